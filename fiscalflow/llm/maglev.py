"""Sharding by a permutation-filled lookup table.

Every shard has its own order of preference over the slots of a table of prime
size (a start and a step from hashes of its name).  Shards take turns, and in
its turn a shard claims the first slot of its order that is still free, until
no slot is free; a shard of weight w gets w turns for one of a shard of weight
1.  Shares differ by about one slot, and a table without one shard keeps
nearly all other placements.  A row's slot is its key's hash modulo the size,
and the broadcast table (its size is a parameter) names the shard.

A key that holds more than a shard's fair share of rows is hot: its rows are
placed by key and id together, so no shard gets them all.

Defined results: a row whose id is null is placed by a hash of all its
columns; repeated rows go to one shard (rows without an id, too); an empty
table gives an empty result; columns named like the result's are left out of
it, and are never mistaken for it.
"""

from __future__ import annotations

from functools import reduce

import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fiscalflow.llm.common import arrow_rows, scratch_path

#: Slots of the table: a prime far above the number of shards.
SLOTS = 65_537
#: Shards of the registered query.
SHARDS = 64


def fill_table(shards: dict[str, int], slots: int = SLOTS) -> list[str]:
    """The shard of each slot, for shard names with whole weights (0: gets no slot)."""
    names = sorted(name for name, weight in shards.items() if weight > 0)
    if not names:
        raise ValueError("no shard has a positive weight")
    if slots < 2 or any(slots % k == 0 for k in range(2, int(slots**0.5) + 1)):
        raise ValueError("the number of slots must be prime")
    at = {n: xxhash.xxh64_intdigest(n, seed=1) % slots for n in names}
    step = {n: 1 + xxhash.xxh64_intdigest(n, seed=2) % (slots - 1) for n in names}
    table: list[str | None] = [None] * slots
    free = slots
    while free:
        for name in names:
            for _ in range(shards[name]):
                while free and table[at[name]] is not None:
                    at[name] = (at[name] + step[name]) % slots
                if free:
                    table[at[name]] = name
                    free -= 1
    return [name for name in table if name is not None]


def _slot(hashed: Column, slots: int) -> Column:
    return F.pmod(hashed, F.lit(slots)).cast("int")


def place(rows: DataFrame, shards: dict[str, int], key: str = "doc_id", id_col: str = "doc_id", slots: int = SLOTS) -> DataFrame:
    """The rows with ``slot`` and ``shard``; no shuffle but for the count of a key that is not the id."""
    spark = rows.sparkSession
    keep = [c for c in rows.columns if c.lower() not in ("slot", "shard", "_hot", "_slot")]
    rows = rows.select(*keep)
    of_row = F.when(F.col(id_col).isNull(), F.xxhash64(*(F.col(c).cast("string") for c in keep))).otherwise(F.xxhash64(F.col(id_col)))
    hashed: Column = of_row
    if key != id_col:
        counts = rows.groupBy(F.col(key).alias("_hot")).agg(F.count(F.lit(1)).alias("_n"))
        total = counts.agg(F.sum("_n")).first()[0] or 0
        fair = max(1.0, total / max(1, sum(1 for w in shards.values() if w > 0)))
        # At most as many keys as shards have more than a fair share.
        hot = [r["_hot"] for r in counts.where(F.col("_n") > fair).select("_hot").collect()]
        is_hot = reduce(lambda a, b: a | b, [F.col(key).eqNullSafe(F.lit(h)) for h in hot], F.lit(False))
        hashed = F.when(is_hot, F.xxhash64(F.col(key), of_row)).otherwise(F.xxhash64(F.col(key)))
    table = spark.createDataFrame(list(enumerate(fill_table(shards, slots))), "_slot int, shard string")
    placed = rows.withColumn("slot", _slot(hashed, slots))
    return placed.join(F.broadcast(table), F.col("slot") == F.col("_slot")).drop("_slot")


def write_shards(placed: DataFrame, out: str) -> None:
    """One folder a shard; Spark splits a shard that is too large for one task over several files."""
    placed.hint("rebalance", "shard").write.partitionBy("shard").parquet(out)


def shard_documents(docs: DataFrame, shards: dict[str, int], lost: str) -> DataFrame:
    """(doc_id, slot, shard, shard_after, n_chars) of every row, read back from the written shards.

    ``shard_after`` is the place once the shard ``lost`` is gone.
    """
    spark = docs.sparkSession
    arrow_rows(spark)
    path = scratch_path(spark, "shards")
    write_shards(place(docs, shards), path)
    rows = spark.read.schema("doc_id long, text string, slot int, shard string").parquet(path)
    after = fill_table({k: v for k, v in shards.items() if k != lost})
    table = spark.createDataFrame(list(enumerate(after)), "_slot int, shard_after string")
    rows = rows.join(F.broadcast(table), F.col("slot") == F.col("_slot"))
    return rows.select("doc_id", "slot", "shard", "shard_after", F.length(F.coalesce("text", F.lit(""))).cast("long").alias("n_chars"))
