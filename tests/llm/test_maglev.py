from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from fiscalflow.llm import maglev as M


def brute(shards, slots):
    """Whole preference lists, walked turn by turn."""
    names = sorted(shards)
    lists = {}
    for n in names:
        start, step = xxhash.xxh64_intdigest(n, seed=1) % slots, 1 + xxhash.xxh64_intdigest(n, seed=2) % (slots - 1)
        lists[n] = iter([(start + j * step) % slots for j in range(slots)])
    table = {}
    while len(table) < slots:
        for n in names:
            for _ in range(shards[n]):
                if len(table) < slots:
                    table[next(s for s in lists[n] if s not in table)] = n
    return [table[i] for i in range(slots)]


def test_table_against_brute_force():
    for shards in ({"a": 1}, {"a": 1, "b": 1, "c": 1}, {"a": 3, "b": 1, "zero": 0}):
        assert M.fill_table(shards, 101) == brute({k: v for k, v in shards.items() if v}, 101)
    with pytest.raises(ValueError):
        M.fill_table({"a": 1}, 100)
    with pytest.raises(ValueError):
        M.fill_table({}, 101)


def test_even_and_stable():
    shards = {f"s{i}": 1 for i in range(50)}
    table = M.fill_table(shards)
    sizes = Counter(table)
    assert max(sizes.values()) - min(sizes.values()) <= 1
    without = M.fill_table({k: v for k, v in shards.items() if k != "s7"})
    moved = sum(a != b for a, b in zip(table, without, strict=True) if a != "s7")
    assert moved < 0.1 * len(table) and "s7" not in without
    weighted = Counter(M.fill_table({"a": 3, "b": 1}))
    assert abs(weighted["a"] / weighted["b"] - 3) < 0.01


def test_whole_table(spark, docs):
    shards = {f"s{i}": 1 for i in range(10)}
    rows = M.shard_documents(docs.select("doc_id", "text"), shards, "s0").collect()
    table, after = M.fill_table(shards), M.fill_table({k: 1 for k in shards if k != "s0"})
    slot = {r.doc_id: r.s for r in docs.select("doc_id", F.pmod(F.xxhash64("doc_id"), F.lit(M.SLOTS)).alias("s")).collect()}
    size = {r.doc_id: len(r.text) for r in docs.collect()}
    assert len(rows) == len(slot)
    for r in rows:
        assert (r.slot, r.shard, r.shard_after, r.n_chars) == (slot[r.doc_id], table[slot[r.doc_id]], after[slot[r.doc_id]], size[r.doc_id])


def test_hot_key_is_spread(spark):
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 300)).alias("key"))
    shards = {f"s{i}": 1 for i in range(8)}
    got = M.place(rows, shards, key="key")
    per_shard = [r["count"] for r in got.groupBy("shard").count().collect()]
    assert len(per_shard) == 8 and max(per_shard) < 2 * 3000 / 8
    cold = got.where("key != 'hot'").groupBy("key").agg(F.countDistinct("shard").alias("n")).agg(F.max("n")).first()[0]
    assert cold == 1


def test_odd_rows(odd, empty):
    shards = {"a": 1, "b": 1}
    rows = M.place(odd, shards).collect()
    assert len(rows) == odd.count() and all(r.shard in ("a", "b") for r in rows)
    assert len({r.shard for r in rows if r.doc_id == 6}) == 1
    assert M.shard_documents(odd.select("doc_id", "text"), shards, "a").count() == odd.count()
    assert M.place(empty, shards).count() == 0 and M.place(odd, shards, key="source").count() == odd.count()
