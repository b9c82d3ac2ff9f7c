"""Exact quantiles by distributed selection: repeated counting in shrinking ranges.

``percentile`` keeps every distinct value of a key in one aggregation state;
a continuous column of a large key does not fit.  Here a round brackets each
wanted rank with a sketch of bounded size (``percentile_approx``) and counts
exactly how many rows lie below, at and between the bracket's ends.  The rank
then is at an end, and its value known, or strictly between them, and only
those rows take part in the next round.  A round leaves about 2 /
``ACCURACY`` of a key's rows, ties at the ends never come back, and when at
most ``FEW`` rows are left they are numbered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fiscalflow.functions._util import column
from fiscalflow.operators.keyed import BROADCAST_ROWS
from fiscalflow.session import materialize

#: Parts of the sketch: its ranks are right to 1 / ACCURACY of the rows.
ACCURACY = 1000
#: Rows of a key that are sorted at the end.
FEW = 10_000


def _matched(keys: Sequence[str], prefix: str) -> Column:
    on = F.lit(True)
    for k in keys:
        on = on & column(k).eqNullSafe(F.col(f"{prefix}{k}"))
    return on


def exact_ranks(df: DataFrame, keys: Sequence[str], value: str, ranks: DataFrame) -> DataFrame:
    """(keys, rank, value) of ``ranks`` (keys, rank from 1, at most the key's rows): the value of each rank in ascending order.

    Null values do not count.  ``ranks`` is a written table.
    """
    spark = df.sparkSession
    names = list(keys)
    keys = [f"__{i}" for i in range(len(names))]
    rows = df.select(*[column(n).alias(k) for n, k in zip(names, keys, strict=True)], column(value).cast("double").alias("v")).where("v IS NOT NULL")
    todo = ranks.select(*[column(n).alias(f"t{k}") for n, k in zip(names, keys, strict=True)], F.col("rank").cast("long").alias("rank"), F.lit(0).cast("long").alias("below"), F.lit(None).cast("double").alias("lo"), F.lit(None).cast("double").alias("hi"))
    tkeys = [f"t{k}" for k in keys]
    known: DataFrame | None = None
    while True:
        side = F.broadcast(todo) if todo.count() <= BROADCAST_ROWS else todo
        inside = (F.col("lo").isNull() | (F.col("v") > F.col("lo"))) & (F.col("hi").isNull() | (F.col("v") < F.col("hi")))
        active = rows.join(side, _matched(keys, "t") & inside).select(*tkeys, "rank", "below", "lo", "hi", "v")
        by = [*tkeys, "rank"]
        # The bracket: the sketch's values a little before and after the rank.
        counted = active.groupBy(*by, "below", "lo", "hi").agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("v", F.array(*[F.lit(i / ACCURACY) for i in range(ACCURACY + 1)]), F.lit(4 * ACCURACY)).alias("s"), F.min("v").alias("least"), F.max("v").alias("most"))
        share = (F.col("rank") - F.col("below")) / F.col("n") * ACCURACY
        end = lambda i: F.element_at("s", F.greatest(F.lit(1), F.least(F.lit(ACCURACY + 1), i)).cast("int"))
        new = counted.select(*by, "below", "lo", "hi", "n", F.when(share < 1.5, F.col("least")).otherwise(end(F.floor(share))).alias("a"), F.when(share > ACCURACY - 1.5, F.col("most")).otherwise(end(F.ceil(share) + 2)).alias("b"))
        new = materialize(new, spark, "selection-bracket")
        few = new.where(F.col("n") <= FEW)
        if few.take(1):
            small = _numbered(rows, keys, few, inside)
            known = small if known is None else known.unionByName(small)
        large = new.where(F.col("n") > FEW)
        if not large.take(1):
            return known.select(*[F.col(t).alias(n) for t, n in zip(tkeys, names, strict=True)], "rank", "value") if known is not None else _none(df, names)
        side = F.broadcast(large) if large.count() <= BROADCAST_ROWS else large
        v = F.col("v")
        split = rows.join(side, _matched(keys, "t") & inside).groupBy(*by, "below", "lo", "hi", "a", "b").agg(F.count_if(v < F.col("a")).alias("n_a"), F.count_if(v == F.col("a")).alias("at_a"), F.count_if((v > F.col("a")) & (v < F.col("b"))).alias("n_ab"), F.count_if(v == F.col("b")).alias("at_b"))
        place = F.col("rank") - F.col("below")
        after_a, after_ab = F.col("n_a") + F.col("at_a"), F.col("n_a") + F.col("at_a") + F.col("n_ab")
        at_b = F.when(F.col("b") > F.col("a"), F.col("at_b")).otherwise(0)
        split = materialize(split.select("*", F.when((place > F.col("n_a")) & (place <= after_a), F.col("a")).when((place > after_ab) & (place <= after_ab + at_b), F.col("b")).alias("value"), place.alias("place"), after_a.alias("after_a"), (after_ab + at_b).alias("after_b")), spark, "selection-counts")
        found = split.where("value IS NOT NULL").select(*by, "value")
        known = found if known is None else known.unionByName(found)
        # Below a, between a and b, or (where the sketch was off) above b.
        low, mid = F.col("place") <= F.col("n_a"), F.col("place") <= F.col("after_b")
        rest = split.where("value IS NULL")
        todo = materialize(rest.select(*by, F.when(low, F.col("below")).when(mid, F.col("below") + F.col("after_a")).otherwise(F.col("below") + F.col("after_b")).alias("below"), F.when(low, F.col("lo")).when(mid, F.col("a")).otherwise(F.col("b")).alias("lo"), F.when(low, F.col("a")).when(mid, F.col("b")).otherwise(F.col("hi")).alias("hi")), spark, "selection-todo")
        if not todo.take(1):
            return known.select(*[F.col(t).alias(n) for t, n in zip(tkeys, names, strict=True)], "rank", "value")


def _numbered(rows: DataFrame, keys: Sequence[str], few: DataFrame, inside: Column) -> DataFrame:
    """The values of ranks in ranges of at most ``FEW`` rows."""
    by = [*[f"t{k}" for k in keys], "rank"]
    side = F.broadcast(few) if few.count() <= BROADCAST_ROWS else few
    order = Window.partitionBy(*by).orderBy("v")
    return rows.join(side, _matched(keys, "t") & inside).withColumn("__place", F.row_number().over(order)).where(F.col("__place") == F.col("rank") - F.col("below")).select(*by, F.col("v").alias("value"))


def _none(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.select(*[column(n) for n in names], F.lit(0).cast("long").alias("rank"), F.lit(0.0).alias("value")).where("false")


def exact_median(df: DataFrame, keys: Sequence[str], value: str, name: str = "mediana") -> DataFrame:
    """(keys, name): the exact median of each key's values that are not null; of an even number, the mean of the middle two."""
    keys = list(keys)
    counts = materialize(df.where(column(value).isNotNull()).groupBy(*[column(k) for k in keys]).agg(F.count(F.lit(1)).alias("__n")).where("__n > 0"), df.sparkSession, "selection-ranks")
    middle = F.array_distinct(F.array(F.floor((F.col("__n") + 1) / 2), F.floor(F.col("__n") / 2) + 1))
    ranks = materialize(counts.select(*[column(k) for k in keys], F.explode(middle).alias("rank")), df.sparkSession, "selection-ranks")
    return exact_ranks(df, keys, value, ranks).groupBy(*[column(k) for k in keys]).agg(F.avg("value").alias(name))
