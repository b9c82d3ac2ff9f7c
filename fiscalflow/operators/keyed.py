"""Attach per-key aggregates back to rows without a per-key window.

An unordered ``OVER (PARTITION BY k)`` window sends every row of a key to
one task and sorts it there; a key that holds a third of the data makes
that task a third of the job.  Here the per-key figures are a partial +
final ``HashAggregate`` (map-side combine, skew-tolerant), and they are
joined back on the key.  The aggregated table is written to the shared folder
when the caller asks for it (``fact_sized``): its row count is then known, and
up to ``BROADCAST_ROWS`` it is broadcast, so the fact side is never exchanged;
beyond that both sides are shuffled, and AQE splits skewed partitions.
Without it the join is a plain equi-join on series-sized input.

With no key at all the figures are one row; that side is broadcast with its
size proven (exactly one row) on a constant join key, not a cross join.
Keys are matched null-safely, so a null key gets its own figures, as it
forms its own group in ``groupBy``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fiscalflow.session import materialize

_GLOBAL = "__all__"


#: Aggregated rows (a few numbers each: 16 MB) that are broadcast at most.
BROADCAST_ROWS = 200_000


def with_key_aggregates(df: DataFrame, keys: Sequence[str], aggs: Sequence[Column], fact_sized: bool = False) -> DataFrame:
    keys = list(keys)
    if not keys:
        stats = df.agg(*aggs).withColumn(_GLOBAL, F.lit(0))
        return (
            df.withColumn(_GLOBAL, F.lit(0))
            .join(F.broadcast(stats), on=_GLOBAL, how="left")
            .drop(_GLOBAL)
        )
    renamed = {k: f"__key{i}" for i, k in enumerate(keys)}
    stats = df.groupBy(*[F.col(k).alias(renamed[k]) for k in keys]).agg(*aggs)
    if fact_sized:
        stats = materialize(stats, df.sparkSession, "key-aggregates")
        if stats.count() <= BROADCAST_ROWS:  # from footers
            stats = F.broadcast(stats)
    cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(renamed[k])) for k in keys])
    return df.join(stats, on=cond, how="left").drop(*renamed.values())
