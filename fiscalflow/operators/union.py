"""Relaxed union by column name (``diagonal_relaxed``).

Columns are matched by name in first-seen order, a frame lacking a column
gets nulls, and each column is widened to a common supertype computed on
the driver from the schemas alone (no data read).  Plain ``unionByName``
is not enough under ANSI: it coerces string to bigint or date and then
fails at run time, and it refuses boolean with int.  Names may hold any sign
(a dot is no path into a struct); names that differ in case alone are one
column in its first spelling, as Spark itself cannot hold both.

Supertype ladder: equal -> same; null with T -> T; integers -> the wider
integer; integer with float/double -> double; float with double -> double;
decimal with integer -> a decimal wide enough for both; decimal with
decimal -> the wider decimal; decimal with float/double -> double; date with
timestamp -> timestamp; boolean with a number -> that number; anything else
(string included) -> string.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fiscalflow.functions._util import column

_INT_RANK = {T.ByteType: 1, T.ShortType: 2, T.IntegerType: 3, T.LongType: 4}
_INT_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}


def _is_int(t: T.DataType) -> bool:
    return type(t) in _INT_RANK


def _is_frac(t: T.DataType) -> bool:
    return isinstance(t, (T.FloatType, T.DoubleType))


def _is_time(t: T.DataType) -> bool:
    return isinstance(t, (T.DateType, T.TimestampType, T.TimestampNTZType))


def _wider_decimal(a: T.DecimalType, b: T.DecimalType) -> T.DataType:
    scale = max(a.scale, b.scale)
    whole = max(a.precision - a.scale, b.precision - b.scale)
    if whole + scale > 38:
        return T.DoubleType()
    return T.DecimalType(whole + scale, scale)


def supertype(a: T.DataType, b: T.DataType) -> T.DataType:
    """The ladder above, for two types."""
    if a == b:
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(b, T.NullType):
        return a
    if _is_int(a) and _is_int(b):
        return a if _INT_RANK[type(a)] >= _INT_RANK[type(b)] else b
    if (_is_int(a) and _is_frac(b)) or (_is_frac(a) and _is_int(b)) or (_is_frac(a) and _is_frac(b)):
        return T.DoubleType()
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        return _wider_decimal(a, b)
    if isinstance(a, T.DecimalType) and _is_int(b):
        return _wider_decimal(a, T.DecimalType(_INT_DIGITS[type(b)], 0))
    if _is_int(a) and isinstance(b, T.DecimalType):
        return _wider_decimal(T.DecimalType(_INT_DIGITS[type(a)], 0), b)
    if (isinstance(a, T.DecimalType) and _is_frac(b)) or (_is_frac(a) and isinstance(b, T.DecimalType)):
        return T.DoubleType()
    if _is_time(a) and _is_time(b):
        if isinstance(a, T.TimestampType) or isinstance(b, T.TimestampType):
            return T.TimestampType()
        return T.TimestampNTZType()
    numeric = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
    if isinstance(a, T.BooleanType) and isinstance(b, numeric):
        return b
    if isinstance(b, T.BooleanType) and isinstance(a, numeric):
        return a
    return T.StringType()


def unified_schema(schemas: Sequence[T.StructType]) -> list[tuple[str, T.DataType]]:
    """Column names in first-seen order with their supertypes; names that differ in case alone are one column, in its first spelling."""
    order: dict[str, tuple[str, T.DataType]] = {}
    for s in schemas:
        for f in s.fields:
            name, kind = order.get(f.name.lower(), (f.name, f.dataType))
            order[f.name.lower()] = name, supertype(kind, f.dataType)
    return list(order.values())


def relaxed_union(frames: Sequence[DataFrame]) -> DataFrame:
    """Union frames by name with null fill and type widening; rows kept as
    they are (no de-duplication)."""
    frames = list(frames)
    if not frames:
        raise ValueError("nothing to union")
    target = unified_schema([f.schema for f in frames])

    def conform(df: DataFrame) -> DataFrame:
        have = {f.name.lower(): f for f in df.schema.fields}
        cols = []
        for name, t in target:
            own = have.get(name.lower())
            if own is None:
                cols.append(F.lit(None).cast(t).alias(name))
            elif own.dataType == t:
                cols.append(column(own.name).alias(name))
            elif isinstance(t, T.StringType) and isinstance(own.dataType, T.BooleanType):
                cols.append(F.lower(column(own.name).cast("string")).alias(name))
            else:
                cols.append(column(own.name).cast(t).alias(name))
        return df.select(*cols)

    return reduce(lambda a, b: a.unionByName(b), [conform(f) for f in frames])
