"""Pearson correlation: one pair per key, or every pair of numeric columns.

Written as ``covar_pop / (stddev_pop * stddev_pop)`` over the rows where
both values are present, with ``try_divide``: Spark's ``corr`` raises
``DIVIDE_BY_ZERO`` under ANSI for a constant column, the reference's
libraries give NaN, and here it is null.  One pair is one aggregate; a
matrix is merged from per-task matrices of co-moments.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from fiscalflow.functions._util import col, column


def pearson(a: str | Column, b: str | Column) -> Column:
    """Aggregate expression: correlation of ``a`` and ``b`` over rows where
    both are non-null; null when either is constant or fewer than 2 rows."""
    x, y = col(a), col(b)
    both = x.isNotNull() & y.isNotNull()
    xa, ya = F.when(both, x), F.when(both, y)
    denom = F.stddev_pop(xa) * F.stddev_pop(ya)
    return F.when(F.count(xa) >= 2, F.try_divide(F.covar_pop(xa, ya), F.nullif(denom, F.lit(0.0))))


def corr_pair(df: DataFrame, a: str, b: str, keys: Sequence[str] = (), name: str = "r") -> DataFrame:
    return df.groupBy(*keys).agg(pearson(a, b).alias(name))


#: Keys whose matrices a task holds at a time; tasks whose matrices are merged first.
KEYS_AT_ONCE, FAN_IN = 1000, 64


class Moments:
    """Counts, means and centred products of every pair of columns, over the rows where both have a value.

    ``mean[i, j]`` and ``square[i, j]`` belong to column i on the rows shared
    with column j, ``product[i, j]`` to both.  Values are shifted by one of
    their own before anything is summed, so a constant column has squares of
    exactly 0 however the rows are dealt out.
    """

    def __init__(self, n: np.ndarray, mean: np.ndarray, square: np.ndarray, product: np.ndarray) -> None:
        self.n, self.mean, self.square, self.product = n, mean, square, product

    @classmethod
    def of(cls, values: np.ndarray, there: np.ndarray) -> Moments:
        """Of rows (rows x columns) and the mask of values that are not null."""
        p = values.shape[1]
        if not len(values):
            return cls(*(np.zeros((p, p)) for _ in range(4)))
        first = np.where(there.any(0), values[there.argmax(0), np.arange(p)], 0.0)
        mask = there.astype(np.float64)
        shifted = np.where(there, values - first, 0.0)
        middle = shifted.sum(0) / np.maximum(mask.sum(0), 1)
        centred = np.where(there, shifted - middle, 0.0)
        n = mask.T @ mask
        sums = centred.T @ mask
        share = np.divide(sums, n, out=np.zeros_like(sums), where=n > 0)
        square = (centred**2).T @ mask - sums * share
        return cls(n, np.where(n > 0, (first + middle)[:, None] + share, 0.0), np.maximum(square, 0.0), centred.T @ centred - share * sums.T)

    def merged(self, other: Moments) -> Moments:
        n = self.n + other.n
        weight = np.divide(other.n, n, out=np.zeros_like(n), where=n > 0)
        step = np.where((self.n > 0) & (other.n > 0), other.mean - self.mean, 0.0)
        mean = np.where(self.n > 0, self.mean + step * weight, other.mean)
        both = self.n * weight
        return Moments(n, mean, self.square + other.square + step**2 * both, self.product + other.product + step * step.T * both)

    def pearson(self) -> np.ma.MaskedArray:
        """Coefficients; masked where there are under two rows or no spread."""
        spread = np.sqrt(self.square) * np.sqrt(self.square.T)
        defined = (self.n >= 2) & (spread != 0)
        product = (self.product + self.product.T) / 2  # the same both ways, to the last bit
        return np.ma.array(np.divide(product, spread, out=np.zeros_like(spread), where=defined), mask=~defined)

    def arrays(self) -> tuple[np.ndarray, ...]:
        return self.n, self.mean, self.square, self.product


_MOMENTS = ("__n", "__mean", "__square", "__product")


def _groups(batch: pa.RecordBatch, n_keys: int) -> tuple[np.ndarray, list[tuple]]:
    """(group of each row, keys of each group) of a batch whose first columns are keys."""
    code = np.zeros(len(batch), np.int64)
    for c in batch.columns[:n_keys]:
        coded = pc.dictionary_encode(c, null_encoding="encode")
        _, code = np.unique(code * (len(coded.dictionary) + 1) + coded.indices.to_numpy(), return_inverse=True)
    _, first, code = np.unique(code, return_index=True, return_inverse=True)
    return code, [tuple(batch.column(k)[int(i)].as_py() for k in range(n_keys)) for i in first]


def _partial(n_keys: int, schema: pa.Schema):
    """One row of matrices for each key that a task has met."""

    def rows(found: dict[tuple, Moments], part: int) -> pa.RecordBatch:
        keys = list(zip(*found, strict=True)) or [()] * n_keys
        cols = [pa.array(k, f.type) for k, f in zip(keys, schema, strict=False)]
        cols += [pa.array([a.ravel() for a in arrays], pa.list_(pa.float64())) for arrays in zip(*(m.arrays() for m in found.values()), strict=True)]
        return pa.RecordBatch.from_arrays([*cols, pa.array([part] * len(found), pa.int32())], [*schema.names, *_MOMENTS, "__part"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        found: dict[tuple, Moments] = {}
        for b in batches:
            columns = b.columns[n_keys:]
            there = np.stack([c.is_valid().to_numpy(zero_copy_only=False) for c in columns], 1)
            values = np.stack([pc.fill_null(c, 0.0).to_numpy(zero_copy_only=False) for c in columns], 1)
            group, keys = _groups(b, n_keys)
            order = np.argsort(group, kind="stable")
            cuts = np.searchsorted(group[order], np.arange(len(keys) + 1))
            for k, key in enumerate(keys):
                at = order[cuts[k] : cuts[k + 1]]
                own = Moments.of(values[at], there[at])
                found[key] = found[key].merged(own) if key in found else own
            if len(found) > KEYS_AT_ONCE:
                yield rows(found, part)
                found = {}
        if found:
            yield rows(found, part)

    return run


def _added(table: pa.Table, size: int) -> Moments:
    """The matrices of a table of them, merged in the order of their tasks."""
    total = None
    for r in sorted(table.select([*_MOMENTS, "__part"]).to_pylist(), key=lambda r: r["__part"]):
        own = Moments(*(np.array(r[name]).reshape(size, size) for name in _MOMENTS))
        total = own if total is None else total.merged(own)
    return total


def corr_matrix(df: DataFrame, columns: Sequence[str] | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """Long-form matrix ``(col_a, col_b, r)`` over every ordered pair of the
    given (default: numeric) columns, diagonal included.

    A task folds its rows, batch by batch, into one matrix of counts, means
    and centred products a key (``Moments``); the shuffle carries those
    matrices, a fixed number of doubles a task and key, and they are merged by
    the parallel formula, ``FAN_IN`` tasks at a time first.  No row is
    unpivoted.  ``r`` is null for a constant column or under two rows.
    """
    from fiscalflow.operators.extract import numeric_columns

    keys = list(keys)
    cols = list(columns) if columns else [c for c in numeric_columns(df) if c not in keys]
    safe = [f"__k{i}" for i in range(len(keys))]  # names of any sign come back at the end
    narrow = df.select(*[column(k).alias(s) for k, s in zip(keys, safe, strict=True)], *[column(c).cast("double").alias(f"__{i}") for i, c in enumerate(cols)])
    key_ddl = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in narrow.schema.fields[: len(keys)])
    partial_ddl = key_ddl + ", ".join(f"{name} array<double>" for name in _MOMENTS) + ", __part int"
    key_schema = to_arrow_schema(T.StructType(narrow.schema.fields[: len(keys)]))
    parts = narrow.mapInArrow(_partial(len(keys), key_schema), partial_ddl)

    def merged(table: pa.Table) -> pa.Table:
        total = _added(table, len(cols))
        first = table.slice(0, 1)
        for name, values in zip(_MOMENTS, total.arrays(), strict=True):
            first = first.set_column(first.schema.get_field_index(name), name, pa.array([values.ravel()], pa.list_(pa.float64())))
        return first

    def matrix(table: pa.Table) -> pa.Table:
        r = _added(table, len(cols)).pearson().ravel()
        own = {s: table[s].take(pa.array(np.zeros(len(r), np.int64))) for s in safe}
        names = {"col_a": pa.array(np.repeat(cols, len(cols)).tolist(), pa.string()), "col_b": pa.array(cols * len(cols), pa.string())}
        return pa.table(own | names | {"r": pa.array(r.data, pa.float64(), mask=np.ma.getmaskarray(r))})

    some = parts.groupBy(*safe, F.floor(F.col("__part") / FAN_IN).alias("__fan")).applyInArrow(merged, partial_ddl)
    found = some.groupBy(*safe).applyInArrow(matrix, f"{key_ddl}col_a string, col_b string, r double")
    return found.select(*[F.col(s).alias(k) for k, s in zip(keys, safe, strict=True)], "col_a", "col_b", "r")
