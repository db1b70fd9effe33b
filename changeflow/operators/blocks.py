"""Windows over a key's whole history in two steps, so that a key with very many rows is no single task's.

Rows are cut into blocks of the order column, each with about as many rows as the others whatever the order's values are: the
bounds are its quantiles, from a sketch for numbers and times and from a sorted sample for all other types that can be ordered. What
a row needs of its block comes from a window over (key, block); what it needs of the rest of its key's history is a prefix over one
row a block. A table that is small enough for one block has no blocks at all: no pass for bounds, no second step, one window by key.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import WindowSpec

#: Rows that a block has, about.
ROWS_A_BLOCK = 250_000
#: Bytes a row at least: what the optimizer's estimate puts below this for one block needs no pass that counts.
ROW_BYTES = 16
#: Quantiles that the first pass asks for; tables with more blocks than this are asked for all theirs in a second pass.
GRID = 1024
#: Sampled values a block, for orders that have no sketch.
SAMPLED = 50

_SKETCHED = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _estimate(rows: DataFrame) -> int:
    return int(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def _quantiles(rows: DataFrame, order: str, at: list[float]) -> tuple[int, list]:
    """Number of rows, and quantiles of the order in one pass that reads that column alone."""
    seen = rows.agg(F.count(F.lit(1)).alias("n"), F.percentile_approx(order, at, max(10_000, 4 * len(at))).alias("q")).first()
    return seen["n"], seen["q"] or []


def bounds(rows: DataFrame, order: str) -> list:
    """Ascending, distinct values of the order at which blocks begin, the first block's left out; none for a small table."""
    if _estimate(rows) <= ROWS_A_BLOCK * ROW_BYTES:
        return []
    if isinstance(rows.schema[order].dataType, _SKETCHED):
        n, found = _quantiles(rows, order, [i / GRID for i in range(1, GRID)])
        blocks = math.ceil(n / ROWS_A_BLOCK)
        if blocks > GRID:
            found = _quantiles(rows, order, [i / blocks for i in range(1, blocks)])[1]
        elif found:
            found = [found[i * GRID // blocks - 1] for i in range(1, blocks)]
    else:
        n = rows.count()
        blocks = math.ceil(n / ROWS_A_BLOCK)
        sample = rows.select(order).filter(F.col(order).isNotNull()).sample(min(1.0, SAMPLED * blocks / max(n, 1)), seed=7) if blocks > 1 else None
        values = [r[0] for r in sample.orderBy(order).collect()] if sample is not None else []  # bounded: ``SAMPLED`` values a block
        found = [values[i * len(values) // blocks] for i in range(1, blocks)] if values else []
    return [b for i, b in enumerate(found) if i == 0 or b != found[i - 1]]


def _literals(values: list, kind: T.DataType) -> Column:
    """An array of literals; numbers and times as one text, which the optimizer turns into one constant."""
    if isinstance(kind, T.StructType):
        return F.array(*[F.struct(*[F.lit(x).alias(f.name) for x, f in zip(v, kind, strict=True)]).cast(kind) for v in values])
    if isinstance(kind, _SKETCHED) and not isinstance(kind, T.TimestampType):
        return F.split(F.lit(",".join(str(v) for v in values)), ",").cast(T.ArrayType(kind))
    return F.array(*[F.lit(v).cast(kind) for v in values])


def place(value: Column, starts: list, kind: T.DataType) -> Column:
    """How many of the bounds are at or below a value, by bisection; 0 for null."""
    held, step = _literals(starts, kind), 1 << (len(starts).bit_length() - 1)
    steps = F.array(*[F.lit(step >> i) for i in range(step.bit_length())])
    return F.aggregate(steps, F.lit(0), lambda n, s: F.when((n + s <= len(starts)) & (F.get(held, n + s - 1) <= value), n + s).otherwise(n)).cast("long")


def whole() -> WindowSpec:
    """All blocks of a key, of rows that have ``_k`` (the key as a struct, so that null keys are equal) and ``_block``."""
    return W.partitionBy("_k")


def in_order() -> WindowSpec:
    return whole().orderBy("_block")


def before() -> WindowSpec:
    """The blocks of a key before a row's own."""
    return in_order().rowsBetween(W.unboundedPreceding, -1)


class Blocks:
    """``rows`` with the key as ``_k`` and, if there is more than one block, the number of a row's block as ``_block``."""

    def __init__(self, rows: DataFrame, keys: list[str], order: str):
        self.order = order
        starts = bounds(rows, order)
        self.many = bool(starts)
        self.keys = ["_k", "_block"] if self.many else ["_k"]
        rows = rows.withColumn("_k", F.struct(*keys))
        self.rows = rows.withColumn("_block", place(F.col(order), starts, rows.schema[order].dataType)) if self.many else rows

    def inside(self) -> WindowSpec:
        """The window over a key's rows in one block, in order."""
        return W.partitionBy(*self.keys).orderBy(self.order)

    def carry(self, rows: DataFrame, facts: dict[str, Column], *across: dict[str, Column], alone: dict[str, Column]) -> DataFrame:
        """``rows`` with columns that are worked out from facts of blocks.

        ``facts`` are aggregates over (_k, _block), ``across`` columns over them by the windows above, the last of which come back to the
        rows. ``alone`` has what the same columns are where a key is one block, over the facts of the key.
        """
        if not self.many:
            known = rows.withColumns({name: fact.over(whole()) for name, fact in facts.items()}).withColumns(alone)
            return known.drop(*[f for f in facts if f not in alone])
        found = rows.groupBy(*self.keys).agg(*[fact.alias(name) for name, fact in facts.items()])
        for columns in across:
            found = found.withColumns(columns)
        return rows.join(found.select(*self.keys, *across[-1]), self.keys)

    def clean(self, rows: DataFrame, *more: str) -> DataFrame:
        return rows.drop("_k", "_block", *more)
