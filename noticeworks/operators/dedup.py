"""Keyed deduplication by an explicit order.

Where the caller states that every row has an order and no two rows of a key share theirs
(``unique``), and orders have a fixed width (a number, a date or a time stamp), nothing is sorted to
find the rows that win. Rows of fixed width are reduced in a hash table. Of others only keys and
orders are, and the winners are then picked by key and order; the rows of a hot key stay spread,
since the order is part of what they are joined by. Otherwise whole rows are reduced to one per key in every task
before the shuffle: a key that holds a large part of the input (rows without a reference share one)
arrives as one row per task, and of rows with equal orders one is kept.
"""

from __future__ import annotations

from functools import reduce
from operator import add, and_

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import BooleanType, DateType, NumericType, TimestampNTZType, TimestampType


_FIXED = (NumericType, BooleanType, DateType, TimestampType, TimestampNTZType)


def packed_order(*parts: tuple[Column, int]) -> Column:
    """Whole numbers from 0 as one bigint that sorts like them, the first part counting most.

    Each part comes with its digits, 18 at most for all parts together; a number that does not fit
    its digits fails. A wider order stays a struct: packed into a decimal it costs more than it saves.
    """
    left = sum(digits for _, digits in parts)
    if left > 18:
        raise ValueError("a packed order has 18 digits at most")
    total = []
    for value, digits in parts:
        left -= digits
        fits = (value >= 0) & (value < 10 ** digits)
        checked = F.when(fits, value).otherwise(F.raise_error(F.lit(f"an order of {digits} digits expected")))
        total.append(checked.cast("bigint") * F.lit(10 ** left).cast("bigint"))
    return reduce(add, total)


def _pick(df: DataFrame, keys: list[str], order: str, best, pick, extra, unique: bool) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    if unique and all(isinstance(df.schema[c].dataType, _FIXED) for c in [order, *rest]):
        won = df.groupBy(*keys).agg(*[pick(c, F.col(order)).alias(c) for c in rest], *extra)
        return won.select(*df.columns, *[c for c in won.columns if c not in df.columns])
    if unique and isinstance(df.schema[order].dataType, _FIXED):
        won = df.groupBy(*[F.col(k).alias(f"_key_{k}") for k in keys]).agg(best(order).alias("_best"), *extra)
        on = [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys] + [F.col(order).eqNullSafe(F.col("_best"))]
        names = [c for c in won.columns if c != "_best" and not c.startswith("_key_")]
        return df.join(won, reduce(and_, on)).select(*df.columns, *names)
    row = F.struct(*rest)
    won = df.groupBy(*keys).agg(pick(row, F.col(order)).alias("_row"), *extra)
    names = [c for c in won.columns if c not in ("_row", *keys)]
    return won.select(*keys, "_row.*", *names).select(*df.columns, *names)


def first_wins(df: DataFrame, keys: list[str], order: str = "ingest_ord", *extra, unique: bool = False) -> DataFrame:
    """The first row of every key; ``extra`` aggregates are added as columns."""
    return _pick(df, keys, order, F.min, F.min_by, extra, unique)


def last_wins(df: DataFrame, keys: list[str], order: str = "ingest_ord", *extra, unique: bool = False) -> DataFrame:
    """The last row of every key; ``extra`` aggregates are added as columns."""
    return _pick(df, keys, order, F.max, F.max_by, extra, unique)
