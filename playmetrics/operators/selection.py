"""The value at a rank without sorting: selection by narrowing.

The interval from the least to the greatest value is cut into buckets of equal width, and rows are counted
by bucket, which combines on the map side. The bucket that holds the rank, from its least to its greatest
value, is the next interval; its ends are values of the table, so the next round's filter is exact and
reaches the scan. A round shrinks the interval at least by the number of buckets, and so prices with cents
take two or three rounds. Nothing is sorted or stored, and what meets in one place
is a row per bucket, or per distinct value where few rows are left.
"""

from __future__ import annotations

from collections.abc import Mapping
from decimal import Decimal, localcontext
from typing import Any

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

BUCKETS = 4096
# Rows that are counted by value instead.
FEW_ROWS = 100_000


def _span(low: Any, high: Any) -> float:
    with localcontext() as context:
        context.prec = 80
        return float(high - low)


def bucket(value: Column, low: Any, high: Any, buckets: int) -> Column:
    """Number of the bucket that ``value`` lies in, from 0; it never falls as the value grows.

    The difference may be rounded to what its type has room for, and then as a double; both keep
    the order, though close values may share a bucket.
    """
    place = (value - F.lit(low)).cast("double") / F.lit(_span(low, high)) * F.lit(float(buckets))
    return F.least(F.floor(place).cast("int"), F.lit(buckets - 1))


def count_buckets(
    df: DataFrame, value: str, low: Any, high: Any, buckets: int = BUCKETS, **measures: Column
) -> list[Row]:
    """``bucket, rows, low, high`` and the measures of each bucket that has rows, in order."""
    inside = df.where(F.col(value).between(F.lit(low), F.lit(high)))
    return inside.groupBy(bucket(F.col(value), low, high, buckets).alias("bucket")).agg(
        F.count(F.lit(1)).alias("rows"), F.min(value).alias("low"), F.max(value).alias("high"),
        *[m.alias(name) for name, m in measures.items()],
    ).orderBy("bucket").collect()


def _holder(rows: list[Row], rank: int) -> tuple[Row, int]:
    """The row in which a rank falls, and the rank within it."""
    for row in rows:
        if rank <= row["rows"]:
            return row, rank
        rank -= row["rows"]
    raise ValueError("the rank is above the number of rows")


def value_at(
    df: DataFrame, value: str, rank: int, rows: list[Row], buckets: int = BUCKETS,
    few_rows: int = FEW_ROWS,
) -> Any:
    """The value of the row with this 1-based ``rank``; ``rows`` are from ``count_buckets``.

    Runs a job for every further round.
    """
    while True:
        found, rank = _holder(rows, rank)
        low, high = found["low"], found["high"]
        if low == high:
            return low
        if found["rows"] <= few_rows or len(rows) == 1:
            break
        rows = count_buckets(df, value, low, high, buckets)
    # few rows, or values so close that buckets cannot tell them apart
    inside = df.where(F.col(value).between(F.lit(low), F.lit(high)))
    counts = inside.groupBy(value).agg(F.count(F.lit(1)).alias("rows")).collect()
    return _holder(sorted(counts, key=lambda r: r[value]), rank)[0][value]


def lower_median(df: DataFrame, value: str, **settings: int) -> Any:
    """``percentile_disc(0.5)`` of the values that are not NULL; None if there are none."""
    ends = df.agg(F.count(value).alias("n"), F.min(value).alias("low"), F.max(value).alias("high")).first()
    if not ends["n"]:
        return None
    if ends["low"] == ends["high"]:
        return ends["low"]
    buckets = settings.get("buckets", BUCKETS)
    rows = count_buckets(df, value, ends["low"], ends["high"], buckets)
    return value_at(df, value, (ends["n"] + 1) // 2, rows, **settings)


def row_of(df: DataFrame, values: Mapping[str, tuple[Any, str]]) -> DataFrame:
    """One row of known values with their types, in the session of ``df``."""
    def known(value: Any, kind: str) -> Column:
        return F.lit(value if not isinstance(value, Decimal) else str(value)).cast(kind)

    return df.sparkSession.range(1).select(*[
        known(value, kind).alias(name) for name, (value, kind) in values.items()
    ])
