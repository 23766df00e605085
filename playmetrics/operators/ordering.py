"""Global order without a single task.

An unpartitioned window (``row_number``, ``ntile``) moves every row into one task. Here a
range-partitioned sort spreads the rows, each partition numbers its own, and the partition
sizes, one row per sort partition, turn that into a global position.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from playmetrics.storage import store

# monotonically_increasing_id keeps the partition number above bit 33
_SLOT_BITS = 33


def _sorted_slots(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    slot = F.monotonically_increasing_id()
    stored = store(df.orderBy(*order).withColumn("_slot", slot))
    return stored.withColumn("_part", F.shiftright("_slot", _SLOT_BITS))


def _parts(slots: DataFrame, weight: Column) -> DataFrame:
    """One row per sort partition: the weight before it, in it, and overall."""
    sizes = slots.groupBy("_part").agg(F.sum(weight).alias("_size"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("_part").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    return sizes.select(
        "_part",
        "_size",
        F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_size").over(everything).alias("_total"),
    )


def with_position(df: DataFrame, order: Sequence[Column], total: str | None = None) -> DataFrame:
    """Add ``position``, the 1-based rank of each row in ``order``.

    Give an order without ties where the result must not depend on the run. ``total``
    names an optional column for the number of rows. The broadcast side has one row per
    sort partition, however large ``df`` is.
    """
    slots = _sorted_slots(df, order)
    placed = slots.join(F.broadcast(_parts(slots, F.lit(1))), "_part")
    in_part = F.col("_slot").bitwiseAND(F.lit((1 << _SLOT_BITS) - 1))
    extra = [] if total is None else [F.col("_total").alias(total)]
    return placed.select(
        *df.columns, (F.col("_before") + in_part + F.lit(1)).alias("position"), *extra
    )


def with_previous(
    df: DataFrame, order: Sequence[Column | str], columns: Sequence[str], out: str
) -> DataFrame:
    """Add ``out``: a struct of ``columns`` of the row before in ``order``; NULL for the first row.

    Each sort partition looks back within itself, and its first row at the last row of the partition before
    it, which are one row per sort partition. Give an order without ties: rows that are equal in it
    cannot be spread over partitions.
    """
    row = F.struct(*[F.col(c).alias(c) for c in columns])
    slots = _sorted_slots(df, order).withColumn("_here", row)
    ends = slots.groupBy("_part").agg(F.max_by("_here", "_slot").alias("_end"))
    border = F.lag("_end").over(Window.orderBy("_part"))
    borders = ends.select("_part", border.alias("_border"))
    earlier = F.lag("_here").over(Window.partitionBy("_part").orderBy("_slot"))
    return (
        slots.withColumn("_earlier", earlier)
        .join(F.broadcast(borders), "_part")
        .select(*df.columns, F.coalesce("_earlier", "_border").alias(out))
    )


def tile(position: Column, total: Column, tiles: int) -> Column:
    """``ntile(tiles)`` from a position: the first ``total mod tiles`` tiles get one more row."""
    small = F.call_function("div", total, F.lit(tiles).cast("bigint"))
    large_tiles = total % F.lit(tiles)
    large_rows = large_tiles * (small + F.lit(1))
    in_large = F.call_function("div", position - F.lit(1), small + F.lit(1))
    in_small = F.call_function(
        "div", position - F.lit(1) - large_rows, F.greatest(small, F.lit(1).cast("bigint"))
    )
    return F.when(position <= large_rows, in_large + F.lit(1)).otherwise(
        large_tiles + in_small + F.lit(1)
    )
