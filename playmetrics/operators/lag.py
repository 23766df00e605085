"""Previous timestamp per key, whatever a key's share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from playmetrics.operators.ordering import with_previous
from playmetrics.storage import store

# Rows of one key and day that a task orders by itself.
CELL_ROWS = 1_000_000


def lag_time(
    df: DataFrame, key: str, time: str, ties: str, out: str, cell_rows: int = CELL_ROWS
) -> DataFrame:
    """Add ``out``: ``time`` of the row before, within ``key``, ordered by ``time``, then ``ties``.

    A window over a key would send all its rows to one task. Here rows are ordered within a cell, a
    key's day; the first row of a cell takes the last time of the cell before, from an
    aggregate with a row per cell. A key with most of the rows is thus spread over its days. A cell
    of more than ``cell_rows`` rows, such as all rows of a key without a time, is not ordered by one task:
    the rows of all such cells are sorted by range, and the last row of each sort partition is
    carried into the next one.

    NULLs come last in both orders; NULL keys form one group, as in a window. Calling this runs a job that
    stores a row per cell, and another one that stores the rows of large cells if there are any.
    """
    # a struct is never NULL itself, so the join and the window agree on their key
    cell = F.struct(F.col(key).alias("key"), F.to_date(time).alias("day"))
    rows = df.withColumn("_cell", cell)
    days = Window.partitionBy("_cell.key").orderBy(F.col("_cell.day").asc_nulls_last())
    cells = store(
        rows.groupBy("_cell").agg(F.max(time).alias("_last"), F.count(F.lit(1)).alias("_rows"))
        .select("_cell", "_rows", F.lag("_last").over(days).alias("_before"))
    )
    large = cells.where(F.col("_rows") > cell_rows).drop("_rows")
    order = [F.col(time).asc_nulls_last(), F.col(ties).asc_nulls_last()]

    def result(first, earlier):
        return F.when(first, F.col("_before")).otherwise(earlier).alias(out)

    def windowed(some: DataFrame) -> DataFrame:
        within = Window.partitionBy("_cell").orderBy(*order)
        return (
            some.join(cells, "_cell")
            .withColumn("_first", F.row_number().over(within) == 1)
            .withColumn("_earlier", F.lag(time).over(within))
            .select(*df.columns, result(F.col("_first"), F.col("_earlier")))
        )

    if large.isEmpty():
        return windowed(rows)
    held = rows.join(large, "_cell").withColumn("_row", F.monotonically_increasing_id())
    placed = with_previous(
        held, ["_cell.key", "_cell.day", *order, "_row"], ["_cell", time], "_previous"
    )
    first = ~F.col("_previous._cell").eqNullSafe(F.col("_cell"))
    spread = placed.select(*df.columns, result(first, F.col(f"_previous.{time}")))
    return windowed(rows.join(large, "_cell", "left_anti")).unionByName(spread)
