"""Joins on a key that a few values dominate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Cells that the rows are dealt to at least, for each shuffle partition.
CELLS = 4


def spread_join(many: DataFrame, few: DataFrame, key: str, cells: int | None = None) -> DataFrame:
    """Inner join on ``key`` where single keys may have most of the rows of ``many``.

    A key with more than one ``cells``-th of the rows is split on both sides: its rows in ``many`` are
    dealt to parts of about that size by a hash of the row, and its rows in ``few``, which has few for any
    key, are copied to each part. No more than ``cells`` keys can have that many rows, which bounds
    what is broadcast. Rows that are equal in all columns lie in the same part. ``many`` is read
    three times, for its size, its keys and its rows, so it had better be a stored table. ``cells``
    follows the number of shuffle partitions unless given.
    """
    if cells is None:
        cells = CELLS * int(many.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    everything = many.agg(F.count(F.lit(1)).alias("_all"))
    share = F.col("_rows") * F.lit(cells) / F.col("_all")
    hot = (
        many.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
        .crossJoin(F.broadcast(everything))  # one row
        .where(F.col("_rows") * F.lit(cells) > F.col("_all"))
        .select(key, F.ceil(share).cast("int").alias("_parts"))
    )
    parts = F.coalesce("_parts", F.lit(1))
    part = F.pmod(F.xxhash64(*many.columns), parts).cast("int")
    dealt = many.join(F.broadcast(hot), key, "left").select(*many.columns, part.alias("_part"))
    copied = few.join(F.broadcast(hot), key, "left").select(
        *few.columns, F.explode(F.sequence(F.lit(0), parts - 1)).alias("_part")
    )
    return dealt.join(copied, [key, "_part"]).drop("_part")
