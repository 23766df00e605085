"""Exact dedup: a heavy-hitter split of text digests. DataFrame functions only.

Texts are equal when identical after lower-casing A-Z. They are compared by SHA-256. A
Misra-Gries summary (Spark's frequent-items sketch, mergeable and of fixed size) names the
digests that may be frequent; an exact count verifies them. The verified winners are few by
construction, so they are broadcast and their rows leave on the map side. No group that is
left holds more than a thousandth of the rows, and those are shuffled as usual.

Nulls and edge cases: a null text counts as empty. A null id is smaller than any other. Of
rows with equal text and equal id exactly one stays. An empty table gives no rows. Columns
beside id and text are not read, so their names cannot clash.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from playmetrics.llm.frames import unused_name
from playmetrics.storage import store

# A digest is a heavy hitter from this share of the rows on, so there are at most 1,000.
HEAVY_SHARE = 0.001
# Counters of the summary: its error is at most 3.5 / COUNTERS of the rows, a fifth of the share.
COUNTERS = 16_384
# Digests over the share are certainly among so many of the summary's largest.
SUSPECTS = 2_048
# Summaries of tasks meet in so many places, so at most MEETING_POINTS * SUSPECTS are broadcast.
MEETING_POINTS = 64


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only. ``lower`` does just that where every character is one byte."""
    only_ascii = F.length(text) == F.octet_length(text)
    return F.when(only_ascii, F.lower(text)).otherwise(
        F.translate(text, ascii_uppercase, ascii_lowercase)
    )


def digests(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None
) -> DataFrame:
    """``doc_id``, ``row`` (tells rows with the same id apart) and ``digest``, stored."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    row = F.monotonically_increasing_id() if row_col is None else F.col(row_col)
    return store(docs.select(
        F.col(id_col).alias("doc_id"),
        row.alias("row"),
        F.unhex(F.sha2(lower_ascii(text), 256)).alias("digest"),
    ))


def heavy_hitters(digested: DataFrame, share: float = HEAVY_SHARE) -> DataFrame:
    """Digests of at least ``share`` of the rows, with count and the row that stays; stored.

    Every meeting point has a summary of its tasks' rows. A digest with the share overall has it at
    one of the points at least, so all points' suspects together miss none. Summaries work on
    64-bit hashes of the digests and may name too many, so each suspect is counted exactly.
    """
    rows = digested.count()
    point = F.pmod(F.spark_partition_id(), F.lit(MEETING_POINTS))
    named = (
        digested.select(point.alias("point"), F.xxhash64("digest").alias("hash"))
        .groupBy("point")
        .agg(F.expr(f"approx_top_k(hash, {SUSPECTS}, {COUNTERS})").alias("top"))
        .select(F.explode("top.item").alias("hash"))
        .distinct()
    )
    counted = (
        digested.withColumn("hash", F.xxhash64("digest"))
        .join(F.broadcast(named), "hash", "left_semi")
        .groupBy("digest")
        .agg(F.count(F.lit(1)).alias("group_size"), F.max(F.struct("doc_id", "row")).alias("stays"))
    )
    return store(counted.where(F.col("group_size") >= max(2, share * rows)))


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None
) -> DataFrame:
    """One row per document: the one it gives way to, and whether it stays.

    Columns ``doc_id, row, keep_id, group_size, kept, text_sha256``. Of equal texts the row with
    the largest id stays. ``row_col`` may name a stored column that tells all rows apart. Calling
    this runs jobs and stores two tables in the shared folder.
    """
    digested = digests(docs, id_col, text_col, row_col)
    heavy = heavy_hitters(digested)
    same = Window.partitionBy("digest")
    light = digested.join(F.broadcast(heavy.select("digest")), "digest", "left_anti").select(
        "*",
        F.count(F.lit(1)).over(same).alias("group_size"),
        F.max(F.struct("doc_id", "row")).over(same).alias("stays"),
    )
    split = digested.join(F.broadcast(heavy), "digest").unionByName(light)
    return split.select(
        "doc_id",
        "row",
        F.col("stays.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("stays.row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    ``docs`` is stored once with a number per row, since ids may repeat.
    """
    number = unused_name(docs, "_row")
    numbered = store(docs.withColumn(number, F.monotonically_increasing_id()))
    verdicts = exact_dedup(numbered, id_col, text_col, number)
    stays = verdicts.where("kept").select(F.col("row").alias(number))
    return numbered.join(stays, number, "left_semi").select(*docs.columns)
