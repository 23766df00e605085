"""Exact distinct counts of, and semi joins on, ids.

``COUNT(DISTINCT id)`` shuffles a row per distinct id. Here whole-number ids become bits of 64-bit
words, and bits of a word combine before the shuffle: ids that are handed out in sequence move up
to 64 to a row, and a group with very many rows shrinks to its words in every task. Scattered
ids cost one word each, so this is never much worse. An id of another type is a word of its own
with a single bit, which amounts to a plain distinct.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WORD_BITS = 6


def _whole(df: DataFrame, number: str) -> bool:
    return isinstance(df.schema[number].dataType, T.IntegralType)


def _word(df: DataFrame, number: str) -> Column:
    if _whole(df, number):
        return F.shiftright(F.col(number).cast("long"), _WORD_BITS)
    return F.col(number)


def _place(df: DataFrame, number: str) -> Column:
    if _whole(df, number):
        return F.col(number).bitwiseAND(F.lit((1 << _WORD_BITS) - 1)).cast("int")
    return F.when(F.col(number).isNotNull(), F.lit(0))


def mark(df: DataFrame, keys: Sequence[str], number: str, **measures: Column) -> DataFrame:
    """One row per ``keys`` and word of ``number``: ``_word``, ``_bits`` and the measures.

    A NULL number keeps its keys and measures but marks nothing.
    """
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), _place(df, number))
    return df.groupBy(*keys, _word(df, number).alias("_word")).agg(
        F.bit_or(bit).alias("_bits"), *[m.alias(name) for name, m in measures.items()]
    )


def merge(marks: DataFrame, keys: Sequence[str], **measures: Column) -> DataFrame:
    """Unite marks of the same word under other ``keys``."""
    return marks.groupBy(*keys, "_word").agg(
        F.bit_or("_bits").alias("_bits"), *[m.alias(name) for name, m in measures.items()]
    )


def keep_marked(df: DataFrame, number: str, marks: DataFrame) -> DataFrame:
    """Semi join: the rows whose ``number`` is in ``marks``, which has no other keys."""
    return (
        df.withColumn("_word", _word(df, number))
        .join(marks, "_word")
        .where(F.bit_get("_bits", _place(df, number)) == 1)
        .select(*df.columns)
    )


def marked() -> Column:
    """Aggregate over words: how many ids they mark."""
    return F.coalesce(F.sum(F.bit_count("_bits")), F.lit(0))


def count_distinct(
    df: DataFrame, keys: Sequence[str], number: str, out: str, **sums: Column
) -> DataFrame:
    """Distinct ``number`` per ``keys`` as ``out``, along with further sums or counts."""
    return mark(df, keys, number, **sums).groupBy(*keys).agg(
        marked().alias(out), *[F.sum(name).alias(name) for name in sums]
    )


def is_unique(df: DataFrame, number: str) -> bool:
    """Whether no id occurs twice; NULLs do not count. Runs a job."""
    known = df.where(F.col(number).isNotNull())
    found = count_distinct(known, [], number, "distinct", rows=F.count(F.lit(1))).first()
    return found["rows"] is None or found["rows"] == found["distinct"]
