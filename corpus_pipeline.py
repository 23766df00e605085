"""A training-data pipeline over ``documents``: five stages, each one of the corpus operators.

Toxic documents go, then copies, then near copies; sources are mixed to their target shares, and
what is left is encoded. Between stages the documents are stored as Parquet and read again, so a lost
executor costs no earlier stage. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from playmetrics.llm import exact_dedup, mixing, simhash, toxicity
from playmetrics.llm.queries import token_digests, toxicity_chain
from playmetrics.storage import Scope, store

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# what stages have stored, and run has kept between them, oldest first
_owned: list[Scope] = []


def _scoped(stage: Stage) -> Stage:
    """A stage that owns what it stores, and first removes what others own and ``docs`` does not read."""
    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        _owned[:] = [s for s in _owned if s.spark is spark]
        for scope in [s for s in _owned if not s.feeds(docs)]:
            scope.drop()
            _owned.remove(scope)
        scope = Scope(spark).open()
        try:
            return stage(spark, docs, sf_dir)
        finally:
            scope.close()
            _owned.append(scope)

    return run


def _kept(df: DataFrame) -> DataFrame:
    scope = Scope(df.sparkSession).open()
    try:
        return store(df)
    finally:
        scope.close()
        _owned.append(scope)


@_scoped
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier chain does not reject; it learns from the labelled ones."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.drop_toxic(docs, labels, toxicity_chain())


@_scoped
def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest id."""
    return exact_dedup.drop_copies(docs)


@_scoped
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near copies the one with the smallest id."""
    return simhash.drop_near_copies(docs)


@_scoped
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes: texts cut to their blocks, a row per repetition."""
    return mixing.mixed_documents(docs, chars_col="n_chars")


@_scoped
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the text they decode to."""
    return token_digests(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("SimHash near-dedup", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("byte-level BPE encoding and decoding", encode),
]

# Classifiers and hashes are not SQL; tests/llm compares the stages with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    *earlier, (_, last) = STAGES
    for _, stage in earlier:
        docs = _kept(stage(spark, docs, sf_dir))
    return last(spark, docs, sf_dir)
