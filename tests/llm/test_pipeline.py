"""The pipeline on awkward and empty tables, and the tables it leaves behind."""

import hashlib

import pytest

import corpus_pipeline
from playmetrics import storage
from playmetrics.storage import store
from tests.llm.frames import AWKWARD, DOCS, documents

LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture
def folder(spark, tmp_path):
    """The session's checkpoint folder set aside for one of our own."""
    context = spark.sparkContext
    before = context.getCheckpointDir()
    context.setCheckpointDir(str(tmp_path / "shared"))
    yield tmp_path
    corpus_pipeline._owned.clear()
    if before is not None:
        context.setCheckpointDir(before)


def tables(spark, folder, rows, labels):
    documents(spark, rows).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, LABELS).write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def stored(folder):
    return {p.parent.name for p in folder.rglob("*.parquet") if p.parent.parent.name == "stored"}


ROWS = [
    *[(i, t, "en", "s" if i % 2 else None) for i, t in enumerate(AWKWARD)],
    (None, "a text without an id", "en", "s"), (None, None, None, None),
    (50, "the same id twice, once like this", "en", "s"), (50, "and once quite different from it", "en", "s"),
    (60, "An Equal Text of some words", "en", "s"), (61, "an equal text of some words", None, "s"),
]


def test_awkward_tables_through_all_stages(spark, folder):
    place = tables(spark, folder, ROWS, [(0, None, None), (None, 1, 1), (3, 1, 0), (3, 0, 0)])
    docs = spark.read.parquet(f"{place}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = store(stage(spark, docs, place))
        assert docs.columns == columns and docs.schema.simpleString() == spark.createDataFrame([], DOCS).schema.simpleString()
        counts.append(docs.count())
    assert counts[1] == counts[0]
    texts = {r["text"] for r in docs.collect()}
    assert "a text without an id" in texts or "the same id twice, once like this" in texts
    assert all(t and t.split() for t in texts)
    found = corpus_pipeline.STAGES[-1][1](spark, docs, place).collect()
    own = {r["doc_id"]: r for r in found}
    assert len(found) == counts[-1]
    for r in docs.collect():
        if sum(x["doc_id"] == r["doc_id"] for x in found) == 1:
            assert own[r["doc_id"]]["decoded_sha256"] == hashlib.sha256(r["text"].encode()).hexdigest()


@pytest.mark.parametrize("rows", [[], [(1, None, None, None)], [(None, "", "", "")] * 3])
def test_empty_tables_and_documents_without_words(spark, folder, rows):
    place = tables(spark, folder, rows, [])
    assert corpus_pipeline.run(spark, place).collect() == []


def test_stages_remove_what_their_predecessors_stored(spark, folder):
    """After each stage, nothing is stored but its own tables and the documents it was given."""
    place = tables(spark, folder, ROWS * 3, [])
    docs, before = spark.read.parquet(f"{place}/documents.parquet"), set()
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        made = stage(spark, docs, place)
        now = stored(folder)
        owned = {path.rsplit("/", 1)[-1] for scope in corpus_pipeline._owned for path in scope.paths}
        assert now == owned, name
        assert len(corpus_pipeline._owned) == (1 if not number else 2), name
        if number + 1 < len(corpus_pipeline.STAGES):
            docs = corpus_pipeline._kept(made)
    assert made.count() > 0
    storage.drop_stored(spark)
    corpus_pipeline._owned.clear()


def test_a_run_removes_the_tables_of_the_last_one(spark, folder):
    place = tables(spark, folder, ROWS, [])
    first = sorted(map(str, corpus_pipeline.run(spark, place).collect()))
    left = len(stored(folder))
    assert sorted(map(str, corpus_pipeline.run(spark, place).collect())) == first
    assert len(stored(folder)) == left
