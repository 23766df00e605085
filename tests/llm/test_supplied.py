"""Registered queries against SQL on the supplied tables, and the pipeline stage by stage."""

import importlib.util
import sys

import duckdb
import pytest

import __spark_entry__ as driver
import corpus_pipeline
from playmetrics.llm import bpe, exact_dedup, mixing, oracles, queries, simhash, toxicity
from playmetrics.storage import store
from tests.compare import assert_same

ROOT = "/root/testdata"
TABLES = ("documents", "pages", "labels", "conversations")


@pytest.mark.parametrize("name", list(oracles.SQL))
@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_query_matches_sql(spark, name, scale):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{ROOT}/{scale}/{table}.parquet'")
    result = queries.QUERIES[name](spark, f"{ROOT}/{scale}")
    assert_same(result, con.sql(oracles.SQL[name]), name)


def test_the_queries_and_the_pipeline_are_registered():
    names = driver.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13
    assert names["pipeline"] is corpus_pipeline.run
    assert oracles.SQL.items() <= driver.oracle_sql().items()


def test_the_rest_does_without(monkeypatch):
    """Without this subpackage and the pipeline, the entry still offers the other queries."""
    class Gone:
        def find_spec(self, name, path=None, target=None):
            if name == "corpus_pipeline" or name.startswith("playmetrics.llm"):
                raise ModuleNotFoundError(f"No module named {name!r}", name=name)

    for name in [m for m in sys.modules if m == "corpus_pipeline" or m.startswith("playmetrics.llm")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setattr(sys, "meta_path", [Gone(), *sys.meta_path])
    spec = importlib.util.spec_from_file_location("entry_alone", driver.__file__)
    alone = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(alone)
    assert alone.queries().keys() == alone.oracle_sql().keys() == set(driver.ANALYSES)


def test_pipeline_stage_by_stage(spark):
    folder = f"{ROOT}/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, rows = docs.columns, []
    for _, stage in corpus_pipeline.STAGES:
        before, docs = docs, store(stage(spark, docs, folder))
        rows.append((before, docs))
    assert all(after.columns == columns for _, after in rows[:-1])
    ids = lambda df: sorted(r["doc_id"] for r in df.select("doc_id").collect())

    before, after = rows[0]
    judged = toxicity.screen(before, spark.read.parquet(f"{folder}/labels.parquet"), queries.toxicity_chain())
    assert ids(after) == ids(judged.where("kept"))
    before, after = rows[1]
    assert ids(after) == ids(exact_dedup.exact_dedup(before).where("kept"))
    before, after = rows[2]
    assert ids(after) == ids(simhash.near_duplicates(before).where("doc_id = component_id"))
    before, after = rows[3]
    taken = {r["doc_id"]: r["taken"] for r in mixing.mix(before).collect() if r["taken"]}
    words = dict.fromkeys(taken, 0)
    for r in after.collect():
        words[r["doc_id"]] += len(r["text"].split())
        assert r["n_chars"] == len(r["text"])
    assert words == taken
    before, after = rows[4]
    assert after.count() == before.count()
    by_run = corpus_pipeline.run(spark, folder)
    assert sorted(map(tuple, by_run.collect())) == sorted(map(tuple, after.collect()))
