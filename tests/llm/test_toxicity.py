import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from playmetrics.llm import toxicity
from playmetrics.llm.queries import op3_toxicity, toxicity_chain
from tests.llm.frames import AWKWARD, documents, plain

CLEAN = [f"w{i:03d}" for i in range(300)]


def corpus(seed, docs=900):
    """Junk is full of stars; a third of the junk, and some other documents, have a bad word."""
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(docs):
        words = [rng.choice(CLEAN) + "x" * (i % 2) for _ in range(rng.randint(20, 120))]
        junk = rng.random() < 0.2
        toxic = rng.random() < (0.35 if junk else 0.1)
        if junk:
            words[::3] = ["junkword"] * len(words[::3])
        if toxic:
            words.insert(rng.randrange(len(words)), rng.choice(["Vilest", "vilestest", "awfully"]))
        rows.append((i, " ".join(words), "en", "s"))
        labels.append((i, int(not junk), int(toxic)))
    return rows, labels


def label_frame(spark, labels):
    return spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_unseen_documents(spark):
    rows, labels = corpus(1)
    truth = {i: bool(t) for i, _, t in labels}
    known = [x for x in labels if x[0] % 3] + [(None, 1, 1), (0, None, None), (1, 1, 0), (999_999, 0, 1)]
    found = toxicity.screen(documents(spark, rows), label_frame(spark, known), toxicity_chain()).collect()
    assert len(found) == len(rows)
    assert all(r["kept"] is not r["toxic"] for r in found)
    assert all(0 <= r["p_junk"] <= 1 and 0 <= r["p_toxic"] <= 1 for r in found)
    unseen = [r for r in found if r["doc_id"] % 3 == 0]
    assert np.mean([r["toxic"] == truth[r["doc_id"]] for r in unseen]) >= 0.99
    left = toxicity.drop_toxic(documents(spark, rows), label_frame(spark, known), toxicity_chain())
    assert left.columns == documents(spark, rows).columns
    assert {r["doc_id"] for r in left.collect()} == {r["doc_id"] for r in found if r["kept"]}


def test_earlier_likelihoods_are_out_of_fold(spark):
    """The chain's second model must see the first one's likelihoods for rows it never learned from."""
    rows, labels = corpus(2, 300)
    sample = toxicity.labelled_sample(documents(spark, rows), label_frame(spark, labels), toxicity_chain())
    table = sample.orderBy("row").toArrow()
    fold = table.column("fold").to_numpy()
    lists = [np.asarray(x.values) for x in table.column("found").combine_chunks()]
    y = table.column("junk").to_numpy().astype(float)
    nothing = np.zeros((len(y), 0))
    expected = np.zeros(len(y))
    for k in range(toxicity.FOLDS):
        learn, out = np.flatnonzero(fold != k), np.flatnonzero(fold == k)
        model = toxicity.fit([lists[i] for i in learn], nothing[learn], y[learn])
        expected[out] = [toxicity.judge(model, lists[i].tolist(), []) for i in out]
    chain = toxicity.train(sample, ["junk", "toxic"])
    toxic = table.column("toxic").to_numpy().astype(float)
    by_hand = toxicity.fit(lists, expected[:, None], toxic)
    assert by_hand.keys() == chain[1].keys() and toxicity._EARLIER in chain[1]
    assert all(chain[1][f] == pytest.approx(w, abs=1e-9) for f, w in by_hand.items())


def test_a_useful_earlier_category_gets_weight():
    rng = np.random.default_rng(3)
    y = rng.integers(0, 2, 400)
    earlier = np.where(y == 1, 0.9, 0.1)[:, None]
    model = toxicity.fit([np.array([1, 2])] * 400, earlier, y.astype(float))
    assert model[toxicity._EARLIER] > 0.5
    assert toxicity.judge(model, [], [0.9]) > 0.9 > 0.1 > toxicity.judge(model, [], [0.1])


def test_features():
    assert len(toxicity.features(None)) == len(toxicity.features(" .1_ ")) == 0
    assert set(toxicity.features("Abc abc")) == set(toxicity.features("ABC"))
    assert len(toxicity.features("abcdefg")) == 4
    for text in AWKWARD:
        assert (toxicity.features(text) >= 0).all()


def test_no_labels_no_classes_and_empty(spark):
    docs = plain(spark, AWKWARD)
    none = label_frame(spark, [])
    assert all(r["kept"] for r in toxicity.screen(docs, none, toxicity_chain()).collect())
    alike = label_frame(spark, [(i, 1, 0) for i in range(len(AWKWARD))])
    assert all(r["kept"] for r in toxicity.screen(docs, alike, toxicity_chain()).collect())
    assert toxicity.screen(plain(spark, []), none, toxicity_chain()).collect() == []


def test_supplied_labels(spark):
    folder = "/root/testdata/sf0.1"
    truth = spark.read.parquet(f"{folder}/labels.parquet")
    pairs = op3_toxicity(spark, folder).join(truth.withColumnRenamed("toxic", "label"), "doc_id").collect()
    caught = [r["toxic"] for r in pairs if r["label"] == 1]
    wrong = [r["toxic"] for r in pairs if r["label"] == 0]
    assert sum(caught) / len(caught) >= 0.9 and sum(wrong) / len(wrong) <= 0.002


@pytest.mark.parametrize("sample_docs", [toxicity.SAMPLE_DOCS, 1500])
def test_labels_held_out_of_the_supplied_table(spark, sample_docs):
    """A fifth of the labels is never learned; with the smaller sample, most of the others are not either."""
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    known = labels.where("doc_id % 5 <> 0")
    categories = toxicity_chain()
    sample = toxicity.labelled_sample(docs, known, categories, sample_docs=sample_docs)
    assert (sample.count() < known.count() / 1.5) == (sample_docs == 1500)
    chain = toxicity.learn(docs, known, categories, sample_docs=sample_docs)
    unseen = docs.join(labels.where("doc_id % 5 = 0").select("doc_id", F.col("toxic").alias("label")), "doc_id")
    found = toxicity.classify(unseen, chain, list(categories)).join(unseen.select("doc_id", "label"), "doc_id").collect()
    caught = [r["p_toxic"] >= 0.5 for r in found if r["label"] == 1]
    wrong = [r["p_toxic"] >= 0.5 for r in found if r["label"] == 0]
    least = 0.85 if sample_docs > 1500 else 0.75
    assert len(caught) > 50 and sum(caught) / len(caught) >= least and sum(wrong) / len(wrong) <= 0.01


def test_features_passed_on_are_those_that_models_choose(spark):
    """Spark's counts by fold and class against a count by hand, for the model of every fold."""
    rows, labels = corpus(4, 400)
    sample = toxicity.labelled_sample(documents(spark, rows), label_frame(spark, labels), toxicity_chain())
    table = sample.toArrow()
    fold = table.column("fold").to_numpy()
    lists = [x.as_py() for x in table.column("found").combine_chunks()]
    y = table.column("junk").to_numpy()
    models, expected = range(-1, toxicity.FOLDS), set()
    for model in models:
        own = np.flatnonzero(fold != model)
        n, positive = len(own), y[own].sum()
        has, both = {}, {}
        for i in own:
            for f in lists[i]:
                has[f] = has.get(f, 0) + 1
                both[f] = both.get(f, 0) + int(y[i])
        for f, h in has.items():
            spread = h * positive / n * (1 - positive / n) * (1 - h / n)
            if h >= toxicity.LEAST_DOCS and spread > 0:
                if (both[f] - h * positive / n) ** 2 / spread >= toxicity.LEAST_CHI2:
                    expected.add(f)
    found = {r["feature"] for r in toxicity.useful_features(sample, "junk", models, toxicity.FOLDS).collect()}
    assert found == expected and found
