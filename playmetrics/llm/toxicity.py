"""Toxicity by classifier chains over text categories.

The categories are predicted one after the other by linear models. Each model reads which words and
word beginnings a text has, and how likely the earlier models find their categories. For
training these likelihoods come out of fold: the rows of a fold are judged by a model that
never saw them, so that a later model does not learn to trust an overfitted one.

Models are fitted on a bounded sample of labelled documents, about ``SAMPLE_DOCS`` by a hash of the
id, however large the corpus. Spark counts the sample's features by fold and class and finds those that
any fold's model can use; only these go to the tasks that fit, one for each fold's model. All
documents are judged.

A feature is a lower-cased word, or the first 4, 5 or 6 letters of a longer one, as a 63-bit
hash; a text has it or has not. A model keeps the features that differ significantly
between its classes (chi-square of at least ``LEAST_CHI2``), at most ``MAX_FEATURES`` of them.

Nulls and edge cases: a null text counts as empty and has no features. Null labels are left out,
null ids never match a label, several labels of an id count by their maximum. A category whose
sample lacks one of its classes gets the constant share of the other, 0 without any label.
Repeated rows get repeated verdicts. An empty table gives no rows. Of the documents only id and
text are read. A text is held whole by one task.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from playmetrics.llm.frames import give_back_memory
from playmetrics.storage import store

SAMPLE_DOCS = 12_000
FOLDS = 5
BEGINNINGS = (4, 5, 6)
LEAST_CHI2 = 30.0
LEAST_DOCS = 3
MAX_FEATURES = 2_000
# Features that Spark passes on beyond those, as its arithmetic may differ in the last place.
_SPARE = 100
THRESHOLD = 0.5
_STEPS = 300
_PENALTY = 1e-3
# Feature numbers of the constant and of the earlier categories.
_CONSTANT = -1
_EARLIER = -2

_LETTERS = re.compile(r"[^\W\d_]+")

Model = dict[int, float]


def features(text: str | None) -> np.ndarray:
    """The hashed features of a text, sorted and without copies."""
    words = set(_LETTERS.findall((text or "").lower()))
    keys = set(words)
    for k in BEGINNINGS:
        keys.update(f"{w[:k]}*" for w in words if len(w) > k)
    hashed = {xxhash.xxh64_intdigest(key) >> 1 for key in keys}
    return np.array(sorted(hashed), np.int64)


# --- fitting one model ----------------------------------------------------------------------------

def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-3, 1 - 1e-3)
    return np.log(p / (1 - p))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _select(places: np.ndarray, rows: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Features that differ between the classes, by the chi-square of their 2 x 2 table."""
    n, positive = len(y), y.sum()
    has = np.bincount(places).astype(float)
    both = np.bincount(places, weights=y[rows])
    expected = has * positive / n
    spread = expected * (1 - positive / n) * (1 - has / n)
    chi2 = np.divide((both - expected) ** 2, spread, out=np.zeros(len(has)), where=spread > 0)
    chosen = np.flatnonzero((chi2 >= LEAST_CHI2) & (has >= LEAST_DOCS))
    return np.sort(chosen[np.lexsort((chosen, -chi2[chosen]))][:MAX_FEATURES])


def fit(lists: Sequence[np.ndarray], earlier: np.ndarray, y: np.ndarray) -> Model:
    """Logistic regression with a ridge penalty: weights by feature number.

    ``lists`` are the features of each row, ``earlier`` (rows, categories) likelihoods, ``y`` 0 or 1.
    """
    if not len(y) or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.0
        return {_CONSTANT: float(_logit(np.array(share)))}
    seen, places = np.unique(np.concatenate(lists), return_inverse=True)
    rows = np.repeat(np.arange(len(y)), [len(x) for x in lists])
    chosen = _select(places, rows, y)
    column = np.full(len(seen), -1, np.int32)
    column[chosen] = np.arange(len(chosen))
    kept = column[places] >= 0
    rows, columns = rows[kept], column[places[kept]]
    extra = np.column_stack([np.ones(len(y)), _logit(earlier)]) if earlier.shape[1] else np.ones(
        (len(y), 1)
    )
    w, v = np.zeros(len(chosen)), np.zeros(extra.shape[1])
    v[0] = _logit(y.mean())
    means = [np.zeros_like(w), np.zeros_like(v)]
    squares = [np.zeros_like(w), np.zeros_like(v)]
    for step in range(1, _STEPS + 1):
        z = np.bincount(rows, weights=w[columns], minlength=len(y)) + extra @ v
        off = (_sigmoid(z) - y) / len(y)
        slopes = [
            np.bincount(columns, weights=off[rows], minlength=len(w)) + _PENALTY * w / 10,
            extra.T @ off,
        ]
        for i, (x, g) in enumerate(zip((w, v), slopes)):
            # Adam with its usual constants
            means[i] = 0.9 * means[i] + 0.1 * g
            squares[i] = 0.999 * squares[i] + 0.001 * g * g
            x -= 0.1 * (means[i] / (1 - 0.9 ** step)) / (
                np.sqrt(squares[i] / (1 - 0.999 ** step)) + 1e-9
            )
    model = dict(zip(seen[chosen].tolist(), w.tolist()))
    model |= {_EARLIER - k: float(x) for k, x in enumerate(v[1:])}
    model[_CONSTANT] = float(v[0])
    return model


def judge(model: Mapping[int, float], found: Sequence[int], earlier: Sequence[float]) -> float:
    """The likelihood that a text with the features ``found`` is in the model's category."""
    z = model[_CONSTANT] + sum(model.get(f, 0.0) for f in found)
    for k, p in enumerate(earlier):
        z += model.get(_EARLIER - k, 0.0) * float(_logit(np.array(p)))
    return float(_sigmoid(np.array(z)))


# --- the chain ------------------------------------------------------------------------------------

def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    categories: Mapping[str, Column],
    id_col: str = "doc_id",
    text_col: str = "text",
    sample_docs: int = SAMPLE_DOCS,
) -> DataFrame:
    """``row, fold, found`` and a 0/1 column per category for about ``sample_docs`` documents; stored.

    ``labels`` has ``doc_id`` and what the expressions in ``categories`` read.
    """
    names = list(categories)
    known = (
        labels.select("doc_id", *[c.cast("int").alias(name) for name, c in categories.items()])
        .where(F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(*[F.max(name).alias(name) for name in names])
    )
    total = known.count()
    share = min(1.0, sample_docs / max(total, 1))
    cut = int(share * (1 << 30))
    chance = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30))
    sample = known.where(chance < cut)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = texts.join(sample, "doc_id").select(
        F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(FOLDS)).cast("int").alias("fold"),
        "text", *names,
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array(
                [features(t.as_py()) for t in batch.column("text")], pa.list_(pa.int64())
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("fold"), found, *[batch.column(n) for n in names]],
                names=["fold", "found", *names],
            )
        give_back_memory()

    schema = "fold int, found array<bigint>, " + ", ".join(f"`{n}` int" for n in names)
    return store(rows.mapInArrow(run, schema).select(
        F.monotonically_increasing_id().alias("row"), "*"
    ))


def _fitter(name: str, earlier: Sequence[str]):
    def run(table: pa.Table) -> pa.Table:
        """Fit the model of one fold, or of all rows (fold -1), and judge the rows of its fold."""
        model_of = table.column("model")[0].as_py()
        fold = table.column("fold").to_numpy()
        y = table.column(name).to_numpy(zero_copy_only=False).astype(float)
        found = [np.asarray(x.values) for x in table.column("found").combine_chunks()]
        before = np.column_stack([table.column(f"p_{e}").to_numpy() for e in earlier]) if earlier \
            else np.zeros((len(y), 0))
        order = np.argsort(table.column("row").to_numpy())
        learn = order[(fold[order] != model_of) & ~np.isnan(y[order])]
        model = fit([found[i] for i in learn], before[learn], y[learn])
        give_back_memory()
        out = np.flatnonzero(fold == model_of)
        judged = [judge(model, found[i].tolist(), before[i].tolist()) for i in out]
        return pa.table({
            "model": pa.array([model_of] * (len(model) + len(out)), pa.int32()),
            "feature": pa.array([*model, *[None] * len(out)], pa.int64()),
            "row": pa.array([*[None] * len(model), *table.column("row").to_numpy()[out].tolist()],
                            pa.int64()),
            "value": pa.array([*model.values(), *judged], pa.float64()),
        })
    return run


def useful_features(sample: DataFrame, name: str, models: Sequence[int], folds: int) -> DataFrame:
    """``feature`` of all that the model of any fold in ``models`` may choose for a category.

    A model learns from all folds but its own, so counts by fold serve them all. No more than
    ``MAX_FEATURES`` and some for each model come out.
    """
    known = sample.where(F.col(name).isNotNull())
    in_fold = lambda f: F.col("fold") == f
    by_fold = known.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), F.sum(name).alias("positive")).collect()
    size = {r["fold"]: (r["n"], r["positive"]) for r in by_fold}
    counts = known.select("fold", name, F.explode("found").alias("feature")).groupBy("feature").agg(
        *[F.count_if(in_fold(f)).alias(f"has_{f}") for f in range(folds)],
        *[F.count_if(in_fold(f) & (F.col(name) == 1)).alias(f"both_{f}") for f in range(folds)],
    )

    def chi2(model: int) -> Column:
        """NULL for a feature that the model cannot choose."""
        own = [f for f in range(folds) if f != model]
        n = float(sum(size.get(f, (0, 0))[0] for f in own))
        positive = float(sum(size.get(f, (0, 0))[1] for f in own))
        if not 0 < positive < n:
            return F.lit(None).cast("double")
        has = sum((F.col(f"has_{f}") for f in own[1:]), F.col(f"has_{own[0]}")).cast("double")
        both = sum((F.col(f"both_{f}") for f in own[1:]), F.col(f"both_{own[0]}")).cast("double")
        expected = has * F.lit(positive / n)
        spread = expected * F.lit(1 - positive / n) * (F.lit(1.0) - has / F.lit(n))
        value = (both - expected) * (both - expected) / spread
        return F.when((spread > 0) & (has >= LEAST_DOCS), value)

    scores = counts.select("feature", F.explode(F.array(*[
        F.struct(F.lit(m).alias("model"), chi2(m).alias("chi2")) for m in models
    ])).alias("s")).where(F.col("s.chi2") >= LEAST_CHI2 * (1 - 1e-9))
    best = Window.partitionBy("s.model").orderBy(F.desc("s.chi2"), "feature")
    chosen = scores.withColumn("place", F.row_number().over(best))
    return chosen.where(F.col("place") <= MAX_FEATURES + _SPARE).select("feature").distinct()


def _narrowed(sample: DataFrame, name: str, models: Sequence[int], folds: int) -> DataFrame:
    """``sample`` with only the features that matter for a category."""
    # a bounded number of features, see above
    chosen = F.broadcast(useful_features(sample, name, models, folds))
    found = (
        sample.select("row", F.explode("found").alias("feature")).join(chosen, "feature", "left_semi")
        .groupBy("row").agg(F.sort_array(F.collect_list("feature")).alias("found"))
    )
    none = F.array().cast("array<bigint>")
    return sample.drop("found").join(found, "row", "left").withColumn("found", F.coalesce("found", none))


def train(sample: DataFrame, names: Sequence[str], folds: int = FOLDS) -> list[Model]:
    """The chain's models, one per category in order. Only weights reach the driver."""
    chain: list[Model] = []
    judged = sample.select("row")
    for k, name in enumerate(names):
        # the last category is nobody's input, so it needs no models by fold
        models = range(-1, folds) if k + 1 < len(names) else [-1]
        rows = _narrowed(sample, name, models, folds).join(judged, "row")
        dealt = rows.withColumn("model", F.explode(F.array(*[F.lit(m) for m in models])))
        fitted = store(dealt.groupBy("model").applyInArrow(
            _fitter(name, names[:k]), "model int, feature bigint, row bigint, value double"
        ))
        weights = fitted.where((F.col("model") == -1) & F.col("feature").isNotNull())
        found = {r["feature"]: r["value"] for r in weights.collect()}
        chain.append(found or {_CONSTANT: float(_logit(np.array(0.0)))})
        if k + 1 < len(names):
            out_of_fold = fitted.where(F.col("row").isNotNull()).select(
                "row", F.col("value").alias(f"p_{name}")
            )
            judged = store(judged.join(out_of_fold, "row"))
    return chain


def likelihoods(texts: pa.Array, chain: Sequence[Model]) -> np.ndarray:
    """What the chain makes of each text, as (texts, categories)."""
    used = set().union(*chain)
    found = np.zeros((len(texts), len(chain)))
    for i, text in enumerate(texts):
        hits = sorted(used.intersection(features(text.as_py()).tolist()))
        for k, model in enumerate(chain):
            found[i, k] = judge(model, hits, found[i, :k])
    return found


def classify(
    docs: DataFrame,
    chain: Sequence[Model],
    names: Sequence[str],
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id`` and ``p_<name>`` for every category, for every row of ``docs``."""
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = likelihoods(batch.column(1), chain)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(found[:, k]) for k in range(len(chain))]],
                names=["doc_id", *[f"p_{n}" for n in names]],
            )
        give_back_memory()

    return narrow.mapInArrow(run, T.StructType([
        T.StructField("doc_id", narrow.schema["doc_id"].dataType),
        *[T.StructField(f"p_{n}", T.DoubleType()) for n in names],
    ]))


def learn(
    docs: DataFrame,
    labels: DataFrame,
    categories: Mapping[str, Column],
    id_col: str = "doc_id",
    text_col: str = "text",
    sample_docs: int = SAMPLE_DOCS,
) -> list[Model]:
    """The chain for ``categories``: names and expressions over ``labels``, in chain order."""
    sample = labelled_sample(docs, labels, categories, id_col, text_col, sample_docs)
    return train(sample, list(categories))


def screen(
    docs: DataFrame,
    labels: DataFrame,
    categories: Mapping[str, Column],
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per document: ``doc_id``, ``p_<name>`` per category, ``toxic`` and ``kept``.

    The last category decides. Calling this runs the training jobs.
    """
    names = list(categories)
    chain = learn(docs, labels, categories, id_col, text_col)
    toxic = F.col(f"p_{names[-1]}") >= threshold
    return classify(docs, chain, names, id_col, text_col).select(
        "*", toxic.alias("toxic"), (~toxic).alias("kept")
    )


def drop_toxic(
    docs: DataFrame,
    labels: DataFrame,
    categories: Mapping[str, Column],
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """The rows of ``docs`` that ``screen`` keeps, with all their columns, in one pass."""
    chain = learn(docs, labels, categories, id_col, text_col)
    at = docs.columns.index(text_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = likelihoods(batch.column(at), chain)[:, -1]
            yield batch.filter(pa.array(found < threshold))
        give_back_memory()

    return docs.mapInArrow(run, docs.schema)
