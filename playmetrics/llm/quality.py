"""Quality rules: base rules and robust multivariate outliers. DataFrame functions only.

Five statistics of a text make a vector: the logarithm of its words, the mean length of a word,
symbols per word (as a logarithm), and the shares of repeated lines and of words in repeated
three-word windows. Per language and source, the minimum covariance determinant gives a centre and
a scatter that outliers cannot pull: the ``SUBSET`` of documents whose covariance has the smallest
determinant, found by concentration steps from two starts, and reweighted once. A document is
rejected if its squared Mahalanobis distance exceeds ``CUTOFF``.

The covariance of the subset is regularised: ``PRIOR_DOCS`` documents' worth of ``PRIOR_SPREAD`` keep
small groups from looking tight, and ``LEAST_SPREAD`` is what any group has at least, since a
statistic may be zero in all of its documents.

A concentration step is one aggregation: documents are counted and summed by group and by the
logarithm of their distance, in steps of 1/16; the nearest bins that hold the subset give the new centre
and scatter. So no group meets in one task, and every step reads one table of statistics, which is
stored. Groups are rows of a table; nothing is collected.

Nulls and edge cases: a null text has no words. Null is a language or source like any other.
Repeated rows count repeatedly. An empty table gives no rows. Only id, text, language and source are
read; a text is held whole by one task. Windows are compared by hashes
and, where these agree, by their words.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from playmetrics.storage import store

SUBSET = 0.75
STEPS = 3
CUTOFF = 30.0
PRIOR_DOCS = 10.0
# The statistics, in the order of the vector: a typical and the least standard deviation.
PRIOR_SPREAD = (1.0, 0.5, 0.1, 0.15, 0.15)
LEAST_SPREAD = (0.3, 0.15, 0.04, 0.1, 0.1)
# What makes the covariance of the nearest 75 % (97.5 %) of a five-dimensional normal
# sample that of the whole, and the 97.5 % point of chi-square with five degrees of freedom.
SUBSET_FACTOR, REWEIGHTED_FACTOR = 1.412, 1.056
REWEIGHTED_WITHIN = 12.833

_SIZE = len(PRIOR_SPREAD)
_X = [f"x{i}" for i in range(_SIZE)]
_PAIRS = [(i, j) for i in range(_SIZE) for j in range(i, _SIZE)]
_GROUP = ["lang_group", "source_group"]
_BINS = 16
_MEDIAN_BINS = 20

# Bits of a code that tell a window's place; the others are its hash.
_PLACE_BITS = 20

_NOT_WORD = r"[\x20\x09-\x0D]+"
_SYMBOLS = "#*$%&|<>"


# --- statistics of a text ---------------------------------------------------------------------------

def _word(i: Column) -> Column:
    return F.get("words", i)


def _windows_differ(i: Column, j: Column) -> Column:
    return (
        (_word(i) != _word(j)) | (_word(i + 1) != _word(j + 1)) | (_word(i + 2) != _word(j + 2))
    )


def _head(code: Column) -> Column:
    return F.shiftright(code, _PLACE_BITS)


def _place(code: Column) -> Column:
    return code.bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)).cast("int")


def _coded() -> Column:
    """Each window's hash with its place in the low bits: plain numbers, which sort fast."""
    last = F.size("words") - 3
    code = lambda i: (
        F.xxhash64(_word(i), _word(i + 1), _word(i + 2))
        .bitwiseAND(F.lit(-(1 << _PLACE_BITS))).bitwiseOR(i.cast("long"))
    )
    return F.when(last >= 0, F.sort_array(F.transform(F.sequence(F.lit(0), last), code))).otherwise(
        F.array().cast("array<bigint>")
    )


def _alike() -> Column:
    """The codes whose hash a neighbour in order shares."""
    at = lambda k: _head(F.get("codes", k))
    return F.filter(
        "codes", lambda code, k: (_head(code) == at(k - 1)) | (_head(code) == at(k + 1))
    )


def _collided() -> Column:
    """Whether windows of different words share a hash, or there are more than places for them."""
    before = lambda k: F.get("alike", k - 1)
    differ = F.transform("alike", lambda code, k: (
        (_head(code) == _head(before(k))) & _windows_differ(_place(code), _place(before(k)))
    ))
    return F.exists(differ, lambda d: d) | (F.size("words") > (1 << _PLACE_BITS))


def _sorted_windows() -> Column:
    """Windows with their places, in the order of their words."""
    return F.sort_array(F.transform(F.sequence(F.lit(0), F.size("words") - 3), lambda i: F.struct(
        _word(i).alias("a"), _word(i + 1).alias("b"), _word(i + 2).alias("c"), i.alias("i")
    )))


def _exactly_repeated() -> Column:
    """Places of windows that a neighbour in the order of words equals."""
    def same(window: Column, k: Column) -> Column:
        other = F.get("windows", k)
        return (window["a"] == other["a"]) & (window["b"] == other["b"]) & (window["c"] == other["c"])

    found = F.filter("windows", lambda window, k: same(window, k - 1) | same(window, k + 1))
    return F.transform(found, lambda window: window["i"])


def _covered(places: Column) -> Column:
    """How many words lie in three-word windows at ``places``."""
    start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("total"))
    return F.aggregate(
        F.sort_array(places),
        start,
        lambda seen, i: F.struct(
            (i + 3).alias("end"), (seen["total"] + i + 3 - F.greatest(i, seen["end"])).alias("total")
        ),
        lambda seen: seen["total"],
    )


def statistics(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
) -> DataFrame:
    """Counts per row, whether the base rules fail, the groups, and the vector; stored."""
    group = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("null"))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    read = docs.select(
        F.col(id_col).alias("doc_id"),
        group(lang_col).alias(_GROUP[0]),
        group(source_col).alias(_GROUP[1]),
        text.alias("text"),
    )
    cut = read.select(
        "doc_id", *_GROUP,
        F.array_remove(F.split("text", _NOT_WORD), "").alias("words"),
        (F.length("text") - F.length(F.translate("text", _SYMBOLS, ""))).alias("n_symbols"),
        F.filter(F.split("text", "\n"), lambda l: l.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    counts = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines"]
    repeated = F.when(F.col("windows").isNotNull(), _exactly_repeated()).otherwise(
        F.transform("alike", _place)
    )
    counted = cut.select(
        "doc_id", *_GROUP, "words",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.col("n_symbols").cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _coded().alias("codes"),
    ).select("doc_id", *_GROUP, *counts, "words", _alike().alias("alike")).select(
        "doc_id", *_GROUP, *counts, "alike", F.when(_collided(), _sorted_windows()).alias("windows")
    ).select(
        "doc_id", *_GROUP, *counts, _covered(repeated).cast("long").alias("n_repeat_words")
    )
    n, lines = F.greatest("n_words", F.lit(1)), F.greatest("n_lines", F.lit(1))
    failed = (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    vector = (
        F.ln(n), F.col("word_chars") / n, F.log1p(F.col("n_symbols") / n),
        F.col("n_dup_lines") / lines, F.col("n_repeat_words") / n,
    )
    return store(counted.select(
        "*", failed.alias("base_failed"), *[v.alias(x) for v, x in zip(vector, _X)]
    ))


# --- minimum covariance determinant ------------------------------------------------------------------

def _moments() -> list[Column]:
    """Sums that give mean and covariance: of 1, of x, and of x * y."""
    return [
        F.count(F.lit(1)).alias("n"),
        *[F.sum(x).alias(f"s{i}") for i, x in enumerate(_X)],
        *[F.sum(F.col(_X[i]) * F.col(_X[j])).alias(f"s{i}{j}") for i, j in _PAIRS],
    ]


def _estimates(sums: DataFrame, keys: Sequence[str], factor: float) -> DataFrame:
    """Centre ``m``, regularised scatter, its determinant, and its inverse ``p``, from moments."""
    n = F.col("n")
    weight = F.lit(PRIOR_DOCS) / (n + PRIOR_DOCS)
    scatter = []
    for i, j in _PAIRS:
        own = F.col(f"s{i}{j}") / n - F.col(f"s{i}") / n * F.col(f"s{j}") / n
        value = (1 - weight) * factor * own
        if i == j:
            # sums of equal values may leave a trace below zero
            value = (1 - weight) * factor * F.greatest(own, F.lit(0.0))
            value = value + weight * PRIOR_SPREAD[i] ** 2 + LEAST_SPREAD[i] ** 2
        scatter.append(value.alias(f"p{i}{j}"))
    means = [(F.col(f"s{i}") / n).alias(f"m{i}") for i in range(_SIZE)]
    return _inverted(sums.select(*keys, *means, *scatter), keys)


def _inverted(table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Replace the symmetric matrix ``p`` by its inverse, by sweeping; add the log determinant."""
    means = [f"m{i}" for i in range(_SIZE)]
    at = lambda i, j: F.col(f"p{min(i, j)}{max(i, j)}")
    table = table.withColumn("log_det", F.lit(0.0))
    for k in range(_SIZE):
        pivot = at(k, k)
        swept = []
        for i, j in _PAIRS:
            if i == j == k:
                value = -1 / pivot
            elif k in (i, j):
                value = at(i, j) / pivot
            else:
                value = at(i, j) - at(i, k) * at(k, j) / pivot
            swept.append(value.alias(f"p{i}{j}"))
        table = table.select(
            *keys, *means, *swept, (F.col("log_det") + F.ln(pivot)).alias("log_det")
        )
    return table.select(
        *keys, *means, *[(-at(i, j)).alias(f"p{i}{j}") for i, j in _PAIRS], "log_det"
    )


def _distance() -> Column:
    """Squared Mahalanobis distance of the vector from ``m`` with the inverse scatter ``p``."""
    off = [F.col(x) - F.col(f"m{i}") for i, x in enumerate(_X)]
    terms = [
        F.col(f"p{i}{j}") * off[i] * off[j] * (1 if i == j else 2) for i, j in _PAIRS
    ]
    total = terms[0]
    for term in terms[1:]:
        total = total + term
    return total


def _medians(vectors: DataFrame) -> DataFrame:
    """Coordinate-wise medians per group, to a twentieth of the typical spread; stored."""
    cells = F.array(*[
        F.floor(F.col(x) / F.lit(spread / _MEDIAN_BINS)) for x, spread in zip(_X, PRIOR_SPREAD)
    ])
    counts = (
        vectors.select(*_GROUP, F.posexplode(cells).alias("i", "cell"))
        .groupBy(*_GROUP, "i", "cell").agg(F.count(F.lit(1)).alias("n"))
    )
    values = Window.partitionBy(*_GROUP, "i")
    so_far = F.sum("n").over(values.orderBy("cell"))
    middle = counts.select(
        "*", so_far.alias("so_far"), F.sum("n").over(values).alias("all")
    ).where(F.col("so_far") * 2 >= F.col("all"))
    spread = F.element_at(F.array(*[F.lit(s) for s in PRIOR_SPREAD]), F.col("i") + 1)
    value = (F.col("cell") + 0.5) * spread / _MEDIAN_BINS
    lowest = middle.groupBy(*_GROUP, "i").agg(F.min_by(value, "cell").alias("m"))
    return store(lowest.groupBy(*_GROUP).agg(*[
        F.max(F.when(F.col("i") == i, F.col("m"))).alias(f"m{i}") for i in range(_SIZE)
    ]))


def _starts(vectors: DataFrame) -> DataFrame:
    """Two first guesses per group, both around the medians; stored.

    Start 0 has the typical spreads, start 1 the covariance of the vectors after large deviations
    were damped by the hyperbolic tangent.
    """
    medians = _medians(vectors)
    damped = vectors.join(medians, _GROUP).select(*_GROUP, *[
        (F.tanh((F.col(x) - F.col(f"m{i}")) / (2 * s)) * (2 * s)).alias(x)
        for i, (x, s) in enumerate(zip(_X, PRIOR_SPREAD))
    ])
    spread = _estimates(damped.groupBy(*_GROUP).agg(*_moments()), _GROUP, 1.0)
    means = [f"m{i}" for i in range(_SIZE)]
    second = spread.drop(*means).join(medians, _GROUP).withColumn("start", F.lit(1))
    first = medians.select(
        "*", F.lit(0).alias("start"), F.lit(0.0).alias("log_det"),
        *[F.lit(1 / PRIOR_SPREAD[i] ** 2 if i == j else 0.0).alias(f"p{i}{j}") for i, j in _PAIRS],
    )
    return store(first.unionByName(second))


def _concentrate(vectors: DataFrame, estimates: DataFrame) -> DataFrame:
    """One concentration step for every group and start; stored."""
    keys = [*_GROUP, "start"]
    bin_ = F.floor(F.ln(_distance() + F.lit(1e-9)) * _BINS)
    sums = (
        vectors.join(estimates, _GROUP)
        .withColumn("bin", bin_).groupBy(*keys, "bin").agg(*_moments())
    )
    group = Window.partitionBy(*keys)
    before = group.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    nearest = sums.select(
        "*",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"),
        F.sum("n").over(group).alias("all"),
    ).where(F.col("before") < F.ceil(F.col("all") * SUBSET))
    names = ["n", *[f"s{i}" for i in range(_SIZE)], *[f"s{i}{j}" for i, j in _PAIRS]]
    subset = nearest.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in names])
    return store(_estimates(subset, keys, SUBSET_FACTOR))


def robust_estimates(vectors: DataFrame, steps: int = STEPS) -> DataFrame:
    """Centre and inverse scatter per group; stored. ``vectors`` has the groups and the vector."""
    found = _starts(vectors)
    for _ in range(steps):
        found = _concentrate(vectors, found)
    best = F.row_number().over(Window.partitionBy(*_GROUP).orderBy(F.round("log_det", 9), "start"))
    raw = store(found.withColumn("place", best).where(F.col("place") == 1).drop("place", "start"))
    near = vectors.join(raw, _GROUP).where(_distance() <= REWEIGHTED_WITHIN)
    reweighted = _estimates(near.groupBy(*_GROUP).agg(*_moments()), _GROUP, REWEIGHTED_FACTOR)
    return store(reweighted)


def quality(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    cutoff: float = CUTOFF,
) -> DataFrame:
    """One row per document: counts, ``base_failed``, ``distance`` and ``kept``.

    Documents that fail the base rules take no part in the estimates. Calling this runs jobs.
    """
    stats = statistics(docs, id_col, text_col, lang_col, source_col)
    estimates = robust_estimates(stats.where(~F.col("base_failed")).select(*_GROUP, *_X))
    distance = F.round(F.when(~F.col("base_failed"), _distance()), 6)
    judged = stats.join(estimates, _GROUP, "left").withColumn("distance", distance)
    kept = ~F.col("base_failed") & F.coalesce(F.col("distance") <= cutoff, F.lit(True))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", kept.alias("kept"), "distance",
    )
