"""Language ID by rank-order profiles.

A profile lists the ``PROFILE`` most frequent n-grams of a language, n from 1 to 3, in order. A
document's own list is compared with every profile: each of its n-grams adds the distance between
its two ranks, or the largest distance if the profile lacks it. The language with the least total
wins. N-grams are taken from lower-cased words, runs of letters with a blank on either side.

Profiles are learned from a sample of about ``SAMPLE_DOCS`` labelled documents per language,
chosen by a hash of the id; documents are held out by another hash of it. The prediction reads the
text only. Counting happens in the tasks, and profiles are a stored table. Documents meet them in
turns: the driver sends ``LANGUAGES_AT_ONCE`` profiles to the tasks, and each document keeps its
nearest language so far, until all languages had their turn. There may be any number of them; the
time grows with it, the memory does not.

Nulls and edge cases: a null text, or one without a letter, is ``und`` with score 0, and so is
every text if nothing was learned. Ties go to the language first in code point order. A null id
counts as held out and is never learned from; null languages are not learned. Repeated rows count
repeatedly and get repeated verdicts. An empty table gives no rows. Only id, text and language are
read. A text is counted in pieces, so very long ones need little memory beside their own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from playmetrics.storage import store

PROFILE = 400
SAMPLE_DOCS = 3_000
# Languages that documents are compared with in one turn, and turns between two stored tables.
LANGUAGES_AT_ONCE = 1_000
TURNS = 8
HELD_OUT = 5
UNKNOWN = "und"
_BLANK = 0x20
# Bits of a character in an n-gram's number, and characters counted at once.
_BITS = 21
_PIECE = 1 << 20
# Counted texts that are summed at once.
_MERGE = 256

Grams = tuple[np.ndarray, np.ndarray]


@cache
def _letters() -> np.ndarray:
    """Whether a code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _sum(parts: Sequence[Grams]) -> Grams:
    counts = np.concatenate([c for _, c in parts])
    found, place = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
    return found, np.bincount(place, weights=counts, minlength=len(found)).astype(np.int64)


def _count_piece(points: np.ndarray) -> Grams:
    """N-grams of a blank-separated run of letters that starts and ends with a blank."""
    p = points.astype(np.int64)
    blank = p == _BLANK
    one = p[~blank]
    two = (p[:-1] << _BITS | p[1:])[~(blank[:-1] & blank[1:])]
    three = (p[:-2] << 2 * _BITS | p[1:-1] << _BITS | p[2:])[~blank[1:-1]]
    found = [np.unique(x, return_counts=True) for x in (one, two, three)]
    # a number tells n: no character is zero
    return np.concatenate([g for g, _ in found]), np.concatenate([c for _, c in found])


def count_grams(text: str | None) -> Grams:
    """The n-grams of a text as numbers, and how often each occurs."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), np.uint32)
    points = np.where(_letters()[points], points, _BLANK)
    points = np.concatenate(([_BLANK], points, [_BLANK]))
    points = points[np.concatenate(([True], (points[1:] != _BLANK) | (points[:-1] != _BLANK)))]
    if len(points) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    parts, start = [], 0
    while start < len(points) - 1:
        end = start + _PIECE
        blanks = np.flatnonzero(points[end:] == _BLANK)[:1] if end < len(points) else []
        end = end + int(blanks[0]) if len(blanks) else len(points) - 1
        parts.append(_count_piece(points[start:end + 1]))
        start = end
    return parts[0] if len(parts) == 1 else _sum(parts)


def ranking(grams: np.ndarray, counts: np.ndarray, length: int = PROFILE) -> np.ndarray:
    """The most frequent n-grams in order; equally frequent ones by number."""
    return grams[np.lexsort((grams, -counts))[:length]]


class Profiles:
    """Ranked n-grams of some languages, ready to be compared with documents.

    ``languages`` are in code point order. ``owners``, ``grams`` and ``places`` have an entry per n-gram of
    a profile: the number of its language, the n-gram, and its rank from 0.
    """

    def __init__(
        self, languages: Sequence[str], owners: np.ndarray, grams: np.ndarray, places: np.ndarray,
        length: int = PROFILE,
    ):
        order = np.argsort(grams, kind="stable")
        self.languages, self.length = list(languages), length
        self.owners, self.grams, self.places = owners[order], grams[order], places[order]

    def nearest(self, own: np.ndarray) -> tuple[str, float]:
        """The language nearest to a document's ranked n-grams, and 1 less the distance as a share
        of the largest possible."""
        if not len(own) or not self.languages:
            return UNKNOWN, 0.0
        first, end = (np.searchsorted(self.grams, own, side) for side in ("left", "right"))
        shared = end - first
        starts = np.cumsum(shared) - shared
        at = np.arange(shared.sum()) + np.repeat(first - starts, shared)
        # what a shared n-gram spares of the largest distance
        spared = self.length - np.abs(self.places[at] - np.repeat(np.arange(len(own)), shared))
        spared = np.bincount(self.owners[at], weights=spared, minlength=len(self.languages))
        best = int(spared.argmax())
        largest = self.length * len(own)
        return self.languages[best], 1 - (largest - int(spared[best])) / largest


def held_out(doc_id: Column, folds: int = HELD_OUT) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(True))


def learn(
    labelled: DataFrame, sample_docs: int = SAMPLE_DOCS, length: int = PROFILE
) -> DataFrame:
    """Profiles of the languages in ``labelled`` (``doc_id, text, lang``), stored: ``lang, gram,
    place``, a row per n-gram, places from 0. Runs jobs that store them and the languages' totals."""
    known = labelled.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    # read from a file, so that Spark knows the size and sends the table around only if it is small
    totals = store(known.groupBy("lang").agg(F.count(F.lit(1)).alias("total")))
    share = F.least(F.lit(1.0), F.lit(float(sample_docs)) / F.col("total"))
    chance = F.pmod(F.xxhash64("doc_id", F.lit("profile")), F.lit(1 << 30))
    sample = known.join(totals, "lang").where(chance < F.floor(share * (1 << 30))).select("lang", "text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counted: dict[str, list[Grams]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                parts = counted.setdefault(lang, [])
                parts.append(count_grams(text.as_py()))
                if len(parts) >= _MERGE:
                    counted[lang] = [_sum(parts)]
            for lang, parts in counted.items():
                grams, counts = _sum(parts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(grams), pa.string()), pa.array(grams), pa.array(counts)],
                    names=["lang", "gram", "n"],
                )

    counts = (
        sample.mapInArrow(run, "lang string, gram long, n long")
        .groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    )
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    top = counts.withColumn("place", place - 1).where(F.col("place") < length)
    return store(top.select("lang", "gram", "place"))


def _turns(profiles: DataFrame, length: int) -> Iterator[Profiles]:
    """The profiles, ``LANGUAGES_AT_ONCE`` at a time, in code point order; one without any if there
    are none."""
    names = profiles.where(F.col("place") == 0).select("lang")
    last = None
    while True:
        left = names if last is None else names.where(F.col("lang") > last)
        turn = [r["lang"] for r in left.orderBy("lang").limit(LANGUAGES_AT_ONCE).collect()]
        if not turn and last is not None:
            return
        rows = (
            profiles.where(F.col("lang").between(turn[0], turn[-1])) if turn else profiles.limit(0)
        ).toArrow()
        number = {lang: i for i, lang in enumerate(turn)}
        owners = np.array([number[lang] for lang in rows["lang"].to_pylist()], np.int64)
        yield Profiles(turn, owners, rows["gram"].to_numpy(), rows["place"].to_numpy(), length)
        if len(turn) < LANGUAGES_AT_ONCE:
            return
        last = turn[-1]


def _first_turn(profiles_of, length: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Texts become their ranked n-grams, with the nearest language of the first turn."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profiles = profiles_of.value
        for batch in batches:
            own = [ranking(*count_grams(t.as_py()), length) for t in batch.column(1)]
            found = [profiles.nearest(grams) for grams in own]
            yield _judged(batch.column(0), own, found)
    return run


def _later_turn(profiles_of) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A language of this turn takes the place of the one before if it is nearer."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profiles = profiles_of.value
        for batch in batches:
            own = [np.frombuffer(grams, np.int64) for grams in batch.column(3).to_pylist()]
            before = zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())
            # languages of earlier turns come first in code point order, so ties leave them
            found = [max(old, profiles.nearest(grams), key=lambda f: f[1]) for old, grams in zip(before, own)]
            yield _judged(batch.column(0), own, found)
    return run


def _judged(ids: pa.Array, own: Sequence[np.ndarray], found: Sequence[tuple[str, float]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([
        ids,
        pa.array([lang for lang, _ in found], pa.string()),
        pa.array([score for _, score in found], pa.float64()),
        pa.array([grams.tobytes() for grams in own], pa.binary()),
    ], names=["doc_id", "lang_pred", "score", "own"])


def identify(
    docs: DataFrame,
    profiles: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = PROFILE,
) -> DataFrame:
    """``doc_id, lang_pred, score`` for every row, from its text and nothing else.

    ``profiles`` come from ``learn``. Runs two small jobs per turn of languages; after ``TURNS`` turns the
    documents' ranked n-grams are stored, so that no task chains more turns than that.
    """
    found = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([
        T.StructField("doc_id", found.schema["doc_id"].dataType),
        T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("own", T.BinaryType()),
    ])
    for turn, some in enumerate(_turns(profiles, length)):
        if turn and turn % TURNS == 0:
            found = store(found)
        sent = docs.sparkSession.sparkContext.broadcast(some)
        found = found.mapInArrow(_later_turn(sent) if turn else _first_turn(sent, length), schema)
    return found.select("doc_id", "lang_pred", "score")


def language_id(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """One row per document: ``doc_id, held_out, lang_pred, score``. Runs the jobs of
    ``learn`` and ``identify``."""
    labelled = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"),
        F.col(lang_col).cast("string").alias("lang"),
    ).where(~held_out(F.col("doc_id")))
    found = identify(docs, learn(labelled), id_col, text_col)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
