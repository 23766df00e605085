"""Token counts: batch encoding in Arrow functions that return lengths only.

Nothing is shuffled: a task encodes the texts it reads. Texts are cut at safe places
(``segments``), so a very long one becomes many short pieces; pieces, whatever text they are from, form
batches of about equal bytes, and a piece that repeats is encoded once. Only lengths come back,
and add up per text. Where a tokenizer file allows no cuts, texts themselves are the pieces.

Nulls and edge cases: a null text counts as empty: no bytes, no tokens. Ids may be null or repeat; every
row has its own count. An empty table gives no rows. Only the id and the text are read, so other
columns, of whatever name, do not matter. A very long text without a safe place is one piece, and
held whole by one task.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playmetrics.llm.frames import give_back_memory
from playmetrics.llm.segments import (
    Memo, TokenizerFile, as_texts, cut_places, joined, load, pieces_of, read_tokenizer, runs,
)

# Bytes of text that are cut at once, and bytes in a batch that the tokenizer sees.
STEP_BYTES = 1 << 22
BATCH_BYTES = 1 << 18


class Counter:
    """Lengths of texts in tokens. Pieces lose the blank that they start with if the tokenizer puts one
    in front of every text; ``joined`` puts one there for it."""

    def __init__(self, file: TokenizerFile, specials_as_text: bool, batch_bytes: int):
        tokenizer = load(file, specials_as_text)
        self.cuts = tokenizer.cuts
        self.skip = int(tokenizer.cuts and tokenizer.drops_blank)
        self.memo = Memo(
            lambda pieces: list(map(len, tokenizer.ids(as_texts(pieces, self.skip)))), batch_bytes
        )

    def of(self, texts: pa.Array) -> np.ndarray:
        raw, edges = joined(texts, " " * self.skip)
        starts = cut_places(raw, edges) if self.cuts else edges[:-1][np.diff(edges) > 0]
        coded = pieces_of(raw, starts).dictionary_encode()
        lengths = np.array(self.memo.of(coded.dictionary.to_pylist()), np.int64)
        each = lengths[coded.indices.to_numpy()] if len(starts) else np.zeros(0, np.int64)
        total = np.concatenate(([0], np.cumsum(each)))
        return np.diff(total[np.searchsorted(starts, edges)])


@lru_cache(maxsize=1)
def _counter(file: TokenizerFile, specials_as_text: bool, batch_bytes: int) -> Counter:
    """Kept by a Python worker for its next tasks."""
    return Counter(file, specials_as_text, batch_bytes)


def count_tokens(
    docs: DataFrame,
    path: str,
    limit: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    specials_as_text: bool = False,
    batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` of every row, and with a ``limit`` also ``over_limit``.

    ``path`` names a ``.json`` file for ``tokenizers`` or a ``.model`` file for ``sentencepiece``. Texts get
    no begin, end or other special tokens, and are neither truncated nor padded. ``specials_as_text``
    makes strings of special tokens inside texts ordinary text; else the library's default holds.
    """
    narrow = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    file_of = docs.sparkSession.sparkContext.broadcast(read_tokenizer(path))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(file_of.value, specials_as_text, batch_bytes)
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).cast(pa.int64())
            counts = [
                counter.of(batch.column(1).slice(first, after - first))
                for first, after in runs(sizes.to_numpy(zero_copy_only=False), STEP_BYTES)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), sizes, pa.array(np.concatenate(counts or [np.zeros(0, np.int64)]))],
                names=["doc_id", "n_bytes", "n_tokens"],
            )
        give_back_memory()

    found = narrow.mapInArrow(run, T.StructType([
        T.StructField("doc_id", narrow.schema["doc_id"].dataType),
        T.StructField("n_bytes", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
    ]))
    if limit is None:
        return found
    return found.withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
