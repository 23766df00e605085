"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes, and how often.

A task takes its documents in blocks. A block's texts are cut at safe places, each distinct piece is
encoded once by both tokenizers, and the ids come back as Arrow lists. From there on the work is
Arrow's: lists are flattened, with their parents' numbers; a segmented cumulative sum of token bytes
gives the places where tokens end; a hash join of both sides on (document, end) gives the places where both
end, which cut a document into groups; and every place where either ends closes one stretch that one
token of each side covers, which is one link. Links are counted per document and pair of ids by
``group_by``, and those counts added up per block.

The block's counts, not its links, are what Spark merges: a row per block and pair of ids. Once the corpus-wide
counts are known they are joined back to the blocks, and a block's documents, which hold the numbers of
their pairs, are put together with them. Blocks have a number of their own and bounded size, and
a pair that every block has is one row a block, in a join that Spark can split.

Nulls and edge cases: a text has no tokens, and zeros in all columns, if it is null or empty, or if the
tokens of either side joined are not a blank and the text: then there is nothing to align. Ids may be
null or repeat; every row has its own result. Ties for the highest count all count as highest. An
empty table gives no rows. Only the id and the text are read. A very long text is a block of its own, and
held whole by one task.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from playmetrics.llm.frames import give_back_memory
from playmetrics.llm.segments import (
    MARK, Loaded, Memo, TokenizerFile, as_texts, cut_places, joined, load, pieces_of, read_tokenizer, runs,
)
from playmetrics.storage import store

# Bytes of text in a block, and bits for the number of a task's block.
BLOCK_BYTES = 1 << 21
_BLOCK_BITS = 32
_MARKS = ("", ",", ";", "|")
_BYTE_TOKEN = re.compile("<0x([0-9A-F]{2})>")


def _visible() -> dict[str, int]:
    """How byte-level vocabularies write bytes: those that can be seen as themselves, the others as
    the characters from 256 on."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in seen]
    return {chr(b): b for b in seen} | {chr(256 + i): b for i, b in enumerate(hidden)}


def token_bytes(tokens: Sequence[str], byte_level: bool) -> list[bytes]:
    """What each token stands for in a text."""
    if byte_level:
        table = _visible()
        return [
            bytes(table[c] for c in token) if all(c in table for c in token) else token.encode("utf-8")
            for token in tokens
        ]
    return [
        bytes([int(own[1], 16)]) if (own := _BYTE_TOKEN.fullmatch(token))
        else token.replace(MARK, " ").encode("utf-8")
        for token in tokens
    ]


class Side:
    """What is known of one tokenizer's tokens."""

    def __init__(self, loaded: Loaded, byte_level: bool):
        contents = token_bytes(loaded.tokens, byte_level)
        self.bytes = pa.array(contents, pa.large_binary())
        self.sizes = np.array([len(c) for c in contents], np.int64)
        # each token's number as text, after each of the marks that can stand before it
        self.written = pa.array(
            [f"{mark}{i}" for mark in _MARKS for i in range(len(contents))], pa.large_string()
        )


class Sides:
    """Two tokenizers, the second of which puts a blank in front of a text, and what they make of pieces."""

    def __init__(self, first: TokenizerFile, second: TokenizerFile):
        a, b = load(first, specials_as_text=True), load(second)
        self.cuts = a.cuts and b.cuts
        self.both = Side(a, byte_level=True), Side(b, byte_level=False)
        self.written = pa.concat_arrays([side.written for side in self.both])
        pack = lambda ids: array("i", ids).tobytes()
        self.memo = Memo(lambda pieces: list(zip(
            map(pack, a.ids(as_texts(pieces))), map(pack, b.ids(as_texts(pieces, 1)))
        )))

    def lists(self, pieces: list[bytes]) -> list[pa.Array]:
        """For each side, the ids of each piece as one list."""
        lists = []
        for own in zip(*self.memo.of(pieces)) if pieces else ((), ()):
            counts = np.fromiter(map(len, own), np.int64, len(own)) // 4
            offsets = np.concatenate(([0], np.cumsum(counts)))
            flat = np.frombuffer(b"".join(own), np.int32)
            lists.append(pa.LargeListArray.from_arrays(pa.array(offsets), pa.array(flat)))
        return lists


@lru_cache(maxsize=1)
def sides_of(first: TokenizerFile, second: TokenizerFile) -> Sides:
    """Kept by a Python worker for its next tasks."""
    return Sides(first, second)


def _tokens(side: Side, lists: pa.Array, piece_doc: pa.Array, heads: np.ndarray) -> pa.Table:
    """Tokens in order: ``doc``, ``id`` and ``end``, the bytes of the document up to the token's end."""
    ids = pc.list_flatten(lists)
    doc = piece_doc.take(pc.list_parent_indices(lists))
    place = pc.cumulative_sum(pa.array(side.sizes[ids.to_numpy()]))
    # what earlier documents have is taken off, which makes the sum one per document
    first = np.searchsorted(doc.to_numpy(), np.arange(len(heads)))
    before = np.concatenate(([0], place.to_numpy()))[first]
    end = pc.subtract(place, pa.array(before[doc.to_numpy()]))
    return pa.table({"doc": doc, "id": ids, "end": end})


def _faithful(side: Side, tokens: pa.Table, raw: bytes, edges: np.ndarray) -> np.ndarray:
    """Whether a document's tokens joined are its bytes."""
    ids = tokens.column("id").combine_chunks()
    content = side.bytes.take(ids)
    data = content.buffers()[2]
    data = bytes(data) if data is not None else b""
    places = np.concatenate(([0], np.cumsum(side.sizes[ids.to_numpy()])))
    doc = tokens.column("doc").to_numpy()
    first = places[np.searchsorted(doc, np.arange(len(edges) - 1))]
    after = places[np.searchsorted(doc, np.arange(len(edges) - 1), "right")]
    return np.array([
        data[a:b] == raw[c:d] for a, b, c, d in zip(first, after, edges[:-1], edges[1:])
    ], bool)


def _ends(a: pa.Table, b: pa.Table) -> pa.Table:
    """Every place where a token of either side ends, in order: the token of each side that covers
    the bytes before it, and whether both end."""
    sides = [
        t.select(["doc", "end"]).append_column(name, pa.array(np.arange(t.num_rows)))
        for t, name in ((a, "a"), (b, "b"))
    ]
    found = sides[0].join(sides[1], ["doc", "end"], join_type="full outer", use_threads=False)
    found = found.take(pc.sort_indices(found, [("doc", "ascending"), ("end", "ascending")]))
    found = found.combine_chunks()
    both = pc.and_(pc.is_valid(found.column("a")), pc.is_valid(found.column("b")))
    covered = [pc.fill_null_backward(found.column(name)) for name in ("a", "b")]
    return pa.table({"doc": found.column("doc"), "a": covered[0], "b": covered[1], "both": both})


def _written(
    sides: Sides, ids: list[np.ndarray], docs: list[np.ndarray], groups: list[np.ndarray]
) -> tuple[bytes, np.ndarray, np.ndarray]:
    """All documents' groups as text; the places where tokens start in it, and their documents.

    ``groups`` number the groups through the block, so that a change is a new group.
    """
    (ids_a, ids_b), (docs_a, docs_b), (group_a, group_b) = ids, docs, groups
    if not len(ids_a):
        return b"", np.zeros(1, np.int64), np.zeros(0, np.int64)
    # a token comes after the tokens of its own side, and those of the other side in groups before
    at_a = np.arange(len(ids_a)) + np.searchsorted(group_b, group_a, "left")
    at_b = np.arange(len(ids_b)) + np.searchsorted(group_a, group_b, "right")
    marks = [np.full(len(own), _MARKS.index(",")) for own in ids]
    marks[0][np.diff(group_a, prepend=-1) != 0] = _MARKS.index(";")
    marks[0][np.diff(docs_a, prepend=-1) != 0] = _MARKS.index("")
    marks[1][np.diff(group_b, prepend=-1) != 0] = _MARKS.index("|")
    code = np.zeros(len(ids_a) + len(ids_b), np.int64)
    doc = np.zeros(len(code), np.int64)
    base = 0
    for side, own, at, mark, docs_of in zip(sides.both, ids, (at_a, at_b), marks, docs):
        code[at] = base + mark * len(side.sizes) + own
        doc[at] = docs_of
        base += len(side.written)
    text = sides.written.take(pa.array(code))
    places = np.frombuffer(text.buffers()[1], np.int64)[:len(code) + 1]
    data = text.buffers()[2]
    return (bytes(data) if data is not None else b""), places, doc


def _packed(numbers: np.ndarray) -> bytes:
    """Numbers below 2^32 as compressed bytes, those of equal weight side by side."""
    planes = np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True) if len(numbers) else b""


def _unpacked(data: bytes, count: int) -> np.ndarray:
    if not count:
        return np.zeros(0, np.int64)
    planes = np.frombuffer(pa.decompress(data, 4 * count, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, count).T).view("<u4")[:, 0].astype(np.int64)


def align(texts: pa.Array, sides: Sides) -> tuple[pa.Table, pa.Table]:
    """Per text its numbers, digest and pairs; and the block's pairs with their counts.

    A text's pairs are places in the second table, and how many links it has of each.
    """
    raw, edges = joined(texts, " ")
    n = len(texts)
    starts = cut_places(raw, edges) if sides.cuts else edges[:-1][np.diff(edges) > 0]
    coded = pieces_of(raw, starts).dictionary_encode()
    piece_doc = pa.array(np.searchsorted(edges, starts, "right") - 1)
    tokens = [
        _tokens(side, lists.take(coded.indices), piece_doc, edges[:-1])
        for side, lists in zip(sides.both, sides.lists(coded.dictionary.to_pylist()))
    ]
    good = np.diff(edges) > 0
    for side, own in zip(sides.both, tokens):
        good &= _faithful(side, own, raw, edges)
    if not good.all():
        keep = pa.array(good)
        tokens = [t.filter(keep.take(t.column("doc").combine_chunks())).combine_chunks() for t in tokens]
    a, b = tokens
    ends = _ends(a, b)
    doc = ends.column("doc").to_numpy()
    both = ends.column("both").to_numpy(zero_copy_only=False)
    ids = [t.column("id").to_numpy() for t in tokens]
    # the group of a place is the number of groups closed before it, through the whole block
    closed = np.cumsum(both) - both
    group = []
    for name, t in zip(("a", "b"), tokens):
        own = np.zeros(t.num_rows, np.int64)
        own[ends.column(name).to_numpy()] = closed
        group.append(own)
    docs_of = [t.column("doc").to_numpy() for t in tokens]
    text, places, token_doc = _written(sides, ids, docs_of, group)
    first = places[np.searchsorted(token_doc, np.arange(n))] if n else np.zeros(0, np.int64)
    after = places[np.searchsorted(token_doc, np.arange(n), "right")] if n else first
    digests = [
        hashlib.sha256(text[x:y]).hexdigest() if y > x else "" for x, y in zip(first, after)
    ]

    # links by pair of ids: per text, and from those for the block
    links = pa.table({
        "doc": ends.column("doc"),
        "a": pa.array(ids[0][ends.column("a").to_numpy()]),
        "b": pa.array(ids[1][ends.column("b").to_numpy()]),
    })
    each = links.group_by(["doc", "a", "b"], use_threads=False).aggregate([([], "count_all")])
    pairs = each.group_by(["a", "b"], use_threads=False).aggregate([("count_all", "sum")])
    pairs = pairs.sort_by([("b", "ascending"), ("a", "ascending")])
    known = pairs.column("b").to_numpy().astype(np.int64) << 32 | pairs.column("a").to_numpy()
    own = each.column("b").to_numpy().astype(np.int64) << 32 | each.column("a").to_numpy()
    number = np.searchsorted(known, own)
    order = np.lexsort((number, each.column("doc").to_numpy()))
    number, times = number[order], each.column("count_all").to_numpy()[order]
    cuts = np.searchsorted(each.column("doc").to_numpy()[order], np.arange(n + 1))
    count = lambda of: np.bincount(of, minlength=n)[:n]
    numbers = pa.table({
        "n_a": pa.array(count(docs_of[0])),
        "n_b": pa.array(count(docs_of[1])),
        "n_groups": pa.array(count(doc[both])),
        "n_links": pa.array(count(doc)),
        "groups_sha256": pa.array(digests, pa.string()),
        "n_pairs": pa.array(np.diff(cuts)),
        "pairs": pa.array([_packed(np.diff(number[x:y], prepend=0)) for x, y in zip(cuts, cuts[1:])], pa.binary()),
        "times": pa.array([_packed(times[x:y]) for x, y in zip(cuts, cuts[1:])], pa.binary()),
    })
    return numbers, pa.table({
        "a": pairs.column("a"), "b": pairs.column("b"), "links": pairs.column("count_all_sum"),
    })


_NUMBERS = ("n_a", "n_b", "n_groups", "n_links", "n_pairs")


def _block_rows(
    batches: Iterable[pa.RecordBatch], sides: Sides, block_bytes: int
) -> Iterator[pa.RecordBatch]:
    """A row per document, and one for each block with its pairs."""
    block = TaskContext.get().partitionId() << _BLOCK_BITS
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
        for first, after in runs(sizes.astype(np.int64), block_bytes):
            numbers, pairs = align(batch.column(1).slice(first, after - first), sides)
            n = after - first
            ids = batch.column(0).slice(first, n)
            lists = [pairs.column(c).combine_chunks() for c in ("a", "b", "links")]
            none = pa.nulls(n, pa.list_(pa.int64()))
            names = ["block", "doc_id", *_NUMBERS, "groups_sha256", "pairs", "times", "a", "b", "links"]
            yield pa.RecordBatch.from_arrays([
                pa.array([block] * n, pa.int64()), ids,
                *[numbers.column(c).cast(pa.int64()).combine_chunks() for c in _NUMBERS],
                *[numbers.column(c).combine_chunks() for c in ("groups_sha256", "pairs", "times")],
                none, none, none,
            ], names=names)
            yield pa.RecordBatch.from_arrays([
                pa.array([block], pa.int64()), pa.nulls(1, ids.type),
                *[pa.nulls(1, pa.int64()) for _ in _NUMBERS],
                pa.nulls(1, pa.string()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary()),
                *[pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), c.cast(pa.int64()))
                  for c in lists],
            ], names=names)
            block += 1
            give_back_memory()


def _finish(pairs: pa.Table, docs: pa.Table) -> pa.Table:
    """Documents of a block with the corpus-wide counts of their links."""
    count = np.zeros(pairs.num_rows, np.int64)
    best = np.zeros(pairs.num_rows, np.int64)
    number = pairs.column("number").to_numpy()
    count[number] = pairs.column("count").to_numpy()
    best[number] = pairs.column("best").to_numpy(zero_copy_only=False)
    sums, bests = [], []
    for size, own, times in zip(*[docs.column(c).to_pylist() for c in ("n_pairs", "pairs", "times")]):
        at, links = np.cumsum(_unpacked(own, size)), _unpacked(times, size)
        sums.append(int((count[at] * links).sum()))
        bests.append(int((best[at] * links).sum()))
    numbers = ["n_a", "n_b", "n_groups", "n_links"]
    return pa.table({
        "doc_id": docs.column("doc_id"), **{c: docs.column(c) for c in numbers},
        "n_best": pa.array(bests, pa.int64()), "count_sum": pa.array(sums, pa.int64()),
        "groups_sha256": docs.column("groups_sha256"),
    })


def aligned_blocks(
    docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Documents and block rows, stored: both tokenizers see a text only here."""
    if not path_a.endswith(".json") or not path_b.endswith(".model"):
        raise ValueError("the first tokenizer must be a .json file, the second a .model file")
    narrow = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    files = docs.sparkSession.sparkContext.broadcast((read_tokenizer(path_a), read_tokenizer(path_b)))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _block_rows(batches, sides_of(*files.value), block_bytes)

    numbers = [T.StructField(c, T.LongType()) for c in _NUMBERS]
    lists = [T.StructField(c, T.ArrayType(T.LongType())) for c in ("a", "b", "links")]
    return store(narrow.mapInArrow(run, T.StructType([
        T.StructField("block", T.LongType()),
        T.StructField("doc_id", narrow.schema["doc_id"].dataType),
        *numbers,
        T.StructField("groups_sha256", T.StringType()),
        T.StructField("pairs", T.BinaryType()),
        T.StructField("times", T.BinaryType()),
        *lists,
    ])))


def pair_counts(pairs: DataFrame) -> DataFrame:
    """``a, b, count, best`` of all pairs of ids that any block links; stored.

    ``best`` says that no other pair of this ``b`` has a higher count.
    """
    counts = pairs.groupBy("a", "b").agg(F.sum("links").alias("count"))
    most = F.max("count").over(Window.partitionBy("b"))
    return store(counts.withColumn("best", F.col("count") == most))


def align_documents(
    docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every row.

    ``path_a`` is a byte-level ``.json`` vocabulary, which encodes a blank and the text; ``path_b`` a
    ``.model`` file of ``sentencepiece`` that adds the blank itself. Strings of special tokens are plain
    text. ``n_links`` are the pairs of tokens that overlap, ``n_best`` those whose pair of ids has the
    highest count of its second id in the corpus, ``count_sum`` the sum of the counts over the links. Calling this runs
    jobs and stores the aligned documents, without their texts.
    """
    blocks = aligned_blocks(docs, path_a, path_b, id_col, text_col, block_bytes)
    pairs = blocks.where(F.col("a").isNotNull()).select(
        "block", F.posexplode(F.arrays_zip("a", "b", "links")).alias("number", "pair")
    ).select("block", "number", "pair.a", "pair.b", "pair.links")
    counts = pair_counts(pairs)
    counted = pairs.join(counts, ["a", "b"]).select("block", "number", "count", "best")
    kept = blocks.where(F.col("a").isNull()).select(
        F.col("block").alias("of"), "doc_id", *_NUMBERS, "groups_sha256", "pairs", "times"
    )
    kind = kept.schema["doc_id"].dataType
    return counted.groupBy("block").cogroup(kept.groupBy("of")).applyInArrow(
        _finish,
        T.StructType([
            T.StructField("doc_id", kind),
            *[T.StructField(c, T.LongType())
              for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")],
            T.StructField("groups_sha256", T.StringType()),
        ]),
    )
