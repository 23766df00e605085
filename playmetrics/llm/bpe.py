"""Byte-level BPE by a global distinct-word shuffle.

Documents are cut into pre-tokens. A block is a run of documents of one task; its distinct words
are numbered, so that a document becomes a sequence of word numbers, its pre-tokens by position.
Two things are shuffled: the blocks' distinct words, by a hash of the word, so that each word is
encoded in one place once; and the sequences, by block, where the word's ids come back and documents
are put together by position. A row holds many words or numbers, packed, since rows of single
words would take more room than the text. Texts are never shuffled, and the words are never
gathered: they are dealt to as many places as Spark has shuffle partitions, and to ``BUCKETS`` at
least; each task remembers the last ``KNOWN_WORDS``. Decoding joins ids with
the token-byte table, which has one row per token of the fixed vocabulary.

Blocks are formed twice, for words and for sequences. A block's key is a digest of the partition it
lies in, its number there, and its words in order, so blocks of the same words stay apart and no task
gets more than its share of them. If a task that is run again saw its rows in another order, numbers
would not fit; the digest then finds no partner and the job fails instead of giving wrong ids.

Letters, numbers and white space are what the tokenizer library's own pattern engine takes for them.

Nulls and edge cases: a null text counts as empty and has no tokens. Ids may repeat or be null. An
empty table gives no rows. Only the id and the text are read. A text is held whole by one task,
and so is a pre-token, which is encoded in time n log n.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import zlib
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playmetrics.llm.frames import give_back_memory

# Bytes of text that are cut at once, and bytes in a block.
STEP_BYTES = 1 << 18
BLOCK_BYTES = 1 << 23
# Least number of places that words are dealt to, and encoded words that a task remembers; beyond
# that, a word may be encoded again.
BUCKETS = 512
KNOWN_WORDS = 1 << 20
# Bytes of ids in one batch of results.
_OUT_BYTES = 1 << 20
# Words up to this length are merged by plain search, longer ones with a heap.
_SHORT = 32

_OTHER, _LETTER, _NUMBER, _SPACE = range(4)
_CLASSES = {r"\p{L}": _LETTER, r"\p{N}": _NUMBER, r"\s": _SPACE}
# The endings that the pattern cuts off after an apostrophe.
_ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ids of a vocabulary in ``base64 id`` lines. It is small and fixed."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


# --- pre-tokens ---------------------------------------------------------------------------------

@cache
def _classes() -> np.ndarray:
    """The class of every code point, as the library's patterns see it."""
    kind = np.full(0x110000, _OTHER, np.uint8)
    every = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
    bytes_alone = {bytes([b]): b for b in range(256)}
    for pattern, known in _CLASSES.items():
        # text that the pattern does not match has no ids
        matching = tiktoken.Encoding(
            "class", pat_str=pattern, mergeable_ranks=bytes_alone, special_tokens={}
        )
        found = bytes(matching.encode_ordinary(every)).decode("utf-8")
        kind[np.frombuffer(found.encode("utf-32-le"), np.uint32)] = known
    return kind


def token_starts(points: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """Where pre-tokens start in texts that lie end to end.

    ``points`` are the code points, ``heads`` the positions where a text starts. A pre-token is an
    apostrophe with one of the endings; or a run of letters, of numbers, or of other characters
    that are not white space, with one blank before it if there is one; or a run of white
    space, whose last character is apart if more text follows.
    """
    n = len(points)
    kind = _classes()[points]
    head = np.zeros(n + 1, bool)
    head[heads] = True
    head[n] = True
    last = head[1:]
    head = head[:n]
    changed = np.ones(n, bool)
    changed[1:] = kind[1:] != kind[:-1]
    changed |= head
    space = kind == _SPACE
    after_blank = np.zeros(n, bool)
    after_blank[1:] = points[:-1] == 0x20
    after_blank &= ~head
    followed = np.zeros(n, bool)
    followed[:-1] = ~space[1:]
    followed &= ~last
    start = np.where(space, changed | followed, changed & ~after_blank)
    for i in np.flatnonzero((points == 0x27) & start).tolist():
        for ending in _ENDINGS:
            j = i + 1 + len(ending)
            if j <= n and not head[i + 1:j].any() and all(
                points[i + 1 + k] == ord(c) for k, c in enumerate(ending)
            ):
                start[i + 1:j] = False
                if j < n:
                    start[j] = True
                break
    return np.flatnonzero(start)


def pre_tokens(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The pre-tokens of texts as bytes, and how many each text has."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if not len(texts):
        return pa.array([], pa.large_binary()), np.zeros(0, np.int64)
    edges = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = memoryview(data)[edges[0]:edges[-1]] if data is not None else memoryview(b"")
    edges = edges - edges[0]
    points = np.frombuffer(str(raw, "utf-8").encode("utf-32-le"), np.uint32)
    if len(points) == len(raw):
        place, heads = np.arange(len(points) + 1), edges
    else:
        width = 1 + (points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF)
        place = np.concatenate(([0], np.cumsum(width)))
        heads = np.searchsorted(place, edges)
    starts = token_starts(points, heads[:-1][heads[:-1] < len(points)])
    offsets = np.append(place[starts], len(raw)).astype(np.int64)
    tokens = pa.Array.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(bytes(raw))]
    )
    return tokens, np.diff(np.searchsorted(starts, heads))


def _pieces(texts: pa.Array, step_bytes: int) -> Iterator[pa.Array]:
    """Cut an array into runs of texts of about ``step_bytes``."""
    lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    step = np.cumsum(lengths) // step_bytes
    for at in np.split(np.arange(len(texts)), np.flatnonzero(np.diff(step)) + 1):
        if len(at):
            yield texts.slice(at[0], len(at))


class Block:
    """Distinct words of a run of documents, and the documents as numbers of words.

    ``place`` says where the run lies: its partition, and its number there.
    """

    def __init__(self, place: tuple[int, int] = (0, 0)):
        self.place = place
        self.size = 0
        self.ids: list[pa.Array] = []
        self.words: list[pa.Array] = []
        self.counts: list[np.ndarray] = []

    def add(self, ids: pa.Array, texts: pa.Array) -> None:
        tokens, counts = pre_tokens(texts)
        self.ids.append(ids)
        self.words.append(tokens.dictionary_encode())
        self.counts.append(counts)
        self.size += len(tokens.buffers()[2] or b"")

    def close(self) -> tuple[int, pa.Array, list[np.ndarray]]:
        """Digest of place and words, distinct words, and the word numbers of each piece."""
        chunks = pa.chunked_array(self.words).unify_dictionaries()
        words = chunks.chunk(0).dictionary
        digest = hashlib.blake2b(np.array(self.place, "<i8").tobytes(), digest_size=8)
        for buffer in words.buffers()[1:]:
            digest.update(memoryview(buffer or b""))
        block = int.from_bytes(digest.digest(), "little", signed=True)
        numbers = [c.indices.to_numpy().astype(np.uint32) for c in chunks.chunks]
        return block, words, numbers


def _blocks(
    batches: Iterable[pa.RecordBatch], step_bytes: int, block_bytes: int
) -> Iterator[Block]:
    context = TaskContext.get()
    partition = context.partitionId() if context is not None else 0
    block = Block((partition, 0))
    for batch in batches:
        done = 0
        for texts in _pieces(batch.column(1), step_bytes):
            block.add(batch.column(0).slice(done, len(texts)), texts)
            done += len(texts)
            if block.size >= block_bytes:
                yield block
                block = Block((partition, block.place[1] + 1))
                give_back_memory()
    if block.ids:
        yield block
    give_back_memory()


def _packed(numbers: np.ndarray) -> bytes:
    """Numbers below 2^32 in bytes of equal weight, which compress well if the numbers are small."""
    if not len(numbers):
        return b""
    planes = np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unpacked(data: bytes, count: int) -> np.ndarray:
    if not count:
        return np.zeros(0, np.uint32)
    planes = np.frombuffer(pa.decompress(data, 4 * count, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, count).T).view("<u4")[:, 0]


def _joined(data: list[bytes] | bytes, lengths: np.ndarray) -> pa.Array:
    """Byte strings of the given lengths that lie end to end."""
    edges = np.concatenate(([0], np.cumsum(lengths, dtype=np.int64)))
    whole = data if isinstance(data, bytes) else b"".join(data)
    return pa.Array.from_buffers(
        pa.large_binary(), len(lengths), [None, pa.py_buffer(edges), pa.py_buffer(whole)]
    )


def _content(strings: pa.Array) -> memoryview:
    """The bytes of a fresh array of byte strings, end to end."""
    if not len(strings):
        return memoryview(b"")
    edges = np.frombuffer(strings.buffers()[1], np.int64)
    return memoryview(strings.buffers()[2])[edges[0]:edges[len(strings)]]


def _places(strings: pa.Array) -> np.ndarray:
    """Where byte strings start in their buffer, and where the last one ends."""
    if not len(strings):
        return np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_binary(strings.type) else np.int32
    places = np.frombuffer(strings.buffers()[1], kind)
    return places[strings.offset:strings.offset + len(strings) + 1].astype(np.int64)


def _cut(strings: pa.Array, places: np.ndarray) -> pa.Array:
    """The buffer of ``strings`` cut at other places."""
    data = strings.buffers()[2] if len(strings) else None
    data = pa.py_buffer(b"") if data is None else data.slice(places[0], places[-1] - places[0])
    edges = (places - places[0]).astype(np.int32)
    return pa.Array.from_buffers(
        pa.binary(), len(edges) - 1, [None, pa.py_buffer(edges), data]
    )


_WORDS = "bucket int, block long, count int, numbers binary, lengths binary, size long, words binary"


def _dealer(places: int, step_bytes: int, block_bytes: int):
    """Deals the words of blocks to ``places``."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row per block and bucket: the numbers of the words there, as steps, and the words."""
        for block in _blocks(batches, step_bytes, block_bytes):
            key, words, _ = block.close()
            at = np.fromiter((zlib.crc32(w) for w in words.to_pylist()), np.int64, len(words))
            at %= places
            order = np.argsort(at, kind="stable")
            rows = {name: [] for name in ("bucket", "block", "count", "numbers", "lengths", "size",
                                          "words")}
            for own in np.split(order, np.flatnonzero(np.diff(at[order])) + 1):
                if not len(own):
                    continue
                mine = words.take(pa.array(own))
                content = _content(mine)
                rows["bucket"].append(at[own[0]])
                rows["block"].append(key)
                rows["count"].append(len(own))
                rows["numbers"].append(_packed(np.diff(own, prepend=0)))
                rows["lengths"].append(_packed(pc.binary_length(mine).to_numpy()))
                rows["size"].append(len(content))
                rows["words"].append(pa.compress(content, codec="zstd", asbytes=True))
            yield pa.RecordBatch.from_pydict(rows, schema=pa.schema([
                ("bucket", pa.int32()), ("block", pa.int64()), ("count", pa.int32()),
                ("numbers", pa.binary()), ("lengths", pa.binary()), ("size", pa.int64()),
                ("words", pa.binary()),
            ]))
    return run


def _sequencer(step_bytes: int, block_bytes: int):
    """Turns documents into the word numbers of their blocks."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row per piece of a block: its documents, their lengths, and all word numbers in order."""
        for block in _blocks(batches, step_bytes, block_bytes):
            key, _, numbers = block.close()
            for ids, counts, numbered in zip(block.ids, block.counts, numbers):
                yield pa.RecordBatch.from_arrays([
                    pa.array([key], pa.int64()),
                    pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                    pa.array([_packed(counts)], pa.binary()),
                    pa.array([len(numbered)], pa.int64()),
                    pa.array([_packed(numbered)], pa.binary()),
                ], names=["block", "doc_ids", "counts", "size", "sequence"])
    return run


# --- encoding -----------------------------------------------------------------------------------

def encode_word(word: bytes, ranks: Mapping[bytes, int]) -> list[int]:
    """Ids of one pre-token: the pair of the lowest rank is merged first, the leftmost of equals."""
    if word in ranks:
        return [ranks[word]]
    if len(word) > _SHORT:
        return _encode_long(word, ranks)
    parts = [word[i:i + 1] for i in range(len(word))]
    pairs = [ranks.get(word[i:i + 2]) for i in range(len(word) - 1)]
    while True:
        best = min((r for r in pairs if r is not None), default=None)
        if best is None:
            return [ranks[p] for p in parts]
        i = pairs.index(best)
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
        del pairs[i]
        if i < len(pairs):
            pairs[i] = ranks.get(parts[i] + parts[i + 1])
        if i:
            pairs[i - 1] = ranks.get(parts[i - 1] + parts[i])


def _encode_long(word: bytes, ranks: Mapping[bytes, int]) -> list[int]:
    """The same with a heap of pairs over a linked list of parts."""
    n = len(word)
    end = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    alive = [True] * n
    heap: list[tuple[int, int, int]] = []

    def push(i: int) -> None:
        if i >= 0 and end[i] < n:
            after = end[end[i]]
            rank = ranks.get(word[i:after])
            if rank is not None:
                heapq.heappush(heap, (rank, i, after))

    for i in range(n):
        push(i)
    while heap:
        _, i, after = heapq.heappop(heap)
        if not alive[i] or end[i] >= n or end[end[i]] != after:
            continue
        alive[end[i]] = False
        end[i] = after
        if after < n:
            before[after] = i
        push(before[i])
        push(i)
    ids, i = [], 0
    while i < n:
        ids.append(ranks[word[i:end[i]]])
        i = end[i]
    return ids


_WORD_IDS = "block long, count int, numbers binary, lengths binary, size long, ids binary"


def _encoder(ranks_of):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Encode each distinct word once; its ids go back to every block that has it."""
        ranks = ranks_of.value
        known: dict[bytes, bytes] = {}

        def encoded(word: bytes) -> bytes:
            ids = known.get(word)
            if ids is None:
                if len(known) >= KNOWN_WORDS:
                    known.clear()
                    give_back_memory()
                ids = known[word] = np.array(encode_word(word, ranks), "<u4").tobytes()
            return ids

        for batch in batches:
            lengths, sizes, packed = [], [], []
            for row in batch.to_pylist():
                content = pa.decompress(row["words"], row["size"], codec="zstd", asbytes=True)
                words = _joined(content, _unpacked(row["lengths"], row["count"]))
                ids = [encoded(w) for w in words.to_pylist()]
                counts = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
                lengths.append(_packed(counts))
                sizes.append(counts.sum())
                packed.append(_packed(np.frombuffer(b"".join(ids), "<u4")))
            yield pa.RecordBatch.from_arrays([
                batch.column("block"), batch.column("count"), batch.column("numbers"),
                pa.array(lengths, pa.binary()), pa.array(sizes, pa.int64()),
                pa.array(packed, pa.binary()),
            ], names=["block", "count", "numbers", "lengths", "size", "ids"])
    return run


def _word_ids(dictionary: pa.Table) -> pa.Array:
    """The ids of a block's words, as bytes, by word number."""
    numbers, lengths, ids = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], []
    for row in dictionary.to_pylist():
        numbers.append(np.cumsum(_unpacked(row["numbers"], row["count"]), dtype=np.int64))
        lengths.append(_unpacked(row["lengths"], row["count"]).astype(np.int64) * 4)
        ids.append(_unpacked(row["ids"], row["size"]).tobytes())
    numbers = np.concatenate(numbers)
    at = np.argsort(numbers)
    if not np.array_equal(numbers[at], np.arange(len(at))):
        raise RuntimeError("words of a block are missing: its rows came in another order")
    return _joined(ids, np.concatenate(lengths)).take(pa.array(at))


def _assemble(dictionary: pa.Table, sequences: pa.Table) -> Iterator[pa.RecordBatch]:
    """Documents of a block as ids, in batches of moderate size."""
    if not sequences.num_rows:
        raise RuntimeError("a block has words but no documents: its rows came in another order")
    word_ids = _word_ids(dictionary.select(["count", "numbers", "lengths", "size", "ids"]))
    for row in range(sequences.num_rows):
        size = sequences.column("size")[row].as_py()
        doc_ids = sequences.column("doc_ids")[row].values
        counts = _unpacked(sequences.column("counts")[row].as_py(), len(doc_ids))
        numbers = _unpacked(sequences.column("sequence")[row].as_py(), size)
        if size and numbers.max() >= len(word_ids):
            raise RuntimeError("a block has no such word: its rows came in another order")
        edges = np.concatenate(([0], np.cumsum(counts, dtype=np.int64)))
        coded = word_ids.take(pa.array(numbers))
        place = _places(coded)[edges]
        cuts = np.flatnonzero(np.diff((place[:-1] - place[0]) // _OUT_BYTES)) + 1
        for own in np.split(np.arange(len(doc_ids)), cuts):
            ids = _cut(coded, place[own[0]:own[-1] + 2])
            yield pa.RecordBatch.from_arrays([
                doc_ids.slice(own[0], len(own)),
                pa.array(np.diff(place[own[0]:own[-1] + 2]) // 4, pa.int64()),
                ids,
            ], names=["doc_id", "n_tokens", "ids"])


def _token_table(ranks: Mapping[bytes, int]) -> list[bytes]:
    """The bytes of each token, by id."""
    tokens = sorted(ranks, key=ranks.get)
    if [ranks[t] for t in tokens] != list(range(len(tokens))):
        raise ValueError("ids must be 0, 1, 2, ... without gaps")
    return tokens


def _with_decoded(batch: pa.RecordBatch, tokens: pa.Array) -> pa.RecordBatch:
    """Join the ids of each row with the token-byte table."""
    ids = batch.column("ids")
    place = _places(ids)
    raw = b"".join(ids.drop_null().to_pylist())
    found = tokens.take(pa.array(np.frombuffer(raw, "<u4")))
    texts = _cut(found, _places(found)[(place - place[0]) // 4])
    return pa.RecordBatch.from_arrays(
        [*batch.columns, texts], names=[*batch.schema.names, "decoded"]
    )


def _word_places(spark: SparkSession) -> int:
    """How many places words are dealt to: one per shuffle partition, ``BUCKETS`` at least."""
    return max(BUCKETS, int(spark.conf.get("spark.sql.shuffle.partitions")))


def _narrow(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )


def encode(
    docs: DataFrame,
    ranks: Mapping[bytes, int],
    id_col: str = "doc_id",
    text_col: str = "text",
    with_decoded: bool = False,
    finish: Callable[[pa.RecordBatch], pa.RecordBatch] | None = None,
    fields: Sequence[T.StructField] = (),
) -> DataFrame:
    """``doc_id, n_tokens, ids`` of every row; ids are little-endian unsigned 32-bit numbers.

    ``with_decoded`` adds what ``decode`` would, in the tasks that have the ids at hand. ``finish`` may
    turn batches of these columns into others, ``doc_id`` and ``fields``, before they leave the task:
    ids and bytes are larger than the text, and whoever only needs a part saves moving them.
    """
    narrow = _narrow(docs, id_col, text_col)
    kind = narrow.schema["doc_id"].dataType
    context = docs.sparkSession.sparkContext
    ranks_of = context.broadcast(dict(ranks))
    tokens_of = context.broadcast(_token_table(ranks)) if with_decoded else None
    # tasks take the sizes from here, so that both sides cut the same blocks
    sizes = STEP_BYTES, BLOCK_BYTES
    words = narrow.mapInArrow(_dealer(_word_places(docs.sparkSession), *sizes), _WORDS)
    dictionaries = words.repartition("bucket").mapInArrow(_encoder(ranks_of), _WORD_IDS)
    sequences = narrow.mapInArrow(_sequencer(*sizes), T.StructType([
        T.StructField("block", T.LongType()),
        T.StructField("doc_ids", T.ArrayType(kind)),
        T.StructField("counts", T.BinaryType()),
        T.StructField("size", T.LongType()),
        T.StructField("sequence", T.BinaryType()),
    ]))

    def assemble(dictionary: pa.Table, sequences: pa.Table) -> pa.Table:
        tokens = pa.array(tokens_of.value, pa.large_binary()) if tokens_of is not None else None
        done = []
        for batch in _assemble(dictionary, sequences):
            if tokens is not None:
                batch = _with_decoded(batch, tokens)
            done.append(batch if finish is None else finish(batch))
        give_back_memory()
        return pa.Table.from_batches(done)

    if finish is None:
        fields = [
            T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType()),
            *[T.StructField("decoded", T.BinaryType())] * with_decoded,
        ]
    schema = T.StructType([T.StructField("doc_id", kind), *fields])
    return dictionaries.groupBy("block").cogroup(sequences.groupBy("block")).applyInArrow(
        assemble, schema
    )


def decode(encoded: DataFrame, ranks: Mapping[bytes, int]) -> DataFrame:
    """``encoded`` with ``decoded``, the bytes of its ``ids``."""
    tokens_of = encoded.sparkSession.sparkContext.broadcast(_token_table(ranks))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = pa.array(tokens_of.value, pa.large_binary())
        for batch in batches:
            yield _with_decoded(batch, tokens)

    schema = T.StructType([*encoded.schema.fields, T.StructField("decoded", T.BinaryType())])
    return encoded.mapInArrow(run, schema)
