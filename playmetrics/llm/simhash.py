"""SimHash near-dedup with bit-sliced comparison.

A fingerprint has a bit set if over half of the document's shingle hashes have it set. Two
fingerprints are linked if at most ``radius`` bits differ; components of links are the groups.

Finding links. The 64 bits are cut into ``radius + KEEP`` runs. Fingerprints within the radius agree
on at least ``KEEP`` whole runs, so each distinct fingerprint is dealt out once per choice of
``KEEP`` runs, keyed by the bits there. Among the fingerprints of a key the bits are stored
vertically: plane b holds bit b of 64 fingerprints in a word. A query is compared with all of them
at once by adding the differing planes into carry-save counters, and a block is given up as
soon as all its counters exceed the radius. Keys with more than ``BLOCK`` fingerprints are split
into parts, and pairs of parts are compared in separate tasks. A task returns a spanning forest of
the links it found, not the links themselves.

Copies share a fingerprint and are compared once. Nothing but the fingerprints is shuffled.

Nulls and edge cases: a null text counts as empty; without a word the fingerprint is zero. Texts
of fewer words than a shingle have their whole sequence as the only shingle. Ids may repeat or be
null; a null is no candidate for the smallest id of a group unless it has no other. An empty
table gives no rows. Only the id and the text are read. A text is held whole by one task.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playmetrics.llm.components import components
from playmetrics.llm.frames import give_back_memory, unused_name
from playmetrics.operators.skew import spread_join
from playmetrics.storage import store

SHINGLE = 4
RADIUS = 4
SEED = 42
BITS = 64
# Runs of bits that two near fingerprints must share to be compared. With 2 of 6 runs a key
# has 21 bits: some 500 fingerprints share it at a billion distinct ones. With 3 of 7 it has 27, and 35
# keys a fingerprint, which pays from there on; results are the same.
KEEP = 2
# Fingerprints compared in one piece.
BLOCK = 8192
# Words that one step of a comparison works on.
_STEP_WORDS = 1 << 15
_ONES = np.uint64(0xFFFFFFFFFFFFFFFF)


# --- fingerprints -----------------------------------------------------------------------------

def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint as a signed 64-bit number. Words are split at ASCII white space."""
    words = (text or "").encode("utf-8").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = ends[shingle - 1:] if len(words) > shingle else ends[-1:]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(joined[i:j], SEED) for i, j in zip(starts.tolist(), last.tolist())),
        np.uint64, len(last),
    )
    set_bits = np.zeros(BITS, np.int64)
    for piece in np.split(hashes, range(1 << 16, len(hashes), 1 << 16)):
        bits = np.unpackbits(piece.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_bits += bits.sum(axis=0, dtype=np.int64)
    chosen = np.packbits(2 * set_bits > len(hashes), bitorder="little")
    return int(chosen.view(np.int64)[0])


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE
) -> DataFrame:
    """``doc_id`` and ``fp`` of every row."""
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = (fingerprint(t.as_py(), shingle) for t in batch.column(1))
            fps = pa.array(np.fromiter(found, np.int64, batch.num_rows))
            yield pa.RecordBatch.from_arrays([batch.column(0), fps], names=["doc_id", "fp"])
        give_back_memory()

    schema = T.StructType([
        T.StructField("doc_id", narrow.schema["doc_id"].dataType),
        T.StructField("fp", T.LongType()),
    ])
    return narrow.mapInArrow(run, schema)


def as_hex(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


# --- bit-sliced comparison ----------------------------------------------------------------------

def bit_planes(fps: np.ndarray) -> np.ndarray:
    """(rows, lanes) fingerprints, lanes a multiple of 64, as (64, rows, words) planes."""
    rows, lanes = fps.shape
    bits = np.unpackbits(
        np.ascontiguousarray(fps).view(np.uint8).reshape(rows, lanes, 8), axis=2, bitorder="little"
    )
    packed = np.packbits(np.ascontiguousarray(bits.transpose(2, 0, 1)), axis=2, bitorder="little")
    return packed.view(np.uint64)


def _exceeds(counters: list[np.ndarray], over: np.ndarray, radius: int) -> np.ndarray:
    """Lanes whose counter is larger than ``radius``, compared from the highest plane down."""
    larger, equal = over.copy(), ~over
    for k in reversed(range(len(counters))):
        if radius >> k & 1:
            equal &= counters[k]
        else:
            larger |= equal & counters[k]
            equal &= ~counters[k]
    return larger


def near(
    queries: np.ndarray, planes: np.ndarray, padding: np.ndarray, radius: int, mask: int
) -> np.ndarray | None:
    """Which lanes are within ``radius`` of which query, as (rows, queries, words) bits.

    ``queries`` is (rows, queries); ``padding`` (rows, words) marks lanes that hold nothing; the bits
    in ``mask`` are known to agree. None if the block was given up.
    """
    shape = (*queries.shape, planes.shape[2])
    over = np.broadcast_to(padding[:, None, :], shape).copy()
    counters = [np.zeros(shape, np.uint64) for _ in range(max(radius.bit_length(), 2))]

    def add(plane: np.ndarray, k: int) -> None:
        for counter in counters[k:]:
            carry = counter & plane
            counter ^= plane
            plane = carry
        np.bitwise_or(over, plane, out=over)

    def differing(b: int) -> np.ndarray:
        query = (queries >> np.uint64(b) & np.uint64(1)) * _ONES
        return planes[b][:, None, :] ^ query[:, :, None]

    bits = [b for b in range(BITS) if not mask >> b & 1]
    for done, at in enumerate(range(0, len(bits), 3), 1):
        three = [differing(b) for b in bits[at:at + 3]]
        if len(three) == 3:
            # carry-save: three planes of weight 1 become one of weight 1 and one of weight 2
            x, y, z = three
            half = x ^ y
            add(half ^ z, 0)
            add((x & y) | (half & z), 1)
        else:
            for plane in three:
                add(plane, 0)
        if done % 3 == 0 and (_exceeds(counters, over, radius) == _ONES).all():
            return None
    return ~_exceeds(counters, over, radius)


def _hits(
    queries: np.ndarray, lanes: np.ndarray, held: np.ndarray, radius: int, mask: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row, query, lane) of near ones. ``held``: how many lanes of each row hold something."""
    rows, width = lanes.shape
    planes = bit_planes(lanes)
    empty = np.arange(width)[None, :] >= held[:, None]
    padding = np.packbits(empty, axis=1, bitorder="little").view(np.uint64)
    step = max(1, _STEP_WORDS // (rows * (width // 64)))
    for at in range(0, queries.shape[1], step):
        found = near(queries[:, at:at + step], planes, padding, radius, mask)
        if found is not None:
            bits = np.unpackbits(found.view(np.uint8), axis=2, bitorder="little")
            row, query, lane = np.nonzero(bits)
            yield row, query + at, lane


class Forest:
    """Disjoint sets of 0..n-1, united in bulk; the least member is the root."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def find(self, x: np.ndarray) -> np.ndarray:
        x = self.up[x]
        while not np.array_equal(higher := self.up[x], x):
            x = higher
        return x

    def unite(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.find(a), self.find(b)
            apart = a != b
            a, b = a[apart], b[apart]
            np.minimum.at(self.up, np.maximum(a, b), np.minimum(a, b))


def _padded(fps: np.ndarray, starts: np.ndarray, sizes: np.ndarray, width: int) -> np.ndarray:
    at = np.arange(width)[None, :]
    index = np.minimum(starts[:, None] + at, len(fps) - 1)
    return np.where(at < sizes[:, None], fps[index], np.uint64(0))


def _link_runs(table: pa.Table, masks: list[int], radius: int) -> pa.RecordBatch:
    """Spanning forest of the links inside each run of equal (choice, key, low, high)."""
    columns = [table.column(c).to_numpy() for c in ("choice", "key", "low", "high", "part")]
    fps = table.column("fp").to_numpy().view(np.uint64)
    n = len(fps)
    new = np.ones(n, bool)
    new[1:] = np.any([c[1:] != c[:-1] for c in columns[:4]], axis=0)
    starts = np.flatnonzero(new)
    sizes = np.diff(np.append(starts, n))
    choice, _, low, high, part = columns
    forest = Forest(n)
    small = (sizes > 1) & (sizes <= 64) & (low[starts] == high[starts])
    for c, mask in enumerate(masks):
        own = np.flatnonzero(small & (choice[starts] == c))
        own = own[np.argsort(sizes[own], kind="stable")]
        for at in range(0, len(own), 1024):
            tile = own[at:at + 1024]
            lanes = _padded(fps, starts[tile], sizes[tile], 64)
            queries = lanes[:, :sizes[tile].max()]
            for row, query, lane in _hits(queries, lanes, sizes[tile], radius, mask):
                held = (query < lane)
                forest.unite(
                    starts[tile][row[held]] + query[held], starts[tile][row[held]] + lane[held]
                )
    for run in np.flatnonzero((sizes > 1) & ~small):
        first, size = starts[run], sizes[run]
        rows = np.arange(first, first + size)
        parts = part[rows]
        asking, asked = rows[parts == low[first]], rows[parts == high[first]]
        if not len(asking) or not len(asked):
            continue
        lanes = _padded(fps[asked], np.zeros(1, int), np.array([len(asked)]), -(-len(asked) // 64) * 64)
        found = _hits(
            fps[asking][None, :], lanes, np.array([len(asked)]), radius, masks[choice[first]]
        )
        for _, query, lane in found:
            forest.unite(asking[query], asked[lane])
    root = forest.find(np.arange(n))
    linked = np.flatnonzero(root != np.arange(n))
    signed = fps.view(np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(signed[linked]), pa.array(signed[root[linked]])], names=["a", "b"]
    )


def _link_sorted(
    batches: Iterable[pa.RecordBatch], masks: list[int], radius: int
) -> Iterator[pa.RecordBatch]:
    """Runs may span batches: the last run of a batch waits for the next one."""
    waiting = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if waiting is not None:
            table = pa.concat_tables([waiting, table])
        ends = [table.column(c).to_numpy() for c in ("choice", "key", "low", "high")]
        same = np.all([c == c[-1] for c in ends], axis=0)
        cut = len(same) - int(np.argmin(same[::-1])) if not same.all() else 0
        if cut:
            yield _link_runs(table.slice(0, cut), masks, radius)
        waiting = table.slice(cut)
    if waiting is not None and waiting.num_rows:
        yield _link_runs(waiting, masks, radius)
    give_back_memory()


def key_masks(radius: int, keep: int) -> list[int]:
    """For each choice of ``keep`` of ``radius + keep`` runs, the bits in these runs."""
    runs = radius + keep
    edges = [round(BITS * i / runs) for i in range(runs + 1)]
    whole = [(1 << j) - (1 << i) for i, j in zip(edges, edges[1:])]
    return [sum(chosen) for chosen in combinations(whole, keep)]


def _signed(number: int) -> int:
    return number - (1 << BITS) if number >> (BITS - 1) else number


def links(distinct: DataFrame, radius: int = RADIUS, keep: int = KEEP, block: int = BLOCK) -> DataFrame:
    """Edges ``a``, ``b`` that connect all fingerprints linked within ``radius``.

    ``distinct`` has distinct values ``fp`` and is read twice. One table is stored: the keys that
    more than ``block`` fingerprints share, with their number of parts.
    """
    masks = key_masks(radius, keep)
    keys = F.array(*[F.col("fp").bitwiseAND(F.lit(_signed(m))) for m in masks])
    keyed = distinct.select("fp", F.posexplode(keys).alias("choice", "key"))
    large = store(
        keyed.groupBy("choice", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > block)
        .select("choice", "key", F.ceil(F.col("n") / block).cast("int").alias("parts"))
    )
    parts = F.coalesce("parts", F.lit(1))
    other = F.explode(F.sequence(F.lit(0), parts - 1))
    dealt = (
        keyed.join(large, ["choice", "key"], "left")
        .select("*", F.pmod(F.xxhash64("fp"), parts).cast("int").alias("part"), other.alias("other"))
        .select(
            "choice", "key", F.least("part", "other").alias("low"),
            F.greatest("part", "other").alias("high"), "part", "fp",
        )
    )
    order = ["choice", "key", "low", "high"]
    return (
        dealt.repartition(*order)
        .sortWithinPartitions(*order)
        .mapInArrow(lambda batches: _link_sorted(batches, masks, radius), "a long, b long")
    )


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    radius: int = RADIUS,
    keep: int = KEEP,
) -> DataFrame:
    """``doc_id``, ``fp`` and ``component_id``, the smallest id reachable, one row per document.

    Calling this runs jobs; fingerprints and rounds of the components are stored.
    """
    found = store(fingerprints(docs, id_col, text_col, shingle))
    distinct = store(found.groupBy("fp").agg(F.min("doc_id").alias("first")))
    grouped = store(components(links(distinct, radius, keep)).withColumnRenamed("node", "fp"))
    least = (
        grouped.join(distinct, "fp").groupBy("root").agg(F.min("first").alias("component_id"))
    )
    linked = spread_join(grouped, least, "root").select("fp", "component_id")
    # stored, so that the last join has plain shuffles on both sides and hot fingerprints are split
    per_fp = store(distinct.join(linked, "fp", "left").select(
        "fp", F.coalesce("component_id", "first").alias("component_id")
    ))
    return found.join(per_fp, "fp").select("doc_id", "fp", "component_id")


def drop_near_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings
) -> DataFrame:
    """One row of each group, the one with the smallest id, with all its columns.

    ``docs`` is stored once with a number per row, since ids may repeat. Null ids come first.
    """
    number, key = unused_name(docs, "_row"), unused_name(docs, "_key")
    numbered = store(docs.withColumn(number, F.monotonically_increasing_id()))
    keyed = numbered.withColumn(key, F.struct(F.col(id_col).alias("id"), F.col(number).alias("row")))
    groups = near_duplicates(keyed, key, text_col, **settings)
    stays = groups.where(F.col("doc_id") == F.col("component_id")).select(
        F.col("doc_id.row").alias(number)
    )
    return numbered.join(stays, number, "left_semi").select(*docs.columns)
