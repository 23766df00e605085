"""Line dedup by a deletion-neighbourhood join and a verified edit distance.

A line goes if an equal line, or a near one, comes earlier. Lines are compared without white space at their
ends. Equal lines go at any length. Two lines are near if their edit distance is at most ``bound`` of the
shorter one: ``edits``, but no more than one edit for every ``CHARS_PER_EDIT`` of its characters, since
one edit is a large part of a short line ("1." and "2."). Earlier means by id of the document, then by line.

Equal lines are found by digest. For near ones, a line is cut into as many pieces as its bound and one more.
Edits leave at least one piece of the shorter line intact, and the longer one has it at most the bound
from its place. So a line asks for all pieces, at all places where they can be, that a line of its length
or less may have; only lines that share a piece go on.

What lies before and after a shared piece has at most the bound's edits in all, so one of the two sides has at
most half of them. Lines that share a piece emit the hashes of all their sides' variants with so many
deletions; equal variants are joined, and lines that have one are compared by edit distance. A piece that
more than ``BLOCK`` lines share is no place to do that: there a line emits the variants of all that is
around the piece, with as many deletions as edits, and each piece and variant becomes a key of its own.
So many lines with the same start cost keys in proportion to their number and no pairs. Should more
than ``BLOCK`` lines share even that, or if a line has more than ``_MOST_VARIANTS`` of them, which are then
not emitted, the key is cut into parts, and pairs of parts are compared in tasks of their own.

Texts of lines are not shuffled but for those that meet another; to find them again, a bitmap of
fixed size with the digests' first three bytes is broadcast, and digests decide.

Nulls and edge cases: a null text counts as empty. Null ids come first. Rows with the same id are
ordered by their number in the stored table. Blank lines stay. An empty table gives no rows. Only id
and text are read. A text is held whole by one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playmetrics.operators.ordering import with_position
from playmetrics.storage import store

EDITS = 1
# A line of fewer characters has no near lines, one of up to twice as many allows one edit, and so on.
CHARS_PER_EDIT = 10
# Lines that share a piece and are compared in one task, at most twice as many.
BLOCK = 256
# The white space that does not count at the ends of a line.
EDGES = " \t\r\x0b\x0c"
_BITMAP_BYTES = 3
# Counters of characters that rule pairs out, and groups large enough to use them.
_BINS = 64
_LARGE = 16
# Most variants of a line that are emitted where many lines share a piece.
_MOST_VARIANTS = 10_000
# An odd base, which has an inverse modulo 2^64.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
# Characters whose powers of the base are held in a table, and of lines that are cut at once.
_STEP = 1 << 16
_CHARS = 1 << 18


def lines_of(text: str | None) -> Iterator[tuple[int, str]]:
    """Number and compared part of the lines that are not blank."""
    for number, line in enumerate((text or "").split("\n")):
        line = line.strip(EDGES)
        if line:
            yield number, line


def digest(line: str) -> bytes:
    return hashlib.md5(line.encode("utf-8", "replace")).digest()


def bound(length: int, edits: int) -> int:
    """Edits that a pair may have whose shorter line has ``length`` characters."""
    return min(edits, length // CHARS_PER_EDIT)


@cache
def _powers(base: int, count: int) -> np.ndarray:
    """Powers of a base modulo 2^64; ``count`` is rounded up by the caller."""
    powers = np.ones(count, np.uint64)
    powers[1:] = base
    return np.multiply.accumulate(powers)


def _span_hashes(points: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of what is between the places, wherever it lies: sums of code points times powers of the base."""
    places, back = np.unique(np.concatenate([start, end]), return_inverse=True)
    sums, total = np.zeros(len(places), np.uint64), np.zeros(1, np.uint64)
    blocks = 1 << (len(points) // _STEP).bit_length()
    low, high = _powers(_BASE, _STEP), _powers(pow(_BASE, _STEP, 1 << 64), blocks)
    for block, at in enumerate(range(0, len(points), _STEP)):
        own = points[at:at + _STEP].astype(np.uint64) + np.uint64(1)
        own = np.cumsum(own * low[:len(own)] * high[block]) + total
        first, after = np.searchsorted(places, [at, at + len(own)], side="right")
        sums[first:after] = own[places[first:after] - at - 1]
        total = own[-1:]
    low, high = _powers(_INVERSE, _STEP), _powers(pow(_INVERSE, _STEP, 1 << 64), blocks)
    sums = sums[back]
    return (sums[len(start):] - sums[:len(start)]) * low[start % _STEP] * high[start // _STEP]


def _shapes(edits: int) -> list[tuple[int, int, int, int]]:
    """What pieces there can be: characters that the line has more than the one it looks for, that one's bound,
    the piece's number, and how far it is from its place; those that are a line's own come first.

    Two lines whose distance is within the bound of the shorter one share a piece that is an own one of the
    shorter. Edits before piece i and after it are counted apart: one side has at most as
    many as pieces, which limits how far an intact piece can be from its place.
    """
    found = [
        (more, most, i, by)
        for most in range(min(edits, 1), edits + 1) for more in range(most + 1) for i in range(most + 1)
        for by in range(max(-i, more - most + i), min(i, more + most - i) + 1)
    ]
    return sorted(found, key=lambda shape: (shape[0] > 0 or shape[3] != 0, abs(shape[3])))


def pieces(lines: list[str], edits: int) -> tuple[np.ndarray, ...]:
    """The pieces that lines have or ask for, by line: the line's place in the list, key, start, end, whether it
    is an own one, and whether no piece before it is the same one of the line. Own ones come first."""
    n = np.fromiter(map(len, lines), np.int64, len(lines))
    ends = np.cumsum(n)
    at, shape, start, end = [], [], [], []
    shapes = _shapes(edits)
    for number, (more, most, i, by) in enumerate(shapes):
        length = n - more
        own = np.flatnonzero((length >= 0) & (np.minimum(edits, length // CHARS_PER_EDIT) == most))
        at.append(own)
        shape.append(np.full(len(own), number))
        start.append(length[own] * i // (most + 1) + by)
        end.append(length[own] * (i + 1) // (most + 1) + by)
    at, shape, start, end = (np.concatenate(c) if c else np.zeros(0, np.int64) for c in (at, shape, start, end))
    points = np.frombuffer("".join(lines).encode("utf-32-le", "replace"), np.uint32)
    begin = (ends - n)[at]
    more, most, i, by = np.array(shapes, np.int64).reshape(-1, 4)[shape].T
    key = _span_hashes(points, begin + start, begin + end)
    # sums of texts that differ in their first character are close together, so the rest must not be small
    key += (n[at] - more).astype(np.uint64) * np.uint64(0x632BE59BD9B4E019)
    key += i.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    first = np.ones(len(at), bool)
    for later, place in enumerate(shapes):
        for earlier in range(later):
            if shapes[earlier][:3] == place[:3]:
                # the same lines in the same order
                first[shape == later] &= key[shape == later] != key[shape == earlier]
    order = np.argsort(at, kind="stable")
    return tuple(c[order] for c in (at, key.view(np.int64), start, end, (more == 0) & (by == 0), first))


def _grouped(lines: list[str]) -> Iterator[list[str]]:
    """Runs of lines with some characters in all, or of one long line."""
    run, held = [], 0
    for line in lines:
        if run and held + len(line) > _CHARS:
            yield run
            run, held = [], 0
        run.append(line)
        held += len(line)
    if run:
        yield run


def variants(text: str, deletions: int) -> np.ndarray:
    """Hashes of all strings that at most so many deletions make of ``text``.

    A hash is the sum of code points times powers of the base by place. Characters after a deleted
    one move down by a place, which divides what they add by the base, so that every variant takes a
    few operations on the sums up to its deleted places, whatever its length.
    """
    points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    n = len(points)
    with np.errstate(over="ignore"):
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((points + np.uint64(1)) * _powers(_BASE, 1 << n.bit_length())[:n], out=sums[1:])
        found = [sums[-1:]]
        for count in range(1, min(deletions, n) + 1):
            if count == 1:
                at = np.arange(n).reshape(1, -1)
            elif count == 2:
                at = np.stack(np.triu_indices(n, 1))
            else:
                at = np.array(list(combinations(range(n), count))).T
            total, start = np.zeros(at.shape[1], np.uint64), np.zeros(at.shape[1], np.int64)
            for moved, place in enumerate([*at, np.full(at.shape[1], n)]):
                total += (sums[place] - sums[start]) * np.uint64(pow(_INVERSE, moved, 1 << 64))
                start = place + 1
            found.append(total)
        # strings of different length must not agree by trailing sums alone
        return np.unique(np.concatenate([
            own + np.uint64(0x632BE59BD9B4E019) * np.uint64(n - count) for count, own in enumerate(found)
        ]))


def _count_variants(length: int, deletions: int) -> int:
    return sum(comb(length, count) for count in range(deletions + 1))


def _equal_run(a: str, b: str, i: int, j: int) -> int:
    """Length of what ``a`` from ``i`` and ``b`` from ``j`` have in common."""
    n = min(len(a) - i, len(b) - j)
    if a[i:i + n] == b[j:j + n]:
        return n
    low, step = 0, 16
    while a[i + low:i + min(low + step, n)] == b[j + low:j + min(low + step, n)]:
        low += step
        step *= 2
    high = min(low + step, n)
    while high - low > 1:
        mid = (low + high) // 2
        if a[i + low:i + mid] == b[j + low:j + mid]:
            low = mid
        else:
            high = mid
    return low


def within(a: str, b: str, edits: int) -> bool:
    """Whether the edit distance is at most ``edits``, by the furthest place on each diagonal."""
    goal, ends = len(b) - len(a), {}
    if abs(goal) > edits:
        return False
    for count in range(edits + 1):
        reached = {}
        for d in range(-count, count + 1):
            steps = [ends[d + by] + (by >= 0) for by in (-1, 0, 1) if d + by in ends]
            i = min(max(steps, default=0), len(a), len(b) - d)
            if i < 0 or i + d < 0:
                continue
            i += _equal_run(a, b, i, i + d)
            if d == goal and i == len(a):
                return True
            reached[d] = i
        ends = reached
    return False


def _split(batches: Iterable[pa.RecordBatch], edits: int) -> Iterator[pa.RecordBatch]:
    """For each document a row without a line, with its number of lines, and a row per line that is not blank."""
    for batch in batches:
        at, numbers, counts, lines = [], [], [], []
        for i, text in enumerate(batch.column(2)):
            text = text.as_py() or ""
            own = list(lines_of(text))
            at += [i] * (len(own) + 1)
            numbers += [None, *(number for number, _ in own)]
            counts += [text.count("\n") + 1, *[None] * len(own)]
            lines += [line for _, line in own]
        n_keys, keys = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for run in _grouped(lines):
            place, key, *_, first = pieces(run, edits)
            n_keys.append(np.bincount(place[first], minlength=len(run)))
            keys.append(key[first])
        numbers = pa.array(numbers, pa.int32())
        # a document's own row has no keys
        is_line = numbers.is_valid().to_numpy(zero_copy_only=False)
        ends = np.zeros(len(at) + 1, np.int32)
        ends[1:][is_line] = np.concatenate(n_keys)
        np.cumsum(ends, out=ends)
        digests = np.full(len(at), None)
        digests[is_line] = [digest(line) for line in lines]
        at = pa.array(at, pa.int64())
        yield pa.RecordBatch.from_arrays([
            batch.column(0).take(at), batch.column(1).take(at), numbers,
            pa.array(counts, pa.int64()), pa.array(digests, pa.binary()),
            pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(keys))),
        ], names=["doc_id", "row", "line", "n_lines", "digest", "keys"])


def _keyed(batches: Iterable[pa.RecordBatch], edits: int) -> Iterator[pa.RecordBatch]:
    """The pieces of each line: key, whether it is an own one, and where it starts and ends."""
    for batch in batches:
        ranks, done = batch.column("rank"), 0
        for run in _grouped(batch.column("text").to_pylist()):
            at, key, start, end, own, _ = pieces(run, edits)
            yield pa.RecordBatch.from_arrays([
                pa.array(key), pa.array(own), pa.array(start, pa.int32()),
                pa.array(end, pa.int32()), ranks.take(pa.array(at + done)),
            ], names=["key", "own", "start", "end", "rank"])
            done += len(run)


def _refined(batches: Iterable[pa.RecordBatch], edits: int) -> Iterator[pa.RecordBatch]:
    """For lines with a piece that very many share: a key for the piece and each variant of the rest."""
    names = ["key", "own", "start", "end", "rank"]
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1)
            line, start, end = (row.column(c)[0].as_py() for c in ("text", "start", "end"))
            rest, most = line[:start] + line[end:], bound(len(line), edits)
            keys = row.column("key").to_numpy()
            if _count_variants(len(rest), most) <= _MOST_VARIANTS:
                with np.errstate(over="ignore"):
                    keys = (variants(rest, most) ^ keys.view(np.uint64)) * np.uint64(_BASE)
                keys = keys.view(np.int64)
            same = pa.array(np.zeros(len(keys), np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys), *(row.column(c).take(same) for c in names[1:])], names=names
            )


def _character_counts(lines: list[str]) -> np.ndarray:
    """Per line, how many characters fall in each of some bins; an edit changes two counters by one."""
    return np.stack([
        np.bincount(np.frombuffer(line.encode("utf-32-le", "replace"), np.uint32) % _BINS, minlength=_BINS)
        for line in lines
    ]).astype(np.int32)


def _joined_variants(lines: list[str], start: list[int], end: list[int], edits: int) -> np.ndarray:
    """Which lines of a run have a variant of the same side of the shared piece in common."""
    hashes, at = [], []
    for i, line in enumerate(lines):
        for side, text in enumerate((line[:start[i]], line[end[i]:])):
            own = variants(text, bound(len(line), edits) // 2) ^ np.uint64(side)
            hashes.append(own)
            at.append(np.full(len(own), i))
    hashes, at = np.concatenate(hashes), np.concatenate(at)
    order = np.argsort(hashes, kind="stable")
    hashes, at = hashes[order], at[order]
    joined = np.zeros((len(lines), len(lines)), bool)
    edges = np.flatnonzero(np.diff(hashes)) + 1
    done = set()
    for first, after in zip([0, *edges.tolist()], [*edges.tolist(), len(at)]):
        if after - first > 1:
            members = at[first:after]
            if (known := members.tobytes()) not in done:
                done.add(known)
                joined[np.ix_(members, members)] = True
    return joined


def _link_run(run: dict[str, list], edits: int, across: bool) -> Iterator[tuple[int, int]]:
    """For each line with a near one before it, its place and that of one; lines in order of rank."""
    lines, own, part, rank = (run[c] for c in ("text", "own", "part", "rank"))
    if len(lines) < 2:
        return
    may = _joined_variants(lines, run["start"], run["end"], edits)
    owns, parts, ranks = np.array(own), np.array(part), np.array(rank)
    may &= owns[:, None] | owns[None, :]
    if across:
        may &= parts[:, None] != parts[None, :]
    large = len(lines) > _LARGE
    if large:
        counts = _character_counts(lines)
    for j in range(1, len(lines)):
        before = may[j, :j] & (ranks[:j] != ranks[j])
        if large:
            before &= np.abs(counts[:j] - counts[j]).sum(axis=1) <= 2 * edits
        for i in np.flatnonzero(before).tolist():
            if within(lines[i], lines[j], bound(min(len(lines[i]), len(lines[j])), edits)):
                yield j, i
                break


def _link_sorted(batches: Iterable[pa.RecordBatch], edits: int) -> Iterator[pa.RecordBatch]:
    """Runs of equal (key, low, high) may span batches: the last one waits for the next batch."""
    def links(table: pa.Table) -> pa.RecordBatch:
        runs = [table.column(c).to_numpy() for c in ("key", "low", "high")]
        new = np.ones(table.num_rows, bool)
        new[1:] = np.any([c[1:] != c[:-1] for c in runs], axis=0)
        edges = np.append(np.flatnonzero(new), table.num_rows).tolist()
        names = ("own", "part", "rank", "start", "end", "text")
        columns = {c: table.column(c).to_pylist() for c in names}
        across = (runs[1] != runs[2]).tolist()
        later, earlier = [], []
        for a, b in zip(edges, edges[1:]):
            run = {c: values[a:b] for c, values in columns.items()}
            for j, i in _link_run(run, edits, across[a]):
                later.append(run["rank"][j])
                earlier.append(run["rank"][i])
        return pa.RecordBatch.from_arrays(
            [pa.array(later, pa.int64()), pa.array(earlier, pa.int64())], names=["rank", "earlier"]
        )

    waiting = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if waiting is not None:
            table = pa.concat_tables([waiting, table])
        ends = [table.column(c).to_numpy() for c in ("key", "low", "high")]
        same = np.all([c == c[-1:] for c in ends], axis=0)
        cut = 0 if same.all() else len(same) - int(np.argmin(same[::-1]))
        if cut:
            yield links(table.slice(0, cut))
        waiting = table.slice(cut)
    if waiting is not None and waiting.num_rows:
        yield links(waiting)


def _candidates(distinct: DataFrame, edits: int) -> DataFrame:
    """``digest`` and ``rank``, its place among all of them, of lines that meet in a piece; stored."""
    keyed = distinct.select("number", F.posexplode("keys").alias("place", "key"))
    shared = (
        keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("least"))
        .where((F.col("n") > 1) & (F.col("least") <= edits))
    )
    numbers = keyed.join(shared.select("key"), "key", "left_semi").select("number").distinct()
    found = distinct.join(numbers, "number", "left_semi").select("first", "digest")
    return with_position(found, [F.asc("first")]).select(
        "digest", F.col("position").alias("rank")
    )


def _texts(narrow: DataFrame, candidates: DataFrame) -> DataFrame:
    """``rank`` and ``text`` of the candidates, read again from the documents; stored."""
    bit = F.conv(F.hex(F.substring("digest", 1, _BITMAP_BYTES)), 16, 10).cast("long")
    words = (
        candidates.select(bit.alias("bit"))
        .groupBy(F.shiftright("bit", 5).alias("word"))
        .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("bit") % 32).cast("int")))
             .alias("bits"))
        .collect()
    )
    bitmap = np.zeros(1 << (8 * _BITMAP_BYTES - 5), np.uint32)
    for word in words:
        bitmap[word["word"]] = word["bits"]
    held = narrow.sparkSession.sparkContext.broadcast(bitmap.tobytes())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(held.value, np.uint32)
        for batch in batches:
            digests, texts = [], []
            for text in batch.column(0):
                for _, line in lines_of(text.as_py()):
                    own = digest(line)
                    at = int.from_bytes(own[:_BITMAP_BYTES], "big")
                    if int(bits[at >> 5]) >> (at & 31) & 1:
                        digests.append(own)
                        texts.append(line)
            yield pa.RecordBatch.from_arrays(
                [pa.array(digests, pa.binary()), pa.array(texts, pa.string())],
                names=["digest", "text"],
            )

    found = narrow.select("text").mapInArrow(run, "digest binary, text string")
    return store(
        found.join(candidates, "digest").groupBy("rank").agg(F.min("text").alias("text"))
    )


def _shared(keyed: DataFrame) -> DataFrame:
    """Keys that more than one row has, and one of them as its own; and how many rows."""
    return keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("own").alias("own")).where(
        (F.col("n") > 1) & F.col("own")
    ).select("key", "n")


def near_links(texts: DataFrame, edits: int = EDITS, block: int = BLOCK) -> DataFrame:
    """Verified pairs ``rank``, ``earlier`` of near lines.

    ``texts`` has ``rank`` and ``text`` of distinct lines, and is read again and again. Every line with an
    earlier partner has a pair, not every pair of partners is there. Keys that lines share are stored.
    """
    schema = "key long, own boolean, start int, end int, rank long"
    keyed = texts.mapInArrow(lambda batches: _keyed(batches, edits), schema)
    shared = store(_shared(keyed))
    rare = keyed.join(shared.where(F.col("n") <= block).select("key"), "key")
    frequent = keyed.join(shared.where(F.col("n") > block).select("key"), "key").join(texts, "rank")
    refined = frequent.mapInArrow(lambda batches: _refined(batches, edits), schema)
    met = store(rare.unionByName(refined))
    parts = store(
        _shared(met).select("key", F.ceil(F.col("n") / block).cast("int").alias("parts"))
    )
    part = F.pmod(F.xxhash64("rank"), "parts").cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    dealt = (
        met.join(parts, "key")
        .select("key", "own", "start", "end", "rank", part.alias("part"), other.alias("other"))
        .join(texts, "rank")
        .select(
            "key", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"),
            "own", "part", "rank", "start", "end", "text",
        )
    )
    order = ["key", "low", "high"]
    return (
        dealt.repartition(*order)
        .sortWithinPartitions(*order, "rank")
        .mapInArrow(lambda batches: _link_sorted(batches, edits), "rank long, earlier long")
        .distinct()
    )


def line_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edits: int = EDITS
) -> DataFrame:
    """One row per document: ``doc_id, row, n_lines, n_exact, n_near, dropped``.

    ``dropped`` are the numbers, from 0, of the lines that go: ``n_exact`` because an equal line comes
    earlier, ``n_near`` because of a near one, with ``edits`` edits at most. ``row`` numbers the rows of this result's run. Calling
    this runs jobs and stores tables of digests.
    """
    if edits < 0:
        raise ValueError("edits must not be negative")
    narrow = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")
    ).withColumn("row", F.monotonically_increasing_id())
    kind = narrow.schema["doc_id"].dataType
    split = narrow.select("doc_id", "row", "text").mapInArrow(lambda batches: _split(batches, edits), T.StructType([
        T.StructField("doc_id", kind),
        T.StructField("row", T.LongType()),
        T.StructField("line", T.IntegerType()),
        T.StructField("n_lines", T.LongType()),
        T.StructField("digest", T.BinaryType()),
        T.StructField("keys", T.ArrayType(T.LongType())),
    ]))
    stored = store(split)
    lines = stored.where(F.col("line").isNotNull())
    place = F.struct("doc_id", "row", "line")
    distinct = store(
        lines.groupBy("digest").agg(
            F.min(place).alias("first"), F.count(F.lit(1)).alias("n"), F.first("keys").alias("keys")
        ).withColumn("number", F.monotonically_increasing_id())
    )
    candidates = _candidates(distinct, edits)
    ranks = near_links(_texts(narrow, candidates), edits).select("rank").distinct()
    near = candidates.join(ranks, "rank", "left_semi").select("digest", F.lit(True).alias("near"))
    # stored, so that the join with all lines has plain shuffles on both sides and hot lines are split
    marked = store(
        distinct.join(near, "digest", "left").where((F.col("n") > 1) | F.col("near"))
        .select("digest", "first", "near")
    )
    repeated = place != F.col("first")
    gone = lines.select("doc_id", "row", "line", "digest").join(marked, "digest").where(
        repeated | F.col("near")
    )
    per_doc = gone.groupBy("row").agg(
        F.count_if(repeated).alias("n_exact"),
        F.count_if(~repeated).alias("n_near"),
        F.sort_array(F.collect_list("line")).alias("dropped"),
    )
    heads = stored.where(F.col("line").isNull()).select("doc_id", "row", "n_lines")
    return heads.join(per_doc, "row", "left").select(
        "doc_id", "row", "n_lines",
        F.coalesce("n_exact", F.lit(0)).alias("n_exact"),
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.coalesce("dropped", F.array().cast("array<int>")).alias("dropped"),
    )


def without_lines(text: Column, dropped: Column) -> Column:
    """``text`` without the lines whose numbers are in ``dropped``."""
    kept = F.filter(F.split(text, "\n"), lambda _, i: ~F.array_contains(dropped, i))
    return F.array_join(kept, "\n")
