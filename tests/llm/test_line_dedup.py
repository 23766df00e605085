"""Line dedup against all pairs of lines, whose rule is written down here once more."""

import random
from itertools import combinations

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from playmetrics.llm import line_dedup, queries
from tests.llm.frames import AWKWARD, documents, plain

WHITE = " \t\r\x0b\x0c"


def distance(a, b, most):
    """Edit distance, or more than ``most`` as soon as it is known to be."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(last + (x != y), row[j] + 1, row[j - 1] + 1)
        if min(row) > most:
            return most + 1
    return row[-1]


def near(a, b, edits):
    """At most ``edits`` edits, and one for every ten characters of the shorter."""
    most = min(edits, min(len(a), len(b)) // 10)
    return a != b and most > 0 and distance(a, b, most) <= most


def slow(rows, edits):
    """Every pair compared. ``rows`` are (doc_id, text) in order."""
    lines = [
        (d, n, line.strip(WHITE)) for d, text in rows for n, line in enumerate((text or "").split("\n"))
    ]
    first = {}
    for place, (_, _, line) in enumerate(lines):
        if line:
            first.setdefault(line, place)
    close = {b for a, b in combinations(first, 2) if near(a, b, edits)}
    found = {d: [(text or "").count("\n") + 1, 0, 0, []] for d, text in rows}
    for place, (d, n, line) in enumerate(lines):
        if line and (first[line] < place or line in close):
            found[d][1 if first[line] < place else 2] += 1
            found[d][3].append(n)
    return sorted(((d, *r[:3], tuple(r[3])) for d, r in found.items()), key=str)


def run(df, **settings):
    return sorted(
        ((r["doc_id"], r["n_lines"], r["n_exact"], r["n_near"], tuple(r["dropped"]))
         for r in line_dedup.line_dedup(df, **settings).collect()), key=str,
    )


def mutated(rng, line, edits):
    for _ in range(edits):
        i = rng.randrange(len(line) + 1)
        kind = rng.choice("ids")
        c = rng.choice("abé中 ")
        line = line[:i] + {"i": c + line[i:], "d": line[i + 1:], "s": c + line[i + 1:]}[kind]
    return line


def made_up(seed, shortest=5, longest=26):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("ab") for _ in range(rng.randint(shortest, longest)))
    base = [word() for _ in range(25)] + ["x" * 30, "line with a few words in it", "é" * 22, "1.", "2."]
    lines = base + [mutated(rng, rng.choice(base), rng.randint(0, 4)) for _ in range(150)] + ["short", "", " \t"]
    return ["\n".join(rng.choice(lines) + rng.choice(["", " ", "\r", "\t"]) for _ in range(rng.randint(1, 6)))
            for _ in range(60)]


@pytest.mark.parametrize("edits", [0, 1, 2, 3])
def test_lines_against_all_pairs(spark, edits):
    texts = made_up(7 + edits) + [t for t in AWKWARD if t is None or len(t) < 1000]
    rows = list(enumerate(texts))
    expected = slow(rows, edits)
    assert sum(r[3] for r in expected) > 5 or not edits
    assert run(plain(spark, texts), edits=edits) == expected


@pytest.mark.parametrize("edits, block", [(1, 2), (2, 256), (2, 3), (3, 4)])
def test_links_against_all_pairs_whatever_the_block(spark, edits, block, monkeypatch):
    """With small blocks most pieces go on with their variants, and some of those are cut into parts."""
    start = "the same start of every line, long enough to be one piece or more: "
    rng = random.Random(block)
    lines = [line for text in made_up(block, 10, 25) for line in text.split("\n") if line.strip(WHITE)]
    lines = sorted({line.strip(WHITE) for line in lines})
    lines += [start + mutated(rng, rng.choice(["abcd efgh ijkl", "mnop qrst"]), rng.randint(0, 5)) for _ in range(60)]
    lines = list(dict.fromkeys(lines))
    texts = spark.createDataFrame(list(enumerate(lines)), "rank long, text string")
    if block == 3:
        monkeypatch.setattr(line_dedup, "_MOST_VARIANTS", 200)
    got = [tuple(r) for r in line_dedup.near_links(texts, edits, block).collect()]
    assert all(i < j and near(lines[i], lines[j], edits) for j, i in got)
    expected = {j for j, b in enumerate(lines) if any(near(a, b, edits) for a in lines[:j])}
    assert {j for j, _ in got} == expected and len(expected) > 25


@pytest.mark.parametrize("text", ["", "a", "ab", "aab", "abcba", "中é a\U0001F600"])
@pytest.mark.parametrize("deletions", [0, 1, 2, 3])
def test_variants_are_those_of_all_deletions(text, deletions):
    """One hash for each distinct string, and the same hash from whichever text it is made."""
    strings = {
        "".join(c for i, c in enumerate(text) if i not in gone)
        for count in range(min(deletions, len(text)) + 1) for gone in combinations(range(len(text)), count)
    }
    got = set(line_dedup.variants(text, deletions).tolist())
    assert got == {int(line_dedup.variants(s, 0)[0]) for s in strings}
    assert len(got) == len(strings)


def test_near_texts_share_a_variant_and_far_ones_hardly_ever():
    rng = random.Random(3)
    for _ in range(300):
        a = "".join(rng.choice("abc") for _ in range(rng.randint(0, 30)))
        b = mutated(rng, a, rng.randint(0, 2))
        assert np.intersect1d(line_dedup.variants(a, 2), line_dedup.variants(b, 2)).size
        c = "".join(rng.choice("xyz") for _ in range(30))
        assert not np.intersect1d(line_dedup.variants(a, 2), line_dedup.variants(c, 2)).size


@pytest.mark.parametrize("edits", [0, 1, 2, 3, 4])
def test_near_lines_share_a_piece_of_the_shorter(edits):
    lines = sorted({line.strip(WHITE) for text in made_up(edits, 8, 45) for line in text.split("\n")})
    keys, own = ({line: set() for line in lines} for _ in range(2))
    for at, key, _, _, is_own, first in zip(*line_dedup.pieces(lines, edits)):
        keys[lines[at]] |= {key} if first else set()
        own[lines[at]] |= {key} if is_own else set()
    for a in lines:
        for b in lines:
            most = min(edits, min(len(a), len(b)) // 10)
            assert line_dedup.within(a, b, most) == (distance(a, b, most) <= most)
            if near(a, b, edits) and len(a) <= len(b):
                assert own[a] & keys[b]


def slow_pieces(line, edits):
    """What a piece says, with the length it is of and its number; where it lies; whether it is an own one."""
    found = set()
    for more in range(edits + 1):
        length = len(line) - more
        most = min(edits, length // 10)
        if length < 0 or more > most or (edits and not most):
            continue
        for i in range(most + 1):
            start, end = length * i // (most + 1), length * (i + 1) // (most + 1)
            # by characters more before the piece, more - by after it; at most i edits or most - i
            for by in range(-edits, edits + 1):
                if abs(by) <= i and abs(more - by) <= most - i:
                    said = (length, i, line[start + by:end + by])
                    found.add((said, start + by, end + by, not more and not by))
    return found


@pytest.mark.parametrize("edits", [0, 1, 2, 3])
@pytest.mark.parametrize("step", [7, 1 << 16])
def test_pieces_are_those_of_the_rule_wherever_a_line_lies(edits, step, monkeypatch):
    monkeypatch.setattr(line_dedup, "_STEP", step)
    lines = [line for text in made_up(edits, 8, 45) for line in text.split("\n")] + ["x" * 64, "", "\U0001F600" * 25]
    keys, got, seen = {}, [set() for _ in lines], [set() for _ in lines]
    for at, key, start, end, own, first in zip(*line_dedup.pieces(lines, edits)):
        assert first == (key not in seen[at])
        seen[at].add(key)
        got[at].add((key, start, end, own))
    for line, found in zip(lines, got):
        expected = slow_pieces(line, edits)
        assert {f[1:] for f in found} == {e[1:] for e in expected} and len(found) == len(expected)
        by_place = {}
        for key, start, end, own in found:
            by_place.setdefault((start, end, own), set()).add(key)
        for said, *place in expected:
            keys.setdefault(said, []).append(by_place[tuple(place)])
    # one key for what says the same, and different ones for all else
    same = {said: set.intersection(*found) for said, found in keys.items()}
    assert all(same.values())
    assert len(set().union(*same.values())) == len(keys)


def test_a_piece_that_very_many_lines_share(spark):
    """Rows in every step stay in proportion to the lines: a line has some hundred variants."""
    rng = random.Random(11)
    start = "a start that all of them have in common, "
    count = 3000
    lines = [start + "".join(rng.choice("abcdefgh") for _ in range(14)) for _ in range(count)]
    twins = {i: mutated(rng, lines[i], 1) for i in range(0, count, 100)}
    lines = list(dict.fromkeys(lines + list(twins.values())))
    texts = spark.createDataFrame(list(enumerate(lines)), "rank long, text string").repartition(8)
    stored = []
    store = line_dedup.store

    def counted(df):
        found = store(df)
        stored.append(found.count())
        return found

    line_dedup.store = counted
    try:
        got = {j for j, _ in line_dedup.near_links(texts, 2).collect()}
    finally:
        line_dedup.store = store
    assert set(range(count, len(lines))) <= got
    assert max(stored) < 500 * 12 * len(lines)
    # no key of the pieces alone is left to compare
    assert all(near(lines[i], lines[j], 2) for j, i in line_dedup.near_links(texts, 2).collect())


def test_very_long_lines(spark):
    line = "".join(random.Random(1).choice("abcdef ") for _ in range(100_000)).strip()
    near_one = line[:50_000] + line[50_001:]
    other = line[:10] + "!!" + line[12:]
    assert run(plain(spark, [line, near_one, other, line])) == [
        (0, 1, 0, 0, ()), (1, 1, 0, 1, (0,)), (2, 1, 0, 0, ()), (3, 1, 1, 0, (0,))
    ]
    assert run(plain(spark, [line, near_one, other]), edits=2)[2] == (2, 1, 0, 1, (0,))


def test_a_frequent_line_and_equal_ids(spark):
    line = "the same line in every document"
    rows = [(i // 2, f"{line}\nand a line of its own, number {i} {i * i}", "", "") for i in range(200)]
    found = line_dedup.line_dedup(documents(spark, rows)).collect()
    assert sum(len(r["dropped"]) for r in found if 0 in r["dropped"]) >= 199
    assert sum(r["n_exact"] for r in found) == 199


def test_null_ids_come_first_and_empty(spark):
    line = "a line that occurs in two rows"
    assert run(documents(spark, [(1, line, "", ""), (None, line, "", "")])) == [
        (1, 1, 1, 0, (0,)), (None, 1, 0, 0, ())
    ]
    assert run(plain(spark, [])) == []


def test_short_lines_go_if_equal_and_stay_if_near(spark):
    """The expected rows are written out: below ten characters one edit is too many, below twenty two are."""
    texts = ["Les.\na\n", "Les.\nLet.\n\n a\t", "x\nLes.\n123456789", "12345678\n123456789z", "1234567890abcdefghi",
             "1234567890Xbcdefghi\n1234567890XYcdefghi", "1234567890XYcdefghi!", " \n\n "]
    assert run(plain(spark, texts), edits=2) == [
        (0, 3, 0, 0, ()), (1, 4, 2, 0, (0, 3)), (2, 3, 1, 0, (1,)), (3, 2, 0, 0, ()), (4, 1, 0, 0, ()),
        (5, 2, 0, 2, (0, 1)), (6, 1, 0, 1, (0,)), (7, 3, 0, 0, ()),
    ]


def test_all_exact_repeats_of_the_supplied_table_go(spark):
    path = "/root/testdata/sf0.01/documents.parquet"
    white = " || ".join(f"chr({n})" for n in (9, 11, 12, 13, 32))
    expected = duckdb.sql(f"""
WITH every AS (
  SELECT doc_id, trim(unnest(string_split(coalesce(text, ''), chr(10))), {white}) AS t FROM '{path}')
SELECT count(*) - count(DISTINCT t) FROM every WHERE t <> ''""").fetchall()[0][0]
    found = line_dedup.line_dedup(spark.read.parquet(path))
    assert found.agg(F.sum("n_exact")).first()[0] == expected


def test_the_query_against_all_pairs_of_the_supplied_lines(spark):
    """Pairs whose characters differ too much in number cannot be near; all others are compared."""
    path = "/root/testdata/sf0.01/documents.parquet"
    first = {}
    for doc_id, text in sorted(duckdb.sql(f"SELECT doc_id, text FROM '{path}'").fetchall()):
        for number, line in enumerate((text or "").split("\n")):
            if line.strip(WHITE):
                first.setdefault(line.strip(WHITE), (doc_id, number))
    lines = sorted(first, key=first.get)
    counts = np.stack([
        np.bincount(np.frombuffer(t.encode("utf-32-le"), np.uint32) % 128, minlength=128) for t in lines
    ]).astype(np.int16)
    close = set()
    for j in range(1, len(lines)):
        may = np.abs(counts[:j] - counts[j]).sum(axis=1) <= 4
        if any(near(lines[i], lines[j], 2) for i in np.flatnonzero(may)):
            close.add(j)
    assert len(close) > 5
    found = queries.op8_line_dedup(spark, "/root/testdata/sf0.01")
    assert found.agg(F.sum("n_near")).first()[0] == len(close)


def test_without_lines(spark):
    df = spark.createDataFrame([("a\nb\n\nc", [1, 3]), ("x", [0]), (None, [])], "t string, d array<int>")
    got = [r[0] for r in df.select(line_dedup.without_lines(F.col("t"), F.col("d"))).collect()]
    assert got == ["a\n", "", None]
