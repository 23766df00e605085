"""The manifest against a tree that is built level by level in plain Python."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from playmetrics.llm import merkle
from playmetrics.llm.queries import op13_merkle_manifest
from tests.llm.frames import AWKWARD, documents, plain


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def digest(*values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def grow(hashes):
    levels = [hashes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([sha("".join(below[i:i + 3])) for i in range(0, len(below), 3)])
    return levels


def siblings(levels, at):
    for level in levels[:-1]:
        run = at // 3 * 3
        yield level[run:at], level[at + 1:run + 3]
        at //= 3


def key(value):
    return (value is not None, (value or "").encode() if isinstance(value, (str, type(None))) else value)


def expected(rows, tamper):
    """``rows`` are (doc_id, source, lang, n_chars, text); one result tuple each, in any order."""
    sources = {}
    for row in rows:
        sources.setdefault(row[1], []).append((row[0] is not None, row[0] or 0, digest(*row), row))
    names = sorted(sources, key=key)
    trees = {}
    for name in names:
        sources[name].sort(key=lambda x: x[:3])
        trees[name] = grow([x[2] for x in sources[name]])
    upper = grow([trees[name][-1][0] for name in names])
    found = []
    for number, name in enumerate(names):
        for at, (_, _, leaf, row) in enumerate(sources[name]):
            path = [*siblings(trees[name], at), *siblings(upper, number)]
            changed = digest(*row[:4], row[4].replace("\n", "")) if tamper(row) and row[4] is not None else leaf
            root = changed
            for left, right in path:
                root = sha("".join(left) + root + "".join(right))
            proof = "".join("".join(left + right) for left, right in path)
            found.append((row[0], leaf, trees[name][-1][0], upper[-1][0], proof, root))
    return found


def crc_even(row):
    return row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0


def run(df, **settings):
    found = merkle.manifest(
        df, F.crc32(F.col("doc_id").cast("string")) % 2 == 0,
        {"text": F.translate("text", "\n", "")}, **settings,
    )
    return [tuple(r) for r in found.select("doc_id", "leaf", "subroot", "root", "proof", "folded_root").collect()]


def plain_rows(df):
    return [(r["doc_id"], r["source"], r["lang"], r["n_chars"], r["text"]) for r in df.collect()]


def corpus(count, seed):
    rng = random.Random(seed)
    sources = ["hot"] * 6 + ["", None, "ä", "Z", "z", "a"]
    ids = rng.sample(range(10**12), count)
    return [
        (i, rng.choice(["x\ny", "x", "", None, "é\n\n", "longer text " * 5]), rng.choice(["en", None]),
         rng.choice(sources)) for i in ids
    ]


@pytest.mark.parametrize("count, levels", [(1, 6), (2, 1), (4, 2), (28, 1), (400, 2), (400, 6)])
def test_against_a_tree_in_plain_python(spark, count, levels):
    df = documents(spark, corpus(count, count))
    rows = plain_rows(df)
    assert sorted(run(df, levels=levels)) == sorted(expected(rows, crc_even))


def test_one_source_over_several_tiers(spark):
    """Blocks of nine leaves: 900 leaves take four tiers, and most sizes leave single nodes at the end."""
    df = documents(spark, [(i, f"{i}\n", "en", "only") for i in range(900)] + [(-1, "x", None, "other")])
    assert sorted(run(df, levels=2)) == sorted(expected(plain_rows(df), crc_even))


def test_many_sources(spark):
    df = documents(spark, [(i, "t\n", "en", f"s{i % 250}") for i in range(500)])
    assert sorted(run(df, levels=2)) == sorted(expected(plain_rows(df), crc_even))


def test_awkward_repeated_null_and_empty(spark):
    df = plain(spark, [t.replace("\x00", "") if t else t for t in AWKWARD])
    assert sorted(run(df)) == sorted(expected(plain_rows(df), crc_even))
    rows = [(None, None, None, None)] * 4 + [(None, "a", "en", None), (7, "b\n", None, "s")] * 2
    df = documents(spark, rows)
    assert sorted(run(df), key=str) == sorted(expected(plain_rows(df), crc_even), key=str)
    assert run(plain(spark, [])) == []


def test_partitions_do_not_matter(spark):
    rows = corpus(200, 9)
    assert sorted(run(documents(spark, rows, 2))) == sorted(run(documents(spark, rows, 9)))


def test_a_version_shares_all_but_its_path():
    rng = random.Random(1)
    leaves = [sha(str(i)) for i in range(70)]
    block = merkle.Block(leaves, whole=True)
    before = [list(level) for level in block.nodes]
    for at in rng.sample(range(70), 20):
        changed = sha(f"other {at}")
        copies = block.version(at, changed)
        rebuilt = grow(leaves[:at] + [changed] + leaves[at + 1:])
        assert copies == [level[at // 3 ** k] for k, level in enumerate(rebuilt)]
        own = {(k, at // 3 ** k) for k in range(len(rebuilt))}
        for k, level in enumerate(rebuilt):
            for i, node in enumerate(level):
                assert (node != before[k][i]) == ((k, i) in own)
        assert block.nodes == before


def test_versions_hold_the_copied_nodes(spark):
    df = documents(spark, [(i, "a\nb", "en", f"s{i % 2}") for i in range(60)])
    found = merkle.manifest(df, F.col("doc_id") % 5 == 0, {"text": F.lit("other")}, levels=1).collect()
    for r in found:
        if r["doc_id"] % 5:
            assert r["copies"] is None and r["folded_root"] == r["root"]
        else:
            # 30 leaves a source are four levels, two sources one more
            assert len(r["copies"]) == 6 and r["copies"][0] != r["leaf"]
            assert r["copies"][-1] == r["folded_root"] != r["root"]


def test_nothing_is_tampered_by_default(spark):
    found = merkle.manifest(documents(spark, corpus(50, 2))).collect()
    assert all(r["copies"] is None and r["folded_root"] == r["root"] for r in found)


def test_the_query_tells_which_documents_changed(spark):
    folder = "/root/testdata/sf0.01"
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    found = op13_merkle_manifest(spark, folder).collect()
    assert len(found) == len(docs)
    for r in found:
        text = docs[r["doc_id"]]["text"]
        lost = text is not None and "\n" in text and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0
        assert r["verified"] == (not lost)
    assert {r["verified"] for r in found} == {True, False}


def test_columns_must_hold_the_id_and_the_source(spark):
    with pytest.raises(ValueError, match="start with the id"):
        merkle.manifest(plain(spark, ["a"]), columns=("text", "doc_id"))
