import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from playmetrics.llm import simhash
from playmetrics.llm.components import components
from tests.llm.frames import AWKWARD, LONG, documents, plain


def slow_fingerprint(text, shingle=4):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    words = [w for w in low.split(" ") if w]
    grams = [" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams] if words else []
    bits = [sum(h >> b & 1 for h in hashes) * 2 > len(hashes) for b in range(64)]
    return sum(1 << b for b, on in enumerate(bits) if on)


@pytest.mark.parametrize("text", [*AWKWARD, "a b c", "a b c d", "a b c d e", "x\x1cy z\x85w v u"])
def test_fingerprint(text):
    assert simhash.fingerprint(text) & (1 << 64) - 1 == slow_fingerprint(text)


def test_fingerprint_hash_is_spark_own(spark):
    own = spark.range(1).select(F.xxhash64(F.lit("a b c")).alias("h")).first()["h"]
    assert simhash.fingerprint("A b C") == own


def classes(values, radius):
    """Smallest index reachable over links within the radius, all pairs compared."""
    values, up = np.array(values, np.uint64), list(range(len(values)))
    def find(i):
        while up[i] != i:
            i = up[i]
        return i
    for i in range(len(values)):
        for j in np.flatnonzero(np.bitwise_count(values ^ values[i]) <= radius):
            a, b = sorted((find(i), find(int(j))))
            up[b] = a
    return [find(i) for i in range(len(values))]


def clustered(rng, clusters, members, flips):
    found = []
    for _ in range(clusters):
        centre = rng.getrandbits(64)
        for _ in range(members):
            value = centre
            for _ in range(rng.randint(0, flips)):
                value ^= 1 << rng.randrange(64)
            found.append(value)
    return list(dict.fromkeys(found))


@pytest.mark.parametrize("radius, keep, block", [(4, 2, 8192), (4, 1, 64), (4, 2, 5), (2, 1, 7), (0, 1, 50)])
def test_links_connect_what_all_pairs_connect(spark, radius, keep, block):
    rng = random.Random(radius * 10 + block)
    values = clustered(rng, 25, 8, 4) + clustered(rng, 1, 250, 6) + [rng.getrandbits(64) for _ in range(300)] + [0]
    values = list(dict.fromkeys(values))
    signed = [simhash._signed(v) for v in values]
    df = spark.createDataFrame([(v,) for v in signed], "fp long").repartition(5)
    edges = simhash.links(df, radius, keep, block).collect()
    at = {v: i for i, v in enumerate(signed)}
    for e in edges:  # a link joins members of one class, here tested by the classes below
        assert e["a"] in at and e["b"] in at
    up = list(range(len(values)))
    def find(i):
        while up[i] != i:
            i = up[i]
        return i
    for e in edges:
        a, b = sorted((find(at[e["a"]]), find(at[e["b"]])))
        up[b] = a
    assert [find(i) for i in range(len(values))] == classes(values, radius)


def test_near_matches_popcount():
    rng = np.random.default_rng(4)
    lanes = rng.integers(0, 1 << 63, 200, dtype=np.uint64)
    lanes[50:120] = lanes[3] ^ (np.uint64(1) << rng.integers(0, 64, 70, dtype=np.uint64))
    queries = lanes[:60]
    hits = set()
    padded = np.concatenate([lanes, np.zeros(56, np.uint64)])[None, :]
    for row, query, lane in simhash._hits(queries[None, :], padded, np.array([200]), 4, 0):
        hits |= set(zip(query.tolist(), lane.tolist()))
    expected = {(q, l) for q in range(60) for l in range(200)
                if np.bitwise_count(queries[q] ^ lanes[l]) <= 4}
    assert hits == expected


def test_documents_against_brute_force(spark):
    rng = random.Random(8)
    base = [" ".join(rng.choice(LONG[:5000].split()) for _ in range(300)) for _ in range(30)]
    texts = AWKWARD + base + [b + " tail" for b in base] + base[:10]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    found = simhash.near_duplicates(documents(spark, [(i, t, None, None) for i, t in rows]))
    got = {r["doc_id"]: (r["fp"] & (1 << 64) - 1, r["component_id"]) for r in found.collect()}
    fps = [slow_fingerprint(t) for t in texts]
    assert got == {i: (fps[i], c) for i, c in enumerate(classes(fps, 4))}
    left = simhash.drop_near_copies(plain(spark, texts))
    assert {r["doc_id"] for r in left.collect()} == set(classes(fps, 4))


def test_null_and_equal_ids(spark):
    texts = [(None, "a b c d"), (3, "a b c d"), (3, "a b c d"), (None, "q")]
    df = documents(spark, [(i, t, None, None) for i, t in texts])
    got = sorted(((r["doc_id"], r["component_id"]) for r in simhash.near_duplicates(df).collect()), key=str)
    assert got == [(3, 3), (3, 3), (None, 3), (None, None)]
    assert simhash.drop_near_copies(df).count() == 2


def test_empty_table(spark):
    df = plain(spark, [])
    assert simhash.near_duplicates(df).collect() == []
    assert simhash.drop_near_copies(df).collect() == []


def test_components_of_chains_and_stars(spark):
    rng = random.Random(2)
    chain = [(i, i + 1) for i in range(40)]
    star = [(1000, 1001 + i) for i in range(30)]
    ring = [(2000 + i, 2000 + (i + 1) % 17) for i in range(17)]
    edges = [(a, b) if rng.random() < 0.5 else (b, a) for a, b in chain + star + ring] + [(5, 5), (0, 1)]
    rng.shuffle(edges)
    found = components(spark.createDataFrame(edges, "a long, b long"))
    got = {r["node"]: r["root"] for r in found.collect()}
    expected = {i: 0 for i in range(41)} | {1000 + i: 1000 for i in range(31)} | {2000 + i: 2000 for i in range(17)}
    assert got == expected


def test_a_star_is_one_component(spark):
    """A centre with 20,000 leaves, one of which has leaves of its own; the centre is not the least."""
    leaves = spark.range(20_000).select((F.col("id") + 1000).alias("a"), F.lit(500).cast("long").alias("b"))
    more = spark.range(100).select(F.lit(1007).cast("long").alias("a"), F.col("id").alias("b"))
    pair = spark.createDataFrame([(90_000, 90_001)], "a long, b long")
    found = {r["node"]: r["root"] for r in components(leaves.unionByName(more).unionByName(pair)).collect()}
    assert len(found) == 20_103
    assert {n: r for n, r in found.items() if r} == {90_000: 90_000, 90_001: 90_000}


def test_a_star_is_spread_over_tasks(spark, monkeypatch):
    """The join of a star's edges with the least neighbours: no task has five times the median's rows."""
    from playmetrics.llm import components as module
    sizes = []
    join = module.spread_join

    def seen(many, few, key):
        found = join(many, few, key)
        counts = found.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()
        sizes.append(sorted(r["n"] for r in counts))
        return found

    monkeypatch.setattr(module, "spread_join", seen)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false",
        "spark.sql.shuffle.partitions": "20",
    }
    edges = spark.range(20_000).select((F.col("id") + 1).alias("a"), F.lit(0).cast("long").alias("b"))
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        assert components(edges).select("root").distinct().collect()[0]["root"] == 0
    finally:
        for name in settings:
            spark.conf.unset(name)
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    large = [s for s in sizes if sum(s) >= 20_000]
    assert large and all(len(s) == 20 and s[-1] <= 5 * s[10] for s in large)
