"""Merkle manifest of a dataset, with a persistent tree that copies paths.

Each row is a leaf: the SHA-256 of its columns. Within a source the leaves ascend by id; every
``WIDTH`` consecutive nodes are hashed into one until one is left, the source's subroot, and the subroots,
by source, lead to the root in the same way.

The tree is cut into aligned blocks of ``LEVELS`` levels, the leaves below one node of a higher level. A
block's nodes are made by one task from its leaves, then the blocks' top nodes are the leaves of the next
tier of blocks, and so on; every tier is ``WIDTH ** LEVELS`` times smaller than the one below, and the sources'
subroots are tiers of their own on top.

A changed leaf makes a version of the tree. It shares all nodes but the leaf's ancestors, which alone are
copied: within the leaf's block first, in the task that holds the block; then it goes on in the
tiers above, whose nodes beside the path every lowest block is given beforehand. So all
versions are made where their leaves are, and the versions that change one upper block, the root's
in the end all of them, never meet in a task.

Nulls and edge cases: a null column counts as ``-``, any other value as the number of its UTF-8 bytes, a
colon, and the value, so null and empty text differ. Null sources and ids come first. Rows with
the same id lie next to each other by digest; equal rows have equal leaves, and their order among
themselves shows in nothing but their proofs. A single leaf is its subroot, a single subroot the root.
An empty table gives no rows and has no root. Only the named columns are read, whatever others are
called. A text is held whole by one task, in Spark's own expressions.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from playmetrics.operators.ordering import with_position
from playmetrics.storage import store

# Children of a node, and levels of a block: 729 leaves.
WIDTH = 3
LEVELS = 6
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")

# the nodes beside a path, from below: those to the left and those to the right, as joined digests
_STEPS = "array<struct<left:string,right:string>>"


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def part(value: Column) -> Column:
    """What a leaf's digest takes in for one column."""
    text = value.cast("string")
    sized = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    return F.coalesce(sized, F.lit("-"))


def leaf(columns: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*map(part, columns)), 256)


class Block:
    """A block's original nodes by level, and versions of it that share them."""

    def __init__(self, leaves: Sequence[str], whole: bool, levels: int = LEVELS):
        """``whole`` says that the tree ends in this block; then it ends where one node is left."""
        self.nodes = [list(leaves)]
        while len(self.nodes) <= levels and not (whole and len(self.nodes[-1]) == 1):
            below = self.nodes[-1]
            self.nodes.append([
                sha256("".join(below[i:i + WIDTH])) for i in range(0, len(below), WIDTH)
            ])

    @property
    def top(self) -> str:
        return self.nodes[-1][0]

    def beside(self, at: int) -> list[tuple[str, str]]:
        """The nodes beside the path from a leaf to the top: to the left and right, level by level."""
        found = []
        for level in self.nodes[:-1]:
            first = at - at % WIDTH
            found.append(("".join(level[first:at]), "".join(level[at + 1:first + WIDTH])))
            at //= WIDTH
        return found

    def version(self, at: int, changed: str) -> list[str]:
        """The nodes that a version does not share: the changed leaf, then its ancestors' copies."""
        return copied(changed, self.beside(at))


def copied(changed: str, beside: Iterable[tuple[str, str]]) -> list[str]:
    """The nodes on a path, from a changed one upwards, between the nodes beside it."""
    path = [changed]
    for left, right in beside:
        path.append(sha256(left + path[-1] + right))
    return path


def _shape(levels: int) -> int:
    return WIDTH ** levels


def _blocks(nodes: DataFrame, levels: int) -> DataFrame:
    """``nodes`` (tree, position, nodes, hash) with the block each belongs to."""
    width = F.lit(_shape(levels)).cast("long")
    return nodes.withColumn("block", F.call_function("div", F.col("position"), width))


def _in_order(group: pa.Table) -> tuple[pa.Table, Block]:
    group = group.sort_by("position")
    levels = int(group.column("levels")[0].as_py())
    whole = group.column("nodes")[0].as_py() <= _shape(levels)
    return group, Block(group.column("hash").to_pylist(), whole, levels)


def _tops(nodes: DataFrame, levels: int) -> DataFrame:
    """The top node of every block, as the nodes of the tier above."""
    def run(group: pa.Table) -> pa.Table:
        _, block = _in_order(group)
        head = {c: group.column(c)[0].as_py() for c in ("tree", "block", "nodes")}
        return pa.table({
            "tree": pa.array([head["tree"]], pa.int64()),
            "position": pa.array([head["block"]], pa.int64()),
            "nodes": pa.array([-(-head["nodes"] // _shape(levels))], pa.int64()),
            "hash": [block.top],
        })

    needed = _blocks(nodes, levels).select(
        "tree", "position", "nodes", "hash", "block", F.lit(levels).alias("levels")
    )
    return needed.groupBy("tree", "block").applyInArrow(
        run, "tree long, position long, nodes long, hash string"
    )


def _beside(nodes: DataFrame, levels: int) -> DataFrame:
    """Every node with the nodes beside its path within its block."""
    def run(group: pa.Table) -> pa.Table:
        ordered, block = _in_order(group)
        paths = [
            [{"left": left, "right": right} for left, right in block.beside(at)]
            for at in range(ordered.num_rows)
        ]
        kind = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
        return pa.table({
            "tree": ordered.column("tree"), "position": ordered.column("position"),
            "block": ordered.column("block"), "steps": pa.array(paths, kind),
        })

    needed = _blocks(nodes, levels).select(
        "tree", "position", "nodes", "hash", "block", F.lit(levels).alias("levels")
    )
    return needed.groupBy("tree", "block").applyInArrow(
        run, f"tree long, position long, block long, steps {_STEPS}"
    )


def _tiers(leaves: DataFrame, largest: int, levels: int) -> list[DataFrame]:
    """The tiers of blocks' top nodes above ``leaves``, up to one node for each tree; stored."""
    tiers = []
    while True:
        leaves = store(_tops(leaves, levels))
        tiers.append(leaves)
        largest = -(-largest // _shape(levels))
        if largest <= 1:
            return tiers


def _paths(tiers: Sequence[DataFrame], levels: int) -> DataFrame:
    """Nodes of the lowest of ``tiers`` with all nodes beside their path up to the tree's last."""
    steps = tiers[-1].select("tree", "position", F.array().cast(_STEPS).alias("path"))
    for nodes in reversed(tiers[:-1]):
        above = steps.withColumnRenamed("position", "block").withColumnRenamed("path", "above")
        steps = _beside(nodes, levels).join(above, ["tree", "block"]).select(
            "tree", "position", F.concat("steps", "above").alias("path")
        )
    return steps


def _placed(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``leaves`` with ``tree``, their source's number, and ``position`` in it; and the sources.

    Global positions come from a range-partitioned sort by source, id and leaf, so that a source
    with most of the rows is spread over the sort partitions. A source's first position is taken
    from an aggregate, and joined; the join has one row a source on its other side, so Spark
    broadcasts it or splits what is skewed.
    """
    order = [
        F.asc_nulls_first("source"), F.asc_nulls_first("doc_id"), F.asc("leaf"), F.asc("row"),
    ]
    ranked = store(with_position(leaves, order))
    sources = store(
        with_position(
            ranked.groupBy("source").agg(
                F.min("position").alias("first"), F.count(F.lit(1)).alias("nodes")
            ),
            [F.asc_nulls_first("source")],
            total="trees",
        ).select(
            F.col("source").alias("_source"), "first", "nodes", "trees",
            (F.col("position") - 1).alias("tree"),
        )
    )
    return ranked.join(sources, F.col("source").eqNullSafe(F.col("_source"))).select(
        *leaves.columns, "tree", (F.col("position") - F.col("first")).alias("position"), "nodes",
    ), sources


def manifest(
    docs: DataFrame,
    tampered: Column | None = None,
    changed: dict[str, Column] | None = None,
    id_col: str = "doc_id",
    source_col: str = "source",
    columns: Sequence[str] = COLUMNS,
    levels: int = LEVELS,
) -> DataFrame:
    """Every row's leaf, proof and the root, and the version of the tree its change makes.

    Where ``tampered`` holds, the columns in ``changed`` have the values given there; such a row makes a
    version, and others none. Returned are ``doc_id, source, position, leaf, subroot, root, proof``
    (the nodes beside the path, from below), ``copies`` (the version's own nodes from its leaf to
    its root; null without a version) and ``folded_root``: the version's root, or else what the
    leaf and its proof lead to. Calling this runs jobs and stores tables; a row in those has digests only.
    """
    if columns[0] != id_col or source_col not in columns:
        raise ValueError("the columns must start with the id and contain the source")
    given = {c: F.col(c) for c in columns}
    other = F.when(
        tampered if tampered is not None else F.lit(False), leaf([*(given | (changed or {})).values()])
    )
    own = leaf([*given.values()])
    leaves = store(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
        own.alias("leaf"), other.alias("other"), F.monotonically_increasing_id().alias("row"),
    ))
    placed, sources = _placed(leaves)
    most = sources.agg(F.max("nodes").alias("nodes"), F.max("trees").alias("trees")).first()
    nodes = placed.withColumnRenamed("leaf", "hash")
    tiers = _tiers(nodes.select("tree", "position", "nodes", "hash"), most["nodes"] or 0, levels)
    subroots = tiers[-1].select(
        F.lit(0).cast("long").alias("tree"), F.col("tree").alias("position"),
        F.lit(most["trees"] or 0).cast("long").alias("nodes"), "hash",
    )
    tops = _tiers(subroots, most["trees"] or 0, levels)
    root = tops[-1].select(F.col("hash").alias("root"))
    # a source's path to the root, then a lowest block's path to its subroot and on
    ends = _paths([subroots, *tops], levels).withColumnRenamed("path", "above")
    ends = ends.join(subroots.select("position", "hash"), "position").select(
        F.col("position").alias("tree"), "above", F.col("hash").alias("subroot")
    )
    blocks = store(
        _paths(tiers, levels).join(ends, "tree")
        .crossJoin(F.broadcast(root))  # one row
        .select(
            "tree", F.col("position").alias("block"), F.concat("path", "above").alias("path"),
            "subroot", "root",
        )
    )
    kind = leaves.schema["doc_id"].dataType

    def finish(key: tuple, group: pa.Table, ends: pa.Table) -> pa.Table:
        ordered, block = _in_order(group)
        end = {c: ends.column(c)[0].as_py() for c in ("path", "subroot", "root")}
        upper = [(s["left"], s["right"]) for s in end["path"]]
        rows = {"proof": [], "copies": [], "folded_root": []}
        hashes = ordered.column("hash").to_pylist()
        for at, (own, other) in enumerate(zip(hashes, ordered.column("other").to_pylist())):
            path = block.beside(at) + upper
            copies = None
            if other is not None:
                copies = block.version(at, other)
                copies += copied(copies[-1], upper)[1:]
            rows["proof"].append("".join(left + right for left, right in path))
            rows["copies"].append(copies)
            rows["folded_root"].append(copies[-1] if copies else copied(own, path)[-1])
        same = lambda name: pa.array([end[name]] * ordered.num_rows, pa.string())
        return pa.table({
            "doc_id": ordered.column("doc_id"), "source": ordered.column("source"),
            "position": ordered.column("position"), "leaf": ordered.column("hash"),
            "subroot": same("subroot"), "root": same("root"),
            "proof": pa.array(rows["proof"], pa.string()),
            "copies": pa.array(rows["copies"], pa.list_(pa.string())),
            "folded_root": pa.array(rows["folded_root"], pa.string()),
        })

    dealt = _blocks(nodes, levels).withColumn("levels", F.lit(levels))
    return dealt.groupBy("tree", "block").cogroup(blocks.groupBy("tree", "block")).applyInArrow(
        finish,
        T.StructType([
            T.StructField("doc_id", kind),
            *[T.StructField(c, T.LongType() if c == "position" else T.StringType())
              for c in ("source", "position", "leaf", "subroot", "root", "proof")],
            T.StructField("copies", T.ArrayType(T.StringType())),
            T.StructField("folded_root", T.StringType()),
        ]),
    )
