"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

Sources get weights by their rank in code point order, null last, and share a budget of words.
A target stops at ``MAX_EPOCHS`` times its source's size; what lies above is shared anew by weight.
Seats are blocks of ``BLOCK_WORDS`` words; sources whose target is less than ``LEAST_BLOCKS`` of those have
blocks half as long, or a quarter, and so on down to single words. The number of blocks of one length is
fixed by the targets of the sources that share it, and they go to those sources by the highest quotients
target / (2k - 1). A source's blocks go to its shards the same way, by the shards' sizes. In a shard the
documents lie in seeded order, end to end; cut into blocks,
each block is taken ``quota div blocks`` times, and the remainder falls on blocks that a seeded
permutation puts first. The mix consists of pieces of documents, some taken more than once.

Every decision depends on ids and sizes only, so reruns agree. Words are runs of characters other
than ASCII white space. A source has a shard for every ``SHARD_DOCS`` documents; a shard's sizes, not its
texts, are sorted by one task, and one row a shard of a source. Driver and
broadcasts see no document: sources are a table of their own, and the driver gets their sums.

Nulls and edge cases: a null text has no words. Null is a source, the last in order. Null ids lie
first in seeded order; rows with the same id lie next to each other. Sources without words get
nothing. An empty table gives no rows. A very long text is counted, and cut, whole by one task; it may be
larger than a block or a shard. The number of a row, for columns with clashing names, is
kept in an unused name.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from playmetrics.llm.frames import give_back_memory, unused_name
from playmetrics.operators.ordering import with_position
from playmetrics.storage import store

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_EPOCHS = 2
BLOCK_WORDS = 128
# Blocks that a target has at least, unless they would be shorter than a word.
LEAST_BLOCKS = 32
SHARD_DOCS = 1000
SEED = "mix-1"
# Fixed value: a prime above any number of blocks in a shard, so that it permutes them.
STRIDE = 2_147_483_647

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def seeded(seed: str, doc_id: Column) -> Column:
    """A number from the seed and an id: the first 15 hex digits of an MD5."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """``doc_id, source, size`` of every row, stored."""
    narrow = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        F.col(text_col).cast("binary").alias("text"),
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [len((t.as_py() or b"").split()) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64())],
                names=["doc_id", "source", "size"],
            )
        give_back_memory()

    schema = T.StructType([
        T.StructField("doc_id", narrow.schema["doc_id"].dataType),
        T.StructField("source", T.StringType()),
        T.StructField("size", T.LongType()),
    ])
    return store(narrow.mapInArrow(run, schema))


def targets(
    sources: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    max_epochs: int = MAX_EPOCHS,
) -> DataFrame:
    """``sources`` (``source, source_size, docs``) with ``number``, ``weight`` and ``target``, stored.

    Targets are weight times a common level, or the limit. The level rises as sources reach
    theirs; it takes as many sums over the sources as sources reach their limit in turns.
    """
    ranked = with_position(sources, [F.asc_nulls_last("source")])
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    weight = F.element_at(cycle, ((F.col("position") - 1) % len(weights) + 1).cast("int"))
    table = store(ranked.withColumn("weight", weight).withColumnRenamed("position", "number"))
    limit = F.col("source_size") * F.lit(max_epochs)
    level, full = 0.0, -1
    while True:
        above = F.col("weight") * F.lit(level) > limit
        sums = table.agg(
            F.sum("source_size").alias("words"),
            F.count_if(above).alias("full"),
            F.sum(F.when(above, limit)).alias("taken"),
            F.sum(F.when(~above, F.col("weight"))).alias("weight"),
        ).first()
        if sums["full"] == full or not sums["words"] or not sums["weight"]:
            break
        full = sums["full"]
        level = (share * sums["words"] - (sums["taken"] or 0)) / sums["weight"]
    return table.withColumn(
        "target", F.least(F.col("weight") * F.lit(level), limit.cast("double"))
    )


def quotas(parties: DataFrame, max_epochs: int) -> DataFrame:
    """Blocks for the parties of each house by Sainte-Lague, summing to its ``seats``.

    ``parties`` has ``house, party, votes, house_votes, seats, blocks``. Rounding gives nearly all seats; the
    few that are left over or too many go to the next highest, or from the lowest quotients. No
    party gets more than ``max_epochs`` times its blocks.

    Only seats that can change hands are listed. If all quotients were divided by a common number until the
    seats add up, that number would differ from one by no more than (seats left over + parties) / seats,
    which limits each party's changes to that share of its seats, and one more.
    """
    whole = lambda c: F.col(c).cast("decimal(38,0)")
    exact = isinstance(parties.schema["votes"].dataType, T.IntegralType)
    share = F.col("votes") / F.col("house_votes") * F.col("seats")
    rounded = F.floor(share + F.lit(0.5)) if not exact else _div(
        whole("votes") * F.col("seats") * 2 + whole("house_votes"), whole("house_votes") * 2
    )
    most = F.col("blocks") * max_epochs
    first = parties.where(F.col("votes") > 0).withColumn("base", F.least(rounded, most))
    per_house = Window.partitionBy("house")
    free = F.sum(F.when(F.col("base") < most, share)).over(per_house)
    off = (
        first.withColumn("off", F.col("seats") - F.sum("base").over(per_house))
        .withColumn("parties", F.count(F.lit(1)).over(per_house))
        .withColumn("free", free)
    )
    up = F.col("off") > 0
    change = (F.abs("off") + F.col("parties")) / F.when(up, F.col("free")).otherwise(F.col("seats"))
    steps = F.least(F.abs("off"), F.coalesce(F.floor(share * change), F.lit(0)) + 2)
    moved = off.where(F.col("off") != 0).select(
        "*", F.explode(F.sequence(F.lit(1).cast("long"), steps.cast("long"))).alias("k")
    )
    seat = F.when(up, F.col("base") + F.col("k")).otherwise(F.col("base") - F.col("k") + 1)
    possible = moved.withColumn("seat", seat).where((F.col("seat") >= 1) & (F.col("seat") <= most))
    quotient = F.col("votes") / (F.col("seat") * 2 - 1)
    order = [
        F.when(up, -quotient).otherwise(quotient),
        F.when(up, F.col("party")).otherwise(-F.col("party")), "seat",
    ]
    chosen = (
        possible.withColumn("place", F.row_number().over(per_house.orderBy(*order)))
        .where(F.col("place") <= F.abs("off"))
        .groupBy("house", "party")
        .agg(F.sum(F.when(up, 1).otherwise(-1)).alias("change"))
    )
    return first.join(chosen, ["house", "party"], "left").select(
        "house", "party", "blocks",
        (F.col("base") + F.coalesce("change", F.lit(0))).alias("quota"),
    )


def _blocks(words: Column, width: Column) -> Column:
    return _div(words.cast("long") + width - F.lit(1), width)


def source_seats(sources: DataFrame, block_words: int, max_epochs: int) -> DataFrame:
    """``sources`` (``number, source_size, target, ...``) with ``width`` and ``seats``.

    Sources of one block length are a house; its seats are what their targets come to together.
    """
    lengths = [block_words >> k for k in range(block_words.bit_length())]
    fitting = F.filter(
        F.array(*[F.lit(n).cast("long") for n in lengths]), lambda n: n * LEAST_BLOCKS <= F.col("target")
    )
    sized = sources.withColumn("width", F.coalesce(F.get(fitting, F.lit(0)), F.lit(lengths[-1]).cast("long")))
    same = Window.partitionBy("width")
    parties = sized.select(
        F.col("width").alias("house"), F.col("number").alias("party"), F.col("target").alias("votes"),
        F.sum("target").over(same).alias("house_votes"),
        F.floor(F.sum("target").over(same) / F.col("width") + F.lit(0.5)).alias("seats"),
        _blocks(F.col("source_size"), F.col("width")).alias("blocks"),
    )
    given = quotas(parties, max_epochs).select(F.col("party").alias("number"), F.col("quota").alias("seats"))
    return sized.join(given, "number", "left").withColumn("seats", F.coalesce("seats", F.lit(0)))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    max_epochs: int = MAX_EPOCHS,
    block_words: int = BLOCK_WORDS,
    seed: str = SEED,
    hashed: Column | None = None,
) -> DataFrame:
    """One row per document: ``doc_id, size, source, source_size, target, pieces, taken``.

    ``pieces`` are (first, after, times): word ranges of the document and how often the mix has
    them; ``taken`` is their total. ``hashed`` may replace the seeded number of ``doc_id``. Calling
    this runs jobs and stores small tables.
    """
    sizes = sized(docs, id_col, text_col, source_col)
    order = seeded(seed, F.col("doc_id")) if hashed is None else hashed
    sources = targets(
        sizes.groupBy("source").agg(
            F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs")
        ),
        weights, share, max_epochs,
    )
    n_shards = F.ceil(F.col("docs") / F.lit(SHARD_DOCS))
    plans = store(source_seats(sources, block_words, max_epochs).select(
        F.col("source").alias("_source"), "number", "source_size", "target", "width", "seats",
        n_shards.alias("n_shards"),
    ))
    placed = (
        sizes.withColumn("order", order)
        .join(plans, F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("shard", F.pmod(F.col("order"), F.col("n_shards")))
        .drop("_source")
    )
    totals = placed.groupBy("number", "shard").agg(
        F.sum("size").alias("votes"),
        F.first("source_size").alias("house_votes"),
        F.first("seats").cast("long").alias("seats"),
        F.first("width").alias("width"),
    ).withColumn("blocks", _blocks(F.col("votes"), F.col("width")))
    shards = store(
        quotas(totals.withColumnRenamed("number", "house").withColumnRenamed("shard", "party"), max_epochs)
        .select(F.col("house").alias("number"), F.col("party").alias("shard"), "blocks", "quota")
    )
    before = (
        Window.partitionBy("number", "shard")
        .orderBy("order", F.asc_nulls_first("doc_id"), "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    begin = F.coalesce(F.sum("size").over(before), F.lit(0))
    laid = placed.withColumn("begin", begin).join(shards, ["number", "shard"], "left")

    width = F.col("width")
    start, end = F.col("begin"), F.col("begin") + F.col("size")
    offset = F.pmod(F.col("shard") * F.lit(31) + F.lit(7), F.col("blocks"))

    def piece(block: Column) -> Column:
        place = F.pmod(block * F.lit(STRIDE).cast("long") + offset, F.col("blocks"))
        extra = place < F.col("quota") % F.col("blocks")
        times = _div(F.col("quota"), F.col("blocks")) + F.when(extra, 1).otherwise(0)
        return F.struct(
            (F.greatest(block * width, start) - start).alias("first"),
            (F.least((block + 1) * width, end) - start).alias("after"),
            times.alias("times"),
        )

    blocks = F.sequence(_div(start, width), _div(end - 1, width))
    pieces = F.when(F.col("size") > 0, F.filter(F.transform(blocks, piece), lambda p: p["times"] > 0))
    return laid.withColumn("pieces", F.coalesce(pieces, F.array())).select(
        "doc_id", "size", "source", "source_size", "target", "pieces",
        F.aggregate(
            "pieces", F.lit(0).cast("long"),
            lambda total, p: total + (p["after"] - p["first"]) * p["times"],
        ).alias("taken"),
    )


def cut(text: str, pieces: Sequence[dict]) -> list[str]:
    """The copies of a text that the mix has: one text per repetition, its ranges on lines."""
    raw = text.encode("utf-8")
    spans = [m.span() for m in _WORD.finditer(raw)]
    copies = []
    for copy in range(max(p["times"] for p in pieces)):
        ranges: list[list[int]] = []
        for p in pieces:
            if p["times"] > copy:
                if ranges and ranges[-1][1] == p["first"]:
                    ranges[-1][1] = p["after"]
                else:
                    ranges.append([p["first"], p["after"]])
        if ranges == [[0, len(spans)]]:
            copies.append(text)
        else:
            copies.append("\n".join(
                raw[spans[a][0]:spans[b - 1][1]].decode("utf-8") for a, b in ranges
            ))
    return copies


def mixed_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    chars_col: str | None = None,
    **settings,
) -> DataFrame:
    """The mix as documents: the columns of ``docs``, one row per copy, texts cut to their pieces.

    ``chars_col`` names a column that is to hold the length of the text. ``docs`` is stored once
    with a number per row.
    """
    number, chosen = unused_name(docs, "_row"), unused_name(docs, "_pieces")
    numbered = store(docs.withColumn(number, F.monotonically_increasing_id()))
    key = unused_name(numbered, "_key")
    keyed = numbered.withColumn(key, F.struct(F.col(id_col).alias("id"), F.col(number).alias("row")))
    order = seeded(settings.pop("seed", SEED), F.col("doc_id.id"))
    found = mix(keyed, key, text_col, source_col, hashed=order, **settings)
    taken = found.where(F.col("taken") > 0).select(
        F.col("doc_id.row").alias(number), F.col("pieces").alias(chosen)
    )
    rows = numbered.join(taken, number).select(*docs.columns, chosen)
    names = docs.columns
    at = names.index(text_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            picked, texts = [], []
            for i, (text, pieces) in enumerate(zip(batch.column(at), batch.column(len(names)))):
                copies = cut(text.as_py(), pieces.as_py())
                picked += [i] * len(copies)
                texts += copies
            columns = [c.take(pa.array(picked, pa.int64())) for c in batch.columns[:-1]]
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=names)
        give_back_memory()

    mixed = rows.mapInArrow(run, docs.schema)
    if chars_col is not None:
        mixed = mixed.withColumn(
            chars_col, F.length(text_col).cast(docs.schema[chars_col].dataType)
        )
    return mixed
