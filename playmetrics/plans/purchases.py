"""What purchases cost, who makes them, and which items sell."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playmetrics.functions.numeric import NARROW, add_up, amount_of, ratio, total
from playmetrics.operators.distinct import mark, marked, merge
from playmetrics.operators.ordering import with_position
from playmetrics.operators.selection import count_buckets, row_of, value_at
from playmetrics.plans.players import per_player, positive, users_by
from playmetrics.schema import GameTables


def purchase_amount_profile(tables: GameTables) -> DataFrame:
    """Count, sum, extremes, mean, median and sample deviation of positive amounts.

    Calling this runs two jobs and mostly a third one, each a pass over the amounts that moves a few rows a
    task: totals first, then counts by amount, which also sum squares around the rounded mean, and
    more counts if the middle is not found by then.
    """
    scale = tables.amount_scale
    priced = tables.events.where(positive()).select(
        "transaction_id", tables.money().alias("amount")
    )
    amount = F.col("amount")
    totals = priced.agg(
        F.count("transaction_id").alias("count_transaction"),
        total(amount, scale).alias("_sum"),
        F.min("amount").alias("min_amount"),
        F.max("amount").alias("max_amount"),
        F.count("amount").alias("_n"),
    ).select(
        "count_transaction",
        amount_of(F.col("_sum"), scale).alias("sum_amount"),
        "min_amount",
        "max_amount",
        ratio(F.col("_sum"), F.when(F.col("_n") > 0, F.col("_n")), 2, scale).alias("avg_amount"),
        "_n",
    )
    found = totals.first()
    n, low, high = found["_n"], found["min_amount"], found["max_amount"]
    middle, variance = low, 0.0 if n > 1 else None
    if low != high:
        # of wide amounts, whose mean has few digits before the point, a difference keeps its places
        room = 20 if scale <= NARROW else max(39 - scale, 2)
        off = (amount - F.lit(found["avg_amount"]).cast(f"decimal({room + 2},2)")).cast("double")
        rows = count_buckets(priced, "amount", low, high, squares=F.sum(off * off), offset=F.sum(off))
        middle = value_at(priced, "amount", (n + 1) // 2, rows)
        shift = math.fsum(r["offset"] for r in rows)
        squares = math.fsum(r["squares"] for r in rows)
        variance = max((squares - shift * shift / n) / (n - 1), 0.0)
    kinds = dict(totals.dtypes)
    given = {name: (found[name], kinds[name]) for name in totals.columns if name != "_n"}
    result = row_of(priced, given | {
        "mid_amount": (middle, kinds["min_amount"]), "_variance": (variance, "double"),
    })
    # settled at nine decimals, where the order of the sums does not show
    deviation = F.round(F.sqrt("_variance"), 9).cast("decimal(38,12)")
    return result.withColumn("stddev_amount", F.round(deviation, 2)).drop("_variance")


def zero_amount_share(tables: GameTables) -> DataFrame:
    """How many purchases cost nothing. Amounts that are NULL count on neither side."""
    counts = tables.events.agg(
        F.count("amount").alias("count"),
        F.count_if(F.col("amount") == 0).alias("null_amount"),
    )
    return counts.withColumn(
        "share_null_amount", ratio(F.col("null_amount"), F.col("count"), 3)
    )


def activity_by_payer(tables: GameTables, group: str = "payer") -> DataFrame:
    """Purchases and spend per buyer, payers against the rest, or by another column of ``users``.

    Every purchase counts: those of unknown players form the NULL group.
    """
    scale = tables.amount_scale
    spent = per_player(
        tables.events, trans=F.count("transaction_id"), amount=total(tables.money(), scale)
    )
    copies = F.coalesce("copies", F.lit(1))
    groups = (
        spent.join(users_by(tables, group), "id", "left")
        .groupBy(group)
        .agg(
            F.count("id").alias("count_users"),
            F.sum(F.col("trans") * copies).alias("count_trans"),
            add_up(F.col("amount"), scale, copies).alias("_amount"),
        )
    )
    return groups.select(
        group,
        "count_users",
        "count_trans",
        ratio(F.col("count_trans"), F.col("count_users"), 2).alias("avg_trans"),
        ratio(F.col("_amount"), F.col("count_users"), 2, scale).alias("avg_amount"),
    )


def item_shares(tables: GameTables) -> DataFrame:
    """Each listed item's share of purchases and of buyers, without a rank.

    The marks of purchases with an item serve the items and the totals; purchases without one are
    marked apart, through a scan for NULL.
    """
    purchases, known = F.count("transaction_id"), F.col("item_code").isNotNull()
    marks = mark(tables.events.where(known), ["item_code"], "id", purchases=purchases)
    loose = mark(tables.events.where(~known), [], "id", purchases=purchases)
    per_item = marks.groupBy("item_code").agg(
        marked().alias("buyers"), F.sum("purchases").alias("purchases")
    )
    together = marks.drop("item_code").unionByName(loose)
    totals = merge(together, [], purchases=F.sum("purchases")).agg(
        marked().alias("_buyers"), F.coalesce(F.sum("purchases"), F.lit(0)).alias("_purchases")
    )
    listed = tables.items.groupBy("item_code", "game_items").agg(
        F.count(F.lit(1)).alias("copies")
    )
    sold = listed.join(per_item, "item_code", "left").select(
        "item_code",
        "game_items",
        F.coalesce(F.col("purchases") * F.col("copies"), F.lit(0)).alias("count_purchases"),
        F.coalesce("buyers", F.lit(0)).alias("_item_buyers"),
    )
    return sold.crossJoin(F.broadcast(totals)).select(
        "item_code",
        "game_items",
        "count_purchases",
        ratio(F.col("count_purchases"), F.col("_purchases"), 3).alias("relative_purchases"),
        ratio(F.col("_item_buyers"), F.col("_buyers"), 2).alias("relative_count_users"),
    )


def item_popularity(tables: GameTables) -> DataFrame:
    """Listed items by purchases, most purchased first.

    Items never sold stay with zero; purchases of unlisted items only count in the totals. Calling
    this runs a job that stores the sorted items.
    """
    order = [
        F.desc("count_purchases"),
        F.asc_nulls_last("item_code"),
        F.asc_nulls_last("game_items"),
    ]
    placed = with_position(item_shares(tables), order)
    return placed.withColumnRenamed("position", "row_number").orderBy("row_number")
