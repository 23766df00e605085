"""How often players buy: days between purchases, and three frequency segments.

Only ``purchase_gaps`` lists single purchases. The days between a player's consecutive
purchases add up to the days from the first to the last, so the mean gap needs neither a
window nor a sort, just the extremes and the count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from playmetrics.functions.numeric import (
    add_fractions, fractions, quotient, ratio, rounded_mean,
)
from playmetrics.operators.distinct import mark, marked, merge
from playmetrics.operators.lag import lag_time
from playmetrics.operators.ordering import tile, with_position
from playmetrics.operators.skew import spread_join
from playmetrics.plans.players import by_id, per_player, positive
from playmetrics.schema import GameTables
from playmetrics.storage import store

# Segment labels, from the smallest to the largest mean gap.
LABELS = ("высокая частота", "умеренная частота", "низкая частота")

MIN_TRANSACTIONS = 25


def purchase_gaps(tables: GameTables) -> DataFrame:
    """Every positive purchase with the player's previous one and the calendar days between."""
    purchases = tables.events.where(positive()).select("transaction_id", "id", "date")
    lagged = lag_time(purchases, "id", "date", "transaction_id", "previous_transaction")
    day, previous_day = F.to_date("date"), F.to_date("previous_transaction")
    return lagged.select(
        "transaction_id",
        "id",
        day.alias("date"),
        "previous_transaction",
        F.datediff(day, previous_day).alias("gap"),
    )


def _stored_marks(tables: GameTables) -> DataFrame | None:
    """Transaction ids of each player's positive purchases with what summaries need; stored.

    Only needed, and only read, where ids may repeat.
    """
    if tables.transactions_are_unique():
        return None
    return store(mark(
        tables.events.where(positive()), ["id"], "transaction_id", **_measures()
    ))


def _measures() -> dict:
    return {
        "rows": F.count(F.lit(1)),
        "_dated": F.count("date"),
        "_first": F.min("date"),
        "_last": F.max("date"),
    }


def _summaries(tables: GameTables, marks: DataFrame | None) -> DataFrame:
    """Per player and payer flag: positive purchases and the mean gap in days.

    ``span / gaps`` is the mean, ``rows`` the purchases it stands for.
    """
    if marks is None:
        players = per_player(
            tables.events.where(positive()),
            count_transactions=F.count("transaction_id"), **_measures(),
        )
    else:
        players = marks.groupBy("id").agg(
            marked().alias("count_transactions"),
            F.sum("rows").alias("rows"),
            F.sum("_dated").alias("_dated"),
            F.min("_first").alias("_first"),
            F.max("_last").alias("_last"),
        )
    gaps = F.when(F.col("_dated") > 1, F.col("_dated") - F.lit(1))
    span = F.datediff(F.to_date("_last"), F.to_date("_first"))
    return (
        players.join(by_id(tables.users.select("id", "payer")).distinct(), "id", "left")
        .select("id", "payer", "count_transactions", "rows", span.alias("span"), gaps.alias("gaps"))
        .withColumn("avg_gap", quotient(F.col("span"), F.col("gaps")))
    )


def player_gap_summary(tables: GameTables) -> DataFrame:
    """Where transaction ids may repeat, calling this runs a job that stores their marks."""
    return _summaries(tables, _stored_marks(tables)).select(
        "id", "payer", "count_transactions", "avg_gap"
    )


def _tiled(
    tables: GameTables, marks: DataFrame | None, min_transactions: int, tiles: int
) -> DataFrame:
    frequent = _summaries(tables, marks).where(F.col("count_transactions") >= min_transactions)
    # a player listed with several payer flags pays if any of them says so
    pays = F.max(F.when((F.col("payer") == 1) & F.col("id").isNotNull(), True))
    frequent = frequent.withColumn("pays", pays.over(Window.partitionBy("id")))
    order = [F.asc_nulls_last("avg_gap"), F.asc_nulls_last("id"), F.asc_nulls_last("payer")]
    placed = with_position(frequent, order, total="players")
    return placed.withColumn("parts_by_gap", tile(F.col("position"), F.col("players"), tiles))


def gap_tiles(
    tables: GameTables, min_transactions: int = MIN_TRANSACTIONS, tiles: int = len(LABELS)
) -> DataFrame:
    """Players with enough purchases in equal tiles, tile 1 buying most often.

    Calling this, or what builds on it below, runs a job that stores the sorted players.
    """
    marks = _stored_marks(tables)
    return _tiled(tables, marks, min_transactions, tiles).select("id", "payer", "avg_gap", "parts_by_gap")


def _labelled(
    tables: GameTables, marks: DataFrame | None, min_transactions: int, labels: Sequence[str]
) -> DataFrame:
    label = F.element_at(F.array(*map(F.lit, labels)), F.col("parts_by_gap").cast("int"))
    return _tiled(tables, marks, min_transactions, len(labels)).withColumn("users_group", label)


def gap_segments(
    tables: GameTables,
    min_transactions: int = MIN_TRANSACTIONS,
    labels: Sequence[str] = LABELS,
) -> DataFrame:
    """The tiles by name."""
    return _labelled(tables, _stored_marks(tables), min_transactions, labels).select(
        "id", "payer", "avg_gap", "users_group"
    )


def segment_paying_players(
    tables: GameTables,
    min_transactions: int = MIN_TRANSACTIONS,
) -> DataFrame:
    """Ids of the players in any segment who pay. No order is needed to find them."""
    players = _summaries(tables, _stored_marks(tables))
    frequent = players.where(F.col("count_transactions") >= min_transactions)
    return frequent.where(F.col("payer") == 1).select("id")


def frequency_segments(
    tables: GameTables,
    min_transactions: int = MIN_TRANSACTIONS,
    labels: Sequence[str] = LABELS,
) -> DataFrame:
    """Per segment: players, payers, purchases per player and the mean gap.

    The mean gap is weighted by purchases: each player's mean counts once per purchase. Days are added up as
    whole numbers for each number of gaps first, so that only a few fractions are left to add.
    """
    marks = _stored_marks(tables)
    segments = _labelled(tables, marks, min_transactions, labels)
    known = F.col("id").isNotNull()
    weight = F.when(F.col("gaps").isNotNull(), F.when(known, F.col("rows")).otherwise(1))
    players = segments.groupBy("users_group", "id").agg(
        F.max(F.when(known, F.col("count_transactions"))).alias("transactions"),
        F.max("pays").alias("pays"),
        F.min("parts_by_gap").alias("part"),
        F.sum(weight).alias("weight"),
    )
    days = F.sum(F.col("span").cast("decimal(10,0)") * weight.cast("decimal(20,0)"))
    by_gaps = segments.where(F.col("gaps").isNotNull()).groupBy("users_group", "gaps").agg(
        days.alias("days")
    )
    means = by_gaps.groupBy("users_group").agg(
        add_fractions(fractions(F.col("days"), F.col("gaps"))).alias("weighted")
    )
    totals = players.groupBy("users_group").agg(
        F.count("id").alias("count_users"),
        F.count("pays").alias("paying_users"),
        F.coalesce(F.sum("transactions"), F.lit(0)).alias("transactions"),
        F.sum("weight").alias("weight"),
        F.min("part").alias("part"),
    ).join(means, "users_group", "left")
    if marks is not None:
        members = segments.where(known).select("id", "users_group").distinct()
        recount = (
            merge(spread_join(marks, members, "id"), ["users_group"])
            .groupBy("users_group")
            .agg(marked().alias("recount"))
        )
        totals = totals.join(recount, "users_group", "left").withColumn(
            "transactions", F.coalesce("recount", F.lit(0))
        )
    users = F.col("count_users")
    return totals.select(
        "users_group",
        users,
        "paying_users",
        ratio(F.col("paying_users"), users, 2).alias("share_paying_users"),
        ratio(F.col("transactions"), users, 2).alias("count_transaction"),
        rounded_mean(F.col("weighted"), F.col("weight")).alias("avg_gap"),
        "part",
    ).orderBy(F.asc_nulls_last("avg_gap"), "part").drop("part")
