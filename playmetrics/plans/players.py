"""Purchases summed per player, and players without copies.

The purchase table is by far the largest. Summing it per player first combines on the map
side, so a player with a third of all rows still sends one row per task, and every later
join moves rows per player instead of per purchase.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playmetrics.operators.distinct import mark
from playmetrics.schema import GameTables


def positive() -> Column:
    """Decided on the amount as stored, so that the filter reaches the scan."""
    return F.col("amount") > 0


def per_player(events: DataFrame, **measures: Column) -> DataFrame:
    return events.groupBy("id").agg(*[m.alias(name) for name, m in measures.items()])


def buyers(tables: GameTables) -> DataFrame:
    """Ids with at least one purchase row, as marks."""
    return mark(tables.events.where(F.col("id").isNotNull()), [], "id")


def transacting(tables: GameTables) -> DataFrame:
    """Ids with at least one purchase that has a transaction id, as marks."""
    known = F.col("id").isNotNull() & F.col("transaction_id").isNotNull()
    return mark(tables.events.where(known), [], "id")


def by_id(users: DataFrame) -> DataFrame:
    """``users`` dealt out by id, which then serves a grouping by more columns and a join by id."""
    return users.repartition("id")


def users_by(tables: GameTables, *columns: str, **measures: Column) -> DataFrame:
    """``users`` with one row per id and ``columns``; ``copies`` says how many it stands for."""
    return by_id(tables.users).groupBy("id", *columns).agg(
        F.count(F.lit(1)).alias("copies"), *[m.alias(name) for name, m in measures.items()]
    )


def positive_marks(tables: GameTables) -> DataFrame:
    """Transaction ids of each player's positive purchases, as marks."""
    known = F.col("id").isNotNull() & F.col("transaction_id").isNotNull()
    return mark(tables.events.where(positive() & known), ["id"], "transaction_id")
