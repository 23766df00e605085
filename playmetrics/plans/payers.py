"""Share of paying players, overall and by group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playmetrics.functions.numeric import ratio
from playmetrics.operators.distinct import count_distinct, mark, marked, merge
from playmetrics.schema import GameTables

# The column names of these results, in this and the other modules of this folder.


def payer_share_overall(tables: GameTables) -> DataFrame:
    """Players with a known payer flag, how many pay, and their share."""
    totals = tables.users.agg(
        F.count("payer").alias("all_users"), F.sum("payer").alias("paying_users")
    )
    return totals.withColumn(
        "share_paying_users", ratio(F.col("paying_users"), F.col("all_users"), 2)
    )


def _with_share(groups: DataFrame, group: str) -> DataFrame:
    share = ratio(F.col("paying_users"), F.col("all_users"), 2)
    return groups.withColumn("share_paying_users", share).orderBy(
        F.desc_nulls_first("share_paying_users"), group
    )


def payer_share_by(tables: GameTables, group: str) -> DataFrame:
    """Payers by a column of ``users``; players without a value form the NULL group."""
    paying = F.sum("payer")
    return _with_share(
        count_distinct(tables.users, [group], "id", "all_users", paying_users=paying), group
    )


def payer_share_by_race(tables: GameTables) -> DataFrame:
    """Payers by race name; players of unknown race form the NULL group.

    Players are counted per ``race_id`` first, so that the join with the names, on a key with few
    values, moves no player rows.
    """
    per_id = mark(tables.users, ["race_id"], "id", paying=F.sum("payer"))
    named = per_id.join(tables.race, "race_id", "left")
    by_race = merge(named, ["race"], paying=F.sum("paying")).groupBy("race").agg(
        marked().alias("all_users"), F.sum("paying").alias("paying_users")
    )
    return _with_share(by_race, "race")
