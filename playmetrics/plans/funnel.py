"""By race: players, those who purchased, those who also pay, and how active they are.

Counts are taken per ``race_id``; race names join the few rows that come out. A race
without a name keeps its player count but matches nothing after that, since NULL equals
nothing, and stages a race never reaches are NULL rather than zero.

Each stage on its own reads what it needs. ``race_stages`` gives several of them from one pass over the
purchases, and ``funnel_by`` has all stages by another column of ``users``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playmetrics.functions.numeric import add_up, ratio, total
from playmetrics.operators.distinct import count_distinct, keep_marked, marked, merge
from playmetrics.operators.skew import spread_join
from playmetrics.plans.players import (
    buyers, per_player, positive, positive_marks, transacting, users_by,
)
from playmetrics.schema import GameTables
from playmetrics.storage import store

RACE_KEY = ["race_id", "race"]


def _name_races(per_race: DataFrame, tables: GameTables) -> DataFrame:
    return per_race.join(tables.race.distinct(), "race_id", "left")


def _count_players(users: DataFrame, tables: GameTables, count: str) -> DataFrame:
    per_race = count_distinct(users, ["race_id"], "id", count)
    return _name_races(per_race, tables).select(*RACE_KEY, count)


def race_all_users(tables: GameTables) -> DataFrame:
    return _count_players(tables.users, tables, "count_all_u")


def player_purchase_counts(tables: GameTables) -> DataFrame:
    """Purchases per registered player, zero included."""
    made = per_player(tables.events, trans=F.count("transaction_id"))
    count = F.coalesce(F.col("trans") * F.col("copies"), F.lit(0))
    return users_by(tables).join(made, "id", "left").select("id", count.alias("count_t"))


def race_purchasers(tables: GameTables) -> DataFrame:
    """Players with a purchase, of whatever amount."""
    users = keep_marked(tables.users, "id", transacting(tables))
    return _count_players(users, tables, "count_purshasing_u")


def race_paying_purchasers(tables: GameTables) -> DataFrame:
    """Payers among the buyers."""
    payers = tables.users.where(F.col("payer") == 1)
    users = keep_marked(payers, "id", buyers(tables))
    return _count_players(users, tables, "count_paying_u")


def _totals(tables: GameTables, group: str = "race_id") -> DataFrame:
    """All counts and sums per ``group`` from a single pass over the purchases.

    A count is NULL where nobody was counted. ``positive`` counts purchases, not distinct ids.
    """
    facts = per_player(
        tables.events.where(F.col("id").isNotNull()),
        transactions=F.count("transaction_id"),
        positive_rows=F.count_if(positive()),
        positive=F.count(F.when(positive(), F.col("transaction_id"))),
        spent=total(F.when(positive(), tables.money()), tables.amount_scale),
    ).withColumn("bought", F.lit(True))
    pays = F.max(F.when(F.col("payer") == 1, True))
    # under a name of its own, so that the payer flag may be the group
    pays_by = users_by(tables, group, pays=pays).withColumnRenamed(group, "_group")
    players = pays_by.join(facts, "id", "left")

    def players_where(condition):
        found = F.count(F.when(condition, F.col("id")))
        return F.when(found > 0, found)

    return players.groupBy("_group").agg(
        F.count("id").alias("count_all_u"),
        players_where(F.col("transactions") > 0).alias("count_purshasing_u"),
        players_where(F.col("pays") & F.col("bought")).alias("count_paying_u"),
        F.sum("positive_rows").alias("positive_rows"),
        F.sum("positive").alias("positive"),
        add_up(F.col("spent"), tables.amount_scale, F.col("copies")).alias("spent"),
    ).withColumnRenamed("_group", group)


def _with_distinct_purchases(
    totals: DataFrame, tables: GameTables, group: str = "race_id"
) -> DataFrame:
    """``positive`` by distinct transaction id, which makes no difference unless ids repeat.

    Only if they do, a job stores the players' marks, and a player with most of them is split.
    """
    if tables.transactions_are_unique():
        return totals
    members = tables.users.select("id", F.col(group).alias("_of")).distinct()
    recount = (
        merge(spread_join(store(positive_marks(tables)), members, "id"), ["_of"])
        .groupBy("_of")
        .agg(marked().alias("recount"))
    )
    # only groups with positive purchases use the count, and a NULL here means zero
    return (
        totals.join(recount, F.col(group).eqNullSafe(F.col("_of")), "left")
        .withColumn("positive", F.coalesce("recount", F.lit(0)))
        .drop("recount", "_of")
    )


def _paying_share(totals: DataFrame, tables: GameTables) -> DataFrame:
    share = ratio(F.col("count_paying_u"), F.col("count_purshasing_u"), 2)
    return _name_races(totals.where(F.col("count_purshasing_u").isNotNull()), tables).select(
        *RACE_KEY, F.when(F.col("race").isNotNull(), share).alias("share_paying_u")
    )


def race_paying_share(tables: GameTables) -> DataFrame:
    """Payers among the purchasers. Races without a name have no share."""
    return _paying_share(_totals(tables), tables)


def _activity_columns(tables: GameTables) -> list[Column]:
    scale = tables.amount_scale
    return [
        ratio(F.col("positive"), F.col("count_purshasing_u"), 2).alias("avg_purshases"),
        ratio(F.col("spent"), F.col("positive"), 2, scale).alias("avg_amount_transaction"),
        ratio(F.col("spent"), F.col("count_purshasing_u"), 2, scale).alias("avg_amount_u"),
    ]


def _activity(totals: DataFrame, tables: GameTables) -> DataFrame:
    races = tables.race.distinct().withColumnRenamed("race_id", "_race_id")
    named = (F.col("race_id") == F.col("_race_id")) & F.col("count_purshasing_u").isNotNull()
    # purchasers are looked up by race_id, so those without one find no count
    known = F.when(F.col("race_id").isNotNull(), F.col("count_purshasing_u"))
    return (
        totals.where(F.col("positive_rows") > 0).join(races, named, "left")
        .withColumn("count_purshasing_u", known)
        .select(*RACE_KEY, *_activity_columns(tables))
    )


def race_activity(tables: GameTables) -> DataFrame:
    """Positive purchases per purchaser, and what one purchase and one purchaser brings."""
    return _activity(_with_distinct_purchases(_totals(tables), tables), tables)


def _side_by_side(named: DataFrame, tables: GameTables, keys: Sequence[str], name: str) -> DataFrame:
    """All stages of totals; groups whose ``name`` is NULL match nothing after the first."""
    known = F.col(name).isNotNull()
    active = F.col("count_purshasing_u").isNotNull() & (F.col("positive_rows") > 0)
    stages = (
        named
        .withColumn("count_purshasing_u", F.when(known, F.col("count_purshasing_u")))
        .withColumn("count_paying_u", F.when(known, F.col("count_paying_u")))
        .withColumn("positive", F.when(active, F.col("positive")))
        .withColumn("spent", F.when(active, F.col("spent")))
    )
    purchasing = F.col("count_purshasing_u")
    return stages.select(
        *keys,
        "count_all_u",
        purchasing,
        ratio(purchasing, F.col("count_all_u"), 2).alias("share_purchasing_u"),
        "count_paying_u",
        ratio(F.col("count_paying_u"), purchasing, 2).alias("share_paying_u"),
        *_activity_columns(tables),
    ).orderBy(F.desc_nulls_first("avg_purshases"), *keys)


def _funnel(totals: DataFrame, tables: GameTables) -> DataFrame:
    return _side_by_side(_name_races(totals, tables), tables, RACE_KEY, "race")


def race_funnel(tables: GameTables) -> DataFrame:
    """All stages side by side, most active race first."""
    return _funnel(_with_distinct_purchases(_totals(tables), tables), tables)


def funnel_by(tables: GameTables, group: str) -> DataFrame:
    """All stages side by side by a column of ``users``, most active group first.

    Any column will do that ``GameTables`` was told to keep in ``user_columns``, and the payer flag and
    ``race_id`` too. Players without a value keep their count, as those of a race without a name.
    """
    totals = _with_distinct_purchases(_totals(tables, group), tables, group)
    return _side_by_side(totals, tables, [group], group)


def _stage_of(count: str) -> Callable[[DataFrame, GameTables], DataFrame]:
    def stage(totals: DataFrame, tables: GameTables) -> DataFrame:
        counted = totals.where(F.col(count).isNotNull()).select("race_id", count)
        return _name_races(counted, tables).select(*RACE_KEY, count)

    return stage


# How each result is taken from the totals.
_STAGES: dict[str, Callable[[DataFrame, GameTables], DataFrame]] = {
    "race_all_users": _stage_of("count_all_u"),
    "race_purchasers": _stage_of("count_purshasing_u"),
    "race_paying_purchasers": _stage_of("count_paying_u"),
    "race_paying_share": _paying_share,
    "race_activity": _activity,
    "race_funnel": _funnel,
}


def race_stages(
    tables: GameTables, names: Sequence[str] = tuple(_STAGES)
) -> dict[str, DataFrame]:
    """The named results, each equal to the function of that name, from one pass over the purchases.

    Calling this runs a job that stores the totals, a row per ``race_id``; the results only read
    those and the names.
    """
    unknown = [name for name in names if name not in _STAGES]
    if unknown:
        raise ValueError(f"no such stages: {', '.join(unknown)}")
    totals = store(_with_distinct_purchases(_totals(tables), tables))
    return {name: _STAGES[name](totals, tables) for name in names}
