"""Where the four tables come from: Parquet folders, a catalog schema, or the supplied files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playmetrics.schema import TABLES, GameTables


def from_parquet(
    spark: SparkSession, folder: str, unique_transactions: bool | None = None
) -> GameTables:
    """``users``, ``race``, ``items`` and ``events`` as Parquet below ``folder``."""
    found = {t: spark.read.parquet(f"{folder}/{t}") for t in TABLES}
    return GameTables(**found, unique_transactions=unique_transactions)


def from_catalog(
    spark: SparkSession, schema: str, unique_transactions: bool | None = None
) -> GameTables:
    """The four tables of a catalog schema."""
    found = {t: spark.table(f"{schema}.{t}") for t in TABLES}
    return GameTables(**found, unique_transactions=unique_transactions)


# How the supplied events are spread over time, so that players differ in how often they buy.
START, SLOWEST = "2024-01-01", 7


def _read(spark: SparkSession, folder: str, name: str, columns: str) -> DataFrame:
    return spark.read.schema(columns).parquet(f"{folder}/{name}.parquet")


def from_supplied(spark: SparkSession, folder: str) -> GameTables:
    """The supplied star schema seen as game tables. Every row of every file is used.

    Customers are players, nations are races (the ones in region 4 unnamed), parts are
    items. HOUSEHOLD customers hide their race. Each event is a purchase: a sign-up is made by
    a guest who is no player, an error costs nothing, and a view has no amount. Some users are
    slower than others: their days since ``START`` count up to ``SLOWEST`` hundredfold.
    """
    customer = _read(
        spark, folder, "customer", "c_custkey long, c_nationkey int, c_mktsegment string"
    )
    segment = F.col("c_mktsegment")
    users = customer.select(
        F.col("c_custkey").alias("id"),
        F.when(segment.isin("AUTOMOBILE", "BUILDING"), 1).otherwise(0).alias("payer"),
        F.when(segment != "HOUSEHOLD", F.col("c_nationkey")).alias("race_id"),
    )
    nation = _read(spark, folder, "nation", "n_nationkey int, n_name string, n_regionkey int")
    race = nation.select(
        F.col("n_nationkey").alias("race_id"),
        F.when(F.col("n_regionkey") != 4, F.col("n_name")).alias("race"),
    )
    part = _read(spark, folder, "part", "p_partkey long, p_name string")
    items = part.select(F.col("p_partkey").alias("item_code"), F.col("p_name").alias("game_items"))
    event = _read(
        spark, folder, "events",
        "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, "
        "props string",
    )
    kind, user = F.col("event_type"), F.col("user_id")
    days = F.datediff(F.to_date("ts"), F.lit(START)) * (user % SLOWEST).cast("int") * 100
    events = event.select(
        F.col("event_id").alias("transaction_id"),
        F.when(kind == "signup", -1 - user).otherwise(user).alias("id"),
        (F.col("ts") + F.make_dt_interval(days)).alias("date"),
        F.when(kind == "error", 0.0).when(kind != "view", F.col("value")).alias("amount"),
        F.get_json_object("props", "$.k").cast("long").alias("item_code"),
    )
    return GameTables(users=users, race=race, items=items, events=events)
