"""The split join against a plain one, and the size of its cells."""

import random

import pytest
from pyspark.sql import functions as F

from playmetrics.operators.skew import spread_join
from playmetrics.plans import frequency, funnel
from playmetrics.schema import GameTables
from tests.compare import _rows
from tests.fixture_data import tables


def sides(spark, count=3000):
    rng = random.Random(count)
    many = [(rng.choice([1, 1, 1, 2, 2, None, *range(10, 200)]), i) for i in range(count)]
    few = [(1, "a"), (1, "b"), (2, "a"), (300, "a"), (None, "n")] + [(i, "c") for i in range(10, 150)]
    return spark.createDataFrame(many, "k long, n long"), spark.createDataFrame(few, "k long, g string")


@pytest.mark.parametrize("cells", [None, 1, 7, 100])
def test_against_a_plain_join(spark, cells):
    many, few = sides(spark)
    key = lambda df: sorted(map(tuple, df.select("k", "n", "g").collect()))
    assert key(spread_join(many, few, "k", cells)) == key(many.join(few, "k"))


def test_text_keys_and_nothing(spark):
    many, few = (df.withColumn("k", F.col("k").cast("string")) for df in sides(spark, 200))
    assert spread_join(many, few, "k").count() == many.join(few, "k").count()
    assert spread_join(many.limit(0), few, "k").count() == 0
    assert spread_join(many, few.limit(0), "k").count() == 0


def tasks_rows(df):
    """Rows by partition, before anything else is done with them."""
    return [r["n"] for r in df.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]


def test_no_task_has_more_than_twice_its_share(spark):
    """A third of the rows has one key; both sides are shuffled and no partitions merged."""
    many = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 5000 + 10).alias("k"), F.col("id").alias("n")
    )
    few = spark.range(6000).select(F.col("id").alias("k"), F.lit("g").alias("g"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        spread, plain = tasks_rows(spread_join(many, few, "k")), tasks_rows(many.join(few, "k"))
    finally:
        for name in settings:
            spark.conf.unset(name)
    assert sum(spread) == sum(plain) == 60_000
    assert max(plain) > 20_000 and len(spread) == 8
    assert max(spread) <= 2 * sum(spread) / len(spread)


@pytest.mark.parametrize("analysis", [frequency.frequency_segments, funnel.race_funnel, funnel.race_activity])
def test_repeated_ids_of_a_busy_player(spark, analysis, monkeypatch):
    """Ids repeat among players; the split join gives what counting distinct ids gives."""
    game = tables(spark)
    events = spark.range(900).select(
        (F.col("id") % 700).alias("transaction_id"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 7).alias("id"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval((F.col("id") % 90).cast("int"))).alias("date"),
        (F.col("id") % 11).cast("decimal(18,2)").alias("amount"), F.lit(10).cast("long").alias("item_code"),
    )
    repeated = GameTables(game.users, game.race, game.items, events)
    assert not repeated.transactions_are_unique()
    own = analysis(repeated)
    module = frequency if analysis is frequency.frequency_segments else funnel
    monkeypatch.setattr(module, "spread_join", lambda many, few, key: many.join(few, key))
    plain = analysis(repeated)
    assert _rows(own.columns, own.collect()) == _rows(plain.columns, plain.collect())
