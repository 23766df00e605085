"""Selection by narrowing against sorted values, and what its rounds may look like."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from playmetrics.operators import selection
from playmetrics.operators.selection import count_buckets, lower_median, value_at
from playmetrics.plans import purchases
from playmetrics.schema import GameTables
from tests.fixture_data import tables
from tests.test_plans import plan


def values(kind, n, seed=1):
    rng = random.Random(f"{kind}{n}{seed}")
    pick = {
        "tied": lambda: Decimal("1.00"),
        "few": lambda: Decimal(rng.choice(["1", "1", "1", "2", "5"])),
        "many": lambda: Decimal(rng.randint(0, 10**6)).scaleb(-2),
        "nulls": lambda: rng.choice([None, Decimal(3), Decimal(4)]),
        "signs": lambda: Decimal(rng.randint(-10**5, 10**3)).scaleb(-2),
        "outliers": lambda: Decimal(rng.choice([1, 2, 3, 10**9, 10**15 + rng.randint(0, 9)])).scaleb(-2),
        "steep": lambda: Decimal(10 ** rng.randint(0, 16)).scaleb(-2),
    }[kind]
    return [pick() for _ in range(n)]


def middle(found):
    known = sorted(v for v in found if v is not None)
    return known[(len(known) - 1) // 2] if known else None


@pytest.mark.parametrize("kind, n", [
    ("tied", 50), ("few", 77), ("many", 400), ("many", 401), ("nulls", 40), ("many", 1), ("many", 2),
    ("many", 0), ("signs", 301), ("outliers", 200), ("steep", 201),
])
def test_median(spark, kind, n):
    given = values(kind, n)
    df = spark.createDataFrame([(v,) for v in given], "v decimal(20,2)").repartition(5)
    for settings in ({}, {"buckets": 4, "few_rows": 3}, {"buckets": 2, "few_rows": 0}):
        assert lower_median(df, "v", **settings) == middle(given)


@pytest.mark.parametrize("kind", ["decimal(38,18)", "decimal(38,37)", "decimal(20,0)"])
def test_values_that_doubles_cannot_tell_apart(spark, kind):
    """Neighbours in the last place of 38 digits: the last round counts by value."""
    scale = int(kind.split(",")[1].rstrip(")"))
    digits = 38 if scale else 20
    base = 10 ** (digits - 1)
    rng = random.Random(scale)
    given = [Decimal(base + rng.randint(0, 40)).scaleb(-scale) for _ in range(101)] + [Decimal(0)] * 7
    df = spark.createDataFrame([(v,) for v in given], f"v {kind}")
    for settings in ({}, {"buckets": 16, "few_rows": 0}):
        assert lower_median(df, "v", **settings) == middle(given)


def test_doubles(spark):
    rng = random.Random(8)
    given = [rng.lognormvariate(0, 5) * rng.choice([1, -1]) for _ in range(301)]
    df = spark.createDataFrame([(v,) for v in given], "v double")
    assert lower_median(df, "v", buckets=8, few_rows=2) == middle(given)


def test_any_rank(spark):
    given = values("many", 100) + values("few", 50)
    df = spark.createDataFrame([(v,) for v in given], "v decimal(20,2)")
    rows = count_buckets(df, "v", min(given), max(given), 8)
    assert sum(r["rows"] for r in rows) == 150 and [r["bucket"] for r in rows] == sorted(r["bucket"] for r in rows)
    for rank in (1, 2, 75, 149, 150):
        assert value_at(df, "v", rank, rows, 8, 5) == sorted(given)[rank - 1]
    with pytest.raises(ValueError, match="above the number"):
        value_at(df, "v", 151, rows)


def test_all_distinct_amounts_are_counted_in_few_rounds(spark, monkeypatch):
    """Half a million prices, none twice: two rounds of counts, no sort, nothing stored."""
    count = 500_000
    df = spark.range(count).select((F.col("id") * 7 / 100).cast("decimal(18,2)").alias("v"))
    rounds, plans = [], []
    counted = selection.count_buckets

    def seen(df, value, low, high, *rest, **more):
        rows = counted(df, value, low, high, *rest, **more)
        rounds.append(len(rows))
        return rows

    monkeypatch.setattr(selection, "count_buckets", seen)
    assert lower_median(df, "v", few_rows=50) == Decimal((count - 1) // 2 * 7).scaleb(-2)
    assert len(rounds) <= 2 and max(rounds) <= selection.BUCKETS
    by_bucket = df.groupBy(selection.bucket(F.col("v"), Decimal(0), Decimal(35000), 4096)).count()
    assert "Sort" not in plan(by_bucket) and "partial_count" in plan(by_bucket)


def test_the_profile_stores_and_sorts_nothing(spark, monkeypatch):
    from playmetrics import storage
    game = tables(spark)
    events = spark.range(3000).select(
        F.col("id").alias("transaction_id"), F.lit(1).cast("long").alias("id"),
        F.lit(None).cast("timestamp_ntz").alias("date"),
        ((F.col("id") * 37 % 3000 + 1) / 100).cast("decimal(18,2)").alias("amount"),
        F.lit(10).cast("long").alias("item_code"),
    )
    before = storage.drop_stored(spark)
    found = purchases.purchase_amount_profile(GameTables(game.users, game.race, game.items, events)).first()
    assert not storage.drop_stored(spark), before
    assert (found["mid_amount"], found["avg_amount"]) == (Decimal("15.00"), Decimal("15.01"))
    assert found["stddev_amount"] == Decimal("8.66")


def test_the_profile_of_nothing_and_of_one(spark):
    none = tables(spark, events=[])
    assert tuple(purchases.purchase_amount_profile(none).first()) == (0, None, None, None, None, None, None)
    one = tables(spark, events=[(1, 1, None, Decimal("2.50"), 10)])
    found = tuple(purchases.purchase_amount_profile(one).first())
    assert found == (1, *[Decimal("2.50")] * 5, None)
