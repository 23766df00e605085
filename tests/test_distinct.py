"""Marked distinct counts against Spark's own."""

import random

import pytest
from pyspark.sql import functions as F

from playmetrics.operators.distinct import (
    count_distinct, is_unique, keep_marked, mark, marked, merge,
)

TOP = (1 << 63) - 1
EDGES = [-1, 0, 1, 63, 64, -63, -64, -65, TOP, TOP - 1, -TOP, -TOP - 1]


def _frame(spark, seed=4):
    rng = random.Random(seed)
    pick = lambda: rng.choice([None, rng.randint(-200, 200), rng.choice(EDGES)])
    rows = [(rng.choice(["a", "a", "b", None]), pick(), rng.randint(1, 9)) for _ in range(600)]
    return spark.createDataFrame(rows + [("only nulls", None, 3)], "k string, n bigint, v int")


def test_by_key(spark):
    df = _frame(spark).repartition(5)
    ours = count_distinct(df, ["k"], "n", "d", v=F.sum("v"))
    theirs = df.groupBy("k").agg(F.count_distinct("n").alias("d"), F.sum("v").alias("v"))
    assert set(ours.collect()) == set(theirs.collect())


def test_overall(spark):
    df = _frame(spark)
    assert count_distinct(df, [], "n", "d").first() == df.agg(F.count_distinct("n")).first()
    assert count_distinct(df.limit(0), [], "n", "d").first()["d"] == 0


def test_marks_unite_across_keys(spark):
    df = _frame(spark)
    united = merge(mark(df, ["k", "v"], "n"), ["v"]).groupBy("v").agg(marked().alias("d"))
    assert set(united.collect()) == set(df.groupBy("v").agg(F.count_distinct("n")).collect())


@pytest.mark.parametrize("numbers, unique", [
    ([], True), ([None, None], True), ([*EDGES, None, None], True),
    ([TOP, 1, TOP], False), ([-TOP - 1, -TOP - 1], False), ([0, None, 0], False),
])
def test_is_unique(spark, numbers, unique):
    df = spark.createDataFrame([(n,) for n in numbers], "n bigint")
    assert is_unique(df, "n") is unique


def test_semi_join(spark):
    df, wanted = _frame(spark), _frame(spark, seed=9).where("v > 6 AND n IS NOT NULL")
    ours = keep_marked(df, "n", mark(wanted, [], "n"))
    theirs = df.join(wanted, "n", "left_semi").select(*df.columns)
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(ours.collect(), key=key) == sorted(theirs.collect(), key=key)
