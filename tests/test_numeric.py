import random
from decimal import Decimal
from fractions import Fraction

import pytest
from pyspark.errors import ArithmeticException
from pyspark.sql import functions as F

from playmetrics.functions.numeric import (
    add_fractions, add_up, amount_of, fractions, quotient, ratio, rounded_mean, total,
)

SCHEMA = "a decimal(28,2), b bigint"


def _round(value, places):
    exact = Fraction(value)
    steps = abs(exact) * 10 ** places
    size = Decimal((2 * steps.numerator + steps.denominator) // (2 * steps.denominator))
    return (size if exact >= 0 else -size).scaleb(-places)


@pytest.mark.parametrize("places", [2, 3])
def test_ratio_rounds_once(spark, places):
    pairs = [
        ("29", 200), ("-29", 200), ("1", 3), ("2", 3), ("0", 7), ("1.01", 2), ("-1.01", 2),
        ("201", 200), ("99999999999999.99", 3), ("12345678901234567.89", 7919),
        # just under a tie, by less than twelve decimals can show
        ("10049999999999.99", 10**13), ("10050000000000.00", 10**13),
    ]
    df = spark.createDataFrame([(Decimal(a), b) for a, b in pairs], SCHEMA)
    found = df.select(ratio(F.col("a"), F.col("b"), places)).collect()
    assert [r[0] for r in found] == [_round(Fraction(a) / b, places) for a, b in pairs]


def test_ratio_of_nothing(spark):
    df = spark.createDataFrame([(None, 0), (None, 5), (Decimal(1), None)], SCHEMA)
    assert [r[0] for r in df.select(ratio(F.col("a"), F.col("b"), 2)).collect()] == [None] * 3
    with pytest.raises(ArithmeticException):
        spark.createDataFrame([(Decimal(0), 0)], SCHEMA).select(
            ratio(F.col("a"), F.col("b"), 2)
        ).collect()


def test_quotient_keeps_close_means_apart(spark):
    df = spark.createDataFrame([(10**6, 10**6 + 1), (10**6 + 1, 10**6 + 2)], "a bigint, b bigint")
    low, high = [r[0] for r in df.select(quotient(F.col("a"), F.col("b"))).collect()]
    assert low < high


def _mean(spark, parts, weight):
    df = spark.createDataFrame([(Decimal(n), d) for n, d in parts], "n decimal(38,0), d bigint")
    sums = df.agg(add_fractions(fractions(F.col("n"), F.col("d"))).alias("s"))
    return sums.select(rounded_mean(F.col("s"), F.lit(weight).cast("bigint"))).first()[0]


def test_means_of_fractions_keep_halves(spark):
    # three times 5/6 is 2.5, but short of it in every decimal expansion
    assert _mean(spark, [(5, 6)] * 3, 1) == 3
    assert _mean(spark, [(1, 3), (1, 6)], 1) == 1
    assert _mean(spark, [(1, 7)] * 7 + [(1, 3)] * 3 + [(1, 2)], 1) == 3


def test_means_just_below_a_half_are_rounded_down(spark):
    short = 10**16
    assert _mean(spark, [(25 * short // 10 - 1, short)], 1) == 2
    assert _mean(spark, [(25 * short // 10, short)], 1) == 3
    # 2.5 less a third of the 18th decimal, of which fifteen decimals would show nothing
    assert _mean(spark, [(5, 6), (5, 6), (833_333_333_333_333_333, 10**18)], 1) == 2
    # the mean over three
    assert _mean(spark, [(3 * 25 * short // 10 - 1, short)], 3) == 2


def test_means_of_many_fractions(spark):
    rng = random.Random(2)
    for _ in range(5):
        parts = [(rng.randint(0, 10**6), rng.randint(1, 5000)) for _ in range(300)]
        weight = rng.randint(1, 400)
        exact = sum(Fraction(n, d) for n, d in parts) / weight
        assert _mean(spark, parts, weight) == (2 * exact.numerator + exact.denominator) // (2 * exact.denominator)
    assert _mean(spark, [], 0) is None


def _amounts(precision, scale, seed=5):
    rng = random.Random(seed)
    rows = []
    for group in range(30):
        for _ in range(rng.randint(1, 6)):
            digits = rng.choice([precision - 2, precision - 5, scale, 3, 1])
            least = -10**digits + 1 if group % 2 else 0
            rows.append((group, Decimal(rng.randint(least, 10**digits - 1)).scaleb(-scale)))
    return rows


@pytest.mark.parametrize("precision, scale", [
    (38, 18), (20, 13), (38, 14), (30, 25), (38, 30), (38, 37),
])
def test_wide_sums_are_exact(spark, precision, scale):
    """Against fractions: ratios of sums, of sums of sums, and the sums themselves."""
    rows = _amounts(precision, scale)
    df = spark.createDataFrame(rows, f"g int, v decimal({precision},{scale})")
    found = df.groupBy("g").agg(total(F.col("v"), scale).alias("t"), F.count("v").alias("n"))
    got = found.select(
        "g", ratio(F.col("t"), F.col("n"), 2, scale).alias("two"),
        ratio(F.col("t"), F.col("n"), 3, scale).alias("three"), amount_of(F.col("t"), scale).alias("sum"),
    ).collect()
    for r in got:
        own = [Fraction(v) for g, v in rows if g == r["g"]]
        assert r["two"] == _round(sum(own) / len(own), 2)
        assert r["three"] == _round(sum(own) / len(own), 3)
        assert Fraction(r["sum"]) == sum(own)
    again = found.groupBy().agg(
        add_up(F.col("t"), scale, F.col("g") + 1).alias("t"), F.sum("n").alias("n")
    ).select(ratio(F.col("t"), F.col("n"), 2, scale)).first()[0]
    assert again == _round(sum((g + 1) * Fraction(v) for g, v in rows) / len(rows), 2)


def test_wide_ratios_at_a_tie(spark):
    """A half is rounded away from zero; what is short of it by the last place is not."""
    for text, expected in [
        ("0.010000000000000000", "0.01"), ("0.009999999999999998", "0.00"), ("-0.010000000000000000", "-0.01"),
        ("-0.009999999999999998", "0.00"), ("2.010000000000000000", "1.01"), ("2.009999999999999999", "1.00"),
    ]:
        df = spark.createDataFrame([(Decimal(text),), (Decimal(0),)], "v decimal(38,18)")
        got = df.agg(ratio(total(F.col("v"), 18), F.count("v"), 2, 18)).first()[0]
        assert got == Decimal(expected), text


def test_wide_sums_of_nothing(spark):
    none = spark.createDataFrame([(None,), (None,)], "v decimal(38,18)")
    sums = none.agg(total(F.col("v"), 18).alias("t"), F.count("v").alias("n"))
    assert tuple(sums.select(amount_of(F.col("t"), 18), ratio(F.col("t"), F.lit(3), 2, 18)).first()) == (None, None)
    df = spark.createDataFrame([(Decimal(1),)], "v decimal(38,18)")
    with pytest.raises(ArithmeticException):
        df.agg(ratio(total(F.col("v"), 18), F.lit(0), 2, 18)).collect()
    with pytest.raises(ValueError, match="more than 37"):
        total(F.col("v"), 38)
