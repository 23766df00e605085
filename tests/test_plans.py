"""What the physical plans must and must not contain."""

import re

import pytest

import __spark_entry__ as driver
from playmetrics import storage
from playmetrics.operators import lag, ordering
from playmetrics.plans import frequency, funnel, payers, purchases
from playmetrics.sources.tables import from_catalog, from_parquet, from_supplied
from tests.compare import _rows
from tests.fixture_data import tables


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """The hand-made tables as Parquet, so that plans have real scans."""
    folder = str(tmp_path_factory.mktemp("game"))
    game = tables(spark)
    for name in ("users", "race", "items", "events"):
        getattr(game, name).write.parquet(f"{folder}/{name}")
    return from_parquet(spark, folder, unique_transactions=True)


@pytest.fixture(params=["10MB", "-1"], ids=["broadcast", "shuffled"])
def threshold(spark, request):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", request.param)
    yield request.param
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(text, table):
    """Reads of a table; stored intermediate results are in other folders.

    Every scan must show its whole path, or else not finding one would mean nothing.
    """
    read = re.findall(r"FileScan parquet.*?Location: [^\[]*\[(.*?)\]", text)
    assert len(read) == text.count("FileScan") and not any("..." in path for path in read)
    return sum(path.endswith(f"/{table}") for path in read)


def test_filters_and_columns_reach_the_scan(stored):
    text = plan(frequency.player_gap_summary(stored))
    assert "GreaterThan(amount,0.00)" in text
    events = next(line for line in text.splitlines() if "FileScan" in line and "/events]" in line)
    assert "item_code" not in events


@pytest.mark.parametrize("analysis, times", [
    (funnel.race_funnel, 1),
    (funnel.race_activity, 1),
    (funnel.race_paying_share, 1),
    (funnel.race_purchasers, 1),
    (purchases.activity_by_payer, 1),
    (purchases.zero_amount_share, 1),
    (frequency.player_gap_summary, 1),
    (frequency.segment_paying_players, 1),
    (frequency.frequency_segments, 1),
    (frequency.gap_tiles, 1),
])
def test_purchases_are_read_once(stored, threshold, monkeypatch, analysis, times):
    """In the plan of the result and in those of what is stored on the way."""
    texts = recorded_plans(monkeypatch)
    found = plan(analysis(stored))
    assert sum(scans(text, "events") for text in [*texts, found]) == times


def recorded_plans(monkeypatch):
    """The plans of what is stored from now on."""
    texts = []

    def recorded(df, store=storage.store):
        texts.append(plan(df))
        return store(df)

    for module in (frequency, ordering, lag):
        monkeypatch.setattr(module, "store", recorded)
    return texts


def ran(df):
    """The plan that ran, with the exchanges that were used again."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def final(text):
    return text.split("== Initial Plan ==")[0]


def test_items_and_totals_share_one_read(stored, threshold):
    """One scan of the purchases of items, and one that is filtered to those of none."""
    reads = lambda text: [
        re.search(r"(Is\w+)\(item_code\)", line).group(1)
        for line in text.splitlines() if "FileScan" in line and "/events]" in line
    ]
    shares = purchases.item_shares(stored)
    assert reads(plan(shares)).count("IsNull") == 1
    text = final(ran(shares))
    assert reads(text).count("IsNotNull") == 1 and "ReusedExchange" in text


def test_items_are_sorted_once_after_storing(stored, threshold):
    text = plan(purchases.item_popularity(stored))
    assert scans(text, "events") == 0
    assert len(re.findall(r"Sort \[(?!_part)", text)) == 1 and "Sort [row_number" in text


def test_gaps_move_each_purchase_once(stored, threshold, monkeypatch):
    texts = recorded_plans(monkeypatch)
    text = plan(frequency.purchase_gaps(stored))
    assert scans(text, "events") == 1 and [scans(t, "events") for t in texts] == [1]
    moved = [
        below for below in _feeds(text, "Exchange hashpartitioning")
        if "Aggregate" not in below[0] and "transaction_id" in "".join(below)
    ]
    assert len(moved) == 1


@pytest.mark.parametrize("analysis", [
    frequency.player_gap_summary, frequency.gap_tiles, frequency.gap_segments,
    frequency.segment_paying_players, frequency.frequency_segments,
])
def test_repeated_ids_are_read_once(spark, tmp_path, monkeypatch, analysis):
    game = tables(spark)
    for name in ("users", "race", "items", "events"):
        getattr(game, name).write.parquet(f"{tmp_path}/{name}")
    repeated = from_parquet(spark, str(tmp_path), unique_transactions=False)
    texts = recorded_plans(monkeypatch)
    found = analysis(repeated, 2) if analysis is not frequency.player_gap_summary else analysis(repeated)
    assert sum(scans(text, "events") for text in [*texts, plan(found)]) == 1
    other = analysis(game, 2) if analysis is not frequency.player_gap_summary else analysis(game)
    assert _rows(found.columns, found.collect()) == _rows(other.columns, other.collect())


@pytest.mark.parametrize("analysis", [
    purchases.activity_by_payer, funnel.race_funnel, frequency.player_gap_summary,
])
def test_users_are_moved_once(spark, stored, analysis):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(analysis(stored))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    moved = [below for below in _feeds(text, "Exchange hashpartitioning") if any("/users]" in l for l in below)
             and not any("Exchange" in l for l in below)]
    assert len(moved) == 1


def test_no_user_row_is_moved_by_race(spark, stored):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(payers.payer_share_by_race(stored))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for below in _feeds(text, "Exchange hashpartitioning"):
        if any("/users]" in line for line in below):
            assert "Aggregate" in below[0] or any("HashAggregate" in line for line in below)


def test_mean_gaps_need_no_window(stored):
    assert "Window" not in plan(frequency.player_gap_summary(stored))


def _feeds(text, exchange):
    """For each exchange of a kind, the part of the plan below it."""
    lines = text.splitlines()
    for i, line in enumerate(lines):
        if exchange in line:
            depth = len(line) - len(line.lstrip(" :+-"))
            below = []
            for later in lines[i + 1:]:
                if len(later) - len(later.lstrip(" :+-")) <= depth:
                    break
                below.append(later)
            yield below


@pytest.mark.parametrize("name", list(driver.ANALYSES))
def test_single_partitions_only_take_aggregates(stored, threshold, name):
    """One row per task or per sort partition may meet in one task, plain rows never."""
    for below in _feeds(plan(driver.ANALYSES[name](stored)), "Exchange SinglePartition"):
        assert "HashAggregate" in below[0], below[0]


@pytest.mark.parametrize("name", list(driver.ANALYSES))
def test_no_python_and_no_unbounded_products(stored, threshold, name):
    text = plan(driver.ANALYSES[name](stored))
    assert "Python" not in text and "CartesianProduct" not in text


def test_broadcasting_does_not_change_results(spark, stored, threshold):
    for analysis in (funnel.race_funnel, purchases.item_popularity, payers.payer_share_by_race):
        ours, expected = analysis(stored), analysis(tables(spark))
        assert _rows(ours.columns, ours.collect()) == _rows(expected.columns, expected.collect())


def test_catalog_tables(spark, stored):
    spark.sql("CREATE DATABASE IF NOT EXISTS play_test")
    try:
        for name in ("users", "race", "items", "events"):
            getattr(stored, name).write.mode("overwrite").saveAsTable(f"play_test.{name}")
        found = payers.payer_share_overall(from_catalog(spark, "play_test")).first()
        assert (found["all_users"], found["paying_users"]) == (7, 3)
    finally:
        spark.sql("DROP DATABASE play_test CASCADE")


def test_supplied_tables_keep_every_row(spark):
    folder = "/root/testdata/sf0.001"
    game = from_supplied(spark, folder)
    files = {"users": "customer", "race": "nation", "items": "part", "events": "events"}
    for table, file in files.items():
        rows = spark.read.parquet(f"{folder}/{file}.parquet").count()
        assert getattr(game, table).count() == rows
