"""Results must not depend on how rows are spread, and parts must add up."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from playmetrics import GameTables
from playmetrics.plans import frequency, funnel
from tests.compare import _rows
from tests.fixture_data import tables
from tests.test_random import _tables


@pytest.fixture(scope="module")
def game(spark):
    return tables(spark, *_tables(11, broken=False))


def _spread(game, parts):
    return GameTables(**{
        t: getattr(game, t).orderBy(F.rand(parts)).repartition(parts)
        for t in ("users", "race", "items", "events")
    })


@pytest.mark.parametrize("name", list(driver.ANALYSES))
def test_partitioning_does_not_matter(spark, game, name):
    analysis = driver.ANALYSES[name]
    expected = analysis(game)
    other = analysis(_spread(game, 13))
    assert _rows(expected.columns, expected.collect()) == _rows(other.columns, other.collect())


def test_races_add_up_to_all_players(game):
    counted = funnel.race_funnel(game).agg(F.sum("count_all_u")).first()[0]
    assert counted == game.users.select("id").distinct().count()


def test_tiles_are_even(game):
    sizes = [
        r["count"] for r in frequency.gap_tiles(game, 2).groupBy("parts_by_gap").count().collect()
    ]
    assert len(sizes) == 3 and max(sizes) - min(sizes) <= 1


def test_segments_cover_the_tiles(game):
    players = frequency.frequency_segments(game, 2).agg(F.sum("count_users")).first()[0]
    known = frequency.gap_tiles(game, 2).where("id IS NOT NULL")
    assert players == known.select("id").distinct().count()
