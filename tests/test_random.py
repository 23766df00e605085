"""Random tables full of NULLs, ties, copies and broken keys, against the SQL counterparts."""

import random
import re
from datetime import datetime, timedelta
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as driver
import oracles
from playmetrics.plans import payers, purchases
from tests.compare import assert_same
from tests.fixture_data import tables

LEAST = 2
DDL = {
    "g_users": "id BIGINT, payer INTEGER, race_id INTEGER",
    "g_race": "race_id INTEGER, race VARCHAR",
    "g_items": "item_code BIGINT, game_items VARCHAR",
    "g_events": "transaction_id BIGINT, id BIGINT, date TIMESTAMP, amount DECIMAL(18,2), "
                "item_code BIGINT",
}


def _maybe(rng, value, chance):
    return None if rng.random() < chance else value


def _tables(seed, broken):
    """``broken`` repeats keys: players, races, items and transactions."""
    rng = random.Random(seed)
    start = datetime(2024, 1, 1)
    users = [(i, rng.choice([0, 1]), _maybe(rng, rng.randint(1, 6), 0.1)) for i in range(40)]
    race = [(i, f"race {i % 4}") for i in range(1, 5)] + [(5, None)]
    items = [(i, f"item {i % 7}") for i in range(12)]
    events = [
        (
            n,
            # one player and one item hold a third of the rows
            _maybe(rng, 3 if rng.random() < 0.33 else rng.randint(0, 45), 0.05),
            _maybe(rng, start + timedelta(hours=rng.randint(0, 600)), 0.1 if broken else 0),
            _maybe(rng, Decimal(rng.choice([0, 100, 250, 333, rng.randint(1, 9999)])) / 100, 0.1),
            _maybe(rng, 1 if rng.random() < 0.33 else rng.randint(0, 15), 0.05),
        )
        for n in range(500)
    ]
    if broken:
        users += [(i, _maybe(rng, rng.choice([0, 1]), 0.2), rng.randint(1, 6)) for i in range(12)]
        users += users[:5] + [(None, 1, 2), (None, 0, None)]
        race += [(1, "other"), race[0], (None, "lost")]
        items += items[:2] + [(3, "second name"), (None, "no code")]
        events = [
            (_maybe(rng, rng.randint(0, 250) if rng.random() < 0.5 else e[0], 0.05), *e[1:])
            for e in events
        ] + [events[7]] * 60
    return users, race, items, events


CASES = [(1, False, False), (2, True, False), (3, True, True), (4, False, True)]


def _name(case):
    return f"{case[0]}-{'broken' if case[1] else 'keyed'}-{'text' if case[2] else 'numbers'}"


@pytest.fixture(scope="module", params=CASES, ids=map(_name, CASES))
def both(request, spark):
    seed, broken, text = request.param
    data = _tables(seed, broken)
    con = duckdb.connect()
    for (name, columns), rows in zip(DDL.items(), data):
        if text:
            columns = re.sub(r"(transaction_id|race_id|item_code|\bid) \w+", r"\1 VARCHAR", columns)
        con.execute(f"CREATE TABLE {name} ({columns})")
        marks = ", ".join("?" * len(rows[0]))
        con.executemany(f"INSERT INTO {name} VALUES ({marks})", [list(r) for r in rows])
    game = tables(spark, *data, text=text)
    assert game.transactions_are_unique() is not broken
    yield game, con
    con.close()


def _sql(name):
    body = oracles.bodies(min_transactions=LEAST)[name].strip()
    return body if body.startswith("SELECT") else f"WITH {body}"


def _ours(name, game):
    analysis = driver.ANALYSES[name]
    if "min_transactions" in analysis.__code__.co_varnames:
        return analysis(game, min_transactions=LEAST)
    return analysis(game)


@pytest.mark.parametrize("name", list(driver.ANALYSES))
def test_matches_sql(both, name):
    game, con = both
    assert_same(_ours(name, game), con.sql(_sql(name)), name)


def test_groups_by_other_columns(both):
    game, con = both
    assert_same(payers.payer_share_by(game, "race_id"), con.sql("""
      SELECT race_id, count(DISTINCT id) AS all_users, sum(payer)::BIGINT AS paying_users,
             round(sum(payer)::DOUBLE / nullif(count(DISTINCT id), 0) + 1e-12, 2) AS share_paying_users
      FROM g_users GROUP BY race_id"""))
    by_race = purchases.activity_by_payer(game, "race_id").select("race_id", "count_users", "count_trans")
    assert_same(by_race, con.sql("""
      SELECT race_id, count(DISTINCT e.id) AS count_users, count(e.transaction_id) AS count_trans
      FROM g_events e LEFT JOIN g_users u ON u.id = e.id GROUP BY race_id"""))
