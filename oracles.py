"""The same questions as plain DuckDB SQL, for comparing results.

Each body reads ``g_users``, ``g_race``, ``g_items`` and ``g_events``; ``SUPPLIED`` defines
these over the supplied tables. Ratios round in whole numbers, because decimal division
in DuckDB gives doubles; amounts are taken in cents and are not negative.
"""

from __future__ import annotations

SUPPLIED = """
g_users AS (
  SELECT c_custkey AS id,
         CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING') THEN 1 ELSE 0 END AS payer,
         CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN c_nationkey END AS race_id
  FROM customer),
g_race AS (
  SELECT n_nationkey AS race_id, CASE WHEN n_regionkey <> 4 THEN n_name END AS race FROM nation),
g_items AS (SELECT p_partkey AS item_code, p_name AS game_items FROM part),
g_events AS (
  SELECT event_id AS transaction_id,
         CASE WHEN event_type = 'signup' THEN -1 - user_id ELSE user_id END AS id,
         ts + to_days(((ts::DATE - DATE '2024-01-01') * (user_id % 7) * 100)::INTEGER) AS date,
         CASE WHEN event_type = 'error' THEN 0 WHEN event_type <> 'view' THEN value END
           ::DECIMAL(18,2) AS amount,
         regexp_extract(props, '([0-9]+)', 1)::BIGINT AS item_code
  FROM events)"""


def _ratio(top: str, below: str, places: int = 2) -> str:
    unit = 10 ** places
    return (
        f"((2 * {unit} * ({top})::HUGEINT + ({below})::HUGEINT)"
        f" // (2 * ({below})::HUGEINT))::DOUBLE / {unit}"
    )


def _money(cents: str, below: str) -> str:
    """Cents per ``below``, in whole currency with two decimals."""
    return f"((2 * ({cents})::HUGEINT + ({below})::HUGEINT) // (2 * ({below})::HUGEINT))::DOUBLE / 100"


# Result columns and segment labels, here and in ``playmetrics/plans``.
_CENTS = "sum((amount * 100)::HUGEINT)"

# name of the stage -> its definition; later ones read earlier ones
_RACE_STAGES = {
    "players": """
      SELECT u.id, u.payer, u.race_id, r.race
      FROM g_users u LEFT JOIN g_race r ON r.race_id = u.race_id""",
    "everyone": "SELECT race_id, race, count(DISTINCT id) AS n FROM players GROUP BY ALL",
    "purchasers": """
      SELECT race_id, race, count(DISTINCT id) AS n FROM players p
      WHERE EXISTS (SELECT 1 FROM g_events e
                    WHERE e.id = p.id AND e.transaction_id IS NOT NULL) GROUP BY ALL""",
    "payers": """
      SELECT race_id, race, count(DISTINCT id) AS n FROM players p
      WHERE payer = 1 AND EXISTS (SELECT 1 FROM g_events e WHERE e.id = p.id) GROUP BY ALL""",
    "activity": f"""
      SELECT u.race_id, b.race,
             {_ratio('count(DISTINCT e.transaction_id)', 'b.n')} AS per_buyer,
             {_money(_CENTS, 'count(DISTINCT e.transaction_id)')} AS per_purchase,
             {_money(_CENTS, 'b.n')} AS spent
      FROM g_events e
      JOIN g_users u ON u.id = e.id
      LEFT JOIN purchasers b ON b.race_id = u.race_id
      WHERE e.amount > 0
      GROUP BY u.race_id, b.race, b.n""",
}

_GAP_STAGES = {
    "steps": """
      SELECT transaction_id, id, date,
             lag(date) OVER (PARTITION BY id
               ORDER BY date NULLS LAST, transaction_id NULLS LAST) AS earlier
      FROM g_events WHERE amount > 0""",
    "summary": """
      SELECT s.id, u.payer, count(DISTINCT s.transaction_id) AS n,
             sum(s.date::DATE - s.earlier::DATE)::DOUBLE
               / count(s.date::DATE - s.earlier::DATE) AS mean_gap
      FROM steps s LEFT JOIN g_users u ON u.id = s.id GROUP BY s.id, u.payer""",
    "tiled": """
      SELECT id, payer, mean_gap,
             ntile({tiles}) OVER (ORDER BY mean_gap NULLS LAST, id NULLS LAST, payer NULLS LAST) AS t
      FROM summary WHERE n >= {min_transactions}""",
    "named": """
      SELECT id, payer, mean_gap,
             ['высокая частота', 'умеренная частота', 'низкая частота'][t] AS segment
      FROM tiled""",
}


def _stages(stages: dict[str, str]) -> str:
    return ",\n".join(f"{name} AS ({body})" for name, body in stages.items())


def _after(stages: dict[str, str], select: str) -> str:
    return f"{_stages(stages)}\n{select}"


def bodies(min_transactions: int = 25, tiles: int = 3) -> dict[str, str]:
    """Query name -> (further stages and) the select, over the ``g_`` tables."""
    race = lambda select: _after(_RACE_STAGES, select)
    filled = {
        k: v.format(min_transactions=min_transactions, tiles=tiles)
        for k, v in _GAP_STAGES.items()
    }
    gaps = lambda select: _after(filled, select)
    return {
        "payer_share_overall": f"""
          SELECT count(payer) AS all_users, sum(payer)::BIGINT AS paying_users,
                 {_ratio('sum(payer)', 'count(payer)')} AS share_paying_users
          FROM g_users""",
        "payer_share_by_race": f"""
          SELECT race, count(DISTINCT id) AS all_users, sum(payer)::BIGINT AS paying_users,
                 {_ratio('sum(payer)', 'count(DISTINCT id)')} AS share_paying_users
          FROM (SELECT u.id, u.payer, r.race
                FROM g_users u LEFT JOIN g_race r ON r.race_id = u.race_id)
          GROUP BY race""",
        "purchase_amount_profile": f"""
          SELECT count(transaction_id) AS count_transaction,
                 sum(amount)::DOUBLE AS sum_amount,
                 min(amount)::DOUBLE AS min_amount,
                 max(amount)::DOUBLE AS max_amount,
                 {_money(_CENTS, 'count(amount)')} AS avg_amount,
                 min(amount) FILTER (k = (n + 1) // 2)::DOUBLE AS mid_amount,
                 round(stddev_samp(amount::DOUBLE), 2) AS stddev_amount
          FROM (SELECT *, row_number() OVER (ORDER BY amount) AS k, count(*) OVER () AS n
                FROM g_events WHERE amount > 0)""",
        "zero_amount_share": f"""
          SELECT count(amount) AS count, count(*) FILTER (amount = 0) AS null_amount,
                 {_ratio('count(*) FILTER (amount = 0)', 'count(amount)', 3)} AS share_null_amount
          FROM g_events""",
        "activity_by_payer": f"""
          SELECT u.payer, count(DISTINCT e.id) AS count_users,
                 count(e.transaction_id) AS count_trans,
                 {_ratio('count(e.transaction_id)', 'count(DISTINCT e.id)')} AS avg_trans,
                 {_money(_CENTS, 'count(DISTINCT e.id)')} AS avg_amount
          FROM g_events e LEFT JOIN g_users u ON u.id = e.id
          GROUP BY u.payer""",
        "item_popularity": f"""
          whole AS (SELECT count(transaction_id) AS n, count(DISTINCT id) AS buyers FROM g_events),
          sold AS (SELECT i.item_code, i.game_items, count(e.transaction_id) AS n,
                          count(DISTINCT e.id) AS buyers
                   FROM g_items i LEFT JOIN g_events e ON e.item_code = i.item_code
                   GROUP BY i.item_code, i.game_items)
          SELECT item_code, game_items, s.n AS count_purchases,
                 {_ratio('s.n', 'w.n', 3)} AS relative_purchases,
                 {_ratio('s.buyers', 'w.buyers')} AS relative_count_users,
                 row_number() OVER (ORDER BY s.n DESC, item_code NULLS LAST,
                                    game_items NULLS LAST) AS row_number
          FROM sold s, whole w""",
        "race_all_users": race("SELECT race_id, race, n AS count_all_u FROM everyone"),
        "player_purchase_counts": """
          SELECT u.id, count(e.transaction_id) AS count_t
          FROM g_users u LEFT JOIN g_events e ON e.id = u.id GROUP BY u.id""",
        "race_purchasers": race("SELECT race_id, race, n AS count_purshasing_u FROM purchasers"),
        "race_paying_purchasers": race("SELECT race_id, race, n AS count_paying_u FROM payers"),
        "race_paying_share": race(f"""
          SELECT b.race_id, b.race, {_ratio('p.n', 'b.n')} AS share_paying_u
          FROM purchasers b LEFT JOIN payers p ON p.race_id = b.race_id AND p.race = b.race"""),
        "race_activity": race("""
          SELECT race_id, race, per_buyer AS avg_purshases,
                 per_purchase AS avg_amount_transaction, spent AS avg_amount_u
          FROM activity"""),
        "race_funnel": race(f"""
          SELECT a.race_id, a.race, a.n AS count_all_u, b.n AS count_purshasing_u,
                 {_ratio('b.n', 'a.n')} AS share_purchasing_u,
                 p.n AS count_paying_u,
                 {_ratio('p.n', 'b.n')} AS share_paying_u,
                 c.per_buyer AS avg_purshases,
                 c.per_purchase AS avg_amount_transaction,
                 c.spent AS avg_amount_u
          FROM everyone a
          LEFT JOIN purchasers b ON b.race_id = a.race_id AND b.race = a.race
          LEFT JOIN payers p ON p.race_id = a.race_id AND p.race = a.race
          LEFT JOIN activity c ON c.race_id = a.race_id AND c.race = a.race"""),
        "purchase_gaps": gaps("""
          SELECT transaction_id, id, date::DATE AS date, earlier AS previous_transaction,
                 (date::DATE - earlier::DATE)::INTEGER AS gap
          FROM steps"""),
        "player_gap_summary": gaps("""
          SELECT id, payer, n AS count_transactions, mean_gap AS avg_gap FROM summary"""),
        "gap_tiles": gaps("""
          SELECT id, payer, mean_gap AS avg_gap, t::BIGINT AS parts_by_gap FROM tiled"""),
        "gap_segments": gaps("""
          SELECT id, payer, mean_gap AS avg_gap, segment AS users_group FROM named"""),
        "segment_paying_players": gaps("SELECT id FROM named WHERE payer = 1"),
        "frequency_segments": gaps(f"""
          SELECT m.segment AS users_group, count(DISTINCT m.id) AS count_users,
                 count(DISTINCT m.id) FILTER (m.id IN (SELECT id FROM named WHERE payer = 1))
                   AS paying_users,
                 {_ratio("count(DISTINCT m.id) FILTER (m.id IN (SELECT id FROM named WHERE payer = 1))",
                         "count(DISTINCT m.id)")} AS share_paying_users,
                 {_ratio("count(DISTINCT s.transaction_id)", "count(DISTINCT m.id)")}
                   AS count_transaction,
                 round(avg(m.mean_gap)) AS avg_gap
          FROM named m LEFT JOIN steps s ON s.id = m.id
          GROUP BY m.segment"""),
    }


def over(tables: str, body: str) -> str:
    """Put the table definitions before a body that may start with stages of its own."""
    joint = "\n" if body.lstrip().startswith("SELECT") else ",\n"
    return f"WITH {tables.strip()}{joint}{body.strip()}"


def supplied() -> dict[str, str]:
    return {name: over(SUPPLIED, body) for name, body in bodies().items()}
