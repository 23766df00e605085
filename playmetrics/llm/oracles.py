"""The registered queries that SQL can express, as DuckDB SQL."""

from __future__ import annotations

from playmetrics.llm import url_filter
from playmetrics.llm.queries import PROBE, URL_RULES

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lower_ascii(text: str) -> str:
    return f"translate({text}, '{_UPPER}', '{_LOWER}')"


CHAT = f"""
WITH talks AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{PROBE}' UNION ALL SELECT -1, 1, 'assistant', '{PROBE}'),
written AS (
  SELECT *, replace(replace(text, '\\', '\\\\'), '<|', '<\\|') AS t,
         replace(replace(replace(role, '\\', '\\\\'), '<|', '<\\|'), chr(10), '<\\n') AS r
  FROM talks)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text))
         AS turns_sha256,
       sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text)
                         FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length('<|im_start|>') + length(r) + 1 + length(t) + length('<|im_end|>') + 1)::BIGINT
         AS formatted_chars
FROM written GROUP BY conv_id"""

EXACT = f"""
WITH d AS (SELECT doc_id, {_lower_ascii("coalesce(text, '')")} AS norm FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY norm ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(norm) AS text_sha256
FROM d WINDOW same AS (PARTITION BY norm)"""


def _quota_sql(name: str, parties: str) -> str:
    """Sainte-Lague for every house: rounded shares, then single seats by quotient."""
    return f"""
{name}_based AS (
  SELECT *, least(floor(votes / house_votes * seats + 0.5), 2 * blocks)::BIGINT AS base
  FROM {parties} WHERE votes > 0),
{name}_off AS (SELECT *, (seats - sum(base) OVER (PARTITION BY house))::BIGINT AS gap FROM {name}_based),
{name}_offers AS (
  SELECT *, CASE WHEN gap > 0 THEN base + k ELSE base - k + 1 END AS seat
  FROM (SELECT *, unnest(range(1, abs(gap) + 1)) AS k FROM {name}_off WHERE gap <> 0)),
{name}_ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY house
    ORDER BY CASE WHEN gap > 0 THEN -1 ELSE 1 END * (votes::DOUBLE / (2 * seat - 1)::DOUBLE),
             CASE WHEN gap > 0 THEN party ELSE -party END, seat) AS place
  FROM {name}_offers WHERE seat >= 1 AND seat <= 2 * blocks),
{name}_moves AS (
  SELECT house, party, sum(sign(gap)) AS change FROM {name}_ranked WHERE place <= abs(gap) GROUP BY ALL),
{name} AS (
  SELECT o.house, o.party, o.blocks, (o.base + coalesce(m.change, 0))::BIGINT AS quota
  FROM {name}_off o LEFT JOIN {name}_moves m USING (house, party))"""


def _mix_sql() -> str:
    """Targets from sorted ratios instead of rounds; blocks of 128 words or less, shards of 1,000 documents."""
    return f"""
WITH docs AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, count(*) AS n,
         row_number() OVER (ORDER BY source NULLS LAST) AS number,
         [3.0, 1.0, 2.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight
  FROM docs GROUP BY source),
full_first AS (
  SELECT 2 * source_size / weight AS ratio,
         sum(2 * source_size) OVER up AS taken,
         sum(weight) OVER () - sum(weight) OVER up AS free,
         lead(2 * source_size / weight) OVER (ORDER BY 2 * source_size / weight, source) AS next_ratio
  FROM sources
  WINDOW up AS (ORDER BY 2 * source_size / weight, source ROWS UNBOUNDED PRECEDING)),
levels AS (
  SELECT 1.5 * (SELECT sum(source_size) FROM sources) / sum(weight) AS level,
         0.0 AS above, min(2 * source_size / weight) AS below FROM sources
  UNION ALL
  SELECT (1.5 * (SELECT sum(source_size) FROM sources) - taken) / free, ratio, next_ratio
  FROM full_first WHERE free > 0),
planned AS (
  SELECT source, number, source_size, n, least(weight * l.level, (2 * source_size)::DOUBLE) AS target
  FROM sources,
       (SELECT min(level) AS level FROM levels WHERE level >= above AND level <= below) l),
widths AS (
  SELECT *, coalesce(list_filter([128, 64, 32, 16, 8, 4, 2, 1], lambda w: w * 32 <= target)[1], 1)::BIGINT
    AS width FROM planned),
source_parties AS (
  SELECT width AS house, number AS party, target AS votes, sum(target) OVER same AS house_votes,
         floor(sum(target) OVER same / width + 0.5)::BIGINT AS seats,
         (source_size + width - 1) // width AS blocks
  FROM widths WINDOW same AS (PARTITION BY width)),
{_quota_sql("source_quotas", "source_parties")},
plans AS (
  SELECT w.*, coalesce(q.quota, 0) AS seats, ceil(n / 1000)::BIGINT AS n_shards
  FROM widths w LEFT JOIN source_quotas q ON q.party = w.number),
placed AS (
  SELECT d.*, p.number, p.source_size, p.target, p.seats, p.width, d.h % p.n_shards AS shard
  FROM docs d JOIN plans p ON d.source IS NOT DISTINCT FROM p.source),
shard_parties AS (
  SELECT number AS house, shard AS party, sum(size)::BIGINT AS votes, any_value(source_size) AS house_votes,
         any_value(seats) AS seats,
         (sum(size)::BIGINT + any_value(width) - 1) // any_value(width) AS blocks
  FROM placed GROUP BY ALL),
{_quota_sql("shard_quotas", "shard_parties")},
laid AS (
  SELECT *, coalesce(sum(size) OVER (
    PARTITION BY number, shard ORDER BY h, doc_id NULLS FIRST, size
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM placed),
cut AS (
  SELECT *, unnest(range(start // width, (start + size - 1) // width + 1)) AS block
  FROM laid WHERE size > 0),
counted AS (
  SELECT c.doc_id, sum(
    (least((block + 1) * width, start + size) - greatest(block * width, start))
    * (quota // blocks + ((block * 2147483647 + (c.shard * 31 + 7) % blocks) % blocks
                          < quota % blocks)::INTEGER))::BIGINT AS taken
  FROM cut c JOIN shard_quotas q ON c.number = q.house AND c.shard = q.party
  GROUP BY c.doc_id)
SELECT doc_id, size, source_size, target, coalesce(taken, 0) AS taken
FROM placed LEFT JOIN counted USING (doc_id)"""


def _line_sql() -> str:
    """Pairs of lines that share a third of the shorter at any place within two of its own, and then
    Levenshtein; two edits, and one for every ten characters at most."""
    white = "' ' || chr(9) || chr(11) || chr(12) || chr(13)"
    return f"""
WITH split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
every AS (
  SELECT doc_id, unnest(range(len(l))) AS line, trim(unnest(l), {white}) AS t FROM split),
long AS (SELECT * FROM every WHERE t <> ''),
single AS (
  SELECT t, length(t) AS n, min(struct_pack(d := doc_id, l := line)) AS first FROM long GROUP BY t),
thirds AS (
  SELECT t, first, n, m, i, m * i // 3 AS start, m * (i + 1) // 3 AS stop
  FROM (SELECT *, unnest([n, n - 1, n - 2]) AS m FROM single WHERE n >= 10), range(3) r(i) WHERE m >= 10),
own AS (SELECT t, first, m, i, substr(t, start + 1, stop - start) AS piece FROM thirds WHERE m = n),
asked AS (
  SELECT DISTINCT t, first, m, i, substr(t, start + s + 1, stop - start) AS piece
  FROM thirds, range(-2, 3) shift(s) WHERE start + s >= 0 AND stop + s <= n),
met AS (
  SELECT DISTINCT a.t AS a, b.t AS b, a.first AS at_a, b.first AS at_b
  FROM own a JOIN asked b USING (m, i, piece) WHERE a.t <> b.t),
near AS (
  SELECT CASE WHEN at_a < at_b THEN b ELSE a END AS t FROM met
  WHERE levenshtein(a, b) <= least(2, least(length(a), length(b)) // 10)),
judged AS (
  SELECT doc_id, line, struct_pack(d := doc_id, l := line) <> first AS again,
         t IN (SELECT t FROM near) AS near
  FROM long JOIN single USING (t)),
gone AS (
  SELECT doc_id, count(*) FILTER (again) AS n_exact, count(*) FILTER (NOT again) AS n_near,
         string_agg(line::VARCHAR, ',' ORDER BY line) AS dropped
  FROM judged WHERE again OR near GROUP BY doc_id)
SELECT doc_id, len(l) AS n_lines, coalesce(n_exact, 0) AS n_exact, coalesce(n_near, 0) AS n_near,
       coalesce(dropped, '') AS dropped
FROM split LEFT JOIN gone USING (doc_id)"""


def _url_sql() -> str:
    fits = lambda r: (
        f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')"
    )
    longest = sorted(URL_RULES, key=lambda r: -len(r.text))
    rule = " ".join(f"WHEN {fits(r)} THEN '{r.text}'" for r in longest)
    verdict = " ".join(f"WHEN {fits(r)} THEN '{r.verdict}'" for r in longest)
    low, high = url_filter.STRENGTH

    def level(name: str, units: str, prior: str) -> str:
        """Two steps: the units with their prior mean, and their posteriors."""
        return f"""
{name}_prior AS (SELECT u.*, v.p AS m FROM {units} u, {prior}),
{name}_strength AS (
  SELECT greatest({low}, least({high}, 1 / greatest(coalesce(
    sum(n * (bad / n - m) * (bad / n - m) - m * (1 - m)) / nullif(sum(m * (1 - m) * (n - 1)), 0),
    0), 1e-9) - 1)) AS s FROM {name}_prior WHERE n > 0),
{name}_post AS (
  SELECT *, m * s + bad AS a, (1 - m) * s + n - bad AS b, (m * s + bad) / (s + n) AS p
  FROM {name}_prior, {name}_strength)"""

    return f"""
WITH cut AS (
  SELECT page_id, CASE WHEN contains(url, '://')
                       THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parsed AS (
  SELECT page_id, {_lower_ascii("regexp_extract(rest, '^[^/?#]*')")} AS host,
         regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*')
           AS path FROM cut),
ruled AS (SELECT *, CASE {rule} END AS rule, CASE {verdict} END AS rule_verdict FROM parsed),
seen AS (
  SELECT doc_id AS page_id, count(*) FILTER (toxic = 1 OR quality = 0) AS bad, count(*) AS n
  FROM labels WHERE (toxic = 1 OR quality = 0) IS NOT NULL GROUP BY ALL),
hosts AS (
  SELECT host, list_extract(string_split(host, '.'), -1) AS suffix,
         array_to_string(string_split(host, '.')[-2:], '.') AS domain,
         coalesce(sum(bad), 0)::DOUBLE AS bad, coalesce(sum(n), 0)::DOUBLE AS n
  FROM ruled LEFT JOIN seen USING (page_id) GROUP BY ALL),
suffixes AS (SELECT suffix, sum(bad) AS bad, sum(n) AS n FROM hosts GROUP BY ALL),
domains AS (SELECT suffix, domain, sum(bad) AS bad, sum(n) AS n FROM hosts GROUP BY ALL),
everything AS (SELECT (sum(bad) + 0.5) / (sum(n) + 1.0) AS p FROM hosts),
{level("suffix", "suffixes", "everything v")},
{level("domain", "domains", "suffix_post v WHERE u.suffix = v.suffix")},
{level("host", "hosts", "domain_post v WHERE u.domain = v.domain")},
judged AS (
  SELECT host, CASE WHEN round(p - {url_filter.BOUND} * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))), 9)
                         > {url_filter.THRESHOLD} THEN 'block' ELSE 'allow' END AS host_verdict
  FROM host_post)
SELECT page_id, host, path, rule, coalesce(rule_verdict, host_verdict) AS verdict
FROM ruled JOIN judged USING (host)"""


def _merkle_sql() -> str:
    """Trees level by level, and each row's path with the tampered leaf, as recursive queries."""
    part = lambda c: f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')"
    leaf = lambda text: "sha256(" + " || ".join(
        part(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    def tree(name: str, leaves: str) -> str:
        """All nodes, and for every leaf and level the nodes to the left and right of its path."""
        return f"""
{name} AS (
  SELECT 0 AS level, tree, position, nodes, hash FROM {leaves}
  UNION ALL
  SELECT level + 1, tree, position // 3, any_value((nodes + 2) // 3),
         sha256(string_agg(hash, '' ORDER BY position))
  FROM {name} WHERE nodes > 1 GROUP BY level, tree, position // 3),
{name}_beside AS (
  SELECT a.level, a.tree, a.position,
         coalesce(string_agg(b.hash, '' ORDER BY b.position) FILTER (b.position < a.position), '') AS l,
         coalesce(string_agg(b.hash, '' ORDER BY b.position) FILTER (b.position > a.position), '') AS r
  FROM {name} a JOIN {name} b
    ON a.level = b.level AND a.tree = b.tree AND a.position // 3 = b.position // 3
  WHERE a.nodes > 1 GROUP BY ALL),
{name}_power AS (SELECT range AS level, (3 ** range)::BIGINT AS size FROM range(39)),
{name}_steps AS (
  SELECT p.tree, p.position, b.level, l, r
  FROM {leaves} p JOIN {name}_power w ON w.level < 39
  JOIN {name}_beside b ON b.level = w.level AND b.tree = p.tree AND b.position = p.position // w.size),
{name}_last AS (SELECT tree, max(level) AS level FROM {name} GROUP BY tree),
{name}_top AS (SELECT tree, hash FROM {name} JOIN {name}_last USING (tree, level))"""

    return f"""
WITH RECURSIVE
tampered AS (
  SELECT *, CASE WHEN xor(list_reduce(
    list_concat([4294967295::UBIGINT],
                list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::UBIGINT)),
    lambda sum, byte: list_reduce(
      list_concat([xor(sum, byte)], [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]),
      lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::UBIGINT) ELSE x >> 1 END)),
    4294967295::UBIGINT) % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS other FROM documents),
leaves AS (SELECT doc_id, source, {leaf("text")} AS leaf, {leaf("other")} AS changed FROM tampered),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS FIRST, doc_id NULLS FIRST, leaf) AS id,
         dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
         count(*) OVER (PARTITION BY source) AS nodes FROM leaves),
placed AS (
  SELECT *, id - min(id) OVER (PARTITION BY tree) AS position, leaf AS hash FROM ranked),
{tree("source_tree", "placed")},
subroots AS (
  SELECT 0 AS tree, tree AS position, (SELECT count(*) FROM source_tree_top) AS nodes, hash
  FROM source_tree_top),
{tree("upper_tree", "subroots")},
steps AS (
  SELECT id, s.level, l, r FROM placed p
  JOIN source_tree_steps s ON s.tree = p.tree AND s.position = p.position
  UNION ALL
  SELECT id, t.level + s.level, l, r FROM placed p
  JOIN source_tree_last t ON t.tree = p.tree JOIN upper_tree_steps s ON s.position = p.tree),
proofs AS (SELECT id, sha256(string_agg(l || r, '' ORDER BY level)) AS proof FROM steps GROUP BY id),
folded AS (
  SELECT id, 0 AS level, changed AS hash FROM placed
  UNION ALL
  SELECT f.id, f.level + 1, sha256(l || hash || r)
  FROM folded f JOIN steps s ON s.id = f.id AND s.level = f.level),
ends AS (SELECT id, arg_max(hash, level) AS folded_root FROM folded GROUP BY id)
SELECT doc_id, leaf, t.hash AS subroot, u.hash AS root,
       coalesce(proof, sha256('')) AS proof_sha256, folded_root, folded_root = u.hash AS verified
FROM placed p JOIN source_tree_top t ON t.tree = p.tree JOIN upper_tree_top u ON true
LEFT JOIN proofs USING (id) JOIN ends USING (id)"""


SQL: dict[str, str] = {
    "op4_chat_formatting": CHAT,
    "op5_exact_dedup": EXACT,
    "op6_source_mixing": _mix_sql(),
    "op8_line_dedup": _line_sql(),
    "op9_url_filter": _url_sql(),
    "op13_merkle_manifest": _merkle_sql(),
}
