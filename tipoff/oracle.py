"""The SQL each registered query is checked against, on the same tables."""

from __future__ import annotations


def _season(day: str) -> str:
    """Season label of a schedule that runs through the whole year."""
    end = f"(year({day}) + CASE WHEN month({day}) >= 11 THEN 1 ELSE 0 END)"
    return f"CAST({end} - 1 AS VARCHAR) || '-' || lpad(CAST({end} % 100 AS VARCHAR), 2, '0')"


def _winter_season(day: str) -> str:
    """Season label, null between seasons."""
    return f"CASE WHEN month({day}) >= 11 OR month({day}) <= 4 THEN {_season(day)} END"


LINES = """
lines AS (
  SELECT *, CAST(l_quantity AS INTEGER) AS score, l_orderkey * 1048576 + (rn + 1) // 2 AS pair_id
  FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey
      ORDER BY l_linenumber, l_suppkey, l_partkey, l_quantity, l_extendedprice) AS rn FROM lineitem) numbered)"""

GAMES = LINES + f""",
games AS (
  SELECT h.pair_id AS game_id, {_season('o_orderdate')} AS season_id, o_orderdate AS date,
    h.l_suppkey AS home_team_id, a.l_suppkey AS away_team_id, o_custkey AS venue_id,
    CASE WHEN o_orderstatus = 'F' THEN h.score END AS home_score,
    CASE WHEN o_orderstatus = 'F' THEN a.score END AS away_score,
    CASE o_orderstatus WHEN 'F' THEN 'final' WHEN 'O' THEN 'scheduled' ELSE 'in_progress' END AS status,
    h.l_returnflag = 'R' AS neutral_site, o_orderpriority = '1-URGENT' AS conference_game
  FROM orders
  JOIN lines h ON h.l_orderkey = o_orderkey AND h.rn % 2 = 1
  JOIN lines a ON a.l_orderkey = o_orderkey AND a.rn = h.rn + 1
  WHERE h.l_suppkey <> a.l_suppkey)"""

TEAM_GAMES = GAMES + """,
sides AS (
  SELECT game_id, season_id, date, CAST(date AS DATE) AS day, neutral_site, conference_game,
    home_team_id AS team_id, away_team_id AS opponent_id, TRUE AS is_home,
    home_score AS pf, away_score AS pa FROM games
  UNION ALL
  SELECT game_id, season_id, date, CAST(date AS DATE), neutral_site, conference_game,
    away_team_id, home_team_id, FALSE, away_score, home_score FROM games),
tg AS (
  SELECT *, pf IS NOT NULL AND pa IS NOT NULL AS played,
    coalesce(pf > pa, FALSE) AS win, coalesce(pf < pa, FALSE) AS loss FROM sides)"""

TIMELINE = TEAM_GAMES + """,
indexed AS (
  SELECT *,
    count(CASE WHEN played THEN 1 END) OVER before + 1 AS position,
    coalesce(sum(CAST(win AS INTEGER)) OVER before, 0) AS w,
    coalesce(sum(CAST(loss AS INTEGER)) OVER before, 0) AS l,
    coalesce(sum(pf) OVER before, 0) AS spf, coalesce(sum(pa) OVER before, 0) AS spa,
    date_diff('day', lag(day) OVER ordered, day) AS rest
  FROM tg
  WINDOW ordered AS (PARTITION BY team_id, season_id ORDER BY date, game_id),
    before AS (PARTITION BY team_id, season_id ORDER BY date, game_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
marked AS (
  SELECT *,
    coalesce(max(CASE WHEN win THEN position END) OVER before, 0) AS last_win,
    coalesce(max(CASE WHEN loss THEN position END) OVER before, 0) AS last_loss,
    coalesce(max(CASE WHEN played AND NOT win AND NOT loss THEN position END) OVER before, 0) AS last_tie
  FROM indexed
  WINDOW before AS (PARTITION BY team_id, season_id ORDER BY date, game_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
timeline AS (
  SELECT *, w + l AS gp,
    CASE WHEN position = 1 THEN 0
      WHEN last_win = position - 1 THEN position - 1 - greatest(last_loss, last_tie)
      WHEN last_loss = position - 1 THEN greatest(last_win, last_tie) - (position - 1)
      ELSE 0 END AS streak
  FROM marked)"""


def _ratio(part: str, whole: str) -> str:
    return f"CASE WHEN coalesce({whole}, 0) = 0 THEN 0.0 ELSE coalesce(CAST({part} AS DOUBLE), 0) / {whole} END"


def _long(expression: str) -> str:
    return f"CAST({expression} AS BIGINT)"


# Window over the last n played games: played rows own their position, others repeat the next one.
def _span(n: int) -> str:
    return (
        "(PARTITION BY team_id, season_id ORDER BY position "
        f"RANGE BETWEEN {n} PRECEDING AND 1 PRECEDING)"
    )


def _recent(n: int) -> str:
    return f"""
    count(CASE WHEN played THEN 1 END) OVER last{n} AS g{n},
    coalesce(sum(CAST(win AS INTEGER)) OVER last{n}, 0) AS w{n},
    coalesce(sum(CAST(loss AS INTEGER)) OVER last{n}, 0) AS l{n},
    sum(pf) OVER last{n} AS pf{n}, sum(pa) OVER last{n} AS pa{n}"""


FORM = TIMELINE + f""",
sums AS (
  SELECT *, {_recent(5)}, {_recent(10)},
    count(CASE WHEN played THEN position END) OVER last10 AS n,
    sum(CASE WHEN played THEN position END) OVER last10 AS sx,
    sum(CASE WHEN played THEN pf - pa END) OVER last10 AS sy,
    sum(CASE WHEN played THEN position * (pf - pa) END) OVER last10 AS sxy,
    sum(CASE WHEN played THEN position * position END) OVER last10 AS sxx
  FROM timeline
  WINDOW last5 AS {_span(5)}, last10 AS {_span(10)}),
form AS (
  SELECT *, CASE WHEN n * sxx - sx * sx <> 0
    THEN CAST(n * sxy - sx * sy AS DOUBLE) / CAST(n * sxx - sx * sx AS DOUBLE) END AS trend
  FROM sums)"""

PAIRED = GAMES + """,
paired AS (
  SELECT *, least(home_team_id, away_team_id) AS team_low, greatest(home_team_id, away_team_id) AS team_high,
    home_score IS NOT NULL AND away_score IS NOT NULL AS played,
    coalesce(CASE WHEN home_team_id < away_team_id THEN home_score > away_score ELSE away_score > home_score END, FALSE) AS low_win,
    coalesce(CASE WHEN home_team_id < away_team_id THEN home_score < away_score ELSE away_score < home_score END, FALSE) AS high_win,
    CASE WHEN home_team_id < away_team_id THEN home_score - away_score ELSE away_score - home_score END AS low_margin
  FROM games)"""

MEETINGS = """,
history AS (
  SELECT game_id, home_team_id, away_team_id, team_low,
    coalesce(sum(CAST(played AS INTEGER)) OVER before, 0) AS m,
    coalesce(sum(CAST(low_win AS INTEGER)) OVER before, 0) AS lw,
    coalesce(sum(CAST(high_win AS INTEGER)) OVER before, 0) AS hw
  FROM paired
  WINDOW before AS (PARTITION BY team_low, team_high ORDER BY date, game_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
h2h AS (
  SELECT game_id, home_team_id, away_team_id, CAST(m AS BIGINT) AS h2h_meetings,
    CAST(CASE WHEN home_team_id = team_low THEN lw ELSE hw END AS BIGINT) AS h2h_home_wins,
    CAST(CASE WHEN home_team_id = team_low THEN hw ELSE lw END AS BIGINT) AS h2h_away_wins
  FROM history)"""

_PAYLOAD = """'{"date":"' || d || '","games":' || n || ',"final":' || f || ',"first":' || lo || ',"last":' || hi || '}'"""

CAPTURES = f"""
days AS (
  SELECT strftime(o_orderdate, '%Y-%m-%d') AS d, o_orderstatus, o_orderkey FROM orders),
counts1 AS (
  SELECT d, count(*) AS n, count(*) AS f, min(o_orderkey) AS lo, max(o_orderkey) AS hi
  FROM days WHERE o_orderstatus = 'F' GROUP BY d),
counts2 AS (
  SELECT d, count(*) AS n, count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS f,
    min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM days GROUP BY d),
cap1 AS (SELECT d, {_PAYLOAD} AS raw FROM counts1),
cap2 AS (SELECT d, {_PAYLOAD} AS raw FROM counts2)"""

_BRONZE_STATE = f"""WITH {CAPTURES}
SELECT cap2.d AS date, '{{"dates":"' || replace(cap2.d, '-', '') || '"}}' AS parameters,
  sha256(cap2.raw) AS content_hash, cap2.raw AS raw_data,
  CASE WHEN cap1.raw = cap2.raw THEN '2024-01-01 00:00:00' ELSE '2024-02-01 00:00:00' END AS created_at,
  substr(cap2.d, 1, 4) AS year, substr(cap2.d, 6, 2) AS month
FROM cap2 LEFT JOIN cap1 ON cap1.d = cap2.d"""

ORACLE: dict[str, str] = {
    "bronze_hash": """SELECT doc_id, sha256(text) AS content_hash, substr(sha256(text), 1, 10) AS hash_prefix
FROM documents""",
    "bronze_partitions": """SELECT strftime(o_orderdate, '%Y') AS year, strftime(o_orderdate, '%m') AS month,
  count(*) AS records FROM orders GROUP BY 1, 2""",
    "bronze_upsert": _BRONZE_STATE,
    "stream_upsert": _BRONZE_STATE,
    "bronze_outcomes": f"""WITH {CAPTURES}
SELECT 'first' AS run, count(*) AS inserted, CAST(0 AS BIGINT) AS updated, CAST(0 AS BIGINT) AS unchanged,
  count(*) AS keys FROM cap1
UNION ALL
SELECT 'second', count(CASE WHEN cap1.d IS NULL THEN 1 END), count(CASE WHEN cap1.raw <> cap2.raw THEN 1 END),
  count(CASE WHEN cap1.raw = cap2.raw THEN 1 END), count(*)
FROM cap2 LEFT JOIN cap1 ON cap1.d = cap2.d""",
    "source_metadata": f"""WITH {CAPTURES}
SELECT 'scoreboard' AS source_type, cap2.d AS source_date,
  'scoreboard/year=' || substr(cap2.d, 1, 4) || '/month=' || substr(cap2.d, 6, 2) AS file_path,
  sha256(cap2.raw) AS content_hash, FALSE AS processed
FROM cap2 LEFT JOIN cap1 ON cap1.d = cap2.d WHERE cap1.raw IS NULL OR cap1.raw <> cap2.raw""",
    "team_upsert": """WITH b AS (
  SELECT c_nationkey, c_mktsegment, count(*) AS n2, max(c_custkey) AS x2,
    count(CASE WHEN c_acctbal > 0 THEN 1 END) AS n1, max(CASE WHEN c_acctbal > 0 THEN c_custkey END) AS x1
  FROM customer GROUP BY 1, 2),
r AS (SELECT *, '{"count":' || n2 || ',"last":' || x2 || '}' AS raw FROM b)
SELECT '{"nation":' || c_nationkey || ',"segment":"' || c_mktsegment || '"}' AS parameters,
  sha256(raw) AS content_hash, raw AS raw_data,
  CASE WHEN n1 = n2 AND x1 = x2 THEN '2024-01-01 00:00:00' ELSE '2024-02-01 00:00:00' END AS created_at
FROM r""",
    "bronze_insert_absent": """WITH o AS (
  SELECT strftime(o_orderdate, '%Y-%m-%d') AS date, 'order/' || o_orderkey AS source_url, o_orderstatus AS raw_data,
    CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END AS batch FROM orders)
SELECT row_number() OVER (ORDER BY batch, date, substr(sha256(source_url), 1, 2), source_url) AS id,
  date, source_url, raw_data FROM o""",
    "read_latest": """WITH e AS (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS pos FROM events)
SELECT user_id, event_type, event_id, value, props FROM e WHERE pos = 1""",
    "processed_dates": "SELECT DISTINCT strftime(o_orderdate, '%Y-%m-%d') AS date FROM orders",
    "skip_processed": """SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders
EXCEPT SELECT CAST(o_orderdate AS DATE) FROM orders WHERE o_orderstatus = 'F'""",
    "migration_check": f"""WITH {CAPTURES}, j AS (
  SELECT cap1.raw AS a, cap2.raw AS b FROM cap1 FULL OUTER JOIN cap2 ON cap1.d = cap2.d)
SELECT 'scoreboard' AS "table", count(a) AS source_count, count(a) AS target_count, count(a) AS matched,
  CAST(0 AS BIGINT) AS different, CAST(0 AS BIGINT) AS missing, CAST(0 AS BIGINT) AS extra,
  TRUE AS content_match, 'migrated' AS stage FROM j
UNION ALL
SELECT 'scoreboard', count(a), count(b), count(CASE WHEN a = b THEN 1 END), count(CASE WHEN a <> b THEN 1 END),
  count(CASE WHEN b IS NULL THEN 1 END), count(CASE WHEN a IS NULL THEN 1 END),
  count(CASE WHEN a IS DISTINCT FROM b THEN 1 END) = 0, 'later capture' FROM j""",
    "changed_keys": f"""WITH {CAPTURES}
SELECT cap2.d AS date, sha256(cap2.raw) AS content_hash,
  CASE WHEN cap1.raw IS NULL THEN 'new' ELSE 'changed' END AS change
FROM cap2 LEFT JOIN cap1 ON cap1.d = cap2.d WHERE cap1.raw IS NULL OR cap1.raw <> cap2.raw""",
    "page_completeness": """SELECT conv_id, count(DISTINCT turn) AS pages_present,
  CAST(max(turn) + 1 AS BIGINT) AS pages_announced, count(DISTINCT turn) = max(turn) + 1 AS complete
FROM conversations GROUP BY conv_id""",
    "schedule_calendar": f"""WITH d AS (
  SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS DATE) AS date FROM orders),
n AS (SELECT CAST(o_orderdate AS DATE) AS date, count(*) AS n FROM orders GROUP BY 1)
SELECT d.date, strftime(d.date, '%Y%m%d') AS api_date, {_winter_season('d.date')} AS season_id,
  coalesce(n.n, 0) AS orders FROM d LEFT JOIN n ON n.date = d.date""",
    "season_calendar": f"""WITH o AS (
  SELECT {_winter_season('o_orderdate')} AS season_id,
    CASE WHEN month(o_orderdate) >= 11 OR month(o_orderdate) <= 4
      THEN year(o_orderdate) + CASE WHEN month(o_orderdate) >= 11 THEN 1 ELSE 0 END END AS y FROM orders)
SELECT season_id, season_id || ' season' AS name, make_date(y - 1, 11, 1) AS start_date,
  make_date(y, 4, 30) AS end_date, CAST(y AS INTEGER) AS year, count(*) AS orders
FROM o GROUP BY season_id, y""",
    "request_manifest": """SELECT DISTINCT CAST(o_orderdate AS DATE) AS date, 'scoreboard' AS endpoint,
  'https://scores.example.org/v2/scoreboard' AS source_url,
  '{"dates":"' || strftime(o_orderdate, '%Y%m%d') || '","groups":"50","limit":200}' AS parameters FROM orders""",
    "team_manifest": """SELECT s_suppkey AS team_id, 'team_detail' AS endpoint,
  'https://scores.example.org/v2/teams/' || s_suppkey AS source_url, '{}' AS parameters FROM supplier""",
    "json_extract": """SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
  coalesce(CAST(json_extract_string(props, '$.neutral') AS BOOLEAN), FALSE) AS neutral,
  CAST(json_extract_string(props, '$.score') AS INTEGER) AS score FROM events""",
    "payload_to_games": f"""WITH {GAMES}
SELECT CAST(game_id AS VARCHAR) AS game_id, season_id, CAST(2 AS INTEGER) AS season_type, CAST(date AS DATE) AS date,
  CAST(home_team_id AS VARCHAR) AS home_team_id, CAST(away_team_id AS VARCHAR) AS away_team_id,
  CAST(venue_id AS VARCHAR) AS venue_id, home_score, away_score, status, neutral_site, conference_game
FROM games""",
    "silver_incremental": f"""WITH {GAMES}
SELECT CAST(game_id AS VARCHAR) AS game_id, season_id, CAST(2 AS INTEGER) AS season_type,
  CAST(CASE WHEN status = 'scheduled' THEN date + INTERVAL 1 DAY ELSE date END AS DATE) AS date,
  CAST(home_team_id AS VARCHAR) AS home_team_id, CAST(away_team_id AS VARCHAR) AS away_team_id,
  CAST(venue_id AS VARCHAR) AS venue_id, home_score, away_score, status, neutral_site, conference_game
FROM games WHERE status <> 'in_progress'""",
    "payload_to_teams": f"""WITH {TEAM_GAMES}
SELECT DISTINCT CAST(team_id AS VARCHAR) AS team_id, s_name AS name, '#' || printf('%06X', team_id) AS color
FROM tg JOIN supplier ON s_suppkey = team_id""",
    "payload_to_venues": f"""WITH {GAMES}
SELECT DISTINCT CAST(venue_id AS VARCHAR) AS venue_id, c_name AS name, c_mktsegment AS city
FROM games JOIN customer ON c_custkey = venue_id""",
    "payload_statistics": f"""WITH {TEAM_GAMES}
SELECT CAST(game_id AS VARCHAR) AS game_id, CAST(team_id AS VARCHAR) AS team_id, season_id,
  pf AS points, pf AS rebounds FROM tg""",
    "request_truncation": """SELECT CAST(o_orderdate AS DATE) AS date, count(*) AS events, count(*) >= 10 AS maybe_truncated
FROM orders GROUP BY 1""",
    "stats_pivot": f"""WITH {LINES}
SELECT pair_id AS game_id, l_suppkey AS team_id, CAST(l_quantity AS INTEGER) AS points,
  l_linenumber AS field_goals_made, l_linenumber + CAST(l_quantity AS INTEGER) AS field_goals_attempted,
  l_linenumber * 100.0::DOUBLE / (l_linenumber + CAST(l_quantity AS INTEGER)) AS field_goal_pct,
  CAST(l_quantity AS INTEGER) AS rebounds, CAST(round(l_discount * 100) AS INTEGER) AS assists,
  CAST(round(l_tax * 100) AS INTEGER) AS turnovers FROM lines""",
    "stats_long": f"""WITH s AS (SELECT {_season('o_orderdate')} AS season_id, l_linenumber AS n,
    CAST(l_quantity AS INTEGER) AS q, CAST(round(l_discount * 100) AS INTEGER) AS a,
    CAST(round(l_tax * 100) AS INTEGER) AS t FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey)
SELECT u.statistic, season_id, count(*) AS entries, CAST(sum(u.value) AS BIGINT) AS total FROM (
  SELECT 'fieldGoalsMade' AS statistic, season_id, n AS value FROM s
  UNION ALL SELECT 'fieldGoalsAttempted', season_id, n + q FROM s
  UNION ALL SELECT 'rebounds', season_id, q FROM s
  UNION ALL SELECT 'assists', season_id, a FROM s
  UNION ALL SELECT 'turnovers', season_id, t FROM s) u GROUP BY 1, 2""",
    "season_team_stats": f"""WITH {LINES},
s AS (SELECT l_suppkey AS team_id, {_season('o_orderdate')} AS season_id, pair_id,
    l_linenumber AS n, CAST(l_quantity AS INTEGER) AS q, CAST(round(l_discount * 100) AS INTEGER) AS a,
    CAST(round(l_tax * 100) AS INTEGER) AS t FROM lines LEFT JOIN orders ON o_orderkey = l_orderkey)
SELECT team_id, season_id, count(DISTINCT pair_id) AS games, CAST(sum(q) AS BIGINT) AS points,
  CAST(sum(n) AS BIGINT) AS field_goals_made, CAST(sum(n + q) AS BIGINT) AS field_goals_attempted,
  CAST(sum(n) AS DOUBLE) * 100 / CAST(sum(n + q) AS DOUBLE) AS field_goal_pct, CAST(sum(q) AS BIGINT) AS rebounds,
  CAST(sum(a) AS BIGINT) AS assists, CAST(sum(t) AS BIGINT) AS turnovers FROM s GROUP BY 1, 2""",
    "unpaired_lines": f"""WITH {LINES}, mates AS (
  SELECT h.*, CASE WHEN o.o_orderkey IS NULL THEN 'no order' WHEN m.pair_id IS NULL THEN 'last line'
    WHEN m.l_suppkey IS NULL OR h.l_suppkey IS NULL OR m.l_suppkey = h.l_suppkey THEN 'same team' END AS reason
  FROM lines h LEFT JOIN lines m ON m.pair_id = h.pair_id AND m.rn <> h.rn
  LEFT JOIN (SELECT DISTINCT o_orderkey FROM orders) o ON o.o_orderkey = h.l_orderkey)
SELECT l_orderkey, l_linenumber, l_suppkey, reason FROM mates WHERE reason IS NOT NULL""",
    "line_balance": f"""WITH {GAMES}
SELECT 'all' AS part, count(*) AS lines FROM lineitem
UNION ALL SELECT 'in games', 2 * count(*) FROM games
UNION ALL SELECT 'unpaired', (SELECT count(*) FROM lineitem) - 2 * count(*) FROM games""",
    "status_counts": """SELECT CASE o_orderstatus WHEN 'F' THEN 'final' WHEN 'O' THEN 'scheduled'
  WHEN 'P' THEN 'in_progress' END AS status, count(*) AS games FROM orders GROUP BY 1""",
    "game_dimensions": f"""WITH {GAMES}
SELECT game_id, hs.s_name AS home_team, hn.n_name AS home_conference, s.s_name AS away_team,
  n.n_name AS away_conference, c_name AS venue, c_mktsegment AS venue_city
FROM games LEFT JOIN supplier hs ON hs.s_suppkey = home_team_id LEFT JOIN nation hn ON hn.n_nationkey = hs.s_nationkey
LEFT JOIN supplier s ON s.s_suppkey = away_team_id LEFT JOIN nation n ON n.n_nationkey = s.s_nationkey
LEFT JOIN customer ON c_custkey = venue_id""",
    "conference_teams": """SELECT n_name AS conference, r_name AS division, count(s_suppkey) AS teams
FROM nation LEFT JOIN region ON r_regionkey = n_regionkey LEFT JOIN supplier ON s_nationkey = n_nationkey
GROUP BY n_nationkey, n_name, r_name""",
    "conference_games": f"""WITH {GAMES}
SELECT s_nationkey AS conference_id, season_id, count(*) AS games
FROM games LEFT JOIN supplier ON s_suppkey = home_team_id GROUP BY 1, 2""",
    "season_record": f"""WITH {TEAM_GAMES}, s AS (
  SELECT team_id, season_id, count(CASE WHEN win THEN 1 END) AS wins, count(CASE WHEN loss THEN 1 END) AS losses,
    sum(pf) AS spf, sum(pa) AS spa FROM tg GROUP BY 1, 2)
SELECT team_id, season_id, wins + losses AS games_played, wins, losses, {_ratio('wins', '(wins + losses)')} AS win_pct,
  {_ratio('spf', '(wins + losses)')} AS avg_points_for, {_ratio('spa', '(wins + losses)')} AS avg_points_against
FROM s""",
    "record_splits": f"""WITH {TEAM_GAMES}
SELECT team_id, season_id,
  count(CASE WHEN win AND is_home AND NOT neutral_site THEN 1 END) AS home_wins,
  count(CASE WHEN loss AND is_home AND NOT neutral_site THEN 1 END) AS home_losses,
  count(CASE WHEN win AND NOT is_home AND NOT neutral_site THEN 1 END) AS away_wins,
  count(CASE WHEN loss AND NOT is_home AND NOT neutral_site THEN 1 END) AS away_losses,
  count(CASE WHEN win AND neutral_site THEN 1 END) AS neutral_wins,
  count(CASE WHEN loss AND neutral_site THEN 1 END) AS neutral_losses,
  count(CASE WHEN win AND conference_game THEN 1 END) AS conference_wins,
  count(CASE WHEN loss AND conference_game THEN 1 END) AS conference_losses
FROM tg GROUP BY 1, 2""",
    "season_to_date": f"""WITH {TIMELINE}
SELECT game_id, team_id, season_id, {_long('gp')} AS prior_games, {_long('w')} AS prior_wins, {_long('l')} AS prior_losses,
  {_ratio('w', 'gp')} AS prior_win_pct, {_ratio('spf', 'gp')} AS prior_avg_points_for,
  {_ratio('spa', 'gp')} AS prior_avg_points_against FROM timeline""",
    **{
        f"form_last{n}": f"""WITH {FORM}
SELECT game_id, team_id, season_id, g{n} AS last{n}_games, {_long(f'w{n}')} AS last{n}_wins,
  {_long(f'l{n}')} AS last{n}_losses, {_ratio(f'w{n}', f'(w{n} + l{n})')} AS last{n}_win_pct,
  {_ratio(f'pf{n}', f'g{n}')} AS last{n}_avg_points_for, {_ratio(f'pa{n}', f'g{n}')} AS last{n}_avg_points_against
FROM form"""
        for n in (5, 10)
    },
    "rest_days": f"""WITH {TIMELINE}
SELECT game_id, team_id, season_id, CAST(rest AS INTEGER) AS rest_days FROM timeline""",
    "streaks": f"""WITH {TIMELINE}
SELECT game_id, team_id, season_id, {_long('streak')} AS streak FROM timeline""",
    "trends": f"""WITH {FORM}
SELECT game_id, team_id, season_id, trend AS margin_trend FROM form""",
    "head_to_head": f"""WITH {PAIRED}{MEETINGS}
SELECT game_id, home_team_id, away_team_id, h2h_meetings, h2h_home_wins, h2h_away_wins FROM h2h""",
    "matchups": f"""WITH {PAIRED}
SELECT team_low, team_high, count(CASE WHEN played THEN 1 END) AS meetings,
  count(CASE WHEN low_win THEN 1 END) AS low_wins, count(CASE WHEN high_win THEN 1 END) AS high_wins,
  {_ratio('sum(low_margin)', 'count(low_margin)')} AS avg_low_margin FROM paired GROUP BY 1, 2""",
    "opponent_strength": f"""WITH {TIMELINE}
SELECT t.game_id, t.team_id, t.opponent_id, o.season_id, {_long('o.gp')} AS opp_prior_games,
  {_ratio('o.w', 'o.gp')} AS opp_prior_win_pct, {_ratio('o.spf', 'o.gp')} AS opp_prior_avg_points_for
FROM timeline t JOIN timeline o ON o.game_id = t.game_id AND o.team_id = t.opponent_id""",
    "game_context": f"""WITH {TIMELINE},{PAIRED[len(GAMES) + 1:]}{MEETINGS}
SELECT t.game_id, t.team_id, t.season_id,
  CASE WHEN neutral_site THEN 'neutral' WHEN is_home THEN 'home' ELSE 'away' END AS site,
  CAST(rest AS INTEGER) AS rest_days, conference_game, h2h_meetings,
  CASE WHEN is_home THEN h2h_home_wins ELSE h2h_away_wins END AS h2h_wins,
  CASE WHEN is_home THEN h2h_away_wins ELSE h2h_home_wins END AS h2h_losses
FROM timeline t JOIN h2h ON h2h.game_id = t.game_id""",
    "team_games": f"""WITH {TEAM_GAMES}
SELECT team_id, season_id, day AS game_day, game_id, opponent_id, is_home, pf AS points_for, pa AS points_against,
  win, loss FROM tg""",
    "matchup_games": f"""WITH {PAIRED}
SELECT team_low, team_high, game_id, home_score, away_score FROM paired""",
    "games_in_range": f"""WITH {GAMES}
SELECT game_id, season_id, home_team_id, away_team_id FROM games
WHERE CAST(date AS DATE) BETWEEN DATE '1997-01-01' AND DATE '1997-12-31'""",
    "upcoming_games": f"""WITH {GAMES}
SELECT game_id, home_team_id, away_team_id, status FROM games
WHERE status = 'scheduled' AND date >= TIMESTAMP '2000-01-01 00:00:00'""",
    "conference_flag": f"""WITH {GAMES}
SELECT game_id, coalesce(h.s_nationkey = a.s_nationkey, FALSE) AS conference_game FROM games
LEFT JOIN supplier h ON h.s_suppkey = home_team_id LEFT JOIN supplier a ON a.s_suppkey = away_team_id""",
    "division_games": f"""WITH {GAMES}, asia AS (
  SELECT s_suppkey FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey
  WHERE r_name = 'ASIA')
SELECT game_id, home_team_id, away_team_id FROM games
WHERE home_team_id IN (SELECT s_suppkey FROM asia) OR away_team_id IN (SELECT s_suppkey FROM asia)""",
    "game_statistics": f"""WITH {TEAM_GAMES}
SELECT game_id, team_id, s_name AS team, opponent_id, is_home, win, CAST(l_quantity AS INTEGER) AS rebounds,
  CAST(round(l_discount * 100) AS INTEGER) AS assists
FROM lines JOIN tg ON game_id = pair_id AND team_id = l_suppkey JOIN supplier ON s_suppkey = team_id""",
    "refreshed_features": f"""WITH {FORM}
SELECT game_id, team_id, season_id, {_long('gp')} AS prior_games, {_long('w')} AS prior_wins,
  {_long('w5')} AS last5_wins, {_long('streak')} AS streak, CAST(rest AS INTEGER) AS rest_days FROM form""",
    "quality_rules": f"""WITH {GAMES}
SELECT 'games' AS "table", 'game_id unique' AS rule,
  (SELECT count(*) FROM (SELECT game_id FROM games GROUP BY 1 HAVING count(*) > 1)) AS violations
UNION ALL SELECT 'teams', 'team_id unique',
  (SELECT count(*) FROM (SELECT s_suppkey FROM supplier GROUP BY 1 HAVING count(*) > 1))
UNION ALL SELECT 'teams', 'team_id required', (SELECT count(*) FROM supplier WHERE s_suppkey IS NULL)
UNION ALL SELECT 'teams', 'name required', (SELECT count(*) FROM supplier WHERE s_name IS NULL)
UNION ALL SELECT 'games', 'game_id required', (SELECT count(*) FROM games WHERE game_id IS NULL)
UNION ALL SELECT 'games', 'date required', (SELECT count(*) FROM games WHERE date IS NULL)
UNION ALL SELECT 'games', 'home_score at least 0', (SELECT count(*) FROM games WHERE home_score < 0)
UNION ALL SELECT 'games', 'away_score at least 0', (SELECT count(*) FROM games WHERE away_score < 0)
UNION ALL SELECT 'games', 'teams differ', (SELECT count(*) FROM games WHERE home_team_id = away_team_id)
UNION ALL SELECT 'games', 'final games have scores',
  (SELECT count(*) FROM games WHERE status = 'final' AND (home_score IS NULL OR away_score IS NULL))
UNION ALL SELECT 'games', 'home_team_id references team_id',
  (SELECT count(*) FROM games WHERE home_team_id NOT IN (SELECT s_suppkey FROM supplier))
UNION ALL SELECT 'games', 'away_team_id references team_id',
  (SELECT count(*) FROM games WHERE away_team_id NOT IN (SELECT s_suppkey FROM supplier))
UNION ALL SELECT 'games', 'venue_id references venue_id',
  (SELECT count(*) FROM games WHERE venue_id NOT IN (SELECT c_custkey FROM customer))
UNION ALL SELECT 'games', 'home_score at most 45', (SELECT count(*) FROM games WHERE home_score > 45)""",
    "key_checks": """SELECT 'lineitem' AS "table", 'l_orderkey, l_linenumber unique' AS rule,
  (SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)) AS violations
UNION ALL SELECT 'orders', 'o_orderkey unique',
  (SELECT count(*) FROM (SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1))
UNION ALL SELECT 'lineitem', 'l_orderkey references o_orderkey',
  (SELECT count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders))
UNION ALL SELECT 'lineitem', 'l_suppkey references s_suppkey',
  (SELECT count(*) FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier))
UNION ALL SELECT 'orders', 'o_custkey references c_custkey',
  (SELECT count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer))
UNION ALL SELECT 'labels', 'doc_id references doc_id',
  (SELECT count(*) FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents))""",
    "lineage_edges": f"""WITH {TEAM_GAMES} SELECT DISTINCT game_id, team_id, season_id FROM tg""",
    "lineage_impact": f"""WITH {CAPTURES}, {TEAM_GAMES.strip()}
SELECT DISTINCT team_id, season_id FROM tg
WHERE strftime(date, '%Y-%m-%d') IN (SELECT cap2.d FROM cap2 LEFT JOIN cap1 ON cap1.d = cap2.d
  WHERE cap1.raw IS NULL OR cap1.raw <> cap2.raw)""",
    "job_history": """WITH p AS (SELECT o_orderdate, o_orderstatus, count(*) AS n FROM orders GROUP BY 1, 2)
SELECT 'scoreboard' AS job, count(DISTINCT CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END) AS successful,
  count(CASE WHEN o_orderstatus = 'P' THEN 1 END) AS failed,
  count(DISTINCT CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END) AS inserted,
  CAST(0 AS BIGINT) AS updated, CAST(0 AS BIGINT) AS unchanged FROM p""",
}

_FEATURES = {
    "prior_games": _long("{s}.gp"),
    "prior_win_pct": _ratio("{s}.w", "{s}.gp"),
    "prior_avg_points_for": _ratio("{s}.spf", "{s}.gp"),
    "prior_avg_points_against": _ratio("{s}.spa", "{s}.gp"),
    "last5_win_pct": _ratio("{s}.w5", "({s}.w5 + {s}.l5)"),
    "last5_avg_points_for": _ratio("{s}.pf5", "{s}.g5"),
    "last5_avg_points_against": _ratio("{s}.pa5", "{s}.g5"),
    "last10_win_pct": _ratio("{s}.w10", "({s}.w10 + {s}.l10)"),
    "rest_days": "CAST({s}.rest AS INTEGER)",
    "streak": _long("{s}.streak"),
    "margin_trend": "{s}.trend",
}


def _feature_columns() -> str:
    parts = []
    for name, expression in _FEATURES.items():
        home, away = expression.format(s="h"), expression.format(s="a")
        parts.append(f"{home} AS home_{name}, {away} AS away_{name}, ({home}) - ({away}) AS diff_{name}")
    return ",\n  ".join(parts)


_PREDICTION = f"""WITH {FORM},{PAIRED[len(GAMES) + 1:]}{MEETINGS}, features AS (
SELECT g.game_id, g.season_id, CAST(g.date AS DATE) AS game_date, g.status, g.home_team_id, g.away_team_id,
  g.neutral_site, g.conference_game,
  {_feature_columns()},
  h2h_meetings, h2h_home_wins, h2h_away_wins,
  CASE WHEN g.home_score > g.away_score THEN 1 WHEN g.home_score < g.away_score THEN 0 END AS home_win,
  g.home_score - g.away_score AS spread, g.home_score + g.away_score AS total
FROM games g JOIN form h ON h.game_id = g.game_id AND h.is_home
JOIN form a ON a.game_id = g.game_id AND NOT a.is_home JOIN h2h ON h2h.game_id = g.game_id)"""

ORACLE["prediction_features"] = f"{_PREDICTION} SELECT * FROM features"

ORACLE["refreshed_predictions"] = f"""{_PREDICTION}
SELECT game_id, home_team_id, away_team_id, home_prior_games, away_prior_games, home_streak, away_streak,
  h2h_meetings, home_win FROM features"""

ORACLE["baseline_metrics"] = f"""{_PREDICTION}, p AS (
  SELECT home_win = 1 AS y, diff_prior_win_pct >= 0 AS p FROM features WHERE home_win IS NOT NULL),
c AS (
  SELECT count(*) AS games, count(CASE WHEN y AND p THEN 1 END) AS true_positive,
    count(CASE WHEN NOT y AND p THEN 1 END) AS false_positive,
    count(CASE WHEN NOT y AND NOT p THEN 1 END) AS true_negative,
    count(CASE WHEN y AND NOT p THEN 1 END) AS false_negative FROM p)
SELECT *, {_ratio('(true_positive + true_negative)', 'games')} AS accuracy,
  {_ratio('true_positive', '(true_positive + false_positive)')} AS "precision",
  {_ratio('true_positive', '(true_positive + false_negative)')} AS recall FROM c"""

ORACLE["feature_summary"] = f"WITH record AS ({ORACLE['season_record']})" + " UNION ALL ".join(
    f"""
SELECT '{c}' AS feature, count({c}) AS "values", count(*) - count({c}) AS nulls, CAST(min({c}) AS DOUBLE) AS minimum,
  CAST(max({c}) AS DOUBLE) AS maximum, round(avg({c}), 6) AS mean FROM record"""
    for c in ("games_played", "wins", "losses", "win_pct")
)

# Gold kept by the stream: games in progress were withdrawn, scheduled ones keep their season.
LIVE_TEAM_GAMES = (
    GAMES + ",\nlive AS (SELECT * FROM games WHERE status <> 'in_progress')" + TEAM_GAMES[len(GAMES) :].replace("FROM games", "FROM live")
)
ORACLE["stream_to_gold"] = ORACLE["season_record"].replace(TEAM_GAMES, LIVE_TEAM_GAMES, 1)

ORACLE["lineage_models"] = f"""WITH {CAPTURES}, {TEAM_GAMES.strip()},
changed AS (SELECT cap2.d FROM cap2 LEFT JOIN cap1 ON cap1.d = cap2.d WHERE cap1.raw IS NULL OR cap1.raw <> cap2.raw),
hit AS (SELECT DISTINCT game_id, team_id, season_id FROM tg WHERE strftime(date, '%Y-%m-%d') IN (SELECT d FROM changed)),
edges AS (SELECT DISTINCT 'all' AS model_id, season_id FROM tg
  UNION SELECT DISTINCT 'season-' || season_id, season_id FROM tg),
per_season AS (SELECT season_id, count(DISTINCT game_id) AS g, count(DISTINCT team_id) AS t FROM hit GROUP BY 1)
SELECT e.model_id, count(DISTINCT e.season_id) AS seasons, CAST(coalesce(sum(p.g), 0) AS BIGINT) AS changed_games,
  CAST(coalesce(sum(p.t), 0) AS BIGINT) AS changed_groups, coalesce(sum(p.g), 0) > 0 AS stale
FROM edges e LEFT JOIN per_season p ON p.season_id = e.season_id GROUP BY 1"""

ORACLE["model_auc"] = f"""WITH {TEAM_GAMES}, rec AS (
  SELECT team_id, season_id, count(CASE WHEN win THEN 1 END) AS wins FROM tg GROUP BY 1, 2),
s AS (SELECT CAST(h.wins - a.wins AS DOUBLE) AS score, CASE WHEN g.home_score > g.away_score THEN 1 ELSE 0 END AS label
  FROM games g JOIN rec h ON h.team_id = g.home_team_id AND h.season_id = g.season_id
  JOIN rec a ON a.team_id = g.away_team_id AND a.season_id = g.season_id WHERE g.status = 'final'),
per AS (SELECT score, sum(label) AS pos, count(*) - sum(label) AS neg FROM s GROUP BY score),
c AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM per)
SELECT sum(pos * (below + 0.5 * neg)) / (sum(pos) * sum(neg)) AS auc, CAST(sum(pos) AS BIGINT) AS positives,
  CAST(sum(neg) AS BIGINT) AS negatives, CAST(0 AS BIGINT) AS skipped FROM c"""

ORACLE["team_by_id"] = f"""WITH {TEAM_GAMES}
SELECT DISTINCT CAST(team_id AS VARCHAR) AS team_id, s_name AS name, '#' || printf('%06X', team_id) AS color
FROM tg JOIN supplier ON s_suppkey = team_id
WHERE team_id IN (SELECT home_team_id FROM games WHERE status = 'scheduled'
  UNION SELECT away_team_id FROM games WHERE status = 'scheduled')"""
