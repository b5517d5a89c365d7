"""The same results in DuckDB SQL, over the same tables."""

from __future__ import annotations

MATCHES = """
matches AS (
  SELECT event_id AS match_id, ts AS match_ts, CAST(ts AS DATE) AS match_date,
    lpad(CAST(CAST(7 + ceil(day(ts) / 2.0) AS INT) AS VARCHAR), 2, '0')
      || lpad(CAST(CAST(8 + ceil(day(ts) / 2.0) AS INT) AS VARCHAR), 2, '0') AS season,
    league, league || '_' || CAST(user_id % 20 AS VARCHAR) AS home_team,
    league || '_' || CAST((user_id + 1 + event_id % 19) % 20 AS VARCHAR) AS away_team,
    fthg, ftag,
    CASE WHEN event_id % 31 = 0 THEN NULL WHEN fthg > ftag THEN 'H'
         WHEN fthg < ftag THEN 'A' ELSE 'D' END AS ftr,
    CASE WHEN event_id % 17 = 0 THEN NULL ELSE CAST(5 + event_id % 13 AS INT) END AS hf,
    CAST(5 + event_id % 11 AS INT) AS af,
    CAST(event_id % 4 AS INT) AS hy, CAST(event_id % 3 AS INT) AS ay,
    CASE WHEN event_id % 23 = 0 THEN 1 ELSE 0 END AS hr,
    CASE WHEN event_id % 29 = 0 THEN 1 ELSE 0 END AS ar
  FROM (SELECT *,
      CASE event_type WHEN 'click' THEN 'E0' WHEN 'error' THEN 'SP1' WHEN 'purchase' THEN 'D1'
                      WHEN 'signup' THEN 'I1' WHEN 'view' THEN 'F1' END AS league,
      CAST(CAST(round(value * 100) AS BIGINT) % 5 AS INT) AS fthg,
      CAST(CAST(json_extract_string(props, '$.k') AS INT) % 4 AS INT) AS ftag
    FROM events) e
),
scored AS (
  SELECT *,
    CASE ftr WHEN 'H' THEN 3 WHEN 'D' THEN 1 ELSE 0 END AS hp,
    CASE ftr WHEN 'A' THEN 3 WHEN 'D' THEN 1 ELSE 0 END AS ap,
    hf * 2 + hy * 10 + hr * 25 AS hdi_fouls, af * 2 + ay * 10 + ar * 25 AS adi_fouls,
    hy * 5 + hr * 25 AS hdi_cards, ay * 5 + ar * 25 AS adi_cards
  FROM matches
),
team_rows AS (
  SELECT match_id, match_ts, match_date, season, league, 'H' AS side, home_team AS team, hp AS points,
    fthg AS goals, ftag AS conceded, hdi_cards AS discipline, ftr FROM scored
  UNION ALL
  SELECT match_id, match_ts, match_date, season, league, 'A', away_team, ap,
    ftag, fthg, adi_cards, ftr FROM scored
),
expected AS (
  SELECT lpad(CAST(y % 100 AS VARCHAR), 2, '0') || lpad(CAST((y + 1) % 100 AS VARCHAR), 2, '0') AS season,
    league FROM range(2008, 2024) AS r(y), (SELECT DISTINCT league FROM matches) l
)
"""

FIVE = "ORDER BY match_ts, match_id ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING"
SO_FAR = "ORDER BY match_ts, match_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
DAY_BEFORE = (
    "ORDER BY match_date RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL '1' DAY PRECEDING"
)


def _sum(value: str, group: str, frame: str = "", empty: int | None = None) -> str:
    total = f"CAST(sum({value}) OVER (PARTITION BY {group} {frame}) AS BIGINT)"
    return total if empty is None else f"coalesce({total}, {empty})"


def _query(body: str, more: str = "") -> str:
    return f"WITH {MATCHES}{more}\n{body}"


def _rolling(team: str, sums: dict[str, str], empty: int | None) -> str:
    columns = [f"{_sum(value, f'season, {team}', FIVE, empty)} AS {name}" for name, value in sums.items()]
    return _query(f"SELECT match_id, {', '.join(columns)} FROM scored")


FORM = f""",
form AS (
  SELECT match_id, side, {_sum('points', 'season, team', FIVE)} AS any5 FROM team_rows
)"""

FEATURES_A = _query(f"""
SELECT match_id, league AS div, match_date AS date, home_team AS hometeam, away_team AS awayteam,
  fthg, ftag, ftr, CAST(NULL AS INT) AS hthg, CAST(NULL AS INT) AS htag, CAST(NULL AS INT) AS hs,
  CAST(NULL AS INT) AS away_shots, CAST(NULL AS INT) AS hst, CAST(NULL AS INT) AS ast,
  CAST(NULL AS INT) AS hc, CAST(NULL AS INT) AS ac, hf, af, hy, ay, hr, ar, fthg - ftag AS gd,
  {_sum('ftag', 'season, away_team', FIVE, 0)} AS agl5,
  {_sum('fthg', 'season, home_team', FIVE, 0)} AS hgl5,
  {_sum('hp + ap', 'season', SO_FAR, 0)} AS htp,
  {_sum('hp + ap', 'season', SO_FAR, 0)} AS atp,
  {_sum('adi_fouls', 'season, away_team', FIVE, 0)} AS adil5,
  {_sum('hdi_fouls', 'season, home_team', FIVE, 0)} AS hdil5,
  {_sum('ap', 'season, away_team', FIVE, 0)} AS atfl5,
  {_sum('hp', 'season, home_team', FIVE, 0)} AS htfl5
FROM scored WHERE CAST(season AS INT) >= 2008""")

SEASON_POINTS = f"""
  {_sum('hp', 'season, home_team')} AS ht_pts_home, {_sum('ap', 'season, home_team')} AS ht_pts_away,
  {_sum('hp + ap', 'season, home_team')} AS htsp,
  {_sum('ap', 'season, away_team')} AS at_pts_away, {_sum('hp', 'season, away_team')} AS at_pts_home,
  {_sum('hp + ap', 'season, away_team')} AS atsp"""

SEASON_GOALS = f"""
  {_sum('fthg', 'season, home_team')} AS htasg, {_sum('ftag', 'season, away_team')} AS atasg,
  {_sum('fthg', 'season, home_team')} - {_sum('ftag', 'season, away_team')} AS sgd"""

FEATURES_B = _query(f"""
SELECT s.match_id, season, away_team AS awayteam, home_team AS hometeam, match_date AS matchdate,
  strftime(match_date, '%d/%m/%Y') AS date, league AS div, ftr, fthg, ftag,
  CAST(NULL AS VARCHAR) AS hthg, CAST(NULL AS VARCHAR) AS htag, CAST(NULL AS VARCHAR) AS hs,
  CAST(NULL AS VARCHAR) AS away_shots, CAST(NULL AS VARCHAR) AS hst, CAST(NULL AS VARCHAR) AS ast,
  CAST(NULL AS VARCHAR) AS hc, CAST(NULL AS VARCHAR) AS ac,
  CAST(hf AS VARCHAR) AS hf, CAST(af AS VARCHAR) AS af, hy, ay, hr, ar, league,
  hp AS homeresultscore, ap AS awayresultscore, hdi_cards AS hdi, adi_cards AS adi,
  {_sum('fthg', 'season, home_team', FIVE)} AS hgl5, {_sum('ftag', 'season, away_team', FIVE)} AS agl5,
  {_sum('hp', 'season, home_team', FIVE)} AS hthf5, {_sum('ap', 'season, away_team', FIVE)} AS ataf5,
  {_sum('hdi_cards', 'season, home_team', FIVE)} AS hdil5,
  {_sum('adi_cards', 'season, away_team', FIVE)} AS adil5,
  htfl5, atfl5, {SEASON_POINTS}, {SEASON_GOALS}
FROM scored s JOIN (SELECT match_id AS h, any5 AS htfl5 FROM form WHERE side = 'H') ON h = s.match_id
  JOIN (SELECT match_id AS a, any5 AS atfl5 FROM form WHERE side = 'A') ON a = s.match_id""", FORM)

STATE_FORM = _query(f"""
SELECT match_id, side, team, {_sum('points', 'season, league, team', FIVE)} AS form5 FROM team_rows""")

PER_SIDE = [
    "form5_any", "form5_venue", "goals5_venue", "discipline5_venue",
    "points_before", "goals_before", "conceded_before", "season_points",
]
TEAM = "season, league, team"
FEATURES_STRICT = _query(f"""
SELECT p.*, {', '.join(f'h.{name} AS home_{name}, a.{name} AS away_{name}' for name in PER_SIDE)},
  (h.goals_before - h.conceded_before) - (a.goals_before - a.conceded_before) AS goal_diff_before
FROM (SELECT * EXCLUDE (match_ts) FROM matches WHERE ftr IS NOT NULL) p
  JOIN f h ON h.match_id = p.match_id AND h.side = 'H'
  JOIN f a ON a.match_id = p.match_id AND a.side = 'A'""", f""",
f AS (
  SELECT match_id, side,
    {_sum('points', TEAM, FIVE)} AS form5_any, {_sum('points', TEAM + ', side', FIVE)} AS form5_venue,
    {_sum('goals', TEAM + ', side', FIVE)} AS goals5_venue,
    {_sum('discipline', TEAM + ', side', FIVE)} AS discipline5_venue,
    {_sum('points', TEAM, DAY_BEFORE)} AS points_before, {_sum('goals', TEAM, DAY_BEFORE)} AS goals_before,
    {_sum('conceded', TEAM, DAY_BEFORE)} AS conceded_before, {_sum('points', TEAM)} AS season_points
  FROM team_rows WHERE ftr IS NOT NULL
)""")

ROLLING_HOME_B = _rolling("home_team", {"hgl5": "fthg", "hthf5": "hp", "hdil5": "hdi_cards"}, None)
FORM_ANY = _query(
    "SELECT h.match_id, h.any5 AS htfl5, a.any5 AS atfl5 FROM form h JOIN form a"
    " ON h.match_id = a.match_id AND h.side = 'H' AND a.side = 'A'", FORM
)
SEASON_CUM = _query(
    f"SELECT match_id, {_sum('hp + ap', 'season', SO_FAR, 0)} AS htp,"
    f" {_sum('hp + ap', 'season', SO_FAR, 0)} AS atp FROM scored"
)
# a message: all columns but match_ts in order, numbers as numbers; nulls are left out
NUMBERS = ["fthg", "ftag", "hf", "af", "hy", "ay", "hr", "ar"]
FIELDS = ["match_id", "match_date", "season", "league", "home_team", "away_team", "fthg", "ftag", "ftr", *NUMBERS[2:]]
JSON_FIELDS = ", ".join(
    f"""'"{name}":' || {name}""" if name in ["match_id", *NUMBERS] else f"""'"{name}":"' || {name} || '"'""" for name in FIELDS
)
CSV_LINE = (
    "concat_ws(',', match_id, strftime(match_date, '%d/%m/%Y'), home_team, away_team, coalesce(ftr, ''), fthg, ftag)"
)
GOOD_AND_BAD = """
SELECT match_date, season, league, home_team, away_team, ftr, fthg, ftag, NULL AS raw FROM matches WHERE match_id % 37 <> 0
UNION ALL
SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, '{"Date":"' || strftime(match_date, '%d/%m/%Y') || '"'
FROM matches WHERE match_id % 37 = 0"""

LANDED = _query(
    "SELECT match_date, season, league, home_team, away_team, ftr, fthg, ftag FROM matches"
)

ORACLE: dict[str, str] = {
    "json_landing": _query("SELECT * EXCLUDE (match_ts) FROM matches"),
    "to_json_messages": _query(f"SELECT match_id, '{{' || concat_ws(',', {JSON_FIELDS}) || '}}' AS value FROM matches"),
    "cast_stats": _query(
        "SELECT match_id, CASE WHEN match_id % 41 = 0 THEN NULL ELSE fthg END AS fthg FROM matches"
    ),
    "parse_match_date": _query("SELECT match_id, match_date FROM matches"),
    "parse_match_date_fallback": _query(
        "SELECT match_id, CASE WHEN match_id % 5 <> 1 THEN match_date END AS match_date FROM matches"
    ),
    "form_by_date": _query(f"""
SELECT m.match_id, f.any5 AS htfl5 FROM matches m LEFT JOIN (
  SELECT season, match_date, team, {_sum('points', 'season, team', FIVE)} AS any5 FROM team_rows
) f ON f.season = m.season AND f.match_date = m.match_date AND f.team = m.home_team"""),
    "season_filter_compat": _query(
        "SELECT match_id, season FROM matches WHERE CAST(season AS INT) >= 2008"
    ),
    "season_filter_strict": _query(
        "SELECT match_id, season FROM matches WHERE 2000 + CAST(left(season, 2) AS INT) >= 2015"
    ),
    "match_points": _query("SELECT match_id, hp AS home_points, ap AS away_points FROM scored"),
    "goal_diff": _query("SELECT match_id, fthg - ftag AS gd FROM matches"),
    "discipline_fouls": _query("SELECT match_id, hdi_fouls AS hdi, adi_fouls AS adi FROM scored"),
    "discipline_cards": _query("SELECT match_id, hdi_cards AS hdi, adi_cards AS adi FROM scored"),
    "select_available": _query(
        "SELECT match_id, fthg, ftag, ftr, hf, af, hy, ay, hr, ar FROM matches"
    ),
    "rolling_home_a": _rolling("home_team", {"hgl5": "fthg", "htfl5": "hp", "hdil5": "hdi_fouls"}, 0),
    "rolling_away_a": _rolling("away_team", {"agl5": "ftag", "atfl5": "ap", "adil5": "adi_fouls"}, 0),
    "rolling_home_b": ROLLING_HOME_B,
    "rolling_home_b_split": ROLLING_HOME_B,
    "rolling_away_b": _rolling("away_team", {"agl5": "ftag", "ataf5": "ap", "adil5": "adi_cards"}, None),
    "team_long": _query("SELECT match_id, side, season, match_date, team, points FROM team_rows"),
    "form_any_venue": FORM_ANY,
    "form_any_venue_split": FORM_ANY,
    "season_cum_compat": SEASON_CUM,
    "season_cum_compat_split": SEASON_CUM,
    "season_cum_strict": _query(
        "SELECT h.match_id, h.p AS htp, a.p AS atp FROM c h JOIN c a"
        " ON h.match_id = a.match_id AND h.side = 'H' AND a.side = 'A'",
        f", c AS (SELECT match_id, side, {_sum('points', TEAM, DAY_BEFORE)} AS p FROM team_rows)",
    ),
    "season_points_compat": _query(f"SELECT match_id, {SEASON_POINTS} FROM scored"),
    "season_points_strict": _query(
        "SELECT season, league, team, CAST(sum(points) AS BIGINT) AS season_points"
        " FROM team_rows GROUP BY season, league, team"
    ),
    "season_goal_diff": _query(f"SELECT match_id, {SEASON_GOALS} FROM scored"),
    "season_league_manifest": _query("SELECT season, league FROM expected"),
    "missing_files": _query(
        "SELECT season, league FROM expected e WHERE NOT EXISTS"
        " (SELECT 1 FROM matches m WHERE m.season = e.season AND m.league = e.league)"
    ),
    "publish_report": _query(
        "SELECT e.season, e.league, count(match_id) AS rows,"
        " CASE WHEN count(match_id) = 0 THEN 'missing' ELSE 'published' END AS status"
        " FROM expected e LEFT JOIN matches m ON m.season = e.season AND m.league = e.league"
        " GROUP BY e.season, e.league"
    ),
    "dedup_matches": _query("SELECT * EXCLUDE (match_ts) FROM matches"),
    "latest_match": _query(
        "SELECT match_id, CASE WHEN match_id % 5 = 0 THEN fthg + 1 ELSE fthg END AS fthg,"
        " CASE WHEN match_id % 5 = 0 THEN 2 ELSE 1 END AS version FROM matches"
    ),
    "quarantine": _query(
        "SELECT match_id, match_id % 37 = 0 OR home_team IS NULL AS quarantined,"
        " CASE WHEN match_id % 37 <> 0 THEN fthg END AS fthg FROM matches"
    ),
    "features_a": FEATURES_A,
    "features_b": FEATURES_B,
    "features_strict": FEATURES_STRICT,
    "features_strict_split": FEATURES_STRICT,
    "csv_scan": _query("SELECT match_id, home_team, fthg, ftr FROM matches"),
    "csv_union_by_name": _query(
        "SELECT match_id, season, league, home_team, away_team, ftr, fthg, ftag,"
        " CASE WHEN match_id % 2 = 0 THEN hy END AS hy, CASE WHEN match_id % 2 = 0 THEN ay END AS ay"
        " FROM matches"
    ),
    "bronze_raw": _query(f"""
SELECT season, league, CASE WHEN match_id % 2 = 0 THEN {CSV_LINE} || ',' || hy || ',' || ay
  ELSE concat_ws(',', strftime(match_date, '%d/%m/%Y'), match_id, ftag, fthg, coalesce(ftr, ''), home_team, away_team)
  END AS line FROM matches"""),
    "csv_quarantine": _query(f"""
SELECT season, league, reason, CASE WHEN reason = 'blank' THEN ',,,,,,' WHEN reason IS NOT NULL THEN
    CASE WHEN match_id % 37 = 0 THEN line || ',x,y' WHEN match_id % 41 = 0 THEN array_to_string(string_split(line, ',')[1:5], ',')
    ELSE concat_ws(',', match_id, strftime(match_date, '%d/%m/%Y'), '', away_team, 'H,1,0') END END AS raw,
  CASE WHEN reason IS NULL THEN match_id::VARCHAR END AS match_id,
  CASE WHEN reason IS NULL THEN strftime(match_date, '%d/%m/%Y') END AS date,
  CASE WHEN reason IS NULL THEN home_team END AS hometeam, CASE WHEN reason IS NULL THEN away_team END AS awayteam,
  CASE WHEN reason IS NULL THEN ftr END AS ftr, CASE WHEN reason IS NULL THEN fthg::VARCHAR END AS fthg,
  CASE WHEN reason IS NULL THEN ftag::VARCHAR END AS ftag
FROM (SELECT *, {CSV_LINE} AS line, CASE WHEN match_id % 37 = 0 OR match_id % 41 = 0 THEN 'ragged'
    WHEN match_id % 43 = 0 THEN 'blank' WHEN match_id % 47 = 0 THEN 'key' END AS reason FROM matches)"""),
    "file_gate": _query(
        "SELECT season, league, count(*) AS rows FROM matches GROUP BY season, league HAVING count(*) >= 100"
    ),
    "publish_run": _query("""
SELECT e.season, e.league, count(match_id) AS rows, CASE WHEN count(match_id) = 0 THEN 'missing' ELSE 'published' END AS status,
  count(match_id) AS sent, FALSE AS explained
FROM expected e LEFT JOIN matches m ON m.season = e.season AND m.league = e.league GROUP BY e.season, e.league
UNION ALL SELECT '9900', 'E0', 0, 'failed', 0, TRUE"""),
    "stream_parquet": LANDED,
    "stream_docs": LANDED,
    "documents_once": LANDED,
    "fanout": _query(GOOD_AND_BAD),
    "landing_quarantine": _query(GOOD_AND_BAD),
    "restart": _query("SELECT match_id, season, fthg FROM matches"),
    "stream_dedup": _query("SELECT match_id, season FROM matches"),
    "incremental_features": FEATURES_STRICT,
    "carried_totals": _query(f"""
SELECT match_id, side, team,
  {_sum('points', TEAM, DAY_BEFORE)} AS points_before, {_sum('goals', TEAM, DAY_BEFORE)} AS goals_before,
  {_sum('conceded', TEAM, DAY_BEFORE)} AS conceded_before, {_sum('points', TEAM)} AS season_points
FROM team_rows WHERE ftr IS NOT NULL"""),
    "incremental_new_run": FEATURES_STRICT,
    "incremental_replayed": FEATURES_STRICT,
    "incremental_moved": FEATURES_STRICT,
    "incremental_withdrawn": FEATURES_STRICT,
    "features_strict_null_key": FEATURES_STRICT,
    "stateful_last5": STATE_FORM,
    "stateful_from_history": STATE_FORM,
    "late_rows": _query(f"""
SELECT t.match_id, t.side, t.team, home_form,
  day(match_date) % 2 = 1 AND max(day(match_date) % 2 = 0) OVER (PARTITION BY {TEAM}) AS late
FROM team_rows t LEFT JOIN (
  SELECT match_id, side, {_sum('points', TEAM, FIVE)} AS home_form FROM team_rows WHERE ftr IS NOT NULL
) h ON h.match_id = t.match_id AND h.side = 'H'"""),
    "carried_last5": _query(
        "SELECT match_id, side, team,"
        f" {_sum('points', TEAM, FIVE)} AS form5_any, {_sum('points', TEAM + ', side', FIVE)} AS form5_venue,"
        f" {_sum('goals', TEAM + ', side', FIVE)} AS goals5_venue,"
        f" {_sum('discipline', TEAM + ', side', FIVE)} AS discipline5_venue"
        " FROM team_rows WHERE ftr IS NOT NULL"
    ),
    "stream_features_a": f"SELECT * EXCLUDE (match_id) FROM ({FEATURES_A})",
    "stream_features_b": f"SELECT * EXCLUDE (match_id) FROM ({FEATURES_B})",
}
