"""ANSI SQL with the same results as the registered queries, written for DuckDB.

Window frames and self-joins are spelled out here without regard to scale: this is the check of
the Spark queries, not another implementation of them.
"""

from __future__ import annotations

from matchflow.plans.catalog import TABLES
from matchflow.schemas import FOOTBALL_FEATURES

HELD_OUT = "CAST('0x' || substr(md5(CAST({} AS VARCHAR)), 1, 8) AS BIGINT) / 4294967296.0 < 0.3"
COUNTERS = {
    "shots": "event_name = 'Shot'",
    "accurate_shots": "event_name = 'Shot' AND list_contains(tags, 1801)",
    "passes": "event_name = 'Pass'",
    "goals": "event_name = 'Shot' AND list_contains(tags, 1801) AND list_contains(tags, 101)",
    "fouls": "event_name = 'Foul'",
    "duels_won": "event_name = 'Duel' AND list_contains(tags, 703)",
}
FLAGS = {
    "is_shot": COUNTERS["shots"],
    "is_accurate_shot": COUNTERS["accurate_shots"],
    "is_pass": COUNTERS["passes"],
    "is_goal": COUNTERS["goals"],
    "is_foul": COUNTERS["fouls"],
    "is_duel_won": COUNTERS["duels_won"],
}
DIFFS = ["goals", "passes", "fouls", "shots", "accurate_shots", "duels_won"]

EVENTS = """
ev AS (
  SELECT event_id, user_id AS match_id,
         date_diff('microsecond', TIMESTAMP '2024-01-01', ts) / 1e6 AS event_sec,
         CASE WHEN hour(ts) < 12 THEN '1H' ELSE '2H' END AS match_period,
         CASE WHEN event_id % 5 <= 1 THEN 'home' WHEN event_id % 5 <= 3 THEN 'away' ELSE 'unknown' END AS side,
         CASE event_type WHEN 'purchase' THEN 'Shot' WHEN 'click' THEN 'Pass' WHEN 'error' THEN 'Foul'
                         WHEN 'view' THEN 'Duel' ELSE 'Other' END AS event_name,
         CASE CAST(json_extract(props, '$.k') AS INTEGER) % 4
              WHEN 0 THEN [101, 1801] WHEN 1 THEN [1801] WHEN 2 THEN [703] ELSE [] END AS tags,
         event_id % 25 AS team_id
  FROM events)"""
HALVES = """
halves AS (SELECT match_id, max(CASE WHEN match_period = '1H' THEN event_sec END) AS half FROM ev GROUP BY match_id),
shifted AS (
  SELECT ev.* EXCLUDE (event_sec),
         CASE WHEN match_period = '2H' THEN event_sec + half ELSE event_sec END AS event_sec
  FROM ev JOIN halves USING (match_id))"""
LAPS = """
laps AS (
  SELECT o_custkey % 10 AS race_id, o_custkey AS driver, o_orderkey AS lap,
         CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS position,
         CAST(round(o_totalprice * 100) AS BIGINT) AS milliseconds
  FROM orders)"""
LAP_STATS = """
stats AS (
  SELECT *,
         round(avg(position) OVER upto, 4) AS mean_position_up_to_lap,
         round(stddev_samp(position) OVER upto, 4) AS std_position_up_to_lap,
         round(CAST(min(position) OVER upto AS DOUBLE), 4) AS min_position_up_to_lap,
         round(avg(position) OVER (PARTITION BY race_id, driver ORDER BY lap ROWS 4 PRECEDING), 4)
           AS last_5_laps_mean_position
  FROM laps
  WINDOW upto AS (PARTITION BY race_id, driver ORDER BY lap ROWS UNBOUNDED PRECEDING))"""
OVERS = """
balls AS (
  SELECT user_id AS match_id, CASE WHEN hour(ts) < 12 THEN 1 ELSE 2 END AS inning, hour(ts) % 12 AS "over",
         event_id, CAST(floor(value) AS BIGINT) % 7 AS runs, event_type = 'error' AS wicket
  FROM events),
overs AS (
  SELECT match_id, CAST(inning AS INTEGER) AS inning, CAST("over" AS INTEGER) AS "over",
         CAST(sum(runs) AS BIGINT) AS over_runs, CAST(count(*) FILTER (wicket) AS BIGINT) AS over_wickets,
         arg_max(runs, event_id) AS runs_total, max(event_id) AS last_event
  FROM balls GROUP BY ALL)"""
CUMULATIVE = """
cum AS (
  SELECT *, CAST(sum(over_runs) OVER w AS BIGINT) AS cumulative_score,
         CAST(sum(over_wickets) OVER w AS BIGINT) AS cumulative_wickets
  FROM overs WINDOW w AS (PARTITION BY match_id, inning ORDER BY "over" ROWS UNBOUNDED PRECEDING))"""
FIRST = """
first AS (
  SELECT match_id, CAST(sum(over_runs) AS BIGINT) AS s, CAST(sum(over_wickets) AS BIGINT) AS w, max("over") AS l
  FROM overs WHERE inning = 1 GROUP BY match_id)"""
FACTS = """
       'Team ' || (match_id % 8) AS team_1, 'Team ' || ((match_id + 1) % 8) AS team_2,
       CAST(match_id % 3 = 0 AS INTEGER) AS toss_decision, CAST(match_id % 2 AS INTEGER) AS toss_winner,
       CAST(CASE WHEN match_id % 2 = 0 THEN 2007.5 ELSE 2020 END AS DOUBLE) AS season,
       CAST(inning = 2 AS INTEGER) AS current_team"""
PER_OVER = """
steps AS (
  SELECT match_id, inning, "over",
         cumulative_score - coalesce(lag(cumulative_score) OVER w, 0) AS runs_per_over,
         cumulative_wickets - coalesce(lag(cumulative_wickets) OVER w, 0) AS wickets_per_over
  FROM cum WINDOW w AS (PARTITION BY match_id, inning ORDER BY "over"))"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"


def _possession(credit: str) -> str:
    side = "side" if credit == "current" else "lag(side) OVER w"
    return _with(EVENTS) + f""", timed AS (
  SELECT event_id, coalesce(event_sec - lag(event_sec) OVER w, 0) AS d, {side} AS holder
  FROM ev WINDOW w AS (PARTITION BY match_id ORDER BY event_sec, event_id))
SELECT event_id, round(d, 4) AS time_diff,
       round(CASE WHEN holder = 'home' THEN d ELSE 0 END, 4) AS home_possession_time,
       round(CASE WHEN holder = 'away' THEN d ELSE 0 END, 4) AS away_possession_time
FROM timed"""


def _timed(source: str, credit: str) -> str:
    side = "side" if credit == "current" else "lag(side) OVER w"
    return f""", timed AS (
  SELECT *, greatest(coalesce(event_sec - lag(event_sec) OVER w, 0), 0) AS d, {side} AS holder
  FROM {source} WINDOW w AS (PARTITION BY match_id ORDER BY event_sec, event_id))"""


def _counted(window: str) -> str:
    sums = [
        f"CAST(count(*) FILTER (side = '{side}' AND {cond}) OVER {window} AS BIGINT) AS {side}_{name}"
        for name, cond in COUNTERS.items()
        for side in ("home", "away")
    ]
    sums += [
        f"coalesce(sum(d) FILTER (holder = '{side}') OVER {window}, 0) AS {side}_possession_time"
        for side in ("home", "away")
    ]
    return ",\n         ".join(sums)


_STATS_COLUMNS = (
    [f"{side}_{name}" for name in COUNTERS for side in ("home", "away")]
    + [f"round({s}_possession_time, 4) AS {s}_possession_time" for s in ("home", "away")]
    + [f"home_{name} - away_{name} AS {name}_diff" for name in DIFFS]
    + ["round(home_possession_time - away_possession_time, 4) AS possession_time_diff"]
)


def _cumulative(source: str, credit: str) -> str:
    """All events up to the second count: a RANGE frame, one row per second."""
    return _timed(source, credit) + f""", counted AS (
  SELECT DISTINCT match_id, event_sec,
         {_counted("upto")}
  FROM timed WINDOW upto AS (PARTITION BY match_id ORDER BY event_sec RANGE UNBOUNDED PRECEDING))
SELECT match_id, round(event_sec, 4) AS event_sec, {", ".join(_STATS_COLUMNS)} FROM counted"""


def _stream_match_stats(source: str = "ev", more: str = "") -> str:
    """``more`` defines the events ``source`` if they are not ``ev``."""
    shifted = f""", live AS (
  SELECT {source}.* EXCLUDE (event_sec), CASE WHEN match_period = '2H' THEN event_sec + 3600 ELSE event_sec END AS event_sec
  FROM {source})"""
    order = "PARTITION BY match_id ORDER BY event_sec, CAST(event_id AS VARCHAR)"
    return _with(EVENTS) + more + shifted + f""", timed AS (
  SELECT *, greatest(coalesce(event_sec - lag(event_sec) OVER w, 0), 0) AS d, lag(side) OVER w AS holder
  FROM live WINDOW w AS ({order})), counted AS (
  SELECT match_id, event_id, event_sec,
         {_counted("upto")}
  FROM timed WINDOW upto AS ({order} ROWS UNBOUNDED PRECEDING))
SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(match_id AS VARCHAR) AS "matchId",
       round(event_sec, 4) AS "eventSec", {", ".join(_STATS_COLUMNS)} FROM counted"""


def _live_statistics() -> str:
    """Events that are messages of their own, with the side of their team."""
    sided = """, sided AS (
  SELECT ev.* EXCLUDE (side), CASE WHEN team_id = c_nationkey THEN 'home' WHEN team_id = (c_nationkey + 1) % 25 THEN 'away' ELSE 'unknown' END AS side
  FROM ev LEFT JOIN customer ON match_id = c_custkey AND c_custkey % 10 > 0 WHERE event_id % 50 <> 49)"""
    return _stream_match_stats("sided", sided)


def _live_predictions() -> str:
    return f"""WITH stats AS ({_live_statistics()}),
ahead AS (SELECT *, exp(CAST(least(greatest(goals_diff, -9), 9) AS DOUBLE)) AS x FROM stats)
SELECT "matchId" AS match_id, "eventSec" AS event_sec, CAST(goals_diff AS BIGINT) AS goals_diff,
       CASE WHEN goals_diff > 0 THEN 'home' WHEN goals_diff < 0 THEN 'away' ELSE 'draw' END AS predicted_result,
       round(x / (x + 1 / x + 1), 4) AS prob_home_win, round(1 / x / (x + 1 / x + 1), 4) AS prob_away_win,
       round(1 / (x + 1 / x + 1), 4) AS prob_draw FROM ahead"""


STREAM_LAPS = _with(LAPS) + """
SELECT CAST(race_id AS VARCHAR) AS race_id, lap, driver, CAST(position AS BIGINT) AS position,
       round(avg(position) OVER upto, 4) AS mean_position_up_to_lap,
       round(stddev_pop(position) OVER upto, 4) AS std_position_up_to_lap,
       round(CAST(min(position) OVER upto AS DOUBLE), 4) AS min_position_up_to_lap,
       round(avg(position) OVER (PARTITION BY race_id, driver ORDER BY lap ROWS 4 PRECEDING), 4) AS last_5_laps_mean_position
FROM laps WINDOW upto AS (PARTITION BY race_id, driver ORDER BY lap ROWS UNBOUNDED PRECEDING)"""


def _stream_overs(kept: str = """kept AS (SELECT * FROM overs WHERE "over" NOT IN (3, 4))""") -> str:
    """Skipped overs add truncated means; the first over of an inning never does."""
    return _with(OVERS) + f""", {kept},
gaps AS (
  SELECT *, coalesce("over" - lag("over") OVER w - 1, 0) AS gap
  FROM kept WINDOW w AS (PARTITION BY match_id, inning ORDER BY "over")),
filled AS (
  SELECT *, over_runs + CAST(trunc(gap * CASE inning WHEN 1 THEN 7.61 ELSE 7.29 END) AS BIGINT) AS r,
         over_wickets + CAST(trunc(gap * CASE inning WHEN 1 THEN 0.36 ELSE 0.34 END) AS BIGINT) AS k
  FROM gaps),
cum AS (
  SELECT *, CAST(sum(r) OVER w AS BIGINT) AS score, CAST(sum(k) OVER w AS BIGINT) AS wickets
  FROM filled WINDOW w AS (PARTITION BY match_id, inning ORDER BY "over" ROWS UNBOUNDED PRECEDING)),
first AS (
  SELECT match_id, CAST(sum(r) AS BIGINT) AS s, CAST(sum(k) AS BIGINT) AS w FROM filled WHERE inning = 1 GROUP BY match_id),
carried AS (
  SELECT cum.*, CASE WHEN inning = 2 THEN coalesce(s, 0) ELSE 0 END AS first_s,
         CASE WHEN inning = 2 THEN coalesce(first.w, 0) ELSE 0 END AS first_w
  FROM cum LEFT JOIN first USING (match_id))
SELECT match_id, inning, "over", runs_total,{FACTS},
       score AS cumulative_score, least(wickets, 10) AS cumulative_wickets,
       CAST(first_s AS BIGINT) AS first_inning_total_score, CAST(first_w AS BIGINT) AS first_inning_total_wickets,
       round(CASE WHEN first_w > 0 THEN first_s / first_w ELSE 0 END, 4) AS first_inning_run_rate,
       round(score / ("over" + 1), 4) AS run_rate,
       round(CASE WHEN inning = 2 THEN (first_s - score) / greatest(19 - "over", 1) ELSE 0 END, 4) AS required_run_rate
FROM carried"""


#: Overs as they land in six parts, and those that an over of an earlier part has not overtaken.
LANDED = """firsts AS (
  SELECT *, (inning - 1) * 2 + CAST(floor("over" / 6) AS INTEGER) + CASE WHEN (match_id + "over") % 7 = 0 THEN 1 ELSE 0 END AS part FROM overs),
landed AS (SELECT * FROM firsts UNION ALL SELECT * REPLACE (part + 1 AS part) FROM firsts WHERE (match_id + "over") % 5 = 0),
reached AS (
  SELECT *, max(inning * 100 + "over") OVER (PARTITION BY match_id ORDER BY part RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM landed),
kept AS (SELECT * EXCLUDE (top) FROM reached WHERE top IS NULL OR inning * 100 + "over" > top)"""


def _stream_overs_dropped() -> str:
    return _with(OVERS) + f""", {LANDED}
SELECT match_id, inning, "over", over_runs, over_wickets, CAST(part AS INTEGER) AS batch_id,
       CASE WHEN EXISTS (SELECT 1 FROM kept k WHERE k.match_id = r.match_id AND k.inning = r.inning AND k."over" = r."over" AND k.part < r.part)
            THEN 'repeated' ELSE 'late' END AS dropped
FROM reached r WHERE top IS NOT NULL AND inning * 100 + "over" <= top"""


def _describe() -> str:
    names = [
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    ]
    one = """SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}), 4) AS mean,
       round(stddev_samp({c}), 4) AS std, round(CAST(min({c}) AS DOUBLE), 4) AS min,
       round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 4) AS q25,
       round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 4) AS median,
       round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 4) AS q75,
       round(CAST(max({c}) AS DOUBLE), 4) AS max FROM lineitem"""
    return "\nUNION ALL\n".join(one.format(c=c) for c in names)


AUDITED = {
    "region": "r_regionkey r_name",
    "nation": "n_nationkey n_name n_regionkey",
    "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment",
    "supplier": "s_suppkey s_name s_nationkey s_acctbal",
    "part": "p_partkey p_name p_brand p_type p_size p_retailprice",
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
    "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax"
    " l_returnflag l_linestatus l_shipdate",
    "events": "event_id ts user_id event_type value props",
    "documents": "doc_id text lang source n_chars",
    "embeddings": "vec_id embedding label",
    "pages": "page_id url html",
    "benchmark": "item_id text",
    "labels": "doc_id quality toxic",
    "conversations": "conv_id turn role text",
}


def _null_audit() -> str:
    parts = [
        f"SELECT '{c}' AS column_name, count(*) AS total_rows, count({c}) AS non_null_count,"
        f" count(*) - count({c}) AS null_count, '{t}' AS table_name FROM {t}"
        for t in TABLES
        for c in AUDITED[t].split()
    ]
    return "\nUNION ALL\n".join(parts)


def _players() -> str:
    names = [f"coalesce(names[{i}], 'Placeholder ' || ({i - 1} - len(names))) AS player_{i}" for i in range(1, 12)]
    return f"""WITH ranked AS (
  SELECT p_brand, p_size, p_name, row_number() OVER (PARTITION BY p_brand, p_size ORDER BY p_partkey) AS n FROM part),
listed AS (SELECT p_brand, p_size, list(p_name ORDER BY n) AS names FROM ranked WHERE n <= 11 GROUP BY ALL)
SELECT p_brand, p_size, {", ".join(names)} FROM listed"""


GUESSES = """
g AS (
  SELECT o_orderstatus AS label, CASE WHEN o_orderkey % 3 = 0 THEN 'F' ELSE o_orderstatus END AS prediction,
         (o_orderkey % 9 + 1) / 10 AS p, CAST(o_orderpriority < '3' AS INTEGER) AS b,
         o_totalprice AS y, o_totalprice * 0.9 + 1000 AS f
  FROM orders)"""

CLASSIFICATION = _with(GUESSES) + """, classes AS (SELECT label AS c FROM g UNION SELECT prediction FROM g),
per_class AS (
  SELECT c, count(*) FILTER (label = c) AS actual, count(*) FILTER (prediction = c) AS said,
         count(*) FILTER (label = c AND prediction = c) AS hit
  FROM g CROSS JOIN classes GROUP BY c),
rates AS (
  SELECT coalesce(hit / nullif(said, 0), 0) AS pr, coalesce(hit / nullif(actual, 0), 0) AS re FROM per_class),
f AS (SELECT *, coalesce(2 * pr * re / nullif(pr + re, 0), 0) AS f1 FROM rates)
SELECT 'accuracy' AS metric_name, round(avg(CAST(label = prediction AS INTEGER)), 4) AS metric_value FROM g
UNION ALL SELECT 'precision', round(avg(pr), 4) FROM f
UNION ALL SELECT 'recall', round(avg(re), 4) FROM f
UNION ALL SELECT 'f1_score', round(avg(f1), 4) FROM f
UNION ALL SELECT 'log_loss', round(avg(-ln(p)), 4) FROM g"""

RANKING = _with(GUESSES) + """, h AS (
  SELECT p, count(*) FILTER (b = 1) AS pos, count(*) FILTER (b = 0) AS neg FROM g GROUP BY p)
SELECT 'roc_auc' AS metric_name,
       round((SELECT sum(x.pos * y.neg * CASE WHEN y.p < x.p THEN 1.0 WHEN y.p = x.p THEN 0.5 ELSE 0.0 END)
              FROM h x CROSS JOIN h y) / ((SELECT sum(pos) FROM h) * (SELECT sum(neg) FROM h)), 4) AS metric_value"""

REGRESSION = _with(GUESSES) + """
SELECT 'mean_absolute_error' AS metric_name, round(avg(abs(y - f)), 4) AS metric_value FROM g
UNION ALL SELECT 'mean_squared_error', round(avg((y - f) * (y - f)), 4) FROM g
UNION ALL SELECT 'mean_squared_log_error', round(avg(power(ln(1 + y) - ln(1 + f), 2)), 4) FROM g
UNION ALL SELECT 'r2_score', round(1 - avg((y - f) * (y - f)) / var_pop(y), 4) FROM g
UNION ALL SELECT 'explained_variance', round(1 - var_pop(y - f) / var_pop(y), 4) FROM g"""


OVER_FEED = """
docs AS (
  SELECT user_id AS match_id, event_id, CAST(floor(value) AS INTEGER) AS v, event_id % 4 AS n, hour(ts) % 12 AS "over",
         CASE WHEN hour(ts) < 12 THEN 'Reds' ELSE 'Blues' END AS team,
         CASE WHEN user_id % 2 = 0 THEN 'Reds' ELSE 'Blues' END AS toss,
         CASE WHEN user_id % 5 = 0 THEN 'Reds' ELSE 'Blues' END AS winner,
         user_id % 3 = 0 AS field
  FROM events),
teams AS (
  SELECT *, CASE WHEN field THEN CASE toss WHEN 'Reds' THEN 'Blues' ELSE 'Reds' END ELSE toss END AS team_1,
         CASE WHEN field THEN toss ELSE CASE toss WHEN 'Reds' THEN 'Blues' ELSE 'Reds' END END AS team_2
  FROM docs)"""


def oracle_sql() -> dict[str, str]:
    flags = ", ".join(f"{cond} AS {name}" for name, cond in FLAGS.items())
    labels = "array_to_string([CASE t WHEN 101 THEN 'Goal' WHEN 1801 THEN 'accurate' ELSE 'Unknown' END FOR t IN tags], ',')"
    label_flags = flags.replace("list_contains(tags, 703)", "false")
    return {
        "scan_filter_time_range": _with(EVENTS) + """SELECT event_id, match_id, match_period, event_sec FROM ev
WHERE (match_period = '2H' AND event_sec + 3600 BETWEEN 86400 AND 1000000)
   OR (match_period <> '2H' AND event_sec BETWEEN 86400 AND 1000000)""",
        "optional_filter": """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'""",
        "nested_laps_roundtrip": _with(LAPS) + """
SELECT CAST(race_id AS VARCHAR) AS race_id, lap, driver, position, milliseconds FROM laps""",
        "race_documents_roundtrip": _with(LAPS) + """
SELECT CAST(race_id AS VARCHAR) AS race_id, lap, driver, position, milliseconds FROM laps""",
        "match_documents_roundtrip": _with(EVENTS) + """
SELECT CAST(match_id AS VARCHAR) AS match_id, CAST(event_id AS VARCHAR) AS event_id, event_name, team_id, match_period,
       round(event_sec, 4) AS event_sec FROM ev""",
        "event_message_roundtrip": _with(EVENTS) + """
SELECT CAST(match_id AS VARCHAR) AS "matchId", event_id AS id,
       round(CASE WHEN match_period = '2H' THEN event_sec + 3600 ELSE event_sec END, 4) AS "eventSec",
       event_name AS "eventName", team_id AS "teamId", array_to_string(tags, ',') AS tags,
       CAST(event_id % 100 AS DOUBLE) AS x, CASE WHEN event_id % 2 = 0 THEN CAST(event_id % 50 AS DOUBLE) END AS y
FROM ev""",
        "event_document_flatten": _with(EVENTS) + """
SELECT CAST(match_id AS VARCHAR) AS match_id, CAST(event_id AS VARCHAR) AS event_id, event_name, '' AS sub_event_name,
       '' AS tags, team_id, match_period, round(event_sec, 4) AS event_sec, CAST(event_id % 100 AS DOUBLE) AS pos_orig_x,
       CASE WHEN event_id % 2 = 0 THEN CAST(event_id % 50 AS DOUBLE) END AS pos_dest_y,
       CASE len(tags) WHEN 0 THEN '' ELSE '[' || array_to_string(tags, ', ') || ']' END AS tags_list
FROM ev""",
        "match_document_flatten": """WITH m AS (
  SELECT o_orderkey, o_custkey % 20 AS t, o_orderkey % 3 AS w, o_orderdate, o_custkey, o_orderstatus AS s, o_orderpriority FROM orders)
SELECT CAST(o_orderkey AS VARCHAR) AS match_id, CAST(month(o_orderdate) AS INTEGER) AS gameweek,
       CAST(o_custkey % 5 AS INTEGER) AS "competitionId", CASE WHEN s <> 'P' THEN s ELSE '' END AS status,
       t AS "team1_teamId", 'away' AS team2_side, o_orderpriority AS bench,
       CASE WHEN s = 'P' THEN NULL WHEN w = 0 THEN 'home' WHEN w = 1 THEN 'away' ELSE 'draw' END AS result
FROM m""",
        "over_document_rows": _with(OVER_FEED) + """
SELECT match_id, CASE WHEN team = team_1 THEN 1 ELSE 2 END AS inning, CAST("over" AS INTEGER) AS "over",
       CASE WHEN n > 0 THEN 'b' || ((event_id + n) % 9) END AS batter, CASE WHEN n > 0 THEN 'c' END AS bowler,
       CASE WHEN n > 0 THEN 'd' END AS non_striker,
       CASE WHEN n > 0 THEN CAST((v + n) % 7 AS BIGINT) END AS runs_batter, CASE WHEN n > 0 THEN CAST(0 AS BIGINT) END AS runs_extras,
       CASE WHEN n > 0 THEN CAST((v + n) % 7 AS BIGINT) END AS runs_total,
       CAST(coalesce(list_sum([(v + i) % 7 FOR i IN range(1, n + 1)]), 0) AS INTEGER) AS over_runs,
       CAST(coalesce(list_sum([CASE WHEN (event_id + i) % 5 = 0 THEN 1 ELSE 0 END FOR i IN range(1, n + 1)]), 0) AS INTEGER) AS over_wickets,
       CAST(field AS INTEGER) AS toss_decision, CAST(toss = team_2 AS INTEGER) AS toss_winner, CAST(2009.5 AS DOUBLE) AS season,
       CAST(team = team_2 AS INTEGER) AS current_team, team_1, team_2
FROM teams""",
        "over_players": _with(OVER_FEED) + """
SELECT DISTINCT match_id, CAST(winner = team_2 AS INTEGER) AS winner, 'y' AS team_1_player_2,
       'Placeholder 0' AS team_1_player_3, 'Placeholder 8' AS team_2_player_11 FROM teams""",
        "overs_to_first_gap": _with(OVERS) + """, nth AS (
  SELECT *, row_number() OVER (PARTITION BY match_id, inning ORDER BY "over") - 1 AS n FROM overs)
SELECT match_id, inning, "over", over_runs FROM nth WHERE "over" = n""",
        "event_flags": _with(EVENTS) + f"SELECT event_id, {flags} FROM ev",
        "tag_labels": _with(EVENTS) + f"SELECT event_id, {labels} AS labels, {label_flags} FROM ev",
        "tag_labels_by_join": _with(EVENTS) + f"SELECT event_id, {labels} AS labels FROM ev",
        "parse_props_defaults": """SELECT event_id,
  CASE WHEN event_id % 13 = 0 THEN -1 ELSE CAST(json_extract(props, '$.k') AS INTEGER) END AS k
FROM events WHERE event_id % 7 <> 0 AND event_id % 11 <> 0""",
        "rejected_messages": """SELECT CASE WHEN event_id % 7 = 0 THEN 'no data' ELSE 'not a JSON object' END AS reason,
  count(*) AS n FROM events WHERE event_id % 7 = 0 OR event_id % 11 = 0 GROUP BY 1""",
        "season_number": """WITH o AS (SELECT o_orderkey, year(o_orderdate) AS y FROM orders)
SELECT o_orderkey,
  CASE WHEN o_orderkey % 2 = 0 THEN CAST(y AS VARCHAR) ELSE y || '/' || lpad(CAST((y + 1) % 100 AS VARCHAR), 2, '0') END AS season,
  CASE WHEN o_orderkey % 2 = 0 THEN CAST(y AS DOUBLE) ELSE (y + (y + 1) % 100) / 2.0 END AS batch_number,
  CASE WHEN o_orderkey % 2 = 0 THEN CAST(y AS DOUBLE) ELSE (y + 2000 + (y + 1) % 100) / 2.0 END AS stream_number
FROM o""",
        "event_keys": _with(EVENTS) + """
SELECT event_id, match_id || '_' || CAST(trunc(event_sec) AS BIGINT) AS prefix FROM ev""",
        "enrich_inner": """SELECT o_orderkey, o_custkey, c_name, c_mktsegment
FROM orders JOIN customer ON o_custkey = c_custkey""",
        "enrich_left_dims": """SELECT o_orderkey, o_custkey, c_nationkey, n_name
FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey""",
        "enrich_unknown_side": _with(EVENTS) + """
SELECT event_id, match_id, team_id,
       CASE WHEN team_id = s_nationkey THEN 'home' WHEN team_id = (s_nationkey + 1) % 25 THEN 'away' ELSE 'unknown' END AS side
FROM ev LEFT JOIN supplier ON match_id = s_suppkey""",
        "semi_pruned_dim": "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT user_id FROM events)",
        "anti_missing_ids": """SELECT c_custkey AS match_id FROM customer
WHERE c_custkey NOT IN (SELECT user_id FROM events)""",
        "match_result": """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL
  WHEN o_orderkey % 5 = o_custkey % 5 THEN 'home' WHEN o_orderkey % 5 = (o_custkey + 1) % 5 THEN 'away'
  ELSE 'draw' END AS result FROM orders""",
        "driver_age": """WITH d AS (SELECT o_custkey, min(o_orderdate) AS dob FROM orders GROUP BY 1)
SELECT o_custkey AS driver, o_orderkey AS lap, CAST(2024 - year(dob) AS INTEGER) AS age FROM orders JOIN d USING (o_custkey)""",
        "half_shift_fixed": _with(EVENTS) + """
SELECT event_id, round(CASE WHEN match_period = '2H' THEN event_sec + 3600 ELSE event_sec END, 4) AS event_sec FROM ev""",
        "half_shift_first_half_max": _with(EVENTS, HALVES) + "SELECT event_id, round(event_sec, 4) AS event_sec FROM shifted",
        "possession_current": _possession("current"),
        "possession_previous": _possession("previous"),
        "cumulative_match_stats": _with(EVENTS, HALVES) + _cumulative("shifted", "current"),
        "cumulative_match_stats_ties": _with(EVENTS)
        + ", hours AS (SELECT ev.* EXCLUDE (event_sec), floor(event_sec / 3600) * 3600.0 AS event_sec FROM ev)"
        + _cumulative("hours", "previous"),
        "lap_expanding_stats": _with(LAPS, LAP_STATS) + "SELECT * FROM stats",
        "lap_time_deviation": _with(LAPS) + """
SELECT driver, lap, round(stddev_pop(milliseconds) OVER w, 2) AS std_pop, round(stddev_samp(milliseconds) OVER w, 2) AS std_sample
FROM laps WINDOW w AS (PARTITION BY race_id, driver ORDER BY lap ROWS UNBOUNDED PRECEDING)""",
        "final_position": _with(LAPS) + """
SELECT race_id, driver, arg_max(position, lap) AS final_position FROM laps GROUP BY race_id, driver""",
        "lap_feature_table": _with(LAPS, LAP_STATS) + """
SELECT stats.*, final_position FROM stats
JOIN (SELECT race_id, driver, arg_max(position, lap) AS final_position FROM laps GROUP BY 1, 2) USING (race_id, driver)
WHERE std_position_up_to_lap IS NOT NULL""",
        "over_rollup": _with(OVERS) + "SELECT * FROM overs",
        "over_cumulative": _with(OVERS, CUMULATIVE) + """
SELECT match_id, inning, "over", cumulative_score, least(cumulative_wickets, 10) AS cumulative_wickets FROM cum""",
        "inning_totals": _with(OVERS) + """
SELECT match_id, inning, CAST(sum(over_runs) AS BIGINT) AS total_score, CAST(sum(over_wickets) AS BIGINT) AS total_wickets,
       max("over") AS last_over, round(sum(over_runs) / (max("over") + 1), 4) AS run_rate
FROM overs GROUP BY match_id, inning""",
        "first_inning_carry": _with(OVERS, FIRST) + """
SELECT match_id, inning, "over", over_runs, over_wickets,
       CAST(CASE WHEN inning = 2 THEN coalesce(s, 0) ELSE 0 END AS BIGINT) AS first_inning_total_score,
       CAST(CASE WHEN inning = 2 THEN coalesce(w, 0) ELSE 0 END AS BIGINT) AS first_inning_total_wickets,
       round(CASE WHEN inning = 2 THEN coalesce(s / least(l + 2, 20), 0) ELSE 0 END, 4) AS first_inning_run_rate
FROM overs LEFT JOIN first USING (match_id)""",
        "over_feature_table": _with(OVERS, CUMULATIVE, FIRST) + """
SELECT match_id, inning, "over", over_runs, over_wickets, runs_total,""" + FACTS + """,
       cumulative_score, cumulative_wickets,
       CAST(CASE WHEN inning = 2 THEN coalesce(s, 0) ELSE 0 END AS BIGINT) AS first_inning_total_score,
       CAST(CASE WHEN inning = 2 THEN coalesce(w, 0) ELSE 0 END AS BIGINT) AS first_inning_total_wickets,
       round(CASE WHEN inning = 2 THEN coalesce(s / (l + 1), 0) ELSE 0 END, 4) AS first_inning_run_rate,
       round(cumulative_score / ("over" + 1), 4) AS run_rate,
       round(CASE WHEN inning = 2 THEN (coalesce(s, 0) - cumulative_score) / greatest(19 - "over", 1) ELSE 0 END, 4)
         AS required_run_rate
FROM cum LEFT JOIN first USING (match_id)""",
        "players_pad_pivot": _players(),
        "runs_per_over": _with(OVERS, CUMULATIVE, PER_OVER) + "SELECT * FROM steps",
        "mean_over_by_inning": _with(OVERS, CUMULATIVE, PER_OVER) + """
SELECT inning, round_even(avg(runs_per_over), 2) AS mean_runs, round_even(avg(wickets_per_over), 2) AS mean_wickets
FROM steps GROUP BY inning""",
        "mean_cumulative_by_over": _with(OVERS, CUMULATIVE) + """
SELECT inning, "over", round(avg(cumulative_score), 4) AS mean_score, round(avg(cumulative_wickets), 4) AS mean_wickets
FROM cum GROUP BY inning, "over\"""",
        "mean_cumulative_at_over": _with(OVERS, CUMULATIVE) + """
SELECT inning, "over", round(avg(cumulative_score), 4) AS mean_score, round(avg(cumulative_wickets), 4) AS mean_wickets
FROM cum WHERE "over" = 11 GROUP BY inning, "over\"""",
        "rebuild_match_id": """SELECT event_id, event_type,
  CAST(count(*) FILTER (event_type = 'signup') OVER (ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS match_id FROM events""",
        "value_shares": """SELECT CASE event_type WHEN 'error' THEN 'Failure' ELSE event_type END AS event_type,
  count(*) AS n, round(count(*) / (SELECT count(*) FROM events), 4) AS share FROM events GROUP BY 1""",
        "top_entities": """WITH t AS (
  SELECT l_orderkey AS m, l_suppkey AS team FROM lineitem UNION ALL SELECT l_orderkey, l_partkey % 100 FROM lineitem)
SELECT team, count(DISTINCT m) AS matches FROM t GROUP BY team ORDER BY matches DESC, team LIMIT 20""",
        "describe_numeric": _describe(),
        "null_audit": _null_audit(),
        "distinct_ids": "SELECT DISTINCT user_id, event_type FROM events",
        "sink_append": """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
UNION ALL SELECT o_orderkey, o_custkey, o_totalprice FROM orders""",
        "sink_truncate": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders",
        "stream_match_stats": _stream_match_stats(),
        "stream_match_stats_batches": _stream_match_stats(),
        "lookup_laps": _with(LAPS) + 'SELECT race_id AS "raceId", driver, lap, milliseconds FROM laps WHERE race_id = 3',
        "lookup_one_lap": _with(LAPS) + """SELECT race_id AS "raceId", driver, lap % 50 AS lap, position, milliseconds
FROM laps WHERE race_id = 3 AND lap % 50 = 7""",
        "lookup_gameweek": """SELECT o_orderkey AS "wyId", CAST(month(o_orderdate) AS INTEGER) AS gameweek,
  CAST(o_custkey % 5 AS INTEGER) AS "competitionId", CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS status,
  o_custkey % 20 AS team1_id FROM orders WHERE month(o_orderdate) = 3 AND o_custkey % 5 = 2""",
        "live_match_dimension": """SELECT CAST(o_orderkey AS VARCHAR) AS "matchId", o_custkey % 20 AS team1_id,
  o_custkey % 20 + 1 AS team2_id, 'home' AS team1_side, 'away' AS team2_side FROM orders""",
        "laps_with_circuit": _with(LAPS) + """SELECT race_id, driver, lap, n_regionkey AS "circuitId"
FROM laps LEFT JOIN nation ON race_id = n_nationkey AND n_nationkey % 4 > 0""",
        "complete_match_events": _with(EVENTS) + "SELECT event_id, match_id, side FROM ev WHERE match_id % 4 = 0",
        "cumulative_match_result": "SELECT *, CASE WHEN match_id % 3 = 0 THEN 'draw' ELSE 'home' END AS result FROM ("
        + _with(EVENTS, HALVES) + _cumulative("shifted", "current") + ")",
        "sink_table": "SELECT o_orderkey, o_totalprice FROM orders UNION ALL SELECT o_orderkey, o_totalprice FROM orders",
        "lookup_race": "SELECT c_name AS name, c_mktsegment AS date FROM customer WHERE c_custkey = 7",
        "lookup_match_events": _with(EVENTS) + """SELECT event_id, match_id, match_period FROM ev
WHERE match_id = 5 AND event_sec + CASE WHEN match_period = '2H' THEN 3600 ELSE 0 END BETWEEN 86400 AND 1500000""",
        "blank_strings": """SELECT c_custkey, CASE WHEN c_custkey % 3 > 0 THEN c_mktsegment ELSE '' END AS segment,
  CASE WHEN c_custkey % 5 > 0 THEN c_acctbal END AS balance FROM customer""",
        "union_of_landed_files": "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders",
        "join_matches": _with(EVENTS) + """SELECT event_id, match_id,
  CASE team_id WHEN match_id % 25 THEN 'home' WHEN (match_id + 1) % 25 THEN 'away' ELSE 'unknown' END AS side,
  CASE WHEN match_id % 3 = 0 AND match_id % 25 <> 0 AND (match_id + 1) % 25 <> 0 THEN 'draw'
       WHEN match_id % 3 = 0 AND (match_id + 1) % 25 = 0 THEN 'away' ELSE 'home' END AS result FROM ev""",
        "lap_features_null_keys": _with(LAPS.replace("laps AS", "given AS") + """,
laps AS (SELECT * REPLACE (CASE WHEN race_id % 3 > 0 THEN race_id END AS race_id)
         FROM (SELECT * FROM given UNION ALL SELECT * FROM given WHERE lap % 10 = 0))""", LAP_STATS) + """
SELECT race_id, driver, lap, position, mean_position_up_to_lap, std_position_up_to_lap, min_position_up_to_lap, last_5_laps_mean_position,
       arg_max(position, lap) OVER (PARTITION BY race_id, driver) AS final_position FROM stats""",
        "half_shift_null_match": _with(EVENTS) + """, m AS (
  SELECT * REPLACE (CASE WHEN match_id % 7 > 0 THEN match_id END AS match_id) FROM ev), e AS (
  SELECT *, max(CASE WHEN match_period = '1H' THEN event_sec END) OVER (PARTITION BY match_id) AS half FROM m)
SELECT event_id, round(CASE WHEN match_period = '2H' THEN event_sec + half ELSE event_sec END, 4) AS event_sec, by_join
FROM e, (SELECT unnest([true, false]) AS by_join)""",
        "tag_labels_duplicates": _with(EVENTS) + f"""SELECT event_id, CASE WHEN event_id % 9 > 0 THEN {labels} END AS labels, by_join
FROM ev, (SELECT unnest([true, false, true, false]) AS by_join)""",
        "null_audit_dotted": """SELECT 'team1.name' AS column_name, count(*) AS total_rows, count(n_name) AS non_null_count,
  count(*) - count(n_name) AS null_count FROM nation
UNION ALL SELECT 'a.b', count(*), count(*) FILTER (n_nationkey > 3), count(*) - count(*) FILTER (n_nationkey > 3) FROM nation""",
        "stream_lap_stats": STREAM_LAPS,
        "stream_lap_stats_batches": STREAM_LAPS,
        "stream_overs": _stream_overs(),
        "stream_overs_all": _stream_overs("kept AS (SELECT * FROM overs)"),
        "stream_overs_late": _stream_overs(LANDED),
        "stream_overs_dropped": _stream_overs_dropped(),
        "live_statistics": f"SELECT * EXCLUDE (event_id) FROM ({_live_statistics()})",
        "live_predictions": _live_predictions(),
        "rejected_events": """SELECT event_id AS id, CASE event_id % 20 WHEN 1 THEN 'no data' WHEN 3 THEN 'no matchId'
  WHEN 4 THEN 'eventSec is no number' ELSE 'not a JSON object' END AS reason FROM events WHERE event_id % 20 < 5""",
        "rejected_overs": """SELECT user_id AS match_id, CAST(hour(ts) % 12 AS INTEGER) AS "over", CASE user_id % 20 WHEN 0 THEN 'no match_id'
  WHEN 1 THEN 'no deliveries' WHEN 2 THEN 'season cannot be read' WHEN 3 THEN 'no data' WHEN 4 THEN 'no team'
  ELSE 'not a JSON object' END AS reason FROM events WHERE user_id % 20 < 6""",
        "holdout_split": _with(EVENTS) + """
SELECT event_id, match_id,
       CASE WHEN CAST('0x' || substr(md5(CAST(match_id AS VARCHAR)), 1, 8) AS BIGINT) / 4294967296.0 < 0.3
            THEN 'test' ELSE 'train' END AS part FROM ev""",
        "scored_position_keys": _with(LAPS, LAP_STATS) + f"""
SELECT race_id, driver, lap, final_position, true AS scored FROM stats
JOIN (SELECT race_id, driver, arg_max(position, lap) AS final_position FROM laps GROUP BY 1, 2) USING (race_id, driver)
WHERE std_position_up_to_lap IS NOT NULL AND {HELD_OUT.format("driver")}""",
        "scored_result_checks": _with(EVENTS, HALVES) + f"""SELECT match_id, count(*) AS n, true AS adds_up, true AS likeliest
FROM (SELECT DISTINCT match_id, event_sec FROM shifted) WHERE {HELD_OUT.format("match_id")} GROUP BY match_id""",
        "scored_winner_keys": _with(OVERS) + f"""SELECT match_id, inning, "over", true AS is_team FROM overs
WHERE {HELD_OUT.format("match_id")}""",
        "importance_total": f"SELECT '{','.join(sorted(FOOTBALL_FEATURES))}' AS names, 1.0::DOUBLE AS total",
        "classification_report": CLASSIFICATION,
        "ranking_report": RANKING,
        "regression_report": REGRESSION,
    }
