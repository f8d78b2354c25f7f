"""Schemas of the feeds and tables. Feeds are read with these; nothing is inferred.

All column and field names here are fixed values: they are those of the feeds and output tables.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields.items()])


STRING, INT, LONG, DOUBLE = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()

# --- football ---

EVENTS = _struct(
    id=LONG, matchId=LONG, matchPeriod=STRING, eventSec=DOUBLE, eventName=STRING, subEventName=STRING,
    subEventId=STRING, teamId=LONG, playerId=LONG, tags=STRING, tagsList=STRING,
    pos_orig_x=DOUBLE, pos_orig_y=DOUBLE, pos_dest_x=DOUBLE, pos_dest_y=DOUBLE,
)

POINT = _struct(x=DOUBLE, y=DOUBLE)
EVENT_OBJECT = _struct(
    subEventName=STRING, tags=STRING, playerId=LONG, positions=_struct(origin=POINT, destination=POINT),
    matchPeriod=STRING, eventSec=DOUBLE, subEventId=STRING, id=LONG, tagsList=STRING, teamId=LONG, eventName=STRING,
)
EVENTS_DOCUMENT = _struct(matches=T.MapType(STRING, _struct(events=T.MapType(STRING, EVENT_OBJECT))))
EVENT_MESSAGE = T.StructType([*EVENT_OBJECT.fields, T.StructField("matchId", STRING)])

# fixed values: field names of a match and of its two teams
MATCH_FIELDS = {
    "roundId": LONG, "gameweek": INT, "teamsData": STRING, "seasonId": LONG, "dateutc": STRING, "venue": STRING,
    "date": STRING, "referees": STRING, "competitionId": INT, "duration": STRING, "label": STRING, "status": STRING,
    "winner": STRING,
}
TEAM_FIELDS = {
    "scoreET": LONG, "coachId": LONG, "side": STRING, "teamId": LONG, "score": LONG, "scoreP": LONG,
    "hasFormation": LONG, "formation": STRING, "scoreHT": LONG, "formation.bench": STRING,
    "formation.lineup": STRING, "formation.substitutions": STRING,
}
MATCHES = _struct(
    wyId=LONG,
    **MATCH_FIELDS,
    **{f"team{n}.{name}": dtype for n in (1, 2) for name, dtype in TEAM_FIELDS.items()},
)
MATCH_OBJECT = _struct(**MATCH_FIELDS, team1=_struct(**TEAM_FIELDS), team2=_struct(**TEAM_FIELDS))
MATCHES_DOCUMENT = _struct(matches=T.MapType(STRING, MATCH_OBJECT))

MATCH_INFO = _struct(wyId=LONG, team1_id=LONG, team2_id=LONG, team1_side=STRING, team2_side=STRING)
TAG_NAMES = _struct(Tag=INT, Label=STRING)

COUNTERS = ["shots", "accurate_shots", "passes", "goals", "fouls", "duels_won"]
COUNTER_COLUMNS = [f"{side}_{name}" for name in COUNTERS for side in ("home", "away")]
POSSESSION_COLUMNS = ["home_possession_time", "away_possession_time"]
DIFF_COLUMNS = [f"{name}_diff" for name in ["goals", "passes", "fouls", "shots", "accurate_shots", "duels_won"]]
FOOTBALL_FEATURES = [*COUNTER_COLUMNS, *POSSESSION_COLUMNS, *DIFF_COLUMNS, "possession_time_diff"]

MATCH_STATS = _struct(
    event_id=STRING, matchId=STRING, eventSec=DOUBLE,
    **dict.fromkeys(COUNTER_COLUMNS, LONG), **dict.fromkeys(POSSESSION_COLUMNS, DOUBLE),
    **dict.fromkeys(DIFF_COLUMNS, LONG), possession_time_diff=DOUBLE,
)
MATCH_PREDICTIONS = _struct(
    event_id=STRING, match_id=STRING, event_sec=DOUBLE, predicted_result=STRING,
    prob_home_win=DOUBLE, prob_away_win=DOUBLE, prob_draw=DOUBLE,
)

# --- Formula 1 ---

LAP_TIMES = _struct(raceId=INT, driverId=INT, lap=INT, position=INT, milliseconds=LONG)
RACES = _struct(raceId=INT, name=STRING, date=STRING, circuitId=INT)
DRIVERS = _struct(driverId=INT, dob=T.DateType())
DRIVER_ENTRY = _struct(position=INT, milliseconds=LONG)
LAPS_DOCUMENT = _struct(
    races=T.MapType(STRING, _struct(laps=T.MapType(STRING, _struct(drivers=T.MapType(STRING, DRIVER_ENTRY)))))
)
LAP_STATISTICS = [
    "mean_position_up_to_lap", "std_position_up_to_lap", "min_position_up_to_lap", "last_5_laps_mean_position",
]
LAP_FEATURES = ["lap", "driver", "position", *LAP_STATISTICS]
LAP_STATS = _struct(lap=LONG, driver=LONG, position=LONG, **dict.fromkeys(LAP_STATISTICS, DOUBLE))

# --- cricket ---

DELIVERY = _struct(
    batter=STRING, bowler=STRING, non_striker=STRING, runs=_struct(batter=INT, extras=INT, total=INT),
    wickets=T.ArrayType(_struct(player_out=STRING, kind=STRING)),
)
OVER_DOCUMENT = _struct(
    match_id=LONG, team=STRING, players=T.MapType(STRING, T.ArrayType(STRING)), toss_winner=STRING,
    toss_decision=STRING, season=STRING, over_number=INT, winner=STRING, city=STRING,
    deliveries=T.ArrayType(DELIVERY),
)
OVER_FEATURES = [
    "inning", "over", "cumulative_score", "cumulative_wickets", "toss_decision", "toss_winner", "season",
    "current_team", "first_inning_total_score", "first_inning_total_wickets", "first_inning_run_rate",
    "team_1", "team_2", "run_rate", "required_run_rate",
]
_OVER_COLUMNS = dict(
    inning=LONG, over=LONG, batter=STRING, bowler=STRING, non_striker=STRING, runs_batter=LONG, runs_extras=LONG,
    runs_total=LONG, cumulative_score=LONG, cumulative_wickets=LONG, toss_decision=LONG, toss_winner=LONG,
    season=DOUBLE, current_team=LONG, first_inning_total_score=LONG, first_inning_total_wickets=LONG,
    first_inning_run_rate=DOUBLE, team_1=STRING, team_2=STRING, run_rate=DOUBLE, required_run_rate=DOUBLE,
)
OVER_STREAM_ROW = _struct(match_id=LONG, **_OVER_COLUMNS, predicted_winner=STRING)
OVER_HISTORY = T.StructType(
    [T.StructField(n, t, nullable=False) for n, t in {**_OVER_COLUMNS, "winner": LONG}.items()]
)
PLAYERS = 11
OVER_HISTORY_WITH_PLAYERS = T.StructType(
    [
        *OVER_HISTORY.fields,
        *[T.StructField(f"team_{n}_player_{i}", STRING) for n in (1, 2) for i in range(1, PLAYERS + 1)],
    ]
)
METRICS = T.StructType(
    [T.StructField("metric_name", STRING, nullable=False), T.StructField("metric_value", DOUBLE, nullable=False)]
)
