import random

import pytest
from pyspark.sql import functions as F

from matchflow import schemas
from matchflow.functions import football as fx
from matchflow.operators import football, joins
from matchflow.operators.running import ROWS_PER_CHUNK_CONF

TAGS = {"Shot": [[1801, 101], [1801], [101], []], "Duel": [[703], []], "Pass": [[1801]], "Foul": [[]], "Other": [[]]}


def sample(n=300, hot=0.5, seed=3):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        match = 1 if rnd.random() < hot else rnd.randint(2, 6)
        name = rnd.choice(list(TAGS))
        rows.append((i, match, float(rnd.randint(0, 60)), rnd.choice(["home", "away", "unknown"]), name, rnd.choice(TAGS[name]), "1H" if rnd.random() < 0.6 else "2H"))
    return rows


SCHEMA = "event_id long, match_id int, event_sec double, side string, event_name string, tags array<int>, match_period string"


def counts_of(event):
    _, _, _, side, name, tags, _ = event
    hit = {
        "shots": name == "Shot", "accurate_shots": name == "Shot" and 1801 in tags,
        "goals": name == "Shot" and 1801 in tags and 101 in tags, "passes": name == "Pass", "fouls": name == "Foul",
        "duels_won": name == "Duel" and 703 in tags,
    }
    return {f"{s}_{c}": int(hit[c] and side == s) for c in hit for s in ("home", "away")}


def brute_stats(rows, credit):
    """Recounts all events up to every second, as slowly as it can be said."""
    out = {}
    for match in {r[1] for r in rows}:
        events = sorted((r for r in rows if r[1] == match), key=lambda r: (r[2], r[0]))
        for second in {r[2] for r in events}:
            seen = [r for r in events if r[2] <= second]
            total = {c: sum(counts_of(r)[c] for r in seen) for c in schemas.COUNTER_COLUMNS}
            held = {"home": 0.0, "away": 0.0, "unknown": 0.0}
            for before, now in zip(seen, seen[1:]):
                held[(now if credit == "current" else before)[3]] += now[2] - before[2]
            total |= {"home_possession_time": held["home"], "away_possession_time": held["away"]}
            for name in [*schemas.COUNTERS, "possession_time"]:
                total[f"{name}_diff"] = total[f"home_{name}"] - total[f"away_{name}"]
            out[match, second] = total
    return out


@pytest.fixture(params=[25, 20_000_000], ids=["hot", "plain"])
def chunked(spark, request):
    spark.conf.set(ROWS_PER_CHUNK_CONF, str(request.param))
    yield request.param
    spark.conf.unset(ROWS_PER_CHUNK_CONF)


@pytest.mark.parametrize("credit", ["current", "previous"])
def test_cumulative_stats(spark, chunked, credit):
    rows = sample()
    flags = fx.flags_by_code(F.col("event_name"), F.col("tags"))
    got = football.cumulative_stats(spark.createDataFrame(rows, SCHEMA), flags, credit)
    assert set(got.columns) == {"match_id", "event_sec", *schemas.FOOTBALL_FEATURES}
    want = brute_stats(rows, credit)
    found = {(r.match_id, r.event_sec): r.asDict() for r in got.collect()}
    assert found.keys() == want.keys()
    for key, values in want.items():
        assert {n: found[key][n] for n in values} == values


@pytest.mark.parametrize("credit", ["current", "previous"])
def test_possession_per_event(spark, chunked, credit):
    rows = sample()
    got = {r.event_id: r for r in football.possession(spark.createDataFrame(rows, SCHEMA), credit).collect()}
    assert len(got) == len(rows)
    for match in {r[1] for r in rows}:
        events = sorted((r for r in rows if r[1] == match), key=lambda r: (r[2], r[0]))
        for before, now in zip([None, *events], events):
            passed = now[2] - before[2] if before else 0
            side = (now if credit == "current" else before or now)[3]
            row = got[now[0]]
            assert (row.time_diff, row.home_possession_time, row.away_possession_time) == (
                passed, passed * (side == "home"), passed * (side == "away"),
            )


def test_offset_in_the_same_pass(spark, chunked):
    rows = sample()
    df = spark.createDataFrame(rows, SCHEMA)
    flags = fx.flags_by_code(F.col("event_name"), F.col("tags"))
    moved = football.shift_second_half(df)
    two_steps = football.cumulative_stats(moved, flags)
    one_step = football.cumulative_stats(df, flags, offset="first_half_max")
    assert sorted(map(str, two_steps.collect())) == sorted(map(str, one_step.select(two_steps.columns).collect()))


@pytest.mark.parametrize("hot", [True, False])
def test_half_offsets(spark, hot):
    rows = [(1, 1, 10.0, "1H"), (2, 1, 2700.0, "1H"), (3, 1, 5.0, "2H"), (4, 2, 5.0, "2H"), (5, 1, 1.0, "E1")]
    df = spark.createDataFrame(rows, "event_id int, match_id int, event_sec double, match_period string")
    at = lambda offset: {r.event_id: r.event_sec for r in football.shift_second_half(df, offset, hot=hot).collect()}
    assert at("first_half_max") == {1: 10.0, 2: 2700.0, 3: 2705.0, 4: None, 5: 1.0}
    assert at("fixed") == {1: 10.0, 2: 2700.0, 3: 3605.0, 4: 3605.0, 5: 1.0}
    with pytest.raises(ValueError):
        football.shift_second_half(df, "other")


def test_join_matches_resolves_sides_per_match(spark):
    matches = spark.createDataFrame(
        [("1", "10", "home", "11", "away", "10"), ("2", "10", "away", "12", "home", "12"), ("3", "1", "home", "2", "away", "")],
        "match_id string, team1_teamId string, team1_side string, team2_teamId string, team2_side string, winner string",
    )
    events = spark.createDataFrame([("1", 10), ("1", 11), ("1", 99), ("2", 10), ("3", 1), ("4", 1)], "match_id string, team_id int")
    got = sorted((r.match_id, r.team_id, r.side, r.result) for r in football.join_matches(events, matches).collect())
    assert got == [
        ("1", 10, "home", "home"), ("1", 11, "away", "home"), ("1", 99, "unknown", "home"), ("2", 10, "away", "home"), ("3", 1, "home", None),
    ]


def test_counters_never_fall_and_differences_hold(spark):
    flags = fx.flags_by_code(F.col("event_name"), F.col("tags"))
    rows = football.cumulative_stats(spark.createDataFrame(sample(), SCHEMA), flags).orderBy("match_id", "event_sec").collect()
    for a, b in zip(rows, rows[1:]):
        assert all(b[f"{n}_diff"] == b[f"home_{n}"] - b[f"away_{n}"] for n in schemas.COUNTERS)
        if a.match_id == b.match_id:
            assert all(a[c] <= b[c] for c in schemas.COUNTER_COLUMNS + schemas.POSSESSION_COLUMNS)


def test_one_shuffle_without_hot_matches(spark, capsys):
    flags = fx.flags_by_code(F.col("event_name"), F.col("tags"))
    football.cumulative_stats(spark.createDataFrame(sample(), SCHEMA), flags, offset="first_half_max").explain()
    plan = capsys.readouterr().out
    assert plan.count("Exchange hashpartitioning") == 1 and "Python" not in plan and "Join" not in plan


def test_enrich_side(spark):
    matches = spark.createDataFrame([("1", 10, 11, "home", "away")], "matchId string, team1_id int, team2_id int, team1_side string, team2_side string")
    events = spark.createDataFrame([("1", 10), ("1", 11), ("1", 12), ("9", 10), (None, 10)], "matchId string, teamId int")
    got = [(r.matchId, r.teamId, r.side) for r in joins.enrich_side(events, matches).collect()]
    assert sorted(got, key=str) == sorted(
        [("1", 10, "home"), ("1", 11, "away"), ("1", 12, "unknown"), ("9", 10, "unknown"), (None, 10, "unknown")], key=str
    )


@pytest.mark.parametrize("entries", [0, 1000])
def test_tag_labels_by_map_and_by_join(spark, entries):
    names = spark.createDataFrame([(101, "Goal"), (1801, "accurate")], schemas.TAG_NAMES)
    names = names.unionByName(spark.createDataFrame([(101, "Aim"), (None, "none")], schemas.TAG_NAMES))
    rows = [(1, [1801, 101, 5]), (2, []), (3, [101, 101]), (4, None), (3, [101, 101]), (5, [None])]
    df = spark.createDataFrame(rows, "id int, tags array<int>")
    got = sorted(((r.id, r.tags_labels) for r in joins.label_tags(df, "tags", names, map_entries=entries).collect()), key=str)
    twice = (3, ["Goal", "Goal"])
    assert got == [(1, ["accurate", "Goal", "Unknown"]), (2, []), twice, twice, (4, None), (5, ["Unknown"])]


def test_pruning_and_missing(spark):
    facts = spark.createDataFrame([(1,), (1,), (3,)], "driver int")
    dim = spark.createDataFrame([(1, "a"), (2, "b")], "driverId int, name string")
    assert [r.name for r in joins.pruned(dim, facts, "driverId", "driver").collect()] == ["a"]
    wanted = spark.createDataFrame([(1,), (2,), (2,)], "driver int")
    assert [r.driver for r in joins.missing(wanted, facts, "driver").collect()] == [2]


@pytest.mark.parametrize("limit", ["100", "3"])
def test_null_match_is_moved_alike_when_hot(spark, limit):
    rows = [(None, float(s), "1H") for s in range(6)] + [(None, 5.0, "2H"), ("1", 2.0, "1H")]
    df = spark.createDataFrame(rows, "match_id string, event_sec double, match_period string")
    hot = limit == "3"
    moved = football.shift_second_half(df, hot=hot)
    assert sorted(r.event_sec for r in moved.where("match_period = '2H'").collect()) == [10.0]


def test_matches_landed_twice_count_once(spark):
    match = ("1", "10", "11", "home", "away", 10)
    matches = spark.createDataFrame([match, match], "match_id string, team1_teamId string, team2_teamId string, team1_side string, team2_side string, winner int")
    events = spark.createDataFrame([("1", 10)], "match_id string, team_id int")
    assert football.join_matches(events, matches).count() == 1
