import json
import random
import time
from pathlib import Path

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from matchflow import schemas
from matchflow.operators.laps import position_statistics
from matchflow.operators.running import ROWS_PER_CHUNK_CONF, running
from matchflow.sources import messages
from matchflow.streaming import football, laps, overs
from matchflow.streaming.commits import MAX_FOLDERS, CommitLog

MATCHES = [("1", 10, 11, "home", "away"), ("2", 12, 13, "away", "home")]
MATCH_SCHEMA = "matchId string, team1_id long, team2_id long, team1_side string, team2_side string"
TAG_TEXT = ["[1801, 101]", "[1801]", "[703]", "", "junk"]


def land(folder, number, texts):
    folder.mkdir(exist_ok=True)
    path = folder / f"{number:03d}.json"
    path.write_text("\n".join(texts))
    import os

    os.utime(path, (1_700_000_000 + number, 1_700_000_000 + number))  # files are taken in this order


def football_events(n=120, seed=5):
    rnd = random.Random(seed)
    teams = {"1": [10, 11, 99], "2": [12, 13], "3": [1]}
    out = []
    for i in range(n):
        match = rnd.choice(["1", "1", "1", "2", "3"])
        out.append({
            "id": i, "matchId": match, "teamId": rnd.choice(teams[match]), "matchPeriod": "1H" if i < 70 else "2H",
            "eventSec": float(i if i < 70 else i - 70), "eventName": rnd.choice(["Shot", "pass ", "Foul", "Duel", "Other"]),
            "tagsList": rnd.choice(TAG_TEXT),
        })
    return out


def brute_match_stats(events):
    """The live rules event by event: counters, and time credited to the side before."""
    side_of = {("1", 10): "home", ("1", 11): "away", ("2", 12): "away", ("2", 13): "home"}
    tags_of = {"[1801, 101]": [1801, 101], "[1801]": [1801], "[703]": [703]}
    state, out = {}, []
    for e in events:
        s = state.setdefault(e["matchId"], {**dict.fromkeys(schemas.COUNTER_COLUMNS + schemas.POSSESSION_COLUMNS, 0), "last": None})
        sec = e["eventSec"] + (3600 if e["matchPeriod"] == "2H" else 0)
        side, name, tags = side_of.get((e["matchId"], e["teamId"]), "unknown"), e["eventName"].strip().lower(), tags_of.get(e["tagsList"], [])
        if s["last"] and s["last"][1] != "unknown":
            s[f"{s['last'][1]}_possession_time"] += max(0, sec - s["last"][0])
        hit = []
        if name == "shot":
            hit = ["shots"] + (["accurate_shots"] if 1801 in tags else []) + (["goals"] if {1801, 101} <= set(tags) else [])
        elif name in ("pass", "foul"):
            hit = [{"pass": "passes", "foul": "fouls"}[name]]
        elif name == "duel" and 703 in tags:
            hit = ["duels_won"]
        if side != "unknown":
            for h in hit:
                s[f"{side}_{h}"] += 1
        s["last"] = (sec, side)
        out.append((e["matchId"], sec, {k: v for k, v in s.items() if k != "last"}))
    return out


def run_football(spark, tmp_path, texts_by_file, **options):
    folder = tmp_path / "in"
    for number, texts in enumerate(texts_by_file):
        land(folder, number, texts)
    matches = spark.createDataFrame(MATCHES, MATCH_SCHEMA)
    stream = messages.read_message_files(spark, str(folder), max_files=1)
    events = football.enrich_events(football.parse_events(stream), matches)
    out = str(tmp_path / "out")
    football.start_match_statistics(events, out, str(tmp_path / "ck"), **options).awaitTermination()
    return football.read_statistics(CommitLog(spark, out))


@pytest.mark.parametrize("cuts, limit", [([0, 120], None), ([0, 30, 31, 90, 120], None), ([0, 60, 120], 20)])
def test_match_stats_do_not_depend_on_the_cut(spark, tmp_path, cuts, limit):
    events = football_events()
    files = [[json.dumps(e) for e in events[a:b]] + ["not json", '"Invalid data provided."', "[1]"] for a, b in zip(cuts, cuts[1:])]
    if limit:
        spark.conf.set(ROWS_PER_CHUNK_CONF, str(limit))
    try:
        got = run_football(spark, tmp_path, files).collect()
    finally:
        spark.conf.unset(ROWS_PER_CHUNK_CONF)
    want = brute_match_stats(events)
    assert len(got) == len(want)
    found = {(r.matchId, r.eventSec): r.asDict() for r in got}
    for match, sec, values in want:
        row = found[match, sec]
        assert {k: row[k] for k in values} == values
        assert row["event_id"].startswith(f"{match}_{int(sec)}_")


def test_restart_goes_on_where_it_stopped(spark, tmp_path):
    events = football_events()
    first = run_football(spark, tmp_path, [[json.dumps(e) for e in events[:50]]])
    assert first.count() == 50
    land(tmp_path / "in", 1, [json.dumps(e) for e in events[50:]])
    matches = spark.createDataFrame(MATCHES, MATCH_SCHEMA)
    stream = football.enrich_events(football.parse_events(messages.read_message_files(spark, str(tmp_path / "in"), 1)), matches)
    football.start_match_statistics(stream, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    found = {(r.matchId, r.eventSec): r for r in football.read_statistics(CommitLog(spark, str(tmp_path / "out"))).collect()}
    for match, sec, values in brute_match_stats(events):
        assert {k: found[match, sec][k] for k in values} == values


def test_time_that_runs_backwards_counts_as_zero_and_doubling_is_optional(spark, tmp_path):
    base = {"matchId": "1", "teamId": 10, "matchPeriod": "1H", "eventName": "Pass", "tagsList": ""}
    files = [[json.dumps({**base, "eventSec": s})] for s in (10.0, 25.0, 5.0, 6.0)]
    rows = run_football(spark, tmp_path, files, double_count=True).orderBy("batch_id").collect()
    assert [r.home_possession_time for r in rows] == [0.0, 30.0, 30.0, 32.0]


def totals_of(spark, log, batch_id):
    """All live rows of a state as the next micro-batch finds them."""
    return log.begin(batch_id).state("totals", ["matchId"]).read()


STATE = "matchId string, __s0 struct<v: bigint>, n int"


def carry(spark, log, batch_id, rows, ttl=None):
    """A micro-batch that puts down ``rows`` as the state of their groups."""
    work = log.begin(batch_id)
    state = work.state("totals", ["matchId"], F.col("__s0.v"), ttl, buckets=4)
    given = spark.createDataFrame(rows, STATE)
    before = state.before(given)
    state.after(given)
    work.write("out", given)
    work.commit()
    return {} if before is None else {r.matchId: r.n for r in before.collect()}, work


def test_state_finds_the_rows_of_its_groups_only(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "log"))
    assert carry(spark, log, 0, [(str(i), (i,), 0) for i in range(50)] + [(None, (1,), 7)])[0] == {}
    assert carry(spark, log, 1, [("3", (1,), 1), (None, (1,), 8), ("new", (1,), 1)])[0] == {"3": 0, None: 7}
    assert carry(spark, log, 2, [("3", (1,), 2), ("4", (1,), 2), (None, (1,), 9)])[0] == {"3": 1, "4": 0, None: 8}
    every = {r.matchId: r.n for r in totals_of(spark, log, 3).collect()}
    assert every == {**{str(i): 0 for i in range(50)}, "3": 2, "4": 2, None: 9, "new": 1}


def written(work, name):
    return sum(f.stat().st_size for folder in work.states[name]["folders"].values() for f in Path(folder[-1]).rglob("*.parquet") if f"batch_id={work.batch_id}" in str(f))


def test_bytes_written_do_not_grow_with_idle_groups(spark, tmp_path):
    sizes = []
    for idle in (10, 20_000):
        log = CommitLog(spark, str(tmp_path / f"log{idle}"))
        carry(spark, log, 0, [(f"idle {i}", (i,), i) for i in range(idle)])
        sizes.append(written(carry(spark, log, 1, [("live", (1,), 1)])[1], "totals"))
    assert sizes[0] == sizes[1] > 0


def test_buckets_are_written_anew_and_lose_idle_groups(spark, tmp_path):
    now = int(time.time())
    log = CommitLog(spark, str(tmp_path / "log"))
    carry(spark, log, 0, [("live", (now,), 0), ("idle", (now - 5000,), 0), ("fresh", (now,), 5)])
    for n in range(1, MAX_FOLDERS + 2):
        carry(spark, log, n, [(m, (now,), n) for m in ("live", "a", "b", "c", "d", "e", "f")], ttl=1000)
    work = log.begin(MAX_FOLDERS + 2)
    state = work.state("totals", ["matchId"])
    assert max(map(len, state.entry["folders"].values())) <= MAX_FOLDERS
    rows = {r.matchId: r.n for r in state.read().collect()}
    assert rows["live"] == MAX_FOLDERS + 1 and rows["fresh"] == 5
    forgetting = work.state("totals", ["matchId"], F.col("__s0.v"), 1000)
    assert "idle" not in {r.matchId for r in forgetting.read().collect()}


def test_replayed_batch_finds_its_state_and_readers_see_whole_batches(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "log"))
    carry(spark, log, 0, [("1", (1,), 10)])
    seen = []
    for failing in (True, True, False):  # the batch fails after it has written its table and state, twice
        work = log.begin(1)
        state = work.state("totals", ["matchId"])
        given = spark.createDataFrame([("1", (1,), 20)], STATE)
        seen.append([r.n for r in state.before(given).collect()])
        state.after(given)
        work.write("out", given)
        work.write("more", given)
        assert [r.n for r in log.read("out", given.schema).collect()] == [10] and log.read("more", given.schema).count() == 0
        if not failing:
            work.commit()
    assert seen == [[10]] * 3  # each attempt starts from the state that the batch before left
    assert log.begin(1) is None  # complete, so it is not worked on again
    assert sorted((r.n, r.batch_id) for r in log.read("out", given.schema).collect()) == [(10, 0), (20, 1)]
    assert log.read("more", given.schema).count() == 1
    with pytest.raises(RuntimeError, match="without a record"):
        log.begin(7)


def test_both_tables_are_read_whole_while_a_batch_runs_again(spark, tmp_path):
    """Scoring fails after the statistics are written: readers see neither table of the batch, and then both."""
    log = CommitLog(spark, str(tmp_path / "live"))
    rows = [("1_0_a", "1", 0.0, "Shot", [1801, 101], "home"), ("1_5_b", "1", 5.0, "Pass", [], "home")]
    events = spark.createDataFrame(rows, "event_id string, matchId string, eventSec double, eventName string, tagsList array<int>, side string")
    score = lambda stats: stats.selectExpr(
        "event_id", "matchId as match_id", "eventSec as event_sec", "'home' as predicted_result", "1.0D as prob_home_win", "0.0D as prob_away_win", "0.0D as prob_draw"
    )

    def failing(stats):
        assert football.read_statistics(log).count() == football.read_predictions(log).count()
        raise OSError("no model")

    football.work_off(log, events.limit(1), 0, score)
    for attempt in range(2):
        with pytest.raises(OSError, match="no model"):
            football.work_off(log, events.where("eventSec > 0"), 1, failing)
        assert football.read_statistics(log).count() == football.read_predictions(log).count() == 1
    football.work_off(log, events.where("eventSec > 0"), 1, score)
    football.work_off(log, events.where("eventSec > 0"), 1, failing)  # complete already, so it does nothing
    got = football.read_statistics(log).join(football.read_predictions(log), "event_id").collect()
    assert {r.event_id: r.home_goals for r in got} == {"1_0_a": 1, "1_5_b": 1}
    assert {r.home_possession_time for r in got} == {0.0, 5.0}


def test_idle_matches_are_forgotten(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "log"))

    def passes(number, match, ttl):
        rows = [(f"e{number}", match, 1.0, "Pass", [], "home")]
        batch = spark.createDataFrame(rows, "event_id string, matchId string, eventSec double, eventName string, tagsList array<int>, side string")
        football.work_off(log, batch, number, ttl_seconds=ttl)
        return football.read_statistics(log).where(f"event_id = 'e{number}'").first().home_passes

    assert [passes(0, "1", None), passes(1, "1", 1000), passes(2, "1", -1), passes(3, "2", None), passes(4, "1", None)] == [1, 2, 1, 1, 2]


def test_idle_drivers_are_forgotten(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "log"))

    def mean(number, position, ttl):
        lap = spark.createDataFrame([("1", 7, number, position)], "race_id string, driver bigint, lap bigint, position int")
        laps.work_off(log, lap, number, ttl_seconds=ttl)
        return laps.read_statistics(log).where(f"lap = {number}").first().mean_position_up_to_lap

    assert [mean(0, 2, None), mean(1, 4, 1000), mean(2, 9, -1), mean(3, 1, None)] == [2.0, 3.0, 9.0, 5.0]


@pytest.mark.parametrize("cuts", [[0, 40], [0, 13, 14, 40]])
def test_lap_stats_equal_windows(spark, tmp_path, cuts):
    rnd = random.Random(2)
    rows = [(1, lap, driver, rnd.randint(1, 20)) for lap in range(1, 21) for driver in (7, 8)]
    as_message = lambda r: json.dumps({"races": {str(r[0]): {"laps": {str(r[1]): {"drivers": {str(r[2]): {"position": r[3]}}}}}}})
    for number, (a, b) in enumerate(zip(cuts, cuts[1:])):
        land(tmp_path / "in", number, [as_message(r) for r in rows[a:b]] + ["broken"])
    parsed = laps.parse_laps(messages.read_message_files(spark, str(tmp_path / "in"), 1))
    out = str(tmp_path / "out")
    laps.start_lap_statistics(parsed, out, str(tmp_path / "ck")).awaitTermination()
    got = laps.read_statistics(CommitLog(spark, out)).drop("batch_id")
    assert [f.name for f in schemas.LAP_STATS] == [c for c in got.columns if c != "race_id"]
    table = spark.createDataFrame([(str(a), b, c, d) for a, b, c, d in rows], "race_id string, lap long, driver long, position int")
    want = running(table, ["race_id", "driver"], ["lap"], position_statistics(ddof=0))
    flat = lambda df: sorted((r.driver, r.lap, *[round(r[c], 9) for c in schemas.LAP_STATISTICS]) for r in df.collect())
    assert flat(got) == flat(want)


def over_message(match, team, over, runs, wickets=0, toss=("A", "bat")):
    return json.dumps({
        "match_id": match, "team": team, "players": {"A": ["a"], "B": ["b"]}, "toss_winner": toss[0], "toss_decision": toss[1],
        "season": "2020", "over_number": over, "winner": "A", "city": "X",
        "deliveries": [{"batter": "a", "bowler": "b", "non_striker": "c", "runs": {"batter": runs, "extras": 0, "total": runs},
                        "wickets": [{"player_out": "a"}] * wickets}],
    })


OVER_MESSAGES = [
    over_message(1, "A", 0, 5), over_message(2, "B", 0, 1, toss=("A", "field")), over_message(1, "A", 0, 5),  # repeated
    over_message(1, "A", 3, 4, 1),  # overs 1 and 2 are skipped: 2 * 7.61 -> 15 runs, 2 * 0.36 -> 0 wickets
    over_message(1, "B", 2, 6, 12),  # first over of an inning is never preceded by imputed ones
    over_message(1, "A", 5, 50),  # late: inning 2 has begun
    over_message(1, "B", 6, 2),  # 3 skipped: 3 * 7.29 -> 21 runs, 3 * 0.34 -> 1 wicket
    over_message(1, "B", 4, 9), over_message(2, "B", 1, 3, toss=("A", "field")), "broken",
]


@pytest.mark.parametrize("sizes", [[10], [1] * 10, [3, 4, 3]])
def test_overs_impute_gaps_and_drop_late_input(spark, tmp_path, sizes):
    at = 0
    for number, size in enumerate(sizes):
        land(tmp_path / "in", number, OVER_MESSAGES[at : at + size])
        at += size
    parsed = overs.parse_overs(messages.read_message_files(spark, str(tmp_path / "in"), 1))
    out = str(tmp_path / "out")
    overs.start_over_statistics(parsed, out, str(tmp_path / "ck")).awaitTermination()
    log = CommitLog(spark, out)
    got = {(r.match_id, r.inning, r.over): r for r in overs.read_overs(log).collect()}
    dropped = sorted((r.match_id, r.inning, r.over, r.dropped) for r in overs.read_overs(log, overs.DROPPED).collect())
    assert len(got) + len(dropped) == 9  # every over leaves once
    scores = {k: (r.cumulative_score, r.cumulative_wickets) for k, r in got.items()}
    if len(sizes) == 1:  # in one batch everything is put in order first, so nothing is late
        assert scores[1, 1, 5] == (81, 1) and scores[1, 2, 4] == (15 + 7, 10)
        return
    if sizes == [1] * 10:
        assert dropped == [(1, 1, 0, "repeated"), (1, 1, 5, "late"), (1, 2, 4, "late")]
    late_four = {(1, 2, 4)} if sizes == [3, 4, 3] else set()
    assert set(scores) - late_four == {(1, 1, 0), (1, 1, 3), (1, 2, 2), (1, 2, 6), (2, 1, 0), (2, 1, 1)} | ({(1, 1, 5)} if sizes == [3, 4, 3] else set())
    assert scores[1, 1, 0] == (5, 0) and scores[1, 1, 3] == (24, 1)
    assert scores[2, 1, 1] == (4, 0)
    if sizes == [1] * 10:
        assert scores[1, 2, 2] == (6, 10) and scores[1, 2, 6] == (29, 10)
        row = got[1, 2, 6]
        assert (row.first_inning_total_score, row.first_inning_total_wickets, row.first_inning_run_rate) == (24, 1, 24.0)
        assert row.required_run_rate == pytest.approx((24 - 29) / 13) and row.run_rate == pytest.approx(29 / 7)
        assert (got[2, 1, 0].team_1, got[2, 1, 0].toss_winner, got[2, 1, 0].toss_decision) == ("B", 1, 1)


def test_over_processor_on_a_table(spark):
    rows = [(1, 1, o, 6, 1) for o in (0, 1, 4)] * 3 + [(None, 1, 0, 1, 0)]
    df = spark.createDataFrame(rows, "match_id long, inning int, over int, over_runs long, over_wickets long")
    spark.conf.set(overs._PROVIDER, overs._ROCKSDB)
    got = overs.carry_overs(df, mean_runs={1: 5.5, 2: 0}, mean_wickets={1: 0.5, 2: 0}).orderBy("over").collect()
    assert [(r.over, r.cumulative_score, r.cumulative_wickets) for r in got] == [(0, 6, 1), (1, 12, 2), (4, 12 + 11 + 6, 4)]


def test_overs_that_do_not_count_are_tagged(spark):
    rows = [(1, 1, o, 6, 1) for o in (0, 1, 4)] * 3 + [(1, 1, 4, 9, 0)]
    df = spark.createDataFrame(rows, "match_id long, inning int, over int, over_runs long, over_wickets long")
    spark.conf.set(overs._PROVIDER, overs._ROCKSDB)
    got = overs.tagged_overs(df, mean_runs={1: 0, 2: 0}, mean_wickets={1: 0, 2: 0}).collect()
    assert sorted((r.over, r.dropped or "", r.cumulative_score) for r in got if not r.dropped) == [(0, "", 6), (1, "", 12), (4, "", 21)]
    assert sorted((r.over, r.dropped) for r in got if r.dropped) == [(0, "repeated")] * 2 + [(1, "repeated")] * 2 + [(4, "repeated")] * 3


def test_idle_matches_leave_by_a_timer(spark, tmp_path):
    schema = "match_id long, inning int, over int, over_runs long, over_wickets long, team_1 string"
    out = str(tmp_path / "out")
    spark.createDataFrame([(1, 1, 3, 5, 1, "A")], schema).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    with pytest.raises(ValueError, match="processingTime"):
        overs.start_over_statistics(stream, out, str(tmp_path / "ck"), ttl_ms=1, trigger={"availableNow": True})
    query = overs.start_over_statistics(stream, out, str(tmp_path / "ck"), ttl_ms=1, trigger={"processingTime": "1 second"})
    log, until = CommitLog(spark, out), time.time() + 60
    try:
        while time.time() < until and (log.record(1) is None or not log.record(1)["tables"]):
            time.sleep(1)
    finally:
        query.stop()
    assert [(r.over, r.cumulative_score, r.team_1) for r in overs.read_overs(log).where("batch_id = 0").collect()] == [(3, 5, "A")]
    idle = [(r.match_id, r.over, r.dropped, r.cumulative_score, r.cumulative_wickets) for r in overs.read_overs(log, overs.DROPPED).collect()]
    assert idle == [(1, 3, "idle", 5, 1)]


def test_every_message_is_an_event_or_rejected_with_a_reason(spark):
    texts = {
        '{"matchId": 1, "eventSec": 3, "matchPeriod": "2H"}': None, '{"matchId": "1"}': None, '{"matchId": 1, "eventSec": null}': None,
        "{}": "no matchId", '{"matchId": null, "eventSec": "x"}': "no matchId", '{"matchId": 1, "eventSec": "soon"}': "eventSec is no number",
        "[1]": "not a JSON object", "{broken": "not a JSON object", "": "not a JSON object", '"Invalid data provided."': "no data", None: "not a JSON object",
    }
    sent = spark.createDataFrame([(t, 7) for t in texts], "value string, offset int")
    assert {r.value: r.reason for r in football.rejected_events(sent).collect()} == {t: reason for t, reason in texts.items() if reason}
    assert football.rejected_events(sent).columns == ["value", "offset", "reason"]
    assert sorted(r.eventSec or 0 for r in football.parse_events(sent).collect()) == [0, 0, 3603.0]


def test_kafka_source_needs_its_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        messages.read_topic(spark, "localhost:9092", "events").explain()


def test_stream_output_schema(spark, tmp_path):
    got = run_football(spark, tmp_path, [[json.dumps(football_events(1)[0])]])
    assert [(f.name, f.dataType) for f in got.schema if f.name != "batch_id"] == [(f.name, f.dataType) for f in schemas.MATCH_STATS]


class _Kept:
    """A state of one value that counts how often it is read and written."""

    def __init__(self):
        self.value, self.reads, self.writes = None, 0, 0

    def get(self):
        self.reads += 1
        return self.value

    def update(self, value):
        self.value, self.writes = value, self.writes + 1


def test_over_processor_works_on_plain_rows_with_one_read_and_one_write():
    columns = ["match_id", "inning", "over", "over_runs", "over_wickets", "city"]
    processor, state = overs.OverProcessor(columns, {1: 5.5, 2: 0}, {1: 0, 2: 0}), _Kept()
    processor.state = state
    asked = []

    def rows(*values):
        for value in values:
            asked.append(value)
            yield Row(*columns)(1, *value, "X")

    found = processor.handleInputRows((1,), rows((1, 2, 4, 0), (1, 2, 9, 0), (1, 0, 1, 0)), None)
    first = next(found)
    assert (first.over_runs, first.dropped, first.city, len(asked)) == (4, overs.REPEATED, "X", 2)  # leaves while input is read
    assert [(r.over, r.cumulative_score, r.dropped) for r in found] == [(0, 1, None), (2, 1 + 5 + 9, None)]
    assert (state.reads, state.writes) == (1, 1)
    assert [r.dropped for r in processor.handleInputRows((1,), rows((1, 1, 3, 0), (1, 2, 9, 0)), None)] == [overs.LATE, overs.REPEATED]
