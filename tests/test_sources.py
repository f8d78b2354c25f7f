import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchflow import schemas
from matchflow.sources import files, messages, nested

LAPS = [(1, 10, 1, 3, 90_000), (1, 10, 2, 2, 91_000), (1, 11, 1, 1, 89_000), (2, 10, 1, 5, 80_000)]


@pytest.fixture
def laps(spark, tmp_path):
    path = tmp_path / "lap_times.csv"
    lines = ["raceId,driverId,lap,position,milliseconds", *[",".join(map(str, r)) for r in LAPS]]
    path.write_text("\n".join(lines))
    return files.read_csv(spark, str(path), schemas.LAP_TIMES)


def as_json(df):
    return json.loads(df.drop("part", "parts").toJSON().first())


def test_lap_documents(laps):
    positions = as_json(nested.laps_document(files.lookup_laps(laps, 1, 1), ["position"]))
    assert positions == {"races": {"1": {"laps": {"1": {"drivers": {"10": {"position": 3}, "11": {"position": 1}}}}}}}
    times = as_json(nested.laps_document(files.lookup_laps(laps, 1, 2), ["milliseconds"]))
    assert times == {"races": {"1": {"laps": {"2": {"drivers": {"10": {"milliseconds": 91_000}}}}}}}
    assert set(as_json(nested.laps_document(files.lookup_laps(laps, 1)))["races"]["1"]["laps"]) == {"1", "2"}
    assert nested.laps_document(files.lookup_laps(laps, 99)).isEmpty()


def test_lap_roundtrip(laps):
    documents = nested.laps_document(laps).select(F.struct("races").alias("document"))
    flat = nested.flatten_laps(documents)
    got = {(int(r.race_id), int(r.driver), r.lap, r.position, r.milliseconds) for r in flat.collect()}
    assert got == set(LAPS)


def test_large_documents_come_in_parts(laps):
    documents = nested.laps_document(laps, max_entries=2)
    assert documents.count() == 3  # race 1 has three entries, race 2 one
    flat = nested.flatten_laps(documents.select(F.struct("races").alias("document")))
    assert {(int(r.race_id), int(r.driver), r.lap, r.position, r.milliseconds) for r in flat.collect()} == set(LAPS)


def test_race_lookup(spark):
    races = spark.createDataFrame([(1, "One", "2009-03-29", 3), (2, "Two", "2009-04-05", 4)], schemas.RACES)
    assert files.lookup_race(races, 2).first().asDict() == {"name": "Two", "date": "2009-04-05"}
    assert files.lookup_race(races, 9).isEmpty()


EVENT_ROWS = [
    (1, 7, "1H", 10.0, "Shot", "Shot", "100", 5, 50, "t", "[101, 1801]", 1.0, 2.0, 3.0, 4.0),
    (2, 7, "2H", 10.0, "Pass", "Simple pass", "85", 6, 60, "t", "", 1.0, 2.0, None, None),
    (3, 8, "1H", 0.0, "Foul", "Foul", "20", 5, 50, "t", "junk", None, None, None, None),
]


def test_event_lookup_and_roundtrip(spark):
    events = spark.createDataFrame(EVENT_ROWS, schemas.EVENTS)
    assert [r.id for r in files.lookup_events(events, 7, 3610, 3610).collect()] == [2]
    assert [r.id for r in files.lookup_events(events, 7, 0, 10).collect()] == [1]
    assert files.lookup_events(events, 8).count() == 1
    flat = nested.flatten_events(nested.events_document(events).select(F.struct("matches").alias("document")))
    got = {r.event_id: r for r in flat.collect()}
    assert len(flat.columns) == 15 and set(got) == {"1", "2", "3"}
    assert (got["1"].match_id, got["1"].event_name, got["1"].pos_dest_y, got["1"].tags_list) == ("7", "Shot", 4.0, "[101, 1801]")
    assert got["2"].pos_dest_x is None


def test_flatten_events_fills_defaults(spark):
    text = '{"matches": {"7": {"events": {"1": {"teamId": 5}}}}}'
    df = spark.createDataFrame([(text,)], "t string").select(nested.parse_document("t", schemas.EVENTS_DOCUMENT).alias("document"))
    row = nested.flatten_events(df).first()
    assert (row.event_name, row.event_sec, row.tags_list, row.match_period, row.team_id, row.pos_orig_x) == ("", 0.0, "[]", "", 5, None)


def match_row(spark, **values):
    return spark.createDataFrame([tuple(values.get(f.name) for f in schemas.MATCHES)], schemas.MATCHES)


def test_match_lookup_precedence(spark):
    df = match_row(spark, wyId=1, gameweek=2, competitionId=3).union(match_row(spark, wyId=2, gameweek=2, competitionId=4))
    ids = lambda **kw: sorted(r.wyId for r in files.lookup_matches(df, **kw).collect())
    assert ids(match=1, gameweek=9) == [1]
    assert ids(gameweek=2) == [1, 2] and ids(gameweek=2, competition=4) == [2]
    assert ids(competition=4) == [1, 2] and ids() == [1, 2]
    with pytest.raises(ValueError, match="No matches"):
        files.require_rows(files.lookup_matches(df, match=5), "No matches found")


def test_match_roundtrip_with_dotted_names(spark):
    df = match_row(spark, wyId=1, winner="10", label="A - B, 1 - 0", **{"team1.teamId": 10, "team1.side": "home", "team2.teamId": 11, "team2.side": "away", "team1.formation.bench": "x"})
    objects = nested.match_objects(df)
    documents = objects.select(F.struct(F.map_from_entries(F.array(F.struct("match_id", "match"))).alias("matches")).alias("document"))
    flat = nested.flatten_matches(documents)
    row = flat.first()
    assert len(flat.columns) == 1 + 13 + 24
    assert (row.match_id, row.team1_teamId, row.team2_side, row["team1_formation.bench"], row.venue) == ("1", 10, "away", "x", "")
    dimension = files.match_dimension_from_matches(df).first()
    assert (dimension.matchId, dimension.team1_id, dimension.team2_side) == ("1", 10, "away")


def test_match_dimension(spark):
    info = spark.createDataFrame([(5, 1, 2, "home", "away")], schemas.MATCH_INFO)
    assert files.match_dimension(info).first().matchId == "5"


def test_completeness_check(spark):
    events = spark.createDataFrame([("1",)], "match_id string")
    matches = spark.createDataFrame([("1",), ("2",)], "match_id string")
    assert nested.require_matches(events, matches.filter("match_id = '1'")) is events
    with pytest.raises(ValueError, match="match 2"):
        nested.require_matches(events, matches)


def over(match, number, **more):
    document = {
        "match_id": match, "team": "A", "players": {"A": ["a1"], "B": ["b1"]}, "toss_winner": "A", "toss_decision": "bat",
        "season": "2007/08", "over_number": number, "winner": "A", "city": "X",
        "deliveries": [{"batter": "a1", "bowler": "b1", "non_striker": "a2", "runs": {"batter": 1, "extras": 0, "total": 1}}],
    }
    return {**document, **more}


def test_over_files(spark, tmp_path):
    for number in (0, 1, 3):
        (tmp_path / f"cricket_5_1_{number}.json").write_text(json.dumps(over(5, number)))
    (tmp_path / "cricket_5_2_0.json").write_text(json.dumps(over(5, 0, team="B"), indent=2))
    (tmp_path / "cricket_5_2_1.json").write_text(json.dumps(messages.SENTINEL))
    overs = files.read_overs(spark, str(tmp_path))
    assert sorted((r.match_id, r.inning, r.over) for r in overs.collect()) == [(5, 1, 0), (5, 1, 1), (5, 1, 3), (5, 2, 0)]
    assert files.lookup_over(overs, 5, 1, 3).first().over_number == 3
    assert files.lookup_over(overs, 5, 1, 7).isEmpty()
    kept = files.up_to_first_gap(overs)
    assert sorted((r.inning, r.over) for r in kept.collect()) == [(1, 0), (1, 1), (2, 0)]


@pytest.mark.parametrize("present, want", [([0, 1, 2], 3), ([1, 2], 0), ([0, 2, 3], 1), (list(range(70)), 70), ([0, 25, -1], 1), ([0, 0, 1, 1, 3], 2)])
def test_overs_before_the_first_gap(spark, present, want):
    df = spark.createDataFrame([(1, 1, o) for o in present], "match_id int, inning int, over int")
    kept = files.up_to_first_gap(df)
    assert sorted({r.over for r in kept.collect()}) == list(range(want))
    assert files.up_to_first_gap(df, size=1).count() == present.count(0)


def test_documents_with_repeated_entries(spark, laps):
    again = laps.unionByName(laps)
    documents = nested.laps_document(again)
    assert {(d.part, d.parts) for d in documents.collect()} == {(0, 1)}
    flat = nested.flatten_laps(documents.select(F.struct("races").alias("document")))
    assert {(int(r.race_id), int(r.driver), r.lap, r.position, r.milliseconds) for r in flat.collect()} == set(LAPS)


def test_select_matches(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "match_id int")
    assert files.select_matches(df, [1, 3]).count() == 2
    assert files.select_matches(df, spark.createDataFrame([(2,)], "match_id int")).count() == 1


def test_blank_strings_leave_numbers_null(spark):
    row = files.blank_strings(spark.createDataFrame([(None, None)], "s string, n int")).first()
    assert (row.s, row.n) == ("", None)


def test_read_table(spark):
    spark.createDataFrame([(1, 2)], "a int, b int").createOrReplaceTempView("some_table")
    assert files.read_table(spark, "some_table", ["b"]).columns == ["b"]
    assert files.read_table(spark, "some_table").columns == ["a", "b"]


def test_event_messages_carry_their_match(spark):
    events = spark.createDataFrame(EVENT_ROWS, schemas.EVENTS)
    documents = nested.events_document(events).select(F.struct("matches").alias("document"))
    sent = [json.loads(r.value) for r in messages.event_messages(documents).collect()]
    assert sorted((m["id"], m["matchId"]) for m in sent) == [(1, "7"), (2, "7"), (3, "8")]
    assert next(m for m in sent if m["id"] == 1)["positions"]["origin"] == {"x": 1.0, "y": 2.0}


def test_list_or_single(spark):
    df = spark.createDataFrame([('{"a": 1}',), ('[{"a": 2}, {"a": 3}]',)], "t string")
    schema = T.StructType([T.StructField("a", T.IntegerType())])
    sent = df.select(F.explode(messages.as_messages(F.col("t"), schema)).alias("m"))
    assert [json.loads(r.m)["a"] for r in sent.collect()] == [1, 2, 3]


def test_malformed_messages_are_set_aside(spark):
    texts = ['{"matchId": "1", "playerId": ""}', "not json", '[{"matchId": "1"}]', f'"{messages.SENTINEL}"', "", None]
    parsed = messages.split_messages(spark.createDataFrame([(t,) for t in texts], "value string"), schemas.EVENT_MESSAGE)
    assert [r.message.matchId for r in messages.accepted(parsed).collect()] == ["1"]
    reasons = [r.reason for r in messages.rejected(parsed).collect()]
    assert len(reasons) == 5 and reasons.count("no data") == 1
