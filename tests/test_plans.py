"""The three pipelines end to end on landed files."""

import json
import random

import pytest
from pyspark.sql import functions as F

from matchflow import schemas
from matchflow.ml import models
from matchflow.plans import catalog, cricket, football, formula
from matchflow.sources import messages
from matchflow.streaming.commits import CommitLog


@pytest.fixture
def database(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS plans_test")
    yield "plans_test"
    spark.sql("DROP DATABASE plans_test CASCADE")


def side(team, where):
    return {"teamId": team, "side": where, "formation.bench": "b"}


def test_football(spark, tmp_path, database):
    rnd = random.Random(4)
    matches, folder = {}, tmp_path / "events"
    folder.mkdir()
    for match in range(1, 13):
        winner = [10 * match, 10 * match + 1, 0][match % 3]
        matches[match] = {
            "gameweek": 1 + match % 2, "competitionId": 5, "winner": winner,
            "team1": side(10 * match, "home"), "team2": side(10 * match + 1, "away"),
        }
        events = {
            str(i): {
                "eventName": rnd.choice(["Shot", "Pass", "Foul", "Duel"]), "teamId": winner or 10 * match + i % 2,
                "matchPeriod": "1H" if i < 20 else "2H", "eventSec": float(i), "tagsList": rnd.choice(["[101, 1801]", "[703]", ""]),
            }
            for i in range(40)
        }
        (folder / f"{match}.json").write_text(json.dumps({"matches": {match: {"events": events}}}))
    (tmp_path / "matches.json").write_text(json.dumps({"matches": matches}))
    tags = spark.createDataFrame([(101, "Goal"), (1801, "accurate"), (703, "won")], schemas.TAG_NAMES)
    table = f"{database}.football"
    for week in (1, 2):
        football.run_batch(spark, str(tmp_path / "matches.json"), str(folder), tags, table, gameweek=week, competition=5)
    rows = spark.table(table)
    assert rows.count() == 12 * 40 and rows.columns == ["match_id", "event_sec", "result", *schemas.FOOTBALL_FEATURES]
    assert {r.result for r in rows.select("result").distinct().collect()} == {"home", "away", "draw"}
    assert rows.agg(F.max("event_sec")).first()[0] == 19 + 39
    with pytest.raises(ValueError, match="No matches"):
        football.run_batch(spark, str(tmp_path / "matches.json"), str(folder), tags, table, gameweek=9)

    model = models.train_result_model(rows, trees=5)
    sent = [json.dumps({"matchId": 1, "teamId": 10, "eventName": "Shot", "eventSec": 1.0 * i, "matchPeriod": "1H", "tagsList": "[101, 1801]"}) for i in range(3)]
    (tmp_path / "live").mkdir()
    (tmp_path / "live" / "a.json").write_text("\n".join(sent))
    dimension = spark.createDataFrame([("1", 10, 11, "home", "away")], "matchId string, team1_id long, team2_id long, team1_side string, team2_side string")
    football.start_live(
        messages.read_message_files(spark, str(tmp_path / "live")), dimension, str(tmp_path / "s"), str(tmp_path / "c"), model
    ).awaitTermination()
    log = CommitLog(spark, str(tmp_path / "s"))
    assert [r.home_goals for r in log.read("statistics").orderBy("eventSec").collect()] == [1, 2, 3]
    assert log.read("predictions").count() == 3


def test_formula(spark, tmp_path, database):
    laps = {
        str(lap): {"drivers": {str(d): {"position": 1 + (d + lap) % 5, "milliseconds": 90_000 + lap} for d in range(5)}}
        for lap in range(1, 9)
    }
    (tmp_path / "race.json").write_text(json.dumps({"races": {"7": {"laps": laps}}}))
    formula.run_batch(spark, str(tmp_path / "race.json"), f"{database}.laps", race=7)
    rows = spark.table(f"{database}.laps")
    assert rows.count() == 5 * 7 and set(rows.columns) == {*schemas.LAP_FEATURES, "final_position"}
    scored = formula.train(rows).transform(rows)
    assert scored.count() == 35
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "m.json").write_text(json.dumps({"races": {"7": {"laps": {"1": laps["1"]}}}}))
    stream = messages.read_message_files(spark, str(tmp_path / "in"))
    formula.start_live(stream, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    assert CommitLog(spark, str(tmp_path / "out")).read("statistics").count() == 5


def test_cricket(spark, tmp_path, database):
    rnd = random.Random(1)
    folder = tmp_path / "overs"
    folder.mkdir()
    for match in range(1, 9):
        strong = match % 2
        for inning in (1, 2):
            for over in range(20):
                if (match, inning, over) == (3, 2, 10):
                    continue
                runs = rnd.randint(6, 12) if (inning == 2) == bool(strong) else rnd.randint(0, 5)
                ball = {"batter": "x", "bowler": "y", "non_striker": "z", "runs": {"batter": runs, "extras": 0, "total": runs}}
                team = ["Reds", "Blues"][inning - 1]
                (folder / f"cricket_{match}_{inning}_{over}.json").write_text(json.dumps({
                    "match_id": match, "team": team, "players": {"Reds": ["r"], "Blues": ["b"]}, "toss_winner": "Reds",
                    "toss_decision": "bat", "season": "2009/10", "over_number": over, "winner": "Blues" if strong else "Reds",
                    "city": "X", "deliveries": [] if over == 5 else [ball],
                }))
    table = f"{database}.overs"
    cricket.run_batch(spark, str(folder), table, "TRUNCATE", matches=[1, 2, 3, 4, 5, 6])
    rows = spark.table(table)
    assert rows.count() == 6 * 40 - 10 and len(rows.columns) == 22 + 22
    assert rows.filter("team_1 <> 'Reds' or season <> 2009.5 or team_1_player_2 <> 'Placeholder 0'").isEmpty()
    model = cricket.train(rows, str(tmp_path / "metrics"))
    report = {r.metric_name: r.metric_value for r in spark.read.parquet(str(tmp_path / "metrics")).collect()}
    assert set(report) == {"accuracy", "precision", "recall", "f1_score", "log_loss", "roc_auc"} and report["accuracy"] > 0.8

    (tmp_path / "in").mkdir()
    texts = [(folder / f"cricket_7_1_{o}.json").read_text() for o in range(4)]
    (tmp_path / "in" / "m.json").write_text("\n".join(texts))
    stream = messages.read_message_files(spark, str(tmp_path / "in"))
    cricket.start_live(stream, str(tmp_path / "out"), str(tmp_path / "ck"), model).awaitTermination()
    out = CommitLog(spark, str(tmp_path / "out")).read("statistics").drop("batch_id")
    assert set(out.columns) == {f.name for f in schemas.OVER_STREAM_ROW}
    assert out.count() == 4 and {r.predicted_winner for r in out.collect()} <= {"Reds", "Blues"}


def test_a_landed_part_has_a_file_for_every_core(spark, tmp_path, monkeypatch):
    """A part of few bytes in one file would be worked off by one task."""
    monkeypatch.setattr(catalog, "fresh_path", lambda spark, name: str(tmp_path / name))
    rows, begun = spark.range(400).coalesce(1), []

    class Done:
        def awaitTermination(self):
            begun.append(len(list((tmp_path / "landed").rglob("*.parquet"))))

    catalog._replayed(spark, [rows, rows], lambda stream: Done())
    cores = spark.sparkContext.defaultParallelism
    assert cores > 1 and begun == [cores, 2 * cores]
    assert spark.read.parquet(str(tmp_path / "landed")).count() == 800
