import math

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from matchflow import schemas
from matchflow.ml import evaluate, models, split
from matchflow.streaming.commits import CommitLog
from matchflow.streaming.football import read_predictions, read_statistics, start_match_statistics


@pytest.fixture(scope="module")
def result_history(spark):
    rows = spark.range(300).withColumn("match_id", F.col("id") % 60)
    goals = (F.col("id") % 7 - 3).cast("bigint")
    columns = {c: F.lit(0.0) if "time" in c else F.lit(0).cast("bigint") for c in schemas.FOOTBALL_FEATURES}
    columns |= {"goals_diff": goals, "shots_diff": goals * 2, "passes_diff": goals * 3, "possession_time_diff": goals * 4.0}
    result = F.when(goals > 0, "home").when(goals < 0, "away").otherwise("draw")
    return rows.withColumns(columns).withColumn("result", result)


@pytest.fixture(scope="module")
def result_model(result_history):
    return models.train_result_model(result_history, trees=40)


def test_result_model_learns_and_probabilities_sum_to_one(result_history, result_model):
    stats = result_history.withColumns({"event_id": F.col("id").cast("string"), "matchId": F.lit("1"), "eventSec": F.lit(0.0)})
    scored = models.score_results(result_model, stats)
    assert [f.name for f in scored.schema] == [f.name for f in schemas.MATCH_PREDICTIONS]
    rows = scored.join(stats.select("event_id", "result"), "event_id").collect()
    assert all(math.isclose(r.prob_home_win + r.prob_away_win + r.prob_draw, 1.0) for r in rows)
    assert sum(r.predicted_result == r.result for r in rows) / len(rows) > 0.9


def test_saved_model_scores_without_a_label(result_history, result_model, tmp_path):
    result_model.write().overwrite().save(str(tmp_path / "model"))
    again = PipelineModel.load(str(tmp_path / "model"))
    stats = result_history.drop("result").limit(5).withColumns({"event_id": F.lit("e"), "matchId": F.lit("1"), "eventSec": F.lit(0.0)})
    assert models.score_results(again, stats).count() == 5


def test_unseen_class_has_probability_zero(result_history):
    model = models.train_result_model(result_history.filter("result <> 'draw'"), trees=3)
    stats = result_history.limit(3).withColumns({"event_id": F.lit("e"), "matchId": F.lit("1"), "eventSec": F.lit(0.0)})
    assert {r.prob_draw for r in models.score_results(model, stats).collect()} == {0.0}


def test_feature_importance(result_model):
    weights = models.feature_importance(result_model, schemas.FOOTBALL_FEATURES)
    assert {n for n, _ in weights[:4]} == {"goals_diff", "shots_diff", "passes_diff", "possession_time_diff"}
    assert len(weights) == 21
    assert math.isclose(sum(w for _, w in weights), 1.0)


def test_stream_writes_statistics_and_predictions(spark, result_model, tmp_path):
    events = spark.createDataFrame(
        [(str(i), "1", float(i), "Shot", [1801, 101], "home") for i in range(4)],
        "event_id string, matchId string, eventSec double, eventName string, tagsList array<int>, side string",
    )
    events.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    start_match_statistics(
        stream, str(tmp_path / "live"), str(tmp_path / "ck"), score=lambda df: models.score_results(result_model, df)
    ).awaitTermination()
    log = CommitLog(spark, str(tmp_path / "live"))
    assert read_statistics(log).count() == 4
    predicted = read_predictions(log).orderBy("event_sec").collect()
    assert [r.event_sec for r in predicted] == [0.0, 1.0, 2.0, 3.0]
    assert {r.predicted_result for r in predicted} <= {"home", "away", "draw"}


def test_position_model(spark):
    rows = spark.range(400).select(
        (F.col("id") % 20 + 1).alias("lap"), (F.col("id") % 10).alias("driver"), (F.col("id") % 10 + 1).alias("position"),
        *[(F.col("id") % 10 + 1.0).alias(c) for c in schemas.LAP_STATISTICS], (F.col("id") % 10 + 1).alias("final_position"),
    )
    scored = models.train_position_model(rows).transform(rows)
    report = {r.metric_name: r.metric_value for r in evaluate.regression_metrics(scored, "final_position", "prediction").collect()}
    assert report["r2_score"] > 0.95


def test_winner_model_and_unknown_team(spark):
    rows = spark.range(200).select(
        *[((F.col("id") * 3) % 11).cast("double").alias(c) for c in models.WINNER_FEATURES],
        F.concat(F.lit("T"), (F.col("id") % 40).cast("string")).alias("team_1"), F.lit("Z").alias("team_2"),
        (((F.col("id") * 3) % 11) > 5).cast("int").alias("winner"),
    )
    model = models.train_winner_model(rows)
    scored = models.score_winners(model, rows.withColumn("team_1", F.lit("new")))
    assert {r.predicted_winner for r in scored.collect()} == {"new", "Z"}
    right = scored.filter((F.col("predicted_winner") == "Z") == (F.col("winner") == 1)).count()
    assert right > 190


def test_split_keeps_matches_whole(spark):
    df = spark.range(2000).selectExpr("id % 200 as match_id")
    train, test = split.split_by_key(df, "match_id")
    assert train.count() + test.count() == 2000 and train.select("match_id").intersect(test.select("match_id")).isEmpty()
    assert 0.2 < test.count() / 2000 < 0.4
    a, b = split.split_rows(df)
    assert a.count() + b.count() == 2000


def test_classification_metrics(spark):
    rows = [("a", "a", 0.9), ("a", "b", 0.4), ("b", "b", 0.8), ("b", "b", 0.7), ("c", "a", 0.1)]
    df = spark.createDataFrame(rows, "label string, said string, p double")
    got = {r.metric_name: r.metric_value for r in evaluate.classification_metrics(df, "label", "said", F.col("p")).collect()}
    assert got["accuracy"] == pytest.approx(3 / 5)
    assert got["precision"] == pytest.approx((1 / 2 + 2 / 3 + 0) / 3)
    assert got["recall"] == pytest.approx((1 / 2 + 1 + 0) / 3)
    assert got["f1_score"] == pytest.approx((1 / 2 + 4 / 5 + 0) / 3)
    assert got["log_loss"] == pytest.approx(sum(-math.log(r[2]) for r in rows) / 5)


def test_roc_auc_counts_ties_half(spark):
    rows = [(1, 0.9), (1, 0.5), (0, 0.5), (0, 0.1), (1, 0.1)]
    pairs = [(p, n) for y, p in rows if y for z, n in rows if not z]
    want = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p, n in pairs) / len(pairs)
    df = spark.createDataFrame(rows, "y int, p double")
    assert evaluate.roc_auc(df, "y", "p").first().metric_value == pytest.approx(want)
