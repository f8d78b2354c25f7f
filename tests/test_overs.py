import pytest
from pyspark.sql import functions as F

from matchflow import schemas
from matchflow.operators import aggregates, overs


def ball(runs, wickets=None, batter="a1", bowler="b1"):
    kinds = None if wickets is None else [{"player_out": "p", "kind": "bowled"}] * wickets
    return {"batter": batter, "bowler": bowler, "non_striker": "a2", "runs": {"batter": runs, "extras": 0, "total": runs}, "wickets": kinds}


def document(match, team, over, balls, toss=("A", "bat"), winner="B", season="2020", players=None):
    return {
        "match_id": match, "team": team, "players": players or {"A": ["a1", "a2"], "B": [f"b{i}" for i in range(1, 14)]},
        "toss_winner": toss[0], "toss_decision": toss[1], "season": season, "over_number": over, "winner": winner,
        "city": "X", "deliveries": balls,
    }


def frame(spark, documents):
    return spark.createDataFrame(documents, schemas.OVER_DOCUMENT)


@pytest.fixture
def match(spark):
    docs = [
        document(1, "A", 0, [ball(4), ball(1, 1), ball(0, 2, batter="a9")]), document(1, "A", 1, [ball(6, 0)]),
        document(1, "B", 0, [ball(2)]), document(1, "B", 1, []), document(1, "B", 2, [ball(3, 1)]),
    ]
    return frame(spark, docs)


def test_over_rows_follow_the_toss(match):
    rows = {(r.inning, r.over): r for r in overs.document_rows(match, inning=None).collect()}
    assert set(rows) == {(1, 0), (1, 1), (2, 0), (2, 1), (2, 2)}
    first = rows[1, 0]
    assert (first.over_runs, first.over_wickets, first.batter, first.runs_total) == (5, 3, "a9", 0)
    assert (first.team_1, first.team_2, first.winner, first.current_team, first.toss_winner, first.toss_decision) == ("A", "B", 1, 0, 0, 0)
    assert rows[2, 0].current_team == 1
    empty = rows[2, 1]
    assert (empty.over_runs, empty.over_wickets, empty.batter) == (0, 0, None)


def test_toss_winner_that_fields_bats_second(spark):
    row = overs.document_rows(frame(spark, [document(1, "B", 0, [ball(1)], toss=("A", "field"))]), inning=None).first()
    assert (row.team_1, row.inning, row.toss_winner, row.toss_decision) == ("B", 1, 1, 1)


def test_batch_inning_column_decides(spark):
    docs = frame(spark, [document(1, "B", 0, [ball(1)])]).withColumn("inning", F.lit(1))
    row = overs.document_rows(docs).first()
    assert (row.team_1, row.team_2) == ("B", "A")


def test_players_are_cut_and_padded(match):
    row = overs.player_columns(overs.document_rows(match, inning=None)).first()
    assert (row.team_1_player_1, row.team_1_player_3, row.team_1_player_11) == ("a1", "Placeholder 0", "Placeholder 8")
    assert row.team_2_player_11 == "b11" and "team_2_player_12" not in row


def test_features(match):
    got = {(r.inning, r.over): r for r in overs.over_features(overs.document_rows(match, inning=None)).collect()}
    assert [got[k].cumulative_score for k in sorted(got)] == [5, 11, 2, 2, 5]
    assert [got[k].cumulative_wickets for k in sorted(got)] == [3, 3, 0, 0, 1]
    assert [got[k].first_inning_total_score for k in sorted(got)] == [0, 0, 11, 11, 11]
    assert got[2, 2].first_inning_total_wickets == 3 and got[2, 2].first_inning_run_rate == 5.5
    assert got[1, 1].run_rate == 5.5 and got[1, 1].required_run_rate == 0.0
    assert got[2, 2].required_run_rate == pytest.approx((11 - 5) / 17)


def test_required_columns_exist(match):
    rows = overs.over_features(overs.document_rows(match, inning=None))
    assert {f.name for f in schemas.OVER_HISTORY} <= set(rows.columns)


def test_wicket_cap_is_for_show_only(spark):
    docs = [document(1, "A", 0, [ball(0, 8)]), document(1, "A", 1, [ball(0, 8)])]
    rows = overs.document_rows(frame(spark, docs), inning=None)
    assert [r.cumulative_wickets for r in overs.cumulative(rows, 10).orderBy("over").collect()] == [8, 10]
    assert [r.cumulative_wickets for r in overs.cumulative(rows).orderBy("over").collect()] == [8, 16]


def test_inning_summary(match):
    got = {r.inning: r for r in overs.inning_summary(overs.document_rows(match, inning=None)).collect()}
    assert (got[1].total_score, got[1].total_wickets, got[1].run_rate) == (11, 3, 5.5)


def test_roll_up_takes_the_last_delivery(spark):
    rows = [(1, 1, 0, n, n % 3, n == 4) for n in range(6)]
    df = spark.createDataFrame(rows, "match_id int, inning int, over int, id int, runs int, out boolean")
    row = overs.roll_up(df, F.col("runs"), F.col("out"), F.col("id"), {"last": F.col("runs")}).first()
    assert (row.over_runs, row.over_wickets, row.last) == (6, 1, 2)


def test_exploration(match):
    rows = overs.cumulative(overs.document_rows(match, inning=None))
    steps = aggregates.per_over(rows)
    assert {(r.inning, r.over): (r.runs_per_over, r.wickets_per_over) for r in steps.collect()} == {
        (1, 0): (5, 3), (1, 1): (6, 0), (2, 0): (2, 0), (2, 1): (0, 0), (2, 2): (3, 1),
    }
    means = {r.inning: (r.mean_runs, r.mean_wickets) for r in aggregates.mean_per_inning(steps).collect()}
    assert means == {1: (5.5, 1.5), 2: (1.67, 0.33)}
    assert aggregates.mean_by_over(rows, 2).first().mean_score == 5.0
    teams = {r.team: r.matches for r in aggregates.team_matches(rows).collect()}
    assert teams == {"A": 1, "B": 1}


def test_null_audit(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    got = {r.column_name: (r.total_rows, r.non_null_count, r.null_count) for r in aggregates.null_audit(df).collect()}
    assert got == {"a": (3, 2, 1), "b": (3, 1, 2)}


@pytest.mark.parametrize("sample_rows, least", [(3000, 1000), (400, 10), (40, 10)])
def test_quartiles_in_brackets_are_exact(spark, monkeypatch, sample_rows, least):
    """Small samples give wide brackets, tiny ones none or some that miss; the result is the same."""
    monkeypatch.setattr(aggregates, "FEW_ROWS", 0)
    monkeypatch.setattr(aggregates, "LEAST_SAMPLE", least)
    df = spark.range(3000).selectExpr("cast(pow(id % 1009, 2) as double) as a", "cast(id % 7 as int) as ties", "if(id % 5 = 0, null, id * 1.5) as b", "cast(null as double) as none", "if(id = 8, id, null) as one")
    want, got = df.toPandas().astype(float).describe(), {r.column_name: r for r in aggregates.describe_numeric(df, sample_rows=sample_rows).collect()}
    for c in ("a", "ties", "b", "one"):
        assert [got[c].q25, got[c]["median"], got[c].q75] == pytest.approx(list(want[c][4:7]))
    assert got["none"]["count"] == 0 and got["none"].q25 is None


@pytest.mark.parametrize("limit", [10, 20_000_000])
def test_describe_matches_pandas(spark, limit):
    from matchflow.operators.running import ROWS_PER_CHUNK_CONF

    pdf = spark.range(97).selectExpr("cast((id * 37) % 23 as int) as a", "if(id % 5 = 0, null, id * 1.5) as b").toPandas()
    pdf["b"] = pdf["b"].astype(float)
    spark.conf.set(ROWS_PER_CHUNK_CONF, str(limit))
    try:
        df = spark.range(97).selectExpr("cast((id * 37) % 23 as int) as a", "cast(if(id % 5 = 0, null, id * 1.5) as double) as b")
        got = {r.column_name: r for r in aggregates.describe_numeric(df).collect()}
    finally:
        spark.conf.unset(ROWS_PER_CHUNK_CONF)
    want = pdf.describe()
    for c in ("a", "b"):
        row = got[c]
        assert list(want[c]) == pytest.approx([row["count"], row["mean"], row["std"], row["min"], row.q25, row["median"], row.q75, row["max"]])


def test_value_shares_name_the_value_not_its_rank(spark):
    df = spark.createDataFrame([(0,), (0,), (0,), (1,)], "toss int")
    got = {r.toss: (r.n, r.share) for r in aggregates.value_shares(df, "toss", {0: "Bat", 1: "Field"}).collect()}
    assert got == {"Bat": (3, 0.75), "Field": (1, 0.25)}


def test_top_breaks_ties(spark):
    df = spark.createDataFrame([("b", 2), ("a", 2), ("c", 5)], "team string, n int")
    assert [r.team for r in aggregates.top(df, 2, "n", "team").collect()] == ["c", "a"]


def test_rebuild_group_id(spark):
    df = spark.createDataFrame([(i, i in (0, 4, 9)) for i in range(12)], "seq int, first boolean")
    got = [r.match_id for r in aggregates.rebuild_group_id(df, F.col("first"), ["seq"]).orderBy("seq").collect()]
    assert got == [1] * 4 + [2] * 5 + [3] * 3
