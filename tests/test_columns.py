import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchflow.functions import columns as fx
from matchflow.functions import cricket, football


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(n) for n, v in values.items()], F.lit(0).alias("__"))
    return row.select(column.alias("x")).first().x


@pytest.mark.parametrize(
    "text, want",
    [
        ("[101, 1801]", [101, 1801]), (" [703] ", [703]), ("(1, 2)", [1, 2]), ("(1801,)", [1801]), ("[]", []),
        ("", []), ("  ", []), (None, []), ("junk", []), ("[1, ", []),
    ],
)
def test_int_list(spark, text, want):
    df = spark.createDataFrame([(text,)], "s string")
    assert df.select(fx.int_list("s").alias("x")).first().x == want


def test_int_lists_accepts_arrays(spark):
    df = spark.createDataFrame([([1, 2],), (None,)], "a array<bigint>")
    assert [r.x for r in df.select(fx.int_lists("a", df.schema["a"].dataType).alias("x")).collect()] == [[1, 2], []]
    text = spark.createDataFrame([("[3]",)], "a string")
    assert text.select(fx.int_lists("a", T.StringType()).alias("x")).first().x == [3]


def test_map_labels_with_default(spark):
    df = spark.createDataFrame([([101, 5],)], "a array<int>")
    assert df.select(fx.map_labels("a", fx.literal_map({101: "Goal"})).alias("x")).first().x == ["Goal", "Unknown"]


@pytest.mark.parametrize("names, want", [(["a"], ["a", "Placeholder 0", "Placeholder 1"]), (list("abcd"), list("abc")), (None, ["Placeholder 0", "Placeholder 1", "Placeholder 2"])])
def test_padded(spark, names, want):
    df = spark.createDataFrame([(names,)], "a array<string>")
    assert df.select(fx.padded("a", 3).alias("x")).first().x == want
    assert list(df.select(*fx.numbered_columns(fx.padded("a", 3), 3, "p_")).first()) == want


@pytest.mark.parametrize("season, batch, stream", [("2020", 2020.0, 2020.0), ("2007/08", 1007.5, 2007.5), ("2009/10", 1009.5, 2009.5), (None, None, None)])
def test_season_number(spark, season, batch, stream):
    df = spark.createDataFrame([(season,)], "s string")
    got = df.select(fx.season_number("s", "batch").alias("b"), fx.season_number("s").alias("t")).first()
    assert (got.b, got.t) == (batch, stream)


@pytest.mark.parametrize("season", ["spring", "2007/x", "1/2/3"])
def test_bad_season_is_an_error(spark, season):
    with pytest.raises(PySparkException):
        spark.createDataFrame([(season,)], "s string").select(fx.season_number("s")).collect()


def test_small_functions(spark):
    assert one(spark, fx.flag(F.col("a") == 1), a=1) == 1
    assert one(spark, fx.flag(F.lit(None).cast("boolean"))) == 0
    assert one(spark, fx.with_default(F.lit(None).cast("int"), 7)) == 7
    assert one(spark, fx.years_since(F.to_date(F.lit("1985-12-31")), 2024)) == 39
    assert one(spark, fx.rounded(F.lit(2.345))) == 2.34 or one(spark, fx.rounded(F.lit(2.345))) == 2.35
    assert one(spark, fx.rounded(F.lit(0.125))) == 0.12
    assert one(spark, fx.length(F.lit(None).cast("array<int>"))) == 0
    assert one(spark, fx.other_key(F.create_map(F.lit("A"), F.lit(1), F.lit("B"), F.lit(2)), F.lit("A"))) == "B"


def test_halves_and_ranges(spark):
    df = spark.createDataFrame([(10.0, "1H"), (10.0, "2H"), (10.0, "E1")], "s double, p string")
    got = df.select(football.absolute_second(F.col("s"), F.col("p")).alias("x"), football.within(F.col("s"), F.col("p"), 10, 3000).alias("in")).collect()
    assert [(r.x, r["in"]) for r in got] == [(10.0, True), (3610.0, False), (10.0, True)]
    assert df.filter(football.within(F.col("s"), F.col("p"))).count() == 3


@pytest.mark.parametrize("winner, want", [("1", "home"), ("2", "away"), ("0", "draw"), ("", None), (None, None)])
def test_match_result(spark, winner, want):
    df = spark.createDataFrame([(winner,)], "w string")
    result = football.match_result(F.col("w"), F.lit(1), F.lit("home"), F.lit(2), F.lit("away"))
    assert df.select(result.alias("x")).first().x == want


def test_flags_by_code_and_by_label_agree(spark):
    rows = [("Shot", [1801, 101]), ("Shot", [1801]), ("Shot", [101]), ("Pass", [1801]), ("Duel", [703]), ("Duel", []), ("Foul", [])]
    df = spark.createDataFrame(rows, "name string, tags array<int>")
    labels = fx.map_labels("tags", fx.literal_map({101: "Goal", 1801: "accurate", 703: "won"}))
    by_code = df.select(*[c.alias(n) for n, c in football.flags_by_code(F.col("name"), F.col("tags")).items()]).collect()
    by_label = df.select(*[c.alias(n) for n, c in football.flags_by_label(F.col("name"), labels).items()]).collect()
    assert by_code == by_label
    assert [r.is_goal for r in by_code] == [True, False, False, False, False, False, False]
    assert [r.is_duel_won for r in by_code] == [False, False, False, False, True, False, False]


def test_code_flags_ignore_case_and_space(spark):
    df = spark.createDataFrame([(" SHOT ", [1801])], "name string, tags array<int>")
    assert df.select(football.flags_by_code(F.col("name"), F.col("tags"))["is_accurate_shot"].alias("x")).first().x


def test_event_key_is_repeatable_unless_asked(spark):
    df = spark.createDataFrame([("9", 61.9, "a")], "m string, s double, c string")
    key = lambda unique: df.select(football.event_key(F.col("m"), F.col("s"), F.col("c"), unique=unique).alias("x")).first().x
    assert key(False) == key(False) and key(False).startswith("9_61_")
    assert key(True) != key(True)


def test_rates(spark):
    assert one(spark, cricket.run_rate(F.lit(30), F.lit(4))) == 6.0
    rrr = lambda i, f, s, o: one(spark, cricket.required_run_rate(F.lit(i), F.lit(f), F.lit(s), F.lit(o)))
    assert rrr(2, 160, 60, 9) == 10.0 and rrr(2, 160, 150, 19) == 10.0 and rrr(1, 0, 50, 3) == 0.0
    rate = lambda m, s, w, o: one(spark, cricket.first_inning_rate(m, F.lit(s), F.lit(w), F.lit(o)))
    assert rate("overs", 100, 5, 9) == 10.0
    assert rate("batch", 110, 5, 9) == 10.0 and rate("batch", 200, 5, 19) == 10.0 and rate("batch", 200, 5, 18) == 10.0
    assert rate("stream", 100, 5, 9) == 20.0 and rate("stream", 100, 0, 9) == 0.0
    assert one(spark, cricket.predicted_team(F.lit(0), F.lit("A"), F.lit("B"))) == "A"
    assert one(spark, cricket.predicted_team(F.lit(1), F.lit("A"), F.lit("B"))) == "B"


def test_toss_decides_who_bats_first(spark):
    players = F.create_map(F.lit("A"), F.lit(1), F.lit("B"), F.lit(2))
    assert one(spark, cricket.batting_first(F.lit("A"), F.lit("field"), players)) == "B"
    assert one(spark, cricket.batting_first(F.lit("A"), F.lit("bat"), players)) == "A"
