import datetime
import statistics

import pytest

from matchflow.operators import joins
from matchflow.operators.laps import final_positions, lap_features, position_statistics
from matchflow.operators.running import ROWS_PER_CHUNK_CONF, running

# driver 1 drives four laps, 2 five, 3 seven, 4 one; driver 5 misses a lap; driver 1 also drives race 2
PLACES = {(1, 1): [3, 2, 2, 1], (1, 2): [1, 3, 1, 2, 4], (1, 3): [7, 6, 5, 4, 3, 2, 1], (1, 4): [9], (2, 1): [8, 8]}
ROWS = [(race, driver, lap, p, 1000 * p) for (race, driver), ps in PLACES.items() for lap, p in enumerate(ps, 1)]
ROWS += [(1, 5, 1, 5, 1), (1, 5, 3, 6, 1)]
SCHEMA = "race_id int, driver int, lap int, position int, milliseconds long"


@pytest.fixture
def laps(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_features(spark, laps):
    got = {(r.race_id, r.driver, r.lap): r for r in lap_features(laps).collect()}
    assert (1, 4, 1) not in got and (1, 1, 1) not in got  # one lap has no sample deviation
    assert len(got) == len(ROWS) - 6
    for (race, driver), places in PLACES.items():
        for lap in range(2, len(places) + 1):
            row, seen = got[race, driver, lap], places[:lap]
            assert row.mean_position_up_to_lap == pytest.approx(statistics.fmean(seen))
            assert row.std_position_up_to_lap == pytest.approx(statistics.stdev(seen))
            assert row.min_position_up_to_lap == min(seen)
            assert row.last_5_laps_mean_position == pytest.approx(statistics.fmean(seen[-5:]))
            assert row.final_position == places[-1]
    assert got[1, 5, 3].final_position == 6


def test_hot_driver_gives_the_same(spark, laps):
    flat = lambda df: sorted(tuple(round(v, 9) for v in r) for r in df.collect())
    columns, plain = lap_features(laps).columns, flat(lap_features(laps))
    spark.conf.set(ROWS_PER_CHUNK_CONF, "3")
    try:
        assert flat(lap_features(laps).select(columns)) == plain
    finally:
        spark.conf.unset(ROWS_PER_CHUNK_CONF)


def test_population_deviation_starts_at_zero(laps):
    out = running(laps, ["race_id", "driver"], ["lap"], position_statistics(ddof=0)).filter("lap = 1").collect()
    assert all(r.std_position_up_to_lap == 0.0 for r in out)
    assert lap_features(laps, complete_only=False).count() == len(ROWS)


def test_final_positions(laps):
    got = {(r.race_id, r.driver): r.final_position for r in final_positions(laps).collect()}
    assert got == {**{k: v[-1] for k, v in PLACES.items()}, (1, 5): 6}


def test_enrichment(spark, laps):
    drivers = spark.createDataFrame([(1, datetime.date(1985, 1, 7)), (1, datetime.date(1985, 1, 7)), (2, datetime.date(1990, 12, 31))], "driverId int, dob date")
    ages = joins.enrich_age(laps, drivers, 2024)
    assert ages.count() == len(ROWS)
    assert {(r.driver, r.age) for r in ages.collect()} == {(1, 39), (2, 34), (3, None), (4, None), (5, None)}
    races = spark.createDataFrame([(1, "x", "d", 77)], "raceId int, name string, date string, circuitId int")
    assert {(r.race_id, r.circuitId) for r in joins.enrich_circuit(laps, races).collect()} == {(1, 77), (2, None)}


def test_one_shuffle(laps, capsys):
    lap_features(laps).explain()
    assert capsys.readouterr().out.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("chunk", [None, "20"])
def test_null_keys_stay_when_hot(spark, chunk):
    rows = [(1 if lap > 10 else None, 7, lap, lap % 5) for lap in range(60)]
    df = spark.createDataFrame(rows, "race_id int, driver int, lap int, position int")
    if chunk:
        spark.conf.set(ROWS_PER_CHUNK_CONF, chunk)
    try:
        out = lap_features(df, complete_only=False).collect()
    finally:
        spark.conf.unset(ROWS_PER_CHUNK_CONF)
    assert len(out) == 60 and {r.final_position for r in out if r.race_id is None} == {0}
