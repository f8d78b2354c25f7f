import math
import random
import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from matchflow.operators.running import (
    CHUNK,
    Count,
    High,
    Low,
    Mean,
    Previous,
    RollingMean,
    Std,
    Total,
    advance,
    cut,
    has_hot_groups,
    hot_cuts,
    running,
)

KEYS, ORDER = ["k"], ["t"]


def stats():
    return {
        "n": Count(),
        "big": Count(F.col("v") > 5),
        "total": Total("v"),
        "mean": Mean("v"),
        "std": Std("v"),
        "pop": Std("v", 0),
        "low": Low("v"),
        "high": High("v"),
        "roll": RollingMean("v", 5),
        "prev": Previous("v"),
    }


def brute(rows):
    groups, out = {}, {}
    for k, t, v in sorted(rows, key=lambda r: r[1]):
        seen = groups.setdefault(k, [])
        prev = seen[-1] if seen else None
        seen.append(v)
        out[k, t] = (
            len(seen), sum(x > 5 for x in seen), sum(seen), statistics.fmean(seen),
            statistics.stdev(seen) if len(seen) > 1 else None, statistics.pstdev(seen),
            min(seen), max(seen), statistics.fmean(seen[-5:]), prev,
        )
    return out


def check(df, rows):
    want = brute(rows)
    got = {(r.k, r.t): tuple(r[n] for n in stats()) for r in df.collect()}
    assert got.keys() == want.keys()
    for key, values in want.items():
        for a, b in zip(got[key], values):
            assert (a is None) == (b is None), key
            assert a is None or math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9), (key, got[key], values)


def sample(n=400, hot=7, seed=1):
    rnd = random.Random(seed)
    return [(rnd.choice([hot, hot, None, *range(20)]), t, rnd.randint(0, 9)) for t in rnd.sample(range(10 * n), n)]


SCHEMA = "k int, t int, v int"


@pytest.mark.parametrize("limit", [17, 10_000])
def test_running_equals_brute_force_with_and_without_hot_groups(spark, limit):
    rows = sample()
    check(running(spark.createDataFrame(rows, SCHEMA), KEYS, ORDER, stats(), limit=limit), rows)


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from([1, 1, 1, 2, None]), st.integers(0, 9)), min_size=1, max_size=40), st.integers(1, 9))
def test_any_small_table_and_chunk_size(spark, pairs, limit):
    rows = [(k, t, v) for t, (k, v) in enumerate(pairs)]
    check(running(spark.createDataFrame(rows, SCHEMA), KEYS, ORDER, stats(), limit=limit), rows)


@pytest.mark.parametrize("limit", [20, 10_000])
def test_state_is_carried_between_batches(spark, limit):
    rows = sorted(sample(), key=lambda r: r[1])
    out, state = None, None
    for part in (rows[:90], rows[90:93], rows[93:]):
        df = spark.createDataFrame(part, SCHEMA)
        now = running(df, KEYS, ORDER, stats(), initial=state, limit=limit)
        state = advance(df, KEYS, ORDER, stats(), state)
        out = now if out is None else out.unionByName(now)
    check(out, rows)


def test_peers_see_the_same_totals(spark):
    rows = [(1, t // 4, 1) for t in range(40)]
    for limit in (3, 1000):
        out = running(spark.createDataFrame(rows, SCHEMA), KEYS, ORDER, {"n": Count()}, peers=True, limit=limit)
        assert sorted((r.t, r.n) for r in out.collect()) == sorted((t // 4, 4 * (t // 4 + 1)) for t in range(40))


def test_whole_table_as_one_group(spark):
    df = spark.range(500).withColumn("start", F.col("id") % 7 == 0)
    for limit in (40, 10_000):
        out = running(df, [], ["id"], {"group": Count("start")}, limit=limit)
        assert out.columns == ["id", "start", "group"]
        assert all(r.group == r.id // 7 + 1 for r in out.collect())


@pytest.mark.parametrize("kind", ["date", "timestamp", "timestamp_ntz", "double", "decimal(10,2)"])
def test_order_column_types(spark, kind):
    base = "date_add(date'2024-01-01', cast(id as int))" if kind not in ("double", "decimal(10,2)") else "id"
    df = spark.range(60).selectExpr("1 as k", f"cast({base} as {kind}) as t", "cast(id as int) as v")
    out = running(df, KEYS, ORDER, {"n": Count()}, limit=7)
    assert all(r.n == r.v + 1 for r in out.collect())


def test_chunks_are_balanced_ordered_and_bounded(spark):
    df = spark.range(10_000).selectExpr("1 as k", "id as t").unionByName(spark.range(50).selectExpr("2 as k", "id as t"))
    cuts = hot_cuts(df, KEYS, ORDER, 500)
    assert [r.k for r in cuts.collect()] == [1]
    sizes = cut(df, KEYS, ORDER, cuts).groupBy("k", CHUNK).agg(F.count("*").alias("n"), F.min("t").alias("lo"), F.max("t").alias("hi"))
    hot = sorted((r[CHUNK], r.lo, r.hi, r.n) for r in sizes.filter("k = 1").collect())
    assert len(hot) == 20 and max(n for *_, n in hot) < 520
    assert all(a[2] < b[1] for a, b in zip(hot, hot[1:]))
    assert [r[CHUNK] for r in sizes.filter("k = 2").collect()] == [None]


def test_hot_group_detection(spark):
    df = spark.range(100).selectExpr("id % 2 as k", "id as t")
    assert has_hot_groups(df, KEYS, 49) and not has_hot_groups(df, KEYS, 50)
    assert hot_cuts(df, KEYS, ORDER, 50) is None


def test_large_values_keep_their_deviation(spark):
    df = spark.range(300).selectExpr("1 as k", "id as t", "1e9 + (id % 2) as v")
    out = running(df, KEYS, ORDER, {"sd": Std("v", 0)}, limit=20).orderBy("t").collect()
    assert all(math.isclose(r.sd, 0.5, rel_tol=1e-4) for r in out[1::2])


def test_hot_plan_never_windows_by_the_key_alone(spark, capsys):
    df = spark.createDataFrame([(1, t, 1) for t in range(100)], SCHEMA)
    running(df, KEYS, ORDER, {"n": Count()}, limit=10).explain()
    plan = capsys.readouterr().out
    assert "hashpartitioning(k" in plan and "__chunk" in plan


def tied_rows():
    """One time holds a third of the group, and one row is there a hundred times."""
    return [(1, t if t % 3 else 50, t) for t in range(300)] + [(1, 120, 1000)] * 100 + [(2, 5, 1)] * 3


def test_hot_ties_and_copies_are_cut_too(spark):
    df = spark.createDataFrame(tied_rows(), "k int, t int, v int")
    order, limit = ["t", "v"], 20
    chunked = cut(df, KEYS, order, hot_cuts(df, KEYS, order, limit), limit)
    sizes = [r.n for r in chunked.groupBy("k", CHUNK).agg(F.count("*").alias("n")).collect()]
    assert max(sizes) <= 3 * limit and sum(sizes) == 403
    out = running(df, KEYS, order, {"n": Count(), "total": Total("v"), "prev": Previous("v")}, limit=limit)
    assert out.columns == ["k", "t", "v", "n", "total", "prev"]
    got, want = [tuple(r) for r in out.collect()], []
    for k in (1, 2):
        rows = sorted(r for r in tied_rows() if r[0] == k)
        want += [(*r, i + 1, sum(x[2] for x in rows[: i + 1]), rows[i - 1][2] if i else None) for i, r in enumerate(rows)]
    assert sorted(got, key=str) == sorted(want, key=str)
