"""Exploration and data-quality aggregates."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from matchflow.functions.columns import literal_map, rounded
from matchflow.operators.running import Count, Total, running
from matchflow.session import materialise


QUARTILES = {0.25: "q25", 0.5: "median", 0.75: "q75"}
SAMPLE_ROWS, LEAST_SAMPLE, SEED = 100_000, 1000, 17
FEW_ROWS = 5_000_000


def null_audit(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Total, non-null and null count per column, from one scan that only counts."""
    names = list(columns or df.columns)
    counts = [F.struct(F.lit(c).alias("column_name"), F.count(F.col(f"`{c}`")).alias("non_null_count")).alias(f"c{i}") for i, c in enumerate(names)]
    long = df.agg(F.count(F.lit(1)).alias("__total"), *counts).select("__total", F.inline(F.array(*[f"c{i}" for i in range(len(names))])))
    return long.select(
        "column_name",
        F.col("__total").alias("total_rows"),
        "non_null_count",
        (F.col("__total") - F.col("non_null_count")).alias("null_count"),
    )


def _brackets(df: DataFrame, values: Sequence[Column], known: Sequence[dict], total: int, sample_rows: int) -> dict[tuple[int, float], tuple[float, float]]:
    """For each column and quantile two values, between which the quantile most likely lies, from a bounded sample.

    They lie five standard deviations of a sample's rank apart from the quantile; a column with a few values in the sample
    gets its whole range.
    """
    share = min(1.0, sample_rows / max(total, 1))
    sample = df.select(*[v.alias(f"v{i}") for i, v in enumerate(values)])
    sample = sample.sample(share, SEED) if share < 1 else sample
    probes: dict[int, list[float]] = {}
    for i, one in enumerate(known):
        if (size := one["count"] * share) >= LEAST_SAMPLE:
            apart = [5 * (q * (1 - q) / size) ** 0.5 for q in QUARTILES]
            probes[i] = [min(1.0, max(0.0, q + sign * d)) for q, d in zip(QUARTILES, apart) for sign in (-1, 1)]
    found = sample.agg(*[F.percentile(f"v{i}", F.lit(p)).alias(f"p{i}") for i, p in probes.items()]).first() if probes else None
    out = {}
    for i, one in enumerate(known):
        at = found[f"p{i}"] if i in probes else None
        for k, q in enumerate(QUARTILES if one["count"] else ()):
            out[i, q] = (at[2 * k], at[2 * k + 1]) if at else (one["min"], one["max"])
    return out


def _quartiles(df: DataFrame, values: Sequence[Column], known: Sequence[dict], total: int, sample_rows: int) -> dict[tuple[int, float], float]:
    """Exact quantiles of the columns, by rank between two bracket values.

    One scan counts what lies below and up to each bracket, which also proves that it holds the ranks that are asked for. A second
    scan counts the distinct values inside, and only these are shuffled. A column whose bracket misses is taken whole, as are
    all columns of a table with fewer than FEW_ROWS rows, where the scans would cost more than they save.
    """
    ranks = {(i, q): (one["count"] - 1) * q for i, one in enumerate(known) if one["count"] for q in QUARTILES}
    if not ranks:
        return {}
    brackets = _brackets(df, values, known, total, sample_rows) if total >= FEW_ROWS else {}
    sums = [F.count(F.when(test, 1)) for (i, _), (low, high) in brackets.items() for test in (values[i] < F.lit(low), values[i] <= F.lit(high))]
    row = df.agg(*[c.alias(f"n{n}") for n, c in enumerate(sums)]).first() if sums else ()
    below = {key: row[2 * n] for n, key in enumerate(brackets) if row[2 * n] <= math.floor(ranks[key]) and math.ceil(ranks[key]) < row[2 * n + 1]}

    whole = sorted({i for i, q in ranks if (i, q) not in below})
    places: dict[tuple[int, float | None], int] = {key: n for n, key in enumerate([*below, *[(i, None) for i in whole]])}
    inside = [F.when(values[i].isNotNull() if q is None else values[i].between(*map(F.lit, brackets[i, q])), F.struct(F.lit(n).alias("__at"), values[i].alias("value"))) for (i, q), n in places.items()]
    long = df.select(F.explode(F.array(*inside)).alias("__e")).where(F.col("__e").isNotNull()).select("__e.*")
    distinct = materialise(long.groupBy("__at", "value").agg(F.count(F.lit(1)).alias("__n")), "bracketed")
    ranked = running(distinct, ["__at"], ["value"], {"__upto": Total("__n")})
    wanted = [(places.get((i, q) if (i, q) in below else (i, None)), i, q, *(int(end(rank)) - below.get((i, q), 0) for end in (math.floor, math.ceil))) for (i, q), rank in ranks.items()]
    asked = df.sparkSession.createDataFrame(wanted, "__at int, i int, q double, low bigint, high bigint")  # three rows per column
    holds = lambda rank: (F.col("__upto") > F.col(rank)) & (F.col("__upto") - F.col("__n") <= F.col(rank))
    picked = ranked.join(F.broadcast(asked), "__at").groupBy("i", "q").agg(*[F.max(F.when(holds(end), F.col("value"))).alias(end) for end in ("low", "high")])
    found = {}
    for r in picked.collect():
        part = ranks[r["i"], r["q"]] % 1
        found[r["i"], r["q"]] = r["low"] if r["low"] == r["high"] else r["low"] + (r["high"] - r["low"]) * part
    return found


def describe_numeric(df: DataFrame, columns: Sequence[str] | None = None, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Count, mean, deviation, minimum, exact quartiles and maximum of numeric columns; one row per column.

    Quartiles interpolate linearly. They are selected by rank inside brackets that a sample of about ``sample_rows`` rows
    proposes and a count proves, so that the result is exact and only the few values inside are shuffled; a table with fewer than
    ``FEW_ROWS`` rows is taken whole. An exact percentile aggregate would gather all distinct values of a column in one task. A column without values has nulls.
    """
    names = list(columns or [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)])
    described: list[Column] = [F.count(F.lit(1)).alias("total")]
    for i, c in enumerate(names):
        value = F.col(f"`{c}`")
        described += [F.count(value).alias(f"count{i}"), F.avg(value).cast("double").alias(f"mean{i}"), F.stddev_samp(value).alias(f"std{i}")]
        described += [F.min(value).cast("double").alias(f"min{i}"), F.max(value).cast("double").alias(f"max{i}")]
    row = df.agg(*described).first()
    known = [{name: row[f"{name}{i}"] for name in ("count", "mean", "std", "min", "max")} for i in range(len(names))]
    values = [F.col(f"`{c}`").cast("double") for c in names]
    quartiles = _quartiles(df, values, known, row["total"], sample_rows)
    rows = [(c, one["count"], one["mean"], one["std"], one["min"], *[quartiles.get((i, q)) for q in QUARTILES], one["max"]) for i, (c, one) in enumerate(zip(names, known))]
    schema = ", ".join(["column_name string, count bigint", *[f"{name} double" for name in ("mean", "std", "min", *QUARTILES.values(), "max")]])
    return df.sparkSession.createDataFrame(rows, schema)


def value_shares(df: DataFrame, value: str, labels: dict | None = None) -> DataFrame:
    """Count of every value and its share of all rows; ``labels`` name the values."""
    counts = df.groupBy(value).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(F.lit(1))).scalar()
    shown = F.coalesce(F.try_element_at(literal_map(labels), F.col(value)), F.col(value).cast("string")) if labels else F.col(value)
    return counts.select(shown.alias(value), "n", (F.col("n") / total).alias("share"))


def stacked(df: DataFrame, columns: Sequence[str], keep: Sequence[str], name: str) -> DataFrame:
    """Stack several columns into one, from a single scan."""
    return df.select(*keep, F.explode(F.array(*columns)).alias(name))


def distinct_per(df: DataFrame, by: str, counted: str, name: str, approximate: bool = False) -> DataFrame:
    """Number of distinct values per group. Spark removes duplicates by both columns first, which
    spreads a hot group."""
    count = F.approx_count_distinct(counted) if approximate else F.countDistinct(counted)
    return df.groupBy(by).agg(count.alias(name))


def top(df: DataFrame, n: int, by: str, *ties: str) -> DataFrame:
    """The ``n`` rows with the largest values; ties are broken by further columns."""
    return df.orderBy(F.col(by).desc(), *ties).limit(n)


def team_matches(df: DataFrame, match: str = "match_id", teams: Sequence[str] = ("team_1", "team_2")) -> DataFrame:
    """Number of matches per team."""
    return distinct_per(stacked(df, teams, [match], "team"), "team", match, "matches")


def per_over(overs: DataFrame, keys: Sequence[str] = ("match_id", "inning")) -> DataFrame:
    """Runs and wickets of each over, from the cumulative columns; the first over keeps its own.

    Rows are unique per (match, inning, over), so a window group is one inning.
    """
    order = Window.partitionBy(*keys).orderBy("over")
    step = lambda c: F.coalesce(F.col(c) - F.lag(c).over(order), F.col(c))
    return overs.withColumns({"runs_per_over": step("cumulative_score"), "wickets_per_over": step("cumulative_wickets")})


def mean_per_inning(overs: DataFrame) -> DataFrame:
    """Mean runs and wickets per over by inning, rounded half-even to two digits."""
    return overs.groupBy("inning").agg(
        rounded(F.avg("runs_per_over")).alias("mean_runs"), rounded(F.avg("wickets_per_over")).alias("mean_wickets")
    )


def mean_by_over(overs: DataFrame, over: int | None = None) -> DataFrame:
    """Mean cumulative score and wickets by inning and over, or at one over."""
    chosen = overs if over is None else overs.filter(F.col("over") == over)
    return chosen.groupBy("inning", "over").agg(
        F.avg("cumulative_score").alias("mean_score"), F.avg("cumulative_wickets").alias("mean_wickets")
    )


def rebuild_group_id(df: DataFrame, starts: Column, order: Sequence[str], name: str = "match_id") -> DataFrame:
    """Number the groups of an ordered feed without an id: a running count of group starts.

    The whole feed is one group here; above the chunk size it is cut along its order.
    """
    return running(df, [], order, {name: Count(starts)})


def distinct_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct()


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)
