"""Overs: rolling deliveries up, cumulative scores, first-inning carry and model features.

Rows are unique per (match, inning, over) after the roll-up, and an inning has at most 20 overs,
so a window over one match holds at most 40 rows, however many deliveries there were. Only the
roll-up sees raw rows, and it combines map-side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from matchflow.functions import cricket
from matchflow.functions.columns import flag, numbered_columns, other_key, padded, season_number
from matchflow.schemas import PLAYERS

def document_rows(overs: DataFrame, inning: str | None = "inning", season_mode: str = "stream") -> DataFrame:
    """One row per over document: runs and wickets of the over, its last delivery, its match facts.

    ``team_1`` bats first. With an ``inning`` column it is the batting team of inning 1; without
    one it follows from the toss, and so does the inning.
    """
    team, players = F.col("team"), F.col("players")
    if inning:
        number = F.col(inning).cast("int")
        first = F.when(number == 1, team).otherwise(other_key(players, team))
    else:
        first = cricket.batting_first(F.col("toss_winner"), F.col("toss_decision"), players)
        number = F.when(team == first, F.lit(1)).otherwise(F.lit(2))
    deliveries = F.col("deliveries")
    rows = overs.withColumns({"__inning": number, "team_1": first})
    rows = rows.withColumn("team_2", other_key("players", "team_1"))
    return rows.select(
        "match_id",
        F.col("__inning").alias("inning"),
        F.col("over_number").cast("int").alias("over"),
        *cricket.last_delivery(deliveries),
        cricket.runs_in_over(deliveries).alias("over_runs"),
        cricket.wickets_in_over(deliveries).alias("over_wickets"),
        flag(F.col("winner") == F.col("team_2")).alias("winner"),
        cricket.chose_field(F.col("toss_decision")).alias("toss_decision"),
        cricket.is_second_team(F.col("toss_winner"), F.col("team_2")).alias("toss_winner"),
        season_number("season", season_mode).alias("season"),
        cricket.is_second_team(team, F.col("team_2")).alias("current_team"),
        "team_1",
        "team_2",
        "players",
    )


def player_columns(rows: DataFrame, size: int = PLAYERS) -> DataFrame:
    """Both teams' players as ``team_1_player_1`` .. ``team_2_player_11``, short teams padded."""
    lists = {n: padded(F.try_element_at("players", F.col(f"team_{n}")), size) for n in (1, 2)}
    columns = [c for n, players in lists.items() for c in numbered_columns(players, size, f"team_{n}_player_")]
    return rows.select("*", *columns).drop("players")


def roll_up(deliveries: DataFrame, runs: Column, wicket: Column, order: Column, last: dict[str, Column]) -> DataFrame:
    """One row per (match, inning, over) from one row per delivery; the ``last`` values are those
    of the delivery that is last in ``order``. Deliveries are only counted and compared, never
    gathered, so an over with very many of them combines map-side."""
    return deliveries.groupBy("match_id", "inning", "over").agg(
        F.sum(runs).cast("bigint").alias("over_runs"),
        F.count_if(wicket).cast("bigint").alias("over_wickets"),
        *[F.max_by(value, order).alias(name) for name, value in last.items()],
    )


def cumulative(overs: DataFrame, wicket_cap: int | None = None) -> DataFrame:
    """Add score and wickets so far within the inning."""
    so_far = (
        Window.partitionBy("match_id", "inning").orderBy("over").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    wickets = F.sum("over_wickets").over(so_far)
    if wicket_cap is not None:
        wickets = F.least(wickets, F.lit(wicket_cap))
    return overs.withColumns(
        {"cumulative_score": F.sum("over_runs").over(so_far), "cumulative_wickets": wickets}
    )


def inning_summary(overs: DataFrame) -> DataFrame:
    """Total score, wickets, last over and run rate of every inning."""
    return overs.groupBy("match_id", "inning").agg(
        F.sum("over_runs").alias("total_score"),
        F.sum("over_wickets").alias("total_wickets"),
        F.max("over").alias("last_over"),
        (F.sum("over_runs") / (F.max("over") + 1)).alias("run_rate"),
    )


def with_first_inning(overs: DataFrame, mode: str = "overs") -> DataFrame:
    """Carry the first inning's totals to the rows of the second; 0 in the first inning."""
    match = Window.partitionBy("match_id")
    first = lambda value: F.when(F.col("inning") == 1, value)
    totals = overs.withColumns(
        {
            "__score": F.coalesce(F.sum(first(F.col("over_runs"))).over(match), F.lit(0)),
            "__wickets": F.coalesce(F.sum(first(F.col("over_wickets"))).over(match), F.lit(0)),
            "__last_over": F.max(first(F.col("over"))).over(match),
        }
    )
    second = F.col("inning") == 2
    rate = cricket.first_inning_rate(mode, F.col("__score"), F.col("__wickets"), F.col("__last_over"))
    return totals.withColumns(
        {
            "first_inning_total_score": F.when(second, F.col("__score")).otherwise(F.lit(0)),
            "first_inning_total_wickets": F.when(second, F.col("__wickets")).otherwise(F.lit(0)),
            "first_inning_run_rate": F.when(second, rate).otherwise(F.lit(0.0)),
        }
    ).drop("__score", "__wickets", "__last_over")


def with_rates(overs: DataFrame) -> DataFrame:
    """Add the run rate and the rate that the second inning still requires."""
    score, over = F.col("cumulative_score"), F.col("over")
    return overs.withColumns(
        {
            "run_rate": cricket.run_rate(score, over),
            "required_run_rate": cricket.required_run_rate(
                F.col("inning"), F.col("first_inning_total_score"), score, over
            ),
        }
    )


def over_features(overs: DataFrame, mode: str = "overs", wicket_cap: int | None = None) -> DataFrame:
    """Cumulative score, first-inning carry and rates for unique (match, inning, over) rows.

    All windows are over one match or finer, so one shuffle by match serves them.
    """
    by_match = overs.repartition("match_id")
    return with_rates(with_first_inning(cumulative(by_match, wicket_cap), mode))
