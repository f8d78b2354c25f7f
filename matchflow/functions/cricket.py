"""Column functions of the cricket domain."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from matchflow.functions.columns import flag, length, other_key

OVERS = 20
MAX_WICKETS = 10


def runs_in_over(deliveries: Column) -> Column:
    return F.aggregate(
        F.coalesce(deliveries, F.array()), F.lit(0), lambda a, d: a + F.coalesce(d["runs"]["total"], F.lit(0))
    )


def wickets_in_over(deliveries: Column) -> Column:
    return F.aggregate(F.coalesce(deliveries, F.array()), F.lit(0), lambda a, d: a + length(d["wickets"]))


def last_delivery(deliveries: Column) -> list[Column]:
    """Columns that an over takes from its last delivery; null for an over without deliveries."""
    last = F.try_element_at(deliveries, F.lit(-1))
    return [
        last["batter"].alias("batter"),
        last["bowler"].alias("bowler"),
        last["non_striker"].alias("non_striker"),
        last["runs"]["batter"].cast("bigint").alias("runs_batter"),
        last["runs"]["extras"].cast("bigint").alias("runs_extras"),
        last["runs"]["total"].cast("bigint").alias("runs_total"),
    ]


def batting_first(toss_winner: Column, toss_decision: Column, players: Column) -> Column:
    """Team that bats first: the toss winner, unless it chose to field."""
    return F.when(toss_decision == "field", other_key(players, toss_winner)).otherwise(toss_winner)


def is_second_team(team: Column, team_2: Column) -> Column:
    return flag(team == team_2)


def chose_field(toss_decision: Column) -> Column:
    return flag(toss_decision == "field")


def run_rate(score: Column, over: Column) -> Column:
    return score / (over + 1)


def required_run_rate(inning: Column, first_total: Column, score: Column, over: Column, overs: int = OVERS) -> Column:
    """Runs still needed per remaining over; 0 in the first inning, at least one over remains."""
    remaining = F.greatest(F.lit(overs - 1) - over, F.lit(1))
    return F.when(inning == 2, (first_total - score) / remaining).otherwise(F.lit(0.0))


def first_inning_rate(mode: str, score: Column, wickets: Column, last_over: Column, overs: int = OVERS) -> Column:
    """Run rate of the first inning.

    ``overs``: score per over bowled. ``batch``: the training job divides by one over more if the
    inning ended early. ``stream``: the live job divides by wickets, and gives 0 without any.
    """
    if mode == "overs":
        return F.coalesce(F.try_divide(score, last_over + 1), F.lit(0.0))
    if mode == "batch":
        return F.coalesce(F.try_divide(score, F.least(last_over + 2, F.lit(overs))), F.lit(0.0))
    if mode == "stream":
        return F.when(wickets > 0, score / wickets).otherwise(F.lit(0.0))
    raise ValueError(f"unknown run rate mode {mode!r}")


def predicted_team(prediction: Column, team_1: Column, team_2: Column) -> Column:
    return F.when(prediction == 0, team_1).otherwise(team_2)
