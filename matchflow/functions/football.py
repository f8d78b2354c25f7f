"""Column functions of the football domain."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: tag codes of the event feed
ACCURATE, GOAL, DUEL_WON = 1801, 101, 703
# fixed values: labels of the same tags
ACCURATE_LABEL, GOAL_LABEL, DUEL_WON_LABEL = "accurate", "Goal", "won"

HALF_SECONDS = 3600


def absolute_second(second: Column, period: Column, half: int = HALF_SECONDS) -> Column:
    """Seconds in the match: the second half starts at ``half``; other periods are not moved."""
    return F.when(period == "2H", second + half).otherwise(second)


def within(second: Column, period: Column, start: float = 0, end: float = float("inf")) -> Column:
    """Whether an event lies in an absolute time range, both ends included."""
    return absolute_second(second, period).between(F.lit(float(start)), F.lit(float(end)))


def match_result(winner: Column, team1: Column, side1: Column, team2: Column, side2: Column) -> Column:
    """Side of the winning team, ``draw`` if neither team won, null without a winner value."""
    winner = winner.try_cast("bigint")
    return (
        F.when(winner.isNull(), F.lit(None).cast("string"))
        .when(team1 == winner, side1)
        .when(team2 == winner, side2)
        .otherwise(F.lit("draw"))
    )


def team_side(team: Column, team1: Column, side1: Column, team2: Column, side2: Column) -> Column:
    """Side of a team within its match, ``unknown`` for a foreign team or a missing match."""
    return F.coalesce(F.when(team == team1, side1).when(team == team2, side2), F.lit("unknown"))


def _flags(name: Column, shot: str, pass_: str, foul: str, duel: str, accurate, goal, won) -> dict[str, Column]:
    is_shot = name == shot
    return {
        "is_shot": is_shot,
        "is_accurate_shot": is_shot & accurate,
        "is_pass": name == pass_,
        "is_goal": is_shot & accurate & goal,
        "is_foul": name == foul,
        "is_duel_won": (name == duel) & won,
    }


def flags_by_label(name: Column, labels: Column) -> dict[str, Column]:
    """Event class from the exact event name and the labels of its tags."""
    has = lambda label: F.array_contains(labels, label)
    return _flags(
        name, "Shot", "Pass", "Foul", "Duel", has(ACCURATE_LABEL), has(GOAL_LABEL), has(DUEL_WON_LABEL)
    )


def flags_by_code(name: Column, tags: Column) -> dict[str, Column]:
    """Event class from the event name, trimmed and in any case, and its tag codes."""
    name = F.lower(F.trim(name))
    has = lambda code: F.array_contains(tags, code)
    return _flags(name, "shot", "pass", "foul", "duel", has(ACCURATE), has(GOAL), has(DUEL_WON))


# counter name -> flag that it counts
COUNTED = {
    "shots": "is_shot",
    "accurate_shots": "is_accurate_shot",
    "passes": "is_pass",
    "goals": "is_goal",
    "fouls": "is_foul",
    "duels_won": "is_duel_won",
}


def side_counters(flags: dict[str, Column], side: Column) -> dict[str, Column]:
    """The twelve conditions that the home and away counters count."""
    return {
        f"{team}_{counter}": flags[flag] & (side == team)
        for counter, flag in COUNTED.items()
        for team in ("home", "away")
    }


def differences() -> dict[str, Column]:
    """Home minus away for every counter and for possession."""
    names = ["goals", "passes", "fouls", "shots", "accurate_shots", "duels_won", "possession_time"]
    return {f"{n}_diff": F.col(f"home_{n}") - F.col(f"away_{n}") for n in names}


def event_key(match: Column, second: Column, *content: Column, unique: bool = False) -> Column:
    """``match_second_suffix``; the suffix is a hash of the content, so that a replay of the
    same event gets the same id, or a random one with ``unique``."""
    suffix = F.uuid() if unique else F.substring(F.sha2(F.to_json(F.struct(*content)), 256), 1, 32)
    return F.concat_ws("_", match.cast("string"), second.cast("int").cast("string"), suffix)
