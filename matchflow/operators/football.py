"""Football: match results, half offsets, possession and cumulative match statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from matchflow.functions import football
from matchflow.operators.joins import one_per_key
from matchflow.operators.running import CHUNK, Previous, Total, attach, cut, has_hot_groups, hot_cuts, running

# sides as numbers keep first- and last-side aggregates in fixed-width hash buffers
_SIDE_CODES = {"home": 1, "away": 2}


def _side_code(side: Column) -> Column:
    return F.when(side == "home", F.lit(1)).when(side == "away", F.lit(2)).otherwise(F.lit(0))


def join_matches(events: DataFrame, matches: DataFrame) -> DataFrame:
    """Events of known matches with the side of their team and the result of their match.

    A match that was landed more than once counts once, with its largest row.
    """
    teams = [F.col(c).try_cast("bigint").alias(c) for c in ("team1_teamId", "team2_teamId")]
    sides = matches.select("match_id", *teams, "team1_side", "team2_side", "winner")
    columns = ("team1_teamId", "team1_side", "team2_teamId", "team2_side")
    result = football.match_result(F.col("winner"), *[F.col(c) for c in columns])
    side = football.team_side(F.col("team_id"), *[F.col(c) for c in columns])
    dimension = one_per_key(sides.withColumn("result", result).drop("winner"), "match_id")
    return events.join(dimension, "match_id").withColumn("side", side).drop(*columns)


def shift_second_half(
    events: DataFrame,
    offset: str = "first_half_max",
    match: str = "match_id",
    second: str = "event_sec",
    period: str = "match_period",
    hot: bool = True,
) -> DataFrame:
    """Move second-half events behind the first half.

    ``fixed`` adds an hour. ``first_half_max`` adds the last first-half second of the match, and
    gives null for a match without first-half events. The maximum is an aggregate that is joined
    back; without ``hot`` matches a window over the match does.
    """
    if offset == "fixed":
        return events.withColumn(second, football.absolute_second(F.col(second), F.col(period)))
    if offset != "first_half_max":
        raise ValueError(f"unknown half offset {offset!r}")
    half = F.max(F.when(F.col(period) == "1H", F.col(second)))
    if hot:
        ends = events.groupBy(match).agg(half.alias("__half"))
        timed = attach(events, ends, [match])
    else:
        timed = events.withColumn("__half", half.over(Window.partitionBy(match)))
    moved = F.when(F.col(period) == "2H", F.col(second) + F.col("__half")).otherwise(F.col(second))
    return timed.withColumn(second, moved).drop("__half")


def _credited(credit: str) -> Column:
    """Code of the side that gets the time since the second before."""
    if credit not in ("current", "previous"):
        raise ValueError(f"possession is credited to the current or previous side, not {credit!r}")
    return F.col("__first_side") if credit == "current" else F.col("__previous_side")


def _sides_of_second(side: str, event: str) -> list[Column]:
    code = _side_code(F.col(side))
    return [F.min_by(code, event).alias("__first_side"), F.max_by(code, event).alias("__last_side")]


def _with_possession(rows: DataFrame, match: str, order: Sequence[str], credit: str, **options) -> DataFrame:
    """Time since the row before and how much of it each side gets."""
    second = order[0]
    previous = {"__previous": Previous(second), "__previous_side": Previous("__last_side")}
    lagged = running(rows, [match], order, previous, **options)
    diff = F.coalesce(F.col(second) - F.col("__previous"), F.lit(0.0))
    lagged = lagged.withColumn("time_diff", diff)
    return lagged.withColumns(
        {
            f"{name}_possession_time": F.when(_credited(credit) == code, F.col("time_diff")).otherwise(F.lit(0.0))
            for name, code in _SIDE_CODES.items()
        }
    ).drop("__previous", "__previous_side")


def possession(
    events: DataFrame,
    credit: str = "current",
    match: str = "match_id",
    second: str = "event_sec",
    event: str = "event_id",
    side: str = "side",
) -> DataFrame:
    """Add the time since the event before and the part of it that each side gets."""
    coded = events.withColumns(dict.fromkeys(["__first_side", "__last_side"], _side_code(F.col(side))))
    return _with_possession(coded, match, [second, event], credit).drop("__first_side", "__last_side")


def cumulative_stats(
    events: DataFrame,
    flags: dict[str, Column],
    credit: str = "current",
    per_match: Sequence[str] = (),
    offset: str | None = None,
    match: str = "match_id",
    second: str = "event_sec",
    event: str = "event_id",
    side: str = "side",
    period: str = "match_period",
) -> DataFrame:
    """One row per (match, second): twelve counters, possession and home-away differences.

    All events up to and including the second count, so ties are counted together. ``per_match``
    names columns that are constant within a match and are kept, such as its result. With an
    ``offset`` the second half is moved first, see ``shift_second_half``.

    Events are first counted per (match, second); running sums then need one row per second.
    While no match is hot, one shuffle by match serves the offset, the counting and both windows.
    Hot matches are counted with map-side combining and cut along time instead.
    """
    counters = football.side_counters(flags, F.col(side))
    columns = dict.fromkeys([match, *per_match, second, event, side, *([period] if offset else [])])
    rows = events.select(*columns, *[c.alias(n) for n, c in counters.items()])
    hot = has_hot_groups(events, [match])
    if not hot:
        rows = rows.repartition(match)
    if offset:
        rows = shift_second_half(rows, offset, match, second, period, hot)
    cuts = hot_cuts(rows, [match], [second]) if hot else None
    counts = [F.count_if(F.col(n)).alias(n) for n in counters]
    seconds = rows.groupBy(match, *per_match, second).agg(*counts, *_sides_of_second(side, event))
    seconds = cut(seconds, [match], [second], cuts, split_ties=False)  # one row per second
    timed = _with_possession(seconds, match, [second], credit, already_cut=True, keep_chunks=True)
    totals = {n: Total(n) for n in [*counters, "home_possession_time", "away_possession_time"]}
    summed = running(timed, [match], [second], totals, already_cut=True)
    return summed.drop("__first_side", "__last_side", "time_diff", CHUNK).withColumns(football.differences())
