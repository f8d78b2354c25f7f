"""Laps: running position statistics and the feature table of the position model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from matchflow.operators.running import Low, Mean, RollingMean, Stat, Std, attach, has_hot_groups, running

ROLLING_LAPS = 5


def position_statistics(position: str = "position", ddof: int = 1) -> dict[str, Stat]:
    """Statistics of all laps so far; training uses the sample deviation, live the population one."""
    return {
        "mean_position_up_to_lap": Mean(position),
        "std_position_up_to_lap": Std(position, ddof),
        "min_position_up_to_lap": Low(F.col(position).cast("double")),
        "last_5_laps_mean_position": RollingMean(position, ROLLING_LAPS),
    }


def final_positions(
    laps: DataFrame, race: str = "race_id", driver: str = "driver", lap: str = "lap", position: str = "position"
) -> DataFrame:
    """Position at the last lap of each driver in each race."""
    return laps.groupBy(race, driver).agg(F.max_by(position, lap).alias("final_position"))


def lap_features(
    laps: DataFrame,
    race: str = "race_id",
    driver: str = "driver",
    lap: str = "lap",
    position: str = "position",
    ddof: int = 1,
    complete_only: bool = True,
) -> DataFrame:
    """Running statistics and final position per lap.

    ``complete_only`` drops rows with a null, which removes the first lap of every driver, since
    one position has no sample deviation. The final position is a window over the same shuffle
    as the statistics, or an aggregate that is joined back if some driver's laps are too many for
    one task.
    """
    keys = [race, driver]
    if has_hot_groups(laps, keys):
        stats = running(laps, keys, [lap], position_statistics(position, ddof))
        out = attach(stats, final_positions(laps, race, driver, lap, position), keys)
    else:
        stats = running(laps, keys, [lap], position_statistics(position, ddof), already_cut=True)
        out = stats.withColumn("final_position", F.max_by(position, lap).over(Window.partitionBy(*keys)))
    return out.dropna("any") if complete_only else out
