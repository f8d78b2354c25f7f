"""Reading the landed feeds and the warehouse tables, and the lookups on them.

Filters are plain column predicates on the scan, so Spark pushes them into Parquet and CSV.
Lay the event table out by match and the lap table out by race to prune whole files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from matchflow import schemas
from matchflow.functions import football

OVER_FILE = r"cricket_(\d+)_(\d+)_(\d+)"  # fixed value: match, inning and over in the file name


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON documents, one or more files each holding one document."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_table(spark: SparkSession, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    table = spark.table(name)
    return table.select(*columns) if columns else table


# --- filters ------------------------------------------------------------------------------


def where_equal(df: DataFrame, **wanted) -> DataFrame:
    """Rows that match every given value; None means no condition and adds nothing to the plan."""
    for name, value in wanted.items():
        if value is not None:
            df = df.filter(F.col(name) == value)
    return df


def blank_strings(df: DataFrame) -> DataFrame:
    """Missing text as an empty string; numbers and dates keep their nulls."""
    return df.fillna("", subset=[f.name for f in df.schema if isinstance(f.dataType, T.StringType)])


def lookup_race(races: DataFrame, race: int, key: str = "raceId") -> DataFrame:
    """Name and date of one race; no row if the race is unknown."""
    return races.filter(F.col(key) == race).select("name", "date").limit(1)


def lookup_laps(laps: DataFrame, race: int, lap: int | None = None) -> DataFrame:
    return where_equal(laps, raceId=race, lap=lap)


def lookup_events(
    events: DataFrame,
    match,
    start: float = 0,
    end: float = float("inf"),
    match_col: str = "matchId",
    second: str = "eventSec",
    period: str = "matchPeriod",
) -> DataFrame:
    """Events of one match in an absolute time range, both ends included."""
    near = F.col(second).between(start - football.HALF_SECONDS, end)  # implied by the range, and pushed into the scan
    return events.filter((F.col(match_col) == match) & near & football.within(F.col(second), F.col(period), start, end))


def lookup_matches(
    matches: DataFrame,
    match=None,
    gameweek=None,
    competition=None,
    match_col: str = "wyId",
    gameweek_col: str = "gameweek",
    competition_col: str = "competitionId",
) -> DataFrame:
    """Matches by id, else by gameweek with an optional competition, else all of them."""
    if match is not None:
        return where_equal(matches, **{match_col: match})
    if gameweek is not None:
        return where_equal(matches, **{gameweek_col: gameweek, competition_col: competition})
    return matches


def require_rows(df: DataFrame, message: str) -> DataFrame:
    if df.isEmpty():
        raise ValueError(message)
    return df


# --- dimensions ---------------------------------------------------------------------------


def match_dimension(matches_info: DataFrame) -> DataFrame:
    """Match table for enrichment, its key as the text that the event feed carries."""
    return matches_info.select(
        F.col("wyId").cast("string").alias("matchId"), "team1_id", "team2_id", "team1_side", "team2_side"
    )


def match_dimension_from_matches(matches: DataFrame) -> DataFrame:
    """The same columns from the full match table, whose column names hold dots."""
    return matches.select(
        F.col("wyId").cast("string").alias("matchId"),
        F.col("`team1.teamId`").alias("team1_id"),
        F.col("`team2.teamId`").alias("team2_id"),
        F.col("`team1.side`").alias("team1_side"),
        F.col("`team2.side`").alias("team2_side"),
    )


# --- cricket over documents -----------------------------------------------------------------


def read_overs(spark: SparkSession, folder: str) -> DataFrame:
    """All over documents of a folder, with match, inning and over taken from the file name.

    Files that hold the "no data" sentinel instead of a document are dropped.
    """
    docs = read_json(spark, folder, schemas.OVER_DOCUMENT).select("*", F.col("_metadata.file_name").alias("__file"))
    part = lambda i: F.regexp_extract("__file", OVER_FILE, i)
    return (
        docs.filter(F.col("players").isNotNull() & F.col("__file").rlike(OVER_FILE))
        .withColumns(
            {
                "match_id": part(1).cast("bigint"),
                "inning": part(2).cast("int"),
                "over": part(3).cast("int"),
            }
        )
        .drop("__file")
    )


def lookup_over(overs: DataFrame, match: int, inning: int, over: int) -> DataFrame:
    return where_equal(overs, match_id=match, inning=inning, over=over)


def select_matches(df: DataFrame, wanted: DataFrame | Sequence, key: str = "match_id") -> DataFrame:
    """Rows of the wanted matches, given as a short list of ids or as a table with the same key."""
    if isinstance(wanted, DataFrame):
        return df.join(wanted.select(key), key, "left_semi")
    return df.filter(F.col(key).isin(list(wanted)))


def up_to_first_gap(
    overs: DataFrame, keys: Sequence[str] = ("match_id", "inning"), over: str = "over", size: int | None = None
) -> DataFrame:
    """Overs of each inning from 0 up to the first over that is missing, or to ``size`` overs where the rules end there.

    Before the first gap an over is the number of different overs below it, which one window per inning tells.
    """
    numbered = overs.filter(F.col(over) >= 0)
    order = Window.partitionBy(*keys).orderBy(over)
    kept = numbered.withColumn("__nth", F.dense_rank().over(order)).filter(F.col(over) == F.col("__nth") - 1).drop("__nth")
    return kept if size is None else kept.filter(F.col(over) < size)
