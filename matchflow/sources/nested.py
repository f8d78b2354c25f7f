"""Nested documents with ids as object keys: building them and flattening them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchflow import schemas
from matchflow.operators.joins import one_per_key
from matchflow.operators.running import Count, attach, running

MAX_ENTRIES = 100_000  # of one document

# --- laps: race -> lap -> driver ------------------------------------------------------------


def parse_document(text: Column | str, schema: T.StructType) -> Column:
    return F.from_json(text, schema)


def _in_parts(df: DataFrame, key: str, order: Sequence[str], max_entries: int) -> DataFrame:
    """Number the parts of each group from 0, so that no document holds more than ``max_entries``, and count them."""
    numbered = running(df, [key], order, {"__nth": Count()})
    counts = df.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / F.lit(max_entries)).alias("__parts"))
    part = F.floor((F.col("__nth") - 1) / F.lit(max_entries))
    return attach(numbered, counts, [key]).withColumn("__part", part).drop("__nth")


def laps_document(
    laps: DataFrame, fields: Sequence[str] = ("position", "milliseconds"), max_entries: int = MAX_ENTRIES
) -> DataFrame:
    """One document per race with the given fields of every driver and lap.

    A race with more than ``max_entries`` driver laps becomes several documents of the same form,
    which flatten to the same rows; ``part`` and ``parts`` say which of how many a document is. Of several rows
    of one driver and lap the one with the largest fields counts.
    """
    once = one_per_key(laps.select("raceId", "lap", "driverId", *fields), "raceId", "lap", "driverId")
    parts = _in_parts(once, "raceId", ["lap", "driverId"], max_entries)
    entry = F.struct(F.col("driverId").cast("string"), F.struct(*fields))
    drivers = parts.groupBy("raceId", "__part", "__parts", "lap").agg(F.map_from_entries(F.collect_list(entry)).alias("drivers"))
    lap = F.struct(F.col("lap").cast("string"), F.struct("drivers"))
    by_race = drivers.groupBy("raceId", "__part", "__parts").agg(F.map_from_entries(F.collect_list(lap)).alias("laps"))
    races = F.create_map(F.col("raceId").cast("string"), F.struct("laps"))
    return by_race.select(races.alias("races"), F.col("__part").alias("part"), F.col("__parts").alias("parts"))


def lap_message(race: Column, lap: Column, driver: Column, **fields: Column) -> Column:
    """Message text for one driver's lap, in the nested form of the feed."""
    values = F.struct(*[value.alias(name) for name, value in fields.items()])
    drivers = F.create_map(driver.cast("string"), values)
    laps = F.create_map(lap.cast("string"), F.struct(drivers.alias("drivers")))
    races = F.create_map(race.cast("string"), F.struct(laps.alias("laps")))
    return F.to_json(F.struct(races.alias("races")))


def flatten_laps(df: DataFrame, document: str = "document") -> DataFrame:
    """One row per race, lap and driver of the documents in a column; works on streams too."""
    return (
        df.select(F.explode(F.col(f"{document}.races")).alias("race_id", "__race"))
        .select("race_id", F.explode("__race.laps").alias("lap", "__lap"))
        .select("race_id", F.col("lap").cast("bigint").alias("lap"), F.explode("__lap.drivers").alias("driver", "__entry"))
        .select("race_id", "lap", "driver", "__entry.*")
    )


# --- football events and matches ------------------------------------------------------------


def _event_object() -> Column:
    point = lambda kind: F.struct(F.col(f"pos_{kind}_x").alias("x"), F.col(f"pos_{kind}_y").alias("y"))
    return F.struct(
        "subEventName", "tags", "playerId",
        F.struct(point("orig").alias("origin"), point("dest").alias("destination")).alias("positions"),
        "matchPeriod", "eventSec", "subEventId", "id", "tagsList", "teamId", "eventName",
    )


def event_objects(events: DataFrame) -> DataFrame:
    """One nested event object per row of the flat event table, with its match."""
    return events.select("matchId", F.col("id").cast("string").alias("event_id"), _event_object().alias("event"))


def events_document(events: DataFrame, max_entries: int = MAX_ENTRIES) -> DataFrame:
    """One document per match, or several for a match with more than ``max_entries`` events.

    ``part`` and ``parts`` say which of how many a document is. Of several rows of one event the largest counts.
    """
    parts = _in_parts(one_per_key(events, "matchId", "id"), "matchId", ["id"], max_entries)
    entry = F.struct(F.col("id").cast("string"), _event_object())
    by_match = parts.groupBy("matchId", "__part", "__parts").agg(F.map_from_entries(F.collect_list(entry)).alias("events"))
    matches = F.create_map(F.col("matchId").cast("string"), F.struct("events")).alias("matches")
    return by_match.select(matches, F.col("__part").alias("part"), F.col("__parts").alias("parts"))


def single_event_documents(events: DataFrame) -> DataFrame:
    """One document per event, for feeds that publish event by event: nothing is gathered."""
    event = F.create_map("event_id", "event")
    match = F.create_map(F.col("matchId").cast("string"), F.struct(event.alias("events")))
    return event_objects(events).select(F.struct(match.alias("matches")).alias("document"))


def flatten_events(df: DataFrame, document: str = "document") -> DataFrame:
    """One row per event of the documents in a column, with defaults for missing fields."""
    event = lambda name: F.col(f"__event.{name}")
    text = lambda name: F.coalesce(event(name), F.lit(""))
    position = lambda end, axis: F.col(f"__event.positions.{end}.{axis}")
    return (
        df.select(F.explode(F.col(f"{document}.matches")).alias("match_id", "__match"))
        .select("match_id", F.explode("__match.events").alias("event_id", "__event"))
        .select(
            "match_id",
            "event_id",
            text("eventName").alias("event_name"),
            text("subEventName").alias("sub_event_name"),
            text("tags").alias("tags"),
            event("playerId").alias("player_id"),
            event("teamId").alias("team_id"),
            text("matchPeriod").alias("match_period"),
            F.coalesce(event("eventSec"), F.lit(0.0)).alias("event_sec"),
            text("subEventId").alias("sub_event_id"),
            position("origin", "x").alias("pos_orig_x"),
            position("origin", "y").alias("pos_orig_y"),
            position("destination", "x").alias("pos_dest_x"),
            position("destination", "y").alias("pos_dest_y"),
            F.coalesce(event("tagsList"), F.lit("[]")).alias("tags_list"),
        )
    )


def match_objects(matches: DataFrame) -> DataFrame:
    """One nested match object per row of the flat match table, whose team columns hold dots."""
    team = lambda n: F.struct(
        *[F.col(f"`team{n}.{name}`").alias(name) for name in schemas.TEAM_FIELDS]
    ).alias(f"team{n}")
    return matches.select(
        F.col("wyId").cast("string").alias("match_id"),
        F.struct(*schemas.MATCH_FIELDS, team(1), team(2)).alias("match"),
    )


def single_match_documents(matches: DataFrame) -> DataFrame:
    """One document per match."""
    match = F.create_map("match_id", "match").alias("matches")
    return match_objects(matches).select(F.struct(match).alias("document"))


def flatten_matches(df: DataFrame, document: str = "document") -> DataFrame:
    """One row per match: the match fields and both teams' fields as ``team1_*``, ``team2_*``."""

    def field(path: str, name: str, dtype: T.DataType, alias: str) -> Column:
        value = F.col(path)[name]
        return (F.coalesce(value, F.lit("")) if isinstance(dtype, T.StringType) else value).alias(alias)

    return df.select(F.explode(F.col(f"{document}.matches")).alias("match_id", "__match")).select(
        "match_id",
        *[field("__match", name, dtype, name) for name, dtype in schemas.MATCH_FIELDS.items()],
        *[
            field(f"__match.team{n}", name, dtype, f"team{n}_{name}")
            for n in (1, 2)
            for name, dtype in schemas.TEAM_FIELDS.items()
        ],
    )


def require_matches(events: DataFrame, matches: DataFrame, key: str = "match_id") -> DataFrame:
    """The events, or an error if a wanted match has none in the landed files."""
    missing = matches.select(key).distinct().join(events, key, "left_anti")
    example = missing.take(1)
    if example:
        raise ValueError(f"no events landed for match {example[0][0]}")
    return events
