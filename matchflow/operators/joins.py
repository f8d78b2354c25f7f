"""Enrichment and completeness joins.

No side is broadcast by hint: Spark broadcasts a dimension when its size is known to be under
``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles both sides, where adaptive
execution splits the partitions of a hot key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchflow.functions import football
from matchflow.functions.columns import literal_map, map_labels, years_since

MAP_ENTRIES = 10_000


def enrich(
    facts: DataFrame, dimension: DataFrame, key: str, dimension_key: str, columns: Sequence[str], how: str = "left"
) -> DataFrame:
    """Add columns of a dimension whose key has another name; the dimension key is dropped."""
    side = dimension.select(F.col(dimension_key).alias("__key"), *columns)
    return facts.join(side, F.col(key) == F.col("__key"), how).drop("__key")


def one_per_key(df: DataFrame, *keys: str) -> DataFrame:
    """One row per key: of several, as after a repeated landing, the largest by its columns from left to right."""
    rest = [c for c in df.columns if c not in keys]
    largest = df.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("__row"))
    return largest.select(*[F.col(c) if c in keys else F.col("__row")[c].alias(c) for c in df.columns])


def enrich_age(facts: DataFrame, drivers: DataFrame, year: int, key: str = "driver") -> DataFrame:
    """Add the age that each driver reaches in ``year``; null for drivers not in the table."""
    ages = drivers.select("driverId", years_since("dob", year).alias("age")).groupBy("driverId").agg(F.max("age").alias("age"))
    return enrich(facts, ages, key, "driverId", ["age"])


def enrich_circuit(facts: DataFrame, races: DataFrame, key: str = "race_id") -> DataFrame:
    return enrich(facts, one_per_key(races.select("raceId", "circuitId"), "raceId"), key, "raceId", ["circuitId"])


def enrich_side(
    events: DataFrame, matches: DataFrame, key: str = "matchId", team: str = "teamId", side: str = "side"
) -> DataFrame:
    """Side of the event's team, ``unknown`` for a foreign team or an unknown match.

    ``matches`` has the columns of the match dimension; a match that is in it more than once counts once. ``events`` may
    be a stream.
    """
    dimension = matches.select(
        F.col("matchId").alias("__key"), *[F.col(c) for c in ("team1_id", "team2_id", "team1_side", "team2_side")]
    )
    joined = events.join(one_per_key(dimension, "__key"), F.col(key) == F.col("__key"), "left")
    value = football.team_side(*[F.col(c) for c in (team, "team1_id", "team1_side", "team2_id", "team2_side")])
    return joined.withColumn(side, value).drop("__key", "team1_id", "team2_id", "team1_side", "team2_side")


def pruned(dimension: DataFrame, facts: DataFrame, dimension_key: str, key: str) -> DataFrame:
    """Rows of a dimension that some fact refers to."""
    return dimension.join(facts.select(F.col(key).alias(dimension_key)), dimension_key, "left_semi")


def missing(wanted: DataFrame, present: DataFrame, key: str) -> DataFrame:
    """Wanted ids that have no row in ``present``."""
    return wanted.select(key).distinct().join(present, key, "left_anti")


def label_tags(
    df: DataFrame,
    tags: str,
    names: DataFrame,
    labels: str = "tags_labels",
    default: str = "Unknown",
    map_entries: int = MAP_ENTRIES,
) -> DataFrame:
    """Add the label of every tag code in an array column; null for a null array.

    Of several labels of one code the largest counts, and entries without a code do not. A dictionary of at most
    ``map_entries`` codes becomes a literal map and needs no join. A larger one is joined to the exploded codes of numbered
    rows, which carries every row through one shuffle; both ways give the same result, copies of rows included.
    """
    one_name = names.where(F.col("Tag").isNotNull()).groupBy("Tag").agg(F.max("Label").alias("Label"))
    entries = one_name.limit(map_entries + 1).collect()
    if len(entries) <= map_entries:
        pairs = {row.Tag: row.Label for row in entries}
        known = literal_map(pairs) if pairs else F.lit(None).cast("map<int,string>")
        return df.withColumn(labels, map_labels(tags, known, default))
    whole = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("__row")
    rows = df.select(F.monotonically_increasing_id().alias("__id"), whole)
    codes = rows.select("__id", "__row", F.posexplode_outer(F.col("__row")[tags]).alias("__at", "Tag"))
    named = codes.join(one_name, "Tag", "left")
    label = F.when(F.col("__at").isNotNull(), F.struct("__at", F.coalesce("Label", F.lit(default)).alias("label")))
    # a row's labels are as many as its codes, so the collected arrays stay small
    back = named.groupBy("__id").agg(F.first("__row").alias("__row"), F.array_sort(F.collect_list(label)).alias("__named"))
    found = F.when(F.col("__row")[tags].isNotNull(), F.transform("__named", lambda x: x["label"]))
    return back.select(*[F.col("__row")[c].alias(c) for c in df.columns if c != labels], found.alias(labels))
