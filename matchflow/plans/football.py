"""Football end to end: landed documents to history table and model, and messages to predictions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from matchflow import schemas
from matchflow.functions import columns as fx
from matchflow.functions import football as rules
from matchflow.ml import models, split
from matchflow.operators import football, joins
from matchflow.session import materialise
from matchflow.sinks.tables import save_table
from matchflow.sources import files, nested
from matchflow.streaming import football as live


def _documents(spark: SparkSession, path: str, schema) -> DataFrame:
    return files.read_json(spark, path, schema).select(F.struct("matches").alias("document"))


def load_matches(spark: SparkSession, path: str, gameweek: int | None = None, competition: int | None = None) -> DataFrame:
    """Flattened matches of the landed documents; an error if none is left by the filters."""
    matches = nested.flatten_matches(_documents(spark, path, schemas.MATCHES_DOCUMENT))
    chosen = files.lookup_matches(matches, None, gameweek, competition)
    return files.require_rows(chosen, "No matches found with the given parameters.")


def load_events(spark: SparkSession, path: str, matches: DataFrame) -> DataFrame:
    """Flattened events of the given matches; an error if a match has none."""
    events = nested.flatten_events(_documents(spark, path, schemas.EVENTS_DOCUMENT))
    return nested.require_matches(files.select_matches(events, matches), matches)


def history(events: DataFrame, matches: DataFrame, tag_names: DataFrame, **options) -> DataFrame:
    """Training rows: match statistics per second with the result of the match."""
    # a number orders the events of one second; hash aggregates cannot keep text in their buffers
    number = F.coalesce(F.col("event_id").try_cast("bigint"), F.xxhash64("event_id"))
    joined = football.join_matches(events.withColumn("event_id", number), matches)
    joined = joined.withColumn("tags", fx.int_list("tags_list"))
    labelled = joins.label_tags(joined, "tags", tag_names)
    flags = rules.flags_by_label(F.col("event_name"), F.col("tags_labels"))
    options = {"offset": "first_half_max", "per_match": ["result"], **options}
    return football.cumulative_stats(labelled, flags, **options)


def run_batch(
    spark: SparkSession,
    matches_path: str,
    events_path: str,
    tag_names: DataFrame,
    table: str,
    mode: str = "APPEND",
    gameweek: int | None = None,
    competition: int | None = None,
) -> None:
    """Add one gameweek to the history table."""
    matches = load_matches(spark, matches_path, gameweek, competition)
    rows = history(load_events(spark, events_path, matches), matches, tag_names)
    columns = ["match_id", "event_sec", "result", *schemas.FOOTBALL_FEATURES]
    save_table(rows.select(columns), table, mode)


def train(rows: DataFrame, evaluation: float = 0.3, by_match: bool = True) -> tuple[PipelineModel, DataFrame]:
    """Result model and the scored evaluation rows."""
    rows = materialise(rows, "history")  # read once per tree level
    fit, held = split.split_by_key(rows, "match_id", evaluation) if by_match else split.split_rows(rows, evaluation)
    model = models.train_result_model(fit)
    return model, model.transform(held)


def start_live(
    messages: DataFrame,
    matches: DataFrame,
    path: str,
    checkpoint: str,
    score: PipelineModel | Callable[[DataFrame], DataFrame],
    **options,
) -> StreamingQuery:
    """Messages to statistics and predictions below ``path``; ``matches`` is the match dimension.

    ``score`` is a result model, or a function that makes predictions of statistics.
    """
    events = live.enrich_events(live.parse_events(messages), matches)
    predict = score if callable(score) else lambda stats: models.score_results(score, stats)
    return live.start_match_statistics(events, path, checkpoint, predict, **options)
