"""Formula 1 end to end: lap documents to history table and position model."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from matchflow import schemas
from matchflow.ml import models
from matchflow.operators.laps import lap_features
from matchflow.session import materialise
from matchflow.sinks.tables import save_table
from matchflow.sources import files, nested
from matchflow.streaming import laps as live


def load_laps(spark: SparkSession, path: str) -> DataFrame:
    documents = files.read_json(spark, path, schemas.LAPS_DOCUMENT).select(F.struct("races").alias("document"))
    laps = nested.flatten_laps(documents)
    return laps.withColumns({c: F.col(c).cast("int") for c in ("race_id", "driver")})


def run_batch(spark: SparkSession, path: str, table: str, mode: str = "APPEND", race: int | None = None) -> None:
    """Add the laps of one race, or of all landed ones, to the history table."""
    features = lap_features(files.where_equal(load_laps(spark, path), race_id=race))
    save_table(features.drop("race_id", "milliseconds"), table, mode)


def train(rows: DataFrame) -> PipelineModel:
    return models.train_position_model(materialise(rows, "history"))


def start_live(messages: DataFrame, path: str, checkpoint: str, **options) -> StreamingQuery:
    return live.start_lap_statistics(live.parse_laps(messages), path, checkpoint, **options)
