"""Cricket end to end: over files to history table, model and metrics, and messages to predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from matchflow import schemas
from matchflow.ml import evaluate, models
from matchflow.operators import overs
from matchflow.session import materialise
from matchflow.sinks.tables import save_path, save_table
from matchflow.sources import files
from matchflow.streaming import overs as live


def load_overs(spark: SparkSession, folder: str, matches: DataFrame | Sequence[int] | None = None) -> DataFrame:
    """Over documents of the wanted matches; an inning ends before its first missing over."""
    documents = files.read_overs(spark, folder)
    if matches is not None:
        documents = files.select_matches(documents, matches)
    return files.up_to_first_gap(documents)


def history(documents: DataFrame, mode: str = "overs", season_mode: str = "stream") -> DataFrame:
    """Training rows, one per over, with both teams' players.

    An over without deliveries keeps the cumulative values, with no players and no runs.
    """
    rows = overs.document_rows(documents, season_mode=season_mode)
    # copies of an over would count twice; they are merged before the shuffle
    rows = overs.player_columns(rows.dropDuplicates(["match_id", "inning", "over"]))
    rows = rows.fillna("", ["batter", "bowler", "non_striker"]).fillna(0, ["runs_batter", "runs_extras", "runs_total"])
    return overs.over_features(rows, mode)


def run_batch(
    spark: SparkSession, folder: str, table: str, mode: str = "APPEND", matches: DataFrame | Sequence[int] | None = None
) -> None:
    rows = history(load_overs(spark, folder, matches))
    save_table(rows, table, mode, schemas.OVER_HISTORY_WITH_PLAYERS)


def train(rows: DataFrame, metrics_path: str | None = None, evaluated: DataFrame | None = None) -> PipelineModel:
    """Winner model; with a path its metrics are appended to the metrics table."""
    rows = materialise(rows, "history")
    model = models.train_winner_model(rows)
    if metrics_path:
        save_path(metrics(model, rows if evaluated is None else evaluated), metrics_path, "APPEND", schemas.METRICS)
    return model


def metrics(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """All classification metrics that are defined on these rows."""
    p = vector_to_array("probability")
    scored = model.transform(rows).withColumns(
        {
            "__p": p[1],
            "__truth": F.when(F.col("winner") == 1, p[1]).otherwise(p[0]),
            "__said": F.col("prediction").cast("int"),
        }
    )
    report = evaluate.classification_metrics(scored, "winner", "__said", F.col("__truth"))
    return report.unionByName(evaluate.roc_auc(scored, "winner", "__p")).filter(F.col("metric_value").isNotNull())


def start_live(messages: DataFrame, path: str, checkpoint: str, model: PipelineModel | None = None, **options) -> StreamingQuery:
    """Messages to statistics, and to the predicted winner if a model is given."""
    score = None if model is None else lambda rows: models.score_winners(model, rows)
    return live.start_over_statistics(live.parse_overs(messages), path, checkpoint, score, **options)
