"""The three models: match result, final position and match winner."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel, Pipeline, Transformer
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import IndexToString, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchflow import schemas
from matchflow.functions.cricket import predicted_team

SEED = 42
TEAMS = ["team_1", "team_2"]
WINNER_FEATURES = [c for c in schemas.OVER_FEATURES if c not in TEAMS]


def _assembler(columns: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(columns), outputCol="features", handleInvalid="keep")


def train_result_model(
    history: DataFrame, features: Sequence[str] = schemas.FOOTBALL_FEATURES, label: str = "result", trees: int = 100
) -> PipelineModel:
    """Random forest for home, away or draw: 100 trees of depth 10 on 0.3 of rows and features.

    The label index is fitted outside the pipeline, so the model scores rows without a label.
    """
    rows = history.filter(F.col(label).isNotNull())
    index = StringIndexer(inputCol=label, outputCol="label", stringOrderType="alphabetAsc").fit(rows)
    forest = RandomForestClassifier(
        numTrees=trees, maxDepth=10, featureSubsetStrategy="0.3", subsamplingRate=0.3, seed=SEED
    )
    names = IndexToString(inputCol="prediction", outputCol="predicted_result", labels=index.labels)
    return Pipeline(stages=[_assembler(features), forest, names]).fit(index.transform(rows))


def result_probabilities(scored: DataFrame, labels: Sequence[str], wanted: Sequence[str]) -> dict:
    """Probability columns by label; 0 for a label that the model never saw."""
    values = vector_to_array("probability")
    return {n: values[list(labels).index(n)] if n in labels else F.lit(0.0) for n in wanted}


def score_results(
    model: PipelineModel, stats: DataFrame, event: str = "event_id", match: str = "matchId", second: str = "eventSec"
) -> DataFrame:
    """Predicted result and probabilities per row of statistics, batch or stream."""
    labels = model.stages[-1].getLabels()
    scored = model.transform(stats)
    p = result_probabilities(scored, labels, ["home", "away", "draw"])
    return scored.select(
        F.col(event).alias("event_id"),
        F.col(match).alias("match_id"),
        F.col(second).alias("event_sec"),
        "predicted_result",
        p["home"].alias("prob_home_win"),
        p["away"].alias("prob_away_win"),
        p["draw"].alias("prob_draw"),
    )


def train_position_model(history: DataFrame, features: Sequence[str] = schemas.LAP_FEATURES) -> PipelineModel:
    """Boosted trees for the final position."""
    rows = history.withColumn("label", F.col("final_position").cast("double"))
    return Pipeline(stages=[_assembler(features), GBTRegressor(seed=SEED)]).fit(rows)


def train_winner_model(history: DataFrame, label: str = "winner") -> PipelineModel:
    """Boosted trees for the winner; team names are categories, unknown teams share one."""
    index = StringIndexer(inputCols=TEAMS, outputCols=[f"{t}_index" for t in TEAMS], handleInvalid="keep")
    teams = index.fit(history)
    bins = max(32, *[len(labels) + 1 for labels in teams.labelsArray])
    features = [*WINNER_FEATURES, *[f"{t}_index" for t in TEAMS]]
    stages: list[Transformer] = [teams, _assembler(features), GBTClassifier(labelCol=label, maxBins=bins, seed=SEED)]
    return Pipeline(stages=stages).fit(history)


def score_winners(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Add the name of the team that is predicted to win."""
    scored = model.transform(rows)
    name = predicted_team(F.col("prediction"), F.col("team_1"), F.col("team_2"))
    return scored.select(*rows.columns, name.alias("predicted_winner"))


def feature_importance(model: PipelineModel, features: Sequence[str]) -> list[tuple[str, float]]:
    """Global attribution: one entry per feature, largest first. The list is as long as the
    feature list, so it is no matter of data size."""
    trees = next(s for s in model.stages if hasattr(s, "featureImportances"))
    weights = trees.featureImportances.toArray()
    return sorted(zip(features, map(float, weights)), key=lambda x: (-x[1], x[0]))
