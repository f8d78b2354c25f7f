"""Model metrics as ``(metric_name, metric_value)`` rows, computed from a table of predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchflow.operators.running import Total, running


def _long(metrics: DataFrame) -> DataFrame:
    doubles = metrics.select([F.col(c).cast("double").alias(c) for c in metrics.columns])
    return doubles.unpivot([], doubles.columns, "metric_name", "metric_value")


def classification_metrics(
    scored: DataFrame, label: str, prediction: str, probability: Column | None = None
) -> DataFrame:
    """Accuracy, macro precision, recall and F1, and log loss if the probability of the true
    label is given.

    One pass counts (label, prediction) pairs; everything else is arithmetic on that small table.
    """
    loss = F.sum(-F.ln(F.greatest(probability, F.lit(1e-15)))) if probability is not None else F.lit(None)
    pairs = scored.groupBy(F.col(label).alias("l"), F.col(prediction).alias("p")).agg(
        F.count(F.lit(1)).alias("n"), loss.cast("double").alias("loss")
    )
    hit = F.when(F.col("l").eqNullSafe(F.col("p")), F.col("n")).otherwise(F.lit(0))
    # each pair counts towards its label and towards its prediction
    sides = F.array(
        F.struct(F.col("l").alias("c"), F.col("n").alias("actual"), F.lit(0).cast("bigint").alias("said"), hit.alias("hit")),
        F.struct(F.col("p").alias("c"), F.lit(0).cast("bigint").alias("actual"), F.col("n").alias("said"), F.lit(0).cast("bigint").alias("hit")),
    )
    classes = (
        pairs.select(F.explode(sides).alias("s"), "loss")
        .groupBy("s.c")
        .agg(F.sum("s.actual").alias("actual"), F.sum("s.said").alias("said"), F.sum("s.hit").alias("hit"), F.sum("loss").alias("loss"))
    )
    precision = F.coalesce(F.try_divide("hit", "said"), F.lit(0.0))
    recall = F.coalesce(F.try_divide("hit", "actual"), F.lit(0.0))
    per_class = classes.select(
        "actual", "hit", "loss", precision.alias("precision"), recall.alias("recall")
    ).withColumn(
        "f1",
        F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), F.lit(0.0)),
    )
    metrics = per_class.agg(
        (F.sum("hit") / F.sum("actual")).alias("accuracy"),
        F.avg("precision").alias("precision"),
        F.avg("recall").alias("recall"),
        F.avg("f1").alias("f1_score"),
        # every pair's loss stands at its label and at its prediction
        *([(F.sum("loss") / 2 / F.sum("actual")).alias("log_loss")] if probability is not None else []),
    )
    return _long(metrics)


def roc_auc(scored: DataFrame, label: str, probability: str) -> DataFrame:
    """Area under the ROC curve of a 0/1 label, exact, with ties counted half.

    Rows are first counted per distinct probability; the ranks are a running sum over those.
    """
    counted = scored.groupBy(F.col(probability).alias("p")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )
    below = running(counted, [], ["p"], {"neg_upto": Total("neg")}, profile=scored.select(F.col(probability).alias("p")))
    # a positive beats every negative below it and half of its equals
    wins = F.sum(F.col("pos") * (F.col("neg_upto") - F.col("neg") / 2))
    pairs = F.sum(F.col("pos").cast("double")) * F.sum(F.col("neg").cast("double"))
    return _long(below.agg(F.try_divide(wins, pairs).alias("roc_auc")))


def regression_metrics(scored: DataFrame, label: str, prediction: str) -> DataFrame:
    """Mean absolute, squared and squared-log error, R2 and explained variance, from one pass."""
    y, f = F.col(label).cast("double"), F.col(prediction).cast("double")
    error = y - f
    log_error = F.log1p(F.greatest(y, F.lit(0.0))) - F.log1p(F.greatest(f, F.lit(0.0)))
    sums = scored.agg(
        F.avg(F.abs(error)).alias("mean_absolute_error"),
        F.avg(error * error).alias("mean_squared_error"),
        F.avg(log_error * log_error).alias("mean_squared_log_error"),
        F.var_pop(y).alias("__label"),
        F.var_pop(error).alias("__error"),
    )
    metrics = sums.select(
        "mean_absolute_error",
        "mean_squared_error",
        "mean_squared_log_error",
        (1 - F.try_divide("mean_squared_error", "__label")).alias("r2_score"),
        (1 - F.try_divide("__error", "__label")).alias("explained_variance"),
    )
    return _long(metrics)
