"""Writing tables: checked modes, not-null columns and batch-idempotent appends."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MODES = {"APPEND": "append", "TRUNCATE": "overwrite"}


def _mode(mode: str) -> str:
    if mode not in MODES:
        raise ValueError(f"write mode must be one of {sorted(MODES)}, not {mode!r}")
    return MODES[mode]


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` in its order and types; a null in a required column is an error."""
    return df.select(*[_conformed(f) for f in schema.fields])


def _conformed(field: T.StructField) -> Column:
    value = F.col(f"`{field.name}`").cast(field.dataType)
    if not field.nullable:
        value = F.coalesce(value, F.raise_error(F.lit(f"null in required column {field.name}")).cast(field.dataType))
    return value.alias(field.name)


def save_path(df: DataFrame, path: str, mode: str = "APPEND", schema: T.StructType | None = None) -> None:
    """Write Parquet files to a folder; APPEND adds rows, TRUNCATE replaces them."""
    mode = _mode(mode)
    (conform(df, schema) if schema else df).write.mode(mode).parquet(path)


def save_table(df: DataFrame, name: str, mode: str = "APPEND", schema: T.StructType | None = None) -> None:
    """Write a catalog table, creating its database if needed."""
    mode = _mode(mode)
    if "." in name:
        df.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS {name.rsplit('.', 1)[0]}")
    (conform(df, schema) if schema else df).write.mode(mode).format("parquet").saveAsTable(name)


def write_batch(df: DataFrame, path: str, batch_id: int, schema: T.StructType | None = None) -> None:
    """Append one micro-batch; a replay of the same batch replaces its own files only."""
    (conform(df, schema) if schema else df).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def save_metrics(metrics: DataFrame | Iterable[tuple[str, float]], path: str, spark=None) -> None:
    """Append ``(metric_name, metric_value)`` rows to the metrics table."""
    from matchflow.schemas import METRICS

    if not isinstance(metrics, DataFrame):
        metrics = spark.createDataFrame([(n, float(v)) for n, v in metrics], METRICS)
    save_path(metrics, path, "APPEND", METRICS)
