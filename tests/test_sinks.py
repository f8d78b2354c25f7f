import pytest
from pyspark.errors import PySparkException

from matchflow import schemas
from matchflow.sinks import tables


def test_modes(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1,)], "a int")
    tables.save_path(df, path)
    tables.save_path(df, path, "APPEND")
    assert spark.read.parquet(path).count() == 2
    tables.save_path(df, path, "TRUNCATE")
    assert spark.read.parquet(path).count() == 1
    with pytest.raises(ValueError, match="APPEND"):
        tables.save_path(df, path, "MERGE")


def test_catalog_table_in_a_new_database(spark):
    df = spark.createDataFrame([(1,)], "a int")
    tables.save_table(df, "sports_test.history", "TRUNCATE")
    tables.save_table(df, "sports_test.history")
    assert spark.table("sports_test.history").count() == 2
    spark.sql("DROP DATABASE sports_test CASCADE")


def test_required_columns(spark, tmp_path):
    good = spark.createDataFrame([("accuracy", 0.5)], "metric_name string, metric_value double")
    tables.save_path(good, str(tmp_path / "m"), "APPEND", schemas.METRICS)
    bad = spark.createDataFrame([("accuracy", None)], "metric_name string, metric_value double")
    with pytest.raises(PySparkException, match="metric_value"):
        tables.save_path(bad, str(tmp_path / "m"), "APPEND", schemas.METRICS)


def test_metrics_table(spark, tmp_path):
    path = str(tmp_path / "metrics")
    tables.save_metrics([("accuracy", 1)], path, spark)
    tables.save_metrics([("f1_score", 0.5)], path, spark)
    assert {(r.metric_name, r.metric_value) for r in spark.read.parquet(path).collect()} == {("accuracy", 1.0), ("f1_score", 0.5)}


def test_batch_write_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "b")
    df = spark.createDataFrame([(1,)], "a int")
    for batch in (0, 1, 1):
        tables.write_batch(df, path, batch)
    assert sorted(r.batch_id for r in spark.read.parquet(path).collect()) == [0, 1]


def test_conform_orders_and_casts(spark):
    df = spark.createDataFrame([(1, "2")], "b int, a string")
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.DoubleType())])
    assert tables.conform(df, schema).first().asDict() == {"a": 2, "b": 1.0}
