"""Sinks: derived tables, tabular files, metrics JSON, feature names, model bundle."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def write_table(df: DataFrame, path: str | None = None, table: str | None = None,
                fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    """Create-or-replace a derived table (full refresh): a catalog table when
    ``table`` is given, otherwise files at ``path``."""
    writer = df.write.mode("overwrite").format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if table:
        writer.saveAsTable(table)
    else:
        writer.save(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Tabular file sink with a header row (one directory of part files); quotes inside a
    field are doubled, as ``readers.read_source`` reads them."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def _spark_type(value) -> T.DataType:
    if isinstance(value, dict):
        return T.StructType([T.StructField(k, _spark_type(v)) for k, v in value.items()])
    if isinstance(value, (list, tuple)):
        return T.ArrayType(_spark_type(value[0]) if value else T.StringType())
    if isinstance(value, bool):
        return T.BooleanType()
    if isinstance(value, int):
        return T.LongType()
    return T.DoubleType() if isinstance(value, float) else T.StringType()


def metrics_frame(spark: SparkSession, metrics: dict) -> DataFrame:
    """One-row DataFrame for a metrics dict; nested dicts become structs."""
    return spark.createDataFrame([metrics], _spark_type(metrics))


def write_metrics(spark: SparkSession, metrics: dict, path: str) -> None:
    metrics_frame(spark, metrics).coalesce(1).write.mode("overwrite").json(path)


def read_metrics(spark: SparkSession, path: str) -> dict:
    return spark.read.json(path).first().asDict(recursive=True)


def feature_names_frame(spark: SparkSession, names: list[str]) -> DataFrame:
    return spark.createDataFrame(list(enumerate(names)), "position int, feature string")


def save_bundle(model, metrics: dict, predictions: DataFrame, path: str) -> None:
    """Model pipeline, metrics, holdout predictions and feature names under
    one directory (use a shared folder on a cluster)."""
    spark = predictions.sparkSession
    base = path.rstrip("/")
    model.pipeline.write().overwrite().save(f"{base}/model")
    write_metrics(spark, metrics, f"{base}/metrics")
    write_csv(predictions, f"{base}/test_predictions")
    feature_names_frame(spark, model.feature_names()).coalesce(1).write.mode("overwrite") \
        .json(f"{base}/feature_names")


def load_bundle(spark: SparkSession, path: str) -> dict:
    """Read back the saved artifacts: model, metrics, predictions, names."""
    base = path.rstrip("/")
    return {
        "model": PipelineModel.load(f"{base}/model"),
        "metrics": read_metrics(spark, f"{base}/metrics"),
        "test_predictions": spark.read.option("header", True).option("inferSchema", True).option("escape", '"')
        .csv(f"{base}/test_predictions"),
        "feature_names": [r.feature for r in spark.read.json(f"{base}/feature_names")
                          .orderBy("position").select("feature").collect()],
    }


def read_artifacts(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """Artifact reader for the read-side operators: scores and contributions."""
    base = base.rstrip("/")
    return {
        "scores": spark.read.parquet(f"{base}/open_deal_scores"),
        "contributions": spark.read.parquet(f"{base}/top_contributions"),
        "metrics": spark.read.json(f"{base}/bundle/metrics"),
    }
