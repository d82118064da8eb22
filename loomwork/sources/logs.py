"""Log streams, predictions and time series on disk."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loomwork import schemas
from loomwork.operators import telemetry

# Folder and names of the two log streams and of the predictions.
WATCH = "watch"
TRAIN_FILE = "trainer_log.jsonl"
EVAL_FILE = "eval_log.jsonl"
PREDICTIONS_FILE = "generated_predictions.jsonl"

JSON_NULLS = {"ignoreNullFields": "false"}


def write_logs(raw: DataFrame, folder: str, overwrite: bool = False) -> None:
    """Append raw log rows to the train and eval streams as JSON lines, nulls written out."""
    train, evaluation = telemetry.normalize_logs(raw)
    mode = "overwrite" if overwrite else "append"
    for rows, name in ((train, TRAIN_FILE), (evaluation, EVAL_FILE)):
        rows.write.mode(mode).options(**JSON_NULLS).json(f"{folder}/{WATCH}/{name}")


def read_logs(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    return (
        spark.read.schema(schemas.TRAIN_LOG).json(f"{folder}/{WATCH}/{TRAIN_FILE}"),
        spark.read.schema(schemas.EVAL_LOG).json(f"{folder}/{WATCH}/{EVAL_FILE}"),
    )


def write_predictions(pairs: DataFrame, folder: str) -> None:
    """Text pairs as JSON lines ``{"label", "predict"}``; other alphabets are kept as they are."""
    pairs.select("label", "predict").write.mode("overwrite").options(**JSON_NULLS).json(f"{folder}/{PREDICTIONS_FILE}")


def read_predictions(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(schemas.PREDICTION).json(f"{folder}/{PREDICTIONS_FILE}")


def write_timeseries(series: DataFrame, path: str, mode: str = "append") -> None:
    series.select("labels", "samples").write.mode(mode).parquet(path)


def read_timeseries(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.TIME_SERIES).parquet(path)
