"""Instruction tables, splits and encoded shards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomwork import schemas
from loomwork.operators import ingest


def read_sft_csv(spark: SparkSession, path: str, multi_line: bool = True, columns: list[str] | None = None) -> DataFrame:
    """CSV with a header; every column is text, so a numeric-looking column stays usable.

    ``columns`` names the columns in file order: no file is read to find them, and a file whose header says otherwise is
    refused. Without it the header of one file counts for all. Quoted newlines need ``multi_line``, which reads one
    file per task: split large inputs into several files, or turn it off when no text holds a newline.
    """
    reader = (
        spark.read.option("header", True).option("multiLine", multi_line)
        .option("escape", '"').option("inferSchema", False).option("enforceSchema", False)
    )
    if columns:
        reader = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    return reader.csv(path)


def read_splits(spark: SparkSession, train: str, evaluation: str | None = None, features: dict[str, str] | None = None,
                multi_line: bool = True, columns: list[str] | None = None) -> DataFrame:
    """Train rows, and evaluation rows when a path is given, told apart by ``split``."""
    def one(path: str, split: str) -> DataFrame:
        return ingest.map_columns(read_sft_csv(spark, path, multi_line, columns), features).withColumn("split", F.lit(split))

    rows = one(train, "train")
    return rows.unionByName(one(evaluation, "evaluation"), allowMissingColumns=True) if evaluation else rows


def read_sft_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Nested instruction rows, ``history`` as an array of pairs."""
    return spark.read.format(fmt).schema(schemas.SFT).load(path)


def write_shards(df: DataFrame, path: str, key: str, files_per_shard: int | None = None, partitions: int | None = None) -> None:
    """Write ``split=/shard=`` folders.

    By default a shard gets as many tasks, and files, as its size asks for: the shuffle is rebalanced at run time, large
    shards split and small ones together. With ``files_per_shard`` rows go by (split, shard, slice of the key's hash).
    """
    if "split" not in df.columns:
        df = df.withColumn("split", F.lit("train"))
    if files_per_shard is None:
        df.hint("rebalance", "split", "shard").write.mode("overwrite").partitionBy("split", "shard").parquet(path)
        return
    piece = F.pmod(F.xxhash64(key), F.lit(files_per_shard))
    by = [F.col("split"), F.col("shard"), piece]
    spread = df.repartition(partitions, *by) if partitions else df.repartition(*by)
    spread.write.mode("overwrite").partitionBy("split", "shard").parquet(path)


def read_shard(spark: SparkSession, path: str, shard: int, split: str = "train") -> DataFrame:
    """One worker's rows; only its folder is read."""
    return spark.read.parquet(path).filter((F.col("split") == split) & (F.col("shard") == shard))
