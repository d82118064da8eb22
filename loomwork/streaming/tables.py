"""Tables that micro-batches append to.

Every micro-batch writes one folder named by its batch id, so replaying a batch after a failure overwrites
its own output and nothing else. Rows of a keyed table are never rewritten: the newest batch of a key wins
when the table is read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH = "batch"


def create(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """An empty version behind all others, so that a table no batch has reached can be read."""
    write_version(spark.createDataFrame([], schema), path, -1)


def write_version(df: DataFrame, path: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")


def read_versions(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All rows with the number of their batch in ``batch``."""
    return spark.read.schema(T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])).parquet(path)


def read_appended(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All versions together: the rows appended batch by batch."""
    return read_versions(spark, path, schema).drop(BATCH)


def read_latest(spark: SparkSession, path: str, schema: T.StructType, keys: list[str], before: int | None = None) -> DataFrame:
    """The row each key got last; ``before`` leaves out later batches, for a batch that is run again."""
    rows = read_versions(spark, path, schema)
    if before is not None:
        rows = rows.filter(F.col(BATCH) < before)
    others = [f.name for f in schema if f.name not in keys]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*others), BATCH).alias("_n"))
    return newest.select(*keys, "_n.*").select(*schema.names)


# ---------------------------------------------------------------- keyed tables that are folded now and then

FOLD_EVERY = 16


def write_keyed(df: DataFrame, path: str, batch_id: int, keys: list[str]) -> None:
    """One version of a keyed table; every ``FOLD_EVERY``-th one is followed by a whole copy, so that reading never
    looks at more than one copy and the versions behind it."""
    write_version(df, path, batch_id)
    if batch_id >= 0 and (batch_id + 1) % FOLD_EVERY == 0:
        write_version(read_keyed(df.sparkSession, path, df.schema, keys, batch_id), f"{path}-folded", batch_id)


def create_keyed(spark: SparkSession, path: str, schema: T.StructType) -> None:
    create(spark, path, schema)
    create(spark, f"{path}-folded", schema)


def read_keyed(spark: SparkSession, path: str, schema: T.StructType, keys: list[str], upto: int) -> DataFrame:
    """The row each key got last, up to version ``upto``."""
    folded = (upto + 1) // FOLD_EVERY * FOLD_EVERY - 1
    if folded == upto and upto >= 0:  # the copy of this very version may not stand yet
        folded -= FOLD_EVERY
    parts = [f"{path}-folded/{BATCH}={folded}", *(f"{path}/{BATCH}={i}" for i in range(folded + 1, upto + 1))]
    read = spark.read.schema(schema).parquet
    rows = read(parts[0]).withColumn(BATCH, F.lit(folded).cast("bigint"))
    for i, part in enumerate(parts[1:], folded + 1):
        rows = rows.unionByName(read(part).withColumn(BATCH, F.lit(i).cast("bigint")))
    others = [f.name for f in schema if f.name not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*others), BATCH).alias("_n")).select(*keys, "_n.*").select(*schema.names)
