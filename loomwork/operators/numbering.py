"""Places in a total order over a whole table, without one task that sees it all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwork.session import scratch_path


def number_rows(df: DataFrame, order: list[Column], out: str) -> DataFrame:
    """Add ``out``: 1, 2, 3 ... in the given order, which must be total.

    Rows go to range partitions, are sorted there and written down with the number of their partition and their place in it, so that
    neither a lost executor nor a second look changes them. Before a row stand the rows of the partitions before its own: one small number each.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "ranges")
    # An increasing id holds the partition in its upper bits and counts the rows of it in the lower 33.
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    placed.write.parquet(path)
    ranged = spark.read.parquet(path).withColumn("_range", F.shiftright("_at", 33))
    sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("n")).orderBy("_range").collect()
    before, total = [], 0
    for row in sizes:
        before.append((row["_range"], total))
        total += row["n"]
    offsets = spark.createDataFrame(before, "_range bigint, _before bigint")
    place = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + F.col("_before") + 1
    return ranged.join(F.broadcast(offsets), "_range").withColumn(out, place).drop("_at", "_range", "_before")
