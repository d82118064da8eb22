"""Ordered per-key work that survives a hot key.

A window over one key sorts that key in one task. ``add_blocks`` looks for keys with more than
``hot_rows`` rows or ``HOT_BYTES`` of text (one map-side combined count, run at once). Without any, nothing is
added and the functions below are plain windows, so steps on the same key share one shuffle.
Otherwise hot keys are cut into blocks along their order, the window runs per block, and one
small row per block carries the neighbour's edge row or the running total across. Both ways give the same rows.

The row set is never changed. Orders must be unique within a key.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from loomwork.session import shared_dir

HOT_ROWS = 1_000_000
HOT_BYTES = 1 << 30
BLOCK = "_block"


def _hot_keys(df: DataFrame, keys: list[str], hot_rows: int) -> DataFrame | None:
    """Keys above a limit: at most rows / hot_rows + bytes / HOT_BYTES of them, which is what makes a broadcast safe."""
    texts = [F.coalesce(F.octet_length(f.name), F.lit(0)).cast("bigint") for f in df.schema
             if f.dataType.typeName() == "string" and f.name not in keys]
    volume = F.sum(sum(texts, F.lit(0).cast("bigint")))
    hot = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"), volume.alias("_bytes")).filter(
        (F.col("_rows") > hot_rows) | (F.col("_bytes") > HOT_BYTES)).select(*keys, F.lit(True).alias("_hot"))
    return None if hot.isEmpty() else hot


def add_blocks(df: DataFrame, keys: list[str], order: Column, width: float, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Add ``_block`` if there are hot keys: ``floor(order / width)`` for them, null for the others."""
    hot = _hot_keys(df, keys, hot_rows)
    if hot is None:
        return df
    block = F.floor(order / F.lit(width)).cast("bigint")
    return df.join(F.broadcast(hot), keys, "left").withColumn(BLOCK, F.when(F.col("_hot"), block)).drop("_hot")


def add_sorted_blocks(df: DataFrame, keys: list[str], order: list[str | Column],
                      hot_rows: int = HOT_ROWS) -> DataFrame:
    """The same for an order that has no number to divide, such as score, then name.

    Rows of hot keys are range-partitioned by key and order, and the partition number is the
    block. It is fixed by a checkpoint, so a lost executor cannot change it.
    """
    hot = _hot_keys(df, keys, hot_rows)
    if hot is None:
        return df
    shared_dir(df.sparkSession)
    tagged = df.join(F.broadcast(hot), keys, "left")
    ranged = (
        tagged.filter(F.col("_hot")).drop("_hot").repartitionByRange(*keys, *order)
        .withColumn(BLOCK, F.spark_partition_id().cast("bigint")).checkpoint()
    )
    ordinary = tagged.filter(F.col("_hot").isNull()).drop("_hot").withColumn(BLOCK, F.lit(None).cast("bigint"))
    return ordinary.unionByName(ranged)


def has_blocks(df: DataFrame) -> bool:
    return BLOCK in df.columns


def hot_part(df: DataFrame) -> DataFrame:
    """The rows of hot keys."""
    return df.filter(F.col(BLOCK).isNotNull())


def drop_blocks(df: DataFrame) -> DataFrame:
    return df.drop(BLOCK)


def in_block(df: DataFrame, keys: list[str]) -> WindowSpec:
    """The window of a key, or of one block of it."""
    return Window.partitionBy(*keys, BLOCK) if has_blocks(df) else Window.partitionBy(*keys)


def _attach(df: DataFrame, carry: DataFrame, keys: list[str], out: str, merge: Callable[[Column, Column], Column]) -> DataFrame:
    # Same keys as the window, so the large side is not shuffled again. Ordinary keys match nothing.
    joined = df.join(carry, [*keys, BLOCK], "left")
    return joined.withColumn(out, merge(F.col(out), F.col("_carry"))).drop("_carry")


def _neighbour(df: DataFrame, keys: list[str], order: str, cols: list[str], out: str, ahead: bool) -> DataFrame:
    step, edge = (F.lead, F.min_by) if ahead else (F.lag, F.max_by)
    row = F.struct(*cols)
    inside = df.withColumn(out, step(row).over(in_block(df, keys).orderBy(order)))
    if not has_blocks(df):
        return inside
    carry = (
        hot_part(df).groupBy(*keys, BLOCK).agg(edge(row, F.col(order)).alias("_edge"))
        .withColumn("_carry", step("_edge").over(Window.partitionBy(*keys).orderBy(BLOCK)))
        .filter(F.col("_carry").isNotNull()).drop("_edge")
    )
    return _attach(inside, carry, keys, out, F.coalesce)


def next_row(df: DataFrame, keys: list[str], order: str, cols: list[str], out: str) -> DataFrame:
    """Add ``out``: struct of ``cols`` of the following row of the key, null at its end."""
    return _neighbour(df, keys, order, cols, out, True)


def previous_row(df: DataFrame, keys: list[str], order: str, cols: list[str], out: str) -> DataFrame:
    """Add ``out``: struct of ``cols`` of the preceding row of the key, null at its start."""
    return _neighbour(df, keys, order, cols, out, False)


def running_total(df: DataFrame, keys: list[str], order: list[str | Column], value: Column, out: str) -> DataFrame:
    """Add ``out``: sum of ``value`` (an integer) over the rows of the key before this one."""
    rows = in_block(df, keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inside = df.withColumn(out, F.coalesce(F.sum(value).over(rows), F.lit(0)).cast("bigint"))
    if not has_blocks(df):
        return inside
    before = Window.partitionBy(*keys).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        hot_part(df).groupBy(*keys, BLOCK).agg(F.sum(value).alias("_total"))
        .withColumn("_carry", F.sum("_total").over(before)).drop("_total")
    )
    return _attach(inside, carry, keys, out, lambda a, b: (a + F.coalesce(b, F.lit(0))).cast("bigint"))


def row_index(df: DataFrame, keys: list[str], order: list[str | Column], out: str) -> DataFrame:
    """Add ``out``: 0-based position of the row within its key."""
    return running_total(df, keys, order, F.lit(1), out)
