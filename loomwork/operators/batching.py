"""Shards, batches and padding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomwork.functions import arrays
from loomwork.functions.arrays import IGNORE_INDEX
from loomwork.operators import blocks

# Fixed value: batches are padded to a multiple of this length.
PAD_MULTIPLE = 4

HASH_BLOCKS = 4096


def _is_int(df: DataFrame, key: str) -> bool:
    return isinstance(df.schema[key].dataType, T.IntegralType)


def assign_shards(df: DataFrame, n: int, key: str) -> DataFrame:
    """Add ``shard`` in ``[0, n)``: by remainder of an integer key, else by hash."""
    number = F.col(key) if _is_int(df, key) else F.xxhash64(key)
    return df.withColumn("shard", F.pmod(number, F.lit(n)).cast("int"))


def assign_batches(df: DataFrame, batch: int, key: str, by: tuple[str, ...] = ("shard",),
                   width: float | None = None, hot_rows: int = blocks.HOT_ROWS) -> DataFrame:
    """Add ``batch_id``: consecutive runs of ``batch`` rows inside each shard.

    Rows are ordered by an integer key, or by the hash of any other key. ``key`` must be unique.
    A shard beyond ``hot_rows`` rows is numbered in blocks: ``width`` units of an integer key each,
    sorted blocks when no width is given, or equal shares of the hash range.
    """
    keys: list[str] = list(by)
    order: list[str | Column] = [key]
    if not _is_int(df, key):
        df = df.withColumn("_hash", F.xxhash64(key))
        order = ["_hash", key]
        # Hashes cover the whole signed range; halved and shifted they start at 0.
        tagged = blocks.add_blocks(df, keys, F.col("_hash") / 2.0 + 2.0**62, 2.0**63 / HASH_BLOCKS, hot_rows)
    elif width:
        tagged = blocks.add_blocks(df, keys, F.col(key), width, hot_rows)
    else:
        tagged = blocks.add_sorted_blocks(df, keys, order, hot_rows)
    numbered = blocks.drop_blocks(blocks.row_index(tagged, keys, order, "_row"))
    return numbered.withColumn("batch_id", F.floor(F.col("_row") / batch)).drop("_row", "_hash")


def shard_plan(df: DataFrame, batch: int, by: tuple[str, ...] = ("shard",)) -> DataFrame:
    """Rows and steps per epoch of each shard."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "steps_per_epoch", F.ceil(F.col("n_rows") / batch))


def collate(df: DataFrame, pad_id: int, multiple: int = PAD_MULTIPLE, side: str = "right",
            by: tuple[str, ...] = ("shard", "batch_id")) -> DataFrame:
    """Pad every example to the longest of its batch, rounded up to ``multiple``.

    The window holds one batch, so its size is the batch size.
    """
    longest = F.max(F.size("input_ids")).over(Window.partitionBy(*by))
    padded = (F.ceil(longest / multiple) * multiple).cast("int")
    pad = arrays.pad_right if side == "right" else arrays.pad_left
    n = F.col("padded_length")
    return (
        df.withColumn("padded_length", padded)
        .withColumn("input_ids", pad("input_ids", n, pad_id))
        .withColumn("labels", pad("labels", n, IGNORE_INDEX))
        .withColumn("attention_mask", pad("attention_mask", n, 0))
    )
