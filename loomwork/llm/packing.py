"""Hierarchical best-fit packing of token pieces into sequences of at most ``capacity`` tokens.

1. ``cut_pieces`` encodes every document and cuts only those longer than a sequence, the shorter piece first. What goes on
   are lengths and checksums, not ids.
2. Each partition packs its own pieces by best fit, longest first. Full pieces and bins with at most ``slack`` free tokens are
   emitted; every other bin becomes one item of its fill.
3. Items of several partitions meet in one (``merge`` times fewer tasks, never more than ``task_items`` items each) and are packed
   again as a whole, so places inside a bin only shift by the bin's own offset. This goes on until the items of one
   task are left, or a round with as few tasks as allowed saves less than one bin in a hundred.

Each round is written to the shared folder before the next reads it, so a lost executor cannot renumber bins.

Defined results: a null or empty text is its end id alone; equal rows are packed each; an empty table gives no rows. The
assignment depends on how the input is split, its quality hardly does.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.llm.tokens import default_vocabulary, encode_documents, slices
from loomwork.session import scratch_path

CAPACITY = 2048
SLACK = 8
MERGE = 8
TASK_ITEMS = 100_000
# Encoding takes some hundred bytes of arrays per byte of text at a time.
_TEXT_PART = 1 << 18

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def cut_lengths(n: int, capacity: int) -> list[int]:
    """Lengths of the pieces of ``n`` tokens: the remainder first, then full ones."""
    rest = n % capacity
    return ([rest] if rest else []) + [capacity] * (n // capacity)


def cut_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
               vocabulary: str | None = None) -> DataFrame:
    """One row per piece (``PIECES``), without a shuffle."""
    vocabulary = vocabulary or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end in slices(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist(), _TEXT_PART):
                ids, texts = (batch.column(i).slice(begin, end - begin).to_pylist() for i in (0, 1))
                rows = []
                for doc_id, raw in zip(ids, encode_documents(texts, vocabulary)):
                    at = 0
                    for i, n in enumerate(cut_lengths(len(raw) // 4, capacity)):
                        rows.append((doc_id, i, at, n, zlib.crc32(raw[4 * at:4 * (at + n)])))
                        at += n
                columns = list(zip(*rows))
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)],
                                                 ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(docs[id_col].cast("bigint").alias("doc_id"), docs[text_col].alias("text")).mapInArrow(run, PIECES)


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each item and the fill of each bin: longest first, each into the fullest bin that has room."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    fills: list[int] = []
    with_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms: list[int] = []  # sorted sizes of room that some bin has
    for item in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[item])
        at = bisect.bisect_left(rooms, n)
        if at < len(rooms):
            room = rooms[at]
            chosen = with_room[room].pop()
            if not with_room[room]:
                rooms.pop(at)
        else:
            room, chosen = capacity, len(fills)
            fills.append(0)
        bins[item], offsets[item] = chosen, fills[chosen]
        fills[chosen] += n
        left = room - n
        if left:
            if not with_room[left]:
                bisect.insort(rooms, left)
            with_room[left].append(chosen)
    return bins, offsets, np.array(fills, np.int64)


def _pack_partitions(items: DataFrame, length_col: str, level: int, capacity: int, slack: int) -> DataFrame:
    """Add ``_bin``, ``_at``, ``_fill`` and ``_done`` to each item, packing every partition by itself."""
    columns = items.columns
    place = columns.index(length_col)
    tagged = items.withColumn("_part", F.spark_partition_id().cast("bigint"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in items.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]  # lengths and keys of one partition only
        if not held:
            return
        table = pa.Table.from_batches(held)
        part = table.column(len(columns))[0].as_py()
        bins, offsets, fills = best_fit(table.column(place).to_numpy(), capacity)
        fill = fills[bins]
        table = table.select(columns)
        for name, values in (("_bin", (level << 58) + (part << 34) + bins), ("_at", offsets), ("_fill", fill), ("_done", fill >= capacity - slack)):
            table = table.append_column(name, pa.array(values))
        yield from table.to_batches(max_chunksize=50_000)

    return tagged.mapInArrow(run, f"{kinds}, _bin bigint, _at bigint, _fill bigint, _done boolean")


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def pack(pieces: DataFrame, length_col: str = "length", capacity: int = CAPACITY, slack: int = SLACK, merge: int = MERGE,
         task_items: int = TASK_ITEMS) -> DataFrame:
    """The pieces (columns kept) with ``sequence_id`` and ``offset``. Lengths are 1 to ``capacity``."""
    spark = pieces.sparkSession
    folder = scratch_path(spark, "packing")
    placed = _written(_pack_partitions(pieces, length_col, 0, capacity, slack), f"{folder}/level-0")
    levels, level = [], 0
    current = placed
    n_tasks = None
    while True:
        level += 1
        open_bins = current.filter(~F.col("_done")).select("_bin", "_fill").distinct()
        n = open_bins.count()
        if n == 0 or level > 15:
            break
        least = max(1, -(-n // task_items))
        n_tasks = max(least, -(-(n_tasks or max(1, pieces.rdd.getNumPartitions())) // merge))
        items = open_bins.withColumnsRenamed({"_bin": "_item", "_fill": "_size"}).repartition(n_tasks, F.xxhash64("_item", F.lit(level)))
        last = n_tasks == 1
        current = _written(_pack_partitions(items, "_size", level, capacity, slack), f"{folder}/level-{level}")
        levels.append(current)
        if last:
            break
        if n_tasks == least and current.select("_bin").distinct().count() > 0.99 * n:
            break
    out = placed.select(*pieces.columns, F.col("_bin").alias("_sequence"), F.col("_at").alias("_offset"))
    for step in levels:
        out = out.join(step.select("_item", "_bin", "_at"), F.col("_sequence") == F.col("_item"), "left").select(
            *pieces.columns, F.coalesce("_bin", "_sequence").alias("_sequence"),
            (F.col("_offset") + F.coalesce("_at", F.lit(0))).alias("_offset"))
    return out.withColumnsRenamed({"_sequence": "sequence_id", "_offset": "offset"})
