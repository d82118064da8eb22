"""Dataset plug-ins: a name and a text of parameters stand for a DataFrame.

A plug-in is either a function that returns a DataFrame or, where rows come from something Spark has no reader for, a
``Feed``: how to cut the rows into parts and how to read one part. A feed becomes a data source of its own name, so
``spark.read.format(name)`` plans it, one task per part, and ``spark.readStream.format(name)`` follows it.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from loomwork.sources import sft

DatasetPlugin = Callable[[SparkSession, str], DataFrame]

DATASETS: dict[str, DatasetPlugin] = {
    "csv": lambda spark, path: sft.read_sft_csv(spark, path),
    "parquet": lambda spark, path: sft.read_sft_table(spark, path, "parquet"),
    "json": lambda spark, path: sft.read_sft_table(spark, path, "json"),
}


def register_dataset(name: str, plugin: DatasetPlugin) -> None:
    DATASETS[name] = plugin


def load_dataset(spark: SparkSession, name: str, parameters: str = "") -> DataFrame:
    if name not in DATASETS:
        raise ValueError(f"no dataset plug-in named {name!r}; known: {', '.join(DATASETS)}")
    return DATASETS[name](spark, parameters)


# ---------------------------------------------------------------- feeds

@dataclass(frozen=True)
class Feed:
    """``parts(parameters)`` lists the parts there are now, as JSON values in a fixed order that only ever grows;
    ``read(parameters, part)`` yields the rows of one of them as Arrow batches of ``schema``.

    Both run outside Spark's planner, ``read`` in the task that its part has become. A part is read again when its task is.
    """

    schema: str
    parts: Callable[[str], list]
    read: Callable[[str, object], Iterator[pa.RecordBatch]]


class _Part(InputPartition):
    def __init__(self, value: object):
        super().__init__(json.dumps(value))


class _Reader(DataSourceReader):
    def __init__(self, feed: Feed, parameters: str):
        self.feed, self.parameters = feed, parameters

    def partitions(self) -> list[InputPartition]:
        return [_Part(p) for p in self.feed.parts(self.parameters)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if partition is not None:  # Spark asks so where there are no parts
            yield from self.feed.read(self.parameters, json.loads(partition.value))


class _StreamReader(DataSourceStreamReader):
    """Offsets count the parts seen; a batch is the parts between two of them, at most ``most`` at a time."""

    def __init__(self, feed: Feed, parameters: str, most: int | None):
        self.feed, self.parameters, self.most = feed, parameters, most
        self.at: int | None = None

    def initialOffset(self) -> dict:
        return {"parts": 0}

    def latestOffset(self) -> dict:
        there = len(self.feed.parts(self.parameters))
        if self.most is not None:
            there = min(there, (self.at or 0) + self.most)
        self.at = there
        return {"parts": there}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        self.at = max(self.at or 0, end["parts"])
        return [_Part(p) for p in self.feed.parts(self.parameters)[start["parts"]:end["parts"]]]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        yield from self.feed.read(self.parameters, json.loads(partition.value))

    def commit(self, end: dict) -> None:
        pass


def register_feed(spark: SparkSession, name: str, feed: Feed) -> None:
    """Make ``feed`` a format of this session and a dataset plug-in, both under ``name``.

    Options of the format: ``parameters``, and for streams ``maxPartsPerTrigger``.
    """

    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return feed.schema

        def reader(self, schema: StructType) -> DataSourceReader:
            return _Reader(feed, self.options.get("parameters", ""))

        def streamReader(self, schema: StructType) -> DataSourceStreamReader:
            most = self.options.get("maxPartsPerTrigger")
            return _StreamReader(feed, self.options.get("parameters", ""), None if most is None else int(most))

    spark.dataSource.register(Source)
    register_dataset(name, lambda session, parameters: session.read.format(name).option("parameters", parameters).load())
