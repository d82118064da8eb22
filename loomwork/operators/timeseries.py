"""Log rows as labelled time series; selection and downsampling."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwork.functions.text import epoch_ms, label_text

# Series names and their labels, in order.
TRAIN_SERIES = ("train_metrics", ["uid", "total_steps", "current_steps", "loss", "learning_rate", "epoch"])
EVAL_SERIES = ("eval_metrics", ["uid", "total_steps", "current_steps", "eval_loss", "eval_perplexity", "epoch"])
NAME_LABEL = "__name__"


def _label(name: str, value: Column) -> Column:
    return F.struct(F.lit(name).alias("name"), value.alias("value"))


def _series(logs: DataFrame, spec: tuple[str, list[str]], ts: str) -> DataFrame:
    name, labels = spec
    return logs.select(
        F.array(_label(NAME_LABEL, F.lit(name)), *(_label(c, label_text(c)) for c in labels)).alias("labels"),
        F.array(F.struct(F.lit(1.0).alias("value"), epoch_ms(ts).alias("timestamp"))).alias("samples"),
    )


def train_series(logs: DataFrame, ts: str = "ts") -> DataFrame:
    """One series per train row: the numbers are labels, the sample is 1 at the time of the event."""
    return _series(logs, TRAIN_SERIES, ts)


def eval_series(logs: DataFrame, ts: str = "ts") -> DataFrame:
    return _series(logs, EVAL_SERIES, ts)


def label_value(name: str) -> Column:
    """Value of a label; an absent label is the empty string."""
    found = F.filter("labels", lambda x: x["name"] == name)
    return F.coalesce(F.try_element_at(found, F.lit(1))["value"], F.lit(""))


@dataclass(frozen=True)
class Matcher:
    """``kind`` is EQ, NEQ, RE or NRE; regular expressions match the whole value."""

    kind: str
    name: str
    value: str

    def predicate(self) -> Column:
        value = label_value(self.name)
        whole = value.rlike(rf"^(?:{self.value})\z")
        try:
            return {"EQ": value == self.value, "NEQ": value != self.value, "RE": whole, "NRE": ~whole}[self.kind]
        except KeyError:
            raise ValueError(f"unknown matcher kind {self.kind!r}") from None


def match_series(series: DataFrame, matchers: list[Matcher]) -> DataFrame:
    """Series all matchers accept."""
    return series.filter(reduce(Column.__and__, (m.predicate() for m in matchers), F.lit(True)))


def select_range(series: DataFrame, start_ms: int, end_ms: int) -> DataFrame:
    """Samples within the range, both ends included; series without any are dropped."""
    kept = F.filter("samples", lambda s: s["timestamp"].between(start_ms, end_ms))
    return series.withColumn("samples", kept).filter(F.size("samples") > 0)


def samples(series: DataFrame) -> DataFrame:
    """One row per sample, labels in name order."""
    ordered = F.sort_array("labels")
    return series.select(ordered.alias("labels"), F.explode("samples").alias("_s")).select(
        "labels", F.col("_s.timestamp").alias("timestamp"), F.col("_s.value").alias("value"))


def group_series(series: DataFrame, part_ms: int = 86_400_000) -> DataFrame:
    """Samples of equal label sets together, by time, one row per label set and stretch of ``part_ms``.

    ``part_start`` is the first millisecond of the stretch. Rows are bounded by time, whatever the length of a
    series, so none has to fit into one task.
    """
    rows = samples(series).withColumn("part_start", F.floor(F.col("timestamp") / part_ms) * part_ms)
    return (
        rows.groupBy("labels", "part_start")
        .agg(F.sort_array(F.collect_list(F.struct("timestamp", "value"))).alias("_samples"))
        .select("labels", "part_start", F.transform("_samples", lambda s: F.struct(s["value"], s["timestamp"])).alias("samples"))
    )


# Functions of a step, of the value and time columns.
STEP_FUNCTIONS = {
    "avg": lambda value, ts: F.avg(value), "min": lambda value, ts: F.min(value), "max": lambda value, ts: F.max(value),
    "sum": lambda value, ts: F.sum(value), "count": lambda value, ts: F.count(value),
    "last": lambda value, ts: F.max_by(value, F.struct(ts, value)),
}


def downsample_all(points: DataFrame, by: list[str], step_ms: int, funcs: list[str], start_ms: int = 0,
                   ts: str = "timestamp", value: str = "value") -> DataFrame:
    """One column per function and step, from one aggregate."""
    for func in funcs:
        if func not in STEP_FUNCTIONS:
            raise ValueError(f"unknown function {func!r}; known: {', '.join(STEP_FUNCTIONS)}")
    bucket = (F.floor((F.col(ts) - start_ms) / step_ms) * step_ms + start_ms).alias("bucket_ms")
    return points.groupBy(*by, bucket).agg(*(STEP_FUNCTIONS[f](value, ts).alias(f) for f in funcs))


def downsample(points: DataFrame, by: list[str], step_ms: int, func: str = "avg", start_ms: int = 0,
               ts: str = "timestamp", value: str = "value") -> DataFrame:
    """One value per step: avg, min, max, sum, count or last."""
    return downsample_all(points, by, step_ms, [func], start_ms, ts, value).withColumnRenamed(func, "value")


@dataclass(frozen=True)
class Query:
    """A range query: matchers, bounds in ms, and optionally a step with a function."""

    start_ms: int
    end_ms: int
    matchers: tuple[Matcher, ...] = ()
    step_ms: int | None = None
    func: str = "avg"


def run_query(series: DataFrame, query: Query) -> DataFrame:
    """Sample rows of the matching series in range, downsampled when a step is given."""
    hits = samples(select_range(match_series(series, list(query.matchers)), query.start_ms, query.end_ms))
    if query.step_ms is None:
        return hits
    return downsample(hits, ["labels"], query.step_ms, query.func, query.start_ms)


def unpivot_metrics(logs: DataFrame, metrics: list[str], ts: str = "ts") -> DataFrame:
    """Numbers as values: ``(uid, metric, timestamp, value)``, missing ones left out."""
    wide = logs.select("uid", epoch_ms(ts).alias("timestamp"), *(F.col(m).cast("double") for m in metrics))
    return wide.unpivot(["uid", "timestamp"], metrics, "metric", "value").filter(F.col("value").isNotNull())
