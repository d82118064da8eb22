"""Training logs: routing, normalising, progress, summaries, curves, state changes.

Per-run facts are aggregates joined back, not windows over a whole run: an aggregate combines on
the map side and a join lets AQE split a run that holds much of the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomwork import schemas
from loomwork.functions.text import col, format_duration, percent
from loomwork.operators import blocks

HOUR = 3600.0

# Metric names as the training loop prints them and as the log schemas call them.
RAW_NAMES = {
    "eval_rouge_1": "eval_rouge-1", "eval_rouge_2": "eval_rouge-2",
    "eval_rouge_l": "eval_rouge-l", "eval_bleu_4": "eval_bleu-4",
}


def micros(ts: Column | str) -> Column:
    return F.unix_micros(col(ts).cast("timestamp"))


def seconds(ts: Column | str) -> Column:
    return micros(ts) / 1e6


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """The difference is taken in microseconds: epoch seconds as doubles would lose them."""
    return (micros(end) - micros(start)) / 1e6


def route_logs(df: DataFrame) -> DataFrame:
    """Add ``kind``: eval when the row carries an evaluation loss, else train."""
    return df.withColumn("kind", F.when(F.col("eval_loss").isNotNull(), F.lit("eval")).otherwise(F.lit("train")))


def route_lines(lines: DataFrame, line: str = "value") -> DataFrame:
    """The same on raw JSON lines, where the key may be present with a null."""
    has_key = F.array_contains(F.json_object_keys(F.col(line)), "eval_loss")
    return lines.withColumn("kind", F.when(has_key, F.lit("eval")).otherwise(F.lit("train")))


def parse_lines(lines: DataFrame, line: str = "value") -> DataFrame:
    """JSON log lines to raw log columns plus ``kind``."""
    parsed = route_lines(lines, line).select(F.from_json(line, schemas.RAW_LOG).alias("_log"), "kind")
    return parsed.select("_log.*", "kind")


def _timing(df: DataFrame) -> DataFrame:
    """Add elapsed, per-step and remaining seconds and the percentage from ``started_at`` and ``ts``."""
    elapsed = seconds_between("started_at", "ts")
    step = F.coalesce(F.col("elapsed_seconds") / F.nullif(F.col("current_steps"), F.lit(0)), F.lit(0.0))
    return (
        df.withColumn("elapsed_seconds", elapsed)
        .withColumn("seconds_per_step", step)
        .withColumn("remaining_seconds", (F.col("total_steps") - F.col("current_steps")) * F.col("seconds_per_step"))
        .withColumn("percentage", percent("current_steps", "total_steps"))
        .withColumn("elapsed_time", format_duration("elapsed_seconds"))
        .withColumn("remaining_time", format_duration("remaining_seconds"))
    )


def progress(logs: DataFrame, starts: DataFrame | None = None) -> DataFrame:
    """Elapsed and remaining time of every log row.

    A run starts at ``starts`` ``(uid, started_at)``, or at its first log row.
    """
    if "started_at" not in logs.columns:
        if starts is None:
            starts = logs.groupBy("uid").agg(F.min("ts").alias("started_at"))
        logs = logs.join(starts, "uid")
    return _timing(logs)


def train_logs(logs: DataFrame) -> DataFrame:
    """Train rows in the 17-field log schema."""
    return _shape(logs, schemas.TRAIN_LOG, {"val_perplexity": "eval_perplexity"})


def eval_logs(logs: DataFrame) -> DataFrame:
    """Evaluation rows in the 13-field log schema."""
    return _shape(logs, schemas.EVAL_LOG, {})


def _shape(logs: DataFrame, schema, renamed: dict[str, str]) -> DataFrame:
    names = {**RAW_NAMES, **renamed}

    def field(f) -> Column:
        raw = names.get(f.name, f.name)
        value = F.col(f"`{raw}`") if raw in logs.columns else F.lit(None)
        return value.cast(f.dataType).alias(f.name)
    return logs.select(*(field(f) for f in schema))


def normalize_logs(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Raw log rows to ``(train rows, eval rows)``."""
    rows = progress(raw if "kind" in raw.columns else route_logs(raw))
    return train_logs(rows.filter(F.col("kind") == "train")), eval_logs(rows.filter(F.col("kind") == "eval"))


def eval_metrics(df: DataFrame, by: list[str], loss: str = "eval_loss") -> DataFrame:
    """Mean loss and its exponential per group; an overflowing perplexity is Infinity."""
    return df.groupBy(*by).agg(F.avg(loss).alias("eval_loss")).withColumn("eval_perplexity", F.exp("eval_loss"))


def eval_speed(df: DataFrame, by: list[str], batch: int, world: int, runtime: str = "runtime") -> DataFrame:
    """Samples, steps and both per second of each evaluation; ``runtime`` is its length in seconds."""
    grouped = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_samples"), F.max(runtime).alias("runtime"))
    time = F.nullif(F.col("runtime"), F.lit(0.0))
    return (
        grouped.withColumn("n_steps", F.ceil(F.col("n_samples") / (batch * world)))
        .withColumn("samples_per_second", F.round(F.col("n_samples") / time, 3))
        .withColumn("steps_per_second", F.round(F.col("n_steps") / time, 3))
    )


def run_summary(logs: DataFrame) -> DataFrame:
    """Counts, extremes and last values per run. A last value is that of the last row that has one."""
    def last(name: str) -> Column:
        return F.max_by(name, F.when(F.col(name).isNotNull(), F.col("current_steps"))).alias(f"last_{name}")

    return logs.groupBy("uid").agg(
        F.count(F.lit(1)).alias("n_logs"),
        F.max("current_steps").alias("last_step"), last("loss"),
        F.min("loss").alias("min_loss"), F.avg("loss").alias("mean_loss"),
        last("learning_rate"), last("epoch"),
    )


def curve(logs: DataFrame, metric: str, every: int, smooth: int = 0, block: int = 65536) -> DataFrame:
    """Mean of a metric per step bucket, and its mean over the bucket and the ``smooth`` before it.

    The trailing window runs inside blocks of buckets, each longer than the window; a block is handed the last
    ``smooth`` buckets of the one before, so a run of any length is spread out and no seam shows.
    """
    block = max(block, 4 * smooth)
    points = (
        logs.withColumn("bucket", F.floor(F.col("current_steps") / every))
        .groupBy("uid", "bucket").agg(F.avg(metric).alias("value"))
    )
    home = F.floor(F.col("bucket") / block)
    reach = F.floor((F.col("bucket") + smooth) / block)
    placed = points.withColumn("_home", home).withColumn(
        "_block", F.explode(F.when(reach > home, F.array(home, reach)).otherwise(F.array(home))))
    w = Window.partitionBy("uid", "_block").orderBy("bucket").rangeBetween(-smooth, 0)
    return (
        placed.withColumn("smoothed", F.avg("value").over(w))
        .filter(F.col("_home") == F.col("_block"))
        .select("uid", "bucket", (F.col("bucket") * every).alias("step"), "value", "smoothed")
    )


def state_changes(df: DataFrame, key: str, order: str, cols: list[str], include_first: bool = False,
                  width: float = HOUR, hot_rows: int = blocks.HOT_ROWS) -> DataFrame:
    """Rows whose ``cols`` differ from the row before of the same key, with ``previous``.

    The first row of a key counts only on request. ``order`` is a time, or a number if ``width``
    counts in its units.
    """
    kind = df.schema[order].dataType.typeName()
    position = seconds(order) if kind.startswith("timestamp") else F.col(order)
    tagged = blocks.add_blocks(df, [key], position, width, hot_rows)
    seen = blocks.drop_blocks(blocks.previous_row(tagged, [key], order, cols, "previous"))
    first = F.col("previous").isNull()
    changed = ~first & ~F.col("previous").eqNullSafe(F.struct(*cols))
    return seen.filter(changed | first if include_first else changed)


def number_steps(df: DataFrame, key: str, order: str, out: str = "current_steps", width: float = HOUR,
                 hot_rows: int = blocks.HOT_ROWS) -> DataFrame:
    """Add the 1-based step number of each row within its run, by time."""
    tagged = blocks.add_blocks(df, [key], seconds(order), width, hot_rows)
    return blocks.drop_blocks(blocks.row_index(tagged, [key], [order], out)).withColumn(out, F.col(out) + 1)
