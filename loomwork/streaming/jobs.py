"""The streaming jobs. Each returns the started query; pass ``available_now`` to drain and stop.

State lives in Spark's state store (keyed aggregates for statuses and windows) or, for state changes, in tables that
batches append to. Results do not depend on how the input is cut into micro-batches or in which order rows arrive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from loomwork.operators import blocks, rollup, telemetry
from loomwork.streaming import tables


def _start(stream: DataFrame, handle, checkpoint: str, available_now: bool, mode: str = "append") -> StreamingQuery:
    writer = stream.writeStream.outputMode(mode).foreachBatch(handle).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


# ---------------------------------------------------------------- log ingest

def read_lines(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """JSON log lines arriving in a folder."""
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(folder)


def stream_logs(lines: DataFrame, out: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Raw JSON log lines to a train table and an eval table under ``out``.

    A line carries its run's start time, so timing needs no state across batches.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        rows = telemetry.progress(telemetry.parse_lines(batch)).persist()
        try:
            tables.write_version(
                telemetry.train_logs(rows.filter(F.col("kind") == "train")), f"{out}/train", batch_id)
            tables.write_version(
                telemetry.eval_logs(rows.filter(F.col("kind") == "eval")), f"{out}/eval", batch_id)
        finally:
            rows.unpersist()
    return _start(lines, handle, checkpoint, available_now)


# ---------------------------------------------------------------- state changes

US = "_us"
MARK = "settled_to bigint, first bigint, include_first boolean"


def _kinds(events_schema: T.StructType, key: str, cols: list[str]) -> dict[str, T.StructType]:
    """Schemas of the tables of a stream of changes: rows as they came, the newest settled row per key, changes."""
    field = lambda name, of: T.StructField(name, events_schema[of].dataType)
    row = [field(key, key), T.StructField(US, T.LongType()), *(field(c, c) for c in cols)]
    before = [field(f"previous_{c}", c) for c in cols]
    return {"rows": T.StructType(row), "late": T.StructType(row), "last": T.StructType(row), "changes": T.StructType(row + before)}


def _micros_of(spark: SparkSession, delay: str) -> int:
    start = F.timestamp_seconds(F.lit(0))
    return spark.range(1).select(F.unix_micros(start + F.expr(f"INTERVAL {delay}")) - F.unix_micros(start)).first()[0]


def _after_last(rows: DataFrame, last: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """Add ``_last``, the newest settled row of the key, null without one."""
    settled = last.select(F.col(key), F.struct(US, *cols).alias("_last"))
    return rows.join(settled, key, "left")


def _changes(rows: DataFrame, key: str, cols: list[str], include_first: Column, hot_rows: int) -> DataFrame:
    """Rows (key, time, values, ``_last``) that differ from the row before; before a key's first one stands ``_last``."""
    rows = rows.withColumn("_at", F.struct(US, *cols))
    cut = blocks.add_blocks(rows, [key], F.col(US), telemetry.HOUR * 1e6, hot_rows)
    seen = blocks.drop_blocks(blocks.previous_row(cut, [key], "_at", cols, "_before"))
    before = F.coalesce("_before", F.when(F.col("_last").isNotNull(), F.struct(*(F.col(f"_last.{c}").alias(c) for c in cols))))
    changed = F.when(before.isNull(), include_first).otherwise(~before.eqNullSafe(F.struct(*cols)))
    return seen.filter(changed).select(key, US, *cols, *(before[c].alias(f"previous_{c}") for c in cols))


def _waiting(spark: SparkSession, out: str, schema: T.StructType, first: int, upto: int) -> DataFrame:
    """Rows of the batches from ``first`` on, with the number of their batch. Earlier batches hold settled rows only."""
    paths = [f"{out}/rows/{tables.BATCH}={i}" for i in range(first, upto + 1)]
    whole = T.StructType([*schema.fields, T.StructField(tables.BATCH, T.LongType())])
    return spark.read.schema(whole).option("basePath", f"{out}/rows").parquet(*paths)


def stream_state_changes(events: DataFrame, key: str, order: str, cols: list[str], out: str, checkpoint: str, delay: str,
                         available_now: bool = True, include_first: bool = False, hot_rows: int = blocks.HOT_ROWS) -> StreamingQuery:
    """Rows whose ``cols`` differ from the row before of the same key, to tables under ``out``; read them with ``read_changes``.

    Batches append their rows to a table. Once the newest time less ``delay`` has passed a row, it is settled: its
    change, if it is one, is written once, and of each key only the newest settled row is kept as state. Rows not yet settled
    are read again from the batches that hold some, which ``delay`` bounds, whatever the length of a key's history. Windows run
    over blocks of a key's rows, so a hot key is many tasks.

    Rows of equal time are ordered by their values. A row older than a settled one of its key cannot be placed any
    more and goes to ``out/late``, and so does a row without a time. ``order`` is a timestamp.
    """
    spark = events.sparkSession
    kinds, reach = _kinds(events.schema, key, cols), _micros_of(spark, delay)
    for name in ("rows", "late", "changes"):
        tables.create(spark, f"{out}/{name}", kinds[name])
    tables.create_keyed(spark, f"{out}/last", kinds["last"])
    mark = lambda session, *values: session.createDataFrame([values], MARK)
    tables.write_version(mark(spark, None, 0, include_first), f"{out}/marks", -1)

    def handle(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        rows = batch.select(key, telemetry.micros(order).alias(US), *cols)
        tables.write_version(rows, f"{out}/rows", batch_id)
        # Batches are numbered without gaps, so the state before this one stands under the number before.
        former = session.read.schema(MARK).parquet(f"{out}/marks/{tables.BATCH}={batch_id - 1}").first()
        rows = _waiting(session, out, kinds["rows"], former["first"], batch_id)
        newest = rows.filter(F.col(tables.BATCH) == batch_id).agg(F.max(US)).first()[0]
        times = [t for t in (former["settled_to"], None if newest is None else newest - reach) if t is not None]
        settled_to = max(times) if times else None
        last = tables.read_keyed(session, f"{out}/last", kinds["last"], [key], batch_id - 1)
        fresh = F.col(tables.BATCH) == batch_id
        still = rows.filter(fresh | (F.lit(True) if former["settled_to"] is None else F.col(US) >= former["settled_to"]))
        late = fresh & F.coalesce(F.col(US) < F.col("_last")[US], F.col(US).isNull())
        placed = _after_last(still, last, key, cols).withColumn("_late", late)
        due = placed.filter(~F.col("_late") & (F.col(US) < settled_to)) if settled_to is not None else placed.filter(F.lit(False))
        due = due.persist()
        try:
            tables.write_version(placed.filter("_late").select(key, US, *cols), f"{out}/late", batch_id)
            tables.write_version(_changes(due, key, cols, F.lit(include_first), hot_rows), f"{out}/changes", batch_id)
            tables.write_keyed(due.groupBy(key).agg(F.max(F.struct(US, *cols)).alias("_n")).select(key, "_n.*"), f"{out}/last", batch_id, [key])
        finally:
            due.unpersist()
        first = rows.filter(F.lit(True) if settled_to is None else F.col(US) >= settled_to).agg(F.min(tables.BATCH)).first()[0]
        tables.write_version(mark(session, settled_to, batch_id + 1 if first is None else first, include_first), f"{out}/marks", batch_id)
    return _start(events, handle, checkpoint, available_now)


def read_changes(spark: SparkSession, out: str, events_schema: T.StructType, key: str, order: str, cols: list[str],
                 hot_rows: int = blocks.HOT_ROWS) -> tuple[DataFrame, DataFrame]:
    """``(changes, late rows)`` of ``stream_state_changes`` as they stand now: key, time, values, ``previous_<name>``.

    Changes among rows that are not settled yet are derived here, from those rows alone.
    """
    kinds = _kinds(events_schema, key, cols)
    marks = tables.read_versions(spark, f"{out}/marks", T.StructType.fromDDL(MARK))
    newest = marks.orderBy(F.col(tables.BATCH).desc()).first()
    batch_id = newest[tables.BATCH]
    changes = tables.read_appended(spark, f"{out}/changes", kinds["changes"]).select(*kinds["changes"].names)
    if batch_id >= newest["first"]:
        rows = _waiting(spark, out, kinds["rows"], newest["first"], batch_id)
        settled_to = F.lit(newest["settled_to"])
        open_ = rows.filter(F.col(US).isNotNull() & F.coalesce(F.col(US) >= settled_to, F.lit(True)))
        last = tables.read_keyed(spark, f"{out}/last", kinds["last"], [key], batch_id)
        changes = changes.unionByName(_changes(_after_last(open_, last, key, cols), key, cols, F.lit(newest["include_first"]), hot_rows))
    late = tables.read_appended(spark, f"{out}/late", kinds["late"])
    time = F.timestamp_micros(US).alias(order)
    return changes.select(key, time, *cols, *(f"previous_{c}" for c in cols)), late.select(key, time, *cols)


# ---------------------------------------------------------------- status upsert

def latest_status(events: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The newest row per key, of a table or a stream; rows of equal time are decided by their values."""
    cols = [c for c in events.columns if c not in keys]
    ranked = F.struct(F.col(order), *(F.col(c) for c in cols if c != order))
    return events.groupBy(*keys).agg(F.max(ranked).alias("_n")).select(*keys, "_n.*").select(*events.columns)


def stream_status(events: DataFrame, path: str, checkpoint: str, keys: list[str], order: str,
                  available_now: bool = True) -> StreamingQuery:
    """Keep the latest status per key at ``path``; read it with ``read_status``.

    The state store holds one row per key; a micro-batch writes the keys it has changed and nothing else.
    """
    tables.create(events.sparkSession, path, events.schema)

    def handle(batch: DataFrame, batch_id: int) -> None:
        tables.write_version(batch, path, batch_id)
    return _start(latest_status(events, keys, order), handle, checkpoint, available_now, "update")


def read_status(spark: SparkSession, path: str, schema: T.StructType, keys: list[str]) -> DataFrame:
    return tables.read_latest(spark, path, schema, keys)


# ---------------------------------------------------------------- live roll-up

STATE = "namespace string, name string, state string"


def stream_rollup(experiments: DataFrame, job_events: DataFrame, out: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Job events ``(namespace, name, state, ts)`` to experiment states, for experiments that list their jobs.

    ``out/jobs`` gets the jobs a batch has changed, ``out/experiments`` the states of the experiments that list one
    of them; read those with ``read_rollup``. A state is computed from the listed jobs as they stand and from
    the experiment's own row, never from a state computed before, so batches may be cut anywhere.
    """
    spark = experiments.sparkSession
    schema = job_events.schema
    state_schema = T.StructType.fromDDL(STATE)
    keys = ["namespace", "name"]
    tables.create(spark, f"{out}/jobs", schema)
    tables.create(spark, f"{out}/experiments", state_schema)
    listing = experiments.select("namespace", F.col("name").alias("experiment"), F.explode("jobs").alias("name"))

    def handle(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        tables.write_version(batch, f"{out}/jobs", batch_id)
        changed = session.read.schema(schema).parquet(f"{out}/jobs/{tables.BATCH}={batch_id}")
        touched = listing.join(changed.select(*keys), keys, "left_semi").select("namespace", F.col("experiment").alias("name")).distinct()
        again = experiments.join(touched, keys, "left_semi")
        wanted = again.select("namespace", F.explode("jobs").alias("name")).distinct()
        known = tables.read_latest(session, f"{out}/jobs", schema, keys, before=batch_id + 1).join(wanted, keys, "left_semi")
        tables.write_version(rollup.rollup_experiments(again, known).select(*state_schema.names), f"{out}/experiments", batch_id)
    return _start(latest_status(job_events, keys, "ts"), handle, checkpoint, available_now, "update")


def read_rollup(spark: SparkSession, out: str, experiments: DataFrame) -> DataFrame:
    """State of every experiment: the streamed one, or what its own row gives while no event has touched it."""
    schema = T.StructType.fromDDL(STATE)
    streamed = tables.read_latest(spark, f"{out}/experiments", schema, ["namespace", "name"]).withColumnRenamed("state", "_streamed")
    none = spark.createDataFrame([], "namespace string, name string, state string")
    return rollup.rollup_experiments(experiments, none).join(streamed, ["namespace", "name"], "left").withColumn(
        "state", F.coalesce("_streamed", "state")).drop("_streamed")


# ---------------------------------------------------------------- loss windows

WINDOW_KEYS = ["uid", "window_start", "window_end"]


def windowed_loss(events: DataFrame, window: str, slide: str | None = None, delay: str | None = None) -> DataFrame:
    """Rows, mean and extremes of the loss per run and time window, of a stream or a table.

    On a stream ``delay`` bounds the state: windows that ended more than ``delay`` before the newest event are
    forgotten and rows for them are dropped, which the query's progress counts. Without it every window stays open.
    """
    timed = events.withColumn("ts", F.col("ts").cast("timestamp"))
    if events.isStreaming and delay:
        timed = timed.withWatermark("ts", delay)
    frame: Column = F.window("ts", window, slide) if slide else F.window("ts", window)
    return timed.groupBy("uid", frame.alias("w")).agg(
        F.count(F.lit(1)).alias("n"), F.avg("loss").alias("mean_loss"),
        F.min("loss").alias("min_loss"), F.max("loss").alias("max_loss"),
    ).select("uid", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
             "n", "mean_loss", "min_loss", "max_loss")


def stream_curve(events: DataFrame, out: str, checkpoint: str, window: str, slide: str | None = None,
                 delay: str | None = None, available_now: bool = True) -> StreamingQuery:
    """Every window a batch has changed, appended to ``out``; read them with ``read_curve``, also those still open."""
    windows = windowed_loss(events, window, slide, delay)
    tables.create(events.sparkSession, out, windows.schema)

    def handle(batch: DataFrame, batch_id: int) -> None:
        tables.write_version(batch, out, batch_id)
    return _start(windows, handle, checkpoint, available_now, "update")


def read_curve(spark: SparkSession, out: str, schema: T.StructType) -> DataFrame:
    return tables.read_latest(spark, out, schema, WINDOW_KEYS)
