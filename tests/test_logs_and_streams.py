"""Telemetry, time series and the streams, which must find what the batch jobs find."""

import json
import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomwork import schemas
from loomwork.operators import rollup, telemetry, timeseries
from loomwork.schemas import RAW_LOG
from loomwork.sources import logs
from loomwork.streaming import jobs as streams
from loomwork.streaming import tables

T0 = datetime(2024, 1, 1)


def raw(uid, step, total, seconds, **metrics):
    names = [f.name for f in RAW_LOG][5:]
    return (uid, step, total, T0, T0 + timedelta(seconds=seconds), *(metrics.get(n) for n in names))


ROWS = [
    raw("1", 10, 84, 59, loss=3.088, learning_rate=4.404761904761905e-05, epoch=0.71),
    raw("1", 20, 84, 3600, eval_loss=2.0, eval_perplexity=math.exp(2), **{"eval_rouge-1": 0.5, "eval_bleu-4": 0.25}),
    raw("1", 0, 84, 5, loss=None, learning_rate=1.0, epoch=0.0),
    raw("2", 5, 0, 172801, loss=1.0, learning_rate=0.5, epoch=1.0),
]


def test_logs_are_routed_timed_and_written(spark, tmp_path):
    df = spark.createDataFrame(ROWS, RAW_LOG)
    train, evaluation = telemetry.normalize_logs(df)
    assert train.columns == schemas.TRAIN_LOG.names and evaluation.columns == schemas.EVAL_LOG.names
    row = {(r.uid, r.current_steps): r for r in train.collect()}
    assert (row["1", 10].percentage, row["1", 10].elapsed_time, row["1", 10].remaining_time) == (11.9, "0:00:59", "0:07:16")
    assert (row["1", 0].remaining_time, row["1", 0].percentage, row["1", 0].loss) == ("0:00:00", 0.0, None)
    assert (row["2", 5].percentage, row["2", 5].elapsed_time) == (100.0, "2 days, 0:00:01")
    e = evaluation.first()
    assert (e.eval_loss, e.eval_rouge_1, e.eval_rouge_2, e.eval_bleu_4) == (2.0, 0.5, None, 0.25)
    for overwrite in (True, False):
        logs.write_logs(df, str(tmp_path), overwrite)
    back_train, back_eval = logs.read_logs(spark, str(tmp_path))
    assert back_train.count() == 6 and back_eval.count() == 2
    assert sorted(map(str, back_train.distinct().collect())) == sorted(map(str, train.collect()))


def test_a_null_evaluation_loss_is_still_an_evaluation(spark):
    lines = [json.dumps({"uid": "1", "eval_loss": None}), json.dumps({"uid": "1", "loss": 1.0})]
    rows = telemetry.parse_lines(spark.createDataFrame([(x,) for x in lines], "value string")).collect()
    assert [r.kind for r in rows] == ["eval", "train"]


def test_run_summary_and_eval(spark):
    df = spark.createDataFrame(ROWS, RAW_LOG)
    row = telemetry.run_summary(df.filter("loss is not null")).filter("uid = '1'").first()
    assert (row.last_step, row.last_loss, row.min_loss, row.last_epoch, row.n_logs) == (10, 3.088, 3.088, 0.71, 1)
    ev = telemetry.eval_metrics(df, ["uid"]).filter("uid = '1'").first()
    assert ev.eval_perplexity == pytest.approx(math.exp(2))
    big = telemetry.eval_metrics(spark.createDataFrame([("x", 1e4)], "uid string, eval_loss double"), ["uid"]).first()
    assert big.eval_perplexity == math.inf
    speed = telemetry.eval_speed(spark.range(9).select(F.lit("e").alias("k"), F.lit(2.0).alias("runtime")), ["k"], 2, 2).first()
    assert (speed.n_steps, speed.samples_per_second, speed.steps_per_second) == (3, 4.5, 1.5)


def test_series_and_matchers(spark, tmp_path):
    df = spark.createDataFrame(ROWS, RAW_LOG)
    series = timeseries.train_series(df)
    labels = {x.name: x.value for x in series.first().labels}
    assert list(labels) == ["__name__", "uid", "total_steps", "current_steps", "loss", "learning_rate", "epoch"]
    assert labels["loss"] == "3.088" and series.first().samples[0].timestamp == 1704067259000
    assert {x.value for r in series.collect() for x in r.labels if x.name == "loss"} == {"3.088", "None", "1.0"}
    assert [x.value for x in timeseries.eval_series(df).first().labels][:1] == ["eval_metrics"]

    def hits(*matchers):
        return timeseries.match_series(series, [timeseries.Matcher(*m) for m in matchers]).count()
    assert hits(("EQ", "uid", "1")) == 3 and hits(("NEQ", "uid", "1")) == 1 and hits(("EQ", "absent", "")) == 4
    assert hits(("RE", "total_steps", "8")) == 0 and hits(("RE", "total_steps", "8.")) == 3 and hits(("NRE", "total_steps", "8.|x")) == 1
    with pytest.raises(ValueError):
        hits(("LIKE", "uid", "1"))
    inside = timeseries.select_range(series, 1704067205000, 1704067259000)
    assert inside.count() == 2 and timeseries.select_range(series, 0, 1).count() == 0
    logs.write_timeseries(series, str(tmp_path / "series"))
    assert logs.read_timeseries(spark, str(tmp_path / "series")).count() == 4
    grouped = timeseries.group_series(series.unionByName(series), 10 ** 12).collect()
    assert len(grouped) == 4 and all(len(r.samples) == 2 for r in grouped)


def test_downsampling(spark):
    points = spark.createDataFrame([("a", 5, 1.0), ("a", 9, 3.0), ("a", 15, 7.0), ("b", -1, 2.0)], "uid string, timestamp long, value double")
    def run(func, start=5):
        return {(r.uid, r.bucket_ms): r.value for r in timeseries.downsample(points, ["uid"], 10, func, start).collect()}
    assert run("avg") == {("a", 5): 2.0, ("a", 15): 7.0, ("b", -5): 2.0}
    assert run("last")["a", 5] == 3.0 and run("count")["a", 5] == 2 and run("sum", 0)["a", 0] == 4.0
    with pytest.raises(ValueError):
        run("median")


EVENTS = "key string, ts timestamp, state string, value int"


def event_files(spark, folder, rows, n_files, seed=0):
    """The rows dealt to files at random; one file per micro-batch."""
    order = random.Random(seed).sample(rows, len(rows))
    for i in range(n_files):
        df = spark.createDataFrame([(k, T0 + timedelta(minutes=m), s, v) for k, m, s, v in order[i::n_files]], EVENTS)
        df.coalesce(1).write.mode("append").parquet(str(folder))
    return spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(str(folder))


def event_rows(n=60, seed=1):
    rng = random.Random(seed)
    return [(rng.choice("abc"), m, rng.choice("xyz"), rng.randrange(100)) for m in range(n)] + [("d", 5, "x", 1)]


CUTS = pytest.mark.parametrize("n_files, delay", [(1, "1 second"), (2, "2 hours"), (5, "2 hours")])


@CUTS
@pytest.mark.parametrize("first", [False, True])
def test_streamed_changes_equal_batch_changes(spark, tmp_path, n_files, delay, first):
    stream = event_files(spark, tmp_path / "in", event_rows(), n_files)
    out, what = str(tmp_path / "out"), ("key", "ts", ["state"])
    streams.stream_state_changes(stream, *what, out, f"{out}-checkpoint", delay, include_first=first).awaitTermination()
    got, late = streams.read_changes(spark, out, stream.schema, *what)
    want = telemetry.state_changes(spark.read.parquet(str(tmp_path / "in")), *what, first)
    want = want.select("key", "ts", "state", F.col("previous.state").alias("previous_state"))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and late.count() == 0


@pytest.mark.parametrize("n_files, hot_rows", [(1, 10 ** 6), (4, 10), (20, 10)])
def test_changes_of_a_long_history_and_a_hot_user(spark, tmp_path, n_files, hot_rows):
    """Twelve days that arrive up to two hours late, a third of the rows of one user: delay of hours, one row of state per key."""
    rng = random.Random(11)
    rows = sorted((m + rng.randrange(120), rng.choice(["hot", rng.choice("abcdef"), rng.choice("abcdef")]), m, rng.choice(["x", "y", "y", None]))
                  for m in range(0, 12 * 24 * 60, 29))
    rows += [(rows[-1][0], "a", None, "x")]
    size = -(-len(rows) // n_files)
    for i in range(n_files):
        part = [(k, None if m is None else T0 + timedelta(minutes=m), s, 0) for _, k, m, s in rows[i * size:(i + 1) * size]]
        spark.createDataFrame(part, EVENTS).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    out, what = str(tmp_path / "out"), ("key", "ts", ["state"])
    streams.stream_state_changes(stream, *what, out, f"{out}-checkpoint", "3 hours", hot_rows=hot_rows).awaitTermination()
    got, late = streams.read_changes(spark, out, stream.schema, *what, hot_rows=hot_rows)
    table = spark.read.parquet(str(tmp_path / "in")).filter("ts IS NOT NULL")
    want = telemetry.state_changes(table, *what).select("key", "ts", "state", F.col("previous.state").alias("previous_state"))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() > 100
    assert [(r.key, r.ts) for r in late.collect()] == [("a", None)]
    # The state: one row per key; batches that hold settled rows only are not read again.
    state = tables.read_keyed(spark, f"{out}/last", spark.read.parquet(f"{out}/last").drop("batch").schema, ["key"], n_files - 1)
    assert state.count() == 7
    newest = tables.read_versions(spark, f"{out}/marks", T.StructType.fromDDL(streams.MARK)).orderBy(F.col("batch").desc()).first()
    assert newest["first"] >= n_files - 2


def test_a_batch_run_again_changes_nothing(spark, tmp_path):
    path, schema = str(tmp_path / "t"), spark.createDataFrame([], EVENTS).schema
    tables.create_keyed(spark, path, schema)
    for i in [*range(16), 15, 16, 16, *range(17, 34)]:
        tables.write_keyed(spark.createDataFrame([("a", T0, "x", i), (f"k{i}", T0, "y", i)], EVENTS), path, i, ["key"])
    read = lambda upto: {r.key: r.value for r in tables.read_keyed(spark, path, schema, ["key"], upto).collect()}
    for upto in (-1, 0, 15, 16, 31, 33):
        assert read(upto) == ({"a": upto} if upto >= 0 else {}) | {f"k{i}": i for i in range(upto + 1)}


def test_rows_too_late_to_be_placed_are_kept_apart(spark, tmp_path):
    batches = [[("a", 300, "x", 1)], [("a", 60, "x", 1)], [("a", 600, "y", 1)], [("a", 620, "y", 1)], [("a", 10, "z", 1)]]
    for i, rows in enumerate(batches):
        spark.createDataFrame([(k, T0 + timedelta(minutes=m), s, v) for k, m, s, v in rows], EVENTS).coalesce(1).write.parquet(f"{tmp_path}/in/{i}")
    stream = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
    out, what = str(tmp_path / "out"), ("key", "ts", ["state"])
    streams.stream_state_changes(stream, *what, out, f"{out}-checkpoint", "2 hours").awaitTermination()
    changes, late = streams.read_changes(spark, out, stream.schema, *what)
    assert [(r.ts, r.state, r.previous_state) for r in changes.collect()] == [(T0 + timedelta(minutes=600), "y", "x")]
    assert late.count() == 1


def test_reading_takes_the_newest_batch_of_a_key(spark, tmp_path):
    path, schema = str(tmp_path / "t"), spark.createDataFrame([], EVENTS).schema
    tables.create(spark, path, schema)
    assert tables.read_latest(spark, path, schema, ["key"]).count() == 0
    for i, state in ((0, "x"), (1, "y"), (1, "y"), (2, "z")):  # batch 1 is run twice
        keys = "ab" if i == 0 else "a"
        tables.write_version(spark.createDataFrame([(k, T0, state, i) for k in keys], EVENTS), path, i)
    read = lambda **k: {r.key: r.state for r in tables.read_latest(spark, path, schema, ["key"], **k).collect()}
    assert read() == {"a": "z", "b": "x"} and read(before=2) == {"a": "y", "b": "x"}
    assert tables.read_appended(spark, path, schema).count() == 4


@CUTS
def test_streamed_status_and_rollup_equal_the_batch(spark, tmp_path, n_files, delay):
    stream = event_files(spark, tmp_path / "in", event_rows(), n_files)
    table = spark.read.parquet(str(tmp_path / "in"))
    streams.stream_status(stream, str(tmp_path / "s"), str(tmp_path / "s-checkpoint"), ["key"], "ts").awaitTermination()
    got = streams.read_status(spark, str(tmp_path / "s"), stream.schema, ["key"])
    assert sorted(map(str, got.collect())) == sorted(map(str, streams.latest_status(table, ["key"], "ts").collect()))

    def jobs(df):
        return df.select(F.lit("ns").alias("namespace"), F.col("key").alias("name"),
                         F.when(F.col("state") == "z", "FAILED").otherwise("SUCCESSFUL").alias("state"), "ts")
    experiments = spark.createDataFrame(
        [("ns", f"e{i}", "", False, listed) for i, listed in enumerate([["a"], ["b", "c"], ["c"], ["a", "missing"], ["missing"], [], ["a", "b", "c", "d"]])]
        + [("ns", "p", "", True, ["a"])], "namespace string, name string, state string, pending boolean, jobs array<string>")
    out = str(tmp_path / "r")
    streams.stream_rollup(experiments, jobs(stream), out, f"{out}-checkpoint").awaitTermination()
    got = streams.read_rollup(spark, out, experiments).select("name", "state")
    want = rollup.rollup_experiments(experiments, streams.latest_status(jobs(table), ["namespace", "name"], "ts")).select("name", "state")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() == 8


def test_streamed_logs_equal_batch_logs(spark, tmp_path):
    df = spark.createDataFrame(ROWS, RAW_LOG)
    lines = df.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("value"))
    lines.repartition(3).write.text(str(tmp_path / "in"))
    out = str(tmp_path / "out")
    streams.stream_logs(streams.read_lines(spark, str(tmp_path / "in"), 1), out, f"{out}-checkpoint").awaitTermination()
    train, evaluation = telemetry.normalize_logs(df)
    for name, want in (("train", train), ("eval", evaluation)):
        got = tables.read_appended(spark, f"{out}/{name}", want.schema)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_streamed_windows_equal_batch_windows(spark, tmp_path):
    rows = [("u", T0 + timedelta(minutes=10 * i), float(i)) for i in range(60)]
    shuffled = random.Random(3).sample(rows, len(rows))
    df = spark.createDataFrame(rows, "uid string, ts timestamp, loss double")
    for i in range(4):
        spark.createDataFrame(shuffled[i::4], df.schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    want = streams.windowed_loss(df, "1 hour", "30 minutes")
    for delay in (None, "1 day"):
        out = str(tmp_path / f"out-{delay}")
        streams.stream_curve(stream, out, f"{out}-checkpoint", "1 hour", "30 minutes", delay).awaitTermination()
        got = streams.read_curve(spark, out, want.schema)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_last_values_are_those_of_the_last_row_that_has_one(spark):
    rows = [("1", i, loss, lr, i / 10) for i, loss, lr in [(1, 3.0, 0.1), (2, 2.0, 0.2), (3, None, None)]] + [("2", 1, None, None, 0.1)]
    df = spark.createDataFrame(rows, "uid string, current_steps int, loss double, learning_rate double, epoch double")
    got = {r.uid: r for r in telemetry.run_summary(df).collect()}
    assert (got["1"].last_loss, got["1"].min_loss, got["1"].mean_loss, got["1"].last_learning_rate, got["1"].last_epoch) == (2.0, 2.0, 2.5, 0.2, 0.3)
    assert got["2"].last_loss is None and got["2"].last_step == 1
    assert telemetry.curve(df.fillna(0.0), "loss", 1, smooth=70_000).count() == 4
