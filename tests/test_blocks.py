"""Blocked windows against plain windows, on a table where one key holds a third of the rows."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from loomwork.operators import blocks, rollup, telemetry, timeseries


@pytest.fixture(scope="module")
def skewed(spark):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(1 + F.col("id") % 41).alias("k"),
        (F.col("id") * 7919 % 3001).alias("o"), (F.hash("id") % 4).alias("v"),
        F.concat(F.lit("s"), F.hash("id") % 3).alias("s"))
    return rows.withColumn("name", F.concat(F.lit("n"), "o")).persist()


def collected(df, *cols):
    return sorted(map(tuple, df.select(*cols).collect()), key=str)


@pytest.mark.parametrize("width", [1.0, 50.0, 1e9])
def test_neighbours_and_totals(skewed, width):
    w = Window.partitionBy("k").orderBy("o")
    want = skewed.withColumn("n", F.lead("s").over(w)).withColumn("p", F.lag("s").over(w)) \
        .withColumn("i", F.row_number().over(w) - 1) \
        .withColumn("t", F.coalesce(F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    got = blocks.add_blocks(skewed, ["k"], F.col("o"), width, hot_rows=200)
    assert got.filter("_block >= 0").select("k").distinct().count() == 1
    got = blocks.next_row(got, ["k"], "o", ["s"], "n").withColumn("n", F.col("n.s"))
    got = blocks.previous_row(got, ["k"], "o", ["s"], "p").withColumn("p", F.col("p.s"))
    got = blocks.row_index(got, ["k"], ["o"], "i")
    got = blocks.running_total(got, ["k"], ["o"], F.col("v"), "t")
    cols = ["k", "o", "s", "n", "p", "i", "t"]
    assert collected(got, *cols) == collected(want, *cols)


def test_sorted_blocks_rank_any_order(skewed):
    jobs = skewed.select(F.lit("ns").alias("namespace"), F.col("k").cast("string").alias("owner_experiment"),
                         "name", F.col("v").cast("string").alias("score"))
    w = Window.partitionBy("namespace", "owner_experiment").orderBy(F.col("points").desc(), "name")
    got = rollup.rank_jobs(jobs, hot_rows=200)
    want = got.drop("rank").withColumn("rank", F.row_number().over(w))
    assert collected(got, "owner_experiment", "name", "rank") == collected(want, "owner_experiment", "name", "rank")
    assert collected(rollup.rank_jobs(jobs), "name", "rank") == collected(got, "name", "rank")
    top = rollup.top_runs(jobs, 3)
    assert collected(top, "name", "rank") == collected(got.filter("rank <= 3"), "name", "rank")


def test_changes_and_curves_do_not_show_the_seams(skewed):
    plain = telemetry.state_changes(skewed, "k", "o", ["s"], True)
    cut = telemetry.state_changes(skewed, "k", "o", ["s"], True, width=11.0, hot_rows=200)
    assert collected(plain, "k", "o", "s", "previous.s") == collected(cut, "k", "o", "s", "previous.s")
    logs = skewed.select(F.col("k").cast("string").alias("uid"), F.col("o").alias("current_steps"),
                         F.col("v").cast("double").alias("loss"))
    cols = ["uid", "bucket", "value", "smoothed"]
    for smooth in (0, 3, 6):
        assert collected(telemetry.curve(logs, "loss", 4, smooth), *cols) == \
            collected(telemetry.curve(logs, "loss", 4, smooth, block=7), *cols)
    w = Window.partitionBy("uid").orderBy("bucket").rangeBetween(-3, 0)
    want = telemetry.curve(logs, "loss", 4).withColumn("smoothed", F.avg("value").over(w))
    assert collected(telemetry.curve(logs, "loss", 4, 3, block=5), *cols) == collected(want, *cols)


def test_series_come_in_stretches_of_time(skewed):
    series = skewed.select(
        F.array(F.struct(F.lit("uid").alias("name"), F.col("k").cast("string").alias("value"))).alias("labels"),
        F.array(F.struct(F.col("v").cast("double").alias("value"), F.col("o").alias("timestamp"))).alias("samples"))
    rows = timeseries.group_series(series, part_ms=64).collect()
    merged = {}
    for r in sorted(rows, key=lambda r: r.part_start):
        assert r.part_start % 64 == 0 and all(0 <= s.timestamp - r.part_start < 64 for s in r.samples)
        merged.setdefault(int(r.labels[0].value), []).extend((s.timestamp, s.value) for s in r.samples)
    want = {}
    for r in skewed.collect():
        want.setdefault(r.k, []).append((r.o, float(r.v)))
    assert merged == {k: sorted(v) for k, v in want.items()}
