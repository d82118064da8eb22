"""States of runs, jobs and experiments; ranking and best version."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomwork.functions.text import is_blank, parse_score
from loomwork.operators import blocks

# Job states in the order a job passes through them.
JOB_STAGES = ["INIT", "FINETUNE", "BUILDIMAGE", "SERVE", "SUCCESSFUL"]
ACTIVE = ["PENDING", "RUNNING"]
ENDED_BADLY = ["STOPPED", "FAILED"]


def status_class(status: Column) -> Column:
    return F.when(status.isin(ACTIVE), F.lit("active")).when(status.isin(ENDED_BADLY), F.lit("failed"))


def is_built(build_completed_at: Column) -> Column:
    return build_completed_at.isNotNull()


def is_serving(service_status: Column, deployment_status: Column) -> Column:
    return F.coalesce((service_status == "RUNNING") & (deployment_status == "HEALTHY"), F.lit(False))


def is_scored(score: Column) -> Column:
    return score.isNotNull()


def rollup_runs(runs: DataFrame) -> DataFrame:
    """Next state of each run from ``state, backing_status, create_failed, checkpoint``.

    ``backing_status`` is null while no backing job exists. Terminal states stay.
    """
    exists = F.col("backing_status").isNotNull()
    succeeded = ~is_blank("backing_status") & status_class(F.col("backing_status")).isNull()
    recorded = ~is_blank("checkpoint.path")
    state = (
        F.when(F.col("state").isin("SUCCESSFUL", "FAILED"), F.col("state"))
        .when(~exists & F.coalesce(F.col("create_failed"), F.lit(False)), F.lit("PENDING"))
        .when(~exists, F.when(is_blank("state"), F.lit("INIT")).otherwise(F.col("state")))
        .when(status_class(F.col("backing_status")) == "failed", F.lit("FAILED"))
        .when(succeeded & recorded, F.lit("SUCCESSFUL"))
        .otherwise(F.lit("RUNNING"))
    )
    return runs.withColumn("state", state)


def _stage(state: Column) -> Column:
    stage = F.lit(0)
    for i, name in enumerate(JOB_STAGES):
        stage = F.when(state == name, F.lit(i)).otherwise(stage)
    return stage


def rollup_jobs(jobs: DataFrame, runs: DataFrame) -> DataFrame:
    """Jobs moved to the furthest stage their facts allow; a stage once reached is kept.

    Uses ``state, build_completed_at, service_status, deployment_status, score`` of the job and ``state`` and
    ``checkpoint`` of the run named in ``run``: an image is only built from a run that has recorded a checkpoint
    object. ``serving`` is a job in state SERVE whose service is up; ``stalled`` marks jobs waiting on an image build.
    """
    side = runs.select("namespace", F.col("name").alias("run"), F.col("state").alias("run_state"),
                       (~is_blank("checkpoint.ref")).alias("_recorded"))
    rows = jobs.join(side, ["namespace", "run"], "left")
    run = F.col("run_state")
    furthest = F.greatest(
        _stage(F.col("state")),
        F.when(run.isin("INIT", "RUNNING"), 1).when((run == "SUCCESSFUL") & F.col("_recorded"), 2).otherwise(0),
        F.when(is_built(F.col("build_completed_at")), 3).otherwise(0),
        F.when(is_scored(F.col("score")), 4).otherwise(0),
    )
    state = F.when(run == "FAILED", F.lit("FAILED")).when(F.col("state") == "FAILED", F.lit("FAILED")) \
        .otherwise(F.element_at(F.array(*map(F.lit, JOB_STAGES)), furthest + 1))
    return (
        rows.withColumn("state", state).drop("_recorded")
        .withColumn("serving", (F.col("state") == "SERVE") & is_serving(F.col("service_status"), F.col("deployment_status")))
        .withColumn("stalled", (F.col("state") == "BUILDIMAGE") & ~is_built(F.col("build_completed_at")))
    )


def _listed_jobs(experiments: DataFrame, jobs: DataFrame, *cols: str) -> DataFrame:
    """One row per listed job: ``namespace, name, job`` and ``cols`` of its row, null where there is none."""
    listed = experiments.select("namespace", "name", F.explode("jobs").alias("job"))
    return listed.join(jobs.select("namespace", F.col("name").alias("job"), *cols), ["namespace", "job"], "left")


def _votes() -> list[Column]:
    """A listed job without a row is neither successful nor failed."""
    return [F.bool_and(F.coalesce(F.col("state") == name, F.lit(False))).alias(out)
            for name, out in (("SUCCESSFUL", "_good"), ("FAILED", "_bad"))]


def _experiment_state() -> Column:
    return (
        F.when(F.coalesce(F.col("pending"), F.lit(False)), F.lit("PENDING"))
        .when(F.col("_good"), F.lit("SUCCESS")).when(F.col("_bad"), F.lit("FAILED"))
        .when(is_blank("state") | (F.col("state") == "PENDING"), F.lit("PROCESSING"))
        .otherwise(F.col("state"))
    )


def rollup_experiments(experiments: DataFrame, jobs: DataFrame) -> DataFrame:
    """SUCCESS when all listed jobs succeeded, FAILED when all failed, otherwise the state as it was.

    ``jobs`` of an experiment is the list of job names. A listed job that does not exist keeps the state as it
    was, and so does an empty list. A pending experiment is PENDING.
    """
    votes = _listed_jobs(experiments, jobs, "state").groupBy("namespace", "name").agg(*_votes())
    return experiments.join(votes, ["namespace", "name"], "left").withColumn("state", _experiment_state()).drop("_good", "_bad")


def rank_jobs(jobs: DataFrame, hot_rows: int = blocks.HOT_ROWS) -> DataFrame:
    """Add ``points`` (the parsed score) and ``rank`` within the experiment; ties go by name."""
    keys = ["namespace", "owner_experiment"]
    order = [F.col("points").desc(), F.col("name").asc()]
    scored = jobs.withColumn("points", parse_score("score"))
    tagged = blocks.add_sorted_blocks(scored, keys, order, hot_rows)
    return blocks.drop_blocks(blocks.row_index(tagged, keys, order, "rank")).withColumn("rank", F.col("rank") + 1)


def top_runs(jobs: DataFrame, k: int = 1) -> DataFrame:
    """The k best jobs per experiment. Spark prunes to k rows per map task before the shuffle."""
    w = Window.partitionBy("namespace", "owner_experiment").orderBy(F.col("points").desc(), F.col("name"))
    return (
        jobs.withColumn("points", parse_score("score"))
        .withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    )


def best_version(experiments: DataFrame, jobs: DataFrame, runs: DataFrame) -> DataFrame:
    """Best listed job of each successful experiment with the model, hyperparameter and dataset of its run.

    Votes and the best job come from one aggregate over the listed jobs; equal scores go to the smaller name.
    """
    rows = _listed_jobs(experiments, jobs, "state", "score", "image", "run")
    # The order comes first in the row itself, so a name crosses the shuffle once.
    best = F.min(F.struct((-parse_score("score")).alias("_order"), "job", "score", "image", "run"))
    voted = rows.groupBy("namespace", "name").agg(*_votes(), best.alias("_best"))
    done = experiments.join(voted, ["namespace", "name"]).filter(_experiment_state() == "SUCCESS").select(
        "namespace", F.col("name").alias("experiment"), "_best.*").drop("_order")
    side = runs.select("namespace", F.col("name").alias("run"), "model", "hyperparameter", "dataset")
    return done.join(side, ["namespace", "run"], "left").select(
        "namespace", "experiment", "job", "score", "image", "model", "hyperparameter", "dataset")


def job_status_list(experiments: DataFrame, jobs: DataFrame, previous: DataFrame | None = None) -> DataFrame:
    """``jobs_status``: name and state of each job an experiment lists, in listed order.

    The list is as long as the ``jobs`` array it comes from. With ``previous``
    ``(namespace, name, jobs_status)``, ``changed`` tells which lists differ.
    """
    listed = experiments.select("namespace", "name", F.posexplode("jobs").alias("_pos", "job"))
    states = jobs.select("namespace", F.col("name").alias("job"), "state")
    lists = (
        listed.join(states, ["namespace", "job"], "left")
        .groupBy("namespace", "name")
        .agg(F.sort_array(F.collect_list(F.struct("_pos", F.col("job").alias("name"), "state"))).alias("_list"))
        .select("namespace", "name", F.transform("_list", lambda x: F.struct(x["name"], x["state"])).alias("jobs_status"))
    )
    if previous is None:
        return lists
    old = previous.select("namespace", "name", F.col("jobs_status").alias("_old"))
    return lists.join(old, ["namespace", "name"], "left").withColumn(
        "changed", ~F.col("jobs_status").eqNullSafe(F.col("_old"))).drop("_old")


def apply_pause(experiments: DataFrame, jobs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(experiments, kept jobs, removed jobs)`` after pausing the experiments marked pending.

    A paused experiment becomes PENDING and loses its status list; one that is PENDING
    already is left alone; one no longer marked goes back to PROCESSING. Kept and removed jobs share one shuffle of the jobs.
    """
    fresh = F.coalesce(F.col("pending"), F.lit(False)) & ~F.col("state").eqNullSafe(F.lit("PENDING"))
    paused = experiments.filter(fresh & F.col("namespace").isNotNull() & F.col("name").isNotNull()).select(
        F.col("namespace").alias("_namespace"), F.col("name").alias("_name"))
    # Jobs without an owner are kept, since no null is among the paused. An equality that is true for nulls leaves the jobs of both
    # joins unfiltered, so that Spark sees one shuffle in them.
    on = F.col("namespace").eqNullSafe(F.col("_namespace")) & F.col("owner_experiment").eqNullSafe(F.col("_name"))
    after = experiments.withColumn(
        "state",
        F.when(F.coalesce(F.col("pending"), F.lit(False)), F.lit("PENDING"))
        .when(F.col("state") == "PENDING", F.lit("PROCESSING")).otherwise(F.col("state")))
    if "jobs_status" in experiments.columns:
        after = experiments.select(
            *[c for c in experiments.columns if c not in ("state", "jobs_status")],
            F.when(fresh, F.slice("jobs_status", 1, 0)).otherwise(F.col("jobs_status")).alias("jobs_status"),
            F.when(F.coalesce(F.col("pending"), F.lit(False)), F.lit("PENDING"))
            .when(F.col("state") == "PENDING", F.lit("PROCESSING")).otherwise(F.col("state")).alias("state"))
    return after, jobs.join(paused, on, "left_anti"), jobs.join(paused, on, "left_semi")
