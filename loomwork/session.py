"""Session settings and the shared folder used for checkpoints and staged tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app: str = "loomwork", master: str | None = None, shuffle_partitions: int | None = None,
                  **conf: str) -> SparkSession:
    """A session with the settings the operators are tuned for.

    Shuffle partitions are left to the cluster's own setting unless given: AQE coalesces
    small partitions and splits skewed ones at run time.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        # Whole documents travel to the scoring helper: bound a batch by bytes, not by rows only.
        .config("spark.sql.execution.arrow.maxBytesPerBatch", str(64 << 20))
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def bound_batches(spark: SparkSession, size: int = 4 << 20) -> None:
    """Let rows cross to Python workers at most ``size`` bytes at a time, for this session, unless it asks for less.

    Spark counts rows only unless told otherwise, and ten thousand whole texts are a large part of a worker's memory, on both sides.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    given = spark.conf.get(name).lower().removesuffix("b")
    if not given.isdigit() or int(given) > size:
        spark.conf.set(name, str(size))


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A temporary folder is used only for a local master without the setting (tests); on a
    cluster the setting is required, since a machine-local folder dies with its executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if configured:
        if not current:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="loomwork-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(folder)
    return folder


_SCRATCH: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for one staged table or stream under the shared folder, until ``remove_scratch``."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _SCRATCH.append(path)
    return path


def remove_scratch(spark: SparkSession) -> None:
    """Delete everything staged so far by this driver, once the tables read from it are no longer needed."""
    while _SCRATCH:
        folder = spark._jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)
