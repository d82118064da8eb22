"""Registry tables that several writers append to, each key once.

A table is a folder of row folders and of numbered commit files; a row folder counts once a commit names it. A writer sets its
rows down first and then claims the next number by a rename that fails if the number is taken. If it is, another
writer was faster: the rows whose keys that one has added are left out and the next number is tried. So no two writers add one key, no
reader sees half an append, and a writer that dies leaves nothing but a folder nobody names.
"""

from __future__ import annotations

import os
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from loomwork.operators import registry
from loomwork.session import path_exists

COMMITS, ROWS = "_commits", "rows"


class Taken(Exception):
    """Another writer has claimed the number."""


def _files(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def _commit_name(number: int) -> str:
    return f"{number:012d}"


def committed(spark: SparkSession, path: str) -> list[str]:
    """Row folders of all commits, in their order."""
    if not path_exists(spark, f"{path}/{COMMITS}"):
        return []
    folder, fs = _files(spark, f"{path}/{COMMITS}")
    names = sorted(s.getPath().getName() for s in fs.listStatus(folder))
    out = []
    for name in names:
        if name.isdigit():
            stream = fs.open(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{COMMITS}/{name}"))
            try:
                out.append(f"{path}/{ROWS}/{stream.readUTF()}")
            finally:
                stream.close()
    return out


def claim(spark: SparkSession, path: str, number: int, rows: str) -> None:
    """Make commit ``number`` name the folder ``rows``, or raise ``Taken``. There is no moment at which it is there without its name."""
    jvm = spark._jvm
    target = f"{path}/{COMMITS}/{_commit_name(number)}"
    draft, fs = _files(spark, f"{path}/{COMMITS}/.{uuid.uuid4().hex}")
    fs.mkdirs(draft.getParent())
    stream = fs.create(draft, True)
    stream.writeUTF(rows)
    stream.close()
    try:
        if fs.getScheme() == "file":
            # Hadoop's local rename looks first and renames then; a hard link is one step.
            local = lambda p: jvm.org.apache.hadoop.fs.Path.getPathWithoutSchemeAndAuthority(p).toString()
            os.link(local(draft), local(jvm.org.apache.hadoop.fs.Path(target)))
        else:
            options = spark.sparkContext._gateway.new_array(getattr(jvm, "org.apache.hadoop.fs.Options$Rename"), 0)
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), spark._jsc.hadoopConfiguration())
            context.rename(draft, jvm.org.apache.hadoop.fs.Path(target), options)
    except FileExistsError as error:
        raise Taken(target) from error
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" in str(error.java_exception):
            raise Taken(target) from error
        raise
    finally:
        if fs.exists(draft):
            fs.delete(draft, False)


def _rows(spark: SparkSession, folders: list[str], schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All rows of the commits made so far."""
    return _rows(spark, committed(spark, path), schema)


def append_absent(spark: SparkSession, desired: DataFrame, path: str, keys: list[str] = registry.KEY) -> int:
    """Append the rows whose key is not in the table at ``path``; the number of the commit. Running it twice adds nothing.

    Of several rows with one key one is taken. Writers may run at the same time.
    """
    schema = desired.schema
    known = committed(spark, path)
    fresh = registry.create_if_absent(_rows(spark, known, schema), desired, keys)
    while True:
        name = uuid.uuid4().hex
        fresh.write.parquet(f"{path}/{ROWS}/{name}")
        try:
            claim(spark, path, len(known), name)
            return len(known)
        except Taken:
            # Only what others have added since is looked at, against the rows set down already.
            now = committed(spark, path)
            fresh = registry.create_if_absent(_rows(spark, now[len(known):], schema), _rows(spark, [f"{path}/{ROWS}/{name}"], schema), keys)
            known = now
