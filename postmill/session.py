"""Session settings the jobs are written for."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session with adaptive execution, skew handling and a fixed time zone."""
    builder = (
        SparkSession.builder.appName("postmill")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


_own_folder: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; where that is unset one of our own, but only where all runs on this machine."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    master = spark.sparkContext.master
    if not re.fullmatch(r"local(\[.*\])?", master):
        raise ValueError(f"spark.checkpoint.dir must name a folder that all machines of {master} share")
    application = spark.sparkContext.applicationId
    if application not in _own_folder:
        _own_folder[application] = tempfile.mkdtemp(prefix="postmill-")
    return _own_folder[application]


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return os.path.join(shared_folder(spark), "postmill", uuid.uuid4().hex, name)


METHOD_LIMIT, COMPILED_BYTES = "spark.sql.codegen.hugeMethodLimit", 8000


@contextmanager
def compiled_methods(spark: SparkSession) -> Iterator[None]:
    """Spark writes code of wide rows as one method, which the JVM interprets for ever when it has over 8,000 bytes. Inside, such code is dealt to small methods instead."""
    before = spark.conf.get(METHOD_LIMIT, None)
    spark.conf.set(METHOD_LIMIT, COMPILED_BYTES)
    try:
        yield
    finally:
        spark.conf.unset(METHOD_LIMIT) if before is None else spark.conf.set(METHOD_LIMIT, before)


_stages_of_jobs: list[list[str]] = []


@contextmanager
def job(spark: SparkSession) -> Iterator[None]:
    """Stages written inside are removed at its end, each by its own path. What leaves the job must not read them."""
    _stages_of_jobs.append([])
    try:
        with compiled_methods(spark):
            yield
    finally:
        for path in _stages_of_jobs.pop():
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def write_stage(df: DataFrame, name: str, *by: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder, in folders ``by`` its last columns, and read it back.

    Cuts the lineage in a way which survives lost executors, and later reads
    still get column pruning and pushed filters.
    """
    path = work_path(df.sparkSession, name)
    if _stages_of_jobs:
        _stages_of_jobs[-1].append(os.path.dirname(path))
    df.write.mode("overwrite").partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What is written inside leaves its rows only: the files of its shuffles go as soon as it is done, not when the driver next collects garbage."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)
