"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import math
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

# Recommended for any session: today's date in UTC, ANSI errors instead of silent
# NULLs, and AQE for coalescing, skew joins and runtime broadcasts.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

# A shuffle partition should fit in a task's memory; Parquet grows about
# threefold when its rows are shuffled.
PARTITION_BYTES = 200 * 1024 * 1024
SHUFFLE_GROWTH = 3

SCOPE = "forgemeter.scratch.scope"

# Tables built at the same time: fills a cluster while a small table's last
# tasks run.
TABLES_AT_ONCE = 4


def local_session(app: str = "forgemeter", cpus: str = "*", **conf: str) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _hadoop(spark: SparkSession, path: str):
    """The path and its file system, whichever storage it names."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    place, files = _hadoop(spark, path)
    return files.exists(place)


def remove_path(spark: SparkSession, path: str) -> None:
    place, files = _hadoop(spark, path)
    files.delete(place, True)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it is not there."""
    place, files = _hadoop(spark, path)
    return [f.getPath().getName() for f in files.listStatus(place)] if files.exists(place) else []


def file_sizes(spark: SparkSession, path: str) -> dict[str, int]:
    """Bytes of each file in a folder, hidden ones left out."""
    place, files = _hadoop(spark, path)
    listed = files.listStatus(place) if files.exists(place) else []
    return {f.getPath().getName(): f.getLen() for f in listed if not f.getPath().getName().startswith((".", "_"))}


def touch(spark: SparkSession, path: str) -> None:
    """Create an empty file."""
    place, files = _hadoop(spark, path)
    files.create(place, True).close()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster that
    would sit on one machine and vanish with it.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    current = context._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get().rstrip("/")
    if not re.match(r"local(\[|$)", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="forgemeter-"))
    return context._jsc.sc().getCheckpointDir().get().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    scope = spark.sparkContext.getLocalProperty(SCOPE)
    folder = f"forgemeter/{scope}" if scope else "forgemeter"
    return f"{scratch_root(spark)}/{folder}/{label}-{uuid.uuid4().hex}"


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Removes on success what was settled inside; a failure leaves it for recovery.

    No DataFrame that still reads a settled table may leave the scope. The scope
    is a Spark local property, so ``in_parallel`` tasks belong to it and other
    threads do not.
    """
    context = spark.sparkContext
    outer, scope = context.getLocalProperty(SCOPE), f"scope-{uuid.uuid4().hex}"
    context.setLocalProperty(SCOPE, scope)
    try:
        yield
    finally:
        context.setLocalProperty(SCOPE, outer)
    remove_path(spark, f"{scratch_root(spark)}/forgemeter/{scope}")


def settle(df: DataFrame, label: str, *partition_by: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and return the written table.

    Used where a result feeds several later steps: it is computed once, its
    lineage ends there, and a lost executor only re-reads files.
    """
    return df.sparkSession.read.schema(df.schema).parquet(settled_files(df, label, *partition_by))


def settled_files(df: DataFrame, label: str, *partition_by: str) -> str:
    """As ``settle``; returns the folder."""
    path = scratch_path(df.sparkSession, label)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def in_parallel(tasks: Mapping[str, Callable[[], DataFrame]]) -> dict[str, DataFrame]:
    """Run the tasks, a few at once, and return their results by name."""
    with ThreadPoolExecutor(TABLES_AT_ONCE) as pool:
        running = {name: pool.submit(inheritable_thread_target(task)) for name, task in tasks.items()}
        return {name: future.result() for name, future in running.items()}


def stored_bytes(spark: SparkSession, path: str) -> int:
    place, files = _hadoop(spark, path)
    return files.getContentSummary(place).getLength()


def sized_session(spark: SparkSession, data_bytes: int) -> tuple[SparkSession, int]:
    """A session with enough shuffle partitions for Parquet data of that size, and their number.

    Settings, catalog and current database are the given session's, which itself
    stays as it is, so several loads and runs may share it. Never fewer
    partitions than configured; AQE merges what turns out too small.
    """
    key = "spark.sql.shuffle.partitions"
    needed = math.ceil(data_bytes * SHUFFLE_GROWTH / PARTITION_BYTES)
    partitions = max(int(spark.conf.get(key)), needed)
    sized = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(name):
            sized.conf.set(name, value)
    sized.catalog.setCurrentDatabase(spark.catalog.currentDatabase())
    sized.conf.set(key, str(partitions))
    return sized, partitions
