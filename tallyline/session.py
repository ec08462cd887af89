"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context
from functools import cache
from threading import Lock
from typing import Any
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from tallyline import store

# SQL settings the plans are written for. Partition counts stay with the cluster; AQE
# merges small shuffle partitions and splits skewed ones at run time.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: int = 8, name: str = "tallyline", partitions: int | None = None):
    """A single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(partitions or cores))
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@cache
def _local_scratch() -> str:
    return tempfile.mkdtemp(prefix="tallyline-")


def scratch_root(spark: SparkSession) -> str:
    """Folder for intermediate tables: below ``spark.checkpoint.dir``, which every executor
    reaches. Only a local master without that setting falls back to a temporary folder."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    master = spark.conf.get("spark.master", "")
    single = master == "local" or master.startswith("local[")
    if not base:
        if not single:
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = _local_scratch()
    return f"{base.rstrip('/')}/tallyline/{spark.conf.get('spark.app.id', 'session')}"


# Scratch paths handed out inside the innermost open scope.
_scope: ContextVar[list[str] | None] = ContextVar("scope", default=None)


def scratch_path(spark: SparkSession, label: str) -> str:
    path = f"{scratch_root(spark)}/{label}-{uuid4().hex}"
    if (paths := _scope.get()) is not None:
        paths.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Remove the scratch tables made inside when the block ends, also when it fails. Nothing that leaves the
    block may still read one of them. Covers what :func:`concurrently` runs; an inner scope removes its own."""
    paths: list[str] = []
    outer = _scope.set(paths)
    try:
        yield
    finally:
        _scope.reset(outer)
        for path in paths:
            store.remove(spark, path)


#: How tables that stay are stored: some three quarters of what Spark's default takes.
COMPRESSION = {"compression": "zstd"}

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of an action go when it ends. Otherwise they stay until the driver collects garbage,
    which it may not do for the whole of a load. Only the block that turned the setting on turns it off."""
    if spark.conf.get(_CLEANUP, "false") == "true":
        yield
        return
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, "false")


def stash(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the scratch folder and read it back.

    This cuts the lineage at a table that outlives any executor, so a plan may read the
    result several times and always see the same rows in the same places.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def path_missing() -> Iterator[None]:
    """Pass over the error of a path that does not exist; raise every other one."""
    try:
        yield
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise


def concurrently(tasks: Sequence[Callable[[], Any]], at_once: int = 4) -> list[Any]:
    """Run independent jobs side by side, so that one job's last tasks do not idle the rest
    of the cluster. Results keep the order of ``tasks``; the first failure is raised."""
    with ThreadPoolExecutor(max_workers=at_once) as pool:
        return [future.result() for future in [pool.submit(copy_context().run, task) for task in tasks]]


def once(make: Callable[[], Any]) -> Callable[[], Any]:
    """A function that calls ``make`` the first time only, also when several jobs that run side by side ask for it."""
    lock, made = Lock(), []

    def get() -> Any:
        with lock:
            if not made:
                made.append(make())
        return made[0]

    return get
