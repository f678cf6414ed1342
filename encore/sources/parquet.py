"""Parquet sources and sinks.

* ``load_dataset``: the interactions / tracks / users triple of one split.
* ``write_table`` / ``read_table``: Parquet sink and re-read.
* ``materialize``: cut a plan's lineage by writing it to the shared checkpoint
  folder and reading it back (survives executor loss, unlike a local cache).
"""

from __future__ import annotations

import contextlib
import contextvars
import copy
import gc
import os
import queue
import threading
import weakref
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from encore.schemas import INTERACTIONS_SCHEMA, TRACKS_SCHEMA
from encore.session import SCRATCH, scratch_path


def dataset_paths(split: str = "train", version: str = "small", data_dir: str = "") -> dict[str, str]:
    """File names of one split; ``version='small'`` selects the ``_small`` files."""
    suffix = "_small" if version == "small" else ""
    return {
        name: os.path.join(data_dir, f"{name}_{split}{suffix}.parquet")
        for name in ("interactions", "tracks", "users")
    }


def load_dataset(
    spark: SparkSession,
    version: str = "small",
    split: str = "train",
    data_dir: str = "",
    declare_schema: bool = True,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Load ``(interactions, tracks, users)`` of a split.

    Interactions and tracks are read with declared schemas so that a file
    with a wrong layout fails at the first scan; the users table is passed
    through untouched (no column of it is used downstream).
    """
    paths = dataset_paths(split, version, data_dir)
    reader = spark.read
    interactions = (reader.schema(INTERACTIONS_SCHEMA) if declare_schema else reader).parquet(
        paths["interactions"]
    )
    tracks = (spark.read.schema(TRACKS_SCHEMA) if declare_schema else spark.read).parquet(paths["tracks"])
    users = spark.read.parquet(paths["users"])
    return interactions, tracks, users


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> str:
    """Write ``df`` as Parquet (replacing what is there by default)."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back.

    A barrier between stages: later actions start from the written files
    instead of recomputing the plan, and the files outlive any executor.
    The table is freed with the scratch scope it was written in.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    write_table(df, path)
    return read_table(spark, path)


@contextlib.contextmanager
def shuffles_freed(spark: SparkSession):
    """Inside the block a job's exchange files go when it ends, not when the driver's memory is next collected.

    For jobs that are run once and written, one after the other.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before) if before is not None else spark.conf.unset(key)


def free(spark: SparkSession, *paths: str) -> None:
    """Delete scratch tables that are read no more, and what only unreachable frames still hold on disk."""
    _delete(spark, list(paths))
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def side_by_side(spark: SparkSession, *builds: Callable[[], DataFrame]) -> list[DataFrame]:
    """Results of independent builds, run at the same time: their jobs share the cluster.

    Each runs in a thread that inherits the caller's local properties and
    scratch scope.
    """
    with ThreadPoolExecutor(len(builds)) as pool:
        # each thread runs in a copy of the caller's context: same scope, same list of paths
        waiting = [pool.submit(contextvars.copy_context().run, inheritable_thread_target(spark)(build)) for build in builds]
        return [done.result() for done in waiting]


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists in its Hadoop file system (shared storage or local)."""
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(jpath)


def file_states(spark: SparkSession, path: str) -> list[str]:
    """Name, size and time of the files of a table, in the order of their names."""
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files = fs.listStatus(jpath)
    return sorted(f"{f.getPath()} {f.getLen()} {f.getModificationTime()}" for f in files)


def _delete(spark: SparkSession, paths: list[str]) -> int:
    """Delete paths through their Hadoop file system (shared storage or local)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    removed = 0
    for path in paths:
        jpath = jvm.org.apache.hadoop.fs.Path(path)
        if jpath.getFileSystem(conf).delete(jpath, True):
            removed += 1
    return removed


@contextlib.contextmanager
def scratch_scope(spark: SparkSession):
    """Delete, on exit, the scratch tables written inside the block.

    For jobs: their intermediate tables are read only inside the job. Tables
    written before the block (still read by other frames) stay.
    """
    paths: list[str] = []
    token = SCRATCH.set(paths)
    try:
        yield paths
    finally:
        SCRATCH.reset(token)
        _delete(spark, paths)


# Scratch tables whose frames are gone, for the thread that deletes them.
_UNUSED: queue.SimpleQueue = queue.SimpleQueue()
_CLEANER_STARTED = threading.Event()


def _clean() -> None:
    while True:
        spark, paths = _UNUSED.get()
        with contextlib.suppress(Exception):  # the session may have ended meanwhile
            _delete(spark, paths)


def owning_scratch(build: Callable[[SparkSession, str], DataFrame], spark: SparkSession, sf_dir: str) -> DataFrame:
    """``build``'s frame, owning the scratch tables that were written for it.

    The frame gets a session handle of its own, which every frame derived from
    it shares; when the last of them is gone, so are the tables. A frame that
    only takes this one in as a join's other side does not keep them: hold the
    query's frame until its result is written.
    """
    paths: list[str] = []
    token = SCRATCH.set(paths)
    try:
        frame = build(spark, sf_dir)
    except BaseException:
        _delete(spark, paths)
        raise
    finally:
        SCRATCH.reset(token)
    if not paths:
        return frame
    if not _CLEANER_STARTED.is_set():
        _CLEANER_STARTED.set()
        threading.Thread(target=_clean, daemon=True, name="encore-scratch").start()
    handle = copy.copy(frame.sparkSession)
    # only a queue is touched here: the last reference may go in the middle of another call to the JVM
    weakref.finalize(handle, _UNUSED.put, (spark, paths)).atexit = False
    return type(frame)(frame._jdf, handle)
