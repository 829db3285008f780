"""Session construction and the shared folder for checkpoints and snapshots."""

from __future__ import annotations

import os
import re
import tempfile
import threading
import uuid
import warnings
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
#: Drops the shuffle files of a job when it ends, and not when the driver happens to collect its plan.
SHUFFLES_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class _Scopes(threading.local):
    """The tables, by their folders, that were written in each of the blocks this thread has open."""

    def __init__(self) -> None:
        self.open: list[dict[str, DataFrame]] = []


_SCOPES = _Scopes()
# per session the open blocks of all threads, and the setting before the first of them
_HOLDERS: WeakKeyDictionary[SparkSession, tuple[int, str | None]] = WeakKeyDictionary()
_LOCK = threading.Lock()


def build_session(app: str = "ledgerbrook", master: str | None = None, partitions: int | None = None) -> SparkSession:
    """Session with the settings the operators rely on (UTC, AQE).

    ``master`` and ``partitions`` are for tests and benchmarks; on a cluster both
    come from spark-submit.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master:
        builder = (
            builder.master(master)
            .config("spark.ui.enabled", "false")
            .config("spark.driver.memory", os.environ.get("LEDGERBROOK_DRIVER_MEMORY", "12g"))
        )
    if partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    The setting is taken at its word, as Spark takes it: a path on the machine's own file
    system may be mounted everywhere, so a cluster is only warned of it. Only a local
    session may fall back to a temporary folder: on a cluster such a folder would not
    survive the loss of the machine that holds it.
    """
    context = spark.sparkContext
    path = spark.conf.get(CHECKPOINT_CONF, None) or context.getConf().get(CHECKPOINT_CONF, None)
    named = context._jsc.sc().getCheckpointDir()
    if not path and named.isDefined():
        path = named.get()
    one_machine = re.fullmatch(r"local(\[.*\])?", context.master) is not None
    if path and not one_machine and "://" not in path and not path.startswith("file:"):
        # without a scheme the default file system decides; the machine's own is right only where it is mounted
        default = context._jsc.hadoopConfiguration().get("fs.defaultFS") or "file:///"
        if default.startswith("file:"):
            warnings.warn(f"{CHECKPOINT_CONF}={path} names no file system: all machines must mount this folder", stacklevel=2)
    if not path:
        if not one_machine:
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder all executors can reach")
        # remembered by the context, since the setting itself cannot be changed in a running session
        path = tempfile.mkdtemp(prefix="ledgerbrook-")
    if named.isEmpty():
        context.setCheckpointDir(path)
    return path


def run_dir(spark: SparkSession, label: str) -> str:
    """A fresh sub-folder of the shared folder for one run."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder so that lost executors cost no recomputation.

    Inside ``scratch`` that is a table of the block, elsewhere a checkpoint.
    """
    shared_dir(df.sparkSession)
    if _SCOPES.open:
        return _table(df, _SCOPES.open[-1])
    return df.checkpoint(eager=True)


def _table(df: DataFrame, scope: dict[str, DataFrame] | None) -> DataFrame:
    """``df`` as a compressed Parquet table, which goes with its block, or with the session where there is none."""
    spark = df.sparkSession
    path = run_dir(spark, "cut")
    if scope is None:
        fs, found = _file_system(spark, path)
        fs.deleteOnExit(found)
    else:
        scope[path] = df
    df.write.option("compression", "zstd").parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    if scope is not None:
        scope[path] = table
    return table


def discard(table: DataFrame) -> None:
    """Remove a table of the innermost block before that ends; a DataFrame that is none is left alone."""
    scope = _SCOPES.open[-1] if _SCOPES.open else {}
    for path in [p for p, kept in scope.items() if kept is table]:
        del scope[path]
        remove(table.sparkSession, path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Keep on disk only what is still needed: for jobs of many steps.

    What ``cut_lineage`` writes inside the block are compressed tables that are removed when the block ends, and
    each job inside gives up its shuffle files when it ends. What the block yields writes a table that stays: the
    only one that may be read afterwards. It belongs to the block around this one, if any.
    """
    opened = _SCOPES.open
    outer = opened[-1] if opened else None
    opened.append({})
    try:
        with _shuffles_given_up(spark):
            yield lambda df: _table(df, outer)
    finally:
        for path in opened.pop():
            remove(spark, path)


@contextmanager
def _shuffles_given_up(spark: SparkSession) -> Iterator[None]:
    with _LOCK:
        holders, before = _HOLDERS.get(spark) or (0, spark.conf.get(SHUFFLES_CONF, None))
        _HOLDERS[spark] = holders + 1, before
        spark.conf.set(SHUFFLES_CONF, "true")
    try:
        yield
    finally:
        with _LOCK:
            holders, before = _HOLDERS.pop(spark)
            if holders > 1:
                _HOLDERS[spark] = holders - 1, before
            elif before is None:
                spark.conf.unset(SHUFFLES_CONF)
            else:
                spark.conf.set(SHUFFLES_CONF, before)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that nothing reads any more."""
    fs, found = _file_system(spark, path)
    fs.delete(found, True)


def _file_system(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found
