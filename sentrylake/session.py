"""Session helpers: settings the engine relies on, and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

#: Used only where the session names no shared folder (single-machine tests).
_LOCAL_SCRATCH: dict[str, str] = {}
#: (name, path) of the tables written within the innermost ``working`` of a thread.
_WRITTEN: ContextVar[list[tuple[str, str]] | None] = ContextVar("written", default=None)


def build_session(app: str = "sentrylake", cores: str = "*", shuffle: int = 8, **conf: str) -> SparkSession:
    """A local session with the settings that results depend on (UTC, ANSI, AQE)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where a local session leaves it unset (tests) a temporary folder of this process is used; on a
    cluster, where machines share no such folder, that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_SCRATCH:
        _LOCAL_SCRATCH[app] = "file://" + tempfile.mkdtemp(prefix=f"sentrylake-{os.getpid()}-")
    return _LOCAL_SCRATCH[app]


#: So many rows a task, at most, where each row costs much.
ROWS_A_TASK = 50_000


def tasks_for(rows: DataFrame) -> int:
    """How many tasks a table whose rows cost much is dealt to: all cores, and more where it is large."""
    return max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // ROWS_A_TASK))


#: So many wide rows are shuffled at once, at most.
ROWS_AT_ONCE = 1_000_000


def materialise(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = _new_path(df.sparkSession, name)
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def in_slices(spark: SparkSession, rows: int, name: str, make: Callable[[Callable[[DataFrame, str], DataFrame]], DataFrame]) -> DataFrame:
    """A table of ``rows`` wide rows made slice after slice and written, so that no more than ROWS_AT_ONCE are shuffled at once.

    ``make`` is given a function that takes from a table the rows whose key is of the slice; tables that are
    joined are cut by the same key. Every row is of one slice. Few rows are one slice, which is not cut.
    """
    path, n = _new_path(spark, name), max(1, -(-rows // ROWS_AT_ONCE))
    for i in range(n):
        made = make((lambda table, key: table.where(F.pmod(F.xxhash64(key), F.lit(n)) == i)) if n > 1 else (lambda table, key: table))
        made.write.option("compression", "zstd").mode("append").parquet(path)
        if i + 1 < n:
            _drop_shuffles(spark)
    return spark.read.schema(made.schema).parquet(path)


def _new_path(spark: SparkSession, name: str) -> str:
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    written = _WRITTEN.get()
    if written is not None:
        written.append((name, path))
    return path


def _drop_shuffles(spark: SparkSession) -> None:
    """Spark deletes the files of shuffles that no frame reads any more once the driver's garbage is collected."""
    spark.sparkContext._jvm.java.lang.System.gc()


def discard(table: DataFrame) -> None:
    """Delete the files of a table that was written; nothing may read it later."""
    for path in {file.rpartition("/")[0] for file in table.inputFiles()}:
        _delete(table.sparkSession, path)


def _delete(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def working(spark: SparkSession, *kept: str) -> Iterator[None]:
    """Tables that this thread writes within are deleted at the end, all but those named.

    Nothing that is read later may read a deleted one. Shuffles that no frame reads any more are dropped as well.
    """
    outer, mine = _WRITTEN.get(), []
    token = _WRITTEN.set(mine)
    try:
        yield
    finally:
        _WRITTEN.reset(token)
        if outer is not None:
            outer.extend(x for x in mine if x[0] in kept)
        for path in (path for name, path in mine if name not in kept):
            _delete(spark, path)
        _drop_shuffles(spark)


def at_once(spark: SparkSession, *made: Callable[[], DataFrame]) -> list[DataFrame]:
    """Tables that do not read each other, made by a thread each; all have ended when there is an error."""
    held = inheritable_thread_target(spark)
    with ThreadPoolExecutor(len(made)) as pool:
        return [one.result() for one in [pool.submit(held(make)) for make in made]]
