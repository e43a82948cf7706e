"""The shared folder that intermediate tables are written to."""

from __future__ import annotations

import gc
import time
import uuid
import weakref
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
WAREHOUSE_SETTING = "spark.sql.warehouse.dir"
_MOMENT = 0.2  # seconds
_owned: set[str] = set()
_passing: list[list[DataFrame]] = []
_written: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def shared_folder(spark: SparkSession) -> str:
    """A folder that every executor can reach, for this application: in the one that the cluster names, else in
    the session's warehouse. It is deleted when the application ends."""
    named = spark.conf.get(CHECKPOINT_SETTING, None) or spark.conf.get(WAREHOUSE_SETTING)
    folder = f"{named.rstrip('/')}/graphloom-{spark.sparkContext.applicationId}"
    if folder not in _owned:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        system = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
        system.mkdirs(path)
        system.deleteOnExit(path)
        _owned.add(folder)
    return folder


def new_location(spark: SparkSession, name: str) -> str:
    """A path in the shared folder nobody has used yet."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows, read back from a table in the shared folder: computed once, lost to no executor."""
    path = new_location(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    _written[out] = path
    for tables in _passing:
        tables.append(out)
    return out


@contextmanager
def passing_tables() -> Iterator[list[DataFrame]]:
    """The tables written in the block are dropped at its end, but for those that are taken out of the list."""
    tables: list[DataFrame] = []
    _passing.append(tables)
    try:
        yield tables
    finally:
        _passing[:] = [other for other in _passing if other is not tables]
    dropped(*[df for df in tables if df in _written])
    _sweep()


def dropped(*tables: DataFrame) -> None:
    """Delete `written` tables that nothing will read again: what was made of them is written itself. Spark deletes the shuffle files of
    finished plans once the driver's JVM has found that nobody holds them, so it is asked to look."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(_written.pop(df))
        path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
    _sweep()


def _sweep() -> None:
    session = SparkSession.getActiveSession()
    if session is not None:
        for _ in range(2):  # listeners hold the plan that has just ended for a moment more
            gc.collect()  # Python's hold on plans
            session._jvm.System.gc()
            time.sleep(_MOMENT)
