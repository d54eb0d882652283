"""Tables that operators write for themselves, in the folder that all executors share."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; one of our own only where none is set, as in tests on one machine."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext._jsc.sc().getCheckpointDir()
        path = path.get() if path.isDefined() else None
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("on a cluster, set spark.checkpoint.dir to a folder that all executors share")
        path = f"file://{tempfile.mkdtemp(prefix='spark-shared-')}"
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


_lock, _writers = threading.Lock(), {}
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Removes the shuffle files of the queries within as each ends, not when the driver happens to collect garbage.

    The session's own setting holds again when the last thread leaves.
    """
    with _lock:
        n, before = _writers.get(spark, (0, spark.conf.get(RELEASE, None)))
        _writers[spark] = (n + 1, before)
        spark.conf.set(RELEASE, "true")
    try:
        yield
    finally:
        with _lock:
            n, before = _writers.pop(spark)
            if n > 1:
                _writers[spark] = (n - 1, before)
            elif before is None:
                spark.conf.unset(RELEASE)
            else:
                spark.conf.set(RELEASE, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Cuts the lineage: writes `df` as a table in the shared folder and reads it back. Its shuffles are gone with that."""
    path = scratch(df.sparkSession, name)
    with released(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    _PATHS[out] = path
    return out


#: Where the tables that `stored` returned lie, while they are referred to.
_PATHS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def delete(spark: SparkSession, path: str) -> None:
    """Removes a table's folder, on any file system that Spark can reach."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def is_whole(spark: SparkSession, path: str) -> bool:
    """Whether a job has written the folder to its end."""
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def discard(df: DataFrame) -> None:
    """Removes a table that `stored` returned, for whoever knows that nothing reads it any more."""
    delete(df.sparkSession, _PATHS.pop(df))
