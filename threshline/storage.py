"""Tables that a job writes for itself, in the folder that all executors share."""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

#: Tables that this process has written and not deleted, by path, the oldest first.
_WRITTEN: dict[str, None] = {}


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session. Only a local session without one (as in
    tests) gets a folder of its own, which goes when the process ends."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        own = tempfile.mkdtemp(prefix="threshline-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        at = "file://" + own
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def cut_lineage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back. A lost executor
    costs nothing then: the table is in shared storage."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _WRITTEN[path] = None
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Inside, what a query has shuffled goes from disk as soon as it ends; otherwise it
    stays until the driver happens to collect its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, was)


def tables_written() -> list[str]:
    """The tables so far, for ``drop_tables``."""
    return list(_WRITTEN)


def drop_tables(spark: SparkSession, before: list[str], keep: DataFrame) -> None:
    """Delete what was written after ``before``, but not the files that ``keep`` reads."""
    kept = keep.inputFiles()
    for path in [p for p in _WRITTEN if p not in set(before)]:
        if not any(f"/{path.rsplit('/', 1)[1]}/" in f for f in kept):
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
            del _WRITTEN[path]
