"""Caches of finished work as Parquet tables, keyed by content and run version."""

from __future__ import annotations

import dataclasses
import hashlib
import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from threshline import schema as S
from threshline.storage import cut_lineage


def described(made: object) -> dict:
    """What is called, and with which options: those that a pass notes as its ``options``,
    or a dataclass's fields."""
    options = dataclasses.asdict(made) if dataclasses.is_dataclass(made) and not isinstance(made, type) else getattr(made, "options", {})
    owner = made if hasattr(made, "__qualname__") else type(made)
    return {"name": f"{owner.__module__}.{owner.__qualname__}", "options": options}


def run_version(passes: Sequence[object], options: dict) -> str:
    """A run's version: its passes with their options, the data format's fixed values, and
    all else that changes results."""
    fixed = {k: v for k, v in vars(S).items() if k.isupper() and not isinstance(v, T.DataType)}
    parts = {"passes": [p if isinstance(p, str) else described(p) for p in passes], "options": options, "fixed": fixed}
    return hashlib.sha1(json.dumps(parts, sort_keys=True, default=str).encode()).hexdigest()


def read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The cache at ``path``; empty if there is none yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def split(rows: DataFrame, cached: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(hits with the cache's columns, rows that still have to be made)."""
    hits = rows.join(cached, list(keys))
    return hits, rows.join(cached.select(*keys).distinct(), list(keys), "left_anti")


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``old`` with ``new`` in place of equal keys; created_at stays that of the old row."""
    now = new.withColumn("last_used", F.current_timestamp())
    born = old.select(*keys, F.col("created_at").alias("_born"))
    fresh = now.join(born, list(keys), "left").withColumn("created_at", F.coalesce("_born", "last_used")).drop("_born")
    return old.join(new.select(*keys).distinct(), list(keys), "left_anti").unionByName(fresh)


def touch(cached: DataFrame, used: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The cache with last_used of the used keys set to now."""
    marks = used.select(*keys).distinct().withColumn("_used", F.lit(True))
    return cached.join(marks, list(keys), "left").withColumn("last_used", F.when(F.col("_used"), F.current_timestamp()).otherwise(F.col("last_used"))).drop("_used")


def save(cache: DataFrame, path: str) -> None:
    """Replace the cache at ``path``; the new rows are whole before the old ones go."""
    cut_lineage(cache, "cache").write.mode("overwrite").parquet(path)


def move_source(entries: DataFrame, source_id: str) -> DataFrame:
    """Cached entries under another source: source_id, and the id's part of it."""
    old = F.col("source_id")
    moved = F.when(F.startswith(F.col("id"), old), F.concat(F.lit(source_id), F.substring(F.col("id"), F.length(old) + 1, F.length("id")))).otherwise(F.col("id"))
    return entries.withColumn("id", moved).withColumn("source_id", F.lit(source_id))


def forget(cached: DataFrame, key: str, column: str = "file_key") -> DataFrame:
    """The cache without a file's rows; letter case counts only if some row matches exactly."""
    exact = not cached.filter(F.col(column) == key).isEmpty()
    hit = F.col(column) == key if exact else F.lower(column) == key.lower()
    return cached.filter(~F.coalesce(hit, F.lit(False)))


def forget_datapoints(datapoints: DataFrame, files: DataFrame) -> DataFrame:
    """The datapoints' cache without the keys that ``files`` (dp_key) name."""
    return datapoints.join(files.select("dp_key").distinct(), "dp_key", "left_anti")


def summary(hits: DataFrame, made: DataFrame) -> DataFrame:
    return hits.agg(F.count("*").alias("reused")).crossJoin(made.agg(F.count("*").alias("regenerated")))
