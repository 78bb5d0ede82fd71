"""Deduplication, orders, limits and set operations over entries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threshline.functions import entries as E
from threshline.operators.filters import without_ids
from threshline.operators.ranking import first_per


def has_id() -> Column:
    return F.coalesce(F.col("id") != "", F.lit(False))


def first_per_id(entries: DataFrame, seen: DataFrame | None = None) -> DataFrame:
    """The earliest entry of each id; entries without an id all stay. Ids in ``seen`` go."""
    named = entries.filter(has_id())
    if seen is not None:
        named = without_ids(named, seen)
    return first_per(named, ["id"], F.col("_ord")).unionByName(entries.filter(~has_id()))


def distinct_rows(entries: DataFrame) -> DataFrame:
    """Each loaded row once, by its own key."""
    return entries.dropDuplicates(["_ord"])


def worst_per_id(entries: DataFrame) -> DataFrame:
    """Each id's entry of the highest worst loss, the earliest of equals; entries
    without an id all stay."""
    return first_per(entries.filter(has_id()), ["id"], -E.worst_loss(), F.col("_ord")).unionByName(entries.filter(~has_id()))


def pick_unique(entries: DataFrame, count: int, exclude: DataFrame | None = None) -> DataFrame:
    """The first ``count`` needed entries of distinct ids; none for 0 or less."""
    named = entries.filter(E.needed() & has_id())
    if exclude is not None:
        named = without_ids(named, exclude)
    return first_per(named, ["id"], F.col("_ord")).orderBy("_ord").limit(max(0, count))


def worst_unique(entries: DataFrame, count: int = 50) -> DataFrame:
    """The worst losses over distinct ids (without an id: ``unknown``), worst first."""
    named = entries.withColumn("id", F.when(has_id(), F.col("id")).otherwise("unknown")).withColumn("_w", E.worst_loss())
    return first_per(named, ["id"], -F.col("_w"), F.col("_ord")).orderBy(F.desc("_w"), "_ord").limit(count).drop("_w")


def longest_per_source(entries: DataFrame) -> DataFrame:
    """Each source's longest prompt, the earliest of equals."""
    sized = entries.withColumns({"source": F.coalesce("source_id", F.lit("")), "prompt_length": F.coalesce(F.length("prompt"), F.lit(0)).cast("long")})
    return first_per(sized, ["source"], -F.col("prompt_length"), F.col("_ord"))


def prompt_length() -> Column:
    return F.coalesce(F.length("prompt"), F.lit(0))


def order_by_difficulty(reverse: bool = False) -> list[Column]:
    """Difficulty, then length; ties keep the input's order either way."""
    keys = [E.difficulty(), prompt_length()]
    return [*[k.desc() if reverse else k.asc() for k in keys], F.asc("_ord")]


def order_by_flip(nonflips_first: bool = True) -> list[Column]:
    """Non-flips (or flips) first, then the hardest, then the longest."""
    flip = F.when(E.is_flip(), 1).otherwise(0)
    return [flip.asc() if nonflips_first else flip.desc(), E.difficulty().desc(), prompt_length().desc(), F.asc("_ord")]


def order_by_bucket() -> list[Column]:
    priority = F.when(E.bucket() == "high", 2).when(E.bucket() == "medium", 1).otherwise(0)
    return [priority.desc(), E.difficulty().desc(), prompt_length().desc(), F.asc("_ord")]


def order_by_length() -> list[Column]:
    return [prompt_length().asc(), F.asc("_ord")]


def order_for_viewing(metric: Column) -> list[Column]:
    """A metric downwards, what is no number last."""
    return [E.sort_metric(metric).desc(), F.asc("_ord")]


def order_by_source() -> list[Column]:
    """Source, the worst of each first, then id."""
    return [F.lower(F.coalesce("source_id", F.lit(""))).asc(), E.sort_metric(F.col("loss_metrics.worst_loss")).desc(), F.coalesce("id", F.lit("")).asc(), F.asc("_ord")]


def concat(*pools: DataFrame) -> DataFrame:
    """One bag of all pools; ``_pool`` tells them apart, in the order given."""
    out = pools[0].withColumn("_pool", F.lit(0))
    for i, pool in enumerate(pools[1:], 1):
        out = out.unionByName(pool.withColumn("_pool", F.lit(i)))
    return out
