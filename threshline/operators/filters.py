"""Filters over entries, and the anti joins that keep sets apart."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threshline.functions import entries as E
from threshline.operators.ranking import literal, values_at

#: Ids broadcast at most; beyond it both sides are shuffled by id.
BROADCAST_IDS = 1_000_000


def keep_needed(entries: DataFrame, predicate: Column | None = None) -> DataFrame:
    return entries.filter(E.needed() if predicate is None else predicate)


def drop_hardest(entries: DataFrame, percent: float, min_difficulty: float = 0.0) -> DataFrame:
    """Without the hardest ``percent`` of the entries of ``min_difficulty`` or more; of
    equally hard ones the earliest go first. The share is rounded up."""
    percent = min(100.0, max(0.0, percent))
    d = E.difficulty()
    eligible = (d >= min_difficulty) & ~F.isnan(d)
    hard = entries.filter(eligible)
    cut_of = lambda n: -int(-(n * percent) // 100)
    total, found = values_at(hard.select(d.alias("d")), lambda n: [n - cut_of(n)])
    if not found:
        return entries
    ((least, smaller, equal),) = found.values()
    gone = d > least
    ties = cut_of(total) - (total - smaller - equal)
    if ties == equal:
        gone = d >= least
    else:
        _, last = values_at(hard.filter(d == least).select("_ord"), lambda _: [ties - 1])
        gone = gone | ((d == least) & (F.col("_ord") <= literal(last[ties - 1][0], entries.schema["_ord"].dataType)))
    return entries.filter(~F.coalesce(eligible & gone, F.lit(False)))


def loss_buckets(entries: DataFrame) -> DataFrame:
    """With loss_bucket: high, medium, low, zero; negative difficulties have none."""
    d = E.difficulty()
    named = F.when(d == 0, "zero").when(d > 0, E.bucket(d))
    return entries.withColumn("loss_bucket", named)


def ids_of(entries: DataFrame) -> DataFrame:
    return entries.select("id").distinct()


def without_ids(entries: DataFrame, ids: DataFrame) -> DataFrame:
    """Entries whose id is not among ``ids``; a null id is among none.

    The ids are broadcast only after they have been counted.
    """
    distinct = ids.select("id").distinct()
    few = distinct.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    return entries.join(F.broadcast(distinct) if few else distinct, "id", "left_anti")


def flips(entries: DataFrame) -> DataFrame:
    return entries.filter(E.is_flip())


def parse_stats(text: str | None) -> list[str]:
    """Stat names of a list with commas or semicolons."""
    return [x.strip().lower() for x in (text or "").replace(";", ",").split(",") if x.strip()]


def allowed_stats(entries: DataFrame, stats: Iterable[str]) -> DataFrame:
    """Entries whose target is among ``stats``; all if there are none."""
    wanted = [s.strip().lower() for s in stats if s.strip()]
    return entries.filter(F.lower(F.trim("target.attr")).isin(wanted)) if wanted else entries


def scored(entries: DataFrame) -> DataFrame:
    return entries.filter(F.col("loss_metrics").isNotNull())


def at_least(entries: DataFrame, difficulty: float) -> DataFrame:
    return entries.filter(E.difficulty() >= difficulty)


def search(entries: DataFrame, query: str, whole: bool = False) -> DataFrame:
    """Entries with ``query`` in their id, or anywhere in their JSON form."""
    q = F.lit(query.lower())
    if not whole:
        return entries.filter(F.contains(F.lower(F.coalesce("id", F.lit(""))), q))
    shown = [c for c in entries.columns if not c.startswith("_")]
    return entries.filter(F.contains(F.lower(F.to_json(F.struct(*shown))), q))


def mislabelled(entries: DataFrame, threshold: float = 8.0) -> DataFrame:
    return entries.filter(E.worst_loss() > threshold)


def finite_only(entries: DataFrame, value: Column) -> DataFrame:
    return entries.filter(E.finite(value))
