"""Global ranks without gathering a table in one task."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threshline.storage import cut_lineage

_BITS = 33


def global_rank(df: DataFrame, *order: Column, name: str = "rank") -> DataFrame:
    """``df`` with ``name``: 1, 2, .. in ``order``, which has to be total.

    Rows are sorted by ranges; a row's rank is its place in its range plus the rows of
    earlier ranges. One row per range, not the table, meets in one task.
    """
    placed = cut_lineage(df.orderBy(*order).withColumn("_m", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("_m", _BITS)
    sizes = placed.groupBy(part.alias("_p")).agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select("_p", before.alias("_before"))
    ranked = placed.withColumn("_p", part).join(F.broadcast(sizes), "_p")
    inside = F.col("_m") - F.shiftleft(F.col("_p"), _BITS)
    return ranked.withColumn(name, (F.col("_before") + inside + 1).cast("long")).select(*df.columns, name)


def values_at(values: DataFrame, places: Callable[[int], Sequence[int]]) -> tuple[int, dict[int, tuple]]:
    """How many values that aren't null the one column of ``values`` holds, and for each of
    the ``places`` (of that number) in ascending order, from 0: (value, how many are
    smaller, how many are equal).

    Distinct values are counted, sorted by ranges and summed up range by range, so neither
    the values nor their counts meet in one task; a row for each place comes to the driver.
    """
    name = values.columns[0]
    counts = values.filter(F.col(name).isNotNull()).groupBy(F.col(name).alias("v")).agg(F.count("*").alias("n"))
    placed = cut_lineage(counts.orderBy("v").withColumn("_p", F.spark_partition_id()), "values")
    ranges = placed.groupBy("_p").agg(F.sum("n").alias("_n")).orderBy("_p").collect()  # a row per range
    total = sum(r["_n"] for r in ranges)
    wanted = sorted({i for i in places(total) if 0 <= i < total})
    if not wanted:
        return total, {}
    starts, first = [], 0
    for r in ranges:
        starts.append((r["_p"], first))
        first += r["_n"]
    starts = F.broadcast(values.sparkSession.createDataFrame(starts, "_p int, _first long"))
    inside = F.coalesce(F.sum("n").over(Window.partitionBy("_p").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = placed.withColumn("_i", inside).join(starts, "_p").withColumn("_i", F.col("_i") + F.col("_first"))
    held = F.filter(F.array(*map(F.lit, wanted)), lambda i: (i >= F.col("_i")) & (i < F.col("_i") + F.col("n")))
    return total, {r.i: (r.v, r["_i"], r.n) for r in ranked.select("v", "_i", "n", F.explode(held).alias("i")).collect()}


def percentiles(values: DataFrame, shares: Sequence[float]) -> tuple[int, list[float | None]]:
    """How many doubles the one column of ``values`` holds, and their exact percentiles,
    between neighbours by distance; null if there are none."""
    spots = lambda n: [p * (n - 1) for p in shares]
    total, found = values_at(values, lambda n: [i for s in spots(n) for i in (math.floor(s), math.ceil(s))])
    if not total:
        return 0, [None] * len(shares)

    def between(s: float) -> float:
        low, high = math.floor(s), math.ceil(s)
        return found[low][0] if low == high else (high - s) * found[low][0] + (s - low) * found[high][0]

    return total, [between(s) for s in spots(total)]


def literal(value: object, kind: T.DataType) -> Column:
    """A collected value as a column, also if it is a struct."""
    if isinstance(kind, T.StructType):
        return F.struct(*[literal(x, f.dataType).alias(f.name) for x, f in zip(value, kind, strict=True)])
    return F.lit(value).cast(kind)


def first_per(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """One row per key, the first in ``order``; partial sums leave each task, so that a
    key with a third of all rows is no task's burden."""
    whole = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    spot = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])
    kept = df.groupBy(*keys).agg(F.min_by(whole, spot).alias("_row"))
    return kept.select("_row.*")
