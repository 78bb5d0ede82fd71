"""Reports over entries and batches, each a small table."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threshline import schema as S
from threshline.functions import entries as E
from threshline.operators.ranking import percentiles


def percent(part: Column, whole: Column) -> Column:
    """0.0 where there is no whole."""
    return F.when(whole > 0, 100.0 * part / whole).otherwise(F.lit(0.0))


def counts(entries: DataFrame) -> DataFrame:
    return entries.agg(F.count("*").alias("n"), F.count_if(E.is_flip()).alias("flips"), F.count_if(E.is_no_change()).alias("no_change"))


def bucket_stats(entries: DataFrame) -> DataFrame:
    """n, flips and no_change of each bucket and of all (``total``)."""
    rows = entries.select(E.bucket().alias("bucket"), E.is_flip().alias("flip"), E.is_no_change().alias("same"))
    out = rows.rollup("bucket").agg(F.count("*").alias("n"), F.count_if("flip").alias("flips"), F.count_if("same").alias("no_change"))
    return out.withColumn("bucket", F.coalesce("bucket", F.lit("total")))


def zero_loss_sources(entries: DataFrame) -> DataFrame:
    """Distinct ids of zero difficulty by file; entries without a file are ``unknown``."""
    zero = entries.filter(E.difficulty() == 0).select(F.coalesce(E.file_of(F.col("id")), F.lit("unknown")).alias("file"), "id")
    return zero.groupBy("file").agg(F.count_distinct("id").alias("ids"), F.count("*").alias("n"))


def file_contributions(selected: DataFrame, pool: DataFrame, evaluation: DataFrame) -> DataFrame:
    """What each file of the selection gives, and a TOTAL row.

    TOTAL's eval_pct is by the pool's rows, not by its distinct ids as the files' are.
    """
    file = E.file_of(F.col("id")).alias("file")
    sel = selected.select(file, E.is_flip().alias("flip"), E.difficulty().alias("d")).filter("file IS NOT NULL")
    sel = sel.groupBy("file").agg(F.count("*").alias("sel"), F.count_if("flip").alias("flips"), F.sum("d").alias("sum_d"))
    tot = pool.select(file, "id").groupBy("file").agg(F.count("*").alias("tot"), F.count_distinct("id").alias("ids"))
    held = evaluation.select(file, "id").groupBy("file").agg(F.count_distinct("id").alias("eval_ids"))
    rows = sel.join(tot, "file", "left").join(held, "file", "left").na.fill(0, ["tot", "ids", "eval_ids"])
    total = rows.agg(F.lit("TOTAL").alias("file"), *[F.coalesce(F.sum(c), F.lit(0)).cast("double" if c == "sum_d" else "long").alias(c) for c in ("sel", "flips", "sum_d", "tot", "ids", "eval_ids")])
    every = rows.withColumn("_by", F.col("ids")).unionByName(total.withColumn("_by", F.col("tot")))
    return every.select(
        "file", "sel", "tot", percent(F.col("sel"), F.col("tot")).alias("sel_pct"),
        "flips", percent(F.col("flips"), F.col("sel")).alias("flip_pct"),
        F.when(F.col("sel") > 0, F.col("sum_d") / F.col("sel")).otherwise(0.0).alias("avg_d"),
        "eval_ids", percent(F.col("eval_ids"), F.col("_by")).alias("eval_pct"),
    )


def median_loss(entries: DataFrame, least: float = S.EVAL_MIN_DIFFICULTY) -> DataFrame:
    """The exact median difficulty of ``least`` or more; 0.0 if there is none."""
    d = E.difficulty()
    _, (median,) = percentiles(entries.filter(d >= least).select(d.alias("d")), [0.5])
    return entries.sparkSession.createDataFrame([(0.0 if median is None else median,)], "median_loss double")


def attr_counts(entries: DataFrame) -> DataFrame:
    """n and share of every attribute, and its place: by count, then name."""
    n = entries.groupBy(E.attr().alias("attr")).agg(F.count("*").alias("n"), F.count_if(E.is_no_change()).alias("no_change"))
    everything = Window.partitionBy(F.lit(0))
    return n.select("attr", "n", "no_change", percent(F.col("n"), F.sum("n").over(everything)).alias("pct"), F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("n"), "attr")).alias("place"))


def eval_attr_stats(entries: DataFrame) -> DataFrame:
    """By attribute: how many are right, unchanged, and right among each."""
    rows = entries.select(E.attr().alias("attr"), (~E.is_flip()).alias("ok"), E.is_no_change().alias("same"))
    out = rows.groupBy("attr").agg(
        F.count("*").alias("n"), F.count_if("ok").alias("ok"), F.count_if("same").alias("same"), F.count_if(F.col("ok") & F.col("same")).alias("ok_same")
    )
    n, ok, same, both = (F.col(c) for c in ("n", "ok", "same", "ok_same"))
    share = percent(n, F.sum("n").over(Window.partitionBy(F.lit(0))))
    return out.select(
        "attr", "n", percent(ok, n).alias("correct_pct"), percent(same, n).alias("no_change_pct"), percent(both, same).alias("correct_same_pct"),
        percent(ok - both, n - same).alias("correct_changed_pct"), share.alias("share_pct"),
    )


def stat_buckets(selected: DataFrame, pool: DataFrame) -> DataFrame:
    """By attribute of the selection: n, flips, shares of the pool and of the selection."""
    sel = selected.groupBy(E.attr().alias("attr")).agg(F.count("*").alias("n"), F.count_if(E.is_flip()).alias("flips"))
    tot = pool.groupBy(E.attr().alias("attr")).agg(F.count("*").alias("pool"))
    rows = sel.join(tot, "attr", "left").na.fill(0, ["pool"])
    share = percent(F.col("n"), F.sum("n").over(Window.partitionBy(F.lit(0))))
    return rows.select("attr", "n", "flips", percent(F.col("n"), F.col("pool")).alias("pool_pct"), share.alias("selected_pct"))


def completion_lengths(entries: DataFrame, length: Column | None = None) -> DataFrame:
    """Sum, mean and largest length of completions, and how many are missing."""
    size = E.text_length(F.col("expected_value"), F.col("completion"), F.col("response")) if length is None else length
    known = F.when(size > 0, size)
    return entries.agg(
        F.coalesce(F.sum(known), F.lit(0)).cast("long").alias("total"), F.coalesce(F.avg(known), F.lit(0.0)).alias("mean"),
        F.coalesce(F.max(known), F.lit(0)).cast("long").alias("largest"), F.count_if(size == 0).alias("missing"),
    )


def _spread(df: DataFrame, column: str, name: str) -> list[Column]:
    c = F.col(column)
    return [F.avg(c).alias(f"{name}_mean"), F.coalesce(F.stddev_samp(c), F.lit(0.0)).alias(f"{name}_std"), F.min(c).alias(f"{name}_min"), F.max(c).alias(f"{name}_max")]


def batch_stats(batches: DataFrame) -> DataFrame:
    """Over batches: the spread of their mean and median difficulty and of distinct attributes."""
    per = batches.groupBy("batch_id").agg(F.avg(E.difficulty()).alias("mean"), F.median(E.difficulty()).alias("median"), F.count_distinct(E.attr()).cast("double").alias("attrs"))
    return per.agg(F.count("*").alias("batches"), *[x for c in ("mean", "median", "attrs") for x in _spread(per, c, c)])


def coverage(batches: DataFrame) -> DataFrame:
    """Batches that lack an attribute's entry, a flip or an unchanged entry."""
    per = batches.groupBy("batch_id").agg(F.count_if(E.is_flip()).alias("flips"), F.count_if(E.is_no_change()).alias("same"), F.count_if(E.bucket() == "high").alias("high"))
    return per.agg(F.count("*").alias("batches"), F.count_if(F.col("flips") == 0).alias("without_flip"), F.count_if(F.col("same") == 0).alias("without_no_change"), F.count_if(F.col("high") == 0).alias("without_high"))


def attr_batch_stats(batches: DataFrame) -> DataFrame:
    """By attribute over all batches, those without it included: least, most, missing."""
    cell = batches.groupBy("batch_id", E.attr().alias("attr")).agg(F.count("*").alias("n"))
    total = batches.agg(F.count_distinct("batch_id").alias("batches"))
    per = cell.groupBy("attr").agg(F.count("*").alias("present"), F.min("n").alias("least_present"), F.max("n").alias("most"))
    least = F.when(F.col("present") < F.col("batches"), 0).otherwise(F.col("least_present")).cast("long")
    return per.crossJoin(F.broadcast(total)).select("attr", least.alias("least"), "most", (F.col("batches") - F.col("present")).alias("missing"))


def batch_lengths(batches: DataFrame) -> DataFrame:
    """Spread of the batches' total prompt length, and of unchanged entries."""
    per = batches.groupBy("batch_id").agg(F.sum(F.length("prompt")).cast("double").alias("length"), F.count_if(E.is_no_change()).alias("same"))
    return per.agg(
        F.sum("length").cast("long").alias("length_sum"), *_spread(per, "length", "length"),
        F.min("same").alias("same_min"), F.max("same").alias("same_max"), F.count_if(F.col("same") == 0).alias("same_missing"),
    )


def difficulty_variance(entries: DataFrame) -> DataFrame:
    """Ids with two finite difficulties or more, and how they vary."""
    rows = entries.select("id", F.col("loss_metrics.completion_difficulty").alias("d")).filter(E.finite(F.col("d")) & (F.coalesce("id", F.lit("")) != ""))
    out = rows.groupBy("id").agg(
        F.count("*").alias("n"), F.avg("d").alias("mean"), F.var_samp("d").alias("variance"), F.stddev_samp("d").alias("std"), F.min("d").alias("least"), F.max("d").alias("most")
    )
    return out.filter("n >= 2").withColumn("range", F.col("most") - F.col("least"))


def flips_per_file(entries: DataFrame) -> DataFrame:
    return entries.filter(E.is_flip()).groupBy(F.coalesce(E.file_of(F.col("id")), F.lit("")).alias("file")).agg(F.count("*").alias("n"))


def histogram(entries: DataFrame, value: Column, clip: bool = True, bins: int | None = None) -> DataFrame:
    """Counts of finite values in equal bins; with ``clip`` the upper end is the 99th
    percentile, and what lies above goes to the last bin (``tail`` tells how many).

    The bins follow the number of values, so they are of bounded number.
    """
    rows = entries.filter(E.finite(value)).select(value.cast("double").alias("v"))
    n, (low, top, high) = percentiles(rows, [0.0, 0.99, 1.0])
    if not n:
        return entries.sparkSession.createDataFrame([], "bin int, low double, high double, n long, tail long")
    upper = top if clip and top > low else high
    k = bins or (min(60, max(10, 2 * math.isqrt(n))) if clip else min(100, max(10, math.isqrt(n))))
    width = (upper - low) / k if upper > low else 1.0
    at = F.least(F.floor((F.least("v", F.lit(upper)) - low) / width), F.lit(k - 1)).cast("int")
    found = rows.select(at.alias("bin"), (F.col("v") > upper).alias("over")).groupBy("bin").agg(F.count("*").alias("n"), F.count_if("over").alias("tail"))
    return found.select("bin", (low + F.col("bin") * width).alias("low"), (low + (F.col("bin") + 1) * width).alias("high"), "n", "tail")


def quantiles(entries: DataFrame, value: Column) -> DataFrame:
    """p10, p33.3, p66.7 and p90 of finite values, and whether bins want a log scale."""
    rows = entries.filter(E.finite(value)).select(value.cast("double").alias("v"))
    n, found = percentiles(rows, [0.1, 1 / 3, 2 / 3, 0.9])
    return entries.sparkSession.createDataFrame([(n, *found)], "n long, p10 double, p33 double, p67 double, p90 double")


def wants_log_scale(bins: DataFrame) -> DataFrame:
    """Whether the fullest bin holds over 50 times the emptiest."""
    return bins.filter("n > 0").agg(F.coalesce(F.max("n") > 50 * F.min("n"), F.lit(False)).alias("log_scale"))


def length_report(longest: DataFrame, count: int = 10) -> tuple[DataFrame, DataFrame]:
    """(the ``count`` longest prompts by source; mean and percentiles over sources)."""
    top = longest.orderBy(F.desc("prompt_length"), "_ord").limit(count).select("source", "id", "prompt_length")
    n = F.col("prompt_length")
    _, found = percentiles(longest.select(n.cast("double")), [0.5, 0.9, 0.95])
    named = [F.lit(x).cast("double").alias(name) for name, x in zip(("p50", "p90", "p95"), found, strict=True)]
    return top, longest.agg(F.count("*").alias("sources"), F.avg(n).alias("mean"), *named)


def neighbours(epochs: DataFrame) -> DataFrame:
    """(epoch, p, q): the distinct pairs p < q of ids that share a batch of an epoch."""
    rows = epochs.select("epoch", "batch_id", "id").distinct()
    x, y = rows.alias("x"), rows.alias("y")
    inside = (F.col("x.epoch") == F.col("y.epoch")) & (F.col("x.batch_id") == F.col("y.batch_id")) & (F.col("x.id") < F.col("y.id"))
    return x.join(y, inside).select(F.col("x.epoch").alias("epoch"), F.col("x.id").alias("p"), F.col("y.id").alias("q")).distinct()


def epoch_uniqueness(epochs: DataFrame) -> DataFrame:
    """How alike two epochs are, on average over pairs i < j: percent of ids in the same
    batch, and percent of neighbour pairs (two ids of a batch) of epoch i in j.

    ``epochs``: epoch, batch_id, id. An id that an epoch holds twice counts in its last batch.
    Pairs are made within a batch only, whose size is fixed.
    """
    last = epochs.groupBy("epoch", "id").agg(F.max("batch_id").alias("batch_id"))
    a, b = last.alias("a"), last.alias("b")
    both = a.join(b, (F.col("a.id") == F.col("b.id")) & (F.col("a.epoch") < F.col("b.epoch")))
    same = both.groupBy(F.col("a.epoch").alias("i"), F.col("b.epoch").alias("j")).agg(percent(F.count_if(F.col("a.batch_id") == F.col("b.batch_id")), F.count("*")).alias("same_pct"))

    pairs = neighbours(epochs)
    n_pairs = pairs.groupBy("epoch").agg(F.count("*").alias("pairs"))
    p, q = pairs.alias("p1"), pairs.alias("p2")
    met = p.join(q, (F.col("p1.p") == F.col("p2.p")) & (F.col("p1.q") == F.col("p2.q")) & (F.col("p1.epoch") < F.col("p2.epoch")))
    met = met.groupBy(F.col("p1.epoch").alias("i"), F.col("p2.epoch").alias("j")).agg(F.count("*").alias("met"))
    joined = same.join(met, ["i", "j"], "left").join(n_pairs.withColumnRenamed("epoch", "i"), "i", "left")
    return joined.agg(F.avg("same_pct").alias("same_batch_pct"), F.avg(percent(F.coalesce("met", F.lit(0)), F.col("pairs"))).alias("shared_pairs_pct"))
