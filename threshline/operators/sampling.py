"""Quotas, stratified samples, evaluation sets, epochs and padding.

Every "random" order is a hash of the row's key and the seed, so a result depends on
data and seed alone, and SQL elsewhere can follow it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threshline import schema as S
from threshline.functions import entries as E
from threshline.operators import dedupe
from threshline.operators.filters import at_least, without_ids
from threshline.operators.ranking import global_rank
from threshline.storage import cut_lineage

#: Quotas of the configured jobs.
#: Attributes whose tables are broadcast; more are joined by shuffling.
BROADCAST_ATTRS = 100_000
TRAIN_BATCH, TRAIN_BATCHES, REGULAR_BATCHES, EVAL_SIZE = 24, 1000, 500, 540


def if_few(small: DataFrame, rows: int) -> DataFrame:
    """A table to broadcast, if its counted rows are few."""
    return F.broadcast(small) if rows <= BROADCAST_ATTRS else small


def shuffled(seed: int) -> Column:
    return E.order_key(F.col("_ord"), seed)


def take(entries: DataFrame, count: int, *order: Column) -> DataFrame:
    """The first ``count`` rows of an order; none for 0 or less."""
    return entries.orderBy(*order).limit(max(0, count))


def allocate(sizes: DataFrame, total: int) -> DataFrame:
    """(attr, n, quota): ``total`` shared in proportion to n by the largest remainder;
    of equal remainders the last name goes first, and none gets more than it has."""
    everything = Window.partitionBy(F.lit(0))
    rows = sizes.withColumn("_all", F.sum("n").over(everything)).withColumn("_total", F.least(F.lit(total).cast("long"), F.col("_all")))
    rows = rows.withColumns({"_share": F.floor(F.expr("n * _total div _all")).cast("long"), "_rest": F.expr("n * _total % _all")})
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("_rest"), F.desc("attr")))
    left = F.col("_total") - F.sum("_share").over(everything)
    return rows.select("attr", "n", F.least("n", F.col("_share") + F.when(place <= left, 1).otherwise(0)).alias("quota"))


def sample_attrs(pool: DataFrame, quotas: DataFrame, correct: float, no_change: float, seed: int) -> DataFrame:
    """By attribute as many rows as its quota: a share of unchanged ones, and in each part
    a share of correct ones; what one part lacks, the other gives."""
    rows = pool.withColumns({"_attr": E.attr(), "_flip": E.is_flip(), "_same": E.is_no_change()})
    sizes = rows.groupBy("_attr").agg(*[F.count_if((F.col("_same") == s) & (F.col("_flip") == f)).alias(f"n{int(s)}{int(f)}") for s in (False, True) for f in (False, True)])
    most, attrs = quotas.agg(F.coalesce(F.max("quota"), F.lit(0)), F.count("*")).first()
    plan = sizes.join(if_few(quotas.select(F.col("attr").alias("_attr"), "quota"), attrs), "_attr")

    def half_even(c: Column) -> Column:
        return F.bround(c, 0).cast("long")

    plan = plan.withColumns({"s1": F.col("n10") + F.col("n11"), "s0": F.col("n00") + F.col("n01")})
    plan = plan.withColumn("t1", F.least("s1", half_even(F.col("quota") * no_change)))
    plan = plan.withColumn("t0", F.least("s0", F.col("quota") - F.col("t1")))
    plan = plan.withColumn("t1", F.least("s1", F.col("quota") - F.col("t0")))
    for side in ("0", "1"):
        right, wrong, want = F.col(f"n{side}0"), F.col(f"n{side}1"), F.col(f"t{side}")
        plan = plan.withColumn(f"c{side}", F.least(right, half_even(want * correct)))
        plan = plan.withColumn(f"f{side}", F.least(wrong, want - F.col(f"c{side}")))
        plan = plan.withColumn(f"c{side}", F.least(right, want - F.col(f"f{side}")))
    plan = plan.select("_attr", "c0", "f0", "c1", "f1")

    place = F.row_number().over(Window.partitionBy("_attr", "_same", "_flip").orderBy(shuffled(seed)))
    # The literal bound lets Spark cut every stratum in each task, before it is shuffled.
    ranked = rows.withColumn("_place", place).filter(F.col("_place") <= int(most)).join(if_few(plan, attrs), "_attr")
    quota = F.when(F.col("_same"), F.when(F.col("_flip"), F.col("f1")).otherwise(F.col("c1"))).otherwise(F.when(F.col("_flip"), F.col("f0")).otherwise(F.col("c0")))
    return ranked.filter(F.col("_place") <= quota).select(*pool.columns)


def balanced_eval(seeds: DataFrame, pool: DataFrame, size: int = EVAL_SIZE, correct: float = 0.5, no_change: float = 0.25, seed: int = 1337) -> DataFrame:
    """An evaluation set: the seeds by distinct id, then a sample of the pool balanced by
    attribute, then any of the pool's other ids, until there are ``size`` rows."""
    first = cut_lineage(dedupe.first_per_id(seeds), "seeds")
    n = first.count()
    if n >= size:
        return take(first, size, F.col("_ord"))
    rest = cut_lineage(dedupe.first_per_id(without_ids(pool, first)), "pool")
    quotas = allocate(rest.groupBy(E.attr().alias("attr")).agg(F.count("*").alias("n")), size - n)
    chosen = cut_lineage(sample_attrs(rest, cut_lineage(quotas, "quotas"), correct, no_change, seed), "chosen")
    missing = size - n - chosen.count()
    more = take(rest.join(chosen.select("_ord"), "_ord", "left_anti"), missing, shuffled(seed))
    return first.unionByName(chosen).unionByName(more)


def big_eval(evaluation: DataFrame, synthetic: DataFrame, pool: DataFrame, size: int, medium_share: float = 0.25, seed: int = 1337) -> DataFrame:
    """The evaluation set, synthetic rows of other ids, then medium and low entries of
    the pool: ``medium_share`` of what is missing medium, the rest low."""
    base = dedupe.first_per_id(evaluation)
    extra = dedupe.first_per_id(at_least(synthetic, S.EVAL_MIN_DIFFICULTY), seen=base)
    both = cut_lineage(base.unionByName(extra), "big")
    missing = max(0, size - both.count())
    rest = dedupe.first_per_id(without_ids(pool, both)).withColumn("_b", E.bucket())
    n_medium = int(missing * medium_share)
    medium = cut_lineage(take(rest.filter("_b = 'medium'"), n_medium, shuffled(seed)), "medium")
    low = take(rest.filter("_b = 'low'"), missing - medium.count(), shuffled(seed))
    return both.unionByName(medium.drop("_b")).unionByName(low.drop("_b"))


def split_training(pool: DataFrame, synthetic: DataFrame, batch: int = TRAIN_BATCH, batches: int = TRAIN_BATCHES, regular: int = REGULAR_BATCHES, seed: int = 1337) -> tuple[DataFrame, DataFrame]:
    """(selected, regularization): the pool's hardest that fill the batches beside the
    synthetic rows, and a sample of the true rest."""
    n = pool.count()
    count = min(n, max(0, batches * batch - synthetic.count()))
    ranked = cut_lineage(global_rank(pool, *dedupe.order_by_bucket()), "selection")
    rest = ranked.filter(F.col("rank") > count).drop("rank")
    return ranked.filter(F.col("rank") <= count).drop("rank"), take(rest, regular * batch, shuffled(seed))


def epochs(selected: DataFrame, synthetic: DataFrame, n: int, low_per_epoch: int, seed: int = 1337) -> DataFrame:
    """``selected`` and ``synthetic`` once an epoch, with an own sample of low entries;
    ``epoch`` and the place in it (``_key``) come with each row."""
    numbers = F.explode(F.sequence(F.lit(0), F.lit(n - 1))) if n > 0 else F.explode(F.array().cast("array<int>"))
    hard = E.bucket().isin("high", "medium")
    low = selected.filter(~hard).withColumn("epoch", numbers)
    low = low.withColumn("_key", E.order_key(F.col("_ord"), F.col("epoch") + seed))
    place = F.row_number().over(Window.partitionBy("epoch").orderBy("_key"))
    low = low.withColumn("_n", place).filter(F.col("_n") <= low_per_epoch).drop("_n")
    every = selected.filter(hard).unionByName(synthetic).withColumn("epoch", numbers)
    every = every.withColumn("_key", E.order_key(F.col("_ord"), F.col("epoch") + seed))
    return every.unionByName(low)


def pad(entries: DataFrame, batch: int, seed: int = 1337) -> DataFrame:
    """Rows up to a multiple of ``batch``: copies are dealt over the attributes in turn,
    the rarest first; ``_is_padding_duplicate`` marks them."""
    n = entries.count()
    needed = -n % batch if n else 0
    plain = entries.withColumn("_is_padding_duplicate", F.lit(False))
    if not needed:
        return plain
    sizes = entries.groupBy(E.attr().alias("_attr")).agg(F.count("*").alias("_n"), F.min("_ord").alias("_first"))
    turn = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("_n", "_first")) - 1
    turns = sizes.select("_attr", "_n", turn.alias("_turn"), F.count("*").over(Window.partitionBy(F.lit(0))).alias("_attrs"))
    slots = entries.sparkSession.range(needed).select(F.col("id").cast("int").alias("_slot"))
    # slot s belongs to the attribute of turn s mod attrs, and takes that attribute's next row
    dealt = slots.join(F.broadcast(turns), F.col("_slot") % F.col("_attrs") == F.col("_turn"))
    dealt = dealt.select("_slot", "_attr", (F.floor(F.col("_slot") / F.col("_attrs")) % F.col("_n") + 1).alias("_place"))
    place = F.row_number().over(Window.partitionBy("_attr").orderBy("_k"))
    members = entries.withColumns({"_attr": E.attr(), "_k": shuffled(seed)}).withColumn("_place", place).filter(F.col("_place") <= needed)
    copies = members.join(F.broadcast(dealt), ["_attr", "_place"]).select(*entries.columns, F.lit(True).alias("_is_padding_duplicate"))
    return plain.unionByName(copies)


def fixed_batches(entries: DataFrame, size: int = 35) -> DataFrame:
    """``batch_id`` of consecutive rows by prompt length."""
    return global_rank(entries, *dedupe.order_by_length()).withColumn("batch_id", F.expr(f"(rank - 1) div {size}").cast("int")).drop("rank")


def replicate(rows: DataFrame, copies: Column) -> DataFrame:
    """Each row ``copies`` times, numbered by ``_copy``; none for 0 or less."""
    numbered = rows.withColumn("_n", copies.cast("int")).filter(F.col("_n") > 0)
    return numbered.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_n")))).drop("_n")

