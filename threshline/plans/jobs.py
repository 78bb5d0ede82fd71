"""Whole jobs: prepare texts, assemble training and evaluation sets, export, inspect.

Each is one lazy plan, cut only where a result feeds several others. Deliberate
differences from a list-based implementation are named where they are made:
regularization is the true rest of the selection, epochs are batched apart, and
synthetic rows are decontaminated if asked to.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threshline import schema as S
from threshline.functions import entries as E
from threshline.operators import batching, cache, dedupe, export, filters, parse, passes, reports, sampling, scoring
from threshline.sources import readers, writers
from threshline.storage import cut_lineage

CACHE_SCHEMA = "dp_key string, version string, entry string, created_at timestamp, last_used timestamp"
CHAINS = {"train": passes.CHAT_TRAIN, "eval": passes.CHAT_EVAL, "synthetic": passes.SYNTHETIC}


@dataclass
class Prepare:
    chain: str = "train"
    allowed_stats: Sequence[str] = ()
    with_loss: bool = True
    budget: int = scoring.BATCH_TOKENS
    cache_path: str | None = None
    scorer: Callable[[], scoring.Scorer] = scoring.HashScorer


def prepare(files: DataFrame, options: Prepare | None = None) -> DataFrame:
    """Entries of annotated texts: parsed, augmented, filtered, scored.

    With a cache, entries of datapoints that a run of the same version has made are
    taken from it; only the others are made, and added to it.
    """
    options = options or Prepare()
    chain = CHAINS[options.chain]
    points = parse.parse(files)
    if not options.cache_path:
        return _make(points, chain, options)
    spark = files.sparkSession
    scored = {"scorer": cache.described(options.scorer), "budget": options.budget} if options.with_loss else None
    version = cache.run_version(chain, {"stats": sorted(options.allowed_stats), "scored": scored})
    points = cut_lineage(points.withColumn("dp_key", passes.content_key()), "points")
    old = cache.read(spark, options.cache_path, CACHE_SCHEMA)
    known = old.filter(F.col("version") == version)
    hits, todo = cache.split(points, known.select("dp_key", "entry"), ["dp_key"])
    # A cached entry keeps its text, and gets the place that it now comes from.
    found = hits.select(F.from_json("entry", S.ENTRY).alias("e"), F.col("source_id").alias("_source"), F.struct("_file", "_line", "_part").alias("_ord")).select("e.*", "_source", "_ord")
    moved = F.when(F.startswith("id", F.col("source_id")), F.concat(F.col("_source"), F.substring(F.col("id"), F.length("source_id") + 1, F.length("id")))).otherwise(F.col("id"))
    found = found.withColumn("id", moved).withColumn("source_id", F.col("_source")).select(*S.ENTRY.names, "_ord")
    made = cut_lineage(_make(todo, chain, options, ("dp_key",)), "made")
    # Equal datapoints of one run make equal entries; those of one are enough to keep.
    sole = todo.groupBy("dp_key").agg(F.min("source_id").alias("source_id"))
    fresh = made.join(sole, ["dp_key", "source_id"]).select("dp_key", F.lit(version).alias("version"), F.to_json(F.struct(*S.ENTRY.names)).alias("entry"))
    now = F.current_timestamp()
    used = cache.touch(old, hits.select("dp_key", F.lit(version).alias("version")), ["dp_key", "version"])
    made_rows = made.select(*S.ENTRY.names, F.struct("_ord._file", "_ord._line", "_ord._part").alias("_ord"))
    out = cut_lineage(found.unionByName(made_rows), "prepared")
    cache.save(used.unionByName(fresh.withColumns({"created_at": now, "last_used": now})), options.cache_path)
    return out


def _make(points: DataFrame, chain: Sequence[passes.Pass], options: Prepare, keep: tuple[str, ...] = ()) -> DataFrame:
    entries = parse.to_entries(passes.run_passes(points, chain), keep)
    entries = filters.allowed_stats(entries, options.allowed_stats)
    return filters.scored(scoring.score(entries, options.scorer, options.budget)) if options.with_loss else entries


@dataclass
class Assembly:
    batch: int = sampling.TRAIN_BATCH
    batches: int = sampling.TRAIN_BATCHES
    regular: int = sampling.REGULAR_BATCHES
    eval_size: int = sampling.EVAL_SIZE
    big_eval_size: int = 2000
    epochs: int = 1
    low_per_epoch: int = 1000
    exclude_percent: float = 0.0
    exclude_min: float = 0.0
    clean_synthetic: bool = False
    engineered: bool = False
    seed: int = 1337
    existing_eval: DataFrame | None = field(default=None, repr=False)


def assemble(train: DataFrame, synthetic: DataFrame, evaluation: DataFrame, options: Assembly | None = None) -> dict[str, DataFrame]:
    """The second stage: eval, big_eval, train_high (batched), train_low, synth_flips.

    All inputs are entries with _ord unique over all of them.
    """
    o = options or Assembly()
    train, synthetic, evaluation = (filters.keep_needed(x) for x in (train, synthetic, evaluation))
    train = filters.drop_hardest(train, o.exclude_percent, o.exclude_min)
    seeds = filters.at_least(evaluation, S.EVAL_MIN_DIFFICULTY)
    chosen = o.existing_eval if o.existing_eval is not None else sampling.balanced_eval(seeds, train.filter(E.bucket() == "medium"), o.eval_size, seed=o.seed)
    chosen = cut_lineage(chosen, "eval")
    train = cut_lineage(filters.without_ids(train, filters.ids_of(chosen)), "train")
    if o.clean_synthetic:
        synthetic = filters.without_ids(synthetic, filters.ids_of(chosen))
    big = sampling.big_eval(chosen, synthetic, train, o.big_eval_size, seed=o.seed)
    selected, regular = sampling.split_training(train, synthetic, o.batch, o.batches, o.regular, o.seed)
    every = sampling.epochs(selected, synthetic, o.epochs, o.low_per_epoch, o.seed).drop("_key")
    if o.engineered:
        high = batching.engineer(every, o.batch, batching.plan_balanced, o.seed)
    else:
        high = batching.deal(every, o.batch, o.seed)
    return {
        "eval": chosen.orderBy(*dedupe.order_by_length()), "big_eval": big, "train_high": high, "train_low": regular,
        "synth_flips": filters.flips(synthetic),
    }


def assembly_reports(parts: dict[str, DataFrame], pool: DataFrame) -> dict[str, DataFrame]:
    """The reports that go with an assembly."""
    high = parts["train_high"]
    return {
        "buckets": reports.bucket_stats(high), "contributions": reports.file_contributions(high, pool, parts["eval"]), "zero_loss": reports.zero_loss_sources(pool),
        "median": reports.median_loss(parts["eval"]), "eval_attrs": reports.eval_attr_stats(parts["eval"]), "stat_buckets": reports.stat_buckets(high, pool),
        "batches": reports.batch_stats(high), "coverage": reports.coverage(high), "worst": dedupe.worst_unique(high), "completions": reports.completion_lengths(high),
    }


def assemble_stage0(train: DataFrame, evaluation: DataFrame, batch: int = 10, epochs: int = 1, seed: int = 1337, **options) -> dict[str, DataFrame]:
    """The first stage: padded epochs batched by attribute, evaluation by prompt length."""
    train, evaluation = filters.keep_needed(train), filters.keep_needed(evaluation)
    return {"train": batching.stage0_epochs(train, batch, epochs, seed, **options), "eval": evaluation.orderBy(*dedupe.order_by_length())}


def embeddings(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Wrapped stat lines of train and eval texts; either being empty is an error."""
    out = {s: export.embedding_lines(readers.stat_lines(readers.text_lines(spark, path, f".{s}.txt"))) for s in ("train", "eval")}
    for split, rows in out.items():
        if rows.isEmpty():
            raise ValueError(f"no stat lines for {split} below {path}")
    return out


def chats(spark: SparkSession, path: str) -> DataFrame:
    return export.chats(parse.parse(readers.texts(spark, path)))


def inspect(entries: DataFrame, flips_only: bool = False, threshold: float | None = None, query: str | None = None, whole: bool = False) -> DataFrame:
    """What a reader of scored entries sees: the worst per id, filtered, the worst first."""
    rows = dedupe.worst_per_id(entries)
    rows = filters.flips(rows) if flips_only else rows
    rows = filters.mislabelled(rows, threshold) if threshold is not None else rows
    rows = filters.search(rows, query, whole) if query else rows
    return rows.orderBy(*dedupe.order_for_viewing(F.col("loss_metrics.worst_loss")))


def main(argv: Sequence[str] | None = None) -> None:
    """Command line: prepare, assemble, stage0, embeddings, chats."""
    p = argparse.ArgumentParser(prog="threshline", description="Prepare dialogue training data with Spark.")
    sub = p.add_subparsers(dest="job", required=True)
    one = sub.add_parser("prepare")
    one.add_argument("--chain", choices=CHAINS, default="train")
    one.add_argument("--stats", default="")
    one.add_argument("--cache")
    one.add_argument("--no-loss", action="store_true")
    one.add_argument("--budget", type=int, default=scoring.BATCH_TOKENS)
    one.add_argument("--model", help="an exported causal model to score by; needs --tokenizer")
    one.add_argument("--tokenizer")
    one.add_argument("--end-token")
    two = sub.add_parser("assemble")
    sizes = {"batch": "batch", "batches": "batches", "regular": "regular", "eval-size": "eval_size", "big-eval-size": "big_eval_size", "epochs": "epochs", "low-per-epoch": "low_per_epoch", "seed": "seed"}
    for name, key in sizes.items():
        two.add_argument(f"--{name}", type=int, default=getattr(Assembly, key))
    for name in ("exclude-percent", "exclude-min"):
        two.add_argument(f"--{name}", type=float, default=0.0)
    two.add_argument("--clean-synthetic", action="store_true", help="synthetic rows lose the evaluation's ids, too")
    two.add_argument("--engineered", action="store_true", help="plan batches row by row, epoch by epoch")
    two.add_argument("--existing-eval", help="an evaluation set that is there already")
    two.add_argument("--synthetic")
    two.add_argument("--eval", required=True)
    zero = sub.add_parser("stage0")
    zero.add_argument("--eval", required=True)
    zero.add_argument("--batch", type=int, default=10)
    zero.add_argument("--epochs", type=int, default=1)
    for name in ("embeddings", "chats"):
        sub.add_parser(name)
    for s in sub.choices.values():
        s.add_argument("input")
        s.add_argument("output")
        s.add_argument("--clean", action="store_true")
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName("threshline").getOrCreate()
    if a.clean:
        writers.clean(spark, a.output)
    if a.job == "prepare":
        scorer = scoring.OnnxScorer(a.model, a.tokenizer, a.end_token) if a.model else scoring.HashScorer
        options = Prepare(a.chain, filters.parse_stats(a.stats), not a.no_loss, a.budget, a.cache, scorer)
        writers.entries(prepare(readers.texts(spark, a.input), options), a.output, F.col("_ord"))
    elif a.job == "chats":
        writers.jsonl(chats(spark, a.input), a.output, F.col("_ord"))
    elif a.job == "embeddings":
        for split, rows in embeddings(spark, a.input).items():
            writers.jsonl(rows, f"{a.output}/{split}")
    else:
        train, held = readers.jsonl(spark, a.input), readers.jsonl(spark, a.eval)
        if a.job == "stage0":
            parts = assemble_stage0(train, held, a.batch, a.epochs)
        else:
            synthetic = readers.jsonl(spark, a.synthetic) if a.synthetic else train.limit(0)
            existing = readers.jsonl(spark, a.existing_eval) if a.existing_eval else None
            given = {key: getattr(a, key) for key in [*sizes.values(), "exclude_percent", "exclude_min", "clean_synthetic", "engineered"]}
            parts = assemble(train, synthetic, held, Assembly(**given, existing_eval=existing))
        for name, rows in parts.items():
            order = [F.col(c) for c in ("epoch", "batch_id", "pos") if c in rows.columns] or dedupe.order_by_length()
            writers.entries(rows, f"{a.output}/{name}", *order)


if __name__ == "__main__":
    main()
