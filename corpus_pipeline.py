"""A corpus from raw documents to tokens, in stages that each call one operator.

Every stage works on all rows that the one before kept, and its decisions take
effect: rows or lines that it rejects are gone from its result. Results are
written as Parquet and read again by the next stage.

Defined results of every stage: rows with a null id or text, empty and very long texts,
repeated rows and an empty table are handled as the stage's operator defines it; all
columns of the input are passed on, whatever their names, in their order; a column that
the stage doesn't need may be missing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threshline.llm import bpe, langid, lines, minhash, winnow
from threshline.llm.common import broadcast_if, drop_tables, held_out, materialize, small_batches, tables_written
from threshline.llm.queries import TOKENIZER
from threshline.session import table

#: A document whose best language is less likely than this is rejected.
LEAST_SCORE = 0.5
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def own_columns(docs: DataFrame) -> list[Column]:
    """A stage's input columns, whatever their names."""
    return [F.col(f"`{c}`") for c in docs.columns]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter go (null and empty texts, too), and those whose best learned
    language isn't likely beside the others. A text in a language that was not learned
    mostly resembles some learned one more than the rest, and then stays."""
    small_batches(spark)
    langs, model = langid.fit(docs, ~held_out("doc_id", 4))
    found = langid.predict(docs, langs, model, out="__language", score="__score")
    return found.filter((F.col("__language") != langid.UNDETERMINED) & (F.col("__score") >= LEAST_SCORE)).select(*own_columns(docs))


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier line repeats go, and documents that have no other lines; n_chars,
    where there is one, follows the text. Documents that lose nothing stay as they are."""
    small_batches(spark)
    left = lines.dedup_lines(docs, counts=("__lines", "__removed"), copy_words=1).filter((F.col("__removed") == 0) | (F.trim("text") != ""))
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.when(F.col("__removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return left.select(*own_columns(docs))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near duplicates the document with the smallest id stays, in all rows
    that repeat it; documents with a null id or no words stay."""
    small_batches(spark)
    gone = minhash.near_duplicates(docs).filter(~F.col("kept")).select(F.col("doc_id").alias("__copy"), F.col("text_hash").alias("__hash")).distinct()
    gone = materialize(gone, "copies")
    some = broadcast_if(gone, gone.count(), minhash.BROADCAST_ROWS)
    return docs.join(some, (F.col("doc_id") == F.col("__copy")) & (F.xxhash64("text") == F.col("__hash")), "left_anti")


def benchmark_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a twentieth of their words in benchmark windows go; those without words stay."""
    found = winnow.find_spans(docs, table(spark, sf_dir, "benchmark"))
    bad = found.filter(winnow.contaminated(F.col("n_hit"), F.col("n_words"))).select(F.col("doc_id").alias("__bad"), F.col("_text_hash").alias("__hash")).distinct()
    bad = materialize(bad, "contaminated")
    some = broadcast_if(bad, bad.count(), winnow.BROADCAST_ROWS)
    same = F.col("doc_id").eqNullSafe(F.col("__bad")) & (F.xxhash64("text") == F.col("__hash"))
    return docs.join(some, same, "left_anti")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, decoded of every row that is left; a null text has no tokens."""
    small_batches(spark)
    texts = docs.select("doc_id", "text")
    lexicon = bpe.train_lexicon(texts, TOKENIZER)
    coded = bpe.encode(texts, TOKENIZER, lexicon, keep=["doc_id"], decoded="decoded")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES: list[tuple[str, Stage]] = [
    ("language", language),
    ("lines", repeated_lines),
    ("near_copies", near_copies),
    ("benchmark", benchmark_text),
    ("tokens", tokens),
]

#: Language models, hash bands and merges are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table of documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        before = tables_written()
        docs = materialize(stage(spark, docs, sf_dir), name)
        drop_tables(spark, before, keep=docs)  # what the stage wrote for itself
    return docs
