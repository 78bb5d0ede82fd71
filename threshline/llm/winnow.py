"""Benchmark decontamination by winnowing (operator 9), DataFrame functions only.

Benchmark windows of one length ``n`` are a family of their own: of every ``w``
consecutive k-gram hashes the smallest is kept as a fingerprint, with
``k + w - 1 = n``, so two texts that share ``n`` words in a row keep a common
fingerprint of that family: every shared span is found. The documents' fingerprints
meet the benchmark's family by family; documents that share one are extended, by
windows of that family's length only, which are compared word for word with the
benchmark's. A short item so costs windows of its own length and no others.

Only tables counted to stay within ``BROADCAST_ROWS`` are broadcast; beyond it Spark
joins by shuffling. Hashes only choose what to compare, they never decide.

Defined results: null text has no words; a document without words is clean; items
without words have no window; items with null id hit words but aren't listed; every
row of the documents gives a row, also those that repeat another; an empty table of
documents gives an empty table, and without items nothing is hit. Only the id and the
text are read, so other columns, whatever their names, don't matter. A text is one
array of words, so a row, however long its text, is the unit of work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threshline.llm.common import broadcast_if, materialize

#: Words of a benchmark window; a shorter item is one window.
WINDOW = 13
BROADCAST_ROWS = 200_000
_CUT = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """Lowered words; ASCII-only text takes the fast way to lower A-Z."""
    low = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))
    return F.array_remove(F.split(F.coalesce(low, F.lit("")), _CUT), "")


def grams(hashes: str, k: int) -> Column:
    """Hashes of all k-grams of a column of word hashes; it needs k words at least."""
    return F.transform(F.sequence(F.lit(0), F.size(hashes) - k), lambda i: F.xxhash64(*[F.get(F.col(hashes), i + j) for j in range(k)]))


def winnowed(gram_hashes: str, w: int) -> Column:
    """The smallest of every w consecutive hashes; it needs w hashes at least."""
    found = F.transform(
        F.sequence(F.lit(0), F.size(gram_hashes) - w),
        lambda i: F.least(*[F.get(F.col(gram_hashes), i + j) for j in range(w)]) if w > 1 else F.get(F.col(gram_hashes), i),
    )
    return F.array_distinct(found)


def windows(items: DataFrame, item_id: str, text: str, window: int) -> DataFrame:
    """(item_id, n, words, span) of every window of every item with words."""
    w = items.select(F.col(item_id).alias("item_id"), words_of(F.col(text)).alias("all")).filter(F.size("all") > 0)
    w = w.withColumn("n", F.least(F.size("all"), F.lit(window)))
    w = w.select("item_id", "n", "all", F.explode(F.sequence(F.lit(1), F.size("all") - F.col("n") + 1)).alias("at"))
    return w.select("item_id", "n", F.slice("all", F.col("at"), F.col("n")).alias("words")).withColumn("span", F.array_join("words", " "))


def fingerprints(df: DataFrame, words: str, n: int, out: str) -> DataFrame:
    """``df`` with the fingerprints of the family ``n``; null for texts of fewer words.

    Each step is a column of its own, for an expression inside a lambda would be
    evaluated anew for every element.
    """
    k = (n + 1) // 2
    names = df.columns
    hashed = df.select(*names, F.when(F.size(words) >= n, F.transform(words, lambda x: F.xxhash64(x))).alias("_h"))
    gram = hashed.select(*names, grams("_h", k).alias("_g"))
    return gram.select(*names, winnowed("_g", n - k + 1).alias(out))


def find_spans(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per row of ``docs``: doc_id, _text_hash, n_words, n_hit, spans (array of
    struct<start, n>, ascending), items (array of ids as strings, sorted)."""
    asked = materialize(windows(items, item_id, item_text, window), "windows")
    lengths = {r.n: r.rows for r in asked.groupBy("n").agg(F.count("*").alias("rows")).collect()}  # at most ``window`` of them
    n_windows = sum(lengths.values())

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("_text_hash"))
    own = rows.select("doc_id", "_text_hash", words_of(F.col("text")).alias("words")).withColumn("n_words", F.size("words").cast("long"))
    for n in lengths:
        own = fingerprints(own, "words", n, f"prints_{n}")
    own = materialize(own.drop("words"), "prints")

    # A window's grams are as many as a fingerprint is chosen from, so their smallest is one of its document's.
    near = None
    for n, count in lengths.items():
        heads = fingerprints(asked.filter(F.col("n") == n).select("words"), "words", n, "prints").select(F.get("prints", F.lit(0)).alias("print")).distinct()
        found = own.select("doc_id", "_text_hash", F.explode(f"prints_{n}").alias("print")).join(broadcast_if(heads, count, BROADCAST_ROWS), "print", "left_semi")
        found = found.select("doc_id", "_text_hash", F.lit(n).alias("n"))
        near = found if near is None else near.unionByName(found)
    if near is None:
        near = own.select("doc_id", "_text_hash", F.lit(0).alias("n")).limit(0)
    near = materialize(near.groupBy("doc_id", "_text_hash").agg(F.collect_set("n").alias("ns")), "near")

    kinds = asked.groupBy("span", "n").agg(F.collect_set(F.col("item_id").cast("string")).alias("items"))
    same = [F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")), F.col("a._text_hash").eqNullSafe(F.col("b._text_hash"))]
    some = broadcast_if(near, near.count(), BROADCAST_ROWS)
    close = rows.alias("a").join(some.alias("b"), on=same[0] & same[1]).select("a.*", "ns").dropDuplicates(["doc_id", "_text_hash"])
    starts = close.select("doc_id", "_text_hash", words_of(F.col("text")).alias("words"), F.explode("ns").alias("n"))
    starts = starts.select("doc_id", "_text_hash", "words", "n", F.explode(F.sequence(F.lit(1), F.size("words") - F.col("n") + 1)).alias("at"))
    spans = starts.select("doc_id", "_text_hash", "n", (F.col("at") - 1).alias("start"), F.array_join(F.slice("words", F.col("at"), F.col("n")), " ").alias("span"))
    hits = spans.join(broadcast_if(kinds, n_windows, BROADCAST_ROWS), ["span", "n"])
    per_doc = hits.groupBy("doc_id", "_text_hash").agg(
        F.array_sort(F.collect_list(F.struct("start", "n"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    per_doc = per_doc.withColumn("n_hit", covered("spans"))
    out = own.alias("a").join(per_doc.alias("b"), on=same[0] & same[1], how="left")
    none = F.array().cast("array<string>")
    return out.select(
        "a.doc_id", "a._text_hash", "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("spans", F.array().cast("array<struct<start:int,n:int>>")).alias("spans"),
        F.coalesce("items", none).alias("items"),
    )


def covered(spans: str) -> Column:
    """Positions inside any of the ascending spans."""
    start = F.struct(F.lit(0).alias("reach"), F.lit(0).alias("total"))

    def step(s: Column, x: Column) -> Column:
        end = x["start"] + x["n"]
        fresh = F.greatest(F.lit(0), end - F.greatest(s["reach"], x["start"]))
        return F.struct(F.greatest(s["reach"], end).alias("reach"), (s["total"] + fresh).alias("total"))

    return F.aggregate(spans, start, step, lambda s: s["total"])


def contaminated(n_hit: Column, n_words: Column) -> Column:
    """At least one word in twenty is hit."""
    return (n_hit > 0) & (20 * n_hit >= n_words)
