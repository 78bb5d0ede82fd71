"""One thin query per operator over its whole table, and SQL where SQL can tell."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from public_tokenizers import path as tokenizer_file
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threshline.llm import bpe, langid, lattice, lines, minhash, prefixfree, suffixtree, topk, urlfilter, winnow
from threshline.llm.common import drop_tables, held_out, small_batches, tables_written
from threshline.session import table

TOKENIZER = tokenizer_file("word_bpe_49k.json")
PIECES = tokenizer_file("piece_bpe_32k.model")
URL_RULES = [
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
]


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The documents; texts can be long, so few go to Python at once."""
    small_batches(spark)
    return table(spark, sf_dir, "documents").select(*columns)


def op1_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's marginal probability, and its add-one unigram baseline."""
    docs = documents(spark, sf_dir, "doc_id", "text", "lang")
    scored = lattice.score_corpus(docs, PIECES, ~held_out("doc_id", 7), classes="lang")
    return scored.select("doc_id", held_out("doc_id", 7).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op2_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language by a model of the rows that are not held out."""
    docs = documents(spark, sf_dir, "doc_id", "text", "lang")
    langs, model = langid.fit(docs, ~held_out("doc_id", 4))
    return langid.predict(docs.select("doc_id", "text"), langs, model).select("doc_id", held_out("doc_id", 4).alias("held_out"), "lang_pred", "score")


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's group of near copies, on 3-word shingles at 85 percent."""
    docs = documents(spark, sf_dir, "doc_id", "text")
    return minhash.near_duplicates(docs, 3, 85).select("doc_id", "n_shingles", "component_id", "kept")


def op4_suffixtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words of repeated 35-word windows."""
    left = suffixtree.drop_repeats(documents(spark, sf_dir, "doc_id", "text"))
    return left.select("doc_id", F.col("n_units").alias("n_words"), "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op5_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that an earlier line repeats."""
    left = lines.dedup_lines(documents(spark, sf_dir, "doc_id", "text"), copy_words=1)
    kept = F.sha2(F.coalesce("text", F.lit("")), 256)
    return left.select("doc_id", "n_lines", F.col("n_lines_removed").alias("n_removed"), kept.alias("kept_sha256"))


def op6_prefixfree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of repeated 400-byte strings."""
    left = prefixfree.drop_repeats(documents(spark, sf_dir, "doc_id", "text"))
    return left.select("doc_id", F.col("n_units").alias("n_bytes"), "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op7_url_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's verdict by the url rules."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urlfilter.judge(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens, and what they decode to, as digests."""
    docs = documents(spark, sf_dir, "doc_id", "text")
    lexicon = bpe.train_lexicon(docs, TOKENIZER)
    coded = bpe.encode(docs, TOKENIZER, lexicon, keep=["doc_id"], decoded="decoded")
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op9_winnow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's share of words inside benchmark windows."""
    docs = documents(spark, sf_dir, "doc_id", "text")
    found = winnow.find_spans(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        winnow.contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
    )


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best rows for every hundredth vector."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def tidy(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """The query, without the written tables that its result doesn't read."""

    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        before = tables_written()
        out = query(spark, sf_dir)
        drop_tables(spark, before, keep=out)
        return out

    return run


QUERIES = {q.__name__: tidy(q) for q in (op1_lattice, op2_langid, op3_minhash, op4_suffixtree, op5_lines, op6_prefixfree, op7_url_cascade, op8_bpe, op9_winnow, op10_topk)}

_HOST = r"translate(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ORACLES = {
    "op7_url_cascade": f"""
WITH rules(kind, h, p) AS (VALUES {", ".join(f"('{k}', '{h}', '{p}')" for k, h, p in URL_RULES)}),
parts AS (
  SELECT page_id, coalesce({_HOST}, '') AS host,
         coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
numbered AS (SELECT row_number() OVER () AS n, * FROM parts),
fits AS (
  SELECT n, h || p AS rule, kind,
         row_number() OVER (PARTITION BY n ORDER BY length(h || p) DESC, kind DESC) AS k
  FROM numbered JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
SELECT page_id, host, path, rule, coalesce(kind, 'allow') AS verdict
FROM numbered LEFT JOIN fits ON fits.n = numbered.n AND k = 1
""",
    "op10_topk": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id),
ranked AS (
  SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
  FROM scores)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
""",
    "op9_winnow": r"""
WITH words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents),
docs AS (SELECT row_number() OVER () AS r, doc_id, w, len(w) AS n FROM words),
items AS (
  SELECT item_id, w, len(w) AS n, least(len(w), 13) AS k FROM (
    SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
    FROM benchmark) WHERE len(w) > 0),
asked AS (
  SELECT DISTINCT item_id, k, array_to_string(w[p0:p0 + k - 1], ' ') AS span
  FROM (SELECT *, unnest(range(1, n - k + 2)) AS p0 FROM items)),
own AS (
  SELECT r, k, p0, array_to_string(w[p0:p0 + k - 1], ' ') AS span
  FROM (SELECT r, w, k, unnest(range(1, n - k + 2)) AS p0 FROM docs, (SELECT DISTINCT k FROM asked) WHERE n >= k)),
hits AS (SELECT r, p0, k, item_id FROM own JOIN asked USING (k, span)),
cover AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(p0, p0 + k)) AS p FROM (SELECT DISTINCT r, p0, k FROM hits)) GROUP BY r),
listed AS (SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM hits GROUP BY r)
SELECT doc_id, n AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= n AS contaminated
FROM docs LEFT JOIN cover USING (r) LEFT JOIN listed USING (r)
""",
}
