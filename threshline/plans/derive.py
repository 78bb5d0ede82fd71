"""Inputs derived from the plain tables, and the same derivations in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threshline import schema as S
from threshline.session import table

#: Flat entries of line items; both engines run these same expressions.
_FIELDS = {
    "_ord": "concat_ws('|', lpad(cast(l_orderkey AS VARCHAR(20)), 12, '0'), lpad(cast(l_linenumber AS VARCHAR(20)), 4, '0'), lpad(cast(l_partkey AS VARCHAR(20)), 12, '0'), "
    "lpad(cast(l_suppkey AS VARCHAR(20)), 12, '0'), lpad(cast(cast(l_quantity AS BIGINT) AS VARCHAR(20)), 4, '0'), lpad(cast(cast(round(l_extendedprice * 100) AS BIGINT) AS VARCHAR(20)), 14, '0'), l_returnflag, l_linestatus, "
    "cast(cast(round(l_discount * 100) AS BIGINT) AS VARCHAR(20)), cast(cast(round(l_tax * 100) AS BIGINT) AS VARCHAR(20)), cast(cast(l_shipdate AS DATE) AS VARCHAR(20)))",
    "id": "CASE WHEN l_partkey % 97 = 0 THEN NULL ELSE concat(cast(l_orderkey AS VARCHAR(20)), ':', cast(l_linenumber AS VARCHAR(20))) END",
    "source_id": "concat('f', cast(l_orderkey % 50 AS VARCHAR(20)), ':', cast(l_orderkey AS VARCHAR(20)))",
    "subject": "concat('S', cast(l_suppkey AS VARCHAR(20)))",
    "raw_attr": "CASE WHEN l_suppkey % 10 = 3 THEN 'updated' WHEN l_suppkey % 50 = 7 THEN NULL WHEN l_suppkey % 50 = 8 THEN '' ELSE concat(l_returnflag, l_linestatus) END",
    "d": "CASE WHEN l_partkey % 89 = 0 THEN NULL WHEN l_partkey % 83 = 0 THEN -0.5 ELSE l_discount * 20 END",
    "w": "l_tax * 100 + l_linenumber",
    "tok": "CASE WHEN l_partkey % 71 = 0 THEN NULL ELSE l_returnflag END",
    "pred": "CASE WHEN l_quantity > 25 THEN l_returnflag ELSE l_linestatus END",
    "prompt": "concat('<stats character=\"S', cast(l_suppkey AS VARCHAR(20)), '\" ', l_returnflag, l_linestatus, '=\"', CASE WHEN l_linenumber % 4 = 0 THEN '!!no_change!!' ELSE concat('v', cast(l_partkey AS VARCHAR(20))) END, '\" />')",
    "unscored": "l_suppkey % 40 = 11",
}
ENTRIES_SQL = "raw AS (SELECT " + ", ".join(f"{v} AS {k}" for k, v in _FIELDS.items()) + """ FROM lineitem),
e AS (
  SELECT _ord, id, source_id, subject, raw_attr, prompt, unscored,
    coalesce(nullif(raw_attr, ''), 'unknown') AS attr,
    CASE WHEN unscored THEN 0.0 ELSE coalesce(d, 0.0) END AS d,
    CASE WHEN unscored THEN 0.0 ELSE w END AS w,
    coalesce(NOT unscored AND pred <> tok, false) AS flip,
    l_same AS same, split_part(nullif(id, ''), ':', 1) AS file
  FROM (SELECT *, ends_with(prompt, '!!no_change!!" />') AS l_same FROM raw)),
b AS (SELECT *, CASE WHEN d > 1 THEN 'high' WHEN d > 0.25 THEN 'medium' WHEN d > 0 THEN 'low' ELSE 'other' END AS bucket, length(prompt) AS len FROM e)"""


def entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries of line items: many files, real duplicate ids, missing metrics."""
    rows = table(spark, sf_dir, "lineitem").select(*[F.expr(v).alias(k) for k, v in _FIELDS.items()])
    token = F.struct(
        F.lit(0).alias("position"), F.lit(0).alias("token_id"), F.col("tok").alias("decoded_value"), F.col("w").alias("loss"), F.lit(0).alias("pred_token_id"), F.col("pred").alias("pred_decoded_value")
    )
    metrics = F.struct(F.col("d").alias("completion_difficulty"), F.col("d").alias("mean_loss"), F.col("w").alias("worst_loss"), token.alias("critical_token"))
    return rows.select(
        "prompt", "id", "source_id",
        F.struct(F.lit("CharacterStats").alias("entity"), F.col("subject").alias("subject_id"), F.col("raw_attr").alias("attr")).cast(S.TARGET).alias("target"),
        F.when(~F.col("unscored"), metrics).cast(S.LOSS_METRICS).alias("loss_metrics"),
        F.substring_index("prompt", '="', -1).alias("expected_value"), F.col("subject").alias("original_subject_id"),
        F.lit(None).cast("string").alias("completion"), F.lit(None).cast("string").alias("response"), "_ord",
    )


def event_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries of events, several per id, with metrics that vary."""
    rows = table(spark, sf_dir, "events")
    name = F.concat(F.col("user_id").cast("string"), F.lit(":"), F.col("event_type"))
    metrics = F.struct(F.col("value").alias("completion_difficulty"), F.lit(None).cast("double").alias("mean_loss"), F.col("value").alias("worst_loss"), F.lit(None).cast(S.CRITICAL_TOKEN).alias("critical_token"))
    return rows.select(
        F.col("props").alias("prompt"), name.alias("id"), name.alias("source_id"),
        F.struct(F.lit(None).cast("string").alias("entity"), F.lit(None).cast("string").alias("subject_id"), F.col("event_type").alias("attr")).alias("target"),
        metrics.cast(S.LOSS_METRICS).alias("loss_metrics"), F.lit(None).cast("string").alias("expected_value"), F.lit(None).cast("string").alias("original_subject_id"),
        F.lit(None).cast("string").alias("completion"), F.lit(None).cast("string").alias("response"), F.col("event_id").alias("_ord"),
    )


#: Messages' texts as they are, but for the marks of tags.
_CLEAN = "replace(replace(coalesce(text, ''), '<', ''), '>', '')"
_TURNS = """SELECT conv_id, role, {clean} AS body, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS t FROM conversations"""
_LINES = "length({0}) - length(replace({0}, chr(10), ''))"
_BLOCKS = f"""SELECT conv_id, t, role, 7 + {_LINES.format("lag(body) OVER w")} + {_LINES.format("body")} AS n_lines, concat('c', cast(conv_id AS VARCHAR(20)), '.txt') AS file,
  concat('<previousMessage from="', lag(role) OVER w, '">', lag(body) OVER w, '</previousMessage>') AS prev,
  concat('<augment duplicate="', cast(t % 3 AS VARCHAR(20)), '" />') AS aug,
  concat('<stats character="', role, '" pose="p', cast((t - 1) % 2 AS VARCHAR(20)), '" location="l', cast(conv_id % 5 AS VARCHAR(20)), '" outfit="o" />') AS before,
  '<stats character="Eve" pose="p0" />' AS eve,
  concat('<message from="', role, '">', body, '</message>') AS msg,
  concat('pose="p', cast(t % 2 AS VARCHAR(20)), '"') AS pose, concat('location="l', cast(conv_id % 5 AS VARCHAR(20)), '"') AS loc,
  concat('fixtures="f', cast(t AS VARCHAR(20)), '"') AS fix, concat('items="i', cast(conv_id % 3 AS VARCHAR(20)), '"') AS items
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY t)"""
_SPANS = """SELECT *, concat('<stats character="', role, '" ', pose, ' ', loc, ' outfit="o" />') AS cha, concat('<stats scene="hall" ', fix, ' ', items, ' />') AS sce,
  concat(file, ':', cast(cast(coalesce(sum(n_lines) OVER (PARTITION BY conv_id ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) + 1 AS VARCHAR(20))) AS source_id FROM blocks WHERE t > 1"""


_WITH = f"turns AS ({_TURNS.format(clean=_CLEAN)}), blocks AS ({_BLOCKS}), spans AS ({_SPANS})"
#: One row per block of annotated dialogue, its parts as columns.
BLOCKS_SQL = _WITH


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(f"WITH {_WITH.replace('FROM conversations', 'FROM {conversations}')} SELECT * FROM spans", conversations=table(spark, sf_dir, "conversations"))


def annotated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(file, value): a whole annotated text per conversation, a block per answer."""
    block = F.concat_ws("\n", "prev", "aug", "before", "eve", "msg", "cha", "sce")
    rows = blocks(spark, sf_dir).select("file", "t", block.alias("block"))
    whole = rows.groupBy("file").agg(F.array_sort(F.collect_list(F.struct("t", "block"))).alias("all"))
    return whole.select("file", F.array_join(F.transform("all", lambda x: x["block"]), "\n").alias("value"))
