"""Queries over annotated dialogue: parsing, passes, exports; and over batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threshline import schema as S
from threshline.functions import entities as N
from threshline.functions import entries as E
from threshline.operators import batching, cache, export, parse, passes, reports, sampling, scoring, shuffles
from threshline.plans.derive import BLOCKS_SQL, ENTRIES_SQL, annotated, blocks, entries
from threshline.plans.entry_queries import rounded
from threshline.sources import readers
from threshline.storage import cut_lineage

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


def _datapoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.parse(annotated(spark, sf_dir))


def _shown(points: DataFrame) -> DataFrame:
    return parse.to_entries(points).select("source_id", "prompt", "id", "expected_value", F.col("target.attr").alias("attr"), "original_subject_id")


_HEAD = r"concat_ws(E'\n', prev, aug, before, eve, msg"
_B = f"WITH {BLOCKS_SQL}"


@query(
    "parse_datapoints",
    f"""{_B} SELECT source_id, {_HEAD}, cha) AS prompt, concat(source_id, ':', role) AS id, 'o" />' AS expected_value, NULL::VARCHAR AS attr, role AS original_subject_id FROM spans
    UNION ALL SELECT source_id, {_HEAD}, cha, sce) AS prompt, concat(source_id, ':hall') AS id, concat('i', conv_id % 3, '" />') AS expected_value, NULL AS attr, 'hall' AS original_subject_id FROM spans""",
)
def parse_datapoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every datapoint of every annotated text, as an entry."""
    return _shown(_datapoints(spark, sf_dir))


@query("parse_warnings", f"{_B} SELECT file, 'a message is not closed' AS warning FROM spans")
def parse_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the parser skips in texts whose messages are cut off."""
    broken = annotated(spark, sf_dir).withColumn("value", F.regexp_replace("value", "</message>", ""))
    return parse.warnings_of(broken)


@query("parse_raw", f"{_B} SELECT source_id, prev AS previous, concat_ws('|', aug, before, eve) AS before, cha AS state, 'CharacterStats' AS type FROM spans UNION ALL SELECT source_id, prev, concat_ws('|', aug, before, eve), sce, 'SceneStats' FROM spans")
def parse_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit form: each entity as written."""
    raw = parse.to_raw(_datapoints(spark, sf_dir))
    state = F.get("state", F.lit(0))
    return raw.select("source_id", F.col("previous_message.rehydrated").alias("previous"), F.array_join(F.transform("previous_state", lambda e: e["rehydrated"]), "|").alias("before"), state["rehydrated"].alias("state"), state["type"].alias("type"))


@query("entity_columns", f"{_B} SELECT source_id, concat_ws('|', cha, sce) AS texts, role AS subject, 'p' || t % 2 AS pose, 2 AS stats, 1 AS scenes FROM spans")
def entity_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities by column functions alone: extracted, looked up, written again."""
    rows = blocks(spark, sf_dir).withColumn("found", N.keep_first(N.entities_in(F.concat_ws("\n", "cha", "sce", "cha"))))
    target = F.struct(F.lit("CharacterStats").alias("entity"), F.col("role").alias("subject_id"), F.lit("pose").alias("attr"))
    return rows.select(
        "source_id", F.array_join(N.texts_of(F.col("found")), "|").alias("texts"), N.first(F.col("found"))["subject"]["id"].alias("subject"), N.target_value(F.col("found"), target).alias("pose"),
        F.size(N.of_type(F.col("found"), "Stats")).alias("stats"), N.count_of(F.col("found"), lambda e: e["cls"] == "SceneStats").alias("scenes"),
    )


@query("entity_updates", f"{_B} SELECT source_id, concat('<stats character=\"', role, '\" pose=\"new\" ', loc, ' outfit=\"o\" />') AS changed, role AS matched, 5 AS everyone FROM spans")
def entity_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A target's value set, a match of one entity among others, all entities together."""
    rows = blocks(spark, sf_dir).select("source_id", "role", N.entities_in(F.concat_ws("\n", "cha", "sce")).alias("s"), N.entities_in(F.concat_ws("\n", "before", "eve")).alias("p"))
    target = F.struct(F.lit("Stats").alias("entity"), F.col("role").alias("subject_id"), F.lit("pose").alias("attr"))
    changed = N.set_target_value(F.col("s"), target, F.lit("new"))
    match = N.find_matching(F.col("p"), F.get("s", F.lit(0)))
    every = N.all_entities(F.get("s", F.lit(0)), F.get("s", F.lit(1)), F.col("p"), F.slice("s", 1, 1))
    return rows.select("source_id", N.first(N.texts_of(changed)).alias("changed"), match["subject"]["id"].alias("matched"), F.size(every).alias("everyone"))


_UNWOUND = f"""u AS (
  SELECT source_id, t, conv_id, role AS subject, 'pose' AS attr, concat('<stats character="', role, '" ', pose, ' />') AS state, '' AS ctx, 'p' || t % 2 AS val, 'p' || (t - 1) % 2 AS old, prev, aug, before, eve, msg FROM spans
  UNION ALL SELECT source_id, t, conv_id, role, 'location', concat('<stats character="', role, '" ', pose, ' ', loc, ' />'), '', 'l' || conv_id % 5, 'l' || conv_id % 5, prev, aug, before, eve, msg FROM spans
  UNION ALL SELECT source_id, t, conv_id, role, 'outfit', concat('<stats character="', role, '" outfit="o" />'), '', 'o', 'o', prev, aug, before, eve, msg FROM spans
  UNION ALL SELECT source_id, t, conv_id, 'hall', 'fixtures', concat('<stats scene="hall" ', fix, ' />'), cha, 'f' || t, NULL, prev, aug, before, eve, msg FROM spans
  UNION ALL SELECT source_id, t, conv_id, 'hall', 'items', concat('<stats scene="hall" ', fix, ' ', items, ' />'), cha, 'i' || conv_id % 3, NULL, prev, aug, before, eve, msg FROM spans)"""
_PROMPT = r"concat_ws(E'\n', prev, aug, before, eve, msg, nullif(ctx, ''), state)"


@query("pass_unwind", f"{_B}, {_UNWOUND} SELECT source_id, {_PROMPT} AS prompt, concat(source_id, ':', subject, ':', attr) AS id, val AS expected_value, attr, subject AS original_subject_id FROM u")
def pass_unwind(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(passes.unwind_stats(_datapoints(spark, sf_dir)))


@query(
    "pass_chat_eval",
    f"""{_B}, {_UNWOUND}, n AS (SELECT * REPLACE (CASE WHEN val = old THEN replace(state, concat(attr, '="', val, '"'), concat(attr, '="!!no_change!!"')) ELSE state END AS state) FROM u)
    SELECT source_id, {_PROMPT} AS prompt, concat(source_id, ':', subject, ':', attr) AS id, val AS expected_value, attr, subject AS original_subject_id FROM n""",
)
def pass_chat_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The evaluation chain: unwound, then unchanged values marked."""
    return _shown(passes.run_passes(_datapoints(spark, sf_dir), passes.CHAT_EVAL))


@query("pass_duplicate", f"{_B}, {_UNWOUND} SELECT source_id, attr, count(*) AS n FROM (SELECT source_id, attr, unnest(range(t % 3)) AS i FROM u) GROUP BY ALL")
def pass_duplicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = passes.duplicate(passes.unwind_stats(_datapoints(spark, sf_dir)))
    return out.groupBy("source_id", F.col("target.attr").alias("attr")).agg(F.count("*").alias("n"))


@query("pass_duplicate_changes", f"{_B}, {_UNWOUND} SELECT source_id, attr, CASE WHEN attr = 'pose' AND val <> old THEN 3 ELSE 1 END::BIGINT AS n FROM u")
def pass_duplicate_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = passes.duplicate_changes("pose", 3)(passes.unwind_stats(_datapoints(spark, sf_dir)))
    return out.groupBy("source_id", F.col("target.attr").alias("attr")).agg(F.count("*").alias("n"))


@query(
    "pass_mirror",
    rf"""{_B}, d AS (SELECT *, cha AS s, '' AS ctx FROM spans UNION ALL SELECT *, sce AS s, cha AS ctx FROM spans)
    SELECT source_id, concat_ws(E'\n', prev, aug, before, eve, msg, nullif(ctx, ''), s) AS prompt FROM d UNION ALL SELECT source_id, concat_ws(E'\n', prev, aug, eve, before, msg, nullif(ctx, ''), s) AS prompt FROM d""",
)
def pass_mirror(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(passes.mirror()(_datapoints(spark, sf_dir))).select("source_id", "prompt")


_FULL = ' outfit="o" exposure="e" accessories="a" bodystate="b"'


@query(
    "pass_meta",
    rf"""{_B}, w AS (SELECT *, CASE WHEN conv_id % 2 = 0 THEN replace(b, 'pose="p1"', 'pose="p0"') ELSE b END AS b1, CASE WHEN conv_id % 2 = 0 THEN replace(c, 'pose="p1"', 'pose="p0"') ELSE c END AS c1
      FROM (SELECT *, replace(before, ' outfit="o"', '{_FULL}') AS b, replace(cha, ' outfit="o"', '{_FULL}') AS c FROM spans)),
    m AS (SELECT *, CASE WHEN conv_id % 2 = 0 THEN 'false' ELSE 'true' END AS changed FROM w)
    SELECT source_id, concat_ws(E'\n', prev, aug, b1, eve, msg, c1) AS prompt, concat(source_id, ':', role) AS id, 'b" />' AS expected_value, NULL::VARCHAR AS attr, role AS original_subject_id FROM m
    UNION ALL SELECT source_id, concat_ws(E'\n', prev, aug, b1, eve, msg, c1, sce), concat(source_id, ':hall'), concat('i', conv_id % 3, '" />'), NULL, 'hall' FROM m
    UNION ALL SELECT source_id, concat_ws(E'\n', prev, aug, b1, eve, msg, concat('<meta character="', role, '" updated="', changed, '" />')), concat(source_id, ':', role, ':updated'), changed, 'updated', role FROM m""",
)
def pass_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts whose characters have all stats, every second of them unchanged."""
    even = F.regexp_extract("file", r"c(\d+)\.", 1).cast("long") % 2 == 0
    whole = F.replace("value", F.lit(' outfit="o"'), F.lit(_FULL))
    texts = annotated(spark, sf_dir).withColumn("value", F.when(even, F.replace(whole, F.lit('pose="p1"'), F.lit('pose="p0"'))).otherwise(whole))
    return _shown(passes.meta_updated(parse.parse(texts)))


@query("pass_rename")
def pass_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(passes.rename()(_datapoints(spark, sf_dir)))


@query("pass_chat_train")
def pass_chat_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(passes.run_passes(_datapoints(spark, sf_dir), passes.CHAT_TRAIN))


_MARKED = f"""{_B}, {_UNWOUND}, n AS (SELECT * REPLACE (CASE WHEN val = old THEN replace(state, concat(attr, '="', val, '"'), concat(attr, '="!!no_change!!"')) ELSE state END AS state), unnest(range(t % 3)) AS copy FROM u)
    SELECT source_id, {_PROMPT} AS prompt, concat(source_id, ':', subject, ':', attr) AS id, val AS expected_value, attr, subject AS original_subject_id FROM n
    UNION ALL SELECT source_id, {_PROMPT.replace("before, eve", "eve, before")}, concat(source_id, ':', subject, ':', attr), val, attr, subject FROM n"""


@query("pass_chat_train_same_names", _MARKED)
def pass_chat_train_same_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The training chain but for the renaming."""
    chain = [passes.unwind_stats, passes.duplicate, passes.mirror(), passes.no_change]
    return _shown(passes.run_passes(_datapoints(spark, sf_dir), chain))


@query("pass_synthetic", _MARKED)
def pass_synthetic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(passes.run_passes(_datapoints(spark, sf_dir), passes.SYNTHETIC))


@query(
    "export_last_stats",
    f"""{_B}, r AS (SELECT source_id, 'Characters' AS section, role AS subject, unnest(['pose', 'location', 'outfit']) AS attr, unnest(['p' || t % 2, 'l' || conv_id % 5, 'o']) AS value FROM spans
    UNION ALL SELECT source_id, 'Characters', 'Eve', 'pose', 'p0' FROM spans
    UNION ALL SELECT source_id, 'Scenes', 'hall', unnest(['fixtures', 'items']), unnest(['f' || t, 'i' || conv_id % 3]) FROM spans) SELECT * FROM r""",
)
def export_last_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export.last_stats(_datapoints(spark, sf_dir))


@query("export_chats", f"{_B} SELECT source_id, role AS name, false AS is_user, false AS is_system, '' AS send_date, body_of AS mes, concat_ws(',', least('Eve', role) || '.png', greatest('Eve', role) || '.png') AS present FROM (SELECT *, regexp_extract(msg, '(?s)>(.*)</message>', 1) AS body_of FROM spans)")
def export_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A chat message per block."""
    return export.chats(_datapoints(spark, sf_dir)).select("source_id", "name", "is_user", "is_system", "send_date", "mes", F.array_join("present", ",").alias("present"))


@query("export_embeddings", rf"""{_B} SELECT source_id, concat('**/<stats character="', role, '" pose="/**p', t % 2, '**/" location="/**l', conv_id % 5, '**/" outfit="/**o**/" />/**') AS prompt FROM spans""")
def export_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = readers.stat_lines(blocks(spark, sf_dir).select("source_id", F.concat(F.lit("  "), F.col("cha"), F.lit("\t")).alias("value")))
    return rows.select("source_id", N.wrap_values(F.col("value")).alias("prompt"))


@query("stat_lines_skipped", f"{_B} SELECT 2 * count(*) AS skipped FROM spans")
def stat_lines_skipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = blocks(spark, sf_dir).select(F.explode(F.array("cha", "msg", F.lit("  "), "prev")).alias("value"))
    return readers.skipped_lines(lines)


_E = f"WITH {ENTRIES_SQL}, u AS (SELECT DISTINCT * FROM b), k AS (SELECT *, sha1(concat_ws('#', _ord, '1337')) AS key FROM u)"
_DEAL = f"""{_E}, total AS (SELECT count(*) // 24 AS whole FROM u),
placed AS (SELECT *, row_number() OVER (ORDER BY bucket, attr, key) - 1 AS place FROM k),
bt AS (SELECT *, CAST(CASE WHEN place < whole * 24 THEN place % whole ELSE whole END AS INTEGER) AS batch_id, CAST(CASE WHEN place < whole * 24 THEN place // whole ELSE place - whole * 24 END AS INTEGER) AS pos FROM placed, total)"""


def _dealt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batching.deal(entries(spark, sf_dir).distinct(), 24)


@query("batch_deal", f"{_DEAL} SELECT _ord, batch_id, pos FROM bt")
def batch_deal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dealt(spark, sf_dir).select("_ord", "batch_id", "pos")


@query(
    "report_batches",
    f"""{_DEAL}, p AS (SELECT batch_id, avg(d) AS m, median(d) AS md, count(DISTINCT attr)::DOUBLE AS a FROM bt GROUP BY batch_id)
    SELECT count(*) AS batches, {", ".join(f"round(avg({c}), 6) AS {n}_mean, round(coalesce(stddev_samp({c}), 0.0), 6) AS {n}_std, round(min({c}), 6) AS {n}_min, round(max({c}), 6) AS {n}_max" for c, n in (("m", "mean"), ("md", "median"), ("a", "attrs")))} FROM p""",
)
def report_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(reports.batch_stats(_dealt(spark, sf_dir)))


def _filtered(c: str) -> str:
    return f"count(*) FILTER (WHERE {c})"


@query(
    "report_coverage",
    f"""{_DEAL}, p AS (SELECT batch_id, {_filtered("flip")} AS f, {_filtered("same")} AS s, {_filtered("bucket = 'high'")} AS h FROM bt GROUP BY batch_id)
    SELECT count(*) AS batches, {_filtered("f = 0")} AS without_flip, {_filtered("s = 0")} AS without_no_change, {_filtered("h = 0")} AS without_high FROM p""",
)
def report_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.coverage(_dealt(spark, sf_dir))


@query(
    "report_attr_batches",
    f"""{_DEAL}, c AS (SELECT batch_id, attr, count(*) AS n FROM bt GROUP BY ALL), g AS (SELECT bb.batch_id, aa.attr, coalesce(n, 0) AS n FROM (SELECT DISTINCT batch_id FROM bt) bb CROSS JOIN (SELECT DISTINCT attr FROM bt) aa LEFT JOIN c USING (batch_id, attr))
    SELECT attr, min(n) AS least, max(n) AS most, {_filtered("n = 0")} AS missing FROM g GROUP BY attr""",
)
def report_attr_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.attr_batch_stats(_dealt(spark, sf_dir))


@query(
    "report_batch_lengths",
    f"""{_DEAL}, p AS (SELECT batch_id, sum(len)::DOUBLE AS l, {_filtered("same")} AS s FROM bt GROUP BY batch_id)
    SELECT CAST(sum(l) AS BIGINT) AS length_sum, round(avg(l), 6) AS length_mean, round(coalesce(stddev_samp(l), 0.0), 6) AS length_std, min(l) AS length_min, max(l) AS length_max, min(s) AS same_min, max(s) AS same_max, {_filtered("s = 0")} AS same_missing FROM p""",
)
def report_batch_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(reports.batch_lengths(_dealt(spark, sf_dir)))


@query(
    "report_epoch_uniqueness",
    f"""{_E}, x AS (SELECT epoch, id, (row_number() OVER (PARTITION BY epoch ORDER BY sha1(concat_ws('#', _ord, CAST(epoch AS VARCHAR)))) - 1) // 10 AS batch_id FROM u, (SELECT unnest(range(3)) AS epoch) WHERE id IS NOT NULL),
    l AS (SELECT epoch, id, max(batch_id) AS batch_id FROM x GROUP BY ALL),
    s AS (SELECT a.epoch AS i, b.epoch AS j, 100.0 * count_if(a.batch_id = b.batch_id)::DOUBLE / count(*) AS p FROM l a JOIN l b ON a.id = b.id AND a.epoch < b.epoch GROUP BY ALL),
    dx AS (SELECT DISTINCT epoch, batch_id, id FROM x), pr AS (SELECT DISTINCT a.epoch, a.id AS p, b.id AS q FROM dx a JOIN dx b ON a.epoch = b.epoch AND a.batch_id = b.batch_id AND a.id < b.id),
    np AS (SELECT epoch, count(*) AS n FROM pr GROUP BY epoch), m AS (SELECT a.epoch AS i, b.epoch AS j, count(*) AS met FROM pr a JOIN pr b ON a.p = b.p AND a.q = b.q AND a.epoch < b.epoch GROUP BY ALL)
    SELECT round(avg(s.p), 6) AS same_batch_pct, round(avg(100.0 * coalesce(met, 0)::DOUBLE / np.n), 6) AS shared_pairs_pct FROM s LEFT JOIN m USING (i, j) LEFT JOIN np ON np.epoch = s.i""",
)
def report_epoch_uniqueness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three shuffles cut into batches of ten, and how alike they are."""
    return rounded(shuffles.shuffle_uniqueness(entries(spark, sf_dir), 3, 10))


def _grouped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All entries, as so many epochs side by side that each can be engineered."""
    rows = entries(spark, sf_dir).distinct()
    n = max(16, -(-2 * rows.count() // batching.ENGINEERED_ROWS))
    return rows.withColumn("epoch", F.pmod(F.xxhash64("_ord"), F.lit(n)).cast("int"))


@query("batch_balanced")
def batch_balanced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches engineered by bucket and attribute."""
    synthetic = F.substring("_ord", 14, 4).cast("int") == 7
    return batching.engineer(_grouped(spark, sf_dir), 24, batching.plan_balanced, synthetic=synthetic).select("_ord", "epoch", "batch_id", "pos")


@query("batch_by_attr")
def batch_by_attr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batching.engineer(_grouped(spark, sf_dir), 24, batching.plan_by_attr).select("_ord", "epoch", "batch_id", "pos")


@query(
    "batch_tokens",
    f"""WITH RECURSIVE {ENTRIES_SQL}, x AS (SELECT _ord, len, row_number() OVER (PARTITION BY len ORDER BY _ord) - 1 AS i FROM b),
    h AS (SELECT len, count(*) AS n, row_number() OVER (ORDER BY len) AS k FROM b GROUP BY len),
    g AS (
      SELECT k, len, cap, 0::BIGINT AS room, -1::BIGINT AS open_, ceil(n / cap)::BIGINT - 1 AS last_, n - (ceil(n / cap)::BIGINT - 1) * cap AS held FROM (SELECT *, greatest(1, 10000 // len) AS cap FROM h WHERE k = 1)
      UNION ALL
      SELECT k, len, cap, room, open_, open_ + ceil((n - room) / cap)::BIGINT, CASE WHEN n = room THEN held + room ELSE n - room - (ceil((n - room) / cap)::BIGINT - 1) * cap END
      FROM (SELECT h.k, h.len, h.n, g.last_ AS open_, g.held, greatest(1, 10000 // h.len) AS cap, least(h.n, greatest(0, 10000 // h.len - g.held)) AS room FROM g JOIN h ON h.k = g.k + 1))
    SELECT _ord, CASE WHEN open_ < 0 THEN i // cap WHEN i < room THEN open_ ELSE open_ + 1 + (i - room) // cap END AS batch_id FROM x JOIN g USING (len)""",
)
def batch_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batching.token_batches(entries(spark, sf_dir).select("_ord", "prompt"), 10_000, F.length("prompt")).select("_ord", "batch_id")


@query("score_prompts")
def score_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Difficulty of every unwound datapoint by the default scorer."""
    points = parse.to_entries(passes.run_passes(_datapoints(spark, sf_dir), passes.CHAT_EVAL))
    out = scoring.score(points)
    return out.select("source_id", "id", F.col("loss_metrics.completion_difficulty").alias("difficulty"), F.col("loss_metrics.critical_token.decoded_value").alias("token"))


@query("cache_summary", f"{_B}, d AS (SELECT source_id, conv_id FROM spans UNION ALL SELECT source_id, conv_id FROM spans) SELECT {_filtered('conv_id % 2 = 0')} AS reused, {_filtered('conv_id % 2 <> 0')} AS regenerated FROM d")
def cache_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Datapoints found in a cache that holds every second conversation, and the others."""
    keyed = _datapoints(spark, sf_dir).select("source_id", F.concat_ws("#", "source_id", passes.content_key(), "_part").alias("dp_key"))
    keyed = cut_lineage(keyed, "keys")
    even = F.regexp_extract("source_id", r"c(\d+)\.", 1).cast("long") % 2 == 0
    hits, missing = cache.split(keyed, keyed.filter(even).select("dp_key"), ["dp_key"])
    return cache.summary(hits, missing)


@query("cache_move", f"{_B} SELECT concat('new.txt:1', ':', role) AS id, 'new.txt:1' AS source_id FROM spans UNION ALL SELECT 'new.txt:1:hall', 'new.txt:1' FROM spans")
def cache_move(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cache.move_source(parse.to_entries(_datapoints(spark, sf_dir)), "new.txt:1").select("id", "source_id")


_CHANCE = "('0x' || left(sha1(concat_ws('#', id, '42', '{}')), 12))::BIGINT::DOUBLE / 281474976710656"


@query(
    "stub_prompts",
    f"""WITH p AS (SELECT range AS id FROM range(1024)), s AS (SELECT id, floor(exp(ln(8.0::DOUBLE) + {_CHANCE.format(1)} * (ln(1025.0::DOUBLE) - ln(8.0::DOUBLE))))::INTEGER AS words, {_CHANCE.format(2)} AS c FROM p)
    SELECT id, concat(CASE WHEN c < 0.5 THEN concat('key="v', id, '" ') ELSE '' END, array_to_string(list_transform(range(1, greatest(1, words) + 1), lambda i: concat('w', (id * 31 + i * 7) % 997)), ' ')) AS prompt FROM s""",
)
def stub_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.stub_prompts(spark, 1024)


_ATTRS = "c AS (SELECT conv_id, t, role, body, CASE t % 4 WHEN 0 THEN ' yes ' WHEN 1 THEN 'off' WHEN 2 THEN 'T' ELSE 'maybe' END AS flag FROM turns)"


@query(
    "message_fields",
    f"""{_B}, {_ATTRS} SELECT conv_id, t, CASE WHEN t % 2 = 0 THEN 'Ann' ELSE role END AS name, CASE WHEN t % 3 = 0 THEN concat('d', t) ELSE '' END AS send_date,
    role = 'user' OR t % 4 = 0 AS is_user, role = 'system' AS is_system, t % 4 = 0 AS truthy, CASE WHEN t % 4 IN (0, 2) THEN true WHEN t % 4 = 1 THEN false END AS parsed,
    CASE WHEN t % 5 = 0 THEN NULL WHEN t % 5 = 1 THEN NULL ELSE concat('a"', t) END AS value FROM c""",
)
def message_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Speaker, date, roles, flags and clean values of message attributes."""
    turns = spark.sql("SELECT conv_id, role, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS t FROM {c}", c=spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    t = F.col("t")
    flag = F.when(t % 4 == 0, " yes ").when(t % 4 == 1, "off").when(t % 4 == 2, "T").otherwise("maybe")
    attrs = F.create_map(F.lit("from"), F.when(t % 2 == 0, " Ann ").otherwise(" "), F.lit("date"), F.when(t % 3 == 0, F.concat(F.lit("d"), t)).otherwise("\t"), F.lit("role"), F.col("role"), F.lit("user"), flag)
    raw = F.when(t % 5 == 0, "  ").when(t % 5 == 1, S.NO_CHANGE).otherwise(F.concat(F.lit(' a\\"'), t, F.lit("\n")))
    role = E.roles(attrs)

    def named(c: Column, name: str) -> Column:
        return c.alias(name)

    return turns.select(
        "conv_id", "t", named(E.speaker(attrs, F.col("role")), "name"), named(E.send_date(attrs), "send_date"), named(role["is_user"], "is_user"), named(role["is_system"], "is_system"),
        named(E.truthy(flag), "truthy"), named(E.parse_bool(flag), "parsed"), named(E.clean_value(raw), "value"),
    )


@query("sample_copies", f"{_E} SELECT _ord, CAST(g AS INTEGER) AS _copy FROM u, (SELECT unnest(range(1, 3)) AS g)")
def sample_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.replicate(entries(spark, sf_dir).select("_ord").distinct(), F.lit(2)).select("_ord", "_copy")
