"""Queries over derived entries: fields, filters, deduplication, orders, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threshline.functions import entries as E
from threshline.operators import dedupe, filters, reports, sampling
from threshline.operators.ranking import global_rank
from threshline.plans.derive import ENTRIES_SQL, entries, event_entries

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, derive=entries):
    """Register a function of (entries) as a query, with the SQL that checks it."""

    def add(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(derive(spark, sf_dir))

        run.__doc__ = f.__doc__
        QUERIES[name] = run
        if sql:
            ORACLES[name] = f"WITH {ENTRIES_SQL} {sql}" if derive is entries else sql
        return f

    return add


def r6(c: Column | str) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def rounded(df: DataFrame) -> DataFrame:
    """Doubles at six decimals, as sums of them may differ by order."""
    return df.select(*[r6(c).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


@query("entry_fields", "SELECT _ord, attr, d AS difficulty, w AS worst_loss, flip, same AS no_change, bucket, attr <> 'updated' AS needed, file FROM b")
def entry_fields(e: DataFrame) -> DataFrame:
    """Every scalar field of every entry."""
    return e.select("_ord", E.attr().alias("attr"), E.difficulty().alias("difficulty"), E.worst_loss().alias("worst_loss"), E.is_flip().alias("flip"), E.is_no_change().alias("no_change"), E.bucket().alias("bucket"), E.needed().alias("needed"), E.file_of(F.col("id")).alias("file"))


@query(
    "entry_texts",
    """SELECT _ord, split_part(prompt, '="', 3) AS completion, left(prompt, length(prompt) - length(split_part(prompt, '="', 3))) AS prefix,
       length(split_part(prompt, '="', 3)) AS completion_length, sha1(concat_ws('#', _ord, '7')) AS order_key,
       CAST(('0x' || left(sha1(_ord), 8)) AS BIGINT) AS seed FROM b""",
)
def entry_texts(e: DataFrame) -> DataFrame:
    """Completions, prefixes, lengths, shuffle keys and seeds."""
    return e.select(
        "_ord", E.completion(F.col("prompt")).alias("completion"), E.prefix(F.col("prompt"), F.coalesce("target.attr", F.lit(""))).alias("prefix"),
        E.text_length(F.col("expected_value")).cast("long").alias("completion_length"), E.order_key(F.col("_ord"), 7).alias("order_key"), E.seed_of(F.sha1("_ord")).alias("seed"),
    )


@query("filter_needed", "SELECT _ord, attr FROM b WHERE attr <> 'updated'")
def filter_needed(e: DataFrame) -> DataFrame:
    return filters.keep_needed(e).select("_ord", E.attr().alias("attr"))


@query(
    "filter_top_percentile",
    """, r AS (SELECT _ord, row_number() OVER (ORDER BY d DESC, _ord) AS k FROM b WHERE d >= 0.25),
    c AS (SELECT CAST(ceil(count(*) * 5 / 100.0) AS BIGINT) AS n FROM r)
    SELECT _ord FROM b WHERE _ord NOT IN (SELECT _ord FROM r, c WHERE k <= n)""",
)
def filter_top_percentile(e: DataFrame) -> DataFrame:
    return filters.drop_hardest(e, 5, 0.25).select("_ord")


@query("filter_buckets", "SELECT _ord, CASE WHEN d = 0 THEN 'zero' WHEN d > 0 THEN bucket END AS loss_bucket FROM b")
def filter_buckets(e: DataFrame) -> DataFrame:
    return filters.loss_buckets(e).select("_ord", "loss_bucket")


_EVAL_SQL = "WHERE CAST(left(_ord, 12) AS BIGINT) % 7 = 0"


def _eval(e: DataFrame) -> DataFrame:
    return e.filter(F.substring("_ord", 1, 12).cast("long") % 7 == 0)


@query("filter_decontaminate", f"SELECT _ord FROM b WHERE id IS NULL OR id NOT IN (SELECT id FROM b {_EVAL_SQL} AND id IS NOT NULL)")
def filter_decontaminate(e: DataFrame) -> DataFrame:
    """Training entries whose id no evaluation entry has."""
    return filters.without_ids(e, filters.ids_of(_eval(e))).select("_ord")


@query("filter_eval_ids", f"SELECT DISTINCT id FROM b {_EVAL_SQL}")
def filter_eval_ids(e: DataFrame) -> DataFrame:
    return filters.ids_of(_eval(e))


@query("filter_flips", "SELECT _ord FROM b WHERE flip")
def filter_flips(e: DataFrame) -> DataFrame:
    return filters.flips(e).select("_ord")


@query("filter_allowed_stats", "SELECT _ord FROM b WHERE lower(raw_attr) IN ('ao', 'rf')")
def filter_allowed_stats(e: DataFrame) -> DataFrame:
    return filters.allowed_stats(e, filters.parse_stats(" AO; rf,")).select("_ord")


@query("filter_scored", "SELECT _ord FROM b WHERE NOT unscored")
def filter_scored(e: DataFrame) -> DataFrame:
    return filters.scored(e).select("_ord")


@query("filter_threshold", "SELECT _ord, d FROM b WHERE d >= 0.05")
def filter_threshold(e: DataFrame) -> DataFrame:
    return filters.at_least(e, 0.05).select("_ord", E.difficulty().alias("d"))


@query("filter_search", "SELECT _ord FROM b WHERE contains(lower(coalesce(id, '')), '12:')")
def filter_search(e: DataFrame) -> DataFrame:
    return filters.search(e, "12:").select("_ord")


@query("filter_search_all", "SELECT _ord FROM b WHERE contains(lower(prompt), 'v77')")
def filter_search_all(e: DataFrame) -> DataFrame:
    return filters.search(e, "V77", whole=True).select("_ord")


@query("filter_mislabelled", "SELECT _ord, w FROM b WHERE w > 8")
def filter_mislabelled(e: DataFrame) -> DataFrame:
    return filters.mislabelled(e).select("_ord", E.worst_loss().alias("w"))


@query("filter_finite", "SELECT event_id, value FROM events WHERE value IS NOT NULL AND isfinite(value)", event_entries)
def filter_finite(e: DataFrame) -> DataFrame:
    return filters.finite_only(e, F.col("loss_metrics.worst_loss")).select(F.col("_ord").alias("event_id"), F.col("loss_metrics.worst_loss").alias("value"))


@query("dedupe_first", "SELECT _ord FROM (SELECT _ord, id, row_number() OVER (PARTITION BY id ORDER BY _ord) AS k FROM b) WHERE id IS NULL OR k = 1")
def dedupe_first(e: DataFrame) -> DataFrame:
    return dedupe.first_per_id(e).select("_ord")


@query("dedupe_first_unseen", f"SELECT _ord FROM (SELECT _ord, id, row_number() OVER (PARTITION BY id ORDER BY _ord) AS k FROM b) WHERE id IS NULL OR (k = 1 AND id NOT IN (SELECT id FROM b {_EVAL_SQL} AND id IS NOT NULL))")
def dedupe_first_unseen(e: DataFrame) -> DataFrame:
    return dedupe.first_per_id(e, _eval(e)).select("_ord")


@query("dedupe_rows", "SELECT DISTINCT _ord FROM b")
def dedupe_rows(e: DataFrame) -> DataFrame:
    return dedupe.distinct_rows(e).select("_ord")


@query("dedupe_worst", "SELECT _ord, w FROM (SELECT _ord, id, w, row_number() OVER (PARTITION BY id ORDER BY w DESC, _ord) AS k FROM b) WHERE id IS NULL OR k = 1")
def dedupe_worst(e: DataFrame) -> DataFrame:
    return dedupe.worst_per_id(e).select("_ord", E.worst_loss().alias("w"))


@query("dedupe_pick", "SELECT id, min(_ord) AS _ord FROM b WHERE attr <> 'updated' AND id IS NOT NULL GROUP BY id ORDER BY _ord LIMIT 100")
def dedupe_pick(e: DataFrame) -> DataFrame:
    return dedupe.pick_unique(e, 100).select("id", "_ord")


@query("top_worst", "SELECT id, w, _ord FROM (SELECT coalesce(id, 'unknown') AS id, w, _ord, row_number() OVER (PARTITION BY coalesce(id, 'unknown') ORDER BY w DESC, _ord) AS k FROM b) WHERE k = 1 ORDER BY w DESC, _ord LIMIT 50")
def top_worst(e: DataFrame) -> DataFrame:
    return dedupe.worst_unique(e).select("id", E.worst_loss().alias("w"), "_ord")


_LONGEST = "(SELECT * FROM (SELECT source_id AS source, id, len AS prompt_length, _ord, row_number() OVER (PARTITION BY source_id ORDER BY len DESC, _ord) AS k FROM b) WHERE k = 1)"


@query("top_longest", f"SELECT source, id, prompt_length FROM {_LONGEST} ORDER BY prompt_length DESC, _ord LIMIT 10")
def top_longest(e: DataFrame) -> DataFrame:
    return reports.length_report(dedupe.longest_per_source(e))[0]


@query("longest_stats", f"SELECT count(*) AS sources, round(avg(prompt_length), 6) AS mean, quantile_cont(prompt_length, 0.5) AS p50, quantile_cont(prompt_length, 0.9) AS p90, quantile_cont(prompt_length, 0.95) AS p95 FROM {_LONGEST}")
def longest_stats(e: DataFrame) -> DataFrame:
    return rounded(reports.length_report(dedupe.longest_per_source(e))[1])


def _order(name: str, keys, sql: str) -> None:
    @query(f"order_{name}", f"SELECT _ord, row_number() OVER (ORDER BY {sql}) AS rank FROM (SELECT DISTINCT * FROM b)")
    def ranks(e: DataFrame) -> DataFrame:
        return global_rank(e.distinct(), *keys()).select("_ord", "rank")


_order("difficulty", dedupe.order_by_difficulty, "d, len, _ord")
_order("difficulty_desc", lambda: dedupe.order_by_difficulty(True), "d DESC, len DESC, _ord")
_order("flip", dedupe.order_by_flip, "flip, d DESC, len DESC, _ord")
_order("bucket", dedupe.order_by_bucket, "CASE bucket WHEN 'high' THEN 2 WHEN 'medium' THEN 1 ELSE 0 END DESC, d DESC, len DESC, _ord")
_order("length", dedupe.order_by_length, "len, _ord")
_order("viewing", lambda: dedupe.order_for_viewing(F.col("loss_metrics.worst_loss")), "CASE WHEN unscored THEN '-inf'::DOUBLE ELSE w END DESC, _ord")
_order("source", dedupe.order_by_source, "lower(source_id), CASE WHEN unscored THEN '-inf'::DOUBLE ELSE w END DESC, coalesce(id, ''), _ord")


@query("concat_pools", "SELECT _ord, 0 AS pool FROM b WHERE bucket = 'high' UNION ALL SELECT _ord, 1 AS pool FROM b WHERE bucket = 'low'")
def concat_pools(e: DataFrame) -> DataFrame:
    return dedupe.concat(e.filter(E.bucket() == "high"), e.filter(E.bucket() == "low")).select("_ord", F.col("_pool").alias("pool"))


@query("set_operations", f"SELECT id, 'both' AS kind FROM (SELECT id FROM b WHERE flip INTERSECT SELECT id FROM b {_EVAL_SQL}) UNION ALL SELECT id, 'rest' AS kind FROM (SELECT id FROM b WHERE flip EXCEPT SELECT id FROM b {_EVAL_SQL})")
def set_operations(e: DataFrame) -> DataFrame:
    a, x = filters.ids_of(filters.flips(e)), filters.ids_of(_eval(e))
    return a.intersect(x).withColumn("kind", F.lit("both")).unionByName(a.subtract(x).withColumn("kind", F.lit("rest")))


@query("report_counts", "SELECT count(*) AS n, count(*) FILTER (WHERE flip) AS flips, count(*) FILTER (WHERE same) AS no_change FROM b")
def report_counts(e: DataFrame) -> DataFrame:
    return reports.counts(e)


@query("report_buckets", "SELECT coalesce(bucket, 'total') AS bucket, count(*) AS n, count(*) FILTER (WHERE flip) AS flips, count(*) FILTER (WHERE same) AS no_change FROM b GROUP BY ROLLUP(bucket)")
def report_buckets(e: DataFrame) -> DataFrame:
    return reports.bucket_stats(e)


@query("report_zero_loss", "SELECT coalesce(file, 'unknown') AS file, count(DISTINCT id) AS ids, count(*) AS n FROM b WHERE d = 0 GROUP BY 1")
def report_zero_loss(e: DataFrame) -> DataFrame:
    return reports.zero_loss_sources(e)


@query(
    "report_contributions",
    f""", s AS (SELECT file, count(*) AS sel, count(*) FILTER (WHERE flip) AS flips, sum(d) AS sum_d FROM b WHERE bucket IN ('high', 'medium') AND file IS NOT NULL GROUP BY file),
    t AS (SELECT file, count(*) AS tot, count(DISTINCT id) AS ids FROM b GROUP BY file),
    h AS (SELECT file, count(DISTINCT id) AS eval_ids FROM b {_EVAL_SQL} GROUP BY file),
    r AS (SELECT s.file, sel, flips, sum_d, coalesce(tot, 0) AS tot, coalesce(ids, 0) AS ids, coalesce(eval_ids, 0) AS eval_ids FROM s LEFT JOIN t USING (file) LEFT JOIN h USING (file)),
    a AS (SELECT *, ids AS wh FROM r UNION ALL SELECT 'TOTAL', sum(sel), sum(flips), sum(sum_d), sum(tot), sum(ids), sum(eval_ids), sum(tot) FROM r)
    SELECT file, CAST(sel AS BIGINT) AS sel, CAST(tot AS BIGINT) AS tot, round(100.0 * sel::DOUBLE / tot, 6) AS sel_pct, CAST(flips AS BIGINT) AS flips, round(100.0 * flips::DOUBLE / sel, 6) AS flip_pct,
      round(sum_d / sel, 6) AS avg_d, CAST(eval_ids AS BIGINT) AS eval_ids, round(100.0 * eval_ids::DOUBLE / wh, 6) AS eval_pct FROM a""",
)
def report_contributions(e: DataFrame) -> DataFrame:
    """What every file gives to the selection of hard entries."""
    return rounded(reports.file_contributions(e.filter(E.bucket().isin("high", "medium")), e, _eval(e)))


@query("report_median", "SELECT coalesce(median(d), 0.0) AS median_loss FROM b WHERE d >= 0.05")
def report_median(e: DataFrame) -> DataFrame:
    return reports.median_loss(e)


@query("report_attrs", "SELECT attr, count(*) AS n, count(*) FILTER (WHERE same) AS no_change, round(100.0 * count(*)::DOUBLE / sum(count(*)) OVER (), 6) AS pct, CAST(row_number() OVER (ORDER BY count(*) DESC, attr) AS INTEGER) AS place FROM b GROUP BY attr")
def report_attrs(e: DataFrame) -> DataFrame:
    return rounded(reports.attr_counts(e))


@query(
    "report_eval_attrs",
    """SELECT attr, count(*) AS n, round(100.0 * count(*) FILTER (WHERE NOT flip)::DOUBLE / count(*), 6) AS correct_pct, round(100.0 * count(*) FILTER (WHERE same)::DOUBLE / count(*), 6) AS no_change_pct,
    CASE WHEN count(*) FILTER (WHERE same) > 0 THEN round(100.0 * count(*) FILTER (WHERE same AND NOT flip)::DOUBLE / count(*) FILTER (WHERE same), 6) ELSE 0.0 END AS correct_same_pct,
    CASE WHEN count(*) FILTER (WHERE NOT same) > 0 THEN round(100.0 * count(*) FILTER (WHERE NOT same AND NOT flip)::DOUBLE / count(*) FILTER (WHERE NOT same), 6) ELSE 0.0 END AS correct_changed_pct,
    round(100.0 * count(*)::DOUBLE / sum(count(*)) OVER (), 6) AS share_pct FROM b GROUP BY attr""",
)
def report_eval_attrs(e: DataFrame) -> DataFrame:
    return rounded(reports.eval_attr_stats(e))


@query(
    "report_stat_buckets",
    """, s AS (SELECT attr, count(*) AS n, count(*) FILTER (WHERE flip) AS flips FROM b WHERE bucket = 'high' GROUP BY attr), t AS (SELECT attr, count(*) AS pool FROM b GROUP BY attr)
    SELECT attr, n, flips, round(100.0 * n::DOUBLE / pool, 6) AS pool_pct, round(100.0 * n::DOUBLE / sum(n) OVER (), 6) AS selected_pct FROM s LEFT JOIN t USING (attr)""",
)
def report_stat_buckets(e: DataFrame) -> DataFrame:
    return rounded(reports.stat_buckets(e.filter(E.bucket() == "high"), e))


@query(
    "report_completions",
    """, x AS (SELECT nullif(length(split_part(prompt, '="', 3)), 0) AS n FROM b)
    SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS total, round(coalesce(avg(n), 0.0), 6) AS mean, coalesce(max(n), 0) AS largest, count(*) FILTER (WHERE n IS NULL) AS missing FROM x""",
)
def report_completions(e: DataFrame) -> DataFrame:
    return rounded(reports.completion_lengths(e))


@query("report_flip_files", "SELECT coalesce(file, '') AS file, count(*) AS n FROM b WHERE flip GROUP BY 1")
def report_flip_files(e: DataFrame) -> DataFrame:
    return reports.flips_per_file(e)


@query(
    "report_variance",
    """SELECT concat(CAST(user_id AS VARCHAR), ':', event_type) AS id, count(*) AS n, round(avg(value), 6) AS mean, round(var_samp(value), 6) AS variance, round(stddev_samp(value), 6) AS std,
    round(min(value), 6) AS least, round(max(value), 6) AS most, round(max(value) - min(value), 6) AS range FROM events WHERE isfinite(value) GROUP BY 1 HAVING count(*) >= 2""",
    event_entries,
)
def report_variance(e: DataFrame) -> DataFrame:
    return rounded(reports.difficulty_variance(e))


_HIST = """WITH v AS (SELECT value AS v FROM events WHERE isfinite(value)),
s AS (SELECT count(*) AS n, min(v) AS low, max(v) AS high, quantile_cont(v, 0.99) AS top FROM v),
p AS (SELECT low, CASE WHEN top > low THEN top ELSE high END AS upper, least(60, greatest(10, 2 * CAST(floor(sqrt(n)) AS INTEGER))) AS k FROM s),
q AS (SELECT *, (upper - low) / k AS width FROM p),
h AS (SELECT least(CAST(floor((least(v, upper) - low) / width) AS INTEGER), k - 1) AS bin, v > upper AS over, low, width FROM v, q)"""


@query("report_histogram", _HIST + " SELECT bin, round(any_value(low) + bin * any_value(width), 6) AS low, round(any_value(low) + (bin + 1) * any_value(width), 6) AS high, count(*) AS n, count(*) FILTER (WHERE over) AS tail FROM h GROUP BY bin", event_entries)
def report_histogram(e: DataFrame) -> DataFrame:
    return rounded(reports.histogram(e, F.col("loss_metrics.completion_difficulty")))


@query("report_log_scale", _HIST + ", c AS (SELECT count(*) AS n FROM h GROUP BY bin) SELECT coalesce(max(n) > 50 * min(n), false) AS log_scale FROM c", event_entries)
def report_log_scale(e: DataFrame) -> DataFrame:
    return reports.wants_log_scale(reports.histogram(e, F.col("loss_metrics.completion_difficulty")))


@query("report_quantiles", "SELECT count(*) AS n, round(quantile_cont(value, 0.1), 6) AS p10, round(quantile_cont(value, 1.0 / 3), 6) AS p33, round(quantile_cont(value, 2.0 / 3), 6) AS p67, round(quantile_cont(value, 0.9), 6) AS p90 FROM events WHERE isfinite(value)", event_entries)
def report_quantiles(e: DataFrame) -> DataFrame:
    return rounded(reports.quantiles(e, F.col("loss_metrics.completion_difficulty")))


# Sampling. Duplicate line items are dropped first, so that _ord tells every row apart.
_POOL = ", u AS (SELECT DISTINCT * FROM b), k AS (SELECT *, sha1(concat_ws('#', _ord, '1337')) AS key FROM u)"
_QUOTAS = """, z AS (SELECT attr, count(*) AS n FROM u GROUP BY attr), y AS (SELECT *, sum(n) OVER () AS total FROM z),
sh AS (SELECT attr, n, n * 500 // total AS share, n * 500 % total AS rest FROM y),
ql AS (SELECT attr, n, share, row_number() OVER (ORDER BY rest DESC, attr DESC) AS place, 500 - sum(share) OVER () AS lft FROM sh),
quotas AS (SELECT attr, n, CAST(least(n, share + CASE WHEN place <= lft THEN 1 ELSE 0 END) AS BIGINT) AS quota FROM ql)"""


def _quotas(e: DataFrame, total: int = 500) -> DataFrame:
    return sampling.allocate(e.groupBy(E.attr().alias("attr")).agg(F.count("*").alias("n")), total)


_SYNTHETIC = ", sy AS (SELECT *, CAST(left(_ord, 12) AS BIGINT) % 700 = 1 AS syn FROM k)"


def _apart(e: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All entries, as a pool and as synthetic ones."""
    rows, synthetic = e.distinct(), F.substring("_ord", 1, 12).cast("long") % 700 == 1
    return rows.filter(~synthetic), rows.filter(synthetic)


@query("sample_quotas", _POOL + _QUOTAS + " SELECT attr, n, quota FROM quotas")
def sample_quotas(e: DataFrame) -> DataFrame:
    return _quotas(e.distinct())


_STRATA = """, cells AS (SELECT attr, count(*) FILTER (WHERE NOT same AND NOT flip) AS n00, count(*) FILTER (WHERE NOT same AND flip) AS n01, count(*) FILTER (WHERE same AND NOT flip) AS n10, count(*) FILTER (WHERE same AND flip) AS n11 FROM u GROUP BY attr),
p1 AS (SELECT c.*, q.quota, least(n10 + n11, CAST(round_even(q.quota * 0.25, 0) AS BIGINT)) AS t1 FROM cells c JOIN quotas q USING (attr)),
p2 AS (SELECT *, least(n00 + n01, quota - t1) AS t0 FROM p1),
p3 AS (SELECT * EXCLUDE (t1), least(n10 + n11, quota - t0) AS t1 FROM p2),
p4 AS (SELECT *, least(n01, t0 - least(n00, CAST(round_even(t0 * 0.5, 0) AS BIGINT))) AS f0, least(n11, t1 - least(n10, CAST(round_even(t1 * 0.5, 0) AS BIGINT))) AS f1 FROM p3),
p5 AS (SELECT attr, f0, f1, least(n00, t0 - f0) AS c0, least(n10, t1 - f1) AS c1 FROM p4),
r AS (SELECT _ord, attr, same, flip, row_number() OVER (PARTITION BY attr, same, flip ORDER BY key) AS place FROM k),
picked AS (SELECT _ord, attr FROM r JOIN p5 USING (attr) WHERE place <= CASE WHEN same THEN CASE WHEN flip THEN f1 ELSE c1 END ELSE CASE WHEN flip THEN f0 ELSE c0 END END)"""


@query(
    "sample_attrs",
    _POOL + _QUOTAS + _STRATA + " SELECT _ord, attr FROM picked",
)
def sample_attrs(e: DataFrame) -> DataFrame:
    pool = e.distinct()
    return sampling.sample_attrs(pool, _quotas(pool), 0.5, 0.25, 1337).select("_ord", E.attr().alias("attr"))


@query("batch_fixed", _POOL + " SELECT _ord, CAST((row_number() OVER (ORDER BY len, _ord) - 1) // 35 AS INTEGER) AS batch_id FROM u")
def batch_fixed(e: DataFrame) -> DataFrame:
    return sampling.fixed_batches(e.distinct()).select("_ord", "batch_id")


@query("replicate", "SELECT _ord, unnest(range(1, CAST(left(_ord, 12) AS BIGINT) % 3 + 1)) AS _copy FROM (SELECT DISTINCT _ord FROM b)")
def replicate(e: DataFrame) -> DataFrame:
    return sampling.replicate(e.select("_ord").distinct(), F.substring("_ord", 1, 12).cast("long") % 3).select("_ord", F.col("_copy").cast("long").alias("_copy"))


@query(
    "sample_pad",
    _POOL + """, m AS (SELECT (1000 - count(*) % 1000) % 1000 AS needed FROM u),
    z AS (SELECT attr, count(*) AS n, min(_ord) AS f FROM u GROUP BY attr), t AS (SELECT *, row_number() OVER (ORDER BY n, f) - 1 AS turn, count(*) OVER () AS attrs FROM z),
    s AS (SELECT unnest(range(needed)) AS slot FROM m), d AS (SELECT attr, slot // attrs % n + 1 AS place FROM s JOIN t ON slot % attrs = turn),
    r AS (SELECT _ord, attr, row_number() OVER (PARTITION BY attr ORDER BY key) AS place FROM k)
    SELECT _ord, false AS padding FROM u UNION ALL SELECT _ord, true AS padding FROM r JOIN d USING (attr, place)""",
)
def sample_pad(e: DataFrame) -> DataFrame:
    return sampling.pad(e.distinct(), 1000).select("_ord", F.col("_is_padding_duplicate").alias("padding"))


@query(
    "sample_epochs",
    _POOL + _SYNTHETIC + """, x AS (SELECT _ord, bucket, epoch, syn, sha1(concat_ws('#', _ord, CAST(epoch + 1337 AS VARCHAR))) AS key FROM sy, (SELECT unnest(range(3)) AS epoch)),
    r AS (SELECT *, row_number() OVER (PARTITION BY epoch ORDER BY key) AS n FROM x WHERE bucket NOT IN ('high', 'medium') AND NOT syn)
    SELECT _ord, CAST(epoch AS INTEGER) AS epoch FROM x WHERE bucket IN ('high', 'medium') OR syn UNION ALL SELECT _ord, CAST(epoch AS INTEGER) AS epoch FROM r WHERE n <= 200""",
)
def sample_epochs(e: DataFrame) -> DataFrame:
    return sampling.epochs(*_apart(e), 3, 200).select("_ord", "epoch")


@query(
    "sample_split",
    _POOL + _SYNTHETIC + """, lim AS (SELECT greatest(0, 960 - count(*) FILTER (WHERE syn)) AS most FROM sy),
    r AS (SELECT _ord, key, row_number() OVER (ORDER BY CASE bucket WHEN 'high' THEN 2 WHEN 'medium' THEN 1 ELSE 0 END DESC, d DESC, len DESC, _ord) AS n FROM sy WHERE NOT syn),
    q AS (SELECT _ord, row_number() OVER (ORDER BY key) AS n FROM r, lim WHERE n > most)
    SELECT _ord, 'train' AS part FROM r, lim WHERE n <= most UNION ALL SELECT _ord, 'regular' AS part FROM q WHERE n <= 240""",
)
def sample_split(e: DataFrame) -> DataFrame:
    train, regular = sampling.split_training(*_apart(e), 24, 40, 10)
    return train.select("_ord", F.lit("train").alias("part")).unionByName(regular.select("_ord", F.lit("regular").alias("part")))


_EVAL_POOL = """, every AS (SELECT DISTINCT * FROM b),
hard AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY _ord) AS i FROM every WHERE bucket = 'high' AND CAST(left(_ord, 12) AS BIGINT) % 500 = 0),
seeds AS (SELECT * EXCLUDE (i) FROM hard WHERE id IS NULL OR i = 1), want AS (SELECT greatest(0, 540 - count(*)) AS w FROM seeds),
others AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY _ord) AS i FROM every WHERE bucket = 'medium' AND (id IS NULL OR id NOT IN (SELECT id FROM seeds WHERE id IS NOT NULL))),
u AS (SELECT * EXCLUDE (i) FROM others WHERE id IS NULL OR i = 1), k AS (SELECT *, sha1(concat_ws('#', _ord, '1337')) AS key FROM u)"""
_EVAL_QUOTAS = """, z AS (SELECT attr, count(*) AS n FROM u GROUP BY attr), y AS (SELECT *, sum(n) OVER () AS total, least((SELECT w FROM want), sum(n) OVER ()) AS goal FROM z),
sh AS (SELECT attr, n, goal, n * goal // total AS share, n * goal % total AS rest FROM y),
ql AS (SELECT attr, n, share, row_number() OVER (ORDER BY rest DESC, attr DESC) AS place, goal - sum(share) OVER () AS lft FROM sh),
quotas AS (SELECT attr, n, CAST(least(n, share + CASE WHEN place <= lft THEN 1 ELSE 0 END) AS BIGINT) AS quota FROM ql)"""


@query(
    "sample_balanced_eval",
    _EVAL_POOL + _EVAL_QUOTAS + _STRATA + """,
    more AS (SELECT _ord, attr, row_number() OVER (ORDER BY key) AS place FROM k WHERE _ord NOT IN (SELECT _ord FROM picked))
    SELECT _ord, attr FROM (SELECT _ord, attr FROM seeds ORDER BY _ord LIMIT 540) UNION ALL SELECT _ord, attr FROM picked
    UNION ALL SELECT _ord, attr FROM more WHERE place <= (SELECT w FROM want) - (SELECT count(*) FROM picked)""",
)
def sample_balanced_eval(e: DataFrame) -> DataFrame:
    pool = e.distinct()
    seeds = pool.filter((E.bucket() == "high") & (F.substring("_ord", 1, 12).cast("long") % 500 == 0))
    return sampling.balanced_eval(seeds, pool.filter(E.bucket() == "medium"), 540).select("_ord", E.attr().alias("attr"))


@query(
    "sample_big_eval",
    _POOL + """, base AS (SELECT * FROM u WHERE CAST(left(_ord, 12) AS BIGINT) % 700 = 0),
    d1 AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY _ord) AS n FROM base), b1 AS (SELECT _ord, id FROM d1 WHERE id IS NULL OR n = 1),
    syn AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY _ord) AS n FROM u WHERE CAST(left(_ord, 12) AS BIGINT) % 701 = 0 AND d >= 0.05),
    b2 AS (SELECT _ord, id FROM syn WHERE id IS NULL OR (n = 1 AND id NOT IN (SELECT id FROM b1 WHERE id IS NOT NULL))),
    held AS (SELECT * FROM b1 UNION ALL SELECT * FROM b2), miss AS (SELECT greatest(0, 2000 - count(*)) AS m FROM held),
    rest AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY _ord) AS n FROM k WHERE id IS NULL OR id NOT IN (SELECT id FROM held WHERE id IS NOT NULL)),
    r2 AS (SELECT _ord, bucket, row_number() OVER (PARTITION BY bucket ORDER BY key) AS p FROM rest WHERE id IS NULL OR n = 1),
    med AS (SELECT _ord FROM r2, miss WHERE bucket = 'medium' AND p <= floor(m * 0.25)),
    low AS (SELECT _ord FROM r2, miss WHERE bucket = 'low' AND p <= m - (SELECT count(*) FROM med))
    SELECT _ord FROM held UNION ALL SELECT _ord FROM med UNION ALL SELECT _ord FROM low""",
)
def sample_big_eval(e: DataFrame) -> DataFrame:
    pool, key = e.distinct(), F.substring("_ord", 1, 12).cast("long")
    return sampling.big_eval(pool.filter(key % 700 == 0), pool.filter(key % 701 == 0), pool, 2000).select("_ord")
