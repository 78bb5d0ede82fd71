import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from threshline.functions import entries as E
from threshline.operators import batching, cache, dedupe, filters, passes, reports, sampling, scoring
from threshline.operators.ranking import global_rank, percentiles
from threshline.plans.derive import entries
from threshline.sources import readers, writers

DIR = "/root/testdata/sf0.001"


def some(spark, n=300):
    return entries(spark, DIR).distinct().orderBy("_ord").limit(n)


def test_engineered_batches_keep_every_row(spark):
    rows = some(spark)
    for plan in (batching.plan_balanced, batching.plan_by_attr):
        a = batching.engineer(rows, 24, plan)
        b = batching.engineer(rows.repartition(7), 24, plan)
        got = sorted((r._ord, r.batch_id, r.pos) for r in a.select("_ord", "batch_id", "pos").collect())
        assert got == sorted((r._ord, r.batch_id, r.pos) for r in b.select("_ord", "batch_id", "pos").collect())
        sizes = pd.Series([x[1] for x in got]).value_counts()
        assert len(got) == 300 and sizes.max() == 24 and len(sizes) == 13


def test_plans_spread(spark):
    rng = np.random.default_rng(0)
    rows = pd.DataFrame({"key": [f"{i:04}" for i in range(240)], "bucket": rng.choice(["high", "medium", "low"], 240), "attr": rng.choice(list("abcd"), 240), "flip": [i % 10 == 0 for i in range(240)], "same": [i % 8 == 0 for i in range(240)], "length": rng.integers(10, 90, 240).astype(float)})
    for found in (batching.plan_balanced(rows, 24), batching.plan_by_attr(rows, 24)):
        assert sorted(x for b in found for x in b) == list(range(240)) and {len(b) for b in found} == {24}
    by_attr = batching.plan_by_attr(rows, 24)
    counts = [pd.Series([rows.attr[i] for i in b]).value_counts() for b in by_attr]
    for a, n in rows.attr.value_counts().items():
        per = [c.get(a, 0) for c in counts]
        assert max(per) - min(per) <= 2 and sum(per) == n
    capped = batching.plan_by_attr(rows, 24, max_per_attr=7)
    assert sum(len(b) for b in capped) == 240
    batches = [[0, 1], [2, 3], [4, 5]]
    assert batching.spread_attrs(batches, [True, True, False, False, False, False], ["x"] * 6) == 1
    assert batching.plan_balanced(rows.iloc[:0], 4) == [] == batching.plan_by_attr(rows.iloc[:0], 4)


def test_stage0_epochs_pad_and_differ(spark):
    out = batching.stage0_epochs(some(spark, 95), 10, 2).select("epoch", "batch_id", "_is_padding_duplicate", "_ord").collect()
    assert len(out) == 200 and sum(r._is_padding_duplicate for r in out) == 10
    assert {(r.epoch, r.batch_id) for r in out} == {(e, b) for e in (0, 1) for b in range(10)}


def test_token_batches_hold_the_budget(spark):
    rows = some(spark)
    out = batching.token_batches(rows.select("_ord", "prompt"), 500, F.length("prompt"))
    other = batching.token_batches(rows.select("_ord", "prompt").repartition(32), 500, F.length("prompt"))
    assert sorted(out.select("_ord", "batch_id").collect()) == sorted(other.select("_ord", "batch_id").collect())
    none = batching.token_batches(rows.select("_ord", "prompt").limit(0), 500, F.length("prompt"))
    assert none.collect() == []
    per = out.groupBy("batch_id").agg((F.max(F.length("prompt")) * F.count("*")).alias("t"), F.count("*").alias("n")).collect()
    assert sum(r.n for r in per) == 300 and all(r.t <= 500 or r.n == 1 for r in per)


def test_length_cuts_are_those_of_one_walk():
    rng = np.random.default_rng(5)
    for _ in range(300):
        budget, lengths = int(rng.integers(1, 60)), sorted(rng.integers(0, 30, rng.integers(1, 60)).tolist())
        want, rows = [], 0
        for n in lengths:
            rows = 1 if not rows or n * (rows + 1) > budget else rows + 1
            want.append((want[-1] if want else -1) + (rows == 1))
        values, counts = np.unique(lengths, return_counts=True)
        got = []
        for n, (room, open_, cap) in zip(counts.tolist(), batching.length_cuts(list(zip(values.tolist(), counts.tolist(), strict=True)), budget), strict=True):
            got += [i // cap if open_ < 0 else open_ if i < room else open_ + 1 + (i - room) // cap for i in range(n)]
        assert got == want


def test_epochs_are_dealt_apart(spark):
    rows = some(spark, 50).withColumn("epoch", F.expr("pmod(hash(_ord), 2)"))
    got = batching.deal(rows, 8).groupBy("epoch", "batch_id").count().collect()
    for e in (0, 1):
        n = [r["count"] for r in got if r.epoch == e]
        assert sorted(n)[1:] == [8] * (len(n) - 1)


def test_a_run_version_holds_the_passes_options():
    versions = [cache.run_version([p], {}) for p in (passes.mirror(), passes.mirror(probability=0.5), passes.mirror(seed=1), passes.rename(0.1), passes.rename(0.2), passes.rename(0.2, exclude=["A"]), passes.duplicate_changes("pose", 2), passes.duplicate_changes("pose", 2.5), passes.no_change)]
    assert len(set(versions)) == len(versions) and cache.run_version([passes.mirror()], {}) == versions[0]
    a, b = (scoring.OnnxScorer("m", "t", end=e) for e in (None, "</s>"))
    assert cache.described(a) != cache.described(b) and cache.described(scoring.HashScorer)["name"].endswith("HashScorer")


def test_dealing_small_tables(spark):
    assert batching.deal(some(spark, 5), 24).select("batch_id").distinct().count() == 1
    assert batching.deal(some(spark, 50), 24, drop_last=True).count() == 48


def test_eval_sets_have_their_size_and_no_double_ids(spark):
    rows = entries(spark, DIR).distinct()
    seeds = rows.filter(F.substring("_ord", 1, 12).cast("long") % 400 == 0)
    got = sampling.balanced_eval(seeds, rows, 120).select("id", "_ord").collect()
    ids = [r.id for r in got if r.id]
    assert len(got) == 120 and len(ids) == len(set(ids))
    assert sampling.balanced_eval(rows, rows, 7).count() == 7
    assert sampling.epochs(rows, rows.limit(0), 0, 5).count() == 0
    assert sampling.replicate(rows.limit(4), F.lit(0)).count() == 0
    assert dedupe.pick_unique(rows, 0).count() == 0
    assert filters.drop_hardest(rows, 0).count() == rows.count()


def test_global_rank_is_a_rank(spark):
    rows = spark.range(1000).select((F.col("id") * 37 % 1000).alias("v")).repartition(9)
    assert [r.rank for r in global_rank(rows, F.desc("v")).orderBy(F.desc("v")).collect()] == list(range(1, 1001))


def test_percentiles(spark):
    rng = np.random.default_rng(2)
    for x in (rng.normal(size=501), rng.integers(0, 5, 64).astype(float), np.array([3.0])):
        n, got = percentiles(spark.createDataFrame([(float(v),) for v in x] + [(None,)], "v double").repartition(5), [0, 0.1, 1 / 3, 0.5, 0.99, 1])
        assert n == len(x) and np.allclose(got, np.quantile(x, [0, 0.1, 1 / 3, 0.5, 0.99, 1]))
    assert percentiles(spark.createDataFrame([], "v double"), [0.5]) == (0, [None])


def byte_encoder():
    return lambda t: list(t.encode())


def test_lengths_in_tokens(spark):
    rows = spark.createDataFrame([("é a",), ("",), (None,)], "expected_value string")
    n = E.token_length(F.col("expected_value"), byte_encoder)
    assert [r.n for r in rows.select(n.alias("n")).collect()] == [4, 0, 0]
    got = reports.completion_lengths(rows, n).first()
    assert (got.total, got.largest, got.missing) == (4, 4, 2)


def test_flat_folders(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    for name in ("a.jsonl", "b.jsonl", "c.txt", "sub/d.jsonl"):
        (tmp_path / name).write_text("{}\n")
    found = spark.read.text(readers.flat_glob(str(tmp_path), ".jsonl"))
    assert found.count() == 2


def test_histogram_edges(spark):
    rows = spark.createDataFrame([(1.0,), (1.0,), (float("nan"),), (None,), (float("inf"),)], "v double")
    assert [(r.bin, r.n, r.tail) for r in reports.histogram(rows, F.col("v")).collect()] == [(0, 2, 0)]
    assert reports.histogram(rows.limit(0), F.col("v")).collect() == []


def test_difficulty_metrics_by_hand():
    logits = np.log(np.array([[[0.7, 0.2, 0.1], [0.1, 0.6, 0.3], [0.2, 0.2, 0.6], [1, 1, 1]]]))
    labels = np.array([[-100, 0, 2, 1]])
    (m,) = scoring.difficulty_metrics(logits, labels, lambda t: "abc"[t])
    (opened,) = scoring.difficulty_metrics(logits, labels, lambda t: "abc"[t], {0})
    loss = [-np.log(0.7), -np.log(0.3), -np.log(0.2)]
    value = [1 - (0.7 - 0.2), 1 - (0.3 - 0.6), 1 - (0.2 - 0.6)]
    average = (value[0] + 0.5 * value[1] + 0.5 * value[2]) / 2
    assert np.isclose(m["mean_loss"], np.mean(loss)) and np.isclose(m["worst_loss"], max(loss))
    assert np.isclose(m["completion_difficulty"], 0.5 * average + 0.5 * value[0])
    assert m["critical_token"] == {"position": 2, "token_id": 1, "decoded_value": "b", "loss": pytest.approx(loss[2]), "pred_token_id": 2, "pred_decoded_value": "c"}
    every = (value[0] + value[1] + 0.5 * value[2]) / 2.5  # the token after a delimiter counts fully
    assert np.isclose(opened["completion_difficulty"], 0.5 * every + 0.5 * max(value[:2]))
    (none,) = scoring.difficulty_metrics(logits, np.full((1, 4), -100), str)
    assert none["critical_token"]["position"] == -1


class Small(scoring.HashScorer):
    def logits(self, batch):
        if batch.size > 600:
            raise MemoryError
        return super().logits(batch)


def test_batches_that_fail_are_halved_once():
    pairs = [("a" * 20, "a" * 20 + "b" * 30)] * 20
    want = scoring.score_pairs(scoring.HashScorer(), pairs, 1200)
    assert scoring.score_pairs(Small(), pairs, 1200) == want
    assert scoring.score_pairs(Small(), [("a" * 400, "a" * 400 + "b" * 400)], 900) == [None]
    with pytest.raises(MemoryError):
        scoring.score_pairs(Small(), [("a" * 400, "a" * 400 + "b" * 400)], 2000)
    found = scoring.benchmark_budgets(["x" * 50] * 10, [100, 1000], scoring.HashScorer())
    assert scoring.best_budget(found) in (100, 1000) and [r["tokens"] for r in found] == [500, 500]
    assert scoring.best_budget([]) is None


def test_delimiters_are_all_tokens_of_the_fixed_strings():
    assert scoring.delimiter_ids(scoring.HashScorer()) == frozenset(b",; ({[")


def test_a_prefix_that_leaves_nothing_gives_way_to_the_last_value():
    s = scoring.HashScorer()
    assert scoring._split(s, 'a="b', 'a="bc')[1] == list(b"bc")  # one token was left
    assert scoring._split(s, 'a="', 'a="bc')[1] == list(b"bc")
    assert scoring._split(s, 'a="b', 'a="b')[1] == []  # the other prefix leaves no more than one
    assert scoring._split(s, "plain", "plain")[1] == []


def test_any_causal_model_can_score():
    seen = []

    def forward(ids, mask):
        seen.append((ids.tolist(), mask.tolist()))
        return scoring.HashScorer().logits(ids)

    plain, ours = scoring.HashScorer(), scoring.CausalScorer(lambda t: list(t.encode()), lambda i: chr(i), forward, end=[3], pad=7)
    (m, _) = scoring.score_pairs(ours, [('x="', 'x="abc'), ("", "q")])
    assert seen[0][0][0] == [*b"q", 3, 7, 7, 7, 7, 7] or seen[0][0][1] == [*b"q", 3, 7, 7, 7, 7, 7]
    assert sum(map(sum, seen[0][1])) == 9 and m["critical_token"]["position"] >= 2
    plain.end = [3]
    assert m == scoring.score_pairs(plain, [('x="', 'x="abc')])[0]


def test_scores_do_not_depend_on_partitions(spark):
    rows = some(spark, 60)
    a = scoring.score(rows).select("_ord", "loss_metrics").collect()
    b = scoring.score(rows.repartition(5)).select("_ord", "loss_metrics").collect()
    assert sorted(a) == sorted(b) and all(r.loss_metrics.worst_loss > 0 for r in a)


def test_cache_round_trip(spark, tmp_path):
    path = f"file://{tmp_path}/cache"
    schema = "k string, v int, created_at timestamp, last_used timestamp"
    assert cache.read(spark, path, schema).count() == 0
    new = spark.createDataFrame([("A.txt", 1), ("b", 2)], "k string, v int")
    cache.save(cache.upsert(cache.read(spark, path, schema), new, ["k"]), path)
    born = {r.k: r.created_at for r in cache.read(spark, path, schema).collect()}
    cache.save(cache.upsert(cache.read(spark, path, schema), new.filter("k = 'b'").withColumn("v", F.lit(9)), ["k"]), path)
    got = {r.k: (r.v, r.created_at) for r in cache.read(spark, path, schema).collect()}
    assert got == {"A.txt": (1, born["A.txt"]), "b": (9, born["b"])}
    hits, missing = cache.split(spark.createDataFrame([("b",), ("c",)], "k string"), cache.read(spark, path, schema), ["k"])
    assert [r.v for r in hits.collect()] == [9] and [r.k for r in missing.collect()] == ["c"]
    assert cache.forget(cache.read(spark, path, schema), "a.TXT", "k").count() == 1
    assert cache.touch(cache.read(spark, path, schema), hits, ["k"]).filter("last_used > created_at").count() >= 1
    assert cache.forget_datapoints(hits.withColumnRenamed("k", "dp_key"), spark.createDataFrame([("b",)], "dp_key string")).count() == 0
    assert cache.run_version(["a"], {}) != cache.run_version(["b"], {})


def test_jsonl_round_trip(spark, tmp_path):
    rows = some(spark, 20)
    path = f"{tmp_path}/out"
    writers.entries(rows, path, F.col("_ord"), single=True)
    back = readers.jsonl(spark, path)
    assert [r.prompt for r in back.orderBy("_ord").collect()] == [r.prompt for r in rows.orderBy("_ord").collect()]
    (tmp_path / "bad.jsonl").write_text('{"prompt": "a"}\n\nnot json\n{"text": "b"}\n{"input": "é"}\n')
    assert readers.jsonl_lenient(spark, f"{tmp_path}/bad.jsonl").count() == 3
    assert [r.prompt for r in readers.prompts(spark, f"{tmp_path}/bad.jsonl").collect()] == ["a", "b", "é"]
    assert readers.prompts(spark, f"{tmp_path}/bad.jsonl", 2).count() == 2
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "X.Train.TXT").write_text('  <stats character="A" p="1" />\nother\n\n')
    assert readers.texts(spark, f"{tmp_path}/in", ".train.txt").count() == 1
    lines = readers.text_lines(spark, f"{tmp_path}/in", ".train.txt")
    assert readers.stat_lines(lines).count() == 1 and readers.skipped_lines(lines).first().skipped == 1
    assert spark.createDataFrame([('{"a":"é😀"}',)], "s string").select(writers.ascii_escaped(F.col("s")).alias("s")).first().s == '{"a":"\\u00e9\\ud83d\\ude00"}'
    writers.clean(spark, path)
    assert not (tmp_path / "out").exists()
