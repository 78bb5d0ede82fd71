import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from threshline.llm import topk, urlfilter, winnow

RULES = [("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("allow", "net", "/de/"), ("block", "example.net", "/de/8"), ("block", "org", "/es/")]


def test_top_k_against_all_products(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 64)
    monkeypatch.setattr(topk, "QUERY_GROUP", 3)
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(700, 16)).tolist()
    vectors[10:200] = [vectors[10]] * 190
    rows = [(i, v, "x") for i, v in enumerate(vectors)]
    rows += [(1000, None, "x"), (1001, [float("nan")] * 16, "x"), (1002, [None] + [0.0] * 15, "x"), (1100, [float("inf")] * 16, "x"), (1101, [1.0, 2.0], "x"), (1200, [], "x"), (None, vectors[0], "x"), (300, vectors[300], "x"), (7, vectors[7], "x")]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string").repartition(5), F.col("vec_id") % 100 == 0, 10)
    fine = [(i, np.floor(1024 * np.array(v)).astype(int)) for i, v, _ in rows if i is not None and v and len(v) == 16 and all(x is not None and np.isfinite(x) for x in v)]
    want = []
    for q, x in {i: v for i, v in fine if i % 100 == 0}.items():
        best = sorted((-int(x @ v), i) for i, v in fine if i != q)[:10]
        want += [(q, n, i, -s) for n, (s, i) in enumerate(best, 1)]
    assert sorted(map(tuple, got.collect())) == sorted(want)


@pytest.mark.parametrize("kind", ["normal", "small integers", "one list tells", "zeros"])
def test_lists_keep_all_of_the_best(kind):
    rng = np.random.default_rng(9)
    for seed in range(20):
        x = {"normal": lambda: rng.normal(size=(500, 12)) * 1000, "small integers": lambda: rng.integers(-2, 3, (500, 12)), "one list tells": lambda: rng.normal(size=(500, 12)) * [9000] + np.eye(12)[0] * 0, "zeros": lambda: np.zeros((500, 12))}[kind]().astype(np.int64)
        q = x[seed].copy() if kind != "one list tells" else np.eye(12, dtype=np.int64)[seed % 12] * 700
        scores = x @ q
        for floor in (-np.inf, float(np.sort(scores)[-30])):
            left = topk.Lists(x).read(q, 11, floor)
            need = np.flatnonzero((scores > np.sort(scores)[-11]) & (scores >= floor))
            assert len(set(left.tolist())) == len(left) and set(need) <= set(left.tolist())
            if kind == "one list tells":
                assert len(left) < 60  # most of the block was never met


def test_huge_components_are_refused(spark):
    for big in (1e18, 1e9):
        rows = spark.createDataFrame([(0, [big, 1.0]), (1, [big, 0.5])], "vec_id long, embedding array<double>")
        with pytest.raises(Exception, match="too large for integer scores"):
            topk.top_k(rows, F.col("vec_id") == 0).collect()


def test_top_k_of_few(spark):
    rows = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in topk.top_k(rows, F.col("vec_id") == 0).collect()] == [(0, 1, 1, 512 * 1024)]
    assert topk.top_k(rows.limit(0), F.col("vec_id") == 0).collect() == []


def judged(url):
    if not url or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    at = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, path = rest[:at], rest[at:]
    path = path[: min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    host = "".join(c.lower() if c.isascii() else c for c in host)
    fits = [(len(h + p), h + p, k) for k, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *max(fits)[1:]) if fits else (host, path, None, "allow")


def test_urls(spark):
    assert len(urlfilter.candidate_keys("a." * 20_000 + "net", "/de/8", [1, 2], [4, 5])) == 4
    rng = random.Random(3)
    hosts, paths = ["example.com", "a.Example.COM", "b.net", "x.example.net", "y.org", "com", "notexample.com", "É.org", "", "com.", ".com", "a." * 500 + "net", "x.y.z.example.com", "net"], ["/en/7", "/en/70?x", "/en/", "/en", "/de/8#y", "/de/9/z", "/es/", "", "?/en/", "/EN/7"]
    urls = [f"{s}://{h}{p}" for s in ("http", "x://y") for h in hosts for p in paths] + [None, "", "com/en/", "://", "http://a.com\n/en/7"]
    urls += [rng.choice(urls) for _ in range(50)]
    got = urlfilter.judge(spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, rule string"), RULES)
    assert [(r.host, r.path, r.rule, r.verdict) for r in got.orderBy("page_id").collect()] == [judged(u) for u in urls]


def test_cascade_is_exact_over_its_universe(spark, monkeypatch):
    monkeypatch.setattr(urlfilter, "RATES", (0.5, 0.5))
    keys = [(f"k{i}",) for i in range(2000)]
    listed = keys[::17]
    made = urlfilter.build_cascade(spark.createDataFrame(listed, "key string"), spark.createDataFrame(keys * 2, "key string"))
    assert len(made.levels) > 2
    assert made.listed([k for k, in keys]).tolist() == [k in set(listed) for k in keys]


def test_no_pages(spark):
    assert urlfilter.judge(spark.createDataFrame([], "page_id long, url string"), RULES).collect() == []


def spans(words, n, items):
    hit, found = set(), set()
    for i, ws in items:
        k = min(len(ws), n)
        for a in range(len(ws) - k + 1) if k else []:
            for b in range(len(words) - k + 1):
                if words[b : b + k] == ws[a : a + k]:
                    hit.update(range(b, b + k))
                    found.add(str(i))
    return len(hit), sorted(found - {"None"})


def test_benchmark_spans(spark):
    import re

    def cut(t):
        low = "".join(c.lower() if c.isascii() else c for c in t or "")
        return [w for w in re.split("[\x00-/:-`{-\x7f]+", low) if w]

    rng = random.Random(8)
    v = [f"w{i}É" if i % 5 == 0 else f"W{i}" for i in range(40)]
    items = [(i, " ".join(rng.choice(v) for _ in range(n))) for i, n in enumerate((3, 5, 13, 14, 20, 40, 7))] + [(7, None), (8, "--"), (None, "w1 w2 w3 w4"), (2, "Other words here are many and new in this item of the benchmark set")]
    docs = []
    for i in range(60):
        t = [rng.choice(v) for _ in range(rng.randrange(0, 50))]
        src = rng.choice([x for _, x in items if x]).split()
        a, b = sorted((rng.randrange(len(src) + 1), rng.randrange(len(src) + 1)))
        at = rng.randrange(len(t) + 1)
        docs.append((i, ", ".join(t[:at] + src[a:b] + t[at:]), "x"))
    docs += [(100, None, "x"), (101, "", "x"), (102, items[5][1] * 300, "x"), (3, docs[3][1], "x"), (None, items[4][1], "x")]
    got = winnow.find_spans(spark.createDataFrame(docs, "doc_id long, text string, items string").repartition(3), spark.createDataFrame(items, "item_id long, text string"))
    cuts = [(i, cut(t)) for i, t in items]
    hashes = {r.t: r.h for r in spark.createDataFrame([(t,) for _, t, _ in docs], "t string").select("t", F.xxhash64("t").alias("h")).distinct().collect()}
    want = [(i, hashes[t], len(cut(t)), *spans(cut(t), 13, cuts)) for i, t, _ in docs]
    rows = [(r.doc_id, r._text_hash, r.n_words, r.n_hit, r["items"]) for r in got.collect()]
    assert sorted(rows, key=str) == sorted(want, key=str)  # a list: repeated rows count


def test_a_short_item_costs_windows_of_its_own_length(spark):
    rng = random.Random(4)
    long_item = " ".join(f"x{i}" for i in range(20))
    docs = [(i, " ".join(["the", *(f"u{rng.randrange(10**6)}" for _ in range(30))])) for i in range(50)] + [(99, long_item)]
    got = winnow.find_spans(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(0, "the"), (1, long_item)], "item_id long, text string"))
    plan = {r.doc_id: r for r in got.collect()}
    assert all([(s.start, s.n) for s in plan[i].spans] == [(0, 1)] for i in range(50))
    assert plan[99].n_hit == 20 and plan[99]["items"] == ["1"]


def test_no_benchmark(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert [(r.n_words, r.n_hit) for r in winnow.find_spans(docs, none).collect()] == [(3, 0)]
    assert winnow.find_spans(docs.limit(0), none).collect() == []


def test_every_row_of_the_query_has_its_result(spark, tmp_path):
    import duckdb

    from threshline.llm import queries

    item = " ".join(f"w{i}" for i in range(15))
    docs = [(1, item), (1, item), (1, "other text"), (2, "a b c"), (2, "a b c"), (2, "a b c"), (3, None), (3, None), (None, item + " x"), (None, item + " x"), (4, "")]
    spark.createDataFrame(docs, "doc_id long, text string").repartition(2).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(7, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = queries.op9_winnow(spark, str(tmp_path))
    c = duckdb.connect()
    for name in ("documents", "benchmark"):
        c.sql(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}.parquet/*.parquet')")
    want = c.sql(f"SELECT {', '.join(got.columns)} FROM ({queries.ORACLES['op9_winnow']})").fetchall()
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(docs) and sorted(rows, key=str) == sorted(want, key=str)
