import random
from itertools import combinations

from threshline.llm import minhash
from threshline.llm.components import components

SCHEMA = "doc_id long, text string, extra string"


def brute(rows, k, percent):
    sets = {}
    for i, t, _ in rows:
        if i is None:
            continue
        w = (t or "").encode().lower().split()
        sets.setdefault(i, []).append({tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set()))
    parent = {i: i for i in sets}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(sets, 2):
        if any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
            x, y = sorted((top(a), top(b)))
            parent[y] = x
    return {i: top(i) for i in sets}


def edited(rng, words, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"x{rng.randrange(10**6)}"
    return out


def check(spark, rows, k, percent):
    got = minhash.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(3), k, percent).collect()
    assert len(got) == len(rows)
    want = brute(rows, k, percent)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert r.component_id == want[r.doc_id], r
            assert r.kept == (r.doc_id == want[r.doc_id])


def test_large_group_around_the_threshold(spark):
    rng = random.Random(5)
    base = [f"w{rng.randrange(10**6)}" for _ in range(150)]
    other = [f"w{rng.randrange(10**6)}" for _ in range(150)]
    rows = [(i, " ".join(edited(rng, base if i % 3 else other, rng.randrange(1, 12))), None) for i in range(300)]
    check(spark, rows, 3, 85)


def test_chunks_of_a_bucket(spark, monkeypatch):
    monkeypatch.setattr(minhash, "CHUNK", 16)
    rng = random.Random(6)
    base = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    rows = [(i, " ".join(edited(rng, base, 5)), "x") for i in range(90)]
    check(spark, rows, 3, 85)
    monkeypatch.setattr(minhash, "CHUNK_SHINGLES", 500)
    check(spark, [(i, t, e) for i, t, e in rows if i % 2], 3, 85)


def test_rows_of_one_id_with_several_texts(spark):
    rng = random.Random(8)
    texts = [[f"w{rng.randrange(10**6)}" for _ in range(60)] for _ in range(8)]
    rows = [(5, " ".join(t), "x") for t in texts[:4]]  # four texts that only their id links
    rows += [(10 + i, " ".join(edited(rng, t, 1)), "x") for i, t in enumerate(texts)]  # a near copy of each
    rows += [(3, " ".join(texts[4]), "x"), (3, " ".join(texts[5]), "x"), (4, " ".join(texts[5]), "x"), (4, " ".join(texts[6]), "x")]
    rng.shuffle(rows)
    check(spark, rows, 3, 85)


def test_edges(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(1, None, "a"), (2, "", "a"), (3, " \n\t", "a"), (4, "One two", None), (5, "one  TWO", None), (6, "two one", None), (7, text, "b"), (8, text, "b"), (8, text, "b"), (None, text, "b"), (9, text + " end", "c"), (10, text * 200, "d")]
    check(spark, rows, 5, 80)


def test_empty_table(spark):
    assert minhash.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_estimate_corrects_chance():
    rng = random.Random(1)
    common = [rng.randrange(2**64) for _ in range(800)]
    import numpy as np

    a = np.unique(np.array(common + [rng.randrange(2**64) for _ in range(100)], np.uint64))
    b = np.unique(np.array(common + [rng.randrange(2**64) for _ in range(100)], np.uint64))
    x, y = (np.frombuffer(minhash.planes(minhash.minima(s)), np.uint8) for s in (a, b))
    assert abs(float(minhash.estimate(x, y)) - 0.8) < 0.15


def test_components_of_a_chain(spark):
    n = 60
    links = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(101, 100), (100, 101)], "a long, b long")
    got = {r.node: r.root for r in components(links).collect()}
    assert got == {**{i: 0 for i in range(1, n + 1)}, 101: 100}
