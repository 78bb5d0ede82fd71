import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from threshline.llm import lines

SCHEMA = "doc_id long, text string, n_lines string"


def brute(rows):
    order = sorted({(i if i is not None else 1 << 62, t) for i, t in rows if t is not None})
    seen, gone = [], set()
    for i, t in order:
        for j, line in enumerate(t.split("\n")):
            w = line.encode().lower().split()
            if len(w) >= lines.MIN_WORDS:
                if any(lines.within_one_edit(w, x) for x in seen):
                    gone.add((i, t, j))
                seen.append(w)
    out = []
    for i, t in rows:
        parts = [] if t is None else t.split("\n")
        left = [x for j, x in enumerate(parts) if (i if i is not None else 1 << 62, t, j) not in gone]
        out.append((str(i), None if t is None else "\n".join(left), len(parts), len(parts) - len(left)))
    return sorted(out, key=str)


@pytest.mark.parametrize("few", [True, False])
def test_against_brute_force(spark, monkeypatch, few):
    if not few:  # the ways of tables too large to broadcast
        monkeypatch.setattr(lines, "BROADCAST_ROWS", -1)
        monkeypatch.setattr(lines, "BROADCAST_KEYS", -1)
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(60)]
    pool = [[rng.choice(vocabulary) for _ in range(rng.randrange(1, 14))] for _ in range(40)]

    def line():
        w = list(rng.choice(pool))
        for _ in range(rng.choice((0, 0, 1, 1, 2))):
            at, kind = rng.randrange(len(w)), rng.randrange(3)
            w[at : at + (kind != 0)] = [] if kind == 1 else [rng.choice(vocabulary)]
            w = w or ["z"]
        return " ".join(w).upper() if rng.random() < 0.2 else "  ".join(w)

    rows = [(i, "\n".join(line() for _ in range(rng.randrange(0, 8)))) for i in range(60)]
    rows += [(70, None), (71, ""), (72, "\n\n"), (5, rows[5][1]), (None, rows[3][1]), (73, "a b c d e f " * 3000)]
    got = lines.dedup_lines(spark.createDataFrame([(i, t, "x") for i, t in rows], SCHEMA).withColumn("_id", F.lit(1)).withColumn("_hash", F.lit("h")).withColumn("lines", F.lit(2)).repartition(3)).collect()
    assert sorted(((str(r.doc_id), r.text, r.n_lines, r.n_lines_removed) for r in got), key=str) == brute(rows)


def test_empty_table(spark):
    assert lines.dedup_lines(spark.createDataFrame([], SCHEMA)).collect() == []


def test_variant_keys_meet():
    coder = lines.Coder()
    a = coder.words("one two three four five six seven")
    for b, same in (("one two THREE four five six seven", True), ("one two x four five six seven", True), ("one two four five six seven", True), ("one x two x four five six seven", False)):
        b = coder.words(b)
        ra, ca, oa = lines.variant_keys(coder.codes(a))
        rb, cb, ob = lines.variant_keys(coder.codes(b))
        met = bool(np.intersect1d(ra, rb).size) or oa in cb.tolist() or ob in ca.tolist()
        assert met == same == lines.within_one_edit(a, b)
        if same:
            assert set(lines.half_keys(a)) & set(lines.half_keys(b))


def test_filter_takes_all_its_keys(spark):
    from threshline.llm.common import filter_of

    keys = spark.range(-3000, 3000, 3).select("id")
    made = filter_of(keys, "id", 2000)
    every = np.arange(-3000, 3000)
    took = made.takes(every)
    assert took[::3].all() and took.mean() < 0.45
    assert not filter_of(keys.limit(0), "id", 0).takes(every).any()


def whole(rows, floor=6):
    """What is left if no line with a word is left out of the comparison."""
    seen, gone = [], set()
    for i, t in sorted(set(rows)):
        for j, line in enumerate(t.split("\n")):
            w = line.encode().lower().split()
            if w and any(w == x or (max(len(w), len(x)) >= floor and lines.within_one_edit(w, x)) for x in seen):
                gone.add((i, t, j))
            seen += [w] if w else []
    return sorted((i, "\n".join(x for j, x in enumerate(t.split("\n")) if (i, t, j) not in gone)) for i, t in rows)


@pytest.mark.parametrize("few", [True, False])
def test_short_lines_go_as_copies(spark, monkeypatch, few):
    if not few:
        monkeypatch.setattr(lines, "BROADCAST_ROWS", -1)
        monkeypatch.setattr(lines, "BROADCAST_KEYS", -1)
    rng = random.Random(9)
    pool = [[f"w{rng.randrange(30)}" for _ in range(n)] for n in (1, 1, 2, 3, 4, 5, 5, 6, 6, 7) for _ in range(3)]

    def line():
        w = list(rng.choice(pool))
        if rng.random() < 0.4:
            at = rng.randrange(len(w))
            w[at : at + 1] = rng.choice(([], [w[at], "more"], ["other"]))
        return " ".join(w).upper() if rng.random() < 0.2 else " ".join(w)

    rows = [(i, "\n".join(line() for _ in range(rng.randrange(1, 7)))) for i in range(40)]
    rows += [(50, "les.\n\n这是一个没有空格的句子。\nles"), (51, "Les.\n \n这是一个没有空格的句子。\nthe"), (52, "q1 q2 q3 q4 q5 q6\nq1 q2 q3 q4 q5\nq1 q2 q3 q4"), (53, "p1 p2 p4 p5 p6\np1 p2 p3 p4 p5 p6\np1 p2 p4 p5")]
    got = lines.dedup_lines(spark.createDataFrame([(i, t, "x") for i, t in rows], SCHEMA).repartition(3), copy_words=1).collect()
    left = sorted((r.doc_id, r.text) for r in got)
    assert left == whole(rows)
    assert dict(left)[51] == " \nthe" and dict(left)[52] == "q1 q2 q3 q4 q5 q6\nq1 q2 q3 q4" and dict(left)[53] == "p1 p2 p4 p5 p6\np1 p2 p4 p5"


def test_query_and_stage_take_short_copies(spark, tmp_path):
    import corpus_pipeline
    from threshline.llm import queries

    docs = spark.createDataFrame([(1, "les.\none", 8), (2, "two\nLES.", 8)], "doc_id long, text string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert {r.doc_id: r.n_removed for r in queries.op5_lines(spark, str(tmp_path)).collect()} == {1: 0, 2: 1}
    assert {r.doc_id: r.text for r in corpus_pipeline.repeated_lines(spark, docs, str(tmp_path)).collect()} == {1: "les.\none", 2: "two"}
