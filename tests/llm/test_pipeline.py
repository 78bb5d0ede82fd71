import random

from pyspark.sql import functions as F

import corpus_pipeline
from threshline.llm import bpe
from threshline.llm.lines import within_one_edit


def made():
    """Documents whose fate is known: (doc_id, text, lang, kept)."""
    rng = random.Random(12)
    words = {"en": [f"the{c}ing" for c in "bcdfghjklmnpqrstvw"], "de": [f"schön{c}keit" for c in "bcdfghjklmnpqrstvw"]}
    item = " ".join(f"bench{i}" for i in range(30))
    out, n = [], 0

    def text(lang, length=60):
        return " ".join(rng.choice(words[lang]) + str(rng.randrange(1000)) for _ in range(length))

    for lang in words:
        for _ in range(12):
            out.append((n, text(lang), lang, True))
            n += 1
    base = text("en", 80)
    near = base.split()
    near[40] = "changed"
    out += [(n, base, "en", True), (n + 1, base, "en", False), (n + 2, " ".join(near), "en", False)]
    out += [(n + 3, "123 ... 456", "en", False), (n + 4, None, "en", False), (n + 5, "", None, False), (n + 6, text("en", 40) + " " + item, "en", False), (n + 7, text("de", 900) + " " + item, "de", True)]
    line = text("en", 12)
    out += [(n + 8, f"{text('en')}\n{line}\nend", "en", True), (n + 9, f"{line} more\n{text('en')}", "en", True)]
    return out, item


def run_stages(spark, rows, tmp_path, extra=()):
    docs, item = rows
    (tmp_path / "in").mkdir(exist_ok=True)
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.mode("overwrite").parquet(f"{tmp_path}/in/benchmark.parquet")
    now = spark.createDataFrame([(i, t, x, "src", len(t or "")) for i, t, x, _ in docs], "doc_id long, text string, lang string, source string, n_chars long")
    for name in extra:
        now = now.withColumn(name, F.lit(name))
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, now, f"{tmp_path}/in").write.mode("overwrite").parquet(f"{tmp_path}/{name}")
        now = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = now
    return seen


def test_fates(spark, tmp_path):
    docs, item = made()
    seen = run_stages(spark, (docs, item), tmp_path)
    assert all(seen[n].columns == ["doc_id", "text", "lang", "source", "n_chars"] for n in list(seen)[:-1])
    last = {r.doc_id: r for r in seen["tokens"].collect()}
    # the second of two documents of one line each is a repeated line, and goes with it
    assert set(last) == {i for i, _, _, kept in docs if kept}
    texts = {r.doc_id: r.text for r in seen["benchmark"].collect()}
    n = max(last)
    assert texts[n].count("\n") == 0 and texts[n - 1].count("\n") == 2
    merger = bpe.Merger(open(corpus_pipeline.TOKENIZER, encoding="utf-8").read())
    pre = bpe.PreTokenizer(open(corpus_pipeline.TOKENIZER, encoding="utf-8").read(), merger.special)
    for i, r in last.items():
        want = [x for _, ws in pre.parts(texts[i]) for w in ws for x in merger.merge(w)]
        assert r.ids == want and r.n_tokens == len(want) and r.decoded == " ".join(merger.names[x] for x in want)


def test_no_line_is_left_that_repeats_an_earlier_one(spark, tmp_path):
    seen = run_stages(spark, made(), tmp_path)
    earlier = []
    for r in seen["lines"].orderBy("doc_id").collect():
        assert r.n_chars == len(r.text)
        for line in r.text.split("\n"):
            words = line.encode().lower().split()
            if len(words) >= 6:
                assert not any(within_one_edit(words, e) for e in earlier)
                earlier.append(words)


def test_empty_table(spark, tmp_path):
    docs, item = made()
    (tmp_path / "in").mkdir()
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/in/benchmark.parquet")
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/in/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/in").collect() == []
    spark.createDataFrame([(i, t, x, "s", 0) for i, t, x, _ in docs], schema).write.mode("overwrite").parquet(f"{tmp_path}/in/documents.parquet")
    assert {r.doc_id for r in corpus_pipeline.run(spark, f"{tmp_path}/in").collect()} == {i for i, _, _, kept in docs if kept}


def test_columns_with_names_of_the_stages_own(spark, tmp_path):
    extra = ["_id", "_hash", "text_hash", "_text_hash", "n_lines", "n_lines_removed", "lines", "lang_pred", "score", "_lang", "kept", "component_id", "ids", "decoded", "item_id", "print", "words", "key"]
    docs, item = made()
    seen = run_stages(spark, (docs, item), tmp_path, extra)
    assert {r.doc_id for r in seen["tokens"].collect()} == {i for i, _, _, kept in docs if kept}
    last = seen["benchmark"]
    assert last.columns == ["doc_id", "text", "lang", "source", "n_chars", *extra]
    assert all(r[name] == name for r in last.collect() for name in extra)


def test_stages_without_columns_that_they_do_not_need(spark, tmp_path):
    rows = [(1, "the same line of eight words is here\nand another line that has quite different words in it", "en"), (2, "the same line of eight words is here", "en"), (None, None, None), (3, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    stages = dict(corpus_pipeline.STAGES)
    got = stages["lines"](spark, docs, str(tmp_path))
    assert got.columns == docs.columns and {r.doc_id for r in got.collect()} == {1, None, 3}
    for name in ("near_copies", "benchmark"):
        out = stages[name](spark, docs.select("doc_id", "text"), str(tmp_path))
        assert out.columns == ["doc_id", "text"] and out.count() == 4
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), str(tmp_path)).collect() == []
