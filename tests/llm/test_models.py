import math
import zlib
from collections import Counter

import numpy as np
from public_tokenizers import path
from pyspark.sql import functions as F

from threshline.llm import langid, lattice
from threshline.llm.common import held_out

PIECES = path("piece_bpe_32k.model")


def test_marginal_is_the_sum_over_segmentations():
    pieces, logp = lattice.read_vocabulary(PIECES)
    assert abs(np.exp(logp).sum() - 1) < 1e-9
    model = lattice.Lattice(pieces, logp)

    def brute(w):
        return 1.0 if not w else sum(math.exp(logp[model.table[w[:i]]]) * brute(w[i:]) for i in range(1, len(w) + 1) if w[:i] in model.table)

    words = [lattice._SPACE + w for w in (b"the", b"of", "é".encode(), b"inth", b"\xff\x00", b"x" * 9)]
    got = model.log_marginal([*words, b"q" * 300])
    assert np.allclose(got[:-1], [math.log(brute(w)) for w in words])
    assert np.isclose(got[-1], model._walk(b"q" * 300)[0][-1])
    # expected counts: pieces' bytes cover the words
    counts = model.expected([*words, b"q" * 300], np.ones(len(words) + 1))
    assert np.isclose(sum(n * len(p) for n, p in zip(counts, pieces, strict=True)), sum(map(len, words)) + 300)


def test_scores_and_baseline(spark):
    rows = [(i, f"the cat{i % 5} Sat on the mat{i % 3}\n", "x") for i in range(40)] + [(50, None, "x"), (51, "", "x"), (None, "the the", "x"), (52, "y" * 20_000, "x"), (3, "the cat3 Sat on the mat0\n", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    got = lattice.score_corpus(docs, PIECES, ~held_out("doc_id", 7)).collect()
    assert len(got) == len(rows)
    kept = [t for i, t, _ in rows if i is None or zlib.crc32(str(i).encode()) % 7 != 2]
    c = Counter(w for t in kept for w in [*lattice.tokens(t), b""])
    n, v = sum(c.values()), len(c)
    for r in got:
        words = [*lattice.tokens(r.text), b""]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(words), sum(c[w] > 0 for w in words), n)
        assert math.isclose(r.base_score, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in words))
        assert r.score < 0 and math.isfinite(r.score)
    best = {r.doc_id: r.score for r in got}
    assert best[51] > best[52] > best[1]


def spelled(model, logp, word):
    """A word's marginal by summing over all its segmentations."""
    word = lattice._SPACE + word
    sums = [1.0] + [0.0] * len(word)
    for j in range(1, len(word) + 1):
        sums[j] = sum(sums[i] * math.exp(logp[model.table[word[i:j]]]) for i in range(j) if word[i:j] in model.table)
    return sums[-1]


def test_documents_scores_by_hand(spark):
    """Whole documents against the sum over classes, words and segmentations, written out."""
    texts = [("the cat sat", "en"), ("the dog sat the", "en"), ("le chat le", "fr"), ("le chien", "fr"), ("the zebra", None)]
    rows = [(i, t, x) for i, (t, x) in enumerate(texts)] + [(100, "the chat unseenword", "en"), (101, "le", "fr"), (102, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r.score for r in lattice.score_corpus(docs, PIECES, F.col("doc_id") < 100, classes="lang", rounds=0).collect()}
    pieces, logp = lattice.read_vocabulary(PIECES)
    model = lattice.Lattice(pieces, logp)
    counts = {k: Counter(w for t, x in texts if x == k for w in t.encode().split()) for k in ("en", "fr", None)}
    docs_of = Counter(x for _, x in texts)

    def probability(text):
        total = 0.0
        for k, c in counts.items():
            n, d = sum(c.values()), docs_of[k]
            seen = Counter(c.values())
            less = min(0.95, max(0.1, (seen[1] + 1) / (seen[1] + 2 * seen[2] + 2)))
            end = (d + 1) / (n + d + 2)
            p = d / len(texts) * end
            for w in (text or "").encode().split():
                p *= (1 - end) * (max(0.0, c[w] - less) / n + min(1.0, less * len(c) / n) * spelled(model, logp, w))
            total += p
        return total

    for i, t, _ in rows:
        assert math.isclose(got[i], math.log10(probability(t)), rel_tol=1e-12), (i, t)


def test_blocks_are_dealt_evenly(spark):
    x = spark.range(2000).select(F.hash(F.col("id").cast("int")).alias("h")).toPandas().h.to_numpy()
    assert (lattice.murmur(np.arange(2000, dtype=np.uint32)).view(np.int32) == x).all()
    for n, parts in ((16, 51), (51, 51), (70, 12), (1, 200)):
        numbers = lattice.spread_numbers(n, parts)
        counts = np.bincount(lattice.murmur(np.array(numbers, np.uint32)).view(np.int32) % parts, minlength=parts)
        assert len(set(numbers)) == n and counts.max() == -(-n // parts)


def test_blocks_do_not_change_scores(spark, monkeypatch):
    rows = [(i % 30 or None, f"word{i % 7} other{i} the", "en") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    one = sorted((r.text, r.score) for r in lattice.score_corpus(docs, PIECES, F.col("doc_id") < 20).collect())
    monkeypatch.setattr(lattice, "BLOCK_BYTES", 100)
    many = sorted((r.text, r.score) for r in lattice.score_corpus(docs, PIECES, F.col("doc_id") < 20).collect())
    assert [t for t, _ in one] == [t for t, _ in many] and np.allclose([x for _, x in one], [x for _, x in many], rtol=1e-12)


def test_no_training_rows(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    got = lattice.score_corpus(docs, PIECES, F.lit(False)).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and math.isfinite(r.score) for r in got)
    assert lattice.score_corpus(docs.limit(0), PIECES, F.lit(True)).collect() == []


def test_languages_are_told_apart(spark):
    words = {"en": "the of and with thing house", "de": "der und nicht für haus größe", "fr": "le été où maison ça être"}
    rows = [(i, " ".join(words[x].split()[(i + j) % 6] for j in range(12)), x, "c") for i in range(30) for x in words]
    rows += [(100, None, "en", "c"), (101, "", "en", "c"), (102, "123 !!", "de", "c"), (103, "the house", None, "c"), (104, "haus " * 300_000, None, "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    langs, model = langid.fit(docs, F.col("doc_id") < 20)
    assert langs == ["de", "en", "fr"] and model.shape == (langid.BUCKETS + 1, 3)
    got = langid.predict(docs, langs, model).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id in (100, 101, 102):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        elif r.doc_id == 104:
            assert r.lang_pred == "de"
        elif r.lang:
            assert r.lang_pred == r.lang and 0.5 < r.score <= 1


def test_posteriors_by_hand(spark):
    """The model written out: counts of hashed n-grams, smoothed, by Bayes' rule in floats."""
    words = {"en": ["the", "of", "house"], "de": ["der", "und", "haus"], "fr": ["le", "et", "maison"]}
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(rng.choice(words[x], 3)), x) for i in range(8) for x in words] + [(50, "the", "en"), (60, "house und", None), (61, "le l", None), (62, "x", None), (63, "d", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    learned = F.col("doc_id") < 60
    got = {r.doc_id: r for r in langid.predict(docs, *langid.fit(docs, learned)).collect() if r.doc_id >= 50}
    train = [(t, x) for i, t, x in rows if i < 60]
    langs = sorted(words)
    count = {x: Counter() for x in langs}
    for t, x in train:
        count[x].update(int(b) for part in langid.features(t) for b in part)
    for i, t, _ in rows:
        if i in got:
            found = [int(b) for part in langid.features(t) for b in part]
            joint = []
            for x in langs:
                total = sum(count[x].values()) + langid.SMOOTHING * langid.BUCKETS
                p = math.log(sum(y == x for _, y in train) / len(train))
                joint.append(p + sum(math.log((count[x][b] + langid.SMOOTHING) / total) for b in found))
            top = max(joint)
            odds = [math.exp(j - top) for j in joint]
            assert got[i].lang_pred == langs[joint.index(top)] and math.isclose(got[i].score, max(odds) / sum(odds), rel_tol=1e-9)


def test_no_documents_for_languages(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert langid.predict(docs, *langid.fit(docs, F.lit(True))).collect() == []


def test_languages_without_training(spark):
    docs = spark.createDataFrame([(1, "word", "en")], "doc_id long, text string, lang string").withColumn("_block", F.lit("b")).withColumn("_train", F.lit(0)).withColumn("word", F.lit("w"))
    langs, model = langid.fit(docs, F.lit(False))
    assert [(r.lang_pred, r.score) for r in langid.predict(docs, langs, model).collect()] == [("und", 0.0)]


def test_chunks_give_the_same_features(monkeypatch):
    text = "größe thing " * 50
    whole = sorted(np.concatenate(list(langid.features(text))).tolist())
    monkeypatch.setattr(langid, "CHUNK", 17)
    assert sorted(np.concatenate(list(langid.features(text))).tolist()) == whole


def test_classes_of_training_rows(spark):
    rows = [(i, " ".join(w + str((i + j) % 9) for j in range(6)), x) for i in range(60) for x, w in (("en", "the"), ("fr", "le"))] + [(200, "the1 the2 the3", None), (201, "le1 le2 le3", "en"), (202, "le1 le2 le3", "xx")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("_block", F.lit("b")).withColumn("_train", F.lit(0)).withColumn("word", F.lit("w"))
    one = {r.doc_id: r for r in lattice.score_corpus(docs, PIECES, F.col("doc_id") < 200).collect() if r.doc_id >= 200}
    two = {r.doc_id: r for r in lattice.score_corpus(docs, PIECES, F.col("doc_id") < 200, classes="lang").collect() if r.doc_id >= 200}
    assert all(two[i].score > one[i].score and math.isclose(two[i].base_score, one[i].base_score) for i in one)
    assert two[201].score == two[202].score  # a scored row's own class is never looked at


def test_more_classes_than_are_kept(spark, monkeypatch):
    monkeypatch.setattr(lattice, "MAX_CLASSES", 3)
    rows = [(i, f"w{i % 5} x{i}", f"l{i % 7}") for i in range(70)]
    got = lattice.score_corpus(spark.createDataFrame(rows, "doc_id long, text string, lang string"), PIECES, F.lit(True), classes="lang").collect()
    assert len(got) == 70 and all(math.isfinite(r.score) and r.train_tokens == 210 for r in got)
