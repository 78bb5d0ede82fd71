import random

import pytest

from threshline.llm import prefixfree, repeats, suffixtree
from threshline.llm.repeats import Words, anchors, rolling, sliding_minimum

import numpy as np

SCHEMA = "doc_id long, text string, spans string"


def brute(texts, length, split, join):
    units = [split(t) for t in texts]
    seen = {}
    for u in units:
        for i in range(len(u) - length + 1):
            w = tuple(u[i : i + length])
            seen[w] = seen.get(w, 0) + 1
    out = []
    for u in units:
        gone = [False] * len(u)
        for i in range(len(u) - length + 1):
            if seen[tuple(u[i : i + length])] > 1:
                gone[i : i + length] = [True] * length
        out.append((len(u), sum(gone), join([x for x, g in zip(u, gone, strict=True) if not g])))
    return sorted(out)


def words(t):
    return (t or "").encode().split()


def raw(t):
    return (t or "").encode()


def corpus(seed, n=40):
    rng = random.Random(seed)
    vocabulary = [f"w{i}é" if i % 7 == 0 else f"w{i}" for i in range(300)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    texts = [None, "", " \n ", "short one", "a " * 300, "ab" * 700, "ab" * 500 + "c"]
    for _ in range(n):
        t = [rng.choice(vocabulary) for _ in range(rng.randrange(5, 120))]
        a, b = sorted(rng.sample(range(60), 2))
        at = rng.randrange(len(t))
        texts.append(" ".join(t[:at] + passage[a:b] + t[at:]))
    texts += [texts[10], texts[10], texts[11] + "\n" + texts[12] + " " + texts[11], " ".join(rng.choice(vocabulary) for _ in range(5000))]
    return texts


def compare(spark, drop, texts, length, split, join, **options):
    rows = [(i if i % 9 else None, t, "x") for i, t in enumerate(texts)]
    got = drop(spark.createDataFrame(rows, SCHEMA).repartition(3), window=length, **options).collect()
    assert sorted((r.n_units, r.n_removed, bytes(r.kept)) for r in got) == brute(texts, length, split, join)
    for r in got:
        assert sum(s.last - s.first + 1 for s in r.spans) == r.n_removed


@pytest.mark.parametrize("big", [None, 1, 3])
def test_words(spark, monkeypatch, big):
    if big == 1:  # too many keys to broadcast: a filter thins rows before the joins
        monkeypatch.setattr(repeats, "BROADCAST_ROWS", 0)
    if big:  # groups are split by longer and longer strings, until one window is left
        monkeypatch.setattr(repeats, "GROUP_ROWS", big)
        monkeypatch.setattr(suffixtree, "SUBTREE_WORDS", 2_000)
    compare(spark, suffixtree.drop_repeats, corpus(1), 12, words, b" ".join, gram=4)


@pytest.mark.parametrize("big", [None, 1, 3])
def test_bytes(spark, monkeypatch, big):
    if big:
        monkeypatch.setattr(repeats, "GROUP_ROWS", big)
        monkeypatch.setattr(prefixfree, "PARSE_BYTES", 20_000)
    compare(spark, prefixfree.drop_repeats, corpus(2), 90, raw, bytes, gram=16)


def test_empty_table(spark):
    assert suffixtree.drop_repeats(spark.createDataFrame([], SCHEMA)).collect() == []
    assert prefixfree.drop_repeats(spark.createDataFrame([], SCHEMA)).collect() == []


def test_chunks_of_a_long_text(spark, monkeypatch):
    monkeypatch.setattr(repeats, "CHUNK", 50)
    codes = rolling(np.arange(400, dtype=np.uint64) % np.uint64(37), 1)
    found = [(a, b) for _, first, last, _ in anchors(codes, 20, 5) for a, b in zip(first.tolist(), last.tolist(), strict=True)]
    assert [x for a, b in found for x in range(a, b + 1)] == list(range(381))


def test_sliding_minimum():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 1000, 97).astype(np.uint64)
    for w in (1, 2, 13, 97):
        assert sliding_minimum(x, w).tolist() == [int(x[i : i + w].min()) for i in range(97 - w + 1)]


def test_words_of_other_spaces():
    assert Words().units("a\u00a0b c\u2003d") == ["a\u00a0b".encode(), "c\u2003d".encode()]


def repeated_starts(texts, starts, window):
    seen = {}
    for t, n in zip(texts, starts, strict=True):
        for i in range(n):
            seen[t[i : i + window]] = seen.get(t[i : i + window], 0) + 1
    return [[seen[t[i : i + window]] > 1 for i in range(n)] for t, n in zip(texts, starts, strict=True)]


def related(seed, alphabet, n=30):
    """Texts that share pieces at any place, some with long runs of one letter."""
    rng = random.Random(seed)
    pool = [bytes(rng.choice(alphabet) for _ in range(rng.randrange(20, 200))) for _ in range(6)]
    return [b"".join(rng.choice(pool)[rng.randrange(10) : rng.randrange(15, 200)] + bytes(rng.choice(alphabet) for _ in range(rng.randrange(4))) for _ in range(rng.randrange(2, 7))) for _ in range(n)]


@pytest.mark.parametrize("alphabet", [b"ab", b"a", b"abcdefghijklmnop \x00", bytes(range(256))])
@pytest.mark.parametrize("divisor", [1, 4, 32, 1 << 40])
def test_dictionary_and_parse_make_the_corpus_order(monkeypatch, alphabet, divisor):
    monkeypatch.setattr(prefixfree, "DIVISOR", divisor)
    for seed in range(4):
        texts = [t for t in related(seed, alphabet) if len(t) >= 60]
        for window in (5, 31, 60):
            starts = [len(t) - window + 1 if i % 4 else 1 for i, t in enumerate(texts)]
            got = prefixfree.CorpusOrder(window)(texts, starts)
            assert [g.tolist() for g in got] == repeated_starts(texts, starts, window)


def test_phrases_are_prefix_free():
    parse = prefixfree.Parse([t for t in related(5, b"abcd") if t])
    phrases = {parse.text[a:b].tobytes() for a, b in zip(parse.cut, parse.end, strict=True)}
    rests = sorted({p[2 * i :] for p in phrases for i in range(len(p) // 2) if len(p) // 2 - i > prefixfree.TRIGGER})
    assert len(phrases) < len(parse.cut)
    assert not any(y.startswith(x) for x, y in zip(rests, rests[1:], strict=False))


def test_inner_nodes_are_the_maximal_repeats():
    rng = random.Random(6)
    texts = [[rng.randrange(3) for _ in range(rng.randrange(1, 60))] for _ in range(12)]
    tree = suffixtree.SuffixTree([np.array(t, np.uint64) for t in texts])
    place = {int(o) + i: tuple(t[i:]) for o, t in zip(tree.offset, texts, strict=True) for i in range(len(t) + 1)}
    for depth in (1, 3, 6, 100):
        want = {}
        for at, rest in place.items():
            if len(rest) >= depth:
                want.setdefault(rest[:depth], set()).add(at)
        first, last, words = tree.nodes(depth)
        got = {}
        for a, b, n in zip(first.tolist(), last.tolist(), words.tolist(), strict=True):
            leaves = tree.leaves[a : b + 1].tolist()
            assert n >= depth and len({place[x][:n] for x in leaves}) == 1 and len({place[x][: n + 1] for x in leaves}) > 1
            got[place[leaves[0]][:depth]] = set(leaves)
        assert got == {k: v for k, v in want.items() if len(v) > 1}


def test_a_passage_in_most_rows(spark, monkeypatch):
    """One anchor in many rows, with other words around it each time."""
    monkeypatch.setattr(repeats, "GROUP_ROWS", 8)
    rng = random.Random(7)
    passage = " ".join(f"p{i}" for i in range(16))
    texts = [" ".join(f"q{rng.randrange(10**6)}" for _ in range(rng.randrange(30))) + " " + passage + " " + " ".join(f"q{rng.randrange(3)}" for _ in range(rng.randrange(12))) for _ in range(200)]
    compare(spark, suffixtree.drop_repeats, texts, 12, words, b" ".join, gram=4)
