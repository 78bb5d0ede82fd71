import random

from public_tokenizers import path
from tokenizers import Tokenizer

from threshline.llm import bpe

FILE = path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, ids string"


def texts():
    rng = random.Random(2)
    marks = "<|endoftext|>", "<|startoftext|>"
    out = [None, "", " \n\t", "Don't I'LL 's ''s!!s 1234 a1b2", f"a{marks[0]}b {marks[1]}{marks[0]} <|endoftext", "x" * 30_000, "ab cd " * 5000]
    out += ["".join(map(chr, range(0x250))), "Ω ΣΑΣ é \u1e9b\u0323 日本語 12３ 𝔘 \x1c\x1d a\x85b\xa0c \u2028x", "e\u0301 \ud7ff \U0001f600\u200d"]
    out += ["".join(rng.choice("abcdeéß'’!1 \n\u00a0") for _ in range(80)) for _ in range(60)]
    return out


def test_same_as_the_library(spark):
    library = Tokenizer.from_file(FILE)
    rows = [(i, t, "x") for i, t in enumerate(texts())]
    docs = spark.createDataFrame(rows, SCHEMA)
    lexicon = bpe.train_lexicon(docs, FILE, 500)
    got = bpe.decode(bpe.encode(docs, FILE, lexicon), FILE).collect()
    assert len(got) == len(rows)
    for r in got:
        want = library.encode(r.text or "", add_special_tokens=False).ids
        assert r.ids == want, r.doc_id
        assert r.decoded == library.decode(want, skip_special_tokens=False)


def test_lexicon_is_minimal_and_exact():
    merger = bpe.Merger(open(FILE, encoding="utf-8").read())
    words = sorted({a + b + c for a in ("th", "st", "re") for b in ("ing", "ed", "er") for c in ("", "s", "ly")})
    lexicon = bpe.Lexicon(bpe.compile_lexicon({w: merger.merge(w) for w in words}))
    assert all(lexicon.get(w.encode()) == merger.merge(w) for w in words)
    assert all(lexicon.get(w) is None for w in (b"", b"t", b"things_", b"thingsl", b"zz"))
    # heads share their suffixes: far fewer states than letters
    assert len(lexicon.accepts) < 20
    assert bpe.Lexicon(bpe.compile_lexicon({})).get(b"a") is None


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert bpe.decode(bpe.encode(docs, FILE, bpe.train_lexicon(docs, FILE)), FILE).collect() == []


def test_both_ways_in_one_pass(spark):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts())], SCHEMA)
    lexicon = bpe.train_lexicon(docs, FILE)
    once = bpe.encode(docs, FILE, lexicon, keep=["doc_id"], decoded="decoded")
    assert once.columns == ["doc_id", "ids", "decoded"]
    twice = bpe.decode(bpe.encode(docs, FILE, lexicon), FILE).select("doc_id", "ids", "decoded")
    assert sorted(once.collect()) == sorted(twice.collect())
