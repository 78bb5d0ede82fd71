"""BPE encoding and decoding over a minimal acyclic transducer lexicon (operator 8).

Frequent words, counted over all documents, are compiled with their token ids into
a minimal acyclic automaton whose words share suffixes. The automaton numbers its
words (every edge stores how many words sort before it), and the number points
into one flat table of ids. It is a few flat arrays in one file, which each Python
worker memory-maps. Words that the automaton lacks are merged exactly, by rank.

Defined results: null text encodes as empty text (no ids, empty decoded text);
columns other than the named text column pass through unchanged, but one named like
an output column gives way to it; repeated rows
each give a row; an empty table gives an empty table.
"""

from __future__ import annotations

import json
import mmap
import re
import tempfile
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from threshline.llm.common import materialize

#: A word is compiled into the lexicon if it is one of so many, or more often, in the
#: running words of the corpus. So the lexicon has at most as many words, for any corpus.
LEXICON_ONE_IN = 200_000
#: Words beyond the lexicon's that a worker remembers before it forgets them.
CACHE_WORDS = 200_000
#: What the pre-tokenizer cuts words by, in Latin-1: letters, numbers, white space.
_LATIN = "".join(map(chr, range(256)))
_LETTERS = "".join(c for c in _LATIN if unicodedata.category(c)[0] == "L")
_NUMBERS = "".join(c for c in _LATIN if unicodedata.category(c)[0] == "N")
_SPACES = "\t-\r \x85\xa0"
_SPLIT = re.compile(f"[{_LETTERS}]+|'s|'t|'re|'ve|'m|'ll|'d|[{_NUMBERS}]|[^{_SPACES}{_LETTERS}{_NUMBERS}]+")


def is_latin(text: str) -> bool:
    """Latin-1 is in normal form C and lower-cases character by character."""
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    at, out = 256, [""] * 256
    for b in range(256):
        if b in shown:
            out[b] = chr(b)
        else:
            out[b], at = chr(at), at + 1
    return out


class Merger:
    """Exact BPE of single words by the tokenizer file's merges, and its tokens' strings."""

    def __init__(self, spec: str):
        data = json.loads(spec)
        self.model = Tokenizer.from_str(spec).model
        self.names = {i: s for s, i in data["model"]["vocab"].items()} | {t["id"]: t["content"] for t in data["added_tokens"]}
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.alphabet = byte_alphabet()

    def strings(self) -> np.ndarray:
        """Every token's string, at its id."""
        out = np.full(max(self.names) + 1, "", object)
        for i, name in self.names.items():
            out[i] = name
        return out

    def merge(self, word: str) -> list[int]:
        """Ids of one pre-token."""
        if not (word.isascii() and word.isprintable()):  # those stand for themselves
            alphabet = self.alphabet
            word = "".join([alphabet[b] for b in word.encode()])
        return [t.id for t in self.model.tokenize(word)]


class PreTokenizer:
    """Texts to words, as the tokenizer file asks; special tokens come out as they are."""

    def __init__(self, spec: str, special: dict[str, int]):
        self.library = Tokenizer.from_str(spec)
        self.special = special
        self.marks = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None

    def words(self, text: str) -> list[str]:
        if is_latin(text):
            return _SPLIT.findall(text.lower())
        # Other scripts: normalization and classes by the library's own tables.
        text = self.library.normalizer.normalize_str(text)
        return [text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)]

    def parts(self, text: str) -> Iterator[tuple[int | None, list[str]]]:
        """(id of a special token, []) or (None, words), in the text's order."""
        if self.marks is None or not any(s in text for s in self.special):
            yield None, self.words(text)
            return
        for part in self.marks.split(text):
            if part in self.special:
                yield self.special[part], []
            elif part:
                yield None, self.words(part)


def build_automaton(words: list[bytes]) -> tuple[np.ndarray, ...]:
    """The minimal acyclic automaton of sorted, distinct words, as flat arrays.

    (first edge of each state, whether it accepts, label, target and words before
    of each edge). States whose right languages are equal are one state.
    """
    register: dict[tuple, int] = {}
    done: list[tuple[bool, tuple]] = []
    path: list[list] = [[False, []]]  # unfinished states: accepts, edges
    last = b""

    def settle(down_to: int) -> None:
        while len(path) > down_to + 1:
            accepts, edges = path.pop()
            key = (accepts, tuple(edges))
            if key not in register:
                register[key] = len(done)
                done.append(key)
            path[-1][1][-1] = (path[-1][1][-1][0], register[key])

    for w in words:
        same = 0
        while same < min(len(w), len(last)) and w[same] == last[same]:
            same += 1
        settle(same)
        for b in w[same:]:
            path[-1][1].append((b, -1))
            path.append([False, []])
        path[-1][0] = True
        last = w
    settle(0)
    root = (path[0][0], tuple(path[0][1]))
    done.append(root)
    count = np.zeros(len(done), np.int64)
    first, label, target, before = [0], [], [], []
    for s, (accepts, edges) in enumerate(done):  # targets come before their sources
        n = int(accepts)
        for b, t in edges:
            label.append(b), target.append(t), before.append(n)
            n += count[t]
        count[s] = n
        first.append(len(label))
    accepts = np.array([a for a, _ in done], np.int32)
    return np.array(first, np.int32), accepts, np.array(label, np.int32), np.array(target, np.int32), np.array(before, np.int32)


def compile_lexicon(words: dict[str, list[int]]) -> bytes:
    """One file image: a header of lengths, the automaton, offsets of ids, ids."""
    keys = sorted(w.encode() for w in words)
    arrays = list(build_automaton(keys))
    ids = [words[k.decode()] for k in keys]
    arrays += [np.cumsum([0, *map(len, ids)]).astype(np.int32), np.array([x for row in ids for x in row], np.int32)]
    return np.array([len(a) for a in arrays], np.int32).tobytes() + b"".join(a.astype(np.int32).tobytes() for a in arrays)


class Lexicon:
    """A memory-mapped lexicon; look-ups walk the automaton byte by byte."""

    def __init__(self, image: bytes):
        with tempfile.TemporaryFile() as f:
            f.write(image)
            f.flush()
            self.map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        lengths, at, out = np.frombuffer(self.map, np.int32, 7), 28, []
        for n in lengths:
            out.append(memoryview(self.map)[at : at + 4 * int(n)].cast("i"))
            at += 4 * int(n)
        self.first, self.accepts, self.label, self.target, self.before, self.offset, self.ids = out
        self.root = len(self.accepts) - 1

    def get(self, word: bytes) -> list[int] | None:
        s, n = self.root, 0
        first, label = self.first, self.label
        for b in word:
            lo, hi = first[s], first[s + 1]
            while lo < hi:  # edges are sorted by label
                mid = (lo + hi) >> 1
                if label[mid] < b:
                    lo = mid + 1
                else:
                    hi = mid
            if lo == first[s + 1] or label[lo] != b:
                return None
            n += self.before[lo]
            s = self.target[lo]
        return list(self.ids[self.offset[n] : self.offset[n + 1]]) if self.accepts[s] else None


def count_words(docs: DataFrame, spec, text: str = "text") -> DataFrame:
    """(word, n) over all texts; partial counts leave each task, then Spark adds them."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merger_special = {t["content"]: t["id"] for t in json.loads(spec.value)["added_tokens"]}
        pre, found = PreTokenizer(spec.value, merger_special), Counter()
        for batch in batches:
            for t in batch.column(0):
                for _, words in pre.parts(t.as_py() or ""):
                    found.update(words)
                if len(found) > CACHE_WORDS:
                    yield _counted(found)
                    found = Counter()
        yield _counted(found)

    return docs.select(text).mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _counted(found: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"word": pa.array(list(found.keys()), pa.string()), "n": pa.array(list(found.values()), pa.int64())})


def train_lexicon(docs: DataFrame, tokenizer_path: str, one_in: int = LEXICON_ONE_IN, text: str = "text") -> bytes:
    """The lexicon image of the corpus's frequent words, ``one_in`` of them at most."""
    spec = _spec(tokenizer_path)
    merger = Merger(spec)
    shared = docs.sparkSession.sparkContext.broadcast(spec)
    counts = materialize(count_words(docs, shared, text), "counts")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    frequent = counts.filter(F.col("n") * one_in >= total).select("word").toArrow()
    return compile_lexicon({w: merger.merge(w) for w in frequent["word"].to_pylist()})


def _spec(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def encode(docs: DataFrame, tokenizer_path: str, lexicon: bytes, text: str = "text", ids: str = "ids", keep: list[str] | None = None, decoded: str | None = None) -> DataFrame:
    """The columns ``keep`` (all, unless named) and ``ids`` (array of int) of every row;
    with ``decoded`` also the text that the ids decode to, in the same pass.

    The vocabulary and the lexicon have a bounded size (``LEXICON_ONE_IN``), so they
    are broadcast. No shuffle.
    """
    context = docs.sparkSession.sparkContext
    spec, image = context.broadcast(_spec(tokenizer_path)), context.broadcast(lexicon)
    made = [ids, *([decoded] if decoded else [])]
    carried = [c for c in (docs.columns if keep is None else keep) if c not in made]
    fields = [docs.schema[c] for c in carried]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merger, lex = Merger(spec.value), Lexicon(image.value)
        pre, cache, names = PreTokenizer(spec.value, merger.special), {}, merger.strings()

        frequent: dict[str, tuple[int, ...]] = {}

        def learn(word: str) -> tuple[int, ...]:
            if len(cache) >= CACHE_WORDS + len(frequent):
                cache.clear()
                cache.update(frequent)
            if (known := lex.get(word.encode())) is not None:
                frequent[word] = cache[word] = got = tuple(known)
            else:
                cache[word] = got = tuple(merger.merge(word))
            return got

        for batch in batches:
            flat, ends, texts = [], [0], []
            for t in batch.column(batch.num_columns - 1):
                row: list[int] = []
                for mark, words in pre.parts(t.as_py() or ""):
                    if mark is not None:
                        row.append(mark)
                    for w in words:
                        row += cache.get(w) or learn(w)
                flat.append(np.array(row, np.int32))
                ends.append(ends[-1] + len(row))
                if decoded:
                    texts.append(" ".join(names[flat[-1]].tolist()))
            out = [pa.ListArray.from_arrays(pa.array(np.array(ends, np.int32)), pa.array(np.concatenate([*flat, np.zeros(0, np.int32)])))]
            out += [pa.array(texts, pa.string())] if decoded else []
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *out], names=[*carried, *made])

    kinds = [T.StructField(ids, T.ArrayType(T.IntegerType())), T.StructField(decoded or "", T.StringType())][: len(made)]
    return docs.select(*[F.col(f"`{c}`") for c in carried], F.col(f"`{text}`").alias("_text")).mapInArrow(run, T.StructType([*fields, *kinds]))


def decode(encoded: DataFrame, tokenizer_path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``encoded`` with the text of its ids; token strings are joined by a space, as
    the library does where the tokenizer file names no decoder. Null ids: empty."""
    encoded = encoded.drop(decoded)
    spec = encoded.sparkSession.sparkContext.broadcast(_spec(tokenizer_path))
    at = encoded.columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = Merger(spec.value).strings()
        for batch in batches:
            col = batch.column(at)
            texts = [" ".join(names[row.values.to_numpy()].tolist()) if row.is_valid else "" for row in col]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, decoded])

    return encoded.mapInArrow(run, T.StructType([*encoded.schema.fields, T.StructField(decoded, T.StringType())]))
