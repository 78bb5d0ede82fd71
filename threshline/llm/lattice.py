"""Subword lattice likelihood (operator 1).

A word is the lattice of all its segmentations into pieces of an existing
vocabulary (single bytes stand in where it has no piece). Piece probabilities weight every
segmentation, and a forward recursion in log space sums over all of them, so the
score is the marginal probability of the text and not that of one best
segmentation. No piece crosses white space, so a document's marginal is the
product of its words' marginals and of the end's probability.

The vocabulary's existing scores give the prior of the piece probabilities; rounds of
expectation maximization over the training words refine it, each distinct word
once, as pieces have to spell the words that training has not seen. A whole word
that it has seen is one more edge of its lattice, weighted by the word's count less a
discount; the pieces' edges share the mass that the discounts leave. Training rows
of different languages have probabilities of their own, and a text's probability
is the mixture of the languages', each by its share of the training rows. The pieces are of fixed number, so they are
collected and broadcast. Word counts grow with the corpus: they stay in Spark, and
every block of documents is joined with its own distinct words only.

Defined results: null or blank text is the end token alone; a null id is never
held out; with no training rows the prior alone scores; rows with equal id are
scored each on its own; an empty table gives an empty table; very long texts are scored
whole, in the block that they are in; input columns pass through, but those named like an
output give way to it. Rows are dealt to blocks by id and text, so only rows that repeat
both (or a text without an id) share a block however many they are.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threshline.llm.common import materialize, text_bytes

#: Text bytes in a block of documents.
BLOCK_BYTES = 32 << 20
#: Up to so many blocks get numbers that Spark deals evenly; more even out by themselves.
NUMBERED = 2_000
#: Rounds of expectation maximization.
ROUNDS = 3
#: Pseudo-counts that the existing scores are worth, against counted pieces.
PRIOR_WEIGHT = 500.0
#: Mass that the single bytes share before training.
BYTE_MASS = 1e-3
#: Classes of training rows with probabilities of their own.
MAX_CLASSES = 16
#: Words taken together, so that many have one length and share a matrix.
WORDS = 65_536
#: Longer words are walked one by one, not in a matrix.
MATRIX_BYTES = 48
_SPACE = "▁".encode()
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_CODES = (np.arange(1, 257, dtype=np.uint64) * np.uint64(0xBF58476D1CE4E5B9)) ^ (np.arange(1, 257, dtype=np.uint64) << np.uint64(23))


def read_vocabulary(path: str) -> tuple[list[bytes], np.ndarray]:
    """(pieces as bytes, log probabilities from their existing scores).

    Scores that are log probabilities are taken as they are; scores of a merge
    vocabulary only rank its pieces, and become Zipf weights of the ranks. The
    last 256 pieces are the single bytes.
    """
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    own = [i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
    scores = np.array([sp.get_score(i) for i in own])
    if np.allclose(scores, np.round(scores)):  # ranks
        scores = -np.log(-scores + scores.max() + 10.0)
    pieces = [sp.id_to_piece(i).encode() for i in own]
    multi = [i for i, p in enumerate(pieces) if len(p) > 1]
    single = {p[0]: scores[i] for i, p in enumerate(pieces) if len(p) == 1}
    pieces, scores = [pieces[i] for i in multi], scores[multi]
    weight = np.exp(scores - scores.max())
    low = np.full(256, math.log(BYTE_MASS / 256 * weight.sum()))
    for b, s in single.items():
        low[b] = np.logaddexp(low[b], s - (scores.max() if len(scores) else 0))
    logp = np.concatenate([np.log(weight), low])
    return pieces + [bytes([b]) for b in range(256)], logp - np.logaddexp.reduce(logp)


class Lattice:
    """Sums over all segmentations of words, many words at a time."""

    def __init__(self, pieces: list[bytes], logp: np.ndarray):
        self.longest = max(map(len, pieces))
        self.table = dict(zip(pieces, range(len(pieces)), strict=True))
        self.heads = {p[:i] for p in pieces for i in range(1, len(p))}
        self.logp = logp
        hashes = np.array([self._hash(p) for p in pieces], np.uint64)
        self.order = np.argsort(hashes)
        self.keys = hashes[self.order]
        self.slots = np.zeros(1 << 20, bool)
        self.slots[(self.keys * _MIX >> np.uint64(44)).astype(np.int64)] = True

    @staticmethod
    def _hash(piece: bytes) -> int:
        h = 0
        for b in piece:
            h = (h * int(_BASE) + int(_CODES[b])) & 0xFFFFFFFFFFFFFFFF
        return h

    def edges(self, words: np.ndarray) -> np.ndarray:
        """For (W, n) bytes: (n, longest, W) piece numbers, -1 for none."""
        w, n = words.shape
        deep = min(n, self.longest)
        prefix = np.zeros((n + 1, w), np.uint64)
        for i in range(n):
            prefix[i + 1] = prefix[i] * _BASE + _CODES[words[:, i]]
        power = np.ones(deep + 1, np.uint64)
        for i in range(deep):
            power[i + 1 :] *= _BASE
        number = np.full((n, deep, w), -1, np.int32)
        for length in range(1, deep + 1):
            h = prefix[length:] - prefix[: n + 1 - length] * power[length]
            at = np.nonzero(self.slots[(h * _MIX >> np.uint64(44)).astype(np.int64)])
            got = h[at]
            k = np.minimum(np.searchsorted(self.keys, got), len(self.keys) - 1)
            number[at[0], length - 1, at[1]] = np.where(self.keys[k] == got, self.order[k], -1)
        return number

    def forward(self, logs: np.ndarray) -> np.ndarray:
        n, deep, w = logs.shape
        a = np.full((n + 1, w), -np.inf)
        a[0] = 0
        for t in range(1, n + 1):
            into = np.stack([a[t - d] + logs[t - d, d - 1] for d in range(1, min(t, deep) + 1)])
            a[t] = _log_sum(into)
        return a

    def backward(self, logs: np.ndarray) -> np.ndarray:
        n, deep, w = logs.shape
        b = np.full((n + 1, w), -np.inf)
        b[n] = 0
        for t in range(n - 1, -1, -1):
            out = np.stack([b[t + d] + logs[t, d - 1] for d in range(1, min(n - t, deep) + 1)])
            b[t] = _log_sum(out)
        return b

    def batches(self, words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray | None]]:
        """(places in ``words``, their (W, n) bytes); None instead for one long word."""
        lengths = np.array([len(x) for x in words])
        order = np.argsort(lengths, kind="stable")
        cuts = np.flatnonzero(np.diff(lengths[order])) + 1
        for group in np.split(order, cuts):
            n = int(lengths[group[0]]) if len(group) else 0
            if n > MATRIX_BYTES:
                yield from ((group[i : i + 1], None) for i in range(len(group)))
                continue
            step = max(1, (1 << 21) // max(1, n * min(n, self.longest)))
            for i in range(0, len(group), step):
                part = group[i : i + step]
                yield part, np.frombuffer(b"".join(words[j] for j in part), np.uint8).reshape(len(part), n)

    def log_marginal(self, words: list[bytes], weights: np.ndarray | None = None) -> np.ndarray:
        """Log marginal probabilities of words (bytes, with their space mark); with
        ``weights``, (classes, pieces) log probabilities, a row for each class."""
        every = self.logp[None] if weights is None else weights
        out = np.zeros((len(every), len(words)))
        for at, matrix in self.batches(words):
            number = None if matrix is None else self.edges(matrix)
            for k, logp in enumerate(every):
                out[k, at] = self._walk(words[at[0]], logp)[0][-1] if number is None else self.forward(_weighted(number, logp))[-1]
        return out[0] if weights is None else out

    def expected(self, words: list[bytes], weight: np.ndarray, logp: np.ndarray | None = None) -> np.ndarray:
        """Expected piece counts, words weighted."""
        logp = self.logp if logp is None else logp
        out = np.zeros(len(logp))
        for at, matrix in self.batches(words):
            if matrix is None:
                a, found = self._walk(words[at[0]], logp)
                b = [-math.inf] * len(a)
                b[-1] = 0.0
                for i, j, k in reversed(found):
                    b[i] = np.logaddexp(b[i], b[j] + logp[k])
                for i, j, k in found:
                    out[k] += weight[at[0]] * math.exp(a[i] + logp[k] + b[j] - a[-1])
                continue
            number = self.edges(matrix)
            logs = _weighted(number, logp)
            a, b = self.forward(logs), self.backward(logs)
            n, deep, _ = logs.shape
            for d in range(1, deep + 1):
                share = np.exp(a[: n + 1 - d] + logs[: n + 1 - d, d - 1] + b[d:] - a[-1]) * weight[at]
                used = number[: n + 1 - d, d - 1] >= 0
                out += np.bincount(number[: n + 1 - d, d - 1][used], share[used], minlength=len(out))
        return out

    def _walk(self, word: bytes, logp: np.ndarray | None = None) -> tuple[list[float], list[tuple[int, int, int]]]:
        n, logp = len(word), self.logp if logp is None else logp
        a, found = [-math.inf] * (n + 1), []
        a[0] = 0.0
        for i in range(n):
            for j in range(i + 1, min(n, i + self.longest) + 1):
                part = word[i:j]
                k = self.table.get(part)
                if k is not None:
                    found.append((i, j, k))
                    x, y = a[j], a[i] + logp[k]
                    a[j] = max(x, y) + math.log1p(math.exp(-abs(x - y))) if x > -math.inf else y
                if part not in self.heads:
                    break
        return a, found


def _weighted(number: np.ndarray, logp: np.ndarray) -> np.ndarray:
    return np.where(number >= 0, logp[number], -np.inf)


def _log_sum(x: np.ndarray) -> np.ndarray:
    top = x.max(axis=0)
    safe = np.where(np.isfinite(top), top, 0)
    with np.errstate(divide="ignore"):
        return np.log(np.exp(x - safe).sum(axis=0)) + safe


def _gathered(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Batches of ``rows`` rows or more, but for the last."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(x.num_rows for x in held) >= rows:
            yield pa.concat_batches(held)
            held = []
    if held:
        yield pa.concat_batches(held)


def tokens(text: str | None) -> list[bytes]:
    """Words of a text, A-Z lowered, cut at ASCII white space."""
    return (text or "").encode().lower().split()


def spread_numbers(n: int, partitions: int) -> list[int]:
    """``n`` block numbers that Spark's hash deals evenly to so many partitions."""
    out: list[int] = []
    full = np.zeros(partitions, np.int64)
    most = -(-n // partitions)
    at = 0
    while len(out) < n:
        tried = np.arange(at, at + 4 * partitions, dtype=np.uint32)
        for number, part in zip(tried.tolist(), (murmur(tried).view(np.int32) % partitions).tolist(), strict=True):
            if len(out) < n and full[part] < most:
                full[part] += 1
                out.append(number)
        at += 4 * partitions
    return out


def murmur(x: np.ndarray) -> np.ndarray:
    """Spark's hash of ints (Murmur3, 32 bits, seed 42)."""
    turn = lambda v, r: (v << np.uint32(r)) | (v >> np.uint32(32 - r))
    h = np.uint32(42) ^ (turn(x.astype(np.uint32) * np.uint32(0xCC9E2D51), 15) * np.uint32(0x1B873593))
    h = (turn(h, 13) * np.uint32(5) + np.uint32(0xE6546B64)) ^ np.uint32(4)
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
        h = (h ^ (h >> np.uint32(shift))) * np.uint32(factor)
    return h ^ (h >> np.uint32(16))


def class_names(docs: DataFrame, column: str) -> list[str]:
    """The commonest values of the training rows, ``MAX_CLASSES`` - 1 at most; equally
    common ones by name. All others, and null, are one more class."""
    rows = docs.filter("__train").filter(F.col(column).isNotNull()).groupBy(F.col(column).cast("string").alias("name"))
    return [r.name for r in rows.count().orderBy(F.desc("count"), "name").limit(MAX_CLASSES - 1).collect()]


def score_corpus(docs: DataFrame, vocabulary: str, training: Column, key: str = "doc_id", text: str = "text", classes: str | None = None, rounds: int = ROUNDS) -> DataFrame:
    """``docs`` with n_tokens, n_known, train_tokens, base_score and score (log10).

    ``training`` marks the rows to learn from; ``key`` only spreads rows over blocks. With
    ``classes``, a column of the training rows (their language), each class has
    probabilities of its own, and a text's is their mixture: what a scored row holds in that
    column is never looked at.
    """
    context = docs.sparkSession.sparkContext
    out = ["n_tokens", "n_known", "train_tokens", "base_score", "score"]
    docs = docs.drop(*out)
    fields = docs.schema.fields
    blocks = max(1, math.ceil(text_bytes(docs, text) / BLOCK_BYTES))
    block = F.pmod(F.xxhash64(key, text), F.lit(blocks)).cast("int")
    if 1 < blocks <= NUMBERED:
        partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        block = F.get(F.array(*map(F.lit, spread_numbers(blocks, partitions))), block)
    docs = docs.withColumns({"__train": F.coalesce(training, F.lit(False)), "__block": block})
    names = class_names(docs, classes) if classes else []
    n_classes = len(names) + 1
    number = F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, names)), F.col(classes).cast("string")), F.lit(0)) - 1, F.lit(len(names))) if names else F.lit(0)
    counted = [f"c{k}" for k in range(n_classes)]
    pieces, prior = read_vocabulary(vocabulary)

    def count(group: pa.Table) -> pa.Table:
        seen = [Counter() for _ in range(n_classes)]
        words: set[bytes] = set()
        for t, train, k in zip(group.column("_text"), group.column("__train").to_pylist(), group.column("_class").to_pylist(), strict=True):
            if train:
                seen[k].update(tokens(t.as_py()))
                seen[k][b""] += 1  # the end
            else:
                words.update(tokens(t.as_py()))
        every = list(words.union(*seen))
        block = np.full(len(every), group.column("__block")[0].as_py(), np.int32)
        return pa.table({"block": pa.array(block), "word": pa.array(every, pa.binary())} | {c: pa.array([n.get(w, 0) for w in every], pa.int64()) for n, c in zip(seen, counted, strict=True)})

    kinds = ", ".join(f"{c} long" for c in counted)
    texts = docs.select("__block", "__train", F.col(text).alias("_text"), number.cast("int").alias("_class"))
    words = materialize(texts.groupBy("__block").applyInArrow(count, f"block int, word binary, {kinds}"), "words")
    vocab = materialize(words.groupBy("word").agg(*[F.sum(c).alias(c) for c in counted]).withColumn("c", reduce(Column.__add__, map(F.col, counted))), "vocab")
    known = vocab.filter("c > 0")
    is_end = F.length("word") == 0
    figures = [x for c in counted for x in (F.sum(c), F.sum(F.when(is_end, F.col(c))), *[F.count_if((F.col(c) == n) & ~is_end) for n in (1, 2)], F.count_if((F.col(c) > 0) & ~is_end))]
    total, distinct, *rest = (x or 0 for x in known.agg(F.sum("c"), F.count("*"), *figures).first())
    per_class = np.array(rest, np.float64).reshape(n_classes, 5)
    used = np.flatnonzero(per_class[:, 1] > 0) if total else np.array([0])
    sums, ends, once, twice, types = per_class[used].T
    end_c = int(ends.sum())
    n_words = np.maximum(1, sums - ends)
    # Absolute discounting, by how many words training has seen once and twice.
    discount = np.clip((once + 1) / (once + 2 * twice + 2), 0.1, 0.95)
    unseen = np.clip(discount * types / n_words, 1e-9, 1)
    # Per token: the end, a whole known word, or pieces.
    p_end = (ends + 1) / (sums + 2)
    share = np.log(np.maximum(ends, 1) / max(1, end_c))

    logp = np.repeat(prior[None], len(used), axis=0)
    for _ in range(rounds if total > end_c else 0):
        shared = context.broadcast((pieces, logp))

        def expect(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            lattice, weights = Lattice(shared.value[0], prior), shared.value[1]
            sums = np.zeros_like(weights)
            for batch in _gathered(batches, WORDS):
                found = [_SPACE + w for w in batch.column(0).to_pylist()]
                for i in range(len(used)):
                    mine = [found[j] for j in np.flatnonzero(batch.column(i + 1).to_numpy())]
                    if mine:
                        sums[i] += lattice.expected(mine, np.ones(len(mine)), weights[i])
            i, at = np.nonzero(sums)
            yield pa.RecordBatch.from_pydict({"class": pa.array(i.astype(np.int32)), "piece": pa.array(at.astype(np.int32)), "n": pa.array(sums[i, at])})

        spelled = known.filter(~is_end).select("word", *[counted[k] for k in used])
        got = spelled.mapInArrow(expect, "class int, piece int, n double").groupBy("class", "piece").agg(F.sum("n").alias("n")).toArrow()
        weight = np.repeat(PRIOR_WEIGHT * np.exp(prior)[None], len(used), axis=0)
        weight[got["class"].to_numpy(), got["piece"].to_numpy()] += got["n"].to_numpy()
        logp = np.log(weight / weight.sum(axis=1, keepdims=True))
    shared = context.broadcast((pieces, logp))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice, weights = Lattice(shared.value[0], prior), shared.value[1]
        for batch in _gathered(batches, WORDS):
            lp = lattice.log_marginal([_SPACE + w for w in batch.column(0).to_pylist()], weights)
            c = np.array([batch.column(i + 2).to_numpy() for i in range(len(used))], np.float64)
            if total > end_c:
                with np.errstate(divide="ignore"):
                    lp = np.logaddexp(np.log(unseen)[:, None] + lp, np.log(np.maximum(c - discount[:, None], 0) / n_words[:, None]))
            lp += np.log(1 - p_end)[:, None]
            packed = np.ascontiguousarray(lp.T, np.float64).tobytes()
            width = 8 * len(used)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([packed[j : j + width] for j in range(0, len(packed), width)], pa.binary())], names=["word", "c", "lp"])

    scored = vocab.filter(~is_end).select("word", "c", *[counted[k] for k in used]).mapInArrow(mark, "word binary, c long, lp binary")
    looked = words.filter(~is_end).select("block", "word").join(scored, "word")
    base_all = math.log10(total + distinct + 1)
    at_text = docs.columns.index(text)

    def score(rows: pa.Table, words: pa.Table) -> pa.Table:
        place = {w: i for i, w in enumerate(words.column("word").to_pylist())}
        c = words.column("c").to_numpy()
        lp = np.frombuffer(b"".join(words.column("lp").to_pylist()), np.float64).reshape(-1, len(used))
        log_c = np.log10(c + 1.0)
        n_tokens, n_known, base, marginal = [], [], [], []
        for t in rows.column(at_text):
            at = np.fromiter(map(place.__getitem__, tokens(t.as_py())), np.int64)
            n_tokens.append(len(at) + 1)
            n_known.append(int((c[at] > 0).sum()) + (end_c > 0))
            base.append(float(log_c[at].sum()) + math.log10(end_c + 1) - (len(at) + 1) * base_all)
            marginal.append(float(np.logaddexp.reduce(share + lp[at].sum(axis=0) + np.log(p_end))) / math.log(10))
        made = [pa.array(n_tokens, pa.int64()), pa.array(n_known, pa.int64()), pa.array([int(total)] * len(base), pa.int64()), pa.array(base, pa.float64()), pa.array(marginal, pa.float64())]
        return pa.Table.from_arrays([*rows.columns[: len(fields)], *made], names=[*[f.name for f in fields], *out])

    schema = T.StructType(fields + [T.StructField(n, T.LongType() if n in out[:3] else T.DoubleType()) for n in out])
    return docs.groupBy("__block").cogroup(looked.groupBy("block")).applyInArrow(score, schema)
