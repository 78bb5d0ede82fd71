"""Language identification: multinomial naive Bayes over hashed character n-grams
(operator 2).

Texts are read as code points; every 1-, 2- and 3-gram is hashed into one of
``BUCKETS`` features. Training adds up a dense count matrix per task, and Spark adds
the tasks' matrices, so the model covers all training rows and its size depends
on the buckets and languages alone. The log-probability matrix is broadcast and
batches are scored in numpy.

Defined results: null text, or text without a letter, is ``und`` with score 0.0;
rows with null language are not learned from; a corpus without a training row
makes every prediction ``und`` with 0.0; equal posteriors go to the language
that sorts first; other columns pass through, but columns named like the outputs
give way to them. Very long texts are read whole, chunk by chunk; an empty table gives
an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threshline.llm.common import materialize

BUCKETS = 1 << 15
ORDERS = (1, 2, 3)
#: Pseudo-count of every feature in every language.
SMOOTHING = 0.1
#: More learned languages than this are refused, as the matrix is broadcast.
MAX_LANGUAGES = 512
#: Characters hashed at once, so that very long texts need bounded memory.
CHUNK = 1 << 20
UNDETERMINED = "und"
_LETTER = regex.compile(r"\p{L}")
_FACTORS = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))


def features(text: str) -> Iterator[np.ndarray]:
    """Bucket numbers of all n-grams of a text, chunk by chunk."""
    longest = max(ORDERS)
    for at in range(0, len(text), CHUNK):
        part = text[at : at + CHUNK + longest - 1]
        codes = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)
        fresh = min(CHUNK, len(text) - at)
        h = np.zeros(len(codes), np.uint32)
        for n in range(1, longest + 1):
            if n > 1:
                h = h[:-1]
            h = (h + codes[n - 1 :]) * _FACTORS[n - 1]
            h ^= h >> np.uint32(15)
            if n in ORDERS:
                yield (h[:fresh] >> np.uint32(17)).astype(np.int32)


def fit(docs: DataFrame, training: Column, text: str = "text", lang: str = "lang") -> tuple[list[str], np.ndarray]:
    """(languages, log-probability matrix of buckets x languages) of the training rows.

    The matrix holds one more row, the languages' log priors, at its end.
    """
    rows = docs.filter(training & F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if lang not in seen and len(seen) >= 64:  # bounds the task's memory
                    yield from map(_counts, seen.items())
                    seen = {}
                got = seen.setdefault(lang, np.zeros(BUCKETS + 1, np.int64))
                got[BUCKETS] += 1
                for f in features(text.as_py()):
                    got[:BUCKETS] += np.bincount(f, minlength=BUCKETS)
        yield from map(_counts, seen.items())

    sums = materialize(rows.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")), "langid")
    found = sums.filter(F.col("bucket") == BUCKETS).select("lang").limit(MAX_LANGUAGES + 1).collect()
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages: the model is too large to broadcast")
    langs = sorted(r.lang for r in found)
    counts = np.zeros((BUCKETS + 1, len(langs)), np.float64)
    if langs:
        place = {x: i for i, x in enumerate(langs)}
        cells = sums.toArrow()  # at most BUCKETS x MAX_LANGUAGES cells
        counts[cells["bucket"].to_numpy(), [place[x] for x in cells["lang"].to_pylist()]] = cells["n"].to_numpy()
    model = np.empty_like(counts)
    smooth = counts[:BUCKETS] + SMOOTHING
    model[:BUCKETS] = np.log(smooth) - np.log(smooth.sum(axis=0, keepdims=True))
    model[BUCKETS] = np.log(counts[BUCKETS] / max(1.0, counts[BUCKETS].sum()))
    return langs, model


def _counts(item: tuple[str, np.ndarray]) -> pa.RecordBatch:
    lang, n = item
    at = np.flatnonzero(n)
    return pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(at), pa.string()), "bucket": pa.array(at.astype(np.int32)), "n": pa.array(n[at])})


def predict(docs: DataFrame, langs: list[str], model: np.ndarray, text: str = "text", out: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` with the predicted language and its posterior probability. No shuffle."""
    docs = docs.drop(out, score)
    at = docs.columns.index(text)
    shared = docs.sparkSession.sparkContext.broadcast((langs, model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, model = shared.value
        for batch in batches:
            names, scores = [UNDETERMINED] * batch.num_rows, np.zeros(batch.num_rows)
            for rows, owner, bucket, n in _sparse_rows(batch.column(at) if langs else []):
                # the sparse rows times the matrix: each row's counts weigh its buckets' lines
                joint = np.tile(model[BUCKETS], (len(rows), 1))
                for k in range(len(langs)):
                    joint[:, k] += np.bincount(owner, n * model[bucket, k], minlength=len(rows))
                odds = np.exp(joint - joint.max(axis=1, keepdims=True))
                best = joint.argmax(axis=1)
                scores[rows] = odds[np.arange(len(rows)), best] / odds.sum(axis=1)
                for i, b in zip(rows, best.tolist(), strict=True):
                    names[i] = langs[b]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=[*batch.schema.names, out, score])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(out, T.StringType()), T.StructField(score, T.DoubleType())]))


def _sparse_rows(texts: pa.Array) -> Iterator[tuple[list[int], np.ndarray, np.ndarray, np.ndarray]]:
    """Texts with a letter as sparse count rows, ``CHUNK`` features or a little more at a
    time: (their places, and for each count that isn't zero its row, bucket and value)."""
    rows: list[int] = []
    found: list[np.ndarray] = []
    held = 0

    def made() -> tuple[list[int], np.ndarray, np.ndarray, np.ndarray]:
        cell, n = np.unique(np.concatenate(found), return_counts=True)
        return rows, cell // BUCKETS, cell % BUCKETS, n

    for i, t in enumerate(texts):
        t = t.as_py()
        if t is None or not _LETTER.search(t):
            continue
        if len(t) > CHUNK:  # counted by itself, chunk by chunk
            n = np.zeros(BUCKETS, np.int64)
            for f in features(t):
                n += np.bincount(f, minlength=BUCKETS)
            used = np.flatnonzero(n)
            yield [i], np.zeros(len(used), np.int64), used, n[used]
            continue
        for f in features(t):
            found.append(f + np.int64(len(rows) * BUCKETS))
            held += len(f)
        rows.append(i)
        if held >= CHUNK:
            yield made()
            rows, found, held = [], [], 0
    if rows:
        yield made()
