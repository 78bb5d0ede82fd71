"""Line deduplication by a deletion-neighbourhood join (operator 5).

A line, as its lowered words, goes if an earlier line of the corpus has the same
words but for one edit: a word replaced, left out or put in. Earlier means a smaller
(doc_id, line number). All variants of a line within the bound are emitted as hashed
keys: the line without its i-th word, once with i (two lines that meet there differ
by a replacement) and once without (it meets the line that lacks the word). Equal
variants are joined to the earliest line that has them, so a key's group costs one
pair a line; the pairs' edit distance is verified on the words themselves.

Copies are first counted as one line, with their earliest place. A line within one
edit of another shares the first or the second half of its words with it, so only
lines whose half some other line has emit their variants; none is lost by that.
Keys that matter are broadcast while they are counted to be few; beyond that, Bloom
filters of bounded size thin the rows before the exact joins.

Lines of ``copy_words`` words at least take part. Of two lines with fewer than
``min_words`` words each, the later goes only as an exact copy: an edit is too much of
them. One word less than ``min_words`` can still be an edit of a line that has as many,
so such lines emit their own key and no variants; shorter ones emit nothing.

Defined results: lines without words always stay, as do those of fewer than
``copy_words``, by default ``min_words``; null text has no lines and stays null; a
document all of whose lines go has empty text; an empty table gives an empty table; very
long texts and lines are read whole; rows with equal doc_id and text are one
document, and each keeps what it keeps; null ids come after all others; other columns
pass through, but the outputs' names give way.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threshline.llm.common import broadcast_if, filter_of, materialize

#: Shorter lines have no near copies among themselves: headings, list marks.
MIN_WORDS = 6
BROADCAST_ROWS, BROADCAST_KEYS = 200_000, 1_000_000
CACHE_WORDS = 100_000
#: Variants of lines that are sent on together.
VARIANTS = 1 << 16
_BASE = np.uint64(0x9E3779B97F4A7C15)
_LAST = (1 << 63) - 1


class Coder:
    """Words of lines, their codes, and keys made of the codes."""

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}

    def words(self, line: str) -> list[bytes]:
        return line.encode().lower().split()

    def codes(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        if len(known) > CACHE_WORDS:
            known.clear()
        for w in set(words).difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w)
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def line_id(words: list[bytes]) -> bytes:
    return xxhash.xxh3_128_digest(b" ".join(words))


def half_keys(words: list[bytes], min_words: int = 0) -> list[int]:
    """Keys of the halves that a line within one edit must share one of: both halves of
    n words, and of n + 1, as the other line can have a word more. With a word less than
    ``min_words`` the other has one more, and shorter lines have no other."""
    n, out = len(words), []
    for k in {n // 2, (n + 1) // 2} if n >= min_words else {(n + 1) // 2} if n == min_words - 1 else ():
        for side, part in ((0, words[:k]), (1, words[n - k :])):
            out.append(xxhash.xxh3_64_intdigest(b" ".join(part), seed=2 * k + side) - (1 << 63))
    return out


def variant_keys(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(keys of a replacement at each word, keys without each word, the line's own)."""
    n = len(codes)
    power = np.full(n + 1, 1, np.uint64)
    power[1:] = _BASE
    power = np.multiply.accumulate(power)
    # head[i]: hash of the first i words; tail[i]: of the words from i on, in their final places
    tail = np.concatenate([np.cumsum((codes * power[n - 1 :: -1][:n])[::-1])[::-1], [np.uint64(0)]])
    head = tail[0] - tail  # the first i words, in the places of n words
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    without = head[:n] * inverse + tail[1:]
    place = np.arange(1, n + 1, dtype=np.uint64)
    return _mixed(without, place + np.uint64(n << 32)), _mixed(without, np.uint64(n - 1)), int(_mixed(tail[:1], np.uint64(n))[0])


def _mixed(h: np.ndarray, salt: np.ndarray | np.uint64) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93) + np.atleast_1d(salt) * np.uint64(0xBF58476D1CE4E5B9)
    return (h ^ (h >> np.uint64(29))).view(np.int64)


def within_one_edit(a: list[bytes], b: list[bytes]) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def row_keys(doc_id: str, text: str) -> list[Column]:
    return [F.coalesce(F.col(doc_id).cast("long"), F.lit(_LAST)).alias("_id"), F.xxhash64(text).alias("_hash")]


def repeated_lines(docs: DataFrame, doc_id: str, text: str, min_words: int, copy_words: int) -> DataFrame:
    """(_id, _hash, lines): the numbers of the lines to remove, by document."""
    rows = docs.select(*row_keys(doc_id, text), F.col(text).alias("_text"))
    found = materialize(rows.mapInArrow(_line_rows(min_words, copy_words), "_id long, _hash long, line int, lid binary, halves array<long>"), "lines")
    place = F.struct("_id", "line", "_hash")
    lines = materialize(found.groupBy("lid").agg(F.min(place).alias("first"), F.count("*").alias("copies")), "distinct")

    halves = found.select("lid", F.explode("halves").alias("key"))
    shared = materialize(_of_several(halves), "shared")
    near_half = _joined(found.select("lid", "halves"), shared, _taken_halves, "lid binary, key long", halves).select("lid").distinct()
    chosen = materialize(lines.join(near_half, "lid").select("lid", "first", F.xxhash64("lid").alias("x")), "chosen")
    texts = materialize(_texts(rows, chosen, copy_words), "texts")
    variants = materialize(texts.mapInArrow(_variant_rows(min_words), "key long, own boolean, lid binary, first struct<_id:long,line:int,_hash:long>"), "variants")

    # Most variants are of one line alone; those go before anything but keys is shuffled.
    met = materialize(_of_several(variants), "met")
    keyed = materialize(_joined(variants, met, _taken, variants.schema, variants), "keyed")
    least = keyed.groupBy("key").agg(
        F.min(F.when(F.coalesce("own", F.lit(True)), F.struct("first", "lid"))).alias("of_own"),
        F.min(F.when(~F.coalesce("own", F.lit(False)), F.struct("first", "lid"))).alias("of_cut"),
    )
    # own is null for a replacement's key, where all are alike; else a line meets the other kind.
    meets = F.when(F.col("own"), F.col("of_cut")).when(~F.col("own"), F.col("of_own")).otherwise(F.least("of_own", "of_cut"))
    pairs = keyed.join(least, "key").withColumn("m", meets).filter("m.first < first").select("lid", F.col("m.lid").alias("early")).distinct()
    words = texts.select("lid", "words")
    both = pairs.join(words, "lid").join(words.select(F.col("lid").alias("early"), F.col("words").alias("early_words")), "early")
    near = both.select("lid", "words", "early_words").mapInArrow(_verified(), "lid binary").distinct()

    marked = lines.join(near.withColumn("near", F.lit(True)), "lid", "left").filter("near OR copies > 1").select("lid", "first", "near")
    marked = materialize(marked, "marked")
    some = broadcast_if(marked, marked.count(), BROADCAST_ROWS)
    gone = found.select("_id", "_hash", "line", "lid").join(some, "lid").filter(F.coalesce("near", F.lit(False)) | (place != F.col("first")))
    return gone.groupBy("_id", "_hash").agg(F.collect_set("line").alias("lines"))


def _joined(rows: DataFrame, keys: DataFrame, thin, schema, plain: DataFrame) -> DataFrame:
    """``plain`` joined with the keys: broadcast while they are counted to be few, else
    ``rows`` are thinned by a filter of the keys before they are shuffled."""
    n = keys.count()
    if n <= BROADCAST_KEYS:
        return plain.join(F.broadcast(keys), "key")
    some = rows.sparkSession.sparkContext.broadcast(filter_of(keys, "key", n))
    return rows.mapInArrow(thin(some), schema).join(keys, "key")


def _texts(rows: DataFrame, chosen: DataFrame, least: int) -> DataFrame:
    """(lid, first, words) of the chosen lines. Few are read where they are first; for
    many, all lines are thinned by a filter, as any copy of a line has its words."""
    n = chosen.count()
    if n <= BROADCAST_ROWS:
        wanted = chosen.select("first._id", "first._hash", F.struct("first", "lid").alias("w")).groupBy("_id", "_hash").agg(F.collect_list("w").alias("wanted"))
        here = rows.join(F.broadcast(wanted), ["_id", "_hash"]).select("_text", "wanted")
        found = here.mapInArrow(_wanted_lines(), "lid binary, first struct<_id:long,line:int,_hash:long>, words binary")
        return found.dropDuplicates(["lid"])
    some = rows.sparkSession.sparkContext.broadcast(filter_of(chosen, "x", n))
    copies = rows.select("_text").mapInArrow(_taken_lines(some, least), "lid binary, words binary")
    return copies.join(chosen, "lid").groupBy("lid").agg(F.first("first").alias("first"), F.first("words").alias("words"))


def _of_several(keyed: DataFrame) -> DataFrame:
    """The keys that more than one line has."""
    ids = keyed.select("key", F.xxhash64("lid").alias("x"))
    return ids.groupBy("key").agg(F.min("x").alias("a"), F.max("x").alias("b")).filter("a <> b").select("key")


def _line_rows(min_words: int, copy_words: int):
    least = max(1, copy_words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder()
        for batch in batches:
            owner, number, lids, halves = [], [], [], []
            for i, t in enumerate(batch.column(2)):
                for j, line in enumerate((t.as_py() or "").split("\n")):
                    words = coder.words(line)
                    if len(words) >= least:
                        owner.append(i), number.append(j), lids.append(line_id(words)), halves.append(half_keys(words, min_words))
            at = pa.array(owner, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(number, pa.int32()), pa.array(lids, pa.binary()), pa.array(halves, pa.list_(pa.int64()))], names=["_id", "_hash", "line", "lid", "halves"])

    return run


def _taken_halves(some):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            keys = lists.flatten()
            owner = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy())
            keep = some.value.takes(keys.to_numpy())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(owner[keep])), keys.filter(pa.array(keep))], names=["lid", "key"])

    return run


def _wanted_lines():
    place = pa.struct([("_id", pa.int64()), ("line", pa.int32()), ("_hash", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder()
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                lines = row["_text"].split("\n")
                out += [(w["lid"], w["first"], b" ".join(coder.words(lines[w["first"]["line"]]))) for w in row["wanted"]]
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], kind) for i, kind in enumerate((pa.binary(), place, pa.binary()))], names=["lid", "first", "words"])

    return run


def _taken_lines(some, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder()
        for batch in batches:
            found = {}
            for t in batch.column(0):
                for line in (t.as_py() or "").split("\n"):
                    words = coder.words(line)
                    if len(words) >= least:
                        text = b" ".join(words)
                        found[xxhash.xxh3_128_digest(text)] = text
            lids = list(found)
            # as Spark's xxhash64 of the id has it
            keep = some.value.takes(np.array([xxhash.xxh64_intdigest(x, seed=42) for x in lids], np.uint64).view(np.int64))
            lids = [x for x, k in zip(lids, keep.tolist(), strict=True) if k]
            yield pa.RecordBatch.from_pydict({"lid": pa.array(lids, pa.binary()), "words": pa.array([found[x] for x in lids], pa.binary())})

    return run


def _taken(some):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(some.value.takes(batch.column(0).to_numpy())))

    return run


def _variant_rows(min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder()
        for batch in batches:
            keys, own, owner, held = [], [], [], 0
            for i, words in enumerate(batch.column(2).to_pylist()):
                replaced, cut, whole = variant_keys(coder.codes(words.split()))
                if len(replaced) < min_words:
                    replaced, cut = replaced[:0], cut[:0]
                n = len(replaced)
                keys += [replaced, cut, [whole]]
                own += [np.zeros(n, np.int8), np.ones(n, np.int8), [2]]
                owner.append(np.full(2 * n + 1, i))
                held += 2 * n + 1
                if held >= VARIANTS or i == batch.num_rows - 1:
                    kind = np.concatenate(own)
                    at = pa.array(np.concatenate(owner))
                    columns = [pa.array(np.concatenate(keys)), pa.array(kind == 2, mask=kind == 0), batch.column(0).take(at), batch.column(1).take(at)]
                    yield pa.RecordBatch.from_arrays(columns, names=["key", "own", "lid", "first"])
                    keys, own, owner, held = [], [], [], 0

    return run


def _verified():
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            close = [within_one_edit(a.split(), b.split()) for a, b in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            yield batch.select([0]).filter(pa.array(close, pa.bool_()))

    return run


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS, counts: tuple[str, str] = ("n_lines", "n_lines_removed"), copy_words: int | None = None) -> DataFrame:
    """``docs`` with ``text`` less its repeated lines, and two ``counts``: of its lines, and
    of those removed. Lines of ``copy_words`` words at least go as exact copies, or if one of
    the two has ``min_words`` at least, as near ones."""
    docs = docs.drop(*counts)
    gone = materialize(repeated_lines(docs, doc_id, text, min_words, min_words if copy_words is None else copy_words), "gone")
    removed = gone.agg(F.coalesce(F.sum(F.size("lines")), F.lit(0))).first()[0]
    fields = docs.schema.fields
    names = dict(zip(("_id", "_hash", "lines"), (f"__line_{x}" for x in ("id", "hash", "numbers")), strict=True))
    own = [k.alias(n) for k, n in zip(row_keys(doc_id, text), names.values(), strict=False)]
    keyed = docs.select(*[F.col(f"`{f.name}`") for f in fields], *own)
    some = broadcast_if(gone.withColumnsRenamed(names), removed, BROADCAST_KEYS)
    joined = keyed.join(some, [names["_id"], names["_hash"]], "left").select(*[F.col(f"`{f.name}`") for f in fields], names["lines"])
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, total, removed = [], [], []
            for t, lines in zip(batch.column(at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist(), strict=True):
                parts, out = [] if t is None else t.split("\n"), set(lines or ())
                texts.append(t if not out else "\n".join([x for i, x in enumerate(parts) if i not in out]))
                total.append(len(parts)), removed.append(len(out))
            columns = [*batch.columns[:-1], pa.array(total, pa.int64()), pa.array(removed, pa.int64())]
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-1], *counts])

    return joined.mapInArrow(run, T.StructType([*fields, *[T.StructField(c, T.LongType()) for c in counts]]))
