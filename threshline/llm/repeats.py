"""Finding windows of text that start more than once in a corpus.

What operators 4 and 6 share: content-defined cutting, the spreading of candidate
pieces over memory-sized groups, and the way back to the documents. How the repeats of
a group are found is each operator's own. Units are words or bytes.

Every window of ``length`` units has an anchor: the leftmost smallest rolling hash of its
``gram``-unit strings. Equal windows have equal anchors at equal places, so a window
can only repeat if its anchor's hash does. Neighbouring windows mostly share their
anchor; the run of windows of one anchor is a *phrase* (its windows overlap, so
phrases do too). The steps:

1. count all anchors' hashes; those that occur once can't be in a repeat;
2. cut the phrases of the others, and gather the dictionary of distinct phrases
   with their counts; a phrase that occurs twice repeats as a whole;
3. deal the suffixes (the phrases' windows) out to groups by the string around the anchor
   that all of a group's windows share: at first the anchor itself, and for every group
   of more than ``group_rows`` phrases a longer one, over and over until it fits (or is
   the whole window, whose members are then one window);
4. in every group find the windows that start twice (the operator's own step);
5. carry the repeated starts back to the documents and remove what they cover.

A longer shared string belongs to fewer places of the anchor in the window: windows whose
anchor is ``lo`` to ``hi`` - 1 units from their start share ``length`` - (``hi`` - ``lo``) + 1
units, so each lengthening cuts that range into ``PARTS``. No text is compared outside
its group, and no group is larger than its bound, so a passage in a third of all rows
is no task's burden.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threshline.llm.common import broadcast_if, filter_of, materialize

#: Distinct phrases of a group at most; larger groups get a longer shared string.
GROUP_ROWS = 1_000
#: Ranges that a group's range of anchor places is cut into.
PARTS = 4
#: Rows of one or two longs that are broadcast at most.
BROADCAST_ROWS = 500_000
#: Windows of one text looked at together; bounds memory for very long texts.
CHUNK = 1 << 19
#: Distinct phrases that a task's dictionary holds before it is sent on.
DICTIONARY = 5_000
CACHE_WORDS = 100_000
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xD6E8FEB86659FD93))
_PLACE = np.uint64((1 << 20) - 1)
_BYTE_CODES = np.random.default_rng(7).integers(0, 1 << 63, 256, dtype=np.uint64)


class Words:
    """Units are words: runs of bytes that aren't ASCII white space."""

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}

    def units(self, text: str | None) -> list[bytes]:
        return (text or "").encode().split()

    def codes(self, units: list[bytes]) -> np.ndarray:
        known = self.known
        if len(known) > CACHE_WORDS:
            known.clear()
        for w in set(units).difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w)
        return np.fromiter(map(known.__getitem__, units), np.uint64, len(units))

    def pack(self, units: list[bytes], a: int, b: int) -> bytes:
        return b" ".join(units[a:b])

    def unpack(self, content: bytes) -> list[bytes]:
        return content.split(b" ")

    def keep(self, units: list[bytes], gone: np.ndarray) -> bytes:
        return b" ".join([u for u, g in zip(units, gone.tolist(), strict=True) if not g])


class Bytes:
    """Units are the bytes of the text's UTF-8 form."""

    def units(self, text: str | None) -> bytes:
        return (text or "").encode()

    def codes(self, units: bytes) -> np.ndarray:
        return _BYTE_CODES[np.frombuffer(units, np.uint8)]

    def pack(self, units: bytes, a: int, b: int) -> bytes:
        return units[a:b]

    def unpack(self, content: bytes) -> bytes:
        return content

    def keep(self, units: bytes, gone: np.ndarray) -> bytes:
        return np.frombuffer(units, np.uint8)[~gone].tobytes()


def rolling(codes: np.ndarray, width: int, salt: int = 0) -> np.ndarray:
    """Hashes of every ``width`` consecutive codes, by doubling."""
    h, have = codes * _MIX[salt], 1
    while have < width:
        step = min(have, width - have)
        h = (h[: len(h) - step] * _MIX[1]) ^ (h[step:] + _MIX[2])
        h ^= h >> np.uint64(29)
        h *= _MIX[0]
        have += step
    return h


def sliding_minimum(x: np.ndarray, w: int) -> np.ndarray:
    """The smallest of every ``w`` consecutive values, by blocks of w."""
    n = len(x) - w + 1
    padded = np.full(-(-len(x) // w) * w, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(x)] = x
    blocks = padded.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[w - 1 : w - 1 + n])


def anchors(codes: np.ndarray, length: int, gram: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(hash, first start, last start, anchor's place) of the runs of windows that share an anchor."""
    w = length - gram + 1
    for at in range(0, len(codes) - length + 1, CHUNK):
        part = codes[at : at + CHUNK + length - 1]
        hashes = rolling(part, gram)
        keys = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
        place = (sliding_minimum(keys, w) & _PLACE).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        last = np.concatenate([first[1:], [len(place)]]) - 1
        yield hashes[place[first]].view(np.int64), first + at, last + at, place[first] + at


def row_keys(doc_id: str, text: str) -> list[Column]:
    """What tells a row's text from others'; a null id has a place of its own."""
    return [F.coalesce(F.col(doc_id).cast("long"), F.lit(-(1 << 63))).alias("_id"), F.xxhash64(text).alias("_hash")]


def among(rows: DataFrame, keys: DataFrame, on: list[str], n: int, how: str = "left_semi") -> DataFrame:
    """Rows (not) among ``n`` written keys; a frequent key's rows are no task's burden, as
    the keys are broadcast or both sides are plain shuffles, which Spark splits."""
    return rows.join(broadcast_if(keys, n, BROADCAST_ROWS), on, how)


class Finder:
    """Steps 1 to 5 for one kind of unit and one window length.

    ``mark_groups`` is step 4: it gets (contents, valid starts in each) of whole groups
    and returns one boolean array per content, true for repeated starts. ``batch_units``
    bounds what it gets at once.
    """

    def __init__(self, unit: type, length: int, gram: int, mark_groups: Callable, batch_units: int, group_rows: int | None = None):
        self.unit, self.length, self.gram = unit, length, gram
        self.mark_groups, self.batch_units = mark_groups, batch_units
        self.group_rows = group_rows or GROUP_ROWS

    def repeated(self, docs: DataFrame, doc_id: str, text: str) -> DataFrame:
        """(_id, _hash, spans): the starts that repeat, as a flat array of first, last."""
        rows = docs.select(*row_keys(doc_id, text), F.col(text).alias("_text"))
        marks = materialize(rows.mapInArrow(self._anchor_rows(), "h long, n int, _id long, _hash long"), "anchors")
        often = materialize(marks.groupBy("h").agg(F.sum("n").alias("n")).filter("n > 1").select("h"), "often")
        n_often = often.count()
        if n_often > BROADCAST_ROWS:  # thin what is shuffled; the join that follows decides
            marks = thinned(marks, filter_of(often, "h", n_often))
        mine = among(marks, often, ["h"], n_often).groupBy("_id", "_hash").agg(F.collect_set("h").alias("hs"))
        cut = rows.join(mine, ["_id", "_hash"]).select("_id", "_hash", "_text", "hs")
        phrases = materialize(cut.mapInArrow(self._phrase_rows(), "h long, ph binary, n long, content binary, starts int, p int, _id long, _hash long, at int"), "phrases")

        book = phrases.filter("content IS NOT NULL").groupBy("h", "ph")
        book = book.agg(F.sum("n").alias("n"), F.first("content").alias("content"), F.first("starts").alias("starts"), F.first("p").alias("p"))
        book = materialize(book, "dictionary")
        whole = book.filter("n > 1").select("ph", F.array(F.lit(0), F.col("starts") - 1).alias("spans"))
        several = book.groupBy("h").agg(F.count("*").alias("size"), F.min("n").alias("least")).filter("size > 1 AND least = 1").select("h")
        several = materialize(several, "several")
        level = among(book, several, ["h"], several.count()).select(F.col("h").alias("k1"), F.lit(0).cast("long").alias("k2"), F.lit(0).alias("lo"), F.lit(self.length - self.gram + 1).alias("hi"), "ph", F.lit(0).alias("base"), "p", "content", "starts", "n")
        groups, single = self._groups(materialize(level, "groups"))
        found = materialize(whole.unionByName(self._marked(groups)).unionByName(single), "found")

        placed = phrases.filter("content IS NULL").select("ph", "_id", "_hash", "at").join(found, "ph")
        moved = placed.select("_id", "_hash", F.transform("spans", lambda x: x + F.col("at")).alias("spans"))
        return moved.groupBy("_id", "_hash").agg(F.flatten(F.collect_set("spans")).alias("spans"))

    def _groups(self, level: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(rows of groups that fit, spans of groups of one window): the shared strings
        are lengthened, where a group is too large, until it fits."""
        keys, width = ["k1", "k2"], self.length - self.gram + 1
        fits = None
        single = level.select("ph", F.array("base", "base").alias("spans")).limit(0)
        while True:
            large = materialize(level.groupBy(*keys).count().filter(F.col("count") > self.group_rows).select(*keys), "large")
            n = large.count()
            fit = among(level, large, keys, n, "left_anti") if n else level
            fits = fit if fits is None else fits.unionByName(fit)
            if not n:
                return fits, single
            rest = among(level, large, keys, n)
            if width == 1:  # the whole window is shared: many phrases have it
                return fits, rest.filter("n = 1").select("ph", F.array("base", "base").alias("spans"))
            level = materialize(rest.mapInArrow(self._split_rows(), level.schema), "groups")
            width = -(-width // PARTS)

    def _split_rows(self):
        unit, length = self.unit, self.length

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            kind = unit()
            for batch in batches:
                out: dict[str, list] = {name: [] for name in batch.schema.names}
                for row in zip(*(batch.column(i).to_pylist() for i in range(2, 10)), strict=True):
                    lo, hi, ph, base, p, content, starts, n = row
                    units, step = kind.unpack(content), -(-(hi - lo) // PARTS)
                    for low in range(lo, hi, step):
                        high = min(hi, low + step)
                        first, last = max(0, p - high + 1), min(starts - 1, p - low)
                        if first > last:
                            continue
                        shared = kind.pack(units, p - low, p + length - high + 1)
                        key = xxhash.xxh3_128_digest(shared + low.to_bytes(4, "little") + high.to_bytes(4, "little"))
                        k1, k2 = (int.from_bytes(key[i : i + 8], "little", signed=True) for i in (0, 8))
                        made = (k1, k2, low, high, ph, base + first, p - first, kind.pack(units, first, last + length), last - first + 1, n)
                        for name, x in zip(out, made, strict=True):
                            out[name].append(x)
                yield pa.RecordBatch.from_pydict(out, schema=batch.schema)

        return run

    def _marked(self, groups: DataFrame) -> DataFrame:
        """(ph, spans) of the repeated starts, groups spread by their counted units."""
        units = groups.agg(F.sum(F.col("starts") + self.length)).first()[0] or 0
        tasks = max(4 * groups.sparkSession.sparkContext.defaultParallelism, -(-units // self.batch_units))
        dealt = groups.select("k1", "k2", "ph", "base", "content", "starts", "n").repartition(int(tasks), "k1", "k2").sortWithinPartitions("k1", "k2", "ph")
        return dealt.mapInArrow(self._group_rows(), "ph binary, spans array<int>")

    def remove(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
        """(doc_id, n_units, n_removed, spans as array<struct<first, last>> of removed
        units, kept as binary) for every row of ``docs``."""
        spans = self.repeated(docs, doc_id, text)
        rows = docs.select(*row_keys(doc_id, text), F.col(doc_id).alias("doc_id"), F.col(text).alias("_text"))
        # The joins' keys are never null; rows with equal keys have equal texts.
        joined = rows.join(spans, ["_id", "_hash"], "left").select("doc_id", "_text", "spans")
        kind = dict(docs.dtypes)[doc_id]
        return joined.mapInArrow(self._kept_rows(), f"doc_id {kind}, n_units long, n_removed long, spans array<struct<first:long,last:long>>, kept binary")

    def _anchor_rows(self):
        unit, length, gram = self.unit, self.length, self.gram

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            kind = unit()
            for batch in batches:
                hashes, counts, owner = [], [], []
                for i, t in enumerate(batch.column(2)):
                    found = [h for h, _, _, _ in anchors(kind.codes(kind.units(t.as_py())), length, gram)]
                    if found:  # a text's copies of one anchor are one row
                        h, n = np.unique(np.concatenate(found), return_counts=True)
                        hashes.append(h), counts.append(n.astype(np.int32)), owner.append(np.full(len(h), i))
                if hashes:
                    at = pa.array(np.concatenate(owner))
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(hashes)), pa.array(np.concatenate(counts)), batch.column(0).take(at), batch.column(1).take(at)], names=["h", "n", "_id", "_hash"])

        return run

    def _phrase_rows(self):
        unit, length, gram = self.unit, self.length, self.gram
        names = ["h", "ph", "n", "content", "starts", "p", "_id", "_hash", "at"]

        def entries(book: dict) -> pa.RecordBatch:
            n = len(book)
            none = pa.nulls(n, pa.int64())
            h, count, content, starts, p = zip(*book.values(), strict=True)
            return pa.RecordBatch.from_arrays([pa.array(h, pa.int64()), pa.array(list(book), pa.binary()), pa.array(count, pa.int64()), pa.array(content, pa.binary()), pa.array(starts, pa.int32()), pa.array(p, pa.int32()), none, none, pa.nulls(n, pa.int32())], names=names)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            kind, book = unit(), {}
            for batch in batches:
                hs, phs, owner, ats = [], [], [], []
                for i, (t, wanted) in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
                    units = kind.units(t.as_py())
                    wanted = wanted.values.to_numpy()
                    for found in anchors(kind.codes(units), length, gram):
                        use = np.isin(found[0], wanted)
                        for x, a, b, q in zip(*(f[use].tolist() for f in found), strict=True):
                            content = kind.pack(units, a, b + length)
                            ph = xxhash.xxh3_128_digest(content + x.to_bytes(8, "little", signed=True))
                            if ph in book:
                                book[ph][1] += 1
                            else:
                                book[ph] = [x, 1, content, b - a + 1, q - a]
                                if len(book) >= DICTIONARY:
                                    yield entries(book)
                                    book = {}
                            hs.append(x), phs.append(ph), owner.append(i), ats.append(a)
                if hs:
                    n, at = len(hs), pa.array(owner)
                    yield pa.RecordBatch.from_arrays([pa.array(hs, pa.int64()), pa.array(phs, pa.binary()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int32()), batch.column(0).take(at), batch.column(1).take(at), pa.array(ats, pa.int32())], names=names)
            if book:
                yield entries(book)

        return run

    def _group_rows(self):
        mark, most, length = self.mark_groups, self.batch_units, self.length

        def done(rows: list) -> pa.RecordBatch:
            masks = mark([r[4] for r in rows], [r[5] for r in rows])
            found = [(r[2], (np.array(spans_of(m)) + r[3]).tolist()) for r, m in zip(rows, masks, strict=True) if r[6] == 1 and m.any()]
            return pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.binary()), pa.array([x for _, x in found], pa.list_(pa.int32()))], names=["ph", "spans"])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rows, size = [], 0
            for batch in batches:
                for row in zip(*(batch.column(i).to_pylist() for i in range(7)), strict=True):
                    if size >= most and row[:2] != rows[-1][:2]:
                        yield done(rows)
                        rows, size = [], 0
                    rows.append(row)
                    size += row[5] + length
            if rows:
                yield done(rows)

        return run

    def _kept_rows(self):
        unit, length = self.unit, self.length

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            kind = unit()
            for batch in batches:
                total, removed, spans, kept = [], [], [], []
                for t, starts in zip(batch.column(1), batch.column(2), strict=True):
                    units = kind.units(t.as_py())
                    change = np.zeros(len(units) + 1, np.int64)
                    if starts.is_valid:
                        s = starts.values.to_numpy()
                        np.add.at(change, s[::2], 1)
                        np.add.at(change, s[1::2] + length, -1)
                    gone = np.cumsum(change[:-1]) > 0
                    total.append(len(units)), removed.append(int(gone.sum()))
                    edges = spans_of(gone)
                    spans.append([{"first": a, "last": b} for a, b in zip(edges[::2], edges[1::2], strict=True)])
                    kept.append(kind.keep(units, gone))
                span = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, span), pa.array(kept, pa.binary())], names=["doc_id", "n_units", "n_removed", "spans", "kept"])

        return run


def spans_of(mask: np.ndarray) -> list[int]:
    """first, last of every run of true values, flat."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    edge[1::2] -= 1
    return edge.tolist()


def thinned(rows: DataFrame, keys) -> DataFrame:
    """Rows (h first) whose ``h`` a Bloom filter of keys takes."""
    shared = rows.sparkSession.sparkContext.broadcast(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(shared.value.takes(batch.column(0).to_numpy())))

    return rows.mapInArrow(run, rows.schema)


def doubled(dense: np.ndarray, have: int, end: np.ndarray | int, most: int) -> list[tuple[int, np.ndarray]]:
    """Levels (depth, ranks) of a suffix array by prefix doubling, from dense ranks of ``have``
    units up to ``most``, or until every place is told from all others or compared whole.

    A place's rank is how many places sort before its class. ``end``: where each place's
    string ends; beyond it nothing is compared, and nothing sorts before everything. Only
    places of classes that may still be split are sorted again.
    """
    n = len(dense)
    sizes = np.bincount(dense)
    rank = (np.cumsum(sizes) - sizes)[dense]
    ends = np.broadcast_to(end, n)
    levels = [(have, rank)]
    goes_on = np.bincount(dense, np.arange(n) + have < ends) > 0  # some string of the class
    place = np.flatnonzero(((sizes > 1) & goes_on)[dense])
    while have < most and len(place):
        ahead = place + have
        key = rank[place] * (n + 1) + np.where(ahead < ends[place], rank[np.minimum(ahead, n - 1)] + 1, 0)
        order = np.argsort(key, kind="stable")
        key, here = key[order], place[order]
        old = rank[here]
        new_class, new_group = (np.concatenate([[True], x[1:] != x[:-1]]) for x in (old, key))
        first = np.flatnonzero(new_group)
        group = np.cumsum(new_group) - 1
        class_first = np.flatnonzero(new_class)[np.cumsum(new_class) - 1]
        rank = rank.copy()
        rank[here] = old + first[group] - class_first
        have *= 2
        levels.append((have, rank))
        several = np.diff(np.append(first, len(here))) > 1
        goes_on = np.add.reduceat((here + have < ends[here]).astype(np.int64), first) > 0
        place = np.sort(here[(several & goes_on)[group]])
    return levels


def common(levels: list[tuple[int, np.ndarray]], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Units that the strings at the different places a and b share, from the levels of
    ``doubled`` for single units, if no two places' strings are equal."""
    shared = np.zeros(len(a), np.int64)
    for depth, rank in reversed(levels):
        shared += np.where(rank[a + shared] == rank[b + shared], depth, 0)
    return shared
