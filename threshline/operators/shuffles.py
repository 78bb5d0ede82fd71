"""How alike several shuffles of a table are, without writing out the shuffles.

``reports.epoch_uniqueness`` takes every epoch's batches as a table and joins all pairs of
neighbours. For shuffles by a hash this is some hundred times the table, to find the few
pairs that meet again. Here each id's places in all shuffles are kept as the first four
bytes of its rows' hashes. Where a shuffle's batches begin is known after one sort of
those; it tells each row's *group*, some consecutive batches. Two ids can only meet
twice if they share two groups, and these are few. Only rows of such groups are
read again, put into their exact batches and compared by ``epoch_uniqueness``'s pairs;
everything else is counted: a batch has a pair of any two rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from threshline.functions import entries as E
from threshline.operators.reports import neighbours
from threshline.storage import cut_lineage, drop_tables, shuffles_dropped, tables_written

#: Groups of a shuffle, at most, whose first keys are broadcast (8 MB a shuffle).
GROUPS = 1 << 21
#: Shares that keys and cells are dealt in. A cell's place in its share has 32 bits.
PIECE_BITS = 10
PIECES = 1 << PIECE_BITS
#: Rows of an id; beyond, its groups are all compared, and its cells aren't made.
HOT_ROWS = 64
#: Ids to read again by a broadcast filter; for more, all rows are placed.
BROADCAST_IDS = 1_000_000
#: Bytes of a hash that are kept for every row.
WIDTH = 4
#: Ids of a block of the table of keys.
BLOCK_IDS = 50_000


def _coarse(n: int) -> Column:
    """The first bytes of a row's ``n`` hashes."""
    return F.unhex(F.concat(*[F.substring(E.order_key(F.col("_ord"), e), 1, 2 * WIDTH) for e in range(n)]))


def _keyed(rows: DataFrame, n: int) -> DataFrame:
    """id, _ord, _coarse and _rest, a hash of the whole row, which tells equal rows."""
    rest = F.substring(F.lpad(F.hex(F.xxhash64(*rows.columns)), 16, "0"), 1, 2 * WIDTH)
    return rows.filter("id IS NOT NULL").select("id", "_ord", _coarse(n).alias("_coarse"), F.unhex(rest).alias("_rest"))


def _bytes(column: pa.Array, n: int) -> np.ndarray:
    """A row of ``n`` keys for each value of a binary column of fixed length."""
    at = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[at[0] : at[-1]].reshape(-1, WIDTH * n).view(">u4").astype(np.uint32)


def _by_id(keyed: DataFrame, n: int) -> DataFrame:
    """Blocks of ids: a hash of each (``h``), how many distinct rows it has and their keys."""

    def group(batches):
        read = [b for b in batches if b.num_rows]
        if not read:
            return
        table = pa.Table.from_batches(read)
        ids = table["id"].combine_chunks().dictionary_encode()
        key = np.concatenate([_bytes(c, n + 1) for c in table["_k"].chunks])
        number = ids.indices.to_numpy()
        order = np.lexsort([*key.T, number])
        number, key = number[order], key[order]
        new = np.ones(len(key), bool)
        new[1:] = (number[1:] != number[:-1]) | (key[1:] != key[:-1]).any(1)
        number, key, h = number[new], key[new, :n], table["h"].to_numpy()[order][new]
        first = np.flatnonzero(np.diff(number, prepend=-1))
        sizes, h, ends = np.diff(first, append=len(number)).astype(np.int32), h[first].astype(np.int32), np.append(first, len(number))
        for i in range(0, len(first), BLOCK_IDS):
            j = min(i + BLOCK_IDS, len(first))
            yield pa.RecordBatch.from_pydict({"n": pa.array([j - i], pa.int64()), **{c: pa.array([x.tobytes()], pa.binary()) for c, x in (("h", h[i:j]), ("sizes", sizes[i:j]), ("keys", key[ends[i] : ends[j]]))}})

    parts = keyed.select("id", F.hash("id").alias("h"), F.concat("_coarse", "_rest").alias("_k")).repartition("id")
    return cut_lineage(parts.mapInArrow(group, "n long, h binary, sizes binary, keys binary"), "keys")


def _ids(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(hash of the id, its rows, their keys) of a task's ids, if there are any."""
    read = [b for b in batches if b.num_rows]
    if read:
        h, sizes, keys = (np.concatenate([np.frombuffer(x.as_buffer(), kind) for b in read for x in b[c]]) for c, kind in (("h", np.int32), ("sizes", np.int32), ("keys", np.uint32)))
        yield h, sizes, keys.reshape(-1, n)


def _by_size(sizes: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(rows of an id, the ids with so many, their rows' places) for each number of rows."""
    first = np.cumsum(sizes) - sizes
    for k in np.unique(sizes).tolist():
        ids = np.flatnonzero(sizes == k)
        yield k, ids, first[ids][:, None] + np.arange(k)


class Groups:
    """Groups of ``span`` batches of a shuffle: the first key of each by shuffle, and its
    first batch, which all shuffles have in common. Where a group would begin between
    two equal keys, it goes with the one before in every shuffle."""

    def __init__(self, first: list[np.ndarray], batch: np.ndarray):
        self.first, self.batch = first, batch

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(f, keys[:, e], "right") - 1 for e, f in enumerate(self.first)], 1).astype(np.int64)

    def start(self, piece: int) -> int:
        """The first group of a share."""
        return -(-piece * len(self.batch) // PIECES)


def _find_groups(spark: SparkSession, by_id: DataFrame, n: int, size: int) -> tuple[Groups, int]:
    """The groups of all shuffles, and the number of rows."""
    low = 32 - PIECE_BITS

    def count(batches):
        for _, _, keys in _ids(batches, n):
            for e in range(n):
                c = np.bincount(keys[:, e] >> low, minlength=PIECES)
                yield pa.RecordBatch.from_pydict({"e": pa.array([e] * PIECES, pa.int32()), "piece": pa.array(range(PIECES), pa.int32()), "n": pa.array(c, pa.int64())})

    starts = np.zeros((n, PIECES), np.int64)
    for r in by_id.mapInArrow(count, "e int, piece int, n long").groupBy("e", "piece").agg(F.sum("n").alias("n")).collect():
        starts[r.e, r.piece] = r["n"]
    rows = int(starts[0].sum())
    starts = np.cumsum(starts, 1) - starts
    span = max(1, -(-rows // (size * GROUPS)))
    step = size * span

    def cut(batches):
        for _, _, keys in _ids(batches, n):
            for e in range(n):
                s = np.sort(keys[:, e])
                at = np.searchsorted(s, np.arange(PIECES + 1, dtype=np.uint64) << low).tolist()
                full = [p for p in range(PIECES) if at[p] < at[p + 1]]
                yield pa.RecordBatch.from_pydict({"e": pa.array([e] * len(full), pa.int32()), "piece": pa.array(full, pa.int32()), "keys": pa.array([s[at[p] : at[p + 1]].tobytes() for p in full], pa.binary())})

    def begin(table: pa.Table) -> pa.Table:
        e, piece = table["e"][0].as_py(), table["piece"][0].as_py()
        s = np.sort(np.concatenate([np.frombuffer(x.as_buffer(), np.uint32) for x in table["keys"]]))
        at = np.arange(-int(starts[e, piece]) % step, len(s), step)
        at = at[(at == 0) | (s[at] != s[at - 1])]
        return pa.table({"e": pa.array([e], pa.int32()), "piece": pa.array([piece], pa.int32()), "place": pa.array([((starts[e, piece] + at) // step).astype(np.int32).tobytes()], pa.binary()), "keys": pa.array([s[at].tobytes()], pa.binary())})

    found = by_id.mapInArrow(cut, "e int, piece int, keys binary").groupBy("e", "piece").applyInArrow(begin, "e int, piece int, place binary, keys binary")
    found, places, firsts = cut_lineage(found, "groups"), [], []
    for e in range(n):  # a shuffle at a time, for the driver's memory
        blobs = sorted(found.filter(F.col("e") == e).collect(), key=lambda r: r.piece)
        places.append(np.frombuffer(b"".join(r.place for r in blobs), np.int32))
        firsts.append(np.frombuffer(b"".join(r["keys"] for r in blobs), np.uint32))
    common = reduce(lambda a, b: np.intersect1d(a, b, assume_unique=True), places)
    first = [f[np.searchsorted(p, common)] for p, f in zip(places, firsts, strict=True)]
    return Groups(first, common.astype(np.int64) * span), rows


def _cells(sizes: np.ndarray, at: np.ndarray, n: int, width: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(shuffle i, j, cells): the pairs of groups of i and j that ids have rows in, once for
    an id; twice what has to be read in any case: the group of an id's two rows, of an id that
    is last in the same group of two shuffles, and of one of very many rows."""
    for k, _, rows in _by_size(sizes):
        g = at[rows]  # ids, rows, shuffles
        if k > HOT_ROWS:
            for e in range(n):
                yield e, e, np.repeat(np.unique(g[:, :, e]) * (width + 1), 2)
        last = g.max(1)
        for i in range(n):
            for j in range(i + 1, n):
                same = np.repeat(last[last[:, i] == last[:, j], i] * (width + 1), 2)
                yield i, i, same
                yield j, j, same
            a = np.sort(g[:, :, i], 1)
            again = np.unique(a[:, 1:][a[:, 1:] == a[:, :-1]])
            yield i, i, np.repeat(again * (width + 1), 2)
            if k > HOT_ROWS:
                continue
            x, y = np.triu_indices(k, 1)
            pairs = [(i, a[:, x] * width + a[:, y])] + [(j, (g[:, :, i, None] * width + g[:, None, :, j]).reshape(len(g), -1)) for j in range(i + 1, n)]
            for j, c in pairs:
                c = np.sort(c, 1)
                new = np.ones(c.shape, bool)
                new[:, 1:] = c[:, 1:] != c[:, :-1]
                yield i, j, c[new]


def _shared(by_id: DataFrame, groups, n: int) -> list[np.ndarray]:
    """By shuffle, whether a group has to be read again."""

    def deal(batches):
        of = groups.value
        width, starts = len(of.batch), np.array([of.start(p) for p in range(PIECES + 1)])
        for _, sizes, keys in _ids(batches, n):
            cells: dict = {}
            for i, j, c in _cells(sizes, of(keys), n, width):
                cells.setdefault((i, j), []).append(c)
            for (i, j), found in cells.items():
                s = np.sort(np.concatenate(found))
                at = np.searchsorted(s, starts * width).tolist()
                full = [p for p in range(PIECES) if at[p] < at[p + 1]]
                blobs = [(s[at[p] : at[p + 1]] - starts[p] * width).astype(np.uint32).tobytes() for p in full]
                yield pa.RecordBatch.from_pydict({"i": pa.array([i] * len(full), pa.int32()), "j": pa.array([j] * len(full), pa.int32()), "piece": pa.array(full, pa.int32()), "cells": pa.array(blobs, pa.binary())})

    def repeated(table: pa.Table) -> pa.Table:
        of = groups.value
        s = np.sort(np.concatenate([np.frombuffer(x.as_buffer(), np.uint32) for x in table["cells"]]))
        twice = s[1:][s[1:] == s[:-1]].astype(np.int64) + of.start(table["piece"][0].as_py()) * len(of.batch)
        blobs = [np.unique(x).tobytes() for x in np.divmod(twice, len(of.batch))]
        return pa.table({"e": pa.array([table[c][0].as_py() for c in "ij"], pa.int32()), "groups": pa.array(blobs, pa.binary())})

    found = by_id.mapInArrow(deal, "i int, j int, piece int, cells binary").groupBy("i", "j", "piece").applyInArrow(repeated, "e int, groups binary")
    wanted = [np.zeros(len(groups.value.batch), bool) for _ in range(n)]
    for r in cut_lineage(found, "shared").filter("length(groups) > 0").toLocalIterator():
        wanted[r.e][np.frombuffer(r.groups, np.int64)] = True
    return wanted


def _touched(by_id: DataFrame, groups, wanted, n: int) -> DataFrame:
    """Hashes of the ids that have rows in wanted groups (i and j are null), and the last row
    in shuffle i, as its keys, of those that are last in the same group of i and j."""

    def find(batches):
        for h, sizes, keys in _ids(batches, n):
            at = groups.value(keys)
            hit = np.any([w[at[:, e]] for e, w in enumerate(wanted.value)], 0)
            hs = np.unique(np.repeat(h, sizes)[hit])
            out = [(hs, [None] * len(hs), [None] * len(hs), [None] * len(hs))]
            for _, ids, rows in _by_size(sizes):
                g = at[rows]
                last = g.max(1)
                for i in range(n):
                    for j in range(i + 1, n):
                        same = np.flatnonzero(last[:, i] == last[:, j])
                        top = keys[rows[same[:, None], g[same, :, i].argmax(1)[:, None]][:, 0]].astype(">u4")
                        out.append((h[ids[same]], [i] * len(same), [j] * len(same), [x.tobytes() for x in top]))
            for a, i, j, c in out:
                yield pa.RecordBatch.from_pydict({"h": pa.array(a, pa.int32()), "i": pa.array(i, pa.int32()), "j": pa.array(j, pa.int32()), "_coarse": pa.array(c, pa.binary())})

    return cut_lineage(by_id.mapInArrow(find, "h int, i int, j int, _coarse binary"), "touched")


def _placed(rows: DataFrame, groups, wanted, n: int, size: int) -> DataFrame:
    """epoch, batch_id, id and _coarse of the rows in wanted groups."""

    def place(batches):
        for b in batches:
            if b.num_rows:
                at = groups.value(_bytes(b["_coarse"], n))
                for e, w in enumerate(wanted.value):
                    hit = np.flatnonzero(w[at[:, e]])
                    part = b.take(pa.array(hit))
                    yield pa.RecordBatch.from_arrays([pa.array([e] * len(hit), pa.int32()), pa.array(groups.value.batch[at[hit, e]], pa.int64()), part["id"], part["_ord"], part["_coarse"]], ["epoch", "_first", "id", "_ord", "_coarse"])

    found = rows.distinct().select("id", "_ord", "_coarse").mapInArrow(place, "epoch int, _first long, id string, _ord string, _coarse binary")
    order = Window.partitionBy("epoch", "_first").orderBy(E.order_key(F.col("_ord"), F.col("epoch")), "_ord")  # rows of a few batches
    batch = F.col("_first") + F.floor((F.row_number().over(order) - 1) / size)
    return cut_lineage(found.select("epoch", batch.alias("batch_id"), "id", "_coarse"), "placed")


def shuffle_uniqueness(rows: DataFrame, n: int, size: int) -> DataFrame:
    """What ``reports.epoch_uniqueness`` says of the distinct ``rows`` with an id, shuffled
    ``n`` times by the hash of ``_ord`` and the epoch's number and cut into batches of ``size``."""
    spark, before = rows.sparkSession, tables_written()
    keyed = _keyed(rows, n)
    with shuffles_dropped(spark):
        by_id = _by_id(keyed, n)
        ids = by_id.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        schema = "same_batch_pct double, shared_pairs_pct double"
        if not ids or n < 2:
            return spark.createDataFrame([(None, None)], schema)
        found, total = _find_groups(spark, by_id, n, size)
        groups = spark.sparkContext.broadcast(found)
        wanted = spark.sparkContext.broadcast(_shared(by_id, groups, n))
        touched = _touched(by_id, groups, wanted, n)
        again = touched.select("h").distinct()
        if (few := again.count()) <= BROADCAST_IDS:
            keyed = _keyed(rows.join(F.broadcast(again), F.hash("id") == F.col("h"), "left_semi") if few else rows.limit(0), n)
        placed = _placed(keyed, groups, wanted, n, size)

        marked = touched.filter("i IS NOT NULL").join(placed.select(F.col("epoch").alias("i"), "_coarse", "id"), ["i", "_coarse"]).select("i", "j", "id").distinct()
        last = placed.groupBy("epoch", "id").agg(F.max("batch_id").alias("batch_id"))
        at = [last.select(F.col("epoch").alias(c), "id", F.col("batch_id").alias(f"b{c}")) for c in "ij"]
        same = {(r.i, r.j): r["count"] for r in marked.join(at[0], ["i", "id"]).join(at[1], ["j", "id"]).filter("bi = bj").groupBy("i", "j").count().collect()}

        pairs = cut_lineage(neighbours(placed), "pairs")
        distinct = {r.epoch: r["count"] for r in pairs.groupBy("epoch").count().collect()}
        in_placed = {r.epoch: r.pairs for r in placed.groupBy("epoch", "batch_id").count().groupBy("epoch").agg(F.sum(F.expr("count * (count - 1) div 2")).alias("pairs")).collect()}
        a, b = (pairs.select(F.col("epoch").alias(c), "p", "q") for c in "ij")
        met = {(r.i, r.j): r["count"] for r in a.join(b, ["p", "q"]).filter("i < j").groupBy("i", "j").count().collect()}
    drop_tables(spark, before, spark.range(0))
    whole, rest = divmod(total, size)
    every = (whole * size * (size - 1) + rest * (rest - 1)) // 2
    n_pairs = [every - in_placed.get(e, 0) + distinct.get(e, 0) for e in range(n)]
    both = [(i, j) for i in range(n) for j in range(i + 1, n)]
    same_pct = sum(100.0 * same.get(x, 0) / ids for x in both) / len(both)
    met_pct = sum(100.0 * met.get(x, 0) / n_pairs[x[0]] if n_pairs[x[0]] else 0.0 for x in both) / len(both)
    return spark.createDataFrame([(same_pct, met_pct)], schema)
