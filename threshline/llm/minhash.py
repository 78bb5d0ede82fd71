"""Near duplicates by b-bit MinHash (operator 3).

A document's set is its distinct k-word shingles. ``BANDS`` x ``ROWS`` minima are taken
over it; each band of minima is a candidate key, and of every minimum only the
lowest ``BITS`` bits are retained and packed into bit planes. Candidates of a band
are first compared by their bit planes: equal bits are counted and corrected for
the collisions that so few bits have by chance. What is not clearly below the
threshold is confirmed on the full sets, which are made from the texts anew.

Equal sets are one class, represented by its smallest doc_id, so copies are never
paired. In a band's bucket every class is first paired with the smallest one (a
star), then with its middle one; classes of one component need no further pair. Only where a bucket still holds several components, the members outside its
largest one are compared with all, chunk against chunk: first their bits, then the full sets
of those that may be linked, which gives no pairs but the links that join components. A
bucket is never gathered: chunks have a bounded number of members and of shingles. A link at
the threshold is in no common band with probability below 1e-9 for 80 percent and above.

Defined results: null or blank text has an empty set and is linked with nothing;
rows with equal doc_id are one document, whose texts count as linked; rows with
null doc_id are kept and linked with nothing; an empty table gives an empty table; very
long texts are compared whole; only the id and the text are read, so other columns,
whatever their names, don't matter.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threshline.llm.common import broadcast_if, materialize
from threshline.llm.components import components

BANDS, ROWS, BITS = 40, 4, 2
#: Estimates this far below the threshold are refuted (seven standard deviations).
MARGIN = 0.24
#: Members confirmed against one copy of a leader's text.
MEMBERS = 64
#: Members of a bucket, and their shingles, that are compared with as many others in memory; a
#: larger bucket is compared chunk against chunk.
CHUNK, CHUNK_SHINGLES = 512, 1_000_000
#: Ids of classes whose first document has another text, too, begin here.
SPARE = 1 << 62
BROADCAST_ROWS = 500_000
CACHE_WORDS = 100_000
_SEEDS = np.random.default_rng(20240229)
_A = (_SEEDS.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint64) | 1).astype(np.uint32)[:, None]
_C = _SEEDS.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint64).astype(np.uint32)[:, None]
_M = np.uint64(0x9E3779B97F4A7C15)


class Shingler:
    """Texts to sorted, distinct 64-bit shingle hashes."""

    def __init__(self, k: int):
        self.k = k
        self.known: dict[bytes, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").encode().lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        known = self.known
        if len(known) > CACHE_WORDS:
            known.clear()
        for w in set(words).difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w)
        h = np.array([known[w] for w in words], np.uint64)
        k = min(self.k, len(h))
        out = np.full(len(h) - k + 1, k, np.uint64)
        for j in range(k):
            out = (out + h[j : len(h) - k + 1 + j]) * _M
            out ^= out >> np.uint64(29)
        return np.unique(out)


def minima(shingles: np.ndarray) -> np.ndarray:
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(len(_A), 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 2048):
        np.minimum(out, (_A * x[i : i + 2048] + _C).min(axis=1), out=out)
    return out


def bands(low: np.ndarray) -> np.ndarray:
    m = low.reshape(BANDS, ROWS).astype(np.uint64)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for j in range(ROWS):
        key = (key + m[:, j]) * _M
        key ^= key >> np.uint64(31)
    return key.view(np.int64)


def planes(low: np.ndarray) -> bytes:
    """The lowest bits of the (mixed) minima: plane by plane, eight minima a byte."""
    mixed = low * np.uint32(0x85EBCA6B)
    mixed ^= mixed >> np.uint32(15)
    return b"".join(np.packbits((mixed >> np.uint32(b)) & np.uint32(1)).tobytes() for b in range(BITS))


def estimate(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Similarity from (.., bytes) planes; 2**-BITS of the others match by chance."""
    differ = x ^ y
    step = BANDS * ROWS // 8
    any_ = differ[..., :step]
    for b in range(1, BITS):
        any_ = any_ | differ[..., b * step : (b + 1) * step]
    same = 1 - np.bitwise_count(any_).sum(axis=-1) / (BANDS * ROWS)
    chance = 2.0**-BITS
    return (same - chance) / (1 - chance)


def signatures(docs: DataFrame, k: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text_hash, n_shingles, print, bands, planes); null print for empty sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(k)
        for batch in batches:
            n, prints, keys, packed = [], [], [], []
            for t in batch.column(2):
                s = shingle(t.as_py())
                n.append(len(s))
                low = minima(s) if len(s) else None
                prints.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                keys.append(bands(low) if len(s) else None)
                packed.append(planes(low) if len(s) else None)
            made = [pa.array(n, pa.int64()), pa.array(prints, pa.binary()), pa.array(keys, pa.list_(pa.int64())), pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *made], names=["doc_id", "text_hash", "n_shingles", "print", "bands", "planes"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, text_hash long, n_shingles long, print binary, bands array<long>, planes binary")


def confirm(pairs: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets' similarity is ``percent`` or more.

    ``docs``: (node, text), one row a node. A leader's text goes once to every
    ``MEMBERS`` members, so neither a group nor a text is gathered whole.
    """
    sizes = pairs.groupBy("a").agg(F.count("*").alias("size"))
    salted = pairs.join(sizes, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.ceil(F.col("size") / MEMBERS)).alias("salt"))
    salted = materialize(salted, "pairs")
    leaders = salted.select("a", "salt").distinct().join(docs, F.col("a") == F.col("node")).select("a", "salt", F.lit(None).cast("long").alias("b"), "text")
    members = salted.join(docs, F.col("b") == F.col("node")).select("a", "salt", "b", "text")
    stream = leaders.unionByName(members).repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle, own = Shingler(k), np.zeros(0, np.uint64)
        for batch in batches:
            out_a, out_b = [], []
            for a, b, t in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3), strict=True):
                s = shingle(t.as_py())
                if b is None:  # the group's leader comes first
                    own = s
                    continue
                both = len(np.intersect1d(own, s, assume_unique=True))
                if 100 * both >= percent * (len(own) + len(s) - both):
                    out_a.append(a), out_b.append(b)
            yield pa.RecordBatch.from_pydict({"a": pa.array(out_a, pa.int64()), "b": pa.array(out_b, pa.int64())})

    return stream.mapInArrow(run, "a long, b long")


def likely(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs that their bit planes don't refute."""
    side = classes.select("node", "planes")
    joined = pairs.join(side.select(F.col("node").alias("a"), F.col("planes").alias("x")), "a").join(side.select(F.col("node").alias("b"), F.col("planes").alias("y")), "b")
    return joined.select("a", "b", "x", "y").mapInArrow(_unrefuted(percent), "a long, b long")


def _unrefuted(percent: int):
    """From (a, b, planes of a, planes of b) the pairs that may be similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (_matrix(batch.column(i)) for i in (2, 3))
                batch = batch.filter(pa.array(estimate(x, y) >= percent / 100 - MARGIN))
            yield batch.select([0, 1])

    return run


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)


def _chunks(members: str, weight: str) -> Column:
    """How many chunks so many members with so many shingles make."""
    return F.greatest(F.lit(1), F.ceil(F.col(members) / CHUNK), F.ceil(F.col(weight) / CHUNK_SHINGLES)).cast("long")


def medoids(opened: DataFrame, stats: DataFrame, sides: DataFrame, percent: int) -> DataFrame:
    """Likely pairs of the middle member of each bucket and its members of other components:
    the middle is the member nearest to the bits that most members have. Bits are counted
    chunk by chunk, so a bucket is never gathered."""
    rows = materialize(opened.join(sides.select("node", "planes"), "node"), "planes")
    chunk = F.pmod(F.xxhash64("node"), _chunks("n", "weight"))
    dealt = _with(rows, stats, "key").select("key", chunk.alias("chunk"), "node", "planes")

    def count(key: tuple, members: list[tuple]) -> list[tuple]:
        s = np.frombuffer(b"".join(m[1] for m in members), np.uint8).reshape(len(members), -1)
        return [(key[0], len(members), np.unpackbits(s, axis=1).sum(axis=0, dtype=np.int64).tobytes())]

    def add(parts: pa.Table) -> pa.Table:
        n = sum(parts["n"].to_pylist())
        bits = sum(np.frombuffer(x, np.int64) for x in parts["bits"].to_pylist())
        return pa.table({"key": parts["key"].slice(0, 1), "common": pa.array([np.packbits(2 * bits >= n).tobytes()], pa.binary())})

    counted = _per_group(dealt, 2, count, "key long, n long, bits binary")
    common = materialize(counted.groupBy("key").applyInArrow(add, "key long, common binary"), "common")  # a row per bucket

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                like = estimate(_matrix(batch.column("planes")), _matrix(batch.column("common")))
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("key", "node", "root", "planes")), pa.array(like)], names=["key", "node", "root", "planes", "like"])

    judged = _with(rows, common, "key").mapInArrow(near, "key long, node long, root long, planes binary, like double")
    middle = judged.groupBy("key").agg(F.max_by(F.struct(F.col("node").alias("m"), F.col("root").alias("m_root"), F.col("planes").alias("x")), F.struct("like", -F.col("node"))).alias("middle"))
    middle = materialize(middle.select("key", "middle.*"), "middle")
    pairs = _with(rows, middle, "key").filter("root <> m_root").select(F.least("m", "node").alias("a"), F.greatest("m", "node").alias("b"), "x", F.col("planes").alias("y"))
    return pairs.mapInArrow(_unrefuted(percent), "a long, b long").distinct()


def units(opened: DataFrame, stats: DataFrame, sides: DataFrame, percent: int) -> DataFrame:
    """(unit, node): members to compare in full, by pairs of chunks of a bucket.

    A chunk of members outside the bucket's largest component meets a chunk of all members.
    Only members with a likely partner in another component come, and a pair's partners
    come for the first band that they share, not for each.
    """

    def wanted(key: tuple, rows: list[tuple]) -> list[tuple[int, int]]:
        left, nodes, roots, sigs, keys = zip(*rows, strict=True)
        left, r = np.array(left), np.array(roots)
        s = np.frombuffer(b"".join(sigs), np.uint8).reshape(len(r), -1)
        k = np.frombuffer(b"".join(keys), np.uint32).reshape(len(r), -1)
        here = int(np.flatnonzero((k == k[0]).all(axis=0))[0])
        i, j = np.flatnonzero(left), np.flatnonzero(~left)
        used: set[int] = set()
        for at in range(0, len(i), 64):
            part = i[at : at + 64]
            near = estimate(s[part, None], s[None, j]) >= percent / 100 - MARGIN
            x, y = np.nonzero(near & (r[part, None] != r[None, j]))
            x, y = part[x], j[y]
            first = ~(k[x, :here] == k[y, :here]).any(axis=1)
            used.update(x[first].tolist(), y[first].tolist())
        unit = xxhash.xxh3_64_intdigest(repr(key)) - (1 << 63)
        return [(unit, n) for n in {nodes[x] for x in used}]

    placed = _with(opened, stats, "key").withColumn("minor", F.col("root") != F.col("largest"))
    a, b = _chunks("n_minor", "weight_minor"), _chunks("n", "weight")
    own = lambda salt, n: F.pmod(F.xxhash64(F.lit(salt), F.col("node")), n)
    left = placed.filter("minor").select("key", own(1, a).alias("a"), F.explode(F.sequence(F.lit(0), b - 1)).alias("b"), F.lit(True).alias("left"), "node", "root")
    right = placed.select("key", F.explode(F.sequence(F.lit(0), a - 1)).alias("a"), own(2, b).alias("b"), F.lit(False).alias("left"), "node", "root")
    members = left.unionByName(right).join(sides.select("node", "planes", "short"), "node")
    return _per_group(members.select("key", "a", "b", "left", "node", "root", "planes", "short"), 3, wanted, "unit long, node long")


def _per_group(members: DataFrame, n_keys: int, found: Callable[[tuple, list[tuple]], list[tuple]], schema: str) -> DataFrame:
    """Run ``found`` on each group by the first ``n_keys`` columns. What a group holds in
    memory is signatures, not texts."""
    kinds = {"long": pa.int64(), "binary": pa.binary()}
    fields = pa.schema([(x.split()[0], kinds[x.split()[1]]) for x in schema.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def done() -> pa.RecordBatch:
            out = found(key, held)
            return pa.RecordBatch.from_pydict({f.name: pa.array([o[i] for o in out], f.type) for i, f in enumerate(fields)})

        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns)), strict=True):
                if row[:n_keys] != key:
                    if held:
                        yield done()
                    key, held = row[:n_keys], []
                held.append(row[n_keys:])
        if held:
            yield done()

    keys = members.columns[:n_keys]
    return members.repartition(*keys).sortWithinPartitions(*keys, "node").mapInArrow(run, schema)


def _with(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Rows with a written table's columns: it is broadcast if counted small, else both
    sides are plain shuffles, which Spark splits at a frequent key."""
    return rows.join(broadcast_if(table, table.count(), BROADCAST_ROWS), key)


def shingle_sets(texts: DataFrame, k: int) -> DataFrame:
    """(node, shingles): the full sets as sorted 64-bit hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(k)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([shingle(t.as_py()).tobytes() for t in batch.column(1)], pa.binary())], names=["node", "shingles"])

    return texts.select("node", "text").mapInArrow(run, "node long, shingles binary")


def confirm_units(units: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that join the components of each unit's members, on their full sets.

    ``units``: (unit, node, root, shingles). Shingles that several members have become bits,
    so an intersection is a bit count. A unit gives fewer links than it has members.
    """

    def links(rows: list[tuple[int, int, bytes]]) -> list[tuple[int, int]]:
        sets = [np.frombuffer(x, np.uint64) for _, _, x in rows]
        sizes = np.array([len(x) for x in sets])
        _, at, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        common = df > 1
        bit = np.cumsum(common) - 1
        bits = np.zeros((len(rows), (int(common.sum()) + 7) // 8), np.uint8)
        for i, part in enumerate(np.split(at, np.cumsum(sizes)[:-1])):
            row = np.zeros(bits.shape[1] * 8, np.uint8)
            row[bit[part[common[part]]]] = 1
            bits[i] = np.packbits(row)
        bits = np.pad(bits, ((0, 0), (0, -bits.shape[1] % 8))).view(np.uint64)
        parent = {r: r for _, r, _ in rows}

        def top(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        out = []
        for i in range(1, len(rows)):
            both = np.bitwise_count(bits[i] & bits[:i]).sum(axis=1, dtype=np.int64)
            for j in np.flatnonzero(100 * both >= percent * (sizes[i] + sizes[:i] - both)).tolist():
                x, y = top(rows[i][1]), top(rows[j][1])
                if x != y:
                    parent[x] = y
                    out.append((rows[i][0], rows[j][0]))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, rows = None, []

        def done() -> pa.RecordBatch:
            found = links(rows) if len(rows) > 1 else []
            return pa.RecordBatch.from_pydict({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

        for batch in batches:
            for u, *row in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if u != unit:
                    if rows:
                        yield done()
                    unit, rows = u, []
                rows.append(tuple(row))
        if rows:
            yield done()

    stream = units.select("unit", "node", "root", "shingles").repartition("unit").sortWithinPartitions("unit", "node")
    return stream.mapInArrow(run, "a long, b long")


def _open(members: DataFrame, roots: DataFrame, sizes: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """(key, node, root) of the buckets that hold several components, a row for each such
    bucket (key, n, weight, largest, n_minor, weight_minor), and their number.

    ``sizes``: (node, n_shingles).
    """
    placed = members.join(roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
    several = placed.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y")).filter("x <> y").select("key")
    opened = materialize(_with(placed, materialize(several, "several"), "key"), "opened")
    parts = opened.join(sizes, "node").groupBy("key", "root").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("weight"))
    stats = parts.groupBy("key").agg(
        F.sum("n").alias("n"), F.sum("weight").alias("weight"), F.max_by(F.struct("root", "n", "weight"), F.struct("n", -F.col("root"))).alias("most")
    )
    stats = stats.select("key", "n", "weight", F.col("most.root").alias("largest"), (F.col("n") - F.col("most.n")).alias("n_minor"), (F.col("weight") - F.col("most.weight")).alias("weight_minor"))
    stats = materialize(stats, "buckets_open")
    return opened, stats, stats.count()


def _links_of(roots: DataFrame) -> DataFrame:
    return roots.select(F.col("node").alias("a"), F.col("root").alias("b"))


def _short_keys(bands: str):
    """The low 32 bits of all band keys, packed: enough to find two rows' first common band."""
    return F.unhex(F.array_join(F.transform(bands, lambda b: F.lpad(F.hex(b.bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0")), ""))


def _classes(full: DataFrame) -> DataFrame:
    """A row per distinct set: print, doc_id (the smallest), text_hash, n_shingles, bands,
    planes, and node, the number that stands for it.

    The node is the doc_id; where a document with several texts is the first of several
    sets, those but one get numbers of their own, larger than any id.
    """
    classes = full.groupBy("print").agg(
        F.min(F.struct("doc_id", "text_hash")).alias("first"), F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"), F.first("planes").alias("planes")
    )
    classes = materialize(classes.select("print", "first.*", "n_shingles", "bands", "planes"), "classes")
    shared = classes.groupBy("doc_id").agg(F.count("*").alias("n"), F.min("print").alias("sole")).filter("n > 1").select("doc_id", "sole")
    shared = materialize(shared, "shared_ids")
    n = shared.count()
    if not n:
        return classes.withColumn("node", F.col("doc_id"))
    spare = F.lit(SPARE) + F.pmod(F.xxhash64("print"), F.lit(SPARE))
    marked = classes.join(broadcast_if(shared, n, BROADCAST_ROWS), "doc_id", "left")
    return marked.withColumn("node", F.when(F.coalesce(F.col("sole") != F.col("print"), F.lit(False)), spare).otherwise(F.col("doc_id"))).drop("sole")


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, text_hash, n_shingles, component_id, kept."""
    sets = materialize(signatures(docs, k, doc_id, text), "sets")
    full = sets.filter("print IS NOT NULL AND doc_id IS NOT NULL")
    classes = _classes(full)

    keys = classes.select(F.explode("bands").alias("key"), "node")
    shared = keys.groupBy("key").agg(F.min("node").alias("leader"), F.count("*").alias("size")).filter("size > 1")
    buckets = materialize(_with(keys, materialize(shared, "shared"), "key"), "buckets")

    # Classes whose documents share a doc_id are linked without a test.
    several = full.groupBy("doc_id").agg(F.min("print").alias("x"), F.max("print").alias("y")).filter("x <> y").select("doc_id", "x")
    several = materialize(several, "several_texts")
    nodes = classes.select("print", "node")
    same = _with(full.select("doc_id", "print"), several, "doc_id").filter("x <> print").select("x", "print").distinct()
    same = same.join(nodes.select(F.col("print").alias("x"), F.col("node").alias("a")), "x").join(nodes.withColumnRenamed("node", "b"), "print").select("a", "b")

    star = buckets.filter("node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
    star = materialize(likely(star, classes, percent), "star")

    members = star.select(F.col("a").alias("node")).unionByName(star.select(F.col("b").alias("node")))
    rest = buckets.filter("size > 2").select("node")
    wanted = materialize(members.unionByName(rest).distinct().join(classes.select("node", "doc_id", "text_hash"), "node"), "wanted")
    some = broadcast_if(wanted, wanted.count(), BROADCAST_ROWS)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).withColumn("text_hash", F.xxhash64("text"))
    texts = materialize(rows.join(some, ["doc_id", "text_hash"]).dropDuplicates(["node"]).select("node", "text"), "texts")

    links = materialize(confirm(star, texts, k, percent).unionByName(same), "confirmed")
    roots = components(links)
    # Buckets of three and more that still hold several components: first a star around
    # their middle, then the other components against all, chunk by chunk.
    large = materialize(buckets.filter("size > 2").select("key", "node"), "large")
    sizes = classes.select("node", "n_shingles")
    opened, stats, n = _open(large, roots, sizes)
    if n:
        sides = classes.select("node", "planes", _short_keys("bands").alias("short"))
        middle = materialize(medoids(opened, stats, sides, percent).join(star, ["a", "b"], "left_anti"), "medoids")
        roots = components(confirm(middle, texts, k, percent).unionByName(_links_of(roots)))
        opened, stats, n = _open(opened.select("key", "node"), roots, sizes)
    if n:
        compared = materialize(units(opened, stats, sides, percent), "units")
        sets_of = shingle_sets(texts.join(compared.select("node").distinct(), "node", "left_semi"), k)
        whole = compared.join(materialize(sets_of, "full"), "node").join(roots, "node", "left").select("unit", "node", F.coalesce("root", "node").alias("root"), "shingles")
        roots = components(materialize(confirm_units(whole, percent), "more").unionByName(_links_of(roots)))

    placed = classes.select("print", "node").join(roots, "node", "left").select("print", F.coalesce("root", "node").alias("component"))
    out = sets.select("doc_id", "text_hash", "n_shingles", "print").join(placed, "print", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", "text_hash", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))
