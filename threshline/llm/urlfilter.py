"""URL rules by a Bloom filter cascade (operator 7).

A url's keys are every (host or parent domain, path prefix) that some rule could
equal: its domain suffixes of as many labels as some rule has, times the lengths of path
prefixes among the rules. Over this complete universe of the corpus's keys the cascade makes Bloom
membership exact: level 1 holds the listed keys, level 2 the keys of the universe
that level 1 takes wrongly, level 3 the listed keys that level 2 takes wrongly, and
so on until a level takes none wrongly. A key is listed if the first level that
refuses it has an even number (or, if none refuses, by the last level's kind).
The verdict is then read off broadcast bits; no join of the pages is needed.

Defined results: a null url, or one without ``://``, has empty host and path, fits
no rule and is allowed; repeated rows each give a row; an empty table gives an
empty table; other columns pass through, but columns named like the outputs give way to
them. Very long urls have no more keys than short ones. The longest rule wins (host and path together; a host cannot fit two
rules of one length); among equal rules of both kinds, block wins.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threshline.llm.common import materialize

#: False positives aimed at, by level: the first level is finer than the others.
RATES = (0.01, 0.3)
#: Bits of one level at most: 32 MB to broadcast. More keys than fit need more
#: levels, not a wrong result, as the next level always holds what one takes wrongly.
MAX_BITS = 1 << 28
MAX_LEVELS = 64


class Bloom:
    """Bits with k positions a key, derived from two halves of a 128-bit hash."""

    def __init__(self, bits: int, hashes: int, words: np.ndarray | None = None):
        self.bits, self.hashes = bits, hashes
        self.words = np.zeros((bits + 63) // 64, np.uint64) if words is None else words

    @classmethod
    def sized(cls, keys: int, rate: float) -> Bloom:
        bits = int(min(MAX_BITS, max(64, -keys * np.log(rate) / np.log(2) ** 2)))
        return cls(bits, max(1, min(16, round(bits / max(1, keys) * np.log(2)))))

    def places(self, hashed: np.ndarray, level: int) -> np.ndarray:
        """(keys, k) bit numbers of (keys, 2) hashes; levels use other positions."""
        a, b = hashed[:, :1], hashed[:, 1:] | np.uint64(1)
        i = np.arange(self.hashes, dtype=np.uint64) + np.uint64(level * 16 + 1)
        x = a + i * b + i * i * i
        x ^= x >> np.uint64(29)
        return x * np.uint64(0xBF58476D1CE4E5B9) % np.uint64(self.bits)

    def holds(self, hashed: np.ndarray, level: int) -> np.ndarray:
        p = self.places(hashed, level)
        return ((self.words[(p >> np.uint64(6)).astype(np.int64)] >> (p & np.uint64(63))) & np.uint64(1)).all(axis=1)


def hash_keys(keys: list[str]) -> np.ndarray:
    raw = b"".join(hashlib.blake2b(k.encode(), digest_size=16).digest() for k in keys)
    return np.frombuffer(raw, np.uint64).reshape(-1, 2)


class Cascade:
    """Levels of Bloom filters, exact over the universe that they were built from."""

    def __init__(self, levels: list[Bloom]):
        self.levels = levels

    def listed(self, keys: list[str]) -> np.ndarray:
        hashed = hash_keys(keys)
        out, open_ = np.zeros(len(keys), bool), np.arange(len(keys))
        for i, level in enumerate(self.levels):
            if not len(open_):
                break
            took = level.holds(hashed[open_], i)
            if i % 2 == 1:  # refused by a level of exceptions: listed
                out[open_[~took]] = True
            open_ = open_[took]
        out[open_] = len(self.levels) % 2 == 1
        return out


def build_cascade(listed: DataFrame, universe: DataFrame) -> Cascade:
    """The cascade of the keys in ``listed`` (column key) over the distinct keys of
    ``universe`` (column key). Bits are set in tasks and OR-ed by Spark; the driver
    gets bits alone, ``MAX_BITS`` a level at most."""
    inside = listed.select("key").distinct()
    outside = materialize(universe.select("key").distinct().join(inside, "key", "left_anti"), "keys")
    levels: list[Bloom] = []
    sides = [inside, outside]
    for i in range(MAX_LEVELS):
        keys = sides[i % 2]
        if levels:
            keys = _taken(keys, levels)
        n = keys.count()
        if not n and levels:
            break
        level = Bloom.sized(n, RATES[min(i, 1)])
        got = _bits(keys, level, i).toArrow()  # a row per word of bits
        level.words[got["word"].to_numpy()] = got["bits"].to_numpy().view(np.uint64)
        levels.append(level)
    else:
        raise ValueError("the cascade does not converge: raise MAX_BITS")
    return Cascade(levels)


def _taken(keys: DataFrame, levels: list[Bloom]) -> DataFrame:
    """The keys that every level but those of their own kind takes: wrong so far."""
    shared = keys.sparkSession.sparkContext.broadcast([(x.bits, x.hashes, x.words) for x in levels])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = [Bloom(*x) for x in shared.value]
        for batch in batches:
            hashed = hash_keys(batch.column(0).to_pylist())
            keep = np.ones(len(hashed), bool)
            for i, level in enumerate(levels):
                keep &= level.holds(hashed, i)
            yield batch.filter(pa.array(keep))

    return keys.mapInArrow(run, "key string")


def _bits(keys: DataFrame, level: Bloom, number: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = np.unique(level.places(hash_keys(batch.column(0).to_pylist()), number))
            word, at = np.unique((p >> np.uint64(6)).astype(np.int64), return_index=True)
            bits = np.bitwise_or.reduceat(np.uint64(1) << (p & np.uint64(63)), at) if len(p) else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_pydict({"word": pa.array(word), "bits": pa.array(bits.view(np.int64))})

    return keys.mapInArrow(run, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits"))


def host_of(url: Column) -> Column:
    """The part after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lowered."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def candidate_keys(host: str, path: str, labels: list[int], lengths: list[int]) -> list[str]:
    """Every key of a url that a rule of so many ``labels`` and path ``lengths`` could
    equal, the longest first."""
    parts = host.rsplit(".", max(labels, default=1))
    n = host.count(".") + 1
    hosts = [".".join(parts[-i:]) if i < n else host for i in labels if i <= n]
    keys = {h + path[:n] for h in hosts for n in lengths if len(path) >= n}
    return sorted(keys, key=lambda k: (-len(k), k))


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], url: str = "url") -> DataFrame:
    """``pages`` with host, path, rule and verdict.

    ``rules``: (kind, host, path); kind is ``allow`` or ``block``. The verdict is
    the longest fitting rule's, else ``allow``: a url with no listed key is in no
    block list. Columns of those four names give way to the new ones.
    """
    spark = pages.sparkSession
    kept = pages.drop("host", "path", "rule", "verdict")
    parts = kept.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    shapes = sorted({h.count(".") + 1 for _, h, _ in rules}), sorted({len(p) for _, _, p in rules})
    universe = parts.select("host", "path").mapInArrow(_key_rows(*shapes), "key string")
    cascades = {}
    for kind in ("block", "allow"):
        listed = spark.createDataFrame([(h + p,) for k, h, p in rules if k == kind], "key string")
        cascades[kind] = build_cascade(listed, universe)
    shared = spark.sparkContext.broadcast({k: [(x.bits, x.hashes, x.words) for x in c.levels] for k, c in cascades.items()})
    at = [parts.columns.index("host"), parts.columns.index("path")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = {k: Cascade([Bloom(*x) for x in c]) for k, c in shared.value.items()}
        for batch in batches:
            keys, owner = [], []
            for i, (h, p) in enumerate(zip(batch.column(at[0]).to_pylist(), batch.column(at[1]).to_pylist(), strict=True)):
                mine = candidate_keys(h, p, *shapes) if h else []
                keys += mine
                owner += [i] * len(mine)
            block, allow = made["block"].listed(keys), made["allow"].listed(keys)
            rule: list[str | None] = [None] * batch.num_rows
            verdict = ["allow"] * batch.num_rows
            for j in np.flatnonzero(block | allow)[::-1]:  # the longest is written last
                rule[owner[j]], verdict[owner[j]] = keys[j], "block" if block[j] else "allow"
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rule, pa.string()), pa.array(verdict, pa.string())], names=[*batch.schema.names, "rule", "verdict"])

    return parts.mapInArrow(run, T.StructType([*parts.schema.fields, T.StructField("rule", T.StringType()), T.StructField("verdict", T.StringType())]))


def _key_rows(labels: list[int], lengths: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys: set[str] = set()
            for h, p in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if h:
                    keys.update(candidate_keys(h, p, labels, lengths))
            yield pa.RecordBatch.from_pydict({"key": pa.array(sorted(keys), pa.string())})

    return run

