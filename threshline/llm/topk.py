"""Exact top-k inner products by no-random-access aggregation (operator 10).

In every block of candidates each dimension is a list sorted by its contribution
to the score: by the component, downwards for a positive weight of the query and
upwards for a negative one. A query reads its lists in step from their best ends, some
entries deeper each time, and never looks a candidate up in a list: what it knows of one
is the sum of the entries that it has met. So a candidate has a lower bound (what was not
met counts as its list's worst) and an upper bound (as the list's frontier), and all that
were not met at all have one upper bound, the frontiers' sum. Reading stops when neither
they nor any but few of those met can come to the k-th best lower bound; the final scores
of those few are then resolved as integers. Blocks that follow start from the k-th best
score that a task has found so far.

Equal vectors of a block are one candidate with their k + 1 smallest ids, so a large
group of copies costs one row. The query set is read in groups of fixed size, each
broadcast to all candidates; no vector is shuffled, only each task's best k.

Defined results: a vector that is null or empty, or holds a null or non-finite component,
takes no part; vectors of another length than the query's aren't its candidates; a
query's own row is every row with its id; rows with a null id take no part; repeated query
rows give one result; ties go to the smaller id; an empty table gives an empty table; other
columns aren't read. Components so large that a score might not fit a long raise an
``OverflowError`` instead of a wrong score.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threshline.llm.common import materialize

#: Candidates of a block, whose lists are sorted together.
BLOCK = 4096
#: Queries broadcast at once.
QUERY_GROUP = 2048
#: Entries that are read of each list at first; each further step reads as many as before, but
#: no more than a share of the list.
STEP, STEPS = 64, 16
#: Components and scores stay below, so that sums of doubles and longs are right.
LARGEST = float(1 << 62)
#: A query stops reading when so many times k candidates are left.
LEFT = 4
SCALE = 1024.0


def to_integers(column: pa.Array, ids: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By vector length: (ids, integer matrix) of the vectors that take part."""
    out: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    whole = column.is_valid().to_numpy(False) & ids.is_valid().to_numpy(False)
    lengths = column.value_lengths().fill_null(0).to_numpy(False)
    flat = column.flatten()
    values = flat.cast(pa.float64()).to_numpy(zero_copy_only=False)  # nulls become NaN
    starts = np.cumsum(lengths) - lengths
    number = ids.fill_null(0).to_numpy(False)
    for n in np.unique(lengths[whole & (lengths > 0)]):
        rows = np.flatnonzero(whole & (lengths == n))
        m = values[starts[rows][:, None] + np.arange(n)]
        fine = np.isfinite(m).all(axis=1)
        scaled = np.floor(SCALE * m[fine])
        if scaled.size and np.abs(scaled).max() >= LARGEST:
            raise OverflowError("a vector's component is too large for integer scores")
        out[int(n)] = (number[rows][fine], scaled.astype(np.int64))
    return out


def distinct_vectors(ids: np.ndarray, x: np.ndarray, keep: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """(distinct rows, the ``keep`` smallest ids of each)."""
    order = np.lexsort((ids, *x.T[::-1]))
    ids, x = ids[order], x[order]
    new = np.flatnonzero(np.concatenate([[True], (x[1:] != x[:-1]).any(axis=1)])) if len(x) else np.zeros(0, int)
    return x[new], [part[:keep] for part in np.split(ids, new[1:])] if len(x) else []


class Lists:
    """A block's candidates, sorted by each dimension: a row per list, ascending."""

    def __init__(self, x: np.ndarray):
        self.size = len(x)
        self.order = np.ascontiguousarray(np.argsort(x, axis=0, kind="stable").T)
        self.values = np.take_along_axis(np.ascontiguousarray(x.T.astype(np.float64)), self.order, axis=1)

    def read(self, q: np.ndarray, k: int, floor: float) -> np.ndarray:
        """The candidates that may be among the query's ``k`` best; ``floor``: a score that
        it has reached k times elsewhere."""
        m, used = self.size, np.flatnonzero(q)
        if m <= k * LEFT or not len(used):
            return np.arange(m)
        weight = q[used].astype(np.float64)
        down = weight > 0  # read from the largest component on
        low, high = self.values[used, 0], self.values[used, -1]
        worst = np.where(down, low, high) * weight
        slack = 1e-9 * float((np.abs(weight) * np.maximum(np.abs(low), np.abs(high))).sum()) + 1e-6
        lower = np.full(m, worst.sum())
        met = np.zeros((len(used), m))
        sides = [(np.flatnonzero(down), True), (np.flatnonzero(~down), False)]
        depth = 0
        while True:
            until = min(m, max(STEP, k, min(2 * depth, depth + m // STEPS)))
            for lists, from_top in sides:
                part = slice(m - until, m - depth) if from_top else slice(depth, until)
                who = self.order[used[lists], part]
                gained = self.values[used[lists], part] * weight[lists, None] - worst[lists, None]
                lower += np.bincount(who.ravel(), gained.ravel(), minlength=m)
                for i, own in zip(lists.tolist(), who, strict=True):
                    met[i][own] = 1.0
            depth = until
            frontier = np.where(down, self.values[used, m - depth], self.values[used, depth - 1]) * weight
            # what a candidate wasn't met in: the frontier in place of the worst; for one that
            # wasn't met at all, this is the frontiers' sum
            upper = lower + (frontier - worst).sum() - (frontier - worst) @ met
            bar = max(floor, np.partition(lower, m - k)[m - k]) - slack
            alive = np.flatnonzero(upper >= bar)
            if len(alive) <= k * LEFT or depth == m:
                return alive


def block_best(ids: np.ndarray, x: np.ndarray, qids: np.ndarray, q: np.ndarray, k: int, best: list[tuple[np.ndarray, np.ndarray]]) -> None:
    """Update each query's best (scores, ids) with a block's candidates."""
    rows, owners = distinct_vectors(ids, x, k + 1)
    if not len(rows):
        return
    if len(q) and float(np.abs(rows).max()) * float(np.abs(q).max()) * q.shape[1] >= LARGEST:
        raise OverflowError("vectors' components are too large for integer scores")
    lists = Lists(rows)
    for i, (known, _) in enumerate(best):
        left = lists.read(q[i], k + 1, float(known[k - 1]) if len(known) >= k else -math.inf)
        score = rows[left] @ q[i]
        found = np.concatenate([owners[j] for j in left]) if len(left) else np.zeros(0, np.int64)
        scores = np.repeat(score, [len(owners[j]) for j in left])
        other = found != qids[i]
        s, v = np.concatenate([best[i][0], scores[other]]), np.concatenate([best[i][1], found[other]])
        top = np.lexsort((v, -s))[:k]
        best[i] = (s[top], v[top])


def top_k(rows: DataFrame, is_query: Column, k: int = 10, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): each query row's ``k`` best other rows."""
    spark = rows.sparkSession
    pairs = rows.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v"))
    queries = materialize(rows.filter(is_query & F.col(key).isNotNull()).select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v")).distinct(), "queries")
    groups = max(1, math.ceil(queries.count() / QUERY_GROUP))
    found = []
    for g in range(groups):
        mine = queries.filter(F.pmod(F.xxhash64("id"), F.lit(groups)) == g).toArrow().combine_chunks()
        shared = spark.sparkContext.broadcast(to_integers(_one(mine.column("v")), _one(mine.column("id"))) if len(mine) else {})

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            asked = shared.value
            best = {n: [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(ids) for n, (ids, _) in asked.items()}
            for batch in batches:
                for n, (ids, x) in to_integers(batch.column(1), batch.column(0)).items():
                    if n in asked:
                        for i in range(0, len(ids), BLOCK):
                            block_best(ids[i : i + BLOCK], x[i : i + BLOCK], *asked[n], k, best[n])
            for n, (ids, _) in asked.items():
                sizes = [len(s) for s, _ in best[n]]
                yield pa.RecordBatch.from_pydict({
                    "query_id": pa.array(np.repeat(ids, sizes), pa.int64()),
                    "vec_id": pa.array(np.concatenate([v for _, v in best[n]]) if len(ids) else [], pa.int64()),
                    "score": pa.array(np.concatenate([s for s, _ in best[n]]) if len(ids) else [], pa.int64()),
                })

        part = pairs.mapInArrow(run, "query_id long, vec_id long, score long")
        found.append(part if groups == 1 else materialize(part, "best"))
    ranked = reduce(DataFrame.unionByName, found).withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _one(column: pa.ChunkedArray) -> pa.Array:
    return column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
