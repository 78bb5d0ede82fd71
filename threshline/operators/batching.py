"""Batches: dealt in one parallel sort, or engineered one by one.

``deal`` spreads every stratum evenly over all batches and scales with the table. The
engineered forms choose each row by what was chosen before, so an epoch is one task;
they get narrow rows (keys, attribute, bucket, length), and the rest is joined back.
"""

from __future__ import annotations

from collections import Counter, deque
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threshline.functions import entries as E
from threshline.operators.ranking import global_rank
from threshline.operators.sampling import pad

#: Rows that an engineered epoch may have; larger ones are dealt.
ENGINEERED_ROWS = 200_000
#: Batches' latest rows among which the least seen attribute is looked for.
RECENT = 50
HARDEST_FIRST = ("high", "medium", "low", "synthetic")


def deal(entries: DataFrame, batch: int, seed: int = 1337, drop_last: bool = False) -> DataFrame:
    """``entries`` with batch_id and pos: strata (bucket, attribute) are dealt in turn, each
    epoch (if there are any) apart.

    The rows of an epoch that fill no whole batch make its last, short one.
    """
    epoch = F.col("epoch") if "epoch" in entries.columns else F.lit(0)
    rows = entries.withColumns({"_epoch": epoch, "_bucket": E.bucket(), "_attr": E.attr(), "_key": E.order_key(F.col("_ord").cast("string"), seed)})
    order = [F.col(c) for c in ("_epoch", "_bucket", "_attr", "_key")]
    ranked = global_rank(rows, *order)
    # One row per epoch: their number is a parameter.
    sizes = ranked.groupBy(F.col("_epoch").alias("_of")).agg(F.floor(F.count("*") / batch).alias("_whole"), F.min("rank").alias("_first"))
    ranked = ranked.join(F.broadcast(sizes), F.col("_epoch").eqNullSafe(F.col("_of")))
    i, whole = F.col("rank") - F.col("_first"), F.col("_whole")
    inside = i < whole * batch
    ranked = ranked.withColumns({
        "batch_id": F.when(inside, i % whole).otherwise(whole).cast("int"),
        "pos": F.when(inside, F.floor(i / whole)).otherwise(i - whole * batch).cast("int"),
    })
    return (ranked.filter(F.col("batch_id") < whole) if drop_last else ranked).select(*entries.columns, "batch_id", "pos")


def spread_attrs(batches: list[list[int]], ok: list[bool], bucket: list[str]) -> int:
    """Swap rows so that every batch has one that is ``ok``, as far as there are enough;
    a partner of the same bucket is preferred. Returns the batches still without."""
    lacking = deque(i for i, b in enumerate(batches) if not any(ok[r] for r in b))
    rich = [i for i, b in enumerate(batches) if sum(ok[r] for r in b) > 1]
    left = 0
    while lacking:
        i = lacking.popleft()
        done = False
        while rich and not done:
            j = rich[-1]
            spare = [p for p, r in enumerate(batches[j]) if ok[r]]
            if len(spare) < 2:
                rich.pop()
                continue
            pairs = ((p, q) for p in spare for q in range(len(batches[i])))
            p, q = next(((p, q) for p, q in pairs if bucket[batches[j][p]] == bucket[batches[i][q]]), (spare[0], 0))
            batches[j][p], batches[i][q] = batches[i][q], batches[j][p]
            done = True
        left += not done
    return left


class Pool:
    """A bucket's rows, a queue per attribute."""

    def __init__(self) -> None:
        self.queues: dict[str, deque[tuple[int, int]]] = {}
        self.size = 0

    def add(self, place: int, row: int, attr: str) -> None:
        self.queues.setdefault(attr, deque()).append((place, row))
        self.size += 1

    def take(self, seen: Counter) -> tuple[str, int]:
        """The next row of the attribute seen least; of several, the one placed first."""
        attr = min(self.queues, key=lambda a: (seen[a], self.queues[a][0]))
        _, row = self.queues[attr].popleft()
        if not self.queues[attr]:
            del self.queues[attr]
        self.size -= 1
        return attr, row


def plan_balanced(rows: pd.DataFrame, batch: int) -> list[list[int]]:
    """Row numbers by batch: of every bucket a share as large as it has of what is left,
    each time a row of the attribute that the latest ``RECENT`` rows have least."""
    pools = {b: Pool() for b in HARDEST_FIRST}
    order = rows.sort_values("key", kind="stable")
    for place, (i, b, a) in enumerate(zip(order.index, order["bucket"], order["attr"], strict=True)):
        pools[b if b in pools else "low"].add(place, i, a)
    recent: deque[str] = deque()
    seen: Counter = Counter()
    out: list[list[int]] = []

    def take(pool: Pool) -> int:
        attr, row = pool.take(seen)
        recent.append(attr)
        seen[attr] += 1
        if len(recent) > RECENT:
            seen[recent.popleft()] -= 1
        return row

    while left := sum(p.size for p in pools.values()):
        size = min(batch, left)
        filled = [pools[b] for b in HARDEST_FIRST if pools[b].size]
        shares = [round(size * p.size / left) for p in filled[:-1]]
        shares.append(max(0, size - sum(shares)))
        wanted = [p for p, n in zip(filled, shares, strict=True) for _ in range(min(n, p.size))][:size]
        chosen = [take(p) for p in wanted]
        while len(chosen) < size:
            chosen.append(take(next(p for p in filled if p.size)))
        out.append(chosen)
    spread_attrs(out, rows["flip"].tolist(), rows["bucket"].tolist())
    spread_attrs(out, rows["same"].tolist(), rows["bucket"].tolist())
    return out


def plan_by_attr(rows: pd.DataFrame, batch: int, max_per_attr: int | None = None, spread_no_change: bool = True) -> list[list[int]]:
    """Row numbers by batch: each row goes to the batch that lacks its attribute most, then
    has the fewest unchanged rows, then the nearest length, then the fewest rows."""
    order = rows.sort_values("key", kind="stable")
    n = -(-len(rows) // batch) if len(rows) else 0
    counts = {a: np.zeros(n) for a in rows["attr"].unique()}
    target = {a: c / n for a, c in rows["attr"].value_counts().items()}
    same, length, size = np.zeros(n), np.zeros(n), np.zeros(n)
    mean = float(rows["length"].mean()) if n else 0.0
    out: list[list[int]] = [[] for _ in range(n)]
    for i, a, s, ln in zip(order.index, order["attr"], order["same"], order["length"], strict=True):
        left = np.flatnonzero(size < batch)
        if max_per_attr is not None and (under := left[counts[a][left] < max_per_attr]).size:
            left = under
        # one measure after the other, each among the best of the one before
        measures = [counts[a] - target[a], same if s and spread_no_change else None, np.abs((length + ln) / (size + 1) - mean), size]
        for m in measures:
            if m is not None and len(left) > 1:
                left = left[m[left] == m[left].min()]
        best = left[0]
        out[best].append(i)
        counts[a][best] += 1
        same[best] += bool(s)
        length[best] += ln
        size[best] += 1
    return out


def engineer(entries: DataFrame, batch: int, plan: Callable[..., list[list[int]]], seed: int = 1337, synthetic: Column | None = None, length: Column | None = None, **options) -> DataFrame:
    """``entries`` with batch_id and pos by ``plan``, each epoch (if there are any) apart."""
    epoch = F.col("epoch") if "epoch" in entries.columns else F.lit(0)
    marked = E.bucket() if synthetic is None else F.when(synthetic, "synthetic").otherwise(E.bucket())
    uid = F.sha1(F.concat_ws("#", F.to_json(F.struct("_ord")), epoch.cast("string")))
    keyed = entries.withColumn("_uid", uid)
    narrow = keyed.select(
        epoch.alias("epoch"), "_uid", F.sha1(F.concat_ws("#", "_uid", F.lit(str(seed)))).alias("key"), marked.alias("bucket"), E.attr().alias("attr"), E.is_flip().alias("flip"),
        E.is_no_change().alias("same"), (F.length("prompt") if length is None else length).cast("double").alias("length"),
    )
    largest = narrow.groupBy("epoch").count().agg(F.max("count")).first()[0] or 0
    if largest > ENGINEERED_ROWS:
        raise ValueError(f"an epoch of {largest} rows is too large to engineer (at most {ENGINEERED_ROWS}): deal() it, or use more epochs")

    def planned(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["key", "_uid"], kind="stable").reset_index(drop=True)
        found = plan(rows, batch, **options)
        at = [(rows["_uid"][i], b, p) for b, members in enumerate(found) for p, i in enumerate(members)]
        return pd.DataFrame(at, columns=["_uid", "batch_id", "pos"])

    placed = narrow.groupBy("epoch").applyInPandas(planned, "_uid string, batch_id int, pos int")
    if entries.select("_ord").distinct().count() != entries.count() and "epoch" not in entries.columns:
        raise ValueError("rows need keys of their own: _ord repeats")
    return keyed.join(placed, "_uid").select(*entries.columns, "batch_id", "pos")


def stage0_epochs(entries: DataFrame, batch: int, n: int, seed: int = 1337, **options) -> DataFrame:
    """Padded entries, ``n`` epochs, each batched by attribute with its own shuffle."""
    padded = pad(entries, batch, seed)
    copies = padded.withColumn("_ord", F.struct("_ord", F.col("_is_padding_duplicate").alias("_pad")))
    every = copies.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    return engineer(every, batch, plan_by_attr, seed, **options).withColumn("_ord", F.col("_ord._ord"))


def token_batches(prompts: DataFrame, budget: int, length: Column) -> DataFrame:
    """``prompts`` with batch_id: by length (then ``_ord``, if there is one), cut before the
    longest length times the rows would pass ``budget``; a longer prompt is a batch alone.

    Rows of one length fill batches of one size, so the cuts follow from how often each
    length occurs; that table (a row per distinct length, at most the longest prompt's
    length) is walked on the driver. A row's batch then follows from its global rank, on
    any number of partitions. A null length counts as 0.
    """
    rows = prompts.withColumn("_length", F.coalesce(length.cast("long"), F.lit(0)))
    if "_ord" in prompts.columns:
        ties = [F.col("_ord").cast("string")]
    else:
        ties = [F.xxhash64(*prompts.columns)] if prompts.columns else []
    ranked = global_rank(rows, F.col("_length"), *ties)
    counts = ranked.groupBy("_length").agg(F.count("*").alias("n"), F.min("rank").alias("first")).orderBy("_length").collect()
    cuts = [(r["_length"], r["first"], *cut) for r, cut in zip(counts, length_cuts([(r["_length"], r["n"]) for r in counts], budget), strict=True)]
    table = prompts.sparkSession.createDataFrame(cuts, "_length long, _first long, _room long, _open long, _cap long")
    i = F.col("rank") - F.col("_first")
    open_, cap = F.col("_open"), F.col("_cap")
    batch = F.when(open_ < 0, F.floor(i / cap)).when(i < F.col("_room"), open_).otherwise(open_ + 1 + F.floor((i - F.col("_room")) / cap))
    return ranked.join(F.broadcast(table), "_length").select(*prompts.columns, batch.cast("long").alias("batch_id"))


def length_cuts(counts: list[tuple[int, int]], budget: int) -> list[tuple[int, int, int]]:
    """For ascending (length, rows): how many of the rows still go to the open batch, that
    batch's number (-1 if none is open yet), and how many fill a batch of their own."""
    out, open_, held = [], -1, 0
    for length, n in counts:
        cap = max(1, budget // length) if length else n + held
        room = 0 if open_ < 0 else min(n, max(0, cap - held) if held * length + length <= budget or not length else 0)
        out.append((room, open_, cap))
        left = n - room
        if left:
            more = -(-left // cap)
            open_, held = open_ + more, left - (more - 1) * cap
        else:
            held += room
    return out
