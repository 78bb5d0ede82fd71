"""Augmentation passes: functions from datapoints to datapoints.

A pass keeps rows that it doesn't apply to, and may turn others into none or many. All
but the renaming are column functions, so Spark plans a chain of passes as one stage.
"""

from __future__ import annotations

import hashlib
import json
import random
import re
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from threshline import schema as S
from threshline.functions import entities as N
from threshline.functions.entries import order_key

Pass = Callable[[DataFrame], DataFrame]


def _noted(applied: Pass, **options) -> Pass:
    """The pass, with the options that a run's version has to hold."""
    applied.options = options
    return applied


def run_passes(datapoints: DataFrame, passes: Sequence[Pass]) -> DataFrame:
    for one in passes:
        datapoints = datapoints.transform(one)
    return datapoints


def content_key() -> Column:
    """What a datapoint says, as a hash: texts, states and context, attributes sorted."""

    def plain(entities: Column) -> Column:
        return F.transform(entities, lambda e: F.struct(e["cls"], e["tag"], e["subject"], F.array_sort(F.map_entries(e["attrs"])), e["text"]))

    parts = F.struct(
        plain(F.array("previous_message")).alias("a"), plain(F.array("message")).alias("b"), plain(F.col("previous_state")).alias("c"),
        plain(F.col("state_context")).alias("d"), plain(F.col("state")).alias("e"),
    )
    return F.sha1(F.to_json(parts))


def _one_stats() -> Column:
    return F.size(N.of_type(F.col("state"), "Stats")) == 1


def meta_updated(datapoints: DataFrame) -> DataFrame:
    """Beside a row whose whole stats are known before and after, one that only asks
    whether they changed."""
    new = N.first(N.of_type(F.col("state"), "Stats"))
    rows = datapoints.withColumn("_new", F.when(_one_stats(), new))
    rows = rows.withColumn("_old", F.when(F.col("_new").isNotNull(), N.find_matching(F.col("previous_state"), F.col("_new"))))
    concrete = F.create_map(*[x for cls in S.STATS_CLASSES for x in (F.lit(cls), F.array(*[F.lit(s) for c, s, _, _, real in S.STATS if c == cls and real]))])[F.col("_new.cls")]
    whole = F.forall(concrete, lambda s: F.map_contains_key(F.col("_new.attrs"), s) & F.map_contains_key(F.col("_old.attrs"), s))
    rows = rows.withColumn("_whole", F.coalesce(F.col("_old").isNotNull() & whole, F.lit(False)))
    same = F.forall(concrete, lambda s: F.col("_new.attrs")[s] == F.col("_old.attrs")[s])
    meta = F.struct(
        F.lit("Meta").alias("cls"), F.lit("meta").alias("family"), F.lit("meta").alias("tag"), F.col("_new.subject").alias("subject"),
        F.create_map(F.lit("updated"), F.when(same, "false").otherwise("true")).alias("attrs"), F.array(F.lit("updated")).alias("attr_order"), F.lit(None).cast("string").alias("text"),
    ).cast(S.ENTITY)
    asks = F.struct(F.lit("Meta").alias("entity"), F.col("_new.subject.id").alias("subject_id"), F.lit(S.UPDATED).alias("attr"))
    asked = rows.withColumn("_asked", F.explode(F.when(F.col("_whole"), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))))
    out = asked.withColumns({"state": F.when(F.col("_asked"), F.array(meta)).otherwise(F.col("state")), "target": F.when(F.col("_asked"), asks.cast(S.TARGET)).otherwise(F.col("target"))})
    return out.select(*datapoints.columns)


def no_change(datapoints: DataFrame) -> DataFrame:
    """A target whose value is the same as before gets the mark of no change."""
    target = F.col("target")
    new, old = N.target_value(F.col("state"), target), N.target_value(F.col("previous_state"), target)
    same = F.coalesce(target.isNotNull() & (new == old), F.lit(False))
    return datapoints.withColumn("state", F.when(same, N.set_target_value(F.col("state"), target, F.lit(S.NO_CHANGE))).otherwise(F.col("state")))


def unwind_stats(datapoints: DataFrame) -> DataFrame:
    """A row per attribute of the one stats entity: the attribute after those that it
    depends on, as the target.

    The closed form holds where no stat has two parents and no parent has one itself.
    """
    parents = {(c, s): d for c, s, d, _, _ in S.STATS}
    if any(len(d) > 1 or any(parents[c, p] for p in d) for (c, _), d in parents.items()):
        raise ValueError("the closed form needs single, direct dependencies")
    key = lambda e, k: F.concat(e["cls"], F.lit("|"), k)
    parent = F.create_map(*[F.lit(x) for (c, s), d in parents.items() if d for x in (f"{c}|{s}", d[0])])
    place = F.create_map(*[x for c, s, _, i, _ in S.STATS for x in (F.lit(f"{c}|{s}"), F.lit(i))])
    rows = datapoints.withColumn("_e", F.when(_one_stats(), N.first(N.of_type(F.col("state"), "Stats"))))
    names = F.filter(F.array_distinct(F.col("_e.attr_order")), lambda k: F.map_contains_key(F.col("_e.attrs"), k))
    rows = rows.select("*", F.posexplode_outer(names).alias("_n", "_k"))
    e, k = F.col("_e"), F.col("_k")
    first = parent[key(e, k)]
    used = F.when(F.map_contains_key(e["attrs"], first), F.array(first, k)).otherwise(F.array(k))
    ordered = F.transform(F.array_sort(F.transform(used, lambda s: F.struct(F.coalesce(place[key(e, s)], F.lit(S.UNKNOWN_ORDER)).alias("o"), s.alias("s")))), lambda x: x["s"])
    cut = e.withField("attrs", F.map_filter(e["attrs"], lambda n, _: F.array_contains(used, n))).withField("attr_order", ordered)
    target = F.struct(e["cls"].alias("entity"), e["subject"]["id"].alias("subject_id"), k.alias("attr")).cast(S.TARGET)
    out = rows.withColumns({
        "state": F.when(k.isNotNull(), F.array(cut)).otherwise(F.col("state")),
        "target": F.when(k.isNotNull(), target).otherwise(F.col("target")),
        "original_subject_id": F.coalesce("original_subject_id", e["subject"]["id"]),
        "_part": F.col("_part") * 1000 + F.coalesce("_n", F.lit(0)),
    })
    return out.select(*datapoints.columns)


def mirror(classes: Sequence[str] | None = None, probability: float = 1.0, seed: int = 0) -> Pass:
    """Beside a row with two entities of a class before, one with each class's entities in
    reverse, in the places that they have."""

    def applied(datapoints: DataFrame) -> DataFrame:
        a = F.col("previous_state")
        moved = (lambda e: F.lit(True)) if classes is None else (lambda e: e["cls"].isin(list(classes)))

        def other(e: Column, i: Column) -> Column:
            kin = F.filter(a, lambda o: o["cls"] == e["cls"])
            rank = F.size(F.filter(F.slice(a, F.lit(1), i), lambda o: o["cls"] == e["cls"]))
            return F.when(moved(e), F.get(kin, F.size(kin) - 1 - rank)).otherwise(e)

        twice = F.exists(a, lambda e: moved(e) & (F.size(F.filter(a, lambda o: o["cls"] == e["cls"])) > 1))
        chosen = twice if probability >= 1 else twice & (_chance(seed) < probability)
        rows = datapoints.withColumn("_mirror", F.explode(F.when(chosen, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))))
        out = rows.withColumn("previous_state", F.when(F.col("_mirror"), F.transform(a, other)).otherwise(a))
        return out.withColumn("_part", F.col("_part") * 2 + F.col("_mirror").cast("int")).select(*datapoints.columns)

    return _noted(applied, classes=classes and list(classes), probability=probability, seed=seed)


def _chance(seed: int) -> Column:
    """A number in [0, 1) by a row's content and the seed."""
    return F.conv(F.substring(order_key(content_key(), seed), 1, 12), 16, 10).cast("double") / float(1 << 48)


def duplicate(datapoints: DataFrame) -> DataFrame:
    """A row as often as its first augment entity says; 0 or less drops it."""
    marks = F.filter("previous_state", lambda e: (e["cls"] == "Augment") & F.map_contains_key(e["attrs"], F.lit("duplicate")))
    n = F.trim(N.first(marks)["attrs"]["duplicate"]).try_cast("int")
    return _copies(datapoints, F.coalesce(n, F.lit(1)))


def duplicate_changes(stat: str, multiplier: float, seed: int = 0) -> Pass:
    """Rows whose target ``stat`` changed, ``multiplier`` times on average."""
    if multiplier < 1:
        raise ValueError("the multiplier is 1 or more")

    def applied(datapoints: DataFrame) -> DataFrame:
        target = F.col("target")
        new, old = N.target_value(F.col("state"), target), N.target_value(F.col("previous_state"), target)
        hit = F.coalesce((target["attr"] == stat) & ~new.eqNullSafe(old) & (new != S.NO_CHANGE), F.lit(False))
        more = (_chance(seed) < multiplier % 1).cast("int")
        return _copies(datapoints, F.when(hit, int(multiplier) + more).otherwise(1))

    return _noted(applied, stat=stat, multiplier=multiplier, seed=seed)


def _copies(datapoints: DataFrame, n: Column) -> DataFrame:
    rows = datapoints.withColumn("_n", n).filter("_n > 0").withColumn("_i", F.explode(F.sequence(F.lit(1), F.col("_n"))))
    here = F.coalesce(F.col("_copy"), F.lit(0)) if "_copy" in datapoints.columns else F.lit(0)
    return rows.withColumn("_copy", here * 1000 + F.col("_i") - 1).select(*dict.fromkeys([*datapoints.columns, "_copy"]))


#: Titles that a composite name may have, and that aren't names themselves.
TITLES = ("Mr", "Mrs", "Ms", "Miss", "Dr", "Sir", "Lady", "Lord", "Captain", "Professor")


def name_pool(size: int = 600) -> list[str]:
    """Invented given names, by a rule: two syllables and an ending."""
    onset, vowel, coda = "b c d f g h j k l m n p r s t v z".split(), "a e i o u".split(), ["n", "ra", "lin", "s", "mir"]
    every = [(a + v + b + w + e).capitalize() for a in onset for v in vowel for b in onset for w in vowel for e in coda]
    return every[:: max(1, len(every) // size)][:size]


def rename(probability: float = 0.30, names: Sequence[str] | None = None, exclude: Sequence[str] = ()) -> Pass:
    """All characters of a datapoint renamed alike: subjects, speakers, values and prose.

    The names that a row gets depend on its content alone. A composite name (a title, or
    a second name) is given with ``probability``; parts of a compound name follow it.
    Generic entities stay as they are; so does the id, which keeps the old name.
    """
    pool = list(names or name_pool())

    def applied(datapoints: DataFrame) -> DataFrame:
        schema = datapoints.schema
        arrow = to_arrow_schema(schema)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = batch.to_pylist(maps_as_pydicts="strict")
                yield pa.RecordBatch.from_pylist([rename_row(r, pool, probability, set(exclude)) for r in rows], schema=arrow)

        return datapoints.mapInArrow(run, schema)

    return _noted(applied, probability=probability, names=pool, exclude=sorted(exclude))


def rename_row(row: dict, pool: Sequence[str], probability: float, exclude: set[str]) -> dict:
    states = [*row["previous_state"], *row["state"]]
    found = {e["subject"]["id"] for e in states if e["subject"] and (e["cls"] == "CharacterStats" or e["subject"]["key"] == "character")}
    originals = sorted(found - exclude)
    if not originals:
        return row
    content = json.dumps([row[k] for k in ("previous_message", "message", "previous_state", "state_context", "state")], sort_keys=True)
    rng = random.Random(hashlib.sha1(content.encode()).hexdigest())
    drawn: set[int] = set()

    def draw() -> str:
        """A name of the pool; none twice before all are drawn."""
        if len(drawn) == len(pool):
            drawn.clear()
        while (i := rng.randrange(len(pool))) in drawn:
            pass
        drawn.add(i)
        return pool[i]

    base: dict[str, str] = {}
    full: dict[str, str] = {}
    for name in originals:
        parts = [p.capitalize() for p in re.split(r"[ ,\-]+", name) if p and p.rstrip(".").capitalize() not in TITLES]
        new = base.get(name) or next((base[p] for p in parts if p in base), None) or draw()
        base[name] = new
        if rng.random() < probability:
            full[name] = rng.choice((f"{rng.choice(TITLES)} {new}", f"{new} {draw()}", f"{new}-{draw()}", f"{rng.choice(TITLES)} {new} {draw()}"))
        if len(parts) > 1:
            base.update({p: new for p in parts if p not in base})
    exact = {n: full.get(n, base[n]) for n in originals}
    compound = {n for n in originals if re.search(r"[ ,\-]", n)}
    inside = {n: full.get(n, b) if n in compound else b for n, b in base.items()}
    pattern = re.compile(r"\b(" + "|".join(map(re.escape, sorted(inside, key=lambda n: (-len(n), n)))) + r")(?='s|'|\b)")

    def prose(text: str | None) -> str | None:
        return None if text is None else pattern.sub(lambda m: inside[m[1]], text)

    def entity(e: dict) -> dict:
        if e["cls"] == "GenericEntity":
            return e
        attrs = {k: exact.get(v, prose(v)) if k == "from" else prose(v) for k, v in e["attrs"].items()}
        subject = e["subject"] and e["subject"] | {"id": exact.get(e["subject"]["id"], prose(e["subject"]["id"]))}
        return e | {"attrs": attrs, "subject": subject, "text": prose(e["text"])}

    out = row | {k: entity(row[k]) for k in ("previous_message", "message")}
    out |= {k: [entity(e) for e in row[k] or []] for k in ("previous_state", "state_context", "state")}
    if row["target"]:
        out["target"] = row["target"] | {"subject_id": exact.get(row["target"]["subject_id"], row["target"]["subject_id"])}
    return out


CHAT_TRAIN: list[Pass] = [unwind_stats, duplicate, rename(0.05), mirror(), no_change]
CHAT_EVAL: list[Pass] = [unwind_stats, no_change]
SYNTHETIC: list[Pass] = [duplicate, unwind_stats, mirror(), no_change]
