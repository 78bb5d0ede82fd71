"""Column functions over entities and arrays of them: text, look-ups, updates."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from threshline import schema as S
from threshline.functions.entries import non_blank

_ATTR = "(?U)" + S.ATTR_PATTERN
_TAG = "(?U)" + S.TAG_PATTERN


def attr_names(text: Column) -> Column:
    """Names of ``name="value"`` pairs in the order written, repeats included."""
    return F.regexp_extract_all(text, F.lit(_ATTR), F.lit(1))


def parse_attrs(text: Column) -> Column:
    """Map of ``name="value"`` pairs; of repeated names the last value counts."""
    names, values = attr_names(text), F.regexp_extract_all(text, F.lit(_ATTR), F.lit(2))
    pairs = F.arrays_zip(names.alias("k"), values.alias("v"))
    return F.aggregate(pairs, F.create_map().cast("map<string,string>"), lambda m, p: F.map_concat(F.map_filter(m, lambda k, _: k != p["k"]), F.create_map(p["k"], p["v"])))


def class_of(tag: Column, attrs: Column) -> Column:
    """The first class of a tag whose subject attribute is there; else generic."""
    out = F.when(tag == "augment", "Augment")
    for name, classes in S.TAGS.items():
        for cls, key in classes:
            out = out.when((tag == name) & F.coalesce(attrs[key] != "", F.lit(False)), cls)
    return out.otherwise("GenericEntity")


def subject_key(cls: Column) -> Column:
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for classes in S.TAGS.values():
        for name, key in classes:
            out = out.when(cls == name, key)
    return out


def family_of(cls: Column) -> Column:
    return F.when(cls.isin(S.STATS_CLASSES), "stats").when(cls == "CharacterEntity", "character").when(cls == "Augment", "entity").otherwise("generic")


def build_entity(tag: Column, written: Column) -> Column:
    """An entity struct of a tag and its attributes as written."""
    attrs = parse_attrs(written)
    cls = class_of(tag, attrs)
    key = subject_key(cls)
    subject = F.when(key.isNotNull(), F.struct(key.alias("key"), attrs[key].alias("id")))
    own = F.when(key.isNull(), attrs).otherwise(F.map_filter(attrs, lambda k, _: k != key))
    order = F.when(key.isNull(), attr_names(written)).otherwise(F.array_remove(attr_names(written), key))
    return F.struct(
        cls.alias("cls"), family_of(cls).alias("family"), F.when(cls == "Augment", "entity").otherwise(tag).alias("tag"),
        subject.alias("subject"), own.alias("attrs"), order.alias("attr_order"), F.lit(None).cast("string").alias("text"),
    ).cast(S.ENTITY)


def identity(e: Column) -> Column:
    return F.struct(e["cls"], e["subject"]["key"], e["subject"]["id"])


def valid(e: Column) -> Column:
    """Whether an entity that needs a subject has one."""
    needs = e["cls"].isin(*S.STATS_CLASSES, "CharacterEntity")
    return ~needs | F.coalesce((e["subject"]["key"] != "") & (e["subject"]["id"] != ""), F.lit(False))


def keep_first(entities: Column) -> Column:
    """The first entity of each identity; generic ones all stay."""

    def fresh(e: Column, i: Column) -> Column:
        before = F.slice(entities, F.lit(1), i)
        return (e["cls"] == "GenericEntity") | ~F.exists(before, lambda o: identity(o) == identity(e))

    return F.filter(entities, fresh)


def entities_in(span: Column) -> Column:
    """Entities of the self-closing tags of a span of text."""
    tags = F.arrays_zip(F.regexp_extract_all(span, F.lit(_TAG), F.lit(1)).alias("t"), F.regexp_extract_all(span, F.lit(_TAG), F.lit(2)).alias("a"))
    return F.transform(tags, lambda x: build_entity(x["t"], x["a"]))


def attrs_text(e: Column) -> Column:
    """``k="v"`` of every name of the order that has a value, unescaped, as written."""
    order = F.when(F.size(e["attr_order"]) > 0, e["attr_order"]).otherwise(F.map_keys(e["attrs"]))
    here = F.filter(order, lambda k: F.map_contains_key(e["attrs"], k))
    return F.array_join(F.transform(here, lambda k: F.concat(k, F.lit('="'), e["attrs"][k], F.lit('"'))), " ")


def text_of(e: Column) -> Column:
    """An entity as it is written in a prompt."""
    cls = e["cls"]
    tag = F.when(cls.isin(S.STATS_CLASSES), "stats").when(cls == "Augment", "augment").when(cls == "CharacterEntity", "character").when(cls == "Meta", "meta").otherwise(e["tag"])
    subject = F.when(e["subject"]["key"].isNotNull(), F.concat(e["subject"]["key"], F.lit('="'), e["subject"]["id"], F.lit('"')))
    inner = F.concat_ws(" ", tag, subject, non_blank(attrs_text(e)))
    lost = cls.isin(*S.STATS_CLASSES, "CharacterEntity") & ~valid(e)
    anchor = F.concat(F.lit("<"), inner, F.lit(">"), F.coalesce(e["text"], F.lit("")), F.lit("</"), e["tag"], F.lit(">"))
    return F.when(lost, "").when(cls.isin("PreviousMessage", "Message"), anchor).otherwise(F.concat(F.lit("<"), inner, F.lit(" />")))


def texts_of(entities: Column) -> Column:
    return F.transform(F.coalesce(entities, F.array().cast(f"array<{S.ENTITY.simpleString()}>")), text_of)


def prompt_of(previous: str = "previous_message", before: str = "previous_state", message: str = "message", context: str = "state_context", state: str = "state") -> Column:
    """The prompt of a datapoint: its parts, a line each."""
    return F.array_join(
        F.concat(F.array(text_of(F.col(previous))), texts_of(F.col(before)), F.array(text_of(F.col(message))), texts_of(F.col(context)), texts_of(F.col(state))), "\n"
    )


# Arrays of entities.


def of_type(entities: Column, *classes: str) -> Column:
    """Entities of the classes; ``Stats`` stands for all kinds of stats."""
    names = [n for c in classes for n in (S.STATS_CLASSES if c == "Stats" else [c])]
    return F.filter(entities, lambda e: e["cls"].isin(names))


def where(entities: Column, predicate: Callable[[Column], Column]) -> Column:
    return F.filter(entities, predicate)


def count_of(entities: Column, predicate: Callable[[Column], Column]) -> Column:
    return F.size(F.filter(entities, predicate))


def first(entities: Column, default: Column | None = None) -> Column:
    head = F.get(entities, F.lit(0))
    return head if default is None else F.coalesce(head, default)


def find_matching(entities: Column, ref: Column) -> Column:
    """The entity of ``ref``'s class and subject; null if none, an error if several."""
    found = F.filter(entities, lambda e: (e["cls"] == ref["cls"]) & (e["subject"]["id"] == ref["subject"]["id"]))
    several = F.raise_error(F.lit("several entities match")).cast(S.ENTITY)
    return F.when(F.size(found) > 1, several).otherwise(F.get(found, F.lit(0)))


def _aims(e: Column, target: Column) -> Column:
    """Whether an entity is of a target's class and, if it names one, its subject."""
    cls = F.when(target["entity"] == "Stats", e["cls"].isin(S.STATS_CLASSES)).otherwise(e["cls"] == target["entity"])
    return cls & (target["subject_id"].isNull() | F.coalesce(e["subject"]["id"] == target["subject_id"], F.lit(False)))


def target_value(entities: Column, target: Column, default: Column | None = None) -> Column:
    """The target's attribute of the first entity that is meant and has it."""
    values = F.filter(F.transform(F.filter(entities, lambda e: _aims(e, target)), lambda e: e["attrs"][target["attr"]]), lambda v: v.isNotNull())
    return first(values, default)


def target_entity(entities: Column, target: Column) -> Column:
    found = F.filter(entities, lambda e: _aims(e, target))
    return F.when(F.size(found) > 1, F.raise_error(F.lit("several entities match")).cast(S.ENTITY)).otherwise(F.get(found, F.lit(0)))


def set_target_value(entities: Column, target: Column, value: Column) -> Column:
    """``entities`` with the attribute changed in the first one that is meant."""
    at = F.array_position(F.transform(entities, lambda e: _aims(e, target)), F.lit(True)) - 1

    def changed(e: Column, i: Column) -> Column:
        attrs = F.map_concat(F.map_filter(e["attrs"], lambda k, _: k != target["attr"]), F.create_map(target["attr"], value))
        return F.when(i == at, e.withField("attrs", attrs)).otherwise(e)

    return F.transform(entities, changed)


def all_entities(previous_message: Column, message: Column, previous_state: Column, state: Column) -> Column:
    """All of a datapoint's entities; its context, whose entities are others' states, is left out."""
    return F.concat(F.array(previous_message), previous_state, F.array(message), state)


# Datapoints.


def line_number(text: Column, at: Column) -> Column:
    """1-based line of the (1-based) character ``at``."""
    head = F.left(text, at - 1)
    return F.length(head) - F.length(F.replace(head, F.lit("\n"), F.lit(""))) + 1


def infer_subject(target: Column, state: Column, previous: Column, context: Column) -> Column:
    """Whom a datapoint is about: its target, else its first subject."""

    def of(entities: Column) -> Column:
        return first(F.transform(F.filter(entities, lambda e: F.coalesce(e["subject"]["id"] != "", F.lit(False))), lambda e: e["subject"]["id"]))

    return F.coalesce(non_blank(target["subject_id"]), of(state), of(previous), of(context))


def build_id(source_id: Column, original: Column, target: Column) -> Column:
    """source, subject and attribute, as far as they are there, joined by colons."""
    return F.concat_ws(":", non_blank(source_id), F.coalesce(non_blank(original), non_blank(target["subject_id"])), non_blank(target["attr"]))


def expected_value(target: Column, state: Column, previous: Column, prompt: Column) -> Column:
    """What the model should write: the target's new value, or the old one if unchanged;
    without a target all that follows the prompt's last ``="``."""
    new = target_value(state, target)
    kept = F.when(new == S.NO_CHANGE, F.coalesce(target_value(previous, target), new)).otherwise(new)
    return F.when(target.isNotNull(), kept).otherwise(F.substring_index(prompt, '="', -1))


def wrap_values(line: Column) -> Column:
    """A stat line between ``**/`` and ``/**``, its values after the first wrapped too."""
    parts = F.split(line, '"', -1)

    def wrapped(v: Column, i: Column) -> Column:
        done = F.startswith(v, F.lit("/**")) & F.endswith(v, F.lit("**/")) & (F.length(v) >= 6)
        inside = (i % 2 == 1) & (i > 1) & (i < F.size(parts) - 1) & ~done
        return F.when(inside, F.concat(F.lit("/**"), v, F.lit("**/"))).otherwise(v)

    return F.concat(F.lit("**/"), F.array_join(F.transform(parts, wrapped), '"'), F.lit("/**"))


def merge_attrs(maps: Iterable[Column]) -> Column:
    """One map of several; later values win."""

    def over(out: Column, m: Column) -> Column:
        return F.map_concat(F.map_filter(out, lambda k, _: ~F.map_contains_key(m, k)), m)

    return reduce(over, maps, F.create_map().cast("map<string,string>"))
