"""Scalar functions over entries: metrics, attributes, buckets, text parts."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from threshline import schema as S

_SPACE = r"(?U)^\s+|\s+$"


def strip(c: Column) -> Column:
    """Without white space of any script at both ends."""
    return F.regexp_replace(c, _SPACE, "")


def non_blank(c: Column) -> Column:
    """Null for the empty string."""
    return F.nullif(c, F.lit(""))


def number(c: Column) -> Column:
    """A double; 0.0 for null and what is no number."""
    return F.coalesce(c.try_cast("double"), F.lit(0.0))


def loss_metrics() -> Column:
    """The metrics; an empty struct where there are none."""
    return F.coalesce(F.col("loss_metrics"), F.lit(None).cast(S.LOSS_METRICS))


def difficulty() -> Column:
    return number(F.col("loss_metrics.completion_difficulty"))


def worst_loss() -> Column:
    return number(F.col("loss_metrics.worst_loss"))


def critical_token() -> Column:
    return F.col("loss_metrics.critical_token")


def attr() -> Column:
    """The target's attribute; ``unknown`` if there is none."""
    return F.coalesce(non_blank(F.col("target.attr")), F.lit("unknown"))


def needed() -> Column:
    """Whether an entry takes part at all: markers of updates don't."""
    return attr() != S.UPDATED


def is_flip() -> Column:
    """The model's critical token differs from the right one; both must be known."""
    t = critical_token()
    return F.coalesce(t["pred_decoded_value"] != t["decoded_value"], F.lit(False))


def is_no_change() -> Column:
    return F.coalesce(F.endswith(F.col("prompt"), F.lit(S.NO_CHANGE + '" />')), F.lit(False))


def bucket(d: Column | None = None) -> Column:
    """high, medium, low or other; NaN, zero and less are other."""
    d = difficulty() if d is None else d
    known = F.when(F.isnan(d), "other").when(d > S.HIGH_DIFFICULTY, "high").when(d > S.MEDIUM_DIFFICULTY, "medium")
    return known.when(d > S.LOW_DIFFICULTY, "low").otherwise("other")


def file_of(entry_id: Column) -> Column:
    """The id's part before the first colon; null for a null or empty id."""
    return F.substring_index(non_blank(entry_id), ":", 1)


def clean_value(c: Column) -> Column:
    """A stat's value for people: unescaped; null if blank or unchanged."""
    v = strip(c)
    plain = F.replace(F.replace(F.replace(v, F.lit("\\\\"), F.lit("\\")), F.lit('\\"'), F.lit('"')), F.lit("\\'"), F.lit("'"))
    return F.when((v == "") | (v == S.NO_CHANGE), None).otherwise(plain)


def first_attr(attrs: Column, names: Iterable[str], default: Column) -> Column:
    """The first attribute of ``names`` that is not blank."""
    return F.coalesce(*[non_blank(strip(attrs[n])) for n in names], default)


def send_date(attrs: Column) -> Column:
    return first_attr(attrs, S.DATE_ATTRS, F.lit(""))


def speaker(attrs: Column, fallback: Column) -> Column:
    return first_attr(attrs, S.SPEAKER_ATTRS, fallback)


def truthy(c: Column) -> Column:
    return F.coalesce(F.lower(strip(c)).isin(S.MARK_WORDS), F.lit(False))


def parse_bool(c: Column) -> Column:
    """true, false, or null for anything else."""
    low = F.lower(strip(c))
    return F.when(low.isin(S.TRUE_WORDS), True).when(low.isin(S.FALSE_WORDS), False)


def roles(attrs: Column) -> Column:
    """struct<is_user, is_system> of a message's attributes."""
    role = F.lower(first_attr(attrs, S.ROLE_ATTRS, F.lit("")))
    return F.struct(((role == "user") | truthy(attrs["user"])).alias("is_user"), ((role == "system") | truthy(attrs["system"])).alias("is_system"))


def present(names: Column) -> Column:
    """Pictures of those present, each once, in order."""
    return F.array_distinct(F.transform(names, lambda n: F.concat(n, F.lit(".png"))))


def sort_metric(c: Column) -> Column:
    """A number to sort by; null, NaN and no number come last when descending."""
    d = c.try_cast("double")
    return F.when(d.isNull() | F.isnan(d), F.lit(float("-inf"))).otherwise(d)


def finite(c: Column) -> Column:
    d = c.try_cast("double")
    return F.coalesce(~F.isnan(d) & (F.abs(d) < float("inf")), F.lit(False))


def completion(prompt: Column) -> Column:
    """What follows the last ``="``; empty if there is none."""
    return F.when(F.instr(prompt, '="') == 0, F.lit("")).otherwise(F.substring_index(prompt, '="', -1))


def prefix(prompt: Column, name: Column) -> Column:
    """Up to and with the last ``name="``, else the last ``="``, else all."""

    named = F.concat(name, F.lit('="'))
    after_named = F.element_at(F.split(prompt, F.concat(F.lit(r"\Q"), named, F.lit(r"\E"))), -1)
    after_any = F.substring_index(prompt, '="', -1)
    whole = F.length(prompt)
    return (
        F.when(F.contains(prompt, named) & (name != ""), F.left(prompt, whole - F.length(after_named)))
        .when(F.contains(prompt, F.lit('="')), F.left(prompt, whole - F.length(after_any)))
        .otherwise(prompt)
    )


def text_length(*choices: Column) -> Column:
    """Characters of the first text that is not blank; 0 if none."""
    return F.coalesce(*[F.length(non_blank(c)) for c in choices], F.lit(0))


def token_length(text: Column, make_encode: Callable[[], Callable[[str], Sequence[int]]]) -> Column:
    """Tokens of a text by an encoder that is made once per worker's batch series; 0 for null."""

    @F.pandas_udf("int")
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = make_encode()
        for texts in batches:
            yield pd.Series([0 if t is None else len(encode(t)) for t in texts], dtype="int32")

    return F.coalesce(counted(non_blank(text)), F.lit(0))


def seed_of(key: Column) -> Column:
    """A number of the first eight hex digits of a key."""
    return F.conv(F.substring(key, 1, 8), 16, 10).cast("long")


def order_key(uid: Column, seed: int | Column) -> Column:
    """Where a row stands in the shuffle of a seed, on any cluster and in any SQL."""
    return F.sha1(F.concat_ws("#", uid.cast("string"), (F.lit(seed) if isinstance(seed, int) else seed).cast("string")))
