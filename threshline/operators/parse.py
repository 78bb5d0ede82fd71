"""Annotated dialogue text to datapoints, and datapoints to entries.

A file is one unit, as its blocks are told apart by what precedes them, so whole texts
are parsed in Python, many files at a time; all that follows is column functions.

What the parser accepts, and keeps on purpose:

- the next anchor after a block must open a previous message, else the file ends there;
- a previous message that isn't closed is skipped, with its open tag;
- it must be followed by a message, else it is skipped; an unclosed message likewise;
- a message directly after a message ends nothing: the state runs to the file's end;
- a block without state entities is skipped;
- attributes of a self-closing tag hold neither ``/`` nor ``>``; other tags are text;
- a tag's name starts with an ASCII letter and may hold hyphens.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from threshline import schema as S
from threshline.functions import entities as N

_OPEN = re.compile(S.ANCHOR_PATTERN)
_ATTR = re.compile(S.ATTR_PATTERN)
_TAG = re.compile(S.TAG_PATTERN)
_ANCHORS = {"previousMessage": "PreviousMessage", "message": "Message"}
#: Classes whose entities are context of an entity of the class.
CONTEXT = {"SceneStats": ("CharacterStats",)}
Warn = Callable[[str], None]


def _attrs(written: str) -> tuple[dict[str, str], list[str]]:
    pairs = _ATTR.findall(written)
    return dict(pairs), [k for k, _ in pairs]


def make_entity(tag: str, written: str) -> dict:
    """The entity of a self-closing tag: the first class of its tag that its attributes fit."""
    attrs, order = _attrs(written)
    made = {"cls": "GenericEntity", "family": "generic", "tag": tag, "subject": None, "attrs": attrs, "attr_order": order, "text": None}
    if tag == "augment":
        return made | {"cls": "Augment", "family": "entity", "tag": "entity"}
    for cls, key in S.TAGS.get(tag, ()):
        if attrs.get(key):
            rest = {k: v for k, v in attrs.items() if k != key}
            family = "stats" if cls in S.STATS_CLASSES else "character"
            return made | {"cls": cls, "family": family, "subject": {"key": key, "id": attrs[key]}, "attrs": rest, "attr_order": [k for k in order if k != key]}
    return made


def _anchor(tag: str, written: str, body: str) -> dict:
    attrs, order = _attrs(written)
    return {"cls": _ANCHORS[tag], "family": "anchor", "tag": tag, "subject": None, "attrs": attrs, "attr_order": order, "text": body}


def entities_in(span: str, warn: Warn = lambda _: None) -> list[dict]:
    """Entities of a span; of one identity the first, generic ones all."""
    out, seen = [], set()
    for tag, written in _TAG.findall(span):
        e = make_entity(tag, written)
        if e["cls"] != "GenericEntity":
            key = (e["cls"], *(e["subject"] or {}).values())
            if key in seen:
                warn(f"repeated entity {key}")
                continue
            seen.add(key)
        out.append(e)
    return out


def parse_text(text: str, file: str = "", warn: Warn = lambda _: None) -> Iterator[dict]:
    """The datapoints of one file's text, in order."""
    at, line, counted = 0, 1, 0
    while (previous := _OPEN.search(text, at)) and previous[1] == "previousMessage":
        close = text.find("</previousMessage>", previous.end())
        if close < 0:
            warn("a previous message is not closed")
            at = previous.end()
            continue
        after = close + len("</previousMessage>")
        message = _OPEN.search(text, after)
        if not message or message[1] != "message":
            warn("a previous message has no message")
            at = after
            continue
        end = text.find("</message>", message.end())
        if end < 0:
            warn("a message is not closed")
            at = message.end()
            continue
        rest = end + len("</message>")
        following = _OPEN.search(text, rest)
        at = following.start() if following and following[1] == "previousMessage" else len(text)
        state = entities_in(text[rest:at], warn)
        if not state:
            warn("a block has no state")
            continue
        line += text.count("\n", counted, previous.start())
        counted = previous.start()
        common = {
            "previous_message": _anchor("previousMessage", previous[2], text[previous.end() : close]),
            "message": _anchor("message", message[2], text[message.end() : end]),
            "previous_state": entities_in(text[after : message.start()], warn),
            "target": None, "source_id": f"{file}:{line}", "original_subject_id": None, "_file": file, "_line": line,
        }
        for i, e in enumerate(state):
            others = CONTEXT.get(e["cls"], ()) if len(state) > 1 else ()
            yield common | {"state": [e], "state_context": [o for o in state if o is not e and o["cls"] in others], "_part": i}


def parse(files: DataFrame, text: str = "value", name: str = "file") -> DataFrame:
    """Datapoints of whole texts; null texts have none. ``_file``, ``_line`` and ``_part``
    keep the order in which they were written."""
    arrow = to_arrow_schema(S.DATAPOINT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [r for t, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for r in parse_text(t or "", n or "")]
            for i in range(0, len(rows), 2000):
                yield pa.RecordBatch.from_pylist(rows[i : i + 2000], schema=arrow)

    return files.select(text, name).mapInArrow(run, S.DATAPOINT)


def warnings_of(files: DataFrame, text: str = "value", name: str = "file") -> DataFrame:
    """(file, warning) of everything that the parser skips."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[str, str]] = []
            for t, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for _ in parse_text(t or "", n or "", lambda w, n=n: out.append((n, w))):
                    pass
            yield pa.RecordBatch.from_pydict({"file": pa.array([x for x, _ in out], pa.string()), "warning": pa.array([x for _, x in out], pa.string())})

    return files.select(text, name).mapInArrow(run, "file string, warning string")


def to_entries(datapoints: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Entries as they are written to JSONL, with the order columns and those to ``keep``."""
    target, state, before = F.col("target"), F.col("state"), F.col("previous_state")
    original = F.coalesce(F.col("original_subject_id"), N.infer_subject(target, state, before, F.col("state_context")))
    prompted = datapoints.withColumn("prompt", N.prompt_of()).withColumn("_original", original)
    copies = [c for c in ("_copy",) if c in datapoints.columns]
    return prompted.select(
        "prompt", N.build_id(F.col("source_id"), F.col("_original"), target).alias("id"), "source_id", "target",
        F.lit(None).cast(S.LOSS_METRICS).alias("loss_metrics"), N.expected_value(target, state, before, F.col("prompt")).alias("expected_value"),
        F.col("_original").alias("original_subject_id"), F.lit(None).cast("string").alias("completion"), F.lit(None).cast("string").alias("response"),
        F.struct("_file", "_line", "_part", *copies).alias("_ord"), *keep,
    )


def to_raw(datapoints: DataFrame) -> DataFrame:
    """Datapoints in full, with each entity as written, for audits."""

    def shown(e):
        order = F.when(F.size(e["attr_order"]) > 0, e["attr_order"])
        return F.struct(e["cls"].alias("type"), e["family"], e["tag"], e["subject"], e["attrs"], order.alias("attr_order"), N.text_of(e).alias("rehydrated"), e["text"])

    one = [shown(F.col(c)).alias(c) for c in ("previous_message", "message")]
    many = [F.transform(c, shown).alias(c) for c in ("previous_state", "state_context", "state")]
    return datapoints.select(*one, *many, "target", "source_id", "original_subject_id")


def with_target(datapoints: DataFrame, **changes) -> DataFrame:
    """A copy with some columns changed, its original subject filled in."""
    original = F.coalesce("original_subject_id", N.infer_subject(F.col("target"), F.col("state"), F.col("previous_state"), F.col("state_context")))
    return datapoints.withColumn("original_subject_id", original).withColumns(changes)
