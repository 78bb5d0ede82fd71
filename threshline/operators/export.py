"""Exports: chats, and stat lines for embeddings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threshline.functions import entities as N
from threshline.functions import entries as E

_SECTIONS = {"CharacterStats": "Characters", "SceneStats": "Scenes"}


def last_stats(datapoints: DataFrame) -> DataFrame:
    """(source_id, section, subject, attr, value): of every attribute the last clean value,
    in the order previous state, context, state, datapoint by datapoint."""
    parts = F.concat(*[F.transform(F.coalesce(c, F.array().cast(dict(datapoints.dtypes)[c])), lambda e, i=i: F.struct(F.lit(i).alias("p"), e.alias("e"))) for i, c in enumerate(("previous_state", "state_context", "state"))])
    rows = datapoints.select("source_id", "_part", F.posexplode(parts).alias("_i", "x"))
    rows = rows.filter(F.col("x.e.cls").isin(list(_SECTIONS)))
    rows = rows.select("source_id", "_part", "_i", F.when(F.col("x.e.cls") == "CharacterStats", "Characters").otherwise("Scenes").alias("section"), F.col("x.e.subject.id").alias("subject"), F.explode("x.e.attrs").alias("attr", "raw"))
    rows = rows.withColumn("value", E.clean_value(F.col("raw"))).filter("value IS NOT NULL")
    return rows.groupBy("source_id", "section", "subject", "attr").agg(F.max_by("value", F.struct("_part", "_i")).alias("value"))


def chats(datapoints: DataFrame) -> DataFrame:
    """One chat message per source: who spoke, what, who was there, and their stats."""
    one = datapoints.groupBy("source_id").agg(F.min_by(F.struct("message", "_file", "_line"), "_part").alias("m"))
    subject = last_stats(datapoints).groupBy("source_id", "section", "subject").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("attr", "value")))).alias("stats"))
    section = subject.groupBy("source_id").agg(
        *[F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("section") == s, F.struct("subject", F.to_json("stats")))))).alias(s) for s in _SECTIONS.values()]
    )
    joined = one.join(section, "source_id", "left")
    attrs = F.col("m.message.attrs")
    role = E.roles(attrs)
    nobody = F.create_map().cast("map<string,string>")
    people, scenes = F.coalesce("Characters", nobody), F.coalesce("Scenes", nobody)
    return joined.select(
        E.speaker(attrs, F.lit("Unknown")).alias("name"), role["is_user"].alias("is_user"), role["is_system"].alias("is_system"), E.send_date(attrs).alias("send_date"),
        F.coalesce("m.message.text", F.lit("")).alias("mes"), E.present(F.array_sort(F.map_keys(people))).alias("present"),
        F.array(F.struct(people.alias("Characters"), scenes.alias("Scenes"))).alias("stats"), F.concat(E.speaker(attrs, F.lit("Unknown")), F.lit(".png")).alias("force_avatar"),
        F.struct("m._file", "m._line").alias("_ord"), "source_id",
    )


def embedding_lines(lines: DataFrame) -> DataFrame:
    """Stat lines as prompts, their values wrapped."""
    return lines.select(N.wrap_values(F.col("value")).alias("prompt"))
