"""Writers: JSONL of entries, batches and chats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ENTRY_COLUMNS = ["prompt", "id", "source_id", "target", "loss_metrics", "expected_value", "original_subject_id"]


def jsonl(rows: DataFrame, path: str, *order: Column, single: bool = False, columns: list[str] | None = None) -> None:
    """Rows as JSON lines in ``order``; part files are in that order too. With ``single``
    one file is written, by one task: for results of known, small size."""
    shown = columns or [c for c in rows.columns if not c.startswith("_")]
    out = rows.orderBy(*order) if order else rows
    out = out.select(*shown)
    (out.coalesce(1) if single else out).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def entries(rows: DataFrame, path: str, *order: Column, single: bool = False) -> None:
    """Entries; original_subject_id is left out where it is null."""
    extra = [c for c in ("_is_padding_duplicate",) if c in rows.columns]
    line = F.to_json(F.struct(*ENTRY_COLUMNS[:-1], *extra), {"ignoreNullFields": "false"})
    subject = F.to_json(F.struct("original_subject_id"))
    whole = F.when(F.col("original_subject_id").isNull(), line).otherwise(F.concat(F.left(line, F.length(line) - 1), F.lit(","), F.substring(subject, 2, 1 << 30)))
    out = rows.orderBy(*order) if order else rows
    out = out.select(whole.alias("value"))
    (out.coalesce(1) if single else out).write.mode("overwrite").text(path)


def ascii_escaped(line: Column) -> Column:
    """A JSON line with every other character as ``\\uXXXX``."""
    chars = F.split(line, "")

    def shown(c: Column) -> Column:
        units = F.hex(F.encode(c, "UTF-16BE"))
        first, second = F.substring(units, 1, 4), F.substring(units, 5, 4)
        escaped = F.concat(F.lit("\\u"), F.lower(first), F.when(F.length(units) > 4, F.concat(F.lit("\\u"), F.lower(second))).otherwise(""))
        return F.when(F.octet_length(c) > 1, escaped).otherwise(c)

    return F.array_join(F.transform(chars, shown), "")


def clean(spark, path: str) -> None:
    """Delete a folder, wherever Spark can reach it."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
