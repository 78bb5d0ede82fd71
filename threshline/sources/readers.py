"""Readers: texts, lists of files, JSONL, prompts, stat lines, synthetic prompts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threshline import schema as S
from threshline.functions.entries import non_blank, strip


def texts(spark: SparkSession, path: str, suffix: str = ".txt", recursive: bool = True) -> DataFrame:
    """(file, value): whole files whose name ends in ``suffix``, letter case aside."""
    reader = spark.read.option("recursiveFileLookup", str(recursive).lower())
    rows = reader.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("file"), "value")
    return rows.filter(F.endswith(F.lower("file"), F.lit(suffix.lower())))


def text_lines(spark: SparkSession, path: str, suffix: str) -> DataFrame:
    """(file, value): lines of all files below ``path`` with the suffix."""
    rows = spark.read.option("recursiveFileLookup", "true").text(path).select(F.col("_metadata.file_name").alias("file"), "value")
    return rows.filter(F.endswith(F.lower("file"), F.lit(suffix.lower())))


def flat_glob(path: str, suffix: str) -> str:
    """Files right in a folder, by an exact suffix."""
    return f"{path.rstrip('/')}/*{suffix}"


def _ordered(rows: DataFrame) -> DataFrame:
    """With _ord: file, then place in it; a file's splits come in their order."""
    return rows.withColumn("_ord", F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")))


def jsonl(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Entries of JSONL files; a line that is no JSON is an error. Blank lines are skipped."""
    return _ordered(spark.read.schema(S.ENTRY).option("mode", "FAILFAST").json(paths))


def jsonl_lenient(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Entries of JSONL files without the lines that are no JSON."""
    schema = T.StructType([*S.ENTRY.fields, T.StructField("_corrupt_record", T.StringType())])
    rows = _ordered(spark.read.schema(schema).option("mode", "PERMISSIVE").json(paths))
    # Spark reads the mark of a bad line only beside a column of the data.
    whole = F.col("_corrupt_record").isNull() & (F.col("prompt").isNull() | F.col("prompt").isNotNull())
    return rows.filter(whole).drop("_corrupt_record")


def prompts(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """Prompts of a JSONL file (prompt, text or input, the first that is not empty), or
    of any other file's lines that aren't blank."""
    if path.endswith(".jsonl"):
        rows = spark.read.schema("prompt string, text string, input string, _corrupt_record string").json(path)
        value = F.coalesce(non_blank(F.col("prompt")), non_blank(F.col("text")), non_blank(F.col("input")))
    else:
        rows = spark.read.text(path)
        value = strip(F.col("value"))
    found = _ordered(rows.withColumn("_value", value)).select(F.col("_value").alias("prompt"), "_ord").filter(F.coalesce(F.col("prompt") != "", F.lit(False)))
    return found if limit is None else found.orderBy("_ord").limit(limit)


def stat_lines(lines: DataFrame) -> DataFrame:
    """Lines that start a stats tag, stripped."""
    return lines.withColumn("value", strip(F.col("value"))).filter(F.startswith(F.col("value"), F.lit("<stats")))


def skipped_lines(lines: DataFrame) -> DataFrame:
    """How many lines that aren't blank are no stat lines."""
    v = strip(F.col("value"))
    return lines.agg(F.count_if((v != "") & ~F.startswith(v, F.lit("<stats"))).alias("skipped"))


def stub_prompts(spark: SparkSession, count: int, least: int = 8, most: int = 1024, seed: int = 42) -> DataFrame:
    """Made-up prompts whose lengths in words are spread by their logarithms; half begin
    with a ``key="value"`` pair. The same for a seed on any cluster."""

    def chance(salt: int):
        return F.conv(F.substring(F.sha1(F.concat_ws("#", F.col("id").cast("string"), F.lit(str(seed)), F.lit(str(salt)))), 1, 12), 16, 10).cast("double") / float(1 << 48)

    words = F.floor(F.exp(F.log(F.lit(float(least))) + chance(1) * (F.log(F.lit(most + 1.0)) - F.log(F.lit(float(least)))))).cast("int")
    text = F.array_join(F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), words)), lambda i: F.concat(F.lit("w"), ((F.col("id") * 31 + i * 7) % 997).cast("string"))), " ")
    head = F.when(chance(2) < 0.5, F.concat(F.lit('key="v'), F.col("id").cast("string"), F.lit('" '))).otherwise("")
    return spark.range(count).select("id", F.concat(head, text).alias("prompt"))
