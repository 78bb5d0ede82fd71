"""New annotated texts as they arrive: an addition for jobs that never end.

Files are read as a stream, and every micro-batch goes through the same job as a whole
folder does. A batch is written under its number, so one that is run again after a
failure replaces what it wrote before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from threshline.plans import jobs


def watch_texts(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """(file, value) of whole text files below ``path``, as they come."""
    rows = spark.readStream.option("recursiveFileLookup", "true").option("maxFilesPerTrigger", files_per_batch).text(path, wholetext=True)
    return rows.select(F.col("_metadata.file_name").alias("file"), "value")


def prepare_stream(spark: SparkSession, path: str, out: str, checkpoint: str, options: jobs.Prepare | None = None, once: bool = False) -> StreamingQuery:
    """Entries of every new text, as Parquet below ``out``."""

    def write(batch: DataFrame, number: int) -> None:
        jobs.prepare(batch, options).drop("_ord").write.mode("overwrite").parquet(f"{out}/batch={number}")

    stream = watch_texts(spark, path).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (stream.trigger(availableNow=True) if once else stream).start()
