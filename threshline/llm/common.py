"""What the corpus operators share: shared-folder tables, sizes, text columns."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threshline.storage import cut_lineage as materialize
from threshline.storage import drop_tables, shared_dir, tables_written

__all__ = ["drop_tables", "materialize", "shared_dir", "tables_written"]


def text_bytes(docs: DataFrame, column: str = "text") -> int:
    """Total UTF-8 bytes of a text column, for choosing numbers of blocks."""
    return docs.agg(F.sum(F.octet_length(column))).first()[0] or 0


def crc_mod(column: str, mod: int) -> Column:
    """crc32 of the column as text, modulo ``mod``; null stays null."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % mod


def held_out(column: str, mod: int) -> Column:
    """True where crc32(id as text) mod ``mod`` is 2; a null id is never held out."""
    return F.coalesce(crc_mod(column, mod) == 2, F.lit(False))


def broadcast_if(df: DataFrame, rows: int, limit: int) -> DataFrame:
    """Broadcast ``df`` only if its counted rows stay within ``limit``."""
    return F.broadcast(df) if rows <= limit else df


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Rows handed to Python at once: long texts times the default would be too much."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


#: Bits of a filter at most: 16 MB to collect and to broadcast, whatever it is made of.
FILTER_BITS = 1 << 27


class LongFilter:
    """A Bloom filter of longs: it takes all its keys, and few others while it isn't full.

    It thins rows before an exact join, so it changes what is shuffled, never a result.
    """

    hashes = 4

    def __init__(self, bits: int, words: np.ndarray | None = None):
        self.bits, self.words = bits, words

    def places(self, keys: np.ndarray) -> np.ndarray:
        k = keys.view(np.uint64)[:, None]
        x = (k ^ (np.arange(1, self.hashes + 1, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))) * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(32)
        return x * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(20) & np.uint64(self.bits - 1)

    def takes(self, keys: np.ndarray) -> np.ndarray:
        p = self.places(np.ascontiguousarray(keys, np.int64))
        return (self.words[(p >> np.uint64(6)).astype(np.int64)] >> (p & np.uint64(63)) & np.uint64(1)).all(axis=1)


def filter_of(keys: DataFrame, column: str, n: int) -> LongFilter:
    """The filter of the ``n`` longs of a column; tasks set bits, Spark OR-s them."""
    made = LongFilter(min(FILTER_BITS, 1 << max(10, (12 * n).bit_length())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = np.unique(made.places(batch.column(0).to_numpy()))
            word, at = np.unique((p >> np.uint64(6)).astype(np.int64), return_index=True)
            bits = np.bitwise_or.reduceat(np.uint64(1) << (p & np.uint64(63)), at) if len(p) else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_pydict({"word": pa.array(word), "bits": pa.array(bits.view(np.int64))})

    got = keys.select(column).mapInArrow(run, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    words = np.zeros(made.bits // 64, np.uint64)
    words[got["word"].to_numpy()] = got["bits"].to_numpy().view(np.uint64)
    return LongFilter(made.bits, words)
