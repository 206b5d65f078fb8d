"""Helpers of this subpackage: whole texts as bytes inside tasks, staged tables, rows passed through."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, types as T

from tidemark.session import shared_dir

#: Rows and bytes of one Arrow batch; they bound what a Python worker holds of very long texts.
BATCH_ROWS, BATCH_BYTES = 1000, 16 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batch limits to this module's bounds; smaller settings stay."""
    for key, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        name = f"spark.sql.execution.arrow.{key}"
        now = int(spark.conf.get(name).removesuffix("b"))
        if now <= 0 or now > most:
            spark.conf.set(name, str(most))


def staged(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared folder and read again, so that later stages never redo earlier ones."""
    path = shared_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def pieces(batches: Iterator[pa.RecordBatch], column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut at rows so that the texts of each piece stay under ``limit`` bytes, one row at least."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends, start = np.cumsum(sizes, dtype=np.int64), 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def raw(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """Texts as UTF-8 bytes, nulls as empty ones."""
    return pc.fill_null(batch.column(column).cast(pa.binary()), b"").to_pylist()


class WordHashes(dict):
    """64-bit hashes of words, remembered up to ``most`` words."""

    def __init__(self, most: int = 300_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit integers, so that every output bit depends on every input bit."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def chained(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n-word windows that start at each word; the last n - 1 entries go past the end."""
    out = words.copy()
    for k in range(1, n):
        out = mixed(out) + np.roll(words, -k)
    return mixed(out)


def plus(schema: T.StructType, *fields: T.StructField) -> T.StructType:
    """A schema with fields appended, in place of fields of the same name."""
    new = {f.name for f in fields}
    return T.StructType([f for f in schema.fields if f.name not in new] + list(fields))


def appended(batch: pa.RecordBatch, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    """The batch with columns appended, in place of columns of the same name."""
    kept = [n for n in batch.schema.names if n not in columns]
    return pa.RecordBatch.from_arrays(
        [batch.column(n) for n in kept] + list(columns.values()), names=kept + list(columns)
    )
