"""Sinks: parquet, CSV, keyed upsert into partitioned parquet, dimension replace and run audit."""

from __future__ import annotations

import time
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from tidemark.operators.dedupe import pick_per_key
from tidemark.session import written


def parquet_sink(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def csv_sink(df: DataFrame, path: str, compression: str = "none") -> None:
    """Header CSV, quotes doubled, spaces kept; a folder of part files."""
    df.write.mode("overwrite").options(
        header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, compression=compression
    ).csv(path)


def upsert_rows(existing: DataFrame, batch: DataFrame, key: str, batch_order: Column) -> DataFrame:
    """Batch rows replace rows of equal key, new keys are added, other rows stay.

    A whole row is replaced, so a null in the batch overwrites. The last row of the batch wins. A
    null key is a key like others.
    """
    return _replaced(existing, pick_per_key(batch, [key], batch_order, last=True), key)


def _replaced(existing: DataFrame, newest: DataFrame, key: str) -> DataFrame:
    """``upsert_rows`` of a batch with one row per key."""
    newest = newest.select(*existing.columns)
    same = F.col(f"e.`{key}`").eqNullSafe(F.col(f"b.`{key}`"))
    return existing.alias("e").join(newest.select(key).alias("b"), same, "left_anti").unionByName(newest)


#: Buckets that a keyed table is dealt to by a hash of its key; one partition folder each.
BUCKETS = 64


def _bucket_column(key: str) -> str:
    return f"{key}_bucket"


def _dealt(df: DataFrame, key: str) -> DataFrame:
    return df.withColumn(_bucket_column(key), F.pmod(F.xxhash64(F.col(f"`{key}`")), F.lit(BUCKETS)).cast("int"))


def stored(spark: SparkSession, path: str) -> DataFrame | None:
    """A written table, or None where there is none yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def replace_keyed(df: DataFrame, path: str, key: str) -> None:
    """Full replace of a table by rows that have one row per key, partitioned by a hash of the key."""
    _dealt(df, key).repartition(_bucket_column(key)).write.mode("overwrite").partitionBy(_bucket_column(key)).parquet(path)


def ensure_key(spark: SparkSession, path: str, key: str, verify: bool = False) -> bool:
    """True if the stored table is partitioned by ``key``; ``verify`` also looks for keys with several rows."""
    table = stored(spark, path)
    if table is None or _bucket_column(key) not in table.columns:
        return False
    return not verify or table.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()


def read_keyed(spark: SparkSession, path: str, key: str) -> DataFrame:
    return spark.read.parquet(path).drop(_bucket_column(key))


def upsert(batch: DataFrame, path: str, key: str, batch_order: Column) -> bool:
    """Upsert a batch into a table; one that isn't partitioned by the key is rebuilt from the batch. True if rebuilt.

    Only the partitions that hold keys of the batch are read, joined and overwritten. The joined
    rows are written apart before they take the partitions' places, so that a failed run leaves the
    table as it was or can be run again with the same batch. One writer at a time; whether
    readers see partitions change one by one is up to the storage.
    """
    spark, bucket = batch.sparkSession, _bucket_column(key)
    newest = written(pick_per_key(batch, [key], batch_order, last=True), "batch")
    if not ensure_key(spark, path, key):
        if newest.isEmpty():
            newest.withColumn(bucket, F.lit(0)).write.mode("overwrite").parquet(path)  # keeps the schema
        else:
            replace_keyed(newest, path, key)
        return True
    table = spark.read.parquet(path)
    touched = [r[0] for r in _dealt(newest, key).select(bucket).distinct().collect()]  # BUCKETS numbers at most
    if touched:
        existing = table.where(F.col(bucket).isin(touched)).drop(bucket)
        merged = written(_dealt(_replaced(existing, newest, key), key), "merged")
        out = merged.repartition(bucket).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        out.partitionBy(bucket).parquet(path)
    return False


AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("stage_name", T.StringType()),
        T.StructField("scope", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("row_count_in", T.LongType()),
        T.StructField("row_count_out", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("duration_seconds", T.DoubleType()),
    ]
)


class StageRun:
    """Row counts of a running stage, taken by observation while the stage's own job runs."""

    def __init__(self) -> None:
        self._seen: dict[str, list[Observation]] = {"in": [], "out": []}

    def _count(self, df: DataFrame, side: str) -> DataFrame:
        seen = Observation()
        self._seen[side].append(seen)
        return df.observe(seen, F.count(F.lit(1)).alias("rows"))

    def count_in(self, df: DataFrame) -> DataFrame:
        return self._count(df, "in")

    def count_out(self, df: DataFrame) -> DataFrame:
        return self._count(df, "out")

    def total(self, side: str, wait: float = 5.0) -> int | None:
        """Rows counted; None if nothing was counted or a counted frame was never run.

        A count arrives shortly after its job, so an unfinished one is looked at again for a while.
        """
        seen, until = self._seen[side], time.monotonic() + wait
        while not all(o._jo is not None and o._jo.future().isCompleted() for o in seen):
            if time.monotonic() > until:
                return None
            time.sleep(0.05)
        return sum(o.get["rows"] for o in seen) if seen else None


@contextmanager
def run_audit(spark: SparkSession, audit_path: str, stage_name: str, scope: str, row_count_in: int | None = None):
    """Append one audit row per stage run; an error is recorded and raised again.

    Counts come from DataFrames wrapped with ``count_in``/``count_out``, which the body must
    write or otherwise run; pass ``row_count_in`` where the size is known beforehand.
    """
    run, status, start = StageRun(), "success", time.perf_counter()
    try:
        yield run
    except Exception:
        status = "failed"
        raise
    finally:
        # observed counts are only known when the observed job finished
        done = status == "success"
        seen_in = run.total("in") if done and row_count_in is None else row_count_in
        row = (
            stage_name, scope, datetime.now(timezone.utc), seen_in, run.total("out") if done else None,
            status, round(time.perf_counter() - start, 3),
        )
        spark.createDataFrame([row], AUDIT_SCHEMA).write.mode("append").parquet(audit_path)
