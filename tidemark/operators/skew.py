"""A join of rows with per-group statistics that does not bind a group to one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Copies of the statistics, and tasks that the rows of one key are dealt to at least. With more than
#: one, what follows can't rely on a whole key lying in one task, so that adaptive execution is free
#: to split a partition further wherever it is large.
SALTS = 8


def spread_join(rows: DataFrame, stats: DataFrame, key: str, how: str = "left", also: Column | None = None, salts: int = SALTS) -> DataFrame:
    """Join rows with statistics that have one row per ``key``, or per key and what ``also`` compares.

    Rows are dealt by key and a salt that changes from row to row, equal rows included. A key of
    any weight, null included, goes to ``salts`` partitions, which the adaptive skew join cuts on into
    tasks of the advised size; it needs no list of hot keys and no pass that counts them. Statistics that turn out small are broadcast by Spark itself.
    """
    salted = rows.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int"))
    copies = stats.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    if also is None:
        return salted.join(copies, [key, "_salt"], how).drop("_salt")
    copies = copies.withColumnsRenamed({key: "_key", "_salt": "_copy"})
    return salted.join(copies, (F.col(key) == F.col("_key")) & (F.col("_salt") == F.col("_copy")) & also, how).drop("_salt", "_key", "_copy")
