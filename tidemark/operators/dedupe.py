"""One row per key, by aggregate: partial results are combined before the shuffle, so a key
that holds a large share of the rows costs no more than any other."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def pick_per_key(df: DataFrame, keys: list[str], order: Column, last: bool = False) -> DataFrame:
    """First (or last) row of each key in ``order``; null is a key like any other.

    ``order`` takes the place of file order and must be unique within a key.
    """
    rest = [c for c in df.columns if c not in keys]
    pick = F.max_by if last else F.min_by
    if not rest:
        return df.select(*keys).distinct()
    chosen = df.groupBy(*keys).agg(pick(F.struct(*rest), order).alias("_row"))
    return chosen.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def dedupe_first(df: DataFrame, keys: list[str], order: Column) -> DataFrame:
    return pick_per_key(df, keys, order)
