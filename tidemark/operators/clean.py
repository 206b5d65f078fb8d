"""Cleaning operators. Group statistics are joined back without a broadcast hint, so Spark
broadcasts them only when their measured size allows; otherwise hot groups are spread."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions import parse
from tidemark.functions.moments import count_true
from tidemark.operators.ranking import field_quantiles
from tidemark.operators.skew import spread_join


def parse_currency(df: DataFrame, columns: list[str]) -> DataFrame:
    """Currency text to doubles, for those of the columns that exist."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: parse.parse_currency(F.col(c)) for c in present}) if present else df


def parse_dates(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: parse.parse_date(F.col(c)) for c in columns})


def parse_percent(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: parse.parse_percent(F.col(c)) for c in columns})


def normalise_text(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: parse.normalise_text(F.col(c)) for c in columns})


def pool_rare(
    df: DataFrame, column: str, min_count: int = 10, label: str = "Other", source: DataFrame | None = None
) -> DataFrame:
    """Categories with fewer than ``min_count`` rows become one label; null stays null.

    ``source`` is an earlier frame with the same rows to count on, which spares the counting the
    joins that ``df`` has since been through.
    """
    counted = df if source is None else source
    rare = (
        counted.where(F.col(column).isNotNull()).groupBy(column)
        .agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") < min_count)
    )
    joined = spread_join(df, rare, column)
    pooled = F.when(F.col("_rows").isNotNull(), F.lit(label)).otherwise(F.col(column))
    return joined.withColumn(column, pooled).select(*df.columns)


def impute_group_median(
    df: DataFrame, group: str, columns: list[str], source: DataFrame | None = None
) -> DataFrame:
    """Null becomes the median of the column within the row's group.

    Rows without a group and groups without any value keep their nulls. ``source`` is an earlier
    frame with the same rows to take the medians from.
    """
    middle = field_quantiles(df if source is None else source, [group], columns, {"m": 0.5})
    wide = middle.groupBy(group).agg(
        *[F.max(F.when(F.col("field") == c, F.col("m"))).alias(f"_m_{c}") for c in columns]
    )
    joined = spread_join(df, wide, group)
    filled = {c: F.coalesce(F.col(c).cast("double"), F.col(f"_m_{c}")) for c in columns}
    return joined.withColumns(filled).select(*df.columns)


def trim_column(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, parse.strip(F.col(column)))


def unmatched_values(df: DataFrame, column: str, lookup: DataFrame, lookup_column: str) -> DataFrame:
    """Trimmed values that the lookup does not have, with row counts (null counts as unmatched)."""
    counted = df.groupBy(parse.strip(F.col(column)).alias(column)).agg(F.count(F.lit(1)).alias("rows"))
    known = lookup.select(F.col(lookup_column).alias("_known")).distinct()
    return counted.join(known, F.col(column).eqNullSafe(F.col("_known")), "left_anti")


def conform_lookup(df: DataFrame, column: str, lookup: DataFrame, lookup_column: str, sample: int = 10) -> DataFrame:
    """One row: number of rows outside the lookup and the first distinct offenders in order."""
    missing = unmatched_values(df, column, lookup, lookup_column)
    total = missing.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("unmatched_rows"))
    head = missing.where(F.col(column).isNotNull()).orderBy(column).limit(sample)
    listed = head.agg(F.array_join(F.array_sort(F.collect_list(column)), "|").alias("s"))
    return total.withColumn("sample", listed.scalar())


def range_rules(ranges: dict[str, tuple[float, float]], optional_min: dict[str, float]) -> dict[str, Column]:
    """Validity per rule, never null: a missing value breaks a range rule, not an optional minimum."""
    rules = {c: F.coalesce(F.col(c) >= low, F.lit(True)) for c, low in optional_min.items()}
    for c, (low, high) in ranges.items():
        rules[c] = F.coalesce(F.col(c).between(low, high), F.lit(False))
    return rules


def validate_keep(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows that pass every rule."""
    return df.where(reduce(lambda a, b: a & b, rules.values()))


def validate_report(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """One row: rows seen, rows dropped and failures per rule (a row may fail several)."""
    passed = reduce(lambda a, b: a & b, rules.values())
    failed = [count_true(~rule).alias(f"failed_{name}") for name, rule in rules.items()]
    return df.agg(F.count(F.lit(1)).alias("rows"), count_true(~passed).alias("dropped"), *failed)


def with_membership(df: DataFrame, column: str, lookup: DataFrame, name: str = "known") -> DataFrame:
    """The rows with whether their value stands in the lookup's first column; null stands in none.

    One pass over the rows for both sides of the question. Rows are spread whatever their value, so that
    a hot one, or null in half of the rows, binds no task.
    """
    values = lookup.select(F.col(f"`{lookup.columns[0]}`").alias(column)).where(F.col(column).isNotNull()).distinct()
    marked = spread_join(df.drop(name), values.withColumn(name, F.lit(True)), column)
    return marked.select(*df.drop(name).columns, F.coalesce(name, F.lit(False)).alias(name))
