"""Derived columns of the enriched entity table."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.moments import skew_g1
from tidemark.operators.ranking import medians
from tidemark.operators.skew import spread_join

# Fixed values of the data model.
DAYS_PER_YEAR = 365
DAYS_PER_MONTH = 30.44
SKEW_THRESHOLD = 1.0


def lookup_align(entities: DataFrame, key: str, counts: DataFrame, counts_key: str, columns: list[str]) -> DataFrame:
    """Counts per key put next to every entity row; an entity without counts gets 0."""
    side = counts.select(F.col(counts_key).alias("_key"), *columns)
    joined = entities.join(side, F.col(key) == F.col("_key"), "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in columns}).drop("_key")


def daily_counts(daily: DataFrame, key: str, flag: str, flag_value: str = "t") -> DataFrame:
    """Rows and flagged rows per entity; the daily table is reduced before it meets any join."""
    return daily.groupBy(key).agg(
        F.count(F.lit(1)).alias("total_days"),
        F.count_if(F.coalesce(F.col(flag) == flag_value, F.lit(False))).alias("available_days"),
    )


def occupancy_rate(
    entities: DataFrame, key: str, daily: DataFrame, daily_key: str, flag: str,
    days: int = DAYS_PER_YEAR, name: str = "occupancy_rate",
) -> DataFrame:
    """Share of days not available. Null without daily rows, 1 if none was available."""
    counts = daily_counts(daily, daily_key, flag)
    both = lookup_align(entities, key, counts, daily_key, ["total_days", "available_days"])
    rate = (F.lit(days) - F.col("available_days")) / F.lit(float(days))
    return both.withColumn(name, F.when(F.col("total_days") > 0, rate)).drop("total_days", "available_days")


def revenue_proxy(occupancy: Column, price: Column, days: int = DAYS_PER_YEAR) -> Column:
    return occupancy * days * price


def review_frequency(reviews: Column, first_review: Column, as_of: date) -> Column:
    """Reviews per month since the first one; 0 without a positive number of months."""
    months = F.datediff(F.lit(as_of), first_review) / F.lit(DAYS_PER_MONTH)
    return F.coalesce(reviews / F.when(months > 0, months), F.lit(0.0))


def tenure_years(since: Column, as_of: date) -> Column:
    return F.datediff(F.lit(as_of), since) / F.lit(float(DAYS_PER_YEAR))


def price_per_unit(price: Column, units: Column) -> Column:
    """Price over units, units floored at 1; null units give null."""
    return price / F.when(units < 1, F.lit(1.0)).otherwise(units)


def group_context(
    df: DataFrame, group: str, key: str, price: str, rating: str,
    names: tuple[str, str, str] = ("group_median_price", "group_density", "group_avg_rating"),
) -> DataFrame:
    """Median price, number of keys and mean rating of the row's group on every row."""
    middle = medians(df, [group], price, names[0]).drop("n")
    rest = df.where(F.col(group).isNotNull()).groupBy(group).agg(
        F.count(key).alias(names[1]), F.avg(rating).alias(names[2])
    )
    return spread_join(df, rest.join(middle, group, "left"), group).select(*df.columns, *names)


def binary_segment(df: DataFrame, key: str, group: str, many: str, one: str, name: str = "segment") -> DataFrame:
    """``many`` for rows whose group has at least two keys, else ``one``; no group means ``one``."""
    sizes = df.where(F.col(group).isNotNull()).groupBy(group).agg(F.count(key).alias("_size"))
    joined = spread_join(df, sizes, group)
    label = F.when(F.col("_size") >= 2, F.lit(many)).otherwise(F.lit(one))
    return joined.withColumn(name, label).select(*df.columns, name)


def log_target(df: DataFrame, price: str, name: str = "target", threshold: float = SKEW_THRESHOLD) -> DataFrame:
    """Adds the model target (log10 of positive prices if the price is skewed, else the price)
    and its ``<name>_kind``. The skew is a one-row subquery, so the plan stays lazy."""
    x = F.col(price).cast("double")
    skew = df.select(skew_g1(x).alias("skew")).scalar()
    out = df.withColumn("_skew", skew)
    logged = F.abs(F.col("_skew")) > threshold
    return out.withColumns(
        {
            name: F.when(logged, F.when(x > 0, F.log10(x))).otherwise(x),
            f"{name}_kind": F.when(logged, F.lit(f"log_{price}")).otherwise(F.lit(price)),
        }
    ).drop("_skew")


def rename_project(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return df.select(*[F.col(a).alias(b) for a, b in mapping.items()])


def top_k(df: DataFrame, by: Column | list[Column], k: int) -> DataFrame:
    """First k rows; each task keeps k rows. Pass a unique key last to make ties stable."""
    return df.orderBy(*(by if isinstance(by, list) else [by])).limit(k)


def drop_nulls(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return df.dropna(subset=columns)


def drop_nulls_report(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row: rows kept and rows dropped for a null in any of the columns."""
    columns = columns or df.columns
    bad = F.greatest(*[F.col(c).isNull().cast("int") for c in columns]) if len(columns) > 1 else F.col(columns[0]).isNull().cast("int")
    return df.agg(F.count_if(bad == 0).alias("kept"), F.count_if(bad == 1).alias("dropped"))
