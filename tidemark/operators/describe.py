"""Descriptive statistics: distributions, concentration, segments, histograms, box statistics."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemark.functions.moments import skew_g1
from tidemark.functions.parse import month_of, round_coord, rows_of
from tidemark.operators.dedupe import pick_per_key
from tidemark.operators.ranking import group_quantiles, medians
from tidemark.operators.skew import spread_join

# Fixed values of the reports.
TOP_FRACTION = 0.10
HIGH_SCORE = 4.8
WHISKER = 1.5
HISTOGRAM_BINS = 50
MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]


def describe_numeric(df: DataFrame, column: str) -> DataFrame:
    """One row: count, share missing, mean, median, sample deviation, skew and 90th percentile."""
    x = F.col(column).cast("double")
    base = df.agg(
        F.count(x).alias("count"),
        (F.coalesce(F.try_divide(F.count_if(x.isNull()), F.count(F.lit(1))), F.lit(0.0)) * 100).alias("missing_pct"),
        F.avg(x).alias("mean"), F.stddev(x).alias("std"), skew_g1(x).alias("skew"),
    )
    q = group_quantiles(df, [], column, {"median": 0.5, "p90": 0.9})
    out = base.withColumn("_q", q.select(F.struct("median", "p90")).scalar())
    return out.select("*", "_q.median", "_q.p90").drop("_q")


def group_size(df: DataFrame, by: list[str], when: Column | None = None) -> DataFrame:
    """Rows per key (null keys left out), or rows that meet a condition per key."""
    counted = F.count(F.lit(1)) if when is None else F.count_if(F.coalesce(when, F.lit(False)))
    return df.dropna(subset=by).groupBy(*by).agg(counted.alias("rows"))


def freq_table(df: DataFrame, column: str) -> DataFrame:
    return group_size(df, [column])


def value_list(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull()).select(column).distinct().orderBy(column)


def median_by_group(df: DataFrame, by: list[str], column: str) -> DataFrame:
    return medians(df, by, column).drop("n")


def fixed_domain(spark: SparkSession, name: str, labels: list) -> DataFrame:
    """The label list as a table, with its order."""
    rows = [F.struct(F.lit(v).alias(name), F.lit(i).alias("position")) for i, v in enumerate(labels)]
    return spark.range(1).select(rows_of(*rows))


def align_to_domain(df: DataFrame, column: str, labels: list) -> DataFrame:
    """One row per label of a fixed list, in list order; a label without a row gets nulls."""
    domain = fixed_domain(df.sparkSession, column, labels)
    return domain.join(df, column, "left")


def means_by_segment(df: DataFrame, segment: str, metrics: list[str], order: list[str]) -> DataFrame:
    means = df.where(F.col(segment).isNotNull()).groupBy(segment).agg(*[F.avg(m).alias(m) for m in metrics])
    return align_to_domain(means, segment, order)


def degree_distribution(df: DataFrame, group: str) -> DataFrame:
    """For each size k, the number of groups of that size."""
    return group_size(df, [group]).groupBy(F.col("rows").alias("size")).agg(F.count(F.lit(1)).alias("groups"))


def concentration(df: DataFrame, group: str, fraction: float = TOP_FRACTION) -> DataFrame:
    """One row on how rows concentrate on groups, from the degree distribution alone.

    n rows have at most sqrt(2n) distinct group sizes, so the walk over sizes is tiny at any
    scale. The share of the top groups does not depend on how equal sizes are ordered.
    """
    sizes = degree_distribution(df, group).withColumn("_all", F.lit(0))
    up = Window.partitionBy("_all").orderBy("size").rowsBetween(Window.unboundedPreceding, 0)
    down = Window.partitionBy("_all").orderBy(F.desc("size")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("_all")
    walked = sizes.withColumns(
        {
            "_hosts": F.sum("groups").over(whole),
            "_upto": F.sum("groups").over(up),
            "_above": F.coalesce(F.sum("groups").over(down), F.lit(0)),
        }
    )
    top = F.greatest(F.lit(1), F.ceil(F.col("_hosts") * fraction)).cast("long")
    taken = F.greatest(F.lit(0), F.least(F.col("groups"), top - F.col("_above")))
    lower, upper = F.floor((F.col("_hosts") - 1) / 2), F.ceil((F.col("_hosts") - 1) / 2)
    out = walked.withColumns({"_top": top, "_taken": taken, "_lower": lower, "_upper": upper}).agg(
        F.max("_hosts").alias("n_groups"),
        F.sum(F.col("size") * F.col("groups")).alias("n_rows"),
        F.max("size").alias("max_rows"),
        F.max("_top").alias("top_groups"),
        F.sum(F.col("size") * F.col("_taken")).alias("_top_rows"),
        F.min(F.when(F.col("_upto") > F.col("_lower"), F.col("size"))).alias("_m1"),
        F.min(F.when(F.col("_upto") > F.col("_upper"), F.col("size"))).alias("_m2"),
    )
    return out.select(
        "n_groups", "n_rows",
        (F.col("n_rows") / F.col("n_groups")).alias("avg_rows"),
        F.floor((F.col("_m1") + F.col("_m2")) / 2).cast("long").alias("median_rows"),
        "max_rows", "top_groups",
        F.col("_top_rows").alias("top_rows"),
        (F.col("_top_rows") / F.col("n_rows") * 100).alias("top_share_pct"),
    )


def top_fraction(df: DataFrame, group: str, fraction: float = TOP_FRACTION) -> DataFrame:
    return concentration(df, group, fraction).select("top_groups", "top_rows", "top_share_pct")


def share_above(df: DataFrame, column: str, threshold: float = HIGH_SCORE) -> DataFrame:
    """One row over the scored rows: count, mean, median, share at or above the threshold."""
    x = F.col(column).cast("double")
    base = df.agg(
        F.count(x).alias("count"),
        (F.coalesce(F.try_divide(F.count_if(x.isNull()), F.count(F.lit(1))), F.lit(0.0)) * 100).alias("missing_pct"),
        F.avg(x).alias("mean"),
        (F.avg((x >= threshold).cast("double")) * 100).alias("share_pct"),
    )
    return base.withColumn("median", medians(df, [], column).select("median").scalar())


def host_counts(df: DataFrame, group: str, flag: str, row_key: str) -> DataFrame:
    """One row: groups with one row, with more, and by the flag of their first row."""
    known = df.where(F.col(group).isNotNull())
    sizes = known.groupBy(group).agg(F.count(F.lit(1)).alias("_n"), F.min_by(flag, row_key).alias("_flag"))
    # a null group has no size but, as one value among others, does have a first flag
    loose = df.where(F.col(group).isNull()).agg(F.min_by(flag, row_key).alias("_flag"))
    both = sizes.select("_n", "_flag").unionByName(loose.withColumn("_n", F.lit(0).cast("long")))
    return both.agg(
        F.count_if(F.col("_n") == 1).alias("single"),
        F.count_if(F.col("_n") >= 2).alias("multi"),
        F.count_if(F.coalesce(F.col("_flag") == "t", F.lit(False))).alias("flagged"),
        F.count_if(F.coalesce(F.col("_flag") == "f", F.lit(False))).alias("not_flagged"),
    )


def extreme_groups(df: DataFrame, group: str, column: str) -> DataFrame:
    """One row: groups with the highest and lowest median (ties: first in key order), overall median."""
    m = median_by_group(df, [group], column)
    out = m.agg(
        F.count(F.lit(1)).alias("n_groups"),
        F.min_by(F.struct(F.col(group).alias("g"), F.col("median").alias("m")), F.struct((-F.col("median")).alias("m"), F.col(group).alias("g"))).alias("_hi"),
        F.min_by(F.struct(F.col(group).alias("g"), F.col("median").alias("m")), F.struct(F.col("median").alias("m"), F.col(group).alias("g"))).alias("_lo"),
    )
    whole = medians(df, [], column).select("median").scalar()
    return out.select(
        "n_groups", F.col("_hi.g").alias("highest_group"), F.col("_hi.m").alias("highest_median"),
        F.col("_lo.g").alias("lowest_group"), F.col("_lo.m").alias("lowest_median"),
    ).withColumn("overall_median", whole)


def coordinate_ranges(df: DataFrame, lat: str, lon: str, value: str) -> DataFrame:
    """One row: complete and incomplete rows, and coordinate ranges of the complete ones."""
    complete = F.col(lat).isNotNull() & F.col(lon).isNotNull() & F.col(value).isNotNull()
    return df.agg(
        F.count_if(complete).alias("kept"),
        F.count_if(~complete).alias("dropped"),
        *[f(F.when(complete, F.col(c))).alias(f"{n}_{c}") for c in (lat, lon) for n, f in (("min", F.min), ("max", F.max))],
    )


def monthly_means(df: DataFrame, date: str, value: str) -> DataFrame:
    """Twelve rows: mean value per calendar month, null for a month without values."""
    months = (
        df.where(F.col(value).isNotNull() & F.col(date).isNotNull())
        .groupBy(month_of(F.col(date)).alias("month")).agg(F.avg(value).alias("mean"))
    )
    return align_to_domain(months, "month", list(range(1, 13))).drop("position")


def seasonal_trend(df: DataFrame, date: str, value: str) -> DataFrame:
    """One row: status, peak and lowest month (first on ties). ``unavailable`` without the column."""
    if value not in df.columns:
        empty = "CAST(NULL AS STRING) {0}_month, CAST(NULL AS DOUBLE) {0}_mean"
        return df.sparkSession.sql(f"SELECT 'unavailable' AS status, {empty.format('peak')}, {empty.format('lowest')}")
    m = monthly_means(df, date, value).where(F.col("mean").isNotNull())
    names = F.array(*[F.lit(n) for n in MONTHS])
    out = m.agg(
        F.min_by("month", F.struct((-F.col("mean")).alias("m"), F.col("month").alias("k"))).alias("_peak"),
        F.max("mean").alias("peak_mean"),
        F.min_by("month", F.struct(F.col("mean").alias("m"), F.col("month").alias("k"))).alias("_low"),
        F.min("mean").alias("lowest_mean"),
    )
    return out.select(
        F.lit("ok").alias("status"),
        F.element_at(names, F.col("_peak").cast("int")).alias("peak_month"), "peak_mean",
        F.element_at(names, F.col("_low").cast("int")).alias("lowest_month"), "lowest_mean",
    )


def _bin(x: Column, low: Column, width: Column, bins: int) -> Column:
    """Bin number of ``x`` among half-open bins, the last one closed, judged by the edges."""
    guess = F.least(F.floor((x - low) / width), F.lit(bins - 1)).cast("long")
    under = x < low + guess * width
    over = (x >= low + (guess + 1) * width) & (guess < bins - 1)
    return F.when(under, guess - 1).when(over, guess + 1).otherwise(guess)


def _fill_bins(counts: DataFrame, bins: int) -> DataFrame:
    every = counts.sparkSession.range(bins).withColumnRenamed("id", "bin")
    return every.join(counts, "bin", "left").withColumn("count", F.coalesce("count", F.lit(0)))


def histogram(df: DataFrame, column: str, bins: int = HISTOGRAM_BINS, log10: bool = False) -> DataFrame:
    """Equal-width bins between the smallest and largest value: bin (from 0), edges and count."""
    x = F.col(column).cast("double")
    values = df.select((F.when(x > 0, F.log10(x)) if log10 else x).alias("_x")).where("_x IS NOT NULL")
    ends = values.agg(F.min("_x").alias("a"), F.max("_x").alias("b"))
    flat = F.col("a") == F.col("b")
    ends = ends.select(
        F.when(flat, F.col("a") - 0.5).otherwise(F.col("a")).alias("lo"),
        F.when(flat, F.col("b") + 0.5).otherwise(F.col("b")).alias("hi"),
    ).select(F.struct("lo", ((F.col("hi") - F.col("lo")) / float(bins)).alias("step")))
    binned = values.withColumn("_e", ends.scalar())
    counts = binned.groupBy(_bin(F.col("_x"), F.col("_e.lo"), F.col("_e.step"), bins).alias("bin")).agg(
        F.count(F.lit(1)).alias("count")
    )
    full = _fill_bins(counts, bins).withColumn("_e", ends.scalar())
    edge = lambda k: F.col("_e.lo") + k * F.col("_e.step")
    return full.select("bin", edge(F.col("bin")).alias("low"), edge(F.col("bin") + 1).alias("high"), "count")


def histogram_fixed(df: DataFrame, column: str, start: float, stop: float, step: float) -> DataFrame:
    """Counts on the fixed edges start, start+step, … up to ``stop``; values outside are not counted."""
    bins = math.floor((stop - start) / step + 1e-9)
    low, width = F.lit(float(start)), F.lit(float(step))
    x = F.col(column).cast("double")
    inside = df.select(x.alias("_x")).where((F.col("_x") >= start) & (F.col("_x") <= start + bins * step))
    counts = inside.groupBy(_bin(F.col("_x"), low, width, bins).alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    return _fill_bins(counts, bins).select("bin", (low + F.col("bin") * width).alias("low"), "count")


def _box_rows(df: DataFrame, group: str, column: str, log10: bool) -> DataFrame:
    x = F.col(column).cast("double")
    v = F.when(x > 0, F.log10(x)) if log10 else x
    return df.withColumn("_x", v).where(F.col("_x").isNotNull() & F.col(group).isNotNull())


def _whiskers(rows: DataFrame, group: str) -> DataFrame:
    """Per group: quartiles, whiskers and rows beyond the fences, from counts per distinct value."""
    q = group_quantiles(rows, [group], "_x", {"q1": 0.25, "median": 0.5, "q3": 0.75})
    spread = (F.col("q3") - F.col("q1")) * WHISKER
    fences = q.withColumns({"_lo": F.col("q1") - spread, "_hi": F.col("q3") + spread})
    counts = rows.groupBy(group, "_x").agg(F.count(F.lit(1)).alias("_n"))
    inside = (F.col("_x") >= F.col("_lo")) & (F.col("_x") <= F.col("_hi"))
    stats = spread_join(counts, fences, group, "inner").groupBy(group).agg(
        *[F.max(c).alias(c) for c in ("n", "q1", "median", "q3")],
        F.min(F.when(inside, F.col("_x"))).alias("_a"), F.max(F.when(inside, F.col("_x"))).alias("_b"),
        F.coalesce(F.sum(F.when(~inside, F.col("_n"))), F.lit(0)).alias("outliers"),
    )
    return stats.withColumns({"whisker_low": F.least("_a", "q1"), "whisker_high": F.greatest("_b", "q3")})


def box_stats(df: DataFrame, group: str, column: str, log10: bool = False) -> DataFrame:
    """Per group: quartiles, whiskers at the furthest value within 1.5 IQR, number of outliers."""
    stats = _whiskers(_box_rows(df, group, column, log10), group)
    return stats.select(group, "n", "q1", "median", "q3", "whisker_low", "whisker_high", "outliers")


def box_outliers(df: DataFrame, group: str, column: str, log10: bool = False) -> DataFrame:
    """The rows beyond the whiskers of their group."""
    rows = _box_rows(df, group, column, log10)
    joined = spread_join(rows, _whiskers(rows, group).select(group, "whisker_low", "whisker_high"), group, "inner")
    beyond = (F.col("_x") < F.col("whisker_low")) | (F.col("_x") > F.col("whisker_high"))
    return joined.where(beyond).select(*df.columns)


def geo_points(df: DataFrame, lat: str, lon: str, value: str) -> DataFrame:
    """Complete rows with the value and its logarithm; null where it has none."""
    x = F.col(value).cast("double")
    return df.dropna(subset=[lat, lon, value]).select(lon, lat, value, F.when(x > 0, F.log10(x)).alias("log_value"))


def geo_grid(df: DataFrame, lat: str, lon: str, value: str, decimals: int = 2) -> DataFrame:
    """The same surface on a coordinate grid, for tables with too many points to draw."""
    points = geo_points(df, lat, lon, value)
    cell = [round_coord(F.col(c), decimals).alias(c) for c in (lat, lon)]
    return points.groupBy(*cell).agg(F.count(F.lit(1)).alias("points"), F.avg("log_value").alias("mean_log_value"))
