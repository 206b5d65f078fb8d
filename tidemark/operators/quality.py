"""Data quality: exact and fuzzy duplicates, IQR outliers, rule violations."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.moments import count_true
from tidemark.functions.parse import pct, round_coord, rows_of
from tidemark.operators.ranking import field_quantiles

# Fixed values of the checks.
PRICE_TOLERANCE = 0.05
IQR_MULTIPLIER = 1.5


def exact_duplicates(df: DataFrame, keys: list[str], check: str) -> DataFrame:
    """One row: rows in any key group of more than one row (all members counted)."""
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    out = groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total"),
        F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n"))), F.lit(0)).alias("count"),
    )
    return out.select(F.lit(check).alias("check"), "total", "count", pct(F.col("count"), F.col("total")).alias("pct"))


def exact_duplicate_checks(checks: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    return reduce(DataFrame.unionByName, [exact_duplicates(df, keys, name) for name, (df, keys) in checks.items()])


def fuzzy_duplicates(
    df: DataFrame, key: str, block: list[Column], price: str, tolerance: float = PRICE_TOLERANCE,
) -> DataFrame:
    """Rows chained by prices within ``tolerance`` of the pair mean inside one block.

    On positive prices the tolerance bounds the ratio of two prices, so sorted prices fall into
    runs and only neighbours matter. Prices in one logarithmic cell of half that ratio always
    belong together: each (block, cell) is combined to its extremes on the map side, and a block
    of any size has at most some 60 000 cells to walk. Zeros chain with zeros, negative prices
    with nothing. Adds ``fuzzy_group``, the smallest key of the chain.
    """
    if not 0 < tolerance < 2:
        raise ValueError("tolerance must lie between 0 and 2")
    cell_width = math.log((2 + tolerance) / (2 - tolerance)) / 2
    p = F.col(price)
    names = [f"_b{i}" for i in range(len(block))]
    known = reduce(lambda a, c: a & c.isNotNull(), block, p >= 0)
    cell = F.when(p > 0, F.floor(F.ln(p) / cell_width).cast("long")).otherwise(F.lit(-(10**9)).cast("long"))
    rows = df.where(known & ~F.isnan(p)).withColumns({**dict(zip(names, block)), "_cell": cell})
    cells = rows.groupBy(*names, "_cell").agg(
        F.min(price).alias("_low"), F.max(price).alias("_high"),
        F.count(F.lit(1)).alias("_n"), F.min(key).alias("_first"),
    )
    along = Window.partitionBy(*names).orderBy("_cell")
    before = F.lag("_high").over(along)
    mean = (before + F.col("_low")) / 2
    linked = (mean > 0) & (F.abs(before - F.col("_low")) / mean <= tolerance)
    start = F.when(linked, 0).otherwise(1)
    runs = cells.withColumn("_start", start).withColumn("_run", F.sum("_start").over(along))
    whole = Window.partitionBy(*names, "_run")
    chains = (
        runs.withColumns({"_members": F.sum("_n").over(whole), "fuzzy_group": F.min("_first").over(whole)})
        .where(F.col("_members") >= 2).select(*names, "_cell", "fuzzy_group")
    )
    return rows.join(chains, [*names, "_cell"]).select(*df.columns, "fuzzy_group")


def location_block(host: str, lat: str, lon: str, decimals: int = 4) -> list[Column]:
    return [F.col(host), round_coord(F.col(lat), decimals), round_coord(F.col(lon), decimals)]


def iqr_bounds(df: DataFrame, fields: list[str], multiplier: float = IQR_MULTIPLIER) -> DataFrame:
    """Rows (field, n, q1, q3, lower_bound, upper_bound)."""
    q = field_quantiles(df, [], fields, {"q1": 0.25, "q3": 0.75})
    spread = (F.col("q3") - F.col("q1")) * multiplier
    return q.withColumns({"lower_bound": F.col("q1") - spread, "upper_bound": F.col("q3") + spread})


def flag_outliers(
    df: DataFrame, fields: list[str], multiplier: float = IQR_MULTIPLIER, keep_bounds: bool = False
) -> DataFrame:
    """Every row with ``<field>_outlier`` flags; on a bound or null is not an outlier."""
    bounds = iqr_bounds(df, fields, multiplier)
    packed = bounds.agg(
        F.struct(
            *[F.max(F.when(F.col("field") == f, F.col("lower_bound"))).alias(f"{f}_lo") for f in fields],
            *[F.max(F.when(F.col("field") == f, F.col("upper_bound"))).alias(f"{f}_hi") for f in fields],
        ).alias("b")
    )
    out = df.withColumn("_b", packed.scalar())

    def outside(f: str) -> Column:
        x = F.col(f).cast("double")
        return F.coalesce((x < F.col(f"_b.{f}_lo")) | (x > F.col(f"_b.{f}_hi")), F.lit(False))

    flagged = out.withColumns({f"{f}_outlier": outside(f) for f in fields})
    return flagged if keep_bounds else flagged.drop("_b")


def iqr_outliers(df: DataFrame, fields: list[str], multiplier: float = IQR_MULTIPLIER) -> DataFrame:
    """Rows with at least one flag."""
    flagged = flag_outliers(df, fields, multiplier)
    return flagged.where(reduce(lambda a, b: a | b, [F.col(f"{f}_outlier") for f in fields]))


def iqr_summary(df: DataFrame, fields: list[str], multiplier: float = IQR_MULTIPLIER) -> DataFrame:
    """Per field: bounds to two decimals, evaluated values, outliers and their share."""
    flagged = flag_outliers(df, fields, multiplier, keep_bounds=True)
    aggs = [F.any_value("_b").alias("_b")]
    for i, f in enumerate(fields):
        aggs += [F.count(f).alias(f"e{i}"), F.count_if(f"{f}_outlier").alias(f"o{i}")]
    structs = [
        F.struct(
            F.lit(f).alias("field"),
            F.bround(F.col(f"_b.{f}_lo"), 2).alias("lower_bound"),
            F.bround(F.col(f"_b.{f}_hi"), 2).alias("upper_bound"),
            F.col(f"e{i}").alias("evaluated"),
            F.col(f"o{i}").alias("outlier_count"),
            pct(F.col(f"o{i}"), F.col(f"e{i}")).alias("outlier_pct"),
        )
        for i, f in enumerate(fields)
    ]
    return flagged.agg(*aggs).select(rows_of(*structs))


def rule_violations(df: DataFrame, rules: dict[str, tuple[Column, Column]]) -> DataFrame:
    """Per rule: rows evaluated, violations and their share, from one pass.

    A rule is (rows it applies to, rows that are fine); null in the second is a violation.
    """
    aggs = []
    for i, (applies, fine) in enumerate(rules.values()):
        aggs.append(count_true(applies).alias(f"e{i}"))
        aggs.append(count_true(applies & ~F.coalesce(fine, F.lit(False))).alias(f"v{i}"))
    structs = [
        F.struct(
            F.lit(name).alias("rule"), F.col(f"e{i}").alias("evaluated"), F.col(f"v{i}").alias("violations"),
            pct(F.col(f"v{i}"), F.col(f"e{i}")).alias("pct"),
        )
        for i, name in enumerate(rules)
    ]
    return df.agg(*aggs).select(rows_of(*structs))
