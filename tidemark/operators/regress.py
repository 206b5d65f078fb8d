"""Correlation matrix, design matrix, ordinary least squares and variance inflation.

Masked Gram products, added up over the tasks, reduce the data to sums per pair of columns; all
correlations, fits and inflation factors are read off them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.functions.moments import skew_g1
from tidemark.functions.tails import f_sf, t_two_sided
from tidemark.operators.derive import SKEW_THRESHOLD

# Fixed value of the report.
VIF_THRESHOLD = 5.0


def usable_columns(df: DataFrame, mapping: dict[str, str]) -> dict[str, str]:
    """Labels whose column exists and is not entirely null, by one aggregate over all of them."""
    present = {label: c for label, c in mapping.items() if c in df.columns}
    if not present:
        return {}
    counts = df.agg(*[F.count(c).alias(label) for label, c in present.items()]).first()
    return {label: c for label, c in present.items() if counts[label]}


SUMS = ["n", "sx", "sy", "sxx", "syy", "sxy"]


def pair_sums(rows: DataFrame, centres: list[float], complete: bool = False) -> DataFrame:
    """(i, j, SUMS) per pair i <= j of the columns of ``rows``: masked Gram products of each task's rows, added up.

    Sums are taken about the centres, over the rows where both columns have a finite value, or with
    ``complete`` over those where all have. A task passes on one row per pair, whatever its rows.
    """
    k, first, second = len(centres), *np.triu_indices(len(centres))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((6, len(first)))
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns]) if batch.num_rows else np.zeros((0, k))
            mask = np.isfinite(x)
            if complete:
                x, mask = x[mask.all(1)], mask[mask.all(1)]
            v, m = np.where(mask, x, centres) - centres, mask.astype(float)
            n, s, ss, xy = m.T @ m, v.T @ m, (v * v).T @ m, v.T @ v
            total += [g[first, second] for g in (n, s, s.T, ss, ss.T, xy)]
        yield pa.RecordBatch.from_arrays([pa.array(first, pa.int32()), pa.array(second, pa.int32()), *map(pa.array, total)], names=["i", "j", *SUMS])

    parts = rows.mapInArrow(run, "i int, j int, " + ", ".join(f"{c} double" for c in SUMS))
    return parts.groupBy("i", "j").agg(*(F.sum(c).alias(c) for c in SUMS))


def _spread(ss: str, s: str) -> Column:
    """Squared deviations from sums about a centre; none if what is left is rounding."""
    left = F.col(ss) - F.col(s) * F.col(s) / F.col("n")
    return F.when(left > 1e-13 * F.col(ss), left)


def corr_matrix(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rows (x, y, r): pairwise-complete Pearson correlation of the usable columns; null for a constant one.

    One pass finds the usable columns and their means, a second one takes all pairs from masked
    Gram products about the means. Values that aren't finite count as missing.
    """
    present = {label: c for label, c in mapping.items() if c in df.columns}
    if not present:
        return df.sparkSession.createDataFrame([], "x string, y string, r double")
    x = {label: F.col(c).cast("double") for label, c in present.items()}
    finite = {label: F.when(F.abs(c) < float("inf"), c) for label, c in x.items()}
    facts = df.agg(*(f(finite[label]).alias(f"{label}_{n}") for label in x for n, f in (("n", F.count), ("mean", F.avg), ("least", F.min), ("most", F.max)))).first()
    labels = [label for label in x if facts[f"{label}_n"]]
    centres = [facts[f"{c}_least"] if facts[f"{c}_least"] == facts[f"{c}_most"] else facts[f"{c}_mean"] for c in labels]
    if not labels:
        return df.sparkSession.createDataFrame([], "x string, y string, r double")
    sums = pair_sums(df.select(*(x[label].alias(f"x{i}") for i, label in enumerate(labels))), centres)
    both = F.sqrt(_spread("sxx", "sx")) * F.sqrt(_spread("syy", "sy"))
    r = (F.col("sxy") - F.col("sx") * F.col("sy") / F.col("n")) / both
    names = F.array(*map(F.lit, labels))
    half = sums.where("n > 0").select(names[F.col("i")].alias("x"), names[F.col("j")].alias("y"), F.when(r.isNotNull(), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r))).alias("r"))
    half = half.unionAll(sums.where("n = 0").select(names[F.col("i")], names[F.col("j")], F.lit(None).cast("double")))
    turned = F.array(F.struct("x", "y"), F.struct(F.col("y").alias("x"), F.col("x").alias("y")))
    return half.select(F.explode(F.array_distinct(turned)).alias("_p"), "r").select("_p.x", "_p.y", "r")


def category_levels(df: DataFrame, columns: list[str]) -> dict[str, list[str]]:
    """Sorted non-null levels per categorical column, in one pass. Each becomes a column of the design, so
    that pooling rare levels first is advised where there are thousands."""
    tall = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in columns]).unpivot([], columns, "column", "level") if columns else None
    found = tall.where("level IS NOT NULL").distinct().collect() if columns else []
    return {c: sorted(r.level for r in found if r.column == c) for c in columns}


def encode(df: DataFrame, predictors: list[str], drop_first: bool, keep: list[str] = ()) -> tuple[DataFrame, list[str], list[str]]:
    """Numeric predictors as doubles, others as 0/1 columns per level.

    Returns the frame, the names of its design columns and the predictors left out because the
    column is missing or entirely null. A null category is 0 in every level.
    """
    usable = usable_columns(df, {p: p for p in predictors})
    numeric = [p for p in usable if isinstance(df.schema[p].dataType, (T.NumericType, T.BooleanType))]
    levels = category_levels(df, [p for p in usable if p not in numeric])
    design = {}
    for p in predictors:
        if p in numeric:
            design[p] = F.col(p).cast("double")
        elif p in levels:
            for level in levels[p][1 if drop_first else 0 :]:
                hit = F.coalesce((F.col(p) == F.lit(level)).cast("double"), F.lit(0.0))
                design[f"{p}_{level}"] = hit
    out = df.select(*keep, *[c.alias(name) for name, c in design.items() if name not in keep])
    return out, list(design), [p for p in predictors if p not in usable]


def design_matrix(df: DataFrame, predictors: list[str], keep: list[str] = ()) -> tuple[DataFrame, list[str], list[str]]:
    """Design for a model with intercept: the first level in sorted order is the baseline."""
    return encode(df, predictors, True, keep)


def _quoted(c: str) -> str:
    return f"`{c}`"


@dataclass
class Moments:
    n: int
    mean: np.ndarray
    std: np.ndarray
    corr: np.ndarray


def complete_case_moments(df: DataFrame, columns: list[str]) -> Moments:
    """Means, deviations and correlations over rows without a missing value; constant columns correlate 0.

    The sums of all pairs come from one pass about rough means; the driver gets a number per pair of columns.
    """
    rows = df.select(*[F.col(_quoted(c)).cast("double").alias(f"x{i}") for i, c in enumerate(columns)])
    centres = rows.agg(*(F.avg(F.when(F.abs(c) < float("inf"), F.col(c))).alias(c) for c in rows.columns)).first()
    centres = [c or 0.0 for c in centres]
    found = pair_sums(rows, centres, complete=True).collect()
    n = int(found[0].n) if found else 0
    if n < 2:
        raise ValueError("fewer than 2 complete rows")
    k = len(columns)
    mean, cov = np.zeros(k), np.zeros((k, k))
    for r in found:
        mean[r.i] = r.sx / n
        cov[r.i, r.j] = cov[r.j, r.i] = (r.sxy - r.sx * r.sy / n) / (n - 1)
        if r.i == r.j and cov[r.i, r.i] * (n - 1) <= 1e-13 * r.sxx:
            cov[r.i, r.i] = 0.0
    std = np.sqrt(np.maximum(np.diag(cov), 0))
    with np.errstate(divide="ignore", invalid="ignore"):
        corr = cov / np.outer(std, std)
    corr = np.where(np.isfinite(corr), corr, 0.0)
    np.fill_diagonal(corr, 1.0)
    return Moments(n, mean + centres, std, np.clip(corr, -1, 1))


def vif_rows(moments: Moments, columns: list[str]) -> list[tuple[str, float, bool]]:
    """Diagonal of the inverse correlation matrix; a redundant column has no finite value."""
    k = len(columns)
    r = moments.corr[:k, :k]
    # a redundant column shows as a zero eigenvalue that it takes part in
    values, vectors = np.linalg.eigh(r)
    small = values < 1e-12 * max(values.max(), 1.0)
    inverse = (vectors[:, ~small] / values[~small]) @ vectors[:, ~small].T
    redundant = (np.abs(vectors[:, small]) > 1e-6).any(axis=1) if small.any() else np.zeros(k, bool)
    out = []
    for i, c in enumerate(columns):
        v = math.inf if redundant[i] else float(inverse[i, i])
        out.append((c, v, v > VIF_THRESHOLD))
    return out


def vif(df: DataFrame, columns: list[str]) -> DataFrame:
    m = complete_case_moments(df, columns)
    return df.sparkSession.createDataFrame(vif_rows(m, columns), "predictor string, vif double, flagged boolean")


@dataclass
class OlsFit:
    coefficients: DataFrame
    summary: DataFrame
    vif: DataFrame
    excluded: list[str]


def ols_fit(spark: SparkSession, m: Moments, columns: list[str]) -> tuple[list, dict]:
    """Least squares from moments of (columns, target last): coefficient rows and fit figures."""
    k = len(columns)
    live = [i for i in range(k) if m.std[i] > 0]
    sy, my = float(m.std[k]), float(m.mean[k])
    r_xx, r_xy = m.corr[np.ix_(live, live)], m.corr[live, k]
    inverse = np.linalg.pinv(r_xx, hermitian=True)
    rank = int(np.linalg.matrix_rank(r_xx, hermitian=True)) if live else 0
    beta = inverse @ r_xy
    sst = sy * sy * (m.n - 1)
    r2 = float(r_xy @ beta)
    df2 = m.n - rank - 1
    sigma2 = max(0.0, (1 - r2) * sst) / df2 if df2 > 0 else math.nan
    sx, mx = m.std[live], m.mean[live]
    coef = beta * sy / sx
    # covariance of the slopes, and of the intercept through the means
    cov = sigma2 * inverse / np.outer(sx, sx) / (m.n - 1)
    const = my - float(coef @ mx)
    const_var = sigma2 / m.n + float(mx @ cov @ mx)
    terms = [("const", const, const_var)] + [(columns[i], float(c), float(v)) for i, c, v in zip(live, coef, np.diag(cov))]
    rows = []
    for name, c, v in terms:
        se = math.sqrt(v) if v > 0 else None
        t = c / se if se else None
        rows.append((name, c, se, t, t_two_sided(t, df2) if t is not None and df2 > 0 else None))
    rows += [(columns[i], 0.0, None, None, None) for i in range(k) if i not in live]
    f = (r2 / rank) / ((1 - r2) / df2) if rank and df2 > 0 and r2 < 1 else None
    figures = {
        "n_obs": m.n, "r_squared": r2, "r_squared_adj": 1 - (1 - r2) * (m.n - 1) / df2 if df2 > 0 else None,
        "f_statistic": f, "f_pvalue": f_sf(f, rank, df2) if f is not None else None,
    }
    return rows, figures


def ols(df: DataFrame, predictors: list[str], target: str) -> OlsFit:
    """Least squares with intercept over complete rows, with VIF of every design column."""
    spark = df.sparkSession
    design, columns, excluded = design_matrix(df.withColumn("_y", F.col(target).cast("double")), predictors, ["_y"])
    total = design.count()
    m = complete_case_moments(design, [*columns, "_y"])
    rows, fit = ols_fit(spark, m, columns)
    coefficients = spark.createDataFrame(rows, "term string, coefficient double, std_error double, t double, p_value double")
    summary = spark.createDataFrame(
        [(target, fit["n_obs"], total - fit["n_obs"], fit["r_squared"], fit["r_squared_adj"], fit["f_statistic"], fit["f_pvalue"])],
        "target string, n_obs long, dropped_rows long, r_squared double, r_squared_adj double, f_statistic double, f_pvalue double",
    )
    vifs = spark.createDataFrame(vif_rows(m, columns), "predictor string, vif double, flagged boolean")
    return OlsFit(coefficients, summary, vifs, excluded)


def price_regression(df: DataFrame, predictors: list[str], price: str, threshold: float = SKEW_THRESHOLD) -> OlsFit:
    """OLS on the price, or on its logarithm where the price is skewed."""
    x = F.col(price).cast("double")
    skew = df.select(skew_g1(x)).first()[0]
    if skew is not None and abs(skew) > threshold:
        return ols(df.withColumn(f"log_{price}", F.when(x > 0, F.log10(x))), predictors, f"log_{price}")
    return ols(df, predictors, price)
