"""Two-group and many-group tests. Moments, ranks and medians are distributed aggregates; only
one row per test, or per pair of groups, reaches the tail functions. Results are unrounded."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.tails import (
    f_sf, mann_whitney_p, normal_scores, shapiro_p, shapiro_w, studentized_range_quantile, studentized_range_table, t_two_sided, tabulated_tail, tail_udf,
)
from tidemark.operators.ranking import group_quantiles, numbered, order_statistics, rank_sums
from tidemark.operators.skew import spread_join

# Fixed values of the tests.
ALPHA = 0.05
SHAPIRO_MAX_N = 5000
BOOTSTRAP_ITERATIONS = 2000
BOOTSTRAP_SEED = 42
COHENS_D_THRESHOLDS = (0.2, 0.5, 0.8)
RANK_BISERIAL_THRESHOLDS = (0.1, 0.3, 0.5)
ETA_SQUARED_THRESHOLDS = (0.01, 0.06, 0.14)
DIGEST_GROUPS = 10


def effect_label(size: Column, thresholds: tuple[float, float, float]) -> Column:
    small, medium, large = thresholds
    x = F.abs(size)
    return (
        F.when(x < small, "negligible").when(x < medium, "small").when(x < large, "medium").when(x.isNotNull(), "large")
    )


def _observations(df: DataFrame, group: str, value: str, labels: list | None = None) -> DataFrame:
    """Rows (g, x) with both present; labels as text."""
    x = F.col(value).cast("double")
    keep = F.col(group).isNotNull() & x.isNotNull()
    if labels is not None:
        keep = keep & F.col(group).isin(labels)
    return df.where(keep).select(F.col(group).cast("string").alias("g"), x.alias("x"))


def group_moments(df: DataFrame, group: str, value: str, labels: list | None = None) -> DataFrame:
    """Per group: n, mean, sample variance, population skewness and excess kurtosis."""
    return _observations(df, group, value, labels).groupBy("g").agg(
        F.count("x").alias("n"), F.avg("x").alias("mean"), F.var_samp("x").alias("variance"),
        F.skewness("x").alias("skewness"), F.kurtosis("x").alias("excess_kurtosis"),
    )


def normality_moments(df: DataFrame, group: str, value: str, labels: list | None = None) -> DataFrame:
    """Per group: near-normal if skewness and excess kurtosis are close to 0."""
    m = group_moments(df, group, value, labels)
    near = (F.abs("skewness") < 0.5) & (F.abs("excess_kurtosis") < 1.0)
    return m.select("g", "n", "skewness", "excess_kurtosis", F.coalesce(near, F.lit(False)).alias("is_normal"))


def shapiro(df: DataFrame, group: str, value: str, labels: list | None = None) -> DataFrame:
    """Shapiro-Wilk W and p of every group, with a status: "tested", or "too few" or "too many" values.

    The test is for 3 to 5000 values; other groups have null W and p. Sizes are counted first, so
    no window ever holds more than 5000 values of a group.
    """
    rows = _observations(df, group, value, labels)
    sizes = rows.groupBy("g").agg(F.count("x").alias("n"), F.var_pop("x").alias("v"))
    small = sizes.where(F.col("n").between(3, SHAPIRO_MAX_N)).select("g", "n", (F.col("v") * F.col("n")).alias("ss"))
    # rows of large groups are spread, so that dropping them costs no single task
    ranked = spread_join(rows, small, "g", "inner").withColumn("i", F.row_number().over(Window.partitionBy("g").orderBy("x")))
    score = F.pandas_udf(normal_scores, "double")((F.col("i") - 0.375) / (F.col("n") + 0.25))
    scored = ranked.withColumn("m", score)

    def at(c: str, position: Column) -> Column:
        return F.max(F.when(F.col("i") == position, F.col(c)))

    n, one = F.col("n"), F.lit(1)
    sums = scored.groupBy("g", "n", "ss").agg(
        F.sum(F.col("m") * F.col("m")).alias("mm"), F.sum(F.col("m") * F.col("x")).alias("mx"),
        at("m", n).alias("m_last"), at("m", n - 1).alias("m_next"),
        at("x", one).alias("x1"), at("x", one + 1).alias("x2"), at("x", n - 1).alias("x_next"), at("x", n).alias("x_last"),
    )
    parts = ["n", "mm", "mx", "m_last", "m_next", "x1", "x2", "x_next", "x_last", "ss"]
    w = sums.select("g", "n", tail_udf(shapiro_w, *[F.col(c) for c in parts]).alias("w"))
    tested = w.withColumn("p_value", tail_udf(shapiro_p, F.col("w"), F.col("n"))).drop("n")
    status = F.when(F.col("n") < 3, "too few").when(F.col("n") > SHAPIRO_MAX_N, "too many").otherwise("tested")
    return sizes.select("g", "n", status.alias("status")).join(tested, "g", "left").select("g", "n", "w", "p_value", "status")


def normality(df: DataFrame, group: str, value: str, labels: list | None = None) -> DataFrame:
    """Per group: Shapiro-Wilk up to 5000 values, the moments rule beyond."""
    m = normality_moments(df, group, value, labels)
    s = shapiro(df, group, value, labels).select("g", "w", "p_value")
    large = F.col("n") > SHAPIRO_MAX_N
    return m.join(s, "g", "left").select(
        "g", "n",
        F.when(large, "skew_kurtosis").otherwise("shapiro").alias("method"),
        "w", "p_value", "skewness", "excess_kurtosis",
        F.when(large, F.col("is_normal")).otherwise(F.coalesce(F.col("p_value") > ALPHA, F.lit(False))).alias("is_normal"),
    )


def _one_way(moments: DataFrame, centre: Column) -> DataFrame:
    """One row from group moments (n, mean, variance): k, n, between and within sums of squares.

    The within sum comes from variances and the between sum from means shifted by a rough
    centre, so neither is a difference of large squares. Any centre is correct.
    """
    rows = moments.withColumn("_d", F.col("mean") - F.coalesce(centre, F.lit(0.0)))
    shift = F.sum(F.col("n") * F.col("_d"))
    out = rows.agg(
        F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"),
        F.greatest(F.sum(F.col("n") * F.col("_d") * F.col("_d")) - shift * shift / F.sum("n"), F.lit(0.0)).alias("ss_between"),
        F.sum((F.col("n") - 1) * F.col("variance")).alias("ss_within"),
    )
    df1, df2 = F.col("k") - 1, F.col("n") - F.col("k")
    f = F.try_divide(F.try_divide(F.col("ss_between"), df1), F.try_divide(F.col("ss_within"), df2))
    return out.withColumns({"df1": df1, "df2": df2, "f": f})


def _deviation_moments(rows: DataFrame, centre: Column, few: bool) -> DataFrame:
    """Per group: n, mean and variance of |x - group median|.

    Values are counted before they meet their median, so neither a hot group nor a hot value is
    more than its distinct values. Squares are taken around a rough centre.
    """
    med = group_quantiles(rows, ["g"], "x", {"median": 0.5}, few=few).select("g", "median")
    counts = rows.groupBy("g", "x").agg(F.count(F.lit(1)).alias("c"))
    joined = counts.join(F.broadcast(med), "g") if few else spread_join(counts, med, "g", "inner")
    z = joined.withColumn("d", F.abs(F.col("x") - F.col("median")) - F.coalesce(centre, F.lit(0.0)))
    c, d = F.col("c"), F.col("d")
    sums = z.groupBy("g").agg(F.sum("c").alias("n"), F.sum(c * d).alias("s"), F.sum(c * d * d).alias("ss"))
    n, mean = F.col("n"), F.col("s") / F.col("n")
    variance = F.coalesce(F.try_divide(F.greatest(F.col("ss") - n * mean * mean, F.lit(0.0)), n - 1), F.lit(0.0))
    return sums.select("g", "n", mean.alias("mean"), variance.alias("variance"))


def levene(df: DataFrame, group: str, value: str, labels: list | None = None, min_n: int = 1) -> DataFrame:
    """One row: median-centred Levene statistic and p over groups of at least ``min_n`` values."""
    rows = _observations(df, group, value, labels)
    # the mean absolute deviation of a bell curve is 0.8 of its standard deviation
    centre = rows.agg(F.stddev_pop("x") * 0.8).scalar()
    # the means are already relative to the centre
    z = _deviation_moments(rows, centre, few=labels is not None)
    w = _one_way(z.where(F.col("n") >= min_n), F.lit(0.0))
    return w.select(
        F.col("f").alias("statistic"), tail_udf(f_sf, F.col("f"), F.col("df1"), F.col("df2")).alias("p_value")
    ).withColumn("equal_variance", F.coalesce(F.col("p_value") > ALPHA, F.lit(False)))


def two_sample_moments(df: DataFrame, group: str, value: str, a, b) -> DataFrame:
    """One row: n, mean, variance of both samples; fewer than 3 values in one is an error."""
    rows = _observations(df, group, value, [a, b])
    aggs = []
    for side, label in (("a", a), ("b", b)):
        x = F.when(F.col("g") == str(label), F.col("x"))
        aggs += [F.count(x).alias(f"n_{side}"), F.avg(x).alias(f"mean_{side}"), F.var_samp(x).alias(f"var_{side}")]
    message = F.concat(
        F.lit("need at least 3 observations per group, got "), F.col("n_a").cast("string"), F.lit(" and "), F.col("n_b").cast("string")
    )
    checked = F.when((F.col("n_a") < 3) | (F.col("n_b") < 3), F.raise_error(message).cast("long")).otherwise(F.col("n_a"))
    return rows.agg(*aggs).withColumn("n_a", checked)


def cohens_d(n1: Column, n2: Column, m1: Column, m2: Column, v1: Column, v2: Column) -> Column:
    pooled = ((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2)
    return F.try_divide(m1 - m2, F.sqrt(pooled))


def rank_biserial(u: Column, n1: Column, n2: Column) -> Column:
    """Positive when the first sample ranks higher."""
    return u * 2 / (n1.cast("double") * n2) - 1


def _t_columns(moments: DataFrame) -> DataFrame:
    c = {k: F.col(k) for k in ("n_a", "n_b", "mean_a", "mean_b", "var_a", "var_b")}
    gap = c["mean_a"] - c["mean_b"]
    pooled = ((c["n_a"] - 1) * c["var_a"] + (c["n_b"] - 1) * c["var_b"]) / (c["n_a"] + c["n_b"] - 2)
    sa, sb = c["var_a"] / c["n_a"], c["var_b"] / c["n_b"]
    return moments.withColumns(
        {
            "t_student": F.try_divide(gap, F.sqrt(pooled * (1 / c["n_a"] + 1 / c["n_b"]))),
            "df_student": (c["n_a"] + c["n_b"] - 2).cast("double"),
            "t_welch": F.try_divide(gap, F.sqrt(sa + sb)),
            "df_welch": F.try_divide((sa + sb) * (sa + sb), sa * sa / (c["n_a"] - 1) + sb * sb / (c["n_b"] - 1)),
            "cohens_d": cohens_d(c["n_a"], c["n_b"], c["mean_a"], c["mean_b"], c["var_a"], c["var_b"]),
        }
    )


def t_test(df: DataFrame, group: str, value: str, a, b) -> DataFrame:
    """One row: Student's t if Levene sees equal variances, else Welch's, with Cohen's d."""
    even = levene(df, group, value, [a, b]).select("equal_variance").scalar()
    out = _t_columns(two_sample_moments(df, group, value, a, b)).withColumn("equal_variance", even)
    chosen = out.withColumns(
        {
            "t": F.when(F.col("equal_variance"), F.col("t_student")).otherwise(F.col("t_welch")),
            "df": F.when(F.col("equal_variance"), F.col("df_student")).otherwise(F.col("df_welch")),
        }
    )
    return chosen.select(
        F.when(F.col("equal_variance"), "Student's t-test").otherwise("Welch's t-test").alias("test_used"),
        "n_a", "n_b", "mean_a", "mean_b", "equal_variance", "t", "df",
        tail_udf(t_two_sided, F.col("t"), F.col("df")).alias("p_value"), "cohens_d",
        effect_label(F.col("cohens_d"), COHENS_D_THRESHOLDS).alias("magnitude"),
    )


def mann_whitney_u(df: DataFrame, group: str, value: str, a, b) -> DataFrame:
    """One row: U of the first sample, tie term, p and the rank-biserial effect size."""
    rows = _observations(df, group, value, [a, b])
    r = rank_sums(rows, [], "x", F.col("g") == str(a), F.col("g") == str(b))
    u = F.col("rank_sum_a") - F.col("n_a").cast("double") * (F.col("n_a") + 1) / 2
    out = r.withColumn("u", u).withColumn("effect_size", rank_biserial(F.col("u"), F.col("n_a"), F.col("n_b")))
    return out.select(
        "n_a", "n_b", "u", "tie_term",
        tail_udf(mann_whitney_p, F.col("u"), F.col("n_a"), F.col("n_b"), F.col("tie_term")).alias("p_value"),
        "effect_size", effect_label(F.col("effect_size"), RANK_BISERIAL_THRESHOLDS).alias("magnitude"),
    )


def _median_positions(side: int, seed: int):
    """Positions in the sorted sample of the middle values of one resample.

    A resample of size n picks uniform positions, so its middle is the floor of n times the
    middle order statistic of n uniforms, which is Beta distributed: one or two draws replace
    a resample of n values.
    """

    def draw(packed: pd.DataFrame) -> pd.DataFrame:
        low, high = [], []
        for rep, n in zip(packed["rep"], packed["n"]):
            rng, n, half = np.random.default_rng([seed, side, int(rep)]), int(n), int(n) // 2
            if n % 2:
                u = v = rng.beta(half + 1, half + 1)
            else:
                u = rng.beta(half, half + 1)
                v = u + (1 - u) * rng.beta(1, half)
            low.append(min(n - 1, int(u * n)))
            high.append(min(n - 1, int(v * n)))
        return pd.DataFrame({"low": low, "high": high})

    return F.pandas_udf(draw, "low long, high long")


def bootstrap_median_ci(
    df: DataFrame, group: str, value: str, a, b,
    iterations: int = BOOTSTRAP_ITERATIONS, ci: float = 0.95, seed: int = BOOTSTRAP_SEED,
) -> DataFrame:
    """One row: percentile bootstrap interval of the difference of medians, a minus b.

    The drawn positions lie within a few square roots of n around the middle. Only that band
    of each sample is ranked; neither the resamples nor the samples are materialised.
    """
    spark = df.sparkSession
    rows = _observations(df, group, value, [a, b])
    labels = {"a": str(a), "b": str(b)}

    def quote(text: str) -> str:
        return "'" + text.replace("\\", "\\\\").replace("'", "\\'").replace("{", "{{").replace("}", "}}") + "'"

    picks = None
    for i, label in enumerate(labels.values()):
        size = rows.where(F.col("g") == label).agg(F.count("x").alias("n")).scalar()
        drawn = spark.range(iterations, numPartitions=1).withColumn("n", size).where("n > 0")
        drawn = drawn.withColumn("_p", _median_positions(i, seed)(F.struct(F.col("id").alias("rep"), "n")))
        part = drawn.select(F.lit(label).alias("g"), F.col("id").alias("rep"), F.explode(F.array("_p.low", "_p.high")).alias("at"))
        picks = part if picks is None else picks.unionByName(part)

    ends = picks.groupBy("g").agg(F.min("at").alias("lo"), F.max("at").alias("hi"))

    def end(which: str) -> str:
        one = [f"WHEN g = {quote(v)} THEN (SELECT max({which}) FROM {{ends}} WHERE g = {quote(v)})" for v in labels.values()]
        return f"CASE {' '.join(one)} END"

    edges = order_statistics(rows, ["g"], "x", {"lo": end("lo"), "hi": end("hi")}, few=True, ends=ends)
    edges = edges.select(F.col("g").alias("_g"), "lo", "hi", "lo_below")
    band = rows.join(F.broadcast(edges), F.col("g") == F.col("_g")).where(F.col("x").between(F.col("lo"), F.col("hi")))
    counted = band.groupBy("g", "x").agg(F.count(F.lit(1)).alias("_n"), F.max("lo_below").alias("_below"))
    up = Window.partitionBy("g").orderBy("x").rowsBetween(Window.unboundedPreceding, -1)
    starts = counted.select(
        "g", (F.col("_below") + F.coalesce(F.sum("_n").over(up), F.lit(0))).alias("at"), F.lit(None).cast("long").alias("rep"), "x"
    )
    both = starts.unionByName(picks.select("g", "at", "rep", F.lit(None).cast("double").alias("x")))
    along = Window.partitionBy("g").orderBy(F.col("at"), F.col("rep").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    valued = both.withColumn("v", F.last("x", ignorenulls=True).over(along)).where(F.col("rep").isNotNull())
    gap = F.avg(F.when(F.col("g") == labels["a"], F.col("v"))) - F.avg(F.when(F.col("g") == labels["b"], F.col("v")))
    diffs = valued.groupBy("rep").agg(gap.alias("d"))
    tail = (1 - ci) / 2
    # one number per iteration
    return diffs.agg(F.percentile("d", tail).alias("ci_low"), F.percentile("d", 1 - tail).alias("ci_high"))


def two_group_test(df: DataFrame, group: str, value: str, a, b) -> DataFrame:
    """One row: the test that fits (t if both samples look normal, else Mann-Whitney), its p,
    effect size, group summaries, normality, Levene and the bootstrap interval of the medians,
    also turned to 'higher minus lower'."""
    rows = df.where(F.col(group).isin([a, b]))
    normal = normality(rows, group, value, [a, b])

    facts = F.struct("method", "w", "p_value", "skewness", "excess_kurtosis", "is_normal")
    checked = normal.agg(F.struct(*[F.max(F.when(F.col("g") == str(v), facts)).alias(s) for s, v in (("a", a), ("b", b))])).scalar()
    med = group_quantiles(_observations(rows, group, value, [a, b]), ["g"], "x", {"median": 0.5}, few=True)
    medians = med.agg(
        F.struct(*[F.max(F.when(F.col("g") == str(v), F.col("median"))).alias(s) for s, v in (("a", a), ("b", b))])
    ).scalar()
    lev = levene(rows, group, value, [a, b]).select(F.struct("statistic", "p_value", "equal_variance")).scalar()
    mw = mann_whitney_u(rows, group, value, a, b).select(F.struct("u", "p_value", "effect_size")).scalar()
    ci = bootstrap_median_ci(rows, group, value, a, b).select(F.struct("ci_low", "ci_high")).scalar()
    base = _t_columns(two_sample_moments(rows, group, value, a, b)).withColumns(
        {"levene": lev, "_checked": checked, "_med": medians, "_mw": mw, "_ci": ci}
    ).withColumns({"normality_a": F.col("_checked.a"), "normality_b": F.col("_checked.b")})
    even = F.col("levene.equal_variance")
    base = base.withColumns(
        {
            "_normal": F.col("normality_a.is_normal") & F.col("normality_b.is_normal"),
            "_t": F.when(even, F.col("t_student")).otherwise(F.col("t_welch")),
            "_df": F.when(even, F.col("df_student")).otherwise(F.col("df_welch")),
        }
    )
    base = base.withColumn("_tp", tail_udf(t_two_sided, F.col("_t"), F.col("_df")))
    normal_now = F.col("_normal")
    out = base.withColumns(
        {
            "test_used": F.when(~normal_now, "Mann-Whitney U").when(even, "Student's t-test").otherwise("Welch's t-test"),
            "test_statistic": F.when(normal_now, F.col("_t")).otherwise(F.col("_mw.u")),
            "p_value": F.when(normal_now, F.col("_tp")).otherwise(F.col("_mw.p_value")),
            "effect_size_type": F.when(normal_now, "cohens_d").otherwise("rank_biserial_correlation"),
            "effect_size": F.when(normal_now, F.col("cohens_d")).otherwise(F.col("_mw.effect_size")),
        }
    )
    first_higher = F.col("_med.a") > F.col("_med.b")
    return out.select(
        "test_used", "test_statistic", "p_value",
        (F.col("p_value") < ALPHA).alias("significant"),
        "effect_size_type", "effect_size",
        F.when(normal_now, effect_label(F.col("effect_size"), COHENS_D_THRESHOLDS))
        .otherwise(effect_label(F.col("effect_size"), RANK_BISERIAL_THRESHOLDS)).alias("effect_size_magnitude"),
        F.lit(str(a)).alias("group_a"), "n_a", "mean_a", F.col("_med.a").alias("median_a"),
        F.lit(str(b)).alias("group_b"), "n_b", "mean_b", F.col("_med.b").alias("median_b"),
        F.col("_ci.ci_low").alias("ci_low"), F.col("_ci.ci_high").alias("ci_high"),
        F.when(first_higher, str(a)).otherwise(str(b)).alias("higher_group"),
        F.when(first_higher, F.col("_ci.ci_low")).otherwise(-F.col("_ci.ci_high")).alias("higher_ci_low"),
        F.when(first_higher, F.col("_ci.ci_high")).otherwise(-F.col("_ci.ci_low")).alias("higher_ci_high"),
        "normality_a", "normality_b", "levene",
    )


def _usable_groups(df: DataFrame, group: str, value: str) -> DataFrame:
    """Moments of the groups with at least 2 values."""
    return group_moments(df, group, value).where(F.col("n") >= 2)


def _grand_mean(moments: DataFrame) -> Column:
    return moments.agg(F.try_divide(F.sum(F.col("n") * F.col("mean")), F.sum("n"))).scalar()


def anova(df: DataFrame, group: str, value: str) -> DataFrame:
    """One row: one-way ANOVA with eta squared and Levene; fewer than 2 usable groups is an error."""
    moments = _usable_groups(df, group, value)
    one = _one_way(moments, _grand_mean(moments))
    checked = F.when(F.col("k") < 2, F.raise_error(F.lit("need at least 2 groups with data")).cast("long")).otherwise(F.col("k"))
    total = F.col("ss_between") + F.col("ss_within")
    eta = F.when(total > 0, F.try_divide(F.col("ss_between"), total)).otherwise(F.lit(0.0))
    lev = levene(df, group, value, min_n=2).select(F.struct("statistic", "p_value", "equal_variance")).scalar()
    out = one.withColumns({"k": checked, "eta_squared": eta, "levene": lev})
    out = out.withColumn("p_value", tail_udf(f_sf, F.col("f"), F.col("df1"), F.col("df2")))
    return out.select(
        F.lit("One-way ANOVA").alias("test_used"), F.col("k").alias("n_groups"), F.col("n").alias("n_obs"),
        F.col("f").alias("f_statistic"), "p_value", (F.col("p_value") < ALPHA).alias("significant"),
        "ss_between", "ss_within", "eta_squared",
        effect_label(F.col("eta_squared"), ETA_SQUARED_THRESHOLDS).alias("magnitude"), "levene",
    )


def group_summary(df: DataFrame, group: str, value: str) -> DataFrame:
    """Per usable group: n, mean and median."""
    m = _usable_groups(df, group, value).select("g", "n", "mean")
    med = group_quantiles(_observations(df, group, value), ["g"], "x", {"median": 0.5}).drop("n")
    return m.join(med, "g")


def tukey_hsd(
    df: DataFrame, group: str, value: str, alpha: float = ALPHA, only_if_significant: bool = True
) -> DataFrame:
    """Per pair of groups: mean difference (second minus first), adjusted p, interval, reject.

    The result has a row per pair of groups by definition; it is built by an equi-join on group
    numbers over the written table of group moments, never over rows of the data, and the numbers come
    from ranges. The driver gets one row of sums; p is read off a table of the tail for this number of
    groups and degrees of freedom.
    """
    moments = numbered(_usable_groups(df, group, value).select("g", "n", "mean", "variance"), ["g"], "_i")
    one = _one_way(moments, _grand_mean(moments))
    fact = one.select("k", "df2", (F.try_divide("ss_within", "df2")).alias("mse"), tail_udf(f_sf, F.col("f"), F.col("df1"), F.col("df2")).alias("p")).first()
    spark, k, df2 = df.sparkSession, int(fact.k or 0), float(fact.df2 or 0)
    if k < 2 or df2 <= 0 or (only_if_significant and not (fact.p is not None and fact.p < alpha)):
        return spark.createDataFrame([], "group1 string, group2 string, meandiff double, q double, p_adj double, lower double, upper double, reject boolean")
    left = moments.where(F.col("_i") < k).select(
        F.col("g").alias("group1"), F.col("n").alias("_n1"), F.col("mean").alias("_m1"), F.explode(F.sequence(F.col("_i") + 1, F.lit(k).cast("long"))).alias("_i")
    )
    right = moments.select(F.col("g").alias("group2"), F.col("n").alias("_n2"), F.col("mean").alias("_m2"), "_i")
    se = F.sqrt(F.lit(fact.mse / 2) * (F.lit(1.0) / F.col("_n1") + F.lit(1.0) / F.col("_n2")))
    pairs = left.join(right, "_i").withColumns({"meandiff": F.col("_m2") - F.col("_m1"), "_se": se})
    pairs = pairs.withColumn("q", F.when(F.col("_se") > 0, F.abs("meandiff") / F.col("_se")).when(F.col("meandiff") != 0, float("inf")))
    half = F.col("_se") * studentized_range_quantile(alpha, k, df2)
    return pairs.select(
        "group1", "group2", "meandiff", "q", tabulated_tail(F.col("q"), studentized_range_table(k, df2)).alias("p_adj"),
        (F.col("meandiff") - half).alias("lower"), (F.col("meandiff") + half).alias("upper"),
        (F.abs("meandiff") > half).alias("reject"),
    )


def posthoc_digest(df: DataFrame, group: str, value: str) -> DataFrame:
    """One row: significant pairs, the most extreme one if there are many groups, and the groups
    with the highest and lowest mean."""
    pairs = tukey_hsd(df, group, value).where("reject")
    means = _usable_groups(df, group, value)
    top = means.agg(
        F.count(F.lit(1)).alias("n_groups"),
        F.min_by("g", F.struct((-F.col("mean")).alias("m"), "g")).alias("highest_group"), F.max("mean").alias("highest_mean"),
        F.min_by("g", F.struct("mean", "g")).alias("lowest_group"), F.min("mean").alias("lowest_mean"),
    )
    extreme = F.max_by(F.struct("group1", "group2", "meandiff", "p_adj"), F.struct(F.abs("meandiff").alias("d"), "group1", "group2"))
    digest = pairs.agg(F.struct(F.count(F.lit(1)).alias("n"), extreme.alias("pair"))).scalar()
    many = F.col("n_groups") > DIGEST_GROUPS
    whole = F.when(F.col("_d.pair").isNotNull(), F.col("_d.pair"))
    return top.withColumn("_d", digest).select(
        "n_groups", "highest_group", "highest_mean", "lowest_group", "lowest_mean",
        F.col("_d.n").alias("significant_pairs"),
        F.when(many, whole).alias("most_extreme_pair"),
    )
