"""Hypothesis tests. p values are checked against SQL that integrates the densities."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.common import query, role, rounded, table
from tidemark.operators import hypothesis as h


def beta_tail(x: str, a: str, b: str, steps: int = 4000) -> str:
    """I_x(a, b) in SQL by Simpson's rule on t = x exp(-s/a)."""
    weight = f"CASE WHEN i.range IN (0, {steps}) THEN 1 WHEN i.range % 2 = 1 THEN 4 ELSE 2 END"
    s = f"(i.range * 60e0 / {steps})"
    return f"""(SELECT SUM({weight} * exp(({a}) * ln({x}) + lgamma(({a}) + ({b})) - lgamma({a}) - lgamma({b}) - {s})
                   * pow(1 - ({x}) * exp(-{s} / ({a})), ({b}) - 1)) * 60e0 / {steps} / 3 / ({a}) FROM range(0, {steps + 1}) i)"""


def f_tail(f: str, d1: str, d2: str) -> str:
    return beta_tail(f"({d2}) / (({d2}) + ({d1}) * ({f}))", f"({d2}) / 2e0", f"({d1}) / 2e0")


def normal_tail(z: str, steps: int = 4000) -> str:
    weight = f"CASE WHEN i.range IN (0, {steps}) THEN 1 WHEN i.range % 2 = 1 THEN 4 ELSE 2 END"
    at = f"(({z}) + i.range * 12e0 / {steps})"
    return f"(SELECT SUM({weight} * exp(-{at} * {at} / 2)) * 12e0 / {steps} / 3 / sqrt(2 * pi()) FROM range(0, {steps + 1}) i)"


def t_tail(t: str, df: str, steps: int = 4000) -> str:
    """Two-sided tail of Student's t as one minus the mass between -t and t."""
    weight = f"CASE WHEN i.range IN (0, {steps}) THEN 1 WHEN i.range % 2 = 1 THEN 4 ELSE 2 END"
    at = f"(abs({t}) * i.range / {steps}e0)"
    density = f"exp(lgamma((({df}) + 1) / 2e0) - lgamma(({df}) / 2e0) - (({df}) + 1) / 2e0 * ln(1 + {at} * {at} / ({df}))) / sqrt(pi() * ({df}))"
    return f"(SELECT 1 - 2 * SUM({weight} * {density}) * abs({t}) / {steps} / 3 FROM range(0, {steps + 1}) i)"


PAIR = "SELECT event_type AS g, value AS x FROM {events} WHERE event_type IN ('click', 'view') AND value IS NOT NULL"
MOMENTS = f"""SELECT COUNT(x) FILTER (WHERE g = 'click') AS n1, COUNT(x) FILTER (WHERE g = 'view') AS n2, AVG(x) FILTER (WHERE g = 'click') AS m1,
    AVG(x) FILTER (WHERE g = 'view') AS m2, var_samp(x) FILTER (WHERE g = 'click') AS v1, var_samp(x) FILTER (WHERE g = 'view') AS v2 FROM ({PAIR}) p"""
ARGS = ("event_type", "value", "click", "view")


def label(x: str, small: float, medium: float, large: float) -> str:
    return f"CASE WHEN abs({x}) < {small}e0 THEN 'negligible' WHEN abs({x}) < {medium}e0 THEN 'small' WHEN abs({x}) < {large}e0 THEN 'medium' ELSE 'large' END"


@query("h1_normality_moments", """
    SELECT event_type AS g, COUNT(*) AS n, round(skewness(value) * (n - 2) / sqrt(n * (n - 1)), 6) AS skewness, round(kurtosis_pop(value), 6) AS excess_kurtosis,
           abs(skewness(value) * (n - 2) / sqrt(n * (n - 1))) < 0.5 AND abs(kurtosis_pop(value)) < 1 AS is_normal FROM {events} GROUP BY event_type
    UNION ALL SELECT l_returnflag, COUNT(*) AS n, round(skewness(l_quantity) * (n - 2) / sqrt(n * (n - 1e0)), 6), round(kurtosis_pop(l_quantity), 6),
           abs(skewness(l_quantity) * (n - 2) / sqrt(n * (n - 1e0))) < 0.5 AND abs(kurtosis_pop(l_quantity)) < 1 FROM {lineitem} GROUP BY l_returnflag""")
def normality_moments(spark, sf):
    both = h.normality_moments(table(spark, sf, "events"), "event_type", "value").unionByName(
        h.normality_moments(table(spark, sf, "lineitem"), "l_returnflag", "l_quantity")
    )
    return rounded(both, 6, "skewness", "excess_kurtosis")


# W and its p follow published approximations; their bounds and the method of each group are what SQL says.
@query("h1_normality", """
    SELECT event_type AS g, COUNT(value) AS n, CASE WHEN COUNT(value) > 5000 THEN 'skew_kurtosis' ELSE 'shapiro' END AS method,
           COUNT(value) BETWEEN 3 AND 5000 AS tested, true AS bounded FROM {events} GROUP BY event_type""")
def normality(spark, sf):
    out = h.normality(table(spark, sf, "events"), "event_type", "value")
    bounded = F.col("w").isNull() | (F.col("w").between(0, 1) & F.col("p_value").between(0, 1) & ((F.col("p_value") > h.ALPHA) == F.col("is_normal")))
    return out.select("g", "n", "method", F.col("w").isNotNull().alias("tested"), bounded.alias("bounded"))


@query("h2_shapiro_wilk", """
    SELECT CAST(o_custkey AS VARCHAR) AS g, COUNT(o_totalprice) AS n,
           CASE WHEN COUNT(o_totalprice) < 3 THEN 'too few' WHEN COUNT(o_totalprice) > 5000 THEN 'too many' ELSE 'tested' END AS status, true AS bounded
    FROM {orders} GROUP BY o_custkey""")
def shapiro_wilk(spark, sf):
    out = h.shapiro(table(spark, sf, "orders"), "o_custkey", "o_totalprice")
    bounded = F.when(F.col("status") == "tested", F.col("w").between(0, 1) & F.col("p_value").between(0, 1)).otherwise(F.col("w").isNull())
    return out.select("g", "n", "status", F.coalesce(bounded, F.lit(False)).alias("bounded"))


# For three values W has a closed form: half the squared range over the sum of squares.
@query("h2_shapiro_of_three", """
    SELECT CAST(o_custkey AS VARCHAR) AS g, round(power(MAX(o_totalprice) - MIN(o_totalprice), 2) / 2 / (var_pop(o_totalprice) * 3), 8) AS w
    FROM {orders} GROUP BY o_custkey HAVING COUNT(*) = 3""")
def shapiro_of_three(spark, sf):
    return rounded(h.shapiro(table(spark, sf, "orders"), "o_custkey", "o_totalprice").where("n = 3").select("g", "w"), 8, "w")


@query("h3_mann_whitney_u", f"""
    WITH r AS (SELECT g, x, rank() OVER (ORDER BY x) + (COUNT(*) OVER (PARTITION BY x) - 1) / 2e0 AS rk FROM ({PAIR}) p),
         t AS (SELECT CAST(SUM(n * n * n - n) AS DOUBLE) AS tie FROM (SELECT COUNT(*) AS n FROM ({PAIR}) p GROUP BY x) c),
         s AS (SELECT COUNT(*) FILTER (WHERE g = 'click') AS n1, COUNT(*) FILTER (WHERE g = 'view') AS n2, SUM(rk) FILTER (WHERE g = 'click') AS r1 FROM r),
         u AS (SELECT n1, n2, r1 - n1 * (n1 + 1) / 2e0 AS u, tie FROM s, t),
         z AS (SELECT *, (greatest(u, n1 * n2 - u) - n1 * n2 / 2e0 - 5e-1) / sqrt(n1 * n2 / 12e0 * ((n1 + n2 + 1) - tie / ((n1 + n2) * (n1 + n2 - 1e0)))) AS z, 2e0 * u / (n1 * n2) - 1 AS e FROM u)
    SELECT n1 AS n_a, n2 AS n_b, u, tie AS tie_term, round(least(1, 2 * {normal_tail("z")}), 7) AS p_value, round(e, 9) AS effect_size, {label("e", 0.1, 0.3, 0.5)} AS magnitude FROM z""")
def mann_whitney_u(spark, sf):
    return rounded(rounded(h.mann_whitney_u(table(spark, sf, "events"), *ARGS), 7, "p_value"), 9, "effect_size")


LEVENE = """WITH x AS ({rows}), z AS (SELECT g, abs(x - median(x) OVER (PARTITION BY g)) AS z FROM x),
    m AS (SELECT g, COUNT(*) AS n, AVG(z) AS m, coalesce(var_samp(z), 0) AS v FROM z GROUP BY g),
    o AS (SELECT COUNT(*) AS k, SUM(n) AS n, SUM(n * m) / SUM(n) AS gm FROM m)
    SELECT any_value(k) - 1 AS d1, any_value(o.n) - any_value(k) AS d2, (SUM(m.n * (m - gm) * (m - gm)) / (any_value(k) - 1)) / (SUM((m.n - 1) * v) / (any_value(o.n) - any_value(k))) AS w FROM m, o"""


@query("h4_t_test", f"""
    WITH m AS ({MOMENTS}), l AS ({LEVENE.format(rows=PAIR)}), e AS (SELECT w, {t_tail("sqrt(w)", "d2")} > 0.05 AS even FROM l),
         t AS (SELECT *, sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2)) AS sp FROM m, e),
         c AS (SELECT *, CASE WHEN even THEN (m1 - m2) / (sp * sqrt(1e0 / n1 + 1e0 / n2)) ELSE (m1 - m2) / sqrt(v1 / n1 + v2 / n2) END AS t,
                      CASE WHEN even THEN n1 + n2 - 2e0 ELSE pow(v1 / n1 + v2 / n2, 2) / (pow(v1 / n1, 2) / (n1 - 1) + pow(v2 / n2, 2) / (n2 - 1)) END AS df, (m1 - m2) / sp AS d FROM t)
    SELECT CASE WHEN even THEN 'Student''s t-test' ELSE 'Welch''s t-test' END AS test_used, n1 AS n_a, n2 AS n_b, round(m1, 7) AS mean_a, round(m2, 7) AS mean_b,
           even AS equal_variance, round(t, 7) AS t, round(df, 5) AS df, round({t_tail("t", "df")}, 6) AS p_value, round(d, 8) AS cohens_d, {label("d", 0.2, 0.5, 0.8)} AS magnitude FROM c""")
def t_test(spark, sf):
    out = rounded(h.t_test(table(spark, sf, "events"), *ARGS), 7, "mean_a", "mean_b", "t")
    return rounded(rounded(rounded(out, 5, "df"), 6, "p_value"), 8, "cohens_d")


ALL = "SELECT event_type AS g, value AS x FROM {events}"


@query("h5_levene", f"SELECT round(w, 7) AS statistic, round({f_tail('w', 'd1', 'd2')}, 6) AS p_value, {f_tail('w', 'd1', 'd2')} > 0.05 AS equal_variance FROM ({LEVENE.format(rows=ALL)}) l")
def levene(spark, sf):
    return rounded(rounded(h.levene(table(spark, sf, "events"), "event_type", "value"), 7, "statistic"), 6, "p_value")


@query("h6_cohens_d", f"SELECT round((m1 - m2) / sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2)), 9) AS cohens_d FROM ({MOMENTS}) m")
def cohens_d(spark, sf):
    m = h.two_sample_moments(table(spark, sf, "events"), *ARGS)
    d = h.cohens_d(*[F.col(c) for c in ("n_a", "n_b", "mean_a", "mean_b", "var_a", "var_b")])
    return rounded(m.select(d.alias("cohens_d")), 9, "cohens_d")


@query("h7_rank_biserial", f"""
    WITH r AS (SELECT g, rank() OVER (ORDER BY x) + (COUNT(*) OVER (PARTITION BY x) - 1) / 2e0 AS rk FROM (SELECT l_linestatus AS g, l_extendedprice AS x FROM {{lineitem}}) p),
         s AS (SELECT COUNT(*) FILTER (WHERE g = 'F') AS n1, COUNT(*) FILTER (WHERE g = 'O') AS n2, SUM(rk) FILTER (WHERE g = 'F') AS r1 FROM r)
    SELECT round(2 * (r1 - n1 * (n1 + 1) / 2e0) / (CAST(n1 AS DOUBLE) * n2) - 1, 9) AS effect_size FROM s""")
def rank_biserial(spark, sf):
    return rounded(h.mann_whitney_u(table(spark, sf, "lineitem"), "l_linestatus", "l_extendedprice", "F", "O").select("effect_size"), 9, "effect_size")


MEDIAN_GAP = f"(SELECT median(x) FILTER (WHERE g = 'click') - median(x) FILTER (WHERE g = 'view') FROM ({PAIR}) p)"


@query("h8_bootstrap_median_ci", f"SELECT round({MEDIAN_GAP}, 6) AS gap, true AS brackets, true AS ordered, true AS stable")
def bootstrap_median_ci(spark, sf):
    """The interval holds the difference of the medians, and another seed's interval overlaps it by most of its width."""
    events = table(spark, sf, "events")
    one, two = (h.bootstrap_median_ci(events, *ARGS, seed=s) for s in (h.BOOTSTRAP_SEED, 7))
    mid = events.where("event_type IN ('click', 'view')").agg((F.median(F.when(F.col("event_type") == "click", F.col("value"))) - F.median(F.when(F.col("event_type") == "view", F.col("value"))))).scalar()
    other = two.select(F.struct("ci_low", "ci_high")).scalar()
    out = one.withColumns({"gap": mid, "_o": other})
    common = F.least("ci_high", "_o.ci_high") - F.greatest("ci_low", "_o.ci_low")
    return out.select(
        F.round("gap", 6).alias("gap"), F.col("gap").between(F.col("ci_low"), F.col("ci_high")).alias("brackets"), (F.col("ci_low") <= F.col("ci_high")).alias("ordered"),
        (common >= 0.7 * (F.col("ci_high") - F.col("ci_low"))).alias("stable"),
    )


@query("h9_effect_label", f"SELECT l_orderkey, l_linenumber, l_partkey, {label('l_tax * 10 - l_discount', 0.1, 0.3, 0.5)} AS magnitude FROM {{lineitem}}")
def effect_label(spark, sf):
    size = h.effect_label(F.col("l_tax") * 10 - F.col("l_discount"), h.RANK_BISERIAL_THRESHOLDS)
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", size.alias("magnitude"))


RANK_TEST = f"""r AS (SELECT g, x, rank() OVER (ORDER BY x) + (COUNT(*) OVER (PARTITION BY x) - 1) / 2e0 AS rk FROM ({PAIR}) p),
         t AS (SELECT CAST(SUM(n * n * n - n) AS DOUBLE) AS tie FROM (SELECT COUNT(*) AS n FROM ({PAIR}) p GROUP BY x) c),
         s AS (SELECT COUNT(*) FILTER (WHERE g = 'click') AS n1, COUNT(*) FILTER (WHERE g = 'view') AS n2, SUM(rk) FILTER (WHERE g = 'click') AS r1 FROM r),
         u AS (SELECT n1, n2, r1 - n1 * (n1 + 1) / 2e0 AS u, tie FROM s, t),
         z AS (SELECT *, (greatest(u, n1 * n2 - u) - n1 * n2 / 2e0 - 5e-1) / sqrt(n1 * n2 / 12e0 * ((n1 + n2 + 1) - tie / ((n1 + n2) * (n1 + n2 - 1e0)))) AS z, 2e0 * u / (n1 * n2) - 1 AS e FROM u),
         tested AS (SELECT u, least(1, 2 * {normal_tail("z")}) AS p, e, {label("e", 0.1, 0.3, 0.5)} AS magnitude FROM z)"""


# The values are far from normal, so that the rank test is the one that fits.
@query("h10_two_group_test", f"""
    WITH {RANK_TEST}
    SELECT n1 AS n_a, n2 AS n_b, round(m1, 6) AS mean_a, round(m2, 6) AS mean_b, (SELECT round(median(x), 6) FROM ({PAIR}) p WHERE g = 'click') AS median_a,
           (SELECT round(median(x), 6) FROM ({PAIR}) p WHERE g = 'view') AS median_b,
           CASE WHEN (SELECT median(x) FROM ({PAIR}) p WHERE g = 'click') > (SELECT median(x) FROM ({PAIR}) p WHERE g = 'view') THEN 'click' ELSE 'view' END AS higher_group,
           'Mann-Whitney U' AS test_used, u AS test_statistic, round(p, 7) AS p_value, p < 5e-2 AS significant, 'rank_biserial_correlation' AS effect_size_type,
           round(e, 9) AS effect_size, magnitude AS effect_size_magnitude, true AS consistent FROM ({MOMENTS}) m, tested""")
def two_group_test(spark, sf):
    """The whole result but the drawn interval, which must hold the difference of the medians and agree with its turned form."""
    out = h.two_group_test(table(spark, sf, "events"), *ARGS)
    consistent = ~(F.col("normality_a.is_normal") & F.col("normality_b.is_normal")) & (F.col("higher_ci_low") <= F.col("higher_ci_high"))
    consistent = consistent & (F.col("median_a") - F.col("median_b")).between(F.col("ci_low"), F.col("ci_high"))
    named = ["test_used", "test_statistic", "p_value", "significant", "effect_size_type", "effect_size", "effect_size_magnitude"]
    out = out.select("n_a", "n_b", "mean_a", "mean_b", "median_a", "median_b", "higher_group", *named, consistent.alias("consistent"))
    return rounded(rounded(rounded(out, 6, "mean_a", "mean_b", "median_a", "median_b"), 7, "p_value"), 9, "effect_size")


# Quantity bands of a price that depends on them: the significant branch.
BANDS = "SELECT 'band ' || CAST(CAST(floor(l_quantity / 4e0) AS BIGINT) + 10 AS STRING) AS band, CASE WHEN l_linenumber = 3 THEN NULL ELSE l_extendedprice + l_quantity * 5e2 END AS x FROM {lineitem}"


def anova_sql(rows: str) -> str:
    return f"""WITH m AS (SELECT g, COUNT(x) AS n, AVG(x) AS m, var_samp(x) AS v FROM ({rows}) r WHERE x IS NOT NULL AND g IS NOT NULL GROUP BY g HAVING COUNT(x) >= 2),
        o AS (SELECT COUNT(*) AS k, SUM(n) AS n, SUM(n * m) / SUM(n) AS gm FROM m)
        SELECT any_value(k) AS k, any_value(o.n) AS n, SUM(m.n * (m - gm) * (m - gm)) AS ssb, SUM((m.n - 1) * v) AS ssw,
               (SUM(m.n * (m - gm) * (m - gm)) / (any_value(k) - 1)) / (SUM((m.n - 1) * v) / (any_value(o.n) - any_value(k))) AS f FROM m, o"""


ANOVA_ROWS = "SELECT event_type AS g, value AS x FROM {events}"


@query("h11_anova", f"""SELECT k AS n_groups, CAST(n AS BIGINT) AS n_obs, round(f, 7) AS f_statistic, round({f_tail("f", "k - 1", "n - k")}, 6) AS p_value,
    {f_tail("f", "k - 1", "n - k")} < 0.05 AS significant, round(ssb / (ssb + ssw), 9) AS eta_squared, {label("ssb / (ssb + ssw)", 0.01, 0.06, 0.14)} AS magnitude FROM ({anova_sql(ANOVA_ROWS)}) a""")
def anova(spark, sf):
    out = h.anova(table(spark, sf, "events"), "event_type", "value")
    out = out.select("n_groups", "n_obs", "f_statistic", "p_value", "significant", "eta_squared", "magnitude")
    return rounded(rounded(rounded(out, 7, "f_statistic"), 6, "p_value"), 9, "eta_squared")


@query("h11_group_summary", "SELECT band AS g, COUNT(x) AS n, round(AVG(x), 5) AS mean, round(median(x), 5) AS median FROM (" + BANDS + ") b WHERE x IS NOT NULL GROUP BY band")
def group_summary(spark, sf):
    return rounded(h.group_summary(role(spark, sf, BANDS), "band", "x"), 5, "mean", "median")


@query("h12_tukey_hsd", f"""
    WITH m AS (SELECT band AS g, AVG(x) AS m FROM ({BANDS}) b WHERE x IS NOT NULL GROUP BY band HAVING COUNT(x) >= 2)
    SELECT p.g AS group1, q.g AS group2, round(q.m - p.m, 4) AS meandiff, true AS consistent FROM m p JOIN m q ON p.g < q.g""")
def tukey_hsd(spark, sf):
    """Every pair; rejection, adjusted p and interval say the same."""
    out = h.tukey_hsd(role(spark, sf, BANDS), "band", "x")
    inside, p = F.col("lower").between(-1e300, 0) & F.col("upper").between(0, 1e300), F.col("p_adj")
    consistent = p.between(0, 1) & (F.col("reject") == ~inside) & ((F.col("reject") == (p < h.ALPHA)) | (F.abs(p - h.ALPHA) < 1e-6))
    return rounded(out.select("group1", "group2", "meandiff", consistent.alias("consistent")), 4, "meandiff")


@query("h12_tukey_statistic", f"""
    WITH a AS ({anova_sql("SELECT band AS g, x FROM (" + BANDS + ") b")}), m AS (SELECT band AS g, COUNT(x) AS n, AVG(x) AS m FROM ({BANDS}) b WHERE x IS NOT NULL GROUP BY band)
    SELECT p.g AS group1, q.g AS group2, round(q.m - p.m, 4) AS meandiff, round(abs(q.m - p.m) / sqrt(ssw / (a.n - k) / 2 * (1e0 / p.n + 1e0 / q.n)), 6) AS q
    FROM m p JOIN m q ON p.g < q.g, a""")
def tukey_statistic(spark, sf):
    out = h.tukey_hsd(role(spark, sf, BANDS), "band", "x").select("group1", "group2", "meandiff", "q")
    return rounded(rounded(out, 4, "meandiff"), 6, "q")


@query("h13_posthoc_digest", f"""
    WITH m AS (SELECT band AS g, AVG(x) AS m FROM ({BANDS}) b WHERE x IS NOT NULL GROUP BY band)
    SELECT COUNT(*) AS n_groups, arg_max(g, m) AS highest_group, round(MAX(m), 5) AS highest_mean, arg_min(g, m) AS lowest_group, round(MIN(m), 5) AS lowest_mean FROM m""")
def posthoc_digest(spark, sf):
    out = h.posthoc_digest(role(spark, sf, BANDS), "band", "x")
    return rounded(out.select("n_groups", "highest_group", "highest_mean", "lowest_group", "lowest_mean"), 5, "highest_mean", "lowest_mean")


@query("h13_posthoc_pairs", f"""
    WITH m AS (SELECT band AS g, AVG(x) AS m FROM ({BANDS}) b WHERE x IS NOT NULL GROUP BY band HAVING COUNT(x) >= 2)
    SELECT COUNT(*) AS n_groups, true AS same_count, (SELECT arg_min(g, m) FROM m) || ' ' || (SELECT arg_max(g, m) FROM m) AS extreme FROM m""")
def posthoc_pairs(spark, sf):
    """Significant pairs as many as the pairwise table rejects; the extreme pair is that of the lowest and highest mean."""
    rows = role(spark, sf, BANDS)
    rejected = h.tukey_hsd(rows, "band", "x").agg(F.count_if("reject")).scalar()
    names = F.array("most_extreme_pair.group1", "most_extreme_pair.group2")
    up = F.col("most_extreme_pair.meandiff") > 0
    return h.posthoc_digest(rows, "band", "x").select(
        "n_groups", (F.col("significant_pairs") == rejected).alias("same_count"), F.concat_ws(" ", F.when(up, names).otherwise(F.reverse(names))).alias("extreme")
    )


@query("j6_group_pairs", "SELECT a.event_type AS group1, b.event_type AS group2 FROM (SELECT DISTINCT event_type FROM {events}) a JOIN (SELECT DISTINCT event_type FROM {events}) b ON a.event_type < b.event_type")
def group_pairs(spark, sf):
    return h.tukey_hsd(table(spark, sf, "events"), "event_type", "value", only_if_significant=False).select("group1", "group2")


# The full results behind the invariant queries above; these have no SQL.
@query("h1_normality_rows")
def normality_rows(spark, sf):
    return h.normality(table(spark, sf, "events"), "event_type", "value")


@query("h2_shapiro_wilk_rows")
def shapiro_wilk_rows(spark, sf):
    return h.shapiro(table(spark, sf, "orders"), "o_custkey", "o_totalprice")


@query("h8_bootstrap_median_ci_rows")
def bootstrap_median_ci_rows(spark, sf):
    return h.bootstrap_median_ci(table(spark, sf, "events"), *ARGS, seed=h.BOOTSTRAP_SEED)


@query("h10_two_group_test_rows")
def two_group_test_rows(spark, sf):
    return h.two_group_test(table(spark, sf, "events"), *ARGS)


# A rational approximation of the normal distribution, good to 15 digits.
_TOP = (0.0352624965998911, 0.700383064443688, 6.37396220353165, 33.912866078383, 112.079291497871, 221.213596169931, 220.206867912376)
_BELOW = (0.0883883476483184, 1.75566716318264, 16.064177579207, 86.7807322029461, 296.564248779674, 637.333633378831, 793.826512519948, 440.413735824752)


def _phi(x: str) -> str:
    """The normal distribution function in SQL."""
    y = f"least(37, abs({x}))"
    horner = lambda values: "(" * len(values) + "0e0" + "".join(f" * {y} + {v!r})" for v in values)
    far = f"exp(-{y} * {y} / 2) / ({y} + 1 / ({y} + 2 / ({y} + 3 / ({y} + 4 / ({y} + 0.65))))) / 2.506628274631"
    tail = f"CASE WHEN {y} < 7.07106781186547 THEN exp(-{y} * {y} / 2) * {horner(_TOP)} / {horner(_BELOW)} ELSE {far} END"
    return f"(CASE WHEN {x} > 0 THEN 1 - ({tail}) ELSE {tail} END)"


# The range of k normal values over s, for each pair; s is spread like sqrt(chi2 / df).
RANGE_TAIL = f"""
    q AS (SELECT p.g AS group1, q.g AS group2, q.m - p.m AS meandiff, abs(q.m - p.m) / sqrt(ssw / (a.n - k) / 2 * (1e0 / p.n + 1e0 / q.n)) AS q, k, a.n - k AS df
          FROM m p JOIN m q ON p.g < q.g, a),
    s AS (SELECT s, w / SUM(w) OVER () AS w FROM (SELECT s, exp((df - 1) * ln(s) - df * (s * s - 1) / 2) AS w
          FROM (SELECT df, 1 + (i - 30) * 8e0 / sqrt(2 * df) / 30 AS s FROM (SELECT any_value(df) AS df FROM q), range(61) t(i)) g WHERE s > 0) h),
    z AS (SELECT -85e-1 + i * 17e0 / 400 AS z, CASE WHEN i IN (0, 400) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END * 17e0 / 400 / 3 AS w FROM range(401) t(i)),
    p AS (SELECT group1, group2, 1 - SUM(s.w * z.w * k * exp(-z * z / 2) / sqrt(2 * pi()) * pow(greatest(0, {_phi("z")} - {_phi("(z - q * s)")}), k - 1)) AS p FROM q, s, z GROUP BY group1, group2)"""
BAND_MOMENTS = f"a AS ({anova_sql('SELECT band AS g, x FROM (' + BANDS + ') b')}), m AS (SELECT band AS g, COUNT(x) AS n, AVG(x) AS m FROM ({BANDS}) b WHERE x IS NOT NULL GROUP BY band HAVING COUNT(x) >= 2)"


@query("h12_tukey_hsd_rows", f"""
    WITH {BAND_MOMENTS}, {RANGE_TAIL}
    SELECT group1, group2, round(meandiff, 4) AS meandiff, round(q, 6) AS q, round(least(1, greatest(0, p)), 6) AS p_adj, p < 5e-2 AS reject FROM q JOIN p USING (group1, group2)""")
def tukey_hsd_rows(spark, sf):
    out = h.tukey_hsd(role(spark, sf, BANDS), "band", "x").select("group1", "group2", "meandiff", "q", "p_adj", "reject")
    return rounded(rounded(out, 4, "meandiff"), 6, "q", "p_adj")


@query("h13_posthoc_digest_rows")
def posthoc_digest_rows(spark, sf):
    return h.posthoc_digest(role(spark, sf, BANDS), "band", "x")
