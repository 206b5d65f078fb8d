import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions import tails
from tidemark.operators import hypothesis as h, ranking


def pairs(spark, **groups):
    rows = [(g, float(v)) for g, values in groups.items() for v in values]
    return spark.createDataFrame(rows, "g string, x double")


def test_tabulated_tails():
    assert tails.t_two_sided(2.0, 10) == pytest.approx(0.0733880, abs=1e-7)
    assert tails.t_two_sided(1.959963985, 1e9) == pytest.approx(0.05, abs=1e-6)
    assert tails.f_sf(4.10, 2, 10) == pytest.approx(0.05, abs=1e-3)
    assert tails.normal_sf(1.644853627) == pytest.approx(0.05, abs=1e-9)
    for k, df, crit in ((3, 10, 3.877), (10, 20, 5.008), (5, 120, 3.917), (2, 2, 6.085), (20, 60, 5.24)):
        assert tails.studentized_range_quantile(0.05, k, df) == pytest.approx(crit, abs=2e-2 if k == 20 else 2e-3)


def test_two_group_range_equals_t_test():
    # the range of two groups is the t statistic times sqrt 2
    for t, df in ((0.5, 5), (2.0, 30), (3.0, 400)):
        assert tails.studentized_range_sf(t * math.sqrt(2), 2, df) == pytest.approx(tails.t_two_sided(t, df), abs=1e-6)


def test_exact_mann_whitney():
    assert tails.mann_whitney_exact(0, 3, 3) == pytest.approx(0.1)
    assert tails.mann_whitney_exact(6, 4, 5) == pytest.approx(2 * 26 / 126, abs=0.02)
    total = tails.mann_whitney_exact(10, 4, 5)
    assert total == 1.0


def test_exact_mann_whitney_by_enumeration():
    from itertools import combinations

    n1, n2 = 4, 6
    us = [sum(c) - n1 * (n1 - 1) // 2 for c in combinations(range(n1 + n2), n1)]
    for u in (0, 3, 9, 12, 20):
        upper = max(u, n1 * n2 - u)
        assert tails.mann_whitney_exact(u, n1, n2) == pytest.approx(min(1, 2 * sum(v >= upper for v in us) / len(us)))


def test_shapiro_published_example(spark):
    weights = [148, 154, 158, 160, 161, 162, 166, 170, 182, 195, 236]
    r = h.shapiro(pairs(spark, a=weights), "g", "x").first()
    assert r["w"] == pytest.approx(0.7888, abs=1e-4) and r["p_value"] == pytest.approx(0.00670, abs=1e-4)


def test_shapiro_small_and_constant_groups(spark):
    got = {r["g"]: r for r in h.shapiro(pairs(spark, three=[1, 2, 3], four=[1, 2, 3, 9], five=[1, 2, 3, 4, 5], same=[7] * 9), "g", "x").collect()}
    assert got["three"]["w"] == pytest.approx(1.0) and got["same"]["w"] == got["same"]["p_value"] == 1.0
    # values of the published tables: even spacing looks normal
    assert got["five"]["w"] == pytest.approx(0.98676, abs=1e-4) and got["five"]["p_value"] == pytest.approx(0.96717, abs=1e-3)
    assert 0.6 < got["four"]["w"] < 0.9


def test_shapiro_does_not_move_with_the_origin(spark):
    rng = np.random.default_rng(8)
    x = rng.exponential(1, 300)
    got = {r["g"]: r["w"] for r in h.shapiro(pairs(spark, near=x, far=x + 1e5), "g", "x").collect()}
    assert got["near"] == pytest.approx(got["far"], rel=1e-7)


def test_shapiro_leaves_large_groups_to_moments(spark):
    rng = np.random.default_rng(0)
    df = pairs(spark, small=rng.normal(size=200), large=rng.normal(size=5001), tiny=[1, 2])
    got = {r["g"]: r for r in h.normality(df, "g", "x").collect()}
    assert got["small"]["method"] == "shapiro" and got["small"]["is_normal"]
    assert got["large"]["method"] == "skew_kurtosis" and got["large"]["w"] is None and got["large"]["is_normal"]
    assert not got["tiny"]["is_normal"]


def test_mann_whitney_fixture(spark):
    r = h.mann_whitney_u(pairs(spark, a=[1, 2, 3], b=[4, 5, 6]), "g", "x", "a", "b").first()
    assert (r["u"], r["effect_size"], r["magnitude"]) == (0.0, -1.0, "large")
    assert r["p_value"] == pytest.approx(0.1)


def test_effect_labels(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (0.5,), (-0.8,), (None,)], "d double")
    got = [r[0] for r in df.select(h.effect_label(F.col("d"), h.COHENS_D_THRESHOLDS)).collect()]
    assert got == ["negligible", "small", "medium", "large", None]


def test_t_test_picks_variant(spark):
    rng = np.random.default_rng(1)
    same = pairs(spark, a=np.arange(400) % 100, b=np.arange(300) % 100 + 5)
    wide = pairs(spark, a=rng.normal(0, 1, 400), b=rng.normal(0, 9, 300))
    assert h.t_test(same, "g", "x", "a", "b").first()["test_used"] == "Student's t-test"
    r = h.t_test(wide, "g", "x", "a", "b").first()
    assert r["test_used"] == "Welch's t-test" and r["df"] < 698


def test_two_group_test_branches(spark):
    rng = np.random.default_rng(2)
    normal = pairs(spark, a=rng.normal(10, 2, 300), b=rng.normal(12, 2, 250))
    r = h.two_group_test(normal, "g", "x", "a", "b").first()
    assert r["test_used"] == "Student's t-test" and r["significant"] and r["higher_group"] == "b"
    assert r["effect_size_type"] == "cohens_d" and r["effect_size"] < 0
    assert r["ci_low"] < r["median_a"] - r["median_b"] < r["ci_high"] < 0 < r["higher_ci_low"]
    skewed = pairs(spark, a=rng.exponential(1, 300), b=rng.exponential(1, 250))
    r = h.two_group_test(skewed, "g", "x", "a", "b").first()
    assert r["test_used"] == "Mann-Whitney U" and r["effect_size_type"] == "rank_biserial_correlation"


def test_too_few_observations_is_an_error(spark):
    with pytest.raises(Exception, match="at least 3 observations"):
        h.two_sample_moments(pairs(spark, a=[1, 2], b=[1, 2, 3]), "g", "x", "a", "b").collect()
    with pytest.raises(Exception, match="at least 2 groups"):
        h.anova(pairs(spark, a=[1, 2, 3], b=[1]), "g", "x").collect()


@pytest.mark.parametrize("n", [(401, 300), (40, 41)])
def test_bootstrap_agrees_with_resampling(spark, n):
    rng = np.random.default_rng(4)
    a, b = rng.lognormal(3, 0.6, n[0]), rng.lognormal(2.8, 0.5, n[1])
    r = h.bootstrap_median_ci(pairs(spark, a=a, b=b), "g", "x", "a", "b").first()
    diffs = np.median(rng.choice(a, (4000, n[0])), axis=1) - np.median(rng.choice(b, (4000, n[1])), axis=1)
    low, high = np.percentile(diffs, [2.5, 97.5])
    assert r["ci_low"] == pytest.approx(low, abs=0.12 * (high - low))
    assert r["ci_high"] == pytest.approx(high, abs=0.12 * (high - low))


def test_bootstrap_with_ties_and_quoted_labels(spark):
    df = pairs(spark, **{"it's {a}": [1.0, 1.0, 1.0, 2.0, 2.0], "b": [0.0, 0.0, 0.0]})
    r = h.bootstrap_median_ci(df, "g", "x", "it's {a}", "b").first()
    assert (r["ci_low"], r["ci_high"]) == (1.0, 2.0)


def test_anova_sums_of_squares(spark):
    rng = np.random.default_rng(5)
    groups = {k: 1e6 + rng.normal(i, 1, 50 + i) for i, k in enumerate("abcd")}
    r = h.anova(pairs(spark, **groups, lone=[5e6]), "g", "x").first()
    every = np.concatenate(list(groups.values()))
    assert r["n_groups"] == 4 and r["ss_between"] + r["ss_within"] == pytest.approx(((every - every.mean()) ** 2).sum(), rel=1e-9)
    assert r["significant"] and r["magnitude"] == "large"


def test_tukey_direction_and_gate(spark):
    rng = np.random.default_rng(6)
    df = pairs(spark, a=rng.normal(0, 1, 60), b=rng.normal(3, 1, 50), c=rng.normal(0.05, 1, 40))
    got = {(r["group1"], r["group2"]): r for r in h.tukey_hsd(df, "g", "x").collect()}
    assert set(got) == {("a", "b"), ("a", "c"), ("b", "c")}
    assert got["a", "b"]["meandiff"] > 0 and got["a", "b"]["reject"] and got["b", "c"]["meandiff"] < 0
    for r in got.values():
        assert r["reject"] == (r["p_adj"] < 0.05) and r["lower"] < r["meandiff"] < r["upper"]
    flat = pairs(spark, a=rng.normal(0, 1, 60), b=rng.normal(0, 1, 60))
    assert h.tukey_hsd(flat, "g", "x").count() == 0
    assert h.tukey_hsd(flat, "g", "x", only_if_significant=False).count() == 1
    d = h.posthoc_digest(df, "g", "x").first()
    assert (d["n_groups"], d["highest_group"], d["significant_pairs"], d["most_extreme_pair"]) == (3, "b", 2, None)


@pytest.mark.parametrize("k, df", [(2, 3), (5, 40), (13, 50_000), (60, 7)])
def test_tabulated_tail_is_the_integral(spark, k, df):
    qs = [0.0, 1e-6, 0.01, 0.3, 1.0, 1.77, 2.5, 3.31, 3.9, 4.6, 5.2, 7.0, 11.3, 30.0, 200.0, float("inf")]
    found = spark.createDataFrame([(q,) for q in qs], "q double").select("q", tails.tabulated_tail(F.col("q"), tails.studentized_range_table(k, df)).alias("p"))
    for r in found.collect():
        wanted = 0.0 if r.q == float("inf") else tails.studentized_range_sf(r.q, k, df)
        assert abs(r.p - wanted) < 1e-8


def test_numbering_by_ranges(spark):
    rows = spark.range(5000).select((F.col("id") * 7919 % 5000).cast("string").alias("g"))
    found = ranking.numbered(rows.repartition(9), ["g"], "i")
    assert [r.i for r in found.orderBy("g").collect()] == list(range(1, 5001))
    assert ranking.numbered(rows.limit(0), ["g"], "i").collect() == []
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SinglePartition" not in plan


def test_tukey_of_many_groups(spark):
    """All pairs of 300 groups, without a task that takes all groups in one window."""
    rows = spark.range(3000).select((F.col("id") % 300).cast("string").alias("g"), (F.col("id") % 300 + F.col("id") % 7).cast("double").alias("x"))
    found = h.tukey_hsd(rows, "g", "x")
    assert found.count() == 300 * 299 // 2 and found.where("p_adj IS NULL OR (reject <> (p_adj < 0.05) AND abs(p_adj - 0.05) > 1e-6)").count() == 0
    assert "WindowExec" not in found._jdf.queryExecution().executedPlan().toString()
