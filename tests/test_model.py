import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.operators import forest, model, regress, shap
from tidemark.plans.price import price_study


def data(spark, n=800, seed=0):
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame({"id": np.arange(n), "a": rng.normal(50, 3, n), "b": rng.integers(0, 4, n).astype(float), "g": rng.choice(["u", "v", "w"], n)})
    pdf["y"] = 10 * pdf.a - 4 * pdf.b + (pdf.g == "w") * 7 + rng.normal(0, 2, n)
    return pdf, spark.createDataFrame(pdf)


def test_design_matrix_drops_first_sorted_level(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, None)], "id int, c string").withColumn("blank", F.lit(None).cast("double"))
    out, columns, excluded = regress.design_matrix(df, ["c", "blank"], ["id"])
    assert columns == ["c_b"] and excluded == ["blank"]
    assert [r["c_b"] for r in out.orderBy("id").collect()] == [1.0, 0.0, 0.0]


def test_ols_matches_least_squares(spark):
    pdf, df = data(spark)
    fit = regress.ols(df, ["a", "b", "g"], "y")
    got = {r["term"]: r for r in fit.coefficients.collect()}
    x = np.column_stack([np.ones(len(pdf)), pdf.a, pdf.b, pdf.g == "v", pdf.g == "w"]).astype(float)
    beta, *_ = np.linalg.lstsq(x, pdf.y, rcond=None)
    residual = pdf.y - x @ beta
    se = np.sqrt(np.diag(np.linalg.inv(x.T @ x)) * (residual @ residual) / (len(pdf) - 5))
    for name, b, s in zip(["const", "a", "b", "g_v", "g_w"], beta, se):
        assert got[name]["coefficient"] == pytest.approx(b, rel=1e-8)
        assert got[name]["std_error"] == pytest.approx(s, rel=1e-8)
    s = fit.summary.first()
    assert s["r_squared"] == pytest.approx(1 - residual @ residual / ((pdf.y - pdf.y.mean()) ** 2).sum(), rel=1e-9)
    for i, c in enumerate(["a", "b", "g_v", "g_w"], start=1):
        others = np.delete(x, i, axis=1)
        fitted = others @ np.linalg.lstsq(others, x[:, i], rcond=None)[0]
        r2 = 1 - ((x[:, i] - fitted) ** 2).sum() / ((x[:, i] - x[:, i].mean()) ** 2).sum()
        vif = {r["predictor"]: r["vif"] for r in fit.vif.collect()}[c]
        assert vif == pytest.approx(1 / (1 - r2), rel=1e-8) and vif >= 1


def test_ols_counts_dropped_rows_and_picks_log(spark):
    rows = [(float(i), float(10 ** (i / 10))) for i in range(40)] + [(None, 5.0), (3.0, None), (3.0, -1.0)]
    df = spark.createDataFrame(rows, "a double, price double")
    fit = regress.price_regression(df, ["a"], "price")
    s = fit.summary.first()
    assert (s["target"], s["n_obs"], s["dropped_rows"]) == ("log_price", 40, 3)
    assert s["r_squared"] == pytest.approx(1.0)


def test_redundant_column_has_infinite_vif(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i, float(i * i % 7)) for i in range(30)], "a double, b double, c double")
    got = {r["predictor"]: r["vif"] for r in regress.vif(df, ["a", "b", "c"]).collect()}
    assert got["a"] == got["b"] == float("inf") and got["c"] < 5


def test_features_reject_leakage(spark):
    _, df = data(spark)
    with pytest.raises(ValueError, match="derived from the target"):
        model.feature_matrix(df, ["a", "y"], ["g"], leakage=["y"])
    out, features, excluded = model.feature_matrix(df, ["a", "zz"], ["g"])
    assert features == ["a", "g_u", "g_v", "g_w"] and excluded == ["zz"]


def test_split_is_stable_under_partitioning(spark):
    _, df = data(spark)
    first = {r["id"] for r in model.split(df, "id")[1].collect()}
    again = {r["id"] for r in model.split(df.repartition(7), "id")[1].collect()}
    assert first == again and 100 < len(first) < 220


def plain_tree(x, y, w, depth, least):
    """A tree by trying every split of every node."""

    def build(rows, left):
        mean, best = np.average(y[rows], weights=w[rows]), None
        for c in range(x.shape[1]) if left != 0 and y[rows].min() < y[rows].max() else ():
            values = np.unique(x[rows, c])
            for a, b in zip(values[:-1], values[1:]):
                low = x[rows, c] <= a
                if min(low.sum(), (~low).sum()) >= least:
                    score = sum((w[r] @ (y[r] - mean)) ** 2 / w[r].sum() for r in (rows[low], rows[~low]))
                    if best is None or score > best[0] + 1e-9:
                        best = (score, c, (a + b) / 2)
        if best is None:
            return mean
        low = x[rows, best[1]] <= best[2]
        return (*best[1:], build(rows[low], left - 1), build(rows[~low], left - 1))

    return build(np.arange(len(y)), -1 if depth is None else depth)


def plain_value(tree, x):
    while isinstance(tree, tuple):
        tree = tree[2] if x[tree[0]] <= tree[1] else tree[3]
    return tree


@pytest.mark.parametrize("depth, least", [(None, 1), (2, 1), (None, 4)])
def test_grown_against_every_split(depth, least):
    rng = np.random.default_rng(0)
    for n in (1, 2, 9, 30, 55):
        x = np.column_stack([np.round(rng.normal(size=(n, 2)), 1), rng.integers(0, 2, n)])
        y, w = np.round(rng.normal(size=n) + x[:, 0], 2), rng.integers(1, 4, n).astype(float)
        nodes = forest.grown(x, y, w, depth, least)
        leaf = forest.reached(x, nodes["left"], nodes["right"], nodes["feature"], nodes["threshold"])
        tree = plain_tree(x, y, w, depth, least)
        np.testing.assert_allclose(nodes["value"][leaf], [plain_value(tree, r) for r in x], atol=1e-12)
        inner = nodes["left"] >= 0
        error = (w * (y - np.average(y, weights=w)) ** 2).sum() - (w * (y - nodes["value"][leaf]) ** 2).sum()
        assert nodes["gain"][inner].sum() == pytest.approx(error, abs=1e-9)


def test_draws_are_poisson_and_depend_on_row_and_tree_alone():
    rows = np.arange(100_000)
    w = forest.draws(rows, 3, 42)
    assert w.mean() == pytest.approx(1, abs=0.02) and w.var() == pytest.approx(1, abs=0.03)
    assert (forest.draws(rows[::-1], 3, 42)[::-1] == w).all() and (forest.draws(rows, 4, 42) != w).any()


def design_of(spark, n=800, seed=0):
    _, df = data(spark, n, seed)
    return model.feature_matrix(df, ["a", "b"], ["g"], ["id", "y"])


def summed(spark, grown, design, features):
    scored = model.predict(grown, design).select("id", "raw_prediction")
    values = shap.shap_values(grown, design, "id").join(scored, "id").toPandas()
    np.testing.assert_allclose(values[[f"phi_{f}" for f in features]].sum(axis=1) + values["base"], values["raw_prediction"], rtol=1e-9)
    return values


def test_attributions_sum_to_prediction(spark):
    design, features, _ = design_of(spark)
    grown = model.rf_regress(design, features, "y", trees=8)
    summed(spark, grown, design, features)
    top = shap.shap_rank(shap.shap_values(grown, design, "id"), features).collect()
    assert top[0]["feature"] == "a" and top[0]["direction"] == "positive"
    assert {r["feature"]: r["direction"] for r in top}["b"] == "negative"
    rank = model.importance_rank(grown).collect()
    assert [r.rank for r in rank] == [1, 2, 3, 4, 5][: len(rank)] and rank[0].feature == "a" and sum(r.importance for r in rank) == pytest.approx(1)


def test_whole_trees_repeat_the_labels(spark):
    pdf, _ = data(spark)
    design, features, _ = design_of(spark)
    grown = model.rf_regress(design, features, "y", trees=1, bootstrap=False)
    found = model.predict(grown, design).toPandas().sort_values("id")
    np.testing.assert_allclose(found.raw_prediction, pdf.y, rtol=1e-12)


def test_trees_split_by_spark_above_their_parts(spark, monkeypatch):
    """Parts of at most 150 rows: same rows, labels and attributions, nearly the same errors."""
    design, features, _ = design_of(spark, 1500)
    design = design.withColumn("a", F.round("a", 1))  # fewer values than bins: the splits above the parts are exact too
    same = model.rf_regress(design, features, "y", trees=4)
    monkeypatch.setattr(forest, "CELLS", 150 * len(features))
    monkeypatch.setattr(forest, "TREES_AT_ONCE", 3)
    monkeypatch.setattr(forest, "SLOT", 400)
    grown = model.rf_regress(design.repartition(5), features, "y", trees=4)
    assert all(len(t.parts()) > 5 for t in grown.tops) and grown.nodes().where("id = 0").count() == sum(len(t.parts()) for t in grown.tops)
    summed(spark, grown, design, features)
    errors = [model.regression_metrics(model.predict(f, design), F.col("y"), F.col("raw_prediction")).first().rmse for f in (same, grown)]
    assert errors[1] == pytest.approx(errors[0], rel=0.1)
    once = model.rf_regress(design, features, "y", trees=1, bootstrap=False)
    means = design.groupBy(*features).agg(F.avg("y").alias("mean"))
    off = model.predict(once, design).join(means, features).agg(F.max(F.abs(F.col("raw_prediction") - F.col("mean")))).first()[0]
    assert off < 1e-9
    stump = model.rf_regress(design, features, "y", trees=1, bootstrap=False, max_depth=1)
    assert stump.tops[0].parts() == [1, 2] and stump.nodes().count() == 2


def test_rows_that_agree_in_all_features_are_one_leaf(spark, monkeypatch):
    monkeypatch.setattr(forest, "CELLS", 20)
    df = spark.range(200).select(F.col("id"), F.lit(1.0).alias("a"), (F.col("id") % 2).cast("double").alias("b"), (F.col("id") % 7).cast("double").alias("y"))
    grown = model.rf_regress(df, ["a", "b"], "y", trees=2)
    assert all(len(t.parts()) == 2 and len(t.value) == 2 for t in grown.tops)
    found = model.predict(grown, df.withColumn("b", F.when(F.col("id") > 0, F.col("b"))))
    assert found.select("raw_prediction").distinct().count() == 3 and found.where("raw_prediction IS NULL").count() == 1
    summed(spark, grown, df, ["a", "b"])


def test_attributions_match_the_definition(spark, monkeypatch):
    """Shapley values of a small forest by enumerating all coalitions, with and without nodes above the parts."""
    from itertools import combinations
    from math import factorial

    _, df = data(spark, 120, 3)
    design, features, _ = model.feature_matrix(df, ["a", "b"], [], ["id", "y"])
    features = [*features, "c"]
    design = design.withColumn("c", F.col("id") % 5 + 0.0)
    for cells in (10**6, 30 * 3):
        monkeypatch.setattr(forest, "CELLS", cells)
        grown = model.rf_regress(design, features, "y", trees=3, max_depth=5)
        inner = {k: t.set_index("id") for k, t in grown.nodes().toPandas().groupby(["tree", "part"])}

        def ends(x, known, tops, part, at):
            """(weight, value) of the leaves a row reaches when only some features are known."""
            top = grown.tops[tops]
            left, right, f, limit, cover = (top.left, top.right, top.feature, top.threshold, top.cover) if part is None else (inner[tops, part][c] for c in ("left", "right", "feature", "threshold", "cover"))
            if left[at] < 0:
                return ends(x, known, tops, at, 0) if part is None else inner[tops, part].value[at]
            if f[at] in known:
                return ends(x, known, tops, part, left[at] if x[f[at]] <= limit[at] else right[at])
            return sum(ends(x, known, tops, part, c) * cover[c] for c in (left[at], right[at])) / cover[at]

        got = shap.shap_values(grown, design, "id").orderBy("id").limit(6).toPandas()
        k = len(features)
        for _, row in got.iterrows():
            x = row[features].to_numpy(dtype=float)
            for i, f in enumerate(features):
                phi = 0.0
                rest = [j for j in range(k) if j != i]
                for size in range(k):
                    weight = factorial(size) * factorial(k - size - 1) / factorial(k)
                    for s in combinations(rest, size):
                        phi += weight * sum(ends(x, {*s, i}, t, None, 0) - ends(x, set(s), t, None, 0) for t in range(3)) / 3
                assert row[f"phi_{f}"] == pytest.approx(phi, abs=1e-9)


def test_no_training_row_is_an_error(spark):
    design, features, _ = design_of(spark, 20)
    with pytest.raises(ValueError, match="no complete training row"):
        model.rf_regress(design.limit(0), features, "y")
    assert model.predict(model.rf_regress(design, features, "y", trees=2), design.limit(0)).collect() == []


def test_price_study(spark):
    _, df = data(spark)
    df = df.withColumn("price", F.exp(F.col("a") / 2 - 20)).withColumn("per_unit", F.col("price") / 2)
    study = price_study(df, "id", "price", ["a", "b", "host_tenure"], ["g"], ["per_unit"], trees=10, max_depth=6)
    assert study.excluded == ["host_tenure"]
    assert study.improvement.first()["mae_improvement_pct"] > 30
    assert study.top_features.first()["feature"] == "a"
    assert study.largest_errors.count() == 5
    report = study.report().toPandas().groupby("section").size().to_dict()
    assert report == {"metrics": 4, "log_metrics": 4, "baseline": 4, "improvement": 7, "facts": 5, "target": 1, "largest_errors": 5, "importances": 5, "drivers": 5}


def test_registered_full_results_of_tests(spark, sf):
    from registry import QUERIES

    for name, columns in {"h1_normality_rows": {"w", "p_value"}, "h2_shapiro_wilk_rows": {"w", "p_value"}, "h8_bootstrap_median_ci_rows": {"ci_low", "ci_high"},
                          "h10_two_group_test_rows": {"p_value", "effect_size"}, "h12_tukey_hsd_rows": {"q", "p_adj", "lower", "upper"}, "h13_posthoc_digest_rows": {"most_extreme_pair"}}.items():
        found = QUERIES[name](spark, sf)
        assert columns <= set(found.columns)
    assert QUERIES["h12_tukey_hsd_rows"](spark, sf).where("p_adj IS NULL").count() == 0
