"""Cases at the edges: infinities, signed zeros, huge degrees of freedom, tiny tails, many levels, repeated keys."""

import math
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.functions import tails
from tidemark.operators import forest as trees, hypothesis, model, profile, quality, ranking, regress, shap
from tidemark.sources import readers


def test_quantiles_with_infinities(spark):
    rows = [("a", v) for v in (float("-inf"), 1.0, 2.0, 3.0, float("inf"))] + [("b", float("inf"))] * 3 + [("c", -1.0), ("c", float("-inf"))]
    df = spark.createDataFrame(rows, "g string, x double")
    found = {r.g: (r.n, r.q0, r.q1, r.q2) for r in ranking.group_quantiles(df, ["g"], "x", {"q0": 0.0, "q1": 0.5, "q2": 1.0}).collect()}
    inf = math.inf
    assert found == {"a": (5, -inf, 2.0, inf), "b": (3, inf, inf, inf), "c": (2, -inf, -inf, -1.0)}


def test_nan_is_missing_at_the_source(spark, tmp_path):
    spark.createDataFrame([(1, float("nan"))] + [(k, 1.0 + k) for k in range(9)], "k long, `x.y` double").write.parquet(str(tmp_path / "t"))
    df = readers.parquet_scan(spark, str(tmp_path / "t")).withColumnRenamed("x.y", "x")
    assert df.where("x IS NULL").count() == 1
    assert quality.iqr_outliers(df, ["x"]).where("k = 1 AND x IS NULL").count() == 0


def test_signed_zeros_are_one_value(spark):
    df = spark.createDataFrame([(0.0,), (-0.0,), (1.0,)], "x double")
    assert profile.profile_columns(df).first().cardinality == 2


@pytest.mark.parametrize("df", [1e7, 1e9, 1e12, 1e15])
def test_tails_for_many_degrees_of_freedom(df):
    assert abs(tails.t_two_sided(2, df) - 0.04550026389635842) < 1e-7
    assert abs(tails.t_two_sided(0.01, df) - 0.9920212941) < 1e-7
    assert abs(tails.f_sf(3.0, 2, df) - math.exp(-3)) < 1e-6  # chi-square with two degrees of freedom
    assert 0 < tails.t_two_sided(30, df) < 1e-190


def test_tails_join_at_the_change_of_method():
    low, high = 2 * tails._LARGE * (1 - 1e-9), 2 * tails._LARGE * (1 + 1e-9)
    for t in (0.3, 2.0, 6.0):
        assert tails.t_two_sided(t, low) == pytest.approx(tails.t_two_sided(t, high), rel=1e-6)
    for d1 in (1, 4, 31):
        assert tails.f_sf(1.7, d1, low) == pytest.approx(tails.f_sf(1.7, d1, high), rel=1e-6)


def exact_p(u, n1, n2):
    ways = [1] + [0] * (n1 * n2)
    for i in range(1, n1 + 1):
        for j in range(len(ways) - 1, n2 + i - 1, -1):
            ways[j] -= ways[j - n2 - i]
        for j in range(i, len(ways)):
            ways[j] += ways[j - i]
    tail = sum(ways[: math.floor(min(u, n1 * n2 - u)) + 1])
    return float(min(Fraction(1), Fraction(2 * tail, math.comb(n1 + n2, n1))))


@pytest.mark.parametrize("n1,n2,us", [(8, 2600, (20780, 20600, 10400, 20799, 20800, 0)), (3, 5, range(16)), (1, 1, (0, 1)), (8, 8, (0, 31.5, 40, 64)), (5, 900, (100, 4400))])
def test_exact_rank_sums(n1, n2, us):
    for u in us:
        found = tails.mann_whitney_exact(u, n1, n2)
        assert found >= 0 and found == pytest.approx(exact_p(u, n1, n2), rel=1e-9)


def test_large_exact_samples_have_no_other_method():
    p = tails.mann_whitney_p(2 * 1_500_000 - 10, 2, 1_500_000, 0)
    assert p == pytest.approx(2 * sum(k // 2 + 1 for k in range(11)) / math.comb(1_500_002, 2), rel=1e-9)


def test_every_group_has_a_shapiro_row(spark):
    rows = [("few", 1.0), ("few", 2.0)] + [("three", float(k * k)) for k in range(3)] + [("none", None)]
    many = spark.range(5001).select(F.lit("many").alias("g"), F.col("id").cast("double").alias("x"))
    found = {r.g: (r.n, r.status, r.w is None) for r in hypothesis.shapiro(spark.createDataFrame(rows, "g string, x double").unionAll(many), "g", "x").collect()}
    assert {k: v for k, v in found.items() if k != "none"} == {"few": (2, "too few", True), "three": (3, "tested", False), "many": (5001, "too many", True)}


def test_no_bound_on_levels(spark):
    df = spark.range(2600).select(F.concat(F.lit("v"), F.format_string("%05d", F.col("id") % 2500)).alias("c"))
    assert len(regress.category_levels(df, ["c"])["c"]) == 2500


def test_correlations_over_many_columns(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(200, 14))
    names = [f"c{k}" for k in range(14)]
    found = regress.corr_matrix(spark.createDataFrame(x.tolist(), ", ".join(f"{n} double" for n in names)), {n: n for n in names})
    got, wanted = {(r.x, r.y): r.r for r in found.collect()}, np.corrcoef(x.T)
    assert len(got) == 14 * 14 and all(abs(got[(a, b)] - wanted[i, j]) < 1e-12 for i, a in enumerate(names) for j, b in enumerate(names))


def test_attributions_of_repeated_keys_and_parts(spark, monkeypatch):
    rng = np.random.default_rng(4)
    x = rng.integers(0, 6, (300, 4)).astype(float)
    y = x[:, 0] * x[:, 1] + 3 * x[:, 2]
    df = spark.createDataFrame([(int(k % 7), *map(float, r), float(t)) for k, (r, t) in enumerate(zip(x, y))], "key long, a double, b double, c double, d double, y double")
    names = ["a", "b", "c", "d"]
    forest = model.rf_regress(df, names, "y", trees=6, max_depth=8)
    whole = sum((F.col(f"phi_{n}") for n in names), F.col("base"))

    def rows():
        out = shap.shap_values(forest, df, "key").withColumn("sum", whole)
        return sorted(tuple(round(v, 8) for v in r) for r in out.collect())

    one = rows()
    monkeypatch.setattr(trees, "SLOT", 50)
    assert len(one) == 300 and rows() == one
    predicted = sorted(round(r.raw_prediction, 6) for r in model.predict(forest, df).collect())
    assert predicted == pytest.approx(sorted(r[-1] for r in one), abs=1e-6)


def repeated(spark, seed=5, copies=4):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.integers(0, 40, 150), rng.integers(0, 2, 150), rng.integers(0, 9, 150)]).astype(float)
    y = x[:, 0] * 3 + x[:, 1] * x[:, 2] + rng.integers(0, 3, 150)
    rows = [(k, *map(float, r), float(t)) for k, (r, t) in enumerate(zip(np.tile(x, (copies, 1)), np.tile(y, copies)))]
    return spark.createDataFrame(rows, "key long, a double, b double, c double, y double")


def test_equal_rows_are_one_item_drawn_as_often(spark):
    """Rows of equal features and label are held once, with the numbers they are drawn by; scoring meets equal features once."""
    df, names = repeated(spark), ["a", "b", "c"]
    x = F.array(*names)
    items = trees._items(df.select(F.col("key").alias("row"), x.alias("x"), "y")).collect()
    assert len(items) == df.select(*names, "y").distinct().count() < 600
    assert sorted(k for i in items for k in i.rows) == list(range(600))
    once, _ = np.unique(np.array([[*i.x, i.y] for i in items]), axis=0, return_counts=True)
    assert len(once) == len(items)
    forest = model.rf_regress(df, names, "y", trees=3)
    rows, points, _ = trees.scored_parts(forest, df, lambda *a: None, "point long")
    assert points.count() == df.select(*names).distinct().count() and rows.count() == 600
    drawn = sum(trees.draws(np.array([r.row]), 0, 42)[0] for r in df.select(F.monotonically_increasing_id().alias("row")).collect())
    root = forest.nodes().where("tree = 0 AND id = 0").first()
    assert root.cover == drawn


def test_large_groups_of_equal_rows_stay_several_items(spark, monkeypatch):
    monkeypatch.setattr(trees, "ALONE", 10)
    df = spark.range(0, 400, 1, 4).select(F.col("id").alias("row"), F.array(F.lit(1.0), (F.col("id") % 40 == 0).cast("double")).alias("x"), F.lit(2.0).alias("y"))
    items = trees._items(df).collect()
    assert sorted(k for i in items for k in i.rows) == list(range(400)) and len(items) == 5  # one of 10 rows, gathered, and 4 of the tasks


def test_grown_counts_the_rows_of_items():
    rng = np.random.default_rng(6)
    x = np.column_stack([rng.integers(0, 12, 60), rng.integers(0, 2, 60)]).astype(float)
    y, m = rng.normal(size=60) + x[:, 0], rng.integers(1, 4, 60)
    once, plain = (trees.grown(a, b, c, None, 5, d) for a, b, c, d in ((x, y, m.astype(float), m.astype(float)), (*(np.repeat(v, m, axis=0) for v in (x, y, np.ones(60))), None)))
    for c in once:
        np.testing.assert_allclose(once[c], plain[c], atol=1e-9)


def test_first_split_above_the_parts_is_exact(spark, monkeypatch):
    """With and without parts below the root: the same middle between two values, means and rows."""
    df, names = repeated(spark), ["a", "b", "c"]
    found = []
    for cells in (10**6, 60):
        monkeypatch.setattr(trees, "CELLS", cells)
        found.append([model.rf_regress(df, names, "y", 1, depth, bootstrap=False).first_splits().first() for depth in (1, None)])
    (a, b), (c, d) = found
    for other in (b, c, d):
        assert tuple(other) == pytest.approx(tuple(a))
    low = df.where(F.col(names[a.feature]) <= a.threshold).agg(F.avg("y"), F.count("y")).first()
    assert (a.left_value, a.left_rows) == pytest.approx(tuple(low)) and a.threshold % 1 == 0.5
    constant = model.rf_regress(df.withColumn("y", F.lit(1.0)), names, "y", 1, None).first_splits().first()
    assert constant.feature is None and constant.left_rows is None


def test_slots_follow_the_points_of_a_part(spark, monkeypatch):
    monkeypatch.setattr(trees, "CELLS", 120)
    monkeypatch.setattr(trees, "SLOT", 5)
    df, names = repeated(spark), ["a", "b", "c"]
    forest = model.rf_regress(df, names, "y", trees=2)
    assert all(len(t.parts()) > 2 for t in forest.tops)
    counts = []
    def score(x, point, tree, part, nodes):
        import pyarrow as pa
        return pa.table({"n": pa.array([len(x)])})
    _, points, met = trees.scored_parts(forest, df, score, "n long")
    counts = [r.n for r in met.collect()]
    n = points.count()
    assert sum(counts) == 2 * n and len(counts) <= sum(len(t.parts()) for t in forest.tops) + 2 * n / 5


def test_predictions_copy_what_they_need_of_the_nodes(spark, monkeypatch):
    """A part's nodes meet its points once, without columns that a prediction does not read; few files of points are dealt by all cores."""
    monkeypatch.setattr(trees, "SLOT", 5)
    df, names = repeated(spark), ["a", "b", "c"]
    forest = model.rf_regress(df, names, "y", trees=2)
    met, scored_parts = [], trees.scored_parts

    def watched(*given, **named):
        met.append((given, named))
        return scored_parts(*given, **named)

    monkeypatch.setattr(trees, "scored_parts", watched)
    plain = model.predict(forest, df)
    _, named = met[0]
    assert not {"cover", "gain"} & set(named["needed"])
    counted = lambda x, *_: pa.table({"n": pa.array([len(x)])})
    _, points, found = scored_parts(forest, df, counted, "n long", **named)
    assert [r.n for r in found.collect()] == [points.count()] * 2
    cores = spark.sparkContext.defaultParallelism
    assert trees._spread(points.coalesce(1)).rdd.getNumPartitions() == cores
    monkeypatch.setattr(trees, "CELLS", 30)  # ten points a slot
    assert sorted(r.raw_prediction for r in model.predict(forest, df).collect()) == pytest.approx(sorted(r.raw_prediction for r in plain.collect()))


def test_items_of_both_zeros_are_one(spark):
    df = spark.createDataFrame([(0, [0.0, 1.0], 2.0), (1, [-0.0, 1.0], 2.0), (2, [0.0, 1.0], -0.0), (3, [0.0, 1.0], 0.0)], "row long, x array<double>, y double")
    assert sorted(sorted(r.rows) for r in trees._items(df).collect()) == [[0, 1], [2, 3]]
