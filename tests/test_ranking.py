import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.operators.ranking import field_quantiles, group_quantiles, order_statistics, rank_sums


def frame(seed=3, n=6000):
    """Values of every magnitude and sign, narrow clusters, heavy ties; one group holds most rows."""
    rng = np.random.default_rng(seed)
    parts = [
        rng.normal(0, 1, n // 6), rng.lognormal(5, 3, n // 6).round(2), -rng.exponential(1e-300, n // 6),
        rng.integers(-3, 4, n // 6).astype(float), 1.7e15 + rng.integers(0, 1000, n // 6) / 8, np.full(n // 6, 0.0),
    ]
    v = np.concatenate(parts)
    v[:4] = [1.7976931348623157e308, -1.7976931348623157e308, 5e-324, -0.0]
    g = rng.choice(["hot", "b", "c", None], n, p=[0.7, 0.15, 0.1, 0.05])
    pdf = pd.DataFrame({"g": g, "v": v})
    pdf.loc[::13, "v"] = np.nan
    return pdf


def load(spark, pdf):
    df = spark.createDataFrame(pdf)
    return df.withColumn("v", F.when(~F.isnan("v"), F.col("v")))


def test_group_quantiles_match_pandas(spark):
    pdf = frame()
    pdf = pdf[pdf.v.abs() < 1e307]
    probs = {"p0": 0.0, "p05": 0.05, "q1": 0.25, "m": 0.5, "p999": 0.999, "p1": 1.0}
    got = group_quantiles(load(spark, pdf), ["g"], "v", probs).toPandas().set_index("g").sort_index()
    want = pdf.dropna().groupby("g").v.quantile(list(probs.values())).unstack()
    np.testing.assert_allclose(got[list(probs)].to_numpy(), want.to_numpy(), rtol=1e-12)
    assert got["n"].to_dict() == pdf.dropna().groupby("g").size().to_dict()


def test_order_statistics_at_every_magnitude(spark):
    pdf = frame()
    values = np.sort(pdf.v.dropna().to_numpy())
    at = {f"p{i}": i for i in (0, 1, 2, 500, 2500, len(values) // 2, len(values) - 2, len(values) - 1)}
    r = order_statistics(load(spark, pdf), [], "v", {k: f"{i}L" for k, i in at.items()}).first()
    for name, i in at.items():
        assert r[name] == values[i]
        assert r[f"{name}_below"] == (values < values[i]).sum()


def test_group_without_values_has_no_row(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", None)], "g string, v double")
    assert [tuple(r) for r in group_quantiles(df, ["g"], "v", {"m": 0.5}).collect()] == [("a", 1, 1.0)]


def test_field_quantiles(spark):
    df = spark.createDataFrame([(1, 10.0), (2, None), (3, 30.0)], "a int, b double")
    got = {r["field"]: (r["n"], r["m"]) for r in field_quantiles(df, [], ["a", "b"], {"m": 0.5}).collect()}
    assert got == {"a": (3, 2.0), "b": (2, 20.0)}


def test_rank_sums_match_midranks(spark):
    pdf = frame(seed=5)
    r = rank_sums(load(spark, pdf), [], "v", F.col("g") == "hot", F.col("g") == "b").first()
    both = pdf[pdf.g.isin(["hot", "b"])].dropna()
    ranks, sizes = both.v.rank(), both.groupby("v").size()
    assert r["rank_sum_a"] == ranks[both.g == "hot"].sum()
    assert r["tie_term"] == pytest.approx(float((sizes**3 - sizes).sum()), rel=1e-12)
    assert (r["n_a"], r["n_b"]) == ((both.g == "hot").sum(), (both.g == "b").sum())
    back = rank_sums(load(spark, pdf), [], "v", F.col("g") == "b", F.col("g") == "hot").first()
    u1 = r["rank_sum_a"] - r["n_a"] * (r["n_a"] + 1) / 2
    u2 = back["rank_sum_a"] - back["n_a"] * (back["n_a"] + 1) / 2
    assert u1 + u2 == r["n_a"] * r["n_b"]


def test_rank_sums_per_group(spark):
    df = spark.createDataFrame([("x", "a", 1.0), ("x", "b", 2.0), ("y", "a", 5.0), ("y", "b", 5.0), ("y", "a", 7.0)], "h string, g string, v double")
    got = {r["h"]: r["rank_sum_a"] for r in rank_sums(df, ["h"], "v", F.col("g") == "a", F.col("g") == "b").collect()}
    assert got == {"x": 1.0, "y": 4.5}
