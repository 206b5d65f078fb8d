import math
import random
from datetime import date

import numpy as np
import pytest

from tidemark.operators import describe


def test_histogram_matches_numpy(spark):
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.exponential(50, 3000).round(2), [0.0, 400.0]])
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    got = describe.histogram(df, "x", 50).orderBy("bin").collect()
    counts, edges = np.histogram(x, bins=50)
    assert [r["count"] for r in got] == counts.tolist()
    np.testing.assert_allclose([r["low"] for r in got], edges[:-1])


def test_histogram_closes_last_bin(spark):
    df = spark.createDataFrame([(float(v),) for v in range(11)], "x double")
    assert [r["count"] for r in describe.histogram(df, "x", 5).orderBy("bin").collect()] == [2, 2, 2, 2, 3]
    one = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    assert sum(r["count"] for r in describe.histogram(one, "x", 4).collect()) == 2


def test_histogram_fixed_matches_numpy(spark):
    x = [1.0, 1.05, 1.1, 4.8, 4.95, 5.0, 0.99, 5.01, None] + [round(1 + i * 0.05, 2) for i in range(81)]
    df = spark.createDataFrame([(v,) for v in x], "x double")
    got = describe.histogram_fixed(df, "x", 1.0, 5.0, 0.05).orderBy("bin").collect()
    counts, _ = np.histogram([v for v in x if v is not None], bins=1.0 + np.arange(81) * 0.05)
    assert [r["count"] for r in got] == counts.tolist()


def test_concentration_brute_force(spark):
    rng = random.Random(1)
    hosts = [int(rng.paretovariate(0.7)) % 60 for _ in range(700)] + [None] * 5
    df = spark.createDataFrame([(h,) for h in hosts], "h int")
    sizes = sorted((hosts.count(h) for h in set(hosts) - {None}), reverse=True)
    top = max(1, math.ceil(len(sizes) * 0.1))
    r = describe.concentration(df, "h").first()
    assert (r["n_groups"], r["n_rows"], r["max_rows"], r["top_groups"]) == (len(sizes), sum(sizes), sizes[0], top)
    assert r["top_rows"] == sum(sizes[:top]) and r["median_rows"] == int(np.median(sizes))


def test_box_whiskers(spark):
    df = spark.createDataFrame([("a", float(v)) for v in (1, 2, 3, 4, 100)] + [("b", 5.0), (None, 1.0)], "g string, x double")
    got = {r["g"]: r for r in describe.box_stats(df, "g", "x").collect()}
    a = got["a"]
    assert (a["q1"], a["median"], a["q3"], a["whisker_low"], a["whisker_high"], a["outliers"]) == (2.0, 3.0, 4.0, 1.0, 4.0, 1)
    assert set(got) == {"a", "b"}
    assert [r["x"] for r in describe.box_outliers(df, "g", "x").collect()] == [100.0]


def test_season(spark):
    rows = [(date(2020, 3, 1), 5.0), (date(2021, 3, 9), 7.0), (date(2020, 7, 1), 6.0), (date(2020, 8, 1), None), (None, 99.0)]
    df = spark.createDataFrame(rows, "d date, p double")
    months = {r["month"]: r["mean"] for r in describe.monthly_means(df, "d", "p").collect()}
    assert len(months) == 12 and months[3] == 6.0 and months[8] is None
    r = describe.seasonal_trend(df, "d", "p").first()
    assert (r["status"], r["peak_month"], r["lowest_month"]) == ("ok", "Mar", "Mar")
    assert describe.seasonal_trend(df.drop("p"), "d", "p").first()["status"] == "unavailable"


def test_host_counts_with_null_host(spark):
    df = spark.createDataFrame([(1, 7, "t"), (2, 7, "f"), (3, 8, "f"), (4, None, "t"), (5, None, "f")], "id int, h int, f string")
    r = describe.host_counts(df, "h", "f", "id").first()
    assert tuple(r) == (1, 1, 2, 1)


def test_extreme_groups_ties_and_nulls(spark):
    df = spark.createDataFrame([("b", 5.0), ("a", 5.0), ("c", 1.0), ("z", None), (None, 100.0)], "g string, x double")
    r = describe.extreme_groups(df, "g", "x").first()
    assert (r["n_groups"], r["highest_group"], r["lowest_group"], r["overall_median"]) == (3, "a", "c", 5.0)


def test_segments_in_fixed_order(spark):
    df = spark.createDataFrame([("b", 1.0), ("b", 3.0), (None, 9.0)], "s string, x double")
    rows = describe.means_by_segment(df, "s", ["x"], ["a", "b"]).orderBy("position").collect()
    assert [(r["s"], r["x"]) for r in rows] == [("a", None), ("b", 2.0)]


@pytest.mark.parametrize("values,want", [([1.0, 2.0, None, 3.0], (3, 25.0, 2.0, 2.0, 1.0)), ([None], (0, 100.0, None, None, None))])
def test_describe_numeric(spark, values, want):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    r = describe.describe_numeric(df, "x").first()
    assert (r["count"], r["missing_pct"], r["mean"], r["median"], r["std"]) == want
