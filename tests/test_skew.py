"""Results must not change when one key holds most rows and nothing may be broadcast."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.operators import clean, derive, describe, hypothesis, profile
from tidemark.operators.skew import spread_join


@pytest.fixture
def no_broadcast(spark):
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    before = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture
def hot(spark):
    rng = np.random.default_rng(9)
    n = 4000
    pdf = pd.DataFrame({"id": np.arange(n), "g": rng.choice(["hot", None, "a", "b", "c"], n, p=[0.5, 0.35, 0.08, 0.05, 0.02])})
    pdf["x"] = rng.lognormal(3, 1, n).round(1)
    pdf.loc[pdf.id % 9 == 0, "x"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("x", F.when(~F.isnan("x"), F.col("x")))
    return pdf, df


def test_spread_join_is_a_plain_join(spark, no_broadcast, hot):
    pdf, df = hot
    stats = df.where("g IN ('hot', 'b')").groupBy("g").agg(F.count("x").alias("c"))
    for how in ("left", "inner"):
        got = spread_join(df, stats, "g", how).orderBy("id").select("id", "g", "c").collect()
        want = df.join(stats, "g", how).orderBy("id").select("id", "g", "c").collect()
        assert got == want


def test_equal_hot_rows_and_warm_keys_are_cut_into_tasks(spark, no_broadcast):
    """100 000 equal rows of one key, as many of null, and 500 warm keys: no task of the join gets a whole hot key."""
    sizes = {"spark.sql.shuffle.partitions": "200", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128k"}
    before = {k: spark.conf.get(k) for k in sizes}
    for k, v in sizes.items():
        spark.conf.set(k, v)
    try:
        hot = spark.range(0, 100_000, 1, 20).select(F.lit("hot").alias("g"), F.lit("same text " * 5).alias("t"))
        none = hot.select(F.lit(None).cast("string").alias("g"), "t")
        warm = spark.range(0, 25_000, 1, 8).select(F.concat(F.lit("w"), F.col("id") % 500).alias("g"), F.lit("t").alias("t"))
        rows = hot.unionAll(none).unionAll(warm)
        stats = rows.where("g IS NOT NULL").groupBy("g").agg(F.count("t").alias("c"))
        found = spread_join(rows, stats, "g").withColumn("task", F.spark_partition_id()).cache()
        per_task = {r["task"]: r["count"] for r in found.groupBy("task").count().collect()}
        assert sum(per_task.values()) == 225_000 and max(per_task.values()) < 50_000
        assert found.where("g = 'hot' AND c = 100000").count() == 100_000 and found.where("g IS NULL AND c IS NULL").count() == 100_000
        assert found.where("g LIKE 'w%' AND c = 50").count() == 25_000
        found.unpersist()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_group_operators(spark, no_broadcast, hot):
    pdf, df = hot
    medians = pdf.groupby("g").x.median()
    filled = clean.impute_group_median(df, "g", ["x"]).orderBy("id").toPandas()
    want = pdf.x.fillna(pdf.g.map(medians))
    np.testing.assert_allclose(filled.x.astype(float), want)
    context = derive.group_context(df, "g", "id", "x", "x").orderBy("id").toPandas()
    np.testing.assert_allclose(context.group_median_price.astype(float), pdf.g.map(medians).astype(float))
    rare = clean.pool_rare(df, "g", 200).orderBy("id").toPandas()
    counts = pdf.g.value_counts()
    assert rare.g.tolist() == [None if g is None else g if counts[g] >= 200 else "Other" for g in pdf.g]
    segment = derive.binary_segment(df, "id", "g", "many", "one").orderBy("id").toPandas()
    assert segment.segment.tolist() == ["one" if g is None else "many" for g in pdf.g]


def test_box_and_levene(spark, no_broadcast, hot):
    pdf, df = hot
    known = pdf.dropna()
    box = describe.box_stats(df, "g", "x").toPandas().set_index("g")
    for g, x in known.groupby("g").x:
        q1, q3 = x.quantile([0.25, 0.75])
        inside = x[(x >= q1 - 1.5 * (q3 - q1)) & (x <= q3 + 1.5 * (q3 - q1))]
        assert box.loc[g, "outliers"] == len(x) - len(inside) and box.loc[g, "whisker_high"] == inside.max()
    r = hypothesis.levene(df, "g", "x").first()
    z = {g: (x - x.median()).abs() for g, x in known.groupby("g").x}
    n, k = sum(map(len, z.values())), len(z)
    grand = sum(v.sum() for v in z.values()) / n
    between = sum(len(v) * (v.mean() - grand) ** 2 for v in z.values()) / (k - 1)
    within = sum(((v - v.mean()) ** 2).sum() for v in z.values()) / (n - k)
    assert r["statistic"] == pytest.approx(between / within, rel=1e-9)


def test_orphans_with_hot_and_null_child_keys(spark, no_broadcast, hot):
    pdf, df = hot
    parent = spark.createDataFrame([("a",), ("hot",)], "k string")
    r = profile.fk_orphans(df, "g", parent, "k", "c").first()
    assert r["count"] == (~pdf.g.isin(["a", "hot"])).sum()


def test_membership_with_half_of_the_values_missing(spark):
    rows = spark.range(4000).select("id", F.when(F.col("id") % 2 == 0, (F.col("id") % 10).cast("string")).when(F.col("id") % 3 == 0, "hot").alias("area"))
    lookup = spark.createDataFrame([("2",), ("4",), ("4",), (None,), ("hot",)], "n string")
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        marked = clean.with_membership(rows, "area", lookup)
        assert marked.columns == ["id", "area", "known"] and marked._jdf.queryExecution().executedPlan().toString().count("Range (") == 1
        found = {(r.area, r.known): r.n for r in marked.groupBy("area", "known").agg(F.count("*").alias("n")).collect()}
        assert found == {("0", False): 400, ("2", True): 400, ("4", True): 400, ("6", False): 400, ("8", False): 400, ("hot", True): 667, (None, False): 1333}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
