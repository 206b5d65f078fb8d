import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import profile, quality


def test_exact_duplicates_and_key_uniqueness(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,), (2,)], "k int")
    members, extras = quality.exact_duplicates(df, ["k"], "c").first(), profile.key_uniqueness(df, ["k"], "c").first()
    assert (members["total"], members["count"], members["pct"]) == (5, 4, 80.0)
    assert (extras["total"], extras["count"]) == (5, 2)


def brute_force(rows, tolerance=0.05):
    """Union-find over all pairs of each block."""
    parent = {r[0]: r[0] for r in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, block_a, p) in enumerate(rows):
        for b, block_b, q in rows[i + 1 :]:
            if block_a != block_b or p is None or q is None:
                continue
            mean = (p + q) / 2
            if p == q == 0 or (mean > 0 and abs(p - q) / mean <= tolerance):
                parent[max(find(a), find(b))] = min(find(a), find(b))
    groups = {}
    for r in rows:
        groups.setdefault(find(r[0]), []).append(r[0])
    return {m: min(g) for g in groups.values() if len(g) > 1 for m in g}


def test_fuzzy_duplicates_fixture(spark):
    rows = [(i, 1, p) for i, p in enumerate([100.0, 104.0, 108.0, 200.0, 0.0, 0.0, None])]
    df = spark.createDataFrame(rows, "id int, b int, price double")
    got = {r["id"]: r["fuzzy_group"] for r in quality.fuzzy_duplicates(df, "id", [F.col("b")], "price").collect()}
    assert got == {0: 0, 1: 0, 2: 0, 4: 4, 5: 4}


@pytest.mark.parametrize("tolerance", [0.05, 0.4])
def test_fuzzy_duplicates_against_all_pairs(spark, tolerance):
    rng = random.Random(7)
    prices = [0.0, None, -3.0, 1e-300, 1e300]
    rows = []
    for i in range(900):
        price = rng.choice(prices) if rng.random() < 0.15 else round(rng.lognormvariate(3, 1.2), 2)
        rows.append((i, rng.randrange(12), price))
    df = spark.createDataFrame(rows, "id int, b int, price double")
    got = {r["id"]: r["fuzzy_group"] for r in quality.fuzzy_duplicates(df, "id", [F.col("b")], "price", tolerance).collect()}
    assert got == brute_force(rows, tolerance)


def test_fuzzy_duplicates_exactly_on_the_tolerance(spark):
    # 39 and 41 differ by exactly 5 % of their mean, 39 and 41.01 by more
    df = spark.createDataFrame([(1, 1, 39.0), (2, 1, 41.0), (3, 2, 39.0), (4, 2, 41.01)], "id int, b int, price double")
    got = {r["id"] for r in quality.fuzzy_duplicates(df, "id", [F.col("b")], "price").collect()}
    assert got == {1, 2}


def test_fuzzy_duplicates_null_block_is_left_out(spark):
    df = spark.createDataFrame([(1, None, 5.0), (2, None, 5.0)], "id int, b int, price double")
    assert quality.fuzzy_duplicates(df, "id", [F.col("b")], "price").count() == 0


def test_location_block_rounds_to_four_places(spark):
    df = spark.createDataFrame([(1, 9, 55.94525, -3.1, 10.0), (2, 9, 55.94523, -3.1, 10.0), (3, 9, 55.9456, -3.1, 10.0)], "id int, host int, lat double, lon double, price double")
    got = quality.fuzzy_duplicates(df, "id", quality.location_block("host", "lat", "lon"), "price")
    assert {r["id"] for r in got.collect()} == {1, 2}


def test_iqr_bounds_and_strictness(spark):
    # q1 = 1, q3 = 3: bounds -2 and 6
    df = spark.createDataFrame([(v,) for v in (0.0, 1.0, 2.0, 3.0, 6.0, None)], "x double")
    b = quality.iqr_bounds(df, ["x"]).first()
    assert (b["q1"], b["q3"], b["lower_bound"], b["upper_bound"]) == (1.0, 3.0, -2.0, 6.0)
    assert quality.iqr_outliers(df, ["x"]).count() == 0
    more = spark.createDataFrame([(v,) for v in [1.0, 2.0, 3.0] * 10 + [6.01, None]], "x double")
    assert [r["x"] for r in quality.iqr_outliers(more, ["x"]).collect()] == [6.01]
    s = quality.iqr_summary(more, ["x"]).first()
    assert (s["evaluated"], s["outlier_count"]) == (31, 1)


def test_rule_violations_null_counts(spark):
    df = spark.createDataFrame([(None, 95.0), (-1.0, None), (2.0, 3.0)], "p double, lat double")
    rules = {"p": (F.col("p").isNotNull(), F.col("p") >= 0), "lat": (F.lit(True), F.col("lat").between(-90, 90))}
    got = {r["rule"]: (r["evaluated"], r["violations"]) for r in quality.rule_violations(df, rules).collect()}
    assert got == {"p": (2, 1), "lat": (3, 2)}


def test_fk_orphans(spark):
    child = spark.createDataFrame([(1,), (None,), (9,)], "k int")
    parent = spark.createDataFrame([(1,)], "id int")
    assert profile.fk_orphans(child, "k", parent, "id", "c").first()["count"] == 2
    with_null = spark.createDataFrame([(1,), (None,)], "id int")
    assert profile.fk_orphans(child, "k", with_null, "id", "c").first()["count"] == 1


def test_empty_tables_give_zero_shares(spark):
    empty = spark.createDataFrame([], "k int")
    assert profile.key_uniqueness(empty, ["k"], "c").first()["pct"] == 0.0
    assert quality.exact_duplicates(empty, ["k"], "c").first()["pct"] == 0.0


def test_profile_keeps_long_ids_exact(spark):
    df = spark.createDataFrame([(1463425312345678901, None), (1463425312345678902, None)], "id long, blank double")
    got = {r["column"]: r for r in profile.profile_columns(df).collect()}
    assert got["id"]["max_value"] == "1463425312345678902" and got["id"]["cardinality"] == 2
    assert got["blank"]["null_pct"] == 100.0 and got["blank"]["cardinality"] == 0


def test_sample_values_in_row_order(spark):
    df = spark.createDataFrame([(3, "c"), (1, "z"), (2, None), (4, "z"), (5, "a"), (6, "b")], "at int, x string")
    got = [r["sample"] for r in profile.sample_values(df, ["x"], "at").orderBy("position").collect()]
    assert got == ["z", "c", "a"]


def test_completeness_of_absent_column(spark):
    df = spark.createDataFrame([(1,), (None,)], "a int")
    got = {r["field"]: r for r in profile.completeness(df, ["a", "b"]).collect()}
    assert (got["a"]["missing"], got["a"]["missing_pct"]) == (1, 50.0)
    assert got["b"]["missing"] is None and got["b"]["status"] == "column not found"


def test_date_range_is_strict(spark):
    df = spark.createDataFrame([("2026-01-01",), ("bad",)], "d string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|CANNOT_PARSE|malformed|cannot be cast|Cannot"):
        profile.date_range(df, "d").collect()


def test_sample_values_ties_and_short_columns(spark):
    df = spark.createDataFrame([(1, "b", None), (1, "a", None), (2, "a", "only"), (3, "c", "only")], "at int, x string, y string")
    got = [(r["column"], r["position"], r["sample"]) for r in profile.sample_values(df, ["x", "y"], "at").collect()]
    assert sorted(got) == [("x", 1, "a"), ("x", 2, "b"), ("x", 3, "c"), ("y", 1, "only")]


def test_profile_tells_long_texts_apart(spark):
    df = spark.createDataFrame([("x" * 200 + "a",), ("x" * 200 + "b",), ("x" * 200 + "a",)], "t string")
    assert profile.profile_columns(df).first()["cardinality"] == 2
    assert profile.profile_columns(df, exact=False).first()["cardinality"] == 2


def test_profiles_merge_from_sketches(spark):
    """Sketches of three extracts, kept as a table, against the exact profile of all rows."""
    rows = spark.range(60_000).select(
        "id", (F.col("id") % 17_011).cast("double").alias("d"), F.concat(F.lit("text "), F.col("id") % 23_000).alias("t"), (F.col("id") % 3 == 0).alias("b"),
        F.when(F.col("id") % 4 > 0, F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 900).cast("int"))).alias("day"), F.lit(None).cast("int").alias("none"),
    )
    parts = [rows.where("id < 20000"), rows.where("id BETWEEN 15000 AND 40000"), rows.where("id >= 40000")]
    kept = profile.column_sketches(parts[0])
    for p in parts[1:]:
        kept = kept.unionByName(profile.column_sketches(p))
    found = {r.column: r for r in profile.merged_profile(kept).collect()}
    exact = {r.column: r for r in profile.profile_columns(rows).collect()}
    assert {c: r.cardinality for c, r in exact.items()} == {"id": 60_000, "d": 17_011, "t": 23_000, "b": 2, "day": 675, "none": 0}
    for c, r in exact.items():
        assert abs(found[c].cardinality - r.cardinality) <= 0.025 * r.cardinality
        assert (found[c].dtype, found[c].min_value, found[c].max_value) == (r.dtype, r.min_value, r.max_value)
    assert found["none"].null_pct == 100 and found["id"].null_pct == 0
    assert profile.profile_columns(rows, ["id"], exact=False).first().min_value == "0"
