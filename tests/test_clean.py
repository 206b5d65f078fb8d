from datetime import date

import pytest
from pyspark.sql import functions as F

from tidemark.functions import parse
from tidemark.functions.moments import safe_corr, skew_g1
from tidemark.operators import clean, derive


def column(df, name="y"):
    return [r[name] for r in df.collect()]


def one(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i long, x {kind}").orderBy("i")


def test_parse_currency(spark):
    df = one(spark, ["$1,234.50", "abc", None, "1.5d", "$-5", "NaN", "1e3"])
    assert column(df.select(parse.parse_currency(F.col("x")).alias("y"))) == [1234.5, None, None, None, -5.0, None, 1000.0]


def test_parse_currency_skips_absent_columns(spark):
    df = clean.parse_currency(one(spark, ["$1"]), ["absent", "x"])
    assert df.columns == ["i", "x"] and column(df, "x") == [1.0]


def test_parse_date(spark):
    df = one(spark, ["2026-06-23", "2026-13-01", "bad", None, "2026"])
    assert column(df.select(parse.parse_date(F.col("x")).alias("y"))) == [date(2026, 6, 23), None, None, None, None]


def test_parse_percent(spark):
    df = one(spark, ["90%", "90%%", "n/a", None])
    assert column(df.select(parse.parse_percent(F.col("x")).alias("y"))) == [90.0, 90.0, None, None]


def test_normalise_text(spark):
    df = one(spark, ["\t Entire Home/Apt \n", None])
    assert column(df.select(parse.normalise_text(F.col("x")).alias("y"))) == ["entire home/apt", None]


def test_pool_rare_keeps_null(spark):
    out = clean.pool_rare(one(spark, ["a", "a", "b", None]), "x", 2)
    assert column(out.orderBy("i"), "x") == ["a", "a", "Other", None]


def test_impute_group_median(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (2, "a", 3.0), (3, "a", None), (4, None, 9.0), (5, None, None), (6, "b", None)], "i int, g string, x double")
    out = clean.impute_group_median(df, "g", ["x"]).orderBy("i")
    assert column(out, "x") == [1.0, 3.0, 2.0, 9.0, None, None]


def test_imputation_leaves_other_columns_alone(spark):
    df = spark.createDataFrame([(1, "a", 1.0, None), (2, "a", 3.0, 4.5)], "i int, g string, beds double, score double")
    assert column(clean.impute_group_median(df, "g", ["beds"]).orderBy("i"), "score") == [None, 4.5]


def test_validation_rules(spark):
    rows = [(1, 1.0, None, 0.0), (2, None, 1.0, 0.0), (3, 1.0, 95.0, 0.0), (4, -1.0, 1.0, 0.0), (5, -1.0, None, 0.0)]
    df = spark.createDataFrame(rows, "i int, price double, lat double, lon double")
    rules = clean.range_rules({"lat": (-90, 90), "lon": (-180, 180)}, {"price": 0})
    assert column(clean.validate_keep(df, rules), "i") == [2]
    r = clean.validate_report(df, rules).first()
    assert (r["rows"], r["dropped"], r["failed_price"], r["failed_lat"], r["failed_lon"]) == (5, 4, 2, 3, 0)


def test_conform_lookup_counts_null_and_keeps_rows(spark):
    df = one(spark, [" a ", "b", None, "zz", "c "])
    lookup = spark.createDataFrame([("a",), ("c",)], "n string")
    r = clean.conform_lookup(df, "x", lookup, "n").first()
    assert (r["unmatched_rows"], r["sample"]) == (3, "b|zz")


def test_occupancy(spark):
    entities = spark.createDataFrame([(i,) for i in range(4)], "id long")
    daily = [(1, "f")] * 10 + [(2, "t")] * 365 + [(3, "t")] * 370
    daily = spark.createDataFrame(daily, "listing_id long, available string")
    out = derive.occupancy_rate(entities, "id", daily, "listing_id", "available").orderBy("id")
    assert column(out, "occupancy_rate") == [None, 1.0, 0.0, -5 / 365]


def test_review_frequency(spark):
    rows = [(1, 7, None), (2, 7, date(2020, 1, 1)), (3, None, date(2019, 1, 1)), (4, 6, date(2019, 7, 2))]
    df = spark.createDataFrame(rows, "i int, n int, d date")
    got = column(df.select(derive.review_frequency(F.col("n"), F.col("d"), date(2020, 1, 1)).alias("y")))
    assert got[:3] == [0.0, 0.0, 0.0] and got[3] == pytest.approx(6 / (183 / 30.44))


def test_tenure_null_in_null_out(spark):
    df = spark.createDataFrame([(None,), (date(2019, 1, 1),)], "d date")
    assert column(df.select(derive.tenure_years(F.col("d"), date(2020, 1, 1)).alias("y"))) == [None, 1.0]


def test_price_per_unit(spark):
    df = spark.createDataFrame([(100.0, None), (100.0, 0.0), (100.0, 0.5), (100.0, 4.0)], "p double, u double")
    assert column(df.select(derive.price_per_unit(F.col("p"), F.col("u")).alias("y"))) == [None, 100.0, 100.0, 25.0]


def test_skew(spark):
    df = spark.createDataFrame([("a", v) for v in (1.0, 2.0, 3.0, 10.0)] + [("b", 5.0)] * 3 + [("c", 1.0), ("c", 2.0)], "g string, x double")
    got = {r["g"]: r["y"] for r in df.groupBy("g").agg(skew_g1(F.col("x")).alias("y")).collect()}
    assert got["a"] == pytest.approx(1.763632614803888) and got["b"] == 0.0 and got["c"] is None


def test_log_target_branches(spark):
    skewed = spark.createDataFrame([(v,) for v in (1.0, 1.0, 1.0, 1.0, 1000.0, -1.0, 0.0, None)], "p double")
    r = derive.log_target(skewed, "p").collect()
    assert r[4]["target"] == 3.0 and r[5]["target"] is None and r[6]["target"] is None and r[0]["target_kind"] == "log_p"
    flat = spark.createDataFrame([(float(v),) for v in range(10)], "p double")
    assert column(derive.log_target(flat, "p"), "target") == [float(v) for v in range(10)]


def test_round_coord_is_half_even(spark):
    df = spark.createDataFrame([(55.94525,), (55.94535,)], "x double")
    assert column(df.select(parse.round_coord(F.col("x")).alias("y")))[0] == 55.9452


def test_clip_text(spark):
    df = one(spark, ["a|b\nc", "x" * 41, "y" * 40])
    assert column(df.select(parse.clip_text(F.col("x")).alias("y"))) == ["a\\|b c", "x" * 37 + "...", "y" * 40]


def test_segment_of_missing_group_is_single(spark):
    df = spark.createDataFrame([(1, 7), (2, 7), (3, 8), (4, None), (5, None)], "id int, h int")
    out = derive.binary_segment(df, "id", "h", "many", "one").orderBy("id")
    assert column(out, "segment") == ["many", "many", "one", "one", "one"]


def test_group_context_null_group(spark):
    df = spark.createDataFrame([(1, "a", 10.0, 4.0), (2, "a", 20.0, None), (3, None, 99.0, 5.0)], "id int, g string, p double, r double")
    rows = derive.group_context(df, "g", "id", "p", "r").orderBy("id").collect()
    assert [tuple(r)[4:] for r in rows] == [(15.0, 2, 4.0), (15.0, 2, 4.0), (None, None, None)]


def test_top_k_puts_null_last(spark):
    df = one(spark, [1, None, 2], "int")
    assert column(derive.top_k(df, [F.desc_nulls_last("x"), F.col("i")], 3), "x") == [2, 1, None]


def test_pairwise_corr(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, None), (3.0, 5.0), (None, 1.0), (4.0, 4.0)], "x double, y double")
    r = df.agg(safe_corr(F.col("x"), F.col("y")).alias("r"), safe_corr(F.col("x"), F.lit(1.0)).alias("c")).first()
    assert r["r"] == pytest.approx(0.785714285714) and r["c"] is None
