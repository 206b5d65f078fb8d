"""Data quality and profiling."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.common import LISTING, query, role, rounded, table
from tidemark.operators import profile, quality

LINE_KEYS = "CASE WHEN l_linenumber = 7 THEN NULL ELSE l_orderkey END AS k, l_linenumber"


@query("q1_exact_duplicates", """
    SELECT 'lines' AS "check", CAST(SUM(n) AS BIGINT) AS total, CAST(SUM(CASE WHEN n > 1 THEN n ELSE 0 END) AS BIGINT) AS count,
           round(SUM(CASE WHEN n > 1 THEN n ELSE 0 END) / SUM(n) * 100e0, 9) AS pct
    FROM (SELECT COUNT(*) AS n FROM (SELECT CASE WHEN l_linenumber = 7 THEN NULL ELSE l_orderkey END AS k, l_linenumber FROM {lineitem}) l GROUP BY k, l_linenumber) q
    UNION ALL SELECT 'events', COUNT(*), COUNT(*) - COUNT(DISTINCT event_id), 0 FROM {events}""")
def exact_duplicates(spark, sf):
    lines = role(spark, sf, f"SELECT {LINE_KEYS} FROM {{lineitem}}")
    checks = {"lines": (lines, ["k", "l_linenumber"]), "events": (table(spark, sf, "events"), ["event_id"])}
    return rounded(quality.exact_duplicate_checks(checks), 9, "pct")


# Blocks of lines with the same supplier, quantity and discount; some prices are missing, zero or negative.
BLOCKS = """SELECT l_orderkey * 1000000 + l_partkey * 10 + l_linenumber AS id, l_suppkey, l_quantity, l_discount,
                   CASE WHEN l_linenumber = 7 AND l_tax < 2e-2 THEN NULL WHEN l_linenumber = 6 AND l_tax < 3e-2 THEN 0e0
                        WHEN l_linenumber = 5 AND l_tax < 1e-2 THEN -l_extendedprice ELSE l_extendedprice END AS price
            FROM {lineitem}"""


@query("q2_fuzzy_duplicates", f"""
    WITH b AS (SELECT * FROM ({BLOCKS}) x WHERE price >= 0),
         p AS (SELECT *, lag(price) OVER (PARTITION BY l_suppkey, l_quantity, l_discount ORDER BY price, id) AS before FROM b),
         r AS (SELECT *, SUM(CASE WHEN (before = 0 AND price = 0) OR ((before + price) / 2 > 0 AND abs(before - price) / ((before + price) / 2) <= 5e-2)
                                  THEN 0 ELSE 1 END) OVER (PARTITION BY l_suppkey, l_quantity, l_discount ORDER BY price, id ROWS UNBOUNDED PRECEDING) AS run FROM p),
         g AS (SELECT *, COUNT(*) OVER (PARTITION BY l_suppkey, l_quantity, l_discount, run) AS n,
                      MIN(id) OVER (PARTITION BY l_suppkey, l_quantity, l_discount, run) AS fuzzy_group FROM r)
    SELECT id, l_suppkey, l_quantity, l_discount, price, fuzzy_group FROM g WHERE n >= 2""")
def fuzzy_duplicates(spark, sf):
    block = [F.col("l_suppkey"), F.col("l_quantity"), F.col("l_discount")]
    return quality.fuzzy_duplicates(role(spark, sf, BLOCKS), "id", block, "price")


FIELDS = ["value", "day_share", "user_id"]
EVENTS = """SELECT event_id, user_id, CASE WHEN event_id % 50 = 0 THEN NULL ELSE value END AS value,
                   CASE WHEN event_type = 'error' THEN NULL ELSE value * value / 1e2 END AS day_share FROM {events}"""
BOUNDS = f"""SELECT f AS field, COUNT(x) AS n, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.75) AS q3,
       q1 - 1.5e0 * (q3 - q1) AS lower_bound, q3 + 1.5e0 * (q3 - q1) AS upper_bound FROM (
       SELECT 'value' AS f, value AS x FROM ({EVENTS}) e UNION ALL SELECT 'day_share', day_share FROM ({EVENTS}) e
       UNION ALL SELECT 'user_id', CAST(user_id AS DOUBLE) FROM ({EVENTS}) e) t WHERE x IS NOT NULL GROUP BY f"""


@query("q3_iqr_bounds", f"SELECT field, n, round(q1, 6) AS q1, round(q3, 6) AS q3, round(lower_bound, 6) AS lower_bound, round(upper_bound, 6) AS upper_bound FROM ({BOUNDS}) b")
def iqr_bounds(spark, sf):
    return rounded(quality.iqr_bounds(role(spark, sf, EVENTS), FIELDS), 6, "q1", "q3", "lower_bound", "upper_bound")


def _flag(field: str) -> str:
    edge = f"(SELECT {{}}_bound FROM b WHERE field = '{field}')"
    return f"coalesce({field} < {edge.format('lower')} OR {field} > {edge.format('upper')}, false)"


@query("q4_iqr_outliers", f"""
    WITH b AS ({BOUNDS}) SELECT *, {", ".join(f"{_flag(f)} AS {f}_outlier" for f in FIELDS)} FROM ({EVENTS}) e
    WHERE {" OR ".join(_flag(f) for f in FIELDS)}""")
def iqr_outliers(spark, sf):
    return quality.iqr_outliers(role(spark, sf, EVENTS), FIELDS)


@query("q5_iqr_summary", f"""
    WITH b AS ({BOUNDS}) SELECT * FROM ({" UNION ALL ".join(
        f"SELECT '{f}' AS field, round_even((SELECT lower_bound FROM b WHERE field = '{f}'), 2) AS lower_bound, "
        f"round_even((SELECT upper_bound FROM b WHERE field = '{f}'), 2) AS upper_bound, COUNT({f}) AS evaluated, "
        f"COUNT(*) FILTER (WHERE {_flag(f)}) AS outlier_count, round(COUNT(*) FILTER (WHERE {_flag(f)}) / COUNT({f}) * 100e0, 9) AS outlier_pct "
        f"FROM ({EVENTS}) e" for f in FIELDS)}) q""")
def iqr_summary(spark, sf):
    return rounded(quality.iqr_summary(role(spark, sf, EVENTS), FIELDS), 9, "outlier_pct")


def _rule(name: str, applies: str, fine: str) -> str:
    return f"""SELECT '{name}' AS rule, COUNT(*) FILTER (WHERE {applies}) AS evaluated,
        COUNT(*) FILTER (WHERE {applies} AND NOT coalesce({fine}, false)) AS violations,
        round(COUNT(*) FILTER (WHERE {applies} AND NOT coalesce({fine}, false)) / COUNT(*) FILTER (WHERE {applies}) * 100e0, 9) AS pct FROM ({LISTING}) l"""


@query("q6_rule_violations", " UNION ALL ".join([
    _rule("price >= 0", "price IS NOT NULL", "price >= 0"),
    _rule("latitude in range", "true", "latitude BETWEEN -90 AND 90"),
    _rule("longitude in range", "true", "longitude BETWEEN -180 AND 180"),
    _rule("reviews in [0, 100]", "true", "n_reviews BETWEEN 0 AND 100"),
]))
def rule_violations(spark, sf):
    every = F.lit(True)
    rules = {
        "price >= 0": (F.col("price").isNotNull(), F.col("price") >= 0),
        "latitude in range": (every, F.col("latitude").between(-90, 90)),
        "longitude in range": (every, F.col("longitude").between(-180, 180)),
        "reviews in [0, 100]": (every, F.col("n_reviews").between(0, 100)),
    }
    return rounded(quality.rule_violations(role(spark, sf, LISTING), rules), 9, "pct")


# Column, SQL type name on the Spark side, numeric or not.
PROFILED = {"id": "bigint", "host_id": "bigint", "area": "string", "category": "string", "price": "double", "rating": "double",
            "units": "double", "latitude": "double", "n_reviews": "bigint", "flag": "string"}


@query("p1_profile_columns", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", '{t}' AS dtype, round(COUNT(*) FILTER (WHERE {c} IS NULL) / COUNT(*) * 100e0, 9) AS null_pct,
        COUNT(DISTINCT {c}) AS cardinality, {f"CAST(MIN({c}) AS STRING)" if t != "string" else "NULL"} AS min_value,
        {f"CAST(MAX({c}) AS STRING)" if t != "string" else "NULL"} AS max_value FROM ({LISTING}) l""" for c, t in PROFILED.items()))
def profile_columns(spark, sf):
    return rounded(profile.profile_columns(role(spark, sf, LISTING), list(PROFILED)), 9, "null_pct")


SAMPLED = ["source", "lang", "text"]


@query("p2_sample_values", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", position, CASE WHEN length(t) > 40 THEN substr(t, 1, 37) || '...' ELSE t END AS sample FROM (
        SELECT row_number() OVER (ORDER BY seen, {c}) AS position, replace(replace(replace({c}, '|', '\\|'), chr(10), ' '), chr(13), ' ') AS t
        FROM (SELECT {c}, MIN(doc_id) AS seen FROM {{documents}} WHERE {c} IS NOT NULL GROUP BY {c}) g) q WHERE position <= 3""" for c in SAMPLED))
def sample_values(spark, sf):
    return profile.sample_values(table(spark, sf, "documents"), SAMPLED, "doc_id")


@query("p3_table_shape", """SELECT 'orders' AS "table", COUNT(*) AS rows, CAST(6 AS BIGINT) AS columns FROM {orders}
    UNION ALL SELECT 'part', COUNT(*), 6 FROM {part} UNION ALL SELECT 'nation', COUNT(*), 3 FROM {nation}""")
def table_shape(spark, sf):
    return profile.table_shape({n: table(spark, sf, n) for n in ("orders", "part", "nation")})


@query("p4_key_uniqueness", """
    SELECT 'lines' AS "check", CAST(SUM(n) AS BIGINT) AS total, CAST(SUM(n - 1) AS BIGINT) AS count, round(SUM(n - 1) / SUM(n) * 100e0, 9) AS pct
    FROM (SELECT COUNT(*) AS n FROM (SELECT CASE WHEN l_linenumber = 7 THEN NULL ELSE l_orderkey END AS k, l_linenumber FROM {lineitem}) l GROUP BY k, l_linenumber) q""")
def key_uniqueness(spark, sf):
    lines = role(spark, sf, f"SELECT {LINE_KEYS} FROM {{lineitem}}")
    return rounded(profile.key_uniqueness(lines, ["k", "l_linenumber"], "lines"), 9, "pct")


# Lines with missing and unknown order keys.
CHILD = """SELECT CASE WHEN l_linenumber = 7 THEN NULL WHEN l_linenumber = 6 THEN -l_orderkey - 1 ELSE l_orderkey END AS listing_id FROM {lineitem}"""
ORPHANS = f"""SELECT COUNT(*) AS total, COUNT(*) FILTER (WHERE o_orderkey IS NULL) AS count,
    round(COUNT(*) FILTER (WHERE o_orderkey IS NULL) / COUNT(*) * 100e0, 9) AS pct FROM ({CHILD}) c LEFT JOIN {{orders}} ON listing_id = o_orderkey"""


@query("p5_fk_orphans", f"""SELECT 'orders: o_orderkey unique' AS "check", COUNT(*) AS total, COUNT(*) - COUNT(DISTINCT o_orderkey) AS count, 0 AS pct FROM {{orders}}
    UNION ALL SELECT 'daily: listing_id in orders', * FROM ({ORPHANS}) o
    UNION ALL SELECT 'orders: o_custkey in hosts', COUNT(*), COUNT(*) FILTER (WHERE s_suppkey IS NULL), round(COUNT(*) FILTER (WHERE s_suppkey IS NULL) / COUNT(*) * 100e0, 9)
              FROM {{orders}} LEFT JOIN {{supplier}} ON o_custkey = s_suppkey""")
def fk_orphans(spark, sf):
    tables = {"orders": table(spark, sf, "orders"), "daily": role(spark, sf, CHILD), "hosts": table(spark, sf, "supplier")}
    children = {"daily": "listing_id", "absent": "listing_id", "hosts": "no_such_column"}
    out = profile.referential_integrity(tables, "orders", "o_orderkey", children, {"hosts": ("o_custkey", "s_suppkey")})
    return rounded(out, 9, "pct")


@query("p6_completeness", f"""
    SELECT 'rating' AS field, COUNT(*) AS total, COUNT(*) - COUNT(rating) AS missing, round((COUNT(*) - COUNT(rating)) / COUNT(*) * 100e0, 9) AS missing_pct, 'ok' AS status FROM ({LISTING}) l
    UNION ALL SELECT 'units', COUNT(*), COUNT(*) - COUNT(units), round((COUNT(*) - COUNT(units)) / COUNT(*) * 100e0, 9), 'ok' FROM ({LISTING}) l
    UNION ALL SELECT 'beds', COUNT(*), NULL, NULL, 'column not found' FROM ({LISTING}) l""")
def completeness(spark, sf):
    return rounded(profile.completeness(role(spark, sf, LISTING), ["rating", "units", "beds"]), 9, "missing_pct")


@query("p7_optional_null_report", """
    SELECT 'price' AS field, COUNT(*) AS total, COUNT(*) FILTER (WHERE l_linenumber = 3) AS missing,
           round(COUNT(*) FILTER (WHERE l_linenumber = 3) / COUNT(*) * 100e0, 9) AS missing_pct, 'ok' AS status FROM {lineitem}
    UNION ALL SELECT 'price', COUNT(*), NULL, NULL, 'column not found' FROM {events}""")
def optional_null_report(spark, sf):
    daily = role(spark, sf, "SELECT CASE WHEN l_linenumber = 3 THEN NULL ELSE l_extendedprice END AS price FROM {lineitem}")
    both = profile.optional_null_report(daily, "price").unionByName(profile.optional_null_report(table(spark, sf, "events"), "price"))
    return rounded(both, 9, "missing_pct")


@query("p8_date_range", "SELECT MIN(CAST(l_shipdate AS DATE)) AS first_date, MAX(CAST(l_shipdate AS DATE)) AS last_date, COUNT(DISTINCT CAST(l_shipdate AS DATE)) AS distinct_dates FROM {lineitem}")
def date_range(spark, sf):
    return profile.date_range(table(spark, sf, "lineitem").select(F.date_format("l_shipdate", "yyyy-MM-dd").alias("date")), "date")
