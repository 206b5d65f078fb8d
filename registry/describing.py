"""Descriptive statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.cleaning import master
from registry.common import DAILY, LISTING, MASTER, query, role, rounded, table
from tidemark.operators import describe

EVENTS = "SELECT event_id, user_id, event_type, CASE WHEN event_id % 50 = 0 THEN NULL ELSE value END AS value FROM {events}"


@query("a5_group_size", "SELECT o_custkey, COUNT(*) AS rows, COUNT(*) FILTER (WHERE o_orderstatus = 'F') AS open_rows FROM {orders} GROUP BY o_custkey")
def group_size(spark, sf):
    orders = table(spark, sf, "orders")
    opened = describe.group_size(orders, ["o_custkey"], F.col("o_orderstatus") == "F").withColumnRenamed("rows", "open_rows")
    return describe.group_size(orders, ["o_custkey"]).join(opened, "o_custkey")


@query("a6_median_by_group", "SELECT l_suppkey, round(median(l_extendedprice), 6) AS median FROM {lineitem} GROUP BY l_suppkey")
def median_by_group(spark, sf):
    return rounded(describe.median_by_group(table(spark, sf, "lineitem"), ["l_suppkey"], "l_extendedprice"), 6, "median")


@query("a7_quantile", """SELECT event_type, COUNT(value) AS n, round(quantile_cont(value, 0.05), 6) AS p05, round(quantile_cont(value, 0.9), 6) AS p90,
                         round(quantile_cont(value, 0.999), 6) AS p999 FROM {events} GROUP BY event_type""")
def quantile(spark, sf):
    from tidemark.operators.ranking import group_quantiles

    out = group_quantiles(table(spark, sf, "events"), ["event_type"], "value", {"p05": 0.05, "p90": 0.9, "p999": 0.999})
    return rounded(out, 6, "p05", "p90", "p999")


@query("a8_describe_numeric", f"""
    SELECT COUNT(value) AS count, round((COUNT(*) - COUNT(value)) / COUNT(*) * 100e0, 9) AS missing_pct, round(AVG(value), 7) AS mean,
           round(stddev_samp(value), 7) AS std, round(skewness(value), 7) AS skew, round(median(value), 6) AS median,
           round(quantile_cont(value, 0.9), 6) AS p90 FROM ({EVENTS}) e""")
def describe_numeric(spark, sf):
    out = describe.describe_numeric(role(spark, sf, EVENTS), "value")
    return rounded(rounded(rounded(out, 9, "missing_pct"), 7, "mean", "std", "skew"), 6, "median", "p90")


SEGMENTS = ["Plain", "Flagged", "Nobody"]


@query("a9_means_by_segment", f"""
    SELECT d.segment, CAST(d.position AS INTEGER) AS position, round(AVG(m.price), 5) AS price, round(AVG(m.occupancy), 8) AS occupancy, round(AVG(m.rating), 8) AS rating
    FROM (VALUES ('Plain', 0), ('Flagged', 1), ('Nobody', 2)) d(segment, position)
    LEFT JOIN (SELECT *, CASE flag WHEN 't' THEN 'Flagged' WHEN 'f' THEN 'Plain' END AS segment FROM ({MASTER}) x) m ON m.segment = d.segment GROUP BY 1, 2""")
def means_by_segment(spark, sf):
    from tidemark.functions.parse import map_flag

    rows = master(spark, sf).withColumn("segment", map_flag(F.col("flag"), {"t": "Flagged", "f": "Plain"}))
    out = describe.means_by_segment(rows, "segment", ["price", "occupancy", "rating"], SEGMENTS)
    return rounded(rounded(out, 5, "price"), 8, "occupancy", "rating")


@query("a10_degree_distribution", f"SELECT n AS size, COUNT(*) AS groups FROM (SELECT host_id, COUNT(*) AS n FROM ({LISTING}) l WHERE host_id IS NOT NULL GROUP BY host_id) h GROUP BY n")
def degree_distribution(spark, sf):
    return describe.degree_distribution(role(spark, sf, LISTING), "host_id")


TOP = f"""SELECT COUNT(*) AS n_groups, CAST(SUM(n) AS BIGINT) AS n_rows, round(AVG(n), 8) AS avg_rows, CAST(floor(median(n)) AS BIGINT) AS median_rows, MAX(n) AS max_rows,
    CAST(greatest(1, ceil(COUNT(*) * 0.1e0)) AS BIGINT) AS top_groups, CAST(SUM(n) FILTER (WHERE rn <= greatest(1, ceil(k * 0.1e0))) AS BIGINT) AS top_rows,
    round(SUM(n) FILTER (WHERE rn <= greatest(1, ceil(k * 0.1e0))) / SUM(n) * 100e0, 8) AS top_share_pct
    FROM (SELECT n, row_number() OVER (ORDER BY n DESC) AS rn, COUNT(*) OVER () AS k
          FROM (SELECT user_id, COUNT(*) AS n FROM {{events}} GROUP BY user_id) c) h"""


@query("a11_concentration", TOP)
def concentration(spark, sf):
    return rounded(describe.concentration(table(spark, sf, "events"), "user_id"), 8, "avg_rows", "top_share_pct")


@query("f6_top_fraction", f"SELECT top_groups, top_rows, top_share_pct FROM ({TOP}) t")
def top_fraction(spark, sf):
    return rounded(describe.top_fraction(table(spark, sf, "events"), "user_id"), 8, "top_share_pct")


@query("a12_share_above", f"""SELECT COUNT(rating) AS count, round((COUNT(*) - COUNT(rating)) / COUNT(*) * 100e0, 9) AS missing_pct, round(AVG(rating), 8) AS mean,
    round(AVG(CASE WHEN rating >= 4.8e0 THEN 1e0 WHEN rating < 4.8e0 THEN 0e0 END) * 100, 8) AS share_pct, round(median(rating), 6) AS median FROM ({LISTING}) l""")
def share_above(spark, sf):
    out = describe.share_above(role(spark, sf, LISTING), "rating")
    return rounded(rounded(rounded(out, 9, "missing_pct"), 8, "mean", "share_pct"), 6, "median")


@query("a13_host_counts", f"""
    WITH h AS (SELECT host_id, COUNT(*) AS n, arg_min(flag, id) FILTER (WHERE true) AS dummy FROM ({LISTING}) l GROUP BY host_id),
         f AS (SELECT host_id, flag FROM (SELECT host_id, flag, row_number() OVER (PARTITION BY host_id ORDER BY id) AS rn FROM ({LISTING}) l) q WHERE rn = 1)
    SELECT COUNT(*) FILTER (WHERE host_id IS NOT NULL AND n = 1) AS single, COUNT(*) FILTER (WHERE host_id IS NOT NULL AND n >= 2) AS multi,
           (SELECT COUNT(*) FROM f WHERE flag = 't') AS flagged, (SELECT COUNT(*) FROM f WHERE flag = 'f') AS not_flagged FROM h""")
def host_counts(spark, sf):
    return describe.host_counts(role(spark, sf, LISTING), "host_id", "flag", "id")


@query("a14_extreme_groups", f"""
    WITH m AS (SELECT area, median(price) AS v FROM ({LISTING}) l WHERE area IS NOT NULL AND price IS NOT NULL GROUP BY area)
    SELECT (SELECT COUNT(*) FROM m) AS n_groups, (SELECT area FROM m ORDER BY v DESC, area LIMIT 1) AS highest_group, (SELECT round(MAX(v), 6) FROM m) AS highest_median,
           (SELECT area FROM m ORDER BY v, area LIMIT 1) AS lowest_group, (SELECT round(MIN(v), 6) FROM m) AS lowest_median,
           (SELECT round(median(price), 6) FROM ({LISTING}) l) AS overall_median""")
def extreme_groups(spark, sf):
    out = describe.extreme_groups(role(spark, sf, LISTING), "area", "price")
    return rounded(out, 6, "highest_median", "lowest_median", "overall_median")


COMPLETE = "latitude IS NOT NULL AND longitude IS NOT NULL AND price IS NOT NULL"


@query("a15_coordinate_ranges", f"""SELECT COUNT(*) FILTER (WHERE {COMPLETE}) AS kept, COUNT(*) FILTER (WHERE NOT ({COMPLETE})) AS dropped,
    MIN(latitude) FILTER (WHERE {COMPLETE}) AS min_latitude, MAX(latitude) FILTER (WHERE {COMPLETE}) AS max_latitude,
    MIN(longitude) FILTER (WHERE {COMPLETE}) AS min_longitude, MAX(longitude) FILTER (WHERE {COMPLETE}) AS max_longitude FROM ({LISTING}) l""")
def coordinate_ranges(spark, sf):
    return describe.coordinate_ranges(role(spark, sf, LISTING), "latitude", "longitude", "price")


MONTHS = f"""SELECT CAST(d.range AS INTEGER) AS month, m.v AS mean FROM range(1, 13) d
    LEFT JOIN (SELECT month(date) AS k, AVG(price) AS v FROM ({DAILY}) q WHERE price IS NOT NULL AND date IS NOT NULL GROUP BY 1) m ON d.range = m.k"""


@query("a16_monthly_mean", f"SELECT month, round(mean, 5) AS mean FROM ({MONTHS}) t")
def monthly_mean(spark, sf):
    return rounded(describe.monthly_means(role(spark, sf, DAILY), "date", "price"), 5, "mean")


def _name(order: str) -> str:
    names = "['Jan','Feb','Mar','Apr','May','Jun','Jul','Aug','Sep','Oct','Nov','Dec']"
    return f"(SELECT {names}[month] FROM m WHERE mean IS NOT NULL ORDER BY mean {order}, month LIMIT 1)"


@query("a16_seasonal_trend", f"""WITH m AS ({MONTHS}) SELECT 'ok' AS status, {_name("DESC")} AS peak_month, round(MAX(mean), 5) AS peak_mean,
    {_name("ASC")} AS lowest_month, round(MIN(mean), 5) AS lowest_mean FROM m UNION ALL SELECT 'unavailable', NULL, NULL, NULL, NULL""")
def seasonal_trend(spark, sf):
    daily = role(spark, sf, DAILY)
    both = describe.seasonal_trend(daily, "date", "price").unionByName(describe.seasonal_trend(daily.drop("price"), "date", "price"))
    return rounded(both, 5, "peak_mean", "lowest_mean")


LOG = "CASE WHEN value > 0 THEN log10(value) END"


def _histogram(x: str, bins: int) -> str:
    return f"""
    WITH v AS (SELECT {x} AS x FROM {{events}}), e AS (SELECT MIN(x) AS lo, (MAX(x) - MIN(x)) / {bins}e0 AS step FROM v),
         b AS (SELECT least(CAST(floor((x - lo) / step) AS BIGINT), {bins - 1}) AS g, x, lo, step FROM v, e WHERE x IS NOT NULL),
         c AS (SELECT CASE WHEN x < lo + g * step THEN g - 1 WHEN x >= lo + (g + 1) * step AND g < {bins - 1} THEN g + 1 ELSE g END AS bin, COUNT(*) AS n FROM b GROUP BY 1)
    SELECT r.range AS bin, round(lo + r.range * step, 9) AS low, round(lo + (r.range + 1) * step, 9) AS high, coalesce(n, 0) AS count
    FROM range(0, {bins}) r LEFT JOIN c ON c.bin = r.range, e"""


@query("a17_histogram", _histogram("value", 50))
def histogram(spark, sf):
    return rounded(describe.histogram(table(spark, sf, "events"), "value"), 9, "low", "high")


@query("a17_histogram_log10", _histogram(LOG, 50))
def histogram_log10(spark, sf):
    return rounded(describe.histogram(table(spark, sf, "events"), "value", log10=True), 9, "low", "high")


@query("a18_histogram_fixed", f"""SELECT r.range AS bin, round(1e0 + r.range * 5e-2, 9) AS low, COUNT(rating) AS count FROM range(0, 80) r
    LEFT JOIN (SELECT rating FROM ({LISTING}) l WHERE rating BETWEEN 1 AND 5) q
    ON rating >= 1e0 + r.range * 5e-2 AND (rating < 1e0 + (r.range + 1) * 5e-2 OR r.range = 79) GROUP BY r.range""")
def histogram_fixed(spark, sf):
    return rounded(describe.histogram_fixed(role(spark, sf, LISTING), "rating", 1.0, 5.0, 0.05), 9, "low")


def _box(x: str) -> str:
    return f"""
    WITH v AS (SELECT event_type, x FROM (SELECT event_type, {x} AS x FROM {{events}}) w WHERE x IS NOT NULL),
         q AS (SELECT event_type, COUNT(*) AS n, quantile_cont(x, 0.25) AS q1, median(x) AS median, quantile_cont(x, 0.75) AS q3 FROM v GROUP BY event_type),
         f AS (SELECT *, q1 - 1.5e0 * (q3 - q1) AS lo, q3 + 1.5e0 * (q3 - q1) AS hi FROM q)
    SELECT v.event_type, n, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
           round(least(MIN(x) FILTER (WHERE x >= lo AND x <= hi), q1), 6) AS whisker_low, round(greatest(MAX(x) FILTER (WHERE x >= lo AND x <= hi), q3), 6) AS whisker_high,
           COUNT(*) FILTER (WHERE x < lo OR x > hi) AS outliers
    FROM v JOIN f USING (event_type) GROUP BY v.event_type, n, q1, median, q3"""


@query("a19_box_stats", _box("value"))
def box_stats(spark, sf):
    out = describe.box_stats(table(spark, sf, "events"), "event_type", "value")
    return rounded(out, 6, "q1", "median", "q3", "whisker_low", "whisker_high")


@query("a19_box_stats_log10", _box(LOG))
def box_stats_log10(spark, sf):
    out = describe.box_stats(table(spark, sf, "events"), "event_type", "value", log10=True)
    return rounded(out, 6, "q1", "median", "q3", "whisker_low", "whisker_high")


@query("a19_box_outliers", """
    WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM {events} GROUP BY event_type)
    SELECT event_id, event_type, value FROM {events} JOIN q USING (event_type) WHERE value < q1 - 1.5e0 * (q3 - q1) OR value > q3 + 1.5e0 * (q3 - q1)""")
def box_outliers(spark, sf):
    rows = table(spark, sf, "events").select("event_id", "event_type", "value")
    return describe.box_outliers(rows, "event_type", "value")


@query("a20_value_set", "SELECT DISTINCT p_name FROM {part} WHERE p_name IS NOT NULL")
def value_list(spark, sf):
    return describe.value_list(table(spark, sf, "part"), "p_name")


@query("a21_freq_table", f"SELECT area, COUNT(*) AS rows FROM ({LISTING}) l WHERE area IS NOT NULL GROUP BY area")
def freq_table(spark, sf):
    return describe.freq_table(role(spark, sf, LISTING), "area")


@query("a22_geo_points", f"SELECT longitude, latitude, price, round(CASE WHEN price > 0 THEN log10(price) END, 9) AS log_value FROM ({LISTING}) l WHERE {COMPLETE}")
def geo_points(spark, sf):
    return rounded(describe.geo_points(role(spark, sf, LISTING), "latitude", "longitude", "price"), 9, "log_value")


@query("a22_geo_grid", f"""SELECT round_even(latitude * 1e2, 0) / 1e2 AS latitude, round_even(longitude * 1e2, 0) / 1e2 AS longitude, COUNT(*) AS points,
    round(AVG(CASE WHEN price > 0 THEN log10(price) END), 8) AS mean_log_value FROM ({LISTING}) l WHERE {COMPLETE} GROUP BY 1, 2""")
def geo_grid(spark, sf):
    return rounded(describe.geo_grid(role(spark, sf, LISTING), "latitude", "longitude", "price"), 8, "mean_log_value")


@query("j7_fixed_domain_align", """SELECT d.o_orderstatus, CAST(d.position AS INTEGER) AS position, c.n AS rows FROM (VALUES ('F', 0), ('O', 1), ('X', 2)) d(o_orderstatus, position)
    LEFT JOIN (SELECT o_orderstatus, COUNT(*) AS n FROM {orders} GROUP BY 1) c ON c.o_orderstatus = d.o_orderstatus""")
def fixed_domain_align(spark, sf):
    return describe.align_to_domain(describe.freq_table(table(spark, sf, "orders"), "o_orderstatus"), "o_orderstatus", ["F", "O", "X"])
