"""Cleaning, derived columns, sorts and star-schema joins."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from registry.common import AS_OF, DAILY, HOST, LISTING, MASTER, MESSY, query, role, rounded, table
from tidemark.functions import parse
from tidemark.functions.moments import skew_g1
from tidemark.operators import clean, derive, star
from tidemark.operators.dedupe import dedupe_first
from tidemark.plans.prepare import Columns, clean_entities

TODAY = date.fromisoformat(AS_OF)
NUMBER = "^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def as_number(text: str) -> str:
    return f"CASE WHEN regexp_full_match(trim({text}), '{NUMBER}') THEN TRY_CAST(trim({text}) AS DOUBLE) END"


CURRENCY = as_number("replace(replace(price, '$', ''), ',', '')")
DATE = "CASE WHEN regexp_full_match(first_review, '[0-9][0-9][0-9][0-9]-[0-9][0-9]-[0-9][0-9]') THEN TRY_CAST(first_review AS DATE) END"
PERCENT = as_number("rtrim(rate, '%')")


@query("c1_parse_currency", f"SELECT id, {CURRENCY} AS price FROM ({MESSY}) m")
def parse_currency(spark, sf):
    return clean.parse_currency(role(spark, sf, MESSY).select("id", "price"), ["price", "absent"])


@query("c2_parse_dates", f"SELECT id, {DATE} AS first_review FROM ({MESSY}) m")
def parse_dates(spark, sf):
    return clean.parse_dates(role(spark, sf, MESSY).select("id", "first_review"), ["first_review"])


@query("c3_parse_percent", f"SELECT id, {PERCENT} AS rate FROM ({MESSY}) m")
def parse_percent(spark, sf):
    return clean.parse_percent(role(spark, sf, MESSY).select("id", "rate"), ["rate"])


@query("c4_normalise_text", f"SELECT id, lower(trim(category)) AS category FROM ({MESSY}) m")
def normalise_text(spark, sf):
    return clean.normalise_text(role(spark, sf, MESSY).select("id", "category"), ["category"])


@query("c5_pool_rare", """
    SELECT p_partkey, CASE WHEN n < 30 THEN 'Other' ELSE p_name END AS p_name
    FROM (SELECT p_partkey, CASE WHEN p_partkey % 25 = 0 THEN NULL ELSE p_name END AS p_name FROM {part}) p
    LEFT JOIN (SELECT p_name AS k, COUNT(*) AS n FROM {part} WHERE p_partkey % 25 <> 0 GROUP BY p_name) c ON p.p_name = c.k""")
def pool_rare(spark, sf):
    parts = role(spark, sf, "SELECT p_partkey, CASE WHEN p_partkey % 25 = 0 THEN NULL ELSE p_name END AS p_name FROM {part}")
    return clean.pool_rare(parts, "p_name", 30)


@query("c6_impute_group_median", f"""
    WITH l AS ({LISTING}), m AS (SELECT area, median(price) AS p, median(rating) AS r, median(units) AS u FROM l WHERE area IS NOT NULL GROUP BY area)
    SELECT l.id, l.area, round(coalesce(l.price, m.p), 6) AS price, round(coalesce(l.rating, m.r), 6) AS rating,
           coalesce(l.units, m.u) AS units FROM l LEFT JOIN m ON l.area = m.area""")
def impute_group_median(spark, sf):
    rows = role(spark, sf, LISTING).select("id", "area", "price", "rating", "units")
    return rounded(clean.impute_group_median(rows, "area", ["price", "rating", "units"]), 6, "price", "rating")


@query("c8_conform_lookup", f"""
    WITH bad AS (SELECT trim(area) AS area FROM ({MESSY}) m WHERE trim(area) IS NULL OR trim(area) NOT IN (SELECT n_name FROM {{nation}}))
    SELECT COUNT(*) AS unmatched_rows,
           (SELECT string_agg(area, '|' ORDER BY area) FROM (SELECT DISTINCT area FROM bad WHERE area IS NOT NULL ORDER BY area LIMIT 10) s) AS sample
    FROM bad""")
def conform_lookup(spark, sf):
    return clean.conform_lookup(role(spark, sf, MESSY), "area", table(spark, sf, "nation"), "n_name")


def rules():
    return clean.range_rules({"latitude": (-90, 90), "longitude": (-180, 180)}, {"price": 0})


KEEP = "(price IS NULL OR price >= 0) AND coalesce(latitude BETWEEN -90 AND 90, false) AND coalesce(longitude BETWEEN -180 AND 180, false)"
PRICED = f"SELECT id, {CURRENCY} AS price, latitude, longitude FROM ({MESSY}) m"


@query("c9_validate_drop", f"SELECT * FROM ({PRICED}) p WHERE {KEEP}")
def validate_keep(spark, sf):
    rows = clean.parse_currency(role(spark, sf, MESSY).select("id", "price", "latitude", "longitude"), ["price"])
    return clean.validate_keep(rows, rules())


@query("c9_validate_report", f"""
    SELECT COUNT(*) AS rows, COUNT(*) FILTER (WHERE NOT ({KEEP})) AS dropped,
           COUNT(*) FILTER (WHERE price < 0) AS failed_price,
           COUNT(*) FILTER (WHERE NOT coalesce(latitude BETWEEN -90 AND 90, false)) AS failed_latitude,
           COUNT(*) FILTER (WHERE NOT coalesce(longitude BETWEEN -180 AND 180, false)) AS failed_longitude
    FROM ({PRICED}) p""")
def validate_report(spark, sf):
    rows = clean.parse_currency(role(spark, sf, MESSY).select("id", "price", "latitude", "longitude"), ["price"])
    return clean.validate_report(rows, rules())


MESSY_COLUMNS = Columns(
    price="price", dates=("first_review",), texts=("category",), pooled="kind", percents=("rate",), group="category",
    imputed=("units",), area="area", latitude="latitude", longitude="longitude",
)


@query("c10_clean_all", f"""
    WITH t AS (SELECT id, {CURRENCY} AS price, {DATE} AS first_review, {PERCENT} AS rate, lower(trim(category)) AS category,
                      lower(trim(kind)) AS kind, trim(area) AS area, units, latitude, longitude FROM ({MESSY}) m),
         k AS (SELECT kind AS kk, COUNT(*) AS n FROM t WHERE kind IS NOT NULL GROUP BY kind),
         u AS (SELECT category AS c, median(units) AS m FROM t WHERE category IS NOT NULL GROUP BY category)
    SELECT id, price, first_review, rate, category, CASE WHEN n < 10 THEN 'Other' ELSE kind END AS kind, area,
           coalesce(units, m) AS units, latitude, longitude
    FROM t LEFT JOIN k ON kind = kk LEFT JOIN u ON category = c WHERE {KEEP}""")
def clean_all(spark, sf):
    return clean_entities(role(spark, sf, MESSY), MESSY_COLUMNS)


@query("d1_occupancy_rate", f"SELECT id, round(occupancy, 9) AS occupancy FROM ({MASTER}) m")
def occupancy_rate(spark, sf):
    rows = role(spark, sf, LISTING).select("id")
    out = derive.occupancy_rate(rows, "id", role(spark, sf, DAILY), "listing_id", "available", days=13, name="occupancy")
    return rounded(out, 9, "occupancy")


def master(spark, sf):
    rows = derive.occupancy_rate(
        role(spark, sf, LISTING), "id", role(spark, sf, DAILY), "listing_id", "available", days=13, name="occupancy"
    )
    return rows.withColumn("revenue", derive.revenue_proxy(F.col("occupancy"), F.col("price"), 13))


@query("d2_revenue_proxy", f"SELECT id, round(revenue, 4) AS revenue FROM ({MASTER}) m")
def revenue_proxy(spark, sf):
    return rounded(master(spark, sf).select("id", "revenue"), 4, "revenue")


@query("d3_review_frequency", f"""
    SELECT id, coalesce(n_reviews / CASE WHEN months > 0 THEN months END, 0) AS review_frequency
    FROM (SELECT id, n_reviews, date_diff('day', first_review, DATE '{AS_OF}') / 30.44e0 AS months FROM ({LISTING}) l) q""")
def review_frequency(spark, sf):
    f = derive.review_frequency(F.col("n_reviews"), F.col("first_review"), TODAY)
    return role(spark, sf, LISTING).select("id", f.alias("review_frequency"))


@query("d4_tenure_years", f"SELECT id, round(date_diff('day', first_review, DATE '{AS_OF}') / 365e0, 9) AS tenure FROM ({LISTING}) l")
def tenure_years(spark, sf):
    return rounded(role(spark, sf, LISTING).select("id", derive.tenure_years(F.col("first_review"), TODAY).alias("tenure")), 9, "tenure")


@query("d5_price_per_unit", f"SELECT id, round(price / CASE WHEN units < 1 THEN 1 ELSE units END, 6) AS price_per_unit FROM ({LISTING}) l")
def price_per_unit(spark, sf):
    return rounded(
        role(spark, sf, LISTING).select("id", derive.price_per_unit(F.col("price"), F.col("units")).alias("price_per_unit")), 6, "price_per_unit"
    )


CONTEXT = f"""
    WITH l AS ({LISTING}), s AS (SELECT area AS a, median(price) AS group_median_price, COUNT(id) AS group_density,
                                        AVG(rating) AS group_avg_rating FROM l WHERE area IS NOT NULL GROUP BY area)
    SELECT id, area, round(group_median_price, 6) AS group_median_price, group_density, round(group_avg_rating, 8) AS group_avg_rating
    FROM l LEFT JOIN s ON area = a"""


@query("d6_group_context", CONTEXT)
def group_context(spark, sf):
    rows = role(spark, sf, LISTING)
    out = derive.group_context(rows, "area", "id", "price", "rating")
    out = out.select("id", "area", "group_median_price", "group_density", "group_avg_rating")
    return rounded(rounded(out, 6, "group_median_price"), 8, "group_avg_rating")


EVENTS = "SELECT event_id, user_id, event_type, CASE WHEN event_id % 50 = 0 THEN NULL WHEN event_id % 33 = 0 THEN -value ELSE value END AS value FROM {events}"


@query("d7_log_target", f"""
    WITH e AS ({EVENTS}), s AS (SELECT skewness(value) AS g FROM e)
    SELECT event_id, round(CASE WHEN abs(g) > 1 THEN CASE WHEN value > 0 THEN log10(value) END ELSE value END, 9) AS target,
           CASE WHEN abs(g) > 1 THEN 'log_value' ELSE 'value' END AS target_kind FROM e, s""")
def log_target(spark, sf):
    out = derive.log_target(role(spark, sf, EVENTS), "value")
    return rounded(out.select("event_id", "target", "target_kind"), 9, "target")


@query("d8_skew_g1", "SELECT event_type, round(skewness(value), 7) AS skew FROM {events} GROUP BY event_type UNION ALL SELECT 'constant', 0 FROM (SELECT DISTINCT 1 FROM {events}) q")
def skew(spark, sf):
    e = table(spark, sf, "events")
    constant = e.agg(skew_g1(F.lit(1.0) + F.col("value") * 0)).select(F.lit("constant").alias("event_type"), F.col("*"))
    out = e.groupBy("event_type").agg(skew_g1(F.col("value")).alias("skew")).union(constant)
    return rounded(out, 7, "skew")


@query("d9_map_flag", f"SELECT id, CASE flag WHEN 't' THEN 'Flagged' WHEN 'f' THEN 'Plain' END AS segment FROM ({LISTING}) l")
def map_flag(spark, sf):
    return role(spark, sf, LISTING).select("id", parse.map_flag(F.col("flag"), {"t": "Flagged", "f": "Plain"}).alias("segment"))


HOSTED = "SELECT id, CASE WHEN host_id % 3 = 0 THEN -id ELSE host_id END AS host_id FROM ({listing}) l"


@query("d10_binary_segment", f"""
    WITH h AS ({HOSTED.format(listing=LISTING)}), s AS (SELECT host_id AS k, COUNT(id) AS n FROM h WHERE host_id IS NOT NULL GROUP BY host_id)
    SELECT id, host_id, CASE WHEN n >= 2 THEN 'Multi (2+)' ELSE 'Single' END AS segment FROM h LEFT JOIN s ON host_id = k""")
def binary_segment(spark, sf):
    return derive.binary_segment(role(spark, sf, HOSTED.format(listing=LISTING)), "id", "host_id", "Multi (2+)", "Single")


@query("d11_case_bucket", f"""
    SELECT id, CASE WHEN t IS NULL THEN 'Unknown' WHEN t < 1 THEN '<1yr' WHEN t < 3 THEN '1-3yr' WHEN t < 5 THEN '3-5yr' ELSE '5yr+' END AS bucket
    FROM (SELECT id, date_diff('day', first_review, DATE '{AS_OF}') / 365e0 AS t FROM ({LISTING}) l) q""")
def case_bucket(spark, sf):
    tenure = derive.tenure_years(F.col("first_review"), TODAY)
    bucket = parse.case_bucket(tenure, TENURE, "5yr+", "Unknown")
    return role(spark, sf, LISTING).select("id", bucket.alias("bucket"))


TENURE = [(1, "<1yr"), (3, "1-3yr"), (5, "3-5yr")]


@query("d12_month_of", "SELECT l_orderkey, l_linenumber, CAST(month(l_shipdate) AS BIGINT) AS month FROM {lineitem}")
def month_of(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", parse.month_of(F.col("l_shipdate")).alias("month"))


@query("d13_pct", """SELECT o_custkey, round(CASE WHEN COUNT(*) - 10 = 0 THEN 0 ELSE COUNT(*) FILTER (WHERE o_orderstatus = 'F') / (COUNT(*) - 10) * 100e0 END, 9) AS pct
                     FROM {orders} GROUP BY o_custkey""")
def pct(spark, sf):
    counted = table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.count_if(F.col("o_orderstatus") == "F").alias("c"), (F.count(F.lit(1)) - 10).alias("t")
    )
    return rounded(counted.select("o_custkey", parse.pct(F.col("c"), F.col("t")).alias("pct")), 9, "pct")


@query("d14_round_coords", """SELECT o_orderkey, round_even((55e0 + o_orderkey / 2e5) * 1e4, 0) / 1e4 AS lat FROM {orders}""")
def round_coords(spark, sf):
    exact = F.lit(55.0) + F.col("o_orderkey") / F.lit(200000.0)
    return table(spark, sf, "orders").select("o_orderkey", parse.round_coord(exact).alias("lat"))


@query("d16_clip_text", r"""
    SELECT doc_id, CASE WHEN length(t) > 40 THEN substr(t, 1, 37) || '...' ELSE t END AS sample
    FROM (SELECT doc_id, replace(replace(replace(source || '|' || text, '|', '\|'), chr(10), ' '), chr(13), ' ') AS t FROM {documents}) q""")
def clip_text(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", parse.clip_text(F.concat("source", F.lit("|"), "text")).alias("sample"))


@query("d17_pow10", "SELECT l_orderkey, l_linenumber, l_partkey, round(pow(10e0, l_tax + l_discount), 9) AS y FROM {lineitem}")
def pow10(spark, sf):
    out = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", parse.pow10(F.col("l_tax") + F.col("l_discount")).alias("y"))
    return rounded(out, 9, "y")


@query("f2_drop_nulls", f"SELECT id, area, price, rating FROM ({LISTING}) l WHERE area IS NOT NULL AND price IS NOT NULL AND rating IS NOT NULL")
def drop_nulls(spark, sf):
    return derive.drop_nulls(role(spark, sf, LISTING).select("id", "area", "price", "rating"), ["area", "price", "rating"])


@query("f2_drop_nulls_report", f"""SELECT COUNT(*) FILTER (WHERE area IS NOT NULL AND price IS NOT NULL AND rating IS NOT NULL) AS kept,
       COUNT(*) FILTER (WHERE area IS NULL OR price IS NULL OR rating IS NULL) AS dropped FROM ({LISTING}) l""")
def drop_nulls_report(spark, sf):
    return derive.drop_nulls_report(role(spark, sf, LISTING), ["area", "price", "rating"])


@query("f5_top_k", f"SELECT id, price FROM ({LISTING}) l ORDER BY price DESC NULLS LAST, id LIMIT 10")
def top_k(spark, sf):
    return derive.top_k(role(spark, sf, LISTING).select("id", "price"), [F.desc_nulls_last("price"), F.col("id")], 10)


@query("f7_sort_multi", f"SELECT area, id FROM ({LISTING}) l ORDER BY area, id")
def sort_multi(spark, sf):
    return role(spark, sf, LISTING).select("area", "id").orderBy("area", "id")


FACT = {"id": "listing_id", "host_id": "host_id", "category": "category", "price": "price", "occupancy": "occupancy_rate",
        "revenue": "estimated_annual_revenue", "rating": "avg_review_score"}
DIM_SQL = f"""SELECT host_id, flag, tenure FROM (
    SELECT host_id, flag, date_diff('day', first_review, DATE '{AS_OF}') / 365e0 AS tenure,
           row_number() OVER (PARTITION BY host_id ORDER BY id) AS rn FROM ({LISTING}) l) q WHERE rn = 1"""


def fact_and_dim(spark, sf):
    m = master(spark, sf).withColumn("tenure", derive.tenure_years(F.col("first_review"), TODAY))
    return star.build_fact(m, FACT), star.build_dim(m, {"host_id": "host_id", "flag": "flag", "tenure": "tenure"}, "host_id", "id")


@query("u1_dedupe_first", f"""SELECT host_id, id, area, price FROM (
    SELECT host_id, id, area, price, row_number() OVER (PARTITION BY host_id ORDER BY id) AS rn FROM ({LISTING}) l) q WHERE rn = 1""")
def first_per_host(spark, sf):
    return dedupe_first(role(spark, sf, LISTING).select("host_id", "id", "area", "price"), ["host_id"], F.col("id"))


@query("j1_join_inner_dim", f"""SELECT l.id AS listing_id, l.host_id, h.host_since FROM ({LISTING}) l JOIN ({HOST}) h ON l.host_id = h.host_id""")
def join_inner_dim(spark, sf):
    fact = role(spark, sf, LISTING).select(F.col("id").alias("listing_id"), "host_id")
    return fact.join(role(spark, sf, HOST), "host_id")


@query("j2_join_left_context", CONTEXT)
def join_left_context(spark, sf):
    return group_context(spark, sf)


@query("j3_lookup_align", f"""SELECT l.id, coalesce(total, 0) AS total_days, coalesce(avail, 0) AS available_days FROM ({LISTING}) l LEFT JOIN
    (SELECT listing_id, COUNT(*) AS total, COUNT(*) FILTER (WHERE available = 't') AS avail FROM ({DAILY}) d GROUP BY listing_id) c ON l.id = c.listing_id""")
def lookup_align(spark, sf):
    counts = derive.daily_counts(role(spark, sf, DAILY), "listing_id", "available")
    return derive.lookup_align(role(spark, sf, LISTING).select("id"), "id", counts, "listing_id", ["total_days", "available_days"])


@query("j4_semi_membership", f"""
    SELECT 'in' AS side, area FROM (SELECT trim(area) AS area FROM ({MESSY}) m) q WHERE area IN (SELECT n_name FROM {{nation}})
    UNION ALL SELECT 'out', area FROM (SELECT trim(area) AS area FROM ({MESSY}) m) q
    WHERE area IS NULL OR area NOT IN (SELECT n_name FROM {{nation}})""")
def semi_membership(spark, sf):
    rows = clean.trim_column(role(spark, sf, MESSY).select("area"), "area")
    marked = clean.with_membership(rows, "area", table(spark, sf, "nation").select("n_name"))
    return marked.select(F.when(F.col("known"), "in").otherwise("out").alias("side"), "area")


@query("a1_agg_by_flag", f"""
    SELECT CASE WHEN h.flag = 't' THEN 'Superhost' ELSE 'Non-superhost' END AS host_type, COUNT(*) AS listing_count,
           round(AVG(f.occupancy), 8) AS avg_occupancy_rate, round(AVG(f.revenue), 4) AS avg_estimated_annual_revenue
    FROM ({MASTER}) f JOIN ({DIM_SQL}) h ON f.host_id = h.host_id WHERE h.flag IS NOT NULL GROUP BY 1""")
def agg_by_flag(spark, sf):
    fact, dim = fact_and_dim(spark, sf)
    averages = {"occupancy_rate": "avg_occupancy_rate", "estimated_annual_revenue": "avg_estimated_annual_revenue"}
    out = star.agg_by_flag(fact, dim, "host_id", "flag", ("Superhost", "Non-superhost"), averages)
    return rounded(rounded(out, 8, "avg_occupancy_rate"), 4, "avg_estimated_annual_revenue")


BUCKETS = f"""
    SELECT CASE WHEN h.tenure IS NULL THEN 'Unknown' WHEN h.tenure < 1 THEN '<1yr' WHEN h.tenure < 3 THEN '1-3yr'
                WHEN h.tenure < 5 THEN '3-5yr' ELSE '5yr+' END AS tenure_bucket,
           COUNT(*) AS listing_count, round(AVG(f.rating), 8) AS avg_review_score
    FROM ({MASTER}) f JOIN ({DIM_SQL}) h ON f.host_id = h.host_id GROUP BY 1"""


@query("a2_agg_by_bucket", BUCKETS)
def agg_by_bucket(spark, sf):
    fact, dim = fact_and_dim(spark, sf)
    out = star.agg_by_bucket(fact, dim, "host_id", "tenure", TENURE, "5yr+", {"avg_review_score": "avg_review_score"})
    return rounded(out, 8, "avg_review_score")


@query("f4_sort_custom", f"SELECT tenure_bucket, listing_count FROM ({BUCKETS}) b")
def sort_custom(spark, sf):
    # the rows come in bucket order, not in label order
    return agg_by_bucket(spark, sf).select("tenure_bucket", "listing_count")


@query("a3_agg_by_category", f"SELECT category, COUNT(*) AS listing_count, round(AVG(revenue), 4) AS avg_revenue FROM ({MASTER}) m GROUP BY category")
def agg_by_category(spark, sf):
    fact, _ = fact_and_dim(spark, sf)
    return rounded(star.agg_by_category(fact, "category", "estimated_annual_revenue", "avg_revenue"), 4, "avg_revenue")


@query("a4_top_groups", f"""SELECT area, round(median(price), 6) AS median_price, COUNT(id) AS density, round(AVG(rating), 8) AS avg_rating
    FROM ({LISTING}) l WHERE area IS NOT NULL GROUP BY area ORDER BY median(price) DESC, area LIMIT 10""")
def top_groups(spark, sf):
    names = ("median_price", "density", "avg_rating")
    rows = derive.group_context(role(spark, sf, LISTING), "area", "id", "price", "rating", names).where("area IS NOT NULL")
    dim = star.build_dim(rows, {"area": "area", **{n: n for n in names}}, "area", "id")
    return rounded(rounded(star.top_groups(dim, "area", "median_price", ["density", "avg_rating"]), 6, "median_price"), 8, "avg_rating")
