"""Whole-table preparation: clean the raw entities, enrich them, and land star-schema tables."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.operators import clean, derive, star
from tidemark.sources.readers import parquet_scan
from tidemark.session import written
from tidemark.sources.writers import csv_sink, parquet_sink, read_keyed, run_audit, upsert


@dataclass(frozen=True)
class Columns:
    """Which columns of the entity table play which part; the defaults are fixed names of the input."""

    price: str = "price"
    dates: tuple[str, ...] = ("host_since", "first_review", "last_review")
    texts: tuple[str, ...] = ("room_type",)
    pooled: str = "property_type"
    percents: tuple[str, ...] = ("host_response_rate",)
    group: str = "room_type"
    imputed: tuple[str, ...] = ("bedrooms", "beds", "bathrooms")
    area: str = "neighbourhood_cleansed"
    latitude: str = "latitude"
    longitude: str = "longitude"
    min_count: int = 10


def validation_rules(c: Columns) -> dict[str, Column]:
    return clean.range_rules({c.latitude: (-90, 90), c.longitude: (-180, 180)}, {c.price: 0})


def parse_entities(raw: DataFrame, c: Columns) -> DataFrame:
    """Everything up to validation: rare categories and medians see rows that validation drops."""
    df = clean.parse_currency(raw, [c.price])
    df = clean.parse_dates(df, list(c.dates))
    df = clean.parse_percent(clean.normalise_text(df, [*c.texts, c.pooled]), list(c.percents))
    parsed = clean.trim_column(df, c.area)
    pooled = clean.pool_rare(parsed, c.pooled, c.min_count)
    # medians come from the parsed rows, unless pooling changed the very group they are taken in
    return clean.impute_group_median(pooled, c.group, list(c.imputed), pooled if c.pooled == c.group else parsed)


def clean_entities(raw: DataFrame, c: Columns = Columns()) -> DataFrame:
    return clean.validate_keep(parse_entities(raw, c), validation_rules(c))


def clean_daily(daily: DataFrame, date_column: str = "date", price: str = "price") -> DataFrame:
    return clean.parse_dates(clean.parse_currency(daily, [price]), [date_column])


def clean_reviews(reviews: DataFrame, date_column: str = "date") -> DataFrame:
    return clean.parse_dates(reviews, [date_column])


def clean_run(
    spark: SparkSession, folder: str, raw: DataFrame, daily: DataFrame, reviews: DataFrame, lookup: DataFrame, c: Columns = Columns(),
    scope: str = "all",
) -> dict[str, DataFrame]:
    """The whole cleaning stage: three cleaned tables written, its reports, and a row in the audit log.

    ``lookup`` holds the known areas in its first column. The parsed entities are written once for the
    table and both reports. The audit counts the rows of all three tables. Returns the tables as
    stored, the validation report (rows, dropped, failures per rule), the unknown areas and the log.
    """
    known = lookup.select(F.col(lookup.columns[0]).alias(c.area))
    with run_audit(spark, f"{folder}/audit", "clean", scope) as run:
        parsed = written(run.count_in(parse_entities(raw, c)), "parsed")
        parquet_sink(run.count_out(clean.validate_keep(parsed, validation_rules(c))), f"{folder}/entities")
        parquet_sink(run.count_out(clean_daily(run.count_in(daily))), f"{folder}/daily")
        parquet_sink(run.count_out(clean_reviews(run.count_in(reviews))), f"{folder}/reviews")
    tables = {name: parquet_scan(spark, f"{folder}/{name}") for name in ("entities", "daily", "reviews")}
    unknown = parsed.select(c.area).where(F.col(c.area).isNotNull()).join(known, c.area, "left_anti").groupBy(c.area).agg(F.count(F.lit(1)).alias("n"))
    return {**tables, "validation": clean.validate_report(parsed, validation_rules(c)), "unknown_areas": unknown, "audit": spark.read.parquet(f"{folder}/audit")}


@dataclass(frozen=True)
class EnrichColumns:
    """Columns of the cleaned tables that the derived columns are made from; fixed names of the input."""

    key: str = "id"
    price: str = "price"
    reviews: str = "number_of_reviews"
    first_review: str = "first_review"
    host_since: str = "host_since"
    units: str = "bedrooms"
    area: str = "neighbourhood_cleansed"
    rating: str = "review_scores_rating"
    daily_key: str = "listing_id"
    available: str = "available"


def enrich(entities: DataFrame, daily: DataFrame, as_of: date, c: EnrichColumns = EnrichColumns()) -> DataFrame:
    """Entities with occupancy, revenue, review frequency, tenure, price per unit and area context."""
    df = derive.occupancy_rate(entities, c.key, daily, c.daily_key, c.available, name="occupancy_rate_365")
    df = df.withColumns(
        {
            "estimated_annual_revenue": derive.revenue_proxy(F.col("occupancy_rate_365"), F.col(c.price)),
            "review_frequency": derive.review_frequency(F.col(c.reviews), F.col(c.first_review), as_of),
            "host_tenure_years": derive.tenure_years(F.col(c.host_since), as_of),
            "price_per_bedroom": derive.price_per_unit(F.col(c.price), F.col(c.units)),
        }
    )
    names = ("neighbourhood_median_price", "neighbourhood_listing_density", "neighbourhood_avg_rating")
    return derive.group_context(df, c.area, c.key, c.price, c.rating, names)


def enrich_run(
    spark: SparkSession, folder: str, entities: DataFrame, daily: DataFrame, as_of: date, c: EnrichColumns = EnrichColumns(), scope: str = "all"
) -> DataFrame:
    """The whole transform stage: the enriched table as parquet and CSV, and a row in the audit log. Returns the table as stored."""
    with run_audit(spark, f"{folder}/audit", "transform", scope) as run:
        counted = written(run.count_in(entities), "entities")
        parquet_sink(run.count_out(enrich(counted, daily, as_of, c)), f"{folder}/master")
        csv_sink(spark.read.parquet(f"{folder}/master"), f"{folder}/master_csv")
    return parquet_scan(spark, f"{folder}/master")


# Fixed names of the input and of the star schema, and fixed labels of its reports.
FACT_COLUMNS = {
    "id": "listing_id", "host_id": "host_id", "neighbourhood_cleansed": "neighbourhood", "room_type": "room_type",
    "property_type": "property_type", "price": "price", "occupancy_rate_365": "occupancy_rate_365",
    "estimated_annual_revenue": "estimated_annual_revenue", "number_of_reviews": "review_count",
    "review_scores_rating": "avg_review_score", "reviews_per_month": "reviews_per_month",
    "price_per_bedroom": "price_per_bedroom",
}
HOST_COLUMNS = {
    "host_id": "host_id", "host_since": "host_since", "host_tenure_years": "host_tenure_years",
    "host_is_superhost": "host_is_superhost", "host_total_listings_count": "host_total_listings_count",
}
AREA_COLUMNS = {
    "neighbourhood_cleansed": "neighbourhood", "neighbourhood_group_cleansed": "neighbourhood_group",
    "neighbourhood_median_price": "median_price", "neighbourhood_listing_density": "listing_density",
    "neighbourhood_avg_rating": "avg_rating",
}


FLAG_LABELS = ("Superhost", "Non-superhost")
TENURE_BUCKETS = [(1, "<1yr"), (3, "1-3yr"), (5, "3-5yr")]
LONGEST_TENURE = "5yr+"


def load_star(
    spark: SparkSession, master: DataFrame, folder: str, row_key: str = "id", fact_columns: dict[str, str] = FACT_COLUMNS,
    host_columns: dict[str, str] = HOST_COLUMNS, area_columns: dict[str, str] = AREA_COLUMNS, host: str = "host_id",
    area: str = "neighbourhood_cleansed", scope: str = "all",
) -> dict[str, DataFrame]:
    """Upsert the fact by its key, replace both dimensions, and return the stored tables; a row in the audit log.

    The mappings name columns of the master and what they are called in the star schema. The
    master is computed once, whatever it is made of. Frames of an earlier load have to be read again.
    """
    key = fact_columns[row_key]
    paths = {n: f"{folder}/{n}" for n in ("fact_listing_performance", "dim_host", "dim_neighbourhood")}
    with run_audit(spark, f"{folder}/audit", "load", scope) as run:
        master = written(run.count_in(master), "master")
        upsert(run.count_out(star.build_fact(master, fact_columns)), paths["fact_listing_performance"], key, F.col(key))
        parquet_sink(star.build_dim(master, host_columns, host, row_key), paths["dim_host"])
        parquet_sink(star.build_dim(master, area_columns, area, row_key), paths["dim_neighbourhood"])
    fact = read_keyed(spark, paths["fact_listing_performance"], key)
    return {"fact_listing_performance": fact, **{n: spark.read.parquet(paths[n]) for n in ("dim_host", "dim_neighbourhood")}}


def star_reports(
    tables: dict[str, DataFrame], flag_labels: tuple[str, str] = FLAG_LABELS, buckets: list[tuple[float, str]] = TENURE_BUCKETS,
    longest: str = LONGEST_TENURE,
) -> dict[str, DataFrame]:
    """The four analytical queries over the star schema."""
    fact, hosts, areas = (tables[n] for n in ("fact_listing_performance", "dim_host", "dim_neighbourhood"))
    averages = {"occupancy_rate_365": "avg_occupancy_rate", "estimated_annual_revenue": "avg_estimated_annual_revenue"}
    return {
        "top_areas": star.top_groups(areas, "neighbourhood", "median_price", ["listing_density", "avg_rating"]),
        "by_host_type": star.agg_by_flag(fact, hosts, "host_id", "host_is_superhost", flag_labels, averages),
        "by_tenure": star.agg_by_bucket(
            fact, hosts, "host_id", "host_tenure_years", buckets, longest, {"avg_review_score": "avg_review_score"}
        ),
        "by_room_type": star.agg_by_category(fact, "room_type", "estimated_annual_revenue", "avg_estimated_annual_revenue"),
    }
