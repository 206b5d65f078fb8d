from datetime import date

from pyspark.sql import functions as F

import __spark_entry__
from tidemark.plans import prepare
from tidemark.session import shared_dir

RAW = [
    (1, 10, "$100.00", "2015-01-01", "2018-01-01", None, " Entire home ", "Flat", "90%", 2.0, 1.0, 1.0, " Old Town ", 55.95, -3.19, 12, 4.9, 1.2, "t"),
    (2, 10, "$1,300.00", "2015-01-01", "bad", None, "entire HOME", "Flat", None, None, 2.0, 1.0, "Old Town", 55.95, -3.19, 3, None, None, "t"),
    (3, 11, None, None, None, None, "Private room", "Barn", "n/a", 1.0, None, None, "Leith", 55.97, -3.17, 0, 4.1, 0.5, "f"),
    (4, 12, "$-5.00", None, None, None, "Private room", "Flat", None, 1.0, 1.0, 1.0, "Leith", 55.97, -3.17, 1, 4.0, 0.1, None),
    (5, 12, "$50.00", None, None, None, None, "Flat", None, None, 1.0, 1.0, None, None, -3.17, 1, 4.0, 0.1, None),
]
SCHEMA = """id long, host_id long, price string, host_since string, first_review string, last_review string, room_type string,
  property_type string, host_response_rate string, bedrooms double, beds double, bathrooms double, neighbourhood_cleansed string,
  latitude double, longitude double, number_of_reviews int, review_scores_rating double, reviews_per_month double, host_is_superhost string"""


def test_raw_to_reports(spark):
    raw = spark.createDataFrame(RAW, SCHEMA)
    cleaned = prepare.clean_entities(raw, prepare.Columns(min_count=2))
    rows = {r["id"]: r for r in cleaned.collect()}
    assert set(rows) == {1, 2, 3}
    assert rows[2]["price"] == 1300.0 and rows[2]["bedrooms"] == 2.0 and rows[2]["first_review"] is None
    assert rows[3]["property_type"] == "Other" and rows[1]["room_type"] == "entire home" and rows[1]["neighbourhood_cleansed"] == "Old Town"
    daily = spark.createDataFrame([(1, "t")] * 73 + [(2, "f")] * 3, "listing_id long, available string")
    master = prepare.enrich(cleaned, daily, date(2020, 1, 1)).withColumns(
        {"host_total_listings_count": F.lit(None).cast("double"), "neighbourhood_group_cleansed": F.lit(None).cast("string")}
    )
    got = {r["id"]: r for r in master.collect()}
    assert got[1]["occupancy_rate_365"] == 0.8 and got[2]["occupancy_rate_365"] == 1.0 and got[3]["occupancy_rate_365"] is None
    assert got[1]["neighbourhood_median_price"] == 700.0 and got[3]["neighbourhood_median_price"] is None
    folder = shared_dir(spark, "star")
    written = prepare.enrich_run(spark, folder, cleaned, daily, date(2020, 1, 1))
    assert {r["id"]: r["occupancy_rate_365"] for r in written.collect()} == {k: r["occupancy_rate_365"] for k, r in got.items()}
    assert prepare.load_star(spark, master, folder)["fact_listing_performance"].count() == 3
    second = prepare.load_star(spark, master, folder)
    assert second["fact_listing_performance"].count() == 3
    log = sorted((r.stage_name, r.row_count_in, r.row_count_out, r.status) for r in spark.read.parquet(f"{folder}/audit").collect())
    assert log == [("load", 3, 3, "success")] * 2 + [("transform", 3, 3, "success")]
    reports = {k: [tuple(r) for r in v.collect()] for k, v in prepare.star_reports(second).items()}
    assert reports["top_areas"][0][:2] == ("Old Town", 700.0)
    assert {r[0]: r[1] for r in reports["by_host_type"]} == {"Superhost": 2, "Non-superhost": 1}
    assert [r[0] for r in reports["by_tenure"]] == ["5yr+", "Unknown"]
    assert reports["by_room_type"][0][0] == "entire home"


def test_entry_and_registry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    queries, sqls = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert set(sqls) <= set(queries) and len(queries) > 90


def test_buckets_come_in_bucket_order(spark, sf):
    got = [r["tenure_bucket"] for r in __spark_entry__.queries()["f4_sort_custom"](spark, sf).collect()]
    order = ["<1yr", "1-3yr", "3-5yr", "5yr+", "Unknown"]
    assert got == [b for b in order if b in got] and len(got) > 1


def test_star_queries_load_a_written_master(spark, sf, monkeypatch):
    """Both loads read one stored master, and an upsert picks the newest rows of its batch once."""
    from registry import pipelines
    from tidemark.sources import writers

    plans, picks, load, pick = [], [], pipelines.prepare.load_star, writers.pick_per_key
    monkeypatch.setattr(pipelines.prepare, "load_star", lambda spark, master, *a, **b: (plans.append(master._jdf.queryExecution().optimizedPlan().toString()), load(spark, master, *a, **b))[1])
    monkeypatch.setattr(writers, "pick_per_key", lambda *a, **b: (picks.append(1), pick(*a, **b))[1])
    assert pipelines.star_load(spark, sf).count() > 0
    assert len(plans) == 2 and not any("Join" in p or "Aggregate" in p for p in plans)
    assert len(picks) == 2
