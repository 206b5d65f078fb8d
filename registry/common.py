"""Role views over the given tables, shared by the queries and their SQL.

The given tables have no nulls, so the roles write edge cases into whole tables: missing and
negative prices, missing keys, out-of-range coordinates, orphan keys. Role text is plain SQL
that Spark and DuckDB read alike; table names stand in braces.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under a name, with the SQL that must give the same rows."""

    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = plain(sql)
        return fn

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def plain(text: str) -> str:
    """Role text for the SQL side: braces dropped."""
    return re.sub(r"\{(\w+)\}", r"\1", text)


def role(spark: SparkSession, sf: str, text: str) -> DataFrame:
    """Role text as a DataFrame."""
    names = set(re.findall(r"\{(\w+)\}", text))
    return spark.sql(text, **{n: table(spark, sf, n) for n in names})


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Doubles rounded, because sums differ in their last bits with the order of rows."""
    return df.withColumns({c: F.round(c, digits) for c in columns})


AS_OF = "2002-01-01"

LISTING = """
SELECT o.o_orderkey AS id,
       CASE WHEN o.o_orderkey % 97 = 0 THEN NULL ELSE o.o_custkey END AS host_id,
       CASE WHEN o.o_orderkey % 89 = 0 THEN NULL ELSE n.n_name END AS area,
       o.o_orderpriority AS category,
       CASE WHEN o.o_orderkey % 10 = 0 THEN NULL WHEN o.o_orderkey % 201 = 0 THEN -o.o_totalprice
            ELSE o.o_totalprice END AS price,
       CASE WHEN o.o_orderkey % 7 = 0 THEN NULL ELSE 1e0 + CAST(o.o_orderkey * 37 % 401 AS DOUBLE) / 1e2 END AS rating,
       CASE WHEN o.o_orderkey % 11 = 0 THEN NULL ELSE CAST(o.o_orderkey % 5 AS DOUBLE) END AS units,
       CASE WHEN o.o_orderkey % 53 = 0 THEN NULL WHEN o.o_orderkey % 59 = 0 THEN 95e0
            ELSE 55e0 + CAST(o.o_custkey % 1000 AS DOUBLE) / 1e4 END AS latitude,
       -3e0 - CAST(o.o_custkey % 777 AS DOUBLE) / 1e4 AS longitude,
       CASE WHEN o.o_orderkey % 13 = 0 THEN NULL ELSE CAST(o.o_orderdate AS DATE) END AS first_review,
       CAST(o.o_orderkey % 120 AS BIGINT) AS n_reviews,
       CASE WHEN o.o_custkey % 31 = 0 THEN NULL WHEN c.c_acctbal > 5e3 THEN 't' ELSE 'f' END AS flag
FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey JOIN {nation} n ON c.c_nationkey = n.n_nationkey
"""

DAILY = """
SELECT l_orderkey AS listing_id, CAST(l_shipdate AS DATE) AS date,
       CASE WHEN l_returnflag = 'A' THEN 't' ELSE 'f' END AS available,
       CASE WHEN l_linenumber = 3 THEN NULL ELSE l_extendedprice END AS price
FROM {lineitem}
"""

HOST = """
SELECT o_custkey AS host_id, MIN(CAST(o_orderdate AS DATE)) AS host_since FROM {orders} GROUP BY o_custkey
"""

# The enriched table: occupancy over 13 days, because an order has at most 13 lines.
MASTER = f"""
SELECT l.*, d.total_days, d.available_days,
       CASE WHEN d.total_days IS NULL THEN NULL ELSE (13 - d.available_days) / 13e0 END AS occupancy,
       CASE WHEN d.total_days IS NULL THEN NULL ELSE (13 - d.available_days) / 13e0 * 13 * l.price END AS revenue
FROM ({LISTING}) l
LEFT JOIN (SELECT listing_id, COUNT(*) AS total_days, SUM(CASE WHEN available = 't' THEN 1 ELSE 0 END) AS available_days
           FROM ({DAILY}) q GROUP BY listing_id) d ON l.id = d.listing_id
"""

# A currency text with a thousands comma, some of it unusable.
MESSY = """
SELECT o_orderkey AS id,
       CASE WHEN o_orderkey % 10 = 0 THEN NULL WHEN o_orderkey % 17 = 0 THEN 'n/a' WHEN o_orderkey % 19 = 0 THEN '1.5d'
            WHEN o_orderkey % 23 = 0 THEN '$-' || CAST(o_totalprice AS STRING)
            ELSE '$' || substr(CAST(o_totalprice AS STRING), 1, 1) || ',' || substr(CAST(o_totalprice AS STRING), 2) END AS price,
       CASE WHEN o_orderkey % 9 = 0 THEN NULL WHEN o_orderkey % 14 = 0 THEN '2000-13-01' WHEN o_orderkey % 15 = 0 THEN 'soon'
            WHEN o_orderkey % 16 = 0 THEN '2000' ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS first_review,
       CASE WHEN o_orderkey % 8 = 0 THEN NULL WHEN o_orderkey % 21 = 0 THEN 'n/a' WHEN o_orderkey % 22 = 0 THEN '90%%'
            ELSE CAST(o_orderkey % 101 AS STRING) || '%' END AS rate,
       CASE WHEN o_orderkey % 12 = 0 THEN NULL WHEN o_orderkey % 3 = 0 THEN '  ' || upper(o_orderpriority) || ' '
            WHEN o_orderkey % 3 = 1 THEN lower(o_orderpriority) || '   ' ELSE o_orderpriority END AS category,
       p_name AS kind, n_name AS area, units, latitude, longitude
FROM (SELECT o.*, p.p_name, CASE WHEN o.o_orderkey % 29 = 0 THEN ' Nowhere' WHEN o.o_orderkey % 31 = 0 THEN 'ATLANTIS '
                                 WHEN o.o_orderkey % 37 = 0 THEN NULL ELSE '  ' || n.n_name || ' ' END AS n_name,
             CASE WHEN o.o_orderkey % 4 = 0 THEN NULL ELSE CAST(o.o_orderkey % 6 AS DOUBLE) END AS units,
             CASE WHEN o.o_orderkey % 53 = 0 THEN NULL WHEN o.o_orderkey % 59 = 0 THEN 95e0
                  ELSE 55e0 + CAST(o.o_custkey % 1000 AS DOUBLE) / 1e4 END AS latitude,
             CASE WHEN o.o_orderkey % 61 = 0 THEN -190e0 ELSE -3e0 - CAST(o.o_custkey % 777 AS DOUBLE) / 1e4 END AS longitude
      FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey JOIN {nation} n ON c.c_nationkey = n.n_nationkey
      LEFT JOIN {part} p ON p.p_partkey = o.o_orderkey % (SELECT COUNT(*) FROM {part}))
"""

# Built label of the regression and the model: the extended price is unrelated to its line.
SALES = """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_discount, l_tax, p_size, p_retailprice, p_type,
       l_linestatus, CASE WHEN l_linenumber = 7 AND l_tax = 0e0 THEN NULL ELSE l_quantity * p_retailprice * (1 - l_discount) END AS label
FROM {lineitem} JOIN {part} ON l_partkey = p_partkey
"""
