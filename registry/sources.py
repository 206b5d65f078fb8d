"""Sources and sinks: written and read back in the shared folder, from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from registry.common import LISTING, query, role, table
from tidemark.operators import star
from tidemark.session import shared_dir
from tidemark.sources import readers, writers

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()), T.StructField("lang", T.StringType()),
        T.StructField("n_chars", T.LongType()), T.StructField("text", T.StringType()),
    ]
)
DOCS_SQL = """
SELECT doc_id, CASE WHEN doc_id % 9 = 0 THEN 'NA' ELSE lang END AS lang, n_chars,
       text || chr(10) || 'he said "' || source || '", twice' AS text FROM {documents}
"""
DOCS_READ = f"SELECT doc_id, CASE WHEN lang = 'NA' THEN NULL ELSE lang END AS lang, n_chars, text FROM ({DOCS_SQL}) q"

NATION = T.StructType(
    [T.StructField("n_nationkey", T.LongType()), T.StructField("n_name", T.StringType()), T.StructField("n_regionkey", T.LongType())]
)
REGION = T.StructType([T.StructField("r_regionkey", T.LongType()), T.StructField("r_name", T.StringType())])


@query("s1_csv_scan", DOCS_READ)
def csv_scan(spark, sf):
    path = shared_dir(spark, "csv")
    writers.csv_sink(role(spark, sf, DOCS_SQL), path)
    return readers.landed(readers.csv_scan(spark, path, DOCS, multi_line=True))


@query("s2_csv_dir_scan", """
    SELECT 'nation' AS stem, n_nationkey AS key, n_name AS name FROM {nation}
    UNION ALL SELECT 'region', r_regionkey, r_name FROM {region}
    UNION ALL SELECT 'supplier', s_suppkey, s_name FROM {supplier}""")
def csv_dir_scan(spark, sf):
    folder = shared_dir(spark, "csvdir")
    for name in ("supplier", "nation", "region"):
        writers.csv_sink(table(spark, sf, name), f"{folder}/{name}.csv")
    found = readers.csv_dir_scan(spark, folder, {"nation": NATION, "region": REGION})
    keys = {"nation": "n_nationkey", "region": "r_regionkey", "supplier": "s_suppkey"}
    out = None
    for stem, df in found.items():
        key = keys[stem]
        part = df.select(F.lit(stem).alias("stem"), F.col(key).cast("long").alias("key"), F.col(f"{key[0]}_name").alias("name"))
        out = part if out is None else out.unionByName(part)
    return out


@query("s3_gz_csv_scan", DOCS_READ)
def gz_csv_scan(spark, sf):
    path = shared_dir(spark, "gz")
    writers.csv_sink(role(spark, sf, DOCS_SQL), path, compression="gzip")
    return readers.landed(readers.csv_scan(spark, path, DOCS, multi_line=True))


# Typed text as users write it: 12.0 in a whole-number column, 1.5d, a bare year, NA tokens.
TYPED_SQL = """
SELECT o_orderkey AS id,
       CASE WHEN o_orderkey % 5 = 0 THEN 'None' WHEN o_orderkey % 5 = 1 THEN '1.5d' WHEN o_orderkey % 5 = 2 THEN CAST(o_custkey AS STRING) || '.0'
            WHEN o_orderkey % 5 = 3 THEN '9007199254740993' ELSE CAST(o_custkey AS STRING) END AS host,
       CASE WHEN o_orderkey % 4 = 0 THEN 'n/a' WHEN o_orderkey % 4 = 1 THEN '1.5d' WHEN o_orderkey % 4 = 2 THEN '-2.5e3' ELSE '7' END AS price,
       CASE WHEN o_orderkey % 3 = 0 THEN '2026' WHEN o_orderkey % 3 = 1 THEN '2001-02-03' ELSE '2001-13-01' END AS day, o_orderkey % 7 AS extra FROM {orders}
"""
TYPED = T.StructType([
    T.StructField("host", T.LongType()), T.StructField("id", T.LongType()), T.StructField("absent", T.StringType()),
    T.StructField("day", T.DateType()), T.StructField("price", T.DoubleType()),
])


@query("s1_csv_by_name", f"""
    SELECT CASE WHEN host IN ('None', '1.5d') THEN NULL WHEN host LIKE '%.0' THEN CAST(replace(host, '.0', '') AS BIGINT) ELSE CAST(host AS BIGINT) END AS host,
           id, CAST(NULL AS VARCHAR) AS absent, CASE WHEN day = '2001-02-03' THEN DATE '2001-02-03' END AS day,
           CASE WHEN price IN ('n/a', '1.5d') THEN NULL ELSE CAST(price AS DOUBLE) END AS price FROM ({TYPED_SQL}) q""")
def csv_by_name(spark, sf):
    """Two files with permuted columns and one more, declared in another order again, one column absent."""
    folder = shared_dir(spark, "named")
    rows = role(spark, sf, TYPED_SQL)
    rows.where("id % 2 = 0").select("day", "id", "extra", "price", "host").coalesce(1).write.option("header", True).csv(folder)
    rows.where("id % 2 = 1").select("id", "host", "price", "day").coalesce(1).write.mode("append").option("header", True).csv(folder)
    return readers.csv_scan(spark, folder, TYPED)


@query("s2_inferred_types", """
    SELECT 'nation' AS stem, 'n_name' AS name, 'string' AS kind UNION ALL SELECT 'nation', 'n_nationkey', 'bigint' UNION ALL SELECT 'nation', 'n_regionkey', 'bigint'
    UNION ALL SELECT 'customer', 'c_custkey', 'bigint' UNION ALL SELECT 'customer', 'c_acctbal', 'double'""")
def inferred_types(spark, sf):
    folder = shared_dir(spark, "undeclared")
    writers.csv_sink(table(spark, sf, "nation").select("n_nationkey", "n_name", "n_regionkey"), f"{folder}/nation.csv")
    writers.csv_sink(table(spark, sf, "customer").select("c_custkey", "c_acctbal"), f"{folder}/customer.csv")
    found = readers.csv_dir_scan(spark, folder, {}, multi_line=False)
    return spark.createDataFrame([(s, n, k) for s, df in found.items() for n, k in df.dtypes], "stem string, name string, kind string")


@query("s4_parquet_scan", "SELECT o_orderkey, o_custkey, o_totalprice FROM {orders}")
def parquet_scan(spark, sf):
    return readers.parquet_scan(spark, f"{sf}/orders.parquet").select("o_orderkey", "o_custkey", "o_totalprice")


REGIONS = """SELECT r.r_name, COUNT(*) AS customers FROM {customer} c JOIN {nation} n ON c.c_nationkey = n.n_nationkey
             JOIN {region} r ON n.n_regionkey = r.r_regionkey GROUP BY r.r_name"""


@query("s5_sql_scan", REGIONS)
def sql_scan(spark, sf):
    return readers.sql_scan(spark, REGIONS, **{n: table(spark, sf, n) for n in ("customer", "nation", "region")})


@query("s6_lookup_scan", "SELECT DISTINCT p_type FROM {part} WHERE p_type IS NOT NULL")
def lookup_scan(spark, sf):
    return readers.value_set(table(spark, sf, "part"), "p_type")


@query("k1_parquet_sink", "SELECT * FROM {customer}")
def parquet_sink(spark, sf):
    path = shared_dir(spark, "parquet")
    writers.parquet_sink(table(spark, sf, "customer"), path)
    return readers.parquet_scan(spark, path)


@query("k2_csv_sink", "SELECT doc_id, text FROM {documents}")
def csv_sink(spark, sf):
    path = shared_dir(spark, "sink")
    writers.csv_sink(table(spark, sf, "documents").select("doc_id", "text"), path)
    raw = spark.read.schema("doc_id long, text string").options(header=True, multiLine=True, escape='"').csv(path)
    return raw


EXISTING = "SELECT o_orderkey AS id, o_custkey AS host_id, o_totalprice AS price FROM {orders}"
# Repeated keys, keys that exist and keys that do not, and nulls that must overwrite.
BATCH = """SELECT CAST(floor(o_orderkey * 3e0 / 4e0) AS BIGINT) + 5000 AS id, o_custkey AS host_id,
                  CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE -o_totalprice END AS price, o_orderkey AS seen FROM {orders}"""
NEWEST = f"""SELECT id, host_id, price FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY seen DESC) AS rn FROM ({BATCH}) b) q WHERE rn = 1"""


@query("k3_upsert_fact", f"""
    SELECT * FROM ({EXISTING}) e WHERE NOT EXISTS (SELECT 1 FROM ({BATCH}) b WHERE b.id = e.id)
    UNION ALL {NEWEST}""")
def upsert_fact(spark, sf):
    path = shared_dir(spark, "fact")
    writers.upsert(role(spark, sf, EXISTING), path, "id", F.col("host_id"))
    batch = role(spark, sf, BATCH)
    for _ in range(2):  # the second run must change nothing
        writers.upsert(batch.select("id", "host_id", "price", "seen"), path, "id", F.col("seen"))
    return writers.read_keyed(spark, path, "id")


@query("k4_replace_dim", "SELECT c_custkey AS host_id, c_acctbal AS balance FROM {customer}")
def replace_dim(spark, sf):
    path = shared_dir(spark, "dim")
    writers.parquet_sink(role(spark, sf, "SELECT s_suppkey AS host_id, s_acctbal AS balance FROM {supplier}"), path)
    writers.parquet_sink(role(spark, sf, "SELECT c_custkey AS host_id, c_acctbal AS balance FROM {customer}"), path)
    return spark.read.parquet(path)


@query("k5_ensure_key", f"SELECT id, host_id, price, true AS rebuilt, true AS keyed FROM ({NEWEST}) n")
def ensure_key(spark, sf):
    """A table without a key is rebuilt from the batch, and has one row per key then."""
    path = shared_dir(spark, "keyless")
    writers.parquet_sink(role(spark, sf, EXISTING), path)
    rebuilt = writers.upsert(role(spark, sf, BATCH), path, "id", F.col("seen"))
    keyed = writers.ensure_key(spark, path, "id", verify=True)
    return writers.read_keyed(spark, path, "id").select("id", "host_id", "price", F.lit(rebuilt).alias("rebuilt"), F.lit(keyed).alias("keyed"))


@query("k6_run_audit", """
    SELECT 'clean' AS stage_name, 'all' AS scope, (SELECT COUNT(*) FROM {lineitem}) AS row_count_in,
           (SELECT COUNT(*) FROM {lineitem} WHERE l_quantity > 10) AS row_count_out, 'success' AS status
    UNION ALL SELECT 'load', 'all', (SELECT COUNT(*) FROM {orders}), NULL, 'failed'""")
def run_audit(spark, sf):
    log, out = shared_dir(spark, "audit"), shared_dir(spark, "stage")
    orders = table(spark, sf, "orders")
    with writers.run_audit(spark, log, "clean", "all") as run:
        kept = run.count_out(run.count_in(table(spark, sf, "lineitem")).where("l_quantity > 10"))
        writers.parquet_sink(kept, out)
    try:
        with writers.run_audit(spark, log, "load", "all", row_count_in=orders.count()):
            writers.parquet_sink(orders.select(F.raise_error(F.lit("bad row")).alias("x")), f"{out}-bad")
    except Exception:  # noqa: BLE001 - the audit row of the failed stage is what is looked at
        pass
    return spark.read.parquet(log).select("stage_name", "scope", "row_count_in", "row_count_out", "status")


FACT = {"id": "listing_id", "host_id": "host_id", "area": "area", "category": "category", "price": "price"}


@query("d15_rename_project", f"SELECT id AS listing_id, host_id, area, category, price FROM ({LISTING}) l")
def rename_project(spark, sf):
    return star.build_fact(role(spark, sf, LISTING), FACT)
