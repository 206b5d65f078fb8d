from datetime import date

import pytest
from pyspark.sql import functions as F, types as T

from tidemark.session import shared_dir
from tidemark.sources import readers, writers
from tidemark.streaming.incremental import upsert_stream

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("t", T.StringType()), T.StructField("v", T.DoubleType())])


def test_csv_quotes_newlines_and_na(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,t,v\n1,"a ""q"" b\nline2",NA\n9007199254740993,None,1.5\n3,x,bad\n')
    rows = [tuple(r) for r in readers.csv_scan(spark, str(tmp_path / "a.csv"), SCHEMA).collect()]
    assert rows == [(1, 'a "q" b\nline2', None), (9007199254740993, None, 1.5), (3, "x", None)]


def test_csv_folder(spark, tmp_path):
    (tmp_path / "b.csv").write_text("id,t,v\n1,x,2\n")
    (tmp_path / "a.csv").write_text("k\n7\n")
    (tmp_path / "notes.txt").write_text("no")
    found = readers.csv_dir_scan(spark, str(tmp_path), {"b": SCHEMA})
    assert list(found) == ["a", "b"] and found["b"].first()["v"] == 2.0
    empty = tmp_path / "empty"
    empty.mkdir()
    with pytest.raises(FileNotFoundError):
        readers.csv_dir_scan(spark, str(empty), {})


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"), "x"), (1.0, None)], "v double, t string")
    assert [r["v"] for r in readers.nan_to_null(df).collect()] == [None, 1.0]


def table_of(spark, rows):
    return spark.createDataFrame(rows, "id int, v string, seen int")


def content(spark, path):
    return {r["id"]: r["v"] for r in writers.read_keyed(spark, path, "id").collect()}


def test_upsert_replaces_whole_rows_and_is_idempotent(spark):
    path = shared_dir(spark, "t")
    assert writers.upsert(table_of(spark, [(1, "a", 0), (2, "b", 0)]), path, "id", F.col("seen"))
    batch = table_of(spark, [(2, "old", 1), (2, None, 2), (3, "c", 1)])
    for _ in range(2):
        assert not writers.upsert(batch, path, "id", F.col("seen"))
        assert content(spark, path) == {1: "a", 2: None, 3: "c"}
    assert writers.ensure_key(spark, path, "id", verify=True)
    assert not writers.upsert(batch.limit(0), path, "id", F.col("seen")) and len(content(spark, path)) == 3


def test_table_with_another_key_is_rebuilt(spark):
    path = shared_dir(spark, "t")
    assert not writers.ensure_key(spark, path, "id")
    writers.parquet_sink(table_of(spark, [(1, "a", 0), (1, "a", 0)]), path)
    assert not writers.ensure_key(spark, path, "id")
    assert writers.upsert(table_of(spark, [(5, "z", 0)]), path, "id", F.col("seen"))
    assert content(spark, path) == {5: "z"}
    writers.replace_keyed(table_of(spark, [(1, "a", 0), (1, "b", 0)]), path, "id")
    assert writers.ensure_key(spark, path, "id") and not writers.ensure_key(spark, path, "id", verify=True)


def test_an_empty_first_batch_leaves_a_table(spark):
    path = shared_dir(spark, "t")
    writers.upsert(table_of(spark, []), path, "id", F.col("seen"))
    assert content(spark, path) == {}
    writers.upsert(table_of(spark, [(1, "a", 0)]), path, "id", F.col("seen"))
    assert content(spark, path) == {1: "a"}


def test_audit_rows(spark):
    log, out = shared_dir(spark, "log"), shared_dir(spark, "out")
    with writers.run_audit(spark, log, "ok", "city") as run:
        writers.parquet_sink(run.count_out(run.count_in(spark.range(10)).where("id < 4")), out)
    with pytest.raises(ZeroDivisionError):
        with writers.run_audit(spark, log, "broken", "city", row_count_in=3):
            1 / 0
    rows = {r["stage_name"]: r for r in spark.read.parquet(log).collect()}
    assert (rows["ok"]["row_count_in"], rows["ok"]["row_count_out"], rows["ok"]["status"]) == (10, 4, "success")
    assert (rows["broken"]["row_count_in"], rows["broken"]["row_count_out"], rows["broken"]["status"]) == (3, None, "failed")


def test_micro_batches_upsert(spark):
    source, path = shared_dir(spark, "in"), shared_dir(spark, "t")
    for i, rows in enumerate([[(1, "a", 0)], [(1, "b", 1), (2, "c", 1)]]):
        table_of(spark, rows).write.mode("append").parquet(source)
        stream = spark.readStream.schema("id int, v string, seen int").parquet(source)
        upsert_stream(stream, path, "id", F.col("seen"), shared_dir(spark, "cp") if i == 0 else shared_dir(spark, "cp2")).awaitTermination()
    assert content(spark, path) == {1: "b", 2: "c"}


def test_columns_by_name_and_strict_types(spark, tmp_path):
    (tmp_path / "a.csv").write_text("b,a,c,d\n12.0,x,1.5d,2026\n9007199254740993.0,y,-2e3,2024-02-29\n1e3,z,inf,2024-02-30\n")
    schema = "a string, b long, c double, d date, e long"
    df = readers.csv_scan(spark, str(tmp_path / "a.csv"), spark.createDataFrame([], schema).schema)
    assert [tuple(r) for r in df.collect()] == [
        ("x", 12, None, None, None), ("y", 9007199254740993, -2000.0, date(2024, 2, 29), None), ("z", None, None, None, None),
    ]


def test_inferred_types(spark, tmp_path):
    (tmp_path / "t.csv").write_text("i,f,s,n,m\n1,1,a,NA,\n2,2.5,3,,x\nNA,-1e3,b,None,1\n")
    df = readers.csv_dir_scan(spark, str(tmp_path), {})["t"]
    assert dict(df.dtypes) == {"i": "bigint", "f": "double", "s": "string", "n": "string", "m": "string"}
    assert [r.i for r in df.collect()] == [1, 2, None]


def batch(spark, *pairs):
    return spark.createDataFrame([(k, v, i) for i, (k, v) in enumerate(pairs)], "k long, v long, i long")


def test_null_keys_are_idempotent(spark):
    path = shared_dir(spark, "t")
    for pairs in ([(1, 1), (None, 5)], *[[(None, 6), (1, 2)]] * 3):
        writers.upsert(batch(spark, *pairs), path, "k", F.col("i"))
    assert sorted((r.k or 0, r.v) for r in writers.read_keyed(spark, path, "k").collect()) == [(0, 6), (1, 2)]


def test_only_touched_partitions_are_rewritten(spark):
    path = shared_dir(spark, "t")
    files = lambda: {f.split("/")[-2]: f for f in spark.read.parquet(path).inputFiles()}  # noqa: E731  one file a partition
    writers.upsert(batch(spark, *[(k, k) for k in range(1000)]), path, "k", F.col("i"))
    before = files()
    writers.upsert(batch(spark, (7, -7)), path, "k", F.col("i"))
    after = files()
    assert len(before) == writers.BUCKETS and sum(before[b] != after[b] for b in before) == 1
    found = {r.k: r.v for r in writers.read_keyed(spark, path, "k").collect()}
    assert found == {k: -7 if k == 7 else k for k in range(1000)}

def test_audit_does_not_wait_for_a_frame_that_never_ran(spark, tmp_path):
    with writers.run_audit(spark, str(tmp_path / "log"), "s", "all") as run:
        run.count_out(spark.range(3))
        run.count_in(spark.range(4)).collect()
        run.total = lambda side, wait=0.3: writers.StageRun.total(run, side, wait)
    row = spark.read.parquet(str(tmp_path / "log")).first()
    assert (row.row_count_in, row.row_count_out, row.status) == (4, None, "success")
