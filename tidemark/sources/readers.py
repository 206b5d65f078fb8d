"""Readers: typed CSV, CSV folders, gzip CSV, parquet, SQL text and lookup sets."""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.functions.parse import to_number
from tidemark.session import shared_dir

# Text that a CSV reader takes for a missing value.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


#: Text of whole and decimal numbers, dates and truth values that a typed field takes.
WHOLE = r"^[+-]?[0-9]+(\.0*)?$"


def _hadoop(spark: SparkSession, path: str):
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _files(spark: SparkSession, path: str) -> list[str]:
    """The file, or the data files of a folder, in name order."""
    at, fs = _hadoop(spark, path)
    if not fs.getFileStatus(at).isDirectory():
        return [path]
    names = [(f.getPath().getName(), f.getPath().toString()) for f in fs.listStatus(at) if f.isFile()]
    return [p for name, p in sorted(names) if not name.startswith(("_", "."))]


def header_of(spark: SparkSession, file: str) -> list[str]:
    """Column names in the first line of a CSV file, gzip or plain; read through the file system of the path."""
    at, fs = _hadoop(spark, file)
    jvm = spark.sparkContext._jvm
    stream = fs.open(at)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark.sparkContext._jsc.hadoopConfiguration()).getCodec(at)
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8"))
        line = reader.readLine()
    finally:
        stream.close()
    return next(csv.reader([(line or "").removeprefix("\ufeff")]), [])


def _texts(spark: SparkSession, path: str, multi_line: bool) -> list[DataFrame]:
    """One frame of text columns per header that the files have, so that columns go by name and not by place."""
    by_header: dict[tuple[str, ...], list[str]] = {}
    for file in _files(spark, path):
        by_header.setdefault(tuple(header_of(spark, file)), []).append(file)
    frames = []
    for header, files in by_header.items():
        if len(set(header)) != len(header):
            raise ValueError(f"repeated column names in {files[0]}")
        if header:
            text = T.StructType([T.StructField(c, T.StringType()) for c in header])
            frames.append(spark.read.schema(text).options(header=True, multiLine=multi_line, escape='"', quote='"').csv(files))
    return frames


def csv_scan(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = True) -> DataFrame:
    """Header CSV with doubled quotes, ``.csv.gz`` too; columns are taken by the names in each file's header.

    A column that a file lacks is null there, a column that isn't declared is left out. Every
    field is read as text first, so that an NA token becomes null, and then parsed strictly: a
    whole number may be written ``12.0``, ``1.5d`` is no number, ``2026`` is no date; what doesn't
    parse becomes null. ``multi_line`` takes quoted line ends as text and reads each file in
    one task: pass False for files without them, or use ``landed`` before heavy use.
    """
    out = None
    for raw in _texts(spark, path, multi_line):
        part = raw.select(*[(_typed(f) if f.name in raw.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields])
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], schema) if out is None else out


def _known(name: str):
    c = F.col(f"`{name}`")
    return F.when(~c.isin(NA_TOKENS), c)


def _typed(field: T.StructField):
    known, kind = _known(field.name), field.dataType
    if isinstance(kind, T.StringType):
        return known
    if isinstance(kind, T.IntegralType):
        return F.when(F.trim(known).rlike(WHOLE), F.regexp_extract(F.trim(known), r"^([+-]?[0-9]+)", 1)).try_cast(kind)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return to_number(known).cast(kind)
    if isinstance(kind, T.DateType):
        return F.when(F.trim(known).rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), F.trim(known)).try_cast(kind)
    return F.trim(known).try_cast(kind)


def inferred(spark: SparkSession, path: str, multi_line: bool = True) -> T.StructType:
    """Types of undeclared columns from all their values: long, double, or text; one pass over each header's files.

    A column is a number if every value that is no NA token is one, whole numbers being long; a
    column without values is text.
    """
    kinds: dict[str, list[tuple[int, int, int]]] = {}
    for raw in _texts(spark, path, multi_line):
        counts = []
        for i, c in enumerate(raw.columns):
            known = _known(c)
            whole = F.trim(known).rlike(r"^[+-]?[0-9]{1,18}$")
            counts += [F.count(known).alias(f"n{i}"), F.count_if(whole).alias(f"w{i}"), F.count(to_number(known)).alias(f"d{i}")]
        row = raw.agg(*counts).first()
        for i, c in enumerate(raw.columns):
            kinds.setdefault(c, []).append((row[f"n{i}"], row[f"w{i}"], row[f"d{i}"]))
    fields = []
    for c, found in kinds.items():
        n, whole, number = (sum(x) for x in zip(*found))
        kind = T.StringType() if n == 0 or number < n else T.LongType() if whole == n else T.DoubleType()
        fields.append(T.StructField(c, kind))
    return T.StructType(fields)


def landed(df: DataFrame, label: str = "landed") -> DataFrame:
    """The rows written as parquet to the shared folder, so that heavy use reads splittable, typed files."""
    path = shared_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def csv_dir_scan(spark: SparkSession, folder: str, schemas: dict[str, T.StructType], multi_line: bool = True) -> dict[str, DataFrame]:
    """One DataFrame per ``<stem>.csv`` (or ``.csv.gz``) of a folder, in name order.

    Files without a declared schema get inferred types.
    """
    root, fs = _hadoop(spark, folder)
    found = {}
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        for ending in (".csv", ".csv.gz"):
            if name.endswith(ending):
                found[name[: -len(ending)]] = status.getPath().toString()
    if not found:
        raise FileNotFoundError(f"no CSV files in {folder}")
    return {
        stem: csv_scan(spark, found[stem], schemas.get(stem) or inferred(spark, found[stem], multi_line), multi_line) for stem in sorted(found)
    }


def parquet_scan(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet with NaN, which means missing, as null."""
    reader = spark.read.schema(schema) if schema else spark.read
    return nan_to_null(reader.parquet(path))


def sql_scan(spark: SparkSession, text: str, **tables: DataFrame) -> DataFrame:
    """SQL text over DataFrames that the text names in braces, e.g. ``FROM {fact}``."""
    return spark.sql(text, **tables)


def value_set(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-null values of one column, as a lookup."""
    return df.select(column).where(F.col(column).isNotNull()).distinct()


def nan_to_null(df: DataFrame) -> DataFrame:
    """Double NaN means missing in the data model; apply once at the source boundary."""
    fixed = {
        f.name: F.when(~F.isnan(F.col(f"`{f.name}`")), F.col(f"`{f.name}`"))
        for f in df.schema.fields
        if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    }
    return df.withColumns(fixed) if fixed else df
