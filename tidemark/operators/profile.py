"""Profiling: per-column profile, samples, keys and foreign keys, completeness, date ranges."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.functions.parse import clip_text, pct, rows_of


#: Base-two logarithm of a sketch's buckets; its estimates are off by some 1.6 % in 19 of 20 cases.
SKETCH_BITS = 14


def _identity(df: DataFrame, column: str) -> Column:
    """What two values of a column are told apart by: numbers and times themselves, other values by 128 bits of hashes.

    All columns share one type, so that they can stand below each other; no value is turned into text.
    """
    c, kind = F.col(f"`{column}`"), df.schema[column].dataType
    whole = fraction = one = other = None
    if isinstance(kind, (T.IntegralType, T.BooleanType)):
        whole = c.cast("long")
    elif isinstance(kind, (T.DoubleType, T.FloatType)):
        fraction = c.cast("double") + 0.0  # -0.0 is 0.0
    elif isinstance(kind, T.DateType):
        whole = F.unix_date(c).cast("long")
    elif isinstance(kind, T.TimestampType):
        whole = F.unix_micros(c)
    else:
        text = c if isinstance(kind, (T.StringType, T.BinaryType)) else c.cast("string")
        one, other = F.xxhash64(text), F.xxhash64(F.lit("other"), text)
    part = lambda v, t, name: (F.lit(None).cast(t) if v is None else v).alias(name)
    return F.when(c.isNotNull(), F.struct(part(whole, "long", "whole"), part(fraction, "double", "fraction"), part(one, "long", "one"), part(other, "long", "other")))


def _values(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows (column, value): what each cell is told apart by, null for an empty one."""
    return df.select(*(_identity(df, c).alias(c) for c in columns)).unpivot([], columns, "column", "value")


def _bounds(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per column: its type, and min and max of a numeric one as text."""
    types, numeric = dict(df.dtypes), [c for c in columns if isinstance(df.schema[c].dataType, T.NumericType)]
    ends = [f(c).alias(f"{side}_{c}") for c in numeric for side, f in (("lo", F.min), ("hi", F.max))]
    text = lambda c, side: (F.col(f"{side}_{c}").cast("string") if c in numeric else F.lit(None).cast("string"))
    cells = [F.struct(F.lit(c).alias("column"), F.lit(types[c]).alias("dtype"), text(c, "lo").alias("min_value"), text(c, "hi").alias("max_value")) for c in columns]
    return (df.agg(*ends) if ends else df.sparkSession.range(1)).select(rows_of(*cells))


def profile_columns(df: DataFrame, columns: list[str] | None = None, exact: bool = True) -> DataFrame:
    """Per column: type, rows, null share, distinct values, and min and max of numeric columns.

    Distinct values are counted on (column, value) pairs that are combined before the shuffle,
    which replaces one wide aggregate with an expansion per column; they are dealt by column and
    value, so that a column with many of them is spread over all tasks. ``exact=False`` estimates
    them from sketches instead, without any shuffle of values. Bounds are text, so that long ids
    keep every digit.
    """
    columns = columns or df.columns
    if not exact:
        return merged_profile(column_sketches(df, columns))
    counts = _values(df, columns).groupBy("column", "value").agg(F.count(F.lit(1)).alias("_n"))
    nulls = F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("_n"))), F.lit(0))
    base = counts.groupBy("column").agg(F.sum("_n").alias("rows"), nulls.alias("nulls"), F.count("value").alias("cardinality"))
    # the bounds have one row per column of the schema
    joined = base.join(F.broadcast(_bounds(df, columns)), "column")
    return joined.select("column", "dtype", pct(F.col("nulls"), F.col("rows")).alias("null_pct"), "cardinality", "min_value", "max_value")


def column_sketches(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Per column what a later profile is merged from: type, rows, nulls, bounds as text, and a sketch of the distinct values.

    The rows of this table are all that has to be kept of an extract; merged_profile() adds those of
    any number of extracts.
    """
    columns = columns or df.columns
    hashed = F.when(F.col("value").isNotNull(), F.xxhash64("value"))
    base = _values(df, columns).groupBy("column").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("value").isNull()).alias("nulls"), F.hll_sketch_agg(hashed, SKETCH_BITS).alias("sketch")
    )
    return base.join(F.broadcast(_bounds(df, columns)), "column")


def merged_profile(sketches: DataFrame) -> DataFrame:
    """The profile of all extracts whose sketches are given; distinct values are estimates."""
    edge = lambda c, first: F.element_at(F.sort_array(F.collect_set(F.struct(F.col(c).cast("decimal(38,10)").alias("n"), F.col(c).alias("t"))), asc=first), 1)["t"]
    some = lambda c: F.col(c).isNotNull()
    ends = sketches.groupBy("column").agg(
        F.any_value("dtype").alias("dtype"), F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("cardinality"),
    )
    low, high = (sketches.where(some(c)).groupBy("column").agg(edge(c, first).alias(c)) for c, first in (("min_value", True), ("max_value", False)))
    return ends.join(low, "column", "left").join(high, "column", "left").select(
        "column", "dtype", pct(F.col("nulls"), F.col("rows")).alias("null_pct"), "cardinality", "min_value", "max_value"
    )


def sample_values(df: DataFrame, columns: list[str], row_key: str, k: int = 3) -> DataFrame:
    """First ``k`` distinct non-null values per column in row order, clipped to one line.

    One narrow pass per position picks the first value that is none of the earlier ones, for all
    columns at once, so no column's values are ever shuffled.
    """
    rows = df.select(F.col(row_key).alias("_at"), *[F.col(c).cast("string").alias(f"v{i}") for i, c in enumerate(columns)])
    picks: list[Column] = []
    for _ in range(k):
        seen = rows.withColumns({f"_p{j}": p for j, p in enumerate(picks)}) if picks else rows

        def first(i: int) -> Column:
            v = F.col(f"v{i}")
            fresh = v.isNotNull()
            for j in range(len(picks)):
                fresh = fresh & F.coalesce(v != F.col(f"_p{j}.v{i}"), F.lit(True))
            return F.min(F.when(fresh, F.struct("_at", v.alias("v"))))["v"].alias(f"v{i}")

        one = seen.agg(*[first(i) for i in range(len(columns))])
        picks.append(one.select(F.struct(*one.columns)).scalar())
    found = df.sparkSession.range(1).withColumns({f"_p{j}": p for j, p in enumerate(picks)})
    cells = [
        F.struct(
            F.lit(c).alias("column"), F.lit(j + 1).cast("long").alias("position"), clip_text(F.col(f"_p{j}.v{i}")).alias("sample")
        )
        for i, c in enumerate(columns) for j in range(k)
    ]
    return found.select(rows_of(*cells)).where(F.col("sample").isNotNull())


def table_shape(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows and columns per named table."""
    parts = [
        df.agg(F.lit(name).alias("table"), F.count(F.lit(1)).alias("rows"), F.lit(len(df.columns)).cast("long").alias("columns"))
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def _check_row(df: DataFrame, check: str) -> DataFrame:
    return df.select(F.lit(check).alias("check"), "total", "count", pct(F.col("count"), F.col("total")).alias("pct"))


def key_uniqueness(df: DataFrame, keys: list[str], check: str) -> DataFrame:
    """One row: rows beyond the first of their key; null is a key like any other."""
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    out = groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("count"),
    )
    return _check_row(out, check)


def fk_orphans(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str, check: str) -> DataFrame:
    """One row: child rows whose key the parent does not have.

    A null key is an orphan unless the parent has a null key too. The child is counted per key
    first, so a hot key meets the join as one row.
    """
    counts = child.groupBy(F.col(child_key).alias("_c")).agg(F.count(F.lit(1)).alias("_n"))
    parents = parent.select(F.col(parent_key).alias("_p")).distinct().withColumn("_found", F.lit(True))
    out = counts.join(parents, F.col("_c").eqNullSafe(F.col("_p")), "left").agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total"),
        F.coalesce(F.sum(F.when(F.col("_found").isNull(), F.col("_n"))), F.lit(0)).alias("count"),
    )
    return _check_row(out, check)


def referential_integrity(
    tables: dict[str, DataFrame], entity: str, key: str, children: dict[str, str], lookups: dict[str, tuple[str, str]],
) -> DataFrame | None:
    """All key and foreign-key checks whose tables and columns exist; None if there are none.

    ``children`` maps a table to its key into the entity, ``lookups`` a table to
    (entity column, lookup column).
    """
    checks = []
    main = tables.get(entity)
    if main is None or key not in main.columns:
        return None
    checks.append(key_uniqueness(main, [key], f"{entity}: {key} unique"))
    for name, column in children.items():
        if name in tables and column in tables[name].columns:
            checks.append(fk_orphans(tables[name], column, main, key, f"{name}: {column} in {entity}"))
    for name, (column, lookup) in lookups.items():
        if name in tables and lookup in tables[name].columns and column in main.columns:
            checks.append(fk_orphans(main, column, tables[name], lookup, f"{entity}: {column} in {name}"))
    return reduce(DataFrame.unionByName, checks)


def completeness(df: DataFrame, columns: list[str]) -> DataFrame:
    """Missing count and share per named column; a column that is not there has null counts."""
    present = [c for c in columns if c in df.columns]
    one = df.agg(F.count(F.lit(1)).alias("_t"), *[F.count_if(F.col(c).isNull()).alias(f"_m_{c}") for c in present])
    none = F.lit(None)

    def row(c: str) -> Column:
        missing = F.col(f"_m_{c}") if c in present else none.cast("long")
        share = pct(missing, F.col("_t")) if c in present else none.cast("double")
        return F.struct(
            F.lit(c).alias("field"), F.col("_t").alias("total"), missing.alias("missing"), share.alias("missing_pct"),
            F.lit("ok" if c in present else "column not found").alias("status"),
        )

    return one.select(rows_of(*[row(c) for c in columns]))


def optional_null_report(df: DataFrame, column: str) -> DataFrame:
    """Completeness of a column that may be absent."""
    return completeness(df, [column])


def date_range(df: DataFrame, column: str) -> DataFrame:
    """First and last date and the number of distinct dates; text that is no date is an error."""
    d = F.to_date(F.col(column))
    return df.select(d.alias("d")).agg(
        F.min("d").alias("first_date"), F.max("d").alias("last_date"), F.count_distinct("d").alias("distinct_dates")
    )
