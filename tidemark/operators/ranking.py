"""Exact ranks and quantiles without sending a group, or a column, through one task.

Values hang under two levels of nodes. The first node number is a slice of the logarithm
(256 per octave), the second a linear slice of its node, so both rise with the value. Whatever
the data, a group has at most about a million first-level nodes, a node has a few million
children, and a second-level node a bounded number of distinct doubles. Running counts are
only ever taken among the children of one node, which bounds every window task; a hot value is
combined into one row before any shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.session import written

# Fixed values of the node numbering. The numbers are never null; saying so keeps joins from
# adding null filters to one use of a subplan only, which would stop its exchange from being shared.
_ZERO = 1 << 20
_INF = 1 << 40
_NODE1 = f"""coalesce(CASE WHEN v = double('inf') THEN {_INF}L WHEN v = double('-inf') THEN -{_INF}L WHEN v > 0 THEN CAST(floor(log2(v) * 256D) AS BIGINT) + {_ZERO}
                           WHEN v < 0 THEN -CAST(floor(log2(-v) * 256D) AS BIGINT) - {_ZERO} ELSE 0L END, 0L)"""
_NODE2 = f"""coalesce(CASE WHEN k1 = 0 OR abs(k1) = {_INF} THEN 0L
                           ELSE CAST(floor(v / pow(2D, (abs(k1) - {_ZERO}) / 256D) * 268435456D) AS BIGINT) END, 0L)"""
_BEFORE = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"


def _list(*names: str) -> str:
    return ", ".join(names)


def _quoted(by: list[str]) -> list[str]:
    return [f"`{c}`" for c in by]


def _values(by: list[str], value: str, extra: str = "") -> str:
    """Rows (by, v, k1) with every key and the value present."""
    keep = " AND ".join(["v IS NOT NULL", "NOT isnan(v)", *[f"{c} IS NOT NULL" for c in by]])
    return f"""SELECT *, {_NODE1} AS k1
               FROM (SELECT {_list(*by, f"CAST(`{value}` AS DOUBLE) AS v")}{extra} FROM {{df}})
               WHERE {keep}"""


def order_statistics(
    df: DataFrame, by: list[str], value: str, positions: dict[str, str], few: bool = False, **tables: DataFrame
) -> DataFrame:
    """Sorted values of each group at 0-based positions, exactly.

    ``positions`` maps a name to a SQL expression of the group size ``size`` (and of tables
    given by name). Returns ``by``, ``n``, and per name the value and ``<name>_below``, the
    number of smaller values. ``few`` promises that the number of groups is fixed by the caller
    and not by the data; only then are the wanted nodes (groups x positions) broadcast by hint,
    and only the rows of those nodes are shuffled by value.
    """
    by = _quoted(by)
    ats = [f"at_{name}" for name in positions]
    # positions come first in the parent and are made relative to the child that holds them
    into_child = _list(*[f"CASE WHEN {a} >= before AND {a} < before + n THEN {a} - before END AS {a}" for a in ats])
    holds = f"coalesce({_list(*ats)}) IS NOT NULL"
    carried = _list(*[f"max({c}) AS {c}" for c in ("size", *ats)])
    group = _list(*by) or "0"
    out = [f"max(CASE WHEN {a} IS NOT NULL THEN v END) AS `{name}`, max({pos} - {a}) AS `{name}_below`" for a, (name, pos) in zip(ats, positions.items())]
    node = _list(*by, "k1")
    if few or not by:
        # a handful of wanted nodes: filter the rows on the map side, count only what is left
        counts = ""
        nodes = f"SELECT {node}, count(1) AS n FROM vals GROUP BY {node}"
        near = f"""SELECT /*+ BROADCAST(top) */ {node}, v, count(1) AS n, {carried}
                   FROM vals JOIN top USING ({node}) GROUP BY {node}, v"""
    else:
        # any number of groups: count the values first, so that a hot value is one row in the join
        counts = f"counts AS (SELECT {node}, v, count(1) AS n FROM vals GROUP BY {node}, v),"
        nodes = f"SELECT {node}, sum(n) AS n FROM counts GROUP BY {node}"
        near = f"SELECT * FROM counts JOIN top USING ({node})"
    text = f"""
    WITH vals AS ({_values(by, value)}), {counts}
    level1 AS (
      SELECT *, {_list(*[f"{pos} AS {a}" for a, pos in zip(ats, positions.values())])} FROM (
        SELECT *, coalesce(sum(n) OVER (PARTITION BY {group} ORDER BY k1 {_BEFORE}), 0L) AS before,
               sum(n) OVER (PARTITION BY {group}) AS size
        FROM ({nodes}))),
    top AS (SELECT * FROM (SELECT {_list(*by, "k1", "size", into_child)} FROM level1) WHERE {holds}),
    near AS (SELECT *, {_NODE2} AS k2 FROM ({near})),
    level2 AS (
      SELECT *, coalesce(sum(n) OVER (PARTITION BY {_list(*by, "k1")} ORDER BY k2 {_BEFORE}), 0L) AS before
      FROM (SELECT {_list(*by, "k1", "k2")}, sum(n) AS n, {carried} FROM near GROUP BY {_list(*by, "k1", "k2")})),
    middle AS (SELECT * FROM (SELECT {_list(*by, "k1", "k2", into_child)} FROM level2) WHERE {holds}),
    leaves AS (
      SELECT *, coalesce(sum(n) OVER (PARTITION BY {_list(*by, "k1", "k2")} ORDER BY v {_BEFORE}), 0L) AS before
      FROM (SELECT {_list(*by, "k1", "k2", "v", "n", "size")} FROM near) JOIN middle USING ({_list(*by, "k1", "k2")})),
    found AS (SELECT * FROM (SELECT {_list(*by, "v", "size", into_child)} FROM leaves) WHERE {holds})
    SELECT {_list(*by, "max(size) AS n", *out)} FROM found {"GROUP BY " + _list(*by) if by else ""}
    """
    return df.sparkSession.sql(text, df=df, **tables)


def group_quantiles(
    df: DataFrame, by: list[str], value: str, probs: dict[str, float], few: bool = False
) -> DataFrame:
    """Exact linearly interpolated quantiles per group: by, ``n`` and one column per name.

    Null keys and null values are left out; a group without values has no row.
    """
    positions = {}
    for name, p in probs.items():
        positions[f"{name}_lo"] = f"CAST(floor((size - 1) * {float(p)!r}D) AS BIGINT)"
        positions[f"{name}_hi"] = f"CAST(ceil((size - 1) * {float(p)!r}D) AS BIGINT)"
    found = order_statistics(df, by, value, positions, few)
    columns = [
        f"CASE WHEN `{name}_lo` = `{name}_hi` OR `{name}_lo` = double('-inf') AND `{name}_hi` < double('inf') THEN `{name}_lo` ELSE `{name}_lo` + (`{name}_hi` - `{name}_lo`) * "
        f"((n - 1) * {float(p)!r}D - floor((n - 1) * {float(p)!r}D)) END AS `{name}`"
        for name, p in probs.items()
    ]
    return found.selectExpr(*_quoted(by), "n", *columns)


def medians(df: DataFrame, by: list[str], value: str, name: str = "median") -> DataFrame:
    return group_quantiles(df, by, value, {name: 0.5})


def field_quantiles(df: DataFrame, by: list[str], fields: list[str], probs: dict[str, float]) -> DataFrame:
    """``group_quantiles`` of several columns in one job; rows per (by, field)."""
    tall = df.select(*by, *[F.col(f).cast("double").alias(f) for f in fields]).unpivot(by, fields, "field", "_x")
    return group_quantiles(tall, [*by, "field"], "_x", probs, few=not by)


def rank_sums(df: DataFrame, by: list[str], value: str, first: Column, second: Column) -> DataFrame:
    """Midrank sum of the first of two samples, with sizes and tie term, per ``by``.

    A rank is what lies in earlier first-level nodes, plus earlier second-level nodes under the
    same parent, plus smaller values in the same node. The sum is built up level by level.
    """
    rows = df.where(first | second).withColumn("_first", first)
    by = _quoted(by)

    def level(source: str, keys: list[str], parent: list[str], key: str) -> str:
        """Nodes of one level with the count of earlier siblings."""
        return f"""SELECT *, coalesce(sum(n) OVER (PARTITION BY {_list(*parent) or "0"} ORDER BY {key} {_BEFORE}), 0L) AS before
                   FROM (SELECT {_list(*keys)}, sum(r + a * before) AS r, sum(t) AS t, sum(a) AS a, sum(n) AS n
                         FROM {source} GROUP BY {_list(*keys)})"""

    node1, node2 = [*by, "k1"], [*by, "k1", "k2"]
    text = f"""
    WITH vals AS ({_values(by, value, ", _first")}),
    leaves AS (
      SELECT *, a * ((n + 1) / 2D) AS r, CAST(n AS DOUBLE) * n * n - n AS t,
             coalesce(sum(n) OVER (PARTITION BY {_list(*node2)} ORDER BY v {_BEFORE}), 0L) AS before
      FROM (SELECT *, {_NODE2} AS k2 FROM (
        SELECT {_list(*node1, "v")}, CAST(count_if(_first) AS DOUBLE) AS a, count(1) AS n FROM vals GROUP BY {_list(*node1, "v")}))),
    level2 AS ({level("leaves", node2, node1, "k2")}),
    level1 AS ({level("level2", node1, by, "k1")})
    SELECT {_list(*by, "sum(r + a * before) AS rank_sum_a", "sum(t) AS tie_term")},
           CAST(sum(a) AS BIGINT) AS n_a, sum(n) - CAST(sum(a) AS BIGINT) AS n_b
    FROM level1 {"GROUP BY " + _list(*by) if by else ""}
    """
    return df.sparkSession.sql(text, df=rows)


def numbered(df: DataFrame, by: list[str], name: str) -> DataFrame:
    """The rows with their place in the order of ``by`` from 1 on, as a written table; ties in any order.

    Rows are sorted within ranges, in one task each; only the sizes of the ranges meet in one place.
    """
    ordered = df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id())
    rows = written(ordered, "numbered").withColumn("_range", F.shiftright("_at", 33))
    sizes = {r["_range"]: r["n"] for r in rows.groupBy("_range").agg(F.count(F.lit(1)).alias("n")).collect()}  # one a range
    before, starts = 0, []
    for k in sorted(sizes):
        starts += [F.lit(k), F.lit(before)]
        before += sizes[k]
    offset = F.try_element_at(F.create_map(*starts), F.col("_range")).cast("long") if starts else F.lit(0).cast("long")
    return rows.withColumn(name, offset + F.col("_at").bitwiseAND((1 << 33) - 1) + 1).drop("_at", "_range")
