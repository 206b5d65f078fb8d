"""Star schema projections and the analytical queries over it."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.operators.dedupe import dedupe_first
from tidemark.operators.derive import rename_project
from tidemark.sources.readers import sql_scan


def build_fact(master: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return rename_project(master, mapping)


def build_dim(master: DataFrame, mapping: dict[str, str], key: str, row_key: str) -> DataFrame:
    """One row per key of the master: its first row in ``row_key`` order."""
    return rename_project(dedupe_first(master.select(row_key, *[c for c in mapping if c != row_key]), [key], F.col(row_key)), mapping)


def top_groups(dim: DataFrame, name: str, measure: str, others: list[str], k: int = 10) -> DataFrame:
    """The k dimension rows with the largest measure, ties in name order."""
    return sql_scan(
        dim.sparkSession,
        f"SELECT {', '.join([name, measure, *others])} FROM {{dim}} ORDER BY {measure} DESC NULLS LAST, {name} LIMIT {k}",
        dim=dim,
    )


def _by_dim_label(
    fact: DataFrame, dim: DataFrame, key: str, label: str, name: str, averages: dict[str, str], where: str, order: str,
) -> DataFrame:
    """Count and averages of fact rows by a label of their dimension row.

    The fact is summed per key before it meets the dimension, so the join moves one row per key
    however many fact rows a key holds.
    """
    sums = ", ".join(f"SUM({c}) AS s{i}, COUNT({c}) AS k{i}" for i, c in enumerate(averages))
    means = ", ".join(f"SUM(s{i}) / NULLIF(SUM(k{i}), 0) AS {alias}" for i, alias in enumerate(averages.values()))
    return sql_scan(
        fact.sparkSession,
        f"""
        WITH per_key AS (SELECT {key}, COUNT(*) AS n, {sums} FROM {{fact}} GROUP BY {key}),
             labelled AS (SELECT {key}, {label} AS {name} FROM {{dim}} WHERE {where})
        SELECT {name}, SUM(n) AS listing_count, {means}
        FROM labelled JOIN per_key USING ({key})
        GROUP BY {name}
        {order}
        """,
        fact=fact, dim=dim,
    )


def agg_by_flag(
    fact: DataFrame, dim: DataFrame, key: str, flag: str, labels: tuple[str, str], averages: dict[str, str],
    name: str = "host_type",
) -> DataFrame:
    """Row count and averages of fact measures by a two-valued flag of the dimension.

    Rows whose key or flag is null are left out; every flag other than 't' is the second label.
    """
    label = f"IF({flag} = 't', '{labels[0]}', '{labels[1]}')"
    return _by_dim_label(fact, dim, key, label, name, averages, f"{flag} IS NOT NULL", "")


def agg_by_bucket(
    fact: DataFrame, dim: DataFrame, key: str, measure: str, edges: list[tuple[float, str]], last: str,
    averages: dict[str, str], missing: str = "Unknown", name: str = "tenure_bucket",
) -> DataFrame:
    """Row count and averages by bucket of a dimension measure, in bucket order, missing last."""
    cases = " ".join(f"WHEN {measure} < {edge} THEN '{label}'" for edge, label in edges)
    bucket = f"CASE WHEN {measure} IS NULL THEN '{missing}' {cases} ELSE '{last}' END"
    ranks = " ".join(f"WHEN '{label}' THEN {i}" for i, label in enumerate([e[1] for e in edges] + [last]))
    order = f"ORDER BY CASE {name} {ranks} ELSE {len(edges) + 1} END"
    return _by_dim_label(fact, dim, key, bucket, name, averages, "true", order)


def agg_by_category(fact: DataFrame, category: str, measure: str, name: str) -> DataFrame:
    """Row count and average by category, largest average first."""
    return sql_scan(
        fact.sparkSession,
        f"""
        SELECT {category}, COUNT(*) AS listing_count, AVG({measure}) AS {name}
        FROM {{fact}} GROUP BY {category} ORDER BY {name} DESC NULLS LAST, {category}
        """,
        fact=fact,
    )
