"""Lookups, reconciliation and merges by key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .grouping import top_per_group


def missing(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Rows whose key the other side doesn't have; null keys are missing."""
    return left.join(right.select(key).distinct(), key, "left_anti")


def present(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    return left.join(right.select(key).distinct(), key, "left_semi")


def lookup_with_fallback(left: DataFrame, rules: DataFrame, first: str, second: str, key: str, value: str) -> DataFrame:
    """``value`` of the rule for ``first``, else for ``second``. A rule that comes twice counts once (its greatest value)."""
    rules = rules.groupBy(key).agg(F.max(value).alias(value))
    one = rules.select(F.col(key).alias(first), F.col(value).alias("_one"))
    two = rules.select(F.col(key).alias(second), F.col(value).alias("_two"))
    return left.join(one, first, "left").join(two, second, "left").withColumn(value, F.coalesce("_one", "_two")).drop("_one", "_two")


def lookup_by_alias(left: DataFrame, id_col: str, aliases: str, right: DataFrame, key: str, value: str) -> DataFrame:
    """(id, value, hits): the value of the smallest alias that the other side knows, and how many it knows."""
    keys = left.select(id_col, F.explode(aliases).alias(key)).distinct()
    known = right.groupBy(key).agg(F.min(value).alias(value))
    found = keys.join(known, key).groupBy(id_col).agg(F.min(F.struct(key, value)).alias("_m"), F.count("*").alias("hits"))
    return left.select(id_col).distinct().join(found, id_col, "left").select(id_col, F.col(f"_m.{value}").alias(value), F.coalesce("hits", F.lit(0)).alias("hits"))


def merge_by_precedence(tables: list[DataFrame], key: str, order: list[str]) -> DataFrame:
    """Union in which the first table that has a key wins it; ``order`` decides within a table."""
    all_rows = None
    for rank, t in enumerate(tables):
        t = t.withColumn("_from", F.lit(rank))
        all_rows = t if all_rows is None else all_rows.unionByName(t, allowMissingColumns=True)
    return top_per_group(all_rows, [key], [F.asc("_from"), *map(F.asc, order)]).drop("_from")


def union_of_aliases(df: DataFrame, keys: list[str], aliases: str, name: str) -> DataFrame:
    """Sorted distinct aliases of each group."""
    return df.select(*keys, F.explode_outer(aliases).alias("_a")).groupBy(*keys).agg(F.array_sort(F.collect_set("_a")).alias(name))


def reconcile(tables: dict[str, DataFrame], key: str, pairs: list[tuple[str, str, str]]) -> DataFrame:
    """(issue_type, key) for keys of one table that another lacks; pairs are (left, right, issue)."""
    out = None
    for left, right, issue in pairs:
        rows = missing(tables[left].select(key).distinct(), tables[right], key).select(F.lit(issue).alias("issue_type"), key)
        out = rows if out is None else out.union(rows)
    return out
