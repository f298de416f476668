"""One record per content, and decisions laid over records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import url as U


def consolidate(rows: DataFrame, key: str, order: list[Column], id_col: str, name_col: str, url_col: str, aliases_col: str, first_col: str, last_col: str) -> DataFrame:
    """One row per content: the primary record (first by ``order``), the best title of all (most words, then longest, then
    first by name), all aliases, earliest and latest date, and how many records there were. One shuffle, partly summed before it.
    Rows without a key are left out."""
    rows = rows.filter(F.col(key).isNotNull())
    title = T.stem_title(F.coalesce(F.nullif(F.col(name_col), F.lit("")), U.basename(F.col(url_col))))
    rank = F.struct((-T.word_count(title)).alias("a"), (-F.length(title)).alias("b"), title.alias("title"))
    primary = F.min(F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)], F.col(id_col).alias("id"), F.col(url_col).alias("url")))
    alias_sets = F.array_union(F.coalesce(aliases_col, F.array().cast("array<string>")), F.array(url_col))
    groups = rows.groupBy(key).agg(primary.alias("p"), F.min(rank).alias("t"), F.min(first_col).alias("first_at"), F.max(last_col).alias("last_at"), F.count_distinct(id_col).alias("records"))
    names = rows.select(key, F.explode(alias_sets).alias("alias")).filter("alias is not null").groupBy(key).agg(F.array_sort(F.collect_set("alias")).alias("aliases"))
    return groups.join(names, key, "left").select(key, F.col("p.id").alias("primary_id"), F.col("p.url").alias("url"), F.col("t.title").alias("title"), "aliases", "first_at", "last_at", "records")


def overlay(rows: DataFrame, decisions: DataFrame, key: str, status_col: str, warnings_col: str, replaced: dict[str, str]) -> DataFrame:
    """Rows with the status that their decision gives them and the reason among their warnings, once. Several decisions for a key
    count as the first by name; rows without one, or with one that isn't in ``replaced``, stay as they are."""
    best = decisions.groupBy(key).agg(F.min(F.struct("decision", "reason")).alias("_d"))
    new = F.coalesce(*[F.when(F.col("_d.decision") == k, v) for k, v in replaced.items()])
    none = F.array().cast("array<string>")
    warned = F.array_distinct(F.concat(F.coalesce(warnings_col, none), F.array(F.col("_d.reason"))))
    out = rows.join(best, key, "left")
    return out.withColumn(warnings_col, F.when(new.isNotNull() & F.col("_d.reason").isNotNull(), warned).otherwise(F.coalesce(warnings_col, none))).withColumn(status_col, F.coalesce(new, F.col(status_col))).drop("_d")
