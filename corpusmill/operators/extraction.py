"""Attachments between queue, index, state and stored texts: edges, incremental outcomes, queues by precedence, checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .grouping import first_match, number_rows
from .joins import missing


def link_edges(pages: DataFrame, page: str, urls: str, normalize) -> DataFrame:
    """(url, page) of each normalised URL that a page names, once."""
    return pages.select(F.explode(urls).alias("url"), F.col(page).alias("page")).filter("page is not null").select(normalize(F.col("url")).alias("url"), "page").filter("url is not null").distinct()


def with_links(attachments: DataFrame, edges: DataFrame, url: str) -> DataFrame:
    """Attachments with ``linked_from``: the sorted pages that name their URL, empty where none does. Edges are gathered by URL before
    the join; attachments without a URL keep an empty list."""
    gathered = edges.groupBy(F.col("url").alias(url)).agg(F.array_sort(F.collect_set("page")).alias("linked_from"))
    return attachments.join(gathered, url, "left").withColumn("linked_from", F.coalesce("linked_from", F.array().cast("array<string>")))


def with_parents(attachments: DataFrame, documents: DataFrame, source: str, parent: str, doc_source: str, doc_number: str, values: list[str]) -> DataFrame:
    """Attachments with ``values`` of their parent document, found by source and number. A parent of 0 is none; a number that a
    source has twice counts as its smallest row."""
    own = documents.filter(F.col(doc_number).isNotNull()).groupBy(F.col(doc_source).alias(source), F.col(doc_number).alias(parent)).agg(F.min(F.struct(*values)).alias("_p"))
    rows = attachments.withColumn(parent, F.when(F.col(parent) != 0, F.col(parent)))
    return rows.join(own, [source, parent], "left").select("*", *[F.col(f"_p.{v}").alias(f"parent_{v}") for v in values]).drop("_p")


def with_prior(queue: DataFrame, state: DataFrame, index: DataFrame, key: str, state_values: list[str], index_values: list[str]) -> DataFrame:
    """Queue rows with what the state and the index of the run before say of their URL (``state_*``, ``index_*``), null where nothing."""
    for name, df, values in (("state", state, state_values), ("index", index, index_values)):
        last = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.max(F.struct(*values)).alias("_v"))
        queue = queue.join(last, key, "left").select("*", *[F.col(f"_v.{v}").alias(f"{name}_{v}") for v in values], F.col("_v").isNotNull().alias(f"in_{name}")).drop("_v")
    return queue


def incremental(downloads: DataFrame, status: Column, digest: Column, prior: Column, stored: Column) -> DataFrame:
    """``downloads`` with ``outcome``, and with ``carried``: true where the index and state rows of the run before are kept."""
    outcome = first_match(
        (status == 304, "not_modified"), (~F.coalesce(status.isin(200, 206), F.lit(False)) | digest.isNull(), "failed"), (prior.isNull(), "new"),
        ((digest == prior) & F.coalesce(stored, F.lit(False)), "downloaded_unchanged"), otherwise="changed",
    )
    return downloads.withColumn("outcome", outcome).withColumn("carried", F.col("outcome").isin("not_modified", "failed", "downloaded_unchanged"))


def removed(state: DataFrame, queue: DataFrame, key: str, full_run: bool) -> DataFrame:
    """State rows that the queue lacks: deleted, which only a full run can tell (no limit, source, extension or pending selection)."""
    return missing(state, queue, key) if full_run else state.limit(0)


def assemble_queue(candidates: list[tuple[str, DataFrame]], excluded: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """``(queue, left)``: for each key the row of the first list that has it, with the list's name as ``rule``; then the rows that
    ``excluded`` names by key, with the rule that they would have had. Null keys are in neither; a key that a list has twice counts
    as its smallest row."""
    rows = None
    for rank, (name, df) in enumerate(candidates):
        values = [c for c in df.columns if c != key]
        one = df.filter(F.col(key).isNotNull()).select(key, F.struct(F.lit(rank).alias("_rank"), F.lit(name).alias("rule"), F.struct(*values).alias("v")).alias("s"))
        rows = one if rows is None else rows.unionByName(one)
    best = rows.groupBy(key).agg(F.min("s").alias("s")).select(key, "s.rule", "s.v.*")
    gone = excluded.filter(F.col(key).isNotNull()).select(key).distinct()
    return best.join(gone, key, "left_anti"), best.join(gone, key, "left_semi")


def supported_override(reachable: Column, extension: Column, media_type: Column, extensions: list[str], media_types: list[str]) -> Column:
    """A file that its checks refused but that can be read: reachable, and of an extension and a type that have a reader."""
    return F.coalesce(reachable & extension.isin(*extensions) & media_type.isin(*media_types), F.lit(False))


def verify_texts(records: DataFrame, texts: DataFrame, key: str, stated: str, text: str) -> DataFrame:
    """(key, issue_type) of records whose text isn't stored, or has another hash than stated. Texts are hashed before the join, so they
    stay where they are; a text stored twice under a key fails if any copy does."""
    hashed = texts.select(key, F.sha2(text, 256).alias("_h")).distinct()
    checked = records.select(key, stated).distinct().join(hashed, key, "left")
    issue = first_match((F.col("_h").isNull(), "missing_text"), (~F.col("_h").eqNullSafe(F.col(stated)), "text_hash_mismatch"))
    return checked.select(key, issue.alias("issue_type")).filter("issue_type is not null").distinct()


def repeated_positions(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """(key, positions): 1-based places, in order, of keys that occur more than once. Places are counted by a range sort."""
    rows = number_rows(df.select(*order), order, "_at", "%d").filter(F.col(key).isNotNull())
    found = rows.groupBy(key).agg(F.array_sort(F.collect_list(F.col("_at").cast("long"))).alias("positions"))
    return found.filter(F.size("positions") > 1)


def consolidate_rules(rules: DataFrame, key: str, decision: str, reason: str, ranks: dict[str, int], position: str) -> DataFrame:
    """(key, decision, reasons): the highest decision of each key, the first of equals, with all its sorted distinct reasons."""
    rank = F.coalesce(*[F.when(F.col(decision) == v, r) for v, r in ranks.items()], F.lit(0))
    best = F.max_by(decision, F.struct(rank.alias("r"), (-F.col(position).cast("long")).alias("p"), F.col(decision)))
    return rules.groupBy(key).agg(best.alias("decision"), F.array_sort(F.collect_set(reason)).alias("reasons"))


def all_hold(conditions: dict[str, DataFrame]) -> DataFrame:
    """One row: a column for each named one-row table's only value, and ``complete``, whether all are true. Null is false."""
    out = None
    for name, df in conditions.items():
        one = df.select(F.coalesce(F.col(df.columns[0]).cast("boolean"), F.lit(False)).alias("value")).select(F.lit(name).alias("name"), "value")
        out = one if out is None else out.unionByName(one)
    each = [F.coalesce(F.bool_and(F.when(F.col("name") == n, F.col("value"))), F.lit(False)).alias(n) for n in conditions]
    return out.agg(*each, F.coalesce(F.bool_and("value"), F.lit(False)).alias("complete"))


def merge_right(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left rows laid over by the right row of their key: where there is one, its values win, nulls too; columns of either side stay."""
    theirs = [c for c in right.columns if c != key]
    rows = left.join(right.select(key, F.struct(*theirs).alias("_r")), key, "left")
    pick = [F.when(F.col("_r").isNotNull(), F.col(f"_r.{c}")).otherwise(F.col(c)).alias(c) if c in theirs else F.col(c) for c in left.columns]
    return rows.select(*pick, *[F.col(f"_r.{c}").alias(c) for c in theirs if c not in left.columns])


def sorted_map(entries: Column) -> Column:
    """A map with its entries in order of their keys."""
    return F.map_from_entries(F.array_sort(F.map_entries(entries)))


def at_run(df: DataFrame, when: str, name: str = "generated_at") -> DataFrame:
    """Rows with the run's timestamp, given once so that all tables of a run agree."""
    return df.withColumn(name, F.lit(when))
