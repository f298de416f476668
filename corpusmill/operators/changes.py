"""Change data capture between snapshots, and its replay."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .grouping import first_match, top_per_group


def state_records(chunks: DataFrame) -> DataFrame:
    """One row per document from its chunks: ids and text hashes in order of the chunks.

    A chunk delivered twice counts once. The arrays hold one document's chunks.
    """
    once = chunks.groupBy("document_id", "id").agg(F.min(F.struct("chunk_index", "text", "document_content_sha256")).alias("c"))
    per_doc = once.groupBy("document_id").agg(
        F.min("c.document_content_sha256").alias("content_sha256"),
        F.array_sort(F.collect_list(F.struct("c.chunk_index", "id", F.sha2("c.text", 256).alias("h")))).alias("all"),
    )
    return per_doc.select(
        "document_id", "content_sha256", F.transform("all", lambda x: x["id"]).alias("chunk_ids"),
        F.transform("all", lambda x: x["h"]).alias("chunk_text_sha256"), F.size("all").alias("chunk_count"),
    )


def snapshot_diff(before: DataFrame, after: DataFrame, key: str = "document_id") -> DataFrame:
    """(key, action, reason, previous and current hash, chunk ids to delete and to upsert), one row per key of either snapshot.

    Both snapshots have key, content_sha256, metadata_sha256 and chunk_ids, chunk_text_sha256; one full outer join.
    """
    a = before.select(F.col(key), *[F.col(c).alias(f"_a_{c}") for c in ("content_sha256", "metadata_sha256", "chunk_ids", "chunk_text_sha256")], F.lit(True).alias("_a"))
    b = after.select(F.col(key), *[F.col(c).alias(f"_b_{c}") for c in ("content_sha256", "metadata_sha256", "chunk_ids", "chunk_text_sha256")], F.lit(True).alias("_b"))
    both = a.join(b, key, "full_outer")
    same = lambda c: F.col(f"_a_{c}").eqNullSafe(F.col(f"_b_{c}"))
    reason = first_match(
        (F.col("_a").isNull(), "document_added"), (F.col("_b").isNull(), "document_removed"), (~same("content_sha256"), "content_changed"),
        (~same("metadata_sha256"), "metadata_changed"), (~(same("chunk_ids") & same("chunk_text_sha256")), "chunking_changed"), otherwise="unchanged",
    )
    action = F.when(reason == "document_added", "new").when(reason == "document_removed", "deleted").when(reason == "unchanged", "unchanged").otherwise("changed")
    none = F.array().cast("array<string>")
    return both.select(
        key, action.alias("action"), reason.alias("reason"), F.col("_a_content_sha256").alias("previous_content_sha256"), F.col("_b_content_sha256").alias("current_content_sha256"),
        F.when(action.isin("changed", "deleted"), F.coalesce("_a_chunk_ids", none)).otherwise(none).alias("delete_chunk_ids"),
        F.when(action.isin("changed", "new"), F.coalesce("_b_chunk_ids", none)).otherwise(none).alias("upsert_chunk_ids"),
    )


def latest_changes(log: DataFrame, key: str = "document_id") -> DataFrame:
    """The last change of each key by generated_at, then received_at: late and repeated rows of the log don't matter."""
    return top_per_group(log.dropDuplicates([key, "generated_at", "action", "reason"]), [key], [F.desc("generated_at"), F.desc("received_at"), F.asc("action"), F.asc("reason")])


def replay(log: DataFrame, key: str = "document_id") -> DataFrame:
    """(key, content_sha256) that a log leads to: for each key, the last row that changes anything, if it doesn't delete."""
    last = latest_changes(log.filter(F.col("action") != "unchanged"), key)
    return last.filter(F.col("action") != "delete").select(key, F.col("current_content_sha256").alias("content_sha256"))


def download_outcome(status: Column, digest: Column, known_digest: Column, stored: Column) -> Column:
    """What a conditional download found against the state of the run before."""
    return first_match(
        (status == 304, "not_modified"), (~status.isin(200, 206), "failed"), (digest.isNull(), "failed"), (known_digest.isNull(), "new"),
        ((digest == known_digest) & stored, "downloaded_unchanged"), otherwise="changed",
    )
