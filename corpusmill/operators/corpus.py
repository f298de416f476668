"""The whole corpus in one plan: records, one per content, chunks, state, changes and the counts of a status file."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import hashing as X
from ..functions import text as T
from .changes import snapshot_diff
from .grouping import bounded_broadcast, delivered_once, first_match
from .segments import chunk_documents


def records(df: DataFrame, id_col: str, text_col: str, least_words: int = 10, title_col: str | None = None, language_col: str | None = None, metadata: dict[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """``(kept, excluded)``: records with normalised text, clean title, language (else by function words), content and metadata hashes;
    and (document_id, reason) of the rows left out: missing_id, missing_text, low_text. Equal rows count once."""
    body = T.normalize_text(F.col(text_col))
    meta = {name: F.col(c) for name, c in (metadata or {}).items()}
    rows = df.select(F.col(id_col).cast("string").alias("document_id"), body.alias("text"), *[(F.col(c) if c else F.lit(None).cast("string")).alias(n) for n, c in (("title", title_col), ("language", language_col))], *[c.alias(f"_{n}") for n, c in meta.items()])
    rows = rows.withColumn("word_count", T.word_count(F.col("text")))
    reason = first_match((F.col("document_id").isNull(), "missing_id"), (F.coalesce("text", F.lit("")) == "", "missing_text"), (F.col("word_count") < least_words, "low_text"))
    rows = rows.withColumn("reason", reason)
    kept = rows.filter("reason is null").select(
        "document_id", "text", T.clean_title(F.col("title")).alias("title"), F.coalesce(F.nullif("language", F.lit("")), T.detect_language(F.col("text"))).alias("language"), "word_count",
        F.sha2("text", 256).alias("content_sha256"), X.json_hash(title=F.col("title"), **{n: F.col(f"_{n}") for n in meta}).alias("metadata_sha256"),
    )
    return kept, rows.filter("reason is not null").select("document_id", "reason").distinct()


def one_per_content(kept: DataFrame) -> DataFrame:
    """The record of the smallest id of each content, with ``copies``. Ids and hashes alone are shuffled; the ids to drop and the contents
    with copies are sent to the records where they are few (checked), else joined."""
    pairs = kept.select("content_sha256", "document_id").distinct()
    best = pairs.groupBy("content_sha256").agg(F.min("document_id").alias("first"), F.count("*").alias("copies")).filter("copies > 1")
    drop = bounded_broadcast(pairs.join(best, "content_sha256").filter("document_id != first").select("content_sha256", "document_id"))
    rows = delivered_once(kept.join(drop, ["content_sha256", "document_id"], "left_anti"), "document_id")
    return rows.join(bounded_broadcast(best.select("content_sha256", "copies")), "content_sha256", "left").fillna(1, ["copies"])


def build_corpus(kept: DataFrame, before: DataFrame | None = None, target_words: int = 350, sections_col: str | None = None) -> dict[str, DataFrame]:
    """``documents``, ``chunks``, ``state``, ``changes`` against the state ``before``, ``status`` (metric, key, n) and ``broken``: (issue_type, key)
    of ids that aren't unique among documents or chunks, which a caller should refuse."""
    documents = one_per_content(kept)
    chunks = chunk_documents(documents, "document_id", "text", "title", target_words, language_col="language", sections_col=sections_col, keep=("content_sha256", "metadata_sha256"))
    per = F.array_sort(F.collect_list(F.struct("chunk_index", "id", "text_sha256")))
    state = chunks.groupBy("document_id").agg(F.first("content_sha256").alias("content_sha256"), F.first("metadata_sha256").alias("metadata_sha256"), per.alias("c"))
    state = state.select("document_id", "content_sha256", "metadata_sha256", F.transform("c", lambda x: x["id"]).alias("chunk_ids"), F.transform("c", lambda x: x["text_sha256"]).alias("chunk_text_sha256"), F.size("c").alias("chunk_count"))
    before = state.limit(0) if before is None else before
    changes = snapshot_diff(before, state)
    twice = lambda df, key, issue: df.groupBy(F.col(key).alias("key")).agg(F.count("*").alias("n")).filter("n > 1").select(F.lit(issue).alias("issue_type"), "key")
    count = lambda df, metric, key: df.groupBy(F.coalesce(F.col(key).cast("string"), F.lit("unknown")).alias("key")).agg(F.count("*").alias("n")).select(F.lit(metric).alias("metric"), "key", "n")
    status = count(documents, "documents_by_language", "language").unionByName(count(chunks, "chunks_by_language", "language")).unionByName(count(changes, "changes_by_action", "action"))
    return {"documents": documents, "chunks": chunks, "state": state, "changes": changes, "status": status, "broken": twice(documents, "document_id", "duplicate_document_id").unionByName(twice(chunks, "id", "duplicate_chunk_id"))}
