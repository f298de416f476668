"""Data-quality rules over chunks and attachments."""

from pyspark.sql import functions as F

from ..operators import quality as Q
from ..operators.grouping import duplicate_groups
from .catalog import query, table

# fixed values: keys that a chunk record must have
REQUIRED = [
    "schema_version", "id", "document_id", "document_kind", "source_id", "source_ids", "source_priority", "title", "url", "url_aliases", "language",
    "chunk_index", "chunk_number", "chunk_count", "text", "embedding_text", "char_count", "word_count", "text_sha256", "document_content_sha256",
]

_W = r"len(regexp_extract_all(t, '[^\s\x{a0}]+'))"
_RULES = {
    "missing_chunk_id": ("error", "coalesce(id, '') = ''", "NULL"),
    "missing_document_id": ("error", "coalesce(document_id, '') = ''", "NULL"),
    "empty_text": ("error", "t = ''", "NULL"),
    "text_hash_mismatch": ("error", "t <> '' AND sha256(t) IS DISTINCT FROM text_sha256", "NULL"),
    "char_count_mismatch": ("error", "t <> '' AND length(t) IS DISTINCT FROM char_count", "length(t)"),
    "word_count_mismatch": ("error", f"t <> '' AND {_W} IS DISTINCT FROM word_count", _W),
    "control_characters_in_text": ("error", r"regexp_matches(t, '[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]')", "NULL"),
    "html_tag_in_text": ("warning", "regexp_matches(t, '<[A-Za-z!/][^>]*>')", "NULL"),
    "html_entity_in_text": ("warning", "regexp_matches(t, '&(?:nbsp|amp|lt|gt|quot|apos|#[0-9]+|#x[0-9A-Fa-f]+);')", "NULL"),
    "very_short_chunk": ("warning", f"t <> '' AND {_W} < 20", _W),
    "high_internal_repetition": ("warning", f"{_W} >= 50 AND len(g) >= 16 AND CAST(len(list_distinct(g)) AS DOUBLE) / len(g) < 0.5", "NULL"),
    "embedding_text_mismatch": ("error", "embedding_text IS DISTINCT FROM coalesce(title, '') || chr(10) || chr(10) || CASE WHEN ctx <> '' THEN ctx || chr(10) || chr(10) ELSE '' END || t", "NULL"),
    "empty_title": ("error", "trim(coalesce(title, '')) = ''", "NULL"),
    "title_contains_newline": ("warning", "contains(title, chr(10))", "NULL"),
    "title_contains_underscore": ("warning", "contains(title, '_')", "NULL"),
    "generic_title": ("warning", r"regexp_matches(trim(title), '(?i)^(?:document|dokument|plik|attachment|załącznik|page|strona|untitled|bez tytułu|\d+)$')", "NULL"),
    "invalid_or_missing_url": ("error", "NOT coalesce(regexp_matches(url, '^https?://'), false)", "NULL"),
    "missing_language": ("warning", "coalesce(language, '') = ''", "NULL"),
    "chunk_number_mismatch": ("error", "chunk_number <> chunk_index + 1", "NULL"),
}
_BASE = r"""
    b AS (SELECT *, coalesce(text, '') AS t, array_to_string(list_filter(list_transform(coalesce(context_path, []), lambda c: trim(c)), lambda c: c <> ''), ' > ') AS ctx,
          regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{Nd}\p{Nl}\p{M}\p{Pc}]+') AS tok FROM chunks),
    c AS (SELECT *, list_transform(range(1, greatest(len(tok) - 3, 1)), lambda i: tok[i:i+4]) AS g FROM b)"""
_AUDIT = (
    f"WITH {_BASE} "
    + " UNION ALL ".join(f"SELECT '{n}' AS issue_type, '{sev}' AS severity, id, document_id, CAST({detail} AS VARCHAR) AS detail FROM c WHERE {when}" for n, (sev, when, detail) in _RULES.items())
    + """ UNION ALL SELECT 'duplicate_chunk_id', 'error', id, NULL, CAST(count(*) AS VARCHAR) FROM chunks WHERE id <> '' GROUP BY id HAVING count(*) > 1
    UNION ALL SELECT 'document_chunk_sequence_error', 'error', NULL, document_id, CAST(count(*) AS VARCHAR) FROM chunks WHERE document_id <> '' GROUP BY document_id
      HAVING NOT (min(chunk_index) = 0 AND max(chunk_index) = count(*) - 1 AND count(DISTINCT chunk_index) = count(*))
    UNION ALL SELECT 'document_chunk_count_error', 'error', NULL, document_id, CAST(count(*) AS VARCHAR) FROM chunks WHERE document_id <> '' GROUP BY document_id
      HAVING NOT (min(chunk_count) = count(*) AND max(chunk_count) = count(*) AND count(chunk_count) = count(*))"""
)


@query("chunk_audit", _AUDIT)
def chunk_audit(spark, d):
    return Q.audit_chunks(table(spark, d, "chunks"))


@query("chunk_audit_summary", f"SELECT issue_type, severity, count(*) AS n FROM ({_AUDIT}) GROUP BY 1, 2")
def chunk_audit_summary(spark, d):
    return Q.audit_chunks(table(spark, d, "chunks")).groupBy("issue_type", "severity").agg(F.count("*").alias("n"))


@query("missing_fields", """
    SELECT DISTINCT id, array_to_string(list_filter(['language', 'source_priority', 'text_sha256', 'word_count'], lambda f: CASE f WHEN 'language' THEN language IS NULL WHEN 'source_priority' THEN source_priority IS NULL WHEN 'text_sha256' THEN text_sha256 IS NULL ELSE word_count IS NULL END), ' ') AS missing
    FROM chunks WHERE language IS NULL OR source_priority IS NULL OR text_sha256 IS NULL OR word_count IS NULL""")
def missing_fields(spark, d):
    """Chunk records as JSON lines in which nulls are left out, held against the required keys."""
    lines = table(spark, d, "chunks").select("id", F.to_json(F.struct(*REQUIRED)).alias("value"))
    found = Q.missing_fields(lines, "value", REQUIRED, ["id"])
    return found.select("id", F.array_join(F.array_sort("missing"), " ").alias("missing")).distinct()


@query("attachment_audit", """
    SELECT 'duplicate_index_url' AS issue_type, effective_url AS url, CAST(count(*) AS VARCHAR) AS detail FROM text_index WHERE effective_url IS NOT NULL GROUP BY effective_url HAVING count(*) > 1
    UNION ALL SELECT DISTINCT 'missing_blob_path', effective_url, NULL FROM text_index WHERE coalesce(trim(blob_path), '') = ''
    UNION ALL SELECT DISTINCT 'low_text', effective_url, CAST(word_count AS VARCHAR) FROM text_index WHERE word_count < 20
    UNION ALL SELECT DISTINCT 'missing_text', effective_url, NULL FROM text_index t WHERE extraction_status IN ('ok', 'ok_ocr') AND NOT EXISTS (SELECT 1 FROM corpus_state s WHERE s.document_id = 'attachment:' || t.content_sha256)""")
def attachment_audit(spark, d):
    index = table(spark, d, "text_index")
    twice = duplicate_groups(index, "effective_url").select(F.lit("duplicate_index_url").alias("issue_type"), F.col("effective_url").alias("url"), F.col("n").cast("string").alias("detail"))
    own = index.select("effective_url", "blob_path", "word_count", "content_sha256", "extraction_status").distinct()
    rules = [Q.Rule("missing_blob_path", "error", F.coalesce(F.trim("blob_path"), F.lit("")) == ""), Q.Rule("low_text", "warning", F.col("word_count") < 20, F.col("word_count"))]
    rows = Q.check(own, rules, ["effective_url"]).select("issue_type", F.col("effective_url").alias("url"), "detail").distinct()
    used = own.filter(F.col("extraction_status").isin("ok", "ok_ocr")).withColumn("document_id", F.concat(F.lit("attachment:"), "content_sha256"))
    lost = used.join(table(spark, d, "corpus_state").select("document_id"), "document_id", "left_anti").select(F.lit("missing_text").alias("issue_type"), F.col("effective_url").alias("url"), F.lit(None).cast("string").alias("detail")).distinct()
    return twice.union(rows).union(lost)


@query("scan_work_queue", "SELECT DISTINCT attachment_id, queue_id, content_sha256, source_id, filename FROM text_index WHERE extraction_status = 'manual_review'")
def scan_work_queue(spark, d):
    return table(spark, d, "text_index").filter("extraction_status = 'manual_review'").select("attachment_id", "queue_id", "content_sha256", "source_id", "filename").distinct()


@query("scan_counts", """
    SELECT s.run_id, s.result_counts.ok_ocr AS stated, count(DISTINCT t.queue_id) FILTER (WHERE t.extraction_status = 'ok_ocr') AS counted FROM attachment_ocr_status s LEFT JOIN text_index t ON s.run_id = t.run_id GROUP BY 1, 2""")
def scan_counts(spark, d):
    """Counts that the status states, held against the index."""
    counted = table(spark, d, "text_index").groupBy("run_id").agg(F.count_distinct(F.when(F.col("extraction_status") == "ok_ocr", F.col("queue_id"))).alias("counted"))
    status = table(spark, d, "attachment_ocr_status").select("run_id", F.col("result_counts.ok_ocr").alias("stated")).distinct()
    return status.join(counted, "run_id", "left").select("run_id", "stated", F.coalesce("counted", F.lit(0)).alias("counted"))
