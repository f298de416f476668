"""Counting, ranking, deduplication, set operations and joins."""

from pyspark.sql import functions as F

from ..functions import hashing as X
from ..functions import text as T
from ..operators import grouping as G
from ..operators import joins as J
from ..operators.consolidate import consolidate, overlay
from .catalog import query, table


@query("count_by_source", "SELECT coalesce(nullif(source_id, ''), 'unknown') AS source_id, count(*) AS n FROM chunks GROUP BY 1")
def count_by_source(spark, d):
    return G.count_by(table(spark, d, "chunks"), "source_id")


@query("counts_two_levels", "SELECT coalesce(nullif(source_id, ''), 'unknown') AS source_id, coalesce(nullif(extraction_status, ''), 'unknown') AS extraction_status, count(*) AS n FROM text_index GROUP BY 1, 2")
def counts_two_levels(spark, d):
    return G.count_by(table(spark, d, "text_index"), "source_id", "extraction_status")


@query("status_counts", " UNION ALL ".join(f"SELECT '{c}' AS metric, coalesce(nullif(CAST({c} AS VARCHAR), ''), 'unknown') AS key, count(*) AS n FROM chunks GROUP BY 2" for c in ("document_kind", "source_id", "source_priority", "language", "section_kind")))
def status_counts(spark, d):
    """All one-dimensional counts of a status file in one pass."""
    return G.counts_of_each(table(spark, d, "chunks"), ["document_kind", "source_id", "source_priority", "language", "section_kind"])


@query("status_cube", "SELECT document_kind, source_priority, count(*) AS n, grouping(document_kind) * 2 + grouping(source_priority) AS level FROM chunks GROUP BY GROUPING SETS ((document_kind), (source_priority), ())")
def status_cube(spark, d):
    table(spark, d, "chunks").createOrReplaceTempView("chunks_of_status")
    return spark.sql("""SELECT document_kind, source_priority, count(*) AS n, grouping_id(document_kind, source_priority) AS level FROM chunks_of_status
                        GROUP BY document_kind, source_priority GROUPING SETS ((document_kind), (source_priority), ())""")


@query("conditional_counts", "SELECT source_id, count(*) FILTER (WHERE extraction_status IN ('ok', 'ok_ocr')) AS usable, count(*) FILTER (WHERE word_count < 20) AS low_text, count(*) FILTER (WHERE filename IS NULL) AS unnamed FROM text_index GROUP BY source_id")
def conditional_counts(spark, d):
    return table(spark, d, "text_index").groupBy("source_id").agg(
        F.count_if(F.col("extraction_status").isin("ok", "ok_ocr")).alias("usable"), F.count_if(F.col("word_count") < 20).alias("low_text"), F.count_if(F.col("filename").isNull()).alias("unnamed")
    )


@query("text_volume", r"SELECT source, count(*) AS documents, sum(length(text)) AS chars, sum(len(regexp_extract_all(text, '[^\s\x{a0}]+'))) AS words FROM documents GROUP BY source")
def text_volume(spark, d):
    return table(spark, d, "documents").groupBy("source").agg(F.count("*").alias("documents"), F.sum(F.length("text")).alias("chars"), F.sum(T.word_count(F.col("text"))).alias("words"))


@query("equal_contents", "SELECT sha256(text) AS content_sha256, count(*) AS n FROM documents WHERE text IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
def equal_contents(spark, d):
    return G.duplicate_groups(table(spark, d, "documents").select(F.sha2("text", 256).alias("content_sha256")), "content_sha256")


@query("extra_copies", "SELECT count(*) AS duplicate_groups, coalesce(sum(n - 1), 0) AS extra_copies FROM (SELECT count(*) AS n FROM chunks WHERE text IS NOT NULL GROUP BY sha256(text) HAVING count(*) > 1)")
def extra_copies(spark, d):
    return G.extra_copies(table(spark, d, "chunks").select(F.sha2("text", 256).alias("h")), "h")


@query("distinct_counts", "SELECT document_kind, count(DISTINCT id) AS chunks, count(DISTINCT document_id) AS documents, count(DISTINCT source_id) AS sources FROM chunks GROUP BY 1")
def distinct_counts(spark, d):
    return table(spark, d, "chunks").groupBy("document_kind").agg(*[F.count_distinct(c).alias(n) for c, n in (("id", "chunks"), ("document_id", "documents"), ("source_id", "sources"))])


@query("document_dates", "SELECT document_id, min(published_at) AS published_at, max(modified_at) AS modified_at FROM chunks GROUP BY 1")
def document_dates(spark, d):
    return table(spark, d, "chunks").groupBy("document_id").agg(F.min("published_at").alias("published_at"), F.max("modified_at").alias("modified_at"))


_RANK = "CASE priority WHEN 'A' THEN 0 WHEN 'B' THEN 1 WHEN 'C' THEN 2 ELSE 99 END"


@query("primary_per_content", f"""
    SELECT content_sha256, attachment_id FROM (SELECT t.*, row_number() OVER (PARTITION BY content_sha256 ORDER BY {_RANK}, t.source_id, effective_url, attachment_id) AS k
    FROM text_index t LEFT JOIN source_rules r ON t.source_id = r.id WHERE content_sha256 IS NOT NULL) WHERE k = 1""")
def primary_per_content(spark, d):
    """The attachment that stands for all with its content: best source first."""
    rules = table(spark, d, "source_rules").select(F.col("id").alias("source_id"), "priority")
    rows = table(spark, d, "text_index").filter("content_sha256 is not null").join(rules, "source_id", "left")
    rank = F.when(F.col("priority") == "A", 0).when(F.col("priority") == "B", 1).when(F.col("priority") == "C", 2).otherwise(99)
    return G.top_per_group(rows, ["content_sha256"], [rank, F.asc_nulls_last("source_id"), F.asc("effective_url"), F.asc("attachment_id")]).select("content_sha256", "attachment_id")


@query("best_titles", r"""
    SELECT document_id, title FROM (SELECT document_id, title, row_number() OVER (PARTITION BY document_id ORDER BY len(regexp_extract_all(title, '[^\s\x{a0}]+')) DESC, length(title) DESC, chunk_index, id) AS k
    FROM chunks WHERE title IS NOT NULL) WHERE k = 1""")
def best_titles(spark, d):
    """The title of most words, then most characters, then first."""
    rows = table(spark, d, "chunks").filter("title is not null")
    return G.top_per_group(rows, ["document_id"], [T.word_count(F.col("title")).desc(), F.length("title").desc(), F.asc("chunk_index"), F.asc("id")]).select("document_id", "title")


@query("chunk_numbers", "SELECT id, row_number() OVER w - 1 AS chunk_index, row_number() OVER w AS chunk_number, count(*) OVER (PARTITION BY document_id) AS chunk_count FROM (SELECT DISTINCT id, document_id FROM chunks) WINDOW w AS (PARTITION BY document_id ORDER BY id)")
def chunk_numbers(spark, d):
    return G.number_within(table(spark, d, "chunks").select("id", "document_id").distinct(), ["document_id"], ["id"]).drop("document_id")


@query("sequential_ids", "SELECT effective_url, format('attachment-{:05d}', row_number() OVER (ORDER BY effective_url)) AS queue_id FROM (SELECT DISTINCT effective_url FROM text_index WHERE effective_url IS NOT NULL)")
def sequential_ids(spark, d):
    return G.number_rows(table(spark, d, "text_index").filter("effective_url is not null").select("effective_url").distinct(), ["effective_url"], "queue_id", "attachment-%05d")


@query("sequence_audit", """
    SELECT * FROM (SELECT document_id, count(*) AS n, NOT (min(chunk_index) = 0 AND max(chunk_index) = count(*) - 1 AND count(DISTINCT chunk_index) = count(*)) AS sequence_error,
    NOT (min(chunk_count) = count(*) AND max(chunk_count) = count(*) AND count(chunk_count) = count(*)) AS count_error FROM chunks GROUP BY 1) WHERE sequence_error OR count_error""")
def sequence_audit(spark, d):
    return G.sequence_errors(table(spark, d, "chunks"), "document_id", "chunk_index", "chunk_count")


@query("ordered_distinct", """
    WITH e AS (SELECT document_id, chunk_index, unnest(context_path) AS c FROM chunks), f AS (SELECT document_id, trim(c) AS c, min(chunk_index) AS p FROM e WHERE trim(c) <> '' GROUP BY 1, 2)
    SELECT document_id, string_agg(c, ' > ' ORDER BY p, c) AS context FROM f GROUP BY 1""")
def ordered_distinct(spark, d):
    rows = table(spark, d, "chunks").select("document_id", "chunk_index", F.explode("context_path").alias("c"))
    return G.collect_in_order(rows, ["document_id"], "chunk_index", "c", "all").select("document_id", F.array_join("all", " > ").alias("context"))


@query("segment_rollup", """
    SELECT document_id, min(page_start) AS page_start, max(page_end) AS page_end, min(slide_start) AS slide_start, max(slide_end) AS slide_end,
    CASE WHEN count(DISTINCT section_kind) = 1 THEN min(section_kind) END AS section_kind, bool_or(forced_split) AS forced_split, sum(semantic_unit_count) AS units FROM chunks GROUP BY 1""")
def segment_rollup(spark, d):
    """Positions and kinds of a document's chunks rolled up."""
    return table(spark, d, "chunks").groupBy("document_id").agg(
        F.min("page_start").alias("page_start"), F.max("page_end").alias("page_end"), F.min("slide_start").alias("slide_start"), F.max("slide_end").alias("slide_end"),
        F.when(F.count_distinct("section_kind") == 1, F.min("section_kind")).alias("section_kind"), F.bool_or("forced_split").alias("forced_split"), F.sum("semantic_unit_count").alias("units"),
    )


@query("work_queue", "SELECT attachment_id, coalesce(char_count, 0) AS size FROM (SELECT DISTINCT attachment_id, extraction_status, char_count, effective_url FROM text_index) ORDER BY CASE WHEN extraction_status IN ('ok', 'ok_ocr') THEN 1 ELSE 0 END, coalesce(char_count, 0), effective_url, attachment_id LIMIT 25")
def work_queue(spark, d):
    """The next 25 to work on: pending first, small first."""
    rows = table(spark, d, "text_index").select("attachment_id", "extraction_status", "char_count", "effective_url").distinct()
    done = F.when(F.col("extraction_status").isin("ok", "ok_ocr"), 1).otherwise(0)
    return rows.orderBy(done, F.coalesce("char_count", F.lit(0)), "effective_url", "attachment_id").limit(25).select("attachment_id", F.coalesce("char_count", F.lit(0)).alias("size"))


@query("natural_order", r"""
    WITH n AS (SELECT DISTINCT filename FROM text_index WHERE filename IS NOT NULL)
    SELECT filename, CAST(row_number() OVER (ORDER BY regexp_replace(filename, '\d+', '#', 'g'), list_transform(regexp_extract_all(filename, '\d+'), lambda x: CAST(x AS HUGEINT)), filename) AS VARCHAR) AS k FROM n""")
def natural_order(spark, d):
    """Every file name, whatever letters and figures it has."""
    return numbered_names(table(spark, d, "text_index").filter("filename is not null"))


def numbered_names(rows):
    """(filename, k): distinct names numbered in natural order."""
    shape, figures, _ = G.natural_order(F.col("filename"))
    rows = rows.select("filename").distinct().select("filename", shape.alias("shape"), figures.alias("figures"))
    return G.number_rows(rows, ["shape", "figures", "filename"], "k", "%d").select("filename", "k")


@query("strongest_action", """
    SELECT document_id, action, reason FROM (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY CASE action WHEN 'delete' THEN 3 WHEN 'upsert' THEN 2 WHEN 'unchanged' THEN 1 ELSE 0 END DESC, generated_at, reason) AS k
    FROM corpus_changes) WHERE k = 1""")
def strongest_action(spark, d):
    rows = table(spark, d, "corpus_changes").withColumn("at", F.struct("generated_at", "reason"))
    return G.highest_rank(rows, ["document_id"], "action", {"delete": 3, "upsert": 2, "unchanged": 1}, "at").select("document_id", "action", "reason")


@query("repeated_urls", "SELECT effective_url, count(*) AS n FROM text_index WHERE effective_url IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
def repeated_urls(spark, d):
    return G.duplicate_groups(table(spark, d, "text_index"), "effective_url")


@query("metadata_duplicates", """
    WITH k AS (SELECT attachment_id, CASE WHEN filename <> '' AND char_count IS NOT NULL THEN 'duplicate:' || substring(sha256(lower(filename) || '|' || char_count || '|' || lower(coalesce(parser, ''))), 1, 16) END AS g FROM (SELECT DISTINCT attachment_id, filename, char_count, parser FROM text_index))
    SELECT attachment_id, g AS group_id, count(*) OVER (PARTITION BY g) AS group_size, attachment_id = min(attachment_id) OVER (PARTITION BY g) AS canonical FROM k WHERE g IS NOT NULL""")
def metadata_duplicates(spark, d):
    rows = table(spark, d, "text_index").select("attachment_id", "filename", "char_count", "parser").distinct()
    rows = rows.select("attachment_id", X.duplicate_key(F.col("filename"), F.col("char_count"), F.col("parser")).alias("group_id")).filter("group_id is not null")
    groups = rows.groupBy("group_id").agg(F.count("*").alias("group_size"), F.min("attachment_id").alias("first"))
    return rows.join(groups, "group_id").select("attachment_id", "group_id", "group_size", (F.col("attachment_id") == F.col("first")).alias("canonical"))


@query("alias_union", "SELECT content_sha256, array_to_string(list_sort(list_distinct(flatten(list(url_aliases)))), ' ') AS aliases FROM text_index WHERE content_sha256 IS NOT NULL GROUP BY 1")
def alias_union(spark, d):
    rows = table(spark, d, "text_index").filter("content_sha256 is not null")
    return J.union_of_aliases(rows, ["content_sha256"], "url_aliases", "all").select("content_sha256", F.array_join("all", " ").alias("aliases"))


@query("attachment_chunks", "SELECT t.attachment_id, coalesce(c.n, 0) AS n FROM (SELECT DISTINCT attachment_id, content_sha256 FROM text_index) t LEFT JOIN (SELECT document_id, count(DISTINCT id) AS n FROM chunks GROUP BY 1) c ON c.document_id = 'attachment:' || t.content_sha256")
def attachment_chunks(spark, d):
    """Attachments with the chunks made of them, aggregated before the join."""
    n = table(spark, d, "chunks").groupBy("document_id").agg(F.count_distinct("id").alias("n"))
    rows = table(spark, d, "text_index").select("attachment_id", F.concat(F.lit("attachment:"), "content_sha256").alias("document_id")).distinct()
    return rows.join(n, "document_id", "left").select("attachment_id", F.coalesce("n", F.lit(0)).alias("n"))


@query("documents_of_sources", "SELECT d.doc_id, r.name, coalesce(r.enabled, true) AS enabled FROM documents d LEFT JOIN source_rules r ON d.source = r.id")
def documents_of_sources(spark, d):
    rules = table(spark, d, "source_rules").select(F.col("id").alias("source"), "name", "enabled")
    return table(spark, d, "documents").join(rules, "source", "left").select("doc_id", "name", F.coalesce("enabled", F.lit(True)).alias("enabled"))


@query("enabled_sources", "SELECT id, content_type FROM (SELECT id, unnest(content_types) AS content_type FROM source_rules WHERE coalesce(enabled, true))")
def enabled_sources(spark, d):
    return table(spark, d, "source_rules").filter(F.coalesce("enabled", F.lit(True))).select("id", F.explode("content_types").alias("content_type"))


@query("records_of_disabled_sources", "SELECT DISTINCT document_id FROM chunks WHERE source_id IN (SELECT id FROM source_rules WHERE NOT enabled)")
def records_of_disabled_sources(spark, d):
    off = table(spark, d, "source_rules").filter("not enabled").select(F.col("id").alias("source_id"))
    return J.present(table(spark, d, "chunks"), off, "source_id").select("document_id").distinct()


@query("unregistered_urls", "SELECT DISTINCT url FROM chunks c WHERE url IS NOT NULL AND NOT EXISTS (SELECT 1 FROM text_index t WHERE t.effective_url = c.url)")
def unregistered_urls(spark, d):
    known = table(spark, d, "text_index").select(F.col("effective_url").alias("url"))
    return J.missing(table(spark, d, "chunks").filter("url is not null").select("url").distinct(), known, "url")


@query("merged_candidates", """
    WITH a AS (SELECT effective_url AS url, min(attachment_id) AS candidate FROM text_index WHERE effective_url IS NOT NULL GROUP BY 1), b AS (SELECT url, min(document_id) AS candidate FROM chunks WHERE url IS NOT NULL GROUP BY 1)
    SELECT * FROM a UNION ALL SELECT * FROM b WHERE url NOT IN (SELECT url FROM a)""")
def merged_candidates(spark, d):
    """Registered URLs win over linked ones."""
    one = table(spark, d, "text_index").filter("effective_url is not null").select(F.col("effective_url").alias("url"), F.col("attachment_id").alias("candidate"))
    two = table(spark, d, "chunks").filter("url is not null").select("url", F.col("document_id").alias("candidate"))
    return J.merge_by_precedence([one, two], "url", ["candidate"])


@query("rules_with_fallback", """
    WITH r AS (SELECT id, max(priority) AS priority FROM source_rules GROUP BY 1)
    SELECT t.attachment_id, coalesce(a.priority, b.priority) AS priority FROM (SELECT DISTINCT attachment_id, source_id, split_part(attachment_id, ':', 1) AS own FROM text_index) t LEFT JOIN r a ON t.source_id = a.id LEFT JOIN r b ON t.own = b.id""")
def rules_with_fallback(spark, d):
    rows = table(spark, d, "text_index").select("attachment_id", "source_id", F.substring_index("attachment_id", ":", 1).alias("own")).distinct()
    return J.lookup_with_fallback(rows, table(spark, d, "source_rules"), "source_id", "own", "id", "priority").select("attachment_id", "priority")


@query("alias_lookup", """
    WITH e AS (SELECT DISTINCT attachment_id, unnest(url_aliases) AS url FROM text_index), c AS (SELECT url, min(document_id) AS document_id FROM chunks WHERE url IS NOT NULL GROUP BY 1),
    m AS (SELECT attachment_id, arg_min(document_id, e.url) AS document_id, count(*) AS hits FROM e JOIN c ON e.url = c.url GROUP BY 1)
    SELECT t.attachment_id, m.document_id, coalesce(m.hits, 0) AS hits FROM (SELECT DISTINCT attachment_id FROM text_index) t LEFT JOIN m USING (attachment_id)""")
def alias_lookup(spark, d):
    rows = table(spark, d, "text_index")
    return J.lookup_by_alias(rows, "attachment_id", "url_aliases", table(spark, d, "chunks").filter("url is not null"), "url", "document_id")


@query("set_difference", "SELECT document_id FROM chunks EXCEPT SELECT document_id FROM corpus_changes WHERE action = 'upsert' AND reason = 'content_changed'")
def set_difference(spark, d):
    changed = table(spark, d, "corpus_changes").filter("action = 'upsert' and reason = 'content_changed'")
    return table(spark, d, "chunks").select("document_id").subtract(changed.select("document_id"))


@query("set_union", "SELECT document_id, 'chunks' AS origin FROM chunks UNION ALL SELECT document_id, NULL FROM corpus_state")
def set_union(spark, d):
    return table(spark, d, "chunks").select("document_id", F.lit("chunks").alias("origin")).unionByName(table(spark, d, "corpus_state").select("document_id"), allowMissingColumns=True)


@query("field_hashes", "SELECT DISTINCT id, sha256(coalesce(title, '') || chr(10) || coalesce(url, '') || chr(10) || coalesce(text, '')) AS content_hash FROM chunks")
def field_hashes(spark, d):
    return table(spark, d, "chunks").select("id", X.fields_hash(F.col("title"), F.col("url"), F.col("text")).alias("content_hash")).distinct()


@query("json_hashes", """SELECT DISTINCT attachment_id, sha256('{"ext":"' || extension || '","n":' || coalesce(CAST(section_count AS VARCHAR), 'null') || ',"parser":"' || parser || '"}') AS h FROM text_index WHERE extension IS NOT NULL AND parser IS NOT NULL""")
def json_hashes(spark, d):
    rows = table(spark, d, "text_index").filter("extension is not null and parser is not null")
    return rows.select("attachment_id", X.json_hash(parser=F.col("parser"), n=F.col("section_count"), ext=F.col("extension")).alias("h")).distinct()


@query("json_values", "SELECT event_type, count(*) AS n, sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS total FROM events GROUP BY 1")
def json_values(spark, d):
    k = F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint")
    return table(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.sum(k).alias("total"))


@query("manifest_classes", """
    SELECT attachment_id, CASE WHEN coalesce(effective_url, '') = '' THEN 'missing_url' WHEN linked_from_count > 0 THEN 'linked' WHEN n > 0 THEN 'parent_only' ELSE 'orphan' END AS class
    FROM (SELECT DISTINCT attachment_id, effective_url, linked_from_count, content_sha256 FROM text_index) t LEFT JOIN (SELECT document_id, count(*) AS n FROM corpus_state GROUP BY 1) s ON s.document_id = 'attachment:' || t.content_sha256""")
def manifest_classes(spark, d):
    n = table(spark, d, "corpus_state").groupBy("document_id").agg(F.count("*").alias("n"))
    rows = table(spark, d, "text_index").select("attachment_id", "effective_url", "linked_from_count", F.concat(F.lit("attachment:"), "content_sha256").alias("document_id")).distinct()
    kind = G.first_match((F.coalesce("effective_url", F.lit("")) == "", "missing_url"), (F.col("linked_from_count") > 0, "linked"), (F.col("n") > 0, "parent_only"), otherwise="orphan")
    return rows.join(n, "document_id", "left").select("attachment_id", kind.alias("class"))


@query("eligibility", """
    SELECT DISTINCT attachment_id, CASE WHEN coalesce(extraction_status, '') = '' THEN 'unknown_extraction_status' WHEN extraction_status NOT IN ('ok', 'ok_ocr') THEN extraction_status WHEN content_sha256 IS NULL THEN 'missing_content_sha256'
    WHEN word_count < 10 THEN 'low_text' END AS exclusion FROM text_index""")
def eligibility(spark, d):
    """Why an attachment is left out: the first reason that holds, null if none does."""
    status = F.col("extraction_status")
    reason = F.when(F.coalesce(status, F.lit("")) == "", "unknown_extraction_status").when(~status.isin("ok", "ok_ocr"), status).when(F.col("content_sha256").isNull(), "missing_content_sha256").when(F.col("word_count") < 10, "low_text")
    return table(spark, d, "text_index").select("attachment_id", reason.alias("exclusion")).distinct()


_STEM = r"trim(regexp_replace(regexp_replace(regexp_replace(coalesce(nullif(filename, ''), regexp_extract(effective_url, '([^/]*)/?$', 1)), '(.)\.[^.]*$', '\1'), '[_-]+', ' ', 'g'), '\s+', ' ', 'g'))"


@query("consolidated_attachments", f"""
    WITH t AS (SELECT *, {_STEM} AS stem FROM text_index WHERE content_sha256 IS NOT NULL), s AS (SELECT *, len(regexp_extract_all(stem, '\\S+')) AS n FROM t),
    g AS (SELECT content_sha256, arg_min(attachment_id, (coalesce(source_id, ''), effective_url, attachment_id)) AS primary_id, arg_min(stem, (-n, -length(stem), stem)) AS title, min(extracted_at) AS first_at, max(checked_at) AS last_at, count(DISTINCT attachment_id) AS records FROM s GROUP BY 1),
    a AS (SELECT content_sha256, list_sort(list_distinct(list(u))) AS aliases FROM (SELECT content_sha256, unnest(list_append(coalesce(url_aliases, []), effective_url)) AS u FROM t) WHERE u IS NOT NULL GROUP BY 1)
    SELECT content_sha256, primary_id, title, array_to_string(aliases, ' ') AS aliases, first_at, last_at, records FROM g LEFT JOIN a USING (content_sha256)""")
def consolidated_attachments(spark, d):
    order = [F.coalesce("source_id", F.lit("")), F.col("effective_url"), F.col("attachment_id")]
    out = consolidate(table(spark, d, "text_index"), "content_sha256", order, "attachment_id", "filename", "effective_url", "url_aliases", "extracted_at", "checked_at")
    return out.drop("url").withColumn("aliases", F.array_join("aliases", " "))


@query("status_overlay", """
    WITH r AS (SELECT content_sha256, CASE WHEN word_count < 150 THEN 'exclude' WHEN word_count < 250 THEN 'manual_review' ELSE 'ocr' END AS decision, 'words ' || word_count AS reason FROM text_index WHERE content_sha256 IS NOT NULL),
    m AS (SELECT content_sha256, min((decision, coalesce(reason, ''))) AS x FROM r GROUP BY 1), d AS (SELECT content_sha256, x[1] AS decision, nullif(x[2], '') AS reason FROM m)
    SELECT DISTINCT t.attachment_id, CASE d.decision WHEN 'exclude' THEN 'excluded_from_rag' WHEN 'manual_review' THEN 'manual_review' ELSE t.extraction_status END AS status,
           array_to_string(CASE WHEN d.decision IN ('exclude', 'manual_review') AND d.reason IS NOT NULL AND NOT list_contains(coalesce(t.warnings, []), d.reason) THEN list_append(coalesce(t.warnings, []), d.reason) ELSE coalesce(t.warnings, []) END, ' / ') AS warnings
    FROM text_index t LEFT JOIN d USING (content_sha256)""")
def status_overlay(spark, d):
    """Decisions by content laid over the index; here made up from the word counts."""
    rows = table(spark, d, "text_index")
    w = F.col("word_count")
    decision = F.when(w < 150, "exclude").when(w < 250, "manual_review").otherwise("ocr")
    rules = rows.filter("content_sha256 is not null").select("content_sha256", decision.alias("decision"), F.concat(F.lit("words "), w.cast("string")).alias("reason"))
    out = overlay(rows, rules, "content_sha256", "extraction_status", "warnings", {"exclude": "excluded_from_rag", "manual_review": "manual_review"})
    return out.select("attachment_id", F.col("extraction_status").alias("status"), F.array_join("warnings", " / ").alias("warnings")).distinct()
