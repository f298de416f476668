"""Attachments between pages, queue, index, state and texts; the corpus as a whole."""

from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import url as U
from ..operators import corpus as C
from ..operators import extraction as E
from ..operators import grouping as G
from ..operators import quality as Q
from .catalog import query, table
from .segment_queries import chunk_sql
from .text_queries import language_sql, normal

# chunks name the parents of their attachment and the URLs under which it is known
_EDGES = "SELECT DISTINCT u AS url, p AS page FROM (SELECT unnest(url_aliases) AS u, parent_document_ids AS ps FROM chunks), unnest(ps) AS t(p) WHERE p IS NOT NULL AND u NOT LIKE '%?%'"


@query("attachment_links", f"""
    WITH e AS ({_EDGES}), g AS (SELECT url, string_agg(page, ' ' ORDER BY page) AS pages, count(*) AS n FROM e GROUP BY 1)
    SELECT DISTINCT attachment_id, coalesce(pages, '') AS linked_from, coalesce(n, 0) AS n FROM text_index LEFT JOIN g ON effective_url = g.url""")
def attachment_links(spark, d):
    """Attachments with the pages that name them, by normalised URL (without tracking parameters an alias is its URL)."""
    pages = table(spark, d, "chunks").select("url_aliases", F.explode("parent_document_ids").alias("page")).distinct()
    edges = E.link_edges(pages, "page", "url_aliases", U.normalize_url)
    rows = E.with_links(table(spark, d, "text_index").select("attachment_id", "effective_url").distinct(), edges, "effective_url")
    return rows.select("attachment_id", F.array_join("linked_from", " ").alias("linked_from"), F.size("linked_from").cast("long").alias("n")).distinct()


@query("attachment_parents", r"""
    WITH a AS (SELECT DISTINCT document_id, p, regexp_extract(p, '^web:([^:]+):', 1) AS source_id, nullif(CAST(regexp_extract(p, ':(\d+)$', 1) AS BIGINT), 0) AS parent FROM (SELECT document_id, unnest(parent_document_ids) AS p FROM chunks WHERE document_kind = 'attachment')),
    w AS (SELECT regexp_extract(document_id, '^web:([^:]+):', 1) AS source_id, CAST(nullif(regexp_extract(document_id, ':(\d+)$', 1), '') AS BIGINT) AS parent, min((document_id, url)) AS x FROM chunks WHERE document_kind = 'web' AND url IS NOT NULL GROUP BY 1, 2)
    SELECT document_id, source_id, parent, x[1] AS parent_document_id, x[2] AS parent_url FROM a LEFT JOIN w USING (source_id, parent)""")
def attachment_parents(spark, d):
    chunks = table(spark, d, "chunks")
    source = lambda c: F.regexp_extract(c, "^web:([^:]+):", 1)
    number = lambda c: F.nullif(F.regexp_extract(c, r":(\d+)$", 1), F.lit("")).cast("long")
    own = chunks.filter("document_kind = 'attachment'").select("document_id", F.explode("parent_document_ids").alias("p")).distinct().select("document_id", source("p").alias("source_id"), number("p").alias("parent"))
    pages = chunks.filter("document_kind = 'web' and url is not null").select("document_id", "url", source("document_id").alias("own"), number("document_id").alias("number")).distinct()
    return E.with_parents(own, pages, "source_id", "parent", "own", "number", ["document_id", "url"]).select("document_id", "source_id", "parent", "parent_document_id", "parent_url")


_PRIOR = """
    SELECT DISTINCT t.effective_url, t.content_sha256, t.blob_path, t.extraction_status, s.document_id IS NOT NULL AS in_state, replace(s.document_id, 'attachment:', '') AS prior
    FROM text_index t LEFT JOIN (SELECT url, max(document_id) AS document_id FROM corpus_state WHERE kind = 'attachment' AND url IS NOT NULL GROUP BY 1) s ON s.url = t.effective_url"""


def _with_prior(spark, d):
    index = table(spark, d, "text_index").select("effective_url", "content_sha256", "blob_path", "extraction_status").distinct()
    state = table(spark, d, "corpus_state").filter("kind = 'attachment'").select(F.col("url").alias("effective_url"), "document_id")
    return E.with_prior(index, state, index, "effective_url", ["document_id"], ["extraction_status"])


@query("prior_records", f"SELECT effective_url, in_state, prior, effective_url IS NOT NULL AS in_index FROM ({_PRIOR})")
def prior_records(spark, d):
    """The queue with what the state and the index have under its URLs."""
    return _with_prior(spark, d).select("effective_url", "in_state", F.replace("state_document_id", F.lit("attachment:"), F.lit("")).alias("prior"), "in_index")


@query("download_outcomes", f"""
    SELECT effective_url, CASE WHEN content_sha256 IS NULL THEN 'failed' WHEN prior IS NULL THEN 'new' WHEN content_sha256 = prior AND blob_path IS NOT NULL THEN 'downloaded_unchanged' ELSE 'changed' END AS outcome,
           content_sha256 IS NULL OR (prior IS NOT NULL AND content_sha256 = prior AND blob_path IS NOT NULL) AS carried FROM ({_PRIOR})""")
def download_outcomes(spark, d):
    """What each file of the index is against the state of its URL."""
    rows = _with_prior(spark, d)
    prior = F.replace("state_document_id", F.lit("attachment:"), F.lit(""))
    return E.incremental(rows, F.when(F.col("content_sha256").isNotNull(), 200), F.col("content_sha256"), prior, F.col("blob_path").isNotNull()).select("effective_url", "outcome", "carried")


_TYPES = ["pdf", "docx", "xlsx"]


@query("assembled_queue", """
    WITH t AS (SELECT effective_url AS url, attachment_id AS a, extension, extraction_status AS s, blob_path IS NOT NULL AS readable, parser FROM text_index WHERE effective_url IS NOT NULL),
    c AS (SELECT url, 0 AS r, 'validated' AS rule, a FROM t WHERE s IN ('ok', 'ok_ocr') UNION ALL SELECT url, 1, 'supported_override', a FROM t WHERE readable AND extension IN ('pdf', 'docx', 'xlsx') AND parser IN ('pypdf', 'ooxml')
          UNION ALL SELECT url, 2, 'linked', min(document_id) FROM chunks WHERE document_kind = 'attachment' AND url IS NOT NULL GROUP BY url),
    b AS (SELECT url, min((r, rule, a)) AS x FROM c GROUP BY 1)
    SELECT url, x[2] AS rule, x[3] AS candidate, url IN (SELECT url FROM t WHERE s = 'excluded_from_rag') AS excluded FROM b""")
def assembled_queue(spark, d):
    """Validated files, then readable ones that their checks refused, then linked ones; excluded URLs are taken out last."""
    t = table(spark, d, "text_index").withColumnRenamed("effective_url", "url")
    rows = lambda df: df.select("url", F.col("attachment_id").alias("candidate"))
    refused = t.filter(E.supported_override(F.col("blob_path").isNotNull(), F.col("extension"), F.col("parser"), _TYPES, ["pypdf", "ooxml"]))
    linked = table(spark, d, "chunks").filter("document_kind = 'attachment'").select("url", F.col("document_id").alias("candidate"))
    queue, left = E.assemble_queue([("validated", rows(t.filter(F.col("extraction_status").isin("ok", "ok_ocr")))), ("supported_override", rows(refused)), ("linked", linked)], t.filter("extraction_status = 'excluded_from_rag'"), "url")
    return queue.withColumn("excluded", F.lit(False)).unionByName(left.withColumn("excluded", F.lit(True)))


@query("verified_texts", """
    WITH r AS (SELECT id, text_sha256 AS h FROM chunks UNION SELECT unnest(chunk_ids), unnest(chunk_text_sha256) FROM corpus_state), c AS (SELECT DISTINCT id, sha256(text) AS h FROM chunks WHERE text IS NOT NULL)
    SELECT DISTINCT r.id, CASE WHEN c.h IS NULL THEN 'missing_text' ELSE 'text_hash_mismatch' END AS issue_type FROM r LEFT JOIN c USING (id) WHERE c.h IS DISTINCT FROM r.h""")
def verified_texts(spark, d):
    """The hashes that chunks and state give of texts, held against the stored texts."""
    chunks = table(spark, d, "chunks")
    pairs = F.explode(F.arrays_zip("chunk_ids", "chunk_text_sha256")).alias("p")
    of_state = table(spark, d, "corpus_state").select(pairs).select(F.col("p.chunk_ids").alias("id"), F.col("p.chunk_text_sha256").alias("stated"))
    return E.verify_texts(of_state.union(chunks.select("id", "text_sha256")), chunks.filter("text is not null"), "id", "stated", "text")


@query("repeated_positions", """
    WITH n AS (SELECT effective_url, row_number() OVER (ORDER BY queue_id, attachment_id, effective_url) AS pos FROM text_index WHERE queue_id IS NOT NULL)
    SELECT effective_url, string_agg(CAST(pos AS VARCHAR), ' ' ORDER BY pos) AS positions FROM n WHERE effective_url IS NOT NULL GROUP BY 1 HAVING count(*) > 1""")
def repeated_positions(spark, d):
    """URLs that the index lists more than once, and where."""
    rows = table(spark, d, "text_index").filter("queue_id is not null")
    found = E.repeated_positions(rows, "effective_url", ["queue_id", "attachment_id", "effective_url"])
    return found.select("effective_url", F.array_join(F.transform("positions", lambda x: x.cast("string")), " ").alias("positions"))


@query("consolidated_decisions", """
    WITH r AS (SELECT document_id, action, reason, CASE action WHEN 'delete' THEN 3 WHEN 'upsert' THEN 2 WHEN 'unchanged' THEN 1 ELSE 0 END AS r, epoch(received_at) AS p FROM corpus_changes)
    SELECT document_id, arg_max(action, (r, -CAST(floor(p) AS BIGINT), action)) AS decision, array_to_string(list_sort(list_distinct(list(reason))), ' ') AS reasons FROM r GROUP BY 1""")
def consolidated_decisions(spark, d):
    rows = table(spark, d, "corpus_changes").withColumn("at", F.unix_seconds(F.col("received_at").cast("timestamp")))
    found = E.consolidate_rules(rows, "document_id", "action", "reason", {"delete": 3, "upsert": 2, "unchanged": 1}, "at")
    return found.select("document_id", "decision", F.array_join("reasons", " ").alias("reasons"))


_NONE = "(SELECT count(*) = 0 FROM ({}))".format
_Q, _I, _S = "SELECT document_id FROM chunks WHERE document_kind = 'attachment'", "SELECT 'attachment:' || content_sha256 FROM text_index WHERE content_sha256 IS NOT NULL", "SELECT document_id FROM corpus_state WHERE kind = 'attachment'"
_CONDITIONS = {
    "index_has_queue": _NONE(f"({_Q}) EXCEPT ({_I})"), "state_has_queue": _NONE(f"({_Q}) EXCEPT ({_S})"), "queue_has_index": _NONE(f"({_I}) EXCEPT ({_Q})"), "queue_has_state": _NONE(f"({_S}) EXCEPT ({_Q})"),
    "unique_queue_ids": _NONE("SELECT queue_id FROM text_index GROUP BY 1 HAVING count(*) > 1"), "unique_index_urls": _NONE("SELECT effective_url FROM text_index GROUP BY 1 HAVING count(*) > 1"),
    "unique_state_ids": _NONE("SELECT document_id FROM corpus_state GROUP BY 1 HAVING count(*) > 1"), "all_have_urls": _NONE("SELECT 1 FROM text_index WHERE effective_url IS NULL"),
    "all_have_contents": _NONE("SELECT 1 FROM text_index WHERE content_sha256 IS NULL"), "all_have_statuses": _NONE("SELECT 1 FROM text_index WHERE extraction_status IS NULL"),
    "all_have_texts": _NONE("SELECT 1 FROM text_index WHERE extraction_status IN ('ok', 'ok_ocr') AND blob_path IS NULL"), "none_is_short": _NONE("SELECT 1 FROM text_index WHERE extraction_status IN ('ok', 'ok_ocr') AND word_count < 10"),
}


@query("complete_run", f"SELECT {', '.join(f'{c} AS {n}' for n, c in _CONDITIONS.items())}, {' AND '.join(_CONDITIONS.values())} AS complete")
def complete_run(spark, d):
    """Twelve conditions under which a run is complete, and whether all hold."""
    index, state = table(spark, d, "text_index"), table(spark, d, "corpus_state")
    sides = {
        "queue": table(spark, d, "chunks").filter("document_kind = 'attachment'").select("document_id"), "state": state.filter("kind = 'attachment'").select("document_id"),
        "index": index.filter("content_sha256 is not null").select(F.concat(F.lit("attachment:"), "content_sha256").alias("document_id")),
    }
    empty = lambda df: df.agg((F.count("*") == 0).alias("ok"))
    without = lambda a, b: empty(sides[a].join(sides[b], "document_id", "left_anti"))
    twice = lambda df, c: empty(df.groupBy(c).agg(F.count("*").alias("n")).filter("n > 1"))
    usable = "extraction_status in ('ok', 'ok_ocr')"
    return E.all_hold({
        "index_has_queue": without("queue", "index"), "state_has_queue": without("queue", "state"), "queue_has_index": without("index", "queue"), "queue_has_state": without("state", "queue"),
        "unique_queue_ids": twice(index, "queue_id"), "unique_index_urls": twice(index, "effective_url"), "unique_state_ids": twice(state, "document_id"),
        "all_have_urls": empty(index.filter("effective_url is null")), "all_have_contents": empty(index.filter("content_sha256 is null")), "all_have_statuses": empty(index.filter("extraction_status is null")),
        "all_have_texts": empty(index.filter(f"{usable} and blob_path is null")), "none_is_short": empty(index.filter(f"{usable} and word_count < 10")),
    })


_RECORDS = rf"""
    WITH n AS (SELECT 'web:' || doc_id AS document_id, {normal('text')} AS body, lang, url, source FROM documents), w AS (SELECT *, len(regexp_extract_all(body, '\S+')) AS words FROM n)
    SELECT document_id, body, words, url, source, coalesce(nullif(lang, ''), {language_sql('body')}) AS language, sha256(body) AS content_sha256 FROM w WHERE words >= 10"""


def _records(spark, d):
    rows = table(spark, d, "documents").select(F.concat(F.lit("web:"), "doc_id").alias("id"), "text", "lang", "url", "source")
    return C.records(rows, "id", "text", language_col="lang", metadata={"source": "source", "url": "url"})


@query("web_records", f"""
    SELECT document_id, words AS word_count, language, content_sha256, sha256('{{"source":' || coalesce('"' || source || '"', 'null') || ',"title":null,"url":' || coalesce('"' || url || '"', 'null') || '}}') AS metadata_sha256 FROM ({_RECORDS})""")
def web_records(spark, d):
    return _records(spark, d)[0].select("document_id", F.col("word_count").cast("long").alias("word_count"), "language", "content_sha256", "metadata_sha256")


@query("excluded_records", f"SELECT DISTINCT 'web:' || doc_id AS document_id, CASE WHEN coalesce({normal('text')}, '') = '' THEN 'missing_text' ELSE 'low_text' END AS reason FROM documents WHERE ('web:' || doc_id) NOT IN (SELECT document_id FROM ({_RECORDS}))")
def excluded_records(spark, d):
    return _records(spark, d)[1]


_KEPT = f"SELECT min(document_id) AS doc, 'Bez tytułu' AS title, arg_min(language, document_id) AS lang, 1 AS sec, NULL::VARCHAR AS sid, NULL::VARCHAR AS label, NULL::VARCHAR AS kind, NULL::INTEGER AS page, NULL::INTEGER AS slide, NULL::VARCHAR AS sheet, arg_min(body, document_id) AS text FROM ({_RECORDS}) GROUP BY content_sha256"
_BUILT = chunk_sql(_KEPT, 350)


@query("corpus_status", f"""
    SELECT 'documents_by_language' AS metric, coalesce(lang, 'unknown') AS key, count(*) AS n FROM ({_KEPT}) GROUP BY 2 UNION ALL SELECT 'chunks_by_language', coalesce(language, 'unknown'), count(*) FROM ({_BUILT}) GROUP BY 2
    UNION ALL SELECT 'changes_by_action', 'new', count(DISTINCT split_part(id, ':chunk:', 1)) FROM ({_BUILT})""")
def corpus_status(spark, d):
    """The counts of a first whole build: records, one per content, chunks, changes."""
    return C.build_corpus(_records(spark, d)[0])["status"]


@query("built_state", f"SELECT split_part(id, ':chunk:', 1) AS document_id, count(*) AS chunk_count, md5(string_agg(text_sha256, '' ORDER BY chunk_number)) AS h FROM ({_BUILT}) GROUP BY 1")
def built_state(spark, d):
    state = C.build_corpus(_records(spark, d)[0])["state"]
    return state.select("document_id", F.col("chunk_count").cast("long").alias("chunk_count"), F.md5(F.array_join("chunk_text_sha256", "")).alias("h"))


@query("selected_queue", """
    SELECT DISTINCT attachment_id, source_id, extension FROM text_index t WHERE source_id IN (SELECT id FROM source_rules WHERE coalesce(enabled, true)) AND extension IN ('pdf', 'docx')
    AND NOT EXISTS (SELECT 1 FROM corpus_state s WHERE s.url = t.effective_url AND s.chunk_count > 2)""")
def selected_queue(spark, d):
    """Files of enabled sources and wanted extensions that are still pending (here: without a text of three chunks or more)."""
    on = table(spark, d, "source_rules").filter(F.coalesce("enabled", F.lit(True))).select(F.col("id").alias("source_id"))
    done = table(spark, d, "corpus_state").filter("chunk_count > 2").select(F.col("url").alias("effective_url"))
    return G.select_queue(table(spark, d, "text_index"), on, ["pdf", "docx"], done).select("attachment_id", "source_id", "extension").distinct()


@query("titles_by_tier", r"""
    WITH c AS (SELECT document_id, title, 0 AS tier, min(chunk_index) AS p FROM chunks WHERE document_kind = 'attachment' AND trim(title) <> '' GROUP BY 1, 2
      UNION ALL SELECT 'attachment:' || content_sha256, trim(regexp_replace(regexp_replace(regexp_replace(filename, '(.)\.[^.]*$', '\1'), '[_-]+', ' ', 'g'), '\s+', ' ', 'g')), 1, 0 FROM text_index WHERE content_sha256 IS NOT NULL AND filename IS NOT NULL)
    SELECT document_id, title FROM (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY tier, len(regexp_extract_all(title, '[^\s\x{a0}]+')) DESC, length(title) DESC, p, title) AS k FROM c) WHERE k = 1""")
def titles_by_tier(spark, d):
    """Titles of the file's own metadata before those of its name."""
    own = table(spark, d, "chunks").filter("document_kind = 'attachment' and trim(title) != ''").groupBy("document_id", "title").agg(F.min("chunk_index").alias("p")).withColumn("tier", F.lit(0))
    names = table(spark, d, "text_index").filter("content_sha256 is not null and filename is not null")
    stems = names.select(F.concat(F.lit("attachment:"), "content_sha256").alias("document_id"), T.stem_title(F.col("filename")).alias("title"), F.lit(0).alias("p"), F.lit(1).alias("tier"))
    order = [F.asc("tier"), T.word_count(F.col("title")).desc(), F.length("title").desc(), F.asc("p"), F.asc("title")]
    return G.top_per_group(own.unionByName(stems), ["document_id"], order).select("document_id", "title")


@query("merged_records", """
    WITH l AS (SELECT document_id, min(title) AS title, min(published_at) AS published_at FROM chunks GROUP BY 1), r AS (SELECT document_id, min(CASE WHEN chunk_count > 1 THEN url END) AS title, min(kind) AS kind FROM corpus_state WHERE kind = 'attachment' GROUP BY 1)
    SELECT l.document_id, CASE WHEN r.document_id IS NULL THEN l.title ELSE r.title END AS title, l.published_at, r.kind FROM l LEFT JOIN r USING (document_id)""")
def merged_records(spark, d):
    """Records laid over by others, whose nulls win too."""
    left = table(spark, d, "chunks").groupBy("document_id").agg(F.min("title").alias("title"), F.min("published_at").alias("published_at"))
    right = table(spark, d, "corpus_state").filter("kind = 'attachment'").groupBy("document_id").agg(F.min(F.when(F.col("chunk_count") > 1, F.col("url"))).alias("title"), F.min("kind").alias("kind"))
    return E.merge_right(left, right, "document_id")


@query("sorted_counts", "SELECT source_id, '{' || string_agg('\"' || k || '\":' || n, ',' ORDER BY k) || '}' AS counts FROM (SELECT source_id, coalesce(language, 'unknown') AS k, count(*) AS n FROM chunks WHERE source_id IS NOT NULL GROUP BY 1, 2) GROUP BY 1")
def sorted_counts(spark, d):
    """Counts by language of each source as JSON with sorted keys."""
    n = table(spark, d, "chunks").filter("source_id is not null").groupBy("source_id", F.coalesce("language", F.lit("unknown")).alias("k")).agg(F.count("*").alias("n"))
    maps = n.groupBy("source_id").agg(F.map_from_entries(F.collect_list(F.struct("k", "n"))).alias("m"))
    return maps.select("source_id", F.to_json(E.sorted_map(F.col("m"))).alias("counts"))


@query("wrong_types", """
    SELECT DISTINCT id, field FROM (SELECT id, unnest(['context_path', 'url_aliases', 'language']) AS field, unnest([false, false, language IS NOT NULL AND language <> '']) AS wrong FROM chunks) WHERE wrong""")
def wrong_types(spark, d):
    """Fields of chunk records that aren't the lists that they are said to be; a language never is."""
    lines = table(spark, d, "chunks").select("id", F.to_json(F.struct("context_path", "url_aliases", "language")).alias("value"))
    return Q.wrong_types(lines, "value", {"context_path": "ARRAY", "url_aliases": "ARRAY", "language": "ARRAY"}, ["id"]).distinct()
