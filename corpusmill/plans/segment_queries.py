"""Segmentation of documents."""

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import segments as S
from ..operators.grouping import delivered_once
from .catalog import query, table
from .text_queries import LIST_SQL, heading_sql, held, language_sql, normal


@query("fixed_word_blocks", r"""
    WITH w AS (SELECT doc_id, regexp_extract_all(text, '[^\s\x{a0}]+') AS w FROM documents WHERE text IS NOT NULL),
    b AS (SELECT doc_id, w, unnest(range(0, len(w), 100)) AS i FROM w)
    SELECT doc_id, CAST(i / 100 AS BIGINT) AS block, md5(array_to_string(w[i + 1:i + 100], ' ')) AS h FROM b""")
def fixed_word_blocks(spark, d):
    words = F.regexp_extract_all("text", F.lit(r"(?U)(\S+)"), F.lit(1))
    rows = table(spark, d, "documents").filter("text is not null").select("doc_id", F.posexplode(S.fixed_word_blocks(words, 100)).alias("block", "b"))
    return rows.select("doc_id", "block", F.md5("b").alias("h"))


def chunk_sql(source: str, target: int, flatten: bool = True) -> str:
    """SQL for chunks of ``source(doc, title, lang, sec, sid, label, kind, page, slide, sheet, text)``, a row per section of a document.

    Each fold is a recursive query; list items are told from a window: a line belongs to an item if the last line that begins one
    comes after the last line that ends one.
    """
    hard, enough = S.hard_limit(target), max(45, target // 4)
    words = r"regexp_extract_all({}, '[^\s\x{{a0}}]+')".format
    mark = lambda pattern: "string_split(regexp_replace({}, '" + pattern + r"', '\1' || chr(1) || '\2', 'g'), chr(1))"
    sentence = lambda c: f"list_filter(list_transform({mark(T.SENTENCE_BREAK_PAIR).format(held(c))}, lambda s: trim(replace(s, chr(9247), '.'))), lambda s: s <> '')"
    clause = lambda c: f"list_filter(string_split(regexp_replace({c}, '([;:])\\s+', '\\1' || chr(1), 'g'), chr(1)), lambda s: s <> '')"
    in_order = lambda value, where, order="o": f"(SELECT array_to_string(list(v ORDER BY k), '|') FROM (SELECT {value} AS v, min({order}) AS k FROM packed p WHERE p.doc = c.doc AND p.merged = c.merged AND {value} <> '' AND {where} GROUP BY 1))"
    return rf"""
    WITH RECURSIVE src AS ({source}),
    par AS (SELECT doc, sec, generate_subscripts(string_split(body, chr(10) || chr(10)), 1) AS p, unnest(string_split(body, chr(10) || chr(10))) AS par FROM (SELECT doc, sec, {normal('text')} AS body FROM src)),
    w0 AS (SELECT doc, sec, p, par, {words('par')} AS w FROM par),
    w1 AS (SELECT *, CASE WHEN len(w) >= 30 THEN list_filter(range(8, least(120, len(w) // 3) + 1), lambda b: CASE WHEN w[1] = w[b + 1] AND w[1] = w[2 * b + 1] THEN w[1:b] = w[b + 1:2 * b] AND w[1:b] = w[2 * b + 1:3 * b] ELSE false END)[1] END AS b FROM w0),
    w2 AS (SELECT doc, sec, p, par, w AS was, CASE WHEN b IS NULL THEN w ELSE w[1:b] || w[list_filter(range(1, len(w) // b + 1), lambda k: w[k * b + 1:(k + 1) * b] <> w[1:b])[1] * b + 1:] END AS w FROM w1),
    runs AS (SELECT doc, sec, p, w, b, unnest(list_filter(range(1, len(w) - 4 * b + 2), lambda i: CASE WHEN w[i] = w[i + b] AND w[i] = w[i + 2 * b] THEN w[i:i + 3 * b - 1] = w[i + b:i + 4 * b - 1] ELSE false END)) AS i
             FROM (SELECT *, unnest(range(2, least(24, len(w) // 4) + 1)) AS b FROM w2 WHERE len(w) >= 16 AND len(list_distinct(w)) <= len(w) - 6)),
    longest AS (SELECT doc, sec, p, i, max(b) AS b, arg_max(w, b) AS w FROM runs GROUP BY ALL),
    spans AS (SELECT doc, sec, p, list({{'i': i, 'b': b, 'to': i + b * list_filter(range(1, len(w) // b + 2), lambda k: w[i + k * b:i + (k + 1) * b - 1] <> w[i:i + b - 1])[1]}} ORDER BY i) AS s FROM longest GROUP BY ALL),
    walk(doc, sec, p, s, cur, gone) AS (
        SELECT doc, sec, p, s, s[1], [[s[1].i + s[1].b, s[1].to]] FROM spans
        UNION ALL SELECT doc, sec, p, s, n, gone || [[n.i + n.b, n.to]] FROM (SELECT *, list_filter(s, lambda x: x.i >= cur.to)[1] AS n FROM walk) WHERE n IS NOT NULL),
    gone AS (SELECT doc, sec, p, arg_max(gone, len(gone)) AS gone FROM walk GROUP BY ALL),
    w3 AS (SELECT doc, sec, p, par, was, CASE WHEN gone IS NULL THEN w ELSE list_filter(w, lambda x, i: len(list_filter(gone, lambda g: i >= g[1] AND i < g[2])) = 0) END AS w FROM w2 LEFT JOIN gone USING (doc, sec, p)),
    slim AS (SELECT doc, sec, p, CASE WHEN {'len(was) >= 16 OR ' if flatten else ''}w <> was THEN array_to_string(w, ' ') ELSE par END AS par FROM w3),
    line AS (SELECT doc, sec, p, generate_subscripts(string_split(par, chr(10)), 1) AS n, unnest(string_split(par, chr(10))) AS line FROM slim WHERE par <> ''),
    own AS (SELECT *, CASE WHEN {heading_sql('line')} THEN 'heading' WHEN regexp_matches(line, '{LIST_SQL}') THEN 'item' ELSE 'text' END AS own, lag(line) OVER (PARTITION BY doc, sec, p ORDER BY n) AS above FROM line),
    breaks AS (SELECT *, own = 'heading' OR (own = 'text' AND NOT (regexp_matches(line, '^\p{{Ll}}') OR NOT regexp_matches(above, '[.!?…:]$'))) AS ends FROM own),
    told AS (SELECT *, CASE WHEN own = 'heading' THEN own WHEN own = 'item' OR coalesce(max(CASE WHEN own = 'item' THEN n END) OVER w > coalesce(max(CASE WHEN ends THEN n END) OVER w, 0), false) THEN 'list' ELSE 'paragraph' END AS kind FROM breaks
             WINDOW w AS (PARTITION BY doc, sec, p ORDER BY n ROWS UNBOUNDED PRECEDING)),
    starts AS (SELECT *, CASE WHEN kind = 'heading' OR kind IS DISTINCT FROM lag(kind) OVER (PARTITION BY doc, sec, p ORDER BY n) THEN 1 ELSE 0 END AS opens FROM told),
    numbered AS (SELECT *, sum(opens) OVER (PARTITION BY doc, sec, p ORDER BY n ROWS UNBOUNDED PRECEDING) AS u FROM starts),
    unit AS (SELECT doc, sec, p, u, any_value(kind) AS kind, string_agg(CASE WHEN opens = 1 THEN '' WHEN own = 'item' THEN chr(10) ELSE ' ' END || line, '' ORDER BY n) AS text FROM numbered GROUP BY ALL),
    lone AS (SELECT doc, sec, p, {sentence('text')} AS parts FROM (SELECT *, count(*) OVER (PARTITION BY doc, sec, p) AS k FROM unit) WHERE k = 1 AND kind = 'paragraph' AND len({words('text')}) > 180),
    units AS (SELECT doc, sec, p, u, 0 AS s, kind, text FROM unit WHERE (doc, sec, p) NOT IN (SELECT (doc, sec, p) FROM lone WHERE len(parts) > 1)
              UNION ALL SELECT doc, sec, p, 1, generate_subscripts(parts, 1), 'sentence_group', unnest(parts) FROM lone WHERE len(parts) > 1),
    sized AS (SELECT *, len({words('text')}) AS words, array_to_string({words('lower(text)')}, ' ') AS key, row_number() OVER (PARTITION BY doc ORDER BY sec, p, u, s) AS o FROM units),
    firsts AS (SELECT * FROM sized QUALIFY words < 18 OR row_number() OVER (PARTITION BY doc, key ORDER BY o) = 1),
    kept AS (SELECT * FROM firsts QUALIFY key IS DISTINCT FROM lag(key) OVER (PARTITION BY doc ORDER BY o)),
    big AS (SELECT doc, o, CASE WHEN len({sentence('text')}) >= 2 THEN {sentence('text')} ELSE {clause('text')} END AS parts FROM kept WHERE words > {hard}),
    part AS (SELECT doc, o, row_number() OVER (PARTITION BY doc, o ORDER BY k, f) AS k, array_to_string(w[f:f + {hard - 1}], ' ') AS joined, part, len(w[f:f + {hard - 1}]) AS words, len(w) > {hard} AS alone
             FROM (SELECT doc, o, k, part, w, unnest(range(1, len(w) + 1, {hard})) AS f FROM (SELECT doc, o, k, part, {words('part')} AS w FROM (SELECT doc, o, generate_subscripts(parts, 1) AS k, unnest(parts) AS part FROM big)))),
    fold(doc, o, k, g, size, alone) AS (SELECT doc, o, k, 1, words, alone FROM part WHERE k = 1
        UNION ALL SELECT x.doc, x.o, x.k, CASE WHEN x.alone OR f.alone OR f.size + x.words > {hard} THEN g + 1 ELSE g END, CASE WHEN x.alone OR f.alone OR f.size + x.words > {hard} THEN x.words ELSE f.size + x.words END, x.alone
        FROM fold f JOIN part x ON x.doc = f.doc AND x.o = f.o AND x.k = f.k + 1),
    cuts AS (SELECT doc, o, g, string_agg(CASE WHEN part.alone THEN joined ELSE part END, ' ' ORDER BY k) AS text, sum(words) AS words FROM fold JOIN part USING (doc, o, k) GROUP BY ALL),
    ready AS (SELECT doc, sec, kind AS uk, text, words, o, 0 AS g, false AS forced FROM kept WHERE words <= {hard}
              UNION ALL SELECT c.doc, k.sec, k.kind, c.text, c.words, c.o, c.g, true FROM cuts c JOIN kept k USING (doc, o)),
    placed AS (SELECT r.* EXCLUDE (o, g), src.* EXCLUDE (doc, sec, text), row_number() OVER (PARTITION BY r.doc ORDER BY o, g) AS o FROM ready r JOIN src USING (doc, sec)),
    pack(doc, o, seg, held) AS (SELECT doc, o, 1, words FROM placed WHERE o = 1
        UNION ALL SELECT doc, o, seg + CASE WHEN new_ THEN 1 ELSE 0 END, CASE WHEN new_ THEN words ELSE held + words END FROM (
            SELECT x.doc, x.o, x.words, seg, held, (coalesce(uk = 'heading' OR kind IN ('slide', 'sheet'), false) AND held >= {enough}) OR held + x.words > {hard} OR (held >= {target} AND uk NOT IN ('list', 'sentence_group')) AS new_
            FROM pack JOIN placed x ON x.doc = pack.doc AND x.o = pack.o + 1)),
    tails AS (SELECT doc, max(seg) AS last FROM (SELECT doc, seg, sum(words) AS n, max(seg) OVER (PARTITION BY doc) AS top FROM pack JOIN placed USING (doc, o) GROUP BY doc, seg) GROUP BY doc
              HAVING max(seg) > 1 AND max(CASE WHEN seg = top THEN n END) < 35 AND sum(CASE WHEN seg >= top - 1 THEN n END) <= {hard}),
    packed AS (SELECT placed.*, seg, CASE WHEN seg = last THEN seg - 1 ELSE seg END AS merged FROM pack JOIN placed USING (doc, o) LEFT JOIN tails USING (doc)),
    chunk AS (SELECT doc, merged, any_value(title) AS title, any_value(lang) AS lang, string_agg(text, chr(10) || chr(10) ORDER BY o) AS text, sum(words) AS words, count(*) AS unit_count, bool_or(forced) AS forced,
                     min(page) AS page_start, max(page) AS page_end, min(slide) AS slide_start, max(slide) AS slide_end, CASE WHEN count(DISTINCT CASE WHEN seg = merged THEN kind END) = 1 THEN max(CASE WHEN seg = merged THEN kind END) END AS section_kind
              FROM packed GROUP BY doc, merged HAVING sum(words) >= 5),
    said AS (SELECT doc, merged, array_to_string(list(v ORDER BY k), '|') AS context, array_to_string(list(v ORDER BY k), ' > ') AS path FROM (
                 SELECT doc, merged, v, min((seg, part, o)) AS k FROM (SELECT doc, merged, seg, o, 0 AS part, label AS v FROM packed WHERE label <> '' AND NOT regexp_matches(label, '{T.GENERIC_LABEL}')
                 UNION ALL SELECT doc, merged, seg, o, 1, text FROM packed WHERE uk = 'heading') GROUP BY ALL) GROUP BY ALL),
    out AS (SELECT c.*, coalesce(context, '') AS context, path, coalesce({in_order('sid', 'true')}, '') AS section_ids, coalesce({in_order('label', 'true')}, '') AS section_labels, coalesce({in_order('sheet', 'true')}, '') AS sheets,
                   coalesce({in_order('uk', 'true')}, '') AS kinds, row_number() OVER (PARTITION BY c.doc ORDER BY c.merged) AS number, count(*) OVER (PARTITION BY c.doc) AS chunk_count FROM chunk c LEFT JOIN said USING (doc, merged)),
    spoken AS (SELECT *, {language_sql('text')} AS own_language FROM out)
    SELECT doc || ':chunk:' || printf('%04d', number) AS id, CAST(number AS INTEGER) AS chunk_number, CAST(chunk_count AS INTEGER) AS chunk_count, sha256(text) AS text_sha256, CAST(words AS INTEGER) AS word_count,
           CAST(length(text) AS INTEGER) AS char_count, md5(concat_ws(chr(10) || chr(10), title, path, text)) AS embedding_md5, context AS context_path, kinds AS unit_kinds, CAST(unit_count AS INTEGER) AS semantic_unit_count, forced AS forced_split,
           section_ids, section_labels, section_kind, page_start, page_end, slide_start, slide_end, sheets AS sheet_names, coalesce(nullif(lang, ''), own_language) AS language
    FROM spoken"""


def _shown(chunks):
    """What the SQL gives of chunks: arrays as strings, the embedding text by its hash."""
    joined = [F.array_join(c, "|").alias(c) for c in ("context_path", "unit_kinds", "section_ids", "section_labels", "sheet_names")]
    plain = ("id", "chunk_number", "chunk_count", "text_sha256", "word_count", "char_count", "semantic_unit_count", "forced_split", "section_kind", "page_start", "page_end", "slide_start", "slide_end", "language")
    return chunks.select(*plain, *joined, F.md5("embedding_text").alias("embedding_md5"))


_NO_SECTION = "1 AS sec, NULL::VARCHAR AS sid, NULL::VARCHAR AS label, NULL::VARCHAR AS kind, NULL::INTEGER AS page, NULL::INTEGER AS slide, NULL::VARCHAR AS sheet"
_DOCUMENTS = f"SELECT DISTINCT 'web:' || doc_id AS doc, NULL::VARCHAR AS title, NULL::VARCHAR AS lang, {_NO_SECTION}, text FROM documents WHERE text IS NOT NULL"
_CHUNKS = f"SELECT DISTINCT id AS doc, title, NULL::VARCHAR AS lang, {_NO_SECTION}, text FROM chunks WHERE text IS NOT NULL"
_SECTIONS = """
    SELECT document_id AS doc, min(title) OVER (PARTITION BY document_id) AS title, NULL::VARCHAR AS lang, chunk_index AS sec, section_ids[1] AS sid, section_labels[1] AS label, section_kind AS kind,
           page_start AS page, slide_start AS slide, sheet_names[1] AS sheet, text FROM chunks WHERE text IS NOT NULL QUALIFY row_number() OVER (PARTITION BY document_id, chunk_index ORDER BY id, text) = 1"""


@query("chunks_of_documents", chunk_sql(_DOCUMENTS, 350))
def chunks_of_documents(spark, d):
    """All documents cut into structure-aware chunks."""
    rows = table(spark, d, "documents").select(F.concat(F.lit("web:"), "doc_id").alias("id"), "text")
    return _shown(S.chunk_documents(rows, "id", "text"))


@query("chunks_keeping_lines", chunk_sql(_DOCUMENTS, 350, flatten=False))
def chunks_keeping_lines(spark, d):
    """As chunks_of_documents, with lines kept in long paragraphs."""
    rows = table(spark, d, "documents").select(F.concat(F.lit("web:"), "doc_id").alias("id"), "text")
    return _shown(S.chunk_documents(rows, "id", "text", flatten=False))


@query("rechunked_chunks", chunk_sql(_CHUNKS, 120))
def rechunked_chunks(spark, d):
    rows = table(spark, d, "chunks").select("id", "title", "text")
    return _shown(S.chunk_documents(rows, "id", "text", "title", target_words=120))


@query("chunks_of_sections", chunk_sql(_SECTIONS, 350))
def chunks_of_sections(spark, d):
    """Documents put together from the sections (pages, slides, sheets) that their chunks came from, and chunked anew."""
    rows = table(spark, d, "chunks").filter("text is not null and document_id is not null")
    first = F.min(F.struct("id", "text", F.get("section_ids", F.lit(0)).alias("section_id"), F.get("section_labels", F.lit(0)).alias("label"), "section_kind", "page_start", "slide_start", F.get("sheet_names", F.lit(0)).alias("sheet_name")))
    one = rows.groupBy("document_id", "chunk_index").agg(first.alias("f"), F.min("title").alias("title"))
    section = F.struct("chunk_index", "f.section_id", "f.label", F.col("f.section_kind").alias("kind"), F.col("f.page_start").alias("page_number"), F.col("f.slide_start").alias("slide_number"), "f.sheet_name", "f.text")
    docs = one.groupBy("document_id").agg(F.min("title").alias("title"), F.array_sort(F.collect_list(section)).alias("sections"))
    return _shown(S.chunk_documents(docs.withColumn("text", F.lit(None).cast("string")), "document_id", "text", "title", sections_col="sections"))


def packed_sentences(rows):
    """(doc_id, segments): greedy packing of each text's sentences into segments of 60 words at most, as a fold inside the JVM."""
    sizes = F.filter(F.transform(F.split("text", T.SENTENCE_BREAK), lambda s: T.word_count(s)), lambda n: n > 0)
    start = F.struct(F.lit(0).alias("seg"), F.lit(1 << 20).alias("size"))
    step = lambda a, n: F.when(a["size"] + n > 60, F.struct((a["seg"] + 1).alias("seg"), n.alias("size"))).otherwise(F.struct(a["seg"].alias("seg"), (a["size"] + n).alias("size")))
    return rows.select("doc_id", F.aggregate(sizes, start, step, lambda a: a["seg"]).cast("long").alias("segments")).filter("segments > 0")


@query("sentence_packing", r"""
    WITH RECURSIVE h AS (SELECT DISTINCT doc_id, text FROM documents WHERE text IS NOT NULL),
    p AS (SELECT doc_id, list_filter(list_transform(string_split(regexp_replace(text, '([.!?…])\s+([A-ZĄĆĘŁŃÓŚŹŻ0-9„"(§])', '\1' || chr(1) || '\2', 'g'), chr(1)), lambda s: len(regexp_extract_all(s, '[^\s\x{a0}]+'))), lambda n: n > 0) AS n FROM h),
    g(doc_id, n, i, seg, size) AS (SELECT doc_id, n, 1, 1, n[1] FROM p WHERE len(n) > 0
      UNION ALL SELECT doc_id, n, i + 1, CASE WHEN size + n[i + 1] > 60 THEN seg + 1 ELSE seg END, CASE WHEN size + n[i + 1] > 60 THEN n[i + 1] ELSE size + n[i + 1] END FROM g WHERE i < len(n))
    SELECT doc_id, CAST(max(seg) AS BIGINT) AS segments FROM g GROUP BY doc_id""")
def sentence_packing(spark, d):
    """Every document with a text, whatever its length."""
    return packed_sentences(delivered_once(table(spark, d, "documents").select("doc_id", "text").filter("text is not null"), "doc_id"))
