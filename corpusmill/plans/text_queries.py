"""Text functions over documents and chunks."""

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators.grouping import delivered_once
from .catalog import query, table

_NORMAL = r"""regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace({c}, '\r\n|\r', chr(10), 'g'), '[ \t]+', ' ', 'g'),
 '[ \x{{a0}}]*\n[ \x{{a0}}]*', chr(10), 'g'), '\n{{3,}}', chr(10) || chr(10), 'g'), '^[\n \x{{a0}}]+', ''), '[\n \x{{a0}}]+$', '')"""


def normal(c: str) -> str:
    return _NORMAL.format(c=c)


@query("corpus_documents", f"""
    WITH n AS (SELECT *, {normal('text')} AS body FROM documents WHERE text IS NOT NULL),
    w AS (SELECT *, len(regexp_extract_all(body, '\\S+')) AS words FROM n),
    r AS (SELECT *, row_number() OVER (PARTITION BY body ORDER BY source, doc_id) AS k, count(*) OVER (PARTITION BY body) AS copies FROM w WHERE words >= 10)
    SELECT 'web:' || doc_id AS id, source, url, words, length(body) AS chars, sha256(body) AS content_sha256, copies FROM r WHERE k = 1""")  # fmt: skip
def corpus_documents(spark, d):
    """Documents of ten words or more, normalised, one per content, with the copies it stands for."""
    rows = table(spark, d, "documents").filter("text is not null").withColumn("body", T.normalize_text(F.col("text")))
    rows = rows.withColumn("words", T.word_count(F.col("body"))).withColumn("content_sha256", F.sha2("body", 256))
    # the first document of a content stands for it; map-side partial aggregation keeps a hot content from one task
    first = F.min(F.struct("source", "doc_id", "url", "words", F.length("body").alias("chars")))
    groups = rows.groupBy("content_sha256").agg(first.alias("f"), F.count("*").alias("copies"))
    # equal contents have equally many words: filtered here, the text isn't normalised twice (filters move below projections)
    groups = groups.filter("f.words >= 10")
    return groups.select(F.concat(F.lit("web:"), "f.doc_id").alias("id"), "f.source", "f.url", "f.words", "f.chars", "content_sha256", "copies")


@query("normalize_text", f"SELECT doc_id, md5({normal('text')}) AS h FROM documents")
def normalize_text(spark, d):
    return table(spark, d, "documents").select("doc_id", F.md5(T.normalize_text(F.col("text"))).alias("h"))


@query("normalize_extracted", f"SELECT DISTINCT id, md5({normal('replace(text, chr(9), chr(32))')}) AS h FROM chunks")
def normalize_extracted(spark, d):
    return table(spark, d, "chunks").select("id", F.md5(T.normalize_extracted(F.col("text"))).alias("h")).distinct()


@query("normalize_page", f"SELECT DISTINCT id, md5({normal('replace(text, chr(160), chr(32))')}) AS h FROM chunks")
def normalize_page(spark, d):
    return table(spark, d, "chunks").select("id", F.md5(T.normalize_page(F.col("text"))).alias("h")).distinct()


@query("word_counts", r"SELECT doc_id, len(regexp_extract_all(text, '[^\s\x{a0}]+')) AS words, length(text) AS chars FROM documents WHERE len(regexp_extract_all(text, '[^\s\x{a0}]+')) >= 10")
def word_counts(spark, d):
    rows = table(spark, d, "documents").withColumn("words", T.word_count(F.col("text"))).filter("words >= 10")
    return rows.select("doc_id", "words", F.length("text").alias("chars"))


# what the engine's word characters have beyond letters, figures and marks: circled and squared letters, joiners
_MORE = r"\x{200c}\x{200d}\x{24b6}-\x{24e9}\x{1f130}-\x{1f149}\x{1f150}-\x{1f169}\x{1f170}-\x{1f189}"


@query("token_counts", rf"SELECT doc_id, len(regexp_extract_all(text, '[''-]*[\p{{L}}\p{{Nd}}\p{{Nl}}\p{{M}}\p{{Pc}}×÷{_MORE}][\p{{L}}\p{{Nd}}\p{{Nl}}\p{{M}}\p{{Pc}}×÷{_MORE}''-]*')) AS tokens FROM documents WHERE text IS NOT NULL")
def token_counts(spark, d):
    return table(spark, d, "documents").filter("text is not null").select("doc_id", T.token_count(F.col("text")).alias("tokens"))


@query("clean_titles", r"""
    SELECT DISTINCT id, coalesce(nullif(regexp_replace(regexp_replace(regexp_replace(replace(title, '_', ' '), '\s+', ' ', 'g'), '^[ _–—-]+', ''), '[ _–—-]+$', ''), ''), 'Bez tytułu') AS title FROM chunks""")
def clean_titles(spark, d):
    return table(spark, d, "chunks").select("id", T.clean_title(F.col("title")).alias("title")).distinct()


@query("unit_keys", f"SELECT md5(trim(regexp_replace(lower({normal('text')}), '\\s+', ' ', 'g'))) AS h, count(DISTINCT doc_id) AS n FROM documents WHERE text IS NOT NULL GROUP BY 1 HAVING count(DISTINCT doc_id) > 1")
def unit_keys(spark, d):
    rows = table(spark, d, "documents").filter("text is not null").select(F.md5(T.unit_key(F.col("text"))).alias("h"), "doc_id")
    return rows.groupBy("h").agg(F.count_distinct("doc_id").alias("n")).filter("n > 1")


@query("merged_blocks", f"""
    WITH b AS (SELECT DISTINCT id, title, text FROM chunks WHERE text IS NOT NULL),
    e AS (SELECT id, unnest(string_split({normal('title')}, chr(10) || chr(10)) || string_split({normal('text')}, chr(10) || chr(10)) || string_split({normal('text')}, chr(10) || chr(10))) AS x,
          generate_subscripts(string_split({normal('title')}, chr(10) || chr(10)) || string_split({normal('text')}, chr(10) || chr(10)) || string_split({normal('text')}, chr(10) || chr(10)), 1) AS p FROM b),
    f AS (SELECT id, x, min(p) AS p FROM e WHERE trim(x) <> '' GROUP BY id, x)
    SELECT id, md5(string_agg(x, chr(10) || chr(10) ORDER BY p)) AS h FROM f GROUP BY id""")
def merged_blocks(spark, d):
    """Title and text twice: every block stays once."""
    rows = delivered_once(table(spark, d, "chunks").filter("text is not null and id is not null").select("id", "title", "text"), "id")
    return rows.select("id", F.md5(T.merge_blocks(F.col("title"), F.col("text"), F.col("text"))).alias("h"))


@query("file_names", r"""
    SELECT DISTINCT attachment_id, regexp_replace(regexp_replace(regexp_replace(filename, '[\\/]', '_', 'g'), '^[ .]+', ''), '[ .]+$', '') AS safe,
           trim(regexp_replace(regexp_replace(regexp_replace(filename, '(.)\.[^.]*$', '\1'), '[_-]+', ' ', 'g'), '\s+', ' ', 'g')) AS stem FROM text_index""")
def file_names(spark, d):
    return table(spark, d, "text_index").select("attachment_id", T.safe_filename(F.col("filename")).alias("safe"), T.stem_title(F.col("filename")).alias("stem")).distinct()


def _hits(words):
    known = ", ".join(f"'{w}'" for w in words)
    return f"len(list_filter(words, lambda w: w IN ({known})))"


def language_sql(c: str) -> str:
    """``detect_language`` of a text column."""
    head = f"lower(substring({c}, 1, 12000))"
    words = f"regexp_extract_all({head}, '[A-Za-z\\x{{c0}}-\\x{{17e}}]+')"
    pl = f"(CAST({_hits(T.POLISH_WORDS).replace('words', words)} AS DOUBLE) + CAST(length({head}) - length(translate({head}, '{T.POLISH_MARKS}', '')) AS DOUBLE) * CAST(0.35 AS DOUBLE))"
    en, more = f"CAST({_hits(T.ENGLISH_WORDS).replace('words', words)} AS DOUBLE)", "CAST(1.25 AS DOUBLE)"
    return f"CASE WHEN {pl} = 0 AND {en} = 0 THEN NULL WHEN {pl} >= {en} * {more} THEN 'pl' WHEN {en} >= {pl} * {more} THEN 'en' ELSE 'pl-en' END"


@query("function_word_languages", f"SELECT doc_id, {language_sql('text')} AS language FROM documents WHERE text IS NOT NULL")
def function_word_languages(spark, d):
    return table(spark, d, "documents").filter("text is not null").select("doc_id", T.detect_language(F.col("text")).alias("language"))


_LINES = "SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS line_no FROM documents WHERE text IS NOT NULL"
LIST_SQL = r"(?i)^(?:[-*•▪◦–—]|(?:\d+|[A-Za-z]|[IVXLCDM]+)[.)]|§\s*\d+)"
_NUMBERED_SQL = r"(?i)^(?:\d+(?:\.\d+){0,5}[.)]?|§\s*\d+)\s+\S+"


def heading_sql(c: str) -> str:
    """``looks_like_heading`` of a line without blanks at its ends."""
    n, letters, upper = rf"len(regexp_extract_all({c}, '[^\s\x{{a0}}]+'))", rf"length(regexp_replace({c}, '\P{{L}}', '', 'g'))", rf"length(regexp_replace({c}, '\P{{Lu}}', '', 'g'))"
    return rf"""({n} BETWEEN 1 AND 18 AND length({c}) <= 180 AND NOT regexp_matches({c}, '{LIST_SQL}') AND CASE WHEN regexp_matches({c}, '{_NUMBERED_SQL}') THEN true WHEN {c} LIKE '%:' AND {n} <= 14 THEN true
        WHEN regexp_matches({c}, '[.!?;,]$') THEN false WHEN {letters} > 0 AND {n} >= 2 AND {upper} >= 0.72 * {letters} THEN true ELSE {n} <= 10 AND regexp_matches({c}, '^\p{{Lu}}') END)"""


@query("headings", rf"""
    WITH l AS ({_LINES}), s AS (SELECT doc_id, line_no, regexp_replace(regexp_replace(line, '^[\s\x{{a0}}]+', ''), '[\s\x{{a0}}]+$', '') AS line FROM l)
    SELECT doc_id, line_no, line FROM s WHERE {heading_sql('line')}""")
def headings(spark, d):
    rows = table(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("p", "line"))
    rows = rows.filter(T.looks_like_heading(F.col("line")))
    return rows.select("doc_id", (F.col("p") + 1).alias("line_no"), T._strip(F.col("line")).alias("line"))


@query("list_items", f"WITH l AS ({_LINES}) SELECT doc_id, count(*) AS n FROM l WHERE regexp_matches(line, '{LIST_SQL}') GROUP BY doc_id")
def list_items(spark, d):
    rows = table(spark, d, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    return rows.filter(T.is_list_item(F.col("line"))).groupBy("doc_id").agg(F.count("*").alias("n"))


def held(c: str) -> str:
    for a in T.ABBREVIATIONS:
        c = f"regexp_replace({c}, '(?i){a.replace('.', chr(92) + '.')}', '{a.replace('.', chr(0x241F))}', 'g')"
    return c


@query("sentences", rf"""
    WITH h AS (SELECT doc_id, {held('text')} AS t FROM documents WHERE text IS NOT NULL),
    m AS (SELECT doc_id, string_split(regexp_replace(t, '([.!?…])\s+([A-ZĄĆĘŁŃÓŚŹŻ0-9„"(§])', '\1' || chr(1) || '\2', 'g'), chr(1)) AS parts FROM h),
    p AS (SELECT doc_id, list_filter(list_transform(parts, lambda s: trim(replace(s, chr(9247), '.'))), lambda s: s <> '') AS parts FROM m)
    SELECT doc_id, len(parts) AS n, md5(array_to_string(parts, chr(1))) AS h FROM p""")
def sentences(spark, d):
    rows = table(spark, d, "documents").filter("text is not null").select("doc_id", T.split_sentences(F.col("text")).alias("parts"))
    return rows.select("doc_id", F.size("parts").alias("n"), F.md5(F.array_join("parts", "\x01")).alias("h"))


@query("repetition", r"""
    WITH w AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{Nd}\p{Nl}\p{M}\p{Pc}]+') AS w FROM documents WHERE text IS NOT NULL),
    g AS (SELECT doc_id, len(w) AS words, list_transform(range(1, greatest(len(w) - 3, 1)), lambda i: w[i:i+4]) AS g FROM w)
    SELECT doc_id, words, len(g) AS n_grams, len(list_distinct(g)) AS distinct_grams FROM g WHERE words >= 20""")
def repetition(spark, d):
    rows = table(spark, d, "documents").filter("text is not null").select("doc_id", F.regexp_count(F.lower("text"), F.lit(r"(?U)\w+")).alias("words"), T.ngrams(F.col("text"), 5).alias("g"))
    return rows.filter("words >= 20").select("doc_id", "words", F.size("g").alias("n_grams"), F.size(F.array_distinct("g")).alias("distinct_grams"))


@query("scan_quality", r"""
    WITH c AS (SELECT DISTINCT id, text FROM chunks WHERE text IS NOT NULL),
    w AS (SELECT id, regexp_extract_all(text, '[^\s\x{a0}]+') AS w, regexp_replace(text, '[\s\x{a0}]', '', 'g') AS seen FROM c)
    SELECT id, len(w) AS words, len(list_filter(w, lambda x: length(regexp_replace(x, '[^\p{L}\p{Nd}\p{Nl}\p{M}\p{Pc}\x{c0}-\x{17e}]', '', 'g')) = 1)) AS single,
           length(regexp_replace(seen, '\P{L}', '', 'g')) AS letters, length(seen) AS visible FROM w""")
def scan_quality(spark, d):
    """What the gate on scanned text counts: single-character words and letters."""
    rows = delivered_once(table(spark, d, "chunks").filter("text is not null and id is not null").select("id", "text"), "id")
    words = F.regexp_extract_all("text", F.lit(r"(?U)(\S+)"), F.lit(1))
    seen = F.regexp_replace("text", r"(?U)\s", "")
    return rows.select(
        "id", F.size(words).alias("words"), F.size(F.filter(words, lambda w: F.length(F.regexp_replace(w, r"(?U)[^\wÀ-ž]", "")) == 1)).alias("single"),
        F.length(F.regexp_replace(seen, r"\P{L}", "")).alias("letters"), F.length(seen).alias("visible"),
    )


@query("low_quality_scans", r"""
    WITH c AS (SELECT DISTINCT id, text FROM chunks WHERE text IS NOT NULL AND id IS NOT NULL),
    w AS (SELECT id, regexp_extract_all(text, '[^\s\x{a0}]+') AS w, regexp_replace(text, '[\s\x{a0}]', '', 'g') AS seen FROM c),
    s AS (SELECT id, coalesce(CAST(len(list_filter(w, lambda x: length(regexp_replace(x, '[^\p{L}\p{Nd}\p{Nl}\p{M}\p{Pc}\x{c0}-\x{17e}]', '', 'g')) = 1)) AS DOUBLE) / nullif(len(w), 0), 0) AS single_share,
                 coalesce(CAST(length(regexp_replace(seen, '\P{L}', '', 'g')) AS DOUBLE) / nullif(length(seen), 0), 0) AS alphabetic_share FROM w)
    SELECT id, round(single_share, 6) AS single_share, round(alphabetic_share, 6) AS alphabetic_share FROM s WHERE single_share > 0.25 OR alphabetic_share < 0.6""")
def low_quality_scans(spark, d):
    rows = delivered_once(table(spark, d, "chunks").filter("text is not null and id is not null").select("id", "text"), "id")
    rows = rows.select("id", T.single_character_share(F.col("text")).alias("single_share"), T.alphabetic_share(F.col("text")).alias("alphabetic_share"))
    return rows.filter("single_share > 0.25 or alphabetic_share < 0.6").select("id", F.round("single_share", 6).alias("single_share"), F.round("alphabetic_share", 6).alias("alphabetic_share"))
