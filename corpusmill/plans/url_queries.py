"""URLs, media types and markup."""

from pyspark.sql import functions as F

from ..functions import url as U
from ..operators import html as H
from .catalog import query, table

_TRACK = ", ".join(f"'{t}'" for t in U.TRACKING)
_DOCS = "|".join(U.DOCUMENT_EXTENSIONS)


def _dirty(c):
    """Stored URLs with what real ones carry: tracking, double slashes, upper case, blank values and fragments."""
    return F.concat(F.regexp_replace(c, "^https://", "HTTPS://WWW."), F.lit("//Dok%20A+B.pdf?utm_source=x&Page=2&fbclid=1&ref=a%20b&empty&utm_id=7#top"))


_DIRTY = "regexp_replace(url, '^https://', 'HTTPS://WWW.') || '//Dok%20A+B.pdf?utm_source=x&Page=2&fbclid=1&ref=a%20b&empty&utm_id=7#top'"


@query("normalized_urls", rf"""
    WITH u AS (SELECT DISTINCT doc_id, {_DIRTY} AS u FROM documents)
    SELECT doc_id, 'https://' || lower(regexp_extract(u, '^[^:]+://([^/?#]*)', 1)) || regexp_replace(regexp_extract(u, '^[^:]+://[^/?#]*([^?#]*)', 1), '/+', '/', 'g') || '?Page=2&ref=a+b&empty=&utm_id=7' AS web,
           'https://' || lower(regexp_extract(u, '^[^:]+://([^/?#]*)', 1)) || replace(regexp_replace(regexp_extract(u, '^[^:]+://[^/?#]*([^?#]*)', 1), '/+', '/', 'g'), '%20', ' ') || '?Page=2&ref=a+b&empty=' AS manifest FROM u""")
def normalized_urls(spark, d):
    rows = table(spark, d, "documents").select("doc_id", _dirty(F.col("url")).alias("u")).distinct()
    return rows.select("doc_id", U.normalize_url(F.col("u")).alias("web"), U.normalize_url(F.col("u"), any_utm=True, decode_path=True).alias("manifest"))


@query("url_parts", rf"""
    SELECT DISTINCT attachment_id, regexp_extract(effective_url, '^[^:]+://([^/?#]*)', 1) AS host, regexp_extract(effective_url, '([^/]*)$', 1) AS name,
           lower(regexp_extract(effective_url, '\.([^./]+)$', 1)) AS ext, regexp_matches(effective_url, '\.({_DOCS})$') AS is_document FROM text_index WHERE effective_url IS NOT NULL""")
def url_parts(spark, d):
    u = F.col("effective_url")
    rows = table(spark, d, "text_index").filter("effective_url is not null")
    return rows.select("attachment_id", U.host(u).alias("host"), U.basename(u).alias("name"), U.extension(u).alias("ext"), U.is_document(u).alias("is_document")).distinct()


@query("link_kinds", rf"""
    WITH l AS (SELECT DISTINCT c.url, r.id AS rule, regexp_extract(r.base_url, '^[^:]+://([^/?#]*)', 1) AS own, regexp_extract(c.url, '^[^:]+://([^/?#]*)', 1) AS host FROM chunks c JOIN source_rules r ON c.source_id = r.id OR r.id = 'portal')
    SELECT url, rule, CASE WHEN regexp_matches(lower(url), '\.({_DOCS})$') THEN 'attachment' WHEN host = own THEN 'internal'
           WHEN host = 'uczelnia.example' OR host LIKE '%.uczelnia.example' THEN 'institutional' ELSE 'external' END AS kind FROM l WHERE url IS NOT NULL""")
def link_kinds(spark, d):
    """Every chunk's URL as a link on its own site and on the portal."""
    rules = table(spark, d, "source_rules").select(F.col("id").alias("rule"), U.host(F.col("base_url")).alias("own"))
    urls = table(spark, d, "chunks").filter("url is not null").select("url", "source_id").distinct()
    own = urls.join(rules, urls.source_id == rules.rule).select("url", "rule", "own")
    portal = urls.withColumn("rule", F.lit("portal")).join(rules, "rule").select("url", "rule", "own")
    rows = own.union(portal).distinct()
    return rows.select("url", "rule", U.link_kind(F.col("url"), F.col("own"), ["uczelnia.example"]).alias("kind"))


@query("resolved_links", """
    SELECT DISTINCT url, url || '#a' AS fragment, url || '?b=1' AS with_query, regexp_extract(url, '^([^:]+://[^/]*)', 1) || '/c/d' AS from_root, 'https://x.example/e' AS to_host,
           CASE WHEN regexp_matches(url, '^[^:]+://[^/]*$') THEN url || '/' ELSE regexp_extract(url, '^(.*/)', 1) END || 'f.html' AS relative FROM documents""")
def resolved_links(spark, d):
    u = F.col("url")
    refs = {"fragment": "#a", "with_query": "?b=1", "from_root": "/c/d", "to_host": "//x.example/e", "relative": "f.html"}
    return table(spark, d, "documents").select("url", *[U.resolve(u, F.lit(r)).alias(n) for n, r in refs.items()]).distinct()


_KNOWN = ["application/pdf", "application/msword"]


@query("content_types", r"""
    WITH e AS (SELECT DISTINCT queue_id, extension, CASE run_id % 4 WHEN 0 THEN 'Application/PDF; charset=x' WHEN 1 THEN 'application/octet-stream' WHEN 2 THEN NULL ELSE 'text/html' END AS mime FROM text_index WHERE run_id IS NOT NULL)
    SELECT queue_id, lower(trim(split_part(mime, ';', 1))) AS media, CASE WHEN lower(trim(split_part(mime, ';', 1))) IN ('application/pdf', 'application/msword') THEN 'supported_mime'
           WHEN mime = 'application/octet-stream' THEN 'octet_stream_with_extension' WHEN mime IS NULL THEN 'missing_mime_with_extension' ELSE 'unsupported' END AS content_class FROM e""")
def content_types(spark, d):
    mime = F.when(F.col("run_id") % 4 == 0, "Application/PDF; charset=x").when(F.col("run_id") % 4 == 1, "application/octet-stream").when(F.col("run_id") % 4 == 2, F.lit(None)).otherwise("text/html")
    rows = table(spark, d, "text_index").filter("run_id is not null").select("queue_id", "extension", mime.alias("mime")).distinct()
    return rows.select("queue_id", U.media_type(F.col("mime")).alias("media"), U.content_class(F.col("mime"), F.col("extension"), _KNOWN).alias("content_class"))


@query("magic_bytes", """
    WITH e AS (SELECT DISTINCT queue_id, extension, CASE WHEN parser = 'ooxml' THEN '504B0304' WHEN parser = 'pypdf' THEN '255044462D312E37' ELSE '3C68746D6C' END AS head FROM text_index)
    SELECT queue_id, CASE WHEN extension = 'pdf' THEN head LIKE '255044462D%' WHEN extension IN ('docx', 'pptx', 'xlsx', 'odt', 'zip') THEN head LIKE '504B0304%' ELSE false END AS matches FROM e""")
def magic_bytes(spark, d):
    head = F.unhex(F.when(F.col("parser") == "ooxml", "504B0304").when(F.col("parser") == "pypdf", "255044462D312E37").otherwise("3C68746D6C"))
    rows = table(spark, d, "text_index").select("queue_id", "extension", "parser").distinct()
    return rows.select("queue_id", U.magic_matches(head, F.col("extension")).alias("matches")).distinct()


@query("file_sizes", """
    SELECT DISTINCT queue_id, CASE WHEN char_count % 2 = 0 THEN char_count WHEN char_count % 3 = 0 THEN 17 ELSE NULL END AS size FROM text_index""")
def file_sizes(spark, d):
    """Sizes from the headers that a ranged request would have brought."""
    even = F.col("char_count") % 2 == 0
    ranged = F.when(even, F.concat(F.lit("bytes 0-0/"), F.col("char_count").cast("string")))
    status = F.when(F.col("char_count") % 3 == 0, 200).otherwise(206)
    return table(spark, d, "text_index").select("queue_id", U.total_size(ranged, F.lit("17"), status).alias("size")).distinct()


def _escaped(c: str) -> str:
    return f"replace(replace(replace(coalesce({c}, ''), '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


_HTML = f"""'<html><head><title>t</title><style>p{{}}</style></head><body><h1>' || {_escaped('title')} || '</h1><p>a &amp; b</p><script>x()</script><h2>' || {_escaped('source_id')} || '</h2><a href="' || url || '">first</a> <a href="/dok/x.pdf?utm_source=q">second</a><a href="#no">no</a><a href="mailto:a@b">no</a><br>end</body></html>'"""


def _pages(spark, d):
    return table(spark, d, "chunks").filter("url is not null").select(F.col("id"), "url", F.expr(_HTML).alias("html")).distinct()


_SPACED = r"trim(regexp_replace(coalesce({}, ''), '\s+', ' ', 'g'))".format


@query("page_headings", f"""
    WITH h AS (SELECT DISTINCT id, {_SPACED('title')} AS t, {_SPACED('source_id')} AS s FROM chunks WHERE url IS NOT NULL)
    SELECT DISTINCT id, CASE WHEN t = s OR s = '' THEN t WHEN t = '' THEN s ELSE t || '|' || s END AS headings FROM h""")
def page_headings(spark, d):
    return H.parse_pages(_pages(spark, d), "id", "html", "url").select("id", F.array_join("headings", "|").alias("headings"))


@query("page_links", rf"""
    WITH c AS (SELECT DISTINCT id, url FROM chunks WHERE url IS NOT NULL), h AS (SELECT *, lower(regexp_extract(url, '^[^:]+://([^/?#]*)', 1)) AS host FROM c)
    SELECT id, url, 'first' AS anchor_text, host, CASE WHEN regexp_matches(lower(url), '\.({_DOCS})$') THEN 'attachment' ELSE 'internal' END AS kind FROM h
    UNION ALL SELECT id, 'https://' || host || '/dok/x.pdf', 'second', host, 'attachment' FROM h""")
def page_links(spark, d):
    return H.page_links(H.parse_pages(_pages(spark, d), "id", "html", "url"), ["uczelnia.example"])


_OWN_LINE = r"CASE WHEN trim({0}) <> '' THEN chr(10) || trim(regexp_replace({0}, ' *\n *', chr(10), 'g')) ELSE '' END".format


@query("page_texts", f"""
    SELECT DISTINCT id, 't' || {_OWN_LINE("coalesce(title, '')")} || chr(10) || 'a & b' || {_OWN_LINE("coalesce(source_id, '')")} || chr(10) || 'first' || chr(10) || chr(10) || 'second' || chr(10) || 'no' || chr(10) || 'no' || chr(10) || chr(10) || 'end' AS text
    FROM chunks WHERE url IS NOT NULL""")
def page_texts(spark, d):
    return H.parse_pages(_pages(spark, d), "id", "html", "url").select("id", "text")
