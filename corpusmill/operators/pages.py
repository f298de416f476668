"""Documents and attachments from the items of a content API, as raw JSON strings in a column."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import url as U
from ..functions.grouping_keys import taxonomy_key
from .grouping import first_match
from .html import read_html


def strings_of(value) -> Iterator[str]:
    """All strings inside nested JSON that aren't blank, depth first."""
    if isinstance(value, str):
        if value.strip():
            yield value
    elif isinstance(value, dict):
        for v in value.values():
            yield from strings_of(v)
    elif isinstance(value, list):
        for v in value:
            yield from strings_of(v)


def _rendered(value) -> str:
    if isinstance(value, dict):
        value = value.get("rendered")
    return value if isinstance(value, str) else ""


_FIELDS = {
    "item_id": pa.int64(), "kind": pa.string(), "status": pa.string(), "slug": pa.string(), "link": pa.string(), "title_html": pa.string(), "title": pa.string(),
    "body": pa.string(), "excerpt": pa.string(), "extra": pa.string(), "headings": pa.list_(pa.string()), "links": pa.list_(pa.struct([("url", pa.string()), ("anchor_text", pa.string())])),
    "published_at": pa.string(), "modified_at": pa.string(), "parent": pa.int64(), "taxonomies": pa.string(), "media_type": pa.string(), "mime_type": pa.string(), "source_url": pa.string(),
    "filesize": pa.int64(),
}


def _read(item: str) -> dict | None:
    try:
        d = json.loads(item)
    except (TypeError, ValueError):
        return None
    if not isinstance(d, dict):
        return None
    link = d.get("link") or _rendered(d.get("guid"))
    content, excerpt, title = _rendered(d.get("content")), _rendered(d.get("excerpt")), _rendered(d.get("title"))
    extra = [s for s in strings_of(d.get("acf")) if not s.startswith(("http://", "https://"))]
    extra_lines = list(dict.fromkeys(x for s in extra for x in read_html(s)[0].split("\n") if x.strip()))
    body, headings, links = read_html(content, link)
    for s in strings_of(d.get("acf")):
        if any(m in s for m in ("<a ", "<h1", "<h2", "<h3")):
            _, more, linked = read_html(s, link)
            headings += [h for h in more if h not in headings]
            links += [x for x in linked if x not in links]
    number = lambda v: v if isinstance(v, int) and not isinstance(v, bool) else None
    kept = {k: v for k, v in d.items() if taxonomy_key(k) and isinstance(v, (list, int, str))}
    return {
        "item_id": number(d.get("id")), "kind": d.get("type"), "status": d.get("status"), "slug": d.get("slug") or "", "link": link, "title_html": title, "title": read_html(title)[0],
        "body": body, "excerpt": read_html(excerpt)[0], "extra": "\n".join(extra_lines), "headings": headings, "links": [{"url": u, "anchor_text": a} for u, a in links],
        "published_at": d.get("date_gmt") or d.get("date"), "modified_at": d.get("modified_gmt") or d.get("modified"), "parent": number(d.get("parent")) or number(d.get("post")),
        "taxonomies": json.dumps(kept, ensure_ascii=False, sort_keys=True), "media_type": d.get("media_type"), "mime_type": d.get("mime_type"), "source_url": d.get("source_url"),
        "filesize": number((d.get("media_details") or {}).get("filesize")) if isinstance(d.get("media_details"), dict) else None,
    }


def read_items(items: DataFrame, source_col: str = "source_id", type_col: str = "content_type", item_col: str = "item") -> DataFrame:
    """Fields of the items; items that are no JSON objects are dropped."""
    rows = items.select(F.col(source_col).alias("source_id"), F.col(type_col).alias("content_type"), F.col(item_col).alias("item")).filter("item is not null")

    def run(batches):
        for batch in batches:
            found = [_read(x) for x in batch.column(2).to_pylist()]
            ok = [i for i, f in enumerate(found) if f is not None]
            cols = [batch.column(0).take(pa.array(ok, pa.int32())), batch.column(1).take(pa.array(ok, pa.int32()))]
            cols += [pa.array([found[i][k] for i in ok], t) for k, t in _FIELDS.items()]
            yield pa.RecordBatch.from_arrays(cols, names=["source_id", "content_type", *_FIELDS])

    kinds = {pa.int64(): "long", pa.string(): "string", pa.list_(pa.string()): "array<string>"}
    fields = ", ".join(f"{k} {kinds.get(t, 'array<struct<url string, anchor_text string>>')}" for k, t in _FIELDS.items())
    return rows.mapInArrow(run, f"source_id string, content_type string, {fields}")


def documents(read: DataFrame, least_words: int = 10) -> DataFrame:
    """One row per page: id, url, title, merged text, word count, whether it has enough words, hash of title, URL and text."""
    title = F.regexp_replace(F.trim(T.normalize_page(F.col("title"))), r"\s+", " ")
    title = F.coalesce(F.nullif(title, F.lit("")), F.nullif(F.col("slug"), F.lit("")), F.lit("Bez tytułu"))
    out = read.select(
        F.format_string("%s:%s:%d", "source_id", "content_type", "item_id").alias("id"), "source_id", "content_type", U.normalize_url(F.col("link")).alias("url"), title.alias("title"),
        T.merge_blocks(F.col("body"), F.col("excerpt"), F.col("extra")).alias("text"), "headings", "links", "published_at", "modified_at", "parent", "taxonomies",
    )
    words = T.word_count(F.col("text"))
    return out.withColumn("word_count", words).withColumn("indexable", words >= least_words).withColumn("content_hash", F.concat(F.lit("sha256:"), F.sha2(F.concat_ws("\n", "title", "url", "text"), 256)))


def attachments(read: DataFrame) -> DataFrame:
    """One row per file that is no image: id, url, filename, type, size."""
    rows = read.filter((F.col("media_type") == "file") | ~F.coalesce(F.startswith("mime_type", F.lit("image/")), F.lit(False)))
    return rows.select(
        F.format_string("%s:media:%d", "source_id", "item_id").alias("id"), "source_id", U.normalize_url(F.coalesce("source_url", "link")).alias("url"), F.col("link").alias("page_url"),
        U.basename(F.coalesce("source_url", "link")).alias("filename"), "mime_type", "media_type", "filesize", F.nullif(T.normalize_page(F.col("title")), F.lit("")).alias("title"), "parent",
    )


def adapter(api_ok: Column, sitemap_ok: Column) -> Column:
    """How a site is read, by what a probe found."""
    return first_match((api_ok, "wordpress"), (sitemap_ok, "sitemap_html"), otherwise="seeded_html")


def inventory(totals: DataFrame) -> DataFrame:
    """(source_id, types, custom_types, items) from (source_id, content_type, total) rows; unknown totals count as 0."""
    custom = ~F.col("content_type").isin("post", "page", "attachment", "posts", "pages", "media")
    return totals.groupBy("source_id").agg(F.count_distinct("content_type").alias("types"), F.count_distinct(F.when(custom, F.col("content_type"))).alias("custom_types"), F.coalesce(F.sum("total"), F.lit(0)).alias("items"))
