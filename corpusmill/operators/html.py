"""Text, headings and links of HTML, with the parser of the standard library in Arrow batches."""

from __future__ import annotations

import re
from html.parser import HTMLParser
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import url as U
from ..functions.text import normalize_page

_SILENT = {"script", "style", "noscript", "svg", "canvas", "form", "iframe"}  # fixed values
_SKIPPED = ("#", "mailto:", "tel:", "javascript:")


class _Reader(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.silent: list[str] = []
        self.parts: list[str] = []
        self.headings: list[str] = []
        self.links: list[tuple[str, str]] = []
        self.heading: list[str] | None = None
        self.anchor: tuple[str, list[str]] | None = None

    def handle_starttag(self, tag, attrs):
        if tag in _SILENT:
            self.silent.append(tag)
        elif tag in ("br", "hr") and not self.silent:
            self.parts.append("\n")
        elif re.fullmatch(r"h[1-6]", tag):
            self.heading = []
        elif tag == "a":
            self._end_anchor()
            href = dict(attrs).get("href")
            if href is not None:
                self.anchor = (href, [])

    def handle_startendtag(self, tag, attrs):
        if tag in ("br", "hr") and not self.silent:
            self.parts.append("\n")

    def handle_endtag(self, tag):
        if tag in _SILENT:
            if tag in self.silent:
                while self.silent.pop() != tag:
                    pass
        elif re.fullmatch(r"h[1-6]", tag) and self.heading is not None:
            text = " ".join(" ".join(self.heading).split())
            if text and text not in self.headings:
                self.headings.append(text)
            self.heading = None
        elif tag in ("td", "th") and not self.silent:
            self.parts.append(" | ")
        elif tag == "a":
            self._end_anchor()

    def _end_anchor(self):
        if self.anchor:
            self.links.append((self.anchor[0].strip(), " ".join(" ".join(self.anchor[1]).split())))
            self.anchor = None

    def handle_data(self, data):
        if self.silent:
            return
        self.parts.append(data)
        if self.heading is not None:
            self.heading.append(data)
        if self.anchor:
            self.anchor[1].append(data)


def read_html(html: str, base: str = "") -> tuple[str, list[str], list[tuple[str, str]]]:
    """(text nodes joined by line feeds, headings, (absolute URL, anchor text) of the links)."""
    r = _Reader()
    r.feed(html)
    r.close()
    r._end_anchor()
    links = []
    for href, anchor in r.links:
        if not href or href.startswith(_SKIPPED):
            continue
        try:
            target = urljoin(base, href)
        except ValueError:
            continue
        if target.startswith(("http://", "https://")) and (target, anchor) not in links:
            links.append((target, anchor))
    return "\n".join(r.parts), r.headings, links


def parse_pages(df: DataFrame, id_col: str, html_col: str, url_col: str) -> DataFrame:
    """(id, url, text, headings, links[url, anchor_text]) of pages; null markup is empty."""
    rows = df.select(F.col(id_col).cast("string").alias("id"), F.col(url_col).alias("url"), F.coalesce(html_col, F.lit("")).alias("html"))
    link = pa.list_(pa.struct([("url", pa.string()), ("anchor_text", pa.string())]))

    def run(batches):
        for batch in batches:
            found = [read_html(h, u or "") for u, h in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            cols = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.list_(pa.string())),
                    pa.array([[{"url": u, "anchor_text": a} for u, a in f[2]] for f in found], link)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *cols], names=["id", "url", "text", "headings", "links"])

    out = rows.mapInArrow(run, "id string, url string, text string, headings array<string>, links array<struct<url string, anchor_text string>>")
    return out.withColumn("text", normalize_page(F.col("text")))


def page_links(pages: DataFrame, domains: list[str]) -> DataFrame:
    """(id, url, anchor_text, host, kind) of the links of parsed pages, one row per page, URL and anchor text."""
    rows = pages.select("id", U.host(F.col("url")).alias("own"), F.explode("links").alias("l"))
    rows = rows.select("id", "own", U.normalize_url(F.col("l.url")).alias("url"), F.col("l.anchor_text").alias("anchor_text"))
    return rows.select("id", "url", "anchor_text", U.host(F.col("url")).alias("host"), U.link_kind(F.col("url"), F.col("own"), domains).alias("kind")).distinct()
