"""Sources on the web: a paginated REST data source, and URL probes. The fetching function is given, so tests need no network."""

from __future__ import annotations

import functools
import json
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions import url as U
from ..operators.grouping import first_match

RETRIED = (429, 500, 502, 503, 504)
Fetch = Callable[[str, dict], tuple[int, dict, bytes]]


def _body(response, most_bytes: int | None) -> bytes:
    """What a response brings, block by block; reading stops one byte beyond ``most_bytes``, which tells that there is more."""
    if most_bytes is None:
        return response.read()
    if (response.headers.get("Content-Length") or "").isdigit() and int(response.headers["Content-Length"]) > most_bytes:
        return b""
    out = bytearray()
    while len(out) <= most_bytes and (block := response.read(min(65_536, most_bytes + 1 - len(out)))):
        out += block
    return bytes(out)


def fetch(url: str, headers: dict, timeout: float = 30.0, attempts: int = 3, backoff: float = 1.0, most_bytes: int | None = None) -> tuple[int, dict, bytes]:
    """(status, headers, body); busy and broken servers are asked again, later each time or when they say so. No more than
    ``most_bytes`` and one are read of a body, none where its header says that it is longer."""
    for n in range(1, attempts + 1):
        try:
            with urllib.request.urlopen(urllib.request.Request(url, headers=headers), timeout=timeout) as r:
                return r.status, {k.lower(): v for k, v in r.headers.items()}, _body(r, most_bytes)
        except urllib.error.HTTPError as e:
            if e.code not in RETRIED or n == attempts:
                return e.code, {k.lower(): v for k, v in e.headers.items()}, b""
            wait = e.headers.get("Retry-After", "")
            time.sleep(float(wait) if wait.isdigit() else backoff * n)
        except OSError:
            if n == attempts:
                raise
            time.sleep(backoff * n)
    raise AssertionError


def pages(base: str, kind: str, get: Fetch, per_page: int = 100, delay: float = 0.0) -> Iterator[dict]:
    """Items of a collection in order of id. The first page says how many there are; else an empty or short page ends it."""
    number, total = 1, None
    while total is None or number <= total:
        status, headers, body = get(f"{base}/{kind}?per_page={per_page}&page={number}&orderby=id&order=asc", {"Accept": "application/json"})
        if status != 200:
            if number > 1 and status in (400, 404):
                return
            raise OSError(f"{kind}, page {number}: status {status}")
        if number == 1 and headers.get("x-wp-totalpages", "").isdigit():
            total = int(headers["x-wp-totalpages"])
        items = json.loads(body)
        yield from (x for x in items if isinstance(x, dict))
        if not items or (total is None and len(items) < per_page):
            return
        number += 1
        time.sleep(delay)


class _Part(InputPartition):
    def __init__(self, source: str, base: str, kind: str):
        self.source, self.base, self.kind = source, base, kind


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options

    def partitions(self):
        return [_Part(s["id"], s["base_url"], k) for s in json.loads(self.options["sources"]) if s.get("enabled", True) for k in s["content_types"]]

    def read(self, part):
        try:
            for item in pages(part.base, part.kind, self.options.get("fetch") or fetch, int(self.options.get("perpage", 100)), float(self.options.get("delay", 0))):
                yield part.source, part.kind, json.dumps(item, ensure_ascii=False), None
        except (OSError, ValueError) as e:  # one collection fails alone
            yield part.source, part.kind, None, str(e)[:300]


class CollectionSource(DataSource):
    """``spark.read.format("collections")``, option ``sources``: JSON list of id, base_url, content_types, enabled. One partition per
    source and content type; columns source_id, content_type, item (JSON), error."""

    @classmethod
    def name(cls):
        return "collections"

    def schema(self):
        return "source_id string, content_type string, item string, error string"

    def reader(self, schema):
        return _Reader(dict(self.options))


def probe(urls: DataFrame, url_col: str, get: Fetch | None = None, partitions: int = 4) -> DataFrame:
    """(url, status, content_type, content_range, content_length, error) of one-byte range requests; few partitions, to be polite."""
    rows = urls.select(F.col(url_col).cast("string").alias("url")).filter("url is not null").distinct().repartition(partitions, "url")

    def run(batches):
        import pandas as pd

        ask = get or fetch
        for pdf in batches:
            out = []
            for u in pdf["url"]:
                try:
                    status, h, _ = ask(u, {"Range": "bytes=0-0"})
                    out.append((u, status, h.get("content-type"), h.get("content-range"), h.get("content-length"), None))
                except OSError as e:
                    out.append((u, None, None, None, None, str(e)[:300]))
            yield pd.DataFrame(out, columns=["url", "status", "content_type", "content_range", "content_length", "error"]).astype({"status": "Int32"})

    return rows.mapInPandas(run, "url string, status int, content_type string, content_range string, content_length string, error string")


def judge_probes(probes: DataFrame, known_types: list[str]) -> DataFrame:
    """Adds extension, size, reachable and the class of content to probes."""
    ext = U.extension(F.col("url"))
    return probes.select(
        "*", ext.alias("extension"), U.total_size(F.col("content_range"), F.col("content_length"), F.col("status")).alias("size"),
        F.coalesce(F.col("status").isin(200, 206), F.lit(False)).alias("reachable"), U.content_class(F.col("content_type"), ext, known_types).alias("content_class"),
    )


SAMPLE = 8192
GENERIC_TYPES = ("application/octet-stream", "binary/octet-stream", "application/download", "application/force-download")


def probe_whole(urls: DataFrame, url_col: str, get: Fetch | None = None, partitions: int = 4) -> DataFrame:
    """(url, status, content_type, head, error) of whole requests, of whose bodies the first 8,192 bytes are kept."""
    rows = urls.select(F.col(url_col).cast("string").alias("url")).filter("url is not null").distinct().repartition(partitions, "url")

    def run(batches):
        import pandas as pd

        ask = get or functools.partial(fetch, most_bytes=SAMPLE)
        for pdf in batches:
            out = []
            for u in pdf["url"]:
                try:
                    status, h, body = ask(u, {})
                    out.append((u, status, h.get("content-type"), body[:SAMPLE], None))
                except OSError as e:
                    out.append((u, None, None, None, str(e)[:300]))
            yield pd.DataFrame(out, columns=["url", "status", "content_type", "head", "error"]).astype({"status": "Int32"})

    return rows.mapInPandas(run, "url string, status int, content_type string, head binary, error string")


def judge_whole(probes: DataFrame, known_types: list[str]) -> DataFrame:
    """Adds extension, ``valid`` and ``verdict`` to whole probes: the first of unreachable, unsupported_extension, html_response,
    supported_type_and_bytes, generic_type_and_bytes, mismatch that holds."""
    ext, kind = U.extension(F.col("url")), F.coalesce(U.media_type(F.col("content_type")), F.lit(""))
    start = F.lower(F.trim(F.substring(F.col("head").cast("string"), 1, 200)))
    html = kind.isin("text/html", "application/xhtml+xml") | start.startswith("<!doctype html") | start.startswith("<html")
    bytes_fit = F.coalesce(U.magic_matches(F.col("head"), ext), F.lit(False))
    verdict = first_match(
        (~F.coalesce(F.col("status") == 200, F.lit(False)), "unreachable"), (~ext.isin(*U.DOCUMENT_EXTENSIONS), "unsupported_extension"), (F.coalesce(html, F.lit(False)), "html_response"),
        (kind.isin(*known_types) & bytes_fit, "supported_type_and_bytes"), (((kind == "") | kind.isin(*GENERIC_TYPES)) & bytes_fit, "generic_type_and_bytes"), otherwise="mismatch",
    )
    return probes.withColumn("extension", ext).withColumn("verdict", verdict).withColumn("valid", F.col("verdict").isin("supported_type_and_bytes", "generic_type_and_bytes"))


#: What is asked of a site, in this order; of the sitemaps, the first that is one counts.
API_PATHS = ("/wp-json/", "/wp-json/wp/v2/types", "/wp-json/wp/v2/posts?per_page=1")
SITEMAP_PATHS = ("/sitemap.xml", "/sitemap_index.xml", "/wp-sitemap.xml")


def _answer(ask: Fetch, url: str) -> tuple[int | None, bytes]:
    try:
        status, _, body = ask(url, {})
        return status, body
    except OSError:
        return None, b""


def probe_sites(sites: DataFrame, base_col: str, get: Fetch | None = None, partitions: int = 4) -> DataFrame:
    """(base_url, home_status, robots_status, api_ok, sitemap_url): whether a site answers, has an API that gives JSON, and its sitemap."""
    rows = sites.select(F.regexp_replace(base_col, "/+$", "").alias("base_url")).filter("base_url != ''").distinct().repartition(partitions, "base_url")

    def is_json(body: bytes) -> bool:
        try:
            return isinstance(json.loads(body), (dict, list))
        except ValueError:
            return False

    def run(batches):
        import pandas as pd

        ask = get or functools.partial(fetch, most_bytes=5_000_000)
        for pdf in batches:
            out = []
            for base in pdf["base_url"]:
                home, robots = _answer(ask, f"{base}/")[0], _answer(ask, f"{base}/robots.txt")[0]
                answers = [_answer(ask, base + p) for p in API_PATHS]
                api = all(status == 200 and is_json(body) for status, body in answers)
                site = next((base + p for p in SITEMAP_PATHS for status, body in [_answer(ask, base + p)] if status == 200 and (b"<urlset" in body or b"<sitemapindex" in body)), None)
                out.append((base, home, robots, api, site))
            yield pd.DataFrame(out, columns=["base_url", "home_status", "robots_status", "api_ok", "sitemap_url"]).astype({"home_status": "Int32", "robots_status": "Int32"})

    return rows.mapInPandas(run, "base_url string, home_status int, robots_status int, api_ok boolean, sitemap_url string")


def content_totals(sites: DataFrame, source_col: str, base_col: str, get: Fetch | None = None, partitions: int = 4) -> DataFrame:
    """(source_id, content_type, taxonomies, total, error): the content types that a site's API names, how many items each has and by which
    taxonomies they are grouped; a row with an error alone where the API doesn't answer. ``pages.inventory`` sums them."""
    rows = sites.select(F.col(source_col).alias("source_id"), F.regexp_replace(base_col, "/+$", "").alias("base_url")).dropna().distinct().repartition(partitions, "base_url")

    def run(batches):
        import pandas as pd

        ask = get or fetch
        for pdf in batches:
            out = []
            for source, base in zip(pdf["source_id"], pdf["base_url"]):
                try:
                    status, _, body = ask(f"{base}/wp-json/wp/v2/types", {"Accept": "application/json"})
                    types = json.loads(body) if status == 200 else None
                    if not isinstance(types, dict):
                        raise ValueError(f"types: status {status}")
                except (OSError, ValueError) as e:
                    out.append((source, None, [], None, str(e)[:300]))
                    continue
                for name, about in sorted(types.items()):
                    about = about if isinstance(about, dict) else {}
                    total, error = None, None
                    try:
                        status, h, _ = ask(f"{base}/wp-json/wp/v2/{about.get('rest_base') or name}?per_page=1", {"Accept": "application/json"})
                        total = int(h["x-wp-total"]) if status == 200 and h.get("x-wp-total", "").isdigit() else None
                        error = None if status == 200 else f"status {status}"
                    except OSError as e:
                        error = str(e)[:300]
                    out.append((source, name, [t for t in about.get("taxonomies") or [] if isinstance(t, str)], total, error))
            yield pd.DataFrame(out, columns=["source_id", "content_type", "taxonomies", "total", "error"]).astype({"total": "Int64"})

    return rows.mapInPandas(run, "source_id string, content_type string, taxonomies array<string>, total long, error string")


def download(queue: DataFrame, url_col: str, get: Fetch | None = None, most_bytes: int | None = 30_000_000, partitions: int = 4) -> DataFrame:
    """(url, status, content, content_sha256, etag, last_modified, error) of conditional requests.

    ``queue`` may have ``etag`` and ``last_modified`` of the time before; unchanged files come as status 304 without
    content. Files above ``most_bytes``, by header or by size, come as an error without content, and no more than that is read of
    them; None reads any file whole.
    """
    extra = [F.col(c).cast("string").alias(c) if c in queue.columns else F.lit(None).cast("string").alias(c) for c in ("etag", "last_modified")]
    rows = queue.select(F.col(url_col).cast("string").alias("url"), *extra).filter("url is not null").dropDuplicates(["url"]).repartition(partitions, "url")

    def run(batches):
        import hashlib

        import pandas as pd

        ask = get or functools.partial(fetch, most_bytes=most_bytes)
        for pdf in batches:
            out = []
            for u, etag, modified in zip(pdf["url"], pdf["etag"], pdf["last_modified"]):
                headers = {k: v for k, v in (("If-None-Match", etag), ("If-Modified-Since", modified)) if isinstance(v, str) and v}
                try:
                    status, h, body = ask(u, headers)
                except OSError as e:
                    out.append((u, None, None, None, None, None, str(e)[:300]))
                    continue
                size = int(h["content-length"]) if h.get("content-length", "").isdigit() else len(body)
                large = most_bytes is not None and max(size, len(body)) > most_bytes
                ok = status == 200 and not large
                out.append((u, status, body if ok else None, hashlib.sha256(body).hexdigest() if ok else None, h.get("etag"), h.get("last-modified"), "too large" if large else None))
            yield pd.DataFrame(out, columns=["url", "status", "content", "content_sha256", "etag", "last_modified", "error"]).astype({"status": "Int32"})

    return rows.mapInPandas(run, "url string, status int, content binary, content_sha256 string, etag string, last_modified string, error string")
