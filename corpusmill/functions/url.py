"""URL and media-type functions, Column to Column. URLs are taken apart by pattern, as stored ones hold blanks and letters of
any script that strict parsers refuse."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
TRACKING = ("fbclid", "gclid", "mc_cid", "mc_eid", "utm_campaign", "utm_content", "utm_medium", "utm_source", "utm_term")
DOCUMENT_EXTENSIONS = ("pdf", "doc", "docx", "ppt", "pptx", "xls", "xlsx", "odt", "ods", "odp", "rtf", "csv", "txt", "zip")
OFFICE_ZIP = ("docx", "odt", "pptx", "xlsx")
OFFICE_OLD = ("doc", "ppt", "xls")
_PARTS = r"^(?:([^:/?#]+):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#.*)?$"


def _part(url: Column, k: int) -> Column:
    return F.regexp_extract(url, _PARTS, k)


def scheme(url: Column) -> Column:
    return F.lower(_part(url, 1))


def host(url: Column) -> Column:
    return F.lower(_part(url, 2))


def path(url: Column) -> Column:
    return _part(url, 3)


def query(url: Column) -> Column:
    return _part(url, 4)


def _decode(c: Column) -> Column:
    """Percent-decoding that leaves a plus as it is; what can't be decoded stays."""
    return F.coalesce(F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), c)


def normalize_url(url: Column, any_utm: bool = False, decode_path: bool = False) -> Column:
    """Lower-cased scheme and host, single slashes, no fragment, no tracking parameters; ``/`` for an empty path.

    ``any_utm`` drops every parameter that begins with utm_, ``decode_path`` percent-decodes the path.
    """
    url = F.trim(url)
    p = F.regexp_replace(path(url), "/{2,}", "/")
    p = F.when(p == "", "/").otherwise(p)
    if decode_path:
        p = _decode(p)
    name = lambda q: F.lower(F.substring_index(q, "=", 1))
    drop = lambda q: (q == "") | name(q).isin(*TRACKING) | (name(q).startswith("utm_") if any_utm else F.lit(False))
    kept = F.filter(F.split(query(url), "&"), lambda q: ~drop(q))
    kept = F.transform(kept, lambda q: F.when(F.contains(q, F.lit("=")), q).otherwise(F.concat(q, F.lit("="))))
    kept = F.array_join(F.transform(kept, lambda q: F.replace(q, F.lit("%20"), F.lit("+"))), "&")
    front = F.when(scheme(url) != "", F.concat(scheme(url), F.lit("://"), host(url))).otherwise(F.when(host(url) != "", F.concat(F.lit("//"), host(url))).otherwise(""))
    return F.concat(front, p, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(""))


def basename(url: Column) -> Column:
    return F.regexp_extract(_decode(path(url)), r"([^/]*)/?$", 1)


def extension(url: Column) -> Column:
    """Lower-cased extension of the last part of the path, without the dot; empty if none."""
    return F.lower(F.regexp_extract(basename(url), r"^.+\.([^.]+)$", 1))


def is_document(url: Column) -> Column:
    return F.coalesce(F.lower(path(url)).rlike(r"\.(" + "|".join(DOCUMENT_EXTENSIONS) + ")$"), F.lit(False))


def within(name: Column, domains: list[str]) -> Column:
    """Whether a host is one of the domains or below one."""
    hit = F.lit(False)
    for d in domains:
        hit = hit | (name == d) | name.endswith("." + d)
    return F.coalesce(hit, F.lit(False))


def link_kind(url: Column, source_host: Column, domains: list[str]) -> Column:
    return F.when(is_document(url), "attachment").when(host(url) == source_host, "internal").when(within(host(url), domains), "institutional").otherwise("external")


def resolve(base: Column, href: Column) -> Column:
    """Absolute URL of a reference: absolute, ``//host``, ``/path``, ``?query``, ``#fragment`` and relative forms without dot segments."""
    front = F.concat(scheme(base), F.lit("://"), host(base))
    folder = F.regexp_replace(path(base), r"[^/]*$", "")
    folder = F.when(folder == "", "/").otherwise(folder)
    bare = F.regexp_replace(base, r"[?#].*$", "")
    return (
        F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme(base), F.lit(":"), href))
        .when(href.startswith("/"), F.concat(front, href))
        .when(href.startswith("?"), F.concat(bare, href))
        .when(href.startswith("#") | (href == ""), F.concat(F.regexp_replace(base, r"#.*$", ""), href))
        .otherwise(F.concat(front, folder, F.regexp_replace(href, r"^\./", "")))
    )


def media_type(value: Column) -> Column:
    """Media type without parameters, lower-cased."""
    return F.lower(F.trim(F.split(value, ";")[0]))


def content_class(mime: Column, ext: Column, known: list[str]) -> Column:
    """How a response tells that it is a document: by its type, by its name, or not."""
    kind = media_type(mime)
    named = ext.isin(*DOCUMENT_EXTENSIONS)
    return (
        F.when(kind.isin(*known), "supported_mime")
        .when((kind == "application/octet-stream") & named, "octet_stream_with_extension")
        .when((F.coalesce(kind, F.lit("")) == "") & named, "missing_mime_with_extension")
        .otherwise("unsupported")
    )


def magic_matches(head: Column, ext: Column) -> Column:
    """Whether a file's first bytes are those of its extension."""
    h = F.hex(F.substring(head, 1, 8))
    zipped = h.rlike("^504B(0304|0506|0708)")
    return F.when(ext == "pdf", h.startswith("255044462D")).when(ext.isin(*OFFICE_ZIP, "zip"), zipped).when(ext.isin(*OFFICE_OLD), h == "D0CF11E0A1B11AE1").otherwise(F.lit(False))


def total_size(content_range: Column, content_length: Column, status: Column) -> Column:
    """Size of a file from the headers of a ranged request."""
    ranged = F.try_to_number(F.nullif(F.regexp_extract(content_range, r"/(\d+)$", 1), F.lit("")), F.lit("9999999999999999")).cast("long")
    return F.coalesce(ranged, F.when(status == 200, content_length.try_cast("long")))
