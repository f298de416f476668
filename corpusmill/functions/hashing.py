"""Hashes and small structures, Column to Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sha256(c: Column) -> Column:
    return F.sha2(c, 256)


def fields_hash(*fields: Column) -> Column:
    """Of fields joined by line feeds, nulls as empty."""
    return F.sha2(F.concat_ws("\n", *[F.coalesce(f.cast("string"), F.lit("")) for f in fields]), 256)


def json_hash(**fields: Column) -> Column:
    """Of the compact JSON object with sorted keys; nulls are kept."""
    return F.sha2(F.to_json(F.struct(*[fields[k].alias(k) for k in sorted(fields)]), {"ignoreNullFields": "false"}), 256)


def duplicate_key(name: Column, size: Column, mime: Column) -> Column:
    """Id of files that look the same by their metadata; null where name or size is missing."""
    key = F.concat_ws("|", F.lower(name), size.cast("string"), F.lower(F.coalesce(mime, F.lit(""))))
    return F.when((name != "") & size.isNotNull(), F.concat(F.lit("duplicate:"), F.substring(F.sha2(key, 256), 1, 16)))


def unique_in_order(values: Column) -> Column:
    """Values of an array without blanks and repetitions, in order of their first occurrence."""
    trimmed = F.transform(values, lambda v: F.trim(v))
    return F.array_distinct(F.filter(trimmed, lambda v: v.isNotNull() & (v != "")))


def without_nulls(entries: Column) -> Column:
    return F.map_filter(entries, lambda k, v: v.isNotNull())


def known(value: Column, unknown: str = "unknown") -> Column:
    return F.coalesce(F.nullif(value, F.lit("")), F.lit(unknown))
