"""The queries pN_... of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import languages, leakage, mixing, near_duplicates, quality, repeated_lines, scans, splitting
from .common import table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    members, _ = near_duplicates.near_duplicates(table(spark, d, "chunks"), every_link=False)
    return near_duplicates.group_pairs(members)


def p1_groups(spark: SparkSession, d: str) -> DataFrame:
    members, _ = near_duplicates.near_duplicates(table(spark, d, "chunks"))
    return members.select("id", F.hex("group_id").alias("group_id"), "n_links")


def _pieces(spark: SparkSession, d: str) -> DataFrame:
    s = splitting.latest_settings(table(spark, d, "rag_corpus_status"))
    return splitting.split_oversized(table(spark, d, "chunks"), s["target_words"], s["requested_overlap_words"], s["natural_boundaries"])


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return _pieces(spark, d).filter("piece_count > 1 and piece_no = 1").select("id").distinct()


def p2_pieces(spark: SparkSession, d: str) -> DataFrame:
    return _pieces(spark, d)


def _languages(spark: SparkSession, d: str) -> DataFrame:
    return languages.identify(table(spark, d, "chunks"), table(spark, d, "common_words"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    found = _languages(spark, d).filter("label_state != 'right'")
    return found.select("id", F.explode("langs").alias("lang")).distinct()


def p3_passages(spark: SparkSession, d: str) -> DataFrame:
    return _languages(spark, d).select("id", "label", F.posexplode("passages").alias("passage_no", "p")).select("id", "label", "passage_no", "p.*")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return repeated_lines.repeated_lines(table(spark, d, "chunks"))[1]


def p4_templates(spark: SparkSession, d: str) -> DataFrame:
    return repeated_lines.repeated_lines(table(spark, d, "chunks"))[2]


def p4_clean(spark: SparkSession, d: str) -> DataFrame:
    chunks = table(spark, d, "chunks")
    return repeated_lines.without_lines(chunks, repeated_lines.repeated_lines(chunks)[0])


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return scans.repair(table(spark, d, "chunks"), table(spark, d, "text_index"))[0]


def p5_text(spark: SparkSession, d: str) -> DataFrame:
    return scans.repair(table(spark, d, "chunks"), table(spark, d, "text_index"))[1]


def _spans(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leaked_spans(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return _spans(spark, d).select("doc_id", "item_id").distinct()


def p6_spans(spark: SparkSession, d: str) -> DataFrame:
    return _spans(spark, d).withColumn("item_share", F.round("item_share", 6))


def p6_clean(spark: SparkSession, d: str) -> DataFrame:
    return leakage.without_spans(table(spark, d, "documents"), _spans(spark, d))


def p7_mix(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix_sources(table(spark, d, "documents"), table(spark, d, "mix_targets"))[0]


def p7_positions(spark: SparkSession, d: str) -> DataFrame:
    return mixing.curriculum(mixing.mix_sources(table(spark, d, "documents"), table(spark, d, "mix_targets"))[1])


def _types(spark: SparkSession, d: str) -> DataFrame:
    return quality.text_types(table(spark, d, "documents"), table(spark, d, "common_words"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return _types(spark, d).filter("form != 'prose'").select("doc_id", "form").distinct()


def p8_statistics(spark: SparkSession, d: str) -> DataFrame:
    return _types(spark, d).drop("votes")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "p1_found": p1_found, "p1_groups": p1_groups,
        "p2_found": p2_found, "p2_pieces": p2_pieces,
        "p3_found": p3_found, "p3_passages": p3_passages,
        "p4_found": p4_found, "p4_templates": p4_templates, "p4_clean": p4_clean,
        "p5_found": p5_found, "p5_text": p5_text,
        "p6_found": p6_found, "p6_spans": p6_spans, "p6_clean": p6_clean,
        "p7_mix": p7_mix, "p7_positions": p7_positions,
        "p8_found": p8_found, "p8_statistics": p8_statistics,
    }


_LEAKS = r"""
    WITH i AS (SELECT item_id, regexp_extract_all(replace(strip_accents(lower(text)), 'ł', 'l'), '[\p{L}\p{N}]+') AS w FROM eval_items WHERE text IS NOT NULL),
    d AS (SELECT DISTINCT doc_id, regexp_extract_all(replace(strip_accents(lower(text)), 'ł', 'l'), '[\p{L}\p{N}]+') AS w FROM documents WHERE text IS NOT NULL),
    gi AS (SELECT DISTINCT item_id, unnest(list_transform(range(1, greatest(len(w) - 10, 1)), lambda k: array_to_string(w[k:k + 11], ' '))) AS g FROM i),
    gd AS (SELECT doc_id, unnest(list_transform(range(1, greatest(len(w) - 10, 1)), lambda k: array_to_string(w[k:k + 11], ' '))) AS g FROM d)
    SELECT DISTINCT doc_id, item_id FROM gd JOIN gi USING (g)"""
_SPANS = r"""
    WITH i AS (SELECT DISTINCT item_id, regexp_extract_all(replace(strip_accents(lower(text)), 'ł', 'l'), '[\p{L}\p{N}]+') AS w FROM eval_items WHERE text IS NOT NULL),
    d AS (SELECT DISTINCT doc_id, regexp_extract_all(replace(strip_accents(lower(text)), 'ł', 'l'), '[\p{L}\p{N}]+') AS w FROM documents WHERE text IS NOT NULL),
    gi AS (SELECT item_id, len(w) AS size, unnest(range(1, greatest(len(w) - 10, 1))) AS p, unnest(list_transform(range(1, greatest(len(w) - 10, 1)), lambda k: array_to_string(w[k:k + 11], ' '))) AS g FROM i),
    gd AS (SELECT doc_id, unnest(range(1, greatest(len(w) - 10, 1))) AS q, unnest(list_transform(range(1, greatest(len(w) - 10, 1)), lambda k: array_to_string(w[k:k + 11], ' '))) AS g FROM d),
    m AS (SELECT doc_id, item_id, size, q, q - p AS off, q - row_number() OVER (PARTITION BY doc_id, item_id, q - p ORDER BY q) AS island FROM gd JOIN gi USING (g)),
    r AS (SELECT DISTINCT doc_id, item_id, size, min(q) - 1 AS a, max(q) + 11 AS z FROM m GROUP BY doc_id, item_id, size, off, island)
    SELECT doc_id, item_id, CAST(a AS INTEGER) AS start_word, CAST(z AS INTEGER) AS end_word, CAST(z - a AS INTEGER) AS n_words, round(CAST(z - a AS DOUBLE) / size, 6) AS item_share FROM r
    WHERE NOT EXISTS (SELECT 1 FROM r o WHERE o.doc_id = r.doc_id AND o.item_id = r.item_id AND o.a <= r.a AND o.z >= r.z AND (o.a < r.a OR o.z > r.z))"""
_LINES = r"""
    WITH c AS (SELECT DISTINCT id, document_id, source_id, text FROM chunks), a AS (SELECT source_id, count(DISTINCT document_id) AS n FROM c GROUP BY 1),
    l AS (SELECT id, document_id, source_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS line_no FROM c WHERE text IS NOT NULL),
    k AS (SELECT *, trim(regexp_replace(lower(line), '[^\p{L}]+', ' ', 'g')) AS key FROM l),
    s AS (SELECT source_id, key, count(DISTINCT document_id) AS docs FROM k WHERE length(replace(key, ' ', '')) >= 10 GROUP BY 1, 2)
    SELECT DISTINCT k.id, k.line_no FROM k JOIN s ON k.key = s.key AND k.source_id IS NOT DISTINCT FROM s.source_id JOIN a ON a.source_id IS NOT DISTINCT FROM s.source_id
    WHERE s.docs >= 5 AND s.docs >= 0.04 * a.n"""
_GROUPS = r"""
    WITH RECURSIVE w AS (SELECT DISTINCT id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM chunks WHERE text IS NOT NULL),
    g AS (SELECT DISTINCT id, unnest(list_transform(range(1, len(w) - 1), lambda k: hash(array_to_string(w[k:k + 2], ' ')))) AS g FROM w WHERE len(w) >= 40),
    n AS (SELECT id, count(*) AS n FROM g GROUP BY 1),
    p AS (SELECT x.id AS a, y.id AS b, count(*) AS both_ FROM g x JOIN g y ON x.g = y.g AND x.id < y.id GROUP BY 1, 2),
    l AS (SELECT a, b FROM p JOIN n x ON x.id = a JOIN n y ON y.id = b WHERE both_ >= 0.6 * (x.n + y.n - both_)),
    e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
    r(a, b) AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
    SELECT a AS id_a, b AS id_b FROM r WHERE a < b"""


def oracle_sql() -> dict[str, str]:
    return {
        "p1_found": _GROUPS, "p4_found": _LINES, "p6_found": _LEAKS, "p6_spans": _SPANS,
        "p2_found": """
            SELECT DISTINCT id FROM chunks
            WHERE len(regexp_extract_all(text, '[^ \\t\\r\\n]+')) > (
                SELECT chunking.target_words FROM rag_corpus_status WHERE complete ORDER BY generated_at DESC LIMIT 1)
        """,
    }
