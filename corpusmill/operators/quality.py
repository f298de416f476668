"""Data-quality rules as data: every rule is a condition with a severity and a name, all checked in one scan."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from .grouping import duplicate_groups, sequence_errors


@dataclass(frozen=True)
class Rule:
    name: str
    severity: str
    broken: Column
    detail: Column | None = None


def check(df: DataFrame, rules: list[Rule], id_cols: list[str]) -> DataFrame:
    """(ids, severity, issue_type, detail): one row per row and broken rule; a condition that is null isn't broken."""
    found = [
        F.when(F.coalesce(r.broken, F.lit(False)), F.struct(F.lit(r.severity).alias("severity"), F.lit(r.name).alias("issue_type"), (F.lit(None) if r.detail is None else r.detail).cast("string").alias("detail")))
        for r in rules
    ]
    broken = F.filter(F.array(*found), lambda x: x.isNotNull())
    return df.select(*id_cols, F.explode(broken).alias("i")).select(*id_cols, "i.*")


def prepare_chunks(df: DataFrame) -> DataFrame:
    """Columns that several rules use, each computed once."""
    context = F.filter(F.transform(F.coalesce("context_path", F.array().cast("array<string>")), lambda c: F.trim(c)), lambda c: c != "")
    df = df.withColumn("_text", F.coalesce("text", F.lit(""))).withColumn("_title", F.coalesce("title", F.lit("")))
    df = df.withColumn("_words", T.word_count(F.col("_text"))).withColumn("_context", F.array_join(context, " > "))
    return df.withColumn("_grams", F.when(F.col("_words") >= 50, T.ngrams(F.col("_text"), 5)))


def chunk_rules() -> list[Rule]:
    """Rules on rows of ``prepare_chunks``."""
    text, title, words = F.col("_text"), F.col("_title"), F.col("_words")
    has = text != ""
    embedding = F.concat_ws("\n\n", title, F.nullif(F.col("_context"), F.lit("")), text)
    blank = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    return [
        Rule("missing_chunk_id", "error", blank("id")),
        Rule("missing_document_id", "error", blank("document_id")),
        Rule("empty_text", "error", ~has),
        Rule("text_hash_mismatch", "error", has & ~F.sha2(text, 256).eqNullSafe(F.col("text_sha256"))),
        Rule("char_count_mismatch", "error", has & ~F.length(text).eqNullSafe(F.col("char_count")), F.length(text)),
        Rule("word_count_mismatch", "error", has & ~words.eqNullSafe(F.col("word_count")), words),
        Rule("control_characters_in_text", "error", has & text.rlike(T.CONTROL)),
        Rule("html_tag_in_text", "warning", has & text.rlike(T.HTML_TAG)),
        Rule("html_entity_in_text", "warning", has & text.rlike(T.HTML_ENTITY)),
        Rule("very_short_chunk", "warning", has & (words < 20), words),
        # texts of 50 words whose figures and letters make fewer than 20 tokens have too few 5-grams to tell
        Rule("high_internal_repetition", "warning", (F.size("_grams") >= 16) & (F.size(F.array_distinct("_grams")) < 0.5 * F.size("_grams"))),
        Rule("embedding_text_mismatch", "error", ~embedding.eqNullSafe(F.col("embedding_text"))),
        Rule("empty_title", "error", F.trim(title) == ""),
        Rule("title_contains_newline", "warning", F.contains(title, F.lit("\n"))),
        Rule("title_contains_underscore", "warning", F.contains(title, F.lit("_"))),
        Rule("generic_title", "warning", F.trim(title).rlike(T.GENERIC_TITLE)),
        Rule("invalid_or_missing_url", "error", ~F.coalesce(F.col("url").rlike("^https?://"), F.lit(False))),
        Rule("missing_language", "warning", blank("language")),
        Rule("chunk_number_mismatch", "error", F.col("chunk_number") != F.col("chunk_index") + 1),
    ]


def audit_chunks(chunks: DataFrame) -> DataFrame:
    """(issue_type, severity, id, document_id, detail) of all rules on chunks, those on groups included."""
    rows = check(prepare_chunks(chunks), chunk_rules(), ["id", "document_id"]).select("issue_type", "severity", "id", "document_id", "detail")
    twice = duplicate_groups(chunks.filter("id != ''"), "id").select(
        F.lit("duplicate_chunk_id").alias("issue_type"), F.lit("error").alias("severity"), "id", F.lit(None).cast("string").alias("document_id"), F.col("n").cast("string").alias("detail")
    )
    wrong = sequence_errors(chunks.filter("document_id != ''"), "document_id", "chunk_index", "chunk_count")
    kinds = F.array(F.when(F.col("sequence_error"), F.lit("document_chunk_sequence_error")), F.when(F.col("count_error"), F.lit("document_chunk_count_error")))
    groups = wrong.select(F.explode(F.filter(kinds, lambda k: k.isNotNull())).alias("issue_type"), F.lit("error").alias("severity"), F.lit(None).cast("string").alias("id"), "document_id", F.col("n").cast("string").alias("detail"))
    return rows.unionByName(twice).unionByName(groups)


def missing_fields(lines: DataFrame, value: str, required: list[str], id_cols: list[str]) -> DataFrame:
    """(ids, missing) of JSON objects without some required keys; a key whose value is null is present."""
    keys = F.json_object_keys(value)
    lost = F.array_except(F.array(*map(F.lit, required)), keys)
    return lines.select(*id_cols, lost.alias("missing")).filter(F.size("missing") > 0)


def wrong_types(lines: DataFrame, value: str, types: dict[str, str], id_cols: list[str]) -> DataFrame:
    """(ids, field) of JSON objects in which a field has another JSON type than its one in ``types`` (ARRAY, OBJECT, STRING, BIGINT, ...). Fields
    that are absent, null, false, 0 or empty count as right."""
    v = F.try_parse_json(value)
    out = []
    for name, kind in types.items():
        one = F.try_variant_get(v, f"$.{name}", "variant")
        empty = F.coalesce(F.to_json(one), F.lit("null")).isin("null", "false", "0", '""', "[]", "{}")
        out.append(F.when(~empty & ~F.startswith(F.schema_of_variant(one), F.lit(kind)), F.lit(name)))
    return lines.select(*id_cols, F.explode(F.filter(F.array(*out), lambda x: x.isNotNull())).alias("field"))


def require(issues: DataFrame) -> None:
    """Raise if there is an issue of severity error: the gate at the end of a run."""
    bad = issues.filter("severity = 'error'").groupBy("issue_type").count().orderBy("issue_type").limit(100).collect()
    if bad:
        raise ValueError("quality gate: " + ", ".join(f"{r['issue_type']} {r['count']}" for r in bad))
