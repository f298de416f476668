"""Lines repeated across one source's documents (problem 4).

Lines are parsed into templates by fixed-depth token trees: a line descends by its source, its number of tokens and one token
(the first, or the last where the first is rare) to a leaf, and joins the leaf's template with which most tokens agree; tokens that
differ become wildcard slots. A template that covers enough documents of its source, each counted once, is removed with all its lines,
whatever stands in its slots (bylines, dates, share prompts); ``lines`` are those of them that repeat enough by themselves.

A token that stands at its place in fewer documents than a template needs must be a slot of any template that is removed. Tokens are
therefore counted first, rare ones masked, and only lines of which enough is left (``likeness``) reach a tree: this loses no
template, and what is left doesn't grow with the corpus, as a place in a source has at most 1 / ``min_share`` frequent tokens a line.

Scale: texts are read once into lines with 128-bit hashes; only distinct lines are shuffled with their letters; documents are counted
from (line, document) hashes. Leaves with many forms are grown in parts, whose trees are merged.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.grouping import bounded_broadcast, delivered_once
from .common import cut

SLOT = "▫"
PART_FORMS = 5000


def line_key(line):
    """Letters of a line without case, any run of other characters as one blank (a column)."""
    return F.trim(F.regexp_replace(F.lower(line), r"[^\p{L}]+", " "))


class Leaf:
    """Templates of one leaf, found by the constants that they share with a line."""

    def __init__(self, likeness: float, min_letters: int):
        self.likeness, self.min_letters = likeness, min_letters
        self.templates: list[list[str]] = []
        self.by_token: dict[tuple[int, str], list[int]] = defaultdict(list)

    def insert(self, tokens: list[str]) -> int:
        """The number of the template that the tokens join: the one with most equal constants, the eldest of equals. They join
        only if the constants that stay are enough: ``likeness`` of the tokens and ``min_letters`` letters."""
        shared: Counter[int] = Counter()
        for place in enumerate(tokens):
            if place[1] != SLOT:
                shared.update(self.by_token.get(place, ()))
        for k, same in sorted(shared.items(), key=lambda x: (-x[1], x[0])):
            if same < self.likeness * len(tokens):
                break
            merged = [a if a == b else SLOT for a, b in zip(self.templates[k], tokens)]
            if sum(len(t) for t in merged if t != SLOT) >= self.min_letters:
                for place in enumerate(self.templates[k]):
                    if place[1] != SLOT and merged[place[0]] == SLOT:
                        self.by_token[place].remove(k)
                self.templates[k] = merged
                return k
        k = len(self.templates)
        self.templates.append(tokens)
        for place in enumerate(tokens):
            if place[1] != SLOT:
                self.by_token[place].append(k)
        return k


def _grow(forms: DataFrame, likeness: float, min_letters: int) -> DataFrame:
    """(leaf, form, template) of ``forms(leaf, part, form, docs)``: the template that the form has once the whole part of its leaf is
    read, forms of most documents first."""

    def run(batches):
        at, leaf, held = None, None, []

        def out():
            cols = zip(*((at[0], form, " ".join(leaf.templates[k])) for form, k in held))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.string(), pa.string()))], names=["leaf", "form", "template"])

        for batch in batches:
            for number, part, form in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if (number, part) != at:
                    if held:
                        yield out()
                    at, leaf, held = (number, part), Leaf(likeness, min_letters), []
                held.append((form, leaf.insert(form.split(" "))))
        if held:
            yield out()

    rows = forms.repartition("leaf", "part").sortWithinPartitions("leaf", "part", F.desc("docs"), "form")
    return rows.select("leaf", "part", "form").mapInArrow(run, "leaf long, form string, template string")


def grow_trees(forms: DataFrame, likeness: float, min_letters: int, part_forms: int = PART_FORMS) -> DataFrame:
    """(leaf, form, template) of ``forms(leaf, form, docs)``. Leaves of more than ``part_forms`` forms are grown in parts; the
    trees of the parts are then merged, template by template."""
    sizes = forms.groupBy("leaf").agg(F.ceil(F.count("*") / part_forms).alias("parts"))
    grown = cut(_grow(forms.join(sizes, "leaf").withColumn("part", F.pmod(F.xxhash64("form"), F.col("parts"))), likeness, min_letters))
    split = sizes.filter("parts > 1").select("leaf")
    again = grown.join(split, "leaf", "left_semi").join(forms, ["leaf", "form"])
    again = again.groupBy("leaf", F.col("template").alias("form")).agg(F.sum("docs").alias("docs")).withColumn("part", F.lit(0))
    merged = _grow(again, likeness, min_letters).withColumnRenamed("template", "merged").withColumnRenamed("form", "template")
    return cut(grown.join(merged, ["leaf", "template"], "left").select("leaf", "form", F.coalesce("merged", "template").alias("template")))


def _templates(keys: DataFrame, likeness: float, min_letters: int) -> DataFrame:
    """(h1, h2, source, template) of the lines ``keys(h1, h2, source, line, docs, need)`` that have a template."""
    words = F.split("line", " ")
    place = lambda i, token: F.xxhash64("source", F.col("n"), i, token)
    rows = keys.withColumn("n", F.size(words))
    rows = rows.withColumn("first", place(F.lit(0), F.element_at(words, 1))).withColumn("last", place(F.lit(-1), F.element_at(words, -1)))
    enough = lambda df, c: bounded_broadcast(cut(df.groupBy(c).agg(F.sum("docs").alias("all"), F.max("need").alias("most")).filter(F.col("all") >= F.col("most")).select(c)))
    ends = enough(rows.select(F.explode(F.array("first", "last")).alias("end"), "docs", "need"), "end")
    rows = rows.join(ends.select(F.col("end").alias("first"), F.lit(1).alias("_f")), "first", "left").join(ends.select(F.col("end").alias("last"), F.lit(1).alias("_l")), "last", "left")
    rows = rows.withColumn("leaf", F.when(F.col("_f") == 1, F.col("first")).when(F.col("_l") == 1, F.col("last"))).filter("leaf is not null")
    rows = cut(rows.select("h1", "h2", "source", "line", "docs", "need", "n", "leaf"))
    tokens = rows.select("h1", "h2", "source", "n", "docs", "need", F.posexplode(words).alias("i", "token")).select("h1", "h2", "n", "docs", "need", "i", place(F.col("i"), F.col("token")).alias("token"))
    often = tokens.join(enough(tokens, "token"), "token").groupBy("h1", "h2", "n").agg(F.collect_list("i").alias("kept")).filter(F.size("kept") >= F.col("n") * likeness)
    form = F.array_join(F.transform(words, lambda w, i: F.when(F.array_contains("kept", i), w).otherwise(SLOT)), " ")
    masked = rows.join(often.select("h1", "h2", "kept"), ["h1", "h2"]).select("h1", "h2", "source", "leaf", "docs", form.alias("form"))
    masked = cut(masked.filter(F.length(F.translate("form", SLOT + " ", "")) >= min_letters))
    trees = grow_trees(masked.groupBy("leaf", "form").agg(F.sum("docs").alias("docs")), likeness, min_letters)
    return cut(masked.join(trees, ["leaf", "form"]).select("h1", "h2", "source", "template"))


def repeated_lines(
    df: DataFrame, id_col: str = "id", text_col: str = "text", doc_col: str = "document_id", source_col: str = "source_id",
    min_docs: int = 5, min_share: float = 0.04, min_letters: int = 10, likeness: float = 0.65,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(covered, lines, templates)``: (id, line_no) of each line of a removed template; (id, line_no) of those that repeat enough
    by themselves; and (source, template, key, docs, need, template_docs) of the lines that do, with the template that covers them and
    the documents it covers. A removed template none of whose lines repeats enough itself has one row, without key and docs.

    Defined cases: null ids, texts or documents give no lines; a null source is a source of its own; empty lines
    count for the numbering and never repeat; a line counts once per document; rows delivered twice count once;
    an empty table gives empty results; other columns are ignored. Documents of a source count even where their text
    is null.
    """
    rows = df.select(
        F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"), F.col(doc_col).cast("string").alias("doc"),
        F.coalesce(F.col(source_col).cast("string"), F.lit("\u0000")).alias("source"),
    ).filter("doc is not null")
    sizes = rows.select("source", "doc").distinct().groupBy("source").agg(F.count("*").alias("all_docs"))
    need = sizes.select("source", F.greatest(F.lit(min_docs), F.ceil(F.col("all_docs") * F.lit(min_share) - F.lit(1e-9))).alias("need"))
    lines = cut(
        rows.filter("id is not null and text is not null")
        .select("id", "doc", "source", F.posexplode(F.split("text", "\n", -1)).alias("at", "line"))
        .filter(F.length("line") >= min_letters)
        .withColumn("key", line_key(F.col("line")))
        .filter(F.length(F.replace(F.col("key"), F.lit(" "), F.lit(""))) >= min_letters)
        # 128 bits stand for a line of a source wherever its letters aren't needed
        .select("id", (F.col("at") + 1).cast("long").alias("line_no"), "source", "key", F.xxhash64("source", "key").alias("h1"), F.xxhash64(F.lit(77), "key", "source").alias("h2"),
                F.xxhash64("doc").alias("d1"), F.hash("doc", F.lit(7)).alias("d2"))
    )
    per_doc = cut(lines.select("h1", "h2", "d1", "d2").distinct())
    counts = per_doc.groupBy("h1", "h2").agg(F.count("*").alias("docs"))
    keys = lines.groupBy("h1", "h2").agg(F.min(F.struct("source", F.col("key").alias("line"))).alias("r")).select("h1", "h2", "r.*")
    keys = cut(keys.join(counts, ["h1", "h2"]).join(bounded_broadcast(cut(need)), "source"))
    t1, t2 = F.xxhash64("source", "template").alias("t1"), F.xxhash64(F.lit(77), "template", "source").alias("t2")
    parsed = _templates(keys, likeness, min_letters).select("*", t1, t2).join(keys.select("h1", "h2", F.col("line").alias("key"), "docs", "need"), ["h1", "h2"])
    parsed = cut(parsed)
    # no template covers more documents than its lines together: documents are counted only where those are enough
    wide = parsed.groupBy("t1", "t2").agg(F.count("*").alias("n"), F.sum("docs").alias("together"), F.max("docs").alias("most"), F.max("need").alias("need"))
    wide = cut(wide.filter("together >= need"))
    several = parsed.join(wide.filter("n > 1").select("t1", "t2"), ["t1", "t2"]).select("t1", "t2", "h1", "h2").join(per_doc, ["h1", "h2"])
    several = several.select("t1", "t2", "d1", "d2").distinct().groupBy("t1", "t2").agg(F.count("*").alias("covered"))
    covers = wide.join(several, ["t1", "t2"], "left").withColumn("template_docs", F.coalesce("covered", "together"))
    removed = cut(parsed.join(covers.filter("template_docs >= need").select("t1", "t2", "most", "template_docs"), ["t1", "t2"]))
    own = removed.filter("docs >= need").select("source", "template", "key", "docs", "need", "template_docs")
    slots = removed.filter("most < need").select("source", "template", F.lit(None).cast("string").alias("key"), F.lit(None).cast("long").alias("docs"), "need", "template_docs").distinct()
    stand = lambda which: lines.select("id", "line_no", "h1", "h2").join(bounded_broadcast(which.select("h1", "h2")), ["h1", "h2"], "left_semi").select("id", "line_no").distinct()
    return stand(removed), stand(removed.filter("docs >= need")), own.unionByName(slots)


def without_lines(df: DataFrame, gone: DataFrame, id_col: str = "id", text_col: str = "text") -> DataFrame:
    """(id, text) of each distinct row with a text, the lines (id, line_no) taken out; nothing else changes."""
    rows = df.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text")).filter("id is not null and text is not null")
    gone = gone.groupBy("id").agg(F.collect_set("line_no").alias("gone"))
    kept = F.filter(F.split("text", "\n", -1), lambda x, i: ~F.array_contains("gone", (i + 1).cast("long")))
    return delivered_once(rows, "id").join(gone, "id", "left").select("id", F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text"))
