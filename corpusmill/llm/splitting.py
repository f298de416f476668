"""Cutting oversized texts at natural boundaries (problem 2).

Balanced targets: the least number of pieces that can hold the text gives equal-length targets; each target snaps to
the strongest boundary near it that keeps every piece within the limit, and pieces are added while a cut would
fall where no boundary is although the text has some. Consecutive pieces share exactly ``overlap`` words.

Scale: one pass; texts within the limit are filtered out in the JVM before Python sees a row, and only the oversized ones are
shuffled, to make rows delivered twice one.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_columns

TOKEN = re.compile(r"[^ \t\r\n]+")
_HEADING = re.compile(r"^(?:§|\d+(?:\.\d+)*\.?\s+\S|#{1,6}\s|Rozdział|Chapter|Section|Kapitel|Розділ)", re.I)
_ITEM = re.compile(r"^(?:[-*•–—▪◦]|\(?\d{1,3}[.)]|\(?[a-z][.)])$", re.I)
_END = re.compile(r"[.!?…][\"'”»)\]]*$")
_SHEET = re.compile(r"^(?:slajd|slide|arkusz|sheet|folie)\b", re.I)
#: Names of boundaries as the settings list them, with their strengths.
STRENGTH = {"page": 8, "slide": 8, "sheet": 8, "section": 7, "heading": 6, "paragraph": 5, "list": 4, "sentence": 3}
SCHEMA = "piece_no int, piece_count int, start_word int, end_word int, word_count int, cut_at string, text string"


def boundaries(text: str, spans: list[tuple[int, int]], allowed: frozenset[str]) -> dict[int, str]:
    """The strongest allowed kind of boundary before each word that has one."""
    out: dict[int, str] = {}
    short = False
    for i in range(1, len(spans)):
        gap = text[spans[i - 1][1] : spans[i][0]]
        kinds = []
        word = text[spans[i][0] : spans[i][1]]
        if "\n" in gap or "\r" in gap:
            stop = text.find("\n", spans[i][0])
            line = text[spans[i][0] : stop if stop >= 0 else len(text)].strip()
            blank = gap.count("\n") > 1
            heading = len(line) <= 120 and len(line.split()) <= 14 and not _END.search(line) and (bool(_HEADING.match(line)) or line.endswith(":") or (blank and line[:1].isupper()) or (line.isupper() and len(line) > 3))
            if _SHEET.match(line) and len(line) <= 60:
                kinds += ["slide", "sheet"]
            if heading and not short:
                kinds.append("section" if blank else "heading")
            if blank and not short:
                kinds.append("paragraph")
            if _ITEM.match(word) or word[:1] in "•▪◦":
                kinds.append("list")
            short = heading  # a heading stays with what it heads
        else:
            short = short and "\n" not in gap
        before = text[spans[i - 1][0] : spans[i - 1][1]]
        if "\f" in before or "\f" in word:
            kinds.append("page")
        if _END.search(before) and not re.fullmatch(r"\(?\w{1,3}\.", before) and not word[:1].islower():
            kinds.append("sentence")
        best = max((k for k in kinds if k in allowed), key=STRENGTH.__getitem__, default=None)
        if best:
            out[i] = best
    return out


def _place(n: int, pieces: int, limit: int, overlap: int, marks: dict[int, str]) -> list[tuple[int, int, str]] | None:
    """(start, end, kind of the cut at the end) of each piece, or None if so few pieces can't hold the text."""
    out, start = [], 0
    for left in range(pieces, 0, -1):
        rest = n - start
        if left == 1:
            return [*out, (start, n, "end")] if rest <= limit else None
        target = start + round((rest + overlap * (left - 1)) / left)
        high = min(start + limit, n - 1)
        low = max(start + overlap + 1, n - (left - 1) * limit + (left - 1) * overlap)
        if low > high:
            return None
        target = min(max(target, low), high)
        reach = max(limit // 4, 1)
        near = range(max(low, target - reach), min(high, target + reach) + 1)
        at = max((i for i in near if i in marks), key=lambda i: (STRENGTH[marks[i]] - 4 * abs(i - target) / reach, -abs(i - target)), default=None)
        if at is None:
            at = min((i for i in range(low, high + 1) if i in marks), key=lambda i: abs(i - target), default=None)
        out.append((start, at, marks[at]) if at is not None else (start, target, "word"))
        start = out[-1][1] - overlap
    return None


def split_text(text: str, limit: int, overlap: int, allowed: frozenset[str]) -> list[tuple[int, int, str, str]]:
    """(first word, word after the last, kind of cut, text) of each piece; one piece if the text fits."""
    spans = [m.span() for m in TOKEN.finditer(text)]
    n = len(spans)
    if n <= limit:
        return [(0, n, "end", text)] if n else []
    marks = boundaries(text, spans, allowed)
    least = -(-(n - overlap) // (limit - overlap))
    best, fewest = None, None
    pieces, last = least - 1, least + max(3, least // 2)
    while pieces < min(last, n):
        pieces += 1
        cuts = _place(n, pieces, limit, overlap, marks)
        if cuts is None:
            continue
        bare = sum(kind == "word" for _, _, kind in cuts)
        if fewest is None or bare < fewest:
            best, fewest = cuts, bare
            last = max(last, pieces + max(3, least // 2))  # more pieces help: go on
        if not bare or not marks:
            break
    return [(a, b, kind, text[spans[a][0] : spans[b - 1][1]]) for a, b, kind in best]


def split_oversized(
    df: DataFrame, limit: int, overlap: int, allowed: list[str] | None = None, id_col: str = "id", text_col: str = "text", keep_fitting: bool = False
) -> DataFrame:
    """(id, piece_no, piece_count, start_word, end_word, word_count, cut_at, text) of each distinct row's pieces.

    Words are runs without blank, tab or line break; ``limit`` holds for every piece including its ``overlap``
    words, which are the last of the piece before. Defined cases: null and empty texts have no pieces; texts
    within the limit have none unless ``keep_fitting``; a text without any boundary is cut between words; a row
    delivered twice is cut once; other columns are ignored. ``overlap`` must be smaller than ``limit``.
    """
    if not 0 <= overlap < limit:
        raise ValueError("overlap must be at least 0 and smaller than limit")
    kinds = frozenset(STRENGTH if allowed is None else [a for a in allowed if a in STRENGTH])
    id_type = df.schema[id_col].dataType
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter(F.col("text").isNotNull())
    if not keep_fitting:
        # n words take 2n - 1 characters at least: short texts are dropped before the words are counted
        rows = rows.filter(F.length("text") > 2 * limit).filter(F.regexp_count("text", F.lit(r"[^ \t\r\n]+")) > limit)
    rows = rows.distinct()
    arrow_id = {"bigint": pa.int64(), "int": pa.int32()}.get(id_type.simpleString(), pa.string())

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        cols: list[list] = [[] for _ in range(8)]
        for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            pieces = split_text(text, limit, overlap, kinds)
            for no, (a, b, kind, piece) in enumerate(pieces, 1):
                for col, v in zip(cols, (i, no, len(pieces), a, b, b - a, kind, piece)):
                    col.append(v)
        types = [arrow_id, *[pa.int32()] * 5, pa.string(), pa.string()]
        names = ["id", "piece_no", "piece_count", "start_word", "end_word", "word_count", "cut_at", "text"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)

    return map_columns(rows, run, f"id {id_type.simpleString()}, {SCHEMA}")


def latest_settings(status: DataFrame) -> dict:
    """The chunking settings of the complete run with the latest generated_at: one row, whatever the table's size."""
    row = status.filter(F.col("complete")).orderBy(F.desc("generated_at"), F.desc("run_id")).select("chunking").first()
    if row is None:
        raise ValueError("no complete run")
    return row["chunking"].asDict()
