"""Text functions, Column to Column: they stay inside whole-stage code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Word lists and patterns that results depend on.
POLISH_WORDS = (
    "aby", "albo", "bardzo", "bez", "będzie", "być", "dla", "do", "jest", "które", "który", "na", "nie", "oraz", "po", "przez", "się", "są", "to",
    "w", "we", "z", "za", "że",
)
ENGLISH_WORDS = ("and", "are", "as", "at", "be", "by", "for", "from", "in", "is", "it", "of", "on", "or", "that", "the", "this", "to", "with")
POLISH_MARKS = "ąćęłńóśźż"
ABBREVIATIONS = ("np.", "nr.", "art.", "ust.", "pkt.", "poz.", "r.", "dr.", "prof.", "mgr.", "inż.", "e.g.", "i.e.")
SENTENCE_BREAK = r'(?<=[.!?…])\s+(?=[A-ZĄĆĘŁŃÓŚŹŻ0-9„"(§])'
#: The same for engines without look-around: the end and the beginning as groups.
SENTENCE_BREAK_PAIR = r'([.!?…])\s+([A-ZĄĆĘŁŃÓŚŹŻ0-9„"(§])'
LIST_ITEM = r"(?i)^(?:[-*•▪◦–—]|(?:\d+|[A-Za-z]|[IVXLCDM]+)[.)]|§\s*\d+)"
NUMBERED_HEADING = r"(?i)^(?:\d+(?:\.\d+){0,5}[.)]?|§\s*\d+)\s+\S+"
GENERIC_LABEL = r"(?i)^(?:strona|page|slajd|slide|arkusz|sheet)\s+\d+$"
GENERIC_TITLE = r"(?i)^(?:document|dokument|plik|attachment|załącznik|page|strona|untitled|bez tytułu|\d+)$"
CONTROL = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]"
HTML_TAG = r"<[A-Za-z!/][^>]*>"
HTML_ENTITY = r"&(?:nbsp|amp|lt|gt|quot|apos|#[0-9]+|#x[0-9A-Fa-f]+);"

#: Blanks of any script but the line feed.
BLANK = r"[ \t\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\u0085]"


#: The same as a string, for trimming, which is far quicker than a pattern of many ranges.
BLANKS = " \t\u00a0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000\u0085"


def _squeeze_lines(c: Column) -> Column:
    c = F.regexp_replace(c, r"[ \t]{2,}|\t", " ")
    c = F.array_join(F.transform(F.split(c, "\n"), lambda line: F.trim(line, F.lit(BLANKS))), "\n")
    return F.regexp_replace(c, "\n{3,}", "\n\n")


def _strip(c: Column) -> Column:
    return F.trim(c, F.lit("\n" + BLANKS))


def normalize_text(c: Column) -> Column:
    """Control characters out, line ends to line feeds, blanks and blank lines squeezed, edges stripped. Null stays null."""
    c = F.regexp_replace(c, r"\x00", "")
    c = F.regexp_replace(c, r"[\x01-\x08\x0b\x0c\x0e-\x1f\x7f]", " ")
    c = F.regexp_replace(c, "\r\n|\r", "\n")
    return _strip(_squeeze_lines(c))


def normalize_extracted(c: Column) -> Column:
    """As ``normalize_text`` for text taken from files: NUL and tab are blanks."""
    return normalize_text(F.translate(c, "\x00\t", "  "))


def normalize_page(c: Column) -> Column:
    """As ``normalize_text`` for web pages: no-break spaces are blanks, all Unicode line separators end a line."""
    c = F.translate(c, "\u00a0", " ")
    c = F.regexp_replace(c, "\r\n", "\n")
    return _strip(_squeeze_lines(F.regexp_replace(c, r"[\r\x0b\x0c\x1c-\x1e\u0085\u2028\u2029]", "\n")))


def word_count(c: Column) -> Column:
    """Runs of characters that are no white space."""
    return F.regexp_count(c, F.lit(r"(?U)\S+"))


def token_count(c: Column) -> Column:
    """Runs of word characters, apostrophes and hyphens that begin and end with a word character."""
    return F.regexp_count(c, F.lit(r"(?U)\b[\wÀ-ž'-]+\b"))


def clean_title(c: Column, fallback: str = "Bez tytułu") -> Column:
    """Underscores to blanks, one line, edges without dashes; ``fallback`` where nothing is left."""
    c = F.regexp_replace(F.translate(normalize_text(c), "_", " "), r"(?U)\s+", " ")
    c = F.regexp_replace(F.regexp_replace(c, r"^[ \-–—_]+", ""), r"[ \-–—_]+$", "")
    return F.coalesce(F.nullif(c, F.lit("")), F.lit(fallback))


def unit_key(c: Column) -> Column:
    """Key under which two units of text are the same."""
    return _strip(F.regexp_replace(F.lower(normalize_text(c)), r"(?U)\s+", " "))


def merge_blocks(*parts: Column) -> Column:
    """Blocks (between blank lines) of all parts, first occurrences only."""
    blocks = F.flatten(F.array(*[F.split(F.coalesce(normalize_page(p), F.lit("")), "\n\n") for p in parts]))
    return F.array_join(F.array_distinct(F.filter(blocks, lambda b: F.trim(b) != "")), "\n\n")


def safe_filename(c: Column) -> Column:
    c = F.regexp_replace(F.regexp_replace(c, r"[\\/]", "_"), r"[\x00-\x1f\x7f]+", "_")
    return F.regexp_replace(F.regexp_replace(c, r"^[ .]+", ""), r"[ .]+$", "")


def stem_title(filename: Column) -> Column:
    """Title from a file's name: without extension, underscores and hyphens as blanks."""
    stem = F.regexp_replace(filename, r"(?<=.)\.[^.]*$", "")
    return F.trim(F.regexp_replace(F.regexp_replace(stem, r"[_-]+", " "), r"\s+", " "))


def detect_language(c: Column, most_chars: int = 12_000) -> Column:
    """pl, en, pl-en or null by function words and Polish letters of the first ``most_chars`` characters."""
    head = F.lower(F.substring(F.coalesce(c, F.lit("")), 1, most_chars))
    words = F.regexp_extract_all(head, F.lit(r"([A-Za-zÀ-ž]+)"), F.lit(1))

    def hits(known):
        return F.size(F.filter(words, lambda w: w.isin(*known))).cast("double")

    marks = (F.length(head) - F.length(F.translate(head, POLISH_MARKS, ""))).cast("double")
    pl, en = hits(POLISH_WORDS) + marks * F.lit(0.35), hits(ENGLISH_WORDS)
    return F.when((pl == 0) & (en == 0), F.lit(None)).when(pl >= en * 1.25, "pl").when(en >= pl * 1.25, "en").otherwise("pl-en")


def is_list_item(line: Column) -> Column:
    return line.rlike(LIST_ITEM)


def looks_like_heading(line: Column) -> Column:
    """Short lines that head what follows, by form alone."""

    def by_form(line: Column) -> Column:
        words = word_count(line)
        letters, upper = F.length(F.regexp_replace(line, r"\P{L}", "")), F.length(F.regexp_replace(line, r"\P{Lu}", ""))
        loud = (letters > 0) & (upper >= 0.72 * letters) & (words >= 2)
        short = (F.length(line) <= 180) & (line != "") & (words <= 18)
        form = F.when(line.rlike(NUMBERED_HEADING), True).when(line.endswith(":") & (words <= 14), True).when(line.rlike(r"[.!?;,]$"), False)
        return short & ~line.rlike(LIST_ITEM) & form.when(loud, True).otherwise(line.rlike(r"^\p{Lu}") & (words <= 10))

    return F.coalesce(let(_strip(line), by_form), F.lit(False))


def split_sentences(c: Column) -> Column:
    """Sentences of a text; full stops of known abbreviations don't end one, wherever they stand. Null and empty texts have none."""
    mark = "\u241f"
    held = c
    for a in ABBREVIATIONS:
        held = F.regexp_replace(held, "(?i)" + a.replace(".", r"\."), a.replace(".", mark))
    parts = F.transform(F.split(held, SENTENCE_BREAK), lambda s: F.trim(F.translate(s, mark, ".")))
    return F.filter(parts, lambda s: s != "")


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once: inside a lambda an expression would be computed for every element."""
    return F.transform(F.array(value), use)[0]


def ngrams(c: Column, n: int) -> Column:
    """Array of the n-grams of lower-cased word tokens, joined by blanks; empty for fewer than n words."""
    words = F.regexp_extract_all(F.lower(c), F.lit(r"(?U)(\w+)"), F.lit(1))
    # joined to strings, which are told apart by hash; arrays of arrays would be compared one by one
    grams = lambda w: F.transform(F.sequence(F.lit(1), F.size(w) - n + 1), lambda i: F.array_join(F.slice(w, i, n), " "))
    return let(words, lambda w: F.when(F.size(w) >= n, grams(w)).otherwise(F.array().cast("array<string>")))


def unique_ngram_ratio(c: Column, n: int = 5, least: int = 20) -> Column:
    """Share of distinct n-grams; 1 for texts of fewer than ``least`` words."""
    share = lambda g: F.when((F.size(g) < least - n + 1) | (F.size(g) <= 0), F.lit(1.0)).otherwise(F.size(F.array_distinct(g)) / F.size(g))
    return let(ngrams(c, n), share)


def single_character_share(c: Column) -> Column:
    """Share of the words with one letter, figure or underscore only."""
    words = F.regexp_extract_all(c, F.lit(r"(?U)(\S+)"), F.lit(1))
    alone = F.filter(words, lambda w: F.length(F.regexp_replace(w, r"(?U)[^\wÀ-ž]", "")) == 1)
    return F.coalesce(F.try_divide(F.size(alone), F.size(words)), F.lit(0.0))


def alphabetic_share(c: Column) -> Column:
    """Share of letters among the characters that are no white space."""
    seen = F.regexp_replace(c, r"(?U)\s", "")
    return F.coalesce(F.try_divide(F.length(F.regexp_replace(seen, r"\P{L}", "")), F.length(seen)), F.lit(0.0))
