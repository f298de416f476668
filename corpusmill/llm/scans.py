"""Repair of text from scanned pages (problem 5).

Three boosted models decide, each trained on cases that tell themselves:

* line pairs, furniture: running headers and page numbers are told from text by trees over each line and its neighbours. A line that
  repeats within its document is furniture, one that carries on a sentence is text, and one of figures alone between others is a page
  number; these train the trees, which then decide every line.
* line pairs, joins: a line that ends in a hyphen and the next line of the text are joined, with or without the hyphen, as trees over both
  ends and the counts of both forms say; they learn from clean words split in two, hyphenated ones and parts that don't belong together.
* words: forms that the collection's clean texts don't have, or have far more often with marks, get correction candidates by a join of
  positional character bigrams with the clean words (of a form's bigrams the five rarest are enough: a candidate lacks four at most);
  trees rank them, trained on clean words damaged by the confusions that the collection itself shows.

Scale: the clean words are counted over all other texts, summed before the shuffle; bigrams carry their position, so
postings are short; texts of the scanned documents move only once, by id, in the last join. Models are trained on bounded samples
(``SAMPLE_*``); everything else covers all rows, lines and words of any length.
"""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.grouping import bounded_broadcast
from .boosting import BoostedTrees
from .common import cut, map_columns

SAMPLE_CHUNKS, SAMPLE_WORDS, SAMPLE_DAMAGED, SAMPLE_CONFUSIONS, SAMPLE_BREAKS = 1500, 30_000, 6000, 2000, 4000
LEAST_COUNT = 3
FREQUENT = 1e-4
#: How often a scan is taken to lose the marks of a word that has some, when known forms without marks are ranked.
MARKS_LOST = 1 / 8
RARE_GRAMS = 5

#: Words that stand before a page number. Fixed values.
PAGE_WORDS = ("strona", "str", "s", "page", "p", "pp", "pg", "seite", "сторінка", "стор", "с")
_LOOK = str.maketrans({"0": "o", "1": "l", "@": "a", "!": "i", "5": "s", "$": "s", "|": "l", "3": "e", "9": "g", "6": "b", "8": "b"})
_CLEAN_WORD = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)*")
_END = re.compile(r"[.!?…:;][\"'”»)\]]*$")
_HYPHENS = "-‐‑¬­"
_IN = re.escape(_HYPHENS)
_BROKEN = re.compile(rf"([^\s{_IN}]*[^\W\d_](?:-[^\s{_IN}]*[^\W\d_])*)[{_IN}]$")
_EDGES = ".,;:?!\"'„”“»«()[]{}…–—|‚‘’`*•"
_INNER_EDGES = ".,;:?\"„”“»«()[]{}…–—‚‘*•-‐‑¬\u00ad"
_OF = r"(?:\s*(?:[^\W\d_]{1,3}|/|\|)\s*\d{1,4})?\W*$"
_BARE_PAGE = re.compile(r"^\W*(\d{1,4}|[ivxlc]{1,6}|[IVXLC]{1,6})" + _OF)
_PAGE = re.compile(r"^\W*([^\W\d_][\w@!$|]{0,8})[.:]?\s*(\d{1,4}|[ivxlcIVXLC]{1,6})" + _OF)


def is_page(line: str) -> bool:
    """Only a page number, in whatever form."""
    s = line.strip()
    if len(s) > 24:
        return False
    if m := _BARE_PAGE.match(s):
        number = m.group(1)
        return (number.isdigit() or len(number) > 1 or not s[:1].isalpha()) and not (s.endswith((".", ",", "%", ")")) and s[:1].isdigit())
    m = _PAGE.match(s)
    if not m:
        return False
    word, number = m.groups()
    if not number.isdigit() and len(number) > 1:
        return False
    word = word.lower().translate(_LOOK)
    return any(word == p or (len(p) >= 4 and len(word) == len(p) and sum(a != b for a, b in zip(word, p)) == 1) for p in PAGE_WORDS)


def _page_number_ends(line: str) -> tuple[int, int]:
    """(where the line begins after a page number, where it ends before one); one pass from each end, whatever its length."""
    n, i = len(line), 0
    while i < n and not (line[i].isalnum() or line[i] == "_"):
        i += 1
    j = i
    while j < n and line[j].isdigit():
        j += 1
    k = j
    while k < n and line[k].isspace():
        k += 1
    begin = k if j > i and k > j and k < n else 0
    i = n
    while i > begin and not (line[i - 1].isalnum() or line[i - 1] == "_"):
        i -= 1
    j = i
    while j > begin and line[j - 1].isdigit():
        j -= 1
    k = j
    while k > begin and line[k - 1].isspace():
        k -= 1
    return begin, k if j < i and j - k >= 2 else n


def line_key(line: str) -> int:
    """The same for lines that differ by a page number at an end or by look-alike characters only; 64 bits of a hash."""
    line = line.strip()
    begin, end = _page_number_ends(line)
    letters = line[begin:end].lower()
    for a, b in (("rn", "m"), ("vv", "w"), ("cl", "d"), ("ii", "u"), ("li", "h")):
        letters = letters.replace(a, b)
    return xxhash.xxh3_64_intdigest(" ".join(letters.translate(_KEY).split())) - (1 << 63)


#: Characters that scans mistake for each other, brought to one of them. Fixed values.
_KEY = str.maketrans({
    "@": "a", "ą": "a", "q": "a", "!": "l", "1": "l", "i": "l", "j": "l", "|": "l", "ł": "l", "0": "o", "ó": "o", "6": "o", "5": "s", "ś": "s", "$": "s",
    "9": "g", "8": "b", "c": "e", "ć": "e", "ę": "e", "f": "t", "ż": "z", "ź": "z", "ń": "n",
})


_YEARS = re.compile(r"\d{4}/\d{2,4}(?:\s|$)")


def numbered(line: str) -> bool:
    """A number and two blanks or more at an end of the line."""
    head, tail = line.split(maxsplit=1)[0], line.rsplit(maxsplit=1)[-1]
    return len(head) < len(line) and ((head.isdigit() and line[len(head) + 1 : len(head) + 2].isspace()) or (tail.isdigit() and line[: len(line) - len(tail)][-2:].isspace()))


def line_features(lines: list[str], repeats: dict[int, tuple[int, int]]) -> tuple[np.ndarray, list[int], list[int]]:
    """(features of the lines that aren't blank, their places, times each repeats in its document)."""
    at = [i for i, x in enumerate(lines) if x.strip()]
    text = [lines[i].strip() for i in at]
    width = sorted(map(len, text))[int(0.85 * (len(text) - 1))] if text else 1
    page = [is_page(x) for x in text]
    ended = [bool(_END.search(x)) for x in text]
    rows, times = [], []
    for k, s in enumerate(text):
        before, after = (text[k - 1] if k else ""), (text[k + 1] if k + 1 < len(text) else "")
        n_doc, n_all = repeats.get(line_key(s), (1, 1))
        words = s.split()
        letters = sum(c.isalpha() for c in s)
        times.append(n_doc)
        rows.append((
            len(words), letters / len(s), sum(c.isdigit() for c in s) / len(s), len(s) / max(1, width), s[:1].islower(), s[:1].isdigit(), ended[k],
            bool(_YEARS.search(s)), " – " in s or " | " in s, s.isupper(), k > 0 and not ended[k - 1], after[:1].islower(),
            math.log(n_all), s[-1:] in _HYPHENS, page[k], (k > 0 and page[k - 1]) or (k + 1 < len(text) and page[k + 1]),
            sum(w[:1].isupper() for w in words) / len(words), numbered(s), "," in s, k == 0, k + 1 == len(text), before[-1:] in _HYPHENS and bool(before),
        ))
    return np.array(rows, float).reshape(len(rows), N_FEATURES), at, times


N_FEATURES = 22


def seeds(x: np.ndarray, times: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(furniture, page number) of each line: 1 for lines that tell themselves to be it, 0 for lines that tell not to be, -1 for the others."""
    times = np.array(times)
    head = np.full(len(x), -1)
    head[(x[:, 4] == 1) | ((x[:, 6] == 1) & (x[:, 0] >= 2)) | ((x[:, 3] > 0.85) & (times == 1) & (x[:, 12] == 0)) | (x[:, 13] == 1) | (x[:, 18] == 1)] = 0
    between = (x[:, 15] == 1) | (x[:, 17] == 1) | ((x[:, 10] == 1) & (x[:, 11] == 1) & (x[:, 3] < 0.85))
    head[(times >= 2) & between & (x[:, 6] == 0) & (x[:, 4] == 0) & (x[:, 0] <= 12) & (x[:, 18] == 0)] = 1
    head[x[:, 14] == 1] = -1
    number = x[:, 14] == 1
    page = np.where(number, 1, np.where(head >= 0, 0, -1))
    crowd = number & (x[:, 15] == 1)  # a column of figures isn't a row of page numbers
    page[crowd & np.r_[False, crowd[:-1]] & np.r_[crowd[1:], False]] = 0
    return head, page


class LineModel:
    """Boosted trees for furniture and for page numbers, over a line and its neighbours."""

    def __init__(self, chunks: list[tuple[list[str], dict[int, tuple[int, int]]]]):
        xs, heads, pages = [np.zeros((0, N_FEATURES))], [np.zeros(0)], [np.zeros(0)]
        for lines, repeats in chunks:
            x, _, times = line_features(lines, repeats)
            head, page = seeds(x, times)
            xs.append(x)
            heads.append(head)
            pages.append(page)
        x = np.concatenate(xs)
        self.head, self.page = (self._fit(x, np.concatenate(y)) for y in (heads, pages))

    @staticmethod
    def _fit(x: np.ndarray, y: np.ndarray) -> BoostedTrees | None:
        x, y = x[y >= 0], y[y >= 0]
        return BoostedTrees(rounds=120).fit(x, y) if len(y) and 0 < y.mean() < 1 else None

    def kinds(self, chunks: list[tuple[list[str], dict[int, tuple[int, int]]]]) -> list[list[str]]:
        """header, page, text or blank for each line of each chunk. A line that comes again in its document needs less to be furniture.
        Where no line of the sample told itself, its form alone says whether a line is a page number, and none is furniture."""
        rows = [line_features(lines, repeats) for lines, repeats in chunks]
        x = np.concatenate([np.zeros((0, N_FEATURES)), *(f for f, _, _ in rows)])
        times = np.array([t for _, _, ts in rows for t in ts])
        head = self.head.predict(x) if self.head and len(x) else np.zeros(len(x))
        page = self.page.predict(x) if self.page and len(x) else x[:, 14]
        needed = np.select([times < 2, times == 2], [0.5, 0.25], 0.1)
        told = np.where(page > 0.5, "page", np.where(head > needed, "header", "text")).tolist()
        out, k = [], 0
        for (lines, _), (_, at, _) in zip(chunks, rows):
            kinds = ["blank"] * len(lines)
            for i in at:
                kinds[i] = told[k]
                k += 1
            out.append(kinds)
        return out


def tokens(line: str) -> list[tuple[str, str]]:
    """(token, form) of the tokens of a line that could be words; a form is lower-cased, without punctuation around it."""
    out = []
    words = line.split()
    if words and words[-1][-1] in _HYPHENS:
        words.pop()  # broken off
    for token in words:
        core = token.strip(_EDGES + _HYPHENS).lower()
        if len(core) >= 3 and any(c.isalpha() for c in core):
            out.append((token, core))
    return out


def broken_words(lines: list[str], kinds: list[str]) -> list[tuple[int, int, str, str, tuple[bool, bool, bool]]]:
    """(line, next line, first part, second part, how the second begins) of the lines of text whose last word may go on in the next
    line of the text. It begins with a small letter, in capitals after capitals, or with a character that looks like a letter."""
    text = [i for i, k in enumerate(kinds) if k == "text"]
    out = []
    for i, j in zip(text, text[1:]):
        last = lines[i].rsplit(maxsplit=1)[-1]
        if last[-1] not in _HYPHENS:
            continue
        m = _BROKEN.search(last)
        first = lines[j].split(maxsplit=1)[0]
        if not m:
            continue
        figure = ord(first[0]) in _LOOK and first[1:2].isalpha()
        look = figure or (first[0] in "IO" and first[1:2].islower() and m.group(1)[-1].islower())
        a = m.group(1).lstrip(_EDGES).lower()
        b = (first.rstrip(_EDGES + _HYPHENS) if figure else first.strip(_EDGES + _HYPHENS)).lower()
        if a and b and a[:1].isalpha():
            out.append((i, j, a, b, (first[:1].islower(), first[:1].isupper() and m.group(1).isupper(), look)))
    return out


class JoinModel:
    """Boosted trees over the ends of two lines and the counts of what they make together, for each way to join them."""

    def __init__(self, words: dict[str, float], seed: int = 9):
        rng = random.Random(seed)
        plain, kept = sorted(w for w in words if "-" not in w and len(w) >= 5), sorted(w for w in words if "-" in w.strip("-"))
        counts = Counter(words)
        for w in kept:
            counts[w.split("-", 1)[0] + "-"] += words[w]
            counts["-" + w.rsplit("-", 1)[1]] += words[w]
        x, y = [], []
        for _ in range(SAMPLE_BREAKS if plain else 0):
            way, chance = rng.random(), rng.random()
            word = kept[rng.randrange(len(kept))] if kept and way < 0.2 else plain[rng.randrange(len(plain))]
            at = word.index("-") if "-" in word else rng.randrange(2, len(word) - 1)
            a, b = word[:at], word[at:].lstrip("-")
            if way > 0.75:  # parts that don't belong together
                word, b = None, plain[rng.randrange(len(plain))]
                begins = (chance < 0.05, False, chance > 0.9)
            else:
                begins = (chance < 0.9, 0.9 <= chance < 0.93, chance >= 0.93)
            known = {f: (counts[f], None) for f in (a + b, f"{a}-{b}", f"{a}-", f"-{b}")}
            if word and rng.random() < 0.3:  # a word that the clean texts don't have
                known[word] = (0, None)
            if word and begins[2]:  # its second part begins with a misread character
                known = {f: ((0, word if f == word else None) if f in (a + b, f"{a}-{b}") else v) for f, v in known.items()}
            for f, row in self.options(a, b, begins, known):
                x.append(row)
                y.append(f == word)
        y = np.array(y, float)
        self.trees = BoostedTrees(rounds=60).fit(np.array(x), y) if len(y) and 0 < y.mean() < 1 else None

    @staticmethod
    def options(a: str, b: str, begins: tuple[bool, bool, bool], known: dict[str, tuple[int, str | None]]) -> list[tuple[str, list[float]]]:
        forms = (a + b, f"{a}-{b}")
        n, fix = zip(*(known.get(f, (0, None)) for f in forms))
        parts = [math.log1p(known.get(f, (0, None))[0]) for f in (f"{a}-", f"-{b}")]
        fixed = [bool(fix[0]), bool(fix[1] and "-" in fix[1])]
        return [(forms[k], [k, math.log1p(n[k]), math.log1p(n[1 - k]), n[k] >= n[1 - k], *parts, min(parts), len(a), len(b), *begins, fixed[k], fixed[1 - k]]) for k in (0, 1)]

    def join(self, breaks: list[tuple[str, str, tuple[bool, bool, bool], dict[str, tuple[int, str | None]]]]) -> list[tuple[str, str | None] | None]:
        """For each (first part, second part, how that begins, what is known of forms): (the word as it stands, the correct word if that
        differs), or None where the lines don't share a word. Without clean words, a word goes on where the next line begins with a
        small letter, without its hyphen."""
        ways = [self.options(*x) for x in breaks]
        if self.trees and ways:
            p = self.trees.predict(np.array([row for two in ways for _, row in two])).reshape(-1, 2)
        else:
            p = np.array([(float((begins[0] or begins[1]) and b[:1].isalpha()), 0.0) for _, b, begins, _ in breaks]).reshape(-1, 2)
        out = []
        for two, (plain, kept), (*_, known) in zip(ways, p, breaks):
            k = int(kept > plain)
            n, fix = known.get(two[k][0], (0, None))
            out.append(None if max(plain, kept) < 0.5 else (two[k][0], fix if fix and not n and (not k or "-" in fix) else None))
        return out


def edit(bad: str, good: str) -> tuple[str, str, int] | None:
    """(wrong characters, right characters, place) if the words differ in one place, or everywhere by the same confusion."""
    if bad == good:
        return None
    n = min(len(bad), len(good))
    i = 0
    while i < n and bad[i] == good[i]:
        i += 1
    j = 0
    while j < n - i and bad[-1 - j] == good[-1 - j]:
        j += 1
    a, b = bad[i : len(bad) - j], good[i : len(good) - j]
    if len(a) <= 2 and len(b) <= 2:
        if not a or not b:  # an insertion or omission is seen with the character before it
            if i == 0:
                return None
            a, b, i = bad[i - 1] + a, good[i - 1] + b, i - 1
            if len(a) > 2 or len(b) > 2:
                return None
        return a, b, i
    if len(bad) == len(good):
        pairs = {(x, y) for x, y in zip(bad, good) if x != y}
        if len(pairs) == 1:
            return (*pairs.pop(), i)
    return None


def features(bad: str, good: str, shared: float, n: float, weight: float, n_bad: float) -> list[float]:
    """Of a form and a candidate for it; ``weight`` is that of their confusion, the counts are those of the clean texts."""
    bare = _bare(bad) == _bare(good)
    a, b, i = edit(bad, good) or ("", "", 0)
    odd = any(not c.isalpha() for c in a)
    return [
        math.log1p(n), math.log(weight + 1e-4), len(bad), len(a), len(b), odd, i == 0, i + len(a) >= len(bad), shared / (len(bad) + 1),
        sorted(a) == sorted(b), len(a) != len(b), bare, math.log1p(n_bad), math.log1p(n) - math.log1p(n_bad),
    ]


#: Letters with marks and the same without. Fixed values.
MARKS = ("ąćęłńóśżźäöüáéíúěšč", "acelnoszzaouaeiuesc")
_MARKS = str.maketrans(*MARKS)


#: Confusions that are expected of any scan: lost marks, ligatures, figures for letters. Fixed values.
EXPECTED = frozenset(
    {(b, a) for a, b in zip("ąćęłńóśżźäöü", "acelnoszzaou")}
    | {("ﬁ", "fi"), ("ﬂ", "fl"), ("ﬀ", "ff"), ("0", "o"), ("1", "l"), ("1", "i"), ("5", "s"), ("8", "b"), ("6", "b"), ("9", "g"), ("@", "a"), ("!", "i"), ("|", "l"), ("$", "s")}
)
PRIOR = 3.0


def _bare(s: str) -> str:
    return s.translate(_MARKS)


def damage(word: str, confusions: list[tuple[tuple[str, str], float]], weights: list[float], rng: random.Random) -> str | None:
    """The word with one of the confusions, if it has a place for it."""
    for (a, b), _ in rng.choices(confusions, weights, k=12):
        places = [m.start() for m in re.finditer(re.escape(b), word)]
        if places:
            i = rng.choice(places)
            return word[:i] + a + word[i + len(b) :]
    return None


def grams(word: str) -> list[tuple[str, int]]:
    s = f"^{word}$"
    return [(s[i : i + 2], i) for i in range(len(s) - 1)]


def shared_grams(form: str, word: str) -> int:
    """Places of the form whose bigram the word has there or one place beside."""
    there = set(grams(word))
    return sum((g, i) in there or (g, i - 1) in there or (g, i + 1) in there for g, i in grams(form))


class Ranker:
    """Boosted trees over (form, candidate) pairs."""

    def __init__(self, words: dict[str, float], confusions: dict[tuple[str, str], float], odd: dict[str, str], seed: int = 5):
        rng = random.Random(seed)
        index: dict[tuple[str, int], list[str]] = defaultdict(list)
        for w in words:
            for g, i in grams(w):
                for k in (i - 1, i, i + 1):
                    index[g, k].append(w)
        names = sorted(w for w in words if len(w) >= 3)
        items = sorted(confusions.items())
        weights = [v**0.5 for _, v in items]  # rare confusions have to be seen too
        rare = [w for w in names if words[w] <= 2 * LEAST_COUNT] or names
        x, y, sure = [], [], []

        def show(form: str, word: str, n: float, n_form: float, right: float) -> None:
            e = edit(form, word)
            x.append(features(form, word, shared_grams(form, word), n, confusions.get(e[:2], 0.0) if e else 0.0, n_form))
            y.append(right > 0)
            sure.append(abs(right))

        for k in range(SAMPLE_DAMAGED if items and names else 0):
            if k % 3:
                true = names[rng.randrange(len(names))]
                form = damage(true, items, weights, rng)
            else:  # a rare word that is right and isn't known
                true, form = "", rare[rng.randrange(len(rare))]
            if not form or (k % 3 and form in words):
                continue
            hidden = bool(k % 3) and k % 4 == 0  # a name that the clean texts don't have
            shared = Counter(w for g in grams(form) for w in index.get(g, ()) if abs(len(w) - len(form)) <= 2 and w != form)
            for w, c in shared.items():
                if enough(len(form), len(w), c) and not (hidden and w == true) and related(form, w):
                    show(form, w, words[w], 0, 1 if w == true else -1)
            read = plain_reading(form, odd)
            if read and (hidden or read != true):
                show(form, read, 0, 0, 1 if read == true else -1)
        for w in names:  # known forms that lack the marks of another word: how often each is meant follows from the counts
            form = _bare(w)
            if form != w and form in words:
                lost = MARKS_LOST * words[w] / (words[form] + MARKS_LOST * words[w])
                show(form, w, words[w], words[form], lost)
                show(form, w, words[w], words[form], lost - 1)
        y = np.array(y, float)
        self.trees = BoostedTrees(rounds=60).fit(np.array(x), y, np.array(sure)) if len(y) and 0 < y.mean() < 1 else None
        self.always = float(y.mean()) if len(y) else 0.0  # where no example, or every one, is right

    def score(self, x: np.ndarray) -> np.ndarray:
        return self.trees.predict(x) if self.trees else np.full(len(x), self.always)


def related(form: str, word: str) -> bool:
    """One edit apart, or equal without marks."""
    return edit(form, word) is not None or (form != word and _bare(form) == _bare(word))


def plain_reading(form: str, odd: dict[str, str]) -> str | None:
    """The form with its one character inside that is no letter read as the letter that it mostly stands for; words of four letters or more."""
    at = [i for i, c in enumerate(form) if not c.isalpha()]
    if len(at) != 1 or not 0 < at[0] < len(form) - 1 or len(form) < 5 or form[at[0]] in "'’.,-" or form[at[0]] not in odd:
        return None
    return form[: at[0]] + odd[form[at[0]]] + form[at[0] + 1 :]


def enough(n: int, m: int, shared: float) -> bool:
    return shared >= max(n, m) + 1 - 4 and shared >= 1


def scanned(chunks: DataFrame, text_index: DataFrame, status: str = "ok_ocr") -> tuple[DataFrame, DataFrame]:
    """(chunks of scanned attachments, the other chunks), each (id, doc, text) with an id and a text."""
    docs = text_index.filter((F.col("extraction_status") == status) & F.col("content_sha256").isNotNull())
    docs = docs.select(F.concat(F.lit("attachment:"), "content_sha256").alias("doc")).distinct()
    rows = chunks.select(F.col("id").cast("string").alias("id"), F.col("document_id").cast("string").alias("doc"), F.col("text")).filter("id is not null and text is not null")
    docs = bounded_broadcast(cut(docs))
    names = ["id", "doc", "text"]
    return rows.join(docs, "doc", "left_semi").select(*names), rows.join(docs, "doc", "left_anti").select(*names)


def clean_words(rows: DataFrame, least: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the words that occur ``least`` times or more; the parts of hyphenated words also as ``first-`` and ``-last``."""

    def run(batches):
        total: Counter[str] = Counter()

        def out():
            return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                total.update(_CLEAN_WORD.findall(text.lower()))
            if len(total) > 200_000:
                yield out()
                total.clear()
        if total:
            yield out()

    words = rows.select("text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    parts = words.filter(F.contains("word", F.lit("-"))).select(F.explode(F.array(F.concat(F.substring_index("word", "-", 1), F.lit("-")), F.concat(F.lit("-"), F.substring_index("word", "-", -1)))).alias("word"), "n")
    return cut(words.union(parts).groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least))


def _with_repeats(rows: DataFrame) -> DataFrame:
    """(id, doc, text, repeats): for each of the text's lines that repeat, its key, times in the document and documents with it."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, docs, keys = [], [], []
        for i, d, text in zip(*(batch.column(k).to_pylist() for k in range(3))):
            own = [line_key(x) for x in text.split("\n") if x.strip()]
            ids += [i] * len(own)
            docs += [d] * len(own)
            keys += own
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(docs, pa.string()), pa.array(keys, pa.int64())], names=["id", "doc", "key"])

    lines = map_columns(rows, run, "id string, doc string, key long")
    in_chunk = lines.groupBy("id", "doc", "key").agg(F.count("*").alias("n"))
    in_doc = in_chunk.groupBy("doc", "key").agg(F.sum("n").alias("n_doc"))
    in_all = in_doc.groupBy("key").agg(F.count("*").alias("n_all"))
    stats = in_doc.join(in_all, "key").filter("n_doc > 1 or n_all > 1")
    per_chunk = in_chunk.select("id", "doc", "key").join(stats, ["doc", "key"]).groupBy("id").agg(F.collect_list(F.struct("key", "n_doc", "n_all")).alias("repeats"))
    return rows.join(per_chunk, "id", "left")


def _repeats(cell) -> dict[int, tuple[int, int]]:
    return {r["key"]: (r["n_doc"], r["n_all"]) for r in cell or ()}


def _known_forms(forms: DataFrame, words: DataFrame) -> DataFrame:
    return forms.join(words.select(F.col("word").alias("form"), "n"), "form", "left").fillna(0, ["n"])


def candidates(forms: DataFrame, words: DataFrame) -> DataFrame:
    """(form, word, n): words that may share enough bigrams with each form, told by its rarest ones.

    A word that shares enough lacks at most four of the form's bigrams, so it has one of the ``RARE_GRAMS`` rarest at its place or
    beside it. Frequent bigrams thus meet nothing, and no key of the join is hot.
    """

    def gram_rows(df: DataFrame, col: str, shift: list[int]) -> DataFrame:
        s = F.concat(F.lit("^"), F.col(col), F.lit("$"))
        at = F.explode(F.sequence(F.lit(1), F.length(s) - 1))
        df = df.withColumn("i", at).withColumn("gram", F.substring(s, F.col("i"), F.lit(2)))
        return df.withColumn("at", F.explode(F.array([F.col("i") + k for k in shift]))).drop("i")

    right = gram_rows(words, "word", [-1, 0, 1])
    sizes = bounded_broadcast(cut(right.groupBy("gram", "at").agg(F.count("*").alias("postings"))))
    left = gram_rows(forms.select("form"), "form", [0]).join(sizes, ["gram", "at"], "left")
    # bigrams that no word has are the rarest: they take their place and meet nothing
    rarest = left.groupBy("form").agg(F.slice(F.array_sort(F.collect_list(F.struct(F.coalesce("postings", F.lit(0)).alias("postings"), "gram", "at"))), 1, RARE_GRAMS).alias("g"))
    left = rarest.select("form", F.explode("g").alias("g")).filter("g.postings > 0").select("form", "g.gram", "g.at")
    # merged, not broadcast: what is exploded is many times larger than the file that its size is guessed from
    near = left.hint("merge").join(right, ["gram", "at"]).filter((F.abs(F.length("form") - F.length("word")) <= 2) & (F.col("form") != F.col("word")))
    return near.select("form", "word", "n").distinct()


_PAIRS = "form string, word string, n long, n_form long, shared long, a string, b string"


def _edits(rows: DataFrame) -> DataFrame:
    """``rows(form, word, n, n_form)`` that are one edit apart, or equal but for marks, with their shared bigrams and the edit."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for f, w, n, m in zip(*(batch.column(k).to_pylist() for k in range(4))):
            if related(f, w) and (m or enough(len(f), len(w), shared := shared_grams(f, w))):
                a, b, _ = edit(f, w) or ("", "", 0)
                out.append((f, w, n, m, shared_grams(f, w) if m else shared, a, b))
        cols = list(zip(*out)) or [()] * 7
        types = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["form", "word", "n", "n_form", "shared", "a", "b"])

    return map_columns(rows.select("form", "word", "n", "n_form"), run, _PAIRS)


def corrections(forms: DataFrame, words: DataFrame) -> tuple[DataFrame, dict[str, float]]:
    """``((form, word, score), sample)``: the best candidate of each of ``forms(form, n)``, if it has any, and the most frequent clean words."""
    spark = forms.sparkSession
    targets = words.filter(~F.startswith("word", F.lit("-")) & ~F.endswith("word", F.lit("-")) & (F.length("word") >= 3))
    whole = forms.filter("length(form) >= 3").filter(~F.startswith("form", F.lit("-")) & ~F.endswith("form", F.lit("-")))
    unknown = whole.filter("n = 0").select("form")
    near = cut(_edits(candidates(unknown, targets).withColumn("n_form", F.lit(0).cast("long"))))
    # a known form can be a damaged one as well, where it lacks marks that another word has
    bare = F.translate("word", *MARKS)
    marked = targets.filter(bare != F.col("word")).select(bare.alias("form"), "word", F.col("n").alias("n_word"))
    marked = whole.filter("n > 0").join(marked, "form").select("form", "word", F.col("n_word").alias("n"), F.col("n").alias("n_form"))
    # confusions: how many forms each would explain, a form with several candidates counting in parts
    # (words rarer than FREQUENT of all, names above all, differ from each other by anything and tell nothing)
    total = targets.agg(F.sum("n")).first()[0] or 0
    often = near.filter((F.col("n") >= max(2 * LEAST_COUNT, total * FREQUENT)) & ~((F.col("a") == "") & (F.col("b") == "")))
    share = often.groupBy("form").agg(F.count("*").alias("k"))
    seen = often.join(share, "form").groupBy("a", "b").agg(F.sum(1 / F.col("k")).alias("weight")).filter("weight >= 1.5 and a != reverse(b)")
    expected = spark.createDataFrame([(a, b, PRIOR) for a, b in sorted(EXPECTED)], "a string, b string, weight double")
    seen = cut(seen.union(expected).groupBy("a", "b").agg(F.sum("weight").alias("weight")))
    confusions = {(r.a, r.b): r.weight for r in seen.orderBy(F.desc("weight"), "a", "b").limit(SAMPLE_CONFUSIONS).collect()}
    # a character that no word has is read as it mostly is; one row a character
    letter = F.col("b").rlike(r"^\p{L}$") & F.col("a").rlike(r"^\P{L}$")
    odd = {r.a: r.s.b for r in seen.filter(letter).groupBy("a").agg(F.max(F.struct("weight", "b")).alias("s")).collect()}
    often_n = targets.agg(F.percentile_approx("n", F.lit(max(0.0, 1 - SAMPLE_WORDS / max(1, targets.count()))), F.lit(1_000_000)).alias("q")).first().q or 0
    sample = {r.word: r.n for r in targets.filter(F.col("n") >= often_n).orderBy(F.desc("n"), "word").limit(SAMPLE_WORDS).collect()}
    ranker = spark.sparkContext.broadcast(Ranker(sample, confusions, odd))

    def readings(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [(f, r) for f in batch.column(0).to_pylist() if (r := plain_reading(f, odd))]
        cols = list(zip(*rows)) or [()] * 2
        return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in cols], names=["form", "word"])

    zero = F.lit(0).cast("long")
    read = map_columns(unknown, readings, "form string, word string").withColumns({"n": zero, "n_form": zero})
    pairs = near.union(_edits(marked)).union(_edits(read)).join(bounded_broadcast(seen), ["a", "b"], "left").fillna(0.0, ["weight"])

    def rank(batch: pa.RecordBatch) -> pa.RecordBatch:
        names = ("form", "word", "shared", "n", "weight", "n_form")
        x = np.array([features(*row) for row in zip(*(batch.column(c).to_pylist() for c in names))])
        return pa.RecordBatch.from_arrays([batch.column("form"), batch.column("word"), batch.column("n"), pa.array(ranker.value.score(x), pa.float64())], names=["form", "word", "n", "score"])

    scored = map_columns(pairs.select("form", "word", "shared", "n", "weight", "n_form"), rank, "form string, word string, n long, score double")
    best = scored.groupBy("form").agg(F.max(F.struct("score", "n", "word")).alias("b"))
    return best.select("form", "b.word", "b.score"), sample


def repair(chunks: DataFrame, text_index: DataFrame, accept: float = 0.5) -> tuple[DataFrame, DataFrame]:
    """``(damage, texts)``: (id, line_no, kind, word) of every damaged line or word, and (id, text) repaired.

    Defined cases: null ids and null texts have no rows; an empty text stays empty; rows delivered twice count once; a document that
    text_index lists twice counts once; lines are the pieces between line feeds, numbered from 1, empty ones included; without scanned
    documents both results are empty; without clean words nothing is corrected and hyphens at line ends are dropped.
    """
    spark = chunks.sparkSession
    own, others = scanned(chunks, text_index)
    rows = cut(own.dropDuplicates(["id", "text"]))
    words = clean_words(others)
    rows = cut(_with_repeats(rows))
    # a hash takes about the sample from every partition, so no more than that is sent anywhere
    part = F.pmod(F.xxhash64("id", F.lit(3)), F.lit(1_000_000)) < int(1.1e6 * SAMPLE_CHUNKS / max(1, rows.count())) + 1
    sample = rows.filter(part).select("text", "repeats").orderBy(F.xxhash64("text"), "text").limit(SAMPLE_CHUNKS).collect()
    model = spark.sparkContext.broadcast(LineModel([(r.text.split("\n"), _repeats([x.asDict() for x in r.repeats or ()])) for r in sample]))

    def read(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, texts, kinds, forms = [], [], [], []
        chunks = [(text.split("\n"), _repeats(r)) for text, r in zip(batch.column("text").to_pylist(), batch.column("repeats").to_pylist())]
        for i, text, (lines, _), k in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist(), chunks, model.value.kinds(chunks)):
            found: set[str] = set()
            parts = broken_words(lines, k)
            for n, line in enumerate(lines):
                if k[n] == "text":
                    for token, form in tokens(line):
                        found.add(form)
                        found.add(token.strip(_INNER_EDGES).lower())
            for _, _, a, b, _ in parts:
                found |= {a + b, f"{a}-{b}", f"{a}-", f"-{b}"}
            ids.append(i)
            texts.append(text)
            kinds.append(k)
            forms.append(sorted(f for f in found if f))
        strings = pa.list_(pa.string())
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(texts, pa.string()), pa.array(kinds, strings), pa.array(forms, strings)], names=["id", "text", "kinds", "forms"])

    lined = cut(map_columns(rows.select("id", "text", "repeats"), read, "id string, text string, kinds array<string>, forms array<string>", rows=250))
    uses = lined.select("id", "text", F.explode("forms").alias("form")).select("id", F.xxhash64("text").alias("h"), "form")
    forms = cut(_known_forms(uses.select("form").distinct(), words))
    fixes, sample = corrections(forms, words)
    joins = spark.sparkContext.broadcast(JoinModel(sample))
    looked = forms.join(fixes.filter(F.col("score") >= accept), "form", "left")
    per_text = uses.join(looked, "form").groupBy("id", "h").agg(F.collect_list(F.struct("form", "n", "word", "score")).alias("forms"))
    joined = lined.drop("forms").withColumn("h", F.xxhash64("text")).join(per_text, ["id", "h"], "left").select("id", "text", "kinds", "forms")

    def write(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        texts = []
        rows = [(text, kinds, {f["form"]: (f["n"], f["word"]) for f in forms or ()}) for text, kinds, forms in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3)))]
        for found, fixed in repair_texts(rows, joins.value):
            out.append([{"line_no": n, "kind": k, "word": w} for n, k, w in found])
            texts.append(fixed)
        kind = pa.list_(pa.struct([("line_no", pa.int64()), ("kind", pa.string()), ("word", pa.string())]))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array(out, kind)], names=["id", "text", "damage"])

    done = cut(map_columns(joined, write, "id string, text string, damage array<struct<line_no long, kind string, word string>>", rows=250))
    return done.select("id", F.explode("damage").alias("d")).select("id", "d.*").distinct(), done.select("id", "text").distinct()


def repair_texts(rows: list[tuple[str, list[str], dict[str, tuple[int, str | None]]]], model: JoinModel) -> list[tuple[list[tuple[int, str, str]], str]]:
    """(damage, repaired text) of each (text, kinds of its lines, what is known of its forms)."""
    breaks = [broken_words(text.split("\n"), kinds) for text, kinds, _ in rows]
    words = iter(model.join([(a, b, begins, known) for own, (*_, known) in zip(breaks, rows) for _, _, a, b, begins in own]))
    return [repair_text(*row, [(i, j, a, word) for i, j, a, _, _ in own if (word := next(words))]) for row, own in zip(rows, breaks)]


def repair_text(text: str, kinds: list[str], known: dict[str, tuple[int, str | None]], joins: list[tuple[int, int, str, tuple[str, str | None]]]) -> tuple[list[tuple[int, str, str]], str]:
    """(damage, repaired text) of one text; ``joins`` are (line, next line, first part, (word as it stands, correct word))."""
    lines = text.split("\n")
    found: list[tuple[int, str, str]] = [(n, k, "") for n, k in enumerate(kinds, 1) if k in ("header", "page")]
    marks = sum(_bare(c) != c for c in text.lower())
    has_marks = marks * 100 >= 3 * sum(c.isalpha() for c in text)
    first: dict[int, tuple[str, str | None]] = {}
    second = set()
    for i, j, a, word in joins:
        first[i] = word
        second.add(j)
        stands, right = word
        found.append((i + 1, "hyphen", right or stands))
        if right and right != stands:
            found.append((i + 1 if not right.startswith(a) else j + 1, "chars", right))
    repaired: list[list[str]] = [[]]
    carry = None
    for i, line in enumerate(lines):
        if kinds[i] != "text":
            if kinds[i] == "blank" and carry is None:
                repaired.append([])
            continue
        words = line.split()
        out = []
        for n, token in enumerate(words):
            if n == 0 and i in second and carry is not None:
                stripped = token.rstrip(_EDGES)
                out.append(carry + token[len(stripped) :])
                carry = None
                continue
            if n + 1 == len(words) and i in first:
                stands, right = first[i]
                lead = token[: len(token) - len(token.lstrip(_EDGES))]
                carry = lead + _like(token.lstrip(_EDGES), right or stands)
                continue
            form = token.strip(_EDGES + _HYPHENS).lower()
            right = None
            for f in (form, token.strip(_INNER_EDGES).lower()):
                n_form, word = known.get(f, (1, None))
                if not word or len(f) < 3 or (n_form and not has_marks) or (not has_marks and _bare(word) == f):
                    continue
                if f != form and known.get(form, (1, None))[0] and not f[-1:].isalpha():
                    continue  # a word that is right, with its own punctuation
                right = word
                break
            if right:
                found.append((i + 1, "chars", right))
                core = token.strip(_INNER_EDGES) if f != form else token.strip(_EDGES + _HYPHENS)
                at = token.find(core)
                out.append(token[:at] + _like(core, right) + token[at + len(core) :])
            else:
                out.append(token)
        repaired[-1] += out
    if carry is not None:
        repaired[-1].append(carry)
    return sorted(set(found)), "\n\n".join(" ".join(p) for p in repaired if p)


def _like(model: str, word: str) -> str:
    """The word with the case of the one that it stands for."""
    if len(model) > 1 and model.isupper():
        return word.upper()
    return word[:1].upper() + word[1:] if model[:1].isupper() else word
