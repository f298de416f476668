"""Per-document text statistics and the type of text they tell (problem 8).

One pass computes the statistics of every document. Thresholds on them are noisy labelling functions: each votes for one
type or abstains. How often each fires on each type is learned by expectation-maximization from their agreements
over all documents; the posterior of the types is the result.

Scale: documents are read once and not shuffled, but for the counts of vote patterns: one row a pattern, of which there are at most
2 ** (number of functions), whatever the number of documents. Only these reach the driver.
"""

from __future__ import annotations

import re
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, map_columns

TYPES = ("prose", "list", "table", "junk")

_ALPHA = re.compile(r"[^\W\d_]+")
_BULLET = re.compile(r"^\s*(?:[-*•–—▪◦·>»+o✓→]|\(?\d{1,3}[.)]|\(?[a-zA-Z][.)])\s+")
_ENDS = tuple(".!?…")
_CODE = re.compile(r"[{}<>=;\\$#]|\(\)|::|->|\b(?:function|return|var|const|def|class|import|if|else|null|true|false|void|int|for|while)\b")
_BLOB = re.compile(r"[A-Za-z0-9+/=_-]{32,}|(?:[0-9a-f]{2}[ :]?){16,}|(?:%[0-9A-F]{2}){6,}|(?:\\[ux][0-9a-fA-F]{2,4}){4,}|(?:&#x?[0-9a-fA-F]+;){4,}")
_HEX = re.compile(r"[0-9a-f:]{2,}")
_MANGLED = re.compile(r"[�ÃÂÄÅâÐÑ¤¦¬±³¼½¾€™‚ƒ„†‡ˆ‰‹Œ¢£¥]")
_CLUSTER = re.compile(r"[bcdfghjklmnpqrstvwxz]{4,}", re.I)
_VOWEL = re.compile(r"[aeiouyąęóäöüаеєиіїоуюяы]", re.I)
_GAP = re.compile(r" {3,}|\t")
_TIGHT = re.compile(r";(?=[^ ])")
_DIGITS = re.compile(r"\d+")
_MARKS = re.compile(r"[{}<>=\\$#]|\(\)|::")
_SEPARATOR = re.compile(r"[/|•»·›>–-]")
_MENU = re.compile(r"\s[/|•»·›>–-]\s|\s{0,1}[|•·»›]\s{0,1}")


def _plain(word: str) -> str:
    if word.isascii():
        return word
    out = unicodedata.normalize("NFD", word.replace("ł", "l").replace("ß", "ss"))
    return "".join(c for c in out if not unicodedata.combining(c))


def cells(line: str) -> int:
    """Number of cells of a line if it looks like a row of them, else 0."""
    s = line.strip()
    for mark in ("|", "\t", ";"):
        n = s.count(mark)
        if n >= 2 or (mark == "\t" and n):
            parts = s.strip(mark).split(mark)
            sizes = [len(p.split()) for p in parts]
            if len(parts) >= 2 and sum(sizes) <= 5 * len(parts) and max(sizes) <= 9:
                if mark != ";" or len(_TIGHT.findall(s)) >= 2:
                    return len(parts)
    if s.count(",") >= 3 and ", " not in s:
        parts = s.split(",")
        if max(len(p.split()) for p in parts) <= 6:
            return len(parts)
    if "   " in s:
        parts = [p for p in _GAP.split(s) if p.strip()]
        if len(parts) >= 3 and max(len(p.split()) for p in parts) <= 9:
            return len(parts)
    return 0


class TokenTraits:
    """What each token adds to a text's statistics, worked out once: a text's sums are sums of rows of a table.

    Columns: characters, letters, digits, words (runs of letters), common words, words of four letters or more, those of them with a cluster of
    consonants or no vowel, code tokens, marks of code, characters of broken encodings, characters of hexadecimal figures.
    """

    COLUMNS = 11
    MOST = 200_000

    def __init__(self, common: frozenset[str]):
        self.common = common
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.words: list[list[str]] = []
        self.table = np.zeros((1024, self.COLUMNS), np.int64)

    def _row(self, token: str) -> tuple[list[str], tuple[int, ...]]:
        words = _ALPHA.findall(token.lower())
        long = [w for w in words if len(w) >= 4]
        return words, (
            len(token), sum(map(len, words)), sum(map(len, _DIGITS.findall(token))), len(words), sum(w in self.common or _plain(w) in self.common for w in words), len(long),
            sum(bool(_CLUSTER.search(w)) or not _VOWEL.search(w) for w in long), len(_CODE.findall(token)), len(_MARKS.findall(token)), len(_MANGLED.findall(token)),
            len(token) if _HEX.fullmatch(token) else 0,
        )

    def ids(self, tokens: list[str]) -> list[int]:
        known = self.known
        try:
            return [known[t] for t in tokens]
        except KeyError:
            for t in tokens:
                if t not in known:
                    words, row = self._row(t)
                    k = len(self.words)
                    if k == len(self.table):
                        self.table = np.concatenate((self.table, np.zeros_like(self.table)))
                    self.table[k] = row
                    self.words.append(words)
                    known[t] = k
            return [known[t] for t in tokens]

    def common_words(self, tokens: list[str]) -> int:
        return int(self.table[self.ids(tokens), 4].sum())


def ends_sentence(line: str) -> bool:
    return line.rstrip().rstrip("\"'”»)]")[-1:] in _ENDS


def longest_run(values: np.ndarray) -> int:
    """Greatest sum of neighbours that aren't 0."""
    some = values > 0
    return int(np.add.reduceat(values, np.flatnonzero(np.r_[True, some[1:] != some[:-1]])).max())


def statistics(text: str, traits: TokenTraits) -> dict[str, float]:
    """Statistics of one text; shares are between 0 and 1, all 0 for a text without a word."""
    tokens = text.split()
    n = len(tokens)
    out = dict.fromkeys(STATISTICS, 0.0)
    out["word_count"] = float(n)
    if not n:
        return out
    if len(traits.known) > traits.MOST:
        traits.forget()
    ids = traits.ids(tokens)
    each = traits.table[ids]
    chars, letters, digits, words, common, long, odd, code, marks, mangled, figures = each.sum(0).tolist()
    found, times = np.unique(ids, return_counts=True)
    distinct = set().union(*map(traits.words.__getitem__, found.tolist()))
    out["mean_word_length"] = chars / n
    out["symbol_ratio"] = max(0, chars - letters - digits) / chars
    out["digit_ratio"] = digits / chars
    out["common_ratio"] = common / max(1, words)
    out["cluster_ratio"] = odd / max(1, long)
    out["distinct_ratio"] = len(distinct) / max(1, words)
    out["top_word_ratio"] = int(times.max()) / n
    # only such texts can hold what the pattern finds
    if each[:, 0].max() >= 32 or (figures >= 20 and longest_run(each[:, 10]) >= 20) or text.count("%") >= 6 or text.count("\\") >= 4 or text.count("&#") >= 4:
        out["blob_ratio"] = sum(map(len, _BLOB.findall(text))) / chars
    out["mangled_ratio"] = mangled / chars
    out["code_ratio"] = code / n if marks else 0.0
    lines = [x for x in text.splitlines() if x.strip()]
    ended = [ends_sentence(x) for x in lines]
    out["line_end_ratio"] = sum(ended) / len(lines)
    sizes = [len(x.split()) for x in lines]
    out["mean_line_words"] = n / len(lines)
    # rows of cells: a line counts where a neighbour is one as well
    rows = [cells(x) for x in lines]
    in_table = [bool(c) and any(rows[j] for j in (i - 1, i + 1) if 0 <= j < len(rows)) for i, c in enumerate(rows)]
    out["table_share"] = sum(s for s, t in zip(sizes, in_table) if t) / n
    # the rest as items or sentences
    listed = 0
    i = 0
    while i < len(lines):
        if in_table[i]:
            i += 1
            continue
        j = i + 1
        count = sizes[i]
        bullet = bool(_BULLET.match(lines[i]))
        # a line goes on in the next where no sentence ends and the next starts small
        while j < len(lines) and not in_table[j] and not ended[j - 1] and not _BULLET.match(lines[j]) and _goes_on(lines[j - 1], lines[j], count):
            count += sizes[j]
            j += 1
        listed += _listed_words(" ".join(lines[i:j]), count, bullet, count / (j - i), traits)
        i = j
    out["list_share"] = listed / n
    out["sentence_share"] = max(0.0, 1 - out["list_share"] - out["table_share"])
    return out


def _goes_on(line: str, after: str, so_far: int) -> bool:
    first = after.lstrip()[:1]
    if first.islower():
        return True
    # wrapped prose: long lines, or a line that ends in a comma or a hyphen
    return line.rstrip()[-1:] in ",–-„(" or (so_far >= 4 and len(line) >= 45 and not after.strip().endswith(":"))


def _listed_words(unit: str, words: int, bullet: bool, a_line: float, traits: TokenTraits) -> int:
    """How many of the words of a run of lines stand in items that are no sentences."""
    body = _BULLET.sub("", unit, count=1) if bullet else unit
    if _SEPARATOR.search(body):
        parts = [p for p in _MENU.split(body) if p.strip()]
        if len(parts) >= 4 and words <= 6 * len(parts) and not ends_sentence(parts[0]):
            return words
    if words >= 6 and ends_sentence(body):
        return 0
    if words >= 9 and a_line >= 4 and traits.common_words(body.split()) >= (1 if not bullet else 3):
        return 0
    return words


STATISTICS = (
    "word_count", "mean_word_length", "symbol_ratio", "digit_ratio", "line_end_ratio", "common_ratio", "distinct_ratio", "top_word_ratio",
    "cluster_ratio", "blob_ratio", "mangled_ratio", "code_ratio", "mean_line_words", "table_share", "list_share", "sentence_share",
)


def _garbled(s: dict[str, float]) -> bool:
    return s["blob_ratio"] > 0.3 or s["mangled_ratio"] > 0.08 or s["code_ratio"] > 0.25 or (s["cluster_ratio"] > 0.3 and s["common_ratio"] < 0.05)


def _over_and_over(s: dict[str, float]) -> bool:
    return s["word_count"] >= 8 and s["digit_ratio"] < 0.1 and (s["top_word_ratio"] > 0.4 or (s["distinct_ratio"] * s["word_count"] <= 3.5 and s["word_count"] >= 12))


#: Labelling functions: type they vote for, and the threshold on the statistics at which they do.
VOTES = (
    ("list", lambda s: s["list_share"] > 0.5 and not _garbled(s) and not _over_and_over(s)),
    ("list", lambda s: s["list_share"] > 0.35 and s["line_end_ratio"] < 0.35 and not _garbled(s) and not _over_and_over(s)),
    ("list", lambda s: s["list_share"] > 0.25 and s["line_end_ratio"] < 0.3 and s["mean_line_words"] < 8 and s["table_share"] < 0.5 and not _over_and_over(s)),
    ("table", lambda s: s["table_share"] > 0.5 and not _garbled(s) and not _over_and_over(s)),
    ("table", lambda s: s["table_share"] > 0.35 and s["digit_ratio"] > 0.15),
    ("table", lambda s: s["digit_ratio"] > 0.25 and s["line_end_ratio"] < 0.3 and s["list_share"] < 0.6),
    ("junk", lambda s: s["word_count"] == 0),
    ("junk", lambda s: s["blob_ratio"] > 0.3 or s["mangled_ratio"] > 0.08 or (s["symbol_ratio"] > 0.45 and s["table_share"] < 0.5)),
    ("junk", lambda s: s["code_ratio"] > 0.25),
    ("junk", lambda s: s["cluster_ratio"] > 0.3 and s["common_ratio"] < 0.05),
    ("junk", _over_and_over),
    ("junk", lambda s: _garbled(s) or _over_and_over(s) or s["word_count"] == 0),
    ("junk", lambda s: s["word_count"] >= 20 and s["common_ratio"] < 0.02 and s["table_share"] < 0.5 and s["list_share"] < 0.5),
    ("prose", lambda s: s["sentence_share"] >= 0.5 and not _garbled(s) and not _over_and_over(s)),
    ("prose", lambda s: s["line_end_ratio"] >= 0.5 and s["common_ratio"] >= 0.06),
    ("prose", lambda s: s["sentence_share"] >= 0.4 and s["common_ratio"] >= 0.06 and s["mean_line_words"] >= 5),
)
#: What a function is taken to do before its votes are seen: it fires on this share of its own type and of the others.
FIRES, FIRES_ELSEWHERE = 0.7, 0.03


def learn_accuracies(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100, prior: float = 0.05) -> tuple[np.ndarray, np.ndarray]:
    """(shares of the types, how often each function fires on each type) from the vote patterns and how many documents have each.

    Expectation-maximization of independent functions given the type. What is assumed before counts as ``prior`` of the
    documents, so that types can't swap their names.
    """
    own = np.array([[kind == t for t in TYPES] for kind, _ in VOTES])
    start = np.where(own, FIRES, FIRES_ELSEWHERE)
    weight = prior * counts.sum() / len(TYPES)
    mix = np.full(len(TYPES), 1 / len(TYPES))
    fires = start
    for _ in range(rounds):
        post = posterior(patterns, mix, fires) * counts[:, None]
        total = post.sum(0)
        mix_new = (total + weight) / (total + weight).sum()
        fires_new = (patterns.T @ post + weight * start) / (total + weight)
        fires_new = np.clip(fires_new, 1e-4, 1 - 1e-4)
        done = np.abs(fires_new - fires).max() < 1e-6
        mix, fires = mix_new, fires_new
        if done:
            break
    return mix, fires


def posterior(patterns: np.ndarray, mix: np.ndarray, fires: np.ndarray) -> np.ndarray:
    logs = patterns @ np.log(fires) + (1 - patterns) @ np.log(1 - fires) + np.log(mix)
    logs -= logs.max(1, keepdims=True)
    p = np.exp(logs)
    return p / p.sum(1, keepdims=True)


def text_types(df: DataFrame, common_words: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, the statistics, votes, form, confidence, p_prose, p_list, p_table, p_junk) of each distinct (id, text).

    Defined cases: null ids have no row; a null text is an empty one, and empty texts are junk; a text of any length is read whole;
    an empty table gives an empty result; other columns are ignored.
    """
    words = [r.word.lower() for r in common_words.select("word").dropna().distinct().limit(100_000).collect()]
    common = frozenset(words) | frozenset(map(_plain, words))
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text")).filter("doc_id is not null")
    names = ["doc_id", *STATISTICS, "votes"]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        traits = run.__dict__.get("traits") or run.__dict__.setdefault("traits", TokenTraits(common))
        found = [statistics(t, traits) for t in batch.column(1).to_pylist()]
        votes = [sum(1 << j for j, (_, fire) in enumerate(VOTES) if fire(s)) for s in found]
        cols = [batch.column(0), *(pa.array([s[k] for s in found], pa.float64()) for k in STATISTICS), pa.array(votes, pa.int32())]
        return pa.RecordBatch.from_arrays(cols, names=names)

    schema = "doc_id long, " + ", ".join(f"{k} double" for k in STATISTICS) + ", votes int"
    seen = cut(map_columns(rows, run, schema).distinct())
    return seen.join(F.broadcast(_types_of_patterns(seen)), "votes")


def _types_of_patterns(seen: DataFrame) -> DataFrame:
    """One row per vote pattern: at most 2 ** len(VOTES) small rows."""
    got = seen.groupBy("votes").agg(F.count("*").alias("n")).collect()
    schema = "votes int, form string, confidence double, " + ", ".join(f"p_{t} double" for t in TYPES)
    if not got:
        return seen.sparkSession.createDataFrame([], schema)
    got = sorted((r.votes, r.n) for r in got)
    patterns = np.array([[v >> j & 1 for j in range(len(VOTES))] for v, _ in got], float)
    p = posterior(patterns, *learn_accuracies(patterns, np.array([n for _, n in got], float)))
    rows = [(v, TYPES[int(x.argmax())], float(x.max()), *map(float, x)) for (v, _), x in zip(got, p)]
    return seen.sparkSession.createDataFrame(rows, schema)
