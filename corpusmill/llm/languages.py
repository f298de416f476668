"""Languages of documents and of the passages of mixed ones (problem 3).

One character language model per language: interpolated Kneser-Ney of order ``ORDER`` inside words, kept in sorted
arrays of n-gram hashes. A passage gets the language of the lowest length-normalised cross-entropy; it is rejected
(``und``) where even that is worse than nearly all running text of the language. As a model never looks across a blank,
a word's entropy is computed once per task and kept, so texts cost one lookup a word.

Training reads all rows, labels aren't trusted: sentences that the common words given per language tell make the first models, all those that
the first models tell apart clearly the second ones. Words are counted in the tasks and their n-grams summed by a shuffle, so
the driver gets distinct n-grams, which hardly grow with the texts. Thresholds are read off counts over all sentences told by common
words, kept to a thousandth of a nat. So texts are read three times, the last time to classify them; only words, n-grams and what was found
are shuffled. Rows delivered twice are one in the result, but train twice.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, map_columns

ORDER = 5
ALPHABET = 256
_U = np.uint64
_BASE, _SALT = _U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F)

#: Pieces that are looked at together: up to the end of a sentence or of a line.
PIECE = re.compile(r"[^\n.!?…]+(?:[.!?…](?!\s|$)[^\n.!?…]*)*[.!?…]*[\"'”»)\]]*")
#: A quotation within a line of up to so many characters is a title, whose words don't count; a longer one is running text.
TITLE_CHARS = 120
QUOTED = re.compile(r"„[^”\"\n]{0,N}[”\"“]|«[^»\n]{0,N}»|“[^”\n]{0,N}”|\"[^\"\n]{0,N}\"".replace("N", str(TITLE_CHARS)))
LETTERS = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?")
WORDS = re.compile(r"[^\W_]+")

#: Words of a sentence that may train or calibrate.
LEAST_WORDS = 5
#: Rates and margins are counted in units of 1 / STEPS nats.
STEPS = 1000
#: Distinct words that a task keeps before it hands on their counts, and words whose n-grams are made at once.
KEPT_WORDS, GRAM_WORDS = 400_000, 50_000
#: What a count of the calibration is of: a sentence's rate in its own language's model, in another's, its margin a word.
OWN, FOREIGN, MARGIN = range(3)


def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of the words between blanks, place of each in its word, number of its word."""
    text = "".join(f" {w} " for w in words)
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    sizes = np.array([len(w) + 2 for w in words])
    word = np.repeat(np.arange(len(words)), sizes)
    place = np.arange(len(codes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return codes, place, word


def _grams(codes: np.ndarray, order: int) -> list[np.ndarray]:
    """Hashes of the 1-, 2-, ... ``order``-grams that end at each place (meaningless where they would leave the word)."""
    out = []
    h = np.zeros(len(codes), np.uint64)
    for n in range(order):
        earlier = np.zeros(len(codes), np.uint64)
        if n < len(codes):
            earlier[n:] = codes[: len(codes) - n]
        h = h + (earlier + _U(1)) * _BASE ** _U(n + 1)
        x = h ^ (h >> _U(29))
        out.append(x * _SALT)
    return out


def gram_table(words: list[str], weight: np.ndarray, order: int = ORDER) -> dict[int, tuple[np.ndarray, ...]]:
    """For each n the distinct n-grams of the words: hash, hash without the last character, without the first, whether it begins the word, weight."""
    codes, place, word = _codes(words)
    grams = _grams(codes, order)
    weight = weight[word]
    out = {}
    for n in range(min(2, order), order + 1):
        at = np.flatnonzero((place >= n - 1) & (place > 0))  # the first blank is given, never predicted
        keys, first, inverse = np.unique(grams[n - 1][at], return_index=True, return_inverse=True)
        where = at[first]
        none = np.zeros(len(keys), np.uint64)
        out[n] = (keys, grams[n - 2][where - 1] if n > 1 else none, grams[n - 2][where] if n > 1 else none, place[where] == n - 1, np.bincount(inverse, weight[at], len(keys)).astype(np.float64))
    return out


class KneserNey:
    """Interpolated Kneser-Ney over characters of words, in sorted hash arrays."""

    def __init__(self, words: Counter[str], order: int = ORDER):
        names = list(words)
        self._fit(gram_table(names, np.array([words[w] for w in names], np.float64), order), order)

    @classmethod
    def of_grams(cls, table: dict[int, tuple[np.ndarray, ...]], order: int = ORDER) -> KneserNey:
        """From what ``gram_table`` gives, each n sorted by hash."""
        model = cls.__new__(cls)
        model._fit(table, order)
        return model

    def _fit(self, table: dict[int, tuple[np.ndarray, ...]], order: int) -> None:
        self.order = order
        self.tables = []
        for n in range(order, 0, -1):
            if n == order:
                keys, context, _, _, counts = table[n]
            else:
                # grams at a word's start keep their counts, others count the characters that stand before them
                longer = table[n + 1][2]
                g, w = longer, np.ones(len(longer))
                if n > 1:
                    own, before, _, start, weight = table[n]
                    g, w = np.concatenate([own[start], g]), np.concatenate([weight[start], w])
                keys, counts = self._sum(g, w)
                context = before[np.searchsorted(own, keys)] if n > 1 else np.zeros(len(keys), np.uint64)
            ones, twos = (counts <= 1).sum(), ((counts > 1) & (counts <= 2)).sum()
            discount = min(0.95, max(0.1, ones / max(1, ones + 2 * twos)))
            contexts, inverse = np.unique(context, return_inverse=True)
            total = np.bincount(inverse, counts)
            kinds = np.bincount(inverse)
            alpha = np.maximum(counts - discount, 0) / total[inverse]
            back = discount * kinds / total
            self.tables.append((keys, alpha, contexts, back))
        self.tables.reverse()

    @staticmethod
    def _sum(keys: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        out, inverse = np.unique(keys, return_inverse=True)
        return out, np.bincount(inverse, weight)

    @staticmethod
    def _look(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, missing: float) -> np.ndarray:
        if not len(keys):
            return np.full(len(wanted), missing)
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return np.where(keys[at] == wanted, values[at], missing)

    def cost(self, words: list[str]) -> np.ndarray:
        """Nats of each word, its final blank included."""
        codes, place, word = _codes(words)
        grams = _grams(codes, self.order)
        p = np.full(len(codes), 1 / ALPHABET)
        for n, (keys, alpha, contexts, back) in enumerate(self.tables, 1):
            fits = place >= n - 1
            a = self._look(keys, alpha, grams[n - 1], 0.0)
            if n == 1:
                b = np.full(len(codes), back[0])
            else:
                context = np.concatenate([[_U(0)], grams[n - 2][:-1]])
                b = self._look(contexts, back, context, 1.0)
            p = np.where(fits, a + b * p, p)
        nats = np.where(place > 0, -np.log(p), 0.0)
        return np.bincount(word, nats, len(words))


def plain(word: str) -> str:
    if word.isascii():
        return word
    out = unicodedata.normalize("NFD", word.replace("ł", "l").replace("ß", "ss"))
    return "".join(c for c in out if not unicodedata.combining(c) or c == "̆")


@dataclass
class LanguageModels:
    names: list[str]
    models: list[KneserNey]
    worst: np.ndarray  # nats a character above which a passage is no running text of the language
    scale: float  # of the margin a word in the confidence

    def __post_init__(self):
        self.known: dict[str, tuple[float, ...]] = {}

    def __getstate__(self):
        return {**self.__dict__, "known": {}}

    def learn(self, words: set[str]) -> None:
        new = [w for w in words if w not in self.known]
        if not new:
            return
        if len(self.known) > 1_500_000:
            self.known.clear()
            new = list(words)
        for i in range(0, len(new), 50_000):
            part = new[i : i + 50_000]
            costs = np.stack([m.cost(part) for m in self.models], 1)
            self.known.update(zip(part, map(tuple, costs.tolist())))

    def nats(self, words: list[str]) -> np.ndarray:
        """Nats of each word (row) in each language."""
        self.learn(set(words))
        return np.array([self.known[w] for w in words]).reshape(len(words), len(self.names))


def sentences(text: str) -> list[tuple[int, int, list[str], int]]:
    """(start, end, lower-cased words of letters outside quotation marks, words outside them) of each piece."""
    out = []
    for m in PIECE.finditer(text):
        piece = m.group()
        if "„" in piece or '"' in piece or "“" in piece or "«" in piece:
            piece = QUOTED.sub(" ", piece)
        n = len(WORDS.findall(piece))
        if n:
            out.append((m.start(), m.end(), [w.lower() for w in LETTERS.findall(piece)], n))
    return out


@dataclass
class Words:
    """The words of many sentences: the distinct ones, which stands at each place, the sentence of each place, words of each sentence."""

    distinct: list[str]
    at: np.ndarray
    sentence: np.ndarray
    sizes: np.ndarray

    @classmethod
    def of(cls, pieces: list[list[str]]) -> Words:
        number: dict[str, int] = {}
        at = np.array([number.setdefault(w, len(number)) for words in pieces for w in words], np.int64)
        sizes = np.array([len(p) for p in pieces], np.int64)
        return cls(list(number), at, np.repeat(np.arange(len(pieces)), sizes), sizes)

    def sums(self, of_words: np.ndarray) -> np.ndarray:
        """Sums over the words of each sentence, for each column of a table of the distinct words."""
        return np.stack([np.bincount(self.sentence, of_words[self.at, k], len(self.sizes)) for k in range(of_words.shape[1])], 1)

    def letters(self) -> np.ndarray:
        return self.sums(np.array([[len(w) + 1.0] for w in self.distinct]).reshape(-1, 1))[:, 0]

    def count(self, language: np.ndarray, bags: list[Counter]) -> None:
        """Add the words of each sentence to the bag of its language, which is -1 for none."""
        of_place = language[self.sentence]
        for k, bag in enumerate(bags):
            counts = np.bincount(self.at[of_place == k], minlength=len(self.distinct))
            for i in np.flatnonzero(counts).tolist():
                bag[self.distinct[i]] += int(counts[i])


class CommonWords:
    """Tells a sentence's language by the common words of each."""

    def __init__(self, common: dict[str, set[str]], least_hits: int = 2):
        self.names, self.least_hits = sorted(common), least_hits
        of: dict[str, list[int]] = defaultdict(list)
        for k, name in enumerate(self.names):
            for w in common[name]:
                of[w].append(k)
        self.shares = {w: tuple(float(k in ks) / len(ks) for k in range(len(self.names))) for w, ks in of.items()}

    def tell(self, words: Words) -> np.ndarray:
        """The language of each sentence of which it holds at least ``least_hits`` common words and of no other half as many; else -1."""
        none = (0.0,) * len(self.names)
        hits = words.sums(np.array([self.shares.get(w, none) for w in words.distinct]).reshape(-1, len(self.names)))
        best = hits.argmax(1)
        top = np.take_along_axis(hits, best[:, None], 1)
        rest = np.where(np.arange(len(self.names)) == best[:, None], -np.inf, hits)
        return np.where((top[:, 0] >= self.least_hits) & (rest <= top / 2).all(1), best, -1)


def tell_apart(words: Words, models: LanguageModels) -> np.ndarray:
    """The language of each sentence whose cost is clearly lowest in its model; else -1."""
    cost = words.sums(models.nats(words.distinct))
    lowest = np.sort(cost, 1)
    clear = lowest[:, 1] - lowest[:, 0] > 0.8 * words.sizes if len(models.names) > 1 else np.full(len(cost), True)
    return np.where(clear, cost.argmin(1), -1)


def tally(words: Words, models: LanguageModels, language: np.ndarray) -> Counter[tuple[int, int, int]]:
    """How often each (OWN, FOREIGN or MARGIN, model, value in 1 / STEPS nats) occurs among the sentences of a known language."""
    cost = words.sums(models.nats(words.distinct))
    each = np.rint(cost / words.letters()[:, None] * STEPS).astype(np.int64)
    out: Counter[tuple[int, int, int]] = Counter()
    for k in range(len(models.names)):
        own = language == k
        if own.any():
            for other in range(len(models.names)):
                out.update((OWN if other == k else FOREIGN, other, v) for v in each[own, other].tolist())
            margin = (np.delete(cost[own], k, 1).min(1) - cost[own, k]) / words.sizes[own] if len(models.names) > 1 else np.ones(own.sum())
            out.update((MARGIN, k, v) for v in np.rint(margin * STEPS).astype(np.int64).tolist())
    return out


def calibrate(models: LanguageModels, counts: dict[tuple[int, int, int], int]) -> LanguageModels:
    """Set the thresholds by the counts that ``tally`` gives."""
    of: dict[tuple[int, int], list[tuple[float, int]]] = defaultdict(list)
    for (kind, k, value), n in counts.items():
        of[kind, 0 if kind == MARGIN else k].append((value / STEPS, n))

    def column(kind: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        rows = np.array(sorted(of[kind, k]), np.float64).reshape(-1, 2)
        return rows[:, 0], rows[:, 1]

    for k in range(len(models.names)):
        (own, own_counts), (foreign, foreign_counts) = column(OWN, k), column(FOREIGN, k)
        models.worst[k] = rejection(own, foreign, own_counts=own_counts, foreign_counts=foreign_counts)
    margins, n = column(MARGIN, 0)
    if len(margins):
        # the confidence of a five-word passage with a margin at the tenth percentile is 0.9
        tenth = margins[np.searchsorted(np.cumsum(n), 0.1 * n.sum())]
        models.scale = math.log(9) / max(1e-3, float(tenth) * 5)
    return models


def with_plain(words: list[str], counts: list[int]) -> tuple[list[str], np.ndarray]:
    """The words, and once more those with marks, without them."""
    bare = [(p, n) for w, n in zip(words, counts) if (p := plain(w)) != w]
    return words + [p for p, _ in bare], np.array([*counts, *(n for _, n in bare)], np.float64)


def train(texts: list[str], common: dict[str, set[str]], least_hits: int = 2) -> LanguageModels:
    """Models from unlabelled texts in memory, the same that ``fit`` makes of a table: a sentence trains the language whose common words it
    holds at least ``least_hits`` of and no other language half as many of; then once more with all sentences that the first models tell apart clearly."""
    by_words = CommonWords(common, least_hits)
    names = by_words.names
    words = Words.of(_long(texts))

    def models(language: np.ndarray) -> LanguageModels:
        bags = [Counter(sorted(common[name])) for name in names]  # a language without a sentence keeps its common words
        words.count(language, bags)
        return LanguageModels(names, [KneserNey.of_grams(gram_table(*with_plain(list(b), list(b.values())))) for b in bags], np.full(len(names), np.inf), 1.0)

    told = by_words.tell(words)
    second = models(tell_apart(words, models(told)))
    return calibrate(second, tally(words, second, told))


def _long(texts: list[str]) -> list[list[str]]:
    return [w for text in texts for _, _, w, _ in sentences(text) if len(w) >= LEAST_WORDS]


def rejection(own: list[float], foreign: list[float], least: int = 20, untrained: float = 3.0, own_counts: np.ndarray | None = None, foreign_counts: np.ndarray | None = None) -> float:
    """The cross-entropy above which a text isn't the model's language: the middle of the range in which fewest sentences of the
    language itself are lost and fewest of the other languages are taken, as shares of both. ``untrained`` with fewer than ``least`` of either.
    The counts tell how often each value occurs, once if not given."""
    sides = []
    for values, counts in ((own, own_counts), (foreign, foreign_counts)):
        values = np.asarray(values, np.float64)
        order = np.argsort(values)
        sides.append((values[order], np.r_[0.0, np.cumsum(np.ones(len(values)) if counts is None else counts[order])]))
    (own, lost), (foreign, taken) = sides
    if min(lost[-1], taken[-1]) < least:
        return untrained
    at = np.unique(np.r_[own, foreign])
    wrong = 1 - lost[np.searchsorted(own, at, side="right")] / lost[-1] + taken[np.searchsorted(foreign, at, side="right")] / taken[-1]
    best = np.flatnonzero(wrong <= wrong.min() + 1e-12)
    end = at[best[-1] + 1] if best[-1] + 1 < len(at) else at[best[-1]]
    return float((at[best[0]] + end) / 2)


def passages(text: str, models: LanguageModels, switch: float = 24.0) -> list[tuple[int, int, str, float, int]]:
    """(start, end, language, confidence, words) of the text's passages, in order."""
    units = sentences(text)
    words = Words.of([u[2] for u in units])
    costs = words.sums(models.nats(words.distinct)).tolist()
    return [judged(p, models.names, models.worst, models.scale) for p in cheapest(units, costs, len(models.names), switch)]


def cheapest(units: list[tuple[int, int, list[str], int]], costs: list[list[float]], k: int, switch: float = 24.0) -> list[tuple[int, int, int, float, float, int]]:
    """(start, end, language or -1, nats a character, nats less than the next language, words) of the passages, in order.

    The cheapest sequence of languages over the pieces, a change costing ``switch`` nats: a name, a title or a
    short line stays in the passage around it.
    """
    if not units:
        return []
    states = range(k)
    best, back = [0.0] * k, []
    for cost in costs:
        low = min(best)
        at = best.index(low)
        low += switch
        back.append([s if best[s] <= low else at for s in states])
        best = [min(best[s], low) + cost[s] for s in states]
    s = best.index(min(best))
    path = [s]
    for b in reversed(back[1:]):
        s = b[s]
        path.append(s)
    path.reverse()
    out = []
    i = 0
    while i < len(units):
        j = i
        while j < len(units) and path[j] == path[i]:
            j += 1
        total = [sum(c) for c in zip(*costs[i:j])]
        letters = sum(len(w) + 1 for u in units[i:j] for w in u[2])
        s = path[i]
        n = sum(u[3] for u in units[i:j])
        if letters:
            other = min((t for q, t in enumerate(total) if q != s), default=total[s])
            out.append((units[i][0], units[j - 1][1], s, total[s] / letters, other - total[s], n))
        else:
            out.append((units[i][0], units[j - 1][1], -1, 0.0, 0.0, n))
        i = j
    return out


def judged(passage: tuple[int, int, int, float, float, int], names: list[str], worst: np.ndarray, scale: float) -> tuple[int, int, str, float, int]:
    """(start, end, language, confidence, words) of a passage of ``cheapest``: ``und`` if it has no letters or costs more than running text."""
    start, end, s, rate, margin, n = passage
    if s < 0 or rate > worst[s]:
        return start, end, "und", 0.0, n
    return start, end, names[s], 1 / (1 + math.exp(-max(-500.0, min(500.0, margin * scale)))), n


def label_languages(label: str | None, names: set[str]) -> frozenset[str] | None:
    """Languages that a label names; None if it names none. Case and regions don't matter."""
    parts = (label or "").strip().lower().replace("_", "-").split("-")
    if not parts[0] or parts[0] in ("und", "unknown"):
        return None
    return frozenset([parts[0], *(p for p in parts[1:] if p in names)])


def _parts(batches: Iterator[pa.RecordBatch], rows: int = 2000) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def _bags(texts: DataFrame, languages: int, tell: Callable[[Words], np.ndarray]) -> DataFrame:
    """(lang, word, n): how often each word stands in the sentences of each language, over all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bags: list[Counter] = [Counter() for _ in range(languages)]

        def emptied() -> Iterator[pa.RecordBatch]:
            for k, bag in enumerate(bags):
                if bag:
                    yield pa.RecordBatch.from_arrays([pa.array([k] * len(bag), pa.int32()), pa.array(list(bag), pa.string()), pa.array(list(bag.values()), pa.int64())], names=["lang", "word", "n"])
                    bag.clear()

        for batch in _parts(batches):
            words = Words.of(_long([t for t in batch.column(0).to_pylist() if t]))
            words.count(tell(words), bags)
            if sum(map(len, bags)) > KEPT_WORDS:
                yield from emptied()
        yield from emptied()

    return texts.mapInArrow(run, "lang int, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _models(bags: DataFrame, common: dict[str, set[str]]) -> LanguageModels:
    """One model per language of the bags' words and its common words. Only distinct n-grams reach the driver."""
    names = sorted(common)
    own = pa.table({"lang": pa.array([k for k, name in enumerate(names) for _ in common[name]], pa.int32()), "word": [w for name in names for w in sorted(common[name])]})
    own = own.append_column("n", pa.array([1] * len(own), pa.int64()))  # a language without a sentence keeps its common words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, tuple[list[str], list[int]]] = defaultdict(lambda: ([], []))

        def emptied() -> Iterator[pa.RecordBatch]:
            for k, (words, counts) in kept.items():
                for n, (keys, before, after, start, weight) in gram_table(*with_plain(words, counts)).items():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(keys), k, np.int32)), pa.array(np.full(len(keys), n, np.int32)), *(pa.array(x.view(np.int64)) for x in (keys, before, after)), pa.array(start), pa.array(weight)],
                        names=["lang", "n", "gram", "before", "after", "start", "weight"],
                    )
            kept.clear()

        for batch in _parts(batches):
            for k, word, count in zip(*(c.to_pylist() for c in batch.columns)):
                kept[k][0].append(word)
                kept[k][1].append(count)
            if sum(len(words) for words, _ in kept.values()) > GRAM_WORDS:
                yield from emptied()
        yield from emptied()

    grams = bags.union(bags.sparkSession.createDataFrame(own)).mapInArrow(run, "lang int, n int, gram long, before long, after long, start boolean, weight double")
    grams = grams.groupBy("lang", "n", "gram").agg(*(F.first(c).alias(c) for c in ("before", "after", "start")), F.sum("weight").alias("weight"))
    lang, n, gram, before, after, start, weight = (c.to_numpy() for c in grams.toArrow().columns)
    gram, before, after = (x.view(np.uint64) for x in (gram, before, after))
    models = []
    for k in range(len(names)):
        table = {}
        for length in range(min(2, ORDER), ORDER + 1):
            at = np.flatnonzero((lang == k) & (n == length))
            at = at[np.argsort(gram[at])]
            table[length] = (gram[at], before[at], after[at], start[at], weight[at])
        models.append(KneserNey.of_grams(table))
    return LanguageModels(names, models, np.full(len(names), np.inf), 1.0)


def fit(df: DataFrame, common: dict[str, set[str]], text_col: str) -> LanguageModels:
    """Models of all texts of the table, still without thresholds."""
    texts = df.select(F.col(text_col).alias("t")).filter("t is not null")
    by_words = CommonWords(common)
    first = df.sparkSession.sparkContext.broadcast(_models(_bags(texts, len(common), by_words.tell), common))
    models = _models(_bags(texts, len(common), lambda words: tell_apart(words, first.value)), common)
    first.destroy()
    return models


def identify(df: DataFrame, common_words: DataFrame, id_col: str = "id", text_col: str = "text", label_col: str = "language", min_words: int = 20) -> DataFrame:
    """(id, label, langs, confidence, label_state, words, passages) of each distinct (id, text, label).

    ``langs`` are the languages of at least ``min_words`` words, sorted; ``label_state`` is right, wrong or missing;
    passages is an array of (start, end, lang, confidence, words) with positions in characters. The common words are a table of some hundred rows.
    Defined cases: null ids have no row; null and empty texts have no passages and no languages; texts under ``min_words`` words have
    no languages; an empty table gives an empty result; other columns are ignored.
    """
    common: dict[str, set[str]] = defaultdict(set)
    for r in common_words.select("lang", "word").dropna().distinct().collect():
        common[r.lang].add(r.word.lower())
    if not common:
        raise ValueError("no common words, so no languages")
    by_words = CommonWords(common)
    fitted = fit(df, common, text_col)
    models = df.sparkSession.sparkContext.broadcast(fitted)
    rows = df.select(F.col(id_col).cast("string").alias("id"), F.col(label_col).cast("string").alias("label"), F.col(text_col).alias("text"))
    part = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.int32()), ("rate", pa.float64()), ("margin", pa.float64()), ("words", pa.int32())])
    tallied = pa.struct([("kind", pa.int32()), ("lang", pa.int32()), ("value", pa.int64()), ("n", pa.int64())])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = models.value
        counts: Counter[tuple[int, int, int]] = Counter()

        def batch_of(ids: pa.Array, labels: pa.Array, found: list, told: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([ids, labels, pa.array(found, pa.list_(part)), pa.array(told, pa.list_(tallied))], names=["id", "label", "passages", "counts"])

        for batch in _parts(batches):
            units = [sentences(t or "") for t in batch.column(2).to_pylist()]
            words = Words.of([u[2] for text in units for u in text])
            costs = words.sums(m.nats(words.distinct)).tolist()
            found, at = [], 0
            for text in units:
                found.append([dict(zip(part.names, p)) for p in cheapest(text, costs[at : at + len(text)], len(m.names))])
                at += len(text)
            long = Words.of([u[2] for text in units for u in text if len(u[2]) >= LEAST_WORDS])
            counts.update(tally(long, m, by_words.tell(long)))
            yield batch_of(batch.column(0), batch.column(1), found, [None] * batch.num_rows)
        if counts:  # one row without id, of the task
            yield batch_of(pa.array([None], pa.string()), pa.array([None], pa.string()), [None], [[dict(zip(tallied.names, (*key, n))) for key, n in counts.items()]])

    fields = "array<struct<start int, end int, lang int, rate double, margin double, words int>>"
    found = cut(rows.mapInArrow(find, f"id string, label string, passages {fields}, counts array<struct<kind int, lang int, value long, n long>>"))
    models.destroy()
    told = found.filter("counts is not null").select(F.explode("counts").alias("c")).groupBy("c.kind", "c.lang", "c.value").agg(F.sum("c.n").alias("n")).collect()
    calibrate(fitted, {(r.kind, r.lang, r.value): r.n for r in told})
    names, worst, scale = fitted.names, fitted.worst, fitted.scale

    def judge(batch: pa.RecordBatch) -> pa.RecordBatch:
        langs, sure, state, sizes, found = [], [], [], [], []
        for raw, label in zip(batch.column(2).to_pylist(), batch.column(1).to_pylist()):
            parts = [judged(tuple(p.values()), names, worst, scale) for p in raw]
            by: Counter[str] = Counter()
            weight: Counter[str] = Counter()
            for _, _, lang, c, n in parts:
                by[lang] += n
                weight[lang] += c * n
            n = sum(by.values())
            own = sorted(k for k, v in by.items() if v >= min_words and k != "und") if n >= min_words else []
            named = label_languages(label, set(names))
            langs.append(own)
            sure.append(min((weight[k] / by[k] for k in own), default=0.0))
            state.append("missing" if named is None else "right" if named == set(own) else "wrong")
            sizes.append(n)
            found.append([{"start": a, "end": z, "lang": k, "confidence": c, "words": w} for a, z, k, c, w in parts])
        part = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string()), ("confidence", pa.float64()), ("words", pa.int32())])
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(langs, pa.list_(pa.string())), pa.array(sure, pa.float64()), pa.array(state), pa.array(sizes, pa.int32()), pa.array(found, pa.list_(part))],
            names=["id", "label", "langs", "confidence", "label_state", "words", "passages"],
        )

    schema = "id string, label string, langs array<string>, confidence double, label_state string, words int, passages array<struct<start int, end int, lang string, confidence double, words int>>"
    return map_columns(found.filter("id is not null").select("id", "label", "passages"), judge, schema).distinct()
