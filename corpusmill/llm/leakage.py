"""Test items standing in training documents (problem 6).

Documents that share no run of ``min_words`` words with any item are passed over by the hashes of such runs. The others stream through
a generalised suffix automaton of the normalised words of the items: it keeps the length of the longest run of words, ending at
the present one, that stands in some item; runs of ``min_words`` or more are spans.

Scale: documents are read once (for every ``SLICE_WORDS`` words of items) and never shuffled (only the spans found are made distinct). Items
travel as word hashes of bounded size; executors build automata, of the items met only where all are too many for one.
"""

from __future__ import annotations

import itertools
import unicodedata
from collections import defaultdict

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, cut, map_columns

#: Words of items that are sent to the executors at once (32 MB), and of one automaton (some 50 MB).
SLICE_WORDS, BLOCK_WORDS = 4_000_000, 50_000
_STEP = np.uint64(0x9E3779B97F4A7C15)

#: Letters whose mark Unicode doesn't take apart. Fixed values.
_PLAIN = str.maketrans({"ł": "l", "đ": "d", "ø": "o", "ħ": "h", "ŧ": "t", "ı": "i"})


def fold(word: str) -> str:
    """Without case and diacritics."""
    word = word.casefold()
    if word.isascii():
        return word
    marks = unicodedata.normalize("NFD", word)
    return "".join(c for c in marks if not unicodedata.combining(c)).translate(_PLAIN)


def words_of(text: str) -> list[str]:
    """Runs of letters and digits; marks that stand as characters of their own belong to their letter."""
    return WORD.findall(text if unicodedata.is_normalized("NFC", text) else unicodedata.normalize("NFC", text))


class SuffixAutomaton:
    """Of several word sequences; each state knows the items in which its runs stand."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.own: list[set[int]] = [set()]

    def _state(self, length: int, nxt: dict[int, int], link: int) -> int:
        self.next.append(nxt)
        self.length.append(length)
        self.link.append(link)
        self.own.append(set())
        return len(self.next) - 1

    def _extend(self, last: int, w: int) -> int:
        if w in self.next[last]:
            q = self.next[last][w]
            if self.length[q] == self.length[last] + 1:
                return q
            return self._clone(last, q, w)
        cur = self._state(self.length[last] + 1, {}, 0)
        p = last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = cur
            p = self.link[p]
        if p >= 0:
            q = self.next[p][w]
            self.link[cur] = q if self.length[q] == self.length[p] + 1 else self._clone(p, q, w)
        return cur

    def _clone(self, p: int, q: int, w: int) -> int:
        new = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = new
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = new
            p = self.link[p]
        return new

    def add(self, item: int, words: list[int]) -> None:
        last = 0
        for w in words:
            last = self._extend(last, w)
            self.own[last].add(item)

    def finish(self, least: int) -> None:
        """Hand the items of each state to the shorter runs that end it, for runs of ``least`` words or more."""
        for s in sorted(range(1, len(self.next)), key=lambda s: -self.length[s]):
            if self.link[s] > 0:
                self.own[self.link[s]] |= self.own[s]
        self.items = [tuple(sorted(o)) if n >= least else () for o, n in zip(self.own, self.length)]
        del self.own

    def spans(self, words: list[int], least: int) -> dict[int, list[list[int]]]:
        """For each item, the [start, end) runs of ``least`` words or more that stand in it, as long as they can be."""
        out: dict[int, list[list[int]]] = defaultdict(list)
        s = n = 0
        nxt, link, length, items = self.next, self.link, self.length, self.items
        for at, w in enumerate(words):
            while s and w not in nxt[s]:
                s = link[s]
                n = length[s]
            if w in nxt[s]:
                s = nxt[s][w]
                n += 1
            v, m = s, n
            while v > 0 and m >= least:
                for item in items[v]:
                    runs = out[item]
                    start = at + 1 - m
                    if runs and runs[-1][0] <= start and runs[-1][1] >= at and start - runs[-1][0] == 0:
                        runs[-1][1] = at + 1
                    elif not (runs and runs[-1][0] <= start and runs[-1][1] == at + 1):
                        runs.append([start, at + 1])
                v = link[v]
                m = length[v]
        return out


def grams_of(words: np.ndarray, n: int) -> np.ndarray:
    """A hash of each run of ``n`` word hashes."""
    out = np.zeros(max(0, len(words) - n + 1), np.uint64)
    for j in range(n):
        out = out * _STEP + words[j : len(words) - n + 1 + j]
    return out


class Items:
    """The word hashes of a bounded set of items; sorted runs and automata are built where they are needed, once a worker."""

    def __init__(self, ids: np.ndarray, begins: np.ndarray, words: np.ndarray, least: int):
        self.ids, self.begins, self.words, self.least = ids, begins, words, least
        self.ready: tuple[np.ndarray, np.ndarray] | None = None
        self.last: tuple[frozenset[int], SuffixAutomaton] | None = None

    def _own(self, k: int) -> np.ndarray:
        return self.words[self.begins[k] : self.begins[k + 1]]

    def holding(self, grams: np.ndarray) -> list[tuple[int, int]]:
        """(place in ``grams``, number of an item) of the runs that stand in items."""
        if self.ready is None:
            runs = [grams_of(self._own(k), self.least) for k in range(len(self.ids))]
            flat = np.concatenate([*runs, np.zeros(0, np.uint64)])
            owner = np.repeat(np.arange(len(runs)), [len(r) for r in runs])
            order = np.argsort(flat, kind="stable")
            self.ready = flat[order], owner[order]
        flat, owner = self.ready
        low = np.searchsorted(flat, grams)
        places = np.flatnonzero(flat[np.minimum(low, len(flat) - 1)] == grams) if len(flat) else []
        return [(int(p), int(k)) for p in places for k in owner[low[p] : np.searchsorted(flat, grams[p], side="right")]]

    def automata(self, wanted: set[int]):
        """Generalised automata of the wanted items, none of more than ``BLOCK_WORDS`` words (or one item); of all items where they fit one."""
        if len(self.words) <= BLOCK_WORDS:
            wanted = set(range(len(self.ids)))
        block, held = [], 0
        for k in [*sorted(wanted), None]:
            if block and (k is None or held + len(self._own(k)) > BLOCK_WORDS):
                key = frozenset(block)
                if self.last is None or self.last[0] != key:
                    sam = SuffixAutomaton()
                    for i in block:
                        sam.add(int(self.ids[i]), self._own(i).tolist())
                    sam.finish(self.least)
                    self.last = key, sam
                yield self.last
                block, held = [], 0
            if k is not None:
                block.append(k)
                held += len(self._own(k))


def leaked_spans(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", doc_text: str = "text", item_id: str = "item_id", item_text: str = "text",
    min_words: int = 12, slice_words: int = SLICE_WORDS,
) -> DataFrame:
    """(doc_id, item_id, start_word, end_word, n_words, item_share): every longest run of at least ``min_words`` words
    that a document has in common with an item.

    Defined cases: null or empty texts and null ids have no spans; items under ``min_words`` words can't leak; equal
    documents under several ids each have their spans; rows delivered twice count once; an empty table on either
    side gives an empty result; other columns are ignored. Documents are read once for every ``slice_words`` words of items (8 bytes each
    are sent to the executors), so what is sent is bounded however many items there are.
    """
    want = cut(_hashed(items.select(F.col(item_id).cast("long").alias("i"), F.col(item_text).alias("t")).dropna().distinct(), min_words))
    slices = max(1, -(-int(want.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]) * 5 // (4 * slice_words)))
    out = None
    for b in range(slices):
        own = want.filter(F.pmod(F.xxhash64("i", "n", F.element_at("w", 1)), F.lit(slices)) == b) if slices > 1 else want
        got = own.select("i", "w").orderBy("i", F.hash("w")).toArrow().combine_chunks()
        words = pa.concat_arrays([*(c.flatten() for c in got["w"].chunks), pa.array([], pa.int64())]).to_numpy().view(np.uint64)
        begins = np.r_[0, np.cumsum([len(x) for x in got["w"]])].astype(np.int64)
        found = _spans(docs, Items(got["i"].to_numpy(), begins, words, min_words), doc_id, doc_text)
        out = found if out is None else out.union(found)
    return out.distinct()


class WordHashes:
    """64-bit hashes of folded words, kept once known."""

    def __init__(self):
        self.known: dict[str, int] = {}

    def of(self, words: list[str]) -> list[int]:
        known = self.known
        try:
            return [known[w] for w in words]
        except KeyError:
            if len(known) > 1_000_000:
                known.clear()
            for w in words:
                if w not in known:
                    known[w] = xxhash.xxh3_64_intdigest(fold(w))
            return [known[w] for w in words]


def _hashed(items: DataFrame, least: int) -> DataFrame:
    """(i, n, w): id, number and hashes of the words of each item that has enough."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        hashes = run.__dict__.setdefault("hashes", WordHashes())
        rows = [(i, len(w), np.array(hashes.of(w), np.uint64).view(np.int64)) for i, t in zip(*(batch.column(k).to_pylist() for k in range(2))) if len(w := words_of(t)) >= least]
        if not rows:
            return None
        types = [pa.int64(), pa.int64(), pa.list_(pa.int64())]
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), types)], names=["i", "n", "w"])

    return map_columns(items, run, "i long, n long, w array<long>", rows=200)


def _spans(docs: DataFrame, items: Items, doc_id: str, doc_text: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(items)
    least, sizes = items.least, defaultdict(int)
    for k, i in enumerate(items.ids.tolist()):
        sizes[i] = max(sizes[i], int(items.begins[k + 1] - items.begins[k]))
    sizes = dict(sizes)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        known = shared.value
        hashes = run.__dict__.setdefault("hashes", WordHashes())
        texts = [words_of(t) for t in batch.column(1).to_pylist()]
        ids = [hashes.of(w) for w in texts]
        begins = np.cumsum([0, *map(len, ids)])
        flat = np.fromiter(itertools.chain.from_iterable(ids), np.uint64, int(begins[-1]))
        hit: dict[int, set[int]] = defaultdict(set)  # documents by item
        for place, item in known.holding(grams_of(flat, least)):
            doc = int(np.searchsorted(begins, place, side="right")) - 1
            if place + least <= begins[doc + 1]:
                hit[item].add(doc)
        number = batch.column(0).to_pylist()
        rows = []
        for own, sam in known.automata(set(hit)) if hit else ():
            for doc in sorted(set().union(*(hit.get(k, ()) for k in own))):
                for item, runs in sam.spans(ids[doc], least).items():
                    rows += [(number[doc], item, x, y, y - x, (y - x) / sizes[item]) for x, y in runs]
        if not rows:
            return None
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.float64()]
        names = ["doc_id", "item_id", "start_word", "end_word", "n_words", "item_share"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(doc_text).alias("text")).dropna()
    schema = "doc_id long, item_id long, start_word int, end_word int, n_words int, item_share double"
    return map_columns(rows, run, schema)


def without_spans(docs: DataFrame, spans: DataFrame, doc_id: str = "doc_id", doc_text: str = "text", most_words: int = 12, most_share: float = 0.2) -> DataFrame:
    """(doc_id, text, removed_words) of the documents from which a span was removed: those of more than ``most_words`` words or
    more than ``most_share`` of their item. Documents without such spans are unchanged and not listed."""
    bad = spans.filter((F.col("n_words") > most_words) | (F.col("item_share") > most_share))
    cuts = bad.groupBy("doc_id").agg(F.sort_array(F.collect_set(F.struct("start_word", "end_word"))).alias("cuts"))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(doc_text).alias("text")).dropna().join(cuts, "doc_id")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for d, text, spans in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if not unicodedata.is_normalized("NFC", text):
                text = unicodedata.normalize("NFC", text)
            at = [m.span() for m in WORD.finditer(text)]
            parts, done, gone = [], 0, 0
            for s in spans:
                a, z = at[s["start_word"]][0], at[s["end_word"] - 1][1]
                if z > done:
                    parts.append(text[done : max(a, done)])
                    done = z
            for w in at:
                gone += any(at[s["start_word"]][0] <= w[0] < at[s["end_word"] - 1][1] for s in spans)
            out.append((d, "".join([*parts, text[done:]]), gone))
        cols = list(zip(*out))
        return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.int32())], names=["doc_id", "text", "removed_words"])

    return map_columns(rows, run, "doc_id long, text string, removed_words int").distinct()
