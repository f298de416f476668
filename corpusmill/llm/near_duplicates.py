"""Near-duplicate groups by Order MinHash (problem 1).

Each text is a sequence of lower-cased words. A sketch keeps, for each of ``sketches`` hash functions, the
``picks`` smallest occurrence-labelled k-mers of words in the order in which they stand in the text: two texts agree
in a sketch when the same k-mers are smallest *and* stand in the same order, so the sketch follows edit similarity
rather than the bag of words. Texts that agree in a sketch and whose 256-bit one-permutation signatures are close are
candidates. A banded alignment of their words verifies them: words left out of it touch a known number of three-word runs at most, so
few edits prove that enough runs are common. Pairs that this doesn't prove (parts that changed places) are decided by the exact share.

Scale: one Python pass over the texts emits about 400 bytes a row; everything after moves only those bytes, and the
texts of candidates. Equal texts collapse to one representative before any pair is formed. Signatures and sizes are
compared inside the join of a bucket, so that only pairs which pass leave a task. A bucket of more than ``max_bucket`` texts (that share a
notice, say) is cut into parts: one side lies in one part each, the other is sent to all parts. Where only the groups are wanted
(``every_link=False``), all members of such a bucket are first compared with one leader, and then only those that aren't linked to it
with the others: no component is lost.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.grouping import bounded_broadcast
from .common import WORD, cut, discard, map_columns
from .graph import components

_U = np.uint64
_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)
BINS = 64
SIGNATURE_BITS = 4 * BINS
SHINGLE = 3


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> _U(31))
    x = x * _U(0xBF58476D1CE4E5B9)
    return x ^ (x >> _U(29))


def _kmers(words: np.ndarray, k: int) -> np.ndarray:
    n = len(words) - k + 1
    h = np.zeros(n, np.uint64)
    for j in range(k):
        h = _mix(h * _U(_ODD[j % 4]) + words[j : j + n])
    return h


def _label_occurrences(h: np.ndarray) -> np.ndarray:
    """The second, third, ... occurrence of a k-mer becomes a k-mer of its own."""
    order = np.argsort(h, kind="stable")
    s = h[order]
    new = np.r_[True, s[1:] != s[:-1]]
    if new.all():
        return h
    at = np.arange(len(s))
    nth = np.empty(len(s), np.uint64)
    nth[order] = at - np.maximum.accumulate(np.where(new, at, 0))
    return np.where(nth > 0, _mix(h + nth * _U(_ODD[3])), h)


class Sketcher:
    """Order MinHash sketches and the signature of one text's words."""

    def __init__(self, k: int = 5, picks: int = 2, sketches: int = 40, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.k, self.picks = k, picks
        self.mul = (rng.integers(1, 2**63, sketches).astype(np.uint64) * _U(2) + _U(1))[:, None]
        self.row = np.arange(sketches)
        self.salt = _mix(np.arange(1, sketches + 1, dtype=np.uint64) * _U(_ODD[0]))
        self.odd = np.array(_ODD, np.uint64)[:, None]
        self.bins = np.arange(BINS, dtype=np.uint64) << _U(58)
        self.known: dict[str, int] = {}

    def ids(self, words: list[str]) -> np.ndarray:
        known = self.known
        if len(known) > 2_000_000:
            known.clear()
        try:
            return np.array([known[w] for w in words], np.uint64)
        except KeyError:
            for w in words:
                if w not in known:
                    known[w] = xxhash.xxh64_intdigest(w)
            return np.array([known[w] for w in words], np.uint64)

    def sketch(self, ids: np.ndarray) -> np.ndarray:
        h = _label_occurrences(_kmers(ids, min(self.k, len(ids))))
        m = h * self.mul
        at = np.empty((len(self.row), min(self.picks, len(h))), np.int64)
        for j in range(at.shape[1]):
            at[:, j] = m.argmin(1)
            m[self.row, at[:, j]] = _U(0xFFFFFFFFFFFFFFFF)
        at.sort(1)
        out = self.salt
        for j in range(at.shape[1]):
            out = _mix(out * _U(_ODD[1]) + h[at[:, j]])
        return out.view(np.int64)

    def signature(self, ids: np.ndarray) -> tuple[np.ndarray, int]:
        """(one bit of the smallest of several hashes in each of 64 bins, four times, empty bins filled from the next that is not; distinct
        three-word runs)."""
        h = np.unique(_mix(_kmers(ids, min(SHINGLE, len(ids)))))
        bits = np.empty((4, BINS), bool)
        for j, x in enumerate(np.sort(_mix(h * self.odd), axis=1)):
            # in order, the first of a bin is its smallest, and where a bin is empty, that of the next that is not
            bits[j] = _mix(x[np.searchsorted(x, self.bins) % len(x)] + (self.bins >> _U(58)) * _U(_ODD[2])) & _U(1)
        return np.packbits(bits).view(np.int64), len(h)


def sketch_texts(df: DataFrame, id_col: str, text_col: str, min_words: int, k: int, picks: int, sketches: int) -> DataFrame:
    """(id, key, its first eight bytes, distinct three-word runs, sig, sketch) of each text of at least ``min_words`` words; null texts have none."""

    def make():
        maker: list[Sketcher] = []

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            if not maker:
                maker.append(Sketcher(k, picks, sketches))
            s = maker[0]
            ids, keys, runs, sigs, rows = [], [], [], [], []
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if text is None or i is None or len(words := WORD.findall(text.lower())) < min_words:
                    continue
                w = s.ids(words)
                ids.append(i)
                keys.append(xxhash.xxh3_128_digest(" ".join(words)))
                bits, n = s.signature(w)
                runs.append(n)
                sigs.append(bits)
                rows.append(s.sketch(w))
            if not ids:
                return None
            sig = np.array(sigs)
            flat = pa.array(np.concatenate(rows))
            offsets = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * sketches)
            cols = [pa.array(ids, pa.string()), pa.array(keys, pa.binary()), pa.array([int.from_bytes(k[:8], "big", signed=True) for k in keys], pa.int64()), pa.array(runs, pa.int32())]
            cols += [pa.array(np.ascontiguousarray(sig[:, j])) for j in range(4)]
            cols.append(pa.ListArray.from_arrays(offsets, flat))
            return pa.RecordBatch.from_arrays(cols, names=["id", "key", "k", "runs", "s0", "s1", "s2", "s3", "sketch"])

        return run

    rows = df.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    return map_columns(rows, make(), "id string, key binary, k long, runs int, s0 long, s1 long, s2 long, s3 long, sketch array<long>")


def banded_lcs(a: np.ndarray, b: np.ndarray, band: int) -> int:
    """Length of the longest common subsequence whose matched positions differ by at most ``band``.

    Bit-parallel: one bit per position of ``a``; each word of ``b`` updates all of them in a few big-integer steps.
    """
    if len(a) > len(b):
        a, b = b, a
    where: dict[int, int] = {}
    for i, w in enumerate(a.tolist()):
        where[w] = where.get(w, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    window = (1 << 2 * band + 1) - 1
    for j, w in enumerate(b.tolist()):
        m = where.get(w)
        if m:
            m &= (window << j - band) if j >= band else (window >> band - j)
            u = v & m
            v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


def proven_share(m: int, n: int, common: int, runs: int) -> float:
    """Least share of common runs of three words that two texts of ``m`` and ``n`` words can have if ``common`` words of both stand in the
    same order and the first has ``runs`` distinct runs.

    A word left out of the alignment touches three runs of its own text and parts two runs of the other.
    """
    lost, gained = 3 * (m - common) + 2 * (n - common), 3 * (n - common) + 2 * (m - common)
    return max(0, runs - lost) / (runs + gained) if runs else 0.0


def compare(a: list[str], b: list[str], threshold: float = 0.6, band: int = 64) -> tuple[float, float | None]:
    """(share of common runs of three words, alignment similarity) of two word lists. The share is the exact one, or, where the
    alignment proves that it reaches the threshold, the share that it proves. Without a chance to prove it, nothing is aligned."""
    shingles = lambda w: set(zip(*(w[i:] for i in range(SHINGLE))))
    sa = shingles(a)
    aligned = None
    if proven_share(len(a), len(b), min(len(a), len(b)), len(sa)) >= threshold:
        ids: dict[str, int] = {}
        x = np.array([ids.setdefault(w, len(ids)) for w in a])
        y = np.array([ids.setdefault(w, len(ids)) for w in b])
        common = banded_lcs(x, y, band + abs(len(a) - len(b)))
        aligned = 2 * common / (len(a) + len(b))
        if (least := proven_share(len(a), len(b), common, len(sa))) >= threshold:
            return least, aligned
    sb = shingles(b)
    both = len(sa & sb)
    union = len(sa) + len(sb) - both
    return (both / union if union else float(a == b)), aligned


_LINK = "a binary, b binary, similarity double, alignment double"


def _links(rows: list[tuple]) -> list[pa.Array]:
    types = (pa.binary(), pa.binary(), pa.float64(), pa.float64())
    return [pa.array(c, t) for c, t in zip(list(zip(*rows)) or [()] * 4, types)]


def _verify(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """(a, b, similarity, alignment) of the candidate pairs whose similarity reaches the threshold."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep = []
        for a, b, x, y in zip(*(batch.column(i).to_pylist() for i in range(4))):
            share, aligned = compare(WORD.findall(x.lower()), WORD.findall(y.lower()), threshold)
            if share >= threshold:
                keep.append((a, b, share, aligned))
        return pa.RecordBatch.from_arrays(_links(keep), names=["a", "b", "similarity", "alignment"])

    left = texts.select(F.col("key").alias("a"), F.col("text").alias("x"))
    right = texts.select(F.col("key").alias("b"), F.col("text").alias("y"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")
    return map_columns(joined, run, _LINK)


def near_duplicates(
    df: DataFrame,
    id_col: str = "id",
    text_col: str = "text",
    threshold: float = 0.6,
    min_words: int = 40,
    k: int = 5,
    picks: int = 2,
    sketches: int = 40,
    max_bucket: int = 256,
    every_link: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """``(members, links)``: members has one row per id, (id, key, group_id, n_links); links are (a, b, similarity, alignment)
    between keys, where a key stands for all ids with equal words, and n_links counts those of a key, whatever the size of
    a bucket. ``every_link=False`` is for groups only: links of buckets above ``max_bucket`` are then a set that
    spans the groups, and members have no n_links.

    Defined cases: null ids, null texts and texts under ``min_words`` words have no row; a repeated id counts once
    (with different texts, each text counts and the id is a member of each group); equal texts are in one group
    without links between them; an empty table gives empty results; other columns are ignored.
    """
    sketched = cut(sketch_texts(df, id_col, text_col, min_words, k, picks, sketches))
    members = cut(sketched.select("id", "key").distinct())
    seen = ["k", "runs", "s0", "s1", "s2", "s3"]
    reps = cut(sketched.groupBy("key").agg(F.min(F.struct("id", *seen, "sketch")).alias("r")).select("key", "r.*"))
    discard(sketched)
    # eight bytes of the key travel with a bucket: where two keys share them, both are compared
    rows = reps.select(F.explode("sketch").alias("bucket"), "k")

    def close(x: str, y: str):
        differ = sum((F.bit_count(F.col(f"{x}.s{j}").bitwiseXOR(F.col(f"{y}.s{j}"))) for j in range(4)), F.lit(0))
        # Unequal bits are expected at half of 1 - similarity; four and a half standard deviations are allowed for. Texts of few
        # runs fill few bins, and bins filled from others say nothing new: their spread is wider.
        share = (1 - threshold) / 2
        filled = 1 - F.exp(-F.least(f"{x}.runs", f"{y}.runs") / BINS)
        return differ <= SIGNATURE_BITS * share + 4.5 * (SIGNATURE_BITS * share * (1 - share)) ** 0.5 / F.sqrt(filled)

    # most buckets hold one text: counting them first (partial sums in the map stage) leaves few rows to compare
    shared = cut(rows.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1"))
    rows = cut(rows.join(shared, "bucket"))
    discard(shared)
    sides = cut(reps.drop("sketch"))
    discard(reps)
    has_big = bool(rows.filter(F.col("n") > max_bucket).take(1))
    small = (rows.filter(F.col("n") <= max_bucket) if has_big else rows).select("bucket", "k").join(sides.drop("id", "key"), "k")
    keys = sides.select("k", "key")
    pairs = (
        small.alias("x").join(small.alias("y"), (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.k") < F.col("y.k")) & close("x", "y"))
        .select(F.col("x.k").alias("x"), F.col("y.k").alias("y")).distinct()
        .join(keys.toDF("x", "p"), "x").join(keys.toDF("y", "q"), "y").select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).distinct()
    )
    source = df.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))

    def linked(pairs: DataFrame) -> DataFrame:
        pairs = cut(pairs)
        wanted = pairs.select(F.col("a").alias("key")).union(pairs.select(F.col("b").alias("key"))).distinct()
        texts = _texts(source, cut(sides.select("key", "id").join(wanted, "key", "left_semi")))
        return cut(_verify(pairs, texts, threshold))

    links = linked(pairs)
    if has_big:
        m = F.ceil(F.col("n") / max_bucket)
        part = lambda df: df.withColumn("i", F.pmod(F.xxhash64("key"), m))
        all_parts = lambda df: df.withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), m - 1)))
        sized = F.least("x.runs", "y.runs") >= F.lit(threshold) * F.greatest("x.runs", "y.runs") - F.lit(1e-9)
        met = (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.i") == F.col("y.i")) & (F.col("x.key") != F.col("y.key")) & sized & close("x", "y")
        pair = lambda x, y: x.alias("x").join(y.alias("y"), met).select(F.least("x.key", "y.key").alias("a"), F.greatest("x.key", "y.key").alias("b")).distinct()
        crowd = cut(rows.filter(F.col("n") > max_bucket).select("bucket", "n", "k").join(sides.drop("id"), "k"))
        rest = crowd
        if not every_link:
            lead = crowd.groupBy("bucket").agg(F.min(F.struct("key", "runs", "s0", "s1", "s2", "s3", "n")).alias("l")).select("bucket", "l.*")
            star = linked(pair(part(crowd), all_parts(lead)))
            links = cut(links.union(star).dropDuplicates(["a", "b"]))
            ends = star.select("a", "b").union(star.select(F.col("b").alias("a"), F.col("a").alias("b"))).toDF("key", "leader")
            led = crowd.join(bounded_broadcast(cut(lead.select("bucket", F.col("key").alias("leader")))), "bucket")
            rest = led.filter("key != leader").join(ends, ["key", "leader"], "left_anti")
        near = pair(all_parts(rest), part(crowd)).join(links.select("a", "b"), ["a", "b"], "left_anti")
        links = cut(links.union(linked(near)))
    groups = components(links.select("a", "b"))
    members = members.join(groups.withColumnRenamed("node", "key"), "key", "left").select("id", "key", F.coalesce("component", "key").alias("group_id"))
    if not every_link:
        return members, links
    degree = links.select(F.explode(F.array("a", "b")).alias("key")).groupBy("key").agg(F.count("*").alias("n_links"))
    return members.join(degree, "key", "left").select("id", "key", "group_id", F.coalesce("n_links", F.lit(0)).alias("n_links")), links


def _texts(source: DataFrame, reps: DataFrame) -> DataFrame:
    """(key, text), one row per key. An id that came with several texts is resolved by its own key again."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep = []
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if text is not None and xxhash.xxh3_128_digest(" ".join(WORD.findall(text.lower()))) == key:
                keep.append((key, text))
        if not keep:
            return None
        a, b = zip(*keep)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.string())], names=["key", "text"])

    joined = source.join(bounded_broadcast(reps), "id").select("key", "text")
    return cut(map_columns(joined, run, "key binary, text string").dropDuplicates(["key"]))


def group_pairs(members: DataFrame) -> DataFrame:
    """(id_a, id_b): all pairs of different ids of a group, id_a < id_b; the size of this result is that of its definition."""
    ids = members.select("id", "group_id").distinct()
    crowded = ids.groupBy("group_id").agg(F.count("*").alias("n")).filter(F.col("n") > 1).select("group_id")
    ids = ids.join(crowded, "group_id", "left_semi")
    return (
        ids.alias("x").join(ids.alias("y"), (F.col("x.group_id") == F.col("y.group_id")) & (F.col("x.id") < F.col("y.id")))
        .select(F.col("x.id").alias("id_a"), F.col("y.id").alias("id_b")).distinct()
    )
