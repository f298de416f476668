import random
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmill.llm import near_duplicates as N
from corpusmill.llm.common import WORD
from corpusmill.llm.graph import components

VOCABULARY = [f"w{i}" for i in range(4000)]


def brute_groups(rows, threshold, min_words):
    words = {i: WORD.findall(t.lower()) for i, t in rows if i is not None and t is not None}
    sets = {i: {tuple(w[j : j + 3]) for j in range(len(w) - 2)} for i, w in words.items() if len(w) >= min_words}
    group = {i: i for i in sets}

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both / (len(sets[a]) + len(sets[b]) - both) >= threshold:
            group[root(b)] = root(a)
    by = {}
    for i in sets:
        by.setdefault(root(i), []).append(i)
    return {p for g in by.values() for p in combinations(sorted(g), 2)}


def edited(rng, words, n):
    out = list(words)
    for _ in range(n):
        i = rng.randrange(len(out))
        kind = rng.random()
        if kind < 0.4:
            out[i] = rng.choice(VOCABULARY)
        elif kind < 0.7:
            out.insert(i, rng.choice(VOCABULARY))
        else:
            del out[i]
    return out


def corpus(seed):
    rng = random.Random(seed)
    rows = []
    for g in range(12):
        base = [rng.choice(VOCABULARY) for _ in range(rng.randrange(45, 200))]
        for k in range(rng.randrange(1, 6)):
            rows.append((f"d{g}-{k}", " ".join(edited(rng, base, rng.randrange(0, 8)))))
        half = len(base) // 2
        rows.append((f"d{g}-turned", " ".join(base[half:] + base[:half])))
    return rows


@pytest.mark.parametrize("max_bucket", [256, 2])
def test_groups_are_those_of_all_pairs(spark, max_bucket):
    rows = corpus(3) + [("short", "a b c"), (None, "x " * 50), ("nothing", None), ("empty", "")]
    rows += rows[:5]  # delivered twice
    df = spark.createDataFrame(rows, "id string, text string").withColumn("key", F.lit(1)).withColumn("bucket", F.lit("x"))
    members, links = N.near_duplicates(df, sketches=48, max_bucket=max_bucket)
    found = {tuple(r) for r in N.group_pairs(members).collect()}
    assert found == brute_groups(rows, 0.6, 40)
    assert links.filter("similarity < 0.6").count() == 0
    assert members.groupBy("id").count().filter("count > 1").count() == 0


def test_equal_texts_are_one_group_without_links(spark):
    text = " ".join(VOCABULARY[:60])
    df = spark.createDataFrame([(f"c{i}", text if i % 2 else text.upper() + " !") for i in range(40)], "id string, text string")
    members, links = N.near_duplicates(df)
    assert members.select("group_id").distinct().count() == 1 and members.count() == 40
    assert links.count() == 0 and N.group_pairs(members).count() == 40 * 39 // 2


def test_empty_table_and_very_long_text(spark):
    members, links = N.near_duplicates(spark.createDataFrame([], "id string, text string"))
    assert members.count() == links.count() == 0
    rng = random.Random(1)
    long = " ".join(rng.choice(VOCABULARY) for _ in range(60_000))
    df = spark.createDataFrame([("a", long), ("b", long + " end of it")], "id string, text string")
    assert N.group_pairs(N.near_duplicates(df)[0]).collect() == [("a", "b")]


def test_banded_alignment_is_the_longest_common_subsequence():
    rng = random.Random(5)
    for _ in range(200):
        a = [rng.randrange(6) for _ in range(rng.randrange(0, 30))]
        b = [rng.randrange(6) for _ in range(rng.randrange(0, 30))]
        for band in (0, 2, 40):
            x, y = (a, b) if len(a) <= len(b) else (b, a)
            table = np.zeros((len(x) + 1, len(y) + 1), int)
            for i in range(len(x)):
                for j in range(len(y)):
                    table[i + 1, j + 1] = max(table[i, j + 1], table[i + 1, j], table[i, j] + (x[i] == y[j] and abs(i - j) <= band))
            assert N.banded_lcs(np.array(a), np.array(b), band) == table[-1, -1]


def test_sketch_sees_order_and_occurrences():
    s = N.Sketcher(sketches=32)
    words = [f"t{i}" for i in range(120)]
    same = s.sketch(s.ids(words)) == s.sketch(s.ids(list(words)))
    turned = s.sketch(s.ids(words)) == s.sketch(s.ids(words[60:] + words[:60]))
    assert same.all() and 0 < turned.sum() < 32
    assert len(set(N._label_occurrences(N._kmers(s.ids(["a", "b"] * 10), 2)).tolist())) == 19


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(70)] + [(1000, 1000 + i) for i in range(1, 50)] + [(5, 5), (None, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a int, b int")).collect()}
    assert got == {**{i: 0 for i in range(71)}, **{1000 + i: 1000 for i in range(50)}}


def test_alignment_proves_no_more_than_the_exact_share():
    rng = random.Random(4)
    proven = 0
    for _ in range(300):
        a = [rng.choice("abcdefghijklmnop" * (1 + rng.randrange(3))) + str(rng.randrange(9)) for _ in range(rng.randrange(40, 120))]
        b = list(a)
        for _ in range(rng.randrange(12)):
            at = rng.randrange(len(b))
            b[at : at + rng.randrange(3)] = [f"new{rng.randrange(5)}"] * rng.randrange(3)
        runs = lambda w: set(zip(w, w[1:], w[2:]))
        exact = len(runs(a) & runs(b)) / len(runs(a) | runs(b))
        share, aligned = N.compare(a, b, 0.6)
        assert share <= exact + 1e-12 and (share >= 0.6) == (exact >= 0.6)
        proven += aligned is not None and share < exact
    assert proven > 30
    half = [f"w{k}" for k in range(100)]
    share, _ = N.compare(half, half[50:] + half[:50])  # parts that changed places: the exact share decides
    assert share == 96 / 100


def test_short_texts_are_compared_whatever_their_signatures(spark):
    rng = random.Random(5)
    rows = []
    for k in range(150):
        words = [f"{rng.choice('abcdefgh')}{rng.randrange(900)}" for _ in range(42)]
        other = words[:20] + [f"x{k}"] + words[21:]
        rows += [(f"a{k}", " ".join(words)), (f"b{k}", " ".join(other))]
    members, links = N.near_duplicates(spark.createDataFrame(rows, "id string, text string"), sketches=48)
    assert links.count() == 150 and brute_groups(rows, 0.6, 40) == {tuple(r) for r in N.group_pairs(members).collect()}
