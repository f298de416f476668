import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusmill.llm import leakage as L
from corpusmill.llm import splitting as S

ALL = frozenset(S.STRENGTH)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["word", "end.", "Start", "\n", "\n\n", "- ", "Title:\n", "x" * 40]), max_size=300), st.integers(2, 40), st.integers(0, 30))
def test_pieces_cover_the_text_within_the_limit(parts, limit, overlap):
    if overlap >= limit:
        return
    text = " ".join(parts)
    words = S.TOKEN.findall(text)
    pieces = S.split_text(text, limit, overlap, ALL)
    if not words:
        assert pieces == []
        return
    assert pieces[0][0] == 0 and pieces[-1][1] == len(words)
    for a, b, _, piece in pieces:
        assert 0 < b - a <= limit
        assert S.TOKEN.findall(piece) == words[a:b]
    for x, y in zip(pieces, pieces[1:]):
        assert x[1] - y[0] == overlap


def test_cuts_stand_at_boundaries_and_pieces_are_balanced():
    sentence = "One two three four five six seven eight nine ten. "
    text = "\n\n".join([sentence * 6] * 10)
    pieces = S.split_text(text, 350, 50, ALL)
    assert [k for *_, k, _ in pieces[:-1]] == ["paragraph"] * (len(pieces) - 1)
    plain = S.split_text("w " * 1000, 350, 50, ALL)
    sizes = [b - a for a, b, _, _ in plain]
    assert len(plain) == 4 and max(sizes) - min(sizes) <= 2


def test_split_rows(spark):
    rows = [("a", "w " * 30, 1), ("a", "w " * 30, 1), ("b", None, 2), ("c", "", 3), (None, "w " * 30, 4), ("d", "x " * 20_000, 5)]
    df = spark.createDataFrame(rows, "id string, text string, piece_no int")
    out = S.split_oversized(df, 10, 2)
    got = {r.id: r.n for r in out.groupBy("id").count().withColumnRenamed("count", "n").collect()}
    assert set(got) == {"a", "d", None} and got["a"] == 4
    assert out.filter("word_count > 10").count() == 0
    assert S.split_oversized(df.limit(0), 10, 2).count() == 0
    assert S.split_oversized(df, 50, 2, keep_fitting=True).filter("id = 'a'").count() == 1
    with pytest.raises(ValueError):
        S.split_oversized(df, 10, 10)


def brute(docs, items, least):
    own = {}
    for i, t in items:
        w = [L.fold(x) for x in L.words_of(t)]
        for j in range(len(w) - least + 1):
            own.setdefault(tuple(w[j : j + least]), set()).add(i)
    out = set()
    for d, t in docs:
        w = [L.fold(x) for x in L.words_of(t)]
        for j in range(len(w) - least + 1):
            out |= {(d, i) for i in own.get(tuple(w[j : j + least]), ())}
    return out


def test_automaton_finds_what_brute_force_finds():
    rng = random.Random(2)
    for _ in range(60):
        items = [(i, " ".join(rng.choice("abc") for _ in range(rng.randrange(1, 25)))) for i in range(6)]
        docs = [(d, " ".join(rng.choice("abcd") for _ in range(60))) for d in range(4)]
        docs.append((9, "x " + items[0][1] + " y " + items[1][1]))
        hashes, sam = L.WordHashes(), L.SuffixAutomaton()
        for i, t in items:
            sam.add(i, hashes.of(L.words_of(t)))
        sam.finish(5)
        got = set()
        for d, t in docs:
            w = hashes.of(L.words_of(t))
            for item, runs in sam.spans(w, 5).items():
                for a, b in runs:
                    part = [L.fold(x) for x in L.words_of(t)][a:b]
                    whole = [L.fold(x) for x in L.words_of(dict(items)[item])]
                    assert any(whole[k : k + len(part)] == part for k in range(len(whole))) and b - a >= 5
                    got.add((d, item))
        assert got == brute(docs, items, 5)


def test_leaks_whatever_case_marks_and_punctuation(spark):
    item = "Zażółć gęślą jaźń, a potem policz do 12 — i jeszcze raz od nowa Łódź płynie dalej rzeką."
    docs = [(1, "Wstęp. " + item.upper() + " Koniec"), (2, "zazolc gesla jazn a potem policz do 12 i jeszcze raz od nowa lodz"), (3, "zażółć gęślą jaźń i nic"), (4, None), (None, item), (5, ""), (1, "Wstęp. " + item.upper() + " Koniec")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    t = spark.createDataFrame([(7, item), (8, "za krótki tekst"), (9, None)], "item_id long, text string")
    spans = L.leaked_spans(d, t)
    assert {(r.doc_id, r.item_id) for r in spans.collect()} == {(1, 7), (2, 7)}
    blocks = L.leaked_spans(d, t.union(spark.createDataFrame([(20, item)], "item_id long, text string")), slice_words=20)
    assert {(r.doc_id, r.item_id) for r in blocks.collect()} == {(1, 7), (2, 7), (1, 20), (2, 20)}
    clean = {r.doc_id: r.text for r in L.without_spans(d, spans).collect()}
    assert "POLICZ" not in clean[1] and clean[1].startswith("Wstęp.") and clean[1].endswith("Koniec")
    assert L.leaked_spans(d.limit(0), t).count() == 0 and L.leaked_spans(d, t.limit(0)).count() == 0


def test_items_in_slices_and_small_automata_lose_no_span(spark, monkeypatch):
    rng = random.Random(8)
    words = [f"w{k}" for k in range(40)]
    items = [(i, " ".join(rng.choices(words, k=rng.randrange(12, 40)))) for i in range(60)]
    docs = []
    for n in range(80):
        own = rng.choice(items)[1].split()
        a = rng.randrange(len(own) - 11)
        docs.append((n, " ".join([*rng.choices(words, k=rng.randrange(30)), *own[a : a + rng.randrange(9, 16)], *rng.choices(words, k=9)])))
    d, t = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    whole = {tuple(r) for r in L.leaked_spans(d, t).collect()}
    assert {r[:2] for r in whole} == brute(docs, items, 12)
    assert {tuple(r) for r in L.leaked_spans(d, t, slice_words=300).collect()} == whole
    ids, lists = zip(*[(i, L.WordHashes().of(x.split())) for i, x in items])
    known = L.Items(np.array(ids), np.cumsum([0, *map(len, lists)]), np.array([w for x in lists for w in x], np.uint64), 12)
    monkeypatch.setattr(L, "BLOCK_WORDS", 100)
    blocks = list(known.automata(set(range(60))))
    assert len(blocks) > 9 and frozenset().union(*(own for own, _ in blocks)) == set(range(60))
    assert all(sum(len(lists[k]) for k in own) <= 100 for own, _ in blocks)
    assert list(known.automata({3}))[0][0] == {3}
