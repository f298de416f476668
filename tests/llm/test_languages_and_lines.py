import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from corpusmill.llm import languages as L
from corpusmill.llm import repeated_lines as R

COMMON = {
    "pl": {"i", "w", "na", "z", "do", "nie", "się", "jest", "oraz", "przez"},
    "en": {"the", "of", "and", "to", "in", "is", "that", "with", "for", "was"},
    "de": {"der", "die", "und", "das", "ist", "nicht", "mit", "von", "den", "auf"},
}
NOUNS = {
    "pl": "uczelnia student rektor biblioteka egzamin wniosek stypendium wykład szkoła dziekan książka zajęcia wydział komisja".split(),
    "en": "university student library lecture scholarship application committee school building teacher weather reading office deadline".split(),
    "de": "Hochschule Bibliothek Vorlesung Antrag Stipendium Prüfung Lehrstuhl Gebäude Wetter Zeitung Schüler Sprechstunde Rechnung Straße".split(),
}


def sentence(rng, lang):
    words = [rng.choice(sorted(COMMON[lang])) if k % 2 else rng.choice(NOUNS[lang]) for k in range(12)]
    return " ".join(words).capitalize() + "."


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(4)
    return [(lang, " ".join(sentence(rng, lang) for _ in range(6))) for lang in COMMON for _ in range(60)]


def test_held_out_accuracy_and_mixed_texts(texts):
    models = L.train([t for _, t in texts], COMMON)
    rng = random.Random(9)
    right = 0
    for lang in COMMON:
        for _ in range(40):
            text = " ".join(sentence(rng, lang) for _ in range(2))
            models.learn({w.lower() for w in L.LETTERS.findall(text)})
            found = L.passages(text, models)
            right += len(found) == 1 and found[0][2] == lang and found[0][3] > 0.8
    assert right >= 118
    mixed = " ".join(sentence(rng, "pl") for _ in range(4)) + "\n" + " ".join(sentence(rng, "de") for _ in range(4))
    models.learn({w.lower() for w in L.LETTERS.findall(mixed)})
    found = L.passages(mixed, models)
    assert [p[2] for p in found] == ["pl", "de"] and abs(found[0][1] - mixed.index("\n")) <= 1
    assert L.passages("", models) == [] and L.passages("12 34 56", models)[0][2] == "und"


def test_kneser_ney_sums_to_one():
    model = L.KneserNey(Counter({"aba": 3, "abb": 2, "bab": 1, "caba": 1}))
    for stem in ("", "a", "ab", "caba", "zz"):
        total = 0.0
        for c in [chr(k) for k in range(33, 33 + 255) if chr(k) != " "] + [" "]:
            word = stem + c if c != " " else stem
            whole = model.cost([word])[0] if c == " " else None
            if c == " ":
                total += np.exp(-(whole - _prefix(model, stem)))
            else:
                total += np.exp(-(_prefix(model, word) - _prefix(model, stem)))
        assert total == pytest.approx(1.0, abs=0.02)


def _prefix(model, stem):
    """Nats of the characters of a word's beginning, without the end of the word."""
    if not stem:
        return 0.0
    codes, place, _ = L._codes([stem])
    grams = L._grams(codes, model.order)
    p = np.full(len(codes), 1 / L.ALPHABET)
    for n, (keys, alpha, contexts, back) in enumerate(model.tables, 1):
        a = model._look(keys, alpha, grams[n - 1], 0.0)
        b = np.full(len(codes), back[0]) if n == 1 else model._look(contexts, back, np.concatenate([[np.uint64(0)], grams[n - 2][:-1]]), 1.0)
        p = np.where(place >= n - 1, a + b * p, p)
    return float(-np.log(p[1:-1]).sum())


@pytest.mark.parametrize(
    ("label", "langs"),
    [("pl_PL", {"pl"}), ("en-GB", {"en"}), ("PL", {"pl"}), ("en-pl", {"en", "pl"}), ("uk-UA", {"uk"}), ("en-uk", {"en", "uk"}), ("cs", {"cs"}), ("", None), (None, None), ("und", None), ("Unknown", None)],
)
def test_labels(label, langs):
    assert L.label_languages(label, {"pl", "en", "de", "uk"}) == (None if langs is None else frozenset(langs))


def test_identify_rows(spark, texts):
    rows = [(f"c{i}", t, lang if i % 3 else "xx") for i, (lang, t) in enumerate(texts)]
    rows += [rows[0], ("null", None, "pl"), (None, texts[0][1], "pl"), ("empty", "", None), ("short", "jest w domu", None)]
    df = spark.createDataFrame(rows, "id string, text string, language string")
    words = spark.createDataFrame([(k, w) for k, v in COMMON.items() for w in v], "lang string, word string")
    out = {r.id: r for r in L.identify(df, words).collect()}
    assert len(out) == len(texts) + 3
    for i, (lang, _) in enumerate(texts):
        r = out[f"c{i}"]
        assert list(r.langs) == [lang] and r.label_state == ("right" if i % 3 else "wrong")
    assert out["null"].langs == [] and out["empty"].label_state == "missing" and out["short"].langs == []
    assert L.identify(df.limit(0), words).count() == 0


def brute_lines(rows, min_docs=5, share=0.04):
    docs, where, lines = defaultdict(set), defaultdict(set), []
    for i, text, d, s in set(rows):
        if d is not None:
            docs[s].add(d)
        if None in (i, text, d):
            continue
        for n, line in enumerate(text.split("\n"), 1):
            key = " ".join("".join(c if c.isalpha() else " " for c in line.lower()).split())
            if len(key.replace(" ", "")) >= 10:
                where[s, key].add(d)
                lines.append((i, n, s, key))
    return {(i, n) for i, n, s, k in lines if len(where[s, k]) >= min_docs and len(where[s, k]) >= share * len(docs[s]) - 1e-9}


def test_repeated_lines_are_those_of_brute_force(spark):
    rng = random.Random(1)
    notices = ["Copyright 20{} All rights reserved", "Share this page | print", "Ostatnia aktualizacja: {}.02.2024", "Menu główne serwisu nr {}", "kurz {}"]
    rows = []
    for k in range(160):
        s = "big" if k % 3 else f"s{k % 4}"
        body = [f"Unique sentence number {rng.random()} about {rng.choice('abcdef')} things" for _ in range(3)]
        body += [rng.choice(notices).format(rng.randrange(99)) for _ in range(rng.randrange(3))] + [""]
        rng.shuffle(body)
        rows.append((f"c{k}", "\n".join(body), f"d{k // 2}", None if k % 11 == 0 else s))
    rows += rows[:7] + [("x", None, "dx", "big"), (None, "Share this page | print", "dy", "big"), ("z", "Share this page | print", None, "big"), ("e", "", "de", "big")]
    df = spark.createDataFrame(rows, "id string, text string, document_id string, source_id string")
    covered, found, templates = R.repeated_lines(df)
    got = {(r.id, r.line_no) for r in found.collect()}
    assert got == brute_lines(rows) and got
    assert templates.filter("docs < need or template_docs < docs").count() == 0
    clean = {r.id: r.text for r in R.without_lines(df, found).collect()}
    for i, text, *_ in rows:
        if i is not None and text is not None:
            assert clean[i] == "\n".join(x for n, x in enumerate(text.split("\n"), 1) if (i, n) not in got)
    assert got <= {(r.id, r.line_no) for r in covered.collect()}
    assert [x.count() for x in R.repeated_lines(df.limit(0))] == [0, 0, 0]


def test_leaf_gives_slots_and_keeps_enough_constants():
    leaf = R.Leaf(0.6, 10)
    a = leaf.insert("written by anna nowak today".split())
    b = leaf.insert("written by jan nowak today".split())
    c = leaf.insert("written by ewa lis today".split())
    d = leaf.insert("written by ewa lis tonight".split())
    assert a == b == c and leaf.templates[a] == ["written", "by", R.SLOT, R.SLOT, "today"] and d != a
    short = R.Leaf(0.5, 10)
    assert short.insert(["read", "more", "news"]) != short.insert(["read", "more", "jobs"])  # eight letters would stay


def test_parts_of_a_leaf_are_merged(spark):
    names = [f"name{chr(97 + i)}{chr(97 + j)}" for i in range(9) for j in range(9)]
    forms = spark.createDataFrame([(1, f"written by {n} for all our readers", 1) for n in names] + [(2, "another line of its own", 3)], "leaf long, form string, docs long")
    whole = {tuple(r) for r in R.grow_trees(forms, 0.6, 10).collect()}
    assert whole == {tuple(r) for r in R.grow_trees(forms, 0.6, 10, part_forms=7).collect()}
    assert {t for _, _, t in whole} == {f"written by {R.SLOT} for all our readers", "another line of its own"}
