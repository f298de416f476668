import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmill.llm import mixing as M
from corpusmill.llm import quality as Q
from corpusmill.llm import scans as S
from corpusmill.llm.boosting import BoostedTrees


def test_boosted_trees_learn_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, 5))
    y = (x[:, 0] * x[:, 1] > 0) & (x[:, 2] > -0.5)
    model = BoostedTrees(rounds=80).fit(x[:3000], y[:3000])
    assert ((model.predict(x[3000:]) > 0.5) == y[3000:]).mean() > 0.93


@pytest.mark.parametrize("line", ["3", "- 4 -", "[12]", "Strona 1 z 10", "Str0na 1 z 10", "p. 3", "Page 2 of 9", "str. 7", "— iv —"])
def test_page_numbers(line):
    assert S.is_page(line)


@pytest.mark.parametrize("line", ["2026.", "r.", "w roku 2020", "pokój 12", "10:15.", "Terminy – egzaminów 2020/2021", "12 osób wyjechało", "i", ""])
def test_no_page_numbers(line):
    assert not S.is_page(line)


def test_edits():
    assert S.edit("cornmittee", "committee") == ("rn", "m", 2)
    assert S.edit("opłafa", "opłata")[:2] == ("f", "t")
    assert S.edit("z@j@cia", "zajacia")[:2] == ("@", "a")
    assert S.edit("same", "same") is None and S.edit("abcdef", "xyzdzz") is None


def test_line_keys_and_page_number_ends():
    assert S.line_key("12  Regulamin studiów") == S.line_key("Regulamin studiów   13") == S.line_key("Regu1amin studiow") != S.line_key("Regulamin zajęć")
    assert S.line_key("rok 2024") != S.line_key("rok 2025") and S.line_key("x" * 100_000) == S.line_key(" " + "x" * 100_000)
    assert S.numbered("7  Uczelnia") and S.numbered("Uczelnia   7") and not S.numbered("Uczelnia 7") and not S.numbered("7")


def test_long_headers_and_long_words_are_looked_at(spark):
    head = "Uczelnia " + "NiezwykleDługaNazwaKomórkiOrganizacyjnejUczelni " * 7 + "– egzemplarz archiwalny"
    word = "a" + "bcdefghij" * 12
    assert len(head) > 300 and S.tokens("x " + word + " y") == [(word, word)]
    body = lambda k: f"Tekst numer {'abcdefghij'[k]} ma kilka zdań, które idą dalej w następnej\n{head}\n{k + 2}\nlinii tekstu i kończą się kropką.\nDrugie zdanie tego akapitu też jest pełne."
    chunks = spark.createDataFrame([(f"c{k}", "attachment:h", body(k % 10)) for k in range(30)], "id string, document_id string, text string")
    index = spark.createDataFrame([("h", "ok_ocr")], "content_sha256 string, extraction_status string")
    found = {(r.id, r.line_no, r.kind) for r in S.repair(chunks, index)[0].collect()}
    assert {(f"c{k}", 2, "header") for k in range(30)} | {(f"c{k}", 3, "page") for k in range(30)} <= found


def test_words_without_marks_are_ranked_by_both_counts():
    rng = random.Random(2)
    words = {"ręka": 700, "reka": 2, "łat": 8, "lat": 900}
    for k in range(600):
        stem = "".join(rng.choices("bdghkmprtuwy", k=4))
        words |= {f"{stem}ę": rng.choice([3, 30, 300, 900]), f"{stem}e": rng.choice([3, 30, 300, 900])}
    r = S.Ranker(words, {(b, a): 3.0 for a, b in zip(*S.MARKS)}, {})
    score = lambda form, word: float(r.score(np.array([S.features(form, word, S.shared_grams(form, word), words[word], 3.0, words[form])]))[0])
    assert score("reka", "ręka") > 0.5 > score("lat", "łat")


WORDS = "biblioteka komisja wniosek stypendium egzamin dziekanat regulamin harmonogram rekrutacja uczelnia semestr wykładowca laboratorium zarządzenie rektora studentów".split()


def scan_table(spark, rng, damaged=True):
    """Clean chunks, and scanned ones with known damage: (chunks, index, truth)."""
    def prose(n):
        return " ".join(" ".join(rng.choice(WORDS) for _ in range(8)).capitalize() + "." for _ in range(n))

    rows = [(f"clean{k}", f"web:{k}", prose(25)) for k in range(60)]
    truth = set()
    for k in range(40):
        lines, line = [], ""
        for w in prose(20).split():
            if len(line) + len(w) > 50:
                lines.append(line)
                line = ""
            line = f"{line} {w}".strip()
        lines.append(line)
        header = f"Zasady – konkursów {2000 + k}/{2001 + k}"
        out = []
        for n, text in enumerate(lines):
            if n and n % 9 == 0 and n < len(lines) - 2:
                out += [f"- {n // 9} -", header]
                truth |= {(f"scan{k}", len(out) - 1, "page", ""), (f"scan{k}", len(out), "header", "")}
            if damaged and n % 5 == 2:
                words = text.split()
                at = next((i for i, w in enumerate(words) if "a" in w[1:] and w.isalpha()), None)
                if at is not None:
                    right = words[at].lower()
                    j = words[at].index("a", 1)
                    words[at] = words[at][:j] + "@" + words[at][j + 1 :]
                    text = " ".join(words)
                    truth.add((f"scan{k}", len(out) + 1, "chars", right))
            out.append(text)
        rows.append((f"scan{k}", f"attachment:h{k}", "\n".join(out)))
    chunks = spark.createDataFrame(rows, "id string, document_id string, text string")
    index = spark.createDataFrame([(f"h{k}", "ok_ocr") for k in range(40)] + [("h1", "ok_ocr"), (None, "ok_ocr"), ("zz", None)], "content_sha256 string, extraction_status string")
    return chunks, index, truth


def test_scans_are_repaired(spark):
    chunks, index, truth = scan_table(spark, random.Random(3))
    extra = spark.createDataFrame([("nulltext", "attachment:h1", None), (None, "attachment:h1", "x"), ("blank", "attachment:h2", "")], chunks.schema)
    damage, texts = S.repair(chunks.union(chunks.limit(70)).union(extra).withColumn("kinds", F.lit(1)), index)
    got = {tuple(r) for r in damage.select("id", "line_no", "kind", "word").collect()}
    assert len(got & truth) >= 0.95 * len(truth) and len(got - truth) <= 0.05 * len(truth)
    fixed = {r.id: r.text for r in texts.collect()}
    assert len(fixed) == 41 and "@" not in "".join(fixed.values()) and "Zasady" not in "".join(fixed.values()) and fixed["blank"] == ""


def test_scans_without_rows(spark):
    chunks, index, _ = scan_table(spark, random.Random(3))
    for c, i in ((chunks.limit(0), index), (chunks, index.limit(0))):
        damage, texts = S.repair(c, i)
        assert damage.count() == texts.count() == 0


def test_hyphens_over_furniture(spark):
    text = "To jest zwykły tekst o sprawach, które kończy hyph-\n[3]\nenacja i dalej.\nKoniec."
    found, fixed = S.repair_texts([(text, ["text", "page", "text", "text"], {"hyphenacja": (4, None)})], S.JoinModel({}))[0]
    assert found == [(1, "hyphen", "hyphenacja"), (2, "page", "")]
    assert "hyphenacja i dalej" in fixed and "[3]" not in fixed


def test_token_counts_are_the_tokenizer_s():
    counter = M.TokenCounter(f"{M.tokenizer_dir()}/{M.VOCABULARY}")
    rng = random.Random(0)
    for text in ["", " ", "Zażółć gęślą jaźń 2024!", "a" * 300, "naïve  text\n\nwith\tblanks  ", "<|endoftext|> Київ"] + ["".join(chr(rng.randrange(32, 1200)) for _ in range(200)) for _ in range(20)]:
        assert counter.count(text) == counter.count(text) == len(counter.encode.encode_ordinary(text))


def test_mix_reaches_its_targets(spark):
    rng = random.Random(6)
    docs = [(i, rng.choice(["a", "a", "a", "b", "c"]), "word " * rng.randrange(1, 40)) for i in range(900)]
    docs += [docs[0], (9001, None, "x"), (9002, "a", None), (9003, "a", ""), (None, "a", "x")]
    targets = [(1, "a", 1.0, 1), (1, "b", 2.0, 4), (1, "c", 1.0, None), (1, "none", 5.0, None), (1, "b", 2.0, 4), (2, "a", 3.0, None), (2, "c", 1.0, 0), (2, "b", None, 2), (None, "a", 1.0, 1)]
    d = spark.createDataFrame(docs, "doc_id long, source string, text string").withColumn("tokens", F.lit("clash"))
    t = spark.createDataFrame(targets, "mix_id long, source string, target_weight double, max_repeats int")
    shares, positions = M.mix_sources(d, t)
    rows = {(r.mix_id, r.source): r for r in shares.collect()}
    for s, want in (("a", 0.25), ("b", 0.5), ("c", 0.25)):
        r = rows[1, s]
        assert r.wanted_share == pytest.approx(want) and r.actual_share == pytest.approx(want, abs=0.01)
        assert r.max_repeats is None or r.most_copies <= r.max_repeats
    assert not rows[1, "none"].usable and rows[1, "none"].actual_share == 0 and not rows[2, "c"].usable and not rows[2, "b"].usable
    assert rows[2, "a"].actual_share == 1
    got = [r for r in M.curriculum(positions).collect() if r.mix_id == 1]
    assert got == sorted(got, key=lambda r: (r.position, r.doc_id, r.copy)) or sorted(got, key=lambda r: r.position)[0].position == 0
    used = defaultdict(int)
    for r in got:
        used[r.source] += r.tokens
    assert all(used[s] == rows[1, s].tokens_used for s in "abc")
    # the share of a source moves from its natural one across its target, and averages to it
    total = sum(used.values())
    early = sum(r.tokens for r in got if r.source == "a" and r.position < total / 2) / (total / 2)
    late = sum(r.tokens for r in got if r.source == "a" and r.position >= total / 2) / (total / 2)
    assert early > 0.25 > late
    assert M.mix_sources(d.limit(0), t)[1].count() == 0 and M.mix_sources(d, t.limit(0))[0].count() == 0


PROSE = "The committee met on Monday and it was decided that the plan of the school will be changed for the next year. "
TEXTS = {
    "prose": [PROSE * 3, PROSE.upper() * 2, "1) " + PROSE + "\n2) " + PROSE, (PROSE * 4).replace(" the ", "\nthe "), PROSE * 6 + "\na;b;c\n1;2;3\n4;5;6"],
    "list": ["\n".join(f"- copy of form {k} (A{k})" for k in range(12)), "\n".join(f"Fees: terms\nOffice for Item {k}" for k in range(10)), PROSE + "\n" + "\n".join(f"* room {k}, floor B" for k in range(20)), " » ".join(f"Dates: exams {k}" for k in range(20))],
    "table": ["\n".join(f"{k};{k * 7};A{k};12.0{k}.2024;{k}%" for k in range(1, 9)), "\n".join(f"| {k} | name {k} | {k * 3},5 |" for k in range(12)), "\n".join(f"{k}        item {k}        {k * 9}" for k in range(12)), "\n".join(f"{k},{k + 1},abc,{k * 2}" for k in range(12))],
    "junk": ["", " \n ", "Zm9vYmFyYmF6cXV4" * 30, "var x = function(a,b){return a[0]||b.c(1);};\n" * 10, "#$%^ &*() " * 30, "again " * 60, "Ã³Å‚Ä… " * 40, "xqzrt wvkpl bnmgh qwrtp zzxcv lkjhg " * 6],
}


def test_text_types(spark):
    rng = random.Random(0)
    rows = []
    for kind, texts in TEXTS.items():
        for k in range(60 if kind == "prose" else 12):
            rows.append((len(rows), texts[k % len(texts)], kind))
    rng.shuffle(rows)
    rows += [rows[0]]
    df = spark.createDataFrame([(i, t, k) for i, t, k in rows] + [(10_000, None, "junk"), (None, "x", "")], "doc_id long, text string, form string")
    common = spark.createDataFrame([("en", w) for w in "the and it was that of will be for on a in is to".split()], "lang string, word string")
    out = {r.doc_id: r.form for r in Q.text_types(df, common).collect()}
    assert len(out) == len(rows)  # one row came twice, one text is null, one id is null
    wrong = [(k, out[i], t[:40]) for i, t, k in rows if out[i] != k]
    assert not wrong and out[10_000] == "junk"
    assert Q.text_types(df.limit(0), common).count() == 0


def test_accuracies_are_learned_from_agreements():
    rng = np.random.default_rng(1)
    own = np.array([[kind == t for t in Q.TYPES] for kind, _ in Q.VOTES])
    fires = np.where(own, rng.uniform(0.5, 0.95, own.shape), rng.uniform(0.0, 0.05, own.shape))
    true = rng.choice(4, 20_000, p=[0.8, 0.1, 0.06, 0.04])
    votes = rng.random((20_000, len(Q.VOTES))) < fires[:, true].T
    patterns, inverse, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    mix, learned = Q.learn_accuracies(patterns.astype(float), counts.astype(float), prior=0.001)
    assert np.abs(learned - fires).max() < 0.12 and np.abs(mix - [0.8, 0.1, 0.06, 0.04]).max() < 0.02
    best = Q.posterior(patterns.astype(float), mix, learned).argmax(1)[inverse.ravel()]
    assert (best == true).mean() > 0.97


def test_statistics_of_a_known_text():
    s = Q.statistics("The cat sat. 12 %\nOn the mat.", Q.TokenTraits(frozenset({"the", "on"})))
    assert s["word_count"] == 8 and s["line_end_ratio"] == 0.5 and s["common_ratio"] == pytest.approx(3 / 6)
    assert math.isclose(s["mean_word_length"], 23 / 8) or s["mean_word_length"] > 2


LONG = ["a" * 400_000, " " * 400_000 + "x", "-" * 300_000, "word " * 100_000, "\n" * 200_000, "A1b2" * 100_000, "x. " * 100_000, "\"quoted " * 50_000, "9 " * 100_000]


@pytest.mark.parametrize("text", LONG, ids=range(len(LONG)))
def test_very_long_texts_take_little_time(text):
    import time

    from corpusmill.llm import languages as L
    from corpusmill.llm import leakage as K
    from corpusmill.llm import splitting as P

    began = time.process_time()
    Q.statistics(text, Q.TokenTraits(frozenset({"a"})))
    lines = text.split("\n")
    S.line_features(lines, {})
    kinds = ["text" if x.strip() else "blank" for x in lines]
    S.repair_texts([(text, kinds, {})], S.JoinModel({}))
    for x in lines:
        S.tokens(x)
    model = L.LanguageModels(["a", "b"], [L.KneserNey(L.Counter({"aba": 2})), L.KneserNey(L.Counter({"cdc": 2}))], np.array([9.0, 9.0]), 1.0)
    model.learn({w.lower() for w in L.LETTERS.findall(text)})
    L.passages(text, model)
    P.split_text(text, 350, 50, frozenset(P.STRENGTH))
    K.words_of(text)
    M.TokenCounter(f"{M.tokenizer_dir()}/{M.VOCABULARY}").count(text)
    assert time.process_time() - began < 20


def test_a_tiny_source_is_repeated_thousands_of_times(spark):
    docs = spark.createDataFrame([(1, "tiny", "word")] + [(i, "large", "some words of a larger source " * 40) for i in range(2, 42)], "doc_id long, source string, text string")
    targets = spark.createDataFrame([(1, "tiny", 0.5, None), (1, "large", 0.5, 1)], "mix_id long, source string, target_weight double, max_repeats int")
    shares, positions = M.mix_sources(docs, targets)
    rows = {r.source: r for r in shares.collect()}
    own = positions.filter("source = 'tiny'")
    assert rows["tiny"].most_copies > 3 * M.COPIES and own.count() == own.select("copy").distinct().count() == rows["tiny"].most_copies
    assert rows["tiny"].actual_share == pytest.approx(0.5, abs=0.001) and own.agg(F.max("copy")).first()[0] == rows["tiny"].most_copies


def test_token_traits_are_forgotten_and_worked_out_again():
    traits = Q.TokenTraits(frozenset({"the"}))
    first = Q.statistics("The cat sat on the mat, 12 times.", traits)
    traits.MOST = 1
    assert Q.statistics("Other words here", traits)["common_ratio"] == 0 and len(traits.known) == 3
    assert Q.statistics("The cat sat on the mat, 12 times.", traits) == first and first["common_ratio"] == 2 / 7
    assert Q.longest_run(np.array([2, 2, 0, 2])) == 4 and Q.statistics("de ad be ef " * 8, traits)["blob_ratio"] > 0.5
