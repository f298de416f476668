import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusmill.functions import hashing as X
from corpusmill.functions import text as T
from corpusmill.functions import url as U
from corpusmill.operators import segments as S


def values(spark, rows, fn, kind="string"):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, v {kind}")
    return [r.o for r in df.select("i", fn(F.col("v")).alias("o")).orderBy("i").collect()]


def test_normalize_text(spark):
    got = values(spark, [" a  b \r\n\r\n\r\n\r\nc\x00d\x07e\t\tf ", None, "", "\n\n x \n\n"], T.normalize_text)
    assert got == ["a  b\n\ncd e f", None, "", "x"]
    assert values(spark, ["a\x00b\tc"], T.normalize_extracted) == ["a b c"]
    assert values(spark, ["a b\x0bc d"], T.normalize_page) == ["a b\nc\nd"]


def test_normalize_text_is_idempotent(spark):
    import random

    rng = random.Random(1)
    rows = ["".join(rng.choice("ab \t\n\r\x00\x07   ") for _ in range(rng.randrange(30))) for _ in range(400)]
    once = values(spark, rows, T.normalize_text)
    assert values(spark, once, T.normalize_text) == once
    for t in once:
        assert "\n\n\n" not in t and not re.search(r"[ \t]\n|\n[ \t]", t) and t == t.strip(" \n\t")


def test_counts_and_titles(spark):
    assert values(spark, ["a b c\n d", "", None], T.word_count) == [4, 0, None]
    assert values(spark, ["well-known o'clock -- x_1", "'a'"], T.token_count) == [3, 1]
    assert values(spark, ["__Ala_ma - kota –", "  ", None, "a\nb"], T.clean_title) == ["Ala ma - kota", "Bez tytułu", "Bez tytułu", "a b"]
    assert values(spark, ["a/b\\c\x01. ", "..x"], T.safe_filename) == ["a_b_c_", "x"]
    assert values(spark, ["moj_plik--2.tar.gz", ".hidden", "x"], T.stem_title) == ["moj plik 2.tar", ".hidden", "x"]
    assert values(spark, ["A\n\nb\n\nA\n\n \n\nc"], lambda c: T.merge_blocks(c, c)) == ["A\n\nb\n\nc"]


def test_detect_language(spark):
    rows = ["To jest tekst, który nie jest krótki", "This is the text of it", "xyz 123", "to jest the of and się", None, ""]
    assert values(spark, rows, T.detect_language) == ["pl", "en", None, "pl-en", None, None]


def test_headings(spark):
    rows = ["1 Wstęp do tematu", "1. Wstęp", "- pozycja", "Warunki przyjęcia:", "To jest zdanie.", "WAŻNE INFORMACJE DLA WSZYSTKICH KTÓRZY CZYTAJĄ TEN TEKST DO KOŃCA", "Krótki tytuł", "mały początek", "", None]
    want = [True, False, False, True, False, True, True, False, False, False]
    assert values(spark, rows, T.looks_like_heading) == want
    assert [S.heading(r or "") for r in rows] == want


def test_sentences(spark):
    rows = ["Zob. art. 5 ust. 2. Potem nr. 7 i koniec! Tak? (Nie)", "Kolor. Teraz dalej. Mgr. Nowak", "jedno", "", None]
    got = values(spark, rows, T.split_sentences)
    assert got[0] == ["Zob. art. 5 ust. 2.", "Potem nr. 7 i koniec!", "Tak?", "(Nie)"]
    assert got[1] == ["Kolor. Teraz dalej.", "Mgr. Nowak"] and got[2] == ["jedno"] and got[3] == [] and got[4] is None
    assert [S.sentences(r) for r in rows[:4]] == got[:4]


def test_ngram_ratio(spark):
    rows = ["a b c d e " * 10, " ".join(map(str, range(60))), "short text", ""]
    got = values(spark, rows, T.unique_ngram_ratio)
    assert abs(got[0] - 5 / 46) < 1e-12 and got[1:] == [1.0, 1.0, 1.0]
    assert values(spark, ["a b c"], lambda c: F.size(T.ngrams(c, 4))) == [0]


def test_urls(spark):
    rows = ["HTTPS://Ex.org:80//a//b%20c?utm_source=1&A=&x=%20y&GCLID=3&utm_id=2#f", "http://ex.org", "//h/p", "http://żółw.pl/ą b.PDF", None]
    assert values(spark, rows, U.normalize_url) == ["https://ex.org:80/a/b%20c?A=&x=+y&utm_id=2", "http://ex.org/", "//h/p", "http://żółw.pl/ą b.PDF", None]
    assert values(spark, rows[:1], lambda c: U.normalize_url(c, any_utm=True, decode_path=True)) == ["https://ex.org:80/a/b c?A=&x=+y"]
    assert values(spark, ["http://h/a+b%2Fc.Pdf?x=1"], U.extension) == ["pdf"]
    assert values(spark, rows, U.is_document) == [False, False, False, True, False]
    for base, href, want in [("http://h/a/b?q#f", "c", "http://h/a/c"), ("http://h", "c", "http://h/c"), ("http://h/a", "?x", "http://h/a?x"), ("http://h/a/", "//o/p", "http://o/p"), ("http://h/a", "mailto:x", "mailto:x"), ("http://h/a#b", "#c", "http://h/a#c")]:
        assert values(spark, [base], lambda c, href=href: U.resolve(c, F.lit(href))) == [want]
    kinds = values(spark, ["http://a.pl/x.pdf", "http://a.pl/x", "http://sub.uni.pl/", "http://uni.pl.evil.com/"], lambda c: U.link_kind(c, F.lit("a.pl"), ["uni.pl"]))
    assert kinds == ["attachment", "internal", "institutional", "external"]


def test_media(spark):
    assert values(spark, [b"%PDF-1.7", b"PK\x03\x04x", b"<html>", None], lambda c: U.magic_matches(c, F.lit("pdf")), "binary") == [True, False, False, None]
    assert values(spark, ["bytes 0-0/123", "bytes */*", None], lambda c: U.total_size(c, F.lit("7"), F.lit(206))) == [123, None, None]
    assert values(spark, [None], lambda c: U.total_size(c, F.lit("7"), F.lit(200))) == [7]


def test_hashes(spark):
    import hashlib
    import json

    assert values(spark, ["x"], lambda c: X.fields_hash(c, F.lit(None), F.lit("z"))) == [hashlib.sha256(b"x\n\nz").hexdigest()]
    want = hashlib.sha256(json.dumps({"a": None, "b": "x"}, separators=(",", ":")).encode()).hexdigest()
    assert values(spark, ["x"], lambda c: X.json_hash(b=c, a=F.lit(None).cast("string"))) == [want]
    assert values(spark, [None], lambda c: X.duplicate_key(c, F.lit(3), F.lit("x"))) == [None]


def test_repeats():
    words = [f"w{i}" for i in range(9)]
    assert S.without_repeats(words * 4 + ["end"] * 2) == [*words, "end", "end"]
    assert S.without_repeats(words * 2 + ["end"] * 20) == [*words * 2, *["end"] * 5]
    assert S.without_repeats(words * 2 + [f"e{i}" for i in range(20)]) == words * 2 + [f"e{i}" for i in range(20)]
    assert S.without_repeats("a b c d e f".split() + "x y".split() * 5 + "g h i j".split()) == "a b c d e f x y g h i j".split()
    assert S.without_repeats(["z"] * 16) == ["z"] * 4 and S.without_repeats(["z"] * 15) == ["z"] * 15 and S.without_repeats([]) == []


def plain_runs(words, longest=24, least=4):
    """From the left, the longest block that stands four times or more, by trying all."""
    out = []
    while words:
        size = next((k for k in range(longest, 1, -1) if len(words) >= least * k and words[: least * k] == words[:k] * least), 0)
        out += words[:size] if size else words[:1]
        if not size:
            words = words[1:]
        else:
            block = words[:size]
            while words[:size] == block:
                words = words[size:]
    return out


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.lists(st.sampled_from("abc"), min_size=1, max_size=7), st.integers(1, 7)), min_size=8, max_size=20))
def test_runs_equal_those_found_by_trying_all(parts):
    words = ["!"] + [w for block, times in parts for w in block * times] + list("defgh") * 3
    assert S.without_repeats(words) == plain_runs(words)


@settings(max_examples=120, deadline=None)
@given(st.lists(st.sampled_from(["Tytuł", "- pozycja listy", "Zdanie pierwsze jest krótkie.", "słowo " * 40, "\n\n", "koniec.", "słowo " * 900]), max_size=40), st.integers(50, 400))
def test_segments_keep_limits(parts, target):
    found = S.segments("\n".join(parts), target)
    hard = max(650, 2 * target)
    assert [s["chunk_index"] for s in found] == list(range(len(found)))
    for s in found:
        assert 5 <= s["word_count"] <= hard and s["word_count"] == len(s["text"].split())


def test_units_and_chunks(spark):
    text = "Wstęp\n- jeden\nciąg dalszy\n- dwa.\nTekst akapitu.\n- trzy\nRozdział\ndalej"
    kinds = [(u.kind, u.text) for u in S.units_of_text(text)]
    assert kinds == [("heading", "Wstęp"), ("list", "- jeden ciąg dalszy\n- dwa."), ("paragraph", "Tekst akapitu."), ("list", "- trzy"), ("heading", "Rozdział"), ("paragraph", "dalej")]
    many = " ".join(f"słowo{i}" for i in range(200))
    assert [u.kind for u in S.units_of_text(many)] == ["paragraph"]
    assert [u.kind for u in S.units_of_text(f"Jeden. Dwa. Trzy {many}")] == ["sentence_group"] * 3
    df = spark.createDataFrame([("d", "T", "słowo " * 1500), ("d", "T", "słowo " * 1500), ("e", None, None), ("f", "F", ""), (None, "x", "y " * 9)], "id string, title string, text string")
    assert [(r.document_id, r.word_count) for r in S.chunk_documents(df, "id", "text", "title").collect()] == [("d", 8 + 1500 % 8)]
    df = spark.createDataFrame([("d", "T", " ".join(f"słowo{i}" for i in range(1500))), ("d", "T", " ".join(f"słowo{i}" for i in range(1500))), ("e", None, None)], "id string, title string, text string")
    out = S.chunk_documents(df, "id", "text", "title", keep=("id",)).orderBy("chunk_index").collect()
    assert [r.word_count for r in out] == [700, 700, 100] and {r.chunk_count for r in out} == {3} and all(r.forced_split for r in out)
    assert out[0].id == "d:chunk:0001" and out[0].embedding_text.startswith("T\n\nsłowo") and {r.document_id for r in out} == {"d"}
    assert S.chunk_documents(df.limit(0), "id", "text").count() == 0


def test_sections_give_pages_labels_and_context(spark):
    page = lambda n, label, kind, text: {"section_id": f"s{n}", "label": label, "kind": kind, "page_number": n, "text": text}
    found = S.segments("unused", 60, sections=[page(1, "Strona 1", "page", "Tytuł\n\n" + " ".join(f"a{i}" for i in range(50))), page(2, "Zasady", "page", "WSTĘP OGÓLNY\n\njeden dwa trzy cztery pięć."), {"text": None}, None])
    assert len(found) == 1  # the second would be too short
    one = found[0]
    assert (one["page_start"], one["page_end"], one["section_kind"], one["slide_start"]) == (1, 2, "page", None)
    assert one["context_path"] == ["Tytuł", "Zasady", "WSTĘP OGÓLNY"] and one["section_labels"] == ["Strona 1", "Zasady"] and one["unit_kinds"] == ["heading", "paragraph"]
    assert S.segments("Sam tekst ma tu pięć słów.", 60, sections=[])[0]["section_ids"] == []


def test_chunks_equal_their_sql_on_made_texts(spark):
    import random

    import duckdb
    import pandas as pd

    from corpusmill.plans import catalog
    from corpusmill.plans import segment_queries as Q

    from .oracle import table

    catalog.queries()
    rng = random.Random(3)
    words = "ala ma kota Dom Rok 2024 Art. np. koniec. Start: A) b. - * 1. IV. WSTĘP CEL; tak, dużo. Pytanie? słowo".split()

    def line():
        some = lambda a, b, of=words: " ".join(rng.choices(of, k=rng.randint(a, b)))
        k = rng.random()
        if k < 0.2:
            return "- " + some(1, 6)
        if k < 0.3:
            return " ".join([some(1, 12)] * rng.randint(2, 9)) + " " + some(0, 9)
        if k < 0.36:
            return some(700, 1600, words[:3]) + "; " + some(3, 900, words[:3])
        return some(100, 1600) if k < 0.4 else some(1, 14)

    rows = []
    for d in range(40):
        for s in range(rng.randint(1, 4)):
            text = "".join(line() + rng.choice(["\n", "\n", "\n\n"]) for _ in range(rng.randint(1, 14)))
            rows.append((f"d{d}", "T", None, s, rng.choice([None, "s1", f"s{s}"]), rng.choice([None, "Strona 3", f"Dział {s}"]), rng.choice([None, "page", "slide", "worksheet"]), s + 1, s, rng.choice([None, "Ark"]), text))
    con = duckdb.connect()
    con.register("x", pd.DataFrame(rows, columns="doc title lang sec sid label kind page slide sheet text".split()))
    df = spark.createDataFrame(rows, "doc string, title string, lang string, sec int, section_id string, label string, kind string, page_number int, slide_number int, sheet_name string, text string")
    section = F.struct("sec", "section_id", "label", "kind", "page_number", "slide_number", "sheet_name", "text")
    docs = df.groupBy("doc", "title").agg(F.array_sort(F.collect_list(section)).alias("sections")).withColumn("text", F.lit(None).cast("string"))
    for target, flatten in ((350, True), (100, False)):
        found = con.execute(Q.chunk_sql("SELECT * FROM x", target, flatten))
        out = Q._shown(S.chunk_documents(docs, "doc", "text", "title", target, flatten, "sections"))
        assert table(out.columns, out.collect()) == table([c[0] for c in found.description], found.fetchall())
