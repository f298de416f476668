"""Queries cover their whole tables."""

from corpusmill.plans import catalog

QUERIES = catalog.queries()


def test_documents_of_any_length_are_packed(spark, tmp_path):
    sentence = "Zdanie ma " + "bardzo " * 17 + "dużo słów."  # 21 words, two to a segment
    rows = [("short", sentence), ("long", " ".join([sentence] * 400)), ("one", "słowo " * 5000), ("none", None), ("blank", " ")]
    spark.createDataFrame(rows, "doc_id string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert {r.doc_id: r.segments for r in QUERIES["sentence_packing"](spark, str(tmp_path)).collect()} == {"short": 1, "long": 200, "one": 1}


def test_names_with_letters_are_ordered(spark, tmp_path):
    names = ["10.pdf", "2.pdf", "part 2 of 10.pdf", "part 2 of 9.pdf", "plan.docx", None, "2.pdf"]
    spark.createDataFrame([(n,) for n in names], "filename string").write.parquet(f"{tmp_path}/text_index.parquet")
    rows = QUERIES["natural_order"](spark, str(tmp_path)).collect()
    assert [r.filename for r in sorted(rows, key=lambda r: int(r.k))] == ["2.pdf", "10.pdf", "part 2 of 9.pdf", "part 2 of 10.pdf", "plan.docx"]


def test_documents_with_any_character_have_token_counts(spark, tmp_path):
    rows = [("a", "dwa słowa"), ("emoji", "dwa 😀 słowa"), ("cjk", "漢字 tekst"), ("none", None)]
    spark.createDataFrame(rows, "doc_id string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert {r.doc_id: r.tokens for r in QUERIES["token_counts"](spark, str(tmp_path)).collect()} == {"a": 2, "emoji": 2, "cjk": 2}
