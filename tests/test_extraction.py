import pytest
from pyspark.sql import functions as F

from corpusmill.functions import url as U
from corpusmill.operators import corpus as C
from corpusmill.operators import extraction as E
from corpusmill.operators import grouping as G
from corpusmill.operators import quality as Q


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_links_and_parents(spark):
    pages = spark.createDataFrame([("p1", ["https://h/a.pdf?utm_source=x", "https://h/a.pdf"]), ("p2", ["HTTPS://H/a.pdf", None]), (None, ["https://h/a.pdf"]), ("p3", None)], "id string, urls array<string>")
    files = spark.createDataFrame([("x", "https://h/a.pdf", "kept"), ("y", "https://h/none.pdf", None), ("z", None, None), ("x", "https://h/a.pdf", "kept")], "id string, url string, page string")
    got = E.with_links(files, E.link_edges(pages, "id", "urls", U.normalize_url), "url")
    assert rows(got.select("id", "linked_from", "page")) == rows(spark.createDataFrame([("x", ["p1", "p2"], "kept"), ("x", ["p1", "p2"], "kept"), ("y", [], None), ("z", [], None)], "id string, l array<string>, page string"))
    docs = spark.createDataFrame([("s", 5, "d5"), ("s", 5, "d4"), ("t", 5, "other"), ("s", None, "none"), ("s", 0, "zero")], "src string, n long, id string")
    own = spark.createDataFrame([("a", "s", 5), ("b", "s", 0), ("c", None, 5), ("d", "s", None), ("e", "s", 6)], "a string, source string, parent long")
    assert rows(E.with_parents(own, docs, "source", "parent", "src", "n", ["id"]).select("a", "parent", "parent_id")) == [("a", 5, "d4"), ("b", None, None), ("c", 5, None), ("d", None, None), ("e", 6, None)]


def test_incremental_outcomes(spark):
    queue = spark.createDataFrame([("a", 200, "h1"), ("b", 304, None), ("c", 200, "h9"), ("d", 200, "h4"), ("e", 500, None), ("f", 200, "h6"), ("g", None, None)], "url string, status int, digest string")
    state = spark.createDataFrame([("a", "h1"), ("c", "h3"), ("f", "h6"), ("gone", "h0"), (None, "h")], "url string, sha string")
    index = spark.createDataFrame([("a", "blob"), ("f", None)], "url string, blob string")
    got = E.incremental(E.with_prior(queue, state, index, "url", ["sha"], ["blob"]), F.col("status"), F.col("digest"), F.col("state_sha"), F.col("index_blob").isNotNull())
    assert {r.url: (r.outcome, r.carried) for r in got.collect()} == {
        "a": ("downloaded_unchanged", True), "b": ("not_modified", True), "c": ("changed", False), "d": ("new", False), "e": ("failed", True), "f": ("changed", False), "g": ("failed", True),
    }
    assert rows(E.removed(state.filter("url is not null"), queue, "url", True).select("url")) == [("gone",)] and E.removed(state, queue, "url", False).count() == 0


def test_queue_by_precedence(spark):
    make = lambda *r: spark.createDataFrame(list(r), "url string, a string")
    queue, left = E.assemble_queue([("first", make(("u1", "x"), ("u1", "b"), (None, "n"))), ("second", make(("u1", "y"), ("u2", "y"), ("u3", None)))], spark.createDataFrame([("u2", 1), (None, 2)], "url string, a int"), "url")
    assert rows(queue) == [("u1", "first", "b"), ("u3", "second", None)] and rows(left) == [("u2", "second", "y")]
    df = spark.createDataFrame([(True, "pdf", "application/pdf"), (True, "exe", "application/pdf"), (None, "pdf", "application/pdf")], "r boolean, e string, m string")
    assert [r[0] for r in df.select(E.supported_override(F.col("r"), F.col("e"), F.col("m"), ["pdf"], ["application/pdf"])).collect()] == [True, False, False]
    own = spark.createDataFrame([("s", "PDF", "u1"), ("s", "pdf", "u2"), ("t", "pdf", "u3"), ("s", None, "u4"), ("s", "pdf", None)], "source_id string, extension string, effective_url string")
    sources, done = spark.createDataFrame([("s",)], "source_id string"), spark.createDataFrame([("u2",), (None,)], "effective_url string")
    assert rows(G.select_queue(own, sources, ["pdf"], done).select("effective_url")) == [("u1",), (None,)] and G.select_queue(own).count() == 5


def test_texts_positions_rules_and_conditions(spark):
    import hashlib

    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    records = spark.createDataFrame([("a", sha("x")), ("b", sha("x")), ("c", sha("x")), ("d", None), ("a", sha("x"))], "id string, sha string")
    texts = spark.createDataFrame([("a", "x", 1), ("b", "y", 1), ("d", "x", 1), ("a", "x", 1)], "id string, text string, sha int")
    assert rows(E.verify_texts(records, texts, "id", "sha", "text")) == [("b", "text_hash_mismatch"), ("c", "missing_text"), ("d", "text_hash_mismatch")]
    urls = spark.createDataFrame([(3, "u"), (1, "u"), (2, "v"), (4, None), (5, None)], "n int, url string")
    assert rows(E.repeated_positions(urls, "url", ["n", "url"])) == [("u", [1, 3])]
    rules = spark.createDataFrame([("h", "exclude", "b", 1), ("h", "ocr", "a", 3), ("h", "ocr", "b", 2), ("h", None, None, 0), ("g", "odd", "z", 1)], "h string, decision string, reason string, p int")
    assert rows(E.consolidate_rules(rules, "h", "decision", "reason", {"ocr": 3, "exclude": 1}, "p")) == [("g", "odd", ["z"]), ("h", "ocr", ["a", "b"])]
    one = lambda v: spark.createDataFrame([(v,)], "x boolean")
    assert rows(E.all_hold({"a": one(True), "b": one(True)})) == [(True, True, True)] and rows(E.all_hold({"a": one(True), "b": one(None)})) == [(True, False, False)]
    left, right = spark.createDataFrame([("k", "t", 1), ("m", "u", 2)], "k string, t string, n int"), spark.createDataFrame([("k", None, "new")], "k string, t string, z string")
    assert rows(E.merge_right(left, right, "k")) == [("k", None, 1, "new"), ("m", "u", 2, None)]
    assert E.at_run(left, "2024-01-01").select("generated_at").distinct().count() == 1
    lines = spark.createDataFrame([("a", '{"c": "x", "n": 1}'), ("b", '{"c": ["x"]}'), ("c", '{"c": null}'), ("d", '{"c": ""}'), ("e", "{}"), ("f", '{"c": {"a": 1}}')], "id string, value string")
    assert rows(Q.wrong_types(lines, "value", {"c": "ARRAY", "n": "BIGINT"}, ["id"])) == [("a", "c"), ("f", "c")]


def test_corpus_is_built(spark):
    text = "Pierwsze zdanie tekstu jest tutaj. " * 3
    df = spark.createDataFrame([("b", text, "T_1", None), ("a", text, "T", "pl"), ("a", text, "T", "pl"), ("c", "krótki", "x", None), ("d", None, None, None), (None, text, None, None)], "id string, text string, title string, lang string")
    kept, excluded = C.records(df, "id", "text", title_col="title", language_col="lang", metadata={"id": "id"})
    assert rows(excluded) == [("c", "low_text"), ("d", "missing_text"), (None, "missing_id")]
    built = C.build_corpus(kept)
    assert rows(built["documents"].select("document_id", "copies", "title", "language")) == [("a", 2, "T", "pl")] and built["broken"].count() == 0
    state = built["state"]
    again = C.build_corpus(kept, before=state.withColumn("metadata_sha256", F.lit("old")))
    assert rows(again["changes"].select("document_id", "action", "reason")) == [("a", "changed", "metadata_changed")]
    assert rows(C.build_corpus(kept, before=state)["changes"].select("action")) == [("unchanged",)]
    empty = C.build_corpus(kept.limit(0))
    assert {k: v.count() for k, v in empty.items()} == dict.fromkeys(empty, 0)


def test_kept_state_rewrites_touched_parts_only(spark, tmp_path):
    from corpusmill.streaming import feeds

    src = tmp_path / "in"
    schema = "document_id string, generated_at string, action string, reason string"
    for n, keys in (("one", "abcdefgh"), ("two", "a")):
        spark.createDataFrame([(k, n, "upsert", n) for k in keys], schema).coalesce(1).write.json(str(src / n))
        feeds.keep_state(spark.readStream.schema(schema).json(str(src / "*")), str(tmp_path / "s"), str(tmp_path / "cp"), buckets=8).awaitTermination()
    assert {r.document_id: r.reason for r in feeds.read_part_state(spark, str(tmp_path / "s")).collect()} == {k: "two" if k == "a" else "one" for k in "abcdefgh"}
    versions = sorted((tmp_path / "s").glob("version=*"))
    assert len(list(versions[1].glob("bucket=*"))) == 1 < len(list(versions[0].glob("bucket=*")))
    assert feeds.read_part_state(spark, str(tmp_path / "none")) is None


def test_a_session_on_several_machines_must_name_a_shared_folder():
    from corpusmill.streaming import feeds

    class Session:
        class conf:
            get = staticmethod(lambda *a: None)

        class sparkContext:
            master = "local-cluster[2,1,1024]"

    with pytest.raises(ValueError):
        feeds.scratch(Session)
