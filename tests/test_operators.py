import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from corpusmill.operators import changes as C
from corpusmill.operators import grouping as G
from corpusmill.operators import html as H
from corpusmill.operators import joins as J
from corpusmill.operators import pages
from corpusmill.operators import quality as Q
from corpusmill.sources import office, records, web
from corpusmill.streaming import feeds


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_ranking(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, None), (None, 5, "z")], "k string, p int, v string")
    assert rows(G.first_rows(df, ["k"], "p").select("k", "p")) == [("a", 1), ("b", 1), (None, 5)]
    assert rows(G.last_wins(df, ["k"], "p").select("k", "p")) == [("a", 2), ("b", 1), (None, 5)]
    assert rows(G.count_by(df, "k")) == [("a", 2), ("b", 1), ("unknown", 1)]
    assert rows(G.highest_rank(df, ["k"], "v", {"y": 2, "x": 1}, "p").select("k", "v")) == [("a", "y"), ("b", None), (None, "z")]
    assert rows(G.duplicate_groups(df, "k")) == [("a", 2)]
    assert rows(G.collect_in_order(df.union(df), ["k"], "p", "v", "all")) == [("a", ["x", "y"]), (None, ["z"])]


def test_ids_in_total_order_over_partitions(spark):
    df = spark.range(5000).select(F.md5(F.col("id").cast("string")).alias("u")).repartition(7)
    out = G.number_rows(df, ["u"], "n", "id-%05d").orderBy("u").collect()
    assert [r.n for r in out] == [f"id-{i:05d}" for i in range(1, 5001)]


def test_natural_order(spark):
    df = spark.createDataFrame([(x,) for x in ("p10", "p2", "p1", "a3")], "v string")
    assert [r.v for r in df.orderBy(*G.natural_order(F.col("v"))).collect()] == ["a3", "p1", "p2", "p10"]


def test_sequences(spark):
    df = spark.createDataFrame([("ok", 0, 2), ("ok", 1, 2), ("gap", 0, 2), ("gap", 2, 2), ("size", 0, 3), ("none", None, None)], "d string, i int, c int")
    assert rows(G.sequence_errors(df, "d", "i", "c").select("d", "sequence_error", "count_error")) == [("gap", True, False), ("none", True, True), ("size", False, True)]


def test_joins(spark):
    left = spark.createDataFrame([("1", "a", "b"), ("2", "x", "b"), ("3", None, None)], "id string, one string, two string")
    rules = spark.createDataFrame([("a", "A"), ("b", "B"), ("b", "B")], "k string, v string")
    assert rows(J.lookup_with_fallback(left, rules, "one", "two", "k", "v").select("id", "v")) == [("1", "A"), ("2", "B"), ("3", None)]
    al = spark.createDataFrame([("1", ["z", "b", "a"]), ("2", ["q"]), ("3", None)], "id string, al array<string>")
    assert rows(J.lookup_by_alias(al, "id", "al", rules, "k", "v")) == [("1", "A", 2), ("2", None, 0), ("3", None, 0)]
    assert rows(J.merge_by_precedence([rules, spark.createDataFrame([("a", "no"), ("c", "C")], "k string, v string")], "k", ["v"])) == [("a", "A"), ("b", "B"), ("c", "C")]
    assert rows(J.missing(left.select(F.col("one").alias("k")), rules, "k")) == [("x",), (None,)]


def snapshot(spark, rows_):
    return spark.createDataFrame(rows_, "document_id string, content_sha256 string, metadata_sha256 string, chunk_ids array<string>, chunk_text_sha256 array<string>")


def test_diff(spark):
    a = snapshot(spark, [("same", "c", "m", ["1"], ["h"]), ("gone", "c", "m", ["2"], ["h"]), ("content", "c", "m", ["3"], ["h"]), ("meta", "c", "m", ["4"], ["h"]), ("cut", "c", "m", ["5"], ["h"])])
    b = snapshot(spark, [("same", "c", "m", ["1"], ["h"]), ("new", "c", "m", ["9"], ["h"]), ("content", "d", "m", ["3"], ["g"]), ("meta", "c", "n", ["4"], ["h"]), ("cut", "c", "m", ["5", "6"], ["h", "h"])])
    got = {r.document_id: (r.action, r.reason, r.delete_chunk_ids, r.upsert_chunk_ids) for r in C.snapshot_diff(a, b).collect()}
    assert got == {
        "same": ("unchanged", "unchanged", [], []), "gone": ("deleted", "document_removed", ["2"], []), "new": ("new", "document_added", [], ["9"]),
        "content": ("changed", "content_changed", ["3"], ["3"]), "meta": ("changed", "metadata_changed", ["4"], ["4"]), "cut": ("changed", "chunking_changed", ["5"], ["5", "6"]),
    }
    assert C.snapshot_diff(a, a).filter("action != 'unchanged'").count() == 0


def test_rules_and_gate(spark):
    df = spark.createDataFrame([("a", 1), ("b", None), ("c", 9)], "id string, n int")
    issues = Q.check(df, [Q.Rule("high", "error", F.col("n") > 5, F.col("n")), Q.Rule("null", "warning", F.col("n").isNull())], ["id"])
    assert rows(issues) == [("b", "warning", "null", None), ("c", "error", "high", "9")]
    with pytest.raises(ValueError, match="high 1"):
        Q.require(issues)
    Q.require(issues.filter("severity = 'warning'"))


def test_html(spark):
    html = "<h1>A <b>b</b></h1><script>no()</script><p>x &amp; y<br>z</p><table><tr><td>1</td><td>2</td></tr></table><a href='/d.pdf?utm_source=1'>doc</a><a href='#x'>n</a><a href='http://o.pl'>o</a><a>none</a><h1>A b</h1>"
    df = spark.createDataFrame([("1", html, "http://h.pl/p/"), ("2", None, "http://h.pl/"), ("3", "<p>open <a href='x", None)], "id string, html string, url string")
    pages = {r.id: r for r in H.parse_pages(df, "id", "html", "url").collect()}
    assert pages["1"].headings == ["A b"] and "no()" not in pages["1"].text and "x & y" in pages["1"].text and pages["2"].text == ""
    links = rows(H.page_links(H.parse_pages(df, "id", "html", "url"), ["o.pl"]).select("url", "anchor_text", "kind"))
    assert links == [("http://h.pl/d.pdf", "doc", "attachment"), ("http://o.pl/", "o", "institutional")]


def test_json_lines(spark, tmp_path):
    p = tmp_path / "x.jsonl"
    p.write_text('{"a": 1}\n\n[1]\n{"a": 2, "b": "z"}\n', encoding="utf-8")
    assert rows(records.read_jsonl(spark, str(p), "a int, b string")) == [(1, None), (2, "z")]
    assert records.read_jsonl_optional(spark, str(tmp_path / "none"), "a int").count() == 0
    with pytest.raises(FileNotFoundError):
        records.read_jsonl(spark, str(tmp_path / "none"), "a int")
    p.write_text('{"a": 1}\n\n[1]\n{"a": \n"s"\n{"a": 3}\n', encoding="utf-8")
    with pytest.raises(Exception, match="malformed"):
        records.read_jsonl(spark, str(p), "a int").collect()
    good, issues = records.read_jsonl_audited(spark, str(p), "a int")
    assert rows(good.select("_line", "a")) == [(1, 1), (6, 3)]
    assert rows(issues) == [(3, "record_not_object"), (4, "invalid_json"), (5, "record_not_object")]


def test_blobs_rules_and_sinks(spark, tmp_path):
    import gzip

    (tmp_path / "b").mkdir()
    for name, body in (("h1", {"text": "x"}), ("h2", None)):
        with gzip.open(tmp_path / "b" / f"{name}.json.gz", "wt") as f:
            f.write("{broken" if body is None else json.dumps(body))
    assert rows(records.read_blobs(spark, str(tmp_path / "b"), "text string")) == [("h1", "x", False), ("h2", None, True)]
    (tmp_path / "r.yml").write_text("rules:\n  - {id: a, decision: ocr}\n  - {id: b, decision: exclude}\n")
    assert rows(records.read_rules(spark, str(tmp_path / "r.yml"), "rules", "id string, decision string", {"decision": {"ocr", "exclude"}})) == [("a", "ocr"), ("b", "exclude")]
    with pytest.raises(ValueError):
        records.read_rules(spark, str(tmp_path / "r.yml"), "rules", "id string", {"decision": {"ocr"}})
    df = spark.createDataFrame([("s1", "a", None), ("s2", "b", 2)], "source_id string, t string, n int")
    records.write_jsonl(df, str(tmp_path / "out"), ["source_id"])
    line = next((tmp_path / "out" / "source_id=s1").glob("*.json")).read_text()
    assert json.loads(line) == {"t": "a", "n": None}
    text = df.select(records.markdown(F.col("t"), F.nullif(F.col("t"), F.lit("b")), {"n": F.col("n")}).alias("m")).collect()
    assert text[0].m.startswith("## a\n\n- n: ") and text[1].m is None
    assert json.loads(records.status_json(df.agg(F.sum("n").alias("n"))).first().value) == {"n": 2}


def _zip(files):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for n, b in files.items():
            z.writestr(n, b)
    return out.getvalue()


def test_office_files(spark):
    w = 'xmlns:w="w"'
    docx = _zip({"word/document.xml": f'<w:document {w}><w:body><w:p><w:pPr><w:pStyle w:val="Heading1"/></w:pPr><w:r><w:t>Tytuł</w:t></w:r></w:p><w:p><w:r><w:t>tekst</w:t></w:r></w:p><w:tbl><w:tr><w:tc><w:p><w:r><w:t>a</w:t></w:r></w:p></w:tc><w:tc><w:p><w:r><w:t>b</w:t></w:r></w:p></w:tc></w:tr></w:tbl></w:body></w:document>', "word/footer1.xml": f"<w:ftr {w}><w:p><w:r><w:t>stopka</w:t></w:r></w:p></w:ftr>"})
    pptx = _zip({f"ppt/slides/slide{n}.xml": f'<p:sld xmlns:p="p" xmlns:a="a"><a:p><a:r><a:t>slajd {n}</a:t></a:r></a:p></p:sld>' for n in (1, 2, 10)})
    xlsx = _zip({"xl/workbook.xml": '<workbook><sheets><sheet name="Dane"/></sheets></workbook>', "xl/sharedStrings.xml": "<sst><si><t>nazwa</t></si></sst>", "xl/worksheets/sheet1.xml": '<worksheet><sheetData><row><c t="s"><v>0</v></c><c><f>A1+1</f><v>42</v></c><c/></row></sheetData></worksheet>'})
    odt = _zip({"content.xml": '<office:doc xmlns:office="o" xmlns:text="t"><office:text><text:h>Nagłówek</text:h><text:p>akapit <text:span>pierwszy</text:span></text:p></office:text></office:doc>'})
    files = [("f/a.docx", docx), ("f/b.pptx", pptx), ("f/c.xlsx", xlsx), ("f/d.odt", odt), ("f/e.docx", b"broken"), ("f/f.pdf", b"%PDF-"), ("f/g.docx", b"x" * 200)]
    df = spark.createDataFrame([(p, bytearray(b)) for p, b in files], "path string, content binary")
    out = {r.path: r for r in office.read_documents(df, most_bytes=5000).collect()}
    assert out["f/a.docx"].text == "Tytuł\ntekst\na b\n\nstopka" and [s.kind for s in out["f/a.docx"].sections] == ["section", "header_footer"]
    assert [s.text for s in out["f/b.pptx"].sections] == ["slajd 1", "slajd 2", "slajd 10"]
    assert out["f/c.xlsx"].text == "nazwa 42" and out["f/c.xlsx"].sections[0].label == "Dane"
    assert out["f/d.odt"].text == "Nagłówek\nakapit pierwszy"
    assert {out[f"f/{n}"].status for n in ("e.docx", "f.pdf", "g.docx")} == {"failed"} and "no reader" in out["f/f.pdf"].error


def test_paging_and_probes(spark):
    def get(url, headers):
        page = int(url.split("&page=")[1].split("&")[0])
        return 200, {"x-wp-totalpages": "3"}, json.dumps([{"id": page * 10 + k} for k in range(2)] + ["no object"]).encode()

    assert [x["id"] for x in web.pages("http://h", "posts", get, per_page=3)] == [10, 11, 20, 21, 30, 31]

    def short(url, headers):
        page = int(url.split("&page=")[1].split("&")[0])
        return 200, {}, json.dumps([{"id": page}] * (2 if page < 3 else 1)).encode()

    assert len(list(web.pages("http://h", "posts", short, per_page=2))) == 5

    def head(url, headers):
        if "bad" in url:
            raise OSError("no host")
        return 206, {"content-type": "application/pdf", "content-range": "bytes 0-0/77"}, b""

    df = spark.createDataFrame([("http://h/a.pdf",), ("http://bad/",), (None,)], "u string")
    got = {r.url: r for r in web.judge_probes(web.probe(df, "u", head), ["application/pdf"]).collect()}
    assert got["http://h/a.pdf"].size == 77 and got["http://h/a.pdf"].reachable and not got["http://bad/"].reachable and got["http://bad/"].error == "no host"


def test_stream_keeps_the_latest_rows(spark, tmp_path):
    schema = "document_id string, generated_at string, action string, reason string"
    src = tmp_path / "in"
    src.mkdir()

    def put(name, rows_):
        spark.createDataFrame(rows_, schema).coalesce(1).write.mode("append").json(str(src / name))

    put("one", [("a", "2024-01-01", "upsert", "new"), ("b", "2024-01-01", "upsert", "new")])
    for _ in range(2):
        stream = spark.readStream.schema(schema).json(str(src / "*"))
        feeds.keep_state(stream, str(tmp_path / "state"), str(tmp_path / "cp")).awaitTermination()
        put("two", [("a", "2024-02-01", "upsert", "content_changed"), ("a", "2023-01-01", "upsert", "late"), ("c", "2024-02-01", "upsert", "new")])
    got = {r.document_id: r.reason for r in feeds.read_part_state(spark, str(tmp_path / "state")).collect()}
    assert got == {"a": "content_changed", "b": "new", "c": "new"}


def test_downloads(spark):
    def get(url, headers):
        if headers.get("If-None-Match") == "v1":
            return 304, {}, b""
        return 200, {"etag": "v2"}, b"x" * (100 if "big" in url else 3)

    df = spark.createDataFrame([("http://h/same", "v1"), ("http://h/new", None), ("http://h/big", None), (None, None)], "u string, etag string")
    got = {r.url.rsplit("/")[-1]: r for r in web.download(df, "u", get, most_bytes=50).collect()}
    assert got["same"].status == 304 and got["same"].content is None and got["big"].error == "too large" and got["big"].content is None
    assert bytes(got["new"].content) == b"xxx" and len(got["new"].content_sha256) == 64 and got["new"].etag == "v2"


def test_downloads_stop_at_the_limit():
    class Response:
        def __init__(self, data, headers):
            self.data, self.headers, self.taken = io.BytesIO(data), headers, 0

        def read(self, n=-1):
            block = self.data.read(n)
            self.taken += len(block)
            return block

    long = Response(b"x" * 1_000_000, {})
    assert len(web._body(long, 100_000)) == 100_001 == long.taken
    said = Response(b"x" * 500, {"Content-Length": "500"})
    assert web._body(said, 100) == b"" and said.taken == 0
    assert len(web._body(Response(b"x" * 500, {}), None)) == 500 == len(web._body(Response(b"x" * 500, {}), 500))


def test_whole_probes_are_judged_by_type_and_bytes(spark):
    answers = {
        "http://h/a.pdf": (200, {"content-type": "application/pdf"}, b"%PDF-1.7" + b"x" * 9000), "http://h/b.pdf": (200, {"content-type": "application/octet-stream"}, b"%PDF-1.4"), "http://h/c.pdf": (200, {"content-type": "text/html"}, b"<html>"),
        "http://h/d.docx": (200, {"content-type": "application/pdf"}, b"%PDF-1.4"), "http://h/e.exe": (200, {}, b"MZ"), "http://h/f.pdf": (404, {}, b""), "http://h/g.pdf": (200, {}, b" <!DOCTYPE html>"),
    }

    def get(url, headers):
        if url not in answers:
            raise OSError("no host")
        return answers[url]

    df = spark.createDataFrame([(u,) for u in [*answers, "http://bad/x.pdf", None]], "u string")
    got = {r.url[9:]: r for r in web.judge_whole(web.probe_whole(df, "u", get), ["application/pdf"]).collect()}
    want = {"a.pdf": "supported_type_and_bytes", "b.pdf": "generic_type_and_bytes", "c.pdf": "html_response", "d.docx": "mismatch", "e.exe": "unsupported_extension", "f.pdf": "unreachable", "g.pdf": "html_response", "d/x.pdf": "unreachable"}
    assert {n: r.verdict for n, r in got.items()} == want and got["a.pdf"].valid and not got["c.pdf"].valid and len(got["a.pdf"].head) == web.SAMPLE


def test_sites_and_their_contents(spark):
    def get(url, headers):
        if url.startswith("http://wp"):
            if url.endswith("/types"):
                return 200, {}, json.dumps({"post": {"rest_base": "posts", "taxonomies": ["category"]}, "event": {"rest_base": "events"}, "odd": None}).encode()
            if "per_page=1" in url:
                return (200, {"x-wp-total": "7"}, b"[]") if "odd" not in url else (404, {}, b"")
            if url.endswith("/wp-json/"):
                return 200, {}, b"{}"
            return 404, {}, b""
        if url == "http://map/wp-sitemap.xml":
            return 200, {}, b"<urlset/>"
        if url == "http://map/sitemap.xml":
            return 200, {}, b"<html/>"
        if url.startswith("http://gone"):
            raise OSError("no host")
        return 200 if url.endswith("/") else 404, {}, b"page"

    df = spark.createDataFrame([("a", "http://wp/"), ("b", "http://map"), ("c", "http://gone"), ("d", None)], "id string, base string")
    got = {r.base_url: r for r in web.probe_sites(df, "base", get).withColumn("adapter", pages.adapter(F.col("api_ok"), F.col("sitemap_url").isNotNull())).collect()}
    assert {b: r.adapter for b, r in got.items()} == {"http://wp": "wordpress", "http://map": "sitemap_html", "http://gone": "seeded_html"}
    assert got["http://map"].sitemap_url == "http://map/wp-sitemap.xml" and got["http://gone"].home_status is None and got["http://map"].home_status == 200
    totals = web.content_totals(df, "id", "base", get)
    rows = {(r.source_id, r.content_type): r for r in totals.collect()}
    assert rows["a", "post"].total == 7 and rows["a", "post"].taxonomies == ["category"] and rows["a", "odd"].error == "status 404" and rows["c", None].error == "no host"
    assert {(r.source_id, r.types, r.custom_types, r["items"]) for r in pages.inventory(totals.filter("error is null")).collect()} == {("a", 2, 1, 14)}


def test_typed_lines_and_readers(spark, tmp_path):
    (tmp_path / "ok.jsonl").write_text('{"a": 1}\n\n{"a": 2}\n')
    (tmp_path / "bad.jsonl").write_text('{"a": 1}\n[1]\n')
    assert sorted(r.a for r in records.read_jsonl_typed(spark, str(tmp_path / "ok.jsonl"), "a int").collect()) == [1, 2]
    assert records.read_jsonl_typed(spark, str(tmp_path / "none.jsonl"), "a int").count() == 0
    with pytest.raises(Exception, match="no object"):
        records.read_jsonl_typed(spark, str(tmp_path / "bad.jsonl"), "a int").collect()
    files = spark.createDataFrame([("a.pdf", bytearray(b"two pages of text, long enough|more|!")), ("b.pdf", bytearray(b"short")), ("c.doc", bytearray(b"old")), ("d.png", bytearray(b"x|y"))], "path string, content binary")
    own = office.pdf(lambda data: [ValueError("broken") if t == "!" else t for t in data.decode().split("|")])
    scan = office.recognized(lambda data: data.split(b"|"), lambda image: image.decode() * 15)
    got = {r.path: r for r in office.read_documents(files, {"pdf": own, "png": scan, "doc": office.first_that_reads(office.docx, lambda data: [("document", "Dokument", "converted text")])}).collect()}
    assert [s.label for s in got["a.pdf"].sections] == ["Strona 1", "Strona 2"] and got["a.pdf"].status == "ok"
    assert got["b.pdf"].status == "failed" and "needs_ocr" in got["b.pdf"].error and got["c.doc"].text == "converted text" and got["d.png"].text == "x" * 15 + "\n\n" + "y" * 15
