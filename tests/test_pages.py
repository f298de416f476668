import json

from corpusmill.operators import pages as P


def test_items_become_documents_and_attachments(spark):
    item = {
        "id": 7, "type": "post", "slug": "s", "link": "https://X.pl//a/?utm_source=1", "title": {"rendered": "A &amp; b"}, "content": {"rendered": "<h2>Nagłówek</h2><p>jeden dwa trzy cztery pięć</p><a href='/p.pdf'>plik</a>"},
        "excerpt": {"rendered": "<p>sześć siedem osiem dziewięć dziesięć</p>"}, "acf": {"x": [{"t": "<a href='https://o.pl/z'>inny</a>"}, "https://skip.pl", "  "], "n": 3}, "date_gmt": "", "date": "2024-01-01", "categories": [1], "my_category": "q", "other": [2],
    }
    media = {"id": 8, "link": "https://x.pl/m", "source_url": "https://x.pl/u/plik%20a.pdf", "media_type": "file", "mime_type": "application/pdf", "media_details": {"filesize": 12}, "post": 7, "title": {"rendered": "P"}}
    image = {"id": 9, "link": "https://x.pl/i", "media_type": "image", "mime_type": "image/png"}
    rows = [("x", "posts", json.dumps(item)), ("x", "posts", "[1]"), ("x", "posts", "{bad"), ("x", "posts", None), ("x", "posts", json.dumps({"id": 1}))]
    read = P.read_items(spark.createDataFrame(rows, "source_id string, content_type string, item string"))
    docs = {r.id: r for r in P.documents(read).collect()}
    d = docs["x:posts:7"]
    assert set(docs) == {"x:posts:7", "x:posts:1"} and d.url == "https://x.pl/a/" and d.title == "A & b" and d.indexable and d.published_at == "2024-01-01"
    assert d.headings == ["Nagłówek"] and {x.url for x in d.links} == {"https://X.pl/p.pdf", "https://o.pl/z"} and json.loads(d.taxonomies) == {"categories": [1], "my_category": "q"}
    assert docs["x:posts:1"].title == "Bez tytułu" and not docs["x:posts:1"].indexable
    files = P.attachments(P.read_items(spark.createDataFrame([("x", "media", json.dumps(m)) for m in (media, image)], "source_id string, content_type string, item string"))).collect()
    assert [(f.id, f.filename, f.filesize, f.parent) for f in files] == [("x:media:8", "plik a.pdf", 12, 7)]


def test_strings_and_inventory(spark):
    assert list(P.strings_of({"a": ["x", {"b": " "}, 3, None], "c": "y"})) == ["x", "y"]
    df = spark.createDataFrame([("s", "post", 5), ("s", "news", None), ("t", "page", 2)], "source_id string, content_type string, total int")
    assert sorted(map(tuple, P.inventory(df).collect())) == [("s", 2, 1, 5), ("t", 1, 0, 2)]
