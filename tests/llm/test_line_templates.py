from corpusmill.llm import repeated_lines as R


def test_a_template_whose_slot_differs_per_document_counts_each_document_once(spark):
    names = [a + b for a in ("anna", "jan", "ewa", "piotr", "zofia") for b in ("nowak", "kowalska", "lis", "wilk")]
    rows = [(f"c{k}", f"Written by {n} for the readers\nWritten by {n}x for the readers\nShort line here number {k}", f"d{k}", "s") for k, n in enumerate(names)]
    covered, found, templates = R.repeated_lines(spark.createDataFrame(rows, "id string, text string, document_id string, source_id string"))
    assert {(r.id, r.line_no) for r in found.collect()} == {(f"c{k}", 3) for k in range(20)}
    got = {(r.template, r.key, r.docs, r.need, r.template_docs) for r in templates.collect()}
    assert {(r.id, r.line_no) for r in covered.collect()} == {(f"c{k}", n) for k in range(20) for n in (1, 2, 3)}
    assert got == {(f"written by {R.SLOT} for the readers", None, None, 5, 20), ("short line here number", "short line here number", 20, 5, 20)}


def test_a_repeated_line_and_a_rare_one_share_a_template(spark):
    rows = [(f"c{k}", "Published by staff for our readers" + ("\nPublished by guests for our readers" if k < 2 else ""), f"d{k}", None) for k in range(6)]
    rows.append(("c6", "Published by nobody for our readers", "d6", None))
    covered, found, templates = R.repeated_lines(spark.createDataFrame(rows, "id string, text string, document_id string, source_id string"))
    assert {(r.id, r.line_no) for r in found.collect()} == {(f"c{k}", 1) for k in range(6)}
    assert [(r.template, r.key, r.docs, r.template_docs) for r in templates.collect()] == [(f"published by {R.SLOT} for our readers", "published by staff for our readers", 6, 7)]


def test_a_slotted_byline_is_removed_and_likeness_decides(spark):
    rows = [(f"c{k}", f"Text prepared by {n} for the press office\nSome sentence of its own number {n}{n}.", f"d{k}", "s") for k, n in enumerate(["Anna", "Jan", "Ewa", "Piotr", "Zofia", "Marek"])]
    df = spark.createDataFrame(rows, "id string, text string, document_id string, source_id string")
    texts = lambda likeness: {r.text for r in R.without_lines(df, R.repeated_lines(df, likeness=likeness)[0]).collect()}
    assert all(t == "" or t.startswith("Some") for t in texts(0.8)) and texts(0.95) == {r[1] for r in rows}


def test_a_source_with_many_lines_of_one_beginning(spark):
    rows = [(f"c{k}", "\n".join(["Informacja dla czytelników serwisu"] + [f"Informacja {chr(97 + k % 26)}{chr(97 + j)}{chr(97 + k // 26)} zupełnie inna od pozostałych" for j in range(20)]), f"d{k}", "s", "extra") for k in range(60)]
    df = spark.createDataFrame(rows, "id string, text string, document_id string, source_id string, source string")
    covered, found, _ = R.repeated_lines(df)
    assert {(r.id, r.line_no) for r in found.collect()} == {(f"c{k}", 1) for k in range(60)}
    assert covered.count() == 60 * 21
