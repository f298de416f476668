import pytest

from corpusmill.llm import queries as Q

from ..oracle import connect, same


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_query_gives_the_rows_of_its_sql(spark, sf, name):
    same(spark, connect(sf), sf, Q.queries()[name], Q.oracle_sql()[name])


COLUMNS = {"p3_found": ["id", "lang"], "p5_found": ["id", "line_no", "kind", "word"], "p8_found": ["doc_id", "form"]}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_found_has_its_columns_and_distinct_rows(spark, sf, name):
    df = Q.queries()[name](spark, sf)
    rows = df.collect()
    assert df.columns == COLUMNS[name] and rows and len(rows) == len(set(rows))


def test_shares_add_up(spark, sf):
    rows = Q.p7_mix(spark, sf).collect()
    by = {}
    for r in rows:
        by.setdefault(r.mix_id, []).append(r.actual_share)
    assert by and all(abs(sum(s) - 1) < 1e-9 for s in by.values())
