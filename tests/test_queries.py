import pytest

from corpusmill.plans import catalog

from .oracle import connect, same

QUERIES, SQL = catalog.queries(), catalog.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_gives_the_rows_of_its_sql(spark, con, sf, name):
    same(spark, con, sf, QUERIES[name], SQL[name])


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(SQL)


def test_entry(spark, sf):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0 and set(e.oracle_sql()) <= set(e.queries())


def test_chunks_of_the_engine_pass_the_audit_of_their_text(spark, sf):
    from pyspark.sql import functions as F

    chunks = QUERIES["chunks_of_documents"](spark, sf)
    per_doc = chunks.groupBy(F.substring_index("id", ":chunk:", 1).alias("d")).agg(F.count("*").alias("n"), F.max("chunk_number").alias("m"), F.max("chunk_count").alias("c"))
    assert per_doc.count() > 50 and per_doc.filter("n != m or n != c").count() == 0
