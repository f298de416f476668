import random

import numpy as np
from pyspark.sql import functions as F

from corpusmill.llm import languages as L

from .test_languages_and_lines import COMMON, sentence


def test_rows_beyond_a_sample_train_their_language(spark):
    rng = random.Random(3)
    ids = spark.range(30_000).select(F.concat(F.lit("c"), "id").alias("id"), F.pmod(F.xxhash64(F.concat(F.lit("c"), "id")), F.lit(1_000_000)).alias("h"))
    late = [r.id for r in ids.filter("h >= 900000").limit(60).collect()]  # 3,000 rows by this hash hold none of them
    early = [r.id for r in ids.filter("h < 700000").limit(4_000).collect()]
    rows = [(i, " ".join(sentence(rng, "de") for _ in range(3)), None) for i in late]
    rows += [(i, " ".join(sentence(rng, ("en", "pl")[k % 2]) for _ in range(2)), None) for k, i in enumerate(early)]
    df = spark.createDataFrame(rows, "id string, text string, language string").repartition(5)
    words = spark.createDataFrame([(k, w) for k, v in COMMON.items() for w in v], "lang string, word string")
    found = L.identify(df, words).filter(F.col("id").isin(late)).collect()
    assert len(found) == 60 and all(list(r.langs) == ["de"] and r.confidence > 0.8 for r in found)


def test_models_of_a_table_are_those_of_all_its_texts(spark):
    rng = random.Random(5)
    texts = [" ".join(sentence(rng, lang) for _ in range(2)) for lang in COMMON for _ in range(40)] + ["", None, "Zażółć gęślą jaźń w na się"]
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    table, memory = L.fit(df, COMMON, "text"), L.train([t for t in texts if t], COMMON)
    assert table.names == memory.names
    for a, b in zip(table.models, memory.models):
        for x, y in zip(a.tables, b.tables):
            assert all(np.allclose(p, q, rtol=1e-12, atol=0) for p, q in zip(x, y))


def test_counted_rates_reject_like_listed_ones():
    rng = np.random.default_rng(2)
    own, foreign = (np.rint(rng.normal(m, 0.4, 2_000) * 10) / 10 for m in (2.0, 3.5))
    counted = [np.unique(x, return_counts=True) for x in (own, foreign)]
    assert L.rejection(own, foreign) == L.rejection(counted[0][0], counted[1][0], own_counts=counted[0][1], foreign_counts=counted[1][1])
    assert L.rejection([1.0], foreign, own_counts=np.array([19])) == 3.0 and L.rejection([1.0], foreign, own_counts=np.array([20])) < 3.0


def test_a_language_of_one_short_word_has_a_model():
    assert np.isfinite(L.KneserNey(L.Counter({"a": 1})).cost(["a", "other"])).all()
