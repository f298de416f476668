import random
from collections import Counter

import pytest

from corpusmill.llm import near_duplicates as N

from .test_near_duplicates import VOCABULARY, brute_groups, corpus


def test_links_of_a_crowded_bucket_are_all_counted(spark):
    rng = random.Random(2)
    base = [rng.choice(VOCABULARY) for _ in range(150)]
    rows = [(f"c{k}", " ".join([*base[:k], f"new{k}", *base[k + 1 :]])) for k in range(60)]
    members, links = N.near_duplicates(spark.createDataFrame(rows, "id string, text string"), max_bucket=8)
    assert {r.id: r.n_links for r in members.collect()} == {i: 59 for i, _ in rows}
    assert links.count() == links.select("a", "b").distinct().count() == 60 * 59 // 2


def test_links_are_those_of_small_buckets(spark):
    df = spark.createDataFrame(corpus(3), "id string, text string")
    sets = [{tuple(r) for r in N.near_duplicates(df, sketches=48, max_bucket=m)[1].collect()} for m in (256, 2)]
    assert sets[0] == sets[1] and len(sets[0]) > 10
    degree = Counter(k for a, b, *_ in sets[1] for k in (a, b))
    members = N.near_duplicates(df, sketches=48, max_bucket=2)[0].collect()
    assert all(r.n_links == degree[r.key] for r in members)


@pytest.mark.parametrize("every_link", [True, False])
def test_groups_are_the_same_with_leaders(spark, every_link):
    rows = corpus(3)
    members, _ = N.near_duplicates(spark.createDataFrame(rows, "id string, text string"), sketches=48, max_bucket=2, every_link=every_link)
    assert ("n_links" in members.columns) == every_link
    assert {tuple(r) for r in N.group_pairs(members).collect()} == brute_groups(rows, 0.6, 40)
