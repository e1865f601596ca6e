"""Statistics against plain Python counts."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from termscape.functions import text as tx
from termscape.operators import stats
from termscape.operators.filters import with_min_terms
from termscape.operators.topk import top_per_group

DOCS = [
    (1, ["a", "b", "a"]), (2, ["a"]), (3, []), (4, ["b", "c", "c", "c"]), (5, ["hot"] * 500),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "doc_id int, terms array<string>")


def pairs(df):
    return {tuple(r) for r in df.collect()}


def test_totals(docs):
    assert tuple(stats.token_totals(docs).first()) == (508, 508 / 5)
    assert tuple(stats.distinct_totals(docs).first()) == (4, 6 / 5)
    unique, per_doc = stats.distinct_totals(docs, approximate=True).first()
    assert (unique, per_doc) == (4, 6 / 5)
    assert stats.longest_document(docs).first()[0] == 500
    assert stats.usable_documents(docs).first()[0] == 3


def test_frequencies(docs):
    tf = Counter(t for _, terms in DOCS for t in terms)
    df = Counter(t for _, terms in DOCS for t in set(terms))
    assert pairs(stats.term_frequency(docs)) == set(tf.items())
    assert pairs(stats.document_frequency(docs)) == set(df.items())
    assert pairs(stats.term_profile(docs)) == {(t, tf[t], df[t]) for t in tf}


def test_min_terms(docs):
    assert {r["doc_id"] for r in with_min_terms(docs).collect()} == {1, 4, 5}


def test_vocabulary_difference(spark):
    left = spark.createDataFrame([("a",), ("b",)], "term string")
    right = spark.createDataFrame([("b",), ("c",)], "term string")
    assert pairs(stats.vocabulary_difference(left, right)) == {("a", "left"), ("c", "right")}


def test_funnel(spark):
    texts = [(1, "The cats, sitting and the cat2"), (2, "and"), (3, "")]
    docs = spark.createDataFrame(texts, "doc_id int, content string")
    report = {r["stage"]: tuple(r)[1:] for r in stats.preprocessing_funnel(docs).collect()}
    assert report["1 tokenize"] == (8, 6, 8 / 3, 7 / 3)
    assert report["2 stop words"] == (4, 4, 4 / 3, 4 / 3)
    assert report["3 lemmatize"] == (3, 3, 1.0, 1.0)
    assert report["4 filter"] == (2, 2, 2 / 3, 2 / 3)
    stemmed = stats.preprocessing_funnel(docs, normalizer=tx.strip_suffix)
    assert stemmed.where("stage = '4 filter'").first()["tokens"] == 2


def test_column_summary(docs):
    summary = {r["summary"]: r["doc_id"] for r in stats.column_summary(docs, "doc_id").collect()}
    assert summary["count"] == "5" and summary["max"] == "5"


@pytest.mark.parametrize("k", [3, 1500])
def test_top_per_group_with_a_hot_group(spark, k):
    rows = spark.range(9000).select(
        F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id") % 5).alias("g"),
        (F.col("id") * 7919 % 1000).alias("v"), "id",
    )
    found = top_per_group(rows, ["g"], [F.desc("v"), F.col("id")], k)
    expected = []
    local = [tuple(r) for r in rows.collect()]
    for group in {g for g, _, _ in local}:
        members = sorted((r for r in local if r[0] == group), key=lambda r: (-r[1], r[2]))
        expected += [(*r, i + 1) for i, r in enumerate(members[:k])]
    assert sorted(tuple(r) for r in found.collect()) == sorted(expected)


def test_top_per_group_limits_before_the_shuffle(spark):
    rows = spark.range(100).select((F.col("id") % 3).alias("g"), "id")
    plan = top_per_group(rows, ["g"], [F.col("id")], 5)._jdf.queryExecution().executedPlan()
    assert "Partial" in plan.toString().split("Exchange")[1]
