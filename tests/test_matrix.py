"""The matrix against Spark ML's own vectorizer and plain Python."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.ml.feature import IDF, CountVectorizer

from termscape.operators import matrix
from termscape.sources import models

DOCS = [
    (10, "d10", "a a a b b c c".split()),
    (11, "d11", "a a b b b d".split()),
    (12, "d12", "a a c c e e".split()),
    (13, "d13", "a a d d d".split()),
    (14, "d14", "x y".split()),
    (15, "d15", "a".split()),
]


@pytest.fixture(scope="module")
def terms(spark):
    return spark.createDataFrame(DOCS, "doc_id bigint, title string, terms array<string>")


@pytest.fixture(scope="module")
def built(terms):
    return matrix.build_matrix(terms, size=4)


def brute(size, min_df=2, min_tf=2):
    usable = [(i, t) for i, _, t in DOCS if len(t) > 1]
    tf, df = Counter(), Counter()
    for _, t in usable:
        tf.update(t)
        df.update(set(t))
    vocabulary = sorted((t for t in tf if df[t] >= min_df), key=lambda t: (-tf[t], t))[:size]
    entries, matrix_df = {}, Counter()
    for i, t in usable:
        for term, n in Counter(t).items():
            if term in vocabulary and n >= min_tf:
                entries[i, term] = n
                matrix_df[term] += 1
    idf = {t: math.log((len(usable) + 1) / (matrix_df[t] + 1)) for t in vocabulary}
    return vocabulary, tf, df, idf, {k: (n, n * idf[k[1]]) for k, n in entries.items()}


def test_vocabulary_and_weights(built):
    vocabulary, tf, df, idf, entries = brute(4)
    rows = built.vocabulary.orderBy("term_id").collect()
    assert [(r["term"], r["tf"], r["df"]) for r in rows] == [(t, tf[t], df[t]) for t in vocabulary]
    assert [r["idf"] for r in rows] == pytest.approx([idf[t] for t in vocabulary])
    found = {(r["doc_id"], r["term"]): (r["tf"], r["tfidf"]) for r in built.named_entries().collect()}
    assert found.keys() == entries.keys()
    for key, value in entries.items():
        assert found[key] == pytest.approx(value)
    assert built.n_documents == 5 and built.n_terms == 4


def test_documents_without_vocabulary_terms_keep_a_row(built):
    ids = {r["doc_id"] for r in built.vectors.select("doc_id").collect()}
    assert ids == {10, 11, 12, 13, 14}


def test_equals_spark_ml(spark, terms, built):
    usable = terms.where("size(terms) > 1")
    counter = CountVectorizer(inputCol="terms", outputCol="tf", minDF=2, minTF=2, vocabSize=4)
    model = counter.fit(usable)
    counts = model.transform(usable)
    weighed = IDF(inputCol="tf", outputCol="tfidf").fit(counts).transform(counts)
    expected = {}
    for row in weighed.collect():
        for i, value in zip(row["tfidf"].indices, row["tfidf"].values):
            expected[row["doc_id"], model.vocabulary[i]] = value
    found = {(r["doc_id"], r["term"]): r["tfidf"] for r in built.named_entries().collect()}
    assert found == pytest.approx(expected)


def test_second_path_has_no_minimum_counts(terms):
    built = matrix.build_matrix(terms, size=20000, min_df=1, min_tf=1)
    vocabulary, _, _, _, entries = brute(20000, 1, 1)
    assert built.n_terms == len(vocabulary)
    found = {(r["doc_id"], r["term"]): r["tfidf"] for r in built.named_entries().collect()}
    assert found == pytest.approx({k: v[1] for k, v in entries.items()})


def test_find_by_term(built):
    _, _, _, idf, _ = brute(4)
    rows = [tuple(r) for r in matrix.find_by_term(built, "b", 3).collect()]
    assert [r[0] for r in rows] == [11, 10, 12]
    assert [r[2] for r in rows] == pytest.approx([3 * idf["b"], 2 * idf["b"], 0])
    by_id = matrix.find_by_term(built, 1, 3).collect()
    assert [r["doc_id"] for r in by_id] == [11, 10, 12]
    assert matrix.find_by_term(built, "unknown").count() == 0
    assert matrix.find_by_term(built, 99).count() == 0


def test_top_terms_per_document(built):
    rows = matrix.top_terms_per_document(built, 2).where("doc_id = 10").orderBy("rank").collect()
    assert [(r["rank"], r["term"], r["tf"]) for r in rows] == [(1, "a", 3.0), (2, "b", 2.0)]


def test_graph(built):
    nodes = {r["id"]: r["label"] for r in matrix.graph_nodes(built).collect()}
    assert nodes["d10"] == "d10" and nodes["t0"] == "a" and len(nodes) == 9
    edges = matrix.graph_edges(built).collect()
    assert len(edges) == built.entries().count()
    assert all(e["src"] in nodes and e["dst"] in nodes for e in edges)


def test_saving(spark, built, tmp_path):
    models.save_matrix(built, str(tmp_path / "m"))
    back = models.load_matrix(spark, str(tmp_path / "m"))
    assert (back.n_documents, back.n_terms) == (built.n_documents, built.n_terms)
    assert sorted(back.named_entries().collect()) == sorted(built.named_entries().collect())
    assert sorted(back.vocabulary.collect()) == sorted(built.vocabulary.collect())


def test_row_ids_are_unique_and_fixed(spark):
    numbered = matrix.with_row_ids(spark.range(1000).toDF("n").repartition(7))
    first = [tuple(r) for r in numbered.collect()]
    assert len({i for i, _ in first}) == 1000
    assert sorted(first) == sorted(tuple(r) for r in numbered.collect())


def test_vocabulary_size_is_checked(terms):
    with pytest.raises(ValueError):
        matrix.fit_vocabulary(terms, 0)
    with pytest.raises(ValueError):
        matrix.build_matrix(terms.limit(0))


def dense(built):
    ids = sorted(r["doc_id"] for r in built.vectors.select("doc_id").collect())
    a = np.zeros((len(ids), built.n_terms))
    for r in built.entries().collect():
        a[ids.index(r["doc_id"]), r["term_id"]] = r["tfidf"]
    return ids, a
