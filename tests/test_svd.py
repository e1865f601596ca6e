"""Concept models and relevance questions against numpy."""

from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml.feature import ElementwiseProduct
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F
from test_matrix import dense

from termscape.operators import matrix, relevance, svd
from termscape.sources import models

WORDS = [f"w{i:02d}" for i in range(12)]


@pytest.fixture(scope="module")
def built(spark):
    random = np.random.default_rng(5)
    docs = []
    for doc in range(60):
        favourites = random.choice(12, 4, replace=False)
        counts = random.integers(2, 9, 4)
        docs.append((doc, f"t{doc}", [WORDS[w] for w, n in zip(favourites, counts) for _ in range(n)]))
    docs += [(100 + i, f"copy{i}", docs[0][2]) for i in range(30)]  # copies: a third of the corpus
    docs.append((200, "zero", ["rare1", "rare2"]))
    terms = spark.createDataFrame(docs, "doc_id bigint, title string, terms array<string>")
    return matrix.build_matrix(terms, size=12)


@pytest.fixture(scope="module")
def a(built):
    return dense(built)


@pytest.fixture(scope="module")
def model(built):
    return svd.fit_concepts(built, 5)


@pytest.fixture(scope="module")
def truncated(a):
    u, s, vt = np.linalg.svd(a[1], full_matrices=False)
    v = vt[:5].T
    v = v * np.sign(v[np.argmax(np.abs(np.round(v, 9)), axis=0), np.arange(5)])
    return s[:5], v, a[1] @ v


def table(df, key, column):
    return {r[key]: np.array(r[column]) for r in df.collect()}


def test_factors(model, truncated, a):
    s, v, us = truncated
    assert model.sigmas == pytest.approx(list(s))
    found = table(model.term_factors, "term_id", "v")
    assert np.allclose([found[i] for i in range(12)], v, atol=1e-8)
    scaled = table(model.term_factors, "term_id", "vs")
    assert np.allclose([scaled[i] for i in range(12)], v * s, atol=1e-7)
    documents = table(model.doc_factors, "doc_id", "us")
    assert np.allclose([documents[i] for i in a[0]], us, atol=1e-7)


@pytest.mark.parametrize("n_terms, k", [(99, 8), (100, 8), (140, 8), (140, 90)])
def test_one_path_for_all_sizes(spark, n_terms, k):
    """Vocabularies that the solver treats in its own ways, against numpy."""
    random = np.random.default_rng(n_terms)
    words = [f"w{i:03d}" for i in range(n_terms)]
    shares = 1 / np.arange(1, n_terms + 1)
    docs = [
        (doc, f"t{doc}", [words[w] for w in random.choice(n_terms, 60, p=shares / shares.sum())] + words * (doc % 3))
        for doc in range(220)
    ]
    terms = spark.createDataFrame(docs, "doc_id bigint, title string, terms array<string>")
    built = matrix.build_matrix(terms, size=n_terms, min_tf=1)
    entries = dense(built)[1]
    _, sigma, vt = np.linalg.svd(entries, full_matrices=False)
    model = svd.fit_concepts(built, k)
    rank = int((sigma > 1e-9 * sigma[0]).sum())
    assert model.sigmas == pytest.approx(list(sigma[: min(k, rank)]), rel=1e-6)
    v = np.array([r["v"] for r in model.term_factors.orderBy("term_id").collect()])
    # the first directions stand apart from the rest; later ones may turn within nearly equal sigmas
    assert np.allclose(np.abs(np.sum(v[:, :3] * vt[:3].T, axis=0)), 1, atol=1e-5)


def test_matrix_without_entries(spark):
    """Terms that every document holds have no weight, and a matrix of them no concept."""
    docs = [(i, f"t{i}", ["one", "two"] * 3) for i in range(4)]
    terms = spark.createDataFrame(docs, "doc_id bigint, title string, terms array<string>")
    built = matrix.build_matrix(terms, size=2)
    flat = replace(built, vectors=ElementwiseProduct(
        scalingVec=Vectors.dense([0.0, 0.0]), inputCol="tf", outputCol="none"
    ).transform(built.vectors).drop("tfidf").withColumnRenamed("none", "tfidf"))
    model = svd.fit_concepts(flat, 2)
    assert model.sigmas == []
    assert model.doc_factors.count() == 4


def test_k_is_checked(built, monkeypatch):
    with pytest.raises(ValueError):
        svd.fit_concepts(built, 13)
    monkeypatch.setattr(svd, "MAX_FACTOR_ENTRIES", 10)
    with pytest.raises(ValueError):
        svd.fit_concepts(built, 5)


def ranked(scores, ids, k):
    """(rank, id, score) by rounded score, then id."""
    order = sorted(zip(np.round(scores, 6) + 0.0, ids), key=lambda p: (-p[0], p[1]))[:k]
    return [(i + 1, doc, score) for i, (score, doc) in enumerate(order)]


def answers(df, key, value, id_col="doc_id"):
    rows = df.where(df[key] == value).orderBy("rank").collect()
    return [(r["rank"], r[id_col], r["score"]) for r in rows]


def same(found, expected):
    assert [f[:2] for f in found] == [e[:2] for e in expected]
    assert [f[2] for f in found] == pytest.approx([e[2] for e in expected], abs=2e-6)


def test_concept_reports(model, truncated, a):
    s, v, us = truncated
    terms = svd.concept_terms(model, n=3).where("concept = 1").orderBy("rank").collect()
    expected = ranked(v[:, 1], range(12), 3)
    names = {r["term_id"]: r["term"] for r in model.term_factors.collect()}
    assert [r["term"] for r in terms] == [names[e[1]] for e in expected]
    words = {r["concept"]: r["words"] for r in svd.concept_words(model, 3).collect()}
    assert words[1] == ", ".join(names[e[1]] for e in expected)
    best = svd.top_terms_for_concept(model, 1, 3).collect()
    assert [r["term_id"] for r in best] == [e[1] for e in expected]

    for concept in range(3):
        expected = ranked(us[:, concept], a[0], 4)
        one = svd.top_documents_for_concept(model, concept, 4).collect()
        assert [r["doc_id"] for r in one] == [e[1] for e in expected]
        assert [r["weight"] for r in one] == pytest.approx([e[2] / s[concept] for e in expected], abs=1e-6)
        every = relevance.concept_documents(model, 3, 4).where(f"concept = {concept}").orderBy("rank")
        assert [r["doc_id"] for r in every.collect()] == [e[1] for e in expected]
    assert svd.top_documents_for_concept(model, 99).count() == 0
    assert svd.top_terms_for_concept(model, 99).count() == 0


@pytest.mark.parametrize("limit, part", [(1 << 22, 1 << 22), (12, 1 << 22), (12, 40)])
def test_docs_for_terms(model, truncated, a, monkeypatch, limit, part):
    monkeypatch.setattr(relevance, "MAX_QUERY_ENTRIES", limit)  # 12: queries are met with parts
    monkeypatch.setattr(relevance, "PART_ENTRIES", part)
    _, v, us = truncated
    names = {r["term"]: r["term_id"] for r in model.term_factors.collect()}
    found = relevance.docs_for_terms(model, k=7)
    assert found.count() == 12 * 7
    for term in WORDS[:4]:
        same(answers(found, "term", term), ranked(us @ v[names[term]], a[0], 7))
    assert relevance.docs_for_terms(model, ["unknown"]).count() == 0


def cosines(rows, row):
    lengths = np.linalg.norm(rows, axis=1)
    return rows @ row / (lengths * np.linalg.norm(row))


def test_terms_for_terms(model, truncated):
    s, v, _ = truncated
    ids = {r["term"]: r["term_id"] for r in model.term_factors.collect()}
    names = {i: t for t, i in ids.items()}
    found = relevance.terms_for_terms(model, WORDS[:3], k=12)
    for term in WORDS[:3]:
        expected = ranked(cosines(v * s, (v * s)[ids[term]]), range(12), 12)
        same(answers(found, "term", term, "related"), [(r, names[i], c) for r, i, c in expected])
        assert expected[0][1] == ids[term]


def test_docs_for_docs(model, truncated, a):
    us = truncated[2]
    kept = [i for i, doc in enumerate(a[0]) if doc != 200]
    found = relevance.docs_for_docs(model, doc_ids=[0, 3, 200], k=40)
    for doc in (0, 3):
        same(answers(found, "query_id", doc),
             ranked(cosines(us[kept], us[a[0].index(doc)]), [a[0][i] for i in kept], 40))
    assert found.where("query_id = 200 OR doc_id = 200").count() == 0
    by_title = relevance.docs_for_docs(model, titles=["t3"], k=40)
    same(answers(by_title, "query_id", 3), answers(found, "query_id", 3))
    assert {r["title"] for r in found.where("query_id = 0 AND rank <= 31").collect()} == {
        "t0", *(f"copy{i}" for i in range(30))
    }
    with pytest.raises(ValueError):
        relevance.docs_for_docs(model)


def test_docs_for_queries(spark, built, model, truncated, a):
    asked = spark.createDataFrame(
        [(1, "w00"), (1, "w05"), (1, "w00"), (1, "nowhere"), (2, "w03"), (3, "nowhere")],
        "query_id int, term string",
    )
    weighed, unknown = relevance.query_terms(asked, built.vocabulary)
    assert sorted(tuple(r) for r in unknown.collect()) == [(1, "nowhere"), (3, "nowhere")]
    idf = {r["term"]: (r["term_id"], r["idf"]) for r in built.vocabulary.collect()}
    found = relevance.docs_for_queries(model, weighed, k=9)
    _, v, us = truncated
    for query, terms in ((1, ("w00", "w05")), (2, ("w03",))):
        q = np.zeros(12)
        for term in terms:
            q[idf[term][0]] = idf[term][1]
        same(answers(found, "query_id", query), ranked(us @ (v.T @ q), a[0], 9))
    assert found.where("query_id = 3").count() == 0


def test_saving(spark, model, tmp_path):
    models.save_concepts(model, str(tmp_path / "svd"))
    back = models.load_concepts(spark, str(tmp_path / "svd"))
    assert back.sigmas == model.sigmas
    assert sorted(relevance.docs_for_terms(back, ["w01"]).collect()) == sorted(
        relevance.docs_for_terms(model, ["w01"]).collect()
    )


@pytest.mark.parametrize("scale", [1e-8, 1e8])
def test_ranks_do_not_depend_on_the_scale(built, model, scale):
    scaled = ElementwiseProduct(scalingVec=Vectors.dense([scale] * built.n_terms), inputCol="plain", outputCol="tfidf")
    vectors = scaled.transform(built.vectors.withColumnRenamed("tfidf", "plain")).drop("plain")
    other = svd.fit_concepts(replace(built, vectors=vectors), 5)
    assert other.sigmas == pytest.approx([s * scale for s in model.sigmas])
    ids = [0, 7, 100, 200]

    def ranks(m):
        return relevance.docs_for_docs(m, doc_ids=ids).select("query_id", "rank", "doc_id").collect()

    assert sorted(ranks(other)) == sorted(ranks(model))
    terms = ["w01", "w05"]

    def more_ranks(m):
        concepts = [relevance.concept_documents(m, 3, 7).select("concept", "rank", "doc_id").collect(), svd.top_documents_for_concept(m, 1, 9).select("rank", "doc_id").collect()]
        return [sorted(found) for found in (relevance.docs_for_terms(m, terms).select("term", "rank", "doc_id").collect(), *concepts)]

    assert more_ranks(other) == more_ranks(model)
    related = [sorted(relevance.terms_for_terms(m).select("term", "rank", "related").collect()) for m in (other, model)]
    assert related[0] == related[1]


def test_no_concepts_beyond_the_rank(spark):
    docs = [(i, f"t{i}", ["aa", "aa", "bb", "bb"] if i % 2 else ["cc", "cc", "dd", "dd"]) for i in range(9)]
    docs.append((20, "other", ["ee", "ee", "ff", "ff"]))
    built = matrix.build_matrix(spark.createDataFrame(docs, "doc_id bigint, title string, terms array<string>"), min_df=1)
    model = svd.fit_concepts(built, built.n_terms)
    assert len(model.sigmas) == 3
    us = np.array([r["us"] for r in model.doc_factors.collect()])
    assert np.sqrt((us * us).sum(0)) == pytest.approx(model.sigmas)


def test_many_queries_take_one_branch(spark, model, monkeypatch):
    every = model.titles.select("doc_id")
    small = relevance.docs_for_docs(model, doc_ids=every, k=9).collect()
    monkeypatch.setattr(relevance, "MAX_QUERIES", 5)
    monkeypatch.setattr(relevance, "PART_ENTRIES", 60)
    met = relevance.docs_for_docs(model, doc_ids=every, k=9)
    rows = sorted(met.collect())
    assert [r[:4] for r in rows] == [r[:4] for r in sorted(small)]
    assert [r["score"] for r in rows] == pytest.approx([r["score"] for r in sorted(small)])
    plan = met._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1
    many = spark.range(100_000).select((F.col("id") % 90).alias("doc_id"))
    assert relevance.docs_for_docs(model, doc_ids=many, k=2).count() == 2 * relevance.docs_for_docs(model, doc_ids=every, k=1).where("query_id < 90").count()
    named = relevance.docs_for_docs(model, titles=model.titles.where("doc_id = 7"), k=3).collect()
    assert {r["query_id"] for r in named} == {7}


def test_short_rows_are_not_read(spark, tmp_path):
    """Only the folders of long rows are there, and the answers are those of the whole table."""
    import shutil

    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=4) * 2.0 ** -(i // 20)).tolist()) for i in range(400)] + [(1000 + i, [0.0] * 4) for i in range(5)]
    longest = max(np.linalg.norm(v) for _, v in rows)
    table = spark.createDataFrame(rows, "doc_id bigint, us array<double>")
    path = str(tmp_path / "rows")
    buckets = svd._by_length(table, longest, path)
    assert sum(buckets.values()) == len(rows) and len(buckets) > 20
    questions = spark.createDataFrame([(q, rng.normal(size=4).tolist()) for q in range(3)], "query int, vector array<double>")
    expected = sorted(relevance.top_scores(table, "doc_id", "us", questions, 6).collect())
    known = relevance.Lengths(longest, buckets)
    stored = spark.read.schema(svd.DOC_FACTORS_SCHEMA).parquet(path)
    assert sorted(relevance.top_scores(stored, "doc_id", "us", questions, 6, known=known).collect()) == expected
    least = min(r["score"] / np.linalg.norm(v["vector"]) / longest for v in questions.collect() for r in expected if r["query"] == v["query"])
    kept = {*known.first(6), *known.rest(known.first(6), least)}
    assert 1 < len(kept) < len(buckets) / 2
    for bucket in set(buckets) - kept:
        shutil.rmtree(f"{path}/bucket={bucket}")
    stored = spark.read.schema(svd.DOC_FACTORS_SCHEMA).parquet(path)
    assert sorted(relevance.top_scores(stored, "doc_id", "us", questions, 6, known=known).collect()) == expected
    # more rows than there are, and questions without a direction
    assert relevance.top_scores(table, "doc_id", "us", questions.limit(1), 1000, known=relevance.Lengths(longest)).count() == len(rows)
