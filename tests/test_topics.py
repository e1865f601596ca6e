"""Topic models and questions on them."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_matrix import dense

from termscape.operators import matrix, topic_queries, topics
from termscape.sources import models
from termscape.streaming import scoring

SUBJECTS = (["river", "water", "boat", "fish"], ["chip", "code", "byte", "disk"])


def subject_docs():
    random = np.random.default_rng(3)
    for doc in range(40):
        words = SUBJECTS[doc % 2]
        yield doc, f"t{doc}", " ".join(w for w in words for _ in range(random.integers(2, 7)))
    yield 99, "odd", "nothing here"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(list(subject_docs()), "doc_id bigint, title string, content string")


@pytest.fixture(scope="module")
def built(docs):
    from termscape.operators.terms import document_terms

    return matrix.build_matrix(document_terms(docs), size=8)


def em(a, ids, k, steps, alpha, eta):
    """The update written for a dense weight matrix."""
    n_docs, n_terms = a.shape
    g = np.zeros((n_docs, n_terms, k))
    for d in range(n_docs):
        for t in range(n_terms):
            g[d, t, (31 * ids[d] + 17 * t) % k] = a[d, t]
    for _ in range(steps):
        by_term, by_doc = g.sum(axis=0), g.sum(axis=1)
        u = (by_term[None] + eta - 1) * (by_doc[:, None] + alpha - 1)
        u = u / (by_term.sum(axis=0) + n_terms * (eta - 1))
        g = a[:, :, None] * u / u.sum(axis=2, keepdims=True)
    return g.sum(axis=0), g.sum(axis=1)


@pytest.fixture(scope="module")
def em_model(built):
    return topics.fit_em(built, 3, 4)


@pytest.mark.parametrize("limit", [1 << 25, 9, 0])  # 9: three terms of three topics
def test_em(built, monkeypatch, limit):
    monkeypatch.setattr(topics, "MAX_BROADCAST_ENTRIES", limit)
    model = topics.fit_em(built, 3, 4)
    ids, a = dense(built)
    by_term, by_doc = em(a, ids, 3, 4, 50 / 3 + 1, 1.1)
    found = {r["term_id"]: r["counts"] for r in model.topic_terms.collect()}
    assert np.allclose([found[t] for t in range(8)], by_term)
    shares = {r["doc_id"]: r["weights"] for r in model.doc_topics.collect()}
    used = [i for i, d in enumerate(ids) if a[i].any()]
    assert sorted(shares) == [ids[i] for i in used]
    expected = by_doc[used] / by_doc[used].sum(axis=1, keepdims=True)
    assert np.allclose([shares[ids[i]] for i in used], expected)


def test_em_does_not_move_the_entries_again(spark, built, monkeypatch):
    plans = []
    written = topics.frozen

    def spy(df, label, path=None):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return written(df, label, path)

    monkeypatch.setattr(topics, "frozen", spy)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for large tables
    try:
        topics.fit_em(built, 2, 1)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    above_entries = plans[-1].split("InMemoryTableScan")[0]
    assert "SortMergeJoin" in above_entries
    assert "Exchange" not in above_entries


@pytest.fixture(scope="module", params=["em", "online"])
def ml_model(request, built):
    # Weak priors: with the default ones documents this short barely leave the random start.
    doc, topic = (1.1, 1.1) if request.param == "em" else (0.1, 0.1)
    # The best of a few starts: the online optimizer may end in a mixture of the two subjects.
    seeds = range(1 if request.param == "em" else 3)
    fits = [topics.fit_lda(built, 2, 40, request.param, doc, topic, seed) for seed in seeds]
    best = max(fits, key=lambda model: model.fitted.logLikelihood(built.vectors))
    return request.param, best


def test_lda_separates_the_subjects(ml_model):
    _, model = ml_model
    words = {r["topic"]: set(r["words"].split(", ")) for r in topic_queries.topic_words(model, 4).collect()}
    assert sorted(map(sorted, words.values())) == sorted(map(sorted, SUBJECTS))


def test_shares_sum_to_one(ml_model, em_model):
    for model in (ml_model[1], em_model):
        total = F.aggregate("weights", F.lit(0.0), lambda s, x: s + x)
        assert model.doc_topics.where(F.abs(total - 1) > 1e-9).count() == 0


def test_quality(ml_model, built):
    row = topics.model_quality(ml_model[1].fitted, built).first()
    assert row["log_likelihood"] < 0 < row["log_perplexity"]


def test_saving(spark, ml_model, built, tmp_path):
    kind, model = ml_model
    path = str(tmp_path / "lda")
    models.save_topics(model, path)
    back = models.load_topics(spark, path, models.load_fitted(path, kind == "em"))
    assert back.n_topics == 2
    assert sorted(back.topic_terms.collect()) == sorted(model.topic_terms.collect())
    again = topics.score_documents(back.fitted, built.vectors)
    assert {r["doc_id"] for r in again.collect()} == {r["doc_id"] for r in model.doc_topics.collect()}
    with pytest.raises(Exception, match="exists"):
        models.save_topics(model, path)


def test_priors():
    assert topics.suggested_priors(50, 200) == (2.0, 2.0)
    assert topics.suggested_priors(50, 200, "online") == (1.0, 1.0)
    with pytest.raises(ValueError):
        topics.fit_lda(None, 2, 1, "em", doc_concentration=0.5)
    with pytest.raises(ValueError):
        topics.fit_lda(None, 2, 1, "gibbs")


def test_words_per_topic(em_model):
    counts = np.array([r["counts"] for r in em_model.topic_terms.orderBy("term_id").collect()])
    names = [r["term"] for r in em_model.topic_terms.orderBy("term_id").collect()]
    share = counts / counts.sum(axis=0)
    rows = topic_queries.words_per_topic(em_model, 3).where("topic = 1").orderBy("rank").collect()
    order = sorted(range(8), key=lambda t: (-round(share[t, 1], 6), t))[:3]
    assert [r["term"] for r in rows] == [names[t] for t in order]
    assert [r["weight"] for r in rows] == pytest.approx([share[t, 1] for t in order])
    first = topic_queries.words_per_topic(em_model, 3, topics=1).collect()
    assert {r["topic"] for r in first} == {0} and len(first) == 3


def test_document_questions(em_model):
    shares = {r["doc_id"]: r["weights"] for r in em_model.doc_topics.collect()}
    best = topic_queries.top_topics_for_document(em_model, 4, 2).orderBy("rank").collect()
    order = sorted(range(3), key=lambda t: (-round(shares[4][t], 6), t))
    assert [(r["topic"], r["weight"]) for r in best] == [(t, shares[4][t]) for t in order[:2]]
    assert topic_queries.top_topics_for_document(em_model, 12345).count() == 0
    assert topic_queries.top_topics_per_document(em_model, 1).count() == len(shares)

    for topic in range(3):
        order = sorted(shares, key=lambda d: (-round(shares[d][topic], 6), d))[:5]
        one = topic_queries.top_documents_for_topic(em_model, topic, 5).orderBy("rank").collect()
        assert [(r["rank"], r["doc_id"], r["title"]) for r in one] == [
            (i + 1, d, f"t{d}") for i, d in enumerate(order)
        ]
        every = topic_queries.top_documents_per_topic(em_model, 5).where(f"topic = {topic}")
        assert [r["doc_id"] for r in every.orderBy("rank").collect()] == order
    assert topic_queries.top_documents_for_topic(em_model, 77).count() == 0


def test_term_questions(em_model):
    counts = {r["term"]: r["counts"] for r in em_model.topic_terms.collect()}
    rows = topic_queries.top_topics_for_terms(em_model, ["river", "unknown"]).orderBy("rank").collect()
    order = sorted(range(3), key=lambda t: (-round(counts["river"][t], 6), t))
    assert [(r["term"], r["topic"], r["weight"]) for r in rows] == [
        ("river", t, counts["river"][t]) for t in order
    ]
    assert topic_queries.top_topics_for_terms(em_model).count() == 8 * 3


def test_labels_and_exports(em_model, tmp_path):
    words = {r["topic"]: r["words"] for r in topic_queries.topic_words(em_model, 3).collect()}
    for r in topic_queries.topic_labels(em_model, 3).collect():
        assert r["label"] == words[r["topic"]].replace(", ", "-")
        assert r["line"] == f"TOPIC {r['topic']}: {words[r['topic']]}"
    labelled = topic_queries.labelled(
        topic_queries.top_topics_for_terms(em_model, ["disk"]), em_model, 3
    ).collect()
    assert {(r["topic"], r["label"]) for r in labelled} == {
        (t, w.replace(", ", "-")) for t, w in words.items()
    }
    table = topic_queries.topic_table(em_model, 3)
    assert {r["topic"]: f"{r['w1']}, {r['w2']}, {r['w3']}" for r in table.collect()} == words
    table.write.csv(str(tmp_path / "topics"))

    entries = json.loads(topic_queries.topic_terms_json(em_model, 3, topics=2).first()["json"])
    assert [e["topicId"] for e in entries] == [0, 0, 0, 1, 1, 1]
    weights = {(r["topic"], r["term"]): r["weight"]
               for r in topic_queries.words_per_topic(em_model, 3).collect()}
    assert all(weights[e["topicId"], e["term"]] == pytest.approx(e["probability"], abs=1e-6) for e in entries)


def test_fold_in_by_em_holds_the_topics(spark, built, em_model):
    new = spark.createDataFrame(
        [(7, "n7", ["river", "river", "boat", "boat", "boat", "chip"]), (8, "n8", ["unknown"] * 3)],
        "doc_id bigint, title string, terms array<string>",
    )
    vectors = matrix.with_new_documents(built, new)
    found = {r["doc_id"]: r["weights"] for r in topics.score_em(em_model, vectors, 4).collect()}
    assert list(found) == [7]
    rows = {r["term"]: r for r in built.vocabulary.collect()}
    by_term = np.array([r["counts"] for r in em_model.topic_terms.orderBy("term_id").collect()])
    weights = {rows["river"]["term_id"]: 2 * rows["river"]["idf"],
               rows["boat"]["term_id"]: 3 * rows["boat"]["idf"]}
    g = {t: np.eye(3)[(31 * 7 + 17 * t) % 3] * w for t, w in weights.items()}
    for _ in range(4):
        mine = sum(g.values())
        u = {t: (by_term[t] + 0.1) * (mine + 50 / 3) / (by_term.sum(axis=0) + 8 * 0.1) for t in g}
        g = {t: weights[t] * u[t] / u[t].sum() for t in g}
    assert found[7] == pytest.approx(sum(g.values()) / sum(weights.values()))


def test_new_documents_in_batch_and_stream(spark, docs, built, tmp_path):
    model = topics.fit_lda(built, 2, 20)
    stages = scoring.scoring_stages(built, model.fitted)
    batch = {r["doc_id"]: r["weights"] for r in scoring.topic_shares(docs, stages).collect()}
    known = {r["doc_id"]: r["weights"] for r in model.doc_topics.collect()}
    for doc_id, weights in known.items():
        assert batch[doc_id] == pytest.approx(weights, abs=1e-6)

    docs.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(docs.schema).parquet(str(tmp_path / "in"))
    run = (
        scoring.topic_shares(stream, stages).writeStream.format("parquet")
        .option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "progress"))
        .trigger(availableNow=True).start()
    )
    run.awaitTermination()
    scored = {r["doc_id"]: r["weights"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert scored.keys() == batch.keys()
    for doc_id, weights in scored.items():
        assert weights == pytest.approx(batch[doc_id], abs=1e-6)


def test_running_counts_over_several_batches(spark, docs, tmp_path):
    from termscape.operators.stats import term_frequency
    from termscape.operators.terms import document_terms

    docs.repartition(4).write.parquet(str(tmp_path / "in"))
    stream = (
        spark.readStream.schema(docs.schema).option("maxFilesPerTrigger", 1)
        .parquet(str(tmp_path / "in"))
    )
    latest = {}

    def keep(batch, _):
        latest.update({r["term"]: r["tf"] for r in batch.collect()})

    run = (
        scoring.running_term_counts(stream).writeStream.outputMode("update").foreachBatch(keep)
        .option("checkpointLocation", str(tmp_path / "progress"))
        .trigger(availableNow=True).start()
    )
    run.awaitTermination()
    expected = {r["term"]: r["tf"] for r in term_frequency(document_terms(docs)).collect()}
    assert latest == expected
