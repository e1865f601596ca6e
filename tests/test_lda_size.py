"""The registered topic queries run on the whole vocabulary with topics of the usual number."""

from termscape.plans import queries

FOLDER = "/root/testdata/sf0.001"


def test_topic_queries_use_the_full_matrix(spark):
    full, model = queries.full_matrix(spark, FOLDER), queries.ml_topics(spark, FOLDER)
    assert full.n_terms > queries.SMALL_VOCABULARY
    assert model.topic_terms.count() == full.n_terms == model.fitted.vocabSize()
    assert model.n_topics == queries.LDA_TOPICS == queries.lda_ml_em(spark, FOLDER).select("topic").distinct().count()
    assert queries.lda_ml_online(spark, FOLDER).select("topic").distinct().count() == queries.LDA_TOPICS
    assert queries.fold_in(spark, FOLDER).select("topic").distinct().count() == queries.LDA_TOPICS
    assert queries.stream_score(spark, FOLDER).select("topic").distinct().count() == queries.LDA_TOPICS
    assert queries.lda_quality(spark, FOLDER).count() == 1
