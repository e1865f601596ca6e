"""Questions on a topic model: words, documents and terms of topics, topics of documents and terms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termscape.operators.relevance import top_scores, unit_queries
from termscape.operators.svd import ranked_words, titled
from termscape.operators.topics import TopicModel
from termscape.operators.topk import top_per_group


#: Topic weights are shares; they rank by this many digits.
WEIGHT_DIGITS = 6


def _falling(weight: str | Column) -> Column:
    """Weights that agree to ``WEIGHT_DIGITS`` digits are ties, which rank by id."""
    return F.desc(F.round(weight, WEIGHT_DIGITS))


def topic_totals(model: TopicModel) -> DataFrame:
    """``(topic, total)``: summed term weights of each topic, one row per topic."""
    return (
        model.topic_terms.select(F.posexplode("counts").alias("topic", "count"))
        .groupBy("topic")
        .agg(F.sum("count").alias("total"))
    )


def words_per_topic(model: TopicModel, n: int = 10, topics: int | None = None) -> DataFrame:
    """Heaviest words of each topic, or of the first ``topics``: ``(topic, rank, term, weight)``.

    The weight is the word's share of the topic.
    """
    rows = model.topic_terms.select("term_id", "term", F.posexplode("counts").alias("topic", "count"))
    if topics is not None and topics > 0:
        rows = rows.where(F.col("topic") < topics)
    shares = rows.join(F.broadcast(topic_totals(model)), "topic").select(
        "topic", "term_id", "term", (F.col("count") / F.col("total")).alias("weight")
    )
    best = top_per_group(shares, ["topic"], [_falling("weight"), F.col("term_id")], n)
    return best.select("topic", "rank", "term", "weight")


def topic_words(model: TopicModel, n: int = 10, separator: str = ", ") -> DataFrame:
    """Heaviest words of each topic as one string: ``(topic, words)``."""
    return ranked_words(words_per_topic(model, n), "topic", separator)


def topic_labels(model: TopicModel, n: int = 10) -> DataFrame:
    """``(topic, label, line)``: words joined by "-", and as a report line."""
    words = topic_words(model, n, "-")
    line = F.concat(F.lit("TOPIC "), "topic", F.lit(": "), F.replace("words", F.lit("-"), F.lit(", ")))
    return words.select("topic", F.col("words").alias("label"), line.alias("line"))


def topic_table(model: TopicModel, n: int = 5) -> DataFrame:
    """One row per topic with its words in columns ``w1..wn``, for a CSV export."""
    ranked = words_per_topic(model, n)
    columns = [F.max(F.when(F.col("rank") == i, F.col("term"))).alias(f"w{i}")
               for i in range(1, n + 1)]
    return ranked.groupBy("topic").agg(*columns).orderBy("topic")


def topic_terms_json(
    model: TopicModel, n: int = 10, topics: int = -1, digits: int = 6
) -> DataFrame:
    """Words of the topics as one JSON array ``(json)`` of ``{"term", "probability", "topicId"}``,
    ordered by topic and rank. ``topics`` > 0 limits the number of topics."""
    ranked = words_per_topic(model, n, topics if topics > 0 else None)
    entry = F.struct(
        "term", F.round("weight", digits).alias("probability"), F.col("topic").alias("topicId")
    )
    # One row per topic and word: a few thousand short entries at most.
    ordered = F.sort_array(F.collect_list(F.struct("topic", "rank", entry.alias("entry"))))
    return ranked.agg(F.to_json(F.transform(ordered, lambda e: e["entry"])).alias("json"))


def document_topics(model: TopicModel) -> DataFrame:
    """``(doc_id, title, topic, weight)``."""
    return model.doc_topics.select("doc_id", "title", F.posexplode("weights").alias("topic", "weight"))


def _ranked_shares(weights: Column, n: int) -> Column:
    """Best ``n`` (topic, weight) of one document's weights, sorted inside its row."""
    pairs = F.transform(
        weights,
        lambda w, i: F.struct((-F.round(w, WEIGHT_DIGITS)).alias("key"), i.alias("topic"), w.alias("weight")),
    )
    return F.slice(F.sort_array(pairs), 1, n)


def _topics_of(documents: DataFrame, n: int) -> DataFrame:
    best = documents.select(
        "doc_id", "title", F.posexplode(_ranked_shares(F.col("weights"), n)).alias("at", "e")
    )
    return best.select("doc_id", "title", (F.col("at") + 1).alias("rank"), "e.topic", "e.weight")


def top_topics_for_document(model: TopicModel, doc_id: int, n: int = 10) -> DataFrame:
    """``(doc_id, title, rank, topic, weight)`` of one document; no rows for an unknown id."""
    return _topics_of(model.doc_topics.where(F.col("doc_id") == doc_id), n)


def top_topics_per_document(model: TopicModel, n: int = 10) -> DataFrame:
    """As ``top_topics_for_document`` for every document, without a shuffle."""
    return _topics_of(model.doc_topics, n)


def top_documents_for_topic(model: TopicModel, topic: int, n: int = 10) -> DataFrame:
    """``(rank, doc_id, title, weight)`` of the documents with the largest share of the topic."""
    best = (
        model.doc_topics.select("doc_id", "title", F.get("weights", F.lit(topic)).alias("weight"))
        .where(F.col("weight").isNotNull())
        .orderBy(_falling("weight"), "doc_id")
        .limit(n)
    )
    rank = F.row_number().over(Window.orderBy(_falling("weight"), "doc_id"))
    return best.select(rank.alias("rank"), "doc_id", "title", "weight")


def top_documents_per_topic(model: TopicModel, n: int = 10) -> DataFrame:
    """``(topic, rank, doc_id, title, weight)`` for every topic, in one pass."""
    topics = unit_queries(model.doc_topics.sparkSession, model.n_topics)
    hits = top_scores(model.doc_topics, "doc_id", "weights", topics, n).select(
        F.col("query").alias("topic"), "rank", F.col("id").alias("doc_id"),
        F.col("score").alias("weight"),
    )
    found = titled(hits, model.doc_topics.select("doc_id", "title"), model.n_topics * n)
    return found.select("topic", "rank", "doc_id", "title", "weight")


def top_topics_for_terms(model: TopicModel, terms: Sequence[str] | None = None) -> DataFrame:
    """Topics of each term by the model's weights: ``(term, rank, topic, weight)``.

    Without ``terms`` the whole vocabulary is answered; unknown terms have no rows.
    """
    rows = model.topic_terms
    if terms is not None:
        rows = rows.where(F.col("term").isin(list(terms)))
    long = rows.select("term", F.posexplode(_ranked_shares(F.col("counts"), model.n_topics))
                       .alias("at", "e"))
    return long.select("term", (F.col("at") + 1).alias("rank"), "e.topic", "e.weight")


def labelled(answers: DataFrame, model: TopicModel, n: int = 10, separator: str = "-") -> DataFrame:
    """Add the words of each answer's topic as ``label``; one row per topic is broadcast."""
    labels = topic_words(model, n, separator).withColumnRenamed("words", "label")
    return answers.join(F.broadcast(labels), "topic")
