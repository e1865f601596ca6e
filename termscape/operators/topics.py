"""Topic models (latent Dirichlet allocation) on the document-term matrix.

``fit_lda`` is Spark ML's LDA. ``fit_em`` runs the same EM update as joins and sums from a start that
the ids fix, so that two runs, or two engines, agree on every number.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.clustering import LDA, LDAModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termscape.operators.matrix import TermMatrix
from termscape.session import frozen, scratch_path, shared_folder

#: Entries of the term-topic table (256 MB of doubles) that are broadcast at most.
MAX_BROADCAST_ENTRIES = 1 << 25

#: Entries of the term-topic matrix (1 GB of doubles) that Spark's model may hand to the driver.
MAX_MODEL_ENTRIES = 1 << 27


@dataclass(frozen=True)
class TopicModel:
    """A fitted topic model as tables.

    ``topic_terms(term_id, term, counts array)``: weight of every topic for a term, as fitted (the
    EM models give expected counts). ``doc_topics(doc_id, title, weights array)``: topic shares of a
    document, which sum to 1.
    """

    n_topics: int
    topic_terms: DataFrame
    doc_topics: DataFrame
    fitted: LDAModel | None = None


def suggested_priors(n_topics: int, n_terms: int, optimizer: str = "em") -> tuple[float, float]:
    """Usual concentrations: 50/k for documents and 200/n for topics, plus 1 each for EM."""
    shift = 1.0 if optimizer == "em" else 0.0
    return 50.0 / n_topics + shift, 200.0 / n_terms + shift


def _check_priors(optimizer: str, doc: float | None, topic: float | None) -> None:
    if optimizer not in ("em", "online"):
        raise ValueError(f"optimizer must be 'em' or 'online', not {optimizer!r}")
    least = 1.0 if optimizer == "em" else 0.0
    for name, value in (("doc_concentration", doc), ("topic_concentration", topic)):
        too_small = value is not None and (value <= least if optimizer == "em" else value < least)
        if too_small:
            raise ValueError(f"{name} must be above {least} for {optimizer}, not {value}")


def fit_lda(
    matrix: TermMatrix,
    n_topics: int = 100,
    max_iter: int = 100,
    optimizer: str = "em",
    doc_concentration: float | None = None,
    topic_concentration: float | None = None,
    seed: int = 1,
    features: str = "tfidf",
) -> TopicModel:
    """Fit Spark ML's LDA and lay the result out as tables. ``None`` leaves a prior to Spark."""
    _check_priors(optimizer, doc_concentration, topic_concentration)
    shared_folder(matrix.vectors.sparkSession)  # the iterations checkpoint there
    lda = LDA(
        k=n_topics, maxIter=max_iter, optimizer=optimizer, seed=seed, featuresCol=features,
        checkpointInterval=10, optimizeDocConcentration=True,
    )
    if doc_concentration is not None:
        lda = lda.setDocConcentration([doc_concentration])
    if topic_concentration is not None:
        lda = lda.setTopicConcentration(topic_concentration)
    vectors = matrix.vectors.select("doc_id", "title", features).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        fitted = lda.fit(vectors)
    finally:
        vectors.unpersist()
    return topic_model(fitted, matrix)


def topic_model(fitted: LDAModel, matrix: TermMatrix) -> TopicModel:
    """Tables of a fitted or loaded Spark ML model."""
    spark = matrix.vectors.sparkSession
    if fitted.vocabSize() * fitted.getK() > MAX_MODEL_ENTRIES:
        raise ValueError(f"{fitted.vocabSize()} terms x {fitted.getK()} topics do not fit on the driver")
    weights = fitted.topicsMatrix().toArray()
    counts = spark.createDataFrame(pa.table({
        "term_id": pa.array(np.arange(len(weights), dtype=np.int32)), "counts": pa.array(list(weights)),
    }))
    names = matrix.vocabulary.select("term_id", "term")
    return TopicModel(
        weights.shape[1],
        names.join(counts, "term_id").select("term_id", "term", "counts"),
        score_documents(fitted, matrix.vectors),
        fitted,
    )


def scoring_model(fitted: LDAModel) -> LDAModel:
    """The model that scores documents: a distributed one as a local one with the seed of its fit.

    Inference starts at random; left to itself, a distributed model draws another seed whenever it is loaded.
    """
    if not fitted.isDistributed():
        return fitted
    local = fitted.toLocal().setFeaturesCol(fitted.getFeaturesCol()).setSeed(fitted.getSeed())
    return local.setTopicDistributionCol(fitted.getTopicDistributionCol())


def score_documents(fitted: LDAModel, vectors: DataFrame) -> DataFrame:
    """Topic shares of documents, also of documents the model has not seen."""
    return scoring_model(fitted).transform(vectors).select(
        "doc_id", "title", vector_to_array("topicDistribution").alias("weights")
    )


def model_quality(fitted: LDAModel, matrix: TermMatrix) -> DataFrame:
    """``(log_likelihood, log_perplexity)`` bounds of the corpus."""
    spark = matrix.vectors.sparkSession
    row = (float(fitted.logLikelihood(matrix.vectors)), float(fitted.logPerplexity(matrix.vectors)))
    return spark.createDataFrame([row], "log_likelihood double, log_perplexity double")


def _summed(column: str) -> Column:
    """Sum of an array column, place by place, aggregated in part before the shuffle."""
    return vector_to_array(Summarizer.sum(array_to_vector(column)))


def _sums(rows: DataFrame, key: str, name: str) -> DataFrame:
    """Sum the topic counts ``g`` of entries by key."""
    return rows.groupBy(key).agg(_summed("g").alias(name))


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, x: total + x)


def _entries(matrix: TermMatrix, features: str) -> DataFrame:
    """Entries (doc_id, term_id, weight), kept partitioned and sorted by document."""
    partitions = int(matrix.vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        matrix.entries()
        .select("doc_id", "term_id", F.col(features).alias("weight"))
        .repartition(partitions, "doc_id")
        .sortWithinPartitions("doc_id")
        .persist(StorageLevel.MEMORY_AND_DISK)
    )


def _start(entries: DataFrame, n_topics: int) -> DataFrame:
    """Every entry wholly in topic (31 doc_id + 17 term_id) mod k."""
    topic = F.pmod(31 * F.col("doc_id") + 17 * F.col("term_id"), F.lit(n_topics))
    numbers = F.sequence(F.lit(0), F.lit(n_topics - 1))
    return entries.select(
        "doc_id", "term_id",
        F.transform(numbers, lambda j: F.when(topic == j, F.col("weight")).otherwise(0.0)).alias("g"),
    )


def _expected(
    entries: DataFrame, by_document: DataFrame, by_term: DataFrame, n_terms: int, n_topics: int,
    alpha: float, eta: float,
) -> DataFrame:
    """Weight of every entry split over the topics in proportion to

        (term count + eta - 1) (document count + alpha - 1) / (topic count + n (eta - 1)).

    Topic totals are k numbers. As many terms as may be broadcast are; term ids rank by frequency, so
    what is left to shuffle by term are the rare ones, and no term weighs on one task.
    """
    totals = by_term.agg(_summed("t")).first()[0]
    below = F.array(*(F.lit(x + n_terms * (eta - 1)) for x in totals))
    above = F.zip_with("t", "d", lambda t, d: (t + (eta - 1)) * (d + (alpha - 1)))
    joined = entries.join(by_document, "doc_id")
    frequent = MAX_BROADCAST_ENTRIES // n_topics
    if n_terms <= frequent:
        joined = joined.join(F.broadcast(by_term), "term_id")
    else:
        common = F.col("term_id") < frequent
        joined = joined.where(common).join(F.broadcast(by_term.where(common)), "term_id").unionByName(
            joined.where(~common).join(by_term.where(~common), "term_id")
        )
    share = F.zip_with(above, below, lambda x, y: x / y)
    unscaled = joined.select("doc_id", "term_id", "weight", share.alias("u"))
    scaled = unscaled.withColumn("scale", F.col("weight") / _total(F.col("u")))
    return scaled.select(
        "doc_id", "term_id", F.transform("u", lambda x: x * F.col("scale")).alias("g")
    )


def _document_shares(by_document: DataFrame, titles: DataFrame) -> DataFrame:
    known = by_document.withColumn("total", _total(F.col("d"))).where("total > 0")
    shares = F.transform("d", lambda x: x / F.col("total"))
    return titles.join(known, "doc_id").select("doc_id", "title", shares.alias("weights"))


def _em_priors(
    n_topics: int, doc_concentration: float | None, topic_concentration: float
) -> tuple[float, float]:
    alpha = 50.0 / n_topics + 1.0 if doc_concentration is None else doc_concentration
    _check_priors("em", alpha, topic_concentration)
    return alpha, topic_concentration


def fit_em(
    matrix: TermMatrix,
    n_topics: int = 100,
    steps: int = 100,
    doc_concentration: float | None = None,
    topic_concentration: float = 1.1,
    features: str = "tfidf",
) -> TopicModel:
    """LDA by expectation maximization on the entries (document, term, weight) of the matrix.

    One step splits every entry over the topics (``_expected``) and sums the parts by term and by
    document. Entries stay partitioned by document, so per step only one row per document and per
    term moves; the sums are written down, which keeps plans short and survives lost executors.
    """
    alpha, eta = _em_priors(n_topics, doc_concentration, topic_concentration)
    spark = matrix.vectors.sparkSession
    # A step reads one slot and writes the other, so only two states take up space.
    slots = [scratch_path(spark, f"em-{slot}") for slot in ("even", "odd")]

    def summed(rows: DataFrame, step: int) -> tuple[DataFrame, DataFrame]:
        path = slots[step % 2]
        return (
            frozen(_sums(rows, "term_id", "t"), "em", f"{path}/terms"),
            frozen(_sums(rows, "doc_id", "d"), "em", f"{path}/documents"),
        )

    entries = _entries(matrix, features)
    try:
        by_term, by_document = summed(_start(entries, n_topics), 0)
        for step in range(1, steps + 1):
            rows = _expected(entries, by_document, by_term, matrix.n_terms, n_topics, alpha, eta)
            by_term, by_document = summed(rows, step)
    finally:
        entries.unpersist()

    names = matrix.vocabulary.select("term_id", "term")
    topic_terms = names.join(by_term, "term_id").select("term_id", "term", F.col("t").alias("counts"))
    return TopicModel(n_topics, topic_terms, _document_shares(by_document, matrix.titles))


def score_em(
    model: TopicModel,
    matrix: TermMatrix,
    steps: int = 20,
    doc_concentration: float | None = None,
    topic_concentration: float = 1.1,
    features: str = "tfidf",
) -> DataFrame:
    """Topic shares ``(doc_id, title, weights)`` of other documents with the words of the topics held
    fixed: the steps of ``fit_em`` on the documents alone.

    ``matrix`` has the model's vocabulary (see ``with_new_documents``). Documents without any of its
    terms have no shares.
    """
    n_topics = model.n_topics
    alpha, eta = _em_priors(n_topics, doc_concentration, topic_concentration)
    slots = [scratch_path(matrix.vectors.sparkSession, f"em-{slot}") for slot in ("even", "odd")]
    by_term = model.topic_terms.select("term_id", F.col("counts").alias("t"))
    entries = _entries(matrix, features)
    try:
        rows = _start(entries, n_topics)
        for step in range(steps + 1):
            if step:
                rows = _expected(
                    entries, by_document, by_term, matrix.n_terms, n_topics, alpha, eta
                )
            by_document = frozen(_sums(rows, "doc_id", "d"), "em", slots[step % 2])
    finally:
        entries.unpersist()
    return _document_shares(by_document, matrix.titles)
