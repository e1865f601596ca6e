"""Fitted models on document streams."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.clustering import LDAModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from termscape.operators.corpus_counts import count_delta
from termscape.operators.matrix import TermMatrix, feature_stages
from termscape.operators.terms import document_terms
from termscape.operators.topics import scoring_model
from termscape.sources.growing import GrowingTable


def scoring_stages(matrix: TermMatrix, fitted: LDAModel) -> PipelineModel:
    """Terms, features and topics of new documents, by the training corpus' own way from text to terms,
    with its vocabulary and weights. Can be saved and loaded like any Spark ML pipeline."""
    return PipelineModel(stages=[matrix.extractor, *feature_stages(matrix), scoring_model(fitted)])


def topic_shares(docs: DataFrame, stages: PipelineModel) -> DataFrame:
    """``docs(doc_id, title, content)``, batch or stream, to ``(doc_id, title, weights)``.

    Map-only, so a stream needs no state.
    """
    return stages.transform(docs).select(
        "doc_id", "title", vector_to_array("topicDistribution").alias("weights")
    )


def running_term_counts(docs: DataFrame) -> DataFrame:
    """Corpus counts ``(term, tf)`` of a document stream, for the update or complete output mode.

    The state has one row per distinct term; on a cluster keep it in the RocksDB state store
    (``spark.sql.streaming.stateStore.providerClass``).
    """
    return (
        document_terms(docs)
        .select(F.explode("terms").alias("term"))
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("tf"))
    )


def keep_counts(terms: DataFrame, counts: GrowingTable, min_terms: int = 2, min_tf: int = 2) -> DataStreamWriter:
    """Add every batch of a stream ``terms(doc_id, title, terms)`` to a stored table of ``corpus_counts.merge_counts``.

    There is no state in the stream; a batch that is run again changes nothing. Start the writer with a checkpoint.
    """
    return terms.writeStream.foreachBatch(
        lambda batch, number: counts.add(number, count_delta(batch, min_terms, min_tf))
    )
