"""Saving and loading matrices and models as parquet tables.

A save is complete when its manifest is there, which is written last: names, row counts and schemas of its
tables. Loading refuses a folder without one.
"""

from __future__ import annotations

import json

from pyspark.ml.clustering import DistributedLDAModel, LDAModel, LocalLDAModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from termscape.operators.matrix import TermMatrix, graph_edges, graph_nodes
from termscape.operators.preprocessing import TermExtractor
from termscape.operators.svd import DOC_FACTORS_SCHEMA, ConceptModel
from termscape.operators.topics import TopicModel
from termscape.session import folders


MANIFEST_SCHEMA = "name string, rows bigint, schema string"


class UnfinishedSave(ValueError):
    """The folder holds no complete save."""


def _write(path: str, **tables: DataFrame) -> None:
    for name, table in tables.items():
        table.write.mode("errorifexists").parquet(f"{path}/{name}")


def _finish(spark: SparkSession, path: str, *names: str) -> None:
    """The manifest of the tables. Row counts are read from the files' footers."""
    rows = []
    for name in names:
        table = spark.read.parquet(f"{path}/{name}")
        rows.append((name, table.count(), table.schema.json()))
    made = spark.createDataFrame(rows, MANIFEST_SCHEMA).coalesce(1)
    made.write.mode("errorifexists").parquet(f"{path}/manifest")


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """``(name, rows, schema)`` of the tables of a save."""
    if "manifest" not in folders(spark, path, marked="_SUCCESS"):
        raise UnfinishedSave(f"no complete save in {path}")
    return spark.read.schema(MANIFEST_SCHEMA).parquet(f"{path}/manifest")


def opened(spark: SparkSession, path: str, *names: str) -> list[DataFrame]:
    """Tables of a complete save, with the schemas they were written with."""
    held = {row["name"]: row["schema"] for row in manifest(spark, path).collect()}
    missing = set(names) - set(held)
    if missing:
        raise UnfinishedSave(f"{path} is a save without {sorted(missing)}")
    return [spark.read.schema(StructType.fromJson(json.loads(held[name]))).parquet(f"{path}/{name}") for name in names]


def check_rows(spark: SparkSession, path: str) -> None:
    """Refuses a save whose tables lost or gained rows since it was written; reads the files' footers only."""
    for row in manifest(spark, path).collect():
        found = spark.read.parquet(f"{path}/{row['name']}").count()
        if found != row["rows"]:
            raise UnfinishedSave(f"{path}/{row['name']} has {found} rows, was saved with {row['rows']}")


def save_matrix(matrix: TermMatrix, path: str) -> None:
    size = matrix.vectors.sparkSession.createDataFrame(
        [(matrix.n_documents, matrix.n_terms, matrix.min_tf)], "n_documents bigint, n_terms int, min_tf int"
    )
    _write(path, vectors=matrix.vectors, vocabulary=matrix.vocabulary, size=size)
    matrix.extractor.write().save(f"{path}/extractor")
    _finish(matrix.vectors.sparkSession, path, "vectors", "vocabulary", "size")


def load_matrix(spark: SparkSession, path: str) -> TermMatrix:
    """Rows carry their ids, so nothing depends on the order of files."""
    vectors, vocabulary, sizes = opened(spark, path, "vectors", "vocabulary", "size")
    size = sizes.first()
    return TermMatrix(
        vectors,
        vocabulary,
        size["n_documents"],
        size["n_terms"],
        size["min_tf"],
        TermExtractor.load(f"{path}/extractor"),
    )


def save_graph(matrix: TermMatrix, path: str) -> None:
    """The document-term graph as tables of nodes and edges."""
    _write(path, nodes=graph_nodes(matrix), edges=graph_edges(matrix))
    _finish(matrix.vectors.sparkSession, path, "nodes", "edges")


def save_concepts(model: ConceptModel, path: str) -> None:
    """Tables of the model; document factors keep their folders by length."""
    spark = model.concepts.sparkSession
    sizes = spark.createDataFrame([(model.longest, model.buckets)], "longest double, buckets map<int,bigint>")
    _write(path, concepts=model.concepts, term_factors=model.term_factors, titles=model.titles, sizes=sizes)
    model.doc_factors.hint("rebalance", "bucket").write.mode("errorifexists").partitionBy("bucket").parquet(f"{path}/doc_factors")
    _finish(spark, path, "concepts", "term_factors", "doc_factors", "titles", "sizes")


def load_concepts(spark: SparkSession, path: str) -> ConceptModel:
    concepts, term_factors, titles, found = opened(spark, path, "concepts", "term_factors", "titles", "sizes")
    sizes = found.first()
    return ConceptModel(
        concepts, term_factors, spark.read.schema(DOC_FACTORS_SCHEMA).parquet(f"{path}/doc_factors"), titles,
        sizes["longest"], sizes["buckets"],
    )


def save_topics(model: TopicModel, path: str) -> None:
    """Tables of the model and, if Spark ML fitted it, the model itself. Fails if they exist."""
    _write(path, topic_terms=model.topic_terms, doc_topics=model.doc_topics)
    if model.fitted is not None:
        model.fitted.write().save(f"{path}/fitted")
    _finish(model.topic_terms.sparkSession, path, "topic_terms", "doc_topics")


def load_fitted(path: str, distributed: bool = True) -> LDAModel:
    """The saved Spark ML model: ``distributed`` for one fitted by EM, otherwise a local one."""
    return (DistributedLDAModel if distributed else LocalLDAModel).load(f"{path}/fitted")


def load_topics(spark: SparkSession, path: str, fitted: LDAModel | None = None) -> TopicModel:
    topic_terms, doc_topics = opened(spark, path, "topic_terms", "doc_topics")
    n_topics = len(topic_terms.select("counts").first()["counts"])
    return TopicModel(n_topics, topic_terms, doc_topics, fitted)
