"""Vocabulary, document-term matrix and TF-IDF weights."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.feature import IDF, CountVectorizerModel, ElementwiseProduct
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termscape.operators.filters import with_min_terms
from termscape.operators.preprocessing import TermExtractor
from termscape.operators.stats import term_profile
from termscape.session import frozen

#: Largest vocabulary that may become a model object on the driver (Spark's own default size).
MAX_VOCABULARY = 1 << 18

VOCABULARY_SCHEMA = "term_id int, term string, tf bigint, df bigint, matrix_df bigint, idf double"


@dataclass(frozen=True)
class TermMatrix:
    """A document-term matrix.

    ``vectors(doc_id, title, tf, tfidf)`` holds one sparse row per document, also for documents
    without any vocabulary term. ``n_documents`` is the number of documents the weights are based
    on. ``vocabulary(term_id, term, tf, df, matrix_df, idf)`` has at most
    ``MAX_VOCABULARY`` rows: ``tf`` and ``df`` count the corpus, ``matrix_df`` the documents with a
    non-zero entry, which is what ``idf`` is based on. ``min_tf`` is the count threshold of the
    entries, which other documents must be held to as well, and ``extractor`` the way from their text to terms.
    """

    vectors: DataFrame
    vocabulary: DataFrame
    n_documents: int
    n_terms: int
    min_tf: int = 2
    extractor: TermExtractor = field(default_factory=TermExtractor)

    @property
    def titles(self) -> DataFrame:
        return self.vectors.select("doc_id", "title")

    def entries(self, *keys: str) -> DataFrame:
        """Non-zero entries ``(doc_id, term_id, tf, tfidf)``, unpacked inside the map task.

        ``keys`` names the row columns to keep instead of ``doc_id``.
        """
        keys = keys or ("doc_id",)
        row = self.vectors.select(
            *keys, F.unwrap_udt("tf").alias("tf"), F.unwrap_udt("tfidf").alias("tfidf")
        )
        packed = F.arrays_zip(
            F.col("tf.indices").alias("term_id"),
            F.col("tf.values").alias("tf"),
            F.col("tfidf.values").alias("tfidf"),
        )
        return row.select(*keys, F.explode(packed).alias("e")).select(
            *keys, "e.term_id", "e.tf", "e.tfidf"
        )

    def named_entries(self, *keys: str) -> DataFrame:
        """``entries`` with the term text; the bounded vocabulary is the broadcast side."""
        keys = keys or ("doc_id",)
        names = F.broadcast(self.vocabulary.select("term_id", "term"))
        return self.entries(*keys).join(names, "term_id").select(
            *keys, "term_id", "term", "tf", "tfidf"
        )


def fit_vocabulary(terms: DataFrame, size: int = 2000, min_df: int = 2) -> DataFrame:
    """The ``size`` most used terms found in at least ``min_df`` documents.

    ``term_id`` is the 0-based rank by (corpus count descending, term ascending), so ties are
    settled the same way in every run.
    """
    return rank_terms(term_profile(terms), size, min_df)


def rank_terms(profile: DataFrame, size: int, min_df: int, *also: str) -> DataFrame:
    """``fit_vocabulary`` of counted terms ``(term, tf, df, *also)``."""
    if not 0 < size <= MAX_VOCABULARY:
        raise ValueError(f"vocabulary size must be in 1..{MAX_VOCABULARY}, not {size}")
    kept = profile.where(F.col("df") >= min_df).orderBy(F.desc("tf"), "term").limit(size)
    # One task numbers the rows: there are at most ``size`` of them.
    rank = F.row_number().over(Window.orderBy(F.desc("tf"), "term"))
    return kept.select((rank - 1).alias("term_id"), "term", "tf", "df", *also)


def term_frequencies(terms: DataFrame, vocabulary: list[str], min_tf: int = 1) -> DataFrame:
    """Sparse count vector of every document: ``(doc_id, title, tf)``, without a shuffle.

    Counts below ``min_tf`` are zero.
    """
    model = CountVectorizerModel.from_vocabulary(
        vocabulary, inputCol="terms", outputCol="tf", minTF=float(min_tf)
    )
    return model.transform(terms).select("doc_id", "title", "tf")


def build_matrix(
    terms: DataFrame,
    size: int = 2000,
    min_terms: int = 2,
    min_df: int = 2,
    min_tf: int = 2,
    extractor: TermExtractor | None = None,
) -> TermMatrix:
    """Vocabulary and TF-IDF matrix of ``terms(doc_id, title, terms)``.

    ``extractor`` says how the terms were made (see ``build_from``); new documents and questions go the same way.

    Two passes over the text: one counts terms, one writes the count vectors. Weights are computed
    from the far smaller vectors.
    """
    usable = with_min_terms(terms, min_terms)
    spark = terms.sparkSession
    rows = fit_vocabulary(usable, size, min_df).collect()
    if not rows:
        raise ValueError("no term is frequent enough for the vocabulary")
    counts = frozen(term_frequencies(usable, [r["term"] for r in rows], min_tf), "counts")
    weights = IDF(inputCol="tf", outputCol="tfidf").fit(counts)
    idf, matrix_df = weights.idf.toArray(), weights.docFreq
    vocabulary = spark.createDataFrame(
        [
            (r["term_id"], r["term"], r["tf"], r["df"], int(matrix_df[i]), float(idf[i]))
            for i, r in enumerate(rows)
        ],
        VOCABULARY_SCHEMA,
    )
    return TermMatrix(
        weights.transform(counts), vocabulary, weights.numDocs, len(rows), min_tf, extractor or TermExtractor()
    )


def build_from(docs: DataFrame, extractor: TermExtractor | None = None, **sizes: int) -> TermMatrix:
    """``build_matrix`` of ``docs(doc_id, title, content)``, remembering how text became terms."""
    extractor = extractor or TermExtractor()
    return build_matrix(extractor.transform(docs), extractor=extractor, **sizes)


def feature_stages(matrix: TermMatrix) -> list[Transformer]:
    """Spark ML stages from ``terms`` to ``tf`` and ``tfidf`` with the matrix's vocabulary, weights
    and count threshold."""
    rows = matrix.vocabulary.orderBy("term_id").select("term", "idf").collect()
    counter = CountVectorizerModel.from_vocabulary(
        [r["term"] for r in rows], inputCol="terms", outputCol="tf", minTF=float(matrix.min_tf)
    )
    weights = ElementwiseProduct(
        scalingVec=Vectors.dense([r["idf"] for r in rows]), inputCol="tf", outputCol="tfidf"
    )
    return [counter, weights]


def with_new_documents(matrix: TermMatrix, terms: DataFrame) -> TermMatrix:
    """The same vocabulary and weights on other documents ``(doc_id, title, terms)``."""
    vectors = PipelineModel(stages=feature_stages(matrix)).transform(terms)
    return replace(matrix, vectors=vectors.select("doc_id", "title", "tf", "tfidf"))


def fold_in_documents(matrix: TermMatrix, docs: DataFrame) -> TermMatrix:
    """``docs(doc_id, title, content)``, batch or stream, by the matrix's own way from text to weights."""
    return with_new_documents(matrix, matrix.extractor.transform(docs))


def entry_of(term_id: int, vector: str = "tf") -> Column:
    """Entry of one term in a sparse vector column, 0 where it is absent."""
    packed = F.unwrap_udt(vector)
    at = F.array_position(packed["indices"], term_id).cast("int") - 1
    return F.coalesce(F.get(packed["values"], at), F.lit(0.0))


def find_by_term(matrix: TermMatrix, term: str | int, n: int = 10) -> DataFrame:
    """Documents by their TF-IDF weight for a term (text or id), heaviest first.

    Documents without the term have weight 0 and come last. Each task keeps its best n rows; the
    matrix is not unpacked. An unknown term gives no rows.
    """
    column = "term" if isinstance(term, str) else "term_id"
    known = matrix.vocabulary.where(F.col(column) == term).select("term_id", "idf").first()
    weight = entry_of(known["term_id"]) * known["idf"] if known else F.lit(0.0)
    scored = matrix.vectors.select("doc_id", "title", weight.alias("weight"))
    return scored.orderBy(F.desc("weight"), "doc_id").limit(n if known else 0)


def top_terms_per_document(matrix: TermMatrix, n: int = 10) -> DataFrame:
    """The ``n`` most used terms of every document: ``(doc_id, rank, term, tf)``.

    Each row is sorted where it is; ties rank by term id.
    """
    packed = F.unwrap_udt("tf")
    pairs = F.zip_with(
        packed["values"], packed["indices"],
        lambda tf, i: F.struct((-tf).alias("key"), i.alias("term_id")),
    )
    best = matrix.vectors.select(
        "doc_id", F.posexplode(F.slice(F.sort_array(pairs), 1, n)).alias("at", "e")
    )
    names = F.broadcast(matrix.vocabulary.select("term_id", "term"))
    return best.select(
        "doc_id", (F.col("at") + 1).alias("rank"), "e.term_id", (-F.col("e.key")).alias("tf")
    ).join(names, "term_id").select("doc_id", "rank", "term", "tf")


def graph_edges(matrix: TermMatrix) -> DataFrame:
    """Document-term graph: ``(src, dst, weight)`` with documents as ``d<id>``, terms as ``t<id>``."""
    return matrix.entries().select(
        F.concat(F.lit("d"), "doc_id").alias("src"),
        F.concat(F.lit("t"), "term_id").alias("dst"),
        F.col("tfidf").alias("weight"),
    )


def graph_nodes(matrix: TermMatrix) -> DataFrame:
    """Nodes of the document-term graph: ``(id, label)``."""
    documents = matrix.titles.select(
        F.concat(F.lit("d"), "doc_id").alias("id"), F.col("title").alias("label")
    )
    return documents.unionByName(matrix.vocabulary.select(
        F.concat(F.lit("t"), "term_id").alias("id"), F.col("term").alias("label")
    ))


def with_row_ids(df: DataFrame, name: str = "id") -> DataFrame:
    """Prepend unique ids to rows that have no key.

    Ids follow the partitions, so they are written down once: a task that is run again cannot hand
    out other ids.
    """
    return frozen(df.select(F.monotonically_increasing_id().alias(name), "*"), "ids")
