"""Truncated singular value decomposition of the document-term matrix.

Row matrices are MLlib's, fed from and read back into DataFrames without leaving the JVM. What the
driver holds is sized by the vocabulary (n x k factors); everything that has one row per
document stays distributed.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termscape.operators.matrix import TermMatrix
from termscape.operators.topk import top_per_group
from termscape.session import frozen, scratch_path

#: Most n x k entries of the term factor that may be held on the driver (1 GB of doubles).
MAX_FACTOR_ENTRIES = 1 << 27

#: Singular values that the solver puts below this fraction of the largest are not looked at.
RELATIVE_CUT = 1e-12

#: Rows of V diag(s) shorter than this fraction of their matrix column, and rows of U diag(s) shorter
#: than this fraction of the longest, are zero but for the error of the factorization.
COLUMN_CUT, ROW_CUT = 1e-9, 1e-11

#: Most answer rows (a few numbers each) that are broadcast to look up their titles.
MAX_BROADCAST_ANSWERS = 1 << 19


@dataclass(frozen=True)
class ConceptModel:
    """A truncated SVD, A = U diag(s) V'.

    ``concepts(concept, sigma)`` by falling sigma; ``term_factors(term_id, term, v, vs)`` with the
    rows of V and of V diag(s); ``doc_factors(doc_id, us, bucket)`` with the rows of U diag(s). The largest
    entry of every column of V is positive. Sigma is the length of the column of A V. A row that
    is zero but for the error of the factorization is zero.

    Document rows are stored in folders by ``bucket``: rows of bucket b are at most ``bucket_length(b)`` times as long
    as the longest row, whose length is ``longest``. ``buckets`` holds their numbers of rows, a few dozen at most.
    """

    concepts: DataFrame
    term_factors: DataFrame
    doc_factors: DataFrame
    titles: DataFrame
    longest: float
    buckets: dict[int, int]

    @property
    def sigmas(self) -> list[float]:
        return [r["sigma"] for r in self.concepts.orderBy("concept").collect()]


#: Directions computed beyond those that are kept, for the sake of the kept ones' digits.
SPARE_DIRECTIONS = 10

#: Buckets of rows by length; each is 2 ** -0.5 times as long as the one before, the last holds all shorter rows.
BUCKETS = 40


def bucket_length(bucket: int) -> float:
    """Length of the longest rows that a bucket may hold, as a fraction of the longest row."""
    return 2.0 ** (-bucket / 2)


def _by_length(rows: DataFrame, longest: float, path: str) -> dict[int, int]:
    """Store ``(doc_id, us)`` by bucket and count the rows of each."""
    share = _length(F.col("us")) / F.lit(longest or 1.0)
    # a little below the border, so that a rounded logarithm never puts a row into a bucket too short for it
    bucket = F.when(share > 0, F.floor(-2 * F.log2(share) - 1e-6)).otherwise(BUCKETS - 1)
    bucket = F.least(F.greatest(bucket, F.lit(0)), F.lit(BUCKETS - 1)).cast("int")
    placed = rows.select("doc_id", "us", bucket.alias("bucket"))
    # even files, and a bucket with most of the rows is split
    placed.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(path)
    stored = rows.sparkSession.read.schema(DOC_FACTORS_SCHEMA).parquet(path)
    return {r["bucket"]: r["count"] for r in stored.groupBy("bucket").count().collect()}


DOC_FACTORS_SCHEMA = "doc_id bigint, us array<double>, bucket int"


def _oriented(v: np.ndarray) -> np.ndarray:
    """Flip columns whose entry of largest magnitude (lowest row on ties) is negative."""
    size = np.round(np.abs(v), 9)
    peak = v[np.argmax(size, axis=0), np.arange(v.shape[1])]
    return v * np.where(peak < 0, -1.0, 1.0)


def _directions(rows: DataFrame, n_terms: int, k: int) -> np.ndarray:
    """Leading directions V by MLlib, which holds O(n k) numbers on the driver, or A'A for few terms or many concepts.

    It stops at a residual of 1e-10 for the last direction asked for; those before are more exact. So some more are
    asked for than are kept.
    """
    if rows.where(F.col("length") > 0).isEmpty():
        return np.eye(n_terms, k)  # the solver needs a matrix with an entry
    asked = min(n_terms, k + SPARE_DIRECTIONS)
    return IndexedRowMatrix(rows.drop("length"), numCols=n_terms).computeSVD(asked, rCond=RELATIVE_CUT).V.toArray()[:, :k]


def _length(values: Column) -> Column:
    """Euclidean length of an array column."""
    return F.sqrt(F.aggregate(values, F.lit(0.0), lambda total, x: total + x * x))


def fit_concepts(matrix: TermMatrix, k: int = 100) -> ConceptModel:
    """Factorize the TF-IDF matrix into at most ``k`` concepts."""
    if not 0 < k <= matrix.n_terms:
        raise ValueError(f"k must be in 1..{matrix.n_terms}, not {k}")
    if k * matrix.n_terms > MAX_FACTOR_ENTRIES:
        raise ValueError(f"{matrix.n_terms} terms x {k} concepts do not fit on the driver")
    spark = matrix.vectors.sparkSession
    weighed = matrix.vectors.select("doc_id", "tfidf", _length(vector_to_array("tfidf")).alias("length"))
    rows = MLUtils.convertVectorColumnsFromML(weighed, "tfidf").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        v = _oriented(_directions(rows, matrix.n_terms, k))
        # U diag(s) is A V, one map-only pass that does not need U.
        product = IndexedRowMatrix(rows.drop("length"), numCols=matrix.n_terms).multiply(
            DenseMatrix(v.shape[0], v.shape[1], v.ravel(order="F"))
        )
        us = callMLlibFunc("getIndexedRows", product._java_matrix_wrapper._java_model)
        us = MLUtils.convertVectorColumnsToML(us, "vector")
        us = frozen(us.select(F.col("index").alias("doc_id"), F.col("vector")), "doc-products")
    finally:
        rows.unpersist()
    # Sigma from the columns of A V: the roots of A'A's eigenvalues are noise below the root of the
    # machine precision. What is left there is beyond the rank of A.
    array = vector_to_array("vector")
    totals = us.agg(Summarizer.normL2(F.col("vector")).alias("columns"), F.max(_length(array)).alias("row")).first()
    sigma = totals["columns"].toArray() if totals["row"] is not None else np.zeros(v.shape[1])
    order = np.argsort(-sigma, kind="stable")
    order = order[sigma[order] > matrix.n_terms * np.finfo(float).eps * sigma.max(initial=0.0)]
    sigma, v = sigma[order], v[:, order]
    row = F.transform(F.array(*[F.lit(int(i)) for i in order]), lambda i: F.get(F.col("us"), i))
    cleared = F.when(_length(row) <= ROW_CUT * (totals["row"] or 0.0), F.transform(row, lambda x: F.lit(0.0)))
    path = scratch_path(spark, "doc-factors")
    found = us.select("doc_id", array.alias("us")).select("doc_id", F.coalesce(cleared, row).alias("us"))
    buckets = _by_length(found, totals["row"] or 0.0, path)
    doc_factors = spark.read.schema(DOC_FACTORS_SCHEMA).parquet(path)
    # lengths of the matrix columns, one number per term
    columns = matrix.vectors.select(Summarizer.normL2(F.col("tfidf"))).first()[0].toArray()
    scaled = v * sigma
    scaled[np.sqrt((scaled * scaled).sum(axis=1)) <= COLUMN_CUT * columns] = 0.0
    concepts = spark.createDataFrame(
        [(i, float(value)) for i, value in enumerate(sigma)], "concept int, sigma double"
    )
    names = matrix.vocabulary.select("term_id", "term").orderBy("term_id").toArrow()
    vectors = names.append_column("v", pa.array(list(v))).append_column("vs", pa.array(list(scaled)))
    term_factors = frozen(spark.createDataFrame(vectors), "term-factors")
    return ConceptModel(concepts, term_factors, doc_factors, matrix.titles, totals["row"] or 0.0, buckets)


def concept_terms(model: ConceptModel, n_concepts: int | None = None, n: int = 10) -> DataFrame:
    """Heaviest terms of the leading concepts: ``(concept, rank, term, weight)``."""
    v = F.col("v") if n_concepts is None else F.slice("v", 1, n_concepts)
    rows = model.term_factors.select("term_id", "term", F.posexplode(v).alias("concept", "weight"))
    order = [F.desc(F.round("weight", 9)), F.col("term_id")]
    return top_per_group(rows, ["concept"], order, n).select("concept", "rank", "term", "weight")


def concept_words(model: ConceptModel, n: int = 10, separator: str = ", ") -> DataFrame:
    """Heaviest terms of each concept as one string: ``(concept, words)``."""
    return ranked_words(concept_terms(model, n=n), "concept", separator)


def ranked_words(ranked: DataFrame, group: str, separator: str = ", ") -> DataFrame:
    """``(group, rank, term, ...)`` of a few terms per group to ``(group, words)``."""
    ordered = F.sort_array(F.collect_list(F.struct("rank", "term")))
    return ranked.groupBy(group).agg(
        F.array_join(F.transform(ordered, lambda e: e["term"]), separator).alias("words")
    )


def top_terms_for_concept(model: ConceptModel, concept: int, n: int = 10) -> DataFrame:
    """``(term_id, term, weight)`` by falling entry of V."""
    weight = F.get("v", F.lit(concept))
    return (
        model.term_factors.select("term_id", "term", weight.alias("weight"))
        .where(F.col("weight").isNotNull())
        .orderBy(F.desc(F.round("weight", 9)), "term_id")
        .limit(n)
    )


def top_documents_for_concept(model: ConceptModel, concept: int, n: int = 10) -> DataFrame:
    """``(rank, doc_id, title, weight)`` by falling entry of U."""
    sigmas = model.sigmas
    if not 0 <= concept < len(sigmas):
        return model.titles.select(
            F.lit(0).alias("rank"), "doc_id", "title", F.lit(0.0).alias("weight")
        ).limit(0)
    # Columns of U have length 1, so the rounding, which settles ties between copies, is relative.
    weight = F.get("us", F.lit(concept)) / F.lit(sigmas[concept])
    order = [F.desc(F.round("weight", 9) + 0.0), F.col("doc_id")]
    best = model.doc_factors.select("doc_id", weight.alias("weight")).orderBy(*order).limit(n)
    ranked = best.select(F.row_number().over(Window.orderBy(*order)).alias("rank"), "doc_id", "weight")
    return titled(ranked, model.titles, n).select("rank", "doc_id", "title", "weight") \
        .orderBy("rank")


def titled(answers: DataFrame, titles: DataFrame, bound: int) -> DataFrame:
    """Add the title of every ``doc_id`` with one join; at most ``bound`` answers, broadcast if few."""
    if bound <= MAX_BROADCAST_ANSWERS:
        answers = F.broadcast(answers)
    return titles.join(answers, "doc_id")
