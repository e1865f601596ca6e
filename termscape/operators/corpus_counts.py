"""Counts of a corpus that grows: partial results of a batch of documents, and how they add up.

Every function that ends in ``_delta`` reads one batch; the matching ``merge_`` makes one row per key of several batches.
Both are what ``sources.growing.GrowingTable`` keeps. Vocabulary, IDF, the weights of a matrix and the funnel
report follow from the merged rows; no text is read again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import replace

from pyspark.ml.feature import ElementwiseProduct
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termscape.functions.stopwords import ENGLISH_DEFAULT
from termscape.operators.filters import with_min_terms
from termscape.operators.matrix import TermMatrix, rank_terms, with_new_documents
from termscape.operators.stats import FUNNEL_STAGES, funnel_stages
from termscape.operators.terms import computed


def count_delta(terms: DataFrame, min_terms: int = 2, min_tf: int = 2) -> DataFrame:
    """``(term, tf, df, matrix_df)`` of the documents with at least ``min_terms`` terms, in one pass and one shuffle.

    ``matrix_df`` counts the documents that use the term at least ``min_tf`` times. The row of the null
    term has the number of documents in ``df``. No document gives no row.
    """
    ordered = computed(with_min_terms(terms, min_terms), [], own=F.sort_array("terms"))
    # in order, a term used min_tf times stands that many places further on too
    often = F.filter("own", lambda term, i: F.coalesce(F.get("own", i + (min_tf - 1)) == term, F.lit(False)))
    none = F.array(F.lit(None).cast("string"))
    kinds = ordered.select(
        F.posexplode(F.array(F.col("own"), F.array_distinct("own"), F.array_distinct(often), none)).alias("kind", "list")
    )
    return kinds.select("kind", F.explode("list").alias("term")).groupBy("term").agg(
        F.count_if(F.col("kind") == 0).alias("tf"),
        F.count_if(F.col("kind").isin(1, 3)).alias("df"),
        F.count_if(F.col("kind") == 2).alias("matrix_df"),
    )


def merge_counts(counts: DataFrame) -> DataFrame:
    return counts.groupBy("term").agg(*(F.sum(c).alias(c) for c in ("tf", "df", "matrix_df")))


def document_count(counts: DataFrame) -> int:
    row = counts.where(F.col("term").isNull()).select("df").first()
    return row["df"] if row else 0


def weight_of(n_documents: int) -> Column:
    return F.log(F.lit(n_documents + 1.0) / (F.col("matrix_df") + 1.0))


def weighed_vocabulary(counts: DataFrame, size: int = 2000, min_df: int = 2) -> DataFrame:
    """``(term_id, term, tf, df, matrix_df, idf)`` of merged counts, as fitting a matrix on all documents gives it."""
    ranked = rank_terms(counts.where(F.col("term").isNotNull()), size, min_df, "matrix_df")
    return ranked.withColumn("idf", weight_of(document_count(counts)))


def reweighted(matrix: TermMatrix, counts: DataFrame) -> TermMatrix:
    """The matrix with the counts and weights of ``counts``: same vocabulary and ids, same count vectors.

    Map-only for the vectors; the vocabulary is of bounded size. ``counts`` must be made with the matrix's ``min_tf``.
    """
    known = matrix.vocabulary.select("term_id", "term")
    found = counts.join(F.broadcast(known.select("term")), "term", "left_semi")
    held = known.join(found, "term", "left").select(
        "term_id", "term", *(F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("tf", "df", "matrix_df"))
    )
    n_documents = document_count(counts)
    rows = held.withColumn("idf", weight_of(n_documents)).orderBy("term_id").collect()
    vocabulary = counts.sparkSession.createDataFrame(rows, matrix.vocabulary.schema)
    weigh = ElementwiseProduct(scalingVec=Vectors.dense([r["idf"] for r in rows]), inputCol="tf", outputCol="tfidf")
    vectors = weigh.transform(matrix.vectors.select("doc_id", "title", "tf"))
    return replace(matrix, vectors=vectors, vocabulary=vocabulary, n_documents=n_documents)


def grown(matrix: TermMatrix, terms: DataFrame, counts: DataFrame, min_terms: int = 2) -> TermMatrix:
    """The matrix with further documents ``terms(doc_id, title, terms)``, all rows weighed by ``counts`` of the whole corpus."""
    added = with_new_documents(matrix, with_min_terms(terms, min_terms)).vectors
    return reweighted(replace(matrix, vectors=matrix.vectors.unionByName(added)), counts)


#: Log2 of the buckets of a sketch: 4096 of them, standard error 1.6 percent, a few kilobytes.
SKETCH_BITS = 12


def funnel_delta(
    docs: DataFrame,
    by: Sequence[str] = (),
    stop_words: Sequence[str] = ENGLISH_DEFAULT,
    normalizer: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Totals and a sketch of the distinct tokens per stage of the funnel: ``(*by, stage, tokens, documents, own, sketch)``.

    ``own`` adds up the distinct tokens of each document. ``by`` names columns of ``docs``, a source for
    instance. A sketch per group and task is all that is shuffled.
    """
    staged = funnel_stages(docs, by, stop_words, normalizer)
    each = staged.select(*by, F.posexplode("stages").alias("at", "list"))
    sized = each.select(
        *by, "at", F.coalesce(F.size("list"), F.lit(0)).alias("n"),
        F.array_distinct(F.coalesce("list", F.array().cast("array<string>"))).alias("distinct"),
    )
    tokens = sized.select(*by, "at", "n", F.size("distinct").alias("m"), F.posexplode_outer("distinct").alias("i", "token"))
    first = F.coalesce("i", F.lit(0)) == 0
    # hashed, since a sketch takes no notice of empty strings
    hashed = F.when(F.col("i").isNotNull(), F.xxhash64("token"))
    names = F.array(*map(F.lit, FUNNEL_STAGES))
    return tokens.groupBy(*by, "at").agg(
        F.coalesce(F.sum(F.when(first, F.col("n"))), F.lit(0)).cast("bigint").alias("tokens"),
        F.count_if(first).alias("documents"),
        F.coalesce(F.sum(F.when(first, F.col("m"))), F.lit(0)).cast("bigint").alias("own"),
        F.hll_sketch_agg(hashed, SKETCH_BITS).alias("sketch"),
    ).select(*by, F.get(names, F.col("at")).alias("stage"), "tokens", "documents", "own", "sketch")


def merge_funnel(*by: str) -> Callable[[DataFrame], DataFrame]:
    """Merge rule for rows of ``funnel_delta``; with fewer columns than they have it rolls them up."""
    def merge(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*by, "stage").agg(
            *(F.sum(c).alias(c) for c in ("tokens", "documents", "own")), F.hll_union_agg("sketch").alias("sketch")
        )

    return merge


def funnel_estimate(rows: DataFrame, *by: str) -> DataFrame:
    """The funnel report of merged rows; only ``unique_tokens`` is an estimate."""
    return rows.select(
        *by, "stage", "tokens", F.hll_sketch_estimate("sketch").alias("unique_tokens"),
        (F.col("tokens") / F.col("documents")).alias("tokens_per_doc"),
        (F.col("own") / F.col("documents")).alias("unique_per_doc"),
    )
