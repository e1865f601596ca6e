"""Vocabularies and matrices of any size: term ids are dealt in Spark, no term passes through the driver.

``operators.matrix`` makes model objects of its vocabulary and is the way to Spark's models. Here vocabulary and
entries stay tables, for corpora whose terms do not fit into one object.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termscape.operators.filters import with_min_terms
from termscape.operators.stats import term_profile
from termscape.operators.terms import computed
from termscape.session import Scratch, frozen

#: Terms that are sent to every task when texts are coded. The term of rank r makes up at most 1/r of all tokens, so
#: none of those left to a shuffle is more than one token in so many.
FREQUENT_TERMS = 1 << 16

#: Bits of ``monotonically_increasing_id`` that count the rows of a partition.
ROW_BITS = 33


@dataclass(frozen=True)
class CodedMatrix:
    """``entries(doc_id, term_id, tf, tfidf)`` and ``vocabulary(term_id, term, tf, df, matrix_df, idf)``, both stored tables."""

    entries: DataFrame
    vocabulary: DataFrame
    n_documents: int


def coded_vocabulary(profile: DataFrame, min_df: int = 2) -> DataFrame:
    """All terms of ``profile(term, tf, df)`` found in at least ``min_df`` documents: ``(term_id bigint, term, tf, df)``.

    ``term_id`` is the 0-based rank by (count descending, term ascending), as in ``matrix.fit_vocabulary``, which has
    the same ids as far as it goes. Terms are sorted by ranges; an id is the place in its range plus
    the sizes of the ranges before. Rows are unique in the sort key, so no range is hot.
    """
    kept = profile.where(F.col("df") >= min_df)
    spark = kept.sparkSession
    with Scratch(spark) as scratch:
        # ranges are drawn from a sample of their input: stored, so that a lost task finds the same ones
        counted = scratch.table(kept.select("term", "tf", "df"), "profile")
        ranges = counted.repartitionByRange(F.desc("tf"), F.asc("term")).sortWithinPartitions(F.desc("tf"), F.asc("term"))
        placed = scratch.table(ranges.select(F.monotonically_increasing_id().alias("at"), "term", "tf", "df"), "ranges")
        part = F.shiftright("at", ROW_BITS)
        # one row per range: bounded by the number of shuffle partitions
        sizes = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect()
        starts, total = [], 0
        for row in sizes:
            starts.append((row["part"], total))
            total += row["n"]
        offsets = F.broadcast(spark.createDataFrame(starts, "part bigint, start bigint"))
        within = F.col("at").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
        ids = placed.withColumn("part", part).join(offsets, "part")
        return frozen(ids.select((F.col("start") + within).alias("term_id"), "term", "tf", "df"), "dictionary")


def coded_counts(terms: DataFrame, vocabulary: DataFrame, min_tf: int = 1, frequent: int = FREQUENT_TERMS) -> DataFrame:
    """``(doc_id, term_id, n)`` for the terms of the vocabulary that a document uses at least ``min_tf`` times.

    Terms are counted inside the row, as runs in sorted order; ids of documents are keys. The ``frequent`` first terms are looked up in a broadcast table;
    only the others are shuffled by term, and of them none makes up more than ``1/frequent`` of all tokens.
    Terms outside the vocabulary are rarer still.
    """
    ordered = computed(terms, ["doc_id"], own=F.sort_array("terms"))
    places = F.transform("own", lambda _, i: i)
    begins = F.filter(places, lambda i: (i == 0) | (F.get("own", i) != F.get("own", i - 1)))
    runs = computed(ordered, ["doc_id", "own"], begins=begins)
    pairs = F.transform("begins", lambda begin, j: F.struct(
        F.get("own", begin).alias("term"), (F.coalesce(F.get("begins", j + 1), F.size("own")) - begin).cast("bigint").alias("n")
    ))
    counted = runs.select("doc_id", F.inline(pairs)).where(F.col("n") >= min_tf)
    named = vocabulary.select("term", "term_id")
    first = F.broadcast(named.where(F.col("term_id") < frequent))
    looked_up = counted.join(first, "term", "left")
    with_id = looked_up.where(F.col("term_id").isNotNull()).select("doc_id", "term_id", "n")
    others = looked_up.where(F.col("term_id").isNull()).select("doc_id", "term", "n")
    rare = others.join(named.where(F.col("term_id") >= frequent).hint("merge"), "term").select("doc_id", "term_id", "n")
    return with_id.unionByName(rare)


def build_coded(
    terms: DataFrame, min_terms: int = 2, min_df: int = 2, min_tf: int = 2, frequent: int = FREQUENT_TERMS
) -> CodedMatrix:
    """TF-IDF matrix of ``terms(doc_id, title, terms)`` over every term of at least ``min_df`` documents.

    An empty corpus gives empty tables.
    """
    usable = with_min_terms(terms, min_terms)
    n_documents = usable.count()
    named = coded_vocabulary(term_profile(usable), min_df)
    with Scratch(terms.sparkSession) as scratch:
        counts = scratch.table(coded_counts(usable, named, min_tf, frequent), "coded")
        used = counts.groupBy("term_id").agg(F.count(F.lit(1)).alias("matrix_df"))
        matrix_df = F.coalesce("matrix_df", F.lit(0).cast("bigint"))
        vocabulary = frozen(
            named.join(used, "term_id", "left").select(
                "term_id", "term", "tf", "df", matrix_df.alias("matrix_df"),
                F.log(F.lit(n_documents + 1.0) / (matrix_df + 1.0)).alias("idf"),
            ), "dictionary",
        )
        # entries of the frequent terms are most of all entries: their weights are broadcast, the others' joined
        weights = vocabulary.select("term_id", "idf")
        common = counts.where(F.col("term_id") < frequent).join(F.broadcast(weights.where(F.col("term_id") < frequent)), "term_id")
        rare = counts.where(F.col("term_id") >= frequent).join(weights.where(F.col("term_id") >= frequent).hint("merge"), "term_id")
        tf = F.col("n").cast("double")
        entries = common.unionByName(rare).select("doc_id", "term_id", tf.alias("tf"), (tf * F.col("idf")).alias("tfidf"))
        return CodedMatrix(frozen(entries, "entries"), vocabulary, n_documents)
