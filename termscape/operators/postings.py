"""Posting lists: the entries of the matrix stored by term, heaviest first, for searches that read only their term.

A weight is a count times the term's idf, so within a term counts rank documents. Entries lie in folders by
``part`` (term id modulo a fixed number, which spreads the frequent terms) and ``level`` (number of bits of the count).
``levels(term_id, level, n)`` says how many documents a term has at a level, whose counts lie between two powers
of two: a search goes down from the top level and stops as soon as the levels above hold enough
documents, since nothing further down can outweigh them. A term that is in every document is split over files by document id.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termscape.operators.matrix import TermMatrix
from termscape.operators.topk import top_per_group

#: Folders that terms are spread over.
PARTS = 64

#: Up to so many hits get their titles by a filter that is pushed to the files of titles, more by a join.
PUSHED_TITLES = 1000


@dataclass(frozen=True)
class Postings:
    """``entries(term_id, doc_id, tf, part, level)``, ``levels(term_id, level, n)``, ``titles(doc_id, title)`` by id,
    and the matrix's ``vocabulary``, all stored; ``parts`` is the number of parts."""

    entries: DataFrame
    levels: DataFrame
    titles: DataFrame
    vocabulary: DataFrame
    parts: int


def level_of(tf: Column) -> Column:
    """Bits of a count less one: 0 for 1, 1 for 2 and 3, 2 for 4 to 7."""
    return (F.length(F.bin(tf.cast("bigint"))) - 1).cast("int")


def write_postings(matrix: TermMatrix, path: str, parts: int = PARTS) -> None:
    """Store the posting lists of a matrix. One shuffle, split by part, level, term and document."""
    entries = matrix.entries().select(
        "term_id", "doc_id", "tf",
        F.pmod("term_id", F.lit(parts)).alias("part"), level_of(F.col("tf")).alias("level"),
    )
    dealt = entries.repartitionByRange("part", "level", "term_id", "doc_id")
    ordered = dealt.sortWithinPartitions("part", "level", "term_id", F.desc("tf"), "doc_id")
    ordered.write.mode("errorifexists").partitionBy("part", "level").parquet(f"{path}/entries")
    stored = matrix.vectors.sparkSession.read.parquet(f"{path}/entries")
    levels = stored.groupBy("term_id", "level").agg(F.count(F.lit(1)).alias("n"))
    levels.coalesce(1).write.mode("errorifexists").parquet(f"{path}/levels")  # a few rows for each term
    matrix.titles.repartitionByRange("doc_id").sortWithinPartitions("doc_id").write.mode("errorifexists").parquet(f"{path}/titles")
    matrix.vocabulary.write.mode("errorifexists").parquet(f"{path}/vocabulary")
    matrix.vectors.sparkSession.createDataFrame([(parts,)], "parts int").write.mode("errorifexists").parquet(f"{path}/size")


def read_postings(spark: SparkSession, path: str) -> Postings:
    schema = "term_id int, doc_id bigint, tf double, part int, level int"
    entries = spark.read.schema(schema).parquet(f"{path}/entries")
    tables = (spark.read.parquet(f"{path}/{name}") for name in ("levels", "titles", "vocabulary"))
    return Postings(entries, *tables, spark.read.parquet(f"{path}/size").first()["parts"])


def find_by_term(postings: Postings, term: str | int, n: int = 10) -> DataFrame:
    """Documents by their TF-IDF weight for a term (text or id), heaviest first: ``(doc_id, title, weight)``.

    Equal weights rank by id. Documents without the term have weight 0 and come last; they are looked at only if
    those with it are fewer than ``n``. An unknown term gives no rows.
    """
    spark = postings.entries.sparkSession
    column = "term" if isinstance(term, str) else "term_id"
    known = postings.vocabulary.where(F.col(column) == term).select("term_id", "idf").first()
    if known is None or n <= 0:
        return spark.createDataFrame([], "doc_id bigint, title string, weight double")
    # a term that is in every document outweighs nothing
    levels = postings.levels.where((F.col("term_id") == known["term_id"]) & F.lit(known["idf"] > 0))
    wanted, found = [], 0
    for row in levels.orderBy(F.desc("level")).collect():
        if found >= n:
            break
        wanted.append(row["level"])
        found += row["n"]
    hits = postings.entries.where(
        (F.col("part") == known["term_id"] % postings.parts) & F.col("level").isin(wanted) & (F.col("term_id") == known["term_id"])
    )
    weighed = hits.select("doc_id", (F.col("tf") * known["idf"]).alias("weight"))
    if found < n:
        rest = postings.titles.select("doc_id").join(F.broadcast(weighed.select("doc_id")), "doc_id", "left_anti")
        weighed = weighed.unionByName(rest.orderBy("doc_id").limit(n - found).withColumn("weight", F.lit(0.0)))
    best = weighed.orderBy(F.desc("weight"), "doc_id").limit(n)
    if n <= PUSHED_TITLES:
        rows = best.collect()
        best = spark.createDataFrame(rows, best.schema)
        titles = postings.titles.where(F.col("doc_id").isin([r["doc_id"] for r in rows]))
    else:
        titles = postings.titles
    return titles.join(best, "doc_id").select("doc_id", "title", "weight").orderBy(F.desc("weight"), "doc_id")


def find_by_terms(postings: Postings, terms: DataFrame, n: int = 10) -> DataFrame:
    """The documents that hold each of ``terms(term)``, heaviest first: ``(term, rank, doc_id, title, weight)``.

    Any number of terms in one pass; of each term only the levels that can be among its first ``n`` are read.
    """
    known = postings.vocabulary.join(terms.select("term").distinct(), "term", "left_semi").select("term_id", "term", "idf")
    above = postings.levels.alias("a").join(postings.levels.alias("b"), F.expr("a.term_id = b.term_id AND b.level > a.level"), "left")
    needed = above.groupBy("a.term_id", "a.level").agg(F.coalesce(F.sum("b.n"), F.lit(0)).alias("above"))
    asked = needed.join(known, "term_id").where((F.col("above") < n) | (F.col("idf") == 0)).select("term_id", "level", "term", "idf", F.pmod("term_id", F.lit(postings.parts)).alias("part"))
    # at most vocabulary x levels rows; part and level also prune the folders that are read
    hits = postings.entries.join(F.broadcast(asked), ["part", "level", "term_id"])
    hits = hits.select("term", "doc_id", (F.col("tf") * F.col("idf")).alias("weight"))
    best = top_per_group(hits, ["term"], [F.desc("weight"), F.col("doc_id")], n)
    return best.join(postings.titles, "doc_id").select("term", "rank", "doc_id", "title", "weight")
