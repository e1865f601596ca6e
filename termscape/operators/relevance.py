"""Relevance questions on a concept model, for one query or a set of queries.

A score is a dot product of a query vector with every factor row. A query set of bounded size (checked)
travels to the tasks, and factor rows never move: a task turns a batch of rows into scores with one
matrix product and keeps its best rows per query, so what is shuffled is k rows per query and task
however large the table or the skew. A larger set is met in parts of the factor table: the rows of a part
come first, the queries stream past them in batches. Either way it is one pass over the factors, and
no query vector beyond the bounded set reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termscape.operators.preprocessing import TermExtractor
from termscape.operators.svd import ConceptModel, bucket_length, titled
from termscape.operators.topk import top_per_group
from termscape.session import at_most, frozen

#: Query vector entries (32 MB of doubles) and queries that are sent to the tasks. A task holds one
#: score per query for each row of a batch.
MAX_QUERY_ENTRIES = 1 << 22
MAX_QUERIES = 1024

#: Factor entries of a part that larger query sets are met with (32 MB of doubles).
PART_ENTRIES = 1 << 22

#: Scores rank by so many digits of the largest score that the query could have: its length times that of the
#: longest row. So copies are ties, whatever the scale.
RANK_DIGITS = 9

#: Cosines, which are that fraction themselves, rank by fewer digits: the last ones of two nearly parallel rows are
#: the factorization's own error.
COSINE_DIGITS = 6


def _scored(
    factors: DataFrame, id_col: str, vector_col: str, queries: np.ndarray, k: int, cosine: bool, longest: float
) -> DataFrame:
    """Best ``k`` rows per task and query: ``(query_no, id, key, score)``; ranks go by ``key``."""
    n_queries, dims = queries.shape
    digits = COSINE_DIGITS if cosine else RANK_DIGITS
    unit = (1.0 if cosine else np.sqrt((queries * queries).sum(axis=1)) * longest) + np.zeros(n_queries)
    unit = np.where(unit > 0, unit, 1.0)
    transposed = np.ascontiguousarray(queries.T)

    # Functions for the tasks are nested so that they travel by value: executors need numpy and
    # pyarrow, not this package.
    def merged(ids, keys, scores, more_ids, more_keys, more_scores):
        """First k of both by (key descending, id ascending)."""
        if len(keys) == k:
            keep = more_keys >= keys[-1]
        elif len(more_keys) > k:
            keep = more_keys >= np.partition(more_keys, -k)[-k]
        else:
            keep = slice(None)
        ids = np.concatenate([ids, more_ids[keep]])
        keys = np.concatenate([keys, more_keys[keep]])
        scores = np.concatenate([scores, more_scores[keep]])
        order = np.lexsort((ids, -keys))[:k]
        return ids[order], keys[order], scores[order]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [(np.empty(0, np.int64), np.empty(0), np.empty(0))] * n_queries
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
            if cosine:
                norms = np.sqrt((x * x).sum(axis=1))
                long = norms > 0  # rows that are but error are zero in the model
                ids, x = ids[long], x[long] / norms[long, None]
            scores = x @ transposed
            # Adding 0 turns a negative zero into zero.
            keys = np.round(scores / unit, digits) + 0.0
            scores[keys == 0] = 0.0
            best = [merged(*best[q], ids, keys[:, q], scores[:, q]) for q in range(n_queries)]
        for q, (ids, keys, scores) in enumerate(best):
            yield pa.RecordBatch.from_pydict({
                "query_no": pa.array(np.full(len(ids), q, np.int32)),
                "id": pa.array(ids),
                "key": pa.array(keys),
                "score": pa.array(scores),
            })

    return factors.select(F.col(id_col).cast("bigint"), vector_col).mapInArrow(
        run, "query_no int, id bigint, key double, score double"
    )


@dataclass(frozen=True)
class Lengths:
    """What is known of a factor table: its longest row and, if it lies in folders by length, their rows."""

    longest: float
    buckets: dict[int, int] | None = None

    def first(self, k: int) -> list[int]:
        """The buckets of the longest rows that hold ``k`` rows together."""
        found, rows = [], 0
        for bucket in sorted(self.buckets):
            found.append(bucket)
            rows += self.buckets[bucket]
            if rows >= k:
                break
        return found

    def rest(self, read: list[int], least_key: float) -> list[int]:
        """Further buckets with rows that may reach a score of ``least_key`` times the largest possible one."""
        slack = 10.0**-RANK_DIGITS  # keys are rounded
        return [b for b in sorted(self.buckets) if b not in read and bucket_length(b) + slack >= least_key]


def _pruned(
    factors: DataFrame, id_col: str, vector_col: str, queries: np.ndarray, k: int, known: Lengths
) -> DataFrame:
    """``_scored`` by dot product, without the buckets whose rows are too short to be among any query's best ``k``.

    The longest rows are scored first. No other row's key exceeds its bucket's length, so a bucket below the
    k-th key of every query is not read.
    """
    read = known.first(k)
    first = _scored(factors.where(F.col("bucket").isin(read)), id_col, vector_col, queries, k, False, known.longest)
    first = frozen(top_per_group(first, ["query_no"], [F.desc("key"), F.col("id")], k).drop("rank"), "first-scores")
    reached = first.groupBy("query_no").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("least")).collect()
    full = [r["least"] for r in reached if r["n"] == k]
    least = min(full) if len(full) == len(queries) else -1.0
    more = known.rest(read, least)
    if not more:
        return first
    return first.unionByName(_scored(factors.where(F.col("bucket").isin(more)), id_col, vector_col, queries, k, False, known.longest))


def _met(
    factors: DataFrame, id_col: str, vector_col: str, queries: DataFrame, k: int, cosine: bool, parts: int, longest: float
) -> DataFrame:
    """Best ``k`` rows per part of the factors and query: ``(query, id, key, score)``, for any number of queries."""
    digits = COSINE_DIGITS if cosine else RANK_DIGITS
    key_type = queries.schema["query"].dataType.simpleString()
    rows = factors.select(
        F.pmod(F.xxhash64(id_col), F.lit(parts)).cast("int").alias("part"), F.lit(0).alias("asks"),
        F.col(id_col).cast("bigint").alias("id"), F.lit(None).cast(key_type).alias("query"),
        F.col(vector_col).alias("vector"),
    )
    asked = queries.select(
        F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), F.lit(1).alias("asks"),
        F.lit(None).cast("bigint").alias("id"), "query", "vector",
    )

    def unit(x):
        norms = np.sqrt((x * x).sum(axis=1))
        return norms > 0, x / np.where(norms > 0, norms, 1.0)[:, None]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, table = None, [], None
        for batch in batches:
            numbers = batch.column("part").to_numpy(zero_copy_only=False)
            kinds = batch.column("asks").to_numpy(zero_copy_only=False)
            turns = np.flatnonzero((np.diff(numbers) != 0) | (np.diff(kinds) != 0)) + 1
            for first, last in zip([0, *turns], [*turns, len(numbers)]):
                if first == last:
                    continue
                piece = batch.slice(first, last - first)
                vectors = piece.column("vector")
                x = vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(piece), -1)
                if numbers[first] != part:
                    part, held, table = numbers[first], [], None
                if not kinds[first]:
                    held.append((piece.column("id").to_numpy(zero_copy_only=False), x))
                    continue
                if not held:
                    continue
                if table is None:
                    ids, own = np.concatenate([i for i, _ in held]), np.concatenate([v for _, v in held])
                    if cosine:
                        long, own = unit(own)
                        ids, own = ids[long], own[long]
                    order = np.argsort(ids, kind="stable")  # equal scores rank by id
                    ids, table = ids[order], own[order]
                keys = piece.column("query")
                if cosine:
                    long, x = unit(x)
                    keys, x = keys.filter(pa.array(long)), x[long]
                n = min(k, len(ids))
                if not n or not len(keys):
                    continue
                size = (1.0 if cosine else np.sqrt((x * x).sum(axis=1)) * longest) + np.zeros(len(x))
                size = np.where(size > 0, size, 1.0)[:, None]
                scores = x @ table.T
                ranked = np.round(scores / size, digits) + 0.0
                scores[ranked == 0] = 0.0
                # all rows at least as good as the n-th: ties beyond n are settled by the caller's rank
                least = -np.partition(-ranked, n - 1, axis=1)[:, n - 1]
                q, r = np.nonzero(ranked >= least[:, None])
                better = ranked[q, r] > least[q]
                spare = n - np.bincount(q, weights=better, minlength=len(keys)).astype(int)
                ties = np.cumsum(~better) - 1
                start = np.concatenate([[0], np.cumsum(np.bincount(q, weights=~better, minlength=len(keys)).astype(int))])
                keep = better | (ties - start[q] < spare[q])
                q, r = q[keep], r[keep]
                yield pa.RecordBatch.from_arrays(
                    [keys.take(pa.array(q)), pa.array(ids[r]), pa.array(ranked[q, r]), pa.array(scores[q, r])], names=["query", "id", "key", "score"]
                )

    met = rows.unionByName(asked).repartition("part").sortWithinPartitions("part", "asks")
    return met.mapInArrow(run, f"query {key_type}, id bigint, key double, score double")


def top_scores(
    factors: DataFrame,
    id_col: str,
    vector_col: str,
    queries: DataFrame,
    k: int = 10,
    cosine: bool = False,
    known: Lengths | None = None,
) -> DataFrame:
    """Best ``k`` factor rows for each of ``queries(query, vector)``: ``(query, rank, id, score)``.

    With ``cosine`` both sides are divided by their length and rows without a direction take no part. Scores that
    agree to ``RANK_DIGITS`` digits of the largest possible one (cosines: ``COSINE_DIGITS``) rank by id. Queries are distinct. ``known`` says how
    long the rows are; with buckets, short rows are only read if they can be among the best.
    """
    spark = factors.sparkSession
    key_type = queries.schema["query"].dataType.simpleString()
    first = factors.select(F.size(vector_col)).first()
    if not first or not first[0]:
        return spark.createDataFrame([], f"query {key_type}, rank int, id bigint, score double")
    order = [F.desc("key"), F.col("id")]
    dims = first[0]
    if cosine:
        known = Lengths(1.0)
    elif known is None:
        squares = F.aggregate(vector_col, F.lit(0.0), lambda total, x: total + x * x)
        known = Lengths(factors.agg(F.sqrt(F.max(squares))).first()[0])
    if not at_most(queries, max(1, min(MAX_QUERIES, MAX_QUERY_ENTRIES // dims))):
        parts = max(1, -(-factors.count() * dims // PART_ENTRIES))
        met = _met(factors, id_col, vector_col, queries, k, cosine, parts, known.longest)
        return top_per_group(met, ["query"], order, k).select("query", "rank", "id", "score")
    rows = queries.orderBy("query").toArrow().combine_chunks()
    keys = rows["query"].to_pylist()
    vectors = rows["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
    if cosine:
        norms = np.sqrt((vectors * vectors).sum(axis=1))
        long = norms > 0
        keys = [key for key, kept in zip(keys, long) if kept]
        vectors = vectors[long] / norms[long, None]
    if not keys:
        return spark.createDataFrame([], f"query {key_type}, rank int, id bigint, score double")
    if known.buckets:
        scored = _pruned(factors, id_col, vector_col, vectors, k, known)
    else:
        scored = _scored(factors, id_col, vector_col, vectors, k, cosine, known.longest)
    names = spark.createDataFrame(list(enumerate(keys)), f"query_no int, query {key_type}")
    return (
        top_per_group(scored, ["query_no"], order, k)
        .join(F.broadcast(names), "query_no")
        .select("query", "rank", "id", "score")
    )


def unit_queries(spark: SparkSession, size: int, n: int | None = None) -> DataFrame:
    """The first ``n`` of ``size`` unit vectors as queries: each asks for one entry of a row."""
    units = np.eye(size)[:n]
    return spark.createDataFrame(
        [(i, row.tolist()) for i, row in enumerate(units)], "query int, vector array<double>"
    )


def _documents(
    model: ConceptModel, queries: DataFrame, key: str, k: int, cosine: bool = False
) -> DataFrame:
    """Best documents per query, ids resolved to titles with one join for all hits."""
    answers = top_scores(model.doc_factors, "doc_id", "us", queries, k, cosine, Lengths(model.longest, model.buckets))
    hits = answers.select(F.col("query").alias(key), "rank", F.col("id").alias("doc_id"), "score")
    found = titled(hits, model.titles, queries.count() * k)
    return found.select(key, "rank", "doc_id", "title", "score")


def concept_documents(model: ConceptModel, n_concepts: int | None = None, n: int = 10) -> DataFrame:
    """Heaviest documents of the leading concepts by U: ``(concept, rank, doc_id, title, weight)``."""
    size = model.concepts.count()
    asked = unit_queries(model.concepts.sparkSession, size, n_concepts)
    hits = _documents(model, asked, "concept", n)
    return hits.join(F.broadcast(model.concepts), "concept").select(
        "concept", "rank", "doc_id", "title", (F.col("score") / F.col("sigma")).alias("weight")
    )


def _term_queries(model: ConceptModel, column: str, terms: Sequence[str] | None) -> DataFrame:
    """Factor rows of the given terms, or of the whole vocabulary; unknown terms are left out."""
    chosen = model.term_factors
    if terms is not None:
        chosen = chosen.where(F.col("term").isin(list(terms)))
    return chosen.select(F.col("term").alias("query"), F.col(column).alias("vector"))


def docs_for_terms(
    model: ConceptModel, terms: Sequence[str] | None = None, k: int = 10
) -> DataFrame:
    """Documents by relevance to each term: ``(term, rank, doc_id, title, score)``.

    The score is the row of U diag(s) times the row of V. Without ``terms`` the whole vocabulary is
    asked.
    """
    queries = _term_queries(model, "v", terms)
    return _documents(model, queries, "term", k)


def terms_for_terms(
    model: ConceptModel, terms: Sequence[str] | None = None, k: int = 10
) -> DataFrame:
    """Terms by cosine of their rows of V diag(s), the term itself included:
    ``(term, rank, related, score)``."""
    queries = _term_queries(model, "vs", terms)
    answers = top_scores(model.term_factors, "term_id", "vs", queries, k, cosine=True)
    names = model.term_factors.select(
        F.col("term_id").cast("bigint").alias("id"), F.col("term").alias("related")
    )
    return answers.join(names, "id").select(
        F.col("query").alias("term"), "rank", "related", "score"
    )


def docs_for_docs(
    model: ConceptModel,
    doc_ids: Sequence[int] | DataFrame | None = None,
    titles: Sequence[str] | DataFrame | None = None,
    k: int = 10,
) -> DataFrame:
    """Documents by cosine of their rows of U diag(s), the document itself included:
    ``(query_id, rank, doc_id, title, score)``.

    Query documents are named by id or by title, as a list or, for any number of them, as a table with
    a column ``doc_id`` or ``title``. A document without any vocabulary term has no
    direction: it neither asks nor answers.
    """
    if doc_ids is None and titles is None:
        raise ValueError("name the query documents by id or by title")
    chosen = model.doc_factors
    if isinstance(doc_ids, DataFrame):
        chosen = chosen.join(doc_ids.select("doc_id"), "doc_id", "left_semi")
    elif doc_ids is not None:
        chosen = chosen.where(F.col("doc_id").isin(list(doc_ids)))
    if isinstance(titles, DataFrame):
        named = model.titles.join(titles.select("title"), "title", "left_semi").select("doc_id")
        chosen = chosen.join(named, "doc_id", "left_semi")
    elif titles is not None:
        named = model.titles.where(F.col("title").isin(list(titles))).select("doc_id")
        chosen = chosen.join(named, "doc_id", "left_semi")
    queries = chosen.select(F.col("doc_id").alias("query"), F.col("us").alias("vector"))
    return _documents(model, queries, "query_id", k, cosine=True)


def query_terms(queries: DataFrame, vocabulary: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Weigh the terms of ``queries(query_id, term)``.

    Returns ``(query_id, term_id, term, weight)``, where the weight is the term's idf and repeated
    terms count once, and ``(query_id, term)`` of the terms the vocabulary does not have.
    """
    asked = queries.select("query_id", "term").distinct()
    words = F.broadcast(vocabulary.select("term", "term_id", F.col("idf").alias("weight")))
    weighed = asked.join(words, "term").select("query_id", "term_id", "term", "weight")
    unknown = asked.join(words, "term", "left_anti").select("query_id", "term")
    return weighed, unknown


def text_queries(texts: DataFrame, extractor: TermExtractor | None = None) -> DataFrame:
    """``(query_id, content)`` to ``(query_id, term)`` with the terms made as the matrix's extractor makes them."""
    asked = texts.select(F.col("query_id").alias("doc_id"), F.lit(None).cast("string").alias("title"), "content")
    found = (extractor or TermExtractor()).transform(asked)
    return found.select(F.col("doc_id").alias("query_id"), F.explode(F.array_distinct("terms")).alias("term"))


def docs_for_queries(
    model: ConceptModel, weighed: DataFrame, k: int = 10
) -> DataFrame:
    """Documents by relevance to ``weighed(query_id, term_id, weight)``:
    ``(query_id, rank, doc_id, title, score)``.

    Query vectors are V'q, summed in Spark.
    """
    factors = model.term_factors.select("term_id", F.posexplode("v").alias("concept", "v"))
    projected = (
        weighed.join(factors, "term_id")
        .groupBy("query_id", "concept")
        .agg(F.sum(F.col("weight") * F.col("v")).alias("x"))
        .groupBy(F.col("query_id").alias("query"))
        .agg(F.sort_array(F.collect_list(F.struct("concept", "x"))).alias("row"))
        .select("query", F.transform("row", lambda e: e["x"]).alias("vector"))
    )
    queries = frozen(projected, "queries")
    return _documents(model, queries, "query_id", k)
