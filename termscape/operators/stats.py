"""Corpus statistics over term arrays.

Counting always explodes inside the map task and merges partial counts before the one shuffle by
term, so a word that makes up a third of the corpus is one row per task in that shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termscape.functions import text as tx
from termscape.functions.stopwords import ENGLISH_DEFAULT
from termscape.operators.filters import with_min_terms
from termscape.operators.terms import computed


def token_count(tokens: Column) -> Column:
    return F.coalesce(F.size(tokens), F.lit(0)).cast("bigint")


def token_totals(docs: DataFrame, tokens: str = "terms") -> DataFrame:
    """Sum and mean of tokens per document, in one job."""
    count = token_count(F.col(tokens))
    return docs.agg(F.sum(count).alias("tokens"), F.avg(count).alias("tokens_per_doc"))


def distinct_totals(
    docs: DataFrame, tokens: str = "terms", approximate: bool = False, error: float = 0.02
) -> DataFrame:
    """Distinct tokens of the corpus and mean distinct tokens per document.

    ``approximate=True`` replaces the exact distinct count, which shuffles the vocabulary once, by a
    sketch of a few kilobytes per task.
    """
    if approximate:
        per_doc = docs.select(F.array_distinct(F.coalesce(tokens, F.array())).alias("own"))
        rows = per_doc.select(F.size("own").alias("n"), F.posexplode_outer("own").alias("i", "term"))
        first = F.coalesce("i", F.lit(0)) == 0
        return rows.agg(
            F.approx_count_distinct("term", error).alias("unique_tokens"),
            (F.sum(F.when(first, F.col("n"))) / F.sum(F.when(first, 1))).alias("unique_per_doc"),
        )
    staged = docs.select(F.array(F.coalesce(tokens, F.array())).alias("stages"))
    totals = _totals(_stage_counts(staged), "stage")
    # one row at most; an aggregate gives one for an empty corpus too
    return totals.agg(
        F.coalesce(F.first("unique_tokens"), F.lit(0).cast("bigint")).alias("unique_tokens"),
        F.first("unique_per_doc").alias("unique_per_doc"),
    )


def _stage_counts(staged: DataFrame) -> DataFrame:
    """Uses and documents of every token at every stage: ``(stage, token, uses, docs)``.

    ``staged(stages array<array<string>>)`` has one row per document with its tokens at each stage,
    which are numbered from 0. A document gives its tokens, its distinct tokens, and one null that
    counts the document itself, so that a single count per (stage, token) serves all totals.
    """
    none = F.array(F.lit(None).cast("string"))
    kinds = staged.select(F.posexplode("stages").alias("stage", "tokens")).select(
        "stage", F.posexplode(F.array("tokens", F.array_distinct("tokens"), none)).alias("kind", "list")
    )
    tokens = kinds.select("stage", "kind", F.explode("list").alias("token"))
    return tokens.groupBy("stage", "token").agg(
        F.count_if(F.col("kind") == 0).alias("uses"), F.count_if(F.col("kind") > 0).alias("docs")
    )


def _totals(counts: DataFrame, stage: str) -> DataFrame:
    """Totals per stage of ``counts(stage, token, uses, docs)``."""
    documents = F.sum(F.when(F.col("token").isNull(), F.col("docs")))
    distinct = F.sum(F.when(F.col("token").isNotNull(), F.col("docs")).otherwise(0))
    return counts.groupBy(stage).agg(
        F.sum("uses").alias("tokens"),
        F.count("token").alias("unique_tokens"),
        (F.sum("uses") / documents).alias("tokens_per_doc"),
        (distinct / documents).alias("unique_per_doc"),
    )


#: Names of the stages of the funnel, in their order.
FUNNEL_STAGES = ("1 tokenize", "2 stop words", "3 lemmatize", "4 filter")


def funnel_stages(
    docs: DataFrame,
    keep: Sequence[str],
    stop_words: Sequence[str],
    normalizer: Callable[[Column], Column] | None,
    with_second: bool = True,
) -> DataFrame:
    """``(*keep, stages)``: the tokens of every document at each stage; the second follows from the first and may be left out."""
    content = F.col("content")
    lemmatize = tx.without_stop_words(tx.normalized(tx.words(content), normalizer), stop_words)
    found = computed(docs, keep, tokenize=tx.whitespace_tokens(content), lemmatize=lemmatize)
    second = [tx.without_stop_words(F.col("tokenize"), stop_words)] if with_second else []
    last = tx.lower_all(tx.with_term_shape(F.col("lemmatize")))
    return found.select(*keep, F.array(F.col("tokenize"), *second, F.col("lemmatize"), last).alias("stages"))


def preprocessing_funnel(
    docs: DataFrame,
    stop_words: Sequence[str] = ENGLISH_DEFAULT,
    normalizer: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Tokens and distinct tokens, in total and per document, after each preprocessing stage.

    Stages: whitespace tokens, the same without stop words, normalized words without stop words,
    and those of only letters and more than two characters, lower-cased. The second stage keeps or
    drops whole tokens of the first, so it is read off the first one's counts.
    """
    staged = funnel_stages(docs, [], stop_words, normalizer, with_second=False)
    lowered = sorted({w.lower() for w in stop_words})
    kept = F.col("token").isNull() | ~F.lower("token").isin(lowered)
    names = (
        F.when(F.col("stage") == 1, F.array(F.lit("3 lemmatize")))
        .when(F.col("stage") == 2, F.array(F.lit("4 filter")))
        .when(kept, F.array(F.lit("1 tokenize"), F.lit("2 stop words")))
        .otherwise(F.array(F.lit("1 tokenize")))
    )
    counts = _stage_counts(staged).withColumn("names", names)
    return _totals(
        counts.select(F.explode("names").alias("stage"), "token", "uses", "docs"), "stage"
    )


def longest_document(docs: DataFrame, tokens: str = "terms") -> DataFrame:
    return docs.agg(F.max(token_count(F.col(tokens))).alias("max_tokens"))


def usable_documents(docs: DataFrame, min_terms: int = 2, tokens: str = "terms") -> DataFrame:
    return with_min_terms(docs, min_terms, tokens).agg(F.count(F.lit(1)).alias("documents"))


def term_frequency(docs: DataFrame, tokens: str = "terms") -> DataFrame:
    """``(term, tf)`` over the corpus."""
    return (
        docs.select(F.explode(tokens).alias("term"))
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("tf"))
    )


def document_frequency(docs: DataFrame, tokens: str = "terms") -> DataFrame:
    """``(term, df)``: the number of documents that contain the term."""
    return (
        docs.select(F.explode(F.array_distinct(tokens)).alias("term"))
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("df"))
    )


def term_profile(docs: DataFrame, tokens: str = "terms") -> DataFrame:
    """``(term, tf, df)`` in one pass and one shuffle, instead of joining the two counts."""
    kinds = docs.select(
        F.posexplode(F.array(tokens, F.array_distinct(tokens))).alias("kind", "list")
    )
    return kinds.select("kind", F.explode("list").alias("term")).groupBy("term").agg(
        F.count_if(F.col("kind") == 0).alias("tf"), F.count_if(F.col("kind") == 1).alias("df")
    )


def column_summary(df: DataFrame, *columns: str) -> DataFrame:
    """Count, mean, standard deviation, minimum and maximum of the columns."""
    return df.describe(*columns)


def vocabulary_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Terms in only one of two ``(term)`` tables: ``(term, only_in)``."""
    marked = left.select("term", F.lit(1).alias("side")).unionByName(
        right.select("term", F.lit(2).alias("side"))
    )
    sides = marked.groupBy("term").agg(F.min("side").alias("low"), F.max("side").alias("high"))
    return sides.where(F.col("low") == F.col("high")).select(
        "term", F.when(F.col("low") == 1, "left").otherwise("right").alias("only_in")
    )
