"""Row filters, samples, caps and lookups on documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termscape.session import at_most

# Title patterns.
UNWANTED_TITLE = r"(^(List)|(Category))|([0-9]+)"
LISTING_TITLES = ("List", "Category", "Template")


def wanted_title(title: Column) -> Column:
    """False for titles that start with "List", contain "Category" or a digit, or are too short."""
    return ~title.rlike(UNWANTED_TITLE) & (F.length(title) > 1)


def filter_titles(docs: DataFrame, title: str = "title") -> DataFrame:
    return docs.where(wanted_title(F.col(title)))


def is_article(
    title: Column, namespace: Column, redirect: Column, markup: Column, match: str = "prefix"
) -> Column:
    """Predicate that keeps encyclopedia articles.

    A page is dropped when it is empty, outside the main namespace, a redirect, a disambiguation
    page or a listing. ``match="prefix"`` drops every title that starts with a listing word,
    ``match="exact"`` only the titles that are nothing but that word.
    """
    if match == "prefix":
        listing = title.rlike("^(" + "|".join(LISTING_TITLES) + ")")
    elif match == "exact":
        listing = title.isin(*LISTING_TITLES)
    else:
        raise ValueError(f"match must be 'prefix' or 'exact', not {match!r}")
    return (
        title.isNotNull()
        & (F.length(F.trim(F.coalesce(markup, F.lit("")))) > 0)
        & (namespace == 0)
        & redirect.isNull()
        & ~markup.rlike(r"(?i)^\s*#redirect")
        & ~markup.rlike(r"(?i)\{\{\s*disambig")
        & ~title.contains("(disambiguation)")
        & ~listing
    )


def with_min_terms(docs: DataFrame, min_terms: int = 2, terms: str = "terms") -> DataFrame:
    """Keep documents with at least ``min_terms`` terms."""
    return docs.where(F.size(terms) >= min_terms)


def random_sample(docs: DataFrame, fraction: float, seed: int | None = None) -> DataFrame:
    """Bernoulli sample; a fraction outside (0, 1) keeps everything."""
    return docs.sample(fraction=fraction, seed=seed) if 0 < fraction < 1 else docs


def hash_sample(docs: DataFrame, key: str, fraction: float) -> DataFrame:
    """Sample that depends only on the key: the same documents in every run and on every engine."""
    if not 0 < fraction < 1:
        return docs
    digest = F.substring(F.md5(F.col(key).cast("string")), 1, 8)
    bucket = F.conv(digest, 16, 10).cast("bigint")
    return docs.where(bucket < int(fraction * 2**32))


def first_documents(docs: DataFrame, n: int, key: str = "doc_id") -> DataFrame:
    """The ``n`` documents with the smallest key; n <= 0 keeps everything."""
    return docs.orderBy(key).limit(n) if n > 0 else docs


def find_by_title(
    docs: DataFrame, needle: str, n: int = 15, case_sensitive: bool = False
) -> DataFrame:
    """Documents whose title contains ``needle``, smallest ids first."""
    title = F.col("title")
    hit = title.contains(needle) if case_sensitive else F.lower(title).contains(needle.lower())
    return docs.where(hit).select("doc_id", "title").orderBy("doc_id").limit(n)


#: Id lists up to this many rows are broadcast to the titles.
MAX_BROADCAST_IDS = 1_000_000


def titles_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Title of every id in ``ids(doc_id)``; an unknown id gets an empty title.

    A short list is broadcast to find its titles first, so the documents are not shuffled for it.
    """
    titles = docs.select("doc_id", "title")
    ids = ids.select("doc_id").distinct()
    if at_most(ids, MAX_BROADCAST_IDS):
        titles = titles.join(F.broadcast(ids), "doc_id")
    return ids.join(titles, "doc_id", "left").select(
        "doc_id", F.coalesce("title", F.lit("")).alias("title")
    )


def title_of(docs: DataFrame, doc_id: int) -> str:
    """Title of one document, an empty string if there is none."""
    row = docs.where(F.col("doc_id") == doc_id).select("title").first()
    return row["title"] if row else ""
