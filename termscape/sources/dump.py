"""Encyclopedia dumps: XML pages to documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termscape.functions import markup
from termscape.operators.filters import is_article
from termscape.operators.terms import computed

# The elements of a page that are used.
PAGE_SCHEMA = (
    "title string, ns int, id bigint, redirect struct<_title: string>, "
    "revision struct<id: bigint, timestamp: string, text: struct<_VALUE: string, _bytes: bigint>>"
)
OPEN_TAG, CLOSE_TAG = "<page>", "</page>"


def read_page_xml(spark: SparkSession, path: str) -> DataFrame:
    """One row ``(page_xml)`` per ``<page>`` element of the files.

    Records end at the closing tag, which lets Spark split one huge file among many tasks; the XML
    data source would give each file to one task.
    """
    raw = spark.read.option("lineSep", CLOSE_TAG).text(path)
    at = F.instr("value", OPEN_TAG)
    page = F.concat(F.substring("value", at, F.length("value")), F.lit(CLOSE_TAG))
    return raw.where(at > 0).select(page.alias("page_xml"))


def parse_pages(raw: DataFrame, column: str = "page_xml") -> DataFrame:
    """XML strings to ``(doc_id, title, ns, redirect, markup)``.

    Null and broken records, and pages without a title or an id, are dropped. ``redirect`` is the
    target's title, empty for a redirect that names none, null for pages that are no redirects.
    """
    page = F.from_xml(F.col(column), PAGE_SCHEMA, {"rowTag": "page"})
    # text is escaped in a record, so a tag is an element
    marked = F.col(column).rlike(r"<redirect[\s/>]")
    parsed = computed(raw.where(F.col(column).isNotNull()), [], page=page, marked=marked)
    named = F.col("page.title").isNotNull() & F.col("page.id").isNotNull()
    return parsed.where(named).select(
        F.col("page.id").alias("doc_id"),
        F.col("page.title").alias("title"),
        F.coalesce("page.ns", F.lit(0)).alias("ns"),
        F.coalesce("page.redirect._title", F.when(F.col("marked"), F.lit(""))).alias("redirect"),
        F.coalesce("page.revision.text._VALUE", F.lit("")).alias("markup"),
    )


def article_documents(pages: DataFrame, match: str = "prefix", title_line: bool = True) -> DataFrame:
    """Articles among parsed pages as ``(doc_id, title, content)`` in plain text.

    With ``title_line`` the content starts with the title on a line of its own.
    """
    kept = pages.where(
        is_article(F.col("title"), F.col("ns"), F.col("redirect"), F.col("markup"), match)
    )
    return kept.select("doc_id", "title", _content(markup.wiki_text(F.col("markup")), title_line))


def _content(text: Column, title_line: bool) -> Column:
    return (F.concat("title", F.lit("\n"), text) if title_line else text).alias("content")


def read_dump(spark: SparkSession, path: str, match: str = "prefix") -> DataFrame:
    """Dump files to documents ``(doc_id, title, content)``."""
    return article_documents(parse_pages(read_page_xml(spark, path)), match)


def html_documents(pages: DataFrame) -> DataFrame:
    """``pages(page_id, html)`` to documents: title element and visible text."""
    return computed(
        pages, [F.col("page_id").alias("doc_id")],
        title=markup.html_title(F.col("html")), content=markup.html_text(F.col("html")),
    )
