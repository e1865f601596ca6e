"""Documents, vocabularies and id maps in files."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Locations:
    """Where the jobs read and write; every folder follows from ``base``."""

    base: str = "termscape-data"
    dump: str = "wikidump.xml"

    @classmethod
    def of(cls, spark: SparkSession) -> Locations:
        """From ``spark.termscape.base`` and ``spark.termscape.dump``, with defaults."""
        return cls(
            spark.conf.get("spark.termscape.base", cls.base),
            spark.conf.get("spark.termscape.dump", cls.dump),
        )

    @property
    def documents(self) -> str:
        return f"{self.base}/documents"

    @property
    def matrix(self) -> str:
        return f"{self.base}/matrix"

    @property
    def concepts(self) -> str:
        return f"{self.base}/svd"

    @property
    def topics(self) -> str:
        return f"{self.base}/lda"


def write_documents(docs: DataFrame, path: str) -> None:
    """Parquet; fails if the folder exists."""
    docs.write.mode("errorifexists").parquet(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select("doc_id", "title", "content")


DOCUMENT_SCHEMA = "doc_id bigint, title string, content string"

#: Line ends are written as two characters, so that a line is a record and files can be split.
LINE_ENDS = (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"))


def _one_line(text: Column) -> Column:
    for char, written in LINE_ENDS:
        text = F.replace(text, F.lit(char), F.lit(written))
    return text


def _lines_again(text: Column) -> Column:
    # pairs of backslashes are set aside while the others are read
    def ends(piece: Column) -> Column:
        for char, written in LINE_ENDS[1:]:
            piece = F.replace(piece, F.lit(written), F.lit(char))
        return piece

    return F.array_join(F.transform(F.split(text, r"\\\\", -1), ends), "\\")


def write_documents_csv(docs: DataFrame, path: str) -> None:
    """CSV with a header, one document a line; quotes are doubled, null and empty told apart."""
    texts = {c: _one_line(F.col(c)) for c in ("title", "content")}
    docs.select("doc_id", "title", "content").withColumns(texts).write.mode("errorifexists").csv(
        path, header=True, quote='"', escape='"', quoteAll=True, nullValue="\\N", emptyValue="",
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )


def read_documents_csv(spark: SparkSession, path: str) -> DataFrame:
    """What ``write_documents_csv`` wrote, in one pass, many tasks to a file."""
    read = spark.read.schema(DOCUMENT_SCHEMA).csv(
        path, header=True, quote='"', escape='"', nullValue="\\N", emptyValue=""
    )
    return read.withColumns({c: _lines_again(F.col(c)) for c in ("title", "content")})


def corpus(documents: DataFrame) -> DataFrame:
    """``documents(doc_id, text, source, ...)`` as ``(doc_id, title, content)``."""
    return documents.select(
        "doc_id",
        F.concat_ws("-", "source", F.col("doc_id").cast("string")).alias("title"),
        F.col("text").alias("content"),
    )


def write_vocabulary_text(vocabulary: DataFrame, path: str) -> None:
    """``term_id<TAB>term`` lines, so that reading does not depend on file order."""
    vocabulary.select(F.concat_ws("\t", F.col("term_id").cast("string"), "term")).write.text(path)


def read_vocabulary_text(spark: SparkSession, path: str) -> DataFrame:
    parts = F.split("value", "\t", 2)
    return spark.read.text(path).select(
        F.get(parts, F.lit(0)).cast("int").alias("term_id"), F.get(parts, F.lit(1)).alias("term")
    )


def write_doc_ids_json(docs: DataFrame, path: str) -> None:
    docs.select("doc_id", "title").write.json(path)


def read_doc_ids_json(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("doc_id bigint, title string").json(path)


#: A stop-word list becomes a literal of the plan, so its length is checked.
MAX_STOP_WORDS = 100_000


def read_stop_words(spark: SparkSession, path: str) -> list[str]:
    """Distinct non-empty lines of a word list."""
    lines = spark.read.text(path).where(F.length("value") > 0).select("value").distinct()
    words = [r["value"] for r in lines.limit(MAX_STOP_WORDS + 1).collect()]
    if len(words) > MAX_STOP_WORDS:
        raise ValueError(f"more than {MAX_STOP_WORDS} stop words in {path}")
    return sorted(words)
