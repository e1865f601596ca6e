"""Whole jobs, for ``spark-submit`` or a notebook. Each stores its result for the next one.

    spark-submit --py-files termscape.zip termscape/plans/jobs.py documents
    spark-submit ... jobs.py matrix --terms 2000 --fraction 0.5 --docs 1000
    spark-submit ... jobs.py svd --concepts 100
    spark-submit ... jobs.py lda --topics 100 --iterations 100
    spark-submit ... jobs.py lsa --concepts 100 --terms 20000 --query "factorization decomposition"

Locations come from ``spark.termscape.base`` and ``spark.termscape.dump``.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from termscape.functions import text as tx
from termscape.functions.stopwords import ENGLISH_174
from termscape.operators import filters, matrix, relevance, svd, topics
from termscape.operators.preprocessing import TermExtractor
from termscape.sources import dump, models, tables


def documents_job(spark: SparkSession, at: tables.Locations, n_docs: int = -1) -> None:
    """Dump to documents."""
    docs = dump.read_dump(spark, at.dump)
    tables.write_documents(filters.first_documents(docs, n_docs), at.documents)


def read_lemmas(spark: SparkSession, path: str) -> DataFrame:
    """``form<TAB>lemma`` lines."""
    return spark.read.csv(path, sep="\t", schema="form string, lemma string", quote="")


def matrix_job(
    spark: SparkSession, at: tables.Locations, size: int = 2000, fraction: float = -1,
    n_docs: int = -1, seed: int | None = None, lemmas: DataFrame | None = None,
    normalizer: str = "",
) -> matrix.TermMatrix:
    """Documents to the matrix. ``n_docs`` limits the documents only together with a sample.

    Words become lemmas by the table ``lemmas(form, lemma)`` or by ``normalizer``, SQL text on ``word``; either
    is stored with the matrix.
    """
    docs = filters.filter_titles(tables.read_documents(spark, at.documents))
    if 0 < fraction < 1:
        docs = filters.first_documents(filters.random_sample(docs, fraction, seed), n_docs)
    built = matrix.build_from(docs, TermExtractor(normalizer=normalizer, lemmas=lemmas), size=size)
    models.save_matrix(built, at.matrix)
    return built


def svd_job(spark: SparkSession, at: tables.Locations, k: int = 100) -> svd.ConceptModel:
    built = models.load_matrix(spark, at.matrix)
    model = svd.fit_concepts(built, min(k, built.n_terms))
    models.save_concepts(model, at.concepts)
    return model


def lda_job(
    spark: SparkSession, at: tables.Locations, k: int = 100, max_iter: int = 100,
    doc_concentration: float | None = None, topic_concentration: float | None = None,
    optimizer: str = "em",
) -> topics.TopicModel:
    built = models.load_matrix(spark, at.matrix)
    model = topics.fit_lda(
        built, k, max_iter, optimizer, doc_concentration, topic_concentration
    )
    models.save_topics(model, at.topics)
    return model


def lsa_reports(
    docs: DataFrame, k: int = 100, size: int = 20000, terms: Sequence[str] = (),
    titles: Sequence[str] = (), question: Sequence[str] = (), n: int = 10,
    lemmas: DataFrame | None = None, normalizer: str = "",
) -> dict[str, DataFrame]:
    """Text to answers in one go: the matrix with 174 case-sensitive stop words and no minimum
    counts, its SVD, the leading concepts, and the four kinds of questions."""
    extractor = TermExtractor(ENGLISH_174, case_sensitive=True, normalizer=normalizer, lemmas=lemmas)
    built = matrix.build_from(docs, extractor, size=size, min_df=1, min_tf=1)
    model = svd.fit_concepts(built, min(k, built.n_terms))
    reports = {
        "singular values": model.concepts,
        "concept terms": svd.concept_terms(model, n, n),
        "concept documents": relevance.concept_documents(model, n, n),
    }
    if terms:
        reports["terms for terms"] = relevance.terms_for_terms(model, terms, n)
        reports["documents for terms"] = relevance.docs_for_terms(model, terms, n)
    if titles:
        reports["documents for documents"] = relevance.docs_for_docs(model, titles=titles, k=n)
    if question:
        asked = docs.sparkSession.createDataFrame(
            [(0, term) for term in question], "query_id int, term string"
        )
        weighed, unknown = relevance.query_terms(asked, built.vocabulary)
        reports["documents for question"] = relevance.docs_for_queries(model, weighed, n)
        reports["unknown terms"] = unknown
    return reports


def main(arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    jobs = parser.add_subparsers(dest="job", required=True)
    job = jobs.add_parser("documents")
    job.add_argument("--docs", type=int, default=-1)
    job = jobs.add_parser("matrix")
    job.add_argument("--terms", type=int, default=2000)
    job.add_argument("--fraction", type=float, default=-1)
    job.add_argument("--docs", type=int, default=-1)
    job.add_argument("--seed", type=int)
    job.add_argument("--lemmas", help="file of form<TAB>lemma lines")
    job.add_argument("--suffixes", action="store_true", help="strip suffixes by rule")
    job = jobs.add_parser("svd")
    job.add_argument("--concepts", type=int, default=100)
    job = jobs.add_parser("lda")
    job.add_argument("--topics", type=int, default=100)
    job.add_argument("--iterations", type=int, default=100)
    job.add_argument("--alpha", type=float)
    job.add_argument("--beta", type=float)
    job.add_argument("--optimizer", choices=("em", "online"), default="em")
    job = jobs.add_parser("lsa")
    job.add_argument("--concepts", type=int, default=100)
    job.add_argument("--terms", type=int, default=20000)
    job.add_argument("--term", nargs="*", default=[])
    job.add_argument("--title", nargs="*", default=[])
    job.add_argument("--query", default="")
    job.add_argument("--lemmas", help="file of form<TAB>lemma lines")
    job.add_argument("--suffixes", action="store_true", help="strip suffixes by rule")
    given = parser.parse_args(arguments)

    spark = SparkSession.builder.appName(f"termscape {given.job}").getOrCreate()
    at = tables.Locations.of(spark)
    lemmas = read_lemmas(spark, given.lemmas) if getattr(given, "lemmas", None) else None
    normalizer = tx.suffix_rules_sql() if getattr(given, "suffixes", False) else ""
    if given.job == "documents":
        documents_job(spark, at, given.docs)
    elif given.job == "matrix":
        matrix_job(
            spark, at, given.terms, given.fraction, given.docs, given.seed, lemmas, normalizer
        )
    elif given.job == "svd":
        svd_job(spark, at, given.concepts)
    elif given.job == "lda":
        lda_job(
            spark, at, given.topics, given.iterations, given.alpha, given.beta, given.optimizer
        )
    else:
        docs = dump.read_dump(spark, at.dump)
        reports = lsa_reports(
            docs, given.concepts, given.terms, given.term, given.title, given.query.split(),
            lemmas=lemmas, normalizer=normalizer,
        )
        for name, report in reports.items():
            print(name)
            report.show(50, truncate=False)


if __name__ == "__main__":
    main()
