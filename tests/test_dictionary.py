"""Ids dealt in Spark against the ones that a single sort gives."""

from pyspark.sql import functions as F

from termscape.operators import dictionary, matrix, stats


def test_ids_equal_one_sort(spark):
    profile = spark.range(5000).select(
        F.concat(F.lit("w"), "id").alias("term"), F.pmod(F.xxhash64("id"), F.lit(40)).alias("tf"),
        F.pmod(F.col("id"), F.lit(4)).alias("df"),
    )
    found = {r["term"]: r["term_id"] for r in dictionary.coded_vocabulary(profile).collect()}
    ranked = sorted((-r["tf"], r["term"]) for r in profile.where("df >= 2").collect())
    assert found == {term: i for i, (_, term) in enumerate(ranked)}


def test_more_terms_than_one_task_numbers(spark):
    """A million terms, with ids as one sort by (count, term) gives them."""
    profile = spark.range(1_000_000).select(
        F.concat(F.lit("t"), F.lpad(F.col("id").cast("string"), 7, "0")).alias("term"),
        (F.lit(1_000_000) - F.floor(F.col("id") / 7)).alias("tf"), F.lit(2).cast("bigint").alias("df"),
    )
    found = dictionary.coded_vocabulary(profile)
    wrong = found.where(F.col("term_id") != F.substring("term", 2, 7).cast("bigint"))
    assert (found.count(), wrong.count()) == (1_000_000, 0)


def corpus(spark):
    words = F.transform(F.sequence(F.lit(1), F.lit(30)), lambda i: F.concat(F.lit("w"), F.pmod(F.pmod(F.xxhash64("id", i), F.lit(90)) * i, F.lit(70))))
    return spark.range(200).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("t"), "id").alias("title"), F.when(F.col("id") % 17 != 3, words).alias("terms")
    )


def test_coded_matrix_equals_the_matrix(spark):
    built = matrix.build_matrix(corpus(spark))
    expected = {(r["doc_id"], r["term"]): (r["tf"], round(r["tfidf"], 9)) for r in built.named_entries().collect()}
    ids = {r["term"]: r["term_id"] for r in built.vocabulary.collect()}
    for frequent in (0, 5, 1 << 16):
        coded = dictionary.build_coded(corpus(spark), frequent=frequent)
        assert {r["term"]: r["term_id"] for r in coded.vocabulary.collect()} == ids
        named = coded.entries.join(coded.vocabulary.select("term_id", "term"), "term_id")
        assert {(r["doc_id"], r["term"]): (r["tf"], round(r["tfidf"], 9)) for r in named.collect()} == expected
        assert coded.n_documents == built.n_documents


def test_empty(spark):
    none = corpus(spark).where("doc_id < 0")
    coded = dictionary.build_coded(none)
    assert (coded.entries.count(), coded.vocabulary.count(), coded.n_documents) == (0, 0, 0)
    assert dictionary.coded_vocabulary(stats.term_profile(none)).count() == 0
