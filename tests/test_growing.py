"""Tables that grow by batches, against the counts of all batches at once."""

import json

import pytest
from pyspark.sql import functions as F

from termscape.operators import corpus_counts, matrix, stats
from termscape.operators.filters import with_min_terms
from termscape.session import folders
from termscape.sources import growing
from termscape.sources.growing import GrowingTable

TEXTS = ["red blue red", "blue green", "red", "", "green green green blue", "amber red red", None, "blue amber"]


def documents(spark, numbers):
    rows = [(n, f"t{n}", (TEXTS[n % len(TEXTS)] or "").split() if TEXTS[n % len(TEXTS)] is not None else None) for n in numbers]
    return spark.createDataFrame(rows, "doc_id bigint, title string, terms array<string>")


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_count_delta_equals_profile(spark):
    found = documents(spark, range(16))
    for min_tf in (1, 2, 3):
        delta = {r["term"]: (r["tf"], r["df"], r["matrix_df"]) for r in corpus_counts.count_delta(found, 2, min_tf).collect()}
        usable = with_min_terms(found)
        assert delta.pop(None) == (0, usable.count(), 0)
        profile = {r["term"]: (r["tf"], r["df"]) for r in stats.term_profile(usable).collect()}
        assert {t: v[:2] for t, v in delta.items()} == profile
        kept = [r["terms"] for r in usable.collect()]
        assert {t: v[2] for t, v in delta.items()} == {t: sum(x.count(t) >= min_tf for x in kept) for t in profile}


def test_no_documents(spark):
    assert corpus_counts.count_delta(documents(spark, [])).count() == 0
    assert corpus_counts.document_count(corpus_counts.count_delta(documents(spark, []))) == 0


def test_batches_add_up(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(growing, "FAN", 3)
    made = GrowingTable(spark, str(tmp_path / "counts"), corpus_counts.merge_counts)
    with pytest.raises(ValueError, match="no batch"):
        made.read()
    most = 0
    for number in range(14):
        assert made.add(number, corpus_counts.count_delta(documents(spark, range(3 * number, 3 * number + 3))))
        most = max(most, len(made.version().parts))
    assert most <= 2 * 3  # two of each level: 14 < 3**3
    assert not made.add(13, corpus_counts.count_delta(documents(spark, range(5))))
    assert not made.add(2, corpus_counts.count_delta(documents(spark, range(5))))
    assert rows(made.read()) == rows(corpus_counts.count_delta(documents(spark, range(42))))
    # folders: parts of two versions, and two versions
    assert len(folders(spark, f"{made.path}/versions")) == growing.KEPT_VERSIONS
    assert len(folders(spark, f"{made.path}/parts")) <= 2 * most


def test_failed_attempts_leave_the_table_as_it_was(spark, tmp_path, monkeypatch):
    made = GrowingTable(spark, str(tmp_path / "counts"), corpus_counts.merge_counts)
    made.add(0, corpus_counts.count_delta(documents(spark, range(4))))
    before = rows(made.read())

    def broken(self, rows):
        real(self, rows)
        raise RuntimeError("lost")

    real = GrowingTable._write
    monkeypatch.setattr(GrowingTable, "_write", broken)
    with pytest.raises(RuntimeError):
        made.add(1, corpus_counts.count_delta(documents(spark, range(4, 8))))
    monkeypatch.setattr(GrowingTable, "_write", real)
    # a version without Spark's mark is no version
    (tmp_path / "counts" / "versions" / "1").mkdir()
    again = GrowingTable(spark, str(tmp_path / "counts"), corpus_counts.merge_counts)
    assert rows(again.read()) == before and again.version().number == 0
    assert len(folders(spark, f"{made.path}/parts")) == 2
    assert again.add(1, corpus_counts.count_delta(documents(spark, range(4, 8))))
    assert rows(again.read()) == rows(corpus_counts.count_delta(documents(spark, range(8))))
    assert len(folders(spark, f"{made.path}/parts")) == 2  # the orphan is gone


def test_other_columns_are_refused(spark, tmp_path):
    made = GrowingTable(spark, str(tmp_path / "counts"), corpus_counts.merge_counts)
    delta = corpus_counts.count_delta(documents(spark, range(4)))
    made.add(0, delta)
    with pytest.raises(ValueError, match="other columns"):
        made.add(1, delta.withColumn("tf", F.col("tf").cast("string")))
    assert json.loads(made.version().schema)["fields"][0]["name"] == "term"


def test_grown_matrix_equals_one_fit_at_once(spark):
    whole = documents(spark, range(24))
    early, late = documents(spark, range(16)), documents(spark, range(16, 24))
    counts = corpus_counts.merge_counts(corpus_counts.count_delta(early).unionByName(corpus_counts.count_delta(late)))
    expected = matrix.build_matrix(whole)
    found = corpus_counts.grown(matrix.build_matrix(early), late, counts)
    assert found.n_documents == expected.n_documents
    assert rows(found.named_entries().select("doc_id", "term", "tf", F.round("tfidf", 9))) == rows(
        expected.named_entries().select("doc_id", "term", "tf", F.round("tfidf", 9))
    )
    columns = ["term", "tf", "df", "matrix_df", F.round("idf", 12)]
    assert rows(found.vocabulary.select(*columns)) == rows(expected.vocabulary.select(*columns))
    assert rows(corpus_counts.weighed_vocabulary(counts).select(*columns)) == rows(expected.vocabulary.select(*columns))


def test_merged_sketches_equal_one_sketch(spark):
    words = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(40)), lambda i: F.concat(F.lit("w"), F.pmod(F.xxhash64("doc_id", i), F.lit(3000)))), " ")
    docs = spark.range(600).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("source"), words.alias("content"))
    docs = docs.unionByName(spark.createDataFrame([(600, "c", ""), (601, "c", None), (602, None, " x")], "doc_id bigint, source string, content string"))
    direct = corpus_counts.merge_funnel()(corpus_counts.funnel_delta(docs))
    parts = [corpus_counts.funnel_delta(docs.where(F.col("doc_id") % 4 == n), ["source"]) for n in range(4)]
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    by_source = corpus_counts.merge_funnel("source")(merged)
    assert by_source.count() == 4 * 4  # stages of the sources a, b, c and of the null one
    whole = corpus_counts.merge_funnel()(by_source)
    columns = ["stage", "tokens", "tokens_per_doc", "unique_per_doc"]
    left, right = corpus_counts.funnel_estimate(whole), corpus_counts.funnel_estimate(direct)
    assert rows(left.select(*columns)) == rows(right.select(*columns))
    exact = {r["stage"]: r for r in stats.preprocessing_funnel(docs).collect()}
    # the union of sketches is the sketch of all, but for the estimator that is allowed after a union
    for a, b in zip(sorted(left.collect()), sorted(right.collect()), strict=True):
        true = exact[a["stage"]]["unique_tokens"]
        assert abs(a["unique_tokens"] - b["unique_tokens"]) <= 0.03 * true
        assert abs(a["unique_tokens"] - true) <= 0.05 * true
        assert a["tokens"] == exact[a["stage"]]["tokens"]
        assert abs(a["unique_per_doc"] - exact[a["stage"]]["unique_per_doc"]) < 1e-9
