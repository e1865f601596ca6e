"""Searches in posting lists against the scan of the matrix."""

import shutil

import pytest

from termscape.operators import matrix, postings


@pytest.fixture(scope="module")
def built(spark):
    docs = [(i, f"t{i}", ["a"] * (1 + i % 9) + ["b"] * (i % 4) + ["c", "x"] * (i % 5 == 0) + ["every"]) for i in range(60)]
    return matrix.build_matrix(spark.createDataFrame(docs, "doc_id bigint, title string, terms array<string>"), size=4, min_tf=1)


@pytest.fixture(scope="module")
def stored(spark, built, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("lists") / "p")
    postings.write_postings(built, path, parts=3)
    return path


@pytest.mark.parametrize("n", [0, 1, 4, 10, 30, 100])
def test_same_answers_as_the_scan(spark, built, stored, n):
    lists = postings.read_postings(spark, stored)
    for row in built.vocabulary.collect():
        expected = [tuple(r) for r in matrix.find_by_term(built, row["term_id"], n).collect()]
        for key in (row["term_id"], row["term"]):
            assert [tuple(r) for r in postings.find_by_term(lists, key, n).collect()] == expected
    assert postings.find_by_term(lists, "unknown", n).count() == 0
    if n:
        each = postings.find_by_terms(lists, lists.vocabulary, n).orderBy("term", "rank").collect()
        for row in built.vocabulary.collect():
            scan = [tuple(r) for r in built.named_entries().where(f"term = '{row['term']}'").select("doc_id", "tfidf").orderBy("doc_id").collect()]
            best = sorted(scan, key=lambda r: (-r[1], r[0]))[:n]
            assert [(r["doc_id"], r["weight"]) for r in each if r["term"] == row["term"]] == best


def test_only_the_folders_of_the_term_and_its_top_levels_are_read(spark, built, stored, tmp_path):
    copy = str(tmp_path / "p")
    shutil.copytree(stored, copy)
    a = built.vocabulary.where("term = 'a'").first()["term_id"]
    for part in range(3):
        for level in range(8):
            if (part, level) != (a % 3, 3):  # counts 8 and 9: twelve documents
                shutil.rmtree(f"{copy}/entries/part={part}/level={level}", ignore_errors=True)
    found = postings.find_by_term(postings.read_postings(spark, copy), "a", 12).collect()
    assert [tuple(r) for r in found] == [tuple(r) for r in matrix.find_by_term(built, "a", 12).collect()]
