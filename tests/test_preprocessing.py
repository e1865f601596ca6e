"""The stage from text to terms: settings, saving, streams."""

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from termscape.functions import text as tx
from termscape.functions.stopwords import ENGLISH_174
from termscape.operators import matrix, relevance, terms
from termscape.operators.preprocessing import TermExtractor
from termscape.sources import models

DOCS = [(1, "t1", "Mice ate THE cheese; mice Will running"), (2, "t2", "running feet 42 the"), (2, "again", "feet"), (3, "t3", ""), (4, "t4", None), (None, "t5", "Feet will passes")]
LEMMAS = [("mice", "mouse"), ("ate", "eat"), ("feet", "foot"), ("Feet", "Foot"), ("will", "Will"), (None, "x"), ("cheese", None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "doc_id bigint, title string, content string")


@pytest.fixture(scope="module")
def lemmas(spark):
    return spark.createDataFrame(LEMMAS, "form string, lemma string")


def found(extractor, docs):
    return {r["title"]: r["terms"] for r in extractor.transform(docs).collect()}


def test_settings(docs, lemmas):
    plain = found(TermExtractor(), docs)
    assert plain == {r["title"]: r["terms"] for r in terms.document_terms(docs).collect()}
    looked_up = found(TermExtractor(lemmas=lemmas), docs)
    assert looked_up["t1"] == ["mouse", "eat", "cheese", "mouse", "running"]  # in the order of the text
    assert looked_up["t2"] == ["running", "foot"] and looked_up["again"] == ["foot"] and looked_up["t3"] == []
    assert looked_up["t5"] == ["foot", "passes"] and not looked_up["t4"]
    # "Will" is no stop word in its own case, "the" is
    cased = found(TermExtractor([*ENGLISH_174, "will"], case_sensitive=True, lemmas=lemmas), docs)
    assert cased["t1"] == ["mouse", "eat", "the", "cheese", "mouse", "will", "running"] and cased["t2"] == ["running", "foot"]
    both = found(TermExtractor(normalizer=tx.suffix_rules_sql(), lemmas=lemmas, min_length=4), docs)
    assert both["t1"] == ["mouse", "cheese", "mouse", "runn"] and both["t5"] == ["foot", "pass"]


def test_lemmas_beyond_the_broadcast(spark, docs, lemmas, monkeypatch):
    one_id_each = docs.where("title <> 'again' and doc_id is not null")
    small = found(TermExtractor(ENGLISH_174, case_sensitive=True, lemmas=lemmas), one_id_each)
    monkeypatch.setattr(terms, "MAX_BROADCAST_LEMMAS", 0)
    large = found(TermExtractor(ENGLISH_174, case_sensitive=True, lemmas=lemmas), one_id_each)
    assert {t: sorted(v or []) for t, v in small.items()} == {t: sorted(v) for t, v in large.items()}
    with pytest.raises(ValueError, match="lemmas"):
        TermExtractor(lemmas=lemmas, normalizer="lower(word)").transform(docs)
    with pytest.raises(ValueError, match="lemmas"):
        terms.lemma_words(docs, lemmas)


def test_rule_as_text_is_the_rule(spark):
    words = spark.createDataFrame([(w,) for w in "passes Kisses flies dies sing Running bed red cats is gas ss ADDED".split()], "word string")
    rows = words.select("word", tx.strip_suffix(F.col("word")).alias("a"), F.expr(tx.suffix_rules_sql()).alias("b")).collect()
    assert all(r["a"] == r["b"] for r in rows) and any(r["a"] != r["word"] for r in rows)


@pytest.mark.parametrize("normalizer", ["", tx.suffix_rules_sql()])
def test_saved_stages_and_questions(spark, docs, lemmas, tmp_path, normalizer):
    extractor = TermExtractor(["the", "eat"], True, 4, normalizer, lemmas)
    expected = found(extractor, docs)
    PipelineModel(stages=[extractor]).write().save(str(tmp_path / "stages"))
    back = PipelineModel.load(str(tmp_path / "stages"))
    assert {r["title"]: r["terms"] for r in back.transform(docs).collect()} == expected
    built = matrix.build_from(docs.where("doc_id is not null"), extractor, min_df=1, min_tf=1, min_terms=1)
    models.save_matrix(built, str(tmp_path / "matrix"))
    again = models.load_matrix(spark, str(tmp_path / "matrix"))
    assert found(again.extractor, docs) == expected
    folded = matrix.fold_in_documents(again, docs.where("doc_id = 1")).named_entries().select("term", "tf", "tfidf")
    assert sorted(folded.collect()) == sorted(built.named_entries().where("doc_id = 1").select("term", "tf", "tfidf").collect())
    asked = spark.createDataFrame([(9, "Mice and FEET the mice")], "query_id int, content string")
    assert {(r["query_id"], r["term"]) for r in relevance.text_queries(asked, again.extractor).collect()} == {(9, "mouse"), (9, "foot")}


def test_analyser_runs_once_per_form(spark, docs):
    calls = spark.sparkContext.accumulator(0)

    def make():
        def analyse(form):
            calls.add(1)
            return {"mice": "mouse", "feet": "feet"}.get(form)

        return analyse

    table = terms.analysed_forms(docs, make)
    assert [tuple(r) for r in table.collect()] == [("mice", "mouse")]
    assert calls.value == len({w.lower() for _, _, t in DOCS for w in (t or "").replace(";", "").split()})
