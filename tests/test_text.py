"""Column functions against Spark ML's transformers and plain Python."""

import re

import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.ml.feature import StopWordsRemover, Tokenizer
from pyspark.sql import functions as F

from termscape.functions import text as tx
from termscape.functions.stopwords import ENGLISH_174, ENGLISH_DEFAULT

EDGE = [
    (1, "The 'wires' are red, what a SHAME."),
    (2, "abc1 x2y don't naïve café ﬁrst 黄婉卿 강남스타일"),
    (3, ""),
    (4, "   "),
    (5, "AND The ab abc ABCD efg\n\n tail  "),
    (6, None),
    (7, "İstanbul ΑΣ Straße under_score 𝒜𝒷𝒸𝒹 ١٢٣"),
]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(EDGE, "doc_id int, content string")


def values(df, column):
    return {r["doc_id"]: r["v"] for r in df.select("doc_id", column.alias("v")).collect()}


def clean(text, stop, case_sensitive=False, min_length=3):
    words = regex.findall(r"[\p{L}\p{M}\p{N}]+", text)
    words = [w for w in words if regex.fullmatch(r"\p{L}+", w) and len(w) >= min_length]
    stop = set(stop)
    if case_sensitive:
        return [w.lower() for w in words if w not in stop]
    return [w.lower() for w in words if w.lower() not in stop]


def test_default_list_is_sparks(spark):
    assert len(ENGLISH_174) == 174
    assert set(ENGLISH_DEFAULT) == set(StopWordsRemover.loadDefaultStopWords("english"))


def test_whitespace_tokens_equal_the_ml_tokenizer(edge):
    known = edge.where("content IS NOT NULL")
    tokens = Tokenizer(inputCol="content", outputCol="t").transform(known)
    expected = {r["doc_id"]: r["t"] for r in tokens.collect()}
    assert values(known, tx.whitespace_tokens(F.col("content"))) == expected


def test_stop_words_equal_the_ml_remover(edge):
    known = edge.where("content IS NOT NULL").withColumn("t", tx.words(F.col("content")))
    removed = StopWordsRemover(inputCol="t", outputCol="kept").transform(known)
    expected = {r["doc_id"]: r["kept"] for r in removed.collect()}
    assert values(known, tx.without_stop_words(F.col("t"))) == expected


def test_case_sensitive_stop_words(edge):
    kept = values(edge, tx.without_stop_words(tx.words(F.col("content")), ENGLISH_174, True))
    assert kept[5][:2] == ["AND", "The"]
    assert "what" not in kept[1]


@pytest.mark.parametrize("case_sensitive", [False, True])
def test_clean_terms(edge, case_sensitive):
    stop = ENGLISH_174 if case_sensitive else ENGLISH_DEFAULT
    found = values(edge, tx.clean_terms(F.col("content"), stop, case_sensitive))
    for doc_id, content in EDGE:
        if content is None:
            assert found[doc_id] is None
        elif doc_id != 7:  # engines lower-case the dotted capital I differently
            assert found[doc_id] == clean(content, stop, case_sensitive)


def test_extraction_regex_equals_filtering(edge):
    fast = values(edge, tx.letter_words(F.col("content")))
    slow = values(edge, tx.with_term_shape(tx.words(F.col("content"))))
    assert fast == slow


def test_normalizer_runs_before_the_filters(spark):
    df = spark.createDataFrame([(1, "studies passes things walked bus class")],
                               "doc_id int, content string")
    found = values(df, tx.clean_terms(F.col("content"), normalizer=tx.strip_suffix))
    assert found[1] == ["study", "pass", "thing", "walk", "bus", "class"]


def test_joined(spark):
    df = spark.createDataFrame([(1, ["a", "b"])], "doc_id int, t array<string>")
    assert values(df, tx.joined(F.col("t"))) == {1: "a, b"}


words = st.text(alphabet="abcXYZéñß1_ '.\ń黄", max_size=40)


@settings(max_examples=8, deadline=None)
@given(st.lists(words, min_size=1, max_size=30))
def test_clean_terms_on_random_text(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, content string")
    found = values(df, tx.clean_terms(F.col("content"), ["abc"]))
    assert found == {i: clean(t, ["abc"]) for i, t in enumerate(texts)}
    split = values(df, tx.whitespace_tokens(F.col("content")))
    for i, text in enumerate(texts):
        pieces = re.split(r"[ \t\n\x0b\f\r]", text.lower())
        while pieces and pieces[-1] == "" and text:
            pieces.pop()
        assert split[i] == pieces
