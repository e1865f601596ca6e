"""Lemma tables and the analyser hook."""

import pickle
import tracemalloc

import pyarrow as pa
import pytest
from pyspark.core.context import SparkContext

from termscape.operators import terms

DOCS = [(1, "t1", "Mice ate THE cheese; mice run"), (2, "t2", "running feet 42"), (3, "t3", "")]
LEMMAS = [("mice", "mouse"), ("ate", "eat"), ("running", "run"), ("feet", "foot"), ("Feet", "Foot")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "doc_id bigint, title string, content string")


@pytest.fixture(scope="module")
def lemmas(spark):
    return spark.createDataFrame(LEMMAS, "form string, lemma string")


def counted(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("limit, frequent", [(1000, 0), (0, 0), (0, 3), (0, 1000)])
def test_lemma_counts_by_broadcast_and_by_shuffle(docs, lemmas, monkeypatch, limit, frequent):
    monkeypatch.setattr(terms, "MAX_BROADCAST_LEMMAS", limit)
    monkeypatch.setattr(terms, "FREQUENT_FORMS", frequent)
    assert counted(terms.lemma_counts(docs, lemmas)) == sorted([
        (1, "mouse", 2), (1, "eat", 1), (1, "THE", 1), (1, "cheese", 1), (1, "run", 1),
        (2, "run", 1), (2, "Foot", 1), (2, "42", 1),
    ])


def test_document_lemmas(docs, lemmas):
    found = {r["doc_id"]: sorted(r["terms"]) for r in terms.document_lemmas(docs, lemmas).collect()}
    assert found == {1: ["cheese", "eat", "mouse", "mouse", "run"], 2: ["foot", "run"], 3: []}


def test_analyser_is_set_up_once_per_task(spark, docs):
    setups = spark.sparkContext.accumulator(0)

    def make():
        setups.add(1)
        return str.split

    found = terms.terms_with(docs.coalesce(1), make).collect()
    assert {r["doc_id"]: r["terms"] for r in found}[2] == ["running", "feet", "42"]
    assert setups.value == 1


def test_costly_columns_are_evaluated_once(docs):
    usable = terms.document_terms(docs).where("size(terms) > 1")
    plan = usable._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_extract_all") == 1


def test_analyser_holds_the_terms_of_few_texts(spark):
    """A batch has up to 10,000 texts; their terms are not all Python objects at once."""

    def make():
        def resident() -> int:
            with open("/proc/self/statm") as f:
                return int(f.read().split()[1]) * 4096

        return lambda text: [str(resident()), *(f"{text}-{i}" for i in range(20000))]

    many = spark.range(300).selectExpr("id AS doc_id", "concat('t', id) AS title", "string(id) AS content").coalesce(1)
    found = terms.terms_with(many, make).selectExpr("doc_id", "size(terms) AS n", "bigint(terms[0]) AS resident", "terms[20000] AS last")
    rows = found.collect()
    assert [(r["doc_id"], r["n"], r["last"]) for r in rows] == [(i, 20001, f"{i}-19999") for i in range(300)]
    assert max(r["resident"] for r in rows) - min(r["resident"] for r in rows) < 250 << 20


def test_lemmas_take_little_memory_in_a_worker(spark, monkeypatch):
    """What every worker unpacks is some 50 bytes a lemma; the words are looked up as before."""
    sent = []
    real = SparkContext.broadcast
    monkeypatch.setattr(SparkContext, "broadcast", lambda self, value: sent.append(value) or real(self, value))
    n = 50000
    table = spark.range(n).selectExpr("concat('form', id) AS form", "concat('lemma', id) AS lemma")
    lookup = terms.lemma_lookup(table)
    packed = pickle.dumps(sent[-1])
    before = pa.total_allocated_bytes()
    tracemalloc.start()
    held = pickle.loads(packed)
    used = tracemalloc.get_traced_memory()[0] + pa.total_allocated_bytes() - before
    tracemalloc.stop()
    assert len(held) and used < 80 * n
    found = spark.createDataFrame([(["FORM7", "other", "form49999", "form50000"],), ([],), (None,), ([None, "form1"],)], "words array<string>")
    assert [r[0] for r in found.coalesce(1).select(lookup(found["words"])).collect()] == [
        ["lemma7", "other", "lemma49999", "form50000"], [], None, [None, "lemma1"],
    ]
    nothing = terms.lemma_lookup(table.where("form is null"))
    assert [r[0] for r in found.limit(1).select(nothing(found["words"])).collect()] == [["FORM7", "other", "form49999", "form50000"]]
