"""The jobs one after another on a small dump."""

from test_topics import SUBJECTS, subject_docs

from termscape.plans import jobs
from termscape.sources import models, tables


def write_dump(path):
    names = ["Alpha", "Beta", "Gamma", "Delta"]
    pages = []
    for doc, _, text in subject_docs():
        title = f"{names[doc % 4]} {'abcdefghij'[doc // 10]}{'klmnopqrst'[doc % 10]}"
        pages.append(
            f"<page><title>{title}</title><ns>0</ns><id>{doc}</id>"
            f"<revision><text bytes=\"1\">{text}</text></revision></page>\n"
        )
    path.write_text("<mediawiki>\n" + "".join(pages) + "</mediawiki>")


def test_jobs(spark, tmp_path):
    write_dump(tmp_path / "dump.xml")
    at = tables.Locations(str(tmp_path / "base"), str(tmp_path / "dump.xml"))
    jobs.documents_job(spark, at)
    assert tables.read_documents(spark, at.documents).count() == 41
    built = jobs.matrix_job(spark, at, 8)
    assert built.n_terms == 8
    model = jobs.svd_job(spark, at, 100)
    assert len(model.sigmas) <= 8
    assert models.load_concepts(spark, at.concepts).doc_factors.count() == built.n_documents
    topics = jobs.lda_job(spark, at, 2, 10, 26.0, 1.1)
    assert topics.doc_topics.count() == built.n_documents


def test_reports(spark):
    docs = spark.createDataFrame(
        list(subject_docs()), "doc_id bigint, title string, content string"
    )
    reports = jobs.lsa_reports(
        docs, 4, terms=["river"], titles=["t0"], question=["code", "disk", "tarantula"], n=4
    )
    related = {r["related"] for r in reports["terms for terms"].collect()}
    assert related == set(SUBJECTS[0])
    for name in ("documents for terms", "documents for documents"):
        assert all(int(r["title"][1:]) % 2 == 0 for r in reports[name].collect())
    assert all(int(r["title"][1:]) % 2 == 1 for r in reports["documents for question"].collect())
    assert [r["term"] for r in reports["unknown terms"].collect()] == ["tarantula"]
    assert reports["concept documents"].where("concept = 0").count() == 4


def test_lemmas_in_jobs(spark, tmp_path):
    docs = spark.createDataFrame(
        [(1, "a b", "rivers river streams"), (2, "c d", "river stream stream"), (3, "e f", "lake lake"), (4, "g h", "rivers rivers")],
        "doc_id bigint, title string, content string",
    )
    (tmp_path / "lemmas.tsv").write_text("rivers\triver\nstreams\tstream\n")
    lemmas = jobs.read_lemmas(spark, str(tmp_path / "lemmas.tsv"))
    at = tables.Locations(str(tmp_path / "base"))
    tables.write_documents(docs, at.documents)
    built = jobs.matrix_job(spark, at, 8, lemmas=lemmas)
    assert {r["term"] for r in built.vocabulary.collect()} == {"river", "stream"}  # in two documents each, twice at least in one
    reports = jobs.lsa_reports(docs, 2, terms=["river", "rivers"], n=3, lemmas=lemmas)
    assert {r["term"] for r in reports["terms for terms"].collect()} == {"river"}
    loaded = models.load_matrix(spark, at.matrix)
    assert (loaded.min_tf, loaded.n_terms) == (2, 2)
