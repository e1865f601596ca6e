"""Saves are complete or refused."""

import shutil

import pytest
from test_topics import subject_docs

from termscape.operators import matrix, svd
from termscape.sources import models


@pytest.fixture(scope="module")
def built(spark):
    docs = spark.createDataFrame(list(subject_docs()), "doc_id bigint, title string, content string")
    return matrix.build_from(docs, size=8)


def test_manifest_describes_the_tables(spark, built, tmp_path):
    path = str(tmp_path / "matrix")
    models.save_matrix(built, path)
    held = {r["name"]: r["rows"] for r in models.manifest(spark, path).collect()}
    assert held == {"vectors": built.vectors.count(), "vocabulary": 8, "size": 1}
    models.check_rows(spark, path)
    assert models.load_matrix(spark, path).vectors.schema == built.vectors.schema


def test_broken_off_saves_are_refused(spark, built, tmp_path, monkeypatch):
    path = str(tmp_path / "matrix")

    def broken(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(models, "_finish", broken)
        with pytest.raises(RuntimeError):
            models.save_matrix(built, path)
    with pytest.raises(models.UnfinishedSave):
        models.load_matrix(spark, path)
    with pytest.raises(models.UnfinishedSave):
        models.load_matrix(spark, str(tmp_path / "nothing"))


def test_lost_rows_are_found(spark, built, tmp_path):
    path = tmp_path / "concepts"
    models.save_concepts(svd.fit_concepts(built, 3), str(path))
    assert models.load_concepts(spark, str(path)).concepts.count() == 3
    models.check_rows(spark, str(path))
    for name in ("_SUCCESS", "._SUCCESS.crc"):
        (path / "titles" / name).unlink(missing_ok=True)
    part = next(f for f in (path / "titles").iterdir() if f.suffix == ".parquet")
    shutil.copy(part, path / "titles" / "again.parquet")
    with pytest.raises(models.UnfinishedSave, match="titles"):
        models.check_rows(spark, str(path))
    with pytest.raises(models.UnfinishedSave, match="without"):
        models.load_matrix(spark, str(path))
