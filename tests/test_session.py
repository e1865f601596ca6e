"""The shared folder and the session helpers."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from termscape import session


def fake(master, folder=None, set_before=None):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: folder),
        sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: set_before),
    )


def test_the_named_folder_is_used():
    assert session.shared_folder(fake("yarn", "hdfs:///shared/")) == "hdfs:///shared"


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "local-cluster[2,1,512]"])
def test_a_cluster_needs_a_named_folder(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(fake(master))
    assert session.shared_folder(fake(master, set_before="hdfs:///c/")) == "hdfs:///c"


def test_frozen_tables_can_reuse_a_path(spark):
    path = session.scratch_path(spark, "test")
    first = session.frozen(spark.range(5), "test", path)
    assert first.count() == 5
    second = session.frozen(spark.range(7), "test", path)
    assert second.count() == 7
    plan = second._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan


def test_at_most(spark):
    assert session.at_most(spark.range(5), 5) and not session.at_most(spark.range(6), 5)


def test_spread_shuffles_small_inputs_only(spark, tmp_path):
    cores = spark.sparkContext.defaultParallelism
    spark.range(100).coalesce(1).write.parquet(str(tmp_path / "one"))
    small = session.spread(spark.read.parquet(str(tmp_path / "one")), "id")
    assert small.rdd.getNumPartitions() == cores
    wide = spark.range(0, 100, 1, cores)
    assert session.spread(wide, "id") is wide


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    from termscape.operators.filters import filter_titles, find_by_title

    docs = spark.range(10).select(
        F.col("id").alias("doc_id"), F.lit("t").alias("title"), F.lit("x").alias("content")
    )
    docs.write.parquet(str(tmp_path / "docs"))
    read = spark.read.parquet(str(tmp_path / "docs"))
    plan = find_by_title(filter_titles(read), "t")._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan
    assert "TakeOrderedAndProject" in plan
    by_id = read.where("doc_id = 3")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(doc_id,3)" in by_id


def test_scratch_tables_go(spark):
    import os

    with session.Scratch(spark) as scratch:
        first, second = (scratch.table(spark.range(n), "scratch") for n in (3, 4))
        places = [p.removeprefix("file:") for p in scratch.paths]
        assert (first.count(), second.count()) == (3, 4)
        scratch.drop_last(keep=1)
        assert [os.path.exists(p) for p in places] == [False, True]
    assert not os.path.exists(places[1])
    session.release_shuffles(spark)
