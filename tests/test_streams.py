"""Streams over the tables, which lie in one file or in a folder of several."""

import pytest

from termscape.plans import queries

TEXTS = ["red blue red", "blue green", "red", "", "green green green blue", "amber red red", None, "blue amber"]


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture
def folders(spark, tmp_path):
    """The same tables twice: in files, and in folders of files."""
    documents = spark.createDataFrame(
        [(n, TEXTS[n % len(TEXTS)], "en", "web", len(TEXTS[n % len(TEXTS)] or "")) for n in range(24)],
        "doc_id bigint, text string, lang string, source string, n_chars bigint",
    )
    turns = spark.createDataFrame(
        [(n, t, "user", TEXTS[(n + t) % len(TEXTS)]) for n in range(6) for t in range(2)],
        "conv_id bigint, turn bigint, role string, text string",
    )
    for name, df in (("documents", documents), ("conversations", turns)):
        df.repartition(4).write.parquet(str(tmp_path / "many" / f"{name}.parquet"))
        (tmp_path / "one").mkdir(exist_ok=True)
        df.toPandas().to_parquet(tmp_path / "one" / f"{name}.parquet", index=False)
    return str(tmp_path / "one"), str(tmp_path / "many")


def test_stream_term_counts_reads_every_file(spark, folders):
    for folder in folders:
        assert rows(queries.stream_term_counts(spark, folder)) == rows(queries.QUERIES["term_freq"](spark, folder))


def test_stream_growing_counts_reads_every_file(spark, folders):
    for folder in folders:
        assert rows(queries.stream_growing_counts(spark, folder)) == rows(queries.growing_counts(spark, folder))


def test_streams_read_every_row(spark, folders, tmp_path):
    for folder, at in zip(folders, ("one", "many"), strict=True):
        stream = queries._stream(spark, folder, "conversations")
        path = str(tmp_path / "out" / at)
        run = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", f"{path}-progress")
        run.trigger(availableNow=True).start().awaitTermination()
        assert rows(spark.read.parquet(path)) == rows(spark.read.parquet(f"{folder}/conversations.parquet"))
