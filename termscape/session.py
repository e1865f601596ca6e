"""Session helpers: the shared folder, tables that cut lineage, input parallelism."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, named by the cluster in ``spark.checkpoint.dir``.

    Without that setting it is the folder given to ``setCheckpointDir``. Only a local session
    without either gets a temporary folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        # in local mode driver and executors are one process; local-cluster is a cluster
        if context.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="termscape-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, below the application's own folder there."""
    application = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/termscape/{application}/{label}-{uuid.uuid4().hex}"


def frozen(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared folder and return the table.

    Cuts the lineage, keeps columns prunable, gives the optimizer real sizes, and survives the loss
    of any executor. A given ``path`` is overwritten, so that a loop can reuse its space.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, label)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a table that ``frozen`` wrote, through the file system that holds it."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def folders(spark: SparkSession, path: str, marked: str = "") -> list[str]:
    """Names of the folders in ``path``, only those with a file called ``marked`` if it is given; none if there is no such path."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(place):
        return []
    found = [entry.getPath() for entry in system.listStatus(place) if entry.isDirectory()]
    return [
        at.getName() for at in found
        if not marked or system.exists(jvm.org.apache.hadoop.fs.Path(at, marked))
    ]


def release_shuffles(spark: SparkSession) -> None:
    """Have the shuffle files of finished steps removed now.

    Spark removes them once the driver's garbage collector finds the step unused, which on a quiet
    driver can be half an hour later. Worth a call after a step that exchanged much.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


class Scratch:
    """Intermediate tables of one computation, deleted when it is done.

    Inside the ``with`` block ``table`` freezes intermediates; what the block returns must not read
    them any more, so freeze it with ``frozen``, or hand the object to whoever reads the result.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def table(self, df: DataFrame, label: str) -> DataFrame:
        path = scratch_path(self.spark, label)
        self.paths.append(path)
        return frozen(df, label, path)

    def drop_last(self, keep: int = 0) -> None:
        """Delete all tables but the ``keep`` latest."""
        cut = len(self.paths) - keep
        for path in self.paths[:cut]:
            discard(self.spark, path)
        self.paths = self.paths[cut:]

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        self.drop_last()


def at_most(df: DataFrame, rows: int) -> bool:
    """Whether ``df`` has at most ``rows`` rows; counts no further."""
    return df.limit(rows + 1).count() <= rows


#: Inputs with more file splits than this are never re-partitioned by ``spread``.
SMALL_SPLITS = 64


def spread(df: DataFrame, *key: str) -> DataFrame:
    """Give a small scanned input enough partitions to use every core.

    Only an input of at most ``SMALL_SPLITS`` splits that leaves cores idle is shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= min(cores, SMALL_SPLITS):
        return df
    return df.repartition(cores, *key)
