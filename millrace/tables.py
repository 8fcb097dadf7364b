"""Reading the driver's tables and cutting lineage in shared storage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Folder of sessions on this machine alone that name none, and the tables that `stored` has written.
_local: list[str] = []
_written: list[str] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table `name` below `sf_dir`."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: spark.checkpoint.dir. Where it is unset, a session within one process (tests)
    gets a folder of its own; on a cluster that is an error, as no folder of one machine would do."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    if not _local:
        _local.append("file://" + tempfile.mkdtemp(prefix="spark-shared-"))
    return _local[0]


def stored(df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
    """Write `df` as a table in the shared folder and read it back: the lineage ends there and survives lost executors.

    A Parquet table is used instead of checkpoint() because it is compressed, is pruned by column on reading
    and is computed once. `drop_stored` deletes what was written.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/millrace-{uuid.uuid4().hex}"
    _written.append(path)
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def by_sorting(df: DataFrame) -> DataFrame:
    """`df`, whose joins are to shuffle and sort: for what grows with the input. Spark takes a stored table for as small as its
    compressed files, also after its rows are exploded, and would send hundreds of megabytes to the driver to broadcast them."""
    return df.hint("merge")


def delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def drop_stored(spark: SparkSession) -> None:
    """Delete the tables that `stored` has written since the last call; their results must have been read or written."""
    while _written:
        delete(spark, _written.pop())
