"""Tables written once between two parts of a computation."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def staging_folder(spark: SparkSession) -> str:
    """The shared folder the cluster names in spark.checkpoint.dir.

    Only a local session without that setting gets a temporary folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="fieldheat-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def stage(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write a table that is read several times, and read it back.

    The copy survives lost executors, and its size is known, so joins to it are planned on facts.
    It is removed when the application ends. `compression` is Parquet's, the session's unless given.
    """
    spark = df.sparkSession
    path = f"{staging_folder(spark)}/{name}-{uuid.uuid4().hex}"
    writer = df.write if compression is None else df.write.option("compression", compression)
    writer.parquet(path)
    remove_at_end(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def stage_in_buckets(
    df: DataFrame, name: str, by: Sequence[str], buckets: int, compression: str | None = None
) -> DataFrame:
    """The same, in buckets of some columns: what groups or joins the copy by these columns, or more, is not shuffled.

    Rows that are dealt into as many parts by these columns already are written as they are, a bucket a task; others are dealt
    once. The table has a name only while it is written. Spark reads buckets together from one table, not from several united.
    """
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    path = f"{staging_folder(spark)}/{table}"
    writer = df.repartition(buckets, *by).write.bucketBy(buckets, *by).option("path", path)
    if compression is not None:
        writer = writer.option("compression", compression)
    remove_at_end(spark, path)
    try:
        writer.saveAsTable(table)
        return spark.table(table)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def remove_at_end(spark: SparkSession, path: str) -> None:
    """Have a folder removed when the application ends."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop_path)
