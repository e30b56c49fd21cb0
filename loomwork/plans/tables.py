"""Written tables that end a plan's lineage, in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir.

    Only a single machine (a master of local threads, as in the tests) may do
    without the setting: there a folder is made and recorded in the session.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="loomwork-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def scratch(spark: SparkSession) -> str:
    """This application's own part of the shared folder."""
    return f"{shared_folder(spark)}/loomwork-{spark.sparkContext.applicationId}"


def settled(df: DataFrame, name: str) -> DataFrame:
    """df written and read back: a lost executor costs only a reread, and what follows has a plan of its own.

    No mark of success is written, as nothing but this session reads the table:
    for that file the driver would start `chmod` twice a table, and until such a
    child runs it counts as much memory as the whole driver.
    """
    spark = df.sparkSession
    path = f"{scratch(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def beside(left: DataFrame, right: DataFrame, on: list[str] | Column | list[Column], how: str = "inner") -> DataFrame:
    """left joined to a side that grows with the input: both are shuffled and sorted.

    What a settled table weighs as packed files says little of what it weighs as
    rows, and less of what an explode or a function over its rows makes of it, so
    by its files' size Spark would send a side of hundreds of MB through the
    driver to every executor.
    """
    return left.join(right.hint("merge"), on, how)


def clear(spark: SparkSession) -> None:
    """Deletes all that this application has settled; results that still read it must be written before."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
