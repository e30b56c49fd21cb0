"""State that lasts from one run to the next over growing folders of files.

A run reads what has come since the last one (availableNow) in micro-batches.
What is known after a batch is a table of its own, written under the batch's
number, and so are the batch's results: a batch that is repeated after a loss
reads the state before it and overwrites only what it wrote itself.  Nothing is
held in memory or in a worker between batches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Step = Callable[[DataFrame, DataFrame], tuple[DataFrame, DataFrame]]


def _versions(spark: SparkSession, folder: str) -> list[int]:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
    whole = lambda n: fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{n}/_SUCCESS"))
    return sorted(int(n[2:]) for n in names if n.startswith("b=") and whole(n))


def state(spark: SparkSession, folder: str, schema: T.StructType, before: int | None = None) -> DataFrame:
    """What was known after the last batch (or the last one before the given); an empty table at first."""
    known = [v for v in _versions(spark, f"{folder}/state") if before is None or v < before]
    return spark.read.schema(schema).parquet(f"{folder}/state/b={known[-1]}") if known else spark.createDataFrame([], schema)


def results(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """The results of all batches so far."""
    done = [f"{folder}/rows/b={v}" for v in _versions(spark, f"{folder}/rows")]
    return spark.read.schema(schema).parquet(*done) if done else spark.createDataFrame([], schema)


def run(source: DataFrame, folder: str, schema: T.StructType, step: Step) -> None:
    """Every batch of a stream that has come: step(state before it, its rows) gives the state after it and its results.

    folder lies where driver and executors can see it; it holds the stream's own
    checkpoint too, so the next run goes on where this one ended.
    """
    spark = source.sparkSession

    def batch(rows: DataFrame, number: int) -> None:
        after, out = step(state(rows.sparkSession, folder, schema, number), rows)
        after.write.mode("overwrite").parquet(f"{folder}/state/b={number}")
        out.write.mode("overwrite").parquet(f"{folder}/rows/b={number}")

    query = source.writeStream.foreachBatch(batch).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    if query.exception():
        raise RuntimeError(str(query.exception()))


def newest(keys: list[str], version: str) -> Step:
    """State: the row of the highest version of every key (S3, K7); results: the rows that became it, which is what has to be fetched again.

    Of rows with equal versions the first to come stays, within a batch the one
    that sorts first.
    """

    def step(before: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        columns = rows.columns
        best = rows.groupBy(*keys).agg(F.max(version).alias("__top"))
        first = rows.join(best, keys).where(F.col(version) == F.col("__top")).groupBy(*keys).agg(F.min(F.struct(*columns)).alias("__r")).select("__r.*")
        old = before.select(*keys, F.struct(*columns).alias("__old"))
        new = first.select(*keys, F.struct(*columns).alias("__new"))
        met = new.join(old, keys, "full")
        newer = F.col("__new").isNotNull() & (F.col("__old").isNull() | (F.col("__new")[version] > F.col("__old")[version]))
        return met.select(F.when(newer, F.col("__new")).otherwise(F.col("__old")).alias("r")).select("r.*"), met.where(newer).select("__new.*")

    return step


def latched(keys: list[str], order: str, cond: Column, out: str = "latched") -> Step:
    """State: the first place at which the condition held for every key; results: the rows, each with whether it held there or before (§2.15).

    Batches bring a key's rows in order; rows of one batch may come in any.
    """

    def step(before: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        now = rows.where(cond).groupBy(*keys).agg(F.min(order).alias("first"))
        after = before.unionByName(now).groupBy(*keys).agg(F.min("first").alias("first"))
        held = F.coalesce(F.col(order) >= F.col("first"), F.lit(False))
        return after, rows.join(after, keys, "left").withColumn(out, held).drop("first")

    return step
