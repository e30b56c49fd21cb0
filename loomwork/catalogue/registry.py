"""The registry of queries, and the tables they read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import structure

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

LINES = "SELECT doc_id, unnest(range(len(l))) AS line_no, trim(unnest(l), ' ') AS line FROM (SELECT doc_id, string_split(replace(text, chr(13) || chr(10), chr(10)), chr(10)) AS l FROM documents)"
EVENTS = "SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos FROM events"


def registered(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        if f.__name__ in QUERIES:
            raise ValueError(f"two queries are called {f.__name__}")
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def step_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return structure.lines(read(spark, sf_dir, "documents"))


def step_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return structure.duplicate_ordinals(read(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], "pos0").withColumn("pos", (F.col("pos0") + 1).cast("long")).drop("pos0")
