"""Registered queries over streams: the driver's tables read as they come."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.tables import scratch
from ..streaming import kept
from .registry import EVENTS, read, registered


def _came(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """A table's files as a stream."""
    schema = read(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parquet*").select(*columns)


def _folder(spark: SparkSession, name: str) -> str:
    return f"{scratch(spark)}/{name}-{uuid.uuid4().hex}"


@registered(f"SELECT event_id, coalesce(bool_or(event_type = 'purchase') OVER (PARTITION BY user_id ORDER BY pos ROWS UNBOUNDED PRECEDING), false) AS bought FROM ({EVENTS})")
def latched_stream(spark, sf_dir):
    """Facts that stay true once they held, over a stream (§2.15, C10)."""
    rows = _came(spark, sf_dir, "events", "user_id", "event_id", "event_type", "ts").withColumn("at", F.struct("ts", "event_id")).drop("ts")
    folder, at = _folder(spark, "latched"), rows.schema["at"]
    state = T.StructType([rows.schema["user_id"], T.StructField("first", at.dataType)])
    kept.run(rows, folder, state, kept.latched(["user_id"], "at", F.col("event_type") == "purchase", "bought"))
    return kept.results(spark, folder, T.StructType([*rows.schema.fields, T.StructField("bought", T.BooleanType())])).select("event_id", "bought")


@registered("SELECT user_id, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC, value) = 1")
def newest_stream(spark, sf_dir):
    """The newest version of every key that a stream has brought (S3, K7)."""
    rows = _came(spark, sf_dir, "events", "user_id", "event_id", "value")
    folder = _folder(spark, "newest")
    kept.run(rows, folder, rows.schema, kept.newest(["user_id"], "event_id"))
    return kept.state(spark, folder, rows.schema)
