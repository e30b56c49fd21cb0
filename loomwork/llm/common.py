"""Helpers shared by the training-text operators.

Every operator reads two columns of its input, an id and a text, under its
own internal names; extra input columns, whatever they are called, are never
touched.  A null text counts as an empty one unless an operator says otherwise.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.tables import settled


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


materialise = settled


def id_and_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns doc_id and text only; a null text becomes empty."""
    return df.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )


def id_and_raw_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def fold(id_col: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; null for a null id."""
    return F.crc32(id_col.cast("string").cast("binary")) % F.lit(n)


def texts(batch: pa.RecordBatch, name: str = "text") -> list[str | None]:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def arrow_rows(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    return df.mapInArrow(fn, schema)


def slices(spark: SparkSession, least: int = 64) -> int:
    """Into how many slices a hot key is dealt: as many as there are shuffle partitions, `least` at least."""
    return max(least, int(spark.conf.get("spark.sql.shuffle.partitions")))


def spread_groups(rows: DataFrame, key: list[str], id_col: str) -> DataFrame:
    """(key..., salt) -> smallest id and row count of the key's whole group.

    A group is first summed within each of its slices of ids (salt()), so that a
    key with a third of all rows reaches no task whole; then a key's partial
    rows, at most one a slice, are summed and handed back to its slices.
    Join rows on key and salt (see salt()) to learn about their group.
    """
    part = rows.groupBy(*key, salt(rows.sparkSession, id_col).alias("salt")).agg(
        F.min(id_col).alias("m"), F.count(F.lit(1)).alias("c")
    )
    return (
        part.groupBy(*key)
        .agg(F.min("m").alias("group_min"), F.sum("c").alias("group_rows"), F.collect_set("salt").alias("salts"))
        .select(*key, "group_min", "group_rows", F.explode("salts").alias("salt"))
    )


def salt(spark: SparkSession, id_col: str) -> Column:
    return F.pmod(F.xxhash64(F.col(id_col)), F.lit(slices(spark))).cast("int")
