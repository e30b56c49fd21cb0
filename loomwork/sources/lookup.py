"""Keyed lookups behind a cache, change detection, first-wins dimensions, commented tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BATCH = 50


def missing(keys: DataFrame, cache: DataFrame, key: str) -> DataFrame:
    """Distinct keys that the cache has no row for; a cached null is an answer."""
    return keys.select(key).where(F.col(key).isNotNull()).distinct().join(cache.select(key), key, "left_anti")


def fetched(keys: DataFrame, key: str, fetch: Callable[[list], dict], value_type: str = "string", batch: int = BATCH, strict: bool = True) -> DataFrame:
    """key, value for every key, asked for in batches; keys without an answer get null, to be cached too.

    Unless strict, a batch that fails has no answers (S2).

    Append the result to the cache before reading on: a lost executor asks again.
    """

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            names = frame[key].tolist()
            for a in range(0, len(names), batch):
                part = names[a : a + batch]
                try:
                    answer = fetch(part)
                except Exception:
                    if strict:
                        raise
                    answer = {}
                yield pd.DataFrame({key: part, "value": [answer.get(k) for k in part]})

    return keys.select(key).mapInPandas(ask, f"{key} {dict(keys.dtypes)[key]}, value {value_type}")


def looked_up(keys: DataFrame, key: str, path: str, fetch: Callable[[list], dict]) -> DataFrame:
    """Every key row with its value; what the cache at `path` lacks is asked for and written there first, answers or none (K7)."""
    from .files import optional_json

    spark, schema = keys.sparkSession, f"{key} {dict(keys.dtypes)[key]}, value string"
    new = fetched(missing(keys, optional_json(spark, path, schema), key), key, fetch)
    new.write.mode("append").option("ignoreNullFields", "false").json(path)
    return resolved(keys, optional_json(spark, path, schema), key)


def resolved(keys: DataFrame, cache: DataFrame, key: str) -> DataFrame:
    """Every key row with its cached value."""
    return keys.join(cache.select(key, "value"), key, "left")


def changed(now: DataFrame, seen: DataFrame, key: str, version: str) -> DataFrame:
    """Rows that are new, or whose version differs from the one seen."""
    return now.join(seen.select(key, version), [key, version], "left_anti")


def first_wins(rows: DataFrame, key: str, order: list[str | Column]) -> DataFrame:
    """One row per key without regard to case: the first in the given order."""
    n = F.row_number().over(Window.partitionBy(F.lower(key)).orderBy(*order))
    return rows.withColumn("__n", n).where("__n = 1").drop("__n")


def commented_table(lines: DataFrame, keys: list[str], order: str, line: str, legend: str) -> DataFrame:
    """Tab-separated rows, each with the latest comment line above it that is no legend."""
    is_note = F.col(line).startswith("#")
    label = F.when(is_note & ~F.col(line).rlike(legend), F.trim(F.regexp_replace(line, "^#+", "")))
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    carried = lines.withColumn("label", F.last(label, ignorenulls=True).over(w))
    return carried.where(~is_note & (F.trim(line) != "")).select(*keys, order, "label", F.split(line, "\t").alias("cells"))
