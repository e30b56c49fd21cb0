"""Data-quality gates as queries that count violations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def violations(checks: list[tuple[str, DataFrame, Column]]) -> DataFrame:
    """check_name, population, violations: one row per named rule, each one pass over its table."""
    rows = [df.agg(F.count(F.lit(1)).alias("population"), F.count_if(bad).alias("violations")).select(F.lit(name).alias("check_name"), "population", "violations") for name, df, bad in checks]
    return reduce(DataFrame.unionByName, rows)


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def orphans(rows: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    return rows.join(parent.select(F.col(parent_key).alias(key)), key, "left_anti")


def regressed(now: DataFrame, baseline: DataFrame, tolerance: float = 2.0) -> DataFrame:
    """metric, value on either side: metrics that fell by more than the tolerance; a missing baseline is 0."""
    b = baseline.select("metric", F.col("value").alias("before"))
    delta = F.col("value") - F.coalesce("before", F.lit(0.0))
    return now.join(b, "metric", "left").withColumn("delta", delta).where(F.col("delta") < -tolerance)
