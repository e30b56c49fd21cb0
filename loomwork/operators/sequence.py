"""Order-dependent passes as window functions; every pass names its total order."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _w(keys: list[str], order: list[str]) -> Window:
    return Window.partitionBy(*keys).orderBy(*order)


def lead_borrow(rows: DataFrame, keys: list[str], order: list[str], value: str, out: str) -> DataFrame:
    """A row without a value takes that of the row right after it."""
    return rows.withColumn(out, F.coalesce(F.col(value), F.lead(value).over(_w(keys, order))))


def islands(rows: DataFrame, keys: list[str], order: list[str], same: Column, out: str = "island") -> DataFrame:
    """Number of the unbroken stretch each row is in; `same` says whether a row continues the one before."""
    new = F.when(same, 0).otherwise(1)
    return rows.withColumn("__new", new).withColumn(out, F.sum("__new").over(_w(keys, order).rowsBetween(Window.unboundedPreceding, 0))).drop("__new")


def ancestor(rows: DataFrame, keys: list[str], order: str, depth: str, max_depth: int, out: str = "parent") -> DataFrame:
    """Order value of the nearest earlier row that is shallower."""
    before = _w(keys, [order]).rowsBetween(Window.unboundedPreceding, -1)
    pick = None
    for k in range(1, max_depth + 1):
        last = F.last(F.when(F.col(depth) < k, F.col(order)), ignorenulls=True).over(before)
        pick = F.when(F.col(depth) == k, last) if pick is None else pick.when(F.col(depth) == k, last)
    return rows.withColumn(out, pick)


def span_fill(rows: DataFrame, keys: list[str], order: list[str], mark: Column, out: str = "filled") -> DataFrame:
    """Between two neighbouring marks of equal value, that value."""
    w = _w(keys, order)
    before = F.last(mark, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    after = F.first(mark, ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing))
    return rows.withColumn(out, F.when(mark.isNull() & (before == after), before))


def exists_in_group(rows: DataFrame, keys: list[str], flag: Column, out: str) -> DataFrame:
    return rows.withColumn(out, F.max(F.when(flag, 1).otherwise(0)).over(Window.partitionBy(*keys)))


def before_first(rows: DataFrame, keys: list[str], order: str, start: Column, out: str = "early") -> DataFrame:
    """1 for rows before the group's first start; 0 after it or without one."""
    first = F.min(F.when(start, F.col(order))).over(Window.partitionBy(*keys))
    return rows.withColumn(out, F.when(F.col(order) < first, 1).otherwise(0))


def monotone_place(rows: DataFrame, keys: list[str], order: str, candidates: str, out: str = "placed") -> DataFrame:
    """In order, each row takes its smallest candidate that is not below the
    last one taken; a row without one takes none and leaves the floor alone.

    Path-dependent, so the rows of a key are read in order, one after another,
    with nothing held but the floor; a key of any length needs no more memory.
    """

    def place(frames):
        key, floor = None, None
        for frame in frames:
            taken = []
            for k, c in zip(zip(*(frame[x] for x in keys), strict=True), frame[candidates], strict=True):
                if k != key:
                    key, floor = k, None
                best = min((v for v in (c if c is not None else []) if v is not None and (floor is None or v >= floor)), default=None)
                floor = floor if best is None else best
                taken.append(best)
            yield frame[[*keys, order]].assign(**{out: pd.Series(taken, index=frame.index, dtype="Int64")})

    kinds = dict(rows.dtypes)
    dealt = rows.select(*keys, order, candidates).repartition(*keys).sortWithinPartitions(*keys, order)
    return dealt.mapInPandas(place, ", ".join(f"{k} {kinds[k]}" for k in [*keys, order]) + f", {out} bigint")


def next_nonzero(rows: DataFrame, keys: list[str], order: list[str], value: str, out: str = "next_value") -> DataFrame:
    """The next value after each row that is neither null nor zero."""
    w = _w(keys, order).rowsBetween(1, Window.unboundedFollowing)
    return rows.withColumn(out, F.first(F.nullif(F.col(value), F.lit(0)), ignorenulls=True).over(w))


def last_per_key(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    n = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("__n", n).where("__n = 1").drop("__n")


def top_k(rows: DataFrame, keys: list[str], order: list[Column], k: int, out: str = "rank") -> DataFrame:
    return rows.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(out) <= k)


def anchor_link(rows: DataFrame, keys: list[str], order: list[str], anchor: Column, out: str = "anchor") -> DataFrame:
    """The latest anchor strictly before each row."""
    return rows.withColumn(out, F.last(anchor, ignorenulls=True).over(_w(keys, order).rowsBetween(Window.unboundedPreceding, -1)))


def falls(rows: DataFrame, keys: list[str], order: list[str], value: str, out: str = "previous") -> DataFrame:
    """Rows whose value is below the one before in its group."""
    return rows.withColumn(out, F.lag(value).over(_w(keys, order))).where(F.col(out) > F.col(value))
