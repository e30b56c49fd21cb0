"""Documents into ordered rows: lines, blocks, carried headers, counters, ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import id_text, short_hash


def lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, line_no from 0, line: trimmed, CRLF read as LF."""
    split = F.split(F.replace(F.col(text_col), F.lit("\r\n"), F.lit("\n")), "\n")
    return docs.select(id_col, F.posexplode(split).alias("line_no", "raw")).select(id_col, "line_no", F.trim("raw").alias("line"))


def classify(line: Column, rules: list[tuple[str, str]], default: str) -> Column:
    """The label of the first pattern that is found."""
    out = None
    for pattern, label in rules:
        out = F.when(line.rlike(pattern), label) if out is None else out.when(line.rlike(pattern), label)
    return out.otherwise(default)


def blocks(rows: DataFrame, keys: list[str], order: list[str], opens: Column, out: str = "block") -> DataFrame:
    """Number of the block of each row: opening rows so far."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(out, F.sum(F.when(opens, 1).otherwise(0)).over(w))


def carried(rows: DataFrame, keys: list[str], order: list[str], value: Column, out: str) -> DataFrame:
    """The latest non-null value up to and including each row."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(out, F.last(value, ignorenulls=True).over(w))


def counters(rows: DataFrame, keys: list[str], order: list[str], literal: Column, delta: Column, out: str = "value") -> DataFrame:
    """A counter that a literal sets and a delta moves; unset reads as 0."""
    seg = blocks(rows.withColumn("__lit", literal).withColumn("__delta", delta), keys, order, F.col("__lit").isNotNull(), "__seg")
    w = Window.partitionBy(*keys, "__seg").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    value = F.coalesce(F.first("__lit").over(w), F.lit(0)) + F.sum(F.coalesce("__delta", F.lit(0))).over(w)
    return seg.withColumn(out, value).drop("__lit", "__delta", "__seg")


def duplicate_ordinals(rows: DataFrame, keys: list[str], order: list[str], out: str = "dup") -> DataFrame:
    """0 for the first row of a key, then 1, 2, ..."""
    return rows.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1)


def stable_ids(rows: DataFrame, scope: str, text_col: str, order: list[str], out: str = "step_id") -> DataFrame:
    """First ten hex digits of SHA-1 over scope and normalised text; a repeat
    within its scope adds its ordinal.  Empty texts are left out first."""
    # A generator, so that the filter is not pushed below it and the text normalised twice.
    some = rows.withColumn("norm", F.explode(F.array(id_text(F.col(text_col))))).where("norm <> ''")
    numbered = duplicate_ordinals(some, [scope, "norm"], order)
    key = F.concat(F.col(scope).cast("string"), F.lit("|"), F.col("norm"), F.when(F.col("dup") > 0, F.concat(F.lit("#"), F.col("dup").cast("string"))).otherwise(""))
    return numbered.withColumn(out, short_hash(key))


def verb_rules(rows: DataFrame, text_col: str, rules: list[tuple[str, str]], out: str = "intent") -> DataFrame:
    """Intent of the first rule (in list order) whose phrase leads the text and
    ends at its end, a space, a colon or a hyphen."""
    lower, found = F.lower(F.col(text_col)), None
    for phrase, intent in rules:
        hit = (lower == phrase) | F.substring(lower, 1, len(phrase) + 1).isin(*[phrase + c for c in " :-"])
        found = F.when(hit, intent) if found is None else found.when(hit, intent)
    return rows.withColumn(out, found)
