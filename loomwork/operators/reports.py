"""What is reported: counts, worklists, changes between releases, and the projection that ships."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.tables import settled


def most_common(rows: DataFrame, value: Column | str, k: int, order: Column | str | None = None) -> DataFrame:
    """value, n: the k most frequent values, of equals the one seen first, or else the smaller (L1, L2)."""
    v = F.col(value) if isinstance(value, str) else value
    o = v if order is None else F.col(order) if isinstance(order, str) else order
    return rows.select(v.alias("value"), o.alias("__o")).where("value is not null").groupBy("value").agg(F.count(F.lit(1)).alias("n"), F.min("__o").alias("__o")).orderBy(F.desc("n"), "__o", "value").limit(k).select("value", "n")


def headed(rows: DataFrame, order: list[str], text: Column, k: int) -> DataFrame:
    """place, line: the first k lines and, where there are more, how many (L4)."""
    total = rows.count()
    head = rows.select(text.alias("line"), *order).orderBy(*order).limit(k)
    lines = head.select((F.row_number().over(Window.orderBy(*order)) - 1).cast("long").alias("place"), "line")
    if total <= k:
        return lines
    return lines.unionByName(rows.sparkSession.createDataFrame([(k, f"... and {total - k} more")], "place long, line string"))


def drawn(rows: DataFrame, key: str, k: int, seed: int = 7) -> DataFrame:
    """k rows, always the same ones for a seed: those whose keys hash lowest."""
    return rows.orderBy(F.xxhash64(F.col(key), F.lit(seed)), key).limit(k)


def annotation_coverage(steps: DataFrame, k: int = 40) -> DataFrame:
    """measure, value, n: steps by intent and confidence, the most common inferred names and the first words of steps without a verb.

    steps: raw, intent, confidence, target.
    """
    first = F.nullif(F.regexp_replace(F.regexp_extract("raw", r"^\s*(\S+)", 1), "^[:,.]+|[:,.]+$", ""), F.lit(""))
    steps = settled(steps.select("intent", "confidence", "target", first.alias("first")), "coverage")  # read four times
    count = lambda name, c: steps.groupBy(c.alias("value")).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("measure"), "value", "n")
    top = lambda name, rows, c: most_common(rows, c, k).select(F.lit(name).alias("measure"), "value", "n")
    return (
        count("intent", F.coalesce("intent", F.lit("-none-")))
        .unionByName(count("confidence", F.col("confidence")))
        .unionByName(top("inferred name", steps.where("confidence = 'inferred'"), F.col("target")))
        .unionByName(top("unhandled verb", steps.where("intent is null"), F.col("first")))
    )


def resolution_stats(resolved: DataFrame, curated: DataFrame) -> DataFrame:
    """measure, value, n: names by kind, by the reason why they have none, and curated choices that led nowhere.

    resolved: name, variant, kind, refusal; curated: name, choice.
    """
    by = lambda name, rows, c: rows.groupBy(F.col(c).alias("value")).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("measure"), "value", "n")
    failed = curated.join(resolved.where("kind is not null").select("name", F.col("variant").alias("choice")), ["name", "choice"], "left_anti")
    return by("kind", resolved.where("kind is not null"), "kind").unionByName(by("refusal", resolved.where("kind is null"), "refusal")).unionByName(failed.select(F.lit("choice failed").alias("measure"), F.col("name").alias("value"), F.lit(1).cast("long").alias("n")))


def flag_inventory(rows: DataFrame, key: str, flags: dict[str, Column]) -> DataFrame:
    """flag, n, first: how many rows raise each flag, and the smallest key among them; a flag that none raises has no row."""
    each = rows.select(key, F.explode(F.filter(F.array(*[F.when(c, F.lit(n)) for n, c in flags.items()]), lambda f: f.isNotNull())).alias("flag"))
    return each.groupBy("flag").agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("first"))


def goals(now: DataFrame, before: DataFrame, key: str, fields: list[str], status: Column) -> DataFrame:
    """key, status, changed: every goal with its status and the names of the fields that differ from the release before, sorted."""
    old = before.select(key, *[F.col(f).alias(f"__{f}") for f in fields], F.lit(True).alias("__had"))
    differs = [F.when(~F.col(f).eqNullSafe(F.col(f"__{f}")), F.lit(f)) for f in sorted(fields)]
    changed = F.when(F.col("__had"), F.array_join(F.filter(F.array(*differs), lambda x: x.isNotNull()), ",")).otherwise("new")
    return now.join(old, key, "left").select(key, status.alias("status"), changed.alias("changed"))


STRETCHES = 1024


def union_in_order(*tables: tuple[DataFrame, str]) -> DataFrame:
    """value, place: every value once, in the order of the tables and, within one, of its order column (X5).  tables: (rows with value, whole-number order column).

    Rows are numbered within STRETCHES stretches of each table's order, whose
    sizes are summed first; only those few sums meet in one task.
    """
    rows = None
    for n, (t, order) in enumerate(tables):
        one = t.select("value", F.struct(F.lit(n).alias("t"), F.col(order).cast("long").alias("o")).alias("at"))
        rows = one if rows is None else rows.unionByName(one)
    first = rows.groupBy("value").agg(F.min("at").alias("at")).select("value", "at.t", "at.o")
    ends = first.groupBy("t").agg(F.min("o").alias("low"), F.max("o").alias("high"))
    share = (F.col("o") - F.col("low")) / (F.col("high") - F.col("low") + 1)
    dealt = first.join(ends, "t").select("value", "t", "o", F.floor(share * STRETCHES).alias("s"))
    sums = dealt.groupBy("t", "s").agg(F.count(F.lit(1)).alias("n"))
    before = sums.select("t", "s", (F.sum("n").over(Window.orderBy("t", "s")) - F.col("n")).alias("before"))
    n = F.row_number().over(Window.partitionBy("t", "s").orderBy("o", "value")) - 1
    return dealt.withColumn("n", n).join(before, ["t", "s"]).select("value", (F.col("before") + F.col("n")).alias("place"))


def release_report(old: DataFrame, new: DataFrame, key: str, text: str, section: str) -> DataFrame:
    """section, status, n, first: what each section gained, lost or said otherwise, with the first text of each."""
    a = old.select(key, F.col(text).alias("__old"), F.col(section).alias("__os"))
    b = new.select(key, F.col(text).alias("__new"), F.col(section).alias("__ns"))
    status = F.when(F.col("__old").isNull(), "added").when(F.col("__new").isNull(), "removed").when(F.col("__old") != F.col("__new"), "reworded")
    met = a.join(b, key, "full").withColumn("status", status).where("status is not null").withColumn("section", F.coalesce("__ns", "__os")).withColumn("shown", F.coalesce("__new", "__old"))
    return met.groupBy("section", "status").agg(F.count(F.lit(1)).alias("n"), F.min_by("shown", key).alias("first"))


def worklist(problems: DataFrame, usages: DataFrame, most: int = 4) -> DataFrame:
    """name, n, examples: what a person should look at, the most used first by n (O2).  problems: name; usages: name, place, text."""
    n = F.row_number().over(Window.partitionBy("name").orderBy("place", "text"))
    met = problems.select("name").distinct().join(usages, "name", "left").withColumn("__n", n)
    some = F.transform(F.sort_array(F.collect_list(F.when((F.col("__n") <= most) & F.col("text").isNotNull(), F.struct("__n", "text")))), lambda s: s["text"])
    return met.groupBy("name").agg(F.count("text").alias("n"), F.array_join(some, " / ").alias("examples"))


def states(quests: DataFrame, key: str, value: str, text: str) -> DataFrame:
    """key, shown: the values of a quest in order, each with its text, for a person to read (O3)."""
    line = F.concat_ws(": ", F.col(value).cast("string"), F.col(text))
    return quests.groupBy(key).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(value, line.alias("l")))), lambda s: s["l"]), " | ").alias("shown"))


# --- what ships ------------------------------------------------------------


def projected(rows: DataFrame, columns: dict[str, Column], drop_empty: list[str] = ()) -> DataFrame:
    """Only the columns of the contract; those listed are null instead of empty."""
    empty = lambda c: F.when(F.size(c) > 0, c)
    return rows.select(*[(empty(c) if n in drop_empty else c).alias(n) for n, c in columns.items()])


def canonical(text: str, without: tuple[str, ...] = ()) -> str | None:
    """The JSON text with sorted keys and no blanks, the named keys left out at every depth; null for text that is no JSON."""

    def strip(x):
        if isinstance(x, dict):
            return {k: strip(v) for k, v in x.items() if k not in without}
        return [strip(v) for v in x] if isinstance(x, list) else x

    try:
        return json.dumps(strip(json.loads(text)), ensure_ascii=False, sort_keys=True, separators=(",", ":"))
    except (TypeError, ValueError):
        return None


def canonical_json(rows: DataFrame, text: str, out: str, without: tuple[str, ...] = ()) -> DataFrame:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame.assign(**{out: pd.Series([canonical(t, without) for t in frame[text]], index=frame.index, dtype=object)})

    return rows.mapInPandas(run, ", ".join(f"{c} {t}" for c, t in rows.dtypes) + f", {out} string")


def content_hash(text: Column) -> Column:
    """Sixteen hex digits over a canonical text; when something was made is no part of it."""
    return F.substring(F.sha2(text.cast("binary"), 256), 1, 16)


def same_content(old: DataFrame, new: DataFrame, key: str, text: str, without: tuple[str, ...]) -> DataFrame:
    """key, same: whether two documents are equal but for the named keys."""
    side = lambda rows, name: canonical_json(rows.select(key, text), text, "__c", without).select(key, content_hash(F.col("__c")).alias(name))
    met = side(old, "__old").join(side(new, "__new"), key, "full")
    return met.select(key, F.coalesce(F.col("__old") == F.col("__new"), F.lit(False)).alias("same"))
