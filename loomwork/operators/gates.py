"""Gates: rules over tables and small documents, as queries that return what breaks them."""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .conditions import problem


@dataclass(frozen=True)
class Rule:
    """A named test of rows: `bad` is true where a row breaks it; a null is no breach."""

    name: str
    bad: Column


def required(column: str) -> Rule:
    return Rule(f"{column} is missing", F.col(column).isNull())


def one_of(column: str, values: list) -> Rule:
    return Rule(f"{column} is not listed", ~F.col(column).isin(*values))


def matches(column: str, pattern: str) -> Rule:
    return Rule(f"{column} has another form", ~F.col(column).rlike(pattern))


def between(column: str, low: object = None, high: object = None) -> Rule:
    c = F.col(column)
    tests = [c < low] if low is not None else []
    return Rule(f"{column} is out of range", reduce(Column.__or__, tests + ([c > high] if high is not None else [])))


def unique_items(column: str) -> Rule:
    return Rule(f"{column} repeats an item", F.size(F.array_distinct(column)) < F.size(column))


def needs(column: str, *others: str) -> Rule:
    """Where the column is given, so are the others."""
    return Rule(f"{column} needs {', '.join(others)}", F.col(column).isNotNull() & reduce(Column.__or__, [F.col(o).isNull() for o in others]))


def any_of(name: str, *tests: Column) -> Rule:
    return Rule(name, ~reduce(Column.__or__, [F.coalesce(t, F.lit(False)) for t in tests]))


def if_then(name: str, when: Column, then: Column) -> Rule:
    return Rule(name, F.coalesce(when, F.lit(False)) & ~F.coalesce(then, F.lit(False)))


def broken(rows: DataFrame, key: str, rules: list[Rule]) -> DataFrame:
    """key, rule: one row for every rule that a row breaks; one pass over the table (V1)."""
    names = F.array(*[F.when(r.bad, F.lit(r.name)) for r in rules])
    return rows.select(F.col(key), F.explode(F.filter(names, lambda n: n.isNotNull())).alias("rule"))


def guide_invariants(sections: DataFrame, steps: DataFrame, episodes: DataFrame, migrations: DataFrame) -> DataFrame:
    """rule, subject: what a schema cannot say (V2).

    sections: section_id, slug, continuation_of; steps: step_id, section_id,
    ordinal; episodes: ordinal, section_id; migrations: old_id, new_id.
    """
    breach = lambda rows, rule, subject: rows.select(F.lit(rule).alias("rule"), F.col(subject).cast("string").alias("subject"))
    twice = lambda rows, c: rows.groupBy(c).count().where("count > 1")
    ids = sections.select(F.col("section_id").alias("__id"))
    dense = steps.withColumn("__n", F.row_number().over(Window.partitionBy("section_id").orderBy("ordinal", "step_id")) - 1).where("ordinal <> __n").select("section_id").distinct()
    lost = sections.where("continuation_of is not null").join(ids, F.col("continuation_of") == F.col("__id"), "left_anti")
    unknown = episodes.join(ids, F.col("section_id") == F.col("__id"), "left_anti").select("ordinal").distinct()
    dangling = migrations.join(steps.select("step_id"), F.col("new_id") == F.col("step_id"), "left_anti")
    return (
        breach(twice(steps, "step_id"), "step id repeats", "step_id")
        .unionByName(breach(twice(sections, "slug"), "slug repeats", "slug"))
        .unionByName(breach(lost, "continues an unknown section", "section_id"))
        .unionByName(breach(dense, "ordinals have gaps", "section_id"))
        .unionByName(breach(unknown, "episode names an unknown section", "ordinal"))
        .unionByName(breach(dangling, "migration leads nowhere", "old_id"))
    )


def image_problems(images: DataFrame, url: str, hashes: DataFrame, prefix: str, key: str | None = None) -> DataFrame:
    """url, problem: images on another host, without a recorded hash, or with one that is none (V3).

    A hash is recorded under `key`, once each; the key is the url itself unless
    one address can stand for several images.
    """
    key = key or url
    h = hashes.select(F.col(key).alias("__key"), F.col("sha256").alias("__sha"))
    why = F.when(~F.startswith(F.col(url), F.lit(prefix)), "unexpected host").when(F.col("__sha").isNull(), "no recorded hash").when(~F.col("__sha").rlike("^[0-9a-f]{64}$"), "malformed hash")
    return images.join(h, F.col(key) == F.col("__key"), "left").select(F.col(url).alias("url"), why.alias("problem")).where("problem is not null")


def curated_problems(rows: DataFrame, key: str, value: str, authority: DataFrame, known: str, severity: str = "error") -> DataFrame:
    """severity, key, value: entries of a curated table that name nothing the authority has (V7)."""
    a = authority.select(F.col(known).alias("__known")).where("__known is not null").distinct()
    lost = rows.where(F.col(value).isNotNull()).join(a, F.col(value) == F.col("__known"), "left_anti")
    return lost.select(F.lit(severity).alias("severity"), F.col(key).cast("string").alias("key"), F.col(value).cast("string").alias("value"))


def checked(problems: DataFrame) -> DataFrame:
    """The notes, if there is nothing worse; errors stop the run and are named (V8)."""
    worst = [f"{r.key}: {r.value}" for r in problems.where("severity = 'error'").orderBy("key", "value").limit(5).collect()]
    if worst:
        raise ValueError("curated tables name unknown things: " + "; ".join(worst))
    return problems


def fresh(stored: DataFrame, source: DataFrame, key: str, text: str) -> DataFrame:
    """key, is_fresh: whether the hash that an artifact was made from is still that of its source (V9).  stored: key, source_hash."""
    now = source.select(F.col(key), F.sha2(F.col(text).cast("binary"), 256).alias("__now"))
    return stored.join(now, key, "left").select(key, F.coalesce(F.col("source_hash") == F.col("__now"), F.lit(False)).alias("is_fresh"))


# --- locks and conditions of a document ------------------------------------

DIAL_SIZE, DIALS = (2, 128), (2, 8)


def lock_problem(lock: dict) -> str | None:
    """Why a lock could not be solved by its own numbers, or none (V6)."""
    whole = lambda x, least: isinstance(x, int) and not isinstance(x, bool) and x >= least
    size, cycles = lock.get("size"), lock.get("cycles") or []
    if not whole(size, DIAL_SIZE[0]) or size > DIAL_SIZE[1]:
        return "dial size"
    if missing := [n for n in ("parent", "submit") if not whole(lock.get(n), 1)]:
        return missing[0]
    if not DIALS[0] <= len(cycles) <= DIALS[1]:
        return "number of dials"
    arrows: list[int] = []
    for dial in cycles:
        if not whole(dial.get("target"), 0) or dial["target"] >= size:
            return "target"
        if any(not whole(dial.get(n), 0) for n in ("varc", "down", "up")):
            return "control"
        arrows += [dial["down"], dial["up"]]
    return "control used twice" if len(set(arrows)) < len(arrows) else None


def document_problems(rows: DataFrame, key: str, text: str, kind: str) -> DataFrame:
    """key, problem of every JSON text that is no sound lock or condition (kind says which of the two it has to be)."""
    test = lock_problem if kind == "lock" else problem

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for k, t in zip(frame[key], frame[text], strict=True):
                try:
                    why = test(json.loads(t)) if t is not None else "nothing"
                except (ValueError, AttributeError):
                    why = "unreadable"
                if why:
                    out.append((k, why))
            yield pd.DataFrame(out, columns=[key, "problem"], dtype=object)

    return rows.select(key, text).mapInPandas(run, f"{key} {dict(rows.dtypes)[key]}, problem string")
