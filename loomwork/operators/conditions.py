"""Conditions as data: checked, compiled to one boolean Column, latched over time.

A condition is a dict with one key, its shape.  `unknown` (null) spreads: a
compound with a part that cannot be read is itself unknown, whatever the other
parts say, unlike AND and OR in SQL.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.tables import settled

VAR_KINDS, SCENE_KINDS = ("varbit", "varplayer"), ("npc", "object", "groundItem")
COMPARE: dict[str, Callable[[Column, int], Column]] = {
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
}


@dataclass(frozen=True)
class State:
    """Columns that conditions read; what is not given makes conditions on it unknown."""

    values: Column | None = None  # map "kind:id" -> long
    held: Column | None = None  # map id -> count; an id that is absent is held 0 times
    at: Column | None = None  # array x, y, plane
    scene: Column | None = None  # array of "kind:id"
    screens: Column | None = None  # array of group ids
    shown: Column | None = None  # map "group:child" -> text
    said: Column | None = None  # text
    speaker: Column | None = None  # text
    kept: Column | None = None  # map key -> boolean


def _var(b: dict, s: State) -> Column:
    now = F.try_element_at(s.values, F.lit(f"{b['kind']}:{b['id']}"))
    if b.get("bit") is not None:
        return F.getbit(now, F.lit(b["bit"])) == int(b["set"])
    return COMPARE[b["op"]](now, b["value"])


def _item(b: dict, s: State) -> Column:
    counts = [F.coalesce(F.try_element_at(s.held, F.lit(i)), F.lit(0)) for i in b["ids"]]
    return reduce(Column.__add__, counts) >= b.get("count", 1)


def _zone(b: list, s: State) -> Column:
    inside = [reduce(Column.__and__, [s.at[k].between(min(box[k], box[k + 3]), max(box[k], box[k + 3])) for k in range(3)]) for box in b]
    return reduce(Column.__or__, inside)


def _here(b: dict, s: State) -> Column:
    return F.arrays_overlap(s.scene, F.array(*[F.lit(f"{b['kind']}:{i}") for i in b["ids"]]))


def _words(text: Column, said: Sequence[str]) -> Column:
    return reduce(Column.__and__, [F.contains(text, F.lit(w)) for w in said])


def _widget(b: dict, s: State) -> Column:
    return _words(F.try_element_at(s.shown, F.lit(f"{b['group']}:{b['child']}")), b["text"])


def _dialog(b: dict, s: State) -> Column:
    hit = _words(s.said, b["text"])
    return hit & (s.speaker == b["speaker"]) if b.get("speaker") else hit


def _kept(b: dict, s: State) -> Column:
    """True once it was kept; until then what the inner condition says now."""
    return F.when(F.try_element_at(s.kept, F.lit(b["key"])), True).otherwise(holds(b["when"], s))


def _joined(join: Callable[[Column, Column], Column]) -> Callable[[list, State], Column]:
    def read(parts: list, s: State) -> Column:
        cols = [holds(p, s) for p in parts]
        known = reduce(Column.__and__, [c.isNotNull() for c in cols])
        return F.when(known, reduce(join, cols))

    return read


#: By shape: the state it needs, and how it is read.
READERS: dict[str, tuple[str | None, Callable]] = {
    "var": ("values", _var),
    "item": ("held", _item),
    "zone": ("at", _zone),
    "here": ("scene", _here),
    "open": ("screens", lambda b, s: F.array_contains(s.screens, b)),
    "widget": ("shown", _widget),
    "dialog": ("said", _dialog),
    "memory": ("kept", _kept),
    "once": ("kept", _kept),
    "not": (None, lambda b, s: ~holds(b, s)),
    "all": (None, _joined(Column.__and__)),
    "any": (None, _joined(Column.__or__)),
}


def _all_words(x: object) -> bool:
    return isinstance(x, list) and bool(x) and all(isinstance(w, str) and w for w in x)


def _var_ok(b: dict) -> bool:
    if b.get("kind") not in VAR_KINDS or b.get("id") is None:
        return False
    return isinstance(b.get("set"), bool) if b.get("bit") is not None else b.get("value") is not None and b.get("op") in COMPARE


def _inner_ok(b: dict) -> bool:
    return isinstance(b.get("key"), str) and bool(b["key"]) and problem(b.get("when")) is None


SHAPES: dict[str, Callable[..., bool]] = {
    "var": _var_ok,
    "item": lambda b: bool(b.get("ids")),
    "zone": lambda b: bool(b) and all(isinstance(box, list) and len(box) >= 6 for box in b),
    "here": lambda b: b.get("kind") in SCENE_KINDS and bool(b.get("ids")),
    "open": lambda b: isinstance(b, int),
    "widget": lambda b: isinstance(b.get("group"), int) and isinstance(b.get("child"), int) and _all_words(b.get("text")),
    "dialog": lambda b: _all_words(b.get("text")) and isinstance(b.get("active", False), bool) and (b.get("speaker") is None or isinstance(b["speaker"], str)),
    "memory": _inner_ok,
    "once": _inner_ok,
    "not": lambda b: problem(b) is None,
    "all": lambda b: bool(b) and all(problem(p) is None for p in b),
    "any": lambda b: bool(b) and all(problem(p) is None for p in b),
}


def problem(cond: object) -> str | None:
    """Why a condition cannot be evaluated, or None."""
    if not isinstance(cond, dict) or len(cond) != 1:
        return "not one shape"
    ((shape, body),) = cond.items()
    if shape not in SHAPES:
        return f"unknown shape {shape}"
    try:
        return None if SHAPES[shape](body) else f"malformed {shape}"
    except (AttributeError, TypeError):
        return f"malformed {shape}"


def holds(cond: dict, s: State) -> Column:
    if problem(cond) is not None:
        return F.lit(None).cast("boolean")
    ((shape, body),) = cond.items()
    needs, read = READERS[shape]
    return read(body, s) if needs is None or getattr(s, needs) is not None else F.lit(None).cast("boolean")


def branch(rules: Sequence[tuple[dict, str]], default: str, s: State) -> Column:
    """Name of the first rule that holds; one that is unknown is passed over."""
    return F.coalesce(*[F.when(holds(c, s), F.lit(n)) for c, n in rules], F.lit(default))


def latched(rows: DataFrame, keys: list[str], order: list[str], cond: Column, out: str = "latched") -> DataFrame:
    """Whether the condition held on this row or any earlier one of its group."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(out, F.coalesce(F.bool_or(cond).over(w), F.lit(False)))


# --- conditions that rows bring with them ------------------------------------


def _readable(texts: pd.Series) -> pd.Series:
    def test(text: str | None) -> bool:
        try:
            return text is not None and problem(json.loads(text)) is None
        except ValueError:
            return False

    return texts.map(test).astype(bool)


def nodes(conditions: DataFrame, text: str) -> DataFrame:
    """cond, path, parent, depth, shape, body: every part of every distinct readable condition (JSON), level by level.

    A path is the parent's with the part's place behind it; a leaf has no part of its own.
    """
    level = conditions.select(F.col(text).alias("cond")).where("cond is not null").distinct().where(F.pandas_udf(_readable, "boolean")("cond"))
    level = level.select("cond", F.lit("0").alias("path"), F.lit(None).cast("string").alias("parent"), F.col("cond").alias("text"))
    shape = F.element_at(F.json_object_keys("text"), 1)
    parts = F.when(F.col("shape").isin("all", "any"), F.from_json("body", "array<string>")).when(F.col("shape") == "not", F.array("body")).when(F.col("shape").isin("memory", "once"), F.array(F.get_json_object("body", "$.when")))
    found, depth = None, 0
    while True:
        here = level.withColumn("shape", shape).withColumn("body", F.expr("get_json_object(text, concat('$.', shape))")).withColumn("depth", F.lit(depth)).drop("text")
        here = settled(here, "conditions")
        if here.isEmpty():
            return here if found is None else found
        found = here if found is None else found.unionByName(here)
        level = here.select("cond", F.col("path").alias("parent"), F.posexplode(parts).alias("nth", "text")).select("cond", F.concat_ws(".", "parent", F.col("nth").cast("string")).alias("path"), "parent", "text")
        depth += 1


def _leaf(s: State) -> Column:
    """What a leaf says of a row; a null where the state it asks is not given."""
    at = lambda path, kind="string": F.get_json_object("body", f"$.{path}").cast(kind)
    listed = lambda path, kind: F.from_json(F.get_json_object("body", f"$.{path}"), f"array<{kind}>")
    words = lambda text: F.forall(listed("text", "string"), lambda w: F.contains(text, w))
    out = F.lit(None).cast("boolean")

    def when(shape: str, given: Column | None, read: Callable[[], Column]) -> None:
        nonlocal out
        if given is not None:
            out = F.when(F.col("shape") == shape, read()).otherwise(out)

    def var() -> Column:
        now, value, by_op = F.try_element_at(s.values, F.concat_ws(":", at("kind"), at("id"))), at("value", "long"), F.lit(None).cast("boolean")
        for op, compare in COMPARE.items():
            by_op = F.when(at("op") == op, compare(now, value)).otherwise(by_op)
        return F.when(at("bit").isNotNull(), F.getbit(now, at("bit", "int")) == F.when(at("set") == "true", 1).otherwise(0)).otherwise(by_op)

    when("var", s.values, var)
    when("item", s.held, lambda: F.aggregate(listed("ids", "int"), F.lit(0).cast("long"), lambda n, i: n + F.coalesce(F.try_element_at(s.held, i), F.lit(0))) >= F.coalesce(at("count", "long"), F.lit(1)))
    inside = lambda box: F.forall(F.array(*map(F.lit, range(3))), lambda k: F.get(s.at, k).between(F.least(F.get(box, k), F.get(box, k + 3)), F.greatest(F.get(box, k), F.get(box, k + 3))))
    when("zone", s.at, lambda: F.exists(F.from_json("body", "array<array<long>>"), inside))
    when("here", s.scene, lambda: F.arrays_overlap(s.scene, F.transform(listed("ids", "string"), lambda i: F.concat_ws(":", at("kind"), i))))
    when("open", s.screens, lambda: F.array_contains(s.screens, F.col("body").cast("int")))
    when("widget", s.shown, lambda: words(F.try_element_at(s.shown, F.concat_ws(":", at("group"), at("child")))))
    if s.said is not None:
        speaker = F.lit(None).cast("string") if s.speaker is None else s.speaker
        when("dialog", s.said, lambda: F.when(F.coalesce(at("speaker"), F.lit("")) != "", words(s.said) & (speaker == at("speaker"))).otherwise(words(s.said)))
    return out


def hold(rows: DataFrame, key: str, text: str, s: State) -> DataFrame:
    """key, holds: whether each row's own condition (JSON in `text`) holds of that row's state (§2.15).

    Distinct conditions are flattened once into nodes; leaves are read for the
    rows that bring them, and parents are decided level by level from the
    deepest.  A null condition, one that cannot be read, and a compound of which
    any part is unknown are unknown.  Keys are unique.
    """
    tree = settled(nodes(rows, text), "nodes")
    inner = F.col("shape").isin("all", "any", "not", "memory", "once")
    asked = rows.withColumn("cond", F.col(text))
    kept = F.lit(None).cast("boolean") if s.kept is None else F.coalesce(F.try_element_at(s.kept, F.get_json_object("body", "$.key")), F.lit(False))
    says = F.when(F.col("shape").isin("memory", "once"), kept).when(~inner, _leaf(s))
    deepest = tree.agg(F.max("depth")).first()[0]
    none = F.lit(None).cast("boolean")
    if deepest is None:
        return rows.select(key, none.alias("holds"))
    each = settled(asked.join(tree, "cond").select(key, "path", "parent", "depth", "shape", says.alias("says")), "said")
    value = None
    for depth in range(deepest, -1, -1):
        here = each.where(F.col("depth") == depth)
        if value is None:
            value = settled(here.select(key, "path", "parent", F.col("says").alias("value")), "truth")
            continue
        known = F.bool_and(F.col("value").isNotNull())
        below = value.groupBy(key, F.col("parent").alias("path")).agg(F.when(known, F.bool_and("value")).alias("every"), F.when(known, F.bool_or("value")).alias("any_one"))
        joined = here.join(below, [key, "path"], "left")
        shape = F.col("shape")
        decided = F.when(shape == "all", F.col("every")).when(shape == "any", F.col("any_one")).when(shape == "not", ~F.col("every")).when(shape.isin("memory", "once"), F.when(F.col("says"), True).when(F.col("says").isNotNull(), F.col("every"))).otherwise(F.col("says"))
        value = settled(joined.select(key, "path", "parent", decided.alias("value")), "truth")
    return rows.select(key).join(value.select(key, F.col("value").alias("holds")), key, "left")
