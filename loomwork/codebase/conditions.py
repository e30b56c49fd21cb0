"""Conditions of source expressions, compiled to the shapes of operators.conditions.

Ids stay constants, written "$Class.NAME", until `resolved` puts numbers in
their place.  An expression that cannot be read, or one of whose parts cannot,
gives null: nothing is guessed.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .reader import arguments, each_source, relations

# How the sources' library names comparisons and joins.
OPERATIONS = {"EQUAL": "==", "NOT_EQUAL": "!=", "LESS": "<", "LESS_EQUAL": "<=", "GREATER": ">", "GREATER_EQUAL": ">="}
LOGIC = {"AND": "all", "OR": "any"}
NEGATED = {"NOR": "any", "NAND": "all"}
CALL = re.compile(r"^(?:new\s+)?(?:\w+\.)*(\w+)\s*(?:<[^<>]*>)?\s*\(", re.S)
POINT = re.compile(r"^new\s+WorldPoint\(\s*(-?\d+)\s*,\s*(-?\d+)\s*,\s*(-?\d+)\s*\)$")
TEXT = re.compile(r'"((?:\\.|[^"\\])*)"')

Names = dict[str, str]


def named(source: str) -> Names:
    """Variables and what they are assigned; the last assignment wins."""
    return {r["target"]: r["expression"] for r in relations(source) if r["kind"] == "statement" and r["name"] == "assign"}


class Compiler:
    def __init__(self, names: Names):
        self.names, self.open = names, set()

    def number(self, a: str) -> int | None:
        a = self.names.get(a, a).strip()
        return int(a) if re.fullmatch(r"-?\d+", a) else None

    def thing(self, a: str) -> int | str | None:
        n = self.number(a)
        return n if n is not None else f"${a}" if re.fullmatch(r"\w+\.\w+", a) else None

    def __call__(self, expression: str) -> dict | None:
        e = expression.strip()
        if e in self.names:
            if e in self.open:
                return None
            self.open.add(e)
            got = self(self.names[e])
            self.open.discard(e)
            return got
        if (m := CALL.match(e)) is None:
            return None
        args = arguments(e, m.end() - 1)
        reader = READERS.get(m[1])
        return reader(self, args) if args is not None and reader else None

    def several(self, args: list[str], join: str) -> dict | None:
        parts = [self(a) for a in args]
        return {join: parts} if parts and all(p is not None for p in parts) else None


def _var(kind: str) -> Callable[[Compiler, list[str]], dict | None]:
    def read(c: Compiler, args: list[str]) -> dict | None:
        if len(args) < 2 or (var := c.thing(args[0])) is None:
            return None
        if args[1] in ("true", "false"):
            bit = c.number(args[2]) if len(args) > 2 else None
            return None if bit is None else {"var": {"kind": kind, "id": var, "bit": bit, "set": args[1] == "true"}}
        value, op = c.number(args[1]), "=="
        if len(args) > 2:
            op = OPERATIONS.get(args[2].rpartition(".")[2])
        return None if value is None or op is None else {"var": {"kind": kind, "id": var, "op": op, "value": value}}

    return read


def _item(c: Compiler, args: list[str]) -> dict | None:
    things = [c.thing(a) for a in args[1:2]]
    counts = [n for a in args[2:] if (n := c.number(a)) is not None]
    return {"item": {"ids": things, "count": max(1, counts[0] if counts else 1)}} if things and None not in things else None


def _zone(c: Compiler, args: list[str]) -> dict | None:
    boxes = []
    for a in args:
        e = c.names.get(a, a).strip()
        m = CALL.match(e)
        parts = arguments(e, m.end() - 1) if m and m[1] == "Zone" else None
        points = [POINT.match(p) for p in parts or []]
        if len(points) not in (1, 2) or None in points:
            return None
        p, q = ([int(x) for x in m_.groups()] for m_ in (points[0], points[-1]))
        boxes.append([*map(min, zip(p, q, strict=True)), *map(max, zip(p, q, strict=True))])
    return {"zone": boxes} if boxes else None


def _here(kind: str) -> Callable[[Compiler, list[str]], dict | None]:
    def read(c: Compiler, args: list[str]) -> dict | None:
        things = [c.thing(a) for a in args if not a.startswith("new ")]
        return {"here": {"kind": kind, "ids": things}} if things and None not in things else None

    return read


def _open(c: Compiler, args: list[str]) -> dict | None:
    group = c.number(args[0]) if args else None
    return None if group is None else {"open": group}


def _words(args: list[str]) -> list[str]:
    return [m[1] for a in args for m in [TEXT.fullmatch(a)] if m]


def _widget(c: Compiler, args: list[str]) -> dict | None:
    group, child = (c.number(a) for a in args[:2]) if len(args) > 2 else (None, None)
    words = _words(args[2:])
    return {"widget": {"group": group, "child": child, "text": words}} if group is not None and child is not None and words else None


def _dialog(c: Compiler, args: list[str]) -> dict | None:
    return {"dialog": {"text": _words(args)}} if args and len(_words(args)) == len(args) else None


def _kept(shape: str) -> Callable[[Compiler, list[str]], dict | None]:
    def read(c: Compiler, args: list[str]) -> dict | None:
        key = _words(args[:1])
        when = c(args[-1]) if len(args) > 1 else None
        return {shape: {"key": key[0], "when": when}} if key and when is not None else None

    return read


def _conditions(c: Compiler, args: list[str]) -> dict | None:
    """A list behind the kind of its joining, if one is given."""
    kind = args[0].rpartition(".")[2] if args and args[0].startswith("LogicType.") else "AND"
    rest = args[1:] if args and args[0].startswith("LogicType.") else args
    if kind in NEGATED:
        inner = c.several(rest, NEGATED[kind])
        return None if inner is None else {"not": inner}
    return c.several(rest, LOGIC[kind]) if kind in LOGIC else None


def _negated(join: str) -> Callable[[Compiler, list[str]], dict | None]:
    def read(c: Compiler, args: list[str]) -> dict | None:
        inner = c.several(args, join) if len(args) != 1 else c(args[0])
        return None if inner is None else {"not": inner}

    return read


#: By name of the call: how its arguments are read.
READERS: dict[str, Callable[[Compiler, list[str]], dict | None]] = {
    "VarbitRequirement": _var("varbit"), "VarplayerRequirement": _var("varplayer"), "ItemRequirement": _item, "ZoneRequirement": _zone, "NpcCondition": _here("npc"), "ObjectCondition": _here("object"),
    "WidgetPresence": _open, "WidgetTextRequirement": _widget, "DialogRequirement": _dialog, "RememberedRequirement": _kept("memory"), "OnceRequirement": _kept("once"), "Conditions": _conditions,
    "and": lambda c, a: c.several(a, "all"), "or": lambda c, a: c.several(a, "any"), "nor": _negated("any"), "nand": _negated("all"), "not": _negated("all"),
}


def compiled(expression: str, names: Names) -> dict | None:
    return Compiler(names)(expression)


def branch_conditions(files: DataFrame, key: str = "file", text: str = "source") -> DataFrame:
    """file, owner, pos, step, condition: every addStep(condition, step) with its condition as JSON, or null."""

    def read(source: str) -> Iterator[dict]:
        rows = relations(source)
        names = {r["target"]: r["expression"] for r in rows if r["kind"] == "statement" and r["name"] == "assign"}
        for r in rows:
            if r["kind"] == "call" and r["name"] == "addStep" and len(r["args"]) == 2:
                c = compiled(r["args"][0], names)
                yield {"owner": r["receiver"] or r["target"], "pos": r["pos"], "step": r["args"][1], "condition": None if c is None else json.dumps(c, sort_keys=True)}

    return each_source(files, key, text, read, "owner string, pos int, step string, condition string")


def resolved(rows: DataFrame, keys: list[str], ids: DataFrame, condition: str = "condition") -> DataFrame:
    """Constants of the conditions replaced by ids (constant, id); a condition with an unknown one is null as a whole."""
    named_ = F.regexp_extract_all(condition, F.lit(r'"\$(\w+\.\w+)"'), F.lit(1))
    leaves = rows.select(*keys, F.explode(F.array_distinct(named_)).alias("constant")).join(ids, "constant", "left")
    known = leaves.groupBy(*keys).agg(F.bool_and(F.col("id").isNotNull()).alias("__all"), F.collect_list(F.struct("constant", "id")).alias("__ids"))
    put = F.aggregate("__ids", F.col(condition), lambda acc, x: F.replace(acc, F.concat(F.lit('"$'), x["constant"], F.lit('"')), x["id"].cast("string")))
    met = rows.join(known, keys, "left")
    return met.withColumn(condition, F.when(F.col("__all").isNull(), F.col(condition)).when(F.col("__all"), put)).drop("__all", "__ids")
