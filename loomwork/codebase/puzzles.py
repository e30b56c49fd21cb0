"""Two kinds of puzzle that a source solves by the shorter way round a dial, recognised by their arithmetic or not at all.

Both compare floorMod(now - wanted, size) with floorMod(wanted - now, size).
Everything else (which controls, which letters) is read from calls and numbers;
one part that is missing leaves the puzzle alone.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .reader import each_source, relations

DIAL_SIZES, DIALS = range(2, 129), range(2, 9)
DIFFERENCE = re.compile(r"^(\w+)\s*-\s*(\w+)$")
TEXT = re.compile(r'^"((?:\\.|[^"\\])*)"$')

Rows = list[dict]


def turns(now: Column, wanted: Column, size: Column) -> Column:
    """way (down, up or none) and clicks, by the shorter way; up where both are as long."""
    down, up = F.pmod(now - wanted, size), F.pmod(wanted - now, size)
    return F.struct(F.when(down == 0, "none").when(down < up, "down").otherwise("up").alias("way"), F.least(down, up).alias("clicks"))


def _calls(rows: Rows, name: str) -> Rows:
    return [r for r in rows if r["kind"] == "call" and r["name"] == name]


def _numbers(rows: Rows) -> dict[str, int]:
    return {r["target"]: int(r["expression"]) for r in rows if r["kind"] == "statement" and r["name"] == "assign" and re.fullmatch(r"-?\d+", r["expression"] or "")}


def _compared(rows: Rows) -> list[tuple[str, str, str, str]]:
    """now, wanted, size, method of every pair of mirrored differences that a statement compares."""
    out = []
    mods = [(DIFFERENCE.match(r["args"][0]), r) for r in _calls(rows, "floorMod") if len(r["args"]) == 2]
    for n, (m, r) in enumerate(mods):
        for k, s in mods[n + 1 :]:
            if m and k and (m[1], m[2]) == (k[2], k[1]) and r["args"][1] == s["args"][1] and r["method"] == s["method"]:
                out.append((m[1], m[2], r["args"][1], r["method"]))
    return out


def _returned(rows: Rows, method: str) -> list[str]:
    return [r["expression"] for r in rows if r["kind"] == "statement" and r["name"] == "return" and r["method"] == method]


def cyclic_dials(rows: Rows) -> list[dict]:
    """position, variable, target, left, right, size of the dials of a solver; none if any part of it is missing."""
    found = _compared(rows)
    if not found:
        return []
    _, _, size, method = found[0]
    numbers = _numbers(rows)
    asked = [r for r in _calls(rows, "replace") if len(r["args"]) == 2 and r["args"][1].startswith(f"{method}(")]
    if not size.isdigit() or int(size) not in DIAL_SIZES or len(asked) not in DIALS or "0" not in _returned(rows, method):
        return []
    out = []
    for r in asked:
        inner = next((c for c in _calls(rows, method) if c["parent"] == r["pos"]), None)
        if inner is None or len(inner["args"]) != 4 or not r["args"][0].isdigit():
            return []
        variable, target, right, left = inner["args"]
        values = [numbers.get(x) for x in (target, left, right)]
        if None in values or not 1 <= values[0] <= int(size) or min(values[1:]) <= 0:
            return []
        out.append({"position": int(r["args"][0]), "variable": variable, "target": values[0], "left": values[1], "right": values[2], "size": int(size)})
    return out if len({d["position"] for d in out}) == len(out) else []


def combination_steps(rows: Rows) -> list[dict]:
    """step, size, dial, target, down, up and the sentence of every use of a class that solves a lock."""
    locks = {}
    for name in {r["in_class"] for r in rows if r["in_class"]}:
        own = [r for r in rows if r["in_class"] == name]
        numbers = _numbers(own)
        first, gap = numbers.get("START_DOWN_ARROW"), numbers.get("ARROW_INTERVAL")
        least = [r for r in _calls(own, "min") if all("floorMod" in a for a in r["args"])]
        if _compared(own) and least and first is not None and gap is not None and 1 <= gap <= 32:
            made = next((r for r in _calls(own, name) if not r["is_new"]), None)
            above = next(iter(_calls(own, "super")), None)
            params = [a.split()[-1] for a in made["args"] if a.split()] if made else []
            locks[name] = (first, gap, params, above["args"][1] if above and len(above["args"]) > 1 else None)
    out = []
    for r in rows:
        if r["kind"] != "call" or not r["is_new"] or r["name"] not in locks or r["target"] is None:
            continue
        first, gap, params, template = locks[r["name"]]
        numbers = [int(a) for a in r["args"] if re.fullmatch(r"-?\d+", a)]
        size, wanted = (numbers[0], numbers[1:]) if numbers else (0, [])
        if size not in DIAL_SIZES or len(wanted) not in DIALS or not all(0 <= t < size for t in wanted):
            continue
        bound, words = dict(zip(params, r["args"], strict=False)), []
        for part in (template or "").split("+"):
            said = TEXT.match(part.strip()) or TEXT.match(bound.get(part.strip(), ""))
            words.append(said[1] if said else None)
        sentence = "".join(words).strip() if words and None not in words else None
        out += [{"step": r["target"], "size": size, "dial": k, "target": t, "down": first + gap * k, "up": first + gap * k + 1, "sentence": sentence or None} for k, t in enumerate(wanted)]
    return out


def _each(files: DataFrame, read: Callable[[Rows], Rows], columns: str) -> DataFrame:
    """What is read of every file; files are dealt evenly, as a small table of many files would be one task."""
    parts = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return each_source(files.repartition(parts, "file"), "file", "source", lambda s: read(relations(s)), columns)


def dial_rows(files: DataFrame) -> DataFrame:
    return _each(files, cyclic_dials, "position int, variable string, target int, left int, right int, size int")


def lock_rows(files: DataFrame) -> DataFrame:
    return _each(files, combination_steps, "step string, size int, dial int, target int, down int, up int, sentence string")
