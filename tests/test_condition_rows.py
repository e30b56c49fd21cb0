"""Rows that bring their own conditions, against the same conditions compiled one by one."""

import json
import random

from pyspark.sql import functions as F

from loomwork.operators import conditions

STATE = "vals map<string,bigint>, held map<int,int>, at array<int>, scene array<string>, screens array<int>, shown map<string,string>, said string, speaker string, kept map<string,boolean>"


def leaf(rng):
    pick = rng.choice
    return pick([
        lambda: {"var": {"kind": pick(["varbit", "varplayer"]), "id": pick([1, 2, 9]), "op": pick(list(conditions.COMPARE)), "value": pick([0, 3, -1])}},
        lambda: {"var": {"kind": "varbit", "id": 1, "bit": pick([0, 1, 5]), "set": pick([True, False])}},
        lambda: {"item": {"ids": pick([[3], [3, 4], [9]]), **pick([{}, {"count": 2}])}},
        lambda: {"zone": [[pick([0, 5]), 9, 0, 2, 0, pick([0, 1])], *pick([[], [[4, 4, 0, 9, 9, 0]]])]},
        lambda: {"here": {"kind": pick(["npc", "object"]), "ids": pick([[7], [7, 8]])}},
        lambda: {"open": pick([11, 12])},
        lambda: {"widget": {"group": 1, "child": pick([2, 3]), "text": pick([["go"], ["go", "on"]])}},
        lambda: {"dialog": {"text": pick([["yes"], ["yes", "no"]]), **pick([{}, {"speaker": "Bob"}, {"speaker": None}])}},
        lambda: pick([{"var": {"kind": "odd", "id": 1, "op": "==", "value": 1}}, {"all": []}, {"open": "x"}, {}]),
    ])()


def condition(rng, depth):
    shape = rng.choice(["leaf", "all", "any", "not", "once", "memory"]) if depth else "leaf"
    if shape == "leaf":
        return leaf(rng)
    if shape == "not":
        return {"not": condition(rng, depth - 1)}
    if shape in ("once", "memory"):
        return {shape: {"key": rng.choice(["k", "l", "m"]), "when": condition(rng, depth - 1)}}
    return {shape: [condition(rng, depth - 1) for _ in range(rng.randrange(1, 4))]}


def some_rows(rng, spark):
    maybe = lambda x: x if rng.random() < 0.8 else None
    conds = [condition(rng, rng.randrange(4)) for _ in range(40)]
    rows = []
    for k in range(120):
        state = (maybe({"varbit:1": rng.randrange(8), "varplayer:2": 3}), maybe({3: 1, 4: rng.randrange(3)}), maybe([rng.randrange(9), 4, 0]), maybe(["npc:7", "object:8"]), maybe([11]), maybe({"1:2": "go now", "1:3": "go on"}), maybe("yes or no"), maybe(rng.choice(["Bob", "Al"])), maybe({"k": True, "l": False}))
        rows.append((k, k % len(conds), json.dumps(conds[k % len(conds)]), *state))
    rows += [(500, -1, None, *[None] * 9), (501, -1, "{", *[None] * 9), (502, -1, "[]", *[None] * 9)]
    return conds, spark.createDataFrame(rows, f"k int, n int, c string, {STATE}")


def test_rows_against_compiled_conditions(spark):
    rng = random.Random(12)
    conds, rows = some_rows(rng, spark)
    c = F.col
    full = conditions.State(values=c("vals"), held=c("held"), at=c("at"), scene=c("scene"), screens=c("screens"), shown=c("shown"), said=c("said"), speaker=c("speaker"), kept=c("kept"))
    bare = conditions.State(values=c("vals"), said=c("said"), speaker=c("speaker"))
    seen = set()
    for state in (full, bare):
        want = F.lit(None).cast("boolean")
        for n, cond in enumerate(conds):
            want = F.when(c("n") == n, conditions.holds(cond, state)).otherwise(want)
        want = {r.k: r.w for r in rows.select("k", want.alias("w")).collect()}
        got = {r.k: r.holds for r in conditions.hold(rows, "k", "c", state).collect()}
        assert got == want
        seen |= set(want.values())
    assert seen == {True, False, None}


def test_no_condition_can_be_read(spark):
    rows = spark.createDataFrame([(1, None), (2, "x")], "k int, c string")
    assert {tuple(r) for r in conditions.hold(rows, "k", "c", conditions.State()).collect()} == {(1, None), (2, None)}
    assert conditions.hold(rows.where("false"), "k", "c", conditions.State()).count() == 0
