"""Golden cases and brute force for goods, classifiers, conditions, lookups, sinks and stages."""

from itertools import product

import pytest
from pyspark.sql import functions as F

from loomwork.functions.goods import goods
from loomwork.functions.predicates import is_advice, is_scattered
from loomwork.operators import conditions as C
from loomwork.plans.stages import Stage, run
from loomwork.sources import lookup, sinks

GOODS = {
    "Coins, 15 Pineapples & 5x Food (23 Slots)": [("Coins", None), ("Pineapples", 15), ("Food", 5)],
    "1,200 Nature Runes and a Knife": [("Nature Runes", 1200), ("Knife", None)],
    "Coal+Iron": [("Coal", None), ("Iron", None)],
    "100+ Coins": [("Coins", 100)],
    "Raw Rat / Chicken": [("Raw Rat", None), ("Raw Chicken", None)],
    "0 Cat / Kitten/ ": [("Cat", 0), ("Kitten", 0)],
    "6xAir/2 Water Runes": [("Air Runes", 6), ("Water Runes", 2)],
    "Raw Rat/Chicken/Beef": [("Raw Rat", None), ("Raw Chicken", None), ("Raw Beef", None)],
    "5x Fire/Air/Earth Pack": [("Fire Pack", 5), ("Air Pack", 5), ("Earth Pack", 5)],
    "100 Soda Ash/Sand if you haven't": [("Soda Ash/Sand if you haven't", 100)],
    "Green D'hide Chaps, Vambs & Rope, Body": [("green d'hide chaps", None), ("green d'hide vambraces", None), ("Rope", None), ("Body", None)],
    "[[Rope|a Rope]], deposit the rest": [("Rope", None)],
    "": [],
    "12, ..": [],
    None: None,
}


def test_goods(spark):
    df = spark.createDataFrame([(k,) for k in GOODS], "t string").select("t", goods(F.col("t")).alias("g"))
    got = {r.t: r.g and [tuple(x) for x in r.g] or r.g for r in df.collect()}
    assert got == GOODS


def test_classifiers(spark):
    texts = {"Note: bring food": True, "(an aside)": True, "DO NOT GO THERE YET": True, "Talk to Hans": False, "You can skip this": True, "Noted logs": False, "": False}
    df = spark.createDataFrame([(k,) for k in texts], "t string").select("t", is_advice(F.col("t")).alias("a"))
    assert {r.t: r.a for r in df.collect()} == texts
    rows = [([[0, 0], [65, 3]], True), ([[0, 0], [64, 64]], False), ([], False), (None, False)]
    pts = spark.createDataFrame(rows, "p array<array<int>>, want boolean").select(is_scattered(F.col("p")).alias("got"), "want")
    assert all(r.got == r.want for r in pts.collect())


def brute(c, v):
    ((shape, body),) = c.items()
    if shape == "var":
        return None if v[body["id"]] is None else v[body["id"]] >= body["value"]
    if shape == "not":
        x = brute(body, v)
        return None if x is None else not x
    parts = [brute(p, v) for p in body]
    return None if None in parts else (all if shape == "all" else any)(parts)


def test_unknown_spreads(spark):
    var = [{"var": {"kind": "varbit", "id": k, "op": ">=", "value": 1}} for k in range(2)]
    conds = [{"all": var}, {"any": var}, {"not": {"any": var}}, {"all": [{"not": var[0]}, {"any": [var[1], var[0]]}]}]
    df = spark.createDataFrame(list(product([None, 0, 1], repeat=2)), "a int, b int")
    state = C.State(values=F.create_map(F.lit("varbit:0"), "a", F.lit("varbit:1"), "b"))
    for c in conds:
        for r in df.select("a", "b", C.holds(c, state).alias("got")).collect():
            assert r.got == brute(c, (r.a, r.b))


def test_other_shapes(spark):
    df = spark.sql("select array(3, 4, 0) at, array('npc:5') scene, array(7) screens, map('1:2', 'a big door') shown, 'well met' said, 'Hans' speaker, map('k', true) kept, map(9, 2) held")
    state = C.State(held=F.col("held"), at=F.col("at"), scene=F.col("scene"), screens=F.col("screens"), shown=F.col("shown"), said=F.col("said"), speaker=F.col("speaker"), kept=F.col("kept"))
    cases = [
        ({"zone": [[9, 9, 0, 9, 9, 0], [0, 0, 0, 5, 5, 0]]}, True),
        ({"zone": [[0, 0, 1, 5, 5, 1]]}, False),
        ({"here": {"kind": "npc", "ids": [5, 6]}}, True),
        ({"here": {"kind": "object", "ids": [5]}}, False),
        ({"open": 7}, True),
        ({"widget": {"group": 1, "child": 2, "text": ["big", "door"]}}, True),
        ({"widget": {"group": 1, "child": 3, "text": ["door"]}}, None),
        ({"dialog": {"text": ["met"], "speaker": "Hans"}}, True),
        ({"once": {"key": "k", "when": {"open": 1}}}, True),
        ({"memory": {"key": "z", "value": 1, "when": {"open": 1}}}, False),
        ({"item": {"ids": [9, 8], "count": 3}}, False),
        ({"item": {"ids": [9]}}, True),
        ({"var": {"kind": "varbit", "id": 1, "op": "==", "value": 1}}, None),
        ({"strange": 1}, None),
    ]
    got = df.select(*[C.holds(c, state).alias(f"c{k}") for k, (c, _) in enumerate(cases)]).first()
    assert list(got) == [want for _, want in cases]


@pytest.mark.parametrize("bad", [None, {}, {"all": []}, {"not": {"open": "x"}}, {"var": {"kind": "x", "id": 1}}, {"dialog": {"text": []}}, {"zone": [[1, 2]]}, {"item": 3}, {"once": {"key": "", "when": {"open": 1}}}])
def test_malformed(bad):
    assert C.problem(bad)


def test_lookup_asks_once_per_key(spark):
    keys = spark.createDataFrame([("a",), ("a",), ("b",), ("c",), (None,)], "k string")
    cache = spark.createDataFrame([("a", "1"), ("b", None)], "k string, value string")
    new = lookup.fetched(lookup.missing(keys, cache, "k"), "k", lambda names: {})
    assert [tuple(r) for r in new.collect()] == [("c", None)]
    assert lookup.resolved(keys, cache.unionByName(new), "k").count() == 5


def test_append_is_all_or_nothing(spark):
    held = spark.createDataFrame([(1, "x"), (2, None)], "k int, v string")
    ok = spark.createDataFrame([(1, "x"), (3, "y"), (3, "y")], "k int, v string")
    assert [tuple(r) for r in sinks.append_checked(ok, held, "k", "v").collect()] == [(3, "y")]
    for bad in ([(1, "z")], [(2, "z")], [(5, "a"), (5, "b")]):
        with pytest.raises(ValueError):
            sinks.append_checked(spark.createDataFrame(bad, "k int, v string"), held, "k", "v")


def test_documents_and_markdown(spark, tmp_path):
    df = spark.createDataFrame([(1, "a|b"), (2, None)], "k int, v string")
    assert [r.value for r in sinks.markdown(df).collect()] == ["| 1 | a\\|b |", "| 2 |  |"]
    sinks.write_documents(df, str(tmp_path / "out"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "out")).collect()) == ['{"k":1,"v":"a|b"}', '{"k":2}']


def test_stages():
    seen = []
    todo = [Stage("fetch", lambda: seen.append("fetch"), online=True), Stage("parse", lambda: seen.append("parse"))]
    assert [r[:2] for r in run(todo, offline=True)] == [("fetch", "skipped"), ("parse", "done")]
    assert [r[1] for r in run(todo, dry=True)] == ["planned", "planned"] and seen == ["parse"]
    with pytest.raises(ZeroDivisionError):
        run([Stage("bad", lambda: 1 // 0), *todo])
    assert seen == ["parse"]
