"""Golden pages and names."""

from pyspark.sql import functions as F

from loomwork.functions import pages as P
from loomwork.operators.pages import resolve_names

OWN_MAP = "{{Infobox Location\n|map = {{Map|name=Port|x=2814|y=3443}}\n}}\n{{map|3089,3265|type=maplink|group=g}}"
PINS = "{{Infobox Location\n|name = x\n}}\n{{map|1744,5475|type=maplink}} {{map|2569,2862|2570,2863|type=maplink}}"
TABLE = "{{Infobox Scenery\n|id1 = 5, 6\n|id2 = 6,7\n|plane = 2\n}}\n{{TeleportLocationLine|name=a|x=1491|y=3283}}"
ITEM = "{{Infobox Item\n|id = 9\n}}\n{{TeleportLocationLine|name=a|x=1491|y=3283}}"
CHOICE = "{{Disambig}}\n" + "".join(f"[[c{k}|x]]" for k in range(12))


def test_page(spark):
    want = {
        OWN_MAP: ("place", "location", [], [[2814, 3443, 0]]),
        PINS: ("place", "location", [], [[1744, 5475, 0], [2569, 2862, 0]]),
        TABLE: ("object", "scenery", [5, 6, 7], [[1491, 3283, 2]]),
        ITEM: ("item", "item", [9], []),
        "#REDIRECT [[x]] {{Infobox Item\n|id = 9\n}}": None,
        "{{Infobox Quest\n|id = 9\n}}": None,
        "{{Infobox Item\n}}": None,
        "{{Infobox Item\n|id = 0, 10 , 21\n}}": ("item", "item", [0, 10, 21], []),
        CHOICE: None,
        "": None,
        None: None,
    }
    df = spark.createDataFrame([(k,) for k in want], "t string").select("t", P.page(F.col("t")).alias("p"))
    assert {r.t: r.p and tuple(r.p) for r in df.collect()} == want


def test_names(spark):
    pages = spark.createDataFrame([("Ropes", None), ("Rope", ITEM), ("Orb", CHOICE), ("Plain", "text"), ("Gone", None)], "title string, markup string")
    names = spark.createDataFrame([("Ropes",), ("Ropes",), ("Orb",), ("Plain",), ("Gone",), ("Nowhere",), (None,)], "name string")
    got = {r.name: (r.variant if r.refusal is None else None, r.refusal, r.choices and len(r.choices)) for r in resolve_names(names, pages).collect()}
    assert got == {
        "Ropes": ("Rope", None, None), "Orb": (None, "choice needed", 8), "Plain": (None, "no usable box", None),
        "Gone": (None, "no page", None), "Nowhere": (None, "no page", None),
    }


def test_overrides(spark):
    rows = [("item", ["npc"], True), ("item", ["npc", "item"], False), ("item", ["new"], False), ("item", ["quest"], False), ("item", ["quest", "npc"], True), ("item", [], False)]
    df = spark.createDataFrame(rows, "k string, i array<string>, want boolean").select(P.overrides(F.col("k"), F.col("i")).alias("got"), "want")
    assert all(r.got == r.want for r in df.collect())
