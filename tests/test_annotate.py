"""Golden sentences for the whole set of fields."""

from pyspark.sql import functions as F

from loomwork.functions.annotate import annotate, leading_verb
from loomwork.operators import reports

SENTENCES = {
    "Head West and talk to Redbeard Frank [Pirate]": {"intent": "npc", "target": "Redbeard Frank", "tags": ["Pirate"]},
    "Take the boat to Brimhaven": {"intent": "item", "destination": "Brimhaven"},
    "Mine 10x Clay on the way": {"intent": "object", "target": "Clay rocks", "items": [("Clay", 10)], "collects": True},
    "Kill a [[Jogre]] and collect Bones & Fur. Run": {"intent": "npc", "target": "Jogre", "links": ["Jogre"], "items": [("Bones", None), ("Fur", None)], "collects": True},
    "Kill a duck": {"intent": "npc", "target": "duck"},
    "Head South and buy 3x Vial then go": {"intent": "nav", "items": [("Vial", 3)], "buys": True},
    "Deposit All, then Withdraw and equip: Leather Gloves": {"intent": "item", "items": [("Leather Gloves", None)], "withdraw": True, "banking": True},
    "Withdraw: 5x Rope & Coal (2,1)": {"intent": "withdraw", "items": [("Rope", 5), ("Coal", None)], "withdraw": True, "dialogue": ["2,1"]},
    "Bank at Draynor": {"intent": "object", "target": "Draynor", "banking": True},
    "Fish until 46 Fishing": {"intent": "object", "target": "until"},
    "Ardy Cloak -> BLS": {"intent": "nav", "teleport_via": "Ardy Cloak", "destination": "BLS"},
    "Chronicle to Varrock": {"teleport_item": "Chronicle", "teleport_item_to": "Varrock"},
    "Use Bucket on Pump": {"intent": "object", "target": "Pump", "items": [("Bucket", None)]},
    "": {},
    None: {},
}


def test_annotate(spark):
    df = annotate(spark.createDataFrame([(k,) for k in SENTENCES], "t string"), "t")
    assert df.columns == ["t", "fields"]
    got = {}
    for r in df.collect():
        some = {k: v for k, v in r.fields.asDict().items() if v is not None}
        if "items" in some:
            some["items"] = [tuple(x) for x in some["items"]]
        got[r.t] = some
    assert got == SENTENCES


def test_leading_verb(spark):
    texts = {"talk to x": ("talk to", "npc"), "talk": None, "bank at y": ("bank at", "object"), "bank": ("bank", "bank"), "banking": None, "withdraw: a": ("withdraw", "withdraw"), "": None}
    df = spark.createDataFrame([(k,) for k in texts], "t string").select("t", leading_verb(F.col("t")).alias("v"))
    assert {r.t: r.v and tuple(r.v) for r in df.collect()} == texts


def test_candidate_texts_are_read_once(spark):
    """What may hold goods is worked out in columns, not inside the function on arrays that reads them."""
    rows = spark.createDataFrame([("Collect 3 Ropes and go",), ("Go on\tHans",), ("play on hans",), (None,), ("Varrock teleport to Varrock",), ("Ropes  and more",), ("(1) [x]",)], "text string")
    got = annotate(rows, "text")
    assert "transform(array(__text0#" in got._jdf.queryExecution().optimizedPlan().toString()
    f = [r.fields for r in got.collect()]
    assert [(x["name"], x["count"]) for x in f[0]["items"]] == [("Ropes", 3)] and f[1]["target"] == "Hans" and f[2]["target"] is None and f[3]["intent"] is None
    assert (f[4]["teleport_item"], f[4]["teleport_item_to"], f[5]["teleport_item"], f[6]["tags"]) == ("Varrock", "Varrock", "Ropes", ["x"])


def test_coverage_reads_the_steps_once(spark):
    read = spark.sparkContext.accumulator(0)

    def counted(frames):
        for f in frames:
            read.add(len(f))
            yield f

    rows = spark.createDataFrame([("Go", "nav", None, "none"), (":Sit", None, "X", "inferred"), ("Sit", None, None, "none")], "raw string, intent string, target string, confidence string")
    got = reports.annotation_coverage(rows.mapInPandas(counted, rows.schema))
    assert {tuple(r) for r in got.collect()} == {("intent", "nav", 1), ("intent", "-none-", 2), ("confidence", "none", 2), ("confidence", "inferred", 1), ("inferred name", "X", 1), ("unhandled verb", "Sit", 2)}
    assert read.value == 3
