"""Tables kept by hand, each check by hand."""

from loomwork.operators import curated


def told(df):
    return sorted((r.severity, r.key, r.value, r.problem) for r in df.collect())


def test_spells_skills_and_tasks(spark):
    make = spark.createDataFrame
    assert told(curated.spells(make([("Town", "HOME"), ("Isle", "TYPO"), ("Void", None)], "place string, spell string"), make([("HOME",), (None,)], "spell string"))) == [("error", "Isle", "TYPO", "no such spell"), ("error", "Void", None, "no such spell")]
    steps = make([("a",), ("b",)], "step_id string")
    rows = make([("a", "MINING", 40), ("b", "MINNING", 100), ("gone", "MAGIC", None)], "step_id string, skill string, level int")
    want = [("error", "b", "MINNING", "level out of range"), ("error", "b", "MINNING", "no such skill"), ("error", "gone", "MAGIC", "level out of range"), ("error", "gone", "MAGIC", "no such step")]
    assert told(curated.skills(rows, steps)) == want and told(curated.skills(rows, None)) == want[:3]
    rows = make([("a", "DIARY", 0), ("b", "DIARY", 32), ("gone", "ODD", 31)], "step_id string, varplayer string, bit int")
    assert told(curated.diary_tasks(rows, make([("DIARY",)], "name string"), steps)) == [("error", "b", "DIARY", "bit out of range"), ("error", "gone", "ODD", "no such step"), ("error", "gone", "ODD", "no such variable")]


def test_aliases_and_places(spark):
    make = spark.createDataFrame
    rows = make([("Falador easy", "Falador Easy Diary"), ("Lumby", "Lumbridge & Draynor Easy Diary"), ("old", "Falador Simple Diary")], "written string, diary string")
    assert told(curated.diary_aliases(rows, make([("Falador easy",), ("Lumby",)], "tag string"))) == [("error", "old", "Falador Simple Diary", "no step writes this"), ("error", "old", "Falador Simple Diary", "no such diary")]
    entities = make([("Bank", "place", [[1, 2, 0]], [4]), ("Bob", "npc", [[1, 2, 0]], []), ("Gate", "object", [], None)], "name string, kind string, points array<array<int>>, ids array<int>")
    rows = make([("the bank", "Bank"), ("bob's", "Bob"), ("gate", "Gate"), ("town", "  OLD town!")], "written string, place string")
    got = told(curated.places(rows, make([("old town",)], "name string"), entities))
    assert {k for _, k, _, _ in got} >= {"bob's", "gate"} and "the bank" not in {k for _, k, _, _ in got}
    rows = make([("banker", ["Bank", "Bob"]), ("none", []), ("null", None), ("odd", ["Nobody"])], "phrase string, names array<string>")
    assert told(curated.entity_aliases(rows, entities)) == sorted([("error", "banker", "Bob", "entity without ids"), ("error", "none", None, "names nothing"), ("error", "null", None, "names nothing"), ("error", "odd", "Nobody", "no such entity")], key=lambda t: (t[0], t[1]))


def test_crossings(spark):
    make = spark.createDataFrame
    rows = make([("Isle", "ship"), ("Rock", "boat"), ("Nowhere", "ship"), ("Cape", "ship"), ("Port", "ship"), ("Bay", "ship")], "place string, kind string")
    routes = make([("Isle, Port", "ship"), ("Isle", "boat"), ("Rock, Cape", "ship"), ("Bay", "ship"), (None, "ship")], "label string, kind string")
    entities = make([("The Cape", [[1, 2, 0]]), ("Bay", [])], "name string, points array<array<int>>")
    aliases = make([("Cape", "The Cape")], "written string, name string")
    journeys = make([("Isle", "12,3,0"), ("Port", None)], "place string, boards string")
    assert told(curated.crossings(rows, routes, entities, aliases, journeys)) == [
        ("error", "Cape", "ship", "leads nowhere"), ("error", "Nowhere", "ship", "end of no route"), ("error", "Port", "ship", "boards nowhere"), ("error", "Rock", "boat", "no route of this kind"),
        ("note", "Bay", "ship", "no step names it yet"), ("note", "Isle", "ship", "another kind goes there too"),
    ]
