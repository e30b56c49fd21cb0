"""The source reader by hand: brackets, quotes, declarations, conditions, puzzles, templates."""

import pytest

from loomwork.codebase import conditions, puzzles, reader, tables
from loomwork.operators.gates import lock_problem

SOURCE = r"""
class Quest extends Helper { /* a ( comment */
  private static final int VAR = 12; // it's "quoted
  ItemRequirement rope = new ItemRequirement("Rope \"(x)", ItemID.ROPE, 3).highlighted();
  Conditions both = new Conditions(LogicType.AND, new VarbitRequirement(VAR, 2, Operation.GREATER), nor(a, loop));
  Conditions a = new WidgetPresence(7), loop = loop;
  void set(String x) {
    if (x) { step = new NpcStep(this, NpcID.BOB, "Talk to " + "Bob."); }
    cs.addStep(and(rope, inside), step).addStep(both, other);
    inside = new ZoneRequirement(new Zone(new WorldPoint(9, 1, 0), new WorldPoint(2, 5, 0)));
    broken(1, (2;
  }
}"""


def test_relations():
    rows = reader.relations(SOURCE)
    calls = {(r["name"], tuple(r["args"])) for r in rows if r["kind"] == "call"}
    assert ("ItemRequirement", (r'"Rope \"(x)"', "ItemID.ROPE", "3")) in calls
    assert ("NpcStep", ("this", "NpcID.BOB", '"Talk to " + "Bob."')) in calls
    npc = next(r for r in rows if r["name"] == "NpcStep")
    assert (npc["target"], npc["method"], npc["in_class"], npc["base"], npc["is_new"]) == ("step", "set", "Quest", "Helper", True)
    first, second = [r for r in rows if r["name"] == "addStep"]
    assert first["receiver"] == "cs" and second["on_call"] == first["pos"]
    assert not any(r["name"] == "broken" for r in rows if r["kind"] == "call")
    assert reader.relations("") == reader.relations("// only\n/* notes") == []


def test_chains_of_any_length():
    chain = ".".join(["a" * 50] * 30)
    call = next(r for r in reader.relations(f"class Q {{ void f() {{ x = 3; {chain}.go(1); }} }}") if r["name"] == "go")
    assert call["receiver"] == chain and call["args"] == ["1"]


def test_arguments():
    assert reader.arguments('f(a, g(b, "c)"), [d, e], {x, y})', 1) == ["a", 'g(b, "c)")', "[d, e]", "{x, y}"]
    assert reader.arguments("f()", 1) == [] and reader.arguments("f(a, (b", 1) is None
    assert reader.without_comments('a /* x\ny */ "//b" // c\nd') == 'a \n "//b" \nd'


@pytest.mark.parametrize(("expression", "want"), [
    ("rope", {"item": {"ids": ["$ItemID.ROPE"], "count": 3}}),
    ("inside", {"zone": [[2, 1, 0, 9, 5, 0]]}),
    ("new VarplayerRequirement(VarPlayerID.X, false, 4)", {"var": {"kind": "varplayer", "id": "$VarPlayerID.X", "bit": 4, "set": False}}),
    ("not(new WidgetTextRequirement(1, 2, \"go\"))", {"not": {"widget": {"group": 1, "child": 2, "text": ["go"]}}}),
    ("new Conditions(LogicType.NAND, a, a)", {"not": {"all": [{"open": 7}, {"open": 7}]}}),
    ("both", None), ("loop", None), ("unknown()", None), ("or(a, unknown())", None), ("", None),
    ("new OnceRequirement(\"k\", a)", {"once": {"key": "k", "when": {"open": 7}}}),
])
def test_conditions(expression, want):
    names = conditions.named(SOURCE.replace("), loop = loop", "); Conditions loop = loop"))
    assert conditions.compiled(expression, names) == want


def test_templates():
    text = "{{A|x = {{B|1|2}}|[[l|m]]|3}} {{a|4}} {{A|never"
    assert tables.templates(text, "A") == [["x = {{B|1|2}}", "[[l|m]]", "3"], ["4"]]
    assert tables.spawn(["name=[[x|Log]]", "x:1,y:2,qty:4-9", "plane=7"]) == {"name": "Log", "place": "", "members": False, "points": [[1, 2, 0]], "counts": [4]}
    assert tables.spawn(["name={{x}}", "1,2"]) is None and tables.spawn(["name=a"]) is None


def test_puzzles_need_every_part():
    solver = "class P { int T = 2; int L = 5; int R = 6; int s(int i, int t, int r, int l) { if (n != t) { return Math.floorMod(n - t, 9) < Math.floorMod(t - n, 9) ? l : r; } return 0; } void d() { m.replace(0, s(V.A, T, R, L)); m.replace(1, s(V.B, T, R, L)); } }"
    assert [d["variable"] for d in puzzles.cyclic_dials(reader.relations(solver))] == ["V.A", "V.B"]
    for old, new in (("t - n, 9", "n - t, 9"), ("return 0;", "return 1;"), ("int L = 5;", ""), ("replace(1", "replace(0"), ("int T = 2", "int T = 20")):
        assert puzzles.cyclic_dials(reader.relations(solver.replace(old, new, 1))) == []


def test_locks():
    dial = lambda k, t=1: {"varc": k, "target": t, "down": 10 * k, "up": 10 * k + 1}
    good = {"size": 5, "parent": 1, "submit": 2, "cycles": [dial(1), dial(2)]}
    assert lock_problem(good) is None
    for bad in ({"size": 1}, {"size": "5"}, {"parent": 0}, {"submit": None}, {"cycles": [dial(1)]}, {"cycles": [dial(1), dial(1)]}, {"cycles": [dial(1), dial(2, 5)]}):
        assert lock_problem(good | bad)


def test_sources_are_handed_on_in_pieces(spark):
    """Rows leave a worker some at a time, whatever the number of files; none is lost, null texts have none."""
    from loomwork.codebase import reader
    from pyspark.sql import functions as F

    files = spark.range(3000, numPartitions=1).select(F.col("id").alias("file"), F.when(F.col("id") % 10 > 0, F.lit("class A { void b() { c = d(1, e()); } }")).alias("source"))
    rel = reader.read_sources(files, settle=False)
    assert rel.count() == 2700 * len(reader.relations("class A { void b() { c = d(1, e()); } }"))
    import pyarrow as pa

    many = pa.RecordBatch.from_pydict({"file": list(range(3000)), "source": ["a(b(), c());"] * 3000})
    got = list(reader.pieces([many], reader.relations, reader.COLUMNS))
    assert max(b.num_rows for b in got) == reader.ROWS and sum(b.num_rows for b in got) == 3000 * len(reader.relations("a(b(), c());"))


def test_puzzles_are_dealt_over_tasks(spark):
    from loomwork.codebase import puzzles

    files = spark.range(50, numPartitions=1).selectExpr("id as file", "'class A {}' as source")
    assert puzzles.dial_rows(files).rdd.getNumPartitions() > 1 and puzzles.lock_rows(files).count() == 0


def test_stock_gives_every_pair_once(spark):
    """Rows of one page are not mixed, and no plan is needed that tells all pairs apart."""
    from loomwork.codebase import tables

    pages = spark.createDataFrame([("a", [1, 1, 2], [8, 8]), ("b", [1], [8, 9]), ("b", [1, 3], [9]), ("c", [], [8]), ("d", None, [8])], "page string, sold array<int>, owners array<int>")
    got = [tuple(r) for r in tables.stock(pages, "page", "sold", "owners").collect()]
    assert sorted(got) == [("a", 1, 8), ("a", 2, 8), ("b", 1, 8), ("b", 1, 9), ("b", 3, 9)]
