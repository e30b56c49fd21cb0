"""What a step says once all that it hands on is asked, from sources written by hand."""

import pytest

from loomwork.codebase import extract, reader

SETUP = """
 box = new ObjectStep(this, ObjectID.BOX, new WorldPoint(1, 2, 0), "Open the box");
 letter = new NpcStep(this, NpcID.CLERK, new WorldPoint(5, 2, 0), "Hand in the letter");
 wheel = new ObjectStep(this, ObjectID.WHEEL, new WorldPoint(3, 4, 0), "Turn the wheel");
 has = new VarbitRequirement(10, 1); sided = new VarbitRequirement(11, 1); inside = new VarbitRequirement(12, 1);
 inner = new ConditionalStep(this, box); inner.addStep(has, letter);
"""


@pytest.fixture(scope="module")
def read(spark):
    def run(*lines):
        source = "class Quest extends Helper { void set() {" + SETUP + "\n".join(lines) + "\n} }"
        rel = reader.read_sources(spark.createDataFrame([(1, source)], "file int, source string"))
        return {r["name"]: r for r in extract.delegated(rel).collect()}

    return run


def arms(r):
    return [(a["condition"], a["step"]) for a in r["arms"]]


def test_nested_defaults_keep_their_arms(read):
    got = read("outer = new ConditionalStep(this, inner); outer.addStep(sided, wheel);", "bare = new ConditionalStep(this, inner);", 'worded = new ConditionalStep(this, outer, "Choose");')
    assert got["outer"]["text"] == got["bare"]["text"] == "Open the box" and got["outer"]["constant"] == "ObjectID.BOX" and got["outer"]["point"] == [1, 2, 0]
    assert arms(got["outer"]) == arms(got["worded"]) == [("sided", "wheel"), ("has", "letter")] and arms(got["bare"]) == [("has", "letter")]
    assert got["worded"]["text"] == "Choose" and got["worded"]["point"] == [1, 2, 0]


def test_aliases_methods_and_later_words(read):
    got = read("same = box; box.setText(\"Look \" + \"inside\"); box.addIcon(ItemID.KEY); third = same; third.addIcon(ItemID.ROPE); built = getBox(x);", "} Step getBox(int x) { if (x) { return early; } return third; } void more() {")
    assert {got[n]["text"] for n in ("box", "same", "third", "built")} == {"Look inside"}
    assert [got[n]["icon"] for n in ("box", "same", "third", "built")] == ["ItemID.KEY", "ItemID.KEY", "ItemID.ROPE", "ItemID.ROPE"]


def test_a_wrapper_says_what_it_wraps(read):
    got = read('riddle = new PuzzleWrapperStep(this, box, "Find out how"); mute = new CustomStep(this); shut = new PuzzleWrapperStep(this, mute, "Find out how"); again = new PuzzleWrapperStep(this, shut, "Outer");')
    assert (got["riddle"]["text"], got["riddle"]["constant"]) == ("Open the box", "ObjectID.BOX")
    assert got["shut"]["text"] == got["again"]["text"] == "Find out how"


def test_a_stand_in_gives_way_to_its_last_arm(read):
    got = read(
        'empty = new DetailedQuestStep(this, "Unknown state."); c = new ConditionalStep(this, empty); c.addStep(has, letter); c.addStep(sided, wheel); c.addStep(inside, empty);',
        'sync = new DetailedQuestStep(this, "Open your Journal to sync."); d = new ConditionalStep(this, sync); d.addStep(has, c); e = new ConditionalStep(this, empty);',
    )
    assert (got["c"]["text"], got["c"]["constant"], got["c"]["stood_in"]) == ("Turn the wheel", "ObjectID.WHEEL", True)
    assert (got["d"]["text"], got["d"]["stood_in"]) == ("Turn the wheel", True)
    assert (got["e"]["text"], got["e"]["stood_in"], got["box"]["stood_in"]) == ("Unknown state.", False, False)


def test_copies_take_what_was_added_before(read):
    got = read("base = new ConditionalStep(this, box); base.addStep(has, letter); twin = base.copy(); base.addStep(sided, wheel); twin.addStep(inside, wheel); twin.addStep(has, wheel);")
    assert arms(got["base"]) == [("has", "letter"), ("sided", "wheel")]
    assert arms(got["twin"]) == [("has", "wheel"), ("inside", "wheel")] and got["twin"]["text"] == "Open the box"


def test_circles_say_nothing_and_long_chains_end(read):
    chain = ["s0 = box;"] + [f"s{k} = s{k - 1};" for k in range(1, 70)]
    got = read("x = y; y = z; z = x; into = x;", *chain)
    assert not {"x", "y", "z", "into"} & set(got) and got["s69"]["text"] == "Open the box"


@pytest.fixture
def plans(monkeypatch):
    """The plan that ran of every table that is settled."""
    seen, write = [], extract.settled

    def settled(df, name):
        df.collect()
        seen.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, name)

    monkeypatch.setattr(extract, "settled", settled)
    return seen


def test_no_names_go_through_the_driver(spark, plans):
    """However small the files of a settled table are, its rows are shuffled, not broadcast."""
    source = "class Quest extends Helper { void set() {" + SETUP + 'empty = new DetailedQuestStep(this, "Unknown state."); c = new ConditionalStep(this, empty); c.addStep(has, letter); d = c.copy(); } Step get() { return c; } }'
    got = extract.delegated(reader.read_sources(spark.createDataFrame([(1, source)], "file int, source string")))
    assert {r["name"]: r["text"] for r in got.collect()}["c"] == "Hand in the letter"
    plans.append(got._jdf.queryExecution().executedPlan().toString())
    assert all("isFinalPlan=true" in p for p in plans) and sum("SortMergeJoin" in p for p in plans) > 4
    assert not any("Broadcast" in p for p in plans)


def test_no_pointers_go_through_the_driver(spark, plans):
    source = "class Quest extends Helper { void set() {" + SETUP + "same = inner; third = same; x = y; y = x; } }"
    got = extract.resolved_steps(reader.read_sources(spark.createDataFrame([(1, source)], "file int, source string")))
    real = {r["name"]: (r["real"], r["type"]) for r in got.collect()}
    assert real["third"] == real["inner"] == ("box", "ObjectStep") and real["x"] == (None, None)
    plans.append(got._jdf.queryExecution().executedPlan().toString())
    assert sum("SortMergeJoin" in p for p in plans) > 3 and not any("Broadcast" in p for p in plans)
