"""Cases of the merge that tables cannot hold, and edges of the sources."""

import pytest

from pyspark.sql import functions as F

from loomwork.operators import gates, loose, merge, reports, resolve, sequence
from loomwork.sources import files, lookup, sinks


def test_unknown_references_and_repeated_keys_stop(spark):
    t = spark.createDataFrame([("a",), ("b",)], "k string")
    assert merge.referenced(t, "k", spark.createDataFrame([("a",), (None,)], "x string")).count() == 1
    with pytest.raises(ValueError, match="unknown k"):
        merge.referenced(t, "k", spark.createDataFrame([("z",)], "x string"))
    with pytest.raises(ValueError, match="several rows"):
        merge.attached(t, "k", spark.createDataFrame([("a", 1), ("a", 2)], "k string, v int"))


def test_errors_stop_a_check_and_notes_do_not(spark):
    rows = spark.createDataFrame([("x", "1")], "key string, value string")
    none = rows.where("false")
    assert gates.checked(gates.curated_problems(rows, "key", "value", none, "value", "note")).count() == 1
    with pytest.raises(ValueError, match="x: 1"):
        gates.checked(gates.curated_problems(rows, "key", "value", none, "value"))


def test_place_streams_over_nulls_and_keys(spark):
    rows = [("a", 1, [5, 3]), ("a", 2, [4, 9]), ("a", 3, None), ("a", 4, [2]), ("a", 5, [None, 9]), (None, 1, [7]), (None, 2, [8, 6])]
    got = sequence.monotone_place(spark.createDataFrame(rows, "k string, o int, c array<bigint>"), ["k"], "o", "c")
    assert {(r.k, r.o): r.placed for r in got.collect()} == {("a", 1): 3, ("a", 2): 4, ("a", 3): None, ("a", 4): None, ("a", 5): 9, (None, 1): 7, (None, 2): 8}


def test_missing_files(spark, tmp_path):
    assert files.optional_json(spark, str(tmp_path / "none"), "a int").count() == 0
    assert files.yaml_rows(spark, str(tmp_path / "none.yaml")).count() == 0
    (tmp_path / "c.yaml").write_text("1: [a, b]\nx: {y: 2}\n", encoding="utf-8")
    assert sorted(map(tuple, files.yaml_rows(spark, str(tmp_path / "c.yaml")).collect())) == [("1", '["a", "b"]'), ("x", '{"y": 2}')]
    (tmp_path / "a.txt").write_text("one", encoding="utf-8")
    assert sinks.packed(spark, [str(tmp_path / "a.txt")]).count() == 1
    with pytest.raises(Exception):
        sinks.packed(spark, [str(tmp_path / "a.txt"), str(tmp_path / "b.txt")])


def test_one_page_and_failing_lookups(spark):
    assert files.one_page(spark, "p", lambda p: {"text": "t", "revision": 3}).first().revision == 3
    for answer in ({"error": "no"}, {"text": "", "revision": 1}):
        with pytest.raises(RuntimeError):
            files.one_page(spark, "p", lambda p, a=answer: a)
    keys = spark.createDataFrame([(1,)], "k int")
    with pytest.raises(Exception):
        lookup.fetched(keys, "k", lambda ks: 1 / 0).collect()
    assert files.newest(["v1.9.jar", "v1.10.jar"]) == "v1.9.jar" and files.newest([]) is None


def test_containment_against_all_pairs(spark):
    """Short and long phrases, in the middle of words, at the ends, in other cases; nothing is in nothing."""
    texts = ["Talk to the Cook's friend", "a", "", None, "ab", "Straße zum Schloss", "cook", "the the the", "x" * 300 + "Cook"]
    phrases = ["cook", "A", "the", "STRASSE", "straße", "", "ok's f", "ab", "xx", "zum schloss"]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    side = spark.createDataFrame([(p,) for p in phrases], "p string")
    got = {(r.i, r.p) for r in loose.containing(rows, "t", side, "p").collect()}
    assert got == {(i, p) for i, t in enumerate(texts) for p in phrases if t and p and p.lower() in t.lower()}
    whole = {(r.i, r.p) for r in loose.containing(rows, "t", side, "p", whole_words=True).collect()}
    assert (0, "cook") in whole and (8, "cook") not in whole and (7, "the") in whole and (0, "ok's f") not in whole


def test_phrases_in_blocks(spark):
    rows = spark.createDataFrame([(1, "the cook"), (2, "a cat"), (3, None)], "i int, t string")
    side = spark.createDataFrame([("cook", 1), ("cat", 2), ("Cat", 3), ("dog", 4), (None, 5)], "p string, n int")
    for block in (loose.BLOCK_BYTES, 70):
        got = loose.containing(rows, "t", side, "p", block_bytes=block)
        assert {tuple(r) for r in got.select("i", "p", "n").collect()} == {(1, "cook", 1), (2, "cat", 2), (2, "Cat", 3)}
        assert ("Union" in got._jdf.queryExecution().toString()) == (block == 70)


def test_suggestions(spark):
    got = loose.suggestions(spark.createDataFrame([("Varrok",), ("zzz",), (None,)], "t string"), "t", ["Varrock", "Falador"])
    assert {r.t: r.suggested for r in got.collect()} == {"Varrok": ["Varrock"], "zzz": [], None: []}


def test_union_in_order_over_uneven_tables(spark):
    a = spark.createDataFrame([("x", 10**12), ("y", -5), ("x", 3)], "value string, o long")
    b = spark.createDataFrame([("z", 0), ("y", 1), ("w", 0)], "value string, o long")
    got = reports.union_in_order((a, "o"), (b, "o"))
    assert [r.value for r in got.orderBy("place").collect()] == ["y", "x", "w", "z"] and sorted(r.place for r in got.collect()) == [0, 1, 2, 3]


def test_partners_are_the_first_others(spark):
    rows = spark.createDataFrame([("g", k) for k in (5, 3, 9, 1, 7, 3)] + [("h", 1)], "g string, m int")
    got = {}
    for r in resolve.partners(rows, "g", "m", 2).collect():
        got.setdefault((r.g, r.m), []).append(r.partner)
    assert {k: sorted(v) for k, v in got.items()} == {("g", 1): [3, 5], ("g", 3): [1, 5], ("g", 5): [1, 3], ("g", 7): [1, 3], ("g", 9): [1, 3]}


def test_canonical_json():
    assert reports.canonical('{"b": [{"x": 1, "a": 2}], "a": null}', ("x",)) == '{"a":null,"b":[{"a":2}]}'
    assert reports.canonical("{nope") is None and reports.canonical(None) is None


def test_milestones_by_hand(spark):
    rows = [(1, "Start X by talking to Bob", "q", 5, None, None), (2, "Start X", "q", 5, None, None), (3, "Continue X until you get sand", "q", None, "sand", [1]),
            (4, "Do X to unlock the door", "q", None, None, None), (5, "Start X", None, 5, None, None), (6, "Start X and kill Bob, talk to him", "q", 5, None, None)]
    df = spark.createDataFrame([("s", *r) for r in rows], "s string, o int, t string, q string, v int, stop string, ids array<int>")
    got = merge.milestones(df, ["s"], "o", "t", "q", "v", "stop", "ids")
    assert {r.o: (r.follow, r.stop_unresolved, r.start_only, r.done_at) for r in got.select("o", "follow", "stop_unresolved", "start_only", F.col("done_at")).collect()} == {
        1: (False, False, True, 5), 2: (False, False, True, 5), 3: (True, False, False, None), 4: (False, True, False, None), 5: (False, False, False, None), 6: (False, False, False, None),
    }


def test_prose_texts_meet_nothing_twice(spark):
    """Names go before aliases, which end a word, without the texts being joined again."""
    rows = spark.createDataFrame([(1, "the wonder"), (2, "Wonder der"), (3, "order, wonderful"), (4, "wonders"), (5, None), (6, "x-der_ der")], "k int, t string")
    got = merge.quest_in_prose(rows, "k", "t", spark.createDataFrame([("the",), ("The W",)], "quest string"), spark.createDataFrame([("der", "D"), ("wonder", "W")], "written string, quest string"))
    assert {tuple(r) for r in got.collect()} == {(1, "The W", "The W"), (2, "W", "wonder"), (3, "D", "der"), (6, "D", "der")}
    assert "LeftAnti" not in got._jdf.queryExecution().optimizedPlan().toString()
