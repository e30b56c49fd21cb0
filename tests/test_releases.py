"""Moves between releases, by hand and against every pairing."""

import random
from difflib import SequenceMatcher

from pyspark.sql import functions as F

from loomwork.operators import diff, graph


def test_likeness():
    assert diff.likeness("talk to the cook", "talk to the cook in lumbridge", 99)  # a long enough start
    assert diff.likeness("talk to", "talk to the cook", 0) is None  # too short a start
    assert diff.likeness("take the red bucket now", "take the blue bucket now", 2) > 0.85
    assert diff.likeness("take the red bucket now", "take the blue bucket now", 3) is None  # too far apart
    assert diff.likeness("abc", "xyz", 0) is None


def plain(removed, added):
    """Every pair scored in full, then claimed in old order."""
    free, out = sorted(added), []
    for ordinal, old_id, old in sorted(removed):
        scored = []
        for cand in free:
            a, b = sorted((old, cand[2]), key=len)
            ratio = SequenceMatcher(None, old, cand[2]).ratio()
            starts = len(a) >= 12 and b.startswith(a) and len(a) >= 0.4 * len(b)
            if starts or (ratio >= 0.85 and abs(ordinal - cand[0]) <= 2):
                scored.append((ratio, cand))
        if scored:
            best = max(r for r, _ in scored)
            pick = next(c for r, c in scored if r == best)
            free.remove(pick)
            out.append((old_id, pick[1]))
    return out


WORDS = ["take", "the", "red", "blue", "bucket", "and", "go", "to", "bank", "cook", "now"]
ROW = "section string, ordinal int, id string, text string"


def edited(rng, n, words):
    """A section and its next release, with copies, moves, additions and ties."""
    old = [(k, f"o{k}", " ".join(rng.choices(WORDS[:words], k=rng.randint(2, 7)))) for k in range(n)]
    new = [(k, f"n{k}", t if rng.random() < 0.3 else t + rng.choice([" now", "s", " and then some", ""])) for k, (_, _, t) in enumerate(old) if rng.random() < 0.8]
    return old, [(k, i, t) for k, (_, i, t) in enumerate(new)] if rng.random() < 0.5 else new


def test_migrations_against_all_pairs(spark):
    rng = random.Random(3)
    sections = [edited(rng, rng.randint(0, 14), rng.choice([2, 5, 11])) for _ in range(80)]
    sides = [spark.createDataFrame([(f"s{k}", *r) for k, s in enumerate(sections) for r in s[side]], ROW) for side in (0, 1)]
    want = sorted((f"s{k}", *pair) for k, (old, new) in enumerate(sections) for pair in plain(old, new))
    assert sorted(map(tuple, diff.migrations(*sides).collect())) == want and len(want) > 200


def test_one_long_section_is_divided(spark):
    """Lines far apart that are not alike share no part; copies share one, linked once."""
    n = 3000
    line = lambda k: f"{k * 7919 % 10007:05d} " + " ".join(WORDS[(k * p) % 11] for p in (3, 5, 7)) + f" {k:07d}"
    old = spark.createDataFrame([("s", k, f"o{k}", line(k)) for k in range(n)] + [("s", n + k, f"c{k}", "the very same line") for k in range(400)], ROW)
    new = spark.createDataFrame([("s", k, f"n{k}", line(k) + " and more") for k in range(n)] + [("s", n + k, f"d{k}", "the very same line now") for k in range(300)], ROW)
    got = {tuple(r)[1:] for r in diff.migrations(old, new).collect()}
    assert got == {(f"o{k}", f"n{k}") for k in range(n)} | {(f"c{k}", f"d{k}") for k in range(300)}
    rows = [spark.createDataFrame([("s", k, "same", k * 2 + side, side) for k in range(400)], "section string, ordinal long, text string, row long, cls long").withColumn("text", F.lit("the very same line")) for side in (0, 1)]
    links = diff.candidates(*rows)
    assert links.where("starts").count() == 1 and links.where("not starts").count() <= 5 * 400


def test_texts_that_start_one_another_need_no_matcher(spark, monkeypatch):
    """Their ratio follows from the lengths, with and without frequent letters; only other neighbours are compared."""
    rng, rows = random.Random(5), []
    for n in (1, 13, 199, 200, 201, 450):
        for letters in ("ab", "abcdefgh ", "".join(map(chr, range(97, 400)))):
            a = "".join(rng.choices(letters, k=n))
            rows += [(a, a + "".join(rng.choices(letters, k=rng.randint(0, n))))] * 2
    rows = [(a, b) if k % 2 else (b, a) for k, (a, b) in enumerate(rows)]
    got = spark.createDataFrame(rows, "old string, new string").select("old", "new", diff.started_ratio(F.length("old"), F.length("new")).alias("ratio")).collect()
    assert [r.ratio for r in got] == [SequenceMatcher(None, r.old, r.new).ratio() for r in got] and len(got) == 36

    asked, rated = [], diff._rated
    monkeypatch.setattr(diff, "_rated", lambda pairs: asked.extend((r.old, r.new) for r in pairs.collect()) or rated(pairs))
    old = spark.createDataFrame([("a", 0, "1", "talk to the cook today"), ("a", 9, "2", "take the red bucket now")], ROW)
    new = spark.createDataFrame([("a", 0, "8", "talk to the cook today!"), ("a", 9, "9", "take the blue bucket now")], ROW)
    assert sorted(tuple(r)[1:] for r in diff.migrations(old, new).collect()) == [("1", "8"), ("2", "9")]
    assert asked == [("take the red bucket now", "take the blue bucket now")]


def test_parts(spark):
    rng = random.Random(1)
    links = [(k, k + 1) for k in range(300)] + [(1000, 1000)] + [(2000 + rng.randrange(60), 2000 + rng.randrange(60)) for _ in range(40)] + [(5000, k) for k in range(4000, 4400)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {r.node: r.part for r in graph.parts(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for x in {x for link in links for x in link}}


def test_migrations(spark):
    old = spark.createDataFrame([("a", 0, "1", "talk to the cook today"), ("a", 1, "2", "fill the bucket with milk"), ("b", 0, "3", "talk to the cook today")], "section string, ordinal int, id string, text string")
    new = spark.createDataFrame([("a", 0, "9", "talk to the cook today please"), ("a", 1, "2", "fill the bucket with milk"), ("b", 5, "8", "something else entirely")], "section string, ordinal int, id string, text string")
    assert [tuple(r) for r in diff.migrations(old, new).collect()] == [("a", "1", "9")]


def test_carry(spark):
    carried = spark.createDataFrame([("a", "b"), ("x", "z"), ("c", "b"), ("k", "m")], "old_id string, new_id string")
    new = spark.createDataFrame([("b", "c"), ("x", "y"), ("m", "k")], "old_id string, new_id string")
    assert sorted(map(tuple, diff.carry(carried, new).collect())) == [("a", "c"), ("b", "c"), ("m", "k"), ("x", "y")]
