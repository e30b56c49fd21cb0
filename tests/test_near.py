"""Likeness and nearness joins against all pairs."""

import random

from pyspark.sql import functions as F

from loomwork.operators import resolve


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_no_alike_pair_is_lost(spark):
    rng = random.Random(8)
    letters = "ab" * 3 + "cdé "
    texts = {"".join(rng.choice(letters) for _ in range(rng.choice([0, 1, 2, 3, 4, 6, 9, 11, 12, 15, 30]))) for _ in range(150)}
    for t in sorted(texts)[:60]:
        s = list(t)
        for _ in range(rng.randrange(1, 5)):
            s.insert(rng.randrange(len(s) + 1), rng.choice(letters)) if rng.random() < 0.5 or not s else s.pop(rng.randrange(len(s)))
        texts.add("".join(s))
    texts |= {"aaaaaaaaaaaaaaaaaaaa", "aaaaaaaaaaaaaaaaaaaaaa", "the same long text of many words", "the same lng texts of many words"}
    rows = spark.createDataFrame([(t,) for t in sorted(texts)] * 2 + [(None,)], "t string")
    for most in (1, 3):
        want = {(a, b, d) for a in texts for b in texts if a < b and (d := edits(a, b)) <= most}
        got = [tuple(r) for r in resolve.alike(rows, "t", most).collect()]
        assert len(got) == len(set(got)) and set(got) == want and len(want) > 20


def test_nearest_alike(spark):
    rows = spark.createDataFrame([(1, "varrock"), (2, "varrok"), (3, "falador"), (4, "lumbridge"), (5, "lumbridge"), (6, None), (7, "lumbrige!")], "k int, t string")
    assert {tuple(r) for r in resolve.nearest_alike(rows, "k", "t", 2).collect()} == {(1, 1), (2, 1), (4, 0), (5, 0), (7, 2)}


def test_within_against_all_pairs(spark):
    rng = random.Random(2)
    points = [(k, rng.choice("pq"), rng.uniform(-50, 50), float(rng.randrange(-30, 30))) for k in range(150)] + [(900, None, 1.0, 1.0), (901, "p", None, 1.0)]
    rows = spark.createDataFrame(points, "k int, plane string, x double, y double")
    for limit in (4, 12.5):
        want = {(a[0], b[0]) for a in points for b in points if a[1] and a[1] == b[1] and None not in (a[2], b[2]) and abs(a[2] - b[2]) <= limit and abs(a[3] - b[3]) <= limit}
        got = resolve.within(rows, rows, ["plane"], ["x", "y"], limit)
        assert got.columns == ["k", "plane", "x", "y", "near_k", "near_plane", "near_x", "near_y"]
        pairs = [tuple(r) for r in got.select("k", "near_k").collect()]
        assert len(pairs) == len(set(pairs)) and set(pairs) == want
    assert resolve.within(rows.where(F.lit(False)), rows, ["plane"], ["x"], 3).count() == 0


def test_nearest_alike_against_all_pairs(spark):
    """Every bound, lengths down to none, and no pair that merely shares a frequent piece is needed."""
    rng = random.Random(5)
    texts = ["".join(rng.choice("ab ") for _ in range(rng.choice([0, 1, 2, 3, 4, 5, 7]))) for _ in range(40)]
    texts += ["".join(rng.choice("abcdefgh ") for _ in range(rng.choice([6, 8, 9, 12, 20]))) for _ in range(120)]
    for t in texts[60:120]:
        s = list(t)
        for _ in range(rng.randrange(1, 5)):
            s.insert(rng.randrange(len(s) + 1), rng.choice("abé")) if rng.random() < 0.5 or not s else s.pop(rng.randrange(len(s)))
        texts.append("".join(s))
    rows = spark.createDataFrame([*enumerate(texts), (9999, None)], "k int, t string")
    for most in (1, 2, 3):
        want = {}
        for i, a in enumerate(texts):
            d = min(edits(a, b) for j, b in enumerate(texts) if i != j)
            if d <= most:
                want[i] = d
        got = [tuple(r) for r in resolve.nearest_alike(rows, "k", "t", most).collect()]
        assert len(got) == len(want) and dict(got) == want


def test_close_pairs_ask_each_likeness_once(spark, monkeypatch):
    """As all pairs of a block say; a block of many rows with few texts makes few pairs."""
    from difflib import SequenceMatcher

    from loomwork.operators import loose

    rng = random.Random(3)
    names = ["hot ring", "hot rings", "cold ring", "small bolt", "smell bolt", "x", None]
    rows = [(rng.choice("pq"), k, rng.choice(names)) for k in range(120)] + [(None, 900, "hot ring")]
    want = set()
    for b, k, a in rows:
        if a is not None and b is not None:
            near = sorted((-SequenceMatcher(None, a, t).ratio(), o) for c, o, t in rows if c == b and o != k and t is not None)
            want |= {(b, k, o, -r, n + 1) for n, (r, o) in enumerate(near[:3]) if -r >= 0.62}
    df = spark.createDataFrame(rows, "b string, k int, t string")
    assert {tuple(r) for r in loose.close_pairs(df, df, "b", "k", "t", 3, 0.62).collect()} == want
    many = spark.range(30000).selectExpr("'b' as b", "id as k", "concat('name ', id % 7) as t")
    assert loose.close_pairs(many, many, "b", "k", "t", 2, 0.62).count() == 60000  # 900 million pairs of rows


def test_close_pairs_of_repeated_keys(spark):
    """Repeated rows and keys with several texts take no places from other keys."""
    from difflib import SequenceMatcher

    from loomwork.operators import loose

    rng = random.Random(4)
    rows = [("p", 1, "hot ring")] * 6 + [("p", 2, "hot ring"), ("p", 2, "hot ring"), ("p", 3, "hot rings")]
    rows += [("q", rng.randrange(8), rng.choice(["hot ring", "hot rings", "cold ring", "small bolt", "smell bolt"])) for _ in range(60)]
    want = set()
    for b, k in {(b, k) for b, k, _ in rows}:
        best = {}
        for a in {t for c, o, t in rows if (c, o) == (b, k)}:
            for c, o, t in rows:
                if c == b and o != k:
                    best[o] = max(best.get(o, 0), SequenceMatcher(None, a, t).ratio())
        near = sorted((-r, o) for o, r in best.items() if r >= 0.62)[:3]
        want |= {(b, k, o, -r, n + 1) for n, (r, o) in enumerate(near)}
    df = spark.createDataFrame(rows, "b string, k int, t string")
    got = [tuple(r) for r in loose.close_pairs(df, df, "b", "k", "t", 3, 0.62).collect()]
    assert len(got) == len(want) and set(got) == want and ("p", 1, 2, 1.0, 1) in want


def test_nearest_of_many_rows_at_few_places(spark):
    """Places meet, not rows: 200,000 by 20,000 rows at 40 places."""
    left = spark.range(200000).selectExpr("id as k", "id % 2 as p", "id % 20 * 7 as x", "id % 5 as y")
    right = spark.range(20000).selectExpr("id as s", "id % 2 as p", "id % 20 * 5 as x", "id % 3 as y")
    sites = {}
    for s in range(20000):
        sites.setdefault((s % 2, s % 20 * 5, s % 3), s)
    want = {}
    for k in range(20):
        near = [((x - k * 7) ** 2 + (y - k % 5) ** 2, s) for (p, x, y), s in sites.items() if p == k % 2 and abs(x - k * 7) <= 9 and abs(y - k % 5) <= 9]
        want[k] = min((d for d in near if d[0] <= 81), default=None)
    got = resolve.nearest_within(left, right, "k", "s", ["p"], ["x", "y"], 9)
    rows = got.where("k < 20").collect()
    assert {r.k: (r.distance, r.s) for r in rows} == {k: v for k, v in want.items() if v}
    assert got.count() == 10000 * len(rows)
