"""Pre-order and reachability of deep, wide and broken trees."""

import random

from loomwork.codebase import extract

NODES, EDGES = "node string, parent string, pos long", "a int, b int"


def walked(rows):
    kids, places, out = {}, {n: (p, n) for n, _, p in rows}, []
    for n, parent, _ in rows:
        kids.setdefault(parent, []).append(n)
    stack = [(n, 0) for n in sorted(kids.get(None, []), key=places.get, reverse=True)]
    while stack:
        n, depth = stack.pop()
        out.append((n, len(out), depth))
        stack += [(k, depth + 1) for k in sorted(kids.get(n, []), key=places.get, reverse=True)]
    return sorted(out)


def preorder(spark, rows):
    return sorted(map(tuple, extract.preorder(spark.createDataFrame(rows, NODES)).collect()))


def test_chain_of_five_thousand(spark):
    rows = [(f"n{k}", f"n{k - 1}" if k else None, 0) for k in range(5000)]
    assert preorder(spark, rows) == walked(rows)


def test_places_of_any_size(spark):
    rows = [("r", None, -3), ("s", None, 7), ("a", "r", 1234567), ("b", "r", 123457), ("c", "r", -1), ("d", "a", 10**15), ("e", "a", 2), ("f", "a", 2)]
    rng = random.Random(2)
    rows += [(f"x{k}", rng.choice(["s", "b", *(f"x{j}" for j in range(k))]), rng.randrange(4)) for k in range(200)]
    assert preorder(spark, rows) == walked(rows)


def test_broken_trees(spark):
    """A missing parent and a circle lead from no root."""
    rows = [("r", None, 0), ("a", "r", 0), ("lost", "gone", 0), ("under", "lost", 0), ("x", "y", 0), ("y", "x", 0)]
    assert preorder(spark, rows) == walked(rows) == [("a", 1, 1), ("r", 0, 0)]
    assert preorder(spark, []) == []


def test_reach_ends_after_so_many_nodes(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(3, 0), (100, 101), (101, 100), (5, None)], EDGES)
    starts = spark.createDataFrame([(0,), (38,), (100,), (7,)], "start int")
    got = extract.reachable(edges, "a", "b", starts, most=10)
    rows = {}
    for r in got.collect():
        rows.setdefault(r.start, []).append((r.node, r.depth, r.cut))
    assert sorted(rows[0]) == [(k, k, True) for k in range(11)]
    assert sorted(rows[38]) == [(38, 0, False), (39, 1, False), (40, 2, False)]
    assert sorted(rows[100]) == [(100, 0, False), (101, 1, False)] and len(rows[7]) == 11
