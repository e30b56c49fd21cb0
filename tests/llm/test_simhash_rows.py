"""Near copies where ids are missing or have several texts."""

from collections import Counter

import pytest

pytest.importorskip("loomwork.llm")
from loomwork.llm import simhash  # noqa: E402

A, C = "one clean text about boats on a lake", "another clean text about trains in winter"
B = " ".join(f"w{k}" for k in range(400))


def kept(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return Counter(map(tuple, simhash.drop_near_duplicates(docs).collect()))


def test_null_ids_leave_by_row(spark):
    assert kept(spark, [(1, B), (None, B), (None, A)]) == Counter([(1, B), (None, A)])


def test_id_with_two_texts_leaves_by_row(spark):
    other = B.upper()
    assert kept(spark, [(5, A), (5, B), (3, other), (None, C)]) == Counter([(5, A), (3, other), (None, C)])


def test_null_ids_link(spark):
    """Neighbours of the three are one or two bits apart, the outer two more."""
    one, two, three = (" ".join(f"w{k}" for k in range(n)) for n in (46, 47, 48))
    fp = [simhash.fingerprint(t) for t in (one, two, three)]
    assert [(fp[a] ^ fp[b]).bit_count() for a, b in ((0, 1), (1, 2), (0, 2))] == [1, 2, 3]
    docs = spark.createDataFrame([(7, one), (None, two), (4, three), (None, A)], "doc_id long, text string")
    got = Counter((r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect())
    assert got == Counter([(7, 4), (None, 4), (4, 4), (None, None)])
    assert kept(spark, [(7, one), (None, two), (4, three), (None, A)]) == Counter([(4, three), (None, A)])
    assert kept(spark, [(7, one), (7, two)]).total() == 1


def test_rounds_of_components_are_one_plain_table_each(spark):
    """The driver commits one table a round, without a mark of success; a long chain still gets its smallest node."""
    import math
    from pathlib import Path

    from loomwork.llm.components import components
    from loomwork.plans.tables import scratch, settled

    settled(spark.range(3), "before")
    place = Path(scratch(spark).removeprefix("file://"))
    old = set(place.iterdir())
    n = 300
    edges = spark.createDataFrame([(a, b) for k in range(n - 1) for a, b in ((k * 7 % n, (k + 1) * 7 % n), ((k + 1) * 7 % n, k * 7 % n))], "a long, b long")
    assert {(r.node, r.label) for r in components(edges).collect()} == {(k, 0) for k in range(n)}
    new = set(place.iterdir()) - old
    assert len(new) <= 2 + 2 * math.ceil(math.log2(n))
    assert all(any(p.glob("*.parquet")) and not (p / "_SUCCESS").exists() for p in new)


def joins(df):
    """The joins and broadcasts of a plan, chosen by the sizes that Spark supposes."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line.strip(" :+-*|") for line in plan.splitlines() if "Join" in line or "BroadcastExchange" in line]


def test_anchors_do_not_go_through_the_driver(spark, monkeypatch):
    """Fingerprints weigh little as files; what is made of them has some sixty rows for each and is shuffled, as is all that meets later."""
    from loomwork.llm import components
    from loomwork.plans.tables import settled

    seen = []

    def watched(df, name):
        seen.extend(joins(df))
        return settled(df, name)

    monkeypatch.setattr(simhash, "materialise", watched)
    monkeypatch.setattr(components, "materialise", watched)
    texts = [" ".join(f"w{k}" for k in range(n)) for n in (46, 47, 48)] + [A, B, C]
    docs = spark.createDataFrame([(k, texts[k % 6]) for k in range(600)], "doc_id long, text string")
    got = simhash.near_duplicates(docs)
    seen += joins(got)
    assert {(r.doc_id, r.component_id) for r in got.collect()} == {(k, 0 if k % 6 < 3 else k % 6) for k in range(600)}
    assert sum("SortMergeJoin" in x for x in seen) >= 6 and not [x for x in seen if "Broadcast" in x]


def test_lists_of_copies_do_not_go_through_the_driver(spark):
    """Rows that leave and groups of copies, one row for each of a group's slices, are shuffled; only filters' words are sent to all."""
    from loomwork.llm import exact

    docs = spark.createDataFrame([(k, [A, B, C][k % 3] if k % 2 else f"{A} {k}") for k in range(60)], "doc_id long, text string")
    copies, near = exact.drop_copies(docs), simhash.drop_near_duplicates(docs)
    assert copies.count() == 33 and {A, B, C} <= {r.text for r in copies.collect()}
    near.collect()
    groups = [x for x in joins(copies) if "Join" in x and "__loom_sha" in x]
    leaves = [x for x in joins(near) if "Join" in x and "LeftAnti" in x]
    assert groups and leaves and all("SortMergeJoin" in x for x in groups + leaves)
