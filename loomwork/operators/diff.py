"""Release comparison: what came, went or was reworded, and where old ids lead."""

from __future__ import annotations

from collections import defaultdict, deque
from collections.abc import Iterator
from difflib import SequenceMatcher

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.tables import settled
from . import graph

PREFIX_CHARS, PREFIX_SHARE, RATIO, ORDINAL_GAP = 12, 0.4, 0.85, 2


def compare(old: DataFrame, new: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys and status: added, removed, reworded or same."""
    a = old.select(*keys, F.col(value).alias("old_value"), F.lit(1).alias("in_old"))
    b = new.select(*keys, F.col(value).alias("new_value"), F.lit(1).alias("in_new"))
    status = F.when(F.col("in_old").isNull(), "added").when(F.col("in_new").isNull(), "removed").when(F.col("old_value").eqNullSafe(F.col("new_value")), "same").otherwise("reworded")
    return a.join(b, keys, "full").select(*keys, status.alias("status"))


def likeness(old: str, new: str, gap: int) -> float | None:
    """How alike two texts are, if one may stand for the other: one starts the
    other for long enough, or they are alike and close by; else null.  The order
    of the two matters."""
    short, long = sorted((old, new), key=len)
    starts = len(short) >= PREFIX_CHARS and long.startswith(short) and len(short) >= PREFIX_SHARE * len(long)
    return ratio_of(old, new, starts) if starts or gap <= ORDINAL_GAP else None


def ratio_of(old: str, new: str, starts: bool) -> float | None:
    """The share of letters in common stretches; null below RATIO unless one text starts the other."""
    m = SequenceMatcher(None, old, new)
    if not starts and (m.real_quick_ratio() < RATIO or m.quick_ratio() < RATIO):
        return None
    ratio = m.ratio()
    return ratio if starts or ratio >= RATIO else None


def starting(short: DataFrame, long: DataFrame) -> DataFrame:
    """short, long, ratio: classes of texts of one section of which one starts the other for long enough.

    Both: section, text, cls.  A longer text is cut to those lengths that the
    section's shorter texts have, so the two meet by equality.
    """
    s = short.where(F.length("text") >= PREFIX_CHARS).select("section", "text", F.col("cls").alias("short"))
    lengths = s.groupBy("section").agg(F.collect_set(F.length("text")).alias("lengths"))
    n = F.length("text")
    fits = F.filter("lengths", lambda x: (x <= n) & (x >= n * PREFIX_SHARE))
    cut = long.join(lengths, "section").select("section", F.col("cls").alias("long"), "text", F.explode(fits).alias("n"))
    cut = cut.select("section", "long", F.substring("text", F.lit(1), F.col("n")).alias("text"), started_ratio(F.col("n"), n).alias("ratio"))
    return cut.join(s, ["section", "text"]).select("short", "long", "ratio")


def started_ratio(x: Column, y: Column) -> Column:
    """ratio_of() two texts of these lengths of which one starts the other.

    The longest stretch in common is then the whole shorter text, at the start
    of both: of equally long stretches of letters that are not too frequent the
    matcher takes the first, which stands at the same place in both, and widens
    it to either side.
    """
    return 2.0 * F.least(x, y) / (x + y)


def _rated(pairs: DataFrame) -> DataFrame:
    """pairs: a, b, old, new; those that are alike, with their ratio instead of the texts."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            ratio = [ratio_of(*r, False) for r in zip(f["old"], f["new"], strict=True)]
            yield f[["a", "b"]].assign(ratio=pd.Series(ratio, index=f.index, dtype=float)).dropna()

    return pairs.select("a", "b", "old", "new").mapInPandas(run, "a long, b long, ratio double")


def candidates(gone: DataFrame, come: DataFrame) -> DataFrame:
    """a, b, starts, ratio: of texts that start one another a link between their classes, of neighbours that are alike one between rows.

    Both sides: section, ordinal, text, row, cls.  Only neighbours of which
    neither starts the other are compared letter by letter.
    """
    a, b = (t.select("section", "text", "cls").distinct() for t in (gone, come))
    forth = starting(a, b).select(F.col("short").alias("a"), F.col("long").alias("b"), "ratio")
    back = starting(b, a).select(F.col("long").alias("a"), F.col("short").alias("b"), "ratio")
    begun = forth.unionByName(back).distinct()
    gaps = F.sequence(F.col("ordinal") - ORDINAL_GAP, F.col("ordinal") + ORDINAL_GAP)
    around = gone.select("section", F.col("row").alias("a"), F.col("text").alias("old"), F.explode(gaps).alias("ordinal"))
    close = around.join(come.select("section", "ordinal", F.col("row").alias("b"), F.col("text").alias("new")), ["section", "ordinal"])
    x, y = F.length("old"), F.length("new")
    close = settled(close.where(2 * F.least(x, y) >= RATIO * (x + y)), "neighbours")
    started = F.startswith("old", "new") | F.startswith("new", "old")
    same = close.where(started).select("a", "b", started_ratio(x, y).alias("ratio")).where(F.col("ratio") >= RATIO)
    near = same.unionByName(_rated(close.where(~started)))
    mark = lambda t, starts: t.select("a", "b", F.lit(starts).alias("starts"), "ratio")
    return settled(mark(begun, True).unionByName(mark(near, False)), "candidates")


def claimed(rows: list[tuple[bool, int, str, int, int]], links: list[tuple[int, int, bool, float]]) -> list[tuple[int, int]]:
    """Pairs of rows of one connected part: in old order, the most alike unclaimed candidate, the first of equals.

    rows: whether new, ordinal, id, row, class; links as in candidates().
    """
    place = {row: (ordinal, i, row) for _, ordinal, i, row, _ in rows}
    near, begun, free = defaultdict(list), defaultdict(list), defaultdict(list)
    for a, b, starts, ratio in links:
        (begun if starts else near)[a].append((ratio, b))
    for new, _, _, row, cls in rows:
        if new:
            free[cls].append(row)
    free = {cls: deque(sorted(own, key=place.get)) for cls, own in free.items()}
    taken, out = set(), []
    for row, cls in sorted(((row, cls) for new, _, _, row, cls in rows if not new), key=lambda r: place[r[0]]):
        found = [(-ratio, place[b]) for ratio, b in near[row] if b not in taken]
        for ratio, other in begun[cls]:
            own = free[other]
            while own and own[0] in taken:
                own.popleft()
            if own:
                found.append((-ratio, place[own[0]]))
        if found:
            best = min(found)[1][2]
            taken.add(best)
            out.append((row, best))
    return out


def _claims(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows and links, sorted by part; one part is held at a time."""
    part, rows, links = None, [], []

    def pairs() -> pa.RecordBatch:
        got = claimed(rows, links)
        return pa.RecordBatch.from_arrays([pa.array([pair[k] for pair in got], pa.int64()) for k in (0, 1)], ["a", "b"])

    for batch in batches:
        for r in zip(*(batch.column(k).to_pylist() for k in range(batch.num_columns)), strict=True):
            if r[0] != part:
                if links:
                    yield pairs()
                part, rows, links = r[0], [], []
            if r[1] is None:
                links.append(r[2:6])
            else:
                rows.append((r[1], *r[6:9], r[9]))
    if links:
        yield pairs()


def migrations(old: DataFrame, new: DataFrame) -> DataFrame:
    """section, ordinal, id, text on either side: section, old_id, new_id.

    Ids of a section that only one side has are matched: the text of one starts
    the other's for long enough, or they are alike and at most ORDINAL_GAP apart.
    Candidates are found by equality (of beginnings, of places), their likeness
    is asked once each, and old rows claim in order within a connected part of
    the candidates only; a section is divided into as many parts as it has.
    Equal texts of a section are one class, linked once.  Null and empty texts
    match nothing; of equal candidates the first by place, then id, is claimed.
    """
    old, new = (settled(t.select("section", "ordinal", "id", "text"), "ids") for t in (old, new))  # each is read twice
    sides = []
    for k, (own, other) in enumerate(((old, new), (new, old))):
        left = own.join(other.select("section", "id"), ["section", "id"], "left_anti").where("text <> ''")
        rows = settled(left.select("section", F.col("ordinal").cast("long").alias("ordinal"), F.col("id").cast("string").alias("id"), "text", (F.monotonically_increasing_id() * 2 + k).alias("row")), "unmatched")
        first = rows.groupBy("section", "text").agg(F.min("row").alias("cls"))
        sides.append(settled(rows.join(first, ["section", "text"]), "unmatched"))
    gone, come = sides
    links = candidates(gone, come)
    every = gone.withColumn("new", F.lit(False)).unionByName(come.withColumn("new", F.lit(True))).drop("text")
    begun = links.where("starts").select(F.explode(F.array("a", "b")).alias("cls")).distinct()
    classes = every.join(begun, "cls", "left_semi").select(F.col("row").alias("a"), F.col("cls").alias("b"))
    part = settled(graph.parts(links.select("a", "b").unionByName(classes)), "part")
    # A part with one row on either side has but one link to follow; only larger ones are sorted and read in order.
    members = settled(every.join(part, every["row"] == part["node"]), "members")
    own = lambda new: F.min(F.when(F.col("new") == new, F.col("row")))
    sizes = members.groupBy("part").agg(F.count(F.lit(1)).alias("n"), own(False).alias("a"), own(True).alias("b"))
    sizes = settled(sizes.withColumn("lone", (F.col("n") == 2) & F.col("a").isNotNull() & F.col("b").isNotNull()), "sizes")
    many = sizes.where("not lone").select("part")
    none = lambda kind: F.lit(None).cast(kind)
    members = members.join(many, "part", "left_semi").select(
        "part", "new", none("long").alias("a"), none("long").alias("b"), none("boolean").alias("starts"), none("double").alias("ratio"), "ordinal", "id", "row", "cls"
    )
    edges = links.join(part.join(many, "part", "left_semi"), links["a"] == F.col("node")).select(
        "part", none("boolean").alias("new"), "a", "b", "starts", "ratio", none("long").alias("ordinal"), none("string").alias("id"), none("long").alias("row"), none("long").alias("cls")
    )
    pairs = members.unionByName(edges).repartition("part").sortWithinPartitions("part").mapInArrow(_claims, "a long, b long")
    pairs = pairs.unionByName(sizes.where("lone").select("a", "b"))
    mine = gone.select(F.col("row").alias("a"), "section", F.col("id").alias("old_id"))
    return pairs.join(mine, "a").join(come.select(F.col("row").alias("b"), F.col("id").alias("new_id")), "b").select("section", "old_id", "new_id")


def carry(carried: DataFrame, new: DataFrame) -> DataFrame:
    """old_id, new_id: earlier migrations advanced one hop, new ones winning, self-maps dropped."""
    hop = new.select(F.col("old_id").alias("h_old"), F.col("new_id").alias("h_new"))
    moved = carried.join(hop, carried["new_id"] == hop["h_old"], "left").select("old_id", F.coalesce("h_new", "new_id").alias("new_id"))
    return moved.join(new, "old_id", "left_anti").unionByName(new.select("old_id", "new_id")).where("old_id <> new_id")
