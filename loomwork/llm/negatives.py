"""Hard-negative mining by norm-bucketed search.

Vectors become whole numbers (floor of SCALE times each component), and a row's
score is its exact inner product with an anchor.  Candidates are sorted by norm,
longest first, and packed into buckets of BUCKET rows; SPAN buckets in a row make
a span.  By Cauchy-Schwarz nothing in a bucket scores above the anchor's norm
times the bucket's longest, so once that falls below what an anchor still asks
for, the bucket and all after it are out: below the running k-th best score when
positives are sought, below the window's lower limit or its running k-th score
when negatives are.  Both searches first visit the span of the longest vectors,
write what they found, and visit only those further spans that the written k-th
scores leave open; within a span the scores go on rising bucket by bucket.

A task holds one block of BLOCK anchors and one span, whatever the table's size:
anchors are a stated query set, and every candidate is asked in blocks.  Found
rows are ranked by a window on the anchor (and its positive), each task giving
K of each at most.

Rows with a null id or label, a null vector or a component that is null or not
finite take no part.  Vectors of different lengths do not meet.  "Other" rows
have another id; rows that repeat an id count each, and a repeated anchor gives
its rows once for every distinct vector and label.  Equal scores go to the smaller
id.  Scores too large for exact doubles are computed with Python's integers, to
38 digits (beyond those all count as equal), and are shown as null where they do
not fit a long.  An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

SCALE = 256
BUCKET = 1024
SPAN = 16
BLOCK = 4096
#: Anchors whose scores with one bucket are held at once.
STRIP = 256
POSITIVES = 5
NEGATIVES = 3
LOW, HIGH, WHOLE = 50, 95, 100
_EXACT = float(1 << 51)
_MOST = 10**38 - 1
#: Room for rounding in products and quotients of norms.
_NEAR = 1e-9

_ROW = "vec_id long, label long, dim int, norm double, q binary"
_PACK = "span int, bucket int, dim int, n int, longest double, ids binary, labels binary, q binary"
_FOUND = "anchor_id long, copy int, place int, other_id long, score decimal(38,0)"


def vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", label: Column | None = None) -> DataFrame:
    """vec_id, label, dim, norm, q: the rows that take part, components as whole numbers in doubles."""
    own = rows.select(F.col(id_col).cast("long").alias("vec_id"), (F.col(label_col) if label is None else label).cast("long").alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    fine = F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return own.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & fine).mapInArrow(_whole, _ROW)


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        v = b.column("v")
        q = np.floor(SCALE * v.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
        dim = np.asarray(v.value_lengths().to_numpy(zero_copy_only=False), np.int64)
        ends = np.cumsum(dim)
        parts = [q[e - d : e] for e, d in zip(ends, dim, strict=True)]
        norm = [float(np.sqrt(np.dot(p, p))) for p in parts]
        cols = [b.column("vec_id"), b.column("label"), pa.array(dim, pa.int32()), pa.array(norm, pa.float64()), pa.array([p.astype("<f8").tobytes() for p in parts], pa.binary())]
        yield pa.RecordBatch.from_arrays(cols, ["vec_id", "label", "dim", "norm", "q"])


def _packer(per_pack: int, per_span: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sorted rows into packs of `per_pack`, each of one length; the first of a span's packs is the longest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def pack() -> pa.RecordBatch:
            nonlocal held, n
            ids, labels, norms, q = zip(*held, strict=True)
            m = np.frombuffer(b"".join(q), "<f8")
            small = m.astype("<f4")
            m = small if np.array_equal(small.astype("<f8"), m) else m
            row = [n // per_span, n % per_span, dim, len(ids), max(norms), np.array(ids, "<i8").tobytes(), np.array(labels, "<i8").tobytes(), m.tobytes()]
            kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.binary(), pa.binary(), pa.binary()]
            held, n = [], n + 1
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, kinds, strict=True)], ["span", "bucket", "dim", "n", "longest", "ids", "labels", "q"])

        dim = None
        for b in batches:
            for i, label, d, norm, q in zip(*(b.column(c).to_pylist() for c in ("vec_id", "label", "dim", "norm", "q")), strict=True):
                if held and (d != dim or len(held) == per_pack):
                    yield pack()
                dim = d
                held.append((i, label, norm, q))
        if held:
            yield pack()

    return run


def packed(rows: DataFrame, per_pack: int, per_span: int, name: str) -> DataFrame:
    """The rows by norm, longest first, as packs; spans are numbered through all ranges, from 0 for the longest vectors.

    Rows are dealt by range of (norm, id), so equal norms are divided too.
    """
    ranges = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("norm").desc(), F.col("vec_id"), F.xxhash64("q")]
    dealt = rows.repartitionByRange(ranges, *order).sortWithinPartitions(F.col("dim"), *order)
    packs = dealt.mapInArrow(_packer(per_pack, per_span), _PACK).withColumn("range", F.spark_partition_id())
    packs = materialise(packs, name)
    spans = packs.groupBy("range").agg(F.max("span").alias("m"))
    before = spans.select("range", (F.sum(F.col("m") + 1).over(Window.orderBy("range")) - F.col("m") - 1).alias("b"))
    return packs.join(F.broadcast(before), "range").withColumn("span", (F.col("b") + F.col("span")).cast("int")).drop("range", "b")


def _matrix(row: dict) -> np.ndarray:
    kind = "<f4" if len(row["q"]) == 4 * row["n"] * row["dim"] else "<f8"
    return np.frombuffer(row["q"], kind).reshape(row["n"], row["dim"]).astype(np.float64)


def _scores(a: np.ndarray, b: np.ndarray, longest: float) -> np.ndarray:
    """Exact inner products: int64, or Python's integers where doubles or 62 bits would not do."""
    most = float(np.sqrt((a * a).sum(1).max(initial=0.0))) * longest
    if most < _EXACT:
        return (a @ b.T).astype(np.int64)
    big = lambda m: np.array([[int(x) for x in r] for r in m], object).reshape(m.shape)
    return big(a).dot(big(b).T)


def _window(p: int | None) -> tuple[int | None, int | None]:
    """The scores that a positive's score leaves to its negatives, both ends included."""
    return (None, None) if p is None else (-(-LOW * p // WHOLE), HIGH * p // WHOLE)


class _Wanted:
    """What one window of an anchor asks for, and the k best (score, then smaller id) found so far."""

    def __init__(self, k: int, p: int | None, kth: int | None) -> None:
        self.k, self.found = k, []
        self.low, self.high = _window(p)
        self.least = max((x for x in (self.low, kth) if x is not None), default=None)

    def add(self, score: np.ndarray, ids: np.ndarray, fits: np.ndarray) -> None:
        if self.least is not None:
            fits = fits & (score >= self.least)
        if self.high is not None:
            fits = fits & (score <= self.high)
        j = np.flatnonzero(fits)
        if not len(j):
            return
        if score.dtype == object:
            j = sorted(j.tolist(), key=lambda x: (-score[x], ids[x]))[: self.k]
        else:
            j = j[np.lexsort((ids[j], -score[j]))[: self.k]]
        self.found = sorted([*self.found, *((-int(score[x]), int(ids[x])) for x in j)])[: self.k]
        if len(self.found) == self.k:
            self.least = max(-self.found[-1][0], self.least if self.least is not None else -self.found[-1][0])


def _searcher(k: int, same: bool) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """One block of anchors against one span of candidates: those of the same label and another id, or those of other labels."""

    def run(asked: pa.Table, packs: pa.Table) -> pa.Table:
        rows, spans = asked.to_pylist(), packs.to_pylist()
        number = lambda x: None if x is None else int(x)
        wanted = [{w["place"]: _Wanted(k, number(w["p"]), number(w["kth"])) for w in r["windows"]} for r in rows]
        for dim in {r["dim"] for r in rows}:
            own = np.array([n for n, r in enumerate(rows) if r["dim"] == dim])
            a = np.array([np.frombuffer(rows[n]["q"], "<f8") for n in own]).reshape(len(own), dim)
            norm = np.array([rows[n]["norm"] for n in own])
            label, ids = (np.array([rows[n][c] for n in own], np.int64) for c in ("label", "anchor_id"))
            for p in sorted((p for p in spans if p["dim"] == dim), key=lambda p: -p["longest"]):
                least = [min((-np.inf if w.least is None else float(w.least) for w in wanted[n].values()), default=np.inf) for n in own]
                still = np.flatnonzero(norm * p["longest"] * (1 + _NEAR) + 1 >= np.array(least) * (1 - _NEAR))
                if not len(still):
                    break  # all that follow are shorter
                b, their_id, their_label = _matrix(p), np.frombuffer(p["ids"], "<i8"), np.frombuffer(p["labels"], "<i8")
                for at in range(0, len(still), STRIP):
                    some = still[at : at + STRIP]
                    s = _scores(a[some], b, p["longest"])
                    alike = label[some, None] == their_label
                    fits = alike & (ids[some, None] != their_id) if same else ~alike
                    for i, n in enumerate(own[some].tolist()):
                        for w in wanted[n].values():
                            w.add(s[i], their_id, fits[i])
        out = [(r["anchor_id"], r["copy"], place, i, Decimal(max(-_MOST, min(_MOST, -s)))) for r, ws in zip(rows, wanted, strict=True) for place, w in ws.items() for s, i in w.found]
        cols = list(zip(*out, strict=True)) or [[]] * 5
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.decimal128(38, 0)]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], ["anchor_id", "copy", "place", "other_id", "score"])

    return run


def _found(asked: DataFrame, packs: DataFrame, k: int, same: bool) -> DataFrame:
    """asked and packs, dealt by block and span, to the found rows of each."""
    return asked.groupBy("block", "span").cogroup(packs.groupBy("block", "span")).applyInArrow(_searcher(k, same), _FOUND)


def _asked(anchors: DataFrame, windows: DataFrame) -> DataFrame:
    """anchors with their windows (place, p, kth) as an array; those without any ask for nothing."""
    each = windows.groupBy("anchor_id", "copy").agg(F.collect_list(F.struct("place", "p", "kth")).alias("windows"))
    return anchors.join(each, ["anchor_id", "copy"])


def search(anchors: DataFrame, packs: DataFrame, windows: DataFrame, k: int, same: bool, name: str) -> DataFrame:
    """anchor_id, copy, place, rank, other_id, score: the k best of every window, by norm-bucketed search.

    windows: anchor_id, copy, place, p, where p is the positive's score that sets
    the limits, or null for none.
    """
    blocks = int(anchors.agg(F.max("block")).first()[0] or 0) + 1
    every = packs.where("span = 0").withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    kth = F.lit(None).cast("decimal(38,0)")
    asked = _asked(anchors, windows.withColumn("kth", kth))
    first = materialise(_found(asked.withColumn("span", F.lit(0)), every, k, same), f"{name}-first")
    full = first.groupBy("anchor_id", "copy", "place").agg(F.count(F.lit(1)).alias("c"), F.min("score").alias("kth")).where(F.col("c") == k).drop("c")
    asked = materialise(_asked(anchors, windows.join(full, ["anchor_id", "copy", "place"], "left")), f"{name}-asked")
    spans = packs.where("span > 0").groupBy("span").agg(F.max("longest").alias("longest"))
    last = int(packs.agg(F.max("span")).first()[0] or 0)
    of = lambda w: F.greatest(w["kth"].cast("double"), w["p"].cast("double") * (LOW / WHOLE))
    least = F.array_min(F.transform("windows", lambda w: F.coalesce(of(w), F.lit(float("-inf")))))
    needs = F.when(least <= 0, float("-inf")).otherwise((least - 1) / F.col("norm")) * (1 - 10 * _NEAR)
    limits = asked.groupBy("block").agg(F.min(needs).alias("needs")).withColumn("span", F.explode(F.sequence(F.lit(1), F.lit(last))) if last else F.lit(1))
    open_ = materialise(limits.join(spans, "span").where("longest >= needs").select("block", "span"), f"{name}-open")
    rest = _found(asked.join(open_, "block"), packs.join(open_, "span"), k, same)
    both = first.unionByName(materialise(rest, f"{name}-rest"))
    rank = F.row_number().over(Window.partitionBy("anchor_id", "copy", "place").orderBy(F.col("score").desc(), "other_id"))
    return both.withColumn("rank", rank).where(F.col("rank") <= k)


def hard_negatives(rows: DataFrame, is_anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", label: Column | None = None, bucket: int = BUCKET, span: int = SPAN, block: int = BLOCK) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    is_anchor and label are expressions over the table's own columns; label
    replaces the label column where it is given.
    """
    own = materialise(vectors(rows, id_col, vector_col, label_col, label), "vectors")
    packs = packed(own, bucket, span, "vector-packs")
    ids = rows.where(is_anchor).select(F.col(id_col).cast("long").alias("vec_id")).distinct()
    chosen = own.join(ids, "vec_id", "left_semi").select(F.col("vec_id").alias("anchor_id"), "label", "dim", "norm", "q").distinct()
    blocks = max(1, -(-chosen.count() // block))
    copy = F.row_number().over(Window.partitionBy("anchor_id").orderBy("label", "q"))
    anchors = materialise(chosen.withColumn("copy", copy).withColumn("block", F.pmod(F.xxhash64("anchor_id"), F.lit(blocks)).cast("int")), "anchors")
    every = anchors.select("anchor_id", "copy", F.lit(0).alias("place"), F.lit(None).cast("decimal(38,0)").alias("p"))
    positives = materialise(search(anchors, packs, every, POSITIVES, True, "positives"), "positives")
    windows = positives.where("score >= 0").select("anchor_id", "copy", F.col("rank").alias("place"), F.col("score").alias("p"))
    negatives = search(anchors, packs, windows, NEGATIVES, False, "negatives")
    p = positives.select("anchor_id", "copy", F.col("rank").alias("place"), F.col("other_id").alias("positive_id"), F.col("score").alias("p"))
    fits = lambda c: F.expr(f"try_cast({c} as long)")
    return negatives.join(p, ["anchor_id", "copy", "place"]).select(
        "anchor_id", "positive_id", "rank", F.col("other_id").alias("negative_id"), fits("p").alias("positive_score"), fits("score").alias("negative_score")
    )


def mined(rows: DataFrame, **sizes) -> DataFrame:
    """The hard negatives of the anchors whose id is divisible by 50, labels of ids divisible by 7 moved on by one."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows, F.col("vec_id") % 50 == 0, label=label, **sizes)


ORACLE_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS alike, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
), p AS (
  SELECT * FROM s WHERE alike QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, p.other_id AS positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, p.other_id ORDER BY s.score DESC, s.other_id) AS INTEGER) AS rank,
       s.other_id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.alike AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score
QUALIFY rank <= 3
"""
