"""SimHash near-duplicates, linked through anchor-point covering.

Fingerprints of 64 bits vote over the XXH64 (seed 42) of a text's three-word
shingles.  To find all pairs within two bits, anchors are the words of a
covering code over the first 46 bits: two perfect binary Golay codes of length
23, each of covering radius 3.  A fingerprint has one home anchor, at most 3
bits away in either block; it is replicated to every anchor within 5 bits in
either block and 8 in all (covering radius plus threshold).  Of two linked
fingerprints the one is thus at the home anchor of the other, and both are
compared there, over all 64 bits.  Only distinct fingerprints are replicated.

Null or empty texts have fingerprint zero and link like any other.  Repeated
rows share a fingerprint.  Fingerprints are linked whatever the ids of their
rows.  A row with a null id gets its component, and links others, but never
names one; a component of null ids only is null.

A bit that exactly half of the shingles have set is 0.  An empty table gives an
empty result.  Texts of any length are read whole; other columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.tables import beside
from .common import id_and_text, materialise, salt
from .components import components
from .exact import without

WORDS = 3
THRESHOLD = 2
RADIUS = 3
BLOCK = 23
SEED = 42
#: Generator polynomial of the binary Golay code of length 23.
GOLAY = 0xC75

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def shingle_hashes(text: str) -> np.ndarray:
    """Big-endian XXH64 of every shingle, in order, repeats included."""
    words = text.encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return np.empty(0, ">u8")
    line, x = b" ".join(words), xxhash.xxh64_digest
    if len(words) <= WORDS:
        return np.frombuffer(x(line, SEED), ">u8")
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[:-WORDS]]).tolist()
    return np.frombuffer(b"".join([x(line[a:b], SEED) for a, b in zip(starts, (ends[WORDS - 1 :] - 1).tolist(), strict=True)]), ">u8")


def fingerprint(text: str) -> int:
    h = shingle_hashes(text)
    votes = np.zeros(64, np.int64)
    for a in range(0, len(h), 1 << 15):
        bits = np.unpackbits(h[a : a + (1 << 15)].view(np.uint8).reshape(-1, 8), axis=1)
        votes += bits.sum(axis=0, dtype=np.uint16 if len(bits) < 1 << 16 else np.int64)
    return int.from_bytes(np.packbits(votes * 2 > len(h)).tobytes(), "big", signed=True)


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array([fingerprint(t) for t in batch.column(1).to_pylist()], pa.int64())], ["doc_id", "text_key", "fp"])


def _reduced(x: int) -> int:
    """Remainder modulo the generator: the syndrome."""
    for b in range(BLOCK - 1, 10, -1):
        if x >> b & 1:
            x ^= GOLAY << (b - 11)
    return x


@cache
def tables() -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Syndromes by byte of a block; by syndrome, the error patterns of at most
    RADIUS + THRESHOLD bits (padded by -1, lightest first) and their weights."""
    unit = [_reduced(1 << b) for b in range(BLOCK)]
    by_byte = []
    for lo in (0, 8, 16):
        part = np.zeros(256, np.int64)
        for v in range(256):
            for b in range(8):
                if v >> b & 1 and lo + b < BLOCK:
                    part[v] ^= unit[lo + b]
        by_byte.append(part)
    found: list[list[tuple[int, int]]] = [[] for _ in range(1 << 11)]
    for weight in range(RADIUS + THRESHOLD + 1):
        for at in combinations(range(BLOCK), weight):
            s = 0
            for b in at:
                s ^= unit[b]
            found[s].append((sum(1 << b for b in at), weight))
    widest = max(map(len, found))
    pattern, heavy = np.full((1 << 11, widest), -1, np.int64), np.full((1 << 11, widest), 99, np.int16)
    for s, row in enumerate(found):
        pattern[s, : len(row)] = [e for e, _ in row]
        heavy[s, : len(row)] = [w for _, w in row]
    return by_byte, pattern, heavy


def anchors(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Home anchor of each fingerprint, then all its anchors as (row, anchor)."""
    by_byte, pattern, heavy = tables()
    words, weights = [], []
    for k in (0, 1):
        x = (fps.astype(np.uint64) >> np.uint64(BLOCK * k)).astype(np.int64) & ((1 << BLOCK) - 1)
        s = by_byte[0][x & 255] ^ by_byte[1][x >> 8 & 255] ^ by_byte[2][x >> 16]
        words.append(x[:, None] ^ pattern[s])
        weights.append(heavy[s])
    home = (words[1][:, 0] << BLOCK) | words[0][:, 0]
    near = weights[0][:, :, None] + weights[1][:, None, :] <= 2 * RADIUS + THRESHOLD
    row, i, j = np.nonzero(near)
    return home, row, (words[1][row, j] << BLOCK) | words[0][row, i]


def _replicas(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a in range(0, batch.num_rows, 4096):
            fp = batch.column(0).slice(a, 4096).to_numpy()
            _, row, anchor = anchors(fp)
            yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(fp[row])], ["anchor", "fp"])


def _homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fp = batch.column(0).to_numpy()
        home = np.concatenate([anchors(fp[a : a + 4096])[0] for a in range(0, len(fp), 4096)]) if len(fp) else np.empty(0, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(home, pa.int64()), batch.column(0)], ["home", "home_fp"])


def links(fps: DataFrame) -> DataFrame:
    """fps: fp (distinct fingerprints).  a, b: linked fingerprints, both directions.

    A fingerprint has some sixty anchors, of which Spark's sizes know nothing:
    the two sides meet by a shuffle, never through the driver.
    """
    replica = fps.mapInArrow(_replicas, "anchor long, fp long")
    home = fps.mapInArrow(_homes, "home long, home_fp long")
    close = (F.col("home") == F.col("anchor")) & (F.col("home_fp") != F.col("fp")) & (F.bit_count(F.col("home_fp").bitwiseXOR(F.col("fp"))) <= THRESHOLD)
    return beside(home, replica, close).select(F.col("home_fp").alias("a"), F.col("fp").alias("b"))


def _found(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text_key (XXH64 of the text), fp, component_id, first_fp: one row per input row.

    first_fp is the smallest fingerprint under the id that names the component.
    """
    own = id_and_text(docs, id_col, text_col).select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    rows = materialise(own.mapInArrow(_fingerprints, "doc_id long, text_key long, fp long"), "fingerprints")
    sliced = rows.withColumn("salt", salt(docs.sparkSession, "doc_id"))
    part = sliced.groupBy("fp", "salt").agg(F.min("doc_id").alias("rep"))
    reps = materialise(part.groupBy("fp").agg(F.min("rep").alias("rep"), F.collect_set("salt").alias("salts")), "distinct")
    label = components(links(reps.select("fp")))
    linked = materialise(beside(label, reps, label["node"] == reps["fp"]).select("node", "label", "rep"), "linked")
    least = F.min(F.when(F.col("rep").isNotNull(), F.struct("rep", "node")))
    first = materialise(linked.groupBy("label").agg(least.alias("first")).select(F.col("label").alias("of"), "first.rep", "first.node"), "first")
    member = beside(linked, first, linked["label"] == first["of"]).select(linked["node"], first["rep"].alias("component_id"), first["node"].alias("first_fp"))
    alone = F.col("node").isNull()
    named = beside(reps, member, reps["fp"] == member["node"], "left").select(
        "fp",
        F.explode("salts").alias("salt"),
        F.when(alone, F.col("rep")).otherwise(F.col("component_id")).alias("component_id"),
        F.when(alone, F.col("fp")).otherwise(F.col("first_fp")).alias("first_fp"),
    )
    return beside(sliced, named, ["fp", "salt"]).select("doc_id", "text_key", "fp", "component_id", "first_fp")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id: one row per input row."""
    return _found(docs, id_col, text_col).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with the row of the smallest id of every component (of its fingerprints
    there, the smallest), and all rows of components without an id; all columns.

    Every row is decided by its id and text, as an id may
    have several texts and many rows may have no id.  What leaves is written as a
    list; rows that a filter of it lacks pass straight through.
    """
    leaves = F.col("component_id").isNotNull() & ~(F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("fp") == F.col("first_fp")))
    gone = materialise(_found(docs, id_col, text_col).where(leaves).select("doc_id", "text_key").distinct(), "gone")
    return without(docs, [docs[id_col].cast("long"), F.xxhash64(F.coalesce(docs[text_col].cast("string"), F.lit("")))], gone)
