"""Removal of repeated 200-byte strings, in and across documents.

Method: the collection's suffix order and common prefixes come from
column-wise insertion (bcr.py), on shards that together hold every candidate.

A shard must see all equal strings together, whatever document they are in.
So every 200-byte string is assigned a seed: the 32 bytes in it whose hash is
smallest (the leftmost of equals).  Equal strings have equal seeds.
Consecutive strings of a document with the same seed form a run; a run and all
bytes its strings cover is its context.

1. One scan counts runs by seed (summed where the text is read).  A seed that
   occurs once holds nothing repeated; one whose runs all have the same
   context (copies) is decided by its count.
2. A second scan sends the runs of repeated seeds to shards by seed, with
   their bytes where a seed has different contexts.  There the contexts are
   cropped to what can be shared with another (hashes of the bytes left and
   right of the seed at a few lengths), and the cropped ones go through the
   column-wise construction, as many seeds at a time as BATCH_STRINGS allows.
   A string whose row has a common prefix of 200 bytes with a neighbour starts
   in more than one place.
3. A seed with more than HOT runs and different contexts would be too much for
   one shard.  The contexts of its runs, and only they, are written and go
   round again under longer seeds (SEEDS), which deal them out more finely; the
   last seed is the string itself, so every group ends as small enough or as
   copies of one string.  Copies under a seed with more than HOT runs are
   spread over slices.

Rows travel packed, one blob for a batch and shuffle partition, so that the
exchanges move a few large values instead of millions of small rows.

Seeds go to the second scan as Bloom filters, sized by the number of seeds up
to BITS bits; the exact counts travel to the shards, so a false positive costs
a moved row, never a wrong answer.  Past that bound the filters let more rows
through, up to all of them.

Null text is empty.  Texts of less than 200 bytes lose nothing; a text of any
length is read in pieces.  A row is told from others of its id by a 64-bit hash
of its text, and where the id is null by a second one of another kind, so by 128
bits; repeated rows count as two documents, so all their strings of 200 bytes
are repeated.  An empty table gives
an empty result.  Other columns are never read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .bcr import repeated_starts
from .common import id_and_text, materialise

LENGTH = 200
SEEDS = (32, 116, 200)
GRAM = SEEDS[0]
BITS = 1 << 27
HOT = 8192
SLICES = 64
CHUNK = 1 << 16
CROP = 12
#: Rows after which a task hands on what it holds of a batch.
ROWS = 1 << 17
BATCH_STRINGS = 1500

_BASE = 0x9E3779B97F4A7C15
_LOW = np.uint64((1 << 24) - 1)
TABLE = np.random.default_rng(20).integers(0, 1 << 64, 256, dtype=np.uint64)
TABLE2 = np.random.default_rng(21).integers(0, 1 << 64, 256, dtype=np.uint64)


@cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        p = np.full(n, base, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    return _powers(1 << max(18, int(n).bit_length()))


def prefix_sums(b: np.ndarray, table: np.ndarray = TABLE) -> np.ndarray:
    """Sums from which the hash of any range follows; modulo 2 ** 64."""
    out = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(table[b] * powers(len(b) + 1)[0][: len(b)], out=out[1:])
    return out


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def range_hash(sums: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    return mixed((sums[hi] - sums[lo]) * powers(len(sums))[1][lo])


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    pad = np.full(-(-len(x) // w) * w, np.iinfo(np.uint64).max, np.uint64)
    pad[: len(x)] = x
    blocks = pad.reshape(-1, w)
    left = np.minimum.accumulate(blocks, 1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(right[: len(x) - w + 1], left[w - 1 : len(x)])


class Part:
    """Texts, or pieces of long ones, side by side."""

    def other_sums(self) -> np.ndarray:
        if self.other is None:
            self.other = prefix_sums(self.bytes, TABLE2)
        return self.other

    def __init__(self, pieces: list[tuple[int, int, bytes]]):
        self.size = np.array([len(p) for _, _, p in pieces])
        self.base = np.cumsum(self.size) - self.size
        self.data = b"".join([p for _, _, p in pieces])
        self.bytes = np.frombuffer(self.data, np.uint8)
        self.sums = prefix_sums(self.bytes)
        self.other = None
        self.text = np.array([t for t, _, _ in pieces])
        self.shift = np.array([a for _, a, _ in pieces]) - self.base


class Runs:
    """The runs of a part under seeds of `gram` bytes.

    By run: which text of the batch, seed, context hash, first start in the
    part, number of starts, place of the seed.  shift + a place in the part is
    a place in the text.
    """

    def __init__(self, part: Part, gram: int = GRAM):
        n = len(part.bytes)
        hashes = mixed((part.sums[gram:] - part.sums[:-gram]) * powers(n + 1)[1][: n - gram + 1])
        least = sliding_min((hashes & ~_LOW) | np.arange(len(hashes), dtype=np.uint64), LENGTH - gram + 1)
        new = np.concatenate([[True], least[1:] != least[:-1]])
        new[part.base] = True
        lo = np.flatnonzero(new)
        which = np.searchsorted(part.base, lo, side="right") - 1
        past = (part.base + part.size - LENGTH + 1)[which]  # later strings would reach into the next text
        end = np.minimum(np.append(lo[1:], len(least)), past)
        own = np.flatnonzero(end > lo)
        self.lo, which = lo[own], which[own]
        self.n = end[own] - self.lo
        self.at = (least[self.lo] & _LOW).astype(np.int64)
        self.seed = hashes[self.at]
        near = mixed((self.at - self.lo).astype(np.uint64) + np.uint64(1))
        sums = part.sums if gram < LENGTH else part.other_sums()  # a seed that is the whole string has a context of other bits
        self.context = range_hash(sums, self.lo, self.lo + self.n + LENGTH - 1) + near
        self.text, self.shift = part.text[which], part.shift[which]

    def stretches(self, own: np.ndarray, alike: bool) -> tuple[np.ndarray, np.ndarray]:
        """Of runs right behind one another in a text (and, if `alike`, with one seed and context) the first, and how many they are.

        A text that repeats itself every few bytes has a run for each of them.
        """
        if not len(own):
            return own, own
        a, b = own[:-1], own[1:]
        same = (self.text[a] == self.text[b]) & (self.lo[b] == self.lo[a] + self.n[a])
        if alike:
            same &= (self.seed[a] == self.seed[b]) & (self.context[a] == self.context[b])
        first = np.flatnonzero(np.concatenate([[True], ~same]))
        return own[first], np.diff(np.append(first, len(own)))


def parts(texts: list[bytes]) -> Iterator[Part]:
    """All texts of a batch, about CHUNK bytes at a time; a longer text in pieces that overlap by a string."""
    held, size = [], 0
    for k, data in enumerate(texts):
        for a in range(0, len(data) - LENGTH + 1, CHUNK):
            held.append((k, a, data[a : a + CHUNK + LENGTH - 1]))
            size += len(held[-1][2])
            if size >= CHUNK:
                yield Part(held)
                held, size = [], 0
    if held:
        yield Part(held)


class Bloom:
    """Membership of 64-bit hashes, from two of their parts; 16 bits a seed up to the bound."""

    def __init__(self, seeds: DataFrame, most: int):
        bits = min(most, 1 << max(10, (16 * seeds.count()).bit_length()))
        mask = bits - 1
        places = seeds.select(F.explode(F.array(F.col("seed").bitwiseAND(F.lit(mask)), F.shiftrightunsigned("seed", 33).bitwiseAND(F.lit(mask)))).alias("p"))
        words = places.groupBy(F.shiftright("p", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("m")).toPandas()
        self.words = np.zeros(bits // 64, np.uint64)
        self.words[words.w.to_numpy(np.int64)] = words.m.to_numpy(np.int64).view(np.uint64)
        self.mask, self.any = np.uint64(mask), len(words) > 0

    def has(self, seed: np.ndarray) -> np.ndarray:
        if not self.any:
            return np.zeros(len(seed), bool)
        out = np.ones(len(seed), bool)
        for p in (seed & self.mask, (seed >> np.uint64(33)) & self.mask):
            out &= (self.words[(p >> np.uint64(6)).astype(np.int64)] >> (p & np.uint64(63))) & np.uint64(1) == 1
        return out


class Filters:
    """Of one length of seed: which repeat, which have several contexts, which have more than HOT runs."""

    def __init__(self, seeds: DataFrame, bits: int, hot: int, last: bool):
        self.repeated, self.several, self.big = Bloom(seeds, bits), Bloom(seeds.where("lo <> hi"), bits), Bloom(seeds.where(F.col("n") > hot), bits)
        self.last = last

    def left(self, seed: np.ndarray) -> np.ndarray:
        """Seeds whose strings go round again, rightly or not; a shard and the next round ask this alike."""
        return np.zeros(len(seed), bool) if self.last else self.several.has(seed) & self.big.has(seed)


SEED = np.dtype([("seed", "<u8"), ("n", "<i8"), ("lo", "<u8"), ("hi", "<u8")])
RUN = np.dtype([("seed", "<u8"), ("context", "<u8"), ("doc", "<i8"), ("tag", "<i8"), ("start", "<i8"), ("n", "<i4"), ("at", "<i4"), ("times", "<i4"), ("slice", "<i4"), ("null", "?"), ("sent", "?")])
OWNER = np.dtype([("doc", "<i8"), ("tag", "<i8"), ("start", "<i8"), ("size", "<i4"), ("null", "?")])
HEAD = np.dtype([("seed", "<u8"), ("n", "<i8")])
MARK = np.dtype([("doc", "<i8"), ("tag", "<i8"), ("a", "<i8"), ("n", "<i8"), ("null", "?")])
PACKED = pa.schema([("bucket", pa.int64()), ("rows", pa.binary()), ("pieces", pa.binary()), ("heads", pa.binary())])
PACKED_SQL = "bucket long, rows binary, pieces binary, heads binary"


def bucket_of(seed: np.ndarray, where: np.ndarray | int, buckets: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = mixed(seed + np.asarray(where, np.uint64) * np.uint64(_BASE))
    return ((h >> np.uint64(11)) % np.uint64(buckets)).astype(np.int64)


def dealt(bucket: np.ndarray, rows: np.ndarray, column: str, pieces: list[bytes] | None = None) -> pa.RecordBatch:
    """One row a bucket; pieces: one for every row, empty where none travels."""
    order = np.argsort(bucket, kind="stable")
    bucket, rows = bucket[order], rows[order]
    edge = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else np.empty(0, np.int64)
    ends = np.append(edge[1:], len(bucket)) if len(edge) else edge
    cols = {"bucket": pa.array(bucket[edge], pa.int64()), column: pa.array([rows[x:y].tobytes() for x, y in zip(edge.tolist(), ends.tolist(), strict=True)], pa.binary())}
    if pieces is not None:
        at = order.tolist()
        cols["pieces"] = pa.array([b"".join([pieces[k] for k in at[x:y]]) for x, y in zip(edge.tolist(), ends.tolist(), strict=True)], pa.binary())
    return pa.RecordBatch.from_arrays([cols.get(f.name, pa.nulls(len(edge), f.type)) for f in PACKED], schema=PACKED)


def unpacked(column: pa.Array, kind: np.dtype) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), kind) for x in column if x.is_valid]


def _totals(rows: np.ndarray) -> np.ndarray:
    rows = rows[np.argsort(rows["seed"], kind="stable")]
    edge = np.flatnonzero(np.concatenate([[True], rows["seed"][1:] != rows["seed"][:-1]])) if len(rows) else np.empty(0, np.int64)
    out = np.empty(len(edge), SEED)
    if len(edge):
        out["seed"], out["n"] = rows["seed"][edge], np.add.reduceat(rows["n"], edge)
        out["lo"], out["hi"] = np.minimum.reduceat(rows["lo"], edge), np.maximum.reduceat(rows["hi"], edge)
    return out


def _seeds(gram: int, buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Runs, smallest and largest context of every seed of a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, size = [], 0
            for part in parts(owned(batch)[1]):
                r = Runs(part, gram)
                one = np.empty(len(r.seed), SEED)
                one["seed"], one["n"], one["lo"], one["hi"] = r.seed, 1, r.context, r.context
                found.append(one)
                size += len(one)
                if size >= ROWS:
                    found = [_totals(np.concatenate(found))]
                    size = len(found[0])
                    if size >= ROWS // 2:
                        yield dealt(bucket_of(found[0]["seed"], 0, buckets), found[0], "rows")
                        found, size = [], 0
            if found:
                seeds = _totals(np.concatenate(found))
                yield dealt(bucket_of(seeds["seed"], 0, buckets), seeds, "rows")

    return run


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """seed, runs, smallest and largest context of the seeds of a few buckets that occur more than once."""
    found = [x for batch in batches for x in unpacked(batch.column(0), SEED)]
    if found:
        out = _totals(np.concatenate(found))
        out = out[out["n"] > 1]
        yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(out[c]).view(np.int64)) for c in SEED.names], list(SEED.names))


def _runs(gram: int, filters, buckets: int, slices: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Runs whose seed repeats; bytes once a batch and context, where a seed has several."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = filters.value
        for batch in batches:
            owners, texts = owned(batch)
            held, pieces = [], []
            sent: set[tuple[int, int]] = set()
            for part in parts(texts):
                r = Runs(part, gram)
                own = np.flatnonzero(now.repeated.has(r.seed) & ~now.left(r.seed))
                own, times = r.stretches(own, alike=True)
                whose, one = owners[r.text[own]], np.zeros(len(own), RUN)
                one["times"] = times
                one["seed"], one["context"], one["n"], one["at"] = r.seed[own], r.context[own], r.n[own], r.at[own] - r.lo[own]
                for c in ("doc", "tag", "null"):
                    one[c] = whose[c]
                one["start"] = whose["start"] + r.lo[own] + r.shift[own]
                spot = mixed((whose["doc"] ^ whose["tag"] ^ one["start"]).view(np.uint64)) >> np.uint64(11)
                one["slice"] = np.where(now.big.has(one["seed"]), spot % np.uint64(slices), 0)
                here, many = [b""] * len(own), np.flatnonzero(now.several.has(one["seed"]))
                for k, key, a, n in zip(many.tolist(), zip(one["seed"][many].tolist(), one["context"][many].tolist(), strict=True), r.lo[own[many]].tolist(), one["n"][many].tolist(), strict=True):
                    if key not in sent:
                        sent.add(key)
                        here[k] = part.data[a : a + n + LENGTH - 1]
                        one["sent"][k] = True
                held.append(one)
                pieces += here
                if len(pieces) >= ROWS:
                    rows, held = np.concatenate(held), []
                    yield dealt(bucket_of(rows["seed"], rows["slice"], buckets), rows, "rows", pieces)
                    pieces = []
            if held:
                rows = np.concatenate(held)
                yield dealt(bucket_of(rows["seed"], rows["slice"], buckets), rows, "rows", pieces)

    return run


STRING_SQL = "heads binary, data binary"
LEFT_BYTES = 1 << 20


def owned(batch: pa.RecordBatch) -> tuple[np.ndarray, list[bytes]]:
    """OWNER rows and their bytes: of texts (doc_id, tag, data), or of contexts packed by _left."""
    if batch.schema.names == ["heads", "data"]:
        heads, data = unpacked(batch.column(0), OWNER), batch.column(1).to_pylist()
        pieces = [d[b - n : b] for h, d in zip(heads, data, strict=True) for b, n in zip(np.cumsum(h["size"]).tolist(), h["size"].tolist(), strict=True)]
        return np.concatenate([np.empty(0, OWNER), *heads]), pieces
    owners = np.zeros(batch.num_rows, OWNER)
    ids, data = batch.column(0), batch.column(2).to_pylist()
    owners["doc"], owners["null"], owners["tag"] = pc.fill_null(ids, 0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False), batch.column(1).to_numpy()
    for k in np.flatnonzero(owners["null"]).tolist():
        owners["doc"][k] = stand_in(data[k])
    return owners, data


def stand_in(data: bytes) -> int:
    """What tells a text without an id from others, besides its tag."""
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)


def _left(gram: int, filters) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The contexts of the runs that go round again, those side by side as one, about LEFT_BYTES to a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = filters.value
        for batch in batches:
            owners, texts = owned(batch)
            heads, data, size = [], [], 0
            for part in parts(texts):
                r = Runs(part, gram)
                all_left = np.flatnonzero(now.left(r.seed))
                own, times = r.stretches(all_left, alike=False)
                last = all_left[np.cumsum(times) - 1]
                h = owners[r.text[own]]
                h["start"] += r.lo[own] + r.shift[own]
                h["size"] = r.lo[last] + r.n[last] - r.lo[own] + (LENGTH - 1)
                heads.append(h)
                data += [part.data[a : a + n] for a, n in zip(r.lo[own].tolist(), h["size"].tolist(), strict=True)]
                size += int(h["size"].sum())
                if size >= LEFT_BYTES:
                    yield _packed_strings(heads, data)
                    heads, data, size = [], [], 0
            if size:
                yield _packed_strings(heads, data)

    return run


def _packed_strings(heads: list[np.ndarray], data: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([np.concatenate(heads).tobytes()], pa.binary()), pa.array([b"".join(data)], pa.binary())], ["heads", "data"])


def _heads(filters, buckets: int, slices: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The number of runs of every repeated seed, for each slice that its runs can be in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = filters.value
        for batch in batches:
            heads = np.empty(batch.num_rows, HEAD)
            heads["seed"], heads["n"] = batch.column(0).to_numpy().view(np.uint64), batch.column(1).to_numpy()
            heads = heads[~now.left(heads["seed"])]
            times = np.where(now.big.has(heads["seed"]), slices, 1)
            where = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            heads = np.repeat(heads, times)
            yield dealt(bucket_of(heads["seed"], where, buckets), heads, "heads")

    return run


def cropped(strings: list[bytes], at: np.ndarray, group: np.ndarray, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """How far left and right of its seed each context can share bytes with
    another of its group: to the next multiple of CROP after the longest
    stretch that some other context also has."""
    size = np.array([len(s) for s in strings])
    begin = np.cumsum(size) - size
    sums = prefix_sums(np.frombuffer(b"".join(strings), np.uint8))
    reach = []
    for side in (-1, 1):
        room = at if side < 0 else size - at - gram
        best = np.zeros(len(strings), np.int64)
        live = np.arange(len(strings))
        for step in range(CROP, LENGTH - gram + 1, CROP):
            live = live[room[live] >= step]
            if not len(live):
                break
            edge = begin[live] + at[live] + (gram if side > 0 else 0)
            h = range_hash(sums, edge - (step if side < 0 else 0), edge + (step if side > 0 else 0))
            order = np.lexsort([h, group[live]])
            same = (np.diff(h[order].view(np.int64)) == 0) & (np.diff(group[live][order]) == 0)
            live = np.sort(live[order[np.concatenate([same, [False]]) | np.concatenate([[False], same])]])
            best[live] = step
        reach.append(np.minimum(best + CROP - 1, room))
    return reach[0], reach[1]


def _spans(strings: list[bytes], at: np.ndarray, group: np.ndarray, gram: int) -> Iterator[tuple[int, int, int]]:
    """(context, first, past the last) of the starts that are repeated, by the column-wise construction."""
    left, right = cropped(strings, at, group, gram)
    keep = np.flatnonzero(left + right + gram >= LENGTH)
    if not len(keep):
        return
    cut = [strings[k][at[k] - left[k] : at[k] + gram + right[k]] for k in keep]
    flat, a = repeated_starts(cut, LENGTH), 0
    for k, s in zip(keep.tolist(), cut, strict=True):
        flags = flat[a : a + len(s)]
        a += len(s)
        if flags.any():
            edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.view(np.int8), [0]]))) + (at[k] - left[k])
            yield from ((k, x, y) for x, y in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True))


def marked(rows: np.ndarray, pieces: bytes, heads: np.ndarray, gram: int) -> Iterator[np.ndarray]:
    """Marks of the repeated starts among the runs of a few buckets."""
    heads = heads[np.argsort(heads["seed"], kind="stable")]
    if not len(heads) or not len(rows):
        return
    size = np.where(rows["sent"], rows["n"] + (LENGTH - 1), 0).astype(np.int64)
    begin = np.cumsum(size) - size
    known = heads["seed"][np.minimum(np.searchsorted(heads["seed"], rows["seed"]), len(heads) - 1)] == rows["seed"]
    own = np.flatnonzero(known)
    if not len(own):
        return
    own = own[np.lexsort((rows["context"][own], rows["slice"][own], rows["seed"][own]))]
    r, begin = rows[own], begin[own]
    change = lambda c: np.concatenate([[True], r[c][1:] != r[c][:-1]])
    new_group = change("seed") | change("slice")
    new = new_group | change("context")
    edge, context = np.flatnonzero(new), np.cumsum(new) - 1
    times = np.add.reduceat(r["times"].astype(np.int64), edge)
    group = (np.cumsum(new_group) - 1)[edge]
    several = np.bincount(group)[group] > 1

    def marks(k: np.ndarray, first: np.ndarray | int, n: np.ndarray) -> np.ndarray:
        out = np.empty(len(k), MARK)
        for c in ("doc", "tag", "null"):
            out[c] = r[c][k]
        out["a"], out["n"] = r["start"][k] + first, n
        return out

    whole = np.flatnonzero((~several | (times > 1))[context])  # copies of a context
    yield marks(whole, 0, r["n"][whole].astype(np.int64) * r["times"][whole])
    todo = np.flatnonzero(several)
    if not len(todo):
        return
    sent = np.maximum.reduceat(np.where(r["sent"], np.arange(len(r)), -1), edge)
    ends = np.append(np.flatnonzero(np.diff(group[todo])) + 1, len(todo)).tolist()
    a = 0
    for n, b in enumerate(ends):
        if b - a < BATCH_STRINGS and n + 1 < len(ends):
            continue
        part, a = todo[a:b], b
        at = sent[part]
        strings = [pieces[x : x + y] for x, y in zip(begin[at].tolist(), (r["n"][at] + (LENGTH - 1)).tolist(), strict=True)]
        found = [(part[k], x, y - x) for k, x, y in _spans(strings, r["at"][at].astype(np.int64), group[part], gram) if times[part[k]] == 1]
        if found:
            c, x, n_ = (np.array(v) for v in zip(*found, strict=True))
            yield marks(edge[c], x, n_)


def _marks(gram: int, buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """From the runs of a few buckets to marks, dealt out by document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, pieces, heads = [np.empty(0, RUN)], [], [np.empty(0, HEAD)]
        for batch in batches:
            rows += unpacked(batch.column(1), RUN)
            pieces += [x.as_py() for x in batch.column(2) if x.is_valid]
            heads += unpacked(batch.column(3), HEAD)
        for m in marked(np.concatenate(rows), b"".join(pieces), np.concatenate(heads), gram):
            if len(m):
                yield dealt((np.where(m["null"], 0, m["doc"]) ^ m["tag"]) % buckets, m, "rows")

    return run


def _packed(df: DataFrame, fn: Callable) -> DataFrame:
    return df.mapInArrow(fn, PACKED_SQL)


#: Bytes of text for one bucket, about.
BUCKET_BYTES = 16 << 20


def _buckets(spark: SparkSession, n_bytes: int) -> int:
    """As many as there are shuffle partitions, or as the text needs."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_bytes // BUCKET_BYTES))


def repeated_marks(own: DataFrame, buckets: int, bits: int = BITS, hot: int = HOT) -> DataFrame:
    """own: doc_id, tag, text.  bucket, rows: the starts of repeated strings, as packed MARKs by document."""
    spark = own.sparkSession
    slices = max(SLICES, buckets)
    strings = own.select("doc_id", "tag", F.col("text").cast("binary").alias("data"))
    marks = None
    for k, gram in enumerate(SEEDS):
        counted = _packed(strings, _seeds(gram, buckets))
        seeds = materialise(counted.repartitionById(buckets, F.col("bucket").cast("int")).select("rows").mapInArrow(_repeated, "seed long, n long, lo long, hi long"), "seeds")
        shared = spark.sparkContext.broadcast(Filters(seeds, bits, hot, last=k + 1 == len(SEEDS)))
        rows = _packed(strings, _runs(gram, shared, buckets, slices)).unionByName(_packed(seeds.select("seed", "n"), _heads(shared, buckets, slices)))
        found = _packed(rows.repartitionById(buckets, F.col("bucket").cast("int")), _marks(gram, buckets)).select("bucket", "rows")
        marks = found if marks is None else marks.unionByName(found)
        if not seeds.where((F.col("n") > hot) & (F.col("lo") != F.col("hi"))).limit(1).count():
            break
        strings = materialise(strings.mapInArrow(_left(gram, shared), STRING_SQL), "left")
    return marks


def spans(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of bytes covered by strings that start in the ranges a to b."""
    order = np.argsort(a, kind="stable")
    a, end = a[order], np.maximum.accumulate(b[order] + LENGTH - 1)
    new = np.concatenate([[True], a[1:] > end[:-1]])
    return a[new], end[np.append(np.flatnonzero(new)[1:] - 1, len(end) - 1)]


class Marks:
    """The marks of a partition by row."""

    def __init__(self, found: list[np.ndarray]):
        m = np.concatenate([np.empty(0, MARK), *found])
        self.m = m[np.lexsort((m["tag"], m["doc"], m["null"]))]
        change = lambda c: self.m[c][1:] != self.m[c][:-1]
        edge = np.concatenate([[0], np.flatnonzero(change("tag") | change("doc") | change("null")) + 1]) if len(m) else np.empty(0, np.int64)
        first = self.m[edge]
        key = zip(*(first[c].tolist() for c in ("doc", "null", "tag")), strict=True)
        self.at = dict(zip(key, zip(edge.tolist(), np.append(edge[1:], len(m)).tolist() if len(edge) else [], strict=True), strict=True))

    def of(self, doc_id: int | None, tag: int, data: bytes) -> tuple[np.ndarray, np.ndarray] | None:
        own = (stand_in(data) if doc_id is None else doc_id, doc_id is None, tag)
        if (at := self.at.get(own)) is None:
            return None
        m = self.m[at[0] : at[1]]
        return spans(m["a"], m["a"] + m["n"])


def _results(keep_text: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Marks come before texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, marks = [], None
        for batch in batches:
            found += unpacked(batch.column(3), MARK)
            texts = batch.filter(batch.column(3).is_null())
            if not texts.num_rows:
                continue
            marks = marks or Marks(found)
            out = []
            for doc_id, tag, text in zip(*(texts.column(k).to_pylist() for k in range(3)), strict=True):
                data = text.encode("utf-8", "surrogatepass")
                kept, removed, n = data, 0, 0
                if (where := marks.of(doc_id, tag, data)) is not None:
                    lo, hi = where
                    n, removed = len(lo), int((hi - lo).sum())
                    kept = b"".join(data[x:y] for x, y in zip([0, *hi.tolist()], [*lo.tolist(), len(data)], strict=True))
                out.append((doc_id, len(data), removed, n, kept if keep_text else hashlib.sha256(kept).hexdigest()))
            cols = list(zip(*out, strict=True))
            kinds = [pa.int64()] * 4 + [pa.binary() if keep_text else pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept" if keep_text else "kept_sha256"])

    return run


def _document_bucket(buckets: int) -> Column:
    return F.pmod(F.coalesce("doc_id", F.lit(0)).bitwiseXOR(F.col("tag")), F.lit(buckets)).alias("bucket")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = False, bits: int = BITS, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, and the digest of the remaining bytes (or, with keep_text, those bytes)."""
    own = id_and_text(docs, id_col, text_col).select("doc_id", F.xxhash64(F.col("text").cast("binary")).alias("tag"), "text")
    buckets = _buckets(own.sparkSession, own.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0)
    texts = own.select(_document_bucket(buckets), "doc_id", "tag", "text", F.lit(None).cast("binary").alias("marks"))
    marks = repeated_marks(own, buckets, bits, hot).select("bucket", F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("long").alias("tag"), F.lit(None).cast("string").alias("text"), F.col("rows").alias("marks"))
    met = marks.unionByName(texts).repartitionById(buckets, F.col("bucket").cast("int")).sortWithinPartitions(F.col("marks").isNull()).select("doc_id", "tag", "text", "marks")
    last = "kept binary" if keep_text else "kept_sha256 string"
    return met.mapInArrow(_results(keep_text), f"doc_id long, n_bytes long, n_removed long, n_spans long, {last}")
