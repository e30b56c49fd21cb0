"""Benchmark decontamination through an FM-index per shard of the corpus.

Words are runs of digits, ASCII letters (without case) and all non-ASCII
characters.  A window is 13 consecutive words of a benchmark item, or the
whole of a shorter item that has words.  Each shard (one batch of documents)
becomes a sequence of word numbers; a word that no item holds is a separator,
and stretches between separators that are shorter than the shortest window
cannot hold one and are left out.  All windows are searched backwards at once,
occurrences located through sampled suffix positions, and the word spans
merged into the hit words of each document.

A null text has no words: nothing is hit and nothing is contaminated.
Repeated items count by distinct item id; items with a null id or text take no part.
The item list is broadcast in blocks of at most BLOCK_BYTES of item text (a
block takes about eight times that in memory), one pass over the corpus per
block.  At most TOGETHER passes run in one stage, then what is known so far is
written, so neither a worker nor an executor holds more than that many blocks.

An empty benchmark hits nothing; an empty table gives an empty result.  Texts of
any length are read whole; other columns are kept as they are.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, materialise, texts
from .fmindex import FMIndex

WINDOW = 13
SHARE = 20
BLOCK_BYTES = 16 << 20
TOGETHER = 4
#: Words of a shard at most (a longer document is a shard of its own).
SHARD_WORDS = 4_000_000

_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORDS).split()


class Items:
    """The windows of a block of items, as word numbers, by length; owners: by window, the items that have it, from `first` on."""

    def __init__(self, items: list[tuple[object, str]]):
        self.number: dict[bytes, int] = {}
        self.names = [str(i) for i, _ in items]
        found: dict[int, list[tuple[np.ndarray, int]]] = defaultdict(list)
        for k, (_, text) in enumerate(items):
            seq = np.array([self.number.setdefault(w, len(self.number) + 1) for w in words(text)], np.int32)
            if len(seq):
                n = min(WINDOW, len(seq))
                found[n].append((np.lib.stride_tricks.sliding_window_view(seq, n), k))
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for n, parts in found.items():
            patterns, which = np.unique(np.concatenate([w for w, _ in parts]), axis=0, return_inverse=True)
            owner = np.repeat(np.array([k for _, k in parts], np.int32), [len(w) for w, _ in parts])
            order = np.argsort(which.ravel(), kind="stable")
            first = np.concatenate([[0], np.cumsum(np.bincount(which.ravel(), minlength=len(patterns)))])
            self.by_length[n] = patterns, first, owner[order]
        self.shortest = min(self.by_length, default=0)


def occurrences(numbers: np.ndarray, items: Items) -> Iterator[tuple[np.ndarray, int, np.ndarray]]:
    """(starts, window length, window number of each start) within a sequence of word numbers."""
    if not items.by_length or not len(numbers):
        return
    edge = np.flatnonzero(np.diff(np.concatenate([[0], (numbers > 0).view(np.int8), [0]])))
    start, end = edge[::2], edge[1::2]
    long = end - start >= items.shortest
    if not long.any():
        return
    start, end = start[long], end[long]
    size = end - start + 1  # with the separator after it
    where = np.arange(size.sum()) + np.repeat(start - np.concatenate([[0], np.cumsum(size)[:-1]]), size)
    kept = np.append(numbers, 0)[where]
    index = FMIndex(kept, len(items.number))
    for n, (patterns, *_) in items.by_length.items():
        lo, hi = index.search(patterns)
        count = hi - lo
        which = np.repeat(np.arange(len(patterns)), count)
        rows = np.arange(count.sum()) + np.repeat(lo - np.concatenate([[0], np.cumsum(count)[:-1]]), count)
        yield where[index.locate(rows)], n, which


def shard_hits(numbers: np.ndarray, bounds: np.ndarray, items: Items) -> tuple[np.ndarray, dict[int, set[str]]]:
    """Hit flag of every word, and by document the items found.  bounds: where each document starts, and the end."""
    change, found = np.zeros(len(numbers) + 1, np.int32), defaultdict(set)
    for starts, n, which in occurrences(numbers, items):
        np.add.at(change, starts, 1)
        np.add.at(change, starts + n, -1)
        doc = np.searchsorted(bounds, starts, side="right") - 1
        _, first, owner = items.by_length[n]
        times = first[which + 1] - first[which]
        at = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + np.repeat(first[which], times)
        for d, k in set(zip(np.repeat(doc, times).tolist(), owner[at].tolist(), strict=True)):
            found[d].add(items.names[k])
    return np.cumsum(change)[:-1] > 0, found


def batch_hits(docs: list[str | None], items: Items) -> Iterator[tuple[int, np.ndarray, set[str]]]:
    """(words, hit flags, items) of each document, in order; shards of up to SHARD_WORDS."""
    get = items.number.get
    held: list[np.ndarray] = []

    def flush() -> Iterator[tuple[int, np.ndarray, set[str]]]:
        sizes = np.array([len(x) for x in held])
        # a separator of its own after each document keeps windows inside one
        bounds = np.concatenate([[0], np.cumsum(sizes + 1)])
        flat = np.concatenate([y for x in held for y in (x, [0])]).astype(np.int64)
        hit, found = shard_hits(flat, bounds, items)
        for d, (a, n) in enumerate(zip(bounds.tolist(), sizes.tolist(), strict=False)):
            yield n, hit[a : a + n], found.get(d, set())

    total = 0
    for text in docs:
        w = words(text)
        held.append(np.array([get(x, 0) for x in w], np.int64))
        total += len(w) + 1
        if total >= SHARD_WORDS:
            yield from flush()
            held, total = [], 0
    if held:
        yield from flush()


def _pass(shared, block: int, last: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """One block of items over the corpus: adds to the hit words (packed bits) and items found so far."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = shared.value
        for batch in batches:
            before = [batch.column(k).to_pylist() for k in (2, 3)] if block else [[b""] * batch.num_rows, [[]] * batch.num_rows]
            bits, names, rows = [], [], []
            for (n, hit, found), b, names_before in zip(batch_hits(texts(batch), items), *before, strict=True):
                if b:
                    hit = hit | np.unpackbits(np.frombuffer(b, np.uint8), count=n).astype(bool)
                found = sorted(found.union(names_before))
                if last:
                    n_hit = int(hit.sum())
                    rows.append((n, n_hit, len(found), hashlib.sha256(",".join(found).encode()).hexdigest(), n_hit > 0 and SHARE * n_hit >= n))
                else:
                    bits.append(np.packbits(hit).tobytes())
                    names.append(found)
            if last:
                cols = list(zip(*rows, strict=True)) or [[]] * 5
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_())
                yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])
            else:
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(bits, pa.binary()), pa.array(names, pa.list_(pa.string()))], ["doc_id", "text", "hit", "items"])

    return run


def item_blocks(benchmark: DataFrame, item_col: str, text_col: str, block_bytes: int) -> Iterator[list[tuple[object, str]]]:
    """Items with id and text, at most block_bytes of text together (one longer item stands alone)."""
    rows, size = [], 0
    for r in benchmark.select(item_col, text_col).dropna().distinct().toLocalIterator():
        if rows and size + len(r[1]) * 4 > block_bytes:
            yield rows
            rows, size = [], 0
        rows.append((r[0], r[1]))
        size += len(r[1]) * 4
    yield rows


def find_contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated: one row per input row."""
    sc = docs.sparkSession.sparkContext
    out, blocks = id_and_text(docs, id_col, text_col), item_blocks(benchmark, item_col, item_text, block_bytes)
    k, block = 0, next(blocks)
    while block is not None:
        after = next(blocks, None)
        known = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
        out = out.mapInArrow(_pass(sc.broadcast(Items(block)), k, after is None), known if after is None else "doc_id long, text string, hit binary, items array<string>")
        k, block = k + 1, after
        if after is not None and k % TOGETHER == 0:
            out = materialise(out, "passes")
    return out


def _marker(shared, text_col: str, hit: str, last: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Adds to the hit words (packed bits) in the last column; the last pass drops it and the contaminated rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = shared.value
        for batch in batches:
            own, before = batch.drop_columns([hit]), batch.column(batch.num_columns - 1).to_pylist()
            hits = [h | np.unpackbits(np.frombuffer(b, np.uint8), count=n).astype(bool) if b else h for (n, h, _), b in zip(batch_hits(texts(batch, text_col), items), before, strict=True)]
            if last:
                yield own.filter(pa.array([not (h.any() and SHARE * int(h.sum()) >= len(h)) for h in hits], pa.bool_()))
            else:
                yield own.append_column(hit, pa.array([np.packbits(h).tobytes() for h in hits], pa.binary()))

    return run


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """docs without contaminated rows; all columns, no shuffle of texts."""
    sc = docs.sparkSession.sparkContext
    hit = "__loom_hit"
    while hit in docs.columns:
        hit += "_"
    out, blocks = docs.withColumn(hit, F.lit(None).cast("binary")), item_blocks(benchmark, item_col, item_text, block_bytes)
    wide = out.schema
    k, block = 0, next(blocks)
    while block is not None:
        after = next(blocks, None)
        out = out.mapInArrow(_marker(sc.broadcast(Items(block)), text_col, hit, after is None), docs.schema if after is None else wide)
        k, block = k + 1, after
        if after is not None and k % TOGETHER == 0:
            out = materialise(out, "passes")
    return out
