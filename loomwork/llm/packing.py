"""Best-fit packing of tokenised documents after Martello-Toth reduction.

A document is its token ids and a closing id 0.  One longer than the sequence
length is cut into full pieces, the first of which may be shorter.  Packing
depends on sizes alone, and there are at most LENGTH different sizes: counts
per size are summed over all documents, and the bin packing is solved on
those counts.

First the reduction permanently fixes sets that dominate every alternative for
their largest piece (a piece alone when nothing fits beside it; two that fill
a sequence; the largest partner when no two others fit, or when no pair that
fits weighs more than it) until none is left.  The rest is packed best-fit
decreasing.  Documents are then numbered within their size and take the places
of that size in order.

Null text counts as empty (a document of one id).  Equal ids or rows are
pieces of their own.  Ties are broken by id, then piece.

An empty table gives an empty result.  Texts of any length are cut, never shortened.
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import id_and_text, materialise, texts

LENGTH = 2048
SLICES = 64
CLOSING = b"\0\0\0\0"
#: Words kept with their ids in a worker; a full cache starts again.
CACHE_WORDS = 400_000
#: White space other than the plain space and the line feed.
OTHER_SPACE = "\t\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0" + "".join(map(chr, (0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Ids of a byte-level BPE tokenizer, as little-endian unsigned 32-bit numbers.

    Its pre-tokens never reach across a single space or line feed that has no
    other white space beside it, so such a text is encoded word by word, each
    distinct word once; any other text is encoded whole.  The tokenizer itself
    reads the words: byte by byte merges from the ranked twin of the
    vocabulary where there is one beside it, else the file's own library.
    encode() takes all text as ordinary; document() reads the file's added
    tokens as their own ids, and splits the text at them.
    """

    def __init__(self, vocabulary: str):
        self.cache: dict[str, bytes] = {}
        with open(vocabulary, encoding="utf-8") as f:
            added = json.load(f).get("added_tokens") or []
        if any(t.get(k) for t in added for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError("added tokens that take in or depend on the text beside them are not supported")
        self.added = {t["content"]: np.array([t["id"]], "<u4").tobytes() for t in added}
        self.split = re.compile("(" + "|".join(re.escape(c) for c in sorted(self.added, key=len, reverse=True)) + ")") if added else None
        try:
            import tiktoken
            from public_tokenizers import PATTERN

            with open(vocabulary.removesuffix(".json") + ".tiktoken", "rb") as lines:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.ids = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        except (ImportError, FileNotFoundError):
            from tokenizers import Tokenizer

            own = Tokenizer.from_file(vocabulary)
            own.encode_special_tokens = True
            self.ids = lambda text: own.encode(text, add_special_tokens=False).ids

    def whole(self, text: str) -> bytes:
        return np.array(self.ids(text), "<u4").tobytes()

    def document(self, text: str) -> bytes:
        if not self.split or not any(c in text for c in self.added):
            return self.encode(text)
        return b"".join(self.added[p] if k % 2 else self.encode(p) for k, p in enumerate(self.split.split(text)) if p)

    def encode(self, text: str) -> bytes:
        plain = not ("  " in text or "\n\n" in text or "\n " in text or " \n" in text or text[:1].isspace() or text[-1:].isspace())
        if not plain or any(c in text for c in OTHER_SPACE):
            return self.whole(text)
        parts: list[str] = []
        for line in text.split("\n"):
            parts.append("\n")
            head, *rest = line.split(" ")
            parts.append(head)
            parts += [" " + w for w in rest]
        cache = self.cache
        try:
            return b"".join([cache[p] for p in parts[1:]])
        except KeyError:
            if len(cache) > CACHE_WORDS:
                cache.clear()
            for p in parts[1:]:
                if p not in cache:
                    cache[p] = self.whole(p)
            return b"".join([cache[p] for p in parts[1:]])


def cut(n: int, length: int = LENGTH) -> list[tuple[int, int]]:
    """(start, size) of a document's pieces."""
    first = n if n <= length else n % length or length
    return [(0, first), *((a, length) for a in range(first, n, length))]


def _pieces(vocabulary: str, length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), texts(batch), strict=True):
                ids = encoder.document(text) + CLOSING
                rows += [(doc_id, k, a, n, zlib.crc32(ids[4 * a : 4 * (a + n)])) for k, (a, n) in enumerate(cut(len(ids) // 4, length))]
            cols = list(zip(*rows, strict=True)) or [[]] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return run


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, length: int = LENGTH) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32."""
    return id_and_text(docs, id_col, text_col).mapInArrow(
        _pieces(vocabulary or default_vocabulary(), length), "doc_id long, piece int, start long, length long, ids_crc32 long"
    )


def reduce_sizes(count: dict[int, int], length: int = LENGTH) -> list[tuple[tuple[int, ...], int]]:
    """Fix dominating sets: (sizes, how often).  Takes them out of count."""
    fixed, changed = [], True
    while changed:
        changed = False
        sizes = sorted(s for s, n in count.items() if n)
        for s in reversed(sizes[:]):
            while count[s]:
                room = length - s
                # the smallest few pieces besides one of size s, with repeats
                small: list[int] = []
                for t in sizes:
                    small += [t] * min(3 - len(small), count[t] - (t == s))
                    if len(small) == 3:
                        break
                k = bisect_left(sizes, room + 1) - 1
                if k >= 0 and sizes[k] == s and count[s] < 2:
                    k -= 1
                partner = sizes[k] if k >= 0 else 0
                if not partner:
                    take: tuple[int, ...] = (s,)
                elif partner == room or len(small) < 2 or small[0] + small[1] > room:
                    take = (s, partner)
                elif (len(small) < 3 or sum(small) > room) and _best_pair(sizes, count, s, room) <= partner:
                    take = (s, partner)
                else:
                    break
                n = count[s] if len(take) == 1 else count[s] // 2 if partner == s else min(count[s], count[partner])
                fixed.append((take, n))
                for t in take:
                    count[t] -= n
                changed = True
                sizes = [t for t in sizes if count[t]]
    return fixed


def _best_pair(sizes: list[int], count: dict[int, int], s: int, room: int) -> int:
    """The largest sum of two pieces besides one of size s that fits."""
    best, hi = 0, len(sizes) - 1
    left = {t: count[t] - (t == s) for t in sizes}
    for i, a in enumerate(sizes):
        while hi >= i and a + sizes[hi] > room:
            hi -= 1
        j = hi
        while j >= i and (not left[a] or not left[sizes[j]] or (i == j and left[a] < 2)):
            j -= 1
        if j >= i:
            best = max(best, a + sizes[j])
    return best


def best_fit(count: dict[int, int], length: int = LENGTH) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing on counts: (sizes, how often)."""
    groups: dict[int, list[list]] = defaultdict(list)  # by room left: [sizes, how often]
    rooms: list[int] = []

    def put(room: int, sizes: tuple[int, ...], n: int) -> None:
        if n:
            if not groups[room]:
                insort(rooms, room)
            groups[room].append([sizes, n])

    for s in sorted((s for s, n in count.items() if n), reverse=True):
        left = count[s]
        while left:
            at = bisect_left(rooms, s)
            if at == len(rooms):
                each = min(left, length // s)
                n = left // each
                put(length - each * s, (s,) * each, n)
                left -= n * each
                continue
            room = rooms[at]
            sizes, n = groups[room].pop()
            if not groups[room]:
                rooms.pop(at)
            each = min(left, room // s)
            full = min(n, left // each)
            put(room, sizes, n - full)
            put(room - each * s, sizes + (s,) * each, full)
            left -= full * each
    return [(tuple(sizes), n) for room in groups for sizes, n in groups[room]]


def places(count: dict[int, int], length: int = LENGTH) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By size: from which number within the size, which sequence that is, and the offset in it."""
    count = dict(count)
    patterns = reduce_sizes(count, length) + best_fit(count, length)
    used: dict[int, int] = defaultdict(int)
    out: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    sequence = 0
    for sizes, n in patterns:
        offset = 0
        for s in sizes:
            out[s].append((used[s], sequence, offset))
            used[s] += n
            offset += s
        sequence += n
    return {s: tuple(np.array(c, np.int64) for c in zip(*rows, strict=True)) for s, rows in out.items()}


def _placer(shared) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, where = shared.value
        for batch in batches:
            size, part, n = (batch.column(k).to_numpy() for k in (3, 5, 6))
            sequence, offset = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
            for s in np.unique(size):
                own = np.flatnonzero(size == s)
                number = n[own] - 1 + base[int(s)][part[own]]
                start, first, at = where[int(s)]
                k = np.searchsorted(start, number, side="right") - 1
                sequence[own], offset[own] = first[k] + number - start[k], at[k]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return run


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, length: int = LENGTH) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A full piece is a sequence of its own and is numbered where it is read,
    below zero.  Any other size is numbered within SLICES slices of its pieces,
    so that a size with a third of all pieces reaches no task whole; the driver
    gets at most length * SLICES counts.
    """
    part = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(SLICES)).cast("int")
    written = materialise(pieces(docs, id_col, text_col, vocabulary, length), "pieces")
    full = written.where(F.col("length") == length).select("doc_id", "piece", "start", "length", "ids_crc32", (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    got = written.where(F.col("length") < length).withColumn("part", part)
    slices: dict[int, np.ndarray] = defaultdict(lambda: np.zeros(SLICES, np.int64))
    for r in got.groupBy("length", "part").count().collect():
        slices[r["length"]][r["part"]] = r["count"]
    where = places({s: int(c.sum()) for s, c in slices.items()}, length)
    base = {s: np.concatenate([[0], np.cumsum(c)[:-1]]) for s, c in slices.items()}
    shared = docs.sparkSession.sparkContext.broadcast((base, where))
    numbered = got.withColumn("number", F.row_number().over(Window.partitionBy("length", "part").orderBy("doc_id", "piece", "start")).cast("long"))
    placed = numbered.select("doc_id", "piece", "start", "length", "ids_crc32", "part", "number").mapInArrow(
        _placer(shared), "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )
    return placed.unionByName(full)
