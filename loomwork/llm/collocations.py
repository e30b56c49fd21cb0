r"""Phrase collocations by suffix-sigma.

Texts are lower-cased (A-Z only), cut into pieces at `[.,;:!?\x0A-\x0D]` and
those into words `[^\x20\x09]+`.  Every word begins one suffix of at most
MOST_WORDS words of its piece.  A task sums equal suffixes of about BLOCK_BYTES
of text, sorts them and deals them by language and first words into ranges;
each range is sorted in reverse lexicographic order and one stack counts all
prefixes of its suffixes.  Ranges end where a sample of the suffixes says, so a
first word (or pair, or triple) with a large share of all rows is divided between
ranges; the sample decides nothing but where.  A range gives every prefix that
reaches `least` and, whatever their counts, those of its first and last suffix,
which a neighbour may share; sums over ranges are therefore exact.

Parts are joined afterwards: a part of a phrase is at least as frequent as the
phrase, so it is among the counted ones.  Scores are exact (decimals of 38
digits, whole division).

A range holds about RANGE_BYTES of text; there are as many as the text needs,
and a suffix leaves its block in one row at most.  A null text is empty, a null
language is `und`.  An empty table gives an empty result; texts of any length
are read whole; repeated rows count each; no other column is read.
"""

from __future__ import annotations

import struct
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

MOST_WORDS = 4
LEAST = 30
TOP = 2000
SCALE = 2_000_000
#: A shorter phrase goes if a longer one around it has this share of its count.
SHARE = 80
UNKNOWN = "und"
BLOCK_BYTES = 16_000_000
RANGE_BYTES = 8_000_000
#: One in so many documents is looked at for the ends of ranges, and so many suffixes a range are kept of them.
SAMPLE = 50
PER_RANGE = 64

_FOLD = bytes(10 if c in b".,;:!?\n\x0b\x0c\r" else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))
# Words hold no tab, so moving 0-8 up by one keeps their order and frees 0 to stand between words.
_UP = bytes(c + 1 if c < 9 else c for c in range(256))
_DOWN = bytes(c - 1 if 1 <= c <= 9 else c for c in range(256))
_END = b"\n"
_FOUND = "lang string, phrase binary, f long"


class _Ids(dict):
    """Numbers for words in the order in which they come; 0 is the end of a piece, -1 nothing."""

    def __init__(self) -> None:
        super().__init__({_END: 0, b"": -1})

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self) - 1
        return n


class Block:
    """The suffixes of one language's texts in a task, summed."""

    def __init__(self) -> None:
        self.ids, self.parts, self.n_bytes = _Ids(), [], 0

    def add(self, text: bytes) -> None:
        words = text.translate(_FOLD).replace(b"\n", b" \n ").split(b" ")
        self.parts.append(np.fromiter(map(self.ids.__getitem__, words), np.int32, len(words)))
        self.parts.append(np.zeros(1, np.int32))
        self.n_bytes += len(text)

    def suffixes(self) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """Words in order, suffixes (rows of word places from 1; 0: none) in order, how often each."""
        words = [w.translate(_UP) for w in self.ids if w not in (_END, b"")]
        order = sorted(range(len(words)), key=words.__getitem__)
        rank = np.zeros(len(words) + 1, np.int32)
        rank[np.array(order, np.int64) + 1] = np.arange(1, len(words) + 1)
        flat = np.concatenate(self.parts) if self.parts else np.zeros(0, np.int32)
        flat = np.concatenate([rank[flat[flat >= 0]], np.zeros(MOST_WORDS, np.int32)])
        n = len(flat) - MOST_WORDS
        cols = [flat[:n]]
        for k in range(1, MOST_WORDS):
            cols.append(np.where(cols[-1] > 0, flat[k : k + n], 0))
        keep = cols[0] > 0
        rows, count = summed(np.stack([c[keep] for c in cols], 1), np.ones(int(keep.sum()), np.int64))
        return [words[i] for i in order], rows, count


def summed(rows: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows in order, with the sums of their counts."""
    if not len(rows):
        return rows, count
    order = _order(rows)
    rows, count = rows[order], count[order]
    new = np.flatnonzero(np.concatenate([[True], (rows[1:] != rows[:-1]).any(1)]))
    return rows[new], np.add.reduceat(count, new)


def _order(rows: np.ndarray) -> np.ndarray:
    """Places of the rows in lexicographic order; neighbouring columns share a 64-bit key while they fit."""
    keys, room = [], 0
    size = int(rows.max(initial=0)) + 1
    for c in rows.T.astype(np.int64):
        if keys and room * size < 1 << 62:
            keys[-1], room = keys[-1] * size + c, room * size
        else:
            keys.append(c)
            room = size
    return np.lexsort(keys[::-1]) if len(keys) > 1 else np.argsort(keys[0], kind="stable")


def spelled(words: list[bytes], row: np.ndarray) -> bytes:
    return b"\0".join(words[i - 1] for i in row.tolist() if i)


def _place(rows: np.ndarray, words: list[bytes], suffix: bytes) -> int:
    """How many rows stand before a suffix of another block."""
    low, high = 0, len(rows)
    for k, w in enumerate(suffix.split(b"\0") if suffix else []):
        at = bisect_left(words, w)
        word_of = lambda i, k=k: rows[i, k]
        low = bisect_left(range(high), at + 1, low, key=word_of)
        if low == high or at == len(words) or words[at] != w:
            break
        high = bisect_right(range(high), at + 1, low, key=word_of)
        if low == high:
            break
    return low


def _packed(words: list[bytes], rows: np.ndarray, count: np.ndarray) -> bytes:
    """The words that some rows use, the rows and their counts, in little room."""
    used, place = np.unique(rows, return_inverse=True)
    own = [words[i - 1] for i in used.tolist() if i]
    place = place.reshape(rows.shape) + (0 if len(used) and used[0] == 0 else 1)
    text = b"\n".join(own)
    numbers = np.concatenate([place.astype("<u4").T.ravel(), count.astype("<u8").view("<u4")]).view(np.uint8).reshape(-1, 4).T
    return struct.pack("<qq", len(text), len(rows)) + zstandard.ZstdCompressor(level=1).compress(text + numbers.tobytes())


def _unpacked(pack: bytes) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    size, n = struct.unpack_from("<qq", pack)
    raw = zstandard.ZstdDecompressor().decompress(pack[16:])
    numbers = np.ascontiguousarray(np.frombuffer(raw, np.uint8, offset=size).reshape(4, -1).T).view("<u4").ravel()
    rows = numbers[: n * MOST_WORDS].reshape(MOST_WORDS, n).T.astype(np.int32)
    return raw[:size].split(b"\n") if size else [], rows, np.ascontiguousarray(numbers[n * MOST_WORDS :]).view("<u8").astype(np.int64)


def _blocks(batches: Iterator[pa.RecordBatch], block_bytes: int) -> Iterator[tuple[str, Block]]:
    """Full blocks of each language as they fill up."""
    held: dict[str, Block] = {}
    for b in batches:
        for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist(), strict=True):
            held.setdefault(lang, Block()).add(text)
            if sum(x.n_bytes for x in held.values()) >= block_bytes:
                yield from held.items()
                held = {}
    yield from held.items()


def _dealer(ends: list[tuple[str, bytes]], block_bytes: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (range, lang, pack): the suffixes of a block, cut at the ends of ranges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, block in _blocks(batches, block_bytes):
            words, rows, count = block.suffixes()
            low, high = bisect_left(ends, (lang, b"")), bisect_left(ends, (lang + "\0", b""))
            cuts = [0, *(_place(rows, words, ends[k][1]) for k in range(low, high)), len(rows)]
            for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                if b > a:
                    pack = _packed(words, rows[a:b], count[a:b])
                    yield pa.RecordBatch.from_arrays([pa.array([low + k], pa.int32()), pa.array([lang]), pa.array([pack], pa.binary())], ["range", "lang", "pack"])

    return run


def _sampler(one_in: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, block in _blocks(batches, BLOCK_BYTES):
            words, rows, count = block.suffixes()
            some = np.arange(len(rows) % one_in // 2, len(rows), one_in)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(some), pa.string()), pa.array([spelled(words, rows[i]) for i in some], pa.binary())], ["lang", "suffix"]
            )

    return run


def range_ends(own: DataFrame, n_bytes: int, range_bytes: int = RANGE_BYTES) -> list[tuple[str, bytes]]:
    """Where ranges end: language and suffix, at most one for every `range_bytes` of text."""
    spark = own.sparkSession
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_bytes // range_bytes))
    share = min(1.0, max(1 / SAMPLE, BLOCK_BYTES / max(1, n_bytes)))
    one_in = max(1, int(n_bytes * share / 6 / (ranges * PER_RANGE)))
    found = own.sample(share, seed=7).mapInArrow(_sampler(one_in), "lang string, suffix binary")
    some = sorted((r["lang"], bytes(r["suffix"])) for r in found.collect())
    return sorted({some[k * len(some) // ranges] for k in range(1, ranges)}) if some else []


def prefixes(rows: np.ndarray, count: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """(row, words, count) of every prefix to be told, by one stack over rows in reverse lexicographic order.

    The prefixes of the first and the last row are told whatever their counts.
    """
    if not len(rows):
        return
    alike = np.cumprod(rows[1:] == rows[:-1], axis=1)
    depth = (rows > 0).sum(1)
    shared = [0, *np.minimum(alike.sum(1), np.minimum(depth[1:], depth[:-1])).tolist(), 0]
    depths, before = [*depth.tolist(), 0], [0, *np.cumsum(count).tolist()]
    stack: list[int] = []
    n = len(rows)
    for i in range(n + 1):
        keep = shared[i]
        while len(stack) > keep:
            start = stack.pop()
            f = before[i] - before[start]
            if f >= least or start == 0 or i == n:
                yield start, len(stack) + 1, f
        if len(stack) < depths[i]:
            stack += [i] * (depths[i] - len(stack))


def _counter(least: int) -> Callable[[pa.Table], pa.Table]:
    """One range: its packs merged, sorted and counted; the row without a phrase is the number of words."""

    def run(packs: pa.Table) -> pa.Table:
        out: list[tuple[str, bytes | None, int]] = []
        langs = packs.column("lang").to_pylist()
        for lang in sorted(set(langs)):
            parts = [_unpacked(p) for p, x in zip(packs.column("pack").to_pylist(), langs, strict=True) if x == lang]
            words = sorted(set().union(*(p[0] for p in parts)))
            at = {w: n for n, w in enumerate(words, 1)}
            moved = [np.array([0, *map(at.__getitem__, own)], np.int32)[rows] for own, rows, _ in parts]
            rows, count = summed(np.concatenate(moved), np.concatenate([p[2] for p in parts]))
            out.append((lang, None, int(count.sum())))
            for row, k, f in prefixes(rows[::-1], count[::-1], least):
                out.append((lang, b" ".join(words[i - 1].translate(_DOWN) for i in rows[len(rows) - 1 - row, :k].tolist()), f))
        cols = list(zip(*out, strict=True)) or [[]] * 3
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.binary(), pa.int64()), strict=True)], ["lang", "phrase", "f"])

    return run


def phrase_counts(docs: DataFrame, least: int = LEAST, text_col: str = "text", lang_col: str = "lang", block_bytes: int = BLOCK_BYTES, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """lang, phrase, f: every phrase of up to MOST_WORDS words that occurs `least` times, and with a null phrase the number of all words."""
    own = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))
    n_bytes = own.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    packs = own.mapInArrow(_dealer(range_ends(own, n_bytes, range_bytes), block_bytes), "range int, lang string, pack binary")
    found = packs.groupBy("range").applyInArrow(_counter(least), _FOUND).select("lang", F.col("phrase").cast("string").alias("phrase"), "f")
    return found.groupBy("lang", "phrase").agg(F.sum("f").alias("f")).where(F.col("phrase").isNull() | (F.col("f") >= least))


def _exact(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(20,0)")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, text_col: str = "text", lang_col: str = "lang", **sizes) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the `top` collocations of every language."""
    counts = materialise(phrase_counts(docs, least, text_col, lang_col, **sizes), "phrase-counts")
    known = counts.where("phrase is not null").select("lang", F.col("phrase").alias("part"), "f")
    words = F.split("phrase", " ")
    phrases = counts.where("phrase is not null").select("lang", "phrase", F.col("f").alias("a"), words.alias("w")).where(F.size("w") > 1)
    join = lambda at, n: F.array_join(F.slice("w", at, n), " ")
    cut = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("w") - 1))).select("lang", "phrase", "a", "k", join(F.lit(1), F.col("k")).alias("first"), join(F.col("k") + 1, F.size("w") - F.col("k")).alias("rest"))
    left = known.select("lang", F.col("part").alias("first"), F.col("f").alias("l"))
    right = known.select("lang", F.col("part").alias("rest"), F.col("f").alias("r"))
    cut = cut.join(left, ["lang", "first"]).join(right, ["lang", "rest"])
    cut = cut.withColumn("up", _exact("a") * F.lit(SCALE)).withColumn("down", _exact("l") + _exact("r")).withColumn("score", F.expr("cast(up div down as long)"))
    scored = cut.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("m")).select("lang", "phrase", "a", "m.l", "m.r", "m.score")
    inner = phrases.where(F.size("w") > 2).withColumn("m", F.explode(F.sequence(F.lit(2), F.size("w") - 1))).withColumn("at", F.explode(F.sequence(F.lit(1), F.size("w") - F.col("m") + 1)))
    around = inner.groupBy("lang", join(F.col("at"), F.col("m")).alias("phrase")).agg(F.max("a").alias("longer"))
    kept = scored.join(around, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (_exact("longer") * 100 < _exact("a") * SHARE)).drop("longer")
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    best = kept.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    n = counts.where("phrase is null").select("lang", F.col("f").alias("n"))
    return best.join(n, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


ORACLE_SQL = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), w AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p
), n AS (
  SELECT lang, sum(len(w)) AS n FROM w GROUP BY lang
), i AS (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w
), g AS (
  SELECT lang, w, i, unnest(range(1, least(4, len(w) - i + 1) + 1)) AS m FROM i
), f AS (
  SELECT lang, list_slice(w, i, i + m - 1) AS w, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 30
), c AS (
  SELECT lang, w, f, unnest(range(1, len(w))) AS k FROM f WHERE len(w) > 1
), s AS (
  SELECT c.lang, c.w, c.f AS a, c.k, x.f AS l, y.f AS r, CAST(CAST(2000000 AS HUGEINT) * c.f // (x.f + y.f) AS BIGINT) AS score
  FROM c JOIN f x ON x.lang = c.lang AND x.w = c.w[1:c.k] JOIN f y ON y.lang = c.lang AND y.w = c.w[c.k + 1:]
  QUALIFY row_number() OVER (PARTITION BY c.lang, c.w ORDER BY score, k) = 1
), m AS (
  SELECT lang, w, f, unnest(range(2, len(w))) AS m FROM f WHERE len(w) > 2
), o AS (
  SELECT lang, w, f, m, unnest(range(1, len(w) - m + 2)) AS j FROM m
), b AS (
  SELECT lang, list_slice(w, j, j + m - 1) AS w, max(f) AS longer FROM o GROUP BY ALL
), t AS (
  SELECT s.lang, array_to_string(s.w, ' ') AS phrase, a, l, r, score
  FROM s LEFT JOIN b ON b.lang = s.lang AND b.w = s.w WHERE longer IS NULL OR 100 * longer < 80 * a
)
SELECT t.lang, row_number() OVER (PARTITION BY t.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, score
FROM t JOIN n ON n.lang = t.lang QUALIFY rank <= 2000
"""
