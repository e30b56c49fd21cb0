"""Cross-entropy difference between a target and a background word model.

Both are bigram models over one shared vocabulary: every lower-cased word of
the corpus, every sign, and every character of scripts written without spaces.
Nothing is left out of it and it grows with the input.  The background model
counts every document, the target model every document whose label marks it as
wanted.  Word probabilities add HALF to each count; pair probabilities add
MASS times the word probability, so an unseen pair falls back to its word.  A
document's score is its mean loss in bits per word under the target model minus
that under the background model: lower means more like the target.

Documents are dealt into blocks by their id.  A block sums its grams (words,
words as histories, pairs; 64-bit keys) and deals them by key to buckets; a
bucket adds up those of all blocks and answers each with the corpus's counts in
the order in which it asked.  A gram leaves a block once, so a common one is no
larger than a rare one, and no table of counts is held whole anywhere.  Blocks
and buckets are as many as the text needs.

Null and empty texts have no words and score 0.  Repeated rows each get their
own row.  Rows with a null id are dealt by their text and are never wanted.

Without any wanted row the target model has counted nothing and every word costs
it the same.  An empty table gives an empty result.  Texts of any length are read
whole; a document is never divided between blocks.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, materialise

HALF = 0.5
MASS = 32.0
#: Bytes of text in a block, about.
BLOCK_BYTES = 8_000_000
#: Words kept with their keys in a worker; a full cache starts again.
CACHE_WORDS = 400_000
SINGLE = "฀-໿က-႟ក-៿぀-ヿ㐀-䶿一-鿿가-힯豈-﫿\U00020000-\U0003ffff"
_WORD = re.compile(rf"[^\W{SINGLE}]+|[^\s]")
WORD, PAIR, HISTORY = (np.uint64(k) for k in range(3))
_KINDS = np.uint64(3)


class _Keys(dict):
    def __missing__(self, word: str) -> int:
        key = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return key


_keys = _Keys()


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def keys(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every word: its own key, that of the word before it as a history, that of the pair; 0 stands before the start."""
    if len(_keys) > CACHE_WORDS:
        _keys.clear()
    found = words(text)
    w = np.fromiter(map(_keys.__getitem__, found), np.uint64, len(found))
    h = np.concatenate([np.zeros(1, np.uint64), w])[:-1]
    pair = h * np.uint64(0x9E3779B97F4A7C15) + (w ^ (w >> np.uint64(29)))
    pair = (pair ^ (pair >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    pair ^= pair >> np.uint64(32)
    return w & ~_KINDS | WORD, h & ~_KINDS | HISTORY, pair & ~_KINDS | PAIR


def _pack(a: np.ndarray) -> bytes:
    """Bytes of equal weight side by side, which makes small numbers short."""
    return zlib.compress(np.ascontiguousarray(a.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def _unpack(b: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zlib.decompress(b), np.uint8).reshape(8, -1).T).view("<u8").ravel()


def _edges(n: int) -> np.ndarray:
    return np.array([-(-(k << 64) // n) for k in range(n)], np.uint64)


def _block(docs: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The block's distinct keys, the place of each gram among them, words per document."""
    parts = [keys(t) for t in docs.column("text").to_pylist()]
    size = np.array([len(p[0]) for p in parts], np.int64)
    flat = np.concatenate([np.concatenate([p[k] for p in parts]) for k in range(3)]) if parts else np.empty(0, np.uint64)
    code, found = pd.factorize(flat)  # by a hash table, several times faster than by sorting all of them
    order = np.argsort(found)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return found[order], rank[code].reshape(3, -1), size


def _asker(buckets: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(docs: pa.Table, wanted: pa.Table) -> pa.Table:
        distinct, place, size = _block(docs)
        held = np.array([i is not None for i in docs.column("doc_id").to_pylist()], bool) & np.isin(
            docs.column("doc_id").fill_null(0).to_numpy(), wanted.column("wanted").to_numpy()
        )
        everywhere = np.bincount(place.ravel(), minlength=len(distinct))
        target = np.bincount(place[:, np.repeat(held, size)].ravel(), minlength=len(distinct))
        cuts = [*np.searchsorted(distinct, _edges(buckets)).tolist(), len(distinct)]
        block = docs.column("block")[0].as_py() if docs.num_rows else None
        rows = []
        for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            if b > a:
                rows.append((block, k, _pack(np.diff(distinct[a:b], prepend=np.uint64(0))), _pack(everywhere[a:b]), _pack(target[a:b])))
        cols = list(zip(*rows, strict=True)) or [[]] * 5
        kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], ["block", "bucket", "gram", "b", "t"])

    return run


def _answer(asked: pa.Table) -> pa.Table:
    """Sums over all blocks for each block; the first row also has the bucket's totals over words."""
    gram = [np.cumsum(_unpack(x), dtype=np.uint64) for x in asked.column("gram").to_pylist()]
    place, distinct = pd.factorize(np.concatenate(gram))
    total = [np.bincount(place, np.concatenate([_unpack(x) for x in asked.column(c).to_pylist()]).astype(np.float64), len(distinct)).astype(np.uint64) for c in "bt"]
    own = (distinct & _KINDS) == WORD
    sums = [int(own.sum()), int(total[0][own].sum()), int(total[1][own].sum())]
    ends = np.cumsum([len(g) for g in gram])
    back = [[_pack(x[place[e - len(g) : e]]) for g, e in zip(gram, ends, strict=True)] for x in total]
    rest = [0] * (len(gram) - 1)
    return pa.Table.from_arrays(
        [asked.column("block"), asked.column("bucket"), pa.array(back[0], pa.binary()), pa.array(back[1], pa.binary()), *(pa.array([s, *rest], pa.int64()) for s in sums)],
        ["block", "bucket", "b", "t", "vocabulary", "all_words", "wanted_words"],
    )


def losses(word: np.ndarray, history: np.ndarray, pair: np.ndarray, total: int, vocabulary: int) -> np.ndarray:
    """Bits of every word, from its count, its history's and the pair's."""
    p = (word + HALF) / (total + HALF * vocabulary)
    return -np.log2((pair + MASS * p) / (history + MASS))


def _scorer(vocabulary: int, totals: tuple[int, int]) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        distinct, place, size = _block(docs)
        answers = answers.sort_by("bucket")
        loss = []
        for c, total in zip("tb", totals, strict=True):
            seen = np.concatenate([np.empty(0), *(_unpack(x) for x in answers.column(c).to_pylist())])
            if len(seen) != len(distinct):
                raise ValueError("a block was read again with other texts")
            w, h, pair = seen[place]
            bits = np.concatenate([[0.0], np.cumsum(losses(w, h, pair, total, vocabulary))])
            ends = np.cumsum(size)
            loss.append((bits[ends] - bits[ends - size]) / np.maximum(size, 1))
        t, b = loss
        return pa.Table.from_arrays([docs.column("doc_id"), pa.array(size), pa.array(t), pa.array(b), pa.array(t - b)], ["doc_id", "n_tokens", "target_loss", "background_loss", "score"])

    return run


def score_difference(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", wanted: int = 1, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_tokens, target_loss, background_loss, score."""
    own = id_and_text(docs, id_col, text_col)
    n_bytes = own.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    n = max(2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n_bytes // block_bytes))
    block = F.pmod(F.xxhash64(F.coalesce("doc_id", F.xxhash64("text"))), F.lit(n)).cast("int").alias("block")
    own = own.select(block, "doc_id", "text")
    target = labels.where((F.col(label_col) == wanted) & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc_id"))
    target = target.select(F.pmod(F.xxhash64("doc_id"), F.lit(n)).cast("int").alias("block"), F.col("doc_id").alias("wanted"))
    asked = own.groupBy("block").cogroup(target.groupBy("block")).applyInArrow(_asker(n), "block int, bucket int, gram binary, b binary, t binary")
    answers = materialise(
        asked.groupBy("bucket").applyInArrow(_answer, "block int, bucket int, b binary, t binary, vocabulary long, all_words long, wanted_words long"), "answers"
    )
    s = answers.agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in ("vocabulary", "wanted_words", "all_words"))).first()
    asked_back = answers.select("block", "bucket", "b", "t")
    score = _scorer(max(1, s[0]), (s[1], s[2]))
    return own.groupBy("block").cogroup(asked_back.groupBy("block")).applyInArrow(score, "doc_id long, n_tokens long, target_loss double, background_loss double, score double")
