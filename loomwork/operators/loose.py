"""Containment and likeness between texts, without comparing all with all.

Texts are read once for a block of phrases by an Aho-Corasick automaton, which
finds all of them in one pass, whatever letters they begin with.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from difflib import SequenceMatcher, get_close_matches

import ahocorasick
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.tables import settled

#: Bytes of phrases in an automaton, about: what is broadcast at a time.
BLOCK_BYTES = 4 << 20
_WORD = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_")


def _finder(shared, whole_words: bool, word_ends: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Replaces the last column, a text, by the distinct phrases found in it."""

    def found(machine: ahocorasick.Automaton, text: str) -> list[str]:
        if not whole_words:
            return sorted({p for end, p in machine.iter(text) if not word_ends or end + 1 == len(text) or text[end + 1] not in _WORD})
        fits = lambda end, p: (end + 1 == len(text) or text[end + 1] not in _WORD) and (end < len(p) or text[end - len(p)] not in _WORD)
        return sorted({p for end, p in machine.iter(text) if fits(end, p)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = ahocorasick.Automaton()
        for p in shared.value:
            machine.add_word(p, p)
        machine.make_automaton()
        for b in batches:
            hits = [found(machine, t) if t and len(machine) else [] for t in b.column(b.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(hits, pa.list_(pa.string()))], names=[*b.schema.names[:-1], "__phrases"])

    return run


def containing(rows: DataFrame, text: str, phrases: DataFrame, phrase: str, whole_words: bool = False, block_bytes: int = BLOCK_BYTES, word_ends: bool = False) -> DataFrame:
    """All pairs of a row and a phrase that its text contains, without regard to case; an empty or null phrase is in nothing.

    Phrases are dealt into blocks of about `block_bytes`, each once; a block is
    broadcast and all texts are read against it.  Only the phrases that a row
    holds go on, to meet the phrases' other columns by equality.  With
    `word_ends` a phrase counts only where no letter, digit or _ follows.
    """
    spark = rows.sparkSession
    side = phrases.withColumn("__phrase", F.lower(phrase)).where("__phrase <> ''")
    distinct = side.select("__phrase").distinct()
    size = distinct.agg(F.sum(F.octet_length("__phrase") + 64).cast("long")).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    dealt = distinct.withColumn("block", F.pmod(F.xxhash64("__phrase"), F.lit(blocks)))
    dealt = settled(dealt, "phrases") if blocks > 1 else dealt
    asked = rows.withColumn("__low", F.lower(F.col(text)))
    schema = T.StructType([*rows.schema.fields, T.StructField("__phrases", T.ArrayType(T.StringType()))])
    met = None
    for k in range(blocks):
        shared = spark.sparkContext.broadcast([r[0] for r in dealt.where(F.col("block") == k).select("__phrase").collect()])
        hit = asked.mapInArrow(_finder(shared, whole_words, word_ends), schema).withColumn("__phrase", F.explode("__phrases")).drop("__phrases")
        met = hit if met is None else met.unionByName(hit)
    return met.join(side, "__phrase").drop("__phrase")


def first_contained(rows: DataFrame, key: str, text: str, phrases: DataFrame, phrase: str, order: list[str | Column]) -> DataFrame:
    """key, and the columns of the first phrase, in the given order, that the text contains."""
    met = containing(rows.select(key, text), text, phrases, phrase)
    n = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return met.withColumn("__n", n).where("__n = 1").drop("__n", text)


def usages(names: DataFrame, name: str, lines: DataFrame, text: str, order: list[str], most: int = 4) -> DataFrame:
    """The first `most` rows, in order, whose text contains the name as whole words."""
    met = containing(lines, text, names.select(name).distinct(), name, whole_words=True)
    n = F.row_number().over(Window.partitionBy(name).orderBy(*order))
    return met.withColumn("place", n).where(F.col("place") <= most)


def close_pairs(left: DataFrame, right: DataFrame, block: str, key: str, text: str, most: int, cutoff: float) -> DataFrame:
    """block, key, other, ratio: up to `most` other keys of the same block whose texts are most alike, the first of equals.

    Both sides have the block, a key and a text; a null block, key or text is
    like nothing.  Rows may repeat and a key may have several texts: two keys
    are as alike as the most alike of their texts, and are one pair.  Likeness
    is asked once for two texts, however many keys and blocks have them.  Of
    each text in a block only the first `most` + 1 different keys can be
    anybody's result: at most one of them is the key that asks, and the others
    are as alike as any later key and come before it.
    """
    kind, block_kind = dict(left.dtypes)[key], dict(left.dtypes)[block]
    own = left.select(block, key, F.col(text).alias("__text")).where("__text is not null").distinct()
    asked = own.select(block, "__text").distinct()
    nth = F.row_number().over(Window.partitionBy(block, "__other_text").orderBy("other"))
    first = right.select(F.col(block), F.col(key).alias("other"), F.col(text).alias("__other_text")).where("other is not null and __other_text is not null").distinct()
    first = settled(first.withColumn("__n", nth).where(F.col("__n") <= most + 1).drop("__n"), "first-keys")
    pairs = asked.join(first.select(block, "__other_text").distinct(), block).select("__text", "__other_text").distinct()

    def score(frames):
        for frame in frames:
            kept = []
            for a, b in zip(frame["__text"], frame["__other_text"], strict=True):
                m = SequenceMatcher(None, a, b)
                kept.append(m.ratio() if m.real_quick_ratio() >= cutoff and m.quick_ratio() >= cutoff else -1.0)
            yield frame.assign(ratio=kept)

    parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = pairs.repartition(parts, "__text", "__other_text")
    alike = settled(spread.mapInPandas(score, "__text string, __other_text string, ratio double").where(F.col("ratio") >= cutoff), "alike")
    likely = asked.join(first, block).join(alike, ["__text", "__other_text"]).groupBy(block, "__text", "other").agg(F.max("ratio").alias("ratio"))
    best = F.row_number().over(Window.partitionBy(block, "__text").orderBy(F.desc("ratio"), "other"))
    likely = likely.withColumn("__n", best).where(F.col("__n") <= most + 1).select(block, "__text", "other", "ratio")
    met = own.join(likely, [block, "__text"]).where(F.col(key) != F.col("other")).groupBy(block, key, "other").agg(F.max("ratio").alias("ratio"))
    n = F.row_number().over(Window.partitionBy(block, key).orderBy(F.desc("ratio"), "other"))
    return met.select(F.col(block).cast(block_kind), F.col(key).cast(kind), F.col("other").cast(kind), "ratio").withColumn("rank", n).where(F.col("rank") <= most)


def suggestions(rows: DataFrame, term: str, pool: list[str], most: int = 3, cutoff: float = 0.62) -> DataFrame:
    """Adds `suggested`: up to `most` names of a short pool that come close to the term."""

    def suggest(frames):
        for frame in frames:
            yield frame.assign(suggested=pd.Series([get_close_matches(t or "", pool, most, cutoff) for t in frame[term]], index=frame.index, dtype=object))

    return rows.mapInPandas(suggest, ", ".join(f"{c} {t}" for c, t in rows.dtypes) + ", suggested array<string>")
