"""Mixing sources to target weights by capped water-filling; DataFrame functions only.

A document's size is its number of words.  The sources, in code point order and
null last, take the given weights in turn and share out as many words as all
documents have.  A source whose share passes `epochs` times its own size is
clamped there, and the excess goes to the others by weight, round by round
until none is above.  A round is one sum over the table of sources; the driver
holds only the level (words for one unit of weight, an exact fraction).

A source's target, rounded to words, is so many whole repetitions of all its
documents and a fractional one.  For the latter its documents are ordered by a
seeded hash of id and text and taken whole until the words run out; the one
document at the end is taken in part, so the words taken equal the rounded
target.  That document is found by sums over LEVELS levels of the hash's digits,
never by ordering a whole source: only rows that share the last digits (one
in DIGITS**LEVELS) are ordered.  Rows are joined to their source's plan by source
and slice, so a source with a third of all rows meets no task whole.

Null and empty texts have size 0 and nothing is taken of them.  A null source is
a source of its own.  Rows that repeat an id count each for itself; repeated
rows are told apart by nothing, so any of them is the one in part.  An empty
table gives an empty result; a text of any length is read whole.  Other columns
are not read.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, slices

WEIGHTS = (5, 2, 1)
EPOCHS = 3
SEED = "mix"
WORD = r"[^\x20\x09-\x0D]+"
#: Hexadecimal digits of the hash that one level looks at, and what they can be.
HEX = 3
DIGITS = 16**HEX
LEVELS = 2
_EXACT = "decimal(20,0)"


def words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text.cast("string"), F.lit("")), F.lit(WORD)).cast("long")


def _digits(level: int) -> Column:
    return F.conv(F.substring("h", 1 + HEX * level, HEX), 16, 10).cast("int")


def numbered(sources: DataFrame) -> DataFrame:
    """sources plus n, their place (from 0) by source, null last: counted within ranges, whose sizes are summed before."""
    ranges = int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = F.col("source").asc_nulls_last()
    dealt = materialise(sources.repartitionByRange(ranges, order).withColumn("part", F.spark_partition_id()), "mix-ranges")
    parts = dealt.groupBy("part").agg(F.count(F.lit(1)).alias("c"))
    before = parts.select("part", (F.sum("c").over(Window.orderBy("part")) - F.col("c")).alias("before"))
    place = F.row_number().over(Window.partitionBy("part").orderBy(order)) - 1
    return dealt.withColumn("place", place).join(before, "part").select("source", "source_size", "salts", (F.col("before") + F.col("place")).alias("n"))


def water_level(sources: DataFrame) -> Fraction:
    """Words for one unit of weight once no source is above its cap.  sources: source_size, w, cap."""
    total, weight = sources.agg(F.sum("source_size").cast(_EXACT), F.sum("w")).first()
    total, rest, weight, level = int(total or 0), int(total or 0), int(weight or 0), Fraction(0)
    while weight and Fraction(rest, weight) != level:
        level = Fraction(rest, weight)
        full = _is_full(level)
        held, weight = sources.agg(F.sum(F.when(full, F.col("cap").cast(_EXACT))), F.sum(F.when(~full, F.col("w")))).first()
        rest, weight = total - int(held or 0), int(weight or 0)
    return level


def _is_full(level: Fraction) -> Column:
    number = lambda x: F.lit(x).cast(_EXACT)
    return F.col("cap").cast(_EXACT) * number(str(level.denominator)) < F.col("w").cast("decimal(18,0)") * number(str(level.numerator))


def source_plan(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """source, salts, source_size, target, whole, rest: of every source its words, those to take, whole repetitions and what is left over."""
    part = rows.groupBy("source", "salt").agg(F.sum("size").alias("s"))
    sources = part.groupBy("source").agg(F.sum("s").alias("source_size"), F.collect_set("salt").alias("salts"))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("n") % len(weights) + 1).cast("int")).cast("long")
    sources = materialise(numbered(sources).withColumn("w", weight).withColumn("cap", F.col("source_size") * epochs), "mix-sources")
    level = water_level(sources)
    num, den = level.numerator, level.denominator
    share = F.expr(f"cast((2 * w * cast('{num}' as decimal(24,0)) + cast('{den}' as {_EXACT})) div (2 * cast('{den}' as {_EXACT})) as long)")
    full = _is_full(level)
    plan = sources.select(
        "source", "salts", "source_size",
        F.when(full, F.col("cap").cast("double")).otherwise(F.col("w") * F.lit(float(num)) / F.lit(float(den))).alias("target"),
        F.when(full, F.col("cap")).otherwise(F.least(share, F.col("cap"))).alias("words"),
    )
    some = F.col("source_size") > 0
    return plan.select(
        "source", "salts", "source_size", "target",
        F.when(some, F.expr("words div source_size")).otherwise(0).cast("long").alias("whole"),
        F.when(some, F.col("words") % F.col("source_size")).otherwise(0).cast("long").alias("rest"),
    )


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS, seed: str = SEED, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, size, source, source_size, target, taken, whole, part: words that the mix takes of each document, and as what.

    taken = whole * size + part, where whole counts whole repetitions and part
    is the words taken from the beginning of one more.
    """
    return _mixed(docs, weights, epochs, seed, id_col, text_col, source_col).drop("h")


def _own(docs: DataFrame, seed: str, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """doc_id, source, text (null: empty) and h, the seeded hash of id and text."""
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return own.withColumn("h", F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), "text").cast("binary")))


def _mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS, seed: str = SEED, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    rows = _own(docs, seed, id_col, text_col, source_col).select("doc_id", "source", words(F.col("text")).alias("size"), "h")
    rows = materialise(rows.withColumn("salt", F.pmod(F.xxhash64("h"), F.lit(slices(docs.sparkSession))).cast("int")), "mix-rows")
    plan = materialise(source_plan(rows, weights, epochs), "mix-plan")
    for level in range(LEVELS):
        plan = materialise(_with_cut(plan, _at_cut(_met(rows, plan, level), level), level), "mix-cut")
    met = _met(rows, plan, LEVELS)
    last = Window.partitionBy("source").orderBy("h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    ends = met.where(_equal(LEVELS)).withColumn("extra", F.least("size", F.greatest(F.lit(0), F.col("rest") - F.coalesce(F.sum("size").over(last), F.lit(0)))))
    others = met.where(~_equal(LEVELS)).withColumn("extra", F.when(_below(LEVELS), F.col("size")).otherwise(0))
    whole = F.col("whole") + F.when((F.col("extra") == F.col("size")) & (F.col("size") > 0), 1).otherwise(0)
    return others.unionByName(ends).select(
        "h", "doc_id", "size", "source", "source_size", "target", (F.col("whole") * F.col("size") + F.col("extra")).cast("long").alias("taken"),
        whole.cast("long").alias("whole"), F.when(F.col("extra") < F.col("size"), F.col("extra")).otherwise(0).cast("long").alias("part"),
    )


def _met(rows: DataFrame, plan: DataFrame, levels: int) -> DataFrame:
    """rows with their source's plan, by source and slice."""
    side = plan.withColumn("salt", F.explode("salts")).drop("salts").withColumn("known", F.lit(True))
    a, b = rows.alias("a"), side.alias("b")
    on = F.col("a.source").eqNullSafe(F.col("b.source")) & (F.col("a.salt") == F.col("b.salt"))
    cuts = [f"c{k}" for k in range(levels)]
    return a.join(b, on).select("a.doc_id", "a.source", "a.size", "a.h", "b.source_size", "b.target", "b.whole", "b.rest", *cuts)


def _equal(levels: int) -> Column:
    """The row lies among those at its source's cut, on every level so far."""
    same = F.lit(True)
    for k in range(levels):
        same = same & (_digits(k) == F.col(f"c{k}"))
    return same


def _below(levels: int) -> Column:
    out = F.lit(False)
    for k in reversed(range(levels)):
        d, c = _digits(k), F.col(f"c{k}")
        out = (d < c) | ((d == c) & out)
    return out


def _at_cut(met: DataFrame, level: int) -> DataFrame:
    """source, c, left: the next digits at which a source's rest runs out, and what is left of it there."""
    sums = met.where(_equal(level)).groupBy("source", _digits(level).alias("c")).agg(F.sum("size").alias("s"), F.first("rest").alias("rest"))
    before = F.sum("s").over(Window.partitionBy("source").orderBy("c")) - F.col("s")
    at = sums.withColumn("before", before).where("before <= rest and rest < before + s")
    return at.select("source", "c", (F.col("rest") - F.col("before")).alias("left"))


def _with_cut(plan: DataFrame, at: DataFrame, level: int) -> DataFrame:
    """plan with c<level> and the rest that is left there; a source without any rest of words is cut below all digits."""
    side = at.select(F.col("source").alias("s2"), "c", "left")
    met = plan.join(side, plan["source"].eqNullSafe(side["s2"]), "left")
    return met.withColumn("rest", F.coalesce("left", F.lit(0))).withColumn(f"c{level}", F.coalesce("c", F.lit(-1))).drop("s2", "c", "left")


def repeated(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", source_col: str = "source", seed: str = SEED, **how) -> DataFrame:
    """The mixed corpus itself: doc_id, source, text, repetition (from 0); a partial repetition holds the document's first words.

    Rows with the same id, text and source are taken together.
    """
    plan = _mixed(docs, seed=seed, id_col=id_col, text_col=text_col, source_col=source_col, **how).where("taken > 0")
    plan = plan.groupBy("h", "source").agg(F.sum("whole").alias("whole"), F.max("part").alias("part"))
    own = _own(docs, seed, id_col, text_col, source_col).dropDuplicates(["h", "source"])
    a, b = own.alias("a"), plan.alias("b")
    met = a.join(b, (F.col("a.h") == F.col("b.h")) & F.col("a.source").eqNullSafe(F.col("b.source"))).select("a.doc_id", "a.source", "a.text", "whole", "part")
    n = F.col("whole") + F.when(F.col("part") > 0, 1).otherwise(0)
    out = met.withColumn("repetition", F.explode(F.sequence(F.lit(0).cast("long"), n - 1)))
    first = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(1)), F.lit(1), F.col("part").cast("int")), " ")
    return out.select("doc_id", "source", F.when(F.col("repetition") < F.col("whole"), F.col("text")).otherwise(first).alias("text"), "repetition")


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')) AS h
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS HUGEINT) AS s, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS n FROM d GROUP BY source
), w AS (
  SELECT *, CAST(CASE n % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS HUGEINT) AS w, 3 * s AS cap, sum(s) OVER () AS total FROM s
), r AS (
  SELECT *, coalesce(sum(cap) OVER (ORDER BY cap / w, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS held,
         sum(w) OVER (ORDER BY cap / w, n ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open
  FROM w
), f AS (
  SELECT *, cap * open < (total - held) * w AS is_full FROM r
), l AS (
  SELECT total - coalesce(sum(cap) FILTER (is_full), 0) AS num, sum(w) FILTER (NOT is_full) AS den FROM f GROUP BY total
), p AS (
  SELECT source, s, CASE WHEN is_full THEN CAST(cap AS DOUBLE) ELSE CAST(w AS DOUBLE) * CAST(num AS DOUBLE) / CAST(den AS DOUBLE) END AS target,
         CASE WHEN is_full THEN cap ELSE (2 * w * CAST(num AS HUGEINT) + CAST(den AS HUGEINT)) // (2 * CAST(den AS HUGEINT)) END AS words
  FROM f, l
), o AS (
  SELECT d.doc_id, d.size, d.source, p.s, p.target, CASE WHEN p.s > 0 THEN p.words // p.s ELSE 0 END AS whole, CASE WHEN p.s > 0 THEN p.words % p.s ELSE 0 END AS rest,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, size, source, CAST(s AS BIGINT) AS source_size, target,
       CAST(whole * size + least(size, greatest(0, rest - before)) AS BIGINT) AS taken,
       CAST(whole + CASE WHEN size > 0 AND rest - before >= size THEN 1 ELSE 0 END AS BIGINT) AS whole,
       CAST(CASE WHEN rest > before AND rest - before < size THEN rest - before ELSE 0 END AS BIGINT) AS part
FROM o
"""
