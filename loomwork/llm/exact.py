"""Exact duplicates through a two-pass Bloom filter; DataFrame functions only.

Pass one sets one bit position for the digest of every text, so one number a row
is what shuffles, summed before; it keeps the positions that were set more than
once.  Pass two tests every row: one whose position was set once is certainly
unique and passes straight through; only the rest shuffle, to be grouped exactly
by SHA-256.  The filter has about PER_ROW bits a row up to BITS, so what is
broadcast is at most BITS / 64 words, and only words with a repeated position.
A fuller filter lets more digests through to the shuffle (40 bytes a row, a
hundredth of its text or so), never a wrong answer.

Texts are equal when identical after every run of white space (space, tab to
carriage return) becomes one space; null counts as empty.  Of equal texts the
smallest id stays; null ids never win against others.  Rows that share id and
text are all marked kept by exact_groups (their id is the group's), and
drop_copies leaves one of them.

An empty table gives an empty result.  A text of any length is one digest; other
columns, whatever their names, are kept as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.tables import beside
from .common import id_and_text, materialise, salt, spread_groups

BITS = 1 << 27
PER_ROW = 32
#: Positions of a member in the second kind of filter, which only asks whether a key was set at all.
HASHES = 2


def digest(text: Column) -> Column:
    """Lower-case hex SHA-256 of the normalised text; a lone space is already normal and is skipped."""
    normal = F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+", " ")
    return F.sha2(normal.cast("binary"), 256)


def bits_for(rows: DataFrame, most: int) -> int:
    """A power of two, PER_ROW bits a row or a little more, at most `most`."""
    return min(most, 1 << max(10, (PER_ROW * rows.count() - 1).bit_length()))


def positions(sha: Column, bits: int) -> list[Column]:
    return [F.xxhash64(sha, F.lit(k)).bitwiseAND(F.lit(bits - 1)) for k in range(HASHES)]


def repeated_bits(shas: DataFrame, bits: int) -> DataFrame:
    """(word, mask): the positions that more than one row set, 64 to a word; shas has a column sha."""
    hit = shas.groupBy(positions(F.col("sha"), bits)[0].alias("p")).agg(F.count(F.lit(1)).alias("c"))
    return (
        hit.where("c > 1")
        .groupBy(F.shiftright("p", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("mask"))
    )


def set_bits(keys: DataFrame, bits: int) -> DataFrame:
    """(word, mask): the positions that any row set; keys has a column sha."""
    hit = keys.select(F.explode(F.array(*positions(F.col("sha"), bits))).alias("p"))
    return hit.groupBy(F.shiftright("p", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("mask"))


def mark_possible(rows: DataFrame, sha_col: str, filter_words: DataFrame, bits: int, out: str, hashes: int = HASHES) -> DataFrame:
    """rows plus the boolean `out`: false means that the filter certainly lacks this key."""
    marked = rows.withColumn(out, F.lit(True))
    for k, p in enumerate(positions(F.col(sha_col), bits)[:hashes]):
        word, mask = f"__loom_w{k}", f"__loom_m{k}"
        side = filter_words.select(F.col("word").alias(word), F.col("mask").alias(mask))
        at = marked.withColumn("__loom_p", p)
        marked = at.join(F.broadcast(side), F.shiftright(at["__loom_p"], 6) == side[word], "left").withColumn(
            out, F.col(out) & (F.coalesce(F.expr(f"shiftright({mask}, cast(__loom_p & 63 as int)) & 1"), F.lit(0)) == 1)
        ).drop(word, mask, "__loom_p")
    return marked


def without(docs: DataFrame, keys: list[Column], gone: DataFrame, bits: int = BITS) -> DataFrame:
    """docs without the rows whose keys (null equals null) are in gone, a written table with one column for each of them.

    The keys make a filter; a row that it lacks passes straight through, so only
    rows that may leave move to be compared.
    """
    bits = bits_for(gone, bits)
    own, theirs = [f"__loom_k{k}" for k in range(len(keys))], [f"__loom_g{k}" for k in range(len(keys))]
    list_ = gone.toDF(*theirs)
    whole = docs.select(F.struct(*docs.columns).alias("__loom_row"), *(k.alias(n) for k, n in zip(keys, own, strict=True))).withColumn("__loom_key", F.xxhash64(*own))
    asked = mark_possible(whole, "__loom_key", set_bits(list_.select(F.xxhash64(*theirs).alias("sha")), bits), bits, "__loom_possible")
    stays, some = asked.where(~F.col("__loom_possible")), asked.where("__loom_possible")
    met = [some[a].eqNullSafe(list_[b]) for a, b in zip(own, theirs, strict=True)]
    return stays.select("__loom_row.*").unionByName(beside(some, list_, met, "left_anti").select("__loom_row.*"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = BITS) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row per input row."""
    own = id_and_text(docs, id_col, text_col)
    rows = materialise(own.select("doc_id", digest(F.col("text")).alias("sha")), "digests")
    bits = bits_for(rows, bits)
    marked = mark_possible(rows, "sha", repeated_bits(rows, bits), bits, "possible", hashes=1)
    lone = marked.where("not possible").select("doc_id", "sha", F.col("doc_id").alias("group_min"), F.lit(1).cast("long").alias("group_rows"))
    some = marked.where("possible").select("doc_id", "sha", salt(docs.sparkSession, "doc_id").alias("salt"))
    met = beside(some, spread_groups(some.select("doc_id", "sha"), ["sha"], "doc_id"), ["sha", "salt"]).select("doc_id", "sha", "group_min", "group_rows")
    return lone.unionByName(met).select(
        "doc_id",
        F.col("group_min").alias("keep_id"),
        F.col("group_rows").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("group_min")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = BITS) -> DataFrame:
    """docs with one row of each group of equal texts; all columns.

    Digests are written once with their ids and decided there.  The ids of rows
    that may have an equal go into a filter of the same kind, so a row whose id
    is not in it passes straight through, its text not read again; only the
    others take their digest with them and shuffle.
    """
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), digest(F.col(text_col)).alias("sha"))
    rows = materialise(own, "digests")
    bits = bits_for(rows, bits)
    possible = mark_possible(rows, "sha", repeated_bits(rows, bits), bits, "possible", hashes=1).where("possible").select("doc_id", "sha")
    ids = possible.select(F.col("doc_id").alias("sha"))
    whole = docs.select(F.struct(*docs.columns).alias("__loom_row"), F.col(id_col).cast("long").alias("__loom_id"))  # no column of docs meets one used here
    asked = mark_possible(whole, "__loom_id", set_bits(ids, bits), bits, "__loom_possible")
    lone = asked.where(~F.col("__loom_possible")).select("__loom_row.*")
    some = asked.where("__loom_possible").withColumn("__loom_sha", digest(F.col("__loom_row").getField(text_col))).withColumn("__loom_salt", salt(docs.sparkSession, "__loom_id"))
    groups = spread_groups(possible, ["sha"], "doc_id").where("group_rows > 1").select(
        F.col("sha").alias("__loom_sha"), F.col("salt").alias("__loom_salt"), F.col("group_min").alias("__loom_min"), F.lit(True).alias("__loom_group")
    )
    met = beside(some, groups, ["__loom_sha", "__loom_salt"], "left")
    alone = met.where("__loom_group is null").select("__loom_row.*")
    first = met.where(F.col("__loom_group") & F.col("__loom_id").eqNullSafe(F.col("__loom_min")))
    return lone.unionByName(alone).unionByName(first.dropDuplicates(["__loom_sha"]).select("__loom_row.*"))


ORACLE_SQL = r"""
WITH n AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
), g AS (
  SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY text_sha256
)
SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id = g.keep_id AS kept, n.text_sha256
FROM n JOIN g USING (text_sha256)
"""
