"""Column expressions for normalising and reading text.

The normalisers differ on purpose and are not interchangeable.  Patterns stay
within what Java's and RE2's regular expressions both read the same way.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LINK = r"\[\[([^\]|]*)\|?([^\]|]*)\]\]"


def display_text(c: Column) -> Column:
    """Link markup replaced by its label, or by its target where there is no label."""
    unlinked = F.regexp_replace(F.regexp_replace(c, r"\[\[[^\]|]*\|([^\]|]+)\]\]", "$1"), r"\[\[([^\]|]*)\|?\]\]", "$1")
    return F.trim(F.when(F.contains(c, F.lit("[[")), unlinked).otherwise(c))


def _with(c: Column, sign: str, read: Column) -> Column:
    """What is read from a text that holds the sign, an empty list from any other; null from null."""
    return F.when(~F.contains(c, F.lit(sign)), F.expr("cast(array() as array<string>)")).otherwise(read)


def without_links(c: Column) -> Column:
    return F.when(F.contains(c, F.lit("[[")), F.regexp_replace(c, r"\[\[[^\]]*\]\]", " ")).otherwise(c)


def link_targets(c: Column) -> Column:
    """Distinct targets in order; anchors cut, underscores read as spaces."""
    return _with(c, "[[", F.array_distinct(F.transform(F.regexp_extract_all(c, F.lit(LINK), F.lit(1)), lambda t: F.trim(F.translate(F.regexp_replace(t, "#.*$", ""), "_", " ")))))


def urls(c: Column) -> Column:
    return _with(c, "://", F.transform(F.regexp_extract_all(c, F.lit(r"(https?://[^\s\"<>\]]+)"), F.lit(1)), lambda u: F.regexp_replace(u, "[.,;:)]+$", "")))


def number_tuples(c: Column) -> Column:
    """Every (1,2,...) as a string of its numbers."""
    return _with(c, "(", F.regexp_extract_all(c, F.lit(r"\(([0-9]+(?:\s*,\s*[0-9]+)*)\)"), F.lit(1)))


def number_lists(c: Column) -> Column:
    """Every (1,2,...) as an array of its numbers."""
    return F.transform(number_tuples(c), lambda t: F.transform(F.split(t, r"\s*,\s*"), lambda n: n.cast("int")))


def bracket_tags(c: Column) -> Column:
    return _with(c, "[", F.regexp_extract_all(without_links(c), F.lit(r"\[([^\]\[]+)\]"), F.lit(1)))


def slug(c: Column) -> Column:
    s = F.regexp_replace(F.lower(display_text(c)), "[^a-z0-9]+", "-")
    return F.coalesce(F.nullif(F.regexp_replace(s, "^-+|-+$", ""), F.lit("")), F.lit("section"))


def collapsed(c: Column) -> Column:
    """Lower case, white space collapsed and trimmed."""
    return F.lower(F.trim(F.regexp_replace(c, r"[^\S ]\s*| \s+", " ")))  # a lone space stays as it is


def id_text(c: Column) -> Column:
    return collapsed(display_text(c))


def place_key(c: Column) -> Column:
    """Lower case without parentheses, punctuation and articles."""
    s = F.regexp_replace(F.lower(c), r"\([^)]*\)", " ")
    s = F.regexp_replace(F.regexp_replace(s, "[^a-z0-9 ]", " "), r"\b(the|a|an)\b", " ")
    return F.trim(F.regexp_replace(s, r"\s+", " "))


def squash(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), "[^a-z0-9]", "")


def spoken_key(c: Column) -> Column:
    return collapsed(F.translate(c, "'’", ""))


def word_text(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), r"[^a-z0-9\s]", "")


def cache_name(c: Column) -> Column:
    """File-safe name with a hash of the original, so that case still tells names apart."""
    return F.concat(F.substring(F.regexp_replace(c, "[^A-Za-z0-9_.-]", "_"), 1, 100), F.lit("-"), short_hash(c, 8))


def short_hash(c: Column, n: int = 10) -> Column:
    return F.substring(F.sha1(c.cast("binary")), 1, n)


def plain_markup(c: Column) -> Column:
    """Tags and templates dropped, entities left, white space collapsed."""
    s = F.regexp_replace(F.regexp_replace(c, "<[^>]*>", " "), r"\{\{[^}]*\}\}", " ")
    return F.trim(F.regexp_replace(s, r"\s+", " "))


def singular(c: Column) -> Column:
    return (
        F.when(F.length(c) < 4, c)
        .when(c.endswith("ies"), F.concat(F.regexp_replace(c, "ies$", ""), F.lit("y")))
        .when(c.endswith("ss"), c)
        .when(c.endswith("s"), F.regexp_replace(c, "s$", ""))
        .otherwise(c)
    )


def sentence_case(c: Column) -> Column:
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.regexp_replace(c, "^.", "")))


def title_variants(c: Column) -> Column:
    """Name, singular, then both in sentence case; distinct, in that order."""
    return F.array_distinct(F.array(c, singular(c), sentence_case(c), sentence_case(singular(c))))
