"""Finding and cutting at listed words and phrases, without regard to case.

A phrase is written as it reads; any white space fits between its words, and
it begins and ends at the edge of a word.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Words = Sequence[str]


def either(phrases: Words) -> str:
    """One pattern for all phrases; of several that fit at a place the longest."""
    longest = sorted(phrases, key=lambda p: -len(p))
    return "(?:" + "|".join(r"\s+".join(re.escape(w).replace("'", "['’]").replace(r"\-", "-") for w in p.split()) for p in longest) + ")"


def starts(phrases: Words) -> str:
    """Looks ahead for letters that phrases begin with, two if all have them: far cheaper to refuse a place by than all phrases."""
    heads = [p.split()[0] for p in phrases]
    letters = ["".join(sorted({h[k] for h in heads})) for k in range(min(2, *map(len, heads)))]
    return "(?=" + "".join(f"[{re.escape(x).replace("'", "'’")}]" for x in letters) + ")"


def anywhere(phrases: Words) -> str:
    """One pattern for any of the phrases as whole words."""
    return rf"(?i){starts(phrases)}\b{either(phrases)}\b"


def in_turn(*groups: Words) -> str:
    """One phrase of every group after the other; an empty one makes its group optional."""
    return "".join(rf"(?:{either([p for p in g if p])}\s+)" + ("?" if "" in g else "") for g in groups)


def says(c: Column, phrases: Words) -> Column:
    return c.rlike(anywhere(phrases))


def opens(c: Column, phrases: Words) -> Column:
    return c.rlike(rf"(?i)^\s*{either(phrases)}\b")


def behind(c: Column, phrases: Words) -> Column:
    """The text behind the first of the phrases; null without one."""
    parts = F.split(c, anywhere(phrases), 2)
    return F.ltrim(F.get(parts, 1))


def behind_opening(c: Column, phrases: Words) -> Column:
    """The text behind the phrase that opens it; null where none does."""
    return F.when(opens(c, phrases), F.ltrim(F.regexp_replace(c, rf"(?i)^\s*{either(phrases)}\b", "")))


def before(c: Column, phrases: Words) -> Column:
    """The text up to the first of the phrases, or all of it."""
    return F.split(c, anywhere(phrases), 2)[0]


def without_opening(c: Column, phrases: Words) -> Column:
    return F.coalesce(behind_opening(c, phrases), c)


def first_sentence(c: Column) -> Column:
    return F.substring_index(c, ".", 1)


def words(c: Column) -> Column:
    """Lower-case words in order."""
    return F.regexp_extract_all(F.lower(c), F.lit(r"([a-z']+)"), F.lit(1))


def first_word(c: Column) -> Column:
    return F.lower(F.regexp_extract(c, r"^\s*([A-Za-z'-]+)", 1))


def mentions(c: Column, phrases: Words) -> Column:
    """How often any of the phrases, of one or two words, is said."""
    w = words(c)
    pairs = F.zip_with(w, F.slice(w, 2, F.greatest(F.size(w) - 1, F.lit(0))), lambda a, b: F.concat_ws(" ", a, b))
    listed = F.array(*[F.lit(p) for p in phrases])
    return F.size(F.filter(F.concat(w, pairs), lambda x: F.array_contains(listed, x)))


def found(c: Column) -> Column:
    """Trimmed; null instead of empty."""
    return F.nullif(F.trim(c), F.lit(""))
