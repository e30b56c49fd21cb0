"""Kind, ids and coordinates of a page from its markup, as Column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# What a box's first word says the page is, and which kinds fit an intent.
BOX_KINDS = {
    "npc": "npc", "monster": "npc", "scenery": "object", "item": "item", "location": "place", "shop": "place",
    "activity": "place", "guild": "place", "dungeon": "place", "room": "place",
}
INTENT_KINDS = {
    "npc": ["npc"], "npc-continue": ["npc"], "object": ["object", "place", "npc"], "bank": ["object", "place"],
    "item": ["item", "object"], "withdraw": ["item"], "nav": ["place", "object"], "quest": [],
}
BOX = r"(?i)\{\{\s*Infobox[ _]+([A-Za-z ]+)"
ID_FIELD = r"(?m)^\|\s*id\d*\s*=\s*([0-9][0-9,\s]*?)\s*$"
PLANE = r"(?i)\bplane\s*=\s*(\d+)"
MAP_NAMED = r"(?i)\{\{Map[^}]*?\bx\s*=\s*(\d+)[^}]*?\by\s*=\s*(\d+)"
MAP_PLAIN = r"(?i)\{\{Map\b[^}]*?\|\s*(\d{3,5})\s*,\s*(\d{3,5})\s*[|}]"
MAP_PIN = r"(?i)\{\{Map\b[^}]*\btype\s*=\s*maplink\b[^}]*\}\}"
TABLE_ROW = r"(?i)LocationLine[^}]*?[|]x *= *([0-9]+)[^}]*?[|]y *= *([0-9]+)"
REDIRECT, CHOICES = r"(?i)^\s*#REDIRECT", r"(?i)\{\{\s*(?:disambig|disambiguation)"
MOST_CHOICES = 8


def _pairs(text: Column, pattern: str, plane: Column) -> Column:
    x, y = (F.regexp_extract_all(text, F.lit(pattern), F.lit(k)) for k in (1, 2))
    return F.zip_with(x, y, lambda a, b: F.array(a.cast("int"), b.cast("int"), plane))


def box_name(text: Column) -> Column:
    return F.nullif(F.lower(F.trim(F.regexp_extract(text, BOX, 1))), F.lit(""))


def kind(text: Column) -> Column:
    word = F.regexp_extract(box_name(text), r"^\S+", 0)
    return F.coalesce(*[F.when(word == w, F.lit(k)) for w, k in BOX_KINDS.items()])


def ids(text: Column) -> Column:
    """Distinct numbers of all id fields, in order."""
    parts = F.flatten(F.transform(F.regexp_extract_all(text, F.lit(ID_FIELD), F.lit(1)), lambda f: F.transform(F.split(f, ","), lambda p: F.trim(p))))
    return F.array_distinct(F.transform(F.filter(parts, lambda p: p.rlike("^[0-9]+$")), lambda p: p.cast("long")))


def points(text: Column) -> Column:
    """The page's own maps; without any, pins in the prose; for scenery without either, its table of places."""
    plane = F.coalesce(F.nullif(F.regexp_extract(text, PLANE, 1), F.lit("")).cast("int"), F.lit(0))
    maps: Callable[[Column], Column] = lambda t: F.array_distinct(F.concat(_pairs(t, MAP_NAMED, plane), _pairs(t, MAP_PLAIN, plane)))
    own, every, rows = maps(F.regexp_replace(text, MAP_PIN, "")), maps(text), F.array_distinct(_pairs(text, TABLE_ROW, plane))
    return F.when(F.size(own) > 0, own).when(F.size(every) > 0, every).when(kind(text) == "object", rows).otherwise(every)


def page(text: Column) -> Column:
    """kind, box, ids, points; null for a redirect, an unknown box, or a page with neither id nor point."""
    i, p = ids(text), points(text)
    usable = ~text.rlike(REDIRECT) & kind(text).isNotNull() & ((F.size(i) > 0) | (F.size(p) > 0))
    return F.when(usable, F.struct(kind(text).alias("kind"), box_name(text).alias("box"), i.alias("ids"), p.alias("points")))


def refusal(text: Column) -> Column:
    """Why a page gives nothing: null where it does."""
    return F.when(text.isNull(), "no page").when(page(text).isNotNull(), None).when(text.rlike(CHOICES), "choice needed").otherwise("no usable box")


def choices(text: Column) -> Column:
    """The first pages that a page of choices offers."""
    return F.when(text.rlike(CHOICES), F.slice(F.regexp_extract_all(text, F.lit(r"\[\[([^\]|]+)"), F.lit(1)), 1, MOST_CHOICES))


def overrides(found: Column, intents: Column) -> Column:
    """Whether the page's kind is none that any of the intents accepts; an intent without a rule accepts all."""
    table = F.create_map(*[c for k, v in INTENT_KINDS.items() for c in (F.lit(k), F.array(*map(F.lit, v)).cast("array<string>"))])
    fit = F.flatten(F.transform(intents, lambda i: F.coalesce(F.try_element_at(table, i), F.array(found))))
    return (F.size(fit) > 0) & ~F.array_contains(fit, found)
