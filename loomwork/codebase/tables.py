"""Tables that are written as text: templates of a page, transport files, task files, shops, places."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import place_key

SIGN = re.compile(r"\{\{|\}\}|\[\[|\]\]|\|")
SPOT, AMOUNT, FIELD = re.compile(r"^x\s*:\s*(\d+)\s*,\s*y\s*:\s*(\d+)(.*)$|^(\d+)\s*,\s*(\d+)(.*)$"), re.compile(r"qty\s*:\s*(\d+)"), re.compile(r"^\s*([A-Za-z]\w*)\s*=(.*)$", re.S)
PLANES = range(4)


def templates(text: str, name: str) -> list[list[str]]:
    """The parameters of every template of this name, whole however deep templates and links stand in them; one that is never closed is none."""
    out, stack = [], []  # of (start, cuts) by open sign
    for m in SIGN.finditer(text):
        sign, at = m[0], m.start()
        if sign in ("{{", "[["):
            stack.append((sign, at, [at + 1]))
        elif sign == "|":
            if stack:
                stack[-1][2].append(at)
        else:
            want = "{{" if sign == "}}" else "[["
            if not any(s == want for s, _, _ in stack):
                continue
            while stack[-1][0] != want:
                stack.pop()
            _, start, cuts = stack.pop()
            if sign == "}}":
                parts = [text[a + 1 : b] for a, b in zip(cuts, [*cuts[1:], at], strict=True)]
                if parts[0].strip().lower() == name.lower():
                    out.append((start, parts[1:]))
    return [p for _, p in sorted(out)]


def plain(markup: str) -> str:
    """Words that a person reads: no templates, links as their labels, no quotes for weight, no empty brackets."""
    words, link, depth, last = [], None, 0, 0
    for m in [*SIGN.finditer(markup), None]:
        piece, sign = markup[last : m.start() if m else None], m[0] if m else ""
        last = m.end() if m else last
        if depth == 0:
            (words if link is None else link).append(piece)
        if sign in ("{{", "}}"):
            depth = max(0, depth + (1 if sign == "{{" else -1))
        elif sign == "[[" and depth == 0:
            link = []
        elif sign == "|" and depth == 0:
            words += [sign] if link is None else []
            link = link if link is None else []  # a label follows
        elif sign == "]]" and link is not None:
            words, link = words + link, None
    text = " ".join("".join(words + (link or [])).replace("'''", "").replace("''", "").split())
    return " ".join(text.replace("( )", "").replace("()", "").split()).strip(" -–")


def spawn(parts: list[str]) -> dict | None:
    """name, place, members, points, counts of one line; null without a name or a point.  A range counts as its low end, a plane that is none as 0."""
    fields, points, counts = {}, [], []
    for part in parts:
        if m := SPOT.match(part.strip()):
            points.append([int(m[1] or m[4]), int(m[2] or m[5])])
            amount = AMOUNT.search(m[3] or m[6] or "")
            counts.append(int(amount[1]) if amount else 1)
        elif m := FIELD.match(part):
            fields[m[1].lower()] = m[2].strip()
    name = plain(fields.get("name", ""))
    if not name or not points:
        return None
    plane = int(fields["plane"]) if fields.get("plane", "").isdigit() and int(fields["plane"]) in PLANES else 0
    return {"name": name, "place": plain(fields.get("location", "")), "members": fields.get("members", "").lower().startswith("y"), "points": [[*p, plane] for p in points], "counts": counts}


def spawns(pages: DataFrame, key: str, text: str, template: str = "ItemSpawnLine") -> DataFrame:
    """key, nth, name, place, members, points, counts of every line of a page."""

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for k, t in zip(frame[key], frame[text], strict=True):
                for n, parts in enumerate(templates(t or "", template)):
                    if (s := spawn(parts)) is not None:
                        rows.append((k, n, s["name"], s["place"], s["members"], s["points"], s["counts"]))
            yield pd.DataFrame(rows, columns=[key, "nth", "name", "place", "members", "points", "counts"], dtype=object)

    return pages.select(key, text).mapInPandas(read, f"{key} {dict(pages.dtypes)[key]}, nth int, name string, place string, members boolean, points array<array<int>>, counts array<int>")


def scattered_items(lines: DataFrame, most: int = 8) -> DataFrame:
    """name, n_points of the items that lie in most places."""
    return lines.groupBy("name").agg(F.sum(F.size("points")).alias("n_points")).orderBy(F.desc("n_points"), "name").limit(most)


def stock(pages: DataFrame, key: str, sold: str, owners: str) -> DataFrame:
    """key, item, owner: everything sold on a page by everyone who owns it, each once.

    Lists lose their repeats before they meet, so a page of one row gives every
    pair once; only pairs of pages with several rows are told apart afterwards.
    """
    lists = F.struct(F.array_distinct(sold).alias("sold"), F.array_distinct(owners).alias("owners"))
    rows = pages.groupBy(key).agg(F.collect_list(lists).alias("__rows"))
    met = lambda r: r.select(key, F.explode("__l.sold").alias("item"), "__l").select(key, "item", F.explode("__l.owners").alias("owner"))
    one = rows.where(F.size("__rows") == 1).select(key, F.col("__rows")[0].alias("__l"))
    more = rows.where(F.size("__rows") > 1).select(key, F.explode("__rows").alias("__l"))
    return met(one).unionByName(met(more).distinct())


def _point(cell: Column) -> Column:
    pattern = r"^\s*(-?[0-9]+)\s+(-?[0-9]+)\s+([0-9]+)\s*$"
    return F.when(cell.rlike(pattern), F.array(*[F.regexp_extract(cell, pattern, k).cast("int") for k in (1, 2, 3)]))


def transports(rows: DataFrame) -> DataFrame:
    """rows plus role (route, hub, arrival or dropped), origin, destination, id, action, quests, from the cells of a transport table.

    Somewhere to arrive without somewhere to start is an arrival; a start needs
    an object, and with no end it is a hub.
    """
    cell = lambda k: F.trim(F.coalesce(F.get("cells", F.lit(k)), F.lit("")))
    words = F.split(cell(2), r"\s+")
    number = F.when(F.element_at(words, -1).rlike("^[0-9]+$") & (F.size(words) > 1), F.element_at(words, -1).cast("int"))
    done = rows.withColumns({
        "origin": _point(cell(0)), "destination": _point(cell(1)), "id": number,
        "action": F.when(number.isNotNull(), F.array_join(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(1))), " ")).otherwise(cell(2)), "quests": cell(5),
    })
    role = F.when(F.size("cells") < 3, "dropped").when(F.col("origin").isNull() & F.col("destination").isNotNull(), "arrival").when(F.col("origin").isNull() | F.col("id").isNull(), "dropped")
    return done.withColumn("role", role.when(F.col("destination").isNull(), "hub").otherwise("route"))


def diary_tasks(bits: DataFrame, panels: DataFrame, conditions: DataFrame) -> DataFrame:
    """file, requirement, variable, bit, title: every bit, with the title of the panel that its condition hides, or none.

    bits: file, requirement, variable, bit; panels: file, panel, title;
    conditions: file, panel, requirement.
    """
    shown = conditions.join(panels, ["file", "panel"]).groupBy("file", "requirement").agg(F.min("title").alias("title"))
    return bits.join(shown, ["file", "requirement"], "left").select("file", "requirement", "variable", "bit", "title")


def scenery(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """quest, id, point: each object of a quest once, where its constant is known."""
    return rows.join(ids, "constant").select("quest", "id", "point").distinct()


def locations(rows: DataFrame, name: str, point: str) -> tuple[DataFrame, DataFrame]:
    """The rows with their `key`, and the names under every key that has several points."""
    keyed = rows.withColumn("key", place_key(F.col(name)))
    doubt = keyed.groupBy("key").agg(F.countDistinct(point).alias("n_points"), F.sort_array(F.collect_set(name)).alias("names")).where("n_points > 1")
    return keyed, doubt


def tier(text: Column, regions: dict[str, str], tiers: list[str]) -> Column:
    """region and tier: the first listed word of each that the text holds; null unless it has both."""
    low = F.lower(F.regexp_replace(text, r"(?<=.)([A-Z])", " $1"))
    region = F.coalesce(*[F.when(F.contains(low, F.lit(w)), F.lit(r)) for w, r in regions.items()])
    level = F.coalesce(*[F.when(F.contains(low, F.lit(t)), F.lit(t)) for t in tiers])
    return F.when(region.isNotNull() & level.isNotNull(), F.struct(region.alias("region"), level.alias("tier")))


def assembled(steps: DataFrame, progress: DataFrame, items: DataFrame) -> DataFrame:
    """file, n_steps, n_values, last_value, n_items: what was read of every file."""
    s = steps.groupBy("file").agg(F.count(F.lit(1)).alias("n_steps"))
    p = progress.groupBy("file").agg(F.count(F.lit(1)).alias("n_values"), F.max("value").alias("last_value"))
    i = items.groupBy("file").agg(F.count(F.lit(1)).alias("n_items"))
    return s.join(p, "file", "full").join(i, "file", "full").na.fill(0, ["n_steps", "n_values", "n_items"])


def first_blocking(rows: DataFrame, folder: str, order: str, readable: Column, leaf: str) -> DataFrame:
    """folder, n, n_readable, blocked_by: totals of a folder, and the leaf that is the first unreadable one most rows meet."""
    totals = rows.groupBy(folder).agg(F.count(F.lit(1)).alias("n"), F.count_if(readable).alias("n_readable"))
    bad = rows.where(~readable).groupBy(folder, leaf).agg(F.count(F.lit(1)).alias("c"))
    n = F.row_number().over(Window.partitionBy(folder).orderBy(F.desc("c"), leaf))
    first = bad.withColumn("__n", n).where("__n = 1").select(folder, F.col(leaf).alias("blocked_by"))
    return totals.join(first, folder, "left")
