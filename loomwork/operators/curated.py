"""What is wrong with tables that people keep by hand: every named check of them (V7).

Each check gives sheet, severity, key, value, problem: one row for each thing
that a person has to look at.  An error names something that is not there; a
note is sound today but wants a look.  Sheets meet what they name by equality,
so the order of tables and their size do not matter.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import place_key

# The diaries (regions, tiers and one of another name), the skills, and bounds.
REGIONS = ["Ardougne", "Desert", "Falador", "Fremennik", "Kandarin", "Karamja", "Kourend", "Lumbridge", "Draynor", "Morytania", "Varrock", "Western Provinces", "Wilderness"]
TIERS = ["Easy", "Medium", "Hard", "Elite"]
JOINT_DIARY = "Lumbridge & Draynor Easy Diary"
SKILLS = [
    "ATTACK", "DEFENCE", "STRENGTH", "HITPOINTS", "RANGED", "PRAYER", "MAGIC", "COOKING", "WOODCUTTING", "FLETCHING", "FISHING", "FIREMAKING", "CRAFTING", "SMITHING", "MINING", "HERBLORE", "AGILITY", "THIEVING",
    "SLAYER", "FARMING", "RUNECRAFT", "HUNTER", "CONSTRUCTION",
]
LEVELS, BITS = (1, 99), 32
PLACE_KINDS = ["place", "object"]


def _told(rows: DataFrame, sheet: str, key: str, value: str, problems: list[tuple[str, Column, str]]) -> DataFrame:
    """A row for every problem that a row has; problems: severity, where it holds, what it is."""
    each = F.array(*[F.when(F.coalesce(bad, F.lit(False)), F.struct(F.lit(severity).alias("severity"), F.lit(text).alias("problem"))) for severity, bad, text in problems])
    found = rows.select(F.col(key).cast("string").alias("key"), F.col(value).cast("string").alias("value"), F.explode(F.filter(each, lambda p: p.isNotNull())).alias("p"))
    return found.select(F.lit(sheet).alias("sheet"), "p.severity", "key", "value", "p.problem")


def _known(rows: DataFrame, column: str, table: DataFrame | None, name: str, out: str) -> DataFrame:
    """rows with whether the table knows their column; without a table all are known."""
    if table is None:
        return rows.withColumn(out, F.lit(True))
    side = table.select(F.col(name).alias(f"__{out}")).where(F.col(name).isNotNull()).distinct()
    return rows.join(side, rows[column] == side[f"__{out}"], "left").withColumn(out, F.col(f"__{out}").isNotNull()).drop(f"__{out}")


def spells(rows: DataFrame, widgets: DataFrame) -> DataFrame:
    """rows: place, spell; widgets: spell."""
    return _told(_known(rows, "spell", widgets, "spell", "real"), "spells", "place", "spell", [("error", ~F.col("real"), "no such spell")])


def diary_aliases(rows: DataFrame, tags: DataFrame) -> DataFrame:
    """rows: written, diary; tags: tag, those that any step writes."""
    real = F.col("diary").isin(JOINT_DIARY, *[f"{r} {t} Diary" for r in REGIONS for t in TIERS])
    met = _known(rows, "written", tags, "tag", "used")
    return _told(met, "diary aliases", "written", "diary", [("error", ~F.col("used"), "no step writes this"), ("error", F.col("diary").isNull() | ~real, "no such diary")])


def _steps(rows: DataFrame, steps: DataFrame | None) -> tuple[DataFrame, tuple[str, Column, str]]:
    return _known(rows, "step_id", steps, "step_id", "live"), ("error", ~F.col("live"), "no such step")


def skills(rows: DataFrame, steps: DataFrame | None) -> DataFrame:
    """rows: step_id, skill, level; steps: step_id, or none where they are not asked."""
    met, lost = _steps(rows, steps)
    level = F.col("level")
    return _told(met, "skills", "step_id", "skill", [("error", F.col("skill").isNull() | ~F.col("skill").isin(SKILLS), "no such skill"), ("error", level.isNull() | ~level.between(*LEVELS), "level out of range"), lost])


def diary_tasks(rows: DataFrame, varplayers: DataFrame, steps: DataFrame | None) -> DataFrame:
    """rows: step_id, varplayer, bit; varplayers: name; steps: step_id, or none."""
    met, lost = _steps(_known(rows, "varplayer", varplayers, "name", "real"), steps)
    bit = F.col("bit")
    return _told(met, "diary tasks", "step_id", "varplayer", [("error", ~F.col("real"), "no such variable"), ("error", bit.isNull() | ~bit.between(0, BITS - 1), "bit out of range"), lost])


def places(rows: DataFrame, locations: DataFrame, entities: DataFrame) -> DataFrame:
    """rows: written, place; locations: name; entities: name, kind, points."""
    met = _known(rows.withColumn("__norm", place_key(F.col("place"))), "__norm", locations.select(place_key(F.col("name")).alias("name")), "name", "located")
    found = entities.where(F.col("kind").isin(PLACE_KINDS) & (F.size("points") > 0))
    return _told(_known(met, "place", found, "name", "placed"), "places", "written", "place", [("error", ~F.col("located") & ~F.col("placed"), "leads to no place")])


def entity_aliases(rows: DataFrame, entities: DataFrame) -> DataFrame:
    """rows: phrase, names; entities: name, ids."""
    e = entities.select("name", (F.coalesce(F.size("ids"), F.lit(0)) > 0).alias("has_ids")).groupBy("name").agg(F.max("has_ids").alias("has_ids"))
    each = rows.select("phrase", F.explode_outer("names").alias("name")).join(e, "name", "left")
    named = F.col("name").isNotNull()
    return _told(each, "entity aliases", "phrase", "name", [("error", ~named, "names nothing"), ("error", named & F.col("has_ids").isNull(), "no such entity"), ("error", ~F.col("has_ids"), "entity without ids")])


def crossings(rows: DataFrame, routes: DataFrame, entities: DataFrame, aliases: DataFrame, journeys: DataFrame) -> DataFrame:
    """rows: place, kind; routes: label (places, comma between them), kind; entities: name, points; aliases: written, name; journeys: place, boards.

    journeys are what the travel rules make of going to each place, boards
    where a journey begins (null: nowhere); a place without any has no row.
    """
    ends = routes.select(F.explode(F.split("label", ",")).alias("place"), F.col("kind").alias("offered")).select(F.trim("place").alias("place"), "offered")
    offered = ends.groupBy("place").agg(F.sort_array(F.collect_set("offered")).alias("offers"))
    met = rows.join(offered, "place", "left")
    placed = entities.where(F.size("points") > 0)
    to = aliases.groupBy(F.col("written").alias("place")).agg(F.min("name").alias("__alias"))
    met = _known(_known(met.join(to, "place", "left"), "__alias", placed, "name", "by_alias"), "place", placed, "name", "by_name")
    met = met.join(journeys.groupBy("place").agg(F.lit(True).alias("goes"), F.min("boards").alias("boards")), "place", "left")
    known, right = F.col("offers").isNotNull(), F.coalesce(F.array_contains("offers", F.col("kind")), F.lit(False))
    goes = F.coalesce("goes", F.lit(False))
    boards = F.col("boards").isNotNull()
    return _told(met, "crossings", "place", "kind", [
        ("error", ~known, "end of no route"), ("error", known & ~right, "no route of this kind"), ("note", right & ~goes & ~F.col("by_alias") & ~F.col("by_name"), "no step names it yet"),
        ("error", right & ~goes & (F.col("by_alias") | F.col("by_name")), "leads nowhere"), ("error", right & goes & ~boards, "boards nowhere"), ("note", right & goes & boards & (F.size("offers") > 1), "another kind goes there too"),
    ])


def all_of(*problems: DataFrame) -> DataFrame:
    """The findings of several sheets together."""
    return reduce(DataFrame.unionByName, problems)
