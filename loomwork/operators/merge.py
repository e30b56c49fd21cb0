"""What a step's words stand for: targets, goods, tags, tasks, and the rules by which one source gives way to another.

Entities are rows (name, kind, ids, points, page, via_redirect) with a unique
name.  Every lookup is a join on equality after the dimension has been brought
to one row a key, so no step is multiplied.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.phrases import before, behind, behind_opening, first_word, opens, says, without_opening
from ..functions.sentences import name_run
from ..functions.text import collapsed, display_text, spoken_key, squash
from ..functions.verdicts import casts
from .loose import containing, first_contained

# Fixed values.
BUYS_FROM = ["buy", "buys", "collect", "withdraw", "purchase"]
ASIDES = ["optional", "as mentioned", "if you"]
WHERE_WORDS = [
    "inside", "in", "on", "at", "from", "north", "south", "east", "west", "next", "by", "near", "under", "behind", "outside", "off", "before", "after", "while", "for", "with", "to", "and",
    "if", "when", "upstairs", "downstairs", "beside", "across",
]
SHORTEST_SQUASH = 10
USES = ["use", "put", "give", "show", "hand", "place", "insert", "offer", "feed", "pour", "sprinkle", "add", "plant"]
USE_ENDS = ["on", "in", "into", "to", "back", "onto", "over", "at", "with", "inside", "under"]
NOT_AN_ITEM = ["it", "them", "this", "that", "one", "these", "those", "him", "her", "everything", "all", "both"]
NO_INTERACTION = ["to kill", "for golems", "per inv", "to enter"]
OPERAND_ENDS = ["and", "then", "to", "for", "at", "from", "in"]
PLACE_OPENS = ["in", "at", "on", "under", "north", "south", "east", "west", "to start"]
NO_IDS = "cast(array() as array<bigint>)"
NO_POINTS = "cast(array() as array<array<int>>)"


# --- targets ---------------------------------------------------------------


def atlas_points(rows: DataFrame, key: str, kind: str, ids: str, atlas: DataFrame) -> DataFrame:
    """key, points, ambiguous: all places of all ids of a row, each once, and whether any of them is in doubt."""
    each = rows.select(key, F.col(kind).alias("kind"), F.posexplode(ids).alias("at", "id")).join(atlas.select("kind", "id", "points", "ambiguous"), ["kind", "id"])
    parts = F.transform(F.sort_array(F.collect_list(F.struct("at", "points"))), lambda s: s["points"])
    return each.groupBy(key).agg(F.array_distinct(F.flatten(parts)).alias("points"), F.bool_or("ambiguous").alias("ambiguous"))


def named_seller(raw: Column) -> Column:
    """Whom a purchase is made from: the capitalised name behind "from" in the same clause; an aside has none."""
    clause = F.split(behind(display_text(raw), BUYS_FROM), r"[.\[\]()]", 2)[0]
    return F.when(~opens(raw, ASIDES), name_run(behind(clause, ["from"])))


def targets(steps: DataFrame, entities: DataFrame, atlas: DataFrame, phrases: DataFrame) -> DataFrame:
    """step, name, kind, ids, points, point_source, confidence: one row for every step with a target.

    steps: step, raw, target_name, links, intent; phrases: phrase, pos, names.
    The first of the target's name and the links that is an entity; else the
    entities that the first phrase in the text stands for; else the bare name,
    unless the step is about a quest.  Where the target is no person, the
    person that goods are bought from replaces it.
    """
    e = entities.select(F.col("name").alias("named"), "kind", "ids", "points", "via_redirect")
    wanted = F.filter(F.concat(F.array("target_name"), F.coalesce("links", F.expr("cast(array() as array<string>)"))), lambda n: n.isNotNull())
    tried = steps.select("step", "links", F.posexplode(wanted).alias("at", "named")).join(e, "named")
    linked = F.coalesce(F.array_contains("links", F.col("named")), F.lit(False))
    sure = F.when(linked, "linked").when(F.col("via_redirect"), "wiki-redirect").otherwise("wiki-exact")
    first = tried.groupBy("step").agg(F.min_by(F.struct(F.col("named").alias("name"), "kind", "ids", "points", sure.alias("confidence")), "at").alias("t")).select("step", "t.*")
    gap = first.where("size(points) = 0 and size(ids) > 0")
    filled = atlas_points(gap, "step", "kind", "ids", atlas).select("step", F.col("points").alias("atlas"))
    own = first.join(filled, "step", "left").select(
        "step", "name", "kind", "ids", F.when(F.size("points") > 0, F.col("points")).otherwise(F.coalesce("atlas", F.expr(NO_POINTS))).alias("points"),
        F.when(F.size("points") > 0, "wiki").when(F.size("atlas") > 0, "atlas").alias("point_source"), "confidence",
    )

    rest = steps.join(own.select("step"), "step", "left_anti")
    hit = first_contained(rest, "step", "raw", phrases, "phrase", ["pos"])
    each = hit.select("step", F.posexplode("names").alias("at", "named"), F.size("names").alias("n")).join(e, "named")
    by_place = lambda c: F.transform(F.sort_array(F.collect_list(F.struct("at", c))), lambda s: s[c])
    manual = each.groupBy("step", "n").agg(F.array_join(by_place("named"), "/").alias("name"), F.min_by("kind", "at").alias("kind"), F.array_distinct(F.flatten(by_place("ids"))).alias("ids"), F.min_by("points", "at").alias("pts"))
    manual = manual.select("step", "name", "kind", "ids", F.when(F.col("n") == 1, F.col("pts")).otherwise(F.expr(NO_POINTS)).alias("points"), F.lit(None).cast("string").alias("point_source"), F.lit("manual").alias("confidence"))
    bare = rest.join(manual.select("step"), "step", "left_anti").where("target_name is not null and coalesce(intent, '') <> 'quest'")
    inferred = bare.select("step", F.col("target_name").alias("name"), F.col("intent").alias("kind"), F.expr(NO_IDS).alias("ids"), F.expr(NO_POINTS).alias("points"), F.lit(None).cast("string").alias("point_source"), F.lit("inferred").alias("confidence"))
    found = own.unionByName(manual).unionByName(inferred)

    people = e.where("kind = 'npc' and size(ids) > 0").select(F.col("named").alias("seller"), F.col("ids").alias("s_ids"), F.col("points").alias("s_points"))
    sold = steps.select("step", named_seller(F.col("raw")).alias("seller")).join(people, "seller")
    met = found.join(sold, "step", "full")
    swap = F.col("seller").isNotNull() & ~F.coalesce(F.col("kind") == "npc", F.lit(False))
    pick = lambda new, old: F.when(swap, new).otherwise(F.col(old)).alias(old)
    return met.select("step", pick(F.col("seller"), "name"), pick(F.lit("npc"), "kind"), pick(F.col("s_ids"), "ids"), pick(F.col("s_points"), "points"), pick(F.lit(None), "point_source"), pick(F.lit("wiki-exact"), "confidence"))


def own_title(said: Column, target: Column, quest: Column) -> Column:
    """Whether the target is only a word of the quest that the step completes, starts or continues."""
    verb = first_word(F.regexp_replace(said, "^[^A-Za-z]+", "")).isin("complete", "finish", "continue", "start")
    return verb & (squash(target) != "") & F.contains(squash(quest), squash(target))


# --- rows by key -----------------------------------------------------------


def attached(steps: DataFrame, key: str | list[str], *tables: DataFrame) -> DataFrame:
    """Steps with the columns of every table's row of the same key; a key that a table has twice is an error."""
    keys = [key] if isinstance(key, str) else key
    for t in tables:
        twice = t.groupBy(*keys).count().where("count > 1").limit(1).collect()
        if twice:
            raise ValueError(f"several rows for {twice[0].asDict()}")
        steps = steps.join(t, keys, "left")
    return steps


def collection_ids(collections: DataFrame, available: DataFrame, entities: DataFrame) -> DataFrame:
    """collection, ids: the ids of all names that a collection lists, in order; null if any name is unknown.

    collections: collection, names; available: name, ids, which goes before entities.
    """
    known = available.select("name", F.col("ids").alias("a_ids"))
    e = entities.where("size(ids) > 0").select("name", F.col("ids").alias("e_ids"))
    each = collections.select("collection", F.posexplode("names").alias("at", "name")).join(known, "name", "left").join(e, "name", "left").withColumn("ids", F.coalesce("a_ids", "e_ids"))
    ids = F.array_distinct(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("at", "ids"))), lambda s: s["ids"])))
    return each.groupBy("collection").agg(F.when(F.bool_and(F.col("ids").isNotNull()), ids).alias("ids"))


def without_where(name: Column) -> Column:
    """The name up to the first word that says where it is."""
    return F.regexp_replace(F.split(name, rf"(?i)\s+\b(?:{'|'.join(WHERE_WORDS)})\b", 2)[0], r"^[ ,.&]+|[ ,.&]+$", "")


def item_ids(mentions: DataFrame, key: str, name: str, collections: DataFrame, entities: DataFrame) -> DataFrame:
    """key, name, ids, source: a listed collection, the stem behind "Empty", the item itself, the item without its place, or none.

    collections: collection, ids.  Null ids of a collection are as none.
    """
    c = collections.where("size(ids) > 0").select(F.col("collection").alias("__key"), F.col("ids").alias("__ids"))
    e = entities.where("kind = 'item' and size(ids) > 0").select(F.col("name").alias("__key"), F.col("ids").alias("__ids"))
    short = without_where(F.col(name))
    tail = F.trim(F.element_at(F.split(short, ": "), -1))
    stem = F.when(F.col(name).rlike(r"(?i)^empty\s+"), F.regexp_replace(name, r"(?i)^empty\s+", ""))
    capital = F.concat(F.upper(F.substring(stem, 1, 1)), F.lower(F.substr(stem, F.lit(2))))
    shorter = F.when((short != "") & (short != F.col(name)), short)
    tails = F.when((short != "") & (short != F.col(name)), tail)
    tries = [("collection", c, F.col(name)), ("stem", e, stem), ("stem", e, capital), ("item", e, F.col(name)), ("shortened", e, shorter), ("shortened", c, shorter), ("shortened", e, tails), ("shortened", c, tails)]
    rows = mentions
    for n, (_, dim, by) in enumerate(tries):
        side = dim.select(F.col("__key").alias(f"__k{n}"), F.col("__ids").alias(f"__i{n}"))
        rows = rows.withColumn("__by", by)
        rows = rows.join(side, F.col("__by") == F.col(f"__k{n}"), "left").drop("__by", f"__k{n}")
    source = F.coalesce(*[F.when(F.col(f"__i{n}").isNotNull(), F.lit(s)) for n, (s, _, _) in enumerate(tries)], F.lit("unresolved"))
    ids = F.coalesce(*[F.col(f"__i{n}") for n in range(len(tries))], F.expr(NO_IDS))
    return rows.select(key, name, ids.alias("ids"), source.alias("source"))


# --- tags, quests, spells --------------------------------------------------


def tagged(tags: DataFrame, key: str, tag: str, quests: DataFrame, aliases: DataFrame, diaries: DataFrame) -> DataFrame:
    """key, tag, quest, via: an alias first, then the same name, then the same letters of a long name, then a diary, corrected.

    quests: quest; aliases: written, quest; diaries: written, real.
    """
    low = lambda c: F.lower(F.trim(F.regexp_replace(c, r"\s+", " ")))
    q = quests.select(low(F.col("quest")).alias("__q"), F.col("quest").alias("__quest")).dropDuplicates(["__q"])
    letters = quests.where(F.length(squash(F.col("quest"))) >= SHORTEST_SQUASH).groupBy(squash(F.col("quest")).alias("__s")).agg(F.min("quest").alias("__same"))
    a = aliases.select(low(F.col("written")).alias("__w"), low(F.col("quest")).alias("__aq"))
    d = diaries.select(F.col("written").alias("__d"), F.col("real").alias("__real"))
    rows = tags.withColumn("__t", low(F.col(tag))).join(a, F.col("__t") == F.col("__w"), "left").withColumn("__by", F.coalesce("__aq", "__t"))
    rows = rows.join(q, F.col("__by") == F.col("__q"), "left").withColumn("__letters", F.when(F.col("__quest").isNull(), squash(F.col(tag))))
    rows = rows.join(letters, F.col("__letters") == F.col("__s"), "left").join(d, F.col(tag) == F.col("__d"), "left")
    diary = F.contains(F.lower(tag), F.lit("diary"))
    quest = F.coalesce("__quest", "__same")
    via = F.when(F.col("__aq").isNotNull() & quest.isNotNull(), "alias").when(F.col("__quest").isNotNull(), "exact").when(F.col("__same").isNotNull(), "letters").when(diary, "diary").otherwise("unresolved")
    shown = F.when(quest.isNull() & diary, F.coalesce("__real", tag)).otherwise(F.col(tag))
    return rows.select(key, shown.alias("tag"), quest.alias("quest"), via.alias("via"))


def quest_in_prose(rows: DataFrame, key: str, text: str, quests: DataFrame, aliases: DataFrame) -> DataFrame:
    """key, quest, written: the longest quest name in the text, or whose letters, ten at least, are in its letters; else the longest alias that ends a word."""
    names = quests.select("quest", F.col("quest").alias("written"), F.lit(0).alias("__turn"))
    plain = names.withColumn("__needle", F.lower("quest")).withColumn("__spelt", F.lit(0))
    flat = names.withColumn("__needle", squash(F.col("quest"))).where(F.length("__needle") >= SHORTEST_SQUASH).withColumn("__spelt", F.lit(1))
    a = aliases.select("quest", "written", F.lit(1).alias("__turn"), F.lower("written").alias("__needle"), F.lit(0).alias("__spelt"))
    low, squashed = rows.select(key, F.lower(text).alias("__text")), rows.select(key, squash(F.col(text)).alias("__text"))
    # Only what was found goes on, never the texts: names and aliases of a row are put in order together.
    met = [containing(low, "__text", plain, "__needle"), containing(squashed, "__text", flat, "__needle"), containing(low, "__text", a, "__needle", word_ends=True)]
    one, two, three = (m.select(key, "quest", "written", "__turn", "__spelt") for m in met)
    order = F.struct("__turn", -F.length("written"), "written", "__spelt", "quest")
    best = one.unionByName(two).unionByName(three).groupBy(key).agg(F.min_by(F.struct("quest", "written"), order).alias("__best"))
    return best.select(key, "__best.quest", "__best.written")


def spells(steps: DataFrame, place: str, raw: str, by_place: DataFrame, widgets: DataFrame) -> DataFrame:
    """Adds `spell` and `widget`: the home teleport by its words, else the spell of the destination where the step casts one."""
    s = by_place.select(F.col("place").alias("__p"), F.col("spell").alias("__s"))
    home = opens(F.col(raw), ["home teleport"])
    named = F.when(home, "TELEPORT_HOME_STANDARD").when(casts(F.col(raw)), F.col("__s"))
    rows = steps.join(s, F.col(place) == F.col("__p"), "left").withColumn("__spell", named)
    w = widgets.select(F.col("spell").alias("__w"), "widget")
    return rows.join(w, F.col("__spell") == F.col("__w"), "left").withColumn("spell", F.col("__w")).drop("__p", "__s", "__spell", "__w")


def uncounted(c: Column) -> Column:
    """The text behind a leading number."""
    return F.regexp_replace(c, r"(?i)^[0-9]+ *x? +", "")


# --- inventory -------------------------------------------------------------


def exact_items(entities: DataFrame) -> DataFrame:
    """item_key, ids: names of items, by letters and spaces alone, that stand for one set of ids."""
    own = entities.where("kind = 'item' and size(ids) > 0").select(collapsed(F.col("name")).alias("item_key"), F.array_sort(F.array_distinct("ids")).alias("ids"))
    return own.groupBy("item_key").agg(F.min("ids").alias("ids"), F.countDistinct("ids").alias("n")).where("n = 1").drop("n")


def recipes(book: DataFrame, items: DataFrame) -> DataFrame:
    """item_key, product_ids, consumed_ids: products with one recipe of which everything is known.

    book: product, names (of all ingredients).
    """
    one = book.withColumn("item_key", collapsed(F.col("product")))
    lone = one.join(one.groupBy("item_key").count().where("count = 1").select("item_key"), "item_key")
    each = lone.select("item_key", F.explode("names").alias("name")).withColumn("need", collapsed(F.col("name"))).join(items.select(F.col("item_key").alias("need"), "ids"), "need", "left")
    all_ids = each.groupBy("item_key").agg(F.bool_and(F.col("ids").isNotNull()).alias("known"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))).alias("consumed_ids"))
    return all_ids.where("known").join(items.select("item_key", F.col("ids").alias("product_ids")), "item_key").drop("known")


def inventory_actions(steps: DataFrame, key: str, raw: str, items: DataFrame, known: DataFrame, verified: DataFrame) -> DataFrame:
    """key, kind (recipe, interact or null), ids, reason: what a step does to things already held, or why that is not sure.

    items: of exact_items; known: of recipes; verified: item_key of every product in the book.
    """
    text = F.trim(display_text(F.col(raw)))
    made = F.regexp_extract(text, r"(?i)^make\s+(?:[0-9]+\s*x?\s+)?(.+?)[.!]?$", 1)
    verb = first_word(text)
    direct = verb.isin("use", "fill", "eat", "drink", "read", "wear", "wield", "equip", "drop", "empty", "light", "open")
    water = (verb == "fill") & says(text, ["of water"])
    other = (verb == "use") & says(text, NO_INTERACTION)
    tail = before(F.split(F.regexp_replace(text, r"^\S+\s*", ""), r"[.;\[(&]", 2)[0], OPERAND_ENDS)
    pair = F.filter(F.array(before(tail, ["on", "with"]), behind(tail, ["on", "with"])), lambda o: o.isNotNull())
    bare = F.transform(F.when(verb == "use", pair).otherwise(F.array(tail)), lambda o: collapsed(uncounted(without_opening(F.trim(o), ["the", "a", "an", "your"]))))
    rows = steps.select(key, F.nullif(collapsed(made), F.lit("")).alias("made"), F.when(direct & ~water & ~other, bare).alias("operands"), F.when(water, "water").when(other, "other").alias("refused"))
    by_item = rows.select(key, F.explode("operands").alias("item_key")).join(items, "item_key", "left").groupBy(key).agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))).alias("ids"), F.array_join(F.array_sort(F.collect_list(F.when(F.col("ids").isNull(), F.col("item_key")))), ", ").alias("missing")
    )
    book = verified.select(F.col("item_key").alias("made"), F.lit(1).alias("in_book")).distinct()
    made_of = known.select(F.col("item_key").alias("made"), "consumed_ids")
    met = rows.join(book, "made", "left").join(made_of, "made", "left").join(by_item, key, "left")
    some = F.size("ids") > 0
    kind = F.when(F.col("made").isNotNull(), F.when(F.col("consumed_ids").isNotNull(), "recipe")).when(some, "interact")
    reason = (
        F.when(F.col("made").isNotNull(), F.when(F.col("in_book").isNull(), "recipe is not verified").when(F.col("consumed_ids").isNull(), "something in the recipe is unknown"))
        .when(F.col("refused").isNotNull(), F.col("refused"))
        .when(F.col("operands").isNotNull() & ~F.coalesce(some, F.lit(False)), "nothing named is an item")
        .when(F.col("missing") != "", F.concat(F.lit("unknown: "), F.col("missing")))
    )
    ids = F.when(kind == "recipe", F.col("consumed_ids")).when(kind == "interact", F.col("ids"))
    return met.select(key, kind.alias("kind"), ids.alias("ids"), reason.alias("reason"))


def used_items(rows: DataFrame, key: str, text: str, items: DataFrame, by_text: DataFrame) -> DataFrame:
    """key, ids: those listed for the very text, else those of the step's own items that its sentence says to use, each by a noun that fits one of them.

    items: key, name, ids; by_text: text, ids.
    """
    listed = rows.join(by_text.select(F.col("text").alias(text), F.col("ids").alias("__listed")), text, "left")
    pieces = F.filter(F.split(F.concat(F.lit(" "), F.lower(text)), rf"[^a-z](?:{'|'.join(USES)})\s+"), lambda p: F.length(p) > 0)
    after = F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0)))
    opened = F.when(first_word(F.col(text)).isin(*USES), pieces).otherwise(after)
    noun = lambda p: squash(F.split(F.regexp_replace(p, r"^(?:the|your|an|a|both|all|[0-9]+x?)\s+", ""), rf"\s+(?:{'|'.join(USE_ENDS)})\b|[.,!]", 2)[0])
    nouns = listed.where("__listed is null").select(key, F.explode(F.array_distinct(F.transform(opened, noun))).alias("noun")).where((F.col("noun") != "") & ~F.col("noun").isin(NOT_AN_ITEM))
    own = items.select(key, squash(F.col("name")).alias("__name"), "ids").where("size(ids) > 0 and __name <> ''")
    fits = nouns.join(own, key).where(F.endswith("__name", F.col("noun")))
    one = fits.groupBy(key, "noun").agg(F.count(F.lit(1)).alias("n"), F.first("ids").alias("ids")).where("n = 1")
    used = one.groupBy(key).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))).alias("__used"))
    return listed.join(used, key, "left").select(key, F.coalesce("__listed", "__used").alias("ids"))


def chosen_sides(tags: DataFrame, notes: DataFrame) -> DataFrame:
    """instruction, note: the only note of an instruction that any tag on its quest names.

    tags: quest, tag; notes: quest, instruction, note.
    """
    said = tags.select("quest", squash(F.col("tag")).alias("side")).distinct()
    met = notes.withColumn("side", squash(F.col("note"))).join(said, ["quest", "side"])
    return met.groupBy("quest", "instruction").agg(F.countDistinct("side").alias("n"), F.min("note").alias("note")).where("n = 1").drop("n")


def noted_substitutes(items: DataFrame, key: str, raw: str, substitutes: DataFrame) -> DataFrame:
    """key, ids: an item's ids, replaced by its substitutes where the author's own bracketed note names one.

    items: key, raw, ids; substitutes: id, notes, other_ids.
    """
    notes = F.transform(F.regexp_extract_all(raw, F.lit(r"\(([^()]+)\)"), F.lit(1)), lambda n: F.lower(F.trim(n)))
    each = items.select(key, notes.alias("__notes"), F.explode("ids").alias("id"))
    s = substitutes.select("id", F.transform("notes", lambda n: F.lower(F.trim(n))).alias("__own"), "other_ids")
    met = each.join(s, "id", "left").withColumn("__use", F.when(F.arrays_overlap("__notes", "__own"), F.col("other_ids")).otherwise(F.array("id")))
    return met.groupBy(key).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("__use")))).alias("ids"))


def referenced(table: DataFrame, key: str, *references: DataFrame) -> DataFrame:
    """The rows of a table that any of the references names; a reference to no row is an error."""
    keys = None
    for r in references:
        one = r.select(F.col(r.columns[0]).alias(key)).where(F.col(key).isNotNull())
        keys = one if keys is None else keys.unionByName(one)
    keys = keys.distinct()
    lost = [r[0] for r in keys.join(table, key, "left_anti").limit(5).collect()]
    if lost:
        raise ValueError(f"unknown {key}: {lost}")
    return table.join(keys, key, "left_semi")


# --- explicit milestones ---------------------------------------------------


def stop_items(phrases: DataFrame, key: str, quest: str, phrase: str, items: DataFrame) -> DataFrame:
    """key, ids (flat, sorted) and n: the goods a phrase stops at, the whole of it as one name first, else all of its parts; null if any part is unknown or in doubt, or two share an id.

    items: quest, name, ids.
    """
    index = items.where("size(ids) > 0").select(F.col(quest), spoken_key(F.col("name")).alias("item_key"), F.array_sort(F.array_distinct("ids")).alias("ids"))
    index = index.groupBy(quest, "item_key").agg(F.min("ids").alias("ids"), F.countDistinct("ids").alias("__n")).where("__n = 1").drop("__n")
    clean = F.regexp_replace(F.trim(F.regexp_replace(phrase, r"\s*\[[^\]]*\]\s*$", "")), r"[.! ]+$", "")
    bare = lambda p: spoken_key(uncounted(without_opening(F.trim(p), ["the", "a", "an"])))
    parts = F.transform(F.concat(F.array(clean), F.split(clean, r"(?i)[,&]|\band\b")), bare)
    each = phrases.select(key, quest, F.posexplode(parts).alias("at", "item_key")).join(index, [quest, "item_key"], "left")
    whole = F.min(F.when(F.col("at") == 0, F.col("ids")))
    flat = F.flatten(F.collect_list(F.when(F.col("at") > 0, F.col("ids"))))
    sure = F.bool_and(F.when(F.col("at") > 0, F.col("ids").isNotNull())) & (F.size(flat) == F.size(F.array_distinct(flat)))
    got = each.groupBy(key).agg(whole.alias("w"), F.when(sure, F.array_sort(flat)).alias("p"), (F.max("at")).alias("parts"))
    return got.select(key, F.coalesce("w", "p").alias("ids"), F.when(F.col("w").isNotNull(), 1).when(F.col("p").isNotNull(), F.col("parts")).alias("n"))


def starters(steps: DataFrame, key: str, quest: str, text: str, ids: str, instructions: DataFrame) -> DataFrame:
    """key, place: the first instruction of the quest's beginning that is the person a step talks to, by id or by the spoken name.

    instructions: quest, place, text, ids.
    """
    said = spoken_key(F.split(before(behind_opening(F.col("i_text"), ["talk to", "speak to"]), PLACE_OPENS), "[.!]", 2)[0])
    i = instructions.select(F.col(quest), "place", F.col("text").alias("i_text"), F.col("ids").alias("i_ids"))
    met = steps.select(key, quest, F.col(text).alias("text"), F.col(ids).alias("own")).join(i, quest)
    spoken = spoken_key(F.split(behind(F.col("text"), ["talking to"]), r"[(\[.!;]", 2)[0])
    hit = F.coalesce(F.arrays_overlap("own", "i_ids"), F.lit(False)) | F.coalesce((spoken != "") & (spoken == said), F.lit(False))
    return met.where(hit).groupBy(key).agg(F.min("place").alias("place"))


def milestones(rows: DataFrame, keys: list[str], order: str, text: str, quest: str, starter_at: str, stop: str, stop_ids: str) -> DataFrame:
    """Adds follow, stop_unresolved, start_only, done_at to the steps of quests.

    starter_at: the progress value that ends the beginning, where the step
    talks to its person; stop: the phrase of "until you get ..."; stop_ids:
    its goods if known.  A stated stop goes before any inferred end; a start
    alone ends at its value only if it is a single act or the next row
    continues it.
    """
    w = Window.partitionBy(*keys).orderBy(order)
    t = F.trim(display_text(F.col(text)))
    has = lambda words: t.rlike(rf"(?i)\b(?:{words})\b")
    bounded = has("until|up to")
    partial = bounded | has("to unlock|to access")
    stopped = F.col(stop).isNotNull()
    act = F.trim(F.regexp_replace(t, r"\([^)]*\)|\[[^\]]*\]", ""))
    says = lambda words: act.rlike(rf"(?i)\b(?:{words})\b")
    goes_on = F.coalesce(F.lead(F.trim(display_text(F.col(text))).rlike(r"(?i)^(?:continue|then|keep)\b")).over(w) & (F.lead(quest).over(w) == F.col(quest)), F.lit(False))
    start = says("start") & ~bounded & ~says("complete|finish|unlock|access|continue|collect|obtain|kill|wear") & (says("talk(?:ing)? to|head to") | goes_on) & F.col(starter_at).isNotNull()
    only = start & ~stopped & F.col(quest).isNotNull()
    follow = t.rlike(r"(?i)^(?:complete|finish|continue)\s+") | ((partial | stopped) & has("start|continue"))
    return rows.withColumns({
        "follow": F.col(quest).isNotNull() & follow,
        "stop_unresolved": F.col(quest).isNotNull() & (partial | stopped) & F.col(stop_ids).isNull(),
        "start_only": only,
        "done_at": F.when(only, F.col(starter_at)),
    })
