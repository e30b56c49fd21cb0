"""What a source declares, as joins and aggregates over its calls and statements.

`rel` is the relation that reader.read_sources gives, keyed by `file`; `ids` is
(constant, id).  A constant is written Class.NAME.  Wherever several answers
exist, the rule that picks one is part of the function's description.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.tables import beside, settled

# Names of the library that the sources are written against.
ITEM, ZONE, PANEL, CONDITIONAL, DETAILED = "ItemRequirement", "Zone", "PanelDetails", "ConditionalStep", "DetailedQuestStep"
POINT_PATTERN = r"^new\s+WorldPoint\(\s*(-?[0-9]+)\s*,\s*(-?[0-9]+)\s*,\s*(-?[0-9]+)\s*\)$"
ID_PATTERN = r"^(?:NpcID|ObjectID|NullObjectID|ItemID)\.\w+$"
LITERAL = r'"((?:\\.|[^"\\])*)"'
LISTS = ["asList", "of", "singletonList"]
REGION_BITS, REGION_SIDE, PACK_BITS = 8, 64, 16
MOST_REACHED = 200
#: Rounds kept apart before they are written together.
MOST_WRITTEN = 16


def calls(rel: DataFrame) -> DataFrame:
    return rel.where("kind = 'call'")


def assigns(rel: DataFrame) -> DataFrame:
    return rel.where("kind = 'statement' and name = 'assign'")


# --- text, numbers, points -------------------------------------------------


def unescaped(c: Column) -> Column:
    c = F.replace(F.replace(c, F.lit("\\n"), F.lit("\n")), F.lit("\\t"), F.lit("\t"))
    return F.regexp_replace(c, r"\\(.)", "$1")


def joined_text(expression: Column) -> Column:
    """All quoted parts of a sum of texts, put together; null where there is none."""
    parts = F.regexp_extract_all(expression, F.lit(LITERAL), F.lit(1))
    return F.when(F.size(parts) > 0, unescaped(F.array_join(parts, "")))


def verbatim(expression: Column) -> Column:
    """The text of an expression that is a single literal."""
    return F.when(F.trim(expression).rlike(f"^{LITERAL}$"), unescaped(F.regexp_extract(F.trim(expression), f"^{LITERAL}$", 1)))


def first_text(args: Column) -> Column:
    """The first argument that opens with a quote, read whole."""
    return joined_text(F.try_element_at(F.filter(args, lambda a: a.startswith('"')), F.lit(1)))


def point(expression: Column) -> Column:
    numbers = [F.regexp_extract(expression, POINT_PATTERN, k).cast("int") for k in (1, 2, 3)]
    return F.when(expression.rlike(POINT_PATTERN), F.array(*numbers))


def first_point(args: Column) -> Column:
    return F.try_element_at(F.filter(F.transform(args, point), lambda p: p.isNotNull()), F.lit(1))


def first_id(args: Column) -> Column:
    return F.try_element_at(F.filter(args, lambda a: a.rlike(ID_PATTERN)), F.lit(1))


def constants(rel: DataFrame) -> DataFrame:
    """file, name, value: whole numbers with a name."""
    plain = assigns(rel).where(F.col("type").isin("int", "long") & F.col("expression").rlike("^-?[0-9]+$"))
    return plain.select("file", F.col("target").alias("name"), F.col("expression").cast("long").alias("value"))


def declarations(rel: DataFrame) -> DataFrame:
    """file, name, type, args, pos: one row a name.

    `new T(...)` wins over the rest and the last of several over earlier ones;
    then numbers, other names and expressions, and a class for what its super
    call makes, where of several the first stands.
    """
    made = calls(rel).where("is_new and target is not null and parent is null").select("file", F.col("target").alias("name"), F.col("name").alias("type"), "args", "pos", F.lit(0).alias("rank"), (-F.col("pos")).alias("nth"))
    rest = assigns(rel).where(~F.col("expression").startswith("new "))
    kind = F.when(F.col("expression").rlike("^-?[0-9]+$"), "number").when(F.col("expression").rlike(r"^[A-Za-z_]\w*$"), "alias").otherwise("expression")
    other = rest.select("file", F.col("target").alias("name"), kind.alias("type"), F.array("expression").alias("args"), "pos", F.lit(1).alias("rank"), F.col("pos").alias("nth"))
    above = calls(rel).where("name = 'super' and in_class is not null").select("file", F.col("in_class").alias("name"), F.col("base").alias("type"), "args", "pos", F.lit(2).alias("rank"), F.col("pos").alias("nth"))
    n = F.row_number().over(Window.partitionBy("file", "name").orderBy("rank", "nth"))
    return made.unionByName(other).unionByName(above).withColumn("__n", n).where("__n = 1").drop("__n", "rank", "nth")


# --- items -----------------------------------------------------------------


def items(rel: DataFrame) -> DataFrame:
    """file, name (the variable), label, constant, collection, count (at least 1), alternates, highlighted, pos."""
    own = declarations(rel).where(F.col("type") == ITEM)
    said = calls(rel).where("name in ('addAlternates', 'highlighted', 'setHighlightInInventory')")
    said = said.withColumn("on", F.coalesce("receiver", F.when(F.col("on_call").isNotNull(), F.col("target"))))
    extra = said.groupBy("file", F.col("on").alias("name")).agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.when(F.col("name") == "addAlternates", F.filter("args", lambda a: a.rlike(ID_PATTERN))))))).alias("alternates"),
        F.bool_or(F.col("name") != "addAlternates").alias("highlighted"),
    )
    second = F.get("args", F.lit(1))
    count = F.greatest(F.coalesce(F.try_element_at(F.transform(F.filter("args", lambda a: a.rlike("^[0-9]+$")), lambda a: a.cast("int")), F.lit(1)), F.lit(1)), F.lit(1))
    return beside(own, extra, ["file", "name"], "left").select(
        "file", "name", joined_text(F.get("args", F.lit(0))).alias("label"), F.when(second.rlike(ID_PATTERN), second).alias("constant"), F.when(second.startswith("ItemCollections."), second).alias("collection"),
        count.alias("count"), F.coalesce("alternates", F.expr("cast(array() as array<string>)")).alias("alternates"), F.coalesce("highlighted", F.lit(False)).alias("highlighted"), "pos",
    )


def step_items(rel: DataFrame) -> DataFrame:
    """file, step, position, label, count: the items that a step's arguments name, each label once, where it first stands."""
    own = items(rel).select("file", F.col("name").alias("argument"), "label", "count")
    given = declarations(rel).where(F.col("type").endswith("Step")).select("file", F.col("name").alias("step"), F.posexplode("args").alias("at", "argument"))
    first = beside(given, own, ["file", "argument"]).groupBy("file", "step", "label").agg(F.min_by(F.struct("at", "count"), "at").alias("f"))
    n = F.row_number().over(Window.partitionBy("file", "step").orderBy("f.at")) - 1
    return first.select("file", "step", n.alias("position"), "label", F.col("f.count").alias("count"))


def required_items(rel: DataFrame, ids: DataFrame) -> DataFrame:
    """file, label, id: every label with the id that it is first declared with."""
    own = items(rel).where("constant is not null").join(ids, "constant")
    return own.groupBy("file", "label").agg(F.min_by("id", "pos").alias("id"))


def substitutes(rel: DataFrame, ids: DataFrame) -> DataFrame:
    """file, id, other_ids: what may stand for an item; an item that is declared with different lists has none."""
    own = items(rel).where("size(alternates) > 0").join(ids, "constant").select("file", "id", F.explode("alternates").alias("constant"), "name")
    lists = own.join(ids.withColumnRenamed("id", "other"), "constant").groupBy("file", "id", "name").agg(F.array_join(F.sort_array(F.collect_set("other")), ",").alias("others"))
    return lists.groupBy("file", "id").agg(F.min("others").alias("other_ids"), F.countDistinct("others").alias("n")).where("n = 1").drop("n")


# --- places ----------------------------------------------------------------


def zones(rel: DataFrame) -> DataFrame:
    """file, name, box (x, y, plane twice): from two corners or a region's number; null where it cannot be read."""
    a = F.col("args")
    p, q = point(F.get(a, F.lit(0))), point(F.get(a, F.lit(1)))
    low = lambda k: F.least(p[k], F.coalesce(q, p)[k])
    high = lambda k: F.greatest(p[k], F.coalesce(q, p)[k])
    corners = F.when(p.isNotNull() & (q.isNotNull() | (F.size(a) == 1)), F.array(low(0), low(1), low(2), high(0), high(1), high(2)))
    region = F.when(F.get(a, F.lit(0)).rlike("^[0-9]+$"), F.get(a, F.lit(0)).cast("int"))
    x, y = F.shiftright(region, REGION_BITS) * REGION_SIDE, region.bitwiseAND(F.lit((1 << REGION_BITS) - 1)) * REGION_SIDE
    plane = F.coalesce(F.get(a, F.lit(1)).try_cast("int"), F.lit(0))
    square = F.when(region.isNotNull() & (F.size(a) <= 2), F.array(x, y, plane, x + (REGION_SIDE - 1), y + (REGION_SIDE - 1), plane))
    return declarations(rel).where(F.col("type") == ZONE).select("file", "name", F.coalesce(corners, square).alias("box"))


def zone_lists(rel: DataFrame) -> DataFrame:
    """file, name, boxes of a condition on several zones; null where any of them cannot be read."""
    asked = declarations(rel).where(F.col("type") == "ZoneRequirement").select("file", "name", F.posexplode("args").alias("at", "zone"))
    met = beside(asked, zones(rel).withColumnRenamed("name", "zone"), ["file", "zone"], "left")
    boxes = F.transform(F.sort_array(F.collect_list(F.struct("at", "box"))), lambda s: s["box"])
    return met.groupBy("file", "name").agg(F.when(F.bool_and(F.col("box").isNotNull()), boxes).alias("boxes"))


def route_points(rel: DataFrame) -> DataFrame:
    """file, step, segment, position, point: a step's drawn line; `null` breaks it, a reversed list is turned round, and a step with two different lines has none."""
    drawn = calls(rel).where("name = 'setLinePoints' and receiver is not null").select("file", F.col("receiver").alias("step"), F.col("pos").alias("drawn"))
    lists = calls(rel).where(F.col("name").isin(*LISTS) & F.col("parent").isNotNull()).select("file", F.col("parent").alias("within"), "args")
    turned = calls(rel).where("name = 'reverse'").select("file", F.col("pos").alias("within"), F.col("parent").alias("drawn"))
    direct = beside(lists.withColumnRenamed("within", "drawn"), drawn, ["file", "drawn"]).select("file", "step", "drawn", "args")
    back = beside(beside(turned, lists, ["file", "within"]), drawn, ["file", "drawn"]).select("file", "step", "drawn", F.reverse("args").alias("args"))
    lines = direct.unionByName(back)
    one = lines.groupBy("file", "step").agg(F.countDistinct(F.array_join("args", ";")).alias("n"), F.min_by("args", "drawn").alias("args")).where("n = 1")
    rows = one.select("file", "step", F.posexplode("args").alias("at", "a")).withColumn("point", point(F.col("a")))
    w = Window.partitionBy("file", "step").orderBy("at")
    cut = rows.withColumn("segment", F.sum((F.col("a") == "null").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0))).where("point is not null")
    return cut.select("file", "step", "segment", (F.row_number().over(Window.partitionBy("file", "step", "segment").orderBy("at")) - 1).alias("position"), "point")


def tile_markers(rel: DataFrame) -> DataFrame:
    """file, step, point: marked floor tiles, each once."""
    marks = calls(rel).where("name in ('addTileMarker', 'addTileMarkers') and receiver is not null")
    return marks.select("file", F.col("receiver").alias("step"), F.explode("args").alias("a")).select("file", "step", point(F.col("a")).alias("point")).where("point is not null").distinct()


def panels(rel: DataFrame) -> DataFrame:
    """file, step, place: steps in the order in which the panels first list them, from 0."""
    panel = calls(rel).where((F.col("name") == PANEL) & F.col("is_new")).select("file", F.col("pos").alias("parent"))
    listed = beside(calls(rel).where(F.col("name").isin(*LISTS)), panel, ["file", "parent"]).where("parent_arg = 1")
    first = listed.select("file", "pos", F.posexplode("args").alias("at", "step")).where(F.col("step").rlike(r"^[A-Za-z_]\w*$")).groupBy("file", "step").agg(F.min(F.struct("pos", "at")).alias("f"))
    return first.select("file", "step", (F.dense_rank().over(Window.partitionBy("file").orderBy("f")) - 1).alias("place"))


# --- marks and words on steps ----------------------------------------------


def widget_marks(rel: DataFrame) -> DataFrame:
    """file, step, packed (group << 16 | child): interface parts that a step points at, however it says so, each once."""
    number = lambda k: F.get("args", F.lit(k)).try_cast("int")
    pack = lambda g, c: F.shiftleft(g, PACK_BITS).bitwiseOR(c)
    said = calls(rel).where("name = 'addWidgetHighlight' and receiver is not null").select("file", F.col("receiver").alias("step"), pack(number(0), number(1)).alias("packed"))
    made = calls(rel).where("name = 'WidgetStep' and is_new and target is not null").select("file", F.col("target").alias("step"), pack(number(2), number(3)).alias("packed"))
    return said.unionByName(made).where("packed is not null").distinct()


def dialogue(rel: DataFrame) -> DataFrame:
    """file, step, kind (option, unless, change), text, other: words to choose, words that rule others out, words shown changed."""
    said = calls(rel).where("receiver is not null and name in ('addDialogStep', 'addDialogSteps', 'addDialogStepWithExclusion', 'addDialogChange')").withColumn("step", F.col("receiver"))
    option = said.where("name in ('addDialogStep', 'addDialogSteps')").select("file", "step", F.lit("option").alias("kind"), F.explode("args").alias("a"), F.lit(None).cast("string").alias("b"))
    pair = said.where("name not in ('addDialogStep', 'addDialogSteps')").select("file", "step", F.when(F.col("name") == "addDialogChange", "change").otherwise("unless").alias("kind"), F.get("args", F.lit(0)).alias("a"), F.get("args", F.lit(1)).alias("b"))
    return option.unionByName(pair).select("file", "step", "kind", verbatim(F.col("a")).alias("text"), verbatim(F.col("b")).alias("other")).where("text is not null").distinct()


def alternate_ids(rel: DataFrame) -> DataFrame:
    """file, step, constant: further ids of a step, bare or behind a cast."""
    more = calls(rel).where("name in ('addAlternateNpcs', 'addAlternateObjects') and receiver is not null")
    each = more.select("file", F.col("receiver").alias("step"), F.explode("args").alias("a")).withColumn("constant", F.regexp_replace("a", r"^\(\s*\w+\s*\)\s*", ""))
    return each.where(F.col("constant").rlike(ID_PATTERN)).select("file", "step", "constant").distinct()


# --- branches --------------------------------------------------------------


def branches(rel: DataFrame) -> DataFrame:
    """file, owner, at, condition, step: the conditional steps of an owner in source order; the default comes last, without a condition.

    The receiver may be the variable or a chain that was begun on it or on its making.
    """
    c = calls(rel)
    base = c.select("file", F.col("pos").alias("on_call"), F.coalesce("receiver", "target").alias("begun"))
    added = beside(c.where("name = 'addStep' and size(args) = 2"), base, ["file", "on_call"], "left").withColumn("owner", F.coalesce("receiver", "target", "begun"))
    own = added.where("owner is not null").select("file", "owner", "until", F.get("args", F.lit(0)).alias("condition"), F.get("args", F.lit(1)).alias("step"))
    default = declarations(rel).where(F.col("type") == CONDITIONAL).select("file", F.col("name").alias("owner"), F.lit(None).cast("int").alias("until"), F.lit(None).cast("string").alias("condition"), F.get("args", F.lit(1)).alias("step"))
    n = F.row_number().over(Window.partitionBy("file", "owner").orderBy(F.asc_nulls_last("until")))
    return own.unionByName(default).where("step is not null").select("file", "owner", (n - 1).alias("at"), "condition", "step")


def copied_branches(rel: DataFrame) -> DataFrame:
    """file, owner, condition, step, at: what `b = a.copy()` took of a's branches: those added before it; a later one with the same condition on b stands instead."""
    copies = assigns(rel).where(F.col("expression").rlike(r"^\w+\.copy\(\)$")).select("file", F.col("target").alias("copy"), F.regexp_extract("expression", r"^(\w+)\.", 1).alias("owner"), F.col("pos").alias("copied"))
    added = calls(rel).where("name = 'addStep' and size(args) = 2 and receiver is not null").select("file", F.col("receiver").alias("owner"), F.col("pos").alias("at"), F.get("args", F.lit(0)).alias("condition"), F.get("args", F.lit(1)).alias("step"))
    taken = beside(added, copies, ["file", "owner"]).where("at < copied").select("file", F.col("copy").alias("owner"), "condition", "step", "at")
    own = beside(added, copies.select("file", F.col("copy").alias("owner")).distinct(), ["file", "owner"], "left_semi").select("file", "owner", "condition", "step", "at")
    return taken.unionByName(own).groupBy("file", "owner", "condition").agg(F.max_by("step", "at").alias("step"), F.min("at").alias("at"))


def certain_branches(rows: DataFrame, keys: list[str], order: str, readable: Column) -> DataFrame:
    """The readable branches of an ordered list; `conditional` where an unreadable one stands before."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    tainted = F.coalesce(F.bool_or(~F.coalesce(readable, F.lit(False))).over(w), F.lit(False))
    return rows.withColumn("conditional", tainted).withColumn("__ok", F.coalesce(readable, F.lit(False))).where("__ok").drop("__ok")


def resolved_steps(rel: DataFrame) -> DataFrame:
    """file, name, real, type: what a name stands for behind aliases and wrapping steps; a cycle stands for nothing.

    A name that is another leads on to it, and so does a conditional step to
    its default.  Pointers are doubled until none moves; each round is written,
    so the plan stays as long as one round.
    """
    d = settled(declarations(rel).select("file", "name", "type", F.when(F.col("type") == "alias", F.get("args", F.lit(0))).when(F.col("type") == CONDITIONAL, F.get("args", F.lit(1))).alias("to")), "names")
    known = d.select("file", F.col("name").alias("to"), F.lit(1).alias("is_name"))
    linked = beside(d, known, ["file", "to"], "left")
    cur = settled(linked.select("file", "name", F.when(F.col("is_name") == 1, F.col("to")).otherwise(F.col("name")).alias("real")), "pointers")
    ends = settled(linked.where("is_name is null").select("file", F.col("name").alias("real"), "type"), "ends")
    left = None
    while True:
        hop = cur.select("file", F.col("name").alias("real"), F.col("real").alias("next"))
        cur = settled(beside(cur, hop, ["file", "real"]).select("file", "name", F.col("next").alias("real")), "pointers")
        still = beside(cur, ends, ["file", "real"], "left_anti").count()
        if still == left or still == 0:
            break
        left = still
    return beside(cur, ends, ["file", "real"], "left").select("file", "name", F.when(F.col("type").isNotNull(), F.col("real")).alias("real"), "type")


# A step that wraps another and hides its answer, and what stand-in steps say.
WRAPPER = "PuzzleWrapperStep"
STAND_INS = r"(?i)^unknown state|journal to sync"


def is_stand_in(record: Column) -> Column:
    """Nothing that a player could act on: no place, no thing, and no words or only those of a stand-in."""
    text = F.coalesce(record["text"], F.lit(""))
    return record["point"].isNull() & record["constant"].isNull() & ((text == "") | text.rlike(STAND_INS))


def _last_said(rel: DataFrame, call: str, value: Column, out: str) -> DataFrame:
    """file, name, out: the last that a call says of a name."""
    return calls(rel).where((F.col("name") == call) & F.col("receiver").isNotNull()).groupBy("file", F.col("receiver").alias("name")).agg(F.max_by(value, "pos").alias(out))


def _own_records(rel: DataFrame) -> DataFrame:
    """file, name, to, rec: what every name says itself, and the name that it hands all else to.

    rec: text (goes before that of the name behind), hidden (stands only where
    no name behind has a text), point, constant, icon, arms (conditions and
    steps in order).
    """
    d = declarations(rel)
    by_method = method_steps(rel).select("file", F.col("method").alias("called"), F.col("step").alias("returned"))
    names = d.select("file", F.col("name").alias("argument"), F.col("type").alias("kind"))
    step_like = F.col("kind").endswith("Step") | F.col("kind").isin("alias", "expression")
    given = beside(d.where(F.col("type").endswith("Step")).select("file", "name", F.posexplode("args").alias("nth", "argument")), names, ["file", "argument"]).where(step_like & (F.col("argument") != F.col("name")))
    first = given.groupBy("file", "name").agg(F.min_by("argument", "nth").alias("handed"))
    said = F.regexp_extract(F.get("args", F.lit(0)), r"^(\w+)\s*\(.*\)$", 1)
    copied = F.regexp_extract(F.get("args", F.lit(0)), r"^(\w+)\.copy\(\)$", 1)
    arms = branches(rel).where("condition is not null").groupBy("file", F.col("owner").alias("name")).agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "condition", "step"))), lambda b: F.struct(b["condition"].alias("condition"), b["step"].alias("step"))).alias("arms"))
    copies = copied_branches(rel).groupBy("file", F.col("owner").alias("name")).agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "condition", "step"))), lambda b: F.struct(b["condition"].alias("condition"), b["step"].alias("step"))).alias("copied_arms"))
    renamed = _last_said(rel, "setText", joined_text(F.get("args", F.lit(0))), "renamed")
    icons = _last_said(rel, "addIcon", F.get("args", F.lit(0)), "icon")
    own = d.withColumn("called", F.when(F.col("type") == "expression", said)).withColumn("original", F.when(F.col("type") == "expression", copied))
    own = beside(own, by_method, ["file", "called"], "left")
    for side in (first, arms, copies, renamed, icons):
        own = beside(own, side, ["file", "name"], "left")
    source = d.where(F.col("type") == CONDITIONAL).select("file", F.col("name").alias("original"), F.get("args", F.lit(1)).alias("original_default"), first_text("args").alias("original_text"))
    own = beside(own, source, ["file", "original"], "left")
    wraps, text = F.col("type") == WRAPPER, F.when(F.col("type").endswith("Step"), first_text("args"))
    to = F.when(F.col("type") == "alias", F.get("args", F.lit(0))).when(F.col("type") == "expression", F.coalesce("original_default", "returned")).otherwise(F.coalesce(F.when(F.col("type") == CONDITIONAL, F.get("args", F.lit(1))), "handed"))
    none = F.expr("cast(array() as array<struct<condition:string,step:string>>)")
    return own.select("file", "name", to.alias("to"), F.struct(
        F.coalesce("renamed", F.when(~wraps, text), "original_text").alias("text"), F.when(wraps, text).alias("hidden"), first_point(F.col("args")).alias("point"), first_id(F.col("args")).alias("constant"), "icon",
        F.coalesce("copied_arms", "arms", none).alias("arms"),
    ).alias("rec"))


def _over(a: Column, b: Column) -> Column:
    """One record over another; the order of putting several together does not matter."""
    first = lambda k: F.coalesce(a[k], b[k]).alias(k)
    return F.struct(first("text"), F.coalesce(b["hidden"], a["hidden"]).alias("hidden"), first("point"), first("constant"), first("icon"), F.concat(a["arms"], b["arms"]).alias("arms"))


def _put_together(own: DataFrame) -> DataFrame:
    """file, name, rec, said: every name's record over all those behind it; pointers are doubled, and names that lead round in a circle have none."""
    known = own.select("file", F.col("name").alias("to"), F.lit(True).alias("is_name"))
    cur = settled(beside(own, known, ["file", "to"], "left").select("file", "name", F.when(F.col("is_name"), F.col("to")).alias("to"), "rec"), "delegates")
    left = None
    while True:
        ahead = cur.select("file", F.col("name").alias("to"), F.col("to").alias("next"), F.col("rec").alias("behind"))
        moved = beside(cur.where("to is not null"), ahead, ["file", "to"]).select("file", "name", F.col("next").alias("to"), _over(F.col("rec"), F.col("behind")).alias("rec"))
        cur = settled(cur.where("to is null").unionByName(moved), "delegates")
        waiting = cur.where("to is not null").count()
        if waiting in (0, left):  # what is left goes round
            break
        left = waiting
    said = F.struct(F.coalesce("rec.text", "rec.hidden").alias("text"), F.col("rec.point").alias("point"), F.col("rec.constant").alias("constant"))
    return cur.where("to is null").select("file", "name", "rec", said.alias("said"))


def delegated(rel: DataFrame) -> DataFrame:
    """file, name, text, point, constant, icon, arms, stood_in: what every step says once all that it hands on is asked.

    A step hands to the name it stands for, to its default, to the step it
    wraps or copies, or to what the method it calls returns.  The outer text,
    place, thing and icon go before the inner ones, only a wrapper's own words
    stand behind those of the step it wraps; outer arms are asked first and the
    default's own stay.  A choice whose default only says a stand-in's words
    hands to the last of its arms that says more instead (stood_in).
    """
    own = settled(_own_records(rel).withColumn("stood_in", F.lit(False)), "records")
    while True:
        done = _put_together(own)
        behind = done.select("file", F.col("name").alias("to"), F.col("said").alias("default"))
        poor = beside(own.where(F.size("rec.arms") > 0), behind, ["file", "to"]).where(is_stand_in(F.col("default"))).select("file", "name", F.posexplode("rec.arms").alias("nth", "arm"))
        rich = done.where(~is_stand_in(F.col("said"))).select("file", F.col("name").alias("step"))
        better = settled(beside(poor.withColumn("step", F.col("arm.step")), rich, ["file", "step"]).groupBy("file", "name").agg(F.max_by("step", "nth").alias("instead")), "stand-ins")
        if better.isEmpty():
            return beside(done, own.select("file", "name", "stood_in"), ["file", "name"]).select("file", "name", "said.text", "said.point", "said.constant", "rec.icon", "rec.arms", "stood_in")
        own = settled(beside(own, better, ["file", "name"], "left").select("file", "name", F.coalesce("instead", "to").alias("to"), "rec", (F.col("stood_in") | F.col("instead").isNotNull()).alias("stood_in")), "records")


def method_steps(rel: DataFrame) -> DataFrame:
    """file, method, step: the name that a method returns; of several returns the last."""
    back = rel.where("kind = 'statement' and name = 'return' and method is not null").where(F.col("expression").rlike(r"^\w+$"))
    return back.groupBy("file", "method").agg(F.max_by("expression", "pos").alias("step"))


def progress(rel: DataFrame) -> DataFrame:
    """file, value, step: what to do at each value of a quest's variable.

    Written as put(value, step), the last for a value wins, the step by name or
    by a method that returns it; a file without any has its only conditional
    step at 0.
    """
    number = F.get("args", F.lit(0))
    put = calls(rel).where("name in ('put', 'add') and size(args) = 2 and receiver = 'steps'").where(number.rlike("^[0-9]+$")).select("file", number.cast("int").alias("value"), F.get("args", F.lit(1)).alias("a"), "pos")
    by = method_steps(rel).withColumn("a", F.concat("method", F.lit("()"))).select("file", "a", F.col("step").alias("returned"))
    own = beside(put, by, ["file", "a"], "left").groupBy("file", "value").agg(F.max_by(F.coalesce("returned", "a"), "pos").alias("step"))
    lone = declarations(rel).where(F.col("type") == CONDITIONAL).groupBy("file").agg(F.min("name").alias("step"), F.count(F.lit(1)).alias("n")).where("n = 1")
    return own.unionByName(beside(lone, own.select("file").distinct(), ["file"], "left_anti").select("file", F.lit(0).alias("value"), "step"))


# --- registries and indexes ------------------------------------------------


def registry(lines: DataFrame, keys: list[str], order: str, starts: Column, text: str) -> DataFrame:
    """keys, row, body: rows that each reach up to the start of the next."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    rows = lines.withColumn("row", F.sum(F.when(starts, 1).otherwise(0)).over(w)).where("row > 0")
    return rows.groupBy(*keys, "row").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(order, text))), lambda s: s[text]), " ").alias("body"))


def first_table_wins(tables: list[DataFrame], key: str) -> DataFrame:
    """One row a key: of the first table that has it."""
    rows = None
    for n, t in enumerate(tables):
        one = t.withColumn("__t", F.lit(n))
        rows = one if rows is None else rows.unionByName(one)
    n = F.row_number().over(Window.partitionBy(key).orderBy("__t", *[c for c in tables[0].columns if c != key]))
    return rows.withColumn("__n", n).where("__n = 1").drop("__n", "__t")


def aliased_keys(rows: DataFrame, name: str, keys: list[Column], order: str) -> DataFrame:
    """key, name: every row under its keys, the most specific first; the first to register a key keeps it, and no later kind of key shadows an earlier one."""
    each = rows.select(name, order, F.posexplode(F.array_distinct(F.array(*keys))).alias("kind", "key")).where("key is not null and key <> ''")
    n = F.row_number().over(Window.partitionBy("key").orderBy("kind", order))
    return each.withColumn("__n", n).where("__n = 1").select("key", name)


def squashed_keys(constant: Column) -> Column:
    """Distinct spellings of a constant: without its signs, and without a leading article."""
    flat = F.regexp_replace(F.lower(constant), "[^a-z0-9]", "")
    return F.array_distinct(F.array(flat, F.regexp_replace(F.regexp_replace(F.lower(constant), "^the[^a-z0-9]+", ""), "[^a-z0-9]", "")))


def reachable(edges: DataFrame, start: str, end: str, starts: DataFrame, most: int = MOST_REACHED) -> DataFrame:
    """start, node, depth, cut: all that can be reached, itself at 0; a node counts once, at its least depth.

    starts has the column `start`.  Once a start has seen more than `most` nodes
    it looks no further: what it has seen by then stays, and `cut` says so in all
    its rows.  A round goes one link further for all starts that still look, at
    any depth, and writes only what is new.
    """
    step = settled(edges.select(F.col(start).alias("node"), F.col(end).alias("next")).where("next is not null").distinct(), "links")
    front = settled(starts.select("start", F.col("start").alias("node"), F.lit(0).alias("depth")).distinct(), "reached")
    rounds, depth = [front], 0
    while True:
        depth += 1
        seen = _all(rounds)
        open_ = seen.groupBy("start").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") <= most).select("start")
        new = front.join(open_, "start", "left_semi").join(step, "node").select("start", F.col("next").alias("node")).distinct()
        front = settled(new.join(seen, ["start", "node"], "left_anti").withColumn("depth", F.lit(depth)), "reached")
        if front.isEmpty():
            break
        rounds.append(front)
        if len(rounds) > MOST_WRITTEN:
            rounds = [settled(_all(rounds), "reached")]
    counts = seen.groupBy("start").agg((F.count(F.lit(1)) > most).alias("cut"))
    return seen.join(counts, "start")


def _all(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out


def preorder(nodes: DataFrame, key: str = "node", parent: str = "parent", at: str = "pos") -> DataFrame:
    """node, place, depth of a forest: every node behind its parent, siblings and roots by their place (equal places by node); place counts from 0.

    The walk around the forest enters and leaves every node once.  Each of these
    steps knows the one after it, and by pointer doubling, in as many rounds as
    the logarithm of their number, how many nodes are entered from it to the end
    and how deep it lies; so any depth and any place will do.  Nodes that no root
    leads to (a parent that is missing, a circle) are not walked.
    """
    own = settled(nodes.select(F.col(key).alias("node"), F.col(parent).alias("parent"), F.col(at).alias("at")), "nodes")
    order = Window.partitionBy("parent").orderBy("at", "node")
    kids = settled(own.withColumn("next", F.lead("node").over(order)).withColumn("first", F.row_number().over(order) == 1), "siblings")
    step = lambda node, out: F.struct(node.alias("node"), out.alias("out"))
    child = kids.where("first and parent is not null").select(F.col("parent").alias("node"), F.col("node").alias("child"))
    into = own.join(child, "node", "left").select(
        step(F.col("node"), F.lit(False)).alias("e"), F.when(F.col("child").isNotNull(), step(F.col("child"), F.lit(False))).otherwise(step(F.col("node"), F.lit(True))).alias("next"), F.lit(1).cast("long").alias("entered"), F.lit(1).cast("long").alias("up"),
    )
    onward = F.when(F.col("next").isNotNull(), step(F.col("next"), F.lit(False))).when(F.col("parent").isNotNull(), step(F.col("parent"), F.lit(True)))
    out = kids.select(step(F.col("node"), F.lit(True)).alias("e"), onward.alias("next"), F.lit(0).cast("long").alias("entered"), F.lit(-1).cast("long").alias("up"))
    walk = settled(into.unionByName(out), "walk")
    for _ in range((2 * own.count()).bit_length()):
        if walk.where("next is not null").isEmpty():
            break
        a, b = walk.alias("a"), walk.alias("b")
        walk = settled(a.join(b, F.col("a.next") == F.col("b.e"), "left").select(
            "a.e", F.coalesce("b.next", F.when(F.col("b.e").isNull(), F.col("a.next"))).alias("next"),
            (F.col("a.entered") + F.coalesce("b.entered", F.lit(0))).alias("entered"), (F.col("a.up") + F.coalesce("b.up", F.lit(0))).alias("up"),
        ), "walk")
    done = walk.where("not e.out and next is null").select("e.node", "entered", (-F.col("up")).alias("depth"))
    total = done.agg(F.max("entered")).first()[0] or 0
    return done.select("node", (F.lit(total) - F.col("entered")).alias("place"), "depth")


def positions(rows: DataFrame, key: str, value: str) -> DataFrame:
    """key, values: sorted distinct values of every key."""
    return rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.sort_array(F.collect_set(value)).alias("values"))


def coordinates(rows: DataFrame, key: str, place: str) -> DataFrame:
    """key, points, ambiguous: where a thing stands, and whether in several places."""
    return rows.groupBy(key).agg(F.sort_array(F.collect_set(place)).alias("points"), (F.countDistinct(place) > 1).alias("ambiguous"))


def members(rows: DataFrame, name: str, list_col: str, ids: DataFrame) -> DataFrame:
    """name, ids: the known members of a named list in order, each once."""
    each = rows.select(name, F.posexplode(list_col).alias("at", "constant")).join(ids, "constant")
    first = each.groupBy(name, "id").agg(F.min("at").alias("at"))
    return first.groupBy(name).agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "id"))), lambda s: s["id"]).alias("ids"))


def resolved_nodes(nodes: DataFrame, ids: DataFrame, columns: list[str]) -> DataFrame:
    """Every constant column of `nodes` gets its id in a column of the same name with _id behind it."""
    for c in columns:
        side = ids.select(F.col("constant").alias(c), F.col("id").alias(f"{c}_id"))
        nodes = nodes.join(side, c, "left")
    return nodes


def hints(rows: DataFrame, place: str, text: str, most: int = 4) -> DataFrame:
    """place, texts: up to `most` different descriptions of a place, in alphabetical order."""
    n = F.row_number().over(Window.partitionBy(place).orderBy(text))
    few = rows.select(place, text).distinct().withColumn("__n", n).where(F.col("__n") <= most)
    return few.groupBy(place).agg(F.sort_array(F.collect_list(text)).alias("texts"))
