"""Registered queries of the source reader.

Every LINES parts are written out as a source file; the SQL works on the
tables and knows nothing of the source.  A part's place in its file is its
rank by key; sizes, prices and brands give counts, places and kinds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..codebase import conditions, extract, reader
from ..plans.tables import beside
from .registry import read, registered, step_events

#: Parts in a source file, so files grow in number with the table; how far away a part's alternate is.
LINES, OTHER = 60, 20

_PARTS = f"""p AS (SELECT p_partkey AS k, p_partkey // {LINES} AS file, p_size AS s, CAST(regexp_extract(p_brand, '[0-9]+$') AS INTEGER) AS b, p_name AS name, row_number() OVER (PARTITION BY p_partkey // {LINES} ORDER BY p_partkey) - 1 AS r FROM part),
  q AS (SELECT *, count(*) OVER (PARTITION BY file) AS n FROM p)"""


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("file")
    p = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), F.floor(F.col("p_partkey") / LINES).alias("file"), F.col("p_size").alias("s"), F.regexp_extract("p_brand", "[0-9]+$", 0).cast("int").alias("b"), F.col("p_name").alias("name"))
    return p.withColumn("r", (F.row_number().over(w.orderBy("k")) - 1).cast("long")).withColumn("n", F.count(F.lit(1)).over(w))


def said(*pieces: str | Column) -> Column:
    """Texts and columns put together."""
    return F.concat(*[F.lit(x) if isinstance(x, str) else x.cast("string") for x in pieces])


def sources(spark: SparkSession, sf_dir: str, *lines: Column) -> DataFrame:
    """file, source: the given lines of every part, in its order, in the method of a class."""
    body = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("r", F.concat_ws("\n", *lines).alias("t")))), lambda x: x["t"]), "\n")
    files = parts(spark, sf_dir).groupBy("file").agg(body.alias("body"))
    return files.select("file", said("class File", F.col("file"), " extends Helper { // it's (open\n void set() { /* \" ) */\n", F.col("body"), "\n}\n}\n").alias("source"))


def relation(spark: SparkSession, sf_dir: str, *lines: Column) -> DataFrame:
    return reader.read_sources(sources(spark, sf_dir, *lines))


def ids(spark: SparkSession, sf_dir: str, prefix: str = "ItemID.K") -> DataFrame:
    return parts(spark, sf_dir).select(said(prefix, F.col("k")).alias("constant"), F.col("k").alias("id"))


c = F.col

def item() -> list[Column]:
    return [said("ItemRequirement v", c("r"), " = new ItemRequirement(\"", c("name"), ", (\\\"big\\\"\" + \")\", ItemID.K", c("k"), ", ", c("s") % 4, ")", F.when(c("b") % 2 == 0, ".highlighted()").otherwise(""), "; // ItemID.X)"),
            F.when(c("s") % 3 == 0, said("v", c("r"), ".addAlternates(ItemID.K", c("k"), ", ItemID.K", c("k") + OTHER, ", 7);"))]


@registered(f"WITH {_PARTS} SELECT file, r AS nth, name || ', (\"big\")' AS label, 'ItemID.K' || k AS constant, CAST(greatest(s % 4, 1) AS INTEGER) AS n, b % 2 = 0 AS highlighted, CASE WHEN s % 3 = 0 THEN 2 ELSE 0 END AS n_alternates FROM q")
def source_items(spark, sf_dir):
    """Item declarations with counts, marks and alternates."""
    got = extract.items(relation(spark, sf_dir, *item()))
    return got.select("file", F.regexp_extract("name", "[0-9]+", 0).cast("long").alias("nth"), "label", "constant", F.col("count").alias("n"), "highlighted", F.size("alternates").alias("n_alternates"))


@registered(f"WITH {_PARTS} SELECT file, label, min(id) AS id FROM (SELECT file, name || ', (\"big\")' AS label, first_value(k) OVER (PARTITION BY file, name ORDER BY r) AS id FROM q) GROUP BY 1, 2")
def source_required(spark, sf_dir):
    """The first id of every label of a file."""
    return extract.required_items(relation(spark, sf_dir, *item()), ids(spark, sf_dir))


@registered(f"WITH {_PARTS} SELECT q.file, q.k AS id, CASE WHEN z.k IS NULL THEN q.k::VARCHAR ELSE q.k || ',' || z.k END AS other_ids FROM q LEFT JOIN q z ON z.k = q.k + {OTHER} WHERE q.s % 3 = 0")
def source_substitutes(spark, sf_dir):
    """What may stand for an item."""
    return extract.substitutes(relation(spark, sf_dir, *item()), ids(spark, sf_dir))


def step() -> list[Column]:
    return [said("step", c("r"), " = new NpcStep(this, NpcID.K", c("k"), ", new WorldPoint(", c("s"), ", ", c("b"), ", 0), \"Talk to \" + \"", c("name"), ".\", v", c("r"), ", v0, v", c("r"), ");")]


@registered(f"WITH {_PARTS}, a AS (SELECT q.file, q.r AS nth, z.name || ', (\"big\")' AS label, CAST(greatest(z.s % 4, 1) AS INTEGER) AS n, CASE WHEN z.r = q.r THEN 0 ELSE 1 END AS ord FROM q JOIN q z ON q.file = z.file AND (z.r = q.r OR z.r = 0)) "
            "SELECT file, nth, label, min(ord) AS position, arg_min(n, ord) AS n FROM a GROUP BY 1, 2, 3")  # fmt: skip
def source_step_items(spark, sf_dir):
    """The items that a step names, each once, in order."""
    got = extract.step_items(relation(spark, sf_dir, *item(), *step()))
    return got.select("file", F.regexp_extract("step", "[0-9]+", 0).cast("long").alias("nth"), "label", "position", F.col("count").alias("n"))


@registered(f"WITH {_PARTS} SELECT file, r AS nth, 'NpcID.K' || k AS constant, k AS id, s || ',' || b || ',0' AS point, 'Talk to ' || name || '.' AS words FROM q")
def source_steps(spark, sf_dir):
    """First id, first point and first text among a step's arguments, ids put in."""
    d = extract.declarations(relation(spark, sf_dir, *step())).where(F.col("type") == "NpcStep")
    flat = d.select("file", F.regexp_extract("name", "[0-9]+", 0).cast("long").alias("nth"), extract.first_id(c("args")).alias("constant"), F.array_join(extract.first_point(c("args")).cast("array<string>"), ",").alias("point"), extract.first_text(c("args")).alias("words"))
    return extract.resolved_nodes(flat, ids(spark, sf_dir, "NpcID.K"), ["constant"]).withColumnRenamed("constant_id", "id")


@registered(f"WITH {_PARTS} SELECT file, 'N' || r AS name, CAST(s * CASE WHEN b % 2 = 0 THEN -1 ELSE 1 END AS BIGINT) AS value FROM q")
def source_constants(spark, sf_dir):
    """Named whole numbers."""
    return extract.constants(relation(spark, sf_dir, said("private static final int N", c("r"), " = ", c("s") * F.when(c("b") % 2 == 0, -1).otherwise(1), ";")))


@registered(f"""WITH {_PARTS} SELECT file, r AS nth, CASE s % 4 WHEN 0 THEN (b // 4) * 64 || ',' || (s + 64 * (b % 4)) * 64 || ',1,' || ((b // 4) * 64 + 63) || ',' || ((s + 64 * (b % 4)) * 64 + 63) || ',1'
  WHEN 1 THEN least(s, b) || ',' || least(b, r) || ',0,' || greatest(s, b) || ',' || greatest(b, r) || ',0' WHEN 2 THEN s || ',' || b || ',0,' || s || ',' || b || ',0' END AS box FROM q""")
def source_zones(spark, sf_dir):
    """Boxes from two corners, one corner or a region; null where unreadable."""
    zone = F.when(c("s") % 4 == 0, said((c("b") * 64 + c("s")), ", 1")).when(c("s") % 4 == 1, said("new WorldPoint(", c("s"), ", ", c("b"), ", 0), new WorldPoint(", c("b"), ", ", c("r"), ", 0)"))
    zone = zone.when(c("s") % 4 == 2, said("new WorldPoint(", c("s"), ", ", c("b"), ", 0)")).otherwise(F.lit("here(1), there"))
    got = extract.zones(relation(spark, sf_dir, said("z", c("r"), " = new Zone(", zone, ");")))
    return got.select("file", F.regexp_extract("name", "[0-9]+", 0).cast("long").alias("nth"), F.array_join(c("box").cast("array<string>"), ",").alias("box"))


@registered(f"WITH {_PARTS}, z AS (SELECT file, r, CASE WHEN b % 5 <> 0 THEN s || ',' || b || ',0' END AS box FROM q) SELECT a.file, a.r AS nth, CASE WHEN a.box IS NOT NULL AND b.box IS NOT NULL THEN a.box || ';' || b.box END AS boxes FROM z a JOIN z b ON a.file = b.file AND b.r = 0")
def source_zone_lists(spark, sf_dir):
    """All zones of a condition, or none."""
    zone = F.when(c("b") % 5 != 0, said("new WorldPoint(", c("s"), ", ", c("b"), ", 0)")).otherwise(F.lit("spot"))
    got = extract.zone_lists(relation(spark, sf_dir, said("z", c("r"), " = new Zone(", zone, ");"), said("in", c("r"), " = new ZoneRequirement(z", c("r"), ", z0);")))
    corner = lambda box: F.array_join(F.slice(box, 1, 3).cast("array<string>"), ",")
    return got.select("file", F.regexp_extract("name", "[0-9]+", 0).cast("long").alias("nth"), F.array_join(F.transform("boxes", corner), ";").alias("boxes"))


_POINT = lambda x: said("new WorldPoint(", x, ", ", c("b"), ", 0)")


@registered(f"""WITH {_PARTS}, l AS (SELECT file, r AS nth, unnest(CASE WHEN s % 3 = 1 THEN [s + 2, NULL, s + 1, s] ELSE [s, s + 1, NULL, s + 2] END) AS x, unnest([0, 1, 2, 3]) AS ord, b FROM q WHERE s % 3 <> 2),
  m AS (SELECT *, sum(CASE WHEN x IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY file, nth ORDER BY ord ROWS UNBOUNDED PRECEDING) AS segment FROM l)
  SELECT file, nth, segment, row_number() OVER (PARTITION BY file, nth, segment ORDER BY ord) - 1 AS position, x || ',' || b || ',0' AS point FROM m WHERE x IS NOT NULL""")
def source_routes(spark, sf_dir):
    """Drawn lines: breaks, reversed lists, and none where two differ."""
    made = said("Arrays.asList(", _POINT(c("s")), ", ", _POINT(c("s") + 1), ", null, ", _POINT(c("s") + 2), ")")
    first = said("step", c("r"), ".setLinePoints(", F.when(c("s") % 3 == 1, said("Lists.reverse(", made, ")")).otherwise(made), ");")
    again = F.when(c("s") % 3 == 2, said("step", c("r"), ".setLinePoints(Arrays.asList(", _POINT(c("b")), "));"))
    got = extract.route_points(relation(spark, sf_dir, first, again))
    return got.select("file", F.regexp_extract("step", "[0-9]+", 0).cast("long").alias("nth"), "segment", F.col("position").cast("long").alias("position"), F.array_join(c("point").cast("array<string>"), ",").alias("point"))


@registered(f"WITH {_PARTS} SELECT file, r AS nth, 'tile' AS kind, s || ',' || b || ',0' AS value FROM q UNION ALL SELECT file, r, 'widget', CAST(s * 65536 + b AS VARCHAR) FROM q UNION ALL SELECT file, r, 'alternate', 'NpcID.K' || k FROM q UNION ALL SELECT file, r, 'alternate', 'NpcID.J' || k FROM q WHERE s % 2 = 0")
def source_marks(spark, sf_dir):
    """Floor tiles, interface parts and further ids of steps, each once."""
    tile = said("step", c("r"), ".addTileMarker(", _POINT(c("s")), ", SpriteID.A); step", c("r"), ".addTileMarkers(", _POINT(c("s")), ");")
    widget = said("step", c("r"), ".addWidgetHighlight(", c("s"), ", ", c("b"), "); step", c("r"), " = new WidgetStep(this, \"x\", ", c("s"), ", ", c("b"), ");")
    more = said("step", c("r"), ".addAlternateNpcs(NpcID.K", c("k"), F.when(c("s") % 2 == 0, said(", (Integer) NpcID.J", c("k"))).otherwise(F.lit("")), ");")
    rel = relation(spark, sf_dir, tile, widget, more)
    nth = F.regexp_extract("step", "[0-9]+", 0).cast("long").alias("nth")
    row = lambda df, kind, value: df.select("file", nth, F.lit(kind).alias("kind"), value.alias("value"))
    tiles = row(extract.tile_markers(rel), "tile", F.array_join(c("point").cast("array<string>"), ","))
    return tiles.unionByName(row(extract.widget_marks(rel), "widget", c("packed").cast("string"))).unionByName(row(extract.alternate_ids(rel), "alternate", c("constant")))


@registered(f"WITH {_PARTS} SELECT file, r AS nth, 'option' AS kind, name AS text, NULL AS other FROM q UNION ALL SELECT file, r, 'option', 'No.', NULL FROM q WHERE s % 2 = 0 UNION ALL SELECT file, r, 'unless', 'Yes (1)', 'I\"m' FROM q UNION ALL SELECT file, r, 'change', 'old', name FROM q")
def source_dialogue(spark, sf_dir):
    """Words to choose, to avoid and to show changed."""
    own = said("step", c("r"))
    lines = [said(own, ".addDialogStep(\"", c("name"), "\");"), F.when(c("s") % 2 == 0, said(own, ".addDialogSteps(\"", c("name"), "\", \"No.\");")), said(own, ".addDialogStepWithExclusion(\"Yes (1)\", \"I\\\"m\"); ", own, ".addDialogChange(\"old\", \"", c("name"), "\");")]
    return extract.dialogue(relation(spark, sf_dir, *lines)).select("file", F.regexp_extract("step", "[0-9]+", 0).cast("long").alias("nth"), "kind", "text", "other")


@registered(f"WITH {_PARTS}, l AS (SELECT file, unnest([r, n - 1 - r]) AS nth, unnest([r * 2, r * 2 + 1]) AS ord FROM q) SELECT file, nth, dense_rank() OVER (PARTITION BY file ORDER BY min(ord)) - 1 AS place FROM l GROUP BY file, nth")
def source_panels(spark, sf_dir):
    """Steps by their first mention in the panels."""
    got = extract.panels(relation(spark, sf_dir, said("panels.add(new PanelDetails(\"p\", Arrays.asList(step", c("r"), ", step", c("n") - 1 - c("r"), "), v0));")))
    return got.select("file", F.regexp_extract("step", "[0-9]+", 0).cast("long").alias("nth"), c("place").cast("long").alias("place"))


def branch() -> list[Column]:
    owner = said("cs", c("r") % 3)
    return [F.when(c("r") < 3, said(owner, " = new ConditionalStep(this, step", c("r"), ");")), F.when(c("r") >= 3, said(owner, ".addStep(", F.when(c("s") % 5 == 0, F.lit("strange()")).otherwise(said("in", c("r"))), ", step", c("r"), ");"))]


@registered(f"WITH {_PARTS}, b AS (SELECT file, r % 3 AS owner, r, CASE WHEN r < 3 THEN NULL WHEN s % 5 = 0 THEN 'strange()' ELSE 'in' || r END AS condition FROM q), o AS (SELECT *, row_number() OVER (PARTITION BY file, owner ORDER BY r < 3, r) - 1 AS ord FROM b) "
            "SELECT file, owner, ord AS place, condition, 'step' || r AS step, coalesce(bool_or(condition = 'strange()') OVER (PARTITION BY file, owner ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS conditional FROM o QUALIFY condition IS DISTINCT FROM 'strange()'")  # fmt: skip
def source_branches(spark, sf_dir):
    """Branches in order, the default last, and what stands behind an unreadable one."""
    rows = extract.branches(relation(spark, sf_dir, *branch()))
    got = extract.certain_branches(rows, ["file", "owner"], "at", ~F.coalesce(c("condition") == "strange()", F.lit(False)))
    return got.select("file", F.substring("owner", 3, 9).cast("long").alias("owner"), c("at").cast("long").alias("place"), "condition", "step", "conditional")


@registered(f"""WITH {_PARTS}, a AS (SELECT file, 'in' || (r % 7) AS condition, r AS ord, 'step' || r AS step, (n // 2) AS half FROM q), t AS (SELECT file, condition, step, ord FROM a WHERE ord <= half UNION ALL SELECT file, 'in0', 'late', 1000000 FROM q WHERE r = half_of(n)),
  x AS (SELECT file, condition, arg_max(step, ord) AS step FROM t GROUP BY 1, 2) SELECT * FROM x""".replace("half_of(n)", "n - 1"))
def source_copies(spark, sf_dir):
    """A copy takes the branches added before it; its own with the same condition stand instead."""
    lines = [said("cs.addStep(in", c("r") % 7, ", step", c("r"), ");"), F.when(c("r") == F.floor(c("n") / 2), F.lit("twin = cs.copy();")), F.when(c("r") == c("n") - 1, F.lit("twin.addStep(in0, late);"))]
    return extract.copied_branches(relation(spark, sf_dir, *lines)).where("owner = 'twin'").select("file", "condition", "step")


@registered(f"WITH {_PARTS} SELECT file, 'a' || r AS name, CASE WHEN r % 9 < 8 THEN 'a' || (r - r % 9) END AS real, CASE WHEN r % 9 < 8 THEN 'NpcStep' END AS type FROM q WHERE r - r % 9 + 8 < n")
def source_delegates(spark, sf_dir):
    """What a name stands for behind aliases and wrapping steps; a cycle stands for nothing."""
    k = c("r") % 9
    line = F.when(k == 0, said("a", c("r"), " = new NpcStep(this, 1);")).when(k == 8, said("a", c("r"), " = a", c("r"), ";")).when(k % 2 == 0, said("a", c("r"), " = new ConditionalStep(this, a", c("r") - 1, ");")).otherwise(said("a", c("r"), " = a", c("r") - 1, ";"))
    whole = parts(spark, sf_dir).select("file", said("a", c("r")).alias("name"), (c("r") - k + 8 < c("n")).alias("whole")).where("whole")
    return beside(extract.resolved_steps(relation(spark, sf_dir, line)), whole.drop("whole"), ["file", "name"], "left_semi")


@registered(f"""WITH {_PARTS}, x AS (SELECT file, r, r % 6 AS k, r - r % 6 AS base, n, k AS id, s, max(CASE WHEN r % 6 = 0 THEN s END) OVER w % 4 = 0 AS poor, max(CASE WHEN r % 6 = 0 THEN k END) OVER w AS id0, max(CASE WHEN r % 6 = 1 THEN k END) OVER w AS id1, max(CASE WHEN r % 6 = 3 THEN s END) OVER w % 2 = 0 AS worded,
   max(CASE WHEN r % 6 = 4 THEN k END) OVER w AS id4, max(CASE WHEN r % 6 = 5 THEN s END) OVER w % 3 = 0 AS late FROM q WINDOW w AS (PARTITION BY file, r - r % 6)),
   y AS (SELECT *, CASE WHEN poor THEN 'Unknown state.' ELSE 'inner ' || base END AS inner_text, CASE WHEN poor THEN NULL ELSE 'ObjectID.K' || id0 END AS inner_id FROM x WHERE base + 5 < n),
   z AS (SELECT *, CASE WHEN worded THEN 'outer ' || (base + 3) WHEN poor THEN 'arm ' || (base + 4) ELSE inner_text END AS choice_text, CASE WHEN poor THEN 'NpcID.K' || id4 ELSE inner_id END AS choice_id FROM y)
  SELECT file, 'd' || r AS name, CASE WHEN k < 3 THEN inner_text WHEN k = 4 THEN 'arm ' || r WHEN k = 5 AND late THEN 'last ' || r ELSE choice_text END AS text, CASE WHEN k < 3 THEN inner_id WHEN k = 4 THEN 'NpcID.K' || id4 ELSE choice_id END AS constant,
    CASE WHEN k IN (1, 2) OR k IN (3, 5) AND NOT poor THEN 'ItemID.K' || id1 END AS icon, CASE WHEN k IN (3, 5) THEN 'in' || (base + 3) ELSE '' END AS arms, k = 3 AND poor AS stood_in FROM z""")
def source_overrides(spark, sf_dir):
    """Names, choices, wrappers and later words: what is said in the end, of what, with which icon and arms."""
    k, name = c("r") % 6, said("d", c("r"))
    above = lambda n: said("d", c("r") - n)
    line = (
        F.when(k == 0, F.when(c("s") % 4 == 0, said(name, " = new DetailedQuestStep(this, \"Unknown state.\");")).otherwise(said(name, " = new ObjectStep(this, ObjectID.K", c("k"), ", \"inner ", c("r"), "\");")))
        .when(k == 1, said(name, " = ", above(1), "; ", name, ".addIcon(ItemID.K", c("k"), ");"))
        .when(k == 2, said(name, " = new PuzzleWrapperStep(this, ", above(1), ", \"hidden\");"))
        .when(k == 3, said(name, " = new ConditionalStep(this, ", above(1), F.when(c("s") % 2 == 0, said(", \"outer ", c("r"), "\"")).otherwise(""), "); ", name, ".addStep(in", c("r"), ", ", above(-1), ");"))
        .when(k == 4, said(name, " = new NpcStep(this, NpcID.K", c("k"), ", \"arm ", c("r"), "\");"))
        .otherwise(said(name, " = ", above(2), ";", F.when(c("s") % 3 == 0, said(" ", name, ".setText(\"last ", c("r"), "\");")).otherwise("")))
    )
    whole = parts(spark, sf_dir).where(c("r") - k + 5 < c("n")).select("file", name.alias("name"))
    got = beside(extract.delegated(relation(spark, sf_dir, line)), whole, ["file", "name"], "left_semi")
    return got.select("file", "name", "text", "constant", "icon", F.array_join(F.transform("arms", lambda a: a["condition"]), ",").alias("arms"), "stood_in")


@registered(f"WITH {_PARTS}, m AS (SELECT file, s AS value, r, CASE WHEN b % 2 = 0 THEN 'inner' || r ELSE 'step' || r END AS step FROM q WHERE file % 2 = 0) SELECT file, value, arg_max(step, r) AS step FROM m GROUP BY 1, 2 UNION ALL SELECT DISTINCT file, 0, 'cs' FROM q WHERE file % 2 = 1")
def source_progress(spark, sf_dir):
    """The step at each value, by name or by the method that returns it; the only root otherwise."""
    name = F.when(c("b") % 2 == 0, said("get", c("r"), "()")).otherwise(said("step", c("r")))
    put = F.when(c("file") % 2 == 0, said("steps.put(", c("s"), ", ", name, ");")).otherwise(F.when(c("r") == 0, F.lit("cs = new ConditionalStep(this, x);")))
    method = F.when(c("b") % 2 == 0, said("} Step get", c("r"), "() { if (x) { return early; } return inner", c("r"), "; } void more", c("r"), "() {"))
    return extract.progress(relation(spark, sf_dir, put, method))


@registered(f"""WITH {_PARTS} SELECT file, r AS nth, CASE s % 6
    WHEN 0 THEN '{{"var": {{"id": ' || k || ', "kind": "varbit", "op": ">=", "value": ' || b || '}}}}' WHEN 1 THEN '{{"all": [{{"open": ' || b || '}}, {{"not": {{"any": [{{"item": {{"count": ' || greatest(s % 4, 1) || ', "ids": [' || k || ']}}}}, {{"zone": [[' || s || ', ' || b || ', 0, ' || s || ', ' || b || ', 0]]}}]}}}}]}}'
    WHEN 2 THEN '{{"var": {{"bit": 3, "id": 5, "kind": "varplayer", "set": true}}}}' WHEN 3 THEN '{{"any": [{{"here": {{"ids": [' || k || '], "kind": "npc"}}}}, {{"dialog": {{"text": ["well (met)"]}}}}]}}' END AS condition FROM q""")
def source_conditions(spark, sf_dir):
    """Conditions of branches compiled, with ids put in; null for what cannot be read or is unknown."""
    var = said("in", c("r"))
    small = said("it", c("r"), " = new ItemRequirement(\"x\", ItemID.K", c("k"), ", ", c("s") % 4, "); z", c("r"), " = new Zone(", _POINT(c("s")), ");\n")
    cond = (
        F.when(c("s") % 6 == 0, said("new VarbitRequirement(VarbitID.K", c("k"), ", ", c("b"), ", Operation.GREATER_EQUAL)"))
        .when(c("s") % 6 == 1, said("and(new WidgetPresence(", c("b"), "), nor(it", c("r"), ", new ZoneRequirement(z", c("r"), ")))"))
        .when(c("s") % 6 == 2, F.lit("new VarplayerRequirement(5, true, 3)"))
        .when(c("s") % 6 == 3, said("new Conditions(LogicType.OR, new NpcCondition(NpcID.K", c("k"), "), new DialogRequirement(\"well (met)\"))"))
        .when(c("s") % 6 == 4, said("new Conditions(", var, "x, strange(1))"))
        .otherwise(F.lit("new VarbitRequirement(VarbitID.UNKNOWN, 1)"))
    )
    files = sources(spark, sf_dir, small, said(var, " = ", cond, "; cs.addStep(", var, ", step", c("r"), ");"))
    known = ids(spark, sf_dir, "VarbitID.K").unionByName(ids(spark, sf_dir)).unionByName(ids(spark, sf_dir, "NpcID.K"))
    got = conditions.resolved(conditions.branch_conditions(files), ["file", "pos"], known)
    return got.select("file", F.substring("step", 5, 9).cast("long").alias("nth"), "condition")


# --- registries, keys, graphs, indexes -------------------------------------


@registered("WITH c AS (SELECT conv_id, turn, text, sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS row FROM conversations) SELECT conv_id, row, string_agg(text, ' ' ORDER BY turn) AS body FROM c WHERE row > 0 GROUP BY 1, 2")
def registry_rows(spark, sf_dir):
    """Rows that reach up to the start of the next."""
    return extract.registry(read(spark, sf_dir, "conversations"), ["conv_id"], "turn", F.col("role") == "user", "text")


@registered("SELECT o_custkey AS k, 'orders' AS source FROM orders GROUP BY 1 UNION ALL SELECT c_custkey, 'customer' FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def progress_tables(spark, sf_dir):
    """Of two tables the first that has a key."""
    one = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"), F.lit("orders").alias("source"))
    return extract.first_table_wins([one, read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.lit("customer").alias("source"))], "k")


@registered("""WITH e AS (SELECT p_partkey, 0 AS kind, regexp_replace(lower(p_name), '[^a-z0-9]', '', 'g') AS key FROM part UNION ALL SELECT p_partkey, 1, regexp_replace(lower(p_type), '[^a-z0-9]', '', 'g') FROM part UNION ALL SELECT p_partkey, 2, lower(p_brand) FROM part)
  SELECT key, arg_min(p_partkey, kind * 100000000 + p_partkey) AS p_partkey FROM e GROUP BY key""")
def key_aliases(spark, sf_dir):
    """Every name under its keys, the most specific first, the first to register a key keeping it."""
    keys = [extract.squashed_keys(F.col("p_name"))[0], extract.squashed_keys(F.col("p_type"))[0], F.lower("p_brand")]
    part = read(spark, sf_dir, "part").withColumn("order", F.col("p_partkey"))
    return extract.aliased_keys(part, "p_partkey", keys, "order").select("key", "p_partkey")


_EDGES = "SELECT n_nationkey AS a, (n_nationkey * 2 + 1) % 25 AS b FROM nation UNION SELECT n_nationkey, n_regionkey FROM nation"


@registered(f"WITH RECURSIVE e AS ({_EDGES}), r AS (SELECT n_nationkey AS start, n_nationkey AS node, 0 AS depth FROM nation UNION SELECT r.start, e.b, r.depth + 1 FROM r JOIN e ON r.node = e.a WHERE r.depth < 25) SELECT start, node, min(depth) AS depth, false AS cut FROM r GROUP BY 1, 2")
def reachable_nations(spark, sf_dir):
    """All that can be reached over links, each at its least depth."""
    n = read(spark, sf_dir, "nation")
    edges = n.select(F.col("n_nationkey").alias("a"), ((F.col("n_nationkey") * 2 + 1) % 25).alias("b")).unionByName(n.select(F.col("n_nationkey").alias("a"), F.col("n_regionkey").alias("b")))
    return extract.reachable(edges, "a", "b", n.select(F.col("n_nationkey").alias("start")))


_NODES = """SELECT 'r' || r_regionkey AS node, NULL AS parent, r_regionkey AS pos FROM region UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey, n_nationkey FROM nation UNION ALL SELECT 's' || s_suppkey, 'n' || s_nationkey, s_suppkey FROM supplier"""


@registered(f"WITH RECURSIVE t AS ({_NODES}), w AS (SELECT node, [CAST(pos AS BIGINT)] AS path, 0::BIGINT AS depth FROM t WHERE parent IS NULL UNION ALL SELECT t.node, list_append(w.path, CAST(t.pos AS BIGINT)), w.depth + 1 FROM w JOIN t ON t.parent = w.node) SELECT node, row_number() OVER (ORDER BY path, node) - 1 AS place, depth FROM w")
def tree_flatten(spark, sf_dir):
    """Regions, their nations and their suppliers in pre-order."""
    r, n, s = (read(spark, sf_dir, t) for t in ("region", "nation", "supplier"))
    rows = [
        r.select(said("r", c("r_regionkey")).alias("node"), F.lit(None).cast("string").alias("parent"), c("r_regionkey").cast("long").alias("pos")),
        n.select(said("n", c("n_nationkey")).alias("node"), said("r", c("n_regionkey")).alias("parent"), c("n_nationkey").cast("long").alias("pos")),
        s.select(said("s", c("s_suppkey")).alias("node"), said("n", c("s_nationkey")).alias("parent"), c("s_suppkey").cast("long").alias("pos")),
    ]
    return extract.preorder(rows[0].unionByName(rows[1]).unionByName(rows[2]))


@registered("SELECT user_id, event_type, string_agg(DISTINCT pos, ',' ORDER BY pos) AS positions FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos FROM events) GROUP BY 1, 2")
def event_positions(spark, sf_dir):
    """The sorted positions at which a thing occurs."""
    rows = step_events(spark, sf_dir).withColumn("key", F.struct("user_id", "event_type"))
    return extract.positions(rows, "key", "pos").select("key.user_id", "key.event_type", F.array_join("values", ",").alias("positions"))


@registered("SELECT p_partkey AS thing, string_agg(DISTINCT l_suppkey, ',' ORDER BY l_suppkey) AS points, count(DISTINCT l_suppkey) > 1 AS ambiguous FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1")
def id_coordinates(spark, sf_dir):
    """Where a thing is found, and whether in several places."""
    got = extract.coordinates(read(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("thing"), "l_suppkey"), "thing", "l_suppkey")
    return got.select("thing", F.array_join("points", ",").alias("points"), "ambiguous")


@registered("SELECT l_orderkey AS name, string_agg(k, ',' ORDER BY ord, k) AS ids FROM (SELECT l_orderkey, l_partkey AS k, min(l_linenumber) AS ord FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_size > 10 GROUP BY 1, 2) GROUP BY 1")
def collection_members(spark, sf_dir):
    """Named lists to known ids in order, each once."""
    lists = read(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("name")).agg(F.transform(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey"))), lambda x: said("K", x["l_partkey"])).alias("list"))
    known = read(spark, sf_dir, "part").where("p_size > 10").select(said("K", c("p_partkey")).alias("constant"), c("p_partkey").alias("id"))
    return extract.members(lists, "name", "list", known).select("name", F.array_join("ids", ",").alias("ids"))


@registered("SELECT p_size, string_agg(p_type, ';' ORDER BY p_type) AS texts FROM (SELECT DISTINCT p_size, p_type, dense_rank() OVER (PARTITION BY p_size ORDER BY p_type) AS n FROM part) WHERE n <= 4 GROUP BY 1")
def place_hints(spark, sf_dir):
    """Up to four descriptions of a place."""
    return extract.hints(read(spark, sf_dir, "part"), "p_size", "p_type").select("p_size", F.array_join("texts", ";").alias("texts"))
