"""Registered queries of the merge: parts stand for steps, brands for entities, suppliers for sections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import loose, merge
from .codebase import said
from .registry import EVENTS, read, registered, step_events, step_lines

c = F.col

#: A brand's number gives an entity: its name, kind, ids and place.
_ENTITY = """ent AS (SELECT e, 'Maker ' || chr(CAST(65 + e AS INTEGER)) || 'x' AS name, CASE e % 4 WHEN 0 THEN 'item' WHEN 1 THEN 'npc' ELSE 'object' END AS kind, CASE WHEN e % 5 = 0 THEN [] ELSE [e, e + 100] END AS ids,
  CASE WHEN e % 3 = 0 THEN e || ',1,0' ELSE '' END AS points, e % 7 = 0 AS redirect FROM (SELECT DISTINCT CAST(regexp_extract(p_brand, '[0-9]+$') AS BIGINT) % 20 AS e FROM part))"""
_STEP = "st AS (SELECT p_partkey AS k, p_size AS s, p_name AS name, CAST(regexp_extract(p_brand, '[0-9]+$') AS BIGINT) % 20 AS e FROM part)"


def number() -> Column:
    return F.regexp_extract("p_brand", "[0-9]+$", 0).cast("long") % 20


def maker(e: Column) -> Column:
    return F.concat(F.lit("Maker "), F.chr(F.lit(65) + e), F.lit("x"))


def entities(spark, sf_dir) -> DataFrame:
    e = read(spark, sf_dir, "part").select(number().alias("e")).distinct()
    none = F.expr(merge.NO_IDS)
    place = F.when(c("e") % 3 == 0, F.array(F.array(c("e").cast("int"), F.lit(1), F.lit(0)))).otherwise(F.expr(merge.NO_POINTS))
    kind = F.when(c("e") % 4 == 0, "item").when(c("e") % 4 == 1, "npc").otherwise("object")
    return e.select("e", maker(c("e")).alias("name"), kind.alias("kind"), F.when(c("e") % 5 == 0, none).otherwise(F.array("e", c("e") + 100)).alias("ids"), place.alias("points"), F.lit("p").alias("page"), (c("e") % 7 == 0).alias("via_redirect"))


def flat(points: Column) -> Column:
    return F.array_join(F.transform(points, lambda p: F.array_join(p.cast("array<string>"), ",")), ";")


@registered(rf"""WITH {_ENTITY}, {_STEP}, b AS (SELECT *, CASE s % 4 WHEN 0 THEN NULL WHEN 1 THEN 'Nobody' ELSE 'Maker ' || chr(CAST(65 + e AS INTEGER)) || 'x' END AS target, CASE WHEN s % 8 = 0 THEN 'Maker ' || chr(CAST(65 + (e + 1) % 20 AS INTEGER)) || 'x' END AS link,
    CASE WHEN s % 5 = 0 THEN 'Maker ' || chr(CAST(65 + (e + 2) % 20 AS INTEGER)) || 'x' END AS seller FROM st),
  o AS (SELECT k, coalesce(t.name, l.name) AS name, coalesce(t.kind, l.kind) AS kind, coalesce(t.e, l.e) AS e, CASE WHEN t.name IS NULL THEN 'linked' WHEN t.redirect THEN 'wiki-redirect' ELSE 'wiki-exact' END AS confidence
    FROM b LEFT JOIN ent t ON t.name = target LEFT JOIN ent l ON l.name = link WHERE t.name IS NOT NULL OR l.name IS NOT NULL),
  p AS (SELECT o.k, o.name, o.kind, ent.ids, CASE WHEN ent.points <> '' THEN ent.points WHEN o.e % 5 <> 0 THEN o.e || ',2,0' || ';' || o.e || ',3,0' ELSE '' END AS points, CASE WHEN ent.points <> '' THEN 'wiki' WHEN o.e % 5 <> 0 THEN 'atlas' END AS point_source, confidence FROM o JOIN ent USING (e)),
  r AS (SELECT * FROM b WHERE k NOT IN (SELECT k FROM o)),
  m AS (SELECT k, CASE WHEN contains(name, 'small') THEN 'Maker Bx/Maker Cx' ELSE 'Maker Dx' END AS name, CASE WHEN contains(name, 'small') THEN 'npc' ELSE 'object' END AS kind, CASE WHEN contains(name, 'small') THEN [1, 101, 2, 102] ELSE [3, 103] END AS ids,
    CASE WHEN contains(name, 'small') THEN '' ELSE '3,1,0' END AS points, NULL AS point_source, 'manual' AS confidence FROM r WHERE s % 5 <> 0 AND (contains(name, 'small') OR contains(name, 'red'))),
  i AS (SELECT k, target AS name, 'nav' AS kind, [] AS ids, '' AS points, NULL AS point_source, 'inferred' AS confidence FROM r WHERE k NOT IN (SELECT k FROM m) AND target IS NOT NULL AND s % 3 <> 0),
  f AS (SELECT * FROM p UNION ALL SELECT * FROM m UNION ALL SELECT * FROM i),
  g AS (SELECT coalesce(f.k, b.k) AS k, f.*EXCLUDE (k), x.name AS s_name, x.ids AS s_ids, x.points AS s_points FROM b LEFT JOIN ent x ON x.name = seller AND x.kind = 'npc' AND len(x.ids) > 0 LEFT JOIN f ON f.k = b.k)
  SELECT k, CASE WHEN s_name IS NOT NULL AND coalesce(kind, '') <> 'npc' THEN s_name ELSE name END AS name, CASE WHEN s_name IS NOT NULL THEN 'npc' ELSE kind END AS kind, array_to_string(CASE WHEN s_name IS NOT NULL AND coalesce(kind, '') <> 'npc' THEN s_ids ELSE ids END, ',') AS ids,
    CASE WHEN s_name IS NOT NULL AND coalesce(kind, '') <> 'npc' THEN s_points ELSE points END AS points, CASE WHEN s_name IS NOT NULL AND coalesce(kind, '') <> 'npc' THEN NULL ELSE point_source END AS point_source,
    CASE WHEN s_name IS NOT NULL AND coalesce(kind, '') <> 'npc' THEN 'wiki-exact' ELSE confidence END AS confidence FROM g WHERE s_name IS NOT NULL OR name IS NOT NULL""")
def step_targets(spark, sf_dir):
    """The whole cascade of a step's target: names and links, places, phrases, the bare name, the seller."""
    e, s = number(), c("p_size")
    target = F.when(s % 4 == 0, None).when(s % 4 == 1, "Nobody").otherwise(maker(e))
    raw = F.when(s % 5 == 0, F.concat(F.lit("Buy it from "), maker((e + 2) % 20), F.lit(", and go"))).otherwise(F.concat(F.lit("Look at the "), F.upper("p_name")))
    steps = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("step"), raw.alias("raw"), target.alias("target_name"), F.when(s % 8 == 0, F.array(maker((e + 1) % 20))).alias("links"), F.when(s % 3 == 0, "quest").otherwise("nav").alias("intent"))
    known = entities(spark, sf_dir)
    atlas = known.select("kind", F.explode("ids").alias("id")).where("id < 100").select("kind", "id", F.array(*[F.array(c("id").cast("int"), F.lit(n), F.lit(0)) for n in (2, 3)]).alias("points"), F.lit(False).alias("ambiguous"))
    phrases = spark.createDataFrame([("red", 1, ["Maker Dx"]), ("Small", 0, ["Maker Bx", "Maker Cx"])], "phrase string, pos int, names array<string>")
    got = merge.targets(steps, known, atlas, phrases)
    return got.select(c("step").alias("k"), "name", "kind", F.array_join("ids", ",").alias("ids"), flat(c("points")).alias("points"), "point_source", "confidence")


@registered("SELECT l_orderkey, l_linenumber, l_partkey, p_size, s_name FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size > 20) ON l_partkey = p_partkey LEFT JOIN (SELECT * FROM supplier WHERE s_suppkey % 2 = 0) ON l_suppkey = s_suppkey")
def attached_rows(spark, sf_dir):
    """Rows of dimensions by key, each at most once."""
    part = read(spark, sf_dir, "part").where("p_size > 20").select(c("p_partkey").alias("l_partkey"), "p_size")
    one = merge.attached(read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), "l_partkey", part)
    two = merge.attached(one, "l_suppkey", read(spark, sf_dir, "supplier").where("s_suppkey % 2 = 0").select(c("s_suppkey").alias("l_suppkey"), "s_name"))
    return two.select("l_orderkey", "l_linenumber", "l_partkey", "p_size", "s_name")


@registered("SELECT e.event_id, t.task FROM events e LEFT JOIN (SELECT user_id, event_type, min(event_id) AS task FROM events WHERE value > 50 GROUP BY 1, 2) t ON e.user_id = t.user_id AND e.event_type = t.event_type")
def composite_tasks(spark, sf_dir):
    """A task by a key of two parts, the first of several."""
    e = read(spark, sf_dir, "events")
    tasks = e.where("value > 50").groupBy("user_id", "event_type").agg(F.min("event_id").alias("task"))
    return merge.attached(e.select("event_id", "user_id", "event_type"), ["user_id", "event_type"], tasks).select("event_id", "task")


_ITEMS = """x AS (SELECT p_partkey AS k, p_size AS s, p_name AS n FROM part), ex AS (SELECT n, min(k) AS id FROM x WHERE k % 3 <> 0 GROUP BY n), co AS (SELECT n, min(k) AS id FROM x WHERE k % 7 = 0 GROUP BY n)"""


@registered(f"""WITH {_ITEMS} SELECT x.k, CASE WHEN s % 4 = 3 THEN 'unresolved' WHEN co.id IS NOT NULL AND s % 4 = 0 THEN 'collection' WHEN s % 4 = 0 AND ex.id IS NOT NULL THEN 'item' WHEN s % 4 = 1 AND ex.id IS NOT NULL THEN 'stem' WHEN s % 4 = 2 AND (ex.id IS NOT NULL OR co.id IS NOT NULL) THEN 'shortened' ELSE 'unresolved' END AS source,
  CASE WHEN s % 4 = 3 THEN '' WHEN co.id IS NOT NULL AND s % 4 = 0 THEN co.id || ',-1' WHEN s % 4 IN (0, 1, 2) AND ex.id IS NOT NULL THEN ex.id::VARCHAR WHEN s % 4 = 2 AND co.id IS NOT NULL THEN co.id || ',-1' ELSE '' END AS ids FROM x LEFT JOIN ex ON x.n = ex.n LEFT JOIN co ON x.n = co.n""")
def item_names(spark, sf_dir):
    """Goods to ids: a listed collection, behind "Empty", the item, without its place, none."""
    p = read(spark, sf_dir, "part")
    s = c("p_size") % 4
    mentions = p.select(c("p_partkey").alias("k"), F.when(s == 0, c("p_name")).when(s == 1, F.concat(F.lit("Empty "), "p_name")).when(s == 2, F.concat("p_name", F.lit(" inside the Longhall."))).otherwise(F.concat(F.lit("no "), "p_name")).alias("name"))
    known = p.where("p_partkey % 3 <> 0").groupBy(c("p_name").alias("name")).agg(F.min("p_partkey").alias("id")).select("name", F.lit("item").alias("kind"), F.array("id").alias("ids"))
    lists = p.where("p_partkey % 7 = 0").groupBy(c("p_name").alias("collection")).agg(F.min("p_partkey").alias("id"))
    shelf = lists.select(F.concat(F.lit("shelf "), "collection").alias("name"), F.array("id", F.lit(-1).cast("long")).alias("ids"))
    collections = merge.collection_ids(lists.select("collection", F.array(F.concat(F.lit("shelf "), "collection")).alias("names")), shelf, known)
    got = merge.item_ids(mentions, "k", "name", collections, known)
    return got.select("k", "source", F.array_join("ids", ",").alias("ids"))


@registered("SELECT l_orderkey AS collection, CASE WHEN bool_and(p_size > 3) THEN string_agg(DISTINCT l_partkey, ',' ORDER BY l_partkey) END AS ids FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1")
def whole_collections(spark, sf_dir):
    """The ids of all members of a list, or of none."""
    lists = read(spark, sf_dir, "lineitem").groupBy(c("l_orderkey").alias("collection")).agg(F.array_sort(F.collect_set("l_partkey")).cast("array<string>").alias("names"))
    known = read(spark, sf_dir, "part").where("p_size > 3").select(c("p_partkey").cast("string").alias("name"), F.array("p_partkey").alias("ids"))
    got = merge.collection_ids(lists, known.where("false"), known)
    return got.select("collection", F.array_join(F.array_sort("ids"), ",").alias("ids"))


_TAG = "CASE WHEN s % 6 = 0 THEN upper(n) WHEN s % 6 = 1 THEN 'tag ' || s WHEN s % 6 = 2 THEN replace(n, ' ', '''-') WHEN s % 6 = 3 THEN 'Easy diary ' || (s % 4) WHEN s % 6 = 4 THEN 'Diary x' ELSE 'unknown ' || n END"


@registered(rf"""WITH q AS (SELECT DISTINCT p_name AS quest FROM part WHERE p_partkey % 2 = 0), al AS (SELECT 'tag ' || s AS written, quest FROM (SELECT p_size AS s, min(p_name) AS quest FROM part WHERE p_partkey % 2 = 0 GROUP BY 1)),
  t AS (SELECT p_partkey AS k, p_size AS s, p_name AS n, {_TAG.replace("(s % 4)", "(p_size % 4)")} AS tag FROM (SELECT *, p_size AS s, p_name AS n FROM part)),
  j AS (SELECT t.*, al.quest AS a, coalesce(lower(al.quest), regexp_replace(lower(trim(tag)), '\s+', ' ', 'g')) AS by_name FROM t LEFT JOIN al ON lower(written) = lower(tag)),
  m AS (SELECT j.*, e.quest AS exact, CASE WHEN e.quest IS NULL THEN l.quest END AS letters FROM j LEFT JOIN (SELECT lower(quest) AS lq, min(quest) AS quest FROM q GROUP BY 1) e ON by_name = lq
    LEFT JOIN (SELECT regexp_replace(lower(quest), '[^a-z0-9]', '', 'g') AS z, min(quest) AS quest FROM q GROUP BY 1 HAVING length(z) >= 10) l ON z = regexp_replace(lower(tag), '[^a-z0-9]', '', 'g'))
  SELECT k, CASE WHEN exact IS NULL AND letters IS NULL AND tag = 'Diary x' THEN 'Real diary' ELSE tag END AS tag, coalesce(exact, letters) AS quest, CASE WHEN a IS NOT NULL AND exact IS NOT NULL THEN 'alias' WHEN exact IS NOT NULL THEN 'exact' WHEN letters IS NOT NULL THEN 'letters' WHEN contains(lower(tag), 'diary') THEN 'diary' ELSE 'unresolved' END AS via FROM m""")
def quest_tags(spark, sf_dir):
    """Tags to quests: alias, name, letters, diary, none."""
    p = read(spark, sf_dir, "part")
    s, n = c("p_size"), c("p_name")
    tag = F.when(s % 6 == 0, F.upper(n)).when(s % 6 == 1, said("tag ", s)).when(s % 6 == 2, F.replace(n, F.lit(" "), F.lit("'-"))).when(s % 6 == 3, said("Easy diary ", s % 4)).when(s % 6 == 4, F.lit("Diary x")).otherwise(said("unknown ", n))
    even = p.where("p_partkey % 2 = 0")
    aliases = even.groupBy("p_size").agg(F.min("p_name").alias("quest")).select(said("tag ", s).alias("written"), "quest")
    diaries = spark.createDataFrame([("Diary x", "Real diary")], "written string, real string")
    return merge.tagged(p.select(c("p_partkey").alias("k"), tag.alias("tag")), "k", "tag", even.select(n.alias("quest")).distinct(), aliases, diaries)


_NAMES = ["the", "of the", "and", "Ation And", "entionand", "inging the"]


@registered(rf"""WITH q(quest) AS (VALUES {", ".join(f"('{n}')" for n in _NAMES)}), l AS (SELECT doc_id, line_no, line, lower(line) AS low, regexp_replace(lower(line), '[^a-z0-9]', '', 'g') AS z FROM (SELECT doc_id, unnest(range(len(l))) AS line_no, trim(unnest(l), ' ') AS line FROM (SELECT doc_id, string_split(replace(text, chr(13) || chr(10), chr(10)), chr(10)) AS l FROM documents))),
  h AS (SELECT doc_id, line_no, quest FROM l, q WHERE contains(low, lower(quest)) OR length(regexp_replace(lower(quest), '[^a-z0-9]', '', 'g')) >= 10 AND contains(z, regexp_replace(lower(quest), '[^a-z0-9]', '', 'g')) QUALIFY row_number() OVER (PARTITION BY doc_id, line_no ORDER BY length(quest) DESC, quest) = 1),
  a AS (SELECT doc_id, line_no, 'German' AS quest FROM l WHERE regexp_matches(low, 'der(?:[^\w]|$)') AND NOT EXISTS (SELECT 1 FROM h WHERE h.doc_id = l.doc_id AND h.line_no = l.line_no))
  SELECT * FROM h UNION ALL SELECT * FROM a""")
def prose_quests(spark, sf_dir):
    """The longest name in a line's words or letters, else an alias that ends a word."""
    quests = spark.createDataFrame([(n,) for n in _NAMES], "quest string")
    aliases = spark.createDataFrame([("der", "German")], "written string, quest string")
    rows = step_lines(spark, sf_dir).withColumn("key", F.struct("doc_id", "line_no"))
    return merge.quest_in_prose(rows, "key", "line", quests, aliases).select("key.doc_id", "key.line_no", "quest")


@registered("SELECT n_nationkey, CASE n_nationkey % 3 WHEN 0 THEN 'TELEPORT_HOME_STANDARD' WHEN 1 THEN CASE WHEN n_nationkey % 2 = 0 THEN 'SPELL_' || n_nationkey END END AS spell, CASE n_nationkey % 3 WHEN 0 THEN 1 WHEN 1 THEN CASE WHEN n_nationkey % 2 = 0 THEN n_nationkey END END AS widget FROM nation")
def step_spells(spark, sf_dir):
    """The spell that a step casts: home by its words, else by its destination."""
    n = read(spark, sf_dir, "nation")
    k = c("n_nationkey") % 3
    steps = n.select("n_nationkey", c("n_name").alias("place"), F.when(k == 0, F.lit("Home teleport to Town")).when(k == 1, said("Teleport to ", c("n_name"))).otherwise(said("Teleport to ", c("n_name"), " with a tab")).alias("raw"))
    by_place = n.select(c("n_name").alias("place"), said("SPELL_", c("n_nationkey")).alias("spell"))
    widgets = n.where("n_nationkey % 2 = 0").select(said("SPELL_", c("n_nationkey")).alias("spell"), c("n_nationkey").alias("widget")).unionByName(spark.createDataFrame([("TELEPORT_HOME_STANDARD", 1)], "spell string, widget int"))
    return merge.spells(steps, "place", "raw", by_place, widgets).select("n_nationkey", "spell", "widget")


@registered("WITH x AS (SELECT p_partkey AS k, p_size AS s, p_name AS n, regexp_extract(p_name, '\\S+$') AS noun, regexp_extract(p_name, '^\\S+') AS lead FROM part) SELECT k, CASE WHEN s % 3 = 0 THEN '9' WHEN s % 3 = 1 AND length(noun) > 0 AND NOT ends_with(lead, noun) THEN k::VARCHAR END AS ids FROM x")
def used_things(spark, sf_dir):
    """What a sentence says to use: listed, else the only own item that the noun fits."""
    p = read(spark, sf_dir, "part")
    noun, lead = F.regexp_extract("p_name", r"\S+$", 0), F.regexp_extract("p_name", r"^\S+", 0)
    text = F.when(c("p_size") % 3 == 0, F.lit("Known.")).when(c("p_size") % 3 == 1, said("Go and use the ", noun, " on the coffin")).otherwise(said("Look at the ", noun))
    rows = p.select(c("p_partkey").alias("k"), text.alias("text"))
    items = p.select(c("p_partkey").alias("k"), c("p_name").alias("name"), F.array("p_partkey").alias("ids")).unionByName(p.select(c("p_partkey").alias("k"), lead.alias("name"), F.array(c("p_partkey") + 100000).alias("ids")))
    by_text = spark.createDataFrame([("Known.", [9])], "text string, ids array<bigint>")
    return merge.used_items(rows, "k", "text", items, by_text).select("k", F.array_join("ids", ",").alias("ids"))


@registered("WITH t AS (SELECT DISTINCT l_orderkey AS q, l_returnflag AS side FROM lineitem), n AS (SELECT DISTINCT l_orderkey AS q, l_linestatus AS i, f.f AS note FROM lineitem, (VALUES ('A'), ('N')) f(f)) SELECT n.q, i, min(note) AS note FROM n JOIN t ON n.q = t.q AND n.note = t.side GROUP BY 1, 2 HAVING count(*) = 1")
def route_sides(spark, sf_dir):
    """The only note of an instruction that a tag names."""
    line = read(spark, sf_dir, "lineitem")
    tags = line.select(c("l_orderkey").alias("quest"), said("(", F.lower("l_returnflag"), ")").alias("tag"))
    notes = line.select(c("l_orderkey").alias("quest"), c("l_linestatus").alias("instruction"), F.explode(F.array(F.lit("A"), F.lit("N"))).alias("note")).distinct()
    return merge.chosen_sides(tags, notes).select(c("quest").alias("q"), c("instruction").alias("i"), "note")


@registered("SELECT p_partkey AS k, CASE WHEN p_size % 2 = 0 AND p_partkey % 3 <> 0 THEN (p_partkey + 1) || ',' || (p_partkey + 2) ELSE p_partkey::VARCHAR END AS ids FROM part")
def noted_substitutes(spark, sf_dir):
    """Substitutes only where the author's own note names one."""
    p = read(spark, sf_dir, "part")
    raw = F.when(c("p_size") % 2 == 0, said("Buy it (or the ", c("p_name"), ") now (Sure)")).otherwise(said("Buy it (or nothing)"))
    subs = p.where("p_partkey % 3 <> 0").select(c("p_partkey").alias("id"), F.array(said("OR the ", F.upper("p_name")), F.lit("other")).alias("notes"), F.array(c("p_partkey") + 2, c("p_partkey") + 1).alias("other_ids"))
    got = merge.noted_substitutes(p.select(c("p_partkey").alias("k"), raw.alias("raw"), F.array("p_partkey").alias("ids")), "k", "raw", subs)
    return got.select("k", F.array_join("ids", ",").alias("ids"))


@registered("SELECT s_suppkey, s_name FROM supplier WHERE s_suppkey IN (SELECT l_suppkey FROM lineitem WHERE l_quantity > 45 UNION SELECT l_suppkey FROM lineitem WHERE l_quantity < 2)")
def referenced_rows(spark, sf_dir):
    """Only rows that are referred to, from several places; an unknown reference is an error."""
    line = read(spark, sf_dir, "lineitem")
    return merge.referenced(read(spark, sf_dir, "supplier").select("s_suppkey", "s_name"), "s_suppkey", line.where("l_quantity > 45").select("l_suppkey"), line.where("l_quantity < 2").select("l_suppkey"))


_ACTION = """p AS (SELECT p_partkey AS k, p_size AS s, p_name AS n FROM part), i AS (SELECT n, min(k) AS id FROM p WHERE k % 4 <> 0 GROUP BY n HAVING count(DISTINCT k % 5) = 1)"""


@registered(f"""WITH {_ACTION}, r AS (SELECT n, min(k) AS k FROM p WHERE k % 2 = 0 GROUP BY n HAVING count(*) = 1), bk AS (SELECT DISTINCT n FROM p WHERE k % 2 = 0), rr AS (SELECT r.n, i.id FROM r JOIN i ON i.n = r.n)
  SELECT p.k, CASE WHEN s % 5 = 0 AND rr.id IS NOT NULL THEN 'recipe' WHEN s % 5 IN (1, 2) AND i.id IS NOT NULL THEN 'interact' END AS kind, CASE WHEN s % 5 = 0 AND rr.id IS NOT NULL THEN (rr.id % 5)::VARCHAR WHEN s % 5 IN (1, 2) AND i.id IS NOT NULL THEN (i.id % 5)::VARCHAR END AS ids,
    CASE WHEN s % 5 = 0 AND bk.n IS NULL THEN 'recipe is not verified' WHEN s % 5 = 0 AND rr.id IS NULL THEN 'something in the recipe is unknown' WHEN s % 5 = 1 AND i.id IS NULL THEN 'nothing named is an item' WHEN s % 5 = 1 THEN 'unknown: door' WHEN s % 5 = 2 AND i.id IS NULL THEN 'nothing named is an item' WHEN s % 5 = 3 THEN 'water' END AS reason
  FROM p LEFT JOIN i ON i.n = p.n LEFT JOIN rr ON rr.n = p.n LEFT JOIN bk ON bk.n = p.n""")
def inventory_actions(spark, sf_dir):
    """What a step does to things held, or why that is not sure."""
    p = read(spark, sf_dir, "part")
    s, n = c("p_size") % 5, c("p_name")
    raw = F.when(s == 0, said("Make 2x ", n, ".")).when(s == 1, said("Use the ", n, " on Door then go")).when(s == 2, said("Wear 1x ", n)).when(s == 3, said("Fill jug of water ", n)).otherwise(said("Look at ", n))
    known = merge.exact_items(p.where("p_partkey % 4 <> 0").select(n.alias("name"), F.lit("item").alias("kind"), F.array(c("p_partkey") % 5).alias("ids")))
    book = p.where("p_partkey % 2 = 0").select(n.alias("product"), F.array(n).alias("names"))
    got = merge.inventory_actions(p.select(c("p_partkey").alias("k"), raw.alias("raw")), "k", "raw", known, merge.recipes(book, known), book.select(T.collapsed(c("product")).alias("item_key")))
    return got.select("k", "kind", F.array_join("ids", ",").alias("ids"), "reason")


@registered("""WITH i AS (SELECT l_orderkey AS q, l_partkey AS k, min(l_linenumber) AS m FROM lineitem GROUP BY 1, 2), o AS (SELECT q, min(k) AS a, max(k) AS b, count(*) AS n FROM i GROUP BY 1)
  SELECT q, CASE WHEN q % 4 = 0 THEN a::VARCHAR WHEN q % 4 = 1 AND a <> b THEN a || ',' || b WHEN q % 4 = 2 THEN NULL WHEN q % 4 = 3 THEN a::VARCHAR END AS ids, CASE WHEN q % 4 = 1 AND a <> b THEN 2 WHEN q % 4 IN (0, 3) THEN 1 END AS n FROM o""")
def stop_goods(spark, sf_dir):
    """The goods at which a step stops: one name, or all parts of a list."""
    i = read(spark, sf_dir, "lineitem").select(c("l_orderkey").alias("quest"), c("l_partkey").alias("k")).distinct()
    items = i.select("quest", said("Item'", c("k")).alias("name"), F.array("k").alias("ids"))
    o = i.groupBy("quest").agg(F.min("k").alias("a"), F.max("k").alias("b"))
    q = c("quest") % 4
    phrase = F.when(q == 0, said("the item", c("a"), "! [note]")).when(q == 1, said("3x Item", c("a"), " and an item", c("b"))).when(q == 2, said("item", c("a"), ", nothing")).otherwise(said("5 ITEM", c("a")))
    got = merge.stop_items(o.select("quest", phrase.alias("phrase")).withColumn("key", c("quest")), "key", "quest", "phrase", items)
    return got.select(c("key").alias("q"), F.array_join("ids", ",").alias("ids"), "n")


@registered("SELECT c_custkey AS k, CASE c_custkey % 3 WHEN 0 THEN min(o_orderkey) WHEN 1 THEN max(o_orderkey) END AS place FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY 1 HAVING c_custkey % 3 < 2")
def step_starters(spark, sf_dir):
    """The person of a quest's beginning that a step talks to, by id or by the spoken name."""
    orders = read(spark, sf_dir, "orders").select(c("o_custkey").alias("quest"), c("o_orderkey").alias("place"))
    instructions = orders.select("quest", "place", said("Talk to Mr O'", c("place"), " in the hall.").alias("text"), F.array("place").alias("ids"))
    ends = orders.groupBy("quest").agg(F.min("place").alias("a"), F.max("place").alias("b"))
    k = c("quest") % 3
    text = F.when(k == 0, F.lit("Start it")).when(k == 1, said("Begin by talking to mr O", c("b"), " (first floor)")).otherwise(F.lit("Start it by talking to Nobody"))
    steps = ends.select("quest", text.alias("text"), F.when(k == 0, F.array("a", "b")).otherwise(F.expr(merge.NO_IDS)).alias("ids")).withColumn("key", c("quest"))
    return merge.starters(steps, "key", "quest", "text", "ids", instructions).select(c("key").alias("k"), "place")


@registered(f"""WITH e AS (SELECT *, CASE event_type WHEN 'click' THEN 'start' WHEN 'purchase' THEN 'until' WHEN 'error' THEN 'finish' WHEN 'signup' THEN 'bare' ELSE 'other' END AS kind, event_id % 4 <> 0 AS has_quest, CASE WHEN event_id % 3 <> 0 THEN event_id % 50 END AS v FROM ({EVENTS})),
  n AS (SELECT *, coalesce(lead(kind = 'finish') OVER w AND lead(has_quest) OVER w AND has_quest, false) AS goes_on FROM e WINDOW w AS (PARTITION BY user_id ORDER BY pos))
  SELECT event_id, has_quest AND kind IN ('finish', 'until') AS follow, has_quest AND kind = 'until' AND event_id % 2 = 0 AS stop_unresolved, has_quest AND v IS NOT NULL AND (kind = 'start' OR kind = 'bare' AND goes_on) AS start_only,
    CASE WHEN has_quest AND v IS NOT NULL AND (kind = 'start' OR kind = 'bare' AND goes_on) THEN v END AS done_at FROM n""")
def explicit_milestones(spark, sf_dir):
    """Stated ends of steps: starts that end by themselves, stops at goods, visits that follow the quest."""
    kind = c("event_type")
    text = F.when(kind == "click", "Talk to Bob to start X (kill a rat)").when(kind == "purchase", "Start X until you get wood").when(kind == "error", "Continue X").when(kind == "signup", "Start X").otherwise("Walk")
    rows = step_events(spark, sf_dir).select("event_id", "user_id", "pos", text.alias("text"), F.when(c("event_id") % 4 != 0, "X").alias("quest"), F.when(c("event_id") % 3 != 0, c("event_id") % 50).alias("v"), F.when(kind == "purchase", "wood").alias("stop"))
    rows = rows.withColumn("ids", F.when(c("event_id") % 2 == 1, F.array(F.lit(1))))
    got = merge.milestones(rows, ["user_id"], "pos", "text", "quest", "v", "stop", "ids")
    return got.select("event_id", "follow", "stop_unresolved", "start_only", "done_at")


_PHRASES = "SELECT DISTINCT item_id, lower(regexp_extract(text, '^(\\S+ \\S+)', 1)) AS phrase FROM benchmark WHERE text IS NOT NULL"


@registered(rf"WITH b AS ({_PHRASES}) SELECT item_id, doc_id FROM b, documents WHERE phrase <> '' AND contains(lower(text), phrase) QUALIFY row_number() OVER (PARTITION BY phrase, item_id ORDER BY doc_id) <= 4")
def loose_contains_review(spark, sf_dir):
    """Where the opening words of an item occur in documents, for a person to look at: the first few of each."""
    phrase = F.lower(F.regexp_extract("text", r"^(\S+ \S+)", 1)).alias("phrase")
    items = read(spark, sf_dir, "benchmark").where("text is not null").select("item_id", phrase).where("phrase <> ''")
    met = loose.containing(read(spark, sf_dir, "documents").select("doc_id", "text"), "text", items, "phrase")
    n = F.row_number().over(Window.partitionBy("item_id").orderBy("doc_id"))
    return met.withColumn("n", n).where("n <= 4").select("item_id", "doc_id")


@registered(r"""WITH l AS (SELECT doc_id, unnest(range(len(l))) AS line_no, trim(unnest(l), ' ') AS line FROM (SELECT doc_id, string_split(replace(text, chr(13) || chr(10), chr(10)), chr(10)) AS l FROM documents))
  SELECT w.word, doc_id, line_no, row_number() OVER (PARTITION BY w.word ORDER BY doc_id, line_no) AS place FROM l JOIN (VALUES ('the'), ('license'), ('of the')) w(word) ON regexp_matches(lower(line), '(^|[^\w])' || w.word || '([^\w]|$)') QUALIFY place <= 4""")
def name_usages(spark, sf_dir):
    """The first lines that use a name as whole words."""
    names = spark.createDataFrame([("the",), ("License",), ("of the",)], "word string")
    got = loose.usages(names, "word", step_lines(spark, sf_dir), "line", ["doc_id", "line_no"])
    return got.select(F.lower("word").alias("word"), "doc_id", "line_no", c("place").cast("long").alias("place"))


@registered()
def close_names(spark, sf_dir):
    """Parts of a type and size with names most alike, and the brands that come close to a misspelt one (J27, F16, W16); no SQL has this likeness."""
    p = read(spark, sf_dir, "part").select(F.concat_ws("|", "p_type", c("p_size").cast("string")).alias("block"), "p_partkey", "p_name")
    return loose.close_pairs(p, p, "block", "p_partkey", "p_name", 4, 0.62)
