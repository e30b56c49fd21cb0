"""Registered queries of the sentence rules: sentences made from the tables, whose parts the SQL knows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import annotate, goods, pages, sentences, verdicts
from ..functions import text as T
from ..operators import conditions, merge, travel
from .codebase import said
from .registry import read, registered

c = F.col


def title(name: Column) -> Column:
    """The first letter of a text in upper case."""
    return F.concat(F.upper(F.substring(name, 1, 1)), F.substring(name, 2, 1000))


@registered("SELECT l_orderkey, l_linenumber, unnest(range(3)) AS nth, unnest([l_partkey, l_suppkey, l_linenumber]) AS number FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem)")
def number_lists(spark, sf_dir):
    """Numbers in brackets as lists of whole numbers."""
    line = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").distinct()
    text = said("Choose (", c("l_partkey"), ", ", c("l_suppkey"), ",", c("l_linenumber"), ") here (or not) (a1)")
    return line.select("l_orderkey", "l_linenumber", F.posexplode(F.element_at(T.number_lists(text), 1)).alias("nth", "number")).withColumn("nth", c("nth").cast("long")).withColumn("number", c("number").cast("long"))


_P = "p AS (SELECT p_partkey AS k, p_size AS s, p_name AS n, upper(left(p_name, 1)) || substr(p_name, 2) AS t, regexp_extract(p_name, '^(\\S+)', 1) AS w FROM part)"


@registered(f"""WITH {_P} SELECT k, CASE WHEN s % 2 = 0 THEN CAST(s AS INTEGER) END AS slots, t || 'x' AS linked, CASE WHEN s % 3 = 0 THEN 'Bob' END AS whom, t AS used, 'Pump' AS used_on, CASE WHEN s % 3 <> 1 THEN t END AS via, CASE WHEN s % 3 <> 1 THEN 'Big Tower' END AS arrow_place,
  upper(left(w, 1)) || substr(w, 2) || ' Cloak' AS item, CASE WHEN s % 2 = 0 THEN 'Varrock' END AS item_to, CASE WHEN s % 4 = 0 THEN 'none' WHEN s % 4 = 1 THEN 'linked' ELSE 'inferred' END AS sure FROM p""")
def sentence_parts(spark, sf_dir):
    """Slots, linked spellings, persons, uses, arrows, teleport items, confidence."""
    p, s, t = read(spark, sf_dir, "part"), c("p_size"), title(c("p_name"))
    first = title(F.regexp_extract("p_name", r"^(\S+)", 1))
    slots = F.when(s % 2 == 0, said("Food (", s, " Inventory Slots)")).otherwise(F.lit("Food (many slots)"))
    whom = F.when(s % 3 == 0, F.lit("Check it on Bob")).when(s % 3 == 1, F.lit("Check it on bob")).otherwise(F.lit("On Bob -> X"))
    used = sentences.use_on(said("Use ", F.initcap("p_name"), " on Pump"))
    arrow = sentences.arrow(F.when(s % 3 == 1, said(t, " -> go there")).otherwise(said(t, " -> Big Tower")))
    item = sentences.teleport_item(F.when(s % 2 == 0, said(first, " Cloak to Varrock")).otherwise(said(first, " Cloak teleport and run")), ["head", "bank"])
    links = F.array(said(t, "x"), t.substr(F.lit(1), F.lit(3)))
    name = F.when(s % 4 == 0, None).otherwise(t)
    sure = sentences.confidence(name, F.when(s % 4 == 1, F.array(t)).otherwise(F.array(F.lit("?"))))
    return p.select(
        c("p_partkey").alias("k"), sentences.slot_count(slots).alias("slots"), sentences.linked_spelling(t, links).alias("linked"), sentences.on_whom(whom).alias("whom"),
        title(F.lower(used["item"])).alias("used"), used["thing"].alias("used_on"), arrow["via"].alias("via"), arrow["place"].alias("arrow_place"), item["item"].alias("item"), item["place"].alias("item_to"), sure.alias("sure"),
    )


@registered(f"""WITH {_P}, g AS (SELECT k, s, n, w, unnest(range(5)) AS nth FROM p)
  SELECT k, nth, CASE nth WHEN 0 THEN 'Big ' || n WHEN 1 THEN n WHEN 2 THEN 'raw ' || w WHEN 3 THEN 'raw meat' ELSE 'rope' END AS name, CAST(CASE nth WHEN 0 THEN 1200 WHEN 1 THEN nullif(s, 1) WHEN 4 THEN 100 END AS INTEGER) AS n FROM g""")
def goods_lists(spark, sf_dir):
    """Lists of goods with counts, notes, separators and shared words."""
    text = said("1,200 Big ", c("p_name"), " (3 Slots), ", c("p_size"), "x the [[x|", c("p_name"), "]] & raw ", F.regexp_extract("p_name", r"^(\S+)", 1), "/meat and 100+ rope, deposit the rest")
    items = read(spark, sf_dir, "part").select(c("p_partkey").alias("k"), F.posexplode(goods.goods(text)).alias("nth", "g"))
    return items.select("k", c("nth").cast("long").alias("nth"), c("g.name").alias("name"), c("g.count").alias("n"))


@registered(f"""WITH {_P} SELECT k, CASE s % 8 WHEN 0 THEN 'npc' WHEN 1 THEN 'item' WHEN 2 THEN 'object' WHEN 3 THEN 'item' WHEN 4 THEN 'npc' WHEN 5 THEN 'item' WHEN 6 THEN 'nav' ELSE 'bank' END AS intent,
  CASE s % 8 WHEN 0 THEN 'Jogre' WHEN 2 THEN t || ' tree' WHEN 4 THEN 'duck' END AS target, CASE WHEN s % 8 IN (0, 1, 3) THEN n WHEN s % 8 = 2 THEN t WHEN s % 8 = 5 THEN t END AS item, CASE s % 8 WHEN 0 THEN 'collects' WHEN 1 THEN 'collects' WHEN 2 THEN 'collects' WHEN 3 THEN 'buys' WHEN 5 THEN 'withdraw' END AS way,
  s % 8 IN (5, 7) AS banking, CASE WHEN s % 8 = 0 THEN 'Jogre' END AS link, CASE WHEN s % 8 = 6 THEN 'Brimhaven' END AS destination FROM p""")
def annotate_cases(spark, sf_dir):
    """Sentences of every source of goods and names, in the order in which one overrules another."""
    s, n, t = c("p_size") % 8, c("p_name"), title(c("p_name"))
    text = (
        F.when(s == 0, said("Kill a [[Jogre]] and collect ", n, " on the way")).when(s == 1, said("Take the ", n, " from the table")).when(s == 2, said("Chop 12x ", t, " (long)"))
        .when(s == 3, said("Buy 2x ", n, " and equip it")).when(s == 4, F.lit("Kill a duck")).when(s == 5, said("Deposit All, then withdraw this: ", t))
        .when(s == 6, F.lit("Head to the boat, take it to Brimhaven -> no. Travel")).otherwise(F.lit("Bank"))
    )
    text = F.when(s == 6, F.lit("Charter Dock -> Brimhaven")).otherwise(text)
    got = annotate.annotate(read(spark, sf_dir, "part").select(c("p_partkey").alias("k"), text.alias("said")), "said")
    f = lambda x: F.col(f"fields.{x}")
    way = F.when(f("withdraw"), "withdraw").when(f("collects"), "collects").when(f("buys"), "buys")
    return got.select("k", f("intent").alias("intent"), f("target").alias("target"), F.try_element_at(f("items"), F.lit(1))["name"].alias("item"), way.alias("way"), F.coalesce(f("banking"), F.lit(False)).alias("banking"), F.get(f("links"), F.lit(0)).alias("link"), f("destination").alias("destination"))


@registered(f"""WITH {_P} SELECT k, s % 3 <> 2 AS doing, s % 4 = 0 AS casts, CASE WHEN s % 5 = 0 THEN lower(n) || ' diary' END AS whole, s % 2 = 0 AND s % 3 <> 2 AS own_title, CASE WHEN s % 6 = 0 THEN s || ',1,0' WHEN s % 6 = 1 THEN s || ',2,0' WHEN s % 6 = 2 THEN s || ',3,0' END AS arrival FROM p""")
def verdict_cases(spark, sf_dir):
    """Doing a quest, casting, whole lists, a quest's own title, arrivals."""
    s, n = c("p_size"), c("p_name")
    quest = said("The ", title(n), "'s End")
    doing = F.when(s % 3 == 0, said("Start the ", n, "s end")).when(s % 3 == 1, said("Continue with ", quest)).otherwise(said("Think of ", quest))
    casts = F.when(s % 4 == 0, "Teleport to Town").when(s % 4 == 1, "Teleport to Town with a ring").otherwise("Walk to Town")
    whole = F.when(s % 5 == 0, said("Complete the ", n, " Diary at Town [x]")).otherwise(said("Complete the ", n, " Diary and go"))
    own = F.when(s % 2 == 0, title(n)).otherwise(said("Not ", title(n)))
    point = lambda z: F.array(c("p_size").cast("int"), F.lit(z), F.lit(0))
    k = s % 6
    text = F.when(k == 0, "Head to Town").when(k == 1, "Take the boat").when(k == 2, "Walk").when(k == 3, "Head to Town and bank").when(k == 4, "Walk until noon").otherwise("Talk")
    place = F.when(k.isin(0, 3), F.struct(F.lit("Town").alias("name"), F.array(point(1), point(1)).alias("points"), F.lit(False).alias("ambiguous")))
    target = F.struct(F.lit("object").alias("kind"), F.lit("linked").alias("confidence"), F.array(point(3)).alias("points"))
    arrival = verdicts.arrival(text, F.lit(False), place, F.when(k.isin(1, 4, 5), point(2)), target)
    start = F.when(s % 3 == 2, said("Talk about ", quest)).otherwise(doing)
    return read(spark, sf_dir, "part").select(
        c("p_partkey").alias("k"), verdicts.does(doing, quest).alias("doing"), verdicts.casts(casts).alias("casts"), verdicts.whole_list(whole).alias("whole"),
        merge.own_title(start, own, quest).alias("own_title"), F.array_join(arrival.cast("array<string>"), ",").alias("arrival"),
    )


@registered("SELECT p_partkey AS k, CASE p_size % 3 WHEN 0 THEN 'npc' WHEN 1 THEN 'item' ELSE 'place' END AS kind, CASE WHEN p_partkey % 2 = 0 THEN p_size % 3 <> 0 ELSE p_size % 3 = 0 END AS overruled FROM part")
def kind_overrides(spark, sf_dir):
    """Where what a page says goes against what the step asked for."""
    box = F.when(c("p_size") % 3 == 0, "NPC").when(c("p_size") % 3 == 1, "Item").otherwise("Location")
    kind = pages.kind(said("{{Infobox ", box, "\n|id = 4\n}}"))
    asked = F.when(c("p_partkey") % 2 == 0, F.array(F.lit("npc"))).otherwise(F.array(F.lit("withdraw"), F.lit("nav")))
    return read(spark, sf_dir, "part").select(c("p_partkey").alias("k"), kind.alias("kind"), pages.overrides(kind, asked).alias("overruled"))


@registered("""SELECT n_nationkey AS k, n_nationkey % 4 = 0 AS here, n_nationkey % 3 = 0 AS opened, n_nationkey % 5 IN (0, 1) AS shown, n_nationkey % 2 = 0 AS said, n_nationkey % 7 = 0 OR n_nationkey % 3 = 0 AS once, CASE WHEN n_nationkey % 5 < 4 THEN n_nationkey % 3 <> 0 AND n_nationkey % 5 IN (0, 1) END AS compound FROM nation""")
def condition_shapes(spark, sf_dir):
    """Conditions on scene, screens, words and kept facts; a part that is unknown makes the whole unknown (§2.15)."""
    k = c("n_nationkey")
    state = conditions.State(
        scene=F.array(F.when(k % 4 == 0, F.lit("npc:5")).otherwise("object:5")), screens=F.array(k % 3), shown=F.when(k % 5 < 4, F.create_map(F.lit("1:2"), F.when(k % 5 < 2, F.lit("a big door")).otherwise("a wall"))).otherwise(F.create_map(F.lit("9:9"), F.lit(""))),
        said=F.when(k % 2 == 0, F.lit("well met, friend")).otherwise("go away"), kept=F.create_map(F.lit("k"), k % 7 == 0),
    )
    opened, shown = {"open": 0}, {"widget": {"group": 1, "child": 2, "text": ["big", "door"]}}
    h = lambda x: conditions.holds(x, state)
    return read(spark, sf_dir, "nation").select(
        k.alias("k"), h({"here": {"kind": "npc", "ids": [5, 6]}}).alias("here"), h(opened).alias("opened"), F.coalesce(h(shown), F.lit(False)).alias("shown"), h({"dialog": {"text": ["well", "friend"]}}).alias("said"),
        h({"once": {"key": "k", "when": opened}}).alias("once"), h({"all": [{"not": opened}, shown]}).alias("compound"),
    )


@registered("""SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN 'minecarts' WHEN 1 THEN 'charter_ships' ELSE 'boats' END AS kind, CASE s_suppkey % 4 WHEN 0 THEN 100 WHEN 1 THEN 200 ELSE 300 END + n_nationkey AS x,
  CASE s_suppkey % 4 WHEN 0 THEN 24 WHEN 1 THEN 1 ELSE 1 END AS n_departures FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_suppkey % 4 < 3""")
def travel_networks(spark, sf_dir):
    """Journeys by network, by charter and by curated crossing."""
    n = read(spark, sf_dir, "nation")
    port = said("Port ", F.chr(F.lit(65) + c("n_nationkey")), "x")
    point = lambda base: F.array((F.lit(base) + c("n_nationkey")).cast("int"), F.lit(0), F.lit(0))
    carts = n.select(F.lit("minecarts").alias("kind"), port.alias("label"), point(500).alias("origin"), F.lit(7).alias("id"), F.lit("ride").alias("action"))
    arrivals = n.select(F.lit("minecarts").alias("kind"), port.alias("label"), point(100).alias("destination"))
    row = lambda kind, label, a, b: n.select(F.lit(kind).alias("kind"), label.alias("label"), a.alias("origin"), b.alias("destination"), F.lit(3).alias("id"), F.lit("go").alias("action"))
    routes = row("charter_ships", port, point(200), point(900)).unionByName(row("charter_ships", F.lit("Elsewhere"), point(900), point(200))).unionByName(row("boats", said("Else, ", port), point(900), point(300)))
    crossings = n.select(port.alias("place"), F.lit("boats").alias("kind"))
    k = c("s_suppkey") % 4
    text = F.when(k == 0, said("Take the minecart to ", port, " then run")).when(k == 1, said("Charter to ", port)).when(k == 2, said("Head to ", port, ".")).otherwise(said("Teleport to ", port))
    steps = read(spark, sf_dir, "supplier").join(n, c("s_nationkey") == c("n_nationkey")).select("s_suppkey", travel.journey(text).alias("j"), F.array(point(300)).alias("place_points"))
    got = travel.travel(steps.select("s_suppkey", "j.vehicle", c("j.place").alias("place_name"), "place_points"), "s_suppkey", routes, carts, arrivals, crossings)
    return got.select("s_suppkey", "kind", c("destination")[0].alias("x"), F.size("departures").alias("n_departures"))


@registered("""SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN 'location' WHEN 1 THEN 'bank' WHEN 2 THEN 'entity' END AS points_source, CASE s_suppkey % 4 WHEN 0 THEN CAST(n_nationkey AS VARCHAR) WHEN 1 THEN CAST(n_nationkey + 100 AS VARCHAR) WHEN 2 THEN CAST(n_nationkey + 200 AS VARCHAR) || ',' || CAST(n_nationkey + 300 AS VARCHAR) END AS points, s_suppkey % 4 = 2 AS ambiguous
  FROM supplier JOIN nation ON s_nationkey = n_nationkey""")
def destination_sources(spark, sf_dir):
    """Places from locations, banks and entities in that order, aliases first, pinned to the only teleport."""
    n, k, m = read(spark, sf_dir, "nation"), c("n_nationkey"), c("s_suppkey") % 4
    loc = n.select(said("The ", c("n_name")).alias("name"), F.lit("teleport").alias("kind"), F.array(k).alias("point")).unionByName(n.select(c("n_name").alias("name"), F.lit("dungeon").alias("kind"), F.array(k + 50).alias("point")))
    banks = n.select(said("Bank of ", c("n_name")).alias("name"), F.array(k + 100).alias("point"))
    ent = n.select(said("Inn ", k).alias("name"), F.explode(F.array(F.lit("place"), F.lit("object"), F.lit("npc"))).alias("kind"), k)
    ent = ent.select("name", "kind", F.array(F.when(c("kind") == "place", k + 200).when(c("kind") == "object", k + 300).otherwise(k + 400)).alias("point"))
    alias = n.select(said("BK ", k).alias("spelling"), said("Bank of ", c("n_name")).alias("name"))
    place = F.when(m == 0, c("n_name")).when(m == 1, said("BK ", k)).when(m == 2, said("Inn ", k)).otherwise(F.lit("Nowhere"))
    steps = read(spark, sf_dir, "supplier").join(n, c("s_nationkey") == k).select("s_suppkey", place.alias("place"))
    got = travel.destinations(steps, "place", alias, loc, banks, ent)
    return got.select("s_suppkey", "points_source", F.array_join(F.flatten("points").cast("array<string>"), ",").alias("points"), "ambiguous")
