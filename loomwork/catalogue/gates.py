"""Registered queries of gates and reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import annotate, sentences
from ..operators import audit, curated, diff, documents, gates, reports
from ..sources import sinks
from .codebase import said
from .registry import EVENTS, LINES, read, registered, step_events, step_lines

c = F.col


@registered("""SELECT p_partkey AS k, rule FROM part, (SELECT unnest(['p_brand is not listed', 'p_name has another form', 'p_size is out of range', 'pair repeats an item', 'odd_size needs big_price', 'small or cheap', 'promo is small', 'big_price is missing']) AS rule) r
  WHERE CASE rule WHEN 'p_brand is not listed' THEN p_brand NOT IN ('Brand#1', 'Brand#2', 'Brand#3') WHEN 'p_name has another form' THEN NOT regexp_matches(p_name, '^[a-z]+ (ring|bolt|gear)$') WHEN 'p_size is out of range' THEN p_size < 5 OR p_size > 45
    WHEN 'pair repeats an item' THEN p_size = p_partkey % 50 WHEN 'odd_size needs big_price' THEN p_size % 2 = 1 AND p_retailprice <= 1000 WHEN 'small or cheap' THEN NOT (p_size < 25 OR p_retailprice < 1000) WHEN 'promo is small' THEN p_type = 'PROMO' AND p_size >= 20 ELSE p_retailprice <= 1000 END""")
def schema_rules(spark, sf_dir):
    """Every kind of schema rule, a row for each breach (V1)."""
    p = read(spark, sf_dir, "part").withColumn("pair", F.array(c("p_size").cast("long"), c("p_partkey") % 50)).withColumn("odd_size", F.when(c("p_size") % 2 == 1, 1)).withColumn("big_price", F.when(c("p_retailprice") > 1000, 1))
    rules = [
        gates.one_of("p_brand", ["Brand#1", "Brand#2", "Brand#3"]), gates.matches("p_name", "^[a-z]+ (ring|bolt|gear)$"), gates.between("p_size", 5, 45), gates.unique_items("pair"), gates.needs("odd_size", "big_price"),
        gates.any_of("small or cheap", c("p_size") < 25, c("p_retailprice") < 1000), gates.if_then("promo is small", c("p_type") == "PROMO", c("p_size") < 20), gates.required("big_price"),
    ]
    return gates.broken(p, "p_partkey", rules).select(c("p_partkey").alias("k"), "rule")


@registered("""WITH v AS (SELECT 'empty text' AS check_name, doc_id AS k, text IS NULL OR text = '' AS bad FROM documents UNION ALL SELECT 'long line', item_id, length(text) > 400 FROM benchmark UNION ALL SELECT 'large order', o_orderkey, o_totalprice > 300000 FROM orders UNION ALL SELECT 'full discount', l_orderkey, l_discount > 0.09 FROM lineitem),
  s AS (SELECT check_name, CAST(k AS VARCHAR) AS k, row_number() OVER (PARTITION BY check_name ORDER BY CAST(k AS VARCHAR)) AS n FROM v WHERE bad)
  SELECT check_name, count(*) AS population, count(*) FILTER (WHERE bad) AS violations, coalesce((SELECT string_agg(k, ', ' ORDER BY k) FROM s WHERE s.check_name = v.check_name AND n <= 3), '') AS sample FROM v GROUP BY check_name""")
def audit_samples(spark, sf_dir):
    """Named checks with population, breaches and the first of those (V5)."""
    r = lambda t: read(spark, sf_dir, t)
    checks = [
        ("empty text", r("documents"), c("text").isNull() | (c("text") == ""), "doc_id"), ("long line", r("benchmark"), F.length("text") > 400, "item_id"),
        ("large order", r("orders"), c("o_totalprice") > 300000, "o_orderkey"), ("full discount", r("lineitem"), c("l_discount") > 0.09, "l_orderkey"),
    ]
    return reduce(DataFrame.unionByName, [audit.scanned(rows, [audit.Check(name, F.lit(True), bad)], F.lit(0), c(label), 3) for name, rows, bad, label in checks])


_NESTED = {
    "type": "object", "required": ["id", "price"], "anyOf": [{"properties": {"name": {"pattern": "ring"}}}, {"properties": {"size": {"maximum": 25}}}], "if": {"properties": {"size": {"const": 7}}}, "then": {"required": ["note"]},
    "properties": {"size": {"type": "integer", "maximum": 40}, "points": {"type": "array", "items": {"type": "array", "minItems": 2, "items": {"type": "integer"}}}},
}


@registered("""WITH p AS (SELECT p_partkey AS k, p_size AS s, p_name AS n FROM part), r AS (SELECT k, '$.price' AS path, 'is missing' AS rule FROM p WHERE k % 4 = 0 UNION ALL SELECT k, '$.size', 'is no integer' FROM p WHERE k % 9 = 0 UNION ALL SELECT k, '$.size', 'breaks maximum' FROM p WHERE k % 9 > 0 AND s > 40
  UNION ALL SELECT k, '$.points[1]', 'breaks minItems' FROM p WHERE k % 5 = 0 UNION ALL SELECT k, '$.note', 'is missing' FROM p WHERE s = 7 AND k % 9 > 0 UNION ALL SELECT k, '$', 'fits no alternative' FROM p WHERE NOT contains(n, 'ring') AND k % 9 > 0 AND s > 25) SELECT * FROM r""")
def nested_schema(spark, sf_dir):
    """What breaks the schema of nested documents, with the path of the part that does (V1)."""
    k, size = c("p_partkey"), c("p_size").cast("string")
    text = said('{"id": ', k, ', "name": "', c("p_name"), '", "size": ', F.when(k % 9 == 0, said('"', size, '"')).otherwise(size), F.when(k % 4 > 0, said(', "price": ', c("p_retailprice"))).otherwise(""), ', "points": [[1, ', size, "], [2", F.when(k % 5 > 0, ", 3").otherwise(""), "]]}")
    return documents.nested_breaches(read(spark, sf_dir, "part").select(k.alias("k"), text.alias("t")), "k", "t", _NESTED)


@registered("""WITH st AS (SELECT l_orderkey AS step_id, l_suppkey AS section_id, l_linenumber AS ordinal FROM lineitem)
  SELECT 'step id repeats' AS rule, CAST(step_id AS VARCHAR) AS subject FROM st GROUP BY step_id HAVING count(*) > 1 UNION ALL SELECT 'slug repeats', CAST(s_nationkey AS VARCHAR) FROM supplier GROUP BY s_nationkey HAVING count(*) > 1
  UNION ALL SELECT 'continues an unknown section', CAST(s_suppkey AS VARCHAR) FROM supplier WHERE s_suppkey % 3 = 0 AND s_suppkey * 2 NOT IN (SELECT s_suppkey FROM supplier)
  UNION ALL SELECT DISTINCT 'ordinals have gaps', CAST(section_id AS VARCHAR) FROM (SELECT *, row_number() OVER (PARTITION BY section_id ORDER BY ordinal, step_id) - 1 AS n FROM st) WHERE n <> ordinal
  UNION ALL SELECT DISTINCT 'episode names an unknown section', CAST(n_regionkey AS VARCHAR) FROM nation WHERE n_nationkey * 7 NOT IN (SELECT s_suppkey FROM supplier) UNION ALL SELECT 'migration leads nowhere', CAST(o_orderkey AS VARCHAR) FROM orders WHERE o_orderkey % 10 = 0 AND o_orderkey + 1 NOT IN (SELECT step_id FROM st)""")
def guide_invariants(spark, sf_dir):
    """What a schema cannot say: repeats, gaps, references that lead nowhere (V2)."""
    s = read(spark, sf_dir, "supplier").select(c("s_suppkey").alias("section_id"), c("s_nationkey").alias("slug"), F.when(c("s_suppkey") % 3 == 0, c("s_suppkey") * 2).alias("continuation_of"))
    st = read(spark, sf_dir, "lineitem").select(c("l_orderkey").alias("step_id"), c("l_suppkey").alias("section_id"), c("l_linenumber").alias("ordinal"))
    e = read(spark, sf_dir, "nation").select(c("n_regionkey").alias("ordinal"), (c("n_nationkey") * 7).cast("long").alias("section_id"))
    m = read(spark, sf_dir, "orders").where("o_orderkey % 10 = 0").select(c("o_orderkey").alias("old_id"), (c("o_orderkey") + 1).alias("new_id"))
    return gates.guide_invariants(s, st, e, m)


@registered("SELECT url, CASE WHEN NOT starts_with(url, 'https://') THEN 'unexpected host' WHEN page_id % 3 = 0 THEN 'no recorded hash' ELSE 'malformed hash' END AS problem FROM pages WHERE NOT starts_with(url, 'https://') OR page_id % 3 < 2")
def image_gate(spark, sf_dir):
    """Hosts and hashes of pictures (V3)."""
    p = read(spark, sf_dir, "pages")
    hashes = p.where("page_id % 3 > 0").select("page_id", F.when(c("page_id") % 3 == 1, F.lit("abc")).otherwise(F.sha2(c("html").cast("binary"), 256)).alias("sha256"))
    return gates.image_problems(p.select("page_id", "url"), "url", hashes, "https://", "page_id")


@registered("SELECT 'error' AS severity, CAST(l_orderkey AS VARCHAR) AS key, CAST(l_partkey AS VARCHAR) AS value FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 5) UNION ALL SELECT 'note', n_name, CAST(n_regionkey AS VARCHAR) FROM nation WHERE n_regionkey NOT IN (SELECT r_regionkey FROM region WHERE r_name LIKE 'A%')")
def curated_checks(spark, sf_dir):
    """Entries that name nothing an authority has, with their weight (V7)."""
    one = gates.curated_problems(read(spark, sf_dir, "lineitem"), "l_orderkey", "l_partkey", read(spark, sf_dir, "part").where("p_size > 5"), "p_partkey")
    return one.unionByName(gates.curated_problems(read(spark, sf_dir, "nation"), "n_name", "n_regionkey", read(spark, sf_dir, "region").where("r_name like 'A%'"), "r_regionkey", "note"))


@registered("""SELECT 'spells' AS sheet, 'error' AS severity, CAST(p_partkey AS VARCHAR) AS key, 'SPELL_' || p_size AS value, 'no such spell' AS problem FROM part WHERE p_size NOT IN (SELECT n_nationkey FROM nation)
  UNION ALL SELECT 'skills', 'error', CAST(o_orderkey AS VARCHAR), CASE WHEN o_orderkey % 3 > 0 THEN 'MINING' ELSE 'MINNING' END, unnest(list_filter([CASE WHEN o_orderkey % 3 = 0 THEN 'no such skill' END, CASE WHEN o_orderkey % 120 NOT BETWEEN 1 AND 99 THEN 'level out of range' END, CASE WHEN o_custkey % 10 = 0 THEN 'no such step' END], lambda x: x IS NOT NULL)) FROM orders
  UNION ALL SELECT 'diary tasks', 'error', CAST(c_custkey AS VARCHAR), 'VAR_' || c_nationkey, unnest(list_filter([CASE WHEN c_nationkey >= 20 THEN 'no such variable' END, CASE WHEN c_custkey % 40 > 31 THEN 'bit out of range' END], lambda x: x IS NOT NULL)) FROM customer
  UNION ALL SELECT 'entity aliases', 'error', CAST(s_suppkey AS VARCHAR), CASE WHEN s_suppkey % 4 > 0 THEN 'N' || CAST(s_nationkey + s_suppkey % 3 AS VARCHAR) END, CASE WHEN s_suppkey % 4 = 0 THEN 'names nothing' WHEN s_nationkey + s_suppkey % 3 > 24 THEN 'no such entity' ELSE 'entity without ids' END FROM supplier WHERE s_suppkey % 4 = 0 OR s_nationkey + s_suppkey % 3 > 24 OR (s_nationkey + s_suppkey % 3) % 2 = 1
  UNION ALL SELECT 'diary aliases', 'error', n_name, 'Falador ' || CASE n_nationkey % 3 WHEN 0 THEN 'Easy' WHEN 1 THEN 'Hard' ELSE 'Odd' END || ' Diary', unnest(list_filter([CASE WHEN n_nationkey % 5 = 0 THEN 'no step writes this' END, CASE WHEN n_nationkey % 3 = 2 THEN 'no such diary' END], lambda x: x IS NOT NULL)) FROM nation""")
def curated_sheets(spark, sf_dir):
    """Spells, skills, diary tasks and aliases that name what is not there (V7)."""
    part, orders, customer, supplier, nation = (read(spark, sf_dir, t) for t in ("part", "orders", "customer", "supplier", "nation"))
    skill = orders.select(c("o_orderkey").cast("string").alias("step_id"), F.when(c("o_orderkey") % 3 > 0, "MINING").otherwise("MINNING").alias("skill"), (c("o_orderkey") % 120).alias("level"))
    task = customer.select(c("c_custkey").cast("string").alias("step_id"), said("VAR_", c("c_nationkey")).alias("varplayer"), (c("c_custkey") % 40).alias("bit"))
    name = said("N", c("s_nationkey") + c("s_suppkey") % 3)
    phrases = supplier.select(c("s_suppkey").cast("string").alias("phrase"), F.when(c("s_suppkey") % 4 > 0, F.array(name)).otherwise(F.expr("cast(array() as array<string>)")).alias("names"))
    entities = nation.select(said("N", c("n_nationkey")).alias("name"), F.when(c("n_nationkey") % 2 == 0, F.array(F.lit(1))).alias("ids"))
    k = c("n_nationkey") % 3
    aliases = nation.select(c("n_name").alias("written"), said("Falador ", F.when(k == 0, "Easy").when(k == 1, "Hard").otherwise("Odd"), " Diary").alias("diary"))
    return curated.all_of(
        curated.spells(part.select(c("p_partkey").alias("place"), said("SPELL_", c("p_size")).alias("spell")), nation.select(said("SPELL_", c("n_nationkey")).alias("spell"))),
        curated.skills(skill, orders.where("o_custkey % 10 > 0").select(c("o_orderkey").cast("string").alias("step_id"))),
        curated.diary_tasks(task, nation.where("n_nationkey < 20").select(said("VAR_", c("n_nationkey")).alias("name")), None),
        curated.entity_aliases(phrases, entities), curated.diary_aliases(aliases, nation.where("n_nationkey % 5 > 0").select(c("n_name").alias("tag"))),
    )


@registered("SELECT 'note' AS severity, n_name AS key, CAST(n_regionkey AS VARCHAR) AS value FROM nation WHERE n_regionkey <> 0")
def check_only(spark, sf_dir):
    """Notes pass a check that errors would stop (V8)."""
    return gates.checked(gates.curated_problems(read(spark, sf_dir, "nation"), "n_name", "n_regionkey", read(spark, sf_dir, "region").where("r_regionkey = 0"), "r_regionkey", "note"))


@registered("SELECT doc_id, doc_id % 3 <> 0 AS is_fresh FROM documents WHERE doc_id % 5 <> 0")
def fresh_artifacts(spark, sf_dir):
    """Whether an artifact was made from its source as it is now (V9)."""
    d = read(spark, sf_dir, "documents")
    stored = d.where("doc_id % 5 <> 0").select("doc_id", F.sha2(F.concat("text", F.when(c("doc_id") % 3 == 0, F.lit("!")).otherwise("")).cast("binary"), 256).alias("source_hash"))
    return gates.fresh(stored, d, "doc_id", "text")


@registered("""SELECT p_partkey AS k, CASE WHEN p_size < 2 THEN 'dial size' WHEN p_partkey % 5 = 0 THEN 'submit' WHEN p_partkey % 7 = 0 THEN 'number of dials' WHEN p_partkey % 11 >= p_size THEN 'target' WHEN p_partkey % 13 = 0 THEN 'control used twice' END AS problem FROM part
  WHERE p_size < 2 OR p_partkey % 5 = 0 OR p_partkey % 7 = 0 OR p_partkey % 11 >= p_size OR p_partkey % 13 = 0""")
def lock_gate(spark, sf_dir):
    """Locks that their own numbers could not solve (V6)."""
    dial = lambda n: F.struct(F.lit(0).alias("target"), F.lit(n).alias("varc"), F.lit(10 * n).alias("down"), F.lit(10 * n + 1).alias("up"))
    odd = F.struct((c("p_partkey") % 11).alias("target"), F.lit(9).alias("varc"), F.when(c("p_partkey") % 13 == 0, 10).otherwise(90).alias("down"), F.lit(91).alias("up"))
    lock = F.struct(c("p_size").alias("size"), F.lit(3).alias("parent"), F.when(c("p_partkey") % 5 == 0, 0).otherwise(4).alias("submit"), F.when(c("p_partkey") % 7 == 0, F.array(dial(1))).otherwise(F.array(dial(1), odd.cast("struct<target:int,varc:int,down:int,up:int>"))).alias("cycles"))
    return gates.document_problems(read(spark, sf_dir, "part").select(c("p_partkey").alias("k"), F.to_json(lock).alias("lock")), "k", "lock", "lock")


@registered("SELECT event_id AS k, CASE WHEN event_id % 4 = 0 THEN 'malformed var' WHEN event_id % 4 = 1 THEN 'malformed not' ELSE 'unreadable' END AS problem FROM events WHERE event_id % 4 < 3")
def condition_gate(spark, sf_dir):
    """Conditions that no client could answer (V6, §2.15)."""
    k = c("event_id") % 4
    text = F.when(k == 0, said('{"var": {"kind": "varbit", "id": ', c("event_id"), ', "op": "~", "value": 1}}')).when(k == 1, F.lit('{"not": {"open": "x"}}')).when(k == 2, F.lit("{open")).otherwise(F.lit('{"any": [{"open": 3}, {"item": {"ids": [4]}}]}'))
    return gates.document_problems(read(spark, sf_dir, "events").select(c("event_id").alias("k"), text.alias("t")), "k", "t", "condition")


# --- counts and lists ------------------------------------------------------


@registered(f"SELECT lower(regexp_extract(line, '^(\\S+)', 1)) AS value, count(*) AS n FROM ({LINES}) WHERE line <> '' GROUP BY 1 ORDER BY n DESC, value LIMIT 40")
def top_openings(spark, sf_dir):
    """The forty most frequent first words."""
    return reports.most_common(step_lines(spark, sf_dir).where("line <> ''"), F.lower(F.regexp_extract("line", r"^(\S+)", 1)), 40)


@registered()
def annotate_coverage(spark, sf_dir):
    """What the sentence rules found in every line, and what they did not."""
    got = annotate.annotate(step_lines(spark, sf_dir).where("line <> ''").repartition("doc_id", "line_no"), "line")
    f = lambda x: F.col(f"fields.{x}")
    return reports.annotation_coverage(got.select(c("line").alias("raw"), f("intent").alias("intent"), f("target").alias("target"), sentences.confidence(f("target"), f("links")).alias("confidence")))


@registered("WITH r AS (SELECT s_name AS name, s_name AS variant, CASE WHEN s_suppkey % 3 = 0 THEN 'npc' WHEN s_suppkey % 3 = 1 THEN 'place' END AS kind, CASE WHEN s_suppkey % 3 = 2 THEN 'no page' END AS refusal FROM supplier) SELECT 'kind' AS measure, kind AS value, count(*) AS n FROM r WHERE kind IS NOT NULL GROUP BY kind UNION ALL SELECT 'refusal', refusal, count(*) FROM r WHERE kind IS NULL GROUP BY refusal UNION ALL SELECT 'choice failed', name, 1 FROM r WHERE kind IS NULL")
def resolution_stats(spark, sf_dir):
    """Names by kind, refusals, and choices that led nowhere."""
    k = c("s_suppkey") % 3
    r = read(spark, sf_dir, "supplier").select(c("s_name").alias("name"), c("s_name").alias("variant"), F.when(k == 0, "npc").when(k == 1, "place").alias("kind"), F.when(k == 2, "no page").alias("refusal"))
    return reports.resolution_stats(r, r.select("name", c("variant").alias("choice")))


@registered("SELECT flag, count(*) AS n, min(doc_id) AS first FROM (SELECT doc_id, unnest([CASE WHEN lang = 'en' THEN 'english' END, CASE WHEN n_chars > 1000 THEN 'long' END, CASE WHEN contains(text, '!!') THEN 'shouting' END, CASE WHEN n_chars < 0 THEN 'never' END]) AS flag FROM documents) WHERE flag IS NOT NULL GROUP BY flag")
def flag_inventory(spark, sf_dir):
    """How many rows raise each flag."""
    return reports.flag_inventory(read(spark, sf_dir, "documents"), "doc_id", {"english": c("lang") == "en", "long": c("n_chars") > 1000, "shouting": F.contains("text", F.lit("!!")), "never": c("n_chars") < 0})


@registered("SELECT o_orderkey AS k, CASE WHEN o_totalprice > 200000 THEN 'item goal' WHEN o_orderkey % 2 = 0 THEN 'state goal' ELSE 'manual' END AS status, CASE WHEN o_orderkey % 7 = 0 THEN 'new' ELSE concat_ws(',', CASE WHEN o_orderkey % 3 = 0 THEN 'o_orderpriority' END, CASE WHEN o_orderkey % 5 = 0 THEN 'o_orderstatus' END) END AS changed FROM orders")
def goal_inventory(spark, sf_dir):
    """Goals by status, with the fields that changed since the release before."""
    o = read(spark, sf_dir, "orders")
    before = o.where("o_orderkey % 7 <> 0").withColumn("o_orderpriority", F.when(c("o_orderkey") % 3 == 0, F.lit("?")).otherwise(c("o_orderpriority"))).withColumn("o_orderstatus", F.when(c("o_orderkey") % 5 == 0, None).otherwise(c("o_orderstatus")))
    status = F.when(c("o_totalprice") > 200000, "item goal").when(c("o_orderkey") % 2 == 0, "state goal").otherwise("manual")
    return reports.goals(o, before, "o_orderkey", ["o_orderstatus", "o_orderpriority"], status).select(c("o_orderkey").alias("k"), "status", "changed")


@registered("WITH a AS (SELECT DISTINCT p_type AS line FROM part), h AS (SELECT line, row_number() OVER (ORDER BY line) - 1 AS place FROM a) SELECT place, line FROM h WHERE place < 4 UNION ALL SELECT 4, '... and ' || (count(*) - 4) || ' more' FROM a HAVING count(*) > 4")
def headed_list(spark, sf_dir):
    """The first rows, and how many more there are (L4)."""
    return reports.headed(read(spark, sf_dir, "part").select("p_type").distinct(), ["p_type"], c("p_type"), 4)


@registered()
def drawn_sample(spark, sf_dir):
    """Always the same rows for a seed (L5); SQL here has another hash."""
    return reports.drawn(read(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id", 20)


@registered("""WITH v AS (SELECT p_type AS value, 0 AS t, p_partkey AS o FROM part UNION ALL SELECT o_orderpriority, 1, o_orderkey FROM orders UNION ALL SELECT upper(event_type), 2, event_id FROM events), f AS (SELECT value, min(t * 1000000000000 + o) AS spot FROM v GROUP BY 1) SELECT value, row_number() OVER (ORDER BY spot, value) - 1 AS place FROM f""")
def union_in_order(spark, sf_dir):
    """Every value once, in the order in which the tables first give it."""
    t = lambda name, v, o: (read(spark, sf_dir, name).select(v.alias("value"), o), o)
    got = reports.union_in_order(t("part", c("p_type"), "p_partkey"), t("orders", c("o_orderpriority"), "o_orderkey"), t("events", F.upper("event_type"), "event_id"))
    return got.select("value", c("place").cast("long").alias("place"))


@registered("""WITH b AS (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN text || '!' ELSE text END AS text, lang FROM documents WHERE doc_id % 7 <> 0 UNION ALL SELECT doc_id + 10000000, text, lang FROM documents WHERE doc_id % 11 = 0),
  j AS (SELECT coalesce(a.doc_id, b.doc_id) AS k, coalesce(b.lang, a.lang) AS section, CASE WHEN a.doc_id IS NULL THEN 'added' WHEN b.doc_id IS NULL THEN 'removed' WHEN a.text <> b.text THEN 'reworded' END AS status, coalesce(b.text, a.text) AS shown FROM documents a FULL JOIN b ON a.doc_id = b.doc_id)
  SELECT section, status, count(*) AS n, arg_min(shown, k) AS first FROM j WHERE status IS NOT NULL GROUP BY 1, 2""")
def release_report(spark, sf_dir):
    """What each section gained, lost or said otherwise."""
    d = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    b = d.where("doc_id % 7 <> 0").withColumn("text", F.when(c("doc_id") % 5 == 0, F.concat("text", F.lit("!"))).otherwise(c("text")))
    return reports.release_report(d, b.unionByName(d.where("doc_id % 11 = 0").withColumn("doc_id", c("doc_id") + 10000000)), "doc_id", "text", "lang")


@registered("""WITH u AS (SELECT n_name AS name, s_suppkey AS place, s_name AS text FROM nation JOIN supplier ON n_nationkey = s_nationkey), r AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY place, text) AS n FROM u)
  SELECT n_name AS name, (SELECT count(*) FROM u WHERE u.name = n_name) AS n, coalesce((SELECT string_agg(text, ' / ' ORDER BY n) FROM r WHERE r.name = n_name AND n <= 4), '') AS examples FROM nation WHERE n_nationkey % 2 = 0""")
def curation_worklist(spark, sf_dir):
    """What a person should look at, with its first uses (O2)."""
    n = read(spark, sf_dir, "nation")
    uses = n.join(read(spark, sf_dir, "supplier"), c("n_nationkey") == c("s_nationkey")).select(c("n_name").alias("name"), c("s_suppkey").alias("place"), c("s_name").alias("text"))
    return reports.worklist(n.where("n_nationkey % 2 = 0").select(c("n_name").alias("name")), uses)


@registered("SELECT o_custkey, string_agg(o_orderkey || ': ' || o_orderstatus, ' | ' ORDER BY o_orderkey) AS shown FROM orders GROUP BY 1")
def quest_states(spark, sf_dir):
    """The states of a quest in order, for a person to read (O3)."""
    return reports.states(read(spark, sf_dir, "orders"), "o_custkey", "o_orderkey", "o_orderstatus")


# --- what ships ------------------------------------------------------------


@registered("SELECT doc_id, '{\"a\":' || doc_id || ',\"lang\":' || CASE WHEN lang IS NULL THEN 'null' ELSE '\"' || lang || '\"' END || ',\"z\":{\"b\":1}}' AS body FROM documents")
def canonical_documents(spark, sf_dir):
    """JSON with sorted keys, without blanks and without the fields that do not count."""
    d = read(spark, sf_dir, "documents")
    raw = F.concat(F.lit('{ "z" : {"skip": [1, 2], "b": 1}, "lang": '), F.coalesce(F.concat(F.lit('"'), "lang", F.lit('"')), F.lit("null")), F.lit(', "a" :'), c("doc_id").cast("string"), F.lit(', "skip": "x"}'))
    return reports.canonical_json(d.select("doc_id", raw.alias("raw")), "raw", "body", ("skip",)).select("doc_id", "body")


@registered("SELECT event_id, left(sha256(replace(props, ' ', '')), 16) AS content_hash, event_id % 4 <> 0 AS same FROM events WHERE event_id % 9 <> 0 UNION ALL SELECT event_id, left(sha256(replace(props, ' ', '')), 16), false FROM events WHERE event_id % 9 = 0")
def content_hashes(spark, sf_dir):
    """A hash of the content alone, and whether two releases have the same."""
    e = read(spark, sf_dir, "events").select("event_id", "props")
    later = e.where("event_id % 9 <> 0").withColumn("props", F.when(c("event_id") % 4 == 0, F.lit('{"k": -1}')).otherwise(F.concat(F.lit('{"at": 5, '), F.substr("props", F.lit(2)))))
    same = reports.same_content(e, later, "event_id", "props", ("at",))
    own = reports.canonical_json(e, "props", "body").select("event_id", reports.content_hash(c("body")).alias("content_hash"))
    return own.join(same, "event_id")


@registered("SELECT doc_id AS id, regexp_extract(text, '^([^\\n]*)', 1) AS title, CASE WHEN contains(text, '1') THEN 1 END AS has_one FROM documents")
def contract_projection(spark, sf_dir):
    """Only the columns of the contract, empty lists as nothing."""
    ones = F.filter(F.array(F.when(F.contains("text", F.lit("1")), 1)), lambda x: x.isNotNull())
    got = reports.projected(read(spark, sf_dir, "documents"), {"id": c("doc_id"), "title": F.regexp_extract("text", r"^([^\n]*)", 1), "ones": ones}, ["ones"])
    return got.select("id", "title", F.get("ones", F.lit(0)).alias("has_one"))


@registered(f"""WITH RECURSIVE e AS (SELECT user_id, pos, event_id FROM ({EVENTS})), h AS (SELECT user_id, pos AS old_id, pos + 1 AS new_id FROM e WHERE pos % 3 = 1), c AS (SELECT user_id, pos AS old_id, CASE WHEN pos % 2 = 0 THEN pos - 1 ELSE pos + 3 END AS new_id FROM e WHERE pos % 5 = 0)
  SELECT user_id, old_id, new_id FROM h UNION ALL SELECT c.user_id, c.old_id, coalesce(h.new_id, c.new_id) AS n FROM c LEFT JOIN h ON c.user_id = h.user_id AND c.new_id = h.old_id WHERE NOT EXISTS (SELECT 1 FROM h z WHERE z.user_id = c.user_id AND z.old_id = c.old_id) AND coalesce(h.new_id, c.new_id) <> c.old_id""")
def migration_chain(spark, sf_dir):
    """Earlier moves one hop on, new ones first, none to itself."""
    e = step_events(spark, sf_dir)
    key = lambda n: F.concat_ws("|", c("user_id").cast("string"), n.cast("string"))
    new = e.where("pos % 3 = 1").select(key(c("pos")).alias("old_id"), key(c("pos") + 1).alias("new_id"))
    carried = e.where("pos % 5 = 0").select(key(c("pos")).alias("old_id"), key(F.when(c("pos") % 2 == 0, c("pos") - 1).otherwise(c("pos") + 3)).alias("new_id"))
    part = lambda name, k: F.get(F.split(name, r"\|"), F.lit(k)).cast("long")
    return diff.carry(carried, new).select(part("old_id", 0).alias("user_id"), part("old_id", 1).alias("old_id"), part("new_id", 1).alias("new_id"))


@registered("SELECT a.label AS left_key, b.label AS right_key, count(*) AS n_shared FROM (SELECT DISTINCT label, vec_id % 40 AS v FROM embeddings) a JOIN (SELECT DISTINCT label, vec_id % 40 AS v FROM embeddings) b ON a.v = b.v AND a.label < b.label GROUP BY 1, 2")
def array_overlap_pairs(spark, sf_dir):
    """How many members two lists share."""
    lists = read(spark, sf_dir, "embeddings").groupBy("label").agg(F.array_sort(F.collect_set(c("vec_id") % 40)).alias("v"))
    each = lists.select("label", F.explode("v").alias("v"))
    met = each.select(c("label").alias("left_key"), "v").join(each.select(c("label").alias("right_key"), "v"), "v").where("left_key < right_key")
    return met.groupBy("left_key", "right_key").agg(F.count(F.lit(1)).alias("n_shared"))


@registered("SELECT '# curated' || chr(10) || 'entries:' || chr(10) || (SELECT string_agg('  - {\"n_name\":\"' || n_name || '\",\"n_regionkey\":' || n_regionkey || '}', chr(10) ORDER BY n_name) FROM nation) || chr(10) || 'ambiguous:' || chr(10) || (SELECT string_agg('  - {\"key\":' || n_regionkey || ',\"names\":[' || l || ']}', chr(10) ORDER BY CAST(n_regionkey AS VARCHAR)) FROM (SELECT n_regionkey, string_agg('\"' || n_name || '\"', ',' ORDER BY n_name) AS l FROM nation GROUP BY 1)) AS value")
def curated_yaml(spark, sf_dir):
    """A curated file with a header and the keys in doubt (K3)."""
    n = read(spark, sf_dir, "nation")
    doubt = n.groupBy(c("n_regionkey").alias("key")).agg(F.sort_array(F.collect_list("n_name")).alias("names"))
    return sinks.yaml_text(n, doubt, "n_name", "n_regionkey", "curated")


@registered("SELECT * FROM (SELECT -1 AS section, '# Report' AS line UNION ALL SELECT 0, '## Regions' UNION ALL SELECT 0, '| ' || r_regionkey || ' | ' || r_name || ' |' FROM region UNION ALL SELECT 1, '## Nations' UNION ALL SELECT 1, '| ' || n_name || ' |' FROM nation)")
def page_report(spark, sf_dir):
    """A page of named tables (K4)."""
    got = sinks.report("Report", {"Regions": read(spark, sf_dir, "region").select("r_regionkey", "r_name"), "Nations": read(spark, sf_dir, "nation").select("n_name")})
    return got.select("section", "line")
