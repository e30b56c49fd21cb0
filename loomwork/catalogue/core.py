"""Registered queries over the driver's tables, each with its SQL counterpart.

Document lines stand for steps, conversations for sections, a user's events
for an ordered list, nation, part and supplier for authorities.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import annotate, goods, predicates, sentences, verdicts
from ..functions import text as T
from ..operators import boundaries, conditions, diff
from ..operators import pages as page_names
from ..operators import quality, resolve, sequence, structure, travel
from ..sources import lookup, sinks
from .registry import EVENTS, LINES, read, registered, step_events, step_lines

#: Leading words and what they stand for, in rule order.
VERBS = [("the", "article"), ("of", "genitive"), ("in", "place"), ("de", "genitive"), ("la", "article"), ("and", "link"), ("to", "aim")]
CLASSES = [(r"^$", "blank"), (r"\|", "table"), (r"[%&$*#]{3}", "noise"), (r"!!", "shout"), (r"[0-9]", "digits")]
NORM = r"lower(trim(regexp_replace(line, '\s+', ' ', 'g')))"


# --- document structure ---------------------------------------------------


@registered(LINES)
def lines_explode(spark, sf_dir):
    return step_lines(spark, sf_dir)


_CASES = " ".join(f"WHEN regexp_matches(line, '{p}') THEN '{n}'" for p, n in CLASSES)


@registered(f"SELECT kind, count(*) AS n_lines, count(DISTINCT doc_id) AS n_docs FROM (SELECT *, CASE {_CASES} ELSE 'prose' END AS kind FROM ({LINES})) GROUP BY kind")
def line_classify(spark, sf_dir):
    kinds = step_lines(spark, sf_dir).withColumn("kind", structure.classify(F.col("line"), CLASSES, "prose"))
    return kinds.groupBy("kind").agg(F.count(F.lit(1)).alias("n_lines"), F.countDistinct("doc_id").alias("n_docs"))


@registered("""SELECT conv_id, block, min(turn) AS first_turn, max(turn) AS last_turn, count(*) AS n_turns FROM (
  SELECT *, sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING) AS block FROM conversations) GROUP BY conv_id, block""")
def block_segment(spark, sf_dir):
    b = structure.blocks(read(spark, sf_dir, "conversations"), ["conv_id"], ["turn", "role", "text"], F.col("role") == "user")
    return b.groupBy("conv_id", "block").agg(F.min("turn").alias("first_turn"), F.max("turn").alias("last_turn"), F.count(F.lit(1)).alias("n_turns"))


@registered(f"""WITH e AS ({EVENTS}), s AS (SELECT *, CASE WHEN event_type = 'signup' THEN CAST(floor(value) AS BIGINT) END AS lit, CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS d FROM e),
  g AS (SELECT *, sum(CASE WHEN lit IS NOT NULL THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS seg FROM s)
  SELECT event_id, CAST(coalesce(first_value(lit) OVER w, 0) + sum(d) OVER w AS BIGINT) AS counter FROM g WINDOW w AS (PARTITION BY user_id, seg ORDER BY pos ROWS UNBOUNDED PRECEDING)""")
def counter_simulation(spark, sf_dir):
    lit = F.when(F.col("event_type") == "signup", F.floor("value").cast("long"))
    got = structure.counters(step_events(spark, sf_dir), ["user_id"], ["pos"], lit, F.when(F.col("event_type") == "click", 1).otherwise(0), "counter")
    return got.select("event_id", F.col("counter").cast("long").alias("counter"))


@registered("""SELECT conv_id, turn, role, last_value(CASE WHEN role = 'user' THEN turn END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING) AS header_turn FROM conversations""")
def header_carry(spark, sf_dir):
    c = structure.carried(read(spark, sf_dir, "conversations"), ["conv_id"], ["turn", "role", "text"], F.when(F.col("role") == "user", F.col("turn")), "header_turn")
    return c.select("conv_id", "turn", "role", "header_turn")


_IDS = f"""SELECT doc_id, line_no, dup, left(sha1(CAST(doc_id AS VARCHAR) || '|' || norm || CASE WHEN dup > 0 THEN '#' || CAST(dup AS VARCHAR) ELSE '' END), 10) AS step_id FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id, norm ORDER BY line_no) - 1 AS dup FROM (SELECT *, {NORM} AS norm FROM ({LINES})) WHERE norm <> '')"""


@registered(_IDS)
def step_ids(spark, sf_dir):
    return structure.stable_ids(step_lines(spark, sf_dir), "doc_id", "line", ["line_no"]).select("doc_id", "line_no", F.col("dup").cast("long").alias("dup"), "step_id")


@registered(f"SELECT doc_id, line_no, row_number() OVER (PARTITION BY doc_id, line ORDER BY line_no) - 1 AS dup FROM ({LINES})")
def dup_ordinals(spark, sf_dir):
    return structure.duplicate_ordinals(step_lines(spark, sf_dir), ["doc_id", "line"], ["line_no"]).select("doc_id", "line_no", F.col("dup").cast("long").alias("dup"))


# --- text to fields -------------------------------------------------------


@registered("""SELECT page_id, pos, regexp_replace(u, '[.,;:)]+$', '') AS url FROM (SELECT page_id, unnest(l) AS u, unnest(range(len(l))) AS pos FROM (SELECT page_id, regexp_extract_all(html, '(https?://[^\\s"<>\\]]+)', 1) AS l FROM pages))""")
def urls_extract(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", F.posexplode(T.urls(F.col("html"))).alias("pos", "url"))


@registered(r"""SELECT doc_id, unnest(l) AS numbers, unnest(range(len(l))) AS pos FROM (SELECT doc_id, regexp_extract_all(text, '\(([0-9]+(?:\s*,\s*[0-9]+)*)\)', 1) AS l FROM documents)""")
def tuple_extract(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", F.posexplode(T.number_tuples(F.col("text"))).alias("pos", "numbers"))


_VERB = " ".join(f"WHEN lower(line) = '{p}' OR substr(lower(line), 1, {len(p) + 1}) IN ('{p} ', '{p}:', '{p}-') THEN '{i}'" for p, i in VERBS)


@registered(f"SELECT doc_id, line_no, intent FROM (SELECT *, CASE {_VERB} END AS intent FROM ({LINES})) WHERE intent IS NOT NULL")
def verb_rules(spark, sf_dir):
    return structure.verb_rules(step_lines(spark, sf_dir), "line", VERBS).where("intent is not null").select("doc_id", "line_no", "intent")


@registered(r"""SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(html, '<[^>]*>', ' ', 'g'), '\{\{[^}]*\}\}', ' ', 'g'), '\s+', ' ', 'g')) AS plain FROM pages""")
def pages_text(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", T.plain_markup(F.col("html")).alias("plain"))


# --- names to entities ----------------------------------------------------


_SING = "CASE WHEN length({0}) < 4 THEN {0} WHEN {0} LIKE '%ies' THEN regexp_replace({0}, 'ies$', '') || 'y' WHEN {0} LIKE '%ss' THEN {0} WHEN {0} LIKE '%s' THEN regexp_replace({0}, 's$', '') ELSE {0} END"
_CASE = "upper(substr({0}, 1, 1)) || lower(substr({0}, 2))"


@registered(f"""WITH v AS (SELECT p_partkey, p_name AS a, {_SING.format('p_name')} AS b FROM part), w AS (SELECT p_partkey, unnest([a, b, {_CASE.format('a')}, {_CASE.format('b')}]) AS variant, unnest([0, 1, 2, 3]) AS k FROM v)
  SELECT p_partkey, string_agg(variant, '|' ORDER BY k) AS variants FROM (SELECT p_partkey, variant, min(k) AS k FROM w GROUP BY p_partkey, variant) GROUP BY p_partkey""")
def title_variants(spark, sf_dir):
    return read(spark, sf_dir, "part").select("p_partkey", F.array_join(T.title_variants(F.col("p_name")), "|").alias("variants"))


@registered("""WITH a(alias, target) AS (VALUES ('N1', 'NATION_1'), ('NATION_1', 'NATION_2'), ('x', 'y'))
  SELECT n_name, coalesce(c.target, b.target, n_name) AS page FROM nation LEFT JOIN a b ON n_name = b.alias LEFT JOIN a c ON coalesce(b.target, n_name) = c.alias""")
def redirect_chain(spark, sf_dir):
    hop = spark.createDataFrame([("N1", "NATION_1"), ("NATION_1", "NATION_2"), ("x", "y")], "alias string, target string")
    return resolve.chase(read(spark, sf_dir, "nation").select("n_name"), [(hop, "alias", "target")] * 2, "n_name", "page")


@registered("""WITH d AS (SELECT lower(p_name) AS k, min(p_partkey) AS v FROM part WHERE p_size <= 10 GROUP BY 1), e AS (SELECT lower(p_brand) AS k, min(p_partkey) AS v FROM part GROUP BY 1)
  SELECT p_partkey, coalesce(d.v, e.v) AS resolved, CASE WHEN d.v IS NOT NULL THEN 'exact' WHEN e.v IS NOT NULL THEN 'brand' ELSE 'unresolved' END AS resolved_source
  FROM part LEFT JOIN d ON lower(p_name) = d.k LEFT JOIN e ON lower(p_brand) = e.k AND p_size > 25""")
def resolver_cascade(spark, sf_dir):
    part = read(spark, sf_dir, "part")
    exact = part.where("p_size <= 10").groupBy(F.lower("p_name").alias("k")).agg(F.min("p_partkey").alias("v"))
    brand = part.groupBy(F.lower("p_brand").alias("k")).agg(F.min("p_partkey").alias("v"))
    dims = [(exact, "exact", F.lower("p_name")), (brand, "brand", F.when(F.col("p_size") > 25, F.lower("p_brand")))]
    return resolve.cascade(part, dims, "k", "v", "resolved").select("p_partkey", "resolved", "resolved_source")


@registered("SELECT doc_id, lang FROM documents WHERE NOT EXISTS (SELECT 1 FROM labels WHERE labels.doc_id = documents.doc_id)")
def unresolved_antijoin(spark, sf_dir):
    return quality.orphans(read(spark, sf_dir, "documents"), "doc_id", read(spark, sf_dir, "labels"), "doc_id").select("doc_id", "lang")


@registered("SELECT name_key, count(DISTINCT p_partkey) AS n_values, count(*) AS n_rows FROM (SELECT regexp_replace(lower(p_name), '[^a-z0-9]', '', 'g') AS name_key, p_partkey FROM part) GROUP BY name_key HAVING count(DISTINCT p_partkey) > 1")
def ambiguous_keys(spark, sf_dir):
    return resolve.ambiguous(read(spark, sf_dir, "part").select(T.squash(F.col("p_name")).alias("name_key"), "p_partkey"), "name_key", "p_partkey")


@registered("SELECT l_orderkey, CASE WHEN bool_and(l_quantity >= 5) THEN CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) END AS total, count(*) AS n_members FROM lineitem GROUP BY l_orderkey")
def all_or_nothing_collection(spark, sf_dir):
    return resolve.all_or_nothing(read(spark, sf_dir, "lineitem"), "l_orderkey", F.col("l_quantity") >= 5, F.col("l_quantity").cast("long"), "total")


@registered("""SELECT l_partkey, l_suppkey, rank FROM (SELECT l_partkey, l_suppkey, row_number() OVER (PARTITION BY l_partkey ORDER BY n DESC, l_suppkey) AS rank FROM (SELECT l_partkey, l_suppkey, count(*) AS n FROM lineitem GROUP BY 1, 2)) WHERE rank <= 12""")
def topk_sellers(spark, sf_dir):
    n = read(spark, sf_dir, "lineitem").groupBy("l_partkey", "l_suppkey").agg(F.count(F.lit(1)).alias("n"))
    return sequence.top_k(n, ["l_partkey"], [F.desc("n"), F.asc("l_suppkey")], 12).select("l_partkey", "l_suppkey", F.col("rank").cast("long").alias("rank"))


_LABELS = [("a", "NATION_1,NATION_2"), ("b", "NATION_3, nation_4"), ("c", "nowhere")]


@registered("""WITH r(route, labels) AS (VALUES ('a', 'NATION_1,NATION_2'), ('b', 'NATION_3, nation_4'), ('c', 'nowhere')), x AS (SELECT route, regexp_replace(lower(unnest(string_split(labels, ','))), '[^a-z0-9]', '', 'g') AS k FROM r)
  SELECT route, n_nationkey FROM x JOIN nation ON regexp_replace(lower(n_name), '[^a-z0-9]', '', 'g') = k""")
def label_list_join(spark, sf_dir):
    routes = spark.createDataFrame(_LABELS, "route string, labels string").select("route", F.explode(F.split("labels", ",")).alias("l"))
    nation = read(spark, sf_dir, "nation").withColumn("k", T.squash(F.col("n_name")))
    return routes.withColumn("k", T.squash(F.col("l"))).join(nation, "k").select("route", "n_nationkey")


@registered("""SELECT a.p_brand, a.p_size, arg_min(b.p_size, abs(b.p_size - a.p_size) * 1000 + b.p_size) AS near_size FROM (SELECT DISTINCT p_brand, p_size FROM part) a JOIN (SELECT DISTINCT p_brand, p_size FROM part) b
  ON a.p_brand = b.p_brand AND a.p_size <> b.p_size AND abs(b.p_size - a.p_size) <= 30 GROUP BY 1, 2""")
def nearest_range(spark, sf_dir):
    sizes = read(spark, sf_dir, "part").select("p_brand", "p_size").distinct()
    both = resolve.within(sizes, sizes, ["p_brand"], ["p_size"], 30).where("p_size <> near_p_size").withColumn("one", F.concat_ws("|", "p_brand", "p_size"))
    return resolve.nearest(both, "one", "near_p_size", F.abs(F.col("near_p_size") - F.col("p_size")), 30, [F.asc("near_p_size")]).select("p_brand", "p_size", F.col("near_p_size").alias("near_size"))


@registered("""WITH a AS (SELECT p_partkey, p_size % 4 AS plane, p_partkey * 37 % 1000 AS x, p_partkey * 91 % 700 AS y FROM part), b AS (SELECT s_suppkey, s_nationkey % 4 AS plane, s_suppkey * 53 % 1000 AS x, s_suppkey * 17 % 700 AS y FROM supplier)
  SELECT p_partkey, arg_min(s_suppkey, ((a.x - b.x) ** 2 + (a.y - b.y) ** 2) * 100000 + s_suppkey) AS s_suppkey, CAST(min((a.x - b.x) ** 2 + (a.y - b.y) ** 2) AS BIGINT) AS distance FROM a JOIN b ON a.plane = b.plane AND abs(a.x - b.x) <= 60 AND abs(a.y - b.y) <= 60 WHERE (a.x - b.x) ** 2 + (a.y - b.y) ** 2 <= 3600 GROUP BY 1""")
def nearest_place(spark, sf_dir):
    """The supplier nearest to a part on its plane, within sixty."""
    k, n = F.col("p_partkey"), F.col("s_suppkey")
    parts = read(spark, sf_dir, "part").select("p_partkey", (F.col("p_size") % 4).cast("long").alias("plane"), (k * 37 % 1000).alias("x"), (k * 91 % 700).alias("y"))
    places = read(spark, sf_dir, "supplier").select("s_suppkey", (F.col("s_nationkey") % 4).cast("long").alias("plane"), (n * 53 % 1000).alias("x"), (n * 17 % 700).alias("y"))
    return resolve.nearest_within(parts, places, "p_partkey", "s_suppkey", ["plane"], ["x", "y"], 60)


PHRASES = ["ring", "hot ring", "small", "small part", "part", "blue", "red part"]


@registered("SELECT p_partkey, (SELECT arg_max(p, length(p) * 100 - k) FROM (VALUES " + ", ".join(f"('{p}', {k})" for k, p in enumerate(sorted(PHRASES))) + ") v(p, k) WHERE contains(lower(p_name), p)) AS phrase FROM part")
def longest_match_contains(spark, sf_dir):
    return read(spark, sf_dir, "part").select("p_partkey", resolve.longest_contained(F.lower("p_name"), PHRASES).alias("phrase"))


_KEY = "regexp_replace(lower(text), '[^a-z0-9]', '', 'g')"


# --- ordered passes -------------------------------------------------------


@registered(f"SELECT event_id, coalesce(v, lead(v) OVER (PARTITION BY user_id ORDER BY pos)) AS borrowed FROM (SELECT *, CASE WHEN event_type = 'purchase' THEN event_id END AS v FROM ({EVENTS}))")
def lead_borrow(spark, sf_dir):
    e = step_events(spark, sf_dir).withColumn("v", F.when(F.col("event_type") == "purchase", F.col("event_id")))
    return sequence.lead_borrow(e, ["user_id"], ["pos"], "v", "borrowed").select("event_id", "borrowed")


@registered(f"""SELECT user_id, island, min(pos) AS first_pos, count(*) AS n, min(event_type) AS kind FROM (SELECT *, sum(nw) OVER (PARTITION BY user_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS island FROM (
  SELECT *, CASE WHEN event_type = lag(event_type) OVER (PARTITION BY user_id ORDER BY pos) THEN 0 ELSE 1 END AS nw FROM ({EVENTS}))) GROUP BY user_id, island""")
def sibling_islands(spark, sf_dir):
    from pyspark.sql import Window

    same = F.col("event_type") == F.lag("event_type").over(Window.partitionBy("user_id").orderBy("pos"))
    got = sequence.islands(step_events(spark, sf_dir), ["user_id"], ["pos"], same)
    return got.groupBy("user_id", "island").agg(F.min("pos").alias("first_pos"), F.count(F.lit(1)).alias("n"), F.min("event_type").alias("kind"))


_DEPTH = "SELECT conv_id, turn, CAST(1 + turn % 4 AS INTEGER) AS depth FROM conversations"


@registered(f"""SELECT conv_id, turn, depth, (SELECT max(b.turn) FROM ({_DEPTH}) b WHERE b.conv_id = a.conv_id AND b.turn < a.turn AND b.depth < a.depth) AS parent FROM ({_DEPTH}) a""")
def ancestor_carry(spark, sf_dir):
    c = read(spark, sf_dir, "conversations").select("conv_id", "turn", (1 + F.col("turn") % 4).cast("int").alias("depth"))
    return sequence.ancestor(c, ["conv_id"], "turn", "depth", 4)


@registered(f"""SELECT event_id, CASE WHEN m IS NULL AND b = a THEN b END AS filled FROM (SELECT event_id, m, last_value(m IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b,
  first_value(m IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS a FROM (SELECT *, CASE WHEN event_type = 'purchase' THEN CAST(floor(value) AS BIGINT) % 3 END AS m FROM ({EVENTS})))""")
def span_fill(spark, sf_dir):
    mark = F.when(F.col("event_type") == "purchase", F.floor("value").cast("long") % 3)
    return sequence.span_fill(step_events(spark, sf_dir), ["user_id"], ["pos"], mark).select("event_id", "filled")


@registered("SELECT l_orderkey, l_linenumber, max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) OVER (PARTITION BY l_orderkey) AS worked FROM lineitem")
def group_exists_demote(spark, sf_dir):
    return sequence.exists_in_group(read(spark, sf_dir, "lineitem"), ["l_orderkey"], F.col("l_returnflag") == "R", "worked").select("l_orderkey", "l_linenumber", "worked")


@registered(f"SELECT event_id, CASE WHEN pos < min(CASE WHEN event_type = 'signup' THEN pos END) OVER (PARTITION BY user_id) THEN 1 ELSE 0 END AS early FROM ({EVENTS})")
def before_first(spark, sf_dir):
    return sequence.before_first(step_events(spark, sf_dir), ["user_id"], "pos", F.col("event_type") == "signup").select("event_id", "early")


@registered(f"SELECT event_id, first_value(nullif(v, 0) IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next_value FROM (SELECT *, CAST(floor(value) AS BIGINT) % 4 AS v FROM ({EVENTS}))")
def next_nonzero(spark, sf_dir):
    return sequence.next_nonzero(step_events(spark, sf_dir).withColumn("v", F.floor("value").cast("long") % 4), ["user_id"], ["pos"], "v").select("event_id", "next_value")


@registered("SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS n FROM orders) WHERE n = 1")
def last_per_key(spark, sf_dir):
    return sequence.last_per_key(read(spark, sf_dir, "orders"), ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")]).select("o_custkey", "o_orderkey")


@registered("SELECT conv_id, turn, last_value(CASE WHEN role = 'assistant' THEN turn END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS anchor FROM conversations")
def anchor_link(spark, sf_dir):
    a = F.when(F.col("role") == "assistant", F.col("turn"))
    return sequence.anchor_link(read(spark, sf_dir, "conversations"), ["conv_id"], ["turn", "role", "text"], a).select("conv_id", "turn", "anchor")


@registered(f"SELECT event_id, previous FROM (SELECT event_id, v, lag(v) OVER (PARTITION BY user_id ORDER BY pos) AS previous FROM (SELECT *, CAST(floor(value) AS BIGINT) AS v FROM ({EVENTS}))) WHERE previous > v")
def monotonic_violations(spark, sf_dir):
    return sequence.falls(step_events(spark, sf_dir).withColumn("v", F.floor("value").cast("long")), ["user_id"], ["pos"], "v").select("event_id", "previous")


# --- releases -------------------------------------------------------------


@registered("""WITH b AS (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN lang || '!' ELSE lang END AS lang FROM documents WHERE doc_id % 7 <> 0 UNION ALL SELECT doc_id + 10000000, lang FROM documents WHERE doc_id % 11 = 0)
  SELECT coalesce(a.doc_id, b.doc_id) AS doc_id, CASE WHEN a.doc_id IS NULL THEN 'added' WHEN b.doc_id IS NULL THEN 'removed' WHEN a.lang IS NOT DISTINCT FROM b.lang THEN 'same' ELSE 'reworded' END AS status FROM documents a FULL JOIN b ON a.doc_id = b.doc_id""")
def migration_added_removed(spark, sf_dir):
    a = read(spark, sf_dir, "documents").select("doc_id", "lang")
    b = a.where("doc_id % 7 <> 0").withColumn("lang", F.when(F.col("doc_id") % 5 == 0, F.concat("lang", F.lit("!"))).otherwise(F.col("lang")))
    return diff.compare(a, b.unionByName(a.where("doc_id % 11 = 0").withColumn("doc_id", F.col("doc_id") + 10000000)), ["doc_id"], "lang")


@registered()
def migration_greedy(spark, sf_dir):
    ids = structure.stable_ids(step_lines(spark, sf_dir), "doc_id", "line", ["line_no"])
    old = ids.select(F.col("doc_id").alias("section"), F.col("line_no").alias("ordinal"), F.col("step_id").alias("id"), F.col("norm").alias("text"))
    edit = step_lines(spark, sf_dir).withColumn("line", F.when(F.col("line_no") % 3 == 0, F.concat("line", F.lit(" more"))).otherwise(F.col("line")))
    new = structure.stable_ids(edit, "doc_id", "line", ["line_no"]).select(F.col("doc_id").alias("section"), F.col("line_no").alias("ordinal"), F.col("step_id").alias("id"), F.col("norm").alias("text"))
    return diff.migrations(old, new)


# --- trees, conditions, ranges, indexes -----------------------------------


@registered("SELECT o_orderkey, zone FROM orders JOIN (VALUES ('low', 0, 1000), ('mid', 1000, 100000), ('wide', 500, 200000)) z(zone, lo, hi) ON o_totalprice BETWEEN lo AND hi")
def zone_contains(spark, sf_dir):
    zones = spark.createDataFrame([("low", 0, 1000), ("mid", 1000, 100000), ("wide", 500, 200000)], "zone string, lo int, hi int")
    return read(spark, sf_dir, "orders").join(zones, F.col("o_totalprice").between(F.col("lo"), F.col("hi"))).select("o_orderkey", "zone")


# --- coverage and gates ---------------------------------------------------


@registered("SELECT lang, count(*) AS n_docs, count(l.doc_id) AS n_labelled, count(*) FILTER (WHERE quality = 1) AS n_good FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY lang")
def coverage_report(spark, sf_dir):
    lab = read(spark, sf_dir, "labels").withColumn("has", F.lit(1))
    return read(spark, sf_dir, "documents").join(lab, "doc_id", "left").groupBy("lang").agg(F.count(F.lit(1)).alias("n_docs"), F.count("has").alias("n_labelled"), F.count_if(F.col("quality") == 1).alias("n_good"))


@registered("""WITH c AS (SELECT lang AS metric, 100.0 * count(l.doc_id) / count(*) AS value FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY lang)
  SELECT metric FROM c LEFT JOIN (VALUES ('en', 90.0), ('de', 10.0), ('fr', 100.0)) b(metric_b, before) ON metric = metric_b WHERE value - coalesce(before, 0) < -2""")
def metric_vs_baseline(spark, sf_dir):
    now = coverage_report(spark, sf_dir).select(F.col("lang").alias("metric"), (100.0 * F.col("n_labelled") / F.col("n_docs")).alias("value"))
    base = spark.createDataFrame([("en", 90.0), ("de", 10.0), ("fr", 100.0)], "metric string, value double")
    return quality.regressed(now, base).select("metric")


@registered("""SELECT 'doc_text' AS check_name, count(*) AS population, count(*) FILTER (WHERE text IS NULL OR text = '') AS violations FROM documents
  UNION ALL SELECT 'label_range', count(*), count(*) FILTER (WHERE quality NOT IN (0, 1) OR toxic NOT IN (0, 1)) FROM labels
  UNION ALL SELECT 'discount_range', count(*), count(*) FILTER (WHERE l_discount > 0.05) FROM lineitem
  UNION ALL SELECT 'role_kind', count(*), count(*) FILTER (WHERE role NOT IN ('user', 'assistant')) FROM conversations""")
def schema_violations(spark, sf_dir):
    r = lambda name: read(spark, sf_dir, name)
    return quality.violations(
        [("doc_text", r("documents"), F.col("text").isNull() | (F.col("text") == "")), ("label_range", r("labels"), ~F.col("quality").isin(0, 1) | ~F.col("toxic").isin(0, 1)),
         ("discount_range", r("lineitem"), F.col("l_discount") > 0.05), ("role_kind", r("conversations"), ~F.col("role").isin("user", "assistant"))]
    )


@registered("SELECT doc_id AS key_value, count(*) AS n_rows FROM labels GROUP BY doc_id HAVING count(*) > 1 UNION ALL SELECT conv_id, count(*) FROM (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS n FROM conversations) WHERE turn <> n GROUP BY conv_id")
def invariants(spark, sf_dir):
    again = quality.repeated_keys(read(spark, sf_dir, "labels"), ["doc_id"]).select(F.col("doc_id").alias("key_value"), "n_rows")
    dense = structure.duplicate_ordinals(read(spark, sf_dir, "conversations"), ["conv_id"], ["turn"], "n").where("turn <> n")
    return again.unionByName(dense.groupBy(F.col("conv_id").alias("key_value")).agg(F.count(F.lit(1)).alias("n_rows")))


@registered(f"""WITH s AS ({_IDS}), k AS (SELECT s.step_id, s.doc_id, CASE {_VERB} ELSE 'none' END AS intent FROM s JOIN ({LINES}) USING (doc_id, line_no))
  SELECT intent, count(*) AS n_steps, count(l.doc_id) AS n_labelled, count(DISTINCT step_id) AS n_ids FROM k LEFT JOIN labels l ON k.doc_id = l.doc_id GROUP BY intent""")
def flagship_steps(spark, sf_dir):
    steps = structure.verb_rules(structure.stable_ids(step_lines(spark, sf_dir), "doc_id", "line", ["line_no"]), "line", VERBS)
    lab = read(spark, sf_dir, "labels").select("doc_id", F.lit(1).alias("has"))
    kinds = steps.withColumn("intent", F.coalesce("intent", F.lit("none"))).join(lab, "doc_id", "left")
    return kinds.groupBy("intent").agg(F.count(F.lit(1)).alias("n_steps"), F.count("has").alias("n_labelled"), F.countDistinct("step_id").alias("n_ids"))


# --- goods, classifiers, conditions ----------------------------------------


@registered()
def item_list_split(spark, sf_dir):
    items = step_lines(spark, sf_dir).select("doc_id", "line_no", F.posexplode(goods.goods(F.col("line"))).alias("item_no", "item"))
    return items.select("doc_id", "line_no", "item_no", F.col("item.name").alias("name"), F.col("item.count").alias("n"))


@registered("""SELECT n_nationkey, n_name AS place, n_nationkey % 3 <> 2 AS is_journey, CASE WHEN n_nationkey % 3 = 0 THEN 'kill' END AS phrase, CASE WHEN n_nationkey % 3 = 0 THEN 'npc' END AS intent FROM nation""")
def sentence_fields(spark, sf_dir):
    kind, name = F.col("n_nationkey") % 3, F.col("n_name")
    raw = F.when(kind == 0, F.concat(F.lit("Take the boat to "), name, F.lit(" and kill a Goblin"))).when(kind == 1, F.concat(F.lit("Charter a ship to the "), name)).otherwise(F.concat(F.lit("Buy 2x Rope in "), name, F.lit(" for later")))
    rows = read(spark, sf_dir, "nation").select("n_nationkey", sentences.destination(raw).alias("d"), sentences.interior_verb(raw, [("talk to", "npc"), ("kill", "npc")]).alias("v"))
    return rows.select("n_nationkey", "d.place", "d.is_journey", "v.phrase", "v.intent")


@registered("""SELECT s_name AS name, CASE s_suppkey % 4 WHEN 0 THEN 'item' WHEN 1 THEN 'place' END AS kind, CASE s_suppkey % 4 WHEN 0 THEN s_suppkey::VARCHAR || ',7' WHEN 1 THEN '' END AS ids,
  CASE s_suppkey % 4 WHEN 0 THEN 0 WHEN 1 THEN 1 END AS n_points, CASE s_suppkey % 4 WHEN 2 THEN 'choice needed' WHEN 3 THEN 'no page' END AS refusal FROM supplier""")
def page_resolve(spark, sf_dir):
    s, k = read(spark, sf_dir, "supplier").select("s_suppkey", "s_name"), F.col("s_suppkey") % 4
    item = F.concat(F.lit("{{Infobox Item\n|id = "), F.col("s_suppkey").cast("string"), F.lit(", 7, 7\n}}"))
    place = F.concat(F.lit("{{Infobox Location\n|map = {{Map|x = 3200|y = "), F.col("s_suppkey").cast("string"), F.lit("}}\n}}\n{{map|3089,3265|type=maplink}}"))
    pages = s.select(F.col("s_name").alias("title"), F.when(k == 0, item).when(k == 1, place).when(k == 2, F.lit("{{Disambig}} [[a]] [[b|c]]")).alias("markup"))
    got = page_names.resolve_names(s, pages, "s_name")
    return got.select("name", "kind", F.array_join("ids", ",").alias("ids"), F.when(F.col("points").isNotNull(), F.size("points")).alias("n_points"), "refusal")


_ADVICE = predicates.advice_pattern().replace("'", "''")


@registered(rf"""SELECT doc_id, line_no FROM ({LINES}) WHERE regexp_matches(line, '{_ADVICE}') OR regexp_matches(line, '^[^a-z]{{{predicates.SHOUT_CHARS},}}') OR regexp_matches(line, '^\s*[\[(].*[\])]\s*$')""")
def advice_lines(spark, sf_dir):
    return step_lines(spark, sf_dir).where(predicates.is_advice(F.col("line"))).select("doc_id", "line_no")


_BOUGHT = {"var": {"kind": "varplayer", "id": 1, "op": ">=", "value": 15}}
_FAILED_ODD = {"var": {"kind": "varplayer", "id": 2, "bit": 0, "set": True}}
_BRANCHES = [
    ({"all": [_BOUGHT, {"not": _FAILED_ODD}]}, "steady"),
    ({"any": [_BOUGHT, {"var": {"kind": "varplayer", "id": 9, "op": "==", "value": 0}}]}, "never"),
    ({"item": {"ids": [3, 4], "count": 28}}, "busy"),
    ({"zone": [[0, 0, 0, 9, 12, 0]]}, "near"),
]


@registered("""WITH s AS (SELECT user_id, count(*) FILTER (WHERE event_type = 'purchase') AS bought, count(*) FILTER (WHERE event_type = 'error') AS failed, count(*) FILTER (WHERE event_type = 'click') AS clicks,
  count(*) FILTER (WHERE event_type = 'view') AS views FROM events GROUP BY user_id)
  SELECT user_id, CASE WHEN bought >= 15 AND failed % 2 = 0 THEN 'steady' WHEN clicks + views >= 28 THEN 'busy' WHEN bought <= 9 AND failed <= 12 THEN 'near' ELSE 'other' END AS branch FROM s""")
def condition_algebra(spark, sf_dir):
    n = lambda kind: F.count_if(F.col("event_type") == kind)
    s = read(spark, sf_dir, "events").groupBy("user_id").agg(n("purchase").alias("bought"), n("error").alias("failed"), n("click").alias("clicks"), n("view").alias("views"))
    state = conditions.State(
        values=F.create_map(F.lit("varplayer:1"), "bought", F.lit("varplayer:2"), "failed"),
        held=F.create_map(F.lit(3), "clicks", F.lit(4), "views"),
        at=F.array("bought", "failed", F.lit(0)),
    )
    return s.select("user_id", conditions.branch(_BRANCHES, "other", state).alias("branch"))


@registered("""WITH s AS (SELECT p_partkey AS k, p_size AS n, CAST(regexp_extract(p_brand, '[0-9]+$') AS INTEGER) AS b, p_name AS t, p_retailprice > 1000 AS dear FROM part)
  SELECT k, CASE k % 6 WHEN 0 THEN n > b WHEN 1 THEN NOT (n % 7 = 3 OR n < 20) WHEN 2 THEN contains(t, 'ring') AND (k % 4 = 0 OR n >= 10) WHEN 3 THEN dear OR n = 5 WHEN 4 THEN (n BETWEEN 3 AND 30 OR n = 45) END AS holds FROM s""")
def condition_rows(spark, sf_dir):
    """Whether each row's own condition holds of its own state; unknown ones hold nothing (§2.15)."""
    n, b, k = F.col("p_size"), F.regexp_extract("p_brand", "[0-9]+$", 0), F.col("p_partkey")
    less = lambda v: F.concat(F.lit('{"var": {"kind": "varbit", "id": 1, "op": "<", "value": '), v, F.lit("}}"))
    own = (
        F.when(k % 6 == 0, F.concat(F.lit('{"var": {"kind": "varbit", "id": 1, "op": ">", "value": '), b, F.lit("}}")))
        .when(k % 6 == 1, F.concat(F.lit('{"not": {"any": [{"here": {"kind": "npc", "ids": [3]}}, '), less(F.lit("20")), F.lit("]}}")))
        .when(k % 6 == 2, F.concat(F.lit('{"all": [{"dialog": {"text": ["ring"]}}, {"any": [{"item": {"ids": [0]}}, {"not": '), less(F.lit("10")), F.lit("}]}]}")))
        .when(k % 6 == 3, F.lit('{"once": {"key": "dear", "when": {"var": {"kind": "varbit", "id": 1, "op": "==", "value": 5}}}}'))
        .when(k % 6 == 4, F.lit('{"zone": [[30, 9, 0, 3, 0, 0], [45, 0, 0, 45, 9, 0]]}'))
        .otherwise(F.when(k % 5 > 0, F.lit('{"all": [{"open": 1}, {"zone": [[0, 0, 0, 99, 99, 9]]}]}')).otherwise("{"))
    )
    rows = read(spark, sf_dir, "part").select(k.alias("k"), n.alias("n"), "p_name", (F.col("p_retailprice") > 1000).alias("dear"), own.alias("c"))
    state = conditions.State(
        values=F.create_map(F.lit("varbit:1"), "n"), held=F.create_map((F.col("k") % 4).cast("int"), F.lit(1)), at=F.array("n", F.lit(5), F.lit(0)),
        scene=F.array(F.concat(F.lit("npc:"), F.col("n") % 7)), said=F.col("p_name"), kept=F.create_map(F.lit("dear"), "dear"),
    )
    return conditions.hold(rows, "k", "c", state)


@registered(f"SELECT event_id, coalesce(bool_or(event_type = 'purchase') OVER (PARTITION BY user_id ORDER BY pos ROWS UNBOUNDED PRECEDING), false) AS bought FROM ({EVENTS})")
def latched_fact(spark, sf_dir):
    rows = conditions.latched(step_events(spark, sf_dir), ["user_id"], ["pos"], F.col("event_type") == "purchase", "bought")
    return rows.select("event_id", "bought")


# --- sources and sinks -----------------------------------------------------


def _even_brands(names: list[str]) -> dict[str, str]:
    return {n: n.lower() for n in names if n[-1] in "02468"}


@registered("SELECT p_partkey, CASE WHEN p_brand LIKE 'Brand#1%' THEN 'cached' WHEN right(p_brand, 1) IN ('0', '2', '4', '6', '8') THEN lower(p_brand) END AS value FROM part")
def cached_lookup(spark, sf_dir):
    part = read(spark, sf_dir, "part").select("p_partkey", "p_brand")
    cache = part.where("p_brand like 'Brand#1%'").select("p_brand", F.lit("cached").alias("value")).distinct()
    new = lookup.fetched(lookup.missing(part, cache, "p_brand"), "p_brand", _even_brands)
    return lookup.resolved(part, cache.unionByName(new), "p_brand").select("p_partkey", "value")


@registered("SELECT p_partkey, p_name FROM part QUALIFY row_number() OVER (PARTITION BY lower(p_name) ORDER BY p_partkey) = 1")
def first_wins(spark, sf_dir):
    return lookup.first_wins(read(spark, sf_dir, "part").select("p_partkey", "p_name"), "p_name", ["p_partkey"])


@registered("SELECT doc_id, n_chars FROM documents WHERE doc_id % 2 = 1 OR doc_id % 4 = 0")
def changed_versions(spark, sf_dir):
    now = read(spark, sf_dir, "documents").select("doc_id", "n_chars")
    seen = now.where("doc_id % 2 = 0").withColumn("n_chars", F.when(F.col("doc_id") % 4 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars")))
    return lookup.changed(now, seen, "doc_id", "n_chars")


@registered("""SELECT conv_id, turn, label, role AS cell FROM (SELECT *, last_value(CASE WHEN role = 'user' AND turn <> 2 THEN turn::VARCHAR END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn
  ROWS UNBOUNDED PRECEDING) AS label FROM conversations) WHERE role <> 'user'""")
def commented_table(spark, sf_dir):
    line = F.when(F.col("role") == "user", F.concat(F.lit("# "), F.col("turn").cast("string"))).otherwise(F.concat_ws("\t", F.col("turn").cast("string"), "role"))
    rows = lookup.commented_table(read(spark, sf_dir, "conversations").select("conv_id", "turn", line.alias("line")), ["conv_id"], "turn", "line", r"^# 2$")
    return rows.select("conv_id", "turn", "label", F.col("cells")[1].alias("cell"))


@registered("SELECT p_partkey, p_name FROM part WHERE p_partkey % 3 <> 0")
def append_checked(spark, sf_dir):
    part = read(spark, sf_dir, "part").select("p_partkey", "p_name")
    return sinks.append_checked(part, part.where("p_partkey % 3 = 0"), "p_partkey", "p_name")


@registered("SELECT '| ' || s_suppkey || ' | ' || s_name || ' |' AS value FROM supplier")
def markdown_report(spark, sf_dir):
    return sinks.markdown(read(spark, sf_dir, "supplier").select("s_suppkey", "s_name"))


# --- verdicts, boundaries, journeys ----------------------------------------


def _words(pattern: list[str]) -> str:
    return rf"\b(?:{'|'.join(pattern)})\b".replace("'", "''")


@registered(rf"""SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'R' THEN 'own rule' WHEN l_quantity % 2 = 1 THEN 'something before or after'
    WHEN l_partkey = l_suppkey THEN 'overlapping items' END AS blocker, l_linenumber > 1 OR l_quantity % 3 = 0 AS preparation FROM lineitem""")
def step_verdicts(spark, sf_dir):
    """Pickups that prove themselves, and preparation against doing."""
    line, odd = read(spark, sf_dir, "lineitem"), F.col("l_quantity") % 2 == 1
    pickup = F.when(odd, "Take the Rope and use it").otherwise("Take the Rope")
    task = F.when(F.col("l_quantity") % 3 == 0, "Go up and collect logs").otherwise("Go up to start it and collect logs")
    blocker = verdicts.pickup_blocker(pickup, F.col("l_returnflag") == "R", F.array(F.array("l_partkey"), F.array("l_suppkey")))
    return line.select("l_orderkey", "l_linenumber", blocker.alias("blocker"), verdicts.is_preparation(task, F.col("l_linenumber")).alias("preparation"))


@registered(rf"""SELECT doc_id, line_no, regexp_matches(line, '(?i){_words(verdicts.FETCHES_INSIDE)}') OR regexp_matches(line, '(?i)^\s*(?:when|during)\b[^,]*,\s*take\b')
    OR regexp_matches(line, '(?i)^\s*(?:{'|'.join([*verdicts.FETCHES, 'train', 'camp'])})\b') OR regexp_matches(regexp_extract(line, '^[^.!;(]*'), '(?i)\b(xp|experience)\b') AS preparation
    FROM ({LINES}) WHERE NOT regexp_matches(line, '(?i){_words(verdicts.DOES)}|\buntil\b')""")
def preparation_lines(spark, sf_dir):
    lines = step_lines(spark, sf_dir).where(~F.col("line").rlike(rf"(?i){_words(verdicts.DOES)}|\buntil\b"))
    return lines.select("doc_id", "line_no", verdicts.is_preparation(F.col("line"), F.lit(1)).alias("preparation"))


@registered(f"""WITH e AS (SELECT *, CASE WHEN event_type = 'purchase' THEN CAST(floor(value) AS BIGINT) % 7 END AS p, CASE WHEN event_type = 'view' THEN CAST(floor(value) AS BIGINT) % 9 END AS f FROM ({EVENTS})),
  a AS (SELECT *, lead(1) OVER w IS NULL AS final, event_type = 'signup' AS ends, event_type = 'click' AS starts FROM e WINDOW w AS (PARTITION BY user_id ORDER BY pos)),
  b AS (SELECT *, coalesce(p, CASE WHEN final AND ends THEN 6 END) AS q FROM a),
  c AS (SELECT *, first_value(nullif(q, 0) IGNORE NULLS) OVER x AS boundary, final AND NOT (starts AND NOT ends) AS completes, coalesce(first_value(nullif(f, 0) IGNORE NULLS) OVER x, CASE WHEN lead(ends) OVER y THEN 8 END) AS hand
    FROM b WINDOW x AS (PARTITION BY user_id ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), y AS (PARTITION BY user_id ORDER BY pos)),
  d AS (SELECT *, coalesce(last_value(boundary IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS opened FROM c)
  SELECT event_id, boundary, completes, CASE WHEN (boundary IS NULL OR boundary <= opened) AND hand > coalesce(f, 0) AND hand IN (2, 4, 6, 8) AND NOT final AND NOT ends AND NOT completes THEN hand END AS fine_boundary FROM d""")
def boundary_rulers(spark, sf_dir):
    """Coarse boundaries, and the finer ruler where they say nothing."""
    part = lambda kind, m: F.when(F.col("event_type") == kind, F.floor("value").cast("long") % m)
    e = step_events(spark, sf_dir).withColumn("p", part("purchase", 7)).withColumn("f", part("view", 9))
    ends, starts = F.col("event_type") == "signup", F.col("event_type") == "click"
    one = boundaries.coarse(e, ["user_id"], ["pos"], "p", ends, starts, F.lit(6).cast("long"))
    reach = F.array(*[F.lit(n).cast("long") for n in (2, 4, 6, 8)])
    return boundaries.finer(one, ["user_id"], ["pos"], "f", ends, F.lit(9).cast("long"), reach).select("event_id", "boundary", "completes", "fine_boundary")


@registered("""SELECT s_suppkey, CASE WHEN n_nationkey % 2 = 0 THEN 'boats' ELSE 'ships' END AS kind, n_nationkey AS x, CASE WHEN s_suppkey % 2 = 0 THEN 1 ELSE 9 END AS y, 2 AS n_departures
  FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_suppkey % 3 <> 0""")
def travel_routes(spark, sf_dir):
    """Suppliers sail to a side of their nation: by name, then by the nearest end of the route."""
    nation = read(spark, sf_dir, "nation").withColumn("port", F.concat(F.lit("Port "), F.regexp_replace(F.initcap(F.translate("n_name", "_", " ")), "[^A-Za-z0-9 ]", "")))
    sides = nation.select("n_nationkey", "port", F.explode(F.array(F.lit(1), F.lit(9))).alias("y"), "n_regionkey")
    point = lambda x, y: F.array(x.cast("int"), y.cast("int"), F.lit(0))
    docks = sides.select("*", F.explode(F.array(F.lit(20), F.lit(30))).alias("dock"))
    routes = docks.select(
        F.when(F.col("n_nationkey") % 2 == 0, "boats").otherwise("ships").alias("kind"), F.concat(F.lit("Elsewhere, "), F.col("port")).alias("label"), point(F.lit(99), F.col("dock")).alias("origin"),
        point(F.col("n_nationkey"), F.col("y")).alias("destination"), "dock", F.lit("sail").alias("action"),
    ).withColumnRenamed("dock", "id")
    none = "kind string, label string, origin array<int>, destination array<int>, id int, action string"
    supplier = read(spark, sf_dir, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    said = F.concat(F.when(F.col("s_suppkey") % 3 == 0, F.lit("Teleport to ")).otherwise(F.lit("Take the boat to ")), F.col("port"), F.lit(" and bank"))
    steps = supplier.select("s_suppkey", travel.journey(said).alias("j"), F.array(point(F.col("n_nationkey"), F.when(F.col("s_suppkey") % 2 == 0, 0).otherwise(8))).alias("place_points"))
    steps = steps.select("s_suppkey", "j.vehicle", F.col("j.place").alias("place_name"), "place_points")
    empty = spark.createDataFrame([], none)
    got = travel.travel(steps, "s_suppkey", routes, empty.drop("destination"), empty.select("kind", "label", "destination"), spark.createDataFrame([], "place string, kind string"))
    return got.select("s_suppkey", "kind", F.col("destination")[0].alias("x"), F.col("destination")[1].alias("y"), F.size("departures").alias("n_departures"))


@registered("""WITH d AS (SELECT lower(p_name) AS name, list_sort(list(DISTINCT p_size)) AS pts, list_sort(list(DISTINCT p_size) FILTER (WHERE p_partkey % 17 = 0)) AS tel FROM part WHERE p_partkey % 5 <> 0 GROUP BY 1),
  j AS (SELECT p_partkey, CASE WHEN len(pts) > 1 AND coalesce(len(tel), 0) = 1 THEN tel ELSE pts END AS pts FROM part LEFT JOIN d ON lower(p_name) = name)
  SELECT p_partkey, array_to_string(pts, ',') AS points, CASE WHEN pts IS NOT NULL THEN 'location' END AS points_source, coalesce(len(pts) > 1, false) AS ambiguous FROM j""")
def destination_pin(spark, sf_dir):
    """Every point of a place, pinned to its only teleport where there is one."""
    part = read(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    place = part.where("p_partkey % 5 <> 0").select(F.col("p_name").alias("name"), F.when(F.col("p_partkey") % 17 == 0, "teleport").otherwise("dungeon").alias("kind"), F.array("p_size").alias("point"))
    empty = spark.createDataFrame([], "name string, kind string, point array<int>")
    got = travel.destinations(part, "p_name", spark.createDataFrame([], "spelling string, name string"), place, empty, empty)
    flat = F.array_join(F.flatten("points").cast("array<string>"), ",")
    return got.select("p_partkey", flat.alias("points"), "points_source", "ambiguous")


@registered("""WITH k AS (SELECT *, p_partkey % 5 AS k, upper(left(p_name, 1)) || substr(p_name, 2) AS n FROM part)
  SELECT p_partkey, CASE k WHEN 0 THEN 'withdraw' WHEN 1 THEN 'object' WHEN 2 THEN 'npc' WHEN 3 THEN 'item' ELSE 'nav' END AS intent,
    CASE k WHEN 1 THEN n || ' rocks' WHEN 2 THEN 'Redbeard Frank' END AS target, CASE WHEN k IN (0, 1, 4) THEN n END AS item, CASE WHEN k IN (0, 1, 4) AND p_size > 1 THEN p_size END AS n_items,
    CASE WHEN k = 3 THEN 'Brimhaven' END AS destination, CASE WHEN k = 2 THEN 'Pirate' END AS tag, CASE k WHEN 0 THEN 'withdraw' WHEN 1 THEN 'collects' WHEN 4 THEN 'buys' END AS way FROM k""")
def annotate_steps(spark, sf_dir):
    """Whole sentences made from parts, read into all their fields."""
    name, k = F.concat(F.upper(F.substring("p_name", 1, 1)), F.substr("p_name", F.lit(2))), F.col("p_partkey") % 5
    count = F.concat(F.col("p_size").cast("string"), F.lit("x "), name)
    said = (
        F.when(k == 0, F.concat(F.lit("Withdraw: "), count, F.lit(" & Rope"))).when(k == 1, F.concat(F.lit("Mine "), count, F.lit(" on the way")))
        .when(k == 2, F.lit("Head West and talk to Redbeard Frank [Pirate]")).when(k == 3, F.lit("Take the boat to Brimhaven"))
        .otherwise(F.concat(F.lit("Head South and buy "), count, F.lit(" then go")))
    )
    got = annotate.annotate(read(spark, sf_dir, "part").select("p_partkey", said.alias("said")), "said")
    f = lambda c: F.col(f"fields.{c}")
    way = F.when(f("withdraw"), "withdraw").when(f("collects"), "collects").when(f("buys"), "buys")
    first = F.try_element_at(f("items"), F.lit(1))
    return got.select("p_partkey", f("intent").alias("intent"), f("target").alias("target"), first["name"].alias("item"), first["count"].alias("n_items"), f("destination").alias("destination"), f("tags")[0].alias("tag"), way.alias("way"))


@registered()
def annotate_lines(spark, sf_dir):
    """Every line of every document read into all fields; those with something found."""
    got = annotate.annotate(step_lines(spark, sf_dir).repartition("doc_id", "line_no"), "line")  # the rules cost far more than moving a line
    f = lambda c: F.col(f"fields.{c}")
    flat = got.select("doc_id", "line_no", f("intent").alias("intent"), f("target").alias("target"), F.size(f("items")).alias("n_items"), f("destination").alias("destination"), f("teleport_item").alias("teleport_item"))
    return flat.where("coalesce(intent, target, destination, teleport_item) IS NOT NULL OR n_items > 0")
