"""Registered queries of names, lists and likeness."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..codebase import extract
from ..functions import predicates, sentences
from ..functions import text as T
from ..operators import resolve, sequence
from .codebase import said
from .registry import EVENTS, read, registered, step_events

c = F.col


@registered(r"""WITH l AS (SELECT page_id, unnest(l) AS u, unnest(range(len(l))) AS spot FROM (SELECT page_id, regexp_extract_all(html, 'href="([^"]*)"', 1) AS l FROM pages)), t AS (SELECT page_id, trim(replace(regexp_replace(u, '#.*$', ''), '_', ' ')) AS target, spot FROM l WHERE NOT regexp_matches(u, '[|\]]'))
  SELECT page_id, target, row_number() OVER (PARTITION BY page_id ORDER BY min(spot)) - 1 AS place FROM t GROUP BY 1, 2""")
def links_extract(spark, sf_dir):
    """Targets of links, each once and in order, anchors cut (A2)."""
    markup = F.regexp_replace("html", r'href="([^"|\]]*)"', "[[$1|label]]")
    return read(spark, sf_dir, "pages").select("page_id", F.posexplode(T.link_targets(F.regexp_replace(markup, r"\[\[\[+", "[["))).alias("place", "target")).withColumn("place", c("place").cast("long"))


@registered("SELECT p_partkey AS k, CASE p_size % 3 WHEN 2 THEN NULL ELSE upper(left(p_name, 1)) || regexp_extract(substr(p_name, 2), '^(\\S+)', 1) || CASE WHEN p_size % 3 = 1 THEN ' of ' || upper(regexp_extract(p_name, ' (\\S)', 1)) || regexp_extract(p_name, ' \\S(.*)$', 1) ELSE '' END END AS name FROM part")
def proper_noun_run(spark, sf_dir):
    """The capitalised name that leads a clause, articles skipped, particles kept inside."""
    first, rest = F.initcap(F.regexp_extract("p_name", r"^(\S+)", 1)), F.initcap(F.regexp_extract("p_name", r" (.*)$", 1))
    k = c("p_size") % 3
    text = F.when(k == 0, said("North-East to the ", first, " again, Sir")).when(k == 1, said("the ", first, " of ", rest, " https://x.example/Y (Z)")).otherwise(said("to a ", c("p_name")))
    return read(spark, sf_dir, "part").select(c("p_partkey").alias("k"), sentences.name_run(text).alias("name"))


@registered("""SELECT name, string_agg(DISTINCT intent, ',' ORDER BY intent) AS intents FROM (
  SELECT lower(p_name) AS name, 'item' AS intent FROM part UNION ALL SELECT lower(s_name), 'npc' FROM supplier UNION ALL SELECT lower(n_name), 'place' FROM nation UNION ALL SELECT lower(r_name), 'nav' FROM region UNION ALL SELECT lower(p_name), 'withdraw' FROM part WHERE p_size > 30) GROUP BY name""")
def candidates_intents(spark, sf_dir):
    """Every name with all that is asked of it, from steps and curated tables."""
    r = lambda t: read(spark, sf_dir, t)
    got = resolve.candidates([(r("part"), "p_name", "item"), (r("supplier"), "s_name", "npc"), (r("nation"), "n_name", "place"), (r("region"), "r_name", "nav"), (r("part").where("p_size > 30"), "p_name", "withdraw")])
    return got.select("name", F.array_join("intents", ",").alias("intents"))


@registered("SELECT p_size, count(DISTINCT p_brand) AS n_brands, string_agg(DISTINCT p_brand, ',' ORDER BY p_brand) AS brands FROM part GROUP BY p_size")
def inverted_index(spark, sf_dir):
    """The sorted things under every key."""
    got = extract.positions(read(spark, sf_dir, "part"), "p_size", "p_brand")
    return got.select("p_size", F.size("values").cast("long").alias("n_brands"), F.array_join("values", ",").alias("brands"))


@registered("SELECT l_partkey, l_orderkey, l_linenumber FROM lineitem WHERE l_partkey IN (SELECT l_partkey FROM lineitem GROUP BY 1 HAVING count(*) <= 25)")
def having_drop_large(spark, sf_dir):
    """Keys with too many rows dropped as a whole."""
    return resolve.few(read(spark, sf_dir, "lineitem"), "l_partkey", 25).select("l_partkey", "l_orderkey", "l_linenumber")


@registered("""WITH g AS (SELECT regexp_replace(lower(p_name), '[^a-z0-9]', '', 'g') AS key, count(DISTINCT p_size) AS n, min(p_size) AS size FROM part WHERE p_size % 2 = 0 GROUP BY 1 HAVING count(*) <= 3)
  SELECT p_partkey, g.size AS place FROM part LEFT JOIN g ON g.key = regexp_replace(lower(p_name), '[^a-z0-9]', '', 'g') AND g.n = 1""")
def ground_spawns(spark, sf_dir):
    """Where a thing lies, if in few places and its spelling is nobody else's."""
    p = read(spark, sf_dir, "part").withColumn("key", T.squash(c("p_name")))
    few = resolve.few(p.where("p_size % 2 = 0"), "key", 3)
    one = resolve.unambiguous(few.select("key", c("p_size").alias("place")), "key", "place")
    return p.join(one, "key", "left").select("p_partkey", "place")


@registered("SELECT s_nationkey, s_suppkey, partner FROM (SELECT a.s_nationkey, a.s_suppkey, b.s_suppkey AS partner, row_number() OVER (PARTITION BY a.s_suppkey ORDER BY b.s_suppkey) AS n FROM supplier a JOIN supplier b ON a.s_nationkey = b.s_nationkey AND a.s_suppkey <> b.s_suppkey) WHERE n <= 4")
def self_join_network(spark, sf_dir):
    """The first other stops of the same network."""
    return resolve.partners(read(spark, sf_dir, "supplier"), "s_nationkey", "s_suppkey", 4)


_KEY = "regexp_replace(lower(text), '[^a-z0-9]', '', 'g')"


@registered(f"WITH k AS (SELECT item_id, {_KEY} AS t FROM benchmark) SELECT a.item_id, min(levenshtein(a.t, b.t)) AS distance FROM k a JOIN k b ON left(a.t, 2) = left(b.t, 2) AND a.item_id <> b.item_id GROUP BY a.item_id")
def similarity_topk(spark, sf_dir):
    """The least edit distance to another text that begins alike."""
    rows = read(spark, sf_dir, "benchmark").select("item_id", T.squash(c("text")).alias("t"))
    return resolve.nearest_texts(rows, "item_id", "t", F.substring("t", 1, 2))


@registered(rf"WITH k AS (SELECT doc_id, regexp_replace(regexp_extract(lower(text), '^\S+ \S+'), '[^ -~]', '', 'g') AS t FROM documents WHERE text IS NOT NULL), d AS (SELECT t, count(*) AS n FROM k GROUP BY t), m AS (SELECT a.t, least(min(CASE WHEN a.n > 1 THEN 0 END), min(levenshtein(a.t, b.t)) FILTER (a.t <> b.t AND levenshtein(a.t, b.t) <= 3)) AS distance FROM d a, d b GROUP BY a.t) SELECT doc_id, distance FROM k JOIN m ON k.t = m.t WHERE distance IS NOT NULL")
def alike_openings(spark, sf_dir):
    """The least edit distance, up to three, of a document's first two words to another's."""
    rows = read(spark, sf_dir, "documents").where("text is not null").select("doc_id", F.regexp_replace(F.regexp_extract(F.lower("text"), r"^\S+ \S+", 0), "[^ -~]", "").alias("t"))
    return resolve.nearest_alike(rows, "doc_id", "t", 3)


@registered("SELECT l_orderkey, greatest(max(l_partkey) - min(l_partkey), max(l_suppkey) - min(l_suppkey)) > 64 AS scattered FROM lineitem GROUP BY l_orderkey")
def scattered_points(spark, sf_dir):
    """Whether the points of a key are in one place."""
    return predicates.spread(read(spark, sf_dir, "lineitem"), "l_orderkey", ["l_partkey", "l_suppkey"])


@registered(f"""WITH RECURSIVE e AS (SELECT user_id, pos, CAST(floor(value) AS BIGINT) % 50 AS c FROM ({EVENTS})), r AS (SELECT user_id, CAST(0 AS BIGINT) AS pos, CAST(NULL AS BIGINT) AS placed, CAST(-1 AS BIGINT) AS fl FROM (SELECT DISTINCT user_id FROM e)
  UNION ALL SELECT e.user_id, e.pos, CASE WHEN c >= fl THEN c WHEN c + 20 >= fl THEN c + 20 END, CASE WHEN c >= fl THEN c WHEN c + 20 >= fl THEN c + 20 ELSE fl END FROM r JOIN e ON e.user_id = r.user_id AND e.pos = r.pos + 1)
  SELECT user_id, pos, placed FROM r WHERE pos > 0""")
def monotone_place(spark, sf_dir):
    """Each row at its smallest place that is not before the last one."""
    n = F.floor("value").cast("long") % 50
    return sequence.monotone_place(step_events(spark, sf_dir).withColumn("c", F.array(n, n + 20)), ["user_id"], "pos", "c")


@registered(r"SELECT p_partkey AS k, trim(regexp_replace(lower(p_name), '\s+', ' ', 'g')) AS folded, lower(regexp_replace(p_type, '[^A-Za-z0-9_.-]', '_', 'g')) || '-' AS safe, CASE WHEN p_name LIKE '%''%' THEN '' ELSE lower(p_name) END AS spoken FROM part")
def normalised_names(spark, sf_dir):
    """Spellings that are told apart or not: folded, file-safe, spoken."""
    p = read(spark, sf_dir, "part")
    safe = F.regexp_replace(F.lower(T.cache_name(c("p_type"))), "[0-9a-f]{8}$", "")
    return p.select(c("p_partkey").alias("k"), T.collapsed(F.upper("p_name")).alias("folded"), safe.alias("safe"), T.word_text(T.spoken_key(c("p_name"))).alias("spoken"))
