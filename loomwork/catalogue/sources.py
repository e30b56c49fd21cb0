"""Registered queries of sources, sinks and tables written as text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..codebase import extract, puzzles, tables
from ..plans.tables import scratch
from ..sources import files, lookup, sinks
from .codebase import _PARTS, ids, item, parts, relation, said, sources, step
from .registry import read, registered, step_events

c = F.col


def folder(spark: SparkSession, sf_dir: str, name: str) -> str:
    """An own place in the shared folder for files that a query writes and reads again."""
    return f"{scratch(spark)}/{name}-{abs(hash(sf_dir)) % 10**8}"


# --- files -----------------------------------------------------------------


@registered("SELECT DISTINCT n_regionkey, n_nationkey, 'enum ' || n_name || ' {}' AS body FROM nation")
def source_tree(spark, sf_dir):
    """Files in folders below a path, each read whole."""
    n = read(spark, sf_dir, "nation")
    path = folder(spark, sf_dir, "tree")
    n.select("n_regionkey", "n_nationkey", said("enum ", c("n_name"), " {}").alias("value")).write.mode("overwrite").partitionBy("n_regionkey", "n_nationkey").text(path)
    got = files.source_tree(spark, path, "*.txt")
    key = lambda k: F.regexp_extract("file", rf"{k}=([0-9]+)", 1).cast("int").alias(k)
    return got.select(key("n_regionkey"), key("n_nationkey"), F.rtrim("source").alias("body")).withColumn("body", F.regexp_replace("body", r"\s+$", ""))


@registered("SELECT n_regionkey AS region, string_agg(n_name, chr(10) ORDER BY n_nationkey) || CASE WHEN n_regionkey = 0 THEN chr(10) || 'NATION_1' ELSE '' END AS source FROM nation GROUP BY 1")
def joined_folders(spark, sf_dir):
    """All files of a folder, and those it imports behind them."""
    n = read(spark, sf_dir, "nation").select(c("n_regionkey").cast("string").alias("folder"), F.lpad(c("n_nationkey").cast("string"), 3, "0").alias("file"), c("n_name").alias("source"))
    imports = spark.createDataFrame([("0", "001"), ("0", "000")], "folder string, file string")
    return files.joined_folders(n, imports).select(c("folder").cast("int").alias("region"), "source")


@registered("SELECT p_partkey // 60 AS file, row_number() OVER (PARTITION BY p_partkey // 60 ORDER BY p_partkey) - 1 AS nth, 'PART_' || p_partkey AS constant, p_name AS name, CASE WHEN p_size % 3 <> 0 THEN p_size || ',' || p_partkey || ',1' END AS point FROM part")
def enum_rows(spark, sf_dir):
    """Rows of an enum, the last string before the point being the name."""
    point = F.when(c("s") % 3 != 0, said(", new WorldPoint(", c("s"), ", ", c("k"), ", 1), \"behind (it\"")).otherwise("")
    rows = sources(spark, sf_dir, said("PART_", c("k"), "(\"code, (x\", \"", c("name"), "\"", point, "),"))
    got = files.enum_rows(rows, "file", "source")
    return got.select("file", c("nth").cast("long").alias("nth"), "constant", "name", F.array_join(c("point").cast("array<string>"), ",").alias("point"))


@registered("SELECT p_partkey AS k, 'CONST_' || p_partkey AS constant, CAST(p_size AS BIGINT) AS value FROM part WHERE p_size % 2 = 0")
def class_constants(spark, sf_dir):
    """Whole-number constants of a class listing."""
    kind = F.when(c("p_size") % 2 == 0, "int").otherwise("String")
    dump = read(spark, sf_dir, "part").select(c("p_partkey").alias("k"), said("public class X {\n  public static final ", kind, " CONST_", c("p_partkey"), " = ", c("p_size"), ";\n}").alias("text"))
    return files.constants_of_classes(dump, "k", "text")


@registered("SELECT n_nationkey, n_name FROM nation WHERE n_nationkey % 2 = 0")
def optional_tables(spark, sf_dir):
    """Packed JSON that may be missing, and a release of it."""
    n, path, schema = read(spark, sf_dir, "nation").select("n_nationkey", "n_name"), folder(spark, sf_dir, "json"), "n_nationkey int, n_name string"
    sinks.write_documents(n.where("n_nationkey % 2 = 0"), f"{path}/release=2")
    return files.snapshot(spark, path, 2, schema).unionByName(files.snapshot(spark, path, 3, schema)).unionByName(files.optional_json(spark, f"{path}/none", schema))


@registered("SELECT conv_id, turn AS line_no, 'n' || turn AS name, CASE WHEN turn % 3 = 0 THEN role END AS kind FROM conversations")
def fixed_lines(spark, sf_dir):
    """A two-level list of fixed shape; a kind stays with its own name."""
    conv = read(spark, sf_dir, "conversations")
    line = F.array(said("  n", c("turn"), ":"), F.when(c("turn") % 3 == 0, said("    kind: ", c("role"))).otherwise(F.lit("    other: x")))
    rows = conv.select("conv_id", "turn", F.posexplode(line).alias("at", "line")).withColumn("line_no", c("turn") * 10 + c("at"))
    return files.fixed_lines(rows, ["conv_id"], "line_no", "line").select("conv_id", (c("line_no") / 10).cast("long").alias("line_no"), "name", "kind")


@registered("""SELECT url, CASE WHEN host = 'www.example.com' THEN 'unexpected host' WHEN length(html) > 4000 THEN 'too large' WHEN page_id % 3 = 0 THEN 'new' WHEN page_id % 3 = 1 THEN 'same' ELSE 'changed' END AS status,
  CASE WHEN host <> 'www.example.com' AND length(html) <= 4000 THEN sha256(html) END AS sha256 FROM (SELECT *, CASE WHEN page_id % 4 = 0 THEN 'www.example.com' ELSE 'ok.example.com' END AS host, 'https://' || CASE WHEN page_id % 4 = 0 THEN 'www.example.com' ELSE 'ok.example.com' END || '/' || page_id AS url FROM (SELECT page_id, html FROM pages))""")
def checked_files(spark, sf_dir):
    """Downloads by host, size and hash, against the hashes before."""
    p = read(spark, sf_dir, "pages").withColumn("url", said("https://", F.when(c("page_id") % 4 == 0, "www.example.com").otherwise("ok.example.com"), "/", c("page_id")))
    before = p.where("page_id % 3 > 0").select("url", F.when(c("page_id") % 3 == 1, F.sha2(c("html").cast("binary"), 256)).otherwise("?").alias("sha256"))
    return files.checked_files(p.select("url", "html"), "url", "html", ["ok.example.com"], 4000, before)


@registered(r"""WITH u AS (SELECT page_id, unnest(l) AS value, unnest(range(len(l))) AS spot FROM (SELECT page_id, regexp_extract_all(html, 'href="([^"]*)"', 1) AS l FROM pages)) SELECT page_id, value, row_number() OVER (PARTITION BY page_id ORDER BY min(spot)) - 1 AS place FROM u GROUP BY 1, 2""")
def distinct_links(spark, sf_dir):
    """Every link of a page once, where it is first seen."""
    p = read(spark, sf_dir, "pages")
    return files.distinct_in_order(p, "page_id", ["page_id"], F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))).withColumn("place", c("place").cast("long"))


def _three_pages(seed: object, cursor: object) -> tuple[list[str], object]:
    n = int(cursor or 0)
    return [f"{seed}-{n}-{k}" for k in range(2)], n + 1 if n < 2 else None


@registered("SELECT n_nationkey AS seed, page, n_nationkey || '-' || page || '-' || k AS value FROM nation, (VALUES (0), (1), (2)) p(page), (VALUES (0), (1)) q(k)")
def paged_interface(spark, sf_dir):
    """All pages of an interface for every seed."""
    return files.paged(read(spark, sf_dir, "nation").select(c("n_nationkey").alias("seed")), "seed", _three_pages)


def _some_texts(titles: list) -> dict:
    return {t: f"text of {t}" for t in titles if not t.endswith("3")}


@registered("SELECT n_name AS title, 'text of ' || n_name AS text FROM nation WHERE n_name NOT LIKE '%3'")
def page_texts(spark, sf_dir):
    """Texts of pages asked for in batches, those without one left out."""
    return files.page_texts(read(spark, sf_dir, "nation").select(c("n_name").alias("title")), "title", _some_texts)


def _failing(keys: list) -> dict:
    raise OSError("no answer")


@registered("SELECT n_nationkey, CAST(NULL AS VARCHAR) AS value FROM nation")
def best_effort_lookup(spark, sf_dir):
    """A lookup whose failure is a null and no end of the run."""
    return lookup.fetched(read(spark, sf_dir, "nation").select("n_nationkey"), "n_nationkey", _failing, strict=False)


def _names(keys: list) -> dict:
    return {k: f"nation {k}" for k in keys if k % 5}


@registered("SELECT n_nationkey, CASE WHEN n_nationkey % 5 <> 0 THEN 'nation ' || n_nationkey END AS value FROM nation")
def written_lookup(spark, sf_dir):
    """Answers and missing answers written to the cache before they are read (K7)."""
    n = read(spark, sf_dir, "nation").select("n_nationkey")
    path = folder(spark, sf_dir, "cache")
    lookup.looked_up(n.where("n_nationkey < 10"), "n_nationkey", path, _names)
    return lookup.looked_up(n, "n_nationkey", path, _names).dropDuplicates(["n_nationkey"])


@registered("SELECT 'nation' AS name, count(*) AS n FROM nation UNION ALL SELECT 'region', count(*) FROM region")
def side_outputs(spark, sf_dir):
    """Named tables written beside a result and packed, and read again (K2, K5)."""
    path = folder(spark, sf_dir, "side")
    sinks.write_all({t: read(spark, sf_dir, t) for t in ("nation", "region")}, path)
    rows = lambda t: spark.read.json(f"{path}/{t}").select(F.lit(t).alias("name"))
    unpacked = sinks.packed(spark, [f"{path}/nation", f"{path}/region"]).where(F.length("content") < 0).select(F.lit("").alias("name"))
    return rows("nation").unionByName(rows("region")).unionByName(unpacked).groupBy("name").agg(F.count(F.lit(1)).alias("n"))


# --- tables as text --------------------------------------------------------


@registered("""WITH p AS (SELECT p_partkey AS k, p_partkey // 60 AS page, p_size AS s, p_name AS n, row_number() OVER (PARTITION BY p_partkey // 60 ORDER BY p_partkey) - 1 AS nth FROM part)
  SELECT page, nth, n AS name, 'hut of ' || n AS place, s % 2 = 0 AS members, k || ',' || s || ',' || CASE WHEN s < 4 THEN s ELSE 0 END || ';1,2,' || CASE WHEN s < 4 THEN s ELSE 0 END AS points, CASE WHEN s % 5 = 0 THEN '3,1' ELSE '1,1' END AS counts FROM p WHERE s % 7 <> 0""")
def spawn_lines(spark, sf_dir):
    """Lines of a table written as templates, with templates and links inside."""
    p = parts(spark, sf_dir)
    amount = F.when(c("s") % 5 == 0, ",qty:3-5").otherwise("")
    name = F.when(c("s") % 7 == 0, "{{gone}}").otherwise(said("[[x|", c("name"), "]]"))
    line = said("{{ItemSpawnLine|name = ", name, "|location = ''hut'' of {{Link|a|b}}", c("name"), " ()|members = ", F.when(c("s") % 2 == 0, "Yes").otherwise("No"), "|plane = ", c("s"), "|x:", c("k"), ",y:", c("s"), amount, "|1,2}}")
    pages = p.groupBy("file").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("r", line.alias("t")))), lambda x: x["t"]), "\n| {{Other|x}} }}").alias("text"))
    got = tables.spawns(pages, "file", "text")
    points = F.array_join(F.transform("points", lambda q: F.array_join(q.cast("array<string>"), ",")), ";")
    return got.select(c("file").alias("page"), c("nth").cast("long").alias("nth"), "name", "place", "members", points.alias("points"), F.array_join(c("counts").cast("array<string>"), ",").alias("counts"))


@registered("SELECT p_name AS name, CAST(sum(p_size % 4) AS BIGINT) AS n_points FROM part GROUP BY 1 ORDER BY n_points DESC, name LIMIT 8")
def most_scattered(spark, sf_dir):
    """What lies in most places."""
    lines = read(spark, sf_dir, "part").select(c("p_name").alias("name"), F.slice(F.array(*[F.lit(k) for k in range(3)]), 1, (c("p_size") % 4).cast("int")).alias("points"))
    return tables.scattered_items(lines)


@registered("WITH i AS (SELECT DISTINCT l_orderkey AS page, l_partkey AS item FROM lineitem), o AS (SELECT DISTINCT l_orderkey AS page, l_suppkey AS owner FROM lineitem) SELECT page, item, owner FROM i JOIN o USING (page)")
def shop_stock(spark, sf_dir):
    """Everything sold on a page by everyone who owns it."""
    pages = read(spark, sf_dir, "lineitem").groupBy(c("l_orderkey").alias("page")).agg(F.collect_list("l_partkey").alias("sold"), F.collect_list("l_suppkey").alias("owners"))
    return tables.stock(pages, "page", "sold", "owners")


@registered("""SELECT p_partkey AS k, CASE s WHEN 0 THEN 'route' WHEN 1 THEN 'hub' WHEN 2 THEN 'arrival' ELSE 'dropped' END AS role, CASE WHEN s IN (0, 1, 3) THEN p_size || ',' || p_partkey || ',0' END AS origin, CASE WHEN s IN (0, 2) THEN p_partkey || ',' || p_size || ',1' END AS destination,
  CASE WHEN s IN (0, 1, 2) THEN p_size END AS id, CASE WHEN s IN (0, 1, 2) THEN 'Board Big ship' WHEN s = 3 THEN 'Board' ELSE '' END AS action FROM (SELECT *, p_size % 5 AS s FROM part)""")
def transport_rows(spark, sf_dir):
    """Rows of a transport table as routes, hubs, arrivals or nothing."""
    s = c("p_size") % 5
    a, b = F.when(s.isin(0, 1, 3), said(c("p_size"), " ", c("p_partkey"), " 0")).otherwise(""), F.when(s.isin(0, 2), said(c("p_partkey"), " ", c("p_size"), " 1")).otherwise("")
    act = F.when(s == 3, F.lit("Board")).otherwise(said("Board Big ship ", c("p_size")))
    rows = read(spark, sf_dir, "part").select(c("p_partkey").alias("k"), F.when(s == 4, F.array(a, b)).otherwise(F.array(a, b, act, F.lit(""), F.lit(""), F.lit("Q"))).alias("cells"))
    flat = lambda p: F.array_join(p.cast("array<string>"), ",")
    return tables.transports(rows).select("k", "role", flat(c("origin")).alias("origin"), flat(c("destination")).alias("destination"), "id", "action")


@registered("SELECT l_orderkey AS file, l_linenumber AS requirement, min(l_partkey) AS variable, min(l_suppkey) AS bit, min(CASE WHEN l_returnflag = 'R' THEN p_name END) AS title FROM lineitem LEFT JOIN part ON l_partkey = p_partkey AND p_size > 20 GROUP BY 1, 2")
def diary_bits(spark, sf_dir):
    """Every bit of a task list, with its title if a panel gives one."""
    line = read(spark, sf_dir, "lineitem").select(c("l_orderkey").alias("file"), c("l_linenumber").alias("requirement"), "l_partkey", "l_suppkey", "l_returnflag")
    bits = line.groupBy("file", "requirement").agg(F.min("l_partkey").alias("variable"), F.min("l_suppkey").alias("bit"))
    panels = line.join(read(spark, sf_dir, "part").where("p_size > 20"), c("l_partkey") == c("p_partkey")).select("file", c("l_partkey").alias("panel"), c("p_name").alias("title")).distinct()
    conditions = line.where("l_returnflag = 'R'").select("file", c("l_partkey").alias("panel"), "requirement")
    return tables.diary_tasks(bits, panels, conditions)


@registered("SELECT DISTINCT l_suppkey AS quest, l_partkey AS id, p_size AS point FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_size > 25")
def quest_scenery(spark, sf_dir):
    """Objects of a quest, each once, where their constant is known."""
    p = read(spark, sf_dir, "part")
    rows = read(spark, sf_dir, "lineitem").join(p, c("l_partkey") == c("p_partkey")).select(c("l_suppkey").alias("quest"), said("K", c("l_partkey")).alias("constant"), c("p_size").alias("point"))
    return tables.scenery(rows, p.where("p_size > 25").select(said("K", c("p_partkey")).alias("constant"), c("p_partkey").alias("id")))


@registered(r"""SELECT trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(p_name || ' (' || p_type || ')'), '\([^)]*\)', ' ', 'g'), '[^a-z0-9 ]', ' ', 'g'), '\b(the|a|an)\b', ' ', 'g'), '\s+', ' ', 'g')) AS key, count(DISTINCT p_size) AS n_points,
  string_agg(DISTINCT p_name || ' (' || p_type || ')', ';' ORDER BY p_name || ' (' || p_type || ')') AS names FROM part GROUP BY 1 HAVING count(DISTINCT p_size) > 1""")
def location_doubts(spark, sf_dir):
    """Places by their plain name, and the names that stand for several."""
    rows = read(spark, sf_dir, "part").select(said(c("p_name"), " (", c("p_type"), ")").alias("name"), "p_size")
    return tables.locations(rows, "name", "p_size")[1].select("key", "n_points", F.array_join("names", ";").alias("names"))


@registered("SELECT n_nationkey, CASE WHEN n_regionkey < 3 AND n_nationkey % 2 = 0 THEN ['north', 'south', 'east'][n_regionkey + 1] || '/easy' END AS tier FROM nation")
def diary_tiers(spark, sf_dir):
    """Region and tier by the words of a tag."""
    words = {"up": "north", "down": "south", "right": "east"}
    place = F.when(c("n_regionkey") == 0, "Up").when(c("n_regionkey") == 1, "Down").when(c("n_regionkey") == 2, "Right").otherwise("Nowhere")
    tag = said("Go", place, F.when(c("n_nationkey") % 2 == 0, "EasyDiary").otherwise("Diary"))
    t = tables.tier(tag, words, ["easy", "hard"])
    return read(spark, sf_dir, "nation").select("n_nationkey", F.concat_ws("/", t["region"], t["tier"]).alias("tier")).withColumn("tier", F.nullif(c("tier"), F.lit("")))


@registered(f"WITH {_PARTS} SELECT file, count(*) AS n_steps, count(*) AS n_items, count(DISTINCT s) AS n_values, max(s) AS last_value FROM q GROUP BY file")
def source_totals(spark, sf_dir):
    """What was read of every file."""
    rel = relation(spark, sf_dir, *item(), *step(), said("steps.put(", c("s"), ", step", c("r"), ");"))
    steps = extract.declarations(rel).where(c("type") == "NpcStep")
    return tables.assembled(steps, extract.progress(rel), extract.items(rel))


@registered(f"WITH {_PARTS}, b AS (SELECT file, s % 4 AS leaf, count(*) AS k FROM q WHERE s % 4 > 1 GROUP BY 1, 2) SELECT file AS folder, count(*) AS n, count(*) FILTER (WHERE s % 4 <= 1) AS n_readable, (SELECT arg_max(leaf, k * 10 - leaf) FROM b WHERE b.file = q.file) AS blocked_by FROM q GROUP BY file")
def first_blocking(spark, sf_dir):
    """Totals of a folder, and what stands in the way most often."""
    rows = parts(spark, sf_dir).select(c("file").alias("folder"), "r", (c("s") % 4).alias("leaf"))
    return tables.first_blocking(rows, "folder", "r", c("leaf") <= 1, "leaf")


_DIAL = """int solve(int id, int target, int right, int left) { int now = get(id); if (now != target) { return Math.floorMod(now - target, %s) < Math.floorMod(target - now, %s) ? left : right; } return 0; }"""


@registered("SELECT p_partkey AS file, d AS position, 'VarbitID.D' || d AS variable, CAST(1 + p_size % 9 AS INTEGER) AS target, 10 + d AS left_id, 20 + d AS right_id FROM part, (VALUES (0), (1), (2)) t(d) WHERE p_size % 3 <> 0 AND p_size % 5 <> 0")
def dial_puzzles(spark, sf_dir):
    """Dials turned the shorter way, recognised by the arithmetic; another arithmetic is nothing."""
    p = read(spark, sf_dir, "part")
    size = F.when(c("p_size") % 5 == 0, "1").otherwise("9")
    solve = said("int solve(int id, int target, int right, int left) { int now = get(id); if (now != target) { return Math.floorMod(now - target, ", size, ") < Math.floorMod(", F.when(c("p_size") % 3 == 0, "now - target").otherwise("target - now"), ", ", size, ") ? left : right; } return 0; }")
    numbers = said("int T = ", 1 + c("p_size") % 9, "; ", *[F.lit(f"int L{d} = {10 + d}; int R{d} = {20 + d}; ") for d in range(3)])
    calls = F.lit("void draw() { " + " ".join(f"marks.replace({d}, solve(VarbitID.D{d}, T, R{d}, L{d}));" for d in range(3)) + " }")
    rows = p.select(c("p_partkey").alias("file"), said("class P { ", numbers, solve, calls, " }").alias("source"))
    return puzzles.dial_rows(rows).select("file", "position", "variable", "target", c("left").alias("left_id"), c("right").alias("right_id"))


@registered("""SELECT p_partkey AS file, d AS dial, CAST((p_size + d) % 7 AS INTEGER) AS target, CAST(4 + 3 * d AS INTEGER) AS down, 'Open the ' || p_name || '.' AS sentence, CASE WHEN (p_size + d) % 7 = 0 THEN 'none' WHEN (7 - (p_size + d) % 7) % 7 < (p_size + d) % 7 THEN 'down' ELSE 'up' END AS way,
  least((7 - (p_size + d) % 7) % 7, (p_size + d) % 7) AS clicks FROM part, (VALUES (0), (1)) t(d) WHERE p_size % 3 <> 0""")
def lock_puzzles(spark, sf_dir):
    """Combination locks bound to their letters where they are used, with the clicks from zero."""
    p = read(spark, sf_dir, "part")
    least = F.when(c("p_size") % 3 == 0, F.lit("return 1;")).otherwise(F.lit("return Math.min(Math.floorMod(now - target, SIZE), Math.floorMod(target - now, SIZE));"))
    source = said(
        "class Code extends Step { int START_DOWN_ARROW = 4; int ARROW_INTERVAL = 3; public Code(Helper helper, String thing, int... codes) { super(helper, \"Open the \" + thing + \".\"); } ",
        "int way(int now, int target) { return Math.floorMod(now - target, SIZE) < Math.floorMod(target - now, SIZE) ? down : up; } int far(int now, int target) { ", least, " } } ",
        "class Q { void set() { open = new Code(this, \"", c("p_name"), "\", 7, ", c("p_size") % 7, ", ", (c("p_size") + 1) % 7, "); } }",
    )
    got = puzzles.lock_rows(p.select(c("p_partkey").alias("file"), source.alias("source")))
    t = puzzles.turns(F.lit(0), c("target"), c("size"))
    return got.select("file", "dial", "target", "down", "sentence", t["way"].alias("way"), t["clicks"].alias("clicks"))
