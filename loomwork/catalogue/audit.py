"""The audit of a guide that orders, parts and suppliers make up, beside the same checks in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import audit
from .registry import read, registered

c = F.col

# A guide's fields by the numbers of an order (k, m: order and customer key) or of a part (k, m: key and size).
_STEP = """k AS place, CAST(floor(k / 16) AS STRING) AS section, concat('S', CAST(floor(k / 16) AS STRING)) AS title, CAST(k % 16 AS INT) AS ordinal, CAST(1 + m % 3 AS INT) AS depth,
  concat('i', CASE WHEN k % 50 = 0 THEN 0 ELSE k END) AS step_id, CASE m % 7 WHEN 0 THEN 'Take a bucket' WHEN 1 THEN 'See {{x' ELSE concat('Talk to ', k) END AS text,
  CASE WHEN m % 2 = 0 THEN array(named_struct('quest', 'a'), named_struct('quest', CASE WHEN k % 3 = 0 THEN 'b' END)) END AS tags, CASE WHEN m % 3 < 2 THEN concat('q', m % 5) END AS quest, m % 2 = 0 AS quest_step,
  CASE WHEN m % 11 = 0 THEN concat('q', k % 6) END AS context, CASE WHEN m % 4 = 0 THEN CAST(k % 12 AS INT) END AS done_at, CASE WHEN m % 9 = 0 THEN CAST(k % 7 AS INT) END AS done_at_panel, CASE WHEN m % 13 = 0 THEN true END AS completes,
  CAST(NULL AS BOOLEAN) AS start_only, CASE WHEN m % 19 = 0 THEN 'x' END AS stop_items, CASE WHEN m % 17 = 0 THEN CAST(k % 14 AS INT) END AS stop_value,
  CASE WHEN m % 23 = 0 THEN concat('{"var": {"kind": "varbit", "id": 1, "bit": ', k % 40, '}}') END AS stop_condition, CAST(NULL AS BOOLEAN) AS stop_unresolved,
  CASE WHEN m % 6 = 0 THEN concat('1:', k % 40) END AS task, CASE WHEN m % 8 = 0 THEN true END AS advice, CASE WHEN m % 5 = 0 THEN named_struct('varplayer', 1, 'bit', CAST(k % 40 AS INT)) END AS bit, m % 7 = 1 AS acquires,
  CASE WHEN m % 3 = 0 THEN array(named_struct('name', 'n', 'ids', CASE WHEN k % 2 = 0 THEN array(4) ELSE CAST(array() AS ARRAY<INT>) END, 'count', CASE WHEN k % 5 > 0 THEN CAST(k % 3 AS INT) END)) END AS items,
  CASE WHEN m % 10 = 0 THEN array(1, 2, CAST(k % 2 AS INT)) END AS arrives_at, CASE WHEN m % 20 = 0 THEN array(array(1, 2, 0)) END AS destination,
  CASE WHEN m % 4 < 2 THEN named_struct('points', CASE WHEN k % 5 = 0 THEN array(array(1, 2)) END, 'ids', CASE WHEN k % 2 = 0 THEN array(4) END, 'kind', CASE WHEN k % 3 = 0 THEN 'npc' END, 'confidence', CASE WHEN k % 4 = 0 THEN 'inferred' END, 'name', CASE WHEN k % 8 = 0 THEN 'x' END, 'names', CAST(NULL AS ARRAY<STRING>)) END AS target,
  CAST(NULL AS ARRAY<INT>) AS travel, CASE WHEN m % 12 = 0 THEN array(named_struct('name', 's', 'ids', CASE WHEN k % 2 = 0 THEN array(1) END)) END AS sellers,
  CASE WHEN m % 14 = 0 THEN named_struct('ids', CAST(NULL AS ARRAY<INT>), 'collection', CASE WHEN k % 2 = 0 THEN 'tabs' END, 'via', CASE WHEN k % 3 = 0 THEN 'tab' END) END AS teleport, m % 15 = 0 AS withdraw"""
_INSTRUCTION = """k AS place, concat('o', m) AS owner, CAST(k AS STRING) AS at, CASE WHEN k % 9 = 0 THEN 'a}}' WHEN k % 4 > 0 THEN 'say' END AS text, CASE WHEN k % 6 = 0 THEN array(1, 2, 0) WHEN k % 10 = 0 THEN array(1) END AS point, CAST(NULL AS ARRAY<INT>) AS ids,
  CASE WHEN k % 8 = 0 THEN array(named_struct('text', CASE WHEN k % 16 = 0 THEN 't' END, 'point', CAST(NULL AS ARRAY<INT>), 'ids', CAST(NULL AS ARRAY<INT>))) END AS branches, CASE WHEN k % 7 = 0 THEN CASE WHEN m % 2 = 0 THEN '3' ELSE '"x"' END END AS icon,
  CASE WHEN k % 5 = 0 THEN array('{"interface": 3}', concat('{"interface": ', m % 3, ', "', CASE WHEN m % 2 = 0 THEN 'child' ELSE 'kid' END, '": 1}')) END AS widgets,
  CASE k % 11 WHEN 0 THEN concat('{"zone": [[', m, ', 1, 0, 25, 2, 0]]}') WHEN 1 THEN '{"open": "x"}' WHEN 2 THEN '{"open": 3}' END AS condition,
  CASE WHEN k % 12 = 0 THEN array(concat('{"size": ', m % 5, ', "parent": 1, "submit": 2, "cycles": [{"target": 1, "varc": 1, "down": 1, "up": 2}, {"target": 0, "varc": 1, "down": 3, "up": 4}]}')) END AS locks, m % 4 = 0 AS spread, CASE WHEN k % 3 = 0 THEN array('Yes.', CASE WHEN m % 3 = 0 THEN ' ' ELSE 'No.' END) END AS dialogue"""

# name, what it looks at, what is wrong, over the numbers; h, hc, ht: known quest, carried quest, task; lv, pc: a quest's last value and length.
_QUEST, _GOAL = "m % 3 < 2", "m % 19 = 0 OR m % 17 = 0 OR m % 23 = 0"
_SIGNALS = "(CASE WHEN m % 19 = 0 THEN 1 ELSE 0 END + CASE WHEN m % 17 = 0 AND k % 14 > 0 THEN 1 ELSE 0 END + CASE WHEN m % 23 = 0 THEN 1 ELSE 0 END)"
_STEPS = [
    ("step ids repeat", "true", "k % 50 = 0 AND nth > 1"), ("unknown quest", _QUEST, "NOT h"), ("unknown carried quest", "m % 11 = 0", "NOT hc"), ("unknown diary task", "m % 6 = 0", "k % 40 >= 25"),
    ("target point malformed", "m % 4 < 2", "k % 5 = 0"), ("target ids without a kind", "m % 4 < 2", "k % 2 = 0 AND k % 3 > 0"),
    ("quest goal without one signal", _GOAL, f"NOT ({_SIGNALS} = 1 AND m % 2 = 0 AND {_QUEST} AND h AND m % 4 > 0 AND m % 9 > 0 AND m % 13 > 0 AND (m % 17 > 0 OR k % 14 BETWEEN 1 AND lv) AND (m % 23 > 0 OR k % 40 < 32))"),
    ("quest step fetches", "m % 2 = 0", "m % 7 = 0"), ("quest step names several quests", "m % 2 = 0", "k % 3 = 0"),
    ("boundary outside its quest", "m % 4 = 0", f"{_QUEST} AND h AND k % 12 > lv"), ("boundary on another step", "m % 4 = 0", f"NOT ({_QUEST} AND h)"), ("boundary goes back", "m % 4 = 0", f"{_QUEST} AND k % 12 < before"),
    ("advice drives a quest", "m % 8 = 0", "m % 2 = 0"), ("carried quest on a quest step", "m % 11 = 0", "m % 2 = 0"), ("diary bit out of range", "m % 5 = 0", "k % 40 > 31"), ("diary task is not its bit", "m % 5 = 0", "false"),
    ("held items without ids", "m % 7 = 1", "m % 3 > 0 OR k % 2 = 1"), ("arrival is no known place", "m % 10 = 0", "m % 20 > 0 OR k % 2 = 1"), ("seller without ids", "m % 12 = 0", "k % 2 = 1"), ("teleport item without ids", "m % 14 = 0", "k % 2 = 0"),
    ("withdrawal without items", "m % 15 = 0", "m % 3 > 0"), ("item count below one", "m % 3 = 0 AND k % 5 > 0", "k % 3 = 0"), ("carried quest without origin", "m % 11 = 0", "NOT (m % 3 > 0 AND coalesce(least_depth < 1 + m % 3, false)) AND NOT coalesce(first_at < k % 16 AND k % 16 < last_at, false)"),
    ("handover outside its list", "m % 9 = 0", f"NOT ({_QUEST} AND h AND k % 7 > 0 AND k % 7 < pc)"), ("handover never observed", "m % 9 = 0", f"NOT ({_QUEST} AND h AND k % 7 < 2)"), ("handover on the last step", "m % 9 = 0", "m % 13 = 0"),
    ("carried quest on advice", "m % 11 = 0", "m % 8 = 0"), ("sellers beside a person", "m % 12 = 0", "m % 4 < 2 AND k % 3 = 0"), ("teleport without a method", "m % 14 = 0", "k % 3 > 0"), ("name-matched target without a name", "m % 4 < 2 AND k % 4 = 0", "k % 8 > 0"),
    ("step carries markup", "true", "m % 7 = 1"), ("an earlier step ends the quest", "m % 13 = 0", f"NOT ({_QUEST} AND coalesce(k = last_of_quest, false))"), ("the end stops partway", "m % 13 = 0", "m % 4 = 0"),
]
_SPOKEN = "k % 9 = 0 OR k % 4 > 0 OR k % 6 = 0 OR k % 10 = 0 OR k % 16 = 0"
_INSTRUCTIONS = [
    ("instruction says nothing", "true", f"NOT ({_SPOKEN})"), ("instruction point malformed", "true", "k % 6 > 0 AND k % 10 = 0"), ("icon is no item id", "true", "k % 7 = 0 AND m % 2 = 1"), ("condition cannot be answered", "true", "k % 11 = 1"),
    ("mark names no interface", "true", "k % 5 = 0 AND m % 3 = 0"), ("mark carries unknown keys", "true", "k % 5 = 0 AND m % 2 = 1"), ("lock cannot be solved", "true", "k % 12 = 0 AND m % 5 < 2"), ("spread without a point", "true", "m % 4 = 0 AND k % 6 > 0 AND k % 10 > 0"),
    ("dialogue option without words", "true", "k % 3 = 0 AND m % 3 = 0"), ("zone box the wrong way round", "true", "k % 11 = 0 AND m > 25"), ("instruction carries markup", "true", "k % 9 = 0"),
]


def _counted(table: str, checks: list[tuple[str, str, str]], label: str) -> str:
    one = "SELECT '{0}' AS check_name, count(*) FILTER ({1}) AS population, count(*) FILTER (({1}) AND ({2})) AS violations, coalesce((SELECT string_agg(l, ', ' ORDER BY k) FROM (SELECT {4} AS l, k FROM {3} WHERE ({1}) AND ({2}) ORDER BY k LIMIT 5)), '') AS sample FROM {3}"
    return " UNION ALL ".join(one.format(*check, table, label) for check in checks)


_SQL = f"""WITH o AS (SELECT o_orderkey AS k, o_custkey AS m, CASE WHEN o_custkey % 3 < 2 THEN o_custkey % 5 END AS q, o_orderkey // 16 AS sec FROM orders),
 r AS (SELECT sec, q AS rq, k % 16 AS ord, 1 + m % 3 AS depth, NULL AS ck FROM o WHERE q IS NOT NULL AND m % 2 = 0 UNION ALL SELECT sec, k % 6, k % 16, NULL, k FROM o WHERE m % 11 = 0),
 g AS (SELECT ck, min(depth) OVER (PARTITION BY sec, rq ORDER BY ord RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS least_depth, min(CASE WHEN ck IS NULL THEN ord END) OVER (PARTITION BY sec, rq) AS first_at, max(CASE WHEN ck IS NULL THEN ord END) OVER (PARTITION BY sec, rq) AS last_at FROM r),
 s AS (SELECT o.*, row_number() OVER (PARTITION BY CASE WHEN k % 50 = 0 THEN 0 ELSE k END ORDER BY k) AS nth, coalesce(q < 4, false) AS h, k % 6 < 4 AS hc, q + 5 AS lv, q + 2 AS pc,
   CASE WHEN q IS NOT NULL THEN last_value(CASE WHEN m % 4 = 0 THEN k % 12 END IGNORE NULLS) OVER (PARTITION BY q ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) END AS before, max(CASE WHEN q IS NOT NULL AND m % 2 = 0 THEN k END) OVER (PARTITION BY q) AS last_of_quest, least_depth, first_at, last_at
   FROM o LEFT JOIN g ON ck = k),
 i AS (SELECT p_partkey AS k, p_size AS m FROM part), v AS (SELECT s_suppkey AS k, 0 AS m, s_suppkey = 0 OR s_suppkey % 50 > 0 AND EXISTS (SELECT 1 FROM orders WHERE o_orderkey = s_suppkey) AS lands FROM supplier)
 {_counted("s", _STEPS, "'[S' || sec || '] ' || CASE m % 7 WHEN 0 THEN 'Take a bucket' WHEN 1 THEN 'See {{x' ELSE 'Talk to ' || k END")}
 UNION ALL {_counted("i", _INSTRUCTIONS, "'o' || m || '@' || k")}
 UNION ALL SELECT 'migration leads nowhere', count(*), count(*) FILTER (NOT lands), coalesce((SELECT string_agg(l, ', ' ORDER BY l) FROM (SELECT 'x' || k || ' -> i' || k AS l FROM v WHERE NOT lands ORDER BY l LIMIT 5)), '') FROM v"""


@registered(_SQL)
def guide_audit(spark, sf_dir):
    """All forty-five checks of a guide, each with how much it looked at, what is wrong and the first of that (V5)."""
    steps = _made(read(spark, sf_dir, "orders").select(c("o_orderkey").alias("k"), c("o_custkey").alias("m")), _STEP)
    instructions = _made(read(spark, sf_dir, "part").select(c("p_partkey").alias("k"), c("p_size").alias("m")), _INSTRUCTION)
    nation = read(spark, sf_dir, "nation").select(c("n_nationkey").cast("int").alias("k"))
    helpers = nation.where("k < 4").select(F.concat(F.lit("q"), "k").alias("quest"), (c("k") + 5).alias("last_value"), (c("k") + 2).alias("panel_count"), F.array(F.lit(0), F.lit(1)).alias("panels"))
    moved = read(spark, sf_dir, "supplier").select(F.concat(F.lit("x"), "s_suppkey").alias("old_id"), F.concat(F.lit("i"), "s_suppkey").alias("new_id"))
    return audit.audit(steps, instructions, helpers, nation.select(F.concat(F.lit("1:"), "k").alias("task")), moved)


def _made(rows, fields):
    """rows with the fields of a list of SQL expressions, which commas outside brackets and quotes divide."""
    found, depth, quoted = [""], 0, False
    for ch in fields:
        quoted ^= ch == "'"
        depth += 0 if quoted else (ch == "(") - (ch == ")")
        if ch == "," and not quoted and not depth:
            found.append("")
        else:
            found[-1] += ch
    return rows.selectExpr(*found)
