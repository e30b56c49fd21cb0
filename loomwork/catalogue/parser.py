"""Registered queries of the page parser.

Every user's events are written out as a marked-up page, one line an event;
the SQL works on the events themselves and knows nothing of the markup.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import parser
from .registry import read, registered, step_events

# What the k-th kind of event writes; N stands for its number.
LINES = [
    "{{Checklist|title=Bank {{#expr:{{#var:b}}+1}}|* inline N", "{{Checklist|title=", "}}", "== [[x|Episode N]] ==", "{{Extimage|https://host.example/N/a.png}}", "{{Youtube|vN}}", "<!-- Bank N -->",
    "{{Var|b|N}}", "** step [[thing|N]]", "prose N}}", "* stray N", "End of Episode 1", "{{Var|b|{{#expr:{{#var:b}}+2}}}}", "",
]


def pages(spark: SparkSession, sf_dir: str) -> parser.Page:
    number = (F.col("event_id") % 5).cast("string")
    line = F.coalesce(*[F.when(F.col("event_id") % 29 % len(LINES) == k, F.replace(F.lit(t), F.lit("N"), number)) for k, t in enumerate(LINES)])
    return parser.Page(step_events(spark, sf_dir).select("user_id", (F.col("pos") - 1).cast("int").alias("line_no"), line.alias("line")), "user_id")


_BASE = f"""e AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS line_no, event_id % 29 % {len(LINES)} AS k, event_id % 5 AS n FROM events),
  a AS (SELECT *, k IN (0, 1) AS opens, sum(CASE WHEN k IN (0, 1) THEN 1 ELSE 0 END) OVER w AS block, last_value(CASE WHEN k <= 7 OR k = 12 THEN k END IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before,
    first_value(CASE WHEN k <= 7 OR k = 12 THEN k END IGNORE NULLS) OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS after, sum(CASE WHEN k = 7 THEN 1 ELSE 0 END) OVER (w ROWS UNBOUNDED PRECEDING) AS seg,
    last_value(CASE WHEN k = 3 THEN n END IGNORE NULLS) OVER (w ROWS UNBOUNDED PRECEDING) AS episode, sum(CASE WHEN k = 3 THEN 1 ELSE 0 END) OVER (w ROWS UNBOUNDED PRECEDING) AS episode_no,
    last_value(CASE WHEN k <> 13 THEN k END IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous FROM e WINDOW w AS (PARTITION BY user_id ORDER BY line_no)),
  l AS (SELECT *, coalesce(first_value(CASE WHEN k = 7 THEN n END) OVER s, 0) + coalesce(sum(CASE WHEN k = 12 THEN 2 ELSE 0 END) OVER s, 0) AS b, coalesce(before IN (0, 1), false) AND k IN (8, 9, 10, 11) AS inside
    FROM a WINDOW s AS (PARTITION BY user_id, seg ORDER BY line_no ROWS UNBOUNDED PRECEDING)),
  pend AS (SELECT user_id, block + 1 AS block, string_agg(CASE WHEN k = 4 THEN 'https://host.example/' || n || '/a.png' END, ' ' ORDER BY line_no) AS images, arg_max(n, line_no) FILTER (WHERE k = 6) AS note FROM l WHERE k IN (4, 6) GROUP BY 1, 2),
  t AS (SELECT *, coalesce(last_value(CASE WHEN k = 0 THEN 'Bank ' || (b + 1) END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY line_no ROWS UNBOUNDED PRECEDING), 'Untitled') AS title FROM l WHERE opens),
  u AS (SELECT *, replace(lower(title), ' ', '-') AS base FROM t),
  v AS (SELECT *, base || CASE WHEN r > 1 THEN '-' || r ELSE '' END AS slug FROM (SELECT *, row_number() OVER (PARTITION BY user_id, base ORDER BY line_no) AS r FROM u)),
  sec AS (SELECT v.*, left(sha1(slug), 10) AS section_id, images, note FROM v LEFT JOIN pend p ON v.user_id = p.user_id AND v.block = p.block),
  x AS (SELECT user_id, block, line_no, CASE WHEN inside AND k = 9 OR inside AND k = 11 THEN 'note' WHEN inside OR k = 0 THEN 'step' ELSE 'trailing-note' END AS kind, CASE WHEN inside AND k = 8 THEN 2 ELSE 1 END AS depth,
    CASE k WHEN 0 THEN 'inline ' || n WHEN 8 THEN 'step [[thing|' || n || ']]' WHEN 9 THEN 'prose ' || n WHEN 11 THEN 'End of Episode 1' ELSE 'stray ' || n END AS raw,
    CASE k WHEN 0 THEN 'inline ' || n WHEN 8 THEN 'step ' || n WHEN 9 THEN 'prose ' || n WHEN 11 THEN 'end of episode 1' ELSE 'stray ' || n END AS norm FROM l WHERE inside OR k = 0 OR block > 0 AND NOT inside AND k IN (8, 10)),
  y AS (SELECT x.*, section_id, slug, row_number() OVER (PARTITION BY x.user_id, x.block ORDER BY x.line_no) - 1 AS ordinal,
    CASE WHEN kind = 'trailing-note' THEN 0 ELSE row_number() OVER (PARTITION BY x.user_id, x.block, norm, kind = 'trailing-note' ORDER BY x.line_no) - 1 END AS dup FROM x JOIN sec ON x.user_id = sec.user_id AND x.block = sec.block),
  vid AS (SELECT l.user_id, l.line_no, n, CASE WHEN previous = 3 THEN 'episode' WHEN last_step IS NOT NULL THEN 'step' WHEN episode_no > 0 THEN 'episode' ELSE 'none' END AS anchor, last_step, episode_no
    FROM (SELECT l.*, (SELECT max(x.line_no) FROM x WHERE x.user_id = l.user_id AND x.block = l.block AND x.line_no < l.line_no) AS last_step FROM l WHERE k = 5) l)"""


@registered(f"""WITH {_BASE} SELECT user_id, block - 1 AS ordinal, section_id, slug, title, CASE WHEN title <> 'Untitled' THEN CAST(replace(title, 'Bank ', '') AS INTEGER) END AS bank_number, CAST(note AS INTEGER) AS note_number, coalesce(images, '') AS images,
  CAST(episode AS INTEGER) AS episode, CASE WHEN k = 1 THEN lag(section_id) OVER (PARTITION BY user_id ORDER BY line_no) END AS continuation_of, coalesce(after = 2, false) AS terminated, line_no + 1 AS source_line FROM sec""")
def parsed_sections(spark, sf_dir):
    """Blocks with titles read from a counter, what stands before them, their parents and their ends."""
    s = pages(spark, sf_dir).sections
    return s.select("user_id", F.col("ordinal").cast("long").alias("ordinal"), "section_id", "slug", "title", "bank_number", "note_number", F.array_join("images", " ").alias("images"), "episode", "continuation_of", "terminated", F.col("source_line").cast("long").alias("source_line"))


@registered(f"WITH {_BASE} SELECT user_id, section_id, ordinal, left(sha1(slug || '|' || norm || CASE WHEN dup > 0 THEN '#' || dup ELSE '' END), 10) AS step_id, kind, CAST(depth AS INTEGER) AS depth, raw FROM y")
def parsed_steps(spark, sf_dir):
    """Steps of blocks, first steps on the opening line, notes, bullets behind a block."""
    return pages(spark, sf_dir).steps.select("user_id", "section_id", F.col("ordinal").cast("long").alias("ordinal"), "step_id", "kind", "depth", "raw")


@registered(f"WITH {_BASE} SELECT user_id, line_no, 'v' || n AS video, anchor, CAST(CASE anchor WHEN 'episode' THEN episode_no WHEN 'step' THEN last_step END AS BIGINT) AS at FROM vid")
def parsed_videos(spark, sf_dir):
    """Videos anchored backwards: to a heading right above, the latest step, the episode, or nothing (P10)."""
    return pages(spark, sf_dir).videos.withColumn("line_no", F.col("line_no").cast("long"))


@registered(f"""WITH {_BASE}, w AS (SELECT 'unterminated_checklist' AS code FROM sec WHERE coalesce(after, -1) <> 2 UNION ALL SELECT CASE WHEN block > 1 THEN 'continuation_section' ELSE 'orphan_continuation' END FROM sec WHERE k = 1
  UNION ALL SELECT 'bank_number_mismatch' FROM sec WHERE note IS NOT NULL AND title NOT IN ('Untitled', 'Bank ' || note) UNION ALL SELECT CASE kind WHEN 'note' THEN 'bare_line_in_block' ELSE 'trailing_note' END FROM x WHERE kind <> 'step'
  UNION ALL SELECT 'orphan_video' FROM vid WHERE anchor = 'none') SELECT code, count(*) AS n FROM w GROUP BY code""")
def parse_warnings(spark, sf_dir):
    """What a page does that it should not, counted by code."""
    return pages(spark, sf_dir).warning_counts


@registered(f"""WITH {_BASE}, p AS (SELECT e.user_id, (SELECT count(*) FROM l WHERE l.user_id = e.user_id AND k = 3) AS n_episodes, (SELECT count(*) FROM sec WHERE sec.user_id = e.user_id) AS n_sections, (SELECT count(*) FROM y WHERE y.user_id = e.user_id) AS n_steps,
  (SELECT count(*) FROM l WHERE l.user_id = e.user_id AND k = 4 AND EXISTS (SELECT 1 FROM sec WHERE sec.user_id = l.user_id AND sec.block = l.block + 1)) AS n_images, (SELECT count(*) FROM vid WHERE vid.user_id = e.user_id AND anchor <> 'none') AS n_videos FROM (SELECT DISTINCT user_id FROM e) e) SELECT * FROM p""")
def parsed_totals(spark, sf_dir):
    """Sizes of every parsed page."""
    return pages(spark, sf_dir).totals


@registered(f"""WITH {_BASE} SELECT l.user_id, l.episode_no, CAST(n AS INTEGER) AS ordinal, '[[x|Episode ' || n || ']]' AS title, (SELECT count(*) FROM sec WHERE sec.user_id = l.user_id AND sec.episode_no = l.episode_no) AS n_sections,
  (SELECT max(z.line_no) + 1 FROM l z WHERE z.user_id = l.user_id AND z.episode_no = l.episode_no AND z.k = 11 AND NOT z.inside) AS end_line FROM l WHERE k = 3""")
def parsed_episodes(spark, sf_dir):
    """Episode headings at any level, their sections and end markers."""
    return pages(spark, sf_dir).episodes.withColumn("end_line", F.col("end_line").cast("long"))


@registered(f"WITH {_BASE} SELECT user_id, line_no, CASE k WHEN 2 THEN '}}}}' WHEN 8 THEN '** step [[thing|' || n || ']]' WHEN 9 THEN 'prose ' || n || '}}}}' ELSE '* stray ' || n END AS line FROM l WHERE NOT inside AND (k = 2 AND NOT coalesce(before IN (0, 1), false) OR k = 9 OR block = 0 AND k IN (8, 10))")
def parsed_preamble(spark, sf_dir):
    """Prose that belongs to no block."""
    return pages(spark, sf_dir).preamble.withColumn("line_no", F.col("line_no").cast("long"))


@registered("""SELECT page_id, CASE WHEN regexp_matches(url, '^https?://[^/]+/[^/]+') THEN 'https://mirror.example/' || regexp_extract(url, '^https?://[^/]+/([^/?]+)', 1) || '.png' ELSE trim(url) END AS url FROM pages""")
def mirrored_links(spark, sf_dir):
    """Links of a known host to its mirror, others as they are."""
    return read(spark, sf_dir, "pages").select("page_id", parser.mirrored(F.col("url"), "^https?://[^/]+/([^/?]+)", "https://mirror.example/").alias("url"))
