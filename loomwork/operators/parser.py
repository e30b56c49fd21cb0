"""A marked-up page into episodes, sections, steps and warnings.

Lines are given as rows (document, line number, trimmed text).  What a line is
depends on its text; whether it stands in a block depends on the latest
structural line before it, so both are columns and every pass is a window over
one document's lines.  The marked lines are written once, as all results read
them.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import display_text, id_text, short_hash, slug
from ..plans.tables import settled
from .structure import classify

def _begins(template: str) -> str:
    return rf"(?i)^\{{\{{\s*{template}\s*\|"


# The markup of the page format, in the order in which a line is asked.
KINDS = [
    (_begins("Checklist") + r"\s*title\s*=", "open"),
    ("^=.+=$", "heading"),
    (_begins("Extimage") + "[^|}]", "image"),
    (_begins("Youtube") + "[^|}]", "video"),
    ("^<!--.*-->$", "comment"),
    (r"\{\{Var", "var"),
    (r"^\}\}$", "close"),
    ("^$", "blank"),
    (r"^\{\{", "template"),
]
STRUCTURAL = ["open", "heading", "image", "video", "comment", "var", "close"]
ASSIGNS, READS = r"(?i)\{\{\s*Var\s*\|", r"(?i)\{\{\s*#expr\s*:"
BANK_TITLE, BANK_NOTE = r"(?i)^Bank\s*([0-9]+)\s*([A-Z]?)\s*$", r"(?i)^\s*Bank\s*([0-9]+)([A-Z]?)\s*$"
EPISODE, EPISODE_END = r"(?i)^Episode\s+([0-9]+)\b", r"(?i)^End of (Episode\s*[0-9]+|Series)\b"
UNTITLED = "Untitled"
STATE = "map<string,int>"


def mirrored(url: Column, host: str, base: str) -> Column:
    """base + the link's id + .png where the link is of the known host (a pattern with one group); else the link."""
    u = F.trim(url)
    return F.when(u.rlike(host), F.concat(F.lit(base), F.regexp_extract(u, host, 1), F.lit(".png"))).otherwise(u)


def _sum(c: Column) -> Column:
    """src, by of "variable plus or minus number" that opens the text behind a sign of a sum; by is null for anything else."""
    src = F.regexp_extract(c, r"(?i)^\s*(?:\{\{\s*#expr\s*:\s*)?\{\{\s*#var\s*:\s*(\w+)", 1)
    number = F.regexp_extract(c, r"^[^}]*\}\}\s*([+-])\s*([0-9]+)\s*\}\}", 2)
    sign = F.regexp_extract(c, r"^[^}]*\}\}\s*([+-])\s*([0-9]+)\s*\}\}", 1)
    by = F.when((src != "") & (number != ""), F.when(sign == "-", -number.try_cast("int")).otherwise(number.try_cast("int")))
    return F.struct(src.alias("src"), by.alias("by"))


def _behind(c: Column, sign: str) -> Column:
    """The text behind every sign."""
    parts = F.split(c, sign)
    return F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))


def _argument() -> Column:
    """The first argument of the template on a line."""
    return F.regexp_extract("line", r"^[^|]*\|([^|}]+)", 1)


def _put(state: Column, name: Column, value: Column) -> Column:
    return F.map_concat(F.map_filter(state, lambda k, _: k != name), F.create_map(name, value))


def _held(state: Column, name: Column) -> Column:
    return F.coalesce(F.try_element_at(state, name), F.lit(0))


def assigned(state: Column, line: Column) -> Column:
    """The variables behind a line: its changes first, then its plain values."""
    parts = F.transform(_behind(line, ASSIGNS), lambda p: F.struct(F.trim(F.substring_index(p, "|", 1)).alias("name"), F.regexp_replace(p, r"^[^|]*\|", "").alias("rest")))
    sums = F.filter(F.transform(parts, lambda p: F.struct(p["name"].alias("name"), _sum(p["rest"]).alias("s"))), lambda p: p["s"]["by"].isNotNull())
    plain = F.filter(F.transform(parts, lambda p: F.struct(p["name"].alias("name"), F.regexp_extract(p["rest"], r"^\s*([0-9]+)\s*\}\}", 1).alias("n"))), lambda p: p["n"] != "")
    after = F.aggregate(sums, state, lambda st, p: _put(st, p["name"], _held(st, p["s"]["src"]) + p["s"]["by"]))
    return F.aggregate(plain, after, lambda st, p: _put(st, p["name"], p["n"].cast("int")))


def resolved_title(title: Column, state: Column) -> Column:
    """Every reading of a variable replaced by its value."""
    parts = F.transform(_behind(title, READS), lambda p: F.struct(p.alias("text"), _sum(p).alias("s"), F.regexp_replace(p, r"^[^}]*\}\}[^}]*\}\}", "").alias("rest")))
    value = lambda p: F.when(p["s"]["by"].isNull(), F.concat(F.lit("{{#expr:"), p["text"])).otherwise(F.concat((_held(state, p["s"]["src"]) + p["s"]["by"]).cast("string"), p["rest"]))
    return F.trim(F.concat(F.split(title, READS)[0], F.array_join(F.transform(parts, value), "")))


@dataclass
class Page:
    """lines: `doc`, line_no, line.  Every result is a DataFrame keyed by `doc`."""

    lines: DataFrame
    doc: str = "doc_id"

    def _window(self, *more: str) -> Window:
        return Window.partitionBy(self.doc, *more).orderBy("line_no")

    @cached_property
    def states(self) -> DataFrame:
        """doc, line_no, state: the variables behind every line that assigns some; a fold over those lines alone."""
        zero = F.expr(f"struct(cast(map() as {STATE}) as state, cast(array() as array<struct<line_no:int,state:{STATE}>>) as seen)")
        rows = F.sort_array(F.collect_list(F.struct(F.col("line_no").cast("int").alias("line_no"), "line")))

        def step(acc: Column, x: Column) -> Column:
            s = assigned(acc["state"], x["line"])
            return F.struct(s.alias("state"), F.concat(acc["seen"], F.array(F.struct(x["line_no"].alias("line_no"), s.alias("state")))).alias("seen"))

        var = self.lines.where(classify(F.col("line"), KINDS, "text") == "var")
        folded = var.groupBy(self.doc).agg(F.aggregate(rows, zero, step, lambda a: a["seen"]).alias("seen"))
        return folded.select(self.doc, F.inline("seen"))

    @cached_property
    def rows(self) -> DataFrame:
        """Every line with its kind, block (opens so far), whether it stands in the block, and what surrounds it."""
        w, start = self._window(), Window.unboundedPreceding
        rows = self.lines.join(self.states, [self.doc, "line_no"], "left").withColumn("kind", classify(F.col("line"), KINDS, "text"))
        mark = F.when(F.col("kind").isin(STRUCTURAL), F.struct("kind", "line_no"))
        title = F.regexp_replace("line", KINDS[0][0], "")
        heading = F.trim(F.regexp_replace("line", "^=+|=+$", ""))
        episode = F.when(F.col("kind") == "heading", F.nullif(F.regexp_extract(display_text(heading), EPISODE, 1), F.lit("")).cast("int"))
        rows = rows.withColumns({
            "block": F.sum((F.col("kind") == "open").cast("int")).over(w.rowsBetween(start, 0)),
            "before": F.last(mark, ignorenulls=True).over(w.rowsBetween(start, -1)),
            "after": F.first(mark, ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing)),
            "state": F.last("state", ignorenulls=True).over(w.rowsBetween(start, 0)),
            "previous": F.last(F.when(F.col("kind") != "blank", F.col("kind")), ignorenulls=True).over(w.rowsBetween(start, -1)),
            "parts": F.when(F.col("kind") == "open", F.split(title, r"\|", 2)),
            "heading": F.when(episode.isNotNull(), heading),
            "episode": episode,
        })
        inside = F.coalesce(F.col("before.kind") == "open", F.lit(False)) & ~F.col("kind").isin(STRUCTURAL)
        done = rows.withColumns({
            "inside": inside,
            "closes": (F.col("kind") == "close") & F.coalesce(F.col("before.kind") == "open", F.lit(False)),
            "episode_no": F.sum(F.col("episode").isNotNull().cast("int")).over(w.rowsBetween(start, 0)),
            "current_episode": F.last("episode", ignorenulls=True).over(w.rowsBetween(start, 0)),
        })
        return settled(done, "lines")  # sections, steps, anchors and warnings all read it

    @cached_property
    def pending(self) -> DataFrame:
        """doc, block, images, note: what stands before a section and belongs to it."""
        image = F.when(F.col("kind") == "image", F.struct("line_no", _argument().alias("url")))
        body = F.trim(F.regexp_extract("line", r"^<!--(.*?)-->$", 1))
        note = F.when((F.col("kind") == "comment") & body.rlike(BANK_NOTE), F.struct("line_no", body.alias("body")))
        some = self.rows.where(F.col("kind").isin("image", "comment"))
        by = some.groupBy(self.doc, (F.col("block") + 1).alias("block")).agg(F.sort_array(F.collect_list(image)).alias("images"), F.max(note).alias("note"))
        return by.select(self.doc, "block", F.transform("images", lambda x: x["url"]).alias("images"), F.col("note.body").alias("note"))

    @cached_property
    def sections(self) -> DataFrame:
        """One row a block: ordinal, id, slug, title, bank number and suffix, note, images, episode, parent, terminated, line."""
        w = self._window()
        opens = self.rows.where("kind = 'open'").join(self.pending, [self.doc, "block"], "left")
        own = F.nullif(resolved_title(F.col("parts")[0], F.coalesce("state", F.expr(f"cast(map() as {STATE})"))), F.lit(""))
        titled = opens.withColumn("own", own).withColumn("title", F.coalesce(F.last("own", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)), F.lit(UNTITLED)))
        n = F.row_number().over(self._window("base"))
        slugged = titled.withColumn("base", slug(F.col("title"))).withColumn("slug", F.concat("base", F.when(n > 1, F.concat(F.lit("-"), n.cast("string"))).otherwise("")))
        bank = lambda pattern, c, k: F.nullif(F.upper(F.regexp_extract(c, pattern, k)), F.lit(""))
        done = slugged.withColumn("section_id", short_hash(F.col("slug")))
        return done.select(
            self.doc, "block", (F.col("block") - 1).cast("int").alias("ordinal"), "section_id", "slug", "title",
            bank(BANK_TITLE, F.col("title"), 1).cast("int").alias("bank_number"), bank(BANK_TITLE, F.col("title"), 2).alias("bank_suffix"),
            "note", bank(BANK_NOTE, F.col("note"), 1).cast("int").alias("note_number"), bank(BANK_NOTE, F.col("note"), 2).alias("note_suffix"),
            F.coalesce("images", F.expr("cast(array() as array<string>)")).alias("images"), F.col("current_episode").alias("episode"), "episode_no",
            F.when(F.col("own").isNull(), F.lag("section_id").over(w)).alias("continuation_of"), F.col("own").isNull().alias("untitled"),
            F.coalesce(F.col("after.kind") == "close", F.lit(False)).alias("terminated"), F.col("after.line_no").alias("until"), (F.col("line_no") + 1).alias("source_line"),
        )

    @cached_property
    def texts(self) -> DataFrame:
        """doc, block, line_no, kind (step, note, trailing-note), depth, raw: what becomes a step."""
        bullet = r"^(\*+)\s?(.*)$"
        inside = F.when(F.col("line").endswith("}}"), F.rtrim(F.regexp_replace("line", r"\}\}$", ""))).otherwise(F.col("line"))
        first = F.trim(F.get(F.col("parts"), F.lit(1)))
        end = F.col("line").rlike(EPISODE_END)
        trailing = ~F.col("inside") & (F.col("kind") == "text") & F.col("line").startswith("*") & ~end & (F.col("block") > 0)
        text = F.when(F.col("inside") & (F.col("kind") != "blank"), inside).when((F.col("kind") == "open") & first.startswith("*"), first).when(trailing, F.col("line"))
        rows = self.rows.withColumn("trailing", trailing).withColumn("text", text).where("text is not null")
        is_bullet = F.col("text").rlike(bullet)
        raw = F.when(is_bullet, F.trim(F.regexp_extract("text", bullet, 2))).otherwise(F.col("text"))
        kind = F.when(F.col("trailing"), "trailing-note").when(is_bullet, "step").otherwise("note")
        depth = F.when((kind == "step"), F.length(F.regexp_extract("text", bullet, 1))).otherwise(1)
        return rows.select(self.doc, "block", "line_no", kind.alias("kind"), depth.cast("int").alias("depth"), raw.alias("raw"))

    @cached_property
    def steps(self) -> DataFrame:
        """Sections' steps, numbered densely; a repeated text in a block adds its ordinal to the id, a trailing note never."""
        w = self._window("block")
        some = self.texts.where("raw <> ''").join(self.sections.select(self.doc, "block", "section_id", "slug"), [self.doc, "block"])
        again = F.when(F.col("kind") == "trailing-note", 0).otherwise(F.row_number().over(self._window("block", "norm", F.col("kind") == "trailing-note")) - 1)
        numbered = some.withColumn("norm", id_text(F.col("raw"))).withColumn("dup", again)
        key = F.concat_ws("|", "slug", F.concat("norm", F.when(F.col("dup") > 0, F.concat(F.lit("#"), F.col("dup").cast("string"))).otherwise("")))
        return numbered.select(self.doc, "block", "section_id", (F.row_number().over(w) - 1).alias("ordinal"), short_hash(key).alias("step_id"), "kind", "depth", "raw", "line_no")

    @cached_property
    def videos(self) -> DataFrame:
        """doc, line_no, video, anchor (episode, step or none), at: an episode's number or the step's line."""
        w = self._window().rowsBetween(Window.unboundedPreceding, 0)
        step = self.texts.where("raw <> ''").select(self.doc, F.col("line_no"), F.lit(1).alias("is_step"))
        rows = self.rows.join(step, [self.doc, "line_no"], "left").withColumn("latest", F.last(F.when(F.col("is_step") == 1, F.struct("block", "line_no")), ignorenulls=True).over(w))
        on_heading = (F.col("previous") == "heading") & (F.col("episode_no") > 0)
        in_section = (F.col("block") > 0) & (F.col("latest.block") == F.col("block"))
        anchor = F.when(on_heading, "episode").when(in_section, "step").when(F.col("episode_no") > 0, "episode").otherwise("none")
        video = F.trim(_argument())
        at = F.when(anchor == "episode", F.col("episode_no")).when(anchor == "step", F.col("latest.line_no"))
        return rows.where("kind = 'video'").select(self.doc, "line_no", video.alias("video"), anchor.alias("anchor"), at.cast("long").alias("at"))

    @cached_property
    def episodes(self) -> DataFrame:
        """doc, episode_no (from 1), ordinal, title, n_sections, end_line: its end marker, if any."""
        heads = self.rows.where("heading is not null").select(self.doc, "episode_no", F.col("episode").alias("ordinal"), F.col("heading").alias("title"))
        counts = self.sections.groupBy(self.doc, "episode_no").agg(F.count(F.lit(1)).alias("n_sections"))
        outside = self.rows.where(~F.col("inside") & (F.col("kind") == "text") & F.col("line").rlike(EPISODE_END))
        ends = outside.groupBy(self.doc, "episode_no").agg((F.max("line_no") + 1).alias("end_line"))
        met = heads.join(counts, [self.doc, "episode_no"], "left").join(ends, [self.doc, "episode_no"], "left")
        return met.withColumn("n_sections", F.coalesce("n_sections", F.lit(0)))

    @cached_property
    def preamble(self) -> DataFrame:
        """doc, line_no, line: prose outside of blocks that belongs to nothing."""
        loose = ~F.col("inside") & ((F.col("kind") == "text") | ((F.col("kind") == "close") & ~F.col("closes")))
        note = F.col("line").startswith("*") & (F.col("block") > 0)
        return self.rows.where(loose & ~note & ~F.col("line").rlike(EPISODE_END)).select(self.doc, "line_no", "line")

    @cached_property
    def warnings(self) -> DataFrame:
        """doc, code, source_line."""
        s = self.sections
        differs = ~(F.col("bank_number").eqNullSafe(F.col("note_number")) & F.col("bank_suffix").eqNullSafe(F.col("note_suffix")))
        at = lambda rows, code: rows.select(self.doc, F.lit(code).alias("code"), F.col("source_line").cast("long").alias("source_line"))
        line = lambda rows, code: at(rows.withColumn("source_line", F.col("line_no") + 1), code)
        return (
            at(s.where("not terminated"), "unterminated_checklist")
            .unionByName(at(s.where("untitled and continuation_of is not null"), "continuation_section"))
            .unionByName(at(s.where("untitled and continuation_of is null"), "orphan_continuation"))
            .unionByName(at(s.where(F.col("bank_number").isNotNull() & F.col("note").isNotNull() & differs), "bank_number_mismatch"))
            .unionByName(line(self.texts.where("kind = 'note'"), "bare_line_in_block"))
            .unionByName(line(self.texts.where("kind = 'trailing-note' and raw <> ''"), "trailing_note"))
            .unionByName(line(self.videos.where("anchor = 'none'"), "orphan_video"))
        )

    @cached_property
    def warning_counts(self) -> DataFrame:
        return self.warnings.groupBy("code").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "code")

    @cached_property
    def totals(self) -> DataFrame:
        """doc, n_episodes, n_sections, n_steps, n_images, n_videos."""
        count = lambda rows, name: rows.groupBy(self.doc).agg(F.count(F.lit(1)).alias(name))
        out = self.lines.select(self.doc).distinct()
        sized = self.sections.groupBy(self.doc).agg(F.count(F.lit(1)).alias("n_sections"), F.sum(F.size("images")).alias("n_images"))
        for side in (count(self.episodes, "n_episodes"), sized, count(self.steps, "n_steps"), count(self.videos.where("anchor <> 'none'"), "n_videos")):
            out = out.join(side, self.doc, "left")
        return out.na.fill(0)
