"""A whole page with every trap of the format."""

import pytest
from pyspark.sql import functions as F

from loomwork.operators import parser, structure

PAGE = """Intro line
* stray before any section
{{Youtube|v0}}
== [[Guide|Episode 1]]: start ==

{{Youtube|v1}}
{{Var|bankNumber|4}}
{{Extimage|https://i.host.example/AbC/pic.png}}
<!-- Bank 5A -->
{{Checklist|title=Bank {{#expr:{{#var:bankNumber}}+1}}A|* first, inline
* second step
** nested  [[Rope|rope]]
* second step
IF 85 Crafting
* glued}}
}}
* note behind
{{Youtube|v2}}
{{Var|bankNumber|{{#expr:{{#var:bankNumber}}+2}}}}{{Var|other|9}}
<!-- Bank 9 -->
{{Checklist|title=
* open end
=== Episode 2 ===
{{Checklist|title=Bank {{#expr:{{#var:bankNumber}}-1}}
}}
{{Checklist|title=Odd {{#expr:{{#var:nothing}}+3}}|not a step
*
}}
End of Episode 2
}}"""


@pytest.fixture(scope="module")
def page(spark):
    docs = spark.createDataFrame([(1, PAGE.replace("\n", "\r\n")), (2, "* only prose"), (3, None)], "doc_id long, text string")
    return parser.Page(structure.lines(docs).withColumn("line_no", F.col("line_no").cast("int")))


def test_sections(page):
    got = [(r.ordinal, r.slug, r.title, r.bank_number, r.bank_suffix, r.note, list(r.images), r.episode, r.terminated, r.continuation_of is not None) for r in page.sections.orderBy("doc_id", "ordinal").collect()]
    assert got == [
        (0, "bank-5a", "Bank 5A", 5, "A", "Bank 5A", ["https://i.host.example/AbC/pic.png"], 1, True, False),
        (1, "bank-5a-2", "Bank 5A", 5, "A", "Bank 9", [], 1, False, True),
        (2, "bank-5", "Bank 5", 5, None, None, [], 2, True, False),
        (3, "odd-3", "Odd 3", None, None, None, [], 2, True, False),
    ]


def test_steps(page):
    rows = page.steps.orderBy("block", "ordinal").collect()
    assert [(r.block, r.ordinal, r.kind, r.depth, r.raw) for r in rows] == [
        (1, 0, "step", 1, "first, inline"), (1, 1, "step", 1, "second step"), (1, 2, "step", 2, "nested  [[Rope|rope]]"), (1, 3, "step", 1, "second step"), (1, 4, "note", 1, "IF 85 Crafting"),
        (1, 5, "step", 1, "glued"), (1, 6, "trailing-note", 1, "note behind"), (2, 0, "step", 1, "open end"),
    ]
    assert len({r.step_id for r in rows}) == len(rows)


def test_videos_episodes_warnings(page):
    assert [(r.video, r.anchor, r.at) for r in page.videos.orderBy("line_no").collect()] == [("v0", "none", None), ("v1", "episode", 1), ("v2", "step", 16)]
    assert [(r.ordinal, r.title, r.n_sections, r.end_line) for r in page.episodes.orderBy("episode_no").collect()] == [(1, "[[Guide|Episode 1]]: start", 2, None), (2, "Episode 2", 2, 29)]
    assert [(r.doc_id, r.line) for r in page.preamble.orderBy("doc_id", "line_no").collect()] == [(1, "Intro line"), (1, "* stray before any section"), (1, "}}"), (2, "* only prose")]
    assert {(r.code, r.n) for r in page.warning_counts.collect()} == {
        ("unterminated_checklist", 1), ("continuation_section", 1), ("bank_number_mismatch", 1), ("bare_line_in_block", 1), ("trailing_note", 1), ("orphan_video", 1),
    }


def test_mirror(spark):
    links = {"https://i.host.example/AbC/pic.png": "https://m.example/AbC.png", " http://else.example/x ": "http://else.example/x"}
    df = spark.createDataFrame([(k,) for k in links], "u string")
    got = df.select("u", parser.mirrored(F.col("u"), r"^https://i\.host\.example/([A-Za-z0-9]+)/[^/]+$", "https://m.example/").alias("m"))
    assert {r.u: r.m for r in got.collect()} == links
