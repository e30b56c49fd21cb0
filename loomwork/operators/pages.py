"""Names to pages: the first spelling with a usable page, or the reason why there is none."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import pages as P
from ..functions.text import title_variants


def resolve_names(names: DataFrame, pages: DataFrame, name: str = "name", title: str = "title", text: str = "markup") -> DataFrame:
    """name, variant, kind, box, ids, points, refusal, choices: one row per distinct name.

    pages has one row a title; a null text is a page known to be missing.
    """
    tried = names.select(F.col(name).alias("name")).where("name is not null").distinct().select("name", F.posexplode(title_variants(F.col("name"))).alias("pos", "variant"))
    known = pages.select(F.col(title).alias("variant"), P.page(F.col(text)).alias("page"), P.refusal(F.col(text)).alias("why"), P.choices(F.col(text)).alias("choices"))
    met = tried.join(known, "variant", "left").withColumn("why", F.when(F.col("page").isNull(), F.coalesce("why", F.lit("no page"))))
    rank = F.when(F.col("why").isNull(), 0).when(F.col("why") != "no page", 1).otherwise(2)
    best = met.groupBy("name").agg(F.min_by(F.struct("variant", "page", "why", "choices"), F.struct(rank, F.col("pos"))).alias("b"))
    return best.select("name", "b.variant", "b.page.kind", "b.page.box", "b.page.ids", "b.page.points", F.col("b.why").alias("refusal"), "b.choices")
