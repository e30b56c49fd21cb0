"""Where a row of an ordered list ends, by a coarse ruler first and a finer one where that says nothing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def coarse(rows: DataFrame, keys: list[str], order: list[str], placed: str, ends: Column, starts: Column, last_value: Column) -> DataFrame:
    """Adds `boundary` (the next placed value that is neither null nor zero) and `completes`.

    An unplaced last row that ends its list is placed at last_value; the last
    row completes unless it only starts.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    after = w.rowsBetween(1, Window.unboundedFollowing)
    rows = rows.withColumn("__final", F.lead(F.lit(1)).over(w).isNull())
    rows = rows.withColumn("__placed", F.coalesce(F.col(placed), F.when(F.col("__final") & ends, last_value)))
    done = rows.withColumn("boundary", F.first(F.nullif(F.col("__placed"), F.lit(0)), ignorenulls=True).over(after))
    return done.withColumn("completes", F.col("__final") & ~(starts & ~ends)).drop("__final", "__placed")


def finer(rows: DataFrame, keys: list[str], order: list[str], placed: str, ends: Column, count: Column, reachable: Column, out: str = "fine_boundary") -> DataFrame:
    """The finer ruler's hand-over where the coarse boundary is missing or not
    past the one before; forward only, and only to a position that is reachable."""
    w = Window.partitionBy(*keys).orderBy(*order)
    rows = rows.withColumn("__ends", ends)
    opened = F.coalesce(F.last("boundary", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    following = F.first(F.nullif(F.col(placed), F.lit(0)), ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing))
    hand_over = F.coalesce(following, F.when(F.lead("__ends").over(w), count - 1))
    marked = rows.withColumn("__open", opened).withColumn("__hand", hand_over).withColumn("__more", F.lead(F.lit(1)).over(w).isNotNull())
    blunt = F.col("boundary").isNull() | (F.col("boundary") <= F.col("__open"))
    fits = (F.col("__hand") > F.coalesce(F.col(placed), F.lit(0))) & F.array_contains(reachable, F.col("__hand"))
    use = blunt & fits & F.col("__more") & ~F.col("__ends") & ~F.col("completes") & (count > 1)
    return marked.withColumn(out, F.when(use, F.col("__hand"))).drop("__ends", "__open", "__hand", "__more")
