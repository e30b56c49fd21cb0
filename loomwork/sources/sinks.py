"""Documents, reports and curated tables out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def documents(rows: DataFrame) -> DataFrame:
    """One JSON text per row, nulls left out."""
    return rows.select(F.to_json(F.struct("*")).alias("value"))


def write_documents(rows: DataFrame, path: str) -> None:
    documents(rows).write.mode("overwrite").option("compression", "gzip").text(path)


def markdown(rows: DataFrame) -> DataFrame:
    """Table rows for a report; pipes are escaped and nulls are empty."""
    cells = [F.replace(F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit("|"), F.lit("\\|")) for c in rows.columns]
    return rows.select(F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |")).alias("value"))


def conflicts(new: DataFrame, held: DataFrame, key: str, value: str) -> DataFrame:
    """Keys that are to be added with another value than the one they have, or with two."""
    both = new.select(key, value).unionByName(held.select(key, value))
    clash = both.groupBy(key).agg(F.count_distinct(F.struct(F.col(value))).alias("n_values")).where("n_values > 1")
    return clash.join(new.select(key).distinct(), key, "left_semi").select(key)


def append_checked(new: DataFrame, held: DataFrame, key: str, value: str) -> DataFrame:
    """The rows to append: all that are not there yet, or an error and none at all."""
    clash = [r[0] for r in conflicts(new, held, key, value).limit(5).collect()]
    if clash:
        raise ValueError(f"conflicting values for {key}: {clash}")
    return new.dropDuplicates([key]).join(held.select(key), key, "left_anti")


def write_all(tables: dict[str, DataFrame], path: str) -> None:
    """Every named table as JSON lines below the path: what a stage gives besides its result (K2)."""
    for name, rows in tables.items():
        documents(rows).write.mode("overwrite").text(f"{path}/{name}")


def yaml_text(rows: DataFrame, doubt: DataFrame, key: str, value: str, header: str) -> DataFrame:
    """value: the lines of a curated file: a header, the entries in order, and the keys in doubt with their names (K3).

    One row, made where the table is: a curated file is small enough to be read by a person.
    """
    entry = F.concat(F.lit("  - "), F.to_json(F.struct(F.col(key), F.col(value))))
    block = lambda df, title, line: df.select(line.alias("l")).agg(F.concat_ws("\n", F.lit(title), F.array_join(F.sort_array(F.collect_list("l")), "\n")).alias("t"))
    one = block(rows, "entries:", entry)
    two = block(doubt, "ambiguous:", F.concat(F.lit("  - "), F.to_json(F.struct("key", "names"))))
    met = one.withColumn("__one", F.lit(1)).join(two.select(F.col("t").alias("u"), F.lit(1).alias("__one")), "__one")  # one row each
    return met.select(F.concat_ws("\n", F.lit(f"# {header}"), "t", "u").alias("value"))


def packed(spark: SparkSession, paths: list[str]) -> DataFrame:
    """path, content: the listed files, packed with gzip; any that is missing stops the run (K5)."""
    import gzip

    files = spark.read.format("binaryFile").load(paths).select("path", "content")
    found = files.count()
    if found < len(set(paths)):
        raise FileNotFoundError(f"{len(set(paths)) - found} of {len(set(paths))} listed files are missing")
    pack = F.udf(lambda b: gzip.compress(bytes(b), 9, mtime=0), "binary")
    return files.select("path", pack("content").alias("content"))


def report(title: str, sections: dict[str, DataFrame]) -> DataFrame:
    """place, line: a page of a title and named tables of text rows (K4)."""
    rows = None
    for n, (name, table) in enumerate(sections.items()):
        head = table.sparkSession.createDataFrame([(n, 0, 0, f"## {name}")], "section int, part int, at long, line string")
        body = markdown(table).select(F.lit(n).alias("section"), F.lit(1).alias("part"), F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"))
        both = head.unionByName(body)
        rows = both if rows is None else rows.unionByName(both)
    top = next(iter(sections.values())).sparkSession.createDataFrame([(-1, 0, 0, f"# {title}")], "section int, part int, at long, line string")
    return top.unionByName(rows)
