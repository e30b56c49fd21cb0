"""Files as tables: source trees, whole texts, enum rows, curated tables, snapshots, checked binaries, paged interfaces."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

STRINGS, NUMBERS = r'"((?:\\.|[^"\\])*)"', r"\(\s*(-?[0-9]+)\s*,\s*(-?[0-9]+)\s*,\s*(-?[0-9]+)\s*\)"


def source_tree(spark: SparkSession, path: str, pattern: str = "*.java") -> DataFrame:
    """file, folder, source of all matching files below a path; unreadable ones are left out."""
    files = spark.read.option("ignoreCorruptFiles", "true").option("ignoreMissingFiles", "true").text(path, wholetext=True, pathGlobFilter=pattern, recursiveFileLookup=True)
    name = F.input_file_name()
    return files.select(name.alias("file"), F.regexp_replace(name, "/[^/]*$", "").alias("folder"), F.col("value").alias("source"))


def whole_text(spark: SparkSession, path: str) -> DataFrame:
    """file, source: one row a file, line ends as they are."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.col("value").alias("source"))


def joined_folders(files: DataFrame, imports: DataFrame | None = None) -> DataFrame:
    """folder, source: all files of a folder in the order of their names, those that it imports from elsewhere behind them.

    imports: folder, file.
    """
    own = files.select("folder", F.struct(F.lit(0).alias("rank"), "file", "source").alias("f"))
    if imports is not None:
        more = imports.join(files.select(F.col("file"), F.col("folder").alias("home"), "source"), "file").where("folder <> home")
        own = own.unionByName(more.select("folder", F.struct(F.lit(1).alias("rank"), "file", "source").alias("f")))
    return own.groupBy("folder").agg(F.array_join(F.transform(F.sort_array(F.collect_set("f")), lambda f: f["source"]), "\n").alias("source"))


def enum_rows(files: DataFrame, key: str, text: str) -> DataFrame:
    """key, nth, constant, strings, point of every NAME(...) row; the last string before the point is the name."""
    row = r"(?s)\b([A-Z][A-Z0-9_]*)\s*\(((?:[^()\"]|\"(?:\\.|[^\"\\])*\"|\([^()]*\))*)\)\s*[,;]"
    each = files.select(key, F.posexplode(F.arrays_zip(F.regexp_extract_all(text, F.lit(row), F.lit(1)).alias("constant"), F.regexp_extract_all(text, F.lit(row), F.lit(2)).alias("body"))).alias("nth", "r"))
    body = F.col("r.body")
    point = F.when(body.rlike(NUMBERS), F.array(*[F.regexp_extract(body, NUMBERS, k).cast("int") for k in (1, 2, 3)]))
    before = F.split(body, r"(?i)new\s+WorldPoint", 2)[0]
    strings = F.regexp_extract_all(before, F.lit(STRINGS), F.lit(1))
    return each.select(key, "nth", F.col("r.constant").alias("constant"), strings.alias("strings"), F.try_element_at(strings, F.lit(-1)).alias("name"), point.alias("point"))


def constants_of_classes(dump: DataFrame, key: str, text: str) -> DataFrame:
    """key, constant, value: the whole-number constants that a class listing shows."""
    line = r"(?m)^\s*public static final int (\w+) = (-?[0-9]+);"
    names, values = (F.regexp_extract_all(text, F.lit(line), F.lit(k)) for k in (1, 2))
    each = dump.select(key, F.explode(F.arrays_zip(names.alias("constant"), values.alias("value"))).alias("c"))
    return each.select(key, "c.constant", F.col("c.value").cast("long").alias("value"))


def newest(paths: list[str]) -> str | None:
    """The last of the paths by their text, as versions are compared there."""
    return max(paths, default=None)


def optional_json(spark: SparkSession, path: str, schema: str, **options: object) -> DataFrame:
    """JSON rows of a schema, packed or not; none where the file is missing."""
    try:
        return spark.read.schema(schema).json(path, **options)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def snapshot(spark: SparkSession, path: str, release: str | int, schema: str) -> DataFrame:
    """The rows of one release, as they were then; releases are folders release=N."""
    return optional_json(spark, f"{path}/release={release}", schema)


def yaml_rows(spark: SparkSession, path: str, section: str | None = None) -> DataFrame:
    """key, value (JSON): a curated mapping, small by nature; keys become texts, a missing file is empty."""
    import json

    import yaml

    file = Path(path)
    doc = yaml.safe_load(file.read_text(encoding="utf-8")) if file.exists() else {}
    held = (doc or {}).get(section, {}) if section else doc or {}
    rows = [(str(k), json.dumps(v, sort_keys=True, ensure_ascii=False)) for k, v in held.items()]
    return spark.createDataFrame(rows, "key string, value string")


def fixed_lines(lines: DataFrame, keys: list[str], order: str, line: str) -> DataFrame:
    """keys, order, name, kind of a two-level list of fixed shape: a name on a line of its own, its kind below it.

    A name without a kind has none; it never takes that of the row before.
    """
    name = F.nullif(F.regexp_extract(line, r"^  (\S.*):\s*$", 1), F.lit(""))
    kind = F.nullif(F.regexp_extract(line, r"^    kind:\s*(\S+)", 1), F.lit(""))
    w = Window.partitionBy(*keys).orderBy(order)
    marked = lines.withColumn("name", name).withColumn("kind", kind).withColumn("__entry", F.sum(F.col("name").isNotNull().cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    own = marked.where("__entry > 0").groupBy(*keys, "__entry").agg(F.min(order).alias(order), F.first("name", ignorenulls=True).alias("name"), F.first("kind", ignorenulls=True).alias("kind"))
    return own.drop("__entry")


def checked_files(files: DataFrame, url: str, content: str, hosts: list[str], most_bytes: int, previous: DataFrame) -> DataFrame:
    """url, status, sha256: what a download gives; refused by host or size, else new, changed or same against the hashes before.

    previous: url, sha256.
    """
    host = F.regexp_extract(url, r"^https?://([^/:?#]+)", 1)
    sha = F.sha2(F.col(content).cast("binary"), 256)
    before = previous.select(F.col("url").alias(url), F.col("sha256").alias("__before"))
    met = files.join(before, url, "left")
    status = (
        F.when(~host.isin(*hosts), "unexpected host").when(F.length(content) > most_bytes, "too large").when(F.col("__before").isNull(), "new").when(F.col("__before") == sha, "same").otherwise("changed")
    )
    return met.select(F.col(url).alias("url"), status.alias("status"), F.when(status.isin("new", "same", "changed"), sha).alias("sha256"))


def distinct_in_order(rows: DataFrame, key: str, order: list[str], values: Column) -> DataFrame:
    """key, value, place: every value of a key once, where it is first seen."""
    each = rows.select(key, F.struct(*order).alias("o"), F.posexplode(values).alias("at", "value"))
    first = each.groupBy(key, "value").agg(F.min(F.struct("o", "at")).alias("f"))
    return first.select(key, "value", (F.row_number().over(Window.partitionBy(key).orderBy("f")) - 1).alias("place"))


def paged(seeds: DataFrame, key: str, fetch: Callable[[object, object], tuple[list[str], object]]) -> DataFrame:
    """key, page, value: all that an interface gives for every seed, one page after another until it names no next one.

    fetch(seed, cursor) gives values and the next cursor; an error stops the run.
    """

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for seed in frame[key]:
                cursor, page = None, 0
                while True:
                    values, cursor = fetch(seed, cursor)
                    yield pd.DataFrame({key: [seed] * len(values), "page": [page] * len(values), "value": values}).astype({"page": "int64"})
                    page += 1
                    if cursor is None:
                        break

    return seeds.select(key).mapInPandas(ask, f"{key} {dict(seeds.dtypes)[key]}, page long, value string")


def page_texts(titles: DataFrame, title: str, fetch: Callable[[list], dict[str, str | None]], batch: int = 50) -> DataFrame:
    """title, text: pages asked for in batches; one without a text is left out."""
    from .lookup import fetched

    return fetched(titles.select(title).distinct(), title, fetch, batch=batch).where("value is not null").withColumnRenamed("value", "text")


def one_page(spark: SparkSession, page: str, fetch: Callable[[str], dict]) -> DataFrame:
    """page, revision, text of a single page; an answer that carries an error, or no text, stops the run."""
    answer = fetch(page)
    if "error" in answer or not answer.get("text"):
        raise RuntimeError(f"no text for {page}: {answer.get('error', 'empty')}")
    return spark.createDataFrame([(page, int(answer["revision"]), answer["text"])], "page string, revision long, text string")


def host_of(url: str) -> str:
    return re.sub(r"^https?://([^/:?#]+).*$", r"\1", url)
