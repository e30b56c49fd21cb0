"""Runs over a growing folder give what one run over all of it gives."""

import random

from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomwork.operators import conditions
from loomwork.streaming import kept

VERSIONS = T.StructType().add("page", "string").add("version", "integer").add("body", "string")
EVENTS = T.StructType().add("user", "integer").add("pos", "integer").add("kind", "string")


def stream(spark, folder, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 2).parquet(folder)


def test_latched_facts_last_from_run_to_run(spark, tmp_path):
    rng = random.Random(4)
    rows = [(u, p, rng.choice(["click", "view", "buy"] if u % 3 else ["click", "view"])) for p in range(60) for u in range(9)]
    want = {tuple(r) for r in conditions.latched(spark.createDataFrame(rows, EVENTS), ["user"], ["pos"], F.col("kind") == "buy").collect()}
    state = T.StructType().add("user", "integer").add("first", "integer")
    out = T.StructType([*EVENTS.fields, T.StructField("latched", T.BooleanType())])
    for n in range(3):
        part = [r for r in rows if r[1] // 20 == n]
        spark.createDataFrame(part, EVENTS).repartitionByRange(3, "pos").write.mode("append").parquet(f"{tmp_path}/in{n}")
    step = kept.latched(["user"], "pos", F.col("kind") == "buy")
    for n in range(3):  # each run sees one more folder's files
        kept.run(spark.readStream.schema(EVENTS).parquet(f"{tmp_path}/in{n}"), f"{tmp_path}/own{n}", state, step)
    apart = [kept.results(spark, f"{tmp_path}/own{n}", out).count() for n in range(3)]
    assert sum(apart) == len(rows)
    grown = f"{tmp_path}/grown"
    for n in range(3):
        spark.read.parquet(f"{tmp_path}/in{n}").coalesce(1).write.mode("append").parquet(grown)
        kept.run(stream(spark, grown, EVENTS), f"{tmp_path}/kept", state, step)
    assert {tuple(r) for r in kept.results(spark, f"{tmp_path}/kept", out).collect()} == want
    kept.run(stream(spark, grown, EVENTS), f"{tmp_path}/kept", state, step)  # nothing new
    assert kept.results(spark, f"{tmp_path}/kept", out).count() == len(rows)


def test_newest_versions(spark, tmp_path):
    grown, folder = f"{tmp_path}/grown", f"{tmp_path}/kept"
    batches = [[("a", 1, "x"), ("b", 5, "y"), ("a", 2, "z"), ("a", 2, "w")], [("a", 2, "late"), ("b", 4, "old"), ("c", 1, "new")], [("b", 9, "last")]]
    told = []
    for rows in batches:
        spark.createDataFrame(rows, VERSIONS).coalesce(1).write.mode("append").parquet(grown)
        kept.run(stream(spark, grown, VERSIONS), folder, VERSIONS, kept.newest(["page"], "version"))
        told.append({tuple(r) for r in kept.state(spark, folder, VERSIONS).collect()})
    assert told == [{("a", 2, "w"), ("b", 5, "y")}, {("a", 2, "w"), ("b", 5, "y"), ("c", 1, "new")}, {("a", 2, "w"), ("b", 9, "last"), ("c", 1, "new")}]
    assert {tuple(r) for r in kept.results(spark, folder, VERSIONS).collect()} == {("a", 2, "w"), ("b", 5, "y"), ("c", 1, "new"), ("b", 9, "last")}


def test_a_repeated_batch_reads_the_state_before_it(spark, tmp_path):
    step = kept.newest(["page"], "version")
    rows = spark.createDataFrame([("a", 1, "x")], VERSIONS)
    for number, version in ((0, 1), (1, 2), (1, 2)):
        after, _ = step(kept.state(spark, str(tmp_path), VERSIONS, number), rows.withColumn("version", F.lit(version)))
        after.write.mode("overwrite").parquet(f"{tmp_path}/state/b={number}")
    assert [tuple(r) for r in kept.state(spark, str(tmp_path), VERSIONS, 1).collect()] == [("a", 1, "x")]
    assert [tuple(r) for r in kept.state(spark, str(tmp_path), VERSIONS).collect()] == [("a", 2, "x")]
