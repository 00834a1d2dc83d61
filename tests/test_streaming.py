"""Streams give what the batch gives."""

import json
import time

from pyspark.sql import functions as F

from feedmill.sources.readers import PagedJsonSource, manifest_paths, scan_manifest
from feedmill.streaming import seen_stream as S


def test_observed_keys_match_batch(spark, tmp_path):
    rows = [(f"k{i % 7}", f"2024-01-{1 + i // 7:02d} 00:00:00") for i in range(60)]
    df = spark.createDataFrame(rows, "key string, at string").withColumn("at", F.col("at").cast("timestamp"))
    for part in range(3):  # files in the order of time: what is late beyond the watermark would not count
        df.filter(F.floor((F.dayofmonth("at") - 1) / 3) == part).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        time.sleep(1.1)
    stream = S.files(spark, str(tmp_path / "in"), df.schema, 1)
    got = S.run_to_memory(S.observed(stream, "key", "at"), "observed_keys")
    last = {r.key: (r["first"], r["last"], r.n) for r in got.orderBy("n").collect() if r.event != "expired"}
    want = {r.key: (r["first"], r["last"], r.n) for r in df.groupBy("key").agg(F.min("at").alias("first"), F.max("at").alias("last"), F.count("*").alias("n")).collect()}
    assert last == want


def test_windowed_counts(spark, tmp_path):
    df = spark.createDataFrame([("a", "2024-01-01 00:10:00"), ("a", "2024-01-01 00:50:00"), ("b", "2024-01-01 01:10:00")], "k string, at string").withColumn("at", F.col("at").cast("timestamp"))
    df.write.parquet(str(tmp_path / "in"))
    got = S.run_to_memory(S.windowed_counts(S.files(spark, str(tmp_path / "in"), df.schema), "at", "k"), "windowed", "complete")
    assert sorted((r.k, r.n) for r in got.collect()) == [("a", 2), ("b", 1)]


def test_paged_source(spark, tmp_path):
    for offset in (0, 2, 4):
        (tmp_path / f"p{offset}.json").write_text(json.dumps([{"i": i} for i in range(offset, min(offset + 2, 5))]))
    spark.dataSource.register(PagedJsonSource)
    got = spark.read.format("paged_json").option("path", str(tmp_path / "p{offset}.json")).option("total", 5).option("page", 2).load()
    assert sorted(json.loads(r.body)["i"] for r in got.collect()) == [0, 1, 2, 3, 4]


def test_manifest_scan(spark, tmp_path):
    spark.range(2).withColumn("a", F.lit(1)).write.parquet(str(tmp_path / "x"))
    spark.range(3).withColumn("b", F.lit("q")).write.parquet(str(tmp_path / "y"))
    manifest = {"by_ats": {"x": {"parquet": str(tmp_path / "x")}, "y": {"parquet": str(tmp_path / "y")}, "z": {}}}
    assert manifest_paths(manifest, ["z", "y"]) == [str(tmp_path / "y")]
    got = scan_manifest(spark, manifest, ["x", "y"])
    assert got.count() == 5 and set(got.columns) == {"id", "a", "b"}
