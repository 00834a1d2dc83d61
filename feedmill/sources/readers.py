"""Scans: manifest-driven tables, cached snapshots, paged documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def manifest_paths(manifest: dict, allowed: list[str]) -> list[str]:
    """Files of the allowed vendors, in the order of the list."""
    by_vendor = manifest.get("by_ats") or {}
    return [by_vendor[a]["parquet"] for a in allowed if (by_vendor.get(a) or {}).get("parquet")]


def scan_manifest(spark: SparkSession, manifest: dict, allowed: list[str]) -> DataFrame:
    """One relation over files whose columns may differ."""
    paths = manifest_paths(manifest, allowed)
    if not paths:
        raise ValueError("the manifest names no file of an allowed vendor")
    return spark.read.option("mergeSchema", "true").parquet(*paths)


def scan_tolerant(spark: SparkSession, schema: str, *paths: str) -> DataFrame:
    """Files that can't be read are left out; the schema says what is expected."""
    return spark.read.schema(schema).option("ignoreCorruptFiles", "true").option("ignoreMissingFiles", "true").parquet(*paths)


def scan_registry(spark: SparkSession, path: str, vendors: list[str]) -> DataFrame:
    """Verified boards of supported vendors out of a commented CSV."""
    rows = spark.read.csv(path, header=True, comment="#")
    return rows.filter((F.lower(F.trim("verified")) == "true") & F.lower("ats").isin(*vendors))


def scan_documents(spark: SparkSession, path: str) -> DataFrame:
    """(path, body) of whole text files."""
    return spark.read.option("wholetext", "true").text(path).select(F.input_file_name().alias("path"), F.col("value").alias("body"))


def recorded_pages(spark: SparkSession, path: str) -> DataFrame:
    """(vendor, board, page, body) of recorded answers below ``path``/vendor=/board=/page=, read by Spark from any file system."""
    rows = spark.read.option("wholetext", "true").option("basePath", path).text(path)
    return rows.select("vendor", F.col("board").cast("string").alias("board"), F.col("page").cast("int").alias("page"), F.regexp_replace("value", r"\n$", "").alias("body"))


def asked_pages(pages: DataFrame, size: Column, full: int, most: int) -> DataFrame:
    """The pages that a fetch would have asked for: up to the first that is not full, ``most`` at the most.

    ``size`` is the number of postings on a page.  A page after a short one is never asked for.
    """
    w = Window.partitionBy("vendor", "board").orderBy("page")
    short = F.max((F.col("_size") < full).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, -1))
    counted = pages.withColumn("_size", size).withColumns({"_done": F.coalesce(short, F.lit(0)), "_n": F.row_number().over(w)})
    return counted.filter((F.col("_done") == 0) & (F.col("_n") <= most)).drop("_size", "_done", "_n")


def chained_pages(pages: DataFrame, following: Column, most: int) -> DataFrame:
    """The pages that a chain reaches from page 0: each names the next in ``following``, null at the end."""
    links = pages.withColumn("_next", following.cast("int"))
    at = links.filter("page = 0")
    out = at
    for _ in range(most - 1):
        at = links.join(at.select("vendor", "board", F.col("_next").alias("page")).filter("page is not null"), ["vendor", "board", "page"])
        out = out.unionByName(at)
    return out.drop("_next").dropDuplicates(["vendor", "board", "page"])


def board_stats(rows: DataFrame, boards: DataFrame) -> DataFrame:
    """(vendor, board, rows, status) of boards asked for: ok, or empty where nothing came."""
    counts = rows.groupBy("vendor", "board").agg(F.count("*").alias("rows"))
    return boards.select("vendor", "board").distinct().join(counts, ["vendor", "board"], "left").select(
        "vendor", "board", F.coalesce("rows", F.lit(0)).alias("rows"), F.when(F.col("rows") > 0, "ok").otherwise("empty").alias("status")
    )
