"""Connected components of an edge table by alternating large and small stars.

Edges stay in DataFrames; every round is two grouped minima and two equi-joins,
and ends in a written table.  Rounds grow with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmill.runtime import cut, discard


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang each node's neighbours onto its smallest one."""
    if large:
        sym = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        sym = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = sym.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    joined = sym.join(low, "u")
    if large:
        out = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low.select("u", F.col("m").alias("v"))
        )
    return out.filter("u <> v").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(u, v) long pairs -> (node, root): root is the smallest node reachable.

    Nodes without an edge are absent.  Nulls and self-loops are ignored; an empty
    edge table gives an empty result.
    """
    now = cut(edges.select("u", "v").filter("u <> v").distinct())
    mark = None
    while True:
        after = cut(_star(_star(now, True), False))
        discard(now)
        now = after
        seen = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if tuple(seen) == mark or not seen["n"]:
            break
        mark = tuple(seen)
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root"))
    ).distinct()


def keep_first(docs: DataFrame, roots: DataFrame) -> DataFrame:
    """Of each group of texts only the first document stays, by (doc_id, hash of the text), null ids last.

    ``roots`` is (node, root) over ``xxhash64(text)``; a text without a root is a group of its
    own.  Rows equal in doc_id and text are one document.
    """
    h = F.xxhash64(F.col("text").cast("string"))
    place = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "h")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), h.alias("h")).distinct().join(roots, F.col("h") == F.col("node"), "left")
    rows = cut(rows.select("doc_id", "h", F.coalesce("root", "h").alias("root")))
    firsts = rows.groupBy("root").agg(F.min(place).alias("c"), F.count("*").alias("m")).filter("m > 1").select("root", "c")
    same = F.col("doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col("h") == F.col("c.h"))
    gone = rows.join(firsts, "root").filter(~same).select(F.col("doc_id").alias("__d"), F.col("h").alias("__h"))
    return docs.join(gone, docs.doc_id.cast("long").eqNullSafe(F.col("__d")) & (F.xxhash64(docs.text.cast("string")) == F.col("__h")), "left_anti")
