"""State across runs: closure votes and the log of observed postings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmill.operators.dedup import keep_first


def closure(rows: DataFrame, votes: DataFrame, group: list[str], ident: str) -> DataFrame:
    """Adds ``verdict``: closed if a board that voted no longer lists the row's id, live if it does, unverified else.

    Votes hold one row for each live id of a board; a row without an id is unverified.
    """
    voters = votes.select(*group).distinct().withColumn("_voted", F.lit(True))
    listed = votes.select(*group, ident).distinct().withColumn("_listed", F.lit(True))
    has_id = F.col(ident).isNotNull() & (F.trim(F.col(ident).cast("string")) != "")
    return (
        rows.join(voters, group, "left").join(listed, [*group, ident], "left")
        .withColumn("verdict", F.when(F.col("_voted").isNull() | ~has_id, "unverified").when(F.col("_listed").isNull(), "closed").otherwise("live"))
        .drop("_voted", "_listed")
    )


def latest_votes(votes: DataFrame, group: list[str], ordinal: str) -> DataFrame:
    """Votes of each board's last crawl."""
    last = votes.groupBy(*group).agg(F.max(ordinal).alias("_last"))
    return votes.join(last, group).filter(F.col(ordinal) == F.col("_last")).drop("_last")


def commit_seen(seen: DataFrame, current: DataFrame, fresh: DataFrame, as_of: str) -> tuple[DataFrame, DataFrame]:
    """Fold a run into the log: (log, events).

    seen: key, bucket, pair, rid, first, last, closed.  current: key, bucket, pair, rid (one row
    a key).  fresh: bucket.  An entry closes when its bucket was fetched anew and neither its key,
    its pair nor its id is live; an id that moved to another key keeps its first date and its old
    key goes; a key is new if neither it nor its id was known to be open.
    """
    now = F.lit(as_of)
    keys = current.select(F.col("key").alias("_ck"))
    ids = keep_first(current.filter("rid <> ''"), ["rid"], [F.col("key")]).select(F.col("rid").alias("_cr"))
    pairs = current.filter("pair <> ''").select(F.col("pair").alias("_cp")).distinct()
    buckets = fresh.select(F.col("bucket").alias("_fb")).distinct()
    flagged = (
        seen.join(keys.withColumn("_live_key", F.lit(True)), F.col("key") == F.col("_ck"), "left").drop("_ck")
        .join(ids.withColumn("_live_id", F.lit(True)), F.col("rid") == F.col("_cr"), "left").drop("_cr")
        .join(pairs.withColumn("_live_pair", F.lit(True)), F.col("pair") == F.col("_cp"), "left").drop("_cp")
        .join(buckets.withColumn("_fresh", F.lit(True)), F.col("bucket") == F.col("_fb"), "left").drop("_fb")
    )
    closes = F.col("_live_key").isNull() & F.col("_live_id").isNull() & F.col("_live_pair").isNull() & F.col("_fresh").isNotNull() & (F.col("closed") == "")
    old = flagged.withColumn("_closes", closes)
    open_ids = keep_first(seen.filter("rid <> '' and closed = ''"), ["rid"], [F.col("key")]).select(F.col("rid").alias("_sr"), F.col("first").alias("_by_id"))
    known = seen.select(F.col("key").alias("_sk"), F.col("first").alias("_by_key"))
    fresh_rows = (
        current.join(known, F.col("key") == F.col("_sk"), "left").join(open_ids, F.col("rid") == F.col("_sr"), "left")
        .withColumn("_new", F.col("_sk").isNull() & F.col("_sr").isNull())
    )
    live = fresh_rows.select("key", "bucket", "pair", "rid", F.coalesce("_by_key", "_by_id", now).alias("first"), now.alias("last"), F.lit("").alias("closed"))
    kept = old.filter("_live_key is null and _live_id is null").select(
        "key", "bucket", "pair", "rid", "first", "last", F.when(F.col("_closes"), now).otherwise(F.col("closed")).alias("closed")
    )
    events = old.filter("_closes").select("key", F.lit("closed").alias("event"), "first").unionByName(
        fresh_rows.filter("_new").select("key", F.lit("new").alias("event"), now.alias("first"))
    )
    return live.unionByName(kept), events


def expire(seen: DataFrame, cutoff: str) -> DataFrame:
    """Entries last seen at or after ``cutoff`` (ISO texts compare as dates)."""
    return seen.filter(F.col("last") >= cutoff)
