"""Streams: file ingest, windowed counts with late data, and the log of observed keys as keyed state."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

LOG = "key string, first timestamp, last timestamp, n long, event string"
STATE = "first timestamp, last timestamp, n long"


def files(spark: SparkSession, path: str, schema, per_trigger: int = 16) -> DataFrame:
    """New files of a folder as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(path)


def windowed_counts(stream: DataFrame, at: str, key: str, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts of each key in windows; what comes later than ``late`` is dropped, as a stale snapshot is."""
    return stream.withWatermark(at, late).groupBy(F.window(at, width), key).agg(F.count("*").alias("n")).select(
        F.col("window.start").alias("start"), key, "n"
    )


def observed(stream: DataFrame, key: str, at: str, ttl: str = "120 days") -> DataFrame:
    """Log rows of each key: ``new`` at its first sight, ``seen`` after, ``expired`` when its time runs out.

    State is three values a key; the timeout is on event time, so the stream needs the watermark set here.
    """
    ttl_ms = int(pd.Timedelta(ttl).total_seconds() * 1000)

    def update(group: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            first, last, n = state.get
            state.remove()
            yield pd.DataFrame({"key": [group[0]], "first": [first], "last": [last], "n": [n], "event": ["expired"]})
            return
        known = state.exists
        first, last, n = state.get if known else (None, None, 0)
        for b in batches:
            lo, hi = b["at"].min(), b["at"].max()
            first, last, n = lo if first is None else min(first, lo), hi if last is None else max(last, hi), n + len(b)
        state.update((first, last, n))
        due = int(pd.Timestamp(last).timestamp() * 1000) + ttl_ms
        state.setTimeoutTimestamp(max(due, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame({"key": [group[0]], "first": [first], "last": [last], "n": [n], "event": ["seen" if known else "new"]})

    rows = stream.select(F.col(key).cast("string").alias("key"), F.col(at).cast("timestamp").alias("at")).withWatermark("at", "1 day")
    return rows.groupBy("key").applyInPandasWithState(update, LOG, STATE, "update", GroupStateTimeout.EventTimeTimeout)


def run_to_memory(stream: DataFrame, name: str, mode: str = "update") -> DataFrame:
    """Drain a stream into a table in memory, for tests and small looks."""
    query = stream.writeStream.outputMode(mode).format("memory").queryName(name).trigger(availableNow=True).start()
    query.awaitTermination()
    return stream.sparkSession.table(name)
