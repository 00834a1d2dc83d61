"""Precedence unions of snapshots and the scope of a feed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedmill.functions import dates as D
from feedmill.functions import geo as G
from feedmill.functions import text as T
from feedmill.functions import url as U
from feedmill.operators.dedup import keep_first

#: Classes of sources, strongest first, and how long each stays servable in hours (fixed values).
PRECEDENCE = ("direct_ats", "priority_ats", "jobhive", "markdown", "aggregators", "specialty")
TTL_HOURS = {"priority_ats": 24, "direct_ats": 48, "jobhive": 24, "markdown": 48, "aggregators": 72, "specialty": 168}


def class_rank(c: Column) -> Column:
    """Place of a class in the precedence; an unknown class ranks as the last."""
    out = F.lit(len(PRECEDENCE) - 1)
    for rank, name in enumerate(PRECEDENCE):
        out = F.when(c == name, rank).otherwise(out)
    return out


def source_class(source: Column, classes: dict[str, str], default: str = "specialty") -> Column:
    out = F.lit(default)
    for name, value in classes.items():
        out = F.when(F.lower(F.trim(T.text(source))) == name, value).otherwise(out)
    return out


def precedence_union(frames: list[DataFrame], key: str, order: list[Column]) -> DataFrame:
    """Union of frames of any columns; per key the first row in ``order`` stays."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return keep_first(out, [key], order)


def live_first_union(cached: DataFrame, live: DataFrame, key: str, ordinal: str) -> DataFrame:
    """Cached and live rows by class; inside a class live rows first, their sources in falling order, cached ones in rising."""
    rows = cached.withColumn("_live", F.lit(0)).unionByName(live.withColumn("_live", F.lit(1)), allowMissingColumns=True)
    source = T.text(F.col("source"))
    order = [class_rank(F.col("class")), F.desc("_live"), F.when(F.col("_live") == 1, source).desc_nulls_last(), source.asc(), F.col(ordinal)]
    return keep_first(rows, [key], order).drop("_live")


def scoped(df: DataFrame, ordinal: str) -> DataFrame:
    """Rows with a place that is a country, American or remote; one row for each canonical link."""
    remote = F.lower(T.text(F.col("location"))).rlike(r"\bremote\b") | F.lower(T.text(F.col("is_remote"))).isin("true", "1")
    kept = df.filter((T.text(F.col("country_iso")) != "") | G.looks_american(F.col("location")) | remote)
    kept = kept.filter(T.text(F.col("location")) != "").withColumn("_url", U.canonical(F.col("link")))
    bare = kept.filter("_url = ''").withColumn("_first", F.lit(0))
    linked = keep_first(kept.filter("_url <> ''"), ["_url"], [F.col(ordinal)]).withColumn("_first", F.lit(1))
    return bare.unionByName(linked).withColumnRenamed("_first", "scope_rank").drop("_url")


def servable(status: Column, provenance: Column, rows: Column, age_hours: Column, ttl: Column) -> tuple[Column, Column]:
    """(fresh, servable) of a snapshot record: a rejected fetch serves its last rows while they are young."""
    young = age_hours.isNotNull() & (age_hours >= 0) & (age_hours <= ttl)
    ok = (provenance == "fetch") & young
    fresh = ok & status.isin("ok", "ok:recovered")
    return F.coalesce(fresh, F.lit(False)), F.coalesce(fresh | (ok & status.startswith("rejected:") & (rows > 0)), F.lit(False))


def gate(rows: Column, previous_rows: Column, rejections: Column, shrink: float = 0.3, most: int = 2) -> Column:
    """Decision on a fetched snapshot: empty is rejected, as is one far smaller, though not more than ``most`` times."""
    return (
        F.when(rows == 0, "rejected:empty")
        .when((previous_rows > 0) & (rejections < most) & (rows < previous_rows * shrink), "rejected:shrunken")
        .when(rejections > 0, "ok:recovered").otherwise("ok")
    )


def last_of(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """Last ``n`` rows of each key."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


#: Sources and their classes (fixed values).
CLASS_OF = {
    "heavy": "direct_ats", "ats_new": "direct_ats", "priority": "priority_ats", "jobhive": "jobhive", "light": "markdown", "breadth": "aggregators", "medium": "aggregators",
    "rss": "specialty", "ecr": "specialty",
}


def sidecars(df: DataFrame, now: Column, classes: dict[str, str] = CLASS_OF, ttl_hours: dict[str, int] = TTL_HOURS) -> DataFrame:
    """(file_source, source, status, provenance, rows, fetched_at) -> with what follows from them.

    The file's name is the identity: a record that names another source is not trusted.  A
    record of before provenance was kept counts as a fetch if its status says so.  Class and
    time to live are policy, whatever an old record says.
    """
    named = F.coalesce(F.nullif("source", F.lit("")), F.col("file_source"))
    kind = F.create_map(*[F.lit(x) for pair in classes.items() for x in pair])[F.col("file_source")]
    ttl = F.create_map(*[F.lit(x) for c, h in ttl_hours.items() for x in (c, float(h))])
    legacy = F.col("provenance").isNull() & F.coalesce(F.col("status").isin("ok", "ok:recovered"), F.lit(False))
    rows = df.withColumns({
        "known": kind.isNotNull(), "class": F.coalesce(kind, F.lit("specialty")), "source_match": named == F.col("file_source"), "provenance_legacy": legacy,
        "provenance": F.when(legacy, "fetch").otherwise(F.col("provenance")), "age_hours": D.hours_old(F.col("fetched_at").cast("timestamp"), now), "seeded": F.coalesce(F.col("status") == "seeded", F.lit(False)),
    }).withColumn("ttl_hours", ttl[F.col("class")])
    rows = rows.withColumn("provenance_ok", F.coalesce(F.col("source_match") & F.col("known") & (F.col("provenance") == "fetch"), F.lit(False)))
    fresh, able = servable(F.col("status"), F.col("provenance"), F.col("rows"), F.col("age_hours"), F.col("ttl_hours"))
    return rows.withColumns({"fresh": F.col("provenance_ok") & fresh, "servable": F.col("provenance_ok") & able})


def sidecar_report(judged: DataFrame, expected: tuple[str, ...], optional: tuple[str, ...] = ()) -> DataFrame:
    """One row of name lists: missing, unexpected, fresh, expired, empty, rejected, invalid, seeded, legacy, serving_previous, and the rows behind them."""
    status = T.text(F.col("status"))
    names = lambda cond: F.array_sort(F.collect_set(F.when(cond, F.col("file_source"))))
    one = judged.agg(
        F.array_sort(F.collect_set("file_source")).alias("have"), names(F.col("fresh")).alias("fresh"), names(~F.col("fresh") & (status != "empty") & ~status.startswith("rejected:")).alias("expired"),
        names(status == "empty").alias("empty"), names(status.startswith("rejected")).alias("rejected"), names(~F.col("provenance_ok")).alias("invalid"), names(F.col("seeded")).alias("seeded"),
        names(F.col("provenance_legacy")).alias("legacy_provenance"), names(F.col("servable") & ~F.col("fresh")).alias("serving_previous"),
        F.sum(F.when(F.col("fresh"), F.col("rows")).otherwise(0)).cast("long").alias("rows_fresh"), F.sum(F.when(F.col("servable"), F.col("rows")).otherwise(0)).cast("long").alias("rows_eligible"),
    )
    listed = lambda names_: F.array(*[F.lit(n) for n in names_]) if names_ else F.array().cast("array<string>")
    return one.withColumns({
        "missing": F.array_sort(F.array_except(listed(expected), "have")), "unexpected": F.array_sort(F.array_except("have", listed((*expected, *optional)))),
    }).drop("have")
