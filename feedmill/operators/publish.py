"""Publication: reasons of refusal, gates, coverage, pages and shards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from feedmill.functions import dates as D
from feedmill.functions import text as T
from feedmill.functions import url as U
from feedmill.operators.dedup import either_key, filled_identity
from feedmill.operators.order import numbered
from feedmill.runtime import cut


def refusal(link: Column, company: Column, role: Column, posted: Column, as_of: Column, blocked: tuple[str, ...], max_days: int | None) -> Column:
    """First reason that refuses a row, null for none, of the display link, the clean company and the clean role.

    A date that can't be read never refuses.
    """
    out = (
        F.when(~link.startswith("https://"), "no_apply_link").when(company == "", "empty_company")
        .when(F.lower(company).isin(*blocked), "blocked_company")
        .when(~T.is_ascii(role) | ~T.is_ascii(company), "non_english")
    )
    return out if max_days is None else out.when(D.days_old(posted, as_of) > max_days, "inactive")


def publish(rows: DataFrame, as_of: Column, blocked: tuple[str, ...] = (), max_days: int | None = 60, ordinal: str = "ord") -> tuple[DataFrame, DataFrame]:
    """(published, reason counts): rows by ordered reasons, then first-fit on id or canonical link."""
    # cut: what follows reads the cleaned columns several times
    judged = cut(
        filled_identity(rows)
        .withColumns({"link": U.display(F.col("link")), "company": T.clean_company(F.col("company")), "role": T.clean_role(F.col("role"))})
        .withColumn("reason", refusal(F.col("link"), F.col("company"), F.col("role"), D.parse(F.col("date")), as_of, blocked, max_days))
    )
    passed = cut(judged.filter("reason is null").withColumns(
        {
            "_id": F.when((F.col("ats_type") != "") & (F.col("ats_id") != ""), F.lower(F.concat_ws("|", "ats_type", "ats_id"))).otherwise(""),
            "_url": U.canonical(F.col("link")),
        }
    ))
    kept = either_key(passed, "_id", "_url", ordinal)
    counts = judged.filter("reason is not null").groupBy("reason").agg(F.count("*").alias("n"))
    gone = passed.join(kept.select(F.col(ordinal).alias("_k")), F.col(ordinal) == F.col("_k"), "left_anti")
    counts = counts.unionByName(gone.groupBy(F.lit("duplicate").alias("reason")).agg(F.count("*").alias("n")))
    out = kept.withColumn(
        "id",
        F.when(F.col("_id") != "", F.lower(F.concat_ws(":", "ats_type", "ats_id")))
        .when(F.col("_url") != "", F.concat(F.lit("url:"), F.substring(F.sha1("_url"), 1, 16))).otherwise(""),
    )
    return out.drop("_id", "_url", "reason"), counts


def publication_gate(rows: int, previous: int, least: int = 1, floor: float = 0.6, from_rows: int = 500) -> str:
    """ok, or why a publication may not replace the one before."""
    if rows < least:
        return "too_few_rows"
    return "retention" if previous >= from_rows and rows < previous * floor else "ok"


def assess(snapshots: DataFrame, critical: tuple[str, ...]) -> DataFrame:
    """One row: status and blockers of critical sources, with the first reason that holds of each."""
    reason = (
        F.when(F.col("status").isNull(), "missing").when(F.col("provenance") != "fetch", "invalid_provenance")
        .when(F.col("status").startswith("rejected") | F.col("status").isin("empty", "failed"), F.col("status"))
        .when(~F.col("fresh"), "expired").when(F.col("rows") <= 0, "empty")
    )
    wanted = snapshots.sparkSession.createDataFrame([(c,) for c in critical], "source string")
    blocked = wanted.join(snapshots, "source", "left").withColumn("reason", reason).filter("reason is not null")
    blockers = blocked.agg(F.array_sort(F.collect_list(F.concat_ws(":", "source", "reason"))).alias("blockers"))
    thin = snapshots.agg(F.count_if(~F.col("fresh")).alias("thin"))
    return blockers.join(thin, F.lit(True)).select(
        F.when(F.size("blockers") > 0, "failed").when(F.col("thin") > 0, "degraded").otherwise("ok").alias("status"), "blockers"
    )


def coverage(df: DataFrame, dims: list[str]) -> DataFrame:
    """(dimension, value, total, share_pct) for each dimension in one pass of grouping sets."""
    sets = df.select(F.explode(F.array(*[F.struct(F.lit(d).alias("dimension"), F.coalesce(F.col(d).cast("string"), F.lit("unknown")).alias("value")) for d in dims])).alias("x"))
    counted = sets.groupBy("x.dimension", "x.value").agg(F.count("*").alias("total"))
    return counted.withColumn("share_pct", F.round(100.0 * F.col("total") / F.sum("total").over(Window.partitionBy("dimension")), 2))


def field_fill(df: DataFrame, fields: list[str]) -> DataFrame:
    """(field, filled, pct): placeholders and blanks are not filled."""
    one = df.agg(F.count("*").alias("_n"), *[F.count_if(T.filled(F.col(f))).alias(f) for f in fields])
    rows = one.select("_n", F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("filled")) for f in fields])).alias("x"))
    return rows.select("x.field", "x.filled", F.round(100.0 * F.col("x.filled") / F.greatest("_n", F.lit(1)), 2).alias("pct"))


def shard_number(df: DataFrame, order: list[Column], rows: int) -> DataFrame:
    """Adds ``shard``: blocks of ``rows`` rows in order, numbered from 0, without one global window."""
    return numbered(df, order, "_i").withColumn("shard", F.floor(F.col("_i") / rows)).drop("_i")


def pack_pages(df: DataFrame, group: str, order: list[str], size: str, budget: int) -> DataFrame:
    """Adds ``page``: rows in order fill a page until the next would pass ``budget``; counted for each group.

    Where a page ends depends on where it began, so a group is folded in order; only the
    order's columns and the size go to that fold, and the pages join the rows again.
    """
    light = df.select(group, *order, size)
    schema = StructType([*light.schema.fields, StructField("page", LongType())])

    def pack(part):
        part = part.sort_values(order, kind="stable")
        page, used, out = 0, 0, []
        for n in part[size]:
            if used and used + n > budget:
                page, used = page + 1, 0
            used += n
            out.append(page)
        return part.assign(page=out)

    packed = light.groupBy(group).applyInPandas(pack, schema).drop(size)
    names = [group, *order]
    on = [df[c].eqNullSafe(packed[c]) for c in names]
    return df.join(packed, on).select(*[df[c] for c in df.columns], packed["page"])


def coverage_with_families(df: DataFrame, primary: str, extras: str) -> DataFrame:
    """(family, total) of rows counted once in their primary family and once in each further one."""
    every = F.concat(F.array(F.coalesce(F.col(primary), F.lit("Other Professional"))), F.slice(F.coalesce(extras, F.array().cast("array<string>")), 2, 1 << 20))
    return df.select(F.explode(every).alias("family")).groupBy("family").agg(F.count("*").alias("total"))


def shard_fill(df: DataFrame, fields: list[str]) -> DataFrame:
    """(field, filled, pct) as shards count it: any text but white space, placeholders too; null and false are not filled."""
    given = lambda f: F.trim(T.text(F.col(f))) != ""
    one = df.agg(F.count("*").alias("_n"), *[F.count_if(given(f)).alias(f) for f in fields])
    rows = one.select("_n", F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("filled")) for f in fields])).alias("x"))
    return rows.select("x.field", "x.filled", F.round(100.0 * F.col("x.filled") / F.greatest("_n", F.lit(1)), 2).alias("pct"))
