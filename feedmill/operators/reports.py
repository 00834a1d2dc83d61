"""Health, scheduling, enrichment and comparison of feeds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedmill.functions import text as T

STARVED_HOURS, YIELD_ROWS, MOST_ROWS = 72.0, 50.0, 500
LANES = {"priority": 3.0, "standard": 1.0, "bulk": 0.2}


def board_score(wait_hours: Column, rows: Column, lane: Column) -> Column:
    """Rank of a board's next visit: waiting time by yield and lane; the starved first."""
    weight = F.lit(1.0)
    for name, w in LANES.items():
        weight = F.when(lane == name, w).otherwise(weight)
    wait = F.greatest(wait_hours, F.lit(0.0))
    return F.when(wait >= STARVED_HOURS, 1e9 + wait).otherwise(wait * (1 + F.least(rows, F.lit(MOST_ROWS)) / YIELD_ROWS) * weight)


def zero_streak(runs: DataFrame, keys: list[str], order: str, rows: str) -> DataFrame:
    """(keys, zero): how many of the latest runs in a row brought nothing."""
    w = Window.partitionBy(*keys).orderBy(F.desc(order))
    some = F.sum(F.when(F.col(rows) > 0, 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return runs.withColumn("_some", some).groupBy(*keys).agg(F.count_if(F.col("_some") == 0).alias("zero"))


def failing(runs: DataFrame, source: str, order: list[Column], ok: Column, n: int = 2) -> DataFrame:
    """Sources whose last ``n`` runs all failed."""
    last = runs.withColumn("_ok", ok).withColumn("_rn", F.row_number().over(Window.partitionBy(source).orderBy(*order))).filter(F.col("_rn") <= n)
    return last.groupBy(source).agg(F.count("*").alias("_n"), F.bool_or("_ok").alias("_any")).filter((F.col("_n") == n) & ~F.col("_any")).select(source)


def trailing(runs: DataFrame, source: str, at: str, as_of: Column, seconds: int, sums: list[str]) -> DataFrame:
    """Sums and runs of each source in the window up to ``as_of``."""
    near = F.unix_timestamp(as_of) - F.unix_timestamp(F.col(at)) <= seconds
    return runs.groupBy(source).agg(*[F.sum(F.when(near, F.col(c)).otherwise(0)).alias(c) for c in sums], F.count_if(near).alias("runs"))


def upper_median(values: Column) -> Column:
    """Middle of the positive values of an array, the upper of two; 0 without any."""
    kept = F.array_sort(F.filter(values, lambda v: v > 0))
    return F.when(F.size(kept) == 0, 0).otherwise(F.get(kept, F.floor(F.size(kept) / 2).cast("int")))


def nearest_rank(values: Column, q: float) -> Column:
    """Nearest-rank percentile of an array."""
    kept = F.array_sort(values)
    return F.get(kept, (F.greatest(F.ceil(F.size(kept) * q), F.lit(1)) - 1).cast("int"))


def shares(df: DataFrame, value: str, out: str) -> DataFrame:
    return df.withColumn(out, F.round(100.0 * F.col(value) / F.sum(value).over(Window.partitionBy(F.lit(1))), 2))


def select_sources(health: DataFrame, least_runs: int = 4) -> DataFrame:
    """Adds decision (poll, defer) and reason to source, value, runs, failing, quiet; the upper median of values makes a source valuable."""
    cut_at = health.agg(upper_median(F.collect_list("value")).alias("cut"))
    valuable = (F.col("cut") > 0) & (F.col("value") >= F.col("cut"))
    reason = (
        F.when(F.col("failing"), "failing").when((F.col("runs") >= least_runs) & (F.col("value") == 0), "empty").when(F.col("quiet") & ~valuable, "quiet")
    )
    return health.join(F.broadcast(cut_at), F.lit(True)).withColumn("reason", reason).select(
        "source", F.when(F.col("reason").isNull(), "poll").otherwise("defer").alias("decision"), "reason", (F.col("reason").isNull() & valuable).alias("expand")
    )


def lookup_flag(rows: DataFrame, reference: DataFrame, key: str, amount: str, out: str) -> DataFrame:
    """'true' where the key has a positive amount in the reference, else empty."""
    totals = reference.groupBy(key).agg(F.sum(amount).alias("_amount"))
    return rows.join(totals, key, "left").withColumn(out, F.when(F.col("_amount") > 0, "true").otherwise("")).drop("_amount")


def lookup_first(rows: DataFrame, reference: DataFrame, keys: list[str], value: str, ordinal: str, out: str) -> DataFrame:
    """The row's own value if filled, else the first filled one of its keys in the reference."""
    first = reference.filter(F.trim(T.text(F.col(value))) != "").groupBy(*keys).agg(F.min_by(value, ordinal).alias("_value"))
    return rows.join(first, keys, "left").withColumn(out, F.coalesce(F.when(F.trim(T.text(F.col(value))) != "", F.col(value)), F.col("_value"))).drop("_value")


def best_title(rows: DataFrame, titles: DataFrame, key: str) -> DataFrame:
    """Best reference title of each row inside its key: rows (row_id, key, role), titles (key, title, n, ord).

    A word of the role is shared if the title has it or one with the same first five letters;
    a title counts from a share of 0.6 with two shared words, or with equal words; best by
    (share, n), the first on ties.  Titles of a key are few (a top list); the join is on the key.
    """
    hit = lambda a, b: (a == b) | ((F.length(a) >= 5) & (F.length(b) >= 5) & (F.substring(a, 1, 5) == F.substring(b, 1, 5)))
    left = rows.withColumn("_r", T.role_tokens(F.col("role")))
    right = titles.withColumn("_t", T.role_tokens(F.col("title")))
    both = left.join(right, key).withColumn("_s", F.size(F.filter("_r", lambda a: F.exists("_t", lambda b: hit(a, b)))))
    both = both.withColumn("score", F.col("_s") / F.size("_r")).filter((F.size("_r") > 0) & (F.size("_t") > 0))
    same = F.array_sort("_r") == F.array_sort("_t")
    good = both.filter(((F.col("score") >= 0.6) & (F.col("_s") >= 2)) | same)
    first = F.row_number().over(Window.partitionBy("row_id").orderBy(F.desc("score"), F.desc("n"), "ord"))
    return good.withColumn("_rn", first).filter("_rn = 1").select("row_id", "title", "n", F.round("score", 4).alias("score"))


def feed_diff(old: DataFrame, new: DataFrame, key: str, group: str) -> DataFrame:
    """(group, added, removed, kept) of two feeds by key."""
    a = old.select(F.col(key).alias("_k"), F.col(group).alias("_ga")).withColumn("_a", F.lit(True))
    b = new.select(F.col(key).alias("_k"), F.col(group).alias("_gb")).withColumn("_b", F.lit(True))
    both = a.join(b, "_k", "full")
    return both.groupBy(F.coalesce("_gb", "_ga").alias(group)).agg(
        F.count_if(F.col("_a").isNull()).alias("added"), F.count_if(F.col("_b").isNull()).alias("removed"), F.count_if(F.col("_a") & F.col("_b")).alias("kept")
    )


def run_stats(runs: DataFrame, source: str, ordinal: str, sums: list[str], status: str, notes: str | None = None) -> DataFrame:
    """Sums of a run's parts; the status is the last that is not ok, notes are listed in order."""
    bad = F.col(status) != "ok"
    more = [] if notes is None else [F.transform(F.array_sort(F.collect_list(F.when(T.text(F.col(notes)) != "", F.struct(F.col(ordinal), F.col(notes))))), lambda x: x[notes]).alias(notes)]
    return runs.groupBy(source).agg(*[F.sum(c).alias(c) for c in sums], F.coalesce(F.max_by(F.when(bad, F.col(status)), F.when(bad, F.col(ordinal))), F.lit("ok")).alias(status), *more)


def ranked_percentiles(df: DataFrame, group: str, value: str, shares: dict[str, float]) -> DataFrame:
    """Exact nearest-rank percentiles of each group: values are counted first, so a window holds a group's different values."""
    counted = df.filter(F.col(value).isNotNull()).groupBy(group, value).agg(F.count("*").alias("_n"))
    w = Window.partitionBy(group)
    upto = counted.withColumns({"_upto": F.sum("_n").over(w.orderBy(value)), "_all": F.sum("_n").over(w)})
    at = lambda q: F.min(F.when(F.col("_upto") >= F.greatest(F.ceil(F.col("_all") * q), F.lit(1)), F.col(value)))
    return upto.groupBy(group).agg(*[at(q).alias(name) for name, q in shares.items()])


def source_yield(df: DataFrame, source: str, link: str) -> DataFrame:
    """(source, rows, distinct, sole): distinct links of each source, and those that no other source has."""
    linked = df.filter(T.text(F.col(link)) != "").select(source, link).distinct()
    owners = linked.groupBy(link).agg(F.count("*").alias("_owners"))
    found = linked.join(owners, link).groupBy(source).agg(F.count("*").alias("distinct"), F.count_if(F.col("_owners") == 1).alias("sole"))
    rows = df.groupBy(source).agg(F.count("*").alias("rows"))
    return rows.join(found, source, "left").select(source, "rows", F.coalesce("distinct", F.lit(0)).alias("distinct"), F.coalesce("sole", F.lit(0)).alias("sole"))


def health(stats: DataFrame) -> DataFrame:
    """(source, new, rows, status, failing, quiet_hours) -> share of what is new, alert kinds, and whether the run is healthy, a row a source."""
    total = F.greatest(F.sum("new").over(Window.partitionBy(F.lit(1))), F.lit(1))
    alerts = F.array_compact(F.array(F.when(F.col("failing"), "failing"), F.when(F.col("quiet_hours").isNotNull(), "quiet"), F.when(F.col("status") != "ok", "degraded")))
    any_failing = F.bool_or("failing").over(Window.partitionBy(F.lit(1)))
    return stats.select("source", "new", "rows", F.round(100.0 * F.col("new") / total, 2).alias("share_of_new_pct"), alerts.alias("alerts"), (~any_failing).alias("healthy"))


def known_by(rows: DataFrame, feed: DataFrame, link: str, key: str, ordinal: str) -> DataFrame:
    """Rows of a batch with how the feed knows them: duplicate inside the batch, link, key or new; the batch's first of a link or key counts."""
    from feedmill.operators.dedup import either_key

    first = either_key(rows, link, key, ordinal).select(F.col(ordinal).alias("_o")).withColumn("_first", F.lit(True))
    links = feed.select(F.col(link).alias("_l")).filter("_l <> ''").distinct().withColumn("_by_link", F.lit(True))
    keys = feed.select(F.col(key).alias("_k")).filter("_k <> ''").distinct().withColumn("_by_key", F.lit(True))
    joined = rows.join(first, F.col(ordinal) == F.col("_o"), "left").join(links, F.col(link) == F.col("_l"), "left").join(keys, F.col(key) == F.col("_k"), "left")
    matched = F.when(F.col("_first").isNull(), "duplicate").when(F.col("_by_link"), "link").when(F.col("_by_key"), "key").otherwise("new")
    return joined.withColumn("matched", matched).drop("_o", "_first", "_l", "_by_link", "_k", "_by_key")


def sponsor_totals(years: DataFrame) -> DataFrame:
    """(Employer, Initial Approval, Continuing Approval) texts of several years -> name, approvals by normalised employer; rows without a positive total don't count."""
    whole = lambda c: F.coalesce(F.nullif(F.trim(T.text(F.col(c))), F.lit("")), F.lit("0")).try_cast("int")
    total = F.coalesce(whole("Initial Approval") + whole("Continuing Approval"), F.lit(0))
    rows = years.select(T.sponsor_key(F.col("Employer")).alias("name"), total.alias("n")).filter("name <> '' and n > 0")
    return rows.groupBy("name").agg(F.sum("n").alias("approvals"))


def filings(pages: DataFrame, top: int = 20) -> DataFrame:
    """(key, html) of filings -> key, title, n, median_salary, place: the commonest titles with the whole median of their salaries.

    Rows are table rows of three cells and more; a median of two is cut to a whole number.
    """
    rows = pages.select("key", F.explode(F.regexp_extract_all(T.text(F.col("html")), F.lit(r"(?s)<tr[^>]*>(.*?)</tr>"), 1)).alias("r"))
    cells = F.transform(F.regexp_extract_all("r", F.lit(r"(?s)<td[^>]*>(.*?)</td>"), 1), lambda c: F.regexp_replace(F.regexp_replace(c, "<[^>]+>", ""), r"^\s+|\s+$", ""))
    rows = rows.withColumn("c", cells).filter(F.size("c") >= 3).withColumn("t", T.squeeze(F.get("c", F.lit(1)))).filter("t <> '' and lower(t) <> 'job title'")
    salary = F.nullif(F.regexp_replace(F.get("c", F.lit(2)), "[^0-9]", ""), F.lit("")).try_cast("long")
    titles = rows.select("key", F.upper("t").alias("title"), F.nullif(salary, F.lit(0)).alias("salary")).groupBy("key", "title").agg(F.count("*").alias("n"), F.floor(F.median("salary")).cast("long").alias("median_salary"))
    place = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("n"), "title"))
    return titles.withColumn("place", place.cast("long")).filter(F.col("place") <= top)
