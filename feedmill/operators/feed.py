"""The base query, the canonical schema, the chains that clean sources, and plans of what to do next."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedmill.functions import classify as C
from feedmill.functions import dates as D
from feedmill.functions import geo as G
from feedmill.functions import money as M
from feedmill.functions import text as T
from feedmill.functions import url as U
from feedmill.operators.dedup import keep_first
from feedmill.operators.reports import board_score

#: Columns of a posting in order; others follow in theirs (fixed values).
CANONICAL = (
    "company", "role", "location", "date", "link", "is_remote", "salary_min", "salary_max", "salary_currency", "country_iso", "description", "ats_type", "ats_id",
    "job_type", "source", "observed_at",
)
TEXT_COLUMNS = (
    "company", "role", "location", "link", "is_remote", "salary_currency", "country_iso", "description", "ats_type", "ats_id", "job_type", "source", "observed_at",
    "employment_type", "seniority",
)
#: Titles and employers that the base query leaves out (fixed values).
EXCLUDED_TITLES = ("%(m/w/d)%", "%(m/f/d)%", "%(w/m/d)%")
EXCLUDED_EMPLOYERS = ("focusgrouppanel", "familiehulp")
#: Types of postings that are worth a description (fixed values).
QUALIFYING = ("internship", "new_grad")


def base_query(jobs: DataFrame, intern: Column, grad: Column, days: int, as_of: Column, excluded: Column | None = None, extra: Column | None = None) -> DataFrame:
    """Matched postings of the last ``days`` days: the latest of each employer, title and place, labelled, newest first.

    jobs: url, title, company, location, posted_at and what else a posting has.  ``excluded``
    titles match but have no label; ``extra`` is one more condition.  Of postings with one date and
    address the first by the other columns, in their order, counts.
    """
    posted = F.col("posted_at").cast("timestamp")
    rows = jobs.filter(intern | grad).filter(posted >= F.date_trunc("day", as_of) - F.make_dt_interval(F.lit(days)))
    rows = rows.filter(F.col("url").isNotNull() & F.col("title").isNotNull() & F.col("company").isNotNull())
    for pattern in EXCLUDED_TITLES:
        rows = rows.filter(~F.col("title").ilike(pattern))
    if extra is not None:
        rows = rows.filter(extra)
    kept = [c for c in jobs.columns if c not in ("title", "posted_at", "url")]
    latest = keep_first(rows, ["company", "title", "location"], [posted.desc(), F.col("url").asc(), *[F.col(c).asc() for c in kept]]).filter(~F.lower("company").isin(*EXCLUDED_EMPLOYERS))
    able = (F.trim("url") != "") & F.col("location").isNotNull() & (F.lit(True) if excluded is None else ~excluded)
    label = F.when(intern & able, "internship").when(grad & able, "new_grad").otherwise("other")
    return latest.select(F.col("title").alias("role"), posted.alias("date"), F.col("url").alias("link"), label.alias("job_type"), *kept).orderBy(F.desc("date"), "link")


def outside_feed(country: Column) -> Column:
    """Is the country one that the broad feed leaves out; unknown ones are not."""
    return F.coalesce(country.isin(*G.EXCLUDED), F.lit(False))


def stamped(df: DataFrame, source: str, now: str) -> DataFrame:
    return df.withColumns({"source": F.lit(source), "observed_at": F.lit(now)})


def published_columns(df: DataFrame) -> DataFrame:
    """Without the columns that this engine made for itself."""
    return df.select(*[c for c in df.columns if not c.startswith("_")])


def canonical(df: DataFrame) -> DataFrame:
    """Postings in the canonical types and order: salaries as numbers, dates as text, false texts of missing values as null."""
    blank = lambda c: F.lower(c).isin("nan", "nat")
    made = df
    for c in ("salary_min", "salary_max"):
        made = made.withColumn(c, M.coerce(F.col(c).cast("string")) if c in df.columns else F.lit(None).cast("double"))
    for c in ("date", "posted_at"):
        if c in df.columns:
            t = F.trim(T.text(F.col(c)))
            made = made.withColumn(c, F.when(F.lower(t).isin(*T.PLACEHOLDERS), "").otherwise(t))
    for c in TEXT_COLUMNS:
        if c in df.columns:
            t = F.col(c).cast("string")
            made = made.withColumn(c, F.when(~blank(t), t))
    order = [c for c in CANONICAL if c in made.columns]
    return made.select(*order, *[c for c in made.columns if c not in CANONICAL])


def supplement(df: DataFrame, blocked: tuple[str, ...], dated: bool = True) -> DataFrame:
    """Rows of a supplementary source that may join a feed: named, ASCII, technical, not blocked, dated; place and country filled."""
    rows = df.withColumns({"company": T.clean_company(F.col("company")), "role": F.trim(T.text(F.col("role")))})
    ok = (F.col("company") != "") & (F.col("role") != "") & T.is_ascii(F.col("role")) & T.is_ascii(F.col("company")) & C.is_technical(F.col("role"))
    rows = rows.filter(ok & ~F.lower(F.trim("company")).isin(*blocked))
    country = T.text(F.col("country_iso"))
    rows = rows.withColumn("country_iso", F.when(country != "", country).otherwise(G.infer_country(F.col("location")))).withColumn("location", G.clean_location(F.col("location")))
    return rows.filter(F.trim(T.text(F.col("date"))) != "") if dated else rows


def table_refusal(link: Column, company: Column, role: Column, posted: Column, as_of: Column, blocked: tuple[str, ...], max_days: int = 60) -> Column:
    """Why a row has no place in the table pages, null for none: employers first, then links, unlike the feed's."""
    return (
        F.when(company == "", "no_company").when(link == "", "no_link").when(F.lower(F.trim(company)).isin(*blocked), "blocked")
        .when(~T.is_ascii(role) | ~T.is_ascii(company), "foreign").when(D.days_old(posted, as_of) > max_days, "inactive")
    )


def link_rejections(df: DataFrame) -> DataFrame:
    """One row: rows whose raw link is no http link, and rows whose http link has no shown form."""
    raw = F.trim(T.text(F.col("link"))).rlike("^https?://")
    shown = U.display(F.col("link")) != ""
    return df.agg(F.count_if(~raw).alias("no_http_link"), F.count_if(raw & ~shown).alias("unusable_http_link"), F.count_if(~shown).alias("linkless"))


def enrichment_plan(df: DataFrame, cap: int, ordinal: str, new: Column | None = None) -> DataFrame:
    """Rows worth a fetch of their description, newest first, at most ``cap``: linked, without one, of a type that qualifies or of none."""
    kind = F.lower(F.trim(T.text(F.col("job_type"))))
    ok = T.text(F.col("link")).rlike("^https?://") & (F.trim(T.text(F.col("description"))) == "") & ((kind == "") | kind.isin(*QUALIFYING))
    rows = df.filter(ok if new is None else ok & new)
    return rows.orderBy(T.text(F.col("date")).desc(), ordinal).limit(max(0, cap))


def oldest_first(boards: DataFrame, state: DataFrame, keys: list[str], at: str, ordinal: str, cap: int | None) -> DataFrame:
    """Adds ``chosen``: the ``cap`` boards longest unvisited, those never visited before all; all of them without a cap."""
    joined = boards.join(state.select(*keys, F.col(at).alias("_at")), keys, "left").withColumn("_at", F.coalesce("_at", F.lit(0.0)))
    if cap is None or cap <= 0:
        return joined.withColumn("chosen", F.lit(True)).drop("_at")
    first = joined.orderBy("_at", ordinal).limit(cap).select(*keys).withColumn("chosen", F.lit(True))
    return joined.drop("_at").join(first, keys, "left").withColumn("chosen", F.coalesce("chosen", F.lit(False)))


def new_sample(rows: DataFrame, known: DataFrame, key: str, most: int = 200) -> DataFrame:
    """The first ``most`` linked rows by key that were not known before."""
    fresh = rows.join(known.select(key).distinct(), key, "left_anti")
    return fresh.filter(T.text(F.col("link")).rlike("^https?://")).orderBy(key).limit(most)


def probe_plan(boards: DataFrame, state: DataFrame, now: float, cap: int, cooldown_hours: float, zero_runs: int = 3, probation_hours: float = 168.0) -> DataFrame:
    """Boards (ats, slug, lane, ordinal) with state (ats, slug, at, rows, zero) -> ats, slug, decision.

    A board visited within the cooldown waits; one that brought nothing ``zero_runs`` times is
    parked until its probation ends; of the rest the ``cap`` highest scores are probed, the
    others deferred.  Boards never visited count as starved.
    """
    joined = boards.join(state, ["ats", "slug"], "left")
    at = F.coalesce("at", F.lit(0.0))
    hours = (F.lit(now) - at) / 3600.0
    wait = F.when(at == 0, F.lit(144.0)).otherwise(F.greatest(hours, F.lit(0.0)))
    parked = (F.coalesce("zero", F.lit(0)) >= zero_runs) & (hours < probation_hours)
    judged = joined.withColumns({"_state": F.when(at > now - cooldown_hours * 3600, "cooldown").when(parked, "parked"), "_score": board_score(wait, F.coalesce("rows", F.lit(0)), F.col("lane"))})
    chosen = judged.filter("_state is null").orderBy(F.desc("_score"), "ordinal").limit(cap).select("ats", "slug", F.lit("probe").alias("_pick"))
    return judged.join(chosen, ["ats", "slug"], "left").select("ats", "slug", F.coalesce("_state", "_pick", F.lit("deferred")).alias("decision"))


def recorded_probe(state: DataFrame, probes: DataFrame, now: float) -> DataFrame:
    """State (ats, slug, at, rows, zero) after probes (ats, slug, rows): time, yield and the run of visits that brought nothing."""
    both = state.join(probes.select("ats", "slug", F.col("rows").alias("_rows")), ["ats", "slug"], "full")
    seen = F.col("_rows").isNotNull()
    return both.select(
        "ats", "slug", F.when(seen, F.lit(now)).otherwise(F.col("at")).alias("at"), F.when(seen, F.col("_rows")).otherwise(F.col("rows")).cast("long").alias("rows"),
        F.when(~seen, F.col("zero")).when(F.col("_rows") == 0, F.coalesce("zero", F.lit(0)) + 1).otherwise(0).cast("int").alias("zero"),
    )


def feed_order(df: DataFrame) -> DataFrame:
    """The small feed's order, by employer, role, place and link, without the column that every run restamps."""
    lower = lambda c: F.lower(T.text(F.col(c)))
    return df.drop("observed_at").orderBy(lower("company"), lower("role"), lower("location"), T.text(F.col("link")))


def previous_rows(df: DataFrame, group: Column, order: list[Column], columns: list[str]) -> DataFrame:
    """Adds ``repeated``: does the row above have the same values.  Rows are compared inside ``group``, a part of the table's pages."""
    w = Window.partitionBy(group).orderBy(*order)
    same = F.lit(True)
    for c in columns:
        same = same & F.col(c).eqNullSafe(F.lag(c).over(w))
    return df.withColumn("repeated", same & F.lag(F.lit(1)).over(w).isNotNull())
