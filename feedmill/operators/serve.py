"""Serving: search filters, pages, lookups, profiles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmill.functions import dates as D
from feedmill.functions import money as M
from feedmill.functions import text as T
from feedmill.functions import url as U
from feedmill.operators.order import numbered


def text_match(query: str, fields: list[str]) -> Column:
    """Every word of the query occurs in the fields joined by spaces."""
    hay = F.lower(F.concat_ws(" ", *[T.text(F.col(f)) for f in fields]))
    return reduce(lambda a, w: a & hay.contains(w), query.lower().split(), F.lit(True))


def csv_set(value: str, upper: bool = False) -> list[str]:
    return [v.strip().upper() if upper else v.strip().lower() for v in value.split(",") if v.strip()]


def clamp(value, default: int, low: int, high: int) -> int:
    try:
        return max(low, min(high, int(value)))
    except (TypeError, ValueError):
        return default


def search(df: DataFrame, args: dict, as_of: Column, fields: list[str]) -> DataFrame:
    """Rows that pass every filter given."""
    conds: list[Column] = []
    if args.get("query"):
        conds.append(text_match(args["query"], fields))
    conds += [F.lower(T.text(F.col(f))).contains(str(args[f]).lower()) for f in ("location", "company") if args.get(f)]
    if args.get("category"):
        conds.append(F.lower(T.text(F.col("category"))) == str(args["category"]).lower())
    conds += [F.lower(T.text(F.col(f))).isin(csv_set(args[f])) for f in ("job_type", "ats_type") if args.get(f)]
    if args.get("country"):
        conds.append(F.upper(T.text(F.col("country_iso"))).isin(csv_set(args["country"], True)))
    conds += [M.truthy(F.col(c)) for a, c in (("remote_only", "is_remote"), ("visa_sponsor", "visa_sponsor"), ("direct_apply", "direct_apply")) if args.get(a)]
    top = lambda: M.high(F.col("salary_min"), F.col("salary_max"))
    if args.get("salary_disclosed"):
        conds.append(top().isNotNull())
    if args.get("min_salary") is not None:
        conds.append(top() >= float(args["min_salary"]))
    if args.get("posted_within_days") is not None:
        days = clamp(args["posted_within_days"], 7, 0, 365)
        conds.append(F.unix_timestamp(D.parse(F.col("date"))) >= F.unix_timestamp(as_of) - days * D.DAY)
    return df.filter(reduce(lambda a, b: a & b, conds, F.lit(True)))


def page(df: DataFrame, order: list[Column], limit=25, cursor=0, most: int = 200) -> tuple[DataFrame, dict]:
    """A page of rows in order and its place: count, returned, next_cursor."""
    limit, start, total = clamp(limit, 25, 1, most), max(0, clamp(cursor, 0, 0, 1 << 31)), df.count()
    returned = max(0, min(limit, total - start))
    after = start + returned
    return df.orderBy(*order).offset(start).limit(limit), {"count": total, "returned": returned, "next_cursor": str(after) if after < total else None}


def newest(date: Column, ident: Column) -> list[Column]:
    return [date.desc_nulls_last(), ident.desc()]


def top_n(df: DataFrame, column: str, n: int, ordinal: str) -> DataFrame:
    """Commonest values; ties in order of first occurrence."""
    counts = df.groupBy(column).agg(F.count("*").alias("n"), F.min(ordinal).alias("_o"))
    return counts.orderBy(F.desc("n"), "_o").limit(n).drop("_o")


def rotate(df: DataFrame, order: list[Column], start: int, cap: int) -> DataFrame:
    """``cap`` rows of a ring that begins at ``start``."""
    ring = numbered(df, order, "_i")
    n = ring.count()
    return ring.filter(F.pmod(F.col("_i") - start, F.lit(max(1, n))) < cap).drop("_i")


def brief(df: DataFrame) -> DataFrame:
    """Optional keys are null, which JSON output leaves out."""
    shown = F.trim(T.text(F.col("description")))
    return df.select(
        "id", "company", "role", "location", F.substring(T.text(F.col("date")), 1, 10).alias("date"), "link",
        M.truthy(F.col("is_remote")).alias("is_remote"), M.number(F.col("salary_min")).alias("salary_min"), M.number(F.col("salary_max")).alias("salary_max"),
        F.when(shown != "", F.substring(shown, 1, 400)).alias("description"), F.when(F.length(shown) > 400, F.lit(True)).alias("description_truncated"),
    )


DETAIL_TEXTS = (
    "company", "role", "location", "date", "link", "source", "category", "job_type", "career_family", "industry", "career_reason", "seniority", "employment_type",
    "country_iso", "ats_type", "ats_id", "salary_currency", "source_posted_at", "verification_status", "first_seen_at", "last_seen_at", "last_verified_at",
    "verified_at", "observed_at", "closed_at",
)


def detail(df: DataFrame, *keep: str) -> DataFrame:
    """Everything that a posting has, blanks as null, flags and numbers as such, the description whole; ``keep`` names columns that stay as they are."""
    has = lambda c: c in df.columns
    texts = [F.nullif(F.col(c).cast("string"), F.lit("")).alias(c) for c in DETAIL_TEXTS if has(c)]
    flags = [M.truthy(F.col(c)).alias(c) if has(c) else F.lit(False).alias(c) for c in ("is_remote", "direct_apply", "visa_sponsor")]
    amounts = [M.number(F.col(c)).alias(c) for c in ("salary_min", "salary_max", "visa_median_salary") if has(c)]
    shown = F.trim(T.text(F.col("description")))
    return df.select(*keep, U.serving_id(F.col("ats_type"), F.col("ats_id"), F.col("link")).alias("id"), *texts, *flags, *amounts, shown.alias("description"), F.length(shown).alias("description_chars"))


class Feed:
    """The published feed for serving: read again only when its key changes, looked at once in ``every`` seconds."""

    def __init__(self, load, key, clock, every: float = 30.0) -> None:
        self._load, self._key, self._clock, self._every = load, key, clock, every
        self._held = self._seen = None
        self._at = float("-inf")

    def rows(self) -> DataFrame:
        now = self._clock()
        if self._held is not None and now - self._at < self._every:
            return self._held
        key, self._at = self._key(), now
        if self._held is None or key is not None and key != self._seen:
            fresh = self._load().cache()
            if self._held is not None:
                self._held.unpersist()
            self._held, self._seen = fresh, key
        return self._held
