"""Date expressions; the run's time is always an argument."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedmill.functions.text import text

DAY, HOUR = 86_400, 3_600
FORMATS = (
    "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS][XXX][X]", "yyyy-MM-dd HH:mm:ss[.SSSSSS][.SSS][XXX]", "yyyy-MM-dd", "d MMM yyyy HH:mm:ss z", "d MMM yyyy HH:mm:ss Z",
    "MMM d, yyyy", "d MMM yyyy", "MM/dd/yyyy",
)


def parse(c: Column) -> Column:
    """Timestamp of a text in any of the formats that sources use; null otherwise.  Numbers are epoch seconds or milliseconds."""
    t = F.regexp_replace(F.trim(text(c)), r"^[A-Za-z]{3}, (?=\d)", "")
    number = F.when(t.rlike(r"^\d{9,14}$"), t.cast("long"))
    return F.coalesce(
        *[F.try_to_timestamp(t, F.lit(f)) for f in FORMATS],
        F.timestamp_seconds(F.when(number >= 100_000_000_000, number / 1000).otherwise(number)),
    )


def days_old(posted: Column, as_of: Column) -> Column:
    """Whole days, rounded down."""
    return F.floor((F.unix_timestamp(as_of) - F.unix_timestamp(posted)) / DAY)


def hours_old(at: Column, as_of: Column) -> Column:
    return F.round((F.unix_micros(as_of) - F.unix_micros(at)) / 3_600_000_000, 2)


def age_label(posted: Column, as_of: Column) -> Column:
    days = F.greatest(days_old(posted, as_of), F.lit(0))
    return F.when(days == 0, "Today").when(days > 30, F.concat(F.floor(days / 30).cast("string"), F.lit("mo"))).otherwise(F.concat(days.cast("string"), F.lit("d")))


def _back(as_of: Column, seconds: Column) -> Column:
    return F.timestamp_seconds(F.unix_timestamp(as_of) - seconds)


def relative(label: Column, as_of: Column) -> Column:
    """``Posted 3 days ago`` as a timestamp; a label that says nothing is the run's time."""
    low = F.lower(text(label))
    n = F.coalesce(F.regexp_extract(low, r"(\d{1,6}) (?:day|week)s? ago", 1).try_cast("long"), F.lit(0))
    unit = F.when(low.rlike(r"\d week"), 7 * DAY).otherwise(DAY)
    return F.coalesce(
        parse(label), F.when(low.contains("today"), as_of).when(low.contains("yesterday"), _back(as_of, F.lit(DAY))).otherwise(_back(as_of, n * unit))
    )


def list_age(cell: Column, as_of: Column) -> Column:
    """Age cell of a list (2d, 3mo, 1y, 5h, 7m) or ISO date as a timestamp; null for none."""
    low = F.lower(F.trim(text(cell)))
    n = F.regexp_extract(low, r"^(\d{1,6})\s*[a-z]+", 1).try_cast("long")
    unit = F.regexp_extract(low, r"^\d+\s*([a-z]+)", 1)
    seconds = (
        F.when(unit.startswith("mo"), 30 * DAY).when(unit.startswith("w"), 7 * DAY).when(unit.startswith("y"), 365 * DAY)
        .when(unit.startswith("h"), HOUR).when(unit.startswith("m"), 60).otherwise(DAY)
    )
    return (
        F.when(low.isin("", "-", "—", "n/a", "na", "asap", "unknown"), F.lit(None).cast("timestamp"))
        .when(low == "today", F.date_trunc("day", as_of))
        .when(low.rlike(r"^\d{4}-\d{2}-\d{2}"), F.try_to_timestamp(F.substring(low, 1, 10), F.lit("yyyy-MM-dd")))
        .otherwise(_back(as_of, n * seconds))
    )
