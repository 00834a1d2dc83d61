"""Lists of postings in four formats: Markdown and HTML tables, CSV and JSON, all to the same columns."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedmill.functions import dates as D
from feedmill.functions import text as T
from feedmill.sources.parsers import cell_link

#: Headings of list tables and the fields they mean (fixed values).
HEADER_ALIASES = {
    "company": "company", "role": "role", "position": "role", "title": "role", "location": "location", "locations": "location",
    "application": "link", "application/link": "link", "posting": "link", "apply": "link", "apply link": "link", "link": "link", "referral": "link",
    "age": "date", "posted": "date", "added": "date", "date": "date", "date posted": "date", "posted at": "date", "posting date": "date",
}
FIELDS = ("company", "role", "location", "link", "date")
LIST_COLUMNS = ("company", "role", "location", "date", "link", "is_remote")
CSV_WIDTH = 32  # columns of a CSV list that are looked at


def header(c: Column) -> Column:
    """A heading without markup, stars and what stands in brackets."""
    bare = F.regexp_replace(F.regexp_replace(T.strip_tags(c), r"^\*+|\*+$", ""), r"^\s+|\s+$", "")
    return F.lower(F.trim(F.substring_index(bare, "(", 1)))


def list_location(c: Column) -> Column:
    """A location cell: breaks as commas, without summaries and brackets."""
    t = F.regexp_replace(F.regexp_replace(T.text(c), "(?is)<summary>.*?</summary>", " "), r"(?i)<br\s*/?>", ", ")
    t = F.regexp_replace(T.strip_tags(t), r"\s*\([^)]*\)", "")
    return F.regexp_replace(F.regexp_replace(t, r"\s{2,}", " "), "^[ ,]+|[ ,]+$", "")


def list_date(c: Column, as_of: Column) -> Column:
    """A date or age cell as ISO text; empty for none."""
    return F.coalesce(F.date_format(D.list_age(T.strip_tags(c), as_of), "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit(""))


def _from_cells(rows: DataFrame, keys: list[str], order: str, as_of: Column, markdown: bool) -> DataFrame:
    """Rows (keys, order, _names, _c) of one table a key -> list columns; a blank or arrow-marked company takes the one above."""

    def cell(name: str) -> Column:
        at = F.array_position("_names", name)
        return F.when(at > 0, F.coalesce(F.get("_c", (at - 1).cast("int")), F.lit(""))).otherwise("")

    bare = lambda c: F.regexp_replace(F.regexp_replace(c, r"^\*+|\*+$", ""), r"^\s+|\s+$", "")
    shown, role = T.strip_tags(cell("company")), T.strip_tags(cell("role"))
    link = cell_link(cell("link"))
    if markdown:
        shown, role = bare(shown), bare(role)
        link = F.when(link != "", link).otherwise(cell_link(cell("company")))
    marks = ("", "↳") if markdown else ("", "↳", "&raquo;", "»")
    above = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    made = rows.withColumns({"company": shown, "role": role, "location": list_location(cell("location")), "link": link, "date": list_date(cell("date"), as_of)})
    filled = made.withColumn("company", F.last(F.when(~F.col("company").isin(*marks), F.col("company")), True).over(above))
    # the whole of it, stars as well, where a Markdown link names the company
    named = F.trim(F.regexp_replace(bare(F.col("company")), r"\*\*|\[([^\]]*)\]\([^)]*\)", "$1"))
    out = filled.withColumn("company", F.coalesce(named, F.lit(""))).withColumn("is_remote", F.lower("location").contains("remote").cast("string"))
    return out.filter("company <> '' and role <> '' and location <> ''")


def _names(cells: Column) -> Column:
    """Fields that headings mean, each at its first heading."""
    known = F.create_map(*[F.lit(x) for kv in HEADER_ALIASES.items() for x in kv])
    named = F.transform(cells, lambda c: F.coalesce(known[header(c)], F.lit("")))
    return F.when(F.array_contains(named, "company") & F.array_contains(named, "role"), named)


def markdown_rows(df: DataFrame, as_of: Column, body: str = "body") -> DataFrame:
    """(id, body) -> id, table_no, line_no and list columns of pipe tables.

    A table is a run of lines that begin with a bar, its first line the header; rows of dashes
    are rules; tables without a company and a role are none.
    """
    lines = df.select("id", F.posexplode(F.split(T.text(F.col(body)), r"\r?\n")).alias("line_no", "_l")).withColumn("_bar", F.ltrim("_l").startswith("|"))
    w = Window.partitionBy("id").orderBy("line_no")
    tabled = lines.withColumn("_head", F.col("_bar") & ~F.coalesce(F.lag("_bar").over(w), F.lit(False)))
    tabled = tabled.withColumn("table_no", F.sum(F.col("_head").cast("int")).over(w).cast("int")).filter("_bar")
    cells = F.transform(F.split(F.regexp_replace(F.trim("_l"), r"^\|+|\|+$", ""), r"\|"), lambda c: F.trim(c))
    tabled = tabled.withColumn("_c", cells)
    heads = tabled.filter("_head").select("id", "table_no", _names(F.col("_c")).alias("_names")).filter("_names is not null")
    rule = F.forall("_c", lambda c: F.replace(c, F.lit(" ")).rlike("^:?-{2,}:?$"))
    rows = tabled.filter(~F.col("_head")).filter(~rule).join(heads, ["id", "table_no"])
    return _from_cells(rows, ["id", "table_no"], "line_no", as_of, True).select("id", "table_no", "line_no", *LIST_COLUMNS)


def html_rows(df: DataFrame, as_of: Column, body: str = "body") -> DataFrame:
    """(id, body) -> id, table_no, line_no and list columns of HTML tables; the first row with a heading cell is the header."""
    tables = df.select("id", F.posexplode(F.regexp_extract_all(T.text(F.col(body)), F.lit("(?is)(<table.*?</table>)"), 1)).alias("table_no", "_t"))
    rows = tables.select("id", "table_no", F.posexplode(F.regexp_extract_all("_t", F.lit("(?is)(<tr.*?</tr>)"), 1)).alias("line_no", "_r"))
    rows = rows.withColumn("_c", F.regexp_extract_all("_r", F.lit("(?is)(<t[dh].*?</t[dh]>)"), 1)).filter(F.size("_c") > 0)
    rows = rows.withColumn("_head", F.exists("_c", lambda c: F.lower(F.ltrim(c)).startswith("<th")))
    heads = rows.filter("_head").groupBy("id", "table_no").agg(F.min_by("_c", "line_no").alias("_h")).select("id", "table_no", _names(F.col("_h")).alias("_names")).filter("_names is not null")
    made = rows.filter(~F.col("_head") & (F.size("_c") > 1)).join(heads, ["id", "table_no"])
    return _from_cells(made, ["id", "table_no"], "line_no", as_of, False).select("id", "table_no", "line_no", *LIST_COLUMNS)


def csv_rows(df: DataFrame, body: str = "body") -> DataFrame:
    """(id, body) -> id, line_no and list columns; none unless company, title, location and url are among the headings, rows without one of them are left out."""
    lines = df.select("id", F.posexplode(F.split(T.text(F.col(body)), r"\r?\n")).alias("line_no", "_l")).filter("trim(_l) <> ''")
    struct = F.from_csv("_l", ", ".join(f"c{i} string" for i in range(CSV_WIDTH)))
    cells = lines.withColumn("_r", struct).withColumn("_c", F.array(*[F.coalesce(F.col(f"_r.c{i}"), F.lit("")) for i in range(CSV_WIDTH)])).drop("_r", "_l")
    heads = cells.filter("line_no = 0").select("id", F.col("_c").alias("_names"))
    whole = F.size(F.array_intersect("_names", F.array(*[F.lit(x) for x in ("company", "title", "location", "url")]))) == 4
    rows = cells.filter("line_no > 0").join(heads.filter(whole), "id")

    def cell(name: str) -> Column:
        at = F.array_position("_names", name)
        return F.when(at > 0, F.get("_c", (at - 1).cast("int"))).otherwise("")

    made = rows.select(
        "id", "line_no", cell("company").alias("company"), cell("title").alias("role"), cell("location").alias("location"), cell("posted_at").alias("date"), cell("url").alias("link"),
        (F.lower(F.trim(cell("remote"))) == "remote").cast("string").alias("is_remote"),
    )
    return made.filter("company <> '' and role <> '' and location <> '' and link <> ''")


JOB = "company:string,title:string,location:string,listingUrl:string,url:string,posted:string,posted_at:string"


def json_rows(df: DataFrame, body: str = "body") -> DataFrame:
    """(id, body) -> id and list columns of a JSON list, bare or under ``jobs``; rows without employer, title, place or link are left out."""
    c = F.col(body)
    bare, wrapped = F.from_json(c, f"array<struct<{JOB}>>"), F.from_json(F.get_json_object(c, "$.jobs"), f"array<struct<{JOB}>>")
    j = F.col("j")
    pick = lambda a, b: F.trim(F.coalesce(F.nullif(j[a], F.lit("")), j[b], F.lit("")))
    rows = df.select("id", F.explode(F.when(F.ltrim(c).startswith("["), bare).otherwise(wrapped)).alias("j"))
    made = rows.select(
        "id", F.trim(T.text(j["company"])).alias("company"), F.trim(T.text(j["title"])).alias("role"), F.trim(T.text(j["location"])).alias("location"), pick("posted", "posted_at").alias("date"), pick("listingUrl", "url").alias("link"),
    ).withColumn("is_remote", F.lower("location").contains("remote").cast("string"))
    return made.filter("company <> '' and role <> '' and location <> '' and link <> ''")


def list_rows(df: DataFrame, as_of: Column) -> DataFrame:
    """(id, format, body) of any of the four formats -> id, format and list columns; other formats read as Markdown."""
    of = lambda name: df.filter(F.col("format") == name).select("id", "body")
    rest = df.filter(F.col("format").isNull() | ~F.col("format").isin("csv", "json", "html")).select("id", "body")
    parts = {"csv": csv_rows(of("csv")), "json": json_rows(of("json")), "html": html_rows(of("html"), as_of), "md": markdown_rows(rest, as_of)}
    out = None
    for name, rows in parts.items():
        rows = rows.select("id", F.lit(name).alias("format"), *LIST_COLUMNS)
        out = rows if out is None else out.unionByName(rows)
    return out


def season_urls(url: str, first_year: int = 2023) -> list[str]:
    """The address, then those of the seasons beside its year, none before ``first_year``."""
    found = re.search(r"20\d\d", url)
    if not found:
        return [url]
    year = int(found[0])
    return [url, *(url.replace(found[0], str(y), 1) for y in (year + 1, year - 1) if y >= first_year)]


def with_season_urls(df: DataFrame, url: str = "url", first_year: int = 2023) -> DataFrame:
    """A row for each address to try, in order of ``attempt``: as :func:`season_urls`, for a column."""
    year = F.regexp_extract(url, r"20\d\d", 0)
    before, after = F.regexp_extract(url, r"(?s)^(.*?)20\d\d", 1), F.regexp_extract(url, r"(?s)^.*?20\d\d(.*)$", 1)
    other = lambda step: F.when(year.try_cast("int") + step >= first_year, F.concat(before, (year.try_cast("int") + step).cast("string"), after))
    tries = F.when(year == "", F.array(url)).otherwise(F.array_compact(F.array(F.col(url), other(1), other(-1))))
    return df.select(*[c for c in df.columns if c != url], F.posexplode(tries).alias("attempt", url))


def first_answers(tries: DataFrame, answers: DataFrame, key: str = "id", url: str = "url") -> DataFrame:
    """(key, attempt, url) with recorded answers (url, status, body) -> the first attempt of each key that was answered with 200."""
    good = tries.join(answers.filter("status = 200").select(url, "body"), url)
    return good.groupBy(key).agg(F.min_by(F.struct(url, "attempt", "body"), "attempt").alias("x")).select(key, f"x.{url}", "x.attempt", "x.body")
