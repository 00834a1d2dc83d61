"""Rows out of fetched documents: JSON-LD pages, feeds, tables, lists, sitemaps, robots, embedded payloads."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedmill.functions import money as M
from feedmill.functions import text as X

LD_DEPTH = 4


def title_of(html: Column) -> Column:
    return X.strip_tags(F.regexp_extract(X.text(html), r"(?is)<title[^>]*>(.*?)</title>", 1))


def anchors(df: DataFrame, html: str = "html") -> DataFrame:
    """A row for each link of a page: its place, address and text."""
    tags = F.regexp_extract_all(X.text(F.col(html)), F.lit(r"""(?is)(<a\s[^>]*href=["'][^"']*["'][^>]*>.*?</a>)"""), 1)
    got = df.select(*[c for c in df.columns if c != html], F.posexplode(tags).alias("place", "tag"))
    return got.withColumns({"href": F.regexp_extract("tag", r"""(?is)href=["']([^"']*)["']""", 1), "label": X.strip_tags(F.col("tag"))}).drop("tag")


def list_items(df: DataFrame, html: str = "html") -> DataFrame:
    items = F.regexp_extract_all(X.text(F.col(html)), F.lit("(?is)<li[^>]*>(.*?)</li>"), 1)
    return df.select(*[c for c in df.columns if c != html], F.posexplode(F.transform(items, X.strip_tags)).alias("place", "item"))


def json_ld(df: DataFrame, html: str = "html", kind: str = "JobPosting") -> DataFrame:
    """Postings of a page's JSON-LD: objects and lists of them, @graph, mainEntity and itemListElement, LD_DEPTH levels deep."""
    blocks = F.regexp_extract_all(X.text(F.col(html)), F.lit(r"""(?is)<script[^>]*application/ld\+json[^>]*>(.*?)</script>"""), 1)
    rows = df.select(*[c for c in df.columns if c != html], F.explode(blocks).alias("_j")).withColumn("_v", F.try_parse_json("_j")).filter("_v is not null")
    rest = [c for c in rows.columns if c not in ("_j", "_v")]

    def spread(d: DataFrame) -> DataFrame:
        listed = "variant_get(_v, '$', 'array<variant>')"
        many = d.select(*rest, F.explode(F.expr(f"CASE WHEN schema_of_variant(_v) LIKE 'ARRAY%' THEN {listed} ELSE array(_v) END")).alias("_v"))
        inner = F.expr(
            "concat(array(_v), " + ", ".join(
                f"coalesce(CASE WHEN schema_of_variant(try_variant_get(_v, '$.{k}', 'variant')) LIKE 'ARRAY%' THEN try_variant_get(_v, '$.{k}', 'array<variant>') "
                f"ELSE array(try_variant_get(_v, '$.{k}', 'variant')) END, array())" for k in ("\"@graph\"", "mainEntity", "itemListElement", "item")
            ).replace('$."@graph"', "$[\"@graph\"]") + ")"
        )
        return many.select(*rest, F.explode(inner).alias("_v")).filter("_v is not null")

    nodes = rows
    for _ in range(LD_DEPTH):
        nodes = spread(nodes)
    at = lambda p, kind_="string": F.expr(f"try_variant_get(_v, '{p}', '{kind_}')")
    first = lambda *ps: F.coalesce(*[at(p) for p in ps])
    typed = nodes.withColumn("_t", F.coalesce(at('$["@type"][0]'), at('$["@type"]'))).filter(F.col("_t") == kind)
    return typed.select(
        *rest, X.placeholder_to_null(at("$.title")).alias("role"), first("$.hiringOrganization.name", "$.hiringOrganization[0].name", "$.hiringOrganization").alias("company"),
        F.concat_ws(
            ", ", first("$.jobLocation.address.addressLocality", "$.jobLocation[0].address.addressLocality"), first("$.jobLocation.address.addressRegion", "$.jobLocation[0].address.addressRegion")
        ).alias("location"),
        first("$.jobLocation.address.addressCountry", "$.jobLocation[0].address.addressCountry", "$.jobLocation.address.addressCountry.name").alias("country"),
        at("$.datePosted").alias("date"), M.coerce(first("$.baseSalary.value.minValue", "$.baseSalary.value", "$.baseSalary")).alias("salary_min"),
        M.coerce(at("$.baseSalary.value.maxValue")).alias("salary_max"), first("$.baseSalary.currency").alias("salary_currency"),
        (F.lower(X.text(at("$.jobLocationType"))) == "telecommute").alias("is_remote"), X.strip_tags(at("$.description")).alias("description"),
    ).distinct()


def feed_items(df: DataFrame, xml: str = "xml") -> DataFrame:
    """Items of RSS 2.0 or Atom: title, link (text or href), published, description; CDATA is unwrapped."""
    items = F.regexp_extract_all(X.text(F.col(xml)), F.lit(r"(?is)(<(?:item|entry)[\s>].*?</(?:item|entry)>)"), 1)
    got = df.select(*[c for c in df.columns if c != xml], F.posexplode(items).alias("place", "_x"))
    tag = lambda *names: F.regexp_replace(F.regexp_extract("_x", rf"(?is)<(?:{'|'.join(names)})(?:\s[^>]*)?>(.*?)</(?:{'|'.join(names)})>", 1), r"(?s)<!\[CDATA\[(.*?)\]\]>", "$1")
    href = F.regexp_extract("_x", r"""(?is)<link[^>]+href=["']([^"']+)["']""", 1)
    link = F.trim(tag("link"))
    return got.withColumns(
        {"title": X.strip_tags(tag("title")), "link": F.when(link != "", link).otherwise(href), "published": F.trim(tag("pubDate", "published", "updated")), "description": X.strip_tags(tag("description", "summary", "content"))}
    ).drop("_x")


def html_tables(df: DataFrame, html: str = "html") -> DataFrame:
    """Cells of a page's tables: table, row and column number, text."""
    rest = [c for c in df.columns if c != html]
    tables = df.select(*rest, F.posexplode(F.regexp_extract_all(X.text(F.col(html)), F.lit("(?is)(<table.*?</table>)"), 1)).alias("table_no", "_t"))
    rows = tables.select(*rest, "table_no", F.posexplode(F.regexp_extract_all("_t", F.lit("(?is)(<tr.*?</tr>)"), 1)).alias("row_no", "_r"))
    cells = rows.select(*rest, "table_no", "row_no", F.posexplode(F.regexp_extract_all("_r", F.lit("(?is)(<t[dh].*?</t[dh]>)"), 1)).alias("col_no", "_c"))
    return cells.withColumn("cell", X.strip_tags(F.col("_c"))).drop("_c")


def cell_link(c: Column) -> Column:
    """Markdown link, else first anchor that is no tracker, else first anchor, else bare URL."""
    hrefs = F.regexp_extract_all(X.text(c), F.lit(r"""(?i)<a\s+[^>]*href=["']([^"']+)["']"""), 1)
    pick = lambda x: F.when(x != "", x)
    return F.coalesce(
        pick(F.regexp_extract(X.text(c), r"\[[^\]]*\]\(([^)\s]+)", 1)), F.get(F.filter(hrefs, lambda h: ~h.contains("simplify.jobs")), F.lit(0)),
        F.get(hrefs, F.lit(0)), pick(F.regexp_extract(X.text(c), r"""(https?://[^\s"'<>)]+)""", 1)), F.lit(""),
    )


def sitemap_locs(df: DataFrame, xml: str = "xml") -> DataFrame:
    locs = F.regexp_extract_all(X.text(F.col(xml)), F.lit(r"(?is)<loc>\s*(.*?)\s*</loc>"), 1)
    return df.select(*[c for c in df.columns if c != xml], F.col(xml).rlike("(?i)<sitemapindex").alias("is_index"), F.explode(locs).alias("loc"))


def sitemap_walk(documents: DataFrame, root: str, depth: int = 2, most: int = 12) -> DataFrame:
    """Page addresses below a root of (loc, xml) documents: indexes are followed ``depth`` levels, ``most`` documents each."""
    level = documents.filter(F.col("loc") == root).select("xml")
    pages = None
    for _ in range(depth + 1):
        found = sitemap_locs(level)
        leaf = found.filter("not is_index").select("loc")
        pages = leaf if pages is None else pages.unionByName(leaf)
        level = documents.join(found.filter("is_index").select("loc").distinct().orderBy("loc").limit(most), "loc", "left_semi").select("xml")
    return pages.distinct()


def robots_rules(text: str, agent: str) -> list[tuple[str, str]]:
    """(directive, path) of the most specific group for ``agent``, else of ``*``."""
    groups: dict[str, list[tuple[str, str]]] = {}
    names: list[str] = []
    fresh = True
    for line in text.splitlines():
        key, _, value = line.split("#", 1)[0].partition(":")
        key, value = key.strip().lower(), value.strip()
        if key == "user-agent":
            names = [*names, value.lower()] if fresh and names else [value.lower()]
            fresh = True
            groups.setdefault(value.lower(), [])
        elif key in ("allow", "disallow") and names:
            fresh = False
            for n in names:
                groups[n].append((key, value))
    fit = max((n for n in groups if n != "*" and n in agent.lower()), key=len, default="*")
    return groups.get(fit, [])


def robots_allows(text: str, agent: str, path: str) -> bool:
    """Longest rule decides, allow on ties; no rule allows."""
    best = (-1, True)
    for kind, prefix in robots_rules(text, agent):
        pattern = re.escape(prefix).replace(r"\*", ".*").replace(r"\$", "$")
        if prefix and re.match(pattern, path):
            best = max(best, (len(prefix), kind == "allow"))
    return best[1]


def balanced(text: str, start: int) -> str:
    """The bracketed value at ``start``, quotes respected; empty if it does not close."""
    depth, quoted, skip = 0, False, False
    for i in range(start, len(text)):
        c = text[i]
        if skip:
            skip = False
        elif quoted:
            skip, quoted = c == "\\", c != '"'
        elif c == '"':
            quoted = True
        elif c in "[{":
            depth += 1
        elif c in "]}":
            depth -= 1
            if not depth:
                return text[start : i + 1]
    return ""


def embedded_arrays(df: DataFrame, key: str, html: str = "html") -> DataFrame:
    """JSON array behind ``"key":`` in a page's escaped payload; a scanner, so an Arrow function."""
    rest = [c for c in df.columns if c != html]
    schema = T.StructType([df.schema[c] for c in rest] + [T.StructField("payload", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = []
            for h in b.column(html):
                flat = (h.as_py() or "").replace('\\"', '"').replace("\\\\", "\\")
                at = flat.find(f'"{key}":[')
                found.append(balanced(flat, at + len(key) + 3) if at >= 0 else "")
            yield pa.RecordBatch.from_arrays([b.column(c) for c in rest] + [pa.array(found, pa.string())], [*rest, "payload"])

    return df.mapInArrow(run, schema)
