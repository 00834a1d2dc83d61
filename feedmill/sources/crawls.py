"""Crawls over recorded documents: sitemaps, shortlists of addresses, pages to postings, several hosts."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedmill.functions import geo as G
from feedmill.functions import text as T
from feedmill.sources import parsers as P

#: Paths of postings and paths that are none; slugs of beginners' postings, of two crawls; addresses of a sharded crawl (fixed values).
JOB_PATH = r"(?i)/(?:job|jobs|career|careers|position|positions|opening|openings|vacancy|vacancies|requisition|requisitions|jobsearch|job-search|viewjob)/"
SKIP_PATH = (
    r"(?i)/(?:apply|application|search|searchresults|login|signin|account|profile|preapply|applybutton|talentcommunity|emailsubscribe)(?:/|$)"
    r"|\.(?:pdf|docx?|xlsx?|pptx?|png|jpe?g|gif|svg|zip|css|js)(?:\?|$)"
)
EARLY_SLUG = r"(?i)(?:intern|internship|co-?op|new-?grad|newgrad|graduate|entry-?level|junior|trainee|apprentice|early-?career|rotation)"
EARLY_WORDS = (
    r"(?i)\bintern(?:ship)?\b|co-op|coop|undergraduate|undergrad|student|reu|apprentice|trainee|fellowship|praktikum|werkstudent|new[\s-]grad(?:uate)?\b"
    r"|entry[\s-]level|early\s+career|university[\s-]grad(?:uate)?\b|junior\b|rotational|campus\b"
)
SHARD_PATH = r"/explore/job/[a-zA-Z0-9]+$"


def dated_urls(df: DataFrame, xml: str = "xml") -> DataFrame:
    """(url, lastmod) of postings that a sitemap dates, each slug once, in the sitemap's order (``place``)."""
    entries = F.regexp_extract_all(T.text(F.col(xml)), F.lit(r"(?s)(<url>\s*<loc>.*?</loc>\s*<lastmod>.*?</lastmod>)"), 1)
    rows = df.select(*[c for c in df.columns if c != xml], F.posexplode(entries).alias("place", "_e"))
    rows = rows.select(
        *[c for c in rows.columns if c != "_e"], F.regexp_extract("_e", "(?s)<loc>(.*?)</loc>", 1).alias("url"), F.trim(F.regexp_extract("_e", "(?s)<lastmod>(.*?)</lastmod>", 1)).alias("lastmod")
    )
    return rows.filter(F.col("url").contains("/job/"))


def early_candidates(urls: DataFrame, key: list[str]) -> DataFrame:
    """Of dated addresses the first of each slug whose words name a beginner's posting; a five-character code that ends a slug is no word."""
    slug = F.element_at(F.split("url", "/job/"), -1)
    rows = urls.withColumn("_slug", slug).withColumn("_n", F.row_number().over(Window.partitionBy(*key, "_slug").orderBy("place"))).filter("_n = 1")
    words = F.replace(F.regexp_replace("_slug", "-[a-z0-9]{5}$", ""), F.lit("-"), F.lit(" "))
    return rows.filter(words.rlike(EARLY_WORDS)).drop("_slug", "_n")


def shard_urls(shards: DataFrame, xml: str = "xml", pattern: str = SHARD_PATH) -> DataFrame:
    """Distinct addresses of postings over a sitemap's shards (shard, xml), each at the first shard that has it."""
    rows = shards.select("shard", F.posexplode(F.regexp_extract_all(T.text(F.col(xml)), F.lit(r"<loc>\s*([^<\s]+)\s*</loc>"), 1)).alias("place", "url")).filter(F.col("url").rlike(pattern))
    return rows.groupBy("url").agg(F.min(F.struct("shard", "place")).alias("x")).select("url", "x.shard", "x.place")


def page_rows(pages: DataFrame) -> DataFrame:
    """(company, url, html) -> a row for each page that is a posting: by its JSON-LD, else by its title.

    A page whose title says nothing is none.  The first posting of a page's JSON-LD counts.
    """
    keyed = pages.withColumn("_id", F.xxhash64("url", "html"))
    ld = P.json_ld(keyed.select("_id", F.col("url").alias("_url"), "html"), "html").filter("role is not null").withColumn("_n", F.row_number().over(Window.partitionBy("_id", "_url").orderBy("role", "company", "date")))
    best = ld.filter("_n = 1").select(
        "_id", "_url", F.struct("role", F.col("company").alias("org"), "location", "country", "date", "is_remote", "salary_min", "salary_max", "salary_currency").alias("ld")
    )
    joined = keyed.join(best, (keyed["_id"] == best["_id"]) & keyed["url"].eqNullSafe(best["_url"]), "left").drop("_id", "_url")
    title = T.fallback_role(P.title_of(F.col("html")), F.col("company"))
    meta = F.regexp_extract(T.text(F.col("html")), r"""(?is)<meta[^>]+name=["']description["'][^>]+content=["']([^"']*)["']""", 1)
    ld_, got = F.col("ld"), F.col("ld").isNotNull()
    full = F.concat_ws(", ", F.nullif(ld_["location"], F.lit("")), F.nullif(ld_["country"], F.lit("")))
    rows = joined.select(
        F.when(got, F.coalesce(F.nullif(T.strip_tags(ld_["org"]), F.lit("")), F.trim(T.text(F.col("company"))))).otherwise(F.trim(T.text(F.col("company")))).alias("company"),
        F.when(got, T.strip_tags(ld_["role"])).otherwise(F.substring(title, 1, 160)).alias("role"), F.when(got, full).otherwise("").alias("location"),
        F.when(got, F.substring(T.text(ld_["date"]), 1, 10)).otherwise("").alias("date"), F.col("url").alias("link"), F.when(got, (ld_["is_remote"] | F.lower(T.text(ld_["location"])).contains("remote")).cast("string")).otherwise("false").alias("is_remote"),
        ld_["salary_min"].alias("salary_min"), ld_["salary_max"].alias("salary_max"), F.upper(ld_["salary_currency"]).alias("salary_currency"),
        F.when(got, G.address_country(ld_["country"])).otherwise("").alias("country_iso"), F.when(~got, F.substring(T.strip_tags(meta), 1, 2000)).alias("description"),
    )
    return rows.filter("role <> ''")


def harvest(hosts: DataFrame, documents: DataFrame, urls: DataFrame, most: int = 40) -> DataFrame:
    """Postings of hosts (company, host): of each host's addresses (host, place, url) the first ``most`` that name a beginner's posting, read from documents (url, html).

    A host that is named twice counts once, by the company that sorts first.
    """
    real = hosts.select("company", F.lower(F.trim("host")).alias("host")).filter(F.col("host").contains(".")).groupBy("host").agg(F.min("company").alias("company"))
    wanted = urls.filter(F.col("url").rlike(JOB_PATH) & ~F.col("url").rlike(SKIP_PATH) & F.col("url").rlike(EARLY_SLUG)).groupBy("host", "url").agg(F.min("place").alias("place"))
    short = wanted.join(real, "host").withColumn("_n", F.row_number().over(Window.partitionBy("host").orderBy("place"))).filter(F.col("_n") <= most)
    return page_rows(short.join(documents, "url").select("company", "url", "html"))


def career_sites(df: DataFrame, robots: str = "robots") -> DataFrame:
    """(tenant, robots text) -> tenant, site, place: sites that robots lines name, then the tenant and the tenant capitalised, each once."""
    named = F.filter(F.regexp_extract_all(T.text(F.col(robots)), F.lit(r"(?m)^\s*Disallow:\s*/([A-Za-z0-9_.-]+)/"), 1), lambda s: s != "refreshFacet")
    own = F.array(F.col("tenant"), F.concat(F.upper(F.substring("tenant", 1, 1)), F.lower(F.substring("tenant", 2, 1 << 20))))
    return df.select("tenant", F.posexplode(F.filter(F.array_distinct(F.concat(named, own)), lambda s: s != "")).alias("place", "site"))


def robots_permit(df: DataFrame, rules: DataFrame, host: Column, path: Column, agent: str) -> DataFrame:
    """Rows whose path the robots text of their host permits; hosts without one permit all.  ``rules`` is (host, robots)."""

    def judge(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, paths in batches:
            yield pa.array([P.robots_allows(t.as_py() or "", agent, p.as_py() or "/") for t, p in zip(texts, paths)], pa.bool_())

    allowed = F.arrow_udf(judge, "boolean")
    joined = df.withColumn("_host", host).join(rules.select(F.col("host").alias("_host"), F.col("robots").alias("_robots")), "_host", "left").withColumn("_ok", allowed(T.text(F.col("_robots")), path))
    return joined.filter("_ok").drop("_host", "_robots", "_ok")
