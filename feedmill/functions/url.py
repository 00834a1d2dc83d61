"""URL expressions: canonical form, display form, identity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedmill.functions.text import text

#: Query parameters that never tell postings apart, besides utm_* (fixed values).
TRACKING = ("ref", "source", "in_iframe")
#: Brand labels of portals that have no page of their own for a posting (fixed values).
AGGREGATOR_BRANDS = (
    "adzuna", "whatjobs", "himalayas", "4dayweek", "governmentjobs", "wellfound", "weworkremotely", "comeet", "comparably", "sequoia-connect",
    "welcometothejungle", "remoteok", "builtin", "dice", "glassdoor", "indeed", "ziprecruiter", "monster", "simplyhired", "levelsfyi", "jooble",
    "jobrapido", "lensa", "snagajob",
)
#: Path words that stand where an id would (fixed values).
ROUTE_WORDS = (
    "application", "apply", "jobs", "job", "careers", "career", "embed", "login", "api", "oauth", "search", "external", "postings", "posting",
    "openings", "talent", "index", "new", "all",
)
UUID = "[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"


def host(url: Column) -> Column:
    """Lower-case authority of an absolute URL, empty otherwise."""
    return F.lower(F.regexp_extract(F.trim(text(url)), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))


def path(url: Column) -> Column:
    return F.regexp_extract(F.trim(text(url)), r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def query(url: Column) -> Column:
    return F.regexp_extract(F.trim(text(url)), r"^[^?#]*\?([^#]*)", 1)


def pairs_of(query_text: Column) -> Column:
    """Query parameters as structs (k, v), decoded; empty parts left out."""
    parts = F.filter(F.split(query_text, "&"), lambda p: p != "")
    decode = lambda c: F.coalesce(F.try_url_decode(c), c)
    return F.transform(
        parts, lambda p: F.struct(decode(F.substring_index(p, "=", 1)).alias("k"), decode(F.regexp_extract(p, "=(.*)$", 1)).alias("v"))
    )


def canonical(url: Column) -> Column:
    """Host without www, path without final slash, sorted query without tracking; empty if not http(s)."""
    ok = F.trim(text(url)).rlike(r"^https?://[^/?#]+")
    h = F.regexp_replace(host(url), r"^www\.", "")
    p = F.regexp_replace(path(url), "/+$", "")
    p = F.when(h == "apply.workable.com", F.regexp_replace(p, "(?i)/apply$", "")).otherwise(p)
    p = F.when(h.rlike(r"\.wd\d+\.myworkdayjobs\.com$"), F.lower(F.regexp_replace(p, "(?i)^/[a-z]{2}-[a-z]{2}(?=/)", ""))).otherwise(p)
    kept = F.filter(pairs_of(query(url)), lambda q: ~F.lower(q["k"]).startswith("utm_") & ~F.lower(q["k"]).isin(*TRACKING))
    flat = F.array_join(F.transform(F.array_sort(kept), lambda q: F.concat(F.url_encode(q["k"]), F.lit("="), F.url_encode(q["v"]))), "&")
    return F.when(ok, F.concat(h, p, F.when(flat != "", F.concat(F.lit("?"), flat)).otherwise(""))).otherwise("")


def display(url: Column) -> Column:
    """https form without tracking; search pages rebuilt; portals and other schemes empty."""
    link = F.trim(text(url))
    link = F.when(link.startswith("http://"), F.concat(F.lit("https://"), F.substring(link, 8, 1 << 20))).otherwise(link)
    search = r"^https?://([^/?]+)/\?.*mode=jobs.*?site_number=([^#&]+)#([^#]+)$"
    link = F.when(
        link.rlike(search), F.regexp_replace(link, search, "https://$1/hcmUI/CandidateExperience/en/sites/$2/job/$3")
    ).otherwise(link)
    link = F.regexp_replace(F.regexp_replace(link, r"[?&](?:utm_\w+|ref)=[^&#]*", ""), "[?&]$", "")
    brands = F.array(*[F.lit(b) for b in AGGREGATOR_BRANDS])
    portal = F.arrays_overlap(F.split(F.lower(F.regexp_extract(link, "^https://([^/]*)", 1)), r"\."), brands)
    return F.when(link.startswith("https://") & ~portal, link).otherwise("")


def _after(segments: Column, word: str) -> Column:
    """The path segment after the first ``word``, empty if none."""
    at = F.array_position(segments, word)
    return F.when(at > 0, F.coalesce(F.get(segments, at.cast("int")), F.lit(""))).otherwise("")


def _valid(c: Column) -> Column:
    return F.when(~F.lower(c).isin(*ROUTE_WORDS, "", "nan", "none", "null", "nat"), c).otherwise("")


def infer_identity(url: Column) -> Column:
    """struct(kind, id) that a board of known shape puts in its URLs; both empty otherwise."""
    h = F.regexp_replace(host(url), r"^.*@|:\d+$", "")
    segments = F.filter(F.split(path(url), "/"), lambda s: s != "")
    last = _valid(F.coalesce(F.try_element_at(segments, F.lit(-1)), F.lit("")))
    many = F.size(segments) >= 2
    tenant = F.regexp_replace(F.substring_index(h, ".", 1), "^(careers|career|jobs|job|apply|recruiting|talent)-", "")
    token = F.regexp_extract(query(url), "(?:^|&)token=([0-9]{5,})(?:&|$)", 1)
    posted = F.when(_after(segments, "jobs").rlike("^[0-9]{5,}$"), _after(segments, "jobs")).otherwise(token)
    pair = lambda kind, value: F.when(value != "", F.struct(F.lit(kind).alias("kind"), value.alias("id"))).otherwise(none)
    none = F.struct(F.lit("").alias("kind"), F.lit("").alias("id"))
    only = lambda cond, value: F.when(cond, value).otherwise("")
    scoped = lambda value: only(value != "", F.concat(tenant, F.lit("/"), value))
    numbered = _after(segments, "jobs")
    code = _valid(_after(segments, "j"))
    job = _valid(_after(segments, "job"))
    return (
        F.when(h.endswith("greenhouse.io"), pair("greenhouse", posted))
        .when(h.endswith("lever.co") & many, pair("lever", only(last.rlike(f"^{UUID}$"), last)))
        .when(h.endswith("ashbyhq.com") & many, pair("ashby", only(last.rlike(f"^{UUID}$"), last)))
        .when(h.endswith("workable.com"), pair("workable", only(code.rlike("^[A-Za-z0-9]{6,}$"), code)))
        .when(h.endswith("myworkdayjobs.com") | h.endswith("workday.com"), pair("workday", scoped(F.regexp_extract(last, r"_([A-Za-z]{1,4}-?\d{3,}(?:-\d+)?)$", 1))))
        .when(h.endswith("icims.com"), pair("icims", scoped(only(numbered.rlike("^[0-9]+$"), numbered))))
        .when(h.endswith("smartrecruiters.com") & many, pair("smartrecruiters", F.regexp_extract(last, r"^(\d{6,})", 1)))
        .when(h.endswith("bamboohr.com"), pair("bamboohr", scoped(_valid(_after(segments, "careers")))))
        .when(h.endswith("jobvite.com"), pair("jobvite", only(job.rlike("^[A-Za-z0-9]{6,}$"), job)))
        .otherwise(none)
    )


def feed_id(kind: Column, ident: Column, link: Column) -> Column:
    """Published id: ``kind:id`` in lower case, else a hash of the canonical URL, else empty."""
    url = canonical(link)
    return (
        F.when((text(kind) != "") & (text(ident) != ""), F.lower(F.concat(text(kind), F.lit(":"), text(ident))))
        .when(url != "", F.concat(F.lit("url:"), F.substring(F.sha1(url), 1, 16))).otherwise("")
    )


def serving_id(kind: Column, ident: Column, link: Column) -> Column:
    """Id that the query service derives: case as given, else a hash of the lower-case link."""
    return F.when(
        (F.trim(text(kind)) != "") & (F.trim(text(ident)) != ""), F.concat(F.trim(text(kind)), F.lit(":"), F.trim(text(ident)))
    ).otherwise(F.concat(F.lit("u:"), F.substring(F.sha1(F.lower(F.trim(text(link)))), 1, 16)))


def tail_id(link: Column) -> Column:
    """Last segment of the path unless it is a route; null without one."""
    tail = F.regexp_extract(F.regexp_replace(path(link), "/+$", ""), "/([^/]+)$", 1)
    return F.when((tail != "") & ~F.lower(tail).isin("jobs", "job", "apply"), tail)


def requisition_id(link: Column) -> Column:
    """``R2600885`` of ``.../Title_R2600885``; null if the tail has another shape."""
    bare = F.regexp_replace(F.substring_index(F.substring_index(text(link), "?", 1), "#", 1), "/+$", "")
    found = F.regexp_extract(bare, r"/[^/]*_([A-Za-z]{1,4}\d{4,})$", 1)
    return F.when(found != "", found)


#: Segments of a path that never name a board, and hosts whose path does: board, host pattern (fixed values).
NON_SLUGS = ("jobs", "job", "embed", "j", "apply", "application", "cxs", "wday")
PATH_BOARDS = (
    ("Greenhouse", r"^(?:job-)?boards\.(?:eu\.)?greenhouse\.io$", True), ("Lever", r"^jobs\.(?:eu\.)?lever\.co$", False), ("Ashby", r"^jobs\.ashbyhq\.com$", False),
    ("SmartRecruiters", r"\.smartrecruiters\.com$", False), ("Workable", r"^(?:(?:apply|jobs)\.)?workable\.com$", True), ("Rippling", r"^ats\.rippling\.com$", True),
)
#: Boards that their host names: board, pattern with the slug (fixed values).
HOST_BOARDS = (
    ("Pinpoint", r"^(.+)\.pinpointhq\.com$"), ("Recruitee", r"^(.+)\.recruitee\.com$"), ("Teamtailor", r"^(.+)\.teamtailor\.com$"), ("Breezy", r"^(.+)\.breezy\.hr$"),
    ("Personio", r"^([a-z0-9-]+)\.jobs\.personio\.(?:com|de)$"),
)
WORKDAY_HOST = r"^([a-z0-9-]+)\.wd\d+\.myworkdayjobs\.com$"


def board_of(link: Column) -> Column:
    """struct(board, slug) of a posting's link for seventeen vendors; both empty for unknown hosts and for what is no http link."""
    link = F.trim(text(link))
    h = F.when(link.rlike("(?i)^https?://"), F.regexp_replace(F.regexp_replace(host(link), "^.*@", ""), r":\d+$", "")).otherwise("")
    parts = F.filter(F.split(path(link), "/"), lambda s: s != "")
    first, second = F.coalesce(F.get(parts, F.lit(0)), F.lit("")), F.coalesce(F.get(parts, F.lit(1)), F.lit(""))
    is_ = lambda board, slug: F.when(slug != "", F.struct(F.lit(board).alias("board"), slug.alias("slug"))).otherwise(none)
    none = F.struct(F.lit("").alias("board"), F.lit("").alias("slug"))
    site = F.when(F.lower(first).rlike("^[a-z]{2}-[a-z]{2}$") & (second != ""), second).otherwise(first)
    workday = F.when((site != "") & ~F.lower(site).isin(*NON_SLUGS), F.concat(h, F.lit("/wday/cxs/"), F.regexp_extract(h, WORKDAY_HOST, 1), F.lit("/"), site)).otherwise("")
    oracle = _after(parts, "sites")
    out = (
        F.when(h.rlike(WORKDAY_HOST), is_("Workday", workday))
        .when(h.rlike(r"^[a-z0-9-]+\.eightfold\.ai$"), is_("Eightfold", F.regexp_extract(h, r"^([a-z0-9-]+)\.", 1)))
        .when(h.endswith(".icims.com"), is_("iCIMS", h))
        .when(h.contains("oraclecloud.com"), is_("Oracle", F.when(oracle != "", F.concat(h, F.lit("|"), oracle)).otherwise("")))
        .when(h == "myjobs.adp.com", is_("ADP", F.lower(first)))
        .when(h.rlike(r"^[a-z0-9-]+\.bamboohr\.com$"), is_("BambooHR", F.regexp_extract(h, r"^([a-z0-9-]+)\.", 1)))
        .otherwise(none)
    )
    for board, pattern in reversed(HOST_BOARDS):
        slug = F.regexp_extract(h, pattern, 1)
        out = F.when(h.rlike(pattern), is_(board, F.when(slug != "www", slug).otherwise(""))).otherwise(out)
    for board, pattern, routed in reversed(PATH_BOARDS):
        slug = F.when(F.lower(first).isin(*NON_SLUGS), "").otherwise(F.lower(first)) if routed else F.lower(first)
        out = F.when(h.rlike(pattern), is_(board, slug)).otherwise(out)
    return out


#: Query parameters that two reports take for tracking, besides utm_*; the second report knows one more (fixed values).
REPORT_TRACKING = ("gh_src", "lever-source", "source", "ref", "referrer")


def report_link(link: Column, more: tuple[str, ...] = ()) -> Column:
    """Host without www, path without final slash, query in its order without tracking; a scheme is supplied where there is none."""
    t = F.trim(text(link))
    full = F.when(t.contains("://"), t).otherwise(F.concat(F.lit("https://"), t))
    kept = F.filter(F.split(query(full), "&"), lambda p: (p != "") & ~F.lower(F.substring_index(p, "=", 1)).rlike(rf"^(?:utm_.*|{'|'.join(REPORT_TRACKING + more)})$"))
    tail = F.array_join(kept, "&")
    return F.when(t == "", "").otherwise(
        F.concat(F.regexp_replace(host(full), r"^www\.", ""), F.regexp_replace(path(full), "/+$", ""), F.when(tail != "", F.concat(F.lit("?"), tail)).otherwise(""))
    )
