"""Scalar functions over the driver tables and over literal rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmill.functions import classify as C
from feedmill.functions import dates as D
from feedmill.functions import geo as G
from feedmill.functions import money as M
from feedmill.functions import text as T
from feedmill.functions import url as U
from feedmill.plans.registry import Tables, query, values

AS_OF = "2024-02-01 12:00:00"


def _as_of():
    return F.lit(AS_OF).cast("timestamp")


@query(r"""SELECT doc_id, regexp_matches(text, '\b(?:idiot|clown|license)\b|\bthe\w*', 'i') AS any_term, regexp_matches(text, '(^|[^a-z])of([^a-z]|$)', 'i') AS whole FROM documents""")
def regex_terms(t: Tables) -> DataFrame:
    return t.documents.select(
        "doc_id", C.matches(F.col("text"), r"\b(?:idiot|clown|license)\b|\bthe\w*").alias("any_term"), C.matches(F.col("text"), "(^|[^a-z])of([^a-z]|$)").alias("whole")
    )


@query(r"""SELECT doc_id, regexp_matches(text, '^[\x00-\x7F]*$') AS ascii_only, NOT regexp_matches(text, '[\x{80}-\x{FF}]') AS no_latin1 FROM documents""")
def ascii_only(t: Tables) -> DataFrame:
    """Two predicates that differ beyond U+00FF."""
    return t.documents.select("doc_id", T.is_ascii(F.col("text")).alias("ascii_only"), T.no_latin1(F.col("text")).alias("no_latin1"))


TITLES = [
    (1, "Software Engineer Intern"), (2, "Senior Data Scientist"), (3, "Senior Software Engineer Intern"), (4, "New Grad Quant Trader"), (5, "Internal Audit Intern"),
    (6, "Junior Nurse"), (7, "Co-op, Firmware"), (8, "Entry Level Accountant"), (9, "Campus Recruiter"), (10, "Chef"), (11, None), (12, "Undergraduate Research Assistant"),
]
_SENIOR = r"regexp_matches(title, '\bsenior\s', 'i') AND NOT regexp_matches(title, '\bsenior\s.*(intern|co-op|apprentice|trainee)', 'i')"
_BAD = r"(regexp_matches(title, '\binternal (only|audit|security|medicine)\b', 'i') OR (" + _SENIOR + "))"
_INTERN = f"regexp_matches(title, '{C.INTERN_RE}', 'i')"
_GRAD = f"regexp_matches(title, '{C.NEWGRAD_RE}', 'i')"


@query(f"""SELECT id, CASE WHEN title IS NULL THEN 'other' WHEN {_INTERN} AND NOT {_BAD} THEN 'internship' WHEN {_GRAD} AND NOT {_BAD} THEN 'new_grad' ELSE 'other' END AS job_type,
  CASE WHEN title IS NULL THEN 'other' WHEN {_GRAD} AND NOT {_BAD} THEN 'new_grad' WHEN {_INTERN} AND NOT {_BAD} THEN 'internship' ELSE 'other' END AS source_type FROM {values(TITLES, 'id, title')}""")
def job_type_labels(t: Tables) -> DataFrame:
    """The base query's label and the fetched sources' label, which rank differently."""
    return t.inline(TITLES, "id int, title string").select("id", C.job_type(F.col("title")).alias("job_type"), C.job_type_of_source(F.col("title"), F.lit("")).alias("source_type"))


PART_CATEGORIES = {"Metal": ("tin", "copper", "steel", "brass", "nickel"), "Small": ("small", "mini"), "Standard": ("standard", "economy")}


def _category_sql(column: str) -> str:
    cases = " ".join(f"WHEN regexp_matches(lower({column}), '{'|'.join(C.keyword_pattern(k) for k in w)}') THEN '{n}'" for n, w in PART_CATEGORIES.items())
    return f"CASE {cases} ELSE 'Other' END"


@query(f"SELECT p_partkey, {_category_sql('p_name')} AS by_name, {_category_sql('p_type')} AS by_type FROM part")
def ordered_category(t: Tables) -> DataFrame:
    """First category with a keyword that fits: short words whole, longer ones at a word's start."""
    return t.part.select("p_partkey", C.category(F.col("p_name"), PART_CATEGORIES).alias("by_name"), C.category(F.col("p_type"), PART_CATEGORIES).alias("by_type"))


@query(r"""
WITH p AS (SELECT page_id, url, regexp_replace(lower(regexp_extract(url, '^https?://([^/?#]+)', 1)), '^www\.', '') AS h,
  regexp_replace(regexp_extract(url, '^https?://[^/?#]+([^?#]*)', 1), '/+$', '') AS path, regexp_extract(url, '\?([^#]*)', 1) AS q FROM pages),
k AS (SELECT *, array_to_string(list_sort(list_filter(string_split(q, '&'), lambda x: x <> '' AND NOT starts_with(lower(x), 'utm_') AND lower(split_part(x, '=', 1)) NOT IN ('ref', 'source', 'in_iframe'))), '&') AS kept FROM p)
SELECT page_id, CASE WHEN h = '' THEN '' ELSE h || path || CASE WHEN kept <> '' THEN '?' || kept ELSE '' END END AS canonical FROM k""")
def canonical_url(t: Tables) -> DataFrame:
    return t.pages.select("page_id", U.canonical(F.col("url")).alias("canonical"))


@query(r"""SELECT page_id, lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)', 1)) AS host, regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS path,
  regexp_extract(url, '^[^?#]*\?([^#]*)', 1) AS query FROM pages""")
def link_host_path(t: Tables) -> DataFrame:
    c = F.col("url")
    return t.pages.select("page_id", U.host(c).alias("host"), U.path(c).alias("path"), U.query(c).alias("query"))


@query(r"""
SELECT page_id, CASE WHEN len(list_intersect(string_split(lower(regexp_extract(l, '^https://([^/]*)', 1)), '.'), ['dice', 'indeed', 'monster', 'builtin'])) > 0 OR NOT starts_with(l, 'https://') THEN '' ELSE l END AS link
FROM (SELECT page_id, regexp_replace(regexp_replace(CASE WHEN starts_with(url, 'http://') THEN 'https://' || url[8:] ELSE url END, '[?&](utm_\w+|ref)=[^&#]*', '', 'g'), '[?&]$', '') AS l FROM pages)""")
def display_link(t: Tables) -> DataFrame:
    return t.pages.select("page_id", U.display(F.col("url")).alias("link"))


LINKS = [
    (1, "https://boards.greenhouse.io/acme/jobs/4012345?gh_src=x"), (2, "https://jobs.lever.co/acme/2f1c3a4e-1111-2222-3333-444455556666"), (3, "https://jobs.lever.co/acme/apply"),
    (4, "https://acme.wd5.myworkdayjobs.com/en-US/site/job/Austin/Tech-Lead_R12345"), (5, "https://careers-stifel.icims.com/jobs/10863/analyst/job"), (6, "https://example.com/jobs/4012345"),
    (7, None), (8, "https://apply.workable.com/acme/j/ABCDEF1234/"), (9, "https://jobs.smartrecruiters.com/Acme/743999123456-engineer"), (10, "https://acme.bamboohr.com/careers/42"),
]


@query(r"WITH l AS (SELECT id, coalesce(link, '') AS u FROM " + values(LINKS, "id, link") + r"""),
p AS (SELECT id, lower(regexp_extract(u, '^https?://([^/?#]*)', 1)) AS h, regexp_extract(u, '^https?://[^/?#]*([^?#]*)', 1) AS path FROM l),
x AS (SELECT *, CASE
  WHEN h LIKE '%greenhouse.io' THEN ['greenhouse', regexp_extract(path, '/jobs/([0-9]{5,})(/|$)', 1)]
  WHEN h LIKE '%lever.co' THEN ['lever', regexp_extract(path, '/([0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12})/?$', 1)]
  WHEN h LIKE '%workable.com' THEN ['workable', regexp_extract(path, '/j/([A-Za-z0-9]{6,})(/|$)', 1)]
  WHEN h LIKE '%myworkdayjobs.com' AND regexp_matches(path, '_[A-Za-z]{1,4}-?[0-9]{3,}$') THEN ['workday', split_part(h, '.', 1) || '/' || regexp_extract(path, '_([A-Za-z]{1,4}-?[0-9]{3,})$', 1)]
  WHEN h LIKE '%icims.com' THEN ['icims', regexp_replace(split_part(h, '.', 1), '^careers-', '') || '/' || regexp_extract(path, '/jobs/([0-9]+)', 1)]
  WHEN h LIKE '%smartrecruiters.com' THEN ['smartrecruiters', regexp_extract(path, '/([0-9]{6,})[^/]*$', 1)]
  WHEN h LIKE '%bamboohr.com' THEN ['bamboohr', split_part(h, '.', 1) || '/' || regexp_extract(path, '/careers/([^/]+)', 1)] ELSE ['', ''] END AS v FROM p)
SELECT id, CASE WHEN v[2] <> '' THEN v[1] ELSE '' END AS kind, v[2] AS ident FROM x""")
def url_identity(t: Tables) -> DataFrame:
    got = t.inline(LINKS, "id int, link string").select("id", U.infer_identity(F.col("link")).alias("x"))
    return got.select("id", "x.kind", F.col("x.id").alias("ident"))


@query("""SELECT page_id, 'u:' || substr(sha1(lower(trim(url))), 1, 16) AS serving, CASE WHEN page_id % 2 = 0 THEN 'site:' || page_id ELSE 'u:' || substr(sha1(lower(trim(url))), 1, 16) END AS mixed FROM pages""")
def serving_ids(t: Tables) -> DataFrame:
    none = F.lit("")
    kind = F.when(F.col("page_id") % 2 == 0, "site").otherwise("")
    return t.pages.select("page_id", U.serving_id(none, none, F.col("url")).alias("serving"), U.serving_id(kind, F.col("page_id").cast("string"), F.col("url")).alias("mixed"))


AGES = [(1, "2d"), (2, "3mo"), (3, "1y"), (4, "5h"), (5, "7m"), (6, "2w"), (7, "today"), (8, "2024-01-15"), (9, "-"), (10, None), (11, "junk")]


@query(f"""
SELECT id, CASE id WHEN 1 THEN TIMESTAMP '2024-01-30 12:00:00' WHEN 2 THEN TIMESTAMP '{AS_OF}' - INTERVAL 90 DAY WHEN 3 THEN TIMESTAMP '{AS_OF}' - INTERVAL 365 DAY
  WHEN 4 THEN TIMESTAMP '{AS_OF}' - INTERVAL 5 HOUR WHEN 5 THEN TIMESTAMP '{AS_OF}' - INTERVAL 7 MINUTE WHEN 6 THEN TIMESTAMP '{AS_OF}' - INTERVAL 14 DAY
  WHEN 7 THEN TIMESTAMP '2024-02-01 00:00:00' WHEN 8 THEN TIMESTAMP '2024-01-15 00:00:00' END AS at FROM {values(AGES, 'id, cell')}""")
def list_ages(t: Tables) -> DataFrame:
    return t.inline(AGES, "id int, cell string").select("id", D.list_age(F.col("cell"), _as_of()).alias("at"))


@query(f"""
SELECT event_id, CASE WHEN d = 0 THEN 'Today' WHEN d > 30 THEN (d // 30)::VARCHAR || 'mo' ELSE d::VARCHAR || 'd' END AS age, d AS days
FROM (SELECT event_id, greatest((floor(date_diff('second', ts, TIMESTAMP '{AS_OF}') / 86400.0))::BIGINT, 0) AS d FROM events)""")
def relative_age(t: Tables) -> DataFrame:
    return t.events.select("event_id", D.age_label(F.col("ts"), _as_of()).alias("age"), F.greatest(D.days_old(F.col("ts"), _as_of()), F.lit(0)).cast("bigint").alias("days"))


DATES = [
    (1, "2024-01-05"), (2, "2024-01-05T10:11:12Z"), (3, "2024-01-05T10:11:12+02:00"), (4, "2024-01-05 10:11:12"), (5, "1704449472"), (6, "1704449472000"), (7, "Jan 5, 2024"), (8, "soon"), (9, None),
]


@query(f"""
SELECT id, CASE WHEN id IN (1, 7) THEN TIMESTAMP '2024-01-05 00:00:00' WHEN id IN (2, 4, 5, 6) THEN TIMESTAMP '2024-01-05 10:11:12' WHEN id = 3 THEN TIMESTAMP '2024-01-05 08:11:12' END AS at FROM {values(DATES, 'id, d')}""")
def mixed_dates(t: Tables) -> DataFrame:
    return t.inline(DATES, "id int, d string").select("id", D.parse(F.col("d")).alias("at"))


MONEY = [
    (1, "$85,000"), (2, "85,000.50"), (3, "USD 120000"), (4, "85k"), (5, "80000-90000"), (6, ""), (7, "DOE"), (8, None), (9, "-5"), (10, "true"), (11, "90.5"), (12, "nan"), (13, "1e5"), (14, "0"),
]


@query(f"""
SELECT id, CASE WHEN v > 0 THEN v END AS salary FROM (SELECT id, CASE WHEN x IS NULL OR lower(trim(x)) IN ('', 'nan', 'true', 'false', '-') THEN NULL ELSE
  coalesce(try_cast(trim(x) AS DOUBLE), try_cast(nullif(regexp_extract(x, '([0-9]+(\\.[0-9]+)?)\\s*[kK]\\b', 1), '') AS DOUBLE) * 1000,
  try_cast(replace(nullif(regexp_extract(x, '(-?[0-9][0-9,]*(\\.[0-9]+)?)', 1), ''), ',', '') AS DOUBLE)) END AS v FROM {values(MONEY, 'id, x')})""")
def money_parse(t: Tables) -> DataFrame:
    return t.inline(MONEY, "id int, x string").select("id", M.coerce(F.col("x")).alias("salary"))


@query("""SELECT event_id, try_cast(json_extract_string(props, '$.k') AS BIGINT) AS k, json_extract_string(props, '$.missing') AS missing FROM events""")
def json_props(t: Tables) -> DataFrame:
    return t.events.select("event_id", F.get_json_object("props", "$.k").try_cast("bigint").alias("k"), F.get_json_object("props", "$.missing").alias("missing"))


@query("""SELECT l_orderkey, l_linenumber, CASE WHEN l_discount = 0 THEN NULL ELSE round(l_extendedprice / l_discount, 2) END::DOUBLE AS ratio FROM lineitem""")
def json_safe(t: Tables) -> DataFrame:
    """Division by nothing is null, never an infinity."""
    ratio = M.finite(F.col("l_extendedprice") / F.nullif(F.col("l_discount"), F.lit(0.0)))
    return t.lineitem.select("l_orderkey", "l_linenumber", F.round(ratio, 2).alias("ratio"))


PLACES = [
    (1, "Austin, TX"), (2, "Toronto, ON"), (3, "Berlin, Germany"), (4, "Remote in USA"), (5, "Perth, WA"), (6, ""), (7, "South Korea"), (8, "Nowhere"), (9, "Hong Kong, China"), (10, "Musée, fr"),
]
_HOME = list(G.US_STATES + G.US_TERRITORIES)
_RANKED = sorted(G.COUNTRIES.items(), key=lambda x: -len(x[0]))


@query(f"""
WITH p AS (SELECT id, lower(trim(x)) AS l, list_filter(string_split(upper(replace(lower(trim(x)), ',', ' ')), ' '), lambda w: w <> '') AS tok FROM {values(PLACES, 'id, x')}),
s AS (SELECT *, list_filter(tok, lambda w: list_contains({_HOME}, w) OR list_contains({[p for p in G.CA_PROVINCES if p not in G.AU_STATES]}, w))[1] AS first FROM p)
SELECT id, CASE {' '.join(f"WHEN contains(l, '{n}') THEN '{c}'" for n, c in _RANKED)} WHEN list_contains({_HOME}, first) THEN 'US' WHEN first IS NOT NULL THEN 'CA' ELSE '' END AS loose,
 CASE {' '.join(f"WHEN regexp_matches(l, '(^|[^a-z]){n.replace('.', chr(92) + '.')}([^a-z]|$)') THEN '{c}'" for n, c in _RANKED)} WHEN list_contains({_HOME}, first) THEN 'US' WHEN first IS NOT NULL THEN 'CA' ELSE '' END AS strict FROM s""")
def infer_country(t: Tables) -> DataFrame:
    """Names inside words count in the loose rule and not in the strict one."""
    c = F.col("x")
    return t.inline(PLACES, "id int, x string").select("id", G.infer_country(c).alias("loose"), G.infer_country(c, True).alias("strict"))


@query("""SELECT c_custkey, lower(regexp_replace(c_name, '[^A-Za-z0-9]', '', 'g')) AS key, regexp_replace(lower(trim(c_name)), '[^a-z0-9]+', '-', 'g') AS slug FROM customer""")
def employer_key(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", T.employer_key(F.col("c_name")).alias("key"), T.slug(F.col("c_name")).alias("slug"))


_LEVELS = ", ".join(f"'{w}'" for w in T.LEVEL_WORDS)


@query(f"""SELECT p_partkey, list_sort(list_distinct(list_filter(regexp_extract_all(lower(p_name), '[a-z0-9]+'), lambda x: len(x) > 1 AND x NOT IN ({_LEVELS})))) AS tokens, regexp_replace(lower(p_name), '[^a-z0-9]+', '', 'g') AS loose FROM part""")
def role_tokens(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", F.array_sort(T.role_tokens(F.col("p_name"))).alias("tokens"), T.loose_title(F.col("p_name")).alias("loose"))


@query("""SELECT doc_id, CASE WHEN length(trim(text)) > 48 THEN substr(trim(text), 1, 45) || '...' ELSE trim(text) END AS shown FROM documents""")
def truncated_title(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", T.truncate(F.col("text"), 48).alias("shown"))


@query("""SELECT o_orderkey, epoch(o_orderdate)::BIGINT AS s, epoch_ms(o_orderdate)::BIGINT AS ms, round(date_diff('microsecond', o_orderdate, TIMESTAMP '2002-01-01 06:00:00') / 3600000000.0::DOUBLE, 2)::DOUBLE AS hours FROM orders""")
def epochs(t: Tables) -> DataFrame:
    at = F.col("o_orderdate").cast("timestamp")
    return t.orders.select("o_orderkey", F.unix_timestamp(at).alias("s"), F.unix_millis(at).alias("ms"), D.hours_old(at, F.lit("2002-01-01 06:00:00").cast("timestamp")).alias("hours"))


@query("""SELECT l_orderkey, list_min(list_filter(list(floor(l_extendedprice / 100)::BIGINT), lambda x: x <> 0)) AS low, list_max(list_filter(list(floor(l_extendedprice / 100)::BIGINT), lambda x: x <> 0)) AS high FROM lineitem GROUP BY 1""")
def pay_range(t: Tables) -> DataFrame:
    """Brackets of several ranges: least of the minima, largest of the maxima."""
    unit = F.floor(F.col("l_extendedprice") / 100).cast("bigint")
    return t.lineitem.groupBy("l_orderkey").agg(F.min(F.when(unit != 0, unit)).alias("low"), F.max(F.when(unit != 0, unit)).alias("high"))
