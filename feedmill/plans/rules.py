"""Names, titles, links and places.  Inputs are composed of table columns by a SQL text that both engines run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmill.functions import classify as C
from feedmill.functions import dates as D
from feedmill.functions import geo as G
from feedmill.functions import money as M
from feedmill.functions import names as N
from feedmill.functions import shapes as S
from feedmill.functions import text as T
from feedmill.functions import url as U
from feedmill.operators import dedup
from feedmill.plans.registry import Tables, query
from feedmill.runtime import settled


def picked(rows: list[str], name: str = "w") -> str:
    """A table (i, name) of numbered texts, for choosing one by a remainder."""
    return "(VALUES " + ", ".join(f"({i}, '" + x.replace("'", "''") + "')" for i, x in enumerate(rows)) + f") AS t_{name}(i, {name})"


KEYWORDS = [k for words in C.CATEGORIES.values() for k in words]
LEADS = ["", "Senior ", "Junior ", "Staff ", "City of Austin ", "internal audit ", "Mobile "]
TAILS = ["", " Intern", " Co-op", ", New Grad", " Internship", " and Sales", " Engineer", " Project Manager", " Apprenticeship", " ai research"]
KINDS = ["", "internship", "full_time", "new_grad"]
TITLES = f"""SELECT o_orderkey AS id, lead.lead || core.core || tail.tail AS title, kind.kind AS kind FROM orders
JOIN (SELECT i, lead FROM {picked(LEADS, 'lead')}) AS lead ON lead.i = o_orderkey % {len(LEADS)}
JOIN (SELECT i, core FROM {picked(KEYWORDS, 'core')}) AS core ON core.i = (o_orderkey * 7 + o_custkey) % {len(KEYWORDS)}
JOIN (SELECT i, tail FROM {picked(TAILS, 'tail')}) AS tail ON tail.i = o_custkey % {len(TAILS)}
JOIN (SELECT i, kind FROM {picked(KINDS, 'kind')}) AS kind ON kind.i = (o_custkey + o_orderkey) % {len(KINDS)}"""


def _re2(pattern: str) -> str:
    """Without the look-ahead that ends a pattern: a match is one with or without it."""
    return pattern.replace("(?=", "(?:").replace("'", "''")


_HITS = ", ".join(
    "struct_pack(name := '" + name + "', hits := list_filter([" + ", ".join(f"CASE WHEN regexp_matches(low, '{C.keyword_pattern(k)}') THEN '{k}' END" for k in words) + "], lambda x: x IS NOT NULL))"
    for name, words in C.CATEGORIES.items()
)
_OF = lambda i: "CASE first.name " + " ".join(f"WHEN '{n}' THEN '{pair[i]}'" for n, pair in C.FAMILIES.items()) + f" ELSE '{C.FALLBACK[i]}' END"
_CROSS = ", ".join(f"CASE WHEN regexp_matches(low, '{'|'.join(terms)}') THEN '{n}' END" for n, terms in C.CROSS_FAMILIES)


@query(f"""
WITH titles AS ({TITLES}), l AS (SELECT id, lower(trim(title)) AS low FROM titles),
h AS (SELECT *, list_filter([{_HITS}], lambda x: len(x.hits) > 0) AS found, regexp_extract(low, '{C.GOVERNMENT_PATTERN}', 0) AS pub, regexp_extract(low, '{C.OPERATIONS_PATTERN}', 0) AS ops,
  list_filter([{_CROSS}], lambda x: x IS NOT NULL) AS others FROM l),
k AS (SELECT *, found[1] AS first, CASE WHEN low = '' THEN 'none' WHEN pub <> '' THEN 'pub' WHEN ops <> '' THEN 'ops' WHEN len(found) > 0 THEN 'hit' ELSE 'none' END AS kind FROM h),
f AS (SELECT *, CASE kind WHEN 'pub' THEN 'Government & Public Service' WHEN 'ops' THEN 'Operations & Project Management' WHEN 'hit' THEN {_OF(0)} ELSE '{C.FALLBACK[0]}' END AS family FROM k)
SELECT id, family, CASE kind WHEN 'pub' THEN 'Government/Public Service' WHEN 'ops' THEN 'Operations/Supply' WHEN 'hit' THEN first.name ELSE 'Other' END AS category,
  CASE kind WHEN 'pub' THEN 'Public Sector' WHEN 'ops' THEN 'Operations' WHEN 'hit' THEN {_OF(1)} ELSE '{C.FALLBACK[1]}' END AS industry,
  CASE WHEN kind = 'none' THEN family ELSE array_to_string(list_concat([family], list_filter(others, lambda x: x <> family)[1:1]), '|') END AS families,
  CASE kind WHEN 'pub' THEN 'high' WHEN 'ops' THEN CASE WHEN len(list_filter(found, lambda x: x.name = 'Operations/Supply')) > 0 THEN 'high' ELSE 'medium' END
    WHEN 'hit' THEN CASE WHEN len(found) > 1 OR len(first.hits) > 1 THEN 'high' ELSE 'medium' END ELSE 'low' END AS confidence,
  CASE kind WHEN 'pub' THEN 'government:' || trim(pub) WHEN 'ops' THEN 'operations:' || trim(ops) WHEN 'hit' THEN first.name || ':' || array_to_string(first.hits[1:3], ', ')
    ELSE CASE WHEN low = '' THEN 'empty_title' ELSE 'no_keyword_match' END END AS reason FROM f""")
def title_families(t: Tables) -> DataFrame:
    """Family, industry, category and confidence of titles over the whole vocabulary."""
    got = C.with_taxonomy(t.sql(TITLES, "orders").select("id", "title"), "title")
    return got.select("id", "family", "category", "industry", F.array_join("families", "|").alias("families"), "confidence", "reason")


@query(f"""
WITH titles AS ({TITLES}), l AS (SELECT id, lower(trim(title)) AS low FROM titles),
h AS (SELECT id, list_filter([{", ".join(f"CASE WHEN regexp_matches(low, '{'|'.join(C.keyword_pattern(k) for k in w)}') THEN '{n}' END" for n, w in C.CATEGORIES.items())}], lambda x: x IS NOT NULL)[1] AS c FROM l)
SELECT id, coalesce(c, 'Other') AS category FROM h""")
def title_categories(t: Tables) -> DataFrame:
    """First of the twenty categories with a keyword that fits."""
    return t.sql(TITLES, "orders").select("id", C.category(F.col("title")).alias("category"))


_STRICT = rf"\b(?:{'|'.join(C.STRICT_ANCHORS)})\b|\b(?:ai|ml)\b[^,]{{0,24}}\b(?:{'|'.join(C.STRICT_NEARBY)})\b|\bresearch (?:engineer|intern|scientist)\b"


@query(f"""WITH titles AS ({TITLES}) SELECT id, regexp_matches(lower(title), '{"|".join(C.TECH_TERMS)}') AS technical, regexp_matches(lower(title), '{_STRICT}') AS strictly FROM titles""")
def technical_titles(t: Tables) -> DataFrame:
    """The keyword gate and the narrow gate of titles."""
    return t.sql(TITLES, "orders").select("id", C.is_technical(F.col("title")).alias("technical"), C.is_strictly_technical(F.col("title")).alias("strictly"))


@query(f"""
WITH titles AS ({TITLES}), e AS (SELECT *, trim(title) AS t, regexp_matches(title, '{C.INTERN_RE}|{C.NEWGRAD_RE}|{C.EARLY_EXTRA_PATTERN}', 'i') AS early, lower(trim(kind)) IN {C.ELIGIBLE_TYPES} AS typed FROM titles),
r AS (SELECT id, CASE WHEN t = '' THEN 'empty_title' WHEN regexp_matches(t, '{C.NON_CAREER_PATTERN}', 'i') THEN 'non_career_title'
  WHEN typed AND regexp_matches(t, '{C.SENIOR_PATTERN}', 'i') AND NOT early THEN 'seniority_mismatch' WHEN typed OR early THEN 'early_career_title' ELSE 'not_early_career' END AS reason FROM e)
SELECT id, reason = 'early_career_title' AS eligible, reason FROM r""")
def title_eligibility(t: Tables) -> DataFrame:
    got = t.sql(TITLES, "orders").select("id", C.eligibility(F.col("title"), F.col("kind")).alias("x"))
    return got.select("id", "x.eligible", "x.reason")


@query(f"""
WITH titles AS ({TITLES}), m AS (SELECT *, regexp_matches(title, '{C.INTERN_RE}', 'i') AS intern, regexp_matches(title, '{C.NEWGRAD_RE}', 'i') AS grad,
  regexp_matches(title, '\\binternal (only|audit|security|medicine)\\b', 'i') OR (regexp_matches(title, '\\bsenior\\s', 'i') AND NOT regexp_matches(title, '\\bsenior\\s.*(intern|co-op|apprentice|trainee)', 'i')) AS bad FROM titles)
SELECT id, CASE WHEN intern AND NOT bad THEN 'internship' WHEN grad AND NOT bad THEN 'new_grad' ELSE 'other' END AS job_type,
  CASE WHEN (grad OR regexp_matches(kind, 'new.?grad|entry')) AND NOT bad THEN 'new_grad' WHEN (intern OR contains(kind, 'intern')) AND NOT bad THEN 'internship' ELSE 'other' END AS source_type FROM m""")
def job_types(t: Tables) -> DataFrame:
    """The base query's label and the fetched sources' label, which rank differently."""
    return t.sql(TITLES, "orders").select("id", C.job_type(F.col("title")).alias("job_type"), C.job_type_of_source(F.col("title"), F.col("kind")).alias("source_type"))


STEMS = ["acme", "Blue River", "NORTH WIND", "zeta", "McAllister", "globex", "umbra"]
WORDS = ["", "industries", "healthcare", "university", "consulting", "usa"]
LEGAL = ["", "inc", "llc", "careers"]
SLUGS = f"""SELECT c_custkey AS id, lower(replace(stem.stem, ' ', '')) || word.word || legal.legal AS slug, stem.stem AS stem, word.word AS word, legal.legal AS legal FROM customer
JOIN (SELECT i, stem FROM {picked(STEMS, 'stem')}) AS stem ON stem.i = c_custkey % {len(STEMS)}
JOIN (SELECT i, word FROM {picked(WORDS, 'word')}) AS word ON word.i = c_nationkey % {len(WORDS)}
JOIN (SELECT i, legal FROM {picked(LEGAL, 'legal')}) AS legal ON legal.i = (c_custkey + c_nationkey) % {len(LEGAL)}"""


@query(f"""
WITH s AS ({SLUGS}), b AS (SELECT *, lower(replace(stem, ' ', '')) AS base, CASE WHEN word = 'usa' THEN 'USA' WHEN word = '' THEN '' ELSE upper(word[1]) || word[2:] END AS shown FROM s)
SELECT id, CASE WHEN word = '' AND legal = '' THEN base ELSE upper(base[1]) || base[2:] || CASE WHEN word = '' THEN '' ELSE ' ' || shown END END AS display,
  CASE WHEN word = '' AND legal = '' THEN 'unrecognized concatenation' WHEN legal <> '' THEN 'trimmed board/legal suffix' ELSE 'split corporate descriptor' END AS reason,
  CASE WHEN word = '' AND legal = '' THEN 'unchanged' ELSE 'derived' END AS confidence, base || word AS key, '' AS domain FROM b""")
def slug_employers(t: Tables) -> DataFrame:
    """Names written without spaces, split on the closed vocabulary."""
    got = settled(t.sql(SLUGS, "customer").select("id", N.employer(F.col("slug")).alias("x")), ["x"])
    return got.select("id", "x.display", "x.reason", "x.confidence", "x.key", "x.domain")


CASED = f"""SELECT c_custkey AS id, CASE c_nationkey % 4 WHEN 0 THEN upper('bank of ' || stem.stem || ' ibm') WHEN 1 THEN lower('the house of ' || stem.stem || ' it') WHEN 2 THEN 'Mixed ' || stem.stem || ' of x'
  ELSE CASE c_custkey % 3 WHEN 0 THEN 'about you gmbh' WHEN 1 THEN 'General  Delivery Hero'  ELSE '<b>Lila&nbsp;Sciences</b>' END END AS name, stem.stem AS stem, c_nationkey % 4 AS kind, c_custkey % 3 AS pick FROM customer
JOIN (SELECT i, stem FROM {picked(STEMS, 'stem')}) AS stem ON stem.i = c_custkey % {len(STEMS)}"""
_CAP = "array_to_string(list_transform(string_split(lower(stem), ' '), lambda w: upper(w[1]) || w[2:]), ' ')"
_SHOUT = "array_to_string(list_transform(string_split(upper(stem), ' '), lambda w: CASE WHEN len(w) <= 4 THEN w ELSE w[1] || lower(w[2:]) END), ' ')"


@query(f"""
WITH n AS ({CASED}), d AS (SELECT id, kind, pick, CASE kind WHEN 0 THEN 'BANK of ' || {_SHOUT} || ' IBM' WHEN 1 THEN 'The House of ' || {_CAP} || ' IT' WHEN 2 THEN 'Mixed ' || stem || ' of x'
  ELSE CASE pick WHEN 0 THEN 'ABOUT YOU' WHEN 1 THEN 'General Delivery Hero' ELSE 'Lila Sciences' END END AS display FROM n)
SELECT id, display, regexp_replace(lower(display), '[^a-z0-9]+', '', 'g') AS key, CASE WHEN kind = 3 AND pick = 0 THEN 'aboutyou.com' WHEN kind = 3 AND pick = 2 THEN 'lilasciences.com' ELSE '' END AS domain,
  CASE WHEN kind = 3 AND pick <> 1 THEN 'verified' WHEN kind IN (0, 1) THEN 'derived' ELSE 'unchanged' END AS confidence FROM d""")
def cased_employers(t: Tables) -> DataFrame:
    """Names of several words: verified spellings, repaired case, the rest as published."""
    got = settled(t.sql(CASED, "customer").select("id", N.employer(F.col("name")).alias("x")), ["x"])
    return got.select("id", "x.display", "x.key", "x.domain", "x.confidence")


@query(f"""
WITH s AS ({SLUGS}) SELECT id, CASE WHEN legal = 'careers' THEN stem ELSE stem END AS vendor, CASE WHEN word = '' THEN stem ELSE stem || ' ' || word END AS vendor_word FROM s""")
def vendor_employers(t: Tables) -> DataFrame:
    """Corporate endings and trailing points go from vendors' names."""
    rows = t.sql(SLUGS, "customer")
    ending = F.when(F.col("legal").isin("inc", "llc"), F.concat(F.lit(", "), F.initcap("legal"), F.lit("."))).otherwise(" Co")
    return rows.select(
        "id", N.vendor_employer(F.concat("stem", ending)).alias("vendor"), N.vendor_employer(F.concat(F.rtrim(F.concat_ws(" ", "stem", "word")), F.lit("  Ltd.,"))).alias("vendor_word")
    )


@query(f"""
WITH s AS ({SLUGS}), k AS (SELECT id, lower(stem) AS low, word, legal FROM s)
SELECT id, CASE WHEN word = '' THEN low ELSE low || ' ' || word END AS sponsor, replace(low, ' ', '') || word AS employer,
  array_to_string(list_transform(string_split(low, ' '), lambda w: CASE WHEN low = w AND len(low) <= 4 AND word = '' THEN upper(w) ELSE upper(w[1]) || w[2:] END), ' ')
    || CASE WHEN word = '' THEN '' ELSE ' ' || upper(word[1]) || word[2:] END AS shown FROM k""")
def sponsor_keys(t: Tables) -> DataFrame:
    """The sponsor's key, the employer's key and the shown name of one spelling."""
    rows = t.sql(SLUGS, "customer").withColumn("base", F.trim(F.concat_ws(" ", "stem", "word")))
    legal = F.when(F.col("legal").isin("inc", "llc"), F.concat(F.lit(", "), F.upper("legal"), F.lit("."))).otherwise("")
    return rows.select(
        "id", T.sponsor_key(F.concat("base", legal)).alias("sponsor"), T.employer_key(F.concat("base", legal)).alias("employer"), T.clean_company(F.concat("base", F.lit(" Careers"))).alias("shown")
    )


COMPANIES = f"""SELECT c_custkey AS id, stem.stem AS stem, CASE c_custkey % 6 WHEN 0 THEN 'https://x.example/' || c_custkey || ' ' || stem.stem || '42' WHEN 1 THEN 'careers.' || lower(replace(stem.stem, ' ', '-')) || '.co.uk'
  WHEN 2 THEN 'www.' || lower(replace(stem.stem, ' ', '-')) || '.com' WHEN 3 THEN 'abc.fa.us2.oraclecloud.com' WHEN 4 THEN stem.stem || ' &amp; Sons jobs' ELSE '' END AS raw, c_custkey % 6 AS kind FROM customer
JOIN (SELECT i, stem FROM {picked(STEMS, 'stem')}) AS stem ON stem.i = c_nationkey % {len(STEMS)}"""


@query(f"""
WITH c AS ({COMPANIES}), w AS (SELECT *, array_to_string(list_transform(string_split(lower(stem), ' '), lambda w: upper(w[1]) || w[2:]), ' ') AS cap FROM c)
SELECT id, CASE kind WHEN 0 THEN CASE WHEN len(stem) <= 4 THEN upper(stem) ELSE cap END WHEN 1 THEN cap WHEN 2 THEN cap WHEN 3 THEN 'Oracle Cloud' WHEN 4 THEN cap || ' Sons' ELSE '' END AS company FROM w""")
def clean_companies(t: Tables) -> DataFrame:
    """Employers out of domains, portals, links and board words."""
    return t.sql(COMPANIES, "customer").select("id", T.clean_company(F.col("raw")).alias("company"))


ROLES = f"""SELECT o_orderkey AS id, core.core AS core, o_orderkey % 5 AS kind, CASE o_orderkey % 5 WHEN 0 THEN '  - ' || core.core || ' | ' WHEN 1 THEN upper('senior ' || core.core || ' of the us, co-op ii') WHEN 2 THEN '<b>' || core.core || '</b>&amp;x|y'
  WHEN 3 THEN core.core || '   (2024) ' ELSE '' END AS raw FROM orders JOIN (SELECT i, core FROM {picked(["data entry", "welder", "pre-press lead", "nurse aide", "it support"], 'core')}) AS core ON core.i = o_custkey % 5"""


@query(f"""
WITH r AS ({ROLES}), w AS (SELECT *, array_to_string(list_transform(string_split(core, ' '), lambda w: CASE WHEN w = 'it' THEN 'IT' WHEN w = 'pre-press' THEN 'Pre-Press' ELSE upper(w[1]) || w[2:] END), ' ') AS cap FROM r)
SELECT id, CASE kind WHEN 0 THEN core WHEN 1 THEN 'Senior ' || cap || ' of the Us, Co-op II' WHEN 2 THEN core || ' &x | y' WHEN 3 THEN core || ' (2024)' ELSE '' END AS role FROM w""")
def clean_roles(t: Tables) -> DataFrame:
    """Titles without markup and dangling separators, re-cased if they shout."""
    return t.sql(ROLES, "orders").select("id", T.clean_role(F.col("raw")).alias("role"))


CITIES = ["Austin", "Toronto", "Paris", "Perth", "Oslo"]
REGIONS = ["tx", "on", "UNAVAILABLE", "WA", "no", "Remote"]
ENDS = ["", "us", "FR", "gb", "Zz"]
SPOTS = f"""SELECT c_custkey AS id, city.city AS city, region.region AS region, last.last AS last, city.city || ', ' || region.region || CASE WHEN last.last = '' THEN ' ,' ELSE ',' || last.last END AS raw FROM customer
JOIN (SELECT i, city FROM {picked(CITIES, 'city')}) AS city ON city.i = c_custkey % {len(CITIES)}
JOIN (SELECT i, region FROM {picked(REGIONS, 'region')}) AS region ON region.i = c_nationkey % {len(REGIONS)}
JOIN (SELECT i, last FROM {picked(ENDS, 'last')}) AS last ON last.i = (c_custkey * 3 + c_nationkey) % {len(ENDS)}"""


@query(f"""
WITH s AS ({SPOTS}), p AS (SELECT *, CASE region WHEN 'tx' THEN 'TX' WHEN 'on' THEN 'ON' WHEN 'no' THEN CASE WHEN last = '' THEN 'Norway' ELSE 'no' END WHEN 'UNAVAILABLE' THEN NULL ELSE region END AS mid,
  CASE last WHEN 'us' THEN 'States' WHEN 'FR' THEN 'France' WHEN 'gb' THEN 'Kingdom' WHEN '' THEN NULL ELSE last END AS tail FROM s),
l AS (SELECT id, list_filter([city, mid, tail], lambda x: x IS NOT NULL) AS parts FROM p)
SELECT id, array_to_string(parts, ', ') AS location, array_to_string(parts, '<br>') AS cell FROM l""")
def clean_locations(t: Tables) -> DataFrame:
    """Locations for display and as a table cell."""
    rows = t.sql(SPOTS, "customer").select("id", G.clean_location(F.col("raw")).alias("location"))
    return rows.withColumn("cell", T.location_cell(F.col("location")))


LOCATED = f"""SELECT c_custkey AS id, CASE c_custkey % 8 WHEN 0 THEN 'US' WHEN 1 THEN 'de' ELSE '' END AS iso, place.place AS place, role.role AS role FROM customer
JOIN (SELECT i, place FROM {picked(["Austin, TX", "London, UK", "Berlin", "", "Springfield", "Tampa, FL · Hanover, NJ · Cambridge, MA, US", "Remote", "Porto, ZZ", "Reno, NV | Lyon, FR", "new york or tokyo"], 'place')}) AS place ON place.i = c_nationkey % 10
JOIN (SELECT i, role FROM {picked(["Analyst", "Analyst Canada", "Remote analyst"], 'role')}) AS role ON role.i = c_custkey % 3"""


@query(f"""
WITH l AS ({LOCATED}), s AS (SELECT *, list_filter(list_transform(regexp_split_to_array(place, '[·|]| or '), lambda x: upper(regexp_extract(trim(x), ',\\s*([A-Za-z]{{2}})\\s*\\.?$', 1))),
   lambda x: x <> '' AND NOT list_contains({list(G.US_STATES + G.US_TERRITORIES + ("US",))}, x))[1] AS abroad, lower(place || ' ' || role) AS blob FROM l),
r AS (SELECT *, CASE WHEN iso <> '' THEN 'iso=' || upper(iso) WHEN list_contains({list(G.FOREIGN_CODES)}, abroad) THEN 'iso-token:' || abroad WHEN abroad IS NOT NULL THEN 'unknown-token:' || abroad
  WHEN regexp_matches(blob, '\\b({'|'.join(G.FOREIGN_NAMES + G.FOREIGN_CITIES)})\\b') THEN 'foreign'
  WHEN regexp_matches(blob, ',\\s*({'|'.join(x.lower() for x in G.US_STATES + G.US_TERRITORIES)})\\b|\\b(remote|united states|u\\.?s\\.?a\\.?|usa)\\b') THEN 'us-hint' WHEN trim(place) = '' THEN 'no-location' ELSE 'unknown-kept' END AS reason FROM s)
SELECT id, reason IN ('iso=US', 'us-hint', 'unknown-kept') AS keep, reason FROM r""")
def geography_backstop(t: Tables) -> DataFrame:
    """Keep or refuse by place, with the reason."""
    got = t.sql(LOCATED, "customer").select("id", G.american(F.col("iso"), F.col("place"), F.col("role")).alias("x"))
    return got.select("id", "x.keep", "x.reason")


ADDRESSES = f"""SELECT c_custkey AS id, country.country AS country FROM customer
JOIN (SELECT i, country FROM {picked(["us", "United States", "Deutschland", "Paris, France", "x; gb", "", " Canada ", "USA", "42"], 'country')}) AS country ON country.i = c_custkey % 9"""


@query(f"""
WITH a AS ({ADDRESSES}), p AS (SELECT *, trim(country) AS t, list_transform(string_split(replace(trim(country), ';', ','), ','), lambda x: trim(x)) AS parts FROM a)
SELECT id, coalesce(CASE WHEN regexp_matches(t, '^[A-Za-z]{{2}}$') THEN upper(t) END, map_extract_value(map({list(G.ADDRESS_COUNTRIES)}, {list(G.ADDRESS_COUNTRIES.values())}), lower(t)),
  list_filter(list_transform(parts, lambda x: CASE WHEN regexp_matches(x, '^[A-Za-z]{{2}}$') THEN upper(x) ELSE map_extract_value(map({list(G.ADDRESS_COUNTRIES)}, {list(G.ADDRESS_COUNTRIES.values())}), lower(x)) END), lambda x: x IS NOT NULL)[1], '') AS code FROM p""")
def country_codes(t: Tables) -> DataFrame:
    return t.sql(ADDRESSES, "customer").select("id", G.address_country(F.col("country")).alias("code"))


HOSTS = [
    "https://boards.greenhouse.io/Acme{n}/jobs/{n}", "https://jobs.eu.lever.co/Beta{n}/x", "https://jobs.ashbyhq.com/Gam{n}", "https://careers.smartrecruiters.com/Del{n}/1", "https://apply.workable.com/Eps{n}/j/1",
    "https://ats.rippling.com/Zet{n}/jobs", "https://Eta{n}.pinpointhq.com/", "https://the{n}.recruitee.com/o/x", "https://iot{n}.teamtailor.com/jobs", "https://kap{n}.breezy.hr/", "https://lam{n}.jobs.personio.de/job/1",
    "https://mu{n}.wd5.myworkdayjobs.com/en-US/Site{n}/job/Austin/Lead_R{n}345?x=1", "https://nu{n}.eightfold.ai/careers", "https://careers-xi{n}.icims.com/jobs/{n}/a/job", "https://omi{n}.fa.us2.oraclecloud.com/hcmUI/CandidateExperience/en/sites/CX_{n}/job/7",
    "https://myjobs.adp.com/Pi{n}/cx/job/1", "https://rho{n}.bamboohr.com/careers/{n}", "https://boards.greenhouse.io/jobs/{n}", "https://x.example/", "https://y{n}.example/jobs", "ftp://jobs.lever.co/a{n}", "https://www.recruitee.com/o/{n}",
]
LINKS = f"""SELECT c_custkey AS id, c_custkey % {len(HOSTS)} AS k, CAST(c_custkey AS STRING) AS n, replace(shape.shape, '{{n}}', CAST(c_custkey AS STRING)) AS link FROM customer
JOIN (SELECT i, shape FROM {picked(HOSTS, 'shape')}) AS shape ON shape.i = c_custkey % {len(HOSTS)}"""
_BOARDS = [
    ("Greenhouse", "'acme' || n"), ("Lever", "'beta' || n"), ("Ashby", "'gam' || n"), ("SmartRecruiters", "'del' || n"), ("Workable", "'eps' || n"), ("Rippling", "'zet' || n"), ("Pinpoint", "'eta' || n"), ("Recruitee", "'the' || n"),
    ("Teamtailor", "'iot' || n"), ("Breezy", "'kap' || n"), ("Personio", "'lam' || n"), ("Workday", "'mu' || n || '.wd5.myworkdayjobs.com/wday/cxs/mu' || n || '/Site' || n"), ("Eightfold", "'nu' || n"), ("iCIMS", "'careers-xi' || n || '.icims.com'"),
    ("Oracle", "'omi' || n || '.fa.us2.oraclecloud.com|CX_' || n"), ("ADP", "'pi' || n"), ("BambooHR", "'rho' || n"),
]
_LINKS_SQL = LINKS.replace("AS STRING", "AS VARCHAR")


@query(f"""
WITH l AS ({_LINKS_SQL}), p AS (SELECT *, regexp_replace(regexp_extract(link, '^[a-z]+://[^/]*([^?#]*)', 1), '/+$', '') AS path, lower(regexp_extract(link, '^[a-z]+://([^/?#]*)', 1)) AS host FROM l),
t AS (SELECT *, regexp_extract(path, '/([^/]+)$', 1) AS last FROM p)
SELECT id, CASE k {" ".join(f"WHEN {i} THEN '{b}'" for i, (b, _) in enumerate(_BOARDS))} ELSE '' END AS board, CASE k {" ".join(f"WHEN {i} THEN {slug}" for i, (_, slug) in enumerate(_BOARDS))} ELSE '' END AS slug,
  CASE WHEN last <> '' AND lower(last) NOT IN ('jobs', 'job', 'apply') THEN last END AS tail, CASE WHEN k = 11 AND id >= 10 THEN 'R' || n || '345' END AS req,
  coalesce(list_filter({list(S.SHARED_DOMAINS)}, lambda d: host = d OR ends_with(host, '.' || d))[1], host) AS provider FROM t""")
def board_links(t: Tables) -> DataFrame:
    """Board, slug, id and rate-limit key of links to seventeen vendors and to others."""
    c = F.col("link")
    got = t.sql(LINKS, "customer").withColumn("b", U.board_of(c))
    return got.select("id", "b.board", "b.slug", U.tail_id(c).alias("tail"), U.requisition_id(c).alias("req"), S.provider_key(U.host(c)).alias("provider"))


@query("""
WITH l AS (SELECT page_id, url, string_split(regexp_extract(url, '\\?([^#]*)', 1), '&') AS q, regexp_replace(lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)), '^www\\.', '') AS h, regexp_replace(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/+$', '') AS p FROM pages),
k AS (SELECT *, array_to_string(list_filter(q, lambda x: x <> '' AND NOT starts_with(lower(x), 'utm_') AND lower(split_part(x, '=', 1)) NOT IN ('gh_src', 'lever-source', 'source', 'ref', 'referrer')), '&') AS a,
  array_to_string(list_filter(q, lambda x: x <> '' AND NOT starts_with(lower(x), 'utm_') AND lower(split_part(x, '=', 1)) NOT IN ('gh_src', 'lever-source', 'source', 'ref', 'referrer', 'trk', 'page')), '&') AS b FROM l)
SELECT page_id, h || p || CASE WHEN a <> '' THEN '?' || a ELSE '' END AS yield_link, h || p || CASE WHEN b <> '' THEN '?' || b ELSE '' END AS other_link FROM k""")
def report_links(t: Tables) -> DataFrame:
    """Links as two reports compare them."""
    c = F.col("url")
    return t.pages.select("page_id", U.report_link(c).alias("yield_link"), U.report_link(F.regexp_replace(c, "^https://", ""), ("trk", "page")).alias("other_link"))


POSTINGS = f"""SELECT o_orderkey AS id, CASE o_orderkey % 4 WHEN 0 THEN 'Greenhouse' WHEN 1 THEN 'nan' ELSE '' END AS ats_type, CASE o_orderkey % 4 WHEN 0 THEN 'Id' || CAST(o_custkey AS STRING) WHEN 1 THEN 'x' ELSE '' END AS ats_id,
  CASE o_orderkey % 4 WHEN 0 THEN 'https://www.a.example/p/' || CAST(o_custkey AS STRING) WHEN 1 THEN 'https://jobs.smartrecruiters.com/Acme/' || CAST(700000 + o_custkey AS STRING) || '-x' WHEN 2 THEN 'https://www.B.example/p/' || CAST(o_custkey AS STRING) || '/?utm_source=x&b=2&a=1' ELSE 'mail' END AS link,
  'Acme, Inc.' AS company, '  Data   ENTRY ' || o_orderstatus AS role, 'Austin,  TX' AS location FROM orders"""
_POSTINGS_SQL = POSTINGS.replace("AS STRING", "AS VARCHAR")
_IDENT = """i AS (SELECT *, CASE id % 4 WHEN 0 THEN 'Greenhouse' WHEN 1 THEN 'smartrecruiters' ELSE '' END AS kind, CASE id % 4 WHEN 0 THEN ats_id WHEN 1 THEN regexp_extract(link, '/(\\d+)-x$', 1) ELSE '' END AS ident,
  CASE id % 4 WHEN 0 THEN 'a.example' || link[22:] WHEN 1 THEN link[9:] WHEN 2 THEN 'b.example' || regexp_extract(link, '(/p/\\d+)', 1) || '?a=1&b=2' ELSE '' END AS canon FROM p)"""


@query(f"""
WITH p AS ({_POSTINGS_SQL}), {_IDENT}
SELECT id, kind, ident, CASE WHEN kind <> '' THEN 'id|' || lower(kind) || '|' || ident WHEN canon <> '' THEN 'url|' || canon ELSE 'details|acme|data entry ' || lower(regexp_extract(role, '(\\S+)$', 1)) || '|austin, tx' END AS key,
  CASE WHEN kind <> '' THEN lower(kind || ':' || ident) WHEN canon <> '' THEN 'url:' || substr(sha1(canon), 1, 16) ELSE '' END AS feed_id,
  CASE WHEN kind <> '' THEN kind || ':' || ident ELSE 'u:' || substr(sha1(lower(link)), 1, 16) END AS serving_id FROM i""")
def identity_keys(t: Tables) -> DataFrame:
    """Identity filled from links, the deduplication key, and the two ids of a posting."""
    rows = dedup.filled_identity(t.sql(POSTINGS, "orders"))
    kind, ident, link = F.col("ats_type"), F.col("ats_id"), F.col("link")
    return rows.select(
        "id", kind.alias("kind"), ident.alias("ident"), dedup.identity_key(kind, ident, link, F.col("company"), F.col("role"), F.col("location")).alias("key"),
        U.feed_id(kind, ident, link).alias("feed_id"), U.serving_id(kind, ident, link).alias("serving_id"),
    )


@query(f"""WITH p AS ({_POSTINGS_SQL}), {_IDENT} SELECT count(*)::BIGINT AS rows, count(*) FILTER (WHERE kind <> '')::BIGINT AS identified, round(100.0::DOUBLE * count(*) FILTER (WHERE kind <> '') / count(*), 2)::DOUBLE AS pct FROM i""")
def identity_coverage(t: Tables) -> DataFrame:
    """Share of postings that carry an id, from their source or from the link."""
    return dedup.identity_coverage(t.sql(POSTINGS, "orders"))


@query("""SELECT o_orderkey, 'src' || o_custkey % 3 || '|Acme ' || o_custkey || '|Data-Entry ' || o_orderstatus || '|X|y' AS key, 'Acme ' || o_custkey || '|dataentry' || lower(o_orderstatus) AS pair FROM orders""")
def observation_keys(t: Tables) -> DataFrame:
    """The key of the observation log and the loose pair that a closure compares."""
    key = T.observation_key(F.concat(F.lit("src"), (F.col("o_custkey") % 3).cast("string")), F.concat(F.lit("acme "), F.col("o_custkey").cast("string"), F.lit("!")), F.concat(F.lit(" Data-Entry "), "o_orderstatus"), F.lit("X|y"), clean=False)
    shown = T.observation_key(F.concat(F.lit("src"), (F.col("o_custkey") % 3).cast("string")), F.concat(F.lit("Acme "), F.col("o_custkey").cast("string")), F.concat(F.lit(" Data-Entry "), "o_orderstatus"), F.lit("X|y"), clean=False)
    return t.orders.select("o_orderkey", shown.alias("key"), T.loose_pair(shown).alias("pair")).where(key.isNotNull())


TITLED = f"""SELECT o_orderkey AS id, 'Acme Labs' AS company, core.core AS core, o_orderkey % 6 AS kind, CASE o_orderkey % 6 WHEN 0 THEN core.core || ' - Acme Labs | Careers' WHEN 1 THEN core.core || ' at acme labs' WHEN 2 THEN 'Job Details' WHEN 3 THEN core.core || ' | Austin | Jobs'
  WHEN 4 THEN core.core || ' – Careers' ELSE '  ' || core.core || ' Job Details | Acme Labs ' END AS title FROM orders JOIN (SELECT i, core FROM {picked(["Welder", "Data Entry Clerk", "Nurse"], 'core')}) AS core ON core.i = o_custkey % 3"""


@query(f"""WITH t AS ({TITLED}) SELECT id, CASE kind WHEN 2 THEN '' ELSE core END AS role FROM t""")
def fallback_roles(t: Tables) -> DataFrame:
    """Roles out of page titles."""
    return t.sql(TITLED, "orders").select("id", T.fallback_role(F.col("title"), F.col("company")).alias("role"))


@query(r"""
SELECT page_id, md5(trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(html, '<br>|<br/>|</p>', chr(10), 'g'), '<[^>]+>', ' ', 'g'), '&nbsp;', ' '), '&amp;', '&'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '\s+', ' ', 'g'))) AS page,
  md5(trim(replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '&nbsp;', ' '), ' ')) AS vendor, md5(trim(regexp_replace(html, '<[^>]+>', ' ', 'g'), ' ')) AS bare FROM pages""")
def html_variants(t: Tables) -> DataFrame:
    """Three ways in which sources read markup as text."""
    c = F.col("html")
    return t.pages.select("page_id", F.md5(T.page_text(c)).alias("page"), F.md5(T.vendor_text(c)).alias("vendor"), F.md5(T.bare_text(c)).alias("bare"))


MARKUP = """SELECT o_orderkey AS id, CASE o_orderkey % 5 WHEN 0 THEN '<p>Order ' || CAST(o_orderkey AS STRING) || ' &amp;amp; <b>more</b></p>' WHEN 1 THEN 'plain &lt;i&gt;' || CAST(o_orderkey AS STRING) || '&lt;/i&gt;  text' WHEN 2 THEN ' n/a ' WHEN 3 THEN '<p> </p>' ELSE 'caf&eacute; ' || CAST(o_custkey AS STRING) END AS raw, CAST(o_orderkey AS STRING) AS n, CAST(o_custkey AS STRING) AS c FROM orders"""


@query(f"""WITH m AS ({MARKUP.replace("AS STRING", "AS VARCHAR")}) SELECT id, CASE id % 5 WHEN 0 THEN 'Order ' || n || ' & more' WHEN 1 THEN 'plain ' || n || ' text' WHEN 4 THEN 'café ' || c END AS text FROM m""")
def parsed_texts(t: Tables) -> DataFrame:
    """Markup read by a tokenizer; placeholders are null."""
    return t.sql(MARKUP, "orders").select("id", T.parsed_text(F.col("raw")).alias("text"))


METAS = """SELECT o_orderkey AS id, '<head><meta name="description" content="short"><meta property="og:description" content="Order ' || CAST(o_orderkey AS STRING) || ' &amp; a description that is long &lt;b&gt;enough&lt;/b&gt; to count">' || '<meta name="description" content="another one that is also long enough, of customer ' || CAST(o_custkey AS STRING) || '"></head>' AS html FROM orders"""


@query("""SELECT o_orderkey AS id, 'Order ' || o_orderkey || ' & a description that is long <b>enough</b> to count' AS description FROM orders""")
def meta_descriptions(t: Tables) -> DataFrame:
    """First description of forty characters in a page's head."""
    return t.sql(METAS, "orders").select("id", T.meta_description(F.col("html")).alias("description"))


LABELS = """SELECT event_id AS id, user_id % 40 AS n, CASE event_id % 6 WHEN 0 THEN 'Posted Today' WHEN 1 THEN 'Posted Yesterday' WHEN 2 THEN 'Posted ' || CAST(user_id % 40 AS STRING) || ' Days Ago' WHEN 3 THEN CAST(user_id % 40 AS STRING) || ' weeks ago' WHEN 4 THEN 'Posted 30+ Days Ago' ELSE '2024-01-03' END AS label, event_id % 6 AS kind FROM events"""


@query(f"""WITH l AS ({LABELS.replace("AS STRING", "AS VARCHAR")}) SELECT id, CASE kind WHEN 0 THEN TIMESTAMP '2024-02-01 12:00:00' WHEN 1 THEN TIMESTAMP '2024-01-31 12:00:00' WHEN 2 THEN TIMESTAMP '2024-02-01 12:00:00' - to_days(n::INT)
  WHEN 3 THEN TIMESTAMP '2024-02-01 12:00:00' - to_days(7 * n::INT) WHEN 4 THEN TIMESTAMP '2024-02-01 12:00:00' ELSE TIMESTAMP '2024-01-03 00:00:00' END AS at FROM l""")
def relative_posted(t: Tables) -> DataFrame:
    """Relative ages of postings as times; what can't be read is the run's time."""
    return t.sql(LABELS, "events").select("id", D.relative(F.col("label"), F.lit("2024-02-01 12:00:00").cast("timestamp")).alias("at"))


@query("""SELECT event_id, round(date_diff('microsecond', ts, TIMESTAMP '2024-01-20 00:00:00') / 3600000000.0::DOUBLE, 2)::DOUBLE AS hours, coalesce(round(date_diff('microsecond', ts, TIMESTAMP '2024-01-20 00:00:00') / 3600000000.0::DOUBLE, 2) BETWEEN 0 AND 48, false) AS young FROM events""")
def snapshot_ages(t: Tables) -> DataFrame:
    """Ages in hours; what lies in the future isn't fresh."""
    hours = D.hours_old(F.col("ts").cast("timestamp"), F.lit("2024-01-20 00:00:00").cast("timestamp"))
    return t.events.select("event_id", hours.alias("hours"), hours.between(0, 48).alias("young"))


AMOUNTS = """SELECT o_orderkey AS id, CASE o_orderkey % 4 WHEN 0 THEN CAST(o_custkey AS STRING) WHEN 1 THEN '1,' || CAST(100 + o_custkey % 900 AS STRING) WHEN 2 THEN '0' ELSE 'n/a' END AS low, CASE o_custkey % 3 WHEN 0 THEN '0' WHEN 1 THEN '' ELSE CAST(o_custkey * 2 AS STRING) END AS top, CASE o_orderkey % 5 WHEN 0 THEN ' Yes' WHEN 1 THEN 'TRUE' WHEN 2 THEN '1' WHEN 3 THEN 'no' ELSE '' END AS flag FROM orders"""


@query(f"""WITH a AS ({AMOUNTS.replace("AS STRING", "AS VARCHAR")}), n AS (SELECT *, try_cast(replace(low, ',', '') AS DOUBLE) AS l, try_cast(replace(top, ',', '') AS DOUBLE) AS t FROM a)
SELECT id, l AS number, CASE WHEN t <> 0 THEN t ELSE l END AS high, lower(trim(flag)) IN ('yes', 'true', '1') AS truth FROM n""")
def numbers(t: Tables) -> DataFrame:
    """Numbers, tops of ranges and flags as text."""
    return t.sql(AMOUNTS, "orders").select("id", M.number(F.col("low")).alias("number"), M.high(F.col("low"), F.col("top")).alias("high"), M.truthy(F.col("flag")).alias("truth"))
