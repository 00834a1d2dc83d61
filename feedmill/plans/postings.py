"""Payloads of vendors, feeds and lists, made of table rows and read back: the SQL side selects the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmill.functions import classify as C
from feedmill.functions import geo as G
from feedmill.functions import text as T
from feedmill.plans.registry import Tables, query
from feedmill.plans.rules import picked
from feedmill.runtime import cut
from feedmill.sources import parsers as P
from feedmill.sources import vendors as V

NOW = "2024-02-01 12:00:00"
PLACES = ["Austin", "Berlin, Germany", "Remote, Canada", "Tokyo, Japan", "Remote"]
#: One posting an order; the customer is the employer and says which vendor it uses.
JOBS = f"""SELECT o_orderkey AS k, o_custkey AS c, CAST(o_orderkey AS STRING) AS n, CAST(o_custkey AS STRING) AS cn, o_orderstatus AS s, place.place AS place, o_orderdate AS moment, CAST(floor(o_totalprice) AS BIGINT) AS pay, o_orderkey % 3 AS m FROM orders
JOIN (SELECT i, place FROM {picked(PLACES, 'place')}) AS place ON place.i = o_orderkey % {len(PLACES)}"""
_JOBS = JOBS.replace("AS STRING", "AS VARCHAR")
_COUNTRY = "CASE " + " ".join(f"WHEN contains(lower(place), '{n}') THEN '{c}'" for n, c in sorted(G.COUNTRIES.items(), key=lambda x: -len(x[0]))) + " ELSE '' END"
_DAY = "strftime(moment, '%Y-%m-%d')"
_STAMP = "strftime(moment, '%Y-%m-%d %H:%M:%S')"
_REMOTE = "CASE WHEN contains(lower(place), 'remote') THEN 'true' ELSE 'false' END"
_ROLE = "'Data Clerk ' || n"
_URL = "'https://x.example/' || n"
_NULL = "CAST(NULL AS DOUBLE)"
KINDS = ("Greenhouse", "Lever", "Ashby", "SmartRecruiters", "Workday", "Workable", "Rippling", "Pinpoint", "Recruitee", "Teamtailor", "Personio", "Breezy")


def _json(*fields: Column) -> Column:
    return F.to_json(F.struct(*fields))


def _as(c: Column | str, name: str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).alias(name)


def _payloads(jobs: DataFrame, kind: Column, item: Column, wrap: dict[str, tuple[str, str]], slug: Column) -> DataFrame:
    """Payload of every employer: its postings' texts between what its vendor puts around them."""
    rows = jobs.select(kind.alias("vendor"), F.concat(F.lit("Employer "), "cn").alias("company"), slug.alias("slug"), "k", item.alias("j"))
    listed = rows.groupBy("vendor", "company", "slug").agg(F.sort_array(F.collect_list(F.struct("k", "j"))).alias("js"))
    around = lambda i: F.create_map(*[F.lit(x) for v, pair in wrap.items() for x in (v, pair[i])])[F.col("vendor")]
    joint = F.when(F.col("vendor").isin("Personio", "WeWorkRemotely"), "").otherwise(",")
    return listed.select("vendor", "company", "slug", F.concat(around(0), F.array_join(F.col("js.j"), "\u0001"), around(1)).alias("body"), joint.alias("joint")).withColumn(
        "body", F.replace("body", F.lit("\u0001"), F.col("joint"))
    ).drop("joint")


def _vendor_item() -> Column:
    n, place, day, pay, m = F.col("n"), F.col("place"), F.date_format("moment", "yyyy-MM-dd"), F.col("pay"), F.col("m")
    role, url = F.concat(F.lit("Data Clerk "), n), F.concat(F.lit("https://x.example/"), n)
    cents = F.array(
        F.struct((pay * 100 + 50).alias("min_cents"), (pay * 200).alias("max_cents"), F.lit("USD").alias("currency_type")),
        F.struct((pay * 100 + 900).alias("min_cents"), (pay * 300 + 99).alias("max_cents"), F.lit("EUR").alias("currency_type")),
    )
    city, country = F.substring_index(place, ",", 1), F.when(place.contains(","), F.trim(F.substring_index(place, ",", -1)))
    address = F.struct(F.struct(city.alias("addressLocality"), country.alias("addressCountry")).alias("address"))
    items = {
        "Greenhouse": _json(role.alias("title"), F.struct(place.alias("name")).alias("location"), _as(day, "updated_at"), url.alias("absolute_url"), F.when(m == 0, cents).alias("pay_input_ranges"), F.concat(F.lit("&lt;p&gt;Job "), n, F.lit(" &amp;amp; more&lt;/p&gt;")).alias("content")),
        "Lever": _json(role.alias("text"), F.struct(place.alias("location")).alias("categories"), F.unix_millis(F.col("moment").cast("timestamp")).alias("createdAt"), url.alias("hostedUrl"), F.when(m == 0, "remote").when(m == 1, "hybrid").alias("workplaceType"), F.concat(F.lit("<b>Job</b> "), n).alias("description")),
        "Ashby": _json(role.alias("title"), _as(place, "location"), _as(day, "publishedAt"), url.alias("applicationUrl"), (m == 0).alias("isRemote"), F.when(m == 1, F.struct(pay.alias("minValue"), (pay * 2).alias("maxValue"), F.lit("USD").alias("currency"))).when(m == 2, F.struct(F.lit(None).cast("long").alias("minValue"), (pay * 3).alias("maxValue"), F.lit("EUR").alias("currency"))).alias("compensation"), F.concat(F.lit("Job "), n).alias("descriptionPlain")),
        "SmartRecruiters": _json(F.concat(F.lit("id"), n).alias("id"), role.alias("name"), _as(day, "publishedDate"), F.when(m != 0, url).alias("applyUrl"), F.struct(F.when(m == 1, place).alias("fullLocation"), city.alias("city"), country.alias("country"), (m == 2).alias("remote")).alias("location"),
                                 F.struct(F.struct(F.struct(F.concat(F.lit("<p>Job "), n, F.lit("</p>")).alias("text")).alias("jobDescription")).alias("sections")).alias("jobAd")),
        "Workday": _json(role.alias("title"), _as(place, "locationsText"), F.when(m == 0, "Posted Today").when(m == 1, F.concat(F.lit("Posted "), (F.col("k") % 30).cast("string"), F.lit(" Days Ago"))).otherwise("Posted 2 weeks ago").alias("postedOn"), F.concat(F.lit("/job/"), n).alias("externalPath")),
        "Workable": _json(role.alias("title"), F.when(m != 1, city).alias("city"), F.array(F.struct(city.alias("city"), country.alias("country"))).alias("locations"), _as(day, "published_on"), url.alias("url"), (m == 0).alias("telecommuting")),
        "Rippling": _json(role.alias("name"), url.alias("url"), F.struct(place.alias("label")).alias("workLocation")),
        "Pinpoint": _json(role.alias("title"), url.alias("url"), F.struct(place.alias("name")).alias("location"), F.when(m == 0, "Remote").alias("workplace_type"), (m == 1).alias("compensation_visible"), pay.alias("compensation_minimum"), (pay * 2).alias("compensation_maximum"), F.lit("GBP").alias("compensation_currency")),
        "Recruitee": _json(role.alias("title"), _as(place, "location"), F.when(m == 0, "").otherwise(day).alias("published_at"), F.lit("2020-02-02").alias("created_at"), F.when(m != 1, url).alias("careers_url"), F.concat(url, F.lit("/apply")).alias("careers_apply_url"), (m == 2).alias("remote"), F.when(m == 0, F.struct(pay.alias("min"), F.lit("EUR").alias("currency"))).alias("salary")),
        "Teamtailor": F.when(m == 0, _json(role.alias("title"), url.alias("url"), _as(day, "date_published"), F.struct(F.array(address).alias("jobLocation")).alias("_jobposting")))
        .otherwise(_json(url.alias("url"), F.struct(role.alias("title"), _as(day, "datePosted"), address.alias("jobLocation"), F.concat(F.lit("<i>Job "), n, F.lit("</i>")).alias("description")).alias("_jobposting"))),
        "Personio": F.concat(F.lit("<position><id>"), n, F.lit("</id><office>"), place, F.lit("</office><name>"), role, F.lit(" &amp; co</name><createdAt>"), day, F.lit("T10:00:00+00:00</createdAt>"), F.when(m == 0, F.concat(F.lit("<careersUrl>"), url, F.lit("</careersUrl>"))).otherwise(""), F.lit("</position>")),
        "Breezy": _json(role.alias("name"), url.alias("url"), _as(day, "published_date"), F.struct(F.when(m != 0, place).alias("name"), (m == 1).alias("is_remote"), F.struct(F.coalesce(country, place).alias("name")).alias("country")).alias("location")),
    }
    out = F.lit("")
    for i, v in enumerate(KINDS):
        out = F.when(F.col("c") % len(KINDS) == i, items[v]).otherwise(out)
    return out


_WRAPS = {
    "Greenhouse": ('{"jobs":[', "]}"), "Lever": ("[", "]"), "Ashby": ('{"jobs":[', "]}"), "SmartRecruiters": ('{"content":[', '],"totalFound":9}'), "Workday": ('{"total":5,"jobPostings":[', "]}"), "Workable": ('{"jobs":[', "]}"),
    "Rippling": ("[", "]"), "Pinpoint": ('{"data":[', "]}"), "Recruitee": ('{"offers":[', "]}"), "Teamtailor": ('{"items":[', "]}"), "Personio": ("<workzag-jobs>", "</workzag-jobs>"), "Breezy": ("[", "]"),
}
_LAST = "CASE WHEN contains(place, ',') THEN trim(split_part(place, ',', 2)) END"


@query(f"""
WITH j AS ({_JOBS}), v AS (SELECT *, c % {len(KINDS)} AS v, {_COUNTRY} AS iso, {_LAST} AS land FROM j)
SELECT k, ['{"', '".join(KINDS)}'][v + 1] AS vendor, 'Employer ' || cn AS company, {_ROLE} || CASE WHEN v = 10 THEN ' & co' ELSE '' END AS role, CASE WHEN v = 5 AND m = 1 THEN place WHEN v = 11 AND m = 0 THEN coalesce(land, place) ELSE place END AS location,
  CASE v WHEN 1 THEN {_STAMP} || '+00:00' WHEN 4 THEN strftime(TIMESTAMP '{NOW}' - to_days(CASE m WHEN 0 THEN 0 WHEN 1 THEN (k % 30)::INT ELSE 14 END), '%Y-%m-%d %H:%M:%S') WHEN 6 THEN '{NOW}' WHEN 7 THEN '{NOW}' WHEN 8 THEN CASE WHEN m = 0 THEN '2020-02-02' ELSE {_DAY} END
    WHEN 9 THEN {_DAY} || ' 00:00:00' WHEN 10 THEN {_DAY} || ' 10:00:00' ELSE {_DAY} END AS date,
  CASE v WHEN 3 THEN CASE WHEN m = 0 THEN 'id' || n ELSE {_URL} END WHEN 4 THEN 'https://slug' || cn || '/job/' || n WHEN 8 THEN CASE WHEN m = 1 THEN {_URL} || '/apply' ELSE {_URL} END WHEN 10 THEN CASE WHEN m = 0 THEN {_URL} ELSE 'https://slug' || cn || '.jobs.personio.com/job/' || n END ELSE {_URL} END AS link,
  CASE v WHEN 1 THEN ['true', 'false', 'unknown'][m + 1] WHEN 2 THEN ['true', 'false', 'false'][m + 1] WHEN 3 THEN ['false', 'false', 'true'][m + 1] WHEN 5 THEN ['true', 'false', 'false'][m + 1] WHEN 7 THEN ['true', 'false', 'false'][m + 1] WHEN 8 THEN ['false', 'false', 'true'][m + 1] WHEN 11 THEN ['false', 'true', 'false'][m + 1] ELSE {_REMOTE} END AS is_remote,
  CASE WHEN v = 0 AND m = 0 AND pay > 0 THEN pay WHEN v = 2 AND m = 1 THEN pay WHEN v = 7 AND m = 1 THEN pay WHEN v = 8 AND m = 0 THEN pay END::DOUBLE AS salary_min,
  CASE WHEN v = 0 AND m = 0 THEN 3 * pay WHEN v = 2 AND m = 1 THEN 2 * pay WHEN v = 2 AND m = 2 THEN 3 * pay WHEN v = 7 AND m = 1 THEN 2 * pay END::DOUBLE AS salary_max,
  CASE WHEN v = 0 AND m = 0 THEN 'USD' WHEN v = 2 AND m > 0 THEN ['USD', 'EUR'][m] WHEN v = 7 AND m = 1 THEN 'GBP' WHEN v = 8 AND m = 0 THEN 'EUR' END AS salary_currency,
  CASE WHEN v = 11 AND m = 0 THEN CASE WHEN land IS NULL THEN iso ELSE iso END ELSE iso END AS country_iso, CASE v WHEN 0 THEN 'Job ' || n || ' & more' WHEN 1 THEN 'Job ' || n WHEN 2 THEN 'Job ' || n WHEN 3 THEN 'Job ' || n WHEN 9 THEN CASE WHEN m > 0 THEN 'Job ' || n END END AS description FROM v""")
def vendor_postings(t: Tables) -> DataFrame:
    """Postings of twelve vendors' payloads, each vendor's employers by the customer's number."""
    jobs = t.sql(JOBS, "orders")
    kind = F.element_at(F.array(*[F.lit(v) for v in KINDS]), (F.col("c") % len(KINDS) + 1).cast("int"))
    payloads = cut(_payloads(jobs, kind, _vendor_item(), _WRAPS, F.concat(F.lit("slug"), "cn")))
    rows = V.normalise_all(payloads, F.lit(NOW).cast("timestamp"))
    return rows.withColumn("k", F.regexp_extract("role", r"(\d+)", 1).cast("long"))


MORE = ("eightfold", "oracle", "adp", "bamboohr", "wfn", "icims")


@query(f"""
WITH j AS ({_JOBS}), v AS (SELECT *, c % 6 AS v FROM j)
SELECT k, CASE v WHEN 5 THEN 'Holder ' || cn ELSE 'Employer ' || cn END AS company, CASE WHEN v = 3 THEN 'Data Intern ' ELSE 'Data Clerk ' END || n AS role, place AS location, CASE v WHEN 0 THEN {_STAMP} || '+00:00' ELSE {_DAY} || ' 00:00:00' END AS date,
  CASE v WHEN 0 THEN 'https://slug' || cn || '/careers/' || n WHEN 1 THEN 'https://slug' || cn || '/hcmUI/CandidateExperience/en/sites/CX/job/' || n WHEN 2 THEN 'https://myjobs.adp.com/slug' || cn || '/cx/job/' || n WHEN 3 THEN 'https://slug' || cn || '.bamboohr.com/careers/' || n
    WHEN 4 THEN 'https://workforcenow.adp.com/mascsr/default/mdf/recruitment/recruitment.html?cid=slug' || cn || '&ccId=1&jobId=' || n || '&lang=en_US' ELSE {_URL} END AS link,
  CASE v WHEN 0 THEN m = 0 WHEN 1 THEN m = 1 WHEN 3 THEN m = 0 ELSE contains(lower(place), 'remote') END::VARCHAR AS is_remote, CASE v WHEN 0 THEN NULL WHEN 4 THEN NULL WHEN 1 THEN 'Job ' || n ELSE 'Job  ' || n END AS description FROM v WHERE v <> 3 OR m < 2""")
def more_vendor_postings(t: Tables) -> DataFrame:
    """Postings of six more vendors, with pages that repeat rows, details and JSON-LD pages."""
    jobs = cut(t.sql(JOBS, "orders").withColumns({"company": F.concat(F.lit("Employer "), "cn", F.lit(", Inc.")), "slug": F.concat(F.lit("slug"), "cn"), "day": F.date_format("moment", "yyyy-MM-dd"), "v": F.col("c") % 6}))
    n, place, m, day = F.col("n"), F.col("place"), F.col("m"), F.col("day")
    role, text = F.concat(F.lit("Data Clerk "), n), F.concat(F.lit("Job&nbsp;<b>"), n, F.lit("</b>"))
    city, land = F.substring_index(place, ",", 1), F.when(place.contains(","), F.trim(F.substring_index(place, ",", -1)))

    def bodies(v: int, item: Column, before: str, after: str, slug: Column = F.col("slug"), twice: bool = False) -> DataFrame:
        rows = jobs.filter(F.col("v") == v).select("company", slug.alias("slug"), "k", item.alias("j"))
        body = F.concat(F.lit(before), F.array_join(F.col("js.j"), ","), F.lit(after)).alias("body")
        made = rows.groupBy("company", "slug").agg(F.sort_array(F.collect_list(F.struct("k", "j"))).alias("js")).select("company", "slug", body)
        return made.unionAll(made) if twice else made

    eight = bodies(0, _json(n.alias("id"), role.alias("name"), F.concat(F.lit("/careers/"), n).alias("positionUrl"), F.unix_timestamp(F.col("moment").cast("timestamp")).alias("postedTs"), F.when(m == 0, "Remote").otherwise("onsite").alias("workLocationOption"), F.array(place).alias("locations")), '{"data":{"positions":[', "]}}", twice=True)
    oracle = bodies(1, _json(n.alias("Id"), role.alias("Title"), place.alias("PrimaryLocation"), day.alias("PostedDate"), F.when(m == 1, "Fully Remote").alias("WorkplaceType"), F.lit("").alias("ShortDescriptionStr"), F.concat(F.lit("Job "), n).alias("ExternalResponsibilitiesStr")), '{"items":[{"TotalJobsCount":3,"requisitionList":[', "]}]}", F.concat("slug", F.lit("|CX")))
    adp = bodies(2, _json(n.alias("reqId"), role.alias("jobTitle"), day.alias("postingDate"), text.alias("jobDescription"), F.array(F.struct(city.alias("city"), land.alias("country"))).alias("requisitionLocations")), '{"count":1,"jobRequisitions":[', "]}")
    opening = F.when(m < 2, F.concat(F.lit("Data Intern "), n)).otherwise(role)
    listed = bodies(3, _json(n.alias("id"), opening.alias("jobOpeningName"), (m == 0).alias("isRemote"), F.struct(city.alias("city"), land.alias("state")).alias("location")), '{"result":[', "]}")
    details = jobs.filter("v = 3").select("slug", n.alias("id"), F.concat(F.lit('{"result":{"jobOpening":'), _json(day.alias("datePosted"), text.alias("description")), F.lit("}}")).alias("body"))
    address = F.struct(city.alias("cityName"), F.struct(land.alias("codeValue")).alias("countrySubdivisionLevel1"))
    wfn = bodies(4, _json(n.alias("itemID"), role.alias("requisitionTitle"), day.alias("postDate"), F.array(F.struct(address.alias("address"))).alias("requisitionLocations")), '{"jobRequisitions":[', "]}", twice=True)
    spot = F.struct(F.struct(city.alias("addressLocality"), land.alias("addressCountry")).alias("address")).alias("jobLocation")
    ld = _json(F.lit("JobPosting").alias("@type"), role.alias("title"), day.alias("datePosted"), text.alias("description"), F.struct(F.concat(F.lit("Holder "), "cn", F.lit(" LLC")).alias("name")).alias("hiringOrganization"), spot)
    pages = jobs.filter("v = 5").select("company", F.concat(F.lit("https://x.example/"), n).alias("link"), F.concat(F.lit('<script type="application/ld+json">'), F.when(m == 0, F.concat(F.lit('[{"@type":"WebSite"},'), ld, F.lit("]"))).otherwise(ld), F.lit("</script>")).alias("body"))
    rows = V.eightfold(eight)
    for part in (V.oracle_cloud(oracle), V.adp(adp), V.bamboohr(listed, details), V.workforce_now(wfn, "1"), V.icims(pages)):
        rows = rows.unionByName(part)
    return rows.select(F.regexp_extract("role", r"(\d+)", 1).cast("long").alias("k"), "company", "role", "location", "date", "link", "is_remote", "description")


NAMES = (*V.FEEDS, "WeWorkRemotely", "HN who-is-hiring")


@query(f"""
WITH j AS ({_JOBS}), f AS (SELECT *, c % 9 AS f FROM j)
SELECT k, CASE f WHEN 7 THEN 'Co ' || n ELSE 'Employer ' || cn END AS company, {_ROLE} AS role,
  CASE WHEN f = 3 AND m = 0 THEN 'Remote' WHEN f = 4 THEN CASE m WHEN 0 THEN split_part(place, ',', 1) WHEN 1 THEN place ELSE '' END WHEN f = 6 AND m = 0 THEN 'United States' WHEN f = 7 AND m = 0 THEN 'Remote' WHEN f = 8 AND m = 0 THEN 'Remote' ELSE place END AS location,
  CASE f WHEN 1 THEN {_STAMP} || '+00:00' WHEN 4 THEN {_STAMP} || '+00:00' WHEN 7 THEN {_STAMP} WHEN 8 THEN '2024-01-02' ELSE {_DAY} END AS date,
  CASE WHEN f = 8 THEN 'https://boards.greenhouse.io' WHEN f IN (3, 4) AND m = 1 THEN {_URL} || '/b' ELSE {_URL} END AS link,
  CASE f WHEN 1 THEN m = 0 WHEN 6 THEN m > 0 AND contains(lower(place), 'remote') WHEN 8 THEN m > 0 AND contains(lower(place), 'remote') ELSE true END::VARCHAR AS is_remote,
  CASE WHEN f IN (3, 4) AND m = 0 AND pay > 0 THEN pay END::DOUBLE AS salary_min, CASE WHEN f IN (3, 4) AND m < 2 AND pay > 0 THEN 2 * pay END::DOUBLE AS salary_max, CASE WHEN f = 4 AND m = 1 THEN 'EUR' END AS salary_currency
FROM f""")
def breadth_rows(t: Tables) -> DataFrame:
    """Postings of nine feeds of many employers: JSON, titles of an RSS feed, comments of a thread."""
    jobs = t.sql(JOBS, "orders")
    n, place, day, pay, m = F.col("n"), F.col("place"), F.date_format("moment", "yyyy-MM-dd"), F.col("pay"), F.col("m")
    role, url, company = F.concat(F.lit("Data Clerk "), n), F.concat(F.lit("https://x.example/"), n), F.concat(F.lit("Employer "), "cn")
    other, seconds = F.concat(url, F.lit("/b")), F.unix_timestamp(F.col("moment").cast("timestamp"))
    low, high = F.when(m == 0, pay).otherwise(F.lit(-1)), F.when(m < 2, 2 * pay)
    where = F.when(m == 0, F.to_json(F.array(F.trim(F.substring_index(place, ",", 1))))).when(m == 1, F.concat(F.lit('["'), place, F.lit('"]'))).otherwise("[]")
    items = [
        _json(company.alias("companyName"), role.alias("jobTitle"), place.alias("jobGeo"), day.alias("pubDate"), url.alias("url")),
        _json(company.alias("company_name"), role.alias("title"), place.alias("location"), seconds.alias("created_at"), url.alias("url"), (m == 0).alias("remote")),
        _json(company.alias("company_name"), role.alias("title"), place.alias("candidate_required_location"), day.alias("publication_date"), url.alias("url")),
        _json(company.alias("company"), role.alias("position"), F.when(m != 0, place).alias("location"), day.alias("date"), F.when(m != 1, url).alias("url"), other.alias("apply_url"), low.alias("salary_min"), high.alias("salary_max")),
        F.concat(F.lit('{"locationRestrictions":'), where, F.lit(","), F.substring(_json(company.alias("companyName"), role.alias("title"), seconds.alias("pubDate"), F.when(m != 1, url).alias("applicationLink"), other.alias("guid"), low.alias("minSalary"), high.alias("maxSalary"), F.when(m == 1, "EUR").otherwise("").alias("currency")), 2, 1 << 20)),
        _json(company.alias("company_name"), role.alias("title"), place.alias("location"), day.alias("pub_date"), url.alias("url")),
        F.when(m == 1, _json(company.alias("company"), role.alias("name"), F.array(F.struct(place.alias("name"))).alias("locations"), day.alias("publication_date"), F.struct(url.alias("landing_page")).alias("refs")))
        .otherwise(_json(F.struct(company.alias("name")).alias("company"), role.alias("name"), F.when(m == 2, F.array(F.struct(place.alias("name")))).alias("locations"), day.alias("publication_date"), F.struct(url.alias("landing_page")).alias("refs"))),
        F.concat(F.lit("<item><title>Co "), n, F.lit(": "), role, F.lit("</title><link>"), url, F.lit("</link>"), F.when(m != 0, F.concat(F.lit("<region>"), place, F.lit("</region>"))).otherwise(""), F.lit("<pubDate>"), F.date_format("moment", "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT</pubDate></item>")),
        _json(F.concat(company, F.lit(" | "), role, F.lit(" | "), F.when(m == 0, "").otherwise(place), F.lit(" | <a>https://boards.greenhouse.io/x/jobs/"), n, F.lit("</a>")).alias("text")),
    ]
    item = F.lit("")
    for i, x in enumerate(items):
        item = F.when(F.col("c") % 9 == i, x).otherwise(item)
    wraps = {
        "Jobicy": ('{"jobs":[', "]}"), "Arbeitnow": ('{"data":[', "]}"), "Remotive": ('{"jobs":[', "]}"), "RemoteOK": ('[{"legal":"x"},', "]"), "Himalayas": ('{"jobs":[', "]}"), "Working Nomads": ("[", "]"), "TheMuse": ('{"results":[', "]}"),
        "WeWorkRemotely": ("<rss>", "</rss>"), "HN who-is-hiring": ('{"created_at":"2024-01-02T03:04:05Z","children":[{"text":"no link | here"},', "]}"),
    }
    kind = F.element_at(F.array(*[F.lit(v) for v in NAMES]), (F.col("c") % 9 + 1).cast("int"))
    payloads = cut(_payloads(jobs, kind, item, wraps, F.lit("")).withColumnRenamed("vendor", "feed"))
    rows = V.read_feeds(payloads)
    return rows.select(F.regexp_extract("role", r"(\d+)", 1).cast("long").alias("k"), "company", "role", "location", "date", "link", "is_remote", "salary_min", "salary_max", "salary_currency")


@query(f"""
WITH j AS ({_JOBS}) SELECT k, 'Employer ' || cn AS company, {_ROLE} AS role, place AS location, {_DAY} AS date, {_URL} AS link, (m = 0)::VARCHAR AS is_remote, CASE WHEN m = 1 THEN pay END::DOUBLE AS salary_min, CASE WHEN m = 0 THEN 'NL' ELSE {_COUNTRY} END AS country_iso,
  CASE m WHEN 0 THEN 'internship' WHEN 1 THEN 'new_grad' END AS employment_type FROM j""")
def enriched_jobs(t: Tables) -> DataFrame:
    """Nested postings of an API with its own enrichment."""
    jobs = t.sql(JOBS, "orders")
    n, m = F.col("n"), F.col("m")
    item = _json(
        F.concat(F.lit("Employer "), "cn").alias("company"), F.concat(F.lit(" Data Clerk "), n).alias("title"), "place", _as("place", "location"), F.date_format("moment", "yyyy-MM-dd").alias("posted_at"), F.concat(F.lit("https://x.example/"), n).alias("url"),
        F.when(m == 0, "remote").alias("work_mode"), F.when(m == 0, F.array(F.lit("nl"))).alias("countries"), F.when(m < 2, F.struct(F.when(m == 1, F.col("pay")).alias("salary_min"), F.when(m == 0, "internship").otherwise("new_grad").alias("employment_type"))).alias("enrichment"),
    )
    pages = jobs.select((F.col("k") % 50).alias("page"), item.alias("j")).groupBy("page").agg(F.collect_list("j").alias("js")).select(F.lit("").alias("company"), F.lit("").alias("slug"), F.concat(F.lit('{"jobs":['), F.array_join("js", ","), F.lit("]}")).alias("body"))
    rows = V.enriched_jobs(pages)
    return rows.select(F.regexp_extract("role", r"(\d+)", 1).cast("long").alias("k"), "company", "role", "location", "date", "link", "is_remote", "salary_min", "country_iso", "employment_type")


@query(f"""
WITH j AS ({_JOBS}) SELECT k, CASE m WHEN 2 THEN 'U.S. Government' WHEN 1 THEN 'Department ' || cn ELSE 'Agency ' || cn END AS company, {_ROLE} AS role, CASE m WHEN 0 THEN place || ', Reno' WHEN 1 THEN place ELSE 'N/A' END AS location, {_URL} AS link, {_DAY} AS date,
  CASE WHEN m = 1 THEN 'M' || n ELSE 'P' || n END AS ats_id, CASE m WHEN 0 THEN 'Summary ' || n ELSE 'Skills' END AS description, pay::DOUBLE AS salary_min FROM j WHERE k % 7 <> 0""")
def government_jobs(t: Tables) -> DataFrame:
    """Postings of a government search; entries without a title or an id are left out."""
    jobs = t.sql(JOBS, "orders")
    n, m, place = F.col("n"), F.col("m"), F.col("place")
    name = lambda c: F.struct(c.alias("LocationName"))
    descriptor = F.struct(
        F.when(m != 1, F.concat(F.lit("P"), n)).alias("PositionID"), F.concat(F.lit("https://x.example/"), n).alias("PositionURI"), F.when(F.col("k") % 7 != 0, F.concat(F.lit("Data Clerk "), n)).alias("PositionTitle"),
        F.when(m == 0, F.concat(F.lit("Agency "), "cn")).alias("OrganizationName"), F.when(m < 2, F.concat(F.lit("Department "), "cn")).alias("DepartmentName"), F.date_format("moment", "yyyy-MM-dd").alias("PublicationStartDate"), F.lit("Skills").alias("QualificationSummary"),
        F.when(m == 0, F.array(name(place), name(F.lit("Reno")), name(place))).when(m == 1, F.array(name(place), name(F.lit("")))).alias("Locations"), F.array(F.struct(F.col("pay").cast("string").alias("MinimumRange"))).alias("PositionRemuneration"),
        F.when(m == 0, F.struct(F.struct(F.concat(F.lit("Summary "), n).alias("JobSummary")).alias("Details"))).alias("UserArea"),
    )
    item = _json(F.concat(F.lit("M"), n).alias("MatchedObjectId"), descriptor.alias("MatchedObjectDescriptor"))
    pages = jobs.select((F.col("k") % 50).alias("page"), item.alias("j")).groupBy("page").agg(F.collect_list("j").alias("js")).select(
        F.lit("").alias("company"), F.lit("").alias("slug"), F.concat(F.lit('{"SearchResult":{"SearchResultItems":['), F.array_join("js", ","), F.lit("]}}")).alias("body")
    )
    rows = V.government_jobs(pages)
    return rows.select(F.regexp_extract("role", r"(\d+)", 1).cast("long").alias("k"), "company", "role", "location", "link", "date", "ats_id", "description", "salary_min")


@query(f"""
WITH j AS ({_JOBS}) SELECT k, 'Employer ' || cn AS company, {_ROLE} AS role, place AS location, CASE WHEN m = 2 THEN '' ELSE strftime(moment, '%Y-%m-%dT%H:%M:%SZ') END AS date, (m = 1)::VARCHAR AS is_remote, CASE WHEN m > 0 AND pay > 0 THEN pay END::DOUBLE AS salary_min, CASE WHEN m = 1 THEN 'USD' END AS salary_currency FROM j WHERE k % 5 <> 3""")
def scraped_rows(t: Tables) -> DataFrame:
    """Rows of a scraper; incomplete ones are left out."""
    jobs = t.sql(JOBS, "orders")
    m = F.col("m")
    rows = V.scraped_rows(jobs.select(
        F.concat(F.lit(" Data Clerk "), "n").alias("title"), F.concat(F.lit("Employer "), "cn").alias("company"), F.when(F.col("k") % 5 != 3, F.col("place")).otherwise(" ").alias("location"), F.concat(F.lit("https://x.example/"), "n").alias("job_url"),
        F.when(m == 2, "soon").otherwise(F.date_format("moment", "yyyy-MM-dd HH:mm:ss")).alias("date_posted"), F.when(m > 0, F.col("pay")).otherwise(0).cast("string").alias("min_amount"), F.lit(None).cast("string").alias("max_amount"), F.when(m == 1, "USD").otherwise("").alias("currency"), F.when(m == 1, "Yes").otherwise("no").alias("is_remote"),
    ))
    return rows.select(F.regexp_extract("role", r"(\d+)", 1).cast("long").alias("k"), "company", "role", "location", "date", "is_remote", "salary_min", "salary_currency")


@query(f"""
WITH j AS ({_JOBS}), r AS (SELECT *, k % 4 AS q FROM j WHERE k % 6 <> 0)
SELECT k, {_ROLE} || CASE WHEN m = 0 THEN ' New Grad' ELSE '' END AS role, place AS location, {_DAY} AS date, CASE WHEN m = 1 THEN {_URL} ELSE 'https://site.example/jobs/' || n END AS link, CASE WHEN q = 1 THEN 'US' ELSE '' END AS country_iso, CASE WHEN m = 0 THEN 'new-grad' ELSE 'internship' END AS tier_hint, (m = 1)::VARCHAR AS direct_apply
FROM r WHERE q = 1 OR (q IN (0, 3) AND (contains(lower(place), 'austin') OR place = 'Remote'))""")
def embedded_listing(t: Tables) -> DataFrame:
    """Open postings of the list that a page's script payload embeds, by place."""
    jobs = t.sql(JOBS, "orders")
    n, m, q = F.col("n"), F.col("m"), F.col("k") % 4
    item = _json(
        n.alias("id"), F.lit("Acme").alias("company"), F.concat(F.lit("Data Clerk "), n, F.when(m == 0, " New Grad").otherwise("")).alias("title"), _as("place", "location"), F.date_format("moment", "yyyy-MM-dd'T'HH:mm:ss").alias("postedAt"),
        F.when(m == 1, F.concat(F.lit("https://x.example/"), n)).alias("applyUrl"), (F.col("k") % 6 == 0).alias("closed"), F.when(q == 1, F.array(F.lit("United States"), F.lit("Mexico"))).when(q == 2, F.array(F.lit("France"))).alias("placeCountries"),
    )
    pages = jobs.select((F.col("k") % 20).alias("page"), item.alias("j")).groupBy("page").agg(F.collect_list("j").alias("js"))
    listed = F.concat(F.lit('{"initialJobs":['), F.array_join("js", ","), F.lit("]}"))
    escaped = F.replace(F.replace(listed, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    pages = pages.select("page", F.concat(F.lit('<script>push([1,"'), escaped, F.lit('"])</script>')).alias("html"))
    rows = V.listing_rows(P.embedded_arrays(pages, "initialJobs"), "https://site.example")
    return rows.select(F.regexp_extract("role", r"(\d+)", 1).cast("long").alias("k"), "role", "location", "date", "link", "country_iso", "tier_hint", "direct_apply")
