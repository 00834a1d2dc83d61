"""Lists, feeds, pages and crawls, made of table rows and read back: the SQL side selects the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmill.functions import shapes as S
from feedmill.functions import text as T
from feedmill.plans.postings import _JOBS, JOBS, _json
from feedmill.plans.registry import Tables, query
from feedmill.plans.rules import picked
from feedmill.runtime import cut
from feedmill.sources import crawls, lists
from feedmill.sources import parsers as P

AS_OF = "2024-02-01 12:00:00"


def _as_of() -> Column:
    return F.lit(AS_OF).cast("timestamp")


def _bodies(rows: DataFrame, item: Column, before: Column | str, after: str, joint: str = "") -> DataFrame:
    """(id, body): the texts of a customer's orders, in order, between two others."""
    before = F.lit(before) if isinstance(before, str) else before
    made = rows.select(F.col("c").alias("id"), "k", item.alias("j")).groupBy("id").agg(F.sort_array(F.collect_list(F.struct("k", "j"))).alias("js"))
    return made.select("id", F.concat(before, F.array_join(F.col("js.j"), joint), F.lit(after)).alias("body"))


_AGE = "CASE m WHEN 0 THEN (k % 20) || 'd' WHEN 1 THEN '2mo' ELSE '-' END"
_AGED = f"CASE m WHEN 0 THEN strftime(TIMESTAMP '{AS_OF}' - to_days((k % 20)::INT), '%Y-%m-%dT%H:%M:%SZ') WHEN 1 THEN strftime(TIMESTAMP '{AS_OF}' - to_days(60), '%Y-%m-%dT%H:%M:%SZ') ELSE '' END"
#: What a customer's orders give as rows of a table list: the first names the employer, others take it over.
_ROWS = f"""j AS ({_JOBS}), r AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY k) AS i FROM j),
l AS (SELECT c AS id, k, 'Employer ' || cn AS company, 'Data Clerk ' || n AS role, replace(place, ', ', ', ') AS location, CASE m WHEN 2 THEN 'https://e.example/' || cn ELSE 'https://x.example/' || n END AS link, {_AGED} AS date, contains(lower(place), 'remote')::VARCHAR AS is_remote, m, i FROM r)"""


def _table_rows(t: Tables) -> DataFrame:
    from pyspark.sql import Window

    rows = t.sql(JOBS, "orders").withColumn("i", F.row_number().over(Window.partitionBy("c").orderBy("k")))
    age = F.when(F.col("m") == 0, F.concat((F.col("k") % 20).cast("string"), F.lit("d"))).when(F.col("m") == 1, "2mo").otherwise("-")
    return rows.withColumns({"role": F.concat(F.lit("Data Clerk "), "n"), "age": age, "url": F.concat(F.lit("https://x.example/"), "n"), "home": F.concat(F.lit("https://e.example/"), "cn")})


def _markdown(rows: DataFrame) -> DataFrame:
    m = F.col("m")
    company = F.when(F.col("i") == 1, F.concat(F.lit("**[Employer "), "cn", F.lit("]("), "home", F.lit(")**"))).when(m == 2, F.concat(F.lit("[Employer "), "cn", F.lit("]("), "home", F.lit(")"))).otherwise("↳")
    link = F.when(m == 0, F.concat(F.lit("[Apply]("), "url", F.lit(")"))).when(m == 1, F.concat(F.lit('<a href="'), "url", F.lit('"><img></a>'))).otherwise("")
    line = F.concat(F.lit("| "), company, F.lit(" | **"), "role", F.lit("** | "), F.replace("place", F.lit(", "), F.lit("<br>")), F.lit(" (onsite) | "), link, F.lit(" | "), "age", F.lit(" |\n"))
    return _bodies(rows, line, "# Jobs\n| Note | x |\n|---|---|\n| a | b |\n\n| Company (employer) | **Position** | Locations | Application/Link | Age |\n| --- | :---: | --- | --- | ---: |\n", "\ntext\n")


def _html(rows: DataFrame) -> DataFrame:
    m = F.col("m")
    company = F.when((F.col("i") == 1) | (m == 2), F.concat(F.lit("<b>Employer "), "cn", F.lit("</b>"))).otherwise("↳")
    link = F.when(m == 2, F.col("home")).otherwise(F.col("url"))
    line = F.concat(
        F.lit("<tr><td>"), company, F.lit("</td><td>"), "role", F.lit("</td><td><details><summary>2 places</summary>"), F.replace("place", F.lit(", "), F.lit("<br/>")), F.lit('</details></td><td><a href="https://simplify.jobs/p">s</a><a href="'), link,
        F.lit('">Apply</a></td><td>'), "age", F.lit("</td></tr>"),
    )
    return _bodies(rows, line, "<table><tr><td>1</td></tr></table><TABLE><thead><tr><th>Company</th><th>Title</th><th>Location</th><th>Posting</th><th>Date Posted</th></tr></thead>", "</TABLE>")


_CSV_HEAD = "posted_at,company,title,location,url,remote\n"


def _csv(rows: DataFrame) -> DataFrame:
    line = F.concat(F.date_format("moment", "yyyy-MM-dd"), F.lit(',"Employer, '), "cn", F.lit('",'), "role", F.lit(',"'), F.when(F.col("k") % 9 == 0, "").otherwise(F.col("place")), F.lit('",'), "url", F.lit(","), F.when(F.col("m") == 0, " Remote").otherwise("no"), F.lit("\n"))
    return _bodies(rows, line, F.when(F.col("id") % 4 == 0, "company,title,url\n").otherwise(_CSV_HEAD), "")


def _json_lists(rows: DataFrame) -> DataFrame:
    m = F.col("m")
    item = _json(
        F.concat(F.lit(" Employer "), "cn").alias("company"), F.col("role").alias("title"), F.when(F.col("k") % 9 != 0, F.col("place")).alias("location"), F.when(m == 0, F.col("url")).alias("listingUrl"), F.when(m != 0, F.col("home")).otherwise("other").alias("url"),
        F.when(m == 1, F.date_format("moment", "yyyy-MM-dd")).alias("posted"), F.lit("2020").alias("posted_at"),
    )
    made = _bodies(rows, item, "", "", ",")
    return made.withColumn("body", F.when(F.col("id") % 2 == 0, F.concat(F.lit("["), "body", F.lit("]"))).otherwise(F.concat(F.lit('{"n":1,"jobs":['), "body", F.lit("]}"))))


@query(f"WITH {_ROWS} SELECT id, 2 AS table_no, (8 + i - 1)::INT AS line_no, company, role, location, date, link, is_remote FROM l".replace("(8 + i - 1)", "(6 + i)"))
def markdown_rows(t: Tables) -> DataFrame:
    """Rows of pipe tables by named fields; an arrow takes the employer above, a missing link the employer's."""
    return lists.markdown_rows(_markdown(_table_rows(t)), _as_of())


@query(f"WITH {_ROWS} SELECT id, 1 AS table_no, i::INT AS line_no, company, role, location, date, link, is_remote FROM l")
def html_list_rows(t: Tables) -> DataFrame:
    """Rows of HTML tables by named fields."""
    return lists.html_rows(_html(_table_rows(t)), _as_of())


_CSV_SQL = f"""WITH j AS ({_JOBS}), r AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY k) AS i FROM j)
SELECT c AS id, i::INT AS line_no, 'Employer, ' || cn AS company, 'Data Clerk ' || n AS role, place AS location, strftime(moment, '%Y-%m-%d') AS date, 'https://x.example/' || n AS link, (m = 0)::VARCHAR AS is_remote FROM r WHERE c % 4 <> 0 AND k % 9 <> 0"""
_JSON_SQL = f"""WITH j AS ({_JOBS}) SELECT c AS id, 'Employer ' || cn AS company, 'Data Clerk ' || n AS role, place AS location, CASE m WHEN 1 THEN strftime(moment, '%Y-%m-%d') ELSE '2020' END AS date, CASE m WHEN 0 THEN 'https://x.example/' || n ELSE 'https://e.example/' || cn END AS link,
  contains(lower(place), 'remote')::VARCHAR AS is_remote FROM j WHERE k % 9 <> 0"""


@query(_CSV_SQL)
def csv_lists(t: Tables) -> DataFrame:
    """CSV lists by their headings; a list without the columns needed gives nothing."""
    return lists.csv_rows(_csv(_table_rows(t)))


@query(_JSON_SQL)
def json_lists(t: Tables) -> DataFrame:
    """JSON lists, bare or wrapped."""
    return lists.json_rows(_json_lists(_table_rows(t)))


@query(f"""
WITH {_ROWS}, csv AS ({_CSV_SQL}), json AS ({_JSON_SQL})
SELECT id, CASE id % 4 WHEN 0 THEN 'md' WHEN 2 THEN 'html' END AS format, company, role, location, date, link, is_remote FROM l WHERE id % 4 IN (0, 2)
UNION ALL SELECT id, 'csv', company, role, location, date, link, is_remote FROM csv WHERE id % 4 = 1 UNION ALL SELECT id, 'json', company, role, location, date, link, is_remote FROM json WHERE id % 4 = 3""")
def list_sources(t: Tables) -> DataFrame:
    """Sources of four formats through one reader."""
    rows = _table_rows(t)
    part = lambda i, name, body: body.filter(F.col("id") % 4 == i).select("id", F.lit(name).alias("format"), "body")
    every = part(0, None, _markdown(rows)).unionByName(part(2, "html", _html(rows))).unionByName(part(1, "csv", _csv(rows))).unionByName(part(3, "json", _json_lists(rows)))
    return lists.list_rows(cut(every.withColumn("format", F.col("format").cast("string"))), _as_of())


@query("""
WITH s AS (SELECT c_custkey AS id, 2022 + c_custkey % 4 AS y, c_custkey % 5 AS q FROM customer), u AS (SELECT id, q, y, 'https://lists.example/' || y || '/' || id AS url FROM s),
a AS (SELECT id, CASE WHEN q <> 0 THEN y WHEN y + 1 >= 2023 AND q = 0 AND id % 3 = 0 THEN y + 1 WHEN y - 1 >= 2023 AND id % 3 = 1 THEN y - 1 END AS hit, y FROM u)
SELECT id, 'https://lists.example/' || hit || '/' || id AS url, CASE WHEN hit = y THEN 0 WHEN hit = y + 1 THEN 1 ELSE 2 END::INT AS attempt, 'list ' || id AS body FROM a WHERE hit IS NOT NULL""")
def season_fallback(t: Tables) -> DataFrame:
    """A list that is gone is sought under the seasons beside its own; the first answer counts."""
    s = t.customer.select(F.col("c_custkey").alias("id"), (2022 + F.col("c_custkey") % 4).alias("y"), (F.col("c_custkey") % 5).alias("q"))
    address = lambda y: F.concat(F.lit("https://lists.example/"), y.cast("string"), F.lit("/"), F.col("id").cast("string"))
    tries = lists.with_season_urls(s.select("id", address(F.col("y")).alias("url")))
    body = F.concat(F.lit("list "), F.col("id").cast("string"))
    status = lambda y, good: s.select(address(y).alias("url"), F.when(good, 200).otherwise(404).alias("status"), body.alias("body"))
    q, third = F.col("q"), F.col("id") % 3
    answers = status(F.col("y"), q != 0).unionByName(status(F.col("y") + 1, (q == 0) & (third == 0))).unionByName(status(F.col("y") - 1, (q == 0) & (third == 1)))
    return lists.first_answers(tries, answers)


@query(f"""
WITH j AS ({_JOBS}), r AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY k) AS i FROM j)
SELECT c AS id, ((i - 1) * 1)::INT AS row_no, x.col::INT AS col_no, CASE x.col WHEN 0 THEN 'Data & Clerk ' || n WHEN 1 THEN place ELSE n END AS cell FROM r, (VALUES (0), (1), (2)) x(col)""")
def html_tables(t: Tables) -> DataFrame:
    """Cells of a page's table."""
    rows = t.sql(JOBS, "orders")
    line = F.concat(F.lit("<TR class=x>\n<td>Data &amp; Clerk "), "n", F.lit("</td><th><i>"), "place", F.lit("</i> </th><td><a href='x'>"), "n", F.lit("</a></td></TR>"))
    return P.html_tables(_bodies(rows, line, "<p>x</p><table border=1>", "</table>").withColumnRenamed("body", "html")).drop("table_no")


@query(f"""
WITH j AS ({_JOBS}), r AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY k) - 1 AS i, c % 2 AS atom FROM j)
SELECT c AS id, i::INT AS place, CASE WHEN m = 2 THEN 'Clerk ' || n ELSE 'Employer ' || cn || ': Data & Clerk ' || n END AS title, 'https://x.example/' || n AS link, CASE WHEN atom = 1 THEN strftime(moment, '%Y-%m-%dT%H:%M:%SZ') WHEN m = 1 THEN '' ELSE strftime(moment, '%a, %d %b %Y %H:%M:%S') || ' GMT' END AS published,
  CASE WHEN m = 0 THEN 'Good job ' || n ELSE '' END AS description, CASE WHEN m = 2 THEN '' ELSE 'Employer ' || cn END AS company, CASE WHEN m = 2 THEN 'Clerk ' || n ELSE 'Data & Clerk ' || n END AS role FROM r""")
def feed_items(t: Tables) -> DataFrame:
    """Items of RSS and Atom feeds, titles split into employer and role."""
    rows = t.sql(JOBS, "orders")
    m = F.col("m")
    title = F.when(m == 2, F.concat(F.lit("Clerk "), "n")).otherwise(F.concat(F.lit("Employer "), "cn", F.lit(": Data &amp; Clerk "), "n"))
    note = F.when(m == 0, F.concat(F.lit("<![CDATA[<b>Good</b> job "), "n", F.lit("]]>"))).otherwise("")
    rss = F.concat(F.lit("<item><title>"), title, F.lit("</title><link> https://x.example/"), "n", F.lit("</link>"), F.when(m != 1, F.concat(F.lit("<pubDate>"), F.date_format("moment", "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT</pubDate>"))).otherwise(""), F.lit("<description>"), note, F.lit("</description></item>"))
    atom = F.concat(F.lit('<entry><title type="text">'), title, F.lit('</title><link rel="alternate" href="https://x.example/'), "n", F.lit('"/><updated>'), F.date_format("moment", "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit("</updated><summary>"), note, F.lit("</summary></entry>"))
    body = _bodies(rows, F.when(F.col("c") % 2 == 1, atom).otherwise(rss), "<x>", "</x>").withColumnRenamed("body", "xml")
    company, role = T.company_role(F.col("title"))
    return P.feed_items(body).withColumns({"company": company, "role": role})


@query(f"""WITH j AS ({_JOBS}) SELECT c AS id, CASE WHEN c % 5 = 0 THEN 0 ELSE count(*) END::INT AS n, CASE WHEN c % 5 = 0 THEN '' ELSE min(n_)[5:] END AS first FROM (SELECT *, lpad(k::VARCHAR, 12, '0') || n AS s, lpad(k::VARCHAR, 4, '0') AS z, printf('%04d', 0) || n AS n_ FROM (SELECT *, k AS kk FROM j) WHERE true) GROUP BY c""".replace("min(n_)[5:]", "arg_min(n, k)"))
def payload_rows(t: Tables) -> DataFrame:
    """Postings in payloads of many shapes, and the first entry of their lists."""
    rows = t.sql(JOBS, "orders")
    made = _bodies(rows, F.concat(F.lit('"'), "n", F.lit('"')), "", "", ",")
    keys = F.element_at(F.array(*[F.lit(k) for k in S.ROW_KEYS]), (F.col("id") % len(S.ROW_KEYS) + 1).cast("int"))
    listed = F.concat(F.lit("["), "body", F.lit("]"))
    shape = F.when(F.col("id") % 5 == 0, '{"other":[1,2]}').when(F.col("id") % 3 == 0, listed).otherwise(F.concat(F.lit('{"x":1,"'), keys, F.lit('":'), listed, F.lit("}")))
    loose = F.when(F.col("id") % 5 == 0, "[]").when(F.col("id") % 2 == 0, listed).otherwise(F.replace(listed, F.lit('"'), F.lit("'")))
    return made.select("id", S.row_count(shape).cast("int").alias("n"), S.first_item(loose).alias("first"))


@query("""
SELECT conv_id AS id, coalesce(arg_min(text, turn) FILTER (WHERE role = 'user'), '') AS body, string_agg(CASE WHEN seen THEN spot END, ', ' ORDER BY turn) AS places
FROM (SELECT *, coalesce(role, 'x') || ' ' || turn % 2 AS spot, row_number() OVER (PARTITION BY conv_id, coalesce(role, 'x'), turn % 2 ORDER BY turn) = 1 AS seen FROM conversations) GROUP BY 1""")
def section_lookup(t: Tables) -> DataFrame:
    """Named sections in a list or an object, and the distinct names of a list of places."""
    turns = t.conversations.withColumn("spot", F.concat(F.coalesce("role", F.lit("x")), F.lit(" "), (F.col("turn") % 2).cast("string")))
    rows = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text", "spot"))).alias("x"), F.min_by(F.when(F.col("role") == "user", F.col("text")), F.when(F.col("role") == "user", F.col("turn"))).alias("user"))
    listed = F.to_json(F.struct(F.transform("x", lambda e: F.struct(e["role"].alias("name"), e["text"].alias("text"))).alias("sections")))
    mapped = F.to_json(F.struct(F.struct(F.struct(F.col("user").alias("text")).alias("user"), F.struct(F.lit("z").alias("text")).alias("other")).alias("sections")))
    places = F.to_json(F.transform("x", lambda e: F.struct(e["spot"].alias("LocationName"))))
    return rows.select(F.col("conv_id").alias("id"), S.section(F.when(F.col("conv_id") % 2 == 0, listed).otherwise(mapped), "user").alias("body"), S.place_names(places).alias("places"))


def _ld(t: Tables) -> DataFrame:
    """Pages of the orders: JSON-LD in three shapes, or a title alone."""
    rows = t.sql(JOBS, "orders")
    n, place, m = F.col("n"), F.col("place"), F.col("m")
    city, land = F.substring_index(place, ",", 1), F.when(place.contains(","), F.trim(F.substring_index(place, ",", -1)))
    address = F.struct(F.struct(city.alias("addressLocality"), land.alias("addressCountry")).alias("address"))
    pay = F.struct(F.lit("usd").alias("currency"), F.struct(F.col("pay").alias("minValue"), (F.col("pay") * 2).cast("string").alias("maxValue")).alias("value"))
    one = F.struct(
        F.lit("JobPosting").alias("@type"), F.concat(F.lit("Data Clerk "), n).alias("title"), F.struct(F.concat(F.lit("Holder "), "cn").alias("name")).alias("hiringOrganization"), F.date_format("moment", "yyyy-MM-dd'T'HH:mm").alias("datePosted"),
        F.when(F.col("k") % 5 == 0, "TELECOMMUTE").alias("jobLocationType"), F.when(m == 1, pay).alias("baseSalary"), F.concat(F.lit("<p>Job "), n, F.lit(" &amp; more</p>")).alias("description"),
    )
    plain = F.to_json(F.struct(one["@type"].alias("@type"), one["title"].alias("title"), one["hiringOrganization"].alias("hiringOrganization"), one["datePosted"].alias("datePosted"), one["jobLocationType"].alias("jobLocationType"), one["baseSalary"].alias("baseSalary"), one["description"].alias("description"), address.alias("jobLocation")))
    listed = F.to_json(F.struct(F.array(one["@type"]).alias("@type"), one["title"].alias("title"), one["hiringOrganization"].alias("hiringOrganization"), one["datePosted"].alias("datePosted"), one["jobLocationType"].alias("jobLocationType"), one["description"].alias("description"), F.array(address).alias("jobLocation")))
    script = lambda x: F.concat(F.lit('<html><script type="application/ld+json">'), x, F.lit("</script></html>"))
    graph = F.concat(F.lit('{"@graph":[{"@type":"WebSite"},{"mainEntity":'), listed, F.lit("}]}"))
    titled = F.concat(F.lit("<title>Data Clerk "), n, F.lit(" | Careers | Home</title><meta name='description' content='Work "), n, F.lit("'><script type=\"application/ld+json\">not json</script>"))
    html = F.when(F.col("k") % 4 == 3, titled).when(m == 2, script(graph)).otherwise(script(plain))
    return rows.select("k", F.concat(F.lit("Employer "), "cn").alias("company"), F.concat(F.lit("https://h"), (F.col("c") % 7).cast("string"), F.lit(".example/jobs/"), F.when(F.col("m") != 1, "data-intern-").otherwise("data-clerk-"), n, F.lit("/")).alias("url"), html.alias("html"), "n", (F.col("c") % 7).alias("host"))


_CITY = "CASE WHEN contains(place, ',') THEN split_part(place, ',', 1) ELSE place END"
_LAND = "CASE WHEN contains(place, ',') THEN trim(split_part(place, ',', 2)) END"
_ISO = "CASE " + " ".join(f"WHEN {_LAND} = '{n}' THEN '{c}'" for n, c in (("Germany", "DE"), ("Canada", "CA"), ("Japan", "JP"))) + " ELSE '' END"
_PAGES_SQL = f"""j AS ({_JOBS}), p AS (SELECT *, k % 4 <> 3 AS ld, c % 7 AS host, 'https://h' || c % 7 || '.example/jobs/' || CASE WHEN m <> 1 THEN 'data-intern-' ELSE 'data-clerk-' END || n || '/' AS url FROM j),
r AS (SELECT k, host, CASE WHEN ld THEN 'Holder ' || cn ELSE 'Employer ' || cn END AS company, 'Data Clerk ' || n AS role, CASE WHEN ld THEN place ELSE '' END AS location, CASE WHEN ld THEN strftime(moment, '%Y-%m-%d') ELSE '' END AS date, url AS link,
  (ld AND (k % 5 = 0 OR contains(lower({_CITY}), 'remote')))::VARCHAR AS is_remote, CASE WHEN ld AND m = 1 AND pay > 0 THEN pay END::DOUBLE AS salary_min, CASE WHEN ld AND m = 1 AND pay > 0 THEN 2 * pay END::DOUBLE AS salary_max, CASE WHEN ld AND m = 1 THEN 'USD' END AS salary_currency,
  CASE WHEN ld THEN {_ISO} ELSE '' END AS country_iso, CASE WHEN NOT ld THEN 'Work ' || n END AS description FROM p)"""


@query(f"""
WITH {_PAGES_SQL}, q AS (SELECT j.*, k % 4 <> 3 AS ld FROM j)
SELECT k, 'Data Clerk ' || n AS role, 'Holder ' || cn AS company, {_CITY} AS location, {_LAND} AS country, strftime(moment, '%Y-%m-%dT%H:%M') AS date, CASE WHEN m = 1 AND pay > 0 THEN pay END::DOUBLE AS salary_min, CASE WHEN m = 1 AND pay > 0 THEN 2 * pay END::DOUBLE AS salary_max, CASE WHEN m = 1 THEN 'usd' END AS salary_currency,
  k % 5 = 0 AS is_remote, 'Job ' || n || ' & more' AS description FROM q WHERE ld""")
def jsonld_fields(t: Tables) -> DataFrame:
    """Fields of postings in JSON-LD: plain, as lists, inside a graph."""
    return P.json_ld(_ld(t).select("k", "html"))


@query(f"WITH {_PAGES_SQL} SELECT * EXCLUDE (host) FROM r")
def page_postings(t: Tables) -> DataFrame:
    """Postings of pages, by JSON-LD or by the title."""
    rows = crawls.page_rows(cut(_ld(t)).select("company", "url", "html"))
    return rows.withColumn("k", F.regexp_extract("role", r"(\d+)$", 1).cast("long"))


@query(f"""
WITH {_PAGES_SQL}, s AS (SELECT *, row_number() OVER (PARTITION BY host ORDER BY k) AS i FROM r WHERE contains(link, 'intern') AND host < 5)
SELECT k, company, role, location, date, link FROM (SELECT s.*, i FROM s) WHERE i <= 25""".replace("company, role", "CASE WHEN location = '' THEN 'Host ' || host ELSE company END AS company, role"))
def host_harvest(t: Tables) -> DataFrame:
    """The first postings for beginners of each host that is asked for."""
    docs = cut(_ld(t))
    name = F.concat(F.lit("h"), F.col("host").cast("string"), F.lit(".example"))
    hosts = t.spark.range(5).select(F.concat(F.lit("Host "), F.col("id").cast("string")).alias("company"), F.concat(F.lit(" H"), F.col("id").cast("string"), F.lit(".EXAMPLE")).alias("host"))
    hosts = hosts.unionByName(hosts.withColumn("company", F.concat("company", F.lit(" again")))).unionByName(t.spark.range(1).select(F.lit("x").alias("company"), F.lit("nodot").alias("host")))
    skipped = docs.select(name.alias("host"), (F.col("k") - 1).alias("place"), F.concat("url", F.lit("apply/")).alias("url"))
    urls = docs.select(name.alias("host"), F.col("k").alias("place"), "url").unionByName(skipped)
    rows = crawls.harvest(hosts, docs.select("url", "html"), urls, 25)
    return rows.select(F.regexp_extract("role", r"(\d+)$", 1).cast("long").alias("k"), "company", "role", "location", "date", "link")


@query("""
WITH u AS (SELECT *, CASE o_orderkey % 4 WHEN 0 THEN 'data-intern' WHEN 1 THEN 'senior-clerk' WHEN 2 THEN 'new-grad-role' ELSE 'internal-tools' END || '-' || o_custkey || '-ab' || lpad((o_custkey % 1000)::VARCHAR, 3, '0') AS slug FROM orders)
SELECT o_custkey % 3 AS map, min(o_orderkey)::INT AS place, 'https://e.example/job/' || slug AS url FROM u WHERE o_orderkey % 4 IN (0, 2) GROUP BY 1, 3""")
def sitemap_candidates(t: Tables) -> DataFrame:
    """Addresses of a dated sitemap whose slugs name beginners' postings, each slug once."""
    kind = F.element_at(F.array(*[F.lit(x) for x in ("data-intern", "senior-clerk", "new-grad-role", "internal-tools")]), (F.col("o_orderkey") % 4 + 1).cast("int"))
    slug = F.concat(kind, F.lit("-"), F.col("o_custkey").cast("string"), F.lit("-ab"), F.lpad((F.col("o_custkey") % 1000).cast("string"), 3, "0"))
    entry = F.concat(F.lit("<url><loc>https://e.example/job/"), slug, F.lit("</loc>\n<lastmod> 2024-01-01 </lastmod></url><url><loc>https://e.example/about</loc><lastmod>x</lastmod></url>"))
    # a map comes in parts of bounded length, in the order of the keys; a row keeps its own key, never the part's
    part = F.floor(F.col("o_orderkey") / 1000).alias("part")
    maps = t.orders.select((F.col("o_custkey") % 3).alias("map"), part, "o_orderkey", entry.alias("e")).groupBy("map", "part").agg(F.sort_array(F.collect_list(F.struct("o_orderkey", "e"))).alias("x"))
    rows = crawls.dated_urls(maps.select("map", F.array_join("x.e", "").alias("xml"), F.col("x.o_orderkey").alias("keys")))
    placed = rows.select("map", F.element_at("keys", (F.col("place") / 2 + 1).cast("int")).alias("place"), "url")
    return crawls.early_candidates(placed, ["map"]).select("map", F.col("place").cast("int").alias("place"), "url")


@query("""SELECT 'https://r.example/explore/job/' || o_custkey || 'x' AS url, min(o_orderkey % 4)::INT AS shard FROM orders GROUP BY 1""")
def sharded_sitemap(t: Tables) -> DataFrame:
    """Distinct addresses over the shards of a sitemap."""
    entry = F.concat(F.lit("<loc> https://r.example/explore/job/"), F.col("o_custkey").cast("string"), F.lit("x </loc><loc>https://r.example/about</loc>"))
    shards = t.orders.select((F.col("o_orderkey") % 4).cast("int").alias("shard"), entry.alias("e")).groupBy("shard").agg(F.array_join(F.collect_list("e"), "").alias("xml"))
    return crawls.shard_urls(shards).select("url", "shard")


ROBOTS = f"""SELECT c_custkey AS id, 'tenant' || CAST(c_custkey AS STRING) AS tenant, 'User-agent: *' || sites.sites AS robots, c_custkey % 4 AS q FROM customer
JOIN (SELECT i, sites FROM {picked(["@Disallow: /Careers/@Disallow: /refreshFacet/x@ Disallow: /Ext_1/a", "@Disallow: /x", "@Allow: /Site/", "@Disallow: /Careers/@Disallow: /Careers/b"], 'sites')}) AS sites ON sites.i = c_custkey % 4"""


@query("""
WITH c AS (SELECT c_custkey, c_custkey % 4 AS q, 'tenant' || c_custkey AS tenant FROM customer), l AS (SELECT tenant, list_concat(CASE q WHEN 0 THEN ['Careers', 'Ext_1'] WHEN 3 THEN ['Careers'] ELSE [] END, [tenant, 'T' || tenant[2:]]) AS sites FROM c)
SELECT tenant, unnest(sites) AS site, (generate_subscripts(sites, 1) - 1)::INT AS place FROM l""")
def site_discovery(t: Tables) -> DataFrame:
    """Career sites that robots texts name, and the tenant's own names."""
    rows = t.sql(ROBOTS, "customer").withColumn("robots", F.replace("robots", F.lit("@"), F.lit("\n")))
    return crawls.career_sites(rows)


@query("""
SELECT page_id, host, path FROM (SELECT page_id, lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)) AS host, regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path FROM pages)
WHERE NOT ends_with(host, '.net') AND NOT (ends_with(host, '.com') AND starts_with(path, '/fr/') AND NOT starts_with(path, '/fr/1')) OR (ends_with(host, '.net') AND starts_with(path, '/en/'))""")
def robots_gate(t: Tables) -> DataFrame:
    """Pages whose address their host's robots text permits."""
    from feedmill.functions import url as U

    host, path = U.host(F.col("url")), U.path(F.col("url"))
    hosts = t.pages.select(host.alias("host")).distinct()
    text = F.when(F.col("host").endswith(".net"), "User-agent: other\nAllow: /\n\nUser-agent: *\nDisallow: /\nAllow: /en/").when(F.col("host").endswith(".com"), "User-agent: mill\nDisallow: /fr/\nAllow: /fr/1").otherwise("")
    rows = t.pages.select("page_id", host.alias("host"), path.alias("path"))
    return crawls.robots_permit(rows, hosts.select("host", text.alias("robots")), F.col("host"), F.col("path"), "Mill/1.0")
