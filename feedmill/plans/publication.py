"""The base query, the publication filter, cleaning chains and plans over postings made of orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmill.functions import classify as C
from feedmill.functions import geo as G
from feedmill.functions import text as T
from feedmill.functions import url as U
from feedmill.operators import dedup, feed, publish, reports, serve, union
from feedmill.plans.registry import Tables, query
from feedmill.plans.rules import picked

AS_OF = "2001-08-01 00:00:00"
ROLES = ["Software Intern", "Data Analyst, New Grad", "Nurse", "Senior Developer", "Ingénieur logiciel stage", "Welder Internship", "Senior Data Intern", "Test Engineer (m/w/d) Intern", ""]
COUNTRY = ["US", "DE", "", "CA", "FR"]
SPOTS = ["Austin, TX", "Berlin, Germany", "Remote", "Nowhere", "", "Toronto, on"]
BLOCKED = ("beta", "gamma corp")
#: Postings of the orders; every part is chosen by a remainder, so that both engines have the same.
POSTED = f"""SELECT o_orderkey AS k, CASE o_custkey % 7 WHEN 0 THEN 'Acme ' || CAST(o_custkey % 40 AS STRING) || 'x' WHEN 1 THEN 'beta careers' WHEN 2 THEN 'www.delta-works.com' WHEN 3 THEN 'Gamma Corp' WHEN 4 THEN '' WHEN 5 THEN 'FocusGroupPanel' ELSE 'Zürich AG' END AS company,
  role.role AS role, country.country AS country_iso, spot.spot AS location, CASE o_orderkey % 9 WHEN 0 THEN '' WHEN 1 THEN 'ftp://x.example/' || CAST(o_orderkey AS STRING) WHEN 2 THEN 'http://jobs.dice.com/' || CAST(o_orderkey AS STRING) ELSE 'http://x.example/' || CAST(o_orderkey % 400 AS STRING) || '?utm_source=a' END AS link,
  o_orderdate AS moment, o_orderkey % 4 AS m, CASE o_orderkey % 6 WHEN 0 THEN 'true' WHEN 1 THEN '1' ELSE 'no' END AS is_remote, o_totalprice AS price FROM orders
JOIN (SELECT i, role FROM {picked(ROLES, 'role')}) AS role ON role.i = (o_orderkey + o_custkey) % {len(ROLES)}
JOIN (SELECT i, country FROM {picked(COUNTRY, 'country')}) AS country ON country.i = o_custkey % {len(COUNTRY)}
JOIN (SELECT i, spot FROM {picked(SPOTS, 'spot')}) AS spot ON spot.i = (o_orderkey * 5 + o_custkey) % {len(SPOTS)}"""
_POSTED = POSTED.replace("AS STRING", "AS VARCHAR")
_INTERN, _GRAD = f"regexp_matches(role, '{C.INTERN_RE}', 'i')", f"regexp_matches(role, '{C.NEWGRAD_RE}', 'i')"
_BAD = "(regexp_matches(role, '\\bsenior\\s', 'i') AND NOT regexp_matches(role, '\\bsenior\\s.*(intern|co-op|apprentice|trainee)', 'i'))"
_COMPANY = "CASE WHEN starts_with(company, 'Acme') THEN company WHEN company = 'beta careers' THEN 'BETA' WHEN starts_with(company, 'www') THEN 'Delta Works' WHEN company = 'Zürich AG' THEN 'Z Rich Ag' WHEN company = 'FocusGroupPanel' THEN 'Focusgrouppanel' ELSE company END"


def _as_of() -> Column:
    return F.lit(AS_OF).cast("timestamp")


def _jobs(t: Tables) -> DataFrame:
    rows = t.sql(POSTED, "orders")
    return rows.select(F.col("k"), F.nullif("company", F.lit("")).alias("company"), F.col("role").alias("title"), F.nullif("location", F.lit("")).alias("location"), "country_iso", F.nullif("link", F.lit("")).alias("url"), F.date_format("moment", "yyyy-MM-dd HH:mm:ss").alias("posted_at"))


_BASE = f"""WITH p AS ({_POSTED}), b AS (SELECT k, nullif(company, '') AS company, role, nullif(location, '') AS location, country_iso, nullif(link, '') AS link, moment AS date, {_INTERN} AS intern, {_GRAD} AS grad, {_BAD} AS bad FROM p),
f AS (SELECT *, row_number() OVER (PARTITION BY company, role, location ORDER BY date DESC, link) AS rn FROM b WHERE (intern OR grad) AND date >= TIMESTAMP '{AS_OF}' - INTERVAL (DAYS) DAY AND link IS NOT NULL AND company IS NOT NULL AND role NOT ILIKE '%(m/w/d)%' EXTRA)
SELECT role, date, link, CASE WHEN intern AND location IS NOT NULL AND NOT bad THEN 'internship' WHEN grad AND location IS NOT NULL AND NOT bad THEN 'new_grad' ELSE 'other' END AS job_type, k, company, location, country_iso FROM f WHERE rn = 1 AND lower(company) <> 'focusgrouppanel'"""


@query(_BASE.replace("(DAYS)", "600").replace("EXTRA", "AND regexp_matches(role, '^[\\x00-\\x7F]+$') AND country_iso NOT IN " + str(G.EXCLUDED)))
def narrow_feed(t: Tables) -> DataFrame:
    """The base query as the narrow feed asks it: few days, ASCII titles, without the countries that are left out."""
    title = F.col("title")
    return feed.base_query(_jobs(t), C.is_intern(title), C.is_new_grad(title), 600, _as_of(), C.excluded(title), T.is_ascii(title) & ~feed.outside_feed(F.col("country_iso")))


@query(_BASE.replace("(DAYS)", "1500").replace("EXTRA", ""))
def broad_feed(t: Tables) -> DataFrame:
    """The base query as the broad feed asks it."""
    title = F.col("title")
    return feed.base_query(_jobs(t), C.is_intern(title), C.is_new_grad(title), 1500, _as_of(), C.excluded(title))


def _raw(t: Tables) -> DataFrame:
    """Postings for the publication filter: a few carry ids, dates are texts, some of them junk."""
    rows = t.sql(POSTED, "orders")
    kind = F.when(F.col("m") == 0, "Site").otherwise("")
    date = F.when(F.col("k") % 11 == 0, "soon").otherwise(F.date_format("moment", "yyyy-MM-dd"))
    return rows.select("k", "company", F.col("role"), "location", "link", date.alias("date"), kind.alias("ats_type"), F.when(F.col("m") == 0, (F.col("k") % 300).cast("string")).otherwise("").alias("ats_id"), "country_iso", "is_remote", F.col("price").cast("string").alias("salary_min"), "moment")


_JUDGED = f"""p AS ({_POSTED}), c AS (SELECT *, {_COMPANY} AS shown, CASE WHEN starts_with(link, 'http://x') THEN 'https://x.example/' || (k % 400) ELSE '' END AS shown_link, CASE WHEN k % 11 = 0 THEN NULL ELSE date_diff('second', date_trunc('day', moment), TIMESTAMP '{AS_OF}') // 86400 END AS days FROM p),
w AS (SELECT *, CASE WHEN shown_link = '' THEN 'no_apply_link' WHEN shown = '' THEN 'empty_company' WHEN lower(shown) IN {BLOCKED} THEN 'blocked_company' WHEN NOT regexp_matches(role, '^[\\x00-\\x7F]*$') THEN 'non_english' WHEN days > 900 THEN 'inactive' END AS reason,
  CASE WHEN shown = '' THEN 'no_company' WHEN shown_link = '' THEN 'no_link' WHEN lower(shown) IN {BLOCKED} THEN 'blocked' WHEN NOT regexp_matches(role, '^[\\x00-\\x7F]*$') THEN 'foreign' WHEN days > 900 THEN 'inactive' END AS page_reason FROM c)"""


@query(f"""
WITH RECURSIVE {_JUDGED}, g AS (SELECT *, CASE WHEN m = 0 THEN (k % 300)::VARCHAR END AS a, (k % 400)::VARCHAR AS b, k % 4 AS part, row_number() OVER (PARTITION BY k % 4 ORDER BY k) AS i FROM w WHERE reason IS NULL),
s AS (SELECT reason, count(*)::BIGINT AS n FROM w WHERE reason IS NOT NULL GROUP BY 1),
r AS (SELECT part, k, i, CASE WHEN a IS NULL THEN [] ELSE [a] END AS sa, [b] AS sb, true AS keep FROM g WHERE i = 1
  UNION ALL SELECT g.part, g.k, g.i, CASE WHEN list_contains(r.sa, g.a) OR list_contains(r.sb, g.b) OR g.a IS NULL THEN r.sa ELSE list_append(r.sa, g.a) END, CASE WHEN coalesce(list_contains(r.sa, g.a), false) OR list_contains(r.sb, g.b) THEN r.sb ELSE list_append(r.sb, g.b) END,
    NOT (coalesce(list_contains(r.sa, g.a), false) OR list_contains(r.sb, g.b)) FROM r JOIN g ON g.part = r.part AND g.i = r.i + 1)
SELECT reason, n FROM s UNION ALL SELECT 'duplicate', count(*)::BIGINT FROM r WHERE NOT keep HAVING count(*) > 0 UNION ALL SELECT 'kept', count(*)::BIGINT FROM r WHERE keep""")
def reject_reasons(t: Tables) -> DataFrame:
    """Rows refused by the first reason that holds, duplicates and what is published, counted."""
    out, counts = publish.publish(_raw(t), _as_of(), BLOCKED, 900, "k")
    return counts.unionByName(out.agg(F.count("*").alias("n")).select(F.lit("kept").alias("reason"), "n"))


@query(f"""
WITH RECURSIVE {_JUDGED}, g AS (SELECT *, CASE WHEN m = 0 THEN (k % 300)::VARCHAR END AS a, (k % 400)::VARCHAR AS b, k % 4 AS part, row_number() OVER (PARTITION BY k % 4 ORDER BY k) AS i FROM w WHERE reason IS NULL),
r AS (SELECT part, k, i, CASE WHEN a IS NULL THEN [] ELSE [a] END AS sa, [b] AS sb, true AS keep FROM g WHERE i = 1
  UNION ALL SELECT g.part, g.k, g.i, CASE WHEN list_contains(r.sa, g.a) OR list_contains(r.sb, g.b) OR g.a IS NULL THEN r.sa ELSE list_append(r.sa, g.a) END, CASE WHEN coalesce(list_contains(r.sa, g.a), false) OR list_contains(r.sb, g.b) THEN r.sb ELSE list_append(r.sb, g.b) END,
    NOT (coalesce(list_contains(r.sa, g.a), false) OR list_contains(r.sb, g.b)) FROM r JOIN g ON g.part = r.part AND g.i = r.i + 1)
SELECT k, shown AS company, role, shown_link AS link, CASE WHEN m = 0 THEN 'site:' || (k % 300) ELSE 'url:' || substr(sha1('x.example/' || (k % 400)), 1, 16) END AS id FROM r JOIN g USING (k) WHERE keep""")
def publish_feed(t: Tables) -> DataFrame:
    """Postings through the whole publication filter: refusals, identity, first-fit, ids."""
    out, _ = publish.publish(_raw(t), _as_of(), BLOCKED, 900, "k")
    return out.select("k", "company", "role", "link", "id")


@query(f"""WITH {_JUDGED} SELECT coalesce(page_reason, 'kept') AS reason, count(*)::BIGINT AS n FROM w GROUP BY 1""")
def table_page_rows(t: Tables) -> DataFrame:
    """Rows that the table pages take, by their own reasons and without deduplication."""
    rows = _raw(t).withColumns({"link": U.display(F.col("link")), "company": T.clean_company(F.col("company")), "role": T.clean_role(F.col("role"))})
    from feedmill.functions import dates as D

    reason = feed.table_refusal(F.col("link"), F.col("company"), F.col("role"), D.parse(F.col("date")), _as_of(), BLOCKED, 900)
    return rows.groupBy(F.coalesce(reason, F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))


@query(f"""WITH {_JUDGED} SELECT count(*) FILTER (WHERE NOT starts_with(link, 'http'))::BIGINT AS no_http_link, count(*) FILTER (WHERE starts_with(link, 'http') AND shown_link = '')::BIGINT AS unusable_http_link, count(*) FILTER (WHERE shown_link = '')::BIGINT AS linkless FROM w""")
def link_rejections(t: Tables) -> DataFrame:
    """Rows without a usable link, by cause."""
    return feed.link_rejections(_raw(t))


@query(f"""
WITH p AS ({_POSTED}), s AS (SELECT *, CASE WHEN starts_with(link, 'http://x') THEN 'x.example/' || (k % 400) WHEN starts_with(link, 'http') THEN 'jobs.dice.com/' || k ELSE '' END AS url FROM p
  WHERE (country_iso <> '' OR regexp_matches(location, '\\b({"|".join(G.US_PLACES)})\\b', 'i') OR regexp_matches(location, '\\bremote\\b', 'i') OR is_remote IN ('true', '1')) AND location <> '')
SELECT k, CASE WHEN url = '' THEN 0 ELSE 1 END AS scope_rank FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY k) AS rn FROM s) WHERE url = '' OR rn = 1""")
def feed_scope(t: Tables) -> DataFrame:
    """Postings that are placed, American or remote, one for each canonical link; those without a link go first."""
    return union.scoped(_raw(t), "k").select("k", "scope_rank")


@query(f"""
WITH p AS ({_POSTED}), c AS (SELECT *, {_COMPANY} AS shown FROM p)
SELECT k, shown AS company, trim(role) AS role, CASE location WHEN 'Toronto, on' THEN 'Toronto, ON' WHEN '' THEN 'N/A' ELSE location END AS location, CASE WHEN country_iso <> '' THEN country_iso WHEN location IN ('Austin, TX') THEN 'US' WHEN location = 'Berlin, Germany' THEN 'DE' WHEN location = 'Toronto, on' THEN 'CA' ELSE '' END AS country_iso
FROM c WHERE shown <> '' AND role <> '' AND regexp_matches(role, '^[\\x00-\\x7F]*$') AND regexp_matches(lower(role), '{"|".join(C.TECH_TERMS)}') AND lower(shown) NOT IN {BLOCKED}""")
def supplement_clean(t: Tables) -> DataFrame:
    """Rows of a supplementary source that may join a feed."""
    return feed.supplement(_raw(t), BLOCKED).select("k", "company", "role", "location", "country_iso")


SALARIES = f"""SELECT o_orderkey AS k, CASE o_orderkey % 7 WHEN 0 THEN '$' || CAST(o_custkey AS STRING) || ',000' WHEN 1 THEN 'nan' WHEN 2 THEN CAST(o_custkey AS STRING) || 'k' WHEN 3 THEN 'USD 12,5' || CAST(o_custkey AS STRING) || '.50 - 99' WHEN 4 THEN '-5' WHEN 5 THEN 'DOE' ELSE '0' END AS salary_min,
  CASE o_custkey % 4 WHEN 0 THEN 'NaN' WHEN 1 THEN 'none' WHEN 2 THEN ' 2024-01-05 ' ELSE '-' END AS date, CASE o_custkey % 3 WHEN 0 THEN 'nan' WHEN 1 THEN 'NaT' ELSE 'none' END AS role, o_custkey AS extra, o_orderkey % 7 AS q, o_custkey % 4 AS d FROM orders"""


@query(f"""
WITH s AS ({SALARIES.replace("AS STRING", "AS VARCHAR")}), v AS (SELECT *, CASE q WHEN 0 THEN (extra || '000')::DOUBLE WHEN 2 THEN extra * 1000.0 WHEN 3 THEN ('125' || extra || '.50')::DOUBLE END AS v FROM s)
SELECT k, CASE WHEN role = 'none' THEN 'none' END AS role, CASE WHEN d = 2 THEN '2024-01-05' ELSE '' END AS date, CASE WHEN v > 0 THEN v END::DOUBLE AS salary_min, CAST(NULL AS DOUBLE) AS salary_max, 'mill' AS source, '2024-02-01' AS observed_at, extra FROM v""")
def canonical_rows(t: Tables) -> DataFrame:
    """Stamped rows in the canonical types and order, without columns of the engine's own."""
    rows = t.sql(SALARIES, "orders").withColumn("_own", F.lit(1)).drop("q", "d")
    out = feed.published_columns(feed.canonical(feed.stamped(rows, "mill", "2024-02-01")))
    if out.columns != ["role", "date", "salary_min", "salary_max", "source", "observed_at", "k", "extra"]:
        raise ValueError(f"columns are out of order: {out.columns}")
    return out


@query(f"""
WITH p AS ({_POSTED}) SELECT CASE WHEN m = 0 THEN 'Site:' || (k % 300) ELSE 'u:' || substr(sha1(lower(link)), 1, 16) END AS id, k, nullif(company, '') AS company, nullif(role, '') AS role, nullif(location, '') AS location, nullif(link, '') AS link,
  is_remote IN ('true', '1') AS is_remote, round(price, 2)::DOUBLE AS salary_min, trim(role || ' at ' || company) AS description, length(trim(role || ' at ' || company))::INT AS description_chars FROM p WHERE company <> '' OR role <> ''""")
def detail_projection(t: Tables) -> DataFrame:
    """Everything that a posting has, as the service shows it."""
    rows = _raw(t).filter("company <> '' or role <> ''").withColumn("description", F.concat(F.col("role"), F.lit(" at "), F.col("company"), F.lit("  ")))
    got = serve.detail(rows.withColumn("category", F.lit("")), "k")
    return got.select("id", "k", "company", "role", "location", "link", "is_remote", F.round("salary_min", 2).alias("salary_min"), "description", "description_chars")


@query(f"""
WITH {_JUDGED}, r AS (SELECT *, CASE WHEN length(shown) > 20 THEN substr(shown, 1, 17) || '...' ELSE shown END AS cut, lag(shown) OVER (PARTITION BY k % 50 ORDER BY k) AS above FROM w WHERE page_reason IS NULL)
SELECT k, '<a href="' || shown_link || '">' || CASE WHEN shown = above THEN '↳ ' ELSE '' END || '<strong>' || cut || '</strong></a>' AS company_cell, '<td>' || role || '</td>' AS role_cell, CASE m WHEN 0 THEN 'role' WHEN 1 THEN 'company' ELSE '' END AS visa FROM r""")
def display_cells(t: Tables) -> DataFrame:
    """Cells of the table pages; an employer like the one above has an arrow."""
    from feedmill.functions import dates as D

    rows = _raw(t).withColumns({"link": U.display(F.col("link")), "company": T.clean_company(F.col("company")), "role": T.clean_role(F.col("role")), "m": F.col("k") % 4})
    rows = rows.filter(feed.table_refusal(F.col("link"), F.col("company"), F.col("role"), D.parse(F.col("date")), _as_of(), BLOCKED, 900).isNull())
    rows = feed.previous_rows(rows, F.col("k") % 50, [F.col("k")], ["company"])
    shown = T.truncate(F.col("company"), 20)
    return rows.select(
        "k", T.company_cell(shown, F.col("link"), F.col("repeated"), F.when(shown != F.col("company"), F.col("company")).otherwise("")).alias("company_cell"), T.role_cell(F.col("role")).alias("role_cell"),
        T.visa_cell(F.when(F.col("m") == 0, "x").otherwise(""), F.when(F.col("m") == 1, "true").otherwise("")).alias("visa"),
    )


@query(f"""WITH p AS ({_POSTED}) SELECT k, strftime(moment, '%Y-%m-%d') AS date FROM p WHERE starts_with(link, 'http') AND m > 1 AND job_ok ORDER BY date DESC, k LIMIT 50""".replace("job_ok", "k % 3 <> 2"))
def enrichment_plan(t: Tables) -> DataFrame:
    """The newest rows that are worth a fetch of their description."""
    rows = t.sql(POSTED, "orders").withColumns({"date": F.date_format("moment", "yyyy-MM-dd"), "description": F.when(F.col("m") > 1, " ").otherwise("text"), "job_type": F.when(F.col("k") % 3 == 0, "Internship").when(F.col("k") % 3 == 2, "other").otherwise("")})
    return feed.enrichment_plan(rows, 50, "k").select("k", "date")


@query("""
WITH b AS (SELECT c_custkey, coalesce(s.moment, 0) AS moment FROM customer LEFT JOIN (SELECT o_custkey, epoch(max(o_orderdate)) AS moment FROM orders WHERE o_orderkey % 3 = 0 GROUP BY 1) s ON s.o_custkey = c_custkey)
SELECT c_custkey, row_number() OVER (ORDER BY moment, c_custkey) <= 60 AS chosen FROM b""")
def oldest_first(t: Tables) -> DataFrame:
    """The boards longest unvisited, those never visited before all."""
    state = t.orders.filter("o_orderkey % 3 = 0").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.unix_timestamp(F.max("o_orderdate").cast("timestamp")).cast("double").alias("at"))
    return feed.oldest_first(t.customer.select("c_custkey"), state, ["c_custkey"], "at", "c_custkey", 60).select("c_custkey", "chosen")


@query(f"""WITH p AS ({_POSTED}) SELECT k, link FROM p WHERE k % 7 <> 1 AND starts_with(link, 'http') ORDER BY k LIMIT 200""")
def new_sample(t: Tables) -> DataFrame:
    """A bounded sample of new linked postings, in order of key."""
    rows = t.sql(POSTED, "orders").select("k", "link")
    return feed.new_sample(rows, rows.filter("k % 7 = 1"), "k", 200)


PROBES = """SELECT c_custkey AS id, 'ats' || CAST(c_custkey % 3 AS STRING) AS ats, 'b' || CAST(c_custkey AS STRING) AS slug, CASE c_custkey % 3 WHEN 0 THEN 'priority' WHEN 1 THEN 'standard' ELSE 'bulk' END AS lane, c_custkey AS ordinal, c_custkey % 5 AS v, (c_custkey * 7) % 100 AS h, c_custkey % 60 AS r FROM customer"""
_PROBED = f"""b AS ({PROBES.replace("AS STRING", "AS VARCHAR")}), s AS (SELECT *, CASE v WHEN 0 THEN NULL WHEN 1 THEN h / 20.0::DOUBLE ELSE h * 2.0::DOUBLE END AS hours, CASE WHEN v = 0 THEN 0 WHEN v = 2 THEN 0 ELSE r END AS rows, CASE WHEN v = 2 THEN 3 ELSE 0 END AS zero FROM b)"""


@query(f"""
WITH {_PROBED}, d AS (SELECT *, CASE WHEN hours < 4 THEN 'cooldown' WHEN zero >= 3 AND hours < 168 THEN 'parked' END AS state, CASE WHEN coalesce(hours, 144) >= 72 THEN 1e9 + coalesce(hours, 144) ELSE hours * (1 + least(rows, 500) / 50.0::DOUBLE) * CASE lane WHEN 'priority' THEN 3.0 WHEN 'standard' THEN 1.0 ELSE 0.2 END::DOUBLE END AS score FROM s),
q AS (SELECT ats, slug FROM d WHERE state IS NULL ORDER BY score DESC, ordinal LIMIT 70)
SELECT d.ats, d.slug, coalesce(state, CASE WHEN q.slug IS NOT NULL THEN 'probe' ELSE 'deferred' END) AS decision FROM d LEFT JOIN q ON q.ats = d.ats AND q.slug = d.slug""")
def probe_plan(t: Tables) -> DataFrame:
    """Which boards to visit: cooldown, parking with probation, score, cap."""
    boards, state = _probes(t)
    return feed.probe_plan(boards, state, 1e9, 70, 4.0)


def _probes(t: Tables) -> tuple[DataFrame, DataFrame]:
    rows = t.sql(PROBES, "customer")
    hours = F.when(F.col("v") == 1, F.col("h") / 20.0).otherwise(F.col("h") * 2.0)
    state = rows.filter("v <> 0").select("ats", "slug", (1e9 - hours * 3600.0).alias("at"), F.when(F.col("v") == 2, 0).otherwise(F.col("r")).cast("long").alias("rows"), F.when(F.col("v") == 2, 3).otherwise(0).alias("zero"))
    return rows.select("ats", "slug", "lane", "ordinal"), state


@query(f"""
WITH {_PROBED} SELECT ats, slug, CASE WHEN id % 4 = 0 THEN 1e9 ELSE round(1e9 - hours * 3600.0, 3) END::DOUBLE AS at, CASE WHEN id % 4 = 0 THEN CASE WHEN id % 8 = 0 THEN 0 ELSE 9 END ELSE rows END::BIGINT AS rows, CASE WHEN id % 4 <> 0 THEN zero WHEN id % 8 = 0 THEN zero + 1 ELSE 0 END::INT AS zero FROM s WHERE v <> 0 OR id % 4 = 0""")
def probe_state(t: Tables) -> DataFrame:
    """Boards' state after the visits of a run."""
    boards, state = _probes(t)
    probes = boards.filter("ordinal % 4 = 0").select("ats", "slug", F.when(F.col("ordinal") % 8 == 0, 0).otherwise(9).alias("rows"))
    return feed.recorded_probe(state, probes, 1e9).withColumn("at", F.round("at", 3))


@query("""
WITH RECURSIVE b AS (SELECT o_orderkey AS k, CASE o_orderkey % 5 WHEN 0 THEN '' ELSE 'l' || o_custkey || '-' || o_orderkey % 6 END AS a, 'k' || o_custkey || o_orderstatus AS b, o_custkey AS c, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS i FROM orders WHERE o_orderkey % 2 = 0),
f AS (SELECT o_orderkey, 'l' || o_custkey || '-' || o_orderkey % 6 AS a, 'k' || o_custkey || o_orderstatus AS b FROM orders WHERE o_orderkey % 7 = 1),
r AS (SELECT c, k, i, a, b, [a] AS sa, [b] AS sb, true AS keep FROM b WHERE i = 1
  UNION ALL SELECT b.c, b.k, b.i, b.a, b.b, CASE WHEN (b.a <> '' AND list_contains(r.sa, b.a)) OR list_contains(r.sb, b.b) THEN r.sa ELSE list_append(r.sa, b.a) END, CASE WHEN (b.a <> '' AND list_contains(r.sa, b.a)) OR list_contains(r.sb, b.b) THEN r.sb ELSE list_append(r.sb, b.b) END,
    NOT ((b.a <> '' AND list_contains(r.sa, b.a)) OR list_contains(r.sb, b.b)) FROM r JOIN b ON b.c = r.c AND b.i = r.i + 1)
SELECT CASE WHEN NOT keep THEN 'duplicate' WHEN a <> '' AND a IN (SELECT a FROM f) THEN 'link' WHEN b IN (SELECT b FROM f) THEN 'key' ELSE 'new' END AS matched, count(*)::BIGINT AS n FROM r GROUP BY 1""")
def known_by(t: Tables) -> DataFrame:
    """Rows of a batch by how the feed knows them."""
    link = F.concat(F.lit("l"), F.col("o_custkey").cast("string"), F.lit("-"), (F.col("o_orderkey") % 6).cast("string"))
    key = F.concat(F.lit("k"), F.col("o_custkey").cast("string"), "o_orderstatus")
    batch = t.orders.filter("o_orderkey % 2 = 0").select("o_orderkey", F.when(F.col("o_orderkey") % 5 == 0, "").otherwise(link).alias("link"), key.alias("key"))
    return reports.known_by(batch, t.orders.filter("o_orderkey % 7 = 1").select(link.alias("link"), key.alias("key")), "link", "key", "o_orderkey").groupBy("matched").agg(F.count("*").alias("n"))


@query("""
WITH l AS (SELECT source, md5(text) AS link FROM documents), d AS (SELECT DISTINCT source, link FROM l), o AS (SELECT link, count(*) AS owners FROM d GROUP BY 1)
SELECT source, (SELECT count(*) FROM l x WHERE x.source = d.source)::BIGINT AS rows, count(*)::BIGINT AS distinct, count(*) FILTER (WHERE owners = 1)::BIGINT AS sole FROM d JOIN o USING (link) GROUP BY 1""".replace(" AS distinct", ' AS "distinct"'))
def source_yield(t: Tables) -> DataFrame:
    """What each source has, and what it alone has."""
    return reports.source_yield(t.documents.select("source", F.md5("text").alias("link")), "source", "link")


@query("""
WITH s AS (SELECT event_type AS source, count(*) FILTER (WHERE value > 90)::BIGINT AS new, count(*)::BIGINT AS rows FROM events GROUP BY 1)
SELECT source, new, rows, round(100.0::DOUBLE * new / greatest(sum(new) OVER (), 1), 2)::DOUBLE AS share_of_new_pct, list_concat(list_concat(CASE WHEN source = 'click' THEN ['failing'] ELSE [] END, CASE WHEN source = 'view' THEN ['quiet'] ELSE [] END), CASE WHEN source = 'error' THEN ['degraded'] ELSE [] END) AS alerts, false AS healthy FROM s""")
def health_payload(t: Tables) -> DataFrame:
    """Shares of what is new, alerts and the run's health."""
    stats = t.events.groupBy(F.col("event_type").alias("source")).agg(F.count_if(F.col("value") > 90).alias("new"), F.count("*").alias("rows"))
    return reports.health(stats.withColumns({"status": F.when(F.col("source") == "error", "failed").otherwise("ok"), "failing": F.col("source") == "click", "quiet_hours": F.when(F.col("source") == "view", 99.0)}))


@query("""
WITH v AS (SELECT user_id, value FROM events WHERE value > 50), r AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY value) AS i, count(*) OVER (PARTITION BY user_id) AS n FROM v),
p AS (SELECT user_id, any_value(n)::BIGINT AS n, max(value) FILTER (WHERE i = n // 2 + 1) AS middle FROM r GROUP BY 1) SELECT u.user_id, coalesce(middle, 0.0)::DOUBLE AS middle FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN p USING (user_id)""")
def upper_medians(t: Tables) -> DataFrame:
    """Upper medians of the positive values."""
    return t.events.groupBy("user_id").agg(reports.upper_median(F.collect_list(F.col("value") - F.when(F.col("value") > 50, 0).otherwise(1000))).cast("double").alias("middle"))


FILED = f"""SELECT p_partkey AS k, CAST(floor(p_retailprice) AS BIGINT) AS pay, p_brand AS brand, name.name AS title, p_partkey % 5 AS q FROM part JOIN (SELECT i, name FROM {picked(["software engineer", "data analyst", "nurse", "job title", ""], 'name')}) AS name ON name.i = p_size % 5"""


@query(f"""
WITH f AS ({FILED}), t AS (SELECT brand AS key, upper(title) AS title, count(*)::BIGINT AS n, floor(median(CASE WHEN q <> 0 THEN pay END))::BIGINT AS median_salary FROM f WHERE title NOT IN ('', 'job title') GROUP BY 1, 2)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY n DESC, title)::BIGINT AS place FROM t) WHERE place <= 2""")
def filing_titles(t: Tables) -> DataFrame:
    """Commonest titles of filings with the whole median of their pay."""
    pay = F.when(F.col("q") == 0, "n/a").otherwise(F.format_string("$%,d", "pay"))
    row = F.concat(F.lit("<tr class=r>\n<td><a>X</a></td><td> "), F.replace("title", F.lit(" "), F.lit("\n ")), F.lit(" </td><td>"), pay, F.lit("</td><td>Reno</td></tr><tr><td>two</td><td>cells</td></tr>"))
    pages = t.sql(FILED, "part").select(F.col("brand").alias("key"), row.alias("r")).groupBy("key").agg(F.concat(F.lit("<table><tr><th>a</th></tr>"), F.array_join(F.collect_list("r"), ""), F.lit("</table>")).alias("html"))
    return reports.filings(pages, 2)


SPONSORS = f"""SELECT c_custkey AS k, name.name AS name, CASE c_custkey % 4 WHEN 0 THEN '' WHEN 1 THEN 'x' ELSE CAST(c_custkey % 9 AS STRING) END AS a, CAST(c_custkey % 3 AS STRING) AS b, c_custkey % 4 AS q FROM customer JOIN (SELECT i, name FROM {picked(["Acme, Inc.", "ACME LLC", "Beta Co. Ltd", "beta", "", "The Co"], 'name')}) AS name ON name.i = c_nationkey % 6"""


@query(f"""
WITH s AS ({SPONSORS.replace("AS STRING", "AS VARCHAR")}), n AS (SELECT CASE WHEN lower(name) LIKE 'acme%' THEN 'acme' WHEN lower(name) LIKE 'beta%' THEN 'beta' WHEN name = '' THEN '' ELSE 'the' END AS name, CASE q WHEN 0 THEN k % 3 WHEN 1 THEN 0 ELSE k % 9 + k % 3 END AS n FROM s)
SELECT name, sum(n)::BIGINT AS approvals FROM n WHERE name <> '' AND n > 0 GROUP BY 1""")
def sponsor_approvals(t: Tables) -> DataFrame:
    """Approvals by normalised employer over the years' files; rows that can't be read don't count."""
    years = t.sql(SPONSORS, "customer").select(F.col("name").alias("Employer"), F.col("a").alias("Initial Approval"), F.col("b").alias("Continuing Approval"))
    return reports.sponsor_totals(years)


@query("""SELECT family, count(*)::BIGINT AS total FROM (SELECT coalesce(lang, 'Other Professional') AS family FROM documents UNION ALL SELECT source FROM documents WHERE n_chars > 500 UNION ALL SELECT 'long' FROM documents WHERE n_chars > 5000) GROUP BY 1""")
def family_coverage(t: Tables) -> DataFrame:
    """Rows by family: the primary one and each further one."""
    more = F.array_compact(F.array(F.col("lang"), F.when(F.col("n_chars") > 500, F.col("source")), F.when(F.col("n_chars") > 5000, F.lit("long"))))
    return publish.coverage_with_families(t.documents.select("lang", more.alias("families")), "lang", "families")


@query("""
WITH d AS (SELECT lang, CASE WHEN doc_id % 3 = 0 THEN 'nan' WHEN doc_id % 3 = 1 THEN ' ' END AS kind FROM documents), c AS (SELECT count(*) AS n, count(lang) AS a, count(*) FILTER (WHERE kind = 'nan') AS b FROM d)
SELECT 'lang' AS field, a::BIGINT AS filled, round(100.0::DOUBLE * a / n, 2)::DOUBLE AS pct FROM c UNION ALL SELECT 'kind', b::BIGINT, round(100.0::DOUBLE * b / n, 2)::DOUBLE FROM c""")
def shard_fields(t: Tables) -> DataFrame:
    """Fill of fields as shards count it: a placeholder is a text like any other."""
    rows = t.documents.withColumn("kind", F.when(F.col("doc_id") % 3 == 0, "nan").when(F.col("doc_id") % 3 == 1, " "))
    return publish.shard_fill(rows, ["lang", "kind"])


STATES = ["ok", "ok:recovered", "seeded", "rejected:empty", "rejected:shrunken", "empty"]
SIDES = f"""SELECT s_suppkey AS id, CASE WHEN s_suppkey < 9 THEN name.name ELSE 'src' || CAST(s_suppkey AS STRING) END AS file_source, CASE s_suppkey % 5 WHEN 4 THEN 'other' WHEN 3 THEN '' ELSE CASE WHEN s_suppkey < 9 THEN name.name ELSE 'src' || CAST(s_suppkey AS STRING) END END AS source, status.status AS status,
  CASE s_suppkey % 4 WHEN 3 THEN 'cache_mtime' WHEN 2 THEN NULL ELSE 'fetch' END AS provenance, s_suppkey % 7 * 10 AS rows, (s_suppkey * 13) % 90 - 5 AS age FROM supplier
JOIN (SELECT i, name FROM {picked(list(union.CLASS_OF), 'name')}) AS name ON name.i = s_suppkey % 9 JOIN (SELECT i, status FROM {picked(STATES, 'status')}) AS status ON status.i = s_suppkey % 6"""
_TTL = "CASE file_source " + " ".join(f"WHEN '{n}' THEN {union.TTL_HOURS[c]}" for n, c in union.CLASS_OF.items()) + " ELSE 168 END"


_SIDED = f"""s AS ({SIDES.replace("AS STRING", "AS VARCHAR")}), j AS (SELECT *, {_TTL} AS ttl, provenance IS NULL AND status IN ('ok', 'ok:recovered') AS legacy, list_contains({list(union.CLASS_OF)}, file_source) AS known, coalesce(nullif(source, ''), file_source) = file_source AS source_match FROM s),
o AS (SELECT *, source_match AND known AND (provenance = 'fetch' OR legacy) IS TRUE AS pok FROM j), f AS (SELECT *, pok AND age BETWEEN 0 AND ttl AND status IN ('ok', 'ok:recovered') AS fresh, pok AND age BETWEEN 0 AND ttl AND (status IN ('ok', 'ok:recovered') OR (starts_with(status, 'rejected:') AND rows > 0)) AS servable FROM o)"""


def _sides(t: Tables) -> DataFrame:
    now = F.lit("2024-02-01 12:00:00").cast("timestamp")
    rows = t.sql(SIDES, "supplier").withColumn("fetched_at", F.timestamp_seconds(F.unix_timestamp(now) - F.col("age") * 3600))
    return union.sidecars(rows, now)


@query(f"""WITH {_SIDED} SELECT id, file_source, ttl::DOUBLE AS ttl_hours, legacy AS provenance_legacy, known, source_match, age::DOUBLE AS age_hours, pok AS provenance_ok, fresh, servable FROM f""")
def sidecar_states(t: Tables) -> DataFrame:
    """What follows from the records of snapshots: trust, class, age, freshness."""
    return _sides(t).select("id", "file_source", "ttl_hours", "provenance_legacy", "known", "source_match", "age_hours", "provenance_ok", "fresh", "servable")


@query(f"""
WITH {_SIDED}, n AS (SELECT list_sort(list(DISTINCT file_source)) AS have, list_sort(list(DISTINCT file_source) FILTER (WHERE fresh)) AS fresh, list_sort(list(DISTINCT file_source) FILTER (WHERE NOT fresh AND status <> 'empty' AND NOT starts_with(status, 'rejected:'))) AS expired,
  list_sort(list(DISTINCT file_source) FILTER (WHERE status = 'empty')) AS empty, list_sort(list(DISTINCT file_source) FILTER (WHERE starts_with(status, 'rejected'))) AS rejected, list_sort(list(DISTINCT file_source) FILTER (WHERE NOT pok)) AS invalid,
  list_sort(list(DISTINCT file_source) FILTER (WHERE status = 'seeded')) AS seeded, list_sort(list(DISTINCT file_source) FILTER (WHERE legacy)) AS legacy_provenance, list_sort(list(DISTINCT file_source) FILTER (WHERE servable AND NOT fresh)) AS serving_previous,
  coalesce(sum(rows) FILTER (WHERE fresh), 0)::BIGINT AS rows_fresh, coalesce(sum(rows) FILTER (WHERE servable), 0)::BIGINT AS rows_eligible FROM f)
SELECT coalesce(fresh, []) AS fresh, coalesce(expired, []) AS expired, coalesce(empty, []) AS empty, coalesce(rejected, []) AS rejected, coalesce(invalid, []) AS invalid, coalesce(seeded, []) AS seeded, coalesce(legacy_provenance, []) AS legacy_provenance, coalesce(serving_previous, []) AS serving_previous,
  rows_fresh, rows_eligible, list_sort(list_filter(['heavy', 'jobhive', 'absent'], lambda x: NOT list_contains(have, x))) AS missing, list_sort(list_filter(have, lambda x: x NOT IN ('heavy', 'jobhive', 'absent', 'rss'))) AS unexpected FROM n""")
def sidecar_report(t: Tables) -> DataFrame:
    """Name lists of the snapshots of a run."""
    return union.sidecar_report(_sides(t), ("heavy", "jobhive", "absent"), ("rss",))
