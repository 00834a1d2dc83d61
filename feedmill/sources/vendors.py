"""Postings out of vendors' payloads: one mapping a vendor, all to the same columns.

A payload is a row (company, slug, body).  A mapping says where its list of postings is,
what fields a posting has, and what each column takes from them.  Missing lists give no rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmill.functions import dates as D
from feedmill.functions import geo as G
from feedmill.functions import money as M
from feedmill.functions import names as N
from feedmill.functions import text as T

COLUMNS = ("company", "role", "location", "date", "link", "is_remote", "salary_min", "salary_max", "salary_currency", "country_iso", "description")


@dataclass(frozen=True)
class Vendor:
    path: str  # of the list in the payload, $ for a bare list
    item: str  # fields of a posting
    row: Callable[[Column, Column, Column], dict[str, Column]]  # (posting, slug, run's time) -> columns


def _joined(*parts: Column) -> Column:
    """Filled parts with commas between."""
    return F.trim(F.array_join(F.filter(F.array(*[T.text(p) for p in parts]), lambda x: x != ""), ", "))


def _flag(c: Column) -> Column:
    """Truth of a JSON value as text."""
    return F.when(F.lower(T.text(c)).isin("", "false", "0"), "false").otherwise("true")


def _says_remote(c: Column) -> Column:
    return F.lower(T.text(c)).contains("remote").cast("string")


def _stamp(at: Column) -> Column:
    return F.coalesce(F.date_format(at, "yyyy-MM-dd HH:mm:ss"), F.lit(""))


def _millis(c: Column) -> Column:
    n = c.try_cast("long")
    return F.coalesce(F.concat(F.date_format(F.timestamp_millis(F.when(n > 0, n)), "yyyy-MM-dd HH:mm:ss"), F.lit("+00:00")), F.lit(""))


def _seconds(c: Column) -> Column:
    return F.coalesce(F.concat(F.date_format(F.timestamp_seconds(c.try_cast("double")), "yyyy-MM-dd HH:mm:ss"), F.lit("+00:00")), F.lit(""))


def _first_of(c: Column) -> Column:
    """First entry of a list, a text between brackets or a plain list with commas."""
    bare = F.trim(F.regexp_replace(F.trim(T.text(c)), r"^[\[\]]+|[\[\]]+$", ""))
    first = F.regexp_replace(F.trim(F.substring_index(bare, ",", 1)), "^['\"]+|['\"]+$", "")
    return F.when(F.ltrim(T.text(c)).startswith("["), F.coalesce(F.trim(F.get_json_object(c, "$[0]")), first)).otherwise(first)


def _greenhouse(j: Column, slug: Column, now: Column) -> dict[str, Column]:
    low, high = M.pay_range(F.transform(j["pay_input_ranges"], lambda r: r["min_cents"].try_cast("long")), F.transform(j["pay_input_ranges"], lambda r: r["max_cents"].try_cast("long")))
    currency = F.get(F.filter(F.transform(j["pay_input_ranges"], lambda r: r["currency_type"]), lambda x: T.text(x) != ""), F.lit(0))
    place = F.trim(T.text(j["location"]["name"]))
    return {
        "role": j["title"], "location": place, "date": j["updated_at"], "link": j["absolute_url"], "is_remote": _says_remote(place), "salary_min": low, "salary_max": high,
        "salary_currency": F.when(low.isNotNull() | high.isNotNull(), currency), "description": T.parsed_or_plain(j["content"]),
    }


def _lever(j: Column, slug: Column, now: Column) -> dict[str, Column]:
    kind = j["workplaceType"]
    return {
        "role": j["text"], "location": j["categories"]["location"], "date": _millis(j["createdAt"]), "link": j["hostedUrl"],
        "is_remote": F.when(kind == "remote", "true").when(kind.isNotNull(), "false").otherwise("unknown"),
        "description": T.parsed_or_plain(F.coalesce(F.nullif(j["descriptionPlain"], F.lit("")), j["description"])),
    }


def _ashby(j: Column, slug: Column, now: Column) -> dict[str, Column]:
    pay = j["compensation"]
    return {
        "role": j["title"], "location": j["location"], "date": j["publishedAt"], "link": j["applicationUrl"], "is_remote": _flag(j["isRemote"]),
        "salary_min": F.coalesce(M.number(pay["minValue"]), M.number(pay["baseSalary"]["minValue"])), "salary_max": F.coalesce(M.number(pay["maxValue"]), M.number(pay["baseSalary"]["maxValue"])),
        "salary_currency": pay["currency"], "description": T.parsed_or_plain(F.coalesce(F.nullif(j["descriptionPlain"], F.lit("")), j["descriptionHtml"])),
    }


def _smartrecruiters(j: Column, slug: Column, now: Column) -> dict[str, Column]:
    at, sections = j["location"], j["jobAd"]["sections"]
    listed = F.from_json(sections, "array<struct<name:string,text:string>>")
    named = F.get(F.filter(listed, lambda s: F.lower(T.text(s["name"])).isin("jobdescription", "description")), F.lit(0))["text"]
    body = F.when(F.ltrim(T.text(sections)).startswith("["), named).otherwise(F.coalesce(F.get_json_object(sections, "$.jobDescription.text"), F.get_json_object(sections, "$.description.text")))
    return {
        "role": j["name"], "location": F.coalesce(F.nullif(at["fullLocation"], F.lit("")), _joined(at["city"], at["region"], at["country"])), "date": j["publishedDate"],
        "link": F.coalesce(j["applyUrl"], j["id"]), "is_remote": _flag(at["remote"]), "description": T.parsed_or_plain(body),
    }


def _workday(j: Column, slug: Column, now: Column) -> dict[str, Column]:
    place, path = F.trim(T.text(j["locationsText"])), T.text(j["externalPath"])
    return {
        "role": j["title"], "location": place, "date": _stamp(D.relative(j["postedOn"], now)),
        "link": F.when(path != "", F.concat(F.lit("https://"), F.substring_index(slug, "/", 1), path)).otherwise(""), "is_remote": _says_remote(place),
    }


def _workable(j: Column, slug: Column, now: Column) -> dict[str, Column]:
    first = F.get(j["locations"], F.lit(0))
    pick = lambda a, b: F.coalesce(F.nullif(a, F.lit("")), b)
    return {
        "role": j["title"], "location": _joined(pick(j["city"], first["city"]), pick(j["state"], first["region"]), pick(j["country"], first["country"])), "date": j["published_on"],
        "link": j["url"], "is_remote": _flag(j["telecommuting"]),
    }


def _rippling(j: Column, slug: Column, now: Column) -> dict[str, Column]:
    place = F.trim(T.text(j["workLocation"]["label"]))
    return {"role": j["name"], "location": place, "date": _stamp(now), "link": j["url"], "is_remote": _says_remote(place)}


def _pinpoint(j: Column, slug: Column, now: Column) -> dict[str, Column]:
    shown = _flag(j["compensation_visible"]) == "true"
    return {
        "role": j["title"], "location": j["location"]["name"], "date": _stamp(now), "link": j["url"], "is_remote": (F.lower(T.text(j["workplace_type"])) == "remote").cast("string"),
        "salary_min": F.when(shown, M.number(j["compensation_minimum"])), "salary_max": F.when(shown, M.number(j["compensation_maximum"])), "salary_currency": F.when(shown, j["compensation_currency"]),
    }


def _recruitee(j: Column, slug: Column, now: Column) -> dict[str, Column]:
    pick = lambda a, b: F.coalesce(F.nullif(a, F.lit("")), b)
    return {
        "role": j["title"], "location": j["location"], "date": pick(j["published_at"], j["created_at"]), "link": pick(j["careers_url"], j["careers_apply_url"]), "is_remote": _flag(j["remote"]),
        "salary_min": M.number(j["salary"]["min"]), "salary_max": M.number(j["salary"]["max"]), "salary_currency": j["salary"]["currency"],
    }


def _teamtailor(j: Column, slug: Column, now: Column) -> dict[str, Column]:
    post = j["_jobposting"]
    at = lambda field: F.coalesce(F.get_json_object(post["jobLocation"], f"$.address.{field}"), F.get_json_object(post["jobLocation"], f"$[0].address.{field}"))
    place = _joined(at("addressLocality"), at("addressRegion"), at("addressCountry"))
    pick = lambda a, b: F.coalesce(F.nullif(a, F.lit("")), b)
    published = F.trim(T.text(pick(j["date_published"], post["datePosted"])))
    return {
        "role": pick(j["title"], post["title"]), "location": place, "date": F.coalesce(F.nullif(_stamp(D.parse(published)), F.lit("")), published), "link": F.trim(T.text(j["url"])),
        "is_remote": _says_remote(place), "description": T.parsed_or_plain(pick(j["content_html"], post["description"])),
    }


def _breezy(j: Column, slug: Column, now: Column) -> dict[str, Column]:
    at = j["location"]
    return {
        "role": j["name"], "location": F.coalesce(F.nullif(F.trim(at["name"]), F.lit("")), at["country"]["name"]), "date": j["published_date"], "link": j["url"], "is_remote": _flag(at["is_remote"]),
    }


VENDORS = {
    "Greenhouse": Vendor("$.jobs", "title string, location struct<name:string>, updated_at string, absolute_url string, content string, pay_input_ranges array<struct<min_cents:string,max_cents:string,currency_type:string>>", _greenhouse),
    "Lever": Vendor("$", "text string, categories struct<location:string>, createdAt string, hostedUrl string, workplaceType string, descriptionPlain string, description string", _lever),
    "Ashby": Vendor("$.jobs", "title string, location string, publishedAt string, applicationUrl string, isRemote string, descriptionPlain string, descriptionHtml string, compensation struct<minValue:string,maxValue:string,currency:string,baseSalary:struct<minValue:string,maxValue:string>>", _ashby),
    "SmartRecruiters": Vendor("$.content", "id string, name string, publishedDate string, applyUrl string, location struct<fullLocation:string,city:string,region:string,country:string,remote:string>, jobAd struct<sections:string>", _smartrecruiters),
    "Workday": Vendor("$.jobPostings", "title string, locationsText string, postedOn string, externalPath string", _workday),
    "Workable": Vendor("$.jobs", "title string, city string, state string, country string, published_on string, url string, telecommuting string, locations array<struct<city:string,region:string,country:string>>", _workable),
    "Rippling": Vendor("$", "name string, url string, workLocation struct<label:string>", _rippling),
    "Pinpoint": Vendor("$.data", "title string, url string, workplace_type string, location struct<name:string>, compensation_visible string, compensation_minimum string, compensation_maximum string, compensation_currency string", _pinpoint),
    "Recruitee": Vendor("$.offers", "title string, location string, published_at string, created_at string, careers_url string, careers_apply_url string, remote string, salary struct<min:string,max:string,currency:string>", _recruitee),
    "Teamtailor": Vendor("$.items", "title string, url string, date_published string, content_html string, _jobposting struct<title:string,datePosted:string,description:string,jobLocation:string>", _teamtailor),
    "Breezy": Vendor("$", "name string, url string, published_date string, location struct<name:string,is_remote:string,country:struct<name:string>>", _breezy),
}


def _tag(xml: Column, name: str) -> Column:
    inner = F.regexp_extract(xml, rf"(?s)<{name}(?:\s[^>]*)?>(.*?)</{name}>", 1)
    return F.trim(T.unescape(F.regexp_replace(inner, r"(?s)^\s*<!\[CDATA\[(.*?)\]\]>\s*$", "$1")))


def _personio(xml: Column, slug: Column, now: Column) -> dict[str, Column]:
    office, ident, own = _tag(xml, "office"), _tag(xml, "id"), _tag(xml, "careersUrl")
    link = F.when(own != "", own).when(ident != "", F.concat(F.lit("https://"), slug, F.lit(".jobs.personio.com/job/"), ident)).otherwise("")
    return {
        "role": _tag(xml, "name"), "location": office, "date": _stamp(F.coalesce(D.parse(_tag(xml, "createdAt")), now)), "link": link, "is_remote": _says_remote(office),
    }


def _canonical(items: DataFrame, fields: dict[str, Column]) -> DataFrame:
    empty = F.lit(None).cast("string")
    place = F.trim(T.text(fields["location"]))
    made = {
        "role": F.trim(T.text(fields["role"])), "location": place, "date": T.text(fields["date"]), "link": T.text(fields["link"]), "is_remote": fields["is_remote"],
        "salary_min": fields.get("salary_min", F.lit(None)).cast("double"), "salary_max": fields.get("salary_max", F.lit(None)).cast("double"),
        "salary_currency": fields.get("salary_currency", empty).cast("string"), "country_iso": fields.get("country_iso", G.infer_country(place)), "description": fields.get("description", empty),
    }
    company = fields.get("company", F.col("company"))
    return items.select(company.alias("company"), *[made[c].alias(c) for c in COLUMNS[1:]])


def normalise(payloads: DataFrame, vendor: str, now: Column) -> DataFrame:
    """(company, slug, body) -> the columns of a posting, one row for each posting of the vendor's payloads."""
    if vendor == "Personio":
        items = payloads.select("company", "slug", F.explode(F.regexp_extract_all(T.text(F.col("body")), F.lit("(?s)(<position>.*?</position>)"), 1)).alias("j"))
        return _canonical(items, _personio(F.col("j"), F.col("slug"), now))
    kind = VENDORS[vendor]
    listed = F.col("body") if kind.path == "$" else F.get_json_object("body", kind.path)
    array = F.when(F.ltrim(listed).startswith("["), F.from_json(listed, "array<struct<" + _ddl(kind.item) + ">>"))
    items = payloads.select("company", "slug", F.explode(array).alias("j"))
    return _canonical(items, kind.row(F.col("j"), F.col("slug"), now))


def _ddl(fields: str) -> str:
    """``a string, b struct<...>`` as the inside of a struct type."""
    out, depth, part = [], 0, ""
    for c in fields + ",":
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            name, _, kind = part.strip().partition(" ")
            out.append(f"{name}:{kind}")
            part = ""
        else:
            part += c
    return ",".join(out)


def normalise_all(payloads: DataFrame, now: Column, vendors: tuple[str, ...] | None = None) -> DataFrame:
    """(vendor, company, slug, body) of any of the vendors; others give no rows."""
    names = vendors or (*VENDORS, "Personio")
    parts = [normalise(payloads.filter(F.col("vendor") == v), v, now).withColumn("vendor", F.lit(v)) for v in names]
    return reduce(DataFrame.unionByName, parts)


# ---- vendors of a second kind: employers lose corporate endings, places are not inferred


def _plain(items: DataFrame, company: Column, role: Column, location: Column, date: Column, link: Column, remote: Column, description: Column | None = None, **pay: Column) -> DataFrame:
    fields = {"company": N.vendor_employer(company), "role": role, "location": location, "date": date, "link": F.trim(T.text(link)), "is_remote": remote.cast("string"), "country_iso": F.lit("")}
    if description is not None:
        fields["description"] = T.vendor_text(description)
    return _canonical(items, fields | pay)


def _list(payloads: DataFrame, path: str, item: str) -> DataFrame:
    listed = F.col("body") if path == "$" else F.get_json_object("body", path)
    array = F.when(F.ltrim(listed).startswith("["), F.from_json(listed, f"array<struct<{_ddl(item)}>>"))
    return payloads.select("company", "slug", "body", F.explode(array).alias("j"))


def eightfold(payloads: DataFrame) -> DataFrame:
    """Positions of search answers; slug is the host.  A position that several answers hold counts once."""
    rows = _list(payloads, "$.data.positions", "id string, name string, positionUrl string, postedTs string, workLocationOption string, locations array<string>")
    rows = rows.groupBy("company", "slug", F.col("j.id").alias("id")).agg(F.min("j").alias("j"))
    j, url = F.col("j"), T.text(F.col("j.positionUrl"))
    link = F.when(url.startswith("/"), F.concat(F.lit("https://"), "slug", url)).otherwise(url)
    return _plain(rows, F.col("company"), j["name"], F.get(j["locations"], F.lit(0)), _seconds(j["postedTs"]), link, F.lower(T.text(j["workLocationOption"])) == "remote")


def oracle_cloud(payloads: DataFrame) -> DataFrame:
    """Requisitions; slug is host|site."""
    item = "Id string, Title string, PrimaryLocation string, PostedDate string, WorkplaceType string, ShortDescriptionStr string, ExternalResponsibilitiesStr string, ExternalQualificationsStr string"
    rows = _list(payloads, "$.items[0].requisitionList", item)
    j, host, site = F.col("j"), F.substring_index("slug", "|", 1), F.substring_index("slug", "|", -1)
    link = F.concat(F.lit("https://"), host, F.lit("/hcmUI/CandidateExperience/en/sites/"), site, F.lit("/job/"), T.text(j["Id"]))
    long = F.concat(T.text(j["ExternalResponsibilitiesStr"]), F.lit("\n"), T.text(j["ExternalQualificationsStr"]))
    return _plain(
        rows, F.col("company"), j["Title"], j["PrimaryLocation"], _stamp(D.parse(j["PostedDate"])), link, F.lower(T.text(j["WorkplaceType"])).contains("remote"),
        F.coalesce(F.nullif(j["ShortDescriptionStr"], F.lit("")), long),
    )


def icims_links(pages: DataFrame) -> DataFrame:
    """(slug, body) of search pages -> one (slug, id, title_slug, link) a posting, beginners' titles first."""
    found = pages.select("slug", F.posexplode(F.regexp_extract_all("body", F.lit(r'(?i)(href="[^"]*?/jobs/\d+/[^"/?]*?/job[^"]*")'), 1)).alias("place", "tag"))
    href = F.regexp_extract("tag", r'(?i)href="([^"]*)"', 1)
    rows = found.select(
        "slug", "place", F.regexp_extract("tag", r"(?i)/jobs/(\d+)/", 1).alias("id"), F.regexp_extract("tag", r"(?i)/jobs/\d+/([^\"/?]*?)/job", 1).alias("title_slug"),
        F.when(href.startswith("http"), href).otherwise(F.concat(F.lit("https://"), "slug", href)).alias("link"),
    )
    early = F.col("title_slug").rlike(r"(?i)(intern|internship|co-?op|new-?grad|entry-?level|junior|trainee|apprentice|early-?career|fellow|student|campus)")
    best = rows.withColumn("early", early).groupBy("slug", "id").agg(F.min_by(F.struct("title_slug", "link", "early"), F.struct(~F.col("early"), F.when(F.col("early"), -F.col("place")).otherwise(F.col("place")))).alias("x"))
    return best.select("slug", "id", "x.title_slug", "x.link", "x.early")


def icims(pages: DataFrame) -> DataFrame:
    """(company, link, body) of posting pages, by the JSON-LD in them."""
    blocks = F.regexp_extract_all(T.text(F.col("body")), F.lit(r"""(?is)<script[^>]+type=["']application/ld\+json["'][^>]*>(.*?)</script>"""), 1)
    item = "struct<`@type`:string,title:string,datePosted:string,url:string,description:string,hiringOrganization:struct<name:string>,jobLocation:string>"
    one = F.transform(blocks, lambda b: F.when(F.ltrim(b).startswith("["), F.get(F.filter(F.from_json(b, f"array<{item}>"), lambda x: x["@type"] == "JobPosting"), F.lit(0))).otherwise(F.from_json(b, item)))
    rows = pages.select("company", F.col("link").alias("slug"), F.get(F.filter(one, lambda x: x["@type"] == "JobPosting"), F.lit(0)).alias("j")).filter("j.title is not null and trim(j.title) <> ''")
    j = F.col("j")
    at = lambda field: F.coalesce(F.get_json_object(j["jobLocation"], f"$.address.{field}"), F.get_json_object(j["jobLocation"], f"$[0].address.{field}"))
    place = _joined(at("addressLocality"), at("addressRegion"), at("addressCountry"))
    return _plain(
        rows, F.coalesce(j["hiringOrganization"]["name"], F.col("company")), j["title"], place, _stamp(D.parse(j["datePosted"])), F.coalesce(j["url"], F.col("slug")),
        F.lower(place).contains("remote"), j["description"],
    )


def adp(payloads: DataFrame) -> DataFrame:
    """Requisitions; slug is the career site's domain."""
    rows = _list(payloads, "$.jobRequisitions", "reqId string, jobTitle string, postingDate string, jobDescription string, requisitionLocations array<struct<city:string,state:string,country:string>>")
    j, first = F.col("j"), F.get(F.col("j.requisitionLocations"), F.lit(0))
    place = _joined(first["city"], first["state"], first["country"])
    link = F.concat(F.lit("https://myjobs.adp.com/"), "slug", F.lit("/cx/job/"), T.text(j["reqId"]))
    return _plain(rows, F.col("company"), j["jobTitle"], place, _stamp(D.parse(j["postingDate"])), link, F.lower(place).contains("remote"), j["jobDescription"])


def bamboohr(lists: DataFrame, details: DataFrame) -> DataFrame:
    """Openings for beginners of a list (company, slug, body), with their details (slug, id, body)."""
    rows = _list(lists, "$.result", "id string, jobOpeningName string, isRemote string, location struct<city:string,state:string>")
    early = F.col("j.jobOpeningName").rlike(r"(?i)(intern|internship|co-?op|new-?grad|entry-?level|junior|trainee|apprentice|early-?career|fellow|student|campus)")
    more = details.select("slug", F.col("id").alias("_id"), F.from_json(F.get_json_object("body", "$.result.jobOpening"), "struct<jobOpeningName:string,datePosted:string,description:string>").alias("d"))
    both = rows.filter(early).join(more.withColumnRenamed("slug", "_slug"), (F.col("slug") == F.col("_slug")) & (F.col("j.id") == F.col("_id")))
    j, d = F.col("j"), F.col("d")
    link = F.concat(F.lit("https://"), "slug", F.lit(".bamboohr.com/careers/"), j["id"])
    return _plain(
        both, F.col("company"), F.coalesce(F.nullif(d["jobOpeningName"], F.lit("")), j["jobOpeningName"]), _joined(j["location"]["city"], j["location"]["state"]), _stamp(D.parse(d["datePosted"])), link,
        _flag(j["isRemote"]) == "true", d["description"],
    )


def workforce_now(payloads: DataFrame, centre: str) -> DataFrame:
    """Requisitions; slug is the client's id.  One that several pages hold counts once."""
    rows = _list(payloads, "$.jobRequisitions", "itemID string, requisitionTitle string, postDate string, requisitionLocations array<struct<address:struct<cityName:string,countrySubdivisionLevel1:struct<codeValue:string>>>>")
    rows = rows.groupBy("company", "slug", F.col("j.itemID").alias("id")).agg(F.min("j").alias("j"))
    j, at = F.col("j"), F.get(F.col("j.requisitionLocations"), F.lit(0))["address"]
    place = _joined(at["cityName"], at["countrySubdivisionLevel1"]["codeValue"])
    link = F.concat(F.lit("https://workforcenow.adp.com/mascsr/default/mdf/recruitment/recruitment.html?cid="), "slug", F.lit(f"&ccId={centre}&jobId="), T.text(j["itemID"]), F.lit("&lang=en_US"))
    return _plain(rows, F.col("company"), j["requisitionTitle"], place, _stamp(D.parse(j["postDate"])), link, F.lower(place).contains("remote"))


# ---- feeds of many employers


@dataclass(frozen=True)
class Feed:
    path: str
    item: str
    row: Callable[[Column], dict[str, Column]]


def _whole(c: Column) -> Column:
    n = T.text(c).try_cast("double")
    return F.when(n > 0, F.floor(n).cast("double"))


def _feed(company: Column, role: Column, location: Column, date: Column, link: Column, remote: Column, **pay: Column) -> dict[str, Column]:
    return {"company": F.trim(T.text(company)), "role": role, "location": location, "date": date, "link": F.trim(T.text(link)), "is_remote": remote.cast("string"), "country_iso": F.lit(""), **pay}


FEEDS = {
    "Jobicy": Feed("$.jobs", "companyName string, jobTitle string, jobGeo string, pubDate string, url string", lambda j: _feed(j["companyName"], j["jobTitle"], j["jobGeo"], j["pubDate"], j["url"], F.lit(True))),
    "Arbeitnow": Feed("$.data", "company_name string, title string, location string, created_at string, url string, remote string", lambda j: _feed(j["company_name"], j["title"], j["location"], _seconds(j["created_at"]), j["url"], F.lower(F.trim(T.text(j["remote"]))) == "true")),
    "Remotive": Feed("$.jobs", "company_name string, title string, candidate_required_location string, publication_date string, url string", lambda j: _feed(j["company_name"], j["title"], j["candidate_required_location"], j["publication_date"], j["url"], F.lit(True))),
    "RemoteOK": Feed("$", "company string, position string, location string, date string, url string, apply_url string, salary_min string, salary_max string", lambda j: _feed(
        j["company"], j["position"], F.coalesce(F.nullif(j["location"], F.lit("")), F.lit("Remote")), j["date"], F.coalesce(F.nullif(j["url"], F.lit("")), j["apply_url"]), F.lit(True), salary_min=_whole(j["salary_min"]), salary_max=_whole(j["salary_max"]))),
    "Himalayas": Feed("$.jobs", "companyName string, title string, locationRestrictions string, pubDate string, applicationLink string, guid string, minSalary string, maxSalary string, currency string", lambda j: _feed(
        j["companyName"], j["title"], _first_of(j["locationRestrictions"]), _seconds(j["pubDate"]), F.coalesce(F.nullif(j["applicationLink"], F.lit("")), j["guid"]), F.lit(True),
        salary_min=_whole(j["minSalary"]), salary_max=_whole(j["maxSalary"]), salary_currency=F.nullif(j["currency"], F.lit("")))),
    "Working Nomads": Feed("$", "company_name string, title string, location string, pub_date string, url string", lambda j: _feed(j["company_name"], j["title"], j["location"], j["pub_date"], j["url"], F.lit(True))),
    "TheMuse": Feed("$.results", "company string, name string, publication_date string, locations array<struct<name:string>>, refs struct<landing_page:string>", lambda j: _muse(j)),
}


def _muse(j: Column) -> dict[str, Column]:
    company = F.when(F.ltrim(T.text(j["company"])).startswith("{"), F.get_json_object(j["company"], "$.name")).otherwise(j["company"])
    place = T.text(F.get(j["locations"], F.lit(0))["name"])
    return _feed(company, j["name"], F.when(place != "", place).otherwise("United States"), j["publication_date"], j["refs"]["landing_page"], F.lower(place).contains("remote"))


def _title_feed(payloads: DataFrame) -> DataFrame:
    """Items of an RSS feed whose titles are ``Employer: Role``."""
    items = payloads.select("company", "slug", F.explode(F.regexp_extract_all(T.text(F.col("body")), F.lit("(?s)(<item>.*?</item>)"), 1)).alias("j"))
    title = _tag(F.col("j"), "title")
    split = title.contains(": ")
    role = F.when(split, F.substring(title, F.instr(title, ": ") + 2, F.lit(1 << 20))).otherwise(title)
    region = _tag(F.col("j"), "region")
    return _canonical(items, _feed(F.when(split, F.substring_index(title, ": ", 1)).otherwise(""), role, F.when(region != "", region).otherwise("Remote"), _stamp(D.parse(_tag(F.col("j"), "pubDate"))), _tag(F.col("j"), "link"), F.lit(True)))


#: Hosts of boards that a comment must link to (fixed values).
COMMENT_BOARDS = (
    "greenhouse.io", "lever.co", "ashbyhq.com", "myworkdayjobs.com", "smartrecruiters.com", "breezy.hr", "recruitee.com", "pinpointhq.com", "teamtailor.com", "workable.com", "rippling.com",
)


def _comments(payloads: DataFrame) -> DataFrame:
    """Comments of a thread, ``Employer | Role | Place``, that link to a board."""
    items = payloads.select("company", F.get_json_object("body", "$.created_at").alias("slug"), F.explode(F.from_json(F.get_json_object("body", "$.children"), "array<struct<text:string>>")).alias("c"))
    flat = F.trim(T.unescape(F.regexp_replace(T.text(F.col("c.text")), "<[^>]+>", " ")))
    rows = items.withColumn("flat", flat).withColumn("link", F.regexp_extract("flat", rf"(?i)(https?://(?:[a-z0-9-]+\.)*(?:{'|'.join(b.replace('.', chr(92) + '.') for b in COMMENT_BOARDS)}))", 1)).filter("link <> ''")
    parts = F.filter(F.transform(F.split("flat", r"\s*\|\s*|\s+—\s+"), lambda p: F.trim(p)), lambda p: (p != "") & ~p.rlike(r"^https?://\S+$"))
    rows = rows.withColumn("parts", parts).filter(F.size("parts") >= 2)
    at = lambda i, n: F.substring(F.get("parts", F.lit(i)), 1, n)
    return _canonical(rows, _feed(at(0, 120), at(1, 200), F.coalesce(at(2, 120), F.lit("Remote")), F.substring("slug", 1, 10), F.col("link"), F.lower("flat").contains("remote")))


def read_feed(payloads: DataFrame, feed: str) -> DataFrame:
    """(company, slug, body) of one of the feeds; the payload's own company is not used."""
    if feed == "WeWorkRemotely":
        return _title_feed(payloads)
    if feed == "HN who-is-hiring":
        return _comments(payloads)
    kind = FEEDS[feed]
    rows = _list(payloads, kind.path, kind.item)
    if feed == "RemoteOK":
        rows = rows.filter("j.position is not null")  # its first entry is a notice
    return _canonical(rows, kind.row(F.col("j")))


def read_feeds(payloads: DataFrame, names: tuple[str, ...] | None = None) -> DataFrame:
    """(feed, company, slug, body) of the feeds polled, ``names`` or all of them."""
    every = (*FEEDS, "WeWorkRemotely", "HN who-is-hiring")
    chosen = [f for f in every if names is None or f in names]
    return reduce(DataFrame.unionByName, [read_feed(payloads.filter(F.col("feed") == f), f).withColumn("feed", F.lit(f)) for f in chosen])


# ---- single sources


def enriched_jobs(payloads: DataFrame) -> DataFrame:
    """Postings of an API that carries its own enrichment, with employment_type and seniority."""
    rows = _list(payloads, "$.jobs", "company string, title string, location string, posted_at string, url string, work_mode string, countries array<string>, enrichment struct<salary_min:string,salary_max:string,salary_currency:string,employment_type:string,seniority:string>")
    j, e, place = F.col("j"), F.col("j.enrichment"), F.trim(T.text(F.col("j.location")))
    country = F.upper(T.text(F.get(j["countries"], F.lit(0))))
    fields = {
        "company": T.text(j["company"]), "role": j["title"], "location": place, "date": j["posted_at"], "link": j["url"], "is_remote": F.coalesce(j["work_mode"] == "remote", F.lit(False)).cast("string"),
        "salary_min": M.number(e["salary_min"]), "salary_max": M.number(e["salary_max"]), "salary_currency": e["salary_currency"], "country_iso": F.when(country != "", country).otherwise(G.infer_country(place)),
        "description": F.lit(None).cast("string"),
    }
    return rows.select(*[fields[c].alias(c) if c not in ("role", "date", "link") else F.trim(T.text(fields[c])).alias(c) for c in COLUMNS], e["employment_type"].alias("employment_type"), e["seniority"].alias("seniority"))


def government_jobs(payloads: DataFrame) -> DataFrame:
    """Postings of a government search answer; those without an id or a title are left out."""
    item = (
        "MatchedObjectId string, MatchedObjectDescriptor struct<PositionID:string,PositionURI:string,PositionTitle:string,OrganizationName:string,DepartmentName:string,PublicationStartDate:string,QualificationSummary:string,"
        "Locations:array<struct<LocationName:string>>,PositionRemuneration:array<struct<MinimumRange:string,MaximumRange:string>>,UserArea:struct<Details:struct<JobSummary:string>>>"
    )
    rows = _list(payloads, "$.SearchResult.SearchResultItems", item)
    d = F.col("j.MatchedObjectDescriptor")
    ident, title = F.trim(T.text(F.coalesce(F.nullif(d["PositionID"], F.lit("")), F.col("j.MatchedObjectId")))), F.trim(T.text(d["PositionTitle"]))
    org = F.trim(T.text(F.coalesce(F.nullif(d["OrganizationName"], F.lit("")), d["DepartmentName"])))
    places = F.array_join(F.array_distinct(F.filter(F.transform(d["Locations"], lambda x: x["LocationName"]), lambda x: T.text(x) != "")), ", ")
    pay = F.get(d["PositionRemuneration"], F.lit(0))
    return rows.filter((ident != "") & (title != "")).select(
        F.when(org != "", org).otherwise("U.S. Government").alias("company"), title.alias("role"), F.when(T.text(places) != "", places).otherwise("N/A").alias("location"), F.trim(T.text(d["PositionURI"])).alias("link"),
        T.text(d["PublicationStartDate"]).alias("date"), F.lit("usajobs").alias("ats_type"), ident.alias("ats_id"), F.lit("usajobs").alias("source"),
        F.substring(T.text(F.coalesce(F.nullif(d["UserArea"]["Details"]["JobSummary"], F.lit("")), d["QualificationSummary"])), 1, 4000).alias("description"),
        M.number(pay["MinimumRange"]).alias("salary_min"), M.number(pay["MaximumRange"]).alias("salary_max"), F.lit("USD").alias("salary_currency"),
    )


def scraped_rows(df: DataFrame) -> DataFrame:
    """Rows of a scraper (title, company, location, job_url, date_posted, min_amount, max_amount, currency, is_remote); incomplete ones are left out."""
    clean = lambda c: F.trim(T.text(F.col(c)))
    whole = df.filter((clean("title") != "") & (clean("company") != "") & (clean("location") != "") & (clean("job_url") != ""))
    return whole.select(
        clean("company").alias("company"), clean("title").alias("role"), clean("location").alias("location"), F.coalesce(F.date_format(D.parse(F.col("date_posted")), "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit("")).alias("date"),
        clean("job_url").alias("link"), M.truthy_plain(F.col("is_remote")).cast("string").alias("is_remote"), M.finite(F.nullif(M.number(F.col("min_amount")), F.lit(0.0))).alias("salary_min"),
        M.finite(F.nullif(M.number(F.col("max_amount")), F.lit(0.0))).alias("salary_max"), F.nullif(F.col("currency").cast("string"), F.lit("")).alias("salary_currency"), F.lit("").alias("country_iso"),
    )


def listing_rows(pages: DataFrame, site: str) -> DataFrame:
    """Open postings of the list that a page's script payload embeds (body), placed in the United States."""
    item = "id string, company string, title string, location string, postedAt string, applyUrl string, mode string, closed string, placeCountries array<string>"
    rows = pages.select(F.explode(F.from_json("payload", f"array<struct<{_ddl(item)}>>")).alias("j"))
    j = F.col("j")
    countries = F.coalesce(F.transform(j["placeCountries"], lambda c: F.lower(F.trim(c))), F.array().cast("array<string>"))
    at_home = F.array_contains(countries, "united states")
    apply = F.trim(T.text(j["applyUrl"]))
    direct = apply.startswith("http")
    made = rows.filter((_flag(j["closed"]) == "false") & (F.trim(T.text(j["company"])) != "") & (F.trim(T.text(j["title"])) != "") & ((F.size(countries) == 0) | at_home)).select(
        F.trim(j["company"]).alias("company"), F.trim(j["title"]).alias("role"), F.trim(T.text(j["location"])).alias("location"), F.substring(T.text(j["postedAt"]), 1, 10).alias("date"),
        F.when(direct, apply).otherwise(F.concat(F.lit(f"{site}/jobs/"), T.text(j["id"]))).alias("link"), (F.lower(F.trim(T.text(j["mode"]))) == "remote").cast("string").alias("is_remote"),
        F.when(at_home, "US").otherwise("").alias("country_iso"), F.when(j["title"].rlike(r"(?i)new[\s-]?grad|newly graduated|graduate student"), "new-grad").otherwise("internship").alias("tier_hint"), direct.cast("string").alias("direct_apply"),
    )
    return made.filter(G.american(F.col("country_iso"), F.col("location"), F.col("role"))["keep"])
