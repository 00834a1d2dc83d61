"""Payloads of varying shape: lists or objects, numbers or texts, recorded link answers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedmill.functions.text import text

#: Keys under which boards put their postings (fixed values).
ROW_KEYS = ("_rows", "jobPostings", "jobs", "results", "data", "postings")
#: Hosts of many boards share one limit each; others are limited by host (fixed values).
SHARED_DOMAINS = ("myworkdayjobs.com", "icims.com", "bamboohr.com", "greenhouse.io", "lever.co", "ashbyhq.com")


def row_count(json: Column) -> Column:
    """Postings in a payload: its own length, or that of the first known list; 0 for other shapes."""
    out = F.lit(0)
    for key in reversed(ROW_KEYS):
        out = F.coalesce(F.json_array_length(F.get_json_object(json, f"$.{key}")), out)
    return F.when(F.ltrim(text(json)).startswith("["), F.coalesce(F.json_array_length(json), F.lit(0))).otherwise(out)


def first_item(value: Column) -> Column:
    """First entry of a JSON list or of bracketed text, else the text."""
    bare = F.trim(F.regexp_replace(F.split_part(F.regexp_replace(text(value), r"^\s*\[|\]\s*$", ""), F.lit(","), F.lit(1)), r"""^[\s"']+|[\s"']+$""", ""))
    return F.when(F.ltrim(text(value)).startswith("["), F.coalesce(F.get_json_object(value, "$[0]"), bare)).otherwise(F.trim(text(value)))


def section(json: Column, name: str) -> Column:
    """Text of a named section, whether sections are a list of {name, text} or an object."""
    listed = F.from_json(F.get_json_object(json, "$.sections"), "array<struct<name:string,text:string>>")
    hit = F.get(F.filter(listed, lambda s: F.lower(s["name"]) == name.lower()), F.lit(0))["text"]
    return F.coalesce(hit, F.get_json_object(json, f"$.sections.{name}.text"), F.lit(""))


def place_names(json: Column) -> Column:
    """Distinct names of a list of places, in order, joined."""
    names = F.from_json(json, "array<struct<LocationName:string>>")
    return F.array_join(F.array_distinct(F.filter(F.transform(names, lambda p: F.trim(p["LocationName"])), lambda n: n != "")), ", ")


def provider_key(host: Column) -> Column:
    """Shared domain of a host, else the host."""
    out = host
    for d in SHARED_DOMAINS:
        out = F.when((host == d) | host.endswith(f".{d}"), d).otherwise(out)
    return out


def link_verdict(head: Column, ranged: Column) -> Column:
    """A link is dead only if both a HEAD and a ranged GET say that it is gone."""
    gone = lambda c: F.coalesce(c.isin(404, 410), F.lit(False))
    return F.when(gone(head) & gone(ranged), "dead").when(head.between(200, 399) | ranged.between(200, 399), "alive").otherwise("unknown")


def description_or(description: Column, role: Column, company: Column, location: Column) -> Column:
    """The description, or a sentence of what is known."""
    place = F.when(F.trim(text(location)) != "", F.concat(F.lit(" in "), F.trim(text(location)))).otherwise("")
    return F.coalesce(F.nullif(F.trim(text(description)), F.lit("")), F.concat(text(role), F.lit(" at "), text(company), place, F.lit(".")))
