"""Text expressions: names, titles, markup."""

from __future__ import annotations

import html
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Corporate endings of a sponsor name and of a verified employer key (fixed values).
LEGAL_TOKENS = ("inc", "llc", "llp", "ltd", "limited", "corp", "corporation", "plc", "co", "company", "lp", "incorporated")
LEGAL_SUFFIXES = ("incorporated", "inc", "llc", "llp", "ltd", "limited", "corp", "corporation", "plc", "gmbh", "pty", "pte")
#: Words of a title that say level, not kind of work (fixed values).
LEVEL_WORDS = (
    "senior", "sr", "staff", "lead", "principal", "ii", "iii", "iv", "junior", "jr", "intern", "internship", "co", "op", "new", "grad", "graduate",
    "entry", "associate", "mid", "level", "summer", "fall", "spring", "winter",
)
#: Texts that stand for a missing value (fixed values).
PLACEHOLDERS = ("", "nan", "nat", "none", "null", "n/a", "na", "-")
#: Words of titles in capitals, Roman numbers, small words (fixed values).
ROLE_ACRONYMS = (
    "ai", "api", "aws", "b2b", "b2c", "cad", "cna", "cnc", "cpa", "cs", "dei", "dsp", "eeo", "ehs", "emt", "eu", "fpga", "gcp", "gis", "hr", "hvac",
    "it", "lp", "lpn", "mba", "ml", "osha", "phd", "pr", "qa", "rf", "rn", "saas", "sql", "stem", "ui", "uk", "us", "usa", "ux",
)
ROLE_ROMAN = ("i", "ii", "iii", "iv", "v", "vi", "vii", "viii", "ix", "x")
ROLE_SMALL = ("a", "an", "and", "at", "by", "for", "in", "of", "on", "or", "the", "to", "with")
ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&middot;", "·"), ("&copy;", "©"), ("&amp;", "&"))


def text(c: Column) -> Column:
    """Missing text as empty."""
    return F.coalesce(c.cast("string"), F.lit(""))


def squeeze(c: Column) -> Column:
    """Runs of white space as one space, none outside."""
    return F.trim(F.regexp_replace(text(c), r"\s+", " "))


def fold(c: Column) -> Column:
    return F.lower(squeeze(c))


def is_ascii(c: Column) -> Column:
    """Every character is ASCII (empty text too)."""
    return text(c).rlike(r"^[\x00-\x7F]*$")


def no_latin1(c: Column) -> Column:
    """No character of U+0080..U+00FF: a looser test than ASCII."""
    return text(c).rlike(r"^[^\x80-\xFF]*$")


def unescape(c: Column) -> Column:
    """The entities that feeds use, ampersand last."""
    for entity, char in ENTITIES:
        c = F.replace(c, F.lit(entity), F.lit(char))
    return c


def strip_tags(c: Column) -> Column:
    """Tags become a space, entities characters, white space one space."""
    return squeeze(unescape(F.regexp_replace(text(c), r"<[^>]+>", " ")))


def html_text(c: Column) -> Column:
    """Readable text of a page: script, style and comments go; block ends are line ends."""
    bare = F.regexp_replace(text(c), r"(?is)<(script|style)\b.*?</\1>|<!--.*?-->", " ")
    lines = F.regexp_replace(bare, r"(?i)<br\s*/?>|</(?:p|div|li|h[1-6]|tr|article|nav|footer)>", "\n")
    flat = unescape(F.regexp_replace(lines, r"<[^>]+>", " "))
    flat = F.regexp_replace(flat, r"[ \t]+", " ")
    return F.trim(F.regexp_replace(flat, r" ?\n[ \n]*", "\n"))


class _Data(HTMLParser):
    def __init__(self) -> None:
        super().__init__()
        self.parts: list[str] = []

    def handle_data(self, data: str) -> None:
        self.parts.append(data)


def _parsed(value: str | None) -> str | None:
    if value is None:
        return None
    value = html.unescape(value)
    if "<" in value:
        parser = _Data()
        parser.feed(value)
        value = html.unescape("".join(parser.parts))
    flat = " ".join(value.split())
    return None if flat.lower() in ("", "nan", "n/a", "na", "none", "null", "<>") else flat


def parsed_text(c: Column) -> Column:
    """Character data of markup as a tokenizer reads it, references decoded before and after; placeholders are null."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for b in batches:
            yield pa.array([_parsed(x.as_py()) for x in b], pa.string())

    return F.arrow_udf(run, "string")(c.cast("string"))


def parsed_or_plain(c: Column) -> Column:
    """Readable text of a description; null for none and for placeholders."""
    return placeholder_to_null(unescape(F.regexp_replace(unescape(text(c)), "<[^>]+>", "")))


#: The entities that page text decodes, in order (fixed values).
PAGE_ENTITIES = (("&nbsp;", " "), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"))


def page_text(c: Column) -> Column:
    """Line ends for breaks and paragraphs, tags to spaces, six entities, and all white space one space."""
    t = F.regexp_replace(text(c), "<br>|<br/>|</p>", "\n")
    t = F.regexp_replace(t, "<[^>]+>", " ")
    for entity, char in PAGE_ENTITIES:
        t = F.replace(t, F.lit(entity), F.lit(char))
    return squeeze(t)


def vendor_text(c: Column) -> Column:
    """Tags to spaces and no-break entities to spaces; inner white space stays."""
    return F.regexp_replace(F.replace(F.regexp_replace(text(c), "<[^>]+>", " "), F.lit("&nbsp;"), F.lit(" ")), r"^\s+|\s+$", "")


def bare_text(c: Column) -> Column:
    """Tags to spaces and nothing else."""
    return F.regexp_replace(F.regexp_replace(text(c), "<[^>]+>", " "), r"^\s+|\s+$", "")


def placeholder_to_null(c: Column) -> Column:
    kept = squeeze(c)
    return F.when(~F.lower(kept).isin("", "nan", "n/a", "na", "none", "null", "<>"), kept)


def filled(c: Column) -> Column:
    """Carries information: neither blank nor a placeholder."""
    return ~F.lower(F.trim(text(c))).isin(*PLACEHOLDERS)


def sponsor_key(c: Column) -> Column:
    """Lower case without punctuation and trailing legal words; at least one word stays."""
    words = F.split(F.trim(F.regexp_replace(F.regexp_replace(F.lower(text(c)), r"[^a-z0-9 ]+", " "), r"\s+", " ")), " ")
    legal = F.array(*[F.lit(w) for w in LEGAL_TOKENS])
    last = F.aggregate(
        F.sequence(F.lit(1), F.size(words)), F.lit(0),
        lambda acc, i: F.when(~F.array_contains(legal, F.get(words, i - 1)), i).otherwise(acc),
    )
    return F.array_join(F.slice(words, F.lit(1), F.greatest(last, F.lit(1))), " ")


#: Keys of employers that go by another name (fixed values).
EMPLOYER_ALIASES = {
    "bah": "boozallenhamilton", "boozallen": "boozallenhamilton", "ngc": "northropgrumman", "amat": "appliedmaterials",
    "gdms": "generaldynamicsmissionsystems", "snc": "sierranevada", "aero": "aerospace", "alliance": "nissan", "ag": "airbus",
    "leonardocompany": "leonardo", "americascookmedical": "cookgroup", "carrieresmarvesting": "marvesting", "microntechnology": "micron",
    "llnl": "lawrencelivermorenationallaboratory", "talos": "talostrading",
}


def employer_key(c: Column, rounds: int = 4) -> Column:
    """Letters and digits only, legal endings peeled while more than two characters stay, other names of an employer brought together."""
    raw = key = F.regexp_replace(F.lower(text(c)), r"[^a-z0-9]+", "")
    # the endings in order, a few rounds: peeling one can bare another
    for _ in range(rounds):
        for suffix in LEGAL_SUFFIXES:
            key = F.regexp_replace(key, f"^(.{{3,}}){suffix}$", "$1")
    known = F.create_map(*[F.lit(x) for pair in EMPLOYER_ALIASES.items() for x in pair])
    return F.coalesce(known[key], known[raw], key)


def role_tokens(c: Column) -> Column:
    """Distinct words of a title that say what the work is."""
    words = F.regexp_extract_all(F.lower(text(c)), F.lit("([a-z0-9]+)"), 1)
    return F.array_distinct(F.filter(words, lambda w: (F.length(w) > 1) & ~w.isin(*LEVEL_WORDS)))


def loose_title(c: Column) -> Column:
    return F.regexp_replace(F.lower(text(c)), "[^a-z0-9]+", "")


def _title_word(word: Column, inner: Column) -> Column:
    low = F.lower(word)
    parts = F.transform(F.regexp_extract_all(word, F.lit("([^-/]+|[-/])"), 1), lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.lower(F.substring(p, 2, 1 << 20))))
    return (
        F.when(~word.rlike(r"\p{L}"), word)
        .when(low.isin(*ROLE_ACRONYMS, *ROLE_ROMAN), F.upper(word))
        .when(low == "co-op", F.lit("Co-op"))
        .when(low.isin(*ROLE_SMALL) & inner, low)
        .otherwise(F.array_join(parts, ""))
    )


def clean_role(c: Column) -> Column:
    """A title without markup and dangling separators; re-cased only if it is all capitals."""
    t = F.regexp_replace(unescape(text(c)), r"<[^>]+>", " ")
    t = F.regexp_replace(F.regexp_replace(t, "[​﻿]", ""), " ", " ")
    t = squeeze(F.regexp_replace(t, r"\s*([|•·])\s*", " $1 "))
    t = squeeze(F.regexp_replace(t, r"^[ \-–—|•*·:;,/]+|[ \-–—|•*·:;,/]+$", ""))
    words = F.split(t, " ")
    cased = F.array_join(F.transform(words, lambda w, i: _title_word(w, (i > 0) & (i < F.size(words) - 1))), " ")
    return F.when(t.rlike(r"\p{L}") & (t == F.upper(t)), cased).otherwise(t)


def capitalize_words(c: Column) -> Column:
    return F.array_join(F.transform(F.split(c, " "), lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, 2, 1 << 20)))), " ")


def clean_company(c: Column) -> Column:
    """An employer name out of domains, portals and board words."""
    name = F.trim(F.regexp_replace(F.trim(unescape(text(c))), r"(?i)https?://\S+", " "))
    name = F.trim(F.regexp_extract(name, r"(?is)^(.*?)(?:\s+https\s+.*)?$", 1))
    low = F.lower(name)
    oracle = (low.contains(".fa.") & low.contains("oracl")) | low.endswith(".oraclecloud.com") | (low.contains("fa-") & low.contains("saasfaprod"))
    tail = r"\.\w{2,}(?:\.\w{2,})?$"
    from_label = lambda x: capitalize_words(F.trim(F.regexp_replace(x, "[-_0-9]+", " ")))
    portal = F.regexp_extract(low, r"careers\.([a-z0-9-]+)", 1)
    domain = F.regexp_extract(low, r"(?:^(?:www|jobs|careers|apply)\.)?([a-z0-9-]+)(?:\.[a-z0-9-]+)+$", 1)
    plain = F.regexp_replace(F.regexp_replace(low, "(?:careers|jobs|portal|apply|recruitment|ats|jobsat)$", ""), r"\d+$", "")
    plain = F.trim(F.regexp_replace(plain, "[^a-z0-9]+", " "))
    plain = F.when((F.length(plain) <= 4) & plain.rlike("^[a-z]+$"), F.upper(plain)).otherwise(capitalize_words(plain))
    return (
        F.when(low == "", "").when(oracle, "Oracle Cloud")
        .when(low.contains("careers.") & low.rlike(tail) & (portal != ""), from_label(portal))
        .when(low.contains(".") & ~low.contains(" ") & (domain != ""), from_label(domain))
        .otherwise(plain)
    )


def truncate(c: Column, width: int) -> Column:
    kept = F.trim(text(c))
    return F.when(F.length(kept) > width, F.concat(F.substring(kept, 1, width - 3), F.lit("..."))).otherwise(kept)


def company_role(c: Column) -> tuple[Column, Column]:
    """``Employer: Role`` split of an item title; no employer if the parts have odd sizes."""
    pattern = r"^\s*([^:]{2,50}?)\s*:\s*(\S.{2,}?)\s*$"
    return F.regexp_extract(text(c), pattern, 1), F.when(text(c).rlike(pattern), F.regexp_extract(text(c), pattern, 2)).otherwise(squeeze(c))


def slug(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text(c)), "[^a-z0-9]+", "-"), F.lit("-"))


def meta_description(html: Column, least: int = 40) -> Column:
    """First social or plain description of at least ``least`` characters."""
    found = F.regexp_extract_all(text(html), F.lit(r"""(?is)<meta[^>]+(?:name|property)=["'](?:og:)?description["'][^>]+content=["']([^"']*)["']"""), 1)
    clean = F.transform(found, strip_tags)
    return F.get(F.filter(clean, lambda x: F.length(x) >= least), F.lit(0))


#: Titles that say nothing, and what trails a page's title (fixed values).
EMPTY_TITLE = r"(?i)^(?:job\s*details?|careers?|job\s*search|search\s*jobs?|positions?|apply|vacanc(?:y|ies)|current\s+openings?)\s*$"
TITLE_TAIL = r"(?i)\s*(?:\||–|—|-)\s*(?:job\s*details?|careers?|search|jobs|home)\s*$"
EMPLOYER_JOINTS = (" - ", " | ", " – ", " — ", ", ", " @ ", " at ")


def fallback_role(title: Column, company: Column) -> Column:
    """A role out of a page's title: without the employer and up to three tails; empty for titles that say nothing."""
    label = F.lower(squeeze(F.regexp_replace(text(company), "<[^>]+>", " ")))
    edge = lambda x: F.regexp_replace(x, "^[ \\-|–—]+|[ \\-|–—]+$", "")

    def without_employer(x: Column) -> Column:
        out = x
        for joint in reversed(EMPLOYER_JOINTS):
            tail = F.concat(F.lit(joint), label)
            out = F.when((label != "") & F.lower(x).endswith(tail), F.substring(x, 1, F.length(x) - F.length(tail))).otherwise(out)
        return out

    def round_(x: Column) -> Column:
        head, last = F.regexp_extract(x, r"^(.*)\|(.*)$", 1), F.regexp_extract(x, r"^(.*)\|(.*)$", 2)
        words = F.size(F.filter(F.split(F.trim(last), r"\s+"), lambda w: w != ""))
        cut = x.contains("|") & (F.trim(head) != "") & words.between(1, 5)
        bare = edge(F.regexp_replace(edge(F.regexp_replace(x, TITLE_TAIL, "")), r"(?i)\s+job\s*details?\s*$", ""))
        return F.when(cut, head).otherwise(edge(without_employer(bare)))

    # one element a round: a lambda's argument is computed once, an expression put in place of its name is not
    first = F.transform(F.array(F.trim(text(title))), without_employer)
    for _ in range(3):
        first = F.transform(first, round_)
    role = first[0]
    return F.when((role == "") | role.rlike(EMPTY_TITLE), "").otherwise(role)


def observation_key(bucket: Column, company: Column, role: Column, location: Column, clean: bool = True) -> Column:
    """``bucket|company|role|location`` of the observation log."""
    return F.concat_ws("|", bucket, clean_company(company) if clean else text(company), F.trim(text(role)), F.trim(text(location)))


def loose_pair(key: Column) -> Column:
    """``company|role`` of an observation key with the role's letters and digits only; null if the key has fewer than three parts."""
    parts = F.split(text(key), r"\|", 4)
    return F.when(F.size(parts) >= 3, F.concat(F.get(parts, F.lit(1)), F.lit("|"), loose_title(F.get(parts, F.lit(2)))))


def escaped(c: Column) -> Column:
    """Text as markup."""
    out = text(c)
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        out = F.replace(out, F.lit(char), F.lit(entity))
    return out


def location_cell(cleaned: Column) -> Column:
    """Parts of a cleaned location below one another, folded up from four of them."""
    parts = F.filter(F.transform(F.split(cleaned, ","), lambda p: escaped(F.trim(p))), lambda p: p != "")
    joined = F.array_join(parts, "<br>")
    folded = F.concat(F.lit("<details><summary><strong>"), F.size(parts).cast("string"), F.lit(" locations</strong></summary>"), joined, F.lit("</details>"))
    return F.when(F.size(parts) == 0, "N/A").when(F.size(parts) <= 3, joined).otherwise(folded)


def company_cell(company: Column, link: Column, repeated: Column, title: Column) -> Column:
    """A linked employer, marked with an arrow where it repeats the row above; ``title`` has the full name if it was cut."""
    base = F.concat(F.lit("<strong>"), escaped(company), F.lit("</strong>"))
    cell = F.when(repeated, F.concat(F.lit("↳ "), base)).otherwise(base)
    attrs = F.when(title != "", F.concat(F.lit(' title="'), escaped(title), F.lit('"'))).otherwise("")
    return F.when(text(link) != "", F.concat(F.lit('<a href="'), escaped(link), F.lit('"'), attrs, F.lit(">"), cell, F.lit("</a>"))).otherwise(cell)


def role_cell(role: Column, width: int = 48) -> Column:
    shown, full = truncate(role, width), F.trim(text(role))
    attrs = F.when(shown != full, F.concat(F.lit(' title="'), escaped(full), F.lit('"'))).otherwise("")
    return F.concat(F.lit("<td"), attrs, F.lit(">"), escaped(shown), F.lit("</td>"))


def visa_cell(role: Column, sponsor: Column) -> Column:
    return F.when(F.trim(text(role)) != "", "role").when(F.trim(text(sponsor)) == "true", "company").otherwise("")
