"""Employer names for display: verified spellings, slugs split on a closed vocabulary, repaired case."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedmill.functions.text import text, unescape

#: Verified spellings and domains by letters-and-digits key (fixed values).
VERIFIED = {
    "aboutyougmbh": ("ABOUT YOU", "aboutyou.com"), "acluinternships": ("ACLU", "aclu.org"), "andurilindustries": ("Anduril Industries", "anduril.com"),
    "cityofnewyork": ("City of New York", "nyc.gov"), "columbiauniversity": ("Columbia University", "columbia.edu"),
    "deliveryhero": ("Delivery Hero", "deliveryhero.com"), "deloittenetherlands": ("Deloitte Netherlands", "deloitte.com"),
    "fehrandpeers": ("Fehr & Peers", "fehrandpeers.com"), "gannettfleming": ("Gannett Fleming", "gannettfleming.com"),
    "gehealthcare": ("GE HealthCare", "gehealthcare.com"), "indiecampers": ("Indie Campers", "indiecampers.com"),
    "keenfootwear": ("KEEN Footwear", "keenfootwear.com"), "kensingtontours": ("Kensington Tours", "kensingtontours.com"),
    "kpffconsultingengineers": ("KPFF Consulting Engineers", "kpff.com"), "lilasciences": ("Lila Sciences", "lilasciences.com"),
    "marinerfinance": ("Mariner Finance", "marinerfinance.com"), "mineralstech": ("Minerals Technologies", "mineralstech.com"),
    "alixpartners": ("AlixPartners", "alixpartners.com"), "morganmorganjobsapplynow": ("Morgan & Morgan", "forthepeople.com"),
    "nbcuniversal": ("NBCUniversal", "nbcuniversal.com"), "paconsulting": ("PA Consulting", "paconsulting.com"),
    "primehealthcare": ("Prime Healthcare", "primehealthcare.com"), "rolandberger": ("Roland Berger", "rolandberger.com"),
    "sargentlundy": ("Sargent & Lundy", "sargentlundy.com"), "sharkninjaoperatingllc": ("SharkNinja", "sharkninja.com"),
    "simpsongumpertzheger": ("Simpson Gumpertz & Heger", "sgh.com"), "standtogether": ("Stand Together", "standtogether.org"),
    "syngentagroup": ("Syngenta Group", "syngenta.com"), "thermofisher": ("Thermo Fisher Scientific", "thermofisher.com"),
    "thenewyorktimes": ("The New York Times", "nytco.com"), "veoliaenvironnementsa": ("Veolia", "veolia.com"),
}
#: Words that may end a name written without spaces (fixed values).
DESCRIPTORS = (
    "pharmaceuticals", "pharmaceutical", "laboratories", "technologies", "manufacturing", "distribution", "construction", "engineering",
    "semiconductors", "therapeutics", "entertainment", "universities", "infrastructure", "healthcare", "industries", "foundation", "association",
    "university", "laboratory", "management", "consulting", "engineers", "insurance", "financial", "logistics", "materials", "chemicals",
    "solutions", "services", "performance", "properties", "enterprises", "technology", "beverages", "education", "institute", "restaurant",
    "electrical", "sciences", "partners", "ventures", "airlines", "airways", "commerce", "community", "medicine", "research", "strategy",
    "systems", "software", "security", "analytics", "studios", "capital", "fashion", "transit", "electric", "building", "networks", "travel",
    "hotels", "resorts", "motors", "mining", "energy", "finance", "medical", "hospital", "pharmacy", "dental", "school", "college", "society",
    "council", "agency", "authority", "robotics", "federal", "animal", "global", "digital", "labor", "asset", "tours", "foods", "retail", "steel",
    "health", "group", "labs", "canada", "mexico", "brazil", "india", "germany", "france", "spain", "italy", "japan", "china", "singapore",
    "australia", "ireland", "israel", "netherlands", "poland", "romania", "philippines", "malaysia", "vietnam", "usa",
)
#: Page words and legal forms that trail a slug (fixed values).
PAGE_TAILS = (
    "jobsapplynow", "applynow", "internships", "internship", "recruitment", "opportunities", "recruiting", "vacancies", "employment", "openings",
    "careers", "hiring", "campus", "career", "jobs", "job",
)
LEGAL_TAILS = ("incorporated", "corporation", "limited", "gmbh", "corp", "llc", "ltd", "plc", "pte", "pty", "srl", "inc")
#: Words in capitals, Roman numbers and small words of names (fixed values).
ACRONYMS = (
    "aclu", "ag", "ai", "aig", "api", "asu", "aws", "b2b", "b2c", "bcg", "bdo", "bge", "bmw", "bny", "bp", "cad", "cdc", "cia", "cna", "cnc", "cpa",
    "cs", "cuny", "dei", "dhs", "dod", "doe", "dsp", "eeo", "ehs", "emt", "epa", "eu", "ey", "faa", "fbi", "fpga", "gcp", "ge", "gis", "gsk", "hr",
    "hsbc", "hvac", "ibm", "ima", "imf", "irs", "it", "jpm", "kia", "kpff", "lp", "lpn", "mba", "mit", "ml", "nasa", "nhs", "nih", "nyu", "oecd",
    "osha", "phd", "plc", "pnc", "pr", "qa", "rf", "rn", "saas", "sec", "sql", "stem", "suny", "ubs", "ucla", "ui", "uk", "un", "unicef", "us",
    "usa", "usc", "usda", "usaa", "ux", "vw", "who", "wto",
)
ROMAN = ("i", "ii", "iii", "iv", "v", "vi", "vii", "viii", "ix", "x")
SMALL_WORDS = (
    "a", "an", "and", "at", "by", "de", "del", "der", "du", "for", "in", "la", "le", "of", "on", "or", "the", "to", "van", "von", "with",
)
#: Endings of employers that some vendors' names lose (fixed values).
VENDOR_SUFFIX = r"(?i)[\s,.]+(?:inc|l\.l\.c|llc|corp|corporation|ltd|limited|co|company|plc|pbc|gmbh)(?:\.|\s|$)"
ROUNDS = 6  # descriptors that a slug may end in, one after another


def name_key(c: Column) -> Column:
    return F.regexp_replace(F.lower(text(c)), "[^a-z0-9]+", "")


def tidy(c: Column) -> Column:
    """A name without markup, odd spaces and quotes or dashes around it."""
    t = F.regexp_replace(unescape(text(c)), "<[^>]+>", " ")
    t = F.regexp_replace(F.regexp_replace(t, " ", " "), "[​﻿]", "")
    return F.regexp_replace(F.trim(F.regexp_replace(t, r"\s+", " ")), "^[ “”\"\\-–—|]+|[ “”\"\\-–—|]+$", "")


def _cased_part(part: Column) -> Column:
    return F.when(F.lower(part).isin(*ACRONYMS, *ROMAN), F.upper(part)).otherwise(F.concat(F.upper(F.substring(part, 1, 1)), F.lower(F.substring(part, 2, 1 << 20))))


def _cased(word: Column, outer: Column, shouted: Column) -> Column:
    low = F.lower(word)
    parts = F.transform(F.regexp_extract_all(word, F.lit("([^-/]+|[-/])"), 1), _cased_part)
    return (
        F.when(~word.rlike(r"\p{L}"), word).when(low.isin(*ACRONYMS, *ROMAN), F.upper(word)).when(low == "co-op", F.lit("Co-op"))
        .when(low.isin(*SMALL_WORDS) & ~outer, low).when(shouted & word.rlike(r"^\p{Lu}{1,4}$"), word).otherwise(F.array_join(parts, ""))
    )


def recased(words: Column, shouted: Column) -> Column:
    return F.array_join(F.transform(words, lambda w, i: _cased(w, (i == 0) | (i == F.size(words) - 1), shouted)), " ")


def _longest(tails: tuple[str, ...], least: int) -> str:
    """A slug and its longest tail of the list, with ``least`` characters before it: a short beginning means a long tail."""
    return rf"^(.{{{least},}}?)(?:{'|'.join(tails)})$"


def split_slug(slug: Column) -> Column:
    """struct(words, trimmed) of a name without spaces; a single word if nothing of the vocabulary ends it."""
    bare = F.regexp_replace(F.regexp_replace(slug, _longest(PAGE_TAILS, 4), "$1"), _longest(LEGAL_TAILS, 3), "$1")
    tail = _longest(DESCRIPTORS, 4).replace("(?:", "(")
    peeled = F.aggregate(
        F.sequence(F.lit(1), F.lit(ROUNDS)), F.struct(bare.alias("rest"), F.array().cast("array<string>").alias("tails")),
        lambda acc, _: F.when(
            acc["rest"].rlike(tail),
            F.struct(
                F.regexp_extract(acc["rest"], tail, 1).alias("rest"),
                F.concat(F.array(F.regexp_replace(F.regexp_extract(acc["rest"], tail, 2), "^usa$", "USA")), acc["tails"]).alias("tails"),
            ),
        ).otherwise(acc),
        lambda acc: F.concat(F.array(acc["rest"]), acc["tails"]),
    )
    return F.struct(peeled.alias("words"), (bare != slug).alias("trimmed"))


def employer(c: Column) -> Column:
    """struct(display, key, confidence, reason, domain) of an employer name.

    A verified spelling wins; a slug is split on the vocabulary; a name all in one case is
    re-cased; anything else stays.
    """
    name = tidy(c)
    known = F.create_map(*[F.lit(x) for k, (shown, domain) in VERIFIED.items() for x in (k, f"{shown}|{domain}")])
    canonical = F.create_map(*[F.lit(x) for shown, domain in dict.fromkeys(VERIFIED.values()) for x in (shown.lower(), f"{shown}|{domain}")])
    slug = ~name.contains(" ")
    split = split_slug(name)
    split_up = slug & ((F.size(split["words"]) > 1) | split["trimmed"])
    derived = recased(split["words"], name == F.upper(name))
    first = F.coalesce(canonical[F.lower(name)], known[name_key(name)])
    hit = F.coalesce(first, F.when(split_up, known[name_key(derived)]))
    shouted, whispered = name.rlike(r"\p{L}") & (name == F.upper(name)), name.rlike(r"\p{L}") & (name == F.lower(name))
    repaired = ~slug & (shouted | whispered)
    display = F.when(hit.isNotNull(), F.substring_index(hit, "|", 1)).when(split_up, derived).when(repaired, recased(F.split(name, " "), shouted)).otherwise(name)
    reason = (
        F.when(name == "", "empty").when(hit.isNotNull(), "verified alias").when(slug & split["trimmed"], "trimmed board/legal suffix")
        .when(split_up, "split corporate descriptor").when(slug, "unrecognized concatenation").when(repaired, "repaired letter case").otherwise("already displayable")
    )
    confidence = F.when(hit.isNotNull(), "verified").when((name != "") & (split_up | repaired), "derived").otherwise("unchanged")
    domain = F.when(hit.isNotNull(), F.substring_index(hit, "|", -1)).otherwise("")
    return F.struct(display.alias("display"), name_key(display).alias("key"), confidence.alias("confidence"), reason.alias("reason"), domain.alias("domain"))


def vendor_employer(c: Column) -> Column:
    """An employer as vendors spell it, without corporate endings and trailing commas and points."""
    bare = F.regexp_replace(F.trim(text(c)), "[,.]+$", "")
    return F.trim(F.regexp_replace(F.regexp_replace(F.trim(F.regexp_replace(bare, VENDOR_SUFFIX, "")), "[,.]+$", ""), r"\s+", " "))
