"""Quality rules as a short-circuit cascade.

Base features come from array functions on each row.  Every rule rejects on one
expression.  On a sample of the rows that reach the rules, each rule's cost and
selectivity are estimated: cost is the time of a job that evaluates the rule on the
sample many times over, less the time of the same job without the rule; selectivity is
the share of the sample that it rejects.  The cascade asks rules in falling order of
rejection per cost, each only of what all before it let pass.  The verdict is a
conjunction, so the order changes time and never results.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmill.llm.mixing import SPACE, WORD
from feedmill.runtime import cut, discard

SYMBOLS = "#*$%&|<>"
#: Rows that the order is estimated on, drawn from the whole table, how often a timing job repeats them, and its seed.
SAMPLE_ROWS = 2000
REPEATS = 8
SEED = 11
#: Least cost of a rule in seconds a row: below it timings are noise.
LEAST_COST = 1e-7


@dataclass(frozen=True)
class Rule:
    name: str
    reject: str  # SQL over text, words and the base features


RULES = (
    Rule("symbol_heavy", "n_symbols > 0.1 * n_words + 2"),
    Rule("mean_word_length", "word_chars < 2 * n_words or word_chars > 16 * n_words"),
    Rule("repeated_lines", "2 * n_dup_lines > size(filter(split(text, '\\n'), l -> l rlike '[^\\\\x20\\\\x09-\\\\x0D]'))"),
    Rule("repeated_words", "10 * n_repeat_words > 3 * n_words"),
    Rule("shouting", "length(regexp_replace(text, '[^\\\\p{Lu}]+', '')) > 0.5 * length(regexp_replace(text, '[^\\\\p{L}]+', ''))"),
    Rule("exclamations", "regexp_count(text, '!') > 0.2 * n_words"),
    Rule("few_letters", "length(regexp_replace(text, '[^\\\\p{L}]+', '')) < 0.6 * word_chars"),
    Rule("unfinished_lines", "regexp_count(text, '(\\\\.\\\\.\\\\.|\\u2026)[ \\\\t]*(\\n|$)') > 0.3 * (1 + length(text) - length(replace(text, '\\n', '')))"),
)


def settled(df: DataFrame, keep: list[str], made: list[str]) -> DataFrame:
    """The same columns, with ``made`` behind a generator of one row.

    The optimizer moves later filters and projections below projections by putting the
    expressions in place of the names; an array that a lambda reads would then be made
    anew for every element.  It does not move them below a generator.
    """
    return df.select(*keep, F.explode(F.array(F.struct(*made))).alias("_x")).select(*keep, *[F.col(f"_x.{c}").alias(c) for c in made])


def with_features(docs: DataFrame) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words to (doc_id, text); null text is empty.

    A window of three words is known by a 64-bit hash of its words.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    d = docs.select("doc_id", text.alias("text"))
    d = d.withColumn("words", F.filter(F.split("text", SPACE), lambda w: w != ""))
    d = d.withColumn("n_words", F.size("words").cast("long"))
    d = d.withColumn("word_chars", F.length(F.regexp_replace("text", SPACE, "")).cast("long"))
    d = d.withColumn("n_symbols", (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long"))
    d = d.withColumn("lines", F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    d = d.withColumn("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"))
    d = d.withColumn("h", F.transform("words", lambda w: F.xxhash64(w)))
    d = d.withColumn(
        "windows",
        F.when(F.size("h") < 3, F.array().cast("array<bigint>")).otherwise(
            F.zip_with(
                F.zip_with(F.slice("h", F.lit(1), F.size("h") - 2), F.slice("h", F.lit(2), F.size("h") - 2), lambda a, b: F.xxhash64(a, b)),
                F.slice("h", F.lit(3), F.size("h") - 2), lambda a, b: F.xxhash64(a, b),
            )
        ),
    )
    d = d.drop("h", "lines")
    # only texts with a repeated window pay for the sort that finds its places
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    d = d.withColumn(
        "sorted", F.when(repeats, F.array_sort(F.transform("windows", lambda w, i: F.struct(w.alias("w"), i.alias("i")))))
    )
    d = settled(d, ["doc_id", "text"], ["n_words", "word_chars", "n_symbols", "n_dup_lines", "sorted"])
    same = lambda s, k, step: F.coalesce(F.get("sorted", k + step)["w"] == s["w"], F.lit(False))
    d = d.withColumn(
        "places", F.array_sort(F.transform(F.filter("sorted", lambda s, k: same(s, k, -1) | same(s, k, 1)), lambda s: s["i"]))
    )
    covered = F.aggregate(
        "places", F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(3), p - a["last"])).alias("n")), lambda a: a["n"],
    )
    d = d.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))
    return settled(d, ["doc_id", "text"], ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"])


BASE_FAILED = "n_words < 50 or 100 * n_repeat_words > 50 * n_words"


def drawn(docs: DataFrame, rows: int = SAMPLE_ROWS, seed: int = SEED) -> DataFrame:
    """About ``rows`` rows, at most half as many again, each drawn by chance from all of the table."""
    total = docs.count()
    some = docs.sample(min(1.0, rows / total), seed) if total > rows else docs
    return some.limit(rows + rows // 2)


def _seconds(sample: DataFrame, reject: str, repeats: int) -> tuple[float, int]:
    """Time and result of counting over the repeated sample; the better of two runs, as the first compiles."""
    counted = sample.withColumn("_again", F.explode(F.sequence(F.lit(1), F.lit(repeats)))).agg(F.count_if(F.expr(reject)).alias("n"))
    took = []
    for _ in range(2):
        began = time.perf_counter()
        n = counted.first()["n"]
        took.append(time.perf_counter() - began)
    return min(took), n // repeats


def order_rules(featured: DataFrame, rules: tuple[Rule, ...] = RULES, repeats: int = REPEATS) -> list[dict]:
    """Rules with cost (seconds a row) and selectivity on the sample ``featured``, most rejection per cost first.

    The sample lies in one partition, so that a job's time is the time of its rows.
    """
    sample = cut(featured.coalesce(1))
    n = max(1, sample.count())
    bare, _ = _seconds(sample, "n_words < 0", repeats)
    found = []
    for rule in rules:
        took, rejected = _seconds(sample, rule.reject, repeats)
        cost = max(LEAST_COST, (took - bare) / (n * repeats))
        found.append({"rule": rule, "cost": cost, "rejects": rejected / n, "rank": (rejected + 0.5) / n / cost})
    discard(sample)
    return sorted(found, key=lambda x: -x["rank"])


def cascade(order: list[Rule]) -> Column:
    """Name of the first rule that rejects, null if none: a later rule is asked only if all before it pass."""
    verdict = F.when(F.expr(order[0].reject), order[0].name)
    for rule in order[1:]:
        verdict = verdict.when(F.expr(rule.reject), rule.name)
    return verdict


def judge_quality(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(doc_id, text) -> doc_id, the base features, base_failed, kept, rejected_by.

    ``rejected_by`` names the rule that came first in the measured order; it is null for
    kept rows and where the base test failed.  Null text is empty and fails; nulls in
    doc_id stay; repeated rows each keep a row; other columns are ignored; an empty table
    gives an empty result.
    """
    # cut first: a projection would otherwise move below the limit and run on every partition's share
    sample = cut(drawn(docs.select("doc_id", "text"), sample_rows))
    order = [x["rule"] for x in order_rules(with_features(sample).filter(f"not ({BASE_FAILED})"), rules)]
    discard(sample)
    d = with_features(docs).withColumn("base_failed", F.expr(BASE_FAILED))
    d = d.withColumn("rejected_by", F.when(~F.col("base_failed"), cascade(order)))
    return d.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & F.col("rejected_by").isNull()).alias("kept"), "rejected_by",
    )
