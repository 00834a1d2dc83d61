"""Canonical forms of listed URLs, lists from tables, and the filter's size."""

import numpy as np

from feedmill.llm import url_filter


def verdicts(spark, urls, entries):
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    return {r.page_id: r for r in url_filter.judge_urls(df, entries).collect()}


def test_forms_of_a_listed_host(spark):
    forms = [
        "http://casino-win.example.com", "http://casino-win.example.com:8080/", "http://u@casino-win.example.com/x", "http://casino-win.example.com./",
        "http://M.Casino-Win.example.com?q", "http://casino-win.example.com/../a//b/./c", "http://u:p@casino-win.example.com.:80#f",
    ]
    clean = ["http://casino-win.example.com.evil.test/", "http://notcasino-win.example.com/", "http://example.com/casino-win.example.com/", "casino-win.example.com/", None, "", "http:///casino-win.example.com"]
    got = verdicts(spark, forms + clean, url_filter.default_entries(spark))
    for i, u in enumerate(forms + clean):
        assert got[i].verdict == ("block" if i < len(forms) else "allow"), u
    # the contract's host and path stay as they are
    assert (got[1].host, got[1].path) == ("casino-win.example.com:8080", "/") and (got[2].host, got[0].path) == ("u@casino-win.example.com", "")


def test_list_from_a_table_with_paths(spark):
    table = spark.createDataFrame([("https://Site.test/Bad%2Dpart/?x",), ("other.test",), (None,), ("",), ("site.test/Bad-part/deep/",)], "url string")
    entries = url_filter.listed_entries(table)
    urls = ["http://site.test/Bad-part/1", "http://a.site.test:1/x/../%42ad-part/deep/1", "http://site.test/bad-part/", "http://site.test/", "ftp://www.other.test", "http://other.test/%7Ea"]
    got = verdicts(spark, urls, entries)
    assert [got[i].listed for i in range(len(urls))] == ["site.test/Bad-part/", "site.test/Bad-part/deep/", None, None, "other.test/", "other.test/"]
    assert all(r.rule is None for r in got.values())


def test_filter_keeps_within_its_size_and_finds_every_key(spark):
    keys = [f"h{i}.test/" for i in range(3000)]
    entries = spark.createDataFrame([(k,) for k in keys], "key string")
    bloom = url_filter.filter_of(entries, len(keys))
    plain = url_filter.BlockedBloom(len(keys))
    plain.add(url_filter.key_hashes(keys))
    assert (bloom.bits == plain.bits).all() and bloom.may_hold(url_filter.key_hashes(keys)).all()
    assert url_filter.BlockedBloom(10**9).bits.nbytes <= url_filter.MAX_FILTER_MB << 20
    assert url_filter.filter_of(entries.limit(0), 0).may_hold(np.zeros(1, np.uint64)).sum() == 0


def test_ids_survive_a_shuffled_table(spark):
    rows = [(i, f"http://{'m.casino-win' if i % 3 else 'x'}.example.com/{i}") for i in range(500)]
    df = spark.createDataFrame(rows, "page_id long, url string").repartition(7)
    got = url_filter.judge_urls(df, url_filter.default_entries(spark)).collect()
    assert {r.page_id: r.verdict for r in got} == {i: "block" if i % 3 else "allow" for i, _ in rows} and len(got) == 500
