"""Archives whose urls hold the version magic."""

from feedmill.llm import warc


def test_magic_in_a_url(spark):
    rows = [(1, "http://x/a", "one"), (2, "http://x/WARC/1.0/spec", "two"), (3, "http://x/WARC/1.WARC/1.1", "three"), (4, "u", "WARC/1.0 four")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    assert sorted((r.page_id, r.payload_bytes) for r in warc.round_trip(df).collect()) == [(i, len(h)) for i, _, h in rows]
