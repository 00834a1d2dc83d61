"""Archives whose scans are cut differently, long headers, nested archives, missing parts."""

import hashlib

import pytest

from feedmill.llm import warc
from feedmill.runtime import new_path


def record(body, kind="response"):
    return f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:page:7>\r\nContent-Length: {len(body.encode())}\r\n\r\n{body}\r\n\r\n"


def pages(n):
    inner = record("HTTP/1.1 200 OK\r\n\r\nabc")
    return [(i, f"http://x/{i}", [f"page {i} é" * (i % 40), f"a WARC/1.0 magic {i} WARC/1.1 twice", f"{i}{inner}{inner} tail", ""][i % 4]) for i in range(n)]


def test_scans_cut_differently_give_every_record(spark, monkeypatch):
    rows = pages(120)
    path = new_path(spark)
    warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3), path)
    sizes = iter([700, 5000, 300, 900, 100_000] * 4)
    real = warc._pieces

    def cut_anew(session, where):
        session.conf.set("spark.sql.files.maxPartitionBytes", str(next(sizes)))
        return real(session, where)

    monkeypatch.setattr(warc, "_pieces", cut_anew)
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = warc.read_archives(spark, path).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    want = {hashlib.sha256(h.encode()).hexdigest() for _, _, h in rows}
    assert len(got) == 120 and {r.payload_sha256 for r in got if r.record_type == "response"} == want


def test_long_http_header_and_no_header(spark, tmp_path):
    long = "HTTP/1.1 200 OK\r\nX-Long: " + "y" * 9000 + "\r\n\r\n" + "p" * 220
    bodies = [long, "no header at all", "HTTP/1.1 200 OK\r\n\r\n", long.replace("yyy", "WARC/1.0", 1)]
    (tmp_path / "a.warc").write_bytes("".join(map(record, bodies)).encode())
    got = sorted(warc.read_archives(spark, str(tmp_path)).collect(), key=lambda r: r.at)
    assert [r.payload_length for r in got] == [220, 16, 0, 220]


def test_a_missing_part_is_an_error(spark, tmp_path):
    whole = record("HTTP/1.1 200 OK\r\n\r\nwith WARC/1.0 inside " + "z" * 300)
    (tmp_path / "a.warc").write_bytes((record("first") + whole[:-200]).encode())
    with pytest.raises(Exception, match="missing"):
        warc.read_archives(spark, str(tmp_path)).collect()


def test_many_digests_join_by_page(spark, monkeypatch):
    monkeypatch.setattr(warc, "BROADCAST_DIGESTS", 0)
    text = "t" * 150
    rows = [(i, "u", text if i % 3 else f"{text}{i // 6}") for i in range(60)] + [(None, "u", text), (4, "v", text), (1, "w", text)]
    got = warc.round_trip(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len(got) == len(rows)
    same = [r for r in got if r.payload_digest == hashlib.sha256(text.encode()).hexdigest()]
    assert {(r.record_type, r.refers_to) for r in same if r.page_id != 1} == {("revisit", 1)} and all(r.record_type == "response" for r in same if r.page_id == 1)
