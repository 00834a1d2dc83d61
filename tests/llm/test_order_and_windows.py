"""The quality sample and edges; sums in two steps and hot keys of the mix."""

from collections import Counter

from pyspark.sql import functions as F

from feedmill.llm import mixing, quality


def test_quality_sample_is_bounded_and_not_a_prefix(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("same text").alias("text"))
    ids = [r.doc_id for r in quality.drawn(docs, 200).collect()]
    assert 100 < len(ids) <= 300 and max(ids) > 3000 and len(set(ids)) == len(ids)
    assert quality.drawn(docs.limit(50), 200).count() == 50


def test_rules_are_ordered_by_rejection_per_cost(spark):
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(60)) + (" ###" * 40 if i % 2 else "")) for i in range(40)]
    df = quality.with_features(spark.createDataFrame(rows, "doc_id long, text string"))
    order = quality.order_rules(df, repeats=2)
    assert {x["rule"] for x in order} == set(quality.RULES) and order == sorted(order, key=lambda x: -x["rank"])
    assert next(x["rejects"] for x in order if x["rule"].name == "symbol_heavy") == 0.5 and all(x["cost"] > 0 for x in order)


def test_quality_edges(spark):
    long = " ".join(f"word{i} other{i}" for i in range(60))
    rows = [(1, None), (2, ""), (3, long), (3, long), (None, long), (4, "a\n" * 80)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"words": F.lit(1), "_x": F.lit(2), "lines": F.lit("l"), "sorted": F.lit(0), "n_words": F.lit(-1)})
    got = quality.judge_quality(df).collect()
    assert Counter((r.doc_id, r.n_words, r.kept) for r in got) == Counter([(1, 0, False), (2, 0, False), (3, 120, True), (3, 120, True), (None, 120, True), (4, 80, False)])
    assert quality.judge_quality(df.limit(0)).count() == 0


def test_sums_in_two_steps(spark):
    rows = [(k, i * 3, (i * 7 + k) % 11) for k in range(3) for i in range(200)]
    got = mixing.upto(spark.createDataFrame(rows, "k long, o long, v long"), ["k"], "o", "v", "s", 16).collect()
    for r in got:
        assert r.s == sum(v for k, o, v in rows if k == r.k and o <= r.o)


def test_rows_that_nothing_tells_apart(spark):
    rows = [(7, "a b c", "s")] * 90 + [(i, "x " * (i % 9), "s" if i % 2 else None) for i in range(60)] + [(None, "q r", "t")] * 5
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns({"k": F.lit(1), "size": F.lit("z"), "rank": F.lit(0), "row": F.lit(5)})
    got = mixing.mix_report(df, 4).collect()
    assert len(got) == len(rows) and Counter((r.doc_id, r["size"]) for r in got) == Counter((i, len(t.split())) for i, t, _ in rows)
    assert all(r.taken <= 2 * r["size"] for r in got)
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r["size"], r.taken)
    assert sorted(map(key, got)) == sorted(map(key, mixing.mix_report(df.repartition(5), 4).collect()))
    assert mixing.mixed_documents(df, 4).columns == df.columns


def test_sources_beyond_the_broadcast(spark, monkeypatch):
    rows = [(i, "w " * (1 + i % 50), f"s{i % 70}") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    want = sorted((r.doc_id, r.taken) for r in mixing.mix_report(df, 4).collect())
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    assert sorted((r.doc_id, r.taken) for r in mixing.mix_report(df, 4).collect()) == want
