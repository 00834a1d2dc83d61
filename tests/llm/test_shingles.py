"""Near-duplicates of the pipeline against brute force over five-word shingles."""

import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from feedmill.llm import shingles

SF = "/root/testdata/sf0.01"


def plain(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def survivors(rows):
    """Ids of one document of each group, rows of (doc_id, text) with distinct ids."""
    sets = {d: plain(t) for d, t in rows}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = 0
    for a, b in combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if min(len(x), len(y)) * 5 >= max(len(x), len(y)) * 4 and 5 * len(x & y) >= 4 * len(x | y):
            links += rows_differ(rows, a, b)
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return {d for d in sets if find(d) == d}, links


def rows_differ(rows, a, b):
    texts = dict(rows)
    return texts[a] != texts[b]


def test_near_dedup_equals_brute_force(spark):
    rnd = random.Random(5)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").limit(500).collect()]
    for i, (_, text) in enumerate(rows[:120]):
        words = text.split()
        for _ in range(max(1, len(words) // 55)):
            words[rnd.randrange(len(words))] = "changed"
        rows.append((10_000 + i, " ".join(words)))
    stem = [f"w{i}" for i in range(80)]
    for i in range(60):  # a chain whose ends have little in common
        stem[rnd.randrange(80)] = f"x{i}"
        rows.append((20_000 + i, " ".join(stem)))
    rows += [(30_000, None), (30_001, ""), (30_002, " \n"), (30_003, "One two"), (30_004, "one  TWO")]
    want, links = survivors(rows)
    assert links > 100
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("h", F.lit("x"))
    assert {r.doc_id for r in corpus_pipeline.near_dedup(spark, df, SF).collect()} == want
    assert corpus_pipeline.near_dedup(spark, df.limit(0), SF).count() == 0


def test_near_dedup_of_repeated_and_null_ids(spark):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(40)) for x in "abcd")
    rows = [(5, a), (7, a), (5, b), (2, b), (3, c), (None, c), (None, d), (None, d + " e")]
    got = sorted(map(tuple, shingles.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=repr)
    assert len(got) == 4 and {(5, a), (2, b), (3, c)} < set(got)


def test_near_dedup_goes_through_simhash(spark, monkeypatch):
    """What SimHash links is checked first, and the join has nothing left to compare."""
    long = " ".join(f"w{i}" for i in range(300))
    said = "said again and again by all them " * 60  # one fingerprint, few shingles in common
    rows = [(1, long), (2, long + " end"), *((k, said + " ".join(f"{k}x{i}" for i in range(20))) for k in (3, 4))]
    compared, verified = [], shingles._verified

    def counted(texts, pairs):
        compared.append(pairs.count())
        return verified(texts, pairs)

    monkeypatch.setattr(shingles, "_verified", counted)
    got = corpus_pipeline.near_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string"), SF).collect()
    assert sorted(r.doc_id for r in got) == [1, 3, 4] and compared == [2, 0, 0]


def test_texts_that_share_a_passage_are_not_compared(spark, monkeypatch):
    shared = [" ".join(f"p{i}w{j}" for j in range(25)) for i in range(41)]
    rows = [(i, " ".join([shared[i], *(f"d{i}w{j}" for j in range(200)), shared[i + 1]])) for i in range(40)]
    rows.append((100, rows[0][1] + " more"))
    compared, verified = [], shingles._verified

    def counted(texts, pairs):
        compared.append(pairs.count())
        return verified(texts, pairs)

    monkeypatch.setattr(shingles, "_verified", counted)
    links = shingles.near_links(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(links) == 1 and sum(compared) <= 2


def edited(rnd, stem, share, mark):
    """The stem's words, each replaced by one of its own at the rate ``share``."""
    return " ".join(f"{mark}e{i}" if rnd.random() < share else w for i, w in enumerate(stem))


@pytest.mark.parametrize("sample", [1, 20_000])
def test_near_copies_below_the_threshold_are_not_compared_pairwise(spark, monkeypatch, sample):
    """However little the sample tells of the shingles' frequencies."""
    rnd = random.Random(3)
    stem = [f"w{i}" for i in range(400)]
    rows = [(i, edited(rnd, stem, 0.05, f"d{i}")) for i in range(70)]
    rows += [(100 + i, edited(rnd, rows[i][1].split(), 0.005, f"c{i}")) for i in range(20)]
    want, links = survivors(rows)
    assert 15 <= links <= 40
    compared, verified = [], shingles._verified

    def counted(texts, pairs):
        compared.append(pairs.count())
        return verified(texts, pairs)

    monkeypatch.setattr(shingles, "_verified", counted)
    monkeypatch.setattr(shingles, "SAMPLE_ROWS", sample)
    got = shingles.keep_one(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id for r in got.collect()} == want and compared[-1] <= 60


def test_links_near_the_threshold_equal_brute_force_whatever_the_sample(spark, monkeypatch):
    rnd = random.Random(7)
    rows = []
    for g in range(12):
        stem = [f"g{g}w{i}" for i in range(rnd.choice([6, 30, 120, 400]))]
        rows += [(len(rows) + i, edited(rnd, stem, rnd.choice([0.005, 0.01, 0.015, 0.02, 0.03]), f"g{g}d{i}")) for i in range(25)]
    want, links = survivors(rows)
    assert links > 100
    monkeypatch.setattr(shingles, "SAMPLE_ROWS", 1)
    got = shingles.keep_one(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id for r in got.collect()} == want
