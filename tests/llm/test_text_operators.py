"""Extraction, tokens, quality and toxicity against brute force, round trips and held-out labels."""

import hashlib
import html as H
import random
import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from feedmill.llm import bpe, html_extract, quality, queries, toxicity

SF = "/root/testdata/sf0.01"
DOC = "doc_id long, text string, lang string, source string, n_chars long"


def test_pages_give_their_article(spark):
    rows = spark.read.parquet(f"{SF}/pages.parquet").collect()
    for r in rows:
        article = re.search("<article>(.*)</article>", r.html, re.S)[1]
        blocks = re.split("</?(?:p|h1)>", re.sub("<br>", " ", re.sub("</?b>", "", article)))
        assert html_extract.main_text(r.html) == "\n\n".join(x for x in (" ".join(H.unescape(b).split()) for b in blocks) if x)


@pytest.mark.parametrize(
    "page, want",
    [
        (None, ""), ("", ""), ("<p>", ""), ("plain a < b &copy;", "plain a < b ©"),
        ("<body><div class='sidebar'><p>Side text, with much of it. More.</p></div><div><h1>T</h1><p>Main one, here.<p>Two &amp; three.</div></body>", "T\n\nMain one, here.\n\nTwo & three."),
        ("<main><p>Body text, yes.</p><section id='comments'><p>Reader, says. A lot, more.</p></section></main>", "Body text, yes."),
        ("<article><header><h1>H</h1><p>By X</p></header><p>Text, all.</p><form><p>mail</p></form></article>", "H\n\nText, all."),
        ("<article><p>a</p><script>var x='</p><p>no</p>'</script><!-- <p>c</p> --><ul><li>b<li>c</ul><p style='display: none'>h</p></article>", "a\n\nb\n\nc"),
        ("<article><p>one <button>Share</button> two <svg/>three <select><option>x</option></select></p></article>", "one two three"),
        ("<div class='header'><p>Top, of all.</p></div><div class='post'><div class='post-header'><h1>T</h1></div><p>Text, all of it.</p><div class='comments-area'><p>No, no.</p></div></div>", "T\n\nText, all of it."),
        ("<header><p>Site, head.</p></header><div id='content'><p>Real, text.</p></div><div class='cookie-notice'>We use, cookies.</div>", "Real, text."),
    ],
)
def test_page_cases(page, want):
    assert html_extract.main_text(page) == want


def test_pages_rows_and_columns(spark):
    df = spark.createDataFrame([(1, "u", "<p>x", "t"), (1, "u", "<p>x", "t"), (None, None, None, None)], "page_id long, url string, html string, text string")
    got = html_extract.extract_main_text(df).collect()
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in got) == [(0, "", 0), (1, "x", 1), (1, "x", 1)]
    assert html_extract.extract_main_text(df.limit(0)).count() == 0
    assert html_extract.main_text("<p>" + "<b>x" * 20000) == "x" * 20000


@pytest.fixture(scope="module")
def vocabulary():
    tok = pytest.importorskip("public_tokenizers")
    return bpe.load_vocabulary(tok.path(queries.VOCABULARY)), tok.PATTERN


def test_perfect_hash(vocabulary):
    v, _ = vocabulary
    assert sorted(v.slots) == list(range(v.n))
    assert all(v.rank(t) == r for r, t in enumerate(v.tokens))
    assert v.rank(b"\x00\x00 not a token") == -1


def test_bpe_equals_library(spark, vocabulary):
    import tiktoken

    v, pattern = vocabulary
    lib = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks={t: r for r, t in enumerate(v.tokens)}, special_tokens={})
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").limit(300).collect()]
    rnd = random.Random(5)
    alphabet = [chr(c) for c in range(300)] + list(" \n\t  　\u2028é😀中\ufeff") * 8
    texts += ["".join(rnd.choices(alphabet, k=rnd.randint(0, 60))) for _ in range(2000)] + ["", "a" * 5000, " " * 500, "<|endoftext|>"]
    encoder = bpe.Encoder(v, pattern)
    for t in texts:
        ids, said = encoder.encode(t)
        assert ids == lib.encode_ordinary(t) and said == ",".join(map(str, ids))
        assert bpe.decode(ids, v.tokens) == t.encode()


def test_bpe_query_rows(spark, vocabulary):
    import public_tokenizers as tok

    df = spark.createDataFrame([(1, "Hi there"), (1, "Hi there"), (None, None), (3, "")], "doc_id long, text string")
    got = bpe.encode_documents(df.withColumn("ids", F.lit("x")), tok.path(queries.VOCABULARY), tok.PATTERN).collect()
    empty = hashlib.sha256(b"").hexdigest()
    by_id = {r.doc_id: r for r in got}
    assert len(got) == 4 and by_id[1].decoded_sha256 == hashlib.sha256(b"Hi there").hexdigest() and len(by_id[1].ids) == by_id[1].n_tokens
    assert by_id[None].ids_sha256 == by_id[3].decoded_sha256 == empty and by_id[3].n_tokens == 0
    assert bpe.encode_documents(df.limit(0), tok.path(queries.VOCABULARY), tok.PATTERN).count() == 0


def base_features(text):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def test_quality_features_and_verdict(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = [(10_000, None), (10_001, ""), (10_002, "a b c a b c a b c"), (10_003, "x\nx\n\n \nx y\nx y"), (10_004, "a b a b a b"), (10_005, "w\u2028\x85v " * 60), (10_006, "#" * 400)]
    df = docs.select("doc_id", "text").unionByName(spark.createDataFrame(odd, "doc_id long, text string"))
    texts = {r.doc_id: r.text for r in df.collect()}
    got = quality.judge_quality(df).collect()
    assert len(got) == len(texts)
    for r in got:
        want = base_features(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert r.kept == (not r.base_failed and r.rejected_by is None)


def test_cascade_order_changes_no_verdict(spark):
    df = quality.with_features(spark.read.parquet(f"{SF}/documents.parquet"))
    one = df.select("doc_id", quality.cascade(list(quality.RULES)).isNull().alias("k"))
    two = df.select("doc_id", quality.cascade(list(reversed(quality.RULES))).isNull().alias("k"))
    assert one.exceptAll(two).count() == 0
    order = quality.order_rules(df)
    assert [x["rank"] for x in order] == sorted((x["rank"] for x in order), reverse=True) and all(0 <= x["rejects"] <= 1 for x in order)


def test_quality_agrees_with_labels(spark):
    got = quality.judge_quality(spark.read.parquet("/root/testdata/sf0.1/documents.parquet")).join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id")
    good = got.filter("quality = 1 and not base_failed").agg(F.avg(F.col("kept").cast("int"))).first()[0]
    bad = got.filter("quality = 0").agg(F.avg(F.col("kept").cast("int"))).first()[0]
    assert good > 0.97 and bad < 0.25


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = toxicity.score_documents(docs, labels).join(labels.select("doc_id", "toxic"), "doc_id").filter("held_out")
    r = got.agg(*[F.expr(f"count_if({c})").alias(a) for c, a in (("toxic = 1 and predicted = 1", "tp"), ("toxic = 0 and predicted = 1", "fp"), ("toxic = 1", "p"), ("toxic = 0", "n"))]).first()
    assert r.tp / r.p > 0.85 and r.fp / r.n < 0.01


def test_toxicity_ignores_held_out_labels(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    turned = labels.withColumn("toxic", F.when(toxicity.remainder(F.col("doc_id")) == 1, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (toxicity.score_documents(docs, x).select("doc_id", "score") for x in (labels, turned))
    assert a.exceptAll(b).count() == 0


def test_toxicity_edges(spark):
    docs = spark.createDataFrame([(1, None), (1, None), (None, ""), (3, "you idiot " * 3)], "doc_id long, text string").withColumn("score", F.lit("x"))
    labels = spark.createDataFrame([(1, 1, None)], "doc_id long, quality int, toxic int")
    got = toxicity.score_documents(docs, labels).collect()
    assert len(got) == 4 and all(0 <= r.score <= 1 and r.predicted == 0 for r in got)
    assert toxicity.keep_clean(docs.withColumn("_toxicity", F.lit(1)), labels).columns == ["doc_id", "text", "score", "_toxicity"]
    assert toxicity.score_documents(docs.limit(0), labels.limit(0)).count() == 0


def test_label_model_recovers_rates():
    import numpy as np

    rng = np.random.default_rng(1)
    y = (rng.random(3000) < 0.2).astype(float)
    fire = np.array([0.7, 0.5, 0.3])
    votes = (rng.random((3000, 3)) < np.where(y[:, None] == 1, fire, 0.01)).astype(float)
    votes = np.hstack([votes, votes[:, :1], votes.sum(axis=1, keepdims=True) == 0])
    post, shape = toxicity.label_model(votes, np.where(votes[:, 0] == 1, 0.9, 0.1))
    assert abs(shape[1]["fires_if_toxic"] - 0.5) < 0.15 and shape[0]["parent"] == 3 or shape[3]["parent"] == 0
    assert ((post > 0.5) == (y == 1)).mean() > 0.9


def test_rows_of_queries_are_whole(spark):
    con = duckdb.connect()
    n = con.execute(f"select count(*) from '{SF}/documents.parquet'").fetchone()[0]
    for name in ("op6_rule_cascade", "op9_weak_toxicity"):
        assert queries.QUERIES[name](spark, SF).count() == n


def test_training_rows_keep_their_bound(spark):
    docs = spark.createDataFrame([(i % 5, f"word{i} idiot" if i % 2 else f"word{i}") for i in range(50)] + [(None, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(5)] + [(None, 1)], "doc_id long, toxic int")
    seen = []
    real = toxicity.fit
    toxicity.fit = lambda rows: seen.extend(rows) or real([])
    try:
        toxicity.train(docs, labels, 3)
    finally:
        toxicity.fit = real
    assert 0 < len(seen) <= 3 and len({t for t, _ in seen}) == len(seen)


def test_voters_of_the_lists_need_no_label():
    rows = [(f"plain words number {i} here" + (" you are an idiot and scum" if i % 7 == 0 else ""), int(i % 7 == 0)) for i in range(400)]
    model = toxicity.fit(rows)
    names = {v["term"] for v in model.voters}
    assert {" idiot ", " scum "} <= names and any(v["term"] in toxicity.PATTERNS for v in model.voters)
    score = model.scorer()
    assert score("some other idiot text, scum") > 0.7 > score("plain words only") and score(None) < 0.5
