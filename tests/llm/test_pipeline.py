"""The pipeline's stages against brute force; clean documents stay."""

from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from feedmill.llm import line_dedup, mixing, queries, simhash, toxicity

SF = "/root/testdata/sf0.001"


def root_of(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.fixture(scope="module")
def stages(spark):
    out = [spark.read.parquet(f"{SF}/documents.parquet")]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stage(spark, out[-1], SF).cache())
    return out


def test_names_and_columns(stages):
    assert [k for k, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "simhash_near_dedup", "source_mixing", "byte_bpe"]
    for df in stages[1:-1]:
        assert df.columns == stages[0].columns and df.count() > 0


def test_toxic_documents_go(spark, stages):
    model = toxicity.train(stages[0], spark.read.parquet(f"{SF}/labels.parquet"))
    score = model.scorer()
    want = {r.doc_id for r in stages[0].collect() if score(r.text) < toxicity.THRESHOLD}
    assert {r.doc_id for r in stages[1].collect()} == want


def test_repeated_lines_go(stages):
    lines, docs = {}, {r.doc_id: r.text for r in stages[1].collect()}
    for d, t in docs.items():
        for i, x in line_dedup.lines_of(t):
            lines[d, i] = x
    texts = sorted(set(lines.values()))
    near = [
        (a, b) for a, b in combinations(texts, 2)
        if abs(len(a) - len(b)) <= 2 and min(len(a), len(b)) >= 12 and sum(((c := Counter(a)) - (e := Counter(b))).values()) + sum((e - c).values()) <= 4 and line_dedup.within(a, b, min(2, min(len(a), len(b)) // 12))
    ]
    root, first = root_of(texts, near), {}
    for place in sorted(lines):
        first.setdefault(root[lines[place]], place)
    want = {}
    for d, t in docs.items():
        kept = [x for i, x in enumerate((t or "").split("\n")) if (d, i) not in lines or first[root[lines[d, i]]] == (d, i)]
        if len(kept) == len((t or "").split("\n")) or "\n".join(kept).strip():
            want[d] = "\n".join(kept)
    assert {r.doc_id: r.text for r in stages[2].collect()} == want


def test_one_of_each_group_stays(stages):
    fp = {r.doc_id: simhash.simhash64(r.text) & (2**64 - 1) for r in stages[2].collect()}
    root = root_of(fp, [(a, b) for a, b in combinations(fp, 2) if (fp[a] ^ fp[b]).bit_count() <= 4])
    assert {r.doc_id for r in stages[3].collect()} == {d for d in fp if root[d] == d}


def test_mix_takes_what_the_report_says(stages):
    want = {r.doc_id: r.taken for r in mixing.mix_report(stages[3], corpus_pipeline.BLOCK_WORDS).collect() if r.taken}
    got = Counter()
    for r in stages[4].collect():
        got[r.doc_id] += len(r.text.split())
    assert dict(got) == want


def test_tokens_equal_library(stages):
    import public_tokenizers as tok
    import tiktoken

    ranks = {t: r for r, t in enumerate(corpus_pipeline.bpe.read_ranks(tok.path(queries.VOCABULARY)))}
    lib = tiktoken.Encoding("own", pat_str=tok.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = sorted((r.doc_id, lib.encode_ordinary(r.text)) for r in stages[4].collect())
    assert sorted((r.doc_id, list(r.ids)) for r in stages[5].collect()) == want


def test_planted_cases(spark):
    filler = " ".join(f"word{i}" for i in range(120))
    rows = [(1, filler), (2, filler), (3, filler.replace("word60 ", "")), (4, " ".join(f"other{i}" for i in range(90)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.length("text").cast("long")})
    got = sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, SF).collect())
    assert got in ([1, 4], [1, 3, 4])
    assert sorted(r.doc_id for r in corpus_pipeline.dedup_lines(spark, docs, SF).collect()) == [1, 3, 4]


def test_every_operator_has_a_query():
    import __spark_entry__

    assert {f"op{n}" for n in range(1, 11)} == {q.split("_")[0] for q in queries.QUERIES}
    assert set(queries.QUERIES) | {"pipeline"} <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
