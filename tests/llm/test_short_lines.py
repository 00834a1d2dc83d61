"""Lines of few words or characters in op8 and the pipeline."""

from itertools import combinations

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

import corpus_pipeline
from feedmill.llm import line_dedup, queries

ROWS = [
    (1, "Les.\nHeti, eror anesti.\n一二三四五六七八九十一二三四"), (2, "Les.\nHeti eror anesti.\nwords of its own in the second document"),
    (3, "Lis.\n一二三四五六七八九十一二三五"), (4, "Erheed. Titionly.\nonly once said here in the fourth document"), (5, "Erheed. Titionly.\nfifth"),
    (6, "twenty-three characters\nhalf"), (7, "twenty-three charactersxx\nhall"),
]


def test_short_lines_are_classed(spark, tmp_path):
    pq.write_table(pa.table({"doc_id": [r[0] for r in ROWS], "text": [r[1] for r in ROWS]}), tmp_path / "documents.parquet")
    got = {(r.doc_id, r.line_no): r for r in queries.op8_segment_edit_join(spark, str(tmp_path)).collect()}
    assert len(got) == sum(len(t.split("\n")) for _, t in ROWS)
    assert {k for k, r in got.items() if r.dropped} == {(2, 0), (2, 1), (3, 1), (5, 0)}
    assert (got[2, 1].class_doc_id, got[2, 1].class_line_no, got[2, 1].n_links) == (1, 1, 1)


def test_short_lines_equal_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").limit(400)
    short = {x for r in docs.collect() for _, x in line_dedup.lines_of(r.text) if line_dedup.CHARS_PER_EDIT <= len(x) < 24}
    short |= {x[:-1] for x in sorted(short)[:40] if len(x) > line_dedup.CHARS_PER_EDIT}
    df = spark.createDataFrame(list(enumerate(sorted(short))), "doc_id long, text string")
    got = line_dedup.line_classes(df).agg(F.sum("n_links")).first()[0]
    assert got == 2 * sum(line_dedup.within(a, b, 1) for a, b in combinations(sorted(short), 2)) > 0


def test_short_lines_go(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string")
    got = {r.doc_id: r.text for r in corpus_pipeline.dedup_lines(spark, df, "").collect()}
    assert got[2] == "words of its own in the second document" and got[3] == "Lis." and got[5] == "fifth" and got[7] == ROWS[6][1]
