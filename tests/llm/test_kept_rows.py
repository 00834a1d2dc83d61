"""Which rows of a group stay."""

from feedmill.llm import simhash


def test_keep_one_of_repeated_and_null_ids(spark):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(40)) for x in "abcd")
    rows = [(5, a), (7, a), (5, b), (2, b), (3, c), (None, c), (None, d)]
    got = {tuple(r) for r in simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(5, a), (2, b), (3, c), (None, d)}
