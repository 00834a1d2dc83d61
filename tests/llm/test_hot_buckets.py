"""Buckets of near-dedup that go on to finer tables."""

import random
from itertools import combinations

from feedmill.llm import simhash

from test_corpus_operators import groups


def test_hot_buckets_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(simhash, "HOT", 30)
    rnd = random.Random(5)
    low = (1 << 28) - 1
    base = rnd.getrandbits(64) & low  # all share three of the coarse segments
    fps = {base | rnd.getrandbits(36) << 28 for _ in range(300)}
    for f in list(fps)[:100]:
        for _ in range(3):
            g = f
            for b in rnd.sample(range(64), rnd.randint(1, 5)):
                g ^= 1 << b
            fps.add(g)
    center = rnd.getrandbits(64)
    fps |= {center ^ (1 << a) ^ (1 << b) for a, b in combinations(range(16), 2)}
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    got = [(r.u, r.v) for r in simhash.fingerprint_links(spark.createDataFrame([(f,) for f in signed], "fp long")).collect()]
    close = [(a, b) for a, b in combinations(signed, 2) if ((a ^ b) & (2**64 - 1)).bit_count() <= 4]
    assert len(close) > 300 and all(((a ^ b) & (2**64 - 1)).bit_count() <= 4 for a, b in got)
    assert groups(signed, got) == groups(signed, close)
