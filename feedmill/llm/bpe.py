"""Byte-level BPE with a two-tier lookup.

Tier one resolves a whole pre-token through a minimal perfect hash over the
vocabulary.  A miss goes to tier two: its bytes form a linked list, and a heap of
adjacent pairs merges the lowest rank first, leftmost on ties.  Pair ranks come
from the same hash.  A task remembers pre-tokens it has already resolved, in a
dictionary of bounded size.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmill.runtime import FORGET, tidied

MEMO = 1 << 17  # remembered pre-tokens of a worker, in each of two generations
PAIRS = 1 << 18  # remembered pairs of ids
LONG = 64  # longer pre-tokens are not remembered
_LOADED: dict[tuple[str, str, int], Encoder] = {}
FORGET.append(_LOADED.clear)


class PerfectVocabulary:
    """Ranks of byte strings in a minimal perfect hash (hash, displace, verify)."""

    def __init__(self, tokens: list[bytes], per_bucket: int = 4) -> None:
        n = len(tokens)
        self.tokens, self.n, self.buckets = tokens, n, max(1, n // per_bucket)
        self.shift = [0] * self.buckets
        self.slots = [-1] * n
        self.pairs: dict[int, int] = {}
        by_bucket: list[list[tuple[int, int]]] = [[] for _ in range(self.buckets)]
        for rank, token in enumerate(tokens):
            h = xxhash.xxh3_64_intdigest(token)
            by_bucket[h % self.buckets].append((h, rank))
        free_from = 0
        for bucket in sorted(range(self.buckets), key=lambda b: -len(by_bucket[b])):
            members = by_bucket[bucket]
            if not members:
                break
            if len(members) == 1:  # the rest of the table: a free slot is named outright
                while self.slots[free_from] >= 0:
                    free_from += 1
                self.shift[bucket] = -1 - free_from
                self.slots[free_from] = members[0][1]
                continue
            d = 0
            while True:
                places = [self._place(h, d) for h, _ in members]
                if len(set(places)) == len(places) and all(self.slots[p] < 0 for p in places):
                    break
                d += 1
                if d > 1 << 20:
                    raise ValueError("two tokens are equal or their hashes collide")
            self.shift[bucket] = d
            for p, (_, rank) in zip(places, members):
                self.slots[p] = rank

        self.single = [self.rank(bytes([c])) for c in range(256)]
        if min(self.single) < 0:
            raise ValueError("the vocabulary lacks a single byte")

    def _place(self, h: int, d: int) -> int:
        x = (h ^ (d * 0x9E3779B97F4A7C15)) & 0xFFFFFFFFFFFFFFFF
        x = ((x ^ (x >> 31)) * 0xBF58476D1CE4E5B9) & 0xFFFFFFFFFFFFFFFF
        return (x ^ (x >> 29)) % self.n

    def rank(self, token: bytes) -> int:
        """Rank of ``token``, or -1."""
        h = xxhash.xxh3_64_intdigest(token)
        d = self.shift[h % self.buckets]
        r = self.slots[-1 - d if d < 0 else self._place(h, d)]
        return r if r >= 0 and self.tokens[r] == token else -1

    def pair(self, left: int, right: int) -> int:
        """Rank of two ids' joined bytes, or -1; remembered in a dictionary of bounded size."""
        if len(self.pairs) >= PAIRS:
            self.pairs.clear()
        r = self.pairs[left * self.n + right] = self.rank(self.tokens[left] + self.tokens[right])
        return r

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ids of one pre-token."""
        whole = self.rank(piece)
        if whole >= 0:
            return [whole]
        ids = [self.single[c] for c in piece]
        n, size, known, pair, push, pop = len(ids), self.n, self.pairs.get, self.pair, heapq.heappush, heapq.heappop
        heap = []
        for i in range(n - 1):
            r = known(ids[i] * size + ids[i + 1])
            if r is None:
                r = pair(ids[i], ids[i + 1])
            if r >= 0:
                heap.append((r, i, ids[i], i + 1, ids[i + 1]))
        if not heap:
            return ids
        heapq.heapify(heap)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while heap:
            r, i, a, j, b = pop(heap)
            if ids[i] != a or ids[j] != b or after[i] != j:
                continue  # one of the parts has changed since
            ids[i], ids[j] = r, -1
            j = after[i] = after[j]
            h = before[i]
            if h >= 0:
                q = known(ids[h] * size + r)
                if q is None:
                    q = pair(ids[h], r)
                if q >= 0:
                    push(heap, (q, h, ids[h], i, r))
            if j < n:
                before[j] = i
                q = known(r * size + ids[j])
                if q is None:
                    q = pair(r, ids[j])
                if q >= 0:
                    push(heap, (q, i, r, j, ids[j]))
        return [x for x in ids if x >= 0]


def read_ranks(path: str) -> list[bytes]:
    """Tokens of a rank file in the order of their ranks, which must be 0..n-1."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(t): int(r) for t, r in (line.split() for line in f if line.strip())}
    tokens = sorted(ranks, key=ranks.__getitem__)
    if [ranks[t] for t in tokens] != list(range(len(tokens))):
        raise ValueError("ranks must be 0..n-1")
    return tokens


class Encoder:
    """Encodes texts; remembers resolved pre-tokens."""

    def __init__(self, vocabulary: PerfectVocabulary, pattern: str, remembered: int = MEMO) -> None:
        self.remembered = remembered
        self.vocabulary, self.find = vocabulary, regex.compile(pattern).findall
        self.memo: dict[str, tuple[str, tuple[int, ...]]] = {}
        self.older: dict[str, tuple[str, tuple[int, ...]]] = {}

    def piece(self, text: str) -> tuple[str, tuple[int, ...]]:
        """The ids as text, and the ids."""
        got = self.older.get(text)
        if got is None:
            ids = tuple(self.vocabulary.encode_piece(text.encode()))
            got = (",".join(map(str, ids)), ids)
        if len(text) <= LONG:
            if len(self.memo) >= self.remembered:
                self.memo, self.older = {}, self.memo
            self.memo[text] = got
        return got

    def encode(self, text: str) -> tuple[list[int], str]:
        """Ids, and their decimal text joined by commas."""
        known, piece, ids, said = self.memo.get, self.piece, [], []
        for p in self.find(text):
            s, more = known(p) or piece(p)
            ids += more
            said.append(s)
        return ids, ",".join(said)


def decode(ids: list[int], tokens: list[bytes]) -> bytes:
    return b"".join([tokens[i] for i in ids])


def _encoder(name: str, vocabulary: PerfectVocabulary, pattern: str, remembered: int) -> Encoder:
    """One for each worker process, vocabulary and pattern."""
    key = (name, pattern, remembered)
    if key not in _LOADED:
        _LOADED[key] = Encoder(vocabulary, pattern, remembered)
    return _LOADED[key]


@lru_cache(maxsize=4)
def load_vocabulary(path: str) -> PerfectVocabulary:
    return PerfectVocabulary(read_ranks(path))


def encode_documents(docs: DataFrame, vocabulary_path: str, pattern: str, with_ids: bool = True, remembered: int = MEMO) -> DataFrame:
    """(doc_id, text) -> doc_id, n_tokens, ids_sha256, decoded_sha256 (and ids).

    The hash table is built on the driver and broadcast; its size is the vocabulary's,
    not the data's.  A null text is encoded as empty: no ids, hashes of nothing.
    A worker keeps up to twice ``remembered`` resolved pre-tokens, at some 300 bytes each.
    Nulls in doc_id stay and repeated rows each keep a row; other columns are ignored.
    """
    vocabulary = load_vocabulary(vocabulary_path)
    name = hashlib.sha256(b"\n".join(vocabulary.tokens)).hexdigest()
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(name, sent.value, pattern, remembered)
        known = encoder.vocabulary.tokens
        for b in batches:
            counts, shas, backs, lists = [], [], [], []
            for t in b.column(1):
                ids, said = encoder.encode(t.as_py() or "")
                counts.append(len(ids))
                shas.append(hashlib.sha256(said.encode()).hexdigest())
                backs.append(hashlib.sha256(decode(ids, known)).hexdigest())
                if with_ids:
                    lists.append(np.array(ids, np.int32))
            cols = [b.column(0), pa.array(counts, pa.int64()), pa.array(shas, pa.string()), pa.array(backs, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                cols, names = [*cols, pa.array(lists, pa.list_(pa.int32()))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(cols, names)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(tidied(run, keep=True), schema)
