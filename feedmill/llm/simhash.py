"""SimHash near-duplicates through pivot distance tables.

Every distinct fingerprint gets a table of Hamming distances to ``PIVOTS``
reference fingerprints, kept per bit segment: entry (s, r) is the distance to
reference r inside segment s, a row sum is the distance to the whole reference.
Two fingerprints that differ in at most ``max_bits`` bits agree on the complete
table rows of at least ``segments - max_bits`` segments, so equality of table
rows over each choice of that many segments yields every pair that can link.
Inside such a bucket pairs whose whole-reference distances differ by more than
``max_bits`` in any coordinate are discarded, and the rest is verified by xor.
A bucket emits a spanning forest of its links, never all of its pairs.

A bucket of more than ``HOT`` fingerprints is not held: its rows go on, dealt out again
by rows of finer tables, in which close pairs agree on more segments.  Only what the
finest table still holds together is compared within a task.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmill.llm.components import connected_components, keep_first
from feedmill.runtime import cut, tidied

PIVOTS = 12
SMALL = 48
#: Fingerprints of a bucket that a task holds, unless the table is the finest.
HOT = 1 << 13
#: Segments that the tables have beyond ``max_bits``, coarse to fine: pairs agree on so many.
LEVELS = (3, 5, 8)
CHUNK = 1 << 15


def simhash64(text: str | None, words_per_shingle: int = 4) -> int:
    """Signed 64-bit SimHash over XXH64 (seed 42) of word shingles; 0 without words."""
    words = text.encode().lower().split() if text else []
    n = len(words)
    if not n:
        return 0
    size = min(words_per_shingle, n)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    first, last = starts[: n - size + 1].tolist(), ends[size - 1 :].tolist()
    total, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for k in range(0, len(first), CHUNK):
        h = np.array([digest(joined[a:b], 42) for a, b in zip(first[k : k + CHUNK], last[k : k + CHUNK])], "<u8")
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * total > len(first)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def with_fingerprint(docs: DataFrame, words_per_shingle: int = 4) -> DataFrame:
    """(doc_id, text) -> (doc_id, fp long)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [simhash64(t.as_py(), words_per_shingle) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps, pa.int64())], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(tidied(run), "doc_id long, fp long")


def references(n: int = PIVOTS) -> np.ndarray:
    """The reference fingerprints: pseudorandom, fixed by their index."""
    return np.array([xxhash.xxh64_intdigest(f"reference {r}") for r in range(n)], np.uint64)


def segment_masks(segments: int) -> list[int]:
    edges = [64 * s // segments for s in range(segments + 1)]
    return [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]


def segment_table(fps: np.ndarray, segments: int) -> np.ndarray:
    """Distances to each reference inside each segment: shape (n, segments, PIVOTS)."""
    off = fps.view(np.uint64)[:, None] ^ references()[None, :]
    masks = np.array(segment_masks(segments), np.uint64)
    return np.bitwise_count(off[:, None, :] & masks[None, :, None])


def pivot_table(fps: np.ndarray) -> np.ndarray:
    """Distances to each whole reference: shape (n, PIVOTS)."""
    return np.bitwise_count(fps.view(np.uint64)[:, None] ^ references()[None, :]).astype(np.int8)


def table_keys(fps: np.ndarray, segments: int, agree: int) -> tuple[np.ndarray, np.ndarray]:
    """For each choice of ``agree`` segments the key of their table rows."""
    table = segment_table(fps, segments).astype(np.uint64)
    base = np.uint64(64 // segments + 2)
    rows = np.zeros(table.shape[:2], np.uint64)
    for r in range(PIVOTS):
        rows = rows * base + table[:, :, r]
    keys = []
    mix = np.uint64(0x9E3779B97F4A7C15)
    for k, chosen in enumerate(combinations(range(segments), agree)):
        key = np.full(len(fps), k + 1, np.uint64)
        for s in chosen:
            key = (key ^ rows[:, s]) * mix
            key ^= key >> np.uint64(29)
        keys.append(key.view(np.int64))
    return np.concatenate(keys), np.tile(fps, len(keys))


def _pairs_of_small(keys: np.ndarray, fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of all runs of equal keys, of at most SMALL rows each."""
    table, left, right = pivot_table(fps), [], []
    d = 1
    while d < len(keys):
        i = np.flatnonzero(keys[:-d] == keys[d:])
        if not len(i):
            break
        i = i[(np.abs(table[i] - table[i + d]) <= max_bits).all(axis=1)]
        i = i[np.bitwise_count((fps[i] ^ fps[i + d]).view(np.uint64)) <= max_bits]
        left.append(fps[i])
        right.append(fps[i + d])
        d += 1
    none = np.array([], np.int64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def _forest_of_large(fps: np.ndarray, max_bits: int) -> tuple[list[int], list[int]]:
    """Spanning forest of the links in one run: each node is compared with those not reached yet."""
    table, left, right = pivot_table(fps), [], []
    rest = np.arange(1, len(fps))
    queue = [0]
    while len(rest) or queue:
        if not queue:
            queue, rest = [int(rest[0])], rest[1:]
        at = queue.pop()
        if not len(rest):
            continue
        near = rest[(np.abs(table[rest] - table[at]) <= max_bits).all(axis=1)]
        near = near[np.bitwise_count((fps[near] ^ fps[at]).view(np.uint64)) <= max_bits]
        if len(near):
            left += [int(fps[at])] * len(near)
            right += fps[near].tolist()
            queue += near.tolist()
            rest = np.setdiff1d(rest, near, assume_unique=True)
    return left, right


def _links_of_sorted(keys: np.ndarray, fps: np.ndarray, max_bits: int) -> pa.RecordBatch:
    cuts = np.flatnonzero(np.diff(keys)) + 1
    edges = np.concatenate(([0], cuts, [len(keys)]))
    lengths = np.diff(edges)
    each = np.repeat(lengths, lengths)
    keep = (each > 1) & (each <= SMALL)
    u, v = _pairs_of_small(keys[keep], fps[keep], max_bits)
    more = [_forest_of_large(fps[edges[k] : edges[k + 1]], max_bits) for k in np.flatnonzero(lengths > SMALL)]
    u = np.concatenate([u, *(np.array(a, np.int64) for a, _ in more)])
    v = np.concatenate([v, *(np.array(b, np.int64) for _, b in more)])
    pair = np.unique(np.stack([np.minimum(u, v), np.maximum(u, v)]), axis=1)
    return pa.RecordBatch.from_arrays([pa.array(pair[0]), pa.array(pair[1])], ["u", "v"])


def _links_of_level(rows: DataFrame, max_bits: int, agree: int, last: bool) -> DataFrame:
    """(key, fp) -> (u, v, hot): links (u, v) of each bucket; of a hot one its rows as (key, fp) with ``hot`` set."""

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []  # rows of the key that may go on, eight bytes a fingerprint
        size, passing = 0, None

        def sent(k: np.ndarray, f: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(k), pa.array(f), pa.array(np.ones(len(k), bool))], ["u", "v", "hot"])

        def found(k: np.ndarray, f: np.ndarray) -> Iterator[pa.RecordBatch]:
            if not last:
                cuts = np.flatnonzero(np.diff(k)) + 1
                lengths = np.diff(np.concatenate(([0], cuts, [len(k)])))
                big = np.repeat(lengths, lengths) > HOT
                if big.any():
                    yield sent(k[big], f[big])
                    k, f = k[~big], f[~big]
            if len(k):
                b = _links_of_sorted(k, f, max_bits)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.zeros(b.num_rows, bool))], ["u", "v", "hot"])

        for b in batches:
            if not b.num_rows:
                continue
            k, f = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            if passing is not None:
                stop = int(np.searchsorted(k, passing, side="right"))
                if stop:
                    yield sent(k[:stop], f[:stop])
                    k, f = k[stop:], f[stop:]
                if not len(k):
                    continue
                passing = None
            if held and k[0] == k[-1] and held[0][0][0] == k[0]:
                held.append((k, f))
                size += len(k)
                if size > HOT and not last:
                    for x, y in held:
                        yield sent(x, y)
                    held, size, passing = [], 0, k[0]
                continue
            k, f = np.concatenate([*(x for x, _ in held), k]), np.concatenate([*(x for _, x in held), f])
            at = int(np.searchsorted(k, k[-1]))
            if at:
                yield from found(k[:at], f[:at])
            held, size = [(k[at:], f[at:])], len(k) - at
            if size > HOT and not last:
                yield sent(*held[0])
                held, size, passing = [], 0, k[-1]
        if held:
            yield from found(np.concatenate([x for x, _ in held]), np.concatenate([x for _, x in held]))

    return rows.repartition("key").sortWithinPartitions("key").mapInArrow(tidied(linked), "u long, v long, hot boolean")


def fingerprint_links(fps: DataFrame, max_bits: int = 4, levels: tuple[int, ...] = LEVELS) -> DataFrame:
    """Distinct fingerprints (fp) -> links (u, v) that span every group of fingerprints within ``max_bits``."""
    if max_bits + max(levels) > 16:
        raise ValueError("a table has at most 16 segments")
    rows, out = fps.select("fp"), None
    for n, agree in enumerate(levels):

        def keyed(batches: Iterator[pa.RecordBatch], agree=agree) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if b.num_rows:
                    k, f = table_keys(b.column("fp").to_numpy(zero_copy_only=False), max_bits + agree, agree)
                    if b.num_columns > 1:  # within the bucket that the rows come from
                        old = np.tile(b.column("key").to_numpy(zero_copy_only=False), len(k) // b.num_rows).view(np.uint64)
                        k = (k.view(np.uint64) ^ (old * np.uint64(0x9E3779B97F4A7C15))).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(f)], ["key", "fp"])

        got = _links_of_level(rows.mapInArrow(tidied(keyed), "key long, fp long"), max_bits, agree, n + 1 == len(levels))
        got = cut(got)
        links = got.filter("not hot").select("u", "v")
        out = links if out is None else out.unionByName(links)
        rows = got.filter("hot").select(F.col("u").alias("key"), F.col("v").alias("fp"))
        if n + 1 == len(levels) or not rows.take(1):
            break
    return out.distinct()


def simhash_groups(docs: DataFrame, words_per_shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """(doc_id, text) -> (doc_id, fp, component_id), one row per input row.

    Null or wordless texts have fingerprint 0 and link like any other.  Rows that
    repeat a doc_id each keep their row.  component_id is the smallest doc_id of
    the group; a null doc_id takes part but never names a group.  Other columns are
    ignored; an empty table gives an empty result.
    """
    prints = cut(with_fingerprint(docs, words_per_shingle))
    classes = prints.groupBy("fp").agg(F.min("doc_id").alias("low"))
    roots = connected_components(fingerprint_links(classes, max_bits))
    named = cut(
        classes.join(roots, classes.fp == roots.node, "left")
        .select("fp", "low", F.coalesce("root", "fp").alias("root"))
    )
    lowest = named.groupBy("root").agg(F.min("low").alias("component_id"))
    groups = named.join(lowest, "root").select("fp", "component_id")
    return prints.join(groups, "fp").select("doc_id", "fp", "component_id")


def fingerprint_hex(fp):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def text_links(docs: DataFrame, words_per_shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """(text) -> links (u, v) of text hashes, ``xxhash64(text)``, that span every group within ``max_bits``."""
    text = F.col("text").cast("string")
    prints = cut(with_fingerprint(docs.select(F.xxhash64(text).alias("doc_id"), "text"), words_per_shingle).distinct())
    lowest = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("low")))
    near = fingerprint_links(lowest, max_bits)
    same = prints.join(lowest, "fp").filter("doc_id <> low").select(F.col("low").alias("u"), F.col("doc_id").alias("v"))
    u, v = (lowest.select(F.col("fp").alias(x), F.col("low").alias(f"low_{x}")) for x in "uv")
    return same.unionByName(near.join(u, "u").join(v, "v").select(F.col("low_u").alias("u"), F.col("low_v").alias("v")))


def keep_one(docs: DataFrame, words_per_shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """Of each group only the first document stays; see :func:`keep_first`."""
    return keep_first(docs, connected_components(text_links(docs, words_per_shingle, max_bits)))
