"""Near-duplicates by exact Jaccard similarity of word shingles.

Take any one order of all shingles.  Two sets of at least four fifths in common share k + 1
of the first ``n - ceil(0.8 n) + 1 + k`` shingles of each, for any k.  Here k is about n / 10, so a
text takes part only if so many of its first shingles are in other texts too: what texts
share by chance, or a passage, seldom reaches that, and neither texts nor pairs grow with
the square of the table.  The order goes by frequency in a sample, rare ones first; which
sample it was changes the work and never the pairs.  Texts that meet
under a shingle are first compared with the smallest of them, so that a group of m copies
costs about m comparisons.  Of those that are not connected by then all shingles are counted,
and no longer in a sample: two texts of different groups have only shingles in common that
several groups have.  A text with less than four fifths of such is done, the others meet by a prefix in
the order of these counts, and a pair is compared only if what both have from their first
common shingle on is enough and maps of the parity of their shingles differ in few enough bits, which
bounds what they have in common from above.  No link between groups is missed, and near copies that are less
alike are seldom compared.

Texts are known by a 64-bit hash, and so are shingles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmill.llm.components import connected_components, keep_first
from feedmill.runtime import cut, discard, tidied

WORDS = 5
#: Least similarity as a fraction.
OVER, UNDER = 4, 5
#: Rows whose shingles are counted for the order, and how many frequent shingles every task gets.
SAMPLE_ROWS = 20_000
MOST_FREQUENT = 200_000
#: Texts whose keys a worker hands over at once.
PACK = 200
#: Pairs that a worker hands over at once.
MOST_HELD = 1 << 16
#: Bits of a text's parity map, in which each shingle turns one.
PARITY = 1024
#: With more texts to fetch for verification than this, fetching is left to a shuffle.
BROADCAST_TEXTS = 1_000_000


def shingle_set(text: str | None, size: int = WORDS) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles; a text of fewer words is one shingle."""
    words = text.encode().lower().split() if text else []
    n = len(words)
    if not n:
        return np.array([], np.uint64)
    size = min(size, n)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(joined[a:b]) for a, b in zip(starts[: n - size + 1].tolist(), ends[size - 1 :].tolist())], np.uint64))


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Is the Jaccard similarity at least OVER / UNDER?  Two empty sets are equal."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return UNDER * both >= OVER * (len(a) + len(b) - both)


def spare(n):
    """The k of a set of n shingles, for ints, arrays and columns; it never falls with n."""
    return (n * (UNDER - OVER) // UNDER + 1) // 2 if not isinstance(n, Column) else F.floor((F.floor(n * (UNDER - OVER) / UNDER) + 1) / 2)


def prefix(own: np.ndarray, common: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The first shingles of a set in the order of (count in the sample, hash); 0 stands for an empty set."""
    n = len(own)
    if not n:
        return np.array([0], np.uint64)
    take = n - -(-OVER * n // UNDER) + 1 + spare(n)
    if len(common):
        at = np.minimum(np.searchsorted(common, own), len(common) - 1)
        own = own[np.argsort(np.where(common[at] == own, counts[at], 0), kind="stable")]
    return own[:take]


def _frequent(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of three rows or more of a sample, sorted, with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for t in b.column(1):
                yield pa.RecordBatch.from_arrays([pa.array(shingle_set(t.as_py()).view(np.int64))], ["s"])

    total = texts.count()
    some = texts.sample(SAMPLE_ROWS / total, 1) if total > SAMPLE_ROWS else texts
    found = some.mapInArrow(tidied(run), "s long").groupBy("s").agg(F.count("*").alias("n")).filter("n > 2").orderBy(F.desc("n"), "s").limit(MOST_FREQUENT).toArrow()
    common, counts = (np.asarray(found.column(k).to_numpy()) for k in (0, 1))
    common = common.astype(np.int64).view(np.uint64)
    order = np.argsort(common)
    return common[order], counts[order].astype(np.int64)


def _keyed(texts: DataFrame) -> DataFrame:
    """(h, text) -> (key, h, n): the prefix of each text and the size of its set."""
    sent = texts.sparkSession.sparkContext.broadcast(_frequent(texts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, counts = sent.value
        known: set[int] = set()
        for b in batches:
            for at in range(0, b.num_rows, PACK):
                part = b.slice(at, PACK)
                keys, sizes, ids = [], [], []
                for h, t in zip(part.column(0).to_pylist(), part.column(1)):
                    if h in known:  # a text that this task has sent already needn't go again
                        continue
                    if len(known) >= 1 << 16:
                        known.clear()
                    known.add(h)
                    own = shingle_set(t.as_py())
                    keys.append(prefix(own, common, counts).view(np.int64))
                    ids.append(h)
                    sizes.append(len(own))
                if ids:
                    each = [len(k) for k in keys]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(keys)), pa.array(np.repeat(np.array(ids, np.int64), each)), pa.array(np.repeat(np.array(sizes, np.int32), each))],
                        ["key", "h", "n"],
                    )

    return texts.mapInArrow(tidied(run), "key long, h long, n int")


def _met(keyed: DataFrame) -> DataFrame:
    """The distinct rows of the keys that more than one text has, in one shuffle.

    Of a key only the last row is held, however many texts have it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        paired = False  # has the held row met another one already?
        for b in batches:
            if not b.num_rows:
                continue
            now = [b.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
            if held:
                now = [np.concatenate([x, y]) for x, y in zip(held, now)]
            key, h = now[0], now[1]
            new = np.concatenate(([True], (key[1:] != key[:-1]) | (h[1:] != h[:-1])))
            now = [x[new] for x in now]
            same = now[0][1:] == now[0][:-1]
            many = np.concatenate(([paired], same)) | np.concatenate((same, [False]))
            held, paired = [x[-1:] for x in now], bool(many[-1])
            many[-1] = False
            if many.any():
                yield pa.RecordBatch.from_arrays([pa.array(x[many]) for x in now], ["key", "h", "n"])
        if paired:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in held], ["key", "h", "n"])

    return keyed.repartition("key").sortWithinPartitions("key", "h").mapInArrow(tidied(run), "key long, h long, n int")


def _fetched(texts: DataFrame, needed: DataFrame) -> DataFrame:
    """One text for each row of ``needed``, by h, beside its other columns."""
    few = F.broadcast(needed) if needed.count() <= BROADCAST_TEXTS else needed
    return cut(texts.join(few, "h").groupBy("h").agg(*[F.first(c).alias(c) for c in ("text", *needed.columns) if c != "h"]))


def _shingled(found: DataFrame) -> DataFrame:
    """(h, text, root) -> (key, h, n, root) for all shingles of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, PACK):
                part = b.slice(at, PACK)
                sets = [shingle_set(t.as_py()) for t in part.column(1)]
                each = np.array([len(x) for x in sets], np.int32)
                h, root = (np.repeat(part.column(i).to_numpy(zero_copy_only=False), each) for i in (0, 2))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sets).view(np.int64)), pa.array(h), pa.array(np.repeat(each, each)), pa.array(root)], ["key", "h", "n", "root"])

    return found.select("h", "text", "root").mapInArrow(tidied(run), "key long, h long, n int, root long")


def _parity(keys: np.ndarray, own: np.ndarray, texts: int) -> np.ndarray:
    """A row of bits for each text: two sets differ in as many shingles as their rows in bits, at least."""
    out = np.zeros((texts, PARITY // 8), np.uint8)
    bit = keys.view(np.uint64) % np.uint64(PARITY)
    np.bitwise_xor.at(out, (own, (bit >> np.uint64(3)).astype(np.int64)), np.uint8(1) << (bit & np.uint64(7)).astype(np.uint8))
    return out


def _narrowed(rows: DataFrame, first: bool) -> DataFrame:
    """(key, h, n, root) -> (key, h, n, root, rest, many, bits): the shingles that texts of several roots have.

    Only those can be common to a pair of different roots, so a text goes if they are less than
    four fifths of its set.  ``rest`` is what the set has from this shingle on, in the order
    of the number of texts, rare ones first and those of one root before all.  With ``first`` the plain
    prefix remains, ``n - ceil(0.8 n) + 1`` shingles, beside the number of all that remained and their parity map.
    """
    counts = rows.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("f")).filter("lo <> hi")
    counts = cut(counts.select("key", "f"))

    def whole(now: list[np.ndarray]) -> pa.RecordBatch:
        h, n = now[1], now[2].astype(np.int64)
        begin = np.concatenate(([0], np.flatnonzero(np.diff(h)) + 1))
        each = np.diff(np.append(begin, len(h)))
        many = np.repeat(each, each)
        rest = np.repeat(begin + each, each) - np.arange(len(h))
        stay = UNDER * many >= OVER * n
        if first:
            stay &= UNDER * rest >= OVER * n
            own = np.repeat(np.arange(len(each)), each)
            maps = [x.tobytes() for x in _parity(now[0], own, len(each))]
            bits = pa.array([maps[i] for i in own[stay].tolist()], pa.binary())
        else:
            bits = pa.nulls(int(stay.sum()), pa.binary())
        return pa.RecordBatch.from_arrays([*(pa.array(x[stay]) for x in (*now, rest.astype(np.int32), many.astype(np.int32))), bits], ["key", "h", "n", "root", "rest", "many", "bits"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        for b in batches:
            if not b.num_rows:
                continue
            now = [b.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
            if held:
                now = [np.concatenate([x, y]) for x, y in zip(held, now)]
            last = int(np.searchsorted(now[1], now[1][-1]))
            if last:
                yield whole([x[:last] for x in now])
            held = [x[last:] for x in now]
        if held:
            yield whole(held)

    shared = rows.select("key", "h", "n", "root").join(counts, "key").repartition("h").sortWithinPartitions("h", "f", "key")
    out = cut(shared.select("key", "h", "n", "root").mapInArrow(tidied(run), "key long, h long, n int, root long, rest int, many int, bits binary"))
    discard(counts)
    return out


def _across(keys: np.ndarray, ids: np.ndarray, sizes: np.ndarray, roots: np.ndarray, rests: np.ndarray, many: np.ndarray, maps: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Pairs of different roots that can be similar if this key is the first that both have, and by their parity maps."""
    bits = np.frombuffer(b"".join(maps), np.uint64).reshape(len(keys), -1)
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(keys)) + 1, [len(keys)]))
    found: list[tuple[np.ndarray, np.ndarray]] = []
    held = 0
    for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        for i in range(lo, hi - 1):
            j = np.arange(i + 1, hi)
            j = j[(roots[j] != roots[i]) & ((UNDER + OVER) * np.minimum(rests[j], rests[i]) >= OVER * (sizes[j] + sizes[i]))]
            # what two sets have in common is half of what their sizes are over their difference
            both = many[j] + many[i] - np.bitwise_count(bits[j] ^ bits[i]).sum(axis=1, dtype=np.int64)
            j = j[(UNDER + OVER) * both >= 2 * OVER * (sizes[j] + sizes[i])]
            if len(j):
                found.append((np.minimum(ids[j], ids[i]), np.maximum(ids[j], ids[i])))
                held += len(j)
            if held >= MOST_HELD:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found)], ["u", "v"])
                found, held = [], 0
    if found:
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found)], ["u", "v"])


def _pairs_across(first: DataFrame) -> DataFrame:
    """(key, h, n, root, rest, many, bits) -> pairs of texts of different roots that may be similar by where they first meet and by their bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        for b in batches:
            if not b.num_rows:
                continue
            now = [b.column(i).to_numpy(zero_copy_only=False) for i in range(7)]
            if held:
                now = [np.concatenate([x, y]) for x, y in zip(held, now)]
            last = int(np.searchsorted(now[0], now[0][-1]))
            if last:
                yield from _across(*(x[:last] for x in now))
            held = [x[last:] for x in now]
        if held:
            yield from _across(*held)

    pairs = first.select("key", "h", "n", "root", "rest", "many", "bits").repartition("key").sortWithinPartitions("key").mapInArrow(tidied(run), "u long, v long")
    return pairs.distinct()


def _verified(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs that are similar, by their texts."""
    needed = cut(pairs.select(F.col("u").alias("h")).union(pairs.select("v")).distinct())
    found = _fetched(texts, needed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, own = None, None
        for b in batches:
            ok = []
            for u, x, y in zip(b.column(0).to_pylist(), b.column(2), b.column(3)):
                if u != last:
                    last, own = u, shingle_set(x.as_py())
                ok.append(similar(own, shingle_set(y.as_py())))
            yield b.filter(pa.array(ok, pa.bool_())).select(["u", "v"])

    both = pairs.join(found.select(F.col("h").alias("u"), F.col("text").alias("a")), "u").join(
        found.select(F.col("h").alias("v"), F.col("text").alias("b")), "v"
    )
    links = cut(both.select("u", "v", "a", "b").mapInArrow(tidied(run), "u long, v long"))
    discard(found)
    discard(needed)
    return links


def near_links(docs: DataFrame, candidates: DataFrame | None = None) -> DataFrame:
    """(text) -> links (u, v) of text hashes, all similar, that connect every group of similar texts.

    ``candidates`` are pairs (u, v) of text hashes from another method.  They are checked first, and
    the join compares only what they leave apart.  Null and wordless texts are equal to one another.
    """
    texts = docs.select(F.xxhash64(F.col("text").cast("string")).alias("h"), F.col("text").cast("string").alias("text"))
    every = cut(_met(_keyed(texts)))
    partner = F.ceil(F.col("n") * OVER / UNDER)  # the smallest set that can be similar
    able = every.groupBy("h", "n").agg(F.count("*").alias("m")).filter(F.col("m") > spare(partner)).select("h")
    met = cut(every.join(able, "h", "left_semi"))
    discard(every)
    least = met.groupBy("key").agg(F.min(F.struct("h", "n")).alias("c"), F.count("*").alias("m")).filter("m > 1")
    least = least.select("key", F.col("c.h").alias("u"), F.col("c.n").alias("n_u"))
    near = met.join(least, "key").filter((F.col("h") != F.col("u")) & (UNDER * F.least("n", "n_u") >= OVER * F.greatest("n", "n_u")))
    star = near.select("u", F.col("h").alias("v")).distinct()
    links = checked = None
    if candidates is not None:
        checked = cut(candidates.filter("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct())
        links = _verified(texts, checked)
        found = cut(connected_components(links))
        u, v = (found.select(F.col("node").alias(x), F.col("root").alias(f"root_{x}")) for x in "uv")
        star = star.join(u, "u", "left").join(v, "v", "left").filter(F.coalesce("root_u", "u") != F.coalesce("root_v", "v")).select("u", "v")
        star = star.join(checked, ["u", "v"], "left_anti")
    star = cut(star)
    more = _verified(texts, star)
    links = more if links is None else links.unionByName(more)
    seen = star if checked is None else star.unionByName(checked)
    roots = cut(connected_components(links))
    named = met.join(roots, met.h == roots.node, "left").select("key", "h", "n", F.coalesce("root", "h").alias("root"))
    mixed = named.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi").select("key")
    apart = named.join(mixed, "key", "left_semi").groupBy("h", "n", "root").agg(F.count("*").alias("m")).filter(F.col("m") > spare(partner))
    apart = cut(apart.select("h", "root"))
    found = _fetched(texts, apart)
    rows = cut(_shingled(found))
    shared = _narrowed(rows, False)
    first = _narrowed(shared, True)
    rest = cut(_pairs_across(first).join(seen, ["u", "v"], "left_anti"))
    out = links.unionByName(_verified(texts, rest))
    for done in (met, star, apart, found, rows, shared, first):
        discard(done)
    return out


def keep_one(docs: DataFrame) -> DataFrame:
    """Of each group of texts that chains of similar pairs connect the first document stays; see :func:`keep_first`."""
    return keep_first(docs, connected_components(near_links(docs)))
