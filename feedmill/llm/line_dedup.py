"""Line deduplication within an edit distance, by segment partition.

A line is split into ``max_edits + 1`` segments; a line within ``max_edits`` edits
keeps one of them whole, at a place that its length and the segment's number bound.
Each line is indexed under its segments and probes, for each length it can reach,
the substrings at those places.  Lines that meet under a key are compared first by
a 63-bit sketch (parities of character counts, of which an edit flips two at most)
and then by banded bit-parallel edit distance on the texts.

Lines are known by a 64-bit hash of their text; two different lines of n share one
with a probability of about n*n / 2**65.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedmill.llm.components import connected_components
from feedmill.runtime import cut, discard, tidied

#: Edits within which lines link: one for each so many characters of the shorter line, and at most MAX_EDITS.
CHARS_PER_EDIT = 12
MAX_EDITS = 2
#: With more lines to fetch for verification than this, fetching is left to a shuffle.
BROADCAST_LINES = 1_000_000
DIRECT = 256
_TOP = np.int64(-(2**63))


def lines_of(text: str | None) -> list[tuple[int, str]]:
    """(place, line without outer white space) of the lines with a word."""
    return [(i, x) for i, line in enumerate(text.split("\n")) if (x := line.strip())] if text else []


def line_id(line: str) -> int:
    h = xxhash.xxh3_64_intdigest(line.encode())
    return h - (1 << 64) if h >> 63 else h


def segments(n: int, k: int) -> list[tuple[int, int]]:
    """(start, length) of the k + 1 segments of a line of n characters, the longer ones last."""
    short, longer = divmod(n, k + 1)
    out, at = [], 0
    for i in range(k + 1):
        size = short + (i >= k + 1 - longer)
        out.append((at, size))
        at += size
    return out


def reach(n: int, max_edits: int = MAX_EDITS, chars_per_edit: int = CHARS_PER_EDIT) -> int:
    """Edits within which a line of n characters links to lines as long or longer."""
    return min(max_edits, n // chars_per_edit)


def probes(n: int, most: int, reach_of: Callable[[int], int]) -> list[tuple[int, int, int, int]]:
    """(indexed length, segment, start, length) of the substrings that a line of n characters probes.

    Places that the line's own index entries cover are left out.
    """
    out = []
    for shorter in range(min(most, n) + 1):
        k = reach_of(n - shorter)
        if not k or shorter > k:
            continue
        for i, (p, size) in enumerate(segments(n - shorter, k)):
            low = max(p - i, p + shorter - (k - i), 0)
            high = min(p + i, p + shorter + (k - i), n - size)
            out += [(n - shorter, i, s, size) for s in range(low, high + 1) if shorter or s != p]
    return out


def within(a: str, b: str, k: int) -> bool:
    """Is the edit distance at most k?  Banded bit-parallel columns on what differs."""
    if abs(len(a) - len(b)) > k:
        return False
    if a == b:
        return True
    i, stop = 0, min(len(a), len(b))
    while i < stop:  # common prefix, by halving steps
        step = 64
        while step and a[i : i + step] != b[i : i + step]:
            step >>= 1
        if not step:
            break
        i += step
    i = min(i, stop)
    a, b = a[i:], b[i:]
    j, stop = 0, min(len(a), len(b))
    while j < stop and a[-1 - j] == b[-1 - j]:
        j += 1
    a, b = a[: len(a) - j], b[: len(b) - j]
    if len(a) > len(b):
        a, b = b, a
    n, m = len(a), len(b)
    if m <= k or not n:
        return m <= k
    # column j holds rows j-k .. j+k; bit r of a vector is row j-k+r, and the score follows row j-k+width-1
    width = 2 * k + 1
    full = (1 << width) - 1
    seen: dict[str, int] = {}
    for r, c in enumerate(a):
        seen[c] = seen.get(c, 0) | 1 << (r + k)  # row r+1 of the matrix is bit r+k of an endless vector
    up, down = full & ~((1 << k) - 1), 0  # vertical differences +1 and -1; the rows above the first are level
    score = min(n, k)  # value at the last row of the band or of the matrix
    last = n - 1  # row index whose value is wanted
    for j, c in enumerate(b):
        match = (seen.get(c, 0) >> j) & full
        d0 = ((((match & up) + up) ^ up) | match | down) & full
        hp = down | (~(d0 | up) & full)
        hn = d0 & up
        edge = j + k  # text row of the band's last bit
        if edge <= last:
            score += not d0 >> (width - 1) & 1
        else:
            at = width - 1 - (edge - last)
            score += (hp >> at & 1) - (hn >> at & 1)
        if score > k + (m - 1 - j) + k:
            return False
        up = (hn | ~((d0 >> 1) | hp)) & full
        down = (d0 >> 1) & hp
    return score <= k


def sketches(lines: list[str]) -> np.ndarray:
    """63-bit parities of character counts; an edit flips at most two bits."""
    codes = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.fromiter(map(len, lines), np.int64, len(lines))
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    bits = np.left_shift(np.uint64(1), ((codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)) % np.uint64(63))
    return np.bitwise_xor.reduceat(bits, starts).view(np.int64)


def _keys(lines: list[str], ids: list[int], most: int, reach_of: Callable[[int], int], shapes: dict) -> tuple[list[int], list[int], list[int], list[int]]:
    """Keys, ids, positions in ``lines`` and roles (1: probe) of all index entries and probes."""
    digest = xxhash.xxh3_64_intdigest
    keys, owners, rows, roles = [], [], [], []
    for r, (line, own) in enumerate(zip(lines, ids)):
        n = len(line)
        shape = shapes.get(n)
        if shape is None:
            index = [(4 * s, 4 * (s + size), n * 16 + i) for i, (s, size) in enumerate(segments(n, reach_of(n)))]
            ask = [(4 * s, 4 * (s + size), length * 16 + i) for length, i, s, size in probes(n, most, reach_of)]
            shape = shapes[n] = (index + ask, [0] * len(index) + [1] * len(ask))
        flat = line.encode("utf-32-le", "surrogatepass")
        places, role = shape
        keys += [digest(flat[a:b], seed) for a, b, seed in places]
        owners += [own] * len(places)
        rows += [r] * len(places)
        roles += role
    return keys, owners, rows, roles


def _meet(keys: np.ndarray, ids: np.ndarray, marks: np.ndarray, most: int) -> pa.RecordBatch:
    """Pairs of different lines under one key, one of them indexed, whose sketches differ in at most ``most`` bits."""
    probe, sketch = marks < 0, marks & ~_TOP
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(keys)) + 1, [len(keys)]))
    sizes = np.diff(cuts)
    each = np.repeat(sizes, sizes)
    left, right = [], []

    def add(i: np.ndarray, j: np.ndarray) -> None:
        ok = (ids[i] != ids[j]) & ~(probe[i] & probe[j])
        i, j = i[ok], j[ok]
        ok = np.bitwise_count((sketch[i] ^ sketch[j]).view(np.uint64)) <= most
        left.append(ids[i[ok]])
        right.append(ids[j[ok]])

    small = np.flatnonzero((each > 1) & (each <= DIRECT))
    d = 1
    while d < len(small):
        hit = np.flatnonzero(keys[small[:-d]] == keys[small[d:]])
        if not len(hit):
            break
        add(small[hit], small[hit + d])
        d += 1
    for g in np.flatnonzero(sizes > DIRECT):
        # sketches that differ in `most` bits agree on one of most + 1 parts: only those are compared
        at = np.arange(cuts[g], cuts[g + 1])
        edges = [63 * p // (most + 1) for p in range(most + 2)]
        for lo, hi in zip(edges, edges[1:]):
            part = (sketch[at] >> lo) & ((1 << (hi - lo)) - 1)
            order = np.argsort(part, kind="stable")
            rows, value = at[order], part[order]
            d = 1
            while d < len(rows):
                hit = np.flatnonzero(value[:-d] == value[d:])
                if not len(hit):
                    break
                add(rows[hit], rows[hit + d])
                d += 1
    none = np.array([], np.int64)
    u, v = np.concatenate([none, *left]), np.concatenate([none, *right])
    pair = np.unique(np.stack([np.minimum(u, v), np.maximum(u, v)]), axis=1)
    return pa.RecordBatch.from_arrays([pa.array(pair[0]), pa.array(pair[1])], ["u", "v"])


def _candidates(texts: DataFrame, k: int, reach_of: Callable[[int], int]) -> DataFrame:
    """(text) -> pairs (u, v) of line ids that may be within reach, of k edits at most."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shapes: dict = {}
        known: set[int] = set()
        for b in batches:
            for part in range(0, b.num_rows, 256):
                lines, ids = [], []
                for t in b.column(0).slice(part, 256):
                    for _, line in lines_of(t.as_py()):
                        if reach_of(len(line)):
                            own = line_id(line)
                            if own not in known:  # a line that this task has sent already needn't go again
                                if len(known) >= 1 << 18:
                                    known.clear()
                                known.add(own)
                                lines.append(line)
                                ids.append(own)
                if lines:
                    keys, owners, rows, roles = _keys(lines, ids, k, reach_of, shapes)
                    marks = sketches(lines)[rows] | (np.array(roles, np.int64) << np.int64(63))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.array(keys, np.uint64).view(np.int64)), pa.array(owners, pa.int64()), pa.array(marks)], ["key", "id", "mark"]
                    )

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        for b in batches:
            if not b.num_rows:
                continue
            now = tuple(b.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            if held and held[0][0][0] == now[0][0] == now[0][-1]:
                held.append(now)
                continue
            keys, ids, marks = (np.concatenate([*(h[i] for h in held), now[i]]) for i in range(3))
            last = int(np.searchsorted(keys, keys[-1]))
            if last:
                yield _meet(keys[:last], ids[:last], marks[:last], 2 * k)
            held = [(keys[last:], ids[last:], marks[last:])]
        if held:
            yield _meet(*(np.concatenate([h[i] for h in held]) for i in range(3)), 2 * k)

    return (
        texts.select("text").mapInArrow(tidied(emit), "key long, id long, mark long")
        .repartition("key").sortWithinPartitions("key").mapInArrow(tidied(meet), "u long, v long").distinct()
    )


def _line_table(docs: DataFrame) -> DataFrame:
    """(doc_id, text, h) -> (doc_id, h, line_no, id)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, places, ids = [], [], []
            for r, t in enumerate(b.column(1)):
                for i, line in lines_of(t.as_py()):
                    rows.append(r)
                    places.append(i)
                    ids.append(line_id(line))
            take = pa.array(rows, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(take), b.column(2).take(take), pa.array(places, pa.int32()), pa.array(ids, pa.int64())], ["doc_id", "h", "line_no", "id"]
            )

    return docs.mapInArrow(tidied(run), "doc_id long, h long, line_no int, id long")


def _verified(docs: DataFrame, pairs: DataFrame, firsts: DataFrame, reach_of: Callable[[int], int]) -> DataFrame:
    """The pairs that are within the reach of the shorter line; a line's text is read where it first occurs."""
    needed = pairs.select(F.col("u").alias("id")).union(pairs.select("v")).distinct()
    spots = cut(needed.join(firsts, "id").select("id", "doc_id", "h", "line_no"))
    per_doc = spots.groupBy(F.col("doc_id").alias("_d"), F.col("h").alias("_h")).agg(F.collect_list(F.struct("line_no", "id")).alias("wanted"))
    if spots.count() <= BROADCAST_LINES:
        per_doc = F.broadcast(per_doc)
    on = docs.doc_id.eqNullSafe(F.col("_d")) & (docs.h == F.col("_h"))

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, lines = [], []
            for t, wanted in zip(b.column(0), b.column(1)):
                parts = t.as_py().split("\n")
                for w in wanted.as_py():
                    ids.append(w["id"])
                    lines.append(parts[w["line_no"]].strip())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(lines, pa.string())], ["id", "line"])

    texts = cut(docs.join(per_doc, on).select("text", "wanted").mapInArrow(tidied(fetch), "id long, line string").dropDuplicates(["id"]))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = zip(b.column(2).to_pylist(), b.column(3).to_pylist())
            ok = [within(x, y, reach_of(min(len(x), len(y)))) for x, y in texts]
            yield b.filter(pa.array(ok, pa.bool_())).select(["u", "v"])

    both = pairs.join(texts.select(F.col("id").alias("u"), F.col("line").alias("a")), "u").join(
        texts.select(F.col("id").alias("v"), F.col("line").alias("b")), "v"
    )
    return cut(both.select("u", "v", "a", "b").mapInArrow(tidied(verify), "u long, v long"))


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("h", F.xxhash64("text"))


def line_classes(docs: DataFrame, max_edits: int = MAX_EDITS, chars_per_edit: int = CHARS_PER_EDIT) -> DataFrame:
    """(doc_id, text) -> one row for each line with a word: doc_id, h, line_no, class_doc_id, class_line_no, n_links, dropped.

    Lines are compared without outer white space.  Two lines link within one edit for each
    ``chars_per_edit`` characters of the shorter one, ``max_edits`` at most: lines shorter than
    that are only equal to equal ones.  A class is what links connect; it is named by its first
    line, by (doc_id, line_no), null ids last; all but lines equal in place and text to that
    first one are ``dropped``.  n_links counts the other line texts within reach.  ``h`` is the
    hash of the document's text: rows of one doc_id and text are one document, rows of one
    doc_id and different texts are documents of their own.  Null and empty texts have no lines;
    other columns are ignored.
    """
    docs = _keyed(docs)
    lines = cut(_line_table(docs))
    place = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "line_no", "h")
    firsts = cut(lines.groupBy("id").agg(F.min(place).alias("p")).select("id", "p.doc_id", "p.line_no", "p.h"))
    reach_of = partial(reach, max_edits=max_edits, chars_per_edit=chars_per_edit)
    pairs = cut(_candidates(docs, max_edits, reach_of))
    links = _verified(docs, pairs, firsts, reach_of)
    discard(pairs)
    degree = links.select(F.col("u").alias("id")).unionAll(links.select("v")).groupBy("id").agg(F.count("*").alias("n_links"))
    roots = connected_components(links).withColumnRenamed("node", "id")
    linked = cut(roots.join(firsts, "id").join(degree, "id"))
    heads = linked.groupBy("root").agg(F.min(place).alias("c"))
    named = linked.join(heads, "root").select("id", "c", "n_links")
    # a written table: both sides of the next join are then dealt out for it alone, and a line that
    # a third of all documents have can be split among tasks
    classes = cut(firsts.join(named, "id", "left").select(
        "id", F.coalesce("c", place).alias("c"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")
    ))
    joined = lines.join(classes, "id")
    same = F.col("doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col("line_no") == F.col("c.line_no")) & (F.col("h") == F.col("c.h"))
    return joined.select(
        "doc_id", "h", "line_no", F.col("c.doc_id").alias("class_doc_id"), F.col("c.line_no").alias("class_line_no"), "n_links", (~same).alias("dropped")
    )


def drop_repeated_lines(docs: DataFrame, max_edits: int = MAX_EDITS, chars_per_edit: int = CHARS_PER_EDIT) -> DataFrame:
    """``docs`` with the dropped lines taken out of ``text``; rows left without any word go, rows that had none stay.

    The other lines stay as they are; n_chars, if there, is counted anew.
    """
    found = line_classes(docs, max_edits, chars_per_edit).filter("dropped").select(
        F.col("doc_id").alias("__d"), F.col("h").alias("__h"), "line_no"
    ).distinct()
    per_doc = found.groupBy("__d", "__h").agg(F.collect_set("line_no").alias("__out"))
    joined = docs.join(per_doc, docs.doc_id.cast("long").eqNullSafe(F.col("__d")) & (F.xxhash64(docs.text.cast("string")) == F.col("__h")), "left")
    kept = F.filter(F.split("text", "\n", -1), lambda line, i: ~F.array_contains("__out", i))
    text = F.when(F.col("__out").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    out = joined.withColumn("text", text).filter(F.col("__out").isNull() | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
