"""URL rules behind a blocked Bloom filter.

Entries name a host (with its subdomains) and a path prefix.  Rules are held against
host and path as they stand; the list is held against the canonical URL, and its own
entries are brought to that form: no user name, no port, no final dot of the host, no
empty labels, an empty path as ``/``, ``.`` and ``..`` resolved, letters and digits and
``-._~`` not percent-encoded.  Each URL asks for its host suffixes joined with its path
prefixes of the lengths that occur among the entries.  A Bloom filter whose bits for a
key lie in one 512-bit block lets possible hits pass; an exact hash join with the entries
removes false positives, and the longest entry wins.

The filter has 16 bits an entry up to ``MAX_FILTER_MB``; a longer list shares those bits,
so more probes pass to the join and the result stays the same.
"""

from __future__ import annotations

import re
import string
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedmill.runtime import cut

BLOCK_BITS = 512
PROBES = 8
PORT = re.compile(r":[0-9]*$")
CODED = re.compile("%([0-9A-Fa-f]{2})")
UNRESERVED = frozenset(string.ascii_letters + string.digits + "-._~")
BITS_PER_ENTRY = 16
MAX_FILTER_MB = 16
#: The default list; another may come from any table, see :func:`listed_entries`.
LISTED = Path(__file__).with_name("listed_urls.txt")
#: (host, path, verdict) of the rules that go before the list.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?`` or ``#``, with A-Z lower-cased; empty without ``://``."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to ``?`` or ``#``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def canonical_host(host: str) -> str:
    """A lower-cased host without user name, port, final dot and empty labels."""
    return ".".join(label for label in PORT.sub("", host.rpartition("@")[2]).split(".") if label)


def canonical_path(path: str) -> str:
    """A path with unreserved characters decoded and ``.``, ``..`` and doubled slashes resolved; ``/`` if empty."""
    if "%" in path:
        path = CODED.sub(lambda m: c if (c := chr(int(m[1], 16))) in UNRESERVED else m[0], path)
    if path.startswith("/") and "//" not in path and "/." not in path:
        return path
    kept: list[str] = []
    parts = path.split("/")
    for part in parts:
        if part == "..":
            del kept[-1:]
        elif part not in ("", "."):
            kept.append(part)
    return "/" + "/".join(kept) + ("/" if kept and parts[-1] in ("", ".", "..") else "")


def suffixes(host: str, widest: int) -> list[str]:
    """The host and its parent domains of at most ``widest`` characters."""
    labels = host.split(".")
    return [h for i in range(len(labels)) if (h := ".".join(labels[i:])) and len(h) <= widest]


class BlockedBloom:
    """Bloom filter whose bits for one key lie in one block."""

    def __init__(self, entries: int, bits_per_entry: int = BITS_PER_ENTRY, max_mb: float = MAX_FILTER_MB) -> None:
        self.blocks = max(1, min(-(-entries * bits_per_entry // BLOCK_BITS), int(max_mb * (1 << 23)) // BLOCK_BITS))
        self.bits = np.zeros((self.blocks, BLOCK_BITS // 8), np.uint8)

    def _where(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        block = (hashes >> np.uint64(32)) % np.uint64(self.blocks)
        a, b = hashes & np.uint64(0xFFFF), (hashes >> np.uint64(16)) & np.uint64(0xFFFF) | np.uint64(1)
        bit = (a[:, None] + b[:, None] * np.arange(PROBES, dtype=np.uint64)) % np.uint64(BLOCK_BITS)
        return block.astype(np.int64), bit.astype(np.int64)

    def add(self, hashes: np.ndarray) -> None:
        block, bit = self._where(hashes)
        np.bitwise_or.at(self.bits, (block[:, None], bit >> 3), np.uint8(1) << (bit & 7).astype(np.uint8))

    def may_hold(self, hashes: np.ndarray) -> np.ndarray:
        block, bit = self._where(hashes)
        return (self.bits[block[:, None], bit >> 3] >> (bit & 7).astype(np.uint8) & 1).all(axis=1)


def key_hashes(keys: list[str]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(k) for k in keys], np.uint64)


def filter_of(entries: DataFrame, n: int) -> BlockedBloom:
    """The filter of a table's ``key`` column of n rows: filled on the executors, block by block, and gathered within its size."""
    bloom = BlockedBloom(n)
    blocks, spans = bloom.blocks, BLOCK_BITS // 64

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                own = BlockedBloom(0)
                own.blocks = blocks
                block, bit = own._where(key_hashes(b.column(0).to_pylist()))
                at = block[:, None] * spans + (bit >> 6)
                value = (np.uint64(1) << (bit & 63).astype(np.uint64)).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(at.ravel()), pa.array(value.ravel())], ["at", "bits"])

    filled = entries.select("key").mapInArrow(words, "at long, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    flat = bloom.bits.reshape(-1).view("<u8")
    flat[filled.column("at").to_numpy()] = filled.column("bits").to_numpy().view(np.uint64)
    return bloom


def rule_entries(spark: SparkSession, rules: tuple[tuple[str, str, str], ...] = RULES) -> DataFrame:
    return spark.createDataFrame([(h, p, v, True) for h, p, v in rules], "host string, path string, verdict string, is_rule boolean")


def listed_entries(urls: DataFrame, column: str = "url") -> DataFrame:
    """Entries that block, of a table of listed URLs, with or without a scheme; null and hostless ones are none."""
    url = F.trim(F.col(column).cast("string"))
    full = F.when(url.contains("://"), url).otherwise(F.concat(F.lit("//://"), url))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hosts = [canonical_host(h or "") for h in b.column(0).to_pylist()]
            paths = [canonical_path(p or "") for p in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(paths, pa.string())], ["host", "path"])

    rows = urls.filter(F.col(column).isNotNull()).select(host_of(full).alias("host"), path_of(full).alias("path"))
    return rows.mapInArrow(run, "host string, path string").filter("host <> ''").distinct().withColumns({"verdict": F.lit("block"), "is_rule": F.lit(False)})


def default_list(path: Path = LISTED) -> list[str]:
    """The lines of the list that is part of this package."""
    return [line.strip() for line in path.read_text(encoding="utf-8").splitlines() if line.strip() and not line.startswith("#")]


def default_entries(spark: SparkSession) -> DataFrame:
    """Rules, then the block list: (host, path, verdict, is_rule)."""
    urls = spark.createDataFrame([(u,) for u in default_list()], "url string")
    return rule_entries(spark).unionByName(listed_entries(urls))


def judge_urls(pages: DataFrame, entries: DataFrame, key: str = "page_id", default: str = "allow") -> DataFrame:
    """(key, url) -> key, host, path, rule, verdict, listed.

    Entries are (host, path, verdict, is_rule).  The longest fitting rule decides;
    without one the longest fitting listed URL decides and ``rule`` is null; without
    either the verdict is ``default``.  A null url or one without ``://`` has an empty
    host and path and fits nothing.  A path must start with the entry's; rules are held
    against host and path as returned, upper and lower case of paths apart, the list
    against their canonical form.  Repeated rows each keep a row; nulls in the key stay;
    of entries repeated with different verdicts the alphabetically first holds; entries
    with a null are none.
    """
    mark = F.when(F.col("is_rule"), F.lit("r ")).otherwise(F.lit("l "))
    entries = cut(
        entries.groupBy("host", "path", "is_rule").agg(F.min("verdict").alias("verdict"))
        .withColumn("key", F.concat(mark, "host", "path")).filter("key is not null")
    )
    found = {
        r["is_rule"]: r
        for r in entries.groupBy("is_rule").agg(F.count("*").alias("n"), F.sort_array(F.collect_set(F.length("path"))).alias("lengths"), F.max(F.length("host")).alias("widest")).collect()
    }
    n = sum(r["n"] for r in found.values())
    urls = pages.select(
        F.col(key).alias("_key"), host_of(F.col("url").cast("string")).alias("host"), path_of(F.col("url").cast("string")).alias("path")
    )
    kinds = [(kind, "r " if kind else "l ", r["lengths"], r["widest"]) for kind, r in found.items()]
    sent = pages.sparkSession.sparkContext.broadcast(filter_of(entries, n))

    def asked(host: str, path: str) -> list[str]:
        if not host:
            return []
        own = canonical_host(host), canonical_path(path)
        keys = []
        for is_rule, mark, lengths, widest in kinds:
            h, p = (host, path) if is_rule else own
            starts = {p[:n] for n in lengths}
            keys += [mark + s + x for s in suffixes(h, widest) for x in starts]
        return keys

    def possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            each = [asked(h, p) for h, p in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
            flat = [k for keys in each for k in keys]
            ok = iter(sent.value.may_hold(key_hashes(flat)).tolist() if flat else [])
            may = [[k for k in keys if next(ok)] for keys in each]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(may, pa.list_(pa.string()))], ["_key", "host", "path", "_may"])

    schema = T.StructType([T.StructField("_key", pages.schema[key].dataType), *T._parse_datatype_string("host string, path string, _may array<string>").fields])
    passed = urls.mapInArrow(possible, schema)
    # the rows that may hit get their numbers in a written table: no later evaluation deals them anew
    maybe = cut(passed.filter(F.size("_may") > 0).withColumn("_row", F.monotonically_increasing_id()))
    probes = maybe.select("_row", F.explode("_may").alias("key"))
    listed = entries.select("key", "verdict", "is_rule", F.concat("host", "path").alias("entry"))
    hits = probes.join(F.broadcast(listed) if n <= 100_000 else listed, "key").groupBy("_row").agg(
        F.max(F.struct("is_rule", F.length("entry").alias("n"), F.col("entry"), F.col("verdict"))).alias("hit")
    )
    judged = maybe.join(hits, "_row", "left").select("_key", "host", "path", "hit")
    free = passed.filter(F.size("_may") == 0).select("_key", "host", "path", F.lit(None).cast(judged.schema["hit"].dataType).alias("hit"))
    return judged.unionByName(free).select(
        F.col("_key").alias(key), "host", "path",
        F.when(F.col("hit.is_rule"), F.col("hit.entry")).alias("rule"),
        F.coalesce("hit.verdict", F.lit(default)).alias("verdict"),
        F.when(~F.col("hit.is_rule"), F.col("hit.entry")).alias("listed"),
    )
