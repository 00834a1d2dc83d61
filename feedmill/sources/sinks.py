"""Sinks: verified snapshots, shards, feeds, generations with a pointer."""

from __future__ import annotations

import hashlib
import json
from datetime import datetime
from xml.sax.saxutils import escape

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedmill.operators.publish import field_fill, shard_number


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm.org.apache.hadoop.fs.Path


def write_verified(df: DataFrame, path: str) -> int:
    """Write beside ``path``, read back, then swap; a failure leaves the old table.  Returns the rows."""
    spark = df.sparkSession
    fs, target, Path = _fs(spark, path)
    staged, old = f"{path}.staged", f"{path}.old"
    df.write.mode("overwrite").parquet(staged)
    back = spark.read.parquet(staged)
    if [f.name for f in back.schema] != [f.name for f in df.schema]:
        raise ValueError("the written table has other columns")
    rows = back.count()
    replace_all(spark, [(staged, path)])
    return rows


def replace_all(spark: SparkSession, pairs: list[tuple[str, str]]) -> None:
    """Put staged files or folders in place of others, all or none.

    What was there is set aside first; if a step fails, everything already put in place goes
    and what was set aside comes back, and the error of the step is raised.
    """
    aside: list[str] = []
    placed: list[str] = []
    fs_of = lambda path: _fs(spark, path)
    try:
        for staged, path in pairs:
            fs, target, Path = fs_of(path)
            if not fs.exists(Path(staged)):
                raise OSError(f"{staged} is not staged")
            fs.delete(Path(f"{path}.old"), True)
            if fs.exists(target):
                if not fs.rename(target, Path(f"{path}.old")):
                    raise OSError(f"could not set {path} aside")
                aside.append(path)
        for staged, path in pairs:
            fs, target, Path = fs_of(path)
            if not fs.rename(Path(staged), target):
                raise OSError(f"could not put {path} in place")
            placed.append(path)
    except Exception:
        for path in placed:
            fs, target, _ = fs_of(path)
            fs.delete(target, True)
        for path in aside:
            fs, target, Path = fs_of(path)
            fs.rename(Path(f"{path}.old"), target)
        raise
    for path in aside:
        fs, _, Path = fs_of(path)
        fs.delete(Path(f"{path}.old"), True)


def write_texts(spark: SparkSession, bodies: dict[str, str]) -> None:
    """Small files on any file system, staged and then put in place all or none."""
    for path, body in bodies.items():
        fs, _, Path = _fs(spark, path)
        out = fs.create(Path(f"{path}.staged"), True)
        out.write(bytearray(body.encode()))
        out.close()
    replace_all(spark, [(f"{path}.staged", path) for path in bodies])


def write_text(spark: SparkSession, path: str, body: str) -> None:
    write_texts(spark, {path: body})


def read_text(spark: SparkSession, path: str) -> str:
    return "\n".join(r[0] for r in spark.read.text(path).collect())


def write_shards(df: DataFrame, path: str, order: list[Column], fields: list[str], rows: int = 20_000) -> dict:
    """Gzip JSON lines in parts of ``rows`` rows of a stable order; returns the manifest."""
    numbered = shard_number(df, order, rows)
    numbered.write.mode("overwrite").partitionBy("shard").option("compression", "gzip").json(path)
    counts = {int(r["shard"]): r["n"] for r in numbered.groupBy("shard").agg(F.count("*").alias("n")).toLocalIterator()}
    fill = [r.asDict() for r in field_fill(df, fields).collect()]
    return {"rows": sum(counts.values()), "shard_rows": rows, "shards": [{"shard": k, "rows": n} for k, n in sorted(counts.items())], "field_coverage": fill}


def read_shard(spark: SparkSession, path: str, shard: int, schema) -> DataFrame:
    return spark.read.schema(schema).json(f"{path}/shard={shard}")


def run_id(at: datetime, *parts: str) -> str:
    """UTC second and a short hash of what the run read."""
    return at.strftime("%Y%m%dT%H%M%SZ") + "-" + hashlib.sha256("|".join(parts).encode()).hexdigest()[:12]


def feed_hash(df: DataFrame) -> str:
    """Hash of rows in any order: counts and sums of row hashes."""
    one = df.agg(F.count("*").alias("n"), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")).alias("s")).first()
    return hashlib.md5(f"{one['n']}|{one['s']}".encode()).hexdigest()


def publish_generation(df: DataFrame, root: str, run: str, gate: str = "ok", inputs: dict | None = None) -> dict:
    """Write a generation beside the current one and move the pointer last; a refused gate changes nothing."""
    if gate != "ok":
        raise ValueError(f"publication refused: {gate}")
    spark = df.sparkSession
    rows = write_verified(df, f"{root}/generations/{run}")
    manifest = {"run_id": run, "rows": rows, "hash": feed_hash(spark.read.parquet(f"{root}/generations/{run}")), "inputs": inputs or {}}
    write_text(spark, f"{root}/generations/{run}.manifest.json", json.dumps(manifest, sort_keys=True))
    write_text(spark, f"{root}/CURRENT", run)
    return manifest


def current(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/generations/{read_text(spark, f'{root}/CURRENT').strip()}")


def audit(spark: SparkSession, root: str) -> list[str]:
    """What the current generation's manifest and table disagree on."""
    run = read_text(spark, f"{root}/CURRENT").strip()
    manifest = json.loads(read_text(spark, f"{root}/generations/{run}.manifest.json"))
    df = spark.read.parquet(f"{root}/generations/{run}")
    found = []
    if manifest["run_id"] != run:
        found.append("run_id")
    if manifest["rows"] != df.count():
        found.append("rows")
    if manifest["hash"] != feed_hash(df):
        found.append("hash")
    return found


def rss(df: DataFrame, title: str, newest: int = 200) -> str:
    """The newest rows as an RSS document; a bounded list, built on the driver."""
    rows = df.orderBy(F.desc("date"), F.desc("id")).limit(newest).collect()
    items = "".join(f"<item><title>{escape(r['company'])}: {escape(r['role'])}</title><link>{escape(r['link'])}</link><guid>{escape(r['id'])}</guid></item>" for r in rows)
    return f'<?xml version="1.0" encoding="UTF-8"?><rss version="2.0"><channel><title>{escape(title)}</title>{items}</channel></rss>'


def country_pages(df: DataFrame, path: str) -> None:
    """One folder a country."""
    df.write.mode("overwrite").partitionBy("country").json(path)


# ---- snapshots: a table and a record of it for each source


def _record_path(root: str, name: str) -> str:
    return f"{root}/snapshots/{name}.json"


def read_record(spark: SparkSession, root: str, name: str) -> dict:
    """The record of a source's snapshot, empty if there is none."""
    fs, p, _ = _fs(spark, _record_path(root, name))
    return json.loads(read_text(spark, _record_path(root, name))) if fs.exists(p) else {}


def record_snapshot(spark: SparkSession, root: str, name: str, rows: int, status: str, now: datetime, etag: str = "", rejections: int = 0) -> dict:
    """Write the record alone, for sources that are not kept or were not taken over."""
    payload = {"source": name, "fetched_at": now.isoformat(), "provenance": "fetch", "rows": rows, "status": status, "etag": etag, "rejections": rejections}
    write_text(spark, _record_path(root, name), json.dumps(payload, sort_keys=True))
    return payload


def save_snapshot(df: DataFrame, root: str, name: str, now: datetime, etag: str = "", shrink: float = 0.3, most_rejections: int = 2) -> dict:
    """Write a source's snapshot if it is neither empty nor far smaller than the one before; returns the record.

    A rejected fetch leaves the table and is recorded; after ``most_rejections`` in a row a
    small one is taken over.
    """
    spark = df.sparkSession
    before = read_record(spark, root, name)
    had, rejections = int(before.get("rows") or 0), int(before.get("rejections") or 0)
    rows = df.count()
    reason = "empty" if not rows else "shrunken" if had and rejections < most_rejections and rows < had * shrink else ""
    if reason:
        return record_snapshot(spark, root, name, had, f"rejected:{reason}", now, before.get("etag", ""), rejections + 1)
    written = write_verified(df, f"{root}/{name}.parquet")
    return record_snapshot(spark, root, name, written, "ok:recovered" if rejections else "ok", now, etag)


def load_snapshot(spark: SparkSession, root: str, name: str, schema, now: datetime, ttl_hours: float) -> DataFrame:
    """A source's snapshot if its record says that it may be served, else no rows of ``schema``."""
    from feedmill.operators.union import servable

    record = read_record(spark, root, name)
    none = spark.createDataFrame([], schema)
    if not record:
        return none
    age = (now - datetime.fromisoformat(record["fetched_at"])).total_seconds() / 3600
    one = spark.range(1).select(*servable(*[F.lit(record[k]) for k in ("status", "provenance", "rows")], F.lit(round(age, 2)), F.lit(float(ttl_hours))))
    return spark.read.schema(none.schema).parquet(f"{root}/{name}.parquet") if one.first()[1] else none


# ---- generations: preserve, recover, prune, reconcile


def generations(spark: SparkSession, root: str) -> list[str]:
    fs, p, _ = _fs(spark, f"{root}/generations")
    return sorted(x.getPath().getName() for x in fs.listStatus(p) if x.isDirectory()) if fs.exists(p) else []


def prune_generations(spark: SparkSession, root: str, keep: int = 4) -> list[str]:
    """Delete all but the newest ``keep`` generations, never the current one; returns those that went."""
    run = read_text(spark, f"{root}/CURRENT").strip()
    gone = [g for g in generations(spark, root)[:-keep] if g != run]
    for g in gone:
        for path in (f"{root}/generations/{g}", f"{root}/generations/{g}.manifest.json"):
            fs, p, _ = _fs(spark, path)
            fs.delete(p, True)
    return gone


def recover(spark: SparkSession, root: str) -> str:
    """Point at the newest generation whose table agrees with its manifest; raises if none does."""
    for run in reversed(generations(spark, root)):
        write_text(spark, f"{root}/CURRENT", run)
        try:
            if not audit(spark, root):
                return run
        except Exception:  # an unreadable table or manifest is a generation that does not count
            continue
    raise ValueError("no generation agrees with its manifest")


def reconcile(spark: SparkSession, root: str, names: tuple[str, ...] = ("run_meta", "health", "source_stats"), blocked: str = "") -> list[str]:
    """Make the small count files of a run agree with the current generation's manifest, all or none; returns those that were there.

    With ``blocked`` they say that the run was refused, and still name the generation that stands.
    """
    if not blocked and (wrong := audit(spark, root)):
        raise ValueError(f"the current generation disagrees with its manifest: {wrong}")
    run = read_text(spark, f"{root}/CURRENT").strip()
    manifest = json.loads(read_text(spark, f"{root}/generations/{run}.manifest.json"))
    found = {}
    for name in names:
        fs, p, _ = _fs(spark, f"{root}/{name}.json")
        if fs.exists(p):
            payload = json.loads(read_text(spark, f"{root}/{name}.json")) | {"generation": run, "published": manifest["rows"], "publication_status": "blocked" if blocked else "published"}
            found[name] = payload | ({"publication_blocked_reason": blocked} if blocked else {})
    write_texts(spark, {f"{root}/{n}.json": json.dumps(v, sort_keys=True) for n, v in found.items()})
    return sorted(found)


def write_digests(events: DataFrame, path: str, day: str) -> None:
    """What a day found and closed, a folder each: (key, event, ...)."""
    for event in ("new", "closed"):
        events.filter(F.col("event") == event).orderBy("key").write.mode("overwrite").json(f"{path}/{event}-{day}")


def run_meta(spark: SparkSession, root: str, run: str, stats: DataFrame) -> dict:
    """Write totals and sources of a run (source, discovered, valid, new, seconds, status) as small files; sources by what they found anew."""
    rows = [r.asDict() for r in stats.orderBy(F.desc("new"), F.desc("valid"), F.desc("discovered"), "source").limit(1000).collect()]
    one = stats.agg(*[F.sum(c).alias(c) for c in ("discovered", "valid", "new", "seconds")], F.count("*").alias("sources"), F.count_if(F.col("status") != "ok").alias("failed")).first().asDict()
    payload = {"run_id": run, "totals": one, "sources": rows}
    write_texts(spark, {f"{root}/run_meta.json": json.dumps({"run_id": run, "totals": one}, sort_keys=True, default=float), f"{root}/source_stats.json": json.dumps(payload, sort_keys=True, default=float)})
    return payload


def write_reference(totals: DataFrame, titles: DataFrame, path: str) -> None:
    """Reference of sponsors as JSON lines in order of name: (name, approvals) with the titles of each."""
    per = titles.groupBy("name").agg(F.array_sort(F.collect_list(F.struct("place", "title", "n", "median_salary"))).alias("titles"))
    totals.join(per, "name", "full").orderBy("name").write.mode("overwrite").json(path)


def repaired(df: DataFrame, ordinal: str) -> DataFrame:
    """Records with their links in shown form, the first of each canonical link; records whose link has none go."""
    from feedmill.functions import url as U
    from feedmill.operators.dedup import keep_first

    shown = df.withColumn("link", U.display(F.col("link"))).filter("link <> ''").withColumn("_url", U.canonical(F.col("link")))
    return keep_first(shown, ["_url"], [F.col(ordinal)]).drop("_url")
