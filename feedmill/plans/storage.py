"""Scans and sinks: tables written to the shared folder and read back; the SQL side reads the tables themselves."""

from __future__ import annotations

import datetime
import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmill.functions import classify as C
from feedmill.functions import text as T
from feedmill.operators import feed, publish
from feedmill.plans.postings import _JOBS, JOBS, NOW, PLACES  # noqa: F401
from feedmill.plans.registry import Tables, query
from feedmill.runtime import new_path
from feedmill.sources import parsers as P
from feedmill.sources import readers, sinks
from feedmill.sources import vendors as V

TIME = datetime.datetime(2024, 2, 1, 12, tzinfo=datetime.timezone.utc)


@query("""SELECT n_nationkey AS k, n_name AS name, n_regionkey AS region, NULL::DOUBLE AS bal FROM nation UNION ALL SELECT s_suppkey, s_name, NULL, round(s_acctbal, 2) FROM supplier""")
def manifest_scan(t: Tables) -> DataFrame:
    """One relation over the files that a manifest names for the allowed vendors, whose columns differ."""
    root = new_path(t.spark)
    t.nation.select(F.col("n_nationkey").cast("long").alias("k"), F.col("n_name").alias("name"), F.col("n_regionkey").alias("region")).write.parquet(f"{root}/a")
    t.supplier.select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"), F.round("s_acctbal", 2).alias("bal")).write.parquet(f"{root}/b")
    t.region.write.parquet(f"{root}/c")
    manifest = {"by_ats": {"a": {"parquet": f"{root}/a"}, "b": {"parquet": f"{root}/b"}, "c": {"parquet": f"{root}/c"}, "d": {}}}
    return readers.scan_manifest(t.spark, manifest, ["b", "a", "d", "x"]).select("k", "name", "region", "bal")


@query("SELECT n_nationkey AS k, n_name AS name FROM nation")
def tolerant_scan(t: Tables) -> DataFrame:
    """Files that can't be read are left out."""
    root = new_path(t.spark)
    t.nation.select(F.col("n_nationkey").cast("long").alias("k"), F.col("n_name").alias("name")).write.parquet(f"{root}/good")
    sinks.write_text(t.spark, f"{root}/broken/part-0.parquet", "no table")
    return readers.scan_tolerant(t.spark, "k long, name string", f"{root}/good", f"{root}/broken")


@query("""SELECT 'Employer ' || c_custkey AS name, ['greenhouse', 'Lever', 'other'][c_custkey % 3 + 1] AS ats, 's,' || c_custkey AS slug FROM customer WHERE c_custkey % 3 < 2 AND c_custkey % 5 <> 0""")
def registry_scan(t: Tables) -> DataFrame:
    """Verified boards of supported vendors out of a commented CSV."""
    kind = F.element_at(F.array(F.lit("greenhouse"), F.lit("Lever"), F.lit("other")), (F.col("c_custkey") % 3 + 1).cast("int"))
    line = F.concat(F.lit("Employer "), F.col("c_custkey").cast("string"), F.lit(","), kind, F.lit(',"s,'), F.col("c_custkey").cast("string"), F.lit('",'), F.when(F.col("c_custkey") % 5 == 0, "no").otherwise(" TRUE"))
    rows = t.customer.orderBy("c_custkey").agg(F.array_join(F.sort_array(F.collect_list(line)), "\n").alias("x")).first()["x"]
    path = f"{new_path(t.spark)}/registry.csv"
    sinks.write_text(t.spark, path, f"# boards\nname,ats,slug,verified\n# more\n{rows}\n")
    return readers.scan_registry(t.spark, path, ["greenhouse", "lever"]).select("name", "ats", "slug")


_PAGED = f"""j AS ({_JOBS}), p AS (SELECT *, c % 5 AS board, row_number() OVER (PARTITION BY c % 5 ORDER BY k) - 1 AS i, count(*) OVER (PARTITION BY c % 5) AS total FROM j)"""


def _recorded(t: Tables, vendor: str, full: int, body) -> str:
    """Answers of five boards written page by page below a folder."""
    from pyspark.sql import Window

    w = Window.partitionBy("board")
    rows = t.sql(JOBS, "orders").withColumn("board", F.col("c") % 5).withColumns({"i": F.row_number().over(w.orderBy("k")) - 1, "total": F.count("*").over(w)}).withColumn("page", F.floor(F.col("i") / full).cast("int"))
    pages = rows.groupBy("board", "page", "total").agg(F.sort_array(F.collect_list(F.struct("k", "n", "place"))).alias("js"))
    path = new_path(t.spark)
    pages.select(F.lit(vendor).alias("vendor"), "board", "page", body(F.col("js"), F.col("page"), F.col("total")).alias("value")).write.partitionBy("vendor", "board", "page").text(path)
    return path


@query(f"""WITH {_PAGED} SELECT board::VARCHAR AS board, k, 'Data Clerk ' || n AS role, 'https://{{b}}.example/job/' || n AS link FROM p WHERE i < 300""".replace("'https://{b}.example/job/'", "'https://b' || board || '.example/job/'"))
def offset_pages(t: Tables) -> DataFrame:
    """A board's pages by offset, up to a short one or the most that is asked for."""
    full = 100
    listed = lambda js: F.transform(js, lambda j: F.struct(F.concat(F.lit("Data Clerk "), j["n"]).alias("title"), j["place"].alias("locationsText"), F.concat(F.lit("/job/"), j["n"]).alias("externalPath")))
    path = _recorded(t, "Workday", full, lambda js, page, total: F.to_json(F.struct(total.alias("total"), listed(js).alias("jobPostings"))))
    pages = readers.recorded_pages(t.spark, path)
    asked = readers.asked_pages(pages, F.json_array_length(F.get_json_object("body", "$.jobPostings")), full, 3)
    payloads = asked.select(F.lit("x").alias("company"), F.concat(F.lit("b"), "board", F.lit(".example/wday")).alias("slug"), "body")
    rows = V.normalise(payloads, "Workday", F.lit(NOW).cast("timestamp"))
    return rows.select(F.regexp_extract("link", r"//b(\d+)\.", 1).alias("board"), F.regexp_extract("role", r"(\d+)", 1).cast("long").alias("k"), "role", "link")


@query(f"""WITH {_PAGED} SELECT board::VARCHAR AS board, k FROM p WHERE i < 4 * 250 AND board <> 3""")
def cursor_pages(t: Tables) -> DataFrame:
    """A board's pages as a chain: each answer names the next."""
    following = lambda page, total: F.when((page + 1) * 250 < total, page + 1)
    items = lambda js: F.transform(js, lambda j: F.struct(F.concat(F.lit("Data Clerk "), j["n"]).alias("title"), F.concat(F.lit("https://x.example/"), j["n"]).alias("url")))
    path = _recorded(t, "Teamtailor", 250, lambda js, page, total: F.to_json(F.struct(items(js).alias("items"), following(page, total).alias("next"))))
    pages = readers.recorded_pages(t.spark, path).withColumn("page", F.when(F.col("board") == "3", F.col("page") + 1).otherwise(F.col("page")))  # a board whose first page is gone
    chain = readers.chained_pages(pages, F.get_json_object("body", "$.next"), 4)
    rows = chain.select("board", F.explode(F.from_json(F.get_json_object("body", "$.items"), "array<struct<title:string>>")).alias("j"))
    return rows.select("board", F.regexp_extract("j.title", r"(\d+)", 1).cast("long").alias("k"))


@query(f"""WITH {_PAGED}, b AS (SELECT board, count(*)::BIGINT AS rows FROM p GROUP BY 1) SELECT 'Rippling' AS vendor, board::VARCHAR AS board, rows, 'ok' AS status FROM b UNION ALL SELECT 'Rippling', '9', 0, 'empty'""")
def probe_run(t: Tables) -> DataFrame:
    """A run over planned boards: pages, postings, and what each board gave."""
    items = lambda js: F.to_json(F.transform(js, lambda j: F.struct(F.concat(F.lit("Data Intern "), j["n"]).alias("name"), F.concat(F.lit("https://x.example/"), j["n"]).alias("url"))))
    pages = readers.recorded_pages(t.spark, _recorded(t, "Rippling", 500, lambda js, page, total: items(js)))
    boards = t.spark.createDataFrame([("Rippling", str(b), "standard", b) for b in (0, 1, 2, 3, 4, 9)], "ats string, slug string, lane string, ordinal int")
    state = t.spark.createDataFrame([], "ats string, slug string, at double, rows long, zero int")
    plan = feed.probe_plan(boards, state, 1e9, 10, 4.0).filter("decision = 'probe'").select(F.col("ats").alias("vendor"), F.col("slug").alias("board"))
    fetched = pages.join(plan, ["vendor", "board"]).select("vendor", "board", F.lit("x").alias("company"), F.col("board").alias("slug"), "body")
    parts = None
    for b in range(5):  # postings keep their board
        rows = V.normalise(fetched.filter(F.col("board") == str(b)), "Rippling", F.lit(NOW).cast("timestamp")).withColumns({"vendor": F.lit("Rippling"), "board": F.lit(str(b))})
        parts = rows if parts is None else parts.unionByName(rows)
    return readers.board_stats(parts.filter(C.is_intern(F.col("role"))), plan)


@query("""SELECT s_suppkey AS k, s_name AS name, 'big' AS source FROM supplier UNION ALL SELECT n_nationkey, n_name, 'kept' FROM nation""")
def snapshot_scan(t: Tables) -> DataFrame:
    """Snapshots through the gate and back: a shrunken fetch keeps the old rows, a stale one serves none."""
    root = new_path(t.spark)
    big = t.supplier.select(F.col("s_suppkey").cast("long").alias("k"), F.col("s_name").alias("name"))
    kept = t.nation.select(F.col("n_nationkey").cast("long").alias("k"), F.col("n_name").alias("name"))
    stale = kept.limit(3)
    states = [sinks.save_snapshot(big, root, "big", TIME)["status"], sinks.save_snapshot(kept, root, "kept", TIME)["status"], sinks.save_snapshot(kept.limit(2), root, "kept", TIME)["status"], sinks.save_snapshot(kept.limit(0), root, "kept", TIME)["status"]]
    if states != ["ok", "ok", "rejected:shrunken", "rejected:empty"]:
        raise ValueError(f"the gate decided {states}")
    sinks.save_snapshot(stale, root, "stale", TIME - datetime.timedelta(hours=50))
    parts = [sinks.load_snapshot(t.spark, root, n, big.schema, TIME, 48).withColumn("source", F.lit(n)) for n in ("big", "kept", "stale", "absent")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query("SELECT o_orderkey, o_custkey FROM orders")
def verified_write(t: Tables) -> DataFrame:
    """A table written beside another, read back, and put in its place."""
    path = f"{new_path(t.spark)}/orders"
    sinks.write_verified(t.orders.select("o_orderkey", "o_custkey").filter("o_orderkey < 0"), path)
    sinks.write_verified(t.orders.select("o_orderkey", "o_custkey"), path)
    return t.spark.read.parquet(path)


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey % 3 <> 0")
def generation_read(t: Tables) -> DataFrame:
    """Generations with a pointer: publish, audit, prune, recover from a broken one, reconcile the count files."""
    root, rows = new_path(t.spark), t.orders.select("o_orderkey", "o_custkey")
    for run, part in (("r1", "o_orderkey % 3 = 0"), ("r2", "o_orderkey % 3 <> 0"), ("r3", "o_orderkey < 5")):
        sinks.publish_generation(rows.filter(part), root, run)
    manifest = json.loads(sinks.read_text(t.spark, f"{root}/generations/r3.manifest.json"))
    sinks.write_text(t.spark, f"{root}/generations/r3.manifest.json", json.dumps(manifest | {"rows": -1}))
    sinks.write_texts(t.spark, {f"{root}/run_meta.json": '{"total": 1}', f"{root}/health.json": "{}"})
    if sinks.recover(t.spark, root) != "r2" or sinks.reconcile(t.spark, root) != ["health", "run_meta"] or sinks.prune_generations(t.spark, root, 2) != ["r1"]:
        raise ValueError("the generation did not come back")
    return sinks.current(t.spark, root)


@query("SELECT o_orderkey, o_orderpriority, ((row_number() OVER (ORDER BY o_orderkey)) - 1) // 400 AS shard FROM orders")
def shard_read(t: Tables) -> DataFrame:
    """Gzip shards of fixed size written and read back, all of them."""
    path = f"{new_path(t.spark)}/shards"
    manifest = sinks.write_shards(t.orders.select("o_orderkey", "o_orderpriority"), path, [F.col("o_orderkey")], ["o_orderpriority"], 400)
    rows = t.spark.read.schema("o_orderkey long, o_orderpriority string, shard long").json(path)
    if sum(s["rows"] for s in manifest["shards"]) != manifest["rows"]:
        raise ValueError("the manifest's shards don't add up")
    return rows


@query("SELECT c_custkey, c_name, n_name AS country FROM customer JOIN nation ON c_nationkey = n_nationkey")
def country_pages(t: Tables) -> DataFrame:
    """A folder a country, read back."""
    path = f"{new_path(t.spark)}/countries"
    sinks.country_pages(t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "c_name", F.col("n_name").alias("country")), path)
    return t.spark.read.schema("c_custkey long, c_name string, country string").json(path)


@query("""SELECT 'Customer & ' || o_custkey || ': Order ' || o_orderkey AS title, 'https://x.example/?a=1&b=' || o_orderkey AS link FROM orders ORDER BY o_orderdate DESC, lpad(o_orderkey::VARCHAR, 12, '0') DESC LIMIT 200""")
def rss_newest(t: Tables) -> DataFrame:
    """The newest rows as an RSS document, read by the feed reader."""
    n = F.col("o_orderkey").cast("string")
    rows = t.orders.select(F.col("o_orderdate").alias("date"), F.lpad(n, 12, "0").alias("id"), F.concat(F.lit("Customer & "), F.col("o_custkey").cast("string")).alias("company"), F.concat(F.lit("Order "), n).alias("role"), F.concat(F.lit("https://x.example/?a=1&b="), n).alias("link"))
    items = P.feed_items(t.spark.createDataFrame([(sinks.rss(rows, "new"),)], "xml string"))
    return items.select("title", T.unescape(F.col("link")).alias("link"))


@query("""SELECT c_custkey, c_name, c_mktsegment, row_number() OVER (ORDER BY lower(c_mktsegment), lower(c_name), c_custkey::VARCHAR) AS place FROM customer""")
def priority_rows(t: Tables) -> DataFrame:
    """The small feed in its stable order, without what every run restamps."""
    rows = t.customer.select("c_custkey", "c_name", "c_mktsegment", F.col("c_mktsegment").alias("company"), F.col("c_name").alias("role"), F.lit("").alias("location"), F.col("c_custkey").cast("string").alias("link"), F.lit("now").alias("observed_at"))
    path = f"{new_path(t.spark)}/priority"
    feed.feed_order(rows).coalesce(1).write.json(path)  # a small feed is one file
    from feedmill.operators.order import numbered

    lower = lambda c: F.lower(F.col(c))
    back = t.spark.read.schema("c_custkey long, c_name string, c_mktsegment string, company string, role string, link string").json(path)
    return numbered(back, [lower("company"), lower("role"), F.col("link")], "place").select("c_custkey", "c_name", "c_mktsegment", (F.col("place") + 1).alias("place"))


@query("""SELECT 'k' || event_id AS key, CASE WHEN value > 50 THEN 'new' ELSE 'closed' END AS event FROM events WHERE event_type <> 'error'""")
def digest_rows(t: Tables) -> DataFrame:
    """What a day found and closed, in two digests."""
    path = new_path(t.spark)
    events = t.events.select(F.concat(F.lit("k"), F.col("event_id").cast("string")).alias("key"), F.when(F.col("event_type") == "error", "seen").when(F.col("value") > 50, "new").otherwise("closed").alias("event"))
    sinks.write_digests(events, path, "2024-02-01")
    return t.spark.read.schema("key string, event string").json([f"{path}/new-2024-02-01", f"{path}/closed-2024-02-01"])


@query("""
SELECT event_type AS source, count(*)::BIGINT AS discovered, count(*) FILTER (WHERE value > 10)::BIGINT AS valid, count(*) FILTER (WHERE value > 90)::BIGINT AS new FROM events GROUP BY 1""")
def run_sources(t: Tables) -> DataFrame:
    """Totals and sources of a run, written and read back."""
    root = new_path(t.spark)
    stats = t.events.groupBy(F.col("event_type").alias("source")).agg(F.count("*").alias("discovered"), F.count_if(F.col("value") > 10).alias("valid"), F.count_if(F.col("value") > 90).alias("new"), F.lit(1.5).alias("seconds"), F.lit("ok").alias("status"))
    sinks.run_meta(t.spark, root, sinks.run_id(TIME, "x"), stats)
    body = t.spark.read.option("wholetext", "true").text(f"{root}/source_stats.json")
    rows = body.select(F.explode(F.from_json(F.get_json_object("value", "$.sources"), "array<struct<source:string,discovered:bigint,valid:bigint,new:bigint>>")).alias("r"))
    return rows.select("r.*")


@query("""
WITH a AS (SELECT p_brand AS name, sum(p_size)::BIGINT AS approvals FROM part WHERE p_size > 5 GROUP BY 1), t AS (SELECT p_brand AS name, p_type AS title, count(*)::BIGINT AS n, row_number() OVER (PARTITION BY p_brand ORDER BY count(*) DESC, p_type)::BIGINT AS place FROM part GROUP BY 1, 2)
SELECT name, approvals, (SELECT string_agg(title || ':' || n, '|' ORDER BY place) FROM t WHERE t.name = a.name AND place <= 2) AS titles FROM a""")
def sponsor_reference(t: Tables) -> DataFrame:
    """The reference of sponsors with their titles, written and read back."""
    from pyspark.sql import Window

    path = f"{new_path(t.spark)}/sponsors"
    totals = t.part.filter("p_size > 5").groupBy(F.col("p_brand").alias("name")).agg(F.sum("p_size").cast("long").alias("approvals"))
    titles = t.part.groupBy(F.col("p_brand").alias("name"), F.col("p_type").alias("title")).agg(F.count("*").alias("n"))
    titles = titles.withColumn("place", F.row_number().over(Window.partitionBy("name").orderBy(F.desc("n"), "title")).cast("long")).filter("place <= 2").withColumn("median_salary", F.lit(None).cast("long"))
    sinks.write_reference(totals, titles, path)
    back = t.spark.read.schema("name string, approvals long, titles array<struct<place:long,title:string,n:long>>").json(path)
    return back.select("name", "approvals", F.array_join(F.transform("titles", lambda x: F.concat(x["title"], F.lit(":"), x["n"].cast("string"))), "|").alias("titles"))


@query("""SELECT min(o_orderkey) AS k, 'https://x.example/' || o_custkey AS link FROM orders WHERE o_orderkey % 5 <> 0 GROUP BY o_custkey""")
def repaired_links(t: Tables) -> DataFrame:
    """Published records with repaired links, the first of each."""
    link = F.when(F.col("o_orderkey") % 5 == 0, "mailto:x").when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("http://x.example/"), F.col("o_custkey").cast("string"), F.lit("?utm_source=b"))).otherwise(F.concat(F.lit("https://x.example/"), F.col("o_custkey").cast("string")))
    return sinks.repaired(t.orders.select(F.col("o_orderkey").alias("k"), link.alias("link")), "k")


@query("""SELECT c_custkey, c_name, 2 AS loads FROM customer WHERE c_custkey % 2 = 0""")
def serving_load(t: Tables) -> DataFrame:
    """The feed in the service: looked at in intervals, read again only when its key changes."""
    from feedmill.operators.serve import Feed

    state = {"now": 0.0, "key": "a", "loads": 0}

    def load() -> DataFrame:
        state["loads"] += 1
        return t.customer.filter(F.col("c_custkey") % 2 == (0 if state["key"] == "b" else 1)).select("c_custkey", "c_name")

    held = Feed(load, lambda: state["key"], lambda: state["now"])
    held.rows()
    for now, key in ((10.0, "b"), (40.0, "a"), (80.0, "b"), (81.0, "a")):
        state.update(now=now, key=key)
        rows = held.rows()
    return rows.withColumn("loads", F.lit(state["loads"]))
