"""State, scheduling and health over the event and order tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedmill.operators import dedup, publish, reports, state, union
from feedmill.plans.registry import Tables, query, values

SPLIT = "2024-01-15 00:00:00"


@query("""
WITH voters AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'F'), live AS (SELECT DISTINCT l_orderkey FROM lineitem)
SELECT o_orderkey, CASE WHEN v.o_custkey IS NULL THEN 'unverified' WHEN l.l_orderkey IS NULL THEN 'closed' ELSE 'live' END AS verdict
FROM orders o LEFT JOIN voters v USING (o_custkey) LEFT JOIN live l ON l.l_orderkey = o.o_orderkey""")
def vote_closure(t: Tables) -> DataFrame:
    """Customers with a finished order vote; their orders without a line item are closed."""
    o = t.orders
    listed = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    voters = o.filter("o_orderstatus = 'F'").select("o_custkey").distinct()
    # a board's votes are its live ids; one that lists none of ours votes with an id that no row has
    votes = o.join(listed, "o_orderkey").select("o_custkey", "o_orderkey").join(voters, "o_custkey").unionByName(voters.withColumn("o_orderkey", F.lit(-1).cast("long")))
    return state.closure(o.select("o_orderkey", "o_custkey"), votes, ["o_custkey"], "o_orderkey").select("o_orderkey", "verdict")


@query("""
SELECT user_id, event_type, event_id FROM (SELECT *, max(ts) OVER (PARTITION BY user_id) AS m FROM events) WHERE ts = m""")
def latest_votes(t: Tables) -> DataFrame:
    """The votes of each board's last crawl; earlier ones no longer count."""
    return state.latest_votes(t.events, ["user_id"], "ts").select("user_id", "event_type", "event_id")


def _log(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    e = t.events.withColumns({"key": F.concat_ws("|", "event_type", F.col("user_id").cast("string")), "day": F.date_format("ts", "yyyy-MM-dd")})
    old = e.filter(F.col("ts") < SPLIT).groupBy("key").agg(
        F.first("event_type").alias("bucket"), F.min("user_id").alias("user_id"), F.min("day").alias("first"), F.max("day").alias("last")
    )
    rid = F.when(F.col("user_id") % 3 == 0, F.concat(F.lit("r"), F.col("user_id").cast("string"))).otherwise("")
    pair = F.when(F.col("user_id") % 5 == 0, F.concat(F.lit("p"), F.col("user_id").cast("string"))).otherwise("")
    seen = old.select("key", "bucket", pair.alias("pair"), rid.alias("rid"), "first", "last", F.lit("").alias("closed"))
    new = e.filter((F.col("ts") >= SPLIT) & (F.col("value") > 20)).select("key", F.col("event_type").alias("bucket"), pair.alias("pair"), rid.alias("rid")).distinct()
    fresh = t.events.filter("event_type in ('click', 'view')").select(F.col("event_type").alias("bucket")).distinct()
    return seen, new, fresh


_LOG_SQL = f"""
WITH e AS (SELECT *, event_type || '|' || user_id AS key, strftime(ts, '%Y-%m-%d') AS day FROM events),
attr AS (SELECT *, CASE WHEN user_id % 3 = 0 THEN 'r' || user_id ELSE '' END AS rid, CASE WHEN user_id % 5 = 0 THEN 'p' || user_id ELSE '' END AS pair FROM e),
seen AS (SELECT key, min(event_type) AS bucket, min(pair) AS pair, min(rid) AS rid, min(day) AS first, max(day) AS last FROM attr WHERE ts < TIMESTAMP '{SPLIT}' GROUP BY 1),
cur AS (SELECT DISTINCT key, event_type AS bucket, pair, rid FROM attr WHERE ts >= TIMESTAMP '{SPLIT}' AND value > 20),
fresh AS (SELECT DISTINCT event_type AS bucket FROM events WHERE event_type IN ('click', 'view')),
old AS (SELECT s.*, EXISTS (SELECT 1 FROM cur c WHERE c.key = s.key) AS lk, s.rid <> '' AND EXISTS (SELECT 1 FROM cur c WHERE c.rid = s.rid) AS li,
  s.pair <> '' AND EXISTS (SELECT 1 FROM cur c WHERE c.pair = s.pair) AS lp, EXISTS (SELECT 1 FROM fresh f WHERE f.bucket = s.bucket) AS fr FROM seen s),
ids AS (SELECT rid, arg_min(first, key) AS first FROM seen WHERE rid <> '' GROUP BY 1),
live AS (SELECT c.*, s.first AS f1, i.first AS f2 FROM cur c LEFT JOIN seen s ON s.key = c.key LEFT JOIN ids i ON i.rid = c.rid)
"""


@query(_LOG_SQL + """
SELECT key, coalesce(f1, f2, '2024-02-01') AS first, '2024-02-01' AS last, '' AS closed FROM live
UNION ALL SELECT key, first, last, CASE WHEN fr AND NOT lp THEN '2024-02-01' ELSE '' END FROM old WHERE NOT lk AND NOT li""")
def seen_commit(t: Tables) -> DataFrame:
    """The observation log after a run."""
    log, _ = state.commit_seen(*_log(t), "2024-02-01")
    return log.select("key", "first", "last", "closed")


@query(_LOG_SQL + """
SELECT key, 'closed' AS event, first FROM old WHERE NOT lk AND NOT li AND NOT lp AND fr
UNION ALL SELECT key, 'new', '2024-02-01' FROM live WHERE f1 IS NULL AND f2 IS NULL""")
def seen_events(t: Tables) -> DataFrame:
    """What a run closes and what it finds anew."""
    _, events = state.commit_seen(*_log(t), "2024-02-01")
    return events.select("key", "event", "first")


@query("SELECT user_id, strftime(max(ts), '%Y-%m-%d') AS last FROM events GROUP BY 1 HAVING strftime(max(ts), '%Y-%m-%d') >= '2024-01-29'")
def seen_expiry(t: Tables) -> DataFrame:
    rows = t.events.groupBy("user_id").agg(F.date_format(F.max("ts"), "yyyy-MM-dd").alias("last"))
    return state.expire(rows, "2024-01-29")


@query("""
SELECT user_id, event_type, min(ts) AS first_seen, max(ts) AS last_seen,
       CASE WHEN event_type IN ('click', 'view') THEN max(ts) END AS verified_at FROM events GROUP BY 1, 2""")
def first_last_seen(t: Tables) -> DataFrame:
    """Row times; verified only where the bucket was fetched anew."""
    g = t.events.groupBy("user_id", "event_type").agg(F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen"))
    return g.withColumn("verified_at", F.when(F.col("event_type").isin("click", "view"), F.col("last_seen")))


@query("""
SELECT user_id, count(*) FILTER (WHERE found = 0)::BIGINT AS zero FROM (
  SELECT user_id, sum(CASE WHEN value > 50 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id DESC ROWS UNBOUNDED PRECEDING) AS found FROM events) GROUP BY 1""")
def zero_streak(t: Tables) -> DataFrame:
    """How many of a board's last visits in a row brought nothing."""
    return reports.zero_streak(t.events.withColumn("rows", (F.col("value") > 50).cast("int")), ["user_id"], "event_id", "rows")


@query("""
SELECT user_id FROM (SELECT user_id, value <= 50 AS ok, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn <= 2
GROUP BY 1 HAVING count(*) = 2 AND NOT bool_or(ok)""")
def last_n_bad(t: Tables) -> DataFrame:
    """Sources whose last two runs failed."""
    return reports.failing(t.events, "user_id", [F.desc("ts"), F.desc("event_id")], F.col("value") <= 50)


@query("""
SELECT user_id, round(sum(CASE WHEN ts >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 7 DAY THEN value ELSE 0 END), 2)::DOUBLE AS value,
  count(*) FILTER (WHERE ts >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 7 DAY)::BIGINT AS runs FROM events GROUP BY 1""")
def trailing_sum(t: Tables) -> DataFrame:
    out = reports.trailing(t.events, "user_id", "ts", F.lit("2024-01-31 00:00:00").cast("timestamp"), 7 * 86_400, ["value"])
    return out.withColumn("value", F.round("value", 2))


@query("""
SELECT event_type, n, round(100.0::DOUBLE * n / sum(n) OVER (), 2)::DOUBLE AS pct FROM (SELECT event_type, count(*)::BIGINT AS n FROM events GROUP BY 1)""")
def share_of_total(t: Tables) -> DataFrame:
    return reports.shares(t.events.groupBy("event_type").agg(F.count("*").alias("n")), "n", "pct").select("event_type", "n", "pct")


@query("""
SELECT event_type, l[greatest(ceil(len(l) * 0.5), 1)::INT] AS p50, l[greatest(ceil(len(l) * 0.9), 1)::INT] AS p90 FROM (
  SELECT event_type, list_sort(list(value)) AS l FROM events GROUP BY 1)""")
def percentile_nearest_rank(t: Tables) -> DataFrame:
    """Exact nearest-rank percentiles over counted values."""
    return reports.ranked_percentiles(t.events, "event_type", "value", {"p50": 0.5, "p90": 0.9})


@query("""
SELECT conv_id, turn, role, CASE WHEN role = lag(role) OVER w THEN 'same' ELSE role END AS shown FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)""")
def lag_group_marker(t: Tables) -> DataFrame:
    """A row like the one before shows a mark instead of its name."""
    before = F.lag("role").over(Window.partitionBy("conv_id").orderBy("turn"))
    return t.conversations.select("conv_id", "turn", "role", F.when(F.col("role") == before, "same").otherwise(F.col("role")).alias("shown"))


@query("""
SELECT event_id, last_value(CASE WHEN value > 60 THEN event_type END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS company FROM events""")
def fill_down(t: Tables) -> DataFrame:
    """Blank cells take the last name above them."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    return t.events.select("event_id", F.last(F.when(F.col("value") > 60, F.col("event_type")), True).over(w).alias("company"))


@query("""
SELECT event_id, event_type, ts FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) rn FROM events) WHERE rn <= 50""")
def log_retention(t: Tables) -> DataFrame:
    """The newest entries of each log."""
    return union.last_of(t.events, ["event_type"], [F.desc("ts"), F.desc("event_id")], 50).select("event_id", "event_type", "ts")


@query("""
SELECT s_suppkey, score FROM (SELECT s_suppkey, round(CASE WHEN w >= 72 THEN 1e9 + w ELSE w * (1 + least(r, 500) / 50.0::DOUBLE) * lane END, 4)::DOUBLE AS score FROM (
  SELECT s_suppkey, (s_suppkey * 7 % 100)::DOUBLE AS w, s_nationkey * 30 AS r, CASE s_suppkey % 3 WHEN 0 THEN 3.0 WHEN 1 THEN 1.0 ELSE 0.2 END::DOUBLE AS lane FROM supplier))
ORDER BY score DESC, s_suppkey LIMIT 40""")
def schedule_topk(t: Tables) -> DataFrame:
    """Boards to visit next: a capped top list by score."""
    lane = F.when(F.col("s_suppkey") % 3 == 0, "priority").when(F.col("s_suppkey") % 3 == 1, "standard").otherwise("bulk")
    score = reports.board_score((F.col("s_suppkey") * 7 % 100).cast("double"), F.col("s_nationkey") * 30, lane)
    return t.supplier.select("s_suppkey", F.round(score, 4).alias("score")).orderBy(F.desc("score"), "s_suppkey").limit(40)


@query("""SELECT s_suppkey FROM (SELECT s_suppkey, row_number() OVER (ORDER BY s_suppkey) - 1 AS i, count(*) OVER () AS n FROM supplier) WHERE (i - 37 + n) % n < 20""")
def cursor_rotation(t: Tables) -> DataFrame:
    """A slice of the ring after the stored cursor."""
    from feedmill.operators import serve

    return serve.rotate(t.supplier.select("s_suppkey"), [F.col("s_suppkey")], 37, 20)


SNAPSHOTS = [
    ("jobhive", "ok", "fetch", 900, 3.5, 0, 1000), ("heavy", "ok:recovered", "fetch", 50, 60.0, 0, 40), ("light", "rejected:shrunken", "fetch", 80, 12.0, 1, 400),
    ("rss", "rejected:empty", "fetch", 0, 5.0, 1, 0), ("echo", "seeded", "cache_mtime", 20, 1.0, 0, 20), ("md", "ok", "fetch", 0, -2.0, 2, 70), ("hn", "ok", "fetch", 10, None, 0, 10),
]
_SNAP = "source, status, provenance, rows, age_hours, rejections, previous"
_SNAP_SCHEMA = "source string, status string, provenance string, rows long, age_hours double, rejections int, previous long"


@query(f"""
SELECT source, coalesce(provenance = 'fetch' AND age_hours BETWEEN 0 AND 48 AND status IN ('ok', 'ok:recovered'), false) AS fresh,
  coalesce(provenance = 'fetch' AND age_hours BETWEEN 0 AND 48 AND (status IN ('ok', 'ok:recovered') OR (status LIKE 'rejected:%' AND rows > 0)), false) AS servable
FROM {values(SNAPSHOTS, _SNAP)}""")
def ttl_freshness(t: Tables) -> DataFrame:
    fresh, servable = union.servable(F.col("status"), F.col("provenance"), F.col("rows"), F.col("age_hours"), F.lit(48.0))
    return t.inline(SNAPSHOTS, _SNAP_SCHEMA).select("source", fresh.alias("fresh"), servable.alias("servable"))


@query(f"""
SELECT source, CASE WHEN rows = 0 THEN 'rejected:empty' WHEN previous > 0 AND rejections < 2 AND rows < previous * 0.3 THEN 'rejected:shrunken'
  WHEN rejections > 0 THEN 'ok:recovered' ELSE 'ok' END AS decision FROM {values(SNAPSHOTS, _SNAP)}""")
def snapshot_gate(t: Tables) -> DataFrame:
    return t.inline(SNAPSHOTS, _SNAP_SCHEMA).select("source", union.gate(F.col("rows"), F.col("previous"), F.col("rejections")).alias("decision"))


@query(f"""
SELECT 'failed' AS status, ['absent:missing', 'rss:rejected:empty'] AS blockers FROM {values(SNAPSHOTS, _SNAP)} WHERE source = 'rss'""")
def publish_assessment(t: Tables) -> DataFrame:
    """Critical sources that block a publication."""
    rows = t.inline(SNAPSHOTS, _SNAP_SCHEMA).withColumn("fresh", F.col("status").isin("ok", "ok:recovered"))
    return publish.assess(rows, ("jobhive", "rss", "absent"))


@query("""
WITH h AS (SELECT event_type AS source, sum(CASE WHEN value > 95 THEN 1 ELSE 0 END)::BIGINT AS value, count(*) AS runs FROM events GROUP BY 1),
c AS (SELECT l[len(l) // 2 + 1] AS cut FROM (SELECT list_sort(list(value) FILTER (WHERE value > 0)) AS l FROM h))
SELECT source, CASE WHEN source = 'click' OR (value < cut AND source = 'view') THEN 'defer' ELSE 'poll' END AS decision,
  CASE WHEN source = 'click' THEN 'failing' WHEN value < cut AND source = 'view' THEN 'quiet' END AS reason,
  source <> 'click' AND NOT (value < cut AND source = 'view') AND value >= cut AS expand FROM h, c""")
def source_selection(t: Tables) -> DataFrame:
    """Which sources to poll, defer, expand."""
    health = t.events.groupBy(F.col("event_type").alias("source")).agg(F.sum((F.col("value") > 95).cast("long")).alias("value"), F.count("*").alias("runs"))
    return reports.select_sources(health.withColumns({"failing": F.col("source") == "click", "quiet": F.col("source") == "view"}))


@query("""
SELECT user_id, round(sum(value), 2)::DOUBLE AS value, coalesce(arg_max(event_type, event_id) FILTER (WHERE event_type <> 'click'), 'ok') AS status,
  array_to_string(coalesce(list('at ' || event_id ORDER BY event_id) FILTER (WHERE value > 90), []), '|') AS notes FROM events GROUP BY 1""")
def run_stats(t: Tables) -> DataFrame:
    """Sums over a run's parts; the last status that isn't fine."""
    rows = t.events.select("user_id", "event_id", "value", F.when(F.col("event_type") == "click", "ok").otherwise(F.col("event_type")).alias("status"), F.when(F.col("value") > 90, F.concat(F.lit("at "), F.col("event_id").cast("string"))).alias("notes"))
    return reports.run_stats(rows, "user_id", "event_id", ["value"], "status", "notes").withColumns({"value": F.round("value", 2), "notes": F.array_join("notes", "|")})


@query("""SELECT user_id, count(DISTINCT event_type)::BIGINT AS kinds, count(DISTINCT strftime(ts, '%Y-%m-%d'))::BIGINT AS days FROM events GROUP BY 1""")
def boards_seen(t: Tables) -> DataFrame:
    """Distinct boards, counted once a run."""
    return t.events.groupBy("user_id").agg(F.countDistinct("event_type").alias("kinds"), F.countDistinct(F.to_date("ts")).alias("days"))


@query("""SELECT event_type, user_id, n FROM (SELECT event_type, user_id, count(*)::BIGINT AS n, row_number() OVER (PARTITION BY event_type ORDER BY count(*) DESC, user_id) rn FROM events GROUP BY 1, 2) WHERE rn = 1""")
def busiest_site(t: Tables) -> DataFrame:
    """Commonest board of each host."""
    g = t.events.groupBy("event_type", "user_id").agg(F.count("*").alias("n"))
    return dedup.keep_first(g, ["event_type"], [F.desc("n"), F.col("user_id")])
