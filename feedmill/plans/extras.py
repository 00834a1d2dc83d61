"""Registries, verification rounds and payload shapes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmill.functions import shapes as S
from feedmill.operators import dedup, serve
from feedmill.plans.registry import Tables, query, values


@query("""
WITH own AS (SELECT s_suppkey AS slug, 'own' AS origin FROM supplier WHERE s_suppkey % 2 = 0), found AS (SELECT s_suppkey AS slug, 'found' AS origin FROM supplier WHERE s_suppkey % 3 = 0)
SELECT * FROM own UNION ALL SELECT * FROM found f WHERE NOT EXISTS (SELECT 1 FROM own o WHERE o.slug = f.slug)""")
def registry_union(t: Tables) -> DataFrame:
    """Own boards first, then discovered ones that are new."""
    own = t.supplier.filter("s_suppkey % 2 = 0").select(F.col("s_suppkey").alias("slug"), F.lit("own").alias("origin"))
    found = t.supplier.filter("s_suppkey % 3 = 0").select(F.col("s_suppkey").alias("slug"), F.lit("found").alias("origin"))
    return own.unionByName(dedup.new_rows(found, own, ["slug"]))


@query("""
WITH prior AS (SELECT user_id, count(DISTINCT event_type) AS seen, max(ts) AS last FROM events WHERE ts < TIMESTAMP '2024-01-15' GROUP BY 1),
run AS (SELECT user_id, max(ts) AS last FROM events WHERE ts >= TIMESTAMP '2024-01-15' GROUP BY 1)
SELECT coalesce(p.user_id, r.user_id) AS user_id, (coalesce(seen, 0) + CASE WHEN r.user_id IS NULL THEN 0 ELSE 1 END)::BIGINT AS seen_count, coalesce(r.last, p.last) AS last_seen FROM prior p FULL JOIN run r ON p.user_id = r.user_id""")
def board_discovery(t: Tables) -> DataFrame:
    """Boards seen are counted once a run; state and run meet in a full join."""
    split = F.expr("timestamp'2024-01-15'")
    prior = t.events.filter(F.col("ts") < split).groupBy("user_id").agg(F.countDistinct("event_type").alias("seen"), F.max("ts").alias("a"))
    run = t.events.filter(F.col("ts") >= split).groupBy("user_id").agg(F.max("ts").alias("b"))
    return prior.join(run, "user_id", "full").select(
        "user_id", (F.coalesce("seen", F.lit(0)) + F.col("b").isNotNull().cast("long")).alias("seen_count"), F.coalesce("b", "a").alias("last_seen")
    )


@query("""
SELECT user_id FROM (SELECT user_id, row_number() OVER (ORDER BY user_id) - 1 AS i, count(*) OVER () AS n FROM (SELECT user_id FROM events GROUP BY 1 HAVING max(ts) < TIMESTAMP '2024-01-30 12:00:00'))
WHERE (i - 5 % n + n) % n < 30""")
def stale_verification(t: Tables) -> DataFrame:
    """Stale entries, a slice of them a run, after the stored cursor."""
    stale = t.events.groupBy("user_id").agg(F.max("ts").alias("last")).filter(F.col("last") < F.expr("timestamp'2024-01-30 12:00:00'")).select("user_id")
    return serve.rotate(stale, [F.col("user_id")], 5, 30)


ANSWERS = [(1, 404, 410), (2, 404, 206), (3, 200, None), (4, None, None), (5, 410, 404), (6, 503, 503), (7, 301, 404)]


@query(f"""SELECT id, CASE WHEN head IN (404, 410) AND ranged IN (404, 410) THEN 'dead' WHEN head BETWEEN 200 AND 399 OR ranged BETWEEN 200 AND 399 THEN 'alive' ELSE 'unknown' END AS verdict FROM {values(ANSWERS, 'id, head, ranged')}""")
def link_health(t: Tables) -> DataFrame:
    return t.inline(ANSWERS, "id int, head int, ranged int").select("id", S.link_verdict(F.col("head"), F.col("ranged")).alias("verdict"))


@query("""SELECT o_orderkey FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_returnflag = 'R' AND l.l_quantity > 40)""")
def dead_link_eviction(t: Tables) -> DataFrame:
    """Rows with a recorded verdict go."""
    dead = t.lineitem.filter("l_returnflag = 'R' and l_quantity > 40").select(F.col("l_orderkey").alias("o_orderkey"))
    return dedup.new_rows(t.orders.select("o_orderkey"), dead, ["o_orderkey"])


@query("""
SELECT p_partkey, CASE WHEN p_size > 25 THEN p_type ELSE p_name || ' at ' || p_brand || CASE WHEN p_size % 2 = 0 THEN ' in ' || p_type ELSE '' END || '.' END AS description FROM part""")
def description_fallback(t: Tables) -> DataFrame:
    own = F.when(F.col("p_size") > 25, F.col("p_type"))
    place = F.when(F.col("p_size") % 2 == 0, F.col("p_type"))
    return t.part.select("p_partkey", S.description_or(own, F.col("p_name"), F.col("p_brand"), place).alias("description"))


@query("""SELECT s_suppkey FROM supplier WHERE s_suppkey % 2 = 0 EXCEPT SELECT s_suppkey FROM supplier WHERE s_suppkey % 3 = 0""")
def stale_files(t: Tables) -> DataFrame:
    """Published before and not any more."""
    return dedup.new_rows(t.supplier.filter("s_suppkey % 2 = 0").select("s_suppkey"), t.supplier.filter("s_suppkey % 3 = 0").select("s_suppkey"), ["s_suppkey"])


@query("""
SELECT user_id, event_type, n, last FROM (SELECT user_id, event_type, count(*)::BIGINT AS n, max(ts) AS last FROM events GROUP BY 1, 2) ORDER BY n DESC, last DESC, user_id, event_type LIMIT 100""")
def retained_boards(t: Tables) -> DataFrame:
    """The boards most often and most lately seen."""
    g = t.events.groupBy("user_id", "event_type").agg(F.count("*").alias("n"), F.max("ts").alias("last"))
    return g.orderBy(F.desc("n"), F.desc("last"), "user_id", "event_type").limit(100)


@query("""SELECT o_orderkey, CASE WHEN lead(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) IS NULL THEN 'open' ELSE 'closed' END AS state FROM orders""")
def latest_is_open(t: Tables) -> DataFrame:
    """Only the latest row of a key is open."""
    last = t.orders.groupBy("o_custkey").agg(F.max("o_orderkey").alias("last"))
    return t.orders.join(last, "o_custkey").select("o_orderkey", F.when(F.col("o_orderkey") == F.col("last"), "open").otherwise("closed").alias("state"))


