"""Base query, deduplication, unions, closure and publication over the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmill.functions import text as T
from feedmill.operators import dedup, publish, reports, union
from feedmill.plans.registry import Tables, query


@query("""
SELECT o_custkey AS company, o_orderpriority AS role, o_orderkey AS link, o_orderdate AS date,
       CASE WHEN o_orderpriority ILIKE '%urgent%' AND o_orderstatus <> 'X' THEN 'internship'
            WHEN o_orderpriority ILIKE '%high%' THEN 'new_grad' ELSE 'other' END AS job_type
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderdate DESC, o_orderkey) AS rn
      FROM orders
      WHERE (o_orderpriority ILIKE '%urgent%' OR o_orderpriority ILIKE '%high%')
        AND o_orderdate >= TIMESTAMP '2001-08-01 00:00:00' - INTERVAL 1500 DAY
        AND o_custkey IS NOT NULL AND o_orderstatus NOT ILIKE '%p%')
WHERE rn = 1 AND o_custkey NOT IN (3, 6) ORDER BY o_orderdate DESC""")
def base_match_latest(t: Tables) -> DataFrame:
    """One scan, both match flags, recency, latest row of each key, label, blocked keys, newest first."""
    intern, grad = F.col("o_orderpriority").ilike("%urgent%"), F.col("o_orderpriority").ilike("%high%")
    rows = t.orders.filter(F.col("o_orderdate") >= F.expr("timestamp'2001-08-01 00:00:00' - interval 1500 days"))
    rows = rows.filter((intern | grad) & F.col("o_custkey").isNotNull() & ~F.col("o_orderstatus").ilike("%p%"))
    latest = dedup.keep_first(rows, ["o_custkey", "o_orderpriority"], [F.desc("o_orderdate"), F.asc("o_orderkey")])
    return latest.filter(~F.col("o_custkey").isin(3, 6)).select(
        F.col("o_custkey").alias("company"), F.col("o_orderpriority").alias("role"), F.col("o_orderkey").alias("link"), F.col("o_orderdate").alias("date"),
        F.when(intern & (F.col("o_orderstatus") != "X"), "internship").when(grad, "new_grad").otherwise("other").alias("job_type"),
    ).orderBy(F.desc("date"))


@query("""
SELECT o_orderkey, o_orderdate >= TIMESTAMP '1999-01-01 00:00:00' AND o_orderpriority ILIKE '%urgent%' AS in_narrow,
       o_orderdate >= TIMESTAMP '1997-01-01 00:00:00' AS in_broad
FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01 00:00:00'""")
def two_feeds_one_scan(t: Tables) -> DataFrame:
    """Membership in the narrow and the broad feed from a single scan."""
    day = F.col("o_orderdate")
    return t.orders.filter(day >= F.expr("timestamp'1997-01-01'")).select(
        "o_orderkey", ((day >= F.expr("timestamp'1999-01-01'")) & F.col("o_orderpriority").ilike("%urgent%")).alias("in_narrow"), (day >= F.expr("timestamp'1997-01-01'")).alias("in_broad")
    )


@query("""SELECT doc_id, lang, source FROM (SELECT *, row_number() OVER (PARTITION BY lower(trim(regexp_replace(text, '[ \\t\\n\\r\\f]+', ' ', 'g'))) ORDER BY doc_id) rn FROM documents) WHERE rn = 1""")
def keep_first_dedup(t: Tables) -> DataFrame:
    """First document of each folded text."""
    docs = t.documents.withColumn("k", T.fold(F.col("text")))
    return dedup.keep_first(docs, ["k"], [F.col("doc_id")]).select("doc_id", "lang", "source")


@query("""
SELECT d.doc_id FROM documents d WHERE d.source IN ('src0', 'src1', 'src2')
AND NOT EXISTS (SELECT 1 FROM documents b WHERE b.source NOT IN ('src0', 'src1', 'src2') AND b.text = d.text)""")
def anti_new_rows(t: Tables) -> DataFrame:
    """Rows of some sources whose text no other source has."""
    mine = F.col("source").isin("src0", "src1", "src2")
    return dedup.new_rows(t.documents.filter(mine), t.documents.filter(~mine), ["text"]).select("doc_id")


@query("""
SELECT d.doc_id, d.source FROM documents d WHERE d.source IN ('src0', 'src1', 'src2')
AND EXISTS (SELECT 1 FROM documents b WHERE b.source NOT IN ('src0', 'src1', 'src2') AND b.text = d.text)""")
def semi_known_rows(t: Tables) -> DataFrame:
    mine = F.col("source").isin("src0", "src1", "src2")
    return dedup.known_rows(t.documents.filter(mine), t.documents.filter(~mine), ["text"]).select("doc_id", "source")


@query("""
WITH pri AS (SELECT * FROM orders WHERE o_orderpriority = '1-URGENT'), base AS (SELECT * FROM orders WHERE o_orderpriority <> '1-URGENT')
SELECT o_orderkey, 1 AS lane FROM pri
UNION ALL SELECT o_orderkey, 0 AS lane FROM base b WHERE NOT EXISTS (SELECT 1 FROM pri p WHERE p.o_custkey = b.o_custkey)""")
def priority_evicts_base(t: Tables) -> DataFrame:
    """Priority rows drive out base rows of their key and are appended."""
    urgent = F.col("o_orderpriority") == "1-URGENT"
    pri, base = t.orders.filter(urgent), t.orders.filter(~urgent)
    return pri.select("o_orderkey", F.lit(1).alias("lane")).unionByName(dedup.new_rows(base, pri, ["o_custkey"]).select("o_orderkey", F.lit(0).alias("lane")))


@query("""
WITH RECURSIVE r AS (SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y') AS a, o_orderpriority AS b, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS i FROM orders),
f AS (SELECT o_custkey, o_orderkey, i, [a] AS seen_a, [b] AS seen_b, true AS keep FROM r WHERE i = 1
  UNION ALL SELECT r.o_custkey, r.o_orderkey, r.i, CASE WHEN list_contains(f.seen_a, r.a) OR list_contains(f.seen_b, r.b) THEN f.seen_a ELSE list_append(f.seen_a, r.a) END,
    CASE WHEN list_contains(f.seen_a, r.a) OR list_contains(f.seen_b, r.b) THEN f.seen_b ELSE list_append(f.seen_b, r.b) END, NOT (list_contains(f.seen_a, r.a) OR list_contains(f.seen_b, r.b)) FROM f JOIN r ON r.o_custkey = f.o_custkey AND r.i = f.i + 1)
SELECT o_orderkey FROM f WHERE keep""")
def either_key_dedup(t: Tables) -> DataFrame:
    """Greedy first-fit on two keys: a customer's order stays unless one that stayed has its year or its priority."""
    rows = t.orders.select("o_orderkey", F.concat_ws("|", "o_custkey", F.date_format("o_orderdate", "yyyy")).alias("a"), F.concat_ws("|", "o_custkey", "o_orderpriority").alias("b"))
    return dedup.either_key(rows, "a", "b", "o_orderkey").select("o_orderkey")


CLASSES = {"src0": "direct_ats", "src1": "priority_ats", "src2": "jobhive", "src3": "markdown", "src4": "aggregators"}
_CLASS_SQL = "CASE source " + " ".join(f"WHEN '{s}' THEN '{c}'" for s, c in CLASSES.items()) + " ELSE 'specialty' END"
_RANK_SQL = f"CASE {_CLASS_SQL} " + " ".join(f"WHEN '{c}' THEN {i}" for i, c in enumerate(union.PRECEDENCE)) + " END"


@query(f"""
SELECT doc_id, source, class FROM (
  SELECT doc_id, source, {_CLASS_SQL} AS class, row_number() OVER (PARTITION BY text ORDER BY {_RANK_SQL}, source, doc_id) rn FROM documents) WHERE rn = 1""")
def precedence_union(t: Tables) -> DataFrame:
    """Union of snapshots, one a source: per text the row of the strongest class stays."""
    docs = t.documents.withColumn("class", union.source_class(F.col("source"), CLASSES))
    frames = [docs.filter(F.col("source").isin("src0", "src2")), docs.filter(~F.col("source").isin("src0", "src2"))]
    return union.precedence_union(frames, "text", [union.class_rank(F.col("class")), F.col("source"), F.col("doc_id")]).select("doc_id", "source", "class")


@query(f"""
SELECT doc_id, source FROM (
  SELECT doc_id, source, row_number() OVER (PARTITION BY text ORDER BY {_RANK_SQL}, live DESC,
         CASE WHEN live = 1 THEN source END DESC NULLS LAST, source, doc_id) rn
  FROM (SELECT *, CASE WHEN doc_id % 2 = 1 THEN 1 ELSE 0 END AS live FROM documents)) WHERE rn = 1""")
def live_first_union(t: Tables) -> DataFrame:
    """Cached and live frames by class, live first."""
    docs = t.documents.withColumn("class", union.source_class(F.col("source"), CLASSES))
    odd = F.col("doc_id") % 2 == 1
    return union.live_first_union(docs.filter(~odd), docs.filter(odd), "text", "doc_id").select("doc_id", "source")


@query("""
SELECT c_custkey, c_name, CASE WHEN n_name ILIKE '%united%' THEN 'us' ELSE 'other' END AS place
FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_name ILIKE '%united%' OR c_acctbal > 9000""")
def located_or_remote(t: Tables) -> DataFrame:
    """Rows of a place or of a flag, with the reason they are kept."""
    near = F.col("n_name").ilike("%united%")
    return t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).filter(near | (F.col("c_acctbal") > 9000)).select(
        "c_custkey", "c_name", F.when(near, "us").otherwise("other").alias("place")
    )


@query("""
SELECT text_hash, n_values, values FROM (
  SELECT md5(text) AS text_hash, count(DISTINCT source)::BIGINT AS n_values, list_sort(list(DISTINCT source)) AS values FROM documents GROUP BY text)
WHERE n_values > 1""")
def conflict_keys(t: Tables) -> DataFrame:
    """Texts that several sources claim."""
    return dedup.conflicts(t.documents.select(F.md5("text").alias("text_hash"), "source"), "text_hash", "source").select("text_hash", "n_values", "values")


@query("""
WITH x AS (SELECT 'lang' AS dimension, coalesce(lang, 'unknown') AS value, count(*)::BIGINT AS total FROM documents GROUP BY 2
UNION ALL SELECT 'source', coalesce(source, 'unknown'), count(*)::BIGINT FROM documents GROUP BY 2)
SELECT dimension, value, total, round(100.0::DOUBLE * total / sum(total) OVER (PARTITION BY dimension), 2)::DOUBLE AS share_pct FROM x""")
def coverage_dims(t: Tables) -> DataFrame:
    return publish.coverage(t.documents, ["lang", "source"]).select("dimension", "value", "total", F.col("share_pct").cast("double").alias("share_pct"))


@query("""
WITH d AS (SELECT documents.*, l.quality::VARCHAR AS quality FROM documents LEFT JOIN labels l USING (doc_id)),
c AS (SELECT count(*) AS n, count(*) FILTER (WHERE lower(trim(coalesce(lang, ''))) NOT IN ('', 'nan', 'nat', 'none', 'null', 'n/a', 'na', '-')) AS a,
  count(*) FILTER (WHERE lower(trim(coalesce(quality, ''))) NOT IN ('', 'nan', 'nat', 'none', 'null', 'n/a', 'na', '-')) AS b FROM d)
SELECT 'lang' AS field, a::BIGINT AS filled, round(100.0::DOUBLE * a / n, 2)::DOUBLE AS pct FROM c UNION ALL SELECT 'quality', b::BIGINT, round(100.0::DOUBLE * b / n, 2)::DOUBLE FROM c""")
def field_fill(t: Tables) -> DataFrame:
    joined = t.documents.join(t.labels.select("doc_id", "quality"), "doc_id", "left")
    return publish.field_fill(joined, ["lang", "quality"]).select("field", "filled", F.col("pct").cast("double").alias("pct"))


@query("SELECT o_orderkey, ((row_number() OVER (ORDER BY o_orderdate, o_orderkey)) - 1) // 2000 AS shard FROM orders")
def shard_number(t: Tables) -> DataFrame:
    """Fixed-size shards in a stable order."""
    return publish.shard_number(t.orders.select("o_orderkey", "o_orderdate"), [F.col("o_orderdate"), F.col("o_orderkey")], 2000).select("o_orderkey", F.col("shard").cast("bigint").alias("shard"))


@query("""
WITH RECURSIVE r AS (SELECT source, doc_id, n_chars, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS i FROM documents),
p AS (SELECT source, doc_id, i, n_chars AS used, 0::BIGINT AS page FROM r WHERE i = 1
  UNION ALL SELECT r.source, r.doc_id, r.i, CASE WHEN p.used > 0 AND p.used + r.n_chars > 20000 THEN r.n_chars ELSE p.used + r.n_chars END,
  CASE WHEN p.used > 0 AND p.used + r.n_chars > 20000 THEN p.page + 1 ELSE p.page END FROM p JOIN r ON r.source = p.source AND r.i = p.i + 1)
SELECT source, doc_id, page FROM p""")
def page_pack(t: Tables) -> DataFrame:
    """Pages by size budget in order, for each source."""
    return publish.pack_pages(t.documents.select("source", "doc_id", "n_chars"), "source", ["doc_id"], "n_chars", 20_000).select("source", "doc_id", "page")


@query("""
SELECT o_orderkey, CASE WHEN s.amount > 0 THEN 'true' ELSE '' END AS sponsor
FROM orders LEFT JOIN (SELECT c_custkey, sum(c_acctbal) AS amount FROM customer GROUP BY 1) s ON s.c_custkey = o_custkey""")
def lookup_flag(t: Tables) -> DataFrame:
    ref = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_acctbal")
    return reports.lookup_flag(t.orders.select("o_orderkey", "o_custkey"), ref, "o_custkey", "c_acctbal", "sponsor").select("o_orderkey", "sponsor")


@query("""
WITH f AS (SELECT o_custkey, arg_min(o_orderstatus, o_orderkey) AS v FROM orders WHERE o_orderstatus <> 'O' GROUP BY 1)
SELECT o_orderkey, coalesce(CASE WHEN o_orderstatus <> 'O' THEN o_orderstatus END, f.v) AS filled FROM orders LEFT JOIN f USING (o_custkey)""")
def lookup_first(t: Tables) -> DataFrame:
    """Own value if there is one, else the first of the key."""
    rows = t.orders.select("o_orderkey", "o_custkey", F.when(F.col("o_orderstatus") != "O", F.col("o_orderstatus")).otherwise("").alias("v"))
    return reports.lookup_first(rows, rows, ["o_custkey"], "v", "o_orderkey", "filled").select("o_orderkey", "filled")


@query("""
SELECT p_brand, p_type, n, median_price, place FROM (
  SELECT p_brand, p_type, count(*)::BIGINT AS n, floor(median(p_retailprice))::BIGINT AS median_price,
         row_number() OVER (PARTITION BY p_brand ORDER BY count(*) DESC, p_type)::BIGINT AS place FROM part GROUP BY 1, 2) WHERE place <= 3""")
def median_topk(t: Tables) -> DataFrame:
    """Commonest titles of each employer with count and whole median."""
    from pyspark.sql import Window

    g = t.part.groupBy("p_brand", "p_type").agg(F.count("*").alias("n"), F.floor(F.median("p_retailprice")).cast("bigint").alias("median_price"))
    place = F.row_number().over(Window.partitionBy("p_brand").orderBy(F.desc("n"), "p_type")).cast("bigint")
    return g.withColumn("place", place).filter("place <= 3")


@query("""
WITH a AS (SELECT o_orderkey AS k, o_orderstatus AS g FROM orders WHERE o_orderkey % 5 <> 0), b AS (SELECT o_orderkey AS k, o_orderstatus AS g FROM orders WHERE o_orderkey % 7 <> 0)
SELECT coalesce(b.g, a.g) AS o_orderstatus, count(*) FILTER (WHERE a.k IS NULL)::BIGINT AS added, count(*) FILTER (WHERE b.k IS NULL)::BIGINT AS removed,
       count(*) FILTER (WHERE a.k IS NOT NULL AND b.k IS NOT NULL)::BIGINT AS kept FROM a FULL JOIN b ON a.k = b.k GROUP BY 1""")
def feed_diff(t: Tables) -> DataFrame:
    """Added, removed and kept keys of two feeds, by source."""
    return reports.feed_diff(t.orders.filter("o_orderkey % 5 <> 0"), t.orders.filter("o_orderkey % 7 <> 0"), "o_orderkey", "o_orderstatus")


@query("""
SELECT n_name AS country, count(*)::BIGINT AS n, round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 2)::DOUBLE AS share
FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1 HAVING count(*) >= 10""")
def country_index(t: Tables) -> DataFrame:
    """Countries with enough rows; the share is of all that are listed."""
    g = t.customer.join(F.broadcast(t.nation), F.col("c_nationkey") == F.col("n_nationkey")).groupBy(F.col("n_name").alias("country")).agg(F.count("*").alias("n"))
    return reports.shares(g.filter("n >= 10"), "n", "share")
