"""Search, pages, lookups, profiles and totals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmill.functions import money as M
from feedmill.functions import text as T
from feedmill.operators import reports, serve
from feedmill.plans.registry import Tables, query


@query("""SELECT doc_id, text ILIKE '%intern%' OR text ILIKE '%the and%' AS flag_a, NOT (text ILIKE '%license%' OR text ILIKE '%click here%') AS flag_b FROM documents""")
def ilike_any_flags(t: Tables) -> DataFrame:
    """Lists of patterns, any and none."""
    any_of = F.expr("text ILIKE ANY ('%intern%', '%the and%')")
    none_of = ~F.expr("text ILIKE ANY ('%license%', '%click here%')")
    return t.documents.select("doc_id", any_of.alias("flag_a"), none_of.alias("flag_b"))


@query("""SELECT doc_id FROM documents WHERE source IN ('src1', 'src2', 'src3') AND lower(lang) = 'en' AND contains(lower(text || ' ' || source), 'the') AND contains(lower(text || ' ' || source), 'src') AND n_chars >= 300""")
def search_filters(t: Tables) -> DataFrame:
    """Words over joined fields, a set, an exact value and a floor, in one filter."""
    return t.documents.filter(
        F.col("source").isin(serve.csv_set("src1, SRC2,src3")) & (F.lower("lang") == "en") & serve.text_match("the SRC", ["text", "source"]) & (F.col("n_chars") >= 300)
    ).select("doc_id")


@query("""SELECT doc_id FROM documents WHERE contains(lower(text || ' ' || lang), 'that') AND contains(lower(text || ' ' || lang), 'with')""")
def search_text_and(t: Tables) -> DataFrame:
    return t.documents.filter(serve.text_match("that with", ["text", "lang"])).select("doc_id")


@query("""SELECT o_orderkey, o_orderdate FROM orders WHERE o_totalprice > 100000 ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 25 OFFSET 50""")
def page_offset(t: Tables) -> DataFrame:
    """Newest first with the id as tie-break; a page by offset."""
    page, _ = serve.page(t.orders.filter("o_totalprice > 100000").select("o_orderkey", "o_orderdate"), serve.newest(F.col("o_orderdate"), F.col("o_orderkey")), 25, 50)
    return page


@query("""SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey = 77 OR o_custkey = 77 ORDER BY o_orderkey LIMIT 1""")
def point_lookup(t: Tables) -> DataFrame:
    """First row by id or by link."""
    return t.orders.filter("o_orderkey = 77 or o_custkey = 77").orderBy("o_orderkey").limit(1).select("o_orderkey", "o_custkey", "o_totalprice")


@query("SELECT source, count(*)::BIGINT AS n FROM documents GROUP BY 1")
def count_by(t: Tables) -> DataFrame:
    return t.documents.groupBy("source").agg(F.count("*").alias("n"))


@query("SELECT lang, n FROM (SELECT lang, count(*)::BIGINT AS n, min(doc_id) AS o FROM documents GROUP BY 1) ORDER BY n DESC, o LIMIT 3")
def topn_by_count(t: Tables) -> DataFrame:
    """Commonest values, ties in order of first occurrence."""
    return serve.top_n(t.documents, "lang", 3, "doc_id")


@query("""
SELECT o_custkey, count(*)::BIGINT AS total, round(avg(CASE WHEN o_orderpriority = '1-URGENT' THEN 1.0 ELSE 0.0 END)::DOUBLE, 3)::DOUBLE AS urgent_share,
  min(o_orderdate) AS oldest, max(o_orderdate) AS newest, count(*) FILTER (WHERE o_totalprice > 200000)::BIGINT AS disclosed,
  count(DISTINCT o_orderstatus)::BIGINT AS kinds FROM orders GROUP BY 1""")
def company_profile(t: Tables) -> DataFrame:
    """Several measures of every employer in one aggregation."""
    return t.orders.groupBy("o_custkey").agg(
        F.count("*").alias("total"), F.round(F.avg((F.col("o_orderpriority") == "1-URGENT").cast("double")), 3).alias("urgent_share"),
        F.min("o_orderdate").alias("oldest"), F.max("o_orderdate").alias("newest"), F.count_if(F.col("o_totalprice") > 200000).alias("disclosed"),
        F.countDistinct("o_orderstatus").alias("kinds"),
    )


@query("""
SELECT 'status' AS dim, o_orderstatus AS value, count(*)::BIGINT AS n FROM orders GROUP BY 2
UNION ALL SELECT 'priority', o_orderpriority, count(*)::BIGINT FROM orders GROUP BY 2 UNION ALL SELECT 'all', NULL, count(*)::BIGINT FROM orders""")
def feed_stats(t: Tables) -> DataFrame:
    """Counts of several dimensions and of everything, by grouping sets in one pass."""
    t.orders.createOrReplaceTempView("_feed_orders")
    return t.orders.sparkSession.sql(
        """SELECT CASE grouping_id() WHEN 1 THEN 'status' WHEN 2 THEN 'priority' ELSE 'all' END AS dim,
        coalesce(o_orderstatus, o_orderpriority) AS value, count(*) AS n FROM _feed_orders
        GROUP BY GROUPING SETS ((o_orderstatus), (o_orderpriority), ())"""
    )


@query("""
SELECT c_mktsegment, count(*) FILTER (WHERE c_acctbal > 0)::BIGINT AS positive, round(100.0::DOUBLE * count(*) FILTER (WHERE c_acctbal > 0) / count(*), 2)::DOUBLE AS pct,
  round(avg(c_acctbal), 2)::DOUBLE AS mean FROM customer GROUP BY 1""")
def conditional_shares(t: Tables) -> DataFrame:
    return t.customer.groupBy("c_mktsegment").agg(
        F.count_if(F.col("c_acctbal") > 0).alias("positive"), F.round(100.0 * F.count_if(F.col("c_acctbal") > 0) / F.count("*"), 2).alias("pct"), F.round(F.avg("c_acctbal"), 2).alias("mean")
    )


@query("""
SELECT o_custkey, n FROM (SELECT o_custkey, count(*)::BIGINT AS n FROM orders GROUP BY 1) ORDER BY n DESC, o_custkey LIMIT 300""")
def top_companies(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_custkey").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "o_custkey").limit(300)


@query("""SELECT s_suppkey, s_name, s_name LIKE '%7%' AS preferred FROM supplier ORDER BY s_name LIKE '%7%' DESC, s_suppkey LIMIT 30""")
def preferred_first(t: Tables) -> DataFrame:
    hit = F.col("s_name").like("%7%")
    return t.supplier.select("s_suppkey", "s_name", hit.alias("preferred")).orderBy(hit.desc(), "s_suppkey").limit(30)


@query("""
SELECT o_orderkey, substr(strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'), 1, 10) AS date, o_orderstatus IN ('F') AS is_remote, CASE WHEN o_totalprice > 150000 THEN o_totalprice END AS salary_max
FROM orders""")
def brief_projection(t: Tables) -> DataFrame:
    """Optional keys are null where they say nothing."""
    return t.orders.select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), M.truthy(F.when(F.col("o_orderstatus") == "F", "Yes").otherwise("no")).alias("is_remote"),
        F.when(F.col("o_totalprice") > 150000, F.col("o_totalprice")).alias("salary_max"),
    )


_LEVELS = ", ".join(f"'{w}'" for w in T.LEVEL_WORDS)


@query(f"""
WITH r AS (SELECT p_partkey AS row_id, p_brand AS k, list_distinct(list_filter(regexp_extract_all(lower(p_name), '[a-z0-9]+'), lambda x: len(x) > 1 AND x NOT IN ({_LEVELS}))) AS rt FROM part WHERE p_size <= 10),
t AS (SELECT p_brand AS k, p_name AS title, count(*)::BIGINT AS n, min(p_partkey) AS ord, any_value(list_distinct(list_filter(regexp_extract_all(lower(p_name), '[a-z0-9]+'), lambda x: len(x) > 1 AND x NOT IN ({_LEVELS})))) AS tt FROM part WHERE p_size > 10 GROUP BY 1, 2),
b AS (SELECT row_id, title, n, ord, rt, tt, len(list_filter(rt, lambda a: len(list_filter(tt, lambda b: a = b OR (len(a) >= 5 AND len(b) >= 5 AND a[1:5] = b[1:5]))) > 0)) AS s FROM r JOIN t USING (k))
SELECT row_id, title, n, score FROM (SELECT row_id, title, n, round(s::DOUBLE / len(rt), 4)::DOUBLE AS score, row_number() OVER (PARTITION BY row_id ORDER BY s::DOUBLE / len(rt) DESC, n DESC, ord) rn
  FROM b WHERE len(rt) > 0 AND len(tt) > 0 AND ((s::DOUBLE / len(rt) >= 0.6 AND s >= 2) OR list_sort(rt) = list_sort(tt))) WHERE rn = 1""")
def fuzzy_title_best(t: Tables) -> DataFrame:
    """Best title of the same employer by shared words."""
    rows = t.part.filter("p_size <= 10").select(F.col("p_partkey").alias("row_id"), F.col("p_brand").alias("k"), F.col("p_name").alias("role"))
    titles = t.part.filter("p_size > 10").groupBy(F.col("p_brand").alias("k"), F.col("p_name").alias("title")).agg(F.count("*").alias("n"), F.min("p_partkey").alias("ord"))
    return reports.best_title(rows, titles, "k")
