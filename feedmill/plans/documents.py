"""Parsers over pages and over literal documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmill.functions import text as T
from feedmill.plans.registry import Tables, query, values
from feedmill.sources import parsers as P

_UNESCAPE = "{0}"
for _e, _c in T.ENTITIES:
    _q = _c.replace("'", "''")
    _UNESCAPE = f"replace({_UNESCAPE}, '{_e}', '{_q}')"


def _strip_sql(x: str) -> str:
    return "trim(regexp_replace(" + _UNESCAPE.format(f"regexp_replace({x}, '<[^>]+>', ' ', 'g')") + r", '\s+', ' ', 'g'))"


@query(f"SELECT page_id, {_strip_sql('regexp_extract(html, ' + chr(39) + '(?is)<title[^>]*>(.*?)</title>' + chr(39) + ', 1)')} AS title FROM pages")
def title_extract(t: Tables) -> DataFrame:
    return t.pages.select("page_id", P.title_of(F.col("html")).alias("title"))


@query(r"""
WITH a AS (SELECT page_id, unnest(regexp_extract_all(html, '(?is)<a\s[^>]*href="[^"]*"[^>]*>.*?</a>')) AS tag, generate_subscripts(regexp_extract_all(html, '(?is)<a\s[^>]*href="[^"]*"[^>]*>.*?</a>'), 1) - 1 AS place FROM pages)
SELECT page_id, place::INT AS place, regexp_extract(tag, '(?is)href="([^"]*)"', 1) AS href, """ + _strip_sql("tag") + " AS label FROM a")
def anchor_links(t: Tables) -> DataFrame:
    return P.anchors(t.pages.select("page_id", "html"))


@query("""
WITH a AS (SELECT page_id, unnest(regexp_extract_all(html, '(?is)<li[^>]*>(.*?)</li>', 1)) AS x, generate_subscripts(regexp_extract_all(html, '(?is)<li[^>]*>(.*?)</li>', 1), 1) - 1 AS place FROM pages)
SELECT page_id, place::INT AS place, """ + _strip_sql("x") + " AS item FROM a")
def list_items(t: Tables) -> DataFrame:
    return P.list_items(t.pages.select("page_id", "html"))


@query(f"SELECT page_id, md5({_strip_sql('html')}) AS h, length({_strip_sql('html')})::BIGINT AS n FROM pages")
def html_to_text(t: Tables) -> DataFrame:
    """Tags to spaces over whole pages."""
    plain = T.strip_tags(F.col("html"))
    return t.pages.select("page_id", F.md5(plain).alias("h"), F.length(plain).cast("bigint").alias("n"))


_BARE = "regexp_replace(html, '(?is)<script\\b.*?</script>|<style\\b.*?</style>|<!--.*?-->', ' ', 'g')"
_LINES = f"regexp_replace({_BARE}, '(?i)<br\\s*/?>|</(?:p|div|li|h[1-6]|tr|article|nav|footer)>', chr(10), 'g')"


@query("SELECT page_id, trim(regexp_replace(regexp_replace(" + _UNESCAPE.replace("{0}", f"regexp_replace({_LINES}, '<[^>]+>', ' ', 'g')") + r", '[ \t]+', ' ', 'g'), ' ?\n[ \n]*', chr(10), 'g'), ' ') AS text FROM pages")
def readable_text(t: Tables) -> DataFrame:
    """Page text without scripts, blocks on lines."""
    return t.pages.select("page_id", T.html_text(F.col("html")).alias("text"))


MAPS = [
    ("root", "<sitemapindex><sitemap><loc>a</loc></sitemap><sitemap><loc> b </loc></sitemap></sitemapindex>"), ("a", "<urlset><url><loc>p1</loc></url><url><loc>p2</loc></url></urlset>"),
    ("b", "<sitemapindex><sitemap><loc>c</loc></sitemap></sitemapindex>"), ("c", "<urlset><url><loc>p3</loc></url><url><loc>p1</loc></url></urlset>"), ("d", "<urlset><url><loc>p9</loc></url></urlset>"),
]


@query(f"""
WITH RECURSIVE m AS (SELECT loc, contains(xml, '<sitemapindex') AS idx, unnest(regexp_extract_all(xml, '<loc>\\s*(.*?)\\s*</loc>', 1)) AS child FROM {values(MAPS, 'loc, xml')}),
w AS (SELECT 'root' AS loc UNION SELECT m.child FROM w JOIN m ON m.loc = w.loc WHERE m.idx) SELECT DISTINCT m.child AS loc FROM w JOIN m ON m.loc = w.loc WHERE NOT m.idx""")
def sitemap_walk(t: Tables) -> DataFrame:
    return P.sitemap_walk(t.inline(MAPS, "loc string, xml string"), "root")
