"""A recursive listing over ``pages``: each page, with its own HTML and links, also is a folder of an index site."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from punctua.operators.crawl import crawl, crawled_pages
from punctua.plans.registry import query
from punctua.tables import Tables

# Query parameters: where the site lies, how deep the listing goes, which pages are its roots.
SITE = "http://index.example.org/data"
MAX_DEPTH = 6
ROOT_EVERY = 200


def folder(i: Column) -> Column:
    """Path of page ``i`` below the site: one of seven folders, then its own."""
    return F.concat(F.lit("h"), (i % 7).cast("string"), F.lit("/p"), i.cast("string"), F.lit("/"))


def site(t: Tables) -> DataFrame:
    """``pages`` under the URLs of the site. Page i links to 2i + 1 and 2i + 2, back to its parent and, where 11 divides i, to
    3i + 5, in all forms of a link; it lists a file of its own and one that ten pages in a row share."""
    i = F.col("page_id")
    up, text = F.lit("../../"), lambda c: c.cast("string")
    links = [
        F.concat(F.lit('<a href="?C=N;O=D">Name</a><a href="../">up</a><a class="x" HREF=\''), up, folder(2 * i + 1), F.lit("'>")),
        F.concat(F.lit('<A HREF="'), F.lit("/data/x/.././"), folder(2 * i + 2), F.lit('">')),
        F.when(i > 0, F.concat(F.lit('<a href="./'), up, F.lit("/"), folder(F.floor((i - 1) / 2)), F.lit('">'))).otherwise(F.lit("")),
        F.when(i % 11 == 0, F.concat(F.lit("<a href=//index.example.org/data/"), folder(3 * i + 5), F.lit(">"))).otherwise(F.lit("")),
        F.concat(F.lit('<a href="f'), text(i), F.lit('.csv">')),
        F.concat(F.lit('<a href="../../../files/s'), text(F.floor(i / 10)), F.lit('.CSV">')),
    ]
    return t.pages.where("page_id is not null").select(
        F.concat(F.lit(SITE + "/"), folder(i), F.when(i % 3 == 0, F.lit("#top")).otherwise(F.lit(""))).alias("url"),
        F.concat(*links, F.coalesce("html", F.lit(""))).alias("html"), (i % ROOT_EVERY == 0).alias("is_root"))


_SITE_SQL = f"""
p AS (SELECT page_id AS i, '{SITE}/h' || page_id % 7 || '/p' || page_id || '/' AS url FROM pages),
e AS (SELECT i, 2 * i + 1 AS j FROM p UNION SELECT i, 2 * i + 2 FROM p UNION SELECT i, (i - 1) // 2 FROM p WHERE i > 0
      UNION SELECT i, 3 * i + 5 FROM p WHERE i % 11 = 0),
r AS (SELECT i, 0 AS depth FROM p WHERE i % {ROOT_EVERY} = 0
      UNION SELECT e.j, depth + 1 FROM r JOIN e ON e.i = r.i WHERE depth < {MAX_DEPTH}),
d AS (SELECT i, min(depth) AS depth FROM r GROUP BY 1)"""


@query("crawl_files", sql=f"""
WITH RECURSIVE {_SITE_SQL},
f AS (SELECT url || 'f' || i || '.csv' AS file_url, i FROM p
      UNION ALL SELECT 'http://index.example.org/files/s' || i // 10 || '.CSV', i FROM p)
SELECT file_url, CAST(min(depth) AS INTEGER) AS depth, CAST(count(*) AS BIGINT) AS pages FROM f JOIN d ON d.i = f.i GROUP BY 1
""")
def q_crawl_files(spark: SparkSession, sf_dir: str):
    """Files listed by the pages that are at most MAX_DEPTH links from a root."""
    pages = site(Tables(spark, sf_dir))
    return crawl(pages, pages.where("is_root"), max_depth=MAX_DEPTH)


@query("crawl_folders", sql=f"""
WITH RECURSIVE {_SITE_SQL}
SELECT '{SITE}/h' || d.i % 7 || '/p' || d.i || '/' AS url, CAST(depth AS INTEGER) AS depth, p.i IS NOT NULL AS found
FROM d LEFT JOIN p ON p.i = d.i
""")
def q_crawl_folders(spark: SparkSession, sf_dir: str):
    """Folders reached, also those without a page."""
    pages = site(Tables(spark, sf_dir))
    return crawled_pages(pages, pages.where("is_root"), max_depth=MAX_DEPTH)
