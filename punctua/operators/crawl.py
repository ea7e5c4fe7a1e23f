"""Breadth-first listing of files over a table of index pages.

The pages' links are taken out of their HTML once, into a narrow table. Every round joins the URLs found last with it, takes
those not seen before (an anti join on what earlier rounds wrote) and writes them; a round reads no page again. Rounds are
bounded by the depth limit, and cycles end because a URL is followed only at its smallest depth.

Rules: a link that ends with ``/`` is a folder and is followed while the depth limit allows, one that ends with the extension
(any letter case) is a file; ``../``, ``./``, ``?...`` and ``#...`` are not followed. Pages are known by their URL without
its fragment. A folder without a page is reached but lists nothing (``found`` is false).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctua.functions.links import extract_links
from punctua.session import materialize


def page_url(url: Column) -> Column:
    return F.regexp_replace(url, "#.*$", "")


def page_links(pages: DataFrame, extension: str = ".csv", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page, link, kind (``folder`` or ``file``) of every page, each link once."""
    named = pages.select(page_url(F.col(url_col)).alias("page"), F.col(url_col).alias("_base"), F.col(html_col).alias("_html"))
    links = extract_links(named, extension, "page", "_base", "_html").where("kind != 'other'")
    link = F.when(F.col("kind") == "folder", page_url(F.col("link_url"))).otherwise(F.col("link_url"))
    return links.select("page", link.alias("link"), "kind").distinct()


def reached(links: DataFrame, roots: DataFrame, max_depth: int, url_col: str = "url") -> DataFrame:
    """url, depth: the folders reached from ``roots`` over at most ``max_depth`` links, at their smallest depth.

    ``links``: page, link, kind (see :func:`page_links`), best written beforehand: every round joins it.
    """
    folders = links.where("kind = 'folder'")
    frontier = materialize(roots.select(page_url(F.col(url_col)).alias("url")).where("url is not null").distinct(), "crawl-0")
    seen, out = frontier, frontier.withColumn("depth", F.lit(0))
    for depth in range(1, max_depth + 1):
        step = frontier.join(folders, F.col("url") == F.col("page")).select(F.col("link").alias("url")).distinct()
        frontier = materialize(step.join(seen, "url", "left_anti"), f"crawl-{depth}")
        if frontier.isEmpty():
            break
        seen = seen.unionByName(frontier)
        out = out.unionByName(frontier.withColumn("depth", F.lit(depth)))
    return out


def crawl(pages: DataFrame, roots: DataFrame, extension: str = ".csv", max_depth: int = 6, url_col: str = "url",
          html_col: str = "html") -> DataFrame:
    """file_url, depth (of the nearest page that lists it) and pages (that do) of the files below ``roots``."""
    links = materialize(page_links(pages, extension, url_col, html_col), "page-links")
    folders = reached(links, roots, max_depth, url_col)
    files = links.where("kind = 'file'")
    return (folders.join(files, F.col("url") == F.col("page")).groupBy(F.col("link").alias("file_url"))
            .agg(F.min("depth").alias("depth"), F.count(F.lit(1)).alias("pages")))


def crawled_pages(pages: DataFrame, roots: DataFrame, extension: str = ".csv", max_depth: int = 6, url_col: str = "url",
                  html_col: str = "html") -> DataFrame:
    """url, depth, found (whether there is such a page) of the folders below ``roots``."""
    links = materialize(page_links(pages, extension, url_col, html_col), "page-links")
    there = pages.select(page_url(F.col(url_col)).alias("_there")).distinct()
    out = reached(links, roots, max_depth, url_col).join(there, F.col("url") == F.col("_there"), "left")
    return out.select("url", "depth", F.col("_there").isNotNull().alias("found"))
