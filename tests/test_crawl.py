"""Link resolution against the standard library, and listings against a recursive walk."""

from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from punctua.functions.links import resolve_url
from punctua.operators.crawl import crawl, crawled_pages

BASES = ["http://h.org/a/b/c.html", "http://h.org/a/b/", "http://h.org", "http://h.org/", "https://h.org:8080/x/y?q=1/2#f/g", "http://h.org/a"]
HREFS = ["x/", "./x/", "../x/", "../../x", "../../../../x/y/", "/x/../y/./z/", "/..", "/.", "..", ".", "../..", "x/./y/../z.csv", "x//y/",
         "//other.org/p/", "https://o.org/a/../b/", "x?d=../e", "../x#a/../b", "/a/b/../../../c/", "a/b/c/../../..", "x/..", "./", "/",
         "mailto:a@b.c", "ü/é/", "a b/c.csv", "...", "..x/", ".x", "x/.../y"]


def test_resolution_is_that_of_the_standard_library(spark):
    rows = [(b, h) for b in BASES for h in HREFS]
    df = spark.createDataFrame(rows, "b string, h string")
    got = {(r["b"], r["h"]): r["u"] for r in df.select("b", "h", resolve_url(F.col("b"), F.col("h")).alias("u")).collect()}
    assert got == {(b, h): urljoin(b, h) for b, h in rows}


def page(url, *hrefs):
    return (url, "".join(f'<li><a href="{h}">x</a>' for h in hrefs))


PAGES = [
    page("http://h/i/", "2020/", "2021/", "top.csv", "../", "./", "?x/", "#y/", "notes.txt"),
    page("http://h/i/2020/", "../2021/", "./../2020/", "a.CSV", "/i/2020/01/", "a.CSV"),
    page("http://h/i/2021/#frag", "../../i/", "b.csv", "gone/", "../2020/a.CSV"),
    page("http://h/i/2020/01/", "02/", "c.csv"),
    page("http://h/i/2020/01/02/", "03/", "d.csv"),
    page("http://h/i/2020/01/02/03/", "e.csv"),
    page("http://h/j/", "k.csv"),
    (None, "<a href='z/'>"), ("http://h/n/", None),
]


def walk(pages, url, depth, out, seen):
    """The listing as a plain recursion over pages, without any record of visits but the path's depth."""
    html = pages.get(url)
    seen[url] = min(seen.get(url, 99), depth)
    if html is None or depth > 10:
        return
    for h in html:
        if h in ("../", "./") or h[0] in "?#":
            continue
        full = urljoin(url, h)
        if h.endswith("/"):
            if depth < walk.limit:
                walk(pages, full, depth + 1, out, seen)
        elif h.lower().endswith(".csv"):
            out.setdefault(full, {})[url] = min(out.get(full, {}).get(url, 99), depth)


@pytest.mark.parametrize("limit", [0, 1, 2, 4, 6])
def test_listing_against_recursion(spark, limit):
    import re

    df = spark.createDataFrame(PAGES, "url string, html string")
    roots = spark.createDataFrame([("http://h/i/#start",), ("http://h/i/",), (None,)], "url string")
    plain = {u.split("#")[0]: re.findall('href="([^"]*)"', h) for u, h in PAGES if u and h}
    walk.limit, out, seen = limit, {}, {}
    walk(plain, "http://h/i/", 0, out, seen)
    got = {r["file_url"]: (r["depth"], r["pages"]) for r in crawl(df, roots, max_depth=limit).collect()}
    assert got == {f: (min(v.values()), len(v)) for f, v in out.items()}
    folders = {r["url"]: (r["depth"], r["found"]) for r in crawled_pages(df, roots, max_depth=limit).collect()}
    assert folders == {u: (d, u in plain) for u, d in seen.items()}


def test_no_pages(spark):
    df = spark.createDataFrame([], "url string, html string")
    assert crawl(df, df).count() == 0
