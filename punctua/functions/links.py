"""Link listing from HTML index pages, as Spark column expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Links that never lead anywhere new.
SKIPPED_HREFS = ("../", "./")
SKIPPED_PREFIXES = ("?", "#")
#: An anchor's href in any letter case, between either quotes or bare; group 1 has the quotes.
HREF_PATTERN = r"""(?i)<a\s(?:[^>]*?\s)?href\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
QUOTES = r"""^["']|["']$"""


def without_dot_segments(segments):
    """The path of ``segments`` (an array, the first one empty for a rooted path) with ``.`` and ``..`` taken out: a fold
    that drops the last kept segment at each ``..``, none above the root. A path that ends in either keeps its slash."""
    last = F.element_at(segments, -1)
    kept = F.aggregate(segments, F.array().cast("array<string>"), lambda acc, s: (
        F.when(s == ".", acc).when(s == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(1)))).otherwise(
            F.concat(acc, F.array(s)))))
    kept = F.when(last.isin(".", ".."), F.concat(kept, F.array(F.lit("")))).otherwise(kept)
    path = F.array_join(kept, "/")
    return F.when(path.startswith("/"), path).otherwise(F.concat(F.lit("/"), path))


def resolve_url(base, href):
    """Resolve ``href`` against the page URL ``base`` (scheme, authority, path).

    Covers absolute URLs, scheme-relative ``//host``, root-relative ``/path`` and paths relative to the base URL's directory,
    whose empty segments go. Dot segments are taken out of the latter two; query and fragment stay as written.
    """
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*):", 1)
    origin = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1)
    base_path = F.regexp_extract(base, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1)
    base_dir = F.regexp_extract(base_path, r"^(.*/)", 1)
    folder = F.split(F.when(base_dir == "", F.lit("/")).otherwise(base_dir), "/", -1)  # the last segment, empty, gives way
    path, rest = F.regexp_extract(href, r"^([^?#]*)", 1), F.regexp_extract(href, r"^[^?#]*(.*)$", 1)
    own = F.split(path, "/", -1)
    joined = F.concat(F.slice(folder, 1, F.size(folder) - 1), own)
    inner = F.filter(F.slice(joined, 2, F.size(joined) - 2), lambda s: s != "")
    relative = F.concat(F.slice(joined, 1, 1), inner, F.slice(joined, -1, 1))
    return (
        F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
        .when(href.startswith("/"), F.concat(origin, without_dot_segments(own), rest))
        .otherwise(F.concat(origin, without_dot_segments(relative), rest))
    )


def extract_links(pages: DataFrame, extension: str = ".csv", id_col: str = "page_id",
                  url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per usable ``href`` of each page: folder, file (by extension) or other.

    Runs per row inside the scan stage (no shuffle): ``regexp_extract_all`` +
    ``explode``; the whole HTML text of each page is searched.
    """
    hrefs = pages.select(
        F.col(id_col), F.col(url_col),
        F.posexplode(F.transform(F.regexp_extract_all(F.col(html_col), F.lit(HREF_PATTERN), 1),
                                 lambda x: F.regexp_replace(x, QUOTES, ""))).alias("link_pos", "href"),
    )
    href = F.col("href")
    skipped = href.isin(*SKIPPED_HREFS)
    for p in SKIPPED_PREFIXES:
        skipped = skipped | href.startswith(p)
    kind = (F.when(href.endswith("/"), F.lit("folder"))
            .when(F.lower(href).endswith(extension.lower()), F.lit("file"))
            .otherwise(F.lit("other")))
    return (hrefs.filter(~skipped)
            .select(id_col, F.col("link_pos").cast("bigint").alias("link_pos"), "href",
                    resolve_url(F.col(url_col), href).alias("link_url"), kind.alias("kind")))
