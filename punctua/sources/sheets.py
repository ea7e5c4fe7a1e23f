"""Spreadsheet-like CSV exports (e.g. an annual fuel-price table per town):
multi-row headers with merged cells, one column per year, numbers written
with a decimal comma, thousands dots and currency text.

:func:`read_wide_sheet` learns the header from the first ``header_rows``
lines of each file (driver reads only those lines), then parses every data
line in Spark and returns the table in *long* form — one row per id and
value column — with the numbers cleaned.  No row is held on the driver.
"""

from __future__ import annotations

import csv
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctua.sources import hadoopfs as hfs
from punctua.sources.ingest import BOM, drop_first
from punctua.sources.naming import sanitize_name


def combine_header_rows(rows: list[list[str]]) -> list[str]:
    """Join stacked header rows into one name per column.

    A blank cell in an upper row belongs to the merged cell on its left
    (carried right); blank parts are skipped; names are sanitised.
    """
    width = max(len(r) for r in rows)
    filled = []
    for r in rows[:-1]:
        out, last = [], ""
        for i in range(width):
            v = r[i].strip() if i < len(r) else ""
            last = v or last
            out.append(last)
        filled.append(out)
    last_row = [(rows[-1][i].strip() if i < len(rows[-1]) else "") for i in range(width)]
    names = []
    for i in range(width):
        parts = [row[i] for row in filled] + [last_row[i]]
        parts = [p for j, p in enumerate(parts) if p and p not in parts[:j]]
        names.append("_".join(sanitize_name(p) for p in parts) or f"col_{i}")
    return names


def clean_number(c):
    """'R$ 1.234,56' -> 1234.56; text without digits -> NULL."""
    txt = F.regexp_replace(c, r"[^0-9,.\-]", "")
    txt = F.regexp_replace(txt, r"\.(?=\d{3}(\D|$))", "")     # thousands dots
    return F.regexp_replace(txt, ",", ".").try_cast("double")


def read_wide_sheet(spark: SparkSession, path: str, header_rows: int, id_cols: int, sep: str = ";",
                    encoding: str = "UTF-8") -> DataFrame:
    """Long table of all sheets under ``path``: id columns, ``column``, ``raw``, ``value``.

    Files are grouped by their own header, so a file's values stand under its own names; an id column that a
    layout lacks is NULL. Header lines are dropped by their place in the file."""
    layouts: dict[tuple[str, ...], list[str]] = {}
    for f in hfs.list_files(spark, path, "*"):
        head = hfs.head_lines(spark, f.path, header_rows, encoding)
        if len(head) == header_rows:  # a shorter file has no data
            rows = [next(csv.reader([line.lstrip(BOM)], delimiter=sep), []) for line in head]
            layouts.setdefault(tuple(combine_header_rows(rows)), []).append(f.path)
    if not layouts:
        raise FileNotFoundError(path)

    def long(names: tuple[str, ...], paths: list[str]) -> DataFrame:
        lines = drop_first(spark.read.text(paths).select("value", "_metadata"), header_rows, encoding)
        schema = ", ".join(f"`{n}` string" for n in names)
        parsed = (lines.filter(F.length(F.trim("value")) > 0)
                  .select(F.from_csv("value", schema, {"sep": sep}).alias("r")).select("r.*"))
        return parsed.unpivot(list(names[:id_cols]), list(names[id_cols:]), "column", "raw")

    frames = [long(names, paths) for names, paths in layouts.items()]
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return out.withColumn("value", clean_number(F.col("raw")))
