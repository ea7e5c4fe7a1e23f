"""Column expressions used by the standardisation and ingestion layers.

All of them are plain built-in Spark expressions (JVM side, inside
whole-stage codegen); none calls back into Python per row.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Fixed values that must match the source system.
# Separator placed between the text form of each data column before hashing.
ROW_HASH_SEPARATOR = "||"
# File names carry year and month, e.g. VRA_2023_01.csv or vra-2023-1.csv.
FILENAME_PERIOD_PATTERN = r"(20\d{2})[_-]?(0?[1-9]|1[0-2])(?!\d)"
FILENAME_PERIOD_FALLBACK = "unparsed"
# Flight timestamps in the landing files.
FLIGHT_TS_FORMAT = "yyyy-MM-dd HH:mm:ss"
# Economic series dates.
SERIES_DATE_FORMAT = "dd/MM/yyyy"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sentinel_null(c: ColumnOrName, sentinel: str) -> Column:
    """Text sentinel (e.g. ``"null"``, ``"N/A"``) -> SQL NULL; other values unchanged."""
    return F.nullif(_col(c), F.lit(sentinel))


def flag_equals(c: ColumnOrName, value) -> Column:
    """Three-valued equality flag: NULL input stays NULL."""
    return _col(c) == F.lit(value)


def code_label(c: ColumnOrName, labels: Mapping[int, str]) -> Column:
    """Map an integer code to a label, falling back to the code's own text.

    The code is read with ``try_cast`` so that non-numeric text becomes NULL
    instead of failing the job under ANSI mode.
    """
    code = _col(c).try_cast("int")
    expr = None
    for k, label in labels.items():
        expr = (F.when(code == F.lit(k), F.lit(label)) if expr is None
                else expr.when(code == F.lit(k), F.lit(label)))
    fallback = code.cast("string")
    return fallback if expr is None else expr.otherwise(fallback)


def parse_timestamp(c: ColumnOrName, fmt: str = FLIGHT_TS_FORMAT) -> Column:
    """Text -> TIMESTAMP; unparsable text -> NULL (never an exception)."""
    return F.try_to_timestamp(_col(c), F.lit(fmt))


def parse_date(c: ColumnOrName, fmt: str = SERIES_DATE_FORMAT) -> Column:
    """Text -> DATE; impossible dates such as 31/02 -> NULL."""
    return F.try_to_date(_col(c), fmt)


def minutes_between(later: ColumnOrName, earlier: ColumnOrName) -> Column:
    """(epoch seconds(later) - epoch seconds(earlier)) / 60 as DOUBLE.

    Negative means early; NULL when either side is NULL.  Sub-second parts
    are floored first, as a cast of a timestamp to long does.
    """
    return (F.unix_seconds(_col(later)) - F.unix_seconds(_col(earlier))) / F.lit(60.0)


def row_hash(cols: Iterable[ColumnOrName], safe: bool = False) -> Column:
    """SHA-256 over the text form of the given columns joined by ``||``.

    ``concat_ws`` skips NULLs, so ('a', NULL, 'b') and ('a', 'b', NULL) hash
    alike; ``safe=True`` replaces NULL by U+0000 first to tell them apart.
    """
    parts = [_col(c).cast("string") for c in cols]
    if safe:
        parts = [F.coalesce(p, F.lit("\u0000")) for p in parts]
    return F.sha2(F.concat_ws(ROW_HASH_SEPARATOR, *parts), 256)


def filename_period(c: ColumnOrName) -> Column:
    """``YYYY/MM`` taken from the first year-month found in a file name, else ``unparsed``."""
    name = F.regexp_extract(_col(c), r"([^/]*)$", 1)
    year = F.regexp_extract(name, FILENAME_PERIOD_PATTERN, 1)
    month = F.regexp_extract(name, FILENAME_PERIOD_PATTERN, 2)
    return F.when(year == "", F.lit(FILENAME_PERIOD_FALLBACK)).otherwise(
        F.concat(year, F.lit("/"), F.lpad(month.cast("int").cast("string"), 2, "0")))


def local_to_utc(ts: ColumnOrName, zone: ColumnOrName) -> Column:
    """Wall-clock time in an IANA zone (column) -> UTC, honouring DST history."""
    return F.to_utc_timestamp(_col(ts), _col(zone))
