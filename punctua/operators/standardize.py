"""Spec-driven typing and standardisation (bronze -> silver shape).

A :class:`StandardizeSpec` lists renames, drops, sentinels, parses, casts,
labels, flags and derived columns; :func:`standardize` turns it into a
single projection so the optimizer sees one ``Project`` (no chain of
``withColumn`` calls).  All parses/casts use ``try_*`` variants: under ANSI
mode a plain cast throws on bad text, which would kill the run instead of
sending the row to quarantine.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctua.functions.columns import code_label, flag_equals, parse_date, parse_timestamp, sentinel_null


@dataclass(frozen=True)
class StandardizeSpec:
    renames: Mapping[str, str] = field(default_factory=dict)      # old -> new, missing ignored
    drops: Sequence[str] = ()                                      # missing ignored
    sentinels: Mapping[str, str] = field(default_factory=dict)    # column -> text meaning NULL
    timestamps: Mapping[str, str | None] = field(default_factory=dict)  # column -> format (None: ISO cast)
    dates: Mapping[str, str] = field(default_factory=dict)        # column -> format
    casts: Mapping[str, str] = field(default_factory=dict)        # column -> type name
    labels: Mapping[str, tuple[str, Mapping[int, str]]] = field(default_factory=dict)  # new -> (code col, map)
    flags: Mapping[str, tuple[str, object]] = field(default_factory=dict)  # new -> (col, value)
    # new -> expression over standardised columns: a Column, a SQL string, or a
    # zero-argument callable returning a Column (lets specs live at module level)
    derived: Mapping[str, Column | str | Callable[[], Column]] = field(default_factory=dict)


def as_column(x) -> Column:
    if isinstance(x, str):
        return F.expr(x)
    if callable(x) and not isinstance(x, Column):
        return x()
    return x


def rename_present(df: DataFrame, renames: Mapping[str, str]) -> DataFrame:
    present = {k: v for k, v in renames.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df


def unify_layouts(df: DataFrame, variants: Mapping[str, Sequence[str]]) -> DataFrame:
    """Several historic names of one field -> one column (first non-NULL wins).

    Input is typically ``old.unionByName(new, allowMissingColumns=True)``;
    names absent from the frame are skipped, the variants are dropped.
    """
    exprs = {}
    drop = []
    for target, names in variants.items():
        present = [n for n in names if n in df.columns]
        if not present:
            exprs[target] = F.lit(None).cast("string")
            continue
        exprs[target] = F.coalesce(*[F.col(n) for n in present]) if len(present) > 1 else F.col(present[0])
        drop += [n for n in present if n != target]
    return df.withColumns(exprs).drop(*drop)


def standardize(df: DataFrame, spec: StandardizeSpec) -> DataFrame:
    df = rename_present(df, spec.renames)
    cols = [c for c in df.columns if c not in set(spec.drops)]
    exprs: dict[str, Column] = {c: F.col(c) for c in cols}
    for c, s in spec.sentinels.items():
        if c in exprs:
            exprs[c] = sentinel_null(exprs[c], s)
    for c, fmt in spec.timestamps.items():
        if c in exprs:
            exprs[c] = exprs[c].try_cast("timestamp") if fmt is None else parse_timestamp(exprs[c], fmt)
    for c, fmt in spec.dates.items():
        if c in exprs:
            exprs[c] = parse_date(exprs[c], fmt)
    for c, t in spec.casts.items():
        if c in exprs:
            exprs[c] = exprs[c].try_cast(t)
    out = df.select(*[e.alias(c) for c, e in exprs.items()])
    extra: dict[str, Column] = {}
    for new, (c, mapping) in spec.labels.items():
        extra[new] = code_label(c, mapping)
    for new, (c, value) in spec.flags.items():
        extra[new] = flag_equals(c, value)
    extra.update({k: as_column(v) for k, v in spec.derived.items()})
    return out.withColumns(extra) if extra else out
