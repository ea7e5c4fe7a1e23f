"""Schema contracts between layers: compare a frame's schema with the
declared one (names, types, nullability) without touching the data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def schema_violations(df: DataFrame, expected: T.StructType, allow_extra: bool = True,
                      check_nullable: bool = False) -> list[str]:
    have = {f.name: f for f in df.schema.fields}
    out = []
    for f in expected.fields:
        g = have.get(f.name)
        if g is None:
            out.append(f"missing column {f.name}")
        elif g.dataType != f.dataType:
            out.append(f"column {f.name}: type {g.dataType.simpleString()} != {f.dataType.simpleString()}")
        elif check_nullable and g.nullable and not f.nullable:
            out.append(f"column {f.name}: nullable but declared NOT NULL")
    if not allow_extra:
        names = {f.name for f in expected.fields}
        out += [f"unexpected column {c}" for c in df.columns if c not in names]
    return out


def enforce_contract(df: DataFrame, expected: T.StructType, allow_extra: bool = True) -> DataFrame:
    problems = schema_violations(df, expected, allow_extra)
    if problems:
        raise ValueError("schema contract violated: " + "; ".join(problems))
    return df


def _differences(df: DataFrame, expected: T.StructType) -> list[tuple[str, str, str | None, str | None, Column]]:
    """(column, problem, expected, actual, whether a row breaks the contract there)."""
    have = {f.name: f for f in df.schema.fields}
    names = {f.name for f in expected.fields}
    out = []
    for f in expected.fields:
        want, got = f.dataType.simpleString(), have.get(f.name)
        if got is None:
            out.append((f.name, "missing", want, None, F.lit(True)))
            continue
        c = F.col(f"`{f.name}`")
        if got.dataType != f.dataType:
            out.append((f.name, "type", want, got.dataType.simpleString(), c.isNotNull() & c.try_cast(f.dataType).isNull()))
        if not f.nullable:
            out.append((f.name, "null", "not null", "nullable" if got.nullable else "not null", c.isNull()))
    return out + [(c, "extra", None, have[c].dataType.simpleString(), F.lit(False)) for c in df.columns if c not in names]


def contract_report(df: DataFrame, expected: T.StructType) -> DataFrame:
    """column, problem, expected, actual, bad_rows: where ``df`` differs from the contract, and in how many rows it matters.

    ``missing`` columns are bad in all rows, a retyped one (``type``) where its value does not cast, a NOT NULL one (``null``)
    where it is NULL, ``extra`` ones nowhere. One aggregate over the data; the report itself is as long as the contract.
    """
    found = _differences(df, expected)
    kind = "array<struct<column:string,problem:string,expected:string,actual:string,bad_rows:bigint>>"
    wide = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(bad).alias(f"_b{i}") for i, (*_, bad) in enumerate(found)])
    names = ("column", "problem", "expected", "actual")
    rows = F.array(*[F.struct(*[F.lit(v).cast("string").alias(n) for n, v in zip(names, d)], F.col(f"_b{i}").alias("bad_rows"))
                     for i, d in enumerate(found)]).cast(kind)
    return wide.select(F.inline(rows))


def conformed(df: DataFrame, expected: T.StructType, fail: bool = False) -> DataFrame:
    """``df`` with the contract's columns, in its order and types, others left out.

    A row that breaks the contract is dropped or, with ``fail``, ends the job from inside the plan: nothing is collected
    beforehand, and what is read once is checked as it passes.
    """
    found = _differences(df, expected)
    broken = F.concat_ws(", ", *[F.when(bad, F.lit(f"{problem} {name}")) for name, problem, _, _, bad in found])
    if fail:
        df = df.where(F.when(broken == "", True).otherwise(F.raise_error(F.concat(F.lit("contract violated: "), broken)).cast("boolean")))
    else:
        df = df.where(broken == "")
    have = set(df.columns)
    return df.select(*[(F.col(f"`{f.name}`").try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
                       for f in expected.fields])
