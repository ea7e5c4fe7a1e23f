"""Keyed upsert (MERGE semantics) and versioned table writes on plain parquet.

``upsert(target, source, keys)``: every source row replaces the target row
with the same key or is inserted; target rows without a source match stay.
Expressed as ``target LEFT ANTI source UNION source`` — one shuffle of each
side on the keys (or a broadcast of the source when the planner measures it
small, the usual case for an increment).  Like MERGE, duplicate keys in the
source are an error: a count over the source keys fails the query inside
the plan (no driver round trip).

Persisting: parquet has no atomic replace, so each write goes to a new
``v=<n>`` directory and readers take the highest version that committed
(Spark's ``_SUCCESS`` marker).  A crashed write is never visible, and a
re-run simply writes the next version.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def check_unique_keys(df: DataFrame, keys: Sequence[str], what: str = "source") -> DataFrame:
    """Pass rows through; raise at execution if a key occurs twice (a key with a NULL equals no other)."""
    given = F.lit(True)
    for k in keys:
        given = given & F.col(k).isNotNull()
    n = F.when(given, F.count(F.lit(1)).over(Window.partitionBy(*keys)))
    msg = F.lit(f"duplicate keys in {what} of upsert on {list(keys)}")
    return (df.withColumn("_dup_n", n)
            .filter(F.when(F.col("_dup_n") > 1, F.raise_error(msg).cast("boolean")).otherwise(F.lit(True)))
            .drop("_dup_n"))


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], check_unique: bool = True) -> DataFrame:
    keys = list(keys)
    src = check_unique_keys(source, keys) if check_unique else source
    src = src.select(*target.columns)
    kept = target.join(source.select(*keys), keys, "left_anti")
    return kept.unionByName(src)


def upsert_sql(spark: SparkSession, target_view: str, source_view: str, keys: Sequence[str]) -> DataFrame:
    """The same upsert in SQL over registered temp views (MERGE without a row-level catalog), by the same rules:
    NULL keys match nothing, a key that the source has twice is an error."""
    cond = " AND ".join(f"t.`{k}` = s.`{k}`" for k in keys)
    cols = ", ".join(f"`{c}`" for c in spark.table(target_view).columns)
    by = ", ".join(f"`{k}`" for k in keys)
    given = " AND ".join(f"`{k}` IS NOT NULL" for k in keys)
    return spark.sql(f"""
        SELECT {cols} FROM {target_view} t WHERE NOT EXISTS (SELECT 1 FROM {source_view} s WHERE {cond})
        UNION ALL
        SELECT {cols} FROM (SELECT *, count(1) OVER (PARTITION BY {by}) AS _dup_n FROM {source_view} WHERE {given})
        WHERE CASE WHEN _dup_n > 1 THEN CAST(raise_error('duplicate keys in source of upsert on {by}') AS BOOLEAN)
                   ELSE true END
        UNION ALL
        SELECT {cols} FROM {source_view} WHERE NOT ({given})""")


def empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """``CREATE TABLE IF NOT EXISTS`` stand-in: an empty frame with the declared schema."""
    return spark.createDataFrame([], schema)


# --------------------------------------------------------------------------- versioned tables
def _fs(spark: SparkSession, root: str):
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path, jvm


def committed_versions(spark: SparkSession, root: str) -> list[int]:
    fs, path, jvm = _fs(spark, root)
    if not fs.exists(path):
        return []
    out = []
    for st in fs.listStatus(path):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("v="):
            if fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
                out.append(int(name[2:]))
    return sorted(out)


def read_table(spark: SparkSession, root: str, schema: T.StructType | None = None) -> DataFrame | None:
    """Latest committed version, or an empty frame of ``schema`` (None if no schema)."""
    versions = committed_versions(spark, root)
    if not versions:
        return empty_table(spark, schema) if schema is not None else None
    return spark.read.parquet(f"{root.rstrip('/')}/v={versions[-1]}")


def write_table(df: DataFrame, root: str, partition_by: Sequence[str] = ()) -> int:
    spark = df.sparkSession
    versions = committed_versions(spark, root)
    nxt = (versions[-1] + 1) if versions else 0
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(f"{root.rstrip('/')}/v={nxt}")
    return nxt


def upsert_table(spark: SparkSession, root: str, source: DataFrame, keys: Sequence[str],
                 schema: T.StructType | None = None) -> int:
    """Read latest version, upsert, write the next version (old version stays readable)."""
    current = read_table(spark, root, schema or source.schema)
    return write_table(upsert(current, source, keys), root)
