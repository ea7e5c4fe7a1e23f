"""Sharding by rendezvous hashing of stable record keys over weighted shards.

Every (key, shard) pair gets a hash; a row goes to the shard whose weighted score is largest. A shard that
is added takes rows only into itself, and one that is removed gives its rows to the others: no other row moves.

Defined cases: a null text has no bytes and checksum 0; a null ``doc_id`` is a key of its own, rows that repeat
a ``doc_id`` share a shard and get different slots; an empty table gives no rows; columns beside ``doc_id`` and
``text`` are ignored by the query and carried along by :func:`assign`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from punctua.llm.catalog import query
from punctua.llm.common import read, slots

#: Rows that one task numbers, about.
ROWS_PER_BUCKET = 100_000


def shard_of(keys: list[str], weights: dict[int, float]) -> Column:
    """The shard of the row with the given key columns: largest -weight / ln(u), u uniform in (0, 1) by (key, shard).

    With equal weights the order of the scores is that of the hashes, which are then compared as they are.
    """
    if not weights or min(weights.values()) <= 0:
        raise ValueError("weights must be positive")
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\u0000null")) for c in keys]
    equal = len(set(weights.values())) == 1
    scores = []
    for shard, weight in sorted(weights.items()):
        h = F.xxhash64(*parts, F.lit(shard).cast("int"))
        # 53 bits of the hash as a double strictly between 0 and 1
        u = (F.shiftrightunsigned(h, 11).cast("double") + 0.5) / F.lit(float(1 << 53))
        scores.append(F.struct((h if equal else F.lit(-float(weight)) / F.log(u)).alias("score"),
                               F.lit(-shard).alias("tie")))
    return -(F.greatest(*scores)["tie"] if len(scores) > 1 else scores[0]["tie"])


def assign(df: DataFrame, keys: list[str], weights: dict[int, float], name: str = "shard") -> DataFrame:
    """``df`` with the shard of every row in column ``name``; no shuffle."""
    return df.withColumn(name, shard_of(keys, weights))


def write_shards(df: DataFrame, keys: list[str], weights: dict[int, float], path: str) -> None:
    """Write the rows of ``df`` as parquet, one folder per shard."""
    assign(df, keys, weights, "shard").write.partitionBy("shard").parquet(path)


@query("op5_sharding")
def op5_sharding(spark: SparkSession, sf_dir: str, shards: int = 16) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("key").alias("law"))
    rows = assign(rows, ["doc_id"], {s: 1.0 for s in range(shards)}, "shard")
    rows = assign(rows, ["doc_id"], {s: 1.0 for s in range(shards + 1)}, "grown_shard")
    n = docs.count()
    buckets = max(1, -(-n // (shards * ROWS_PER_BUCKET)))
    bucket = F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.lit(buckets))
    return slots(rows, "shard", bucket, [F.col("doc_id"), F.col("text_crc32"), F.col("size")], "slot")
