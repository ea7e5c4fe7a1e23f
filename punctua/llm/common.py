"""What the training-data operators share: reading, null rules, word arrays, connected ids.

Null rules that hold for every operator unless its own docstring says otherwise: a null text has no words,
lines or characters; a null ``doc_id`` sorts after every other one; rows that repeat a ``doc_id`` are kept
apart by their text, and rows that repeat both get the same result each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Largest id: stands for a null ``doc_id`` in comparisons.
LAST_ID = 2**63 - 1
#: Bytes of text that one numpy step works on; a longer text is a step of its own.
STEP_BYTES = 1 << 20
#: White space of the word contracts: space and \t \n \v \f \r.
SPACE_BYTES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def row_key() -> dict[str, Column]:
    """Null-safe identity of a document row: its id (null last) and a hash of its text."""
    return {"k_id": F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)),
            "k_text": F.xxhash64(F.coalesce(F.col("text"), F.lit("")))}


def keyed(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id, text and ``more`` columns of ``docs`` with the row key; other columns stay behind."""
    return docs.select("doc_id", "text", *more).withColumns(row_key())


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def separators(*ranges: tuple[int, int]) -> np.ndarray:
    """Byte table, True where a byte separates words; ``ranges`` are inclusive."""
    table = np.zeros(256, bool)
    for a, b in ranges:
        table[a:b + 1] = True
    return table


SPACES = separators((0x09, 0x0D), (0x20, 0x20))
NOT_ALNUM = separators((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_powers = np.cumprod(np.full(1 << 10, _BASE, np.uint64))


def mix(h: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (the finaliser of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * _MIX1
    h = (h ^ (h >> np.uint64(27))) * _MIX2
    return h ^ (h >> np.uint64(31))


def pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of the ordered pair (a, b)."""
    return mix(a * _BASE + mix(b))


class Words:
    """Words of consecutive texts in one byte buffer: ``start``/``end`` (bytes), ``doc`` (index), ``hash``."""

    def __init__(self, data: np.ndarray, offs: np.ndarray, sep: np.ndarray, hashed: bool = True):
        global _powers
        self.data, self.offs = data, offs
        inside = ~sep[data]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        heads = offs[:-1][np.diff(offs) > 0]  # a text's first byte begins a word if it is in one
        first[heads] = inside[heads]
        tails = offs[1:][np.diff(offs) > 0] - 1
        last[tails] = inside[tails]
        self.start, self.end = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.doc = np.searchsorted(offs, self.start, "right") - 1
        self.first = np.searchsorted(self.doc, np.arange(len(offs)))  # word range of text i: first[i]:first[i + 1]
        if hashed:
            if len(self.start):
                longest = int((self.end - self.start).max())
                if longest > len(_powers):
                    _powers = np.cumprod(np.full(2 * longest, _BASE, np.uint64))
                head = np.zeros(len(data), np.int64)
                head[self.start] = self.start
                np.maximum.accumulate(head, out=head)
                at = np.arange(len(data)) - head
                value = np.where(inside, _BYTE[data], np.uint64(0))
                value *= _powers[np.minimum(at, len(_powers) - 1)]
                self.hash = mix(np.add.reduceat(value, self.start))
            else:
                self.hash = np.zeros(0, np.uint64)

    def __len__(self) -> int:
        return len(self.start)


def steps(texts: pa.Array, lower: bool = False) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of texts of about STEP_BYTES; a null text is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if not pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    n = len(texts)
    _, offsets, buf = texts.buffers()
    offs = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + n + 1] if n else np.zeros(1, np.int64)
    data = np.frombuffer(buf, np.uint8) if buf is not None and offs[-1] else np.zeros(0, np.uint8)
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(offs, offs[a] + STEP_BYTES, "right")) - 1)
        b = min(b, n)
        part = data[offs[a]:offs[b]]
        yield a, b, (LOWER[part] if lower else part), offs[a:b + 1] - offs[a]
        a = b


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the runs of ``n`` consecutive values of ``h`` (by doubling, so about log n passes)."""
    have, at, out, size = h, 0, None, 1
    while True:
        if n & size:
            piece = have[at:]
            out = piece if out is None else pair_hash(out[:len(piece)], piece)
            at += size
        size *= 2
        if size > n:
            break
        have = pair_hash(have[:len(have) - size // 2], have[size // 2:]) if len(have) > size // 2 else have[:0]
    return out[:max(0, len(h) - n + 1)]


def slots(df: DataFrame, group: str, bucket: Column, order: list[Column], name: str) -> DataFrame:
    """Number the rows of each ``group`` from 0 without gaps, in as many tasks as there are (group, bucket) pairs.

    Buckets are counted first; a window over the small table of counts gives each its first number, and a
    window inside each bucket the rest, so one group may hold any share of the rows.
    """
    from pyspark.sql import Window as W

    rows = df.withColumn("slot_bucket", bucket)
    counts = rows.groupBy(group, "slot_bucket").agg(F.count(F.lit(1)).alias("slot_n"))
    before = W.partitionBy(group).orderBy("slot_bucket").rowsBetween(W.unboundedPreceding, -1)
    base = counts.select(F.col(group).alias("slot_group"), F.col("slot_bucket").alias("slot_b"),
                         F.coalesce(F.sum("slot_n").over(before), F.lit(0)).alias("slot_base"))
    own = F.row_number().over(W.partitionBy(group, "slot_bucket").orderBy(*order)) - 1
    ranked = rows.withColumn("slot_own", own)
    joined = ranked.join(base, (F.col(group) == F.col("slot_group")) & (F.col("slot_bucket") == F.col("slot_b")))
    return (joined.withColumn(name, (F.col("slot_base") + F.col("slot_own")).cast("long"))
            .drop("slot_bucket", "slot_group", "slot_b", "slot_base", "slot_own"))
