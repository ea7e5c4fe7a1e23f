"""Benchmark decontamination by a prefix-filtered set join.

A window is ``width`` consecutive words of a benchmark item (a shorter item is one window); a document word is hit
if it lies in an occurrence of a window. A window is seen as the set of its shingles (3 words, fewer in shorter
windows). Containment asks for every shingle, so the necessary prefix of a window, with its shingles ordered by
rarity in the corpus, is the rarest one. The join looks for that shingle only; its place in the window and in the
document gives the one place where the window can begin (positional bound), which must leave room for the
whole window inside the document (length bound); then the words themselves are compared.

The benchmark's windows travel to the tasks in blocks of distinct items: one block up to ``block_bytes`` of item text,
measured before, else blocks by hash that hold half of that on average, with an item always whole. A larger benchmark
takes one pass over the documents for each block. Documents are never shuffled for one block.

Defined cases: null texts have no words; an item without words has no window; items that repeat an ``item_id`` or a
text are counted by distinct ``item_id`` (a null id is never listed); repeated document rows get the same result
each; an empty benchmark hits nothing; columns beside the ids and texts are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punctua.llm.catalog import query
from punctua.llm.common import NOT_ALNUM, Words, grams, keyed, read, row_key, steps
from punctua.session import materialize

SHINGLE = 3
#: Bytes of item text that go in one broadcast block (about 40 times that in a task's memory at worst).
BLOCK_BYTES = 4 << 20
_TABLE = 1 << 18


def item_words(texts: list[str | None]) -> list[tuple[list[bytes], np.ndarray]]:
    """Words and their hashes of each item."""
    out = []
    for _, _, data, offs in steps(pa.array(texts, pa.large_string()), lower=True):
        w, raw = Words(data, offs, NOT_ALNUM), data.tobytes()
        for i in range(len(offs) - 1):
            at = slice(w.first[i], w.first[i + 1])
            out.append(([raw[a:b] for a, b in zip(w.start[at], w.end[at])], w.hash[at]))
    return out


class Windows:
    """The distinct windows of a block of items."""

    def __init__(self, items: list[tuple[object, str | None]], width: int):
        self.words: list[list[bytes]] = []
        self.hashes: list[np.ndarray] = []
        self.items: list[list[str]] = []
        number: dict[tuple[bytes, ...], int] = {}
        for (item, _), (words, hashes) in zip(items, item_words([t for _, t in items])):
            n = min(width, len(words))
            for i in range(len(words) - n + 1 if n else 0):
                key = tuple(words[i:i + n])
                k = number.setdefault(key, len(number))
                if k == len(self.words):
                    self.words.append(list(key))
                    self.hashes.append(hashes[i:i + n])
                    self.items.append([])
                if item is not None and str(item) not in self.items[k]:
                    self.items[k].append(str(item))
        self.shingles: dict[int, np.ndarray] = {}  # by shingle width: sorted distinct hashes
        found = defaultdict(list)
        for h in self.hashes:
            s = min(SHINGLE, len(h))
            found[s].append(grams(h, s))
        self.shingles = {s: np.unique(np.concatenate(g)) for s, g in found.items()}

    def prefixes(self, counts: dict[tuple[int, int], int]) -> dict[int, dict[int, list[tuple[int, int]]]]:
        """By shingle width: rarest shingle of each window -> (window, place in the window)."""
        out: dict[int, dict[int, list[tuple[int, int]]]] = defaultdict(lambda: defaultdict(list))
        for k, h in enumerate(self.hashes):
            s = min(SHINGLE, len(h))
            g = grams(h, s).tolist()
            place = min(range(len(g)), key=lambda i: (counts.get((s, g[i]), 0), g[i], i))
            out[s][g[place]].append((k, place))
        return {s: dict(m) for s, m in out.items()}


class Lookup:
    """Places of the given hashes in a long array."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.sort(keys)
        self.table = np.zeros(_TABLE, bool)
        self.table[(keys & np.uint64(_TABLE - 1)).astype(np.int64)] = True

    def __call__(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``h`` that hold a key, and which key."""
        at = np.flatnonzero(self.table[(h & np.uint64(_TABLE - 1)).astype(np.int64)])
        i = np.minimum(np.searchsorted(self.keys, h[at]), len(self.keys) - 1)
        same = self.keys[i] == h[at]
        return at[same], i[same]


def shingle_counts(docs: DataFrame, shingles: dict[int, np.ndarray]) -> dict[tuple[int, int], int]:
    """How often each of the given shingles occurs in all documents; one row per task batch and shingle moves."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finders = {s: Lookup(k) for s, k in shingles.items()}
        totals = {s: np.zeros(len(k), np.int64) for s, k in shingles.items()}
        for batch in batches:
            for _, _, data, offs in steps(batch.column("text"), lower=True):
                h = Words(data, offs, NOT_ALNUM).hash
                for s, find in finders.items():
                    totals[s] += np.bincount(find(grams(h, s))[1], minlength=len(totals[s]))
        for s, total in totals.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), s, np.int32)), pa.array(at), pa.array(total[at])], names=["s", "i", "n"])

    if not shingles:
        return {}
    rows = docs.select("text").mapInArrow(count, "s int, i long, n long").groupBy("s", "i").agg(F.sum("n").alias("n"))
    return {(r["s"], int(shingles[r["s"]][r["i"]])): r["n"] for r in rows.collect()}  # a row per item shingle at most


def block_hits(docs: DataFrame, items: list[tuple[object, str | None]], width: int) -> DataFrame:
    """``docs`` (keyed) with n_words, hit_ranges (merged word ranges) and hit_items for one block of items."""
    spark = docs.sparkSession
    windows = Windows(items, width)
    prefixes = windows.prefixes(shingle_counts(docs, windows.shingles))
    shared = spark.sparkContext.broadcast((windows.words, windows.hashes, windows.items, prefixes))
    fields = [f for f in docs.schema.fieldNames() if f != "text"]
    arrow_extra = [("n_words", pa.int64()), ("hit_ranges", pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))),
                   ("hit_items", pa.list_(pa.string()))]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, hashes, item_ids, by_width = shared.value
        lookups = {s: (Lookup(np.array(sorted(m), np.uint64)), [m[k] for k in sorted(m)]) for s, m in by_width.items()}
        for batch in batches:
            n_words = np.zeros(batch.num_rows, np.int64)
            ranges: list[list] = [[] for _ in range(batch.num_rows)]
            items_of: list[set] = [set() for _ in range(batch.num_rows)]
            for a, _, data, offs in steps(batch.column("text"), lower=True):
                w = Words(data, offs, NOT_ALNUM)
                n_words[a:a + len(offs) - 1] = np.diff(w.first)
                raw = None
                for s, (lookup, uses) in lookups.items():
                    for at, key in zip(*(x.tolist() for x in lookup(grams(w.hash, s)))):
                        doc = int(w.doc[at])
                        for k, place in uses[key]:
                            n, begin = len(words[k]), at - place
                            if begin < w.first[doc] or begin + n > w.first[doc + 1]:  # positional and length bounds
                                continue
                            if not np.array_equal(w.hash[begin:begin + n], hashes[k]):
                                continue
                            raw = data.tobytes() if raw is None else raw
                            if [raw[x:y] for x, y in zip(w.start[begin:begin + n], w.end[begin:begin + n])] == words[k]:
                                ranges[a + doc].append((begin - int(w.first[doc]), begin - int(w.first[doc]) + n))
                                items_of[a + doc].update(item_ids[k])
            cols = [batch.column(batch.schema.get_field_index(f)) for f in fields]
            more = [pa.array(n_words), pa.array([merged(r) for r in ranges], arrow_extra[1][1]),
                    pa.array([sorted(i) for i in items_of], arrow_extra[2][1])]
            yield pa.RecordBatch.from_arrays(cols + more, names=fields + [n for n, _ in arrow_extra])

    more = T.StructType.fromDDL("n_words long, hit_ranges array<struct<a:long,b:long>>, hit_items array<string>")
    schema = T.StructType(docs.drop("text").schema.fields + more.fields)
    return docs.mapInArrow(find, schema)


def merged(ranges: list[tuple[int, int]]) -> list[dict]:
    out: list[dict] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1]["b"]:
            out[-1]["b"] = max(out[-1]["b"], b)
        else:
            out.append({"a": a, "b": b})
    return out


def item_blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple[object, str | None]]]:
    """The distinct items in blocks of about ``block_bytes``; how many blocks there are follows from their measured size."""
    items = materialize(benchmark.select("item_id", "text").distinct(), "benchmark-items")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-2 * size // block_bytes)) if size > block_bytes else 1
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    for k in range(n):
        yield [(r[0], r[1]) for r in items.where(block == k).collect()]


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, k_id, k_text, n_words, hit_ranges (merged word ranges), hit_items of every document row."""
    rows = keyed(docs)
    blocks = [block_hits(rows, items, width) for items in item_blocks(benchmark, block_bytes)]
    if len(blocks) == 1:
        return blocks[0]
    base, rest = blocks[0].select("doc_id", "k_id", "k_text", "n_words"), blocks[0]
    for b in blocks[1:]:
        rest = rest.unionByName(b)
    hits = (rest.where(F.size("hit_ranges") > 0).groupBy(F.col("k_id").alias("h_id"), F.col("k_text").alias("h_text"))
            .agg(F.array_distinct(F.flatten(F.collect_list("hit_ranges"))).alias("r"),
                 F.array_distinct(F.flatten(F.collect_list("hit_items"))).alias("i")))
    step = "struct<a:long,b:long>"
    # sorted ranges; one that overlaps the last is cut to begin where that one ends
    cut = F.aggregate(F.array_sort("r"), F.array().cast(f"array<{step}>"), lambda acc, x: F.when(
        (F.size(acc) == 0) | (F.element_at(acc, -1)["b"] <= x["a"]), F.concat(acc, F.array(x))).when(
        F.element_at(acc, -1)["b"] >= x["b"], acc).otherwise(F.concat(acc, F.array(F.struct(
            F.element_at(acc, -1)["b"].alias("a"), x["b"].alias("b"))))))
    return (base.join(hits, (F.col("k_id") == F.col("h_id")) & (F.col("k_text") == F.col("h_text")), "left")
            .select("doc_id", "k_id", "k_text", "n_words",
                    F.coalesce(cut, F.array().cast(f"array<{step}>")).alias("hit_ranges"),
                    F.coalesce("i", F.array().cast("array<string>")).alias("hit_items")))


def clean(docs: DataFrame, benchmark: DataFrame, width: int = 10) -> DataFrame:
    """The rows of ``docs`` without any hit, with all their columns."""
    found = materialize(contamination(docs, benchmark, width).where(F.size("hit_ranges") > 0)
                        .select(F.col("k_id").alias("h_id"), F.col("k_text").alias("h_text")).distinct(), "contaminated")
    key = row_key()
    return docs.join(found, (key["k_id"] == F.col("h_id")) & (key["k_text"] == F.col("h_text")), "left_anti")


SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT item_id, least(len(w), 10) AS n, unnest(range(0, len(w) - least(len(w), 10) + 1)) AS i, w FROM b
       WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, n, array_to_string(w[i + 1:i + n], ' ') AS t FROM bw),
sizes AS (SELECT DISTINCT n FROM win),
dp AS (SELECT doc_id, n, unnest(range(0, len(w) - n + 1)) AS i, w FROM d, sizes WHERE len(w) >= n),
dw AS (SELECT doc_id, n, i, array_to_string(w[i + 1:i + n], ' ') AS t FROM dp),
hit AS (SELECT doc_id, dw.n, i, item_id FROM dw JOIN win ON dw.n = win.n AND dw.t = win.t),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM
          (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, n, i FROM hit)) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS l FROM
          (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(l, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query("op2_decontamination", SQL)
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("hit_ranges", F.lit(0).cast("long"), lambda n, r: n + r["b"] - r["a"])
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("hit_items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", F.array_sort("hit_items")).cast("binary"), 256).alias("items_sha256"),
                        (n_hit > 0).alias("contaminated"))
