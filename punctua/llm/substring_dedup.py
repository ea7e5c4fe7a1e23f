"""Substring dedup by prefix-partitioned suffix trees over words.

A window is ``width`` consecutive words of one document. Its words go if the same window starts in a document with a
smaller ``doc_id``. Suffixes (window starts) are dealt into groups by word prefixes of varying length:

1. Each window holds the prefix of PREFIX words whose hash is smallest; equal windows hold the same one at the same
   place. Neighbouring windows with one such anchor form a segment, so a segment stands for about 20 suffixes. Only
   prefixes that start in two documents or more go on: the others head no inner node of a suffix tree.
2. Copies of a segment collapse to the smallest document. A prefix with one distinct segment needs no tree: every
   window in it first starts in that document.
3. Segments that share a prefix and differ are read again from their first document. A group of at most GROUP segments
   fits in memory: its suffixes are sorted, neighbours' common prefixes give the tree's inner nodes, and the nodes at
   least ``width`` words deep are the repeats. The prefixes of larger groups are lengthened to all ``width`` words, where
   a group is one node and Spark's aggregation finds its smallest document.

Words are compared by 64-bit hashes each. Defined cases: a null text has no words; a null ``doc_id`` is larger than any
other; rows that repeat a ``doc_id`` are copies of one document number, so none of them is the smaller one; documents
shorter than the window keep all; an empty table gives no rows; columns beside ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctua.llm.catalog import query
from punctua.llm.common import SPACES, Words, grams, keyed, mix, pair_hash, partitions, read, steps
from punctua.session import materialize

WIDTH, PREFIX = 50, 16
#: Most segments in a group that one tree is built for, and suffixes that are sorted at once.
GROUP, SUFFIXES = 4096, 20_000
_AT = np.uint64((1 << 30) - 1)


def anchors(h: np.ndarray, doc: np.ndarray, width: int, prefix: int) -> dict[str, np.ndarray]:
    """Segments of the word hashes ``h``: first window, windows, place of the anchor, prefix and segment hash."""
    n = len(h) - width + 1
    if n < 1:
        return {k: np.zeros(0, np.int64) for k in ("first", "count", "off", "key", "seg")}
    g = grams(h, prefix)
    low = (g & ~_AT) | np.arange(len(g), dtype=np.uint64)
    size, want = 1, width - prefix + 1
    while 2 * size <= want:
        low, size = np.minimum(low[:-size], low[size:]), 2 * size
    if want > size:
        low = np.minimum(low[:len(low) - (want - size)], low[want - size:])
    at = (low & _AT).astype(np.int64)
    window = np.flatnonzero(doc[:n] == doc[width - 1:])
    if not len(window):
        return anchors(h[:0], doc[:0], width, prefix)
    at = at[window]
    new = np.r_[True, (np.diff(at) != 0) | (np.diff(window) != 1)]
    begin = np.flatnonzero(new)
    count = np.diff(np.r_[begin, len(window)])
    first, off = window[begin], at[begin] - window[begin]
    whole = grams(h, width)
    seg = pair_hash(pair_hash(whole[first], whole[first + count - 1]), (off * 4096 + count).astype(np.uint64))
    return {"first": first, "count": count, "off": off, "key": g[at[begin]].view(np.int64), "seg": seg.view(np.int64)}


def segments(rows: DataFrame, width: int, prefix: int) -> DataFrame:
    """Every segment of the keyed ``rows``: k_id, k_text, key, seg, at (first window's word), cnt (windows)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column("k_id").to_numpy(), batch.column("k_text").to_numpy()
            for a, _, data, offs in steps(batch.column("text")):
                w = Words(data, offs, SPACES)
                s = anchors(w.hash, w.doc, width, prefix)
                doc = w.doc[s["first"]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[a + doc]), pa.array(texts[a + doc]), pa.array(s["key"]), pa.array(s["seg"]),
                     pa.array((s["first"] - w.first[doc]).astype(np.int32)), pa.array(s["count"].astype(np.int32))],
                    names=["k_id", "k_text", "key", "seg", "at", "cnt"])

    return rows.select("text", "k_id", "k_text").mapInArrow(
        run, "k_id long, k_text long, key long, seg long, at int, cnt int")


def bodies(wanted: DataFrame, width: int) -> DataFrame:
    """Word hashes of the wanted segments: ``wanted`` has text and want (array of key, seg, at, cnt, big)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("k_id").to_pylist()
            want = batch.column("want")
            for a, b, data, offs in steps(batch.column("text")):
                h, cols = Words(data, offs, SPACES), [[] for _ in range(6)]
                for i in range(a, b):
                    for s in want[i].as_py():
                        begin = int(h.first[i - a]) + s["at"]
                        body = h.hash[begin:begin + s["cnt"] + width - 1].tobytes()
                        for c, v in zip(cols, (s["key"], s["seg"], ids[i], s["cnt"], s["big"], body)):
                            c.append(v)
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                                 names=["key", "seg", "mid", "cnt", "big", "body"])

    return wanted.mapInArrow(run, "key long, seg long, mid long, cnt int, big boolean, body binary")


def deep_nodes(keys: np.ndarray, counts: np.ndarray, mids: np.ndarray, body: list[bytes], width: int):
    """Windows that first start in a document before their segment's own: (row, window, that document).

    The suffixes of all rows are sorted under their group's prefix; where neighbours share ``width`` words they hang from
    one inner node of that depth.
    """
    row = np.repeat(np.arange(len(keys)), counts)
    j = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    flat = np.frombuffer(b"".join(body), np.uint64)
    begin = np.cumsum([0, *(len(b) // 8 for b in body)])[:-1]
    suffix = np.empty((len(row), width + 1), ">u8")
    suffix[:, 0] = keys.view(np.uint64)[row]
    suffix[:, 1:] = flat[(begin[row] + j)[:, None] + np.arange(width)]
    order = np.argsort(suffix.view(f"V{8 * (width + 1)}").ravel(), kind="stable")
    suffix = suffix[order]
    differ = suffix[1:] != suffix[:-1]
    depth = np.where(differ.any(1), differ.argmax(1), width + 1)  # common prefix of neighbours, group key included
    node = np.flatnonzero(np.r_[True, depth < width + 1])
    first = np.minimum.reduceat(mids[row[order]], node)
    least = np.repeat(first, np.diff(np.r_[node, len(row)]))
    found = least < mids[row[order]]
    return row[order][found], j[order][found], least[found]


def tree_marks(grouped: DataFrame, width: int) -> DataFrame:
    """key, seg, j, m for the windows of segments dealt and sorted by key; whole groups are worked on at once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            t = pa.Table.from_batches(held)
            keys, mids = t.column("key").to_numpy(), t.column("mid").to_numpy()
            row, j, m = deep_nodes(keys, t.column("cnt").to_numpy(), mids, t.column("body").to_pylist(), width)
            return pa.RecordBatch.from_arrays(
                [pa.array(keys[row]), pa.array(t.column("seg").to_numpy()[row]), pa.array(j.astype(np.int32)), pa.array(m)],
                names=["key", "seg", "j", "m"])

        held, size = [], 0
        for batch in batches:
            keys = batch.column("key").to_numpy()
            a = 0
            for b in [*(np.flatnonzero(np.diff(keys)) + 1).tolist(), batch.num_rows]:
                if b == a:
                    continue
                if size >= SUFFIXES and held[-1].column("key")[-1].as_py() != int(keys[a]):
                    yield out(held)
                    held, size = [], 0
                held.append(batch.slice(a, b - a))
                size += int(batch.column("cnt").to_numpy()[a:b].sum())
                a = b
        if held:
            yield out(held)

    return grouped.mapInArrow(run, "key long, seg long, j int, m long")


def long_prefixes(big: DataFrame, width: int) -> DataFrame:
    """One row per suffix of the segments in large groups, with two hashes of its whole prefix."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = batch.column("cnt").to_numpy()
            row = np.repeat(np.arange(batch.num_rows), counts)
            j = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
            if not len(row):
                continue
            h = [np.frombuffer(b.as_py(), np.uint64) for b in batch.column("body")]
            one = np.concatenate([grams(x, width) for x in h]).view(np.int64)
            two = np.concatenate([grams(mix(x), width) for x in h]).view(np.int64)
            cols = [pa.array(batch.column(c).to_numpy()[row]) for c in ("key", "seg", "mid")]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(j.astype(np.int32)), pa.array(one), pa.array(two)],
                                             names=["key", "seg", "mid", "j", "one", "two"])

    return big.mapInArrow(run, "key long, seg long, mid long, j int, one long, two long")


def repeats(rows: DataFrame, width: int = WIDTH, prefix: int = PREFIX) -> DataFrame:
    """r_id, r_text, spans: runs of removed windows (at: first window's word, cnt: windows) of each document."""
    spark = rows.sparkSession
    found = materialize(segments(rows, width, prefix), "segments")
    # tables of their own: joined on the spot, a key with a large share of the segments could not be split over tasks
    stat = materialize(found.groupBy(F.col("key").alias("s_key")).agg(
        F.min("k_id").alias("lo"), F.max("k_id").alias("hi"), F.min("seg").alias("a"), F.max("seg").alias("b")).where(
        "lo < hi").select("s_key", "lo", (F.col("a") != F.col("b")).alias("multi")), "repeated-keys")
    shared = materialize(found.join(stat, F.col("key") == F.col("s_key")).drop("s_key"), "repeated-segments")
    several = materialize(shared.where("multi").groupBy("key", "seg")
                          .agg(F.min(F.struct("k_id", "k_text", "at")).alias("f"), F.max("cnt").alias("cnt")), "differing-segments")
    sizes = materialize(several.groupBy(F.col("key").alias("n_key")).agg((F.count(F.lit(1)) > GROUP).alias("big")), "group-sizes")
    want = (several.join(sizes, F.col("key") == F.col("n_key"))
            .groupBy(F.col("f.k_id").alias("w_id"), F.col("f.k_text").alias("w_text"))
            .agg(F.collect_list(F.struct("key", "seg", F.col("f.at").alias("at"), "cnt", "big")).alias("want")))
    texts = rows.join(want, (F.col("k_id") == F.col("w_id")) & (F.col("k_text") == F.col("w_text"))).select(
        "doc_id", "text", "k_id", "k_text", "want")
    body = materialize(bodies(texts, width), "segment-words")
    # a repeated document row gives its segments twice: equal rows, which change no minimum
    small = body.where("not big").repartition(partitions(spark), "key").sortWithinPartitions("key")
    marks = tree_marks(small, width)
    long = long_prefixes(body.where("big"), width)
    least = long.groupBy(F.col("one").alias("o"), F.col("two").alias("t")).agg(F.min("mid").alias("m"))
    marks = marks.unionByName(long.join(least, (F.col("one") == F.col("o")) & (F.col("two") == F.col("t")))
                              .where("m < mid").select("key", "seg", "j", "m"))
    early = marks.groupBy("key", "seg").agg(F.collect_set("j").alias("js"))
    table = (several.select("key", "seg", F.col("f.k_id").alias("mid")).join(early, ["key", "seg"], "left")
             .select(F.col("key").alias("t_key"), F.col("seg").alias("t_seg"), "mid", "js"))
    one = shared.where("not multi and lo < k_id").select("k_id", "k_text", F.struct("at", "cnt").alias("span"))
    more = (shared.where("multi").join(table, (F.col("key") == F.col("t_key")) & (F.col("seg") == F.col("t_seg")))
            .select("k_id", "k_text", F.explode(F.when(F.col("mid") < F.col("k_id"), F.array(F.struct("at", "cnt"))).otherwise(
                F.transform(F.coalesce("js", F.array().cast("array<int>")), lambda j: F.struct(
                    (F.col("at") + j).alias("at"), F.lit(1).alias("cnt"))))).alias("span")))
    return (one.unionByName(more).groupBy(F.col("k_id").alias("r_id"), F.col("k_text").alias("r_text"))
            .agg(F.collect_set("span").alias("spans")))


def cleaned(docs: DataFrame, width: int = WIDTH, texts: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every document and, if asked for, the kept text."""
    rows = keyed(docs)
    found = repeats(rows, width)
    joined = rows.join(found, (F.col("k_id") == F.col("r_id")) & (F.col("k_text") == F.col("r_text")), "left").select(
        "doc_id", "text", "k_id", "k_text", "spans")
    kinds = [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()),
             ("kept", pa.large_string())][:5 if texts else 4]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols: list[list] = [[] for _ in kinds]
            spans = batch.column("spans")
            texts_ = batch.column("text").cast(pa.large_binary())
            for doc_id, text, span in zip(batch.column("doc_id").to_pylist(), texts_, spans):
                words = (text.as_py() or b"").split()  # bytes.split parts at the contract's six separators
                n = len(words)
                if span.is_valid:
                    gone = np.zeros(n + 1, np.int32)
                    for s in span.as_py():
                        gone[s["at"]] += 1
                        gone[s["at"] + s["cnt"] + width - 1] -= 1
                    keep = np.cumsum(gone)[:-1] == 0
                    words = [w for w, k in zip(words, keep.tolist()) if k]
                kept = b" ".join(words)
                for c, v in zip(cols, (doc_id, n, n - len(words), hashlib.sha256(kept).hexdigest(), kept)):
                    c.append(v)
            if texts:
                cols[4] = [k.decode() for k in cols[4]]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(cols, kinds)], names=[k for k, _ in kinds])

    return joined.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string"
                             + ", kept string" * texts)


SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, unnest(range(0, len(w) - 49)) AS i, w FROM d WHERE len(w) >= 50),
x AS (SELECT doc_id, i, array_to_string(w[i + 1:i + 50], ' ') AS t FROM p),
m AS (SELECT md5(t) AS t, min(doc_id) AS lo FROM x GROUP BY 1 HAVING min(doc_id) < max(doc_id)),
g AS (SELECT doc_id, i FROM x JOIN m ON md5(x.t) = m.t WHERE lo < doc_id),
r AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM g),
s AS (SELECT doc_id, list(i) AS gone FROM r GROUP BY doc_id),
k AS (SELECT d.doc_id, len(w) AS n, coalesce(len(gone), 0) AS c, w, gone FROM d LEFT JOIN s USING (doc_id)),
u AS (SELECT doc_id, unnest(w) AS v, unnest(range(0, len(w))) AS i FROM d),
j AS (SELECT u.doc_id, string_agg(v, ' ' ORDER BY u.i) AS t FROM u LEFT JOIN r ON u.doc_id = r.doc_id AND u.i = r.i
      WHERE r.i IS NULL GROUP BY u.doc_id)
SELECT k.doc_id, CAST(n AS BIGINT) AS n_words, CAST(c AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM k LEFT JOIN j USING (doc_id)
"""


@query("op1_substring_dedup", SQL)
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaned(read(spark, sf_dir, "documents"))
