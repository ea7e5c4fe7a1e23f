"""Vector code compression: product codes with integer codebooks, assigned along a lexicographic trie.

Components become integers, vectors are cut into equal consecutive parts, and every part position has a codebook of
``entries`` vectors, refined by rounds of nearest-entry assignment and floored means. Equal parts are counted once: the
distinct parts of a position, with their multiplicity, are kept in lexicographic order, so consecutive rows that agree in
their first dimensions are a node of a trie. A traversal in that (depth-first) order adds each dimension's squared
differences to all entries once per node, from the parent's sums; the leaves take the smallest entry and add their
components, weighted, to its sums. Runs of STEP leaves are one step, so memory does not depend on a position's distinct parts.

A round reads the distinct parts and sends back sums per (part, entry, dimension): a number fixed by the codebooks' shape.

Defined cases: vectors that are null or hold null or non-finite components are dropped; shorter ones count as padded with
zeros, also to a multiple of the number of parts; components beyond LIMIT after scaling count as LIMIT; rows that repeat a
``vec_id`` are vectors of their own, and a null one sorts last; with fewer vectors than entries the codebooks are
smaller; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punctua.llm.catalog import query
from punctua.llm.common import LAST_ID, partitions, read
from punctua.llm.vectors import dense, matrix
from punctua.session import materialize

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Largest magnitude of an integer component; squared differences of 64 of them still fit in 63 bits.
LIMIT = 1 << 26
#: Leaves that one step of a traversal holds.
STEP = 1 << 14


def integers(df: DataFrame, parts: int, scale: int) -> tuple[DataFrame, int]:
    """k_id, label and q (integer components) of the vectors that count; the length of q."""
    rows, width = dense(df, "label", multiple=parts)
    whole = F.transform("v", lambda x: F.greatest(F.least(F.floor(x.cast("double") * scale), F.lit(LIMIT)), F.lit(-LIMIT)).cast("int"))
    return rows.select("k_id", "label", whole.alias("q")), width


def nearest(rows: np.ndarray, part: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entry, squared distance) of every row in the codebook of its part; rows in trie order.

    ``books``: (part, entry, dimension). Runs of rows that agree in part and leading dimensions are nodes; any order of
    rows gives the same result, a sorted one the fewest nodes.
    """
    wide = max(np.abs(rows).max(initial=0), np.abs(books).max(initial=0))
    kind = np.float64 if books.shape[2] * (2 * wide) ** 2 < 2**53 else np.longdouble
    values, books = rows.astype(kind), books.astype(kind)
    apart = (rows[1:] != rows[:-1])
    first = np.where(apart.any(1), apart.argmax(1), rows.shape[1])  # depth of the first difference to the row before
    first = np.r_[0, np.where(part[1:] != part[:-1], 0, first)]
    node, sums = np.zeros(len(rows), np.int64), np.zeros((1, books.shape[1]), kind)
    for depth in range(rows.shape[1]):
        opens = first <= depth
        begin = np.flatnonzero(opens)
        sums = sums[node[begin]] + (values[begin, depth][:, None] - books[part[begin], :, depth]) ** 2
        node = np.cumsum(opens) - 1
    best = sums.argmin(1)
    return best[node], sums[np.arange(len(sums)), best][node].astype(np.int64)


def distinct_parts(rows: DataFrame, parts: int, width: int) -> DataFrame:
    """part, p (components), w (how many vectors have it), ranged and sorted by (part, p)."""
    size = width // parts
    cut = F.posexplode(F.array(*[F.slice("q", i * size + 1, size) for i in range(parts)])).alias("part", "p")
    counted = rows.select(cut).groupBy("part", "p").agg(F.count(F.lit(1)).alias("w"))
    return counted.repartitionByRange(partitions(rows.sparkSession), "part", "p").sortWithinPartitions("part", "p")


def refined(distinct: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round: each used entry is the floored mean of the parts nearest to it."""
    parts, entries, size = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts * entries, size + 1), np.int64)  # sums by dimension, then the count
        for batch in batches:
            p, w = matrix(batch.column("p"), size).astype(np.int64), batch.column("w").to_numpy()
            part = batch.column("part").to_numpy()
            for a in range(0, len(p), STEP):
                entry, _ = nearest(p[a:a + STEP], part[a:a + STEP], books)
                weight = w[a:a + STEP]
                np.add.at(total, part[a:a + STEP] * entries + entry, np.c_[p[a:a + STEP] * weight[:, None], weight])
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total.ravel()[at])], names=["at", "s"])

    sums = distinct.mapInArrow(run, "at long, s long").groupBy("at").agg(F.sum("s").alias("s")).collect()
    total = np.zeros(parts * entries * (size + 1), np.int64)
    for r in sums:  # at most one per part, entry and dimension
        total[r["at"]] = r["s"]
    total = total.reshape(parts, entries, size + 1)
    n = total[:, :, -1:]
    return np.where(n > 0, total[:, :, :-1] // np.maximum(n, 1), books)


def codebooks(rows: DataFrame, width: int, parts: int, entries: int, rounds: int) -> np.ndarray:
    """(part, entry, dimension): started from the parts of the smallest ids, refined ``rounds`` times."""
    size = width // parts
    start = rows.orderBy("k_id", "q").limit(entries).select("q").collect()
    books = np.array([r["q"] for r in start], np.int64).reshape(-1, parts, size).transpose(1, 0, 2)
    if not len(start):
        return books
    distinct = materialize(distinct_parts(rows, parts, width), "distinct-parts")
    for _ in range(rounds):
        books = refined(distinct, books)
    return books


def assigned(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """k_id, label, codes (entry per part) and errors (squared distance per part) of every vector; no shuffle."""
    parts, _, size = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, STEP // parts):
                batch = whole.slice(a, STEP // parts)
                p = matrix(batch.column("q"), parts * size).astype(np.int64).reshape(-1, size)
                part = np.tile(np.arange(parts), batch.num_rows)
                order = np.lexsort((*p.T[::-1], part))
                entry, error = (np.empty(len(p), np.int64) for _ in range(2))
                entry[order], error[order] = nearest(p[order], part[order], books)
                ends = pa.array(np.arange(0, len(p) + 1, parts, dtype=np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("k_id"), batch.column("label"), pa.ListArray.from_arrays(ends, pa.array(entry.astype(np.int32))),
                     pa.ListArray.from_arrays(ends, pa.array(error))], names=["k_id", "label", "codes", "errors"])

    schema = rows.select("k_id", "label").schema.add("codes", T.ArrayType(T.IntegerType())).add("errors", T.ArrayType(T.LongType()))
    return rows.mapInArrow(run, schema)


def compress(df: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
             scale: int = SCALE) -> tuple[DataFrame, np.ndarray]:
    """The codes of all vectors of ``df`` (see :func:`assigned`) and the final codebooks."""
    rows, width = integers(df, parts, scale)
    rows = materialize(rows, "integer-vectors")
    books = codebooks(rows, width, parts, entries, rounds)
    if not books.size:
        return rows.select("k_id", "label", F.lit(None).cast("array<int>").alias("codes"),
                           F.lit(None).cast("array<bigint>").alias("errors")).limit(0), books
    return materialize(assigned(rows, books), "codes"), books


ORACLE = """
WITH kept AS (SELECT vec_id, label, [floor(4096 * x::DOUBLE)::BIGINT FOR x IN embedding] AS q FROM embeddings
              WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
size AS (SELECT max(len(q)) // 8 AS k FROM kept),
vals AS MATERIALIZED (SELECT vec_id, i // k AS part, i % k AS pos, q[i + 1] AS val
                      FROM kept, size, range(8 * k) AS r(i)),
ranked AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept),
book0 AS MATERIALIZED (SELECT part, entry, pos, val FROM vals JOIN ranked USING (vec_id) WHERE entry < 16),
"""
for _i in range(ROUNDS + 1):
    ORACLE += f"""far{_i} AS (SELECT v.vec_id, v.part, b.entry, sum((v.val - b.val) * (v.val - b.val))::BIGINT AS d
         FROM vals v JOIN book{_i} b USING (part, pos) GROUP BY ALL),
near{_i} AS MATERIALIZED (SELECT vec_id, part, (min(d * 16 + entry) % 16)::BIGINT AS entry, min(d) AS d FROM far{_i} GROUP BY ALL),
"""
    if _i < ROUNDS:
        ORACLE += f"""mean{_i} AS (SELECT n.part, n.entry, v.pos, floor(sum(v.val)::DOUBLE / count(*))::BIGINT AS val
          FROM near{_i} n JOIN vals v USING (vec_id, part) GROUP BY ALL),
book{_i + 1} AS MATERIALIZED (SELECT part, entry, pos, coalesce(m.val, b.val) AS val
                     FROM book{_i} b LEFT JOIN mean{_i} m USING (part, entry, pos)),
"""
ORACLE += f"""final AS (SELECT k.vec_id, k.label, string_agg(printf('%02x', n.entry), '' ORDER BY n.part) AS code, sum(n.d)::BIGINT AS error
          FROM kept k JOIN near{ROUNDS} n USING (vec_id) GROUP BY ALL)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(val::VARCHAR, ',' ORDER BY part, entry, pos)) FROM book{ROUNDS}) AS codebooks_sha256
FROM final
"""


@query("op13_vector_codes", ORACLE)
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, books = compress(read(spark, sf_dir, "embeddings"))
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    code = F.concat_ws("", F.transform("codes", lambda e: F.lpad(F.lower(F.hex(e)), 2, "0")))
    rows = found.select(F.when(F.col("k_id") != LAST_ID, F.col("k_id")).alias("vec_id"), "label", code.alias("code"),
                        F.aggregate("errors", F.lit(0).cast("long"), lambda a, x: a + x).alias("error"))
    exact = F.sum(F.col("error").cast("decimal(38,0)"))  # so that no sum overflows; beyond a long it is the largest long
    sums = rows.groupBy(F.col("label").alias("s_label")).agg(F.least(exact, F.lit(LAST_ID)).cast("long").alias("label_error"))
    return rows.join(sums, F.col("label").eqNullSafe(F.col("s_label"))).select(
        "vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
