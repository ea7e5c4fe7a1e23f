"""Hard-negative mining by angular triangle filtering.

Scores are inner products of integer vectors (components scaled and floored). Every row stores its norm and its angles to a
few reference directions. For a row at angle y of a reference and an anchor at angle x the angle between them is within
[|x - y|, x + y], so each reference gives an interval of the cosine; their intersection times the norms, widened by a
rounding allowance, bounds the score. Rows are dealt by their nearest reference and lie in windows of WINDOW rows with
similar angles; only windows whose bounds overlap what an anchor still needs get integer scores:

* positives: scores above the anchor's fifth best so far, among rows of its label;
* negatives: scores within the range that the anchor's positives allow, among rows of other labels.

Anchors go in blocks, rows in slices; a pair of block and slice is a unit of work that holds the block and streams the slice,
keeping the best few per anchor (and positive). What a unit sends back is bounded by its anchors, and the units' bests
are merged by rank. Both a label and a reference that hold any share of the rows are split over slices.

Defined cases: rows with a null label, a null vector, or a null or non-finite component take no part; a shorter vector counts
as padded with zeros; rows that repeat a ``vec_id`` are rows of their own (an anchor's other rows are the other rows, also
those of its id); a null ``vec_id`` is no anchor and sorts last; anchors without positives or negatives give no rows; an
empty table gives none; further columns are ignored. Scores are exact up to 2^57.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punctua.llm.catalog import query
from punctua.llm.common import LAST_ID, partitions, read
from punctua.llm.vectors import dense, matrix
from punctua.session import materialize

SCALE, TOP = 256, 5
#: Negatives score between LOW and HIGH percent of the positive.
LOW, HIGH = 80, 100
#: Reference directions, chosen among the SAMPLE vectors with the smallest hash of their id (a choice of bounds only).
REFERENCES, SAMPLE = 16, 1024
#: Anchors in a block, at most about; rows in a slice, at least about; rows in a window.
ANCHORS, SLICE, WINDOW = 2048, 2048, 128


def whole(x: np.ndarray, scale: int) -> np.ndarray:
    return np.floor(x * scale)


def norms(q: np.ndarray) -> np.ndarray:
    return np.sqrt(np.einsum("ij,ij->i", q, q))


def angles(q: np.ndarray, n: np.ndarray, references: np.ndarray) -> np.ndarray:
    """Angles (radians) of the rows of ``q`` to unit ``references``; a zero vector is at angle 0 of all."""
    with np.errstate(invalid="ignore", divide="ignore"):
        cosine = np.where(n[:, None] > 0, q @ references.T / n[:, None], 1.0)
    return np.arccos(np.clip(cosine, -1, 1))


def references(rows: DataFrame, width: int, scale: int) -> np.ndarray:
    """Unit vectors far from each other, of a bounded sample: each next one is the farthest from those before."""
    sample = rows.select("k_id", "v").orderBy(F.xxhash64("k_id"), "k_id", "v").limit(SAMPLE).select("v").collect()
    x = whole(np.array([r["v"] for r in sample], np.float64).reshape(-1, width), scale)
    x = x[norms(x) > 0]
    if not len(x):
        return np.eye(1, width)
    x = x / norms(x)[:, None]
    chosen, nearest = [0], x @ x[0]
    while len(chosen) < min(REFERENCES, len(x)):
        chosen.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, x @ x[chosen[-1]])
    return x[chosen]


def stored(rows: DataFrame, width: int, directions: np.ndarray, scale: int) -> DataFrame:
    """``rows`` with r (number), norm, angles to the directions, and near (the nearest direction)."""
    rows = rows.withColumn("r", F.monotonically_increasing_id())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q = whole(matrix(batch.column("v"), width), scale)
            n = norms(q)
            a = angles(q, n, directions)
            ends = pa.array(np.arange(0, a.size + 1, a.shape[1], dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(n), pa.ListArray.from_arrays(ends, pa.array(a.ravel())), pa.array(a.argmin(1).astype(np.int32))],
                names=[*batch.schema.names, "norm", "angles", "near"])

    more = [("norm", T.DoubleType()), ("angles", T.ArrayType(T.DoubleType())), ("near", T.IntegerType())]
    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, *[T.StructField(*x) for x in more]]))


def bounds(na: np.ndarray, ta: np.ndarray, n: np.ndarray, t: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(least, largest) score of every anchor with any row of every window, rounding allowed for."""
    n1, n2 = np.minimum.reduceat(n, starts), np.maximum.reduceat(n, starts)
    high, low = np.ones((len(na), len(starts))), -np.ones((len(na), len(starts)))
    for k in range(ta.shape[1]):  # one reference at a time: the windows of all of them need not be held at once
        near, far = np.minimum.reduceat(t[:, k], starts), np.maximum.reduceat(t[:, k], starts)
        x = ta[:, k][:, None]
        high = np.minimum(high, np.cos(np.maximum(0, np.maximum(x - far, near - x))))
        low = np.maximum(low, np.cos(np.minimum(np.pi, x + far)))
    margin = 1 + 1e-6 * na[:, None] * n2  # angles near 0 or pi lose half the digits
    most = na[:, None] * np.where(high >= 0, n2, n1) * high + margin
    least = na[:, None] * np.where(low >= 0, n1, n2) * low - margin
    return least, most


class Best:
    """The best TOP (score, smaller id, smaller number first) of each slot."""

    def __init__(self, slots: int):
        self.slot, self.id, self.r = (np.zeros(0, np.int64) for _ in range(3))
        self.score = np.zeros(0)
        self.last = np.full(slots, -np.inf)  # score of the worst of a full slot

    def add(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray, r: np.ndarray) -> None:
        slot, ids, r = np.r_[self.slot, slot], np.r_[self.id, ids], np.r_[self.r, r]
        score = np.concatenate([self.score.astype(score.dtype), score])
        order = np.lexsort((r, ids, -score, slot))
        slot = slot[order]
        begin = np.searchsorted(slot, slot, "left")
        keep = np.arange(len(slot)) - begin < TOP
        order = order[keep]
        self.slot, self.id, self.r, self.score = slot[keep], ids[order], r[order], score[order]
        full = np.bincount(self.slot, minlength=len(self.last)) == TOP
        at_last = np.r_[self.slot[1:] != self.slot[:-1], True] if len(self.slot) else np.zeros(0, bool)
        worst = np.full(len(self.last), -np.inf)
        worst[self.slot[at_last]] = self.score[at_last]
        self.last = np.where(full, worst, -np.inf)


def as_long(score: np.ndarray) -> pa.Array:
    return pa.array(np.clip(score, -2.0**63, 2.0**63 - 1024).astype(np.int64))


def scan(width: int, turns: int, scale: int, negatives: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A unit's anchors (kind 0) come first, then its rows (kind 1) by direction and angle."""
    def finish(held: dict, best: Best) -> pa.RecordBatch:
        a = best.slot // TOP if negatives else best.slot
        place = best.slot % TOP if negatives else np.zeros(len(best.slot), np.int64)
        return pa.RecordBatch.from_arrays([pa.array(held["r"][a]), pa.array(place.astype(np.int32)), pa.array(best.id), pa.array(best.r),
                                           as_long(best.score)], names=["anchor_r", "place", "id", "r", "score"])

    def anchors(batch: pa.RecordBatch) -> dict:
        q = whole(matrix(batch.column("v"), width), scale)
        held = {"q": q, "n": norms(q), "t": matrix(batch.column("angles"), turns),
                "r": batch.column("r").to_numpy(), "label": batch.column("label").to_numpy(zero_copy_only=False)}
        if negatives:
            scores = np.full((batch.num_rows, TOP), np.nan)
            for i, x in enumerate(batch.column("positives").to_pylist()):
                scores[i, :len(x)] = x
            held["positive"] = scores
        return held

    def search(held: dict, best: Best, batch: pa.RecordBatch) -> None:
        q = whole(matrix(batch.column("v"), width), scale)
        n, t = norms(q), matrix(batch.column("angles"), turns)
        ids, r, label = batch.column("k_id").to_numpy(), batch.column("r").to_numpy(), batch.column("label").to_numpy(zero_copy_only=False)
        starts = np.arange(0, len(q), WINDOW)
        least, most = bounds(held["n"], held["t"], n, t, starts)
        exact = np.float64 if held["n"].max() * n.max() < 2.0**46 else np.longdouble
        for k, a in enumerate(starts.tolist()):
            s = slice(a, a + WINDOW)
            if negatives:
                need = ((HIGH * held["positive"] >= 100 * least[:, k][:, None]) & (LOW * held["positive"] <= 100 * most[:, k][:, None]))
                need &= most[:, k][:, None] >= best.last.reshape(-1, TOP)
                some = np.flatnonzero(need.any(1))
            else:
                some = np.flatnonzero(most[:, k] >= best.last)
            if not len(some):
                continue
            score = held["q"][some].astype(exact) @ q[s].T.astype(exact)
            same = held["label"][some][:, None] == label[s]
            if negatives:
                found = []
                for p in range(TOP):
                    positive = held["positive"][some, p].astype(exact)[:, None]
                    ok = ~same & (LOW * positive <= 100 * score) & (100 * score <= HIGH * positive)
                    i, j = np.nonzero(ok & (score >= best.last[some * TOP + p][:, None]))
                    found.append((some[i] * TOP + p, score[i, j], ids[s][j], r[s][j]))
                found = [np.concatenate(x) for x in zip(*found)]
            else:
                ok = same & (held["r"][some][:, None] != r[s]) & (score >= best.last[some][:, None])
                i, j = np.nonzero(ok)
                found = [some[i], score[i, j], ids[s][j], r[s][j]]
            if len(found[0]):
                best.add(*found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, parts, held, best = None, [], None, None
        for batch in batches:
            key = np.stack([batch.column(c).to_numpy() for c in ("u_label", "block", "slice", "kind")])
            cuts = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(0)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                if a == b:
                    continue
                part, now, kind = batch.slice(a, b - a), tuple(key[:3, a].tolist()), key[3, a]
                if now != unit:
                    if best is not None:
                        yield finish(held, best)
                    unit, parts, held, best = now, [], None, None
                if kind == 0:
                    parts.append(part)
                elif parts or held:
                    if held is None:
                        held = anchors(pa.Table.from_batches(parts).combine_chunks().to_batches()[0])
                        best, parts = Best(len(held["r"]) * (TOP if negatives else 1)), []
                    search(held, best, part)
        if best is not None:
            yield finish(held, best)

    return run


def searched(rows: DataFrame, anchors: DataFrame, plan: dict[str, Column], width: int, turns: int, scale: int,
             negatives: bool) -> DataFrame:
    """anchor_r, place, id, r, score: the best TOP of each unit, and of those the best TOP (by_rank).

    ``plan``: u_label, blocks and slices of a row or anchor as columns.
    """
    extra = ["positives"] if negatives else []
    cols = ["u_label", "block", "slice", "kind", "near", "r", "k_id", "label", "v", "angles", *extra]
    both = [df.withColumns(plan) for df in (anchors, rows)]
    block, own = (F.pmod(F.xxhash64("r", F.lit(k)), F.col(c)).cast("int") for k, c in ((0, "blocks"), (1, "slices")))
    left = both[0].withColumns({"block": block, "slice": F.explode(F.sequence(F.lit(0), F.col("slices") - 1)), "kind": F.lit(0)})
    right = both[1].withColumns({"slice": own, "block": F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)), "kind": F.lit(1)})
    for c in extra:
        right = right.withColumn(c, F.lit(None).cast("array<bigint>"))
    work = left.select(*cols).unionByName(right.select(*cols)).withColumn("at", F.col("angles")[F.col("near")])
    unit = ["u_label", "block", "slice"]
    dealt = work.repartition(partitions(rows.sparkSession), *unit).sortWithinPartitions(*unit, "kind", "near", "at")
    found = dealt.drop("near", "at").mapInArrow(scan(width, turns, scale, negatives),
                                                 "anchor_r long, place int, id long, r long, score long")
    order = W.partitionBy("anchor_r", "place").orderBy(F.desc("score"), "id", "r")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= TOP)


def slices_for(n: Column, blocks: Column, tasks: int) -> Column:
    """Enough slices to keep ``tasks`` busy, none of fewer than about SLICE rows."""
    return F.greatest(F.lit(1), F.least(F.ceil(n / F.lit(SLICE)), F.ceil(F.lit(2 * tasks) / blocks))).cast("int")


def mine(df: DataFrame, every: int = 100, scale: int = SCALE) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of the rows whose id is divisible by ``every``."""
    spark = df.sparkSession
    rows, width = dense(df.where("label is not null"), "label")
    rows = rows.withColumn("label", F.col("label").cast("long"))
    directions = references(rows, width, scale)
    table = materialize(stored(rows, width, directions, scale), "angles")
    anchors = table.where((F.col("k_id") != LAST_ID) & (F.col("k_id") % every == 0))
    tasks = partitions(spark)
    per_label = table.groupBy(F.col("label").alias("u_label")).agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when((F.col("k_id") != LAST_ID) & (F.col("k_id") % every == 0), 1)).alias("a"))
    per_label = materialize(per_label.where("a > 0"), "labels")
    plan = per_label.withColumn("blocks", F.ceil(F.col("a") / F.lit(ANCHORS)).cast("int"))
    plan = plan.select("u_label", "blocks", slices_for(F.col("n"), F.col("blocks"), tasks).alias("slices"))
    of_label = [x.join(plan, F.col("label") == F.col("u_label")) for x in (table, anchors)]
    best = searched(of_label[0], of_label[1], {}, width, len(directions), scale, False)
    positives = materialize(best.select("anchor_r", F.col("rank").alias("place"), "id", "score"), "positives")
    # collected lists hold TOP scores at most
    lists = positives.groupBy("anchor_r").agg(F.sort_array(F.collect_list(F.struct("place", "score"))).alias("p")).select(
        "anchor_r", F.transform("p", lambda x: x["score"]).alias("positives"))
    asking = materialize(anchors.join(lists, F.col("r") == F.col("anchor_r")).drop("anchor_r"), "anchors")
    n, a = table.count(), asking.count()
    blocks = max(1, -(-a // ANCHORS))
    whole_plan = {"u_label": F.lit(0).cast("long"), "blocks": F.lit(blocks), "slices": slices_for(F.lit(n), F.lit(blocks), tasks)}
    found = searched(table, asking, whole_plan, width, len(directions), scale, True)
    named = anchors.select(F.col("r").alias("a_r"), F.col("k_id").alias("anchor_id"))
    pairs = positives.join(named, F.col("anchor_r") == F.col("a_r")).select(
        F.col("a_r"), "anchor_id", (F.col("place") - 1).alias("p_place"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    out = found.join(pairs, (F.col("anchor_r") == F.col("a_r")) & (F.col("place") == F.col("p_place")))
    return out.select("anchor_id", *[F.when(F.col(c) != LAST_ID, F.col(c)).alias(name) for c, name in (("positive_id", "positive_id"),)],
                      "rank", F.when(F.col("id") != LAST_ID, F.col("id")).alias("negative_id"), "positive_score",
                      F.col("score").alias("negative_score"))


ORACLE = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  [floor(256 * x::DOUBLE) FOR x IN embedding] AS q FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (SELECT a.vec_id AS anchor_id, x.vec_id AS other, a.label = x.label AS same, list_dot_product(a.q, x.q)::BIGINT AS score
           FROM v a JOIN v x ON a.vec_id % 100 = 0 AND a.vec_id <> x.vec_id),
positives AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM scored WHERE same
              QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT p.anchor_id, p.positive_id, (row_number() OVER w)::INTEGER AS rank, s.other AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score
WINDOW w AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other)
QUALIFY row_number() OVER w <= 5
"""


@query("op12_hard_negatives", ORACLE)
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings")
    return mine(rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))))
