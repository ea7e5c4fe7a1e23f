"""Embedding near-duplicates by PCA-ordered tiled comparison.

Vectors link when their cosine is at least ``least``. Unit vectors are turned into the directions of their second moment,
largest first, which leaves cosines as they are and puts most of a product into its leading dimensions. Linked unit
vectors are at most reach = sqrt(2 - 2 least) apart, in any leading dimensions as well. So

* a grid of cells of that width over the first AXES dimensions: linked vectors are in the same cell or in cells next to each
  other; a cell of more than TILE vectors is cut into tiles by hash, and pairs of tiles are the unit of work, so no
  cell, however full, is one task;
* inside a pair of tiles, runs of STEP vectors along the first dimension are compared only if their boxes over the leading
  BOX dimensions are within reach; a run pair accumulates 16, 32, 64, ... dimensions, and after each chunk pairs whose
  partial product plus the product of the norms of what is left (the suffix norms) is below ``least`` are out. A run
  pair without pairs left stops. What remains is decided by the cosine of the vectors as given, in double precision.

A pair of tiles sends back at most one row per vector: how many links it found there and the smallest vector it is connected
with; links themselves never become rows. Equal vectors are one vertex, counted with their multiplicity.

Defined cases: vectors that are null, zero, or hold null or non-finite components link with nothing (0 links, their own
component); a shorter vector counts as padded with zeros; rows that repeat a ``vec_id`` are vectors of their own and the
id does not link them; a null ``vec_id`` sorts last, and a component with no other id has a null one; an empty table gives
no rows; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punctua.llm.catalog import query
from punctua.llm.common import LAST_ID, read
from punctua.llm.components import components
from punctua.llm.vectors import dense, left_out, matrix
from punctua.session import materialize

LEAST = 0.95
#: Most dimensions of the grid, and most cells that it may have (which bounds what is known of them).
AXES, CELLS = 2, 4096
#: Vectors in a tile, about; vectors in a run; dimensions of a run's box; dimensions accumulated first.
TILE, STEP, BOX, CHUNK = 8192, 512, 16, 16
#: Rounding allowance of bounds on cosines.
SLACK = 1e-9


def units(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows of ``x`` scaled by powers of two (exactly) to magnitudes near 1, and their norms then."""
    x = x / np.exp2(np.floor(np.log2(np.abs(x).max(1, keepdims=True, initial=1e-300))))
    return x, np.sqrt(np.einsum("ij,ij->i", x, x))


def directions(rows: DataFrame, width: int) -> np.ndarray:
    """Orthonormal columns: the eigenvectors of the second moment of all unit vectors, largest eigenvalue first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            x, n = units(matrix(batch.column("v"), width))
            u = x / n[:, None]
            total += u.T @ u
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width * width, dtype=np.int32)), pa.array(total.ravel())], names=["at", "s"])

    moment = np.zeros(width * width)
    for r in rows.select("v").mapInArrow(run, "at int, s double").groupBy("at").agg(F.sum("s").alias("s")).collect():
        moment[r["at"]] = r["s"]  # width * width numbers
    _, basis = np.linalg.eigh(moment.reshape(width, width))
    return np.ascontiguousarray(basis[:, ::-1])


def reach_of(least: float) -> float:
    return math.sqrt(max(0.0, 2 - 2 * least)) + 1e-6


def axes_of(least: float, width: int, n: int) -> int:
    """Dimensions of the grid: as many as ``n`` vectors fill with tiles; within a tile boxes do the same. Decides no link."""
    per_axis = 2 / reach_of(least) + 3
    return max(0, min(AXES, width, int(math.log(CELLS) / math.log(per_axis)), math.ceil(math.log2(max(1, n) / TILE))))


def placed(rows: DataFrame, basis: np.ndarray, axes: int, least: float) -> DataFrame:
    """``rows`` (d, lo, w, v) with their cell of the grid as one number."""
    width, reach = len(basis), reach_of(least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, n = units(matrix(batch.column("v"), width))
            at = np.floor((x / n[:, None]) @ basis[:, :axes] / reach).astype(np.int64)
            cell = ((at + (1 << 19)) << (20 * np.arange(axes))).sum(1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], names=[*batch.schema.names, "cell"])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("cell", T.LongType())]))


def tile_pairs(cells: DataFrame, axes: int) -> DataFrame:
    """t_cell, t_no, pair, side: in which pairs of tiles a tile takes part (side 1: left, 2: right, 3: with itself)."""
    tiles = cells.select("cell", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("no"))
    near = [sum(o << (20 * a) for a, o in enumerate(x)) for x in np.ndindex(*[3] * axes)]
    middle = sum(1 << (20 * a) for a in range(axes))
    left = tiles.select(F.col("cell").alias("c1"), F.col("no").alias("n1"),
                        F.explode(F.array(*[F.lit(o - middle).cast("long") for o in near])).alias("step"))
    right = tiles.select(F.col("cell").alias("c2"), F.col("no").alias("n2"))
    pairs = left.join(right, F.col("c1") + F.col("step") == F.col("c2")).where("c1 < c2 or (c1 = c2 and n1 <= n2)")
    pairs = pairs.select("c1", "n1", "c2", "n2", F.xxhash64("c1", "n1", "c2", "n2").alias("pair"))
    itself = (F.col("c1") == F.col("c2")) & (F.col("n1") == F.col("n2"))
    one = pairs.select(F.col("c1").alias("t_cell"), F.col("n1").alias("t_no"), "pair", "c1", "n1", "c2", "n2",
                       F.when(itself, 3).otherwise(1).alias("side"))
    two = pairs.where(~itself).select(F.col("c2").alias("t_cell"), F.col("n2").alias("t_no"), "pair", "c1", "n1", "c2", "n2",
                                      F.lit(2).alias("side"))
    return one.unionByName(two)


def union(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Join the sets of i[k] and j[k]; ``root`` keeps the smallest member's place of each set."""
    while True:
        a, b = root[i], root[j]
        apart = a != b
        if not apart.any():
            return
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root[:] = up


class Side:
    """Vectors of a tile along the first direction, turned, with suffix norms and the boxes of their runs."""

    def __init__(self, x: np.ndarray, place: np.ndarray, w: np.ndarray, basis: np.ndarray):
        x, n = units(x)
        y = (x / n[:, None]) @ basis
        order = np.argsort(y[:, 0], kind="stable")
        self.x, self.n, self.y, self.place, self.w = x[order], n[order], y[order], place[order], w[order]
        self.cuts = chunks(y.shape[1])
        left = np.cumsum(self.y[:, ::-1] ** 2, axis=1)[:, ::-1]
        self.rest = np.sqrt(np.c_[left, np.zeros(len(x))][:, self.cuts])  # norm of the dimensions from each cut on
        starts = np.arange(0, len(x), STEP)
        self.runs = [slice(a, a + STEP) for a in starts]
        self.low = np.minimum.reduceat(self.y[:, :BOX], starts) if len(x) else np.zeros((0, BOX))
        self.high = np.maximum.reduceat(self.y[:, :BOX], starts) if len(x) else np.zeros((0, BOX))


def chunks(width: int) -> list[int]:
    out = [min(CHUNK, width)]
    while out[-1] < width:
        out.append(min(2 * out[-1], width))
    return out


def run_links(a: Side, s: slice, b: Side, t: slice, least: float, upper: bool) -> tuple[np.ndarray, np.ndarray]:
    """(i, j) within the runs, of linked vectors; ``upper``: the runs are the same one, i < j."""
    ya, yb, cuts = a.y[s], b.y[t], a.cuts
    product = ya[:, :cuts[0]] @ yb[:, :cuts[0]].T
    alive = product + a.rest[s, 0][:, None] * b.rest[t, 0] >= least - SLACK
    if upper:
        alive &= np.tri(len(ya), len(yb), -1, bool).T
    k = 0
    while k + 1 < len(cuts) and np.count_nonzero(alive) * 16 > alive.size:  # many pairs: whole products
        product += ya[:, cuts[k]:cuts[k + 1]] @ yb[:, cuts[k]:cuts[k + 1]].T
        k += 1
        alive &= product + a.rest[s, k][:, None] * b.rest[t, k] >= least - SLACK
    i, j = np.nonzero(alive)
    got = product[i, j]
    while k + 1 < len(cuts) and len(i):  # few pairs: one by one
        got = got + np.einsum("ij,ij->i", ya[i, cuts[k]:cuts[k + 1]], yb[j, cuts[k]:cuts[k + 1]])
        k += 1
        stays = got + a.rest[s, k][i] * b.rest[t, k][j] >= least - SLACK
        i, j, got = i[stays], j[stays], got[stays]
    if len(i) * 16 > alive.size:
        cosine = (a.x[s] @ b.x[t].T / (a.n[s][:, None] * b.n[t]))[i, j]
    else:
        cosine = np.einsum("ij,ij->i", a.x[s][i], b.x[t][j]) / (a.n[s][i] * b.n[t][j])
    linked = cosine >= least
    return i[linked], j[linked]


def compare(table: pa.Table, basis: np.ndarray, least: float) -> pa.Table:
    """One pair of tiles: d, n (links found, with multiplicity), root (a connected vector, d itself if none is smaller)."""
    d, w, side = (table.column(c).to_numpy() for c in ("d", "w", "side"))
    order = np.argsort(d, kind="stable")
    d, w, side = d[order], w[order], side[order]
    x = matrix(table.column("v"), len(basis))[order]
    sides = [Side(x[at], at, w[at], basis) for at in (np.flatnonzero(side & 1), np.flatnonzero(side & 2))]
    a, b = sides
    same, reach = bool(len(side)) and side[0] == 3, reach_of(least)
    links, root = np.zeros(len(d), np.int64), np.arange(len(d))
    for p, s in enumerate(a.runs):
        gap = np.maximum(0, np.maximum(a.low[p] - b.high, b.low - a.high[p]))
        for q in np.flatnonzero((gap ** 2).sum(1) <= reach ** 2).tolist():
            if same and q < p:
                continue
            t = b.runs[q]
            i, j = run_links(a, s, b, t, least, same and p == q)
            if len(i):
                i, j = a.place[s][i], b.place[t][j]
                np.add.at(links, i, w[j])
                np.add.at(links, j, w[i])
                union(root, i, j)
    hit = np.flatnonzero(links)
    return pa.table({"d": d[hit], "n": links[hit], "root": d[root[hit]]})


def distinct_vectors(rows: DataFrame) -> DataFrame:
    """d (number), lo (smallest id), w (rows), v of every distinct vector that is not zero."""
    some = rows.where(F.exists("v", lambda x: x != 0))
    return some.groupBy("v").agg(F.min("k_id").alias("lo"), F.count(F.lit(1)).alias("w")).select(
        F.monotonically_increasing_id().alias("d"), "lo", "w", "v")


def links(vectors: DataFrame, width: int, least: float) -> DataFrame:
    """d, n, root: what the pairs of tiles found (see :func:`compare`), of ``vectors`` (d, lo, w, v)."""
    basis = directions(vectors, width)
    axes = axes_of(least, width, vectors.count())
    table = materialize(placed(vectors, basis, axes, least), "placed-vectors")
    cells = table.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / F.lit(TILE)).cast("int").alias("tiles"))
    cells = materialize(cells, "cells")  # CELLS rows at most
    at_cell = F.col("cell") == F.col("of_cell")
    of = F.broadcast(cells.select(F.col("cell").alias("of_cell"), "tiles"))
    tiled = table.join(of, at_cell).select("d", "w", "v", "cell", F.pmod(F.xxhash64("d"), F.col("tiles")).cast("int").alias("no"))
    pairs = tile_pairs(cells, axes)
    work = tiled.join(pairs, (F.col("cell") == F.col("t_cell")) & (F.col("no") == F.col("t_no"))).select(
        "pair", "c1", "n1", "c2", "n2", "side", "d", "w", "v")
    return work.groupBy("c1", "n1", "c2", "n2").applyInArrow(lambda t: compare(t, basis, least), "d long, n long, root long")


def linked(df: DataFrame, least: float = LEAST) -> DataFrame:
    """k_id, n_links, comp (smallest id reachable) of every row of ``df`` (``vec_id``, ``embedding``)."""
    rows, width = dense(df)
    vectors = materialize(distinct_vectors(rows), "distinct-vectors")
    found = materialize(links(vectors, width, least), "links")
    counts = found.groupBy(F.col("d").alias("n_d")).agg(F.sum("n").alias("n"))
    comps = components(found.select(F.col("d").alias("a"), F.col("root").alias("b")))
    named = comps.join(vectors.select("d", "lo"), F.col("v") == F.col("d")).select(F.col("v").alias("c_d"), "comp", "lo")
    least_id = named.groupBy(F.col("comp").alias("i_comp")).agg(F.min("lo").alias("cid"))
    named = named.join(least_id, F.col("comp") == F.col("i_comp")).select("c_d", "cid")
    seen = vectors.join(counts, F.col("d") == F.col("n_d"), "left").join(named, F.col("d") == F.col("c_d"), "left")
    seen = materialize(seen.select("lo", "w", (F.coalesce("n", F.lit(0)) + F.col("w") - 1).cast("long").alias("n_links"),
                                   F.coalesce("cid", "lo").alias("comp"), "v"), "vector-components")
    alone = seen.where("w = 1").select(F.col("lo").alias("k_id"), "n_links", "comp")
    several = seen.where("w > 1").select("n_links", "comp", F.col("v").alias("s_v"))
    copies = rows.join(several, F.col("v") == F.col("s_v")).select("k_id", "n_links", "comp")
    zero = rows.where(~F.exists("v", lambda x: x != 0)).select("k_id")
    return alone.unionByName(copies).unionByName(zero.unionByName(left_out(df)).select(
        "k_id", F.lit(0).cast("long").alias("n_links"), F.col("k_id").alias("comp")))


ORACLE = """
WITH RECURSIVE ok AS (
  SELECT vec_id, embedding::DOUBLE[] AS e, sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS n FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x FOR x IN embedding IF x <> 0]) > 0),
links AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b
  ON a.vec_id <> b.vec_id AND list_dot_product(a.e, b.e) / (a.n * b.n) >= 0.95),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
comp AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT v.vec_id, coalesce(counts.n, 0)::BIGINT AS n_links, comp.component_id, v.vec_id = comp.component_id AS kept
FROM embeddings v JOIN comp ON comp.a = v.vec_id LEFT JOIN counts ON counts.a = v.vec_id
"""


@query("op11_embedding_dedup", ORACLE)
def op11_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = linked(read(spark, sf_dir, "embeddings"))
    named = [F.when(F.col(c) != LAST_ID, F.col(c)).alias(name) for c, name in (("k_id", "vec_id"), ("comp", "component_id"))]
    return found.select(named[0], "n_links", named[1], (F.col("k_id") == F.col("comp")).alias("kept"))
