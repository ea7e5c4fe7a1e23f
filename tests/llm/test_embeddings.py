"""Operators on embeddings against brute force, with the rows that every operator has to stand."""

import hashlib
import math
import os
import random
import sys
from collections import Counter, defaultdict

import numpy as np
import pytest
from edge import SF_SMALL
from pyspark.sql import types as T

from punctua.llm import embedding_dedup as D
from punctua.llm import hard_negatives as H
from punctua.llm import vector_codes as V

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))
from oracle_check import compare, duck  # noqa: E402

LAST = 2**63 - 1
SCHEMA = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())), T.StructField("label", T.IntegerType()),
    # names that operators might use themselves
    *[T.StructField(c, T.StringType()) for c in ("k_id", "v", "q", "d", "n", "part", "w", "cell", "r", "score", "id")],
])


def folder(spark, tmp, rows):
    spark.createDataFrame([(i, x, label, *["x"] * 11) for i, x, label in rows], SCHEMA).write.parquet(f"{tmp}/embeddings.parquet")
    return tmp


def some(seed=5, n=150, width=16):
    """Random vectors, groups of near and exact copies, and odd rows."""
    rng = np.random.default_rng(seed)
    rows = [(i * 7 % 1000, rng.normal(size=width).tolist(), int(rng.integers(0, 4))) for i in range(n)]
    for k in range(6):
        base = rng.normal(size=width)
        for i in range(10):
            x = base + rng.normal(size=width) * 0.25 * rng.random() * np.linalg.norm(base) / math.sqrt(width)
            rows.append((1000 + 100 * i + k, (x * rng.uniform(0.1, 20)).tolist(), k % 4))
    same = rng.normal(size=width).tolist()
    rows += [(i, same, 1) for i in (2000, 2001, 2002, 2003, 2003, None, None)] + [(2004, [2 * x for x in same], 2)]
    rows += [(3000, None, 1), (3001, [0.0] * width, 1), (3002, [float("nan")] + same[1:], 1), (3003, [None, *same[1:]], 2),
             (3004, [float("inf")] + same[1:], 2), (3100, same[:5], None), (3005, same[:5], 3), (3006, [], 3), (3006, [1.0], 3),
             (3200, [-0.0] * width, 0), (None, None, None), (3300, [1e-200] * width, 0), (3301, [2e-200] * width, 0),
             (-100, [-x for x in same], 1), (700, [x + 1e-3 for x in same], 1)]
    return rows


def counts(x):
    return x is not None and all(c is not None and math.isfinite(c) for c in x)


def padded(x, width):
    return list(x) + [0.0] * (width - len(x))


def scaled(x):
    """Divided by a power of two, so that squares neither vanish nor overflow."""
    top = max(map(abs, x), default=0)
    return [c / 2.0 ** math.floor(math.log2(top)) for c in x] if top else x


def brute_links(rows, least=0.95):
    width = max(len(x) for _, x, _ in rows if counts(x))
    at = [k for k, (_, x, _) in enumerate(rows) if counts(x) and any(x)]
    m = np.array([scaled(padded(rows[k][1], width)) for k in at])
    c = m @ m.T / np.outer(*[np.sqrt((m * m).sum(1))] * 2)
    up, links = list(range(len(rows))), Counter()

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, j in zip(*np.nonzero(c >= least)):
        if i != j:
            links[at[i]] += 1
            a, b = sorted((root(at[i]), root(at[j])))
            up[b] = a
    ids = [LAST if r[0] is None else r[0] for r in rows]
    least_id = {}
    for k, i in enumerate(ids):
        least_id[root(k)] = min(least_id.get(root(k), LAST), i)
    none = lambda i: None if i == LAST else i
    return Counter((none(i), links[k], none(least_id[root(k)]), i == least_id[root(k)]) for k, i in enumerate(ids))


@pytest.mark.parametrize("tile", [4096, 16])
def test_links_against_brute_force(spark, tmp, monkeypatch, tile):
    monkeypatch.setattr(D, "TILE", tile)
    rows = some()
    got = Counter((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in D.op11_embedding_dedup(spark, folder(spark, tmp, rows)).collect())
    want = brute_links(rows)
    assert got == want
    assert sum(n for (i, k, *_), n in want.items() if k) > 50


def test_links_in_one_pair_of_tiles():
    """Runs, boxes, chunks of dimensions and the dense and sparse ways of a pair of tiles, against all cosines."""
    import pyarrow as pa

    rng = np.random.default_rng(3)
    for n, width, noise in ((1300, 64, 0.02), (700, 40, 0.3), (900, 3, 0.0), (5, 100, 0.05)):
        x = rng.normal(size=(max(1, n // 40), width))[rng.integers(0, max(1, n // 40), n)] + noise * rng.normal(size=(n, width))
        u = x / np.linalg.norm(x, axis=1)[:, None]
        basis = np.linalg.eigh(u.T @ u)[1][:, ::-1].copy()
        cosine = u @ u.T
        for side in (np.full(n, 3), rng.integers(1, 3, n)):
            w = rng.integers(1, 4, n)
            table = pa.table({"d": np.arange(n) * 3, "w": w, "side": side, "v": list(x)})
            out = D.compare(table, basis, 0.95)
            ok = (cosine >= 0.95) & ~np.eye(n, dtype=bool)
            if side[0] != 3:
                ok &= side[:, None] != side[None]
            want = (ok * w[None]).sum(1)
            assert dict(zip(out["d"].to_pylist(), out["n"].to_pylist())) == {3 * i: k for i, k in enumerate(want.tolist()) if k}
            root = {a: b for a, b in zip(out["d"].to_pylist(), out["root"].to_pylist())}
            assert all(root[3 * i] == root[3 * j] <= 3 * i for i, j in zip(*np.nonzero(ok)))


def mined(rows):
    rows = [(i, x, (y + 1) % 10 if i is not None and i % 7 == 0 else y) for i, x, y in rows if y is not None and counts(x)]
    width = max(len(x) for _, x, _ in rows)
    q = [[math.floor(256 * c) for c in padded(x, width)] for _, x, _ in rows]
    out = []
    for a, (anchor, _, label) in enumerate(rows):
        if anchor is None or anchor % 100:
            continue
        score = [sum(x * y for x, y in zip(q[a], o)) for o in q]
        order = sorted((k for k in range(len(rows)) if k != a), key=lambda k: (-score[k], LAST if rows[k][0] is None else rows[k][0]))
        for p in [k for k in order if rows[k][2] == label][:5]:
            fits = [k for k in order if rows[k][2] != label and 80 * score[p] <= 100 * score[k] <= 100 * score[p]]
            out += [(anchor, rows[p][0], n, rows[k][0], score[p], score[k]) for n, k in enumerate(fits[:5], 1)]
    return Counter(out)


@pytest.mark.parametrize("block", [2048, 3])
def test_negatives_against_brute_force(spark, tmp, monkeypatch, block):
    monkeypatch.setattr(H, "ANCHORS", block)
    monkeypatch.setattr(H, "SLICE", 20 * block)
    rows = some(n=400)
    got = Counter(tuple(r[c] for c in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
                  for r in H.op12_hard_negatives(spark, folder(spark, tmp, rows)).collect())
    want = mined(rows)
    assert got == want
    assert len(want) > 50


def test_bounds_hold_every_score():
    rng = np.random.default_rng(8)
    for width, top in ((2, 5), (8, 300), (64, 10**6)):
        q = np.floor(rng.normal(size=(300, width)) * top)
        q[::50] = 0
        references = rng.normal(size=(5, width))
        references /= np.linalg.norm(references, axis=1)[:, None]
        n = H.norms(q)
        t = H.angles(q, n, references)
        starts = np.arange(0, 300, 32)
        least, most = H.bounds(n[:40], t[:40], n, t, starts)
        score = q[:40] @ q.T
        assert (np.maximum.reduceat(score, starts, axis=1) <= most).all() and (np.minimum.reduceat(score, starts, axis=1) >= least).all()


def coded(rows):
    kept = sorted(((LAST if i is None else i, x, y) for i, x, y in rows if counts(x)), key=lambda r: r[0])
    width = -(-max(len(x) for _, x, _ in kept) // 8) * 8
    size = width // 8
    fix = lambda x: max(-V.LIMIT, min(V.LIMIT, math.floor(4096 * x)))
    q = [(i, [fix(c) for c in padded(x, width)], y) for i, x, y in kept]
    q = sorted(q, key=lambda r: (r[0], r[1]))
    books = [[r[1][p * size:(p + 1) * size] for r in q[:16]] for p in range(8)]

    def near(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(book))

    def assign():
        return [[near(v[p * size:(p + 1) * size], books[p]) for p in range(8)] for _, v, _ in q]

    for _ in range(6):
        found = assign()
        for p in range(8):
            members = defaultdict(list)
            for (_, v, _), f in zip(q, found):
                members[f[p][1]].append(v[p * size:(p + 1) * size])
            for e, vs in members.items():
                books[p][e] = [sum(c) // len(vs) for c in zip(*vs)]
    found = assign()
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    error = [sum(d for d, _ in f) for f in found]
    by_label = Counter()
    for (_, _, y), e in zip(q, error):
        by_label[y] += e
    return Counter((None if i == LAST else i, "".join(f"{e:02x}" for _, e in f), err, by_label[y], digest)
                   for (i, _, y), f, err in zip(q, found, error))


def codes_of(df):
    return Counter(tuple(r[c] for c in ("vec_id", "code", "error", "label_error", "codebooks_sha256")) for r in df.collect())


@pytest.mark.parametrize("n,width", [(150, 16), (0, 11)])
def test_codes_against_brute_force(spark, tmp, n, width):
    rows = some(n=n, width=width)
    assert codes_of(V.op13_vector_codes(spark, folder(spark, tmp, rows))) == coded(rows)


def test_codes_of_fewer_vectors_than_entries(spark, tmp):
    rows = [(5, [0.1 * k for k in range(8)], 1), (None, [-3e30] * 8, None), (5, [0.1] * 7, None)]
    assert codes_of(V.op13_vector_codes(spark, folder(spark, tmp, rows))) == coded(rows)


def test_trie_order_does_not_matter():
    rng = random.Random(2)
    rows = np.array([[rng.randint(-3, 3) for _ in range(4)] for _ in range(500)])
    part = np.array([rng.randint(0, 2) for _ in range(500)])
    books = np.array([[[rng.randint(-3, 3) for _ in range(4)] for _ in range(6)] for _ in range(3)])
    want = ((rows[:, None, :] - books[part]) ** 2).sum(2)
    for order in (np.arange(500), np.lexsort((*rows.T[::-1], part))):
        entry, error = V.nearest(rows[order], part[order], books)
        assert (entry == want[order].argmin(1)).all() and (error == want[order].min(1)).all()


@pytest.mark.parametrize("op", [D.op11_embedding_dedup, H.op12_hard_negatives, V.op13_vector_codes])
def test_empty_and_without_vectors(spark, tmp, op):
    assert op(spark, folder(spark, f"{tmp}/a", [])).count() == 0
    n = op(spark, folder(spark, f"{tmp}/b", [(100, None, 1), (101, [float("nan")], 1)])).count()
    assert n == (2 if op is D.op11_embedding_dedup else 0)


@pytest.mark.parametrize("module,name", [(D, "op11_embedding_dedup"), (H, "op12_hard_negatives"), (V, "op13_vector_codes")])
def test_small_table_against_sql(spark, module, name):
    ok, message = compare(spark, duck(SF_SMALL), name, getattr(module, name), module.ORACLE, SF_SMALL)
    assert ok, message
