import math
import zlib
from collections import Counter

import numpy as np
import pytest
from edge import EDGE, docs, folder

from punctua.llm import language_id as G
from punctua.llm.common import read


@pytest.mark.parametrize("stride", [1, 4])
def test_gradient_is_that_of_the_loss(stride):
    rng = np.random.default_rng(0)
    net = G.Network(3, hidden=3, stride=stride)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    x, y = rng.integers(97, 101, (4, 16)).astype(np.uint8), np.array([0, 1, 2, 1])
    mask = np.arange(16) < np.array([16, 9, 1, 12])[:, None]
    _, g = net.loss(x, y, mask)
    for k, v in net.p.items():
        flat, grad = v.reshape(-1), g[k].reshape(-1)
        for i in rng.choice(np.flatnonzero(np.abs(grad) > 1e-6), 5):
            keep = flat[i]
            flat[i] = keep + 1e-3
            up = net.loss(x, y, mask)[0]
            flat[i] = keep - 1e-3
            down = net.loss(x, y, mask)[0]
            flat[i] = keep
            assert abs((up - down) / 2e-3 - grad[i]) < 2e-4 + 0.02 * abs(grad[i]), k


@pytest.mark.parametrize("stride", [1, 4])
def test_fast_positions_equal_the_training_network(stride):
    rng = np.random.default_rng(2)
    net = G.Network(4, stride=stride)
    x = rng.integers(0, 256, (5, G.WIDTH)).astype(np.uint8)
    q = net.positions(x, net.tables())
    assert np.allclose(q.sum(0), 1, atol=1e-4)
    for c in range(4):
        loss, _ = net.loss(x, np.full(5, c), np.ones((5, G.WIDTH), bool))
        assert abs(-np.log(q[c]).mean() - loss) < 1e-3


def test_segments_hold_every_byte():
    data = np.arange(600, dtype=np.int64).astype(np.uint8)
    x, text, length = G.cut(data, np.array([0, 0, 128, 129, 600]))
    assert length.sum() == 600 and (x[:, 0] == data[[0, 128, 129, 257, 385, 513]]).all()
    assert text.tolist() == [1, 2, 3, 3, 3, 3]


def slow_positions(net, segment):
    """Probabilities of each byte of one segment: the network written out for single numbers, a byte at a time."""
    h, p = net.h, {k: v.astype(np.float64) for k, v in net.p.items()}
    sigmoid = lambda v: 1 / (1 + math.exp(-v))
    states = [[0.0] * (2 * h) for _ in segment]
    for d, order in enumerate((range(len(segment)), range(len(segment) - 1, -1, -1))):
        s = [0.0] * h
        for t in order:
            a = [p["e"][d, 0, segment[t], i] + p["bias"][d, i] for i in range(3 * h)]
            b = [sum(s[j] * p["u"][d, j, i] for j in range(h)) for i in range(3 * h)]
            z, r = [sigmoid(a[i] + b[i]) for i in range(h)], [sigmoid(a[h + i] + b[h + i]) for i in range(h)]
            c = [math.tanh(a[2 * h + i] + r[i] * b[2 * h + i]) for i in range(h)]
            s = [s[i] + z[i] * (c[i] - s[i]) for i in range(h)]
            states[t][d * h:(d + 1) * h] = s
    out = []
    for s in states:
        e = [math.exp(sum(s[i] * p["w"][i, k] for i in range(2 * h)) + p["v"][k]) for k in range(net.classes)]
        out.append([x / sum(e) for x in e])
    return out


def test_predictions_against_a_byte_at_a_time(spark):
    """Labels and scores of whole texts, pooled over all positions, by the network written out."""
    net = G.Network(3, hidden=4, seed=1)
    net.p["w"] *= 5
    texts = [(1, "short"), (2, "Ünïcödé 你好 text, over more than one segment. " * 14), (3, "a" * G.SEGMENT), (4, "b" * (G.SEGMENT + 1)), (5, "12 !")]
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in G.predict(docs(spark, texts), (["x", "y", "z"], net)).collect()}
    for i, t in texts[:4]:
        data, total = t.encode(), np.zeros(3)
        for at in range(0, len(data), G.SEGMENT):
            piece = data[at:at + G.SEGMENT]
            padded = list(piece) + [G.PAD] * (G.SEGMENT - len(piece))
            total += np.sum(slow_positions(net, padded)[:len(piece)], axis=0)
        assert got[i][0] == "xyz"[int(total.argmax())]
        assert abs(got[i][1] - total.max() / len(data)) < 1e-4
    assert got[5] == ("und", 0.0)


def test_same_model_whatever_row_of_a_repeated_id_comes_first(spark):
    rows = [(i % 40, f"{'der die das und ist' if i % 2 else 'the and of to in'} {i}", "de" if i % 2 else "en") for i in range(120)]
    one, two = (G.fit(docs(spark, r).repartition(k), rounds=3)[1].p for r, k in ((rows, 1), (rows[::-1], 5)))
    assert all((one[k] == two[k]).all() for k in one)


def test_held_out_accuracy(spark):
    d = read(spark, "/root/testdata/sf0.01", "documents")
    rows = G.predict(d, G.fit(d)).join(d.select(d.doc_id.alias("i"), "lang", "n_chars"), G.F.expr("doc_id = i")).collect()
    held = [r for r in rows if r["held_out"]]
    assert all((zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) == r["held_out"] for r in rows)
    assert np.mean([r["lang_pred"] == r["lang"] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_edges(spark, tmp):
    rows = [(i, t, "en") for i, t in EDGE] + [(50, "123 !!", "en"), (51, "你好", None), (52, "́ 7", "en"), (53, "der die das" * 9, "de")]
    got = G.op3_language_id(spark, folder(spark, tmp, rows)).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in rows)
    by = {r["doc_id"]: r for r in got}
    assert [by[i]["lang_pred"] for i in (3, 4, 5, 50, 52)] == ["und"] * 5 and by[51]["lang_pred"] in ("en", "de")
    assert by[None]["held_out"] and by[3]["score"] == 0


def test_nothing_to_learn(spark):
    assert G.fit(docs(spark, [(1, "words", None)])) is None
    got = G.predict(docs(spark, [(1, "words"), (2, None)]), None).collect()
    assert [r["lang_pred"] for r in got] == ["und"] * 2
