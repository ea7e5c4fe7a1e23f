"""Language identification by a bidirectional gated recurrent network over bytes, trained and run in numpy.

A text's UTF-8 bytes are cut into segments of SEGMENT bytes. One gated recurrent layer reads a segment forwards and one
backwards, a byte at a step; from both states every byte position gets a probability for each language. (A network may also
take ``stride`` bytes at a step, and then labels them from one state; the query does not.) A document's probabilities are the mean over all its positions. Training is back-propagation through time with Adam on
the driver, over a bounded sample: at most PER_LANG labelled documents of each language (smallest hashes of their
ids) and SLICES slices of SLICE characters of each, spread over the whole text. Prediction reads every byte of every
text, inside Spark tasks.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; so is everything if nothing could be
learned; a null ``doc_id`` counts as held out; repeated rows get the same result; an empty table gives no rows; columns
beside ``doc_id``, ``text`` and ``lang`` are ignored, and ``lang`` is read for training only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from punctua.llm.catalog import query
from punctua.llm.common import read, steps

PER_LANG, SLICES, SLICE = 150, 6, 160
HIDDEN, STEPS, BATCH = 8, 300, 96
#: Bytes that the network reads at a step; bytes of a segment in training and in prediction.
STRIDE, WIDTH, SEGMENT = 1, 128, 512
PAD = 0x20


class Network:
    """Parameters by name: e (2, stride, 256, 3h) input weights of each byte of a step, u (2, h, 3h), bias (2, 3h), w, v.

    The three blocks of 3h are the update gate, the reset gate and the candidate.
    """

    def __init__(self, classes: int, hidden: int = HIDDEN, seed: int = 7, stride: int = STRIDE):
        r, h = np.random.default_rng(seed), hidden
        self.h, self.classes, self.stride = h, classes, stride
        self.p = {"e": r.normal(0, 0.1, (2, stride, 256, 3 * h)), "u": r.normal(0, 0.3, (2, h, 3 * h)), "bias": np.zeros((2, 3 * h)),
                  "w": r.normal(0, 0.3, (2 * h, stride * classes)), "v": np.zeros(stride * classes)}
        self.p = {k: x.astype(np.float32) for k, x in self.p.items()}

    def loss(self, x: np.ndarray, y: np.ndarray, mask: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross-entropy over the masked byte positions of segments ``x`` (n, width), and its gradient."""
        n, h, p, size = len(x), self.h, self.p, self.stride
        frames = x.reshape(n, -1, size)
        t_all = frames.shape[1]
        states, caches = np.zeros((t_all, n, 2 * h), np.float32), ([], [])
        for d in range(2):
            s = np.zeros((n, h), np.float32)
            for t in range(t_all) if d == 0 else range(t_all - 1, -1, -1):
                a = p["bias"][d] + sum(p["e"][d, k][frames[:, t, k]] for k in range(size))
                b = s @ p["u"][d]
                gates = 1 / (1 + np.exp(-(a[:, :2 * h] + b[:, :2 * h])))
                z, r = gates[:, :h], gates[:, h:]
                c = np.tanh(a[:, 2 * h:] + r * b[:, 2 * h:])
                caches[d].append((t, s, z, r, c, b[:, 2 * h:]))
                s = s + z * (c - s)
                states[t, :, d * h:(d + 1) * h] = s
        logits = (states @ p["w"] + p["v"]).reshape(t_all, n, size, self.classes)
        logits -= logits.max(-1, keepdims=True)
        q = np.exp(logits)
        q /= q.sum(-1, keepdims=True)
        m = mask.reshape(n, t_all, size).transpose(1, 0, 2)[..., None] / max(mask.sum(), 1)
        right = np.take_along_axis(q, np.broadcast_to(y[None, :, None, None], (t_all, n, size, 1)), -1)
        loss = float(-(np.log(right + 1e-9) * m).sum())
        dq = q * m
        np.put_along_axis(dq, np.broadcast_to(y[None, :, None, None], (t_all, n, size, 1)), (right - 1) * m, -1)
        dq = dq.reshape(t_all, n, -1).astype(np.float32)
        g = {k: np.zeros_like(v) for k, v in p.items()}
        g["w"] = np.einsum("tni,tnj->ij", states, dq, optimize=True)
        g["v"] = dq.sum((0, 1))
        ds = dq @ p["w"].T
        for d in range(2):
            carry, da_all = np.zeros((n, h), np.float32), np.zeros((t_all, n, 3 * h), np.float32)
            for t, s, z, r, c, bc in reversed(caches[d]):
                ds_t = ds[t, :, d * h:(d + 1) * h] + carry
                dc = ds_t * z * (1 - c * c)
                db = np.concatenate([ds_t * (c - s) * z * (1 - z), dc * bc * r * (1 - r), dc * r], 1)
                da_all[t, :, :2 * h], da_all[t, :, 2 * h:] = db[:, :2 * h], dc
                g["u"][d] += s.T @ db
                carry = ds_t * (1 - z) + db @ p["u"][d].T
            g["bias"][d] = da_all.sum((0, 1))
            flat = da_all.transpose(1, 0, 2).reshape(-1, 3 * h)
            for k in range(size):
                np.add.at(g["e"][d, k], frames[:, :, k].ravel(), flat)
        return loss, g

    def train(self, x: np.ndarray, y: np.ndarray, mask: np.ndarray, rounds: int = STEPS, rate: float = 0.02) -> list[float]:
        """Adam on random batches with as many segments of each class as chance gives equal weight."""
        r, losses = np.random.default_rng(1), []
        first, second = ({k: np.zeros_like(v) for k, v in self.p.items()} for _ in range(2))
        by_class = [np.flatnonzero(y == c) for c in range(self.classes)]
        by_class = [c for c in by_class if len(c)]
        for step in range(1, rounds + 1):
            pick = np.concatenate([r.choice(c, max(1, BATCH // len(by_class))) for c in by_class])
            loss, g = self.loss(x[pick], y[pick], mask[pick])
            losses.append(loss)
            lr = rate * min(1.0, 2 * (1 - step / (rounds + 1)))
            for k, v in self.p.items():
                first[k] += 0.1 * (g[k] - first[k])
                second[k] += 0.01 * (g[k] ** 2 - second[k])
                v -= lr * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-8)
        return losses

    def tables(self) -> np.ndarray:
        """Input weights with the bias: (direction, byte of a step, byte value, 3h)."""
        e = self.p["e"].copy()
        e[:, 0] += self.p["bias"][:, None]
        return e

    def positions(self, x: np.ndarray, tables: np.ndarray) -> np.ndarray:
        """Probabilities (class, segment, byte) of segments ``x`` (n, width) of bytes."""
        n, h, c, size = len(x), self.h, self.classes, self.stride
        values = x.reshape(n, -1, size).transpose(1, 2, 0).astype(np.intp)
        t_all = len(values)
        states = np.empty((2 * h, t_all, n), np.float32)
        for d in range(2):
            s, u = np.zeros((n, h), np.float32), self.p["u"][d]
            for t in range(t_all) if d == 0 else range(t_all - 1, -1, -1):
                a = tables[d, 0].take(values[t, 0], axis=0)
                for k in range(1, size):
                    a += tables[d, k].take(values[t, k], axis=0)
                b = s @ u
                gates = a[:, :2 * h] + b[:, :2 * h]
                gates *= 0.5  # a logistic function is a shifted hyperbolic tangent
                np.tanh(gates, out=gates)
                gates += 1
                gates *= 0.5
                k = b[:, 2 * h:] * gates[:, h:]
                k += a[:, 2 * h:]
                np.tanh(k, out=k)
                k -= s
                k *= gates[:, :h]
                s = s + k
                states[d * h:(d + 1) * h, t] = s.T
        logits = self.p["w"].T @ states.reshape(2 * h, -1) + self.p["v"][:, None]
        q = np.exp(np.clip(logits, -40, 40)).reshape(size, c, t_all, n)
        q /= q.sum(1, keepdims=True)
        return q.transpose(1, 3, 2, 0).reshape(c, n, t_all * size)


def cut(data: np.ndarray, offs: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Segments (n, width) of texts, padded with spaces; the text of each, and the bytes in it."""
    sizes = np.diff(offs)
    count = -(-sizes // width)
    text = np.repeat(np.arange(len(sizes)), count)
    k = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    begin = offs[text] + k * width
    length = np.minimum(width, offs[text + 1] - begin) if len(text) else begin
    at = begin[:, None] + np.arange(width)
    inside = np.arange(width) < length[:, None]
    x = np.where(inside, data[np.minimum(at, max(len(data) - 1, 0))] if len(data) else np.uint8(PAD), np.uint8(PAD))
    return x.astype(np.uint8), text, length


def held_out() -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0


def fit(docs: DataFrame, rounds: int = STEPS, stride: int = STRIDE) -> tuple[list[str], Network] | None:
    """Languages and network learned from the sample of documents that are not held out."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out())
    rank = F.row_number().over(W.partitionBy("lang").orderBy(F.xxhash64("doc_id"), F.col("doc_id")))
    ids = known.select("doc_id", "lang").withColumn("rank", rank).where(F.col("rank") <= PER_LANG).select(
        F.col("doc_id").alias("s_id")).distinct()
    n = F.length("text")
    slices = F.transform(F.sequence(F.lit(0), F.lit(SLICES - 1)), lambda i: F.substring(
        F.col("text"), (F.lit(1) + F.floor(n * i / SLICES)).cast("int"), F.lit(SLICE)))
    rows = (known.join(F.broadcast(ids), F.col("doc_id") == F.col("s_id"))  # PER_LANG ids of each language at most
            .groupBy("doc_id", "lang").agg(F.min(F.struct(F.xxhash64("text").alias("of"), slices.alias("parts"))).alias("s"))
            .select("doc_id", "lang", "s.parts").collect())  # of rows that repeat an id and language always the same one
    rows.sort(key=lambda r: (r["lang"], r["doc_id"]))
    langs = sorted({r["lang"] for r in rows})
    parts = [(langs.index(r["lang"]), s.encode()) for r in rows for s in dict.fromkeys(r["parts"]) if s]
    if not parts:
        return None
    raw = [b for _, b in parts]
    x, text, length = cut(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    y = np.array([k for k, _ in parts])[text]
    net = Network(len(langs), stride=stride)
    net.train(x, y, np.arange(WIDTH) < length[:, None], rounds)
    return langs, net


def predict(docs: DataFrame, model: tuple[list[str], Network] | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of ``docs``."""
    langs, net = model or (["und"], None)
    shared = docs.sparkSession.sparkContext.broadcast(net)  # a few thousand weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        tables = net.tables() if net is not None else None
        for batch in batches:
            pred, score = [], []
            for a, b, data, offs in steps(batch.column("text")):
                total = np.zeros((b - a, len(langs)))
                ascii_letter = ((data | 0x20) >= 0x61) & ((data | 0x20) <= 0x7A)
                letters = np.diff(np.r_[0, np.cumsum(ascii_letter)][offs])
                if net is not None:
                    x, text, length = cut(data, offs, SEGMENT)
                    for at in range(0, len(x), 1024):
                        q = net.positions(x[at:at + 1024], tables)
                        q *= np.arange(SEGMENT) < length[at:at + 1024, None]
                        sums = q.sum(2, dtype=np.float64)
                        for c in range(len(langs)):
                            total[:, c] += np.bincount(text[at:at + 1024], sums[c], b - a)
                size = np.diff(offs)
                for i in range(b - a):
                    has = letters[i] > 0 or any(ch.isalpha() for ch in data[offs[i]:offs[i + 1]].tobytes().decode())
                    best = int(total[i].argmax())
                    pred.append(langs[best] if has else "und")
                    score.append(min(1.0, total[i, best] / size[i]) if has else 0.0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(pred, pa.string()),
                                              pa.array(score, pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


@query("op3_language_id")
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return predict(docs, fit(docs))
