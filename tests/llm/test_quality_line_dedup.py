import hashlib
import re
import time
from collections import Counter

import numpy as np
import pytest
from edge import EDGE, SF_SMALL, docs, folder

from punctua.llm import line_dedup as L
from punctua.llm import quality as Q
from punctua.llm.common import read

SPACE = " \t\n\x0b\f\r"


def counts(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if x.strip(SPACE)]
    wins = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    c, hit = Counter(wins), set()
    for i, x in enumerate(wins):
        if c[x] > 1:
            hit.update(range(i, i + 5))
    return (len(w), sum(map(len, w)), sum(ch in "#*$%&|<>" for ch in t), len(lines) - len(set(lines)), len(hit),
            len(w) < 10 or 100 * len(hit) > 20 * len(w))


@pytest.fixture(scope="module")
def edge_dir(spark, tmp_path_factory):
    labels = spark.createDataFrame([(1, 1, 0), (8, 0, 0), (None, 0, 1), (9, None, None)], "doc_id long, quality int, toxic int")
    return folder(spark, str(tmp_path_factory.mktemp("edge")), EDGE + [(12, "tail # \x0b x\r\n\n x"), (13, "a b c d e a b c d e f")],
                  labels=labels)


def test_quality_counts(spark, edge_dir):
    texts = [tuple(r) for r in read(spark, edge_dir, "documents").select("doc_id", "text").collect()]
    rows = Q.op6_quality_rules(spark, edge_dir).collect()
    assert Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"],
                    r["base_failed"]) for r in rows) == Counter((i, *counts(t)) for i, t in texts)
    assert all(not r["kept"] for r in rows if r["base_failed"])


def test_quality_small_table(spark):
    texts = {r["doc_id"]: r["text"] for r in read(spark, SF_SMALL, "documents").collect()}
    for r in Q.op6_quality_rules(spark, SF_SMALL).collect():
        assert tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                    "base_failed")) == counts(texts[r["doc_id"]])


def test_rules_separate_labelled_documents(spark):
    sf = "/root/testdata/sf0.1"
    d, labels = read(spark, sf, "documents"), read(spark, sf, "labels")
    even = labels.where("doc_id % 2 = 0")
    rules = Q.fit(d, even)
    assert rules and Q.readable(rules)
    got = (Q.verdicts(d, rules).join(labels.where("doc_id % 2 = 1"), "doc_id").select("quality", "kept").collect())
    good = [r["kept"] for r in got if r["quality"] == 1]
    bad = [r["kept"] for r in got if r["quality"] == 0]
    assert np.mean(good) > 0.95 and np.mean(bad) < 0.05


def test_learn_finds_a_conjunction():
    rng = np.random.default_rng(1)
    x = rng.random((3000, len(Q.RATIOS)))
    bad = (x[:, 2] > 0.6) & (x[:, 5] <= 0.3)
    rules = Q.learn(x, bad, np.ones(len(x)))
    hit = np.zeros(len(x), bool)
    for r in rules:
        hit |= Q.covers(r, x)
    assert (hit == bad).mean() > 0.98


def test_quality_empty_and_single_class(spark, tmp):
    d = folder(spark, tmp, [], labels=spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert Q.op6_quality_rules(spark, d).count() == 0
    assert Q.fit(docs(spark, EDGE), spark.createDataFrame([(1, 1)], "doc_id long, quality int")) == []
    kept = Q.keep(docs(spark, EDGE), spark.createDataFrame([(1, 1)], "doc_id long, quality int"))
    assert kept.columns == docs(spark, []).columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(i for i, t in EDGE if not counts(t)[-1])


def chunks(lines):
    h = [int(hashlib.md5(x.encode()).hexdigest()[:8], 16) for x in lines]
    even = [((h[i - 1] if i else 0) * L.FACTOR + h[i]) % L.PRIME % 2 == 0 for i in range(len(h))]
    out, a = [], 0
    for i in range(len(h)):
        if i == len(h) - 1 or (1 <= i <= len(h) - 3 and even[i] and not even[i - 1]):
            out.append((a, i))
            a = i + 1
    return out


def removed(texts):
    """{(id, text): (lines, removed, kept text)}"""
    seen = {}
    for i, t in texts:
        if t is not None:
            lines = t.split("\n")
            for a, b in chunks(lines):
                c = "\n".join(lines[a:b + 1])
                if b > a and c.strip(SPACE):
                    seen.setdefault(c, {})[(2**63 - 1 if i is None else i, t, a)] = None
    out = {}
    for i, t in texts:
        if t is None:
            out[i, t] = (0, 0, "")
            continue
        lines, gone = t.split("\n"), set()
        for a, b in chunks(lines):
            c = "\n".join(lines[a:b + 1])
            if c in seen and min(seen[c], key=lambda k: (k[0], k[2])) != (2**63 - 1 if i is None else i, t, a):
                gone.update(range(a, b + 1))
        out[i, t] = (len(lines), len(gone), "\n".join(x for k, x in enumerate(lines) if k not in gone))
    return out


def test_line_dedup_against_brute_force(spark, tmp):
    block = "\n".join(f"shared line {i}" for i in range(12))
    rows = EDGE + [(30, f"own first\n{block}\nown last"), (31, f"x\ny\nz\n{block}"), (32, block), (33, block + "\n"), (34, "\n\n\n"),
                   (35, "\n\n\n"), (None, block), (36, f"{block}\n{block}"), (37, "é\nü"), (38, "é\nü"), (38, "é\nü")]
    d = folder(spark, tmp, rows)
    want = removed(rows)
    got = Counter((r["doc_id"], r["n_lines"], r["n_removed"], r["kept_sha256"]) for r in L.op8_line_dedup(spark, d).collect())
    assert got == Counter((i, want[i, t][0], want[i, t][1], hashlib.sha256(want[i, t][2].encode()).hexdigest()) for i, t in rows)
    assert sum(want[i, t][1] for i, t in rows) > 30
    left = L.dedup_lines(read(spark, d, "documents"))
    assert left.columns == docs(spark, []).columns
    assert Counter((r["doc_id"], r["text"]) for r in left.collect()) == Counter(
        (i, want[i, t][2] if t is not None else None) for i, t in rows
        if not want[i, t][1] or want[i, t][2].strip(SPACE))


def test_line_dedup_empty(spark, tmp):
    assert L.op8_line_dedup(spark, folder(spark, tmp, [])).count() == 0


def test_chunks_of_one_hash_and_other_bytes(spark, tmp, monkeypatch):
    """With a hash that says nothing, texts alone decide."""
    block = "\n".join(f"shared line {i}" for i in range(12))
    rows = [(30, f"own first\n{block}\nown last"), (31, f"x\ny\nz\n{block}"), (32, block), (36, f"{block}\n{block}"), (37, "p\nq"), (38, "r\ns")]
    want = removed(rows)
    real = L.F.xxhash64
    one = lambda *c: L.F.lit(7).cast("long") if "array_join" in str(c[0]) else real(*c)
    monkeypatch.setattr(L.F, "xxhash64", one)
    got = Counter((r["doc_id"], r["n_removed"], r["kept_sha256"]) for r in L.op8_line_dedup(spark, folder(spark, tmp, rows)).collect())
    assert got == Counter((i, want[i, t][1], hashlib.sha256(want[i, t][2].encode()).hexdigest()) for i, t in rows)


def test_line_dedup_of_long_texts_is_linear(spark):
    """Two texts of 500,000 lines, half of them the same."""
    shared = [f"shared line {i}" for i in range(250_000)]
    texts = [(k, "\n".join(f"own {k} {i}" if i % 1000 < 500 else shared[i // 1000 * 500 + i % 1000 - 500] for i in range(500_000))) for k in (1, 2)]
    began = time.time()
    left = {r["doc_id"]: r["text"] for r in L.dedup_lines(docs(spark, texts)).collect()}
    assert time.time() - began < 60
    assert left[1] == texts[0][1]
    assert left[2] == removed(texts)[2, texts[1][1]][2]
    assert left[2].count("\n") < 260_000
