import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from edge import EDGE, SF_SMALL, folder

from punctua.llm import substring_dedup as S
from punctua.llm.common import grams, mix, read


def brute(rows, width=50):
    split = [(2**63 - 1 if i is None else i, i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    first = {}
    for k, _, w in split:
        for a in range(len(w) - width + 1):
            x = tuple(w[a:a + width])
            first[x] = min(k, first.get(x, k))
    out = Counter()
    for k, i, w in split:
        gone = set()
        for a in range(len(w) - width + 1):
            if first[tuple(w[a:a + width])] < k:
                gone.update(range(a, a + width))
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        out[i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    return out


def got(df):
    return Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in df.collect())


def planted():
    rng = random.Random(5)
    vocab = [f"t{i}" for i in range(400)]
    text = lambda n: rng.choices(vocab, k=n)
    passages = [text(n) for n in (49, 50, 51, 60, 90, 300)]
    rows = []
    for i in range(60):
        w = text(rng.randint(0, 150))
        for p in rng.sample(passages, rng.randint(0, 3)):
            a = rng.randint(0, max(0, len(p) - 50))
            w += p[a:a + rng.randint(40, 300)] + text(rng.randint(0, 40))
        rows.append((rng.randint(0, 10**6), " ".join(w)))
    return rows + [(5, "z " * 400), (4, "z " * 60), (6, "y z " * 100), (8, "z " * 49)]


@pytest.mark.parametrize("group", [S.GROUP, 2])
def test_against_brute_force(spark, tmp, monkeypatch, group):
    monkeypatch.setattr(S, "GROUP", group)
    monkeypatch.setattr(S, "SUFFIXES", 50)
    rows = EDGE + planted()
    want = brute(rows)
    assert got(S.op1_substring_dedup(spark, folder(spark, tmp, rows))) == want
    assert sum(k[2] > 0 for k in want) > 20


def test_small_table(spark):
    rows = [tuple(r) for r in read(spark, SF_SMALL, "documents").select("doc_id", "text").collect()]
    assert got(S.op1_substring_dedup(spark, SF_SMALL)) == brute(rows)


def test_empty(spark, tmp):
    assert S.op1_substring_dedup(spark, folder(spark, tmp, [])).count() == 0


def test_equal_windows_share_an_anchor():
    rng = np.random.default_rng(0)
    h = mix(rng.integers(0, 50, 500).astype(np.uint64))
    both = np.concatenate([h, mix(rng.integers(0, 50, 37).astype(np.uint64)), h])
    s = S.anchors(both, np.zeros(len(both), np.int64), 50, 16)
    place = {}
    for first, count, off in zip(s["first"], s["count"], s["off"]):
        for j in range(count):
            place[first + j] = off - j
    assert sorted(place) == list(range(len(both) - 49))
    assert all(place[i] == place[i + 537] for i in range(451))
    assert len(grams(h, 50)) == 451
