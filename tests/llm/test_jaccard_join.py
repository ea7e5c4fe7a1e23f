import random
import re
from collections import Counter

import pytest
from edge import EDGE, SF_SMALL, docs, folder

from punctua.llm import jaccard_join as J
from punctua.llm.common import read

LAST = 2**63 - 1


def shingles(text):
    t = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    return {tuple(w[i:i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else ({tuple(w)} if w else set())


def brute(rows):
    ids = [LAST if i is None else i for i, _ in rows]
    s = [shingles(t) for _, t in rows]
    up = {i: i for i in ids}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for x in range(len(rows)):
        for y in range(x):
            same = len(s[x] & s[y])
            if same and 100 * same >= 85 * (len(s[x]) + len(s[y]) - same):
                a, b = sorted((root(ids[x]), root(ids[y])))
                up[b] = a
    none = lambda i: None if i == LAST else i
    return Counter((none(i), len(x), none(root(i))) for i, x in zip(ids, s))


def got(df):
    return Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect())


def near_copies():
    rng = random.Random(11)
    vocab = [f"t{i}" for i in range(3000)]
    rows, i = [], 1000
    for n in (4, 5, 8, 12, 20, 40, 41, 90, 200, 500):
        for _ in range(3):
            base = rng.choices(vocab, k=n)
            for _ in range(8):
                w = list(base)
                for _ in range(rng.randint(0, max(1, n // 30))):
                    w[rng.randrange(len(w))] = rng.choice(vocab)
                if rng.random() < 0.5:
                    w = w[:len(w) - rng.randint(0, len(w) // 7)]
                rows.append((rng.randint(0, 10**6), " ".join(w).upper() if rng.random() < 0.2 else " ".join(w)))
                i += 1
    return rows


@pytest.mark.parametrize("block", [J.BLOCK, 3])
def test_against_brute_force(spark, tmp, monkeypatch, block):
    monkeypatch.setattr(J, "BLOCK", block)
    rows = EDGE + near_copies()
    want = brute(rows)
    assert got(J.op9_jaccard_join(spark, folder(spark, tmp, rows))) == want
    assert sum(k[0] != k[2] for k in want) > 50


def test_small_table(spark):
    rows = [tuple(r) for r in read(spark, SF_SMALL, "documents").select("doc_id", "text").collect()]
    assert got(J.op9_jaccard_join(spark, SF_SMALL)) == brute(rows)


def test_one_of_each_keeps_columns_and_first(spark):
    rows = [(5, "a b c d e f"), (3, "a b c d e f"), (9, "other words in here"), (4, None), (9, "other words in here")]
    left = J.one_of_each(docs(spark, rows))
    assert left.columns == docs(spark, []).columns
    assert sorted(r["doc_id"] for r in left.collect()) == [3, 4, 9]


def test_empty(spark, tmp):
    assert J.op9_jaccard_join(spark, folder(spark, tmp, [])).count() == 0


@pytest.mark.parametrize("percent", [80, 85, 95])
def test_bands_bound_the_difference(percent):
    b = J.Bands(percent)
    b.upto(800)
    for a in range(1, 400):
        k = max(i for i, f in enumerate(b.first) if f <= a)
        for c in range(a, 100 * a // percent + 1):
            assert c < b.first[k + 2]
            most = (100 - percent) * (a + c) // (100 + percent)
            assert most < b.parts[k] - b.slack[k]


def test_hot_buckets_by_aggregation(spark, monkeypatch):
    """With all but single buckets hot, or only some of them, the links are those of the window path."""
    rows = near_copies()
    for frequent, keys in ((2, 10_000), (2, 50)):
        monkeypatch.setattr(J, "ONE_IN", 1)
        monkeypatch.setattr(J, "FREQUENT", frequent)
        monkeypatch.setattr(J, "HOT_KEYS", keys)
        found = J.linked(docs(spark, rows))
        out = Counter((None if r["k_id"] == LAST else r["k_id"], r["n"], None if r["comp"] == LAST else r["comp"])
                      for r in found.collect())
        assert out == brute(rows)


def test_id_with_a_copied_and_a_near_copied_text(spark, tmp):
    """Both texts of id 20 (and of the null id) link: one is an exact copy, the other a near copy."""
    one, two, three = (" ".join(f"{x}{i}" for i in range(100)) for x in "abc")
    rows = [(1, one), (20, one), (20, two), (30, two + " more"), (None, three), (None, one.upper()), (40, three + " more"), (50, "z")]
    want = brute(rows)
    assert {k[2] for k in want} == {1, 50}
    assert got(J.op9_jaccard_join(spark, folder(spark, tmp, rows))) == want
