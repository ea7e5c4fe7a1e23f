"""The near-duplicate stage: five-word shingles, linked at a similarity of 0.8 or more."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from edge import EDGE, docs
from test_jaccard_join import LAST, near_copies

import corpus_pipeline as C
from punctua.llm import jaccard_join as J


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def similarity(x, y, k):
    x, y = shingles(x, k), shingles(y, k)
    return len(x & y) / len(x | y)


def kept(rows, k=5, percent=80):
    """Brute force: (id, text) of the rows that stay; a component's smallest id stays. Ids and texts are vertices; of rows
    that repeat one with words the first stays."""
    v = sorted({(LAST if i is None else i, t or "") for i, t in rows})
    s = [shingles(t, k) for _, t in v]
    up = list(range(len(v)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for x in range(len(v)):
        for y in range(x):
            same = len(s[x] & s[y])
            if same and 100 * same >= percent * (len(s[x]) + len(s[y]) - same):
                a, b = sorted((root(x), root(y)))
                up[b] = a
    seen, out = set(), []
    for i, t in rows:
        at = v.index((LAST if i is None else i, t or ""))
        if root(at) == at and (at not in seen or not s[at]):
            seen.add(at)
            out.append((i, t))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=str)


def test_copies_between_80_and_85_percent_go(spark):
    base = [f"q{i}" for i in range(100)]
    edited = list(base)
    edited[30], edited[70] = "other", "words"
    two = [(1, " ".join(base)), (2, " ".join(edited))]
    assert 0.80 <= similarity(two[0][1], two[1][1], 5) < 0.85 and similarity(two[0][1], two[1][1], 4) < 0.85
    assert rows_of(C.near_duplicates(spark, docs(spark, two), "")) == two[:1]
    assert rows_of(J.one_of_each(docs(spark, two))) == two  # op9 keeps its own contract


def test_one_row_of_equal_ones_stays(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(None, text), (None, text), (8, "one text"), (8, "one text"), (8, "one text"), (3, "short"), (None, "")]
    assert rows_of(C.near_duplicates(spark, docs(spark, rows), "")) == sorted([(None, text), (8, "one text"), (3, "short"), (None, "")], key=str)


def chained(n=60, words=120, step=7):
    """Near copies in chains: each text differs from the one before in a few places, so ends are far apart."""
    rng = random.Random(4)
    out, text = [], [f"c{i}" for i in range(words)]
    for k in range(n):
        out.append((5000 + (k * 37) % n, " ".join(text)))
        for _ in range(rng.randint(1, step)):
            text[rng.randrange(words)] = f"n{rng.randrange(10**6)}"
    return out


@pytest.mark.parametrize("block,shingles,star,ids", [(2048, 1 << 20, 2048, 10**6), (4, 1 << 20, 3, 0), (2048, 700, 2048, 2)])
def test_left_members_of_buckets(spark, monkeypatch, block, shingles, star, ids):
    """Components that stars do not join, in one block or many, by members or by shingles; ids broadcast or not."""
    monkeypatch.setattr(J, "BROADCAST_IDS", ids)
    monkeypatch.setattr(J, "BLOCK", block)
    monkeypatch.setattr(J, "BLOCK_SHINGLES", shingles)
    monkeypatch.setattr(J, "STAR", star)
    rows = chained()
    assert rows_of(C.near_duplicates(spark, docs(spark, rows), "")) == kept(rows)


def test_a_block_sends_spanning_links_only():
    """All members of a block link: n - 1 links leave it, none from a bucket that is not the smallest shared one."""
    n = 50
    text = [" ".join(f"w{k}" for k in range(104)) + f" x{i}" for i in range(n)]
    bits = np.zeros((n, J.BITS // 8), np.uint8)
    table = {"key": [7] * n, "p": [0] * n, "q": [0] * n, "own": [0] * n, "id": list(range(n)), "comp": list(range(n)), "n": [101] * n,
             "bits": [b.tobytes() for b in bits], "text": text, "keys": [[7, 9]] * n}
    t = pa.table({k: pa.array(v) for k, v in table.items()})
    assert J.spanning(t, 5, 80).num_rows == n - 1
    assert J.marks(t, 80).num_rows == n
    other = t.set_column(t.schema.get_field_index("keys"), "keys", pa.array([[3, 7]] * n, pa.list_(pa.int64())))
    assert J.spanning(other, 5, 80) is None and J.own_marks(other, 80) is None
    assert J.own_marks(t, 80).num_rows == n


def test_sketches_bound_the_difference(spark):
    """Positions that differ are never more than shingles that do, and many where many do, for sets of any size."""
    rng = random.Random(9)
    rows = []
    for n in (3, 200, 1500, 1501, 6000, 12000):
        base = [f"b{rng.randrange(10**9)}" for _ in range(n)]
        for change in (0, n // 50, n // 3, n):
            rows.append((len(rows), " ".join([f"c{rng.randrange(10**9)}" if i < change else w for i, w in enumerate(base)])))
    got = {r["k_id"]: r for r in J.sets(spark.createDataFrame(rows, "k_id long, text string").withColumn("k_text", J.F.lit(0).cast("long")), 5).collect()}
    for i, x in rows:
        for j, y in rows:
            if i < j:
                bits = [bytes(got[k]["bits"]) for k in (i, j)]
                size = min(map(len, bits))
                far = int(np.bitwise_count(J.folded(bits[:1], size) ^ J.folded(bits[1:], size)).sum())
                apart, total = len(shingles(x, 5) ^ shingles(y, 5)), got[i]["n"] + got[j]["n"]
                assert far <= apart
                if apart == total and total > 300 and 0.5 < got[i]["n"] / got[j]["n"] < 2:
                    assert far * 180 > 20 * total * 2


def test_stage_against_brute_force(spark):
    rows = [r for r in EDGE if r[0] != 7] + near_copies()
    want = kept(rows)
    assert rows_of(C.near_duplicates(spark, docs(spark, rows), "")) == want
    assert len(want) < len(kept(rows, 4, 85))


def test_only_the_linked_texts_of_shared_ids_go(spark):
    """Clean texts without an id, or under the id of a copy, stay; links do not cross between the texts of an id."""
    one, two, three = (" ".join(f"{x}{i}" for i in range(100)) for x in "abc")
    rows = [(1, one), (None, one + " more"), (None, two), (None, three), (5, two + " more"), (7, one), (7, three + " more"), (7, "own"),
            (8, "single"), (8, "single"), (None, None), (None, None), (9, "  "), (9, "  ")]
    want = sorted([(1, one), (5, two + " more"), (7, three + " more"), (7, "own"), (8, "single"), (None, None), (None, None), (9, "  "),
                   (9, "  ")], key=str)
    assert kept(rows) == want
    assert rows_of(C.near_duplicates(spark, docs(spark, rows), "")) == want
