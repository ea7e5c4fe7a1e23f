import hashlib
import random
import re

import pytest
from edge import EDGE, PASSAGE, SF_SMALL, folder

from punctua.llm import decontaminate as D
from punctua.llm import secrets as S
from punctua.llm.common import read

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(texts, items, width=10):
    out = []
    for i, t in texts:
        w, hit, found = words(t), set(), set()
        for item, b in items:
            v = words(b)
            n = min(width, len(v))
            wins = {tuple(v[k:k + n]) for k in range(len(v) - n + 1)} if n else set()
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in wins:
                    hit.update(range(k, k + n))
                    found.add(str(item))
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(),
                    bool(hit)))
    return sorted(out, key=str)


def got(df):
    return sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"])
                   for r in df.collect()), key=str)


ITEMS = [(1, " ".join(f"w{i}" for i in range(5, 30))), (2, "ONE"), (3, None), (4, ""), (5, "w60-w61, W62"), (6, "a a a a"),
         (7, "not here at all"), (10, " ".join(f"w{i}" for i in range(20, 31)))]


@pytest.fixture(scope="module")
def edge_dir(spark, tmp_path_factory):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    return folder(spark, str(tmp_path_factory.mktemp("edge")), EDGE, benchmark=items)


def test_decontamination_edges(spark, edge_dir):
    assert got(D.op2_decontamination(spark, edge_dir)) == brute(EDGE, ITEMS)


def test_decontamination_in_blocks(spark, edge_dir, monkeypatch):
    found = D.contamination(read(spark, edge_dir, "documents"), read(spark, edge_dir, "benchmark"), block_bytes=60)
    rows = sorted(((r["doc_id"], r["n_words"], sum(x["b"] - x["a"] for x in r["hit_ranges"]), len(r["hit_items"]))
                   for r in found.collect()), key=str)
    assert rows == sorted((x[:4] for x in brute(EDGE, ITEMS)), key=str)


def test_repeated_items_are_in_a_block_once(spark):
    items = ITEMS + [(None, "null id"), (None, "null id")] + [(1, ITEMS[0][1])] * 500
    blocks = list(D.item_blocks(spark.createDataFrame(items, "item_id long, text string"), 200))
    assert sorted((i for b in blocks for i in b), key=str) == sorted(set(items), key=str)
    assert len(blocks) < 10


def test_decontamination_small_table(spark):
    texts = [tuple(r) for r in read(spark, SF_SMALL, "documents").select("doc_id", "text").collect()]
    items = [tuple(r) for r in read(spark, SF_SMALL, "benchmark").select("item_id", "text").collect()]
    want = brute(texts, items)
    assert got(D.op2_decontamination(spark, SF_SMALL)) == want
    assert any(x[-1] for x in want)


def test_decontamination_empty(spark, tmp):
    d = folder(spark, tmp, EDGE, benchmark=spark.createDataFrame([], "item_id long, text string"))
    assert not any(r["contaminated"] for r in D.op2_decontamination(spark, d).collect())


def base_brute(text):
    kinds = [("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
              lambda m: len(m[2]) >= 8), ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 16),
             ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 32)]
    out = []
    for k, (name, p, ok) in enumerate(kinds):
        flags = re.I | re.A if name == "assign" else re.A
        out += [(m.start(), k, m.end(), name) for m in re.finditer(p, text or "", flags) if ok(m)]
    return sorted(out)


def secret_rows():
    rng = random.Random(3)
    b64 = "".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", k=64))
    return EDGE + [
        (20, 'é Password="hunter22x" and API_KEY: abcdefgh.ijk token= short secret = = x'), (21, "AKIA" + "ABCD1234EFGH5678 AKIAX"),
        (22, "deadbeef" * 5 + " " + "0" * 31), (23, f"plain {b64} plain"), (24, "x" * 200), (25, "token=" * 40 + "aaaaaaaaaaaa"),
        (26, "toKen=abcdefghijk ſecret=abcdefghijk"), (27, "tokentoken=abcdefghij")], b64


def test_secret_scan(spark, tmp):
    rows, b64 = secret_rows()
    found = {}
    for r in S.op10_secrets(spark, folder(spark, tmp, rows)).collect():
        found.setdefault(r["doc_id"], []).append(r)
    for i, t in rows:
        base = base_brute(t)
        text = ",".join(f"{n}:{a}:{b}" for a, _, b, n in base)
        want = tuple(sum(x[3] == k for x in base) for k in ("assign", "access", "hex"))
        match = [r for r in found[i] if r["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()]
        assert match and all((r["n_assign"], r["n_access"], r["n_hex"]) == want for r in match), i
        assert all(set(text.split(",")) - {""} <= set(r["spans"].split(",")) for r in match)
    assert found[23][0]["spans"] == "random:6:70"
    assert found[24][0]["spans"] == "" and all(r["n_random"] == 0 for r in found[2])
    assert sum(map(len, found.values())) == len(rows)


def test_secret_scan_empty(spark, tmp):
    assert S.op10_secrets(spark, folder(spark, tmp, [])).count() == 0


def test_secret_scan_small_table(spark):
    texts = {r["doc_id"]: r["text"] for r in read(spark, SF_SMALL, "documents").collect()}
    for r in S.op10_secrets(spark, SF_SMALL).collect():
        text = ",".join(f"{n}:{a}:{b}" for a, _, b, n in base_brute(texts[r["doc_id"]]))
        assert r["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_random_tokens_of_one_case_are_found(spark, tmp):
    rng = random.Random(5)
    lower, digits = "abcdefghijklmnopqrstuvwxyz", "0123456789"
    tokens = {i: "".join(rng.choices(a, k=96)) for i, a in enumerate((lower, lower + digits, (lower + digits).upper(), lower + "234567"))}
    prose = "the ordinary text of an article in the paper " * 5
    rows = [(i, f"some text {t}") for i, t in tokens.items()] + [(100 + i, prose + prose.upper()) for i in range(50)]
    found = {r["doc_id"]: r["spans"] for r in S.op10_secrets(spark, folder(spark, tmp, rows)).collect()}
    assert {i: s for i, s in found.items() if s} == {i: "random:10:106" for i in tokens}


def test_every_tested_token_is_counted(spark):
    rows = [(1, "x" * 30), (2, "y" * 19 + "==="), (3, "internationalization-of-the-word"), (4, "z" * 19)]
    scanned = S.scan(spark.createDataFrame(rows, "doc_id long, text string"))
    tokens = {r["doc_id"]: r["tokens"] for r in S.judged(scanned, S.power_sums(S.byte_counts(scanned))).collect()}
    assert {i: len(t) for i, t in tokens.items()} == {1: 1, 2: 1, 3: 1, 4: 0}
    assert all(t[0]["band"] == 1 for t in tokens.values() if t)
    assert all(tokens[i][0]["bin"] == S.BINS - 1 and not tokens[i][0]["ok"] for i in (1, 2))
