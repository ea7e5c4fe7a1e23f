import hashlib
import random
import re
import time
from collections import Counter

from edge import EDGE, SF_SMALL, folder
from pyspark.sql import functions as F

from punctua.llm import pii as P
from punctua.llm.common import read


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        v = int(c) * (2 if i % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def brute(text):
    only = lambda m: re.sub("[^0-9]", "", m[0])
    kinds = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
             ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m[0].split("."))),
             ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(only(m)) <= 19 and luhn(only(m))),
             ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(only(m)) <= 15)]
    return [(n, m.start(), m.end()) for n, p, ok in kinds for m in re.finditer(p, text or "") if ok(m)]


def check(rows, got):
    want = Counter()
    for i, t in rows:
        b = brute(t)
        text = ",".join(f"{n}:{s}:{e}" for n, s, e in b)
        want[(i, *(sum(x[0] == k for x in b) for k in P.KINDS), hashlib.sha256(text.encode()).hexdigest())] += 1
    assert Counter((r["doc_id"], *(r[f"n_{k}"] for k in P.KINDS), r["base_sha256"]) for r in got) == want


ODD = [(100, "é\U0001f600 a@b.c a@b-c.com+x@y.zz b@c x.@y..z @q.w a@b@c.d me@x.y.z."), (101, "1.2.3.4.5.6.7.8 256.1.1.1 000255.0.0.01 9.9.9"),
       (102, "4111 1111 1111 1111 and 4111-1111-1111-1112 41111111111111111111111 4111  1111111111111111"),
       (103, "+1 (017) 555-7713 +44 20 7946 0958. +1 2 +12345678901234567 ++49 30 123456 +7-"), (104, "+" * 50 + "1" * 3000 + "@" * 100),
       (105, "a.b-" * 3000 + "@x" + ".y" * 3000), (106, "1 2-" * 4000), (107, "1." * 4000 + "5"), (108, "call 212-555-0142 or jane (at) mail (dot) org")]


def test_base_spans(spark, tmp):
    rows = EDGE + ODD
    got = P.op4_pii(spark, folder(spark, tmp, rows)).collect()
    check(rows, got)
    texts = {i: t for i, t in ODD}
    for r in got:
        spans = [x.split(":") for x in r["spans"].split(",") if x]
        assert [s[0] for s in spans] == sorted((s[0] for s in spans), key=P.KINDS.index)
        if r["doc_id"] in texts:
            assert {(n, s, e) for n, s, e in brute(texts[r["doc_id"]])} <= {(n, int(s), int(e)) for n, s, e in spans}


def test_small_table_and_added_spans(spark, tmp):
    texts = [(r["doc_id"], r["text"]) for r in read(spark, SF_SMALL, "documents").select("doc_id", "text").collect()]
    texts += [(10_000, "please call 212-555-0142 or write jane (at) mail (dot) org today"), (10_001, "order 212-555-0142x")]
    got = P.op4_pii(spark, folder(spark, tmp, texts)).collect()
    check(texts, got)
    by = {r["doc_id"]: r for r in got}
    assert by[10_000]["spans"] == "email:34:58,phone:12:24"
    assert by[10_001]["spans"] == ""


def test_empty(spark, tmp):
    assert P.op4_pii(spark, folder(spark, tmp, [])).count() == 0


def test_expectation_maximisation_finds_the_good_labelers():
    import random

    rng, counts = random.Random(0), Counter()
    for _ in range(20_000):
        true = rng.random() < 0.4
        vote = lambda right: (1 if true else -1) if rng.random() < right else (-1 if true else 1)
        counts[vote(0.9), vote(0.8), vote(0.85), vote(0.5), 0] += 1
    prior, tables = P.reliabilities(dict(counts))
    assert abs(prior - 0.4) < 0.03
    assert abs(tables[0][1][0] - 0.9) < 0.03 and abs(tables[3][1][0] - 0.5) < 0.05
    w = P.classifier(dict(counts), {v: P.posterior(v, prior, tables) for v in counts})
    assert w[1] > w[2] > abs(w[4])


def test_scan_and_overlaps(spark):
    rng = random.Random(6)
    rows = []
    for k in range(60):
        spans = [(rng.randint(0, 90), rng.randint(1, 9)) for _ in range(rng.choice([0, 1, 2, 7, 16, 33]))]
        cands = sorted((rng.randint(0, 90), rng.randint(1, 9)) for _ in range(rng.choice([0, 1, 12])))
        rows.append((k, [(s, s + n) for s, n in spans], [(s, s + n) for s, n in cands], [rng.randint(0, 9) for _ in spans]))
    kind = "array<struct<s:int,e:int>>"
    df = spark.createDataFrame(rows, f"k int, b {kind}, c {kind}, x array<int>")
    got = df.select("k", P.apart(F.col("c"), F.col("b")).alias("c"), P.scanned(F.col("x"), lambda a, b: a + b).alias("x")).collect()
    for r in got:
        _, b, c, x = rows[r["k"]]
        assert [tuple(s) for s in r["c"]] == [s for s in c if not any(t[0] < s[1] and s[0] < t[1] for t in b)]
        assert r["x"] == [sum(x[:i + 1]) for i in range(len(x))]


def test_many_matches_in_one_text(spark, tmp):
    """200,000 addresses of one text, and loose candidates among base spans."""
    ips = " ".join(f"{i % 256}.{i // 256 % 256}.7.{i % 199}" for i in range(200_000))
    mixed = " ".join(f"10.0.{i % 200}.1 call 212-555-{i % 10000:04d}" for i in range(20_000))
    began = time.time()
    got = {r["doc_id"]: r for r in P.op4_pii(spark, folder(spark, tmp, [(1, ips), (2, mixed)])).collect()}
    assert time.time() - began < 90
    assert got[1]["n_ip"] == 200_000 and got[1]["n_spans"] >= 200_000
    assert got[2]["n_ip"] == 20_000
    check([(2, mixed)], [got[2]])
