"""Secret scan: fixed patterns, and a battery of randomness tests on long tokens.

Base spans come from three patterns. Beyond them every token of 20 or more characters is tested. Its encoding is
inferred from its characters (hex, letters of one case, base32, these with digits, letters and digits, base64), which
gives the alphabet. Three
statistics follow: chi-squared against the uniform alphabet, Wald-Wolfowitz runs above and below the alphabet's
middle, and the lag-1 serial correlation of the alphabet positions. Against the null "a token of ordinary text",
whose character frequencies are counted over all documents, the chi-squared statistic gives a p-value that falls as
a random token grows longer; Benjamini-Hochberg within bands of length picks the discoveries, over all tokens of
the corpus (from a histogram of p-values of fixed size; a token whose randomness tests give 0 counts as no discovery). A discovery whose own uniformity, runs or serial test
rejects randomness is dropped.

Defined cases: a null text is empty; an empty text or table has no spans; repeated rows get the same result each;
columns beside ``doc_id`` and ``text`` are ignored. Offsets are code points, the end exclusive.
"""

from __future__ import annotations

import bisect
import hashlib
import itertools
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctua.llm.catalog import query
from punctua.llm.common import read
from punctua.session import materialize

# Patterns of the contract (fixed values); a run of hex digits that is too short is no match either way.
ASSIGN = re.compile(r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]"""
                    r"""|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"""
                    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ASSIGN_HINTS = ("password", "passwd", "secret", "token", "api")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "random")

LEAST = 20
TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
#: A token has the first alphabet that holds all its characters.
ALPHABETS = (("hex", "0123456789abcdef"), ("HEX", "0123456789ABCDEF"),
             ("lower", "abcdefghijklmnopqrstuvwxyz"), ("UPPER", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
             ("base32", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"), ("base32 lower", "abcdefghijklmnopqrstuvwxyz234567"),
             ("lower digits", "0123456789abcdefghijklmnopqrstuvwxyz"), ("UPPER digits", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
             ("alnum", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
             ("base64", "+/0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ_abcdefghijklmnopqrstuvwxyz-"))
#: False-discovery rate within a band of length, and the level of the randomness tests.
RATE, LEVEL = 0.01, 0.001
#: Length bands double: 20-39, 40-79, ...; p-values are binned by their logarithm.
BINS, BIN = 400, 0.25


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) of the base patterns, by start, then kind."""
    out = []
    low = text.lower()
    if any(h in low for h in ASSIGN_HINTS):
        out += [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m[1]) >= 8]
    if "AKIA" in text:
        out += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[0], s[2]))


def tails(x2: float, k: int) -> float:
    """Upper tail of chi-squared with k - 1 degrees of freedom (Wilson-Hilferty)."""
    df = k - 1
    z = ((max(x2, 0) / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df))
    return 0.5 * math.erfc(z / math.sqrt(2))


_CODES = [{c: i for i, c in enumerate(alphabet)} for _, alphabet in ALPHABETS]


def battery(token: str) -> tuple[int, float, float]:
    """(number of the encoding, chi-squared statistic, smallest p-value of the three tests of randomness)."""
    body = token.rstrip("=")
    chars = set(body)
    e = next((i for i, codes in enumerate(_CODES) if chars <= codes.keys()), len(_CODES) - 1)
    codes, k = _CODES[e], len(_CODES[e])
    x = [codes[c] for c in body if c in codes]
    n = len(x)
    if n < LEAST:
        return e, math.inf, 0.0
    x2 = k / n * sum(body.count(c) ** 2 for c in chars if c in codes) - n
    middle = (k - 1) / 2
    up = [v > middle for v in x]
    n1 = sum(up)
    n2 = n - n1
    if not n1 or not n2:
        return e, x2, 0.0
    runs = 1 + sum(a != b for a, b in zip(up, up[1:]))
    mean = 1 + 2 * n1 * n2 / n
    var = max((mean - 1) * (mean - 2) / (n - 1), 1e-9)
    p_runs = math.erfc(abs(runs - mean) / math.sqrt(2 * var))
    centre = sum(x) / n
    power = sum((v - centre) ** 2 for v in x)
    r = sum((a - centre) * (b - centre) for a, b in zip(x, x[1:])) / power if power else 1.0
    p_serial = math.erfc(abs(r + 1 / n) * math.sqrt(n) / math.sqrt(2))
    return e, x2, min(tails(x2, k), p_runs, p_serial)


def text_p(x2: float, n: int, k: int, sums: tuple[float, float]) -> float:
    """log10 of the chance that a token of ordinary text has a chi-squared statistic this small.

    ``sums``: second and third power sums of the text's frequencies over the alphabet (normal approximation of
    the sum of squared counts of a multinomial).
    """
    s2, s3 = sums
    mean = k / n * (n * s2 * (n - 1) + n) - n
    var = (k / n) ** 2 * max(4 * n ** 3 * (s3 - s2 ** 2) + 2 * n ** 2 * s2 ** 2, 1e-9)
    z = (x2 - mean) / math.sqrt(var)
    if z > -30:
        return math.log10(max(0.5 * math.erfc(-z / math.sqrt(2)), 1e-300))
    return -z * z / 2 / math.log(10) - math.log10(-z * math.sqrt(2 * math.pi))


_SCAN = ("doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, "
         "base array<struct<s:int,e:int,k:int>>, tokens array<struct<s:int,e:int,n:int,code:int,x2:double,p:double>>, "
         "histogram binary")
_NAMES = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "base", "tokens", "histogram"]
_BASE_T = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32()), ("k", pa.int32())]))
_TOKEN_T = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32()), ("n", pa.int32()), ("code", pa.int32()),
                               ("x2", pa.float64()), ("p", pa.float64())]))


def scan(docs: DataFrame) -> DataFrame:
    """Base spans and tested tokens of each document, and one row per task with its counts of bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(256, np.int64)

        def out(cols: list[list]) -> pa.RecordBatch:
            kinds = [pa.int64()] * 4 + [pa.string(), _BASE_T, _TOKEN_T, pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=_NAMES)

        for batch in batches:
            cols: list[list] = [[] for _ in range(8)]
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                text = text.as_py() or ""
                raw = np.frombuffer(text.encode(), np.uint8)
                for a in range(0, len(raw), 1 << 20):
                    seen += np.bincount(raw[a:a + (1 << 20)], minlength=256)
                base = base_spans(text)
                # of the base spans that begin before a token's end, the last end says whether one touches it
                starts = sorted((a, b) for a, b, _ in base)
                last = list(itertools.accumulate((b for _, b in starts), max))
                tokens = []
                for m in TOKEN.finditer(text):
                    s, e = m.span()
                    before = bisect.bisect_left(starts, (e,))
                    if not before or last[before - 1] <= s:
                        code, x2, p = battery(m[0])
                        tokens.append({"s": s, "e": e, "n": max(LEAST, len(m[0].rstrip("="))), "code": code, "x2": x2, "p": p})
                digest = hashlib.sha256(",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in base).encode()).hexdigest()
                row = (doc_id, *(sum(k == i for _, _, k in base) for i in range(3)), digest,
                       [{"s": a, "e": b, "k": k} for a, b, k in base], tokens, None)
                for c, v in zip(cols, row):
                    c.append(v)
            yield out(cols)
        yield out([[None], [0], [0], [0], [None], [[]], [[]], [seen.tobytes()]])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _SCAN)


def byte_counts(scanned: DataFrame) -> np.ndarray:
    """Counts of bytes over all documents, from the per-task rows (summed in Spark; 256 numbers come back)."""
    total = np.zeros(256, np.int64)
    rows = scanned.where(F.col("histogram").isNotNull()).select("histogram")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for h in batch.column("histogram"):
                c = np.frombuffer(h.as_py(), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(256)), pa.array(c)], names=["b", "n"])

    for r in rows.mapInArrow(add, "b long, n long").groupBy("b").agg(F.sum("n").alias("n")).collect():
        total[r["b"]] = r["n"]
    return total


def power_sums(counts: np.ndarray) -> list[tuple[float, float]]:
    """Second and third power sums of the byte frequencies over each alphabet (one is added to each count)."""
    out = []
    for _, alphabet in ALPHABETS:
        p = counts[[ord(c) for c in alphabet]] + 1.0
        p = p / p.sum()
        out.append((float((p ** 2).sum()), float((p ** 3).sum())))
    return out


def judged(scanned: DataFrame, sums: list[tuple[float, float]]) -> DataFrame:
    """Tokens that pass as random, with their length band and the bin of their p-value against ordinary text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = [batch.column(i) for i in range(batch.num_columns)]
            names = batch.schema.names
            lists = []
            for tokens in batch.column("tokens").to_pylist():
                lists.append([{"s": t["s"], "e": t["e"], "band": (t["n"] // LEAST).bit_length(),
                               "bin": p_bin(text_p(t["x2"], t["n"], len(ALPHABETS[t["code"]][1]), sums[t["code"]]))
                               if t["p"] > 0 else BINS - 1, "ok": t["p"] >= LEVEL} for t in tokens])
            cols[names.index("tokens")] = pa.array(lists, pa.list_(pa.struct(
                [("s", pa.int32()), ("e", pa.int32()), ("band", pa.int32()), ("bin", pa.int32()), ("ok", pa.bool_())])))
            yield pa.RecordBatch.from_arrays(cols, names=names)

    schema = (_SCAN.replace("n:int,code:int,x2:double,p:double", "band:int,bin:int,ok:boolean")
              .replace(", histogram binary", ""))
    return scanned.where(F.col("histogram").isNull()).drop("histogram").mapInArrow(run, schema)


def p_bin(log_p: float) -> int:
    """Bin of a p-value: 0 is the smallest; a bin's upper edge is 10 ** ((number + 1 - BINS) * BIN)."""
    return max(0, min(BINS - 1, BINS - 1 + math.ceil(log_p / BIN)))


def thresholds(tokens: DataFrame) -> dict[int, int]:
    """Benjamini-Hochberg on the binned p-values, by length band: the last bin that counts as a discovery."""
    rows = (tokens.select(F.explode("tokens").alias("t")).groupBy("t.band", "t.bin").agg(F.count(F.lit(1)).alias("n"))
            .collect())  # bands x bins rows at most
    by_band: dict[int, dict[int, int]] = {}
    for r in rows:
        by_band.setdefault(r["band"], {})[r["bin"]] = r["n"]
    out = {}
    for band, bins in by_band.items():
        m, seen = sum(bins.values()), 0
        for b in sorted(bins):
            seen += bins[b]
            if 10 ** ((b + 1 - BINS) * BIN) <= RATE * seen / m:
                out[band] = b
    return out


def find_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, counts and digest of the base spans, and all spans as kind:start:end by start, then kind."""
    scanned = materialize(scan(docs), "secret-scan")
    tokens = judged(scanned, power_sums(byte_counts(scanned)))
    limits = thresholds(tokens)
    limit = F.create_map(*[F.lit(x) for kv in limits.items() for x in kv]) if limits else None
    found = (F.filter("tokens", lambda t: t["ok"] & (t["bin"] <= F.coalesce(limit[t["band"]], F.lit(-1))))
             if limits else F.filter("tokens", lambda t: F.lit(False)))
    added = F.transform(found, lambda t: F.struct(t["s"].alias("s"), F.lit(KINDS.index("random")).alias("k"),
                                                  t["e"].alias("e")))
    base = F.transform("base", lambda t: F.struct(t["s"].alias("s"), t["k"].alias("k"), t["e"].alias("e")))
    spans = F.transform(F.array_sort(F.concat(base, added)), lambda t: F.concat_ws(
        ":", F.element_at(F.array(*map(F.lit, KINDS)), t["k"] + 1), t["s"].cast("string"), t["e"].cast("string")))
    return tokens.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", F.concat_ws(",", spans).alias("spans"),
                         F.size(added).cast("long").alias("n_random"))


@query("op10_secrets")
def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(read(spark, sf_dir, "documents"))
