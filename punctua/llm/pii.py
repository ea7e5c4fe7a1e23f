"""Personal data by weak supervision, in DataFrame functions only.

Base spans come from four patterns with checks. Candidates are the base spans and looser forms (phones without a country
code, spelled-out e-mails, card numbers of other lengths, long-form addresses). Five labelers vote on each, for, against
or not at all: the strict pattern, the form (checksum, digits), a gazetteer (endings, issuers, area codes), words before
the span, and its neighbours. Votes are counted by pattern in Spark, over all candidates of the corpus; from these few
counts expectation-maximisation estimates each labeler's reliability per kind, and a logistic span classifier is
trained on the resulting posteriors. It becomes a Spark expression, and candidates that it accepts and that touch no
base span are added. The driver sees at most 4 x 3^5 x 2 counts.

Positions are code points: the pieces between matches (``split``) and the matches give every start, by a scan of their
lengths. Words before a span are looked for back to the match before it. Work grows as n log n with the matches of a text.

Defined cases: a null text is empty; without candidates nothing is added; repeated rows get the same result each; an
empty table gives no rows; columns beside ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from punctua.llm.catalog import query
from punctua.llm.common import read
from punctua.session import materialize

KINDS = ("email", "ip", "card", "phone")
_LOCAL = "[A-Za-z0-9._%+-]"
# Patterns of the contract (fixed values). Where a match can only begin at the head of a run of its characters, or where
# the last match ended, this is said first, and loops give nothing back: equal matches, in time linear in the text.
BASE = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){15,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "email": r"(?<![A-Za-z0-9._-])[A-Za-z0-9._-]{1,40}(?:\x20?[(\[]at[)\]]\x20?|\x20at\x20)[A-Za-z0-9-]{1,40}"
             r"(?:(?:\x20?[(\[]dot[)\]]\x20?|\x20dot\x20)[A-Za-z0-9-]{2,20}){1,4}(?![A-Za-z0-9])",
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9][\x20-]?)(?<![0-9.+])[0-9](?:[\x20-]?[0-9]){12,14}+(?![\x20-]?[0-9])",
    "phone": r"(?<![0-9+.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
}
# Gazetteers (fixed values): common endings, leading digits of card issuers, words said before or against a kind.
ENDINGS = r"(?i)(?:\.|dot[)\]]?\x20?)(?:com|org|net|edu|gov|info|io|de|fr|es|uk|eu)$"
ISSUERS = r"^(?:3[47]|4|5[1-5]|2[2-7]|6)"
BEFORE = {
    "email": r"(?i)(?:e-?mail|mail|contact|write|reach|kontakt|correo|courriel)\W*$",
    "ip": r"(?i)(?:\bip|address|host|server|adresse)\W*$",
    "card": r"(?i)(?:card|visa|credit|karte|tarjeta|carte)\W*(?:no|number)?\W*$",
    "phone": r"(?i)(?:phone|call|tel|mobile|fax|telefon|tel[eé]fono|t[eé]l[eé]phone)\W*$",
}
AGAINST = r"(?i)(?:version|isbn|order|invoice|serial|section|ref|id|no)\W*$"
LABELERS = ("strict", "form", "gazetteer", "before", "edges")
CONTEXT = 30
#: Candidates that the labelers' assumed reliabilities weigh as much as.
BELIEF = 20


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is worked out once: inside a lambda an expression would be again for every element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def scanned(values: Column, join: Callable[[Column, Column], Column]) -> Column:
    """``values`` joined with all before them: in round k with what ends 2^k places earlier, so in n log n steps."""
    rounds = F.sequence(F.lit(0), F.ceil(F.log2(F.greatest(F.size(values), F.lit(1)))).cast("int"))

    def step(acc: Column, k: Column) -> Column:
        back = F.pow(F.lit(2), k).cast("int")
        return F.transform(acc, lambda x, i: F.when(i >= back, join(x, F.get(acc, i - back))).otherwise(x))

    return F.aggregate(rounds, values, step)


def located(text: Column, pattern: str) -> Column:
    """Matches of ``pattern``: array of (s, e, m, l, r), code points, end exclusive; l is what stands before, back to the
    match before at most, r the character behind. Linear in the text, n log n in the matches."""
    kind = "array<struct<s:int,e:int,m:string,l:string,r:string>>"

    def spans(x: Column) -> Column:
        ends = scanned(F.transform(x["m"], lambda m, i: F.length(F.get(x["gap"], i)) + F.length(m)), lambda a, b: a + b)

        def span(m: Column, i: Column, ends: Column) -> Column:
            e = F.get(ends, i)
            left = F.concat(F.coalesce(F.get(x["m"], i - 1), F.lit("")), F.get(x["gap"], i))
            right = F.concat(F.get(x["gap"], i + 1), F.coalesce(F.get(x["m"], i + 1), F.lit("")))
            return F.struct((e - F.length(m)).alias("s"), e.alias("e"), m.alias("m"),
                            F.substring(left, -CONTEXT, CONTEXT).alias("l"), F.substring(right, 1, 1).alias("r"))

        return let(ends, lambda ends: F.transform(x["m"], lambda m, i: span(m, i, ends)))

    found = F.struct(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), 0).alias("m"))
    return F.when(F.regexp_like(text, F.lit(pattern)), let(found, spans)).otherwise(F.array().cast(kind))


def apart(candidates: Column, spans: Column) -> Column:
    """The ``candidates`` that touch none of the ``spans``: of those that begin before a candidate's end, found by halving, the
    last end decides."""
    def against(x: Column) -> Column:
        def before(e: Column) -> Column:
            """How many spans begin before ``e``."""
            def halve(low: Column, k: Column) -> Column:
                step = F.pow(F.lit(2), F.lit(30) - k).cast("int")
                fits = (step <= F.size(x["s"]) - low) & (F.get(x["s"], low + step - 1) < e)
                return F.when(fits, low + step).otherwise(low)

            return F.aggregate(F.sequence(F.lit(0), F.lit(30)), F.lit(0), halve)

        return F.filter(candidates, lambda c: F.coalesce(F.get(x["e"], before(c["e"]) - 1) <= c["s"], F.lit(True)))

    def ordered(b: Column) -> Column:
        return F.struct(F.transform(b, lambda s: s["s"]).alias("s"),
                        scanned(F.transform(b, lambda s: s["e"]), lambda p, q: F.greatest(p, q)).alias("e"))

    both = (F.size(candidates) > 0) & (F.size(spans) > 0)
    return F.when(both, let(F.array_sort(spans), lambda b: let(ordered(b), against))).otherwise(candidates)


def digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(d: Column) -> Column:
    def value(i: Column) -> Column:
        v = F.substring(d, F.length(d) - i + 1, F.lit(1)).try_cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return F.when(v > 9, v - 9).otherwise(v)

    total = F.aggregate(F.sequence(F.lit(1), F.length(d)), F.lit(0), lambda a, i: a + value(i))
    return F.when(F.length(d).between(12, 19), total % 10 == 0).otherwise(False)


def valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        part = lambda p: F.ltrim(p, F.lit("0"))
        return F.forall(F.split(m, r"\."), lambda p: (F.length(part(p)) <= 3)
                        & (F.coalesce(part(p).try_cast("int"), F.lit(0)) <= 255))
    if kind == "card":
        return F.length(digits(m)).between(16, 19) & luhn(digits(m))
    if kind == "phone":
        return F.length(digits(m)).between(8, 15)
    return F.lit(True)


def votes(kind: str, x: Column, base: bool) -> Column:
    """The labelers' votes on span ``x`` (1, 0, -1), with its place and whether it is a base span."""
    before, d, m = x["l"], digits(x["m"]), x["m"]
    form = {"email": F.when(F.length(m) <= 80, 1).otherwise(-1), "ip": F.when(F.regexp_like(m, F.lit("[:.](?:0+)?[1-9a-fA-F]")), 1).otherwise(-1),
            "card": F.when(luhn(d), 1).otherwise(-1), "phone": F.when(F.length(d).between(10, 13), 1).otherwise(0)}[kind]
    gazetteer = {"email": F.when(F.regexp_like(m, F.lit(ENDINGS)), 1).otherwise(0),
                 "ip": F.when(F.regexp_like(m, F.lit(r"^(?:0|127|255)\.")), -1).otherwise(0),
                 "card": F.when(F.regexp_like(d, F.lit(ISSUERS)), 1).otherwise(-1),
                 "phone": F.when(F.regexp_like(d, F.lit("^[01]{3}")), -1).otherwise(1)}[kind]
    context = F.when(F.regexp_like(before, F.lit(BEFORE[kind])), 1).when(F.regexp_like(before, F.lit(AGAINST)), -1).otherwise(0)
    edge = F.concat(F.substring(before, -1, 1), F.lit("|"), x["r"])
    edges = F.when(F.regexp_like(edge, F.lit(r"[A-Za-z0-9_/=#]")), -1).otherwise(1)
    cols = (F.lit(1 if base else 0), form, gazetteer, context, edges)
    return F.struct(x["s"].alias("s"), x["e"].alias("e"), F.lit(KINDS.index(kind)).alias("k"), F.lit(base).alias("base"),
                    *[c.cast("int").alias(n) for c, n in zip(cols, LABELERS)])


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, base (array of s, e, k) and cands (with votes) of every row; written once, spans only."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    t = F.col("text")

    def checked(kind: str):
        return lambda x: valid(kind, x["m"])

    def placed(number: int):
        return lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), F.lit(number).alias("k"))

    def voter(kind: str, base: bool):
        return lambda x: votes(kind, x, base)

    rows = rows.withColumns({f"b_{k}": located(t, p) for k, p in BASE.items()} | {f"l_{k}": located(t, p) for k, p in LOOSE.items()})
    rows = rows.withColumns({f"b_{k}": F.filter(f"b_{k}", checked(k)) for k in KINDS})
    rows = rows.withColumn("base", F.flatten(F.array(*[F.transform(f"b_{k}", placed(i)) for i, k in enumerate(KINDS)])))
    voted = [F.transform(f"b_{k}", voter(k, True)) for k in KINDS]
    voted += [F.transform(apart(F.col(f"l_{k}"), F.col("base")), voter(k, False)) for k in KINDS]
    return rows.select("doc_id", "base", F.flatten(F.array(*voted)).alias("cands"))


def reliabilities(counts: dict[tuple[int, ...], float], rounds: int = 50) -> tuple[float, list[dict[int, tuple[float, float]]]]:
    """Expectation-maximisation over vote patterns: prior, and each labeler's chance of each vote if true, if not.

    Labelers are taken as independent given the truth. Each starts as better than chance, and that start weighs as much as
    BELIEF candidates, so a kind with few candidates stays close to it.
    """
    n = len(next(iter(counts)))
    prior = 0.5
    start = {1: (0.7, 0.2), 0: (0.2, 0.3), -1: (0.1, 0.5)}
    tables = [dict(start) for _ in range(n)]
    total = sum(counts.values())
    for _ in range(rounds):
        post = {v: posterior(v, prior, tables) for v in counts}
        true = sum(c * post[v] for v, c in counts.items())
        prior = min(max((true + BELIEF / 2) / (total + BELIEF), 0.02), 0.98)
        tables = [{vote: ((sum(c * post[v] for v, c in counts.items() if v[i] == vote) + BELIEF * yes) / (true + BELIEF),
                          (sum(c * (1 - post[v]) for v, c in counts.items() if v[i] == vote) + BELIEF * no)
                          / (total - true + BELIEF)) for vote, (yes, no) in start.items()} for i in range(n)]
    return prior, tables


def posterior(v: tuple[int, ...], prior: float, tables: list[dict[int, tuple[float, float]]]) -> float:
    yes, no = math.log(prior), math.log(1 - prior)
    for vote, table in zip(v, tables):
        yes, no = yes + math.log(table[vote][0]), no + math.log(table[vote][1])
    return 1 / (1 + math.exp(min(max(no - yes, -500), 500)))


def classifier(counts: dict[tuple[int, ...], float], posts: dict[tuple[int, ...], float], rounds: int = 400) -> list[float]:
    """Logistic regression on the votes (one feature for, one against, per labeler), trained on soft labels."""
    def features(v: tuple[int, ...]) -> list[float]:
        return [1.0] + [float(x == 1) for x in v] + [float(x == -1) for x in v]

    rows = [(features(v), posts[v], c) for v, c in counts.items()]
    total, w = sum(c for _, _, c in rows), [0.0] * (1 + 2 * len(next(iter(counts))))
    for _ in range(rounds):
        g = [0.001 * x for x in w]
        for x, y, c in rows:
            p = 1 / (1 + math.exp(-sum(a * b for a, b in zip(w, x))))
            for i, a in enumerate(x):
                g[i] += c / total * (p - y) * a
        w = [a - b for a, b in zip(w, g)]
    return w


def train(cands: DataFrame) -> dict[int, list[float]]:
    """Weights of the span classifier by kind, from the counts of vote patterns over all candidates."""
    names = ["k", *LABELERS]
    rows = (cands.select(F.explode("cands").alias("c")).groupBy(*[F.col(f"c.{n}").alias(n) for n in names])
            .agg(F.count(F.lit(1)).alias("n")).collect())
    out = {}
    for k in range(len(KINDS)):
        counts = {tuple(r[n] for n in LABELERS): float(r["n"]) for r in rows if r["k"] == k}
        if counts:
            prior, tables = reliabilities(counts)
            out[k] = classifier(counts, {v: posterior(v, prior, tables) for v in counts})
    return out


def accepted(x: Column, weights: dict[int, list[float]]) -> Column:
    out = F.lit(False)
    for k, w in weights.items():
        z = F.lit(w[0])
        for i, n in enumerate(LABELERS):
            z = z + F.when(x[n] == 1, w[1 + i]).when(x[n] == -1, w[1 + len(LABELERS) + i]).otherwise(0.0)
        out = F.when(x["k"] == k, z > 0).otherwise(out)
    return out


def joined(spans: Column) -> Column:
    """kind:start:end by kind, then start, joined by commas; ``spans``: array of (k, s, e) in that order of fields."""
    return F.concat_ws(",", F.transform(F.array_sort(spans), lambda x: F.concat_ws(
        ":", F.element_at(F.array(*map(F.lit, KINDS)), x["k"] + 1), x["s"].cast("string"), x["e"].cast("string"))))


def equal_to(value: int):
    return lambda x: x == value


def find_pii(docs: DataFrame) -> DataFrame:
    """doc_id, counts and digest of the base spans, all spans, how many were added and how many there are."""
    found = materialize(candidates(docs), "pii-candidates")
    weights = train(found)

    def place(x: Column) -> Column:
        return F.struct(x["k"].alias("k"), x["s"].alias("s"), x["e"].alias("e"))

    base = F.transform("base", place)
    added = F.transform(F.filter("cands", lambda x: ~x["base"] & accepted(x, weights)), place)
    numbers = F.transform("base", lambda x: x["k"])
    counts = [F.size(F.filter(numbers, equal_to(i))).cast("long").alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
                        joined(F.concat(base, added)).alias("spans"), F.size(added).cast("long").alias("n_added"),
                        (F.size("base") + F.size(added)).cast("long").alias("n_spans"))


@query("op4_pii")
def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(read(spark, sf_dir, "documents"))
