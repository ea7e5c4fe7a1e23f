"""Quality rules as a learned decision list, in DataFrame functions only.

Counts of each whole text (words, symbols, repeated lines and 5-word windows, ...) become ratios. From labelled
documents sequential covering learns rules that reject: a rule is grown by adding the threshold condition with the
best information gain until it covers no good document, pruned from its end on rows held back, and kept if it is
precise there; the rows that it covers go and the next rule is grown. The list becomes one ordered conditional
expression over the ratios, so the rules can be read, and run inside Spark.

The rules are fitted on at most ``sample`` labelled documents of each class (those with the smallest hashes of
their ids); counts, ratios and verdicts cover every row.

Defined cases: a null text has no words; texts without words have ratios of 0; without labels of both classes there
is no rule; a document labelled twice counts as good if any label says so; repeated rows get the same verdict;
columns beside ``doc_id`` and ``text`` are ignored by the counts and kept by :func:`keep`. Repeated windows are
found by 64-bit hashes of words within one text.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from punctua.llm.catalog import query
from punctua.llm.common import read

SYMBOLS = "#*$%&|<>"  # fixed value
SPACES = " \t\n\u000b\f\r"
RATIOS = ["n_words", "word_len", "symbols", "upper", "bangs", "digits", "dup_lines", "repeats", "distinct", "lines"]
#: Labelled documents of each class that the rules are fitted on, at most.
SAMPLE = 4000
MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20  # of the contract


def occurrences(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def counted(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id and text) with counts in columns that begin with ``q_``; array columns are left out."""
    text = F.coalesce(F.col("text"), F.lit(""))
    step = docs.withColumn("q_text", text)
    t = F.col("q_text")
    step = step.withColumns({
        "q_words": F.filter(F.split(t, r"[\x20\x09-\x0D]+"), lambda w: w != ""),
        "q_lines": F.filter(F.split(t, "\n"), lambda x: F.translate(x, SPACES, "") != ""),
        "word_chars": F.length(F.translate(t, SPACES, "")), "n_symbols": occurrences(t, SYMBOLS),
        "q_upper": occurrences(t, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"), "q_bangs": occurrences(t, "!?"),
        "q_digits": occurrences(t, "0123456789"),
    }).drop("q_text")
    step = step.withColumns({
        "n_words": F.size("q_words"), "n_lines": F.size("q_lines"),
        "n_dup_lines": F.size("q_lines") - F.size(F.array_distinct("q_lines")),
        "q_distinct": F.size(F.array_distinct("q_words")),
        "q_hash": F.transform("q_words", lambda w: F.xxhash64(w)),
    }).drop("q_words", "q_lines")
    h = F.col("q_hash")
    window = F.transform(h, lambda x, i: F.when(i <= F.size(h) - 5, F.xxhash64(
        x, F.get(h, i + 1), F.get(h, i + 2), F.get(h, i + 3), F.get(h, i + 4))))
    step = step.withColumn("q_window", F.filter(window, lambda x: x.isNotNull())).drop("q_hash")
    w = F.col("q_window")
    # only texts with a repeated window go on: windows sorted by hash, those with an equal neighbour, their places
    some = F.size(F.array_distinct(w)) < F.size(w)
    empty = F.array().cast("array<struct<h:bigint,i:int>>")
    step = step.withColumn("q_sorted", F.when(some, F.array_sort(F.transform(
        w, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))).otherwise(empty)).drop("q_window")
    s = F.col("q_sorted")
    same = F.filter(s, lambda x, i: F.coalesce(x["h"] == F.get(s, i - 1)["h"], F.lit(False))
                    | F.coalesce(x["h"] == F.get(s, i + 1)["h"], F.lit(False)))
    step = step.withColumn("q_places", F.array_sort(F.transform(same, lambda x: x["i"]))).drop("q_sorted")
    p = F.col("q_places")
    covered = F.transform(p, lambda x, i: F.least(F.lit(5), F.coalesce(F.get(p, i + 1) - x, F.lit(5))))
    step = step.withColumn("n_repeat_words", F.aggregate(covered, F.lit(0), lambda a, x: a + x)).drop("q_places")
    return step


def ratios() -> dict[str, Column]:
    def per(a: str, b: str) -> Column:
        return F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b).cast("double")), F.lit(0.0))

    return {"n_words": F.col("n_words").cast("double"), "word_len": per("word_chars", "n_words"),
            "symbols": per("n_symbols", "word_chars"), "upper": per("q_upper", "word_chars"),
            "bangs": per("q_bangs", "n_words"), "digits": per("q_digits", "word_chars"),
            "dup_lines": per("n_dup_lines", "n_lines"), "repeats": per("n_repeat_words", "n_words"),
            "distinct": per("q_distinct", "n_words"), "lines": per("n_lines", "n_words")}


Rule = list[tuple[int, bool, float]]  # (ratio, True: above, threshold); all must hold


def covers(rule: Rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for f, above, at in rule:
        out &= (x[:, f] > at) if above else (x[:, f] <= at)
    return out


def learn(x: np.ndarray, bad: np.ndarray, weight: np.ndarray, precision: float = 0.95, least: int = 8,
          longest: int = 4) -> list[Rule]:
    """Sequential covering: rules that hold for bad rows; ``weight`` is what a row stands for."""
    order = np.argsort((np.arange(len(x)) * 2654435761) % 2**32)
    x, bad, weight = x[order], bad[order], weight[order]
    held = np.arange(len(x)) % 3 == 0
    rules: list[Rule] = []
    while True:
        grow, prune = ~held, held
        if (bad & grow).sum() < least or (bad & prune).sum() < least // 2:
            return rules
        rule: Rule = []
        inside = grow.copy()
        while len(rule) < longest and (inside & ~bad).any():
            best, found = 1e-9, None
            pos, neg = weight[inside & bad].sum(), weight[inside & ~bad].sum()
            prior = np.log2(pos / (pos + neg))
            for f in range(x.shape[1]):
                v = x[inside, f]
                by = np.argsort(v, kind="stable")
                v, p = v[by], np.where(bad[inside], weight[inside], 0.0)[by]
                n = np.where(bad[inside], 0.0, weight[inside])[by]
                cut = np.flatnonzero(np.diff(v) > 0)
                if not len(cut):
                    continue
                below_p, below_n = np.cumsum(p)[cut], np.cumsum(n)[cut]
                for above, cp, cn in ((False, below_p, below_n), (True, pos - below_p, neg - below_n)):
                    gain = np.where(cp > 0, cp * (np.log2(np.maximum(cp, 1e-12) / (cp + cn + 1e-12)) - prior), 0)
                    k = int(np.argmax(gain))
                    if gain[k] > best:
                        best, found = gain[k], (f, above, float((v[cut[k]] + v[cut[k] + 1]) / 2))
            if found is None:
                break
            rule.append(found)
            inside &= covers([found], x)

        def value(r: Rule) -> float:
            c = covers(r, x) & prune
            p, n = weight[c & bad].sum(), weight[c & ~bad].sum()
            return (p - n) / (p + n) if p + n else -1.0

        while len(rule) > 1 and value(rule[:-1]) >= value(rule):
            rule = rule[:-1]
        c = covers(rule, x)
        p, n = weight[c & bad].sum(), weight[c & ~bad].sum()
        if not rule or (c & bad).sum() < least or p < precision * (p + n) or value(rule) < 2 * precision - 1:
            return rules
        rules.append(rule)
        x, bad, weight, held = x[~c], bad[~c], weight[~c], held[~c]


def expression(rules: list[Rule]) -> Column:
    """The decision list: number of the first rule that holds, from 1; null if none does."""
    r = ratios()
    out = None
    for k, rule in enumerate(rules, 1):
        holds = F.lit(True)
        for f, above, at in rule:
            c = r[RATIOS[f]]
            holds = holds & ((c > at) if above else (c <= at))
        out = F.when(holds, k) if out is None else out.when(holds, k)
    return F.lit(None).cast("int") if out is None else out


def readable(rules: list[Rule]) -> list[str]:
    return ["reject if " + " and ".join(f"{RATIOS[f]} {'>' if above else '<='} {at:.6g}" for f, above, at in rule)
            for rule in rules]


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> list[Rule]:
    """Learn the rules from at most ``sample`` labelled documents of each class."""
    known = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
             .groupBy(F.col("doc_id").alias("label_id")).agg((F.max("quality") == 0).alias("bad")))
    total = {r["bad"]: r["n"] for r in known.groupBy("bad").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(total) < 2:
        return []
    order = [F.xxhash64("label_id"), F.col("label_id")]
    chosen = (known.where("bad").orderBy(*order).limit(sample)
              .unionByName(known.where("not bad").orderBy(*order).limit(sample)))
    counts = counted(docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id")))
    # of rows that repeat an id always the same one, so a row per chosen id at most
    one = F.min(F.struct(F.xxhash64("text").alias("of"), *[c.alias(n) for n, c in ratios().items()]))
    rows = counts.groupBy("label_id", "bad").agg(one.alias("x")).select("bad", "x.*").collect()
    if not rows:
        return []
    x = np.array([[r[n] for n in RATIOS] for r in rows], float)
    bad = np.array([r["bad"] for r in rows])
    weight = np.where(bad, total[True] / max(bad.sum(), 1), total[False] / max((~bad).sum(), 1))
    # order must not depend on how Spark dealt the rows
    by = np.lexsort((*x.T, bad))
    return learn(x[by], bad[by], weight[by])


def verdicts(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """``docs`` with the counts, base_failed, rule (that rejected; null: none) and kept."""
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return (counted(docs).withColumn("rule", expression(rules)).withColumn("base_failed", base)
            .withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull()))


def keep(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the base rules and the learned list keep, with their columns."""
    rules = fit(docs, labels)
    inner = docs.select(F.struct("*").alias("row"), F.col("doc_id"), F.col("text"))
    # a filter is not moved below a column that depends on the row's place, so the counts are worked out once
    judged = verdicts(inner, rules).withColumn("q_place", F.monotonically_increasing_id())
    return judged.where(F.col("kept") & (F.col("q_place") >= 0)).select("row.*")


@query("op6_quality_rules")
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    rules = fit(docs, read(spark, sf_dir, "labels"))
    long = [F.col(c).cast("long").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    return verdicts(docs, rules).select("doc_id", *long, "base_failed", "kept", "rule")
