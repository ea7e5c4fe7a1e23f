from collections import Counter

from edge import EDGE, docs, folder
from test_decontaminate_secrets import ITEMS
from test_decontaminate_secrets import brute as hits
from test_jaccard_join import near_copies
from test_pipeline_near import kept
from test_quality_line_dedup import SPACE, counts, removed
from test_sharding_packing import check_packing

import corpus_pipeline as C
from punctua.session import materialize


def rows_of(df):
    return Counter((r["doc_id"], r["text"]) for r in df.collect())


def test_stages_against_brute_force(spark, tmp):
    block = "\n".join(f"shared line number {i} of a block" for i in range(12))
    rows = EDGE + near_copies() + [(i, f"document {i} has its own first line\n{block}\nand the end of {i}") for i in range(20, 28)]
    no_labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    items = [i for i in ITEMS if i[0] != 2]
    d = folder(spark, tmp, rows, labels=no_labels, benchmark=spark.createDataFrame(items, "item_id long, text string"))
    names = docs(spark, []).columns
    df = spark.read.parquet(f"{d}/documents.parquet")

    def step(k, df):
        out = materialize(C.STAGES[k][1](spark, df, d), "stage")
        assert k == 4 or out.columns == names
        return out

    df = step(0, df)
    left = [(i, t) for i, t in rows if not counts(t)[-1]]
    assert rows_of(df) == Counter(left)
    df = step(1, df)
    cut = removed(left)
    left = [(i, cut[i, t][2] if cut[i, t][1] else t) for i, t in left if not cut[i, t][1] or cut[i, t][2].strip(SPACE)]
    assert rows_of(df) == Counter(left)
    df = step(2, df)
    left = kept(left, C.NEAR_SHINGLE, C.NEAR_PERCENT)
    assert rows_of(df) == Counter(left)
    df = step(3, df)
    bad = {(i, n) for i, n, h, *_ in hits(left, items) if h}
    left = [(i, t) for i, t in left if (i, counts_words(t)) not in bad]
    assert rows_of(df) == Counter(left)
    assert 10 < len(left) < len(rows) - 100
    check_packing(step(4, df).collect(), left)
    assert len(check_packing(C.run(spark, d).collect(), left)) == 2


def counts_words(text):
    from test_decontaminate_secrets import words

    return len(words(text))


def test_empty(spark, tmp):
    d = folder(spark, tmp, [], labels=spark.createDataFrame([], "doc_id long, quality int, toxic int"),
               benchmark=spark.createDataFrame([], "item_id long, text string"))
    assert C.run(spark, d).count() == 0
