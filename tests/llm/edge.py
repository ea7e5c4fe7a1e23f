"""Small document tables with the cases that every operator has to stand."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark.sql import types as T  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that operators might use themselves
    T.StructField("key", T.StringType()), T.StructField("k_id", T.StringType()), T.StructField("n", T.StringType()),
    T.StructField("hash", T.StringType()), T.StructField("length", T.StringType()),
])


def docs(spark, rows):
    """``rows``: (doc_id, text) or (doc_id, text, lang)."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else None, "s", None, "x", "x", "x", "x", "x") for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def folder(spark, tmp, rows, **tables):
    """A table folder with ``documents`` (and others, given as DataFrames)."""
    docs(spark, rows).write.parquet(f"{tmp}/documents.parquet")
    for name, df in tables.items():
        df.write.parquet(f"{tmp}/{name}.parquet")
    return tmp


PASSAGE = " ".join(f"w{i}" for i in range(120))
EDGE = [
    (1, PASSAGE), (2, f"before {PASSAGE} after"), (3, None), (4, ""), (5, " \n\t "), (6, "one"), (7, PASSAGE),
    (8, "a a a a a a a a a a " * 30), (None, PASSAGE), (9, "x" * 5000 + " " + "long " * 8000), (7, PASSAGE),
    (7, "another text under the same id"), (10, "Ünïcödé 你好   words \U0001f600 é"), (-5, "negative id " + PASSAGE),
    (11, "line one\nline two\nline one\n\nline two\n"),
]
