"""The corpus pipeline: stages over ``documents``, each written as parquet and read again as the next one's input.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the last return the columns
of ``documents``. Empty tables, null texts and ids, and further columns go through every stage (see the operators).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from punctua.llm.common import read
from punctua.llm.decontaminate import clean
from punctua.llm.jaccard_join import one_of_each
from punctua.llm.line_dedup import dedup_lines
from punctua.llm.packing import pack, tokenizer_path
from punctua.llm.quality import keep
from punctua.session import materialize

#: Words in a shingle and least similarity (percent) of the near-duplicate stage; op9's own contract is 4 and 85.
NEAR_SHINGLE, NEAR_PERCENT = 5, 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the decision list learned from ``labels`` reject go."""
    return keep(docs, read(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated multi-line chunks go from the texts, but for their first occurrence; emptied documents go."""
    return dedup_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by the n-gram Jaccard join (5 words, 0.8 or more) the one with the smallest id stays."""
    return one_of_each(docs, NEAR_SHINGLE, NEAR_PERCENT)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a window of a benchmark item occurs go."""
    return clean(docs, read(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing of what is left into sequences of 2048 ids."""
    return pack(docs, tokenizer_path())


STAGES = [("quality rules", quality_rules), ("line dedup", line_dedup), ("n-gram Jaccard join", near_duplicates),
          ("benchmark decontamination", decontamination), ("best-fit packing", packing)]

#: No SQL can express the learned quality rules or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply STAGES to ``documents``; the result of each but the last is written and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
