"""Line dedup by content-defined chunks of lines, in DataFrame functions only.

Each line has a hash; a rolling hash over two neighbouring lines says at which lines a chunk may end. A chunk ends
where the rolling hash turns even after an odd one, so ends depend on three lines only: text inserted before a passage
shifts no end inside it, and chunks have two lines at least (a document's last line never stands alone). Chunks that
occur more than once in the corpus are candidates by hash; their bytes are then compared (grouped by the chunk's text),
and every occurrence but the first, by (doc_id, text hash, place), is removed.

Defined cases: a null text has no lines and stays null; a text of one line has no multi-line chunk; chunks without
words stay; rows that repeat a ``doc_id`` and a text lose the same lines (their first occurrence counts once); an
empty table gives no rows; other columns are kept as they are, but for ``n_chars``, which follows the text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from punctua.llm.catalog import query
from punctua.llm.common import SPACE_BYTES, keyed, read, row_key
from punctua.session import materialize

FACTOR, PRIME = 1_000_003, 1_000_000_007
SPACES = "".join(map(chr, SPACE_BYTES))


def with_chunks(rows: DataFrame) -> DataFrame:
    """``rows`` with l_lines and l_chunks, an array of (a, b): first and last line of each chunk, from 0."""
    step = rows.withColumn("l_lines", F.when(F.col("text").isNull(), F.array().cast("array<string>"))
                           .otherwise(F.split("text", "\n", -1)))
    step = step.withColumn("l_hash", F.transform("l_lines", lambda x: F.conv(
        F.substring(F.md5(x.cast("binary")), 1, 8), 16, 10).cast("long")))
    h = F.col("l_hash")
    step = step.withColumn("l_even", F.transform(h, lambda x, i: F.pmod(F.pmod(
        F.coalesce(F.get(h, i - 1), F.lit(0)) * FACTOR + x, F.lit(PRIME)), F.lit(2)) == 0)).drop("l_hash")
    even, n = F.col("l_even"), F.size("l_lines")
    step = step.withColumn("l_ends", F.when(n > 0, F.concat(
        F.when(n > 3, F.filter(F.sequence(F.lit(1), F.greatest(n - 3, F.lit(1))),
                               lambda i: F.get(even, i) & ~F.get(even, i - 1))).otherwise(F.array().cast("array<int>")),
        F.array(n - 1))).otherwise(F.array().cast("array<int>"))).drop("l_even")
    ends = F.col("l_ends")
    return step.withColumn("l_chunks", F.transform(ends, lambda e, i: F.struct(
        F.coalesce(F.get(ends, i - 1) + 1, F.lit(0)).alias("a"), e.alias("b")))).drop("l_ends")


def chunk_text(lines: Column, chunk: Column) -> Column:
    return F.array_join(F.slice(lines, chunk["a"] + 1, chunk["b"] - chunk["a"] + 1), "\n")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is worked out once: inside a lambda an expression would be again for every element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def removals(docs: DataFrame) -> DataFrame:
    """k_id, k_text and the chunks (a, b) to remove, for each document that has any."""
    rows = keyed(docs)
    chunks = materialize(
        with_chunks(rows).select("k_id", "k_text", F.explode(F.transform("l_chunks", lambda c: F.struct(
            c["a"].alias("a"), c["b"].alias("b"), F.xxhash64(chunk_text(F.col("l_lines"), c)).alias("h")))).alias("c"))
        .select("k_id", "k_text", "c.a", "c.b", F.col("c.h").alias("h")).where("b > a"), "chunks")
    # rows that repeat a document wholly count once; tables of their own, so that a line of any share can be split in the joins
    seen = materialize(chunks.groupBy("h").agg(F.min(F.struct("k_id", "k_text", "a")).alias("lo"),
                                               F.max(F.struct("k_id", "k_text", "a")).alias("hi")).where("lo != hi").select(
        F.col("h").alias("seen_h")), "repeated-hashes")
    wanted = (chunks.join(seen, F.col("h") == F.col("seen_h"), "left_semi")
              .groupBy(F.col("k_id").alias("w_id"), F.col("k_text").alias("w_text"))
              .agg(F.collect_set(F.struct("a", "b", "h")).alias("w_chunks")))
    cut_out = let(F.struct(F.split("text", "\n", -1).alias("lines"), F.col("w_chunks").alias("chunks")), lambda x: F.transform(
        x["chunks"], lambda c: F.struct(c["a"].alias("a"), c["b"].alias("b"), c["h"].alias("h"), chunk_text(x["lines"], c).alias("t"))))
    found = materialize(
        rows.select("k_id", "k_text", "text").join(wanted, (F.col("k_id") == F.col("w_id")) & (F.col("k_text") == F.col("w_text")))
        .select("k_id", "k_text", cut_out.alias("cs")).select("k_id", "k_text", F.inline("cs"))
        .where(F.translate("t", SPACES, "") != ""), "repeated-chunks")
    # bytes decide what is equal; a hash stands for them in the joins, but where several texts have it
    firsts = materialize(found.groupBy("h", "t").agg(F.min(F.struct("k_id", "k_text", "a")).alias("first")), "first-chunks")
    texts = materialize(firsts.groupBy(F.col("h").alias("f_h")).agg(F.min("first").alias("first"), F.count(F.lit(1)).alias("texts")),
                        "first-hashes")
    place = F.struct("k_id", "k_text", "a")
    again = (found.select("k_id", "k_text", "a", "b", "h").join(texts.where("texts = 1"), F.col("h") == F.col("f_h"))
             .where(place != F.col("first")).select("k_id", "k_text", "a", "b"))
    clash = texts.where("texts > 1").select("f_h")
    if clash.limit(1).count():
        own = firsts.join(clash, F.col("h") == F.col("f_h"), "left_semi").select(F.col("h").alias("o_h"), F.col("t").alias("o_t"), "first")
        again = again.unionByName(found.join(own, (F.col("h") == F.col("o_h")) & (F.col("t") == F.col("o_t")))
                                  .where(place != F.col("first")).select("k_id", "k_text", "a", "b"))
    return again.groupBy("k_id", "k_text").agg(F.collect_set(F.struct("a", "b")).alias("cut"))


def kept_text(text: Column, cut: Column) -> Column:
    """The lines of ``text`` outside the chunks in ``cut``, which do not overlap, joined again: the gaps between them."""
    def gaps(x: Column) -> Column:
        starts = F.concat(F.array(F.lit(0)), F.transform(x["cut"], lambda c: c["b"] + 1))
        ends = F.concat(F.transform(x["cut"], lambda c: c["a"]), F.array(F.size(x["lines"])))
        between = F.filter(F.arrays_zip(starts.alias("s"), ends.alias("e")), lambda g: g["e"] > g["s"])
        return F.array_join(F.flatten(F.transform(between, lambda g: F.slice(x["lines"], g["s"] + 1, g["e"] - g["s"]))), "\n")

    return F.when(F.size(cut) > 0, let(F.struct(F.split(text, "\n", -1).alias("lines"), F.array_sort(cut).alias("cut")), gaps)).otherwise(text)


def deduped(docs: DataFrame) -> DataFrame:
    """``docs`` with all columns, and l_new (the text that is left), l_cut (chunks removed)."""
    cut = removals(docs).select(F.col("k_id").alias("r_id"), F.col("k_text").alias("r_text"), F.col("cut").alias("r_cut"))
    key = row_key()
    rows = docs.select(F.struct("*").alias("row"), key["k_id"].alias("d_id"), key["k_text"].alias("d_text"))
    joined = rows.join(cut, (F.col("d_id") == F.col("r_id")) & (F.col("d_text") == F.col("r_text")), "left")
    none = F.array().cast("array<struct<a:int,b:int>>")
    return joined.select("row", F.coalesce("r_cut", none).alias("l_cut")).withColumn(
        "l_new", kept_text(F.col("row.text"), F.col("l_cut")))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` without repeated chunks, same columns; documents that lose all their words go."""
    out = deduped(docs).where((F.size("l_cut") == 0) | (F.translate(F.col("l_new"), SPACES, "") != ""))
    cols = []
    for f in docs.schema.fields:
        c = F.col("row").getField(f.name)
        if f.name == "text":
            c = F.col("l_new")
        elif f.name == "n_chars":
            c = F.when(F.size("l_cut") > 0, F.length("l_new").cast(f.dataType)).otherwise(c)
        cols.append(c.alias(f.name))
    return out.select(*cols)


SQL = f"""
WITH l AS (SELECT doc_id, text, md5(text) AS tm, unnest(range(0, len(s))) AS i, s, len(s) AS n
           FROM (SELECT DISTINCT doc_id, text, string_split(text, chr(10)) AS s FROM documents WHERE text IS NOT NULL)),
h AS (SELECT *, s[i + 1] AS line, CAST('0x' || substr(md5(s[i + 1]), 1, 8) AS BIGINT) AS v FROM l),
e AS (SELECT *, ((coalesce(lag(v) OVER w, 0) * {FACTOR} + v) % {PRIME}) % 2 = 0 AS even FROM h
      WINDOW w AS (PARTITION BY doc_id, tm ORDER BY i)),
b AS (SELECT *, i >= 1 AND i <= n - 3 AND even AND NOT lag(even) OVER w AS ends FROM e
      WINDOW w AS (PARTITION BY doc_id, tm ORDER BY i)),
c AS (SELECT *, coalesce(sum(CAST(ends AS INT)) OVER (PARTITION BY doc_id, tm ORDER BY i
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS chunk FROM b),
k AS (SELECT doc_id, tm, chunk, min(i) AS a, count(*) AS m, string_agg(line, chr(10) ORDER BY i) AS t FROM c
      GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY t ORDER BY doc_id, tm, a) AS rn FROM k
      WHERE m > 1 AND trim(t, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) <> ''),
x AS (SELECT c.doc_id, c.tm, c.i, c.line, coalesce(r.rn, 1) > 1 AS gone FROM c LEFT JOIN r
      ON c.doc_id = r.doc_id AND c.tm = r.tm AND c.chunk = r.chunk),
o AS (SELECT doc_id, tm, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
      coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '') AS kept FROM x GROUP BY doc_id, tm)
SELECT d.doc_id, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN o ON d.doc_id = o.doc_id AND md5(d.text) = o.tm
"""


@query("op8_line_dedup", SQL)
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = deduped(read(spark, sf_dir, "documents").select("doc_id", "text"))
    n_removed = F.aggregate("l_cut", F.lit(0).cast("long"), lambda n, c: n + (c["b"] - c["a"] + 1))
    n_lines = F.when(F.col("row.text").isNull(), 0).otherwise(F.size(F.split("row.text", "\n", -1)))
    return got.select("row.doc_id", n_lines.cast("long").alias("n_lines"), n_removed.alias("n_removed"),
                      F.sha2(F.coalesce("l_new", F.lit("")).cast("binary"), 256).alias("kept_sha256"))
