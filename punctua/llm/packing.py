"""Best-fit packing of tokenised documents into sequences (best-two-fit).

A sequence is filled greedily: the longest piece that is left, then again and again the longest piece that
still fits. Then its smallest piece is taken out if two unpacked pieces fit the larger gap more tightly, and
the two go in instead. Only lengths matter for this, and there are at most ``capacity`` of them, so the packing
runs on the counts of each length: one pattern of lengths is repeated as often as the counts allow. The pieces of
each length are numbered without gaps by Spark, and a piece's number says which copy of which pattern it is in.
So the driver sees one count per length, whatever the size of the corpus.

Defined cases: a null or empty text is the closing id alone; a text of more than ``capacity`` ids is cut into full
pieces and a rest; rows that repeat a ``doc_id`` are packed each for itself; an empty table gives no rows;
columns beside ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import bisect
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctua.llm.catalog import query
from punctua.llm.common import read, slots
from punctua.session import materialize

#: Words, and chunks, whose ids a worker remembers; beyond that the older half is forgotten.
CACHE_WORDS = 800_000
ROWS_PER_BUCKET = 100_000


class Encoder:
    """Ids of texts by a tokenizer of the ``tokenizers`` library, remembering the ids of words.

    The tokenizer drops white space and never joins what it parts, so a text's ids are those of its chunks between
    ASCII white space, one after the other. A chunk of ASCII and Latin-1 letters is parted into words here by
    the tokenizer's own pattern and each new word goes to its BPE model; any other chunk goes through the whole
    tokenizer.
    """

    #: The tokenizer's word pattern (fixed value).
    WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.find = regex.compile(self.WORDS).findall
        self.plain = regex.compile("[\x21-\x7eÀ-ÿ]+").fullmatch
        shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]  # bytes that stand for themselves
        rest = [b for b in range(256) if b not in shown]
        self.shown = {b: b for b in shown} | {b: 256 + i for i, b in enumerate(rest)}
        self.chunks: tuple[dict, dict] = ({}, {})
        self.words: tuple[dict, dict] = ({}, {})

    @staticmethod
    def _remember(cache: tuple[dict, dict], key, value) -> tuple[dict, dict]:
        new, old = cache
        new[key] = value
        return ({}, new) if len(new) >= CACHE_WORDS // 2 else cache

    def word(self, w: str) -> bytes:
        got = self.words[0].get(w) or self.words[1].get(w)
        if got is None:
            shown = w.encode().decode("latin-1").translate(self.shown)
            got = np.array([t.id for t in self.model.tokenize(shown)], "<u4").tobytes()
            self.words = self._remember(self.words, w, got)
        return got

    def chunk(self, c: bytes) -> bytes:
        got = self.chunks[1].get(c)
        if got is None:
            text = c.decode()
            if self.plain(text) and "<|" not in text:
                got = b"".join(map(self.word, self.find(unicodedata.normalize("NFC", text).lower())))
            else:
                got = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        self.chunks = self._remember(self.chunks, c, got)
        return got

    def __call__(self, text: bytes) -> bytes:
        """Little-endian 32-bit ids."""
        parts = text.split()
        out = []
        known = self.chunks[0].get
        for c in parts:
            ids = known(c)
            if ids is None:
                ids = self.chunk(c)
                known = self.chunks[0].get
            out.append(ids)
        return b"".join(out)


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker process keeps its encoder, and the words that it remembers, from task to task."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def pieces(docs: DataFrame, tokenizer: str, capacity: int = 2048, closing: int = 0) -> DataFrame:
    """One row per piece of a document: doc_id, piece, start, length, ids_crc32."""
    fields = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
              ("ids_crc32", pa.int64())]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end, width = encoder(tokenizer), np.array([closing], "<u4").tobytes(), 4 * capacity
        for batch in batches:
            cols: list[list] = [[] for _ in fields]
            texts = batch.column("text").cast(pa.large_binary())
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts):
                ids = encode(text.as_py() or b"") + end
                for k in range(0, len(ids), width):
                    part = ids[k:k + width]
                    for col, v in zip(cols, (doc_id, k // width, k // 4, len(part) // 4, zlib.crc32(part))):
                        col.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(cols, fields)],
                                             names=[f for f, _ in fields])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def best_two_fit(counts: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """Patterns (lengths in a sequence, largest first; copies) that use up ``counts`` (length -> pieces)."""
    left = {n: c for n, c in counts.items() if c > 0}
    if left and not 0 < min(left) <= max(left) <= capacity:
        raise ValueError("lengths must lie between 1 and the capacity")
    lengths = sorted(left)  # those that are left, ascending
    out = []

    def longest(limit: int, used: dict[int, int]) -> int | None:
        i = bisect.bisect_right(lengths, limit) - 1
        while i >= 0 and left[lengths[i]] <= used.get(lengths[i], 0):
            i -= 1
        return lengths[i] if i >= 0 else None

    def two(limit: int, floor: int, used: dict[int, int]) -> tuple[int, int] | None:
        """The two lengths left with the largest sum that is above ``floor`` and within ``limit``."""
        free = [n for n in lengths if n < limit and left[n] > used.get(n, 0)]
        i, j, best, found = 0, len(free) - 1, floor, None
        while i <= j:
            total = free[i] + free[j]
            if total > limit:
                j -= 1
            elif i == j:
                if total > best and left[free[i]] - used.get(free[i], 0) >= 2:
                    best, found = total, (free[i], free[i])
                break
            else:
                if total > best:
                    best, found = total, (free[j], free[i])
                if best == limit:
                    break
                i += 1
        return found

    while lengths:
        bin_, used, gap = [], {}, capacity
        while gap and (n := longest(gap, used)) is not None:
            bin_.append(n)
            used[n] = used.get(n, 0) + 1
            gap -= n
        if gap and len(bin_) > 1:
            small = bin_[-1]
            used[small] -= 1
            if pair := two(gap + small, small, used):
                bin_[-1:] = pair
                for n in pair:
                    used[n] = used.get(n, 0) + 1
            else:
                used[small] += 1
        copies = min(left[n] // k for n, k in used.items() if k)
        for n, k in used.items():
            left[n] -= k * copies
            if not left[n]:
                del left[n]
                lengths.remove(n)
        out.append((sorted(bin_, reverse=True), copies))
    return out


def placed(ranked: DataFrame, patterns: list[tuple[list[int], int]]) -> DataFrame:
    """``ranked`` (length, slot: number among the pieces of the length) with sequence_id and offset.

    Each use of a length in a pattern takes one number of that length per copy, so the uses cut the numbers of a
    length into ranges: (length, first number, first sequence, offset). There are fewer than capacity x capacity
    uses; they travel with the task's code.
    """
    uses: dict[int, list[tuple[int, int, int]]] = {}
    taken: dict[int, int] = {}
    sequence = 0
    for lengths, copies in patterns:
        offset = 0
        for n in lengths:
            uses.setdefault(n, []).append((taken.get(n, 0), sequence, offset))
            taken[n] = taken.get(n, 0) + copies
            offset += n
        sequence += copies
    tables = {n: np.array(u, np.int64).T for n, u in uses.items()}
    schema = ranked.drop("slot").schema

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, slot = batch.column("length").to_numpy(), batch.column("slot").to_numpy()
            seq, off = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)
            order = np.argsort(n, kind="stable")
            for rows in np.split(order, np.flatnonzero(np.diff(n[order])) + 1):
                if len(rows):
                    first, sequences, offsets = tables[int(n[rows[0]])]
                    use = np.searchsorted(first, slot[rows], "right") - 1
                    seq[rows], off[rows] = sequences[use] + slot[rows] - first[use], offsets[use]
            keep = [i for i, f in enumerate(batch.schema.names) if f != "slot"]
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in keep] + [pa.array(seq), pa.array(off)],
                                             names=[batch.schema.names[i] for i in keep] + ["sequence_id", "offset"])

    return ranked.mapInArrow(place, schema.add("sequence_id", "long").add("offset", "long"))


def pack(docs: DataFrame, tokenizer: str, capacity: int = 2048, closing: int = 0) -> DataFrame:
    """Pieces of ``docs`` with the sequence and the offset that each got; written once, then packed by length."""
    cut = materialize(pieces(docs, tokenizer, capacity, closing), "pieces")
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    buckets = max(1, -(-sum(counts.values()) // ROWS_PER_BUCKET))
    bucket = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets))
    ranked = slots(cut, "length", bucket, [F.col("doc_id"), F.col("piece"), F.col("ids_crc32")], "slot")
    return placed(ranked, best_two_fit(counts, capacity))


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op7_packing")
def op7_packing(spark: SparkSession, sf_dir: str, tokenizer: str | None = None, capacity: int = 2048) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"), tokenizer or tokenizer_path(), capacity)
