"""N-gram Jaccard join with parity sketches.

Two documents link when the distinct word shingles of one and the other have a Jaccard similarity of at least
``percent`` / 100. Linked sets are of similar size and differ in few shingles: sets in one size band or the next differ in
at most D shingles, a number that follows from the band. For every pair of neighbouring bands the shingles of a set are
dealt by hash to m > D parts, and each part keeps the XOR of its shingles' hashes. A shingle in one set only
changes one part, so the number of parts that differ (the Hamming distance of these sketches) is a lower bound of the
symmetric difference, and by the pigeonhole principle linked sets agree in a part. A bucket is (band, part, value).

Buckets are not paired up: each member is compared with the bucket's smallest id, and after components are formed only
members that are still in different components are, in blocks of bounded size. A second sketch of one parity bit per
position rules out pairs whose Hamming distance is too large. The others are verified on their whole shingle sets (64-bit
hashes): a star as a group of its own, with its centre's set held once, and what is left of a bucket inside its blocks,
each pair in the smallest of the buckets that both are left in. A block sends back links that span its components, so
neither candidates nor links of a group become a row per pair.

Parts without shingles say little: with m = D + 1 + slack parts, linked sets agree in slack + 1 parts, so a set
with at most ``slack`` empty parts need not use them, and one with more uses them too.

Defined cases: a text of fewer words than a shingle is one shingle; texts without words have none and link with nothing;
rows that repeat a ``doc_id`` are one vertex with the links of all their texts, so are rows with a null ``doc_id`` (whose
component is null if nothing else is in it), but in :func:`one_of_each` each of their texts is a vertex of its own; an
empty table gives no rows; other columns are ignored by the query and kept by :func:`one_of_each`.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from punctua.llm.catalog import query
from punctua.llm.common import LAST_ID, SPACES, Words, grams, keyed, mix, pair_hash, partitions, read, row_key, steps
from punctua.llm.components import components
from punctua.session import materialize

SHINGLE, PERCENT = 4, 85
#: Positions of the second sketch, one parity bit each: a power of two, BITS at least and BITS_PER_SHINGLE for each shingle, so
#: that sets of any size that differ in too much differ in many positions. A longer sketch folds to a shorter one.
BITS, BITS_PER_SHINGLE = 1024, 1.5
#: Most members of a bucket, and about the most shingles of theirs, that are one side of a comparison of blocks.
BLOCK, BLOCK_SHINGLES = 1024, 1 << 20
#: Most ids that are broadcast to pick out their texts (16 bytes each, so 8 MB).
BROADCAST_IDS = 500_000
#: Members of a star that are verified against its centre in one group.
STAR = 2048
#: Sets that a task remembers so that copies in it give their sketch once.
SEEN = 1 << 19
#: Buckets that have FREQUENT members among one in ONE_IN rows are met by aggregation, HOT_KEYS of them at most; the rest
#: by a window. This chooses the plan only: either way finds the same members.
ONE_IN, FREQUENT, HOT_KEYS = 64, 32, 10_000


#: A bucket's key has its band in the lowest bits; all bands from this one on have its number.
LAST_BAND = 255


class Bands:
    """Size bands: a set in band k links with sets of at least its size only in bands k and k + 1."""

    def __init__(self, percent: int):
        self.percent = percent
        self.first = [1]
        self.parts: list[int] = []
        self.slack: list[int] = []

    def upto(self, n: int) -> None:
        while self.first[-1] <= n:
            lo = self.first[-1]
            hi = 100 * lo // self.percent
            self.first.append(hi + 1)
            most = (100 - self.percent) * (hi + 100 * hi // self.percent) // (100 + self.percent)
            slack = 0
            if most:
                slack = 1 + int(2 * (most + 2) * math.exp(-lo / (most + 2)))
            self.parts.append(most + 1 + slack)
            self.slack.append(slack)

    def largest(self) -> list[int]:
        """By band number, up to LAST_BAND: the largest set in a bucket of that band."""
        while len(self.first) < LAST_BAND + 3:
            self.upto(self.first[-1])
        return [min(self.first[k + 2] - 1, 1 << 40) for k in range(LAST_BAND + 1)]


def shingle_sets(w: Words, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of the distinct shingles of each text, sorted by text and hash."""
    n = np.diff(w.first)
    g = grams(w.hash, shingle)
    whole = w.doc[:len(g)] == w.doc[shingle - 1:] if len(g) else np.zeros(0, bool)
    doc, h = [w.doc[:len(g)][whole]], [g[whole]]
    for k in range(1, shingle):
        short = np.flatnonzero(n == k)
        if len(short):
            doc.append(short)
            h.append(grams(w.hash, k)[w.first[short]])
    doc, h = np.concatenate(doc), np.concatenate(h)
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.r_[True, (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])] if len(h) else np.zeros(0, bool)
    return doc[new], h[new]


def per_text(doc: np.ndarray, values: np.ndarray, n: int, how=np.bitwise_xor) -> np.ndarray:
    out = np.zeros(n, np.uint64)
    if len(doc):
        begin = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
        out[doc[begin]] = how.reduceat(values, begin)
    return out


def folded(sketches: list[bytes], size: int) -> np.ndarray:
    """Sketches of ``size`` bytes or more as a matrix of 64-bit numbers, longer ones folded: a position stands for all that are
    equal to it modulo the shorter length."""
    out = np.zeros((len(sketches), size // 8), np.uint64)
    for i, b in enumerate(sketches):
        out[i] = np.bitwise_xor.reduce(np.frombuffer(b, np.uint64).reshape(-1, size // 8), axis=0)
    return out


def sets(rows: DataFrame, shingle: int) -> DataFrame:
    """k_id, k_text, n (size of the shingle set), sa and sb (two hashes of the set), bits (parity sketch)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column("k_id"), batch.column("k_text")
            for a, b, data, offs in steps(batch.column("text"), lower=True):
                doc, h = shingle_sets(Words(data, offs, SPACES), shingle)
                n, size = b - a, np.bincount(doc, minlength=b - a)
                wide = np.maximum(BITS, 1 << np.ceil(np.log2(np.maximum(1, BITS_PER_SHINGLE * size))).astype(np.int64))
                ends = np.cumsum(wide)
                place = (ends - wide)[doc] + (mix(h) & (wide[doc] - 1).astype(np.uint64)).astype(np.int64)
                bits = np.packbits(np.bincount(place, minlength=ends[-1]) & 1 == 1).tobytes()
                cuts = [0, *(ends // 8).tolist()]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, n), texts.slice(a, n), pa.array(size),
                     pa.array(per_text(doc, mix(h), n).view(np.int64)), pa.array(per_text(doc, mix(~h), n, np.add).view(np.int64)),
                     pa.array([bits[x:y] for x, y in zip(cuts, cuts[1:])], pa.binary())], names=["k_id", "k_text", "n", "sa", "sb", "bits"])

    return rows.select("text", "k_id", "k_text").mapInArrow(run, "k_id long, k_text long, n long, sa long, sb long, bits binary")


def sketches(rows: DataFrame, shingle: int, percent: int) -> DataFrame:
    """key (bucket), id: the parts of each set's sketches, for its own band and the one below."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands, seen = Bands(percent), set()
        for batch in batches:
            ids = batch.column("k_id").to_numpy()
            for a, b, data, offs in steps(batch.column("text"), lower=True):
                doc, h = shingle_sets(Words(data, offs, SPACES), shingle)
                n = np.bincount(doc, minlength=b - a)
                name = per_text(doc, mix(h), b - a)
                keep = n > 0
                for i in np.flatnonzero(keep).tolist():
                    key = (int(name[i]), int(n[i]))
                    if key in seen:
                        keep[i] = False
                    elif len(seen) < SEEN:
                        seen.add(key)
                use = keep[doc]
                doc, h = doc[use], h[use]
                if not len(doc):
                    continue
                bands.upto(int(n.max()))
                own = np.searchsorted(bands.first, n, "right") - 1
                parts, slack = np.array(bands.parts), np.array(bands.slack)
                value = mix(h)
                keys, who, of_band = [], [], []
                for down in (0, 1):  # as the smaller or equal, and as the larger of a pair
                    ok = own[doc] - down >= 0
                    d, v = doc[ok], value[ok]
                    band = own[d] - down
                    # hashes ascend within a text, so do parts
                    part = ((h[ok] >> np.uint64(32)) * parts[band].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
                    begin = np.flatnonzero(np.r_[True, (d[1:] != d[:-1]) | (part[1:] != part[:-1])]) if len(d) else np.zeros(0, np.int64)
                    if not len(begin):
                        continue
                    x = np.bitwise_xor.reduceat(v, begin)
                    place = (band[begin] * (1 << 32) + part[begin]).astype(np.uint64)
                    keys.append(pair_hash(place, x))
                    who.append(d[begin])
                    of_band.append(band[begin])
                    full = np.bincount(d[begin], minlength=b - a)
                    band_of = own - down
                    at = np.flatnonzero((full > 0) & (band_of >= 0))
                    at = at[parts[band_of[at]] - full[at] > slack[band_of[at]]]
                    for i in at.tolist():
                        some = part[begin][d[begin] == i]
                        none = np.setdiff1d(np.arange(parts[band_of[i]]), some)
                        keys.append(pair_hash((band_of[i] * (1 << 32) + none).astype(np.uint64), np.zeros(len(none), np.uint64)))
                        who.append(np.full(len(none), i))
                        of_band.append(np.full(len(none), band_of[i]))
                keys, who = np.concatenate(keys), np.concatenate(who)
                keys = (keys & ~np.uint64(LAST_BAND)) | np.minimum(np.concatenate(of_band), LAST_BAND).astype(np.uint64)
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(ids[a + who])], names=["key", "id"])

    return rows.select("text", "k_id").mapInArrow(run, "key long, id long")


def met_members(rows: DataFrame, shingle: int, percent: int) -> DataFrame:
    """key, id, lo: members of buckets with two ids or more, and the smallest id of each bucket.

    A window sees a whole bucket in one task, so buckets that may hold a large share of all rows are aggregated
    instead (combined on the map side), and their members, written once, meet the few totals by broadcast.
    """
    def totals(of):
        return {"lo": of(F.min("id")), "hi": of(F.max("id"))}

    some = rows.where(F.pmod(F.xxhash64("k_id", "k_text"), F.lit(ONE_IN)) == 0)
    hot = materialize(sketches(some, shingle, percent).groupBy(F.col("key").alias("h_key")).agg(F.count(F.lit(1)).alias("c"))
                      .where(F.col("c") >= FREQUENT).orderBy(F.desc("c"), "h_key").limit(HOT_KEYS).select("h_key"), "hot-buckets")
    every = sketches(rows, shingle, percent)
    at_hot = F.col("key") == F.col("h_key")
    bucket = Window.partitionBy("key")
    met = (every.join(F.broadcast(hot), at_hot, "left_anti").withColumns(totals(lambda c: c.over(bucket)))
           .where("lo != hi").select("key", "id", "lo"))
    if hot.limit(1).count():
        members = materialize(every.join(F.broadcast(hot), at_hot, "left_semi"), "hot-members")
        stat = members.groupBy(F.col("key").alias("h_key")).agg(
            *[c.alias(n) for n, c in totals(lambda c: c).items()]).where("lo != hi")  # HOT_KEYS rows at most
        met = met.unionByName(members.join(F.broadcast(stat), at_hot).select("key", "id", "lo"))
    return met


def close_enough(pairs: DataFrame, known: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose sizes and parity sketches allow a link."""
    side = known.select("k_id", F.col("n").alias("n"), "bits")
    left = side.select(F.col("k_id").alias("la"), F.col("n").alias("na"), F.col("bits").alias("ba"))
    right = side.select(F.col("k_id").alias("lb"), F.col("n").alias("nb"), F.col("bits").alias("bb"))
    both = (pairs.join(left, F.col("a") == F.col("la")).join(right, F.col("b") == F.col("lb"))
            .where((F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent) & (F.least("na", "nb") > 0))
            .select("a", "b", "na", "nb", "ba", "bb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (batch.column(c).to_pylist() for c in ("ba", "bb"))
            size = np.minimum([len(b) for b in x], [len(b) for b in y])
            far = np.zeros(len(x), np.int64)
            for k in np.unique(size).tolist():
                at = np.flatnonzero(size == k).tolist()
                far[at] = np.bitwise_count(folded([x[i] for i in at], k) ^ folded([y[i] for i in at], k)).sum(1, dtype=np.int64)
            total = batch.column("na").to_numpy() + batch.column("nb").to_numpy()
            ok = far * (100 + percent) <= (100 - percent) * total
            yield batch.select(["a", "b"]).filter(pa.array(ok))

    return both.mapInArrow(run, "a long, b long").distinct()


def in_groups(rows: DataFrame, by: list[str], order: list[str], work: Callable[[pa.Table], pa.RecordBatch | None], schema: str) -> DataFrame:
    """``work`` on the rows of each group, which are held at once; many small groups cost little."""
    dealt = rows.repartition(partitions(rows.sparkSession), *by).sortWithinPartitions(*by, *order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            place = np.stack([batch.column(c).to_numpy() for c in by])
            new = np.flatnonzero((place[:, 1:] != place[:, :-1]).any(0)) + 1
            at = 0
            for end in [*new.tolist(), batch.num_rows]:
                if end == at:
                    continue
                part = batch.slice(at, end - at)
                if held and any(held[-1].column(c)[0] != part.column(c)[0] for c in by):
                    if (out := work(pa.Table.from_batches(held))) is not None:
                        yield out
                    held = []
                held.append(part)
                at = end
        if held and (out := work(pa.Table.from_batches(held))) is not None:
            yield out

    return dealt.mapInArrow(run, schema)


def lists(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(values, offsets) of Arrow lists of longs."""
    column = column.combine_chunks()
    ends = column.offsets.to_numpy().astype(np.int64)
    return column.flatten().to_numpy(), ends - ends[0]


def counts_in(one: np.ndarray, values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """How many of each list values[starts:ends] are in the sorted ``one``."""
    size = ends - starts
    if not len(one) or not size.sum():
        return np.zeros(len(size), np.int64)
    at = np.repeat(starts - np.r_[0, np.cumsum(size)[:-1]], size) + np.arange(size.sum())
    v = values[at]
    place = np.minimum(np.searchsorted(one, v), len(one) - 1)
    hit = np.r_[0, np.cumsum(one[place] == v)]
    return hit[np.cumsum(size)] - hit[np.cumsum(size) - size]


class Block:
    """A pair of blocks of a bucket: which pairs of members in different components their sizes and sketches allow."""

    def __init__(self, t: pa.Table, percent: int):
        self.ids, self.comp, self.n, own = (t.column(c).to_numpy() for c in ("id", "comp", "n", "own"))
        bits = t.column("bits").to_pylist()
        self.bits = folded(bits, min(map(len, bits)))
        p, q = t.column("p")[0].as_py(), t.column("q")[0].as_py()
        self.left, self.right, self.same, self.percent = np.flatnonzero(own == p), np.flatnonzero(own == q), p == q, percent

    def allowed(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(i, j) of members, for some of the left ones at a time."""
        y, percent = self.right, self.percent
        step = max(1, (1 << 22) // (max(1, len(y)) * self.bits.shape[1]))
        for at in range(0, len(self.left), step):
            x = self.left[at:at + step]
            far = np.bitwise_count(self.bits[x][:, None, :] ^ self.bits[y][None]).sum(2, dtype=np.int64)
            nx, ny = self.n[x][:, None], self.n[y][None]
            ok = (self.comp[x][:, None] != self.comp[y][None]) & (far * (100 + percent) <= (100 - percent) * (nx + ny))
            ok &= np.minimum(nx, ny) * 100 >= np.maximum(nx, ny) * percent
            if self.same:
                ok &= self.ids[x][:, None] < self.ids[y][None]
            i, j = np.nonzero(ok)
            yield x[i], y[j]


MARKED = "key long, p int, q int, own int, id long, comp long, n long, bits binary"


def marked_rows(t: pa.Table, hit: np.ndarray) -> pa.RecordBatch | None:
    if not hit.any():
        return None
    return t.select([c.split()[0] for c in MARKED.split(", ")]).filter(pa.array(hit)).combine_chunks().to_batches()[0]


def marks(t: pa.Table, percent: int) -> pa.RecordBatch | None:
    """Members of a pair of blocks that have a pair that is allowed."""
    block = Block(t, percent)
    hit = np.zeros(len(block.ids), bool)
    for i, j in block.allowed():
        hit[i] = hit[j] = True
    return marked_rows(t, hit)


def own_pairs(block: Block, t: pa.Table) -> Iterator[tuple[int, np.ndarray]]:
    """(x, ys) of allowed pairs whose smallest bucket, of those (``keys``) that both are marked in, is this one."""
    key = t.column("key")[0].as_py()
    keys, at = lists(t.column("keys"))
    for i, j in block.allowed():
        cuts = np.flatnonzero(np.diff(i)) + 1  # i ascends
        for x, y in zip(i[np.r_[0, cuts]].tolist() if len(i) else [], np.split(j, cuts)):
            own = keys[at[x]:at[x + 1]]
            y = y[counts_in(own[own < key], keys, at[y], at[y + 1]) == 0]
            if len(y):
                yield x, y


def own_marks(t: pa.Table, percent: int) -> pa.RecordBatch | None:
    """Members of a pair of blocks that have a pair to be decided here."""
    block = Block(t, percent)
    hit = np.zeros(len(block.ids), bool)
    for x, y in own_pairs(block, t):
        hit[x] = hit[y] = True
    return marked_rows(t, hit)


def hashes(texts: pa.ChunkedArray, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """(values, offsets): the sorted shingle hashes of each text."""
    values, size = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)]
    for a, b, data, offs in steps(texts, lower=True):
        doc, h = shingle_sets(Words(data, offs, SPACES), shingle)
        values.append(h)
        size.append(np.bincount(doc, minlength=b - a))
    return np.concatenate(values), np.cumsum(np.concatenate(size))


def spanning(t: pa.Table, shingle: int, percent: int) -> pa.RecordBatch | None:
    """Links (a, b) that join the components of a pair of blocks, by the members' whole texts."""
    block = Block(t, percent)
    h, at = hashes(t.column("text"), shingle)
    root = {c: c for c in block.comp.tolist()}

    def find(c: int) -> int:
        while root[c] != c:
            root[c] = c = root[root[c]]
        return c

    out = []
    for x, y in own_pairs(block, t):
        mine = find(block.comp[x].item())
        y = y[[find(c) != mine for c in block.comp[y].tolist()]]
        if not len(y):
            continue
        both = counts_in(h[at[x]:at[x + 1]], h, at[y], at[y + 1])
        for k in y[100 * both >= percent * (block.n[x] + block.n[y] - both)].tolist():
            a, b = find(block.comp[x].item()), find(block.comp[k].item())
            if a != b:
                root[b] = a
                out.append((block.ids[x].item(), block.ids[k].item()))
    if not out:
        return None
    return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["a", "b"])


def texts_of(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """t_id, text: the text of each of the ``ids`` (v), once. Up to BROADCAST_IDS, which are counted, ids go to the texts; more
    of them meet the texts in a shuffle."""
    ids = materialize(ids.select("v"), "asked-ids")
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    some = rows.join(ids, F.col("k_id") == F.col("v"), "left_semi")
    return some.dropDuplicates(["k_id"]).select(F.col("k_id").alias("t_id"), "text")


def links_in_buckets(members: DataFrame, known: DataFrame, rows: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Links (a, b) that join the components of ``members`` (key, id, comp, m: size of the bucket) further.

    A bucket with more members or shingles than a block holds is cut into blocks by id, and each pair of blocks is a group of
    its own. First the sketches are compared, which marks the members of pairs that may link; then each such pair finds its
    one bucket among those that both are marked in; only members with a pair of that bucket get their texts and meet again.
    """
    largest = F.array(*[F.lit(x).cast("long") for x in Bands(percent).largest()])
    shingles = F.col("m") * F.get(largest, F.col("key").bitwiseAND(F.lit(LAST_BAND)).cast("int"))
    blocks = F.greatest(F.ceil(F.col("m") / F.lit(BLOCK)), F.least(F.col("m"), F.ceil(shingles / F.lit(BLOCK_SHINGLES)))).cast("int")
    side = known.select(F.col("k_id").alias("s_id"), F.col("n").alias("n"), "bits").distinct()
    dealt = members.join(side, F.col("id") == F.col("s_id")).withColumns(
        {"own": F.pmod(F.xxhash64("id"), blocks).cast("int"), "blocks": blocks})
    dealt = dealt.select("key", "id", "comp", "n", "bits", "own", F.explode(
        F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    dealt = dealt.select("key", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), "own", "id", "comp",
                         "n", "bits")
    group = ["key", "p", "q"]
    marked = materialize(in_groups(dealt, group, [], lambda t: marks(t, percent), MARKED), "marked")
    if not marked.limit(1).count():
        return marked.select(F.col("id").alias("a"), F.col("id").alias("b"))
    keys = marked.groupBy(F.col("id").alias("v")).agg(F.array_sort(F.collect_set("key")).alias("keys"))
    keys = materialize(keys, "marked-buckets")
    at_id = F.col("id") == F.col("v")
    asked = materialize(in_groups(marked.join(keys, at_id).drop("v"), group, [], lambda t: own_marks(t, percent), MARKED), "asked")
    few = asked.select(F.col("id").alias("v")).distinct()
    full = asked.join(keys, at_id).drop("v").join(texts_of(rows, few), F.col("id") == F.col("t_id")).drop("t_id")
    return in_groups(full, group, [], lambda t: spanning(t, shingle, percent), "a long, b long")


def verified(pairs: DataFrame, rows: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Pairs (a, b) that link, by their whole texts. ``a`` may be in any number of pairs: its partners are dealt by hash
    to groups of about STAR, and each group holds the text of ``a`` once."""
    ids = pairs.select(F.col("a").alias("v")).unionByName(pairs.select(F.col("b").alias("v"))).distinct()
    groups = pairs.groupBy(F.col("a").alias("g_a")).agg(F.ceil(F.count(F.lit(1)) / F.lit(STAR)).cast("int").alias("groups"))
    centres = groups.select(F.col("g_a").alias("a"), F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("no"), F.col("g_a").alias("b"))
    # a third of all pairs may have one centre: those with several groups, few, are met apart
    large = groups.where("groups > 1")
    dealt = pairs.join(large, F.col("a") == F.col("g_a"), "left").select(
        "a", F.coalesce(F.pmod(F.xxhash64("b"), F.col("groups")), F.lit(0)).cast("int").alias("no"), "b")
    work = dealt.unionByName(centres).join(texts_of(rows, ids), F.col("b") == F.col("t_id")).select(
        "a", "no", (F.col("a") != F.col("b")).cast("int").alias("kind"), "b", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, centre = None, None
        for batch in batches:
            a, no, kind, b = (batch.column(c).to_numpy() for c in ("a", "no", "kind", "b"))
            h, at = hashes(batch.column("text"), shingle)
            cuts = np.flatnonzero((a[1:] != a[:-1]) | (no[1:] != no[:-1])) + 1
            out = []
            for x, y in zip([0, *cuts.tolist()], [*cuts.tolist(), len(a)]):
                if x == y:
                    continue
                if kind[x] == 0:
                    now, centre, x = (a[x], no[x]), h[at[x]:at[x + 1]], x + 1
                if x < y and now == (a[x], no[x]):
                    size = at[x + 1:y + 1] - at[x:y]
                    both = counts_in(centre, h, at[x:y], at[x + 1:y + 1])
                    ok = (both > 0) & (100 * both >= percent * (size + len(centre) - both))
                    out.append(np.arange(x, y)[ok])
            keep = np.concatenate(out) if out else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(b[keep])], names=["a", "b"])

    dealt = work.repartition(partitions(pairs.sparkSession), "a", "no").sortWithinPartitions("a", "no", "kind")
    return dealt.mapInArrow(run, "a long, b long")


def text_numbers(known: DataFrame) -> DataFrame | None:
    """k_id, k_text, v: a number for every distinct id and text, in their order; none if no id has several texts."""
    names = known.select("k_id", "k_text")
    several = names.groupBy("k_id").agg(F.min("k_text").alias("t1"), F.max("k_text").alias("t2")).where("t1 != t2")
    if not several.limit(1).count():
        return None
    return materialize(names.distinct().orderBy("k_id", "k_text").withColumn("v", F.monotonically_increasing_id()),
                       "text-numbers")


def linked(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, join_ids: bool = True) -> DataFrame:
    """k_id, k_text, n (shingles), comp (smallest id reachable), first (of its component) for every row of ``docs``.

    If ids have several texts, each text is a vertex of its own, by its number; ``join_ids`` links those of one id.
    """
    rows = keyed(docs).select("k_id", "k_text", "text")
    known = materialize(sets(rows, shingle), "shingle-sets")
    number = text_numbers(known)
    if number is None:
        comps = vertex_components(rows, known, shingle, percent)
        return known.select("k_id", "k_text", "n").join(comps, F.col("k_id") == F.col("v"), "left").select(
            "k_id", "k_text", "n", F.coalesce("comp", "k_id").alias("comp"),
            (F.coalesce("comp", "k_id") == F.col("k_id")).alias("first"))

    def by_number(df: DataFrame) -> DataFrame:
        return df.join(number, ["k_id", "k_text"]).drop("k_id").withColumnRenamed("v", "k_id")

    first = number.groupBy(F.col("k_id").alias("f_id")).agg(F.min("v").alias("a"))
    one_id = number.join(first, F.col("k_id") == F.col("f_id")).where("a != v").select("a", F.col("v").alias("b"))
    comps = vertex_components(materialize(by_number(rows), "numbered-texts"), materialize(by_number(known), "numbered-sets"),
                              shingle, percent, one_id if join_ids else None)
    names = number.select(F.col("v").alias("c_v"), F.col("k_id").alias("c_id"))
    comps = comps.join(names, F.col("comp") == F.col("c_v")).select(F.col("v").alias("n_v"), "c_v", "c_id")
    found = number.join(comps, F.col("v") == F.col("n_v"), "left").select(
        "k_id", "k_text", F.coalesce("c_id", "k_id").alias("comp"), (F.coalesce("c_v", "v") == F.col("v")).alias("first"))
    return known.select("k_id", "k_text", "n").join(found, ["k_id", "k_text"])


def vertex_components(rows: DataFrame, known: DataFrame, shingle: int, percent: int, more: DataFrame | None = None) -> DataFrame:
    """v, comp of the linked ``k_id``, each of which has one text; ``more``: further edges (a, b)."""
    # a table of its own: joined on the spot, a large group of copies could not be split over tasks
    same = materialize(known.where("n > 0").groupBy("sa", "sb", "n").agg(F.min("k_id").alias("rep"), F.max("k_id").alias("hi"))
                       .where("rep != hi").drop("hi"), "copy-groups")
    copies = known.where("n > 0").join(same, ["sa", "sb", "n"]).select(F.col("k_id").alias("c_id"), "rep")
    copies = materialize(copies.where("c_id != rep").distinct(), "copies")
    met = materialize(met_members(rows, shingle, percent), "buckets")

    def represented(pairs: DataFrame) -> DataFrame:
        """Copies stand back for the smallest id with their set."""
        first, second = (copies.select(F.col("c_id").alias(f"{x}_c"), F.col("rep").alias(f"{x}_r")) for x in "ab")
        out = (pairs.join(first, F.col("a") == F.col("a_c"), "left").join(second, F.col("b") == F.col("b_c"), "left")
               .select(F.coalesce("a_r", "a").alias("x"), F.coalesce("b_r", "b").alias("y")))
        return out.where("x != y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()

    stars = materialize(represented(met.where("id != lo").select(F.col("lo").alias("a"), F.col("id").alias("b")).distinct()), "stars")
    links = materialize(verified(materialize(close_enough(stars, known, percent), "near"), rows, shingle, percent), "links")
    equal = copies.select(F.col("rep").alias("a"), F.col("c_id").alias("b"))
    equal = equal if more is None else equal.unionByName(more)
    comps = components(links.unionByName(equal))
    # what is left: members of one bucket in different components that were not compared yet
    member = met.join(comps, F.col("id") == F.col("v"), "left").select("key", "id", F.coalesce("comp", "id").alias("comp"))
    open_ = member.groupBy(F.col("key").alias("o_key")).agg(
        F.min("comp").alias("c1"), F.max("comp").alias("c2"), F.count(F.lit(1)).alias("m")).where("c1 != c2 and m > 2")
    rest = member.join(open_, F.col("key") == F.col("o_key")).select("key", "id", "comp", "m")
    more_links = materialize(links_in_buckets(rest, known, rows, shingle, percent), "more-links")
    if more_links.limit(1).count():
        comps = components(links.unionByName(more_links).unionByName(equal))
    return comps


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row of ``docs`` for each component: of those with the smallest id, the first by a hash of its columns.

    Links are those of texts: other texts of a linked text's id, or without an id, stay, and so do all rows without words.
    """
    found = materialize(linked(docs, shingle, percent, join_ids=False), "linked")
    gone = materialize(found.where("not first").select(F.col("k_id").alias("g_id"), F.col("k_text").alias("g_text")).distinct(),
                       "linked-copies")
    key = row_key()
    docs = docs.join(gone, (key["k_id"] == F.col("g_id")) & (key["k_text"] == F.col("g_text")), "left_anti")
    # rows that repeat an id and its text; where there are none, the rows need not be dealt by them
    twice = materialize(found.where("n > 0").groupBy(F.col("k_id").alias("t_id"), F.col("k_text").alias("t_text")).agg(
        F.count(F.lit(1)).alias("t_n")).where("t_n > 1").drop("t_n"), "repeated-rows")
    if not twice.limit(1).count():
        return docs
    is_twice = (key["k_id"] == F.col("t_id")) & (key["k_text"] == F.col("t_text"))
    place = Window.partitionBy("t_id", "t_text").orderBy(F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]))
    names = docs.columns
    firsts = docs.join(twice, is_twice).withColumn("t_place", F.row_number().over(place)).where("t_place = 1").select(*[f"`{c}`" for c in names])
    return docs.join(twice, is_twice, "left_anti").unionByName(firsts)


@query("op9_jaccard_join")
def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = linked(read(spark, sf_dir, "documents"))
    return found.select(*[F.when(F.col(c) != LAST_ID, F.col(c)).alias(name) for c, name in
                          (("k_id", "doc_id"), ("comp", "component_id"))], F.col("n").alias("n_shingles"))
