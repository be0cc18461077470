"""Near-duplicates by word shingles: pairs of texts whose sets of WORDS-word shingles have a Jaccard similarity of NEAR or more.

Candidates share all ROWS minimum hashes of one of BANDS bands: a pair at similarity 0.8 is missed with probability (1 - 0.8^5)^24 = 7e-5, one at 0.85 with 8e-7. Each candidate is checked exactly on both sets.
Texts with equal sets are one class. In a bucket each class is checked against the least one. Classes of buckets that still hold more than one component are then told partners by prefix filtering: with shingles in order of
rarity among these classes, a pair at the similarity shares one of the first fifth of each set, at places that leave room for enough others; that misses no pair, and what many texts share ranks last. Minimum hashes then leave out what is clearly not alike. Words are those of the fingerprints (ASCII lower case, split at white space), told apart by 64-bit hashes; a text of fewer words is one shingle.

Nulls and ties: a null text counts as empty; all texts without words are one class.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import NULL_ID, Words, bounded_batches, enter, materialize, parts, rolled, total_bytes, utf8
from .simhash import components, links, simhash

WORDS, BANDS, ROWS = 5, 24, 5
#: Similarity as a fraction, 4 / 5.
NEAR = (4, 5)
#: Rows of one shingle that meet as a block; pairs with one class that are checked in one place.
BLOCK, PAIRS = 2048, 256
#: Of the BANDS * ROWS minimum hashes, those that two sets must have in common to be checked: a pair at similarity 0.8 has fewer with probability 1.4e-6.
AGREE = 76
#: Odd factors and terms of the hashes that minima are taken of.
FACTORS, TERMS = np.random.default_rng(5).integers(0, 2**64, (2, BANDS * ROWS), np.uint64)
FACTORS |= np.uint64(1)


def shingles(texts: list[bytes | None], words: int = WORDS) -> list[np.ndarray]:
    """The distinct shingle hashes of each text, rising."""
    found = Words(texts, lower=True)
    hashes, ends = found.hashes(), np.cumsum(found.counts)
    every, out = rolled(hashes, words), []
    for end, n in zip(ends.tolist(), found.counts.tolist(), strict=True):
        out.append(np.unique(every[end - n : end - words + 1]) if n >= words else rolled(hashes[end - n : end], n) if n else hashes[:0])
    return out


def minima(sets: list[np.ndarray]) -> np.ndarray:
    starts = np.cumsum([0, *map(len, sets[:-1])])
    all_, least = np.concatenate(sets), np.empty((len(sets), BANDS * ROWS), np.uint64)
    for k in range(BANDS * ROWS):
        least[:, k] = np.minimum.reduceat(all_ * FACTORS[k] + TERMS[k], starts)
    return least


def bands(sets: list[np.ndarray]) -> np.ndarray:
    """A key for each band of each set that is not empty."""
    least = minima(sets)
    keys = [xxhash.xxh64_intdigest(row[8 * ROWS * b : 8 * ROWS * (b + 1)], b) for row in (r.tobytes() for r in least) for b in range(BANDS)]
    return np.array(keys, np.uint64).reshape(len(sets), BANDS)


def alike(a: np.ndarray, b: np.ndarray) -> bool:
    if NEAR[1] * min(len(a), len(b)) < NEAR[0] * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return NEAR[1] * both >= NEAR[0] * (len(a) + len(b) - both)


def read(rows: DataFrame) -> DataFrame:
    """_id, _row, fp (fingerprint), c (class of equal shingle sets) and the keys of its bands, for rows of _id, _row, text."""

    def run(batches):
        enter("jaccard")
        for b in batches:
            texts = utf8(b.column("text"))
            sets = shingles(texts)
            full = [k for k, s in enumerate(sets) if len(s)]
            keys: list = [[]] * len(sets)
            if full:
                for k, row in zip(full, bands([sets[k] for k in full]).view(np.int64).tolist(), strict=True):
                    keys[k] = row
            c = np.array([xxhash.xxh64_intdigest(s.tobytes()) for s in sets], np.uint64).view(np.int64)
            fps = np.array([simhash(t) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column("_id"), b.column("_row"), pa.array(fps), pa.array(c), pa.array(keys, pa.list_(pa.int64()))], ["_id", "_row", "fp", "c", "keys"])

    return rows.mapInArrow(run, "_id long, _row long, fp long, c long, keys array<long>")


def checked(pairs: DataFrame, texts: DataFrame, n: int) -> DataFrame:
    """The pairs (a, b) that are alike; texts: c, text. Texts meet their a in a stream, of which one set is held; an a with many pairs is dealt over several places."""
    many = pairs.groupBy("a").agg(F.ceil(F.count("*") / PAIRS).cast("int").alias("places"))
    others = pairs.join(many, "a").select("a", F.pmod(F.xxhash64("b"), F.col("places")).cast("int").alias("place"), F.col("b").alias("c"))
    rows = others.unionByName(many.select("a", F.explode(F.sequence(F.lit(0), F.col("places") - 1)).alias("place"), F.col("a").alias("c")))
    rows = rows.join(texts, "c").select("a", "place", "c", (F.col("a") != F.col("c")).alias("other"), "text")

    def run(batches):
        enter("jaccard")
        at, held = None, None
        for b in batches:
            out = []
            for a, c, one in zip(b.column("a").to_pylist(), b.column("c").to_pylist(), shingles(utf8(b.column("text"))), strict=True):
                if a == c:
                    at, held = a, one
                elif a == at and alike(held, one):
                    out.append((a, c))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], ["a", "b"])

    return rows.repartition(n, "a", "place").sortWithinPartitions("a", "place", "other").mapInArrow(run, "a long, b long")


def stars(rows: DataFrame) -> DataFrame:
    """key, a, b for rows of key, c sorted by both: the least class of each bucket with every other one."""

    def run(batches):
        enter("jaccard")
        last, least, before = None, None, None
        for batch in batches:
            key, c = (batch.column(k).to_numpy() for k in ("key", "c"))
            out = []
            for k, x in zip(key.tolist(), c.tolist(), strict=True):
                if k != last:
                    last, least = k, x
                elif x != before:
                    out.append((k, least, x))
                before = x
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in range(3)], ["key", "a", "b"])

    return rows.mapInArrow(run, "key long, a long, b long")


def prefixes(texts: DataFrame, n: int) -> DataFrame:
    """s, c, size, at: of each class (c, text) the shingles that a partner may be told by. Shingles are put in one order for all, the rare ones first; two sets of similarity NEAR or more share one of the first
    size - NEAR size + 1 in that order. `at` is the place in the order; shingles that no other class has are left out, but counted."""

    def run(batches):
        enter("jaccard")
        for b in batches:
            sets = shingles(utf8(b.column("text")))
            size = [len(x) for x in sets]
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(b.column("c").to_numpy(), size)), pa.array(np.repeat(np.array(size, np.int64), size)), pa.array(np.concatenate([np.zeros(0, np.uint64), *sets]).view(np.int64))], ["c", "size", "s"])

    every = materialize(texts.repartition(n, "c").mapInArrow(run, "c long, size long, s long"))
    shared = every.groupBy("s").agg(F.count("*").alias("often")).filter("often > 1")
    held = every.join(shared, "s").withColumn("alone", F.col("size") - F.count("*").over(Window.partitionBy("c")))
    held = held.withColumn("at", F.col("alone") + F.row_number().over(Window.partitionBy("c").orderBy("often", "s")))
    return held.filter(F.col("at") <= F.col("size") - F.ceil(F.col("size") * NEAR[0] / NEAR[1]) + 1).select("s", "c", "size", "at")


def signatures(texts: DataFrame) -> DataFrame:
    """c and sig, a byte of each minimum hash."""

    def run(batches):
        enter("jaccard")
        for b in batches:
            sets = shingles(utf8(b.column("text")))
            sig = (minima(sets) >> np.uint64(56)).astype(np.uint8) if sets else []
            yield pa.RecordBatch.from_arrays([b.column("c"), pa.array([x.tobytes() for x in sig], pa.binary())], ["c", "sig"])

    return texts.mapInArrow(run, "c long, sig binary")


def partners(rows: DataFrame, n: int, best: bool, block: int = BLOCK) -> DataFrame:
    """Pairs a, b of classes of different roots that share a shingle of their prefixes (rows: s, c, size, at, root, sig) where sizes and places leave room for similarity NEAR, and AGREE minimum hashes are the same.
    best: of each class, in each block, only the one with most of them the same among those before it, so that there are no more pairs than rows. A shingle's rows meet in blocks, and only such pairs leave a task."""
    sizes = rows.groupBy("s").agg(F.count("*").alias("rows")).filter("rows > 1").select("s", F.ceil(F.col("rows") / block).cast("int").alias("blocks"))
    both = rows.join(sizes, "s").withColumn("own", F.pmod(F.xxhash64("c"), F.col("blocks")).cast("int"))
    # block i meets block j at (i, j), i <= j; with one block there is one such place
    both = both.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))
    both = both.select("s", "i", "j", (F.col("own") == F.col("j")).alias("second"), (F.col("own") == F.col("i")).alias("first"), "c", "size", "at", "root", "sig")

    def run(batches):
        enter("jaccard")
        names = ["s", "i", "j", "first", "second", "c", "size", "at", "root"]
        held: list[np.ndarray] = []
        held_sig: list[np.ndarray] = []

        def pairs(rows, sig):
            one, two = rows[:, 3] == 1, rows[:, 4] == 1
            y, y_sig = rows[two], sig[two]
            out = []
            for (c, size, at, root), own in zip(rows[one, 5:].tolist(), sig[one], strict=True):
                room = np.minimum(size - at, y[:, 6] - y[:, 7]) + 1
                fits = np.flatnonzero((room * (NEAR[0] + NEAR[1]) >= NEAR[0] * (size + y[:, 6])) & (y[:, 8] != root) & ((y[:, 5] < c) if best else (y[:, 5] != c)))
                if len(fits):
                    same = (y_sig[fits] == own).sum(axis=1)
                    fits = fits[[np.argmax(same)]] if best and same.max() >= AGREE else fits[:0] if best else fits[same >= AGREE]
                    other = y[fits, 5]
                    out.append(np.column_stack([np.minimum(other, c), np.maximum(other, c)]))
            return np.unique(np.concatenate(out), axis=0) if out else np.zeros((0, 2), np.int64)

        def done():
            found = pairs(np.concatenate(held), np.concatenate(held_sig))
            held.clear()
            held_sig.clear()
            return pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], ["a", "b"])

        for b in batches:
            rows = np.column_stack([b.column(k).cast(pa.int64()).to_numpy(zero_copy_only=False) for k in names])
            if not len(rows):
                continue
            sig = np.frombuffer(b"".join(b.column("sig").to_pylist()), np.uint8).reshape(len(rows), -1)
            starts = np.flatnonzero(np.r_[True, (rows[1:, :3] != rows[:-1, :3]).any(axis=1)])
            for k, (at, end) in enumerate(zip(starts.tolist(), [*starts[1:].tolist(), len(rows)], strict=True)):
                if held and (k or (held[-1][-1, :3] != rows[0, :3]).any()):
                    yield done()
                held.append(rows[at:end])
                held_sig.append(sig[at:end])
        if held:
            yield done()

    return both.repartition(n, "s", "i", "j").sortWithinPartitions("s", "i", "j").mapInArrow(run, "a long, b long").distinct()


def similar(each: DataFrame, rows: DataFrame, n: int) -> DataFrame:
    """Edges a, b between classes that connect just what the alike pairs among candidates connect."""
    one = materialize(each.filter(F.size("keys") > 0).groupBy("c").agg(F.min(F.struct("_id", "_row", "keys")).alias("x")).select("c", "x.*"))
    keyed = one.select(F.explode("keys").alias("key"), "c").repartition(n, "key").sortWithinPartitions("key", "c")
    buckets = materialize(stars(keyed))
    pairs = materialize(buckets.select("a", "b").distinct())
    some = one.join(pairs.select(F.col("a").alias("c")).union(pairs.select("b")).distinct(), "c", "left_semi").select("c", "_id", "_row")
    texts = materialize(rows.join(some, ["_id", "_row"]).select("c", "text").dropDuplicates(["c"]))
    found = materialize(checked(pairs, texts, n))
    # in buckets with more than one component left, pairs of different components that may be alike
    roots = materialize(components(found))
    named = buckets.join(roots.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a", "left").join(roots.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b", "left")
    named = named.select("key", F.explode(F.array(F.struct(F.col("a").alias("c"), F.coalesce("ra", "a").alias("root")), F.struct(F.col("b").alias("c"), F.coalesce("rb", "b").alias("root")))).alias("x")).select("key", "x.*").distinct()
    open_ = named.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y"), F.countDistinct("c").alias("n")).filter("x <> y and n > 2").select("key")
    left = materialize(named.join(open_, "key", "left_semi").select("c", "root").distinct())
    some = materialize(texts.join(left.select("c"), "c", "left_semi"))
    held = materialize(prefixes(some, n).join(signatures(some), "c"))
    # most of a large group of copies is linked by the likeliest partner of each; what then is still apart is looked at pair by pair
    for best in (True, True, False):
        more = materialize(partners(held.join(left, "c"), n, best).join(pairs, ["a", "b"], "left_anti"))
        new = materialize(checked(more, texts, n))
        found = found.unionByName(new)
        if not best:
            return found
        pairs = pairs.unionByName(more)
        joined = new.join(left.select(F.col("c").alias("a"), F.col("root").alias("x")), "a").join(left.select(F.col("c").alias("b"), F.col("root").alias("y")), "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
        merged = components(joined)
        left = materialize(left.join(merged.select(F.col("node").alias("root"), F.col("root").alias("to")), "root", "left").select("c", F.coalesce("to", "root").alias("root")))


def groups(docs: DataFrame) -> DataFrame:
    """_id (NULL_ID for null), _row (a hash of the text) and group of each row: linked by alike shingle sets or by fingerprints within the operator's radius."""
    bounded_batches(docs.sparkSession)
    text = F.col("text").cast("string")
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("_id"), F.xxhash64(text).alias("_row"), text.alias("text"))
    n = parts(docs.sparkSession, total_bytes(docs), 16 << 20)
    each = materialize(read(rows))
    known = materialize(each.select("fp", "c").distinct())
    first = materialize(known.groupBy("fp").agg(F.min("c").alias("first")))
    near = links(first.select("fp"))
    edges = known.join(first, "fp").filter("c <> first").select(F.col("first").alias("a"), F.col("c").alias("b"))
    near = near.join(first.select(F.col("fp").alias("a"), F.col("first").alias("x")), "a").join(first.select(F.col("fp").alias("b"), F.col("first").alias("y")), "b")
    edges = edges.unionByName(near.select(F.col("x").alias("a"), F.col("y").alias("b"))).unionByName(similar(each, rows, n))
    roots = components(edges)
    return each.join(roots.select(F.col("node").alias("c"), "root"), "c", "left").select("_id", "_row", F.coalesce("root", "c").alias("group"))
