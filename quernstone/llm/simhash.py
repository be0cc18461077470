"""SimHash near-duplicates found by covering locality-sensitive hashing.

A fingerprint bit is set if over half of the shingles' XXH64 values have it. For radius r,
every bit position is given a vector of r + 1 bits, and table v (each v other than 0) looks
only at positions whose vector has an odd product with v. Any r differing positions leave some
v orthogonal to all of them, so each pair within the radius agrees in full on some table's bits.

A bucket of more than BUCKET distinct fingerprints is not compared as a whole: its members agree
on the table's bits, so they are dealt out again by tables over the bits left (half as many each
time), with the same guarantee, until a bucket is bounded by two to the number of bits left.
Within a bucket each fingerprint is linked to the least one of its group there; never are all pairs returned.

Nulls and ties: a null text counts as empty; texts without words have fingerprint 0 and link like
any other. A null doc_id has a fingerprint; it names a component only if the component has no other id
(then component_id is null). Repeated rows stay repeated. Columns besides doc_id and text are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, enter, materialize, utf8

BITS = 64
#: Distinct fingerprints compared with each other in one bucket; larger ones are dealt out again.
BUCKET = 2048


def simhash(text: bytes | None, words: int = 4, seed: int = 42) -> int:
    """The fingerprint of one UTF-8 text."""
    tokens = (text or b"").lower().split()
    if not tokens:
        return 0
    joined, n = b" ".join(tokens), len(tokens)
    if n <= words:
        hashes = xxhash.xxh64_digest(joined, seed)
    else:
        ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, n) + 1)
        starts = np.concatenate(([0], ends[: n - words]))
        digest = xxhash.xxh64_digest
        hashes = b"".join([digest(joined[a:b], seed) for a, b in zip(starts.tolist(), (ends[words - 1 :] - 1).tolist(), strict=True)])
    each = np.frombuffer(hashes, np.uint8).reshape(-1, 8)
    counts = sum(np.unpackbits(each[i : i + 16384], axis=1).sum(axis=0, dtype=np.int64) for i in range(0, len(each), 16384))
    return int.from_bytes(np.packbits(counts * 2 > len(each)).tobytes(), "big")


def fingerprints(docs: DataFrame, words: int = 4, seed: int = 42) -> DataFrame:
    """doc_id, row (a hash of the text) and fp, the fingerprint as a signed long."""

    def run(batches):
        enter("simhash")
        for b in batches:
            fps = [simhash(t, words, seed) for t in utf8(b.column("text"))]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("row"), pa.array(np.array(fps, np.uint64).view(np.int64))], ["doc_id", "row", "fp"])

    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long"), F.xxhash64(text).alias("row"), text.alias("text")).mapInArrow(run, "doc_id long, row long, fp long")


def cover(free: list[int], radius: int) -> list[int]:
    """Masks over the bit positions in free; any `radius` positions are all outside some mask."""
    n = 2 ** (radius + 1) - 1
    vector = {bit: k % n + 1 for k, bit in enumerate(free)}
    return [sum(1 << bit for bit, x in vector.items() if (x & v).bit_count() % 2) for v in range(1, n + 1)]


class Tables:
    """Masks of a table's path: number t at level 1, t * 2^(radius+1) + u below it, and so on."""

    def __init__(self, radius: int):
        self.radius, self.step, self.known = radius, 2 ** (radius + 1), {0: (0, 0)}

    def mask(self, path: int) -> int:
        """Every bit on which a bucket of this table agrees."""
        if path not in self.known:
            up, v = divmod(path, self.step)
            above = self.mask(up)
            masks = cover([i for i in range(BITS) if not above >> i & 1], self.radius)
            self.known[up * self.step + v] = above | masks[v - 1]
        return self.known[path] if path else 0

    def below(self, path: int) -> list[int]:
        return [path * self.step + v for v in range(1, self.step)]


def stars(fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Edges from each of some distinct fingerprints (uint64) to the least one it is connected with."""
    edges, left = [], fps
    while len(left) > 1:
        open_, group, left = [left[0]], [int(left[0])], left[1:]
        while open_ and len(left):
            near = np.bitwise_count(left ^ open_.pop()) <= radius
            if near.any():
                open_ += list(left[near])
                group += left[near].tolist()
                left = left[~near]
        least = min(group)
        edges += [(least, x) for x in group if x != least]
    return edges


def bucketed(rows: DataFrame, radius: int, bucket: int) -> DataFrame:
    """rows: path, key, fp. Returns edges (deep false: a, b) and rows to deal out again (deep true: path, key, a as fp)."""

    def run(batches):
        enter("simhash")
        tables, step = Tables(radius), np.uint64(radius)

        def large(path: int, n: int) -> bool:
            return n > bucket and tables.mask(path).bit_count() < BITS - 9

        def dealt(rows: np.ndarray):
            """Rows of one bucket, for each table over the bits left."""
            path, fps = int(rows[0, 0]), np.ascontiguousarray(rows[:, 2]).view(np.uint64)
            return [np.column_stack([np.ones(len(fps), np.int64), np.full(len(fps), p), (fps & np.uint64(tables.mask(p))).view(np.int64), fps.view(np.int64), np.zeros(len(fps), np.int64)]) for p in tables.below(path)]

        def work(rows: np.ndarray):
            """Whole buckets."""
            starts = np.flatnonzero(np.r_[True, (rows[1:, :2] != rows[:-1, :2]).any(axis=1)])
            sizes = np.diff(np.r_[starts, len(rows)])
            fps, out = np.ascontiguousarray(rows[:, 2]).view(np.uint64), []
            two = starts[sizes == 2]
            near = two[np.bitwise_count(fps[two] ^ fps[two + 1]) <= step]
            found = [np.column_stack([np.zeros((len(near), 3), np.int64), fps[near].view(np.int64), fps[near + 1].view(np.int64)])]
            for s, n in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
                if large(int(rows[s, 0]), n):
                    found += dealt(rows[s : s + n])
                else:
                    out += stars(fps[s : s + n], radius)
            if out:
                e = np.array(out, np.uint64).view(np.int64)
                found.append(np.column_stack([np.zeros((len(e), 3), np.int64), e]))
            return found

        def record(found):
            all_ = np.concatenate([np.empty((0, 5), np.int64), *found])
            return pa.RecordBatch.from_arrays([pa.array(all_[:, 0] == 1), *(pa.array(np.ascontiguousarray(all_[:, k])) for k in range(1, 5))], ["deep", "path", "key", "a", "b"])

        count, deep = 0, False
        held: list[np.ndarray] = []  # of the bucket that the last batch ended in; once it is large, its rows are dealt on as they come
        for batch in batches:
            rows = np.column_stack([batch.column(k).to_numpy(zero_copy_only=False) for k in ("path", "key", "fp")])
            if not len(rows):
                continue
            found, change = [], np.flatnonzero((rows[1:, :2] != rows[:-1, :2]).any(axis=1)) + 1
            first = 0
            if held and (held[0][0, :2] == rows[0, :2]).all():
                first = int(change[0]) if len(change) else len(rows)
                held.append(rows[:first])
                count += first
            if held and (deep or large(int(held[0][0, 0]), count)):
                fresh = held[1:] if deep else held
                if fresh:
                    found += dealt(np.concatenate(fresh))
                held, deep = held[:1], True  # the first rows stay to know the bucket by
            if first < len(rows):
                if held and not deep:
                    found += work(np.concatenate(held))
                last = max(first, int(change[-1]) if len(change) else 0)
                if last > first:
                    found += work(rows[first:last])
                held, count, deep = [rows[last:]], len(rows) - last, False
            yield record(found)
        if held and not deep:
            yield record(work(np.concatenate(held)))

    return rows.mapInArrow(run, "deep boolean, path long, key long, a long, b long")


def links(fps: DataFrame, radius: int = 4, bucket: int = BUCKET) -> DataFrame:
    """Edges a, b between distinct fingerprints (column fp) that connect just what the links connect."""
    tables = Tables(radius)
    first = F.array(*(F.struct(F.lit(p).cast("long").alias("path"), F.col("fp").bitwiseAND(F.lit(signed(tables.mask(p)))).alias("key")) for p in tables.below(0)))
    rows = fps.select(F.explode(first).alias("x"), "fp").select("x.path", "x.key", "fp")
    found = []
    while True:
        n = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        out = materialize(bucketed(rows.repartition(n, "path", "key").sortWithinPartitions("path", "key"), radius, bucket))
        found.append(out.filter(~F.col("deep")).select("a", "b"))
        rows = out.filter("deep").select("path", "key", F.col("a").alias("fp"))
        if rows.isEmpty():
            break
    edges = found[0]
    for x in found[1:]:
        edges = edges.unionByName(x)
    return edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def signed(x: int) -> int:
    return x - 2**64 if x >= 2**63 else x


def components(edges: DataFrame) -> DataFrame:
    """node, root (the least node reached) of every node in edges (a, b): alternating large and small stars,
    each round a table in the shared folder. Only two numbers a round come to the driver."""
    edges, before = materialize(edges.filter("a <> b").select("a", "b")), None
    while True:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v")
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(low, "u").select(F.col("v").alias("b"), F.col("m").alias("a")).union(low.select(F.col("u").alias("b"), F.col("m").alias("a"))).filter("a <> b").select("a", "b").distinct()
        edges = materialize(small)
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == before:
            return edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root"))
        before = now


def near_duplicates(docs: DataFrame, words: int = 4, seed: int = 42, radius: int = 4, bucket: int = BUCKET) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (the least doc_id reachable by links), row (a hash of the text, that tells rows of one id apart)."""
    bounded_batches(docs.sparkSession)
    each = materialize(fingerprints(docs, words, seed))
    classes = materialize(each.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = materialize(components(links(classes.select("fp"), radius, bucket)))
    # the ids of linked classes only: a small part of all
    linked = classes.join(roots.select(F.col("node").alias("fp"), "root"), "fp").unionByName(classes.join(roots.select(F.col("root").alias("fp")).distinct(), "fp").withColumn("root", F.col("fp")))
    named = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    moved = linked.join(named, "root").select("fp", "component_id")
    # written down, so that the last join reads both its sides from their shuffles and a fingerprint with any share of the rows can be split there
    ids = materialize(classes.join(moved, "fp", "left").select("fp", F.coalesce("component_id", "least").alias("component_id")))
    return each.join(ids, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "row")
