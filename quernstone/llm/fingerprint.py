"""Document fingerprints: quartile bucket digests of hashed byte triplets.

Six triplets of every five consecutive bytes are hashed into BUCKETS counters; a digest holds for each bucket the quartile its count falls into (two bits),
after one byte for the length on a log scale. Digests are compared by a difference score with a fixed bound: quartile distances bucket by bucket (opposite quartiles weigh double)
and the distance of the length codes, as a share of the bound; likeness is 1 less that share.

Each text is also compared with an edited copy, its last half replaced by the start of the next document (by descending doc_id, after the last the first). Documents are
range-partitioned by id, so neighbours meet in a stream; only the first and last row of a partition wait, in a table in the shared folder, for the partition next to theirs.

Nulls and ties: a null text counts as empty; its digest has all buckets in the lowest quartile, as has that of a text under five bytes (told apart only by length). A null doc_id comes after
every other; rows with one id are ordered by a hash of their text, and repeated rows stay repeated. A single document is its own neighbour. Columns besides doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches, materialize, parts, total_bytes

BUCKETS = 256
#: Bytes hashed at once; bytes of text in a range of ids (a task holds two texts of it at a time, and the sample that sets the ranges grows with their number).
PIECE, PART = 1 << 20, 128 << 20
#: Distances of quartiles, and what the body and the length code add at most.
STEP = np.array([0, 1, 2, 6])
LENGTH_BOUND = 12
TRIPLETS = ((0, 1, 2), (0, 1, 3), (0, 2, 3), (0, 1, 4), (0, 2, 4), (0, 3, 4))


def buckets(data: bytes) -> np.ndarray:
    counts = np.zeros(BUCKETS, np.int64)
    whole = np.frombuffer(data, np.uint8)
    for s in range(0, max(0, len(whole) - 4), PIECE):
        a = whole[s : s + PIECE + 4].astype(np.uint32)
        n = len(a) - 4
        one, two, three = a * np.uint32(0x9E3779B1), a * np.uint32(0x85EBCA77), a * np.uint32(0xC2B2AE3D)
        for salt, (x, y, z) in enumerate(TRIPLETS):
            h = (one[x : x + n] + two[y : y + n]) ^ (three[z : z + n] + np.uint32(salt * 0x27D4EB2F & 0xFFFFFFFF))
            h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
            counts += np.bincount(h >> np.uint32(24), minlength=BUCKETS)
    return counts


def digest(data: bytes) -> bytes:
    counts = buckets(data)
    ranked = np.sort(counts)
    cuts = ranked[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
    level = (counts[:, None] > cuts).sum(axis=1).astype(np.uint8).reshape(-1, 4)
    return bytes([min(255, round(8 * math.log2(len(data) + 1)))]) + (level[:, 0] | level[:, 1] << 2 | level[:, 2] << 4 | level[:, 3] << 6).astype(np.uint8).tobytes()


def levels(d: bytes) -> np.ndarray:
    body = np.frombuffer(d, np.uint8, offset=1)
    return (body[:, None] >> np.array([0, 2, 4, 6], np.uint8) & 3).ravel()


def likeness(a: bytes, b: bytes) -> float:
    """1 for equal digests, 0 at the bound."""
    if a == b:
        return 1.0
    body = int(STEP[np.abs(levels(a).astype(np.int8) - levels(b))].sum())
    return 1 - (body + min(LENGTH_BOUND, abs(a[0] - b[0]))) / (int(STEP[-1]) * BUCKETS + LENGTH_BOUND)


def edited(text: str, following: str) -> str:
    k = len(text) // 2
    return text[: len(text) - k] + following[:k]


NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
KINDS = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def compared(doc_id, text: str, own: bytes, following: str, other: bytes) -> tuple:
    new = edited(text, following).encode("utf-8", "replace")
    d = digest(new)
    return doc_id, len(text), hashlib.sha256(new).hexdigest(), own.hex(), d.hex(), likeness(own, d), likeness(own, other)


def batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(KINDS)], NAMES)


def compare(docs: DataFrame) -> DataFrame:
    bounded_batches(docs.sparkSession)
    spark = docs.sparkSession
    n = parts(spark, total_bytes(docs), PART)
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    order = [F.col("doc_id").desc_nulls_last(), F.col("h")]
    rows = rows.repartitionByRange(n, *order).sortWithinPartitions(*order).select("doc_id", "text")

    def run(batches):
        part, held, out = TaskContext.get().partitionId(), None, []

        def ends(which, doc_id, text):
            return pa.RecordBatch.from_arrays([*(pa.array([None], k) for k in KINDS), pa.array([part], pa.int32()), pa.array([which]), pa.array([doc_id], pa.int64()), pa.array([text])], [*NAMES, "part", "which", "id", "text"])

        def done(rows):
            b, none = batch(rows), len(rows)
            return pa.RecordBatch.from_arrays([*b.columns, pa.nulls(none, pa.int32()), pa.nulls(none, pa.string()), pa.nulls(none, pa.int64()), pa.nulls(none, pa.string())], [*NAMES, "part", "which", "id", "text"])

        for b in batches:
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                d = digest(text.encode("utf-8", "replace"))
                if held is None:
                    yield ends("first", doc_id, text)
                else:
                    out.append(compared(*held, text, d))
                held = (doc_id, text, d)
            if out:
                yield done(out)
                out = []
        if held is not None:
            yield ends("last", held[0], held[1])

    made = materialize(rows.mapInArrow(run, SCHEMA + ", part int, which string, id long, text string"))
    # one number a partition; the next partition with rows, and after the last the first
    present = made.filter("which = 'last'").select("part")
    follow = present.withColumn("then", F.coalesce(F.lead("part").over(Window.orderBy("part")), F.min("part").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))))
    first = made.filter("which = 'first'").select(F.col("part").alias("then"), F.col("text").alias("following"))
    pairs = made.filter("which = 'last'").select("part", "id", "text").join(follow, "part").join(first, "then").select("id", "text", "following")

    def close(batches):
        for b in batches:
            rows = zip(*(b.column(k).to_pylist() for k in ("id", "text", "following")), strict=True)
            yield batch([compared(i, t, digest(t.encode("utf-8", "replace")), f, digest(f.encode("utf-8", "replace"))) for i, t, f in rows])

    return made.filter("which is null").select(*NAMES).unionByName(pairs.mapInArrow(close, SCHEMA))
