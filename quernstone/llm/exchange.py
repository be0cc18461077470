"""Pieces of bytes between groups of documents and shards of a key space, there and back.

A group sends at most WIDTH rows, however many shards there are. Up to WIDTH shards, a row is the piece for one shard. Beyond, it is a frame with the pieces for a bucket of neighbouring shards;
on the way, the frames that up to WIDTH groups sent to one bucket are turned into one frame for each of its shards, and the answers are turned back likewise. So rows grow in proportion to groups and shards
(divided by WIDTH, with their product), and no task holds more than WIDTH frames of one bucket.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WIDTH = 8192
#: Bytes of answers that leave a shard together.
TOGETHER = 4 << 20
ROWS = "g long, shard int, blob binary"


def frame(items: list[tuple[int, bytes]]) -> bytes:
    head = np.array([len(items), *(k for k, _ in items), *(len(x) for _, x in items)], np.int64)
    return head.tobytes() + b"".join(x for _, x in items)


def unframe(blob: bytes) -> list[tuple[int, bytes]]:
    (n,) = np.frombuffer(blob, np.int64, 1).tolist()
    head = np.frombuffer(blob, np.int64, 2 * n, 8).tolist()
    out, at = [], 8 + 16 * n
    for k, size in zip(head[:n], head[n:], strict=True):
        out.append((k, blob[at : at + size]))
        at += size
    return out


def table(items) -> pa.Table:
    items = list(items)
    return pa.table({"g": pa.array([x[0] for x in items], pa.int64()), "shard": pa.array([x[1] for x in items], pa.int32()), "blob": pa.array([x[2] for x in items], pa.binary())})


def record(items) -> pa.RecordBatch:
    (out,) = table(items).combine_chunks().to_batches() or [pa.RecordBatch.from_pylist([], table([]).schema)]
    return out


def runs(batches, *names: str):
    """(values of the named columns, [rows as (g, shard, blob)]) for each run of rows that agree on them; rows come sorted by them."""
    last, held = None, []
    for b in batches:
        for key, row in zip(zip(*(b.column(k).to_pylist() for k in names), strict=True), zip(*(b.column(k).to_pylist() for k in ("g", "shard", "blob")), strict=True), strict=True):
            if key != last and held:
                yield last, held
                held = []
            last = key
            held.append(row)
    if held:
        yield last, held


def chunks(batches, size: int, column: str = "text"):
    """(number, table) of rows that lie together, about `size` bytes of a column at a time. Numbers are unique over all tasks of a stage, so they hold once the stage's rows are written down."""
    task = TaskContext.get()
    number = (task.partitionId() if task else 0) << 32
    held, weight = [], 0
    for b in batches:
        total = np.cumsum(pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < b.num_rows:
            before = int(total[at - 1]) if at else 0
            end = min(b.num_rows, int(np.searchsorted(total, before + size - weight)) + 1)
            held.append(b.slice(at, end - at))
            weight += int(total[end - 1]) - before
            at = end
            if weight >= size:
                yield number, pa.Table.from_batches(held)
                held, weight, number = [], 0, number + 1
    if held:
        yield number, pa.Table.from_batches(held)


class Exchange:
    def __init__(self, groups: int, shards: int, partitions: int, width: int = WIDTH):
        self.shards, self.partitions = shards, partitions
        self.fan, self.subs = -(-shards // width), -(-groups // width)

    def sent(self, g: int, pieces) -> list[tuple[int, int, bytes]]:
        """At a group: rows for its (shard, piece)s."""
        if self.fan == 1:
            return [(g, s, x) for s, x in pieces]
        buckets: dict[int, list] = {}
        for s, x in pieces:
            buckets.setdefault(s // self.fan, []).append((s, x))
        return [(g, b, frame(x)) for b, x in buckets.items()]

    def received(self, rows: pa.Table) -> dict[int, bytes]:
        """At a group: the answers by shard."""
        pairs = zip(rows.column("shard").to_pylist(), rows.column("blob").to_pylist(), strict=True)
        return dict(pairs) if self.fan == 1 else {s: x for _, blob in pairs for s, x in unframe(blob)}

    def mapped(self, rows: DataFrame, f) -> DataFrame:
        """Rows for groups with f applied to each piece."""

        def run(batches):
            for b in batches:
                for g, s, x in zip(*(b.column(k).to_pylist() for k in ("g", "shard", "blob")), strict=True):
                    yield record([(g, s, f(x) if self.fan == 1 else frame([(k, f(y)) for k, y in unframe(x)]))])

        return rows.mapInArrow(run, ROWS)

    def at_shards(self, sent: DataFrame, settle) -> DataFrame:
        """settle(shard, [(group, piece)]) gives (group, answer)s; group -1 is nobody's and may be used for sums over all shards."""
        fan = self.fan

        def turn(batches):
            for (_, sub), rows in runs(batches, "bucket", "sub"):
                by: dict[int, list] = {}
                for g, _, blob in rows:
                    for s, x in unframe(blob):
                        by.setdefault(s, []).append((g, x))
                for s, pieces in by.items():
                    yield record([(sub, s, frame(pieces))])

        def work(batches):
            for (shard,), rows in runs(batches, "shard"):
                if fan == 1:
                    ready, size = [], 0
                    for g, x in settle(shard, [(g, x) for g, _, x in rows]):
                        ready.append((g, shard, x))
                        size += len(x)
                        if size >= TOGETHER:
                            yield record(ready)
                            ready, size = [], 0
                    if ready:
                        yield record(ready)
                    continue
                pieces = [(sub, g, x) for sub, _, blob in rows for g, x in unframe(blob)]
                of, out = {g: sub for sub, g, _ in pieces}, {}
                for g, x in settle(shard, [(g, x) for _, g, x in pieces]):
                    if g < 0:
                        yield record([(g, shard, x)])
                    else:
                        out.setdefault(of[g], []).append((g, x))
                for sub, answers in out.items():
                    yield record([(sub, shard, frame(answers))])

        if fan > 1:
            sub = F.pmod(F.xxhash64("g"), F.lit(self.subs)).cast("int")
            sent = sent.withColumn("sub", sub).withColumnRenamed("shard", "bucket").withColumn("shard", F.col("bucket"))
            sent = sent.repartition(self.partitions, "bucket", "sub").sortWithinPartitions("bucket", "sub").mapInArrow(turn, ROWS)
        return sent.repartitionById(min(self.partitions, self.shards), F.pmod("shard", F.lit(min(self.partitions, self.shards)))).sortWithinPartitions("shard").mapInArrow(work, ROWS)

    def back(self, answers: DataFrame) -> DataFrame:
        """Answers as rows for their groups (those of nobody left out)."""
        answers, fan = answers.filter("g >= 0"), self.fan
        if fan == 1:
            return answers

        def turn(batches):
            for (bucket, _), rows in runs(batches, "bucket", "sub"):
                by: dict[int, list] = {}
                for _, s, blob in rows:
                    for g, x in unframe(blob):
                        by.setdefault(g, []).append((s, x))
                for g, pieces in by.items():
                    yield record([(g, bucket, frame(pieces))])

        both = answers.withColumn("bucket", (F.col("shard") / fan).cast("int")).withColumn("sub", F.col("g").cast("int"))
        return both.repartition(self.partitions, "bucket", "sub").sortWithinPartitions("bucket", "sub").mapInArrow(turn, ROWS)
