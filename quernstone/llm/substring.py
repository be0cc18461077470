"""Repeated passages removed: every window of `window` words that starts in a document with a smaller doc_id.

Super-k-mer partitioning. A window's minimiser is the least hash among its runs of MINIMISER words; equal windows have equal minimisers. Documents are dealt into groups of about GROUP bytes by a hash.
1. Windows that stand twice in a group are settled there. Each group sends the hashes of its minimisers, once each, to their shards, and learns which of them other groups have too.
2. Consecutive windows that share such a minimiser travel as one packed string of words to the minimiser's bucket: the group's smallest doc_id alone sends a window that several of its documents have, so a passage shared by any number of documents comes once a group.
3. In a bucket, windows are sorted (by a 64-bit hash of their words' hashes, and told apart by one of a second, independent family of word hashes), and each set of equal windows is left to its smallest doc_id. The word ranges that go return to their group.
How pieces travel between groups, shards and buckets, and how many, is in `exchange`.

Nulls and ties: a null text has no words. A null doc_id counts as larger than any other. Rows with one doc_id never remove each other's words; repeated rows get the same result each.
Texts shorter than a window lose nothing. Columns besides doc_id and text are kept by `deduplicate` and not read by `digest`.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import exchange
from .common import BASE, NULL_ID, SPACE, Words, bounded_batches, delta, enter, parts, rolled, total_bytes, utf8
from .exchange import WIDTH, Exchange

WINDOW, MINIMISER = 13, 8
#: Bytes of text in a group, and for which there is one shard of minimisers and one bucket.
GROUP, SHARD = 8 << 20, 16 << 20


def sliding_min(a: np.ndarray, size: int) -> np.ndarray:
    out, span = a, 1
    while span * 2 <= size:
        out, span = np.minimum(out[:-span], out[span:]), span * 2
    return np.minimum(out[: len(out) - (size - span)], out[size - span :]) if size > span else out


def classes(tokens: np.ndarray, others: np.ndarray, begin: np.ndarray, owner: np.ndarray, window: int) -> np.ndarray:
    """For each window (from tokens[begin]), the smallest owner among the windows with the same words. tokens and others are two independent families of word hashes: windows are sorted by a hash of the one and told apart by a hash of the other."""
    hashes = rolled(tokens, window)[begin]
    order = np.argsort(hashes)
    h, o = hashes[order], owner[order]
    new = np.ones(len(h), bool)
    new[1:] = h[1:] != h[:-1]
    check = rolled(others, window, BASE + 2)[begin[order]]
    if np.any(~new[1:] & (check[1:] != check[:-1])):
        again = np.lexsort((check, h))
        order, h, o, check = order[again], h[again], o[again], check[again]
        new[1:] = (h[1:] != h[:-1]) | (check[1:] != check[:-1])
    out = np.empty(len(order), owner.dtype)
    if len(order):
        first = np.flatnonzero(new)
        out[order] = np.repeat(np.minimum.reduceat(o, first), np.diff(np.r_[first, len(o)]))
    return out


class Group:
    """The words of a group's documents, one after another, by rising id."""

    def __init__(self, table: pa.Table, window: int = WINDOW, size: int = MINIMISER):
        texts, ids = utf8(table.column("text").combine_chunks()), table.column("_id").to_pylist()
        self.order = sorted(range(len(ids)), key=lambda k: (ids[k], texts[k] or b""))
        self.words = Words([texts[k] for k in self.order])
        self.sizes = self.words.counts
        self.ids = np.repeat(np.array([ids[k] for k in self.order], np.int64), self.sizes)
        self.window, self.size = window, size

    def windows(self) -> None:
        """Where windows begin (in one document only), and their minimisers."""
        self.hashes = self.words.hashes()
        first = np.cumsum(self.sizes) - self.sizes
        left = np.repeat(first + self.sizes, self.sizes) - np.arange(len(self.hashes))
        self.begin = np.flatnonzero(left >= self.window)
        runs = rolled(self.hashes, self.size)
        least = sliding_min(runs, self.window - self.size + 1) if len(runs) >= self.window - self.size + 1 else runs[:0]
        self.minimiser = least[self.begin]

    def settle(self) -> np.ndarray:
        """Which windows stand in a smaller id of this group."""
        gone = np.zeros(len(self.begin), bool)
        hashes = rolled(self.hashes, self.window)[self.begin]
        ordered = np.sort(hashes)
        twice = ordered[1:][ordered[1:] == ordered[:-1]]
        # few windows stand twice: the others are seen in a small table of the hashes' first bits
        table = np.zeros(1 << 20, bool)
        table[(twice >> np.uint64(44)).astype(np.int64)] = True
        some = np.flatnonzero(table[(hashes >> np.uint64(44)).astype(np.int64)])
        owner = self.ids[self.begin[some]]
        if len(some):
            gone[some] = classes(self.hashes, self.words.hashes(1), self.begin[some], owner, self.window) != owner
        return gone

    def by_shard(self, shards: int):
        """Distinct minimisers of each shard."""
        m = self.minimiser
        distinct = np.sort(m[np.r_[True, m[1:] != m[:-1]]]) if len(m) else m
        distinct = distinct[np.r_[True, distinct[1:] != distinct[:-1]]] if len(m) else m
        shard = (distinct >> np.uint64(20)) % np.uint64(shards)
        order = np.argsort(shard, kind="stable")
        cut = np.searchsorted(shard[order], np.arange(shards + 1).astype(np.uint64))
        return [(s, distinct[order[cut[s] : cut[s + 1]]]) for s in range(shards) if cut[s] < cut[s + 1]]

    def super_kmers(self, alive: np.ndarray, shards: int):
        """(bucket, blob) of runs of living windows that share a minimiser: first word, windows and id of each, and their words."""
        at, m = self.begin[alive], self.minimiser[alive]
        if not len(at):
            return
        start = np.flatnonzero(np.r_[True, (np.diff(at) != 1) | (m[1:] != m[:-1])])
        number = np.diff(np.r_[start, len(at)])
        first, bucket = at[start], ((m[start] >> np.uint64(20)) % np.uint64(shards)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cut = np.searchsorted(bucket[order], np.arange(shards + 1))
        for s in range(shards):
            own = order[cut[s] : cut[s + 1]]
            if len(own):
                body = b" ".join(self.words.slices(first[own], first[own] + number[own] + self.window - 2))
                yield s, zstandard.compress(np.concatenate([[len(own)], first[own], number[own], self.ids[first[own]]]).astype(np.int64).tobytes() + body, 3)


def spans(begin: np.ndarray, window: int) -> np.ndarray:
    """Rising places of windows as rows (first word, words)."""
    if not len(begin):
        return np.zeros((0, 2), np.int64)
    start = np.flatnonzero(np.r_[True, np.diff(begin) != 1])
    return np.column_stack([begin[start], np.diff(np.r_[start, len(begin)]) + window - 1])


def repeated(blobs: list[bytes], window: int) -> list[np.ndarray]:
    """For each group's blob of a bucket, the spans of windows whose words also start in a smaller id."""
    if not blobs:
        return []
    bodies, first, number, ids, sizes = [], [], [], [], []
    for blob in blobs:
        data = zstandard.decompress(blob)
        (n,) = np.frombuffer(data, np.int64, 1).tolist()
        head = np.frombuffer(data, np.int64, 3 * n, 8).reshape(3, n)
        bodies.append(data[8 + 24 * n :])
        for a, x in zip((first, number, ids), head, strict=True):
            a.append(x)
        sizes.append(int(head[1].sum()))
    words, number = Words(bodies), np.concatenate(number)
    length = number + window - 1
    which = np.repeat(np.arange(len(number)), number)
    nth = np.arange(len(which)) - np.repeat(np.cumsum(number) - number, number)
    begin = (np.cumsum(length) - length)[which] + nth
    owner = np.concatenate(ids)[which]
    small = classes(words.hashes(), words.hashes(1), begin, owner, window)
    place = np.concatenate(first)[which] + nth
    out, at = [], 0
    for n in sizes:
        out.append(spans(place[at : at + n][(small != owner)[at : at + n]], window))
        at += n
    return out


def swept(docs: DataFrame, finish, schema, window: int = WINDOW, size: int = MINIMISER) -> DataFrame:
    """finish(table, group, gone) for each group: gone tells for each word whether it goes."""
    bounded_batches(docs.sparkSession)
    nbytes = total_bytes(docs)
    groups, shards = parts(docs.sparkSession, nbytes, GROUP), int(nbytes / SHARD) + 1
    between = Exchange(groups, shards, groups, WIDTH)
    text = F.col("text").cast("string")
    rows = docs.withColumn("_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID))).withColumn("g", F.pmod(F.xxhash64("doc_id", text), F.lit(groups)))

    def ask(key, docs_):
        enter("substring")
        group = Group(docs_, window, size)
        group.windows()
        return exchange.table(between.sent(key[0].as_py(), ((s, delta(m).tobytes()) for s, m in group.by_shard(shards))))

    def shared(shard, asked):
        all_ = [np.cumsum(np.frombuffer(x, np.uint64), dtype=np.uint64) for _, x in asked]
        ordered = np.sort(np.concatenate(all_))
        both = ordered[1:][ordered[1:] == ordered[:-1]]
        for (g, _), a in zip(asked, all_, strict=True):
            at = np.minimum(np.searchsorted(both, a), max(0, len(both) - 1))
            own = a[both[at] == a] if len(both) else a[:0]
            if len(own):
                yield g, own.tobytes()

    def send(key, docs_, answers):
        enter("substring")
        group, g = Group(docs_, window, size), key[0].as_py()
        group.windows()
        settled = group.settle()
        known = np.sort(np.frombuffer(b"".join(between.received(answers).values()), np.uint64))
        at = np.minimum(np.searchsorted(known, group.minimiser), max(0, len(known) - 1))
        alive = ~settled & (known[at] == group.minimiser) if len(known) else np.zeros(len(settled), bool)
        # what the group settled itself goes along, by the bucket of its number
        own, sent = spans(group.begin[settled], window).tobytes(), dict(group.super_kmers(alive, shards))
        return exchange.table(between.sent(g, ((s, exchange.frame([(0, sent.get(s, b"")), (1, own if s == g % shards else b"")])) for s in {*sent, g % shards})))

    def settle(bucket, got):
        both = [(g, *(x for _, x in exchange.unframe(blob))) for g, blob in got]
        found = repeated([b for _, b, _ in both if b], window)
        for g, blob, own in both:
            ranges = (found.pop(0).tobytes() if blob else b"") + own
            if ranges:
                yield g, ranges

    def remove(key, docs_, ranges):
        enter("substring")
        group = Group(docs_, window, size)
        gone = np.zeros(int(group.sizes.sum()) + 1, np.int64)
        at = np.frombuffer(b"".join(between.received(ranges).values()), np.int64).reshape(-1, 2)
        np.add.at(gone, at[:, 0], 1)
        np.add.at(gone, at.sum(axis=1), -1)
        return finish(docs_, group, np.cumsum(gone)[:-1] > 0)

    rows = rows.select(*docs.columns, "_id", "g")
    slim = rows if set(docs.columns) == {"doc_id", "text"} else rows.select("doc_id", "text", "_id", "g")
    asked = slim.groupBy("g").applyInArrow(ask, exchange.ROWS)
    answers = between.back(between.at_shards(asked, shared))
    strings = slim.groupBy("g").cogroup(answers.groupBy("g")).applyInArrow(send, exchange.ROWS)
    ranges = between.back(between.at_shards(strings, settle))
    return rows.groupBy("g").cogroup(ranges.groupBy("g")).applyInArrow(remove, schema)


def kept(group: Group, gone: np.ndarray):
    """(row of the table, words, words kept, kept words joined by one space) of each document."""
    words, stay = group.words, ~gone
    place = np.zeros(len(words.bytes) + 1, np.int8)
    place[words.starts[stay]] = 1
    place[words.ends[stay] + 1] -= 1  # with the byte after the word, for the space
    inside = np.cumsum(place, dtype=np.int8)[:-1] > 0
    text = words.bytes[inside]
    text[SPACE[text]] = 32
    text = text.tobytes()
    cut = np.r_[0, np.cumsum(np.add.reduceat(inside, words.places[:-1], dtype=np.int64))].tolist() if len(words.places) > 1 else [0]
    number = np.diff(np.r_[0, np.cumsum(stay)][np.r_[0, np.cumsum(group.sizes)]]).tolist()
    for k, (row, n) in enumerate(zip(group.order, group.sizes.tolist(), strict=True)):
        yield row, n, number[k], text[cut[k] : max(cut[k], cut[k + 1] - 1)]


def digest(docs: DataFrame, window: int = WINDOW, size: int = MINIMISER) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 for every row."""

    def finish(table, group, gone):
        ids, out = table.column("doc_id").to_pylist(), [(row, n, k, hashlib.sha256(text).hexdigest()) for row, n, k, text in kept(group, gone)]
        return pa.table({"doc_id": pa.array([ids[x[0]] for x in out], pa.int64()), "n_words": pa.array([x[1] for x in out], pa.int64()), "n_removed": pa.array([x[1] - x[2] for x in out], pa.int64()), "kept_sha256": pa.array([x[3] for x in out], pa.string())})

    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return swept(docs, finish, "doc_id long, n_words long, n_removed long, kept_sha256 string", window, size)


def deduplicate(docs: DataFrame, window: int = WINDOW, size: int = MINIMISER) -> DataFrame:
    """docs with repeated passages cut out of text (kept words joined by one space where any was removed; other texts stay as they are) and n_chars, if there, brought up to date."""
    names = [c for c in docs.columns if c not in ("_id", "g")]

    def finish(table, group, gone):
        texts = table.column("text").to_pylist()
        for row, n, k, text in kept(group, gone):
            if k < n:
                texts[row] = text.decode()
        return table.select(names).set_column(names.index("text"), "text", pa.array(texts, pa.string()))

    schema = T.StructType([T.StructField(f.name, f.dataType) for f in docs.select(*names).schema])
    out = swept(docs.select(*names), finish, schema, window, size)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in names else out
