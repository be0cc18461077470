"""Packing into fixed windows by minimum bin slack.

A document's ids are cut into whole windows and a remainder. Remainders are told apart by length alone, so the plan works on a
histogram: its size is bounded by the window, whatever the number of documents. For each new window the longest remainder left
opens it, and a subset-sum dynamic programme over a bitset (bit s: some multiset of the remaining lengths has sum s) finds the multiset that
fills it closest to capacity; counts are backtracked from the bitsets, and the window is repeated as often as the counts allow.
If slack is left, a further remainder is cut to fill it. Windows that cannot be filled because nothing is left are cut into powers of two,
which need no padding.

Pieces are given out by rank within (length, salt): no length is ranked by one task, and the driver sees one count for each pair.

Nulls: a null text is empty and has only the end id; a null doc_id is packed like any other. Equal ids and repeated rows stay apart (rows are told apart by rank).
Columns besides doc_id and text are not read.
"""

from __future__ import annotations

import os
import zlib
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memo, Words, bounded_batches, enter, materialize, memories, union_all, utf8

WINDOW, END_ID = 4096, 2
#: Cut documents that may be named in the scan's filter, and whose pieces may be sent to all tasks.
NAMED, BROADCAST = 1_000, 20_000
#: Rows ranked by one task, about.
RANKED = 100_000
#: Words whose ids a worker remembers.
CACHE = 1_200_000
SLOTS = 21


class Encoder:
    """Ids of whole texts as unsigned 32-bit numbers. The vocabulary's rules never look across white space
    (words are taken apart there before any merge), nor do they join an ASCII letter with a stop after it, so ids are found word by word and remembered by the word's hash."""

    def __init__(self, path: str, limit: int = CACHE, slots: int = SLOTS):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a worker has one core
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        # a word of one id that stands between others when many are encoded at once
        self.mark, (self.mark_id,) = b"~", self.tokenizer.encode("~", add_special_tokens=False).ids
        self.memo = Memo(self.learn, limit, slots)
        # words of ASCII letters alone need none of the rules for texts, only the merges
        self.letters = Tokenizer(self.tokenizer.model)
        self.letters.pre_tokenizer = WhitespaceSplit()

    def learn(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        letters = np.array([w.isalpha() and w.islower() for w in words], bool)
        kinds = [np.flatnonzero(letters).tolist(), [], []]
        for k in np.flatnonzero(~letters).tolist():
            kinds[2 if self.mark in words[k] or b"<|" in words[k] else 1].append(k)
        got, length, order = [], np.zeros(len(words), np.int64), []
        for tokenizer, which in ((self.letters, kinds[0]), (self.tokenizer, kinds[1])):
            some = [words[k] for k in which]
            sizes = [np.zeros(0, np.int64)]
            for i in range(0, len(some), 10_000):
                texts = [(b" " + self.mark + b" ").join(some[k : k + 1000]).decode("utf-8", "replace") for k in range(i, min(i + 10_000, len(some)), 1000)]
                for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False):
                    ids = np.array(e.ids, np.uint32)
                    ends = np.r_[np.flatnonzero(ids == self.mark_id), len(ids)]
                    sizes.append(np.diff(ends, prepend=-1) - 1)
                    got.append(ids[ids != self.mark_id])
            length[which] = np.concatenate(sizes)
            order += which
        for k, e in zip(kinds[2], self.tokenizer.encode_batch_fast([words[k].decode("utf-8", "replace") for k in kinds[2]], add_special_tokens=False), strict=True):
            got.append(np.array(e.ids, np.uint32))
            length[k] = len(e.ids)
            order.append(k)
        # ids in the order of the words
        ids, order = np.concatenate([*got, np.zeros(0, np.uint32)]), np.array(order, np.int64)
        first = np.empty(len(words), np.int64)
        first[order] = np.cumsum(length[order]) - length[order]
        place = np.cumsum(length) - length
        return ids[np.repeat(first - place, length) + np.arange(length.sum())], length

    def encode(self, texts: list[bytes | None]) -> list[np.ndarray]:
        # the special words are told apart before letters are lowered
        words = Words([t and (t if b"<|" in t else t.lower()) for t in texts], stops=True)
        number = self.memo.look_up(words.hashes(), words.hashes(1), lambda at: words.slices(at, at))
        if number is None:
            return [x for t in texts for x in self.encode_long(t)]
        ids, total = self.memo.gather(number)
        return np.split(ids, total[np.cumsum(words.counts)][:-1]) if len(texts) else []

    def encode_long(self, text: bytes | None) -> list[np.ndarray]:
        """One text of more distinct words than are remembered, a stretch at a time."""
        words, out, some = Words([text], stops=True), [], self.memo.limit // 2
        if len(words.starts) <= some:
            return self.encode([text])
        for w in range(0, len(words.starts), some):
            out += self.encode([words.data[words.starts[w] : words.ends[min(w + some, len(words.ends)) - 1]]])
        return [np.concatenate(out)]


def encoder_of(path: str) -> Encoder:
    """One for each vocabulary in a worker, kept from task to task."""
    if path not in memories:
        memories[path] = Encoder(path)
    return memories[path]


def pieces(texts: list[bytes | None], size: int = 4 << 20):
    """Texts a few at a time."""
    at = 0
    while at < len(texts):
        end, weight = at, 0
        while end < len(texts) and (end == at or weight < size):
            weight += len(texts[end] or b"")
            end += 1
        yield texts[at:end]
        at = end


def encoded(docs: DataFrame, path: str, window: int, end_id: int) -> DataFrame:
    """doc_id, doc_tokens, full (crc of each whole window), rest (length of the remainder), rest_crc, crc (of all ids)."""
    end = end_id.to_bytes(4, "little")

    def run(batches):
        enter("packing")
        encoder = encoder_of(path)
        for b in batches:
            out = []
            for texts in pieces(utf8(b.column("text"))):
                for ids in encoder.encode(texts):
                    x = ids.astype("<u4").tobytes() + end
                    n = len(x) // 4
                    cut = n // window * window * 4
                    out.append((n, [zlib.crc32(x[k : k + window * 4]) for k in range(0, cut, window * 4)], n % window, zlib.crc32(x[cut:]), zlib.crc32(x)))
            kinds = (pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array([x[k] for x in out], kind) for k, kind in enumerate(kinds))], ["doc_id", "doc_tokens", "full", "rest", "rest_crc", "crc"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, doc_tokens long, full array<long>, rest long, rest_crc long, crc long")


def best_fill(counts: dict[int, int], room: int) -> dict[int, int]:
    """The multiset of the lengths in counts whose sum is nearest to room from below; longest lengths are tried first."""
    reach, steps, mask = 1, [], (1 << (room + 1)) - 1
    for length in sorted((x for x in counts if x <= room), reverse=True):
        left, size = min(counts[length], room // length), 1
        while left and not reach >> room & 1:  # counts in binary: 1, 2, 4, ... and the rest
            take = min(size, left)
            steps.append((length, take, reach))
            reach |= (reach << length * take) & mask
            left, size = left - take, size * 2
        if reach >> room & 1:
            break
    total, chosen = reach.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            chosen[length] = chosen.get(length, 0) + take
            total -= length * take
    return chosen


def plan(histogram: dict[int, int], window: int = WINDOW) -> list[tuple[int, list[tuple[int, int, int, int, int]]]]:
    """Windows for remainders: (times, pieces), a piece being (remainder length, first rank, start, end, step): in repeat t of the
    window it is ids [start, end) of the remainder of rank first + t * step. Every id is in exactly one piece."""
    # stock: length -> runs of (remainder length, first rank, start, end, number)
    stock: dict[int, list[list[int]]] = {n: [[n, 0, 0, n, c]] for n, c in histogram.items() if n and c}
    have = {n: c for n, c in histogram.items() if n and c}
    out = []

    def put(length, run):
        stock.setdefault(length, []).append(run)
        have[length] = have.get(length, 0) + run[4]

    def take(length, number, times):
        """number pieces of this length for each of times windows, as (pieces); splits runs as needed."""
        pieces, runs = [], stock[length]
        for _ in range(number):
            run = runs[0] if runs[0][4] >= times else None
            if run is None:
                return None
            pieces.append((run[0], run[1], run[2], run[3], 1))
            run[1] += times
            run[4] -= times
            have[length] -= times
            if not run[4]:
                runs.pop(0)
        if not have[length]:
            del have[length], stock[length]
        return pieces

    def possible(need):
        """How often the pieces can be taken with each slot served by one run."""
        most = 1 << 62
        for length, number in need.items():
            sizes = [r[4] for r in stock[length]]
            low, high = 1, have[length] // number
            while low < high:  # runs are used in order; whole slots only
                mid = (low + high + 1) // 2
                low, high = (mid, high) if serves(sizes, mid, number) else (low, mid - 1)
            most = min(most, low if serves(sizes, low, number) else 1)
        return most

    def serves(sizes, times, number):
        for s in sizes:
            number -= s // times
            if number <= 0:
                return True
            if s % times:
                return False
        return number <= 0

    while have:
        longest = max(have)
        have[longest] -= 1
        fill = best_fill({n: c for n, c in have.items() if c}, window - longest)
        have[longest] += 1
        need = dict(fill)
        need[longest] = need.get(longest, 0) + 1
        slack = window - sum(n * c for n, c in need.items())
        spare = max((n for n in have if n > slack and have[n] > need.get(n, 0)), default=None) if slack else None
        whole = need if spare is None else need | {spare: need.get(spare, 0) + 1}
        times = possible(whole)
        pieces = [p for n, c in sorted(need.items(), reverse=True) for p in take(n, c, times)]
        if spare is not None:
            n, first, a, b, step = take(spare, 1, times)[0]
            pieces.append((n, first, a, a + slack, step))
            put(b - a - slack, [n, first, a + slack, b, times])
            slack = 0
        out.append((times, pieces))
    return out


def settle(windows, window: int):
    """The plan as sequences: (first sequence, sequences apart, times, offset, piece), windows with slack cut into powers of two."""
    out, number = [], 0
    for times, pieces in windows:
        size = sum(b - a for _, _, a, b, _ in pieces)
        limits = [window] if size == window else [1 << k for k in range(size.bit_length() - 1, -1, -1) if size >> k & 1]
        k, used = 0, 0
        for n, first, a, b, step in pieces:
            while a < b:
                here = min(b - a, limits[k] - used)
                out.append((number + k, len(limits), times, used, (n, first, a, a + here, step)))
                a, used = a + here, used + here
                if used == limits[k]:
                    k, used = k + 1, 0
        number += times * len(limits)
    return out, number


def pack(docs: DataFrame, path: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """One row a piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    bounded_batches(docs.sparkSession)
    spark = docs.sparkSession
    each = materialize(encoded(docs, path, window, end_id))
    counts = {r.rest: r.n for r in each.filter("rest > 0").groupBy("rest").agg(F.count("*").alias("n")).collect()}  # at most window - 1 rows
    salts = {n: c // RANKED + 1 for n, c in counts.items()}
    salt = F.lit(0)
    if many := {n: s for n, s in salts.items() if s > 1}:
        by = F.create_map(*(F.lit(x).cast("long") for n, s in many.items() for x in (n, s)))
        salt = F.coalesce(F.pmod(F.xxhash64("doc_id", "crc"), by[F.col("rest")]), F.lit(0)).cast("int")
    rests = each.filter("rest > 0").withColumn("salt", salt)
    by_salt = {(r.rest, r.salt): r.n for r in rests.groupBy("rest", "salt").agg(F.count("*").alias("n")).collect()} if many else {(n, 0): c for n, c in counts.items()}
    first, at = {}, 0
    base: dict[tuple[int, int], int] = {}
    for n, s in sorted(by_salt):
        first.setdefault(n, 0)
        base[n, s] = first[n]
        first[n] += by_salt[n, s]
    slots, sequences = settle(plan(counts, window), window)
    runs: dict[int, list] = {}
    for seq, apart, times, offset, (n, rank, a, b, step) in slots:
        runs.setdefault(n, []).append((rank, rank + times, a, b, seq, apart, offset))
    lookup = spark.sparkContext.broadcast((base, runs))

    def place(batches):
        """Rows come sorted by rest and salt, so the rank within a pair is a running count."""
        base, runs = lookup.value
        last, rank = None, 0
        cut_at: dict[int, tuple] = {}
        for b in batches:
            out = []
            for doc_id, tokens, n, rest_crc, crc, s in zip(*(b.column(k).to_pylist() for k in ("doc_id", "doc_tokens", "rest", "rest_crc", "crc", "salt")), strict=True):
                if (n, s) != last:
                    last, rank = (n, s), base[n, s]
                if n not in cut_at:
                    cut_at[n] = spans(runs[n])
                marks, here = cut_at[n]
                for low, _, a, z, seq, apart, offset in here[marks[bisect_right(marks, rank) - 1]]:
                    out.append((doc_id, tokens - n + a, z - a, rest_crc if z - a == n else None, tokens, seq + (rank - low) * apart, offset, crc))
                rank += 1
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in range(8)], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "crc"])

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, crc long"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rests = rests.select("doc_id", "doc_tokens", "rest", "rest_crc", "crc", "salt")
    placed = materialize(rests.repartition(n, "rest", "salt").sortWithinPartitions("rest", "salt", "doc_id", "crc").mapInArrow(place, schema))
    whole = placed.filter("ids_crc32 is not null").drop("crc")
    cut = cut_crcs(docs, placed.filter("ids_crc32 is null"), path, end_id)
    # whole windows of long documents: one sequence each, numbered after the others
    full = each.filter(F.size("full") > 0).select("doc_id", "doc_tokens", F.posexplode("full").alias("k", "ids_crc32"))
    full = full.select("doc_id", (F.col("k") * F.lit(window).cast("long")).alias("start"), F.lit(window).cast("long").alias("length"), "ids_crc32", "doc_tokens", (F.lit(sequences) + F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return union_all([whole, cut, full])


def spans(runs: list) -> tuple[list[int], dict[int, list]]:
    """Ranks at which the pieces change, and the pieces from each on."""
    marks = sorted({x for r in runs for x in r[:2]})
    here: dict[int, list] = {m: [] for m in marks}
    for r in runs:
        for m in marks[bisect_right(marks, r[0]) - 1 :]:
            if m >= r[1]:
                break
            here[m].append(r)
    return marks, here


def cut_crcs(docs: DataFrame, cut: DataFrame, path: str, end_id: int) -> DataFrame:
    """Pieces of cut remainders with their ids_crc32: only documents that have some are encoded again."""
    end, names = end_id.to_bytes(4, "little"), ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    each = cut.groupBy("doc_id").agg(F.collect_list(F.struct("crc", "start", "length", "doc_tokens", "sequence_id", "offset")).alias("pieces"))
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).alias("t")
    # few documents are cut as a rule: then their pieces go to the texts, and the texts stay where they are
    few = cut.select("doc_id").distinct().limit(BROADCAST + 1).collect()
    if len(few) <= NAMED:
        docs = docs.filter(F.col("doc_id").isin([r.doc_id for r in few if r.doc_id is not None]) | (F.col("doc_id").isNull() if any(r.doc_id is None for r in few) else F.lit(False)))
    if len(few) <= BROADCAST:
        each = F.broadcast(each)
    both = texts.join(each.alias("e"), F.col("t.doc_id").eqNullSafe(F.col("e.doc_id"))).select("t.doc_id", "t.text", "e.pieces").dropDuplicates(["doc_id", "text"])

    def run(batches):
        encoder = encoder_of(path)
        for b in batches:
            out = []
            for doc_id, ids, pieces in zip(b.column("doc_id").to_pylist(), encoder.encode(utf8(b.column("text"))), b.column("pieces").to_pylist(), strict=True):
                ids = ids.astype("<u4").tobytes() + end
                crc = zlib.crc32(ids)
                for p in pieces:
                    if p["crc"] == crc and p["doc_tokens"] * 4 == len(ids):
                        out.append((doc_id, p["start"], p["length"], zlib.crc32(ids[p["start"] * 4 : (p["start"] + p["length"]) * 4]), p["doc_tokens"], p["sequence_id"], p["offset"]))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in range(7)], names)

    return both.mapInArrow(run, ", ".join(f"{x} long" for x in names))
