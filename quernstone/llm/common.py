"""Shared pieces: tables in the cluster's shared folder, inputs, byte helpers."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
import zlib
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import bounded_batches  # noqa: F401  the operators take it from here

#: Stands for a null doc_id where ids are compared: a null id comes after every other.
NULL_ID = 2**63 - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: the one the cluster names, or (in one process, as in tests) one of our own. A cluster that names none has no such folder: that is an error, not a reason to lose data."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    own = spark.conf.get("quernstone.shared.dir", None)
    if not own:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        own = "file://" + tempfile.mkdtemp(prefix="quernstone-")
        spark.conf.set("quernstone.shared.dir", own)
    return own


def materialize(df: DataFrame) -> DataFrame:
    """Write to the shared folder and read again: cuts the lineage and outlives executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, buckets: int, column: str) -> DataFrame:
    """Like materialize, in buckets by a hash of a column: what meets the table by that column comes to it, and the table is not shuffled. The files are in the shared folder; the session's catalog has a name for them."""
    name = f"quernstone_{uuid.uuid4().hex}"
    df.write.bucketBy(buckets, column).sortBy(column).format("parquet").option("compression", "uncompressed").option("path", f"{shared_dir(df.sparkSession)}/{name}").saveAsTable(name)
    return df.sparkSession.table(name)


def total_bytes(docs: DataFrame, column: str = "text") -> int:
    """Bytes of a text column; one number to the driver."""
    return docs.agg(F.sum(F.octet_length(F.col(column)))).first()[0] or 0


def parts(spark: SparkSession, nbytes: float, per_task: float) -> int:
    """Partitions so that a task holds about per_task bytes; at least the session's own number."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(nbytes / per_task) + 1)


def training(doc_id: str, modulus: int, held_out: int):
    """Native: crc32(doc_id as text) mod modulus is not held_out. A null id counts as the text ''."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(modulus)) != held_out


def is_training(doc_id, modulus: int, held_out: int) -> bool:
    """The same in Python."""
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % modulus != held_out


def utf8(column: pa.Array) -> list[bytes | None]:
    """A string column as UTF-8 bytes, nothing decoded."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


#: What the operator at work in this Python worker remembers from task to task.
memories: dict[str, object] = {}


def enter(name: str) -> None:
    """An operator starts a task in this worker: what another one left goes, and freed memory returns to the machine."""
    if memories.get("at") != name:
        memories.clear()
        memories["at"] = name
        powers.clear()
    trim()


def trim() -> None:
    gc.collect()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: 1: ASCII letters, 2: marks after which a word may be cut.
KINDS = np.zeros(256, np.uint8)
KINDS[[*range(65, 91), *range(97, 123)]] = 1
KINDS[list(b".,;:!?")] = 2
#: The base that tells places in a run of words apart; odd, so that it has an inverse.
BASE = 0x9E3779B97F4A7C15
MIX = np.uint64(0xBF58476D1CE4E5B9)
PIECE, LONG = 1 << 16, 64
#: Masks of the first 0 to 8 bytes of a little-endian number.
FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
powers: dict[int, np.ndarray] = {}


def mix(a: np.ndarray) -> np.ndarray:
    a = (a ^ (a >> np.uint64(31))) * MIX
    return a ^ (a >> np.uint64(29))


def stirred(a: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers in which each bit depends on every one (the constants are the splitmix64 generator's)."""
    a = a + np.uint64(0x9E3779B97F4A7C15)
    a = (a ^ (a >> np.uint64(30))) * MIX
    a = (a ^ (a >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return a ^ (a >> np.uint64(31))


def delta(a: np.ndarray) -> np.ndarray:
    """Differences of rising numbers; their cumulative sum gives them back."""
    return np.diff(a, prepend=np.uint64(0))


def power(base: int, n: int) -> np.ndarray:
    """base to the powers 0 to n - 1, modulo 2^64."""
    if base not in powers or len(powers[base]) < n:
        steps = np.full(n, base, np.uint64)
        steps[:1] = 1
        powers[base] = np.multiply.accumulate(steps)
    return powers[base][:n]


def rolled(a: np.ndarray, size: int, base: int = BASE) -> np.ndarray:
    """A hash of each `size` consecutive numbers (hashes themselves); a base gives one family of hashes."""
    n, step = max(0, len(a) - size + 1), 1 << 15
    out, up, down = np.empty(n, np.uint64), power(base, step + size), power(pow(base, -1, 2**64), step + size)
    total = np.zeros(step + size, np.uint64)
    for s in range(0, n, step):
        x = a[s : s + step + size - 1]
        np.cumsum(x * up[: len(x)], out=total[1 : len(x) + 1])
        m = len(x) - size + 1
        out[s : s + m] = mix((total[size : size + m] - total[:m]) * down[:m])
    return out


class Words:
    """Words of many texts, found without an object for each: all texts one after another, and where words start and end."""

    def __init__(self, texts: list[bytes | None], lower: bool = False, stops: bool = False):
        """stops: a word also ends between an ASCII letter and one of .,;:!?"""
        data = b"\n".join([*(t or b"" for t in texts), b""])
        self.data = data.lower() if lower else data
        self.bytes = np.frombuffer(self.data, np.uint8)
        edge = np.flatnonzero(np.diff(SPACE[self.bytes], prepend=True))  # words end before the last byte, a space
        self.starts, self.ends = edge[::2], edge[1::2]
        if stops:
            kind = KINDS[self.bytes]
            cut = np.flatnonzero((kind[1:] == 2) & (kind[:-1] == 1)) + 1
            self.starts, self.ends = np.sort(np.r_[self.starts, cut]), np.sort(np.r_[self.ends, cut])
        self.places = np.cumsum([0, *(len(t or b"") + 1 for t in texts)])
        self.counts = np.diff(np.searchsorted(self.starts, self.places))

    def hashes(self, family: int = 0) -> np.ndarray:
        """64-bit hashes of the words' bytes; each family is independent of the others. Eight bytes at a time are mixed in, many words at once; words of more than LONG bytes have an XXH3."""
        lanes = np.ndarray((len(self.data) + 1,), "<u8", self.data + bytes(8), strides=(1,))
        size, out = self.ends - self.starts, np.empty(len(self.starts), np.uint64)
        for s in range(0, len(out), PIECE):
            at, left = self.starts[s : s + PIECE], size[s : s + PIECE]
            h = stirred(left.astype(np.uint64) + np.uint64(family << 32))
            h = stirred(h ^ (lanes[at] & FIRST[np.minimum(left, 8)]))
            k, live = 8, np.flatnonzero((left > 8) & (left <= LONG))
            while len(live):
                h[live] = stirred(h[live] ^ (lanes[at[live] + k] & FIRST[np.minimum(left[live] - k, 8)]))
                k += 8
                live = live[left[live] > k]
            for w in np.flatnonzero(left > LONG).tolist():
                h[w] = xxhash.xxh3_64_intdigest(self.data[at[w] : at[w] + left[w]], family)
            out[s : s + PIECE] = h
        return out

    def slices(self, first, last) -> list[bytes]:
        """The stretches from word first[k] up to word last[k], as they stand."""
        data = self.data
        return [data[a:b] for a, b in zip(self.starts[first].tolist(), self.ends[last].tolist(), strict=True)]


class Memo:
    """Ids of words, remembered by the word's hash and checked by a second, independent one. learn() gives those of new words: all ids one after another, and how many each word has."""

    def __init__(self, learn, limit: int = 1_500_000, slots: int = 21):
        self.learn, self.limit, self.bits, self.begun = learn, limit, slots, 0
        self.forget()

    def forget(self) -> None:
        """Known words by rising hash, with the place and number of their ids; and a table in which most of them are found at once by the first bits of the hash."""
        self.begun += 1
        self.hashes, self.number = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.first, self.length, self.check = np.zeros(self.limit, np.int32), np.zeros(self.limit, np.int32), np.zeros(self.limit, np.uint64)
        self.ids, self.used, self.count = np.zeros(1 << 20, np.uint32), 0, 0
        self.slots, self.where = np.zeros(1 << self.bits, np.uint64), np.full(1 << self.bits, -1, np.int32)

    def slot(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - self.bits)).astype(np.int64)

    def add(self, hashes: np.ndarray, check: np.ndarray, words: list[bytes]) -> None:
        """Words not known yet, by rising hash."""
        ids, length = self.learn(words)
        number = np.arange(self.count, self.count + len(words), dtype=np.int32)
        self.first[number], self.length[number] = np.cumsum(length) - length + self.used, length
        self.check[number] = check
        self.count += len(words)
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.used : self.used + len(ids)] = ids
        self.used += len(ids)
        at = np.searchsorted(self.hashes, hashes)
        self.hashes, self.number = np.insert(self.hashes, at, hashes), np.insert(self.number, at, number)
        slot = self.slot(hashes)
        free = self.where[slot] < 0  # words met early, the frequent ones, keep their slots
        self.slots[slot[free]], self.where[slot[free]] = hashes[free], number[free]
        taken = slot[free & (self.slots[slot] != hashes)]
        if len(taken):  # two new words in one slot: the last one written has it, with its own number
            self.where[taken] = self.number[np.searchsorted(self.hashes, self.slots[taken])]

    def look_up(self, hashes: np.ndarray, check: np.ndarray, words) -> np.ndarray | None:
        """Numbers of the words; words(places) gives those at some places. None if they are more than can be remembered."""
        number, begun = self.found(hashes, check, words), self.begun
        if number is not None:
            other = np.flatnonzero(self.check[number] != check)
            if len(other):  # another word with this hash came first: these go by a number made of both hashes
                more = self.look_up(mix(hashes[other] + check[other]), check[other], lambda at: words(other[at]))
                if more is None:
                    return None
                if self.begun != begun:  # the memory was emptied in between
                    return self.look_up(hashes, check, words)
                number[other] = more
        return number

    def found(self, hashes: np.ndarray, check: np.ndarray, words) -> np.ndarray | None:
        """Numbers by hash alone; new words are learned."""
        slot = self.slot(hashes)
        number = np.where(self.slots[slot] == hashes, self.where[slot], -1)
        rest = np.flatnonzero(number < 0)
        if len(rest):
            distinct, one, back = np.unique(hashes[rest], return_index=True, return_inverse=True)
            at = np.minimum(np.searchsorted(self.hashes, distinct), max(0, len(self.hashes) - 1))
            new = self.hashes[at] != distinct if len(self.hashes) else np.ones(len(distinct), bool)
            if self.count + new.sum() > self.limit:
                if not self.count:
                    return None
                self.forget()  # start again with an empty memory
                return self.found(hashes, check, words)
            if new.any():
                self.add(distinct[new], check[rest[one[new]]], words(rest[one[new]]))
                at = np.searchsorted(self.hashes, distinct)
            number[rest] = self.number[at][back]
        return number

    def gather(self, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words one after another, and where each word's ids start (with the end of the last)."""
        length = self.length[number]
        total = np.zeros(len(length) + 1, np.int64)
        np.cumsum(length, out=total[1:])
        kind = np.int32 if total[-1] + self.used < 2**31 else np.int64
        at = np.repeat(self.first[number] - total[:-1].astype(kind), length)
        at += np.arange(total[-1], dtype=kind)
        return self.ids[at], total
