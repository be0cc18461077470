"""Language identification by prediction by partial matching (PPM).

Each language has a variable-order byte context tree: for every context of up to ORDER bytes seen in
training, the counts of the bytes that followed. A byte costs -log2(count / (total + distinct)) at the
longest context that has seen it, and every longer known context passed on the way costs its escape,
-log2(distinct / (total + distinct)); a byte no context has seen costs 8 bits more. Statistics are frozen
after training, so the cost of a byte depends on its ORDER + 1 bytes alone: texts are scored by table look-up,
and rows of the table are filled as new byte strings appear. Texts are scored whole.

Training takes a bounded sample: for each language the `per_language` training rows that come first by a hash of
their text and id. Rows of more than `max_bytes` bytes come after all others, and give a stretch of max_bytes / 4 characters whose place the hash chooses. The model is bounded by that and is sent to executors.

Nulls and ties: a null text or one without a letter is `und` with score 0, as is every text if nothing was learned.
Rows with null lang, or lang `und`, are not learned from. A null doc_id is hashed as ''. Ties between languages go to the first by name.
Repeated rows stay repeated. Columns besides doc_id, text and lang are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, enter, training

ORDER = 4
#: The bound of the training sample.
PER_LANGUAGE, MAX_BYTES = 256, 65_536
#: Bytes scored at once, and slots of the table of known costs.
PIECE, SLOTS = 1 << 19, 1 << 20


def grams(data: np.ndarray, size: int) -> np.ndarray:
    """The `size` bytes that end at each position from size - 1 on, as one number each."""
    out = np.zeros(max(0, len(data) - size + 1), np.uint64)
    for k in range(size):
        out <<= np.uint64(8)
        out |= data[k : len(data) - size + 1 + k]
    return out


def padded(text: str, order: int) -> bytes:
    return b"\n" * order + text.lower().encode("utf-8", "replace")


class Tree:
    """Counts of one language: for each order, known strings of context and byte, and known contexts."""

    def __init__(self, texts: list[str], order: int = ORDER):
        self.order, self.levels = order, []
        data = [np.frombuffer(padded(t, order), np.uint8) for t in texts]
        for k in range(order + 1):
            all_ = np.concatenate([grams(d[order - k :], k + 1) for d in data]) if data else np.zeros(0, np.uint64)
            seen, count = np.unique(all_, return_counts=True)
            context, first = np.unique(seen >> np.uint64(8), return_index=True)
            total = np.add.reduceat(count, first) if len(first) else np.zeros(0)
            distinct = np.diff(np.r_[first, len(seen)])
            where = np.searchsorted(context, seen >> np.uint64(8))
            self.levels.append((seen, np.log2((total + distinct)[where] / count), context, np.log2((total + distinct) / distinct)))

    def cost(self, strings: np.ndarray) -> np.ndarray:
        """Bits of the last byte of each string of order + 1 bytes, given those before it."""
        out, open_ = np.zeros(len(strings)), np.arange(len(strings))
        for k in range(self.order, -1, -1):
            if not len(open_):
                break
            seen, bits, context, escape = self.levels[k]
            if not len(seen):
                continue
            tail = strings[open_] & np.uint64(2 ** (8 * (k + 1)) - 1)
            at = np.minimum(np.searchsorted(seen, tail), len(seen) - 1)
            hit = seen[at] == tail
            out[open_[hit]] += bits[at[hit]]
            open_, tail = open_[~hit], tail[~hit]
            at = np.minimum(np.searchsorted(context, tail >> np.uint64(8)), len(context) - 1)
            known = context[at] == tail >> np.uint64(8)
            out[open_[known]] += escape[at[known]]
        out[open_] += 8
        return out


class Model:
    def __init__(self, samples: dict[str, list[str]], order: int = ORDER):
        self.order, self.names = order, sorted(samples)
        self.trees = [Tree(samples[x], order) for x in self.names]
        self.keys = None

    def costs(self, strings: np.ndarray) -> np.ndarray:
        """Bits for each string and language."""
        if self.keys is None:
            self.keys, self.rows = np.full(SLOTS, 2**64 - 1, np.uint64), np.zeros((SLOTS, len(self.names)), np.float32)
        slot = (strings * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SLOTS.bit_length() + 1)
        miss = self.keys[slot] != strings
        out = self.rows[slot]
        if miss.any():
            new, back = np.unique(strings[miss], return_inverse=True)
            got = np.column_stack([t.cost(new) for t in self.trees]).astype(np.float32)
            out[miss] = got[back]
            at = (new * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SLOTS.bit_length() + 1)
            self.rows[at] = got
            self.keys[at] = new
            lost = self.keys[at] != new  # two strings in one slot: only the last one written may stay
            self.keys[at[lost]] = 2**64 - 1
        return out

    def bits(self, texts: list[str]) -> np.ndarray:
        """Code length of each text under each language."""
        out = np.zeros((len(texts), len(self.names)))
        held, owner, size = [], [], 0

        def flush():
            nonlocal held, owner, size
            if held:
                got = self.costs(np.concatenate(held)).astype(np.float64)
                starts = np.cumsum([0] + [len(x) for x in held[:-1]])
                np.add.at(out, owner, np.add.reduceat(got, starts, axis=0))
            held, owner, size = [], [], 0

        for i, t in enumerate(texts):
            data = np.frombuffer(padded(t, self.order), np.uint8)
            for s in range(0, len(data) - self.order, PIECE):
                g = grams(data[s : s + PIECE + self.order], self.order + 1)
                held.append(g)
                owner.append(i)
                size += len(g)
                if size >= PIECE:
                    flush()
        flush()
        return out

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, float]]:
        """Language, probability among the learned languages, bits a byte."""
        out = [("und", 0.0, 0.0)] * len(texts)
        known = [i for i, t in enumerate(texts) if self.names and t and any(map(str.isalpha, t))]
        if known:
            bits = self.bits([texts[i] for i in known])
            best = bits.argmin(axis=1)
            with np.errstate(under="ignore"):
                share = 1 / np.exp2(-np.minimum(bits - bits.min(axis=1, keepdims=True), 1000)).sum(axis=1)
            for i, b, p, row in zip(known, best.tolist(), share.tolist(), bits, strict=True):
                out[i] = (self.names[b], p, float(row[b]) / len(texts[i].lower().encode("utf-8", "replace")))
        return out


def sample(docs: DataFrame, modulus: int = 4, held_out: int = 2, per_language: int = PER_LANGUAGE, max_bytes: int = MAX_BYTES) -> dict[str, list[str]]:
    """The training texts by language: at most per_language rows each, of at most max_bytes bytes; longer rows give a stretch where shorter ones are too few."""
    rows = docs.filter(training("doc_id", modulus, held_out) & F.col("lang").isNotNull() & (F.col("lang") != "und") & F.col("text").rlike(r"\p{L}"))
    rows = rows.select("lang", "text", F.xxhash64("doc_id", "text").alias("h"), (F.octet_length("text") > max_bytes).alias("long"))
    # the least hashes of each language, without sorting it: as many as a share of the range of hashes should hold, and more of it where repeated rows leave too few
    sizes = {(r.lang, r.long): r["count"] for r in rows.groupBy("lang", "long").count().collect()}
    upto = {k: -(2**63) + min(2**64 - 1, 2**64 * 4 * per_language // n) for k, n in sizes.items()}
    least: dict[tuple[str, bool], list[int]] = {}
    while open_ := {k: x for k, x in upto.items() if k not in least}:
        inside = F.lit(False)
        for (lang, long), x in open_.items():
            inside = inside | ((F.col("lang") == lang) & (F.col("long") == long) & (F.col("h") <= x))
        found: dict[tuple[str, bool], list[int]] = {k: [] for k in open_}
        for r in rows.filter(inside).select("lang", "long", "h").distinct().collect():  # some thousand numbers a language
            found[r.lang, r.long].append(r.h)
        for k, hs in found.items():
            if len(hs) >= per_language or upto[k] == 2**63 - 1:
                least[k] = sorted(hs)[:per_language]
            else:
                upto[k] = -(2**63) + min(2**64 - 1, 16 * (upto[k] + 2**63 + 1))
    cut = []
    for lang in sorted({lang for lang, _ in sizes}):
        some = [(long, h) for long in (False, True) for h in least.get((lang, long), ())][:per_language]
        cut.append((lang, *some[-1]))
    # one row a language; equal hashes beyond the bound are repeated rows
    chosen = F.lit(False)
    for lang, long, h in cut:
        last = (F.col("h") <= h) & (F.col("long") == long)
        chosen = chosen | ((F.col("lang") == lang) & (last | ~F.col("long") if long else last))
    size = max(1, max_bytes // 4)  # characters, so at most max_bytes bytes
    # no stretch starts before the first letter
    first = F.regexp_instr("text", F.lit(r"\p{L}"))
    place = F.when(F.length("text") - size + 1 > first, F.pmod(F.col("h"), F.length("text") - size + 2 - first) + first).otherwise(first)
    rows = rows.withColumn("text", F.when(F.col("long"), F.substring("text", place.cast("int"), F.lit(size))).otherwise(F.col("text")))
    out: dict[str, list[str]] = {}
    for r in sorted(rows.filter(chosen).select("lang", "long", "h", "text").distinct().collect(), key=lambda r: (r.lang, r.long, r.h, r.text)) if cut else []:
        if len(out.setdefault(r.lang, [])) < per_language:
            out[r.lang].append(r.text)
    return out


def identify(docs: DataFrame, modulus: int = 4, held_out: int = 2, per_language: int = PER_LANGUAGE, max_bytes: int = MAX_BYTES) -> DataFrame:
    """docs with held_out, lang_pred, score and bits_per_byte; columns of these names are replaced."""
    bounded_batches(docs.sparkSession)
    docs = docs.drop("held_out", "lang_pred", "score", "bits_per_byte")
    model = docs.sparkSession.sparkContext.broadcast(Model(sample(docs, modulus, held_out, per_language, max_bytes)))
    names = docs.columns
    schema = docs.withColumn("held_out", ~training("doc_id", modulus, held_out)).schema

    def run(batches):
        enter("language")
        for b in batches:
            got = model.value.predict(b.column(names.index("text")).to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([x[0] for x in got], pa.string()), *(pa.array([x[k] for x in got], pa.float64()) for k in (1, 2))], [*b.schema.names, "lang_pred", "score", "bits_per_byte"])

    ddl = schema.add("lang_pred", "string").add("score", "double").add("bits_per_byte", "double")
    return docs.withColumn("held_out", ~training("doc_id", modulus, held_out)).mapInArrow(run, ddl)


def accepted(docs: DataFrame, max_bits_per_byte: float = 8.0) -> DataFrame:
    """docs, whole rows, without texts that have no language: `und`, or coded worse than max_bits_per_byte by every
    language learned. At 8 bits a byte a model says no more than raw bytes do: such texts are in no language learned (texts of one take 2 to 4, short ones with keys and numbers in them up to 7)."""
    return identify(docs).filter((F.col("lang_pred") != "und") & (F.col("bits_per_byte") <= max_bits_per_byte)).select(*docs.columns)
