"""SentencePiece encoding and decoding as a parallel scan.

The vocabulary is a BPE model, so there is no sum of scores to maximise: a segmentation is the encoder's own if and only if every two neighbouring pieces, put together, are encoded as just these two. In max-plus terms
a step between compatible neighbours weighs 0 and any other minus infinity, and the state at a position is the last piece before it. For each start state and position at most one last piece is possible.

Where no piece can cross (before a space mark that follows another character) every state leads on alike, so words are segmented apart and remembered. A giant document is cut into chunks at fixed places. A chunk gives
a transfer matrix (sparse: the finite entries) from states at its first cut (a piece that ends at or crosses it, and where it ends) to states at its last. Matrices are combined associatively, in a tree; that settles the state at every cut, and
each chunk is backtraced on its own.

Nulls and ties: a null text counts as empty and has no pieces. Texts are whole; repeated rows and a null doc_id are encoded like any other. A mark U+2581 in a text decodes as a space (round_trip false). Columns besides doc_id and text are not read.
"""

from __future__ import annotations

import re
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memo, Words, bounded_batches, enter, materialize, memories, utf8

MARK = "▁"
GIANT, CHUNK = 32_768, 8_192
#: Pairs of pieces a worker remembers.
PAIRS = 1_000_000
WORD = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


class Segments(Words):
    """The stretches that no merge leaves, of normalised texts with spaces for marks: each starts at a space after another character, or at its text's start."""

    def __init__(self, texts: list[bytes]):
        self.data = b"".join(texts)
        self.bytes = np.frombuffer(self.data, np.uint8)
        self.places = np.cumsum([0, *map(len, texts)])
        space = self.bytes == 32
        cut = space.copy()
        cut[1:] &= ~space[:-1]
        cut[self.places[:-1][self.places[:-1] < len(cut)]] = True
        self.starts = np.flatnonzero(cut)
        self.ends = np.r_[self.starts[1:], len(cut)][: len(self.starts)]
        self.counts = np.diff(np.searchsorted(self.starts, self.places))


class Model:
    def __init__(self, path: str):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.sp.get_piece_size()
        self.bytes = {int(self.sp.id_to_piece(i)[3:5], 16): i for i in range(n) if self.sp.is_byte(i)}
        self.ids = {self.sp.id_to_piece(i): i for i in range(n) if not (self.sp.is_byte(i) or self.sp.is_control(i) or self.sp.is_unknown(i))}
        self.scores = {p: self.sp.get_score(i) for p, i in self.ids.items()}
        self.longest = max(map(len, self.ids), default=1)
        #: No piece has a space mark after another character, so no merge crosses there.
        self.apart = not any(re.search(f"[^{MARK}]{MARK}", p) for p in self.ids)
        self.texts = [b""] * n
        for b, i in self.bytes.items():
            self.texts[i] = bytes([b])
        for p, i in self.ids.items():
            self.texts[i] = p.replace(MARK, " ").encode()
        self.pairs: dict[tuple[str, str], bool] = {}
        self.own: dict[str, bool] = {}
        self.memo, self.unlike = Memo(self.learn), 0
        probe = " a  b\n\tç " + MARK
        #: Normalising only puts a mark first and turns spaces into marks.
        self.simple = self.apart and self.sp.normalize(probe) == MARK + probe.replace(" ", MARK)

    # pieces

    def merged(self, text: str) -> list[str]:
        """The merges of a short string: best score first, leftmost of equals."""
        parts = list(text)
        while len(parts) > 1:
            best = max(((self.scores.get(a + b, -np.inf), -k) for k, (a, b) in enumerate(zip(parts, parts[1:], strict=False))), default=(-np.inf, 0))
            if best[0] == -np.inf:
                break
            k = -best[1]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return parts

    def piece(self, p: str) -> bool:
        """Can p stand in a segmentation: a character, or a piece that is encoded as itself."""
        if len(p) == 1:
            return True
        if p not in self.ids:
            return False
        ok = self.own.get(p)
        if ok is None:
            ok = self.own[p] = self.merged(p) == [p]
        return ok

    def fits(self, a: str, b: str) -> bool:
        """The weight of a step is 0 (else minus infinity)."""
        ok = self.pairs.get((a, b))
        if ok is None:
            if len(self.pairs) > PAIRS:
                self.pairs.clear()
            ok = self.pairs[a, b] = self.merged(a + b) == [a, b]
        return ok

    def run(self, text: str, start: int, last: str | None, end: int, like: dict[int, str] | None = None) -> dict[int, str]:
        """Last piece at each reachable position after start, up to the pieces that reach or cross end. last: the piece before start (None: nothing before). like: a
        run from another state; once `longest` positions agree with it, the rest is the same."""
        known, same, stop = {start: last}, 0, min(len(text), end + self.longest - 1)
        for j in range(start + 1, stop + 1):
            for i in range(j - 1, max(start, j - self.longest) - 1, -1):
                if i >= end:
                    continue
                before = known.get(i, 0)
                if before == 0:
                    continue
                p = text[i:j]
                if self.piece(p) and (before is None or self.fits(before, p)):
                    known[j] = p
                    break
            if like is not None:
                same = same + 1 if known.get(j) == like.get(j) else 0
                if same >= self.longest:
                    return known | {k: p for k, p in like.items() if k > j}
        return known

    def trace(self, known: dict[int, str], start: int, end: int) -> list[str]:
        out = []
        while end > start:
            out.append(known[end])
            end -= len(known[end])
        return out[::-1]

    def pack(self, pieces: list[str]) -> bytes:
        out: list[int] = []
        for p in pieces:
            if (i := self.ids.get(p)) is not None:
                out.append(i)
            elif self.bytes:
                out += [self.bytes[b] for b in p.encode("utf-8", "replace")]
            else:
                out.append(self.sp.unk_id())
        return np.array(out, "<u4").tobytes()

    def segment(self, text: str) -> bytes:
        """Ids of a stretch that no merge leaves."""
        return self.pack(self.trace(self.run(text, 0, None, len(text)), 0, len(text)))

    def learn(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        got = [self.segment(w.decode("utf-8", "replace").replace(" ", MARK)) for w in words]
        self.unlike += sum(self.decode(x) != w for x, w in zip(got, words, strict=True))
        return np.frombuffer(b"".join(got), "<u4"), np.array([len(x) // 4 for x in got], np.int64)

    def encode_all(self, texts: list[bytes]) -> list[bytes]:
        """Ids of normalised texts (spaces for marks), as little-endian unsigned 32-bit numbers."""
        words = Segments(texts)
        number = self.memo.look_up(words.hashes(), words.hashes(1), lambda at: words.slices(at, at))
        if number is None:  # more distinct stretches than are remembered
            return [b"".join(self.segment(w) for w in WORD.findall(t.decode().replace(" ", MARK))) for t in texts]
        ids, total = self.memo.gather(number)
        data, ends = ids.astype("<u4").tobytes(), (total[np.r_[0, np.cumsum(words.counts)]] * 4).tolist()
        return [data[a:b] for a, b in zip(ends, ends[1:], strict=False)]

    def encode(self, text: str) -> bytes:
        """Ids of one normalised text."""
        if self.apart:
            return self.encode_all([text.replace(MARK, " ").encode()])[0]
        return self.segment(text) if text else b""

    def decode(self, ids: bytes) -> bytes:
        """UTF-8 of ids, with the space that encoding puts first."""
        return b"".join(map(self.texts.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    # chunks: `text` holds the chunk from `low` to `high` and enough around it

    def states(self, text: str, cut: int) -> list[tuple[int, str]]:
        """(end, piece) of every piece that ends at the cut or crosses it."""
        return [(j, text[i:j]) for j in range(cut, min(len(text), cut + self.longest - 1) + 1) for i in range(max(0, j - self.longest), cut) if self.piece(text[i:j])]

    def breaks(self, text: str, low: int, high: int) -> tuple[int, int] | None:
        """The first and last place in a chunk that no piece crosses, far enough from its ends."""
        if not self.apart:
            return None
        first = re.compile(f"(?<=[^{MARK}]){MARK}").search(text, low + self.longest, high)
        last = text.rfind(MARK, low + self.longest, high)
        while first and last > first.start() and text[last - 1] == MARK:
            last = text.rfind(MARK, low + self.longest, last)
        return (first.start(), last) if first and last >= first.start() else None

    def ends(self, known: dict[int, str], high: int) -> list[tuple[int, str]]:
        return [(j, p) for j, p in known.items() if p and j >= high and j - len(p) < high]

    def transfer(self, text: str, low: int, high: int, first: bool) -> dict[tuple, list[tuple]]:
        """Finite entries of the matrix: states at low -> states at high, places counted from the cut."""
        starts = [(low, None)] if first else self.states(text, low)
        middle, out, like = self.breaks(text, low, high), {}, None
        tail = self.ends(self.run(text, middle[1], None, high), high) if middle else []
        for at, p in starts:
            if middle:
                reached = middle[0] in self.run(text, at, p, middle[0])
                found = tail if reached else []
            else:
                known = self.run(text, at, p, high, like)
                like = like or known
                found = self.ends(known, high)
            if found:
                out[at - low, p] = [(j - high, q) for j, q in found]
        return out

    def backtrace(self, text: str, low: int, high: int, start: tuple, end: tuple) -> bytes:
        """Ids of the pieces after the start state up to and with the end state."""
        at, upto, middle = low + start[0], high + end[0], self.breaks(text, low, high)
        if not middle:
            return self.pack(self.trace(self.run(text, at, start[1], high), at, upto))
        a, b = middle
        head = self.pack(self.trace(self.run(text, at, start[1], a), at, a))
        return head + self.encode(text[a:b]) + self.pack(self.trace(self.run(text, b, None, high), b, upto))


def product(a: dict, b: dict) -> dict:
    """Max-plus product of two sparse matrices with entries 0."""
    out = {}
    for s, ends in a.items():
        if found := list(dict.fromkeys(t for e in ends for t in b.get(e, ()))):
            out[s] = found
    return out


def settled(matrices: list[dict], last: tuple) -> list[tuple]:
    """The state at every cut on the way from the start to the state `last`: products in a tree, then from the root down."""
    if len(matrices) == 1:
        (start,) = (s for s, ends in matrices[0].items() if last in ends)
        return [start, last]
    levels = [matrices]
    while len(levels[-1]) > 1:
        m = levels[-1]
        levels.append([product(m[k], m[k + 1]) if k + 1 < len(m) else m[k] for k in range(0, len(m), 2)])
    cuts = [(next(s for s, ends in levels[-1][0].items() if last in ends)), last]
    for below in levels[-2::-1]:
        out = [cuts[0]]
        for k in range(0, len(below), 2):
            start, end = cuts[k // 2], cuts[k // 2 + 1]
            if k + 1 < len(below):
                out.append(next(e for e in below[k][start] if end in below[k + 1].get(e, ())))
            out.append(end)
        cuts = out
    return cuts


def model_of(path: str) -> Model:
    """One for each vocabulary in a worker, kept from task to task."""
    enter("sentencepiece")
    if path not in memories:
        memories[path] = Model(path)
    return memories[path]


STATE = pa.list_(pa.struct([("s", pa.int32()), ("p", pa.string()), ("t", pa.int32()), ("q", pa.string())]))


def encode(docs: DataFrame, path: str, giant: int = GIANT, chunk: int = CHUNK) -> DataFrame:
    """doc_id, n_chars, ids (little-endian unsigned 32-bit numbers), round_trip (decoding gives the text back) for every row."""
    bounded_batches(docs.sparkSession)
    head = "doc_id long, n_chars long, ids binary, round_trip boolean"
    names = ["doc_id", "n_chars", "ids", "round_trip", "key", "k", "text", "low", "high"]
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.bool_(), pa.string(), pa.int32(), pa.string(), pa.int32(), pa.int32()]

    def model() -> Model:
        return model_of(path)

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names)

    def whole(batches):
        m = model()
        for b in batches:
            out, size = [], 0
            small: list[tuple] = []

            def flush():
                before = m.unlike
                plain = [b" " + t.replace(MARK.encode(), b" ") if m.simple else m.sp.normalize(t.decode()).replace(MARK, " ").encode() for _, _, t in small]
                got = m.encode_all(plain) if m.apart else [m.encode(x.decode().replace(" ", MARK)) for x in plain]
                for (doc_id, n, t), ids in zip(small, got, strict=True):
                    same = MARK.encode() not in t if m.simple and not before and not m.unlike else m.decode(ids) == (b" " + t if t else b"")
                    out.append((doc_id, n, ids if t else b"", same or not t, None, None, None, None, None))
                small.clear()

            for doc_id, n, text in zip(b.column("doc_id").to_pylist(), b.column("n_chars").to_pylist(), utf8(b.column("text")), strict=True):
                text = text or b""
                if n + 1 < giant:
                    small.append((doc_id, n, text))
                else:
                    plain = m.sp.normalize(text.decode())
                    key, round_ = uuid.uuid4().hex, plain.replace(MARK, " ") == " " + text.decode()
                    for k, low in enumerate(range(0, len(plain), chunk)):
                        a = max(0, low - m.longest)
                        out.append((doc_id, n, None, round_, key, k, plain[a : low + chunk + m.longest], low - a, min(len(plain), low + chunk) - a))
                size += len(text)
                if size >= 8 << 20:
                    flush()
                    yield batch(out)
                    out, size = [], 0
            flush()
            yield batch(out)

    def transfer(batches):
        m = model()
        for b in batches:
            cells = []
            for text, low, high, k in zip(*(b.column(x).to_pylist() for x in ("text", "low", "high", "k")), strict=True):
                cells.append([{"s": s, "p": p, "t": t, "q": q} for (s, p), ends in m.transfer(text, low, high, k == 0).items() for t, q in ends])
            yield pa.RecordBatch.from_arrays([b.column("key"), b.column("k"), pa.array(cells, STATE)], ["key", "k", "cells"])

    def scan(key, table):
        rows = sorted(zip(table.column("k").to_pylist(), table.column("cells").to_pylist(), strict=True))
        matrices = []
        for _, cells in rows:
            m: dict[tuple, list] = {}
            for c in cells:
                m.setdefault((c["s"], c["p"]), []).append((c["t"], c["q"]))
            matrices.append(m)
        # the text ends at its last cut
        for last in dict.fromkeys(t for ends in matrices[-1].values() for t in ends if t[0] == 0):
            try:
                cuts = settled(matrices, last)
                break
            except (StopIteration, ValueError):  # a state no start leads to
                continue
        return pa.table({"key": pa.array([key[0].as_py()] * len(rows)), "k": pa.array([k for k, _ in rows], pa.int32()), **{n: pa.array([c[i] for c in part], kind) for n, i, part, kind in (("s", 0, cuts[:-1], pa.int32()), ("p", 1, cuts[:-1], pa.string()), ("t", 0, cuts[1:], pa.int32()), ("q", 1, cuts[1:], pa.string()))}})

    def back(batches):
        m = model()
        for b in batches:
            out = []
            for text, low, high, s, p, t, q, ok in zip(*(b.column(x).to_pylist() for x in ("text", "low", "high", "s", "p", "t", "q", "round_trip")), strict=True):
                ids = m.backtrace(text, low, high, (s, p), (t, q))
                out.append((ids, ok and m.decode(ids) == text[low + s : high + t].replace(MARK, " ").encode()))
            yield pa.RecordBatch.from_arrays([*(b.column(x) for x in ("doc_id", "n_chars", "key", "k")), pa.array([x[0] for x in out], pa.binary()), pa.array([x[1] for x in out], pa.bool_())], ["doc_id", "n_chars", "key", "k", "ids", "round_trip"])

    def joined(key, table):
        rows = sorted(zip(*(table.column(x).to_pylist() for x in ("k", "ids", "round_trip")), strict=True))
        first = table.slice(0, 1)
        return pa.table({"doc_id": first.column("doc_id"), "n_chars": first.column("n_chars"), "ids": pa.array([b"".join(x[1] for x in rows)], pa.binary()), "round_trip": pa.array([all(x[2] for x in rows)])})

    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.length(text), F.lit(0)).cast("long").alias("n_chars"), text.alias("text"))
    made = materialize(rows.mapInArrow(whole, head + ", key string, k int, text string, low int, high int"))
    chunks = made.filter("key is not null").drop("ids")
    cells = chunks.select("key", "k", "text", "low", "high").mapInArrow(transfer, "key string, k int, cells array<struct<s int, p string, t int, q string>>")
    states = cells.groupBy("key").applyInArrow(scan, "key string, k int, s int, p string, t int, q string")
    parts_ = chunks.join(states, ["key", "k"]).mapInArrow(back, "doc_id long, n_chars long, key string, k int, ids binary, round_trip boolean")
    giants = parts_.groupBy("key").applyInArrow(joined, head)
    return made.filter("key is null").select("doc_id", "n_chars", "ids", "round_trip").unionByName(giants)


def decode(rows: DataFrame, path: str) -> DataFrame:
    """rows with ids (as `encode` gives them; null: empty) and a column decoded, their text."""

    def run(batches):
        m = Model(path)
        for b in batches:
            texts = [m.decode(x or b"").decode("utf-8", "replace").removeprefix(" ") for x in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts)], [*b.schema.names, "decoded"])

    rows = rows.drop("decoded")
    return rows.mapInArrow(run, rows.limit(0).withColumn("decoded", F.lit("")).schema)


def digest(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_chars, n_pieces, ids_crc32, round_trip for every row."""
    return encode(docs, path).select("doc_id", "n_chars", (F.octet_length("ids") / 4).cast("long").alias("n_pieces"), F.crc32("ids").alias("ids_crc32"), "round_trip")
