"""N-gram language model in Elias-Fano tries, and scores of all documents under it.

Counts cover every training document and nothing is pruned, so the model grows with the corpus; it is never in one place. Documents are taken where they lie, about GROUP bytes at a time; such a group is written down once,
as numbers of its distinct words (64-bit hashes of their bytes), and the texts are not read or moved again.
1. A group sends each shard of the vocabulary its distinct words with training counts, and gets back global ids (in each shard frequent words have small ones) and counts.
2. It sends each shard of the trie its distinct pairs and triples as ids: once each, however often they occur, so a frequent pair costs a shard one row a group. The shard is chosen by a hash of the first word; where that is frequent, by the second word too.
3. A shard adds the counts up and builds its trie. Level 1 holds first words, level 2 the second words of each, level 3 the third words of each pair. A level is one monotone sequence (siblings plus the base of their parent),
   and the pointers to children are monotone too; both are Elias-Fano coded, in a file that is mapped and has no name any more, together with the probabilities, quantised to 16 bits (1/4096 of a decade).
   A query looks for its word among the successors of its context: a successor search in the sequence from the context's base on.
4. The group gets back codes in the order it asked and sums the texts' log probabilities.
How pieces travel, and how many, is in `exchange`.

Smoothing. Triples, absolute discounting: p(w|uv) = (c(uvw) - D3)/c(uv) + D3 t(uv)/c(uv) p(w|v), t the number of distinct words after uv; a triple that its own text alone has counts little, so texts that training holds twice stand out.
Pairs, Dirichlet: p(w|v) = c(vw)/(c(v)+MU2) + MU2/(c(v)+MU2) p(w). Words: p(w) = (c(w)+1)/(N+V+1), which leaves 1/(N+V+1) to all unknown words together.

Nulls and ties: a null text is empty, and has one token, its end; a null doc_id counts as the text '' for the split. Without training documents N = V = 0. Repeated rows count and score each. Words are told apart by 64-bit hashes. Columns besides doc_id and text are not read.
"""

from __future__ import annotations

import mmap
import os
import tempfile

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import exchange
from .common import Words, bounded_batches, bucketed, enter, delta, materialize, parts, stirred, total_bytes, training, utf8

#: Bytes of text in a group, and for which there is one shard.
GROUP, SHARD = 8 << 20, 8 << 20
#: Training occurrences of a first word for which one shard has its pairs; those of a more frequent word are dealt over more of them.
SPLIT = 16_384
D3, MU2 = 0.9, 1000.0
SCALE, ABSENT = 4096, 0xFFFF
#: Values whose low bits are read or written at once.
PART = 1 << 14
#: The end of a text among the hashes of words.
END = np.uint64(0x5851F42D4C957F2D)


class EliasFano:
    """A monotone sequence of numbers below `top`: low bits packed, high bits in unary."""

    def __init__(self, values: np.ndarray, top: int):
        self.n = len(values)
        self.low = min(32, max(0, (max(top, 1) // max(self.n, 1)).bit_length() - 1))
        values = values.astype(np.uint64)
        high = (values >> np.uint64(self.low)).astype(np.int64) + np.arange(self.n)
        bits = np.zeros(int(high[-1]) + 1 if self.n else 0, bool)
        bits[high] = True
        self.upper = np.packbits(bits)
        # low bits, a few thousand values at a time: their number is a multiple of 8, so each part ends with a whole byte
        parts_ = [np.packbits(np.unpackbits(values[k : k + PART].astype(">u8").view(np.uint8).reshape(-1, 8)[:, 4:], axis=1)[:, 32 - self.low :]) for k in range(0, self.n if self.low else 0, PART)]
        self.lower = np.concatenate(parts_) if parts_ else np.zeros(0, np.uint8)
        self.index()

    def index(self):
        """Set bits before each 4096 bytes of the upper part."""
        counts = np.add.reduceat(np.bitwise_count(self.upper), np.arange(0, len(self.upper), 4096)) if len(self.upper) else np.zeros(0)
        self.before = np.r_[0, np.cumsum(counts, dtype=np.int64)]

    def range(self, first: int, last: int) -> np.ndarray:
        """Values first to last - 1."""
        if first >= last:
            return np.zeros(0, np.uint64)
        b, e = int(np.searchsorted(self.before, first, "right")) - 1, int(np.searchsorted(self.before, last, "left"))
        at = np.flatnonzero(np.unpackbits(np.asarray(self.upper[b * 4096 : e * 4096]))) + b * 4096 * 8
        at = at[first - self.before[b] : last - self.before[b]] - np.arange(first, last)
        out = at.astype(np.uint64) << np.uint64(self.low)
        for k in range(first, last if self.low else first, PART):
            end = min(last, k + PART)
            s, t = k * self.low, end * self.low
            bits = np.unpackbits(np.asarray(self.lower[s // 8 : (t + 7) // 8]))[s % 8 : s % 8 + t - s].reshape(-1, self.low)
            wide = np.zeros((len(bits), 32), np.uint8)
            wide[:, 32 - self.low :] = bits
            out[k - first : end - first] |= np.packbits(wide, axis=1).view(">u4").ravel().astype(np.uint64)
        return out

    def __getitem__(self, i: int) -> int:
        return int(self.range(i, i + 1)[0])


class Mapped:
    """The bytes of some sequences, and of arrays of codes, in one file that is mapped into memory and deleted at once."""

    def __init__(self, sequences: list[EliasFano], codes: list[np.ndarray]):
        arrays = [*(a for s in sequences for a in (s.upper, s.lower)), *codes]
        fd, path = tempfile.mkstemp()
        try:
            with os.fdopen(fd, "w+b") as f:
                for a in arrays:
                    f.write(a.data)
                f.write(b"\0")
                f.flush()
                self.map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        finally:
            os.unlink(path)
        at = 0
        for s in sequences:
            for name in ("upper", "lower"):
                n = len(getattr(s, name))
                setattr(s, name, np.frombuffer(self.map, np.uint8, n, at))
                at += n
        self.codes = []
        for a in codes:
            self.codes.append(np.frombuffer(self.map, a.dtype, len(a), at))
            at += a.nbytes


def quantised(p: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return np.minimum(np.round(-np.log10(p) * SCALE), ABSENT - 1).astype(np.uint16)


def value(codes: np.ndarray, absent: float) -> np.ndarray:
    return np.where(codes == ABSENT, absent, 10.0 ** (-codes.astype(np.float64) / SCALE))


class Trie:
    """Pairs and triples of word ids with counts above 0, sorted. u, v, c2, cu: a row a pair; pair, w, c3: a row a triple."""

    SLAB = 1 << 20

    def __init__(self, u, v, c2, cu, pair, w, c3):
        self.top = int(max([0, *(int(a.max()) for a in (u, v, w) if len(a))])) + 1
        self.roots, first = np.unique(u, return_index=True)
        parent = np.repeat(np.arange(len(self.roots)), np.diff(np.r_[first, len(u)]))
        # a level as one monotone sequence: siblings plus their parent's number times the range of ids
        self.second = EliasFano(parent.astype(np.uint64) * np.uint64(self.top) + v, max(1, len(self.roots)) * self.top)
        self.third = EliasFano(pair.astype(np.uint64) * np.uint64(self.top) + w, max(1, len(u)) * self.top)
        self.pointers = [EliasFano(np.r_[first, len(u)], len(u) + 1), EliasFano(np.searchsorted(pair, np.arange(len(u) + 1)), len(w) + 1)]
        types = np.bincount(pair, minlength=len(u))
        gamma2 = np.where(types > 0, D3 * types / np.maximum(c2, 1), 1.0)  # a pair that ends a text has no successors
        self.file = Mapped([self.second, self.third, *self.pointers], [quantised(c2 / (cu + MU2)), quantised(gamma2), quantised((c3 - D3) / c2[pair])])
        self.alpha2, self.gamma2, self.alpha3 = self.file.codes

    def search(self, sequence: EliasFano, pointer: EliasFano, parents: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Position of each word among the successors of its parent, or -1. Parents come in rising order, -1 for none."""
        out = np.full(len(words), -1)
        k = int(np.searchsorted(parents, 0))
        while k < len(parents):
            first = pointer[int(parents[k])]
            last = min(sequence.n, first + self.SLAB)
            # contexts whose successors all lie in this part
            ends = pointer.range(int(parents[k]) + 1, min(pointer.n, int(parents[k]) + 1 + self.SLAB))
            some = max(1, int(np.searchsorted(ends, last, "right")))
            last = max(last, int(ends[0]))
            until = int(np.searchsorted(parents, int(parents[k]) + some))
            part = sequence.range(first, last)
            wanted = parents[k:until].astype(np.uint64) * np.uint64(self.top) + words[k:until]
            at = np.minimum(np.searchsorted(part, wanted), max(0, len(part) - 1))
            if len(part):
                out[k:until] = np.where((part[at] == wanted) & (words[k:until] < self.top), at + first, -1)
            k = until
        return out

    def answer(self, u, v, number, w):
        """Codes for pairs (sorted) and for their triples: pair k has number[k] of them in w."""
        at = np.minimum(np.searchsorted(self.roots, u), max(0, len(self.roots) - 1))
        root = np.where(self.roots[at] == u, at, -1) if len(self.roots) else np.full(len(u), -1)
        order = np.argsort(root, kind="stable")
        pairs = np.empty(len(u), np.int64)
        pairs[order] = self.search(self.second, self.pointers[0], root[order], v[order])
        parent = np.repeat(pairs, number)
        order = np.argsort(parent, kind="stable")
        triples = np.empty(len(w), np.int64)
        triples[order] = self.search(self.third, self.pointers[1], parent[order], w[order])
        code = lambda codes, at: np.where(at < 0, np.uint16(ABSENT), codes[at] if len(codes) else np.uint16(ABSENT)).astype(np.uint16)
        return code(self.alpha2, pairs), code(self.gamma2, pairs), code(self.alpha3, triples)


def numbered(a: np.ndarray, b: np.ndarray, train: np.ndarray, count: bool):
    """Distinct pairs (a << 32 | b, rising) of numbers that are both 0 or more, the pair's number in each place (-1: none), and how often it stands in training."""
    both = np.flatnonzero((a >= 0) & (b >= 0))
    key = a[both] << 32 | b[both]
    order = np.argsort(key)
    key = key[order]
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    key, both = key[new], both[order]
    del order
    name = np.cumsum(new) - 1
    out = np.full(len(a), -1)
    out[both] = name
    return key, out, np.bincount(name[train[both]], minlength=len(key)).astype(np.uint32) if count else None


def dealt(shard: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows by shard, otherwise in their order, and where each shard starts."""
    shard = shard.astype(np.uint16 if shards <= 65536 else np.int64)
    order = np.argsort(shard, kind="stable")
    return order, np.r_[0, np.cumsum(np.bincount(shard, minlength=shards))]


def distinct(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs sorted: their order, which of them are new there, and the number of each pair among the distinct ones."""
    if not len(a):
        return np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)
    if max(int(a.max()), int(b.max())) < 2**32:
        key = a << np.uint64(32) | b
        order = np.argsort(key)
        key = key[order]
        new = np.r_[True, key[1:] != key[:-1]]
    else:
        order = np.lexsort((b, a))
        new = np.r_[True, (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])]
    name = np.empty(len(a), np.int64)
    name[order] = np.cumsum(new) - 1
    return order, new, name


def pack(*arrays: np.ndarray) -> bytes:
    head = np.array([len(arrays), *(x for a in arrays for x in (a.dtype.itemsize, len(a)))], np.int64).tobytes()
    planes = [np.ascontiguousarray(np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.dtype.itemsize).T).tobytes() for a in arrays]
    return zstandard.compress(head + b"".join(planes), 3)


def unpack(blob: bytes) -> list[np.ndarray]:
    data = zstandard.decompress(blob)
    (n,) = np.frombuffer(data, np.int64, 1).tolist()
    head, at, out = np.frombuffer(data, np.int64, 2 * n, 8).tolist(), 8 + 16 * n, []
    for size, count in zip(head[::2], head[1::2], strict=True):
        planes = np.frombuffer(data, np.uint8, size * count, at).reshape(size, count)
        out.append(np.ascontiguousarray(planes.T).view(f"u{size}").ravel())
        at += size * count
    return out


class Group:
    """The tokens of a group's documents: distinct words (hashes, the most frequent first), and the number of each token's word."""

    def __init__(self, state: bytes):
        self.words, self.tokens, sizes, train, ids, null = unpack(state)
        self.sizes, self.held_out = sizes.astype(np.int64), train == 0
        self.train = np.repeat(train == 1, self.sizes)
        self.ids = pa.array(ids.view(np.int64), mask=null == 1)
        self.first = np.cumsum(self.sizes) - self.sizes

    @staticmethod
    def state(rows: pa.Table) -> bytes:
        rows = rows.combine_chunks()
        words = Words(utf8(rows.column("text").combine_chunks()), lower=True)
        found, tokens, often = np.unique(np.insert(words.hashes(), np.cumsum(words.counts), END), return_inverse=True, return_counts=True)  # each text has an end
        order = np.argsort(-often, kind="stable")
        rank = np.empty(len(order), np.uint32)
        rank[order] = np.arange(len(order), dtype=np.uint32)
        ids = rows.column("doc_id").combine_chunks()
        return pack(found[order], rank[tokens], (words.counts + 1).astype(np.uint32), rows.column("train").to_numpy().astype(np.uint8), ids.fill_null(0).to_numpy().view(np.uint64), ids.is_null().to_numpy(zero_copy_only=False).astype(np.uint8))

    def by_shard(self, shards: int):
        """Places of the words of each shard, by rising hash."""
        shard = (self.words % np.uint64(shards)).astype(np.int64)
        order = np.lexsort((self.words, shard))
        cut = np.searchsorted(shard[order], np.arange(shards + 1))
        return [(s, order[cut[s] : cut[s + 1]]) for s in range(shards) if cut[s] < cut[s + 1]]

    def training_counts(self) -> np.ndarray:
        return np.bincount(self.tokens[self.train], minlength=len(self.words)).astype(np.uint64)

    def vocabulary(self, answers: dict[int, bytes], shards: int, ids: bool):
        """Training counts (0: unknown) and, to ask, global ids of the words."""
        self.counts, self.names = np.zeros(len(self.words), np.uint64), np.zeros(len(self.words), np.uint64)
        for s, at in self.by_shard(shards):
            (self.counts[at],) = unpack(answers[s + shards])
            if ids:
                (self.names[at],) = unpack(answers[s])

    def grams(self, shards: int, ask: bool = True):
        """Distinct pairs and triples of known words, shard by shard: (shard, pairs, triples) and, to ask, what is sent. Word 0 stands for the start of a text here, id 1 in what is sent.
        The shard of a pair is chosen by the hash of its first word and, if that has more than SPLIT occurrences, the second word's hash."""
        rank = np.where(self.counts > 0, np.arange(1, len(self.words) + 1), -1)
        hashes = np.r_[np.uint64(1), self.words]
        cur = rank[self.tokens]
        prev = np.empty_like(cur)
        prev[1:] = cur[:-1]
        prev[self.first] = 0
        pairs, self.pair, c2 = numbered(prev, cur, self.train, ask)
        self.context = np.empty_like(self.pair)
        self.context[1:] = self.pair[:-1]
        self.context[self.first] = -1
        triples, self.triple, c3 = numbered(self.context, cur, self.train, ask)
        u, v = pairs >> 32, pairs & 0xFFFFFFFF
        owner = triples >> 32
        counts = np.r_[np.uint64(self.ends), self.counts]
        h = stirred(hashes[u] * np.uint64(0xC2B2AE3D27D4EB4F) + hashes[v] % (counts[u] // np.uint64(SPLIT) + np.uint64(1)))
        order, cut = dealt((h >> np.uint64(33)) % np.uint64(shards), shards)
        number = np.bincount(owner, minlength=len(pairs))[order]
        start = np.searchsorted(owner, np.arange(len(pairs)))[order]
        third = np.repeat(start - (np.cumsum(number) - number), number) + np.arange(number.sum())
        upto = np.r_[0, np.cumsum(number)][cut]
        if ask:
            names = np.r_[np.uint64(1), self.names]
            u, v, w = u[order], names[v[order]], names[triples[third] & 0xFFFFFFFF]
            c2, number, c3 = c2[order], number.astype(np.uint32), c3[third]
        for s in range(shards):
            a, b, x, y = cut[s], cut[s + 1], upto[s], upto[s + 1]
            if a < b and ask:
                new = np.flatnonzero(np.diff(u[a:b], prepend=-1))  # first words once each, with their number of pairs
                one = u[a:b][new]
                yield s, pack(names[one], counts[one], np.diff(np.r_[new, b - a]).astype(np.uint32), v[a:b], c2[a:b], number[a:b], w[x:y], c3[x:y])
            elif a < b:
                yield s, order[a:b], third[x:y]

    def context_count(self) -> np.ndarray:
        """Training count of the word before each token; a text starts as often as one ends."""
        c = self.counts[self.tokens].astype(np.float64)
        before = np.r_[0.0, c[:-1]]
        before[self.first] = self.ends
        return before


def score(docs: DataFrame, modulus: int = 7, held_out: int = 2, group: int = GROUP, shard: int = SHARD, width: int = exchange.WIDTH) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row."""
    spark = docs.sparkSession
    bounded_batches(spark)
    nbytes = total_bytes(docs)
    shards, n = int(nbytes / shard) + 1, parts(spark, nbytes, shard)
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), training("doc_id", modulus, held_out).alias("train"))

    def read(batches):
        enter("lm")
        for g, rows_ in exchange.chunks(batches, group):
            yield exchange.record([(g, 0, Group.state(rows_))])

    states = bucketed(rows.mapInArrow(read, exchange.ROWS).select("g", F.col("blob").alias("state")), n, "g")
    between = exchange.Exchange(int(nbytes / group) + 1, shards, n, width)

    def words(batches):
        enter("lm")
        for b in batches:
            for g, state in zip(b.column("g").to_pylist(), b.column("state").to_pylist(), strict=True):
                own = Group(state)
                counts = own.training_counts()
                yield exchange.record(between.sent(g, ((s, pack(delta(own.words[at]), counts[at])) for s, at in own.by_shard(shards))))

    def number(shard, asked):
        all_ = [unpack(x) for _, x in asked]
        known, back = np.unique(np.concatenate([np.cumsum(d, dtype=np.uint64) for d, _ in all_]), return_inverse=True)
        counts = np.bincount(back, weights=np.concatenate([c for _, c in all_])).astype(np.uint64)
        rank = np.empty(len(known), np.uint64)
        rank[np.argsort(counts)[::-1]] = np.arange(len(known), dtype=np.uint64)
        ids = rank * np.uint64(shards) + np.uint64(shard + 2)
        yield -1, b"%d,%d,%d" % (counts.sum(), (counts > 0).sum(), counts[known == END].sum())
        at = 0
        for (g, _), (d, _) in zip(asked, all_, strict=True):
            own = back[at : at + len(d)]
            at += len(d)
            yield g, exchange.frame([(0, pack(ids[own])), (1, pack(counts[own]))])

    numbered_ = materialize(between.at_shards(states.mapInArrow(words, exchange.ROWS), number))
    sums = F.split(F.col("blob").cast("string"), ",")
    total = numbered_.filter("g < 0").agg(*(F.sum(sums[k].cast("long")) for k in range(3))).first()  # three numbers to the driver
    tokens, types, ends = (int(x or 0) for x in total)
    vocabulary = between.back(numbered_)
    slim = between.mapped(vocabulary, lambda x: exchange.frame(exchange.unframe(x)[1:]))

    def restored(state, answers, ids):
        own, own.ends = Group(state.column("state")[0].as_py()), ends
        got = {s: dict(exchange.unframe(x)) for s, x in between.received(answers).items()}
        own.vocabulary({s + shards * k: x for s, both in got.items() for k, x in both.items()}, shards, ids)
        return own

    def ask(key, state, answers):
        enter("lm")
        return exchange.table(between.sent(key[0].as_py(), restored(state, answers, True).grams(shards)))

    def look_up(shard, asked):
        enter("lm")
        parts_ = []
        for _, blob in asked:
            u, cu, pairs, v, c2, k, w, c3 = unpack(blob)
            parts_.append((np.repeat(u, pairs), v, c2, np.repeat(cu, pairs), k.astype(np.int64), w, c3))
        u, v, c2, cu, k, w, c3 = (np.concatenate([p[i] for p in parts_]) for i in range(7))
        sizes = [(len(p[0]), len(p[5])) for p in parts_]
        del parts_
        order, new, name = distinct(u, v)
        pair_counts = np.bincount(name, weights=c2)
        rows_ = order[new]
        owner = np.repeat(name, k)
        order3, new3, name3 = distinct(owner.astype(np.uint64), w)
        counts3 = np.bincount(name3, weights=c3)
        rows3 = order3[new3]
        live, live3 = pair_counts > 0, counts3 > 0
        where = np.cumsum(live) - 1
        u1, v1, owner1, w1 = u[rows_], v[rows_], owner[rows3], w[rows3]
        trie = Trie(u1[live], v1[live], pair_counts[live], cu[rows_][live].astype(np.float64), where[owner1[live3]], w1[live3], counts3[live3])
        # every distinct question is asked once, in order, and the codes are dealt to the groups that sent it
        a2, g2, a3 = trie.answer(u1, v1, np.bincount(owner1, minlength=len(u1)), w1)
        at2, at3 = 0, 0
        for (g, _), (two, three) in zip(asked, sizes, strict=True):
            own, own3 = name[at2 : at2 + two], name3[at3 : at3 + three]
            at2, at3 = at2 + two, at3 + three
            yield g, pack(a2[own], g2[own], a3[own3])

    def finish(key, state, answers):
        enter("lm")
        is_word = answers.column("words")
        own, codes = restored(state, answers.filter(is_word), False), between.received(answers.filter(pc.invert(is_word)))
        got = [(at, third, unpack(codes[s])) for s, at, third in own.grams(shards, ask=False)]
        size2, size3 = sum(len(x[0]) for x in got), sum(len(x[1]) for x in got)
        alpha2, gamma2, alpha3 = np.full(size2 + 1, ABSENT, np.uint16), np.full(size2 + 1, ABSENT, np.uint16), np.full(size3 + 1, ABSENT, np.uint16)
        for at, third, (a2, g2, a3) in got:
            alpha2[at], gamma2[at], alpha3[third] = a2, g2, a3
        del got, codes
        c = own.counts[own.tokens].astype(np.float64)
        p1 = (c + 1) / (tokens + types + 1)
        p2 = value(alpha2[own.pair], 0.0) + MU2 / (own.context_count() + MU2) * p1
        p3 = value(alpha3[own.triple], 0.0) + value(gamma2[own.context], 1.0) * p2
        add = lambda x: np.add.reduceat(x, own.first) if len(own.first) else np.zeros(0)
        return pa.table({
            "doc_id": own.ids, "held_out": pa.array(own.held_out), "n_tokens": pa.array(own.sizes),
            "n_known": pa.array(add((c > 0).astype(np.int64)), pa.int64()), "train_tokens": pa.array(np.full(len(own.ids), tokens), pa.int64()),
            "base_score": pa.array(add(np.log10(p1)), pa.float64()), "score": pa.array(add(np.log10(p3)), pa.float64()),
        })

    grams = states.groupBy("g").cogroup(vocabulary.groupBy("g")).applyInArrow(ask, exchange.ROWS)
    answers = between.back(between.at_shards(grams, look_up)).withColumn("words", F.lit(False)).unionByName(slim.withColumn("words", F.lit(True)))
    return states.groupBy("g").cogroup(answers.groupBy("g")).applyInArrow(finish, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
