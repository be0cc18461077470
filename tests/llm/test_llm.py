"""Each operator against a brute-force version, a library or an exact round trip, with nulls, empty texts, ties, repeated rows, empty tables and other columns."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quernstone.llm import ann, fingerprint, html_extract, language_id, licenses, ngram_lm, packing, sentencepiece_scan, simhash, substring
from quernstone.llm.common import Memo, Words

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row long, g int, fp long"


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def texts(seed=1, n=120):
    r = random.Random(seed)
    words = [f"w{k}" for k in range(300)] + ["the", "of", "and", "École", "naïve", "日本"]
    out = []
    for k in range(n):
        if out and r.random() < 0.25:
            t = r.choice(out).split(" ")
            for _ in range(r.randint(0, 2)):
                t[r.randrange(len(t))] = r.choice(words)
            out.append(" ".join(t))
        else:
            out.append(" ".join(r.choice(words) for _ in range(r.randint(1, 90))))
    shared = " ".join(r.choice(words) for _ in range(60))
    return [t if k % 5 else t + "\n" + shared + "\t end" for k, t in enumerate(out)]


def corpus():
    some = texts()
    rows = [(k * 3, t) for k, t in enumerate(some)] + [(1000, None), (1001, ""), (1002, " \n\t"), (1003, "one"), (1004, "one two three"), (None, some[0]), (1005, "ONE TWO three"), (9, some[3]), (9, some[3]), (1006, "x" * 300 + " " + "y " * 400)]
    return [(i, t, "en", "s", len(t or ""), 7, 8, 9) for i, t in rows]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_words():
    some = [None, "", "a b", "É x y\n", " lead", "trail ", "a"]
    w = Words([t and t.encode() for t in some])
    got = [x.decode() for x in w.slices(np.arange(len(w.starts)), np.arange(len(w.starts)))]
    assert got == [x for t in some for x in WORD.findall(t or "")] and w.counts.tolist() == [len(WORD.findall(t or "")) for t in some]
    h = w.hashes()
    assert h[0] == h[-1] and len(set(h.tolist())) == len(set(got))


def thue_morse(n, a, b):
    """Two words of 2^n letters with the same polynomial hash modulo 2^64 for any base."""
    bits = [k.bit_count() % 2 for k in range(2**n)]
    return "".join(a if x else b for x in bits), "".join(b if x else a for x in bits)


def test_hashes_tell_words_apart():
    some = [*thue_morse(10, "x", "y"), *thue_morse(11, "a", "b"), *thue_morse(5, "p", "q"), "x" * 64, "x" * 65, "x" * 63, "\0", "\0\0", "12345678", "123456789", "1234567\0"]
    w = Words([" ".join(some).encode()])
    one, two = w.hashes(), w.hashes(1)
    assert len(set(one.tolist())) == len(some) == len(set(two.tolist())) and not set(one.tolist()) & set(two.tolist())
    # the same word has one hash wherever it stands
    again = Words([b"lead " + x.encode() + b"\n" for x in some])
    assert again.hashes()[1::2].tolist() == one.tolist()


def test_words_of_one_polynomial_hash_stay_apart(spark):
    one, two = thue_morse(10, "x", "y")
    some = [" ".join(["a", w, *"bcdefghijkl"]) for w in (one, two)] + [one, two]
    rows = [(k, t, "en", "s", len(t), 7, 8, 9) for k, t in enumerate(some)]
    table = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    assert all(r.n_removed == 0 for r in substring.digest(table).collect())
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in substring.digest(table).collect()) == plain_removals([r[:2] for r in rows])
    check_packing([r[:2] for r in rows], packing.pack(table, public_tokenizers.path("word_bpe_49k.json")).collect())


def test_memo_checks_what_it_finds():
    words = [b"a", b"bb", b"ccc", b"bb"]
    memo = Memo(lambda ws: (np.array([len(w) for w in ws], np.uint32), np.ones(len(ws), np.int64)), limit=10, slots=4)
    number = memo.look_up(np.array([5, 5, 5, 5], np.uint64), np.array([1, 2, 3, 2], np.uint64), lambda at: [words[k] for k in at])
    assert memo.gather(number)[0].tolist() == [1, 2, 3, 2]


def test_exchange(spark):
    """What shards get and give back is the same however rows are framed."""
    from quernstone.llm import exchange

    pieces = {(g, s): f"{g}/{s}".encode() for g in range(7) for s in range(11) if (g + s) % 3}
    for width in (2, 3, 512):
        x = exchange.Exchange(7, 11, 3, width)
        sent = spark.createDataFrame([r for g in range(7) for r in x.sent(g, [(s, b) for (k, s), b in pieces.items() if k == g])], exchange.ROWS)
        assert sent.groupBy("g").count().agg({"count": "max"}).first()[0] <= width or width == 512

        def settle(shard, asked):
            yield -1, b"sum"
            for g, piece in asked:
                yield g, piece + b"=%d" % shard

        got = {}
        for r in x.back(x.at_shards(sent, settle)).toArrow().to_pylist():
            got.update({(r["g"], s): b for s, b in x.received(exchange.table([(r["g"], r["shard"], r["blob"])])).items()})
        assert got == {(g, s): b + b"=%d" % s for (g, s), b in pieces.items()}


# 6


def plain_fingerprint(t):
    w = WORD.findall(lower(t or ""))
    if not w:
        return 0
    grams = [" ".join(w[k : k + 4]) for k in range(len(w) - 3)] if len(w) >= 4 else [" ".join(w)]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@pytest.mark.parametrize("bucket", [simhash.BUCKET, 3])
def test_simhash(docs, bucket):
    rows = [(r[0], plain_fingerprint(r[1])) for r in corpus()]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= 4:
                up[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    want = sorted((str(d), f"{f:016x}", least[find(i)]) for i, (d, f) in enumerate(rows))
    got = simhash.near_duplicates(docs, bucket=bucket).collect()
    assert sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in got) == want


def test_cover_misses_no_pair():
    r = random.Random(2)
    masks = simhash.cover(list(range(64)), 4)
    assert len(masks) == 31
    for _ in range(3000):
        d = sum(1 << b for b in r.sample(range(64), 4))
        assert any(not d & m for m in masks)


def test_components(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 90), (90, 95)]
    got = {r.node: r.root for r in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[k] == 0 for k in range(1, 41)) and got[100] == got[95] == 90


# 8


def plain_removals(rows):
    first = {}
    for d, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        w = WORD.findall(t or "")
        for k in range(len(w) - 12):
            first.setdefault(tuple(w[k : k + 13]), d)
    out = []
    for d, t in rows:
        w, gone = WORD.findall(t or ""), set()
        for k in range(len(w) - 12):
            if first[tuple(w[k : k + 13])] != d:
                gone.update(range(k, k + 13))
        kept = [x for k, x in enumerate(w) if k not in gone]
        out.append((str(d), len(w), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("group", [substring.GROUP, 500])
def test_substring(docs, group, monkeypatch):
    monkeypatch.setattr(substring, "GROUP", group)
    monkeypatch.setattr(substring, "SHARD", group)
    monkeypatch.setattr(substring, "WIDTH", 4 if group == 500 else 512)
    got = sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in substring.digest(docs).collect())
    assert got == plain_removals([r[:2] for r in corpus()])
    assert sum(r[2] for r in got) > 0


def test_substring_keeps_columns(docs):
    out = substring.deduplicate(docs.drop("g"))
    assert out.columns == docs.drop("g").columns and out.count() == len(corpus())
    assert out.filter("n_chars <> length(text)").count() == 0


def test_hash_collisions_are_told_apart():
    tokens, check = np.array([1, 1, 1, 1], np.uint64), np.array([5, 6, 5, 7], np.uint64)
    assert substring.classes(tokens, check, np.arange(4), np.array([3, 2, 1, 4]), 1).tolist() == [1, 2, 1, 4]


# 7


def check_packing(rows, pieces, window=4096):
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {}
    for d, x in rows:
        want.setdefault(d, []).append(t.encode(x or "", add_special_tokens=False).ids + [2])
    covered, sequences = {}, {}
    for p in pieces:
        ids = next(i for i in want[p.doc_id] if len(i) == p.doc_tokens)
        assert zlib.crc32(np.array(ids[p.start : p.start + p.length], "<u4").tobytes()) == p.ids_crc32
        covered.setdefault((p.doc_id, p.doc_tokens), []).append((p.start, p.length))
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for d, some in want.items():
        for ids in some:
            copies = sum(len(x) == len(ids) for x in some)
            assert sum(n for _, n in covered[d, len(ids)]) == len(ids) * copies
            if copies == 1:
                at = 0
                for a, n in sorted(covered[d, len(ids)]):
                    assert a == at
                    at += n
    padding = 0
    for s in sequences.values():
        at = 0
        for o, n in sorted(s):
            assert o == at
            at += n
        assert at <= window
        padding += window - at if at & (at - 1) else 0
    return padding


def test_packing(docs):
    rows = [r[:2] for r in corpus()]
    path = public_tokenizers.path("word_bpe_49k.json")
    assert check_packing(rows, packing.pack(docs, path).collect()) == 0
    assert check_packing(rows, packing.pack(docs, path, window=64).collect(), 64) == 0


def test_packing_plan():
    assert sum(n * c for n, c in packing.best_fill({5: 2, 3: 1, 2: 4}, 11).items()) == 11
    assert packing.best_fill({4: 2, 6: 1}, 5) == {4: 1} and packing.best_fill({}, 5) == {}
    r = random.Random(3)
    for histogram in ({3000: 1000}, {100: 7}, {}, {n: r.randint(1, 50) for n in r.sample(range(1, 4096), 300)}, {2049: 5, 1: 3}):
        windows = packing.plan(dict(histogram))
        used = {}
        for times, pieces in windows:
            assert sum(b - a for _, _, a, b, _ in pieces) <= 4096
            for n, first, a, b, step in pieces:
                for k in range(times):
                    used.setdefault((n, first + k * step), []).append((a, b))
        assert sorted({n: c for n, c in histogram.items()}) == sorted({n for n, _ in used})
        for n, c in histogram.items():
            for rank in range(c):
                at = 0
                for a, b in sorted(used[n, rank]):
                    assert a == at
                    at = b
                assert at == n
        full = sum(t for t, p in windows if sum(b - a for _, _, a, b, _ in p) == 4096)
        assert sum(t for t, _ in windows) - full <= 1 if histogram and sum(n * c for n, c in histogram.items()) > 4096 else True


# 10


def test_language(spark):
    r = random.Random(4)
    alphabets = {"aa": "abcdef ", "bb": "defghi ", "cc": "ghijkl "}
    rows = [(k, "".join(r.choice(alphabets[x]) for _ in range(120)), x) for k, x in enumerate(r.choice("abc") * 2 for _ in range(300))]
    rows += [(900, None, "aa"), (901, "12 34", "aa"), (902, "abcabc", None), (903, "", "bb")]
    out = language_id.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("x")))
    got = {x.doc_id: x for x in out.collect()}
    held = [k for k in got if zlib.crc32(str(k).encode()) % 4 == 2]
    assert sorted(k for k, x in got.items() if x.held_out) == sorted(held)
    assert all(got[k].lang_pred == x for k, t, x in rows[:300]) and all(got[k].lang_pred == "und" and got[k].score == 0 for k in (900, 901, 903))
    assert got[902].lang_pred == "aa" and all(0 <= x.score <= 1 for x in got.values())
    empty = language_id.identify(spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")).first()
    assert empty.lang_pred == "und"


def test_language_of_long_rows_only(spark):
    r = random.Random(4)
    rows = [(k, " ".join(r.choice(["und", "der", "sch", "ein"]) for _ in range(20)), "de") for k in range(40)]
    rows += [(100 + k, "é" * 3 + " ".join(r.choice(["et", "la", "les", "eau"]) for _ in range(400)), "fr") for k in range(8)] + [(200, " ".join(["der"] * 500), "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    some = language_id.sample(docs, per_language=5, max_bytes=400)
    assert sorted(some) == ["de", "fr"] and len(some["fr"]) == 5 and all(len(t) == 100 and t in rows_ for t, rows_ in ((t, "\n".join(x for _, x, _ in rows)) for t in some["fr"]))
    assert len(some["de"]) == 5 and all(t in {x for _, x, _ in rows[:40]} for t in some["de"])
    got = {x.doc_id: x.lang_pred for x in language_id.identify(docs, per_language=5, max_bytes=400).collect()}
    assert {got[100 + k] for k in range(8)} == {"fr"} and got[0] == "de"


def test_code_lengths_are_exact():
    sample, text = ["abracadabra", "abrac"], "abrazo"
    seen = [("\n" * 2 + t).encode() for t in sample]

    def bits(context, byte):
        total = 0.0
        for k in range(2, -1, -1):
            c = context[len(context) - k :]
            after = [s[i + k] for s in seen for i in range(2 - k, len(s) - k) if s[i : i + k] == c]
            if after:
                n, d = len(after), len(set(after))
                if byte in after:
                    return total + np.log2((n + d) / after.count(byte))
                total += np.log2((n + d) / d)
        return total + 8

    data = b"\n\n" + text.encode()
    want = sum(bits(data[k - 2 : k], data[k]) for k in range(2, len(data)))
    got = language_id.Model({"x": sample}, 2).bits([text])[0, 0]
    assert got == pytest.approx(want, rel=1e-6)


# 4


@pytest.mark.parametrize("sizes", [{}, {"group": 600, "shard": 400, "width": 3}])
def test_language_model(docs, sizes):
    rows = [r[:2] for r in corpus()]
    tokens = [WORD.findall(lower(t or "")) + ["\n"] for _, t in rows]
    held = [zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2 for d, _ in rows]
    c1, c2, c3, after = {}, {}, {}, {}
    for w, h in zip(tokens, held, strict=True):
        if not h:
            s = ["^", *w]
            for k, x in enumerate(s):
                c1[x] = c1.get(x, 0) + 1
                if k:
                    c2[s[k - 1], x] = c2.get((s[k - 1], x), 0) + 1
                if k > 1:
                    c3[s[k - 2], s[k - 1], x] = c3.get((s[k - 2], s[k - 1], x), 0) + 1
                    after.setdefault((s[k - 2], s[k - 1]), set()).add(x)
    n, v = sum(c for x, c in c1.items() if x != "^"), len(c1) - 1
    want = []
    for (d, _), w, h in zip(rows, tokens, held, strict=True):
        s, base, score = ["^", *w], 0.0, 0.0
        for k in range(1, len(s)):
            p1 = (c1.get(s[k], 0) + 1) / (n + v + 1)
            p = (c2.get((s[k - 1], s[k]), 0) + ngram_lm.MU2 * p1) / (c1.get(s[k - 1], 0) + ngram_lm.MU2)
            if k > 1 and (context := (s[k - 2], s[k - 1])) in c2:
                p = (max(0, c3.get((*context, s[k]), 0) - ngram_lm.D3) + ngram_lm.D3 * len(after[context]) * p) / c2[context]
            base, score = base + np.log10(p1), score + np.log10(p)
        want.append((str(d), h, len(w), sum(x in c1 for x in w), n, base, score))
    got = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in ngram_lm.score(docs, **sizes).collect())
    for a, b in zip(got, sorted(want), strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], rel=1e-9) and a[6] == pytest.approx(b[6], abs=3e-4 * a[2])  # quantised to 1/4096 of a decade


def test_elias_fano():
    r = np.random.default_rng(5)
    for n, top in ((0, 10), (1, 1), (5, 5), (40_000, 10**12), (70_000, 100)):
        values = np.sort(r.integers(0, top, n).astype(np.uint64))
        s = ngram_lm.EliasFano(values, top)
        ngram_lm.Mapped([s], [])
        assert (s.range(0, n) == values).all()
        for _ in range(20):
            a, b = sorted(r.integers(0, n + 1, 2).tolist())
            assert (s.range(a, b) == values[a:b]).all()


# 9


def test_fingerprint(docs):
    rows = sorted(((d, t or "") for d, t, *_ in corpus()), key=lambda r: (r[0] is None, -(r[0] or 0)))
    got = fingerprint.compare(docs).collect()
    assert len(got) == len(rows)
    by = {(r.doc_id, r.n_chars): r for r in got}
    ids = [d for d, _ in rows]
    for k, (d, t) in enumerate(rows):
        if ids.count(d) > 1 or ids.count(rows[(k + 1) % len(rows)][0]) > 1:
            continue  # order among equal ids is by a hash
        following, r = rows[(k + 1) % len(rows)][1], by[d, len(t)]
        new = t[: len(t) - len(t) // 2] + following[: len(t) // 2]
        assert r.edited_sha256 == hashlib.sha256(new.encode()).hexdigest()
        assert r.fingerprint == fingerprint.digest(t.encode()).hex() and r.edited_fingerprint == fingerprint.digest(new.encode()).hex()
        assert r.near_next == fingerprint.likeness(fingerprint.digest(t.encode()), fingerprint.digest(following.encode()))
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    a, b = fingerprint.digest(b"abc def ghi " * 30), fingerprint.digest(b"abc def ghi " * 30 + b"x")
    assert fingerprint.likeness(a, a) == 1 and fingerprint.likeness(a, b) == fingerprint.likeness(b, a)


def test_single_document_is_its_own_neighbour(spark):
    r = fingerprint.compare(spark.createDataFrame([(5, "abcdefgh")], "doc_id long, text string")).first()
    assert r.near_next == 1 and r.edited_sha256 == hashlib.sha256(b"abcdabcd").hexdigest()


# 5


def test_html():
    main = "<main><h1>T &amp; x</h1><p>A  <b>bold</b>\nword<br>more<p>Second<script>var a='</p>'</script> part</main>"
    assert html_extract.blocks(f"<nav>menu</nav>{main}<footer>f</footer>") == (["T & x", "A bold word more", "Second part"], True)
    page = '<body class="has-sidebar"><header><h1>Site</h1></header><div class="cookie-notice">ok?</div><article><header><h1>Title</h1></header><p>Body.</p><form>f</form><ul><li>one<li>two</ul><section id="comments"><p>nice</p></section><!-- x --></article><aside>x</aside><p>tail'
    assert html_extract.blocks(page) == (["Title", "Body.", "one", "two"], True)
    assert html_extract.blocks("") == ([], False) and html_extract.blocks("a < b &lt;i&gt;") == (["a < b <i>"], False)
    assert html_extract.blocks("<p>it's <a href=x title=it's>a</a> b") == (["it's a b"], False)


def test_cards_do_not_hide_the_main_text():
    blocks = html_extract.blocks
    assert blocks("<main><p>One.</p><article><p>Card.</p></article><p>Two.</p></main>") == (["Card."], True)
    cards = "<article><h2>Card</h2></article><article>Other</article>"
    assert blocks(f"<nav>menu</nav><main><p>One.</p>{cards}<p>Two.</p></main><footer>end</footer>") == (["One.", "Card", "Other", "Two."], True)
    assert blocks(f"<p>before</p>{cards}") == (["Card", "Other"], True)
    assert blocks("<article><p>Text</p><article class=comment>me too</article></article>") == (["Text"], True)
    assert blocks("<article><header><h1>Title</h1></header><p>Text</p><section><article><p>Inner</p></article></section></article>") == (["Title", "Text", "Inner"], True)


def test_extraction_keeps_repeated_rows_and_ignores_other_columns(spark):
    long = " ".join(f"word{k}" for k in range(60_000))
    rows = [(1, "http://h/a", f"<article><p>{long}</p></article>", "x", 9), (1, "http://h/a", f"<article><p>{long}</p></article>", "x", 9), (2, None, None, "y", 8), (3, "http://h/b", "", "z", 7)]
    out = html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string, g int")).collect()
    assert sorted((r.page_id, r.n_chars, r.text == long) for r in out) == [(1, len(long), True), (1, len(long), True), (2, 0, False), (3, 0, False)]


def test_host_boilerplate(spark):
    site = "<div><p>Welcome to our site where all the news is first</p></div>"
    pages = [(k, f"http://h.example/{k}", f"<body>{site}<p>Story number {k} tells of things seen only here {'x' * k} and nowhere else</p><p>All rights to this text are with the site owner</p>") for k in range(6)]
    pages += [(10, "http://other.example/", f"<body>{site}"), (11, None, None), (12, "http://h.example/c", pages[0][2])]
    got = {r.page_id: r for r in html_extract.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert all(got[k].text == f"Story number {k} tells of things seen only here {'x' * k} and nowhere else".replace("  ", " ") for k in range(6))
    assert got[12].text == got[0].text and got[10].text.startswith("Welcome") and got[11].text == "" and got[11].n_chars == 0


def test_groups_of_a_host_tell_each_other(spark, monkeypatch):
    pages = [(k, "http://h.example/", f"<p>{'one two three four five six seven' if k < 2 else 'all the news of our site comes first here'}</p><p>Only page {k} {'x' * k} has this line and page {k} {'y' * k} alone") for k in range(12)]
    pages += [(20, "http://h.example/", pages[3][2]), (21, "http://i.example/", "<p>copied whole and shared by nobody else</p>"), (22, "http://i.example/", "<p>copied whole and shared by nobody else</p>")]
    docs = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(4)
    read = lambda: {r.page_id: (r.text, r.n_chars) for r in html_extract.extract(docs).collect()}
    one = read()
    assert all(one[k][0].startswith("Only page") for k in range(12)) and one[20] == one[3] and one[22][0].startswith("copied")
    monkeypatch.setattr(html_extract, "GROUP_PAGES", 2)
    assert read() == one


def test_every_page_of_a_host_tells_its_boilerplate(spark, monkeypatch):
    site, notice, quoted = "Welcome to our site where all the news is first", "Sign up today and never miss a story of ours", "A saying that two pages of this site hold dear to them"
    pages = [(k, "http://h.example/", f"<div>{site}</div><article><p>Story {k} {'x' * k} of its own</p><p>{quoted if k < 3 else f'Only {k} has it'}</p><p>{notice}</p></article><p>tail {k}") for k in range(7)]
    pages += [(10, "http://h.example/", f"<div>{site}</div><p>The one page that does not mark its text</p><p>{quoted}</p>"), (11, "http://i.example/", f"<div>{site}</div><p>Alone</p>")]
    docs = spark.createDataFrame(pages, "page_id long, url string, html string")
    read = lambda **how: {r.page_id: r.text for r in html_extract.extract(docs, **how).collect()}
    one, bare = read(), read(marks=False)
    assert one[10] == f"The one page that does not mark its text\n{quoted}" and one[11] == f"{site}\nAlone"
    assert one[0] == f"Story 0  of its own\n{quoted}\n{notice}".replace("  ", " ") and one[5].endswith(f"Only 5 has it\n{notice}")
    assert bare[0] == "Story 0 of its own" and bare[5] == "Story 5 xxxxx of its own\nOnly 5 has it" and bare[10] == "The one page that does not mark its text"
    monkeypatch.setattr(html_extract, "GROUP_PAGES", 2)
    assert read() == one and read(marks=False) == bare


def test_shared_runs_against_a_plain_version():
    r, run = random.Random(5), 3
    for _ in range(200):
        pages = [[" ".join(r.choice("abcd") for _ in range(r.randint(1, 6))) for _ in range(r.randint(0, 5))] for _ in range(r.randint(1, 5))]
        inside = [[r.random() < 0.3 for _ in page] for page in pages]
        owns = [r.randint(0, 3) for _ in pages]
        at, of = {}, []  # pages of each run outside articles; (page, block) of each word of each run
        for k, page in enumerate(pages):
            words = [(w, b, inside[k][b]) for b, text in enumerate(page) for w in text.split(" ")]
            for i in range(len(words) - run + 1):
                here = words[i : i + run]
                if len({x for _, _, x in here}) == 1:
                    name = tuple(w for w, _, _ in here)
                    of.append((name, k, i, [b for _, b, _ in here]))
                    at.setdefault(name, set()).update({owns[k]} if not here[0][2] else ())
        got = html_extract.Runs(pages, run, owns, inside).shares()
        for k, page in enumerate(pages):
            start = 0
            for b, text in enumerate(page):
                n = len(text.split(" "))
                covers = [(i, blocks) for name, j, i, blocks in of if j == k and len(at[name]) > 1]
                whole = {x for i, _ in covers for x in range(i, i + run)} >= set(range(start, start + n))
                within = {x for i, blocks in covers if set(blocks) == {b} for x in range(i, i + run)}
                assert got[k][b] == pytest.approx(1 if whole else len(within) / n)
                start += n


# 3


def test_licenses(spark):
    rows = [(1, "x\nReleased under the MIT License.\ny"), (2, "licensed under the apache license, version 2.0 and more words follow here"), (3, "a licence to kill"), (4, None), (5, ""), (None, "This work is licensed under the GNU General Public License, version 3."),
            (6, "word " * 900 + "Licensed under CC BY-NC 4.0. " + "word " * 900)]
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {d: r.license for d, r in got.items()} == {1: "MIT", 2: "Apache-2.0", None: "GPL-3.0", 6: "CC-BY-NC-4.0"}
    assert got[1].start == 2 and got[1].n_diff == 0 and got[6].start == 4500


def test_license_wording_against_all_templates():
    s = licenses.Scanner()
    for name, template in licenses.TEMPLATES.items():
        best = s.confirm("Note: " + template + " Thanks.")
        assert best and best[0] == name and best[3] == 0
    n, a, b, found = licenses.aligned("a b c d".split(), "x a q c d y".split())
    assert (n, a, b, found) == (1, 1, 5, ["b->q"])


def test_wrapped_licenses():
    s, r = licenses.Scanner(), random.Random(3)
    for name, template in licenses.TEMPLATES.items():
        for prefix, width in (("", 3), (" * ", 5), ("# ", 9)):
            w = template.split()
            lines = "\n".join(prefix + " ".join(w[k : k + width]) for k in range(0, len(w), width))
            (at, got), = s.notices("Some words\n" + lines + "\n" + "and more words here\n" * 3)
            assert got[0] == name and got[3] == 0 and at == 11 + len(prefix)
    assert s.notices(" ".join(r.choice("a of free license software under".split()) for _ in range(3000))) == []


def test_every_license_of_a_block(spark):
    s = licenses.Scanner()
    assert [g[0] for _, g in s.notices("Released under the MIT License. Licensed under CC BY 4.0.")] == ["MIT", "CC-BY-4.0"]
    names, gap = sorted(licenses.TEMPLATES) * 3, {0: "", 1: "und so weiter ", 150: "word " * 150}
    for some in gap.values():
        text = some.join(licenses.TEMPLATES[k] + " " for k in names)
        got = s.notices(text)
        assert [g[0] for _, g in got] == names and all(text[at : at + len(g[5])] == g[5] for at, g in got)
    assert licenses.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).count() == len(names)


def test_compression_ranks_the_templates():
    s = licenses.Scanner()
    header = licenses.TEMPLATES["Apache-2.0-header"].replace("except", "unless")  # its first words are a whole shorter template
    for around in ("", "word " * 150, licenses.TEMPLATES["Apache-2.0"] + " ", "licensed under the terms of what follows, version 3. "):
        (_, got), = [x for x in s.notices(around + header + " " + around[::-1]) if x[1][4] > 7]
        assert got[0] == "Apache-2.0-header" and got[2] == ["except->unless"]
    for name, template in licenses.TEMPLATES.items():
        block = "Some text. " + template + " And more of it."
        ranked, saved = s.rank(block), s.saved(block, licenses.TEMPLATES)
        assert ranked[0] == name and sorted(ranked) == sorted(licenses.TEMPLATES) and [saved[k] for k in ranked] == sorted(saved.values(), reverse=True)
    # what stands around makes 3.0 save more of the block, at the place 2.0 does
    assert [g[0] for _, g in s.notices("version 3. version 3. " + licenses.TEMPLATES["GPL-2.0"] + " the terms of version 3.")] == ["GPL-2.0"]


# 1


def test_neighbours(spark):
    r = np.random.default_rng(6)
    x = r.standard_normal((1500, 16))
    x[100:160] = x[100]
    x[7] = 0
    rows = [(k, v.tolist()) for k, v in enumerate(x)] + [(2000, None), (2020, [float("nan")] * 16), (2040, [1.0, None] * 8), (2060, [1.0] * 3), (None, x[1].tolist())]
    got = {}
    for q in ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).orderBy("query_id", "rank").collect():
        got.setdefault(q.query_id, []).append((q.vec_id, q.score))
    assert sorted(got) == [k for k in range(0, 1500, 20)]
    ok, found = np.delete(np.arange(1500), 7), 0
    for q, some in got.items():
        near = sorted((-float(x[q] @ x[k]), k) for k in ok.tolist() if k != q)[:20]
        assert len(some) == 20 and all(s == pytest.approx(float(x[q] @ x[k]), abs=1e-12) for k, s in some)
        found += len({k for _, k in near} & {k for k, _ in some})
    assert found / 20 / len(got) >= 0.9
    assert [k for k, _ in got[120]] == [k for k in range(100, 121) if k != 120]
    few = ann.search(spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.0]), (20, [0.0, 1.0])], "vec_id long, embedding array<double>")).orderBy("query_id", "rank").collect()
    assert [(f.query_id, f.vec_id) for f in few] == [(0, 1), (0, 20), (20, 0), (20, 1)]


def test_repeated_rows_take_one_place(spark):
    r = np.random.default_rng(9)
    x = r.standard_normal((60, 4))
    x[0] *= 10
    x[30:50] = x[0]
    rows = [(k, v) for k, v in enumerate(x)] + [(0, x[0])] * 30 + [(5, x[5])] * 4 + [(20, v) for v in x[20] * r.uniform(1, 2, (25, 1))] + [(7, v) for v in x[20] * r.uniform(1, 2, (25, 1))]
    out = ann.search(spark.createDataFrame([(k, v.tolist()) for k, v in rows], "vec_id long, embedding array<double>"), sample=2000).orderBy("query_id", "rank").collect()
    for q in (0, 20, 40):
        best = {}
        for own in (v for k, v in rows if k == q):
            for k, v in rows:
                if k != q:
                    best[k] = max(best.get(k, -1e9), float(own @ v))
        got = [(o.vec_id, o.score) for o in out if o.query_id == q]
        assert len(got) == 20 == len({k for k, _ in got}) and all(s == pytest.approx(best[k], abs=1e-12) for k, s in got)
        assert len({k for k, _ in got} & set(sorted(best, key=lambda k: (-round(best[k], 9), k))[:20])) >= 18
    assert {o.vec_id for o in out if o.query_id == 0 and o.score == pytest.approx(float(x[0] @ x[0]))} == set(range(30, 50))


# 2


@pytest.fixture(scope="module")
def pieces():
    return public_tokenizers.path("piece_bpe_32k.model")


def test_sentencepiece(docs, pieces):
    sp = sentencepiece.SentencePieceProcessor(model_file=pieces)
    want = sorted((str(d), len(t or ""), zlib.crc32(np.array(sp.encode(t or ""), "<u4").tobytes())) for d, t, *_ in corpus())
    for giant, chunk in ((sentencepiece_scan.GIANT, sentencepiece_scan.CHUNK), (40, 24)):
        got = sentencepiece_scan.encode(docs, pieces, giant, chunk).select("doc_id", "n_chars", F.crc32("ids").alias("c"), "round_trip").collect()
        assert sorted((str(r.doc_id), r.n_chars, r.c) for r in got) == want and all(r.round_trip for r in got)
    back = sentencepiece_scan.decode(sentencepiece_scan.encode(docs, pieces), pieces).collect()
    assert sorted(r.decoded for r in back) == sorted((t or "") for _, t, *_ in corpus())


def test_pieces_match_the_library(pieces):
    sp, m, r = sentencepiece.SentencePieceProcessor(model_file=pieces), sentencepiece_scan.Model(pieces), random.Random(7)
    for k in range(400):
        t = "".join(r.choice("ab c▁é日\n1.,  the of tion ﬁ😀" if k % 2 else "aabbthe") for _ in range(r.randint(1, 90)))
        assert np.frombuffer(m.encode(m.sp.normalize(t)), "<u4").tolist() == sp.encode(t)


# all


def test_empty_tables(spark, none, pieces):
    path = public_tokenizers.path("word_bpe_49k.json")
    for out in (simhash.near_duplicates(none), substring.digest(none), substring.deduplicate(none.drop("g")), packing.pack(none, path), language_id.identify(none), fingerprint.compare(none), ngram_lm.score(none), licenses.scan(none), sentencepiece_scan.digest(none, pieces),
                html_extract.extract(spark.createDataFrame([], "page_id long, url string, html string")), ann.search(spark.createDataFrame([], "vec_id long, embedding array<double>"))):
        assert out.count() == 0


def test_pipeline(spark, tmp_path):
    import corpus_pipeline as p

    r = random.Random(8)
    base = [" ".join("".join(r.choice("etaoin") for _ in range(r.randint(2, 6))) for _ in range(60)) for _ in range(40)]
    shared = " ".join(base[0].split()[:20])
    rows = [(k, t, "en") for k, t in enumerate(base)] + [(100, base[3], "en"), (101, base[5] + " zz", "en"), (102, "12 34", "en"), (103, None, None), (104, base[7].replace(" ", "\n") + " " + shared, "en")]
    spark.createDataFrame([(d, t, x, "s", len(t or "")) for d, t, x in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    one = p.language(spark, docs, "")
    assert sorted(x.doc_id for x in one.collect()) == [*range(40), 100, 101, 104]
    two = p.near_duplicates(spark, one, "")
    kept = sorted(x.doc_id for x in two.collect())
    groups = {x.doc_id: x.component_id for x in simhash.near_duplicates(one).collect()}
    assert kept == sorted({d for d, c in groups.items() if d == c}) and 100 not in kept
    three = p.repeated_passages(spark, two, "")
    assert three.columns == docs.columns
    text = {x.doc_id: x.text for x in three.collect()}
    want = {d: h for d, _, _, h in plain_removals([(x.doc_id, x.text) for x in two.collect()])}
    assert all(hashlib.sha256(" ".join(WORD.findall(t)).encode()).hexdigest() == want[str(d)] for d, t in text.items())
    assert check_packing(list(text.items()), p.run(spark, str(tmp_path)).collect()) == 0
    assert [k for k, _ in p.STAGES] == ["language", "near_duplicates", "repeated_passages", "packing"]


def plain_shingles(t, words=5):
    w = lower(t).split()
    return {tuple(w[k : k + words]) for k in range(max(1, len(w) - words + 1))} if w else set()


@pytest.mark.parametrize("block", [7, 2048])
def test_prefixes_miss_no_partner(spark, block):
    from quernstone.llm import jaccard

    r = random.Random(4)
    base = [f"w{k}" for k in range(90)]
    rows = []
    for c in range(80):
        t = list(base[: r.choice([60, 75, 90])])
        for _ in range(r.randint(0, 6)):
            t[r.randrange(len(t))] = "x" + str(r.randrange(30))
        rows.append((c, " ".join(t)))
    texts_ = spark.createDataFrame(rows, "c long, text string")
    sets = {c: set(x.tolist()) for (c, _), x in zip(rows, jaccard.shingles([t.encode() for _, t in rows]), strict=True)}
    held = jaccard.prefixes(texts_, 3).withColumn("root", F.col("c") % 5).join(jaccard.signatures(texts_), "c")
    got = {(x.a, x.b) for x in jaccard.partners(held, 3, False, block).collect()}
    likely = {(x.a, x.b) for x in jaccard.partners(held, 3, True, block).collect()}
    assert likely < got and len(likely) <= held.count()
    want = {(a, b) for a in sets for b in sets if a < b and a % 5 != b % 5 and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])}
    assert want and want <= got and all(a < b and a % 5 != b % 5 for a, b in got)
    assert len(got) < len(rows) * (len(rows) - 1) // 3


def test_pipeline_reaches_similarity(spark):
    import corpus_pipeline as p

    r, texts_ = random.Random(12), []
    for k in range(60):
        t = ["".join(r.choice("etaoinsh") for _ in range(r.randint(3, 7))) for _ in range(r.choice([30, 150, 400]))]
        texts_.append(" ".join(t))
        for _ in range(3):  # near copies: some words replaced, so that similarity is about 0.6 to 0.98
            c = list(t)
            for _ in range(r.randint(1, max(1, len(t) // 30))):
                c[r.randrange(len(c))] = "zz" + str(r.randrange(99))
            texts_.append(" ".join(c))
    rows = list(enumerate(texts_)) + [(500, texts_[0]), (None, texts_[4]), (501, ""), (502, None), (503, "a b"), (504, "A\tb")]
    sets = [plain_shingles(t or "") for _, t in rows]
    fps = [simhash.simhash((t or "").encode()) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    wide = 0
    for i in range(len(rows)):
        for j in range(i):
            near = not (sets[i] or sets[j]) or 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])
            bits = (fps[i] ^ fps[j]).bit_count()
            wide += near and bits > 4
            if near or bits <= 4:
                root[max(find(i), find(j))] = min(find(i), find(j))
    assert wide > 20
    docs = spark.createDataFrame([(d, t, "en", "s", 1) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    kept = sorted(x.doc_id for x in p.near_duplicates(spark, docs, "").collect())
    assert kept == sorted(d for k, (d, _) in enumerate(rows) if find(k) == k)
