"""Main text of web pages, with a host's boilerplate found by suffix array.

A page is read into blocks of text. Blocks within elements that say what they are (navigation, page header, footer, aside, form, advert, cookie notice, reader comments, ...)
go, and so do scripts and styles. The token streams of all pages of a host are put one after another, and a suffix array sorted by prefix doubling gives every run of RUN tokens that distinct pages share;
blocks mostly covered by shared runs go; unique runs stay. Pages with the same text count as one page there, so a copied article is no boilerplate.
Where a page marks its article (one <article>; else <main>, with what articles it holds; else all articles), the mark is checked after that: the blocks inside are its text, even if other pages have them too (quotations, copies), and those around them are not.
What stands around marked articles tells what is boilerplate of the host, what stands inside does not; so a page without a mark is judged by all pages of its host. With marks=False the suffix array alone decides inside articles.

Pages of one host are dealt by a hash of the page into groups of about GROUP_PAGES pages or GROUP_BYTES bytes, each with a suffix array of its own, so that a host with any share of all pages is dealt over many tasks.
Where a host has several groups, each sends a hash of every distinct run that may tell boilerplate once, with the least and the greatest of its pages; runs that distinct pages of the host share return to the groups that have sent them. So the result does not depend on groups or partitions.

Nulls and ties: null html gives an empty text; a null url is a host of its own (''). A page alone on its host keeps what its own structure leaves. Repeated rows stay repeated. Columns besides page_id, url and html are not read.
"""

from __future__ import annotations

import html as entities
import re
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BASE, bounded_batches, mix, parts

RUN, COVERED = 6, 0.7
GROUP_PAGES, GROUP_BYTES = 256, 8 << 20

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe svg math object audio video canvas title textarea xmp noframes noembed".split())
GONE = frozenset("nav footer aside form menu dialog button select option datalist fieldset label input".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody tfoot thead tr ul".split())
#: Start tags that end an open element of the second kind.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
#: Where a search for an open element to close ends.
SCOPE = frozenset("article main section body html table ul ol dl td th blockquote aside nav header footer form".split())
#: Words in class, id or role that name what is not the article.
NAMED = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert nav navbar navigation menu menus breadcrumb breadcrumbs sidebar sidebars widget widgets "
    "related recommended share sharing social comment comments respond reply replies disqus footer masthead newsletter subscribe subscription signup login searchform pagination pager popup modal overlay toolbar copyright complementary contentinfo search dialog".split()
)
TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([A-Za-z][^\s/>]*)([^>]*)>|<[!?/][^>]*>", re.S)
NAMES_IN = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
HIDDEN = re.compile(r"(?:^|\s)(?:hidden(?=[\s/=]|$)|aria-hidden\s*=\s*[\"']?true|style\s*=\s*[\"'][^\"']*display\s*:\s*none)", re.I)
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


def named(attributes: str) -> set[str]:
    return {w.lower() for m in NAMES_IN.finditer(attributes) for w in WORD.findall(m[1] or m[2] or m[3] or "")}


def streams(source: str) -> tuple[list[str], list[bool], bool]:
    """Blocks of text in page order, whether each may be main text, and whether the page marks its article."""
    found: list[tuple[str, int, str]] = []  # part of the page, number of its article (0: none), text
    stack: list[tuple[str, bool, tuple[str, int]]] = []  # name, dropped, part of the page
    articles = 0
    text: list[str] = []
    lower = None

    def state():
        return stack[-1][1:] if stack else (False, ("", 0))

    def flush():
        if text:
            line = " ".join(entities.unescape("".join(text)).split())
            if line:
                found.append((*state()[1], line))
            text.clear()

    at, end = 0, len(source)
    while at < end:
        m = TAG.search(source, at)
        upto = m.start() if m else end
        if upto > at and not state()[0]:
            text.append(source[at:upto])
        if not m:
            break
        at = m.end()
        name = m[2] or m[5]
        if not name:
            if m[0].startswith("<![CDATA[") and not state()[0]:
                text.append(entities.escape(m[0][9:].removesuffix("]]>")))
            continue
        name, closing, attributes = name.lower(), m[1] or m[4], m[3] or m[6] or ""
        if name in ("br", "td", "th", "img", "wbr") and not state()[0] and name != "wbr":
            text.append(" ")
        if closing:
            if name in BLOCK:
                flush()
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    flush_at = any(x[0] in BLOCK or x[1] for x in stack[k:])
                    if flush_at:
                        flush()
                    del stack[k:]
                    break
                if stack[k][0] in SCOPE and name not in SCOPE:
                    break
            continue
        if name in RAW:
            if attributes.rstrip().endswith("/") and name == "svg":
                continue
            lower = source.lower() if lower is None else lower
            shut = lower.find(f"</{name}", at)
            at = end if shut < 0 else (source.find(">", shut) + 1 or end)
            continue
        if name in BLOCK or name == "hr":
            flush()
            for k in range(len(stack) - 1, -1, -1):  # a block ends an open paragraph
                if stack[k][0] == "p":
                    del stack[k:]
                    break
                if stack[k][0] in SCOPE:
                    break
        for other in CLOSES.get(name, ()):
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == other:
                    flush()
                    del stack[k:]
                    break
                if stack[k][0] in SCOPE and stack[k][0] not in CLOSES[name]:
                    break
        if name in VOID or attributes.endswith("/") and name not in BLOCK:
            continue
        dropped, part = state()
        if not dropped:
            words = named(attributes) if attributes else ()
            dropped = name in GONE or (name == "header" and not any(part)) or bool(attributes and HIDDEN.search(attributes))
            if words and name not in ("html", "body", "main") and not (name == "article" and not any(part)):
                dropped = dropped or not NAMED.isdisjoint(words) or ("header" in words and not any(part))
            elif name == "article" and words and not {"comment", "comments", "reply"}.isdisjoint(words):
                dropped = True
            if dropped:
                flush()
            elif name == "article" and not part[1]:
                flush()
                articles += 1
                part = (part[0], articles)
            elif name == "main" and not part[0]:
                flush()
                part = (name, part[1])
        stack.append((name, dropped, part))
    flush()
    # one article is the text; several are parts of <main>, or the text together where there is none
    inside = {n for _, n, _ in found if n}
    main = any(part for part, _, _ in found)
    chosen = [bool(part) if main and len(inside) != 1 else bool(n) for part, n, _ in found]
    marked = any(chosen)
    return [x for _, _, x in found], chosen if marked else [True] * len(found), marked


def blocks(source: str) -> tuple[list[str], bool]:
    """Blocks that may be main text in page order, and whether the page marks its article."""
    texts, chosen, marked = streams(source)
    return [x for x, c in zip(texts, chosen, strict=True) if c], marked


def digest(page: list[str]) -> int:
    """What tells a page from pages with another text."""
    return xxhash.xxh64_intdigest("\n".join(page).encode("utf-8", "replace")) - 2**63


class Runs:
    """The runs of `run` words of some pages by suffix array; of each distinct run the least and greatest page (pages: a hash of the text) that has it outside of a marked article."""

    def __init__(self, pages: list[list[str]], run: int = RUN, owns: list[int] | None = None, inside: list[list[bool]] | None = None):
        self.pages, self.run = pages, run
        names: dict[str, int] = {}
        of, ids, block, tells, at = [], [], [], [], 0
        for k, page in enumerate(pages):
            own, before = digest(page) if owns is None else owns[k], None
            for text, marked in zip(page, inside[k] if inside else [False] * len(page), strict=True):
                words = text.split(" ")
                if before is not None and before != marked:  # a border of the article ends a run
                    words.insert(0, "")
                before = marked
                ids += [names.setdefault(w, len(names) + 1) if w else 0 for w in words]
                block += [at if w else -1 for w in words]
                of += [own] * len(words)
                tells += [not marked] * len(words)
                at += 1
            ids.append(0)
            of.append(own)
            block.append(-1)
            tells.append(False)
        self.ids, of, self.block = np.array(ids, np.int64), np.array(of, np.int64), np.array(block)
        self.words, self.blocks = list(names), at
        self.suffixes = ranked(self.ids, len(names), run)
        suffixes, rank = self.suffixes
        first = np.r_[True, rank[1:] != rank[:-1]] if len(rank) else np.zeros(0, bool)
        self.first, self.group = suffixes[first], np.cumsum(first) - 1
        self.low, self.high = np.full(len(self.first), 2**63 - 1), np.full(len(self.first), -(2**63))
        told = np.array(tells, bool)[suffixes]
        np.minimum.at(self.low, self.group[told], of[suffixes[told]])
        np.maximum.at(self.high, self.group[told], of[suffixes[told]])

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each distinct run."""
        word = np.array([0, *(xxhash.xxh64_intdigest(w.encode("utf-8", "replace")) for w in self.words)], np.uint64)
        out = np.zeros(len(self.first), np.uint64)
        for k in range(self.run):
            out = mix(out * np.uint64(BASE) + word[self.ids[self.first + k]])
        return out.view(np.int64)

    def shares(self, elsewhere: np.ndarray | None = None) -> list[list[float]]:
        """For each block of each page, the share of its words in runs that other pages have too, here or (hashes) elsewhere."""
        mine = self.low < self.high
        if elsewhere is not None and len(elsewhere):
            mine = mine | np.isin(self.hashes(), elsewhere)
        return covered_shares(self.pages, self.block, self.blocks, self.suffixes[0][mine[self.group]], self.run)


def shared(pages: list[list[str]], run: int = RUN) -> list[list[float]]:
    """For each block of each page, the share of its words in runs of `run` words that stand in other pages too."""
    return Runs(pages, run).shares()


def ranked(ids: np.ndarray, words: int, run: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes that start a run, sorted by it, and their ranks."""
    n = len(ids)
    # ranks of the suffixes by their first `run` words, by prefix doubling; a separator ends a run
    rank, span, alive = ids.copy(), 1, ids > 0
    while span < run:
        step = min(span, run - span)
        after = np.zeros(n, np.int64)
        after[: n - step] = rank[step:]
        ok = np.zeros(n, bool)
        ok[: n - step] = alive[step:]
        alive &= ok
        _, rank = np.unique(rank * (n + words + 2) + after, return_inverse=True)
        span += step
    suffixes = np.argsort(rank, kind="stable")
    suffixes = suffixes[alive[suffixes]]
    return suffixes, rank[suffixes]


def covered_shares(pages: list[list[str]], block: np.ndarray, at: int, common: np.ndarray, run: int) -> list[list[float]]:
    n = len(block)

    def inside(starts):
        covered = np.zeros(n + 1, np.int64)
        np.add.at(covered, starts, 1)
        np.add.at(covered, starts + run, -1)
        return np.cumsum(covered)[:-1] > 0

    real = block >= 0
    total = np.maximum(np.bincount(block[real], minlength=at), 1)
    share = lambda mask: np.bincount(block[real], weights=mask[real], minlength=at) / total
    # a run over several blocks counts for those it covers whole; a block that only begins or ends it is judged by the runs within
    whole, within = share(inside(common)), share(inside(common[block[common] == block[common + run - 1]]) if len(common) else np.zeros(n, bool))
    part = np.where(whole == 1, 1.0, within)
    out, at = [], 0
    for page in pages:
        out.append(part[at : at + len(page)].tolist())
        at += len(page)
    return out


def cut(page: list[str], chosen: list[bool]) -> list[list[str]]:
    """The stretches of blocks around what is chosen."""
    return [[x for x, _ in stretch] for c, stretch in groupby(zip(page, chosen, strict=True), lambda x: x[1]) if not c]


def extract(pages: DataFrame, run: int = RUN, covered: float = COVERED, marks: bool = True) -> DataFrame:
    """page_id, url, text, n_chars for every row."""
    spark = pages.sparkSession
    bounded_batches(spark)
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    rows = rows.withColumn("host", F.lower(F.coalesce(F.regexp_extract("url", r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit(""))))
    size = F.sum(F.coalesce(F.octet_length("html"), F.lit(0)))
    n = parts(spark, rows.agg(size).first()[0] or 0, GROUP_BYTES)
    # at most one row for GROUP_PAGES pages or GROUP_BYTES bytes, so that the pages need not move for it
    sizes = rows.groupBy("host").agg(F.greatest(F.ceil(F.count("*") / GROUP_PAGES), F.ceil(size / GROUP_BYTES)).alias("groups")).filter("groups > 1")
    dealt = rows.join(F.broadcast(sizes), "host", "left").withColumn("g", F.when(F.col("groups") > 1, F.pmod(F.xxhash64("page_id", "url", "html"), "groups")).otherwise(F.lit(0)).cast("long"))

    def read(batches):
        for b in batches:
            got = [streams(x or "") for x in b.column("html").to_pylist()]
            own = [digest([x for x, c in zip(texts, chosen, strict=True) if c]) for texts, chosen, _ in got]
            new = [pa.array(own, pa.int64()), pa.array([x for x, _, _ in got], pa.list_(pa.string())), pa.array([x for _, x, _ in got], pa.list_(pa.bool_())), pa.array([x and marks for _, _, x in got])]
            yield pa.RecordBatch.from_arrays([*(b.column(x) for x in ("page_id", "url", "host", "g")), *new], ["page_id", "url", "host", "g", "own", "blocks", "chosen", "marked"])

    def read_telling(batches):
        for b in read(batches):
            chosen, marked = b.column("chosen").to_pylist(), b.column("marked").to_pylist()
            # a border of the article ends a run here too
            texts = [cut(x, c) if m else [x] for x, c, m in zip(b.column("blocks").to_pylist(), chosen, marked, strict=True)]
            at = [k for k, pieces in enumerate(texts) for _ in pieces]
            out = pa.RecordBatch.from_arrays([b.column(x).take(pa.array(at, pa.int64())) for x in ("host", "g", "own")] + [pa.array([x for pieces in texts for x in pieces], pa.list_(pa.string()))], ["host", "g", "own", "blocks"])
            yield out.filter(pc.greater(pc.list_value_length(out.column("blocks")), 0))

    def send(key, part):
        runs = Runs(part.column("blocks").to_pylist(), run, part.column("own").to_pylist())
        m = len(runs.first)
        return pa.table({"host": pa.array([key[0].as_py()] * m, pa.string()), "g": np.full(m, key[1].as_py(), np.int64), "run": runs.hashes(), "low": runs.low, "high": runs.high})

    keys = ["host", "g"]
    telling = dealt.filter("groups > 1").select("page_id", "url", "host", "g", "html").mapInArrow(read_telling, "host string, g long, own long, blocks array<string>")
    sent = telling.repartition(n, *keys).groupBy(*keys).applyInArrow(send, "host string, g long, run long, low long, high long")
    common = sent.groupBy("host", "run").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.collect_set("g").alias("gs")).filter("low < high").select("host", F.explode("gs").alias("g"), "run")

    def settle(key, part, known):
        pages_, chosen, marked = (part.column(x).to_pylist() for x in ("blocks", "chosen", "marked"))
        inside = [[c and m for c in page] for page, m in zip(chosen, marked, strict=True)]
        shares = Runs(pages_, run, part.column("own").to_pylist(), inside).shares(known.column("run").to_numpy()) if pages_ else []
        texts = ["\n".join(b for b, s, c, i in zip(*page, strict=True) if i or c and s < covered) for page in zip(pages_, shares, chosen, inside, strict=True)]
        return pa.table({"page_id": part.column("page_id"), "url": part.column("url"), "text": pa.array(texts, pa.string()), "n_chars": pa.array(list(map(len, texts)), pa.int64())})

    left = dealt.select("page_id", "url", "host", "g", "html").mapInArrow(read, "page_id long, url string, host string, g long, own long, blocks array<string>, chosen array<boolean>, marked boolean")
    return left.repartition(n, *keys).groupBy(*keys).cogroup(common.groupBy(*keys)).applyInArrow(settle, "page_id long, url string, text string, n_chars long")
