"""Structured article XML into chunks, in document order.

Spark's XML reader loses the order of mixed content, so articles are read by the standard library in mapInPandas, a file a row. An article that cannot be read gives one row with an error; no task fails.
"""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fixed import SPLIT_TOKENS, TAIL_TOKENS

META = "struct<doi:string,title:string,source_path:string,sec_type:string,chunk_index:int,token_count:int,label:string,caption:string,header_rows:array<array<string>>,headers:array<string>,rows:array<array<string>>,n_rows:int,n_cols:int,footnotes:array<string>,markdown_text:string>"
CHUNK = f"paper_id string, chunk_id string, chunk_type string, text string, section_path array<string>, metadata {META}"
ROW = f"source_path string, {CHUNK}, skipped map<string,int>, error string"
SKIPPED = ("ref-list", "ack", "fn-group", "notes")
INNER = ("boxed-text", "app", "app-group", "body")
LETTER = {"paragraph": "p", "abstract": "a", "table": "t"}
SENTENCE = re.compile(r"(?<=[.!?])\s+(?=[\"'“(\[]?[A-Z0-9])")


def plain(node) -> str:
    """Text of an element, with a space between the texts of inline elements."""
    return " ".join(w for t in node.itertext() for w in t.split()) if node is not None else ""


def size_of(text: str) -> int:
    return max(1, len(text) // 4)


def split_paragraph(text: str, limit: int = SPLIT_TOKENS, tail: int = TAIL_TOKENS) -> list[str]:
    """Whole if short; else sentences up to the limit, cut only where enough is left."""
    if size_of(text) <= limit:
        return [text]
    parts = [s for s in (x.strip() for x in SENTENCE.split(text)) if s]
    left, out, held, held_size = sum(map(size_of, parts)), [], [], 0
    for s in parts:
        n = size_of(s)
        if held and held_size + n > limit and left >= tail:
            out.append(" ".join(held))
            held, held_size = [], 0
        held.append(s)
        held_size, left = held_size + n, left - n
    return [*out, " ".join(held)] if held else out


def grid(rows) -> list[list[str]]:
    """Cells of <tr> elements in place: a spanning cell has its text at its first place and '' at the others."""
    cells: dict[tuple[int, int], str] = {}
    for r, row in enumerate(rows):
        c = 0
        for cell in (x for x in row if x.tag in ("td", "th")):
            while (r, c) in cells:
                c += 1
            down, across = (max(1, int(v)) if (v := cell.get(k, "1")).strip().isdigit() else 1 for k in ("rowspan", "colspan"))
            for i in range(r, min(r + down, len(rows))):
                for j in range(c, c + across):
                    cells.setdefault((i, j), "")
            cells[r, c] = plain(cell)
            c += across
    width = max((j for _, j in cells), default=-1) + 1
    return [[cells.get((i, j), "") for j in range(width)] for i in range(len(rows))]


def flat_headers(rows: list[list[str]]) -> list[str]:
    """One header a column: its cells from the top, empty and repeated ones left out."""
    out = []
    for column in zip(*rows, strict=True):
        parts: list[str] = []
        for cell in column:
            if cell and (not parts or parts[-1] != cell):
                parts.append(cell)
        out.append(" ".join(parts))
    return out


def markdown(headers: list[str], rows: list[list[str]]) -> str:
    width = max([len(headers), *map(len, rows)], default=0)
    if not width:
        return ""
    line = lambda cells: "| " + " | ".join(c.replace("|", "\\|") for c in [*cells, *[""] * (width - len(cells))]) + " |"
    return "\n".join([line(headers), "|" + " --- |" * width, *map(line, rows)])


class Article:
    """Chunks of one article as they come."""

    def __init__(self, source: bytes, path: str):
        root = ET.fromstring(source)
        for e in root.iter():  # names without their namespace
            if isinstance(e.tag, str):
                e.tag = e.tag.rpartition("}")[2]
        self.path, self.chunks, self.skips, self.counts = path, [], Counter(), Counter()
        ids = {k: next((plain(x) for x in root.iter("article-id") if x.get("pub-id-type") in v), "") for k, v in {"doi": ("doi",), "pmcid": ("pmcid", "pmc")}.items()}
        self.doi, self.title = ids["doi"], plain(next(root.iter("article-title"), None))
        self.paper = ids["pmcid"] or re.sub(r"\.[^.]*$", "", path.rpartition("/")[2])
        body = root.find(".//body")
        if body is None:
            raise ValueError("no <body>")
        self.abstracts(root.find(".//front"))
        self.walk(body, [], None)
        for back in root.iter("back"):
            self.skips.update(x.tag for x in back.iter() if x.tag in SKIPPED)

    def add(self, kind: str, text: str, section: list[str], sec_type: str, **more):
        n = len(self.chunks)
        meta = {"doi": self.doi, "title": self.title, "source_path": self.path, "sec_type": sec_type, "chunk_index": n, "token_count": size_of(text)}
        meta |= dict.fromkeys(("label", "caption", "header_rows", "headers", "rows", "n_rows", "n_cols", "footnotes", "markdown_text")) | more
        self.chunks.append((self.paper, f"{self.paper}::{LETTER[kind]}{n:04d}", kind, text, section, meta))

    def abstracts(self, front):
        for a in front.iter("abstract") if front is not None else ():
            if a.get("abstract-type") in ("graphical", "teaser", "precis"):
                continue
            sections = a.findall("sec")
            for s in sections:
                heading = plain(s.find("title"))
                text = " ".join(filter(None, (plain(p) for p in s.iter("p"))))
                if text:
                    self.add("abstract", text, ["Abstract", *([heading] if heading else [])], "abstract")
            if not sections and (text := " ".join(filter(None, (plain(p) for p in a.iter("p"))))):
                self.add("abstract", text, ["Abstract"], "abstract")

    def walk(self, node, section: list[str], sec_type: str | None):
        """sec_type: of the element that holds the node's children, not of those around it."""
        for e in node:
            if e.tag == "sec":
                heading = plain(e.find("title"))
                self.walk(e, [*section, heading] if heading else section, e.get("sec-type") or None)
            elif e.tag == "p":
                self.paragraph(e, section, sec_type)
            elif e.tag == "table-wrap":
                self.table(e, section, sec_type)
            elif e.tag in INNER:
                self.walk(e, section, None)
            elif e.tag in SKIPPED:
                self.skips[e.tag] += 1

    def paragraph(self, p, section, sec_type):
        for t in list(p.iter("table-wrap")):
            self.table(t, section, sec_type)
        text = " ".join(self.without(p, "table-wrap"))
        if len(text) >= 2 and re.search("[A-Za-z0-9]", text):
            for part in split_paragraph(text):
                self.add("paragraph", part, section, sec_type)

    def without(self, node, tag) -> list[str]:
        """Words of an element but for those in elements of a kind."""
        return [*(node.text or "").split(), *(w for e in node for w in [*([] if e.tag == tag else self.without(e, tag)), *(e.tail or "").split()])]

    def table(self, wrap, section, sec_type):
        label, caption = plain(wrap.find("label")), plain(wrap.find("caption"))
        table = wrap.find(".//table")
        top = [r for h in table.iter("thead") for r in h.iter("tr")] if table is not None else []
        rest = [r for r in table.iter("tr") if r not in top] if table is not None else []
        head, rows = grid(top), grid(rest)
        if not head and rows:
            head, rows = rows[:1], rows[1:]
        headers = flat_headers(head)
        foot = wrap.find(".//table-wrap-foot")
        notes = [t for e in (foot.iter() if foot is not None else ()) if e.tag in ("p", "fn") and (t := plain(e))] or [t for t in [plain(foot)] if t]
        shown = markdown(headers, rows)
        text = "\n".join(filter(None, (". ".join(filter(None, (label, caption))), shown)))
        self.add("table", text, section, sec_type, label=label, caption=caption, header_rows=head, headers=headers, rows=rows, n_rows=len(rows), n_cols=max([len(headers), *map(len, rows)]), footnotes=notes, markdown_text=shown)


def chunks(files: DataFrame) -> DataFrame:
    """files: path, content (binary). ROWs: chunks; and a row without chunk_id for each file, with skip counts or its error."""

    def run(frames):
        for frame in frames:
            out = []
            for path, content in zip(frame["path"], frame["content"], strict=True):
                try:
                    a = Article(bytes(content), path)
                    out += [(path, *c, None, None) for c in a.chunks]
                    out.append((path, a.paper, None, None, None, None, None, dict(a.skips), None))
                except Exception as e:  # noqa: BLE001  a file that cannot be read is a row, not a failed task
                    out.append((path, None, None, None, None, None, None, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=["source_path", "paper_id", "chunk_id", "chunk_type", "text", "section_path", "metadata", "skipped", "error"])

    return files.select("path", "content").mapInPandas(run, ROW)


def read(spark: SparkSession, path: str) -> DataFrame:
    return chunks(spark.read.format("binaryFile").option("pathGlobFilter", "*.{xml,nxml}").load(path))


def skip_counts(rows: DataFrame) -> DataFrame:
    return rows.filter("skipped is not null").select(F.explode("skipped").alias("tag", "n")).groupBy("tag").agg(F.sum("n").alias("n"))
