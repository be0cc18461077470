"""Light metadata of article files: HTML pages and article XML, a file a row, read by the standard library in batches. Errors are rows."""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import bounded_batches

SCHEMA = "source_path string, source_file string, file_type string, paper_id string, title string, abstract string, text_for_filter string, doi string, pmcid string, abstract_available boolean, front_matter_used boolean, metadata_quality string, error string"
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
ASIDE = {"nav", "header", "footer", "script", "style", "aside"}
HEADINGS = ["h1", "h2", "h3", "h4"]


def file_type():
    """Column: xml, html, pdf, txt or unknown, by the suffix of `path`."""
    suffix = F.lower(F.regexp_extract("path", r"\.(\w+)$", 1))
    return F.when(suffix.isin("xml", "nxml"), "xml").when(suffix.isin("html", "htm"), "html").when(suffix == "pdf", "pdf").when(suffix == "txt", "txt").otherwise("unknown")


class Node:
    def __init__(self, tag: str, attrs: dict[str, str], up: Node | None):
        self.tag, self.attrs, self.up, self.parts = tag, attrs, up, []

    def walk(self):
        yield self
        for p in self.parts:
            if isinstance(p, Node):
                yield from p.walk()

    def text(self, skip=frozenset({"script", "style"})) -> str:
        if self.tag in skip:
            return ""
        return " ".join(" ".join(p if isinstance(p, str) else p.text(skip) for p in self.parts).split())


class Tree(HTMLParser):
    """Our own rules for tag soup: a paragraph ends where the next block starts, an end tag closes up to its element, an unmatched one is ignored."""

    BLOCKS = {"p", "div", "article", "section", "ul", "ol", "table", "h1", "h2", "h3", "h4", "h5", "h6", "nav", "header", "footer", "aside", "form"}

    def __init__(self, source: str):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", {}, None)
        self.feed(source)
        self.close()

    def handle_starttag(self, tag, attrs):
        if tag in self.BLOCKS:
            node = self.at
            while node.up and node.tag not in self.BLOCKS:
                node = node.up
            if node.tag == "p":
                self.at = node.up
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.parts.append(node)
        if tag not in VOID:
            self.at = node

    def handle_endtag(self, tag):
        node = self.at
        while node.up and node.tag != tag:
            node = node.up
        if node.up:
            self.at = node.up

    def handle_data(self, data):
        self.at.parts.append(data)


class Page:
    """A page as a tree, to be used in `with`: elements know the one around them, so a tree left alone stays until the garbage collector comes by."""

    def __enter__(self) -> Page:
        return self

    def __exit__(self, *_):
        for n in self.nodes:
            n.up, n.parts = None, []

    def __init__(self, source: str):
        self.root = Tree(source).root
        self.nodes = list(self.root.walk())
        self.metas = [(m.attrs.get("name") or m.attrs.get("property") or "", " ".join(m.attrs.get("content", "").split())) for m in self.nodes if m.tag == "meta"]

    def meta(self, *names: str) -> str:
        return next((c for n in names for k, c in self.metas if k == n and c), "")

    def first(self, tag: str) -> str:
        return next((t for n in self.nodes if n.tag == tag and (t := n.text())), "")

    def title(self) -> str:
        """Citation meta, then og:title, a heading marked as the article's title, the page title without a site's name."""
        if got := self.meta("citation_title", "dc.title", "DC.title") or self.meta("og:title"):
            return got
        for n in self.nodes:
            if n.tag in HEADINGS[:3] and re.search(r"article[-_]?title|headline", f"{n.attrs.get('class', '')} {n.attrs.get('id', '')}", re.I) and n.text():
                return n.text()
        return re.sub(r"\s*[|\-–—]\s*[^|\-–—]{4,}$", "", self.first("title")).strip()

    def abstract(self) -> str:
        """Citation meta, a long description, an element named abstract, or what follows a heading Abstract or Summary."""
        if got := self.meta("citation_abstract"):
            return got
        if got := next((c for n in ("description", "og:description", "dc.description", "DC.description") for k, c in self.metas if k == n and len(c) > 100), ""):
            return got
        for n in self.nodes:
            if re.search(r"\babstract\b", " ".join(n.attrs.get(k, "") for k in ("class", "id", "name")), re.I) and n.tag != "meta" and len(t := n.text()) > 80:
                return t[:3000]
        for n in self.nodes:
            if n.tag in HEADINGS and n.up and n.text().lower().strip(" :") in ("abstract", "summary"):
                at, parts, size = n.up.parts.index(n) + 1, [], 0
                for x in n.up.parts[at:]:
                    if isinstance(x, Node) and x.tag in HEADINGS or size > 2000:
                        break
                    t = " ".join(x.split()) if isinstance(x, str) else x.text()
                    parts, size = [*parts, t] if t else parts, size + len(t)
                if len(got := " ".join(parts)) > 80:
                    return got[:3000]
        return ""

    def front_matter(self) -> str:
        """Up to five paragraphs of 80 characters or more outside page furniture, 2000 characters in all."""
        out: list[str] = []
        for n in self.nodes:
            up = n
            while up and up.tag not in ASIDE:
                up = up.up
            if n.tag == "p" and not up and len(t := n.text()) >= 80:
                out.append(t)
                if len(out) == 5 or sum(map(len, out)) >= 2000:
                    break
        return " ".join(out)[:2000]

    def doi(self) -> str:
        return re.sub(r"^\s*doi:\s*", "", self.meta("citation_doi", "dc.identifier", "DC.identifier"), flags=re.I).strip()


def of_html(source: str) -> dict:
    with Page(source) as page:
        title, abstract, doi = page.title(), page.abstract(), page.doi()
        front = "" if abstract else page.front_matter()
    quality = "html_abstract" if abstract else "html_front_matter" if front else "title_only" if title else "parse_error"
    return {"title": title, "abstract": abstract, "text_for_filter": abstract or front, "doi": doi, "pmcid": "", "abstract_available": bool(abstract), "front_matter_used": bool(front), "metadata_quality": quality}


def of_xml(source: bytes) -> dict:
    root = ET.fromstring(source)
    for e in root.iter():
        if isinstance(e.tag, str):
            e.tag = e.tag.rpartition("}")[2]
    text = lambda e: " ".join("".join(e.itertext()).split()) if e is not None else ""
    ids = {kind: next((text(x) for x in root.iter("article-id") if x.get("pub-id-type") in kinds), "") for kind, kinds in {"doi": ("doi",), "pmcid": ("pmcid", "pmc")}.items()}
    title = text(next(root.iter("article-title"), None))
    abstract = " ".join(filter(None, (text(p) for f in root.iter("front") for a in f.iter("abstract") for p in a.iter("p"))))
    quality = "structured_xml" if abstract else "title_only" if title else "parse_error"
    return {"title": title, "abstract": abstract, "text_for_filter": abstract, **ids, "abstract_available": bool(abstract), "front_matter_used": False, "metadata_quality": quality}


def light(files: DataFrame) -> DataFrame:
    """files: path, content (binary)."""
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    empty = {"title": "", "abstract": "", "text_for_filter": "", "doi": "", "pmcid": "", "abstract_available": False, "front_matter_used": False, "metadata_quality": "parse_error"}

    def one(path, kind, content):
        file = re.split(r"[/\\]", path)[-1]
        row = {"source_path": path, "source_file": file, "file_type": kind, "error": None} | empty
        try:
            if kind == "xml":
                row |= of_xml(bytes(content))
            elif kind == "html":
                row |= of_html(bytes(content).decode("utf-8", "replace"))
            else:
                row["error"] = "PDF is not supported" if kind == "pdf" else "Unsupported file type"
        except Exception as e:  # noqa: BLE001  a file that cannot be read is a row
            row["error"] = f"{type(e).__name__}: {e}"
        return row | {"paper_id": row["pmcid"] or re.sub(r"\.[^.]*$", "", file)}

    def run(frames):
        for f in frames:
            yield pd.DataFrame([one(*r) for r in zip(f["path"], f["kind"], f["content"], strict=True)], columns=names)

    bounded_batches(files.sparkSession)
    return files.select("path", file_type().alias("kind"), "content").mapInPandas(run, SCHEMA)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """The article files of a folder (not below it); PDFs give an error row."""
    return light(spark.read.format("binaryFile").option("pathGlobFilter", "*.{xml,nxml,html,htm,pdf}").load(folder))


def titles(pages: DataFrame, column: str = "html", keep: list[str] | None = None) -> DataFrame:
    """pages with title, abstract, front_matter and doi of the html in a column. keep: the columns that stay, all by default. One page's tree is held at a time."""
    keep, new = pages.columns if keep is None else keep, ["title", "abstract", "front_matter", "doi"]

    def one(source: str | None) -> tuple[str, str, str, str]:
        with Page(source or "") as p:
            return p.title(), p.abstract(), p.front_matter(), p.doi()

    def run(batches):
        for b in batches:
            got = [one(x.as_py()) for x in b.column(column)]
            yield pa.RecordBatch.from_arrays([*map(b.column, keep), *(pa.array([x[k] for x in got], pa.string()) for k in range(len(new)))], [*keep, *new])

    bounded_batches(pages.sparkSession)
    schema = pages.select(*keep).limit(0).withColumns({c: F.lit("") for c in new}).schema
    return pages.select(*dict.fromkeys([*keep, column])).mapInArrow(run, schema)
