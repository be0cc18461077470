import json

import pytest
from pyspark.sql import functions as F

from quernstone import cli, models, sinks
from quernstone.sources import config, html_meta, jats, jsonl, wos
from quernstone.streaming import incremental

WOS = """FN X
VR 1.0
PT J
AU Smith, A
   Jones, B
TI A title
   that goes on
AB Text of
   the abstract
DE one; two
   three; four
DI 10.1/x
UT WOS:0001
ER

PT J
TI A title again
DI 10.1/X
ER

PT J
TI No ids here
"""

ARTICLE = """<article xmlns:x="u"><front><article-meta><article-id pub-id-type="pmcid">PMC1</article-id><article-id pub-id-type="doi">10.1/z</article-id><title-group><article-title>On <i>things</i></article-title></title-group>
<abstract><sec><title>Aim</title><p>To see.</p></sec><sec><p>Seen it.</p></sec></abstract><abstract abstract-type="graphical"><p>picture</p></abstract></article-meta></front>
<body><sec sec-type="methods"><title>Methods</title><p>We did it <b>well</b>.<table-wrap><label>Table 1</label><caption><p>Cap</p></caption><table><thead><tr><th rowspan="2">A</th><th colspan="2">B</th></tr><tr><th>x</th><th>y</th></tr></thead><tbody><tr><td>1</td><td>2|3</td><td>4</td></tr></tbody></table><table-wrap-foot><fn><p>note</p></fn></table-wrap-foot></table-wrap> After.</p><sec><p>Deep text.</p></sec></sec>
<boxed-text><p>Boxed text.</p></boxed-text><p>*</p><ack><p>thanks</p></ack></body><back><ref-list/><notes/></back></article>"""


def test_wos(spark, tmp_path):
    (tmp_path / "a.txt").write_text(WOS, encoding="utf-8")
    (tmp_path / "b.txt").write_text("PT J\nTI no IDs here\nER\nEF\n", encoding="utf-8")
    rows = wos.read(spark, str(tmp_path)).orderBy("_pos").collect()
    assert [(r.title, r.paper_id) for r in rows] == [("A title that goes on", "WOS_0001"), ("No ids here", "WOS_TITLE_No_ids_here")]
    r = rows[0]
    assert r.authors == ["Smith", " A", "Jones", " B"] or r.authors == ["Smith, A", "Jones, B"]
    assert r.abstract == "Text of the abstract" and r.keywords == ["one", "two", "three", "four"] and r.doi == "10.1/x" and r.metadata_quality == "external_metadata"


def test_jats(spark, tmp_path):
    (tmp_path / "a.xml").write_text(ARTICLE, encoding="utf-8")
    (tmp_path / "bad.xml").write_text("<article><front/></article>", encoding="utf-8")
    rows = jats.read(spark, str(tmp_path)).collect()
    chunks = sorted((r for r in rows if r.chunk_id), key=lambda r: r.metadata.chunk_index)
    assert [(r.chunk_id, r.chunk_type, r.text if r.chunk_type != "table" else None, r.section_path) for r in chunks] == [
        ("PMC1::a0000", "abstract", "To see.", ["Abstract", "Aim"]), ("PMC1::a0001", "abstract", "Seen it.", ["Abstract"]), ("PMC1::t0002", "table", None, ["Methods"]),
        ("PMC1::p0003", "paragraph", "We did it well . After.", ["Methods"]), ("PMC1::p0004", "paragraph", "Deep text.", ["Methods"]), ("PMC1::p0005", "paragraph", "Boxed text.", []),
    ]
    t = chunks[2].metadata
    assert t.headers == ["A", "B x", "y"] and t.rows == [["1", "2|3", "4"]] and t.footnotes == ["note", "note"] and t.n_cols == 3 and t.sec_type == "methods" and chunks[4].metadata.sec_type is None and "2\\|3" in t.markdown_text
    assert t.header_rows == [["A", "B", ""], ["", "x", "y"]] and chunks[2].text.startswith("Table 1. Cap\n|")
    assert {r.tag: r.n for r in jats.skip_counts(jats.read(spark, str(tmp_path))).collect()} == {"ack": 1, "ref-list": 1, "notes": 1}
    assert [r.error for r in rows if r.error] == ["ValueError: no <body>"]


def test_page_trees_go_with_their_page(spark):
    """No tree waits for the garbage collector, whatever the number of pages in a batch."""
    import gc

    trees = lambda: sum(isinstance(x, html_meta.Node) for x in gc.get_objects())
    gc.collect()
    before = trees()
    gc.disable()
    try:
        for _ in range(50):
            html_meta.of_html("<title>T</title><p>x<b>y</b></p>")
        assert trees() == before
    finally:
        gc.enable()
    rows = spark.createDataFrame([(1, "u", "<title>A page</title>"), (2, None, None)], "id long, url string, html string")
    assert [tuple(r) for r in html_meta.titles(rows, keep=["id"]).orderBy("id").collect()] == [(1, "A page", "", "", ""), (2, "", "", "", "")]
    assert [tuple(r) for r in html_meta.titles(rows).orderBy("id").collect()] == [(1, "u", "<title>A page</title>", "A page", "", "", ""), (2, None, None, "", "", "", "")]


def test_html_metadata(spark, tmp_path):
    long = "This is a long enough paragraph of the article that tells what was found in it, at last. " * 2
    (tmp_path / "a.html").write_text(f'<meta name="citation_title" content="T1"><meta name="citation_doi" content="doi: 10.1/a"><div class="abstract">{long}</div>', encoding="utf-8")
    (tmp_path / "b.html").write_text(f"<title>Name of it | Some Site</title><nav><p>{long}</p></nav><p>{long}<p>short", encoding="utf-8")
    (tmp_path / "c.pdf").write_bytes(b"%PDF")
    got = {r.source_file: r for r in html_meta.read(spark, str(tmp_path)).collect()}
    assert (got["a.html"].title, got["a.html"].doi, got["a.html"].metadata_quality, got["a.html"].abstract) == ("T1", "10.1/a", "html_abstract", long.strip())
    assert (got["b.html"].title, got["b.html"].metadata_quality, got["b.html"].text_for_filter) == ("Name of it", "html_front_matter", long.strip())
    assert got["c.pdf"].error == "PDF is not supported"


def test_jsonl_keeps_nulls(spark, tmp_path):
    rows = spark.createDataFrame([("a", None), ("é", 1)], "x string, y int")
    jsonl.write(rows.coalesce(1), str(tmp_path / "t"))
    lines = [json.loads(x) for p in (tmp_path / "t").glob("part-*") for x in p.read_text(encoding="utf-8").splitlines()]
    assert lines == [{"x": "a", "y": None}, {"x": "é", "y": 1}]
    assert jsonl.read(spark, str(tmp_path / "none"), "x string", optional=True).count() == 0
    assert jsonl.read(spark, str(tmp_path / "t"), "x string, y int").orderBy("_pos").count() == 2


def test_csv_has_mark(spark, tmp_path):
    rows = spark.createDataFrame([("p", "r", "a,b", ["c1", "c2"])], "paper_id string, record_id string, f string, source_chunk_ids array<string>")
    sinks.write_csv(rows.coalesce(1), str(tmp_path / "c"), ["f"], [])
    (part,) = (tmp_path / "c").glob("part-*")
    assert part.read_bytes().startswith(b"\xef\xbb\xbfpaper_id,record_id,f,source_chunk_ids\n") and b'"a,b"' in part.read_bytes()


def test_upsert(spark, tmp_path):
    path = str(tmp_path / "v")
    row = lambda *ids: spark.createDataFrame([(i,) for i in ids], "chunk_id string")
    assert sinks.upsert_new(row("a", "b"), path).count() == 2
    sinks.upsert_new(row("b", "c"), path)
    assert sorted(r.chunk_id for r in spark.read.parquet(path).collect()) == ["a", "b", "c"]


def test_stream_batches_equal_one(spark, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    step = lambda rows: rows.groupBy("paper_id").count()
    for k, papers in enumerate([["a", "a"], ["b"]]):
        (source / f"{k}.json").write_text("".join(json.dumps({"paper_id": p}) + "\n" for p in papers), encoding="utf-8")
        incremental.run_available(spark, str(source), "paper_id string", step, target, str(tmp_path / "state")).awaitTermination()
    assert {r.paper_id: r["count"] for r in spark.read.parquet(target).collect()} == {"a": 2, "b": 1}


def test_backends(spark):
    assert models.hash_embedding("a b") == models.hash_embedding("b a") and len(models.hash_embedding("")) == 64
    def down(_c, _f):
        raise TimeoutError

    rows = spark.createDataFrame([("p", "[CHUNK c | x]\nbody"), ("q", None)], "paper_id string, context string")
    got = {r.paper_id: (r.status, r.f) for r in models.extract(rows, ["f"]).collect()}
    assert got == {"p": ("ok", "body"), "q": ("skipped:no_context", None)}
    assert {r.status for r in models.extract(rows.filter("paper_id = 'p'"), ["f"], down, ("a", "b")).collect()} == {"failed:TimeoutError"}
    assert models.as_text(2959) == "2959" and models.as_text([1]) == "[1]"


def test_second_tries():
    parts = [{"chunk_type": "abstract", "rendered": "A"}, *({"chunk_type": "paragraph", "rendered": f"p{k}"} for k in range(7))]
    seen = []

    def limited(context, fields, mode):
        seen.append((mode, context.split("\n\n")))
        if mode == "strict":
            raise ValueError
        if len(seen[-1][1]) > 4:
            raise TimeoutError
        return [{"f": x} for x in seen[-1][1][1:]], "ok"

    call = lambda text: models.in_modes(limited, text, ["f"], ("strict", "plain"))
    assert call("A\n\np1") == ([{"f": "p1"}], "ok") and [m for m, _ in seen] == ["strict", "plain"]
    rows, status = models.in_batches(call, parts)
    assert [r["f"] for r in rows] == [f"p{k}" for k in range(7)] and status == "ok:split_retry:2_batches"
    assert models.in_batches(lambda _: ([], "failed:TimeoutError"), parts) is None
    few = lambda text: ([{"f": text}], "ok") if text.endswith("p6") else ([], "failed:TimeoutError")
    assert models.in_batches(few, parts)[1] == "ok:split_retry_partial:2_batches:5_failed"


def run(spark, *args):
    a = cli.parser().parse_args([str(x) for x in args])
    a.run(spark, a)
    return a


def jsonl_rows(spark, path):
    return [r.asDict(recursive=True) for r in spark.read.json(str(path)).collect()]


def test_runs_go_on_where_the_last_one_ended(spark, tmp_path):
    """Every stage twice: first one paper, then the others; what there was stays."""
    out, xml = tmp_path / "out", tmp_path / "xml"
    xml.mkdir()
    for k in (1, 2, 3):
        (xml / f"PMC{k}.xml").write_text(ARTICLE.replace("PMC1", f"PMC{k}"), encoding="utf-8")
    papers = [{"paper_id": f"PMC{k}", "title": f"On things {k}", "text_for_filter": "things", "pmcid": f"PMC{k}", "file_type": "metadata"} for k in (1, 2, 3)] + [{"paper_id": "X", "title": "On nothing", "file_type": "metadata"}]
    (tmp_path / "papers.json").write_text("".join(json.dumps(p) + "\n" for p in papers), encoding="utf-8")
    (tmp_path / "r.yaml").write_text(REQUIREMENTS, encoding="utf-8")
    (tmp_path / "presets" / "demo").mkdir(parents=True)
    (tmp_path / "presets" / "demo" / "labeling_config.yaml").write_text(LABELING, encoding="utf-8")
    (tmp_path / "presets" / "demo" / "paper_filter.yaml").write_text("criteria: [{name: c, uncertain_policy: reject}]\nkeywords: {c: [things]}\n", encoding="utf-8")
    preset = ["--project", "demo", "--preset-dir", tmp_path / "presets", "--output", out]

    for more in (["--limit", 1], []):
        run(spark, "filter", "--metadata", tmp_path / "papers.json", *preset, *more)
    results = {r["paper_id"]: r["decision"] for r in jsonl_rows(spark, out / "filter_results")}
    assert results == {"PMC1": "pass", "PMC2": "pass", "PMC3": "pass", "X": "reject"}
    assert sorted(r["paper_id"] for r in jsonl_rows(spark, out / "passed")) == ["PMC1", "PMC2", "PMC3"]
    (counts,) = jsonl_rows(spark, out / "summary")
    assert (counts["total"], counts["passed"], counts["rejected"]) == (4, 3, 1)

    for more in (["--limit", 1], []):
        run(spark, "acquire", "--passed", out / "passed", "--fulltext-dir", xml, "--output", out, *more)
    assert {r["paper_id"]: r["status"] for r in jsonl_rows(spark, out / "acquisition")} == {f"PMC{k}": "downloaded" for k in (1, 2, 3)}
    for more in (["--limit", 1], []):
        run(spark, "preprocess", "--passed", out / "acquisition", "--output", out, *more)
    assert {r["paper_id"] for r in jsonl_rows(spark, out / "parsed_chunks")} == {"PMC1", "PMC2", "PMC3"}
    for more in (["--limit", 1], []):
        run(spark, "label", "--chunks", out / "parsed_chunks", *preset, *more)
    assert {r["paper_id"] for r in jsonl_rows(spark, out / "labeled_chunks")} == {"PMC1", "PMC2", "PMC3"}

    extract = ["extract", "--requirements", tmp_path / "r.yaml", "--chunks", out / "parsed_chunks", "--labels", out / "labeled_chunks", "--output", out]
    run(spark, *extract, "--limit", 1)
    assert {r["paper_id"] for r in jsonl_rows(spark, out / "extracted_records")} == {"PMC1"}

    def down(context, fields):
        raise ConnectionError

    a = cli.parser().parse_args([str(x) for x in [*extract, "--checkpoint-every", 1]])
    cli.extract(spark, a, down)  # nothing new comes, what there was stays
    assert {r["paper_id"] for r in jsonl_rows(spark, out / "extracted_records")} == {"PMC1"}
    status = {r["paper_id"]: r["status"] for r in jsonl_rows(spark, out / "extraction_status")}
    assert status == {"PMC1": "ok", "PMC2": "failed:ConnectionError", "PMC3": "failed:ConnectionError"}
    run(spark, *extract)  # failed ones come again
    run(spark, *extract)  # nothing is left to do
    records_ = jsonl_rows(spark, out / "extracted_records")
    assert sorted(r["record_id"] for r in records_) == [f"PMC{k}::r0001" for k in (1, 2, 3)]
    (total,) = jsonl_rows(spark, out / "extraction_summary")
    assert (total["total_records_extracted"], total["total_papers_failed"], total["processed_this_run"], total["skipped_existing"]) == (3, 0, 0, 3)
    run(spark, *extract, "--paper-id", "PMC2")
    assert len(jsonl_rows(spark, out / "extracted_records")) == 3
    with pytest.raises(SystemExit, match="PMC9"):
        run(spark, *extract, "--paper-id", "PMC9")


def test_drafts_and_lookups(spark, tmp_path):
    spec = config.requirements_of("alloys", "yield_strength,phase", {"yield_strength": "stress at which it yields", "phase": "crystal phase"})
    fields = config.labeling(config.draft_labeling(spec))
    assert [f.name for f in fields] == ["yield_strength", "phase"] and fields[0].keywords == ["yield", "strength"] and "\\bstress" in fields[0].patterns["other"]
    assert [c.name for c in config.criteria(config.draft_filter(spec))] == ["in_domain", "reports_record"]

    def fetch(pmcid):
        if pmcid == "PMC3":
            raise OSError
        return b"<x/>" if pmcid == "PMC2" else None

    rows = spark.createDataFrame([("a", "", "/f/a.xml"), ("b", "2", None), ("c", "PMC3", None), ("d", "4", ""), ("e", None, None)], "paper_id string, pmcid string, source_path string").withColumn("reason", F.lit(""))
    got = {r.paper_id: (r.status, r.pmcid, r.content) for r in config.looked_up(rows, config.Lookup(fetch=fetch)).collect()}
    assert {k: v[0] for k, v in got.items()} == {"a": "already_exists", "b": "downloaded", "c": "error", "d": "unavailable", "e": "no_pmcid"} and got["b"][1:] == ("PMC2", b"<x/>")


def test_confirmation(spark):
    field = config.labeling({"fields": [{"field_name": "v", "patterns": {"strong": ["did"]}, "llm_binary_confirm": True}, {"field_name": "w"}]})
    evidence = spark.createDataFrame([("p", "v", "a"), ("p", "v", "b"), ("p", "w", "b")], "paper_id string, field string, chunk_id string")
    chunks = spark.createDataFrame([("a", "we did it"), ("b", "no")], "chunk_id string, text string")
    kept = lambda **k: sorted((r.field, r.chunk_id) for r in models.confirm(evidence, chunks, field, **k).collect())
    assert kept() == [("v", "a"), ("w", "b")] and len(kept(judge=lambda rows, _: F.lit(None).cast("boolean"))) == 3


REQUIREMENTS = """project_name: demo
domain_description: things
record: {name: finding, meaning: a finding, fields: [{name: value, definition: the value, type: number}, {name: what, definition: what it is}]}
"""
LABELING = "fields: [{field_name: value, patterns: {strong: ['did']}, table_header_keywords: [a]}]\n"


def test_whole_pipeline(spark, tmp_path):
    (tmp_path / "xml").mkdir()
    (tmp_path / "xml" / "PMC1.xml").write_text(ARTICLE, encoding="utf-8")
    (tmp_path / "r.yaml").write_text(REQUIREMENTS, encoding="utf-8")
    (tmp_path / "l.yaml").write_text(LABELING, encoding="utf-8")
    out = tmp_path / "out"
    args = ["pipeline", "--xml", str(tmp_path / "xml"), "--requirements", str(tmp_path / "r.yaml"), "--labeling-config", str(tmp_path / "l.yaml"), "--output", str(out)]
    a = cli.parser().parse_args(args)
    a.run(spark, a)
    assert spark.read.json(str(out / "parsed_chunks")).count() == 6
    assert spark.read.json(str(out / "labeled_chunks")).count() >= 1
    (record,) = spark.read.json(str(out / "final_records")).collect()
    assert record.value == "To see." and record.record_id == "PMC1::r0001"
    spec = config.requirements(tmp_path / "r.yaml")
    assert config.post({}, spec).numeric == {"value": {}} and "value (number)" in config.instruction(spec)
    assert config.resolve("x.yaml", "p", folder=tmp_path) is None
