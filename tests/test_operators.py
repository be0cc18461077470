import json

from pyspark.sql import functions as F

from quernstone.operators import context, identity, records, retrieve, screening, summaries


def test_section_pools(spark):
    rows = spark.createDataFrame([(k, s) for k, s in enumerate(["Results", "Methods", "References", "Funding", "Introduction", "Discussion"])], "k int, s string")
    got = [r.p for r in rows.orderBy("k").select(retrieve.pool(F.col("s"), ["results"], []).alias("p")).collect()]
    assert got == ["preferred", "fallback", "excluded", "excluded", "fallback", "fallback"]


def test_fusion_order(spark):
    rows = [("p", "f", "c1", "semantic", 0, 0), ("p", "f", "c2", "semantic", 0, 1), ("p", "f", "c2", "regex", 1, 0), ("p", "f", "c3", "regex", 1, 1)]
    out = retrieve.fuse(spark.createDataFrame(rows, "paper_id string, field string, chunk_id string, source string, list_ord int, rank int"), ["paper_id", "field"], 5).orderBy("hybrid_rank").collect()
    assert [r.chunk_id for r in out] == ["c2", "c1", "c3"]
    assert abs(out[0].rrf_score - (1 / 62 + 1 / 61)) < 1e-12
    assert out[0].ranks == {"semantic": 1, "regex": 0}


def tables(n):
    return [("p", f"t{k}", k, "table", f"table {k}", ["Results"], "yield strength" if k in (2, 3) else "", ["a"]) for k in range(n)]


SCHEMA = "paper_id string, chunk_id string, chunk_index int, chunk_type string, text string, section_path array<string>, caption string, headers array<string>"


def test_few_and_many_tables(spark):
    f = retrieve.Field("f", {"other": ["table"]}, ["yield"], confirm=True)
    few = retrieve.label_evidence(spark.createDataFrame(tables(3), SCHEMA), [f]).orderBy("hybrid_rank").collect()
    assert [r.chunk_id for r in few] == ["t2", "t0", "t1"]
    many = retrieve.label_evidence(spark.createDataFrame(tables(8), SCHEMA), [f]).orderBy("hybrid_rank").collect()
    assert len(many) == 5 and {r.chunk_id for r in many[:2]} == {"t2", "t3"}


def test_unsignalled_tables_follow_for_confirmation(spark):
    f = retrieve.Field("f", {}, ["yield"], confirm=True)
    got = retrieve.label_evidence(spark.createDataFrame(tables(4), SCHEMA), [f]).orderBy("hybrid_rank").collect()
    assert [(r.chunk_id, r.sources) for r in got] == [("t2", ["table_header"]), ("t3", ["table_header"]), ("t0", ["table_all"]), ("t1", ["table_all"])]


def test_vector_pool_falls_back(spark):
    rows = [("p", f"c{k}", k, "paragraph", "x", ["Results"] if k < 2 else ["Other"], "", []) for k in range(6)]
    near = spark.createDataFrame([("p", "f", f"c{k}", float(k)) for k in range(6)], "paper_id string, field string, chunk_id string, distance double")
    enough = retrieve.label_evidence(spark.createDataFrame(rows, SCHEMA), [retrieve.Field("f", include=["results"], text_top_k=2)], near)
    assert sorted(r.chunk_id for r in enough.collect()) == ["c0", "c1"]
    short = retrieve.label_evidence(spark.createDataFrame(rows, SCHEMA), [retrieve.Field("f", include=["results"], text_top_k=3)], near)
    assert sorted(r.chunk_id for r in short.collect()) == ["c0", "c1", "c2"]


def test_labels_in_configured_order(spark):
    fields = [retrieve.Field("b"), retrieve.Field("a")]
    found = spark.createDataFrame([("p", "c1", x) for x in ("a", "b", "z", "a")] + [("p", "gone", "a")], "paper_id string, chunk_id string, field string")
    chunks = spark.createDataFrame([("p", "c1", 3, "table", "", ["R"], "", [])], SCHEMA)
    got = {r.chunk_id: r for r in retrieve.label_chunks(found, chunks, fields).collect()}
    assert got["c1"].labels == ["b", "a", "z"] and got["gone"].section_path == [] and got["gone"].chunk_index is None
    assert len(got["c1"].__fields__) == 6
    labeled = retrieve.label_chunks(found, chunks, fields)
    assert summaries.labeling_summary(labeled).first().total_assignments == 4
    assert {r.field: r.papers for r in summaries.labels_by_field(labeled).collect()}["a"] == {"p": 2}


def test_context_budget(spark):
    rows = [("p", "a1", 5, 1, 150), ("p", "n1", 1, 2, 40), ("p", "n2", 2, 2, 100), ("p", "n3", 3, 2, 5), ("p", "l1", 4, 3, 10), ("p", "l2", 6, 3, 50)]
    got = context.budgeted(spark.createDataFrame(rows, "paper_id string, chunk_id string, chunk_index int, step int, n_chars int"), 200).orderBy("context_order").collect()
    assert [r.chunk_id for r in got] == ["a1", "n1", "l1"]  # n3 would fit, but comes after the first overflow


def test_numeric_evidence(spark):
    rows = [("p", "c0", 0, "paragraph", "IC50 was 5 nM", ["Results"]), ("p", "c1", 1, "table", "AUC 12 ng/mL and 3 h", ["Methods"]), ("p", "c2", 2, "paragraph", "nothing", ["Results"])]
    got = context.numeric_evidence(spark.createDataFrame(rows, "paper_id string, chunk_id string, chunk_index int, chunk_type string, text string, section_path array<string>")).orderBy("rank").collect()
    assert [(r.chunk_id, r.score) for r in got] == [("c0", 1 + 5 + 4 + 0.75), ("c1", 1 + 4 - 4 + 1.5)]


def test_attribution(spark):
    used = spark.createDataFrame([("p", "a1", 1, "abstract with nothing"), ("p", "p2", 2, "median OS 12.5 months"), ("p", "p3", 3, "other")], "paper_id string, chunk_id string, context_order int, text string")
    rows = spark.createDataFrame([("p", "r1", "12.5", "OS"), ("p", "r2", "none", None)], "paper_id string, record_id string, value string, endpoint string")
    got = {r.record_id: r.source_chunk_ids for r in context.attribute(rows, used, ["value", "endpoint"], 2).collect()}
    assert got == {"r1": ["p2"], "r2": ["a1", "p2"]}


def test_cleanup_and_numbers(spark):
    rows = spark.createDataFrame([("p", " A  b", None, 0), ("p", "a B", None, 1), ("p", "a b", "x", 2)], "paper_id string, f string, g string, _pos int")
    got = records.number_records(records.clean_records(rows, ["f", "g", "h"])).orderBy("_pos").collect()
    assert [(r.f, r.g, r.h, r.record_id) for r in got] == [(" A  b", None, None, "p::r0001"), ("a b", "x", None, "p::r0002")]


def test_constraint(spark):
    c = records.EndpointConstraint.of({"mode": "strict", "by_record_type": {"clinical outcome": ["OS"], "pk": ["Cmax"]}, "aliases": {"OS": ["overall survival"]}})
    rows = spark.createDataFrame([("clinical_outcome", "Overall-Survival"), ("clinical_outcome", "clearance"), ("PK", "cmax"), (None, "OS"), ("pk", None)], "record_type string, endpoint string")
    assert sorted(r.endpoint for r in c.apply(rows).collect()) == ["Cmax", "OS"]
    assert {r.combo: r.n for r in c.rejected(rows).collect()} == {"clinical_outcome | clearance": 1, "None | OS": 1, "pk | None": 1}
    assert records.EndpointConstraint.of({"mode": "off"}) is None


def test_terms(spark):
    terms = {"FCC": ["face-centered cubic"], "BCC": ["body-centered cubic"], "first-line": ["1L"], "clearance": ["CL"]}
    see = lambda v, **k: spark.range(1).select(records.standard_terms(F.lit(v), terms, **k).alias("x")).first().x
    assert see("face-centered cubic + BCC", multiple=True) == "FCC; BCC"
    assert see("1L therapy") == "first-line" and see("1L therapy", match="exact") == "1L therapy"
    assert see("cell cycle arrest") == "cell cycle arrest" and see("CL") == "clearance" and see(None) is None


def test_postprocess(spark):
    rows = spark.createDataFrame([("p", "r1", "200-300 MPa", "alpha", ["c1"], 0), ("p", "r2", "200 - 300 MPa", "Alpha ", ["c2", "c1"], 1), ("p", "r3", "n/a", "", ["c3"], 2)], "paper_id string, record_id string, v string, n string, source_chunk_ids array<string>, _pos int")
    config = records.PostConfig(numeric={"v": {"unit": "GPa"}})
    got = records.postprocess(rows, ["v", "n"], config).collect()
    assert [(r.record_id, r.source_chunk_ids, r.v_norm.value, r.v_norm.unit) for r in got] == [("r1", ["c1", "c2"], 0.25, "GPa")]
    s = records.postprocess_summary(rows, ["v", "n"], config).first()
    assert (s.records_input, s.records_output, s.invalid_removed, s.duplicates_removed) == (3, 1, 1, 1)
    strict = records.PostConfig(numeric={"v": {"integer": True}}, required_all=["n"], required_numeric_all=["v"])
    assert records.postprocess_summary(rows, ["v", "n"], strict).first().invalid_removed == 1
    flat = records.csv_rows(records.postprocess(rows, ["v", "n"], config), ["v", "n"], ["v"]).first()
    assert flat.v_unit == "GPa" and flat.v_error == "" and flat.source_chunk_ids == "c1;c2"


def test_screening(spark):
    some = [screening.Criterion("a", uncertain_policy="reject"), screening.Criterion("b"), screening.Criterion("c", required=False)]
    said = [{"a": "true", "b": "uncertain"}, {"a": "uncertain", "b": "true"}, {"a": "TRUE", "b": "false"}, {"a": "true"}]
    rows = spark.createDataFrame([(k, "t", "x", "ok", json.dumps({n: {"answer": v, "reason": "r"} for n, v in s.items()})) for k, s in enumerate(said)] + [(4, "t", "x", "ok", "no json"), (5, "", "", "ok", None), (6, "", "", "parse_error", None)], "k int, title string, text_for_filter string, metadata_quality string, raw string")
    got = {r.k: (r.decision, r.reason) for r in screening.screen(rows, some, lambda _: F.col("raw")).collect()}
    assert [got[k][0] for k in range(7)] == ["pass", "reject", "reject", "pass", "pass", "pass", "error"]
    assert got[2][1] == "b=false: r"
    counts = screening.decision_counts(screening.screen(rows, some, lambda _: F.col("raw"))).first()
    assert (counts.total, counts.passed, counts.rejected, counts.error) == (7, 4, 2, 1)
    passed, rejected = screening.outputs(screening.screen(rows, some, lambda _: F.col("raw")))
    assert len(passed.columns) == 12 and len(rejected.columns) == 9


def test_candidates(spark):
    rows = spark.createDataFrame([(" T ", "A", None, None, None), ("", "", None, None, None), ("x", None, "W1", "5", None)], "title string, abstract string, wos_uid string, pmid string, doi string")
    got = screening.candidate(rows).collect()
    assert [(r.title, r.text_for_filter, r.paper_id, r.metadata_quality) for r in got] == [("T", "A", "T", "external_metadata"), ("", "", "unknown", "parse_error"), ("x", "", "W1", "external_metadata")]


def test_identity(spark):
    kind = "_pos int, paper_id string, doi string, source_path string, file_type string"
    rows = spark.createDataFrame([(0, "a", "d1", "/x/a.xml", "xml"), (1, "b", "", "/x/b.xml", "xml"), (2, "c", None, "/x/all.txt", "metadata"), (3, "e", None, "/x/all.txt", "metadata")], kind)
    done = spark.createDataFrame([(0, "d1", "", "", "xml"), (1, "", "", "/other/b.xml", "xml"), (2, "c", "", "/x/all.txt", "metadata")], kind)
    assert [r._pos for r in identity.pending(rows, done).collect()] == [3]
    assert [r._pos for r in identity.limited(rows, 2).collect()] == [0, 1] and identity.limited(rows, 0).count() == 4
    old = spark.createDataFrame([("a", 1), ("b", 1)], "paper_id string, n int")
    assert sorted(map(tuple, identity.replace_by_key(old, spark.createDataFrame([("b", 2)], old.schema)).collect())) == [("a", 1), ("b", 2)]
    status = spark.createDataFrame([("a", "ok:split_retry"), ("b", "failed:X"), ("c", "skipped:no_context")], "paper_id string, status string")
    assert [r.paper_id for r in identity.unfinished(rows.select("paper_id"), status).orderBy("paper_id").collect()] == ["b", "e"]
    got = identity.dedupe_acquired(spark.createDataFrame([(0, "a", "d"), (1, "a", "d"), (2, "", ""), (3, None, None)], "_pos int, paper_id string, doi string"))
    assert sorted(r._pos for r in got.collect()) == [0, 2, 3]


def plan(rows):
    return rows._jdf.queryExecution().optimizedPlan().toString(), rows._jdf.queryExecution().executedPlan().toString()


def test_merging_sends_rows_once(spark):
    """A key's rows are merged by one sort of their paper, not by aggregates that hold whole records."""
    rows = spark.createDataFrame([("p", "r1", "5", ["c2"], 1), ("p", "r2", "5", ["c1"], 0), ("p", "r3", "6", ["c3"], 2), ("q", "r4", "5", ["c4", "c4"], 3)], "paper_id string, record_id string, f string, source_chunk_ids array<string>, _pos int")
    merged = records.merge_duplicates(rows, ["f"])
    assert plan(merged)[1].count("Exchange") == 1 and "Aggregate" not in plan(merged)[1]
    assert sorted((r.record_id, r.source_chunk_ids) for r in merged.collect()) == [("r2", ["c1", "c2"]), ("r3", ["c3"]), ("r4", ["c4"])]


def test_labeling_reads_and_sends_chunks_once(spark):
    rows = [("p", f"c{k}", k, "table" if k % 3 == 2 else "paragraph", "a table", ["Results"] if k < 4 else ["Other"], "yield", ["a"]) for k in range(9)]
    chunks = spark.createDataFrame(rows, SCHEMA)
    fields = [retrieve.Field("f", {"other": ["table"]}, ["yield"], include=["results"]), retrieve.Field("g", {"other": ["a"]}, ["b"], text_top_k=2, table_top_k=1)]
    near = retrieve.by_field(chunks, fields, lambda f: [], "x").select("paper_id", "field", "chunk_id", F.expr("chunk_index * 7 % 5D").alias("distance"))
    given, joined = retrieve.label_evidence(chunks, fields, F.expr("chunk_index * 7 % 5D")), retrieve.label_evidence(chunks, fields, near)
    assert plan(given)[1].count("Exchange") == 1 and plan(given)[1].count("Scan") == 1
    assert sorted(map(str, given.collect())) == sorted(map(str, joined.collect())) != []
