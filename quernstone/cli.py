"""Command line: one stage a command, each from files to files. `python -m quernstone.cli STAGE --help` lists a stage's flags."""

from __future__ import annotations

import argparse
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import models, sinks
from .functions.text import rendered
from .operators import context, identity, records, retrieve, screening, summaries
from .sources import config, html_meta, jats, jsonl, wos

CHUNKS = f"paper_id string, chunk_id string, chunk_type string, text string, section_path array<string>, metadata {jats.META}"
PAPERS = "paper_id string, source_path string, source_file string, file_type string, title string, abstract string, text_for_filter string, doi string, pmid string, pmcid string, wos_uid string, metadata_quality string, reason string, status string"
ERRORS = "paper_id string, source_path string, error string"
RESULTS = f"{PAPERS}, criteria {screening.ANSWERS}, decision string, error string"
LABELED = "paper_id string, chunk_id string, chunk_index int, chunk_type string, section_path array<string>, labels array<string>"


def merged(spark, new: DataFrame, path: str, schema: str, force: bool, key: str = "paper_id") -> DataFrame:
    """new rows with those of an earlier run; force starts anew. Written aside first, since it reads what it replaces."""
    if force or not jsonl.exists(spark, path):
        return new
    old = jsonl.read(spark, path, schema).drop("_pos")
    return identity.replace_by_key(old, new.drop("_pos"), key)


def replace(spark, rows: DataFrame, path: str) -> None:
    jsonl.write(rows, path + ".new")
    jvm = spark._jvm
    P = jvm.org.apache.hadoop.fs.Path
    fs = P(path).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.delete(P(path), True)
    fs.rename(P(path + ".new"), P(path))


def settings(a, explicit, name: str) -> dict:
    """A stage's settings: the file given, else the project's preset, else those of an earlier run; {} if there are none."""
    path = config.resolve(name, a.project or "", explicit, a.preset_dir, a.output)
    return config.load(path) if path else {}


def wanted(a):
    """What is to be found: a file of requirements, or domain, fields and definitions from the flags."""
    if a.requirements:
        return config.requirements(a.requirements)
    if not a.fields:
        raise SystemExit("--requirements or --fields is needed")
    return config.requirements_of(a.domain or "", a.fields, dict(d.split("=", 1) for d in a.definition))


def ingest(spark, a):
    rows = identity.limited(wos.read(spark, *a.input), a.limit)
    jsonl.write(rows.drop("record_no"), f"{a.output}/papers")
    sinks.write_summary(summaries.ingest_summary(rows), f"{a.output}/ingest_summary")


def screen(spark, a):
    spec = settings(a, a.config, "paper_filter.yaml")
    if not spec and a.fields:
        spec = config.draft_filter(wanted(a))
    some = config.criteria(spec) if spec else [screening.Criterion("relevant", "Is the paper relevant?")]
    rows = screening.candidate(jsonl.read(spark, a.metadata, PAPERS)) if a.metadata else html_meta.read(spark, a.input).withColumn("_pos", F.col("source_path"))
    path = f"{a.output}/filter_results"
    if not a.force and jsonl.exists(spark, path):
        rows = identity.pending(rows, jsonl.read(spark, path, RESULTS))
    words = {c.name: (spec.get("keywords") or {}).get(c.name, []) for c in some}
    out = screening.screen(identity.limited(rows, a.limit), some, models.keyword_classifier(some, words), a.dry_run)
    replace(spark, merged(spark, out, path, RESULTS, a.force), path)
    sinks.write_screening(jsonl.read(spark, path, RESULTS), a.output, results_too=False)


def acquire(spark, a, lookup: config.Lookup | None = None):
    """Papers with a local file pass; for others a lookup is asked, by default one that finds files by PMCID in --fulltext-dir. What it gives is kept as a table of files, fulltexts."""
    lookup = lookup or config.Lookup(fetch=config.folder_lookup(a.fulltext_dir) if a.fulltext_dir else None)
    rows = jsonl.read(spark, a.passed, PAPERS)
    known = identity.acquired(rows, jsonl.read(spark, f"{a.output}/acquisition", PAPERS, optional=True)) if not a.force else rows
    found = config.looked_up(identity.dedupe_acquired(identity.limited(known, a.limit)), lookup).persist()
    table = f"{a.output}/fulltexts"
    # written first: a paper whose text is not there is not acquired
    sinks.upsert_new(found.filter("content is not null").select(F.concat(F.lit(table + "/"), F.col("pmcid"), F.lit(".xml")).alias("path"), "content"), table, key="path")
    out = found.withColumn("source_path", F.when(F.col("content").isNotNull(), F.concat(F.lit(table + "/"), F.col("pmcid"), F.lit(".xml"))).otherwise(F.col("source_path"))).withColumn("file_type", F.when(F.col("status").isin("downloaded", "already_exists"), "xml").otherwise(F.col("file_type"))).drop("content")
    replace(spark, merged(spark, out, f"{a.output}/acquisition", PAPERS, a.force), f"{a.output}/acquisition")
    sinks.write_summary(summaries.acquisition_summary(jsonl.read(spark, f"{a.output}/acquisition", PAPERS)), f"{a.output}/acquisition_summary")


def bare(path):
    """A path without its scheme."""
    return F.regexp_replace(path, "^[a-z0-9]+:/+", "/")


#: Files named one by one; more are read by their folders and picked out there.
NAMED = 10_000


def opened(spark, wanted_: DataFrame, table: str) -> DataFrame:
    """path and content of files (source_path), on disk or in the table of texts that a lookup gave."""
    files = spark.createDataFrame([], "path string, content binary")
    if jsonl.exists(spark, table):
        files = spark.read.parquet(table).join(wanted_.select(F.col("source_path").alias("path")), "path", "left_semi")
        wanted_ = wanted_.join(files.select(F.col("path").alias("source_path")), "source_path", "left_anti")
    wanted_ = wanted_.persist()
    few = [r.source_path for r in wanted_.limit(NAMED + 1).collect()]
    if not few:
        return files
    if len(few) <= NAMED:
        return files.unionByName(spark.read.format("binaryFile").load(few).select("path", "content"))
    folders = [r.f for r in wanted_.select(F.regexp_extract("source_path", r"^(.*)/[^/]*$", 1).alias("f")).distinct().collect()]
    there = spark.read.format("binaryFile").load(folders).select("path", "content")
    return files.unionByName(there.join(wanted_.select(bare("source_path").alias("_p")), bare("path") == F.col("_p"), "left_semi"))


def preprocess(spark, a):
    passed = jsonl.read(spark, a.passed, PAPERS)
    done = jsonl.read(spark, f"{a.output}/parsed_chunks", CHUNKS, optional=True)
    todo = passed if a.force else passed.join(done.select("paper_id").distinct(), "paper_id", "left_anti")
    jsonl.write(identity.limited(todo, a.limit).select("paper_id", "source_path", "file_type"), f"{a.output}/preprocess_todo")  # what this run is about, before its results change it
    todo = jsonl.read(spark, f"{a.output}/preprocess_todo", PAPERS)
    bad = todo.filter(F.col("file_type") != "xml").select("paper_id", "source_path", F.lit("only article XML is parsed").alias("error"))
    rows = jats.chunks(opened(spark, todo.filter("file_type = 'xml'").select("source_path").distinct(), f"{a.output}/fulltexts")).persist()
    chunks = rows.filter("chunk_id is not null").select("paper_id", "chunk_id", "chunk_type", "text", "section_path", "metadata")
    replace(spark, merged(spark, chunks, f"{a.output}/parsed_chunks", CHUNKS, a.force), f"{a.output}/parsed_chunks")
    failed = rows.filter("error is not null").select(bare("source_path").alias("_p"), "error").join(todo.select("paper_id", "source_path", bare("source_path").alias("_p")), "_p").drop("_p")
    before = jsonl.read(spark, f"{a.output}/preprocess_errors", ERRORS, optional=True).drop("_pos")
    kept = identity.carried_errors(before, todo, jsonl.read(spark, f"{a.output}/parsed_chunks", CHUNKS))
    replace(spark, failed.unionByName(bad).unionByName(kept), f"{a.output}/preprocess_errors")
    skips = summaries.skip_counts(jats.skip_counts(rows), jsonl.read(spark, f"{a.output}/skipped_sections", "tag string, n long", optional=True).drop("_pos"))
    replace(spark, skips, f"{a.output}/skipped_sections")
    sinks.write_summary(summaries.chunk_summary(jsonl.read(spark, f"{a.output}/parsed_chunks", CHUNKS)), f"{a.output}/preprocess_summary")


def flat(chunks: DataFrame) -> DataFrame:
    m = F.col("metadata")
    return chunks.select("paper_id", "chunk_id", m["chunk_index"].alias("chunk_index"), "chunk_type", "text", "section_path", F.coalesce(m["caption"], F.lit("")).alias("caption"), F.coalesce(m["headers"], F.array().cast("array<string>")).alias("headers"), m["markdown_text"].alias("markdown_text"))


def label(spark, a):
    data = settings(a, a.config, "labeling_config.yaml") or config.draft_labeling(wanted(a))
    fields = config.labeling(data)
    chunks = flat(jsonl.read(spark, a.chunks, CHUNKS))
    done = jsonl.read(spark, f"{a.output}/labeled_chunks", LABELED, optional=True)
    if not a.force:
        chunks = chunks.join(done.select("paper_id").distinct(), "paper_id", "left_anti")
    if a.limit:
        chunks = chunks.join(chunks.select("paper_id").distinct().orderBy("paper_id").limit(a.limit), "paper_id", "left_semi")
    vectors = models.embed(chunks).select("paper_id", "chunk_id", "embedding")
    asked = spark.createDataFrame([(f.name, models.hash_embedding(" ".join([f.name, *f.keywords]))) for f in fields], "field string, query array<double>")
    near = retrieve.semantic_rank(vectors, asked, 10 * max(f.fetch_k for f in fields), exact=True)
    evidence = models.confirm(retrieve.label_evidence(chunks, fields, near), chunks, fields)
    out = retrieve.label_chunks(evidence, chunks, fields).persist()
    replace(spark, merged(spark, out, f"{a.output}/labeled_chunks", LABELED, a.force), f"{a.output}/labeled_chunks")
    sinks.write_summary(summaries.labeling_summary(jsonl.read(spark, f"{a.output}/labeled_chunks", LABELED)), f"{a.output}/labeling_summary")
    config.snapshot(data, Path(a.output) / "labeling_config.yaml")


def extract(spark, a, function=models.mock_extract, modes: tuple[str, ...] = ("records",)):
    """Papers with labels that have no finished status yet, or those named. --checkpoint-every N works N papers at a time, so that an interrupted run keeps what it has."""
    spec = wanted(a)
    labeled = jsonl.read(spark, a.labels, LABELED)
    papers = labeled.select("paper_id").distinct()
    path, states = f"{a.output}/extracted_records", f"{a.output}/extraction_status"
    if a.paper_id:
        if a.force:
            raise SystemExit("--paper-id with --force would lose the records of all other papers")
        targets = spark.createDataFrame([(p,) for p in a.paper_id], "paper_id string")
        if missing := sorted(r.paper_id for r in identity.unknown_targets(targets, papers).collect()):
            raise SystemExit("not among the labeled papers: " + ", ".join(missing))
        todo = targets.distinct()
    else:
        todo = papers if a.force else identity.unfinished(papers, jsonl.read(spark, states, summaries.EXTRACTED, optional=True))
    todo = todo.orderBy("paper_id").limit(a.limit) if a.limit else todo
    batches = -(-todo.count() // a.checkpoint_every) if a.checkpoint_every else 1
    todo = todo.withColumn("batch", F.pmod(F.xxhash64("paper_id"), F.lit(max(1, batches))))
    jsonl.write(todo, f"{a.output}/extraction_todo")  # what this run is about, before its results change it
    todo = jsonl.read(spark, f"{a.output}/extraction_todo", "paper_id string, batch long").drop("_pos")
    last = todo.agg(F.max("batch")).first()[0]
    chunks, force = flat(jsonl.read(spark, a.chunks, CHUNKS)), a.force
    for k in range((-1 if last is None else last) + 1):
        now = todo.filter(F.col("batch") == k).select("paper_id")
        records_, status = extracted(now, chunks, labeled, spec, settings(a, a.prompt_preset, "extraction_prompt.yaml"), function, modes)
        # records of a paper that failed stay as they were
        fine = status.filter(~F.col("status").startswith("failed")).select("paper_id")
        if not force and jsonl.exists(spark, path):
            old = jsonl.read(spark, path, spec.schema()).drop("_pos").join(fine, "paper_id", "left_anti")
            records_ = old.unionByName(records_, allowMissingColumns=True)
        replace(spark, records_, path)
        replace(spark, merged(spark, status, states, summaries.EXTRACTED, force), states)
        force = False
    if last is None and not jsonl.exists(spark, path):
        jsonl.write(spark.createDataFrame([], spec.schema()), path)
    sinks.write_summary(summaries.extraction_summary(jsonl.read(spark, states, summaries.EXTRACTED, optional=True), todo, papers), f"{a.output}/extraction_summary")


def extracted(papers: DataFrame, chunks: DataFrame, labeled: DataFrame, spec, prompt: dict, function, modes) -> tuple[DataFrame, DataFrame]:
    """(records, status) of some papers."""
    chunks = chunks.join(papers, "paper_id", "left_semi")
    some = context.candidates(chunks, labeled, context.numeric_evidence(chunks))
    some = some.withColumn("rendered", rendered("chunk_id", "chunk_type", "section_path", "text")).withColumn("n_chars", F.length("rendered"))
    used = context.budgeted(some).persist()
    got = models.extract(papers.join(context.contexts(used), "paper_id", "left"), spec.names, function, modes).persist()
    raw = got.filter("_pos is not null")
    rule = records.EndpointConstraint.of(prompt.get("endpoint_constraints"))
    found = rule.apply(raw) if rule else raw
    numbered = records.number_records(records.clean_records(found, spec.names)).persist()
    out = numbered.join(context.attribute(numbered, used, spec.names), "record_id", "left").select("paper_id", "record_id", *spec.names, "source_chunk_ids")
    combos = (rule.rejected(raw, "record_type", "endpoint", "paper_id") if rule else raw.limit(0).select("paper_id", F.lit("").alias("combo"), F.lit(0).cast("long").alias("n")))
    combos = combos.groupBy("paper_id").agg(F.sum("n").alias("rejected"), F.map_from_entries(F.collect_list(F.struct("combo", "n"))).alias("rejected_by_combo"))
    status = got.groupBy("paper_id").agg(F.first("status").alias("status"), F.count("_pos").alias("records_raw"))
    for extra in (numbered.groupBy("paper_id").agg(F.count("*").alias("records_after_cleanup")), combos, used.groupBy("paper_id").agg(F.count("*").alias("context_chunks_used"))):
        status = status.join(extra, "paper_id", "left")
    n = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    removed = n("records_raw") - n("rejected") - n("records_after_cleanup")
    none = F.create_map().cast("map<string,bigint>")
    return out, status.select("paper_id", "status", (n("records_raw") - n("rejected")).alias("records_raw"), n("records_after_cleanup").alias("records_after_cleanup"), removed.alias("duplicates_removed"), n("rejected").alias("endpoint_constraint_rejected"), F.coalesce("rejected_by_combo", none).alias("rejected_by_combo"), n("context_chunks_used").alias("context_chunks_used"))


def postprocess(spark, a):
    spec = wanted(a)
    data = settings(a, a.config, "postprocess_config.yaml")
    rule = config.post(data, spec)
    rows = jsonl.read(spark, a.records, spec.schema())
    out = records.postprocess(rows, spec.names, rule).persist()
    jsonl.write(out, f"{a.output}/final_records")
    sinks.write_csv(out, f"{a.output}/final_records_csv", spec.names, [f for f in rule.numeric if f in spec.names])
    sinks.write_summary(records.postprocess_summary(rows, spec.names, rule), f"{a.output}/postprocess_summary")
    config.snapshot(data, Path(a.output) / "postprocess_config.yaml")


def pipeline(spark, a):
    if a.force and a.limit:
        raise SystemExit("--force with --limit would lose the papers beyond the limit")
    Path(a.output).mkdir(parents=True, exist_ok=True)
    if a.wos or a.metadata:
        if a.wos:
            a.input = a.wos
            ingest(spark, a)
        a.metadata, a.dry_run = a.metadata or f"{a.output}/papers", False
        a.config = a.filter_config
        screen(spark, a)
        a.passed = f"{a.output}/passed"
        acquire(spark, a)
        a.passed = f"{a.output}/acquisition"
    else:
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.{xml,nxml}").load(a.xml)
        name = F.regexp_extract("path", r"([^/]+)\.[^.]*$", 1)
        jsonl.write(files.select(name.alias("paper_id"), F.col("path").alias("source_path"), F.lit("xml").alias("file_type")), f"{a.output}/passed")
        a.passed = f"{a.output}/passed"
    preprocess(spark, a)
    a.chunks, a.config = f"{a.output}/parsed_chunks", a.labeling_config
    label(spark, a)
    a.labels, a.paper_id = f"{a.output}/labeled_chunks", []
    extract(spark, a)
    if not a.skip_postprocess:
        a.records, a.config = f"{a.output}/extracted_records", a.postprocess_config
        postprocess(spark, a)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="quernstone")
    stages = p.add_subparsers(dest="stage", required=True)

    def stage(name, run, **flags):
        s = stages.add_parser(name)
        s.set_defaults(run=run)
        s.add_argument("--output", required=True)
        s.add_argument("--limit", type=int, default=None)
        s.add_argument("--force", action="store_true")
        s.add_argument("--project", default=None, help="name of a folder of presets")
        s.add_argument("--preset-dir", default=None, help="where such folders are")
        s.add_argument("--requirements", default=None, help="a file of requirements; or:")
        s.add_argument("--domain", default=None)
        s.add_argument("--fields", default=None, help="names, separated by commas")
        s.add_argument("--definition", action="append", default=[], help="name=definition, for each field")
        for flag, options in flags.items():
            s.add_argument("--" + flag.replace("_", "-"), **options)

    need, may = {"required": True}, {"default": None}
    stage("ingest", ingest, input={"nargs": "+", "required": True})
    stage("filter", screen, input=may, metadata=may, config=may, dry_run={"action": "store_true"})
    stage("acquire", acquire, passed=need, fulltext_dir=may)
    stage("preprocess", preprocess, passed=need)
    stage("label", label, chunks=need, config=may)
    every = {"type": int, "default": None}
    stage("extract", extract, chunks=need, labels=need, prompt_preset=may, paper_id={"action": "append", "default": []}, checkpoint_every=every)
    stage("postprocess", postprocess, records=need, config=may)
    stage("pipeline", pipeline, wos={"nargs": "*", "default": None}, metadata=may, xml=may, fulltext_dir=may, filter_config=may, labeling_config=may, prompt_preset=may, postprocess_config=may, checkpoint_every=every, skip_postprocess={"action": "store_true"})
    return p


def main(argv=None) -> None:
    a = parser().parse_args(argv)
    a.run(SparkSession.builder.getOrCreate(), a)


if __name__ == "__main__":
    main()
