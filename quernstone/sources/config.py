"""YAML settings: requirements, screening, labeling, prompts, post-processing; presets and templates. Small files, read on the driver."""

from __future__ import annotations

import re
from dataclasses import dataclass
from pathlib import Path

import pandas as pd
import yaml
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import pmcid
from ..operators.records import PostConfig
from ..operators.retrieve import Field
from ..operators.screening import Criterion

NUMERIC_TYPES = ("number", "numeric", "float", "integer", "int")


@dataclass(frozen=True)
class FieldSpec:
    name: str
    definition: str
    type: str = "string"


@dataclass(frozen=True)
class Requirements:
    project_name: str
    domain_description: str
    fields: tuple[FieldSpec, ...]
    record_name: str = "record"
    record_meaning: str = ""

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]

    def schema(self) -> str:
        """DDL of an extracted record: all fields as text, in their order."""
        return ", ".join(["paper_id string", "record_id string", *(f"`{n}` string" for n in self.names), "source_chunk_ids array<string>"])


def load(path) -> dict:
    data = yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {}
    if not isinstance(data, dict):
        raise ValueError(f"not a mapping: {path}")
    return data


def specs(items) -> tuple[FieldSpec, ...]:
    out = []
    for x in items or []:
        if not (x.get("name") and x.get("definition")):
            raise ValueError(f"a field needs name and definition: {x}")
        out.append(FieldSpec(str(x["name"]), str(x["definition"]), str(x.get("type") or "string").lower()))
    if not out:
        raise ValueError("no fields")
    return tuple(out)


def requirements(path) -> Requirements:
    """record.fields, or target_fields where there are none."""
    d = load(path)
    record = d.get("record") or {}
    return Requirements(str(d.get("project_name") or ""), str(d.get("domain_description") or ""), specs(record.get("fields") or d.get("target_fields")), str(record.get("name") or "record"), str(record.get("meaning") or ""))


def requirements_of(domain: str, fields: str, definitions: dict[str, str]) -> Requirements:
    """From command-line texts; every field must be defined."""
    names = [f.strip() for f in fields.split(",") if f.strip()]
    if missing := [n for n in names if not definitions.get(n)]:
        raise ValueError(f"no definition for {', '.join(missing)}")
    return Requirements("", domain, specs([{"name": n, "definition": definitions[n]} for n in names]))


def criteria(data: dict) -> list[Criterion]:
    some = [Criterion(str(c["name"]), str(c.get("question") or c.get("description") or ""), bool(c.get("required", True)), str(c.get("uncertain_policy") or "pass")) for c in (data.get("paper_filter") or data).get("criteria") or []]
    if not some:
        raise ValueError("no criteria")
    return some


def labeling(data: dict) -> list[Field]:
    confirm = bool((data.get("labeling_strategy") or {}).get("llm_binary_confirm"))
    out = []
    for f in data.get("fields") or []:
        r, p = f.get("retrieval_settings") or {}, f.get("patterns") or f.get("regex_patterns") or {}
        p = p if isinstance(p, dict) else {"other": p}
        sections = f.get("sections") or {}
        out.append(Field(
            str(f["field_name"]), {k: list(v or []) for k, v in p.items() if not invalid(v)} , list(f.get("table_header_keywords") or f.get("keywords") or []),
            list(sections.get("include") or f.get("section_include") or []), list(sections.get("exclude") or f.get("section_exclude") or []),
            int(r.get("text_top_k", 5)), int(r.get("table_top_k", 5)), int(r.get("semantic_fetch_k", 20)), int(r.get("table_fetch_k", 10)), int(r.get("rrf_k", 60)), bool(f.get("llm_binary_confirm", confirm)),
        ))
    return out


def invalid(patterns) -> list[str]:
    """Patterns that do not compile."""
    bad = []
    for p in patterns or []:
        try:
            re.compile(p)
        except re.error:
            bad.append(p)
    return bad


def post(data: dict, spec: Requirements | None = None) -> PostConfig:
    """Numeric fields are those named here and those of a numeric type."""
    v = data.get("validity") or {}
    numeric = {str(k): dict(c or {}) for k, c in (data.get("numeric_fields") or {}).items()}
    for f in spec.fields if spec else ():
        if f.type in NUMERIC_TYPES:
            numeric.setdefault(f.name, {"integer": True} if f.type in ("integer", "int") else {})
    standard = {k: (c if "terms" in c else {"terms": c}) for k, c in (data.get("standardize") or {}).items()}
    for f in spec.fields if spec else ():
        if f.type == "list" and f.name in standard:
            standard[f.name].setdefault("multiple", True)
    return PostConfig(numeric, standard, list(v.get("required_all") or []), list(v.get("required_any") or []), list(v.get("required_numeric_all") or []), list(data.get("null_values") or []))


def preset(project: str, name: str, folder) -> Path | None:
    path = Path(folder) / project / name
    return path if project and path.is_file() else None


def resolve(name: str, project: str = "", explicit=None, folder=None, output=None) -> Path | None:
    """The settings file to use: the one given, else the project's preset, else the one of an earlier run."""
    if explicit:
        return Path(explicit)
    if folder and (found := preset(project, name, folder)):
        return found
    earlier = Path(output) / name if output else None
    return earlier if earlier and earlier.is_file() else None


def rendered(template: str, spec: Requirements) -> str:
    """A prompt template with its placeholders filled."""
    listed = "\n".join(f"- {f.name} ({f.type}): {f.definition}" for f in spec.fields)
    for k, v in {"domain_description": spec.domain_description, "record_name": spec.record_name, "record_meaning": spec.record_meaning, "fields": listed, "field_names": ", ".join(spec.names)}.items():
        template = template.replace("{" + k + "}", v)
    return template


def instruction(spec: Requirements) -> str:
    return rendered("Find every {record_name} in the text ({record_meaning}).\nFields:\n{fields}\nGive values in the words of the text; leave out what is not said. Answer as JSON: a list under `records`.", spec)


def system_message(spec: Requirements) -> str:
    return rendered("You extract structured records about: {domain_description}. Use only the given text.", spec)


def snapshot(data: dict, path) -> None:
    """The settings in effect, beside the output."""
    Path(path).write_text(yaml.safe_dump(data, allow_unicode=True, sort_keys=False), encoding="utf-8")


@dataclass
class Lookup:
    """Where full texts come from. resolve: row (a dict) -> PMCID or None; fetch: PMCID -> XML as bytes or None. Both run on the executors and may raise; without fetch nothing is found (there is no network here)."""

    resolve: object = None
    fetch: object = None


def folder_lookup(folder: str):
    """fetch from files named by PMCID in a folder that all executors see."""

    def fetch(pmcid: str) -> bytes | None:
        path = Path(folder) / f"{pmcid}.xml"
        return path.read_bytes() if path.is_file() else None

    return fetch


def looked_up(rows: DataFrame, lookup: Lookup) -> DataFrame:
    """rows with pmcid, status (already_exists, downloaded, no_pmcid, unavailable, error) and content, the XML that was found."""
    names = [c for c in rows.columns if c not in ("_pos", "status", "content")]
    rows = rows.select(*(F.col(c) for c in names))

    def run(frames):
        for f in frames:
            out = []
            for row in f.to_dict("records"):
                path, content = str(row.get("source_path") or ""), None
                if path.lower().endswith((".xml", ".nxml")):
                    status = "already_exists"
                else:
                    try:
                        row["pmcid"] = row.get("pmcid") or (lookup.resolve(row) if lookup.resolve else None)
                        content = lookup.fetch(row["pmcid"]) if row["pmcid"] and lookup.fetch else None
                        status = "no_pmcid" if not row["pmcid"] else "downloaded" if content else "unavailable"
                    except Exception as e:  # noqa: BLE001  whatever a service raises
                        status, row["reason"] = "error", f"{type(e).__name__}: {e}"
                out.append(row | {"status": status, "content": content})
            yield pd.DataFrame(out, columns=[*names, "status", "content"])

    return rows.withColumn("pmcid", pmcid("pmcid")).mapInPandas(run, T.StructType([*rows.schema.fields, T.StructField("status", T.StringType()), T.StructField("content", T.BinaryType())]))


def words_of(text: str) -> list[str]:
    return list(dict.fromkeys(w for w in re.findall(r"[a-z0-9]{3,}", text.lower()) if w not in DRAFT_STOPS))


DRAFT_STOPS = {"and", "any", "for", "from", "how", "its", "not", "of", "the", "their", "this", "that", "used", "was", "what", "which", "with"}


def draft_labeling(spec: Requirements) -> dict:
    """Settings for labeling from what is to be found: the words of a field's name are strong patterns and table keywords, those of its definition weaker ones. A draft to be edited; a model may write a better one."""
    edge = lambda words: [rf"\b{re.escape(w)}" for w in words]
    fields = []
    for f in spec.fields:
        name = words_of(f.name.replace("_", " "))
        fields.append({"field_name": f.name, "patterns": {"strong": edge(name), "other": edge(w for w in words_of(f.definition) if w not in name)}, "table_header_keywords": name})
    return {"fields": fields}


def draft_filter(spec: Requirements) -> dict:
    """Criteria for a screening from the same: is the paper about the domain, and does it report the record. Keywords are for the classifier that needs no model."""
    about, reports = words_of(spec.domain_description), words_of(" ".join([spec.record_meaning, *(f.name.replace("_", " ") for f in spec.fields)]))
    some = [{"name": "in_domain", "question": f"Is the paper about {spec.domain_description}?", "uncertain_policy": "pass"}, {"name": "reports_record", "question": f"Does it report {spec.record_meaning or spec.record_name}?", "uncertain_policy": "pass"}]
    return {"criteria": some, "keywords": {"in_domain": about, "reports_record": reports}}
