"""Command line: python -m labeldiff.plans.cli --store DIR [--json] COMMAND ... Exit codes: 0 done, 1 failed, 2 undecided or partial."""

from __future__ import annotations

import argparse
import json
import sys
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labeldiff.functions import rules
from labeldiff.operators import diff
from labeldiff.plans.batches import Batches
from labeldiff.plans.flows import Flows
from labeldiff.sources import fetch, files
from labeldiff.sources.fetch import Transport

COMMANDS = {
    "fetch": ["set_id", "version?"], "ingest": ["raw?"], "search": ["query"], "lineages": ["query"], "show": ["document"], "verify": ["raw?"], "history": ["set_id?"], "verify-diff": ["old", "new"],
    "integrity": [], "count": ["table"], "compact": [], "export": ["root"], "candidates": ["name"],
}
STAGES = ("plan", "fetch", "ingest", "verify", "run", "status", "report")


def arguments(argv: list[str] | None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="labeldiff")
    p.add_argument("--store", required=True)
    p.add_argument("--service", default="https://service")
    p.add_argument("--json", action="store_true", help="JSON instead of lines of text")
    sub = p.add_subparsers(dest="command", required=True)
    for name, words in COMMANDS.items():
        c = sub.add_parser(name)
        for w in words:
            c.add_argument(w.rstrip("?"), nargs="?" if w.endswith("?") else None)
        if name == "show":
            c.add_argument("--concept")
    d = sub.add_parser("diff")
    for flag in ("--old", "--new", "--set-id", "--from-version", "--to-version"):
        d.add_argument(flag)
    d.add_argument("--text", action="store_true")
    u = sub.add_parser("utilization")
    u.add_argument("action", choices=("add", "list", "show"))
    u.add_argument("name", nargs="?")
    b = sub.add_parser("batch")
    b.add_argument("stage", choices=STAGES)
    b.add_argument("list")
    b.add_argument("--ranks", type=int, nargs="*")
    return p.parse_args(argv)


def rows(df: DataFrame) -> list:
    return [json.loads(x) for x in df.toJSON().collect()]


def fault(category: str, message: str, code: int = 1, **details) -> tuple[int, object]:
    return code, {"category": category, "message": message, "details": details}


def run(argv: list[str] | None = None, spark: SparkSession | None = None, transport: Transport = fetch.http_get, moment: str | None = None) -> tuple[int, object]:
    """Exit code and payload of a command."""
    a = arguments(argv)
    spark = spark or SparkSession.builder.appName("labeldiff").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    flows = Flows(spark, a.store)
    moment = moment or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    try:
        flows.migrate(moment)
        if a.command == "batch":
            return run_batch(a, Batches(flows, transport, a.service, moment))
        if a.command in ("utilization", "candidates"):
            return run_lists(a, Batches(flows, transport, a.service, moment))
        if a.command in ("diff", "verify-diff"):
            return run_diff(a, flows, moment)
        return run_documents(a, flows, transport, moment)
    except (ValueError, LookupError) as e:
        return fault("source_not_found" if isinstance(e, LookupError) else "malformed_metadata", str(e))


def run_documents(a: argparse.Namespace, flows: Flows, transport: Transport, moment: str) -> tuple[int, object]:
    spark = flows.spark
    if a.command == "fetch":
        chosen = spark.createDataFrame([(a.set_id, a.version or "")], "set_id string, version string")
        wrong = rows(flows.fetch_histories(chosen, a.service, transport, moment))
        if wrong:
            return fault("network_failure", wrong[0]["error"], set_id=a.set_id)
        if not a.version:
            newest = flows.latest_history().where(F.col("lineage_id") == flows.lineage_of(F.lit(a.set_id))).orderBy("position").first()
            chosen = chosen.withColumn("version", F.lit(newest.version))
        out = rows(flows.fetch(chosen, a.service, transport, moment, versions=bool(a.version)))
        return int(any(r["state"] not in ("FETCHED", "ALREADY_FETCHED") for r in out)), out
    if a.command == "ingest":
        flows.recover(moment)
        source = files.raw_files(spark, a.raw).select("path", "content") if a.raw else flows.table("raw").select("path", "content", "raw_sha256", "set_id", "version")
        out = rows(flows.ingest(source, moment))
        return int(any(r["outcome"] not in ("INGESTED", "ALREADY_INGESTED") for r in out)), out
    if a.command == "search":
        return 0, rows(flows.search(a.query))
    if a.command == "lineages":
        return 0, rows(flows.lineage_search(a.query))
    if a.command == "show":
        head = rows(flows.document(a.document))
        if not head:
            return fault("source_not_found", "no such document", document_id=a.document)
        return 0, {"document": head[0], "sections": rows(flows.sections(a.document, a.concept).drop("structure", "comparison"))}
    if a.command == "verify":
        out = rows(flows.verify(files.raw_files(spark, a.raw).select("path", "content") if a.raw else None))
        return int(not all(r["verified"] for r in out)), out
    if a.command == "history":
        versions = flows.versions_of()
        versions = versions.where(F.lower("set_id") == a.set_id.lower()) if a.set_id else versions
        shown = versions.select("lineage_id", "set_id", "document_id", "version", "effective", "published", "published_source", "disagrees", "position").orderBy("lineage_id", "position")
        return 0, {"versions": rows(shown), "pairs": rows(flows.pairs().join(shown.select("lineage_id").distinct(), "lineage_id", "left_semi").select("lineage_id", "old_version", "new_version", "ordering", "missing"))}
    if a.command == "count":
        return 0, [{"table": a.table, "n": flows.count(a.table)}]
    if a.command == "compact":
        from labeldiff.plans.tables import TABLES

        flows.store.compact({n: schema for n, (schema, _) in TABLES.items()})
        return 0, [{"commits": len(flows.store.commits())}]
    if a.command == "export":
        return 0, [{"written": flows.export(a.root)}]
    out = rows(flows.integrity())
    return int(bool(out)), out


def run_diff(a: argparse.Namespace, flows: Flows, moment: str) -> tuple[int, object]:
    old, new = a.old, a.new
    if a.command == "diff" and a.set_id:
        if old or new or not (a.from_version and a.to_version):
            return fault("malformed_metadata", "give either two documents or a set id with two versions")
        found = [flows.resolve(a.set_id, v).first() for v in (a.from_version, a.to_version)]
        if any(r.status != "FOUND" for r in found):
            many = any(r.status == "AMBIGUOUS" for r in found)
            return fault("ambiguous_document_version" if many else "source_not_found", "a version does not resolve to one document", 2 if many else 1, set_id=a.set_id)
        old, new = (r.document_id for r in found)
    if not (old and new):
        return fault("malformed_metadata", "two documents are needed")
    pair = flows.pair_of(old, new)
    if pair.isEmpty():
        return fault("lineage_mismatch", "the documents do not share a lineage", old=old, new=new)
    if a.command == "verify-diff":
        out = rows(flows.verify_diffs(pair))
        return (int(not all(r["verified"] for r in out)), out) if out else fault("source_not_found", "the diff is not stored")
    stored = rows(flows.store_diffs(pair, moment))
    sections = flows.section_diffs(pair)
    out = {"stored": stored, "summary": rows(flows.diff(pair, sections, moment).drop("canonical")), "sections": rows(sections.drop("old_text", "new_text", "canonical").orderBy("index"))}
    if a.text:
        changed = sections.where(F.arrays_overlap("operations", F.array(F.lit("SECTION_MODIFIED"))))
        out |= {"chunks": rows(flows.text_diffs(pair, sections).orderBy("index", "position")), "unified": rows(diff.unified_texts(changed, ["index"]).orderBy("index"))}
    return int(any(r["outcome"] == "CONFLICT" for r in stored)), out


def run_lists(a: argparse.Namespace, batches: Batches) -> tuple[int, object]:
    if a.command == "candidates":
        return 0, rows(batches.candidates(a.name))
    if a.action == "add":
        out = rows(batches.add_list(files.ranked_lists(batches.spark, a.name)))
        return int(bool(out)), out or rows(batches.lists())
    if a.action == "list":
        return 0, rows(batches.lists())
    return 0, rows(batches.flows.table("entries").where(F.col("utilization_list_id") == a.name).orderBy("rank"))


def run_batch(a: argparse.Namespace, batches: Batches) -> tuple[int, object]:
    if a.stage in ("status", "report"):
        run_id = batches.run_id(a.list)
    elif a.stage == "run":
        run_id = batches.verify(a.list)
    else:
        run_id = batches.plan(a.list) if a.stage == "plan" else getattr(batches, a.stage)(a.list, a.ranks)
    whole, items = batches.status(run_id)
    out = {"run": rows(whole), "items": rows(items.orderBy("rank"))}
    if not out["run"]:
        return fault("source_not_found", "the list has no run yet", list=a.list)
    if a.stage in ("run", "report"):
        out["report"] = rows(batches.report(run_id).drop("canonical"))
    trouble = items.agg(F.coalesce(F.bool_or(F.col("error").isNotNull() | F.col("manual_review") | F.col("quarantine_id").isNotNull()), F.lit(False))).first()[0]
    return whole.select(rules.exit_code(F.col("status"), F.lit(trouble))).first()[0], out


def as_text(value: object, indent: str = "") -> str:
    """Lines of "name: value"; lists and objects are indented below their name."""
    if isinstance(value, dict):
        return "\n".join(f"{indent}{k}: {v}" if not isinstance(v, (dict, list)) else f"{indent}{k}:\n{as_text(v, indent + '  ')}" for k, v in value.items() if v not in (None, [], {}))
    if isinstance(value, list):
        return "\n".join(f"{indent}- {as_text(v, indent + '  ').lstrip()}" for v in value)
    return f"{indent}{value}"


def main() -> int:
    code, out = run()
    as_json = arguments(None).json
    print(json.dumps(out, ensure_ascii=False, indent=2, sort_keys=True) if as_json else as_text(out), file=sys.stdout if code != 1 else sys.stderr)
    return code


if __name__ == "__main__":
    sys.exit(main())
