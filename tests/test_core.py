"""Core operators on small tables: golden ids, rules, matching, diffs, store, sources and flows."""

from __future__ import annotations

import io
import json
import os
import random
import signal
import subprocess
import sys
import time
import uuid
import zipfile
from datetime import date
from difflib import SequenceMatcher
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from labeldiff.functions import identity, rules, text
from labeldiff.operators import batch, diff, lineage, matching, relational, selection, store, structure, textdiff
from labeldiff.operators.store import Refused
from labeldiff.plans import cli
from labeldiff.plans.batches import Batches
from labeldiff.plans.flows import Flows
from labeldiff.sources import fetch, files, xml_documents
from labeldiff.streaming import ingest
from labeldiff.values import CANDIDATE_CLASSES, NAMESPACE


@pytest.fixture(scope="module", autouse=True)
def few_tasks(spark):
    """Stores of a few rows: every table of a commit would have a file for each task."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def section(code=None, title=None, body=None, inner="", root=None):
    return f"<component><section>{f'<id root={root!r}/>' if root else ''}{f'<code code={code!r}/>' if code else ''}{f'<title>{title}</title>' if title else ''}{f'<text>{body}</text>' if body is not None else ''}{inner}</section></component>"


def document(version="1", sections="", set_id="SET-1", title="Drug label", extra=""):
    return f"""<document xmlns="urn:hl7-org:v3"><id root="doc-{version}"/><code displayName="HUMAN LABEL"/><title>{title}</title><effectiveTime value="2020010{version}"/><setId root="{set_id}"/><versionNumber value="{version}"/><languageCode code="en"/>{extra}<component><structuredBody>{sections}</structuredBody></component></document>""".encode()


PRODUCT = """<subject><manufacturedProduct><manufacturedProduct><name>Brandex</name><formCode displayName="TABLET"/><asEntityWithGeneric><genericMedicine><name>drugol</name></genericMedicine></asEntityWithGeneric>
<ingredient classCode="ACTIB"><ingredientSubstance><name>DRUGOL</name></ingredientSubstance></ingredient><ingredient classCode="IACT"><ingredientSubstance><name>starch</name></ingredientSubstance></ingredient></manufacturedProduct>
<consumedIn><routeCode displayName="ORAL"/><routeCode displayName="oral"/></consumedIn></manufacturedProduct></subject>"""
V1 = document("1", section("34067-9", "1 INDICATIONS", "<paragraph>use <b>it</b> well</paragraph>", section(None, "1.1 Adults", "for adults only", root="x1"), root="x0") + section("34070-3", "4 CONTRAINDICATIONS", "never with milk") + section(None, "8.6 Renal impairment", "") + section(None, "Old words", "these words will go"), extra=PRODUCT)
V2 = document("2", section("34070-3", "4 CONTRAINDICATIONS", "never with cold milk") + section("34067-9", "1 Indications", "<paragraph>use <b>it</b> well</paragraph>", section(None, "1.1 Adults", "for adults only", root="x1"), root="x0") + section(None, "8.6 Renal impairment", "") + section("99999-9", "New part", "quite another thing"), extra=PRODUCT)


# Scalars


def test_golden_ids(spark):
    lit = F.lit
    doc = one(spark, identity.lineage_id(lit("FDA"), lit("DailyMed"), lit("US"), lit("e9481622-7cc6-418a-acb6-c5450daae9b0")).alias("l"), identity.ingredient_id(lit("apixaban")).alias("i"))
    assert doc.i == "9efe7838-0498-5b55-82db-5f9a9bf84a8a"
    assert doc.l == str(uuid.uuid5(uuid.UUID(NAMESPACE), 'lineage|{"authority":"FDA","jurisdiction":"US","provider":"DailyMed","source_document_id":"e9481622-7cc6-418a-acb6-c5450daae9b0"}'))
    names = ["", "é", "a|b", "x" * 300]
    got = [r.u for r in spark.createDataFrame([(n,) for n in names], "n string").select(identity.uuid5(F.col("n")).alias("u")).collect()]
    assert got == [str(uuid.uuid5(uuid.UUID(NAMESPACE), n)) for n in names]


def test_canonical_json(spark):
    value = 'a"b\\u001F\\\x1f\n\té\x0b'
    got = one(spark, identity.canonical_json(z=F.lit(value), a=F.lit(1), n=F.lit(None).cast("string")).alias("j")).j
    assert got == json.dumps({"a": 1, "n": None, "z": value}, ensure_ascii=False, sort_keys=True, separators=(",", ":"))


def test_text(spark):
    lit = F.lit
    r = one(
        spark, text.mapped_heading(lit(" 2.10  How Supplied ")).alias("h"), F.size(text.tokens(lit("a é  b c"))).alias("n"), text.mentions(lit("x.Eliquis-tab"), "ELIQUIS").alias("m"), text.mentions(lit("eliquist"), "eliquis").alias("m2"), text.mentions(lit("a.c"), "a+c").alias("m3"),
        text.first_spellings(F.array(lit("A"), lit("b"), lit("a"), lit(" "), lit(None).cast("string"), lit("B"))).alias("f"), text.cleaned_segment(lit("..")).alias("c"), text.cleaned_segment(lit("a/b?")).alias("c2"), text.safe_segment(lit("..")).alias("s"),
        text.descending_version(lit("x")).cast("int").alias("v"), text.version_direction(lit("9"), lit("10")).alias("d"), text.version_direction(lit("9a"), lit("10")).alias("d2"), text.ordinal(text.lenient_date(lit("jan 5, 2020"))).alias("o"), text.strict_date(lit("Jan 5, 2020")).alias("sd"), text.strict_date(lit("Jan 05, 2020")).alias("sd2"),
        text.utc_text(lit("2020-01-02T03:04:05Z").cast("timestamp")).alias("u"), text.utc_text(lit("2020-01-02T03:04:05.5Z").cast("timestamp")).alias("u2"), text.normalized_name(lit("ＡＢ  Straße")).alias("nn"),
    )
    assert (r.h, r.n, r.m, r.m2, r.m3, r.f, r.c, r.c2, r.s) == ("how supplied", 4, True, False, False, ["A", "b"], "unknown", "a_b_", False)
    assert (r.v, r.d, r.d2, r.o, r.sd, r.sd2, r.u, r.u2, r.nn) == (-1, -1, None, date(2020, 1, 5).toordinal(), None, date(2020, 1, 5), "2020-01-02T03:04:05Z", "2020-01-02T03:04:05.500000Z", "ab strasse")


@pytest.mark.parametrize(("signals", "adjacent", "want"), [
    ((-1, -1, None, None, None), True, ("SOURCE_VERSION_ORDERED", "AUTHORITATIVE_HISTORY_ADJACENT", True)),
    ((-1, -1, None, None, None), False, ("SOURCE_VERSION_ORDERED", "AUTHORITATIVE_HISTORY_WITH_INTERMEDIATES", False)),
    ((-1, None, -1, None, None), None, ("SOURCE_VERSION_ORDERED", "MULTIPLE_SOURCE_FIELDS_AGREE", False)),
    ((-1, None, 0, None, 1), None, ("SOURCE_VERSION_ORDERED", "SOURCE_VERSION_ONLY", False)),
    ((None, None, -1, -1, None), None, ("EFFECTIVE_DATE_ORDERED", "DATES_AGREE", False)),
    ((0, None, None, -1, None), None, ("PUBLICATION_DATE_ORDERED", "DATE_ONLY", False)),
    ((None, None, None, None, -1), None, ("INGESTION_ORDER_ONLY", "INGESTION_METADATA_ONLY", False)),
    ((None, None, None, None, 1), None, ("ORDER_CONFLICT", "INGESTION_DIRECTION_CONFLICT", False)),
    ((-1, None, 1, None, -1), None, ("ORDER_CONFLICT", "CONFLICT", False)),
    ((None, None, None, None, 0), None, ("ORDER_UNDETERMINED", "UNDETERMINED", False)),
])
def test_version_order(spark, signals, adjacent, want):
    got = one(spark, rules.version_order(*[F.lit(s).cast("int") for s in signals], F.lit(adjacent).cast("boolean")).alias("o")).o
    assert (got.status, got.confidence, got.known) == want


def test_change_cause(spark):
    t, f = F.lit(True), F.lit(False)
    comp = lambda *n: F.array(*map(F.lit, n)).cast("array<string>")
    cases = [((f, f, t, comp(), f, f, f), "NO_CHANGE"), ((t, f, t, comp(), f, f, f), "SOURCE_CHANGED"), ((t, t, f, comp("X"), f, f, f), "UNDETERMINED"), ((t, t, t, comp("PARSER_CHANGED"), f, f, f), "PARSER_CHANGED"), ((t, t, t, comp("A", "B"), f, f, f), "MULTIPLE_CAUSES"), ((t, t, t, comp(), t, f, f), "UNDETERMINED"), ((t, t, t, comp(), f, f, t), "METADATA_ONLY_CHANGED")]
    got = one(spark, *[rules.change_cause(*a).alias(f"c{i}") for i, (a, _) in enumerate(cases)])
    assert list(got) == [w for _, w in cases]


# Candidates


def lookup(spark, records, name="drugol", total=None):
    body = json.dumps({"metadata": {"total_elements": len(records) if total is None else total}, "data": records})
    return spark.createDataFrame([(name, body)], "lookup_id string, body string")


def record(set_id="S1", version="3", ingredients=("Drugol",), **more):
    return {"setid": set_id, "spl_version": version, "title": "T", "published_date": "Jan 02, 2020", "active_ingredients": list(ingredients), "product_type": "HUMAN PRESCRIPTION DRUG LABEL", "status": "current", "labeler": "Maker", "marketing_category": "NDA", "dosage_form": "TABLET", "route": "ORAL"} | more


def select(spark, path, records, total=None):
    entries = spark.createDataFrame([("L", 1, "Drugol", "drugol")], "utilization_list_id string, rank int, ingredient_name string, normalized string")
    items, evidence, _ = Batches(Flows(spark, str(path)), None).decided(entries, lookup(spark, records, total=total))
    return items.first(), {(r.set_id, r.version, r.index): r for r in evidence.collect()}


def test_selection(spark, tmp_path):
    cases = [
        ([record(), record("S2", "2")], None, "SELECTED"),
        ([record(), record("S2", "3")], None, "MULTIPLE_EQUIVALENT_CANDIDATES"),
        ([record(ingredients=["Other"])], None, "NO_ACCEPTABLE_CANDIDATE"),
        ([], None, "NO_CANDIDATE"),
        ([record()], 120, "AMBIGUOUS_REQUIRES_REVIEW"),
        ([record(ingredients=["Other"])], 120, "NO_ACCEPTABLE_CANDIDATE"),
        ([record(), record()], None, "SELECTED"),
        ([record("S9", "9", repackaged=True), record()], None, "SELECTED"),
        ([record("S2", "9", ingredients=["ＤＲＵＧＯＬ "]), record("S1", "1")], None, "SELECTED"),
        ([record(), {"setid": "x"}], None, "METADATA_INVALID"),
        ("no JSON", None, "METADATA_INVALID"),
    ]
    # Every case once as it is and once backwards, each a list of its own.
    entries, bodies = [], []
    for k, (records, total, _) in enumerate(cases):
        for back in (0, 1):
            own = f"{k}x{back}"
            entries.append((f"L{k}/{back}", k + 1, f"Drugol{own}", f"drugol{own}"))
            body = records if isinstance(records, str) else json.dumps({"metadata": {"total_elements": len(records) if total is None else total}, "data": records[::-1] if back else records}, ensure_ascii=False)
            bodies.append((f"drugol{own}", body.replace("Drugol", f"Drugol{own}").replace("ＤＲＵＧＯＬ", f"ＤＲＵＧＯＬ{own}")))
    listed = spark.createDataFrame(entries, "utilization_list_id string, rank int, ingredient_name string, normalized string")
    items, _, _ = Batches(Flows(spark, str(tmp_path)), None).decided(listed, spark.createDataFrame(bodies, "lookup_id string, body string"))
    got = {r.utilization_list_id: r for r in items.collect()}
    for k, (_, _, want) in enumerate(cases):
        a, b = got[f"L{k}/0"], got[f"L{k}/1"]
        assert a.selection == b.selection == want, k
        assert a.ingestion == ("PENDING" if want == "SELECTED" else "NOT_SELECTED") and a.selected_index == b.selected_index


def test_classes(spark, tmp_path):
    cases = {
        "COMBINATION_PRODUCT": record("C", ingredients=["Drugol", "Other"]), "SALT_OR_FORM_VARIANT": record("F", ingredients=["drugol sodium"]), "NON_HUMAN_PRODUCT": record("N", product_type="ANIMAL DRUG"), "OTC_PRODUCT": record("O", product_type="HUMAN OTC DRUG"),
        "REPACKAGED_PRODUCT": record("R", labeler="Repackers Inc"), "ARCHIVED_OR_INACTIVE": record("A", status="inactive"), "MISSING_REQUIRED_METADATA": record("M", route=" "), "UNSUPPORTED_PRODUCT_TYPE": record("U", product_type="DEVICE"), "AMBIGUOUS": record("B", status="pending"),
    }
    _, evidence = select(spark, tmp_path, [*cases.values(), record("X", active_ingredient="ignored", active_ingredients=[{"name": " Drugol "}, 3])])
    found = {r.set_id: r for r in evidence.values()}
    for name, r in cases.items():
        assert name in found[r["setid"]].classes and not found[r["setid"]].accepted and found[r["setid"]].reasons
        assert found[r["setid"]].classes == [c for c in CANDIDATE_CLASSES if c in found[r["setid"]].classes]
    assert found["X"].accepted and found["X"].active == ["Drugol"]
    rows = files.candidates(lookup(spark, [record(), {"setid": "x"}, record(version=True), record(version=7)])).orderBy("index").collect()
    assert [r.invalid for r in rows] == [None, "version,title,published", "version", None]


def test_single_label(spark):
    kind = "set_id string, version string, title string, published string"
    rows = [("a", "2", "Eliquis (apixaban) tablet", "Jan 02, 2020"), ("A", "10", "ELIQUIS apixaban", "Jan 01, 2020"), ("b", "99", "apixaban generic", "Jan 01, 2020")]
    got = selection.single_label(spark.createDataFrame(rows, kind), "apixaban", "eliquis").first()
    assert (got.status, got.selected.version) == ("SELECTED", "10")
    assert selection.single_label(spark.createDataFrame(rows[2:] + [("c", "1", "Apixaban", "x")], kind), "apixaban", "eliquis").first().status == "AMBIGUOUS"
    assert selection.single_label(spark.createDataFrame(rows, kind), "warfarin", "x").first().status == "NOT_FOUND"


HEAD = {"schema_version": "1", "jurisdiction": "US", "measurement_year": 2020, "dataset_name": "D", "dataset_version": "1", "metric": "claims", "source_reference": "r", "source_status": "s"}


def ranked(list_id, *entries, **head):
    return json.dumps({"utilization_list_id": list_id, **HEAD, **head, "entries": [e if isinstance(e, dict) else {"rank": k, "ingredient_name": e} for k, e in enumerate(entries, 1)]})


def past(set_id, *versions):
    return json.dumps({"data": {"spl": {"setid": set_id, "title": "T"}, "history": [{"spl_version": v, "published_date": d} for v, d in versions]}})


def test_history_and_lists(spark, tmp_path):
    kind = "lookup_id string, set_id string, body string"
    good = past("SET", (4, "Jan 02, 2020"), (1, "Jan 02, 2019"))
    rows = files.history(spark.createDataFrame([("k", "set", good)], kind)).orderBy("position").collect()
    assert [(r.version, r.published, r.wrong) for r in rows] == [("4", date(2020, 1, 2), None), ("1", date(2019, 1, 2), None)]
    bad = [("a", "set", past("SET", (1, "2020-01-02"))), ("b", "set", past("SET", (1, "Jan 02, 2020"), (1, "Jan 02, 2020"))), ("c", "other", good), ("d", "set", past("SET")), ("e", "set", "no json"), ("f", "set", past("SET", (" ", "Jan 02, 2020")))]
    wrong = {r.lookup_id: r.wrong for r in files.history(spark.createDataFrame(bad, kind)).collect()}
    assert wrong == {"a": "entry without date", "b": "repeated version", "c": "other set id", "d": "no history", "e": "no history", "f": "entry without version"}
    entries = spark.createDataFrame([("l", v, k) for k, v in enumerate("4321")], "lineage_id string, version string, position int")
    got = lineage.history_gaps(spark.createDataFrame([("l", "1", "4"), ("l", "3", "4"), ("l", "4", "9")], "lineage_id string, old_version string, new_version string"), entries).orderBy("old_version").collect()
    assert [(r.history, r.adjacent, r.missing) for r in got] == [(-1, False, ["2", "3"]), (-1, True, []), (None, None, [])]
    (tmp_path / "l.json").write_text(ranked("L", "A", {"rank": 3, "ingredient_name": "ａ"}, {"rank": 0, "ingredient_name": " ", "metric_value": "x"}, metric=" "))
    (tmp_path / "m.json").write_text(ranked("M", "A", "B", {"rank": True, "ingredient_name": "C"}))
    (tmp_path / "n.json").write_text(ranked("N", "A", "B"))
    problems = {(r.utilization_list_id, r.problem) for r in files.list_problems(files.ranked_lists(spark, str(tmp_path))).collect()}
    assert {p for n, p in problems if n == "L"} == {"rank is not a positive number", "name is missing", "metric is not a number", "metric is missing", "repeated name", "ranks are not contiguous from 1"}
    assert ("M", "a boolean stands for a number") in problems and not any(n == "N" for n, _ in problems)


# Parser


def test_parse(spark):
    got = xml_documents.parse(V1)
    assert (got["set_id"], got["version"], got["effective"], got["generics"], got["ingredients"]) == ("SET-1", "1", date(2020, 1, 1), ["drugol"], ["DRUGOL"])
    assert [(p["brand"], p["form"], p["route"]) for p in got["products"]] == [("Brandex", "TABLET", "ORAL")]
    assert [(s["seq"], s["parent_seq"], s["depth"], s["heading"], s["text"], s["status"], s["xml_id"]) for s in got["sections"]] == [
        (0, None, 0, "1 INDICATIONS", "use it well", "PRESENT", "x0"), (1, 0, 1, "1.1 Adults", "for adults only", "PRESENT", "x1"), (2, None, 0, "4 CONTRAINDICATIONS", "never with milk", "PRESENT", None), (3, None, 0, "8.6 Renal impairment", "", "PRESENT_EMPTY", None), (4, None, 0, "Old words", "these words will go", "PRESENT", None),
    ]
    assert got["sections"][1]["locator"] == "/document[1]/component[1]/structuredBody[1]/component[1]/section[1]/component[1]/section[1]"
    assert xml_documents.flat_text(xml_documents.ET.fromstring("<t>a<item>b</item>c<br/>d <i>e</i>f</t>")) == "a b c d ef"
    assert xml_documents.parse(V1) == got


@pytest.mark.parametrize(("content", "category"), [
    (b"", "malformed_xml"), (b"<!DOCTYPE x><document/>", "malformed_xml"), (b"<a", "malformed_xml"), (b"<document/>", "unsupported_document_structure"),
    (V1.replace(b'value="20200101"', b'value="20201301"'), "unsupported_document_structure"), (V1.replace(b"<title>Drug label</title>", b""), "unsupported_document_structure"),
    (V1.replace(b"</document>", b"<component><structuredBody/></component></document>"), "unsupported_document_structure"),
])
def test_rejected(content, category):
    with pytest.raises(xml_documents.Rejected) as e:
        xml_documents.parse(content)
    assert e.value.category == category


def test_archive(spark):
    def packed(members):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            for name, body in members:
                z.writestr(name, body)
        return out.getvalue()

    rows = [(packed([("a.xml", "<x/>"), ("i.jpg", "j")]),), (packed([("../a.xml", "x")]),), (packed([("a.xml", "x"), ("b.xml", "y")]),), (b"no",), (None,)]
    got = files.sole_members(spark.createDataFrame(rows, "c binary"), "c").collect()
    assert (got[0].member, bytes(got[0].content)) == ("a.xml", b"<x/>") and all(g.member_error for g in got[1:4]) and got[4].member_error is None


# Store and flows


def raw(spark, *contents):
    return spark.createDataFrame([(f"f{k}", bytearray(c)) for k, c in enumerate(contents)], "path string, content binary")


@pytest.fixture(scope="module")
def flows(spark, tmp_path_factory):
    f = Flows(spark, str(tmp_path_factory.mktemp("store")))
    f.first = {r.outcome: r.n for r in f.ingest(raw(spark, V1, V2, b"<a", V1)).collect()}
    f.again = {r.outcome: r.n for r in f.ingest(raw(spark, V1)).collect()}
    f.clash = {r.outcome: r.n for r in f.ingest(raw(spark, V1.replace(b"milk", b"wine"))).collect()}
    history = json.dumps({"data": {"spl": {"setid": "SET-1"}, "history": [{"spl_version": "2", "published_date": "Feb 01, 2020"}, {"spl_version": "1", "published_date": "Jan 01, 2020"}]}})
    f.add_history(spark.createDataFrame([("k", "SET-1", history)], "lookup_id string, set_id string, body string"), "2020-03-01T00:00:00Z")
    return f


def test_ingest_is_idempotent(flows):
    assert flows.first == {"ALREADY_INGESTED": 1, "INGESTED": 2, "malformed_xml": 1} and flows.again == {"ALREADY_INGESTED": 1} and flows.clash == {"CONFLICT": 1}
    assert {n: flows.table(n).count() for n in ("documents", "sections", "products", "ingredients", "mappings", "statuses", "quarantine")} == {"documents": 2, "sections": 10, "products": 2, "ingredients": 2, "mappings": 6, "statuses": 40, "quarantine": 2}
    assert flows.integrity().count() == 0
    events = {(r.state, r.category): r.n for r in flows.table("ingestion_events").groupBy("state", "category").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert events == {("started", None): 6, ("succeeded", None): 4, ("failed", "malformed_xml"): 1, ("failed", "CONFLICT"): 1}
    kept = {r.category: bytes(r.content) for r in flows.table("quarantine").collect()}
    assert kept["malformed_xml"] == b"<a" and kept["CONFLICT"] == V1.replace(b"milk", b"wine")
    assert flows.count("documents") == 2 and flows.migrate() == flows.migrate() == 2
    with pytest.raises(ValueError, match="no table"):
        flows.count("elsewhere")


def test_statuses_and_reads(flows):
    d = flows.resolve("set-1", "1").first()
    assert d.status == "FOUND" and flows.resolve("set-1", "9").first().status == "NOT_FOUND"
    s = {r.concept: r.status for r in flows.table("statuses").where(F.col("document_id") == d.document_id).collect()}
    assert (s["indications_and_usage"], s["renal_impairment"], s["pregnancy"]) == ("PRESENT", "PRESENT_EMPTY", "ABSENT")
    assert [r.version for r in flows.search("BRAND").collect()] == ["2", "1"] and flows.search("nothing").count() == 0
    assert [r.seq for r in flows.sections(d.document_id, "contraindications").collect()] == [2] and flows.lineage_search("drugol").count() == 1


def test_diff(flows):
    pairs = flows.pairs()
    p = pairs.first()
    assert (p.old_version, p.new_version, p.ordering.status, p.ordering.confidence) == ("1", "2", "SOURCE_VERSION_ORDERED", "AUTHORITATIVE_HISTORY_ADJACENT")
    sections = flows.section_diffs(pairs)
    rows = {(r.old_seq, r.new_seq): r for r in sections.collect()}
    got = {k: (r.method, r.operations) for k, r in rows.items()}
    assert got == {
        (0, 1): ("XML_IDENTIFIER", ["SECTION_MOVED", "SECTION_RENAMED"]), (1, 2): ("XML_IDENTIFIER", ["NO_CHANGE"]), (2, 0): ("SECTION_CODE", ["SECTION_MODIFIED", "SECTION_MOVED"]),
        (3, 3): ("SOURCE_LOCATOR", ["NO_CHANGE"]), (4, None): ("UNMATCHED", ["SECTION_REMOVED"]), (None, 4): ("UNMATCHED", ["SECTION_ADDED"]),
    }
    s = flows.diff(pairs, sections).first()
    assert (s.matched, s.unmatched, s.added, s.removed, s.modified, s.moved, s.renamed, s.unchanged, s.metadata_changes) == (4, 2, 1, 1, 1, 2, 1, 2, 2)
    assert [(c.field, c.old_value, c.new_value) for c in s.changes] == [("source_instance_id", "doc-1", "doc-2"), ("effective_date", "2020-01-01", "2020-01-02")]
    assert s.operations == ["SECTION_ADDED", "SECTION_REMOVED", "SECTION_MODIFIED", "SECTION_MOVED", "SECTION_RENAMED", "DOCUMENT_METADATA_CHANGED"] and s.cause == "SOURCE_CHANGED"
    payload = json.loads(s.canonical)
    assert payload["generated_at"] is None and payload["old_provenance"]["retrieved_at"] is None and json.dumps(payload, ensure_ascii=False, sort_keys=True, separators=(",", ":")) == s.canonical
    chunks = [(r.operation, r.text) for r in flows.text_diffs(pairs, sections).where(F.col("index") == rows[2, 0]["index"]).orderBy("position").collect()]
    assert chunks == [("CONTEXT", "never with"), ("ADDITION", "cold"), ("CONTEXT", "milk")]


def test_causes_of_flows(flows):
    """Each provenance value of the new version put to that of the old one, but for what is asked for."""
    pairs = flows.pairs()
    assert pairs.first().old_metadata_sha256 != pairs.first().new_metadata_sha256
    fields = ("raw_sha256", "parser_version", "schema_version", "mapping_version", "version", "normalized_sha256", "metadata_sha256")

    def causes(*differ, missing=None):
        rows = pairs.withColumns({f"new_{f}": F.lit("other") if f in differ else F.col(f"old_{f}") for f in fields})
        rows = rows.withColumn(f"old_{missing}", F.lit(None).cast("string")) if missing else rows
        return flows.change_causes(rows).select("diff_id", F.array_join("components", "|").alias("components"), "cause")

    asked = {
        (): ("NO_CHANGE", "NO_CHANGE"), ("raw_sha256", "metadata_sha256"): ("SOURCE_CHANGED", "SOURCE_CHANGED"), ("mapping_version",): ("MAPPING_CHANGED", "MAPPING_CHANGED"), ("version",): ("UNDETERMINED", "UNDETERMINED"),
        ("normalized_sha256", "metadata_sha256"): ("UNDETERMINED", "UNDETERMINED"), ("metadata_sha256",): ("METADATA_ONLY_CHANGED", "METADATA_ONLY_CHANGED"), ("raw_sha256", "parser_version", "schema_version"): ("SOURCE_CHANGED|PARSER_CHANGED|SCHEMA_CHANGED", "MULTIPLE_CAUSES"),
    }
    for differ, want in asked.items():
        got = causes(*differ).first()
        assert (got.components, got.cause) == want, differ
    assert causes("raw_sha256", missing="parser_version").first().components == "UNDETERMINED"


def test_one_sided_diff(flows):
    pairs = flows.pairs()
    for gone, op, sections in (("old", "DOCUMENT_ADDED", "added"), ("new", "DOCUMENT_REMOVED", "removed")):
        one = pairs.withColumn(f"{gone}_document_id", F.lit(None).cast("string"))
        s = flows.diff(one).first()
        assert (s.operations[0], s[sections], s.matched, s.cause, s.changes) == (op, 5, 0, "SOURCE_CHANGED", []) and s.components == ["SOURCE_CHANGED"]


def test_stored_diffs_verify(spark, flows):
    pairs = flows.pairs()
    assert [r.outcome for r in flows.store_diffs(pairs, "2020-05-01T00:00:00Z").collect()] == ["NEW"]
    assert [r.outcome for r in flows.store_diffs(pairs, "2021-05-01T00:00:00Z").collect()] == ["SAME"]
    assert {n: flows.count(n) for n in ("diffs", "section_diffs", "edges")} == {"diffs": 1, "section_diffs": 6, "edges": 1}
    good = flows.verify_diffs(pairs, raw(spark, V1, V2)).first()
    assert good.verified and good.n_checks == 8
    bad = flows.verify_diffs(pairs, raw(spark, V1)).first()
    assert bad.failed == ["compared_source_documents"]
    other = Flows(spark, flows.store.path, flows.versions | {"diff": "section-diff/2"})
    assert other.verify_diffs(pairs, raw(spark, V1, V2)).first().failed == ["deterministic_diff_reproduction", "diff_engine_version"]
    assert flows.integrity().count() == 0


def test_verify(spark, flows):
    good = flows.verify(raw(spark, V1, V2)).collect()
    assert all(r.verified and r.n_checks == 7 for r in good)
    broken = {r.verified: r.failed for r in flows.verify(raw(spark, V1)).collect()}
    assert broken[True] == [] and broken[False] == ["deterministic_normalization", "raw_sha256"]


# Fetch and batches

BASE = "https://labels"


def packed(body):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("label.xml", body)
    return out.getvalue()


def service():
    answers = {
        "spls.json?drug_name=drugol&page=1&pagesize=100": {"metadata": {}, "data": [record("SET-1", "2"), record("SET-1", "1")]},
        "spls.json?drug_name=tied&page=1&pagesize=100": {"metadata": {}, "data": [record("A", "2", ["tied"]), record("B", "2", ["tied"])]},
        "spls.json?drug_name=malformed&page=1&pagesize=100": {"metadata": {}, "data": [record("A", "2", ["malformed"]), {"setid": "x"}]},
        "spls.json?drug_name=broken&page=1&pagesize=100": {"metadata": {}, "data": [record("BAD", "1", ["broken"])]},
        "spls.json?drug_name=gone&page=1&pagesize=100": {"metadata": {}, "data": [record("GONE", "1", ["gone"])]},
    }
    out = {k: json.dumps(v).encode() for k, v in answers.items()}
    out |= {"spls/SET-1.xml": V2, "spls/BAD.xml": b"<a", "spls/SET-1/history.json": past("SET-1", ("2", "Feb 01, 2020"), ("1", "Jan 01, 2020")).encode(), "getFile.cfm?type=zip&setid=SET-1&version=1": packed(V1)}
    return fetch.Recorded({f"{BASE}/{k}": v for k, v in out.items()})


def test_fetch_and_manifests(spark, tmp_path):
    f = Flows(spark, str(tmp_path / "s"))
    chosen = spark.createDataFrame([("SET-1", "1"), ("SET-1", "9")], "set_id string, version string")
    assert f.fetch_histories(chosen, BASE, service(), "2020-03-01T00:00:00Z").count() == 0
    assert [r.error for r in f.fetch_histories(spark.createDataFrame([("NONE",)], "set_id string"), BASE, service()).collect()] == [f"LookupError: 404 {BASE}/spls/NONE/history.json"]
    got = {r.version: (r.state, r.error) for r in f.fetch(chosen, BASE, service(), "2020-03-01T00:00:00Z", versions=True).collect()}
    assert got == {"1": ("FETCHED", None), "9": ("RAW_FETCH_FAILED", "the history has no such version")}
    assert [r.state for r in f.fetch(chosen.limit(1), BASE, service(), versions=True).collect()] == ["ALREADY_FETCHED"]
    row = f.table("raw").first()
    m = json.loads(row.manifest)
    assert bytes(row.content) == V1 and m["source_identity"]["source_version"] == "1" and m["retrieval"]["container_member"] == "label.xml" and m["history"]["raw_body_base64"]
    asked = spark.createDataFrame([("set-1", None), ("SET-1", "1"), ("SET-1", "2"), ("no", None), ("../x", None)], "set_id string, version string")
    assert {(r.asked_set, r.asked_version): r.error for r in f.resolved(asked).collect()} == {("set-1", None): None, ("SET-1", "1"): None, ("SET-1", "2"): "source_not_found", ("no", None): "source_not_found", ("../x", None): "unsafe name"}
    other = spark.createDataFrame([("SET-1", "1", bytearray(b"other"), "0" * 64, 200, {"a": "b"}, "u", None, None, None)], "set_id string, version string, content binary, raw_sha256 string, status int, headers map<string,string>, source_url string, container binary, member string, error string")
    clash = f.store_raw(other).first()
    assert clash.state == "RAW_HASH_CONFLICT" and clash.quarantine_id and [bytes(r.content) for r in f.table("quarantine").collect()] == [b"other"]
    assert f.export(str(tmp_path / "files")) == 3 and f.export(str(tmp_path / "files")) == 0
    assert (tmp_path / "files" / "SET-1" / "1" / "label.xml").read_bytes() == V1
    assert f.ingest(f.table("raw")).first().outcome == "INGESTED" and f.verify().first().verified
    wrong = spark.createDataFrame([("p", bytearray(V2), "SET-9", "2")], "path string, content binary, set_id string, version string")
    assert [r.outcome for r in f.ingest(wrong).collect()] == ["provenance_validation_failure"]
    kept = files.manifests(spark.createDataFrame([("[]",), ("{}",), (None,), (row.manifest.replace(m["source_identity"]["raw_sha256"], "xyz"),)], "manifest string")).collect()
    assert [r.manifest_error for r in kept][:1] + [r.manifest_error for r in kept][2:] == ["not a JSON object", "not a JSON object", "malformed hash"] and kept[1].manifest_error.startswith("missing")


def test_batch_stages(spark, tmp_path):
    (tmp_path / "l.json").write_text(ranked("L", "Drugol", "Tied", "Malformed", "Broken", "Gone", "Nowhere"))
    b = Batches(Flows(spark, str(tmp_path / "s")), service(), BASE)
    assert b.add_list(files.ranked_lists(spark, str(tmp_path / "l.json"))).count() == 0
    assert [(r.utilization_list_id, r.n_entries) for r in b.lists().collect()] == [("L", 6)]
    (tmp_path / "l.json").write_text(ranked("L", "Other"))
    assert [r.problem for r in b.add_list(files.ranked_lists(spark, str(tmp_path / "l.json"))).collect()] == ["another content under this id"]
    run = b.plan("L")
    states = lambda c: [r[c] for r in b.items(run).orderBy("rank").collect()]
    assert states("selection") == ["SELECTED", "MULTIPLE_EQUIVALENT_CANDIDATES", "METADATA_INVALID", "SELECTED", "SELECTED", "FETCH_FAILED"]
    assert states("discovery") == ["DISCOVERED", "DISCOVERED", "LOOKUP_FAILED", "DISCOVERED", "DISCOVERED", "LOOKUP_FAILED"] and states("retry") == [False, False, True, False, False, True]
    b.fetch("L", [1])
    assert states("ingestion") == ["FETCHED", "NOT_SELECTED", "NOT_SELECTED", "PENDING", "PENDING", "NOT_SELECTED"]
    whole = b.run("L").first()
    assert states("ingestion") == ["INGESTED", "NOT_SELECTED", "NOT_SELECTED", "PARSER_FAILED", "RAW_FETCH_FAILED", "NOT_SELECTED"]
    assert states("verification") == ["VERIFIED"] + ["NOT_VERIFIED"] * 5 and states("compatibility")[0] == "PARSED_WITH_UNMAPPED_SECTIONS" and states("n_sections")[0] == 5
    got = b.runs(run).first()
    assert (got.status, got.total, got.selected, got.fetched, got.ingested, got.verified, got.quarantined, got.unresolved, got.failed) == ("PARTIAL_FAILURE", 6, 3, 1, 1, 1, 1, 1, 4)
    assert got.artifact_sha256 == whole.sha256 and json.loads(whole.canonical)["batch_run"]["started_at"] is None
    later = Batches(Flows(spark, str(tmp_path / "s")), service(), BASE, "2022-01-01T00:00:00Z")
    assert later.report(run).first().canonical == whole.canonical and later.flows.count("batch_artifacts") == 1
    audit = [(r.set_id, r.version, r.selected) for r in b.candidates("ＤＲＵＧＯＬ").collect()]
    assert sorted(audit) == [("SET-1", "1", False), ("SET-1", "2", True)]
    assert b.flows.count("lookup_failures") >= 2 and b.flows.integrity().count() == 0
    dated = later.flows.versions_of().first()
    assert (dated.published, dated.published_source) == (date(2020, 1, 2), "SELECTION_METADATA")


def content_rows(r, spark):
    names = [f"Straße{k}" if k % 9 == 0 else f"word-{k}'s" if k % 7 == 0 else f"w{k}" for k in range(80)]
    rows = []
    for pair in range(6):
        bases = [r.choices(names, k=r.choice((1, 2, 12, 40))) for _ in range(6)]
        for side in ("old", "new"):
            for k, base in enumerate(bases + [[]]):
                for c in range(r.choice((1, 2))):
                    words = [r.choice(names) if r.random() < 0.04 else w for w in base]
                    rows.append((pair, side, f"{side}{k}{c}", r.choice(("Head A", "HEAD  a", "other", None)), r.randrange(3), r.choice(("; ", " ", " <= ")).join(words).upper() if r.random() < 0.3 else " ".join(words), r.choice("pq"), r.choice("pq"), 0))
    return rows


def test_content_scores_are_those_of_all_pairs(spark):
    import random
    import re
    from difflib import SequenceMatcher

    rows = content_rows(random.Random(4), spark)
    kind = "pair_id int, side string, section_id string, heading string, depth int, text string, parent_code string, parent_heading string, parent_depth int"
    got = {(x.pair_id, x.old_id, x.new_id): x.score for x in matching.content_scores(spark.createDataFrame(rows, kind)).collect()}
    word = re.compile(r"[^\W_]+(?:[-'][^\W_]+)*|[<>]=?|=")
    plain = lambda a, b: SequenceMatcher(a=a, b=b, autojunk=False).ratio()
    head = lambda h: re.sub(r"\s+", " ", (h or "").strip().casefold())
    want = {}
    for p, _, old, h1, d1, t1, *parent1 in (x for x in rows if x[1] == "old"):
        for q, _, new, h2, d2, t2, *parent2 in (x for x in rows if x[1] == "new" and x[0] == p):
            a, b = word.findall(t1.casefold()), word.findall(t2.casefold())
            score = 0.94 * plain(a, b) + 0.04 * plain(head(h1), head(h2)) + 0.02 * (parent1 == parent2) if a or b else 0.0
            if abs(d1 - d2) <= 1 and score >= 0.92:
                want[p, old, new] = score
    assert len(want) > 20 and got.keys() == want.keys() and all(abs(got[k] - v) < 1e-9 for k, v in want.items())


def test_folding(spark):
    texts = ["Straße ẞ", "İı Σςσ", "ŉ ﬁ ᾳ", "K Å µ ſ", "ꭰ Ꭰ", "plain ASCII", ""]
    got = [r.f for r in spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string").orderBy("k").select(text.folded(F.col("t")).alias("f")).collect()]
    assert got == [t.casefold() for t in texts]


def test_content_phase_and_margin(spark):
    words = " ".join(f"word{k}" for k in range(60))
    rows = [(1, "old", f"o{k}", None, k, None, None, f"/o{k}", f"head {k}", 0, t) for k, t in enumerate((words, "twin a b c d e f g h i j k l m n o p q r s t", "alone"))]
    rows += [(1, "new", f"n{k}", None, k, None, None, f"/n{k}", f"head {k + 3}", d, t) for k, (t, d) in enumerate(((words.replace("word7 ", "other "), 1), ("twin a b c d e f g h i j k l m n o p q r s t", 0), ("twin a b c d e f g h i j k l m n o p q r s t", 0), (words, 3)))]
    sections = spark.createDataFrame(rows, "pair_id int, side string, section_id string, parent_id string, seq int, xml_id string, code string, locator string, heading string, depth int, text string")
    got = {(r.old_id, r.new_id): (r.method, r.status) for r in matching.outcomes(matching.match_sections(sections).select("pair_id", "side", "section_id", "partner", "method")).collect()}
    assert got[("o0", "n0")] == ("CONTENT_ASSISTED", "HEURISTIC") and ("o1", None) in got and (None, "n1") in got and ("o2", None) in got and (None, "n3") in got


def test_phase_keys_must_be_single(spark):
    rows = [(1, s, f"{s}{k}", key) for s in ("old", "new") for k, key in enumerate(["a", "a", "b", None] if s == "old" else ["a", "b", "c", None])]
    got = matching.exact_phases(spark.createDataFrame(rows, "pair_id int, side string, section_id string, k string"), {"P": F.col("k")})
    assert {(r.section_id, r.partner) for r in got.where("partner IS NOT NULL").collect()} == {("old2", "new1"), ("new1", "old2")}


def test_text_chunks():
    got = list(textdiff.chunks_of("a b c d".split(), "a x c d e".split()))
    assert got == [("CONTEXT", ["a"], 0, 1, 0, 1), ("DELETION", ["b"], 1, 2, 1, 1), ("ADDITION", ["x"], 2, 2, 1, 2), ("CONTEXT", ["c", "d"], 2, 4, 2, 4), ("ADDITION", ["e"], 4, 4, 4, 5)]
    assert "-a" in diff.unified(["a"], ["b"], "o", "n") and list(textdiff.chunks_of([], [])) == []


def plain_chunks(old, new):
    """By the standard library's differ."""
    for tag, a, b, c, d in SequenceMatcher(a=old, b=new, autojunk=False).get_opcodes():
        if tag == "equal":
            yield "CONTEXT", old[a:b], a, b, c, d
        if tag in ("delete", "replace"):
            yield "DELETION", old[a:b], a, b, c, c
        if tag in ("insert", "replace"):
            yield "ADDITION", new[c:d], b, b, c, d


def edited(r, words, n):
    out = list(words)
    for _ in range(n):
        k = r.randrange(len(out) + 1)
        out[k : k + r.randrange(3)] = r.choices("abcde", k=r.randrange(3))
    return out


def test_blocks_are_those_of_the_differ():
    r = random.Random(8)
    for _ in range(1500):
        old = r.choices("abcdefgh"[: r.randrange(1, 9)], k=r.randrange(30))
        new = edited(r, old, r.randrange(6)) if r.random() < 0.7 else r.choices("abcd", k=r.randrange(30))
        assert list(textdiff.chunks_of(old, new)) == list(plain_chunks(old, new))
        a, b = textdiff.coded(old, new)
        runs = lambda meet: sorted(zip(*(x.tolist() for x in textdiff.diagonal_runs(a, b, meet)), strict=True))
        assert runs(3) == runs(10**6)


def test_long_pairs_are_split(spark):
    r = random.Random(9)
    rows = []
    for k in range(12):
        old = r.choices([f"w{x}" for x in range(30)], k=r.randrange(1, 80))
        new = edited(r, old, r.randrange(12)) if k % 3 else r.choices([f"w{x}" for x in range(40)], k=r.randrange(1, 80))
        rows.append((k, "p", " ".join(old), "\n".join(new)))
    rows += [(90, "p", None, "a b"), (91, "p", "a", ""), (94, "p", "".join(f"x{chr(c)}" for c in range(0x3100)), "".join(f"x{chr(c)}y " for c in range(0x3100) if c % 7 == 0)), (92, "p", "x " * 40, "x " * 50), (93, "p", " ".join(map(str, range(40))), " ".join(map(str, range(50, 90))))]
    pairs = spark.createDataFrame(rows, "index int, pair_id string, old_text string, new_text string")
    want = {(k, p, *c[:1], " ".join(c[1]), *c[2:]) for k, _, old, new in rows for p, c in enumerate(plain_chunks((old or "").split(), (new or "").split()))}
    for area in (10**9, 400):
        got = [(x["index"], x.position, x.operation, x.text, x.old_start, x.old_end, x.new_start, x.new_end) for x in textdiff.text_chunks(pairs, ["pair_id", "index"], area).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_relational(spark):
    tree = spark.createDataFrame([("a", None, False), ("b", "a", False), ("c", "b", True), ("d", "a", False)], "n string, p string, f boolean")
    assert {r.n for r in relational.subtree_any(tree, "n", "p", "f").where("f").collect()} == {"a", "b", "c"}
    log = spark.createDataFrame([(1, 1, "x"), (1, 3, "y"), (2, 2, "z")], "k int, at int, v string")
    assert {(r.k, r.v) for r in store.current(log, ["k"], ["at"], ["v"]).collect()} == {(1, "y"), (2, "z")}
    old, new = (spark.createDataFrame(x, "k int, h string") for x in ([(1, "a"), (2, "b"), (3, "c")], [(2, "b"), (3, "X"), (4, "d")]))
    assert {r.k: r.outcome for r in store.compared(old, new, ["k"], "h").collect()} == {1: "KEPT", 2: "SAME", 3: "CONFLICT", 4: "NEW"}
    bad = store.violations(old.union(old.limit(1)), "t", unique=[["k"]], checks={"k small": F.col("k") < 3}, references={"other": (["k"], new, ["k"])})
    assert {r.rule for r in bad.collect()} == {"unique(k)", "k small", "other"}


def test_subtrees_by_intervals(spark):
    r = random.Random(4)
    rows, flags = [], {}
    for tree in range(6):
        parents = [None] + [r.randrange(k) if r.random() < 0.8 else k - 1 for k in range(1, 25)]
        order, below = [], {k: [c for c, p in enumerate(parents) if p == k] for k in range(25)}

        def walk(k, order=order, below=below):
            order.append(k)
            for c in below[k]:
                walk(c)
            return k

        walk(0)
        at = {k: i for i, k in enumerate(order)}
        own = {k: r.random() < 0.15 for k in range(25)}
        deep = lambda k, below=below: [k, *(x for c in below[k] for x in deep(c))]
        for k in range(25):
            rows.append((tree, at[k], max(at[x] for x in deep(k)), own[k]))
            flags[tree, at[k]] = any(own[x] for x in deep(k))
    got = relational.interval_any(spark.createDataFrame(rows, "t int, a int, b int, f boolean"), "t", "a", "b", "f")
    assert {(x.t, x.a): x.f for x in got.collect()} == flags


def deep_document(n):
    return document("1", "<component><section><id root='a'/><text>t</text>" * n + "</section></component>" * n)


def test_ids_are_scanned_in_bounded_memory(spark):
    import tracemalloc

    body = "".join(section("34067-9", "t", "word " * 200, section(None, "in", "x", root=f"b{k}"), root=f"a{k}") for k in range(200))
    peaks = []
    for times in (1, 12):
        content = document("1", body * times)
        tracemalloc.start()
        n = sum(1 for _ in xml_documents.scanned(content))
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        assert n == 400 * times
    assert peaks[1] < 1.3 * peaks[0] + 200_000
    assert [s["locator"] for s in xml_documents.parse(deep_document(300))["sections"]] == [at for at, _ in xml_documents.scanned(deep_document(300))]
    files_ = raw(spark, V1, b"<a", b"", document("2", "<structuredBody/>"))
    got = xml_documents.section_ids(files_)
    assert sorted(x.error for x in got.where("error IS NOT NULL").collect()) == ["malformed_xml", "malformed_xml", "unsupported_document_structure"]
    want = [(s["seq"], s["locator"], s["xml_id"]) for s in xml_documents.parse(V1)["sections"]]
    assert sorted((x.seq, x.locator, x.xml_id) for x in got.where("error IS NULL").collect()) == want


def test_threads_release_their_own(spark):
    from concurrent.futures import ThreadPoolExecutor

    from labeldiff import scratch

    since = scratch.mark()
    with ThreadPoolExecutor(1) as other:
        theirs = other.submit(lambda: scratch.held(spark.range(3))).result()
        mine = scratch.held(spark.range(4))
        scratch.release(since)
        assert theirs.count() == 3 and scratch.mark() == since
        other.submit(scratch.release).result()
    with pytest.raises(Exception, match="(?i)not.exist|not_exist|cannot"):
        mine.count()


def test_changed_paths(spark):
    r = random.Random(6)

    def tree(depth):
        return {"attributes": [["a", r.choice("xy")]], "children": [tree(depth - 1) for _ in range(r.randrange(4))] if depth else [], "tag": r.choice("pq"), "tail": r.choice([None, "t"]), "text": r.choice([None, "é", "u"])}

    def edit(n):
        n = n | {"children": [edit(x) for x in n["children"] if r.random() < 0.95]}
        if r.random() < 0.1:
            n["text"] = "new"
        if r.random() < 0.05:
            n["children"] = [*n["children"], tree(1)]
        return n

    def plain(old, new, path=""):
        if any(old[x] != new[x] for x in structure.OWN):
            yield path, "CHANGED"
        for k in range(max(len(old["children"]), len(new["children"]))):
            a, b = (x["children"][k] if k < len(x["children"]) else None for x in (old, new))
            if a is None or b is None:
                yield f"{path}/{k}", "ADDED" if a is None else "REMOVED"
            else:
                yield from plain(a, b, f"{path}/{k}")

    pairs = [(k, t, edit(t)) for k, t in enumerate(tree(4) for _ in range(40))]
    made = lambda t: json.dumps(t, ensure_ascii=False, sort_keys=True, separators=(",", ":"))
    rows = [(k, made(a), made(b)) for k, a, b in pairs] + [(90, None, made(tree(1))), (91, made(tree(1)), None), (92, None, None)]
    got = structure.changed_paths(spark.createDataFrame(rows, "k int, old string, new string"), ["k"])
    want = {(k, *x) for k, a, b in pairs for x in plain(a, b)} | {(90, "", "ADDED"), (91, "", "REMOVED")}
    assert len(want) > 40 and {tuple(x) for x in got.collect()} == want and got.count() == len(want)


def test_store_inserts(spark, tmp_path):
    s = store.Store(spark, str(tmp_path))
    rows = lambda *x: spark.createDataFrame(list(x), "k int, h string")
    assert [r.outcome for r in s.insert("t", rows((1, "a"), (1, "a")), "k int, h string", ["k"], "h").distinct().collect()] == ["NEW"]
    assert {r.k: r.outcome for r in s.insert("t", rows((1, "b"), (2, "c")), "k int, h string", ["k"], "h").collect()} == {1: "CONFLICT", 2: "NEW"}
    assert [tuple(r) for r in s.table("t", "k int, h string").collect()] == [(1, "a")]
    s.insert("t", rows((2, "c")), "k int, h string", ["k"], "h")
    assert s.table("t", "k int, h string").count() == 2
    rows((9, "z")).write.parquet(f"{tmp_path}/t/uncommitted")
    assert s.table("t", "k int, h string").count() == 2
    target = str(tmp_path / "raw" / "x.xml")
    assert files.write_once(target, b"a") and not files.write_once(target, b"a")
    with pytest.raises(ValueError, match="raw_hash_conflict"):
        files.write_once(target, b"b")


def test_rollup(spark):
    kind = "run int, rank int, discovery string, selection string, ingestion string, verification string"
    rows = [(1, 1, "DISCOVERED", "SELECTED", "INGESTED", "VERIFIED"), (1, 2, "DISCOVERED", "AMBIGUOUS_REQUIRES_REVIEW", "NOT_SELECTED", "NOT_VERIFIED"), (2, 1, "DISCOVERED", "SELECTED", "PARSER_FAILED", "NOT_VERIFIED"), (2, 2, "DISCOVERED", "SELECTED", "INGESTED", "VERIFIED"), (3, 1, "LOOKUP_FAILED", "FETCH_FAILED", "NOT_SELECTED", "NOT_VERIFIED"), (4, 1, "DISCOVERED", "SELECTED", "FETCHED", "NOT_VERIFIED"), (5, 1, "DISCOVERED", "SELECTED", "INGESTED", "VERIFIED")]
    got = {r.run: r.status for r in batch.rollup(spark.createDataFrame(rows, kind), ["run"]).collect()}
    assert got == {1: "COMPLETED_WITH_UNRESOLVED_ITEMS", 2: "PARTIAL_FAILURE", 3: "FAILED", 4: "RUNNING", 5: "COMPLETED"}


def test_cli_and_stream(spark, tmp_path):
    for v, content in (("1", V1), ("2", V2)):
        d = tmp_path / "raw" / "SET-1" / v
        d.mkdir(parents=True)
        (d / "label.xml").write_bytes(content)
    call = lambda *words: cli.run(["--store", str(tmp_path / "s"), "--service", BASE, *words], spark, service(), "2020-01-01T00:00:00Z")
    code, out = call("ingest", str(tmp_path / "raw"))
    assert code == 0 and out == [{"outcome": "INGESTED", "n": 2}]
    hits = call("search", "drugol")[1]
    assert hits[0]["version"] == "2" and call("show", hits[0]["document_id"], "--concept", "contraindications")[1]["sections"][0]["seq"] == 0
    assert call("show", "nothing")[0] == 1
    code, out = call("diff", "--set-id", "SET-1", "--from-version", "1", "--to-version", "2", "--text")
    assert code == 0 and out["summary"][0]["added"] == 1 and out["chunks"] and "+never with cold milk" in out["unified"][0]["unified"] and "added: 1" in cli.as_text(out)
    assert call("diff", "--set-id", "SET-1", "--from-version", "1", "--to-version", "7")[0] == 1
    assert call("diff", "--old", hits[0]["document_id"])[1]["category"] == "malformed_metadata"
    assert call("compact") == (0, [{"commits": 1}]) and call("integrity") == (0, []) and call("count", "documents")[1] == [{"table": "documents", "n": 2}]
    assert call("count", "nothing")[0] == 1 and len(call("history", "set-1")[1]["versions"]) == 2
    query = ingest.watch(spark, str(tmp_path / "raw"), str(tmp_path / "streamed"), str(tmp_path / "checkpoint"))
    query.awaitTermination(120)
    assert Flows(spark, str(tmp_path / "streamed")).table("documents").count() == 2


def test_cli_batch(spark, tmp_path):
    (tmp_path / "l.json").write_text(ranked("L", "Drugol", "Missing"))
    call = lambda *words: cli.run(["--store", str(tmp_path / "s"), "--service", BASE, *words], spark, service(), "2020-01-01T00:00:00Z")
    assert call("batch", "status", "L")[0] == 1
    assert call("utilization", "add", str(tmp_path / "l.json"))[0] == 0 and [e["rank"] for e in call("utilization", "show", "L")[1]] == [1, 2]
    code, out = call("batch", "run", "L")
    assert code == 2 and [i["verification"] for i in out["items"]] == ["VERIFIED", "NOT_VERIFIED"] and out["run"][0]["status"] == "PARTIAL_FAILURE" and out["report"]
    assert len(call("candidates", "drugol")[1]) == 2 and call("fetch", "SET-1", "1")[0] == 0 and call("ingest")[1] == [{"outcome": "ALREADY_INGESTED", "n": 1}, {"outcome": "INGESTED", "n": 1}]


# Runs that survive


def test_open_runs_are_closed(spark, tmp_path, monkeypatch):
    f = Flows(spark, str(tmp_path / "s"))
    states = lambda: [(r.path, r.state, r.category) for r in f.table("ingestion_events").orderBy("path", "seq").collect()]
    with monkeypatch.context() as m:
        m.setattr(xml_documents, "parsed", lambda *a, **b: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            f.ingest(raw(spark, V1, V2))
    names = [r.path for r in raw(spark, V1, V2).orderBy("path").collect()]
    assert states() == [(n, "started", None) for n in names] and f.count("documents") == 0
    assert f.recover().count() == 2 and f.recover().count() == 0
    assert states() == [x for n in names for x in ((n, "started", None), (n, "failed", "interrupted"))]
    f.ingest(raw(spark, V1))
    assert "succeeded" in {s for _, s, _ in states()} and f.recover().count() == 0 and f.count("documents") == 1


def test_parts_of_an_older_schema_are_read(spark, tmp_path):
    f = Flows(spark, str(tmp_path / "s"))
    old = f.table("sections").drop("leave_seq")
    row = spark.range(1).select(*[F.lit("s" if x.name == "section_id" else None).cast(x.dataType).alias(x.name) for x in old.schema])
    f.store.commit({"sections": row, "schema": spark.range(1).select(F.lit(1).cast("int").alias("version"), F.current_timestamp().alias("at"))})
    assert f.migrate() == 2 and f.table("schema").count() == 2 and f.migrate() == 2 and f.table("schema").count() == 2
    f.commit(sections=f.table("sections").withColumns({"section_id": F.lit("t"), "leave_seq": F.lit(3)}))
    assert {(r.section_id, r.leave_seq) for r in f.table("sections").collect()} == {("s", None), ("t", 3)}


def test_commits_that_change_or_dangle_are_refused(spark, tmp_path):
    f = Flows(spark, str(tmp_path / "s"))
    made = lambda name, **values: f.spark.range(1).select(*[F.lit(values.get(x.name)).cast(x.dataType).alias(x.name) for x in f.table(name).schema])
    lists = made("lists", utilization_list_id="L", sha256="1")
    discovery = made("discoveries", discovery_id="d", utilization_list_id="L", raw_sha256="r")
    decision = lambda status: made("decisions", decision_id="x", discovery_id="d", status=status, sha256=status)
    with pytest.raises(Refused, match="nothing is stored: discoveries L"):
        f.commit(discoveries=discovery, decisions=decision("SELECTED"))
    assert f.store.commits() == [] and not list((tmp_path / "s" / "discoveries").iterdir())
    f.commit(lists=lists, discoveries=discovery, decisions=decision("SELECTED"))
    f.commit(discoveries=discovery, decisions=decision("SELECTED"))
    with pytest.raises(Refused, match="another content is stored: decisions x"):
        f.commit(decisions=decision("NO_CANDIDATE"), lists=made("lists", utilization_list_id="M", sha256="2"))
    with pytest.raises(Refused, match="decisions y"):
        f.commit(decisions=decision("A").union(decision("B")).withColumn("decision_id", F.lit("y")))
    assert [r.status for r in f.table("decisions").collect()] == ["SELECTED"] and f.count("lists") == 1
    with pytest.raises(Refused, match="sections doc"):
        f.commit(sections=made("sections", section_id="s", document_id="doc"))
    with pytest.raises(Refused, match="edges"):
        f.commit(edges=made("edges", edge_id="e", old_document_id="doc"))
    assert f.count("sections") == 0 and f.integrity().count() == 0


def many(names):
    """A service in which every name has one document."""
    out = {f"{BASE}/spls.json?drug_name={n}&page=1&pagesize=100": json.dumps({"metadata": {}, "data": [record(n.upper(), "2", [n])]}).encode() for n in names}
    return out | {f"{BASE}/spls/{n.upper()}.xml": document("2", set_id=n.upper()) for n in names}


class Deadly(fetch.Recorded):
    """Ends the Python worker at one address: a failure of the job, not of the request."""

    def __call__(self, url, accept):
        if url.endswith("/CC.xml"):
            os._exit(3)
        return super().__call__(url, accept)


def test_an_item_that_breaks_its_job_stands_alone(spark, tmp_path):
    (tmp_path / "l.json").write_text(ranked("L", "aa", "bb", "cc", "dd"))
    b = Batches(Flows(spark, str(tmp_path / "s")), Deadly(many(["aa", "bb", "cc", "dd"])), BASE)
    b.add_list(files.ranked_lists(spark, str(tmp_path / "l.json")))
    run = b.fetch("L")
    got = {r["rank"]: (r.ingestion, r.retry) for r in b.items(run).collect()}
    assert got == {1: ("FETCHED", False), 2: ("FETCHED", False), 3: ("RAW_FETCH_FAILED", True), 4: ("FETCHED", False)}
    healed = Batches(Flows(spark, str(tmp_path / "s")), fetch.Recorded(many(["aa", "bb", "cc", "dd"])), BASE)
    assert [r.ingestion for r in healed.items(healed.fetch("L")).orderBy("rank").collect()] == ["FETCHED"] * 4


KILLED = """
import sys, time
sys.path[:0] = [{root!r}]
from pyspark.sql import SparkSession
from labeldiff.plans.batches import Batches
from labeldiff.plans.flows import Flows
from labeldiff.sources import fetch, files
from tests.test_core import BASE, many

class Slow(fetch.Recorded):
    def __call__(self, url, accept):
        if url.endswith("/CC.xml"):
            open({mark!r}, "w").close()
            time.sleep(600)
        return super().__call__(url, accept)

spark = SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "2").config("spark.ui.enabled", "false").getOrCreate()
calls = Slow(many(["aa", "cc", "dd"]))
b = Batches(Flows(spark, {store!r}), calls, BASE)
b.add_list(files.ranked_lists(spark, {names!r}))
b.plan("L")
Batches(b.flows, calls, BASE, group=1).fetch("L")
"""


def test_a_killed_fetch_keeps_what_is_finished(spark, tmp_path):
    root = str(Path(__file__).resolve().parent.parent)
    (tmp_path / "l.json").write_text(ranked("L", "aa", "cc", "dd"))
    mark, store = tmp_path / "mark", str(tmp_path / "s")
    job = subprocess.Popen([sys.executable, "-c", KILLED.format(root=root, mark=str(mark), store=store, names=str(tmp_path / "l.json"))], cwd=root, start_new_session=True)
    try:
        until = time.time() + 300
        while not mark.exists() and job.poll() is None and time.time() < until:
            time.sleep(0.5)
    finally:
        os.killpg(job.pid, signal.SIGKILL)
        job.wait()
    assert mark.exists()
    b = Batches(Flows(spark, store), fetch.Recorded(many(["aa", "cc", "dd"])), BASE)
    run = b.run_id("L")
    assert [r.ingestion for r in b.items(run).orderBy("rank").collect()] == ["FETCHED", "PENDING", "PENDING"] and b.flows.count("raw") == 1
    assert b.flows.integrity().count() == 0
    assert [r.ingestion for r in b.items(b.fetch("L")).orderBy("rank").collect()] == ["FETCHED"] * 3
    assert b.flows.table("batch_items").where("ingestion = 'FETCHED'").count() == 3
