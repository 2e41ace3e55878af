"""Structured product documents (HL7 v3 XML) to normalized rows, one pass over each document.

Guards come first: size, document type declarations and entities, hash of the bytes. A document that cannot be read
gives an error row with a category instead of failing the job. A row of a good document holds its header, products,
names, and its sections in document order with locator, depth, parent, text, structure and hash; the child tables are
plain projections of it (``children``).
"""

from __future__ import annotations

import hashlib
import json
import re
import xml.etree.ElementTree as ET
from collections.abc import Iterator
from datetime import datetime
from functools import lru_cache
from json.encoder import encode_basestring

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labeldiff.functions import identity, rules, text
from labeldiff.operators import relational
from labeldiff.values import CONCEPTS, MAX_BYTES, TEXT_BLOCKS, VERSIONS

#: Namespace of the documents.
NS = "urn:hl7-org:v3"
#: Bytes of documents whose rows leave a task together.
BATCH_BYTES = 2_000_000
#: Bytes that the scan for ids reads at once.
SCAN_BYTES = 65_536
_DECLARED = re.compile(rb"<!\s*(?:DOCTYPE|ENTITY)\b", re.I)

SECTION = "struct<seq:int,parent_seq:int,depth:int,code:string,heading:string,text:string,status:string,locator:string,xml_id:string,structure:string,comparison:string,sha256:string,leave_seq:int,filled:boolean,parent_locator:string,parent_sha256:string>"
PRODUCT = "struct<seq:int,brand:string,form:string,route:string>"
PARSED = f"path string, raw_sha256 string, n_bytes long, set_id string, version string, document_root string, title string, doc_type string, language string, effective date, generic_name string, generics array<string>, ingredients array<string>, products array<{PRODUCT}>, sections array<{SECTION}>, normalized_sha256 string, error string, message string"


class Rejected(Exception):
    """A document that gives an error row."""

    def __init__(self, category: str, message: str):
        super().__init__(message)
        self.category = category


def canonical(value: object) -> str:
    return json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":"), allow_nan=False)


@lru_cache(maxsize=4096)
def local_name(tag: str) -> str:
    return tag.rpartition("}")[2]


def local(node: ET.Element) -> str:
    return local_name(node.tag) if isinstance(node.tag, str) else ""


def squeezed(text: str | None) -> str | None:
    return " ".join((text or "").split()) or None


def flat_text(node: ET.Element | None) -> str | None:
    """Text in source order; block elements are set apart by spaces. An explicit stack, so depth does not matter."""
    if node is None:
        return None
    out, todo = [], [(node, False)]
    while todo:
        item, plain = todo.pop()
        if plain:
            out.append(item)
            continue
        out.append(item.text or "")
        for child in reversed(item):
            gap = " " if local(child) in TEXT_BLOCKS else ""
            todo += [(gap + (child.tail or ""), True), (child, False), (gap, True)]
    return squeezed("".join(out))


def child(node: ET.Element, name: str) -> ET.Element | None:
    return next((c for c in node if local(c) == name), None)


def attribute(node: ET.Element | None, *names: str) -> str | None:
    return next((v for n in names if (v := ((node.get(n) if node is not None else None) or "").strip())), None)


def distinct(values) -> list[str]:
    """First spellings, whatever the case, in order."""
    seen: dict[str, str] = {}
    for v in values:
        if v and v.strip():
            seen.setdefault(v.casefold(), v)
    return list(seen.values())


def quoted(value: str | None) -> str:
    return "null" if value is None else encode_basestring(value)


def structures(node: ET.Element, locator: str) -> tuple[str, str]:
    """Canonical JSON of the structure below a node, with locators and (for comparison) without, in one walk. An explicit stack, so depth does not matter."""
    located, plain = [], []
    todo: list = [(node, locator, "")]
    while todo:
        item = todo.pop()
        if isinstance(item[0], str):
            located.append(item[0])
            plain.append(item[1])
            continue
        n, at, comma = item
        head = f'{comma}{{"attributes":{canonical(sorted([k, v] for k, v in n.attrib.items())) if n.attrib else "[]"},"children":['
        rest = f'"tag":{quoted(local(n))},"tail":{quoted(squeezed(n.tail))},"text":{quoted(squeezed(n.text))}}}'
        located.append(head)
        plain.append(head)
        todo.append((f'],"locator":{quoted(at)},{rest}', f"],{rest}"))
        if len(n):
            counts: dict[str, int] = {}
            below = []
            for c in n:
                name = local(c)
                counts[name] = counts.get(name, 0) + 1
                below.append((c, f"{at}/{name}[{counts[name]}]", "," if below else ""))
            todo += below[::-1]
    return "".join(located), "".join(plain)


def ordinal(node: ET.Element, above: dict[ET.Element, ET.Element]) -> str:
    """The locator of a node: on each level the ordinal among siblings of the same local name."""
    steps = []
    while node in above:
        same = [c for c in above[node] if local(c) == local(node)]
        steps.append(f"/{local(node)}[{same.index(node) + 1}]")
        node = above[node]
    return "".join([f"/{local(node)}[1]", *reversed(steps)])


def components(node: ET.Element, at: str, parent: int | None, depth: int) -> list[tuple[ET.Element, str, int | None, int]]:
    """The sections within the components below a node, in order, as ``sections_of`` takes them up."""
    found, k = [], 0
    for c in node:
        if local(c) == "component":
            k += 1
            inner = [s for s in c if local(s) == "section"]
            found += [(s, f"{at}/component[{k}]/section[{i}]", parent, depth) for i, s in enumerate(inner, 1)]
    return found


def sections_of(root: ET.Element, above: dict[ET.Element, ET.Element]) -> list[dict]:
    bodies = list(root.iter(f"{{{NS}}}structuredBody"))
    if len(bodies) > 1:
        raise Rejected("unsupported_document_structure", "more than one structuredBody")
    out: list[dict] = []
    todo = components(bodies[0], ordinal(bodies[0], above), None, 0)[::-1] if bodies else []
    while todo:
        node, at, parent, depth = todo.pop()
        first: dict[str, ET.Element] = {}
        for c in node:
            first.setdefault(local(c), c)
        body, identifier = first.get("text"), first.get("id")
        text = flat_text(body) or ""
        structure, comparison = structures(body, f"{at}/text[1]") if body is not None else (None, None)
        row = {
            "seq": len(out), "parent_seq": parent, "depth": depth, "code": attribute(first.get("code"), "code"), "heading": flat_text(first.get("title")), "text": text,
            "status": "TEXT_ELEMENT_ABSENT" if body is None else "PRESENT" if text else "PRESENT_EMPTY", "locator": at,
            "xml_id": attribute(identifier, "root") if identifier is not None and str(node.tag).startswith(f"{{{NS}}}") else None, "structure": structure, "comparison": comparison,
        }
        content = f'{{"original_heading":{quoted(row["heading"])},"original_text":{quoted(text)},"source_section_code":{quoted(row["code"])},"structured_content":{structure or "null"}}}'
        row["sha256"] = hashlib.sha256(content.encode()).hexdigest()
        out.append(row)
        todo += components(node, at, row["seq"], depth + 1)[::-1]
    return out


def products_of(root: ET.Element, above: dict[ET.Element, ET.Element]) -> list[dict]:
    out = []
    for node in root.iter():
        if local(node) not in ("manufacturedProduct", "manufacturedMedicine"):
            continue
        brand, form = flat_text(child(node, "name")), attribute(child(node, "formCode"), "displayName", "code")
        if not brand or form is None and all(local(n) != "genericMedicine" for n in node.iter()):
            continue
        subject = node
        while subject in above and local(subject) != "subject":
            subject = above[subject]
        routes = distinct(attribute(n, "displayName", "code") for n in subject.iter() if local(n) == "routeCode")
        out += [{"seq": len(out) + k, "brand": brand, "form": form, "route": route} for k, route in enumerate(routes or [None])]
    return out


def parse(content: bytes) -> dict:
    """The normalized document, or Rejected."""
    if not content:
        raise Rejected("malformed_xml", "empty document")
    if len(content) > MAX_BYTES:
        raise Rejected("malformed_xml", "document exceeds the size limit")
    if _DECLARED.search(content):
        raise Rejected("malformed_xml", "document type and entity declarations are refused")
    try:
        root = ET.fromstring(content)
    except ET.ParseError as e:
        raise Rejected("malformed_xml", str(e)) from e
    if root.tag != f"{{{NS}}}document":
        raise Rejected("unsupported_document_structure", "the root is not a document of the namespace")
    own = lambda name: root.find(f"{{{NS}}}{name}")
    ids = {"document_root": attribute(own("id"), "root"), "set_id": attribute(own("setId"), "root"), "version": attribute(own("versionNumber"), "value"), "title": flat_text(own("title"))}
    for name, value in ids.items():
        if not value:
            raise Rejected("unsupported_document_structure", f"{name} is required")
    day, effective = attribute(own("effectiveTime"), "value"), None
    if day is not None:
        try:
            effective = datetime.strptime(day, "%Y%m%d").date() if re.fullmatch(r"\d{8}", day) else None
        except ValueError:
            pass
        if effective is None:
            raise Rejected("unsupported_document_structure", "effectiveTime is not a date")
    above = {c: p for p in root.iter() for c in p}
    generics = distinct(flat_text(child(n, "name")) for n in root.iter() if local(n) == "genericMedicine")
    active = distinct(flat_text(child(s, "name")) for n in root.iter() if local(n) == "ingredient" and n.get("classCode") in ("ACTIB", "ACTIM") for s in n.iter() if local(s) == "ingredientSubstance")
    out = ids | {"doc_type": attribute(own("code"), "displayName", "code"), "language": attribute(own("languageCode"), "code"), "effective": effective, "generics": generics, "generic_name": next(iter(generics), None), "ingredients": active, "products": products_of(root, above), "sections": sections_of(root, above)}
    whole = {k: v.isoformat() if k == "effective" and v else v for k, v in out.items()}
    digest = hashlib.sha256(canonical(whole).encode()).hexdigest()
    # Whether a section or one below it has text: children follow their parents, so one pass backwards tells.
    filled = [s["status"] == "PRESENT" for s in out["sections"]]
    for s in reversed(out["sections"]):
        if s["parent_seq"] is not None and filled[s["seq"]]:
            filled[s["parent_seq"]] = True
    # The last section of each subtree: with seq, the interval of the tree that a stored section stands for.
    leave = list(range(len(filled)))
    for s in reversed(out["sections"]):
        if s["parent_seq"] is not None:
            leave[s["parent_seq"]] = max(leave[s["parent_seq"]], leave[s["seq"]])
    # What a parent's id is made of travels with its children, so that no row has to look into the whole document again.
    above = [out["sections"][s["parent_seq"]] if s["parent_seq"] is not None else {} for s in out["sections"]]
    rows = [s | {"leave_seq": e, "filled": f, "parent_locator": a.get("locator"), "parent_sha256": a.get("sha256")} for s, e, f, a in zip(out["sections"], leave, filled, above, strict=True)]
    return out | {"sections": rows, "normalized_sha256": digest}


def parsed(files: DataFrame, expected: str | None = None, asked: tuple[str, str] | None = None) -> DataFrame:
    """files (path, content and, if named, a column with the expected hash, and columns with the set id and version that were asked for) to one row each: the document, or an error category and message."""
    spark_schema = files.sparkSession.createDataFrame([], PARSED).schema
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(spark_schema)
    names = [f.name for f in spark_schema]
    # Dealt by path: parsing costs far more than moving the bytes, and a file of one large row group is one task.
    rows = files.repartition(F.col("path")).select("path", "content", *[(F.col(c) if c else F.lit(None).cast("string")).alias(n) for n, c in (("expected", expected), ("asked_set", asked and asked[0]), ("asked_version", asked and asked[1]))])

    def read(path: str, content: bytes, want: str | None, set_id: str | None, version: str | None) -> dict:
        row = dict.fromkeys(names) | {"path": path, "raw_sha256": hashlib.sha256(content).hexdigest(), "n_bytes": len(content)}
        try:
            if want is not None and want != row["raw_sha256"]:
                raise Rejected("provenance_validation_failure", "the bytes do not have the recorded hash")
            found = parse(content)
            if set_id is not None and set_id.casefold() != found["set_id"].casefold() or version is not None and version != found["version"]:
                raise Rejected("provenance_validation_failure", "the document is not the one that was asked for")
            return row | found
        except Rejected as e:
            return row | {"error": e.category, "message": str(e)}
        except RecursionError:
            return row | {"error": "unsupported_document_structure", "message": "nested too deeply"}

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for path, content, *asked_for in zip(*(c for c in batch.columns), strict=True):
                content = content.as_py() or b""
                held.append(read(path.as_py(), content, *(x.as_py() for x in asked_for)))
                size += len(content)
                if size >= BATCH_BYTES:
                    yield pa.RecordBatch.from_pylist(held, schema=arrow)
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_pylist(held, schema=arrow)

    return rows.mapInArrow(run, PARSED)


def scanned(content: bytes) -> Iterator[tuple[str, str | None]]:
    """(locator, id) of every section that has its place in a structuredBody, in order, by pull parsing: what has been read is dropped, so memory goes with depth and not with size."""
    if _DECLARED.search(content):
        raise Rejected("malformed_xml", "document type and entity declarations are refused")
    parser, bodies = ET.XMLPullParser(("start", "end")), 0
    open_: list[list] = []  # per open element: local name, ordinals of its children, locator, row of its section, element

    def events() -> Iterator[tuple[str, ET.Element]]:
        try:
            for at in range(0, len(content), SCAN_BYTES):
                parser.feed(content[at : at + SCAN_BYTES])
                yield from parser.read_events()
            parser.close()
            yield from parser.read_events()
        except ET.ParseError as e:
            raise Rejected("malformed_xml", str(e)) from e

    waiting: list[list] = []  # sections in order whose id may still come
    for event, node in events():
        name = local(node)
        if event == "start":
            above = open_[-1] if open_ else None
            if above is None:
                if node.tag != f"{{{NS}}}document":
                    raise Rejected("unsupported_document_structure", "the root is not a document of the namespace")
                where = f"/{name}[1]"
            else:
                above[1][name] = above[1].get(name, 0) + 1
                where = f"{above[2]}/{name}[{above[1][name]}]"
            body = node.tag == f"{{{NS}}}structuredBody"
            bodies += body
            if bodies > 1:
                raise Rejected("unsupported_document_structure", "more than one structuredBody")
            # A component counts in a body or a section, a section in such a component.
            inside = body or above is not None and (name == "component" and above[3] in ("body", "section") or name == "section" and above[3] == "component")
            kind = "body" if body else name if inside else ""
            row = [where, None, False] if kind == "section" else None
            if row:
                waiting.append(row)
            elif name == "id" and above is not None and above[3] == "section" and above[1]["id"] == 1 and str(above[4].tag).startswith(f"{{{NS}}}"):
                above[5][1] = attribute(node, "root")
            open_.append([name, {}, where, kind, node, row])
        else:
            *_, row = open_.pop()
            if row:
                row[2] = True
            if open_:
                open_[-1][4].remove(node)
            # Rows leave in document order once every section before them has ended its own head.
            if not any(o[3] == "section" for o in open_):
                yield from ((at, found) for at, found, _ in waiting)
                waiting.clear()


def section_ids(files: DataFrame) -> DataFrame:
    """files (path, content) to (path, seq, locator, xml_id, error): the sections' ids by a scan that keeps neither texts nor tree. A document that cannot be read is one row with an error category."""
    schema = "path string, seq int, locator string, xml_id string, error string"

    def run(batches):
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                content = content.as_py() or b""
                try:
                    if not content or len(content) > MAX_BYTES:
                        raise Rejected("malformed_xml", "empty or beyond the size limit")
                    found = [(k, at, i, None) for k, (at, i) in enumerate(scanned(content))]
                except Rejected as e:
                    found = [(None, None, None, e.category)]
                seq, at, ids, error = zip(*found, strict=True) if found else ((), (), (), ())
                yield pa.RecordBatch.from_arrays([pa.array([path.as_py()] * len(found), pa.string()), pa.array(seq, pa.int32()), *(pa.array(x, pa.string()) for x in (at, ids, error))], names=["path", "seq", "locator", "xml_id", "error"])

    return files.repartition(F.col("path")).select("path", "content").mapInArrow(run, schema)


def section_hash(heading: Column, body: Column, code: Column, structure: Column) -> Column:
    """The hash of a stored section from its fields, as ``sections_of`` makes it; structure is canonical JSON or null."""
    head = identity.canonical(original_heading=heading, original_text=body, source_section_code=code)
    return identity.sha256(F.concat(F.substring(head, F.lit(1), F.length(head) - 1), F.lit(',"structured_content":'), F.coalesce(structure, F.lit("null")), F.lit("}")))


def children(documents: DataFrame, authority: str = "FDA", provider: str = "DailyMed", jurisdiction: str = "US", versions: dict[str, str] = VERSIONS) -> dict[str, DataFrame]:
    """The normalized tables of parsed documents: documents, sections, products, ingredients, mappings, statuses, errors."""
    lit = F.lit
    errors = documents.where("error IS NOT NULL").select("path", "raw_sha256", "n_bytes", F.col("error").alias("category"), "message")
    record = identity.source_record_id(lit(authority), lit(provider), lit(jurisdiction), F.col("set_id"), F.col("version"), F.col("raw_sha256"))
    good = documents.where("error IS NULL").withColumn("source_id", record).withColumn("document_id", identity.document_id(F.col("source_id"), lit(versions["parser"]), lit(versions["schema"]), lit(versions["mapping"]))).withColumn("lineage_id", identity.lineage_id(lit(authority), lit(provider), lit(jurisdiction), F.col("set_id")))
    parent = F.when(F.col("parent_seq").isNotNull(), identity.section_id(F.col("document_id"), F.col("parent_locator"), F.col("parent_sha256")))
    sections = good.select("path", "document_id", "lineage_id", F.inline("sections")).withColumns({"section_id": identity.section_id(F.col("document_id"), F.col("locator"), F.col("sha256")), "parent_id": parent}).drop("filled", "parent_locator", "parent_sha256")
    mapped = sections.select("path", "document_id", "section_id", "seq", rules.concept(F.col("code"), F.col("heading")).alias("m")).where("m IS NOT NULL").select("path", "document_id", "section_id", "seq", "m.*")
    mappings = mapped.withColumn("mapping_id", identity.mapping_id(F.col("section_id"), F.col("concept"), lit(versions["mapping"])))
    products = good.select("path", "document_id", F.inline("products")).withColumn("product_id", identity.product_id(F.col("document_id"), F.col("seq"), F.col("brand"), F.col("form"), F.col("route")))
    ingredients = good.select("document_id", F.posexplode("ingredients").alias("seq", "name")).withColumn("ingredient_id", identity.ingredient_id(text.folded(F.col("name"))))
    named = {n: text.first_spellings(F.col(f"products.{f}")) for n, f in (("brands", "brand"), ("forms", "form"), ("routes", "route"))}
    header = good.withColumns(named).drop("sections", "products", "error", "message")
    return {"documents": header, "sections": sections, "products": products, "ingredients": ingredients, "mappings": mappings, "statuses": concept_statuses(good.select("path", "document_id", "sections")), "errors": errors}


def concept_statuses(documents: DataFrame) -> DataFrame:
    """(path, document_id, concept, status) of every document and concept: ABSENT, PRESENT if a mapped section or one below it has text, else PRESENT_EMPTY. Decided within the document's own array, without a join."""
    mapped = F.transform("sections", lambda x: F.struct(rules.concept(x["code"], x["heading"])["concept"].alias("c"), x["filled"].alias("f")))
    rows = documents.select("path", "document_id", mapped.alias("m"))
    each = rows.select("path", "document_id", "m", F.explode(F.array(*map(F.lit, CONCEPTS))).alias("concept"))
    own = F.filter("m", lambda m: m["c"] == F.col("concept"))
    status = F.when(F.size(own) == 0, "ABSENT").when(F.exists(own, lambda m: m["f"]), "PRESENT").otherwise("PRESENT_EMPTY")
    return each.select("path", "document_id", "concept", status.alias("status"))


def stored_statuses(documents: DataFrame, sections: DataFrame, mappings: DataFrame) -> DataFrame:
    """The same from stored rows: (document_id, concept, status) of documents (document_id), by the intervals of their sections' subtrees."""
    full = relational.interval_any(sections.select("document_id", "section_id", "seq", "leave_seq", (F.col("status") == "PRESENT").alias("_text")), "document_id", "seq", "leave_seq", "_text")
    found = mappings.select("section_id", "concept").join(full, "section_id").groupBy("document_id", "concept").agg(F.bool_or("_text").alias("_f"))
    each = documents.select("document_id", F.explode(F.array(*map(F.lit, CONCEPTS))).alias("concept")).join(found, ["document_id", "concept"], "left")
    return each.select("document_id", "concept", F.when(F.col("_f").isNull(), "ABSENT").when(F.col("_f"), "PRESENT").otherwise("PRESENT_EMPTY").alias("status"))
