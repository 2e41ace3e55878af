"""Hashes, name-based ids and canonical JSON as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from labeldiff.values import NAMESPACE


def sha256(value: Column) -> Column:
    """Lower-case hex of the exact bytes (UTF-8 of a string)."""
    return F.sha2(value.cast("binary"), 256)


def uuid5(name: Column, namespace: str = NAMESPACE) -> Column:
    """RFC 4122 version 5: SHA-1 of namespace and name, with the version and variant bits set."""
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace.replace("-", ""))), name.cast("binary")))

    def written(h: Column) -> Column:
        variant = F.substring(F.lit("89ab"), F.conv(F.substring(h, 17, 1), 16, 10).cast("int") % 4 + 1, F.lit(1))
        piece = lambda at, n: F.substring(h, at, n)
        return F.concat(piece(1, 8), F.lit("-"), piece(9, 4), F.lit("-5"), piece(14, 3), F.lit("-"), variant, piece(18, 3), F.lit("-"), piece(21, 12))

    # The digest is bound once: ids are made of ids, and each level would repeat it six times over.
    return F.transform(F.array(digest), written)[0]


def named(kind: str, *parts: Column) -> Column:
    """The id of ``kind|part|part...``; a null part is empty."""
    return uuid5(F.concat_ws("|", F.lit(kind), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))


def canonical_json(**values: Column) -> Column:
    """A flat object with sorted keys, no spaces, nulls kept, non-ASCII as it is and lower-case escapes of control characters."""
    return canonical(**values)


def fields(**values: Column) -> Column:
    """A nested object: a struct whose fields are sorted."""
    return F.struct(*[values[k].alias(k) for k in sorted(values)])


def rendered(value: Column) -> Column:
    """Canonical JSON of a struct made by ``fields``; nulls are kept."""
    return lower_escapes(F.to_json(value, {"ignoreNullFields": "false"}))


def canonical(**values: Column) -> Column:
    """Canonical JSON of nested values: structs made by ``fields``, arrays of them, scalars."""
    return rendered(fields(**values))


#: What says when or from where something was made, by the kind of artifact that leaves it out.
VOLATILE = {"normalized": ("source_identity.retrieved_at", "source_identity.source_url"), "diff": ("generated_at", "old_provenance.retrieved_at", "new_provenance.retrieved_at"), "report": ("generated_at", "batch_run.started_at", "batch_run.completed_at", "batch_run.canonical_report_sha256")}


def steady(value: Column, kind: str, drop: bool = False) -> Column:
    """A struct without the volatile fields of its kind: set to null, or dropped."""
    for path in VOLATILE[kind]:
        value = value.dropFields(path) if drop else value.withField(path, F.lit(None).cast("string"))
    return value


def lower_escapes(text: Column) -> Column:
    """Escapes \\u000A to \\u001F with lower-case digits; an escaped backslash before "u" is left alone."""
    for digit in "ABCDEF":
        text = F.regexp_replace(text, rf"(?<!\\)((?:\\\\)*)\\u00([01]){digit}", rf"$1\\u00$2{digit.lower()}")
    return text


# The ids of the store, by what they identify.


def source_record_id(authority: Column, provider: Column, jurisdiction: Column, document: Column, version: Column, raw_sha256: Column) -> Column:
    return uuid5(canonical_json(authority=authority, provider=provider, jurisdiction=jurisdiction, source_document_id=document, source_version=version, raw_sha256=raw_sha256))


def document_id(source_record: Column, parser: Column, schema: Column, mapping: Column) -> Column:
    return uuid5(F.concat_ws("|", source_record, parser, schema, mapping))


def section_id(document: Column, locator: Column, digest: Column) -> Column:
    return named("section", document, locator, digest)


def product_id(document: Column, index: Column, brand: Column, form: Column, route: Column) -> Column:
    return named("product", document, index, brand, form, route)


def ingredient_id(folded_name: Column) -> Column:
    return named("ingredient", folded_name)


def mapping_id(section: Column, concept: Column, version: Column) -> Column:
    return named("mapping", section, concept, version)


def lineage_id(authority: Column, provider: Column, jurisdiction: Column, document: Column) -> Column:
    return named("lineage", canonical_json(authority=authority, provider=provider, jurisdiction=jurisdiction, source_document_id=document))


def snapshot_id(lineage: Column, raw_sha256: Column) -> Column:
    return named("history", lineage, raw_sha256)


def edge_id(lineage: Column, old: Column, new: Column) -> Column:
    return named("edge", lineage, old, new)


def diff_id(old: Column, new: Column, engine: Column) -> Column:
    return named("diff", old, new, engine)


def section_diff_id(diff: Column, index: Column) -> Column:
    return named("section-diff", diff, index)


def discovery_id(list_id: Column, ingredient: Column, connector: Column, raw_sha256: Column) -> Column:
    return named("candidate-discovery", list_id, ingredient, connector, raw_sha256)


def candidate_id(discovery: Column, folded_set_id: Column, version: Column, metadata_sha256: Column, index: Column) -> Column:
    return named("label-candidate", discovery, folded_set_id, version, metadata_sha256, index)


def decision_id(discovery: Column, rule: Column) -> Column:
    return named("candidate-decision", discovery, rule)


def batch_run_id(list_id: Column, rule: Column, connector: Column, parser: Column, schema: Column, mapping: Column) -> Column:
    return named("batch-run", list_id, rule, connector, parser, schema, mapping)


def batch_artifact_id(run: Column, report: Column, digest: Column) -> Column:
    return named("batch-artifact", run, report, digest)


def quarantine_id(run: Column, ingredient: Column, stage: Column, raw_sha256: Column) -> Column:
    return named("quarantine", run, ingredient, stage, F.coalesce(raw_sha256, F.lit("unknown")))
