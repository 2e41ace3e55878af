"""Decision tables as column expressions: concepts, candidate classes, change causes, version order, states."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from labeldiff.functions import text
from labeldiff.values import ALIASES, CANDIDATE_CLASSES, CODE_CONCEPTS, FAILED, FETCHED, HEADING_CONCEPTS, INGESTED, MATCHES, OPERATIONS, REJECTIONS, SELECTION_ERRORS, UNRESOLVED


def looked_up(key: Column, table: Mapping[str, str]) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), key)


def listed(flags: Mapping[str, Column]) -> Column:
    """The names whose flag holds, in the mapping's order."""
    return F.array_compact(F.array(*[F.when(flag, F.lit(name)) for name, flag in flags.items()]))


def concept(code: Column, heading: Column) -> Column:
    """struct(concept, method): by code, else by heading; null if neither is known."""
    by_code, by_heading = looked_up(code, CODE_CONCEPTS), looked_up(text.mapped_heading(heading), HEADING_CONCEPTS)
    found = F.struct(F.coalesce(by_code, by_heading).alias("concept"), F.when(by_code.isNotNull(), "loinc_code_exact").otherwise("normalized_heading_exact").alias("method"), F.lit(1.0).alias("confidence"))
    return F.when(F.coalesce(by_code, by_heading).isNotNull(), found)


def required(fields: Mapping[str, Column]) -> Column:
    """Names of the fields that are null or empty."""
    return listed({k: v.isNull() | (v.cast("string") == "") for k, v in fields.items()})


def classes(active: Column, original: Column, normalized: Column, active_normalized: Column, kind: Column, labeler: Column, category: Column, status: Column, form: Column, route: Column, repackaged: Column, duplicate: Column) -> Column:
    """All classes of a candidate, in report order. active: array of ingredient names; active_normalized: the normalized first one."""
    low = lambda c: F.lower(F.coalesce(c, F.lit("")))
    has = lambda c, *terms: F.greatest(*[F.contains(low(c), F.lit(t)) for t in terms], F.lit(False))
    single = F.size(active) == 1
    exact = single & (F.lower(F.trim(active[0])) == F.lower(F.trim(original)))
    same = single & (active_normalized == normalized)
    salt = single & (F.startswith(active_normalized, F.concat(normalized, F.lit(" "))) | F.startswith(active_normalized, F.concat(normalized, F.lit("-"))))
    present = lambda c: c.isNotNull() & (c != "")
    animal = has(kind, "animal", "veterinary", "non-human")
    otc = ~animal & has(kind, "human") & has(kind, "over-the-counter", "otc")
    prescription = ~animal & ~otc & has(kind, "human") & has(kind, "prescription")
    archived = has(status, "archived", "inactive", "discontinued")
    missing = (F.size(active) < 1) | ~(present(kind) & present(status) & present(labeler) & present(category) & present(form) & present(route))
    flags = {
        "EXACT_SINGLE_INGREDIENT_MATCH": exact,
        "SINGLE_INGREDIENT_NORMALIZED_MATCH": ~exact & same,
        "COMBINATION_PRODUCT": F.size(active) > 1,
        "WRONG_INGREDIENT": single & ~exact & ~same & ~salt,
        "SALT_OR_FORM_VARIANT": ~exact & ~same & salt,
        "NON_HUMAN_PRODUCT": animal,
        "OTC_PRODUCT": otc,
        "PRESCRIPTION_PRODUCT": prescription,
        "REPACKAGED_PRODUCT": F.coalesce(repackaged, F.lit(False)) | has(labeler, "repack") | has(category, "repack"),
        "ARCHIVED_OR_INACTIVE": archived,
        "MISSING_REQUIRED_METADATA": missing,
        "DUPLICATE_CANDIDATE": F.coalesce(duplicate, F.lit(False)),
        "UNSUPPORTED_PRODUCT_TYPE": ~animal & ~otc & ~prescription & present(kind),
        "AMBIGUOUS": ~archived & present(status) & ~has(status, "current", "active"),
    }
    return listed({k: F.coalesce(flags[k], F.lit(False)) for k in CANDIDATE_CLASSES})


def accepted(found: Column) -> Column:
    """A match that is a prescription product and has no excluding class."""
    return F.arrays_overlap(found, F.array(*map(F.lit, MATCHES))) & F.array_contains(found, "PRESCRIPTION_PRODUCT") & ~F.arrays_overlap(found, F.array(*map(F.lit, REJECTIONS)))


def reasons(found: Column) -> Column:
    """One sentence per excluding class, in report order."""
    return F.array_compact(F.transform(found, lambda c: looked_up(c, REJECTIONS)))


def change_components(sides: Sequence[tuple[str, Column, Column]]) -> Column:
    """Names of the (name, old, new) that differ, in order."""
    return listed({name: ~old.eqNullSafe(new) for name, old, new in sides})


def change_cause(has_old: Column, has_new: Column, complete: Column, components: Column, version_differs: Column, normalized_differs: Column, metadata_differs: Column) -> Column:
    """Why two versions differ. complete: all provenance values of both sides are there."""
    return (
        F.when(~has_old & ~has_new, "NO_CHANGE")
        .when(~has_old | ~has_new, "SOURCE_CHANGED")
        .when(~complete, "UNDETERMINED")
        .when(F.size(components) > 1, "MULTIPLE_CAUSES")
        .when(F.size(components) == 1, components[0])
        .when(version_differs | normalized_differs, "UNDETERMINED")
        .when(metadata_differs, "METADATA_ONLY_CHANGED")
        .otherwise("NO_CHANGE")
    )


def causes(cause: Column, components: Column) -> Column:
    """The components of a change: those that were found if there are several, else the cause itself, whatever it is."""
    return F.when(cause == "MULTIPLE_CAUSES", components).otherwise(F.array(cause))


def version_order(version: Column, history: Column, effective: Column, publication: Column, retrieved: Column, adjacent: Column) -> Column:
    """struct(status, source, confidence, known, possible) from five directions (-1, 0, 1 or null) and history adjacency."""
    signals = F.filter(F.array(version, history, effective, publication), lambda x: x.isNotNull() & (x != 0))
    is_ = lambda c: F.coalesce(c == -1, F.lit(False))
    near = F.coalesce(adjacent, F.lit(False))
    conflict = F.array_contains(signals, 1)
    by_source = is_(version) | is_(history)

    def out(status: str, source: Column, confidence: Column, known: Column) -> Column:
        return F.struct(F.lit(status).alias("status"), source.alias("source"), confidence.alias("confidence"), known.alias("known"), (~known).alias("possible"))

    confidence = F.when(near, "AUTHORITATIVE_HISTORY_ADJACENT").when(is_(history), "AUTHORITATIVE_HISTORY_WITH_INTERMEDIATES").when(F.size(signals) > 1, "MULTIPLE_SOURCE_FIELDS_AGREE").otherwise("SOURCE_VERSION_ONLY")
    dates = F.when(F.coalesce(publication, F.lit(0)) == 0, "DATE_ONLY").otherwise("DATES_AGREE")
    no = F.lit(False)
    return (
        F.when(conflict, out("ORDER_CONFLICT", F.lit("conflicting_source_fields"), F.lit("CONFLICT"), no))
        .when(by_source, out("SOURCE_VERSION_ORDERED", F.when(is_(history), "dailymed_history").otherwise("source_version"), confidence, near))
        .when(is_(effective), out("EFFECTIVE_DATE_ORDERED", F.lit("effective_date"), dates, near))
        .when(is_(publication), out("PUBLICATION_DATE_ORDERED", F.lit("publication_date"), F.lit("DATE_ONLY"), near))
        .when(is_(retrieved), out("INGESTION_ORDER_ONLY", F.lit("retrieved_at"), F.lit("INGESTION_METADATA_ONLY"), no))
        .when(F.coalesce(retrieved == 1, no), out("ORDER_CONFLICT", F.lit("retrieved_at"), F.lit("INGESTION_DIRECTION_CONFLICT"), no))
        .otherwise(out("ORDER_UNDETERMINED", F.lit("none"), F.lit("UNDETERMINED"), no))
    )


def in_order(names: Column, order: Sequence[str] = OPERATIONS) -> Column:
    """The distinct names, in the given order."""
    return F.filter(F.array(*map(F.lit, order)), lambda x: F.array_contains(names, x))


def selection_error(status: Column) -> Column:
    return looked_up(status, SELECTION_ERRORS)


def parser_failure(category: Column) -> Column:
    """struct(compatibility, ingestion) of a failed parse."""
    pair = lambda a, b: F.struct(F.lit(a).alias("compatibility"), F.lit(b).alias("ingestion"))
    return F.when(category == "unsupported_document_structure", pair("PARSED_WITH_UNSUPPORTED_STRUCTURES", "UNSUPPORTED_STRUCTURE")).when(category == "database_failure", pair("PARTIAL_PARSE", "DATABASE_FAILED")).otherwise(pair("PARSER_FAILED", "PARSER_FAILED"))


def compatibility(unmapped: Column, empty: Column) -> Column:
    return F.when((unmapped == 0) & (empty == 0), "FULLY_PARSED").otherwise("PARSED_WITH_UNMAPPED_SECTIONS")


def batch_status(total: Column, verified: Column, failed: Column) -> Column:
    """Of a run whose items are all done."""
    return F.when(verified == total, "COMPLETED").when(failed == total, "FAILED").when(failed > 0, "PARTIAL_FAILURE").otherwise("COMPLETED_WITH_UNRESOLVED_ITEMS")


def exit_code(status: Column, trouble: Column) -> Column:
    """trouble: any error, review flag or quarantine id of a running batch."""
    return F.when(status == "FAILED", 1).when(status.isin("PARTIAL_FAILURE", "COMPLETED_WITH_UNRESOLVED_ITEMS"), 2).when((status == "RUNNING") & trouble, 2).otherwise(0)


def fetched(status: Column) -> Column:
    return status.isin(*FETCHED)


def ingested(status: Column) -> Column:
    return status.isin(*INGESTED)


def unresolved(selection: Column) -> Column:
    return selection.isin(*UNRESOLVED)


def failed(discovery: Column, ingestion: Column, verification: Column) -> Column:
    return (discovery.isin("LOOKUP_FAILED", "METADATA_INVALID")) | ingestion.isin(*FAILED) | (verification == "FAILED")


def candidate_fields(meta: Column) -> dict[str, Column]:
    """Typed fields of free-form candidate metadata (a variant)."""
    return {name: text.first_text(meta, names) for name, names in ALIASES.items()}
