"""Section operations, movement, summaries, metadata changes and unified texts of version pairs."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from labeldiff.functions.rules import in_order, listed
from labeldiff.values import LINE_WORDS, OPERATIONS


def rank_moves(matches: DataFrame, group: list[str], old_order: str = "old_seq", new_order: str = "new_seq") -> DataFrame:
    """matches with ``reordered``: whether a matched section's rank among matched siblings differs. One shuffle, two sorts."""
    rank = lambda order: F.row_number().over(Window.partitionBy(*group).orderBy(order))
    return matches.withColumn("reordered", rank(old_order) != rank(new_order))


def with_movement(matches: DataFrame) -> DataFrame:
    """matches (pair_id, old_id, new_id, old_parent, new_parent, old_seq, new_seq) with ``moved``."""
    to = matches.select("pair_id", F.col("old_id").alias("old_parent"), F.col("new_id").alias("_mapped"))
    joined = rank_moves(matches.join(to, ["pair_id", "old_parent"], "left"), ["pair_id", "old_parent", "new_parent"])
    both_roots = F.col("old_parent").isNull() & F.col("new_parent").isNull()
    elsewhere = ~both_roots & ~F.col("_mapped").eqNullSafe(F.col("new_parent"))
    return joined.withColumn("moved", elsewhere | F.col("reordered")).drop("_mapped", "reordered")


def operations(has_old: Column, has_new: Column, modified: Column, moved: Column, renamed: Column, remapped: Column) -> Column:
    """Operations of one section, in report order."""
    no = F.lit(False)
    changed = F.coalesce(modified, no) | F.coalesce(moved, no) | F.coalesce(renamed, no) | F.coalesce(remapped, no)
    both = has_old & has_new
    return listed({
        "SECTION_ADDED": ~has_old & has_new,
        "SECTION_REMOVED": has_old & ~has_new,
        "SECTION_MODIFIED": both & F.coalesce(modified, no),
        "SECTION_MOVED": both & F.coalesce(moved, no),
        "SECTION_RENAMED": both & F.coalesce(renamed, no),
        "SECTION_MAPPING_CHANGED": both & F.coalesce(remapped, no),
        "NO_CHANGE": both & ~changed,
    })


def summary(sections: DataFrame, keys: list[str]) -> DataFrame:
    """Ten counts per key over section rows with old_id, new_id, method, status and operations: one partial aggregate."""
    has = lambda op: F.count_if(F.array_contains("operations", op))
    matched = F.col("old_id").isNotNull() & F.col("new_id").isNotNull()
    return sections.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("sections"),
        F.count_if(matched).alias("matched"),
        F.count_if(~matched).alias("unmatched"),
        has("SECTION_ADDED").alias("added"),
        has("SECTION_REMOVED").alias("removed"),
        has("SECTION_MODIFIED").alias("modified"),
        has("SECTION_MOVED").alias("moved"),
        has("SECTION_RENAMED").alias("renamed"),
        has("SECTION_MAPPING_CHANGED").alias("mapping_changed"),
        has("NO_CHANGE").alias("unchanged"),
    )


def document_operations(sections: DataFrame, keys: list[str]) -> DataFrame:
    """Per key the distinct operations of its sections, in report order."""
    return sections.groupBy(*keys).agg(in_order(F.array_distinct(F.flatten(F.collect_set("operations"))), OPERATIONS).alias("operations"))


CHANGES = "array<struct<field:string,new_value:string,old_value:string>>"
#: Fields of the header that are compared, in report order, and their columns.
HEADER = {"source_instance_id": "document_root", "effective_date": "effective", "document_type": "doc_type", "language": "language", "title": "title", "generic_name": "generic_name", "brand_names": "brands", "dosage_forms": "forms", "routes": "routes", "active_ingredients": "ingredients"}


def metadata_changes(pairs: DataFrame, key: str) -> DataFrame:
    """(key, changes): the header fields in which the two sides (prefix ``old_`` and ``new_``) differ; none where a side is missing. Lists are compared and shown as JSON."""
    kinds = {f.name: f.dataType.typeName() for f in pairs.schema}
    shown = lambda c: F.to_json(c) if kinds[c] == "array" else F.col(c).cast("string")
    parts = F.array(*[F.struct(F.lit(name).alias("field"), shown(f"new_{c}").alias("new_value"), shown(f"old_{c}").alias("old_value")) for name, c in HEADER.items()])
    differ = F.filter(parts, lambda x: ~x["old_value"].eqNullSafe(x["new_value"]))
    return pairs.select(key, F.when(F.col("old_document_id").isNotNull() & F.col("new_document_id").isNotNull(), differ).otherwise(F.array().cast(CHANGES)).alias("changes"))


def whole_operations(has_old: Column, has_new: Column, changed: Column, of_sections: Column) -> Column:
    """Operations of a whole diff, in report order: the document's own and its sections'; NO_CHANGE stands alone."""
    own = listed({"DOCUMENT_ADDED": ~has_old & has_new, "DOCUMENT_REMOVED": has_old & ~has_new, "DOCUMENT_METADATA_CHANGED": changed})
    every = in_order(F.concat(own, F.filter(of_sections, lambda x: x != "NO_CHANGE")), OPERATIONS)
    return F.when(F.size(every) > 0, every).otherwise(F.array(F.lit("NO_CHANGE")))


def unified(old: list[str], new: list[str], old_label: str, new_label: str) -> str:
    from difflib import unified_diff

    lines = lambda words: [" ".join(words[k : k + LINE_WORDS]) for k in range(0, len(words), LINE_WORDS)]
    return "\n".join(unified_diff(lines(old), lines(new), old_label, new_label, lineterm="", n=3))


def unified_texts(pairs: DataFrame, keys: list[str], old_label: str = "old", new_label: str = "new") -> DataFrame:
    """(keys, unified): a unified diff of each pair's texts over lines of LINE_WORDS words."""

    @F.pandas_udf(StringType())
    def of(old: pd.Series, new: pd.Series) -> pd.Series:
        return pd.Series([unified((a or "").split(), (b or "").split(), old_label, new_label) for a, b in zip(old, new, strict=True)], dtype=object)

    return pairs.select(*keys, of("old_text", "new_text").alias("unified"))
