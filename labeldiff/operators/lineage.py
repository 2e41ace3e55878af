"""Versions of a document over time: edges, order evidence, missing versions, latest history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labeldiff.functions import text
from labeldiff.functions.rules import version_order


def edges(versions: DataFrame, lineage: str, order: list[Column], keep: list[str]) -> DataFrame:
    """Consecutive versions: each row with its predecessor's columns (prefix ``old_``); the first of a lineage has none and is left out."""
    w = Window.partitionBy(lineage).orderBy(*order)
    position = versions.withColumn("position", F.row_number().over(w)).withColumns({f"old_{c}": F.lag(c).over(w) for c in keep})
    return position.where("position > 1")


def history_gaps(pairs: DataFrame, entries: DataFrame, lineage: str = "lineage_id") -> DataFrame:
    """pairs (lineage, old_version, new_version) with positions in the newest-first history, direction, adjacency and the versions strictly between.

    entries: (lineage, version, position). The versions between are an equi join on the lineage with a range filter.
    """
    at = lambda side: entries.select(lineage, F.col("version").alias(f"{side}_version"), F.col("position").alias(f"{side}_position"))
    placed = pairs.join(at("old"), [lineage, "old_version"], "left").join(at("new"), [lineage, "new_version"], "left")
    ends = F.least("old_position", "new_position"), F.greatest("old_position", "new_position")
    between = placed.withColumns({"_low": ends[0], "_high": ends[1]}).join(entries.select(F.col(lineage).alias("_l"), F.col("version").alias("_v"), F.col("position").alias("_p")), (F.col(lineage) == F.col("_l")) & (F.col("_p") > F.col("_low")) & (F.col("_p") < F.col("_high")), "left")
    keys = [*pairs.columns, "old_position", "new_position"]
    found = between.groupBy(*keys).agg(F.sort_array(F.collect_list(F.when(F.col("_v").isNotNull(), F.struct(F.col("_p"), F.col("_v")))), asc=False).alias("_m"))
    direction = F.when(F.col("old_position").isNull() | F.col("new_position").isNull(), F.lit(None).cast("int")).otherwise(text.direction(F.col("new_position"), F.col("old_position")))
    return found.select(*keys, direction.alias("history"), (F.col("old_position") - F.col("new_position") == 1).alias("adjacent"), F.transform("_m", lambda x: x["_v"]).alias("missing"))


def ordered(pairs: DataFrame) -> DataFrame:
    """pairs with ``ordering``: the evidence that old precedes new, from versions, history, dates and retrieval times."""
    c = F.col
    history = c("history") if "history" in pairs.columns else F.lit(None).cast("int")
    adjacent = c("adjacent") if "adjacent" in pairs.columns else F.lit(False)
    direction = lambda name: text.direction(c(f"old_{name}"), c(f"new_{name}"))
    return pairs.withColumn("ordering", version_order(text.version_direction(c("old_version"), c("new_version")), history, direction("effective"), direction("published"), direction("retrieved"), adjacent))


def publication(documents: DataFrame, snapshots: DataFrame, selected: DataFrame) -> DataFrame:
    """documents (document_id, lineage_id, version) with the publication date: of the latest snapshot that has the version, else of the selection."""
    last = snapshots.groupBy("lineage_id", "version").agg(F.max_by("published", F.struct("retrieved_at", "snapshot_id")).alias("_h"))
    rows = documents.join(last, ["lineage_id", "version"], "left").join(selected.select("document_id", F.col("published").alias("_s")), "document_id", "left")
    source = F.when(F.col("_h").isNotNull(), "DAILYMED_HISTORY").when(F.col("_s").isNotNull(), "SELECTION_METADATA")
    return rows.withColumn("published", F.coalesce("_h", "_s")).withColumn("published_source", source).withColumn("disagrees", F.coalesce(F.col("_h") != F.col("_s"), F.lit(False))).drop("_h", "_s")
