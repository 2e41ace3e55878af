"""Candidates of ranked names: classes, duplicates and a selection in which ties stay unresolved."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labeldiff.functions import rules, text
from labeldiff.operators.relational import first_occurrence
from labeldiff.values import LOWER_PRIORITY


def candidate_order(version: Column, published: Column, set_id: Column, title: Column) -> list[Column]:
    """Newest version first (non-numeric last), then newest date, then ids."""
    return [text.descending_version(version).desc(), text.ordinal(published).desc(), set_id, title]


def top_or_tied(rows: DataFrame, keys: list[str], score: Column, identity: Column) -> DataFrame:
    """Per key the best score, how many rows reach it, how many identities those have, and whether that is a tie. Never breaks a tie."""
    best = rows.withColumn("_score", score).withColumn("_top", F.max("_score").over(Window.partitionBy(*keys)))
    top = best.where(F.col("_score").eqNullSafe(F.col("_top")))
    n, ids = F.count(F.lit(1)), F.count_distinct(identity)
    status = F.when(n == 1, "SELECTED").when(ids > 1, "MULTIPLE_EQUIVALENT_CANDIDATES").otherwise("AMBIGUOUS_REQUIRES_REVIEW")
    return top.groupBy(*keys).agg(n.alias("n_top"), ids.alias("n_identities"), F.when(n == 1, F.min(identity)).alias("selected"), status.alias("status"))


def classified(candidates: DataFrame) -> DataFrame:
    """candidates (discovery_id, original, normalized, set_id, version, title, published, active, metadata_sha256 and the typed fields) with index, duplicate_of, classes, accepted, reasons."""
    order = [F.col("set_id"), F.col("version"), F.col("title"), F.col("published"), F.col("metadata_sha256")]
    rows = candidates.withColumn("index", F.row_number().over(Window.partitionBy("discovery_id").orderBy(*order)) - 1).withColumn("_fold", F.lower("set_id"))
    rows = first_occurrence(rows, ["discovery_id", "_fold", "version"], ["index"], "index").drop("_fold")
    found = rules.classes(F.col("active"), F.col("original"), F.col("normalized"), text.normalized_name(F.col("active")[0]), *[F.col(c) for c in ("product_type", "labeler", "marketing_category", "source_status", "dosage_form", "route", "repackaged")], F.col("duplicate_of").isNotNull())
    rows = rows.withColumn("classes", found)
    return rows.withColumn("accepted", rules.accepted(F.col("classes"))).withColumn("reasons", rules.reasons(F.col("classes")))


def decisions(evidence: DataFrame, lookups: DataFrame) -> DataFrame:
    """One row per lookup (discovery_id, truncated): status, selected index, manual review. evidence: what ``classified`` returns."""
    ok = evidence.where("accepted")
    score = F.struct(F.array_contains("classes", "EXACT_SINGLE_INGREDIENT_MATCH").cast("int").alias("exact"), text.descending_version(F.col("version")).alias("version"), text.ordinal(text.lenient_date(F.col("published"))).alias("date"))
    tops = top_or_tied(ok, ["discovery_id"], score, F.lower("set_id"))
    winner = ok.groupBy("discovery_id").agg(F.max_by("index", score).alias("_index"))
    counts = evidence.groupBy("discovery_id").agg(F.count(F.lit(1)).alias("n"), F.count_if("accepted").alias("n_accepted"))
    rows = lookups.join(counts, "discovery_id", "left").join(tops.withColumnRenamed("status", "_status"), "discovery_id", "left").join(winner, "discovery_id", "left")
    status = (
        F.when(F.coalesce("n", F.lit(0)) == 0, "NO_CANDIDATE")
        .when(F.col("n_accepted") == 0, "NO_ACCEPTABLE_CANDIDATE")
        .when(F.coalesce("truncated", F.lit(False)), "AMBIGUOUS_REQUIRES_REVIEW")
        .otherwise(F.col("_status"))
    )
    rows = rows.withColumn("status", status)
    return rows.select("discovery_id", "status", F.when(F.col("status") == "SELECTED", F.col("_index")).alias("selected_index"), (~F.col("status").isin("SELECTED", "NO_CANDIDATE")).alias("manual_review"), F.coalesce("n", F.lit(0)).alias("n_candidates"), F.coalesce("n_accepted", F.lit(0)).alias("n_accepted"))


def explained(evidence: DataFrame, decided: DataFrame) -> DataFrame:
    """evidence after the decision: losers of a selection get a reason, winners of a tie the class AMBIGUOUS, rows of a truncated lookup lose their acceptance."""
    rows = evidence.join(decided.select("discovery_id", "status", "selected_index"), "discovery_id")
    lost = (F.col("status") == "SELECTED") & F.col("accepted") & (F.col("index") != F.col("selected_index"))
    return rows.withColumn("reasons", F.when(lost, F.array_append("reasons", F.lit(LOWER_PRIORITY))).otherwise(F.col("reasons")))


def single_label(candidates: DataFrame, name: str, brand: str) -> DataFrame:
    """Of candidates (set_id, version, title, published) whose title mentions the name, those with the brand if any: SELECTED, AMBIGUOUS or NOT_FOUND, in one row."""
    pool = candidates.where(text.mentions(F.col("title"), name)).withColumn("_b", text.mentions(F.col("title"), brand))
    any_brand = pool.agg(F.coalesce(F.bool_or("_b"), F.lit(False)).alias("_any"))
    pool = pool.join(F.broadcast(any_brand)).where(~F.col("_any") | F.col("_b"))
    best = F.min_by(F.struct("set_id", "version", "title", "published"), F.struct((-text.descending_version(F.col("version"))).alias("v"), (-text.ordinal(text.lenient_date(F.col("published")))).alias("d"), "set_id", "title"))
    n = F.count_distinct(F.lower("set_id"))
    return pool.agg(F.when(n == 0, "NOT_FOUND").when(n > 1, "AMBIGUOUS").otherwise("SELECTED").alias("status"), F.when(n == 1, best).alias("selected"))
