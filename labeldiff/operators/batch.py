"""Batch runs: initial item states, stage transitions, roll-ups, reports, integrity and verification."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labeldiff.functions import identity, rules
from labeldiff.values import STAGE_INPUTS


def initial_items(entries: DataFrame, decided: DataFrame) -> DataFrame:
    """One item per ranked entry: selection status, PENDING or NOT_SELECTED, error category, review flag."""
    rows = entries.join(decided, "discovery_id", "left").withColumn("selection", F.coalesce("status", F.lit("PENDING"))).drop("status")
    return rows.withColumns({
        "discovery": F.when(F.col("selection") == "FETCH_FAILED", "LOOKUP_FAILED").when(F.col("selection") == "METADATA_INVALID", "METADATA_INVALID").when(F.col("selection") == "NO_CANDIDATE", "NO_CANDIDATE").when(F.col("selection") == "PENDING", "PENDING").otherwise("DISCOVERED"),
        "ingestion": F.when(F.col("selection") == "SELECTED", "PENDING").otherwise("NOT_SELECTED"),
        "verification": F.lit("NOT_VERIFIED"),
        "error": rules.selection_error(F.col("selection")),
    })


def eligible(items: DataFrame, stage: str, ranks: Sequence[int] | None = None) -> DataFrame:
    """Items that a stage takes up, of the given ranks."""
    rows = items.where(F.col("ingestion").isin(*STAGE_INPUTS[stage]))
    return rows if ranks is None else rows.where(F.col("rank").isin(*ranks))


def spans(items: DataFrame, size: int) -> list[tuple[int, int]]:
    """Ranges of ranks (first, last) that hold items, ``size`` ranks each."""
    found = items.select(F.floor((F.col("rank") - 1) / F.lit(size)).cast("long").alias("g")).distinct().orderBy("g").collect()
    return [(r.g * size + 1, (r.g + 1) * size) for r in found]


def orphaned(log: DataFrame, keys: Sequence[str], state: str, started: Sequence[str], ended: Sequence[str]) -> DataFrame:
    """Keys with a start and no end: an anti join of the log with itself."""
    begun = log.where(F.col(state).isin(*started)).select(*keys).distinct()
    return begun.join(log.where(F.col(state).isin(*ended)).select(*keys), list(keys), "left_anti")


def rollup(items: DataFrame, keys: Sequence[str], terminal: bool | None = None) -> DataFrame:
    """Eight counts per run and the status they imply: one partial aggregate. A run is RUNNING while items are open; ``terminal`` says instead whether it is over."""
    c = F.col
    failed = rules.failed(c("discovery"), c("ingestion"), c("verification"))
    done = (c("ingestion") == "NOT_SELECTED") & (c("selection") != "PENDING") | (c("verification") != "NOT_VERIFIED") | failed
    quarantined = c("quarantine_id").isNotNull() if "quarantine_id" in items.columns else F.lit(False)
    out = items.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(c("selection") == "SELECTED").alias("selected"),
        F.count_if(rules.fetched(c("ingestion"))).alias("fetched"),
        F.count_if(rules.ingested(c("ingestion"))).alias("ingested"),
        F.count_if(c("verification") == "VERIFIED").alias("verified"),
        F.count_if(quarantined).alias("quarantined"),
        F.count_if(rules.unresolved(c("selection"))).alias("unresolved"),
        F.count_if(failed).alias("failed"),
        F.count_if(~done).alias("open"),
    )
    running = c("open") > 0 if terminal is None else F.lit(not terminal)
    return out.withColumn("status", F.when(running, "RUNNING").otherwise(rules.batch_status(c("total"), c("verified"), c("failed"))))


def verified(checks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per key whether all checks (name, passed) passed, and the names of those that failed, sorted."""
    failed = F.array_sort(F.collect_set(F.when(~F.col("passed"), F.col("name"))))
    return checks.groupBy(*keys).agg(F.bool_and("passed").alias("verified"), failed.alias("failed"), F.count(F.lit(1)).alias("n_checks"))


def unrolled(rows: DataFrame, keys: Sequence[str], checks: Mapping[str, Column]) -> DataFrame:
    """One row per check of every row: (keys, name, passed)."""
    return rows.select(*keys, F.inline(F.array(*[F.struct(F.lit(n).alias("name"), F.coalesce(ok, F.lit(False)).alias("passed")) for n, ok in checks.items()])))


def artifact(items: DataFrame, keys: Sequence[str], order: str, fields: Sequence[str]) -> DataFrame:
    """Canonical JSON of a run's items in order, with its hash. A run has few items: its ranked list."""
    one = identity.canonical_json(**{f: F.col(f) for f in fields})
    text = F.concat(F.lit("["), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), one.alias("j")))), lambda x: x["j"]), ","), F.lit("]"))
    return items.groupBy(*keys).agg(text.alias("canonical"), F.count(F.lit(1)).alias("n")).withColumn("sha256", identity.sha256(F.col("canonical")))


def intact(artifacts: DataFrame, ranks: str = "ranks") -> Column:
    """Whether an artifact's hash is that of its text and its items are in order without repeats."""
    r = F.col(ranks)
    return (identity.sha256(F.col("canonical")) == F.col("sha256")) & (r == F.array_sort(F.array_distinct(r)))
