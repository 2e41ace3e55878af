"""Read models: search, semi and anti joins, point lookups, uniqueness, latest rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labeldiff.functions import text


def any_mention(columns: Sequence[Column], needle: str) -> Column:
    """Whether any column holds the needle, whatever the case; an empty needle is in every non-null value."""
    return reduce(lambda a, b: a | b, (F.coalesce(text.contains_folded(c, needle), F.lit(False)) for c in columns))


def search(rows: DataFrame, needle: str, over: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Distinct rows of which any of the columns holds the needle. The filter comes before the distinct, so little is shuffled."""
    return rows.where(any_mention([F.col(c) for c in over], needle)).select(*keep).distinct()


def having(rows: DataFrame, other: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows that have a partner (EXISTS)."""
    return rows.join(other.select(*on), list(on), "left_semi")


def orphans(rows: DataFrame, other: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows without a partner (NOT EXISTS)."""
    return rows.join(other.select(*on), list(on), "left_anti")


def foreign_parents(rows: DataFrame, key: str, parent: str, document: str) -> DataFrame:
    """Rows whose parent belongs to another document."""
    above = rows.select(F.col(key).alias("_key"), F.col(document).alias("_document"))
    return rows.join(above, (F.col(parent) == F.col("_key")) & (F.col(document) != F.col("_document"))).drop("_key", "_document")


def resolved(rows: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Per key: how many rows, the value if there is one only, and FOUND or AMBIGUOUS."""
    n = F.count(F.lit(1))
    return rows.groupBy(*keys).agg(n.alias("n"), F.when(n == 1, F.min(value)).alias(value), F.when(n == 1, "FOUND").otherwise("AMBIGUOUS").alias("status"))


def latest(rows: DataFrame, keys: Sequence[str], by: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Per key the values of the row that is last by ``by``: one partial aggregate, no sort."""
    last = F.max(F.struct(*by, *[v for v in values if v not in by]))
    return rows.groupBy(*keys).agg(last.alias("_last")).select(*keys, *[F.col(f"_last.{v}").alias(v) for v in values])


def numbered(rows: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str = "index") -> DataFrame:
    """Positions from 0 within each key; the order must be total."""
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1)


def first_occurrence(rows: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str = "duplicate_of") -> DataFrame:
    """The value of the key's first row, on its later rows; null on the first. Only key and order columns enter the aggregate."""
    first = rows.groupBy(*keys).agg(F.min(F.struct(*order, *[value] if value not in order else [])).alias("_first"))
    joined = rows.join(first, list(keys))
    return joined.withColumn(name, F.when(F.col(f"_first.{value}") != F.col(value), F.col(f"_first.{value}"))).drop("_first")


def subtree_any(nodes: DataFrame, node: str, parent: str, flag: str, depth: str | None = None) -> DataFrame:
    """(node, flag): whether the node or any descendant has the flag. Level by level over a materialized frontier of flagged nodes: a node is told once, and levels are the tree's depth."""
    edges = nodes.select(F.col(node).alias("n"), F.col(parent).alias("p"))
    hit = frontier = nodes.where(F.col(flag)).select(F.col(node).alias("n")).distinct()
    levels = nodes.agg(F.max(depth)).first()[0] if depth else 64
    for _ in range(levels or 0):
        frontier = edges.join(frontier, "n").where(F.col("p").isNotNull()).select(F.col("p").alias("n")).distinct()
        if depth is None and frontier.isEmpty():
            break
        hit = hit.union(frontier)
    hit = hit.distinct().withColumn("_hit", F.lit(True))
    return nodes.select(F.col(node).alias("n")).join(hit, "n", "left").select(F.col("n").alias(node), F.coalesce("_hit", F.lit(False)).alias(flag))


def interval_any(nodes: DataFrame, tree: str, enter: str, leave: str, flag: str) -> DataFrame:
    """nodes with the flag of any node of their subtree. A subtree is the interval enter..leave of its tree's preorder, so the running counts of flags at both ends tell: a window within each tree and one equi join, whatever the depth."""
    upto = Window.partitionBy(tree).orderBy(enter)
    running = nodes.withColumn("_n", F.count_if(F.col(flag)).over(upto))
    ends = running.select(tree, F.col(enter).alias(leave), F.col("_n").alias("_end"))
    return running.join(ends, [tree, leave]).withColumn(flag, F.col(flag) | (F.col("_end") > F.col("_n"))).select(*nodes.columns)


def unpivoted(rows: DataFrame, keys: Sequence[str], fields: Mapping[str, tuple[Column, Column]]) -> DataFrame:
    """One row per field whose old and new value differ, in the mapping's order (``position``)."""
    parts = F.array(*[F.struct(F.lit(k).alias("position"), F.lit(name).alias("field"), old.cast("string").alias("old"), new.cast("string").alias("new")) for k, (name, (old, new)) in enumerate(fields.items())])
    return rows.select(*keys, F.inline(F.filter(parts, lambda x: ~x["old"].eqNullSafe(x["new"]))))


def contiguous(rows: DataFrame, keys: Sequence[str], rank: str) -> DataFrame:
    """Per key whether the ranks are 1, 2, ... without gaps or repeats."""
    n, d = F.count(F.lit(1)), F.count_distinct(rank)
    return rows.groupBy(*keys).agg(n.alias("n"), d.alias("n_distinct"), F.min(rank).alias("low"), F.max(rank).alias("high")).withColumn("contiguous", (F.col("low") == 1) & (F.col("high") == F.col("n")) & (F.col("n") == F.col("n_distinct")))
