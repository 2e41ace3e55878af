"""Where two structures differ: canonical JSON trees (attributes, children, tag, tail, text) compared level by level.

Subtrees are met by their place and told apart by a digest, so equal ones are left behind at once and only what differs is
looked into. A level is one join; there are as many as the deepest difference lies below the root.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labeldiff.scratch import held

#: What a node says itself, apart from its children.
OWN = ("attributes", "tag", "tail", "text")


def own(node: Column) -> Column:
    tree = F.try_parse_json(node)
    return F.to_json(F.struct(*[F.try_variant_get(tree, f"$.{n}", "variant").alias(n) for n in OWN]))


def below(rows: DataFrame, keys: Sequence[str], side: str) -> DataFrame:
    """(keys, path, side, digest) of the children of a side's nodes."""
    each = rows.select(*keys, "path", F.posexplode(F.try_variant_get(F.try_parse_json(side), "$.children", "array<variant>")).alias("_k", "_v"))
    text = each.select(*keys, F.concat(F.col("path"), F.lit("/"), F.col("_k").cast("string")).alias("path"), F.to_json("_v").alias(side))
    return text.withColumn(f"_{side}", F.xxhash64(side))


def changed_paths(pairs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """pairs: keys, old, new (JSON or null). (keys, path, change): a path is the ordinals of children from the root, "" itself; ADDED and REMOVED stand for a whole subtree, CHANGED for what a node says itself."""
    c = F.col
    level = held(pairs.select(*keys, F.lit("").alias("path"), "old", "new").where(~c("old").eqNullSafe(c("new"))), "structures")
    found = []
    while True:
        change = F.when(c("old").isNull(), "ADDED").when(c("new").isNull(), "REMOVED").when(own(c("old")) != own(c("new")), "CHANGED")
        found.append(level.select(*keys, "path", change.alias("change")).where("change IS NOT NULL"))
        both = level.where("old IS NOT NULL AND new IS NOT NULL")
        met = below(both, keys, "old").join(below(both, keys, "new"), [*keys, "path"], "full_outer")
        # Digests pick; the texts decide, in case two digests are the same.
        level = held(met.where(~c("_old").eqNullSafe(c("_new")) | ~c("old").eqNullSafe(c("new"))).select(*keys, "path", "old", "new"), "structures")
        if level.isEmpty():
            return reduce(DataFrame.unionByName, found)
