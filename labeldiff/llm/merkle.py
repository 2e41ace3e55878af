"""A dataset manifest as a Merkle forest: a tree over the rows of each source, and a tree over the sources' roots.

A leaf is the digest of a row's fields. Leaves of a source lie in ascending order of their key; every ``arity``
consecutive nodes are digested into one until one is left, the last run as it is, even alone. The sources' roots, in
order (null first, then by bytes), are the leaves of one more tree.

Positions come from one range shuffle of the narrow leaves (no text moves) and the number of rows before each of its
partitions. Blocks of ``arity ** height`` leaves, aligned so a block is a whole subtree, are traversed recursively in
postorder: a subtree gives its digest, and while the recursion unwinds, siblings are appended to the leaves that it
holds. The roots of the blocks are the leaves of the next distributed traversal, and so on; the siblings of a block's
root are then handed down to its leaves. Whatever the size of a source, a task sees a block; a pass costs a shuffle of
digests, and there are log(rows) / log(block) of them.

Defined results: null fields have a digest of their own; rows without key come first in their source, rows of equal keys
lie in order of their leaves, repeated rows are leaves each; null is a source like others; an empty table gives no rows;
other columns are ignored; a result called like a kept column gets an underscore.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labeldiff.llm.common import fresh, stored

#: Children of a node; levels of a block (3^6 leaves are one traversal).
ARITY, HEIGHT = 3, 6
STEPS = "array<struct<left:binary,right:binary>>"


def leaf(fields: Sequence[Column]) -> Column:
    """Digest of a row: '-' for null, else the number of UTF-8 bytes, ':' and the value."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]), 256)


def joined(parts: Sequence[bytes]) -> bytes:
    """H over digests as hex text."""
    return hashlib.sha256("".join([p.hex() for p in parts]).encode()).digest()


def traversed(digests: Sequence[bytes], height: int, arity: int) -> tuple[bytes, list[list[tuple[bytes, bytes]]]]:
    """Root of a block after ``height`` folds, and of each leaf the siblings on its left and right, level by level."""
    steps: list[list[tuple[bytes, bytes]]] = [[] for _ in digests]

    def visit(low: int, high: int, level: int) -> bytes:
        if level == 0:
            return digests[low]
        width = arity ** (level - 1)
        own = [visit(a, min(a + width, high), level - 1) for a in range(low, high, width)]
        for k, a in enumerate(range(low, high, width)):
            step = (b"".join(own[:k]), b"".join(own[k + 1 :]))
            for i in range(a, min(a + width, high)):
                steps[i].append(step)
        return joined(own)

    return visit(0, len(digests), height), steps


def folds(n: int, height: int, arity: int) -> int:
    """Levels that a block of a tree of n leaves has: all of them, fewer in a tree that is one block."""
    levels = 0
    while levels < height and arity**levels < n:
        levels += 1
    return levels


def traversal(height: int, arity: int):
    """For applyInArrow over one block: adds ``top`` (the block's root) and ``steps``."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("pos")
        top, steps = traversed(table["digest"].to_pylist(), folds(table["n"][0].as_py(), height, arity), arity)
        ends = [0]
        for s in steps:
            ends.append(ends[-1] + len(s))
        pairs = pa.StructArray.from_arrays([pa.array([x[k] for s in steps for x in s], pa.binary()) for k in (0, 1)], names=["left", "right"])
        return table.append_column("top", pa.array([top] * len(steps), pa.binary())).append_column("steps", pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs))

    return run


def placed(rows: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """rows with ``pos`` (from 0 within its key) and ``n`` (rows of the key). rows: held; the key is not null. Rows equal in order are dealt by a salt, so no number of them is one task's."""
    salt = rows.withColumn("_salt", F.monotonically_increasing_id())
    dealt = stored(salt, "merkle-salted").repartitionByRange(F.col(key), *order, F.col("_salt")).sortWithinPartitions(F.col(key), *order, F.col("_salt"))
    dealt = stored(dealt.select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_at")), "merkle-dealt")
    parts = dealt.groupBy(key, "_part").agg(F.min("_at").alias("_low"), F.count(F.lit(1)).alias("_m"))
    upto = Window.partitionBy(key).orderBy("_part")
    parts = parts.select(key, "_part", "_low", (F.sum("_m").over(upto) - F.col("_m")).alias("_base"), F.sum("_m").over(Window.partitionBy(key)).alias("n"))
    return dealt.join(parts, [key, "_part"]).withColumn("pos", F.col("_base") + F.col("_at") - F.col("_low")).drop("_part", "_at", "_low", "_base", "_salt")


def walked(nodes: DataFrame, height: int, arity: int) -> list[DataFrame]:
    """The traversals of a forest (g, pos, n, digest, ...), lowest first, each held: with ``block``, ``top`` and ``steps``."""
    size, levels = arity**height, []
    while True:
        rows = nodes.withColumn("block", F.floor(F.col("pos") / F.lit(size)).cast("long"))
        schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema), "top binary", f"steps {STEPS}"])
        levels.append(stored(rows.groupBy("g", "block").applyInArrow(traversal(height, arity), schema), "merkle-blocks"))
        roots = levels[-1].where(F.col("pos") % size == 0)
        nodes = roots.where(F.col("n") > size).select("g", F.col("block").alias("pos"), F.ceil(F.col("n") / F.lit(size)).cast("long").alias("n"), F.col("top").alias("digest"))
        if nodes.isEmpty():
            return levels


def tops(levels: Sequence[DataFrame], size: int) -> DataFrame:
    """(g, digest): the root of each tree."""
    parts = [rows.where((F.col("n") <= size) & (F.col("pos") == 0)).select("g", F.col("top").alias("digest")) for rows in levels]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def handed_down(levels: Sequence[DataFrame], ends: DataFrame, size: int) -> DataFrame:
    """The lowest traversal's rows with the steps of all higher ones, and ``root``. ends: (g, steps, root) of each tree's root, whose steps follow. Each join's key is a block, so no tree is one task's."""
    above = None
    for rows in reversed(levels):
        last = rows.where((F.col("n") <= size) & (F.col("pos") == 0)).select("g").join(ends, "g").select("g", F.lit(0).cast("long").alias("block"), F.col("steps").alias("_steps"), "subroot")
        up = last if above is None else last.unionByName(above.select("g", F.col("pos").alias("block"), F.col("steps").alias("_steps"), "subroot"))
        above = rows.join(up, ["g", "block"]).withColumn("steps", F.concat("steps", "_steps")).drop("_steps")
    return above


def manifest(rows: DataFrame, source: Column, key: Column, fields: Sequence[Column], keep: Sequence[Column] = (), arity: int = ARITY, height: int = HEIGHT) -> DataFrame:
    """(kept columns, leaf, subroot, root, steps): every row's leaf, the roots of its source and of the whole as hex text, and its proof."""
    size = arity**height
    g = F.when(source.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), source.cast("string")))
    leaves = rows.select(g.alias("g"), key.alias("_key"), F.struct(*keep, F.lit(None).cast("int").alias("_none")).alias("_kept"), F.unhex(leaf(fields)).alias("digest"))
    nodes = placed(leaves, "g", [F.col("_key").asc_nulls_first(), F.col("digest")])
    levels = walked(nodes, height, arity)
    roots = stored(tops(levels, size), "merkle-subroots")
    sources = placed(roots.select(F.lit("").alias("t"), F.col("g").alias("_source"), "digest"), "t", [F.col("_source")]).withColumnRenamed("t", "g")
    higher = walked(sources, height, arity)
    top = tops(higher, size).first()
    none = F.array().cast(STEPS)
    whole = handed_down(higher, tops(higher, size).select("g", none.alias("steps"), F.col("digest").alias("subroot")), size)
    ends = whole.select(F.col("_source").alias("g"), "steps", F.col("digest").alias("subroot"))
    hexed = lambda c: F.lower(F.hex(c))
    out = handed_down(levels, ends, size)
    kept = [f.name for f in out.schema["_kept"].dataType.fields if f.name != "_none"]
    results = {"leaf": hexed("digest"), "subroot": hexed("subroot"), "root": hexed(F.lit(bytes(top.digest) if top else None).cast("binary")), "steps": F.col("steps")}
    return out.select(*[F.col(f"_kept.`{c}`") for c in kept], *[v.alias(fresh(kept, n)) for n, v in results.items()])


def folded(start: Column, steps: Column) -> Column:
    """The root that a leaf and its proof give."""
    text = lambda b: F.lower(F.hex(b))
    return F.aggregate(steps, start, lambda held, s: F.sha2(F.concat(text(s["left"]), held, text(s["right"])), 256))


def proof_digest(steps: Column) -> Column:
    """Digest of all siblings of a proof, from the lowest level, left to right."""
    return F.sha2(F.array_join(F.transform(steps, lambda s: F.concat(F.lower(F.hex(s["left"])), F.lower(F.hex(s["right"])))), ""), 256)


def report(docs: DataFrame) -> DataFrame:
    """Every document's proof, checked against its leaf after tampering: half the documents lose their line ends."""
    c = F.col
    name = [c("doc_id"), c("source"), c("lang"), c("n_chars")]
    tampered = F.crc32(c("doc_id").cast("string")) % 2 == 0
    changed = F.when(tampered, leaf([*name, F.replace(c("text"), F.lit("\n"), F.lit(""))]))
    rows = manifest(docs, c("source"), c("doc_id"), [*name, c("text")], keep=[c("doc_id"), changed.alias("changed")])
    rows = rows.withColumn("folded_root", folded(F.coalesce("changed", "leaf"), c("steps")))
    return rows.select("doc_id", "leaf", "subroot", "root", proof_digest(c("steps")).alias("proof_sha256"), "folded_root", (c("folded_root") == c("root")).alias("verified"))
