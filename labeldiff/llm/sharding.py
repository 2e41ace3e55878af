"""Rendezvous hashing of stable record keys over weighted shards. DataFrame functions only.

Each (key, shard) pair has a 52-bit hash, the first 13 hex digits of the MD5 of ``key:shard``. The shard with the
largest ``ln(u) / weight`` wins, u being the hash scaled to (0, 1); with equal weights this is the largest hash. A new
shard adds one candidate to each key, so it only takes rows, each existing shard loses its share, and no row moves
between old shards. There is no shuffle: a row's shard depends on its key and the shard list alone.

Defined results: a null key is a key of its own; equal keys land in one shard; a null text has no bytes; an empty table
gives an empty result; extra columns are kept, and a name for a new column that one of them has is refused. Repeated rows are counted before they are numbered, so a row that repeats millions of times does
not meet in one task, and then get consecutive slots.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labeldiff.llm.common import fresh, stored

BITS = 52
#: Repeats of one row are unfolded in pieces of this many.
PIECE = 65_536


def key_hash(key: Column, salt: str) -> Column:
    """52 bits of MD5 of ``key:salt`` as a long; null keys hash as the text \\0."""
    name = F.concat(F.coalesce(key.cast("string"), F.lit("\0")), F.lit(f":{salt}"))
    return F.conv(F.substring(F.md5(name.cast("binary")), 1, 13), 16, 10).cast("long")


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """Index of the shard that wins for ``key``; ties (probability 2^-52) go to the smaller index."""
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive")
    even = len(set(weights)) == 1

    def score(k: int, w: float) -> Column:
        h = key_hash(key, str(k))
        return h if even else F.log((h + F.lit(0.5)) / F.lit(float(2**BITS))) / F.lit(float(w))

    best = F.array_max(F.array(*[F.struct(score(k, w).alias("s"), F.lit(-k).alias("k")) for k, w in enumerate(weights)]))
    return -best["k"]


def assign_shards(docs: DataFrame, key: str, weights: Sequence[float], shard: str = "shard") -> DataFrame:
    """docs with the column ``shard`` (with underscores if there is one of that name). One projection: no shuffle, no Python."""
    return docs.withColumn(fresh(docs.columns, shard), rendezvous(F.col(f"`{key}`"), weights).cast("int"))


def number_slots(rows: DataFrame, key: str, shard: str = "shard", slot: str = "slot", buckets: int | None = None) -> DataFrame:
    """Gapless numbers from 0 in each shard, in order of a hash of the key, then of the other columns.

    A shard may be far larger than a task, so it is cut by the leading bits of that hash into ``buckets`` ranges
    (default: the number of shuffle partitions, at least 64); rows are numbered inside a range and shifted by the sizes of the ranges
    before it. Only shards x buckets sizes are broadcast. Equal rows are counted first and unfolded last. The number's
    column gets underscores if there is one of that name.
    """
    spark = rows.sparkSession
    names = rows.columns
    slot = fresh(names, slot)
    o, n, b, all_, shift_, first_, p, k = (fresh([*names, slot], f"_{x}") for x in ("o", "n", "b", "all", "shift", "first", "p", "k"))
    c = lambda x: F.col(f"`{x}`")
    ranges = buckets or max(64, int(spark.conf.get("spark.sql.shuffle.partitions")))
    kinds = rows.withColumn(o, key_hash(c(key), "slot")).groupBy(*map(c, names), o).agg(F.count(F.lit(1)).alias(n))
    kinds = stored(kinds.withColumn(b, F.floor(F.col(o) * F.lit(ranges / 2**BITS)).cast("int")), "slots")
    order = Window.partitionBy(c(shard), b).orderBy(o, *[c(x) for x in names if x != shard])
    sizes = kinds.groupBy(c(shard), b).agg(F.sum(n).alias(all_))
    ahead = Window.partitionBy(c(shard)).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    shift = sizes.select(c(shard), b, F.coalesce(F.sum(all_).over(ahead), F.lit(0)).alias(shift_))
    first = F.sum(n).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col(n)
    placed = kinds.withColumn(first_, first).join(F.broadcast(shift), [shard, b])
    piece = placed.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1, F.lit(PIECE).cast("long"))).alias(p))
    each = piece.select("*", F.explode(F.sequence(F.col(p), F.least(F.col(p) + PIECE, F.col(n)) - 1)).alias(k))
    return each.select(*map(c, names), (F.col(shift_) + F.col(first_) + F.col(k)).cast("long").alias(slot))


def shard_report(docs: DataFrame, n_shards: int = 24) -> DataFrame:
    """One row per document: its size and checksum, its shard and slot of n_shards, and its shard if there were one more."""
    text = F.coalesce(F.col("text"), F.lit(""))
    n = F.lit(n_shards)
    rows = docs.select(
        "doc_id",
        (F.octet_length(text).cast("long") + 8).alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
        F.lit("key").alias("law"),
        rendezvous(F.col("doc_id"), [1.0] * n_shards).cast("int").alias("shard"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
    best = key_hash(F.col("doc_id"), str(n_shards))
    old = F.array_max(F.array(*[key_hash(F.col("doc_id"), str(k)) for k in range(n_shards)]))
    rows = rows.withColumn("grown_shard", F.when(best > old, n).otherwise(F.col("shard")).cast("int")) if n_shards else rows
    return number_slots(rows, "doc_id").select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
