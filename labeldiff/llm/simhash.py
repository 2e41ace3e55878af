"""Near duplicates by SimHash fingerprints, found exactly by pigeonhole blocks.

A fingerprint is cut into four 16-bit blocks. Two fingerprints that differ in at most two bits agree in at least two
blocks, so every such pair shares one of the six pairs of blocks (32 bits). Fingerprints are joined on those, and pairs
are verified by Hamming distance. Only distinct fingerprints take part: exact copies never meet as pairs.

A pair of blocks that more than ``HOT`` distinct fingerprints share would still give all pairs of a large group. Such
fingerprints go another exact way: each emits itself and its 64 one-bit neighbours; fingerprints that meet in a
neighbour are within two bits of each other, and any two within two bits meet in one; each group is linked as a star to
its smallest member, so the rows stay proportional to the fingerprints. Components are found by alternating large-star
and small-star steps, each written to the shared folder.

Defined results: a text without words (null, empty) has fingerprint zero and is linked like any other; fewer words
than a shingle make one shingle of all words; rows that share a doc_id keep their own fingerprints, the smallest doc_id
names the component; an empty table gives no rows; all other columns are kept.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labeldiff import scratch
from labeldiff.llm.common import LOWER, fresh, stored

#: Rows for one task of the steps on distinct fingerprints and links (narrow rows), and tasks at least.
ROWS, TASKS = 250_000, 6
#: Distinct fingerprints in a pair of blocks beyond which pairs are not compared one by one; bits two fingerprints may differ in.
HOT, RADIUS = 64, 2


def fingerprint(text: bytes, shingle: int, seed: int = 42) -> int:
    """64 bits; a bit is set if it is set in over half of the shingles' XXH64 hashes."""
    from xxhash import xxh64_digest

    words = text.translate(LOWER).split()
    if not words:
        return 0
    parts = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False)) if len(words) >= shingle else [b" ".join(words)]
    total, n, rows = np.zeros(64, np.int64), 0, []
    for p in parts:
        rows.append(xxh64_digest(p, seed))
        if len(rows) == 65_536:
            total, n, rows = total + bit_sums(rows), n + len(rows), []
    total, n = total + bit_sums(rows), n + len(rows)
    return int.from_bytes(np.packbits(2 * total > n).tobytes(), "big")


def bit_sums(digests: list[bytes]) -> np.ndarray:
    raw = np.frombuffer(b"".join(digests), np.uint8).reshape(-1, 8)
    return np.unpackbits(raw, axis=1).sum(0, dtype=np.int64)


def add_fingerprints(shingle: int, text_at: int, name: str):
    def run(batches):
        for batch in batches:
            # bytes of large batches are taken one text at a time
            prints = [fingerprint(t.as_buffer().to_pybytes() if t.is_valid else b"", shingle) for t in batch.column(text_at).cast(pa.large_binary())]
            keep = batch.columns[:-1] if batch.schema.names[-1] == name else batch.columns
            yield pa.RecordBatch.from_arrays([*keep, pa.array(np.array(prints, dtype=np.uint64).view(np.int64))], names=[*batch.schema.names[: len(keep)], name])

    return run


def with_fingerprints(docs: DataFrame, shingle: int, text_col: str = "text", name: str = "fp", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (default: all) and the fingerprint as a signed long. Texts go to Python once and don't come back unless kept."""
    keep = docs.columns if keep is None else keep
    sent = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text_col}`").cast("string").alias(name))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*[F.col(f"`{c}`") for c in keep]).schema), f"`{name}` long"])
    return sent.mapInArrow(add_fingerprints(shingle, len(keep), name), schema)


def sized(df: DataFrame, rows: int) -> DataFrame:
    """df in as many tasks as its rows ask for, whatever the number of shuffle partitions: links are few, and thousands of empty tasks cost more than the work."""
    return df.coalesce(max(TASKS, rows // ROWS))


def close_pairs(prints: DataFrame) -> DataFrame:
    """(a, b), a < b: links between distinct fingerprints (column ``fp``) that connect all that differ in RADIUS bits or fewer."""
    blocks = [F.shiftrightunsigned("fp", s).bitwiseAND(F.lit(0xFFFF)) for s in (48, 32, 16, 0)]
    keys = [F.lit(n).cast("long") * (1 << 32) + blocks[i] * (1 << 16) + blocks[j] for n, (i, j) in enumerate(combinations(range(4), 2))]
    spread = prints.select("fp", F.explode(F.array(*keys)).alias("key"))
    rows = 6 * prints.count()
    shared = sized(spread.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), rows)
    met = stored(sized(spread.join(shared, "key"), rows), "blocks")
    rows = met.count()
    few = met.where(F.col("n") <= HOT)
    left, right = few.select("key", F.col("fp").alias("a")), few.select("key", F.col("fp").alias("b"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= RADIUS
    pairs = sized(left.join(right, (left["key"] == right["key"]) & (F.col("a") < F.col("b")) & near).select("a", "b"), rows)
    hot = sized(met.where(F.col("n") > HOT).select("fp").distinct(), rows)
    flips = F.array(F.lit(0).cast("long"), *[F.lit(1 << i if i < 63 else -(1 << 63)).cast("long") for i in range(64)])
    beside = hot.select("fp", F.explode(F.transform(flips, lambda x: x.bitwiseXOR(F.col("fp")))).alias("x"))
    beside = sized(beside, rows)
    centre = beside.groupBy("x").agg(F.min("fp").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1").select("x", "a")
    stars = beside.join(centre, "x").where(F.col("a") != F.col("fp")).select("a", F.col("fp").alias("b"))
    return sized(pairs.union(sized(stars, rows)).distinct(), rows)


def components(edges: DataFrame) -> DataFrame:
    """(node, root): every node of the edges (a, b) with the smallest node it is connected to."""
    since = scratch.mark()
    now = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v"), "edges")
    mark = None
    while True:
        n, crc = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").bitwiseAND(F.lit(0xFFFFFFFF)))).first()
        if not n or (n, crc) == mark:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()) if n else now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = (n, crc)
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = sized(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), n)
        large = sized(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v"), n)
        large = sized(large.distinct(), n)
        low = sized(large.groupBy("u").agg(F.min("v").alias("m")), n)
        small = large.join(low, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = sized(small, n).union(low.select("u", F.col("m").alias("v")))
        now = stored(sized(small.where("u > v").distinct(), n), "edges")
        scratch.release(since, keep=1)


def near_duplicates(docs: DataFrame, shingle: int = 5, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None, name: str = "component_id") -> DataFrame:
    """The columns ``keep`` (default: all), ``fp`` and ``component_id``, the smallest id that is reached through links; either with underscores behind it where a column has that name."""
    keep = docs.columns if keep is None else keep
    name = fresh(keep, name)
    fp = fresh([*docs.columns, name], "fp")
    marked = stored(with_fingerprints(docs, shingle, text_col, fp, list(dict.fromkeys([*keep, id_col]))), "fingerprints")
    prints = stored(marked.groupBy(F.col(fp).alias("fp")).agg(F.min(F.col(f"`{id_col}`")).alias("least")), "prints")
    whole = components(close_pairs(prints))
    linked = prints.join(whole, prints["fp"] == whole["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    names = linked.join(linked.groupBy("root").agg(F.min("least").alias(name)), "root").select(F.col("fp").alias(fresh([*docs.columns, name, fp], "_of")), name)
    return marked.join(names, marked[fp] == names[names.columns[0]]).select(*[F.col(f"`{c}`") for c in keep], fp, name)


def keep_one(docs: DataFrame, shingle: int = 5, id_col: str = "doc_id") -> DataFrame:
    """docs with one row of each group: the smallest id (of rows that share it, one)."""
    name = fresh(docs.columns, "component_id")
    marked = near_duplicates(docs, shingle, id_col, name=name)
    first = marked.where(F.col(f"`{id_col}`").eqNullSafe(F.col(name)))
    return first.dropDuplicates([name]).select(*[F.col(f"`{c}`") for c in docs.columns])
