"""Exact top-k search by inner product over a vector-approximation file.

A component counts as floor(scale * x). The file holds, for each vector, the cell of every component (up to 7 bits)
beside the exact vector in another column. Each dimension has cells of its own: quantiles of a bounded sample
(``SAMPLE`` rows, by hash), and one open cell on either side that reaches to the dimension's exact least and largest
value, so one outlier widens the bounds of its own vector only.

A search scans the cells alone: their edges bound each product from below and above, the bounds are widened by what
floating point may lose, so they hold for components of any size. A task keeps a candidate while its upper bound reaches
the k-th best lower bound of distinct ids that it has met. Exact vectors are then read in order of bounds: first the k
with the highest upper bounds of each query, which fixes a score that any result must reach, then those whose upper
bound still reaches it. No unread vector can enter the result, so it is exact. Products are summed exactly: in float64
where all sums stay below 2^53, in whole numbers of any size elsewhere.

Copies: of vectors equal in all cells' integers only the k + 1 smallest ids can ever be in a result (one may be the
query itself), so the file keeps those; the limit is pushed below the shuffle, and a vector that a third of all rows
share costs k + 1 rows a task. Queries are scanned in blocks of bounded bytes, each broadcast and run on its own, so no
plan grows with their number; candidates are never crossed with them as rows.

Defined results: null vectors, vectors with null or non-finite components (also after scaling) and rows without id take
no part; missing components of shorter vectors count as zero; rows that share id and vector count once; a candidate with
the query's id is the query's own; if one id has several vectors, the smallest is its query and the best score counts; a
score beyond a long is ranked by its exact value and returned as the nearest long; other columns are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labeldiff.llm.common import received, shipped, stored
from labeldiff.scratch import place

#: Bytes of queries in one broadcast block; rows and queries scanned at once; rows of the sample that fixes the cells (fewer where vectors are long: at most SAMPLE_VALUES components).
BLOCK_BYTES, ROWS, LANES, SAMPLE, SAMPLE_VALUES = 16_000_000, 2048, 512, 20_000, 8_000_000
#: Candidates a task holds before it prunes or sends them on; tasks over which the candidates of one query are dealt.
HELD, SALTS = 200_000, 16
FAR = float("-inf")


def scaled(vectors: DataFrame, id_col: str, vec_col: str, scale: float) -> DataFrame:
    """(vec_id, q): floor(scale * x) as whole doubles, of the rows that take part."""
    q = F.transform(F.col(f"`{vec_col}`"), lambda x: x.cast("double") * F.lit(scale))
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), q.alias("q")).where("vec_id IS NOT NULL AND q IS NOT NULL")
    finite = F.forall("q", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    # Spark's floor gives a long; beyond 2^53 a double is whole already. Adding 0 turns -0 into 0.
    whole = F.transform("q", lambda x: F.when(F.abs(x) < float(2**53), F.floor(x).cast("double")).otherwise(x) + F.lit(0.0))
    return rows.where(finite).select("vec_id", whole.alias("q"))


def matrix(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a list column, zero-filled to one width, as float64, and their own lengths."""
    flat, size = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64), np.asarray(column.value_lengths())
    if len(size) and (size == width).all():
        return flat.reshape(-1, width), size
    out = np.zeros((len(size), width))
    out[np.arange(width)[None, :] < size[:, None]] = flat
    return out, size


def extremes(width: int):
    """For mapInArrow over (q): least and largest value of each dimension in the task."""

    def run(batches):
        low, high = np.full(width, np.inf), np.full(width, -np.inf)
        for batch in batches:
            got, size = matrix(batch["q"], width)
            own = np.arange(width)[None, :] < size[:, None]
            low = np.minimum(low, np.where(own, got, np.inf).min(0, initial=np.inf))
            high = np.maximum(high, np.where(own, got, -np.inf).max(0, initial=-np.inf))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), pa.array(low), pa.array(high)], names=["d", "low", "high"])

    return run


class Cells:
    """cuts[d]: ascending edges; a value's cell is the number of edges at or below it. under/over[d, cell]: its bounds; the last column is zero, for components that a shorter vector does not have."""

    def __init__(self, sample: list[list[float]], low: np.ndarray, high: np.ndarray, bits: int):
        width, n = len(low), 2**bits - 1
        self.cuts = np.zeros((width, n))
        self.under, self.over = np.zeros((width, n + 2)), np.zeros((width, n + 2))
        for d in range(width):
            own = np.sort([r[d] for r in sample if len(r) > d])
            cuts = own[np.linspace(0, len(own) - 1, n).astype(int)] if len(own) else np.zeros(n)
            self.cuts[d] = cuts
            edge = [float(low[d]) if np.isfinite(low[d]) else 0.0, float(high[d]) if np.isfinite(high[d]) else 0.0]
            self.under[d, : n + 1] = [edge[0], *cuts]
            self.over[d, : n + 1] = [*cuts, edge[1]]

    def code(self, values: np.ndarray, size: np.ndarray) -> np.ndarray:
        out = np.stack([np.searchsorted(c, v, side="right") for c, v in zip(self.cuts, values.T, strict=True)], axis=1) if values.shape[1] else np.zeros(values.shape)
        out[np.arange(values.shape[1])[None, :] >= size[:, None]] = -1
        return out.astype(np.int8)


def add_codes(model, width: int):
    """For mapInArrow over (rid, vec_id, q)."""

    def run(batches):
        cells = received(model)
        for batch in batches:
            code = cells.code(*matrix(batch["q"], width))
            codes = pa.FixedSizeListArray.from_arrays(pa.array(code.reshape(-1)), width).cast(pa.list_(pa.int8())) if width else pa.array([[]] * batch.num_rows, pa.list_(pa.int8()))
            yield pa.RecordBatch.from_arrays([batch["rid"], batch["vec_id"], codes, batch["q"]], names=["rid", "vec_id", "code", "q"])

    return run


def build(whole: DataFrame, k: int, width: int, bits: int = 7) -> tuple[DataFrame, Cells]:
    """The file as a table (rid, vec_id, code, q), and its cells. whole: (vec_id, q)."""
    if not 1 <= bits <= 7:
        raise ValueError("1 to 7 bits a component")
    spark = whole.sparkSession
    same = Window.partitionBy("q").orderBy("vec_id")
    kept = whole.withColumn("_r", F.dense_rank().over(same)).where(F.col("_r") <= k + 1)
    kept = kept.withColumn("_l", F.lag("vec_id").over(same)).where(F.col("_l").isNull() | (F.col("_l") != F.col("vec_id")))
    kept = stored(kept.select(F.monotonically_increasing_id().alias("rid"), "vec_id", "q"), "va-rows")
    ends = kept.select("q").mapInArrow(extremes(width), "d long, low double, high double").groupBy("d").agg(F.min("low").alias("low"), F.max("high").alias("high")).orderBy("d").collect()
    rows = min(SAMPLE, max(1, SAMPLE_VALUES // max(1, width)))
    sample = [r.q for r in kept.orderBy(F.xxhash64("rid"), "rid").limit(rows).select("q").collect()]
    cells = Cells(sample, np.array([r.low for r in ends]), np.array([r.high for r in ends]), bits)
    return stored(kept.mapInArrow(add_codes(shipped(spark, cells), width), "rid long, vec_id long, code array<tinyint>, q array<double>"), "va-file"), cells


def merged_top(best: np.ndarray, owner: np.ndarray, value: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of what is held (best, owner: lanes x k) and of value (lanes x rows of ids), each id once."""
    n = min(2 * k, value.shape[1])
    at = np.argpartition(value, -n, axis=1)[:, -n:]
    both = np.concatenate([best, np.take_along_axis(value, at, axis=1)], axis=1)
    names = np.concatenate([owner, ids[at]], axis=1)
    order = np.argsort(-both, axis=1, kind="stable")
    both, names = np.take_along_axis(both, order, axis=1), np.take_along_axis(names, order, axis=1)
    again = (names[:, :, None] == names[:, None, :]) & np.tri(names.shape[1], k=-1, dtype=bool)[None]
    both[again.any(2)] = FAR
    order = np.argsort(-both, axis=1, kind="stable")[:, :k]
    return np.take_along_axis(both, order, axis=1), np.take_along_axis(names, order, axis=1)


def scan(block, model, k: int):
    """For mapInArrow over (rid, vec_id, code): candidates of each query whose upper bound reaches the k-th lower bound met in the task."""

    def run(batches):
        ids, queries = received(block)
        cells, width = received(model), queries.shape[1]
        up, down = np.maximum(queries, 0), np.minimum(queries, 0)
        reach = np.abs(queries).sum(1)
        best, owner = np.full((len(ids), k), FAR), np.full((len(ids), k), -1, dtype=np.int64)
        none = np.zeros(0)
        found = [(none.astype(int), none.astype(np.int64), none.astype(np.int64), none, none)]
        dims = np.arange(width)[None, :]

        def pruned():
            a, rid, vec_id, low, high = (np.concatenate(x) for x in zip(*found, strict=True))
            keep = high >= best[a, k - 1]
            return a[keep], rid[keep], vec_id[keep], low[keep], high[keep]

        def rows(a, rid, vec_id, low, high):
            for at in range(0, len(a), 20_000):
                s = slice(at, at + 20_000)
                yield pa.RecordBatch.from_arrays([pa.array(ids[a[s]]), pa.array(rid[s]), pa.array(vec_id[s]), pa.array(low[s]), pa.array(high[s])], names=["query_id", "rid", "vec_id", "lb", "ub"])

        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                vec_id, rid = part["vec_id"].to_numpy(), part["rid"].to_numpy()
                code = part["code"].flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
                under, over = cells.under[dims, code], cells.over[dims, code]
                size = np.maximum(np.abs(under), np.abs(over)).max(1, initial=0)
                # Rows of one id in the slice count once: the last by id holds the largest lower bound of them.
                unique, first = np.unique(vec_id, return_inverse=True)
                for lane in range(0, len(ids), LANES):
                    s = slice(lane, lane + LANES)
                    with np.errstate(over="ignore", invalid="ignore"):
                        lost = (4 * width + 16) * 2.0**-53 * np.outer(reach[s], size)
                        low = up[s] @ under.T + down[s] @ over.T - lost
                        high = up[s] @ over.T + down[s] @ under.T + lost
                    low[~np.isfinite(low)] = FAR
                    high[~np.isfinite(high)] = np.inf
                    own = ids[s][:, None] == vec_id[None, :]
                    low[own], high[own] = FAR, FAR
                    if len(unique) < len(vec_id):
                        top = np.full((low.shape[0], len(unique)), FAR)
                        np.maximum.at(top, (slice(None), first), low)
                    else:
                        top = low[:, np.argsort(first)]
                    best[s], owner[s] = merged_top(best[s], owner[s], top, unique, k)
                    a, b = np.nonzero((high > FAR) & (high >= best[s][:, k - 1 :]))
                    found.append((a + lane, rid[b], vec_id[b], low[a, b], high[a, b]))
                if sum(len(x[0]) for x in found) > HELD:
                    found = [pruned()]
                    if len(found[0][0]) > HELD // 2:
                        yield from rows(*found.pop())
                        found = [(none.astype(int), none.astype(np.int64), none.astype(np.int64), none, none)]
        yield from rows(*pruned())

    return run


def exact_products(width: int):
    """For mapInArrow over (query_id, vec_id, query, q): the whole-number score as the nearest long, and what ranks equal longs."""

    def run(batches):
        for batch in batches:
            a, b = matrix(batch["query"], width)[0], matrix(batch["q"], width)[0]
            with np.errstate(over="ignore", invalid="ignore"):
                safe = np.abs(a * b).sum(1) < 2.0**53
                score = np.where(safe, np.einsum("ij,ij->i", a, b), 0).astype(np.int64)
            rest = ["5"] * batch.num_rows
            for i in np.flatnonzero(~safe):
                total = sum(int(x) * int(y) for x, y in zip(a[i], b[i], strict=True))
                near = min(max(total, -(2**63)), 2**63 - 1)
                score[i] = near
                if near != total:
                    digits = f"{len(str(abs(total))):05d}{abs(total)}"
                    rest[i] = f"9{digits}" if total > 0 else "1" + digits.translate(str.maketrans("0123456789", "9876543210"))
            yield pa.RecordBatch.from_arrays([batch["query_id"], batch["vec_id"], pa.array(score), pa.array(rest, pa.string())], names=["query_id", "vec_id", "score", "rest"])

    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding", scale: float = 1024.0, bits: int = 7, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k highest integer inner products, ties to the smaller id."""
    spark = vectors.sparkSession
    whole = scaled(vectors, id_col, vec_col, scale)
    asked = scaled(vectors.where(is_query), id_col, vec_col, scale).groupBy(F.col("vec_id").alias("query_id")).agg(F.min("q").alias("query"))
    asked = stored(asked, "va-queries")
    width = whole.agg(F.coalesce(F.max(F.size("q")), F.lit(0))).first()[0]
    n_asked = asked.count()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if not n_asked:
        return empty
    va, cells = build(whole, k, width, bits)
    model = shipped(spark, cells)
    blocks = max(1, -(-n_asked * 8 * max(1, width) // block_bytes))
    folder = place(spark, "va-bounds")
    for i in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == i).collect()
        queries = np.zeros((len(rows), width))
        for j, r in enumerate(rows):
            queries[j, : len(r.query)] = r.query
        block = shipped(spark, (np.array([r.query_id for r in rows], dtype=np.int64), queries))
        found = va.select("rid", "vec_id", "code").mapInArrow(scan(block, model, k), "query_id long, rid long, vec_id long, lb double, ub double")
        found.write.mode("append").parquet(folder)
        block.destroy()
    found = spark.read.schema("query_id long, rid long, vec_id long, lb double, ub double").parquet(folder)
    # No window sees all candidates of a query: Spark limits each of these to k rows a query before it shuffles.
    highest = lambda rows, *order: rows.withColumn("_o", F.row_number().over(Window.partitionBy("query_id").orderBy(*order))).where(F.col("_o") <= k)

    # Candidates of one query meet what belongs to the query in SALTS tasks, not in one.
    salt, spread = F.pmod("rid", F.lit(SALTS)).cast("int"), lambda rows: rows.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))

    def read(candidates: DataFrame) -> DataFrame:
        rows = candidates.select("query_id", "rid", "vec_id", salt.alias("salt")).join(va.select("rid", "q"), "rid").join(spread(asked), ["query_id", "salt"])
        return rows.select("query_id", "vec_id", "query", "q").mapInArrow(exact_products(width), "query_id long, vec_id long, score long, rest string")

    first = stored(read(highest(found, F.desc("ub"), "vec_id", "rid")), "va-first")
    certain = first.groupBy("query_id").agg(F.when(F.count_distinct("vec_id") >= k, F.min("score")).alias("least"))
    # A long that was cut off, or a score that a double cannot hold, is compared from the safe side.
    reach = F.col("least").cast("double") - F.abs(F.col("least").cast("double")) * F.lit(2.0**-50)
    rest = found.withColumn("salt", salt).join(spread(certain), ["query_id", "salt"], "left").where(F.col("least").isNull() | (F.col("ub") >= reach))
    scored = read(rest).groupBy("query_id", "vec_id").agg(F.max(F.struct("score", "rest")).alias("best")).select("query_id", "vec_id", "best.*")
    best = highest(scored, F.desc("score"), F.desc("rest"), "vec_id")
    return best.select("query_id", F.col("_o").alias("rank"), "vec_id", "score")
