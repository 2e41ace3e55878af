"""Word diffs of pairs of texts: matching blocks, longest first, and the chunks between them.

The longest run of equal words is a block (of several, the first in the old text, then in the new one); what lies left of
it on both sides is searched in the same way, and what lies right. So a block splits its pair into two pairs that need
not know of each other. Pairs whose tables of word pairs are small are searched within a task, from all diagonal runs of
equal words at once. A pair with more than ``AREA`` word pairs is first split by Spark: words meet in a join, runs are
islands on diagonals, the longest of each region is an aggregate; regions that are small enough go to tasks of their own.
Both ways give the same blocks.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labeldiff.scratch import held

#: Word pairs (words of one side times words of the other) that a task searches; equal ones that it holds at once.
AREA, MEET = 50_000_000, 2_000_000
#: Bytes of texts whose words a task holds at once; a longer pair is alone.
SLICE = 2_000_000
#: White space as Python's ``str.split`` sees it.
BLANK = "[\\x09-\\x0D\\x1C-\\x20\\x85\\xA0\\u1680\\u2000-\\u200A\\u2028\\u2029\\u202F\\u205F\\u3000]+"
CHUNKS = "position int, operation string, text string, old_start int, old_end int, new_start int, new_end int"


def coded(old: Sequence[str], new: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Words as numbers."""
    numbers: dict[str, int] = {}
    codes = np.array([numbers.setdefault(w, len(numbers)) for w in (*old, *new)], dtype=np.int64)
    return codes[: len(old)], codes[len(old) :]


def diagonal_runs(a: np.ndarray, b: np.ndarray, meet: int = MEET) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts in a, starts in b, and lengths of all maximal runs of equal numbers. Equal pairs are made in slices of a, of which the runs are kept."""
    order = np.argsort(b, kind="stable")
    low = np.searchsorted(b[order], a, side="left")
    many = np.searchsorted(b[order], a, side="right") - low
    ends = np.cumsum(many)
    cuts = np.unique(np.append(np.searchsorted(ends, np.arange(0, int(many.sum()), meet)), len(a)))
    parts = [diagonal_slice(np.arange(x, y), low[x:y], many[x:y], order) for x, y in zip(np.append(0, cuts[:-1]), cuts, strict=True) if y > x]
    i, j, size = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (order[:0],) * 3
    if len(parts) > 1:
        by = np.lexsort((i, i - j))
        i, j, size = i[by], j[by], size[by]
        first = np.flatnonzero(np.append(True, (i[1:] - j[1:] != i[:-1] - j[:-1]) | (i[1:] != i[:-1] + size[:-1])))
        i, j, size = i[first], j[first], np.add.reduceat(size, first)
    return i, j, size


def diagonal_slice(rows: np.ndarray, low: np.ndarray, many: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    total = int(many.sum())
    i = np.repeat(rows, many)
    j = order[np.repeat(low - np.cumsum(many) + many, many) + np.arange(total)]
    by = np.lexsort((i, i - j))
    i, j = i[by], j[by]
    first = np.flatnonzero(np.append(True, (np.diff(i) != 1) | (np.diff(j) != 1))[:total])
    return i[first], j[first], np.diff(np.append(first, total))


def matching_blocks(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int, int]]:
    """(start in a, start in b, length) of the blocks, in order."""
    found, todo = [], [(0, len(a), 0, len(b), *diagonal_runs(a, b))]
    while todo:
        a_low, a_high, b_low, b_high, i, j, size = todo.pop()
        cut = np.maximum(np.maximum(a_low - i, b_low - j), 0)
        size = np.minimum(np.minimum(a_high - i, b_high - j), size) - cut
        on = size > 0
        if not on.any():
            continue
        i, j, size = (i + cut)[on], (j + cut)[on], size[on]
        best = np.flatnonzero(size == size.max())
        best = best[np.lexsort((j[best], i[best]))[0]]
        x, y, n = int(i[best]), int(j[best]), int(size[best])
        found.append((x, y, n))
        left, right = (i < x) & (j < y), (i + size > x + n) & (j + size > y + n)
        todo.append((a_low, x, b_low, y, i[left], j[left], size[left]))
        todo.append((x + n, a_high, y + n, b_high, i[right], j[right], size[right]))
    return sorted(found)


def chunks_of(old: Sequence[str], new: Sequence[str], codes: tuple[np.ndarray, np.ndarray] | None = None) -> Iterator[tuple[str, Sequence[str], int, int, int, int]]:
    """(operation, words, old range, new range). A replacement is a deletion at the start of the new range, then an addition at the end of the old one."""
    at, to, run = 0, 0, 0
    for x, y, n in [*matching_blocks(*(codes or coded(old, new))), (len(old), len(new), 0)]:
        # Blocks that touch on both sides are one piece of context.
        if run and (x, y) == (at, to) and n:
            run, at, to = run + n, at + n, to + n
            continue
        if run:
            yield "CONTEXT", old[at - run : at], at - run, at, to - run, to
        if x > at:
            yield "DELETION", old[at:x], at, x, to, to
        if y > to:
            yield "ADDITION", new[to:y], x, x, to, y
        at, to, run = x + n, y + n, n


def words(value: Column) -> Column:
    """Runs of anything but white space; null has none."""
    return F.filter(F.split(F.coalesce(value, F.lit("")), BLANK), lambda w: w != "")


def text_chunks(pairs: DataFrame, keys: list[str], area: int = AREA) -> DataFrame:
    """One row per chunk of every pair's text diff. pairs: keys, old_text, new_text; null texts have no words."""
    rows = pairs.select(*keys, F.col("old_text").alias("a"), F.col("new_text").alias("b"))
    # A text has at most half as many words as characters, so few pairs are counted.
    may = F.length("a").cast("long") * F.length("b") > 4 * area
    large = F.coalesce(may & (F.size(words(F.col("a"))).cast("long") * F.size(words(F.col("b"))) > area), F.lit(False))
    short, long = short_chunks(rows.where(~large), keys), rows.where(large)
    if long.isEmpty():
        return short
    return short.unionByName(long_chunks(held(long.select(*keys, words(F.col("a")).alias("a"), words(F.col("b")).alias("b")), "long-pairs"), keys, area))


def slices(batch: pa.RecordBatch, columns: tuple[int, ...], size: int = SLICE) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of about ``size`` bytes of text in the columns; a larger row is a part of its own. Words take many times the bytes of their text, so a whole batch would fill a task."""
    ends = np.cumsum([0, *(sum(x or 0 for x in row) for row in zip(*(pc.binary_length(batch.column(c)).to_pylist() for c in columns), strict=True))])
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + size, side="right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def short_chunks(rows: DataFrame, keys: list[str]) -> DataFrame:
    """A map over pairs (keys, a, b as texts): no shuffle. Memory goes with a slice of pairs, not with a batch."""
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keys).schema), CHUNKS])
    names = [*keys, "position", "operation", "text", "old_start", "old_end", "new_start", "new_end"]
    kinds = [pa.int32(), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int32()]
    n = len(keys)

    def run(batches):
        for batch in (part for whole in batches for part in slices(whole, (n, n + 1))):
            found, of = [], []
            sides = [[(t or "").split() for t in batch.column(m).to_pylist()] for m in (n, n + 1)]
            codes = np.asarray(pa.array([w for side in sides for own in side for w in own], pa.string()).dictionary_encode().indices).astype(np.int64)
            old_ends = np.append(0, np.cumsum([len(w) for w in sides[0]]))
            new_ends = old_ends[-1] + np.append(0, np.cumsum([len(w) for w in sides[1]]))
            for k, (old, new) in enumerate(zip(*sides, strict=True)):
                both = codes[old_ends[k] : old_ends[k + 1]], codes[new_ends[k] : new_ends[k + 1]]
                own = [(p, op, " ".join(w), *spans) for p, (op, w, *spans) in enumerate(chunks_of(old, new, both))]
                found += own
                of += [k] * len(own)
            if found:
                at = pa.array(of, pa.int32())
                yield pa.RecordBatch.from_arrays([*(c.take(at) for c in batch.columns[:n]), *(pa.array(c, t) for c, t in zip(zip(*found, strict=True), kinds, strict=True))], names=names)

    return rows.mapInArrow(run, schema)


REGION = ["a_low", "a_high", "b_low", "b_high"]


def longest(regions: DataFrame, old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """The block of every region that has one: (keys, region, i, j, n). Words meet by a join, so popular ones are spread; a diagonal's islands are numbered within the diagonal."""
    c = F.col
    met = regions.join(old, keys).where((c("i") >= c("a_low")) & (c("i") < c("a_high"))).join(new, [*keys, "word"]).where((c("j") >= c("b_low")) & (c("j") < c("b_high")))
    at = [*keys, *REGION, "d"]
    islands = met.withColumn("d", c("i") - c("j")).withColumn("run", c("i") - F.row_number().over(Window.partitionBy(*at).orderBy("i")))
    runs = islands.groupBy(*at, "run").agg(F.min("i").alias("i"), F.count(F.lit(1)).alias("n"))
    best = runs.groupBy(*keys, *REGION).agg(F.max(F.struct("n", (-c("i")).alias("i"), (c("d") - c("i")).alias("j"))).alias("m"))
    return best.select(*keys, *REGION, (-c("m.i")).alias("i"), (-c("m.j")).alias("j"), c("m.n").cast("int").alias("n"))


def long_blocks(rows: DataFrame, keys: list[str], area: int) -> DataFrame:
    """(keys, i, j, n): the blocks of pairs that Spark splits. rows: held (keys, a, b). A round finds a block in every open region; regions of at most ``area`` word pairs are searched in tasks."""
    c = F.col
    side = lambda s, p: held(rows.select(*keys, F.posexplode(s).alias(p, "word")), "long-words")
    old, new = side("a", "i"), side("b", "j")
    zero = F.lit(0)
    opened = rows.select(*keys, zero.alias("a_low"), F.size("a").alias("a_high"), zero.alias("b_low"), F.size("b").alias("b_high"))
    blocks, closed = [], []
    while True:
        found = held(longest(opened, old, new, keys), "long-blocks")
        blocks.append(found.select(*keys, "i", "j", "n"))
        halves = F.array(F.struct(c("a_low"), c("i").alias("a_high"), c("b_low"), c("j").alias("b_high")), F.struct((c("i") + c("n")).alias("a_low"), c("a_high"), (c("j") + c("n")).alias("b_low"), c("b_high")))
        parts = found.select(*keys, F.inline(halves)).where("a_low < a_high AND b_low < b_high")
        size = (c("a_high") - c("a_low")).cast("long") * (c("b_high") - c("b_low"))
        closed.append(parts.where(size <= area))
        opened = held(parts.where(size > area), "long-regions")
        if opened.isEmpty():
            break
    cut = lambda s: F.slice(c(s), c(f"{s}_low") + 1, c(f"{s}_high") - c(f"{s}_low")).alias(f"_{s}")
    small = reduce(DataFrame.unionByName, closed).join(rows, keys).select(*keys, "a_low", "b_low", cut("a"), cut("b"))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keys).schema), "i int, j int, n int"])
    n = len(keys)

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                x, y, old_words, new_words = (batch.column(n + m)[k].as_py() for m in range(4))
                own = matching_blocks(*coded(old_words, new_words))
                if own:
                    i, j, size = (pa.array(v, pa.int32()) for v in zip(*((i + x, j + y, m) for i, j, m in own), strict=True))
                    yield pa.RecordBatch.from_arrays([*(col.take(pa.array([k] * len(own))) for col in batch.columns[:n]), i, j, size], names=[*keys, "i", "j", "n"])

    # Regions of one pair are dealt apart.
    return reduce(DataFrame.unionByName, blocks).unionByName(small.repartition(*keys, "a_low").mapInArrow(run, schema))


def long_chunks(rows: DataFrame, keys: list[str], area: int) -> DataFrame:
    """The chunks of pairs that Spark splits, from their blocks: what touches is joined, and what lies between is deleted and added."""
    c = F.col
    ends = rows.select(*keys, F.size("a").alias("i"), F.size("b").alias("j"), F.lit(0).alias("n"))
    in_order = Window.partitionBy(*keys).orderBy("i", "j", F.desc("n"))
    before = lambda x: F.lag(c(x) + c("n"), 1, 0).over(in_order)
    every = long_blocks(rows, keys, area).unionByName(ends)
    joined = every.withColumn("new", F.when((c("i") == before("i")) & (c("j") == before("j")) & (c("n") > 0) & (F.row_number().over(in_order) > 1), 0).otherwise(1))
    joined = joined.withColumn("g", F.sum("new").over(in_order)).groupBy(*keys, "g").agg(F.min("i").alias("i"), F.min("j").alias("j"), F.sum("n").cast("int").alias("n"))
    joined = joined.select(*keys, "i", "j", "n", before("i").cast("int").alias("at"), before("j").cast("int").alias("to"))
    one = lambda op, *spans: F.struct(F.lit(op).alias("operation"), *[s.cast("int").alias(n) for s, n in zip(spans, ("old_start", "old_end", "new_start", "new_end"), strict=True)])
    three: list[Column] = [one("DELETION", c("at"), c("i"), c("to"), c("to")), one("ADDITION", c("i"), c("i"), c("to"), c("j")), one("CONTEXT", c("i"), c("i") + c("n"), c("j"), c("j") + c("n"))]
    kept = F.filter(F.array(*three), lambda x: (x["old_end"] > x["old_start"]) | (x["operation"] == "ADDITION") & (x["new_end"] > x["new_start"]))
    # A pair's chunks meet its words once, not once for each chunk.
    whole = joined.groupBy(*keys).agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("i", "j", (-c("n")).alias("m"), kept.alias("k")))), lambda x: x["k"])).alias("chunks")).join(rows, keys)
    told = lambda x, p: F.struct(p.alias("position"), x["operation"].alias("operation"), F.array_join(F.when(x["operation"] == "ADDITION", F.slice(c("b"), x["new_start"] + 1, x["new_end"] - x["new_start"])).otherwise(F.slice(c("a"), x["old_start"] + 1, x["old_end"] - x["old_start"])), " ").alias("text"), *[x[n].alias(n) for n in ("old_start", "old_end", "new_start", "new_end")])
    return whole.select(*keys, F.inline(F.transform("chunks", told)))
