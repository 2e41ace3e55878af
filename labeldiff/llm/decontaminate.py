"""Benchmark decontamination by a prefix-filtered join with exact containment of item-sized windows.

Each item is cut into windows of ``window`` consecutive words (a shorter item is one window). A window's tokens are
ordered by rarity, their count over all documents (ties: the smaller word). For a containment of t the necessary prefix
of m tokens is the m - ceil(t * m) + 1 rarest; a window must be contained whole, so it is one: the rarest, which has the
fewest places to try. Documents are joined with the prefixes token by token, by a broadcast table of them: a place of the
prefix token fixes where the window would start; positional and length bounds drop starts before the first word and ends
after the last; the rest are verified word by word.

The counts are of the benchmark's words only, summed in each task before the shuffle. The index is broadcast in blocks
of items of at most ``BLOCK_WORDS`` words, one after the other over the same rows, so its size is bounded however large
the benchmark is. Texts are not shuffled.

Defined results: null and empty texts have no words and are clean; an item without words has no windows; equal windows
of several items count for each; repeated item rows count once; null item ids are ignored; an empty benchmark leaves
all documents clean; extra columns are kept.
"""

from __future__ import annotations

from collections import Counter
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labeldiff.llm.common import ALNUM, fresh, text_bytes

#: Words of items in one broadcast block.
BLOCK_WORDS = 1_000_000


def count_words(wanted: set[bytes]):
    """For mapInArrow: counts of the wanted words, one row per word and task."""

    def run(batches):
        seen: Counter = Counter()
        for batch in batches:
            for text in batch.column(0):
                words = text.as_buffer().to_pybytes().translate(ALNUM).split()
                if not wanted.isdisjoint(words):
                    seen.update(filter(wanted.__contains__, words))
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])

    return run


def rarity(docs: DataFrame, vocabulary: set[bytes], text_col: str) -> dict[bytes, int]:
    """Counts over all documents of a vocabulary that is bounded by the block of items."""
    rows = docs.select(text_bytes(f"`{text_col}`").alias("t")).mapInArrow(count_words(vocabulary), "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    return {bytes(r.word): r.n for r in rows}


def prefix_index(items: list[tuple[str, list[bytes]]], counts: dict[bytes, int], window: int) -> dict[bytes, list[tuple[int, list[bytes], tuple[str, ...]]]]:
    """prefix word -> (its offset in the window, the window, the items that have it)."""
    owners: dict[tuple[bytes, ...], set[str]] = {}
    for name, words in items:
        for i in range(max(1, len(words) - window + 1)):
            owners.setdefault(tuple(words[i : i + window]), set()).add(name)
    index: dict[bytes, list] = {}
    for w, names in owners.items():
        rarest = min(w, key=lambda x: (counts.get(x, 0), x))
        index.setdefault(rarest, []).append((w.index(rarest), list(w), tuple(sorted(names))))
    return index


def occurrences(words: list[bytes], index: dict) -> tuple[list[tuple[int, int]], set[str]]:
    """Disjoint, sorted word ranges that windows cover, and the items whose windows occur."""
    spans, names = [], set()
    n = len(words)
    for i, word in enumerate(words):
        for offset, w, owners in index.get(word, ()):
            start = i - offset
            if start >= 0 and start + len(w) <= n and words[start : start + len(w)] == w:
                spans.append((start, start + len(w)))
                names.update(owners)
    return merged(spans), names


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


MARKS = [("n_words", pa.int64()), ("spans", pa.list_(pa.list_(pa.int64()))), ("items", pa.list_(pa.string()))]


def marks_beside(keep: list[str]) -> list[str]:
    """Names of n_words, spans and items, with underscores behind where a column has that name."""
    out: list[str] = []
    for name, _ in MARKS:
        out.append(fresh([*keep, *out], name))
    return out


def mark(index: dict, known: frozenset, n_keep: int, names: list[str], first: bool):
    """For mapInArrow: keeps the first n_keep columns; the next is the text; a later block adds to what earlier ones found."""

    def run(batches):
        for batch in batches:
            out: list[list] = [[], [], []]
            before = [c.to_pylist() for c in batch.columns[n_keep + 1 :]]
            for k, text in enumerate(batch.column(n_keep)):
                words = text.as_buffer().to_pybytes().translate(ALNUM).split()
                spans, items = ([], set()) if known.isdisjoint(words) else occurrences(words, index)
                if not first:
                    spans, items = merged([*spans, *map(tuple, before[1][k])]), items | set(before[2][k])
                out[0].append(len(words))
                out[1].append(spans)
                out[2].append(sorted(items))
            found = [pa.array(x, kind) for x, (_, kind) in zip(out, MARKS, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: n_keep + 1], *found], names=names)

    return run


def blocks_of(items: DataFrame, id_col: str, text_col: str, limit: int) -> list[list[tuple[str, bytes]]]:
    """The items in blocks of bounded size: rows are dealt by a hash of the id into as many blocks as the words ask for."""
    rows = items.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("string").alias("i"), text_bytes(text_col).alias("t")).distinct()
    size = rows.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()[0]
    n = max(1, -(-size // (8 * limit)))
    blocks = [[(r.i, bytes(r.t)) for r in rows.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == k).collect()] for k in range(n)]
    return [b for b in blocks if b] or [[]]


def find_windows(docs: DataFrame, items: DataFrame, window: int = 10, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", keep: list[str] | None = None, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The columns ``keep`` (default: all) with n_words, spans (covered word ranges, disjoint) and items (ids as sorted strings); ``marks_beside(keep)`` has the names of these three."""
    keep = docs.columns if keep is None else keep
    marks = marks_beside(keep)
    kept = docs.select(*[F.col(f"`{c}`") for c in keep])
    sent = fresh([*keep, *marks], "_text")
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], text_bytes(f"`{text_col}`").alias(sent))
    base = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema), f"`{sent}` binary"])
    schema = base + ", " + ", ".join(f"`{m}` {kind}" for m, kind in zip(marks, ("long", "array<array<long>>", "array<string>"), strict=True))
    names = [*keep, sent, *marks]
    first = True
    for block in blocks_of(items, item_id, item_text, block_words):
        cut = [(name, words) for name, text in block if (words := text.translate(ALNUM).split())]
        vocabulary = set(chain.from_iterable(w for _, w in cut))
        index = prefix_index(cut, rarity(docs, vocabulary, text_col) if cut else {}, window)
        rows = rows.mapInArrow(mark(index, frozenset(index), len(keep), names, first), schema)
        first = False
    return rows.drop(sent)


def hit_words() -> Column:
    return F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x[1] - x[0])


def report(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row per document: words, words inside any occurrence, items that occur, their digest."""
    found = find_windows(docs, items, keep=["doc_id"])
    return found.select(
        "doc_id",
        "n_words",
        hit_words().alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
        "items",
        "spans",
    )


def clean(docs: DataFrame, items: DataFrame, window: int = 10) -> DataFrame:
    """docs without those that contain a window of an item; their columns unchanged."""
    _, spans, _ = marks_beside(docs.columns)
    return find_windows(docs, items, window).where(F.size(F.col(f"`{spans}`")) == 0).select(*[F.col(f"`{c}`") for c in docs.columns])
