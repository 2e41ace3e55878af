"""Byte-level BPE over a table of documents: encoding by corpus-level merge replay, and decoding.

A task takes its documents in blocks of ``BLOCK_BYTES`` of text. The words of a block (matches of the vocabulary's
pattern) are numbered, so each distinct word is merged once however often it occurs. An inverted index from token pair
to word positions then replays the merges of the block in rank order: the lowest rank that has positions is applied to
all of them, and only the two neighbours of a merged pair enter the index again. A word that is a token as a whole is
that token, without merges. Blocks know nothing of each other: no shuffle, no state to lose, a lost task runs again.

The order is that of one word on its own (lowest rank first, then leftmost): positions of a rank that overlap are taken
from the left; where a merge would meet a lower rank at once (possible, since ranks are not bound to grow with length;
only tokens in ``early``), its word goes on one position at a time, lower ranks first.

The published pattern is split with arrays of character classes, asked of the tokenizer library itself once on the
driver, so both agree on every code point whatever Unicode version either knows. Any other pattern is matched by the
``regex`` library, where characters that the tokenizer library does not know count as private ones.

Defined results: a null text is an empty one and has no ids; an empty table gives no rows; repeated rows are rows of
their own; a text of any length is encoded whole; if a kept column is called like the result, the result gets an
underscore. ``decode`` takes null ids as none and refuses ids that the vocabulary lacks.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labeldiff.llm.common import fresh, received, shipped

#: Bytes of text in a block, characters split at once, symbols in one index (a longer word has one of its own), ids in a batch that goes back.
BLOCK_BYTES, SLICE, SYMBOLS, IDS = 12_000_000, 2_000_000, 2_000_000, 4_000_000
NONE = np.int32(2**31 - 1)
LETTER, NUMBER, SPACE = 1, 2, 3


def ranks_of(path: str) -> dict[bytes, int]:
    """A rank file: a token in base64 and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def known_classes() -> np.ndarray:
    """Of each code point: letter, number, space or none, as the tokenizer library classes it."""
    import tiktoken

    every = "".join(map(chr, (c for c in range(0x110000) if not 0xD800 <= c < 0xE000)))
    out = np.zeros(0x110000, dtype=np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        asked = tiktoken.Encoding("classes", pat_str=pattern, mergeable_ranks={bytes([b]): b for b in range(256)}, special_tokens={})
        out[np.frombuffer(bytes(asked.encode_ordinary(every)).decode().encode("utf-32-le"), dtype=np.uint32)] = kind
    return out


class Vocabulary:
    """Ranks with what the replay needs of them; its size depends on the vocabulary only."""

    def __init__(self, ranks: dict[bytes, int], pattern: str | None = None):
        import public_tokenizers

        if missing := [b for b in range(256) if bytes([b]) not in ranks]:
            raise ValueError(f"a byte-level vocabulary holds every byte; {len(missing)} are missing")
        self.ranks, self.pattern = ranks, pattern or public_tokenizers.PATTERN
        self.published = self.pattern == public_tokenizers.PATTERN
        self.classes = known_classes()
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.bytes = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        made = {}
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    made[(a << 32) | b] = rank
        self.keys = np.array(sorted(made), dtype=np.int64)
        self.made = np.array([made[k] for k in self.keys.tolist()], dtype=np.int32)
        #: Tokens that some merge of a lower rank continues.
        self.early = {t for key, rank in made.items() for t in (key >> 32, key & 0xFFFFFFFF) if rank < t}

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank that each pair merges to, or NONE."""
        if not len(self.keys):
            return np.full(len(left), NONE, dtype=np.int32)
        key = (left.astype(np.int64) << 32) | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.made[at], NONE)

    def decode(self, ids: Sequence[int]) -> bytes:
        try:
            return b"".join(map(self.tokens.__getitem__, ids))
        except KeyError as e:
            raise ValueError(f"the vocabulary has no id {e.args[0]}") from None


def piece_starts(codes: np.ndarray, first: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Whether a word of the published pattern starts at each code point. first (one longer than codes): starts of texts, and the end."""
    n = len(codes)
    kind = classes[codes]
    edge = first.copy()
    edge[1:n] |= kind[1:] != kind[:-1]
    # The last white space of a run stands apart if something follows; a blank there joins what follows.
    tail = (kind == SPACE) & edge[1:] & ~first[1:]
    start = edge[:n] | tail
    start[1:] &= ~(tail[:-1] & (codes[:-1] == 32))
    at = np.flatnonzero((codes[:-1] == 39) & start[:-1] & (kind[1:] == LETTER) & ~first[1:n])
    if len(at):
        one = codes[at + 1]
        two = np.where((at + 2 < n) & ~first[at + 2], codes[np.minimum(at + 2, n - 1)], 0)
        size = np.where(np.isin(one, [*map(ord, "stmd")]), 2, 0)
        for a, b in ("re", "ve", "ll"):
            size[(one == ord(a)) & (two == ord(b))] = 3
        at, size = at[size > 0], size[size > 0]
        start[at + 1] = False
        start[(at + size)[at + size < n]] = True
    return start


def split_published(data: np.ndarray, offsets: np.ndarray, classes: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Words of texts (UTF-8 bytes between offsets), and how many each text has."""
    raw = data[offsets[0] : offsets[-1]]
    ends = offsets - offsets[0]
    if raw.size and raw.max() >= 128:
        codes = np.frombuffer(raw.tobytes().decode().encode("utf-32-le"), dtype=np.uint32)
        place = np.zeros(len(codes) + 1, dtype=np.int64)
        np.cumsum(1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000), out=place[1:])
        bounds = np.searchsorted(place, ends)
    else:
        codes, place, bounds = raw, None, ends
    first = np.zeros(len(codes) + 1, dtype=bool)
    first[bounds] = first[0] = first[-1] = True
    at = np.flatnonzero(piece_starts(codes, first, classes)) if len(codes) else np.zeros(0, dtype=np.int64)
    counts = np.diff(np.searchsorted(at, bounds))
    places = np.append(at if place is None else place[at], len(raw)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(places), pa.py_buffer(raw)]), counts


def split_other(texts: Sequence[str], pattern: str, classes: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """As split_published, for any pattern; what no match covers is left out."""
    import regex

    match, words, counts = regex.compile(pattern), [], []
    strange = odd_characters(classes)
    for text in texts:
        seen = text if text.isascii() else text.translate(strange)
        own = [text[m.start() : m.end()].encode() for m in match.finditer(seen)]
        words += own
        counts.append(len(own))
    return pa.array(words, pa.binary()), np.array(counts, dtype=np.int64)


_strange: dict[int, int] = {}


def odd_characters(classes: np.ndarray) -> dict[int, int]:
    """Code points that the regex library classes otherwise, to a private one."""
    if not _strange:
        import regex

        for c in np.flatnonzero(classes == 0).tolist():
            if not 0xD800 <= c < 0xE000 and regex.match(r"[\p{L}\p{N}\s]", chr(c)):
                _strange[c] = 0xE000
        _strange.setdefault(0xE000, 0xE000)
    return _strange


def replay(words: pa.Array, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all words one after the other, and how many each has. words: distinct, none empty."""
    ends = np.frombuffer(words.buffers()[1], dtype=np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    data = np.frombuffer(words.buffers()[2], dtype=np.uint8)[ends[0] : ends[-1]]
    n, starts = len(data), ends[:-1] - ends[0]
    token = np.append(vocabulary.bytes[data], np.int32(-1))
    # Position n stands for "none" on either side of a word.
    after, before = np.arange(1, n + 2), np.arange(-1, n)
    after[ends[1:] - ends[0] - 1], before[starts], after[n] = n, n, n
    wanted = np.append(vocabulary.rank(token[:n], token[after[:n]]), NONE)
    order = np.argsort(wanted[:n], kind="stable")
    order = order[: np.searchsorted(wanted[order], NONE)]
    ranks, cut = np.unique(wanted[order], return_index=True)
    given = dict(zip(ranks.tolist(), np.split(order, cut[1:]), strict=True)) if len(ranks) else {}
    index: dict[int, list[int]] = {}
    queue = ranks.tolist()

    def merge(at: np.ndarray, rank: int) -> int:
        """Merges the pairs that start at these positions, none overlapping; the neighbours enter the index. Returns the lowest rank among them."""
        gone = after[at]
        beyond = after[gone]
        token[at], token[gone], wanted[gone] = rank, -1, NONE
        after[at], before[beyond] = beyond, at
        ahead = before[at]
        touched = np.concatenate([at, ahead[ahead < n]])
        new = vocabulary.rank(token[touched], token[after[touched]])
        wanted[touched] = new
        live = new != NONE
        low = int(NONE)
        for r, p in zip(new[live].tolist(), touched[live].tolist(), strict=True):
            if r in index:
                index[r].append(p)
            else:
                index[r] = [p]
                heapq.heappush(queue, r)
            low = min(low, r)
        return low

    while queue:
        rank = heapq.heappop(queue)
        own, more = given.pop(rank, None), index.pop(rank, None)
        if more is not None:
            more = np.array(more, dtype=np.int64)
            at = np.unique(more if own is None else np.concatenate([own, more]))
        elif own is not None:
            at = own
        else:
            continue
        at = at[wanted[at] == rank]
        if not len(at):
            continue
        every = at
        if len(at) > 1 and (after[at[:-1]] == at[1:]).any():
            kept, taken = [], -1
            for p, q in zip(at.tolist(), after[at].tolist(), strict=True):
                if p != taken:
                    kept.append(p)
                    taken = q
            at = np.array(kept)
        if rank in vocabulary.early:
            # What each merge would meet, were they done from the left: merged pairs on its left, tokens on its right.
            same, ahead = np.full(len(at), rank, dtype=np.int32), before[at]
            left = np.where(np.append(False, after[after[at[:-1]]] == at[1:]), rank, token[ahead])
            lower = (vocabulary.rank(left, same) < rank) | (vocabulary.rank(same, token[after[after[at]]]) < rank)
            if lower.any():
                word = np.searchsorted(starts, at, side="right")
                slow, whose = np.isin(word, word[lower]), np.searchsorted(starts, every, side="right")
                for w in np.unique(word[slow]):
                    own = every[whose == w]
                    for k in range(len(own)):
                        if wanted[own[k]] == rank and merge(own[k : k + 1], rank) < rank:
                            if k + 1 < len(own):
                                index.setdefault(rank, []).extend(own[k + 1 :].tolist())
                                heapq.heappush(queue, rank)
                            break
                at = at[~slow]
                if not len(at):
                    continue
        merge(at, rank)
    alive = token[:n] >= 0
    return token[:n][alive], np.add.reduceat(alive, starts, dtype=np.int64) if len(starts) else np.zeros(0, dtype=np.int64)


def encoded_words(words: pa.Array, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """(ids one after the other, ids of each word) of distinct words."""
    whole = np.array([vocabulary.ranks.get(w, -1) for w in words.to_pylist()], dtype=np.int64)
    rest = np.flatnonzero(whole < 0)
    size = np.asarray(pa.compute.binary_length(words))[rest].astype(np.int64)
    counts = np.ones(len(words), dtype=np.int64)
    parts, share = [], np.cumsum(size) // SYMBOLS
    for lo, hi in zip(*bounds_of(share), strict=True):
        ids, own = replay(words.take(pa.array(rest[lo:hi])), vocabulary)
        counts[rest[lo:hi]] = own
        parts.append(ids)
    ends = np.cumsum(counts)
    flat = np.empty(ends[-1] if len(ends) else 0, dtype=np.int32)
    single = whole >= 0
    flat[(ends - counts)[single]] = whole[single]
    if parts:
        inside = np.ones(len(flat), dtype=bool)
        inside[(ends - counts)[single]] = False
        flat[inside] = np.concatenate(parts)
    return flat, counts


def bounds_of(groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and end of each run of equal values."""
    cut = np.flatnonzero(np.diff(groups)) + 1
    return np.append(0, cut)[: len(groups)], np.append(cut, len(groups))[: max(len(cut) + 1, 1) if len(groups) else 0]


def encoded_block(texts: pa.Array, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """(ids one after the other, ids of each text)."""
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    dictionaries, numbers, counts, seen = [], [], [], 0
    for lo, hi in zip(*bounds_of((offsets[1:] - offsets[0]) // SLICE), strict=True):
        if vocabulary.published:
            data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)
            words, own = split_published(data, offsets[lo : hi + 1], vocabulary.classes)
        else:
            words, own = split_other(texts.slice(lo, hi - lo).to_pylist(), vocabulary.pattern, vocabulary.classes)
        coded = words.dictionary_encode()
        dictionaries.append(coded.dictionary)
        numbers.append(np.asarray(coded.indices) + seen)
        counts.append(own)
        seen += len(coded.dictionary)
    if not seen:
        return np.zeros(0, dtype=np.int32), np.zeros(len(texts), dtype=np.int64)
    both = pa.concat_arrays(dictionaries).dictionary_encode()
    at = np.asarray(both.indices)[np.concatenate(numbers)]
    flat, size = encoded_words(both.dictionary, vocabulary)
    sizes, begin = size[at], np.cumsum(size) - size
    ends = np.cumsum(sizes)
    shift = (begin[at] - (ends - sizes)).astype(np.int32)
    ids = flat[np.repeat(shift, sizes) + np.arange(ends[-1], dtype=np.int32)]
    per_text = np.diff(np.append(0, ends)[np.append(0, np.cumsum(np.concatenate(counts)))])
    return ids, per_text


def encoder(model, name: str = "ids"):
    """For mapInArrow over (kept columns, text last)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = received(model)

        def finished(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(parts).combine_chunks()
            ids, size = encoded_block(table.column(table.num_columns - 1).combine_chunks().cast(pa.string()), vocabulary)
            ends = np.append(0, np.cumsum(size))
            for lo, hi in zip(*bounds_of(ends[1:] // IDS), strict=True):
                own = pa.ListArray.from_arrays(pa.array((ends[lo : hi + 1] - ends[lo]).astype(np.int32)), pa.array(ids[ends[lo] : ends[hi]]))
                kept = table.slice(lo, hi - lo).combine_chunks()
                yield pa.RecordBatch.from_arrays([*(c.combine_chunks() if c.num_chunks != 1 else c.chunk(0) for c in kept.columns[:-1]), own], names=[*kept.column_names[:-1], name])

        held, bytes_held = [], 0
        for batch in batches:
            size = np.asarray(pa.compute.binary_length(batch.column(batch.num_columns - 1))).astype(np.int64)
            for lo, hi in zip(*bounds_of((bytes_held + np.cumsum(size)) // BLOCK_BYTES), strict=True):
                held.append(batch.slice(lo, hi - lo))
                bytes_held += int(size[lo:hi].sum())
                if hi < batch.num_rows or bytes_held >= BLOCK_BYTES:
                    yield from finished(held)
                    held, bytes_held = [], 0
        if held:
            yield from finished(held)

    return run


def encode(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The kept columns and ``ids`` (array<int>) of every row."""
    name = fresh(list(keep), "ids")
    kept = [F.col(f"`{c}`") for c in keep]
    rows = docs.select(*kept, F.coalesce(F.col(f"`{text}`"), F.lit("")).alias(fresh(list(keep), "text")))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*kept).schema), f"`{name}` array<int>"])
    return rows.mapInArrow(encoder(shipped(docs.sparkSession, vocabulary), name), schema)


def decoder(model, at: int, name: str = "decoded"):
    """For mapInArrow: the ids in column ``at`` become bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = received(model)
        for batch in batches:
            said = pa.array([vocabulary.decode(ids or ()) for ids in batch.column(at).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], said, *batch.columns[at + 1 :]], names=[*batch.schema.names[:at], name, *batch.schema.names[at + 1 :]])

    return run


def decode(rows: DataFrame, vocabulary: Vocabulary, ids: str = "ids") -> DataFrame:
    """The rows with ``decoded`` (bytes) instead of their ids."""
    at = rows.columns.index(ids)
    name = fresh([c for c in rows.columns if c != ids], "decoded")
    schema = ", ".join(f"`{name}` binary" if f.name == ids else f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(decoder(shipped(rows.sparkSession, vocabulary), at, name), schema)


def digests(model):
    """For mapInArrow over (doc_id, ids): counts and digests of the ids and of the bytes that they decode to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = received(model)
        for batch in batches:
            column = batch.column(1)
            ends, flat = np.asarray(column.offsets), np.asarray(column.values).astype("<u4")
            counts, own, said = [], [], []
            for lo, hi in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
                ids = flat[lo:hi]
                counts.append(hi - lo)
                own.append(hashlib.sha256(ids.tobytes()).hexdigest())
                said.append(hashlib.sha256(vocabulary.decode(ids.tolist())).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(own, pa.string()), pa.array(said, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return run


def report(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every document."""
    rows = encode(docs.withColumn("doc_id", F.col("doc_id").cast("long")), vocabulary)
    return rows.mapInArrow(digests(shipped(docs.sparkSession, vocabulary)), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
