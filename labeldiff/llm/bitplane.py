"""Token ids in a binary format: blocks of a fixed number of ids, transposed into planes, each compressed by zstandard.

Documents are dealt by range of doc_id and sorted, each task encodes its range, appends an end id to each document and
cuts the stream of ids into blocks of ``block`` ids (the last block of a range is shorter). A block's 32-bit ids are
transposed into 4 byte planes or 32 bit planes; planes of high-order bits hold long runs and nearly vanish. One row of
the table is one block: its place (segment, block), its planes, their sizes, and which documents it holds from where to
where. The rows without planes are the chunk index (``chunk_index``). The planes are written by Spark's own Parquet
writer, uncompressed, so a lost executor leaves no partial file, and any store that Spark can reach will do.

Encoding is exact. In a vocabulary that splits text as ``NORMALIZER`` and ``SPLITTER`` say (its file is compared with
them) no token crosses ASCII white space, so the library encodes each distinct chunk between white space once and a task
looks the rest up in a bounded table, which its worker keeps for the next task. With any other vocabulary the library encodes whole texts.

Defined results: a null or empty text gives the end id alone; rows that share a doc_id follow each other in order of a
text hash, each a document of its own; null doc_ids come first; an empty table gives no blocks; other columns are
ignored; a text may be longer than a block, its pieces' checksums are then combined.
"""

from __future__ import annotations

import json
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from labeldiff.scratch import held, place

#: Ids in a block, zstandard level, distinct chunks that a worker remembers at most (before the next slice), bytes of text encoded at once.
BLOCK, LEVEL, MEMORY, SLICE = 65_536, 1, 600_000, 8_000_000
#: Punctuation that is cut off a word.
STOPS, CUT = ".,;:!?", r"[A-Za-z0-9][.,;:!?]+$"

#: How a vocabulary normalizes and splits text whose chunks may be encoded one by one.
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
SPLITTER = {"type": "Sequence", "pretokenizers": [{"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True}, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}

BLOCKS = "segment int, block int, n_ids int, width int, planes binary, sizes array<int>, docs array<struct<doc_id:long,at:long,off:long,pos:int,len:int>>"


def to_planes(ids: np.ndarray, width: int, level: int) -> tuple[bytes, list[int]]:
    """The block's planes, compressed, least significant first. width: bits of a plane's item, 1 or 8."""
    import zstandard

    raw = np.ascontiguousarray(ids, dtype="<u4").view(np.uint8).reshape(-1, 4)
    planes = raw.T if width == 8 else np.packbits(np.unpackbits(raw, axis=1, bitorder="little").T, axis=1, bitorder="little")
    press = zstandard.ZstdCompressor(level=level).compress
    packed = [press(np.ascontiguousarray(p).tobytes()) for p in planes]
    return b"".join(packed), [len(p) for p in packed]


def from_planes(planes: bytes, sizes: list[int], n: int, width: int) -> np.ndarray:
    import zstandard

    unpack, at, rows = zstandard.ZstdDecompressor().decompress, 0, []
    for size in sizes:
        rows.append(np.frombuffer(unpack(planes[at : at + size]), np.uint8))
        at += size
    stack = np.stack(rows)
    raw = stack.T if width == 8 else np.packbits(np.unpackbits(stack, axis=1, count=n, bitorder="little").T, axis=1, bitorder="little")
    return np.ascontiguousarray(raw).reshape(-1).view("<u4")


class Encoder:
    """Ids of texts. Knows the ids of chunks it has met: index (chunk -> entry), and of each entry its place in a pool of ids."""

    def __init__(self, vocabulary: str, literal_specials: bool):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.tokenizer.encode_special_tokens = literal_specials
        with open(vocabulary, encoding="utf-8") as f:
            file = json.load(f)
        added = [t for t in file.get("added_tokens") or [] if not t["content"].startswith("<|") or any(c.isspace() for c in t["content"])]
        self.by_chunks = (file.get("normalizer"), file.get("pre_tokenizer"), added) == (NORMALIZER, SPLITTER, [])
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {"": 0}
        self.pool, self.used = np.zeros(1 << 16, "<u4"), 0
        self.start, self.size = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)

    def add(self, words: list[str], ids: np.ndarray, size: np.ndarray) -> None:
        """New chunks, the ids of all of them one after the other, and how many each has."""
        k, n = len(self.index), len(words)
        while self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        while k + n > len(self.start):
            self.start, self.size = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.size))
        self.pool[self.used : self.used + len(ids)] = ids
        self.start[k : k + n], self.size[k : k + n] = self.used + np.cumsum(size) - size, size
        self.index.update(zip(words, range(k, k + n), strict=True))
        self.used += len(ids)

    def learn(self, new: list[str]) -> None:
        """The library's ids of each chunk. Words of letters alone are one pre-token each, so many are encoded in one call."""
        words = [w for w in new if w.isalpha()]
        for at in range(0, len(words), 20_000):
            part = words[at : at + 20_000]
            e = self.tokenizer.encode("\n".join(part), add_special_tokens=False)
            ids, owner = np.array(e.ids, "<u4"), np.array(e.word_ids, dtype=float)
            size = np.bincount(owner.astype(int), minlength=len(part)) if len(owner) and not np.isnan(owner).any() else np.zeros(0, int)
            if len(size) == len(part) and (size > 0).all() and (np.diff(owner) >= 0).all():
                self.add(part, ids, size)
            else:
                self.learn_singly(part)
        self.learn_singly([w for w in new if not w.isalpha()])

    def learn_singly(self, new: list[str]) -> None:
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(new, add_special_tokens=False)]
        self.add(new, np.array([x for i in ids for x in i], "<u4"), np.array([len(i) for i in ids], int))

    def entries(self, chunks: pa.Array) -> np.ndarray:
        """The entry of each chunk; distinct chunks are looked up once."""
        coded = chunks.dictionary_encode()
        words = coded.dictionary.to_pylist()
        got = list(map(self.index.get, words))
        if None in got:
            self.learn([w for w, k in zip(words, got, strict=True) if k is None])
            got = list(map(self.index.get, words))
        return np.array(got, dtype=np.int64)[coded.indices.to_numpy()]

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and how many each has."""
        import pyarrow.compute as pc

        if not self.by_chunks:
            each = [e.ids for e in self.tokenizer.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)]
            return np.array([x for ids in each for x in ids], "<u4"), np.array([len(ids) for ids in each], int)
        if len(self.index) > MEMORY:
            self.forget()
        # The vocabulary's normalizer lowers letters; special tokens are matched before that, so texts that may hold one stay as they are.
        if not pc.any(pc.match_substring(texts, "<|")).as_py():
            texts = pc.ascii_lower(texts)
        lists = pc.ascii_split_whitespace(texts)
        coded = lists.flatten().dictionary_encode()
        # Punctuation after an ASCII letter or digit is a pre-token of its own.
        chunks = coded.dictionary
        cut = pc.match_substring_regex(chunks, CUT)
        heads = pc.if_else(cut, pc.ascii_rtrim(chunks, STOPS), chunks)
        tails = pc.if_else(cut, pc.replace_substring_regex(chunks, "^.*[A-Za-z0-9]", ""), "")
        pairs = np.stack([self.entries(heads), self.entries(tails)], axis=1)
        at = pairs[coded.indices.to_numpy()].reshape(-1)
        size = self.size[at]
        ends = np.cumsum(size)
        ids = self.pool[np.repeat(self.start[at] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)]
        words = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
        marks = np.concatenate([[0], ends])[2 * words]
        return ids, np.diff(marks)


@lru_cache(maxsize=1)
def encoder_of(vocabulary: str, literal_specials: bool) -> Encoder:
    """A worker's encoder: what it has learnt serves the tasks that follow, which would load the vocabulary and learn the same chunks anew."""
    return Encoder(vocabulary, literal_specials)


def slices(batch: pa.RecordBatch):
    """Parts of a batch of about SLICE bytes of text; a longer text is a part of its own."""
    ends = np.cumsum([0] + [x or 0 for x in pa.compute.binary_length(batch["text"]).to_pylist()])
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + SLICE, side="right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def encode(vocabulary: str, end_id: int, block: int, width: int, level: int, literal_specials: bool):
    def run(batches):
        from pyspark import TaskContext

        segment, encoder, end = TaskContext.get().partitionId(), None, np.array([end_id], dtype="<u4").tobytes()
        pending, size, docs, number, at = [], 0, [], 0, 0  # ids of the open block as bytes, their count, its documents; start of the next document

        def closed():
            ids = np.frombuffer(b"".join(pending), dtype="<u4")
            planes, sizes = to_planes(ids, width, level)
            return pa.RecordBatch.from_pylist([{"segment": segment, "block": number, "n_ids": size, "width": width, "planes": planes, "sizes": sizes, "docs": docs}], schema=SCHEMA)

        SCHEMA = pa.schema([("segment", pa.int32()), ("block", pa.int32()), ("n_ids", pa.int32()), ("width", pa.int32()), ("planes", pa.binary()), ("sizes", pa.list_(pa.int32())), ("docs", pa.list_(pa.struct([("doc_id", pa.int64()), ("at", pa.int64()), ("off", pa.int64()), ("pos", pa.int32()), ("len", pa.int32())])))])
        for batch in batches:
            encoder = encoder or encoder_of(vocabulary, literal_specials)
            for part in slices(batch):
                ids, counts = encoder(part["text"])
                raw, done = ids.tobytes(), 0
                for doc_id, count in zip(part["doc_id"].to_pylist(), counts.tolist(), strict=True):
                    own = memoryview(raw)[4 * done : 4 * (done + count)]
                    done, total, off = done + count, count + 1, 0
                    while off < total:
                        n = min(block - size, total - off)
                        pending.append(own[4 * off : 4 * (off + n)])
                        if off + n == total:
                            pending.append(end)
                        docs.append({"doc_id": doc_id, "at": at, "off": off, "pos": size, "len": n})
                        size, off = size + n, off + n
                        if size == block:
                            yield closed()
                            pending, size, docs, number = [], 0, [], number + 1
                    at += total
        if size:
            yield closed()

    return run


def write_ids(docs: DataFrame, vocabulary: str, end_id: int = 1, block: int = BLOCK, width: int = 8, level: int = LEVEL, literal_specials: bool = False) -> DataFrame:
    """Writes the ids of every text in ascending order of doc_id; returns the table of blocks as read from the files."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    dealt = rows.repartitionByRange(F.col("doc_id"), F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    spark = docs.sparkSession
    blocks = dealt.mapInArrow(encode(vocabulary, end_id, block, width, level, literal_specials), BLOCKS)
    return stored_blocks(spark, blocks)


def stored_blocks(spark, blocks: DataFrame) -> DataFrame:
    """The planes are compressed already, so Parquet's own compression is off."""
    path = place(spark, "ids")
    blocks.write.option("compression", "uncompressed").parquet(path)
    return spark.read.schema(blocks.schema).parquet(path)


def chunk_index(blocks: DataFrame) -> DataFrame:
    """The chunk index as a table of its own: one row per block: where its ids start among all ids, how many there are, its planes' sizes, its documents."""
    starts = segment_starts(blocks)
    ahead = Window.partitionBy("segment").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    index = blocks.select("segment", "block", "n_ids", "width", "sizes", F.transform("docs", lambda d: d["doc_id"]).alias("doc_ids"))
    index = index.withColumn("_n", F.coalesce(F.sum("n_ids").over(ahead), F.lit(0))).join(F.broadcast(starts), "segment")
    return held(index.select("segment", "block", (F.col("_start") + F.col("_n")).alias("start"), "n_ids", "width", "sizes", "doc_ids"), "chunk-index")


def segment_starts(blocks: DataFrame) -> DataFrame:
    """(segment, _start): a row per task that wrote, so its size is bounded by the number of tasks."""
    sizes = blocks.groupBy("segment").agg(F.sum("n_ids").alias("_n"))
    ahead = Window.orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select("segment", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_start"))


def read_pieces(batches):
    """For mapInArrow: of each block, its documents' ids (here: their checksum)."""
    for batch in batches:
        for r in batch.to_pylist():
            ids = memoryview(from_planes(r["planes"], r["sizes"], r["n_ids"], r["width"]).tobytes())
            d = r["docs"]
            crc = [zlib.crc32(ids[4 * x["pos"] : 4 * (x["pos"] + x["len"])]) for x in d]
            yield pa.RecordBatch.from_arrays([pa.array([r["segment"]] * len(d), pa.int32()), pa.array([x["at"] for x in d], pa.int64()), pa.array([x["doc_id"] for x in d], pa.int64()), pa.array([x["off"] for x in d], pa.int64()), pa.array([x["len"] for x in d], pa.int64()), pa.array(crc, pa.int64())], names=["segment", "at", "doc_id", "off", "len", "crc"])


def crc_joined(first: int, second: int, n: int) -> int:
    """CRC-32 of a + b from those of a and b, b being n bytes long: a's register is advanced by n zero bytes."""
    if not n:
        return first

    def times(m, v):
        out, i = 0, 0
        while v:
            if v & 1:
                out ^= m[i]
            v, i = v >> 1, i + 1
        return out

    step = [0xEDB88320] + [1 << i for i in range(31)]  # one zero bit
    for _ in range(3):
        step = [times(step, x) for x in step]  # one zero byte
    while n:
        if n & 1:
            first = times(step, first)
        n >>= 1
        if n:
            step = [times(step, x) for x in step]
    return first ^ second


def joined_crc(pieces) -> object:
    """For a pandas UDF: each row's sorted pieces (off, len, crc) to one checksum."""
    import pandas as pd

    out = []
    for row in pieces:
        crc = int(row[0]["crc"])
        for p in row[1:]:
            crc = crc_joined(crc, int(p["crc"]), 4 * int(p["len"]))
        out.append(crc)
    return pd.Series(out, dtype="int64")


def read_documents(blocks: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files."""
    pieces = blocks.mapInArrow(read_pieces, "segment int, at long, doc_id long, off long, len long, crc long")
    docs = pieces.groupBy("segment", "at", "doc_id").agg(F.sum("len").alias("n_tokens"), F.sort_array(F.collect_list(F.struct("off", "len", "crc"))).alias("p"))
    crc = F.when(F.size("p") == 1, F.col("p")[0]["crc"]).otherwise(F.pandas_udf(joined_crc, "long", F.PandasUDFType.SCALAR)("p"))
    docs = docs.withColumn("ids_crc32", crc).join(F.broadcast(segment_starts(blocks)), "segment")
    return docs.select("doc_id", (F.col("_start") + F.col("at")).cast("long").alias("start"), "n_tokens", "ids_crc32")


def decode_ids(blocks: DataFrame) -> DataFrame:
    """(doc_id, start, off, ids): the ids themselves, a row per document and block that it reaches into."""

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                ids = from_planes(r["planes"], r["sizes"], r["n_ids"], r["width"]).astype("int64")
                d = r["docs"]
                yield pa.RecordBatch.from_arrays([pa.array([r["segment"]] * len(d), pa.int32()), pa.array([x["at"] for x in d], pa.int64()), pa.array([x["doc_id"] for x in d], pa.int64()), pa.array([x["off"] for x in d], pa.int64()), pa.array([ids[x["pos"] : x["pos"] + x["len"]] for x in d], pa.list_(pa.int64()))], names=["segment", "at", "doc_id", "off", "ids"])

    pieces = blocks.mapInArrow(run, "segment int, at long, doc_id long, off long, ids array<long>")
    return pieces.join(F.broadcast(segment_starts(blocks)), "segment").select("doc_id", (F.col("_start") + F.col("at")).alias("start"), "off", "ids")


__all__ = ["chunk_index", "decode_ids", "read_documents", "write_ids"]
