"""Near-duplicate documents at a Jaccard similarity of 0.8 or more on shingle sets: candidates from SimHash blocks and MinHash bands, every link verified on whole sets.

1. The SimHash blocks of ``simhash`` (64 bits, over the distinct shingles; pairs of 16-bit blocks, then Hamming distance)
   give the pairs within two bits: nearly equal texts, in rows proportional to the documents however large a group is.
2. A pair at similarity 0.8 differs in about ten of 64 bits, which no split of 64 bits finds at an affordable cost. So the
   ``BANDS`` * ``DEEP`` least values of a set under as many hash functions are cut into bands; documents that agree in a
   band are candidates. A pair of similarity s agrees in none with probability (1 - s^DEEP)^BANDS, whatever the length of
   the texts: 3e-6 at 0.8, 4e-13 at 0.9.

Candidates whose sizes rule 0.8 out, or whose sketches (four bits of each least value) differ in more than ``FAR`` of 160
values, are dropped: at 0.8 sketches differ in 30 values, give or take 5, so this costs 3e-5 of pairs at 0.8. The rest
are verified, so each link has a similarity of 0.8 or more.

A band that many documents share would give all their pairs. So its members first meet its hub, the member that meets
the most others in all its bands: the nearest hub of each document is verified, then those hubs that are still in other
groups. Pairs left apart in a band are then compared exhaustively: one by one in a band of at most ``FEW`` members, else
in two parts. Shingles that at most ``RARE`` of the documents left have are rare: pairs that share a rare one are listed by it, so a shingle gives a bounded number of pairs.
Pairs that share none can share no more than their other shingles. That bound rules out most documents of a large group
of loose copies for good (their own edits are rare shingles) and nearly all pairs of the others; members of a band are
dealt into chunks of bounded size, a task compares two chunks, and only pairs that sizes, rare shingles and sketches do
not rule out become rows. Members of the band's largest group are never compared with each other. Nothing is left out.
Documents with the same shingle set are one node. Groups are connected components.

Defined results: texts without words (null, empty) are copies of each other; fewer words than a shingle make one shingle;
rows that share an id keep their own fingerprints; a group is named by its smallest id; an empty table gives no rows;
extra columns are kept, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from labeldiff.llm.common import ALNUM, fresh, stored, text_bytes
from labeldiff.llm.simhash import bit_sums, close_pairs, components, sized
from labeldiff.scratch import mark, release

#: Bands, least values in a band, and values of 160 in which the sketches of candidates may differ; members of a chunk.
BANDS, DEEP, FAR, CHUNK = 32, 5, 50, 512
#: Rows of two longs that are broadcast, at most; more are joined by a shuffle.
SENT = 1_000_000
#: Documents that have a rare shingle, at most; members of a band whose pairs are compared one by one, at most.
RARE, FEW = 8, 16
#: The hash functions of the least values: odd multipliers and summands.
TIMES, PLUS = np.random.Generator(np.random.PCG64(7)).integers(0, 2**64, (2, BANDS * DEEP, 1), np.uint64) | np.array([1, 0], np.uint64).reshape(2, 1, 1)
#: Bit planes of a sketch, and longs in one (160 bits and padding).
PLANES, LONGS = 4, 3


def shingle_digests(text: bytes, shingle: int) -> list[bytes]:
    """XXH64 of the distinct shingles of lower-cased words of letters and digits."""
    from xxhash import xxh64_digest

    words = text.translate(ALNUM).split()
    if not words:
        return []
    parts = set(map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))) if len(words) >= shingle else {b" ".join(words)}
    return [xxh64_digest(p, 42) for p in parts]


def shingle_hashes(text: bytes, shingle: int) -> np.ndarray:
    return np.sort(np.frombuffer(b"".join(shingle_digests(text, shingle)), ">u8").astype(np.uint64))


def marks(text: bytes, shingle: int) -> tuple[int, int, int, list[int], list[int]]:
    """Of the shingle set: a hash, its size, its SimHash, its bands and its sketch (bit planes of the least values)."""
    from xxhash import xxh64_digest, xxh64_intdigest

    raw = shingle_digests(text, shingle)
    if not raw:
        return 0, 0, 0, [], []
    total = sum(bit_sums(raw[k : k + 65_536]) for k in range(0, len(raw), 65_536))
    fp = np.packbits(2 * total > len(raw)).view(">i8")[0]
    h = np.sort(np.frombuffer(b"".join(raw), ">u8").astype(np.uint64))
    least = np.min([(h[k : k + 2048] * TIMES + PLUS).min(1) for k in range(0, len(h), 2048)], axis=0)
    bands = np.frombuffer(b"".join([xxh64_digest(least[j * DEEP : (j + 1) * DEEP].tobytes(), j) for j in range(BANDS)]), ">i8")
    planes = [np.packbits((least >> np.uint64(p)).astype(np.uint8) & 1) for p in range(PLANES)]
    sketch = np.frombuffer(b"".join([p.tobytes().ljust(8 * LONGS, b"\0") for p in planes]), ">i8")
    return int(np.array(xxh64_intdigest(h.tobytes()), np.uint64).view(np.int64)), len(h), int(fp), bands.tolist(), sketch.tolist()


def add_marks(shingle: int, n_keep: int, names: list[str]):
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()))

    def run(batches):
        for batch in batches:
            got = [marks(t.as_buffer().to_pybytes(), shingle) for t in batch.column(n_keep)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:n_keep], *(pa.array([g[k] for g in got], t) for k, t in enumerate(kinds))], names=names)

    return run


def add_sets(shingle: int):
    """For mapInArrow over (node, text): the node and its shingle set."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                got = [shingle_hashes(t.as_buffer().to_pybytes(), shingle).view(np.int64) for t in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(got, pa.list_(pa.int64()))], names=["node", "h"])

    return run


def unlike(a: str, b: str):
    """Values in which two sketches differ."""
    words = lambda w: [F.element_at(a, p * LONGS + w + 1).bitwiseXOR(F.element_at(b, p * LONGS + w + 1)) for p in range(PLANES)]
    return sum((F.bit_count(x.bitwiseOR(y).bitwiseOR(z).bitwiseOR(u)) for x, y, z, u in map(words, range(LONGS))), F.lit(0))


def simhash_pairs(kinds: DataFrame, rows: int) -> DataFrame:
    """Pairs (a, b) of nodes whose fingerprints are within two bits: a star in each fingerprint, and a pair for each link between fingerprints."""
    lead = stored(sized(kinds.where("n > 0").groupBy("fp").agg(F.min("node").alias("lead")), rows), "leads")
    same = kinds.where("n > 0").join(lead, "fp").where("node <> lead").select(F.col("lead").alias("a"), F.col("node").alias("b"))
    near = close_pairs(lead.select("fp"))
    ends = near.join(lead.select(F.col("fp").alias("a"), F.col("lead").alias("x")), "a").join(lead.select(F.col("fp").alias("b"), F.col("lead").alias("y")), "b")
    return same.union(ends.select(F.least("x", "y"), F.greatest("x", "y")))


def hub_pairs(met: DataFrame, rows: int) -> DataFrame:
    """met: (key, node, met). Pairs (a, b) of each node with the hubs of its bands."""
    weight = sized(met.groupBy("node").agg(F.sum("met").alias("weight")), rows)
    hubs = met.join(weight, "node").groupBy("key").agg(F.max(F.struct("weight", "node"))["node"].alias("hub"))
    pairs = met.join(hubs, "key").where("node <> hub").select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b"))
    return sized(pairs.distinct(), rows)


def nearest(pairs: DataFrame, rows: int) -> DataFrame:
    """Of the pairs (a, b, far) the best of each node."""
    ends = pairs.select(F.col("a").alias("node"), F.col("b").alias("other"), "far").union(pairs.select(F.col("b").alias("node"), F.col("a").alias("other"), "far"))
    best = ends.groupBy("node").agg(F.min(F.struct("far", "other"))["other"].alias("other"))
    return stored(sized(best.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct(), rows), "nearest")


def apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """Of the pairs (a, b) those whose ends are in different groups."""
    side = lambda x: roots.select(F.col("node").alias(x), F.col("root").alias(f"_{x}"))
    return pairs.join(side("a"), "a", "left").join(side("b"), "b", "left").where(F.coalesce("_a", "a") != F.coalesce("_b", "b")).select(*pairs.columns)


def open_bands(met: DataFrame, roots: DataFrame, rows: int) -> DataFrame:
    """(key, node, root, main, n_main, n_all) of the bands whose members are in several groups; main: whether the node is in the band's largest one."""
    named = met.join(roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
    groups = sized(named.groupBy("key", "root").agg(F.count(F.lit(1)).alias("k")), rows)
    bands = groups.groupBy("key").agg(F.max_by("root", F.struct("k", "root")).alias("_main"), F.max("k").alias("n_main"), F.sum("k").alias("n_all")).where("n_all > n_main")
    return stored(named.join(sized(bands, rows), "key").withColumn("main", F.col("root") == F.col("_main")).drop("_main"), "open")


def few_pairs(left: DataFrame) -> DataFrame:
    """Pairs (a, b) of different groups in open bands of at most FEW members."""
    members = left.where(F.col("n_all") <= FEW).groupBy("key").agg(F.collect_list(F.struct("node", "root")).alias("m"))
    pairs = members.select(F.explode("m").alias("x"), "m").select("x", F.explode("m").alias("y")).where("x.node < y.node AND x.root <> y.root")
    return pairs.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()


def rare_shingles(nodes: DataFrame, texts: DataFrame, shingle: int) -> DataFrame:
    """(h, m): the shingles that at most RARE of the nodes have, with those nodes. Of other shingles no task sends more than RARE + 1 rows."""
    sets = texts.join(nodes, "node").select("node", "text").mapInArrow(add_sets(shingle), "node long, h array<long>")
    first = sets.select("node", F.explode("h").alias("h")).withColumn("_o", F.row_number().over(Window.partitionBy("h").orderBy("node"))).where(F.col("_o") <= RARE + 1)
    return stored(first.groupBy("h").agg(F.collect_list("node").alias("m")).where(F.size("m") <= RARE), "rare")


def rare_pairs(rare: DataFrame) -> DataFrame:
    """Pairs (a, b) of nodes that share a rare shingle: at most RARE - 1 for each that a node has."""
    return rare.where(F.size("m") > 1).select(F.explode("m").alias("a"), "m").select("a", F.explode("m").alias("b")).where("a < b").distinct()


def able_nodes(nodes: DataFrame, rare: DataFrame, kinds: DataFrame) -> DataFrame:
    """(node, n, sketch, own) of the nodes that can have a link to one with which they share no rare shingle; own: how many rare shingles they have."""
    own = rare.select(F.explode("m").alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("own"))
    rows = nodes.join(kinds.select("node", "n", "sketch"), "node").join(own, "node", "left").select("node", "n", "sketch", F.coalesce("own", F.lit(0)).alias("own"))
    return stored(rows.where("5 * (n - own) >= 4 * n"), "able")


def chunk_pairs(left: DataFrame, able: DataFrame) -> DataFrame:
    """Pairs (a, b) that share an open band, are in different groups, and are not ruled out by sizes, rare shingles or sketches: every such pair, by chunks."""
    size = F.when(F.col("main"), F.col("n_main")).otherwise(F.col("n_all") - F.col("n_main"))
    dealt = left.withColumn("chunk", F.pmod(F.xxhash64("node"), F.ceil(size / CHUNK)).cast("int")).join(able, "node")
    chunks = stored(dealt.groupBy("key", "main", "chunk").agg(F.collect_list(F.struct("node", "root", "n", "own", "sketch")).alias("m")), "chunks")
    other = chunks.select(F.col("key").alias("k2"), F.col("main").alias("main2"), F.col("chunk").alias("chunk2"), F.col("m").alias("m2"))
    # Others with the main group's chunks, and with each other once.
    both = chunks.where("NOT main").join(other, (F.col("key") == F.col("k2")) & (F.col("main2") | (F.col("chunk") <= F.col("chunk2"))))
    return stored(both.select("m", "m2").mapInArrow(compare_chunks, "a long, b long").distinct(), "apart")


def compare_chunks(batches):
    """For mapInArrow over two lists of members: the pairs of different groups that sizes, rare shingles and sketches leave over. Sets that share no rare shingle share at most their other ones."""
    words = PLANES * LONGS

    def members(column, k):
        m = column[k].values
        return [m.field(c).to_numpy() for c in ("node", "root", "n", "own")] + [m.field("sketch").flatten().to_numpy().reshape(-1, words).view(np.uint64)]

    for batch in batches:
        for k in range(batch.num_rows):
            (a, ra, na, ua, sa), (b, rb, nb, ub, sb) = members(batch["m"], k), members(batch["m2"], k)
            i, j = np.nonzero((ra[:, None] != rb[None, :]) & (9 * np.minimum((na - ua)[:, None], (nb - ub)[None, :]) >= 4 * (na[:, None] + nb[None, :])))
            far = np.zeros(len(i), np.int64)
            for w in range(LONGS):
                far += np.bitwise_count(np.bitwise_or.reduce([sa[i, p * LONGS + w] ^ sb[j, p * LONGS + w] for p in range(PLANES)]))
            i, j = i[far <= FAR], j[far <= FAR]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a[i], b[j])), pa.array(np.maximum(a[i], b[j]))], names=["a", "b"])


def candidates(pairs: DataFrame, kinds: DataFrame) -> DataFrame:
    """Of the pairs (a, b) of nodes those that sizes and sketches do not rule out, with ``far``, the values in which the sketches differ."""
    left, right = kinds.select(F.col("node").alias("a"), F.col("n").alias("m"), F.col("sketch").alias("x")), kinds.select(F.col("node").alias("b"), "n", F.col("sketch").alias("y"))
    near = pairs.join(left, "a").join(right, "b").where("5 * least(m, n) >= 4 * greatest(m, n)").withColumn("far", unlike("x", "y"))
    return stored(near.where(F.col("far") <= FAR).select("a", "b", "far"), "candidates")


def ends_of(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()


def verified(pairs: DataFrame, texts: DataFrame, shingle: int, rows: int) -> DataFrame:
    """Of the pairs (a, b) those whose shingle sets have a similarity of 0.8 or more. texts: (node, text) of all nodes that meet another."""
    since = mark()
    sets = stored(texts.join(sized(ends_of(pairs), rows), "node").mapInArrow(add_sets(shingle), "node long, h array<long>"), "sets")
    left, right = sets.select(F.col("node").alias("a"), F.col("h").alias("x")), sets.select(F.col("node").alias("b"), F.col("h").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    links = stored(pairs.join(left, "a").join(right, "b").where(9 * both >= 4 * (F.size("x") + F.size("y"))).select("a", "b"), "links")
    release(since, keep=1)
    return links


def similar_groups(docs: DataFrame, shingle: int = 5, id_col: str = "doc_id", text_col: str = "text", name: str = "component_id") -> DataFrame:
    """docs with ``name``: the smallest id of the group that each belongs to."""
    return grouped(docs, shingle, id_col, text_col, name).drop(fresh([*docs.columns, name], "_root"))


def grouped(docs: DataFrame, shingle: int, id_col: str, text_col: str, name: str) -> DataFrame:
    """docs with ``name`` and ``_root``, which tells groups apart even where rows of different groups share an id."""
    taken = [*docs.columns, name]
    row, node, size, fp, bands, sketch, root, sent_text = (fresh(taken, x) for x in ("_row", "_node", "_size", "_fp", "_bands", "_sketch", "_root", "_sent"))
    kept = [F.col(f"`{c}`") for c in docs.columns]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    sent = docs.select(*kept, F.monotonically_increasing_id().alias(row), text_bytes(f"`{text_col}`").alias(sent_text))
    names = [*docs.columns, row, node, size, fp, bands, sketch]
    schema = ", ".join([*([kinds] if kinds else []), f"{row} long, {node} long, {size} long, {fp} long, {bands} array<long>, {sketch} array<long>"])
    marked = stored(sent.mapInArrow(add_marks(shingle, len(docs.columns) + 1, names), schema), "similar")
    kinds = marked.select(F.col(node).alias("node"), F.col(row).alias("row"), F.col(size).alias("n"), F.col(fp).alias("fp"), F.col(bands).alias("bands"), F.col(sketch).alias("sketch"), F.col(f"`{id_col}`").alias("id"))
    kinds = stored(kinds.groupBy("node").agg(F.min("id").alias("least"), F.min("row").alias("row"), *[F.any_value(c).alias(c) for c in ("n", "fp", "bands", "sketch")]), "nodes")
    n = kinds.count()
    rows = BANDS * n
    spread = kinds.select("node", F.explode("bands").alias("key"))
    shared = spread.groupBy("key").agg(F.count(F.lit(1)).alias("met")).where("met > 1")
    met = stored(sized(spread.join(shared, "key"), rows), "bands")
    close = stored(sized(simhash_pairs(kinds, n), n), "close")
    # Texts are dealt once, and only those of nodes that meet another are kept for what follows.
    meeting = stored(kinds.select("node", "row").join(sized(ends_of(close).union(met.select("node")).distinct(), n), "node", "left_semi"), "meeting")
    meeting = F.broadcast(meeting) if meeting.count() <= SENT else meeting
    texts = stored(marked.select(F.col(row).alias("row"), text_bytes(f"`{text_col}`").alias("text")).join(meeting, "row").select("node", "text"), "texts")
    links = verified(candidates(close, kinds).drop("far"), texts, shingle, n)
    hubs = candidates(apart(hub_pairs(met, rows), components(links)), kinds)
    links = links.union(verified(nearest(hubs, n), texts, shingle, n))
    links = links.union(verified(apart(hubs.drop("far"), components(links)), texts, shingle, n))
    left = open_bands(met, components(links), rows)
    many = left.where(F.col("n_all") > FEW)
    nodes = stored(sized(many.select("node").distinct(), n), "open-nodes")
    rare = rare_shingles(nodes, texts, shingle)
    listed = apart(sized(few_pairs(left).union(rare_pairs(rare)).distinct(), rows), components(links))
    rest = candidates(listed, kinds).drop("far").union(chunk_pairs(many, able_nodes(nodes, rare, kinds))).distinct()
    links = links.union(verified(stored(rest, "rest"), texts, shingle, n))
    roots = components(links)
    # Only nodes with a link meet by root; all others are groups of their own.
    linked = roots.join(kinds.select("node", "least"), "node")
    called = linked.join(linked.groupBy("root").agg(F.min("least").alias("first")), "root").select("node", "root", "first")
    names = kinds.select("node", "least").join(called, "node", "left").select(F.col("node").alias(f"{node}n"), F.coalesce("first", "least").alias(name), F.coalesce("root", "node").alias(root))
    return marked.join(names, F.col(node) == F.col(f"{node}n")).select(*kept, name, root)


def keep_one(docs: DataFrame, shingle: int = 5, id_col: str = "doc_id") -> DataFrame:
    """docs with one row of each group: the one with the smallest id (of rows that share it, one); columns unchanged."""
    name = fresh(docs.columns, "component_id")
    groups = grouped(docs, shingle, id_col, "text", name)
    first = groups.where(F.col(f"`{id_col}`").eqNullSafe(F.col(name)))
    return first.dropDuplicates([fresh([*docs.columns, name], "_root")]).select(*[F.col(f"`{c}`") for c in docs.columns])
