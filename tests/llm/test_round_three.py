"""Clustering, the manifest and merge replay against plain versions, with nulls, empty and long texts, ties, repeats, empty tables and clashing names."""

from __future__ import annotations

import hashlib
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from labeldiff.llm import annulus, byte_bpe, merkle

# 11 clustering


def plain_clusters(vectors, k, rounds, width, seed="3"):
    """vectors: [(id, components)]; every distance, in Python's whole numbers."""
    kept = []
    for i, v in vectors:
        if v is not None and len(v) == width and all(x is not None and math.isfinite(x) and math.isfinite(1024.0 * x) for x in v):
            kept.append((i, [math.floor(1024.0 * x) for x in v]))
    hashed = lambda x: (x[0] is None, hashlib.sha256(f"{seed}:{x[0]}".encode()).hexdigest() if x[0] is not None else "", x[1])
    centres = [v for _, v in sorted(kept, key=hashed)[:k]]
    nearest = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(centres))
    for _ in range(rounds):
        own = [[] for _ in centres]
        for _, v in kept:
            own[nearest(v)[1]].append(v)
        centres = [[sum(x) // len(o) for x in zip(*o, strict=True)] if o else c for o, c in zip(own, centres, strict=True)]
    out = [(i, nearest(v)[1], nearest(v)[0]) for i, v in kept]
    return out, centres


@pytest.mark.parametrize("scale", [1.0, 1e6, 1e30])
def test_clusters_are_those_of_all_distances(spark, scale):
    r = random.Random(3)
    vectors = [(i, [r.choice([-1.0, 0.0, 0.5, r.gauss(0, 1)]) * scale for _ in range(6)]) for i in range(150)]
    vectors += [(7, vectors[7][1]), (None, [0.25] * 6), (900, None), (901, [1.0] * 5), (902, [1.0, None] * 3), (903, [math.nan] * 6), (904, [math.inf] * 6), (905, [-0.0] * 6)]
    vectors += [(1000 + i, [0.5 * scale] * 6) for i in range(80)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").withColumn("cluster", F.lit("clash")).repartition(5)
    got, centres = annulus.cluster(df, k=5, rounds=4, width=6)
    want, expected = plain_clusters(vectors, 5, 4, 6)
    assert centres == expected
    key = lambda x: (x[0] is None, x[0] or 0, *x[1:])
    assert sorted(((x.vec_id, x.cluster, x.distance) for x in got.collect()), key=key) == sorted(((i, c, min(d, annulus.LONG)) for i, c, d in want), key=key)


def test_cluster_report_and_edges(spark):
    flat = [(i, [float(i % 3)] * 4) for i in range(9)]
    df = spark.createDataFrame(flat, "vec_id long, embedding array<float>")
    rows = annulus.report(df, k=8, rounds=10, width=4).collect()
    want, centres = plain_clusters(flat, 8, 10, 4)
    total = sum(d for *_, d in want)
    for r in rows:
        i, c, d = want[r.vec_id]
        assert (r.cluster, r.distance, r.inertia, r.cluster_inertia) == (c, d, total, sum(x for _, o, x in want if o == c))
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, centres[c])).encode()).hexdigest()
    few = annulus.report(df.where("vec_id < 2"), k=8, rounds=3, width=4).collect()
    assert sorted(x.distance for x in few) == [0, 0]
    assert annulus.report(df.where("false"), width=4).collect() == []
    assert annulus.report(df, width=5).collect() == []


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(-4, 4), min_size=3, max_size=3), min_size=1, max_size=12), st.lists(st.lists(st.integers(-6, 6), min_size=3, max_size=3), min_size=1, max_size=20))
def test_annulus_keeps_boundary_ties(centres, vectors):
    owner, far = annulus.Centroids(centres, 3).nearest(np.array(vectors, dtype=np.float64))
    for v, c, d in zip(vectors, owner.tolist(), far, strict=True):
        assert (d, c) == min((sum((a - b) ** 2 for a, b in zip(v, o, strict=True)), n) for n, o in enumerate(centres))


def test_annulus_leaves_out_what_is_far():
    centres = [[100 * n, 0] for n in range(50)]
    first, end = annulus.Centroids(centres, 2).annulus(np.array([[1010.0, 0.0]]))
    assert (end - first).tolist() == [1]


# 12 manifest


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(*fields):
    return h(*["-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields])


def plain_tree(leaves):
    """(root, of each leaf the siblings left and right level by level)"""
    steps, nodes, own = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(nodes) > 1:
        runs = [nodes[i : i + 3] for i in range(0, len(nodes), 3)]
        for i, at in enumerate(own):
            run, k = runs[at // 3], at % 3
            steps[i].append(("".join(run[:k]), "".join(run[k + 1 :])))
            own[i] = at // 3
        nodes = [h(*r) for r in runs]
    return nodes[0], steps


def plain_manifest(rows):
    sources = {}
    for row in rows:
        sources.setdefault(row[1], []).append((plain_leaf(*row), row))
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        sources[s].sort(key=lambda x: (x[1][0] is not None, x[1][0] or 0, x[0]))
        trees[s] = plain_tree([x[0] for x in sources[s]])
    root, above = plain_tree([trees[s][0] for s in order])
    out = []
    for s, up in zip(order, above, strict=True):
        for (leaf, row), own in zip(sources[s], trees[s][1], strict=True):
            steps = own + up
            held = leaf
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0:
                held = plain_leaf(*row[:4], None if row[4] is None else row[4].replace("\n", ""))
            for a, b in steps:
                held = h(a, held, b)
            out.append((row[0], leaf, trees[s][0], root, h(*[a + b for a, b in steps]), held, held == root))
    return out


@pytest.mark.parametrize("height", [1, 2, 6])
@pytest.mark.parametrize("n_sources", [1, 7])
def test_manifest_is_that_of_a_plain_version(spark, height, n_sources, monkeypatch):
    monkeypatch.setattr(merkle.manifest, "__defaults__", (*merkle.manifest.__defaults__[:2], height))
    r = random.Random(height)
    rows = [(i, f"s{i % n_sources}" if i % 3 else "s0", "en", i, r.choice(["a\nb", "é", "", None, "x" * 3000, "\n"])) for i in range(-20, 130)]
    rows += [rows[3], rows[3], (None, "s0", None, None, "no id\n"), (5, "s0", "other", 1, "same id")]
    rows += [(500 + i, s, None, None, "t\n") for i, s in enumerate([None, "", "Z", "a", "é", "€"])] if n_sources > 1 else []
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    docs = docs.withColumns({"g": F.lit(1), "pos": F.lit(2), "leaf": F.lit("clash")}).repartition(6)
    key = lambda x: tuple((v is not None, v) for v in x)
    assert sorted(map(tuple, merkle.report(docs).collect()), key=key) == sorted(plain_manifest(rows), key=key)


def test_manifest_edges(spark):
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    assert merkle.report(spark.createDataFrame([], schema)).collect() == []
    one = [(4, None, None, None, None)]
    assert [tuple(r) for r in merkle.report(spark.createDataFrame(one, schema)).collect()] == plain_manifest(one)
    same = [(1, "s", "en", 1, "t")] * 40
    got = merkle.report(spark.createDataFrame(same, schema))
    assert sorted(map(tuple, got.collect())) == sorted(plain_manifest(same))
    kept = merkle.manifest(spark.createDataFrame(one, schema), F.col("source"), F.col("doc_id"), [F.col("text")], keep=[F.lit(1).alias("Leaf"), F.col("doc_id").alias("steps")])
    assert kept.columns == ["Leaf", "steps", "leaf_", "subroot", "root", "steps_"]


def test_traversal_folds_a_lone_last_leaf():
    leaves = [hashlib.sha256(bytes([i])).digest() for i in range(4)]
    top, steps = merkle.traversed(leaves, 2, 3)
    assert top.hex() == plain_tree([x.hex() for x in leaves])[0]
    assert steps[3] == [(b"", b""), (bytes.fromhex(h(*[x.hex() for x in leaves[:3]])), b"")]


# 13 merge replay


@pytest.fixture(scope="module")
def ranks():
    return byte_bpe.ranks_of(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


@pytest.fixture(scope="module")
def vocabulary(ranks):
    return byte_bpe.Vocabulary(ranks)


@pytest.fixture(scope="module")
def plain(ranks):
    return tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def encoded(texts, vocabulary):
    ids, size = byte_bpe.encoded_block(pa.array(texts, pa.string()), vocabulary)
    ends = np.append(0, np.cumsum(size))
    return [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:], strict=True)]


PARTS = ["'s", "'t", "'re", "'ve", "'m", "'ll", "'d", "'", " ", "  ", "\n", "\t", "a", "re", "é", "ß", "1", "२", "!", "''", "　", "՘", "࢏", "𝒳", "漢", "\x1c", "\x85", "ABC", ""]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.text(), st.lists(st.sampled_from(PARTS), max_size=30).map("".join)), max_size=8))
def test_replay_encodes_like_the_library(texts):
    ranks = byte_bpe.ranks_of(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")) if not _cache else None
    if ranks:
        _cache.extend([byte_bpe.Vocabulary(ranks), tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})])
    texts = [t.encode("utf-8", "replace").decode() for t in texts]
    assert encoded(texts, _cache[0]) == [_cache[1].encode_ordinary(t) for t in texts]


_cache: list = []


def test_every_code_point(vocabulary, plain):
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["x " + "".join(every[i : i + 500]) + "'s" for i in range(0, len(every), 500)]
    assert encoded(texts, vocabulary) == [plain.encode_ordinary(t) for t in texts]


def test_ranks_that_do_not_grow_with_length(vocabulary, monkeypatch):
    """Random vocabularies in which a merge may meet a lower rank: one position at a time, and overlaps."""
    monkeypatch.setattr(byte_bpe, "known_classes", lambda: vocabulary.classes)
    r, slow = random.Random(5), 0
    for _ in range(150):
        pool, tokens = [b"a", b"b", b"c"], []
        for _ in range(25):
            token = r.choice(pool) + r.choice(pool)
            if len(token) < 9 and token not in pool:
                pool.append(token)
                tokens.append(token)
        r.shuffle(tokens)
        ranks = {bytes([b]): b for b in range(256)} | {t: 256 + i for i, t in enumerate(tokens)}
        own = byte_bpe.Vocabulary(ranks)
        slow += bool(own.early)
        library = tiktoken.Encoding("odd", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        texts = ["".join(r.choices("abc", k=r.randrange(1, 40))) for _ in range(60)]
        assert encoded(texts, own) == [library.encode_ordinary(t) for t in texts]
    assert slow > 50


@pytest.mark.parametrize("pattern", [r"\p{L}+|\p{N}{1,3}|[^\s\p{L}\p{N}]+|\s+", r"\w+", r"."])
def test_other_patterns(ranks, pattern):
    own = byte_bpe.Vocabulary(ranks, pattern)
    library = tiktoken.Encoding("other", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    texts = ["", "it's 12345 o'clock\n\n", "naïve 漢字 ࢏՘", "x" * 300]
    assert encoded(texts, own) == [library.encode_ordinary(t) for t in texts]


def test_blocks_and_slices_do_not_matter(vocabulary, plain, monkeypatch):
    r = random.Random(2)
    texts = ["".join(r.choices(PARTS, k=r.randrange(0, 60))) for _ in range(200)] + ["a" * 5000, "ab" * 4000 + " ", ""]
    want = [plain.encode_ordinary(t) for t in texts]
    for size, symbols in ((1, 1), (50, 100), (10**6, 10**6)):
        monkeypatch.setattr(byte_bpe, "SLICE", size)
        monkeypatch.setattr(byte_bpe, "SYMBOLS", symbols)
        assert encoded(texts, vocabulary) == want


@pytest.mark.parametrize("block, ids", [(1, 1), (300, 50), (10**6, 10**6)])
def test_tables_encode_and_decode(spark, vocabulary, plain, block, ids, monkeypatch):
    monkeypatch.setattr(byte_bpe, "BLOCK_BYTES", block)
    monkeypatch.setattr(byte_bpe, "IDS", ids)
    r = random.Random(4)
    texts = [None, "", "\n", "long " * 3000, "w" * 4000, *("".join(r.choices(PARTS, k=r.randrange(0, 40))) for _ in range(60))]
    rows = [(i, t, 1) for i, t in enumerate(texts)] + [(2, texts[2], 1), (None, "no id", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int").repartition(3)
    got = byte_bpe.decode(byte_bpe.encode(docs, vocabulary, keep=["doc_id", "ids"]), vocabulary, "ids_").collect()
    assert len(got) == len(rows) and got[0].__fields__ == ["doc_id", "ids", "decoded"]
    by = {r[0]: r[1] for r in rows}
    assert all(bytes(x.decoded).decode() == (by[x.doc_id] or "") for x in got)
    found = {x.doc_id: x for x in byte_bpe.report(docs, vocabulary).collect()}
    for i, text in by.items():
        own = plain.encode_ordinary(text or "")
        x = found[i]
        assert (x.n_tokens, x.ids_sha256) == (len(own), hashlib.sha256(np.array(own, "<u4").tobytes()).hexdigest())
        assert x.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    assert byte_bpe.report(docs.where("false"), vocabulary).collect() == []


def test_refused(vocabulary, ranks):
    with pytest.raises(ValueError):
        byte_bpe.Vocabulary({b"a": 0})
    with pytest.raises(ValueError):
        vocabulary.decode([10**6])
