"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Fitting (on at most ``MAX_TRAIN`` labelled rows, those with the smallest hash of their id; all other steps see all rows):
features of a text are its words (A-Z lowered) and their leading 4 to 7 bytes, so inflected forms of one stem can share a
feature, and each of these once more where it occurs twice or oftener. The vocabulary is fitted too: a feature is in it if
it tells the labels apart (chi-square of ``MIN_CHI2`` or more, for either label; however many there are); of a word's
features only the best one in it counts. Over all words, whatever they tell, nearest neighbours are those of the same
topic and half the toxic texts are missed; the README has the figures. Features are weighted by (1 + ln tf) * idf and
vectors scaled to length 1; equal vectors are merged with their label counts. The block-max inverted index of these
vectors is bounded by the sample.

Scoring: the index reads blocks in the order of their bounds until the k nearest are certain. They
vote with weight cos^2 (1 - distance, sharpened); a text without any feature has as neighbours the labelled texts
without any, and so has one that shares no feature with a labelled text. Votes become probabilities by a monotone map fitted on leave-one-out votes of the labelled rows
(pool-adjacent-violators with smoothing). Evidence: the neighbours' ids and cosines.

Defined results: null and empty texts have no features and are scored; null labels are ignored; several labels of one
id are averaged, one half counts as toxic; without any usable label the score is 0.5 for all; ties among neighbours go
to the vector with the smaller id; repeated rows are scored alike; extra columns are kept; whole texts are read.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labeldiff.llm.common import ALNUM, fresh, received, shipped, stored, text_bytes

#: Labelled rows that are fitted on, at most; neighbours; vectors in a block of the index; blocks read first; the share of blocks from which on reading all of them in one run costs less.
MAX_TRAIN, NEIGHBOURS, BLOCK, AHEAD, MOST = 20_000, 15, 64, 12, 0.3
#: Least document frequency and chi-square of a feature, at any number of labelled rows.
MIN_DF, MIN_CHI2 = 4, 20.0
#: Lengths of leading parts; least length of a word that has them.
LEADING, LONG = (4, 5, 6, 7), 5
#: Words a task remembers; what marks the feature of a repeated word.
MEMORY, AGAIN = 100_000, b"@2"


def parts(word: bytes) -> list[bytes]:
    """A word's features: itself and its leading parts (marked by a star)."""
    return [word, *(word[:n] + b"*" for n in LEADING if len(word) > n)] if len(word) >= LONG else [word]


def count_features(batches):
    """For mapInArrow over (y, text): document frequencies by label of every feature, one row a task and feature."""
    seen: dict[bytes, list[int]] = {}
    totals = [0, 0]
    for batch in batches:
        for y, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            totals[y] += 1
            tf: Counter = Counter()
            for w, n in Counter(text.as_buffer().to_pybytes().translate(ALNUM).split()).items():
                for p in parts(w):
                    tf[p] += n
            for f, n in tf.items():
                seen.setdefault(f, [0, 0])[y] += 1
                if n > 1:
                    seen.setdefault(f + AGAIN, [0, 0])[y] += 1
    rows = [(b"", *totals), *((f, *n) for f, n in seen.items())]
    for at in range(0, len(rows), 50_000):
        f, n0, n1 = zip(*rows[at : at + 50_000], strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(f, pa.binary()), pa.array(n0, pa.int64()), pa.array(n1, pa.int64())], names=["f", "n0", "n1"])


class Features:
    """Sparse vectors of texts over a chosen vocabulary: sorted ((feature, tf), ...)."""

    def __init__(self, vocabulary: dict[bytes, int]):
        self.vocabulary, self.known = vocabulary, {}

    def of(self, word: bytes) -> tuple[int, ...]:
        """The best of the word's features (the vocabulary is numbered from the best on), and its number for repeats."""
        best = min(((k, p) for p in parts(word) for q in (p, p + AGAIN) if (k := self.vocabulary.get(q)) is not None), default=None)
        got = () if best is None else (self.vocabulary.get(best[1], -1), self.vocabulary.get(best[1] + AGAIN, -1))
        if len(self.known) < MEMORY and len(word) < 64:
            self.known[word] = got
        return got

    def __call__(self, text: bytes) -> tuple[tuple[int, int], ...]:
        known, tf = self.known, Counter()
        for w in text.translate(ALNUM).split():
            got = known.get(w)
            if got is None:
                got = self.of(w)
            if got:
                tf[got] += 1
        return tuple(sorted((k, n) for (one, again), n in tf.items() for k in ((one, again) if n > 1 else (one,)) if k >= 0))


def kth(scores: np.ndarray, k: int) -> float:
    """The k-th largest; 0 if there are fewer."""
    return float(np.partition(scores, -k)[-k]) if k <= len(scores) else 0.0


class Index:
    """Block-max inverted index of labelled vectors. rows: [(vector, n0, n1, smallest id)] with distinct vectors.

    Vectors are numbered in the order of their features, so like ones are neighbours, and lie in blocks of ``BLOCK``.
    A feature's postings are cut by block, and its largest weight in each block bounds what the block can score. Blocks
    are read in the order of their bounds until no unread block can reach the k-th best score, so the result is exact.
    """

    def __init__(self, rows: list, idf: np.ndarray):
        self.idf = idf
        bare = [r for r in rows if not r[0]]
        self.bare = (sum(r[1] for r in bare), sum(r[2] for r in bare), min((r[3] for r in bare), default=None))
        rows = sorted((r for r in rows if r[0]), key=lambda r: r[0])
        self.number = {r[0]: k for k, r in enumerate(rows)}
        self.ids = [r[3] for r in rows]
        # Of equal scores the vector with the smaller id comes first.
        self.order = np.argsort(np.argsort(np.array(self.ids, dtype=np.int64), kind="stable"), kind="stable")
        self.n0 = np.array([r[1] for r in rows], dtype=float)
        self.n1 = np.array([r[2] for r in rows], dtype=float)
        self.size, self.blocks = len(rows), -(-len(rows) // BLOCK)
        pairs = [(f, k, w) for k, r in enumerate(rows) for f, w in zip(*self.weights(r[0]), strict=True)]
        f, at, w = (np.array(x) for x in zip(*sorted(pairs), strict=True)) if pairs else (np.zeros(0, int), np.zeros(0, int), np.zeros(0))
        self.at, self.w = at.astype(np.int32), w
        # Where the postings of each feature and block start; the last one ends the last.
        cell = f.astype(np.int64) * self.blocks + at // BLOCK
        self.start = np.searchsorted(cell, np.arange(len(idf) * self.blocks + 1))
        top = np.zeros(len(idf) * self.blocks)
        np.maximum.at(top, cell, w)
        self.top = top.reshape(len(idf), self.blocks)

    def weights(self, vector) -> tuple[np.ndarray, np.ndarray]:
        f = np.array([x[0] for x in vector])
        w = np.array([(1 + math.log(x[1])) * self.idf[x[0]] for x in vector])
        return f, w / np.linalg.norm(w)

    def read(self, f: np.ndarray, w: np.ndarray, blocks: np.ndarray) -> np.ndarray:
        """Scores from all postings of features f in the blocks."""
        cell = (f[:, None] * self.blocks + blocks[None, :]).ravel()
        size = self.start[cell + 1] - self.start[cell]
        ends = np.cumsum(size)
        at = np.repeat(self.start[cell] - (ends - size), size) + np.arange(ends[-1])
        return np.bincount(self.at[at], self.w[at] * np.repeat(np.repeat(w, len(blocks)), size), self.blocks * BLOCK)

    def read_all(self, f: np.ndarray, w: np.ndarray) -> np.ndarray:
        """The same for all blocks: each feature's postings are one run."""
        runs = [slice(self.start[x * self.blocks], self.start[(x + 1) * self.blocks]) for x in f.tolist()]
        return np.bincount(np.concatenate([self.at[r] for r in runs]), np.concatenate([self.w[r] * y for r, y in zip(runs, w.tolist(), strict=True)]), self.blocks * BLOCK)

    def nearest(self, vector, k: int, but: int = -1) -> list[tuple[float, int]]:
        """The k largest cosines above 0 as (cosine, vector number), exact; ``but`` is left out."""
        f, w = self.weights(vector)
        bound = w @ self.top[f]
        order = np.argsort(-bound)
        order = order[: np.count_nonzero(bound > 0)]
        # A feature that was nobody's best one in the sample has no postings.
        if not len(order):
            return []

        # The blocks with the highest bounds fix a score to beat; then all others that can.
        some = order[:AHEAD]
        score = self.read(f, w, some)
        if but >= 0:
            score[but] = 0
        least = kth(score[(some[:, None] * BLOCK + np.arange(BLOCK)[None, :]).ravel()], k)
        rest = order[AHEAD:][bound[order[AHEAD:]] >= least - 1e-11]
        if len(rest):
            score = score + self.read(f, w, rest) if len(rest) < MOST * self.blocks else self.read_all(f, w)
        if but >= 0:
            score[but] = 0
        least = kth(score[score >= least - 1e-11], k)
        hits = np.flatnonzero((score > 0) & (score >= least - 1e-11))
        near = np.round(score[hits], 12)
        best = np.lexsort((self.order[hits], -near))[:k]
        return list(zip(near[best].tolist(), hits[best].tolist(), strict=True))

    def vote(self, vector, k: int, but: int = -1, own: int = 0) -> tuple[float, list[tuple[float, int]]]:
        """Share of the weight of toxic neighbours; but/own: the vector and label of a labelled text that asks about itself."""
        n0, n1 = self.n0, self.n1
        if not vector:
            a, b, _ = self.bare
            a, b = (a - (own == 0), b - (own == 1)) if but == -2 else (a, b)
            return ((b / (a + b)) if a + b > 0 else 0.0), []
        alone = but >= 0 and n0[but] + n1[but] <= 1
        near = self.nearest(vector, k, but if alone else -1)
        up = down = 0.0
        for cos, i in near:
            a, b = n0[i], n1[i]
            if i == but:
                a, b = a - (own == 0), b - (own == 1)
            share = cos * cos * (1 + math.log(a + b)) / (a + b) if a + b > 0 else 0.0
            up, down = up + share * b, down + share * a
        return (up / (up + down) if up + down > 0 else self.vote((), k)[0]), near


def monotone(votes: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of a non-decreasing map from vote to probability: pool-adjacent-violators over distinct votes, each pool smoothed by half a row of either label."""
    pools: list[list[float]] = []  # lowest vote, highest vote, toxic, all
    for v in np.unique(votes):
        hit = votes == v
        pools.append([v, v, float(labels[hit].sum()), float(hit.sum())])
        while len(pools) > 1 and pools[-2][2] * pools[-1][3] >= pools[-1][2] * pools[-2][3]:
            b = pools.pop()
            pools[-1] = [pools[-1][0], b[1], pools[-1][2] + b[2], pools[-1][3] + b[3]]
    x = [e for p in pools for e in (p[0], p[1])]
    y = [(p[2] + 0.5) / (p[3] + 1) for p in pools for _ in (0, 1)]
    return np.array(x), np.maximum.accumulate(np.array(y))


class Model:
    """Vocabulary, index and calibration; small enough to broadcast (bounded by the sample of MAX_TRAIN rows)."""

    def __init__(self, vocabulary: dict[bytes, int], idf: np.ndarray, rows: list):
        self.features, self.index = Features(vocabulary), Index(rows, idf)
        numbers = self.index.number
        votes, labels, weight = [], [], []
        for vector, n0, n1, _ in rows:
            for y, n in ((0, n0), (1, n1)):
                if n:
                    votes.append(self.index.vote(vector, NEIGHBOURS, numbers.get(vector, -2), y)[0])
                    labels.append(y)
                    weight.append(int(n))
        self.x, self.y = monotone(np.repeat(votes, weight).round(9), np.repeat(labels, weight)) if votes else (np.array([0.0]), np.array([0.5]))
        self.scores: dict = {}

    def score(self, text: bytes) -> tuple[float, list[tuple[float, int]]]:
        vector = self.features(text)
        got = self.scores.get(vector)
        if got is None:
            vote, near = self.index.vote(vector, NEIGHBOURS)
            got = (float(np.interp(round(vote, 9), self.x, self.y)), [(c, self.index.ids[i]) for c, i in near[:3]])
            if len(self.scores) < 10_000 and len(vector) < 16:
                self.scores[vector] = got
        return got


def fit(labelled: DataFrame) -> Model:
    """labelled: (doc_id, text, toxic), any number of rows. One pass counts features, one makes the vectors; both over the bounded sample."""
    rows = labelled.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    chosen = rows.groupBy("doc_id").agg((F.avg("toxic") >= 0.5).cast("int").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_TRAIN)
    texts = labelled.select("doc_id", text_bytes("text").alias("text")).join(F.broadcast(chosen), "doc_id")
    sample = stored(texts.select("doc_id", "y", "text"), "labelled")
    counts = sample.select("y", "text").mapInArrow(count_features, "f binary, n0 long, n1 long").groupBy("f").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    counts = stored(counts.where((F.col("n0") + F.col("n1") >= MIN_DF) | (F.octet_length("f") == 0)), "features")
    total = counts.where(F.octet_length("f") == 0).first()
    if total is None or not (total.n0 and total.n1):
        return Model({}, np.zeros(0), [((), total.n0, total.n1, None)] if total is not None and total.n0 + total.n1 else [])
    m0, m1 = float(total.n0), float(total.n1)
    a, b = F.col("n1").cast("double"), F.col("n0").cast("double")
    c, d = F.lit(m1) - a, F.lit(m0) - b
    chi2 = F.lit(m0 + m1) * (a * d - b * c) * (a * d - b * c) / (F.lit(m0 * m1) * (a + b) * F.greatest(c + d, F.lit(1.0)))
    picked = counts.where(F.octet_length("f") > 0).withColumn("chi2", chi2).where(F.col("chi2") >= MIN_CHI2).orderBy(F.desc("chi2"), "f").collect()
    vocabulary = {bytes(r.f): k for k, r in enumerate(picked)}
    idf = np.array([math.log((1 + m0 + m1) / (1 + r.n0 + r.n1)) + 1 for r in picked])
    vectors = sample.mapInArrow(vectorize(vocabulary), "y int, doc_id long, f array<int>, tf array<int>").groupBy("f", "tf").agg(F.count_if(F.col("y") == 0).alias("n0"), F.count_if(F.col("y") == 1).alias("n1"), F.min("doc_id").alias("doc_id"))
    rows = sorted(((tuple(zip(r.f, r.tf, strict=True)), r.n0, r.n1, r.doc_id) for r in vectors.collect()), key=lambda r: r[3])
    return Model(vocabulary, idf, rows)


def vectorize(vocabulary: dict[bytes, int]):
    def run(batches):
        features = Features(vocabulary)
        for batch in batches:
            got = [features(t.as_buffer().to_pybytes()) for t in batch["text"]]
            yield pa.RecordBatch.from_arrays([batch["y"], batch["doc_id"].cast(pa.int64()), pa.array([[x[0] for x in v] for v in got], pa.list_(pa.int32())), pa.array([[x[1] for x in v] for v in got], pa.list_(pa.int32()))], names=["y", "doc_id", "f", "tf"])

    return run


def add_scores(model, n_keep: int, names: list[str]):
    def run(batches):
        m = received(model)
        for batch in batches:
            got = [m.score(t.as_buffer().to_pybytes()) for t in batch.column(n_keep)]
            near = pa.array([[{"doc_id": i, "cosine": c} for c, i in e] for _, e in got], pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64())])))
            yield pa.RecordBatch.from_arrays([*batch.columns[:n_keep], pa.array([s for s, _ in got], pa.float64()), near], names=names)

    return run


def score(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None, name: str = "score", evidence: str = "evidence") -> DataFrame:
    """The columns ``keep`` (default: all), the score and its evidence, named with underscores behind where a column has that name. One pass, no shuffle."""
    keep = docs.columns if keep is None else keep
    name = fresh(keep, name)
    evidence = fresh([*keep, name], evidence)
    kept = docs.select(*[F.col(f"`{c}`") for c in keep])
    sent = docs.select(*[F.col(f"`{c}`") for c in keep], text_bytes(f"`{text_col}`").alias(fresh([*keep, name, evidence], "_text")))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema), f"`{name}` double", f"`{evidence}` array<struct<doc_id:long,cosine:double>>"])
    shared = shipped(docs.sparkSession, model)
    return sent.mapInArrow(add_scores(shared, len(keep), [*keep, name, evidence]), schema)


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt: crc32 of the id as text leaves remainder 1 by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learn(documents: DataFrame, labels: DataFrame) -> Model:
    """Fits on the documents with a label whose id is not held out."""
    usable = labels.where(~held_out(F.col("doc_id"))).select(F.col("doc_id").alias("_id"), "toxic")
    chosen = usable.where(F.col("toxic").isNotNull() & F.col("_id").isNotNull()).groupBy("_id").agg(F.avg("toxic").alias("toxic")).orderBy(F.xxhash64("_id"), "_id").limit(MAX_TRAIN)
    rows = documents.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
    return fit(rows.select("doc_id", "text", "toxic"))


def report(documents: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    got = score(documents.select("doc_id", "text"), learn(documents, labels), keep=["doc_id"])
    return got.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "evidence")


def reject(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """docs without those that score at least ``threshold``; their columns unchanged."""
    name, evidence = fresh(docs.columns, "score"), fresh(docs.columns, "evidence")
    got = score(docs, model, name=name, evidence=evidence)
    return got.where(F.col(name) < threshold).select(*[F.col(f"`{c}`") for c in docs.columns])
