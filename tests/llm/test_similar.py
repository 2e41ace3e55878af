"""Similar documents: links against plain similarities, and edges."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from labeldiff.llm import similar as sb
from labeldiff.llm.common import ALNUM


def shingles(text, k=5):
    w = (text or "").encode().translate(ALNUM).split()
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a or b else 1.0


def test_groups_follow_similarity(spark):
    r = random.Random(11)
    words = ["".join(r.choices("abcdefgh", k=6)) for _ in range(3000)]
    texts, family = [], []
    for f in range(40):
        base = r.choices(words, k=r.choice((80, 200, 600)))
        for c in range(r.choice((1, 2, 6))):
            copy = list(base)
            for i in r.sample(range(len(copy)), min(c, 1)):
                copy[i] = f"edit{c}x{f}"
            texts.append(" ".join(copy))
            family.append(f)
        half = base[: len(base) // 2] + r.choices(words, k=len(base) // 2)
        texts.append(" ".join(half))
        family.append(1000 + f)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x.doc_id: x.component_id for x in sb.similar_groups(df).collect()}
    sets = [shingles(t) for t in texts]
    for i in range(len(texts)):
        assert got[i] <= i
        for j in range(i):
            s = jaccard(sets[i], sets[j])
            assert s < 0.9 or got[i] == got[j], (i, j, s)
            assert s > 0.6 or got[i] != got[j], (i, j, s)
    kept = {x.doc_id for x in sb.keep_one(df).collect()}
    assert kept == set(got.values())


def test_large_group_stays_linear(spark):
    r = random.Random(12)
    base = ["".join(r.choices("abcdefgh", k=6)) for _ in range(400)]
    rows = []
    for k in range(500):
        copy = list(base)
        copy[r.randrange(400)] = f"e{k}"
        rows.append((k, " ".join(copy)))
    got = sb.similar_groups(spark.createDataFrame(rows, "doc_id long, text string")).groupBy("component_id").count().collect()
    assert [tuple(x) for x in got] == [(0, 500)]


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, " ?! "), (4, "one"), (5, "ONE."), (6, "one two"), (7, "a b c d e"), (7, "a b c d e"), (7, "v w x y z"), (None, "null id"), (9, "x" * 200_000), (10, "spam " * 900 + "some other words here now"), (11, "spam " * 900 + "quite different things are there")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"_node": F.lit(1), "Component_ID": F.lit("x"), "_text": F.lit("y")})
    kept = sb.keep_one(df)
    assert kept.columns == df.columns
    ids = [x.doc_id for x in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 4, 6, 7, 7, 9, 10, 11] and None in ids
    assert sb.keep_one(df.limit(0)).count() == 0


def scattered(r, base, similarity, k):
    """base with single words changed at random places until the similarity would be below the one asked for."""
    copy, own = list(base), shingles(" ".join(base))
    n = len(base)
    while True:
        step = max(1, n // 500)
        trial = list(copy)
        for i in r.sample(range(n), step):
            trial[i] = f"e{k}x{i}"
        if jaccard(own, shingles(" ".join(trial))) < similarity:
            return copy
        copy = trial


def test_scattered_edits_at_every_length(spark):
    r = random.Random(13)
    texts, pairs = [], []
    for n, times in ((100, 6), (500, 4), (2000, 3), (5000, 2), (20_000, 1)):
        for similarity in (0.8, 0.85, 0.9):
            for k in range(times):
                base = [f"w{r.randrange(50_000)}" for _ in range(n)]
                pairs.append((len(texts), len(texts) + 1))
                texts += [" ".join(base), " ".join(scattered(r, base, similarity, k))]
                far = scattered(r, base, 0.74, "f")
                for i in r.sample(range(n), max(2, n // 50)):
                    far[i] = f"g{i}"
                texts.append(" ".join(far))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x.doc_id: x.component_id for x in sb.similar_groups(df).collect()}
    for a, b in pairs:
        sets = [shingles(texts[k]) for k in (a, b, b + 1)]
        assert jaccard(sets[0], sets[1]) >= 0.8 and got[a] == got[b] == a
        assert (got[b + 1] == a) == (max(jaccard(sets[0], sets[2]), jaccard(sets[1], sets[2])) >= 0.8)


def test_copies_that_are_alike_only_through_their_original(spark):
    r = random.Random(14)
    texts = []
    for n, copies in ((100, 60), (300, 120)):
        base = [f"w{r.randrange(50_000)}" for _ in range(n)]
        group = [" ".join(scattered(r, base, 0.81, k)) for k in range(copies)]
        group.insert(copies // 2, " ".join(base))
        texts.append(group)
    # a chain: each is like the next only
    words = [f"w{r.randrange(50_000)}" for _ in range(600)]
    texts.append([" ".join(words[20 * k : 20 * k + 300]) for k in range(15)])
    rows = [(k, t) for k, t in enumerate(t for group in texts for t in group)]
    got = [x.component_id for x in sb.similar_groups(spark.createDataFrame(rows, "doc_id long, text string")).orderBy("doc_id").collect()]
    at = 0
    for group in texts:
        sets = [shingles(t) for t in group]
        assert all(jaccard(sets[0], x) < 0.8 for x in sets[2:10])
        assert got[at : at + len(group)] == [at] * len(group)
        at += len(group)
