"""The pipeline against plain versions of its stages, and on tables with nulls, repeats, no rows and clashing names."""

from __future__ import annotations

import hashlib
import random

import pytest

import corpus_pipeline
from labeldiff.llm import mixing, toxicity
from tests.llm.test_operators import plain_hits

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(r, n):
    return " ".join("".join(r.choices("an be ca do en fi go hu in jo ka".split(), k=r.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    r, d = random.Random(9), tmp_path_factory.mktemp("sf")
    vile = ["trash", "moron", "idiot", "scum"]
    item = prose(r, 25)
    texts, labels = [], []
    for k in range(400):
        words = prose(r, r.randint(20, 60)).split()
        bad = k % 8 == 0
        for w in r.sample(vile, 3) if bad else []:
            words.insert(r.randrange(len(words)), w)
        if k % 20 == 3:
            words[5:5] = item.split()[3:18]
        texts.append(" ".join(words))
        labels.append((k, int(bad)))
    texts[5] = prose(r, 300)
    texts += [texts[1]] * 3 + [texts[2].replace(" ", "\n").upper(), texts[5].replace(texts[5].split()[40], "changed", 1), None, "", " "]
    rows = [(k, t, ("en", "de", None)[k % 3], f"s{k % 3}", len(t or "")) for k, t in enumerate(texts)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return str(d), rows, item


def test_stages(spark, folder):
    d, rows, item = folder
    docs = spark.read.parquet(f"{d}/documents.parquet")
    texts = {r[0]: r[1] for r in rows}
    out = corpus_pipeline.drop_toxic(spark, docs, d)
    model = toxicity.learn(docs, spark.read.parquet(f"{d}/labels.parquet"))
    kept = {k for k, t in texts.items() if model.score((t or "").encode())[0] < 0.7}
    assert {r.doc_id for r in out.collect()} == kept and not any(k % 8 == 0 for k in kept if k < 400) and len(kept) > 340
    out = corpus_pipeline.drop_near_duplicates(spark, out, d)
    first = {}
    for k in sorted(kept):
        first.setdefault(" ".join((texts[k] or "").lower().split()), k)
    want = set(first.values()) - {404}  # 404 is 5 with one word changed
    assert {r.doc_id for r in out.collect()} == want and not {400, 401, 402, 403} & want
    out = corpus_pipeline.drop_contaminated(spark, out, d)
    want = {k for k in want if not plain_hits(texts[k], [(1, item)])[1]}
    assert {r.doc_id for r in out.collect()} == want and not any(k % 20 == 3 for k in want if k < 400)
    mixed = corpus_pipeline.mix_sources(spark, out, d)
    drawn, names, _ = mixing.probabilities(out, None, alpha=corpus_pipeline.ALPHA)
    chance = {r.doc_id: r[names["drawn"]] for r in drawn.collect()}
    want = {k for k in want if chance[k]}
    assert {r.doc_id for r in mixed.collect()} == want and mixed.columns == docs.columns
    final = corpus_pipeline.deal_shards(spark, mixed, d)
    for r in final.collect():
        h = [int(hashlib.md5(f"{r.doc_id}:{s}".encode()).hexdigest()[:13], 16) for s in range(corpus_pipeline.SHARDS)]
        assert r.shard == h.index(max(h))
    assert sorted(map(str, corpus_pipeline.run(spark, d).collect())) == sorted(map(str, final.collect()))


def test_edges(spark, folder, tmp_path):
    d, rows, _ = folder
    odd = spark.createDataFrame([(None, None, None, None, None, 1, "x"), (7, "one two three", None, "s", 3, 1, "x"), (7, "one two three", None, "s", 3, 1, "x"), (8, "x" * 100_000, "en", None, 5, None, None)], f"{DOCS}, score int, Items string")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, odd, d)
        assert got.columns == odd.columns and got.count() <= 4
        assert stage(spark, odd.limit(0), d).count() == 0
    assert corpus_pipeline.drop_toxic(spark, odd, d).count() == 4 and corpus_pipeline.drop_near_duplicates(spark, odd, d).count() == 3
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{d}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
