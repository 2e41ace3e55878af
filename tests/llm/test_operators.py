"""Each operator against a plain version on small tables, with nulls, empty and long texts, ties, repeats, empty tables and clashing names."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from labeldiff.llm import bitplane, chat, decontaminate, html_crf, licenses, mixing, sharding, similar, simhash, toxicity, va_file
from labeldiff.llm.html_blocks import blocks
from labeldiff.llm.labelled_pages import labelled_pages
from labeldiff.llm.license_rules import BASE, rules

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, Extra string"


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))


def sample_texts():
    r = random.Random(5)
    syllables = "an be ca do en é fi go hu in jo ka ß ñ".split()
    prose = lambda n: " ".join("".join(r.choices(syllables, k=r.randint(1, 3))) for _ in range(n))
    texts = [None, "", " \n\t ", "One", "Two words", "x" * 5000, prose(4000), prose(60).upper(), prose(60) + "."]
    base = prose(900)
    texts += [base, base, base.replace(" ", "  "), base.upper(), base + " tail", base.replace(base.split()[7], "other", 1)]
    texts += [prose(r.randint(3, 80)) for _ in range(60)]
    return texts


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, t, ("en", "fr", None)[k % 3], f"s{k % 4}" if k % 7 else None, 1, 0.5, "e") for k, t in enumerate(sample_texts())]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


# 1 token ids


@pytest.fixture(scope="module")
def vocabulary():
    return pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")


@pytest.mark.parametrize(("block", "width"), [(64, 8), (1000, 1), (65_536, 8)])
def test_ids_round_trip(docs, vocabulary, block, width):
    from tokenizers import Tokenizer

    plain, start = Tokenizer.from_file(vocabulary), 0
    table = bitplane.write_ids(docs, vocabulary, block=block, width=width)
    got, ids = by_id(bitplane.read_documents(table)), {}
    for r in sorted(bitplane.decode_ids(table).collect(), key=lambda r: (r.doc_id, r.off)):
        ids.setdefault(r.doc_id, []).extend(r.ids)
    for k, t in enumerate(sample_texts()):
        want = plain.encode(t or "", add_special_tokens=False).ids + [1]
        assert ids[k] == want
        assert tuple(got[k])[1:] == (start, len(want), zlib.crc32(np.array(want, "<u4").tobytes()))
        start += len(want)
    index = sorted(bitplane.chunk_index(table).collect(), key=lambda r: r.start)
    assert [r.start for r in index] == list(np.cumsum([0] + [r.n_ids for r in index])[:-1])


def test_ids_ties_and_empty(spark, nothing, vocabulary):
    assert bitplane.read_documents(bitplane.write_ids(nothing, vocabulary)).count() == 0
    rows = spark.createDataFrame([(3, "b"), (3, "a"), (3, "a"), (None, "n"), (1, None)], "doc_id long, text string")
    got = sorted(bitplane.read_documents(bitplane.write_ids(rows, vocabulary)).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None, 1, 3, 3, 3] and [r.n_tokens for r in got] == [2, 1, 2, 2, 2]


@pytest.mark.parametrize("text", ["<|endoftext|> a.b, it's. C'est été, l'été. (a). x.) 'tis! <|ENDOFTEXT|>a!", "É, İstanbul, 12.5, 7! \x1c x\x0by é. 　a", "n't'LL. we'Re, a's! '.'", "a.,;b.. ,, .a"])
def test_chunks_encode_like_whole_texts(vocabulary, text):
    encoder = bitplane.Encoder(vocabulary, False)
    for _ in range(2):
        ids, counts = encoder(pa.array([text, "", text]))
        want = encoder.tokenizer.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == want + want and counts.tolist() == [len(want), 0, len(want)]


def test_crc_joined():
    a, b = b"some bytes", b"and more of them" * 99
    assert bitplane.crc_joined(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


def test_other_vocabularies_encode_whole_texts():
    path = pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")
    encoder, texts = bitplane.Encoder(path, True), ["Ab  c.\n d", "", "<|endoftext|> x, é", "word " * 50]
    ids, counts = encoder(pa.array(texts))
    want = [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert not encoder.by_chunks and ids.tolist() == [x for w in want for x in w] and counts.tolist() == [len(w) for w in want]


# 2 toxicity


def test_nearest_is_exact():
    r = random.Random(3)
    rows = {}
    for k in range(900):
        v = tuple(sorted((f, r.randint(1, 4)) for f in r.sample(range(60), r.randint(0, 6))))
        rows.setdefault(v, (v, r.randint(0, 2), r.randint(0, 2), k))
    index = toxicity.Index(list(rows.values()), np.array([1 + r.random() * 3 for _ in range(60)]))
    dense = []
    for v in (v for v in rows if v):
        x = np.zeros(60)
        f, w = index.weights(v)
        x[f] = w
        dense.append(x)
    dense = np.array(dense)
    for v in list(rows)[:200]:
        if v:
            x = np.zeros(60)
            f, w = index.weights(v)
            x[f] = w
            cos = np.round(dense @ x, 9)
            want = sorted((-c, i) for i, c in enumerate(cos) if c > 0)[:15]
            got = index.nearest(v, 15)
            assert [round(c, 9) for c, _ in got] == [-c for c, _ in want]


def test_toxicity_learns_and_scores(spark):
    r = random.Random(1)
    clean, vile = [f"w{k}" for k in range(300)], ["trash", "moronic", "moronity", "vilebarg", "vilebork"]
    rows, labels = [], []
    for k in range(600):
        bad = k % 5 == 0
        text = r.choices(clean, k=40) + (r.sample(vile, 2) if bad else [])
        r.shuffle(text)
        rows.append((k, " ".join(text)))
        labels.append((k, int(bad)))
    rows += [(1000, None), (1001, ""), (1002, "vilebaz moronish " * 3), (1003, "unheard of words"), (1003, "unheard of words")]
    labels += [(1000, 0), (2, None), (3, 0), (None, 1)]
    documents, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    got = toxicity.report(documents, marks).collect()
    assert len(got) == len(rows)
    for g in got:
        assert 0 <= g.score <= 1 and g.predicted == int(g.score >= 0.7) and g.held_out == (zlib.crc32(str(g.doc_id).encode()) % 3 == 1)
        if g.doc_id < 600:
            assert g.predicted == int(g.doc_id % 5 == 0)
    assert {g.doc_id: g.predicted for g in got if g.doc_id >= 1000} == {1000: 0, 1001: 0, 1002: 1, 1003: 0}
    kept = toxicity.reject(documents.withColumn("score", F.lit("x")), toxicity.learn(documents, marks))
    assert kept.columns == ["doc_id", "text", "score"] and kept.count() == sum(g.score < 0.7 for g in got)


def plain_toxicity(rows, labels):
    """rows: (doc_id, text); labels: (doc_id, toxic) that are learnt from. Scores by loops over dicts."""
    parts = lambda w: [w, *(w[:n] + "*" for n in (4, 5, 6, 7) if len(w) > n)] if len(w) >= 5 else [w]
    known = {d: t for d, t in rows}
    train = [(d, words(known[d]), y) for d, y in sorted(labels.items()) if d in known]
    counts = {}
    for _, w, y in train:
        tf = {}
        for x in w:
            for f in parts(x):
                tf[f] = tf.get(f, 0) + 1
        for f, n in tf.items():
            for g in (f, f + "@2")[: 1 + (n > 1)]:
                counts.setdefault(g, [0, 0])[y] += 1
    m = [sum(1 for *_, y in train if y == k) for k in (0, 1)]
    chi = {f: sum(m) * (b * (m[0] - a) - (m[1] - b) * a) ** 2 / (m[0] * m[1] * (a + b) * max(1, sum(m) - a - b)) for f, (a, b) in counts.items() if a + b >= toxicity.MIN_DF}
    order = {f: k for k, f in enumerate(sorted((f for f in chi if chi[f] >= toxicity.MIN_CHI2), key=lambda f: (-chi[f], f)))}
    idf = {f: math.log((1 + sum(m)) / (1 + sum(counts[f]))) + 1 for f in order}

    def vector(w):
        tf = {}
        for x in w:
            best = min(((order[q], f) for f in parts(x) for q in (f, f + "@2") if q in order), default=None)
            if best:
                tf[best[1]] = tf.get(best[1], 0) + 1
        return tuple(sorted((order[q], n) for f, n in tf.items() for q in (f, f + "@2")[: 1 + (n > 1)] if q in order))

    names = {k: f for f, k in order.items()}
    scaled = lambda v: {k: (1 + math.log(n)) * idf[names[k]] for k, n in v}
    groups = {}
    for d, w, y in train:
        g = groups.setdefault(vector(w), [0, 0, d])
        g[y] += 1
        g[2] = min(g[2], d)

    def vote(v, own=None):
        if not v:
            a, b, _ = groups.get((), (0, 0, 0))
            if own is not None:
                a, b = a - (own == 0), b - (own == 1)
            return b / (a + b) if a + b else 0.0
        x, near = scaled(v), []
        for u, (a, b, d) in groups.items():
            if u and not (own is not None and u == v and a + b <= 1):
                z = scaled(u)
                cos = sum(x[k] * z.get(k, 0) for k in x) / math.hypot(*x.values()) / math.hypot(*z.values())
                if cos > 0:
                    near.append((-round(cos, 12), d, u))
        up = down = 0.0
        for c, _, u in sorted(near)[: toxicity.NEIGHBOURS]:
            a, b, _ = groups[u]
            if own is not None and u == v:
                a, b = a - (own == 0), b - (own == 1)
            if a + b > 0:
                share = c * c * (1 + math.log(a + b)) / (a + b)
                up, down = up + share * b, down + share * a
        return up / (up + down) if up + down > 0 else vote(())

    votes = sorted((round(vote(v, y), 9), y) for v, g in groups.items() for y in (0, 1) for _ in range(g[y]))
    pools = []
    for x in sorted({v for v, _ in votes}):
        pools.append([x, x, sum(y for v, y in votes if v == x), sum(1 for v, _ in votes if v == x)])
        while len(pools) > 1 and pools[-2][2] / pools[-2][3] >= pools[-1][2] / pools[-1][3]:
            z = pools.pop()
            pools[-1] = [pools[-1][0], z[1], pools[-1][2] + z[2], pools[-1][3] + z[3]]
    knots = [(e, (p[2] + 0.5) / (p[3] + 1)) for p in pools for e in p[:2]]
    ys = np.maximum.accumulate([y for _, y in knots])
    return {d: float(np.interp(round(vote(vector(words(t))), 9), [x for x, _ in knots], ys)) for d, t in rows}


def test_toxicity_is_that_of_a_plain_version(spark):
    r = random.Random(41)
    plain, vile = [f"word{k}" for k in range(60)], ["trash", "moronic", "moronity", "scum", "vilebarg"]
    rows, labels = [], []
    for k in range(240):
        bad = k % 4 == 0
        text = r.choices(plain, k=r.randint(3, 25)) + (r.choices(vile, k=r.randint(1, 4)) if r.random() < (0.85 if bad else 0.12) else []) + (["calm"] * r.randint(1, 2) if not bad and r.random() < 0.7 else [])
        rows.append((k, " ".join(text)))
        labels.append((k, int(bad)))
    got = {g.doc_id: g.score for g in toxicity.report(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")).collect()}
    want = plain_toxicity(rows, {k: y for k, y in labels if zlib.crc32(str(k).encode()) % 3 != 1})
    assert got == pytest.approx(want, abs=1e-6) and len(set(np.round(list(want.values()), 6))) > 3


def test_features_of_either_label_at_any_sample(spark):
    r = random.Random(2)
    rows = []
    for k in range(8000):
        bad = k % 8 == 0
        words = ["both"] + (["calm"] if not bad and r.random() < 0.6 else []) + (["vile"] if bad else []) + (["rare"] if bad and k < 32 else [])
        rows.append((k, " ".join(words), int(bad)))
    model = toxicity.fit(spark.createDataFrame(rows, "doc_id long, text string, toxic int"))
    assert {b"calm", b"rare", b"vile"} <= set(model.features.vocabulary) and b"both" not in model.features.vocabulary
    assert model.features(b"calm") and model.score(b"calm")[0] < 0.1 and model.score(b"rare vile")[0] > 0.9


def test_toxicity_without_labels(spark, docs, nothing):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in toxicity.report(docs, none).collect()} == {0.5}
    assert toxicity.report(nothing, none).count() == 0
    one = spark.createDataFrame([(0, 1), (2, 1), (4, 1)], "doc_id long, toxic int")
    assert all(0 <= r.score <= 1 for r in toxicity.report(docs, one).collect())


# 3 sharding


def test_rendezvous(docs, nothing):
    rows = sharding.shard_report(docs, 24).collect()
    assert len(rows) == docs.count()
    for k, t in enumerate(sample_texts()):
        r = next(x for x in rows if x.doc_id == k)
        h = [int(hashlib.md5(f"{k}:{s}".encode()).hexdigest()[:13], 16) for s in range(25)]
        raw = (t or "").encode()
        assert (r.size, r.text_crc32, r.law, r.shard, r.grown_shard) == (len(raw) + 8, zlib.crc32(raw), "key", int(np.argmax(h[:24])), int(np.argmax(h)))
    for s in {r.shard for r in rows}:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))
    assert sharding.shard_report(nothing).count() == 0


def test_weights_nulls_and_repeats(spark):
    keys = spark.range(20_000).withColumnRenamed("id", "doc_id")
    counts = {r.shard: r["count"] for r in sharding.assign_shards(keys, "doc_id", [1.0, 2.0, 1.0]).groupBy("shard").count().collect()}
    assert abs(counts[1] - 10_000) < 500 and abs(counts[0] - 5_000) < 400
    before, after = (by_id(sharding.assign_shards(keys, "doc_id", w)) for w in ([1.0] * 5, [1.0] * 6))
    assert all(after[k].shard in (before[k].shard, 5) for k in before)
    rows = spark.createDataFrame([(None, "a")] * 5 + [(7, "a")] * 3 + [(7, "b")], "doc_id long, text string")
    got = sharding.shard_report(rows, 1).collect()
    assert sorted(r.slot for r in got) == list(range(9))
    with pytest.raises(ValueError):
        sharding.rendezvous(F.col("x"), [])


# 4 mixing


def plain_mix(rows, budget, alpha):
    """rows: (source, lang, topic, tokens). Probabilities of the cells and targets, with loops over dicts."""
    total, cells = sum(r[3] for r in rows), {}
    for *cell, n in rows:
        if n:
            cells[tuple(cell)] = cells.get(tuple(cell), 0) + n / total
    goal = []
    for j in range(3):
        share = {}
        for c, n in cells.items():
            share[c[j]] = share.get(c[j], 0) + n
        t = {v: x**alpha[j] for v, x in share.items()}
        t = {v: x / sum(t.values()) for v, x in t.items()}
        low, high = 0.0, 1e9
        for _ in range(300):  # the scale at which capped targets sum to one
            mid = (low + high) / 2
            low, high = (mid, high) if sum(min(x * mid, share[v] / budget) for v, x in t.items()) < 1 else (low, mid)
        goal.append({v: min(x * high, share[v] / budget) for v, x in t.items()})
    f = [dict.fromkeys(g, 1.0) for g in goal]
    p = lambda c: min(1.0, budget * f[0][c[0]] * f[1][c[1]] * f[2][c[2]])
    for _ in range(3000):
        for j in range(3):
            for v in f[j]:
                f[j][v] = min(1e150, f[j][v] * goal[j][v] * budget / sum(n * p(c) for c, n in cells.items() if c[j] == v))
    return {c: p(c) for c in cells}, goal


def mixed_rows(spark, n=3000):
    r = random.Random(31)
    rows = [(k, "word " * (r.randint(0, 9) * (1 + (k % 7 == 0))), r.choice("aaaabc"), r.choice(("en", "en", "en", "de", None)), r.choice(("x", "x", "y"))) for k in range(n)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, kind string")


@pytest.mark.parametrize("max_cells", [mixing.MAX_CELLS, 3])
def test_raking_is_that_of_a_plain_version(spark, max_cells, monkeypatch):
    rows, df = mixed_rows(spark)
    monkeypatch.setattr(mixing, "ROUNDS", 16)
    marked, names = mixing.marked_rows(df, topic_col="kind")
    cells = marked.select(*[F.col(names[k]).alias(k) for k in (*mixing.KINDS, "tokens")])
    mix = mixing.fit(cells, 0.7, alpha={"source": 0.5, "lang": 0.2}, max_cells=max_cells)
    want, goal = plain_mix([(s, x or "", t, len(text.split())) for _, text, s, x, t in rows], 0.7, (0.5, 0.2, 0.7))
    assert {(r.source, r.lang, r.topic): r.p for r in mix.cells.collect()} == pytest.approx(want, abs=5e-3 if max_cells > 3 else 5e-2)
    labels = mix.labels.collect()
    for j, kind in enumerate(mixing.KINDS):
        own = {r.label: r for r in labels if r.kind == kind}
        assert {v: r.target for v, r in own.items()} == pytest.approx(goal[j], abs=1e-6)
        assert {v: r.drawn for v, r in own.items()} == pytest.approx(goal[j], abs=1e-3 if max_cells > 3 else 1e-2)
    assert mix.error <= (mixing.TOLERANCE if max_cells > 3 else 1e-2) and any(r.target < r.asked - 0.01 for r in labels)
    if max_cells < 18:
        return
    whole = mixing.fit(cells, None, alpha={"source": 0.5, "lang": 0.2}, max_cells=max_cells)
    assert whole.budget < 0.7 and all(r.target == pytest.approx(r.asked) and r.drawn == pytest.approx(r.asked, abs=1e-3) for r in whole.labels.collect())


def test_mixing_budget_and_edges(spark, docs, nothing):
    rows, big = mixed_rows(spark, 4000)
    big = big.withColumns({"mix_tokens": F.lit("mine"), "Mix_Drawn": F.lit(1)})
    got, names, mix = mixing.probabilities(big, 0.5, {"lang": {"en": 0.5, "de": 0.5, "xx": 1.0}}, topic_col="kind")
    assert set(big.columns) <= set(got.columns) and len(set(x.lower() for x in got.columns)) == len(got.columns)
    tokens, p = F.col(names["tokens"]), F.col(names["probability"])
    all_tokens, expected, drawn = got.agg(F.sum(tokens), F.sum(tokens * p), F.sum(F.when(F.col(names["drawn"]), tokens))).first()
    assert expected == pytest.approx(mix.budget * all_tokens, rel=1e-3) and drawn == pytest.approx(expected, rel=0.08)
    assert got.where(F.col("lang").isNull() & (tokens > 0) & (p > 0)).isEmpty() and mix.budget <= 0.5
    assert got.count() == 4000 and mixing.draw(nothing).count() == 0
    again = mixing.draw(big.repartition(7), 0.5)
    assert again.columns == big.columns and sorted(r[0] for r in again.collect()) == sorted(r[0] for r in mixing.draw(big, 0.5).collect())
    assert mixing.draw(docs, 2.0).count() == docs.count()
    with pytest.raises(ValueError):
        mixing.rescaled({"zz": 1.0}, {"a": 0.5})


def test_topics(spark):
    texts = ["The doctor told the patient: a new vaccine!", "Die Aktie fällt, die Zinsen steigen; Steuer.", "doctor and patient only", "a | b | c | d", None, ""]
    got = [r.t for r in spark.createDataFrame(list(enumerate(texts)), "k int, text string").orderBy("k").select(mixing.topic_of(F.coalesce("text", F.lit(""))).alias("t")).collect()]
    assert got == ["health", "finance", "prose", "table", "prose", "prose"]


# 5 pages


def test_pages_held_out():
    crf, right, total = html_crf.default_model(), 0, 0
    for page, labels in labelled_pages(200, seed=77):
        chain = blocks(page)
        assert len(chain) == len(labels)
        right += sum(a == b for a, b in zip(crf.decode([b.features for b in chain]), labels, strict=True))
        total += len(labels)
    assert right / total > 0.98


def test_viterbi_is_the_best_path():
    from itertools import product

    crf, r = html_crf.default_model(), random.Random(2)
    names = sorted(crf.weights)
    for _ in range(20):
        chain = [tuple(r.sample(names, 3)) for _ in range(r.randint(1, 7))]

        def value(path, chain=chain):
            v = crf.begins[path[0]] + crf.ends[path[-1]] + sum(crf.moves[a][b] for a, b in zip(path, path[1:], strict=False))
            return v + sum(sum(crf.weights[f] for f in fs) for fs, s in zip(chain, path, strict=True) if s)

        assert value(crf.decode(chain)) == pytest.approx(max(value(p) for p in product((0, 1), repeat=len(chain))))


def test_page_edges(spark):
    page = '<html><head><title>T</title></head><body><nav><a href=/>Home</a></nav><article><h1>A &amp; B</h1><p>One\n two&nbsp;three.<p><b>Four<br>five.</article><div class="comments"><p>me too</p></div><footer>&copy; x</footer>'
    rows = [(1, page), (2, None), (3, ""), (4, "<p"), (5, "<" * 3000), (6, "</p></x><!-- never closed"), (7, page), (8, "<script>never closed <p>x</p>"), (9, "<article>" + "<p>word word word word word.</p>" * 3000 + "</article>")]
    got = by_id(html_crf.extract(spark.createDataFrame(rows, "page_id long, html string").withColumn("Url", F.lit("u"))), "page_id")
    assert got[1].text == "A & B\nOne two three.\nFour five." and got[7].text == got[1].text
    assert got[2].text == got[3].text == got[6].text == got[8].text == "" and got[9].n_chars == 3000 * 26 - 1
    assert all(r.n_chars == len(r.text) for r in got.values())
    assert html_crf.extract(spark.createDataFrame([], "page_id long, html string")).count() == 0


def test_deep_pages_cost_time_in_proportion():
    import time

    crf = html_crf.default_model()
    took = []
    for n in (4000, 32_000):
        pages = ["<div class=c%d>x" * n % tuple(range(n)), "<div>" * n + "<td>a" * n, "<ul>" + "<div>" * n + "<p>b</span>" * n, "<table>" + "<div>" * n + "<td>c</td>" * n]
        start = time.process_time()
        assert all(isinstance(html_crf.main_text(p, crf), str) for p in pages)
        took.append(time.process_time() - start)
    assert took[1] < 24 * took[0] + 1


def test_gains_are_the_features_of_ancestors():
    crf = html_crf.default_model()
    for page, _ in labelled_pages(40, seed=5):
        whole, short = blocks(page), blocks(page, crf.units)
        for a, b in zip(whole, short, strict=True):
            assert a.text == b.text and sum(crf.units.get(f, 0) for f in a.features) == sum(crf.units.get(f, 0) for f in b.features) + b.gain
        assert crf.decode([b.features for b in whole]) == crf.decode([b.features for b in short], [b.gain for b in short])


def test_head_without_end():
    page = "<html><head><title>T</title><meta charset=u><body><article><h1>Big news today</h1><p>First long sentence of the article stands here.</p></article></body>"
    assert [b.text for b in blocks(page)] == ["Big news today", "First long sentence of the article stands here."]
    assert [b.text for b in blocks(page.replace("<body>", ""))] == [b.text for b in blocks(page)]
    assert [b.text for b in blocks("<head><title>T</title><script>x</script></head><p>a")] == ["a"]


# 6 near duplicates


def plain_print(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", lowered(text))
    if not w:
        return 0
    parts = [" ".join(w[i : i + k]) for i in range(len(w) - k + 1)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_groups(prints):
    """prints: {id: fingerprint}; smallest id within reach."""
    root = {k: k for k in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(prints)
    for i in ids:
        for j in ids:
            if i < j and (prints[i] ^ prints[j]).bit_count() <= 2:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {k: find(k) for k in ids}


@pytest.mark.parametrize("hot", [64, 1])
def test_fingerprints_and_components(docs, hot, monkeypatch):
    monkeypatch.setattr(simhash, "HOT", hot)
    prints = {k: plain_print(t, 3) for k, t in enumerate(sample_texts())}
    want = plain_groups(prints)
    got = by_id(simhash.near_duplicates(docs, shingle=3))
    assert {k: r.fp % 2**64 for k, r in got.items()} == prints
    assert {k: r.component_id for k, r in got.items()} == want
    assert set(docs.columns) < set(simhash.near_duplicates(docs, 3).columns)


@pytest.mark.parametrize("hot", [64, 2])
def test_chains_of_close_fingerprints(spark, hot, monkeypatch):
    monkeypatch.setattr(simhash, "HOT", hot)
    r, prints = random.Random(4), {}
    for g in range(6):
        x = r.getrandbits(64)
        for _ in range(25):
            for b in r.sample(range(64), r.randint(0, 3)):
                x ^= 1 << b
            prints[len(prints)] = x
    want = plain_groups(prints)
    df = spark.createDataFrame([(v - 2**64 if v >= 2**63 else v,) for v in set(prints.values())], "fp long")
    whole = {row.node: row.root for row in simhash.components(simhash.close_pairs(df)).collect()}
    groups = {}
    for k, v in prints.items():
        s = v - 2**64 if v >= 2**63 else v
        groups.setdefault(whole.get(s, s), set()).add(want[k])
    assert all(len(x) == 1 for x in groups.values()) and len(groups) == len(set(want.values()))


def test_keep_one(spark, docs, nothing):
    kept = simhash.keep_one(docs.withColumn("fp", F.lit(1)).withColumn("component_id", F.lit("x")), shingle=3)
    want = set(plain_groups({k: plain_print(t, 3) for k, t in enumerate(sample_texts())}).values())
    assert kept.columns == [*docs.columns, "fp", "component_id"] and {r.doc_id for r in kept.collect()} == want
    assert simhash.near_duplicates(nothing).count() == 0
    twice = spark.createDataFrame([(1, "a b c d"), (1, "a b c d"), (2, None), (3, "")], "doc_id long, text string")
    assert sorted(r.doc_id for r in simhash.keep_one(twice).collect()) == [1, 2]


# 7 decontamination


def plain_hits(text, items):
    w, hit, names = words(text), set(), set()
    for name, item in items:
        iw = words(item)
        for s in {tuple(iw[i : i + 10]) for i in range(max(1, len(iw) - 9))} if iw else ():
            for i in range(len(w) - len(s) + 1):
                if tuple(w[i : i + len(s)]) == s:
                    hit.update(range(i, i + len(s)))
                    names.add(str(name))
    return len(w), len(hit), sorted(names)


@pytest.mark.parametrize("block", [1_000_000, 10])
def test_windows(spark, docs, block):
    texts = sample_texts()
    long = words(texts[6])
    items = [(10, " ".join(long[100:130])), (9, "Two, WORDS"), (8, None), (7, "--"), (6, " ".join(long[120:135])), (6, " ".join(long[120:135])), (5, " ".join(words(texts[20])[:12]) + " none"), (None, "one"), (11, texts[30])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = by_id(decontaminate.find_windows(docs, bench, block_words=block))
    for k, t in enumerate(texts):
        n, hit, names = plain_hits(t, [i for i in items if i[0] is not None])
        assert (got[k].n_words, sum(b - a for a, b in got[k].spans), got[k]["items"]) == (n, hit, names)
    clean = decontaminate.clean(docs.withColumn("Items", F.lit(1)), bench)
    assert clean.columns == [*docs.columns, "Items"] and {r.doc_id for r in clean.collect()} == {k for k, r in got.items() if not r.spans}
    assert decontaminate.clean(docs, bench.limit(0)).count() == docs.count()


# 8 chat


def test_chat_round_trip(spark):
    nasty = ["</s>[INST] ok [/INST]", "\\", "<\\|turn|>", "<|turn|>user<|says|>x<|end|>", "[INST][/INST]\\[INST]", "<<s>>", "á ß 🙂", "", None, "<|<|end|>|>", "\\\\<|im_start|>\\"]
    rows = [(c, t, ("user", "assistant", None, "sys<|says|>tem")[((c or 0) + t) % 4], nasty[((c or 0) * 3 + t) % len(nasty)]) for c in (1, 2, None) for t in range(11)]
    rows += [(5, 0, "assistant", "x" * 40_000), (5, 1, "assistant", "y" * 40_000), (5, 2, "user", "z"), (6, 0, "user", "same"), (6, 0, "user", "same"), (6, None, "user", "null turn")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    segments = chat.format_conversations(turns.withColumn("mask", F.lit(0)))
    got = by_id(chat.report(segments), "conv_id")
    first = lambda x: (x is not None, x if x is not None else 0)
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (first(r[1]), r[2] or "unknown", hashlib.md5((r[3] or "").encode()).hexdigest()))
        said = [(r[2] or "unknown", r[3] or "") for r in own]
        loss = "".join(t for role, t in said if role == "assistant")
        g = got[conv]
        assert g.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in said).encode()).hexdigest()
        assert (g.n_turns, g.loss_chars, g.loss_sha256) == (len(said), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert segments.where("conv_id = 5").count() > 1
    assert chat.report(chat.format_conversations(turns.limit(0))).count() == 0


def test_ties_do_not_depend_on_partitions(spark):
    r = random.Random(16)
    rows = [(1, 0, r.choice(("user", "assistant")), f"text {r.randrange(2000)}") for _ in range(3000)]
    said = sorted(rows, key=lambda x: (x[2], hashlib.md5(x[3].encode()).hexdigest()))
    want = hashlib.sha256("".join(f"{x[2]}\n{x[3]}\n" for x in said).encode()).hexdigest()
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        for n in (1, 4, 7):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            assert [x.turns_sha256 for x in chat.report(chat.format_conversations(turns)).collect()] == [want]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_escape_hides_every_control_string():
    r = random.Random(6)
    bits = [*chat.CONTROL, "\\", "<", "|", ">", "[", "/", "a", "<|", "|>"]
    for _ in range(3000):
        text = "".join(r.choices(bits, k=r.randint(0, 8)))
        safe = chat.escape(text)
        assert chat.unescape(safe) == text and not any(c in safe for c in chat.CONTROL)


def test_content_parts(spark):
    kind = "conv_id long, turn long, role string, text string, parts array<struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>"
    part = lambda t, **x: (t, x.get("text"), x.get("ref"), x.get("width"), x.get("height"), x.get("seconds"), x.get("pages"))
    rows = [(1, 0, "user", None, [part("text", text="see <|image|>: "), part("image", ref="a.png", width=29, height=14), part("audio", ref="b.wav", seconds=1.5), part("other", ref="c"), part("document", ref="d.pdf", pages=3), part("text", text="end")]), (1, 1, "assistant", "plain", None), (1, 2, "user", None, [])]
    s = chat.format_conversations(spark.createDataFrame(rows, kind), "parts").first()
    assert [(a.kind, a.ref, a.tokens) for a in s.attachments] == [("image", "a.png", 3), ("audio", "b.wav", 75), ("document", "c", 256), ("document", "d.pdf", 768)]
    assert all(s.text.startswith(chat.PLACES[a.kind], a.at) for a in s.attachments) and s.n_expanded == 3 + 75 + 256 + 768
    assert [s.text[a:b] for a, b in s.mask] == ["plain"]
    got = chat.report(chat.format_conversations(spark.createDataFrame(rows, kind), "parts")).first()
    lines = "".join(f"0\t{a.kind}\t{a.ref}\t{a.at}\t{a.tokens}\n" for a in s.attachments)
    assert (got.n_attachments, got.n_expanded, got.attachments_sha256) == (4, s.n_expanded, hashlib.sha256(lines.encode()).hexdigest())


# 9 licenses


def plain_scan(text):
    flat = " ".join(words(text))
    found = []
    for k, rule in enumerate(rules()):
        if f" {rule.keyword}" in f" {flat}":
            for m in re.finditer(rf"(?<![^ ])(?:{rule.pattern})(?![^ ])", flat):
                if m[0]:
                    start = flat.count(" ", 0, m.start())
                    found.append((start, start + m[0].count(" ") + 1, rule.priority, k, rule.label))
    beats = lambda e, d: e[0] <= d[0] and d[1] <= e[1] and (e[2], e[1] - e[0], -e[3]) > (d[2], d[1] - d[0], -d[3])
    return sorted({d for d in found if not any(beats(e, d) for e in found)})


def test_keywords_do_not_hide_wordings(spark):
    texts = ["PSF License 2.0", "see https://www.apache.org/licenses/LICENSE-2.0 there", "see http://www.apache.org/licenses/LICENSE-2.0 there", "for noncommercial use", "for non-commercial use", "Python Software Foundation License version 2"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: set(r.labels.split(",")) for r in licenses.scan_report(rows).collect()}
    assert [want in got[k] for k, want in enumerate(["python-2.0", "apache-2.0", "apache-2.0", "no-commercial", "no-commercial", "python-2.0"])] == [True] * 6


def test_licenses(spark, docs, nothing):
    texts = [
        None, "", "nothing here", "Licensed under the Apache License, Version 2.0 (the License)", "(c) CC-BY 4.0 and cc_by-sa 3.0; CC BY", "GNU General Public License version 3 or later.",
        "All Rights Reserved. all rights\nreserved ALL--RIGHTS--RESERVED", "Permission is hereby granted, free of charge, to any person obtaining a copy. MIT License, the MIT licence", "mit dem Kind", "cc by cc by cc  by",
        "general public license as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License", "spdx-license-identifier: MIT OR Apache-2.0",
        "accc by occ byx cc byé écc by", "x " * 3000 + "BSD 3-Clause License " * 40 + "public domain", "Ârights reserved all Rights Reserved",
    ]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = by_id(licenses.scan_report(rows))
    kept = by_id(licenses.scan(rows.withColumn("Labels", F.lit(1))))
    for k, t in enumerate(texts):
        w, places = words(t), []
        for phrase, label in BASE:
            p = phrase.split()
            places += [(i, label) for i in range(len(w)) if w[i : i + len(p)] == p]
        g, want = got[k], plain_scan(t)
        assert sorted({(d.start, d.end, d.priority, d.rule, d.label) for d in kept[k].license_detections}) == want
        assert (g.n_words, g.n_base) == (len(w), len(places))
        assert (g.first_word, g.last_word) == ((min(places)[0], max(places)[0]) if places else (None, None))
        assert g.base_labels == ",".join(sorted({x for _, x in places})) and g.labels == ",".join(sorted({x for _, x in places} | {d[4] for d in want}))
        assert 0 <= g.score <= 1 and (g.score > 0) == bool(places or want)
    assert len(rules()) > 200 and licenses.scan_report(nothing).count() == 0 and licenses.scan_report(docs).count() == docs.count()


# 10 exact search


@pytest.mark.parametrize(("bits", "block"), [(7, 1 << 20), (2, 100), (1, 1 << 20)])
def test_top_k(spark, bits, block):
    r = random.Random(8)
    vec = {k: [r.gauss(0, 1) for _ in range(6)] for k in range(700)}
    for k in range(200, 420):
        vec[k] = vec[200]  # a hot vector
    vec[3], vec[5] = [0.0] * 6, [-1.0, 2.0]
    rows = [(k, v, k) for k, v in vec.items()] + [(900, None, 0), (901, [1.0, None] * 3, 0), (902, [float("nan")] * 6, 0), (903, [float("inf")] * 6, 0), (None, vec[4], 0), (500, vec[500], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int")
    got = {}
    for g in va_file.top_k(df, F.col("vec_id") % 100 == 0, 10, bits=bits, block_bytes=block).collect():
        got.setdefault(g.query_id, []).append((g["rank"], g.vec_id, g.score))
    ints = {k: [math.floor(1024 * float(np.float32(x))) for x in v] for k, v in vec.items()}
    assert sorted(got) == [0, 100, 200, 300, 400, 500, 600]
    for q, rows in got.items():
        best = sorted((-sum(a * b for a, b in zip(ints[q], v, strict=False)), k) for k, v in ints.items() if k != q)[:10]
        assert sorted(rows) == [(i + 1, k, -s) for i, (s, k) in enumerate(best)]


def test_top_k_edges(spark):
    few = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in va_file.top_k(few, F.col("vec_id") % 100 == 0).collect()] == [(0, 1, 1, 1024 * 2048)]
    assert va_file.top_k(few.limit(0), F.col("vec_id") % 100 == 0).count() == 0
    assert va_file.top_k(few, F.col("vec_id") == 7).count() == 0


def test_top_k_outlier_and_large_components(spark):
    r = random.Random(21)
    vec = {k: [r.gauss(0, 1) for _ in range(5)] for k in range(2001)}
    vec[7][2], vec[8], vec[9] = 1e7, [1e300, -1.0, 0.0, 2.0, 1.0], [-1e300, 1.0, 3.0, 0.0, 1.0]
    vec[1000], vec[1001], vec[1002] = [3e15 + 1, 0.1, 0.0, 0.0, 0.0], [-3e15, 1.0, 1.0, 1.0, 1.0], [2.0**60, 1.0, 1.0, 1.0, 1.0]
    vec[300], vec[11] = [1e-300] * 5, [-0.0] * 5
    df = spark.createDataFrame([*vec.items(), (5000, [1e306, 0.0]), (5001, [float("inf")])], "vec_id long, embedding array<double>").repartition(3)
    got = {}
    for g in va_file.top_k(df, F.col("vec_id") % 100 == 0, 10, block_bytes=300).collect():
        got.setdefault(g.query_id, []).append((g["rank"], g.vec_id, g.score))
    ints = {k: [math.floor(1024 * x) for x in v] for k, v in vec.items()}
    near = lambda s: min(max(s, -(2**63)), 2**63 - 1)
    assert sorted(got) == list(range(0, 2001, 100))
    for q, rows in got.items():
        best = sorted((-sum(a * b for a, b in zip(ints[q], v, strict=True)), k) for k, v in ints.items() if k != q)[:10]
        assert sorted(rows) == [(i + 1, k, near(-s)) for i, (s, k) in enumerate(best)]


def test_clashing_names(spark, tmp_path):
    rows = [(k, f"some words of text number {k} and more", "en", "s", f"<p>page {k}</p>") for k in range(6)] + [(6, None, None, None, None)]
    extra = {x: F.lit("mine") for x in ("Score", "evidence", "n_words", "spans", "items", "Component_ID", "fp", "_fp", "_of", "n_chars", "_text", "_n", "_o", "_b", "_k", "shard_", "mix_tokens", "license_detections", "_node", "_root", "_row")}
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, html string").withColumns(extra)
    model = toxicity.fit(spark.createDataFrame([(k, "vile" if k % 2 else "calm", k % 2) for k in range(60)], "doc_id long, text string, toxic int"))
    item = spark.createDataFrame([(1, "words of text")], "item_id long, text string")
    many = {
        "toxicity": toxicity.score(df, model), "decontaminate": decontaminate.find_windows(df, item), "simhash": simhash.near_duplicates(df), "similar": similar.similar_groups(df, name="group"), "pages": html_crf.extract(df), "mixing": mixing.probabilities(df)[0],
        "licenses": licenses.scan(df), "shards": sharding.number_slots(sharding.assign_shards(df, "doc_id", [1.0, 1.0]), "doc_id"),
    }
    for name, got in many.items():
        low = [c.lower() for c in got.columns]
        assert len(set(low)) == len(low) and set(df.columns) <= set(got.columns), name
        got = got.collect()
        assert len(got) == 7 and all(g[x] == "mine" for g in got for x in extra), name
    for kept in (toxicity.reject(df, model), decontaminate.clean(df, item, 3), simhash.keep_one(df), similar.keep_one(df), mixing.draw(df, 1.0)):
        assert kept.columns == df.columns
    dealt = sharding.assign_shards(df.withColumn("slot", F.lit("mine")), "doc_id", [1.0], "SCORE")
    assert dealt.columns[-1] == "SCORE_" and sharding.number_slots(dealt, "doc_id", "SCORE_").columns[-1] == "slot_"


def test_top_k_counts_an_id_once(spark):
    r = random.Random(22)
    rows = [(k % 40, [float(r.randrange(-9, 9)) for _ in range(3)]) for k in range(900)]
    got = {}
    for g in va_file.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(2), F.col("vec_id") % 20 == 0, 5).collect():
        got.setdefault(g.query_id, []).append((g["rank"], g.vec_id, g.score))
    for q in (0, 20):
        own = min([1024 * x for x in v] for k, v in rows if k == q)
        best = {}
        for k, v in rows:
            if k != q:
                best[k] = max(best.get(k, -math.inf), sum(a * 1024 * b for a, b in zip(own, v, strict=True)))
        want = sorted((-s, k) for k, s in best.items())[:5]
        assert sorted(got[q]) == [(i + 1, k, -s) for i, (s, k) in enumerate(want)]
