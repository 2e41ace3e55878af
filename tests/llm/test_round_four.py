"""What the fourth round's findings found."""

from __future__ import annotations

from labeldiff.llm import bitplane, toxicity


def test_features_that_no_labelled_text_has(spark):
    """``abcd*`` tells the labels apart, but every labelled word has a better feature, so its list of postings is empty."""
    texts = [("abcdefgh plain" if k < 150 else "other words", 1) for k in range(200)] + [("abcdzzzz plain" if k < 80 else "other words", 0) for k in range(200)]
    labelled = spark.createDataFrame([(k, t, y) for k, (t, y) in enumerate(texts)], "doc_id long, text string, toxic int")
    model = toxicity.fit(labelled)
    unused = model.features(b"abcdyyyy")
    assert len(unused) == 1 and not model.index.top[unused[0][0]].any()
    docs = spark.createDataFrame([(1, "abcdyyyy"), (2, "nothing known"), (3, "abcdyyyy abcdefgh"), (4, "abcdefgh"), (5, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert got[1].score == got[2].score == got[5].score and got[1].evidence == []
    assert got[3].score == got[4].score > 0.7


def test_only_texts_without_features_are_labelled():
    """An index without a single block."""
    import numpy as np

    index = toxicity.Index([((), 3, 1, 7)], np.ones(2))
    assert index.vote(((0, 1),), 5) == (0.25, [])


def test_a_worker_keeps_its_encoder():
    """op1: each task loaded the vocabulary and learnt the words of its texts anew."""
    import public_tokenizers
    import pyarrow as pa

    path = public_tokenizers.path("word_bpe_49k.json")
    one = bitplane.encoder_of(path, True)
    ids, counts = one(pa.array(["some words", ""]))
    assert bitplane.encoder_of(path, True) is one and {"some", "words"} <= set(one.index)
    again, same = one(pa.array(["some words", ""]))
    assert ids.tolist() == again.tolist() and counts.tolist() == same.tolist() and bitplane.encoder_of(path, False) is not one
