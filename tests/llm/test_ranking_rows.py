"""The ranking of op5 learns from every labelled row."""

import numpy as np

from coldspring.llm import pairwise_quality


def test_all_labelled_rows_take_part(spark):
    draw = np.random.default_rng(2)
    texts = [" ".join("word" if draw.random() < 0.7 else "| #" for _ in range(draw.integers(1, 9))) for _ in range(7000)]
    good = [text.count("word") > 3 for text in texts]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(g)) for i, g in enumerate(good)], "doc_id long, quality int")
    model = pairwise_quality.learn_ranking(docs, labels)
    x = pairwise_quality.doc_features([t.encode() for t in texts])
    np.testing.assert_allclose(model.mean, x.mean(axis=0), atol=1e-9)
    np.testing.assert_allclose(model.scale, np.where(x.std(axis=0) > 1e-9, x.std(axis=0), 1.0), atol=1e-9)
    raw, at = np.sort(model.raw(x)), 7000 - sum(good)
    assert abs(model.cut - (raw[at - 1] + raw[at]) / 2) < 1e-9
    shuffled = pairwise_quality.learn_ranking(docs.orderBy("text"), labels, pairwise_quality.PairConfig(broadcast_labels=0))
    np.testing.assert_allclose(shuffled.weight, model.weight, rtol=1e-5, atol=1e-6)
