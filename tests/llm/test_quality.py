import zlib

import numpy as np
import pyarrow as pa
import pytest

from lumbre.llm import quality as Q
from lumbre.llm.query_quality import held_out, op1_quality


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = op1_quality(spark, folder).collect()
    assert len(rows) == 1000
    right = []
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
        if r.held_out and r.doc_id in labels:
            right.append(r.predicted == labels[r.doc_id])
    assert len(right) > 100 and np.mean(right) > 0.97


def test_labels_of_held_out_rows_do_not_matter(spark, documents):
    ids = [r.doc_id for r in documents.select("doc_id").collect()]
    own = [(i, int(k % 3 > 0)) for k, i in enumerate(ids)]
    other = [(i, 1 - y if zlib.crc32(str(i).encode()) % 3 == 1 else y) for i, y in own]
    fits = []
    for rows in (own, other):
        labelled = spark.createDataFrame(rows, "doc_id long, label int").where(~held_out())
        fits.append(Q.fit(documents, labelled, rows=40).weights)
    assert all((fits[0][k] == fits[1][k]).all() for k in fits[0])


def test_gradients_as_by_differences():
    network = Q.Network.new(3)
    network.weights = {k: v.astype(np.float64) for k, v in network.weights.items()}
    texts = pa.array(["some words here", "!!! ??? !!! ???", "x" * 5000 + "end", ""])
    labels, weight = np.array([1.0, 0, 1, 1]), np.array([1.0, 2, 1, 1])
    laid = Q._layout(*Q.utf8(texts))

    def loss():
        p = network.combine(network.pooled(*laid[:3]), laid[3], 4)[2]
        return -(weight * np.where(labels == 1, np.log(p), np.log(1 - p))).sum() / weight.sum()

    grads = network.step(*laid, labels, weight)
    rng = np.random.default_rng(1)
    for name, grad in grads.items():
        flat, g = network.weights[name].reshape(-1), grad.reshape(-1)
        for k in rng.choice(len(flat), min(6, len(flat)), replace=False):
            keep = flat[k]
            flat[k] = keep + 1e-3
            up = loss()
            flat[k] = keep - 1e-3
            down = loss()
            flat[k] = keep
            assert abs((up - down) / 2e-3 - g[k]) < 2e-3 + 0.05 * abs(g[k]), (name, k)


def test_every_byte_counts_whatever_its_place():
    network = Q.Network.new(1)
    plain = "word " * 4000
    scores = network.scores(pa.array([plain, *(plain[:k] + "#@#@#@#@#@#@#@#@#@#@" + plain[k:] for k in (0, 4090, 9999, 20000))]))
    assert len(set(scores.round(6).tolist())) > 1 and (scores[1:] != scores[0]).all()


def test_odd_and_empty_tables(odd, none):
    network = Q.Network.new(2)
    rows = Q.score(odd, network).collect()
    empty = {r.score for r in rows if r.id in (1, 2)}
    assert len(rows) == odd.count() and len(empty) == 1
    assert len({r.score for r in rows if r.id == 5}) == 1
    assert Q.score(none, network).count() == 0
    assert Q.passing(odd, network, least=0.0).columns == odd.columns
    assert Q.passing(odd, network, least=0.0).count() == odd.count()
    with pytest.raises(ValueError):
        Q.fit_arrays(pa.array(["a", "b"]), np.array([1, 1]))
