import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from citeweave.llm import quality
from citeweave.llm.queries import op11_quality

SF = "/root/testdata/sf0.01"


def brute(network, text):
    """The network's answer window by window, chunk by chunk."""
    data = text + bytes(max(0, quality.WIDTH - len(text)))
    windows = max(len(text) - quality.WIDTH + 1, 1)
    answers = np.array([sum(network.tables[k, data[i + k]].astype(float) for k in range(quality.WIDTH)) for i in range(windows)])
    segments = -(-max(len(text), 1) // quality.SEGMENT)
    last = max(0, segments - quality.CHUNK)
    most = np.full(quality.HIDDEN, -np.inf)
    for low in [*range(0, last, quality.STEP), last]:
        part = answers[low * quality.SEGMENT : (low + quality.CHUNK) * quality.SEGMENT]
        full = len(part) / (quality.CHUNK * quality.SEGMENT)
        inputs = np.concatenate([np.maximum(part.max(0) + network.bias, 0), [full, 1 + np.log2(full) / np.log2(quality.CHUNK * quality.SEGMENT)]])
        most = np.maximum(most, np.maximum(inputs @ network.hidden + network.hidden_bias, 0))
    return 1 / (1 + np.exp(-(most @ network.out + network.out_bias[0])))


@pytest.fixture(scope="module")
def network():
    return quality.Network(3)


def texts_of(r, sizes):
    return [bytes(r.randrange(256) for _ in range(n)) for n in sizes]


@pytest.mark.parametrize("block", [quality.BLOCK, 3])
def test_scores_are_the_networks(network, monkeypatch, block):
    monkeypatch.setattr(quality, "BLOCK", block)
    texts = texts_of(random.Random(1), [0, 1, 5, 6, 7, 63, 64, 65, 66, 69, 70, 255, 256, 257, 261, 300, 384, 385, 500, 2000, 64, 0])
    got = network.score(texts, network.paired())
    assert np.allclose(got, [brute(network, t) for t in texts], atol=1e-5)
    assert np.allclose(got, np.concatenate([network.score([t], network.paired()) for t in texts]), atol=1e-6)


def test_gradients_are_those_of_the_loss(network):
    r = random.Random(2)
    texts, label, weight = texts_of(r, [3, 80, 700]), np.array([0, 1, 0], np.float32), np.array([1, 0.5, 2], np.float32)
    grads = network.train_step(quality.Layout(texts), label, weight)

    def loss():
        p = np.array([brute(network, t) for t in texts])
        return (-weight * np.where(label, np.log(p), np.log(1 - p))).mean()

    for p, g in zip(network.parameters(), grads, strict=True):
        for at in [np.unravel_index(i, p.shape) for i in np.argsort(-abs(g), None)[:3]]:
            was, step = p[at], 2e-3
            p[at] = was + step
            high = loss()
            p[at] = was - step
            low = loss()
            p[at] = was
            assert abs((high - low) / (2 * step) - g[at]) < 0.05 * abs(g[at]) + 1e-3


def test_every_part_of_a_text_counts(network):
    """A chunk anywhere in the text reaches the score: each place is within a chunk."""
    lay = quality.Layout([bytes(n) for n in (0, 1, 64, 257, 1000, 4096, 4097)])
    for i, n in enumerate(lay.segments):
        own = np.unique(lay.members[lay.text == i]) - lay.first[i]
        assert own.tolist() == list(range(n))


def test_held_out_accuracy(spark):
    rows = spark.read.parquet(f"{SF}/labels.parquet").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    full = op11_quality(spark, SF)
    got = full.join(rows, "doc_id").select("doc_id", "held_out", "score", "predicted", "quality").collect()
    assert all(x.held_out == (zlib.crc32(str(x.doc_id).encode()) % 5 == 0) and x.predicted == (x.score >= 0.3) for x in got)
    good, bad = ([x.score for x in got if x.held_out and x.quality == q] for q in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) >= 0.97
    assert np.mean([g >= 0.3 for g in good]) >= 0.97 and np.mean([b < 0.3 for b in bad]) >= 0.6


def test_odd_tables(odd, docs_of, spark):
    labels = spark.createDataFrame([(5, 1, 0), (5, 0, 0), (6, 1, 0), (8, 0, 0), (None, 1, 1), (12, None, 1)], "doc_id long, quality int, toxic int")
    rows, counts = quality.sampled(odd, labels, F.lit(True))
    assert counts == {0: 2, 1: 1} and sorted((r.quality, bytes(r.text)) for r in rows.collect()) == [(0, b""), (0, b"same text here"), (1, b"same text here")]
    got = quality.score(odd, quality.fit(odd, labels, F.lit(True))).collect()
    assert len(got) == 10 and all(0 <= r.score <= 1 for r in got)
    one = quality.fit(odd, labels, F.col("doc_id") == 6)
    assert {r.score for r in quality.score(odd, one).collect()} == {1.0}
    assert {r.score for r in quality.score(odd, quality.fit(odd, labels, F.lit(False))).collect()} == {0.5}
    assert quality.score(docs_of([]), one).count() == 0
