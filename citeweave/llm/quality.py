"""Document quality by a small byte-level convolutional network in numpy.

FILTERS learned filters of WIDTH bytes slide over every byte of a text. What they answer is
max-pooled over chunks of CHUNK segments of SEGMENT bytes that overlap by half and cover the
whole text, the last one ending where the text ends. A hidden layer judges each chunk, its
answers are max-pooled over the chunks, and a logistic of these is the probability of label
1. A filter's answer is a sum of one table entry for each byte under it, so that convolving is
gathering; for scoring, tables of two neighbouring bytes are made, and the model is
broadcast (FILTERS * WIDTH * 128 KB, whatever the data).

The network is fitted on the driver by gradient descent (Adam, fixed seeds) on a bounded sample:
of each class the labelled documents of least hash, SAMPLE at most, of texts of MOST_BYTES
bytes at most, together SAMPLE_BYTES. Losses are weighed by the classes' shares among all
labelled rows that may be learned from, so that scores are not shifted by the sample's.
All documents are scored whole, whatever their length.

Nulls: a null text is empty; a null label or doc_id teaches nothing. An empty text has one
chunk of zero bytes and the score that the network gives it. Ties: a doc_id labelled both ways
is of quality 0; equal texts have equal scores. Repeated rows are scored each. Where a class has no
labelled document, every score is the share of label 1, or 0.5 without any label. An empty
table gives an empty one. Columns of the documents other than doc_id and text are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citeweave.llm.common import give_back, keyed, unkeyed
from citeweave.session import materialize

WIDTH, FILTERS, HIDDEN = 6, 32, 16
#: Bytes of a segment; segments of a chunk, and from one chunk to the next.
SEGMENT, CHUNK, STEP = 64, 4, 2
#: Bounds of the sample: documents of a class, bytes of a text, bytes of a class's texts.
SAMPLE, MOST_BYTES, SAMPLE_BYTES = 2000, 32 << 10, 6 << 20
EPOCHS, LEAST_STEPS, BATCH, RATE, DECAY = 6, 400, 32, 0.01, 1e-4
THRESHOLD = 0.3
#: Segments whose answers a task holds at once (FILTERS floats for each byte).
BLOCK = 1 << 11


class Layout:
    """Texts laid out in whole segments, their chunks, and which windows lie within a text."""

    def __init__(self, texts: list[bytes]):
        sizes = np.array([len(t) for t in texts], np.int64)
        self.segments = -(-np.maximum(sizes, 1) // SEGMENT)
        ends = np.cumsum(self.segments)
        self.first = ends - self.segments
        self.data = np.zeros(int(ends[-1]) * SEGMENT + WIDTH, np.uint8)
        for text, at in zip(texts, (self.first * SEGMENT).tolist(), strict=True):
            self.data[at : at + len(text)] = np.frombuffer(text, np.uint8)
        self.windows = np.maximum(sizes - WIDTH + 1, 1)
        # Chunks: of each text every STEP segments, and one that ends with the text.
        n = 1 + -(-np.maximum(self.segments - CHUNK, 0) // STEP)
        self.text = np.repeat(np.arange(len(texts)), n)
        self.begins = np.cumsum(n) - n
        place = np.arange(len(self.text)) - self.begins[self.text]
        low = np.minimum(place * STEP, np.maximum(self.segments[self.text] - CHUNK, 0))
        high = np.minimum(low + CHUNK, self.segments[self.text]) - 1
        self.members = self.first[self.text, None] + np.minimum(low[:, None] + np.arange(CHUNK), high[:, None])
        of = np.clip(self.windows[self.text] - low * SEGMENT, 1, CHUNK * SEGMENT)
        #: How full each chunk is, plainly and in octaves.
        self.full = np.stack([of / (CHUNK * SEGMENT), np.log2(of) / np.log2(CHUNK * SEGMENT)], 1).astype(np.float32)

        # Places whose window isn't within a text, in order.
        tails = self.segments * SEGMENT - self.windows
        ends = np.cumsum(tails)
        self.outside = np.repeat(self.first * SEGMENT + self.windows - (ends - tails), tails) + np.arange(ends[-1])


class Network:
    """tables[k, byte, filter], then bias of filters, hidden layer and output."""

    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        self.tables = r.normal(0, 0.5, (WIDTH, 256, FILTERS)).astype(np.float32)
        self.bias = np.zeros(FILTERS, np.float32)
        self.hidden = r.normal(0, 0.15, (FILTERS + 2, HIDDEN)).astype(np.float32)
        self.hidden_bias = np.full(HIDDEN, 0.1, np.float32)
        self.out = r.normal(0, 0.3, HIDDEN).astype(np.float32)
        self.out_bias = np.zeros(1, np.float32)

    def parameters(self) -> list[np.ndarray]:
        return [self.tables, self.bias, self.hidden, self.hidden_bias, self.out, self.out_bias]

    def judged(self, pooled: np.ndarray, full: np.ndarray, begins: np.ndarray):
        """(inputs, hidden answers, their maxima over each text's chunks, logits)."""
        inputs = np.concatenate([np.maximum(pooled + self.bias, 0), full], 1)
        hidden = np.maximum(inputs @ self.hidden + self.hidden_bias, 0)
        most = np.maximum.reduceat(hidden, begins)
        return inputs, hidden, most, most @ self.out + self.out_bias[0]

    def train_step(self, lay: Layout, label: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
        """Gradients of the mean weighed loss, in the order of the parameters."""
        n = len(lay.data) - WIDTH
        data = lay.data.astype(np.int64)
        answers = self.tables[0][data[:n]]
        for k in range(1, WIDTH):
            answers += self.tables[k][data[k : k + n]]
        answers[lay.outside] = -np.inf
        folded = answers.reshape(-1, SEGMENT, FILTERS)
        best = folded.argmax(1)
        segment = np.take_along_axis(folded, best[:, None], 1)[:, 0]
        of = segment[lay.members]
        which = of.argmax(1)
        pooled = np.take_along_axis(of, which[:, None], 1)[:, 0]
        inputs, hidden, most, logit = self.judged(pooled, lay.full, lay.begins)
        loss = weight * (1 / (1 + np.exp(-logit)) - label) / len(label)
        d_out, d_out_bias = loss @ most, np.array([loss.sum()])
        # The gradient of a maximum goes to the first chunk that reaches it.
        ties = hidden == most[lay.text]
        counted = np.cumsum(ties, 0)
        first = ties & (counted - (counted[lay.begins] - ties[lay.begins])[lay.text] == 1)
        d_hidden = np.where(first & (hidden > 0), (loss[:, None] * self.out)[lay.text], 0)
        d_weights, d_hidden_bias = inputs.T @ d_hidden, d_hidden.sum(0)
        d_pooled = np.where(inputs[:, :FILTERS] > 0, d_hidden @ self.hidden[:FILTERS].T, 0)
        chosen = np.take_along_axis(lay.members, which, 1)
        place = chosen * SEGMENT + best[chosen, np.arange(FILTERS)]
        d_tables = np.empty_like(self.tables)
        for k in range(WIDTH):
            cell = data[place + k] * FILTERS + np.arange(FILTERS)
            d_tables[k] = np.bincount(cell.ravel(), d_pooled.ravel(), 256 * FILTERS).reshape(256, FILTERS)
        return [d_tables, d_pooled.sum(0), d_weights, d_hidden_bias, d_out, d_out_bias]

    def fit(self, texts: list[bytes], label: np.ndarray, weight: np.ndarray, seed: int = 11) -> Network:
        r = np.random.default_rng(seed)
        params = self.parameters()
        mean, square = ([np.zeros_like(p) for p in params] for _ in range(2))
        steps = max(LEAST_STEPS, EPOCHS * -(-len(texts) // BATCH))
        order, at = r.permutation(len(texts)), 0
        for step in range(1, steps + 1):
            if at >= len(order):
                order, at = r.permutation(len(texts)), 0
            take = order[at : at + BATCH]
            at += BATCH
            grads = self.train_step(Layout([texts[i] for i in take]), label[take], weight[take])
            rate = RATE * (1 - (step - 1) / steps)
            for p, g, m, s in zip(params, grads, mean, square, strict=True):
                g = g.astype(np.float32) + DECAY * p
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
        return self

    def paired(self) -> np.ndarray:
        """Tables of two neighbouring bytes: [pair of the window, first byte * 256 + second, filter]."""
        first, second = self.tables[0::2], self.tables[1::2]
        return (first[:, :, None] + second[:, None]).reshape(WIDTH // 2, 1 << 16, FILTERS)

    def score(self, texts: list[bytes], pairs: np.ndarray) -> np.ndarray:
        """Probabilities of label 1; the answers of BLOCK segments are held at a time."""
        lay = Layout(texts)
        total = int(lay.segments.sum())
        segment = np.empty((total, FILTERS), np.float32)
        answers, more = (np.empty((min(BLOCK, total) * SEGMENT, FILTERS), np.float32) for _ in range(2))
        for low in range(0, total, BLOCK):
            n = (min(low + BLOCK, total) - low) * SEGMENT
            at = low * SEGMENT
            a, b = answers[:n], more[:n]
            data = lay.data[at : at + n + WIDTH].astype(np.intp)
            codes = data[:-1] << 8 | data[1:]
            np.take(pairs[0], codes[:n], 0, a, "clip")
            for k in range(1, WIDTH // 2):
                np.take(pairs[k], codes[2 * k : 2 * k + n], 0, b, "clip")
                a += b
            a[lay.outside[slice(*np.searchsorted(lay.outside, (at, at + n)))] - at] = -np.inf
            a = a.reshape(-1, SEGMENT, FILTERS)
            while a.shape[1] > 1:
                half = a.shape[1] // 2
                a = np.maximum(a[:, :half], a[:, half:], out=a[:, :half])
            segment[low : low + n // SEGMENT] = a[:, 0]
        pooled = segment[lay.members[:, 0]]
        for j in range(1, CHUNK):
            np.maximum(pooled, segment[lay.members[:, j]], out=pooled)
        logit = self.judged(pooled, lay.full, lay.begins)[3].astype(np.float64)
        return 1 / (1 + np.exp(-logit))


class Model:
    """The network, or None where a class has no example, and the share of label 1."""

    def __init__(self, network: Network | None, share: float):
        self.network, self.share = network, share


def sampled(docs: DataFrame, labels: DataFrame, learn: Column) -> tuple[DataFrame, dict[int, int]]:
    """(quality, text as bytes) of the bounded sample, and how many labelled rows may be learned from, by class."""
    rows = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & learn)
    rows = rows.groupBy(F.col("doc_id").cast("long").alias("_key")).agg(F.min("quality").cast("int").alias("quality"))
    rows = materialize(rows.withColumn("h", F.xxhash64("_key")), "labels")
    counts = {r.quality: r["count"] for r in rows.groupBy("quality").count().collect()}
    chosen = None
    for q in (0, 1):
        some = rows.where(F.col("quality") == q).orderBy("h", "_key").limit(SAMPLE)
        chosen = some if chosen is None else chosen.unionAll(some)
    texts = keyed(docs.select("doc_id", F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text")), "text")
    # The chosen labels are 2 * SAMPLE rows at most. Of rows that repeat an id the least text is taken.
    texts = texts.where(F.octet_length("text") <= MOST_BYTES).join(F.broadcast(chosen), "_key").groupBy("_key", "quality", "h").agg(F.min("text").alias("text"))
    texts = materialize(texts, "sample", 2 * SAMPLE)
    so_far = F.sum(F.octet_length("text")).over(Window.partitionBy("quality").orderBy("h", "_key"))  # of the sample alone
    return texts.withColumn("so_far", so_far).where(F.col("so_far") <= SAMPLE_BYTES).orderBy("quality", "so_far").select("quality", "text"), counts


def fit(docs: DataFrame, labels: DataFrame, learn: Column) -> Model:
    """Learns from the labelled documents where ``learn``, a condition on ``labels``, holds."""
    rows, counts = sampled(docs, labels, learn)
    rows = rows.collect()
    total = counts.get(0, 0) + counts.get(1, 0)
    share = counts.get(1, 0) / total if total else 0.5
    label = np.array([r.quality for r in rows], np.float32)
    n = [int((label == q).sum()) for q in (0, 1)]
    if not all(n):
        return Model(None, share)
    weight = np.array([counts[r.quality] / n[r.quality] for r in rows], np.float32)
    return Model(Network().fit([bytes(r.text) for r in rows], label, weight / weight.mean()), share)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Per document: doc_id, score (the probability of label 1), predicted (1 from THRESHOLD on)."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = held.value.network
        pairs = network.paired() if network else None

        def scored(texts: list[bytes]) -> np.ndarray:
            return network.score(texts, pairs) if network else np.full(len(texts), held.value.share)

        for batch in batches:
            out, waiting, size = [], [], 0
            for text in batch.column("text"):
                waiting.append(text.as_py() or b"")
                size += len(waiting[-1])
                if size >= BLOCK * SEGMENT:
                    out.append(scored(waiting))
                    waiting, size = [], 0
            if waiting:
                out.append(scored(waiting))
            if out:
                found = np.concatenate(out)
                yield pa.RecordBatch.from_arrays([batch.column("_key"), pa.array(found), pa.array((found >= THRESHOLD).astype(np.int32))], ["_key", "score", "predicted"])
        give_back()

    texts = keyed(docs.select("doc_id", F.col("text").cast("binary").alias("text")), "text")
    return unkeyed(texts.mapInArrow(run, "_key long, score double, predicted int"))
