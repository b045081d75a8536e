"""Toxicity by class-conditional Kneser-Ney models.

Two bigram models, of toxic and of ordinary documents, are interpolated down to their
continuation distributions, and these to one that both share: how many different words
stand before a word in the whole corpus, labelled or not. That is counted for every word of
all documents, without a cap: the contexts of a word are told apart by 48 bits of their hashes. Words that are frequent in the
labelled sample are split by their contexts' hashes, so that no word is one task's. A document's score is a logistic of one
length-normalised comparison of the classes' log-likelihoods, of its words in their contexts: each word's ratio, less
that of a word never met, is weighed by the evidence that the sample has for the word, in nats, and where it speaks for the
ordinary class it counts as that of a word never met. Without that, the many words that few ordinary documents and no
toxic one has are all that a mean of ratios sees (README has the figures).

Words are 64-bit hashes. Class counts come from MAX_LABELLED labelled documents at most,
those of least hash, of texts of MAX_BYTES bytes at most; an expression counts once a document, and every bigram is kept. One
labelled document in CALIBRATE is left out of the counts and fits the logistic. The driver
and the tasks hold what the labelled sample has: 12 bytes for each of its bigrams, words and
contexts. Of a word that no labelled document has, both classes have the same share of the
shared distribution, so that its ratio is a constant and the corpus' table of words needn't
leave Spark.

Nulls: a null text or label is empty, or teaches nothing; a document without words has
the score of a ratio of 0. Ties: a doc_id labelled both ways is toxic. Repeated rows count
and are scored each. With no labelled toxic or no ordinary document, all score 0; where
only the documents left out lack a class, the comparison is weighed by PLAIN and the
labels' odds. Texts of any length are scored whole, block by block. Columns of ``docs`` other
than doc_id and text are never read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeweave.llm.common import Emitter, give_back, keyed, mix, rows_of, text_of, unkeyed, word_hashes
from citeweave.session import materialize

MAX_LABELLED, MAX_BYTES, CALIBRATE = 40_000, 1 << 20, 5
#: Nats of evidence below which a word's ratio counts nothing, and at which it counts by half; the least mean ratio told from none.
LEAST_EVIDENCE, EVIDENCE, LEAST_EXCESS = 2.0, 10.0, 1e-3
THRESHOLD = 0.3
#: Weight of the comparison where no logistic can be fitted.
PLAIN = 1.0
#: The context of a text's first word.
START = np.uint64(0x5851F42D4C957F2D)
#: Words whose contexts a task tells apart at once, and frequent words that are split by their contexts, into 64.
CHUNK_WORDS, HOT = 3_000_000, 4096
_CLASSES = ("t", "o")
#: Bits of a key below those by which it is dealt: there are 64 parts.
_PART = np.uint64(58)
#: Separators: every ASCII byte that is no letter, digit or apostrophe.
_GAPS = np.array([c < 128 and not (chr(c).isalnum() or c == 39) for c in range(256)])


def words_of(text: str) -> np.ndarray:
    """Hashes of the text's lower-cased words, in order."""
    return word_hashes(text.lower().encode("utf-8", "surrogatepass"), _GAPS)


def contexts(words: np.ndarray) -> np.ndarray:
    """The word before each word; START at a text's beginning."""
    return np.concatenate([[START], words[:-1]]) if len(words) else words


def pair_keys(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    """One 64-bit key for each bigram v w; its first bits are v's, by which bigrams are dealt."""
    return ((v >> _PART) << _PART) | (mix(mix(v) + w) >> np.uint64(6))


def _distinct(w: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different pairs, by w."""
    order = np.lexsort((v, w))
    w, v = w[order], v[order]
    new = np.concatenate([[True], (w[1:] != w[:-1]) | (v[1:] != v[:-1])])
    return w[new], v[new]


def sampled(labels: DataFrame, learn: Column, most: int = MAX_LABELLED) -> DataFrame:
    """(_id, toxic, left_out) of ``most`` labelled documents at most, those of least hash."""
    rows = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & learn)
    rows = rows.groupBy(F.col("doc_id").cast("long").alias("_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    rows = rows.orderBy(F.xxhash64("_id"), "_id").limit(most)
    return materialize(rows.withColumn("left_out", F.pmod(F.xxhash64("_id", F.lit(1)), F.lit(CALIBRATE)) == 0), "labels", most)


def labelled(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """(_key, text, toxic, left_out) of the sample's documents; the sample has MAX_LABELLED rows at most."""
    return keyed(docs, "text").where(F.coalesce(F.octet_length("text"), F.lit(0)) <= MAX_BYTES).join(F.broadcast(sample.withColumnRenamed("_id", "_key")), "_key")


def class_counts(rows: DataFrame) -> DataFrame:
    """(p, v, w, t, o): in how many toxic and ordinary documents v w stands; p is the part of v, in one partition each."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting, held = [], 0

        def counted() -> pd.DataFrame:
            w, v, t = (np.concatenate(x) for x in zip(*waiting, strict=True))
            order = np.lexsort((w, v))
            w, v, t = w[order], v[order], t[order]
            first = np.flatnonzero(np.concatenate([[True], (w[1:] != w[:-1]) | (v[1:] != v[:-1])]))
            n, toxic = np.diff(np.append(first, len(w))), np.add.reduceat(t, first)
            return pd.DataFrame({"p": (v[first] >> _PART).astype(np.int32), "v": v[first].view(np.int64), "w": w[first].view(np.int64), "t": toxic, "o": (n - toxic).astype(np.int32)})

        for text, toxic in rows_of(batches, "text", "toxic"):
            own = words_of(text_of(text))
            if len(own):
                w, v = _distinct(own, contexts(own))
                waiting.append((w, v, np.full(len(w), int(toxic > 0), np.int32)))
                held += len(w)
                if held > CHUNK_WORDS // 2:
                    yield counted()
                    waiting, held = [], 0
        if held:
            yield counted()
        give_back()

    found = rows.where("NOT left_out").select("text", "toxic").mapInPandas(run, "p int, v long, w long, t int, o int").repartition("p")
    return found.groupBy("p", "v", "w").agg(F.sum("t").cast("int").alias("t"), F.sum("o").cast("int").alias("o"))


def known_words(counts: DataFrame) -> np.ndarray:
    """The words of the labelled sample, in order."""
    return np.sort(counts.select("w").distinct().toArrow().column("w").to_numpy().view(np.uint64))


def frequent(counts: DataFrame, most: int = HOT) -> np.ndarray:
    """The words that most of the sample's documents have, in order."""
    rows = counts.groupBy("w").agg(F.sum(F.col("t") + F.col("o")).alias("n")).orderBy(F.desc("n"), "w").limit(most)
    return np.sort(np.array([r.w for r in rows.collect()], np.int64).view(np.uint64))


def _varints(values: np.ndarray) -> bytes:
    """Whole numbers, seven bits a byte, the lowest first."""
    left, out, at = values.astype(np.uint64), [], np.arange(len(values))
    while len(left):
        more = left > 127
        out.append((at, (left & np.uint64(127)).astype(np.uint8) | np.where(more, 128, 0).astype(np.uint8)))
        left, at = left[more] >> np.uint64(7), at[more]
    if not out:
        return b""
    place = np.concatenate([x for x, _ in out])
    return np.concatenate([y for _, y in out])[np.argsort(place, kind="stable")].tobytes()


def _unvarints(data: np.ndarray) -> np.ndarray:
    ends = np.flatnonzero(data < 128)
    starts = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
    place = np.arange(len(data)) - np.repeat(starts, ends - starts + 1)
    return np.add.reduceat((data & 127).astype(np.int64) << (7 * place), starts) if len(ends) else ends.astype(np.int64)


def corpus_contexts(docs: DataFrame, words: np.ndarray, hot: np.ndarray | None = None) -> DataFrame:
    """(w, n): how many different words stand before w in all documents, for each of ``words``; a text's beginning is one.

    A word among ``hot`` has a row for each part of its contexts. Rows without a word count all others' contexts together.
    Tasks hand on buckets of packed numbers: words' places in ``words``, one byte mostly, and six bytes of a context's hash.
    """
    import pyarrow as pa

    session = docs.sparkSession
    buckets = max(64, int(session.conf.get("spark.sql.shuffle.partitions")))
    held = session.sparkContext.broadcast((words, np.zeros(0, np.uint64) if hot is None else hot))

    def packed(w: np.ndarray, h: np.ndarray) -> Iterator[pa.RecordBatch]:
        words, hot = held.value
        w, h = _distinct(w, h)
        at = np.searchsorted(words, w)
        known = words[np.minimum(at, len(words) - 1)] == w if len(words) else np.zeros(len(w), bool)
        split = hot[np.minimum(np.searchsorted(hot, w), len(hot) - 1)] == w if len(hot) else np.zeros(len(w), bool)
        pair = mix(mix(w) + h)
        bucket = (np.where(known & ~split, mix(w), pair) >> np.uint64(32)) % np.uint64(buckets)
        rows = []
        for mine in (known, ~known):
            order = np.flatnonzero(mine)
            order = order[np.argsort(bucket[order], kind="stable")]
            edges = np.searchsorted(bucket[order], np.arange(buckets + 1, dtype=np.uint64)).tolist()
            hashes = np.ascontiguousarray((h if mine is known else pair & np.uint64(2**48 - 1))[order].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6])
            for b, (low, high) in enumerate(zip(edges, edges[1:], strict=False)):
                if low < high:
                    places = _varints(np.diff(at[order[low:high]], prepend=0)) if mine is known else None
                    rows.append((b, places, hashes[low:high].tobytes()))
        for low in range(0, len(rows), 200):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[low : low + 200], strict=True), (pa.int32(), pa.binary(), pa.binary()), strict=True)], names=["bucket", "places", "hashes"])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size = [], 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                own = words_of(text_of(text))
                if len(own):
                    waiting.append((own, mix(contexts(own)) >> np.uint64(16)))
                    size += len(own)
                    if size > CHUNK_WORDS:
                        yield from packed(*(np.concatenate(x) for x in zip(*waiting, strict=True)))
                        waiting, size = [], 0
        if waiting:
            yield from packed(*(np.concatenate(x) for x in zip(*waiting, strict=True)))
        give_back()

    def hashes_of(data: pa.Scalar) -> np.ndarray:
        out = np.zeros((len(data.as_py()) // 6, 8), np.uint8)
        out[:, :6] = np.frombuffer(data.as_py(), np.uint8).reshape(-1, 6)
        return out.view("<u8").ravel()

    def counted(known: list, others: list) -> pa.RecordBatch:
        """One bucket: its different contexts by word, and of all other words together."""
        at, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if known:
            at, h = (np.concatenate(x) for x in zip(*known, strict=True))
            at, n = np.unique(_distinct(at.astype(np.uint64), h)[0], return_counts=True)
        rest = len(np.unique(np.concatenate(others))) if others else 0
        w = pa.concat_arrays([pa.array(held.value[0][at.astype(np.int64)].view(np.int64)), pa.array([None], pa.int64())])
        return pa.RecordBatch.from_arrays([w, pa.array(np.append(n, rest).astype(float))], names=["w", "n"])

    def union(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, known, others = None, [], []
        for batch in batches:  # sorted by bucket
            for bucket, places, hashes in zip(batch.column("bucket").to_pylist(), batch.column("places"), batch.column("hashes"), strict=True):
                if bucket != now:
                    if now is not None:
                        yield counted(known, others)
                    now, known, others = bucket, [], []
                h = hashes_of(hashes)
                if places.is_valid:
                    known.append((np.cumsum(_unvarints(np.frombuffer(places.as_py(), np.uint8))), h))
                else:
                    others.append(h)
        if now is not None:
            yield counted(known, others)
        give_back()

    found = docs.select("text").mapInArrow(gather, "bucket int, places binary, hashes binary")
    return found.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(union, "w long, n double")


def discounts_of(n: list[int]) -> np.ndarray:
    """Discounts of counts 0, 1, 2 and 3 or more, from how many counts are 1, 2, 3 and 4."""
    n1, n2, n3, n4 = (max(1, int(k)) for k in n)
    y = n1 / (n1 + 2 * n2)
    raw = [0.0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return np.clip(raw, [0, 0.1, 0.1, 0.1], [0, 0.98, 1.9, 2.9])


def evidence_of(t: np.ndarray, o: np.ndarray) -> np.ndarray:
    """Nats by which a word's counts in the two classes are likelier at their own share than at that of all words."""
    n, total = (t + o).astype(float), float(t.sum() + o.sum())
    out = np.zeros(len(n))
    for own in (t, o):
        share = own.sum() / total if total else 0.0
        some = own > 0
        out[some] += own[some] * np.log(own[some] / (n[some] * share))
    return np.maximum(out, 0)


def build(counts: DataFrame, corpus: DataFrame) -> Model:
    """The log-ratios, from ``class_counts`` and ``corpus_contexts`` rows; both are read more than once.

    Of words and contexts, as many as the labelled sample has, the log-probabilities are
    computed on the driver, and of bigrams in tasks.
    """
    session = counts.sparkSession.sparkContext
    words = counts.groupBy("w").agg(*[F.count_if(F.col(c) > 0).cast("int").alias(c) for c in _CLASSES], *[F.sum(c).cast("int").alias(f"n_{c}") for c in _CLASSES]).toArrow()
    key = words.column("w").to_numpy().view(np.uint64)
    order = np.argsort(key)
    key, met = key[order], [words.column(c).to_numpy()[order] for c in _CLASSES]
    evidence = evidence_of(*[words.column(f"n_{c}").to_numpy()[order] for c in _CLASSES])
    del words, order
    total = float(corpus.agg(F.sum("n")).first()[0] or 1)
    found = corpus.where("w IS NOT NULL").toArrow()  # of the sample's words
    w, n = found.column("w").to_numpy().view(np.uint64), found.column("n").to_numpy()
    shared = np.zeros(len(key))
    if len(key):
        at = np.minimum(np.searchsorted(key, w), len(key) - 1)
        np.add.at(shared, at[key[at] == w], n[key[at] == w] / total)
    del found, w, n
    chance, unmet = [], []
    for n in met:
        d = discounts_of([(n == k).sum() for k in range(1, 5)])[np.minimum(n, 3)]
        unmet.append(max(d.sum(), 1e-9) / max(n.sum(), 1))
        chance.append(np.log((n - d) / max(n.sum(), 1) + unmet[-1] * np.maximum(shared, 1e-300)))
    words = _Table(key, chance[0] - chance[1], float(np.log(unmet[0] / unmet[1])), True)
    some = evidence >= LEAST_EVIDENCE
    known = _Table(key[some], evidence[some] ** 2 / (evidence[some] ** 2 + EVIDENCE**2), 0.0, True)
    chance = [c.astype(np.float32) for c in chance]
    del met, shared, n, d
    give_back()

    high = counts.agg(*[F.count_if(F.col(c) == k).alias(f"{c}{k}") for c in _CLASSES for k in range(1, 5)]).first()
    d = [discounts_of([high[f"{c}{k}"] for k in range(1, 5)]) for c in _CLASSES]
    left = [F.sum(F.when(F.col(c) == 0, 0.0).when(F.col(c) == 1, float(x[1])).when(F.col(c) == 2, float(x[2])).otherwise(float(x[3]))) for c, x in zip(_CLASSES, d, strict=True)]
    rows = counts.groupBy("v").agg(*[F.sum(c).cast("int").alias(c) for c in _CLASSES], *[x.alias(f"left_{c}") for c, x in zip(_CLASSES, left, strict=True)])
    weight = [F.when(F.col(c) > 0, F.log(F.col(f"left_{c}") / F.col(c))).otherwise(0.0).cast("float").alias(f"left_{c}") for c in _CLASSES]
    got = rows.select("v", *_CLASSES, *weight).toArrow()
    before = got.column("v").to_numpy().view(np.uint64)
    order = np.argsort(before)
    before, n_of, backoff = before[order], [got.column(c).to_numpy()[order] for c in _CLASSES], [got.column(f"left_{c}").to_numpy()[order] for c in _CLASSES]
    del got, order
    give_back()
    held = session.broadcast((key, chance, before, n_of, backoff))
    contexts_of = _Table(before, backoff[0] - backoff[1], 0.0, True)
    del key, chance, before, n_of, backoff
    give_back()

    def gains(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """What bigrams add to their words backed off, toxic less ordinary: the keys and ratios of each part, in order."""
        key, chance, before, n_of, backoff = held.value
        keys, ratios = [np.zeros(0, np.uint64)], [np.zeros(0, np.float32)]
        for pdf in batches:
            v, w = (pdf[c].to_numpy(np.int64).view(np.uint64) for c in ("v", "w"))
            at_v, at_w = np.searchsorted(before, v), np.searchsorted(key, w)
            gain = []
            for i, c in enumerate(_CLASSES):
                n, backed = pdf[c].to_numpy(np.int64), backoff[i][at_v].astype(float) + chance[i][at_w]
                direct = (n - d[i][np.minimum(n, 3)]) / np.maximum(n_of[i][at_v], 1)
                gain.append(np.log(direct + np.exp(backed)) - backed)
            keys.append(pair_keys(v, w))
            ratios.append((gain[0] - gain[1]).astype(np.float32))
        keys, ratios = np.concatenate(keys), np.concatenate(ratios)
        order = np.argsort(keys)
        keys, ratios = keys[order], ratios[order]
        part = keys >> _PART
        first = np.flatnonzero(np.diff(part, prepend=64))
        rows = [(int(part[a]), keys[a:b].tobytes(), ratios[a:b].tobytes()) for a, b in zip(first, np.append(first[1:], len(keys)), strict=False)]
        yield pd.DataFrame(rows, columns=["p", "keys", "ratios"])
        give_back()

    # The parts come to the driver a few at a time, each into its place.
    sizes = np.zeros(65, np.int64)
    for r in counts.groupBy("p").count().collect():
        sizes[r["p"] + 1] = r["count"]
    starts = np.cumsum(sizes)
    keys, ratios, filled = np.empty(starts[-1], np.uint64), np.empty(starts[-1], np.float32), starts[:-1].copy()
    for k in range(16):
        for r in counts.where(F.col("p") % 16 == k).mapInPandas(gains, "p int, keys binary, ratios binary").collect():
            low = filled[r["p"]]
            filled[r["p"]] = high = low + len(r["keys"]) // 8
            keys[low:high], ratios[low:high] = np.frombuffer(r["keys"], np.uint64), np.frombuffer(r["ratios"], np.float32)
    for low, high in zip(starts, starts[1:], strict=False):
        part = keys[low:high]
        if (part[1:] < part[:-1]).any():  # of several tasks
            order = np.argsort(part)
            keys[low:high], ratios[low:high] = keys[low:high][order], ratios[low:high][order]
    pairs = _Table(keys, ratios, 0.0, True)
    held.destroy()
    give_back()
    return Model(words, known, contexts_of, pairs)


class _Table:
    """Values by 64-bit key, and one for all other keys."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, other: float, ordered: bool = False):
        order = slice(None) if ordered else np.argsort(keys)
        self.keys, self.values, self.other = keys[order], values[order].astype(np.float32, copy=False), np.float32(other)

    def of(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(keys), self.other)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.values[at], self.other)


class Model:
    """Log-ratios of the sample's words, contexts and bigrams, words' evidence, and the weights that compare a text's."""

    def __init__(self, words: _Table, known: _Table, contexts: _Table, pairs: _Table):
        self.words, self.known, self.contexts, self.pairs = words, known, contexts, pairs
        self.weights: np.ndarray | None = None

    def ratios(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Toxic less ordinary log-likelihood of each word, given the one before it, and backed off from it."""
        different, back = np.unique(words, return_inverse=True)
        v, backed_off = contexts(words), self.words.of(different)[back].astype(float)
        return backed_off + self.contexts.of(v) + self.pairs.of(pair_keys(v, words)), backed_off

    def feature(self, text: str) -> float:
        """The logarithm of the mean of the words' ratios, by their evidence, less that of a word never met; what speaks for the ordinary class is none."""
        words = words_of(text)
        if not len(words):
            return float(np.log(LEAST_EXCESS))
        different, back = np.unique(words, return_inverse=True)
        weight = self.known.of(different)
        some = np.flatnonzero(weight[back] > 0)  # the others' ratios count nothing
        v, own, back = contexts(words)[some], words[some], back[some]
        low = self.words.of(different).astype(float)[back] - self.words.other
        full = low + self.contexts.of(v) + self.pairs.of(pair_keys(v, own))
        return float(np.log(LEAST_EXCESS + np.maximum(full * weight[back], 0).sum() / len(words)))

    def score(self, text: str) -> float:
        x = np.array([self.feature(text), 1.0])
        return float(1 / (1 + np.exp(-np.clip(x @ self.weights, -30, 30))))


def _logistic(x: np.ndarray, y: np.ndarray, share: float, ridge: float = 1.0) -> np.ndarray:
    """Weights of a logistic regression (last: intercept), by Newton steps; without much to learn from all scores tend to ``share``."""
    mean = x.mean(0)
    x = np.column_stack([x - mean, np.ones(len(x))])
    w, start = np.zeros(x.shape[1]), np.log(share / (1 - share))
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(start + x @ w, -30, 30)))
        h = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + ridge * np.eye(len(w))
        w += np.linalg.solve(h, x.T @ (y - p) - ridge * w)
    return np.append(w[:-1], start + w[-1] - w[:-1] @ mean)


def fit(docs: DataFrame, labels: DataFrame, learn: Column, most: int = MAX_LABELLED) -> Model | None:
    """The two models of the labelled documents where ``learn`` holds; None without both classes."""
    sample = sampled(labels, learn, most)
    n, toxic = sample.agg(F.count("*"), F.count_if(F.col("toxic") > 0)).first()
    if not toxic or toxic == n:
        return None
    rows = labelled(docs, sample)
    counts = materialize(class_counts(rows), "bigrams")
    model = build(counts, materialize(corpus_contexts(docs, known_words(counts), frequent(counts)), "corpus"))
    held = docs.sparkSession.sparkContext.broadcast(model)

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = [(key, held.value.feature(text_of(text)), int(toxic > 0)) for key, text, toxic in rows_of(batches, "_key", "text", "toxic")]
        yield pd.DataFrame(found, columns=["_key", "x", "y"]).astype({"_key": "int64", "x": float, "y": "int64"})

    found = rows.where("left_out").select("_key", "text", "toxic").mapInPandas(features, "_key long, x double, y long")
    got = found.groupBy("_key").agg(F.avg("x").alias("x"), F.max("y").alias("y")).toArrow().to_pandas()  # a row for each left-out document
    held.destroy()
    if got["y"].nunique() == 2:
        model.weights = _logistic(got[["x"]].to_numpy(float), got["y"].to_numpy(float), toxic / n)
    else:
        model.weights = np.array([PLAIN, np.log(toxic / (n - toxic)) - PLAIN * np.log(LEAST_EXCESS)])
    return model


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """Per document: doc_id, score, predicted (1 from THRESHOLD on); written, so that the broadcast model needn't outlive the call."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = Emitter(["_key", "score"])
        for key, text in rows_of(batches, "_key", "text"):
            if out.add((key, held.value.score(text_of(text)) if held.value else 0.0)):
                yield out.frame()
        yield out.frame()

    found = unkeyed(materialize(keyed(docs, "text").mapInPandas(run, "_key long, score double"), "scores"))
    held.destroy()
    return found.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_ordinary(docs: DataFrame, model: Model | None) -> DataFrame:
    """The rows of ``docs`` that score below THRESHOLD, whole and with all their columns; all of them without a model. Written, as in :func:`score`."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def clean(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            keep = [held.value is None or held.value.score(text_of(t)) < THRESHOLD for t in batch.column("text").to_pylist()]
            yield batch.filter(pa.array(keep, pa.bool_()))
        give_back()

    kept = materialize(docs.mapInArrow(clean, docs.schema), "ordinary")
    held.destroy()
    return kept
