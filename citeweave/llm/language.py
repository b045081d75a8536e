"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counts come from all rows given for learning. The matrix of log-probabilities (DIMENSIONS
rows, a column for each language) is broadcast. A batch of documents is a sparse matrix of
n-gram counts in compressed rows: where each document's n-grams begin, and their hashes; its
product with the broadcast matrix is one gather and one sum over rows for each language.

Nulls: a null language teaches nothing; a null text, and a text without a letter, is
``und`` with score 0. Ties go to the language that is first in order. With nothing
learned every prediction is ``und``. Repeated rows count and are scored each. Very long
texts take several rows of the sparse matrix, whose sums are added. Columns other than
doc_id, text and lang are never read, whatever their names. A language takes 4 * DIMENSIONS
bytes of every task; more than MOST_LANGUAGES are an error, none is ever left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeweave.llm.common import give_back, keyed, mix, text_of, unkeyed
from citeweave.session import materialize

DIMENSIONS = 1 << 15
ORDERS = (1, 2, 3)
#: Languages a model can hold (512 MB).
MOST_LANGUAGES = 4096
#: Code points of one sparse matrix, and of one of its rows.
BLOCK = 1 << 19
_SEEDS = {n: np.uint64(0x9E3779B97F4A7C15 * (2 * n + 1) % 2**64) for n in range(1, 8)}


def sparse(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text, first, hashes) of blocks of texts: the texts that the rows are of, where the rows begin, and their n-grams.

    N-grams are of the lower-cased texts, each as often as it occurs; rows without any are left out.
    """
    rows: list[tuple[int, np.ndarray, int]] = []
    held = 0
    for i, text in enumerate(texts):
        codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
        for at in range(0, len(codes), BLOCK):
            part = codes[at : at + BLOCK + max(ORDERS) - 1]
            rows.append((i, part, min(BLOCK, len(codes) - at)))
            held += len(part)
            if held >= BLOCK:
                yield from _blocks(rows)
                rows, held = [], 0
    if rows:
        yield from _blocks(rows)


def _blocks(rows: list[tuple[int, np.ndarray, int]]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    text, own = np.array([i for i, _, _ in rows]), np.array([n for _, _, n in rows])
    sizes = np.array([len(part) for _, part, _ in rows])
    codes = np.concatenate([part for _, part, _ in rows]).astype(np.uint64)
    row = np.repeat(np.arange(len(rows)), sizes)
    inside = np.arange(len(codes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)  # place in the row
    packed = codes
    for n in ORDERS:
        if n > 1:
            if len(codes) < n:
                return
            packed = (packed[: len(codes) - n + 1] << np.uint64(21)) | codes[n - 1 :]
        begins = (inside < np.repeat(np.minimum(own, sizes - n + 1), sizes))[: len(packed)]
        counts = np.bincount(row[: len(packed)][begins], minlength=len(rows))
        some = counts > 0
        if some.any():
            yield text[some], (np.cumsum(counts) - counts)[some], (mix(packed[begins] * _SEEDS[n]) >> np.uint64(49)).astype(np.int64)


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


class Model:
    """Languages in order, their log-probabilities (a row each, all n-grams' together) and priors."""

    def __init__(self, languages: list[str], documents: np.ndarray):
        self.languages = languages
        self.log_prob = np.full((len(languages), DIMENSIONS), 0, np.float32)
        self.prior = np.log(documents / max(documents.sum(), 1)) if len(languages) else np.zeros(0)

    def learn(self, language: int, grams: np.ndarray, counts: np.ndarray) -> None:
        row = np.full(DIMENSIONS, 0.5)
        row[grams] += counts
        self.log_prob[language] = np.log(row / row.sum())

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """The likeliest languages and their posterior probabilities."""
        letters = np.array([has_letter(t) for t in texts], bool)
        if not self.languages or not letters.any():
            return ["und"] * len(texts), np.zeros(len(texts))
        total = np.tile(self.prior, (len(texts), 1))
        for text, first, hashes in sparse([t if ok else "" for t, ok in zip(texts, letters, strict=True)]):
            for k in range(len(self.languages)):
                sums = np.add.reduceat(self.log_prob[k][hashes], first, dtype=np.float64)
                np.add.at(total[:, k], text, sums)
        best = total.argmax(1)
        score = 1 / np.exp(total - total.max(1, keepdims=True)).sum(1)
        return [self.languages[b] if ok else "und" for b, ok in zip(best, letters, strict=True)], np.where(letters, score, 0.0)


def fit(docs: DataFrame, learn: Column) -> Model:
    """Counts n-grams of all rows where ``learn`` holds and ``lang`` isn't null."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[str, np.ndarray] = {}
        for pdf in batches:
            for lang, of in pdf.groupby("lang"):
                if lang not in seen:
                    if len(seen) >= 256:  # many languages: hand on what there is
                        yield _counted(seen)
                        seen = {}
                    seen[lang] = np.zeros(DIMENSIONS + 1, np.int64)
                mine = seen[lang]
                mine[DIMENSIONS] += len(of)
                for _, _, hashes in sparse([text_of(t) for t in of["text"]]):
                    mine[:DIMENSIONS] += np.bincount(hashes, minlength=DIMENSIONS)
        yield _counted(seen)
        give_back()

    rows = docs.where(learn & F.col("lang").isNotNull()).select("lang", "text")
    sums = materialize(rows.mapInPandas(count, "lang string, gram int, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")), "grams")
    sizes = sums.where(F.col("gram") == DIMENSIONS).select("lang", "n").limit(MOST_LANGUAGES + 1).toArrow().to_pandas().sort_values("lang")
    if len(sizes) > MOST_LANGUAGES:
        raise ValueError(f"there are more than {MOST_LANGUAGES} languages")
    model = Model(list(sizes["lang"]), sizes["n"].to_numpy(np.int64))
    for at in range(0, len(model.languages), 256):  # a part of the matrix at a time
        part = model.languages[at : at + 256]
        got = sums.where((F.col("gram") < DIMENSIONS) & F.col("lang").between(part[0], part[-1])).toArrow().to_pandas()
        for lang, of in got.groupby("lang"):
            model.learn(model.languages.index(lang), of["gram"].to_numpy(np.int64), of["n"].to_numpy())
        for k, lang in enumerate(part, at):
            if not (got["lang"] == lang).any():  # texts without any n-gram
                model.learn(k, np.zeros(0, np.int64), np.zeros(0))
    return model


def _counted(seen: dict[str, np.ndarray]) -> pd.DataFrame:
    parts = [pd.DataFrame({"lang": x, "gram": (k := np.flatnonzero(v)).astype(np.int32), "n": v[k]}) for x, v in seen.items()]
    return pd.concat(parts) if parts else pd.DataFrame({"lang": pd.Series(dtype=str), "gram": pd.Series(dtype=np.int32), "n": pd.Series(dtype=np.int64)})


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """Per document: doc_id, lang_pred, score."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            lang, chance = held.value.predict([text_of(t) for t in pdf["text"]])
            yield pd.DataFrame({"_key": pdf["_key"], "lang_pred": lang, "score": chance})
        give_back()

    return unkeyed(keyed(docs, "text").mapInPandas(score, "_key long, lang_pred string, score double"))
