"""Document fingerprints by winnowing.

Every k-gram of code points gets a rolling hash; of each window of w hashes the least
is chosen, the rightmost where several are equal, and kept with its position. Two
texts that share a run of w + k - 1 code points share a fingerprint.

Nulls: a null text is empty, and an empty text has an empty fingerprint; two empty
fingerprints are alike (1.0). A text shorter than k is one gram. A null doc_id comes
before all others. Rows that repeat a doc_id are each fingerprinted; the next document
is the least text of the next larger doc_id (after the largest: of the least). An empty
table gives an empty one; one document is its own next. Very long texts are hashed whole, in
blocks of BLOCK windows. Columns other than doc_id and text are never read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeweave.llm.common import Emitter, IdRanges, keyed, range_hashes, rows_of, text_of, unkeyed

K, W = 16, 64
#: Windows handled at once: a long text needs memory for one block.
BLOCK = 1 << 18


def gram_hashes(codes: np.ndarray, k: int) -> np.ndarray:
    """Rolling hashes of all k-grams; of the whole text where it is shorter."""
    n = len(codes)
    if not n:
        return np.zeros(0, np.uint64)
    starts = np.arange(max(1, n - k + 1))
    return range_hashes(codes, starts, np.minimum(starts + k, n))


def chosen(hashes: np.ndarray, w: int) -> np.ndarray:
    """Positions that the windows choose: the least hash, the rightmost of equal ones."""
    if len(hashes) <= w:
        return len(hashes) - 1 - np.argmin(hashes[::-1], keepdims=True) if len(hashes) else np.zeros(0, np.int64)
    best, at, width = hashes, np.arange(len(hashes), dtype=np.int32), 1
    while width < w:
        step = min(width, w - width)
        right = best[step:]
        take = right <= best[:-step]
        best, at = np.where(take, right, best[:-step]), np.where(take, at[step:], at[:-step])
        width += step
    return at[np.flatnonzero(np.diff(at, prepend=-1))]


def fingerprint(text: str, k: int = K, w: int = W) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, positions) of the text, by position."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    if len(codes) <= BLOCK + w + k:
        h = gram_hashes(codes, k)
        at = chosen(h, w)
        return h[at], at.astype(np.int64)
    hashes, positions = [], []
    for s in range(0, len(codes) - w - k + 2, BLOCK):
        h = gram_hashes(codes[s : s + BLOCK + w + k - 2], k)
        at = chosen(h, w)
        hashes.append(h[at])
        positions.append(at.astype(np.int64) + s)
    at, first = np.unique(np.concatenate(positions), return_index=True)
    return np.concatenate(hashes)[first], at


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sorted sets of hashes."""
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def written(hashes: np.ndarray) -> str:
    return hashes.astype(">u8").tobytes().hex()


def fingerprints(docs: DataFrame, k: int = K, w: int = W) -> DataFrame:
    """Per document: doc_id, hashes (array of long) and their positions."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = Emitter(["_key", "hashes", "positions"])
        for key, text in rows_of(batches, "_key", "text"):
            h, at = fingerprint(text_of(text), k, w)
            if out.add((key, h.view(np.int64), at), 16 * len(h)):
                yield out.frame()
        yield out.frame()

    return unkeyed(keyed(docs, "text").mapInPandas(run, "_key long, hashes array<long>, positions array<long>"))


def with_next(docs: DataFrame, visit, columns: list[str], schema: str) -> DataFrame:
    """Calls ``visit(text, next_text, next_state)`` for every row, where the next document is known.

    ``visit`` returns the row's columns and its own state, which its predecessor gets.
    Texts are shuffled once, by ranges of ids. Each range also gets a copy of the row
    that follows it, and is read from the largest id down, so that a task holds two
    texts at a time and never a window over all rows.
    """
    ranges = IdRanges(docs, "doc_id")

    def bounds(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(bucket=ranges.bucket(pdf["_key"])).groupby("bucket", as_index=False).agg(least=("_key", "min"))

    least = keyed(docs).mapInPandas(bounds, "bucket int, least long").groupBy("bucket").agg(F.min("least").alias("least")).orderBy("bucket").collect()
    before = {r.least: least[i - 1].bucket for i, r in enumerate(least)}  # the first of a range follows the range before it

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            own = pdf.assign(bucket=ranges.bucket(pdf["_key"]), guest=np.int8(0))
            first = own[own["_key"].isin(before)]
            yield own if first.empty else pd.concat([own, first.assign(bucket=first["_key"].map(before).astype(np.int32), guest=np.int8(1))])

    dealt = keyed(docs, "text").mapInPandas(deal, "_key long, text string, bucket int, guest byte")
    dealt = dealt.repartitionById(ranges.n, F.col("bucket")).sortWithinPartitions("bucket", F.desc("guest"), F.desc("_key"), F.desc("text"))

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = Emitter(["_key", *columns], most=500)
        where, here, after = None, None, ("", None)
        for bucket, guest, key, text in rows_of(batches, "bucket", "guest", "_key", "text"):
            if where != (bucket, guest, key):
                if where and where[0] == bucket:
                    after = here
                where = (bucket, guest, key)
            row, state = visit(text_of(text), *after, guest)
            here = (text_of(text), state)
            if not guest and out.add((key, *row), 64 + sum(len(x) for x in row if isinstance(x, str))):
                yield out.frame()
        yield out.frame()

    return unkeyed(dealt.mapInPandas(walk, f"_key long, {schema}"))


def compare_edited(docs: DataFrame, k: int = K, w: int = W) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they are.

    The edited text is the text with its last half replaced by as much of the next
    document's beginning. ``near_edited``: likeness to the edited text; ``near_next``:
    to the next document. ``positions``: where the text's fingerprint was chosen.
    """

    def visit(text: str, next_text: str, next_set, guest: int):
        h, at = fingerprint(text, k, w)
        own = np.unique(h)
        if guest:
            return (), own
        half = len(text) // 2
        edited = text[: len(text) - half] + next_text[:half]
        g, _ = fingerprint(edited, k, w)
        row = (len(text), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), written(h), written(g), likeness(own, np.unique(g)), likeness(own, next_set), at)
        return row, own

    columns = ["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "positions"]
    return with_next(docs, visit, columns, "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, positions array<long>")
