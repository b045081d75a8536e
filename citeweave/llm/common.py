"""What several corpus operators share: word hashing, id ranges, batch helpers."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST = -(2**63)
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_powers: dict[str, np.ndarray] = {}

#: Separator tables for byte-wise words.
ASCII_SPACE = np.zeros(256, bool)
ASCII_SPACE[[9, 10, 11, 12, 13, 32]] = True


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash base's powers and their inverses modulo 2**64, at least n of each."""
    if len(_powers.get("up", ())) < n:
        size = max(n, 1 << 14)
        up, down = np.full(size, _BASE), np.full(size, _INVERSE)
        up[0] = down[0] = 1
        _powers["up"], _powers["down"] = np.cumprod(up), np.cumprod(down)
    return _powers["up"], _powers["down"]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of values[start:end] for every range, from one running polynomial sum."""
    up, down = powers(len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up[: len(values)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts])


def word_hashes(data: bytes, separators: np.ndarray = ASCII_SPACE, block: int = 1 << 20) -> np.ndarray:
    """64-bit hashes of the words of ``data``, in order; long inputs go block by block, cut between words."""
    out, at = [], 0
    whole = np.frombuffer(data, np.uint8)
    while at < len(whole):
        size = block
        while True:
            part = whole[at : at + size]
            gap = separators[part]
            if at + len(part) == len(whole):
                cut = len(part)
                break
            last = np.flatnonzero(gap[-4096:]) if gap[-4096:].any() else np.flatnonzero(gap)
            if len(last):
                cut = int(last[-1]) + 1 + (len(part) - 4096 if gap[-4096:].any() and len(part) > 4096 else 0)
                break
            size *= 2
        part, gap = part[:cut], gap[:cut]
        inside = np.zeros(len(part) + 2, np.int8)
        inside[1:-1] = ~gap
        step = np.diff(inside)
        starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        if len(starts):
            out.append(range_hashes(part, starts, ends))
        at += cut
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def text_of(value: object) -> str:
    """A text as the operators read it: null is empty."""
    return value if isinstance(value, str) else ""


def ordered_key(col: str) -> Column:
    """Ids in their order; a null id comes before all others."""
    return F.coalesce(F.col(col).cast("long"), F.lit(LEAST))


def fold(col: str, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id has none."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % n


class IdRanges:
    """Cuts ids into ranges of about equal counts, from the quantiles of all ids.

    Only the cut points (one per range) come to the driver. ``bucket`` numbers
    the ranges in ascending order of ids.
    """

    def __init__(self, df: DataFrame, col: str, n: int | None = None):
        n = max(2, n or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        cuts = df.select(F.percentile_approx(ordered_key(col), [i / n for i in range(1, n)], F.lit(max(10_000, 20 * n)))).first()[0]
        self.n, self.cuts = n, np.unique(np.array(cuts or [], np.int64))

    def bucket(self, keys: pd.Series | np.ndarray) -> np.ndarray:
        return np.searchsorted(self.cuts, np.asarray(keys, np.int64), side="right").astype(np.int32)


def rows_of(batches: Iterator[pd.DataFrame], *cols: str) -> Iterator[tuple]:
    for pdf in batches:
        yield from zip(*(pdf[c].array if pdf[c].dtype != object else pdf[c].to_numpy() for c in cols), strict=True)
    give_back()


def give_back() -> None:
    """Returns a worker's free memory to the machine: workers outlive their tasks, and share it with Spark's heap."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):
        ctypes.CDLL(None).malloc_trim(0)


class Emitter:
    """Collects output rows and hands them on as frames of bounded size."""

    def __init__(self, columns: list[str], dtypes: dict[str, str] | None = None, most: int = 2000, most_bytes: int = 16 << 20):
        self.columns, self.dtypes, self.most, self.most_bytes = columns, dtypes or {}, most, most_bytes
        self.rows: list[tuple] = []
        self.held = 0

    def add(self, row: tuple, weight: int = 64) -> bool:
        self.rows.append(row)
        self.held += weight
        return len(self.rows) >= self.most or self.held >= self.most_bytes

    def frame(self) -> pd.DataFrame:
        out = pd.DataFrame(self.rows, columns=self.columns)
        for c, t in self.dtypes.items():
            out[c] = out[c].astype(t)
        self.rows, self.held = [], 0
        return out


def keyed(docs: DataFrame, *cols: str, key: str = "doc_id") -> DataFrame:
    """``_key`` (the id, LEAST where null) and the columns asked for; no other column of ``docs`` goes further."""
    return docs.select(ordered_key(key).alias("_key"), *[F.col(c) for c in cols])


def unkeyed(df: DataFrame, key: str = "doc_id") -> DataFrame:
    """Turns ``_key`` back into the id, first column."""
    rest = [c for c in df.columns if c != "_key"]
    return df.select(F.when(F.col("_key") != LEAST, F.col("_key")).alias(key), *rest)


def unused(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have."""
    while name in df.columns:
        name += "_"
    return name
