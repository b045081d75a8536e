"""Benchmark decontamination with a generalised suffix automaton of the test items.

The automaton holds every word sequence of the normalised items, and its states the items:
a state whose strings have a window's length knows the items that they occur in, and the
state of a whole short item knows that item. Documents stream through it word by word; at
each word the state and length of the longest match that ends there, up to a window, are
tracked. A match of a window's length marks the window's words and its state's items.

Nulls: a text that is null has no words; an item without words gives no window.
Ties and repeated rows: each row is judged by itself; items with equal text are
all named. An empty benchmark contaminates nothing. Of a very long text a task holds all
words at once. The columns of ``docs`` may have any names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from citeweave.llm.common import give_back, text_of, unused
from citeweave.session import materialize

WINDOW = 13
#: Words of items that one automaton holds, some 100 MB in a task; more items make more automata, one pass each.
MAX_ITEM_WORDS = 200_000

#: A-Z to a-z, and every other ASCII byte that is no digit and no letter to a space.
_NORMAL = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def words(text: object) -> list[bytes]:
    """Lower-cases A-Z; words are runs of digits, a-z and characters beyond ASCII."""
    return text_of(text).encode("utf-8", "surrogatepass").translate(_NORMAL).split()


class SuffixAutomaton:
    """Generalised suffix automaton over word numbers, with the items that its states' windows occur in."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        numbered = [(name, [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in tokens]) for name, tokens in items if tokens]
        for _, ids in numbered:
            last = 0
            for c in ids:
                last = self._extend(last, c)
        # By window length: the items of each state. States are complete only now.
        self.items: dict[int, dict[int, set[str]]] = {}
        for name, ids in numbered:
            size = min(window, len(ids))
            mine = self.items.setdefault(size, {})
            state = matched = 0
            for c in ids:
                state, matched = self.step(state, matched, c)
                if matched >= size:
                    mine.setdefault(self._of_length(state, size), set()).add(name)
        self.sizes = sorted(self.items)

    def step(self, state: int, matched: int, c: int) -> tuple[int, int]:
        """The state and length of the longest match that ends with word c, no longer than a window."""
        follow, link, length = self.next, self.link, self.length
        while state and c not in follow[state]:
            state = link[state]
            matched = length[state]
        if c not in follow[state]:
            return 0, 0
        state, matched = follow[state][c], matched + 1
        if matched >= self.window:
            matched = self.window
            while length[link[state]] >= matched:
                state = link[state]
        return state, matched

    def _of_length(self, state: int, size: int) -> int:
        """The state of the last ``size`` words of the state's match."""
        while self.length[self.link[state]] >= size:
            state = self.link[state]
        return state

    def _split(self, p: int, c: int, q: int) -> int:
        """The state for the strings of q that are p's plus c; q itself where those are all of its own."""
        if self.length[q] == self.length[p] + 1:
            return q
        clone = len(self.next)
        self.next.append(dict(self.next[q]))
        self.link.append(self.link[q])
        self.length.append(self.length[p] + 1)
        self.link[q] = clone
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, c: int) -> int:
        if c in self.next[last]:
            return self._split(last, c, self.next[last][c])
        state = len(self.next)
        self.next.append({})
        self.link.append(0)
        self.length.append(self.length[last] + 1)
        p = last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = state
            p = self.link[p]
        if p >= 0:
            self.link[state] = self._split(p, c, self.next[p][c])
        return state

    def hits(self, tokens: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Word ranges that windows cover, merged and in order, and the items whose windows occur."""
        spans: list[tuple[int, int]] = []
        items: set[str] = set()
        if not self.sizes:
            return spans, items
        number, least, step = self.vocabulary, self.sizes[0], self.step
        ids = [number.get(w, -1) for w in tokens]
        end, n = 0, len(ids)
        while end < n:
            start = end
            while end < n and ids[end] >= 0:
                end += 1
            if end - start >= least:
                state = matched = 0
                for i in range(start, end):
                    state, matched = step(state, matched, ids[i])
                    if matched >= least:
                        for size in self.sizes:
                            if size > matched:
                                break
                            found = self.items[size].get(self._of_length(state, size))
                            if found:
                                items |= found
                                spans.append((i + 1 - size, i + 1))
            end += 1
        return _joined([spans]), items


def automata(benchmark: DataFrame, window: int = WINDOW, most: int = MAX_ITEM_WORDS) -> Iterator[SuffixAutomaton]:
    """One automaton for each ``most`` words of items, one at a time; an empty one for an empty benchmark."""
    batch: list[tuple[str, list[bytes]]] = []
    held = made = 0
    for row in benchmark.selectExpr("cast(item_id as string) AS item_id", "text").orderBy("item_id", "text").toLocalIterator():
        tokens = words(row.text)
        if batch and held + len(tokens) > most:
            yield SuffixAutomaton(batch, window)
            made += 1
            batch, held = [], 0
        batch.append((row.item_id if row.item_id is not None else "", tokens))
        held += len(tokens)
    if batch or not made:
        yield SuffixAutomaton(batch, window)


def _joined(parts: list[list[tuple[int, int]]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for low, high in sorted(s for p in parts for s in p):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


def remove_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans and what stands between those words."""
    if not spans:
        return text
    data = text.encode("utf-8", "surrogatepass")
    at = [m.span() for m in _WORD.finditer(data)]
    out, last = [], 0
    for low, high in spans:
        out.append(data[last : at[low][0]])
        last = at[high - 1][1]
    return b"".join([*out, data[last:]]).decode("utf-8", "surrogatepass")


def _hits(docs: DataFrame, benchmark: DataFrame, window: int) -> tuple[DataFrame, list[str]]:
    """``docs`` with three columns more, and their names: number of words, hit word ranges (ends in turn), items.

    A benchmark of one automaton takes one pass. A larger one takes a pass for each,
    the table being written between them, so that a task holds one automaton at a time.
    """
    own_columns = docs.columns
    n_words, hits, items = names = [unused(docs, c) for c in ("_n_words", "_hits", "_items")]
    schema = StructType([*docs.schema.fields, StructField(n_words, LongType()), StructField(hits, ArrayType(IntegerType())), StructField(items, ArrayType(StringType()))])

    def apply(machine: SuffixAutomaton, first: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                old = [([], [])] * batch.num_rows if first else zip(batch.column(hits).to_pylist(), batch.column(items).to_pylist(), strict=True)
                counts, spans, found = [], [], []
                for text, (before, named) in zip(batch.column("text").to_pylist(), old, strict=True):
                    tokens = words(text)
                    mine, own = machine.hits(tokens)
                    counts.append(len(tokens))
                    spans.append([x for s in _joined([mine, list(zip(before[::2], before[1::2], strict=True))]) for x in s])
                    found.append([*named, *sorted(own)])
                columns = [batch.column(c) for c in own_columns]
                more = [pa.array(counts, pa.int64()), pa.array(spans, pa.list_(pa.int32())), pa.array(found, pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays(columns + more, names=schema.fieldNames())
            give_back()

        return run

    rows, first = docs, True
    for machine in automata(benchmark, window):
        rows = (rows if first else materialize(rows, "hits")).mapInArrow(apply(machine, first), schema)
        first = False
    return rows, names


def _verdict(names: list[str], share: int) -> dict[str, Column]:
    n_words, hits, items = names
    n_hit = F.aggregate(F.col(hits), F.struct(F.lit(0).cast("long").alias("n"), F.lit(-1).cast("long").alias("sign")), lambda t, x: F.struct((t["n"] + t["sign"] * x).alias("n"), (-t["sign"]).alias("sign")), lambda t: t["n"])
    named = F.array_sort(F.array_distinct(F.col(items)))
    return {
        "n_words": F.col(n_words), "n_hit": n_hit, "n_items": F.size(named).cast("long"), "items_sha256": F.sha2(F.array_join(named, ",").cast("binary"), 256),
        "contaminated": (n_hit > 0) & (share * n_hit >= F.col(n_words)),
    }


def judged(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = 20) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    ``contaminated``: some word is hit and ``share`` * n_hit >= n_words (the coverage
    limit; ``window`` is the length limit).
    """
    rows, names = _hits(docs.select("doc_id", "text"), benchmark, window)
    return rows.select("doc_id", *[c.alias(k) for k, c in _verdict(names, share).items()])


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = 20) -> DataFrame:
    """As :func:`judged`, with ``cleaned``: the text without its hit spans."""
    rows, names = _hits(docs.select("doc_id", "text"), benchmark, window)

    @F.pandas_udf(StringType())
    def cleaned(text: pd.Series, hits: pd.Series) -> pd.Series:
        return pd.Series([remove_spans(text_of(t), list(zip(h[::2], h[1::2], strict=True))) for t, h in zip(text, hits, strict=True)], dtype=object)

    return rows.select("doc_id", *[c.alias(k) for k, c in _verdict(names, share).items()], cleaned("text", names[1]).alias("cleaned"))


def keep_clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = 20) -> DataFrame:
    """The rows of ``docs`` that aren't contaminated, whole and with all their columns."""
    rows, names = _hits(docs, benchmark, window)
    return rows.where(~_verdict(names, share)["contaminated"]).select(*[F.col(f"`{c}`") for c in docs.columns])
