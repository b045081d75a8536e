"""SentencePiece encoding as a max-plus scan, and decoding.

A text's best segmentation is the path of the greatest score, a path's score being the
sum of its pieces' scores: matrix products over (max, +). A piece that begins a blank
can't follow another character inside a piece, so ordinary texts fall into independent
words, and a task remembers the words it has met. A giant text is cut into chunks that
go to different tasks: each gives the transfer matrix from the states at its beginning
(how far the last chunk's piece reaches in) to those at its end; the matrices of a text
are combined in a tree, which is associative, into the scores at each chunk's beginning.
From these each chunk tells by which state its path came in for each by which it leaves;
these maps are combined in the same way from the text's end, and then each chunk finds
its own path back.

Scores: those of a unigram model are log-probabilities. The scores of a model made by pair
merging are the merges' numbers, which can't be summed; such pieces were found in the order
of their frequency, so by Zipf's law the probability of the r-th is taken as proportional to
1 / (r + ZIPF). All scores are rounded to whole UNITs, so that sums are exact in any
grouping. A character without a piece scores less than any piece and becomes its UTF-8
bytes. Of equal scores the path whose last piece is longest wins, in chunks as in whole texts.

Nulls: a null text is empty and has no ids. A U+2581 in a text is read as a blank.
Repeated rows are encoded each. An empty table gives an empty one. Columns other than doc_id and text are never read.
"""

from __future__ import annotations

import functools
import math
import re
import sys
from array import array
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeweave.llm.common import Emitter, give_back, keyed, rows_of, text_of, unkeyed
from citeweave.session import materialize

#: Code points beyond which a text is giant, and code points of a chunk.
GIANT, CHUNK = 50_000, 16_384
#: Words that a task remembers, and slots in which it notes that it met a word.
CACHE_WORDS, MET_SLOTS = 300_000, 1 << 22
#: Chunks, or blocks of them, that one task combines.
FAN = 256
#: Offset of ranks, and a nat's units: scores are whole numbers, exact in sums of less than 2**53.
ZIPF, UNIT = 100, 1 << 16
_BLANK = "▁"
_NONE = -math.inf


def log_probabilities(scores: dict[str, float]) -> dict[str, float]:
    """Scores that may be summed, in units; of a merged vocabulary (scores 0, -1, -2 ...) by the rank's share.

    Pieces that a model's maker has put below all others (-1e9) stay there.
    """
    real = [s for s in scores.values() if s > -1e8]
    if real and all(s <= 0 and s == int(s) for s in real):
        total = math.log(sum(1 / (ZIPF - s) for s in real))
        scores = {p: -math.log(ZIPF - s) - total if s > -1e8 else s for p, s in scores.items()}
    low = min((s for s in scores.values() if s > -1e8), default=0.0)
    return {p: float(round(UNIT * (s if s > -1e8 else low - 5))) for p, s in scores.items()}


class Vocabulary:
    """Pieces, scores and ids of a model file, and the ids of bytes."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        ordinary = {}
        self.pieces: dict[str, tuple[float, int]] = {}
        self.bytes: dict[int, int] = {}
        self.text: list[bytes] = []
        for i in range(model.vocab_size()):
            piece = model.id_to_piece(i)
            self.text.append(b"")
            if model.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
                self.text[i] = bytes([int(piece[3:5], 16)])
            elif not (model.is_unknown(i) or model.is_control(i) or model.is_unused(i)):
                ordinary[piece] = (float(model.get_score(i)), i)
                self.text[i] = piece.replace(_BLANK, " ").encode()
        scores = log_probabilities({p: s for p, (s, _) in ordinary.items()})
        self.pieces.update({p: (scores[p], i) for p, (_, i) in ordinary.items()})
        self.longest = max(map(len, self.pieces), default=1)
        self.unknown = min((s for s, _ in self.pieces.values()), default=0.0) - 10 * UNIT
        self.scores = np.zeros(model.vocab_size())
        for score, i in self.pieces.values():
            self.scores[i] = score
        for byte, i in self.bytes.items():
            self.scores[i] = 0.0 if 0x80 <= byte < 0xC0 else self.unknown
        inner = [p for p in self.pieces if _BLANK in p.lstrip(_BLANK)]
        if inner:
            raise ValueError(f"pieces hold blanks inside: {inner[:3]}")
        # Every beginning of a piece: a scan ends where nothing goes on.
        self.starts: dict[str, tuple[float, int] | None] = {}
        for p, found in self.pieces.items():
            for i in range(1, len(p)):
                self.starts.setdefault(p[:i], None)
            self.starts[p] = found
        # Neighbours inside a piece: between any other two characters every path has a boundary.
        self.bonds = {p[i : i + 2] for p in self.pieces for i in range(len(p) - 1)}
        self.lines = not any("\n" in p for p in self.pieces)
        self.forget()

    def forget(self) -> None:
        """Drops the words met, as a task does at its end: a worker's next task may need the memory."""
        self.known: dict[str, bytes] = {"": b""}
        self.met, self.n_met = bytearray(MET_SLOTS), 0

    def ids_of(self, part: str) -> list[int]:
        found = self.pieces.get(part)
        return [found[1]] if found else [self.bytes[b] for b in part.encode("utf-8", "surrogatepass")]

    def scan(self, text: str, entry: list[float], stop: int) -> tuple[list[float], list[int]]:
        """Best score and last piece's start at every position, from scores ``entry`` at the first ones.

        Pieces begin before ``stop``. A start of -1 means that the path entered there.
        """
        n, starts, unknown = len(text), self.starts, self.unknown
        best, last = [_NONE] * (n + 1), [-1] * (n + 1)
        best[: len(entry)] = entry[: n + 1]
        for start in range(min(stop, n)):
            here = best[start]
            if here == _NONE:
                continue
            end = start + 1
            if not starts.get(text[start]) and here + unknown > best[end]:
                best[end], last[end] = here + unknown, start
            while end <= n:
                found = starts.get(text[start:end], 0)
                if found:
                    score = here + found[0]
                    if score > best[end]:
                        best[end], last[end] = score, start
                elif found == 0:
                    break
                end += 1
        return best, last

    def back(self, text: str, last: list[int], end: int) -> tuple[int, list[int]]:
        """Where the path to ``end`` entered, and its ids."""
        parts = []
        while last[end] >= 0:
            parts.append(text[last[end] : end])
            end = last[end]
        return end, [i for p in reversed(parts) for i in self.ids_of(p)]

    def word(self, text: str) -> bytes:
        """Packed ids of a marked word."""
        found = self.known.get(text)
        if found is None:
            m = _MARKS.search(text)
            if m and text[m.start() - 1 : m.start() + 1] not in self.bonds:
                found = self.word(text[: m.start()]) + self.word(m[0])
            else:
                found = self._fresh(text)
            self._remember(text, found)
        return found

    def _remember(self, text: str, found: bytes) -> None:
        """Keeps a word that was met before: most words of a corpus are met once, and would push out the others."""
        slot = hash(text) & (MET_SLOTS - 1)
        if not self.met[slot]:
            self.met[slot] = 1
            self.n_met += 1
            if self.n_met > MET_SLOTS // 2:
                self.met, self.n_met = bytearray(MET_SLOTS), 0
        elif len(text) < 64:
            if len(self.known) >= CACHE_WORDS:  # the older half goes
                self.known = {"": b""} | dict(islice(self.known.items(), CACHE_WORDS // 2, None))
            self.known[text] = found

    def score(self, ids: bytes) -> float:
        """Sum of the pieces' scores, in units; of a character's bytes the first has its score, the others none."""
        return float(self.scores[np.frombuffer(ids, "<u4")].sum())

    def _fresh(self, text: str) -> bytes:
        """As :meth:`scan` and :meth:`back` from a single entry, with each place's id kept on the way."""
        n, get, unknown = len(text), self.starts.get, self.unknown
        best, last, which = [_NONE] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
        best[0] = 0.0
        for start in range(n):
            here = best[start]
            end = start + 1
            found = get(text[start])
            if not found and here + unknown > best[end]:
                best[end], last[end], which[end] = here + unknown, start, -1
            while found != 0:
                if found and here + found[0] > best[end]:
                    best[end], last[end], which[end] = here + found[0], start, found[1]
                if end == n:
                    break
                end += 1
                found = get(text[start:end], 0)
        out = array("I")
        end = n
        while end:
            start = last[end]
            if which[end] >= 0:
                out.append(which[end])
            else:
                out.extend(reversed(self.ids_of(text[start:end])))
            end = start
        out.reverse()
        if sys.byteorder == "big":
            out.byteswap()
        return out.tobytes()

    def encode(self, text: str) -> tuple[float, bytes]:
        """Score in units and packed ids (32 bits each, little-endian) of the whole text."""
        if not text:
            return 0.0, b""
        known, word = self.known.get, self.word
        if "  " in text or _BLANK in text or text[0] == " " or text[-1] == " ":
            words = _WORDS.findall(marked(text))
        else:
            words = _BLANK + text.replace(" ", " " + _BLANK)
            words = (words.replace("\n", " \n ") if self.lines else words).split(" ")
        ids = b"".join([known(w) or word(w) for w in words])
        return self.score(ids), ids

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.text.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")[1:]


@functools.cache
def vocabulary_of(path: str) -> Vocabulary:
    """One vocabulary for each worker process."""
    return Vocabulary(path)


#: Marks at a word's end.
_MARKS = re.compile(r"(?<=\w)[!-/:-@\[-`{-~]+\Z")
_WORDS = re.compile(f"{_BLANK}*[^{_BLANK}]+|{_BLANK}+")
#: A place where every path has a boundary: before a blank that follows another character.
_CUT = re.compile(f"(?<=[^{_BLANK}]){_BLANK}")


def marked(text: str) -> str:
    return _BLANK + text.replace(" ", _BLANK) if text else ""


def cuts(text: str, size: int, longest: int) -> tuple[int, int] | None:
    """First place after all entries, and last place in the chunk, where every path has a boundary."""
    first = _CUT.search(text, longest, size)
    if not first:
        return None
    low = first.start()
    for back in (256, 4096, size):
        found = [m.start() for m in _CUT.finditer(text, max(low, size - back), size)]
        if found:
            return low, found[-1]
    return low, low


def transfer(vocabulary: Vocabulary, text: str, size: int) -> np.ndarray:
    """The chunk's matrix: best score from state i at its beginning to state j at its end.

    State k: the piece that crosses the boundary reaches k characters beyond it.
    ``text`` goes on beyond ``size``, the chunk's own length, as far as a piece can reach.
    """
    k = vocabulary.longest
    out = np.full((k, k), _NONE)
    found = cuts(text, size, k)
    ahead = min(k, len(text) - size + 1)
    if not found:
        for i in range(min(k, size + 1)):
            best, _ = vocabulary.scan(text, [_NONE] * i + [0.0], size)
            out[i, :ahead] = best[size : size + ahead]
        return out
    low, high = found
    head = [_NONE] * (low + 1)
    head[low] = 0.0
    for start in range(low - 1, -1, -1):
        for end in range(start + 1, min(start + k, low) + 1):
            piece = vocabulary.pieces.get(text[start:end])
            score = piece[0] if piece else vocabulary.unknown if end == start + 1 else _NONE
            head[start] = max(head[start], score + head[end])
    middle = vocabulary.score(b"".join([vocabulary.word(w) for w in _WORDS.findall(text[low:high])]))
    best, _ = vocabulary.scan(text[high:], [0.0], size - high)
    tail = best[size - high : size - high + ahead]
    out[:, :ahead] = np.array(head[:k])[:, None] + middle + np.array(tail)[None, :]
    return out


def combined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Product over (max, +): associative, so matrices may be combined in any grouping."""
    return (a[:, :, None] + b[None, :, :]).max(axis=1)


def way_in(vocabulary: Vocabulary, text: str, size: int, entry: list[float]) -> np.ndarray:
    """The chunk's map back, as a matrix: 0 where the best path to state i at its end came in by state j, else -inf.

    ``entry``: the best scores of the states at its beginning.
    """
    k = vocabulary.longest
    out = np.full((k, k), _NONE)
    found = cuts(text, size, k)
    if found:  # the path to the first cut tells how it came in, whatever follows
        _, last = vocabulary.scan(text[: found[0]], entry, found[0])
        out[:, vocabulary.back(text, last, found[0])[0]] = 0.0
        return out
    best, last = vocabulary.scan(text, entry, size)
    for i in range(min(k, len(text) - size + 1)):
        if best[size + i] > _NONE:
            out[i, vocabulary.back(text, last, size + i)[0]] = 0.0
    return out


def states(matrices: DataFrame, last: int, k: int, fan: int = FAN) -> DataFrame:
    """(row, at, state) of (row, at, m): the product of all matrices before each, from state 0.

    ``last``: the greatest ``at``. Blocks of ``fan`` matrices are multiplied first, and the
    blocks' products combined in the same way, so that no task has all of a long text.
    """
    first = np.array([0.0] + [_NONE] * (k - 1))

    def along(row: int, at: list[int], ms: list[bytes], state: np.ndarray) -> pd.DataFrame:
        out = []
        for m in ms:
            out.append(state.tobytes())
            state = combined(state[None, :], np.frombuffer(m).reshape(k, k))[0]
        return pd.DataFrame({"row": row, "at": at, "state": out})

    schema = "row long, at int, state binary"
    if last < fan:

        def whole(group: pd.DataFrame) -> pd.DataFrame:
            group = group.sort_values("at")
            return along(group["row"].iloc[0], list(group["at"]), list(group["m"]), first)

        return matrices.groupBy("row").applyInPandas(whole, schema)

    def product(group: pd.DataFrame) -> pd.DataFrame:
        ms = [np.frombuffer(m).reshape(k, k) for m in group.sort_values("at")["m"]]
        return pd.DataFrame({"row": group["row"].iloc[:1], "at": np.int32(group["at"].iloc[0] // fan), "m": [functools.reduce(combined, ms).tobytes()]})

    def inside(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("at")
        return along(group["row"].iloc[0], list(group["at"]), list(group["m"]), np.frombuffer(group["before"].iloc[0]))

    block = F.floor(F.col("at") / fan).cast("int").alias("block")
    blocks = matrices.groupBy("row", block).applyInPandas(product, "row long, at int, m binary")
    before = states(materialize(blocks, "products"), last // fan, k, fan).select("row", F.col("at").alias("block"), F.col("state").alias("before"))
    return matrices.withColumn("block", block).join(before, ["row", "block"]).groupBy("row", "block").applyInPandas(inside, schema)


def path_back(vocabulary: Vocabulary, text: str, size: int, entry: list[float], end: int) -> bytes:
    """Packed ids of the pieces that begin in the chunk."""
    found = cuts(text, size, vocabulary.longest)
    if not found:
        _, last = vocabulary.scan(text, entry, size)
        return np.array(vocabulary.back(text, last, size + end)[1], "<u4").tobytes()
    low, high = found
    _, last = vocabulary.scan(text[:low], entry, low)
    head = vocabulary.back(text[:low], last, low)[1]
    middle = b"".join([vocabulary.word(w) for w in _WORDS.findall(text[low:high])])
    _, last = vocabulary.scan(text[high:], [0.0], size - high)
    tail = vocabulary.back(text[high:], last, size - high + end)[1]
    return np.array(head, "<u4").tobytes() + middle + np.array(tail, "<u4").tobytes()


def chunks_of(text: str, longest: int, size: int = CHUNK) -> list[tuple[str, int]]:
    """(text with what a piece can reach beyond, own length) of each chunk; none is shorter than a piece."""
    whole = marked(text)
    n = max(1, len(whole) // size)
    edges = [i * size for i in range(n)] + [len(whole)]
    return [(whole[a : b + longest], b - a) for a, b in zip(edges, edges[1:], strict=False)]


_ARRAY, _PACKED = "ids array<int>", "ids binary"


def _schema(kind: str) -> str:
    return f"_key long, n_tokens long, {kind}, score double, round_trip boolean"


def _told(ids: bytes, kind: str):
    return np.frombuffer(ids, "<i4") if kind == _ARRAY else ids


def encode(docs: DataFrame, model: str, giant: int = GIANT, chunk: int = CHUNK) -> DataFrame:
    """Per document: doc_id, n_tokens, ids, score of the path in nats, and whether the decoded ids are the text."""
    return _encoded(docs, model, giant, chunk, _ARRAY)


def encode_packed(docs: DataFrame, model: str, giant: int = GIANT, chunk: int = CHUNK) -> DataFrame:
    """As :func:`encode`, with ids as bytes (32 bits each, little-endian) and ids_crc32, their checksum."""
    return _encoded(docs, model, giant, chunk, _PACKED).withColumn("ids_crc32", F.crc32("ids"))


def _encoded(docs: DataFrame, model: str, giant: int, chunk: int, kind: str) -> DataFrame:
    size = F.length(F.coalesce("text", F.lit("")))

    def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocabulary = vocabulary_of(model)
        out = Emitter(["_key", "n_tokens", "ids", "score", "round_trip"])
        for key, text in rows_of(batches, "_key", "text"):
            text = text_of(text)
            score, ids = vocabulary.encode(text)
            if out.add((key, len(ids) // 4, _told(ids, kind), score / UNIT, vocabulary.decode(ids) == text), 2 * len(ids)):
                yield out.frame()
        vocabulary.forget()
        give_back()
        yield out.frame()

    small = keyed(docs.where(size <= giant), "text").mapInPandas(whole, _schema(kind))
    return unkeyed(small.unionByName(_giants(docs.where(size > giant), model, chunk, kind)))


def _giants(docs: DataFrame, model: str, chunk: int, kind: str) -> DataFrame:
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    longest = vocabulary_of(model).longest

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for key, row, text in rows_of(batches, "_key", "row", "text"):
            parts = chunks_of(text_of(text), longest, chunk)
            yield pd.DataFrame({"_key": key, "row": row, "at": range(len(parts)), "chunks": len(parts), "part": [p for p, _ in parts], "size": [s for _, s in parts]})

    rows = keyed(docs, "text").withColumn("row", F.monotonically_increasing_id())
    parts = rows.mapInPandas(cut, "_key long, row long, at int, chunks int, part string, size int").repartition(n, "row", "at")
    parts = materialize(parts, "chunks")  # row numbers are given once
    last = (parts.agg(F.max("chunks")).first()[0] or 1) - 1

    def matrix(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocabulary = vocabulary_of(model)
        for row, at, part, size in rows_of(batches, "row", "at", "part", "size"):
            yield pd.DataFrame({"row": [row], "at": [np.int32(at)], "m": [transfer(vocabulary, part, size).tobytes()]})

    matrices = materialize(parts.mapInPandas(matrix, "row long, at int, m binary"), "matrices")
    entries = materialize(states(matrices, last, longest), "entries").withColumnRenamed("state", "entry")

    def back(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocabulary = vocabulary_of(model)
        for row, at, chunks, part, size, entry in rows_of(batches, "row", "at", "chunks", "part", "size", "entry"):
            m = way_in(vocabulary, part, size, np.frombuffer(entry).tolist())
            yield pd.DataFrame({"row": [row], "at": [np.int32(chunks - 1 - at)], "m": [m.tobytes()]})

    maps = materialize(parts.join(entries, ["row", "at"]).mapInPandas(back, "row long, at int, m binary"), "maps")
    ends = states(maps, last, longest).select("row", F.col("at").alias("from_end"), F.col("state").alias("exit"))

    def trace(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocabulary = vocabulary_of(model)
        for key, row, at, part, size, entry, end in rows_of(batches, "_key", "row", "at", "part", "size", "entry", "exit"):
            ids = path_back(vocabulary, part, size, np.frombuffer(entry).tolist(), int(np.frombuffer(end).argmax()))
            yield pd.DataFrame({"_key": [key], "row": [row], "at": [np.int32(at)], "ids": [ids], "text": [part[:size]]})

    both = parts.join(entries, ["row", "at"]).withColumn("from_end", F.col("chunks") - 1 - F.col("at")).join(ends, ["row", "from_end"])
    traced = both.mapInPandas(trace, "_key long, row long, at int, ids binary, text string")

    def gather(group: pd.DataFrame) -> pd.DataFrame:
        vocabulary = vocabulary_of(model)
        group = group.sort_values("at")
        ids = b"".join(group["ids"])
        same = vocabulary.decode(ids) == "".join(group["text"]).replace(_BLANK, " ")[1:]
        return pd.DataFrame({"_key": [group["_key"].iloc[0]], "n_tokens": [len(ids) // 4], "ids": [_told(ids, kind)], "score": [vocabulary.score(ids) / UNIT], "round_trip": [same]})

    return traced.groupBy("row").applyInPandas(gather, _schema(kind))


def decode(rows: DataFrame, model: str) -> DataFrame:
    """(doc_id, text) of rows of (doc_id, ids)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocabulary = vocabulary_of(model)
        for pdf in batches:
            yield pd.DataFrame({"_key": pdf["_key"], "text": ["" if x is None else vocabulary.decode(np.asarray(x, "<u4").tobytes()) for x in pdf["ids"]]})

    return unkeyed(keyed(rows, "ids").mapInPandas(run, "_key long, text string"))
