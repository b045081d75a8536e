"""Alignment of two tokenizers' tokens, with segments in place of documents.

A byte-level BPE (A, of the tokenizers library, with the usual pattern for words) and a BPE of
pieces (B, of sentencepiece, which puts a space before a text) encode the same bytes, space and
text. Places where tokens of both end cut the text into groups, and tokens whose bytes
overlap are linked.

Neither encodes a text as a whole: no token goes across the beginning of a run of white space,
which :class:`Tokenizers` verifies on both vocabularies, character by character. So texts are cut there,
every distinct segment of the corpus is tokenised and aligned once, and documents are composed:

* texts are read in blocks of BLOCK bytes; a block keeps its distinct segments as rows, and
  its documents as numbers of these segments (one compressed row);
* the blocks' segments meet by their bytes; each distinct one is encoded, many at a time, and
  aligned in numpy, and carries the blocks that have it;
* alignments go back to these blocks, and meet the block's documents. A segment, however
  frequent, is at most one row of a block, so no key is hot; a block is bounded, and so is what
  meets there;
* a pair of ids is counted once a document, summed in the block before it is shuffled, and its
  count goes to chunks of the distinct segments, again once a chunk. What a document adds up
  is then the sum over its segments.

Nulls: a null or empty text has no tokens and zeros; so has a text that one of the tokenizers
doesn't give back byte by byte (B reads U+2581 as a space), and neither's links are counted. A null doc_id is
a document like others; rows that repeat a doc_id are documents of their own. Ties: all B ids
with an A id's highest count are best. An empty table gives an empty one. A very long text
is cut as any other; a block is never less than a text, and a segment without white space is encoded whole.
Columns other than doc_id and text are never read, whatever their names.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citeweave.llm.common import give_back, keyed, mix, unkeyed
from citeweave.session import materialize

#: Bytes of texts after which a block ends, distinct segments after which a chunk ends, and bytes encoded at once.
BLOCK, CHUNK, TEXT = 16 << 20, 100_000, 1 << 16
#: Bits of a segment's number in its block.
_PLACE = 28
#: White space that texts may be cut before.
_BLANKS = b" \t\n\v\f\r"


def _after_blank(data: np.ndarray) -> np.ndarray:
    """Whether white space ends before each byte, or what may be: any byte up to 0x20, and the blocks of code points that have other white space."""
    blank = np.zeros(len(data) + 1, bool)
    blank[1:] = data <= 0x20
    if len(data) and data.max() >= 0xC2:
        blank[2:] |= (data[:-1] == 0xC2) & ((data[1:] == 0x85) | (data[1:] == 0xA0))
        high, low = data[:-2], data[1:-1]
        blank[3:] |= ((high == 0xE1) & (low == 0x9A)) | ((high == 0xE2) & ((low == 0x80) | (low == 0x81))) | ((high == 0xE3) & (low == 0x80))
    return blank


def cuts(data: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Places in UTF-8 bytes where a run of white space begins, of those bytes that ``before`` marks."""
    out = []
    for low in range(0, len(data), 1 << 20):  # with the three bytes before, on which a place depends
        at = max(0, low - 3)
        part = data[at : low + (1 << 20)]
        out.append(np.flatnonzero((before[part] & ~_after_blank(part)[:-1])[low - at :]) + low)
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def different(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, codes): of the byte ranges between edges, the place of each different one, and every range's number among these.

    Ranges meet by a 64-bit hash of their words of eight bytes, and every one is compared with the first of its hash.
    """
    start, size = edges[:-1], np.diff(edges)
    words = np.ndarray(len(data), "<u8", np.concatenate([data, np.zeros(8, np.uint8)]), strides=(1,))
    h = mix(size.astype(np.uint64))
    parts = [slice(low, low + (1 << 18)) for low in range(0, len(size), 1 << 18)]
    for part in parts:
        own = h[part]
        for left, word in _words(words, start[part], size[part]):
            own[left] = mix(own[left] + word * np.uint64(0x9E3779B97F4A7C15))
    first, codes = np.unique(h, return_index=True, return_inverse=True)[1:]
    del h
    same = np.ones(len(size), bool)
    for part in parts:
        like, own = first[codes[part]], same[part]
        own &= size[like] == size[part]
        if own.all():
            for (left, word), (_, other) in zip(_words(words, start[part], size[part]), _words(words, start[like], size[part]), strict=True):
                own[left] &= word == other
    if not same.all():  # two ranges of one hash: told apart by their bytes
        seen: dict[bytes, int] = {}
        codes = np.array([seen.setdefault(data[a:b].tobytes(), len(seen)) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)], np.int64)
        first = np.unique(codes, return_index=True)[1]
    return first, codes


def _words(words: np.ndarray, start: np.ndarray, size: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(which, word): the ranges that have a j-th word of eight bytes, and these words, zero beyond the range's end."""
    left, at = np.arange(len(start)), 0
    while True:
        left = left[size[left] > at]
        if not len(left):
            return
        word = words[start[left] + at]
        short = np.minimum(size[left] - at, 8).astype(np.uint64)
        yield left, word & (np.uint64(2**64 - 1) >> (np.uint64(64) - np.uint64(8) * short))
        at += 8


class Tokenizers:
    """Both tokenizers, their tokens' bytes, and the white space that neither merges with what stands before it."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        byte_of = _byte_level()
        vocabulary = self.a.get_vocab()
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            # A special token's string is no token of a text.
            self.a_bytes[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        self.b_bytes = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.a_size, self.b_size = (np.array([len(t) for t in x], np.int64) for x in (self.a_bytes, self.b_bytes))
        #: Marks the bytes that texts are cut before.
        self.before = np.zeros(256, bool)
        self.before[list(_BLANKS)] = True
        for token in {*self.a_bytes, *self.b_bytes}:
            if any(c <= 0x20 for c in token[1:]):
                data = np.frombuffer(token, np.uint8)
                places = cuts(data, self.before)
                self.before[data[places[places > 0]]] = False

    def _piece(self, i: int) -> bytes:
        if self.b.is_byte(i):
            return bytes([int(self.b.id_to_piece(i)[3:5], 16)])
        return self.b.id_to_piece(i).replace("▁", " ").encode()

    @property
    def pair(self) -> str:
        """Type of a pair's number, which is A's id times the number of B's ids, and B's id."""
        return "int" if len(self.a_bytes) * len(self.b_bytes) < 1 << 31 else "long"

    def ends(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
        """A's ids and B's, and where their tokens end, for bytes that begin with a space; None if one doesn't give them back."""
        text = data.decode()
        a = self.a.encode(text, add_special_tokens=False).ids
        b = self.b.encode(text[1:])
        if b"".join(map(self.a_bytes.__getitem__, a)) != data or b"".join(map(self.b_bytes.__getitem__, b)) != data:
            return None
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        return a, b, np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])

    def aligned(self, segments: list[bytes]) -> Iterator[tuple]:
        """(n_a, n_b, n_groups, pairs of linked ids, groups as text) of each segment, in order; no tokens where one isn't given back."""
        waiting, size = [], 0
        for s in segments:
            # A segment that ends with white space ended its text; another one may not follow it.
            alone = bool(_after_blank(np.frombuffer(s[-3:], np.uint8))[-1])
            if waiting and (alone or size + len(s) > TEXT):
                yield from self._together(waiting)
                waiting, size = [], 0
            waiting.append(s)
            size += len(s)
            if alone:
                yield from self._together(waiting)
                waiting, size = [], 0
        if waiting:
            yield from self._together(waiting)

    def _together(self, segments: list[bytes]) -> Iterator[tuple]:
        # A word before the first segment, so that all are alike.
        found = self.ends(b" x" + b"".join(segments))
        if found is None:
            if len(segments) == 1:
                yield 0, 0, 0, [], b""
                return
            half = len(segments) // 2
            yield from self._together(segments[:half])
            yield from self._together(segments[half:])
            return
        a, b, a_ends, b_ends = found
        borders = np.cumsum([2, *map(len, segments)])
        common = np.intersect1d(a_ends, b_ends, assume_unique=True)
        if len(np.setdiff1d(borders, common, assume_unique=True)):
            raise ValueError("a token goes across the border of segments")
        # Between two neighbouring ends of either tokenizer, one token of each overlaps the other.
        links = np.union1d(a_ends, b_ends)
        pairs = (a[np.searchsorted(a_ends, links)] * len(self.b_bytes) + b[np.searchsorted(b_ends, links)]).tolist()
        a_at, b_at = np.searchsorted(a_ends, common) + 1, np.searchsorted(b_ends, common) + 1
        groups = np.searchsorted(common, borders) + 1
        of_a, of_b, of_links = a_at[groups - 1].tolist(), b_at[groups - 1].tolist(), (np.searchsorted(links, borders) + 1).tolist()
        a_at, b_at, groups = a_at.tolist(), b_at.tolist(), groups.tolist()
        a, b = list(map(str, a.tolist())), list(map(str, b.tolist()))
        for i in range(len(segments)):
            low, high = groups[i], groups[i + 1]
            text = ";".join(f"{','.join(a[a_at[g - 1] : a_at[g]])}|{','.join(b[b_at[g - 1] : b_at[g]])}" for g in range(low, high))
            yield of_a[i + 1] - of_a[i], of_b[i + 1] - of_b[i], high - low, pairs[of_links[i] : of_links[i + 1]], text.encode()


def _byte_level() -> dict[str, int]:
    """The bytes that the characters of byte-level tokens stand for: printable ones for themselves, others from U+0100 on in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [c for c in range(256) if c not in plain]
    return {chr(c): c for c in plain} | {chr(256 + i): c for i, c in enumerate(others)}


@functools.cache
def tokenizers_of(a_path: str, b_path: str) -> Tokenizers:
    """Both tokenizers, once for each worker process."""
    return Tokenizers(a_path, b_path)


def _packed(keys: np.ndarray, counts: np.ndarray, codes: np.ndarray) -> bytes:
    """A block's documents, compressed: the bytes of all numbers by their place, all lowest ones first."""
    head = np.array([len(keys), len(codes)], "<i8").tobytes()
    parts = (np.ascontiguousarray(a.astype(kind).view(np.uint8).reshape(len(a), int(kind[2])).T) for a, kind in ((keys, "<i8"), (counts, "<i4"), (codes, "<i4")))
    return zstandard.compress(head + b"".join(x.tobytes() for x in parts), 3)


def _unpacked(data: bytes) -> list[np.ndarray]:
    """(keys, counts, codes)."""
    data = np.frombuffer(zstandard.decompress(data), np.uint8)
    n, codes = data[:16].view("<i8").tolist()
    at, out = 16, []
    for size, kind, width in ((n, "<i8", 8), (n, "<i4", 4), (codes, "<i4", 4)):
        out.append(np.ascontiguousarray(data[at : at + size * width].reshape(width, size).T).view(kind).ravel())
        at += size * width
    return out


def segmented(docs: DataFrame, before: np.ndarray) -> DataFrame:
    """Rows of blocks: (block, place, segment) of each distinct segment, and (block, -1, null, documents).

    ``documents`` packs the documents' keys, how many segments each has, and the segments' places. ``before`` marks the
    bytes that texts are cut before.
    """
    fields = pa.schema([("block", pa.int64()), ("place", pa.int32()), ("segment", pa.binary()), ("documents", pa.binary())])

    def block_rows(block: int, keys: np.ndarray, texts: pa.Array) -> Iterator[pa.RecordBatch]:
        edges = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[edges[0] : edges[-1]]
        edges -= edges[0]
        borders = np.union1d(cuts(data, before), edges)
        counts = np.diff(np.searchsorted(borders, edges))
        first, codes = different(data, borders)
        # The most frequent ones first, whose numbers then compress best.
        order = np.argsort(-np.bincount(codes, minlength=len(first)), kind="stable")
        place = np.empty(len(order), "<i4")
        place[order] = np.arange(len(order))
        yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([-1], pa.int32()), pa.array([None], pa.binary()), pa.array([_packed(keys, counts, place[codes])], pa.binary())], schema=fields)
        if len(first) >= 1 << _PLACE:
            raise ValueError("a block has too many segments")
        for low in range(0, len(first), CHUNK):
            own = first[order[low : low + CHUNK]]
            size = borders[own + 1] - borders[own]
            ends = np.concatenate([[0], np.cumsum(size)])
            values = data[np.repeat(borders[own] - ends[:-1], size) + np.arange(ends[-1])]
            segments = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(own), [None, pa.py_buffer(ends), pa.py_buffer(values)]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), block)), pa.array(np.arange(low, low + len(own), dtype=np.int32)), segments, pa.nulls(len(own), pa.binary())], schema=fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 13
        waiting: list[pa.RecordBatch] = []
        held = 0

        def hand_on() -> Iterator[pa.RecordBatch]:
            whole = pa.Table.from_batches(waiting).combine_chunks()
            return block_rows(block, whole["_key"].to_numpy(), pa.concat_arrays(whole["text"].chunks))

        for batch in batches:
            size = np.cumsum(pa.compute.fill_null(pa.compute.binary_length(batch.column("text")), 0).to_numpy())
            low = 0
            while low < len(size):  # as many rows as the block still takes, one at least
                high = max(low + 1, int(np.searchsorted(size, (size[low - 1] if low else 0) + BLOCK - held, "right")))
                waiting.append(batch.slice(low, high - low))
                held += int(size[high - 1] - (size[low - 1] if low else 0))
                low = high
                if held >= BLOCK or low < len(size):
                    yield from hand_on()
                    waiting, held = [], 0
                    block += 1
        if waiting:
            yield from hand_on()
        give_back()

    text = F.when(F.length("text") > 0, F.concat(F.lit(" "), "text")).cast("binary").alias("text")
    return keyed(docs.select("doc_id", text), "text").mapInArrow(run, "block long, place int, segment binary, documents binary")


def aligned_segments(segments: DataFrame, a_path: str, b_path: str, pair: str) -> DataFrame:
    """Each distinct segment once: (chunk, places, n_a, n_b, n_groups, pairs, groups).

    ``places`` are the blocks that have it, with its number there; there are as many as blocks at most.
    """
    kinds = {"chunk": pa.int64(), "places": pa.list_(pa.int64()), "n_a": pa.int32(), "n_b": pa.int32(), "n_groups": pa.int32(), "pairs": pa.list_(pa.int32() if pair == "int" else pa.int64()), "groups": pa.binary()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        both = tokenizers_of(a_path, b_path)
        chunk, held = TaskContext.get().partitionId() << 24, 0
        found: list[bytes] = []
        places: list[list[np.ndarray]] = []

        def hand_on(n: int) -> pa.RecordBatch:
            nonlocal found, places, chunk, held
            rows = list(zip(*both.aligned(found[:n]), strict=True))
            own = [np.concatenate(x) for x in places[:n]]
            edges = np.concatenate([[0], np.cumsum([len(x) for x in own])]).astype(np.int32)
            cols = [pa.array(np.full(n, chunk)), pa.ListArray.from_arrays(edges, np.concatenate(own)), *(pa.array(c, t) for c, t in zip(rows, list(kinds.values())[2:], strict=True))]
            found, places, held = found[n:], places[n:], held + n
            if held >= CHUNK:
                chunk, held = chunk + 1, 0
            return pa.RecordBatch.from_arrays(cols, names=list(kinds))

        for batch in batches:  # sorted by segment
            segment = batch.column("segment")
            if not len(segment):
                continue
            new = np.concatenate([[True], pa.compute.not_equal(segment[1:], segment[:-1]).to_numpy(zero_copy_only=False)])
            at = np.flatnonzero(new)
            of = np.split(batch.column("at").to_numpy(), at[1:])
            values = segment.take(pa.array(at)).to_pylist()
            if found and found[-1] == values[0]:
                places[-1].append(of[0])
                values, of = values[1:], of[1:]
            found += values
            places += [[x] for x in of]
            if len(found) > 10_000:
                yield hand_on(len(found) - 1)
        if found:
            yield hand_on(len(found))
        give_back()

    rows = segments.select("segment", (F.shiftleft("block", _PLACE) + F.col("place")).alias("at"))
    rows = rows.repartition("segment").sortWithinPartitions("segment")
    return rows.mapInArrow(run, f"chunk long, places array<long>, n_a int, n_b int, n_groups int, pairs array<{pair}>, groups binary")


def _at_blocks(rows: DataFrame, *cols: str) -> DataFrame:
    """A row for each block that has the segment."""
    rows = rows.select(F.explode("places").alias("at"), *cols)
    return rows.select(F.shiftright("at", _PLACE).alias("block"), F.col("at").bitwiseAND((1 << _PLACE) - 1).cast("int").alias("place"), *cols)


def _lists(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(edges, values) of a column of lists."""
    whole = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    edges = whole.offsets.to_numpy().astype(np.int64)
    return edges - edges[0], whole.flatten().to_numpy()


def _gathered(edges: np.ndarray, values: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The values of these lists, one after another."""
    size = edges[which + 1] - edges[which]
    ends = np.cumsum(size)
    return values[np.repeat(edges[which] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)]


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of as many values as each document has segments."""
    total = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]


def _composed(left: pa.Table, right: pa.Table) -> pa.Table:
    """One block: a row for each document, with its place in the block, and for each pair of ids the number of documents that link it."""
    keys, counts, codes = _unpacked(left["documents"][0].as_py())
    counts = counts.astype(np.int64)
    right = right.take(np.argsort(right["place"].to_numpy()))
    columns = {c: right[c].to_numpy().astype(np.int64) for c in ("n_a", "n_b", "n_groups")}
    edges, pairs = _lists(right["pairs"])
    columns["n_links"] = np.diff(edges)
    groups = right["groups"].to_pylist()
    whole = _sums((columns["n_a"] == 0)[codes], counts) == 0
    sums = {c: np.where(whole, _sums(v[codes], counts), 0) for c, v in columns.items()}
    known, of_pair = np.unique(pairs, return_inverse=True)
    documents = np.zeros(len(known), np.int64)
    shas, ends = [], np.cumsum(counts).tolist()
    for i, (high, n) in enumerate(zip(ends, counts.tolist(), strict=True)):
        if not whole[i] or not n:
            shas.append("")
            continue
        own = codes[high - n : high]
        shas.append(hashlib.sha256(b";".join([groups[c] for c in own.tolist()])).hexdigest())
        documents[np.unique(_gathered(edges, of_pair, np.unique(own)))] += 1
    some = np.flatnonzero(documents)
    none, block = pa.nulls(len(some), pa.int64()), left["block"][0].as_py()
    n = len(keys)
    of_docs = [np.full(n, block), np.arange(n, dtype=np.int32), keys, *sums.values(), pa.array(shas, pa.string()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64())]
    of_pairs = [np.full(len(some), block), np.full(len(some), -1, np.int32), none, none, none, none, none, pa.nulls(len(some), pa.string()), known[some].astype(np.int64), documents[some]]
    give_back()
    fields = pa.schema([(c, pa.int64()) for c in ("block",)] + [("row", pa.int32())] + [(c, pa.int64()) for c in ("_key", *sums)] + [("groups_sha256", pa.string()), ("pair", pa.int64()), ("documents", pa.int64())])
    return pa.concat_tables(pa.Table.from_arrays([pa.array(c, f.type) if isinstance(c, np.ndarray) else c for c, f in zip(part, fields, strict=True)], schema=fields) for part in (of_docs, of_pairs))


def _weighed(left: pa.Table, right: pa.Table) -> pa.Table:
    """One chunk of segments: how many of a segment's links are best, and the sum of their counts.

    A pair that only documents without tokens link has no count; they have none to sum either.
    """
    edges, pairs = _lists(left["pairs"])
    right = right.sort_by("pair")
    known = np.append(right["pair"].to_numpy(), -1)
    at = np.searchsorted(known[:-1], pairs)
    size, found = np.diff(edges), known[at] == pairs
    best, count = (np.append(right[c].to_numpy(zero_copy_only=False).astype(np.int64), 0)[at] for c in ("best", "documents"))
    return pa.table({"places": left["places"], "n_best": _sums(np.where(found, best, 0), size), "count_sum": _sums(np.where(found, count, 0), size)})


def _added(left: pa.Table, right: pa.Table) -> pa.Table:
    """One block: the documents' sums over their segments."""
    keys, counts, codes = _unpacked(left["documents"][0].as_py())
    order = np.argsort(right["place"].to_numpy())
    sums = {c: _sums(right[c].to_numpy()[order][codes], counts.astype(np.int64)) for c in ("n_best", "count_sum")}
    return pa.table({"block": np.full(len(keys), left["block"][0].as_py()), "row": np.arange(len(keys), dtype=np.int32), **sums})


def pair_counts(composed: DataFrame, n_b: int) -> DataFrame:
    """(pair, documents, best): in how many documents ids are linked; a pair is A's id times ``n_b`` and B's id."""
    pairs = composed.where("row < 0").groupBy("pair").agg(F.sum("documents").alias("documents"))
    most = F.max("documents").over(Window.partitionBy(F.col("pair") - F.col("pair") % n_b))  # an A id has as many pairs as B has pieces at most
    return pairs.withColumn("best", F.col("documents") == most)


def align(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    both = tokenizers_of(a_path, b_path)
    blocks = materialize(segmented(docs, both.before), "blocks", compression="zstd")
    packed = blocks.where("place < 0").select("block", "documents")
    segments = materialize(aligned_segments(blocks.where("place >= 0"), a_path, b_path, both.pair), "segments", compression="zstd")
    back = _at_blocks(segments, "n_a", "n_b", "n_groups", "pairs", "groups")
    composed = packed.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(
        _composed, "block long, row int, _key long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pair long, documents long"
    )
    composed = materialize(composed, "composed")
    wanted = segments.select("chunk", F.explode("pairs").alias("pair")).distinct().join(pair_counts(composed, len(both.b_bytes)), "pair")
    wanted = wanted.select(F.col("chunk").alias("of"), "pair", "documents", "best")
    weighed = segments.select("chunk", "places", "pairs").groupBy("chunk").cogroup(wanted.groupBy("of")).applyInArrow(_weighed, "places array<long>, n_best long, count_sum long")
    back = _at_blocks(weighed, "n_best", "count_sum")
    added = packed.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(_added, "block long, row int, n_best long, count_sum long")
    rows = composed.where("row >= 0").drop("pair", "documents").join(added, ["block", "row"])
    whole = F.col("groups_sha256") != ""
    return unkeyed(rows.select("_key", "n_a", "n_b", "n_groups", "n_links", F.when(whole, F.col("n_best")).otherwise(0).alias("n_best"), F.when(whole, F.col("count_sum")).otherwise(0).alias("count_sum"), "groups_sha256"))
