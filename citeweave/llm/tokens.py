"""Token ids in a binary format with a shared zstandard dictionary.

A dictionary is trained on the serialized id arrays of a bounded sample of documents.
Every document is then compressed by itself, so that one short document can be read
without its neighbours. Documents stand in ascending order of ids in segments:

    magic, version, bytes an id takes, sha256 of the dictionary, number of documents,
    ids of documents (int64 each), null flags, id counts before each document,
    offsets of the frames, frames

A segment is one row of a Parquet table with its range of doc_id and id counts beside
it, so that any store that Spark writes will do and a lookup reads few segments.

Nulls: a null text is empty and has only the end id; a null doc_id comes before all
others. Ties: of sampled documents with one hash the least id goes first. Rows that repeat a doc_id follow each other, in the order of their frames. An
empty table gives no segment. Of a very long text a task holds the ids and, at a time, the
words of one block. Columns other than doc_id and text are never read.
"""

from __future__ import annotations

import functools
import hashlib
import re
import struct
import sys
import unicodedata
import zlib
from array import array
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from citeweave.llm.common import LEAST, Emitter, IdRanges, give_back, keyed, ordered_key, rows_of, text_of, unkeyed
from citeweave.session import materialize, scratch_path

END = 2
#: Documents that the dictionary is trained on (those of least hash), and bytes of their id arrays at most,
#: of which none takes more than an eighth.
SAMPLE, SAMPLE_BYTES = 1000, 32 << 20
DICTIONARY_BYTES = 64 << 10
LEVEL = 3
#: Compressed bytes after which a segment ends.
SEGMENT_BYTES = 1 << 20
#: Words whose ids a task remembers.
CACHE_WORDS = 600_000
#: Code points whose words are told apart at once, and texts encoded at once.
BLOCK_CHARS, TEXTS = 1 << 21, 1000

_MAGIC = b"CWTK"
_HEAD = struct.Struct("<4sBB32sQ")


#: A word's end: ASCII marks, without the apostrophe, that follow a letter or digit.
_MARKS = re.compile(r"(?<=[^\W_])[!-&(-/:-@\[-`{-~]+\Z")


class Encoder:
    """Encodes texts with a tokenizer that drops white space and case, remembering the ids of words.

    Such a tokenizer works on each word between blanks by itself, and splits marks from
    the letters before them, so that a text's ids are its words' ids one after another.
    Texts with special tokens, or with letters whose lower case depends on their
    neighbours, keep their case and marks until the tokenizer sees them.

    Words are told apart for a block of texts at once, in Arrow; Python sees each of a
    block's different words once.
    """

    def __init__(self, path: str, end: int = END):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.kind = "H" if self.width == 2 else "I"
        self.end = self._packed([end])
        # Whether an id ends a word, where the vocabulary says so.
        vocabulary = self.tokenizer.get_vocab()
        self.ends = None
        if any(t.endswith("</w>") for t in vocabulary):
            self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
            self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.quick = self._unread(path)
        self.known: dict[str, bytes] = {"": b""}

    def _unread(self, path: str):
        """The tokenizer without the steps that leave lower-cased letters and blanks as they are; None if it differs on a trial."""
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        if self.ends is None:
            return None
        quick = Tokenizer.from_file(path)
        quick.normalizer = normalizers.Sequence([])
        quick.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Split(" ", "removed"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        trial = "an unquestionably ñandú straße überall œuvre ζωή жизнь qqzxv a"
        same = quick.encode(trial, add_special_tokens=False).ids == self.tokenizer.encode(trial, add_special_tokens=False).ids
        return quick if same else None

    def _packed(self, ids: list[int]) -> bytes:
        out = array(self.kind, ids)
        if sys.byteorder == "big":
            out.byteswap()
        return out.tobytes()

    def _learn(self, words: list[str], lowered: bool) -> None:
        """Words of letters only are one token run each, and are encoded in one call: a run ends where a word does."""
        plain, others = [], []
        for w in words:
            (plain if w.isalpha() else others).append(w)
        if plain and self.ends is not None:
            joined = " ".join(plain)
            # Latin, Greek and Cyrillic letters in normal form; of others the tokenizer's own tables may say more.
            usual = lowered and self.quick is not None and max(joined) < "\u0530" and unicodedata.is_normalized("NFC", joined)
            found = (self.quick if usual else self.tokenizer).encode_batch_fast([joined], add_special_tokens=False)[0]
            ids = np.array(found.ids, np.int64)
            at = (np.flatnonzero(self.ends[ids]) + 1) * self.width
            if len(at) == len(plain):
                data, low = ids.astype(f"<u{self.width}").tobytes(), 0
                for w, high in zip(plain, at.tolist(), strict=True):
                    self.known[w] = data[low:high]
                    low = high
                words = others
        for w, e in zip(words, self.tokenizer.encode_batch_fast(words, add_special_tokens=False), strict=True):
            self.known[w] = self._packed(e.ids)

    def _meet(self, words: Iterable[str], lowered: bool) -> None:
        """Learns the words that aren't known; of lower-cased ones, marks at a word's end by themselves."""
        if len(self.known) > CACHE_WORDS:  # the older half goes
            self.known = {"": b""} | dict(islice(self.known.items(), len(self.known) // 2, None))
        known = self.known
        new = [w for w in words if w not in known]
        if new:
            parts = {w: (w[: m.start()], m[0]) for w in new if not w.isalpha() and (m := _MARKS.search(w))} if lowered else {}
            self._learn(list({p for w in new for p in parts.get(w, (w,)) if p not in known}), lowered)
            for w, (body, marks) in parts.items():
                known[w] = known[body] + known[marks]

    def encode(self, text: str) -> bytes:
        """The ids and the end id, ``width`` bytes each, little-endian."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """As :meth:`encode`, of every text; long ones go piece by piece, cut at blanks."""
        out: list[list[bytes]] = [[] for _ in texts]
        block: list[tuple[int, str]] = []
        held = 0
        for i, text in enumerate(texts):
            if "<|" in text or "\u03a3" in text or "\u0130" in text:
                words = text.replace("\n", " ").split(" ")
                self._meet(set(words), False)
                out[i] = [b"".join(map(self.known.__getitem__, words))]
                continue
            text = text.lower().replace("\n", " ")
            while text:
                cut = text.find(" ", BLOCK_CHARS) if len(text) > BLOCK_CHARS else -1
                part, text = (text, "") if cut < 0 else (text[:cut], text[cut + 1 :])
                block.append((i, part))
                held += len(part)
                if held >= BLOCK_CHARS:
                    self._encode_block(block, out)
                    block, held = [], 0
        if block:
            self._encode_block(block, out)
        return [b"".join(parts) + self.end for parts in out]

    def _encode_block(self, block: list[tuple[int, str]], out: list[list[bytes]]) -> None:
        words = pc.split_pattern(pa.array([t for _, t in block], pa.large_string()), " ")
        coded = words.flatten().dictionary_encode()
        different = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        self._meet(different, True)
        ids = [self.known[w] for w in different]
        data = np.frombuffer(b"".join(ids), f"<u{self.width}")
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // self.width
        starts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
        at = coded.indices.to_numpy()
        n = sizes[at]
        ends = np.cumsum(n)
        all_ids = data[np.repeat(starts[at] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)]
        edges = np.concatenate([[0], ends])[words.offsets.to_numpy() - words.offsets[0].as_py()].tolist()
        for (i, _), low, high in zip(block, edges, edges[1:], strict=False):
            out[i].append(all_ids[low:high].tobytes())


@functools.cache
def encoder_of(path: str) -> Encoder:
    """One encoder for each worker process: later tasks find the words of earlier ones."""
    return Encoder(path)


def _encoded(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(_key, ids as bytes) of every row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = encoder_of(tokenizer)
        for pdf in batches:
            yield pd.DataFrame({"_key": pdf["_key"], "ids": encoder.encode_all([text_of(t) for t in pdf["text"]])})

    return keyed(docs, "text").mapInPandas(run, "_key long, ids binary")


def train(docs: DataFrame, tokenizer: str, sample: int = SAMPLE, most_bytes: int = SAMPLE_BYTES) -> bytes:
    """A dictionary from the whole arrays of ``sample`` documents; empty where these are too few to train one."""
    ids = [r._key for r in keyed(docs).select("_key", F.xxhash64("_key").alias("h")).distinct().orderBy("h", "_key").limit(sample).collect()]
    chosen = _encoded(docs.where(ordered_key("doc_id").isin(ids)), tokenizer).withColumn("h", F.xxhash64("_key"))
    chosen = materialize(chosen.where(F.length("ids") <= most_bytes // 8), "sample")
    order = Window.orderBy("h", "_key", "ids")  # of the sample's rows alone
    samples = chosen.orderBy("h", "_key", "ids").limit(sample).withColumn("so_far", F.sum(F.length("ids")).over(order)).where(F.col("so_far") <= most_bytes)
    samples = [bytes(r.ids) for r in samples.orderBy("so_far").select("ids").collect()]
    size = min(DICTIONARY_BYTES, sum(map(len, samples)) // 8)
    try:
        return zstandard.train_dictionary(size, samples).as_bytes() if size >= 1024 else b""
    except zstandard.ZstdError:
        return b""


def write(docs: DataFrame, path: str, tokenizer: str, sample: int = SAMPLE) -> None:
    """Writes ``path``/dictionary and ``path``/segments."""
    spark = docs.sparkSession
    shared = train(docs, tokenizer, sample)
    digest = hashlib.sha256(shared).digest()
    spark.createDataFrame([(digest.hex(), shared)], "sha256 string, dictionary binary").coalesce(1).write.parquet(f"{path}/dictionary")
    ranges = IdRanges(docs, "doc_id")

    def compress(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = encoder_of(tokenizer)
        packer = _compressor(shared)
        out = Emitter(["_key", "n", "frame"])
        for pdf in batches:
            keys, texts = pdf["_key"].tolist(), [text_of(t) for t in pdf["text"]]
            for at in range(0, len(keys), TEXTS):
                for key, ids in zip(keys[at : at + TEXTS], encoder.encode_all(texts[at : at + TEXTS]), strict=True):
                    if out.add((key, len(ids) // encoder.width, packer.compress(ids)), len(ids)):
                        yield out.frame().assign(bucket=lambda x: ranges.bucket(x["_key"]), width=np.int8(encoder.width))
        give_back()
        yield out.frame().assign(bucket=lambda x: ranges.bucket(x["_key"]), width=np.int8(encoder.width))

    frames = keyed(docs, "text").mapInPandas(compress, "_key long, n long, frame binary, bucket int, width byte")
    frames = frames.repartitionById(ranges.n, F.col("bucket")).sortWithinPartitions("bucket", "_key", "frame")

    def segment(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        where, seq, before, size = None, 0, 0, 0
        rows: list[tuple[int, int, bytes, int]] = []

        def done() -> pd.DataFrame:
            nonlocal rows, seq, before, size
            n = sum(r[1] for r in rows)
            out = pd.DataFrame({"bucket": [np.int32(where)], "seq": [np.int32(seq)], "first": [rows[0][0]], "last": [rows[-1][0]], "n_ids": [n], "before": [before], "data": [pack(rows, digest)]})
            rows, seq, before, size = [], seq + 1, before + n, 0
            return out

        for bucket, key, n, frame, width in rows_of(batches, "bucket", "_key", "n", "frame", "width"):
            if rows and (bucket != where or size >= SEGMENT_BYTES):
                yield done()
            if bucket != where:
                where, seq, before = bucket, 0, 0
            rows.append((int(key), int(n), frame, int(width)))
            size += len(frame) + 33
        if rows:
            yield done()

    schema = "bucket int, seq int, first long, last long, n_ids long, before long, data binary"
    frames.mapInPandas(segment, schema).write.parquet(f"{path}/segments")


def _compressor(shared: bytes) -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(shared) if shared else None, write_content_size=True)


def pack(rows: list[tuple[int, int, bytes, int]], digest: bytes) -> bytes:
    """One segment of (key, number of ids, frame, bytes an id takes)."""
    keys = np.array([r[0] for r in rows], "<i8")
    starts = np.concatenate([[0], np.cumsum([r[1] for r in rows])]).astype("<u8")
    at = np.concatenate([[0], np.cumsum([len(r[2]) for r in rows])]).astype("<u8")
    flags = (keys == LEAST).astype(np.uint8)
    return b"".join([_HEAD.pack(_MAGIC, 1, rows[0][3], digest, len(rows)), keys.tobytes(), flags.tobytes(), starts.tobytes(), at.tobytes(), *[r[2] for r in rows]])


class Segment:
    """Reads a segment; a document's frame is found by the offset index and decompressed alone."""

    def __init__(self, data: bytes, shared: bytes):
        magic, version, self.width, digest, n = _HEAD.unpack_from(data)
        if magic != _MAGIC or version != 1:
            raise ValueError("this is no token segment")
        if digest != hashlib.sha256(shared).digest():
            raise ValueError("the segment was written with another dictionary")
        at = _HEAD.size
        self.keys = np.frombuffer(data, "<i8", n, at)
        self.starts = np.frombuffer(data, "<u8", n + 1, at + 9 * n)
        self.at = np.frombuffer(data, "<u8", n + 1, at + 17 * n + 8)
        self.data, self.base = data, at + 25 * n + 16
        self.unpacker = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(shared) if shared else None)

    def ids(self, i: int) -> np.ndarray:
        frame = self.data[self.base + int(self.at[i]) : self.base + int(self.at[i + 1])]
        return np.frombuffer(self.unpacker.decompress(frame), f"<u{self.width}")


def read(spark: SparkSession, path: str) -> DataFrame:
    """Per document: doc_id, start (ids of all documents before it), n_tokens, ids_crc32 (of 32-bit ids)."""
    shared = bytes(spark.read.parquet(f"{path}/dictionary").first().dictionary)
    segments = spark.read.parquet(f"{path}/segments")
    base, total = {}, 0
    for r in segments.groupBy("bucket").agg(F.sum("n_ids").alias("n")).orderBy("bucket").collect():  # one row a range
        base[r.bucket] = total
        total += r.n

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for bucket, before, data in rows_of(batches, "bucket", "before", "data"):
            s = Segment(bytes(data), shared)
            ids = [s.ids(i) for i in range(len(s.keys))]
            crc = [zlib.crc32(x.astype("<u4").tobytes()) for x in ids]
            yield pd.DataFrame({"_key": s.keys, "start": s.starts[:-1].astype(np.int64) + base[bucket] + before, "n_tokens": [len(x) for x in ids], "ids_crc32": crc})

    return unkeyed(segments.select("bucket", "before", "data").mapInPandas(unpack, "_key long, start long, n_tokens long, ids_crc32 long"))


def lookup(spark: SparkSession, path: str, doc_id: int) -> list[np.ndarray]:
    """The id arrays of one doc_id: reads the segments whose range holds it, and of these its frames."""
    shared = bytes(spark.read.parquet(f"{path}/dictionary").first().dictionary)
    rows = spark.read.parquet(f"{path}/segments").where((F.col("first") <= doc_id) & (F.col("last") >= doc_id)).orderBy("bucket", "seq").collect()
    out = []
    for r in rows:
        s = Segment(bytes(r.data), shared)
        out += [s.ids(int(i)) for i in np.flatnonzero(s.keys == doc_id)]
    return out


def write_and_read(docs: DataFrame, tokenizer: str, name: str = "tokens") -> DataFrame:
    path = scratch_path(docs.sparkSession, name)
    write(docs, path, tokenizer)
    return read(docs.sparkSession, path)
