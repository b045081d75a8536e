"""Fill-in-the-middle: texts are cut at token borders and rearranged so that a model learns to fill gaps.

A token is a run of ASCII letters or any other single code point. Texts are never split into
a list of tokens: ``bytes.translate`` turns the UTF-8 bytes of a text into two big integers of a
bit for each byte, those of letters and those that begin a code point. A shift and two
boolean operations leave the bits where tokens begin, ``bit_count`` gives their number, and
the byte where the k-th token begins is found by halving the integer again and again.

Nulls: a null text is empty; a null doc_id is drawn as the empty string. An empty text, and one
that contains a marker, stays plain. Rows that repeat a doc_id are cut alike where their
texts are equal. An empty table gives an empty one. A very long text is one integer of as many
bits as it has bytes, and all its operations are linear. Columns other than doc_id and text are
never read, whatever their names. There are no ties: draws are numbers of a hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeweave.llm.common import LEAST, give_back, keyed, unkeyed

#: Markers before prefix, suffix and middle.
MARKERS = ("<P>", "<S>", "<M>")
#: Of 100 texts, those from PLAIN on stay as they are; of 100 others, the first SPM have the suffix first.
PLAIN, SPM = 90, 20
SEED = "1"
#: Bytes of texts that leave a task at once.
BLOCK = 16 << 20

_LETTERS = bytes(49 if chr(c).isalpha() and c < 128 else 48 for c in range(256))
_BEGINS = bytes(48 if 0x80 <= c < 0xC0 else 49 for c in range(256))
_SCHEMA = "_key long, n long, form string, prefix_chars long, middle_chars long, output string"


def masks(data: bytes) -> tuple[int, int]:
    """(begins, tokens): the bits of bytes that begin a code point, and of those that begin a token; the first byte's bit is the highest."""
    if not data:
        return 0, 0
    letters, begins = int(data.translate(_LETTERS), 2), int(data.translate(_BEGINS), 2)
    return begins, begins & ~(letters & (letters >> 1))


def place_of(bits: int, size: int, rank: int) -> int:
    """How many of ``size`` bits stand before the set bit that has ``rank`` set bits before it; ``size`` if there is none."""
    if rank >= bits.bit_count():
        return size
    at = 0
    while size > 1:
        rest = size >> 1
        first = bits >> rest
        n = first.bit_count()
        if rank < n:
            bits, size = first, size - rest
        else:
            bits, rank, at, size = bits & ((1 << rest) - 1), rank - n, at + size - rest, rest
    return at


def draws(key: int, seed: str = SEED) -> list[int]:
    """Four numbers of 32 bits that the seed and the id decide."""
    digest = hashlib.sha256(f"{seed}:{'' if key == LEAST else key}".encode()).digest()
    return [int.from_bytes(digest[4 * i : 4 * i + 4], "big") for i in range(4)]


def rearranged(data: bytes, h: list[int], markers: tuple[bytes, ...]) -> tuple[int, str, int | None, int | None, bytes]:
    """(tokens, form, code points of the prefix, of the middle, output) of one text."""
    begins, tokens = masks(data)
    n, size = tokens.bit_count(), len(data)
    if not data or h[2] % 100 >= PLAIN or any(m in data for m in markers):
        return n, "plain", None, None, data
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    a, b = place_of(tokens, size, low), place_of(tokens, size, high)
    prefix, middle, suffix = data[:a], data[a:b], data[b:]
    before_a, before_b = (begins >> (size - a)).bit_count(), (begins >> (size - b)).bit_count()
    p, s, m = markers
    if h[3] % 100 < SPM:
        return n, "spm", before_a, before_b - before_a, b"".join((s, suffix, p, prefix, m, middle))
    return n, "psm", before_a, before_b - before_a, b"".join((p, prefix, s, suffix, m, middle))


def rearrange(docs: DataFrame, seed: str = SEED, markers: tuple[str, str, str] = MARKERS) -> DataFrame:
    """Per document: doc_id, n, form (plain, psm or spm), prefix_chars, middle_chars, output."""
    marks = tuple(m.encode() for m in markers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = pa.schema([("_key", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.string())])

        def frame(rows: list[tuple]) -> pa.RecordBatch:
            *cols, output = zip(*rows, strict=True)
            # Rearranged texts are UTF-8 as the texts were: the bytes are taken over as strings.
            cols = [pa.array(c, f.type) for c, f in zip(cols, fields, strict=False)]
            return pa.RecordBatch.from_arrays([*cols, pa.array(output, pa.binary()).view(pa.string())], schema=fields)

        for batch in batches:
            rows, held = [], 0
            for key, data in zip(batch.column("_key").to_pylist(), batch.column("text"), strict=True):
                row = (key, *rearranged(data.as_py() or b"", draws(key, seed), marks))
                rows.append(row)
                held += len(row[-1])
                if held >= BLOCK:
                    yield frame(rows)
                    rows, held = [], 0
            if rows:
                yield frame(rows)
        give_back()

    return unkeyed(keyed(docs.select("doc_id", F.col("text").cast("binary").alias("text")), "text").mapInArrow(run, _SCHEMA))


def restored(output: str | Column = "output", form: str | Column = "form", markers: tuple[str, str, str] = MARKERS) -> Column:
    """The text that an output was made of; a rearranged text has each marker once, as its text has none."""
    output, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    parts = F.split(output, "|".join(rf"\Q{m}\E" for m in markers), -1)
    return (
        F.when(form == "plain", output)
        .when(form == "psm", F.concat(parts[1], parts[3], parts[2]))
        .when(form == "spm", F.concat(parts[2], parts[3], parts[1]))
    )


def digests(rows: DataFrame) -> DataFrame:
    """Checksums of the outputs and of the texts rebuilt from them, in place of the outputs."""
    return rows.select(
        *[c for c in rows.columns if c != "output"],
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored().cast("binary"), 256).alias("restored_sha256"),
    )
