import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from citeweave.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Vocabulary(PATH)


def plain(v, text):
    """The best segmentation by the textbook: every piece tried at every place."""
    s = pieces.marked(text)
    best, last = [0.0] + [-1e300] * len(s), [0] * (len(s) + 1)
    for j in range(1, len(s) + 1):
        for i in range(max(0, j - v.longest), j):
            found = v.pieces.get(s[i:j])
            score = found[0] if found else v.unknown if j == i + 1 else None
            if score is not None and best[i] + score > best[j]:
                best[j], last[j] = best[i] + score, i
    parts, j = [], len(s)
    while j:
        parts.append(s[last[j] : j])
        j = last[j]
    return best[-1], [x for p in reversed(parts) for x in v.ids_of(p)]


def texts(seed, n):
    r = random.Random(seed)
    bits = ["the", "ing", " ", "a", "th", "  ", "é", "\n", "中", "x", "tion", ", ", ".", "###", "▁"]
    return ["".join(r.choice(bits[: r.choice([2, 4, 9, 15])]) for _ in range(r.randint(0, 120))) for _ in range(n)]


def test_words_give_the_best_path(vocabulary):
    for t in [*texts(1, 150), "", " ", "  a", "a ", "é中\n\t  z"]:
        score, ids = vocabulary.encode(t)
        want = plain(vocabulary, t)
        assert np.frombuffer(ids, "<u4").tolist() == want[1] and abs(score - want[0]) <= 1e-9 * abs(want[0])
        assert vocabulary.decode(ids) == t.replace("▁", " ")


def test_chunks_combine_to_the_same_path(vocabulary):
    r = random.Random(2)
    for t in [x for x in [*texts(3, 150), *("".join(r.choice("aet") for _ in range(90)) for _ in range(20))] if len(x) > 40]:
        parts = pieces.chunks_of(t, vocabulary.longest, r.randint(17, 60))
        entry = np.array([0.0] + [-np.inf] * (vocabulary.longest - 1))
        entries, maps = [], []
        for p, n in parts:
            entries.append(entry)
            maps.append(pieces.way_in(vocabulary, p, n, entry.tolist()))
            entry = pieces.combined(entry[None, :], pieces.transfer(vocabulary, p, n))[0]
        ends = [0]
        for m in maps[:0:-1]:
            ends.insert(0, int(m[ends[0]].argmax()))
        ids = b"".join(pieces.path_back(vocabulary, p, n, e.tolist(), x) for (p, n), e, x in zip(parts, entries, ends, strict=True))
        want = plain(vocabulary, t)
        assert entry[0] == want[0]
        assert np.frombuffer(ids, "<u4").tolist() == want[1]


def test_states_in_blocks_are_those_of_one_row(spark):
    r = np.random.default_rng(3)
    ms = [[r.integers(-9, 9, (4, 4)).astype(float) for _ in range(n)] for n in (30, 1, 7)]
    df = spark.createDataFrame([(row, at, m.tobytes()) for row, of in enumerate(ms) for at, m in enumerate(of)], "row long, at int, m binary")
    got = {(x.row, x.at): np.frombuffer(x.state).tolist() for x in pieces.states(df, 29, 4, 3).collect()}
    assert len(got) == 38
    for row, of in enumerate(ms):
        state = np.array([0.0] + [-np.inf] * 3)
        for at, m in enumerate(of):
            assert got[row, at] == state.tolist()
            state = pieces.combined(state[None, :], m)[0]


def test_combining_is_associative():
    r = np.random.default_rng(1)
    a, b, c = (r.integers(-50, 50, (6, 6)).astype(float) for _ in range(3))
    assert (pieces.combined(pieces.combined(a, b), c) == pieces.combined(a, pieces.combined(b, c))).all()


def test_giant_documents_are_as_whole_ones(docs_of):
    r = random.Random(7)
    rows = [(i, " ".join(r.choice(["the", "thing,", "ab\ncd", "xyzzyx", "é"]) for _ in range(r.choice([5, 900])))) for i in range(12)] + [(50, "z" * 1500), (51, None)]
    rows += [(3, rows[3][1])]
    rows.append((52, "".join(r.choice("aet") for _ in range(1500))))  # many ties, and no blank
    columns = ["doc_id", "n_tokens", "ids", "score", "round_trip"]
    whole = sorted(map(tuple, pieces.encode(docs_of(rows), PATH).select(columns).collect()))
    for chunk in (100, 333):
        assert sorted(map(tuple, pieces.encode(docs_of(rows), PATH, giant=600, chunk=chunk).select(columns).collect())) == whole
    assert all(x[4] for x in whole)
    packed = {x.doc_id: x for x in pieces.encode_packed(docs_of(rows), PATH, giant=600, chunk=100).collect()}
    for doc_id, n, ids, _, _ in whole:
        data = np.array(ids, "<u4").tobytes()
        assert (bytes(packed[doc_id].ids), packed[doc_id].n_tokens, packed[doc_id].ids_crc32) == (data, n, zlib.crc32(data))


def test_near_the_library_s_own_reading(vocabulary, spark):
    """The library merges pairs, which is no sum of scores; most words come out the same."""
    from sentencepiece import SentencePieceProcessor

    library = SentencePieceProcessor(model_file=PATH)
    words = [w for x in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect() for w in (x.text or "").split()]
    own = [np.frombuffer(vocabulary.encode(w)[1], "<u4").tolist() for w in words]
    theirs = library.encode(words)
    assert np.mean([a == b for a, b in zip(own, theirs, strict=True)]) > 0.75
    assert abs(sum(map(len, own)) / sum(map(len, theirs)) - 1) < 0.03
    assert library.id_to_piece(np.frombuffer(vocabulary.encode("the international quality")[1], "<u4").tolist()) == ["▁the", "▁international", "▁quality"]


def test_decode_gives_the_texts_back(odd, docs_of):
    rows = {r.doc_id: r.text for r in pieces.decode(pieces.encode(odd, PATH), PATH).collect()}
    want = {r.doc_id: r.text or "" for r in odd.collect()}
    assert rows == want
    assert pieces.encode_packed(docs_of([]), PATH).count() == 0
