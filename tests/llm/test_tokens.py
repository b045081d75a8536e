import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from citeweave.llm import tokens
from citeweave.session import scratch_path

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    "", "  ", "\n\n a\tb", "don't  it's x", "<|endoftext|> a<|startoftext|>", "<|ENDOFTEXT|> X!!", "é ́x", "Σας ΣΑΣ. ΑΣ.", "İI ſ K",
    "\x85a\x1cb", "١٢٣ ½ 9a9", "🎉🎉 中文字", "a b", "word.,! WORD%%% it's. don't, _a_. a_!", "é, É. ²). x≠", "plain words only",
]


@pytest.fixture(scope="module")
def exact():
    t = Tokenizer.from_file(PATH)
    return lambda text: [*t.encode(text or "", add_special_tokens=False).ids, 2]


def test_words_give_the_tokenizer_s_ids(exact):
    e = tokens.Encoder(PATH)
    for _ in range(2):
        for t in TEXTS:
            assert np.frombuffer(e.encode(t), "<u2").tolist() == exact(t)


def test_blocks_and_the_full_cache_change_nothing(exact, monkeypatch):
    texts = [f"{t} word{i} mot{i % 7}é, {t}" for i, t in enumerate(TEXTS * 20)]
    want = [exact(t) for t in texts]
    monkeypatch.setattr(tokens, "BLOCK_CHARS", 50)  # texts are cut, and blocks hold a few
    monkeypatch.setattr(tokens, "CACHE_WORDS", 40)
    assert [np.frombuffer(x, "<u2").tolist() for x in tokens.Encoder(PATH).encode_all(texts)] == want


def test_round_trip_starts_and_lookup(spark, docs_of, exact):
    rows = [(i * 7 % 101, t * (1 + i % 3)) for i, t in enumerate(TEXTS * 6) if i < 100] + [(1000, None)]
    path = scratch_path(spark, "test")
    tokens.write(docs_of(rows), path, PATH, sample=50)
    got = tokens.read(spark, path).orderBy("doc_id").collect()
    start = 0
    for g, (i, t) in zip(got, sorted(rows), strict=True):
        ids = exact(t)
        assert (g.doc_id, g.start, g.n_tokens) == (i, start, len(ids))
        assert g.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    assert [x.tolist() for x in tokens.lookup(spark, path, 14)] == [exact(dict(rows)[14])]
    assert tokens.lookup(spark, path, 555) == []


def test_another_dictionary_is_refused():
    data = tokens.pack([(1, 1, b"x", 2)], b"\0" * 32)
    with pytest.raises(ValueError):
        tokens.Segment(data, b"other")


def test_odd_tables(odd, docs_of):
    assert tokens.write_and_read(odd, PATH).count() == 10
    assert tokens.write_and_read(docs_of([]), PATH).count() == 0
