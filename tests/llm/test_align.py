import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from citeweave.llm import align
from citeweave.llm.queries import op13_align, tokenizer_path

PATHS = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def brute(rows):
    """Every text encoded as a whole, every pair of tokens compared."""
    import sentencepiece
    from tokenizers import Tokenizer

    a_tok = Tokenizer.from_file(PATHS[0])
    a_tok.encode_special_tokens = True
    b_tok = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    byte_of = align._byte_level()
    out, found = [], []
    for doc_id, text in rows:
        a = b = []
        if text:
            a, b = a_tok.encode(" " + text, add_special_tokens=False).ids, b_tok.encode(text)
            a_bytes = [bytes(byte_of[c] for c in a_tok.id_to_token(i)) for i in a]
            b_bytes = [bytes([int(b_tok.id_to_piece(i)[3:5], 16)]) if b_tok.is_byte(i) else b_tok.id_to_piece(i).replace("▁", " ").encode() for i in b]
            if not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
                a = b = []
        if not a:
            found.append((doc_id, 0, 0, 0, [], ""))
            continue
        x, y = (np.cumsum([0, *map(len, t)]).tolist() for t in (a_bytes, b_bytes))
        links = []
        j0 = 0
        for i in range(len(a)):
            while y[j0 + 1] <= x[i]:
                j0 += 1
            j = j0
            while j < len(b) and y[j] < x[i + 1]:
                links.append((a[i], b[j]))
                j += 1
        both = sorted(set(x) & set(y))
        groups = [f"{','.join(str(a[i]) for i in range(len(a)) if p <= x[i] < q)}|{','.join(str(b[j]) for j in range(len(b)) if p <= y[j] < q)}" for p, q in zip(both, both[1:], strict=False)] if len(a) < 3000 else None
        sha = "long" if groups is None else hashlib.sha256(";".join(groups).encode()).hexdigest()
        found.append((doc_id, len(a), len(b), len(both) - 1, links, sha))
    held = Counter(p for f in found for p in set(f[4]))
    most = defaultdict(int)
    for (i, _), n in held.items():
        most[i] = max(most[i], n)
    for doc_id, n_a, n_b, n_groups, links, sha in found:
        out.append((doc_id, n_a, n_b, n_groups, len(links), sum(held[p] == most[p[0]] for p in links), sum(held[p] for p in links), sha))
    return out


def check(df, rows):
    got, want = (sorted(x, key=repr) for x in (map(tuple, df.select(*COLUMNS).collect()), brute(rows)))
    assert len(got) == len(want)
    for g, w in zip(got, want, strict=True):
        assert g == w or w[-1] == "long" and g[:-1] == w[:-1]


def texts(r, n):
    words = ["the", "Zürich", "don't", "I'll", "x y", "　z", "中文字", "😀", "<|endoftext|>", "<s>", "1234567", "----", "a\x00b", "é́", "﻿", "ing", "{\r", "}", "\x1c", " ", "“q”"]
    gaps = [" ", " ", " ", "  ", "\n", "\n\n", "\t", " \n ", "\r\n", "   ", "", "  ", "  ", "\x0b", "  "]
    for i in range(n):
        yield i, "".join(r.choice(words) + r.choice(gaps) for _ in range(r.choice([0, 1, 2, 5, 40])))


@pytest.mark.parametrize(("block", "text", "chunk"), [(align.BLOCK, align.TEXT, align.CHUNK), (200, 30, 7)])
def test_same_as_whole_texts(docs_of, monkeypatch, block, text, chunk):
    for name, value in (("BLOCK", block), ("TEXT", text), ("CHUNK", chunk)):
        monkeypatch.setattr(align, name, value)
    rows = [*texts(random.Random(block), 250), (300, None), (301, ""), (302, "a▁b c"), (303, " lead"), (304, "trail  "), (304, "trail  "), (305, " "), (306, "\n"), (307, "c a▁b"), (None, "no id")]
    check(align.align(docs_of(rows), *PATHS), rows)


def test_cuts_are_safe():
    """Segments encoded one by one give the tokens of the whole text."""
    both = align.tokenizers_of(*PATHS)
    assert bytes(np.flatnonzero(both.before).tolist()) == b"\t\n\v\f "  # carriage returns end pieces of B
    for _, text in texts(random.Random(9), 300):
        data = (" " + text).encode()
        found = both.ends(data)
        if found:
            assert not set(align.cuts(np.frombuffer(data, np.uint8), both.before).tolist()) - {0} - (set(found[2].tolist()) & set(found[3].tolist()))


def test_equal_ranges_are_one(monkeypatch):
    r = random.Random(4)
    for broken in (False, True):
        if broken:  # a hash that tells nothing apart
            monkeypatch.setattr(align, "mix", lambda h: h * np.uint64(0))
        for _ in range(50):
            parts = [bytes(r.choice(b"ab") for _ in range(r.choice([1, 2, 8, 9, 16, 17, 30]))) for _ in range(60)]
            edges = np.cumsum([0, *map(len, parts)])
            first, codes = align.different(np.frombuffer(b"".join(parts), np.uint8), edges)
            assert [parts[first[c]] for c in codes] == parts and len(first) == len(set(parts))


def test_odd_tables(odd, docs_of):
    rows = [tuple(x) for x in odd.select("doc_id", "text").collect()]
    check(align.align(odd, *PATHS), rows)
    assert align.align(docs_of([]), *PATHS).count() == 0
    nothing = [(1, None), (2, "")]
    check(align.align(docs_of(nothing), *PATHS), nothing)


def test_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(x) for x in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    check(op13_align(spark, sf), rows)
