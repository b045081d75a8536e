import hashlib
import random

import numpy as np

from citeweave.llm import winnow


def brute(text, k, w):
    codes = np.frombuffer(text.encode("utf-32-le"), "<u4")
    h = winnow.gram_hashes(codes, k).tolist()
    out = set()
    for i in range(max(1, len(h) - w + 1) if h else 0):
        window = h[i : i + w]
        out.add(i + max(j for j, x in enumerate(window) if x == min(window)))
    return sorted(out), [h[i] for i in sorted(out)]


def test_choice_is_the_rightmost_least(monkeypatch):
    r = random.Random(3)
    for block in (1 << 18, 23):
        monkeypatch.setattr(winnow, "BLOCK", block)
        for _ in range(150):
            text = "".join(r.choice("abé") for _ in range(r.randint(0, 120)))
            k, w = r.randint(1, 6), r.randint(1, 9)
            h, at = winnow.fingerprint(text, k, w)
            assert (at.tolist(), h.tolist()) == brute(text, k, w)


def test_shared_run_shares_a_fingerprint():
    r = random.Random(4)
    for _ in range(50):
        run = "".join(r.choice("abcdefgh ") for _ in range(winnow.K + winnow.W - 1))
        a, b = ("".join(r.choice("stuvwxyz ") for _ in range(200)) for _ in range(2))
        x, y = (set(winnow.fingerprint(s + run + s)[0].tolist()) for s in (a, b))
        assert x & y


def test_edited_and_next(docs_of):
    r = random.Random(6)
    rows = [(i * 3, "".join(r.choice("abcdefghijklmno ") for _ in range(r.choice([0, 1, 30, 500])))) for i in range(40)] + [(7, None)]
    got = {x.doc_id: x for x in winnow.compare_edited(docs_of(rows, 5)).collect()}
    order = sorted((i, t or "") for i, t in rows)
    for k, (i, text) in enumerate(order):
        after = order[(k + 1) % len(order)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert got[i].n_chars == len(text)
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        own, other, nxt = (np.unique(winnow.fingerprint(t)[0]) for t in (text, edited, after))
        assert got[i].fingerprint == winnow.written(winnow.fingerprint(text)[0])
        assert got[i].near_edited == winnow.likeness(own, other)
        assert got[i].near_next == winnow.likeness(own, nxt)


def test_odd_tables(odd, docs_of):
    assert winnow.compare_edited(odd).count() == 10
    assert winnow.fingerprints(odd).count() == 10
    assert winnow.compare_edited(docs_of([])).count() == 0
    one = winnow.compare_edited(docs_of([(1, "abcd")])).first()
    assert one.near_next == 1.0
