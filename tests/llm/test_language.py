import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from citeweave.llm import language
from citeweave.llm.queries import op4_language

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = op4_language(spark, SF).join(docs.select("doc_id", "lang"), "doc_id").where("held_out AND lang_pred <> 'und'")
    right = got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right >= 0.99


def grams(text):
    """The n-grams' numbers, one by one."""
    codes, out = [ord(c) for c in text.lower()], []
    for n in (1, 2, 3):
        for i in range(len(codes) - n + 1):
            h = 0
            for c in codes[i : i + n]:
                h = (h << 21 | c) % 2**64
            h = h * int(language._SEEDS[n]) % 2**64
            h = (h ^ h >> 30) * 0xBF58476D1CE4E5B9 % 2**64
            h = (h ^ h >> 27) * 0x94D049BB133111EB % 2**64
            out.append((h ^ h >> 31) >> 49)
    return out


def posterior(rows, text):
    """Naive Bayes by hand: each language's probability for the text."""
    known = sorted({lang for _, _, lang in rows if lang})
    score = {}
    for lang in known:
        own = [t or "" for _, t, x in rows if x == lang]
        n = np.bincount([g for t in own for g in grams(t)], minlength=language.DIMENSIONS) + 0.5
        score[lang] = math.log(len(own) / sum(1 for r in rows if r[2])) + sum(math.log(n[g] / n.sum()) for g in grams(text))
    most = max(score.values())
    total = sum(math.exp(v - most) for v in score.values())
    return {lang: math.exp(v - most) / total for lang, v in score.items()}


def test_predictions_are_naive_bayes(docs_of, monkeypatch):
    r = random.Random(1)
    letters = {"x": "abcd ", "y": "cdef.", "z": "éñ中 a"}
    rows = [(i, "".join(r.choice(letters["xyz"[i % 3]]) for _ in range(r.randint(0, 30))), "xyz"[i % 3] if i % 7 else None) for i in range(60)]
    model = language.fit(docs_of(rows), F.lit(True))
    texts = ["".join(r.choice("abcdefé中. ") for _ in range(n)) for n in (0, 1, 2, 3, 5, 40, 200)] + ["abx", "...", "Ab"]
    for block in (language.BLOCK, 7):
        monkeypatch.setattr(language, "BLOCK", block)
        lang, score = model.predict(texts)
        for t, one, p in zip(texts, lang, score, strict=True):
            if not any(c.isalpha() for c in t):
                assert (one, p) == ("und", 0.0)
                continue
            want = posterior(rows, t)
            assert abs(want[one] - max(want.values())) < 1e-4 and abs(p - want[one]) < 1e-4


def test_no_language_is_left_out(docs_of, monkeypatch):
    rows = [(i, chr(0x4E00 + i) * 5, f"l{i:03d}") for i in range(300)]
    model = language.fit(docs_of(rows), F.lit(True))
    assert len(model.languages) == 300 and model.predict([r[1] for r in rows])[0] == [r[2] for r in rows]
    monkeypatch.setattr(language, "MOST_LANGUAGES", 299)
    with pytest.raises(ValueError):
        language.fit(docs_of(rows), F.lit(True))


def test_odd_tables(odd, docs_of):
    model = language.fit(odd, F.lit(True))
    got = {r.doc_id: r for r in language.identify(odd, model).collect()}
    assert (got[7].lang_pred, got[8].lang_pred, got[10].lang_pred, got[7].score) == ("und", "und", "und", 0.0)
    empty = language.fit(docs_of([]), F.lit(True))
    assert {r.lang_pred for r in language.identify(odd, empty).collect()} == {"und"}


def test_sparse_rows_are_the_texts_grams(monkeypatch):
    texts = ["abcdefghij" * 50, "", "a", "ab", "ÀB中"]
    for block in (language.BLOCK, 7, 1):
        monkeypatch.setattr(language, "BLOCK", block)
        found = [[] for _ in texts]
        for text, first, hashes in language.sparse(texts):
            for i, part in zip(text, np.split(hashes, first[1:]), strict=True):
                found[i] += part.tolist()
        assert [sorted(x) for x in found] == [sorted(grams(t)) for t in texts]
