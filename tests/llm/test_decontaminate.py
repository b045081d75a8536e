import hashlib
import random
import re

import pytest

from citeweave.llm import decontaminate as dc


def brute(doc, items, window):
    hit, found = set(), set()
    for name, t in items:
        s = min(window, len(t))
        for i in range(len(t) - s + 1 if t else 0):
            for j in range(len(doc) - s + 1):
                if doc[j : j + s] == t[i : i + s]:
                    hit |= set(range(j, j + s))
                    found.add(name)
    return hit, found


def hit_by_windows(doc, items, window):
    """As :func:`brute`'s hits, with the windows in a set: for whole tables."""
    windows = {}
    for _, t in items:
        s = min(window, len(t))
        for i in range(len(t) - s + 1 if t else 0):
            windows.setdefault(s, set()).add(tuple(t[i : i + s]))
    return {j + k for s, held in windows.items() for j in range(len(doc) - s + 1) if tuple(doc[j : j + s]) in held for k in range(s)}


def test_automaton_finds_every_window():
    r = random.Random(3)
    for _ in range(600):
        words = [b"a", b"b", b"c"][: r.randint(1, 3)]
        items = [(str(i), [r.choice(words) for _ in range(r.randint(0, 9))]) for i in range(r.randint(0, 4))]
        window = r.randint(1, 5)
        doc = [r.choice([*words, b"q"]) for _ in range(r.randint(0, 25))]
        spans, found = dc.SuffixAutomaton(items, window).hits(doc)
        assert ({i for a, b in spans for i in range(a, b)}, found) == brute(doc, items, window)


def contract_words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


@pytest.mark.parametrize("most", [dc.MAX_ITEM_WORDS, 30])
def test_documents_follow_the_contract(spark, docs_of, monkeypatch, most):
    r = random.Random(5)
    vocabulary = [f"w{i}" for i in range(30)] + ["É", "ñandú", "X9"]
    items = [(i, " ".join(r.choice(vocabulary) for _ in range(r.choice([0, 3, 12, 13, 40])))) for i in range(12)] + [(99, None), (100, "!!")]
    rows = [(50, None), (51, ""), (52, "?!")]
    for i in range(40):
        t = " ".join(r.choice(vocabulary) for _ in range(r.choice([5, 60, 400])))
        if i % 3 == 0 and items[i % 12][1]:
            t = f"{t}, {items[i % 12][1].upper()}; {t}"
        rows.append((i, t))
    bench = spark.createDataFrame(items, "item_id long, text string")
    real = dc.automata
    monkeypatch.setattr(dc, "automata", lambda b, w: real(b, w, most))
    got = {x.doc_id: x for x in dc.decontaminate(docs_of(rows), bench).collect()}
    split = [(str(i), contract_words(t)) for i, t in items]
    for i, t in rows:
        w = contract_words(t)
        hit, found = brute(w, split, 13)
        x = got[i]
        assert (x.n_words, x.n_hit, x.n_items) == (len(w), len(hit), len(found))
        assert x.items_sha256 == hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        assert x.contaminated == (len(hit) > 0 and 20 * len(hit) >= len(w))
        assert contract_words(x.cleaned) == [y for k, y in enumerate(w) if k not in hit]
    kept = sorted(x.doc_id for x in dc.keep_clean(docs_of(rows), bench).collect())
    assert kept == sorted(i for i, _ in rows if not got[i].contaminated)


def test_odd_tables(odd, docs_of, spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert dc.judged(odd, none).where("contaminated").count() == 0
    assert dc.judged(docs_of([]), none).count() == 0
    same = spark.createDataFrame([(1, "same text here"), (None, "same text here")], "item_id long, text string")
    got = dc.judged(odd, same)
    assert got.count() == 10 and got.where("contaminated AND n_items = 2").count() == 3
    kept = dc.keep_clean(odd, same)
    assert kept.columns == odd.columns and kept.count() == 7
    assert dc.keep_clean(odd, none).count() == 10 and dc.keep_clean(docs_of([]), same).count() == 0
