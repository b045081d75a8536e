import math
import re

import numpy as np
from pyspark.sql import functions as F

from citeweave.llm import toxicity
from citeweave.llm.queries import op5_toxicity

SF = "/root/testdata/sf0.1"


def test_held_out_quality(spark):
    got = op5_toxicity(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out").toPandas()
    y, s = got["toxic"].to_numpy(), got["score"].to_numpy()
    rank = s.argsort().argsort() + 1
    auc = (rank[y == 1].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (len(y) - y.sum()))
    assert auc > 0.96
    assert ((s >= 0) & (s <= 1)).all() and ((s >= 0.3) == (got["predicted"] == 1)).all()
    assert (s[y == 0] >= 0.3).mean() < 0.05


def kneser_ney(rows, classes, corpus):
    """P(w | v) and P(w) of both classes by the textbook, from (text, class) rows and all texts."""
    def grams(t):
        w = re.findall(r"[a-z0-9']+", t.lower())
        return list(zip([None, *w], w, strict=False))

    before = {}
    for t in corpus:
        for v, w in grams(t):
            before.setdefault(w, set()).add(v)
    total = sum(map(len, before.values()))

    def discount(counts):
        n = [max(1, sum(x == k for x in counts)) for k in range(1, 5)]
        y = n[0] / (n[0] + 2 * n[1])
        d = [1 - 2 * y * n[1] / n[0], 2 - 3 * y * n[2] / n[1], 3 - 4 * y * n[3] / n[2]]
        d = [min(max(x, 0.1), m) for x, m in zip(d, (0.98, 1.9, 2.9), strict=True)]
        return lambda x: d[min(x, 3) - 1] if x else 0.0

    out = []
    for c in classes:
        n = {}
        for t, own in rows:
            for g in set(grams(t)) if own == c else ():
                n[g] = n.get(g, 0) + 1
        low = {}
        for _, w in n:
            low[w] = low.get(w, 0) + 1
        of, dl, dh = sum(low.values()), discount(list(low.values())), discount(list(n.values()))
        left = sum(map(dl, low.values())) / of

        def word(w, low=low, of=of, dl=dl, left=left):
            return (low.get(w, 0) - dl(low.get(w, 0))) / of + left * len(before[w]) / total

        def pair(v, w, n=n, dh=dh, word=word):
            own = [x for (a, _), x in n.items() if a == v]
            if not own:
                return word(w)
            x = n.get((v, w), 0)
            return (x - dh(x)) / sum(own) + sum(map(dh, own)) / sum(own) * word(w)

        out.append((word, pair))
    return out, before


def test_the_models_are_those_of_the_textbook(docs_of, spark):
    r = np.random.default_rng(4)
    bad, good = "bad mean ugly thing word here now".split(), "fine good word here thing nice now then".split()
    rows = [(i, " ".join(r.choice(bad if i % 3 else good, r.integers(1, 9)))) for i in range(90)] + [(i, f"other{i % 4} word unmet") for i in range(90, 99)]
    docs = docs_of(rows)
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(90)], "doc_id long, toxic long")
    sample = toxicity.sampled(labels, F.lit(True))
    left_out = {x._id for x in sample.where("left_out").collect()}
    assert 0 < len(left_out) < 45
    counts = toxicity.class_counts(toxicity.labelled(docs, sample))
    corpus = toxicity.corpus_contexts(docs, np.unique(toxicity.words_of(" ".join(t for _, t in rows))))
    models, before = kneser_ney([(t, int(i % 3 > 0)) for i, t in rows if i < 90 and i not in left_out], (1, 0), [t for _, t in rows])
    (word_t, pair_t), (word_o, pair_o) = models
    for word, pair in models:
        assert math.isclose(sum(map(word, before)), 1, rel_tol=1e-9)
        assert all(math.isclose(sum(pair(v, w) for w in before), 1, rel_tol=1e-9) for v in [None, "bad", "word", "fine"])
    key = {int(toxicity.words_of(w).view(np.int64)[0]): w for w in before}
    assert {key[x.w]: x.n for x in corpus.where("w IS NOT NULL").collect()} == {w: len(v) for w, v in before.items()}
    model = toxicity.build(counts, corpus)
    for _, t in rows:
        full, low = model.ratios(toxicity.words_of(t))
        w = t.split()
        for i, (v, x) in enumerate(zip([None, *w], w, strict=False)):
            assert math.isclose(low[i], math.log(word_t(x) / word_o(x)), abs_tol=1e-5)
            assert math.isclose(full[i], math.log(pair_t(v, x) / pair_o(v, x)), abs_tol=1e-5)


def test_contexts_are_counted_exactly(docs_of):
    rows = [(i, f"c{i % 3000} often c{i % 40} seldom x{i}") for i in range(6000)]
    hot = np.sort(toxicity.words_of("often seldom"))
    words = np.unique(toxicity.words_of(" ".join(t for _, t in rows if "x1" not in t)))  # all but some of the last words
    for split in (None, hot):
        found = toxicity.corpus_contexts(docs_of(rows, 7), words, split).collect()
        others = sum(x.n for x in found if x.w is None)
        found = [x for x in found if x.w is not None]
        got = {}
        for x in found:
            got[x.w] = got.get(x.w, 0) + x.n

        def n(word):
            return got[int(toxicity.words_of(word).view(np.int64)[0])]

        assert (n("seldom"), n("x27"), n("c7"), n("often")) == (40, 1, 2, 3000)  # of c7 a text's beginning, and "often"
        assert len(got) == len(words) and others + len(words) == 3000 + 2 + 6000 and (len(found) > len(got)) == (split is not None)


def test_the_score_is_the_weighed_ratio(docs_of, spark):
    """The final score by hand: evidence, one-sided mean, logistic."""
    rows = [(i, "bad word here bad thing often" if i % 2 else "good word here fine thing often") for i in range(60)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic long")
    docs = docs_of(rows)
    model = toxicity.fit(docs, labels, F.lit(True))
    sample = {x._id: x for x in toxicity.sampled(labels, F.lit(True)).collect()}
    kept = [(t.split(), i % 2) for i, t in rows if not sample[i].left_out]
    pairs = {}
    for t, y in kept:
        for g in set(zip([None, *t], t, strict=False)):
            pairs.setdefault(g, [0, 0])[y] += 1
    counts = {}
    for (_, w), (good, bad) in pairs.items():
        have = counts.setdefault(w, [0, 0])
        have[0], have[1] = have[0] + good, have[1] + bad
    share = [sum(c[y] for c in counts.values()) / sum(map(sum, counts.values())) for y in (0, 1)]
    for text in ("bad word", "good often here", "unmet bad bad", ""):
        words, total = text.split(), 0.0
        full = model.ratios(toxicity.words_of(text))[0] if words else []
        for w, r in zip(words, full, strict=True):
            e = sum(n * math.log(n / (sum(counts[w]) * share[y])) for y, n in enumerate(counts[w]) if n) if w in counts else 0
            total += max((r - model.words.other) * e**2 / (e**2 + toxicity.EVIDENCE**2), 0) if e >= toxicity.LEAST_EVIDENCE else 0
        x = math.log(toxicity.LEAST_EXCESS + (total / len(words) if words else 0))
        assert math.isclose(model.score(text), 1 / (1 + math.exp(-(model.weights[0] * x + model.weights[1]))), rel_tol=1e-4)
    assert model.weights[0] > 0


def test_scores_follow_the_labels(docs_of, spark):
    rows = [(i, "bad word here bad thing" if i % 2 else "good word here fine thing") for i in range(40)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic long")
    model = toxicity.fit(docs_of(rows), labels, F.lit(True))
    assert model.score("bad") > 0.5 > model.score("good")
    kept = {x.doc_id for x in toxicity.keep_ordinary(docs_of(rows), model).collect()}
    assert kept == {i for i, _ in rows if i % 2 == 0}


def test_odd_tables(odd, docs_of, spark):
    none = spark.createDataFrame([], "doc_id long, toxic long")
    assert toxicity.fit(odd, none, F.lit(True)) is None
    assert {r.score for r in toxicity.score(odd, None).collect()} == {0.0}
    labels = spark.createDataFrame([(5, 1), (5, 0), (7, 1), (8, 0), (9, 0), (None, 1), (12, None)], "doc_id long, toxic long")
    model = toxicity.fit(odd, labels, F.lit(True))
    got = toxicity.score(odd, model)
    assert got.count() == 10 and got.where("score BETWEEN 0 AND 1").count() == 10
    assert toxicity.keep_ordinary(odd, None).count() == 10
    assert toxicity.score(docs_of([]), model).count() == 0
    kept = toxicity.keep_ordinary(odd, model)
    assert kept.columns == odd.columns and kept.count() == got.where("predicted = 0").count()
    assert toxicity.keep_ordinary(docs_of([]), model).count() == 0
    assert toxicity.fit(docs_of([]), labels, F.lit(True)) is not None


def test_packed_numbers():
    r = np.random.default_rng(1)
    for values in (np.zeros(0, np.int64), np.array([0]), r.integers(0, 1 << 40, 500), r.integers(0, 300, 500)):
        assert (toxicity._unvarints(np.frombuffer(toxicity._varints(values), np.uint8)) == values).all()
