import random

import numpy as np
import pytest

from citeweave.llm import jaccard


def brute(rows, size=5, percent=75):
    sets, parent = {}, {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        k = min(size, len(w))
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if w else set()
        parent[i] = i

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return sorted((i, len(sets[i]), root(i)) for i in ids)


def corpus(seed):
    r = random.Random(seed)
    rows = []
    passage = [f"p{i}" for i in range(60)]
    for g in range(10):
        base = [f"w{r.randrange(4000)}" for _ in range(r.choice([3, 5, 9, 40, 120]))]
        for _ in range(90 if g == 0 else r.choice([1, 2, 4])):
            w = list(base)
            for _ in range(r.randint(0, max(1, len(base) // 18))):
                w[r.randrange(len(w))] = f"q{r.randrange(10**6)}"
            rows.append((len(rows), " ".join(w + passage * (r.random() < 0.3))))
    return [*rows, (len(rows), None), (len(rows) + 1, ""), (len(rows) + 2, "Only Three\tWords"), (len(rows) + 3, "only three words")]


@pytest.mark.parametrize(("seed", "short"), [(1, 64), (2, 6), (3, 2)])
def test_same_as_all_pairs(docs_of, seed, short):
    rows = corpus(seed)
    got = sorted(map(tuple, jaccard.near_duplicates(docs_of(rows), short=short).collect()))
    assert got == brute(rows)


def test_exact_threshold(docs_of):
    a = [f"w{i}" for i in range(34)]  # 30 shingles; changing the last n words changes n shingles
    rows = [(1, " ".join(a)), (2, " ".join(a[:-4] + ["x1", "x2", "x3", "x4"])), (3, " ".join(a[:-5] + ["y1", "y2", "y3", "y4", "y5"]))]
    assert sorted(map(tuple, jaccard.near_duplicates(docs_of(rows)).collect())) == brute(rows)


def test_bounds_lose_no_pair():
    for a in range(1, 120):
        for b in range(a, 160):
            need = jaccard.least_common(a, b)
            assert 100 * need >= 75 * (a + b - need) and (need == 0 or 100 * (need - 1) < 75 * (a + b - need + 1))
            if need <= a:
                assert jaccard.least_merged(a, b) >= 1


def test_one_of_each_group_stays(docs_of, odd):
    rows = corpus(4)
    kept = sorted(r.doc_id for r in jaccard.keep_one(docs_of(rows)).collect())
    assert kept == sorted(i for i, _, c in brute(rows) if i == c)
    out = jaccard.keep_one(odd)
    assert out.columns == odd.columns
    assert sorted((r.doc_id or 0) for r in out.collect()) == [0, 5, 7, 8, 9, 10, 11, 12]


def test_odd_tables(odd, docs_of):
    got = [tuple(r) for r in jaccard.near_duplicates(odd).collect()]
    assert len(got) == 10 and got.count((5, 1, 5)) == 2 and (6, 1, 5) in got and (7, 0, 7) in got and (None, 1, None) in got
    assert jaccard.near_duplicates(docs_of([])).count() == 0


@pytest.mark.parametrize(("seed", "short", "block"), [(1, 64, 256), (2, 6, 16), (3, 2, 3)])
def test_every_link_is_counted(docs_of, monkeypatch, seed, short, block):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rows = [*corpus(seed), *[(i + 1000, t) for i, t in corpus(seed)[:7]]]
    rows += [(i + 2000, " ".join(f"q{i}" if j == i else f"near{j}" for j in range(120))) for i in range(100)]
    words = {i: (t or "").encode().lower().split() for i, t in rows}
    sets = {i: {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set() for i, w in words.items()}
    n = {i: sum(i != j and bool(a) and 100 * len(a & b) >= 75 * len(a | b) for j, b in sets.items()) for i, a in sets.items()}
    assert all(n[i + 2000] == 99 for i in range(100))
    got = sorted(map(tuple, jaccard.near_duplicates(docs_of(rows), short=short, count_links=True).collect()))
    assert got == [(*r, n[r[0]]) for r in brute(rows)]
    least = {}
    for i in sorted(sets, reverse=True):
        least[frozenset(sets[i])] = i
    own = sorted(least.values())
    want = [(a, b, len(sets[a] & sets[b])) for a in own for b in own if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    assert sorted(map(tuple, jaccard.link_pairs(docs_of(rows), short=short).collect())) == want


def test_one_long_list_of_many_components(docs_of, monkeypatch):
    """Texts that share one passage, in a rare list of all of them, and are linked in small groups only; tables are salted, not broadcast."""
    monkeypatch.setattr(jaccard, "FEW", 0)
    monkeypatch.setattr(jaccard, "MOST_HEAVY", 0)  # nothing is known to be frequent: the passage's lists stay short ones
    r = random.Random(6)
    passage = [f"p{i}" for i in range(8)]
    rows = []
    for g in range(40):
        base = [f"g{g}w{i}" for i in range(30)]
        for k in range(5):
            w = list(base)
            w[r.randrange(30)] = f"x{g}y{k % 3}"
            rows.append((len(rows), " ".join(passage + w)))
    got = sorted(map(tuple, jaccard.near_duplicates(docs_of(rows), short=6).collect()))
    assert got == brute(rows)
    monkeypatch.setattr(jaccard, "MOST_HEAVY", 1 << 18)
    monkeypatch.setattr(jaccard, "HEAVY", 2)
    monkeypatch.setattr(jaccard, "SHORT", 1)  # every repeated list is known to be long
    assert sorted(map(tuple, jaccard.near_duplicates(docs_of(rows), short=6).collect())) == brute(rows)


def test_merged_lists_count_what_pairs_share():
    r = np.random.default_rng(2)
    sets = [np.unique(r.integers(0, 300, n).astype(np.uint64)) for n in (0, 1, 5, 80, 200, 200, 90)]
    assert jaccard._common(sets, sets).astype(int).tolist() == [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    one = [np.arange(20_000, dtype=np.uint64)] * 5
    assert (jaccard._common(one, one) == 20_000).all()
