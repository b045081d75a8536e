import hashlib
import math
import random
import re

from citeweave.llm import secrets
from citeweave.llm.queries import op1_secrets


def brute(text):
    """The contract, character by character classes spelled out."""
    names = r"[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]"
    out = []
    for m in re.finditer(rf"({names})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, m.end()))
    for k, p, n in ((1, r"AKIA[A-Z0-9]+", 20), (2, r"[0-9a-f]+", 24)):
        out += [(m.start(), k, m.end()) for m in re.finditer(p, text) if m.end() - m.start() >= n]
    return sorted(out)


def sample(n, seed=1):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        words = ["".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 18))) for _ in range(30)]
        if i % 3 == 0:
            words.insert(5, f'token = "{r.randbytes(20).hex()}"')
        if i % 4 == 0:
            words.insert(9, "AKIA" + "".join(r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(16)))
        if i % 5 == 0:
            words.insert(12, f"PASSWORD: s{i}Xy_{r.randint(0, 999)}")
        rows.append((i, "é " * (i % 2) + " ".join(words)))
    return rows


def test_base_spans_follow_the_contract(docs_of):
    rows = [*sample(60), (100, "secret: token: abcdefgh"), (101, "api-key=abcdef apikey=abcdef API_KEY='x'"), (102, "AKIAAKIA" + "A" * 11), (103, "f" * 23 + "g" + "0" * 24), (104, None)]
    got = {r.doc_id: r for r in secrets.scan(docs_of(rows)).collect()}
    assert len(got) == len(rows)
    for i, text in rows:
        want = brute(text or "")
        assert [got[i].n_assign, got[i].n_access, got[i].n_hex] == [sum(s[1] == k for s in want) for k in range(3)]
        joined = ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in want)
        assert got[i].base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        spans = got[i].spans.split(",") if got[i].spans else []
        assert [s for s in spans if not s.startswith("format")] == (joined.split(",") if joined else [])


def test_automata_add_credentials_without_a_name(docs_of):
    r = random.Random(5)
    bare = [(1000 + i, "here it is " + "".join(r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(20)) + " and more") for i in range(8)]
    plain = [(2000 + i, "onintionlyandthering thethingsofwhich internationalisation") for i in range(8)]
    docs = docs_of(sample(200) + bare + plain)
    got = {x.doc_id: x for x in secrets.scan(docs).collect()}
    assert sum(got[i].n_format for i, _ in bare) >= 7
    assert sum(got[i].n_format for i, _ in plain) == 0


def test_merging_finds_loops():
    r = random.Random(2)
    a = secrets.Automaton(["".join(r.choice("0123456789abcdef") for _ in range(40)) for _ in range(500)])
    assert len(a.cost) < 200
    good, bad = a.likelihoods(["0a" * 20, "zz" * 20])
    assert good > bad + 40


def test_all_candidates_are_scored_by_the_automata(docs_of):
    """Every span's score, and every token that isn't one, against the automata walked character by character."""
    rows = sample(200, 9) + [(i, f"x{i} bare {w} end") for i, w in enumerate(("abcdefgh", "12345678", "Zq9-xY_77+", "ABCDEF"), 500)]
    docs = docs_of(rows)
    formats = secrets.fit(docs, held_out=500)

    def walk(a, value):
        state, total = 0, 0.0
        for c in value:
            k = secrets._CLASS[c]
            total += a.cost[state, k]
            state = a.table[state, k]
        return total + a.cost[state, -1]

    def score(value):
        return max(walk(a, value) for a in formats.kinds.values()) - walk(formats.ordinary, value)

    got = {x.doc_id: x for x in secrets.scan(docs, formats).collect()}
    for i, text in rows:
        spans = [(*s.split(":"), float(c)) for s, c in zip(got[i].spans.split(","), got[i].scores.split(","), strict=True)] if got[i].spans else []
        base = secrets.base_spans(text)
        values = {(str(a), str(b)): v for a, _, b, v in base}
        tokens = [m for m in re.finditer("[A-Za-z0-9+/_.=-]{%d,}" % secrets.SHORTEST, text) if not any(a < m.end() and m.start() < b for a, _, b, _ in base)]
        assert got[i].n_scored == len(base) + len(tokens)
        for kind, a, b, c in spans:
            assert abs(c - score(text[int(a) : int(b)] if kind == "format" else values[a, b])) < 1e-3
        added = {(int(a), int(b)) for kind, a, b, _ in spans if kind == "format"}
        assert added == {m.span() for m in tokens if score(m[0]) > formats.threshold(m[0])}


def test_the_query_shows_planted_formats(spark, docs_of, tmp_path):
    r = random.Random(8)
    bare = [(1000 + i, "see " + "".join(r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(20)) + " there") for i in range(10)]
    docs_of(sample(300, 3) + bare).write.parquet(f"{tmp_path}/documents.parquet")
    got = {x.doc_id: x for x in op1_secrets(spark, str(tmp_path)).collect()}
    assert sum(got[i].n_format for i, _ in bare) >= 9
    assert sum(got[i].n_format for i in range(300)) <= 3


def test_redaction_keeps_all_rows_and_columns(odd, docs_of):
    out = secrets.redact(odd)
    assert out.columns == odd.columns and out.count() == odd.count()
    text = secrets.redact(docs_of([*sample(30)])).collect()
    assert not any("AKIA" in x.text or re.search("[0-9a-f]{24}", x.text) for x in text)
    assert all(len(x.text) == x.n_chars for x in text)


def test_odd_tables(odd, docs_of):
    assert secrets.scan(odd).count() == 10
    assert secrets.scan(docs_of([])).count() == 0


def test_all_values_are_counted(docs_of, monkeypatch):
    """Probabilities and thresholds come from every different value, also where the tree shows only the frequent ones, and of long ones."""
    monkeypatch.setattr(secrets, "ORDINARY_ABOVE", 5)
    r = random.Random(11)
    rows = sample(150, 4) + [(900 + i, "".join(r.choice("0123456789abcdefXYZ_") for _ in range(r.choice((7, 60, 300, 700))))) for i in range(120)]
    rows += [(i + 5000, text) for i, text in rows]
    formats = secrets.fit(docs_of(rows), states=20)
    values = {k: set() for k in (*secrets.KINDS[:3], "ordinary")}
    for _, text in rows:
        base = secrets.base_spans(text)
        for _, k, _, v in base:
            values[secrets.KINDS[k]].add(v)
        values["ordinary"] |= {m[0] for m in re.finditer("[A-Za-z0-9+/_.=-]{%d,}" % secrets.SHORTEST, text) if not any(a < m.end() and m.start() < b for a, _, b, _ in base)}
    assert len(values["ordinary"]) > 1000 and max(map(len, values["ordinary"])) == 700
    for label, mine in values.items():
        a = formats.ordinary if label == "ordinary" else formats.kinds[label]
        seen = {}
        for v in mine:
            s = 0
            for c in (*map(secrets._CLASS.__getitem__, v), secrets._END):
                seen[s, c] = seen.get((s, c), 0) + 1
                s = a.table[s, c] if c < secrets._END else s
        for (s, c), n in seen.items():
            total, size = sum(m for (x, _), m in seen.items() if x == s), len(secrets._CLASSES[c]) if c < secrets._END else 1
            assert abs(a.cost[s, c] - math.log((n + 0.5) / (total + 0.5 * (secrets._END + 1)) / size)) < 1e-9
    by = {}
    for v in values["ordinary"]:
        by.setdefault(len(v).bit_length(), []).append(v)
    assert formats.thresholds.keys() == by.keys()
    for bits, mine in by.items():
        scores = sorted(formats.scores(mine, True), reverse=True)
        want = max(math.log(secrets.RARITY), scores[len(mine) // 5])
        assert want - 1e-9 <= formats.thresholds[bits] <= want * math.exp(1 / secrets.STEPS) + 1e-9
