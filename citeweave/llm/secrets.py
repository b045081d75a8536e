"""Secret scans: fixed formats, and probabilistic automata inferred from the credentials found.

Labelled credentials are the values that the fixed formats find; their kind is the
label. For each kind a prefix tree of the values' character classes is built and its
statistically compatible states are merged (Hoeffding test on exits and ends, as in
ALERGIA), which gives a deterministic probabilistic automaton. Ordinary tokens give one
more automaton. Every candidate is scored: the values of the base spans, and every token
outside them of SHORTEST characters or more. Its score is by how many nats its
best credential automaton, the end of the value included, explains it better than the ordinary one. A token becomes a span of
kind ``format`` where its score is more than a threshold: that of a token in RARITY being a
credential, or, where ordinary tokens of about its length look like credentials, what all but one in
ORDINARY_ABOVE of held-out ones have. Lengths are told apart by powers of two.

All different values of all documents teach, whatever their length and number; Spark counts them.
Values that read alike in character classes are one string with a count. The states come from the
part of the prefix tree that one in STATES of a label's values or more pass, DEPTH characters deep, with the
exact counts of its exits; it has at most STATES nodes of each depth, however many values there are, and what is rarer could not be
told apart. Then every string is walked, and the automata's probabilities are the exact counts of all
values. The thresholds are of all ordinary values too, each scored as if it had not been counted. Nulls: a null text is empty. Ties: spans with one start stand in the
order of KINDS. Repeated rows are scanned each by itself. No credentials: no automata, base
spans only. An empty table gives an empty one. Very long texts are scanned whole. Other columns may have any names.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeweave.llm.common import give_back, keyed, rows_of, text_of, unkeyed
from citeweave.session import materialize, tasks

KINDS = ("assign", "access", "hex", "format")


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join([*map(_either_case, ("password", "passwd", "secret", "token")), _either_case("api") + "_?" + _either_case("key")])
ASSIGN = re.compile(rf"({_NAMES})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
#: As HEX with 24 characters or more: both find whole runs.
_LONG_HEX = re.compile(r"[0-9a-f]{24,}")
_TOKEN = "[A-Za-z0-9+/_.=-]"
_HINTS = ("password", "passwd", "secret", "token", "api")

#: One in so many of a label's values must pass a node of the prefix tree for it to be told apart; how deep the tree is.
STATES, DEPTH = 100, 256
#: Counts taken out of each transition when an ordinary value, which is among those counted, is scored for the thresholds.
HELD_OUT = 1
#: Characters of the shortest token that can be a candidate.
SHORTEST = 6
#: Confidence of the merge test; tokens among which one bare credential is expected, and ordinary ones of which one may be above the threshold.
ALPHA, RARITY, ORDINARY_ABOVE = 0.05, 100_000, 100
#: Tokens whose verdicts a task remembers; characters of values that a task holds to give out each once.
MOST_KNOWN, MOST_HELD = 1 << 20, 16 << 20
#: Steps of the scores that thresholds are found among, of which so many multiply a score by e.
STEPS = 512

_CLASSES = ("0123456789", "abcdef", "ghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "+/", "_", ".", "=", "-")
_CLASS = {c: i for i, members in enumerate(_CLASSES) for c in members}
_END = len(_CLASSES)
#: What stands for a class in the strings that values are counted as: its first character.
_FROM, _TO = "".join(_CLASSES), "".join(members[0] * len(members) for members in _CLASSES)
_CLASS_TABLE = bytes(_CLASS.get(chr(c), 0) for c in range(256))


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind number, end, value) of the fixed formats, leftmost non-overlapping for each kind."""
    found = []
    folded = text.lower()
    if any(h in folded for h in _HINTS):
        found += [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end(), m[0]) for m in _LONG_HEX.finditer(text)]
    return sorted(found)


def candidates(text: str, taken: list[tuple[int, int, int, str]], token: re.Pattern) -> list[tuple[int, int, str]]:
    """Tokens outside the base spans."""
    out, k = [], 0
    furthest = [0]  # how far the spans before each reach
    for s in taken:
        furthest.append(max(furthest[-1], s[2]))
    for m in token.finditer(text):
        while k < len(taken) and taken[k][0] < m.end():
            k += 1
        if furthest[k] <= m.start():
            out.append((m.start(), m.end(), m[0]))
    return out


class Automaton:
    """Deterministic probabilistic automaton over character classes, inferred by state merging."""

    def __init__(self, values: Iterable[str] = (), alpha: float = ALPHA, exits: dict[str, list[int]] | None = None):
        """exits: how many values leave each node of the prefix tree by each class, or end there; else those of ``values``, which are then walked."""
        values = list(values)
        if exits is None:
            exits = {}
            for v in (v.translate(str.maketrans(_FROM, _TO)) for v in values):
                for i in range(len(v) + 1):
                    exits.setdefault(v[:i], [0] * (_END + 1))[_CLASS[v[i]] if i < len(v) else _END] += 1
        number = {prefix: i for i, prefix in enumerate(sorted(exits, key=lambda p: (len(p), p)))} or {"": 0}
        n = len(number)
        self.count, self.ends = [0] * n, [0] * n
        self.follow: list[dict[int, int]] = [{} for _ in range(n)]
        self.taken: list[dict[int, int]] = [{} for _ in range(n)]
        for prefix, by in exits.items():
            s = number[prefix]
            self.count[s], self.ends[s] = sum(by), by[_END]
            for c in range(_END):
                if by[c]:
                    t = number.get(prefix + _CLASSES[c][0])
                    if t is None:  # too rare to be looked into: compatible with any state
                        t = len(self.count)
                        self.count.append(0)
                        self.ends.append(0)
                        self.follow.append({})
                        self.taken.append({})
                    self.taken[s][c], self.follow[s][c] = by[c], t
        self._merge(math.sqrt(0.5 * math.log(2 / alpha)))
        self.learn(self.visits(values, np.ones(len(values), np.int64)))

    def _differ(self, f1: int, n1: int, f2: int, n2: int, bound: float) -> bool:
        return abs(f1 / n1 - f2 / n2) > bound * (1 / math.sqrt(n1) + 1 / math.sqrt(n2))

    def _compatible(self, a: int, b: int, bound: float) -> bool:
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            na, nb = self.count[a], self.count[b]
            if not na or not nb:
                continue
            if self._differ(self.ends[a], na, self.ends[b], nb, bound):
                return False
            for c in self.taken[a].keys() | self.taken[b].keys():
                if self._differ(self.taken[a].get(c, 0), na, self.taken[b].get(c, 0), nb, bound):
                    return False
                if c in self.follow[a] and c in self.follow[b]:
                    todo.append((self.follow[a][c], self.follow[b][c]))
        return True

    def _fold(self, a: int, b: int) -> None:
        """Adds the tree below b to a."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            self.count[a] += self.count[b]
            self.ends[a] += self.ends[b]
            for c, n in self.taken[b].items():
                self.taken[a][c] = self.taken[a].get(c, 0) + n
                if c in self.follow[a]:
                    todo.append((self.follow[a][c], self.follow[b][c]))
                else:
                    self.follow[a][c] = self.follow[b][c]

    def _merge(self, bound: float) -> None:
        red, kept, blue = [0], {0}, [(0, c) for c in sorted(self.follow[0])]
        while blue:
            s, c = blue.pop(0)
            t = self.follow[s][c]
            if t in kept:
                continue
            for r in red:
                if self._compatible(r, t, bound):
                    self.follow[s][c] = r
                    self._fold(r, t)
                    blue = [(x, k) for x in red for k in sorted(self.follow[x]) if self.follow[x][k] not in kept]
                    break
            else:
                red.append(t)
                kept.add(t)
                blue += [(t, k) for k in sorted(self.follow[t])]
        number = {s: i for i, s in enumerate(red)}
        self.table = np.full((len(red) + 1, _END + 1), len(red), np.int32)
        for s, i in number.items():
            for c, t in self.follow[s].items():
                self.table[i, c] = number[t]
        del self.count, self.ends, self.follow, self.taken  # the tree isn't needed any more, and is large

    def learn(self, visits: np.ndarray, held_out: int = HELD_OUT) -> None:
        """Takes the probabilities from how often values left each state by each class, or ended there."""
        k = _END + 1
        visits = visits.reshape(len(self.table), k)
        total = visits.sum(axis=1, keepdims=True)
        size = np.array([math.log(len(members)) for members in _CLASSES] + [0.0])
        self.cost = np.log((visits + 0.5) / (total + 0.5 * k)) - size
        #: The same without ``held_out`` of the values.
        self.without = np.log((np.maximum(visits - held_out, 0) + 0.5) / (np.maximum(total - held_out, 0) + 0.5 * k)) - size

    @staticmethod
    def _steps(values: list[str]) -> tuple[np.ndarray, Iterator[np.ndarray]]:
        """The values' order, longest first, and at each step the classes of those that are so long."""
        sizes = np.fromiter(map(len, values), np.int64, len(values))
        order = np.argsort(-sizes, kind="stable")
        codes = np.frombuffer("".join(values).encode("ascii").translate(_CLASS_TABLE), np.uint8)
        start, sizes = (np.cumsum(sizes) - sizes)[order], sizes[order]
        going = np.searchsorted(-sizes, -np.arange(1, sizes[0] + 1), side="right") if len(values) else []
        return order, (codes[start[:n] + i] for i, n in enumerate(going))

    def visits(self, values: list[str], counts: np.ndarray) -> np.ndarray:
        """How often values, each of so many, leave each state by each class or end there, as a flat table."""
        out = np.zeros(self.table.size, np.int64)
        order, steps = self._steps(values)
        state, counts = np.zeros(len(values), np.int32), counts[order]
        for c in steps:
            n = len(c)
            np.add.at(out, state[:n] * (_END + 1) + c, counts[:n])
            state[:n] = self.table[state[:n], c]
        np.add.at(out, state * (_END + 1) + _END, counts)
        return out

    def likelihoods(self, values: list[str], without: bool = False) -> np.ndarray:
        """Log-likelihood of each value and its end; all values go a step at a time. ``without``: as if the value had not been counted."""
        cost = self.without if without else self.cost
        order, steps = self._steps(values)
        state, total = np.zeros(len(values), np.int32), np.zeros(len(values))
        for c in steps:
            n = len(c)
            total[:n] += cost[state[:n], c]
            state[:n] = self.table[state[:n], c]
        out = np.empty(len(values))
        out[order] = total + cost[state, _END]
        return out


class Formats:
    """The automata of the kinds of credential and of ordinary tokens, and the threshold between them."""

    def __init__(self, automata: dict[str, Automaton]):
        self.ordinary = automata.get("ordinary") or Automaton()
        self.kinds = {k: automata[k] for k in KINDS if k in automata}
        self.token = re.compile(_TOKEN + "{%d,}" % SHORTEST)
        #: Thresholds of lengths of so many bits; of others the least one.
        self.thresholds: dict[int, float] = {}

    def steps(self, values: list[str]) -> np.ndarray:
        """The step of each ordinary value's score, the value itself taken out: 0 up to the least threshold."""
        scores = self.scores(values, True)
        return np.where(scores > math.log(RARITY), 1 + np.floor(STEPS * np.log(np.maximum(scores, 1) / math.log(RARITY))), 0).astype(np.int64)

    def set_thresholds(self, counts: Iterable[tuple[int, int, int]]) -> None:
        """counts: (bits of the length, step of the score, values). A threshold is the upper end of a step: no more than one value in ORDINARY_ABOVE is above it."""
        by: dict[int, dict[int, int]] = {}
        for bits, step, n in counts:
            by.setdefault(bits, {})[step] = n
        for bits, steps in by.items():
            left = sum(steps.values()) // ORDINARY_ABOVE
            for step in sorted(steps, reverse=True):
                left -= steps[step]
                if left < 0:
                    break
            self.thresholds[bits] = math.log(RARITY) * math.exp(step / STEPS)

    def threshold(self, value: str) -> float:
        """The score above which a token of the value's length is a span."""
        return self.thresholds.get(len(value).bit_length(), math.log(RARITY))

    def scores(self, values: list[str], without: bool = False) -> np.ndarray:
        """By how many nats the best credential automaton explains each value better than the ordinary one."""
        if not self.kinds or not values:
            return np.full(len(values), -np.inf)
        return np.max([a.likelihoods(values) for a in self.kinds.values()], axis=0) - self.ordinary.likelihoods(values, without)


def _strings(docs: DataFrame) -> DataFrame:
    """(label, string, n): the different values of each label in all documents as strings of classes, with how many read so."""
    token = re.compile(_TOKEN + "{%d,}" % SHORTEST)

    def labelled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        met: set[tuple[str, str]] = set()
        held = 0
        for (text,) in rows_of(batches, "text"):
            taken = base_spans(text_of(text))
            found = {(KINDS[k], v) for _, k, _, v in taken}
            found.update(("ordinary", v) for v in ([v for _, _, v in candidates(text, taken, token)] if taken else token.findall(text_of(text))))
            found -= met
            met |= found
            held += sum(len(v) for _, v in found)
            if held > MOST_HELD:
                yield pd.DataFrame(list(met), columns=["label", "value"])
                met, held = set(), 0
        yield pd.DataFrame(list(met), columns=["label", "value"])
        give_back()

    values = docs.select("text").mapInPandas(labelled, "label string, value string").distinct()
    found = values.groupBy("label", F.translate("value", _FROM, _TO).alias("string")).agg(F.count("*").alias("n"))
    return materialize(found.repartition(tasks(docs.sparkSession)), "strings")


def fit(docs: DataFrame, states: int = STATES, held_out: int = HELD_OUT) -> Formats:
    """Fits the automata and the thresholds on all different values of all documents.

    The driver gets the nodes of the prefix trees that one in ``states`` of a label's values or more pass, then one count
    for each transition of the automata and one for each step of the scores.
    """
    strings = _strings(docs)
    totals = {r.label: r.n for r in strings.groupBy("label").agg(F.sum("n").alias("n")).collect()}
    if not set(KINDS) & set(totals):
        return Formats({})
    least = F.create_map(*[F.lit(x) for label, n in totals.items() for x in (label, max(1, n // states))])
    at = F.explode(F.sequence(F.lit(0), F.least(F.length("string"), F.lit(DEPTH - 1)))).alias("at")
    nodes = strings.select("label", "string", "n", at).select("label", "n", F.expr("substring(string, 1, at)").alias("prefix"), F.expr("substring(string, at + 1, 1)").alias("c"))
    by = [F.coalesce(F.sum(F.when(F.col("c") == c, F.col("n"))), F.lit(0)) for c in (*(m[0] for m in _CLASSES), "")]
    exits: dict[str, dict[str, list[int]]] = {label: {} for label in totals}
    for r in nodes.groupBy("label", "prefix").agg(F.sum("n").alias("n"), F.array(*by).alias("by")).where(F.col("n") >= least[F.col("label")]).collect():
        exits[r.label][r.prefix] = r.by
    automata = {label: Automaton(exits=e) for label, e in exits.items()}

    def walked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        visits = {label: np.zeros(a.table.size, np.int64) for label, a in automata.items()}
        for pdf in batches:
            for label, part in pdf.groupby("label"):
                visits[label] += automata[label].visits(part["string"].tolist(), part["n"].to_numpy(np.int64))
        for label, v in visits.items():
            cells = np.flatnonzero(v)
            yield pd.DataFrame({"label": label, "cell": cells, "n": v[cells]})
        give_back()

    visits = {label: np.zeros(a.table.size, np.int64) for label, a in automata.items()}
    for r in strings.mapInPandas(walked, "label string, cell long, n long").groupBy("label", "cell").agg(F.sum("n").alias("n")).collect():
        visits[r.label][r.cell] = r.n
    for label, a in automata.items():
        a.learn(visits[label], held_out)
    formats = Formats(automata)

    def stepped(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            values = pdf["string"].tolist()
            found = pd.DataFrame({"bits": [len(v).bit_length() for v in values], "step": formats.steps(values), "n": pdf["n"]})
            yield found.groupby(["bits", "step"], as_index=False).sum()
        give_back()

    ordinary = strings.where("label = 'ordinary'").select("string", "n")
    formats.set_thresholds(map(tuple, ordinary.mapInPandas(stepped, "bits long, step long, n long").groupBy("bits", "step").agg(F.sum("n")).collect()))
    return formats


class Scanner:
    """Finds spans batch by batch, and remembers the tokens it has judged."""

    def __init__(self, formats: Formats):
        self.formats = formats
        self.known: set[str] = set()
        self.flagged: dict[str, float] = {}

    def _judge(self, tokens: set[str]) -> None:
        new = list(tokens - self.known)
        if not new:
            return
        if len(self.known) > MOST_KNOWN:
            self.known, self.flagged = set(), {}
            new = list(tokens)
        self.known.update(new)
        scores = self.formats.scores(new)
        self.flagged |= {new[i]: float(scores[i]) for i in np.flatnonzero(scores > math.log(RARITY)) if scores[i] > self.formats.threshold(new[i])}

    def spans(self, texts: list[str]) -> list[tuple[list[tuple[int, int, int, float]], int]]:
        """Of each text: (start, kind number, end, score) of all spans, by start, then kind; and how many tokens were scored."""
        token = self.formats.token
        base = [base_spans(t) for t in texts]
        values = [v for spans in base for _, _, _, v in spans]
        scores = iter(self.formats.scores(values).tolist())
        # Tokens of texts with base spans are cut from between these; most texts have none.
        inside = [candidates(t, b, token) if b else None for t, b in zip(texts, base, strict=True)]
        tokens = [token.findall(t) if c is None else [v for _, _, v in c] for t, c in zip(texts, inside, strict=True)] if self.formats.kinds else [[] for _ in texts]
        self._judge(set().union(*tokens))
        out = []
        for text, b, c, own in zip(texts, base, inside, tokens, strict=True):
            spans = [(s, k, e, next(scores)) for s, k, e, _ in b]
            if not self.flagged.keys().isdisjoint(own):
                spans += [(s, 3, e, self.flagged[v]) for s, e, v in (candidates(text, b, token) if c is None else c) if v in self.flagged]
            out.append((sorted(spans), len(b) + len(own)))
        return out


#: Texts, and characters of texts, that are scanned at once.
TEXTS, CHARS = 2000, 8 << 20


def _parts(texts: list[str]) -> Iterator[list[str]]:
    part, held = [], 0
    for t in texts:
        part.append(t)
        held += len(t)
        if len(part) >= TEXTS or held >= CHARS:
            yield part
            part, held = [], 0
    if part:
        yield part


def _joined(spans: list[tuple[int, int, int, float]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b, _ in spans)


def scan(docs: DataFrame, formats: Formats | None = None) -> DataFrame:
    """Per document: doc_id, counts of the base kinds and of added spans, n_scored, base_sha256, spans and their scores.

    Positions are code points, ends exclusive. ``scores``: nats, joined in the spans'
    order; -inf where nothing was learned. ``formats``: fitted on ``docs`` itself if not given.
    """
    formats = formats or fit(docs)

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scanner = Scanner(formats)
        for pdf in batches:
            rows = []
            for part in _parts([text_of(t) for t in pdf["text"]]):
                for spans, n_scored in scanner.spans(part):
                    n = [sum(s[1] == k for s in spans) for k in range(4)]
                    base = [s for s in spans if s[1] < 3]
                    rows.append((*n, n_scored, hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(spans), ",".join(f"{s[3]:.3f}" for s in spans)))
            yield pd.DataFrame(rows, columns=columns).assign(_key=pdf["_key"].to_numpy())
        give_back()

    columns = ["n_assign", "n_access", "n_hex", "n_format", "n_scored", "base_sha256", "spans", "scores"]
    return unkeyed(keyed(docs, "text").mapInPandas(find, "_key long, n_assign long, n_access long, n_hex long, n_format long, n_scored long, base_sha256 string, spans string, scores string"))


def redacted(text: str, spans: list[tuple[int, int, int, float]]) -> str:
    """The text with each run of overlapping spans replaced by the first one's kind in brackets."""
    out, at = [], 0
    k = 0
    while k < len(spans):
        start, kind, end, _ = spans[k]
        k += 1
        while k < len(spans) and spans[k][0] < end:
            end = max(end, spans[k][2])
            k += 1
        out += [text[at:start], f"[{KINDS[kind]}]"]
        at = end
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, formats: Formats | None = None) -> DataFrame:
    """``docs`` with all their rows and columns; secrets in ``text`` give way to their kind in brackets.

    Where ``n_chars`` is a column, it becomes the length of the new text.
    """
    formats = formats or fit(docs)

    def clean(batches: Iterator) -> Iterator:
        import pyarrow as pa

        scanner = Scanner(formats)
        for batch in batches:
            old = batch.column("text").to_pylist()
            found = (spans for part in _parts([text_of(t) for t in old]) for spans, _ in scanner.spans(part))
            texts = [None if t is None else redacted(t, spans) for t, spans in zip(old, found, strict=True)]
            cols = {f.name: batch.column(i) for i, f in enumerate(batch.schema)} | {"text": pa.array(texts, pa.string())}
            yield pa.RecordBatch.from_arrays([cols[f.name] for f in batch.schema], names=[f.name for f in batch.schema])
        give_back()

    out = docs.mapInArrow(clean, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"])) if "n_chars" in docs.columns else out
