"""N-gram Jaccard join by T-occurrence search.

Sets are distinct word shingles. Two sets of a and b shingles reach the similarity
only if they have at least T(a, b) in common, so each of them can leave out of the
index all but its rarest ones: those it leaves out are its long inverted lists, the
others its short ones (DivideSkip). The search of a set merges its short lists with a
heap, counts in how many each other set occurs, and keeps those that could still reach
T with all long lists; these are then probed, by binary search of the long lists'
shingles in the other set.

Equal sets are one node, whatever the number of copies, so copies are never expanded.
Short lists that are long all the same (many near copies) aren't paired within: each member
is compared with a few that lead, and after that only members that are still in different
components. Where links are asked for, the lists of each component's members are merged in
full, block by block of members, and every pair that shares enough is found: the work grows
with the square of a component's different texts, as its links may. No task has all of a
long list or of a large component: members of lists that are known to be long are dealt by
list and set, and tables of one row a list are broadcast up to FEW rows and salted beyond.

Nulls: an empty table gives an empty one; a null text is empty; an empty set is linked with nothing and is a component of
its own doc_id. Ties: the least doc_id names a component. Rows that repeat a doc_id are one
document, and linked. Very long texts are sets like others. Columns other than doc_id and
text are never read. Sets are told apart by 64-bit hashes: of 2 * 10**10 different sets,
some ten pairs can be expected to be taken for equal.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citeweave.llm.common import LEAST, Emitter, keyed, mix, rows_of, text_of, unkeyed, unused, word_hashes
from citeweave.operators.graph import connected_components
from citeweave.session import materialize

SHINGLE, PERCENT = 5, 75
#: A shingle that so many documents of one task hold is counted; those held by so many in all are put last.
LOCAL, HEAVY = 2, 12
#: Most shingles that are put last: the bound of what is broadcast. Others keep their place, which costs time only.
MOST_HEAVY = 1 << 18
#: Members of a list that are paired with each other; of longer lists, members that are compared with all others first.
SHORT, LEADERS = 64, 16
#: Members, and bytes of their sets, of a block where all pairs of two blocks are made.
BLOCK, BLOCK_BYTES = 256, 16 << 20
#: Rows of a table that may be broadcast, and parts of a list or component where it isn't.
FEW, SALTS = 200_000, 64
#: Bits of the filter of sets to fetch, and sets a task remembers having sent.
FILTER_BITS = 1 << 24
_ODD = [np.uint64(x) for x in mix(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)]


def shingles(text: str, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the text's word shingles; all words make one where there are fewer."""
    words = word_hashes(text.encode("utf-8", "surrogatepass").lower())
    n = len(words)
    if not n:
        return words
    size = min(size, n)
    total = np.full(n - size + 1, size, np.uint64)
    for i in range(size):
        total += words[i : n - size + 1 + i] * _ODD[i % 64] + _ODD[(i + 7) % 64]
    return np.unique(mix(total))


def set_key(hashes: np.ndarray) -> int:
    """The set's hash, as a signed number."""
    total = mix(hashes ^ np.uint64(0xA0761D6478BD642F)).sum(dtype=np.uint64, keepdims=True)
    return int(mix(total ^ np.uint64(len(hashes))).view(np.int64)[0])


def least_common(a: int, b: int, percent: int = PERCENT) -> int:
    """T: how many shingles sets of a and b must share."""
    return -(-percent * (a + b) // (100 + percent))


def skipped(n: int, percent: int = PERCENT) -> int:
    """How many long lists a set of n may leave out: one fewer than it must share with any other."""
    return -(-percent * n // 100) - 1


def least_merged(a: int, b: int, percent: int = PERCENT) -> int:
    """How many indexed lists sets of a and b must share: T less what the lists left out can give."""
    return least_common(a, b, percent) - max(skipped(a, percent), skipped(b, percent))


def short_lists(hashes: np.ndarray, heavy: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """The shingles that are indexed: in the order of (heavy, hash), all but the last ``skipped``."""
    keep = len(hashes) - skipped(len(hashes), percent)
    if not len(heavy):
        return hashes[:keep]
    is_heavy = heavy[np.minimum(np.searchsorted(heavy, hashes), len(heavy) - 1)] == hashes
    return np.concatenate([hashes[~is_heavy], hashes[is_heavy]])[:keep]


def _first_seen(seen: set[int], key: int, most: int = 1 << 20) -> bool:
    """Whether the task hasn't met the set; forgets all rather than grow without bound."""
    if key in seen:
        return False
    if len(seen) >= most:
        seen.clear()
    seen.add(key)
    return True


def survey(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """One pass over the texts: (_key, n, node) of every row, node being null for an empty set,
    and, of kind 2, (node = a shingle, n = how often the task met it) of frequent shingles.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = Emitter(["_key", "n", "node", "kind"], most=10_000)
        seen: set[int] = set()
        parts, held = [], 0
        for key, text in rows_of(batches, "_key", "text"):
            h = shingles(text_of(text), size)
            node = set_key(h) if len(h) else 0
            if out.add((key, len(h), node, int(len(h) > 0))):
                yield out.frame()
            if len(h) and _first_seen(seen, node):
                parts.append(h)
                held += len(h)
                if held > 4_000_000:
                    yield _often(parts)
                    parts, held = [], 0
        yield out.frame()
        if parts:
            yield _often(parts)

    return keyed(docs, "text").mapInPandas(run, "_key long, n long, node long, kind int")


def rows_in(surveyed: DataFrame) -> DataFrame:
    return surveyed.where("kind < 2").select("_key", "n", F.when(F.col("kind") == 1, F.col("node")).alias("node"))


def heavy_in(surveyed: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that many documents hold, sorted, and those of them whose lists are long.

    They only decide an order and how lists are dealt, so near counts will do.
    """
    counts = surveyed.where("kind = 2").groupBy("node").agg(F.sum("n").alias("n"))
    top = counts.where(F.col("n") >= HEAVY).orderBy(F.desc("n"), "node").limit(MOST_HEAVY).toArrow().to_pandas()
    both = [top["node"][top["n"] >= least].to_numpy(np.int64).view(np.uint64) for least in (HEAVY, 2 * SHORT)]
    return np.sort(both[0]), np.sort(both[1])


def _often(parts: list[np.ndarray]) -> pd.DataFrame:
    h = np.sort(np.concatenate(parts))
    starts = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
    n = np.diff(np.append(starts, len(h)))
    keep = n >= LOCAL
    return pd.DataFrame({"_key": 0, "n": n[keep].astype(np.int64), "node": h[starts[keep]].view(np.int64), "kind": np.int32(2)})


def _held(sorted_values: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which of the values are among the sorted ones."""
    if not len(sorted_values):
        return np.zeros(len(values), bool)
    return sorted_values[np.minimum(np.searchsorted(sorted_values, values), len(sorted_values) - 1)] == values


def _index(docs: DataFrame, heavy: tuple[np.ndarray, np.ndarray], size: int, percent: int, short: int = SHORT) -> DataFrame:
    """Lists that several sets share: one row for each member, with the members before it.

    Not ``whole``: the list is long, and the row tells only that the set is a member. The
    members of a list that is known to be long go to many tasks; they have a negative n on the way.
    """
    heavy, hot = heavy

    def post(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[int] = set()
        parts, held = [], 0
        for (text,) in rows_of(batches, "text"):
            h = shingles(text_of(text), size)
            key = set_key(h) if len(h) else 0
            if len(h) and _first_seen(seen, key):
                s = short_lists(h, heavy, percent)
                parts.append((s.view(np.int64), np.full(len(s), key), np.where(_held(hot, s), -len(h), len(h)).astype(np.int32)))
                held += len(s)
                if held > 200_000:
                    yield pd.DataFrame(dict(zip(("s", "node", "n"), map(np.concatenate, zip(*parts, strict=True)), strict=True)))
                    parts, held = [], 0
        if parts:
            yield pd.DataFrame(dict(zip(("s", "node", "n"), map(np.concatenate, zip(*parts, strict=True)), strict=True)))

    def lists(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = Emitter(["s", "node", "n", "partners", "sizes", "whole"], most=20_000)
        s0 = node0 = None
        members: list[int] = []
        sizes: list[int] = []
        long = False

        def end() -> Iterator[pd.DataFrame]:
            if not long:
                for i in range(1, len(members)):
                    if out.add((s0, members[i], sizes[i], members[:i], sizes[:i], True), 64 + 12 * i):
                        yield out.frame()

        for pdf in batches:
            s, node, n = (pdf[c].to_numpy() for c in ("s", "node", "n"))
            dealt, n = n < 0, np.abs(n)
            # A list of one member, with nothing equal on either side, is none: most are passed over here.
            shared = np.empty(len(s), bool)
            shared[1:] = s[1:] == s[:-1]
            lone = ~(shared | np.append(shared[1:], True))
            lone[:1] = False
            lone &= ~dealt
            for i in np.flatnonzero(~lone):
                if s[i] != s0:
                    yield from end()
                    s0, node0, members, sizes, long = int(s[i]), None, [], [], bool(dealt[i])
                if node[i] == node0:
                    continue
                node0 = int(node[i])
                if long:
                    if out.add((s0, node0, int(n[i]), [], [], False)):
                        yield out.frame()
                    continue
                members.append(node0)
                sizes.append(int(n[i]))
                if len(members) > short:
                    long = True
                    for m, k in zip(members, sizes, strict=True):
                        if out.add((s0, m, k, [], [], False)):
                            yield out.frame()
        yield from end()
        yield out.frame()

    posted = docs.select("text").mapInPandas(post, "s long, node long, n int")
    posted = posted.repartition(F.expr("if(n < 0, xxhash64(s, node), s)")).sortWithinPartitions("s", "node")
    return posted.mapInPandas(lists, "s long, node long, n int, partners array<long>, sizes array<int>, whole boolean")


def _search(index: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that the merge of a's short lists leaves to be probed."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = Emitter(["a", "b"], most=10_000)
        rows = rows_of(batches, "node", "n", "partners", "sizes", "whole")
        for (a, n), mine in groupby(rows, key=lambda r: (r[0], r[1])):
            # The members of a list stand in order, so the lists merge as they are.
            lists, long, found = [], 0, set()
            for _, _, partners, sizes, whole in mine:
                if whole:
                    lists.append(zip(partners.tolist(), sizes.tolist(), strict=True))
                long += not whole
            # Of the lists that a pair must share, so many may be long; the others are found by the merge.
            for (b, k), group in groupby(heapq.merge(*lists)):
                if sum(1 for _ in group) >= least_merged(n, k, percent) - long:
                    found.add((b, k))
            for b, k in sorted(found):
                if least_common(n, k, percent) <= min(n, k) and out.add((a, b)):
                    yield out.frame()
        yield out.frame()

    rows = index.repartition("node").sortWithinPartitions("node")
    return rows.mapInPandas(run, "a long, b long").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _filter_of(ids: DataFrame) -> np.ndarray:
    """Packed bits of the nodes in ``ids``; 2 MB whatever their number. A full filter lets all pass, and the join decides."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits = np.zeros(FILTER_BITS, bool)
        for pdf in batches:
            bits[_slots(pdf["node"].to_numpy(np.int64))] = True
        words = np.packbits(bits).view(np.int64)
        at = np.flatnonzero(words)
        yield pd.DataFrame({"at": at.astype(np.int32), "word": words[at]})

    out = np.zeros(FILTER_BITS // 64, np.int64)
    got = ids.mapInPandas(run, "at int, word long").groupBy("at").agg(F.bit_or("word").alias("word")).toArrow().to_pandas()
    out[got["at"].to_numpy(np.int64)] = got["word"]
    return out.view(np.uint8)


def _slots(nodes: np.ndarray) -> np.ndarray:
    return (nodes.view(np.uint64) >> np.uint64(64 - FILTER_BITS.bit_length() + 1)).astype(np.int64)


def _sets(docs: DataFrame, wanted: DataFrame, size: int, rows: int) -> DataFrame:
    """(node, hashes) of the nodes wanted: one pass over the texts, of which the filter lets few pass."""
    wanted = materialize(wanted.distinct(), "wanted", rows)
    bits = _filter_of(wanted)

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[int] = set()
        out = Emitter(["node", "hashes"])
        for (text,) in rows_of(batches, "text"):
            h = shingles(text_of(text), size)
            if len(h):
                key = set_key(h)
                slot = int(_slots(np.array([key], np.int64))[0])
                if bits[slot >> 3] >> (7 - (slot & 7)) & 1 and _first_seen(seen, key) and out.add((key, h.tobytes()), 8 * len(h)):
                    yield out.frame()
        yield out.frame()

    found = docs.select("text").mapInPandas(fetch, "node long, hashes binary")
    return materialize(found.join(wanted, "node", "left_semi").groupBy("node").agg(F.first("hashes").alias("hashes")), "sets", wanted.count(), 5_000)


def _probe(sets: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs that reach the similarity, with the number of shingles they share."""
    both = pairs.join(sets.toDF("a", "of_a"), "a").join(sets.toDF("b", "of_b"), "b")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            common, least = [], []
            for x, y in zip(pdf["of_a"], pdf["of_b"], strict=True):
                query, other = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                if len(query) > len(other):
                    query, other = other, query
                at = np.searchsorted(other, query)  # a binary probe for each shingle
                common.append(int((other[np.minimum(at, len(other) - 1)] == query).sum()))
                least.append(least_common(len(query), len(other), percent))
            yield pd.DataFrame({"a": pdf["a"], "b": pdf["b"], "common": common})[np.array(common, np.int64) >= np.array(least, np.int64)]

    return both.mapInPandas(compare, "a long, b long, common long")


def links(docs: DataFrame, heavy: tuple[np.ndarray, np.ndarray], size: int = SHINGLE, percent: int = PERCENT, short: int = SHORT) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Links (a, b, common) between different sets, enough to connect all that are linked; their components; and their sets."""
    index = materialize(_index(docs, heavy, size, percent, short), "index")
    rows, long = index.count(), index.where("NOT whole")
    pairs, members, n_long = _search(index, percent), None, long.count()
    if n_long:
        members = materialize(_ranked(long), "members", n_long)
        pairs = pairs.unionByName(_stars(members, percent)).distinct()
    pairs = materialize(pairs, "pairs", rows)
    wanted = long.select("node").unionByName(pairs.select(F.explode(F.array("a", "b")).alias("node")))
    sets = _sets(docs, wanted, size, rows)
    found = _linked(sets, pairs, percent)
    groups = materialize(connected_components(found, "a", "b"), "groups", rows)
    if members is not None:
        rest = _unsettled(members, groups, percent, n_long).join(pairs, ["a", "b"], "left_anti")
        more = _linked(sets, materialize(rest, "pairs", 4 * n_long), percent)
        if not more.isEmpty():
            found = found.unionByName(more)
            groups = materialize(connected_components(found, "a", "b"), "groups", rows)
    return found, groups, sets


def _linked(sets: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The links among materialized pairs, materialized."""
    return materialize(_probe(sets, pairs, percent), "links", max(pairs.count(), sets.count()), 5_000)


def _joined(many: DataFrame, few: DataFrame, on: str, salted_by: str = "node") -> DataFrame:
    """Join with a table of few rows for each ``on``: broadcast if it is small, else salted, so that no ``on`` is one task's."""
    if few.count() <= FEW:
        return many.join(F.broadcast(few), on)
    salt = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt")
    return many.withColumn("_salt", F.pmod(F.xxhash64(salted_by), F.lit(SALTS)).cast("int")).join(few.select("*", salt), [on, "_salt"]).drop("_salt")


def _ranked(members: DataFrame) -> DataFrame:
    """Members (s, node, n) of long lists, with each list's size, each node's number of lists m, and from which
    on, in one order of all lists, it has ``room`` for others.
    """
    sizes = materialize(members.groupBy("s").agg(F.count("*").alias("size")), "sizes")
    lists = Window.partitionBy("node")
    own = _joined(members.select("s", "node", "n"), sizes, "s")
    return own.withColumns({"m": F.count("*").over(lists), "room": F.count("*").over(lists) - F.row_number().over(lists.orderBy("size", "s")) + 1})


def _must_share(n: str, k: str, percent: int) -> tuple[Column, Column]:
    """(whether the sizes allow the similarity, how many indexed lists sets of the sizes must share)."""
    common = F.floor((percent * (F.col(n) + F.col(k)) + (100 + percent - 1)) / (100 + percent))
    return common <= F.least(n, k), common - F.floor((percent * F.greatest(n, k) + 99) / 100) + 1


def _pair(x: str, y: str) -> list[Column]:
    return [F.greatest(x, y).alias("a"), F.least(x, y).alias("b")]


def _stars(members: DataFrame, percent: int) -> DataFrame:
    """Each long list's LEADERS with all its members. Those in most long lists lead: of many near copies, the least edited.

    They are chosen within parts of a list first, so that no task ranks all of a list.
    """
    first = [F.desc("m"), F.col("node")]
    part = F.pmod(F.xxhash64("node"), F.lit(SALTS))
    some = members.withColumn("_part", part).withColumn("_r", F.row_number().over(Window.partitionBy("s", "_part").orderBy(*first))).where(F.col("_r") <= LEADERS)
    some = some.withColumn("_r", F.row_number().over(Window.partitionBy("s").orderBy(*first))).where(F.col("_r") <= LEADERS)
    leaders = materialize(some.select("s", F.col("node").alias("x"), F.col("n").alias("nx"), F.col("m").alias("mx")), "leaders")
    allowed, share = _must_share("n", "nx", percent)
    pairs = _joined(members, leaders, "s").where((F.col("node") != F.col("x")) & allowed & (share <= F.least("m", "mx")))
    return pairs.select(*_pair("node", "x")).distinct()


def _unsettled(members: DataFrame, groups: DataFrame, percent: int, rows: int) -> DataFrame:
    """Pairs of a long list that are still in different components and that the merge may have missed.

    The merge missed a pair only if the two share no short list, and so as many long
    ones as they must share in all. The first list they share then has to leave each of
    them room for the others, which is tested with the lists in one order, short ones
    first. A list's largest component isn't paired within, only with the members
    outside it. Members are dealt into blocks, and each pair of blocks meets by itself.
    """
    own = members.select("s", "node", "n", "room").join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    shares = own.groupBy("s", "component").agg(F.count("*").alias("k"))
    main = shares.groupBy("s").agg(F.max(F.struct("k", "component")).alias("main"), F.sum("k").alias("size"), F.count("*").alias("parts")).where("parts > 1")
    blocks = [F.ceil(F.col(c) / BLOCK).cast("int").alias(f"blocks_{c}") for c in ("size", "outside")]
    main = main.select("s", F.col("main.component").alias("main"), "size", (F.col("size") - F.col("main.k")).alias("outside")).select("s", "main", *blocks)
    own = materialize(_joined(own, materialize(main, "main"), "s"), "members", rows)

    def block(of: str) -> Column:
        return F.pmod(F.xxhash64("node"), F.col(of)).cast("int")

    def all_of(of: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(of) - 1))

    y = own.where("component <> main").select("s", F.col("node").alias("x"), F.col("n").alias("nx"), F.col("room").alias("rx"), F.col("component").alias("cx"), block("blocks_outside").alias("i"), all_of("blocks_size").alias("j"))
    own = own.select("s", "node", "n", "room", "component", "main", block("blocks_size").alias("j"), all_of("blocks_outside").alias("i"))
    allowed, share = _must_share("n", "nx", percent)
    # Of two members outside the largest component, each finds the other: one of the two is enough.
    once = (F.col("component") == F.col("main")) | (F.col("node") > F.col("x"))
    pairs = own.join(y, ["s", "i", "j"]).where((F.col("component") != F.col("cx")) & once & allowed & (share <= F.least("room", "rx")))
    return pairs.select(*_pair("node", "x")).distinct()


def _common(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """How many shingles each of x shares with each of y, the lists of all merged: a list adds one to its members' pairs."""
    out = np.zeros((len(x), len(y)), np.float32)
    if len(x) * len(y) <= 16:
        for i, a in enumerate(x):
            for j, b in enumerate(y):
                small, large = (a, b) if len(a) <= len(b) else (b, a)
                out[i, j] = (large[np.minimum(np.searchsorted(large, small), len(large) - 1)] == small).sum()
        return out
    owner = np.repeat(np.arange(len(x) + len(y)), [len(h) for h in (*x, *y)])
    h = np.concatenate([*x, *y])
    order = np.argsort(h, kind="stable")
    h, owner = h[order], owner[order]
    column = np.cumsum(np.concatenate([[0], h[1:] != h[:-1]]))
    keep = np.bincount(column)[column] > 1  # a list of one joins nothing
    column, owner = np.unique(column[keep], return_inverse=True)[1], owner[keep]
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
        a, b = np.searchsorted(column, [low, low + 4096])
        m = np.zeros((len(x) + len(y), 4096), np.float32)
        m[owner[a:b], column[a:b] - low] = 1
        out += m[: len(x)] @ m[len(x) :].T
    return out


def _in_components(sets: DataFrame, groups: DataFrame, copies: DataFrame, percent: int, pairs: bool) -> DataFrame:
    """All links of different sets, every pair of a component being compared once.

    ``pairs``: (a, b, common) of each. Else (node, others): how many documents' sets each is linked with.
    """
    own = materialize(groups.join(sets, "node").join(copies, "node").select("node", "component", "hashes", "copies"), "linked")
    parts = own.groupBy("component").agg(F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum(F.length("hashes")) / BLOCK_BYTES)).cast("int").alias("blocks"))
    own = _joined(own, materialize(parts, "parts"), "component").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    x = own.withColumns({"lo": F.col("block"), "hi": F.explode(F.expr("sequence(block, blocks - 1)")), "side": F.lit(0)})
    y = own.where("block > 0").withColumns({"hi": F.col("block"), "lo": F.explode(F.expr("sequence(0, block - 1)")), "side": F.lit(1)})
    dealt = x.unionByName(y).select("component", "lo", "hi", "side", "node", "copies", "hashes").repartition("component", "lo", "hi").sortWithinPartitions("component", "lo", "hi", "side")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = rows_of(batches, "component", "lo", "hi", "side", "node", "copies", "hashes")
        for (_, lo, hi), group in groupby(rows, key=lambda r: r[:3]):
            ends = [[], []]
            for r in group:
                ends[r[3]].append((int(r[4]), int(r[5]), np.frombuffer(r[6], np.uint64)))
            a, b = ends[0], ends[0] if lo == hi else ends[1]
            if not a or not b:
                continue
            common = _common([h for _, _, h in a], [h for _, _, h in b]).astype(np.int64)
            sizes = np.array([len(h) for _, _, h in a])[:, None] + np.array([len(h) for _, _, h in b])[None, :]
            link = common >= -(-percent * sizes // (100 + percent))
            node = [np.array([n for n, _, _ in e], np.int64) for e in (a, b)]
            if lo == hi:
                np.fill_diagonal(link, False)
            if pairs:
                i, j = np.nonzero(np.triu(link) if lo == hi else link)
                yield pd.DataFrame({"a": np.maximum(node[0][i], node[1][j]), "b": np.minimum(node[0][i], node[1][j]), "common": common[i, j]})
            else:
                copies = [np.array([c for _, c, _ in e], np.int64) for e in (a, b)]
                yield pd.DataFrame({"node": node[0], "others": link @ copies[1]})
                if lo != hi:
                    yield pd.DataFrame({"node": node[1], "others": link.T @ copies[0]})

    if pairs:
        return dealt.mapInPandas(compare, "a long, b long, common long")
    return dealt.mapInPandas(compare, "node long, others long").groupBy("node").agg(F.sum("others").alias("others"))


def near_duplicates(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, short: int = SHORT, count_links: bool = False) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id (the least doc_id of all it is linked with).

    ``count_links``: and n_links, how many other rows' sets are equal or reach the similarity; all links are found for it.
    """
    surveyed = materialize(survey(docs, size), "survey")
    rows = rows_in(surveyed)
    found, groups, hashes = links(docs, heavy_in(surveyed), size, percent, short)
    linked = groups
    sets = rows.where("node IS NOT NULL")
    least = sets.groupBy("node").agg(F.min("_key").alias("least"))
    several = sets.groupBy("_key").agg(F.min("node").alias("b"), F.max("node").alias("most")).where("b < most")
    same = materialize(sets.join(several, "_key").where("node > b").select(F.col("node").alias("a"), "b"), "same", rows.count(), 1_000_000)
    if not same.isEmpty():
        groups = connected_components(found.select("a", "b").unionByName(same), "a", "b")
    own = least.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = own.groupBy("component").agg(F.min("least").alias("name"))
    least = own.join(named, "component").select("node", F.col("name").alias("least"))
    some = sets.join(least, "node").select("_key", "n", F.col("least").alias("component"), "node")
    none = rows.where("node IS NULL").select("_key", "n", F.col("_key").alias("component"))
    counted = []
    if count_links:
        copies = sets.groupBy("node").agg(F.count("*").alias("copies"))
        others = _in_components(hashes, linked, copies, percent, False)
        n_links = copies.join(others, "node", "left").select("node", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
        some, none, counted = some.join(n_links, "node"), none.withColumn("n_links", F.lit(0).cast("long")), ["n_links"]
    out = some.drop("node").unionByName(none)
    return unkeyed(out.select("_key", F.col("n").alias("n_shingles"), F.when(F.col("component") != LEAST, F.col("component")).alias("component_id"), *counted))


def link_pairs(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, short: int = SHORT) -> DataFrame:
    """All links between different sets: (doc_a, doc_b, n_common), each set named by its least doc_id, doc_a < doc_b."""
    surveyed = materialize(survey(docs, size), "survey")
    _, groups, hashes = links(docs, heavy_in(surveyed), size, percent, short)
    sets = rows_in(surveyed).where("node IS NOT NULL").groupBy("node").agg(F.min("_key").alias("least"), F.count("*").alias("copies"))
    found = _in_components(hashes, groups, sets.select("node", "copies"), percent, True)
    for end in ("a", "b"):
        found = found.join(sets.select(F.col("node").alias(end), F.col("least").alias(f"of_{end}")), end)
    named = [F.when(c != LEAST, c) for c in (F.least("of_a", "of_b"), F.greatest("of_a", "of_b"))]
    return found.select(named[0].alias("doc_a"), named[1].alias("doc_b"), F.col("common").alias("n_common"))


def keep_one(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one document of each component, that of the least doc_id; rows without words all stay."""
    found = near_duplicates(docs, size, percent)
    keep = found.groupBy("doc_id").agg(F.min("component_id").alias("_component"), F.max("n_shingles").alias("_most"), F.count("*").alias("_copies"))
    keep = materialize(keep.where(F.col("doc_id").eqNullSafe(F.col("_component"))), "keep")
    repeated = (F.col("_copies") > 1) & (F.col("_most") > 0)

    own, row = unused(docs, "_id"), unused(docs, "_row")

    def of(ids: DataFrame) -> DataFrame:
        return docs.join(ids.select(F.col("doc_id").alias(own)), docs["doc_id"].eqNullSafe(F.col(own)), "left_semi")

    if keep.where(repeated).isEmpty():
        return of(keep)
    first = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.desc(F.length("text")), "text"))
    once = of(keep.where(repeated)).withColumn(row, first).where(F.col(row) == 1).drop(row)
    return of(keep.where(~repeated)).unionByName(once)
