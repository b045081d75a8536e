"""URL filters: host and path rules, and a list of canonical URLs behind a blocked Bloom filter.

Every key sets its bits in one 512-bit block, so that a probe touches one cache line.
The filter lets possible hits pass; an exact join with the list removes its false
positives. The list's size decides the filter's, up to a bound on what is broadcast: a
fuller filter lets more pass, and the join still decides.

Nulls: a null url, or one without ``://``, has an empty host and path, no rule, and is
allowed; a null in the list lists nothing. Ties: of rules of one length the first in
order of text. Repeated urls are judged each. An empty list blocks nothing. Urls of any
length are judged whole; columns other than page_id and url are never read. Only rows that
pass the filter are shuffled to meet the list.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeweave.llm.common import mix
from citeweave.session import materialize

#: (verdict, host, path)
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
BLOCK_WORDS, BITS_A_KEY, PROBES = 8, 12, 6
#: Bytes that a filter takes at most.
MOST_BYTES = 64 << 20
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def after_scheme(url: str) -> Column:
    """What follows the first ``://``; empty where there is none."""
    at = F.instr(F.col(url), F.lit("://"))
    return F.when(at > 0, F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)")).otherwise(F.lit(""))


def host_of(rest: Column) -> Column:
    return F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _UPPER, _LOWER)


def path_of(rest: Column) -> Column:
    return F.regexp_extract(F.regexp_replace(rest, "^[^/?#]*", ""), "^[^?#]*", 0)


def canonical(rest: Column) -> Column:
    """Host without ``www.``, ``m.`` and a default port, path without end slashes, query without tracking; null if empty."""
    host = F.regexp_replace(F.regexp_replace(host_of(rest), "^(www|m)[.]", ""), ":(80|443)$", "")
    path = F.regexp_replace(path_of(rest), "/+$", "")
    query = F.regexp_extract(F.regexp_replace(rest, "#(.|\\n)*$", ""), "[?]((.|\\n)*)$", 1)
    query = F.regexp_replace(F.regexp_replace(F.concat(F.lit("&"), query), "&(utm_[a-z]*|ref)=[^&]*", ""), "^&", "")
    return F.nullif(F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit(""))), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; nulls if none does."""
    rule = verdict = F.lit(None).cast("string")
    for what, h, p in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]), reverse=True):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def _places(keys: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Each key's block, and its bits there as BLOCK_WORDS words."""
    h = mix(keys.view(np.uint64))
    block = (h % np.uint64(blocks)).astype(np.int64)
    words = np.zeros((len(keys), BLOCK_WORDS), np.uint64)
    row = np.arange(len(keys))
    for i in range(PROBES):
        bit = (mix(h + np.uint64(i + 1)) >> np.uint64(55)).astype(np.int64)
        words[row, bit >> 6] |= np.uint64(1) << (bit & 63).astype(np.uint64)
    return block, words


class BlockedBloom:
    """A Bloom filter of blocks; built by Spark, one partial row for each block and task."""

    def __init__(self, keys: DataFrame, column: str, most_bytes: int = MOST_BYTES):
        blocks = self.blocks = max(1, min(-(-keys.count() * BITS_A_KEY // (64 * BLOCK_WORDS)), most_bytes // (8 * BLOCK_WORDS)))
        names = [f"w{i}" for i in range(BLOCK_WORDS)]

        def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                block, words = _places(pdf["key"].to_numpy(np.int64), blocks)
                yield pd.DataFrame(words.view(np.int64), columns=names).assign(block=block)

        rows = keys.select(F.col(column).alias("key")).where("key IS NOT NULL").mapInPandas(place, ", ".join(f"{n} long" for n in names) + ", block long")
        got = rows.groupBy("block").agg(*[F.bit_or(n).alias(n) for n in names]).toArrow().to_pandas()
        self.words = np.zeros((blocks, BLOCK_WORDS), np.int64)
        self.words[got["block"].to_numpy(np.int64)] = got[names].to_numpy(np.int64)

    def may_hold(self, keys: np.ndarray) -> np.ndarray:
        block, words = _places(keys, self.blocks)
        words = words.view(np.int64)
        return ((self.words[block] & words) == words).all(axis=1)


def judge(pages: DataFrame, listed: DataFrame, rules=RULES) -> DataFrame:
    """Per page: page_id, host, path, rule, verdict. ``listed`` has a column url."""
    rest = after_scheme("url")
    names = materialize(listed.select(canonical(rest).alias("name")).where("name IS NOT NULL").distinct(), "listed")
    bloom = BlockedBloom(names.select(F.xxhash64("name").alias("key")), "key")
    held = pages.sparkSession.sparkContext.broadcast(bloom)

    @F.pandas_udf("boolean")
    def possible(keys: pd.Series) -> pd.Series:
        return pd.Series(held.value.may_hold(keys.to_numpy(np.int64)))

    rows = pages.select("page_id", host_of(rest).alias("host"), path_of(rest).alias("path"), canonical(rest).alias("name"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.select("*", rule.alias("rule"), verdict.alias("ruled"))
    rows = rows.withColumn("possible", F.col("ruled").isNull() & F.col("name").isNotNull() & possible(F.coalesce(F.xxhash64("name"), F.lit(0))))
    rows = materialize(rows.select("page_id", "host", "path", "rule", "ruled", "possible", F.when(F.col("possible"), F.col("name")).alias("name")), "urls")
    hits = rows.where("possible").join(names.withColumn("on_list", F.lit(True)), "name", "left")
    found = F.when(F.col("on_list"), F.lit("block")).otherwise(F.lit("allow"))
    out = rows.where("NOT possible").select("page_id", "host", "path", "rule", F.coalesce("ruled", F.lit("allow")).alias("verdict"))
    return out.unionByName(hits.select("page_id", "host", "path", "rule", found.alias("verdict")))
