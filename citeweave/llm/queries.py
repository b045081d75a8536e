"""The registered queries of the corpus operators, and their SQL where there is any."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from citeweave.llm import align, decontaminate, fim, jaccard, language, pieces, quality, secrets, shards, tokens, toxicity, urls, winnow
from citeweave.llm.common import fold
from citeweave.session import scratch_path, table

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer's file; a cluster has them at the same place on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base spans of every text, and the spans that the automata add."""
    return secrets.scan(table(spark, sf_dir, "documents"))


def op2_winnow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they are."""
    return winnow.compare_edited(table(spark, sf_dir, "documents"))


def op3_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text's ids, from the files that they were written to."""
    return tokens.write_and_read(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted languages; languages of one fold in three are never read."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(fold("doc_id", 3) == 1, F.lit(False))
    found = language.identify(docs, language.fit(docs, ~held_out))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of every text; labels of one fold in four are never read."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(fold("doc_id", 4) == 2, F.lit(False))
    found = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels"), ~held_out))
    return found.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op6_compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Appends the documents as sixteen arrivals, compacts, and reads the table that the last manifest names."""
    docs = table(spark, sf_dir, "documents")
    store = shards.ingest(docs, scratch_path(spark, "shards"))
    return store.read(docs.schema).select("doc_id", F.length("text").cast("long").alias("n_chars"), F.md5(F.col("text").cast("binary")).alias("text_md5"))


def op7_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list: of the canonical urls of all pages, those whose MD5 begins with 0, a sixteenth."""
    pages = table(spark, sf_dir, "pages")
    return urls.judge(pages, pages.where(F.md5(urls.canonical(urls.after_scheme("url")).cast("binary")).startswith("0")).select("url"))


def op8_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components, and every document's number of links, for which all links are found."""
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"), count_links=True)


def op8_jaccard_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The links themselves, between the representatives of equal sets."""
    return jaccard.link_pairs(table(spark, sf_dir, "documents"))


def op9_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """n_tokens, checksum of the ids, score and round trip; the ids themselves stay with the operator's rows."""
    return pieces.encode_packed(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model")).drop("ids")


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much of every text benchmark windows cover, and of which items."""
    return decontaminate.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of one fold in five are never read."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(fold("doc_id", 5) == 0, F.lit(False))
    found = quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels"), ~held_out))
    return found.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op12_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checksums of the rearranged texts and of the texts rebuilt from them."""
    return fim.digests(fim.rearrange(table(spark, sf_dir, "documents")))


def op13_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of the byte-level tokens and the pieces of every text."""
    return align.align(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


OP6_SQL = "SELECT doc_id, CAST(length(text) AS BIGINT) AS n_chars, md5(text) AS text_md5 FROM documents"

OP7_SQL = r"""
WITH parts AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
split AS (
  SELECT page_id, rest, translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(regexp_replace(rest, '^[^/?#]*', ''), '^[^?#]*', 0) AS path
  FROM parts),
named AS (
  SELECT *, regexp_replace(regexp_replace(host, '^(www|m)[.]', ''), ':(80|443)$', '') || regexp_replace(path, '/+$', '')
    || CASE WHEN query = '' THEN '' ELSE '?' || query END AS name
  FROM (SELECT *, regexp_replace(regexp_replace('&' || regexp_extract(regexp_replace(rest, '#(.|\n)*$', ''), '[?]((.|\n)*)$', 1), '&(utm_[a-z]*|ref)=[^&]*', '', 'g'), '^&', '') AS query FROM split)),
rules(verdict, h, p) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
ruled AS (
  SELECT page_id, max_by(h || p, length(h || p)) AS rule, max_by(verdict, length(h || p)) AS verdict
  FROM named JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id),
listed AS (
  SELECT DISTINCT name FROM named WHERE name <> '' AND md5(name)[1] = '0')
SELECT n.page_id, n.host, n.path, r.rule, coalesce(r.verdict, CASE WHEN n.name IN (SELECT name FROM listed) THEN 'block' ELSE 'allow' END) AS verdict
FROM named n LEFT JOIN ruled r USING (page_id)
"""

_OP8_COMMON = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)]) END AS s
  FROM words),
grams AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, a.n + b.n AS n, count(*) AS k FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id
  WHERE least(a.n, b.n) * 100 >= 75 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*)))"""

OP8_SQL = (
    _OP8_COMMON
    + """,
links AS (SELECT a, b FROM common UNION ALL SELECT b, a FROM common),
reach AS (
  SELECT doc_id AS node, doc_id AS root FROM documents
  UNION
  SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.node),
counted AS (SELECT a AS doc_id, count(*) AS n_links FROM links GROUP BY a)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, min(r.root) AS component_id, CAST(coalesce(any_value(c.n_links), 0) AS BIGINT) AS n_links
FROM sets s JOIN reach r ON r.node = s.doc_id LEFT JOIN counted c ON c.doc_id = s.doc_id GROUP BY s.doc_id, s.s
"""
)

#: Of documents with equal sets (2 * common = both sizes) the least stands for all.
OP8_LINKS_SQL = (
    _OP8_COMMON
    + """,
copies AS (SELECT b FROM common WHERE 2 * k = n)
SELECT a AS doc_a, b AS doc_b, CAST(k AS BIGINT) AS n_common FROM common
WHERE 2 * k < n AND a NOT IN (SELECT b FROM copies) AND b NOT IN (SELECT b FROM copies)
"""
)

OP10_SQL = r"""
WITH norm AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
items AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, size, array_to_string(w[i:i + size - 1], ' ') AS gram
  FROM (SELECT item_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM (SELECT item_id, w, least(13, len(w)) AS size FROM items WHERE len(w) > 0))),
found AS (
  SELECT d.doc_id, d.i, d.size, x.item_id
  FROM (SELECT doc_id, size, unnest(range(1, len(w) - size + 2)) AS i, w FROM norm, (SELECT DISTINCT size FROM windows) WHERE len(w) >= size) d
  JOIN windows x ON x.size = d.size AND x.gram = array_to_string(d.w[d.i:d.i + d.size - 1], ' ')),
hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM found) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id)
SELECT n.doc_id, CAST(len(n.w) AS BIGINT) AS n_words, CAST(coalesce(h.n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(m.n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(m.items, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AND 20 * coalesce(h.n_hit, 0) >= len(n.w) AS contaminated
FROM norm n LEFT JOIN hits h USING (doc_id) LEFT JOIN named m USING (doc_id)
"""

OP12_SQL = r"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS w,
    sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents),
drawn AS (
  SELECT doc_id, text, w, len(w) AS n, CAST('0x' || h[1:8] AS UBIGINT) % (len(w) + 1) AS x, CAST('0x' || h[9:16] AS UBIGINT) % (len(w) + 1) AS y,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR CAST('0x' || h[17:24] AS UBIGINT) % 100 >= 90 THEN 'plain'
      WHEN CAST('0x' || h[25:32] AS UBIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM cut),
parts AS (
  SELECT doc_id, text, n, form, array_to_string(w[1:least(x, y)], '') AS p,
    array_to_string(w[least(x, y) + 1:greatest(x, y)], '') AS m, array_to_string(w[greatest(x, y) + 1:], '') AS s
  FROM drawn)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
  CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts
"""

QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (op1_secrets, op2_winnow, op3_tokens, op4_language, op5_toxicity, op6_compact, op7_urls, op8_jaccard, op8_jaccard_links, op9_pieces, op10_decontaminate, op11_quality, op12_fim, op13_align)
} | {"pipeline": corpus_pipeline.run}

#: The others are tested against brute force, exact round trips or held-out accuracy.
ORACLE_SQL: dict[str, str] = {"op6_compact": OP6_SQL, "op7_urls": OP7_SQL, "op8_jaccard": OP8_SQL, "op8_jaccard_links": OP8_LINKS_SQL, "op10_decontaminate": OP10_SQL, "op12_fim": OP12_SQL}
if corpus_pipeline.ORACLE_SQL:
    ORACLE_SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
