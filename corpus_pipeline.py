"""A corpus pipeline of five stages over ``documents``.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and returns the
documents that go on, with the columns of ``documents``. The last returns the encoded
corpus. Between stages the documents are written to the shared folder and read again,
so that an executor that is lost costs one stage's tasks.

Every stage takes any table with doc_id and text, whatever its other columns are called, and
keeps these. A null or empty text is in no stage a reason to go, is not redacted, and is encoded
as no ids. Rows that repeat a doc_id with the same text are one document to the near-duplicate
stage, of which one row stays. An empty table stays empty. Very long texts are judged whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeweave.llm import decontaminate, jaccard, pieces, secrets, toxicity
from citeweave.llm.common import fold
from citeweave.session import materialize, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity models reject go. Labels of one fold in four are never read."""
    learn = ~F.coalesce(fold("doc_id", 4) == 2, F.lit(False))
    return toxicity.keep_ordinary(docs, toxicity.fit(docs, table(spark, sf_dir, "labels"), learn))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, that of the least doc_id."""
    return jaccard.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark windows cover a twentieth of the words or more go."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; secrets give way to their kind in brackets."""
    return secrets.redact(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The encoded corpus: doc_id, n_tokens, ids (32 bits each), ids_crc32, score, round_trip of every document."""
    import public_tokenizers

    return pieces.encode_packed(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("pieces", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs, name)
    return docs


#: SQL can express neither the toxicity models nor the segmentation; tests/llm holds the stages against brute force.
ORACLE_SQL = None
