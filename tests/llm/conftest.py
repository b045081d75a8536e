from decimal import Decimal

import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang) rows."""

    def make(rows, parts=3):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, SCHEMA).repartition(parts)

    return make


@pytest.fixture(scope="session")
def odd(docs_of):
    """Nulls everywhere, empty and very long texts, ties, repeated rows, and columns with clashing names."""
    long = " ".join(f"word{i % 977}" for i in range(60_000))
    rows = [(5, "same text here"), (5, "same text here"), (6, "same text here"), (7, None), (8, ""), (None, "no id at all"), (9, long), (10, "\x00 \t\n"), (11, "ünïcödé ★ 中文"), (12, "a")]
    return docs_of(rows).withColumns({"node": F.lit(1), "n": F.lit("x"), "bucket": F.lit(Decimal(1)), "key": F.lit(None).cast("int"), "_row": F.lit(2)})
