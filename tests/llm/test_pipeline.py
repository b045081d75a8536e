import numpy as np
import public_tokenizers
import pytest
import test_decontaminate
import test_jaccard
import test_pieces
import test_secrets

import corpus_pipeline
from citeweave.llm import decontaminate, pieces, secrets
from citeweave.llm.queries import ORACLE_SQL, QUERIES, op5_toxicity

SF = "/root/testdata/sf0.001"


def test_stages_hand_on_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").cache()
    columns, ids = docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF).cache()
        assert docs.columns == columns, name
        now = {r.doc_id for r in docs.select("doc_id").collect()}
        assert now <= ids and len(now) > 0.6 * len(ids), name
        ids = now
    clean = decontaminate.judged(docs, spark.read.parquet(f"{SF}/benchmark.parquet"))
    assert clean.where("contaminated").count() == 0
    texts = [r.text for r in docs.collect()]
    assert not any(secrets.base_spans(t) for t in texts)
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert last.where("round_trip").count() == len(ids)
    assert corpus_pipeline.run(spark, SF).count() == len(ids)


def texts_of(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages_are_what_brute_force_gives(spark):
    """Each stage on what its predecessor kept, against plain Python over the same rows."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stage = dict(corpus_pipeline.STAGES)
    now = stage["toxicity"](spark, docs, SF).cache()
    ordinary = {r.doc_id for r in op5_toxicity(spark, SF).where("predicted = 0").collect()}
    before, texts = texts_of(docs), texts_of(now)
    assert texts == {i: t for i, t in before.items() if i in ordinary}

    now = stage["near_duplicates"](spark, now, SF).cache()
    least = {i for i, _, c in test_jaccard.brute(sorted(texts.items())) if i == c}
    assert texts_of(now) == {i: t for i, t in texts.items() if i in least}
    texts = texts_of(now)

    items = [(str(r.item_id), test_decontaminate.contract_words(r.text)) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = set()
    for i, t in texts.items():
        words = test_decontaminate.contract_words(t)
        hit = test_decontaminate.hit_by_windows(words, items, 13)
        if not hit or 20 * len(hit) < len(words):
            clean.add(i)
    now = stage["decontamination"](spark, now, SF).cache()
    assert texts_of(now) == {i: t for i, t in texts.items() if i in clean}
    texts = texts_of(now)

    assert secrets.scan(now).where("n_format > 0").count() == 0
    now = stage["secrets"](spark, now, SF).cache()
    assert texts_of(now) == {i: secrets.redacted(t, [(*s, 0.0) for s in test_secrets.brute(t)]) for i, t in texts.items()}
    texts = texts_of(now)

    vocabulary = pieces.Vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    rows = {r.doc_id: r for r in stage["pieces"](spark, now, SF).collect()}
    assert set(rows) == set(texts) and all(r.round_trip for r in rows.values())
    for i in sorted(texts)[::8]:
        score, ids = test_pieces.plain(vocabulary, texts[i])
        assert np.frombuffer(rows[i].ids, "<u4").tolist() == ids and abs(rows[i].score * pieces.UNIT - score) < 1


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_odd_and_empty_tables(spark, odd, docs_of, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    out = stage(spark, odd, SF)
    if name != "pieces":
        assert out.columns == odd.columns
    assert out.count() == (8 if name == "near_duplicates" else 10)
    assert stage(spark, docs_of([]), SF).count() == 0


def test_every_operator_has_a_query():
    assert {f"op{n}" for n in range(1, 14)} | {"pipeline"} == {q.split("_")[0] for q in QUERIES}
    assert set(ORACLE_SQL) <= set(QUERIES)
