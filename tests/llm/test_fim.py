import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from citeweave.llm import fim
from citeweave.llm.queries import op12_fim

COLUMNS = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]


def brute(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    prefix, middle, suffix = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        form, out = "plain", text
    elif h[3] % 100 < 20:
        form, out = "spm", f"<S>{suffix}<P>{prefix}<M>{middle}"
    else:
        form, out = "psm", f"<P>{prefix}<S>{suffix}<M>{middle}"
    none = form == "plain"
    return (doc_id, len(units), form, None if none else len(prefix), None if none else len(middle), out)


def random_text(r):
    return "".join(r.choice("abcZ <PSM>\n\x00é中😀-9") for _ in range(r.choice([0, 1, 2, 7, 30, 200])))


def test_outputs_and_restored_texts(docs_of):
    r = random.Random(5)
    rows = [(i, random_text(r)) for i in range(400)] + [(401, None), (None, "no id"), (402, "a<P>b"), (403, "a<S"), (403, "a<S"), (404, "<M")]
    made = fim.rearrange(docs_of(rows))
    got = sorted((tuple(x) for x in made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output").collect()), key=repr)
    assert got == sorted((brute(*x) for x in rows), key=repr)
    assert {x[2] for x in got} == {"plain", "psm", "spm"}
    back = made.select("doc_id", fim.restored().alias("text")).collect()
    assert sorted(map(tuple, back), key=repr) == sorted(((i, t or "") for i, t in rows), key=repr)


def test_masks_and_ranks():
    r = random.Random(2)
    for _ in range(300):
        text = random_text(r)
        data = text.encode()
        begins, tokens = fim.masks(data)
        assert begins.bit_count() == len(text)
        places = [len(text[: m.start()].encode()) for m in re.finditer(r"[A-Za-z]+|[^A-Za-z]", text)]
        assert [fim.place_of(tokens, len(data), k) for k in range(len(places) + 1)] == [*places, len(data)]


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: r for r in op12_fim(spark, "/root/testdata/sf0.001").select(*COLUMNS).collect()}
    rows = docs.select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for doc_id, text in rows:
        *want, out = brute(doc_id, text)
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (out, text or "")]
        assert list(got[doc_id]) == [*want, *sha]


@pytest.mark.parametrize("block", [fim.BLOCK, 1])
def test_odd_tables(odd, docs_of, monkeypatch, block):
    monkeypatch.setattr(fim, "BLOCK", block)
    got = fim.digests(fim.rearrange(odd)).collect()
    want = odd.select("doc_id", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("s")).collect()
    assert sorted((x.doc_id or 0, x.restored_sha256) for x in got) == sorted((x.doc_id or 0, x.s) for x in want)
    assert fim.rearrange(docs_of([])).count() == 0
