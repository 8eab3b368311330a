"""Displacements against plain slicing, and exact round trips."""

import hashlib
import random

import pytest

from beaconry.llm.fill_in_middle import digests, restore, transform
from beaconry.llm.queries import QUERIES


def by_slicing(doc_id, text):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    n = len(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not n or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}"
    return n, "psm", a, b - a, f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}"


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(9)
    signs = ["a", "é", "日", "🤦", "<", ">", "<P", "S>", "M", " ", "\n", "<M>"]
    made = [(i, "".join(rnd.choice(signs[:rnd.randint(1, 12)]) for _ in range(rnd.choice([0, 1, 2, 5, 30])))) for i in range(500)]
    return made + [(None, "zé日"), (None, None), (7, None), (8, ""), (9, "copy"), (9, "copy"), (10, "long é" * 40_000)]


def test_outputs_and_round_trip(spark, rows):
    docs = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, text string, output string, restored string")
    done = transform(docs)
    got = sorted((tuple(r) for r in done.collect()), key=repr)
    assert got == sorted(((i, *by_slicing(i, t)) for i, t in rows), key=repr)
    back = restore(done, ["doc_id"]).collect()
    assert sorted(((r.doc_id, r.restored) for r in back), key=repr) == sorted(((i, t or "") for i, t in rows), key=repr)
    assert {r.form for r in back} == {"plain", "psm", "spm"}


def test_one_row_batches_and_empty_tables(spark):
    docs = spark.createDataFrame([(3, "<")], "doc_id long, text string")
    assert tuple(transform(docs).first()) == (3, *by_slicing(3, "<"))
    assert digests(docs.limit(0)).count() == 0


def test_shares_are_parameters(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.form for r in transform(docs, plain_percent=100).collect()} == {"plain"}
    assert {r.form for r in transform(docs.where("text not like '%<%' and text <> ''"), plain_percent=0, spm_percent=100).collect()} == {"spm"}


def test_query_over_whole_documents(spark):
    data = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()}

    def digest(text):
        return hashlib.sha256((text or "").encode()).hexdigest()

    rows = QUERIES["op12_fill_in_middle"](spark, data).collect()
    assert len(rows) == len(texts)
    for row in rows:
        *facts, output = by_slicing(row.doc_id, texts[row.doc_id])
        assert (row.n, row.form, row.prefix_chars, row.middle_chars, row.output_sha256, row.restored_sha256) == (
            *facts, digest(output), digest(texts[row.doc_id]))
