"""Tree encoding against the library itself, and the way back."""

import base64
import hashlib
import random

import numpy as np
import pytest

from beaconry.llm.byte_bpe import RANKS, TreeCoder, decode, encode, round_trip
from beaconry.llm.queries import QUERIES

SIGNS = ["a", "b", "é", "日本", "'", "'re", "'s", "'ll", " ", "  ", "\n", "\t", "1", "23", "!", "?!", "the", "ing", "🤦", " ", "S", "r", "e", "l"]


@pytest.fixture(scope="module")
def library():
    import public_tokenizers as public
    import tiktoken

    with open(public.path(RANKS), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_any_leaf_gives_the_ids_of_the_library(library):
    rnd = random.Random(5)
    coders = [TreeCoder(leaf=n, whole_piece=w) for n, w in ((1, 2), (3, 4), (17, 40))]
    for _ in range(1500):
        signs = rnd.sample(SIGNS, rnd.randint(1, len(SIGNS)))
        text = "".join(rnd.choice(signs) for _ in range(rnd.choice([0, 1, 3, 10, 40, 150])))
        for tree in coders:
            ids = np.frombuffer(tree.encode(text), "<u4")
            assert ids.tolist() == library.encode_ordinary(text), text
            assert tree.decode(ids.astype(np.int64)) == text.encode()


@pytest.mark.parametrize("text", ["a" * 60_000, "ab" * 40_000, "x" + " " * 50_000 + "x", "!" * 50_000, "'" * 9_000 + "s'" * 900,
                                  base64.b64encode(random.Random(1).randbytes(60_000)).decode(), "word " * 30_000])
def test_endless_pieces(library, text):
    assert np.frombuffer(TreeCoder().encode(text), "<u4").tolist() == library.encode_ordinary(text)


def test_a_piece_that_is_a_token_says_nothing_about_longer_ones():
    tree = TreeCoder()
    for token in list(tree.ranks)[:3000]:
        assert tree.data(tree.merged(token)) == token


def test_defined_cases(spark, library):
    rows = [(1, None, "x"), (2, "", "x"), (3, "same 1", "x"), (3, "same 1", "x"), (None, "it's", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = sorted(((r.doc_id, r.ids) for r in encode(docs).collect()), key=repr)
    assert got == sorted([(1, []), (2, []), (3, library.encode_ordinary("same 1")), (3, library.encode_ordinary("same 1")),
                          (None, library.encode_ordinary("it's"))], key=repr)
    back = sorted(((r.doc_id, bytes(r.decoded)) for r in decode(encode(docs)).collect()), key=repr)
    assert back == sorted([(a, (b or "").encode()) for a, b, _ in rows], key=repr)
    none = hashlib.sha256(b"").hexdigest()
    assert tuple(round_trip(docs).where("doc_id = 1").first()) == (1, 0, none, none)
    assert round_trip(docs.limit(0)).count() == 0


def test_null_ids_decode_to_nothing(spark):
    ids = spark.createDataFrame([(1, None), (2, [64])], "doc_id long, ids array<int>")
    assert sorted((r.doc_id, len(r.decoded)) for r in decode(ids).collect()) == [(1, 0), (2, 1)]


def test_query_over_whole_documents(spark, library):
    data = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()}
    rows = QUERIES["op11_byte_bpe"](spark, data).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = library.encode_ordinary(texts[row.doc_id])
        assert (row.n_tokens, row.ids_sha256, row.decoded_sha256) == (
            len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(texts[row.doc_id].encode()).hexdigest())
