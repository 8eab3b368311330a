import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from beaconry.llm import packing, tokens


def texts():
    rng = random.Random(2)
    out = [None, "", " ", "a", "  two  spaces ", "tab\tand\nline\n\n\nend", "don't we'll  x", " lead", "trail ", "a \n b", "ünï ç½²³ ٣٤",
           "<|endoftext|> plain", "a <|endoftext|> b", "<|endoftext", "x" * 70 + " y", "word " * 3000, "a b" * 2500, "nbsp here   there", "　wide", "emoji 😀😀 ok", "1234567 89"]
    for _ in range(200):
        out.append(" ".join(rng.choice(["the", "tion,", "Été", "42", "x.\nY", "und"]) for _ in range(rng.randint(1, 900))))
    return out


@pytest.fixture(scope="module")
def reference():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def test_ids(reference):
    ids = tokens.Encoder().ids
    for text in texts():
        assert ids(text).tolist() == reference(text)


def test_added_tokens_are_tokens_or_text():
    assert tokens.Encoder().ids("a <|endoftext|> b").tolist() == [64, 220, 50256, 275]
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    plain = tokens.Encoder(plain=True).ids
    for text in texts():
        assert plain(text).tolist() == t.encode(text or "", add_special_tokens=False).ids


def test_length_table(spark, reference):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts())], "doc_id long, text string")
    got = {r.token_limit: r for r in tokens.length_table(tokens.token_counts(df), 64).collect()}
    n = [len(reference(t)) for t in texts()]
    assert set(got) == set(n)
    for limit, r in got.items():
        assert r.n_docs == n.count(limit) and r.docs_over == sum(x > limit for x in n) and r.tokens == sum(n)
        assert r.tokens_kept == sum(min(x, limit) for x in n)
        assert abs(r.docs_share - sum(x <= limit for x in n) / len(n)) < 1e-8
    assert tokens.length_table(tokens.token_counts(df.limit(0))).collect() == []


def check_packing(rows, df_rows, reference):
    used = {}
    for r in rows:
        used.setdefault(r.sequence_id, []).append(r)
    padding = 0
    for parts in used.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= 2048
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    assert padding == 0
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    for i, text in dict.fromkeys(df_rows):
        ids = np.array([*reference(text), 1], "<u4")
        parts = sorted(by_doc[i], key=lambda r: r.start)
        copies = sum(1 for j, t in df_rows if j == i)
        covered = [0] * len(ids)
        for r in parts:
            assert r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[r.start:r.start + r.length].tobytes())
            for k in range(r.start, r.start + r.length):
                covered[k] += 1
        assert set(covered) == {copies}


def test_pack(spark, reference):
    rows = list(enumerate(texts())) + [(20, texts()[20])] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    out = packing.pack(df).collect()
    check_packing(out, rows, reference)
    cut = sum(1 for r in out if r.length < min(2048, r.doc_tokens - r.start // 2048 * 2048))
    assert cut < len(rows)


def test_one_length_only(spark, reference):
    rows = [(k, "word " * 1500) for k in range(40)]
    check_packing(packing.pack(spark.createDataFrame(rows, "doc_id long, text string")).collect(), rows, reference)


def test_many_equal_rows(spark, reference):
    """Copies of one row share its text: the work grows with the copies, not with their square."""
    rows = [(7, "word " * 700 + "end")] * 1500
    check_packing(packing.pack(spark.createDataFrame(rows, "doc_id long, text string")).collect(), rows[:1] * 1500, reference)


def test_empty(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_least_squares_finds_an_exact_solution():
    columns = np.array([[0, 1, 9], [0, 2, 8], [1, 1, 8]])
    times = np.array([30.0, 50, 20])
    target = np.bincount(columns.ravel(), np.repeat(times, 3), minlength=10).astype(float)
    target[0] = 0
    assert np.allclose(packing.nonnegative_least_squares(columns, target, 3000), times, rtol=0.02)


def test_plan_uses_exact_combinations():
    rng = random.Random(1)
    histogram = {}
    for _ in range(20000):
        n = min(2048, int(rng.lognormvariate(5.5, 1)) + 1)
        histogram[n] = histogram.get(n, 0) + 1
    runs, leftovers, sequences = packing.make_plan(histogram)
    placed = sum(r[2] for r in runs)
    assert placed > 0.9 * 20000
    for length, n in histogram.items():
        ranks = sorted(x for l, first, count, _, _ in runs if l == length for x in range(first, first + count))
        assert ranks == list(range(len(ranks))) and len(ranks) == (leftovers[length][0] if length in leftovers else n)
