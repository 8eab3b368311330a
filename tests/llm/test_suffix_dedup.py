import hashlib
import random

import pytest

from beaconry.llm import suffix_dedup as sd


def brute(texts):
    """(removed, runs, sha) of each text by looking at every 400-byte string."""
    seen = {}
    for data in texts:
        for s in range(len(data) - sd.SPAN + 1):
            w = data[s:s + sd.SPAN]
            seen[w] = seen.get(w, 0) + 1
    out = []
    for data in texts:
        gone = bytearray(len(data))
        for s in range(len(data) - sd.SPAN + 1):
            if seen[data[s:s + sd.SPAN]] > 1:
                gone[s:s + sd.SPAN] = b"\1" * sd.SPAN
        kept = bytes(b for b, g in zip(data, gone) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def words(rng, n):
    return " ".join("".join(rng.choice(["th", "er", "é", "on", "ß", "tion"]) for _ in range(rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    passage, other = words(rng, 120), words(rng, 90)
    near = words(rng, 300).split(" ")
    out = [None, "", "a", "x" * 399, "x" * 400, "x" * 401, "ab" * 900, words(rng, 40), words(rng, 4000)]
    for k in range(12):
        out.append(words(rng, rng.randint(0, 60)) + " " + passage[rng.randint(0, 30):] + words(rng, rng.randint(0, 90)))
        edited = list(near)
        for _ in range(rng.randint(0, 4)):
            edited[rng.randrange(len(edited))] = "zz"
        out.append(" ".join(edited))
    out += [other + words(rng, 50) + other, out[-1], out[-1], passage[:380], other[3:]]
    return out


def test_against_every_string(spark, texts):
    rows = [(i if i % 7 else None, t, 1) for i, t in enumerate(texts)] + [(3, "y" * 500, 1), (3, "y" * 500, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, bytes int").repartition(3)
    got = sorted((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in sd.removal_report(df).collect())
    assert got == sorted(brute([(t or "").encode() for _, t, _ in rows]))


def test_boundaries_between_buckets(spark, texts):
    """As many buckets as rows nearly: neighbours are mostly in other buckets."""
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    try:
        rows = list(enumerate(texts[9:25] + ["z" * 1000] * 9))
        df = spark.createDataFrame(rows, "doc_id long, text string")
        got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in sd.removal_report(df).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert [got[i] for i, _ in rows] == brute([t.encode() for _, t in rows])


def test_long_text_is_looked_at_in_pieces(monkeypatch):
    text = words(random.Random(1), 3000).encode()
    whole = sd.anchors(text)
    monkeypatch.setattr(sd, "_PIECE", 1000)
    lo, hi, a = sd.anchors(text)
    assert [x for l, h in zip(lo, hi) for x in range(l, h + 1)] == list(range(len(text) - sd.SPAN + 1))
    served = {s: p for l, h, p in zip(*whole) for s in range(l, h + 1)}
    assert all(served[s] == p for l, h, p in zip(lo, hi, a) for s in range(l, h + 1))


def test_empty_table_and_stage(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert sd.removal_report(empty).collect() == []
    df = spark.createDataFrame([(1, "a" * 500, "x"), (2, None, "y"), (3, "é" * 300 + "b", "z")], "doc_id long, text string, lang string")
    out = {r.doc_id: r for r in sd.without_repeats(df).collect()}
    assert out[1].text == "" and out[2].text is None and out[2].lang == "y" and df.columns == list(out[1].asDict())
    assert out[3].text == "b"


def brute_words(texts, span):
    """Texts without the words that lie in a repeated window of `span` words."""
    seen = {}
    for t in texts:
        w = t.split()
        for i in range(len(w) - span + 1):
            seen[tuple(w[i:i + span])] = seen.get(tuple(w[i:i + span]), 0) + 1
    out = []
    for t in texts:
        w, gone = t.split(), set()
        for i in range(len(w) - span + 1):
            if seen[tuple(w[i:i + span])] > 1:
                gone.update(range(i, i + span))
        out.append([x for i, x in enumerate(w) if i not in gone])
    return out


def test_windows_of_words_and_of_other_lengths(spark):
    rng = random.Random(8)
    passage, near = words(rng, 90).split(" "), words(rng, 200).split(" ")
    texts = [words(rng, 51), "", " ".join(["x"] * 300), "a b"]
    for k in range(14):
        part = passage[rng.randint(0, 25):][:rng.randint(45, 65)]
        edited = [w if rng.random() > 0.01 else "zz" for w in near]
        texts += [" ".join([words(rng, 9), (" ", "\n", "\u3000")[k % 3].join(part), words(rng, 9)]), " ".join(edited)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.text for r in sd.without_repeats(df, kinds=(sd.PASSAGES,)).collect()}
    assert [got[i].split() for i in range(len(texts))] == brute_words(texts, 51)
    old, sd.SPAN = sd.SPAN, 100
    try:
        spans = sd.with_spans(df, kinds=(sd.Windows(100),)).select("row.doc_id", "bytes", "spans").collect()
        want = dict(enumerate(brute([t.encode() for t in texts])))
    finally:
        sd.SPAN = old
    assert all(sum(hi - lo for lo, hi in sd._merged(r.spans, bytes(r.bytes))) == want[r.doc_id][1] for r in spans)


def test_stage_takes_short_passages_of_over_50_words(spark):
    import corpus_pipeline
    rng = random.Random(9)
    passage = " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(51))
    assert len(passage) < sd.SPAN
    less = passage.rsplit(" ", 1)[0]
    rows = [(1, f"one two {passage} three"), (2, f"four {passage} five"), (3, f"six {less} seven")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in corpus_pipeline.repeated_passages(spark, df, "").collect()}
    assert got == {1: "one two  three", 2: "four  five", 3: rows[2][1]}
