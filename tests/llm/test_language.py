import random
import zlib

from beaconry.llm import language as la
from beaconry.session import read_table


def plain_phrases(word, words):
    """Longest pieces of `word` that are substrings of some word, by looking."""
    at = count = 0
    while at < len(word):
        size = 0
        while at + size < len(word) and any(word[at:at + size + 1] in w for w in words):
            size += 1
        at += max(1, size)
        count += 1
    return count


def test_automaton_against_substrings():
    rng = random.Random(4)
    for _ in range(40):
        words = ["".join(rng.choice("abc") for _ in range(rng.randint(0, 9))) for _ in range(rng.randint(1, 12))]
        automaton = la.SuffixAutomaton(words)
        for _ in range(30):
            word = "".join(rng.choice("abcd") for _ in range(rng.randint(0, 12)))
            assert automaton.phrases(word) == plain_phrases(word, words)


def test_parser_against_plain():
    model = {"x": ["Alpha", "beta", "gam"], "y": ["delta", "pha"]}
    parser = la.Parser(model)
    for text in ("alpha beta", "Delta  pha\nq", "zzz"):
        want = [sum(plain_phrases(la.bounded(w), [la.bounded(v) for v in model[k]]) for w in text.split()) for k in ("x", "y")]
        assert parser.parse(text) == want == parser.parse(text)
        assert parser.predict(text)[0] == ("x" if want[0] <= want[1] else "y")


def test_held_out_accuracy(spark):
    docs = read_table(spark, "/root/testdata/sf0.01", "documents")
    rows = la.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == 1000 and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    tested = [r for r in rows if r.held_out]
    assert sum(r.lang == r.lang_pred for r in tested) / len(tested) > 0.98
    assert la.understood(docs).count() > 0.98 * 1000


SEEN = next(i for i in range(10, 99) if zlib.crc32(str(i).encode()) % 3 != 1)


def test_defined_cases(spark):
    rows = [(1, "der die das und", "de", "a"), (SEEN, "the and of", "en", "b"), (None, None, "de", "c"), (4, "", None, None), (5, "12 34 !", "en", "d"),
            (6, "und das", None, "e"), (6, "und das", None, "e"), (7, "the of " * 20000, None, "long")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    out = la.identify(df)
    assert out.columns == ["doc_id", "held_out", "lang_pred", "score"]
    got = sorted([(r.doc_id or 0, r.lang_pred) for r in out.collect()])
    assert [g for g in got if g[0] in (0, 4, 5)] == [(0, "und"), (4, "und"), (5, "und")]
    assert got.count((6, "de")) == 2 and (7, "en") in got
    kept = la.understood(df)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == sorted([1, SEEN, 6, 6, 7])
    assert {r.score for r in kept.collect()} == {"a", "b", "e", "long"}
    nothing = la.identify(spark.createDataFrame([(1, "text", None)], "doc_id long, text string, lang string")).first()
    assert (nothing.lang_pred, nothing.score) == ("und", 0.0)
    assert la.identify(df.limit(0)).collect() == []


def test_ties_and_unlearned_texts_stay(spark):
    rows = [(SEEN, "same words here", lang) for lang in ("de", "en")] + [(3, "here", None), (4, "12", None), (5, None, "de"), (6, "zz", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {r.score for r in la.identify(df).collect()} == {0.0}
    assert sorted(r.doc_id for r in la.understood(df).collect()) == [3, 6, SEEN, SEEN]
    for lang in (None, "und"):
        kept = la.understood(df.selectExpr("doc_id", "text", f"cast({'null' if lang is None else repr(lang)} as string) as lang"))
        assert sorted(r.doc_id for r in kept.collect()) == [3, 6, SEEN, SEEN]


def test_every_label_is_learned_from_distinct_texts(spark, monkeypatch):
    rows = [(f"w{k:03d} q{k:03d}", f"l{k:03d}") for k in range(70)]
    model = la.train(spark.createDataFrame(rows, "text string, lang string"))
    assert {k: sorted(v) for k, v in model.items()} == {lang: sorted(text.split()) for text, lang in rows}
    monkeypatch.setattr(la, "TRAIN_DOCS", 3)
    copies = [("copied", "x")] * 50 + [("other", "x"), ("third", "x")]
    assert sorted(la.train(spark.createDataFrame(copies, "text string, lang string"))["x"]) == ["copied", "other", "third"]
    monkeypatch.setattr(la, "ALL_WORDS", 100)
    assert {len(v) for v in la.train(spark.createDataFrame(rows, "text string, lang string")).values()} == {1}
