"""Rows pass through operators and stages whatever their columns are called, and copies count as rows."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from beaconry.llm import language, simhash_dedup, suffix_dedup
from beaconry.llm.queries import QUERIES

NAMES = ("k1", "k2", "_k1", "_k2", "_text", "_t", "_l", "_h", "_bytes", "_spans", "spans", "bytes", "row", "id", "fp", "h", "w", "m", "l", "t", "g",
         "lang_pred", "score", "rest", "n", "start", "length", "a.b", "salt", "ids", "output", "root", "item", "value")
WORDS = "alpha bravo charlie delta echo foxtrot golf hotel india juliet kilo lima mike november oscar papa quebec romeo".split()


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    """A folder with documents that hold every odd case, under columns of many names."""
    folder = tmp_path_factory.mktemp("sf")
    body = " ".join(WORDS[(i * i + i // 3) % len(WORDS)] + str(i % 11) for i in range(160))
    texts = [body + " one", "Before. " + body + " After.", "", None, "!!! ...", "A text that stands alone here; nobody else has it.", "copy of a text", "copy of a text",
             "der Hund und die Katze", "the dog and the cat", "x" * 30_000]
    rows = [(i if i != 5 else None, t, ("en", "de", None)[i % 3], "s", len(t or "")) for i, t in enumerate(texts)] + [(6, "copy of a text", "en", "s", 14)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.select("*", *[F.lit(i).alias(n) for i, n in enumerate(NAMES)])
    docs.coalesce(2).write.parquet(f"{folder}/documents.parquet")
    items = [(1, "What is the capital of the old kingdom by the sea, and who ruled it?"), (2, None), (None, ""), (2, "the dog"),
             (9, "A text that stands alone here; nobody else has it.")]
    spark.createDataFrame(items, "item_id long, text string").withColumn("k1", F.lit(1)).write.parquet(f"{folder}/benchmark.parquet")
    pages = [(1, "https://a.org/x?y", "<p>One.</p>"), (None, None, None), (1, "https://a.org/x?y", "<p>One.</p>"), (3, "nothing", "")]
    spark.createDataFrame(pages, "page_id long, url string, html string").select("*", *[F.lit(1).alias(n) for n in ("k1", "host", "path", "text")]).write.parquet(f"{folder}/pages.parquet")
    turns = [(1, 0, "user", "hi"), (1, 0, "user", "hi"), (None, 1, "user", "x"), (2, None, None, None)]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").select("*", *[F.lit(1).alias(n) for n in ("a", "b", "position", "conv")]).write.parquet(f"{folder}/conversations.parquet")
    return str(folder)


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stage(spark, sf_dir, name):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = dict(corpus_pipeline.STAGES)[name](spark, docs, sf_dir)
    if name != "packing":
        assert found.columns == docs.columns
        rows = found.collect()
        assert all(r["k1"] == 0 and r["a.b"] == NAMES.index("a.b") for r in rows)
        kept = sorted(repr(r.text) for r in rows)
        count = {"language ID": 9, "SimHash near-dedup": None, "suffix-array dedup": 12, "benchmark decontamination": 11}[name]
        assert count is None or len(kept) == count, kept
    else:
        assert found.count() >= docs.count()
    assert dict(corpus_pipeline.STAGES)[name](spark, docs.limit(0), sf_dir).count() == 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_operator(spark, sf_dir, name):
    QUERIES[name](spark, sf_dir).collect()


def test_rows_keep_their_other_columns(spark):
    docs = spark.createDataFrame([(1, "The first text of all.", "en", 5), (2, "A second one, not like it.", "en", 6)], "doc_id long, text string, lang string, k1 long")
    for found in (language.understood(docs), simhash_dedup.one_of_each(docs), suffix_dedup.without_repeats(docs)):
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, docs.collect()))
