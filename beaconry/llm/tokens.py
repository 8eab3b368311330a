"""Token ids of whole texts, with a public byte-level vocabulary that is read from its installed place.

A token never spans a single space between two other characters, except as that space in front of
its word. Words repeat, so a text is cut there and the ids of each word are kept in a bounded table.

Strings of added tokens (`<|endoftext|>`) in a text are those tokens, as the contracted library finds
them with its defaults; `plain=True` reads them as ordinary text.

Defined cases: null and empty texts have no ids; a repeated row is counted as often as it stands there, and
documents of equal length share a row of the table; very long texts are encoded whole; only the text column
is read, so others may have any name; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, stored

VOCABULARY = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"   # the same vocabulary for a second library, which is faster here
CACHE_WORDS = 300_000
_SPACE_BESIDE_SPACE = re.compile(r"\s |\s\Z| \s|\A\s")


class _Words(dict):
    """Ids of a word with the space in front of it, as bytes of little-endian 32-bit numbers."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, word):
        ids = np.array(self.encode(" " + word), "<u4").tobytes()
        if len(self) < CACHE_WORDS and len(word) <= 64:
            self[word] = ids
        return ids


class Encoder:
    """Ids of a text as an array of unsigned 32-bit numbers; built once in a Python worker."""

    def __init__(self, vocabulary: str = VOCABULARY, plain: bool = False):
        import public_tokenizers as public
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(public.path(vocabulary))
        tokenizer.encode_special_tokens = plain
        self.encode = lambda text: tokenizer.encode(text, add_special_tokens=False).ids
        added = [] if plain else [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        self.by_ranks = self.words = None
        if vocabulary == VOCABULARY:
            import tiktoken

            with open(public.path(RANKS), "rb") as lines:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.by_ranks = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
            self.words = _Words(self.by_ranks)

    def ids(self, text: str | None) -> np.ndarray:
        if not text:
            return np.zeros(0, "<u4")
        if self.words is None or self.added and self.added.search(text):
            return np.array(self.encode(text), "<u4")
        if _SPACE_BESIDE_SPACE.search(text):
            return np.array(self.by_ranks(text), "<u4")
        first, *rest = text.split(" ")
        return np.frombuffer(np.array(self.by_ranks(first), "<u4").tobytes() + b"".join(map(self.words.__getitem__, rest)), "<u4")


_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def encoder(vocabulary: str = VOCABULARY, plain: bool = False) -> Encoder:
    key = (vocabulary, plain)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(vocabulary, plain)
    return _ENCODERS[key]


def token_counts(documents: DataFrame, text_col: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """`n_tokens` of every document (null: 0); no other column, no order."""
    def work(batches):
        ids = encoder(vocabulary).ids
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(ids(t)) for t in batch.column(0).to_pylist()], pa.int64())],
                                             names=["n_tokens"])

    return arrow_map(documents.select(text_col), work, "n_tokens long")


def length_table(counts: DataFrame, block: int = 1024) -> DataFrame:
    """One row for every context limit at which an answer changes, that is for every encoded length.

    n_docs: documents of exactly this length; docs_over: of more (they are truncated at this limit);
    tokens: all tokens of all documents; tokens_kept: what is left when every document is cut to
    the limit; docs_share: share of documents that fit (so the q-quantile is the first limit with
    docs_share >= q).

    The histogram is summed from its end in blocks of lengths: a window within each block, and one
    over the blocks' totals (longest length / `block` rows). An empty table has no rows."""
    from pyspark.sql import Window

    # Written, as it is read twice and each text would be encoded for both.
    histogram = stored(counts.groupBy(F.col("n_tokens").alias("token_limit")).agg(F.count("*").alias("n_docs")), "lengths")
    histogram = histogram.withColumn("part", F.floor(F.col("token_limit") / block))
    totals = histogram.groupBy("part").agg(F.sum("n_docs").alias("docs"), F.sum(F.col("n_docs") * F.col("token_limit")).alias("tokens"))
    later = Window.orderBy(F.col("part").desc()).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(F.col("part").desc()).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    totals = totals.select(
        "part", F.coalesce(F.sum("docs").over(later), F.lit(0)).alias("docs_later"),
        F.coalesce(F.sum("tokens").over(later), F.lit(0)).alias("tokens_later"),
        F.sum("docs").over(whole).alias("docs_all"), F.sum("tokens").over(whole).alias("tokens_all"))
    inside = Window.partitionBy("part").orderBy(F.col("token_limit").desc()).rowsBetween(Window.unboundedPreceding, -1)
    rows = histogram.join(totals, "part").select(
        "token_limit", "n_docs", "docs_all", "tokens_all",
        (F.col("docs_later") + F.coalesce(F.sum("n_docs").over(inside), F.lit(0))).alias("docs_over"),
        (F.col("tokens_later") + F.coalesce(F.sum(F.col("n_docs") * F.col("token_limit")).over(inside), F.lit(0))).alias("tokens_over"))
    return rows.select(
        "token_limit", "n_docs", "docs_over", F.col("tokens_all").alias("tokens"),
        (F.col("tokens_all") - F.col("tokens_over") + F.col("docs_over") * F.col("token_limit")).alias("tokens_kept"),
        F.round((F.col("docs_all") - F.col("docs_over")) / F.col("docs_all"), 9).alias("docs_share"))
