"""Language of a text by cross-parsing: the language whose labelled text explains it in fewest phrases.

Per language a suffix automaton of labelled words is built. A text is parsed from left to right into
the longest pieces that occur in that automaton; a character that occurs nowhere is a phrase of its
own. Phrases do not cross white space, so a word is parsed once and its phrase counts are kept in a
bounded table. The language with the fewest phrases per letter wins.

Training is a bounded sample: of each language the `TRAIN_DOCS` distinct labelled texts with the smallest
hash, and of those the `TRAIN_WORDS` most frequent words. Every label is learned: beyond
`ALL_WORDS` / `TRAIN_WORDS` languages they share `ALL_WORDS` evenly, with one word each at least. Prediction reads the whole text and nothing but the text.

Defined cases: null, empty or letterless text is `und` with score 0, and so is any text if nothing
was learned; ties go to the language whose name sorts first and have score 0; repeated rows are
each judged, and count once in training; columns of any name pass through, null ids are in training.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beaconry.operators.cutoff import within_limit

from .common import arrow_map, nested, stored, unnested

UNKNOWN = "und"
TRAIN_DOCS, TRAIN_WORDS, ALL_WORDS = 200, 8000, 512_000
_CACHE_WORDS = 200_000
_LETTER = re.compile(r"[^\W\d_]")


class SuffixAutomaton:
    """Smallest automaton that accepts every substring of the words it was built from."""

    def __init__(self, words):
        self.next: list[dict[str, int]] = [{}]
        self.link, self.size = [-1], [0]
        for word in words:
            last = 0
            for letter in word:
                last = self._extend(last, letter)

    def _extend(self, last: int, letter: str) -> int:
        there = self.next[last].get(letter)
        if there is not None:
            if self.size[there] == self.size[last] + 1:
                return there
            return self._clone(last, letter, there)
        state = self._new({}, self.size[last] + 1, 0)
        at = last
        while at >= 0 and letter not in self.next[at]:
            self.next[at][letter] = state
            at = self.link[at]
        if at >= 0:
            to = self.next[at][letter]
            self.link[state] = to if self.size[to] == self.size[at] + 1 else self._clone(at, letter, to)
        return state

    def _new(self, moves, size, link):
        self.next.append(moves)
        self.size.append(size)
        self.link.append(link)
        return len(self.next) - 1

    def _clone(self, at, letter, to):
        copy = self._new(dict(self.next[to]), self.size[at] + 1, self.link[to])
        self.link[to] = copy
        while at >= 0 and self.next[at].get(letter) == to:
            self.next[at][letter] = copy
            at = self.link[at]
        return copy

    def phrases(self, word: str) -> int:
        """Longest pieces that `word` falls into, from left to right."""
        count, at, inside = 0, 0, 0
        moves = self.next
        while at < len(word):
            state, inside = 0, at
            while inside < len(word) and (to := moves[state].get(word[inside])) is not None:
                state, inside = to, inside + 1
            count += 1
            at = max(inside, at + 1)
        return count


def bounded(word: str) -> str:
    """A word with its ends marked; case is kept out."""
    return f" {word.lower()} "


class Parser:
    """Phrase counts of whole texts under every language of a model {language: words}."""

    def __init__(self, model: dict[str, list[str]]):
        self.languages = sorted(model)
        self.automata = [SuffixAutomaton(map(bounded, model[name])) for name in self.languages]
        self.known: dict[str, tuple[int, ...]] = {}

    def counts(self, word: str) -> tuple[int, ...]:
        text = bounded(word)
        found = tuple(a.phrases(text) for a in self.automata)
        if len(self.known) < _CACHE_WORDS and len(word) <= 64:
            self.known[word] = found
        return found

    def parse(self, text: str) -> list[int]:
        get, total = self.known.get, [0] * len(self.languages)
        rows = [get(w) or self.counts(w) for w in text.split()]
        return [sum(c) for c in zip(*rows)] if rows else total

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.languages or not _LETTER.search(text):
            return UNKNOWN, 0.0
        total = self.parse(text)
        best = min(range(len(total)), key=lambda i: (total[i], i))
        others = [c for i, c in enumerate(total) if i != best]
        return self.languages[best], 1.0 - total[best] / min(others) if others else 1.0


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang") -> dict[str, list[str]]:
    """Words of each language from rows with text and language; see the bounds above."""
    rows = labelled.select(F.col(lang_col).alias("l"), F.col(text_col).alias("t"), F.xxhash64(text_col).alias("h")).where("l is not null and t is not null")
    keys = stored(rows.select("l", "h").distinct().withColumn("most", F.lit(TRAIN_DOCS)), "labelled")
    rank = F.row_number().over(Window.partitionBy("l").orderBy("h"))
    # Hashes are counted in bands first, so that the window sees two samples of a language at most, however many rows it has.
    near = within_limit(keys, ["l"], ["h"], "most")
    last = near.withColumn("r", rank).where(F.col("r") <= TRAIN_DOCS).groupBy("l").agg(F.max("h").alias("m")).collect()
    if not last:
        return {}
    each = max(1, min(TRAIN_WORDS, ALL_WORDS // len(last)))
    kind = labelled.schema[lang_col].dataType.simpleString()
    limit = F.broadcast(labelled.sparkSession.createDataFrame([tuple(r) for r in last], f"l {kind}, m long"))
    chosen = rows.join(limit, "l").where("h <= m").dropDuplicates(["l", "h"])

    def words(batches):
        for batch in batches:
            out = []
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                out += [(lang, w, c) for w, c in Counter(w for w in text.split() if _LETTER.search(w)).items()]
            columns = list(zip(*out)) or [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64()))],
                                             names=["l", "w", "c"])

    counted = arrow_map(chosen.select("l", "t"), words, "l string, w string, c long").groupBy("l", "w").agg(F.sum("c").alias("c"))
    rank = F.row_number().over(Window.partitionBy("l").orderBy(F.desc("c"), "w"))
    model: dict[str, list[str]] = {}
    for r in counted.withColumn("r", rank).where(F.col("r") <= each).orderBy("l", "r").collect():
        model.setdefault(r["l"], []).append(r["w"])
    return model


_PARSERS: dict = {}


def predict(documents: DataFrame, model: dict[str, list[str]], text_col: str = "text") -> DataFrame:
    """`row` (all columns of `documents`), lang_pred and score."""
    shared = documents.sparkSession.sparkContext.broadcast(model)  # at most ALL_WORDS words, or one a language
    name = uuid.uuid4().hex

    def work(batches):
        if name not in _PARSERS:
            _PARSERS.clear()
            _PARSERS[name] = Parser(shared.value)
        parser = _PARSERS[name]
        for batch in batches:
            found = [parser.predict(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                names=["row", "lang_pred", "score"])

    rows = nested(documents, F.col(text_col).alias("text"))
    return arrow_map(rows, work, rows.select("row").schema.add("lang_pred", "string").add("score", "double"))


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that training leaves out: crc32 of the id as text leaves 1 when divided by 3 (null: not held out)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def identify(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Per document: id, held_out, lang_pred, score."""
    model = train(documents.where(~held_out(id_col)), text_col, lang_col)
    rows = documents.select(F.col(id_col).alias("id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))
    return predict(rows, model).select(F.col("row.id").alias(id_col), "row.held_out", "lang_pred", "score")


def understood(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """`documents` without those that are null or have no letter; ties and texts of unlearned languages stay."""
    # Other names keep a label that reads `und` apart from UNKNOWN; where nothing was learned any lettered text is of one language.
    model = {f"={name}": words for name, words in train(documents.where(~held_out(id_col)), text_col, lang_col).items()} or {"=": []}
    return predict(documents, model, text_col).where(F.col("lang_pred") != UNKNOWN).select(*unnested(documents.schema))
