"""Fill-in-the-middle order of whole texts by displacement: every byte of a batch is moved at once.

The texts of an Arrow batch lie one after the other in one byte array. A scan of it finds the code
points, so the cuts of all rows become byte positions together. Each stretch of a row (prefix,
middle, suffix) moves by one distance; the distances are entered as differences at the starts of the
stretches, their cumulative sum is the displacement of every byte, and one scatter writes all outputs.
The way back needs only outputs and forms: the marks are found in the bytes, the stretches between
them get their displacements in the same way, and one gather restores all texts.

Forms: `plain` (the text itself), `psm` (<P>prefix<S>suffix<M>middle), `spm` (<S>suffix<P>prefix<M>middle).
A text that is empty or holds a mark stays plain, so that marks in an output are never ambiguous.

Defined cases: null text is empty, thus plain; a null id draws like the empty string; a repeated row
draws the same cuts and stays a row of its own; cuts at the same place leave an empty middle; very long
texts are moved like any other; of other columns only the id is carried, so any name is fine; an empty
table gives none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_map

FORMS = ("plain", "psm", "spm")
#: Marks that open the prefix, the suffix and the middle.
MARKS = ("<P>", "<S>", "<M>")
_MARK = 3
_OPEN, _CLOSE = ord("<"), ord(">")
_LETTERS = np.array([ord(m[1]) for m in MARKS], np.uint8)
#: Stretches of the text (0 prefix, 1 middle, 2 suffix) in the order of the output, by form.
_ORDER = {1: (0, 2, 1), 2: (2, 0, 1)}
#: Which of MARKS opens each stretch.
_OPENS = (0, 2, 1)


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the borders of its rows in them; null rows are empty."""
    column = column.fill_null("").cast(pa.large_string())
    ends = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1 + column.offset)[column.offset:] if len(column) else np.zeros(1, np.int64)
    data = column.buffers()[2]
    flat = np.frombuffer(data, np.uint8)[ends[0]:ends[-1]] if data is not None and ends[-1] > ends[0] else np.zeros(0, np.uint8)
    return flat, ends - ends[0]


def _strings(flat: np.ndarray, ends: np.ndarray) -> pa.Array:
    wide = pa.LargeStringArray.from_buffers(len(ends) - 1, pa.py_buffer(np.ascontiguousarray(ends, np.int64)),
                                            pa.py_buffer(np.ascontiguousarray(flat)))
    return wide.cast(pa.string())


def _marks(flat: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all marks that lie within one row, and their rows."""
    if len(flat) < _MARK:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.flatnonzero((flat[:-2] == _OPEN) & (flat[2:] == _CLOSE) & np.isin(flat[1:-1], _LETTERS))
    row = np.searchsorted(ends, at, "right") - 1
    inside = at + _MARK <= ends[row + 1]
    return at[inside], row[inside]


def _displaced(starts: np.ndarray, shifts: np.ndarray, size: int) -> np.ndarray:
    """Shift of each of `size` positions: that of the last start at or in front of it.

    Starts rise; where some are equal (empty stretches), the last one counts."""
    differences = np.zeros(size + 1, np.int64)
    np.add.at(differences, starts, np.diff(shifts, prepend=0))
    return np.cumsum(differences[:size])


def scattered(flat: np.ndarray, ends: np.ndarray, form: np.ndarray, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Outputs of a batch. `first` and `second`: cuts of each row in code points; plain rows ignore them."""
    points = np.flatnonzero((flat & 0xC0) != 0x80)
    before = np.searchsorted(points, ends)   # code points in front of each row
    points = np.append(points, len(flat))

    def byte(cut):
        return np.minimum(points[np.minimum(before[:-1] + cut, len(points) - 1)], ends[1:])

    moved = form > 0
    borders = np.stack([ends[:-1], np.where(moved, byte(first), ends[1:]), np.where(moved, byte(second), ends[1:]), ends[1:]])
    lengths = np.diff(borders, axis=0)
    out_ends = np.concatenate([[0], np.cumsum(lengths.sum(0) + np.where(moved, _MARK * len(MARKS), 0))])
    goes = np.repeat(out_ends[None, :-1], 3, 0)   # where each stretch of a plain row would go: prefix is all there is
    out = np.zeros(out_ends[-1], np.uint8)
    for kind, order in _ORDER.items():
        rows = np.flatnonzero(form == kind)
        at = out_ends[rows]
        for stretch in order:
            for i, letter in enumerate(MARKS[_OPENS[stretch]].encode()):
                out[at + i] = letter
            goes[stretch, rows] = at + _MARK
            at = at + _MARK + lengths[stretch, rows]
    starts = borders[:3].T.ravel()
    out[np.arange(len(flat)) + _displaced(starts, goes.T.ravel() - starts, len(flat))] = flat
    return out, out_ends


def gathered(flat: np.ndarray, ends: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts of a batch of outputs, from the outputs and their forms alone."""
    at, row = _marks(flat, ends)
    at = at[form[row] > 0].reshape(-1, len(MARKS)).T   # three marks in each row that is not plain
    rows = np.flatnonzero(form > 0)
    begins, until = np.repeat(ends[None, :-1], 3, 0), np.repeat(ends[None, :-1], 3, 0)
    until[0] = ends[1:]   # a plain row: one stretch
    bounds = np.concatenate([at, ends[None, 1:][:, rows]])
    for kind, order in _ORDER.items():
        here = form[rows] == kind
        for place, stretch in enumerate(order):
            begins[stretch, rows[here]] = bounds[place, here] + _MARK
            until[stretch, rows[here]] = bounds[place + 1, here]
    lengths = (until - begins).T.ravel()
    text_ends = np.concatenate([[0], np.cumsum(lengths)])
    size = int(text_ends[-1])
    source = np.arange(size) + _displaced(text_ends[:-1], begins.T.ravel() - text_ends[:-1], size)
    return flat[source], text_ends[::3]


def transform(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", plain_percent: int = 10,
              spm_percent: int = 20, salt: str = "1:") -> DataFrame:
    """`id_col`, n (code points), form, prefix_chars, middle_chars (null if plain), output.

    Draws are the first four 8-digit groups of the hex sha256 of `salt` and the decimal id: two
    cuts modulo n + 1, the share of plain texts, and that of `spm` among the others."""
    digest = F.sha2(F.concat(F.lit(salt), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    draws = [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]

    def work(batches):
        for batch in batches:
            flat, ends = _bytes_of(batch.column(1))
            h1, h2, h3, h4 = (batch.column(i).to_numpy() for i in range(2, 6))
            points = np.concatenate([[0], np.cumsum((flat & 0xC0) != 0x80)])
            n = np.diff(points[ends])
            plain = (n == 0) | (h3 % 100 >= 100 - plain_percent)
            plain[_marks(flat, ends)[1]] = True
            form = np.where(plain, 0, np.where(h4 % 100 < spm_percent, 2, 1))
            a, b = h1 % (n + 1), h2 % (n + 1)
            first, second = np.minimum(a, b), np.maximum(a, b)
            out, out_ends = scattered(flat, ends, form, first, second)
            names = pa.DictionaryArray.from_arrays(pa.array(form, pa.int32()), pa.array(FORMS)).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), names, pa.array(first, pa.int64(), mask=plain),
                 pa.array(second - first, pa.int64(), mask=plain), _strings(out, out_ends)],
                names=[id_col, "n", "form", "prefix_chars", "middle_chars", "output"])

    fields = [T.StructField(id_col, documents.schema[id_col].dataType), T.StructField("n", T.LongType()), T.StructField("form", T.StringType()),
              T.StructField("prefix_chars", T.LongType()), T.StructField("middle_chars", T.LongType()), T.StructField("output", T.StringType())]
    return arrow_map(documents.select(id_col, F.col(text_col).cast("string").alias("text"), *draws), work, T.StructType(fields))


def restore(outputs: DataFrame, columns: list[str]) -> DataFrame:
    """`columns` of `outputs` (with `form` and `output`) and `restored`, the text each was made from."""
    kept = [c for c in columns if c not in ("form", "output", "restored")]

    def work(batches):
        for batch in batches:
            form = np.array([FORMS.index(f) for f in batch.column(0).to_pylist()], np.int64)
            text, ends = gathered(*_bytes_of(batch.column(1)), form)
            yield pa.RecordBatch.from_arrays([*batch.columns, _strings(text, ends)], names=["form", "output", *kept, "restored"])

    source = outputs.select("form", "output", *kept)
    return arrow_map(source, work, T.StructType([*source.schema.fields, T.StructField("restored", T.StringType())]))


def digests(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document transformed and restored, with the digests of both texts."""
    done = transform(documents, id_col, text_col)
    both = restore(done, done.columns)
    return both.select(id_col, "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2("restored", 256).alias("restored_sha256"))


def digests_sql(table: str = "documents") -> str:
    """DuckDB SQL of `digests` with its default parameters."""
    draw = [f"('0x' || substr(digest, {1 + 8 * i}, 8))::BIGINT" for i in range(4)]
    marked = " OR ".join(f"contains(body, '{m}')" for m in MARKS)
    return f"""
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS body, length(coalesce(text, ''))::BIGINT AS n,
         sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS digest FROM {table}),
cut AS (
  SELECT *, least({draw[0]} % (n + 1), {draw[1]} % (n + 1)) AS a, greatest({draw[0]} % (n + 1), {draw[1]} % (n + 1)) AS b,
         CASE WHEN n = 0 OR {marked} OR {draw[2]} % 100 >= 90 THEN 'plain' WHEN {draw[3]} % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn),
parts AS (
  SELECT *, substr(body, 1, a) AS prefix, substr(body, a + 1, b - a) AS middle, substr(body, b + 1) AS suffix FROM cut)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN body WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(body) AS restored_sha256
FROM parts"""
