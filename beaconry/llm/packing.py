"""Documents packed into sequences of 2048 tokens without padding, few of them cut.

Every document gives full sequences and one rest of under 2048 tokens. Combinations of one to three
rests that fill a window exactly are enumerated from the histogram of rest lengths (at most 2047
bins, whatever the corpus); repeat counts come from non-negative least squares against it, are
rounded down to what is there. Rests left over fill windows greedily with as many pieces as it takes;
what fits nowhere is packed one behind the other, cut where a window is full. The last, shorter
sequence is cut into powers of two, which need no padding.

Combinations: all pairs, and the triples that the current residual asks for most (column pricing).

Only the histogram reaches the driver. Each piece gets its rank among the pieces of its length from
a window per length and salt, so that one length that most documents share is spread over tasks.
Token ids are not kept: pass one keeps the CRC of every whole piece, and only documents that are cut
elsewhere are encoded again.

Defined cases: null text is empty and packs its closing id alone; repeated rows are packed as often
as they occur, each text encoded once more at most; ties between pieces of one length go by row; very long
texts give full sequences and one rest; null ids are packed; only id and text are read, so other columns may
have any name; an empty table gives no pieces.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_map, row_keys, stored
from .tokens import VOCABULARY, encoder

WINDOW = 2048
CLOSING_ID = 1
SALTS = 32
_ROUNDS = 6            # rounds of pricing
_COLUMNS = 2000        # triples added in each


def whole_pieces(documents: DataFrame, id_col: str, text_col: str, vocabulary: str) -> DataFrame:
    """Pieces of at most a window: k1, k2, id, start, length, CRC of its ids, tokens of the document."""
    def work(batches):
        ids_of = encoder(vocabulary).ids
        for batch in batches:
            out: list[list] = [[] for _ in range(5)]
            for i, text in enumerate(batch.column(3).to_pylist()):
                ids = np.append(ids_of(text), np.uint32(CLOSING_ID)).astype("<u4")
                for start in range(0, len(ids), WINDOW):
                    part = ids[start:start + WINDOW]
                    for column, value in zip(out, (i, start, len(part), zlib.crc32(part.tobytes()), len(ids))):
                        column.append(value)
            take = pa.array(out[0], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k).take(take) for k in range(3)), *(pa.array(c, pa.int64()) for c in out[1:])],
                names=["k1", "k2", id_col, "start", "length", "ids_crc32", "doc_tokens"])

    kind = documents.schema[id_col].dataType.simpleString()
    return arrow_map(documents.select(*row_keys(id_col, text_col), id_col, text_col), work,
                     f"k1 long, k2 long, {id_col} {kind}, start long, length long, ids_crc32 long, doc_tokens long")


# --- the plan, from the histogram alone -----------------------------------------------------------

def nonnegative_least_squares(columns: np.ndarray, target: np.ndarray, steps: int = 300) -> np.ndarray:
    """x >= 0 that brings sum_j x_j * columns_j near `target`; a column lists the bins it takes one of.

    Accelerated projected gradient; bin 0 is a dummy. Bins are scaled by 1/sqrt(target) so that rare
    lengths count as much as frequent ones."""
    weight = 1.0 / np.maximum(target, 1.0)
    weight[0] = 0.0
    size = len(target)

    def spread(x):
        return np.bincount(columns.ravel(), np.repeat(x, columns.shape[1]), minlength=size)

    load = spread(np.ones(len(columns)))
    step = 1.0 / np.maximum((weight * load)[columns].sum(axis=1), 1e-12)
    x = np.zeros(len(columns))
    y, pace = x, 1.0
    for _ in range(steps):
        slope = (weight * (target - spread(y)))[columns].sum(axis=1)
        new = np.maximum(0.0, y + step * slope)
        faster = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        y = new + (pace - 1) / faster * (new - x)
        x, pace = new, faster
    return x


def combinations(residual: np.ndarray, window: int) -> np.ndarray:
    """Triples a <= b <= c with a + b + c = window, by how much of `residual` they would use."""
    here = np.flatnonzero(residual > 0)
    found = []
    for a in here[here <= window // 3]:
        b = here[(here >= a) & (here <= (window - a) // 2)]
        c = window - a - b
        ok = residual[c] > 0
        if ok.any():
            b, c = b[ok], c[ok]
            gain = np.minimum(residual[a], np.minimum(residual[b], residual[c]))
            best = np.argsort(-gain, kind="stable")[:8]
            found.append(np.stack([gain[best], np.full(len(best), float(a)), b[best], c[best]], axis=1))
    if not found:
        return np.zeros((0, 3), int)
    rows = np.concatenate(found)
    return rows[np.argsort(-rows[:, 0], kind="stable")[:_COLUMNS], 1:].astype(int)


def fill(left: np.ndarray, window: int) -> list[int]:
    """Lengths still there that fill a window exactly: the longest that fits, again and again, but one
    or two that end it exactly first. Empty if none is found from any of the longest lengths."""
    for first in np.flatnonzero(left[:window])[::-1][:64]:
        free = left.copy()
        parts, gap = [int(first)], window - int(first)
        free[first] -= 1
        while gap:
            small = np.arange(1, gap // 2 + 1)
            pairs = small[(free[small] > 0) & (free[gap - small] > (small * 2 == gap))]
            if free[gap]:
                step = [gap]
            elif len(pairs):
                step = [int(pairs[-1]), gap - int(pairs[-1])]
            else:
                fits = np.flatnonzero(free[:gap])
                if not len(fits):
                    break
                step = [int(fits[-1])]
            for p in step:
                free[p] -= 1
                gap -= p
            parts += step
        if not gap:
            return parts
    return []


def make_plan(histogram: dict[int, int], window: int = WINDOW) -> tuple[list[tuple], dict[int, tuple], int]:
    """(runs, leftovers, sequences). A run (length, first rank, ranks, first sequence, offset) puts
    consecutive ranks of a length into consecutive sequences. leftovers: length -> (first rank, first
    token in the stream of leftovers); the stream fills sequences from `sequences` on."""
    left = np.zeros(window + 1, np.int64)
    for length, n in histogram.items():
        left[length] = n
    used = np.zeros(window + 1, np.int64)
    runs, sequences = [], 0

    def place(parts, n):
        nonlocal sequences
        at = 0
        for length in parts:
            runs.append((int(length), int(used[length]), int(n), sequences, int(at)))
            used[length] += n
            left[length] -= n
            at += length
        sequences += int(n)

    if left[window]:
        place((window,), int(left[window]))
    small = np.arange(1, window // 2 + 1)
    small = small[(left[small] > 0) & (left[window - small] > 0)]
    columns = np.stack([np.zeros_like(small), small, window - small], axis=1).astype(int)
    target = left.astype(float)
    if len(columns) or left[1:window].any():
        for _ in range(_ROUNDS):
            times = nonnegative_least_squares(columns, target) if len(columns) else np.zeros(0)
            rest = target - np.bincount(columns.ravel(), np.repeat(times, 3), minlength=window + 1)
            rest[0] = 0
            more = combinations(np.maximum(rest, 0) * (target > 0), window)
            new = np.unique(np.concatenate([columns, more]), axis=0)
            if len(new) == len(columns):
                break
            columns = new
        times = nonnegative_least_squares(columns, target) if len(columns) else np.zeros(0)
        for goal in (np.floor(times), None):
            for j in np.argsort(-times, kind="stable"):
                parts = [int(p) for p in columns[j] if p]
                most = min(int(left[p]) // parts.count(p) for p in set(parts))
                n = most if goal is None else min(most, int(goal[j]))
                if n > 0:
                    place(parts, n)
        while True:   # what rounding left: a window at a time, as often as its lengths allow
            parts = fill(left, window)
            if not parts:
                break
            place(parts, min(int(left[p]) // parts.count(p) for p in set(parts)))
    leftovers, at = {}, 0
    for length in range(window, 0, -1):
        if left[length]:
            leftovers[length] = (int(used[length]), at)
            at += length * int(left[length])
    return runs, leftovers, sequences


def _cuts(start: int, length: int, total: int, window: int) -> list[tuple[int, int, int, int]]:
    """(token of the piece, length, sequence, offset) of a piece at `start` in a stream of `total` tokens."""
    tail = total // window * window
    out, at = [], start
    while at < start + length:
        if at < tail:
            number, offset = divmod(at, window)
            end = (number + 1) * window
        else:  # the last sequence is written as powers of two, the largest first
            begin, number, rest = tail, tail // window, total - tail
            while True:
                size = 1 << (rest.bit_length() - 1)
                if at < begin + size:
                    break
                begin, rest, number = begin + size, rest - size, number + 1
            offset, end = at - begin, begin + size
        stop = min(end, start + length)
        out.append((at - start, stop - at, number, offset))
        at = stop
    return out


def pack(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """Per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    pieces = stored(whole_pieces(documents, id_col, text_col, vocabulary).withColumn("row", F.monotonically_increasing_id()), "pieces")
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)))
    counts = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # 2048 rows at most
    runs, leftovers, sequences = make_plan(histogram)
    total = sum(n * (histogram[n] - leftovers[n][0]) for n in leftovers)
    # Rank of a piece among those of its length: its rank within the salt, behind the salts before it.
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
    ranked = salted.withColumn("r", F.row_number().over(Window.partitionBy("length", "salt").orderBy("row")) - 1)
    ranked = ranked.join(F.broadcast(offsets), ["length", "salt"]).select(   # 2048 * SALTS rows at most
        "k1", "k2", id_col, "row", "start", "length", "ids_crc32", "doc_tokens", (F.col("ahead") + F.col("r")).alias("rank"))
    by_length: dict[int, list] = {}
    for length, first, n, sequence, offset in runs:
        by_length.setdefault(length, []).append((first, n, sequence, offset))
    found = {length: tuple(np.array(c) for c in zip(*sorted(rows))) for length, rows in by_length.items()}
    names = ["k1", "k2", id_col, "row", "start", "length", "ids_crc32", "doc_tokens"]

    def work(batches):
        for batch in batches:
            lengths, ranks = (batch.column(i).to_pylist() for i in (5, 8))
            out: list[list] = [[] for _ in range(5)]
            for i, (length, rank) in enumerate(zip(lengths, ranks)):
                if length in leftovers and rank >= leftovers[length][0]:
                    first, at = leftovers[length]
                    parts = [(skip, size, sequences + number, offset) for skip, size, number, offset in
                             _cuts(at + (rank - first) * length, length, total, WINDOW)]
                else:
                    first, _, sequence, offset = found[length]
                    j = int(np.searchsorted(first, rank, side="right")) - 1
                    parts = [(0, length, int(sequence[j]) + rank - int(first[j]), int(offset[j]))]
                for skip, size, number, offset in parts:
                    for column, value in zip(out, (i, skip, size, number, offset)):
                        column.append(value)
            take = pa.array(out[0], pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(k).take(take) for k in range(8)), *(pa.array(c, pa.int64()) for c in out[1:])],
                                             names=[*names, "skip", "size", "sequence_id", "offset"])

    kind = documents.schema[id_col].dataType.simpleString()
    placed = stored(arrow_map(ranked.select(*names, "rank"), work,
                              f"k1 long, k2 long, {id_col} {kind}, row long, start long, length long, ids_crc32 long, doc_tokens long, "
                              "skip long, size long, sequence_id long, offset long"), "placed")
    whole = placed.where("size = length").select(id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
    parts = placed.where("size < length")
    # A stretch of a text is encoded once, whatever number of rows hold that text, and met by the rows' pieces.
    stretch = [F.col("k1"), F.col("k2"), (F.col("start") + F.col("skip")).alias("start"), F.col("size").alias("length")]
    wanted = parts.select(*stretch).distinct().groupBy("k1", "k2").agg(F.collect_list(F.struct("start", "length")).alias("w"))
    texts = documents.select(*row_keys(id_col, text_col), F.col(text_col).alias("text")).join(wanted.select("k1", "k2"), ["k1", "k2"], "left_semi")
    texts = texts.dropDuplicates(["k1", "k2"]).join(wanted, ["k1", "k2"])

    def again(batches):
        ids_of = encoder(vocabulary).ids
        for batch in batches:
            rows = []
            for k1, k2, text, stretches in zip(*[batch.column(i).to_pylist() for i in range(4)]):
                ids = np.append(ids_of(text), np.uint32(CLOSING_ID)).astype("<u4")
                rows += [(k1, k2, w["start"], w["length"], zlib.crc32(ids[w["start"]:w["start"] + w["length"]].tobytes())) for w in stretches]
            columns = list(zip(*rows)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["k1", "k2", "start", "length", "ids_crc32"])

    found_again = arrow_map(texts.select("k1", "k2", "text", "w"), again, "k1 long, k2 long, start long, length long, ids_crc32 long")
    cut = parts.select(id_col, *stretch, "doc_tokens", "sequence_id", "offset").join(found_again, ["k1", "k2", "start", "length"])
    return whole.union(cut.select(*whole.columns))
