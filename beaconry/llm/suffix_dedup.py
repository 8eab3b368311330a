"""Bytes that lie in a repeated string of 400 bytes, found by a distributed sort of sampled suffixes.

Every start of a 400-byte window is served by one anchor: the position with the smallest hash of
its 8 bytes among the 200 positions from the start on. Equal windows have their anchor at the same
place, so only suffixes at anchors (about one per 100 bytes) need sorting, not one per byte.

1. The suffixes at all anchors, with the leading bytes, a name of their first 200 bytes (`inner`,
   part of every window the anchor serves) and a name of all bytes that the anchor's windows
   cover (`outer`), go to buckets by sampled splitters and are sorted there (multikey quicksort).
   Neighbours are compared, also across bucket boundaries. Equal `outer`: all these windows
   repeat. No neighbour with this `inner`: none does. Else undecided.
2. Undecided anchors are split into bands of 16 starts, and undecided bands into single windows;
   both are sorted and compared in the same way. A window is decided by its 400 bytes alone.

The length of a window is a parameter (`Windows`), in bytes or in words; reach and bands follow from
it. Windows of words are compared as words, whatever white space is between them; op8 has 400 bytes
alone, the pipeline also looks at 51 words, so that every passage of over 50 words is found.

Names are XXH3 of 128 bits where equality decides, of 64 bits where it only groups. The sort ends
in the row's own key, so that even one string that half of all rows hold spreads over buckets.

Defined cases: null text is empty; texts under one window lose nothing; a repeated row is another
document; windows never cross documents; null ids are fine; other columns pass through unread.
"""

from __future__ import annotations

import hashlib
import re
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_map, nested, partitions_for, row_keys, stored, unnested

SPAN = 400
_PIECE = 1 << 22  # bytes of a text whose anchors are looked up at a time
_ROWS = 300_000   # suffixes a bucket should hold
_ROW = "k1 long, k2 long, lead long, inner long, outer_hi long, outer_lo long, lo int, hi int, a int"
_FIELDS = [f.split()[0] for f in _ROW.split(", ")]
_MIX = np.uint64(0x9E3779B97F4A7C15)
_WORD = re.compile(r"\S+")


class Windows(NamedTuple):
    """Length of a window, in bytes or in words; 16 at least."""

    span: int = SPAN
    words: bool = False

    @property
    def reach(self) -> int:
        """Window starts that look for an anchor: it is among so many first positions."""
        return self.span // 2

    @property
    def band(self) -> int:
        return max(1, self.reach // 12)

    def units(self, data: bytes):
        """What positions count: bytes, or words."""
        return data.decode("utf-8", "replace").split() if self.words else data

    def joined(self, units) -> bytes:
        return " ".join(units).encode() if self.words else units


BYTES, PASSAGES = Windows(), Windows(51, True)


def anchors(text, kind: Windows = BYTES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last window start, and position, of every anchor of `text` (units of `kind`)."""
    span, reach = kind.span, kind.reach
    if span < 16:
        raise ValueError("windows have 16 units at least")
    if len(text) < span:
        return (np.zeros(0, np.int64),) * 3
    codes = np.array([xxhash.xxh3_64_intdigest(w) for w in text], np.uint64) if kind.words else np.frombuffer(text, np.uint8)
    lows, highs, places = [], [], []
    for begin in range(0, len(text) - span + 1, _PIECE):
        part = codes[begin:begin + _PIECE + span - 1]
        starts = len(part) - span + 1
        if kind.words:
            value = (((part[:-2] * _MIX ^ part[1:-1]) * _MIX ^ part[2:]) * _MIX)[:starts + reach - 1]
        else:
            grams = np.lib.stride_tricks.sliding_window_view(part, 8)[:starts + reach - 1]
            value = np.ascontiguousarray(grams).view("<u8").ravel() * _MIX
        value = (value ^ (value >> np.uint64(29))) * _MIX
        value = (value & ~np.uint64(0xFFFFFF)) | np.arange(len(value), dtype=np.uint64)
        width = 1
        while width * 2 <= reach:
            value = np.minimum(value[:-width], value[width:])
            width *= 2
        rest = reach - width
        value = np.minimum(value[:starts], value[rest:rest + starts])
        place = (value & np.uint64(0xFFFFFF)).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
        lows.append(first + begin)
        highs.append(np.concatenate((first[1:] - 1, [starts - 1])) + begin)
        places.append(place[first] + begin)
    return np.concatenate(lows), np.concatenate(highs), np.concatenate(places)


class _Rows:
    """Columns of suffix rows, filled one by one."""

    def __init__(self, kind):
        self.kind = kind
        self.keys, self.names, self.lead = [], bytearray(), bytearray()
        self.inner, self.places = [], []

    def add(self, k1, k2, text, lo, hi, a, inner, seed, start):
        self.keys.append((k1, k2))
        self.inner.append(xxhash.xxh3_64_intdigest(inner, seed))
        self.names += xxhash.xxh3_128_digest(self.kind.joined(text[start:start + hi - lo + self.kind.span]))
        self.places.append((lo, hi, a))

    def batch(self, lead: list[bytes]) -> pa.RecordBatch:
        n = len(self.inner)
        keys = np.array(self.keys, np.int64).reshape(n, 2)
        places = np.array(self.places, np.int32).reshape(n, 3)
        names = np.frombuffer(bytes(self.names), ">i8").astype(np.int64).reshape(n, 2)
        words = (np.frombuffer(b"".join(lead), ">u8") ^ np.uint64(1 << 63)).view(np.int64) if n else np.zeros(0, np.int64)
        inner = np.array(self.inner, np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (
            keys[:, 0].copy(), keys[:, 1].copy(), words, inner, names[:, 0].copy(), names[:, 1].copy(),
            places[:, 0].copy(), places[:, 1].copy(), places[:, 2].copy())], names=_FIELDS)


def _sampled(kind):
    """Level one: the suffix at every anchor."""
    def work(batches):
        for batch in batches:
            rows, lead = _Rows(kind), []
            for k1, k2, data in zip(*(batch.column(i).to_pylist() for i in range(3))):
                text = kind.units(data)
                for lo, hi, a in zip(*(x.tolist() for x in anchors(text, kind))):
                    inner = kind.joined(text[a:a + kind.span - kind.reach])
                    rows.add(k1, k2, text, lo, hi, a, inner, 0, lo)
                    lead.append(inner[:8])
                if len(lead) > 50_000:
                    yield rows.batch(lead)
                    rows, lead = _Rows(kind), []
            yield rows.batch(lead)
    return work


def _split(kind, width):
    """Level two and three: the starts of an anchor in bands of `width`, from the bytes kept of it."""
    def work(batches):
        for batch in batches:
            rows, lead = _Rows(kind), []
            for k1, k2, base, lo, hi, a, data in zip(*(batch.column(i).to_pylist() for i in range(7))):
                text = kind.units(data)
                for band in range((a - hi) // width, (a - lo) // width + 1):
                    near, far = band * width, band * width + width - 1
                    first, last = max(lo, a - far), min(hi, a - near)
                    inner = kind.joined(text[a - near - base:a + kind.span - far - base])
                    rows.add(k1, k2, text, first, last, a, inner, band + 1, first - base)
                    lead.append(inner[:8])
                if len(lead) > 50_000:
                    yield rows.batch(lead)
                    rows, lead = _Rows(kind), []
            yield rows.batch(lead)
    return work


def multikey_order(keys: list[np.ndarray]) -> np.ndarray:
    """Order of rows by several keys: quicksort on one key, then only runs of ties on the next."""
    order = np.argsort(keys[0], kind="quicksort")
    run = np.cumsum(np.concatenate(([0], keys[0][order][1:] != keys[0][order][:-1])))
    for key in keys[1:]:
        tied = np.zeros(len(order), bool)
        same = run[1:] == run[:-1]
        tied[1:] |= same
        tied[:-1] |= same
        if not tied.any():
            break
        sub = order[tied]
        inside = np.argsort(key[sub], kind="quicksort")
        inside = inside[np.argsort(run[tied][inside], kind="stable")]
        order[tied] = sub[inside]
        value = key[order]
        run = np.cumsum(np.concatenate(([0], (run[1:] != run[:-1]) | (value[1:] != value[:-1]))))
    return order


def _compare(batches):
    """Sort one bucket and mark repeats (`same`), what needs a closer look (`open`) and the two rows
    at the ends (`side`), which the next buckets may change."""
    from pyspark import TaskContext

    batches = list(batches)
    if not sum(b.num_rows for b in batches):
        return
    table = pa.Table.from_batches(batches)
    cols = {name: table.column(name).to_numpy() for name in _FIELDS}
    order = multikey_order([cols[k] for k in ("lead", "inner", "outer_hi", "outer_lo", "k1", "k2", "lo")])
    lead, inner, high, low = (cols[k][order] for k in ("lead", "inner", "outer_hi", "outer_lo"))
    near = (lead[1:] == lead[:-1]) & (inner[1:] == inner[:-1])
    equal = near & (high[1:] == high[:-1]) & (low[1:] == low[:-1])
    no = np.array([False])
    same = np.concatenate((no, equal)) | np.concatenate((equal, no))
    starts_run = np.concatenate(([True], ~equal))
    # A run of equal rows is looked at through its first row, if its group holds another run.
    group = np.cumsum(np.concatenate(([0], ~near)))
    runs = np.bincount(group, weights=starts_run)
    opened = starts_run & (runs[group] > 1)
    side = np.zeros(len(order), np.int32)
    side[0] |= 1
    side[-1] |= 2
    keep = np.flatnonzero(same | opened | (side > 0))
    bucket = TaskContext.get().partitionId()
    yield pa.RecordBatch.from_arrays(
        [pa.array(cols[name][order[keep]]) for name in _FIELDS]
        + [pa.array(same[keep]), pa.array(opened[keep]), pa.array(side[keep]),
           pa.array(np.full(len(keep), bucket, np.int32))],
        names=[*_FIELDS, "same", "open", "side", "bucket"])


def sort_and_compare(rows: DataFrame, partitions: int, label: str) -> DataFrame:
    """`rows` that repeat (`same`) or are undecided (`open`), written to the shared folder."""
    ranged = rows.repartitionByRange(partitions, "lead", "inner", "outer_hi", "outer_lo", "k1", "k2", "lo")
    found = stored(ranged.mapInArrow(_compare, _ROW + ", same boolean, open boolean, side int, bucket int"), label)
    # At most two rows of each bucket: the first and the last, next to each other across boundaries.
    line = Window.orderBy("bucket", "side")
    ends = found.where("side > 0")
    ends = ends.select(*_FIELDS, "same", "open", "bucket", F.explode(F.expr("filter(array(1, 2), x -> (side & x) > 0)")).alias("side"))

    def beside(step, column):
        other = F.lag if step < 0 else F.lead
        return other(column).over(line)

    def compared(step):
        across = beside(step, "bucket") != F.col("bucket")
        near = across & (beside(step, "lead") == F.col("lead")) & (beside(step, "inner") == F.col("inner"))
        equal = near & (beside(step, "outer_hi") == F.col("outer_hi")) & (beside(step, "outer_lo") == F.col("outer_lo"))
        return F.coalesce(near, F.lit(False)), F.coalesce(equal, F.lit(False))

    (near_before, same_before), (near_after, same_after) = compared(-1), compared(1)
    ends = ends.select(
        *_FIELDS, (F.col("same") | same_before | same_after).alias("same"),
        (F.col("open") | (near_before & ~same_before) | (near_after & ~same_after)).alias("open"))
    return found.where("side = 0").select(*_FIELDS, "same", "open").union(ends).where("same or open")


def _cut(kind):
    """The bytes that an undecided anchor's windows cover."""
    def work(batches):
        for batch in batches:
            out = []
            for k1, k2, data, wanted in zip(*(batch.column(i).to_pylist() for i in range(4))):
                text = kind.units(data)
                out += [(k1, k2, w["lo"], w["lo"], w["hi"], w["a"], kind.joined(text[w["lo"]:w["hi"] + kind.span])) for w in wanted]
            columns = list(zip(*out)) or [[]] * 7
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)],
                                             names=["k1", "k2", "base", "lo", "hi", "a", "bytes"])
    return work


def repeated_spans(docs: DataFrame, kind: Windows = BYTES) -> DataFrame:
    """(k1, k2, lo, hi): starts lo..hi, in units of `kind`, of windows of the text named by k1, k2 that repeat elsewhere.

    docs: k1, k2, bytes."""
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length("bytes"))).first()[0] or 0
    parts = partitions_for(spark, total // (kind.reach // 2 * (6 if kind.words else 1)), _ROWS)
    first = sort_and_compare(arrow_map(docs, _sampled(kind), _ROW), parts, "suffixes")
    wanted = first.where("open").groupBy("k1", "k2").agg(F.collect_set(F.struct("lo", "hi", "a")).alias("wanted"))
    cut = stored(arrow_map(docs.join(wanted, ["k1", "k2"]).select("k1", "k2", "bytes", "wanted"), _cut(kind),
                           "k1 long, k2 long, base int, lo int, hi int, a int, bytes binary"), "cut")
    bands = kind.reach // kind.band
    parts = partitions_for(spark, cut.count() * (bands // 2 + 1), _ROWS)
    second = sort_and_compare(arrow_map(cut, _split(kind, kind.band), _ROW), parts, "bands")
    pieces = second.where("open").select("k1", "k2", "lo", "hi", "a").distinct()
    kept = cut.select("k1", "k2", "base", "a", F.col("hi").alias("end"), "bytes").distinct()
    single = pieces.join(kept, ["k1", "k2", "a"]).where("lo >= base and hi <= end").select("k1", "k2", "base", "lo", "hi", "a", "bytes")
    third = sort_and_compare(arrow_map(single, _split(kind, 1), _ROW),
                             partitions_for(spark, pieces.count() * kind.band, _ROWS), "windows")
    levels = [x.where("same").select("k1", "k2", "lo", "hi") for x in (first, second, third)]
    return levels[0].union(levels[1]).union(levels[2])


def _word_edges(data):
    """First byte of every word, and the byte behind it."""
    text = data.decode("utf-8", "replace")
    edges = np.array([m.span() for m in _WORD.finditer(text)], np.int64).reshape(-1, 2)
    if len(text) < len(data):
        code = np.frombuffer(text.encode("utf-32-le"), "<u4")
        edges = np.concatenate(([0], np.cumsum(1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF))))[edges]
    return edges


def _merged(spans, data):
    """Maximal runs of removed bytes."""
    ranges, edges = [], None
    for s in spans or ():
        lo, hi = s["lo"], s["hi"] + s["span"]
        if s["words"]:
            edges = _word_edges(data) if edges is None else edges
            lo, hi = int(edges[lo, 0]), int(edges[hi - 1, 1])
        ranges.append((lo, min(hi, len(data))))
    runs = []
    for lo, hi in sorted(ranges):
        if runs and lo <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], hi)
        else:
            runs.append([lo, hi])
    return [tuple(r) for r in runs]


def with_spans(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", kinds: tuple = (BYTES,)) -> DataFrame:
    """Per row of `documents`: `row` (all its columns), `bytes` (UTF-8 of the text, null as empty) and `spans` (starts
    of windows of any of `kinds` that repeat; equal rows have equal spans)."""
    clear = nested(documents, F.coalesce(F.encode(F.col(text_col), "UTF-8"), F.lit(b"")).alias("bytes"), F.col(id_col).alias("id"))
    clear = clear.select("row", "bytes", *row_keys("id", "bytes"))
    docs = clear.select("k1", "k2", "bytes")
    spans = reduce(DataFrame.union, [repeated_spans(docs, k).select("k1", "k2", "lo", "hi", F.lit(k.span).alias("span"), F.lit(k.words).alias("words")) for k in kinds])
    spans = spans.groupBy("k1", "k2").agg(F.collect_set(F.struct("lo", "hi", "span", "words")).alias("spans"))
    return clear.join(spans, ["k1", "k2"], "left").select("row", "bytes", "spans")


def _rest(data: bytes, runs: list[tuple[int, int]]) -> bytes:
    """`data` without `runs`."""
    at, kept = 0, []
    for lo, hi in runs:
        kept.append(data[at:lo])
        at = hi
    return b"".join(kept) + data[at:]


def removal_report(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: bytes, removed bytes, removed runs, SHA-256 of what is left, and that as `text` (without
    the bytes of a character cut apart)."""
    def work(batches):
        for batch in batches:
            sizes, gone, runs, digests, texts = [], [], [], [], []
            for data, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                cut = _merged(spans, data)
                rest = _rest(data, cut)
                sizes.append(len(data))
                gone.append(len(data) - len(rest))
                runs.append(len(cut))
                digests.append(hashlib.sha256(rest).hexdigest())
                texts.append(rest.decode("utf-8", "ignore"))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), pa.array(runs, pa.int64()),
                 pa.array(digests, pa.string()), pa.array(texts, pa.string())],
                names=[id_col, "n_bytes", "n_removed", "n_spans", "kept_sha256", "text"])

    kind = documents.schema[id_col].dataType.simpleString()
    rows = with_spans(documents.select(id_col, text_col), id_col, text_col)
    return arrow_map(rows.select(F.col("row").getField(id_col).alias(id_col), "bytes", "spans"), work,
                     f"{id_col} {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, text string")


def without_repeats(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", kinds: tuple = (BYTES,)) -> DataFrame:
    """`documents` whose text has lost every repeated passage; bytes of a character cut apart go too."""
    def work(batches):
        for batch in batches:
            rests = [_rest(data, _merged(spans, data)).decode("utf-8", "ignore") if spans else None
                     for data, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rests, pa.string())], names=["row", "rest"])

    rows = with_spans(documents, id_col, text_col, kinds)
    cut = arrow_map(rows, work, rows.select("row").schema.add("rest", "string"))
    return cut.select(*unnested(documents.schema, {text_col: F.coalesce("rest", F.col("row").getField(text_col))}))
