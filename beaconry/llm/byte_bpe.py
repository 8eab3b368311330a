"""Byte-level BPE by a reduction over halves of a text, and decoding up the same kind of tree.

A node stands for one stretch of a text and holds its encoding as if the stretch were a whole text:
where its pieces start (a piece is one match of the public pattern) and the ids of each piece. Leaves
are short stretches; two neighbours are joined by encoding again around their border until nothing
farther out can change. The join is associative, so any tree over the leaves gives the same ids.

Why the rest cannot change:

* Pieces. A match depends on nothing in front of its start and on at most two characters behind its
  end. So pieces of the left node that end two characters before the border stand, and once a
  piece of the new split starts where a piece of the right node starts, all later ones agree.
* Tokens inside a long piece. A list of tokens is the encoding of its bytes if and only if every two
  neighbours are the encoding of theirs: the first merge across a token's border would also happen
  in the pair alone, since merges inside the tokens come in the same order there. So a window of
  tokens around the border is encoded again; if its outermost tokens come out as they were, every
  pair within the window and beside it is sound, and so is the whole. Else that side grows.

Defined cases: null text is empty and has no ids; a repeated row is encoded again and stays a row of
its own; very long texts and texts of one endless piece are reduced like any other; only the id
column is carried along, so columns of any name are fine, and a null id too; an empty table gives none.
"""

from __future__ import annotations

import base64
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_map

RANKS = "byte_bpe_multi_50k.tiktoken"
#: Characters of a leaf.
LEAF = 2048
#: Longest piece, in characters, that is encoded whole; longer ones are joined from the parts the nodes hold.
WHOLE_PIECE = 256
#: Characters and tokens that a window around a border starts with.
FIRST_WINDOW, FIRST_TOKENS = 32, 4
_KNOWN_PIECES = 300_000
#: Characters behind its end that a match may depend on (the contractions look two ahead).
_AHEAD = 2


class _Pieces(dict):
    """Ids of short pieces, as bytes of little-endian unsigned 32-bit numbers."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, piece):
        ids = np.array(self.encode(piece), "<u4").tobytes()
        if len(self) < _KNOWN_PIECES and len(piece) <= 64:
            self[piece] = ids
        return ids


class Node:
    """Encoding of text[lo:hi] on its own: starts of its pieces and the ids of each."""

    __slots__ = ("lo", "hi", "starts", "ids")

    def __init__(self, lo: int, hi: int, starts: list[int], ids: list[bytes]):
        self.lo, self.hi, self.starts, self.ids = lo, hi, starts, ids

    def end(self, i: int) -> int:
        return self.starts[i + 1] if i + 1 < len(self.starts) else self.hi


class TreeCoder:
    """Encoder and decoder over one rank file; built once in a Python worker."""

    def __init__(self, ranks_name: str = RANKS, leaf: int = LEAF, whole_piece: int = WHOLE_PIECE):
        import public_tokenizers as public
        import regex
        import tiktoken

        with open(public.path(ranks_name), "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.pattern = regex.compile(public.PATTERN)
        self.single = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=self.ranks,
                                        special_tokens={})._encode_single_piece
        self.known = _Pieces(self.single)
        self.leaf, self.whole_piece = leaf, whole_piece
        size = max(self.ranks.values()) + 1
        self.bytes_of = [b""] * size
        for token, rank in self.ranks.items():
            self.bytes_of[rank] = token
        self.byte_length = np.array([len(b) for b in self.bytes_of], np.int64)

    # Tokens of one piece -----------------------------------------------------------------------

    def merged(self, data: bytes) -> np.ndarray:
        """The encoding of `data` by merges alone: a whole piece that is a token is looked up
        by the library, which says nothing about pieces that go on."""
        if data not in self.ranks:
            return np.array(self.single(data), "<u4")
        parts = [data[i:i + 1] for i in range(len(data))]
        while True:
            pairs = [(self.ranks[p], i) for i, p in enumerate(a + b for a, b in zip(parts, parts[1:])) if p in self.ranks]
            if not pairs:
                return np.array([self.ranks[p] for p in parts], "<u4")
            i = min(pairs)[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]

    def data(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))

    def joined(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Encoding of the bytes of two encodings one after the other."""
        if not len(left) or not len(right):
            return left if len(left) else right
        a, b = min(FIRST_TOKENS, len(left)), min(FIRST_TOKENS, len(right))
        while True:
            window = self.merged(self.data(left[len(left) - a:]) + self.data(right[:b]))
            left_stands = a == len(left) or window[0] == left[len(left) - a]
            right_stands = b == len(right) or window[-1] == right[b - 1]
            if left_stands and right_stands:
                return np.concatenate([left[:len(left) - a], window, right[b:]])
            a = a if left_stands else min(2 * a, len(left))
            b = b if right_stands else min(2 * b, len(right))

    def cut(self, ids: np.ndarray, text: str, lo: int, hi: int, start: int, end: int) -> list[np.ndarray]:
        """Encodings, in order, that cover text[start:end] within a piece text[lo:hi] of `ids`.

        Tokens inside the stretch are kept: a run of tokens of an encoding is the encoding of its bytes."""
        if (start, end) == (lo, hi):
            return [ids]
        data = text[lo:hi].encode()
        first, last = len(text[lo:start].encode()), len(data) - len(text[end:hi].encode())
        ends = np.cumsum(self.byte_length[ids])
        i, j = int(np.searchsorted(ends - self.byte_length[ids], first)), int(np.searchsorted(ends, last, "right"))
        if i >= j:
            return [self.merged(data[first:last])]
        inner_first, inner_last = int(ends[i] - self.byte_length[ids[i]]), int(ends[j - 1])
        sides = [self.merged(data[a:b]) if b > a else None for a, b in ((first, inner_first), (inner_last, last))]
        return [part for part in (sides[0], ids[i:j], sides[1]) if part is not None]

    # The tree over a text ----------------------------------------------------------------------

    def leaf_node(self, text: str, lo: int, hi: int) -> Node:
        pieces = self.pattern.findall(text, lo, hi)
        starts = list(accumulate(map(len, pieces), initial=lo))
        starts.pop()
        return Node(lo, hi, starts, list(map(self.known.__getitem__, pieces)))

    def join(self, text: str, left: Node, right: Node) -> Node:
        """One node for two neighbours; `left` is used up."""
        border, keep = left.hi, len(left.starts)
        while keep and left.end(keep - 1) + _AHEAD > border:
            keep -= 1
        old = [(left.starts[i], left.end(i), left.ids[i]) for i in range(keep, len(left.starts))]
        at = old[0][0] if old else border
        seam, window, j = [], FIRST_WINDOW, 0
        met = False
        while not met:   # every pass ends at a piece that the next characters cannot change, or has doubled the window
            until = min(border + window, right.hi)
            for match in self.pattern.finditer(text, at, until):
                end = match.end()
                if end + _AHEAD > until and until < right.hi:
                    break
                seam.append((at, end))
                at = end
                while j < len(right.starts) and right.starts[j] < at:
                    j += 1
                met = at == right.hi or (j < len(right.starts) and right.starts[j] == at)
                if met:
                    break
            met = met or at == right.hi
            window *= 2
        old += [(right.starts[i], right.end(i), right.ids[i]) for i in range(j)]
        del left.starts[keep:], left.ids[keep:]
        left.starts.extend(a for a, _ in seam)
        left.ids.extend(self.piece(text, a, b, old) for a, b in seam)
        left.starts.extend(right.starts[j:])
        left.ids.extend(right.ids[j:])
        left.hi = right.hi
        return left

    def piece(self, text: str, start: int, end: int, old: list[tuple[int, int, bytes]]) -> bytes:
        """Ids of the piece text[start:end]; a long one is joined from the parts in `old`, which cover it."""
        if end - start <= self.whole_piece:
            return self.known[text[start:end]]
        ids = np.zeros(0, "<u4")
        for a, b, parts in old:
            if a < end and b > start:
                for part in self.cut(np.frombuffer(parts, "<u4"), text, a, b, max(a, start), min(b, end)):
                    ids = self.joined(ids, part)
        return ids.astype("<u4").tobytes()

    def node(self, text: str, lo: int, hi: int) -> Node:
        if hi - lo <= self.leaf:
            return self.leaf_node(text, lo, hi)
        middle = (lo + hi) // 2
        return self.join(text, self.node(text, lo, middle), self.node(text, middle, hi))

    def encode(self, text: str | None) -> bytes:
        return b"".join(self.node(text, 0, len(text)).ids) if text else b""

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of `ids`: short runs by lookup, neighbours concatenated up the tree."""
        level = [self.data(ids[i:i + self.leaf]) for i in range(0, len(ids), self.leaf)]
        while len(level) > 1:
            level = [b"".join(level[i:i + 2]) for i in range(0, len(level), 2)]
        return level[0] if level else b""


_CODERS: dict[str, TreeCoder] = {}


def coder(ranks_name: str = RANKS) -> TreeCoder:
    if ranks_name not in _CODERS:
        _CODERS[ranks_name] = TreeCoder(ranks_name)
    return _CODERS[ranks_name]


def encode(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks_name: str = RANKS) -> DataFrame:
    """`id_col` and `ids` (array of int) of every text, as the ranks in `ranks_name` encode it."""
    def work(batches):
        tree = coder(ranks_name)
        for batch in batches:
            found = [tree.encode(t) for t in batch.column(1).to_pylist()]
            ends = pa.array(np.cumsum([0] + [len(f) // 4 for f in found]), pa.int32())
            values = pa.array(np.frombuffer(b"".join(found), "<i4"), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(ends, values)], names=[id_col, "ids"])

    kind = documents.schema[id_col].dataType
    schema = T.StructType([T.StructField(id_col, kind), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return arrow_map(documents.select(id_col, F.col(text_col).alias("text")), work, schema)


def decode(encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", ranks_name: str = RANKS) -> DataFrame:
    """`id_col`, `ids` and `decoded` (binary), the bytes that the ids stand for; null ids are none."""
    def work(batches):
        tree = coder(ranks_name)
        for batch in batches:
            found = [tree.decode(np.array(ids if ids is not None else [], np.int64)) for ids in _lists(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.binary())],
                                             names=[id_col, "ids", "decoded"])

    fields = [T.StructField(id_col, encoded.schema[id_col].dataType), T.StructField("ids", encoded.schema[ids_col].dataType),
              T.StructField("decoded", T.BinaryType())]
    return arrow_map(encoded.select(id_col, F.col(ids_col).alias("ids")), work, T.StructType(fields))


def _lists(column: pa.ListArray):
    """The lists of an Arrow column as numpy arrays."""
    values, ends = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    for i, valid in enumerate(column.is_valid().to_pylist()):
        yield values[ends[i]:ends[i + 1]] if valid else None


def round_trip(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks_name: str = RANKS) -> DataFrame:
    """Digests of both directions: n_tokens, ids_sha256 (decimal ids joined by commas), decoded_sha256."""
    both = decode(encode(documents, id_col, text_col, ranks_name), id_col, "ids", ranks_name)
    return both.select(
        id_col, F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
