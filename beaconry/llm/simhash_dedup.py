"""Near duplicates by 64-bit SimHash and the generalised pigeonhole principle.

Two fingerprints differ in at most 4 bits only if, for any split of the bits into parts with
thresholds t_i where sum(t_i + 1) = 5, some part differs in at most t_i bits. Bits that go together
are put into one part (so that the other parts stay selective); the thresholds come from a dynamic
program over the estimated cost of probing every part at every threshold. A fingerprint is filed
under all values within t_i / 2 bits (rounded up) of its value of part i, so that two values within
t_i bits meet halfway; what meets under a value is verified on all 64 bits.

Work is done on distinct fingerprints, so copies cost nothing. Within one value no pairs are written:
a task links its fingerprints by breadth-first search and keeps one edge per fingerprint reached. A
value that more than `BLOCK` fingerprints share is cut into blocks, and every two blocks meet in a
task of their own, so no task reads more than 2 * BLOCK fingerprints.

Defined cases: null and empty texts have fingerprint zero and are linked like any other; repeated
rows are members of their component; a null id never names a component unless all its ids are null.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, connected, nested, partitions_for, row_keys, stored, unnested

BITS, DISTANCE, SHINGLE, SEED = 64, 4, 4, 42
BLOCK = 4096
SAMPLE = 2000          # fingerprints whose pairwise distances estimate the cost; results do not depend on them
_ROW_COST = 30.0       # a filed row costs as much as so many verifications
_ONE = np.uint64(1)


def fingerprint(text: str | None) -> int:
    """SimHash of the 4-word shingles; a bit is set if it is set in over half of their hashes."""
    words = (text or "").encode().lower().split()  # bytes: A-Z only, and exactly the six ASCII spaces
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= SHINGLE:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends, at = [], -1
    for w in words:
        at += len(w) + 1
        ends.append(at)
    starts = [0, *(e + 1 for e in ends[:-SHINGLE])]
    digest = xxhash.xxh64_intdigest
    total, count = np.zeros(BITS, np.int64), len(starts)
    for k in range(0, count, 65536):
        hashes = np.array([digest(joined[a:b], SEED) for a, b in
                           zip(starts[k:k + 65536], ends[k + SHINGLE - 1:k + SHINGLE - 1 + 65536])], np.uint64)
        total += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * total > count).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(documents: DataFrame, text_col: str = "text", keep: tuple = ()) -> DataFrame:
    """`keep` columns and `fp`, the fingerprint as a signed long."""
    def work(batches):
        for batch in batches:
            last = batch.num_columns - 1
            values = np.array([fingerprint(t) for t in batch.column(last).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:last], pa.array(values)], names=[*keep, "fp"])

    schema = documents.select(*keep).schema.add("fp", "long")
    return arrow_map(documents.select(*keep, text_col), work, schema)


# --- the plan of parts and thresholds -------------------------------------------------------------

def bit_moments(prints: DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of fingerprints, and how often each bit and each two bits are set, over all of them."""
    def work(batches):
        count, both = 0, np.zeros((BITS, BITS), np.int64)
        for batch in batches:
            if batch.num_rows:
                values = batch.column(0).to_numpy().astype(np.uint64)
                bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
                both += np.rint(bits.T @ bits).astype(np.int64)
                count += batch.num_rows
        yield pa.RecordBatch.from_arrays([pa.array([count]), pa.array([both.ravel().tolist()])], names=["n", "both"])

    rows = prints.select("fp").mapInArrow(work, "n long, both array<long>")
    cells = rows.select("n", F.posexplode("both").alias("i", "c")).groupBy("i").agg(F.sum("n").alias("n"), F.sum("c").alias("c"))
    table = {r["i"]: (r["n"], r["c"]) for r in cells.collect()}  # 64 x 64 cells
    both = np.array([table.get(i, (0, 0))[1] for i in range(BITS * BITS)], float).reshape(BITS, BITS)
    return (table[0][0] if table else 0), np.diag(both).copy(), both


def group_bits(n: int, ones: np.ndarray, both: np.ndarray, parts: int) -> list[list[int]]:
    """Bits in `parts` groups of even size, each bit with those it is correlated with."""
    mean = ones / max(n, 1)
    spread = np.sqrt(np.maximum(mean * (1 - mean), 1e-9))
    link = np.abs((both / max(n, 1) - np.outer(mean, mean)) / np.outer(spread, spread))
    np.fill_diagonal(link, 0)
    left, groups = list(range(BITS)), []
    for k in range(parts):
        size = len(left) // (parts - k)
        group = [max(left, key=lambda i: link[i, left].sum())]
        left.remove(group[0])
        while len(group) < size:
            near = max(left, key=lambda i: link[i, group].sum())
            group.append(near)
            left.remove(near)
        groups.append(sorted(group))
    return groups


def _mask(bits) -> int:
    return sum(1 << b for b in bits)


def _ball(width: int, radius: int) -> int:
    total, term = 0, 1
    for k in range(radius + 1):
        total += term
        term = term * (width - k) // (k + 1)
    return total


def _radius(threshold: int) -> int:
    """Bits flipped on either side so that values within `threshold` bits meet."""
    return -(-threshold // 2)


def allocate(costs: list[list[float]], budget: int = DISTANCE + 1) -> tuple[float, list[int]]:
    """Threshold of each part, -1 for none, with sum(t + 1) = budget at least cost. costs[i][t] is for t >= 0."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for part in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, chosen) in best.items():
            for t in range(-1, min(len(part) - 1, budget - used - 1) + 1):
                total = cost + (part[t] if t >= 0 else 0.0)
                if used + t + 1 not in step or total < step[used + t + 1][0]:
                    step[used + t + 1] = (total, [*chosen, t])
        best = step
    return best[budget]


def choose_plan(n: int, ones, both, sample: np.ndarray) -> list[tuple[int, list[int]]]:
    """(mask, flips) of each part probed: the cheapest over splits into 1 to 5 parts."""
    best = None
    for parts in range(1, DISTANCE + 2):
        groups = group_bits(n, ones, both, parts)
        costs = []
        for group in groups:
            value = sample & np.uint64(_mask(group))
            near = np.zeros(BITS + 1)
            for x in value:
                near += np.bincount(np.bitwise_count(value ^ x), minlength=BITS + 1)
            share = np.cumsum(near - np.bincount([0], weights=[len(value)], minlength=BITS + 1)) / max(1, len(value) * (len(value) - 1))
            # a sample cannot see shares below one pair; evenly spread bits are the least there is
            least = [min(1.0, _ball(len(group), r) / 2.0 ** len(group)) for r in range(DISTANCE + 1)]
            reach = [2 * _radius(t) for t in range(DISTANCE + 1)]
            costs.append([_ROW_COST * n * _ball(len(group), r // 2) + n * n * max(share[r], least[r]) / 2 for r in reach])
        cost, chosen = allocate(costs)
        if best is None or cost < best[0]:
            best = (cost, [(group, t) for group, t in zip(groups, chosen) if t >= 0])
    plan = []
    for group, t in best[1]:
        flips = [_mask(c) for k in range(_radius(t) + 1) for c in combinations(group, k)]
        plan.append((_mask(group), flips))
    return plan


# --- probing and linking --------------------------------------------------------------------------

def _filed(plan):
    masks = [(np.uint64(mask), np.array(flips, np.uint64)) for mask, flips in plan]

    def work(batches):
        for batch in batches:
            fp = batch.column(0).to_numpy().astype(np.uint64)
            for part, (mask, flips) in enumerate(masks):
                step = max(1, 2_000_000 // len(flips))
                for k in range(0, len(fp), step):
                    some = fp[k:k + step]
                    keys = ((some & mask)[:, None] ^ flips[None, :]).ravel().view(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(keys), part, np.int32)), pa.array(keys), pa.array(np.repeat(some.view(np.int64), len(flips)))],
                        names=["part", "key", "fp"])
    return work


def link_group(fp: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the graph of fingerprints within 4 bits (uint64, distinct)."""
    edges = []
    if len(fp) <= 96:
        near = np.bitwise_count(fp[:, None] ^ fp[None, :]) <= DISTANCE
        if near.sum() == len(fp):
            return edges
        rest = list(range(len(fp)))
    else:
        near = None
        rest = None
    todo = np.arange(len(fp))
    while len(todo):
        queue, todo = [todo[0]], todo[1:]
        while queue and len(todo):
            at = queue.pop()
            hit = near[at, todo] if rest is not None else np.bitwise_count(fp[todo] ^ fp[at]) <= DISTANCE
            found = todo[hit]
            if len(found):
                edges += [(int(fp[at]), int(fp[x])) for x in found]
                queue += found.tolist()
                todo = todo[~hit]
    return edges


def _linked(batches):
    """Rows come sorted by group; a group holds at most 2 * BLOCK fingerprints."""
    def finish(pieces):
        values = np.unique(np.concatenate(pieces).view(np.uint64))
        return link_group(values) if len(values) > 1 else []

    def rows(edges):
        values = np.array(edges, np.uint64).reshape(-1, 2).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(values[:, 0].copy()), pa.array(values[:, 1].copy())], names=["a", "b"])

    last, pieces, edges = None, [], []
    for batch in batches:
        if not batch.num_rows:
            continue
        table = np.stack([batch.column(i).to_numpy().astype(np.int64) for i in range(4)], axis=1)
        fp = batch.column(4).to_numpy()
        cuts = np.flatnonzero((table[1:] != table[:-1]).any(axis=1)) + 1
        for a, b in zip([0, *cuts], [*cuts, len(fp)]):
            name = tuple(table[a])
            if name != last:
                if pieces:
                    edges += finish(pieces)
                last, pieces = name, []
            pieces.append(fp[a:b])
        if len(edges) > 50_000:
            yield rows(edges)
            edges = []
    if pieces:
        edges += finish(pieces)
    yield rows(edges)


def near_edges(prints: DataFrame, block: int | None = None) -> DataFrame:
    """Edges (a, b) that connect all distinct fingerprints `fp` within 4 bits of each other."""
    block = block or BLOCK
    n, ones, both = bit_moments(prints)
    spark: SparkSession = prints.sparkSession
    if n < 2:
        return spark.createDataFrame([], "a long, b long")
    order = prints.select("fp", F.xxhash64("fp").alias("h")).orderBy("h").limit(SAMPLE)
    sample = np.array([r["fp"] for r in order.collect()], np.int64).view(np.uint64)
    plan = choose_plan(n, ones, both, sample)
    filed = prints.select("fp").mapInArrow(_filed(plan), "part int, key long, fp long")
    counts = filed.groupBy("part", "key").agg(F.count("*").alias("c"))
    rows = filed.join(counts.where("c > 1"), ["part", "key"])
    # A value with more than `block` members: each of them goes to the tasks of its block with every other.
    blocks = F.ceil(F.col("c") / block)
    own = F.pmod(F.xxhash64("fp"), blocks)
    meets = F.when(F.col("c") <= block, F.array(F.struct(F.lit(0).cast("long").alias("i"), F.lit(0).cast("long").alias("j")))).otherwise(
        F.transform(F.sequence(F.lit(0).cast("long"), blocks - 1), lambda o: F.struct(F.least(o, own).alias("i"), F.greatest(o, own).alias("j"))))
    met = rows.select("part", "key", "fp", F.explode(meets).alias("m")).select("part", "key", "m.i", "m.j", "fp")
    names = ["part", "key", "i", "j"]
    flips = sum(len(f) for _, f in plan)
    dealt = met.repartition(partitions_for(spark, n * flips, 1_000_000), *names).sortWithinPartitions(*names)
    return dealt.mapInArrow(_linked, "a long, b long")


def components(prints: DataFrame) -> DataFrame:
    """(fp, root) of every distinct fingerprint: root is the smallest one of its component."""
    found = connected(near_edges(prints))
    return prints.select("fp").join(found.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: its fingerprint in hex and the smallest id of its component."""
    marked = stored(fingerprints(documents, text_col, (id_col,)), "fingerprints")
    distinct = stored(marked.groupBy("fp").agg(F.min(id_col).alias("first")), "distinct")
    roots = components(distinct).join(distinct, "fp")
    names = roots.groupBy("root").agg(F.min("first").alias("component_id"))
    by_print = roots.select("fp", "root").join(names, "root").select("fp", "component_id")
    return marked.join(by_print, "fp").select(id_col, F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`documents` with one row of each component: the smallest id (null last), then the smallest text hash."""
    marked = nested(documents, *row_keys(id_col, text_col), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    prints = stored(fingerprints(marked, "text", ("id", "k1", "k2")), "fingerprints")
    first = F.min(F.struct(F.col("id").isNull().alias("no"), "id", "k1", "k2")).alias("first")
    distinct = stored(prints.groupBy("fp").agg(first), "distinct")
    roots = components(distinct).join(distinct, "fp")
    best = roots.groupBy("root").agg(F.min("first").alias("first")).select("first.k1", "first.k2")
    kept = marked.select("row", "k1", "k2").join(best, ["k1", "k2"], "left_semi")
    # Repeated rows agree in both keys: one of them stays.
    return kept.dropDuplicates(["k1", "k2"]).select(*unnested(documents.schema))
