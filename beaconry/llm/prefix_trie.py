"""Prefix trie of conversations, its subtree totals by parallel tree contraction.

1. Turns are numbered within their conversation and, once conversations are rebuilt, every row gets
   the key of the prefix that ends in it: the exclusive or of 128-bit hashes of (position, role, text)
   over all rows so far. Both are scans over one range-partitioned sort: tasks scan their own rows, and
   one carry per task (its last group and that group's total) is added to the group that goes on in
   the next one. So a single conversation may hold any share of the rows.
2. Rows with the same key are members of the same node; map-side aggregation makes the nodes.
3. Contraction, in rounds of keyed messages that are joined per node by one aggregation each. Rake:
   every leaf gives its totals to its parent and is done. Compress: of the nodes that have one child
   left, those whose random rank lies below that of their parent and child are cut out; the parent
   takes their totals and the child. A node of the first kind is finished, one of the second kind
   remembers its own totals and its child. The tree shrinks by a constant factor a round (in
   expectation), however deep or wide it is.
4. Expansion, rounds in reverse: total of a cut-out node = what it held + total of its child.

The digest of the conversations that end in a node needs their ids in order: they are sorted by range,
joined to blocks of text within each task, and the blocks of a node are hashed as a stream.

Defined cases: turns in order, null first; rows of one turn by the MD5 of role and text; a repeated row
is another turn; null role or text is empty; rows without a conversation id belong to none and are left out; a
rebuilt conversation without turns is a member of the root alone; ids are read as 64-bit integers, and
`c - c % 20` has the sign rule of SQL; only the four columns are read, so others may have any name; very
long texts are hashed and counted once and not moved; an empty table has no node, not even a root.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_map, partitions_for, stored

WORD = r"[^\x20\x09-\x0D]+"
#: Conversations share the opening turns of the one whose id is the next lower multiple of this.
FAMILY = 20
#: A rebuilt conversation takes fewer than this many turns from it.
OPENINGS = 4
ROWS_EACH = 1_000_000
#: Turns of a conversation that meet its facts in one task.
BLOCK = 100_000
#: Ids in one block of text.
IDS_IN_BLOCK = 4096


# Scans ---------------------------------------------------------------------------------------------

def _local_scan(group: str, lanes: list[str]):
    """Per task, over sorted rows: `task`, row number and running exclusive ors within `group`, and
    `last_row`, true on the task's last row."""
    def work(batches):
        task = TaskContext.get().partitionId()
        held, before, count, running = None, None, 0, [np.int64(0)] * len(lanes)
        for batch in batches:
            if not batch.num_rows:
                continue
            if held is not None:
                yield held
            g = batch.column(batch.schema.get_field_index(group)).to_numpy()
            rows = np.arange(len(g))
            new = np.concatenate([[before is None or g[0] != before], g[1:] != g[:-1]])
            start = np.maximum.accumulate(np.where(new, rows, -1))
            number = np.where(start >= 0, rows - start + 1, rows + 1 + count)
            columns = []
            for i, lane in enumerate(lanes):
                total = np.bitwise_xor.accumulate(batch.column(batch.schema.get_field_index(lane)).to_numpy())
                front = np.concatenate([[0], total])[np.maximum(start, 0)]
                columns.append(np.where(start >= 0, total ^ front, total ^ running[i]))
                running[i] = columns[-1][-1]
            before, count = g[-1], int(number[-1])
            last = np.zeros(len(g), bool)
            held = pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(len(g), task, np.int64)), pa.array(number.astype(np.int64)),
                 *[pa.array(c) for c in columns], pa.array(last)],
                names=[*batch.schema.names, "task", "number", *[f"{lane}_sum" for lane in lanes], "last_row"])
        if held is not None:
            last = np.zeros(held.num_rows, bool)
            last[-1] = True
            yield pa.RecordBatch.from_arrays([*held.columns[:-1], pa.array(last)], names=held.schema.names)

    return work


def _carries(lanes: int):
    """From each task's last row, in task order: what the next task's first group has behind it."""
    def work(batches):
        previous = None   # group, count, lanes behind the task before
        for batch in batches:
            out = []
            for task, group, count, *sums in zip(*[c.to_pylist() for c in batch.columns]):
                if previous is not None:
                    out.append((task, *previous))
                    if previous[0] == group:
                        count += previous[1]
                        sums = [a ^ b for a, b in zip(sums, previous[2:])]
                previous = (group, count, *sums)
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64()) for i in range(3 + lanes)],
                                             names=["task", "carry_group", "carry_number", *[f"carry_{i}" for i in range(lanes)]])

    return work


def scanned(df: DataFrame, group: str, order: list[Column], lanes: list[str], label: str) -> DataFrame:
    """`df` with `number` (position within `group`, from 1) and, for each lane, `<lane>_sum`, the exclusive
    or over the rows of the group up to this one. `group` has no nulls; `order` is unique within it.

    The carries are one row a task, so their number is that of the partitions: they are put in order by
    one task and broadcast."""
    spark = df.sparkSession
    tasks = partitions_for(spark, df.count(), ROWS_EACH)
    added = [T.StructField("task", T.LongType()), T.StructField("number", T.LongType()),
             *[T.StructField(f"{lane}_sum", T.LongType()) for lane in lanes], T.StructField("last_row", T.BooleanType())]
    placed = df.repartitionByRange(tasks, F.col(group), *order).sortWithinPartitions(F.col(group), *order)
    local = stored(placed.mapInArrow(_local_scan(group, lanes), T.StructType([*df.schema.fields, *added])), label)
    ends = local.where("last_row").select("task", group, "number", *[f"{lane}_sum" for lane in lanes])
    schema = "task long, carry_group long, carry_number long" + "".join(f", carry_{i} long" for i in range(len(lanes)))
    carries = ends.repartition(1).sortWithinPartitions("task").mapInArrow(_carries(len(lanes)), schema)
    rows = local.join(F.broadcast(carries.withColumnRenamed("task", "carry_task")),
                      (F.col("task") == F.col("carry_task")) & (F.col(group) == F.col("carry_group")), "left")
    sums = [F.col(f"{lane}_sum").bitwiseXOR(F.coalesce(F.col(f"carry_{i}"), F.lit(0))).alias(f"{lane}_sum") for i, lane in enumerate(lanes)]
    return rows.select(*df.columns, (F.col("number") + F.coalesce(F.col("carry_number"), F.lit(0))).alias("number"), *sums)


# Conversations -------------------------------------------------------------------------------------

def _openings(conv: str) -> Column:
    return F.crc32(F.col(conv).cast("string").cast("binary")) % OPENINGS


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """conv, number, turn_key (MD5 of role and text), words: the turns of every conversation in order."""
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    turns = conversations.select(F.col("conv_id").cast("long").alias("conv"), "turn", role.alias("role"), text.alias("text"))
    turns = turns.where("conv is not null").select(
        "conv", "turn", F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"))).alias("turn_key"),
        F.regexp_count("text", F.lit(WORD)).cast("long").alias("words"))
    turns = stored(turns, "turns").withColumn("copy", F.monotonically_increasing_id())   # of a stored table: the same in a retry
    return scanned(turns, "conv", [F.col("turn"), F.col("turn_key"), F.col("copy")], [], "numbered").select("conv", "number", "turn_key", "words")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(facts, rows): conv and length of every rebuilt conversation; conv, position, turn_key, words, length of its turns."""
    own = turns.groupBy("conv").agg(F.max("number").alias("n"))
    own = own.select("conv", "n", _openings("conv").alias("h"), (F.col("conv") - F.col("conv") % FAMILY).alias("base"))
    bases = own.where("conv = base").select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    facts = own.join(bases, "base", "left").withColumn("taken", F.least("h", F.coalesce("base_n", F.lit(0))))
    facts = stored(facts.select("conv", "base", "n", "h", "taken", (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")),
                   "facts")
    # A long conversation meets its facts block by block, so that none of them is one task's work.
    blocks = facts.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"n div {BLOCK}"))))
    rest = turns.where(F.col("number") > _openings("conv")).withColumn("block", F.expr(f"number div {BLOCK}")).join(blocks, ["conv", "block"])
    rest = rest.select("conv", (F.col("number") - F.col("h") + F.col("taken")).alias("position"), "turn_key", "words", "length")
    opening = turns.where((F.col("conv") % FAMILY == 0) & (F.col("number") < OPENINGS))
    opening = opening.select(F.col("conv").alias("base"), F.col("number").alias("position"), "turn_key", "words")
    opening = facts.where("taken > 0").join(opening, "base").where("position <= taken").select("conv", "position", "turn_key", "words", "length")
    return facts, rest.unionByName(opening)


def prefixes(rows: DataFrame) -> DataFrame:
    """conv, position, words, length, node (a, b) of every rebuilt turn and its parent (pa, pb); the root is (0, 0)."""
    lanes = stored(rows.select("conv", "position", "words", "length", F.xxhash64("position", "turn_key").alias("x"),
                               F.xxhash64(F.lit(1), "turn_key", "position").alias("y")), "rebuilt")
    found = scanned(lanes, "conv", [F.col("position")], ["x", "y"], "prefixes")
    return found.select("conv", "position", "words", "length", F.col("x_sum").alias("a"), F.col("y_sum").alias("b"),
                        F.col("x_sum").bitwiseXOR(F.col("x")).alias("pa"), F.col("y_sum").bitwiseXOR(F.col("y")).alias("pb"))


# Contraction ---------------------------------------------------------------------------------------

def _message(*columns: tuple[str, Column | int | None]) -> Column:
    names = ("a", "b", "pa", "pb", "leaves", "saved", "children", "ca", "cb")
    given = dict(columns)
    return F.struct(*[(F.lit(0) if n in ("leaves", "saved", "children") and n not in given else
                       given[n] if isinstance(given.get(n), Column) else F.lit(given.get(n))).cast("long").alias(n) for n in names])


def _met(df: DataFrame, messages: Column) -> DataFrame:
    """One row per node from the messages (null: none) that the rows of `df` send."""
    sent = df.select(F.explode(F.filter(messages, lambda m: m.isNotNull())).alias("m")).select("m.*")
    return sent.groupBy("a", "b").agg(
        F.max("pa").alias("pa"), F.max("pb").alias("pb"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"),
        F.sum("children").alias("children"), F.max("ca").alias("ca"), F.max("cb").alias("cb"))


def _own(*names: str) -> list[tuple[str, Column]]:
    return [(n, F.col(n)) for n in names]


def subtree_totals(nodes: DataFrame) -> DataFrame:
    """a, b, leaves, saved over the subtree of each row of `nodes` (a, b, pa, pb, own `saved`, number of `children`).

    The root is (0, 0), its parent null. A childless node counts as one leaf."""
    spark = nodes.sparkSession
    to_parent = [("a", F.col("pa")), ("b", F.col("pb"))]
    leaf, root = F.col("children") == 0, (F.col("a") == 0) & (F.col("b") == 0)
    alive = nodes.select("a", "b", "pa", "pb", leaf.cast("long").alias("leaves"), "saved", "children")
    done, cut, turn = [], [], 0
    while True:
        alive = stored(alive, "alive")
        done.append(alive.where(leaf).select("a", "b", "leaves", "saved"))
        if alive.where(~leaf).isEmpty():
            break
        held = _met(alive, F.array(
            F.when(~leaf, _message(*_own("a", "b", "pa", "pb", "leaves", "saved"))),
            F.when(~root & ~leaf, _message(*to_parent, ("children", 1), ("ca", F.col("a")), ("cb", F.col("b")))),
            F.when(~root & leaf, _message(*to_parent, *_own("leaves", "saved")))))
        rank = F.xxhash64("a", "b", F.lit(turn))
        between = (rank < F.xxhash64("ca", "cb", F.lit(turn))) & ((rank < F.xxhash64("pa", "pb", F.lit(turn))) | ((F.col("pa") == 0) & (F.col("pb") == 0)))
        held = stored(held.withColumn("out", ~root & (F.col("children") == 1) & between), "raked")
        cut.append(held.where("out").select("a", "b", "ca", "cb", "leaves", "saved"))
        # The new parent of a child travels in (ca, cb): in this half of a round they are free.
        met = _met(held, F.array(
            F.when(~F.col("out"), _message(*_own("a", "b", "pa", "pb", "leaves", "saved", "children"))),
            F.when(F.col("out"), _message(*to_parent, *_own("leaves", "saved"))),
            F.when(F.col("out"), _message(("a", F.col("ca")), ("b", F.col("cb")), ("ca", F.col("pa")), ("cb", F.col("pb"))))))
        alive = met.select("a", "b", F.coalesce("ca", "pa").alias("pa"), F.coalesce("cb", "pb").alias("pb"), "leaves", "saved", "children")
        turn += 1
    known = done.pop()
    for raked, spliced in zip(reversed(done), reversed(cut)):
        child = known.select(F.col("a").alias("ca"), F.col("b").alias("cb"), F.col("leaves").alias("l"), F.col("saved").alias("s"))
        grown = spliced.join(child, ["ca", "cb"]).select("a", "b", (F.col("leaves") + F.col("l")).alias("leaves"), (F.col("saved") + F.col("s")).alias("saved"))
        known = stored(known.unionByName(raked).unionByName(grown), "totals")
    return known


# Digest of ends ------------------------------------------------------------------------------------

def _id_blocks(batches):
    """Sorted (a, b, conv) to blocks of decimal ids: a, b, first id, text."""
    node, first, ids = None, 0, []

    def block():
        return node[0], node[1], first, ",".join(map(str, ids))

    for batch in batches:
        out = []
        for a, b, conv in zip(*[c.to_pylist() for c in batch.columns]):
            if (a, b) != node or len(ids) >= IDS_IN_BLOCK:
                if ids:
                    out.append(block())
                node, first, ids = (a, b), conv, []
            ids.append(conv)
        yield _rows(out, _BLOCK_FIELDS)
    if ids:
        yield _rows([block()], _BLOCK_FIELDS)


def _hashed_blocks(batches):
    """Sorted blocks to a, b, ends_sha256: the blocks of a node go through one digest as a stream."""
    node, digest = None, None
    for batch in batches:
        out = []
        for a, b, _, text in zip(*[c.to_pylist() for c in batch.columns]):
            if (a, b) != node:
                if digest:
                    out.append((*node, digest.hexdigest()))
                node, digest = (a, b), hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(text.encode())
        yield _rows(out, _DIGEST_FIELDS)
    if digest:
        yield _rows([(*node, digest.hexdigest())], _DIGEST_FIELDS)


_BLOCK_FIELDS = [("a", pa.int64()), ("b", pa.int64()), ("first", pa.int64()), ("ids", pa.string())]
_DIGEST_FIELDS = [("a", pa.int64()), ("b", pa.int64()), ("ends_sha256", pa.string())]


def _rows(rows: list[tuple], fields) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, (_, kind) in enumerate(fields)], names=[n for n, _ in fields])


def end_digests(ends: DataFrame) -> DataFrame:
    """a, b, ends_sha256 from (a, b, conv): SHA-256 of the ids of each node, ascending, joined by commas.

    One digest is one chain by its nature, but what a task holds at a time are a few blocks."""
    ends = stored(ends, "ends")
    tasks = partitions_for(ends.sparkSession, ends.count(), ROWS_EACH)
    placed = ends.repartitionByRange(tasks, "a", "b", "conv").sortWithinPartitions("a", "b", "conv")
    blocks = arrow_map(placed, _id_blocks, "a long, b long, first long, ids string")
    return arrow_map(blocks.repartition(tasks, "a", "b").sortWithinPartitions("a", "b", "first"), _hashed_blocks,
                     "a long, b long, ends_sha256 string")


# The operator --------------------------------------------------------------------------------------

def trie(conversations: DataFrame) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    facts, rows = rebuilt(stored(numbered_turns(conversations), "ordered"))
    members = stored(prefixes(rows), "members")
    inner = members.groupBy("a", "b").agg(F.max("position").alias("depth"), F.min("conv").alias("conv"), F.count("*").alias("n_convs"),
                                          F.max("words").alias("words"), F.max("pa").alias("pa"), F.max("pb").alias("pb"))
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    root = facts.agg(F.min("conv").alias("conv"), F.count("*").alias("n_convs")).where("n_convs > 0").select(
        zero.alias("a"), zero.alias("b"), zero.alias("depth"), "conv", "n_convs", zero.alias("words"), none.alias("pa"), none.alias("pb"))
    plain = stored(inner.unionByName(root), "nodes")
    counts = plain.groupBy(F.col("pa").alias("a"), F.col("pb").alias("b")).agg(F.count("*").alias("children"))
    nodes = plain.join(counts, ["a", "b"], "left").withColumn("children", F.coalesce("children", F.lit(0).cast("long")))
    nodes = stored(nodes.withColumn("saved", (F.col("n_convs") - 1) * F.col("words")), "counted")
    totals = subtree_totals(nodes).select("a", "b", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"))
    ends = members.where("position = length").select("a", "b", "conv").unionByName(
        facts.where("length = 0").select(zero.alias("a"), zero.alias("b"), "conv"))
    parents = nodes.select(F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv").alias("parent_conv_id"))
    found = nodes.join(totals, ["a", "b"]).join(end_digests(ends), ["a", "b"], "left").join(parents, ["pa", "pb"], "left")
    return found.select(F.col("conv").alias("conv_id"), F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs",
                        F.col("children").alias("n_children"), "n_leaves", "saved_tokens",
                        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))


def trie_sql(table: str = "conversations") -> str:
    """DuckDB SQL of `trie`: prefixes as texts, subtree totals by the ancestors of every node's smallest member."""
    crc_table = "list_transform(range(256), lambda x: list_reduce(list_prepend(x, range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))"
    crc = (f"xor(list_reduce(list_prepend(4294967295, list_transform(string_split(c::VARCHAR, ''), lambda d: ord(d)::BIGINT)), "
           f"lambda s, d: xor(s >> 8, codes[(xor(s, d) & 255) + 1])), 4294967295)")
    return f"""
WITH t AS (
  SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM {table} WHERE conv_id IS NOT NULL),
keyed AS (
  SELECT c, turn, md5(length(role)::VARCHAR || ':' || role || text) AS k,
         len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'))::BIGINT AS words FROM t),
own AS (SELECT c, k, words, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, k) AS i FROM keyed),
counted AS (SELECT c, count(*) AS n, c - c % {FAMILY} AS base FROM own GROUP BY c),
codes AS (SELECT {crc_table} AS codes),
hashed AS (SELECT counted.*, {crc} % {OPENINGS} AS h FROM counted, codes),
facts AS (
  SELECT x.c, x.n, x.h, x.base, least(x.h, coalesce(y.n, 0)) AS taken, least(x.h, coalesce(y.n, 0)) + greatest(x.n - x.h, 0) AS len
  FROM hashed x LEFT JOIN counted y ON y.c = x.base),
rebuilt AS (
  SELECT f.c, f.len, o.i AS pos, o.k, o.words FROM facts f JOIN own o ON o.c = f.base AND o.i <= f.taken
  UNION ALL
  SELECT f.c, f.len, o.i - f.h + f.taken, o.k, o.words FROM facts f JOIN own o ON o.c = f.c AND o.i > f.h),
members AS (
  SELECT c, len, pos, words, string_agg(k, '') OVER (PARTITION BY c ORDER BY pos) AS node FROM rebuilt
  UNION ALL SELECT c, len, 0, 0, '' FROM facts),
nodes AS (
  SELECT node, pos AS depth, min(c) AS conv, count(*) AS n_convs, (count(*) - 1) * max(words) AS saved,
         coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE pos = len), '') AS ends
  FROM members GROUP BY node, pos),
linked AS (SELECT *, CASE WHEN depth > 0 THEN substr(node, 1, 32 * (depth - 1)::INTEGER) END AS parent FROM nodes),
children AS (SELECT parent, count(*) AS n_children FROM linked WHERE parent IS NOT NULL GROUP BY parent),
full_nodes AS (SELECT l.*, coalesce(ch.n_children, 0) AS n_children FROM linked l LEFT JOIN children ch ON ch.parent = l.node),
totals AS (
  SELECT m.node, count(*) FILTER (WHERE f.n_children = 0) AS n_leaves, sum(f.saved)::BIGINT AS saved_tokens
  FROM full_nodes f JOIN members m ON m.c = f.conv AND m.pos <= f.depth GROUP BY m.node)
SELECT f.conv AS conv_id, f.depth, p.conv AS parent_conv_id, f.n_convs, f.n_children, t.n_leaves, t.saved_tokens, sha256(f.ends) AS ends_sha256
FROM full_nodes f JOIN totals t ON t.node = f.node LEFT JOIN nodes p ON p.node = f.parent"""
