"""The trie against one built turn by turn, and contraction on trees of any shape."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from beaconry.llm import prefix_trie
from beaconry.llm.prefix_trie import end_digests, scanned, subtree_totals, trie

NAMES = "conv_id long, turn long, role string, text string"


def by_hand(rows):
    turns = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            turns.setdefault(conv, []).append((turn, role or "", text or ""))
    for own in turns.values():
        own.sort(key=lambda t: (t[0] is not None, t[0] or 0, hashlib.md5(f"{len(t[1])}:{t[1]}{t[2]}".encode()).hexdigest()))
    rebuilt = {}
    for conv, own in turns.items():
        h = zlib.crc32(str(conv).encode()) % 4
        base = conv - (abs(conv) % 20) * (1 if conv >= 0 else -1)
        rebuilt[conv] = tuple(t[1:] for t in turns.get(base, [])[:h]) + tuple(t[1:] for t in own[h:])
    members = {}
    for conv, seq in rebuilt.items():
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append(conv)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children.get(node, [])
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        leaves[node] = sum(leaves[c] for c in below) if below else 1
        saved[node] = (len(members[node]) - 1) * words + sum(saved[c] for c in below)
    return sorted(((min(m), len(n), min(members[n[:-1]]) if n else None, len(m), len(children.get(n, [])), leaves[n], saved[n],
                    hashlib.sha256(",".join(str(c) for c in sorted(m) if len(rebuilt[c]) == len(n)).encode()).hexdigest())
                   for n, m in members.items()), key=repr)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_defined_cases(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice([0, 0, 20, 20, 21, 22, 35, 40, 41, -3, -7, 1000, None]), rnd.choice([None, 0, 1, 2, 3]),
             rnd.choice(["u", None, ""]), rnd.choice(["a", "a b", None, "", "é\n x"])) for _ in range(150)]
    rows += [(60, i, "u", "x y") for i in range(40)] + [(61, i, "u", "x y") for i in range(35)]   # chains
    rows += [(i, 0, "u", "q") for i in range(200, 260)]   # one common turn
    rows += [(c, 0, "u", "alone") for c in range(301, 312)]   # absent base: some lose their only turn
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], NAMES + ", a string, position int").repartition(5)
    assert found(trie(docs)) == by_hand(rows)


def test_empty_tables_and_nothing_but_null_ids(spark):
    assert trie(spark.createDataFrame([], NAMES)).count() == 0
    assert trie(spark.createDataFrame([(None, 1, "u", "x")], NAMES)).count() == 0


def test_one_conversation_over_all_tasks(spark, monkeypatch):
    """Groups that go on in the next tasks get what lies behind them."""
    monkeypatch.setattr(prefix_trie, "ROWS_EACH", 40)
    rnd = random.Random(4)
    rows = [(rnd.choice([1, 7, 7, 7, 7, 9]), i, rnd.getrandbits(63) - 2**62) for i in range(1000)]
    df = spark.createDataFrame(rows, "g long, i long, x long")
    got = found(scanned(df, "g", [F.col("i")], ["x"], "scan-test").select("g", "i", "number", "x_sum"))
    want, seen = [], {}
    for g, i, x in rows:
        n, total = seen.get(g, (0, 0))
        seen[g] = (n + 1, total ^ x)
        want.append((g, i, *seen[g]))
    assert got == sorted(want, key=repr)


@pytest.mark.parametrize("shape", ["chain", "star", "caterpillar", "random", "single"])
def test_contraction(spark, shape):
    rnd = random.Random(shape)
    n = 1 if shape == "single" else 120
    parent = {i: {"chain": i - 1, "star": 0, "caterpillar": i - 1 if i % 2 else max(i - 2, 0), "random": rnd.randrange(i)}.get(shape, 0)
              for i in range(1, n)}
    own = [rnd.randrange(9) for _ in range(n)]
    kids = {}
    for c, p in parent.items():
        kids.setdefault(p, []).append(c)
    leaves, saved = {}, {}
    for i in reversed(range(n)):
        leaves[i] = sum(leaves[c] for c in kids.get(i, [])) or 1
        saved[i] = own[i] + sum(saved[c] for c in kids.get(i, []))
    name = lambda i: (0, 0) if i == 0 else (i, 7)
    rows = [(*name(i), *(name(parent[i]) if i else (None, None)), own[i], len(kids.get(i, []))) for i in range(n)]
    nodes = spark.createDataFrame(rows, "a long, b long, pa long, pb long, saved long, children long")
    got = found(subtree_totals(nodes).select("a", "b", "leaves", "saved"))
    assert got == sorted(((*name(i), leaves[i], saved[i]) for i in range(n)), key=repr)


def test_digest_streams_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "IDS_IN_BLOCK", 7)
    monkeypatch.setattr(prefix_trie, "ROWS_EACH", 50)
    ids = {(1, 1): list(range(-20, 300)), (1, 2): [5], (0, 0): list(range(1000, 1090))}
    rows = [(a, b, c) for (a, b), cs in ids.items() for c in cs]
    random.Random(1).shuffle(rows)
    got = found(end_digests(spark.createDataFrame(rows, "a long, b long, conv long")))
    assert got == sorted(((a, b, hashlib.sha256(",".join(map(str, cs)).encode()).hexdigest()) for (a, b), cs in ids.items()), key=repr)
