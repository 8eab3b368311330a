import random
from itertools import combinations

import numpy as np
import pytest
import xxhash

from beaconry.llm import simhash_dedup as sh


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\v\f\r":
        low = low.replace(c, " ")
    words = [w for w in low.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(values):
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a, b in combinations(sorted(root), 2):
        if (a ^ b).bit_count() <= 4:
            a, b = sorted((find(a), find(b)))
            root[b] = a
    return {v: find(v) for v in root}


def texts():
    rng = random.Random(3)
    vocabulary = ["the", "on", "É", "Word", "tion\xa0x", "ble", "q"]
    base = [" ".join(rng.choice(vocabulary) + str(rng.randint(0, 50)) for _ in range(90)) for _ in range(12)]
    out = [None, "", " \n\t", "\x85", "one", "ONE", "a b c d", "a b c d e", *base, *base[:3]]
    for text in base:
        for _ in range(6):
            words = text.split(" ")
            for _ in range(rng.randint(1, 3)):
                words[rng.randrange(len(words))] = "edit"
            out.append("\n".join(words))
    return out


def test_fingerprint():
    for text in texts():
        assert sh.fingerprint(text) == plain_fingerprint(text)


def test_documents(spark):
    rows = [(i if i else None, t, "x") for i, t in enumerate(texts())] + [(5, "one", "x"), (5, "other", "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string")
    got = sh.near_duplicates(df)
    prints = [plain_fingerprint(t) for _, t, _ in rows]
    comp = plain_components(prints)
    least = {}
    for (i, _, _), p in zip(rows, prints):
        if i is not None:
            least[comp[p]] = min(i, least.get(comp[p], i))
    want = sorted(((i, f"{p:016x}", least.get(comp[p])) for (i, _, _), p in zip(rows, prints)), key=repr)
    assert sorted(((r[0], r[1], r[2]) for r in got.collect()), key=repr) == want
    assert len(set(comp.values())) < len(set(prints))
    kept = sh.one_of_each(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(least.values())


@pytest.mark.parametrize("block", [8, 4096])
def test_near_edges_lose_no_link(spark, block):
    """Fingerprints around a few centres: every component is found, also when values are cut into blocks."""
    rng = random.Random(block)
    values = {rng.getrandbits(64) for _ in range(60)}
    for centre in list(values)[:6]:
        for _ in range(40):
            values.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 6))))
    signed = np.array(sorted(values), np.uint64).view(np.int64).tolist()
    prints = spark.createDataFrame([(v,) for v in signed], "fp long")
    edges = [(r.a % 2**64, r.b % 2**64) for r in sh.near_edges(prints, block).collect()]
    assert all((a ^ b).bit_count() <= 4 for a, b in edges)
    want, root = plain_components(values), {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a, b in edges:
        root[find(a)] = find(b)
    assert len({find(v) for v in values}) == len(set(want.values()))


def test_allocation_meets_the_budget():
    cost, chosen = sh.allocate([[1.0, 50, 60, 70, 80], [3.0, 4.0, 90, 90, 90], [100.0, 100, 100, 100, 100]])
    assert sum(t + 1 for t in chosen) == 5 and cost == min(60 + 4.0, 50 + 90 + 0.0, 70 + 3.0, 80.0)


def test_empty(spark):
    assert sh.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    assert sh.one_of_each(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_one_group(spark):
    df = spark.createDataFrame([(k, "same text of six words here") for k in range(50)], "doc_id long, text string")
    assert {r.component_id for r in sh.near_duplicates(df).collect()} == {0}
