"""Fingerprints and their classes against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash
from llm_data import ODD, documents, none, odd, prose

from tidegauge.llm import registry, simhash

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fingerprint(text, n=3):
    words = WORD.findall((text or "").translate(LOWER))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + n]).encode(), 42) for i in range(max(1, len(words) - n + 1))] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(rows):
    """(id, fingerprint, smallest id) of rows of (id, fingerprint), by comparing all pairs."""
    fps = np.array([f for _, f in rows], np.uint64)
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in np.flatnonzero(np.bitwise_count(fps[:i] ^ fps[i]) <= 3):
            root[find(i)] = find(int(j))
    low = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            low[find(i)] = min(low.get(find(i), key), key)
    return sorted(((key, f"{f:016x}", low.get(find(i))) for i, (key, f) in enumerate(rows)), key=str)


def found(df):
    out = df.select("id", simhash.hexadecimal(df.fp).alias("fp"), "class").collect()
    return sorted((tuple(r) for r in out), key=str)


def test_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = sorted((tuple(r) for r in registry.QUERIES["op11_pigeonring_simhash"](spark, SF).collect()), key=str)
    want = classes([(r.doc_id, fingerprint(r.text)) for r in rows])
    assert got == want
    assert len({w[2] for w in want}) < len(want)


def test_odd_rows(spark):
    more = [(None, "lost"), (None, prose(5, 30)), (10, prose(5, 30)), (3, "A  b\tC\nd"), (4, "a b c d"), (None, " ")]
    rows = ODD + more
    assert found(simhash.near_duplicates(documents(spark, rows))) == classes([(i, fingerprint(t)) for i, t in rows])
    assert found(simhash.near_duplicates(none(spark))) == []
    assert found(simhash.near_duplicates(odd(spark), n=1)) == classes([(i, fingerprint(t, 1)) for i, t in ODD])


def test_hashes_are_those_of_spark(spark):
    text = "Some Words of Three"
    want = fingerprint(text)
    row = spark.sql("SELECT xxhash64('some words of') a, xxhash64('words of three') b").first()
    assert want == (row.a % 2**64) & (row.b % 2**64)


def dense(seed):
    """Fingerprints of which many differ in a few bits."""
    rng = random.Random(seed)
    out = {rng.getrandbits(64) for _ in range(200)}
    for kind in range(4):
        base = rng.getrandbits(64)
        span = rng.sample(range(64), 22) if kind % 2 else list(range(rng.randrange(46), 64))[:18]
        for _ in range(400):
            value = base
            for b in rng.sample(span, rng.randrange(0, 9)):
                value ^= 1 << b
            out.add(value)
    return sorted(out)


@pytest.mark.parametrize("cell", [simhash.CELL, 30])
def test_crowded_cells_lose_no_link(spark, cell):
    values = dense(cell)
    nodes = spark.createDataFrame([(int(np.uint64(v).astype(np.int64)),) for v in values], "fp long")
    root = {v: v for v in values}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in simhash.links(nodes, cell).collect():
        a, b = a % 2**64, b % 2**64
        assert (a ^ b).bit_count() <= 3
        low, high = sorted((find(a), find(b)))
        root[high] = low
    first = {}
    for i, v in enumerate(values):
        first.setdefault(find(v), i)
    assert sorted(((i, f"{v:016x}", first[find(v)]) for i, v in enumerate(values)), key=str) == classes(list(enumerate(values)))


def test_looking_up_neighbours_finds_what_comparing_does():
    rng = np.random.default_rng(4)
    free = np.array([18, 33, 40, *range(48, 64)], np.uint64)  # what nodes of a cut cell may differ in
    for must in (np.uint64(0), np.uint64(1 << 18)):
        chosen = np.unique(rng.integers(0, 1 << len(free), 3000))
        ring = np.zeros(len(chosen), np.uint64)
        for i, b in enumerate(free):
            ring |= ((chosen >> i) & 1).astype(np.uint64) << b
        edges = simhash._looked_up(ring, [int(b) for b in free], must)
        x = ring[:, None] ^ ring[None, :]
        linked = (np.bitwise_count(x) <= 3) & (np.bitwise_count(x & np.uint64((1 << 48) - 1)) <= 2) & ((must == 0) | ((x & must) != 0))
        assert all(linked[a, b] for a, b in edges)
        label = np.arange(len(ring))
        while True:
            lower = np.minimum(label, np.where(linked, label[None, :], len(ring)).min(axis=1))
            if (lower == label).all():
                break
            label = lower
        assert len(edges) == len(ring) - len(np.unique(label))
