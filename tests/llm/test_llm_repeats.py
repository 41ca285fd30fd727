"""Removal of repeated byte strings, and the interval expansion below it, against brute force."""

import random

import numpy as np
import pytest
from llm_data import ODD, documents, none, odd

from tidegauge.llm import repeats
from tidegauge.llm.bwt import repeated


@pytest.mark.parametrize("letters", [1, 2, 3])
def test_interval_expansion(letters):
    rng = np.random.default_rng(letters)
    for trial in range(60):
        least, m = int(rng.integers(2, 12)), int(rng.integers(1, 12))
        strings = [bytes(rng.integers(0, letters, int(rng.integers(0, 40))).astype(np.uint8) + 97 * (trial % 2)) for _ in range(m)]
        rank, first = rng.permutation(m), {}
        for r in np.argsort(rank):
            for i in range(len(strings[r]) - least + 1):
                first.setdefault(strings[r][i : i + least], (r, i))
        want = [[i for i in range(len(s) - least + 1) if first[s[i : i + least]] != (r, i)] for r, s in enumerate(strings)]
        assert [x.tolist() for x in repeated(strings, rank, least)] == want


def brute(rows, least=100):
    """(id, kept bytes, spans); rows with equal id and text are one document."""
    texts = sorted({(-(2**63) if i is None else i, t or "") for i, t in rows})
    seen, out = set(), {}
    for i, t in texts:
        data, cut = t.encode(), np.zeros(len(t.encode()) + 1, bool)
        for s in range(len(data) - least + 1):
            if data[s : s + least] in seen:
                cut[s : s + least] = True
            else:
                seen.add(data[s : s + least])
        kept = bytes(b for b, c in zip(data, cut, strict=False) if not c)
        out[i, t] = (kept, int((cut[1:] & ~cut[:-1]).sum() + cut[0]))
    return sorted(((i, *out[-(2**63) if i is None else i, t or ""]) for i, t in rows), key=str)


def found(df, **how):
    return sorted(((r.id, bytes(r.kept), len(r.spans)) for r in repeats.remove_repeats(df, **how).collect()), key=str)


def corpus(seed):
    rng = random.Random(seed)
    line = "".join(rng.choice("abcdé ") for _ in range(90))
    passages = ["".join(rng.choice("abcdefgh ü") for _ in range(rng.choice([99, 100, 101, 160, 400]))) for _ in range(6)]
    rows = []
    for i in range(120):
        parts = [rng.choice([line, rng.choice(passages), rng.choice(passages)[rng.randrange(40) :], "xy" * rng.randrange(120)]) for _ in range(4)]
        rows.append((rng.randrange(10**6), "".join(p + "".join(rng.choice("pqrst ") for _ in range(rng.randrange(30))) for p in parts)))
    return rows + rows[:10] + [(rows[3][0] + 1, rows[3][1]), (2, "z" * 5000), (3, "z" * 40_000)]


@pytest.mark.parametrize("how", [{}, {"block": 3000}])
def test_removal_equals_brute_force(spark, how):
    rows = corpus(1)
    assert found(documents(spark, rows), **how) == brute(rows)


def test_crowded_minimisers_are_cut_finer(spark, monkeypatch):
    monkeypatch.setattr(repeats, "CLASSES", ((2, 2), (5, 8)))
    rows = corpus(2)
    assert found(documents(spark, rows).repartition(5)) == brute(rows)


def test_odd_rows(spark):
    assert found(odd(spark)) == brute(ODD)
    assert found(none(spark)) == []


def test_long_texts_are_cut_into_chunks(spark, monkeypatch):
    """Chunks of some 700 bytes instead of a megabyte; parts are folded after 2,000 bytes."""
    monkeypatch.setattr(repeats, "_CHUNK", 700)
    monkeypatch.setattr(repeats, "_FOLD", 2000)
    rows = corpus(3)
    assert found(documents(spark, rows)) == brute(rows)


def test_many_texts_of_one_id_and_of_none(spark):
    rng = random.Random(8)
    passages = ["".join(rng.choice("abcdefgh") for _ in range(130)) for _ in range(40)]
    rows = []
    for k in range(3000):
        text = "".join(rng.choice("klmnopqrst ") for _ in range(140))
        if k % 25 == 0:
            text = text[:70] + rng.choice(passages) + text[70:]
        rows.append(((7, None, -(2**63))[k % 3], text))
    hashes = [r[0] for r in spark.createDataFrame([(t,) for _, t in rows], "t string").selectExpr("xxhash64(t) & 9223372036854775807").collect()]
    order = sorted(range(len(rows)), key=lambda k: (-(2**63) if rows[k][0] is None else rows[k][0], rows[k][0] is not None, -hashes[k] if rows[k][0] is None else hashes[k]))
    seen, removed = set(), {}
    for k in order:
        data, cut = rows[k][1].encode(), set()
        for a in range(len(data) - 99):
            if data[a : a + 100] in seen:
                cut.update(range(a, a + 100))
            seen.add(data[a : a + 100])
        removed[rows[k]] = bytes(b for i, b in enumerate(data) if i not in cut)
    assert 60 < sum(len(removed[r]) < len(r[1]) for r in rows) < 130
    got = repeats.remove_repeats(documents(spark, rows)).selectExpr("id", "string(kept) AS kept").collect()
    assert sorted(((r.id, r.kept) for r in got), key=str) == sorted(((r[0], removed[r].decode()) for r in rows), key=str)


def test_crowded_minimisers_go_through_the_transform(spark, monkeypatch):
    monkeypatch.setattr(repeats, "CLASSES", ((2, 2), (5, 8)))
    rows = corpus(4)
    assert found(documents(spark, rows)) == brute(rows)
