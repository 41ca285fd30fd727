"""Codes of vectors against plain loops."""

import math
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest

from tidegauge.llm import part_codes as p

SCHEMA = "vec_id long, embedding array<double>, label int, codes string, error string, vector string, key string, n string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x", "x") for r in rows], SCHEMA)


def plain(rows, entries=16, rounds=6):
    """(id, codes, error) and the codebooks, with loops over all parts and entries."""
    ordered = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    dims = len(rows[0][1])
    width = -(-dims // 8)
    cut = lambda v: [([math.floor(Fraction(x) * 4096) for x in v] + [0] * (8 * width - dims))[k * width : (k + 1) * width] for k in range(8)]
    books = [[cut(v)[k] for _, v, *_ in ordered[:entries]] for k in range(8)]
    distance = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    nearest = lambda part, book: min((distance(part, e), i) for i, e in enumerate(book))
    for _ in range(rounds):
        for k in range(8):
            own = defaultdict(list)
            for _, v, *_ in rows:
                own[nearest(cut(v)[k], books[k])[1]].append(cut(v)[k])
            for e, parts in own.items():
                books[k][e] = [sum(x) // len(parts) for x in zip(*parts, strict=True)]
    found = [(r[0], [nearest(part, books[k]) for k, part in enumerate(cut(r[1]))]) for r in rows]
    return sorted(((i, tuple(e for _, e in f), sum(d for d, _ in f)) for i, f in found), key=str), books


def coded(df, entries=16, rounds=6):
    rows, dims = p.kept(df)
    books = p.fit_codebooks(rows, dims, entries=entries, rounds=rounds)
    return sorted(((r.vec_id, tuple(r.codes), r.error) for r in p.encode(rows, books).collect()), key=str), books


def vectors(seed, n, dims, step):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(9, dims))
    return [(i, (np.round((centres[rng.integers(9)] + 0.2 * rng.normal(size=dims)) / step) * step).tolist(), i % 3) for i in range(n)]


@pytest.mark.parametrize("n, dims, step", [(60, 16, 0.25), (40, 13, 0.001), (9, 8, 0.5), (50, 24, 1.0)])
def test_codes_equal_plain_loops(spark, n, dims, step):
    rows = vectors(n, n, dims, step)
    got, books = coded(frame(spark, rows))
    want, plain_books = plain(rows)
    assert books.entries.tolist() == plain_books
    assert got == want


def test_odd_rows(spark):
    good = vectors(1, 20, 8, 0.1)
    twice = [*good, good[3], (None, good[4][1], None), (5, good[6][1], None), (None, [0.0] * 8, 1)]
    bad = [(50, None, 1), (51, [None] + [1.0] * 7, 1), (52, [float("nan")] * 8, 1), (53, [float("inf")] * 8, 1), (54, [1.0] * 9, 1), (55, [], None)]
    got, books = coded(frame(spark, twice + bad))
    want, plain_books = plain(twice)
    assert books.entries.tolist() == plain_books and got == want


def test_extreme_components_and_empty_vectors(spark):
    got, books = coded(frame(spark, [(1, [1e300] * 8, 1), (2, [-1e300] * 8, 1), (3, [1e-320] * 8, 1)]))
    assert [g[2] for g in got] == [0, 0, 0]
    assert sorted(np.unique(books.entries).tolist()) == [-p.LIMIT, 0, p.LIMIT]
    got, books = coded(frame(spark, [(1, [], 1), (2, [], 1)]))
    assert got == [(1, (0,) * 8, 0), (2, (0,) * 8, 0)]
    assert p.kept(frame(spark, []))[1] is None and p.kept(frame(spark, [(1, None, 1)]))[1] is None


def test_query_on_empty_and_odd_tables(spark, tmp_path):
    kind = "vec_id long, embedding array<float>, label int, code string"
    spark.createDataFrame([], kind).write.parquet(f"{tmp_path}/none/embeddings.parquet")
    empty = p.op12_trie_codes(spark, f"{tmp_path}/none")
    assert empty.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"] and empty.count() == 0
    rows = vectors(7, 30, 8, 0.1)
    spark.createDataFrame([(i, v, None if g == 2 else g, "x") for i, v, g in rows], kind).write.parquet(f"{tmp_path}/some/embeddings.parquet")
    got = p.op12_trie_codes(spark, f"{tmp_path}/some").collect()
    errors = Counter()
    for r in got:
        errors[r.vec_id % 3] += r.error
    assert len(got) == 30 and all(r.label_error == errors[r.vec_id % 3] for r in got)
    assert all(len(r.code) == 16 and int(r.code, 16) >= 0 for r in got)


@pytest.mark.parametrize("nodes", [1, 3, 4096])
def test_walk_takes_the_first_of_the_nearest(nodes):
    rng = np.random.default_rng(nodes)
    for width in (1, 2, 5):
        parts = np.unique(rng.integers(-3, 4, (200, width)), axis=0)
        entries = rng.integers(-3, 4, (7, width))
        found, far = p.walk(parts, entries, nodes)
        all_far = ((parts[:, None] - entries[None]) ** 2).sum(axis=2)
        assert (found == all_far.argmin(axis=1)).all() and (far == all_far.min(axis=1)).all()


def test_decoded_vectors_are_as_far_as_said(spark):
    rows = vectors(3, 40, 12, 1 / 4096)
    got, books = coded(frame(spark, rows))
    by_id = {i: np.array(v) for i, v, _ in rows}
    for i, codes, error in got:
        back = p.decode(np.array([codes]), books)[0]
        assert round(float(((back - by_id[i]) ** 2).sum()) * 4096**2) == error
