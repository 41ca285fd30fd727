"""Nearest neighbours against brute force."""

import numpy as np
from pyspark.sql import functions as F

from tidegauge.llm import forest


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "x", "y") for i, v in rows], "vec_id long, embedding array<float>, ids string, cell string")


def brute(rows, k):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float32).astype(np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    out = {}
    for q in np.flatnonzero(ids % 50 == 0):
        score = (x @ x[q]).round(9)
        others = np.flatnonzero(ids != ids[q])
        out[ids[q]] = [(int(ids[j]), score[j]) for j in others[np.lexsort((ids[others], -score[others]))][:k]]
    return out


def found(df, **how):
    rows = forest.nearest(df, F.col("id") % 50 == 0, **how).orderBy("query_id", "rank").collect()
    out = {}
    for r in rows:
        assert r.rank == len(out.get(r.query_id, [])) + 1
        out.setdefault(r.query_id, []).append((r.id, round(r.score, 9)))
    return out


def test_all_leaves_are_exact(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(300)]
    rows += [(300 + i, rows[7][1]) for i in range(120)]  # many equal vectors
    rows += [(500, rows[7][1]), (550, (np.array(rows[3][1]) * 4).tolist())]
    got = found(vectors(spark, rows), leaves=10**6, trees=3, leaf=16)
    assert got == brute(rows, 5)


def test_recall(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=16).tolist()) for i in range(2000)]
    want, got = brute(rows, 5), found(vectors(spark, rows), trees=20, leaf=16, leaves=200)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits / (5 * len(want)) >= 0.9


def test_leaves_in_blocks(spark):
    """A sample much smaller than the table: leaves hold many vectors, in several blocks."""
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(400)]
    assert found(vectors(spark, rows), trees=2, leaf=8, leaves=10**6, sample=40) == brute(rows, 5)


def test_odd_rows(spark):
    rows = [(0, [1.0, 0.0]), (50, [0.0, 1.0]), (50, [0.0, 1.0]), (3, [1.0, 1e-3]), (None, [1.0, 0.5])]
    odd = [(1, None), (2, []), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]), (7, [None, 1.0]), (8, [1.0, 2.0, 3.0])]
    want = brute([(0, [1.0, 0.0]), (50, [0.0, 1.0]), (3, [1.0, 1e-3])], 5)
    assert found(vectors(spark, rows + odd)) == want
    assert found(vectors(spark, odd[:3])) == {}
    assert found(vectors(spark, [])) == {}
    assert found(vectors(spark, [(0, [1.0, 2.0])])) == {}


def test_extreme_components_have_right_cosines(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(60, 6))
    rows = [(i, (v * 10.0 ** rng.choice([-200, 0, 150])).tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, ids string")
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    got = found(df, trees=3, leaf=8, leaves=10**6)
    for q in (0, 50):
        score = unit @ unit[q]
        best = [j for j in np.argsort(-score) if j != q][:5]
        assert [i for i, _ in got[q]] == best and np.allclose([s for _, s in got[q]], score[best], atol=1e-9)


def test_scaling_changes_no_digit():
    rng = np.random.default_rng(10)
    a, b = rng.normal(size=(2, 500, 9)).astype(np.float32).astype(np.float64)
    dot = lambda x, y: np.einsum("ij,ij->i", x, y)
    assert (forest.cosine(a, b) == dot(a, b) / (np.sqrt(dot(a, a)) * np.sqrt(dot(b, b)))).all()


def test_a_bounded_sample_indexes_all(spark, monkeypatch):
    monkeypatch.setattr(forest, "SAMPLE_BYTES", 8 * 4 * 30)
    rng = np.random.default_rng(11)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(500)]
    assert found(vectors(spark, rows), trees=2, leaf=8, leaves=10**6) == brute(rows, 5)


def test_nothing_is_broadcast_but_the_forest(spark):
    """A query and all its leaves passed for as little as the query, and were sent to the driver for a join."""
    rng = np.random.default_rng(12)
    df = vectors(spark, [(i, rng.normal(size=8).tolist()) for i in range(300)])
    rows = forest.nearest(df, F.col("id") % 50 == 0)
    assert len(rows.collect()) == 30
    assert "Broadcast" not in rows._jdf.queryExecution().executedPlan().toString()


def test_small_groups(spark, monkeypatch):
    """Few vectors and queries meet in a group. Ids have several vectors, and some cosines differ less than single precision tells."""
    monkeypatch.setattr(forest, "MEET_BYTES", 1 << 11)
    rng = np.random.default_rng(13)
    x = rng.normal(size=(300, 6))
    rows = [*enumerate(x)] + [(300 + i, x[50] + 1e-9 * rng.normal(size=6)) for i in range(60) if i]
    rows += [(i, x[i] * 2) for i in range(40, 60)] + [(i, x[-1 - i]) for i in range(0, 160, 10)]
    rows += [(7, (x[100] + 1e-3) * 2.0**j) for j in range(12)]  # one id and score
    df = spark.createDataFrame([(i, v.tolist()) for i, v in rows], "vec_id long, embedding array<double>")
    ids, x, want = np.array([i for i, _ in rows]), np.array([v for _, v in rows]), {}
    for q in set(ids[ids % 50 == 0].tolist()):
        scores = [forest.cosine(np.repeat(v[None], len(x), axis=0), x) for v in x[ids == q]]
        pairs = {(i, s) for score in scores for i, s in zip(ids.tolist(), score.tolist(), strict=True) if i != q}
        want[q] = [(i, round(s, 9)) for i, s in sorted(pairs, key=lambda p: (-p[1], p[0]))[:5]]
    assert found(df, trees=3, leaf=8, leaves=10**6) == want


def test_recall_of_the_query(spark):
    """The registered query with its own settings, on the whole table, against all vectors."""
    path = "/root/testdata/sf0.1"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{path}/embeddings.parquet").collect()]
    want, got = brute(rows, 5), {}
    for r in forest.op7_projection_forest(spark, path).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    assert sum(len(got[q] & {i for i, _ in want[q]}) for q in want) >= 0.9 * 5 * len(want)
