"""Ordered operators on keys that hold most rows, against plain loops."""

import random
import re
from collections import defaultdict

import pytest

from tidegauge.operators import catalog, hot

OFFSETS = {"_1": 1, "_12": 12}


def _rows(seed):
    """A series with a third of all rows, ties, exact copies and nulls; and usual ones."""
    rng = random.Random(seed)
    rows = []
    for month in range(1, 10):
        for _ in range(rng.choice([0, 1, 3, 60])):
            value = rng.choice([None, 1.0, 2.0, rng.random()])
            rows += [("hot", month, value)] * rng.choice([1, 1, 2, 30])
    for series in "abcdef":
        rows += [(series, month, rng.random()) for month in range(1, 20) if rng.random() < 0.9]
    rng.shuffle(rows)
    return rows


def _expected(spark, rows):
    tie = {r.v: r.h for r in spark.createDataFrame([(r[2],) for r in rows], "v double").selectExpr("v", "xxhash64(v) h").collect()}
    series = defaultdict(list)
    for key, order, value in rows:
        series[key].append((order, tie[value], value))
    out = []
    for key, points in series.items():
        points.sort(key=lambda p: (p[0], p[1]))
        values = [p[2] for p in points]
        for i, (order, _, value) in enumerate(points):
            out.append((key, order, value, *(values[i - k] if i >= k else None for k in OFFSETS.values())))
    return sorted(out, key=repr)


@pytest.mark.parametrize("hot_rows, slot_rows", [(0, 1), (0, 50), (100, 20), (100, 10**6), (10**9, 1)])
@pytest.mark.parametrize("seed", [1, 2])
def test_lags_are_the_same_on_every_path(spark, seed, hot_rows, slot_rows):
    rows = _rows(seed)
    df = spark.createDataFrame(rows, "key string, month int, value double")
    got = hot.with_lags(df, "key", "month", "value", OFFSETS, hot_rows, slot_rows).collect()
    assert sorted((tuple(r) for r in got), key=repr) == _expected(spark, rows)


@pytest.mark.parametrize("hot_rows, slot_rows", [(0, 1), (100, 20), (10**9, 1)])
def test_stored_parts_give_the_same_lags(spark, hot_rows, slot_rows):
    rows = _rows(5)
    df = spark.createDataFrame(rows, "key string, month int, value double")
    parts = hot.laid_out(df, "key", "month", "value", 12, hot_rows, slot_rows)
    got = hot.lags_of_parts(parts, "key", "month", "value", OFFSETS).drop("part").collect()
    assert sorted((tuple(r) for r in got), key=repr) == _expected(spark, rows)


def test_copies_beyond_one_piece_are_all_written(spark):
    n = 3 * hot.EXPAND + 7
    df = spark.range(n).selectExpr("'a' AS key", "1 AS month", "5.0D AS value")
    got = hot.with_lags(df, "key", "month", "value", OFFSETS, hot_rows=0)
    counts = {(r["_1"], r["_12"]): r["count"] for r in got.groupBy("_1", "_12").count().collect()}
    assert counts == {(None, None): 1, (5.0, None): 11, (5.0, 5.0): n - 12}


def test_no_task_windows_over_a_whole_hot_key(spark):
    df = spark.createDataFrame(_rows(1), "key string, month int, value double")
    lagged = hot.with_lags(df, "key", "month", "value", OFFSETS, 100, 20)
    plan = lagged._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    by_key = [line for line in windows if re.search(r"\], \[key#\d+\], \[", line)]
    assert any("_slot" in line for line in windows)
    # By key alone: the usual series, and the ends of the buckets.
    assert len(by_key) == 2 and any("collect_list(_end" in line for line in by_key)


def test_lags_start_no_job_and_may_be_told_the_sizes(spark):
    rows = _rows(3)
    df = spark.createDataFrame(rows, "key string, month int, value double")
    sizes = spark.createDataFrame(hot.key_sizes(df, "key", "month").collect(), "key string, month int, n long")
    spark.sparkContext.setJobGroup("planning", "no job")
    lagged = hot.with_lags(df, "key", "month", "value", OFFSETS, 100, 20, sizes)
    lagged._jdf.queryExecution().executedPlan()
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("planning")) == 0
    spark.sparkContext.setJobGroup("running", "all others")
    assert sorted((tuple(r) for r in lagged.collect()), key=repr) == _expected(spark, rows)


def test_positions_count_copies_once_each(spark):
    rows = [("t", f"s{i % 37}") for i in range(400)] + [("u", f"s{i}") for i in range(60)] + [("t", "s1")] * 300
    df = spark.createDataFrame(rows, "type string, id string")
    placed = hot.with_positions(df, ["type"], "id").collect()
    for group in "tu":
        spans = sorted((r.start, r.start + r.copies) for r in placed if r.type == group)
        assert spans[0][0] == 0
        assert [r.id for r in sorted((r for r in placed if r.type == group), key=lambda r: r.start)] == sorted({r[1] for r in rows if r[0] == group})
        assert all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
        assert spans[-1][1] == sum(1 for r in rows if r[0] == group)


def test_batches_are_full_and_hold_every_copy(spark):
    rows = [("x", f"s{i}") for i in range(130)] + [("x", "dup")] * 120 + [("y", "only")]
    df = spark.createDataFrame(rows, "series_type string, series_id string")
    lists = catalog.request_lists(catalog.request_batches(df, 50)).collect()
    sizes = {(r.series_type, r.batch): r.n_series for r in lists}
    assert sizes == {("x", 1): 50, ("x", 2): 50, ("x", 3): 50, ("x", 4): 50, ("x", 5): 50, ("y", 1): 1}
    assert sorted(i for r in lists for i in r.series_ids) == sorted(i for _, i in rows)
    assert all(len(r.series_ids) == r.n_series for r in lists)
