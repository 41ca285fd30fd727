"""Reports and views against plain loops, with copies, ties and missing values."""

import datetime as dt
import itertools
import random
from collections import defaultdict

import pytest

from tidegauge.operators import quality_gold, views
from tidegauge.plans import reports, stages
from tidegauge.schemas import STAGES

FACT = "series_id string, date date, value double, is_annual_avg boolean"
DIM = "series_id string, raw_series_id string, indicator_name string, source string, industry_name string"


def month(i):
    return dt.date(2000 + i // 12, i % 12 + 1, 1)


def dim_of(spark, ids):
    return spark.createDataFrame([(i, f"raw {i}", f"PPI {i}", "BLS", "x") for i in sorted(ids)], DIM)


@pytest.mark.parametrize("seed", range(4))
def test_pairs_are_the_top_of_all_pairs(spark, seed):
    rng = random.Random(seed)
    latest, rows = month(20), []
    for i in range(40):
        value = rng.choice([0.5, 0.5, -0.25, 0.125 * rng.randint(-8, 8), None])
        rows += [(f"s{i:02d}", latest, 1.0, None, value)] * rng.choice([1, 1, 1, 3])
        rows.append((f"s{i:02d}", month(19), 1.0, None, 99.0))
    rows += [("s07", latest, 1.0, None, 0.125 * k) for k in range(-20, 20)]
    changes = spark.createDataFrame(rows, "series_id string, date date, value double, mom_change double, yoy_change double")
    got = reports.cross_indicator_pairs(changes, dim_of(spark, {r[0] for r in rows}), top=10).collect()
    last = [(r[0], r[4]) for r in rows if r[1] == latest and r[4] is not None]
    pairs = [(a, b) for a, b in itertools.product(last, last) if a[0] < b[0]]
    pairs.sort(key=lambda p: (-abs(p[0][1] - p[1][1]), p[0][0], p[1][0]))
    want = [(a[0], b[0], round((a[1] - b[1]) * 100, 2)) for a, b in pairs[:10]]
    assert [abs(r.change_difference) for r in got] == [abs(w[2]) for w in want]
    assert [(r.series1, r.series2) for r in got] == [w[:2] for w in want]


@pytest.mark.parametrize("top", [3, 10, 60])
def test_pairs_without_a_difference_fill_up(spark, top):
    rng = random.Random(top)
    rows = [(f"s{i:02d}", month(5), 1.0, None, rng.choice([None, None, None, 0.25 * i])) for i in range(30) for _ in range(rng.choice([1, 1, 2]))]
    changes = spark.createDataFrame(rows, "series_id string, date date, value double, mom_change double, yoy_change double")
    got = reports.cross_indicator_pairs(changes, dim_of(spark, {r[0] for r in rows}), top=top).collect()
    pairs = [(a, b) for a, b in itertools.product(rows, rows) if a[0] < b[0]]

    def apart(a, b):
        return None if a[4] is None or b[4] is None else abs(a[4] - b[4])

    pairs.sort(key=lambda p: (apart(*p) is None, -(apart(*p) or 0), p[0][0], p[1][0]))
    assert [(r.series1, r.series2) for r in got] == [(a[0], b[0]) for a, b in pairs[:top]]


def test_stage_pressure_weighs_copies_like_a_join(spark):
    rng = random.Random(5)
    members = [s for group in STAGES.values() for s in group]
    latest, rows = month(30), []
    for i, raw in enumerate(members):
        for back in (0, 1, 12, 5):
            if i == 3 and back == 1:
                continue
            copies = rng.choice([1, 1, 2])
            for _ in range(copies):
                value = rng.choice([None, 0.0, *[50.0 + rng.random() * 100] * 6])
                rows.append((raw, month(30 - back), value, False))
    rows.append((members[0], latest, 1e9, True))
    dim = spark.createDataFrame([(r, r, r, "BLS", "x") for r in members], DIM)
    fact = spark.createDataFrame(rows, FACT)
    got = {r.stage: r for r in stages.stage_pressure(fact, dim, stages.stage_map(spark)).collect()}

    def at(raw, back):
        return [r[2] for r in rows if r[0] == raw and r[1] == month(30 - back) and not r[3]]

    for stage, group in STAGES.items():
        yoy, mom = [], []
        for raw in group:
            for now, before, year in itertools.product(at(raw, 0), at(raw, 1), at(raw, 12)):
                if now is not None and year:
                    yoy.append((now - year) / year * 100)
                if now is not None and before:
                    mom.append((now - before) / before * 100)
        mean = sum(yoy) / len(yoy)
        assert got[stage].yoy_change == pytest.approx(round(mean, 1), abs=0.11)
        assert got[stage].mom_change == pytest.approx(round(sum(mom) / len(mom), 1), abs=0.11)
        assert got[stage].period == 200207
        assert got[stage].pressure_level == ("Low" if mean <= 1 else "Medium" if mean <= 2.5 else "High")


def test_stage_that_lags_behind_is_absent(spark):
    rows = [("WPUID511", month(i), 100.0 + i, False) for i in range(30)]
    rows += [("WPUID521", month(i), 100.0, False) for i in range(29)]
    dim = spark.createDataFrame([(r, r, r, "BLS", "x") for r in ("WPUID511", "WPUID521")], DIM)
    got = stages.stage_pressure(spark.createDataFrame(rows, FACT), dim, stages.stage_map(spark)).collect()
    assert [r.stage for r in got] == ["Stage 1"]


def test_pressure_levels(spark):
    df = spark.createDataFrame([(1.0,), (1.01,), (2.5,), (2.51,)], "yoy double")
    got = [r[0] for r in df.select(stages.pressure_level(df.yoy)).collect()]
    assert got == ["Low", "Medium", "Medium", "High"]


def test_row_and_calendar_changes_agree_without_gaps_and_differ_with_one(spark):
    full = [("a", month(i), 100.0 + i, False) for i in range(30)]
    gap = [("b", month(i), 100.0 + i, False) for i in range(30) if i != 15]
    dim = dim_of(spark, "ab")
    fact = spark.createDataFrame(full + gap, FACT)
    rows = {(r.series_id, r.date): r for r in views.changes_by_rows(fact, dim).collect()}
    calendar = {(r.series_id, r.date): r for r in views.changes_by_calendar(fact, dim).collect()}
    assert rows.keys() == calendar.keys()
    for key, r in rows.items():
        if key[0] == "a":
            assert (r.mom_change, r.yoy_change) == (calendar[key].mom_change_calendar, calendar[key].yoy_change_calendar)
    after_gap = ("b", month(16))
    assert rows[after_gap].mom_change == 116 / 114 - 1
    assert calendar[after_gap].mom_change_calendar is None
    assert calendar["b", month(27)].yoy_change_calendar is None
    assert rows["b", month(27)].yoy_change == 127 / 114 - 1


def test_change_against_zero_is_null(spark):
    fact = spark.createDataFrame([("a", month(0), 0.0, False), ("a", month(1), 5.0, False)], FACT)
    got = views.row_changes(fact).orderBy("date").collect()
    assert [r.mom_change for r in got] == [None, None]


def test_annual_rows_stay_out_of_the_views(spark):
    fact = spark.createDataFrame([("a", month(11), 5.0, False), ("a", month(11), 500.0, True)], FACT)
    dim = dim_of(spark, "a")
    assert views.monthly(fact, dim).collect()[0].avg_value == 5.0
    assert views.yearly(fact, dim).collect()[0].calculated_annual_value == 5.0
    assert views.changes_by_rows(fact, dim).count() == 1
    key = ["series_id", "date"]
    assert quality_gold.duplicate_keys({"values": (fact, key)}).collect()[0].n_rows == 2


def test_view_bounds(spark):
    rng = random.Random(3)
    rows = [(s, month(i), rng.choice([None, rng.random()]), False) for s in "abc" for i in range(40) for _ in range(3)]
    fact, dim = spark.createDataFrame(rows, FACT), dim_of(spark, "abc")
    for view in (views.monthly(fact, dim), views.yearly(fact, dim)):
        for r in view.collect():
            if r.avg_value is not None:
                assert r.min_value <= r.avg_value + 1e-12 and r.avg_value <= r.max_value + 1e-12


def test_change_from_start(spark):
    rows = [("a", month(i), 100.0 + i, False) for i in range(20)] + [("b", month(i), 50.0 + i, False) for i in range(20)]
    fact, dim = spark.createDataFrame(rows, FACT), dim_of(spark, "ab")
    whole = {(r.series_id, r.date): r.change_from_start_pct for r in reports.last_12_months(fact, dim, "%PPI%").collect()}
    own = {(r.series_id, r.date): r.change_from_start_pct for r in reports.last_12_months_by_series(fact, dim, "%PPI%").collect()}
    assert len(whole) == 26 and whole["a", month(7)] == 0.0 and own["b", month(7)] == 0.0
    assert whole["b", month(19)] == round((69 / 107 - 1) * 100, 2)
    assert own["b", month(19)] == round((69 / 57 - 1) * 100, 2)
    assert reports.last_12_months(fact, dim, "%none%").count() == 0


def test_stage_yoy_is_by_row_and_keeps_nulls(spark):
    index = spark.createDataFrame([("Stage 1", month(i), None if i == 2 else 100.0 + i) for i in range(16)], "stage string, date date, index_value double")
    got = {r.date: r.yoy_pct for r in stages.stage_yoy(index).collect()}
    assert got[month(11)] is None and got[month(14)] is None
    assert got[month(12)] == (112 / 100 - 1) * 100
    wide = stages.stage_yoy_wide(stages.stage_yoy(index))
    assert wide.columns == ["date", "stage_1", "stage_2", "stage_3", "stage_4"] and wide.count() == 16


def test_recent_nulls_and_rounding(spark):
    rows = [("a", month(10), None, False), ("a", month(9), 1.0, False), ("a", month(8), 1.0, False), ("a", month(0), None, False), ("b", month(10), 2.0, False)]
    fact, dim = spark.createDataFrame(rows, FACT), dim_of(spark, "ab")
    got = quality_gold.recent_nulls(fact, dim).collect()
    assert [(r.indicator_name, r.total_values, r.null_values, r.null_percentage) for r in got] == [("PPI a", 3, 1, 33.33)]


def test_annual_reconciliation(spark):
    rows = [("a", month(i), 10.0, False) for i in range(24)] + [("a", month(11), 10.00005, True), ("a", month(23), 11.0, True)]
    fact, dim = spark.createDataFrame(rows, FACT), dim_of(spark, "a")
    found = quality_gold.annual_mismatches(fact, dim).collect()
    assert [(r.year, r.provided_annual_value, r.calculated_annual_value) for r in found] == [(dt.date(2001, 1, 1), 11.0, 10.0)]
    summary = quality_gold.annual_summary(fact).collect()[0]
    assert (summary.total_comparisons, summary.mismatches) == (2, 1)
    counts = defaultdict(int, {r.indicator_name: r.annual_avg_rows for r in quality_gold.annual_rows_by_indicator(fact, dim).collect()})
    assert counts["PPI a"] == 2
