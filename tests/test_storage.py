"""Gold and silver storage, and the incremental views."""

import datetime as dt
import os
import random

import pytest

from tidegauge.operators import catalog, quality_gold, quality_raw, views
from tidegauge.plans import reports
from tidegauge.session import clear_scratch, scratch, stored
from tidegauge.sources import files, snapshots, tables
from tidegauge.streaming import stats, views as streaming

FACT = "series_id string, date date, value double, is_annual_avg boolean"
DIM = "series_id string, raw_series_id string, indicator_name string, source string"


def month(i):
    return dt.date(2000 + i // 12, i % 12 + 1, 1)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def fact_of(spark, months, series="ab"):
    return spark.createDataFrame([(s, month(i), 100.0 + i, False) for s in series for i in months], FACT)


def test_rerun_replaces_its_years_and_keeps_others(spark, tmp_path):
    path = str(tmp_path / "gold")
    tables.write_by_year(fact_of(spark, range(36)), path)
    tables.write_by_year(fact_of(spark, range(12, 24)), path)
    assert spark.read.parquet(path).count() == 72


def test_since_prunes_years(spark, tmp_path):
    path = str(tmp_path / "gold")
    tables.write_by_year(fact_of(spark, range(36)), path)
    recent = tables.since(spark.read.parquet(path), dt.date(2002, 3, 1))
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "PushedFilters: [IsNotNull(date)" in plan
    assert recent.count() == 20


def test_latest_date_and_windows_after_it_read_the_newest_years(spark, tmp_path):
    path = str(tmp_path / "gold")
    tables.write_by_year(fact_of(spark, range(40)), path)
    fact = spark.read.parquet(path)
    latest = tables.latest_date(fact)
    recent = tables.since(fact, views.F.add_months(latest, -2))
    assert {r.date for r in recent.collect()} == {month(37), month(38), month(39)}
    plan = recent._jdf.queryExecution().executedPlan().toString()
    pruned = [line for line in plan.splitlines() if "FileScan" in line and "PartitionFilters: [isnotnull(year" in line]
    assert pruned and all("ubquery" in line for line in pruned)


def test_views_over_a_bucketed_table_need_no_shuffle(spark, tmp_path):
    spark.sql(f"CREATE DATABASE bucketed LOCATION '{tmp_path}/db'")
    tables.write_bucketed(fact_of(spark, range(36)), "bucketed.fact", 4)
    fact = spark.table("bucketed.fact")
    for view in (views.period_state(fact, streaming.MONTHLY(views.F.col("date"))), views.row_changes(fact, None)):
        assert "Exchange" not in view._jdf.queryExecution().executedPlan().toString()
        assert view.count() == 72
    spark.sql("DROP DATABASE bucketed CASCADE")


def test_a_dominating_series_is_spread_over_buckets_and_needs_no_shuffle(spark, tmp_path):
    spark.sql(f"CREATE DATABASE parts_test LOCATION '{tmp_path}/db'")
    rng = random.Random(7)
    hot = [("hot", month(rng.randrange(24)), rng.random(), False) for _ in range(3000)]
    usual = [(s, month(m), rng.random(), False) for s in "abc" for m in range(30)]
    fact = spark.createDataFrame(hot + usual, FACT)
    dim = spark.createDataFrame([(s, s, s, "BLS") for s in ("a", "b", "c", "hot")], DIM)
    tables.write_parts(views.change_parts(fact, hot_rows=500, slot_rows=20), dim, "parts_test", 8)
    parts, names = spark.table("parts_test.change_parts"), spark.table("parts_test.dimension_parts")
    sizes = [r["count"] for r in parts.where("series_id = 'hot'").groupBy(views.F.input_file_name()).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 3 * min(sizes)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        view = views.changes_of_parts(parts, names)
        assert "Exchange" not in plan_of(view)
        assert rows(view) == rows(views.changes_by_rows(fact, dim))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    spark.sql("DROP DATABASE parts_test CASCADE")


def test_table_definitions(spark, tmp_path):
    for _ in range(2):
        tables.create_tables(spark, "macro_test", str(tmp_path))
    spark.sql("INSERT INTO macro_test.economic_indicators_values (series_id, date, value, year) VALUES ('a', DATE '2001-01-01', 1.5, 2001)")
    row = spark.table("macro_test.economic_indicators_values").collect()[0]
    assert row.is_annual_avg is False and row.created_at is not None
    counts = tables.row_counts({"values": spark.table("macro_test.economic_indicators_values"), "metadata": spark.table("macro_test.economic_indicators_metadata")})
    assert rows(counts) == [("metadata", 0), ("values", 1)]
    spark.sql("DROP DATABASE macro_test CASCADE")


def test_snapshot_written_last_wins(spark, tmp_path):
    root = str(tmp_path / "silver")
    silver = fact_of(spark, range(12)).selectExpr(
        "series_id", "year(date) AS year", "quarter(date) AS quarter", "value", "'[]' AS footnotes", "is_annual_avg", "date",
        "timestamp'2024-01-01' AS extraction_timestamp",
    )
    snapshots.write_snapshot(silver, root, "20240102_000000")
    snapshots.write_snapshot(silver.where("series_id = 'a'"), root, "20240101_000000")
    newest = snapshots.newest_snapshot(spark, root)
    assert newest.count() == 12 and newest.columns == silver.columns
    snapshots.write_snapshot(silver, root, "20240102_000000")
    assert snapshots.newest_snapshot(spark, root).count() == 24


def test_an_empty_run_is_the_newest(spark, tmp_path):
    root = str(tmp_path / "silver")
    silver = spark.createDataFrame([], snapshots.SILVER)
    one = spark.sql("SELECT 'a' series_id, 2000 year, 1 quarter, 1D value, '[]' footnotes, false is_annual_avg, date'2000-01-01' date, timestamp'2024-01-01' extraction_timestamp")
    snapshots.write_snapshot(one, root, "1")
    snapshots.write_snapshot(silver, root, "2")
    assert snapshots.newest_snapshot(spark, root).count() == 0
    (tmp_path / "silver" / "snapshot=3").mkdir()  # a run under way
    assert snapshots.finished_runs(spark, root, "snapshot") == ["1", "2"]
    with pytest.raises(ValueError):
        snapshots.newest_snapshot(spark, str(tmp_path / "none"))


def test_a_published_run_is_the_whole_state(spark, tmp_path):
    gold = str(tmp_path / "gold")
    dim = spark.createDataFrame([("a", "a", "a", "BLS")], DIM)
    for stamp, months in (("1", range(36)), ("2", range(12)), ("2", range(12))):
        tables.publish({"values": fact_of(spark, months), "dim": dim}, gold, stamp)
    assert tables.published(spark, gold, "values").count() == 24
    tables.register(spark, "published_test", gold, ["values", "dim"])
    assert spark.table("published_test.values").where("year = 2000").count() == 24
    tables.publish({"values": fact_of(spark, range(6)), "dim": dim}, gold, "3")
    tables.register(spark, "published_test", gold, ["values"])
    assert spark.table("published_test.values").count() == 12
    spark.sql("DROP DATABASE published_test CASCADE")


def test_scratch_folders_lie_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    one, two = scratch(spark, "x"), scratch(spark, "x")
    assert one != two
    assert shared is None or one.startswith(shared)


def test_scratch_folders_can_be_cleared(spark):
    kept = stored(fact_of(spark, range(3)), "kept")
    assert kept.count() == 6
    clear_scratch(spark)
    folder = kept.inputFiles()[0].removeprefix("file://")
    assert not os.path.exists(os.path.dirname(folder))


ORDERS = [
    [range(0, 12), range(12, 24), range(24, 30)],
    [range(24, 30), range(0, 12), range(12, 24)],
    [range(0, 30, 2), range(1, 30, 2)],
]


@pytest.mark.parametrize("arrivals", ORDERS)
def test_incremental_views_equal_a_batch_run(spark, tmp_path, arrivals):
    landing = str(tmp_path / "in")
    dim = spark.createDataFrame([(s, s, s, "BLS") for s in "ab"], DIM)
    everything = fact_of(spark, range(30))
    for i, months in enumerate(arrivals):
        # The first delivery lacks series b, which must not disturb series a.
        part = fact_of(spark, months, "a" if i == 0 else "ab")
        part.coalesce(1).write.mode("append").parquet(landing)
    late = fact_of(spark, arrivals[0], "b")

    def run():
        for view, start in (("monthly", streaming.MONTHLY), ("yearly", streaming.YEARLY)):
            stream = streaming.observation_stream(spark, landing, 1)
            streaming.maintain_periods(stream, f"{tmp_path}/{view}", f"{tmp_path}/{view}_at", start, True).awaitTermination()
        stream = streaming.observation_stream(spark, landing, 1)
        streaming.maintain_changes(stream, f"{tmp_path}/changes", f"{tmp_path}/changes_at", True).awaitTermination()

    run()
    late.coalesce(1).write.mode("append").parquet(landing)
    run()  # restarts from its checkpoint and reads the new file only
    monthly = streaming.read_periods(spark, f"{tmp_path}/monthly", dim)
    assert rows(monthly) == rows(views.monthly(everything, dim))
    yearly = streaming.read_periods(spark, f"{tmp_path}/yearly", dim)
    assert rows(yearly) == rows(views.yearly(everything, dim).drop("calculated_annual_value"))
    changes = streaming.read_changes(spark, f"{tmp_path}/changes", dim)
    assert rows(changes) == rows(views.changes_by_rows(everything, dim))


DIMENSIONS = [(s, s, s, "BLS") for s in "abc"]


def test_a_replayed_batch_counts_once(spark, tmp_path):
    log = streaming.period_log(spark, str(tmp_path / "s"), 2)
    for batch_id in (0, 0, 1, 1, 0, 2):
        streaming.add_period_batch(log, fact_of(spark, range(12)), batch_id, streaming.MONTHLY)
    assert {r.value_count for r in streaming._merged(log.read("state")).collect()} == {3}
    changes = streaming.changes_log(spark, str(tmp_path / "c"), 2)
    for batch_id in (0, 0, 1, 1):
        streaming.add_changes_batch(changes, fact_of(spark, range(12 * batch_id, 12 * batch_id + 12)), batch_id)
    dim = spark.createDataFrame(DIMENSIONS, DIM)
    assert rows(streaming.read_changes(spark, changes.root, dim)) == rows(views.changes_by_rows(fact_of(spark, range(24)), dim))


def test_a_run_that_broke_off_leaves_no_trace(spark, tmp_path):
    log = streaming.period_log(spark, str(tmp_path / "s"), 3)
    state = views.period_state(fact_of(spark, range(12)), streaming.MONTHLY(views.F.col("date")))
    log.write(log.begin(0), "state", state)  # and no commit
    assert log.read("state").count() == 0 and not log.holds(0)
    streaming.add_period_batch(log, fact_of(spark, range(12)), 0, streaming.MONTHLY)
    assert {r.value_count for r in log.read("state").collect()} == {1}
    assert len(files.names(spark, f"{tmp_path}/s/runs")) == 1


def test_many_batches_leave_few_folders_and_readers_see_one_state(spark, tmp_path):
    log, fanout = streaming.period_log(spark, str(tmp_path / "s"), 3), 3
    for number in range(20):
        before = streaming._merged(log.read("state"))  # opened before the batch and what it merges
        streaming.add_period_batch(log, fact_of(spark, [number % 5], "a"), number, streaming.MONTHLY)
        assert sum(r.value_count for r in before.collect()) == number
        runs = log.state()[1]
        assert len(runs) <= 2 * (fanout - 1) + 2 and [r.first for r in runs] == sorted(r.first for r in runs)
    assert {r.level for r in runs} == {0, 2} and sum(r.last - r.first + 1 for r in runs) == 20
    assert len(files.names(spark, f"{tmp_path}/s/runs")) <= 10
    assert len(files.names(spark, f"{tmp_path}/s/manifest")) == 3


def test_two_writers_of_one_log_are_told_apart(spark, tmp_path):
    one, two = (streaming.period_log(spark, str(tmp_path / "s")) for _ in range(2))
    state = views.period_state(fact_of(spark, range(12)), streaming.MONTHLY(views.F.col("date")))
    runs = [log.begin(0) for log in (one, two)]
    for log, run in zip((one, two), runs, strict=True):
        log.write(run, "state", state)
    path = f"{tmp_path}/x/1.json"
    assert files.put_if_absent(spark, path, "a") and not files.put_if_absent(spark, path, "b")
    assert spark.read.text(path).first()[0] == "a" and files.names(spark, f"{tmp_path}/x") == ["1.json"]
    two.state = lambda: (0, [])  # saw nothing of the other
    one.commit(runs[0])
    with pytest.raises(RuntimeError, match="another writer"):
        two.commit(runs[1])


def written(spark, log, batch_id):
    return log.spark.read.parquet(*[f"{log.root}/runs/{r.folder}/changes" for r in log.state()[1] if r.first == batch_id])


def test_a_late_batch_rewrites_only_what_looks_back_at_it(spark, tmp_path):
    log = streaming.changes_log(spark, str(tmp_path / "c"))
    dim = spark.createDataFrame(DIMENSIONS, DIM)
    everything = fact_of(spark, range(120), "abc")
    late = (views.F.col("series_id") == "b") & (views.F.col("date") == month(50))
    streaming.add_changes_batch(log, everything.where(~late), 0)
    folders = set(files.names(spark, f"{log.root}/runs"))
    old = {f: sorted(os.listdir(f"{log.root}/runs/{f}/changes")) for f in folders}
    streaming.add_changes_batch(log, everything.where(late), 1)
    assert old == {f: sorted(os.listdir(f"{log.root}/runs/{f}/changes")) for f in folders}
    made = written(spark, log, 1)
    assert {r.series_id for r in made.collect()} == {"b"}
    assert sorted(r.date for r in made.collect()) == [month(50 + k) for k in range(13)]
    assert rows(streaming.read_changes(spark, log.root, dim)) == rows(views.changes_by_rows(everything, dim))


def test_random_deliveries_equal_a_batch_run(spark, tmp_path):
    rng = random.Random(6)
    everything = [(rng.choice("abc"), month(rng.choice([rng.randrange(0, 30), rng.randrange(200, 240)])), float(rng.randrange(5)), rng.random() < 0.1) for _ in range(150)]
    log = streaming.changes_log(spark, str(tmp_path / "c"), 3)
    dim = spark.createDataFrame(DIMENSIONS, DIM)
    for number in range(5):
        streaming.add_changes_batch(log, spark.createDataFrame(everything[number * 30 : number * 30 + 30], FACT), number)
    got = streaming.read_changes(spark, log.root, dim)
    assert rows(got) == rows(views.changes_by_rows(spark.createDataFrame(everything, FACT), dim))


def test_years_far_from_a_delivery_are_not_read(spark, tmp_path):
    log = streaming.changes_log(spark, str(tmp_path / "c"))
    streaming.add_changes_batch(log, fact_of(spark, range(240), "ab"), 0)
    touched = spark.createDataFrame([("a", month(125))], "series_id string, date date")
    needed = streaming._years_needed(touched, log.read("counts"))
    assert rows(needed) == [("a", 2009), ("a", 2010), ("a", 2011)]


def test_a_rerun_leaves_published_folders_alone_and_the_catalog_switches(spark, tmp_path):
    gold = str(tmp_path / "gold")
    dim = spark.createDataFrame(DIMENSIONS, DIM)
    full = fact_of(spark, range(36)).withColumn("created_at", views.F.lit("2024-01-01").cast("timestamp"))
    tables.publish({"values": full, "dim": dim}, gold, "1")
    tables.register(spark, "rerun_test", gold, ["values", "dim"])
    between, by_sql = tables.published(spark, gold, "values"), spark.table("rerun_test.values")
    tables.publish({"values": full.where("year(date) < 2002"), "dim": dim}, gold, "1")
    assert between.count() == by_sql.count() == 72  # as opened before the second write
    assert spark.table("rerun_test.values").count() == 72  # not yet switched
    tables.register(spark, "rerun_test", gold, ["values", "dim"])
    assert spark.table("rerun_test.values").count() == 48
    assert spark.table("rerun_test.values").where("year = 2002").count() == 0
    assert tables.published(spark, gold, "values", 1).count() == 72
    described = spark.sql("SHOW CREATE TABLE rerun_test.values").first()[0]
    assert "DEFAULT" in described and "PARTITIONED BY (year)" in described
    counts = {(r.table_name, r.year): r.row_count for r in tables.published_counts(spark, gold).collect()}
    assert counts == {("values", 2000): 24, ("values", 2001): 24, ("dim", None): 3}
    tables.forget(spark, gold, 1)
    assert len(files.names(spark, f"{gold}/runs")) == 1 and tables.published(spark, gold, "values").count() == 48
    spark.sql("DROP DATABASE rerun_test CASCADE")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_rows_come_from_the_newest_years_that_suffice(spark, tmp_path):
    path = str(tmp_path / "gold")
    fact = fact_of(spark, range(60), "ab").unionByName(fact_of(spark, range(0, 20), "c"))
    tables.write_by_year(fact, path)
    dim = spark.createDataFrame([(s, s, f"{s} index", "BLS", "i", "") for s in "abc"], DIM + ", industry_name string, seasonal_adjustment string")
    kept = spark.read.parquet(path)
    assert tables.years_of(kept) == [2004, 2003, 2002, 2001, 2000]
    for pattern, year in (("%index", 2004), ("c %", 2000)):
        got = reports.latest_like(kept, dim, pattern)
        assert f">= {year})" in plan_of(got).split("PartitionFilters: [")[1].split("]")[0]
        assert rows(got) == rows(reports.latest_like(fact, dim, pattern))
    recent = reports.values_recent(kept, dim, dt.date(2003, 6, 1))
    assert ">= 2004" in plan_of(recent) and rows(recent) == rows(reports.values_recent(fact, dim, dt.date(2003, 6, 1)))
    few = reports.latest_like(kept, dim, "no such %")
    assert few.count() == 0


def test_checks_read_each_table_once(spark, tmp_path):
    path = str(tmp_path / "gold")
    tables.write_by_year(fact_of(spark, range(24)).unionByName(fact_of(spark, [3, 3, 5])), path)
    fact = spark.read.parquet(path)
    found = quality_gold.duplicate_keys({"a": (fact, ["series_id", "date"]), "b": (fact, ["date"]), "c": (fact, ["series_id", "value"])}, 1)
    plan = plan_of(found)  # before it runs, there is one plan
    assert plan.count("FileScan") == 1 and plan.count("HashAggregate") == 2
    assert rows(found) == [("a", "a|2000-04-01", 3), ("b", "2000-04-01", 6), ("c", "a|103.0", 3)]


def test_statistics_after_late_deliveries_equal_a_full_run(spark, tmp_path):
    rng = random.Random(2)
    values = [(s, month(m), rng.choice([None, 1e6 + rng.random(), 1e6 + rng.random(), 1e6 + rng.random(), 1e6 + rng.choice([1, 1, 1, 60]) * rng.random()]), False) for s in "abc" for m in range(60)] + [("d", month(1), None, False)]
    rng.shuffle(values)
    log = stats.stats_log(spark, str(tmp_path / "s"), 3)
    for number in range(7):
        stats.add_stats_batch(log, spark.createDataFrame(values[number::7], FACT), number)
        stats.add_stats_batch(log, spark.createDataFrame(values[number::7], FACT), number)
    everything = spark.createDataFrame(values, FACT)
    want = {r.series_id: r for r in quality_raw.series_stats(everything).collect()}
    got = {r.series_id: r for r in stats.read_stats(log).collect()}
    assert set(got) == set(want)
    for key, row in got.items():
        assert (row.min_value, row.max_value, row.n_values) == (want[key].min_value, want[key].max_value, want[key].n_values)
        assert row.mean_value == (want[key].mean_value and pytest.approx(want[key].mean_value, rel=1e-15))
        assert row.std_value == (want[key].std_value and pytest.approx(want[key].std_value, rel=1e-7))
    places = ["series_id", "date", "value"]
    found = stats.read_outliers(log)
    assert rows(found.select(places)) == rows(quality_raw.outliers(everything).select(places)) and found.count() > 0


def test_an_update_of_few_keys_leaves_all_other_files(spark, tmp_path):
    log = catalog.document_log(spark, str(tmp_path / "d"))
    old = spark.range(1000).selectExpr("concat('s', id) series_id", "'t' series_type", "concat('old', id) document")
    catalog.upsert_documents(log, old, 0)
    before = {os.path.join(d, f) for d, _, names in os.walk(f"{tmp_path}/d/runs") for f in names}
    few = spark.range(0, 1100, 110).selectExpr("concat('s', id) series_id", "'u' series_type", "concat('new', id) document")
    for _ in range(2):
        catalog.upsert_documents(log, few, 1)
    assert before <= {os.path.join(d, f) for d, _, names in os.walk(f"{tmp_path}/d/runs") for f in names}
    (run,) = [r for r in log.state()[1] if r.first == 1]
    assert log.read("documents", [run]).count() == 10
    now = catalog.current_documents(log)
    assert rows(now) == rows(catalog.upsert_consolidated(old, few)) and now.where("document LIKE 'new%'").count() == 10
