"""Catalog precedence, validation, resume, quota, upsert and the dimension."""

import datetime as dt

from pyspark.sql import functions as F

from tidegauge.operators import catalog, quality_gold, silver, star
from tidegauge.sources import catalogs

RUN = "2024-01-01 00:00:00"
PAIR = "series_id string, series_name string"
TYPED = PAIR + ", series_type string"
LEDGER = "series_id string, status string, error string, series_type string"


def rows(df, *columns):
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())


def test_earlier_catalogs_win_and_inner_copies_stay(spark):
    a = spark.createDataFrame([("1", "a"), ("1", "a again")], PAIR)
    b = spark.createDataFrame([("1", "b"), ("2", "b"), ("2", "b")], PAIR)
    c = spark.createDataFrame([("2", "c"), ("3", "c")], PAIR)
    assert rows(catalog.combine_catalogs(a, b, c), "series_id", "series_type") == [
        ("1", "aggregated"), ("1", "aggregated"), ("2", "commodity"), ("2", "commodity"), ("3", "industry"),
    ]
    assert rows(catalog.duplicate_totals(a, b, c)) == [(7, 6, 1)]


def test_catalog_columns_are_taken_by_position(spark, tmp_path):
    (tmp_path / "c.csv").write_text('"Series.ID",Title,Extra\nWPU1,"One, two",x\n')
    assert rows(catalogs.read_catalog(spark, str(tmp_path / "c.csv"))) == [("WPU1", "One, two")]


def test_csv_keeps_every_text(spark, tmp_path):
    names = ['Lumber 2" x 4", cut', " blanks ", "", None, "line\nbreak, \r\n too", "back\\slash\\", '"', "ends with \\", "é,;\t'"]
    entries = spark.createDataFrame([(f"s{i}", n, "x") for i, n in enumerate(names)], PAIR + ", more string")
    for _ in range(2):
        catalogs.write_csv(entries, str(tmp_path / "c"))
    assert rows(catalogs.read_catalog(spark, str(tmp_path / "c"))) == [(f"s{i}", n) for i, n in enumerate(names)]


def test_validity_counts_are_taken_after_the_update(spark):
    listed = spark.createDataFrame([("1", "a", "industry"), ("2", "b", "industry"), ("3", "c", "industry")], TYPED)
    results = spark.createDataFrame([("1", True), ("2", False)], "series_id string, ok boolean")
    validated = catalog.apply_validation(listed, results)
    assert rows(validated, "series_id", "is_valid") == [("1", True), ("2", False), ("3", False)]
    assert rows(catalog.validity_by_type(validated)) == [("industry", 1, 3, 33.3)]
    assert rows(catalog.series_of_type(validated, "industry", valid_only=True), "series_id") == [("1",)]
    assert catalog.series_of_type(validated, "commodity").count() == 0


def test_failed_series_are_done_unless_retried(spark):
    listed = spark.createDataFrame([("1", "a", "industry"), ("2", "b", "industry"), ("3", "c", "industry")], TYPED)
    ledger = spark.createDataFrame([("1", "success", None, "industry"), ("2", "error", "x", "industry")], LEDGER)
    assert rows(catalog.pending_series(listed, ledger), "series_id") == [("3",)]
    assert rows(catalog.pending_series(listed, ledger, retry_failed=True), "series_id") == [("2",), ("3",)]
    answer = catalog.ledger_of_answer(listed, listed.where("series_id <> '2'"))
    assert rows(answer, "series_id", "status") == [("1", "success"), ("2", "error"), ("3", "success")]
    assert rows(catalog.status_by_type(answer)) == [("industry", 2, 1, 3)]


def test_quota_goes_to_the_first_types(spark):
    listed = spark.createDataFrame(
        [(f"a{i}", "aggregated") for i in range(5)] + [(f"c{i}", "commodity") for i in range(5)] + [(f"i{i}", "industry") for i in range(5)],
        "series_id string, series_type string",
    )
    batches = catalog.request_batches(listed, size=2)
    runs = catalog.batches_within_budget(batches, max_batches=2, remaining=3)
    assert rows(runs.select("series_type", "batch").distinct()) == [("aggregated", 1), ("aggregated", 2), ("industry", 1)]
    assert catalog.batches_within_budget(batches).count() == 15
    assert catalog.remaining_requests([500, 499, 600, 0]) == 501


def test_new_documents_replace_old_ones(spark):
    old = spark.createDataFrame([("1", "x"), ("2", "x")], "series_id string, doc string")
    new = spark.createDataFrame([("2", "y"), ("3", "y")], "series_id string, doc string")
    assert rows(catalog.upsert_consolidated(old, new)) == [("1", "x"), ("2", "y"), ("3", "y")]


def test_dimension_is_the_same_on_every_run_and_keeps_invalid_series(spark):
    validated = spark.createDataFrame(
        [("1", "a", "industry", True, "more"), ("2", "b", "industry", False, None), ("2", "b", "industry", False, None)],
        TYPED + ", is_valid boolean, note string",
    )
    metadata = silver.series_metadata(validated, RUN)
    assert metadata.schema["note"].dataType.simpleString() == "string"
    first, second = (star.build_dimension(metadata, RUN) for _ in range(2))
    assert rows(first, "series_id", "raw_series_id") == rows(second, "series_id", "raw_series_id")
    assert first.count() == 2 and star.build_dimension(metadata, RUN, valid_only=True).count() == 1
    assert quality_gold.duplicate_keys({"metadata": (first, ["raw_series_id"])}).count() == 0


def test_unmapped_observations_are_left_out_and_counted(spark):
    metadata = spark.createDataFrame([("1", "a", "industry", True)], TYPED + ", is_valid boolean")
    dim = star.build_dimension(metadata, RUN)
    rows_in = [("1", dt.date(2001, 1, 1), 1.0, False), ("2", dt.date(2001, 1, 1), 2.0, False), ("2", dt.date(2001, 2, 1), 2.0, False)]
    observed = spark.createDataFrame(rows_in, "series_id string, date date, value double, is_annual_avg boolean")
    fact = star.build_fact(observed, dim, F.lit(RUN))
    assert rows(fact, "series_id", "value") == [(dim.collect()[0].series_id, 1.0)]
    assert rows(star.unmapped_counts(observed, dim)) == [("2", 2)]
