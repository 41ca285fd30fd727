"""All steps from catalogs and documents to reports, on a small made-up input."""

import datetime as dt
import json

from tidegauge.plans import flow, stages
from tidegauge.schemas import STAGES

ZEROTH, FIRST, SECOND = dt.datetime(2023, 12, 1), dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
MEMBERS = [s for group in STAGES.values() for s in group]


def point(year, period, value):
    return {"year": str(year), "period": period, "periodName": "x", "value": str(value), "footnotes": [{}]}


def series(base, months=26):
    return [point(2022 + i // 12, f"M{i % 12 + 1:02d}", base + i) for i in range(months)]


def with_years(points, base):
    return points + [point(2022, "M13", base + 5.5), point(2023, "M13", base + 99)]


def rows(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def test_from_catalogs_to_reports(spark, tmp_path):
    bronze, silver, gold = (str(tmp_path / layer) for layer in ("bronze", "silver", "gold"))
    (tmp_path / "bronze").mkdir()
    listed = {
        "ppi_aggregation_series_ids.csv": [(s, f"PPI {s}") for s in MEMBERS],
        "ppi_commodity_series_ids.csv": [("WPU01", "PPI manufacturing"), (MEMBERS[0], "again")],
        "ppi_series_ids.csv": [("PCU1", "Industry one"), ("PCU2", "Industry two")],
    }
    for name, entries in listed.items():
        (tmp_path / "bronze" / name).write_text("id,title\n" + "".join(f"{a},{b}\n" for a, b in entries))

    for _ in range(2):  # every step can be run again
        flow.build_catalog(spark, bronze)
    known = spark.createDataFrame([(s, True) for s in MEMBERS + ["WPU01"]], "series_id string, ok boolean")
    for _ in range(2):
        flow.validate_catalog(spark, bronze, known)
    requests = flow.next_requests(spark, bronze, used=[499])
    assert sorted(rows(requests, "series_type", "batch"))[0] == ("aggregated", 1) and requests.count() == 20

    point_type = "array<struct<year:string,period:string,periodName:string,value:string,footnotes:string>>"
    received = spark.createDataFrame(
        [(s, "aggregated", json.dumps(series(100.0 + 10 * i) if i < 2 else with_years(series(100.0 + 10 * i), 100.0 + 10 * i))) for i, s in enumerate(MEMBERS)]
        + [("WPU01", "commodity", json.dumps(with_years(series(50.0), 50.0) + [point(2022, "Q01", 1), point(2022, "M01", "x")]))],
        "series_id string, series_type string, data string",
    ).selectExpr("series_id", "series_type", f"from_json(data, '{point_type}') AS points")
    everything = spark.read.csv(f"{bronze}/{flow.VALIDATED}", header=True).drop("is_valid")
    refused = spark.createDataFrame([("PCU1", "industry")], "series_id string, series_type string")
    flow.record_failure(refused, "daily quota reached", bronze, ZEROTH)
    for _ in range(2):
        flow.record_answer(everything.where("series_id <> 'PCU1'"), received, bronze, FIRST)
    entries = flow.ledgers.read_ledger(spark, f"{bronze}/{flow.LEDGER}")
    assert sorted(rows(entries.where("error IS NOT NULL"), "series_id", "error")) == [
        ("PCU1", "daily quota reached"), ("PCU2", "Series not found in API response"),
    ]
    assert flow.next_requests(spark, bronze, used=[0]).count() == 0

    for _ in range(2):
        summary = flow.check_bronze(spark, bronze, FIRST).collect()[0]
        # All but two series have annual rows, which are no month.
        assert (summary.total_files, summary.valid_files) == (21, 2)
    report = spark.read.json(f"{bronze}/{flow.REPORT}/details")
    assert {r.rule for r in report.collect()} == {"bad_period", "bad_value", "duplicate_point"}
    assert spark.read.json(f"{bronze}/{flow.REPORT}/stats").count() == 21

    flow.build_silver(spark, bronze, silver, FIRST)
    flow.build_gold(spark, silver, gold, FIRST)
    again = received.where(f"series_id = '{MEMBERS[0]}'").selectExpr(
        "series_id", "series_type", "transform(points, p -> named_struct('year', p.year, 'period', p.period, "
        "'periodName', p.periodName, 'value', string(2 * double(p.value)), 'footnotes', p.footnotes)) AS points",
    )
    flow.record_answer(again.select("series_id", "series_type"), again, bronze, SECOND)
    for _ in range(2):  # a re-run changes nothing
        flow.build_silver(spark, bronze, silver, SECOND)
        flow.build_gold(spark, silver, gold, SECOND)

    opened = flow.open_gold(spark, gold)
    checks = flow.check_gold(opened)
    assert dict(rows(checks["row_counts"], "table_name", "row_count")) == {
        "economic_indicators_metadata": 23, "economic_indicators_values": 21 * 26 + 19 * 2,
        "economic_indicators_monthly": 21 * 26, "economic_indicators_changes": 21 * 26,
    }
    assert rows(checks["annual_summary"], "total_comparisons", "mismatches") == [(38, 19)]
    assert rows(checks["latest_like"], "indicator_name")[0] == ("PPI manufacturing",)
    assert rows(checks["duplicate_keys"], "check_name") == [("values_series_date",)] * 5
    assert all(check.columns for check in checks.values())
    for name, check in checks.items():
        check.collect()

    found = flow.report_gold(opened, stages.stage_map(spark))
    assert rows(found["stage_pressure"], "stage", "period") == [(s, 202402) for s in STAGES]
    assert found["stage_observations"].count() == 20 * 26
    assert found["cross_indicator_pairs"].count() == 10
    assert found["stage_yoy_wide"].count() == 26
    for report in found.values():
        report.collect()
    doubled = opened[flow.FACT].join(opened[flow.DIMENSION], "series_id").where(f"raw_series_id = '{MEMBERS[0]}'")
    assert sorted(r[0] for r in rows(doubled, "value"))[:2] == [200.0, 202.0]
    assert spark.sql("SELECT count(*) FROM economic_indicators_values WHERE year = 2024").collect()[0][0] == 42
    bad = spark.read.parquet(f"{silver}/{flow.QUARANTINE}").where("snapshot = '20240201_000000'")
    assert sorted(r[0] for r in rows(bad, "reason")) == ["bad_period", "bad_value"]
