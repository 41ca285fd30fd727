"""Document shapes, file selection, parsing, quarantine and document rules."""

import datetime as dt
import json
import os
import random

import pytest

from tidegauge.operators import quality_raw, silver
from tidegauge.sources import documents

RUN = "2024-01-01 00:00:00"


def point(year="2001", period="M01", value="1.5", **more):
    return {"year": year, "period": period, "periodName": "x", "value": value, "footnotes": [{}], **more}


def write(folder, name, content):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w") as f:
        f.write(content if isinstance(content, str) else json.dumps(content, indent=1))
    return path


def values(docs):
    rows = silver.explode_points(docs).select("series_id", "period", "value").collect()
    return sorted(tuple(r) for r in rows)


def test_all_shapes_in_one_folder(spark, tmp_path):
    folder = str(tmp_path)
    write(folder, "a.json", {"seriesID": "A", "data": [point()]})
    write(folder, "b.json", {"series_id": "B", "data": [point(value=2.5)]})
    write(folder, "raw_series_C1.json", {"z": [], "t": "[text]", "y": [point(value="3")], "a": [point(value="9")]})
    write(folder, "all.json", {"D": {"series_type": "industry", "data": {"seriesID": "D", "data": [point(value="4")]}},
                               "E": {"series_type": "commodity", "data": {"seriesID": "E", "data": []}}})
    write(folder, "broken.json", "{not json")
    write(folder, "nothing.json", {"status": "ok"})
    write(folder, "extraction_results.json", {"seriesID": "X", "data": [point()]})
    write(folder, "extraction_progress.json", {"seriesID": "X", "data": [point()]})
    docs = documents.read_series_documents(spark, folder)
    assert values(docs) == [("A", "M01", "1.5"), ("B", "M01", "2.5"), ("C1", "M01", "3"), ("D", "M01", "4")]
    types = {r.series_id: r.series_type for r in docs.select("series_id", "series_type").collect()}
    assert types == {"A": None, "B": None, "C1": None, "D": "industry", "E": "commodity"}


def test_subfolders_are_read_only_when_the_top_holds_nothing(spark, tmp_path):
    top = str(tmp_path / "raw")
    write(top, "extraction_results.json", {})
    write(os.path.join(top, "one"), "a.json", {"seriesID": "A", "data": [point()]})
    write(os.path.join(top, "one", "deep"), "b.json", {"seriesID": "B", "data": [point()]})
    assert [v[0] for v in values(documents.read_series_documents(spark, top))] == ["A"]
    write(top, "c.json", {"seriesID": "C", "data": [point()]})
    assert [v[0] for v in values(documents.read_series_documents(spark, top))] == ["C"]


def test_folder_without_documents_gives_none(spark, tmp_path):
    write(str(tmp_path), "extraction_progress.json", {})
    assert documents.read_series_documents(spark, str(tmp_path)).count() == 0


def test_last_document_of_a_series_wins(spark, tmp_path):
    folder = str(tmp_path)
    for i, name in enumerate(["z.json", "m.json", "n.json"]):
        path = write(folder, name, {"seriesID": "A", "data": [point(value=str(i))]})
        os.utime(path, (1000 + min(i, 1), 1000 + min(i, 1)))
    newest = documents.latest_per_series(documents.read_series_documents(spark, folder))
    assert values(newest) == [("A", "M01", "2")]


def test_versions_in_one_file_leave_one_document(spark, tmp_path):
    first, second = ({"seriesID": "A", "delivered": d, "data": [point(value=v)]} for d, v in (("2024-02", "2"), ("2024-01", "1")))
    tie = [{"seriesID": "T", "data": [point(value=v)]} for v in "345"]
    write(str(tmp_path), "a.json", "\n".join(json.dumps(d) for d in (first, second, first, *tie)))
    newest = documents.latest_per_series(documents.read_series_documents(spark, str(tmp_path), lines=True))
    assert values(newest)[0] == ("A", "M01", "2") and newest.count() == 2


def test_documents_of_one_file_are_judged_apart(spark, tmp_path):
    line = {"seriesID": "A", "data": [point(), point(period="M02")]}
    write(str(tmp_path), "a.json", "\n".join(json.dumps(line) for _ in range(2)))
    inspected = quality_raw.inspect_documents(documents.read_json_text(spark, str(tmp_path), lines=True))
    points = quality_raw.document_points(inspected)
    assert quality_raw.duplicate_points(points).count() == 0 and points.count() == 4
    assert [r.is_valid for r in quality_raw.judge_documents(inspected).collect()] == [True, True]


def test_points_become_observations_or_go_to_quarantine(spark, tmp_path):
    points = [
        point(),
        point(),
        point(period="M13", value="7"),
        point(period="M12", value="8"),
        point(value="-", period="M02"),
        {"year": "2001", "period": "M03"},
        point(year="20x1"),
        point(value="n/a"),
        point(value="NaN"),
        point(period="Q01"),
        point(period="M14"),
        {"period": "M04", "value": "1"},
    ]
    write(str(tmp_path), "a.json", {"seriesID": "A", "data": points})
    docs = documents.read_series_documents(spark, str(tmp_path))
    exploded = silver.explode_points(docs)
    good = silver.observations(docs, RUN).orderBy("date", "is_annual_avg", "value").collect()
    day = dt.date
    assert [(r.date, r.value, r.is_annual_avg, r.quarter) for r in good] == [
        (day(2001, 1, 1), 1.5, False, 1),
        (day(2001, 2, 1), None, False, 1),
        (day(2001, 3, 1), None, False, 1),
        (day(2001, 12, 1), 8.0, False, 4),
        (day(2001, 12, 1), 7.0, True, 4),
    ]
    assert [r.footnotes for r in good][2:] == ["[]", "[{}]", "[{}]"]
    bad = silver.quarantine_points(exploded)
    assert sorted(r.reason for r in bad.collect()) == [
        "bad_date", "bad_period", "bad_period", "bad_value", "bad_value", "bad_year",
    ]
    assert silver.standardize(exploded, RUN).count() + bad.count() == len(points)


def inspect(spark, folder):
    return quality_raw.inspect_documents(documents.read_json_text(spark, folder))


def test_document_rules(spark, tmp_path):
    folder = str(tmp_path)
    write(folder, "from_file_name.json", {"data": [point()]})
    write(folder, "nothing.json", {"status": "ok"})
    write(folder, "all.json", {"D": {"series_type": "industry", "data": {"seriesID": "D", "data": [point(period="M1")]}}})
    write(folder, "b.json", {"series_id": "B", "data": [point()]})
    write(folder, "no_data.json", {"seriesID": "N"})
    write(folder, "not_list.json", {"seriesID": "L", "data": "[text]"})
    write(folder, "empty.json", {"seriesID": "E", "data": []})
    write(folder, "broken.json", "{")
    write(folder, "good.json", {"seriesID": "G", "data": [point()]})
    inspected = inspect(spark, folder)
    found = sorted((r.document, r.rule) for r in quality_raw.document_violations(inspected).collect())
    want = [
        ("E", "no_values"), ("L", "data_not_list"), ("N", "missing_data"),
        ("broken.json", "invalid_json"), ("nothing.json", "missing_data"), ("nothing.json", "missing_series_id"),
    ]
    assert found == want
    judged = quality_raw.judge_documents(inspected)
    assert sorted((r.document, r.rule) for r in quality_raw.findings(judged).collect()) == want
    summary = quality_raw.report_summary(judged).collect()[0]
    assert (summary.total_files, summary.valid_files, summary.success_rate) == (9, 4, "44.44%")


def test_point_rules_are_judged_one_by_one(spark, tmp_path):
    points = [point(), {"year": "2001"}, point(year="x", value="-", period="M13"), point(period="Q01")]
    write(str(tmp_path), "a.json", {"seriesID": "A", "data": points})
    exploded = quality_raw.document_points(inspect(spark, str(tmp_path)))
    structure = sorted((r.position, r.rule) for r in quality_raw.structure_violations(exploded).collect())
    assert structure == [(1, "missing_period"), (1, "missing_period_name"), (1, "missing_value")]
    types = sorted((r.position, r.rule) for r in quality_raw.type_violations(exploded).collect())
    assert types == [(2, "bad_period"), (2, "bad_value"), (2, "bad_year"), (3, "bad_period")]


@pytest.mark.parametrize("seed", range(3))
def test_series_rules_in_place_equal_the_exploded_ones(spark, tmp_path, seed):
    rng = random.Random(seed)
    for name in "ABCD":
        months = [i for i in range(60) if rng.random() < 0.9] + rng.choices(range(60), k=4)
        points = [
            point(str(2000 + i // 12), f"M{i % 12 + 1:02d}", rng.choice(["-", "1000", *[str(rng.random())] * 9]))
            for i in months
        ]
        write(str(tmp_path), f"{name}.json", {"seriesID": name, "data": points})
    inspected = inspect(spark, str(tmp_path))
    judged = {(r.document, r.rule): r.n_violations for r in quality_raw.findings(quality_raw.judge_documents(inspected)).collect()}
    exploded = quality_raw.document_points(inspected)
    want = {}
    for r in quality_raw.duplicate_points(exploded).collect():
        want[r.document, "duplicate_point"] = want.get((r.document, "duplicate_point"), 0) + r.n_points - 1
    dated = exploded.selectExpr("document", "make_date(int(year), int(substr(period, 2)), 1) date", "try_cast(value as double) value")
    for rule, rows in {"gap": quality_raw.month_gaps(dated, "document"), "outlier": quality_raw.outliers(dated, "document")}.items():
        for r in rows.collect():
            want[r.document, rule] = want.get((r.document, rule), 0) + 1
    for r in quality_raw.type_violations(exploded).collect():
        want[r.document, r.rule] = want.get((r.document, r.rule), 0) + 1
    assert judged == want


def test_written_documents_read_back(spark, tmp_path):
    write(str(tmp_path / "in"), "a.json", {"seriesID": "A", "data": [point(), point(period="M02")]})
    docs = documents.read_series_documents(spark, str(tmp_path / "in")).withColumn("series_type", documents.F.lit("industry"))
    out = str(tmp_path / "out")
    documents.write_consolidated(docs, out)
    again = documents.read_series_documents(spark, out, lines=True)
    assert values(again) == values(docs)
    assert again.collect()[0].series_type == "industry"


def test_texts_are_parsed_once(spark, tmp_path):
    write(str(tmp_path), "a.json", {"seriesID": "A", "data": [point()]})
    docs = documents.read_series_documents(spark, str(tmp_path))
    for exploded in (silver.explode_points(docs), quality_raw.document_points(inspect(spark, str(tmp_path)))):
        plan = exploded._jdf.queryExecution().optimizedPlan().toString()
        assert "Filter (size(" not in plan
