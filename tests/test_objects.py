"""Entries of large JSON objects, cut at any place."""

import json
import os
import random

import pytest

from tidegauge.operators import silver
from tidegauge.sources import documents, objects

AWKWARD = ['}', '{"', '\\', '\\"}', '"}, {"', "[[", "é} ", "\n}", '\\\\"', "", "a}b{c]d["]


def entry(rng, key):
    points = [
        {"year": "2001", "period": f"M{m:02d}", "periodName": rng.choice(AWKWARD), "value": str(m), "footnotes": [{"code": rng.choice(AWKWARD)}]}
        for m in range(1, rng.randrange(2, 9))
    ]
    return {"series_type": "industry", "data": {"seriesID": key, "data": points}}


def consolidated(seed, n):
    rng = random.Random(seed)
    return {f"{rng.choice(AWKWARD)}{i}": entry(rng, f"S{i}") for i in range(n)}


def write(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write(text)


@pytest.fixture
def splits_of(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = {name: spark.conf.get(name) for name in names}

    def to(size):
        spark.conf.set(names[0], str(size))
        spark.conf.set(names[1], "100")

    yield to
    for name, value in old.items():
        spark.conf.set(name, value)


def entries(spark, folder, names="*.json"):
    found = {}
    for r in objects.read_entries(spark, folder, names).collect():
        found.update(json.loads(r.json))
    return found


@pytest.mark.parametrize("size, indent", [(64, 2), (333, None), (1000, 2), (10_000, 4), (1 << 27, 2)])
def test_entries_survive_any_cut(spark, tmp_path, splits_of, size, indent):
    splits_of(size)
    want = {}
    for i in range(2):
        content = consolidated(i, 12)
        content = {f"{i}{key}": value for key, value in content.items()}
        want |= content
        write(str(tmp_path), f"{i}.json", json.dumps(content, indent=indent, ensure_ascii=bool(i)) + "\n" * i)
    assert entries(spark, str(tmp_path)) == want
    if size == 1000:
        read = objects._pieces(spark, str(tmp_path), "*.json")
        assert read.rdd.getNumPartitions() > 8 and read.select("path", "block").distinct().count() > 8


def test_other_members_and_whole_documents(spark, tmp_path, splits_of):
    splits_of(100)
    for text in ('{"a": 1, "b": {"data": []}, "c": "}", "d": [{}, 2]}', "{}", ' {\n"x": {"y": {}}\n}\n\n', '{"seriesID": "A", "data": [{"year": "1"}, {"year": "2"}]}'):
        folder = str(tmp_path / str(abs(hash(text))))
        write(folder, "a.json", text)
        assert entries(spark, folder) == json.loads(text)


def test_a_file_that_breaks_off_keeps_its_whole_entries(spark, tmp_path, splits_of):
    splits_of(200)
    content = consolidated(5, 6)
    text = json.dumps(content, indent=2)
    for number, end in enumerate((len(text) - 2, len(text) - 40, len(text) // 2, text.rindex("}", 0, len(text) - 2))):
        folder = str(tmp_path / str(number))
        write(folder, "a.json", text[:end])
        found = documents.shape_documents(objects.read_entries(spark, folder, "*.json")).collect()
        whole = [r.series_id for r in found if r.readable and r.series_id]
        assert set(whole) < set(content) or number == 0
        assert len(whole) == len(set(whole)) and len(found) - len(whole) == (number > 0)


def test_the_consolidated_file_among_others(spark, tmp_path, splits_of):
    splits_of(150)
    content = {f"S{i}": entry(random.Random(i), f"S{i}") for i in range(20)}
    write(str(tmp_path), "consolidated_data.json", json.dumps(content, indent=2))
    write(str(tmp_path), "a.json", json.dumps({"seriesID": "A", "data": [{"year": "2001", "period": "M01", "value": "1"}]}))
    want = sorted([(k, p["period"], json.dumps(p["footnotes"], ensure_ascii=False, separators=(",", ":"))) for k, e in content.items() for p in e["data"]["data"]] + [("A", "M01", None)], key=str)
    for lines in (False, True):
        docs = documents.read_series_documents(spark, str(tmp_path), lines)
        got = silver.explode_points(docs).select("series_id", "period", "footnotes").collect()
        assert sorted(map(tuple, got), key=str) == want


def test_a_split_is_the_most_that_meets_in_one_task(spark, tmp_path, splits_of):
    splits_of(500)
    write(str(tmp_path), "a.json", json.dumps(consolidated(9, 10), indent=2))
    plan = objects._within_splits(objects._pieces(spark, str(tmp_path), "*.json"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(path") == 1
