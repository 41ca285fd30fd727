"""The archive: records come back byte for byte, payloads are stored once."""

import hashlib

import pytest

from tidegauge.llm import warc

BIG = "<p>" + "é" * 600 + "</p>"
PAGES = [
    (1, "http://a/1", BIG),
    (2, "http://a/2", BIG),
    (9, "http://a/ 9\r\nX: y", BIG),
    (3, None, "small"),
    (4, "http://a/4", "small"),
    (5, "u", None),
    (6, "u", ""),
    (None, "u", BIG),
    (7, "u", "x" * 50_000),
    (7, "u", "x" * 50_000),
]


def pages(spark, rows):
    return spark.createDataFrame([(*r, "z", b"z") for r in rows], "page_id long, url string, html string, address string, payload binary")


def test_round_trip(spark, tmp_path):
    warc.write_archive(pages(spark, PAGES), str(tmp_path))
    records = warc.read_records(spark, str(tmp_path))
    got = sorted(((r.page_id, r.record_type, r.refers_to, bytes(r.payload).decode()) for r in records.collect()), key=str)
    want = [(i, "revisit" if i in (1, 2) else "response", 9 if i in (1, 2) else None, h or "") for i, _, h in PAGES]
    assert got == sorted(want, key=str)
    assert spark.read.parquet(f"{tmp_path}/payloads").count() == len({h or "" for _, _, h in PAGES})
    for row in warc.warc_bytes(records).collect():
        header, _, rest = bytes(row.record).partition(b"\r\n\r\n")
        size = int(next(x for x in header.split(b"\r\n") if x.startswith(b"Content-Length: ")).split()[1])
        assert rest[size:] == b"\r\n\r\n"
    nine = next(r for r in records.collect() if r.page_id == 9)
    assert nine.url == "http://a/%209%0AX:%20y"


def test_written_records_come_back(spark, tmp_path):
    rows = [*PAGES, (10, "http://ü/é", "a\r\n\r\nb" * 300), (8, "u", "a\r\n\r\nb" * 300), (11, "u", "é" * 2_000_000), (7, "u", "y" * 2000), (6, "u", "y" * 2000)]
    warc.write_archive(pages(spark, rows), f"{tmp_path}/a")
    warc.write_warc(spark, f"{tmp_path}/a", f"{tmp_path}/r")
    records = warc.read_warc(spark, f"{tmp_path}/r")
    got = {(r.page_id, r.url, None if r.payload is None else bytes(r.payload).decode()) for r in records.collect()}
    assert (10, "http://ü/é", "a\r\n\r\nb" * 300) in got and (1, "http://a/1", None) in got and (11, "u", "é" * 2_000_000) in got
    last = {h: max(i for i, _, g in rows if i is not None and g == h) for h in {h for _, _, h in rows if h and len(h.encode()) >= 1000}}
    want = []
    for i, _, h in rows:
        data = (h or "").encode()
        other = last.get(h) if i is not None and h in last and i < last[h] else None
        want.append((i, len(data), hashlib.sha1(data).hexdigest(), "response" if other is None else "revisit", other))
    assert sorted(map(tuple, warc.payload_digests(records).collect()), key=str) == sorted(want, key=str)


def test_a_changed_record_is_seen(spark, tmp_path):
    from pyspark.sql import functions as F

    warc.write_archive(pages(spark, PAGES[3:4]), f"{tmp_path}/a")
    warc.write_warc(spark, f"{tmp_path}/a", f"{tmp_path}/r")
    whole = spark.read.parquet(f"{tmp_path}/r").select(F.col("record").cast("string").alias("record"))
    for number, (old, new, says) in enumerate((("small", "smell", "doesn't match its digest"), ("small", "smal", "not as long as it says"))):
        whole.select(F.replace("record", F.lit(old), F.lit(new)).cast("binary").alias("record")).write.parquet(f"{tmp_path}/{number}")
        with pytest.raises(Exception, match=says):
            warc.payload_digests(warc.read_warc(spark, f"{tmp_path}/{number}")).collect()


def test_damage_is_seen(spark, tmp_path):
    warc.write_archive(pages(spark, PAGES[:1]), str(tmp_path))
    spark.sql("select unhex(sha2('a', 256)) as address, cast('b' as binary) as payload, 1L as uses").write.mode("overwrite").parquet(f"{tmp_path}/payloads")
    with pytest.raises(Exception, match="doesn't match its address"):
        warc.read_payloads(spark, str(tmp_path)).collect()


def test_empty_table(spark, tmp_path):
    warc.write_archive(pages(spark, []), str(tmp_path))
    assert warc.read_records(spark, str(tmp_path)).collect() == []
