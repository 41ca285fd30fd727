"""A content-addressed WARC archive.

Two tables hold the archive. ``payloads`` has the bytes of every payload once, under their
SHA-256. ``headers`` has a row for every record: the exact bytes that stand before the
payload (WARC header, blank line, HTTP header) and the address of the payload. A record is
the join of both. Addresses are verified twice: on writing, equal addresses must come with
equal length, SHA-1 and hash of another family; on reading, the address is computed anew
from the stored bytes, and a difference stops the job.

Of the records with one payload of at least ``least`` bytes, that with the largest id is the
response; the others are revisits, which name it and carry no payload of their own in WARC
(`warc_bytes`), though `read_records` gives them the one they refer to.

`write_warc` puts the records together as they stand in WARC files, `read_warc` parses such
records from their bytes alone.

Defined cases: null html is an empty payload; a null url is empty and blanks or control
characters in urls are percent-encoded; long payloads are one value of a row throughout; rows without id are responses; rows that repeat an id
are kept, and those with the response's id are responses too; an empty table makes an empty
archive; columns other than the three named ones are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.skew import attach
from tidegauge.session import scratch, stored

LEAST = 1000
RECORD = "urn:page:"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_END = "\r\n"
_BYTES = "ISO-8859-1"  # a character for each byte


def _lines(*parts: Column | str) -> Column:
    """Header lines, each ended, with a blank line behind; null parts are left out."""
    columns = [F.lit(p) if isinstance(p, str) else p for p in parts]
    return F.concat(F.array_join(F.array_compact(F.array(*columns)), _END), F.lit(_END + _END))


def _header(date: str) -> Column:
    revisit = F.col("refers_to").isNotNull()
    http = _lines("HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", F.concat(F.lit("Content-Length: "), F.col("payload_bytes").cast("string")))
    block = F.octet_length(http) + F.when(revisit, F.lit(0)).otherwise(F.col("payload_bytes"))
    warc = _lines(
        "WARC/1.1",
        F.concat(F.lit("WARC-Type: "), F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        F.concat(F.lit(f"WARC-Record-ID: <{RECORD}"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">")),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), F.col("url")),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("payload_digest")),
        F.concat(F.lit(f"WARC-Refers-To: <{RECORD}"), F.col("refers_to").cast("string"), F.lit(">")),
        F.when(revisit, F.lit(f"WARC-Profile: {PROFILE}")),
        "Content-Type: application/http; msgtype=response",
        F.concat(F.lit("Content-Length: "), block.cast("string")),
    )
    return F.concat(warc, http).cast("binary")


def write_archive(pages: DataFrame, archive: str, key: str = "page_id", url: str = "url", html: str = "html", least: int = LEAST, date: str = "2024-01-01T00:00:00Z") -> None:
    """Write ``archive``/payloads and ``archive``/headers, replacing what is there."""
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    uri = F.regexp_replace(F.regexp_replace(F.coalesce(F.col(url), F.lit("")), r"[\x00-\x1F\x7F]+", "%0A"), " ", "%20")
    records = pages.select(F.col(key).alias("page_id"), uri.alias("url"), payload.alias("payload")).withColumn("address", F.unhex(F.sha2("payload", 256)))
    described = records.select(
        "page_id", "url", "address", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_digest"), F.xxhash64("payload").alias("other")
    )
    check = F.struct("payload_bytes", "payload_digest", "other")
    groups = described.groupBy("address").agg(F.max("page_id").alias("response"), F.min(check).alias("low"), F.max(check).alias("high"))
    same = F.when(F.col("low") != F.col("high"), F.raise_error(F.lit("two payloads have one address"))).otherwise(F.col("response"))
    groups = groups.select("address", same.alias("response"))
    payloads = records.groupBy("address").agg(F.any_value("payload").alias("payload"), F.count(F.lit(1)).alias("uses"))
    payloads.write.mode("overwrite").option("compression", "zstd").parquet(f"{archive}/payloads")
    refers = F.when((F.col("payload_bytes") >= least) & (F.col("page_id") < F.col("response")), F.col("response"))
    (
        described.join(groups, "address")
        .withColumn("refers_to", refers)
        .select(_header(date).alias("header"), "address")
        .write.mode("overwrite")
        .option("compression", "zstd")
        .parquet(f"{archive}/headers")
    )


def read_payloads(spark, archive: str) -> DataFrame:
    """``address``, ``payload`` (verified) and ``uses``, the number of records that have it."""
    kept = spark.read.parquet(f"{archive}/payloads")
    right = F.unhex(F.sha2("payload", 256)) == F.col("address")
    payload = F.when(right, F.col("payload")).otherwise(F.raise_error(F.lit("a stored payload doesn't match its address")))
    return kept.select("address", payload.alias("payload"), "uses")


def _fields(text: Column) -> dict[str, Column]:
    """What a record's header says."""
    field = lambda name, value="(.*)": F.regexp_extract(text, rf"(?:^|\r\n){name}: {value}\r\n", 1)
    number = lambda name: F.nullif(field(name, f"<{RECORD}(.*)>"), F.lit("")).cast("long")
    return {
        "page_id": number("WARC-Record-ID"),
        "record_type": field("WARC-Type"),
        "refers_to": number("WARC-Refers-To"),
        "url": field("WARC-Target-URI"),
        "digest": field("WARC-Payload-Digest", "sha1:(.*)"),
        "length": field("Content-Length", "([0-9]+)").cast("int"),
    }


def read_records(spark, archive: str, bodies: bool = True) -> DataFrame:
    """Every record: ``page_id``, ``record_type``, ``refers_to``, ``url``, ``header`` and ``payload``.

    Without ``bodies`` revisits have a null payload, so that no payload moves for them. A
    payload that very many records have (short ones, as longer ones have one response) is
    handed out by broadcast.
    """
    fields = _fields(F.col("header").cast("string"))
    names = ["page_id", "record_type", "refers_to", "url"]
    headers = spark.read.parquet(f"{archive}/headers").select(*[fields[n].alias(n) for n in names], "header", "address")
    payloads = read_payloads(spark, archive)
    with_payload = lambda rows: attach(rows, payloads, "address", "uses").drop("address")
    if bodies:
        return headers.join(payloads.drop("uses"), "address")
    revisit = F.col("record_type") == "revisit"
    revisits = headers.where(revisit).select(*names, "header", F.lit(None).cast("binary").alias("payload"))
    return with_payload(headers.where(~revisit)).unionByName(revisits)


def warc_bytes(records: DataFrame) -> DataFrame:
    """``page_id`` and ``record``: the bytes of each record as a WARC file has them."""
    block = F.when(F.col("record_type") == "revisit", F.col("header")).otherwise(F.concat("header", "payload"))
    return records.select("page_id", F.concat(block, F.lit(_END + _END).cast("binary")).alias("record"))


def write_warc(spark, archive: str, path: str) -> None:
    """The archive's records as they stand in WARC files, a row for each in the column ``record``."""
    warc_bytes(read_records(spark, archive, bodies=False)).select("record").write.mode("overwrite").option("compression", "zstd").parquet(path)


def read_warc(spark, path: str) -> DataFrame:
    """Records parsed from their bytes alone: ``page_id``, ``record_type``, ``refers_to``, ``url``, ``digest`` and ``payload`` (null for revisits).

    The payload is what follows the HTTP header within the record's Content-Length.
    """
    # Places in this text are places in the record.
    text = F.decode("record", _BYTES)
    blank = _END + _END
    records = spark.read.parquet(path).select(text.alias("text")).withColumn("header", F.substring_index("text", blank, 1))
    records = records.select(*[c.alias(n) for n, c in _fields(F.concat("header", F.lit(_END))).items()], "text", (F.length("header") + 4).alias("start"))
    block = F.substring(F.col("text"), F.col("start") + 1, F.col("length"))
    http = F.length(F.substring_index(block, blank, 1)) + 4
    payload = F.encode(F.substring(block, http + 1, F.col("length") - http), _BYTES)
    whole = F.length("text") == F.col("start") + F.col("length") + 4
    checked = F.when(whole, payload).otherwise(F.raise_error(F.lit("a record is not as long as it says")))
    known = F.decode(F.encode("url", _BYTES), "UTF-8")
    return records.select("page_id", "record_type", "refers_to", known.alias("url"), "digest", F.when(F.col("record_type") == "response", checked).alias("payload"))


def payload_digests(records: DataFrame) -> DataFrame:
    """``page_id``, ``payload_bytes``, ``payload_digest``, ``record_type`` and ``refers_to`` of all records of `read_warc`.

    They are made from the payload itself; a revisit's is that of the response it refers to.
    """
    made = stored(
        records.select("page_id", "record_type", "refers_to", "digest", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_digest")), "records"
    )
    out = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    wrong = (F.col("record_type") == "response") & (F.col("digest") != F.col("payload_digest"))
    responses = made.where("record_type = 'response'").withColumn("payload_digest", F.when(wrong, F.raise_error(F.lit("a payload doesn't match its digest"))).otherwise(F.col("payload_digest")))
    # Rows of one id may hold several payloads, so the digest is part of the name.
    name = lambda key, digest: F.concat_ws(":", F.col(key).cast("string"), digest)
    revisits = made.where("record_type = 'revisit'").select("page_id", "record_type", "refers_to", name("refers_to", "digest").alias("name"))
    uses = revisits.groupBy("name").agg(F.count(F.lit(1)).alias("uses"))
    named = responses.select(name("page_id", "payload_digest").alias("name"), "payload_bytes", "payload_digest").dropDuplicates(["name"])
    found = attach(revisits, stored(named.join(uses, "name"), "referred"), "name", "uses")
    return responses.select(*out).unionByName(found.select(*out))


def op3_content_addressed_warc(spark, sf_dir: str) -> DataFrame:
    archive, records = scratch(spark, "warc"), scratch(spark, "records")
    write_archive(spark.read.parquet(f"{sf_dir}/pages.parquet"), archive)
    write_warc(spark, archive, records)
    return payload_digests(read_warc(spark, records))


OP3_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
q AS (SELECT page_id, h, strlen(h) AS n, max(page_id) OVER (PARTITION BY h) AS last FROM p)
SELECT page_id, n AS payload_bytes, sha1(h) AS payload_digest,
       CASE WHEN n >= 1000 AND page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id < last THEN last END AS refers_to
FROM q
"""
