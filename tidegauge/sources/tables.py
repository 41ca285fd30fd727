"""Gold tables: definitions, writing by year, reading with pruning, inventory."""

import datetime as dt
import json
import re
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tidegauge.schemas import CHANGES_VIEW, DIMENSION, FACT, PERIOD_VIEW, YEARLY_VIEW
from tidegauge.sources import files

MAX_RECORDS_PER_FILE = 50_000_000

_DEFAULTS = {
    "is_annual_avg": "false",
    "created_at": "current_timestamp()",
    "updated_at": "current_timestamp()",
}


def _columns(schema) -> str:
    def one(field):
        default = _DEFAULTS.get(field.name)
        return f"{field.name} {field.dataType.simpleString()}" + (f" DEFAULT {default}" if default else "")

    return ", ".join(one(field) for field in schema)


_BY_YEAR = {
    "economic_indicators_values": FACT,
    "economic_indicators_monthly": PERIOD_VIEW,
    "economic_indicators_changes": CHANGES_VIEW,
    "economic_indicators_yearly": YEARLY_VIEW,
}


def create_tables(spark: SparkSession, database: str, root: str) -> None:
    """Define dimension, fact and views, all but the first partitioned by year; existing ones stay."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {database}.economic_indicators_metadata ({_columns(DIMENSION)}) "
        f"USING parquet LOCATION '{root}/economic_indicators_metadata'"
    )
    for name, schema in _BY_YEAR.items():
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {database}.{name} ({_columns(schema)}, year int) "
            f"USING parquet PARTITIONED BY (year) LOCATION '{root}/{name}'"
        )


def publish(contents: dict[str, DataFrame], root: str, stamp: str) -> None:
    """Write tables as one run and make it the state that readers open.

    Tables with a date are partitioned by year. Every run has a folder of its own, also one
    with a stamp that was there before, so a reader of an earlier run isn't disturbed. The
    run counts once its manifest is there: which files' folders, rows and years it has.
    """
    spark = next(iter(contents.values())).sparkSession
    run = f"{stamp}-{uuid.uuid4().hex[:8]}"
    described = {}
    for name, table in contents.items():
        path = f"{root}/runs/{run}/{name}"
        if "date" in table.columns:
            write_by_year(table, path, whole=True)
        else:
            write_table(table, path)
        described[name] = _described(table, path)
    manifest = json.dumps({"run": run, "tables": described})
    while not files.put_if_absent(spark, _manifest(root, _last_version(spark, root) + 1), manifest):
        pass  # another run was first, and this one comes after it


def _described(table: DataFrame, path: str) -> dict:
    """Schema and rows of a written table, by year where it has years; the files' footers tell, no column is read."""
    by_year = "date" in table.columns
    kept = StructType([f for f in table.schema if f.name != "year"] if by_year else table.schema.fields)
    schema = StructType([*kept.fields, StructField("year", IntegerType())]) if by_year else kept
    schema = StructType([StructField(f.name, f.dataType, True) for f in schema])
    written = table.sparkSession.read.schema(schema).parquet(path)
    described = {"schema": schema.jsonValue()}
    if by_year:
        counts = written.groupBy("year").count().collect()  # as many rows as years
        described["years"] = {str(r["year"]): r["count"] for r in counts}
        described["rows"] = sum(r["count"] for r in counts)
    else:
        described["rows"] = written.count()
    return described


def _manifest(root: str, version: int) -> str:
    return f"{root}/published/{version:012d}.json"


def _last_version(spark: SparkSession, root: str) -> int:
    found = files.names(spark, f"{root}/published")
    return int(found[-1].removesuffix(".json")) if found else 0


def published_version(spark: SparkSession, root: str, version: int | None = None) -> dict:
    """The manifest published last, or that with a number: its run and, by table, schema, rows and rows by year."""
    version = version or _last_version(spark, root)
    if not version:
        raise ValueError(f"nothing is published in {root}")
    return json.loads(spark.read.text(_manifest(root, version), wholetext=True).first()[0])


def published(spark: SparkSession, root: str, name: str, version: int | None = None) -> DataFrame:
    """A table of the run published last, or of an earlier one by its number."""
    manifest = published_version(spark, root, version)
    schema = StructType.fromJson(manifest["tables"][name]["schema"])
    return spark.read.schema(schema).parquet(f"{root}/runs/{manifest['run']}/{name}")


def published_counts(spark: SparkSession, root: str) -> DataFrame:
    """(table_name, year, row_count) of the run published last, from its manifest alone; no year for tables without."""
    rows = []
    for name, table in published_version(spark, root)["tables"].items():
        years = table.get("years")
        rows += [(name, None, table["rows"])] if years is None else [(name, None if y == "None" else int(y), n) for y, n in years.items()]
    return spark.createDataFrame(rows, "table_name string, year int, row_count long")


def forget(spark: SparkSession, root: str, keep: int = 2) -> None:
    """Delete all but the ``keep`` runs published last; their readers must be done."""
    versions = files.names(spark, f"{root}/published")
    numbers = [int(name.removesuffix(".json")) for name in versions]
    kept = {published_version(spark, root, n)["run"] for n in numbers[-keep:]}
    for number in numbers[:-keep]:
        run = published_version(spark, root, number)["run"]
        if run not in kept:
            files.delete(spark, f"{root}/runs/{run}")
        files.delete(spark, _manifest(root, number))


def register(spark: SparkSession, database: str, root: str, names: list[str]) -> None:
    """Name the tables of the run published last in the catalog; a table that is there is switched to that run.

    Definitions keep their defaults. The catalog holds no partitions: a query lists the years
    below the table's location, so that changing the location switches all of them at once.
    """
    manifest = published_version(spark, root)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    tracked = "spark.sql.hive.manageFilesourcePartitions"
    before = spark.conf.get(tracked)
    spark.conf.set(tracked, "false")
    try:
        for name in names:
            schema = StructType.fromJson(manifest["tables"][name]["schema"])
            table, location = f"{database}.{name}", f"{root}/runs/{manifest['run']}/{name}"
            by_year = "years" in manifest["tables"][name]
            columns = _columns(StructType([f for f in schema if not (by_year and f.name == "year")]))
            if spark.catalog.tableExists(table):
                if spark.table(table).schema.simpleString() == schema.simpleString():
                    spark.sql(f"ALTER TABLE {table} SET LOCATION '{location}'")
                    spark.catalog.refreshTable(table)
                    continue
                spark.sql(f"DROP TABLE {table}")  # other columns: another table
            defined = f"({columns}, year int) USING parquet PARTITIONED BY (year)" if by_year else f"({columns}) USING parquet"
            spark.sql(f"CREATE TABLE {table} {defined} LOCATION '{location}'")
    finally:
        spark.conf.set(tracked, before)


def write_by_year(df: DataFrame, path: str, whole: bool = False) -> None:
    """Write rows with a date partitioned by year and sorted by series and date.

    The rebalance gathers a year's rows into files of a good size and cuts a
    year that is too large for one task. Years not in ``df`` stay as they are,
    so a re-run replaces what it loaded before; with ``whole`` they go.
    """
    (
        df.withColumn("year", F.year("date"))
        .hint("rebalance", "year")
        .sortWithinPartitions("year", "series_id", "date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if whole else "dynamic")
        .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
        .option("compression", "snappy")
        .partitionBy("year")
        .parquet(path)
    )


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)


def write_bucketed(df: DataFrame, table: str, buckets: int) -> None:
    """Write a catalog table by year whose files also keep a series together.

    Views over it then need no shuffle by series. It suits tables without
    dominating series; ``write_by_year`` spreads those.
    """
    (
        df.withColumn("year", F.year("date"))
        .repartition(buckets, "series_id")
        .write.mode("overwrite")
        .format("parquet")
        .partitionBy("year")
        .bucketBy(buckets, "series_id")
        .sortBy("series_id", "date")
        .saveAsTable(table)
    )


def write_parts(parts: DataFrame, dim: DataFrame, database: str, buckets: int) -> None:
    """Write change parts (see `operators.views.change_parts`) and the dimension, copied to each part, as tables in equal buckets.

    The parts of a series that dominates lie in many buckets, so none holds much more than
    its share, and views over both tables need no shuffle.
    """
    key = ["series_id", "part"]
    _in_buckets(parts, f"{database}.change_parts", buckets, key, ["date"])
    stored = parts.sparkSession.table(f"{database}.change_parts")
    _in_buckets(stored.select(*key).distinct().join(dim, "series_id"), f"{database}.dimension_parts", buckets, key, [])


def _in_buckets(df: DataFrame, table: str, buckets: int, key: list[str], order: list[str]) -> None:
    spread = df.repartition(buckets, *key).write.mode("overwrite").format("parquet")
    spread.bucketBy(buckets, *key).sortBy(*key, *order).saveAsTable(table)


def since(table: DataFrame, start: dt.date | Column) -> DataFrame:
    """Rows from ``start`` on; skips earlier years where the table has that column."""
    rows = table.where(F.col("date") >= F.lit(start))
    return rows.where(F.col("year") >= F.year(F.lit(start))) if "year" in table.columns else rows


def latest_date(table: DataFrame) -> Column:
    """The latest date as a scalar; reads dates of the newest year only where there are years."""
    if "year" in table.columns:
        table = table.where(F.col("year") == table.agg(F.max("year").alias("y")).scalar())
    return table.agg(F.max("date").alias("d")).scalar()


def years_of(table: DataFrame) -> list[int]:
    """The years of a table that is partitioned by them, newest first, from the names of its folders."""
    found = {re.search(r"/year=(\d+)/", name) for name in table.inputFiles()}
    return sorted({int(hit[1]) for hit in found if hit}, reverse=True)


def newest_first(table: DataFrame, report: Callable[[DataFrame], DataFrame], top: int) -> DataFrame:
    """``report`` over as few of the newest years of ``table`` as give ``top`` rows.

    ``report`` takes a table with a date and gives its first ``top`` rows, latest date
    first. The newest year is tried alone, then more and more older ones; once there are
    enough rows, the date of the last bounds what is read in the end.
    """
    years = years_of(table) if "year" in table.columns else []
    taken, step = 0, 1
    while taken < len(years):
        taken, step = min(len(years), taken + step), 2 * step
        recent = table.where(F.col("year") >= years[taken - 1])
        found = report(recent).agg(F.count("*").alias("n"), F.min("date").alias("first")).first()
        if found["n"] >= top:
            return report(recent.where(F.col("date") >= F.lit(found["first"])))
    return report(table)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Number of rows per named table."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    result = counts[0]
    for count in counts[1:]:
        result = result.unionByName(count)
    return result
