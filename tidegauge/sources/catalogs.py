"""Series catalogs as CSV, and JSON reports."""

from pyspark.sql import DataFrame, SparkSession, functions as F


# Quotes are doubled inside quoted values; blanks and line breaks belong to a value; a
# missing value is written as nothing and an empty text as a pair of quotes.
_CSV = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "multiLine": True,
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}
# What the reader takes for a missing value besides nothing at all: a text that no catalog holds.
# Were it the empty text, as by default, a pair of quotes would read as missing.
_READ = {**_CSV, "nullValue": "\u0000"}


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """First two columns of a catalog, whatever their names, as id and name."""
    table = spark.read.options(**_READ).csv(path)
    series_id, series_name = table.columns[:2]
    return table.select(F.col(f"`{series_id}`").alias("series_id"), F.col(f"`{series_name}`").alias("series_name"))


def read_validated(spark: SparkSession, path: str) -> DataFrame:
    """The combined or validated catalog, by its own column names."""
    table = spark.read.options(**_READ).csv(path)
    if "is_valid" in table.columns:
        table = table.withColumn("is_valid", F.col("is_valid").cast("boolean"))
    return table


def write_csv(df: DataFrame, path: str) -> None:
    """Replace ``path`` by a table that reads back as it is, text by text."""
    df.write.mode("overwrite").options(**{k: v for k, v in _CSV.items() if k != "multiLine"}).csv(path)


def write_report(df: DataFrame, path: str) -> None:
    """A report as JSON, one object per line, missing entries kept as null; replaces an earlier one."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)
