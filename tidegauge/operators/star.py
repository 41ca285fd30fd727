"""The star schema: dimension, fact and the key lookup between them."""

from pyspark.sql import Column, DataFrame, functions as F

from tidegauge.functions import columns as c
from tidegauge.schemas import DIMENSION, FACT, SOURCE

# No join here asks for a broadcast: the optimizer takes one when the measured
# size of a side allows it, and splits skewed partitions when not.


def build_dimension(metadata: DataFrame, loaded_at: Column | str, valid_only: bool = False) -> DataFrame:
    """Silver metadata as dimension rows under a key that is the same on every run.

    A series listed more than once gets one row, so that no join repeats its
    observations; of differing entries the smallest is kept.
    """
    rows = metadata.where("is_valid") if valid_only else metadata
    entry = F.min(F.struct("series_name", "series_type")).alias("entry")
    blank = F.lit("")
    return rows.groupBy("series_id").agg(entry).select(
        c.surrogate_id(F.col("series_id")).alias("series_id"),
        F.col("series_id").alias("raw_series_id"),
        F.col("entry.series_name").alias("indicator_name"),
        F.lit(SOURCE).alias("source"),
        blank.alias("industry_code"),
        blank.alias("industry_name"),
        F.col("entry.series_type").alias("series_type"),
        blank.alias("seasonal_adjustment"),
        blank.alias("base_period"),
        F.lit(loaded_at).cast("timestamp").alias("created_at"),
        F.lit(loaded_at).cast("timestamp").alias("updated_at"),
    ).select(DIMENSION.fieldNames())


def map_series_ids(silver: DataFrame, dim: DataFrame) -> DataFrame:
    """Observations under the dimension's key; those without an entry are left out."""
    keys = dim.select(F.col("raw_series_id"), F.col("series_id").alias("_key")).distinct()
    return (
        silver.withColumnRenamed("series_id", "raw_series_id")
        .join(keys, "raw_series_id")
        .withColumn("series_id", F.col("_key"))
        .select(silver.columns)
    )


def unmapped_counts(silver: DataFrame, dim: DataFrame) -> DataFrame:
    """Observations per raw id that the dimension lacks, counted before the join."""
    counts = silver.groupBy(F.col("series_id").alias("raw_series_id")).agg(F.count("*").alias("n_unmapped"))
    return counts.join(dim.select("raw_series_id").distinct(), "raw_series_id", "left_anti")


def build_fact(silver: DataFrame, dim: DataFrame, loaded_at: Column | str) -> DataFrame:
    return (
        map_series_ids(silver, dim)
        .withColumn("date", F.col("date").cast("date"))
        .withColumn("created_at", F.lit(loaded_at).cast("timestamp"))
        .withColumn("updated_at", F.lit(loaded_at).cast("timestamp"))
        .select(FACT.fieldNames())
    )


def with_names(df: DataFrame, dim: DataFrame, *attributes: str) -> DataFrame:
    """Attach dimension attributes by series_id (inner, as in all reports)."""
    return df.join(dim.select("series_id", *attributes), "series_id")
