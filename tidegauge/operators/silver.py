"""Raw points to clean observations, with a quarantine for what cannot be read."""

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidegauge.functions import columns as c
from tidegauge.schemas import DECEMBER, SILVER


def explode_points(docs: DataFrame) -> DataFrame:
    """One row per point of the documents (series_id, points)."""
    return explode_list(docs, "series_id", "points", "position", "point").select("series_id", "position", "point.*")


def explode_list(df: DataFrame, key: str, values: str, *names: str) -> DataFrame:
    """(key, *names): the elements of an array with positions, or of a map.

    The outer form with a filter behind it, because a plain explode of a parsed
    column also filters by its size further down and so has it parsed twice.
    """
    generator = F.explode_outer if isinstance(df.schema[values].dataType, T.MapType) else F.posexplode_outer
    return df.select(key, generator(values).alias(*names)).where(F.col(names[0]).isNotNull())


def _reason(points: DataFrame) -> Column:
    """Why a point cannot become an observation; NULL if it can."""
    year, period = c.point_year(F.col("year")), F.col("period")
    month_period = F.when(c.is_annual(period), F.lit(DECEMBER)).otherwise(period)
    return (
        F.when(year.isNull(), "bad_year")
        .when(c.is_unparsable_value(F.col("value")), "bad_value")
        .when(c.period_month(month_period).isNull(), "bad_period")
        .when(c.period_date(year, month_period).isNull(), "bad_date")
    )


def quarantine_points(points: DataFrame) -> DataFrame:
    """Points left out of the observations, each with its reason."""
    return points.withColumn("reason", _reason(points)).where("reason IS NOT NULL")


def standardize(points: DataFrame, extraction_timestamp: Column | str) -> DataFrame:
    """Typed records of the readable points; the annual average counts as December."""
    annual = c.is_annual(F.col("period"))
    return points.where(_reason(points).isNull()).select(
        "series_id",
        c.point_year(F.col("year")).alias("year"),
        F.when(annual, F.lit(DECEMBER)).otherwise(F.col("period")).alias("period"),
        c.point_value(F.col("value")).alias("value"),
        F.coalesce("footnotes", F.lit("[]")).alias("footnotes"),
        annual.alias("is_annual_avg"),
        F.lit(extraction_timestamp).cast("timestamp").alias("extraction_timestamp"),
    )


def dedupe(df: DataFrame) -> DataFrame:
    """Drop full copies of a row; copies already meet on the map side."""
    return df.dropDuplicates()


def clean(records: DataFrame) -> DataFrame:
    """Distinct records with date and quarter, in the silver schema."""
    date = c.period_date(F.col("year"), F.col("period"))
    return (
        dedupe(records)
        .withColumn("date", date)
        .withColumn("quarter", F.quarter("date"))
        .select(SILVER.fieldNames())
    )


def observations(docs: DataFrame, extraction_timestamp: Column | str) -> DataFrame:
    """Documents to silver observations."""
    return clean(standardize(explode_points(docs), extraction_timestamp))


def series_metadata(validated: DataFrame, processed_timestamp: Column | str) -> DataFrame:
    """The validated catalog as silver metadata; further columns become text."""
    known = {"is_valid": "boolean"}
    typed = [F.col(name).cast(known.get(name, "string")).alias(name) for name in validated.columns]
    return validated.select(*typed, F.lit(processed_timestamp).cast("timestamp").alias("processed_timestamp"))
