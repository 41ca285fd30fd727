"""Schemas and fixed values of the data model."""

from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------
SOURCE = "BLS"
ANNUAL_PERIOD = "M13"
DECEMBER = "M12"
MISSING_VALUE = "-"
SERIES_TYPES = ["aggregated", "industry", "commodity"]  # order of extraction
BATCH_SIZE = 50
DAILY_LIMIT = 500
NOT_FOUND = "Series not found in API response"
BOOKKEEPING_FILES = ["extraction_results.json", "extraction_progress.json"]
CONSOLIDATED_FILE = "consolidated_data.json"
ANNUAL_TOLERANCE = 0.0001
LOW_PRESSURE, MEDIUM_PRESSURE = 1.0, 2.5

STAGES = {
    "Stage 1": ["WPUID511", "WPUID5111", "WPUID51111", "WPUID51112", "WPUID51113"],
    "Stage 2": ["WPUID521", "WPUID5211", "WPUID52111", "WPUID52112", "WPUID52113"],
    "Stage 3": ["WPUID531", "WPUID5311", "WPUID53111", "WPUID53112", "WPUID53113"],
    "Stage 4": ["WPUID541", "WPUID5411", "WPUID54111", "WPUID54112", "WPUID54113"],
}
# ----------------------------------------------------------------------------

# Leaves are text in the raw documents; numbers are parsed later, point by point.
# Footnotes have no fixed inner shape, so they stay JSON text.
POINT = T.StructType(
    [
        T.StructField("year", T.StringType()),
        T.StructField("period", T.StringType()),
        T.StructField("periodName", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("footnotes", T.StringType()),
    ]
)

CATALOG = T.StructType(
    [
        T.StructField("series_id", T.StringType()),
        T.StructField("series_name", T.StringType()),
        T.StructField("series_type", T.StringType()),
    ]
)

LEDGER = T.StructType(
    [
        T.StructField("series_id", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("series_type", T.StringType()),
    ]
)

SILVER = T.StructType(
    [
        T.StructField("series_id", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("quarter", T.IntegerType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("footnotes", T.StringType()),
        T.StructField("is_annual_avg", T.BooleanType()),
        T.StructField("date", T.DateType()),
        T.StructField("extraction_timestamp", T.TimestampType()),
    ]
)

SILVER_METADATA = T.StructType(
    [
        T.StructField("series_id", T.StringType()),
        T.StructField("series_name", T.StringType()),
        T.StructField("series_type", T.StringType()),
        T.StructField("is_valid", T.BooleanType()),
        T.StructField("processed_timestamp", T.TimestampType()),
    ]
)

DIMENSION = T.StructType(
    [
        T.StructField("series_id", T.StringType()),
        T.StructField("raw_series_id", T.StringType()),
        T.StructField("indicator_name", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("industry_code", T.StringType()),
        T.StructField("industry_name", T.StringType()),
        T.StructField("series_type", T.StringType()),
        T.StructField("seasonal_adjustment", T.StringType()),
        T.StructField("base_period", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("updated_at", T.TimestampType()),
    ]
)

FACT = T.StructType(
    [
        T.StructField("series_id", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("is_annual_avg", T.BooleanType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("updated_at", T.TimestampType()),
    ]
)

_VIEW_KEY = [
    T.StructField("series_id", T.StringType()),
    T.StructField("raw_series_id", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("indicator_name", T.StringType()),
    T.StructField("date", T.DateType()),
]
_MEASURES = [T.StructField(name, T.DoubleType()) for name in ("avg_value", "min_value", "max_value")]

PERIOD_VIEW = T.StructType([*_VIEW_KEY, *_MEASURES])
YEARLY_VIEW = T.StructType([*_VIEW_KEY, *_MEASURES, T.StructField("calculated_annual_value", T.DoubleType())])
CHANGES_VIEW = T.StructType(
    [*_VIEW_KEY, *[T.StructField(name, T.DoubleType()) for name in ("value", "mom_change", "yoy_change")]]
)
