"""The derived tables: monthly, yearly and change views over the fact."""

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidegauge.functions import columns as c
from tidegauge.operators.hot import HOT_ROWS, SLOT_ROWS, key_sizes, laid_out, lags_of_parts, with_lags
from tidegauge.operators.star import with_names

NAMES = ["raw_series_id", "source", "indicator_name"]
LAGS = {"_1": 1, "_12": 12}


def monthly_rows(fact: DataFrame) -> DataFrame:
    """The fact without annual averages, which carry December's date."""
    return fact.where(~F.col("is_annual_avg"))


def value_state() -> list[Column]:
    """Aggregate state of ``value`` that can be merged later."""
    return [
        F.sum("value").alias("value_sum"),
        F.count("value").alias("value_count"),
        F.min("value").alias("value_min"),
        F.max("value").alias("value_max"),
    ]


def merge_state() -> list[Column]:
    return [
        F.sum("value_sum").alias("value_sum"),
        F.sum("value_count").alias("value_count"),
        F.min("value_min").alias("value_min"),
        F.max("value_max").alias("value_max"),
    ]


def finish_state(state: DataFrame) -> DataFrame:
    """State columns to average, minimum and maximum."""
    average = F.col("value_sum") / F.nullif(F.col("value_count"), F.lit(0))
    return state.select(
        "series_id",
        "date",
        average.alias("avg_value"),
        F.col("value_min").alias("min_value"),
        F.col("value_max").alias("max_value"),
    )


def period_state(fact: DataFrame, start: Column) -> DataFrame:
    """State per series and period; rows meet on the map side before the shuffle."""
    return monthly_rows(fact).groupBy("series_id", start.alias("date")).agg(*value_state())


def named(view: DataFrame, dim: DataFrame) -> DataFrame:
    """Add names to a view. Aggregates are joined after aggregation: a row per period."""
    measures = [name for name in view.columns if name not in ("series_id", "date")]
    return with_names(view, dim, *NAMES).select("series_id", *NAMES, "date", *measures)


def monthly(fact: DataFrame, dim: DataFrame) -> DataFrame:
    return named(finish_state(period_state(fact, c.month_start(F.col("date")))), dim)


def yearly(fact: DataFrame, dim: DataFrame) -> DataFrame:
    return named(yearly_values(fact), dim)


def yearly_values(fact: DataFrame) -> DataFrame:
    view = finish_state(period_state(fact, c.year_start(F.col("date"))))
    return view.withColumn("calculated_annual_value", F.col("avg_value"))


def row_changes(fact: DataFrame, hot_rows: int | None = HOT_ROWS, sizes: DataFrame | None = None) -> DataFrame:
    """Month and year changes by position: against 1 and 12 rows earlier in the series.

    ``sizes`` (series_id, date, n) spares a look at the fact for series that hold very many
    rows; None for ``hot_rows`` says that there are none.
    """
    rows = monthly_rows(fact).select("series_id", "date", "value")
    lagged = with_lags(rows, "series_id", "date", "value", LAGS, hot_rows, sizes=sizes)
    return lagged.select("series_id", "date", "value", *_changes())


def _changes() -> list[Column]:
    return [
        c.change(F.col("value"), F.col("_1")).alias("mom_change"),
        c.change(F.col("value"), F.col("_12")).alias("yoy_change"),
    ]


def change_parts(fact: DataFrame, hot_rows: int = HOT_ROWS, slot_rows: int = SLOT_ROWS) -> DataFrame:
    """The fact's monthly rows in parts of which each holds all that its changes need, to be stored in buckets."""
    rows = monthly_rows(fact).select("series_id", "date", "value")
    return laid_out(rows, "series_id", "date", "value", max(LAGS.values()), hot_rows, slot_rows)


def changes_of_parts(parts: DataFrame, dim_parts: DataFrame) -> DataFrame:
    """The changes view over stored parts and the dimension copied to them; bucketed alike, they need no shuffle."""
    lagged = lags_of_parts(parts, "series_id", "date", "value", LAGS)
    changes = lagged.select("series_id", "part", "date", "value", *_changes())
    return changes.join(dim_parts, ["series_id", "part"]).select(
        "series_id", *NAMES, "date", "value", "mom_change", "yoy_change"
    )


def changes_by_rows(
    fact: DataFrame, dim: DataFrame, hot_rows: int = HOT_ROWS, sizes: DataFrame | None = None
) -> DataFrame:
    """The changes view: positional changes with the series' names."""
    return named(row_changes(fact, hot_rows, sizes), dim)


def large_series(fact: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(series_id, date, n): rows of the series above the limit, to be kept with the fact for `row_changes`."""
    sizes = key_sizes(monthly_rows(fact), "series_id", "date")
    large = sizes.groupBy("series_id").agg(F.sum("n").alias("all")).where(F.col("all") > hot_rows)
    return sizes.join(large.select("series_id"), "series_id", "left_semi")


def changes_by_calendar(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Month and year changes by date: against the same series 1 and 12 months earlier.

    One row per series and month, valued at the month's mean. The window comes
    after that aggregation, so a series of any size brings it at most twelve
    rows per year.
    """
    means = period_state(fact, c.month_start(F.col("date"))).select(
        "series_id", "date", (F.col("value_sum") / F.nullif("value_count", F.lit(0))).alias("value")
    )
    months = W.partitionBy("series_id").orderBy(c.month_index(F.col("date")))

    def earlier(n: int) -> Column:
        return F.max("value").over(months.rangeBetween(-n, -n))

    changes = means.select(
        "series_id",
        "date",
        "value",
        c.change(F.col("value"), earlier(1)).alias("mom_change_calendar"),
        c.change(F.col("value"), earlier(12)).alias("yoy_change_calendar"),
    )
    return named(changes, dim)
