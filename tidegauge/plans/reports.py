"""Named end-user queries over the gold tables and views."""

import datetime as dt

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidegauge.operators.star import with_names
from tidegauge.sources.tables import latest_date, newest_first, since


def latest_like(fact: DataFrame, dim: DataFrame, pattern: str, top: int = 10) -> DataFrame:
    """The latest values of indicators whose name matches, with their metadata; older years are read only if needed."""
    named = dim.where(F.col("indicator_name").like(pattern))
    attributes = ["indicator_name", "source", "industry_name", "seasonal_adjustment"]

    def report(rows: DataFrame) -> DataFrame:
        return (
            with_names(rows, named, *attributes)
            .select("series_id", "date", "value", "is_annual_avg", *attributes)
            .orderBy(F.desc("date"), "series_id", "is_annual_avg", "value")
            .limit(top)
        )

    return newest_first(fact, report, top)


def monthly_recent(monthly: DataFrame, dim: DataFrame, start: dt.date, top: int = 20) -> DataFrame:
    """Monthly averages from a date on, newest first."""

    def report(part: DataFrame) -> DataFrame:
        view = since(part, start).select("series_id", "date", "avg_value", "min_value", "max_value")
        rows = with_names(view, dim, "indicator_name", "industry_name")
        return rows.orderBy(F.desc("date"), "indicator_name", "series_id").limit(top)

    return newest_first(monthly, report, top)


def values_recent(fact: DataFrame, dim: DataFrame, start: dt.date, top: int = 20) -> DataFrame:
    """Values from a date on, newest first."""

    def report(part: DataFrame) -> DataFrame:
        view = since(part, start).select("series_id", "date", "value", "is_annual_avg")
        rows = with_names(view, dim, "indicator_name", "industry_name")
        return rows.orderBy(F.desc("date"), "indicator_name", "series_id", "is_annual_avg", "value").limit(top)

    return newest_first(fact, report, top)


def _percent(change: str) -> Column:
    return F.round(F.col(change) * 100, 2)


def latest_changes(changes: DataFrame) -> DataFrame:
    """Rows of the changes view at its latest date."""
    latest = latest_date(changes)
    return since(changes, latest).where(F.col("date") == latest)


def latest_changes_top(changes: DataFrame, dim: DataFrame, top: int = 10) -> DataFrame:
    """The largest yearly changes at the latest date."""
    rows = latest_changes(changes).select("series_id", "date", "value", "mom_change", "yoy_change")
    return (
        with_names(rows, dim, "indicator_name", "industry_name")
        .select(
            "series_id",
            "indicator_name",
            "industry_name",
            "date",
            "value",
            _percent("mom_change").alias("mom_change_pct"),
            _percent("yoy_change").alias("yoy_change_pct"),
        )
        .orderBy(F.desc(F.abs("yoy_change_pct")), "series_id")
        .limit(top)
    )


def _last_months(fact: DataFrame, dim: DataFrame, pattern: str, months: int) -> DataFrame:
    recent = since(fact, F.add_months(latest_date(fact), -months))
    named = dim.where(F.col("indicator_name").like(pattern))
    return with_names(recent, named, "indicator_name", "industry_name").select(
        "series_id", "indicator_name", "industry_name", "date", "value", "is_annual_avg"
    )


def _first_value() -> Column:
    return F.min_by("value", F.struct("date", "series_id", "is_annual_avg", "value"))


def _from_start(start: Column) -> Column:
    return F.round((F.col("value") / F.nullif(start, F.lit(0.0)) - 1) * 100, 2)


def last_12_months(fact: DataFrame, dim: DataFrame, pattern: str, months: int = 12) -> DataFrame:
    """Values of the last months against the very first of them, in percent.

    The first value over one global order is an aggregate, not a window: a
    window without a key would put all rows into one task.
    """
    rows = _last_months(fact, dim, pattern, months)
    start = rows.agg(_first_value().alias("v")).scalar()
    return rows.withColumn("change_from_start_pct", _from_start(start))


def last_12_months_by_series(fact: DataFrame, dim: DataFrame, pattern: str, months: int = 12) -> DataFrame:
    """The same with each series against its own first value."""
    rows = _last_months(fact, dim, pattern, months)
    starts = rows.groupBy("series_id").agg(_first_value().alias("_start"))
    changed = rows.join(starts, "series_id").withColumn("change_from_start_pct", _from_start(F.col("_start")))
    return changed.drop("_start")


def cross_indicator_pairs(changes: DataFrame, dim: DataFrame, top: int = 10) -> DataFrame:
    """The series pairs whose latest yearly changes differ most; pairs without a difference come last.

    A pair among the ``top`` joins a series from the top + 1 highest with one
    from the top + 1 lowest: had either more than ``top`` series before it, each
    of those would give a pair at least as far apart and earlier in the order.
    So the pairs come from a few extreme series instead of all series.
    """
    rows = latest_changes(changes).select("series_id", "date", "yoy_change")
    known = rows.where("yoy_change IS NOT NULL")
    extreme = _extreme(known, F.desc("yoy_change"), F.max, top).unionByName(
        _extreme(known, F.asc("yoy_change"), F.min, top)
    )
    # A row that is extreme both ways must not count twice; its copies must stay.
    kept = extreme.groupBy("series_id", "date", "yoy_change", "_copy").agg(F.lit(1))
    apart = _pairs(kept, dim)
    open_ended = _pairs(_first_with_gaps(rows, top), dim).where("yoy1 IS NULL OR yoy2 IS NULL")
    difference = F.col("yoy1") - F.col("yoy2")
    order = [F.desc_nulls_last(F.abs(difference)), F.asc("series1"), F.asc("series2")]
    first = [pairs.orderBy(*order).limit(top) for pairs in (apart, open_ended)]
    return (
        first[0]
        .unionByName(first[1])
        .orderBy(*order)
        .limit(top)
        .select(
            "series1",
            "series2",
            "indicator1",
            "indicator2",
            _percent("yoy1").alias("indicator1_yoy_change"),
            _percent("yoy2").alias("indicator2_yoy_change"),
            F.round(difference * 100, 2).alias("change_difference"),
        )
    )


def _pairs(rows: DataFrame, dim: DataFrame) -> DataFrame:
    """All pairs of a few rows, the smaller series first."""
    a = with_names(rows, dim, "indicator_name").select(
        F.col("series_id").alias("series1"),
        "date",
        F.col("yoy_change").alias("yoy1"),
        F.col("indicator_name").alias("indicator1"),
    )
    b = a.select(
        F.col("series1").alias("series2"), "date", F.col("yoy1").alias("yoy2"), F.col("indicator1").alias("indicator2")
    )
    return a.join(b, "date").where("series1 < series2")


def _first_with_gaps(rows: DataFrame, top: int) -> DataFrame:
    """Rows that can make the first ``top`` pairs without a difference.

    Such pairs come in the order of their series. The first series of each is
    among the ``top`` smallest, its partner within the ``top`` series behind it
    or the ``top`` behind it that lack a change.
    """
    unknown = F.col("yoy_change").isNull()
    series = rows.groupBy("series_id").agg(F.bool_or(unknown).alias("_lacks"))
    most = 2 * top + 1
    first = series.orderBy("series_id").limit(most).unionByName(series.where("_lacks").orderBy("series_id").limit(most))
    near = rows.join(first.select("series_id").distinct(), "series_id", "left_semi")
    rank = F.row_number().over(W.partitionBy("series_id", unknown).orderBy("yoy_change"))
    return near.withColumn("_rank", rank).where(F.col("_rank") <= top).drop("_rank")


def _extreme(rows: DataFrame, order: Column, best, top: int) -> DataFrame:
    """Up to ``top`` rows each of the top + 1 series that come first in ``order``."""
    value = F.asc("_best") if best is F.min else F.desc("_best")
    series = rows.groupBy("series_id").agg(best("yoy_change").alias("_best"))
    first = series.orderBy(value, "series_id").limit(top + 1).select("series_id")
    rank = F.row_number().over(W.partitionBy("series_id").orderBy(order))
    ranked = rows.join(first, "series_id", "left_semi").withColumn("_rank", rank).where(F.col("_rank") <= top)
    copy = F.row_number().over(W.partitionBy("series_id", "date", "yoy_change").orderBy("_rank"))
    return ranked.withColumn("_copy", copy).drop("_rank")
