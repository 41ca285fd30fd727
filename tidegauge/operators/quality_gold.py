"""Checks on the gold tables and views."""

import functools

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidegauge.functions import columns as c
from tidegauge.operators.star import with_names
from tidegauge.operators.views import yearly_values
from tidegauge.schemas import ANNUAL_TOLERANCE
from tidegauge.sources.tables import latest_date, since


def date_coverage(fact: DataFrame) -> DataFrame:
    return fact.agg(
        F.min("date").alias("min_date"),
        F.max("date").alias("max_date"),
        F.count_distinct("date").alias("unique_dates"),
    )


def view_coverage(view: DataFrame) -> DataFrame:
    return view.agg(
        F.count("*").alias("total_records"), F.min("date").alias("min_date"), F.max("date").alias("max_date")
    )


def _null_columns() -> list[Column]:
    return [F.count("*").alias("total_values"), F.count_if(F.col("value").isNull()).alias("null_values")]


def _null_percentage(counts: DataFrame) -> DataFrame:
    share = F.round(c.percent(F.col("null_values"), F.col("total_values")), 2)
    return counts.withColumn("null_percentage", share)


def null_share(fact: DataFrame) -> DataFrame:
    return _null_percentage(fact.agg(*_null_columns()))


def cardinality(fact: DataFrame) -> DataFrame:
    return fact.agg(
        F.count_distinct("series_id").alias("unique_series"),
        F.count_distinct("date").alias("unique_dates"),
        F.count("*").alias("total_values"),
    )


def nulls_by_series(fact: DataFrame) -> DataFrame:
    counts = fact.groupBy("series_id").agg(
        F.count("*").alias("total_rows"), F.count_if(F.col("value").isNull()).alias("null_values")
    )
    return counts.where(F.col("null_values") > 0)


def annual_rows_by_indicator(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Indicators with annual averages, and how many of their rows those are."""
    by_series = fact.groupBy("series_id").agg(
        F.count("*").alias("n"), F.sum(F.col("is_annual_avg").cast("int")).alias("n_annual")
    )
    by_name = with_names(by_series, dim, "indicator_name").groupBy("indicator_name")
    totals = by_name.agg(F.sum("n").alias("total_rows"), F.sum("n_annual").alias("annual_avg_rows"))
    return totals.where(F.col("annual_avg_rows") > 0)


def view_profile(views: dict[str, DataFrame]) -> DataFrame:
    """Rows and distinct dates per indicator, for each named view: one aggregation over all of them."""
    named = [view.select(F.lit(name).alias("view_name"), "indicator_name", "date") for name, view in views.items()]
    return (
        functools.reduce(DataFrame.unionByName, named)
        .groupBy("view_name", "indicator_name")
        .agg(F.count("*").alias("total_rows"), F.count_distinct("date").alias("unique_dates"))
    )


def gold_keys(dim: DataFrame, fact: DataFrame, monthly: DataFrame, changes: DataFrame) -> dict[str, tuple[DataFrame, list[str]]]:
    """The keys that must be unique, by the name of their check."""
    key = ["series_id", "date"]
    return {
        "metadata_raw_series_id": (dim, ["raw_series_id"]),
        "values_series_date": (fact, key),
        "monthly_series_date": (monthly, key),
        "changes_series_date": (changes, key),
    }


def duplicate_keys(tables: dict[str, tuple[DataFrame, list[str]]], top: int = 5) -> DataFrame:
    """The ``top`` most repeated keys of each table, given as check name: (table, key columns).

    Every row is tagged with its check, and one aggregation counts all keys of all checks;
    of each check only the first ``top`` of a task travel on. Checks of one table share its scan.
    """
    shared: list[tuple[DataFrame, dict[str, list[str]]]] = []
    for name, (table, keys) in tables.items():
        known = next((checks for other, checks in shared if other is table), None)
        if known is None:
            shared.append((table, {name: keys}))
        else:
            known[name] = keys
    # Keys stay lists, so that a missing part and where a part ends tell them apart.
    tagged = [
        table.select(
            F.explode(
                F.array(
                    *[
                        F.struct(F.lit(name).alias("check_name"), F.array(*[F.col(k).cast("string") for k in keys]).alias("parts"))
                        for name, keys in checks.items()
                    ]
                )
            ).alias("tag")
        ).select("tag.*")
        for table, checks in shared
    ]
    counts = functools.reduce(DataFrame.unionByName, tagged).groupBy("check_name", "parts").agg(F.count("*").alias("n_rows"))
    key = F.array_join("parts", "|", "null")
    groups = counts.where(F.col("n_rows") > 1).select("check_name", key.alias("key"), "n_rows")
    turn = F.row_number().over(W.partitionBy("check_name").orderBy(F.desc("n_rows"), "key"))
    return groups.withColumn("_turn", turn).where(F.col("_turn") <= top).drop("_turn")


def recent_nulls(fact: DataFrame, dim: DataFrame, months: int = 3) -> DataFrame:
    """Indicators with missing values in the last months before the latest date."""
    recent = since(fact, F.add_months(latest_date(fact), -months))
    by_series = recent.groupBy("series_id").agg(*_null_columns())
    totals = (
        with_names(by_series, dim, "indicator_name", "industry_name")
        .groupBy("indicator_name", "industry_name")
        .agg(F.sum("total_values").alias("total_values"), F.sum("null_values").alias("null_values"))
    )
    return _null_percentage(totals).where("null_percentage > 0").orderBy(F.desc("null_percentage"), "indicator_name")


def annual_comparison(fact: DataFrame) -> DataFrame:
    """Provided annual averages next to those computed from the monthly values."""
    provided = fact.where("is_annual_avg").select(
        "series_id", c.year_start(F.col("date")).alias("year"), F.col("value").alias("provided_annual_value")
    )
    computed = yearly_values(fact).select("series_id", F.col("date").alias("year"), "calculated_annual_value")
    difference = F.abs(F.col("provided_annual_value") - F.col("calculated_annual_value"))
    return (
        provided.join(computed, ["series_id", "year"])
        .withColumn("difference", difference)
        .withColumn("percent_difference", c.percent(F.col("difference"), F.col("provided_annual_value")))
    )


def annual_mismatches(fact: DataFrame, dim: DataFrame, tolerance: float = ANNUAL_TOLERANCE) -> DataFrame:
    differing = annual_comparison(fact).where(F.col("difference") > tolerance)
    return with_names(differing, dim, "indicator_name", "source").select(
        "indicator_name",
        "source",
        "year",
        "provided_annual_value",
        "calculated_annual_value",
        "difference",
        "percent_difference",
    ).orderBy(F.desc("percent_difference"))


def annual_summary(fact: DataFrame, tolerance: float = ANNUAL_TOLERANCE) -> DataFrame:
    return annual_comparison(fact).agg(
        F.count("*").alias("total_comparisons"),
        F.count_if(F.col("difference") > tolerance).alias("mismatches"),
        F.avg("percent_difference").alias("avg_percent_difference"),
    )
