"""Supply-chain stages: price pressure report, stage index and its yearly change."""

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from tidegauge.functions import columns as c
from tidegauge.operators.views import monthly_rows
from tidegauge.schemas import LOW_PRESSURE, MEDIUM_PRESSURE, STAGES
from tidegauge.sources.tables import latest_date, since


def stage_map(spark: SparkSession) -> DataFrame:
    """The fixed (raw_series_id, stage) table."""
    rows = [(series, stage) for stage, members in STAGES.items() for series in members]
    return spark.createDataFrame(rows, "raw_series_id string, stage string")


def stage_keys(dim: DataFrame, stages: DataFrame) -> DataFrame:
    """(series_id, raw_series_id, stage) of the series that belong to a stage."""
    return dim.select("series_id", "raw_series_id").join(stages, "raw_series_id")


def stage_observations(fact: DataFrame, dim: DataFrame, stages: DataFrame) -> DataFrame:
    """Monthly values of the stage series."""
    rows = monthly_rows(fact).select("series_id", "date", "value")
    return rows.join(stage_keys(dim, stages), "series_id").select("stage", "raw_series_id", "date", "value")


def pressure_level(yoy: Column) -> Column:
    return F.when(yoy <= LOW_PRESSURE, "Low").when(yoy <= MEDIUM_PRESSURE, "Medium").otherwise("High")


def stage_pressure(fact: DataFrame, dim: DataFrame, stages: DataFrame) -> DataFrame:
    """Mean year and month change per stage at the latest date, with a level.

    A series counts if it has rows at the latest date, one month and one year
    before. The three dates are read in one pass and summed per series, so the
    change over all (now, then) row pairs comes from sums: with copies of a row
    the pairs are weighted as a join would weight them, without forming them.
    """
    latest = latest_date(fact)
    date, value = F.col("date"), F.col("value")
    when = F.when(date == latest, "now").when(date == F.add_months(latest, -1), "month")
    when = when.when(date == F.add_months(latest, -12), "year")
    compared = since(monthly_rows(fact), F.add_months(latest, -12)).join(stage_keys(dim, stages), "series_id")
    rows = compared.select("stage", "series_id", "value", when.alias("when")).where(F.col("when").isNotNull())
    base = F.nullif(value, F.lit(0.0))

    def at(name: str, expression: Column) -> Column:
        return F.when(F.col("when") == name, expression)

    per_series = rows.groupBy("stage", "series_id").agg(
        F.count(at("now", F.lit(1))).alias("now_rows"),
        F.count(at("now", value)).alias("now_n"),
        F.sum(at("now", value)).alias("now_sum"),
        *[
            column
            for name in ("month", "year")
            for column in (
                F.count(at(name, F.lit(1))).alias(f"{name}_rows"),
                F.count(at(name, base)).alias(f"{name}_n"),
                F.sum(at(name, 1 / base)).alias(f"{name}_inverse"),
            )
        ],
    )
    complete = per_series.where("now_rows > 0 AND month_rows > 0 AND year_rows > 0")

    def mean_change(name: str, other: str) -> Column:
        pairs = F.col("now_n") * F.col(f"{name}_n")
        total = (F.col("now_sum") * F.col(f"{name}_inverse") - pairs) * 100
        weight = F.col(f"{other}_rows")
        return F.sum(total * weight) / F.nullif(F.sum(pairs * weight), F.lit(0))

    means = complete.groupBy("stage").agg(
        mean_change("year", "month").alias("yoy"), mean_change("month", "year").alias("mom")
    )
    return means.select(
        "stage",
        c.year_month(latest).alias("period"),
        F.round("yoy", 1).alias("yoy_change"),
        F.round("mom", 1).alias("mom_change"),
        pressure_level(F.col("yoy")).alias("pressure_level"),
    ).orderBy("stage")


def stage_index(fact: DataFrame, dim: DataFrame, stages: DataFrame) -> DataFrame:
    """Mean value of a stage's series per date."""
    return stage_observations(fact, dim, stages).groupBy("stage", "date").agg(F.avg("value").alias("index_value"))


def stage_yoy(index: DataFrame) -> DataFrame:
    """Percent change of the index against 12 rows earlier in the stage."""
    # The index has one row per stage and date, so the window stays small.
    earlier = F.lag("index_value", 12).over(W.partitionBy("stage").orderBy("date"))
    return index.withColumn("yoy_pct", c.change(F.col("index_value"), earlier) * 100)


def stage_yoy_wide(yoy: DataFrame, stages: list[str] | None = None) -> DataFrame:
    """The yearly changes with one column per stage, one row per date."""
    names = list(STAGES) if stages is None else stages
    wide = yoy.groupBy("date").pivot("stage", names).agg(F.max("yoy_pct"))
    return wide.withColumnsRenamed({name: name.lower().replace(" ", "_") for name in names})
