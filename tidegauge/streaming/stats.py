"""Series statistics and outliers kept current as observations land."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from tidegauge.operators.quality_raw import far_from_mean
from tidegauge.sources.runs import FANOUT, RunLog, Table
from tidegauge.sources.tables import write_by_year
from tidegauge.streaming.views import OBSERVATION

_NUMBERS = ["min_value", "max_value", "mean_value", "m2"]
MOMENTS = StructType(
    [
        StructField("series_id", StringType()),
        StructField("n_values", LongType()),
        *[StructField(name, DoubleType()) for name in _NUMBERS],
    ]
)
_MOMENT = "struct<n_values: bigint, min_value: double, max_value: double, mean_value: double, m2: double>"


def moments(observations: DataFrame) -> DataFrame:
    """Count, range, mean and sum of squared distances from the mean (``m2``) of each series' values."""
    state = observations.groupBy("series_id").agg(
        F.count("value").alias("n_values"),
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
        F.avg("value").alias("mean_value"),
        (F.var_pop("value") * F.count("value")).alias("m2"),
    )
    return state.select(*MOMENTS.fieldNames())


def _pair(a: Column, b: Column) -> Column:
    """Two states as one. The means are never squared, so large values with a small spread lose nothing."""
    n = a["n_values"] + b["n_values"]
    apart = b["mean_value"] - a["mean_value"]
    both = F.struct(
        n.alias("n_values"),
        F.least(a["min_value"], b["min_value"]).alias("min_value"),
        F.greatest(a["max_value"], b["max_value"]).alias("max_value"),
        (a["mean_value"] + apart * b["n_values"] / n).alias("mean_value"),
        (a["m2"] + b["m2"] + apart * apart * a["n_values"] * b["n_values"] / n).alias("m2"),
    )
    return F.when(a["n_values"] == 0, b).when(b["n_values"] == 0, a).otherwise(both)


def merge_moments(states: DataFrame) -> DataFrame:
    """One state per series, merged pair by pair; a series has one state in each run, and runs are few."""
    own = F.sort_array(F.collect_list(F.struct("n_values", *_NUMBERS)))
    nothing = F.struct(F.lit(0).cast("long").alias("n_values"), *[F.lit(None).cast("double").alias(x) for x in _NUMBERS])
    merged = states.groupBy("series_id").agg(F.aggregate(own, nothing.cast(_MOMENT), lambda a, b: _pair(a, b).cast(_MOMENT)).alias("s"))
    return merged.select("series_id", "s.*")


def stats_log(spark: SparkSession, path: str, fanout: int = FANOUT) -> RunLog:
    rows = StructType([*OBSERVATION.fields, StructField("year", IntegerType())])
    return RunLog(
        spark,
        path,
        {
            "rows": Table(rows, lambda rows: rows, lambda df, to: write_by_year(df, to, whole=True)),
            "moments": Table(MOMENTS, merge_moments),
        },
        fanout,
    )


def add_stats_batch(log: RunLog, batch: DataFrame, batch_id: int) -> None:
    """Add a batch's rows and their moments, once."""
    if log.holds(batch_id):
        return
    run = log.begin(batch_id)
    rows = log.write(run, "rows", batch.select(OBSERVATION.fieldNames()))
    log.write(run, "moments", moments(rows))
    log.commit(run)
    log.compact()


def read_stats(log: RunLog) -> DataFrame:
    """Range, mean, count and population deviation of every series, from the moments alone."""
    merged = merge_moments(log.read("moments"))
    deviation = F.sqrt(F.col("m2") / F.nullif("n_values", F.lit(0)))
    return merged.select("series_id", "min_value", "max_value", "mean_value", "n_values", deviation.alias("std_value"))


def read_outliers(log: RunLog, deviations: float = 3.0) -> DataFrame:
    """Observations far from the mean of their series as it is now: one scan, no statistics over rows."""
    return far_from_mean(log.read("rows").drop("year"), read_stats(log), deviations=deviations)
