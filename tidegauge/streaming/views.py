"""Incremental views.

Each micro-batch adds one run to a log (`sources.runs`): a replay adds nothing, runs are
merged by levels, and readers see whole states only. The views equal a batch run over all
rows, in whatever order they came.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DateType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from tidegauge.functions import columns as c
from tidegauge.operators.views import finish_state, merge_state, monthly_rows, named, period_state, row_changes
from tidegauge.schemas import FACT
from tidegauge.sources.runs import FANOUT, RunLog, Table
from tidegauge.sources.tables import write_by_year

OBSERVATION = StructType(FACT.fields[:4])  # the fact without load times

REACH = 12  # rows behind a row whose changes look back at it

_KEY = [StructField("series_id", StringType()), StructField("date", DateType())]
_YEAR = StructField("year", IntegerType())
_VALUE = StructField("value", DoubleType())
_STATE = StructType(
    [
        *_KEY,
        StructField("value_sum", DoubleType()),
        StructField("value_count", LongType()),
        StructField("value_min", DoubleType()),
        StructField("value_max", DoubleType()),
    ]
)
_COUNTS = StructType([_KEY[0], _YEAR, StructField("n", LongType())])
_CHANGES = StructType(
    [
        *_KEY,
        _VALUE,
        StructField("mom_change", DoubleType()),
        StructField("yoy_change", DoubleType()),
        StructField("batch_id", LongType()),
        _YEAR,
    ]
)


def observation_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """New Parquet files of observations as they land in a folder."""
    return spark.readStream.schema(OBSERVATION).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def _start(
    stream: DataFrame, checkpoint: str, on_batch: Callable[[DataFrame, int], None], available_now: bool
) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


# --- monthly and yearly aggregates --------------------------------------------


def _merged(states: DataFrame) -> DataFrame:
    return states.groupBy("series_id", "date").agg(*merge_state())


def period_log(spark: SparkSession, path: str, fanout: int = FANOUT) -> RunLog:
    return RunLog(spark, path, {"state": Table(_STATE, _merged)}, fanout)


def add_period_batch(log: RunLog, batch: DataFrame, batch_id: int, start: Callable[[Column], Column]) -> None:
    """Add the states of a batch, once."""
    if log.holds(batch_id):
        return
    run = log.begin(batch_id)
    log.write(run, "state", period_state(batch, start(F.col("date"))))
    log.commit(run)
    log.compact()


def maintain_periods(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    start: Callable[[Column], Column],
    available_now: bool = False,
    fanout: int = FANOUT,
) -> StreamingQuery:
    """Keep aggregate states per series and period (``month_start`` or ``year_start``)."""

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        add_period_batch(period_log(batch.sparkSession, path, fanout), batch, batch_id, start)

    return _start(stream, checkpoint, on_batch, available_now)


def read_periods(spark: SparkSession, path: str, dim: DataFrame) -> DataFrame:
    """The monthly or yearly view: all states of a series and period merged."""
    return named(finish_state(_merged(period_log(spark, path).read("state"))), dim)


# --- changes -------------------------------------------------------------------


def _newest(changes: DataFrame) -> DataFrame:
    """Of each series and date the rows of the batch that made them last; a batch makes all rows of a date."""
    last = changes.groupBy("series_id", "date").agg(F.max("batch_id").alias("batch_id"))
    return changes.join(last, ["series_id", "date", "batch_id"], "left_semi")


def _years_kept(df: DataFrame, path: str) -> None:
    write_by_year(df, path, whole=True)


def changes_log(spark: SparkSession, path: str, fanout: int = FANOUT) -> RunLog:
    counted = Table(_COUNTS, lambda counts: counts.groupBy("series_id", "year").agg(F.sum("n").alias("n")))
    rows = Table(StructType([*_KEY, _VALUE, _YEAR]), lambda rows: rows, _years_kept)
    changes = Table(_CHANGES, _newest, _years_kept)
    return RunLog(spark, path, {"rows": rows, "counts": counted, "changes": changes}, fanout)


def _years_needed(touched: DataFrame, counts: DataFrame) -> DataFrame:
    """(series_id, year): of touched series, the years that may hold the `REACH` rows before and after touched ones."""
    by_year = W.partitionBy("series_id").orderBy("year")
    totals = counts.groupBy("series_id", "year").agg(F.sum("n").alias("n"))
    totals = totals.join(touched.select("series_id").distinct(), "series_id", "left_semi")
    places = totals.withColumn("upto", F.sum("n").over(by_year)).withColumn("before", F.col("upto") - F.col("n"))
    of = touched.select("series_id", F.year("date").alias("at")).distinct()
    hit = places.join(of, "series_id").where("year = at").select("series_id", "at", F.col("before").alias("lead"), F.col("upto").alias("tail"))
    near = places.join(hit, "series_id")
    # Years that begin with no more than REACH rows between them and the touched year, or end so behind it.
    wanted = (F.col("upto") > F.col("lead") - REACH) & (F.col("before") < F.col("tail") + REACH)
    return near.where(wanted).select("series_id", "year").distinct()


def _affected(history: DataFrame, touched: DataFrame) -> DataFrame:
    """(series_id, date): touched dates, and those with a row that looks back at one of their rows."""
    dates = history.groupBy("series_id", "date").agg(F.count(F.lit(1)).alias("n"))
    marked = dates.join(touched.withColumn("hit", F.lit(True)), ["series_id", "date"], "left")
    by_date = W.partitionBy("series_id").orderBy("date")
    placed = marked.withColumn("upto", F.sum("n").over(by_date))
    last = F.last(F.when(F.col("hit"), F.col("upto")), ignorenulls=True).over(by_date)
    between = F.col("upto") - F.col("n") - last  # rows after the last touched date and before this one
    return placed.withColumn("between", between).where(F.col("hit") | (F.col("between") < REACH)).select("series_id", "date")


def add_changes_batch(log: RunLog, batch: DataFrame, batch_id: int) -> None:
    """Add a batch's rows, once, and make anew the changes that it affects, and only those.

    A late row is a base of the rows up to `REACH` places behind it. To know these and their
    own bases, only the years around the touched ones are read, as the counts of rows by
    series and year tell; written are the batch's rows and the affected dates of its series.
    """
    if log.holds(batch_id):
        return
    run = log.begin(batch_id)
    rows = log.write(run, "rows", monthly_rows(batch).select("series_id", "date", "value"))
    log.write(run, "counts", rows.groupBy("series_id", "year").agg(F.count(F.lit(1)).alias("n")))
    runs = [*log.state()[1], run]
    touched = rows.select("series_id", "date").distinct()
    needed = _years_needed(touched, log.read("counts", runs))
    years = [r.year for r in needed.select("year").distinct().collect()]  # as many as the calendar has
    history = log.read("rows", runs).where(F.col("year").isin(years)).join(needed, ["series_id", "year"], "left_semi")
    changes = row_changes(history.withColumn("is_annual_avg", F.lit(False)))
    made = changes.join(_affected(history, touched), ["series_id", "date"], "left_semi")
    log.write(run, "changes", made.withColumn("batch_id", F.lit(batch_id).cast("long")))
    log.commit(run)
    log.compact()


def maintain_changes(
    stream: DataFrame, path: str, checkpoint: str, available_now: bool = False, fanout: int = FANOUT
) -> StreamingQuery:
    """Keep the changes view at the cost of what is delivered."""

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        add_changes_batch(changes_log(batch.sparkSession, path, fanout), batch, batch_id)

    return _start(stream, checkpoint, on_batch, available_now)


def read_changes(spark: SparkSession, path: str, dim: DataFrame) -> DataFrame:
    """The changes view with the series' names."""
    changes = changes_log(spark, path).read("changes")
    return named(_newest(changes).drop("batch_id", "year"), dim)


MONTHLY, YEARLY = c.month_start, c.year_start
