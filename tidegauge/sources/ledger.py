"""The extraction ledger: what became of each requested series."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidegauge.schemas import LEDGER

_STORED = T.StructType([*LEDGER.fields, T.StructField("request", T.StringType())])


def write_ledger(entries: DataFrame, path: str, request: str) -> None:
    """Enter what became of one request; entering it again replaces it. Requests sort by time."""
    entries.select(LEDGER.fieldNames()).write.mode("overwrite").json(f"{path}/request={request}")


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The last entry of each series: by request, then success before error. No ledger yet is an empty one."""
    try:
        entries = spark.read.schema(_STORED).json(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)
    order = F.struct("request", F.col("status") == "success", "status", "error")
    entry = F.struct("status", "error", "series_type")
    last = entries.groupBy("series_id").agg(F.max_by(entry, order).alias("entry"))
    return last.select("series_id", "entry.*")
