"""Silver snapshots: one folder per run under a common root."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidegauge.schemas import SILVER, SILVER_METADATA


def finished_runs(spark: SparkSession, root: str, name: str) -> list[str]:
    """The runs ``name=...`` under ``root`` whose writing came to its end, the last written last.

    The mark that a write leaves at its end tells both; a run that broke off, or is under way, has none.
    """
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/{name}=*/_SUCCESS")
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    marks = [(f.getModificationTime(), f.getPath().getParent().getName()) for f in files.globStatus(folder) or []]
    return [run.removeprefix(f"{name}=") for _, run in sorted(marks)]


def write_snapshot(silver: DataFrame, root: str, stamp: str) -> None:
    """Write observations as the snapshot ``stamp``; writing it again replaces it."""
    typed = silver.select(*[F.col(f.name).cast(f.dataType) for f in SILVER])
    typed.write.mode("overwrite").option("compression", "snappy").parquet(f"{root}/snapshot={stamp}")


def newest_snapshot(spark: SparkSession, root: str) -> DataFrame:
    """Observations of the snapshot written last; one without rows counts as well.

    Times and names come from the folder's listing, so no file is opened for them.
    """
    runs = finished_runs(spark, root, "snapshot")
    if not runs:
        raise ValueError(f"no snapshot in {root}")
    return spark.read.schema(SILVER).parquet(f"{root}/snapshot={runs[-1]}")


def write_metadata(metadata: DataFrame, path: str) -> None:
    metadata.write.mode("overwrite").option("compression", "snappy").parquet(path)


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SILVER_METADATA).parquet(path)
