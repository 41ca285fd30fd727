"""Session settings and the shared scratch folder."""

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from tidegauge.sources.files import delete


def local_session(cores: int | str = "*", app: str = "tidegauge", **conf: str) -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder for one run, inside the folder all executors share.

    The cluster names that folder in ``spark.checkpoint.dir``. Only a local
    session, whose executors are this machine, may do without.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="tidegauge-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
    made = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _made.append(made)
    return made


_made: list[str] = []


def clear_scratch(spark: SparkSession) -> None:
    """Delete the folders that `scratch` has named so far; for when the results made from them are written."""
    while _made:
        delete(spark, _made.pop())


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a scratch folder and read back, so that it is computed once."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
