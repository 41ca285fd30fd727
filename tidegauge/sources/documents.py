"""Raw series documents.

Four shapes occur, one JSON object each:

* ``{"seriesID": id, "data": [point, ...]}``
* ``{"series_id": id, "data": [point, ...]}``
* any object with a non-empty list: the first one holds the points and the id
  is the last ``_`` part of the file's stem
* a consolidated object ``{id: {"series_type": t, "data": document}, ...}``, in the
  consolidated file of any size

A document may say in ``delivered`` when it was delivered (text that sorts by time).
"""

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidegauge.schemas import BOOKKEEPING_FILES, CONSOLIDATED_FILE, POINT
from tidegauge.sources.objects import read_entries

JSON_FILES = "{*.json,part-*.txt}"  # Spark's text writer names its parts .txt
_HEAD = "seriesID string, series_id string, data variant, delivered string"
_ENTRY = "struct<series_type: string, delivered: string, data: struct<seriesID: string, data: variant>>"
_POINTS = f"array<{POINT.simpleString()}>"


def read_json_text(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Objects as text with file name and time; one per file, or one per line.

    ``part`` tells objects of one file apart. The consolidated file is one object of any
    size, over one line or many: it is read in splits and gives an object for each entry.
    """
    text = spark.read.option("pathGlobFilter", JSON_FILES).text(path, wholetext=not lines)
    name = F.col("_metadata.file_name")
    objects = text.where(~name.isin(*BOOKKEEPING_FILES, CONSOLIDATED_FILE)).select(
        F.col("value").alias("json"),
        name.alias("file"),
        F.col("_metadata.file_modification_time").alias("modified"),
        F.monotonically_increasing_id().alias("part"),
    )
    consolidated = spark.read.option("pathGlobFilter", CONSOLIDATED_FILE).text(path)
    if not consolidated.inputFiles():
        return objects
    return objects.unionByName(read_entries(spark, path, CONSOLIDATED_FILE))


def _is_list(value: Column) -> Column:
    return F.schema_of_variant(value).startswith("ARRAY<")


def shape_documents(text: DataFrame) -> DataFrame:
    """(file, modified, part, readable, series_id, series_type, delivered, is_list, data) of JSON objects.

    ``data`` is JSON text. An object that is no JSON or fits no shape gives one
    row without ``series_id``, so that checks see it.
    """
    stem = F.regexp_extract("file", r"([^_]*?)(\.[^.]*)?$", 1)
    nothing = F.lit(None).cast("string")

    def document(series_id, series_type, delivered, data):
        return F.struct(
            series_id.alias("series_id"),
            series_type.alias("series_type"),
            delivered.alias("delivered"),
            _is_list(data).alias("is_list"),
            F.to_json(data).alias("data"),
        )

    # Field order of the object matters for the third shape, so it is read as a map.
    fields = F.map_entries(F.from_json("json", "map<string, variant>"))
    lists = F.filter(fields, lambda e: _is_list(e["value"]) & (F.schema_of_variant(e["value"]) != "ARRAY<VOID>"))
    first_list = F.get(lists, 0)["value"]
    inner = F.filter(F.map_entries(F.from_json("json", f"map<string, {_ENTRY}>")), lambda e: e["value"]["data"].isNotNull())

    def entry(e):
        return document(e["key"], e["value"]["series_type"], e["value"]["delivered"], e["value"]["data"]["data"])

    headed = F.coalesce(F.col("head.seriesID"), F.col("head.series_id"))
    delivered, data = F.col("head.delivered"), F.col("head.data")
    found = (
        F.when(headed.isNotNull(), F.array(document(headed, nothing, delivered, data)))
        .when(F.size(inner) > 0, F.transform(inner, entry))
        .when(first_list.isNotNull(), F.array(document(stem, nothing, delivered, first_list)))
        .otherwise(F.array(document(nothing, nothing, delivered, data)))
    )
    return (
        text.withColumn("head", F.from_json("json", _HEAD))
        .withColumn("readable", F.try_parse_json("json").isNotNull())
        .select("file", "modified", "part", "readable", F.explode(found).alias("doc"))
        .select("file", "modified", "part", "readable", "doc.*")
    )


def parse_documents(text: DataFrame) -> DataFrame:
    """(file, modified, delivered, series_id, series_type, data) of the objects that fit a shape."""
    found = shape_documents(text).where("series_id IS NOT NULL")
    return found.select("file", "modified", "delivered", "series_id", "series_type", "data")


def with_points(documents: DataFrame) -> DataFrame:
    """Documents with their points parsed; data that is no list gives none."""
    points = F.coalesce(F.from_json("data", _POINTS), F.array().cast(_POINTS))
    return documents.withColumn("points", points).drop("data")


def read_consolidated(spark: SparkSession, path: str, names: str = CONSOLIDATED_FILE) -> DataFrame:
    """Series documents of consolidated objects, which several tasks may read from one file."""
    return with_points(parse_documents(read_entries(spark, path, names)))


def read_series_documents(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Series documents of a folder; one level of subfolders where it holds none itself."""
    found = parse_documents(read_json_text(spark, path, lines))
    if found.isEmpty():
        try:
            found = parse_documents(read_json_text(spark, f"{path.rstrip('/')}/*/", lines))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    return with_points(found)


def latest_per_series(documents: DataFrame) -> DataFrame:
    """The last document of each series, exactly one.

    What was delivered last counts, then the file written last, then the file's
    name; of documents that still tie, the one with the largest hash. Only these
    are aggregated: a document moves at most once, and a series with any number
    of versions never meets whole in one task.
    """
    version = F.struct("delivered", "modified", "file", F.xxhash64("points").alias("hash"))
    versions = documents.withColumn("_version", version)
    newest = versions.groupBy("series_id").agg(F.max("_version").alias("_version"))
    same = (versions["series_id"] == newest["series_id"]) & versions["_version"].eqNullSafe(newest["_version"])
    return versions.join(newest, same, "left_semi").drop("_version").dropDuplicates(["series_id"])


def _delivered(documents: DataFrame) -> list[Column]:
    return [F.col("delivered")] if "delivered" in documents.columns else []


def write_documents(
    documents: DataFrame, path: str, id_field: str = "seriesID", mode: str = "errorifexists"
) -> None:
    """Write (series_id, points) as one JSON document per line, with ``delivered`` if there is such a column."""
    named = [F.col("series_id").alias(id_field), F.col("points").alias("data"), *_delivered(documents)]
    documents.select(*named).write.mode(mode).json(path)


def write_consolidated(documents: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write (series_id, series_type, points) as consolidated objects, one series per line, with ``delivered`` likewise."""
    document = F.struct(F.col("series_id").alias("seriesID"), F.col("points").alias("data"))
    entry = F.struct("series_type", *_delivered(documents), document.alias("data"))
    line = F.to_json(F.create_map("series_id", entry))
    documents.select(line.alias("value")).write.mode(mode).text(path)
