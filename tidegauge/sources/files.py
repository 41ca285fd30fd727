"""The few file operations that Spark's readers and writers don't offer.

They go through the session's Hadoop file system, so paths are those Spark takes.
"""

import uuid

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def names(spark: SparkSession, folder: str) -> list[str]:
    """The entries of a folder in the order of their names, without hidden ones; none if there is no such folder."""
    files = _system(spark, folder)
    if not files.exists(_path(spark, folder)):
        return []
    found = [f.getPath().getName() for f in files.listStatus(_path(spark, folder))]
    return sorted(name for name in found if not name.startswith((".", "_")))


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file as a whole, unless there is one: false then, whoever was first.

    The text goes to a file of its own, which then takes the name; a rename that may not
    replace anything is what keeps two writers apart.
    """
    context = spark.sparkContext
    folder, _, name = path.rpartition("/")
    temporary = f"{folder}/.{name}-{uuid.uuid4().hex}"
    files = _system(spark, path)
    stream = files.create(_path(spark, temporary), True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    hadoop = context._jvm.org.apache.hadoop.fs
    rename = hadoop.FileContext.getFileContext(_path(spark, path).toUri(), context._jsc.hadoopConfiguration()).rename
    keep = context._gateway.new_array(hadoop.Options.Rename, 1)
    keep[0] = getattr(hadoop.Options.Rename, "NONE")
    try:
        rename(files.makeQualified(_path(spark, temporary)), files.makeQualified(_path(spark, path)), keep)
    except Exception as error:
        files.delete(_path(spark, temporary), False)
        if "AlreadyExists" in str(error):
            return False
        raise
    return True


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or folder; nothing happens if there is none."""
    _system(spark, path).delete(_path(spark, path), True)
