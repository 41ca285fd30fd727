"""Entries of one JSON object that is too large for a task, whatever its line breaks.

The file is read in splits like any text, in pieces that end with a closing brace. What a
piece does to a reader is a small function: it may turn the reader from outside to inside a
text literal or back (an odd number of quotes), and it changes the depth of brackets by one
number if the reader comes from outside, by another if from inside. These functions compose,
so a reader's state at any piece is a sum over the pieces before it: first within each
split, then over the splits of a file, which are few. An entry ends where the depth comes
back to one; an entry that a split cuts is put together from its fragments.

Every piece moves once, to the window over its split. A split is no larger than
``spark.sql.files.maxPartitionBytes`` says; only an entry itself has to fit into a row.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from tidegauge.session import stored

END = "}"  # of a piece; the only bracket that can close an entry


def _pieces(spark: SparkSession, path: str, names: str) -> DataFrame:
    """(path, block, seq, file, modified, size, text, bytes, quotes, from_outside, from_inside) of all pieces."""
    text = spark.read.option("pathGlobFilter", names).option("lineSep", END).text(path)
    pieces = text.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),  # ascends within a split
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.file_modification_time").alias("modified"),
        F.col("_metadata.file_size").alias("size"),
        F.concat("value", F.lit(END)).alias("text"),
    )
    # Between quotes that no backslash escapes, every other part is inside a literal.
    parts = F.split(F.regexp_replace("text", r"(?s)\\.", ""), '"', -1)
    return pieces.withColumns(
        {
            "bytes": F.octet_length("text"),
            "quotes": F.size(parts) - 1,
            "from_outside": _depth(F.filter(parts, lambda _, i: i % 2 == 0)),
            "from_inside": _depth(F.filter(parts, lambda _, i: i % 2 == 1)),
        }
    )


def _depth(parts: Column) -> Column:
    """Brackets opened less brackets closed."""
    text = F.array_join(parts, "")
    return F.length(F.translate(text, "}]", "")) - F.length(F.translate(text, "{[", ""))


def _before(value: Column | str, window) -> Column:
    return F.coalesce(F.sum(value).over(window.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))


def _within_splits(pieces: DataFrame) -> DataFrame:
    """Pieces with what their split did before them, if it began outside a literal and if inside."""
    split = W.partitionBy("path", "block").orderBy("seq")
    turned = pieces.withColumn("turned", _before("quotes", split) % 2 == 1)
    changes = turned.withColumns(
        {
            "change_outside": F.when(F.col("turned"), F.col("from_inside")).otherwise(F.col("from_outside")),
            "change_inside": F.when(F.col("turned"), F.col("from_outside")).otherwise(F.col("from_inside")),
        }
    )
    return changes.withColumns(
        {
            "depth_outside": _before("change_outside", split),
            "depth_inside": _before("change_inside", split),
            "read": _before("bytes", split),
        }
    )


def _splits(within: DataFrame) -> DataFrame:
    """(path, block, inside, depth, split_bytes, cut_off): the reader's state at the start of each split.

    ``cut_off``: the file's last piece, which is in this split, ends with the file and not with a brace.
    """
    totals = within.groupBy("path", "block").agg(
        F.sum("quotes").alias("quotes"),
        F.sum("change_outside").alias("change_outside"),
        F.sum("change_inside").alias("change_inside"),
        F.sum("bytes").alias("split_bytes"),
        F.max("size").alias("size"),
    )
    file, whole = W.partitionBy("path").orderBy("block"), W.partitionBy("path")
    inside = totals.withColumn("inside", _before("quotes", file) % 2 == 1)
    change = F.when(F.col("inside"), F.col("change_inside")).otherwise(F.col("change_outside"))
    last = F.col("block") == F.max("block").over(whole)
    cut_off = last & (F.sum("split_bytes").over(whole) > F.col("size"))
    return inside.select(
        "path", "block", "inside", _before(change, file).alias("depth"), "split_bytes", cut_off.alias("cut_off")
    )


def _fragments(within: DataFrame, splits: DataFrame) -> DataFrame:
    """Pieces of a split put together, cut behind each entry: (path, block, number, ended, opens, closes, text, ...)."""
    pieces = within.join(splits, ["path", "block"])
    inside = F.col("inside") != F.col("turned")
    start = F.col("depth") + F.when(F.col("inside"), F.col("depth_inside")).otherwise(F.col("depth_outside"))
    depth = start + F.when(inside, F.col("from_inside")).otherwise(F.col("from_outside"))
    braceless = F.col("cut_off") & (F.col("read") + F.col("bytes") == F.col("split_bytes"))
    outside = inside == (F.col("quotes") % 2 == 1)  # at the closing brace
    text = F.when(braceless, F.expr("substr(text, 1, length(text) - 1)")).otherwise(F.col("text"))
    marked = pieces.select(
        "path", "block", "seq", "file", "modified", text.alias("text"),
        (outside & (depth == 1) & ~braceless).alias("ends"),
        (outside & (depth == 0) & ~braceless).alias("closes"),
        ((F.col("block") == 0) & (F.col("read") == 0)).alias("opens"),
    )
    number = _before(F.col("ends").cast("int"), W.partitionBy("path", "block").orderBy("seq"))
    return (
        marked.withColumn("number", number)
        .groupBy("path", "block", "number")
        .agg(
            F.any_value("file").alias("file"),
            F.any_value("modified").alias("modified"),
            F.bool_or("ends").alias("ended"),
            F.bool_or("opens").alias("opens"),
            F.bool_or("closes").alias("closes"),
            F.array_join(F.sort_array(F.collect_list(F.struct("seq", "text")))["text"], "").alias("text"),
        )
    )


def _joined(fragments: DataFrame) -> DataFrame:
    """Entries that splits cut, put together."""
    places = fragments.select("path", "block", "number", "ended")
    entry = _before(F.col("ended").cast("int"), W.partitionBy("path").orderBy("block", "number"))
    named = fragments.join(places.select("path", "block", "number", entry.alias("entry")), ["path", "block", "number"])
    return named.groupBy("path", "entry").agg(
        F.any_value("file").alias("file"),
        F.any_value("modified").alias("modified"),
        F.bool_or("opens").alias("opens"),
        F.bool_or("closes").alias("closes"),
        F.array_join(F.sort_array(F.collect_list(F.struct("block", "number", "text")))["text"], "").alias("text"),
    )


def read_entries(spark: SparkSession, path: str, names: str) -> DataFrame:
    """(json, file, modified, part): each entry of the objects in the files ``names`` of a folder, as an object of its own.

    Members that are no objects stay with the entry behind them, those at the end make
    one of their own. What follows the last whole entry of a file that breaks off is an
    object that can't be read.
    """
    within = _within_splits(_pieces(spark, path, names))
    splits = stored(_splits(within), "splits")
    fragments = stored(_fragments(within, splits).withColumn("whole", (F.col("number") > 0) & F.col("ended")), "fragments")
    columns = ["file", "modified", "opens", "closes", "text"]
    found = fragments.where("whole").select(*columns).unionByName(_joined(fragments.where("NOT whole")).select(*columns))
    inner = F.when(F.col("opens"), F.regexp_replace("text", r"^\s*\{", "")).otherwise(F.col("text"))
    inner = F.when(F.col("closes"), F.regexp_replace(inner, r"\}\s*$", "")).otherwise(inner)
    entries = found.withColumn("inner", F.regexp_replace(inner, r"^[\s,]+", "")).where("inner <> ''")
    json = F.concat(F.lit("{"), F.col("inner"), F.lit("}"))
    return entries.select(json.alias("json"), "file", "modified", F.monotonically_increasing_id().alias("part"))
