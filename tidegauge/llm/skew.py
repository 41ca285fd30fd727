"""Joins on keys of which one may hold any share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is hot if it holds more than this part of the rows, so there are fewer hot keys than its inverse.
HOT = 1000


def attach(rows: DataFrame, values: DataFrame, key: str, count: str) -> DataFrame:
    """``rows`` with the columns of ``values``, which has one row for each key of ``rows`` (null is a key).

    ``count`` is the column of ``values`` with the number of rows of the key; it is dropped.
    Values of hot keys are broadcast, fewer than `HOT` rows whatever the tables hold; all
    others meet by a shuffle, in which no key is hot. Both tables are read twice.
    """
    total = values.agg(F.sum(count)).first()[0] or 0
    renamed = values.withColumnRenamed(key, "__key").withColumn("__hot", F.col(count) * HOT > total).drop(count)
    same = F.col(key).eqNullSafe(F.col("__key"))
    hot = F.broadcast(renamed.where("__hot"))
    usual = rows.join(hot.select("__key"), same, "left_anti").join(renamed.where("not __hot"), same)
    return usual.unionByName(rows.join(hot, same)).drop("__key", "__hot")
