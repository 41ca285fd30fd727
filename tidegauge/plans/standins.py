"""Stand-ins for bronze, silver and gold inputs, derived from the order tables.

A part brand plays the series: its monthly value is the mean line price, its
annual row the mean over the year's lines. Defects are put in by rule, from the
number of lines behind a cell, so that every check has something to find.
"""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidegauge.functions import columns as c
from tidegauge.schemas import NOT_FOUND

LAST_FULL_YEAR = 2000
STAGE_NAMES = ["Stage 1", "Stage 2", "Stage 3", "Stage 4"]


# The columns used, so that opening a table needs no look at its files.
COLUMNS = {
    "lineitem": "l_partkey bigint, l_extendedprice double, l_shipdate timestamp_ntz",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(COLUMNS[name]).parquet(f"{sf_dir}/{name}.parquet")


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(brand, month, cents, n): price sum in whole cents and line count."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_partkey",
        c.month_start(F.col("l_shipdate").cast("date")).alias("month"),
        F.floor(F.col("l_extendedprice") * 100 + 0.5).alias("cents"),
    )
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("brand"))
    return lines.join(parts, "l_partkey").groupBy("brand", "month").agg(
        F.sum("cents").alias("cents"), F.count("*").alias("n")
    )


def _mean(cents: Column, n: Column) -> Column:
    return cents / F.lit(100.0) / n


def _with_years(cell: DataFrame) -> DataFrame:
    """Cells by (brand, date, annual): the months and, for complete years, their sum.

    Every month is sent to itself and to its year, so both come from one scan.
    """
    itself = F.struct(F.col("month").alias("date"), F.lit(False).alias("annual"))
    december = F.make_date(F.year("month"), F.lit(12), F.lit(1))
    year = F.struct(december.alias("date"), F.lit(True).alias("annual"))
    targets = F.when(F.year("month") <= LAST_FULL_YEAR, F.array(itself, year)).otherwise(F.array(itself))
    sent = cell.select("brand", "cents", "n", F.explode(targets).alias("to")).select("brand", "cents", "n", "to.*")
    return sent.groupBy("brand", "date", "annual").agg(F.sum("cents").alias("cents"), F.sum("n").alias("n"))


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact: monthly values and, for complete years, annual averages."""
    return _with_years(cells(spark, sf_dir)).select(
        c.surrogate_id(F.col("brand")).alias("series_id"),
        "date",
        _mean(F.col("cents"), F.col("n")).alias("value"),
        F.col("annual").alias("is_annual_avg"),
    )


def obs_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact with nulls, gaps and repeated months."""
    n, mean = F.col("n"), _mean(F.col("cents"), F.col("n"))
    kept = F.when(n % 11 != 0, F.array(F.when(n % 7 != 0, mean))).otherwise(F.array().cast("array<double>"))
    copy = F.when(n % 13 == 0, F.array(mean)).otherwise(F.array().cast("array<double>"))
    return cells(spark, sf_dir).select(
        c.surrogate_id(F.col("brand")).alias("series_id"),
        F.col("month").alias("date"),
        F.explode(F.concat(kept, copy)).alias("value"),
        F.lit(False).alias("is_annual_avg"),
    )


def _number_of(brand: Column) -> Column:
    return F.substring(brand, 7, 9).cast("int")


def dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dimension: a row per brand."""
    brands = table(spark, sf_dir, "part").groupBy("p_brand").agg(F.min("p_type").alias("industry_name"))
    prefix = F.when(_number_of(F.col("p_brand")) % 2 == 0, "PPI ").otherwise("Index ")
    return brands.select(
        c.surrogate_id(F.col("p_brand")).alias("series_id"),
        F.col("p_brand").alias("raw_series_id"),
        F.concat(prefix, "p_brand").alias("indicator_name"),
        F.lit("BLS").alias("source"),
        "industry_name",
        F.lit("").alias("seasonal_adjustment"),
    )


def stage_members(dimension: DataFrame) -> DataFrame:
    """Four stages of five brands each; the other brands belong to none."""
    number = _number_of(F.col("raw_series_id"))
    stage = F.concat(F.lit("Stage "), (F.floor((number - 1) / 5) + 1).cast("string"))
    return dimension.where(number <= 20).select("raw_series_id", stage.alias("stage"))


def rawpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw points as text: missing marks, bad values, bad periods, absent fields, gaps, copies."""
    n, date, annual = F.col("n"), F.col("date"), F.col("annual")
    cell = _with_years(cells(spark, sf_dir)).where("annual OR n % 11 <> 0")
    month = F.concat(F.lit("M"), F.lpad(F.month(date).cast("string"), 2, "0"))
    money = _money(F.col("cents"))
    plain = F.struct(
        F.when(annual, "M13").otherwise(month).alias("period"),
        F.when(annual, "Annual").otherwise(F.date_format(date, "MMMM")).alias("periodName"),
        money.alias("value"),
    )
    faulty = F.struct(
        F.when(n % 17 == 0, "Q01").otherwise(month).alias("period"),
        F.when(n % 23 != 0, F.date_format(date, "MMMM")).alias("periodName"),
        F.when(n % 7 == 0, "-").when(n % 19 == 0, "n/a").otherwise(money).alias("value"),
    )
    versions = F.when(annual, F.array(plain)).when(n % 13 == 0, F.array(faulty, plain)).otherwise(F.array(faulty))
    return cell.select("brand", date, annual, n, F.explode(versions).alias("point")).select(
        F.col("brand").alias("series_id"),
        F.year(date).cast("string").alias("year"),
        "point.*",
        F.when(annual, "0").otherwise(n.cast("string")).alias("code"),
    )


def rawpoint_with_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw points as read from documents: footnotes as JSON text."""
    notes = F.to_json(F.array(F.struct("code")))
    return rawpoint(spark, sf_dir).withColumn("footnotes", notes).drop("code")


def _money(cents: Column) -> Column:
    return (cents.cast("decimal(20,0)") * F.lit("0.01").cast("decimal(2,2)")).cast("decimal(22,2)").cast("string")


def rawdoc(points: DataFrame) -> DataFrame:
    """Points nested into one document per series, in a fixed order."""
    note = F.array(F.struct("code"))
    point = F.struct("year", "period", "periodName", "value", note.alias("footnotes"))
    # A document holds at most a few points per month of its series.
    return points.groupBy("series_id").agg(F.sort_array(F.collect_list(point)).alias("points"))


def raw_texts(docs: DataFrame) -> DataFrame:
    """Documents (series_id, points) as JSON lines: by number of the series three shapes, then broken ones."""
    number, data = _number_of(F.col("series_id")), F.col("points").alias("data")
    inner = F.struct(F.col("series_id").alias("seriesID"), data)
    no_data = F.struct(F.col("series_id").alias("seriesID"))
    industry = F.lit("industry").alias("series_type")

    def consolidated(document: Column) -> Column:
        return F.to_json(F.create_map("series_id", F.struct(industry, document.alias("data"))))

    text = (
        F.when(number <= 8, F.to_json(inner))
        .when(number <= 16, F.to_json(F.struct("series_id", data)))
        .when(number <= 20, consolidated(inner))
        .when(number == 21, consolidated(no_data))
        .when(number == 22, F.to_json(F.struct(F.col("series_id").alias("seriesID"), F.lit("none").alias("data"))))
        .when(number == 23, F.expr("substr(to_json(struct(series_id, points)), 1, 40)"))
        .when(number == 24, F.to_json(F.struct("series_id", F.slice("points", 1, 0).alias("data"))))
        .otherwise(F.lit('{"note": 1}'))
    )
    return docs.select(text.alias("value"))


def bracketed(points: DataFrame) -> DataFrame:
    """Points whose notes hold brackets, quotes and backslashes."""
    return points.withColumn("code", F.concat(F.lit("}"), "code", F.lit('"{[\\')))


def consolidated_lines(docs: DataFrame) -> DataFrame:
    """Documents (series_id, points) as the lines of one indented object, in their order."""
    document = F.struct(F.col("series_id").alias("seriesID"), F.col("points").alias("data"))
    entry = F.to_json(F.struct(F.lit("industry").alias("series_type"), document.alias("data")), {"pretty": "true"})
    mark = F.when(F.col("series_id") == docs.agg(F.min("series_id").alias("first")).scalar(), "{").otherwise(",")
    lines = docs.select("series_id", F.concat(mark, F.lit('\n  "'), "series_id", F.lit('": '), entry).alias("value"))
    end = docs.select(F.lit(None).cast("string").alias("series_id"), F.lit("}").alias("value")).limit(1)
    return lines.unionByName(end).coalesce(1).sortWithinPartitions(F.asc_nulls_last("series_id")).select("value")


def awkward(name: Column, series_id: Column) -> Column:
    """Names with all that a CSV file must quote, by the id's last digit."""
    digit = F.substring(series_id, -1, 1).cast("int")
    return (
        F.when(digit == 0, F.concat(name, F.lit(', 2" x 4", cut')))
        .when(digit == 1, F.concat(F.lit("  "), name, F.lit(" ")))
        .when(digit == 2, F.concat(name, F.lit("\n second line")))
        .when(digit == 3, F.lit(""))
        .when(digit == 4, F.concat(name, F.lit("\\")))
        .when(digit != 5, name)
    )


def catalogs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Aggregation, commodity and industry catalogs; they overlap."""
    part = table(spark, sf_dir, "part")
    entry = [F.col("p_partkey").cast("string").alias("series_id"), F.col("p_name").alias("series_name")]
    return (
        part.where("p_size <= 20").select(*entry),
        part.where("p_type = 'ECONOMY'").select(*entry),
        part.where("p_size > 10").select(*entry),
    )


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger of an earlier run, which got as far as the cheaper parts."""
    part = table(spark, sf_dir, "part")
    kind = F.when(F.col("p_size") <= 20, "aggregated").when(F.col("p_type") == "ECONOMY", "commodity")
    kind = kind.otherwise("industry")
    failed = F.col("p_size") % 4 == 0
    return part.where("p_size <= 40").select(
        F.col("p_partkey").cast("string").alias("series_id"),
        F.when(failed, "error").otherwise("success").alias("status"),
        F.when(failed, NOT_FOUND).alias("error"),
        kind.alias("series_type"),
    )
