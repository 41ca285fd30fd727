"""Quality rules for raw documents.

Every rule is judged on its own and reported in long form, one row per document,
point and broken rule, so no document's findings have to fit into one row.
"""

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidegauge.functions import columns as c
from tidegauge.operators.silver import explode_list
from tidegauge.schemas import POINT
from tidegauge.sources import documents

REQUIRED = {
    "year": "missing_year",
    "period": "missing_period",
    "periodName": "missing_period_name",
    "value": "missing_value",
}
_POINTS = f"array<{POINT.simpleString()}>"


def inspect_documents(text: DataFrame) -> DataFrame:
    """(file, part, document, problems, points) of JSON texts, whatever their shape.

    The reader's own parser tells the documents, so what can be read is judged
    by its points. A document without id is called by its file; ``file``,
    ``part`` and ``document`` together name one document.
    """
    shaped = documents.shape_documents(text)
    readable, missing = F.col("readable"), F.col("data").isNull()
    return shaped.select(
        "file",
        "part",
        F.coalesce("series_id", "file").alias("document"),
        F.filter(
            F.array(
                F.when(~readable, "invalid_json"),
                F.when(readable & F.col("series_id").isNull(), "missing_series_id"),
                F.when(readable & missing, "missing_data"),
                F.when(~missing & ~F.col("is_list"), "data_not_list"),
            ),
            lambda rule: rule.isNotNull(),
        ).alias("problems"),
        F.when(F.col("is_list"), F.from_json("data", _POINTS)).alias("points"),
    )


def document_points(inspected: DataFrame) -> DataFrame:
    keyed = inspected.withColumn("key", F.struct("file", "part", "document"))
    exploded = explode_list(keyed, "key", "points", "position", "point")
    return exploded.select("key.*", "position", "point.*")


def _violations(points: DataFrame, rules: dict[str, Column]) -> DataFrame:
    broken = F.filter(
        F.array(*[F.when(condition, F.lit(rule)) for rule, condition in rules.items()]), lambda r: r.isNotNull()
    )
    return points.select("document", "position", F.explode(broken).alias("rule"))


def document_violations(inspected: DataFrame) -> DataFrame:
    """Documents without id, without data, with data that is no list or with no points."""
    none = F.array().cast("array<string>")
    empty = F.when((F.size("points") == 0) & (F.size("problems") == 0), F.array(F.lit("no_values"))).otherwise(none)
    return inspected.select("document", F.explode(F.concat("problems", empty)).alias("rule"))


def structure_violations(points: DataFrame) -> DataFrame:
    """Fields that points lack."""
    return _violations(points, {rule: F.col(field).isNull() for field, rule in REQUIRED.items()})


def type_violations(points: DataFrame) -> DataFrame:
    """Fields that are there but cannot be read: year, value, period of month 1 to 12."""
    return _violations(
        points,
        {
            "bad_year": F.col("year").isNotNull() & c.integer(F.col("year")).isNull(),
            "bad_value": F.col("value").isNotNull() & c.number(F.col("value")).isNull(),
            "bad_period": F.col("period").isNotNull() & c.period_month(F.col("period")).isNull(),
        },
    )


def duplicate_points(points: DataFrame) -> DataFrame:
    """Periods that a document lists more than once."""
    counts = points.groupBy("file", "part", "document", "year", "period").agg(F.count("*").alias("n_points"))
    return counts.where(F.col("n_points") > 1).select("document", "year", "period", "n_points")


def document_observations(points: DataFrame) -> DataFrame:
    """(document key, date, value, the value's text) of the points that have a month."""
    date = c.period_date(c.integer(F.col("year")), F.col("period"))
    key = F.struct("file", "part", "document").alias("key")
    value = c.number(F.col("value"))
    return points.select(key, date.alias("date"), value.alias("value"), F.col("value").alias("text")).where("date IS NOT NULL")


def details(inspected: DataFrame) -> DataFrame:
    """Where the rules are broken: document, rule, position, month and text of every finding.

    A gap has the month before it and how many months lack; a repeated point how often it is there.
    """
    points = document_points(inspected)
    observed = document_observations(points)
    broken = structure_violations(points).unionByName(type_violations(points))
    placed = broken.select("document", "rule", "position", F.lit(None).cast("date").alias("month"), F.lit(None).cast("string").alias("detail"))

    def found(rows: DataFrame, rule: str, month: Column, detail: Column) -> DataFrame:
        position = F.lit(None).cast("int").alias("position")
        return rows.select("document", F.lit(rule).alias("rule"), position, month.alias("month"), detail.cast("string").alias("detail"))

    gaps = month_gaps(observed, "key").select("key.document", "from_month", "missing_months")
    far = outliers(observed, "key").select("key.document", "date", "text")
    repeated = duplicate_points(points)
    at = c.period_date(c.integer(F.col("year")), F.col("period"))
    return (
        placed.unionByName(found(gaps, "gap", F.col("from_month"), F.col("missing_months")))
        .unionByName(found(far, "outlier", F.col("date"), F.col("text")))
        .unionByName(found(repeated, "duplicate_point", at, F.col("n_points")))
    )


def document_stats(inspected: DataFrame) -> DataFrame:
    """Range, mean, count and deviation of the values of each document."""
    stats = series_stats(document_observations(document_points(inspected)), "key")
    return stats.select("key.document", *[c for c in stats.columns if c != "key"])


def month_gaps(observations: DataFrame, key: str = "series_id") -> DataFrame:
    """Pairs of neighbouring months of a series that lie more than one month apart."""
    # Distinct months first: a series then has at most twelve rows per year.
    months = observations.select(key, c.month_start(F.col("date")).alias("from_month")).distinct()
    following = F.lead("from_month").over(W.partitionBy(key).orderBy("from_month"))
    gap = c.month_index(F.col("to_month")) - c.month_index(F.col("from_month")) - 1
    return months.withColumn("to_month", following).withColumn("missing_months", gap).where("missing_months > 0")


def series_stats(observations: DataFrame, key: str = "series_id") -> DataFrame:
    """Range, mean, count and population deviation of the given values."""
    return observations.groupBy(key).agg(
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
        F.avg("value").alias("mean_value"),
        F.count("value").alias("n_values"),
        F.stddev_pop("value").alias("std_value"),
    )


def outliers(observations: DataFrame, key: str = "series_id", deviations: float = 3.0) -> DataFrame:
    """Observations strictly more than ``deviations`` standard deviations off the mean.

    The statistics are aggregated and joined back rather than computed in a
    window, which would hand a whole series to one task.
    """
    return far_from_mean(observations, series_stats(observations, key), key, deviations)


def far_from_mean(observations: DataFrame, stats: DataFrame, key: str = "series_id", deviations: float = 3.0) -> DataFrame:
    """Observations strictly more than ``deviations`` standard deviations off the mean, by given statistics."""
    far = F.abs(F.col("value") - F.col("mean_value")) > deviations * F.col("std_value")
    return observations.join(stats.select(key, "mean_value", "std_value"), key).where(far)


def _differences(sorted_values: Column) -> Column:
    """Steps between neighbours of an array."""
    steps = F.greatest(F.size(sorted_values) - 1, F.lit(0))
    return F.zip_with(F.slice(sorted_values, 2, steps), F.slice(sorted_values, 1, steps), lambda b, a: b - a)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def _n_outliers(values: Column) -> Column:
    def total(of) -> Column:
        return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + of(x))

    n = F.nullif(F.size(values), F.lit(0))

    def spread(mean: Column) -> Column:
        return F.struct(mean.alias("mean"), F.sqrt(total(lambda x: (x - mean) * (x - mean)) / n).alias("std"))

    def far(s: Column) -> Column:
        return F.size(F.filter(values, lambda x: F.abs(x - s["mean"]) > 3 * s["std"]))

    return F.coalesce(_let(_let(total(lambda x: x) / n, spread), far), F.lit(0))


def judge_documents(inspected: DataFrame) -> DataFrame:
    """One row per document: its number of violations per rule, and whether it is valid.

    A document is one row with all its points, so every rule, also those over
    the whole series, is judged in place: one pass and no shuffle.
    """
    points = F.coalesce("points", F.array().cast(_POINTS))
    dated = F.filter(
        F.transform(
            points,
            lambda p: F.struct(
                c.period_date(c.integer(p["year"]), p["period"]).alias("date"), c.number(p["value"]).alias("value")
            ),
        ),
        lambda o: o["date"].isNotNull(),
    )
    prepared = inspected.select("file", "part", "document", "problems", points.alias("points"), dated.alias("dated"))

    def having(rule) -> Column:
        return F.size(F.filter("points", rule))

    def lacking(field: str) -> Column:
        return having(lambda p: p[field].isNull())

    keys = F.transform("points", lambda p: F.struct(p["year"], p["period"]))
    months = F.sort_array(F.array_distinct(F.transform("dated", lambda o: c.month_index(o["date"]))))
    values = F.filter(F.transform("dated", lambda o: o["value"]), lambda v: v.isNotNull())
    counts = {
        **{rule: lacking(field) for field, rule in REQUIRED.items()},
        "bad_year": having(lambda p: p["year"].isNotNull() & c.integer(p["year"]).isNull()),
        "bad_value": having(lambda p: p["value"].isNotNull() & c.number(p["value"]).isNull()),
        "bad_period": having(lambda p: p["period"].isNotNull() & c.period_month(p["period"]).isNull()),
        "duplicate_point": F.size(keys) - F.size(F.array_distinct(keys)),
        "gap": F.size(F.filter(_differences(months), lambda step: step > 1)),
        "outlier": _n_outliers(values),
        "no_values": ((F.size("points") == 0) & (F.size("problems") == 0)).cast("int"),
    }
    of_points = F.create_map(*[part for rule, n in counts.items() for part in (F.lit(rule), n)])
    of_document = F.map_from_entries(F.transform("problems", lambda rule: F.struct(rule, F.lit(1))))
    violations = F.map_filter(F.map_concat(of_points, of_document), lambda rule, n: n > 0)
    return prepared.select("file", "part", "document", violations.alias("violations")).withColumn(
        "is_valid", F.size("violations") == 0
    )


def findings(judged: DataFrame) -> DataFrame:
    """The judgements in long form: document, broken rule and number of violations."""
    return explode_list(judged, "document", "violations", "rule", "n_violations")


def report_summary(judged: DataFrame) -> DataFrame:
    """Total, valid and invalid documents and the rate of valid ones as text."""
    totals = judged.agg(
        F.count("*").alias("total_files"),
        F.count_if("is_valid").alias("valid_files"),
        F.count_if(~F.col("is_valid")).alias("invalid_files"),
    )
    rate = F.coalesce(c.percent(F.col("valid_files"), F.col("total_files")), F.lit(0.0))
    return totals.withColumn("success_rate", F.format_string("%.2f%%", rate))
