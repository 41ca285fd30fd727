"""Every checked query: name to (spark, table folder) -> DataFrame.

Measures that depend on the order in which doubles are added are rounded to six
digits here (four for deviations), as in the SQL they are checked against.
"""

import datetime as dt
import functools
import uuid

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from tidegauge.operators import catalog, quality_gold, quality_raw, silver, star, views
from tidegauge.plans import reports, stages, standins as s
from tidegauge.session import scratch
from tidegauge.sources import catalogs as catalog_files, documents, snapshots, tables
from tidegauge.streaming import stats, views as streaming

PATTERN = "%PPI%"
RECENT = dt.date(2001, 1, 1)
RUN = "2024-01-01 00:00:00"
MAX_BATCHES, REMAINING = 12, 30


def _rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    return df.withColumns({name: F.round(name, digits) for name in names})


def _fact_dim(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return s.obs(spark, sf), s.dim(spark, sf)


def _dirty_dim(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return s.obs_dirty(spark, sf), s.dim(spark, sf)


def _stored(spark: SparkSession, view: DataFrame, name: str) -> DataFrame:
    """A view as the table it is in use, for reports that read it more than once."""
    path = scratch(spark, name)
    tables.write_by_year(view, path)
    return spark.read.parquet(path)


# --- stages -----------------------------------------------------------------


def stage_pressure(spark, sf):
    fact, dim = _fact_dim(spark, sf)
    return stages.stage_pressure(fact, dim, s.stage_members(dim))


def stage_observations(spark, sf):
    fact, dim = _fact_dim(spark, sf)
    return stages.stage_observations(fact, dim, s.stage_members(dim))


def _index(spark, sf):
    fact, dim = _fact_dim(spark, sf)
    return stages.stage_index(fact, dim, s.stage_members(dim))


def stage_index(spark, sf):
    return _rounded(_index(spark, sf), "index_value")


def stage_yoy(spark, sf):
    return _rounded(stages.stage_yoy(_index(spark, sf)), "index_value", "yoy_pct")


def stage_yoy_wide(spark, sf):
    wide = stages.stage_yoy_wide(stages.stage_yoy(_index(spark, sf)), s.STAGE_NAMES)
    return _rounded(wide, *wide.columns[1:])


# --- views ------------------------------------------------------------------


def monthly_agg(spark, sf):
    return _rounded(views.monthly(*_fact_dim(spark, sf)), "avg_value")


def yearly_agg(spark, sf):
    return _rounded(views.yearly(*_fact_dim(spark, sf)), "avg_value", "calculated_annual_value")


def changes_rows(spark, sf):
    return views.changes_by_rows(*_fact_dim(spark, sf))


def changes_bucketed(spark, sf):
    """The changes view over bucketed parts; the row limit makes hot series of all with many rows."""
    database = f"parts_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{scratch(spark, 'parts')}'")
    fact, dim = _fact_dim(spark, sf)
    tables.write_parts(views.change_parts(fact, hot_rows=82, slot_rows=1), dim, database, 8)
    return views.changes_of_parts(spark.table(f"{database}.change_parts"), spark.table(f"{database}.dimension_parts"))


def changes_calendar(spark, sf):
    return views.changes_by_calendar(*_dirty_dim(spark, sf))


# --- reports ----------------------------------------------------------------


def _kept_fact_dim(spark, sf):
    """The fact as the table it is in use, by year."""
    return _stored(spark, s.obs(spark, sf), "fact"), s.dim(spark, sf)


def latest_like(spark, sf):
    return reports.latest_like(*_kept_fact_dim(spark, sf), PATTERN)


def monthly_recent(spark, sf):
    fact, dim = _fact_dim(spark, sf)
    monthly = _stored(spark, views.monthly(fact, dim), "monthly")
    return _rounded(reports.monthly_recent(monthly, dim, RECENT), "avg_value")


def values_recent(spark, sf):
    return reports.values_recent(*_kept_fact_dim(spark, sf), RECENT)


def latest_changes_top(spark, sf):
    fact, dim = _fact_dim(spark, sf)
    return reports.latest_changes_top(_stored(spark, views.row_changes(fact), "changes"), dim)


def last_12_months(spark, sf):
    return reports.last_12_months(*_kept_fact_dim(spark, sf), PATTERN)


def last_12_months_by_series(spark, sf):
    return reports.last_12_months_by_series(*_kept_fact_dim(spark, sf), PATTERN)


def cross_indicator_pairs(spark, sf):
    fact, dim = _fact_dim(spark, sf)
    return reports.cross_indicator_pairs(_stored(spark, views.row_changes(fact), "changes"), dim)


# --- gold checks ------------------------------------------------------------


def annual_mismatch(spark, sf):
    found = quality_gold.annual_mismatches(*_fact_dim(spark, sf))
    return _rounded(found, "calculated_annual_value", "difference", "percent_difference")


def annual_summary(spark, sf):
    return _rounded(quality_gold.annual_summary(s.obs(spark, sf)), "avg_percent_difference")


def annual_rows_by_indicator(spark, sf):
    return quality_gold.annual_rows_by_indicator(*_fact_dim(spark, sf))


def _views(fact, dim):
    return {
        "monthly": views.monthly(fact, dim),
        "changes": views.changes_by_rows(fact, dim),
        "yearly": views.yearly(fact, dim),
    }


def view_profile(spark, sf):
    return quality_gold.view_profile(_views(*_dirty_dim(spark, sf)))


def view_coverage(spark, sf):
    profiles = [
        quality_gold.view_coverage(view).select(F.lit(name).alias("view_name"), "*")
        for name, view in _views(*_dirty_dim(spark, sf)).items()
        if name != "yearly"
    ]
    return profiles[0].unionByName(profiles[1])


def date_coverage(spark, sf):
    return quality_gold.date_coverage(s.obs(spark, sf))


def cardinality(spark, sf):
    return quality_gold.cardinality(s.obs(spark, sf))


def table_row_counts(spark, sf):
    fact, dim = _fact_dim(spark, sf)
    view = _views(fact, dim)
    return tables.row_counts(
        {
            "economic_indicators_metadata": dim,
            "economic_indicators_values": fact,
            "economic_indicators_monthly": view["monthly"],
            "economic_indicators_changes": view["changes"],
        }
    )


def recent_nulls(spark, sf):
    fact, dim = _dirty_dim(spark, sf)
    return quality_gold.recent_nulls(_stored(spark, fact, "fact"), dim)


def null_share(spark, sf):
    return quality_gold.null_share(s.obs_dirty(spark, sf))


def nulls_by_series(spark, sf):
    return quality_gold.nulls_by_series(s.obs_dirty(spark, sf))


def dup_keys(spark, sf):
    fact, dim = _dirty_dim(spark, sf)
    view = _views(fact, dim)
    return quality_gold.duplicate_keys(quality_gold.gold_keys(dim, fact, view["monthly"], view["changes"]))


def month_gaps(spark, sf):
    return quality_raw.month_gaps(s.obs_dirty(spark, sf))


def series_stats(spark, sf):
    stats = quality_raw.series_stats(s.obs_dirty(spark, sf))
    return _rounded(_rounded(stats, "mean_value"), "std_value", digits=4)


def outliers_3sigma(spark, sf):
    found = quality_raw.outliers(s.obs_dirty(spark, sf))
    return found.select("series_id", "date", "value", F.round("mean_value", 6).alias("mean_value"))


def dedupe_rows(spark, sf):
    return silver.dedupe(s.obs_dirty(spark, sf))


# --- star schema ------------------------------------------------------------


def _silver(spark, sf):
    return silver.clean(silver.standardize(s.rawpoint_with_notes(spark, sf), RUN))


def _staged_dim(spark, sf):
    dim = s.dim(spark, sf)
    return dim.join(s.stage_members(dim).select("raw_series_id"), "raw_series_id", "left_semi")


def build_dim(spark, sf):
    metadata = silver.series_metadata(_validated(spark, sf), RUN)
    return star.build_dimension(metadata, RUN).drop("created_at", "updated_at")


def map_series_ids(spark, sf):
    fact = star.build_fact(_silver(spark, sf), s.dim(spark, sf), RUN)
    return fact.drop("created_at", "updated_at")


def unmapped_counts(spark, sf):
    return star.unmapped_counts(_silver(spark, sf), _staged_dim(spark, sf))


def metadata_roundtrip(spark, sf):
    """Series metadata as written and read, with the time of the run in every row."""
    path = scratch(spark, "metadata")
    snapshots.write_metadata(silver.series_metadata(_validated(spark, sf), RUN), path)
    metadata = snapshots.read_metadata(spark, path)
    return metadata.withColumn("processed_timestamp", F.date_format("processed_timestamp", "yyyy-MM-dd HH:mm:ss"))


def run_times(spark, sf):
    """The times of a run in silver and in the fact: one for all rows."""
    rows = _silver(spark, sf)
    fact = star.build_fact(rows, s.dim(spark, sf), RUN)
    times = [rows.select(F.lit("silver").alias("table_name"), F.col("extraction_timestamp").alias("at"))]
    times += [fact.select(F.lit("fact").alias("table_name"), F.col(c).alias("at")) for c in ("created_at", "updated_at")]
    text = F.date_format("at", "yyyy-MM-dd HH:mm:ss").alias("at")
    return functools.reduce(DataFrame.unionByName, times).groupBy("table_name", text).agg(F.count("*").alias("n_rows"))


def sorted_files(spark, sf):
    """Rows by year of the stored fact, and how many of them come before the row ahead of them in their file."""
    path = scratch(spark, "gold")
    tables.write_by_year(s.obs(spark, sf), path)
    rows = spark.read.parquet(path).select("year", "series_id", "date", F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("at"))
    ahead = F.lag(F.struct("series_id", "date")).over(W.partitionBy("year", "file").orderBy("at"))
    early = F.count_if(F.struct("series_id", "date") < F.col("ahead"))
    return rows.withColumn("ahead", ahead).groupBy("year").agg(F.count("*").alias("n_rows"), early.alias("n_unsorted"))


def gold_by_year(spark, sf):
    path = scratch(spark, "gold")
    tables.write_by_year(s.obs(spark, sf), path)
    return spark.read.parquet(path)


def gold_reload(spark, sf):
    """A load, then one that lacks a year: nothing of the first shows."""
    gold = scratch(spark, "gold")
    fact = s.obs(spark, sf)
    tables.publish({"values": fact}, gold, "20240101_000000")
    tables.publish({"values": fact.where("year(date) <> 1997")}, gold, "20240201_000000")
    return tables.published(spark, gold, "values")


def gold_rerun(spark, sf):
    """A run, and another of the same stamp that lacks a year: a table opened between them stays as it is."""
    gold, fact = scratch(spark, "gold"), s.obs(spark, sf)
    tables.publish({"values": fact}, gold, "20240101_000000")
    first = tables.published(spark, gold, "values")
    tables.publish({"values": fact.where("year(date) <> 1997")}, gold, "20240101_000000")
    runs = {"first": first, "second": tables.published(spark, gold, "values")}
    named = [run.select(F.lit(name).alias("run"), "*") for name, run in runs.items()]
    return named[0].unionByName(named[1])


def _published(spark, sf):
    gold = scratch(spark, "gold")
    fact, dim = _fact_dim(spark, sf)
    found = {"economic_indicators_metadata": dim, "economic_indicators_values": fact}
    found |= {f"economic_indicators_{name}": view for name, view in _views(fact, dim).items()}
    tables.publish(found, gold, "20240101_000000")
    return gold, list(found)


def gold_row_counts(spark, sf):
    """Rows by table and year, as the manifest of a run has them."""
    return tables.published_counts(spark, _published(spark, sf)[0])


def gold_tables(spark, sf):
    """Rows of the gold tables as SQL users see them, by year where they have one."""
    database = f"gold_{uuid.uuid4().hex}"
    gold, found = _published(spark, sf)
    tables.register(spark, database, gold, found)
    counts = []
    for name in found:
        table = spark.table(f"{database}.{name}")
        year = F.col("year") if "year" in table.columns else F.lit(None).cast("int")
        counts.append(table.groupBy(year.alias("year")).agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "*"))
    return functools.reduce(DataFrame.unionByName, counts)


# --- raw documents and silver -----------------------------------------------


def _docs(spark, sf):
    return s.rawdoc(s.rawpoint(spark, sf))


def _points_of(docs):
    return silver.explode_points(docs).drop("position")


def read_series_docs(spark, sf):
    path = scratch(spark, "documents")
    docs = _docs(spark, sf).withColumn("number", F.substring("series_id", 7, 9).cast("int"))
    documents.write_documents(docs.where("number <= 10"), path, "seriesID")
    documents.write_documents(docs.where("number > 10 AND number <= 18"), path, "series_id", mode="append")
    consolidated = docs.where("number > 18").withColumn("series_type", F.lit("industry"))
    documents.write_consolidated(consolidated, path, mode="append")
    return _points_of(documents.read_series_documents(spark, path, lines=True))


def consolidated_object(spark, sf):
    """All series in one indented object, with brackets in its literals."""
    path = scratch(spark, "consolidated")
    docs = s.rawdoc(s.bracketed(s.rawpoint(spark, sf)))
    s.consolidated_lines(docs).write.text(path)
    return _points_of(documents.read_consolidated(spark, path, "part-*.txt"))


def latest_doc_per_series(spark, sf):
    """Every series delivered twice or once, both versions in the same files."""
    path = scratch(spark, "versions")
    docs = _docs(spark, sf)
    annual = docs.withColumn("points", F.filter("points", lambda p: p["period"] == "M13"))
    redelivered = docs.where(F.substring("series_id", 7, 9).cast("int") > 12)
    first, second = annual.withColumn("delivered", F.lit("1")), redelivered.withColumn("delivered", F.lit("2"))
    documents.write_documents(second.unionByName(first).coalesce(1), path)
    return _points_of(documents.latest_per_series(documents.read_series_documents(spark, path, lines=True)))


def standardize_series(spark, sf):
    records = silver.standardize(s.rawpoint_with_notes(spark, sf), RUN)
    return records.drop("extraction_timestamp")


def annual_flag(spark, sf):
    records = silver.standardize(s.rawpoint_with_notes(spark, sf), RUN)
    return records.groupBy("period", "is_annual_avg").agg(F.count("*").alias("n_rows"))


def period_to_date(spark, sf):
    return _silver(spark, sf).select("series_id", "year", "quarter", "date", "is_annual_avg")


def footnotes_json(spark, sf):
    return _silver(spark, sf).groupBy("footnotes").agg(F.count("*").alias("n_rows"))


def quarantine_points(spark, sf):
    return silver.quarantine_points(s.rawpoint_with_notes(spark, sf)).drop("footnotes", "periodName")


def silver_roundtrip(spark, sf):
    root = scratch(spark, "silver")
    docs = documents.with_points(_docs(spark, sf).select("series_id", F.to_json("points").alias("data")))
    snapshots.write_snapshot(silver.observations(docs, RUN), root, "20240101_000000")
    return snapshots.newest_snapshot(spark, root).drop("extraction_timestamp")


def latest_snapshot(spark, sf):
    """Two full runs, the second with an earlier stamp: the one written last counts."""
    root = scratch(spark, "snapshots")
    rows = _silver(spark, sf)
    snapshots.write_snapshot(rows, root, "20240201_000000")
    revised = rows.withColumn("value", F.col("value") * 2)
    snapshots.write_snapshot(revised, root, "20240101_000000")
    return snapshots.newest_snapshot(spark, root).drop("extraction_timestamp")


def _inspected(spark, sf):
    """Documents of three shapes and some broken ones, as lines of files; those without id are nobody's."""
    path = scratch(spark, "raw")
    s.raw_texts(_docs(spark, sf)).write.text(path)
    inspected = quality_raw.inspect_documents(documents.read_json_text(spark, path, lines=True))
    return inspected.withColumn("document", F.nullif("document", "file"))


def dq_shapes(spark, sf):
    found = _inspected(spark, sf)
    return found.select("document", F.array_join("problems", ",").alias("problems"), F.size("points").cast("bigint").alias("n_points"))


def dq_details(spark, sf):
    return quality_raw.details(_inspected(spark, sf))


def dq_structure(spark, sf):
    inspected = _inspected(spark, sf)
    points = quality_raw.structure_violations(quality_raw.document_points(inspected))
    return points.unionByName(quality_raw.document_violations(inspected), allowMissingColumns=True)


def dq_types(spark, sf):
    return quality_raw.type_violations(quality_raw.document_points(_inspected(spark, sf)))


def dq_dup_points(spark, sf):
    return quality_raw.duplicate_points(quality_raw.document_points(_inspected(spark, sf)))


def dq_report(spark, sf):
    found = quality_raw.findings(quality_raw.judge_documents(_inspected(spark, sf)))
    return found.withColumn("n_violations", F.col("n_violations").cast("bigint"))


def report_json(spark, sf):
    """The summary as a JSON report, read back."""
    path = scratch(spark, "report")
    catalog_files.write_report(dq_summary(spark, sf), path)
    return spark.read.schema("total_files bigint, valid_files bigint, invalid_files bigint, success_rate string").json(path)


def dq_summary(spark, sf):
    return quality_raw.report_summary(quality_raw.judge_documents(_inspected(spark, sf)))


# --- catalogs and extraction ------------------------------------------------


def _combined(spark, sf):
    return catalog.combine_catalogs(*s.catalogs(spark, sf))


def _validated(spark, sf):
    results = s.ledger(spark, sf).select("series_id", (F.col("status") == "success").alias("ok"))
    return catalog.apply_validation(_combined(spark, sf), results)


def _pending(spark, sf):
    return catalog.pending_series(_combined(spark, sf), s.ledger(spark, sf))


def catalog_files_combined(spark, sf):
    """Catalogs as files, with names that need quotes."""
    path = scratch(spark, "catalogs")
    parts = []
    for name, part in zip(("aggregation", "commodity", "industry"), s.catalogs(spark, sf)):
        awkward = part.select("series_id", s.awkward(F.col("series_name"), F.col("series_id")).alias("title"), F.lit("x, y").alias("more"))
        catalog_files.write_csv(awkward, f"{path}/{name}.csv")
        parts.append(catalog_files.read_catalog(spark, f"{path}/{name}.csv"))
    return catalog.combine_catalogs(*parts)


def combine_catalogs(spark, sf):
    return _combined(spark, sf)


def catalog_roundtrip(spark, sf):
    path = scratch(spark, "catalog")
    catalog_files.write_csv(_validated(spark, sf), path)
    return catalog_files.read_validated(spark, path)


def duplicate_totals(spark, sf):
    return catalog.duplicate_totals(*s.catalogs(spark, sf))


def series_by_type(spark, sf):
    return catalog.series_by_type(_combined(spark, sf))


def apply_validation(spark, sf):
    return _validated(spark, sf)


def validity_by_type(spark, sf):
    return catalog.validity_by_type(_validated(spark, sf))


def pending_series(spark, sf):
    return _pending(spark, sf)


def retry_series(spark, sf):
    return catalog.pending_series(_combined(spark, sf), s.ledger(spark, sf), retry_failed=True)


def missing_series(spark, sf):
    received = s.ledger(spark, sf).where("status = 'success'")
    return catalog.missing_series(_combined(spark, sf), received)


def _batches(spark, sf):
    return catalog.request_batches(_combined(spark, sf))


def request_batches(spark, sf):
    lists = catalog.request_lists(_batches(spark, sf))
    return lists.withColumn("series_ids", F.array_join("series_ids", ","))


def batches_within_budget(spark, sf):
    return catalog.batches_within_budget(_batches(spark, sf), MAX_BATCHES, REMAINING)


def upsert_consolidated(spark, sf):
    existing = s.ledger(spark, sf).select("series_id", "series_type", F.lit("old").alias("document"))
    new = _combined(spark, sf).where("series_type <> 'aggregated'").select(
        "series_id", "series_type", F.lit("new").alias("document")
    )
    return catalog.upsert_consolidated(existing, new)


def upsert_log(spark, sf):
    """The earlier documents, an update of all but one type, and one of a few series."""
    log = catalog.document_log(spark, scratch(spark, "documents"))
    old = s.ledger(spark, sf).select("series_id", "series_type", F.lit("old").alias("document"))
    combined = _combined(spark, sf)
    new = combined.where("series_type <> 'aggregated'").withColumn("document", F.lit("new"))
    few = combined.where("series_id LIKE '%77'").withColumn("document", F.lit("few"))
    for number, documents_of in enumerate((old, new, few)):
        catalog.upsert_documents(log, documents_of, number)
    return catalog.current_documents(log)


def series_of_type(spark, sf):
    return catalog.series_of_type(_validated(spark, sf), "commodity", valid_only=True)


def status_by_type(spark, sf):
    return catalog.status_by_type(s.ledger(spark, sf))


# --- streaming --------------------------------------------------------------

ARRIVALS = [("1998-01-01", "2000-01-01"), ("1995-01-01", "1998-01-01"), ("2000-01-01", "2002-01-01")]


def _arrivals(spark, sf):
    """Observations as files by year range, the first range delivered late."""
    path = scratch(spark, "arrivals")
    rows = _stored(spark, s.obs(spark, sf), "observations").drop("year").withColumn("part", _arrival_number())
    for number in range(len(ARRIVALS) + 1):
        rows.where(F.col("part") == number).drop("part").hint("rebalance").write.mode("append").parquet(path)
    return streaming.observation_stream(spark, path, files_per_batch=1)


def _arrival_number():
    number = F.lit(len(ARRIVALS))
    for i, (start, end) in enumerate(ARRIVALS):
        number = F.when((F.col("date") >= start) & (F.col("date") < end), i).otherwise(number)
    return number


def _stream_periods(spark, sf, start):
    path, checkpoint = scratch(spark, "states"), scratch(spark, "progress")
    streaming.maintain_periods(_arrivals(spark, sf), path, checkpoint, start, available_now=True).awaitTermination()
    return streaming.read_periods(spark, path, s.dim(spark, sf))


def stream_monthly(spark, sf):
    return _rounded(_stream_periods(spark, sf, streaming.MONTHLY), "avg_value")


def stream_yearly(spark, sf):
    return _rounded(_stream_periods(spark, sf, streaming.YEARLY), "avg_value")


def _stats(spark, sf):
    """Statistics over three deliveries, the earliest rows last."""
    log = stats.stats_log(spark, scratch(spark, "stats"), fanout=2)
    rows = _stored(spark, s.obs_dirty(spark, sf), "observations").drop("year")
    for number, years in enumerate(("> 1999", "BETWEEN 1997 AND 1999", "< 1997")):
        stats.add_stats_batch(log, rows.where(f"year(date) {years}"), number)
    return log


def stream_stats(spark, sf):
    return _rounded(_rounded(stats.read_stats(_stats(spark, sf)), "mean_value"), "std_value", digits=4)


def stream_outliers(spark, sf):
    found = stats.read_outliers(_stats(spark, sf))
    return found.select("series_id", "date", "value", F.round("mean_value", 6).alias("mean_value"))


def stream_compacted(spark, sf):
    """A batch for each month in turn, the latest months first, so that runs are merged at several levels."""
    log = streaming.period_log(spark, scratch(spark, "states"), fanout=2)
    rows = _stored(spark, s.obs(spark, sf), "observations").drop("year")
    for number in range(12):
        streaming.add_period_batch(log, rows.where(F.month("date") == 12 - number), number, streaming.MONTHLY)
    return _rounded(streaming.read_periods(spark, log.root, s.dim(spark, sf)), "avg_value")


def stream_changes_late(spark, sf):
    """All but a few months of every other series, then these, which other rows look back at."""
    log = streaming.changes_log(spark, scratch(spark, "changes"))
    rows = _stored(spark, s.obs(spark, sf), "observations").drop("year")
    late = (F.year("date") == 1998) & (F.month("date") <= 3) & (F.conv(F.substring("series_id", 1, 1), 16, 10) % 2 == 0)
    for number, part in enumerate((rows.where(~late), rows.where(late))):
        streaming.add_changes_batch(log, part, number)
    return streaming.read_changes(spark, log.root, s.dim(spark, sf))


def stream_changes(spark, sf):
    path, checkpoint = scratch(spark, "changes"), scratch(spark, "progress")
    query = streaming.maintain_changes(_arrivals(spark, sf), path, checkpoint, available_now=True)
    query.awaitTermination()
    return streaming.read_changes(spark, path, s.dim(spark, sf))


QUERIES = {
    query.__name__: query
    for query in [
        stage_pressure, stage_observations, stage_index, stage_yoy, stage_yoy_wide,
        monthly_agg, yearly_agg, changes_rows, changes_bucketed, changes_calendar,
        latest_like, monthly_recent, values_recent, latest_changes_top, last_12_months,
        last_12_months_by_series, cross_indicator_pairs,
        annual_mismatch, annual_summary, annual_rows_by_indicator, view_profile, view_coverage, date_coverage,
        cardinality, table_row_counts, recent_nulls, null_share, nulls_by_series, dup_keys, month_gaps,
        series_stats, outliers_3sigma, dedupe_rows,
        build_dim, map_series_ids, unmapped_counts, metadata_roundtrip, run_times, sorted_files, gold_by_year, gold_reload, gold_rerun, gold_row_counts, gold_tables,
        read_series_docs, consolidated_object, latest_doc_per_series, standardize_series, annual_flag, period_to_date, footnotes_json,
        quarantine_points, silver_roundtrip, latest_snapshot,
        dq_structure, dq_types, dq_dup_points, dq_report, dq_summary, report_json, dq_shapes, dq_details,
        combine_catalogs, catalog_files_combined, catalog_roundtrip, duplicate_totals, series_by_type, apply_validation, validity_by_type,
        pending_series, retry_series, missing_series, request_batches, batches_within_budget, upsert_consolidated, upsert_log,
        series_of_type, status_by_type,
        stream_monthly, stream_yearly, stream_compacted, stream_changes, stream_changes_late, stream_stats, stream_outliers,
    ]
}
