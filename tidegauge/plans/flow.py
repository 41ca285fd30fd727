"""The steps from catalogs and raw documents to gold tables, checks and reports.

Each step reads what the step before wrote, so a step can be run again on its
own. Folders may lie on any file system the cluster shares.
"""

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidegauge.operators import catalog, quality_gold, quality_raw, silver as observed, star, views
from tidegauge.plans import reports, stages as stage_plans
from tidegauge.sources import catalogs, documents, ledger as ledgers, snapshots, tables

# --- fixed values: names of files, folders and tables -----------------------
CATALOG_FILES = {
    "aggregation": "ppi_aggregation_series_ids.csv",
    "commodity": "ppi_commodity_series_ids.csv",
    "industry": "ppi_series_ids.csv",
}
COMBINED, VALIDATED = "final_ppi_series_ids.csv", "validated_ppi_series.csv"
DOCUMENTS, LEDGER, REPORT = "raw_series_data", "extraction_ledger", "validation_report"
METADATA, POINTS = "series_metadata.parquet", "points"
OBSERVATIONS, QUARANTINE = "observations", "quarantine"
DIMENSION, FACT = "economic_indicators_metadata", "economic_indicators_values"
VIEWS = ["economic_indicators_monthly", "economic_indicators_changes", "economic_indicators_yearly"]
CHECK_PATTERN, REPORT_PATTERN = "%manufacturing%", "%PPI%"
RECENT = dt.date(2023, 1, 1)


# --- bronze -----------------------------------------------------------------


def build_catalog(spark: SparkSession, bronze: str) -> None:
    """Combine the three catalogs into one with a type per series."""
    parts = {name: catalogs.read_catalog(spark, f"{bronze}/{file}") for name, file in CATALOG_FILES.items()}
    catalogs.write_csv(catalog.combine_catalogs(**parts), f"{bronze}/{COMBINED}")


def validate_catalog(spark: SparkSession, bronze: str, results: DataFrame) -> None:
    """Add the outcome of validation, given as (series_id, ok)."""
    combined = catalogs.read_validated(spark, f"{bronze}/{COMBINED}")
    catalogs.write_csv(catalog.apply_validation(combined, results), f"{bronze}/{VALIDATED}")


def next_requests(spark: SparkSession, bronze: str, used: list[int]) -> DataFrame:
    """The requests that may still run today, for series without a ledger entry."""
    validated = catalogs.read_validated(spark, f"{bronze}/{VALIDATED}")
    pending = catalog.pending_series(validated, ledgers.read_ledger(spark, f"{bronze}/{LEDGER}"))
    batches = catalog.request_batches(pending)
    return catalog.batches_within_budget(batches, remaining=catalog.remaining_requests(used))


def _stamp(at: dt.datetime) -> str:
    return at.strftime("%Y%m%d_%H%M%S_%f")


def record_answer(requested: DataFrame, received: DataFrame, bronze: str, at: dt.datetime) -> None:
    """Keep the documents (series_id, series_type, points) of an answer and enter them in the ledger.

    The time names the request: recording it again replaces what it left, so a
    step that broke off in between can be run again. Of several documents of a
    series, readers take the one delivered last.
    """
    delivered = received.withColumn("delivered", F.lit(_stamp(at)))
    documents.write_consolidated(delivered, f"{bronze}/{DOCUMENTS}/request={_stamp(at)}", mode="overwrite")
    ledgers.write_ledger(catalog.ledger_of_answer(requested, received), f"{bronze}/{LEDGER}", _stamp(at))


def record_failure(requested: DataFrame, reason: str, bronze: str, at: dt.datetime) -> None:
    """Enter a request without an answer in the ledger, with its reason."""
    ledgers.write_ledger(catalog.failed_request(requested, reason), f"{bronze}/{LEDGER}", _stamp(at))


def check_bronze(spark: SparkSession, bronze: str, run_at: dt.datetime, lines: bool = True) -> DataFrame:
    """Judge the raw documents, write the report (judgements, places, statistics, summary) and return its summary."""
    text = documents.read_json_text(spark, f"{bronze}/{DOCUMENTS}", lines)
    staged = f"{bronze}/{REPORT}/inspected"
    quality_raw.inspect_documents(text).write.mode("overwrite").parquet(staged)
    inspected = spark.read.parquet(staged)
    judged = quality_raw.judge_documents(inspected)
    catalogs.write_report(judged, f"{bronze}/{REPORT}/documents")
    catalogs.write_report(quality_raw.details(inspected), f"{bronze}/{REPORT}/details")
    catalogs.write_report(quality_raw.document_stats(inspected), f"{bronze}/{REPORT}/stats")
    stored = spark.read.schema(judged.schema).json(f"{bronze}/{REPORT}/documents")
    summary = quality_raw.report_summary(stored).withColumn("timestamp", F.lit(run_at))
    catalogs.write_report(summary, f"{bronze}/{REPORT}/summary")
    return summary


# --- silver -----------------------------------------------------------------


def build_silver(spark: SparkSession, bronze: str, silver: str, run_at: dt.datetime, lines: bool = True) -> None:
    """Validated catalog and raw documents to metadata, observations and quarantine."""
    validated = catalogs.read_validated(spark, f"{bronze}/{VALIDATED}")
    snapshots.write_metadata(observed.series_metadata(validated, F.lit(run_at)), f"{silver}/{METADATA}")
    stamp = run_at.strftime("%Y%m%d_%H%M%S")
    # The documents are stored, so that the texts are parsed once and not once per use.
    staged = f"{silver}/{POINTS}/snapshot={stamp}"
    documents.read_series_documents(spark, f"{bronze}/{DOCUMENTS}", lines).write.mode("overwrite").parquet(staged)
    docs = spark.read.parquet(staged)
    if docs.isEmpty():
        raise ValueError(f"no series documents in {bronze}/{DOCUMENTS}")
    points = observed.explode_points(documents.latest_per_series(docs))
    records = observed.standardize(points, F.lit(run_at))
    snapshots.write_snapshot(observed.clean(records), f"{silver}/{OBSERVATIONS}", stamp)
    observed.quarantine_points(points).write.mode("overwrite").parquet(f"{silver}/{QUARANTINE}/snapshot={stamp}")


# --- gold -------------------------------------------------------------------


def build_gold(spark: SparkSession, silver: str, gold: str, run_at: dt.datetime) -> None:
    """The newest observations to dimension, fact and views, published as one run."""
    staged = f"{gold}/staged"
    metadata = snapshots.read_metadata(spark, f"{silver}/{METADATA}")
    tables.write_table(star.build_dimension(metadata, F.lit(run_at)), f"{staged}/{DIMENSION}")
    dim = spark.read.parquet(f"{staged}/{DIMENSION}")
    newest = snapshots.newest_snapshot(spark, f"{silver}/{OBSERVATIONS}")
    tables.write_by_year(star.build_fact(newest, dim, F.lit(run_at)), f"{staged}/{FACT}", whole=True)
    fact = spark.read.parquet(f"{staged}/{FACT}")
    tables.write_table(views.large_series(fact), f"{staged}/large_series")
    sizes = spark.read.parquet(f"{staged}/large_series")
    changes = views.changes_by_rows(fact, dim, sizes=sizes)
    built = dict(zip(VIEWS, (views.monthly(fact, dim), changes, views.yearly(fact, dim))))
    tables.publish({DIMENSION: dim, FACT: fact, **built}, gold, _stamp(run_at))


def open_gold(spark: SparkSession, gold: str) -> dict[str, DataFrame]:
    """The gold tables of the run published last, by name, also as temporary views for SQL."""
    opened = {name: tables.published(spark, gold, name) for name in [DIMENSION, FACT, *VIEWS]}
    for name, table in opened.items():
        table.createOrReplaceTempView(name)
    return opened


def check_gold(opened: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Every check on the gold tables, by name."""
    dim, fact = opened[DIMENSION], opened[FACT]
    monthly, changes, _ = (opened[name] for name in VIEWS)
    return {
        "row_counts": tables.row_counts({name: opened[name] for name in (DIMENSION, FACT, *VIEWS[:2])}),
        "date_coverage": quality_gold.date_coverage(fact),
        "null_share": quality_gold.null_share(fact),
        "cardinality": quality_gold.cardinality(fact),
        "monthly_coverage": quality_gold.view_coverage(monthly),
        "changes_coverage": quality_gold.view_coverage(changes),
        "duplicate_keys": quality_gold.duplicate_keys(quality_gold.gold_keys(dim, fact, monthly, changes)),
        "latest_like": reports.latest_like(fact, dim, CHECK_PATTERN),
        "values_recent": reports.values_recent(fact, dim, RECENT),
        "nulls_by_series": quality_gold.nulls_by_series(fact),
        "annual_rows_by_indicator": quality_gold.annual_rows_by_indicator(fact, dim),
        "view_profile": quality_gold.view_profile({name: opened[name] for name in VIEWS}),
        "annual_mismatches": quality_gold.annual_mismatches(fact, dim),
        "annual_summary": quality_gold.annual_summary(fact),
    }


def report_gold(opened: dict[str, DataFrame], stages: DataFrame) -> dict[str, DataFrame]:
    """Every end-user query, by name."""
    dim, fact = opened[DIMENSION], opened[FACT]
    monthly, changes, _ = (opened[name] for name in VIEWS)
    index = stage_plans.stage_index(fact, dim, stages)
    return {
        "latest_like": reports.latest_like(fact, dim, REPORT_PATTERN),
        "monthly_recent": reports.monthly_recent(monthly, dim, RECENT),
        "latest_changes_top": reports.latest_changes_top(changes, dim),
        "last_12_months": reports.last_12_months(fact, dim, REPORT_PATTERN).orderBy("date", "series_id"),
        "cross_indicator_pairs": reports.cross_indicator_pairs(changes, dim),
        "recent_nulls": quality_gold.recent_nulls(fact, dim),
        "stage_pressure": stage_plans.stage_pressure(fact, dim, stages),
        "stage_observations": stage_plans.stage_observations(fact, dim, stages),
        "stage_yoy_wide": stage_plans.stage_yoy_wide(stage_plans.stage_yoy(index)).orderBy("date"),
    }
